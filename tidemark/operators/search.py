"""Term search over articles: inverted index, document frequencies, recall."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def inverted_index(articles: DataFrame, key: str, text: str) -> DataFrame:
    """term, key, tf: words in lower case."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    return articles.select(key, F.explode(words).alias("term")).groupBy("term", key).agg(F.count(F.lit(1)).alias("tf"))


def term_frequency(articles: DataFrame, terms: DataFrame, most_terms: int = 10_000) -> DataFrame:
    """term, freq: the larger of the numbers of titles and of excerpts that contain the term, whatever its case. The terms are a stated query
    set of at most most_terms; each text is lowered once and tried with all of them, and only counts leave the tasks."""
    want = sorted({r[0] for r in terms.select(F.lower("term")).distinct().limit(most_terms + 1).collect() if r[0] is not None})
    if len(want) > most_terms:
        raise ValueError(f"more than {most_terms} terms")
    low = articles.select(F.lower("title").alias("t"), F.lower("excerpt").alias("e"))
    own = F.filter(F.transform(F.lit(want), lambda w: F.struct(w.alias("term"), F.coalesce(F.contains("t", w), F.lit(False)).alias("t"), F.coalesce(F.contains("e", w), F.lit(False)).alias("e"))), lambda x: x["t"] | x["e"])
    n = low.select(F.explode(own).alias("x")).groupBy("x.term").agg(F.count_if("x.t").alias("in_title"), F.count_if("x.e").alias("in_excerpt"))
    every = articles.sparkSession.createDataFrame([(w,) for w in want], "term string")
    return every.join(n, "term", "left").select("term", F.coalesce(F.greatest("in_title", "in_excerpt"), F.lit(0)).alias("freq"))


def recall(results: DataFrame, expected: DataFrame, within: int = 150) -> DataFrame:
    """query, expected_id, in_set, rank (-1: a miss): the place of the expected row in the results (query, id, published_at), newest first."""
    w = Window.partitionBy("query").orderBy(F.desc_nulls_last("published_at"), "id")
    r = results.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= within)
    out = expected.join(r.select("query", F.col("id").alias("expected_id"), "rank"), ["query", "expected_id"], "left")
    return out.select("query", "expected_id", F.col("rank").isNotNull().alias("in_set"), F.coalesce("rank", F.lit(-1)).alias("rank"))


TITLE_STOP = sorted("adds after amid and are for from has have into more not over plans says sees than that the their this warns was will with".split())
CHROME = sorted("advertisement author by caption comment comments contact cookie cookies copyright credit file home image latest login more newsletter photo picture posted privacy published read related reuters search share source subscribe tags terms".split())


def capital_run(title: Column, stop: list[str] = TITLE_STOP) -> Column:
    """The longest run of capitalised words of a title that aren't stop words, the first of equals; bare letters and digits."""
    words = F.transform(F.split(F.coalesce(title, F.lit("")), r"\s+"), lambda w: F.regexp_replace(w, "[^A-Za-z0-9]", ""))
    none = F.array().cast("array<string>")
    good = lambda w: w.rlike("^[A-Z][A-Za-z0-9]") & ~F.lower(w).isin(stop)
    step = lambda a, w: F.struct(F.when(good(w) & (F.size(a["now"]) + 1 > F.size(a["best"])), F.concat(a["now"], F.array(w))).otherwise(a["best"]).alias("best"), F.when(good(w), F.concat(a["now"], F.array(w))).otherwise(none).alias("now"))
    return F.aggregate(words, F.struct(none.alias("best"), none.alias("now")), step, lambda a: a["best"])


def candidate_terms(title: Column, body: Column, chrome: list[str] = CHROME, places: list[str] | None = None) -> Column:
    """Capitalised phrases of two or more words, 7 to 40 characters, that the title lacks, hold no page furniture, place or month, and don't stand in a photo credit; the first of each."""
    bad = sorted({*chrome, *(places or []), *"january february march april may june july august september october november december jan feb mar apr jun jul aug sep sept oct nov dec".split()})
    every = F.transform(F.regexp_extract_all(body, F.lit(r"(?<![A-Za-z0-9_])([A-Z][a-z]+(?:[ \t]+(?:of[ \t]+|the[ \t]+)?[A-Z][a-z]+){1,3})(?![A-Za-z0-9_])"), F.lit(1)), lambda p: F.trim(p))
    words = lambda p: F.transform(F.split(F.lower(p), r"\s+"), lambda w: F.regexp_replace(w, "[^a-z]", ""))
    near = lambda p: F.substring(body, F.greatest(F.lit(1), F.position(p, body) - 40), F.length(p) + 80)
    low = F.lower(F.coalesce(title, F.lit("")))
    ok = lambda p: F.length(p).between(7, 40) & ~F.contains(low, F.lower(p)) & F.forall(words(p), lambda w: (F.length(w) > 1) & ~w.isin(bad)) & ~near(p).rlike(r"(?i)\b(?:credit|getty|image|photo|photograph|picture|source)\b")
    kept = F.filter(every, ok)
    return F.filter(kept, lambda t, i: F.array_position(F.transform(kept, lambda x: F.lower(x)), F.lower(t)) == i + 1)


def recall_totals(found: DataFrame, control_least: float = 0.8) -> DataFrame:
    """source, in_set, queries over recall()'s rows with a source; control_ok on every row: whether the CONTROL group reached its least share, without which the others say nothing."""
    x = found.groupBy("source").agg(F.count_if("in_set").alias("in_set"), F.count(F.lit(1)).alias("queries"))
    ok = x.agg(F.coalesce(F.max(F.when(F.col("source") == "CONTROL", F.col("in_set") / F.col("queries") >= control_least)), F.lit(False)).alias("control_ok"))
    return x.crossJoin(F.broadcast(ok))
