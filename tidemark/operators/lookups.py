"""Lookups, comparisons and counts over the store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import url_hash


def category_ids(rows: DataFrame, categories: DataFrame, slug: str = "category") -> DataFrame:
    """rows with category_id: that of their slug, else that of 'general', else null. categories: id, slug (a few dozen rows)."""
    c = categories.select(F.col("id").alias("_id"), F.col("slug").alias(slug)).dropDuplicates([slug])
    general = categories.filter("slug = 'general'").agg(F.min("id").alias("_general"))
    return rows.join(c, slug, "left").crossJoin(F.broadcast(general)).withColumn("category_id", F.coalesce("_id", "_general")).drop("_id", "_general")


def with_names(articles: DataFrame, sources: DataFrame, categories: DataFrame) -> DataFrame:
    """articles with source_name and category_slug, null where an id is unknown; rows stay as many."""
    s = sources.select(F.col("id").alias("source_id"), F.col("name").alias("source_name")).dropDuplicates(["source_id"])
    c = categories.select(F.col("id").alias("category_id"), F.col("slug").alias("category_slug")).dropDuplicates(["category_id"])
    return articles.join(s, "source_id", "left").join(c, "category_id", "left")


def hash_parity(stored: DataFrame) -> DataFrame:
    """url_hash of the store against the hash of its url: url, url_hash, expected, ok."""
    return stored.select("url", "url_hash", url_hash(F.col("url")).alias("expected")).withColumn("ok", F.col("url_hash").eqNullSafe(F.col("expected")))


def date_agreement(stored: DataFrame, pages: DataFrame, key: str) -> DataFrame:
    """key, stored_day, page_day, ok for articles whose page names a date."""
    x = stored.select(key, F.to_date("published_at").alias("stored_day")).join(pages.select(key, F.to_date("at").alias("page_day")).filter("page_day is not null"), key)
    return x.withColumn("ok", F.col("stored_day").eqNullSafe(F.col("page_day")))


def merged_index(base: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """base with delta's rows, whose version of a key wins."""
    return base.join(delta.select(key).distinct(), key, "left_anti").unionByName(delta, allowMissingColumns=True)


def shares(df: DataFrame, col: Column, name: str) -> DataFrame:
    """name, n, percent of each value."""
    from pyspark.sql import Window

    x = df.groupBy(col.alias(name)).agg(F.count(F.lit(1)).alias("n"))
    return x.withColumn("percent", F.lit(100.0) * F.col("n") / F.sum("n").over(Window.partitionBy()))  # a row a value


def discovery_mode(config: Column) -> Column:
    """How a source is read, from its settings (a map): the first of its modes that is set."""
    has = lambda k: F.coalesce(config[k], F.lit("")) != ""
    return F.when(has("rss_url"), "rss").when(has("wp_rest"), "rest").when(has("sitemap_url"), "sitemap").when(has("list_url"), "html_list").otherwise("none")


def enum_counts(df: DataFrame, cols: list[str], sample: int = 5000, order: str | None = None) -> DataFrame:
    """col, value, n over a sample of rows (the feature: a look at what values occur), the first by order."""
    part = (df.orderBy(order) if order else df).limit(sample)
    return part.select(F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("value")) for c in cols])).alias("x")).groupBy("x.col", "x.value").agg(F.count(F.lit(1)).alias("n"))


def reclassified(old: Column, new: Column) -> Column:
    """Old segments that are still found, in their old order: re-derivation only drops."""
    return F.array_intersect(old, new)


def same_set(a: Column, b: Column) -> Column:
    return F.array_sort(F.array_distinct(a)) == F.array_sort(F.array_distinct(b))


def dropped_counts(df: DataFrame, old: str, new: str) -> DataFrame:
    """segment, n: how often re-derivation dropped each."""
    return df.select(F.explode(F.array_except(old, new)).alias("segment")).groupBy("segment").agg(F.count(F.lit(1)).alias("n"))


def load_quality(df: DataFrame) -> DataFrame:
    """One row over terms and raw_excerpt: rows, terms, proper_percent, over_500, empty."""
    from tidemark.operators.gates import proper_term

    t = F.coalesce("terms", F.array().cast("array<string>"))
    good = F.size(F.filter(t, proper_term))
    n = F.length(F.coalesce("raw_excerpt", F.lit("")))
    x = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.size(t)), F.lit(0)).alias("terms"), F.coalesce(F.sum(good), F.lit(0)).alias("_g"), F.count_if(n > 500).alias("over_500"), F.count_if(n == 0).alias("empty"))
    return x.select("rows", "terms", F.when(F.col("terms") > 0, F.lit(100.0) * F.col("_g") / F.col("terms")).alias("proper_percent"), "over_500", "empty")


def with_defaults(df: DataFrame) -> DataFrame:
    """Date provenance that a row lacks."""
    return df.withColumn("published_at_source", F.coalesce("published_at_source", F.lit("scraper_default"))).withColumn("published_at_confidence", F.coalesce("published_at_confidence", F.lit("low")))


def reachability(status: Column, error: Column) -> Column:
    """What a probe of a source found."""
    return F.when(status == 200, "ok").when(status == 403, "forbidden").when(status.isin(418, 429, 503), "blocked").when(status.isNull() & error.isNotNull(), "network").otherwise("other")


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def patched(sources: DataFrame, patch: DataFrame) -> DataFrame:
    """sources (source_id, jobs) with the patch's jobs (source_id, job) appended that they don't have, in the patch's order (pos)."""
    p = patch.groupBy("source_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "job"))), lambda x: x["job"]).alias("_new"))
    none = F.array().cast("array<string>")
    return sources.join(p, "source_id", "left").withColumn("jobs", F.array_distinct(F.concat(F.coalesce("jobs", none), F.coalesce("_new", none)))).drop("_new")


def re_extracted(store: DataFrame, wanted: DataFrame, fresh: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """store with cols replaced by fresh's in the wanted rows alone. Refuses if the store lacks a column."""
    lost = missing_columns(store, cols)
    if lost:
        raise ValueError(f"the store lacks {lost}")
    new = fresh.join(wanted.select(key).distinct(), key, "left_semi").select(key, *[F.col(c).alias("_" + c) for c in cols], F.lit(True).alias("_new")).dropDuplicates([key])
    x = store.join(new, key, "left")
    return x.select(*[F.when(F.col("_new"), F.col("_" + c)).otherwise(F.col(c)).alias(c) if c in cols else F.col(c) for c in store.columns])


def bucket_counts(ours: DataFrame, theirs: DataFrame, buckets: list[tuple[str, str, str]], at: str = "published_at") -> DataFrame:
    """bucket, ours, theirs: rows in each half-open [from, to); a row lies in every bucket that holds it."""
    every = F.array_compact(F.array(*[F.when((F.col(at) >= F.lit(a).cast("timestamp")) & (F.col(at) < F.lit(b).cast("timestamp")), F.lit(n)) for n, a, b in buckets]))
    n = lambda df, name: df.select(F.explode(every).alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias(name))
    names = ours.sparkSession.createDataFrame([(n_,) for n_, _, _ in buckets], "bucket string")
    x = names.join(n(ours, "ours"), "bucket", "left").join(n(theirs, "theirs"), "bucket", "left")
    return x.select("bucket", F.coalesce("ours", F.lit(0).cast("long")).alias("ours"), F.coalesce("theirs", F.lit(0).cast("long")).alias("theirs"))


def windowed(df: DataFrame, at: str, after: Column, before: Column) -> DataFrame:
    """Archive rows from after (included) to before (not)."""
    return df.filter((F.col(at) >= after) & (F.col(at) < before))
