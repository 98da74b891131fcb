"""Rule-based classification and tags."""

from __future__ import annotations

import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import lexicons as L
from tidemark.functions.text import Finder, let, matches

Rules = dict[str, tuple[int, list[str]]]


def category(title: Column, excerpt: Column, hint: Column | None = None, rules: Rules = L.CATEGORIES) -> Column:
    """struct<slug, score, confidence>: the first slug with the highest score (its weight for each pattern in title or
    excerpt, and again for each in the title); the hint where no score reaches 2."""
    f = Finder(*(p for _, p in rules.values()))

    def counts(x: Column) -> Column:
        """By rule how many patterns a text holds; null where it has no word that begins one."""
        return F.when((F.size(x["heads"]) > 0) | F.lit(not all(f.heads.values())), F.array(*[f.count(x, p) for _, p in rules.values()]))

    def best(n: Column) -> Column:
        zero = F.lit([0] * len(rules))
        total = F.zip_with(F.coalesce(n[0], zero), F.coalesce(n[1], zero), lambda a, b: a + b)
        scored = F.zip_with(total, F.lit([w for w, _ in rules.values()]), lambda a, w: a * w)
        ranked = F.transform(scored, lambda v, i: F.struct(v.alias("score"), (-i).alias("order")))
        top = F.array_max(ranked)
        return F.struct(top["score"].alias("score"), F.element_at(F.lit(list(rules)), 1 - top["order"]).alias("slug"))

    hint = hint if hint is not None else F.lit(None).cast("string")

    def pick(best: Column) -> Column:
        hinted = (best["score"] < 2) & hint.isNotNull()
        conf = F.when(hinted, F.lit(0.6)).when(best["score"] == 0, F.lit(0.3)).otherwise(F.least(F.lit(0.9), F.lit(0.4) + best["score"].cast("double") * F.lit(0.15)))
        return F.struct(F.when(hinted, hint).when(best["score"] == 0, "general").otherwise(best["slug"]).alias("slug"), best["score"].alias("score"), conf.alias("confidence"))

    both = F.array(f.read(F.concat_ws("\n", title, excerpt)), f.read(title))
    return let(let(F.transform(both, counts), best), pick)


def segments(title: Column, excerpt: Column, category_slug: Column, source_name: Column, rules: dict[str, list[str]] = L.SEGMENTS) -> Column:
    """Segments named by the source, then by the category, then found in the title and the first 400 characters."""
    text = F.concat_ws("\n", title, F.substring(excerpt, 1, 400))
    named = [F.when(matches(source_name, [p]), F.lit(s)) for p, s in L.SOURCE_SEGMENT.items()]
    by_category = F.create_map(*[F.lit(x) for kv in L.CATEGORY_SEGMENT.items() for x in kv])[category_slug]
    found = [F.when(matches(text, p), F.lit(s)) for s, p in rules.items()]
    return F.array_distinct(F.array_compact(F.array(*named, by_category, *found)))


def document_type(hint: Column, source_name: Column, category_slug: Column, title: Column, excerpt: Column) -> Column:
    text = F.concat_ws("\n", title, F.substring(excerpt, 1, 600))
    out = F.when(hint == "port-state-control", "psc_report").when(hint == "pi-insurance", "pi_circular").when(hint == "classification", "class_notice")
    out = out.when(category_slug == "accidents", "casualty_report").when(category_slug == "regulations", "regulation")
    return out.when(matches(text, L.MARKET), "market_report").when(source_name.rlike(r"(?i)press\s*release"), "press_release").otherwise("news")


NAME = "[A-Z][a-z]+"
PHRASE = re.compile(rf"\b({NAME}(?:\s+(?:(?:of|the)\s+)?{NAME}){{1,3}})\b", re.ASCII)
TOKEN = re.compile(r"\b([A-Za-z][-A-Za-z]+)\b", re.ASCII)


def salient(title: str | None, excerpt: str | None, stop: frozenset[str]) -> list[str]:
    t, e = (title or "")[:500], (excerpt or "")[:4000]
    phrases: dict[str, int] = {}
    words: dict[str, int] = {}
    for text, worth in ((t, 5), (e, 1)):
        for p in PHRASE.findall(text):
            phrases[p] = phrases.get(p, 0) + worth
    for text, worth in ((t, 5), (e, 1)):
        for w in TOKEN.findall(text):
            if len(w) >= 4 and w.lower() not in stop and (worth == 5 or w[0].isupper()):
                words[w] = words.get(w, 0) + worth
    covered = {w for p in phrases for w in p.lower().split()}
    every = [*phrases.items(), *((w, n) for w, n in words.items() if w.lower() not in covered)]
    out: dict[str, str] = {}
    for w, _ in sorted(every, key=lambda x: -x[1]):
        out.setdefault(w.lower(), w)
    return list(out.values())


def keywords(title: Column, excerpt: Column, most: int = 5, stop: list[str] = L.STOP_WORDS) -> Column:
    """The most salient capitalised phrases and words: 5 a hit in the title (its first 500 characters), 1 in the excerpt
    (4,000). Words of a phrase that was found don't count alone. Ties stay in order of first occurrence, phrases before
    words. Counting with ordered ties is quadratic in array functions, so texts go to Python in Arrow batches, cut before."""
    none = frozenset(stop)

    @F.arrow_udf("array<string>")
    def pick(t: pa.Array, e: pa.Array) -> pa.Array:
        return pa.array([salient(a, b, none)[:most] for a, b in zip(t.to_pylist(), e.to_pylist(), strict=True)], pa.list_(pa.string()))

    return pick(F.substring(title, 1, 500), F.substring(excerpt, 1, 4000))


GAP = "[^A-Za-z0-9]"
TAGS = "id string, slug string, name string, aliases array<string>, requires array<string>"


def _quoted(word: str) -> str:
    return "".join("\\" + c if c in r".*+?^${}()|[]\\" else c for c in word)


def variant_rows(tags: list) -> list[tuple]:
    """Tags -> (id, slug, requires, phrase, key, pattern in titles, pattern in excerpts), a row for each name and alias. key: the first
    run of letters and digits, which a text must have as a word ('' where there is none: any text may match)."""
    out = []
    some = lambda x: [] if x is None else list(x)
    for t in tags:
        case = "" if t["slug"] in L.CASE_TAGS else "(?i)"
        for raw in [t["name"], *some(t["aliases"])]:
            words = (raw or "").split()
            if not words:
                continue
            w = [_quoted(x) for x in words]
            own = [f"{case}(?:^|{GAP})" + r"\s+".join(w) + f"(?=$|{GAP})"] * 2
            if len(w) == 2:
                for i, most in enumerate((35, 90)):
                    for x, y in (w, w[::-1]):
                        own[i] += f"|(?:^|{GAP}){x}(?=$|{GAP}).{{0,{most}}}(?:^|{GAP}){y}(?=$|{GAP})"
            keys = [k for k in re.split(GAP, " ".join(words)) if k]
            must = [f"(?i)(?:^|{GAP}){_quoted(r.strip())}(?=$|{GAP})" for r in some(t["requires"])]
            note = "requires one of: " + ", ".join(some(t["requires"]))
            out.append((t["id"], t["slug"], "|".join(must) or None, note, len(w) > 1, keys[0].lower() if keys else "", *own))
    return out


VARIANT = "id string, slug string, requires string, note string, phrase boolean, word string, in_title string, in_excerpt string"


def url_tags(url: Column, rules: list[tuple[str, list[str]]] = L.URL_RULES) -> Column:
    """Distinct slugs of the rules whose pattern the URL matches."""
    found = [F.when(url.rlike(p), F.lit(slugs)) for p, slugs in rules]
    return F.array_distinct(F.flatten(F.array_compact(F.array(*found))))


def ruled_out(title: Column, contexts: list[tuple[str, list[str]]] = L.FALSE_CONTEXTS) -> Column:
    """Slugs that the title's phrases forbid."""
    found = [F.when(matches(title, [p]), F.lit(slugs)) for p, slugs in contexts]
    return F.array_distinct(F.flatten(F.array_compact(F.array(*found))))


def tag_details(articles: DataFrame, tags: DataFrame, key: str, threshold: int = 4, rules: list[tuple[str, list[str]]] = L.URL_RULES, contexts: list[tuple[str, list[str]]] = L.FALSE_CONTEXTS, most_tags: int = 50_000) -> DataFrame:
    """key, id, slug, score, contributions (array of area and score), blocked (why the tag doesn't count, or null).

    articles: key, url, title, excerpt. tags: TAGS. URL rule 10; title phrase 6 or word 4; excerpt phrase 2 or word 1, the best of a tag's
    names in each area; score >= threshold. Two words also match within 35 characters in a title and 90 in an excerpt, in either order.
    A tag is blocked by a false context in the title, or where none of its required terms is in title or excerpt.

    An article meets only the names whose first word it has (a hash join on words, of a broadcast side of at most most_tags tags; more go
    through a shuffle), not every tag; regexes run on these pairs alone, and only scores are grouped.
    """
    t = tags.select("id", "slug", "name", "aliases", "requires")
    n = t.count()
    if n <= most_tags:
        v = tags.sparkSession.createDataFrame(variant_rows(t.collect()), VARIANT)  # bounded by most_tags
    else:
        v = t.mapInPandas(lambda fs: (pd.DataFrame(variant_rows(f.to_dict("records")), columns=[c.split()[0] for c in VARIANT.split(", ")]) for f in fs), VARIANT)
    side = (lambda x: F.broadcast(x)) if n <= most_tags else (lambda x: x)
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    a = articles.select(key, text("url").alias("url"), text("title").alias("title"), text("excerpt").alias("excerpt"))
    a = a.withColumn("out", ruled_out(F.col("title"), contexts)).withColumn("all", F.concat_ws("\n", "title", "excerpt"))
    words = F.array_distinct(F.concat(F.split(F.lower(F.translate("all", "\u212a\u0130", "  ")), "[^a-z0-9]+"), F.array(F.lit(""))))
    if n <= most_tags:  # only words that begin a name are exploded
        known = sorted({r[0] for r in v.select("word").distinct().collect()})
        words = F.array_intersect(words, F.lit(known)) if known else F.array().cast("array<string>")
    pairs = a.withColumn("word", F.explode(words)).join(side(v), "word")
    worth = lambda hit, phrase, word: F.when(hit, F.when(F.col("phrase"), phrase).otherwise(word)).otherwise(0)
    met = F.col("requires").isNull() | F.regexp_like(F.col("all"), F.col("requires"))
    gate = F.when(F.array_contains("out", F.col("slug")), "title has a false-context phrase").when(~met, F.col("note")).alias("gate")
    in_text = pairs.select(key, "id", "slug", F.lit(0).alias("u"), worth(F.regexp_like(F.col("title"), F.col("in_title")), 6, 4).alias("t"), worth(F.regexp_like(F.col("excerpt"), F.col("in_excerpt")), 2, 1).alias("e"), gate)
    tag = v.groupBy("id", "slug").agg(F.first("requires").alias("requires"), F.first("note").alias("note"))
    in_url = a.withColumn("slug", F.explode(url_tags(F.col("url"), rules))).join(side(tag), "slug").select(key, "id", "slug", F.lit(10).alias("u"), F.lit(0).alias("t"), F.lit(0).alias("e"), gate)
    s = in_text.filter("t > 0 or e > 0").unionByName(in_url).groupBy(key, "id", "slug").agg(F.max("u").alias("u"), F.max("t").alias("t"), F.max("e").alias("e"), F.max("gate").alias("blocked"))
    s = s.withColumn("score", F.col("u") + F.col("t") + F.col("e")).filter(F.col("score") >= threshold)
    parts = F.array(*[F.when(F.col(c) > 0, F.struct(F.lit(n_).alias("area"), F.col(c).alias("score"))) for c, n_ in (("u", "url"), ("t", "title"), ("e", "excerpt"))])
    return s.select(key, "id", "slug", "score", F.array_compact(parts).alias("contributions"), "blocked")


def tag_ids(details: DataFrame, key: str) -> DataFrame:
    """key, id of the tags that count."""
    return details.filter("blocked is null").select(key, "id")
