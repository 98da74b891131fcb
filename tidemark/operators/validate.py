"""Data-quality rules R1 to R15 over the outcomes of a dry run, as one frame of violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import month_number
from tidemark.functions.lexicons import EDGE, LANDING, MONTHS
from tidemark.functions.text import last_segment


ZONED = r"T[0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]+)?)?(?:[-+][0-9]{2}:?[0-9]{2}|Z)\z"
_MON = "(" + "|".join(m.title() for m in MONTHS) + ")"
DISCOVERY = ["rss_pubdate", "sitemap_lastmod"]


def label_day(raw: Column) -> Column:
    """yyyy-mm-dd as the label writes it ('29 May 2026', 'May 29, 2026' or ISO), taken from its parts and never through a time zone; or null."""
    e = EDGE
    forms = [(rf"{e}(\d{{1,2}})\s+{_MON}[a-z]*\.?\s+(\d{{4}}){e}", (3, 2, 1)), (rf"{e}{_MON}[a-z]*\.?\s+(\d{{1,2}}),?\s+(\d{{4}}){e}", (3, 1, 2))]
    out = F.lit(None).cast("string")
    for p, (y, m, d) in reversed(forms):
        got = F.concat_ws("-", F.regexp_extract(raw, p, y), F.lpad(month_number(F.regexp_extract(raw, p, m)).cast("string"), 2, "0"), F.lpad(F.regexp_extract(raw, p, d), 2, "0"))
        out = F.when(raw.rlike(p), got).otherwise(out if p != forms[-1][0] else F.nullif(F.regexp_extract(raw, rf"{e}(\d{{4}}-\d{{2}}-\d{{2}}){e}", 1), F.lit("")))
    return out


def iso_day(iso: Column) -> Column:
    return F.nullif(F.regexp_extract(iso, r"^(\d{4}-\d{2}-\d{2})", 1), F.lit(""))


def utc_day(raw: Column) -> Column:
    """The UTC day of an ISO time with a zone, else null."""
    t = F.trim(raw)
    return F.when(t.rlike(ZONED), F.date_format(F.try_to_timestamp(F.regexp_replace(t, r"([+-]\d{2})(\d{2})\z", "$1:$2")), "yyyy-MM-dd"))


def parseable(url: Column) -> Column:
    """Whether a URL has a scheme and, where its scheme wants one, a host."""
    u = F.trim(F.coalesce(url, F.lit("")))
    web = u.rlike(r"(?i)^(?:https?|ftp|wss?):")
    return F.when(web, u.rlike(r"(?i)^[a-z]+:[/\\]*[^/\\\s?#]")).otherwise(u.rlike(r"(?i)^[a-z][a-z0-9+.\-]*:"))


def violations(outcomes: DataFrame, now: Column, landing: list[str] = LANDING) -> DataFrame:
    """rule, idx, url. outcomes: idx, decision, detected_url, date_signals (array, the chosen one first), raw_label, parsed (the
    outcome's date), and the proposed record's url, title, source_id, url_hash, published, confidence and excerpt (no record: all null).

    R11 looks at every outcome and R12 at every record, the others at would_insert. A missing record is R1 and nothing else. Rules that
    compare outcomes with each other count hashes and prefixes of the rows at stake first (partial sums before the shuffle), so that no group meets in one task.
    """
    ins = F.col("decision") == "would_insert"
    empty = F.col("title").isNull() & F.col("url").isNull() & F.col("url_hash").isNull()
    live = ins & ~empty
    o = outcomes.withColumn("_prefix", F.when(live & (F.length("excerpt") >= 250), F.md5(F.substring("excerpt", 1, 250).cast("binary")))).withColumn("_hash", F.when(live, F.nullif("url_hash", F.lit(""))))
    twice = o.filter("_hash is not null").groupBy("_hash").agg(F.min("idx").alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    same = o.filter("_prefix is not null").groupBy("_prefix").agg(F.count(F.lit(1)).alias("_same")).filter("_same > 1")
    o = o.join(twice, "_hash", "left").join(same, "_prefix", "left")
    sure = lambda c: F.coalesce(c, F.lit(False))
    chosen = F.try_element_at("date_signals", F.lit(1))
    has_label = F.length(F.coalesce("raw_label", F.lit(""))) > 0
    found = sure(chosen.isin(DISCOVERY)) & has_label
    zoned = sure(F.trim("raw_label").rlike(ZONED))
    rules: dict[str, Column] = {
        "R1": ins & empty, "R2": live & (F.trim(F.coalesce("title", F.lit(""))) == ""), "R3": live & ~parseable(F.col("url")), "R4": live & (F.length(F.coalesce("source_id", F.lit(""))) < 30),
        "R5": live & ~sure(F.col("url_hash").rlike("^[0-9a-f]{32}\\z")), "R6": live & ~sure(F.col("published").rlike(r"^\d{4}-\d{2}-\d{2}")), "R7": live & sure(F.try_to_timestamp("published") > now + F.expr("INTERVAL 24 HOURS")),
        "R8": live & sure(F.col("idx") > F.col("_first")), "R9": live & sure(F.array_contains("date_signals", "rss_pubdate")) & ~has_label, "R10": live & found & ~zoned & sure(label_day(F.col("raw_label")) != iso_day(F.col("published"))),
        "R11": found & sure(utc_day(F.col("raw_label")) != iso_day(F.col("parsed"))), "R12": ~empty & (F.size("date_signals") == 1) & sure(chosen == "sitemap_lastmod") & sure(F.col("confidence").isin("medium", "high")),
        "R13": F.col("_same").isNotNull(), "R14": live & sure(last_segment(F.col("url")).isin(landing)), "R15": live & (F.length(F.coalesce("excerpt", F.lit(""))) < 400),
    }
    broken = F.array_compact(F.array(*[F.when(c, F.lit(r)) for r, c in rules.items()]))
    return o.select(F.explode(broken).alias("rule"), "idx", "url")


def failure_counts(found: DataFrame) -> DataFrame:
    """rule, failures for all fifteen rules."""
    rules = found.sparkSession.createDataFrame([(f"R{i}",) for i in range(1, 16)], "rule string")
    return rules.join(found.groupBy("rule").agg(F.count(F.lit(1)).alias("failures")), "rule", "left").select("rule", F.coalesce("failures", F.lit(0)).alias("failures"))
