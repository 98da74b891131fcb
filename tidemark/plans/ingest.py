"""The row pipeline: fresh rows to accepted and rejected ones, and the account of the run, in one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import fallback_date
from tidemark.functions.text import summary, url_hash
from tidemark.operators import enrich, gates
from tidemark.operators.monitor import run_status


def sift(raw: DataFrame, known: DataFrame | None = None, now: Column | None = None) -> DataFrame:
    """raw: source_id, source_name, url, title, excerpt, published_at, category_hint, trust. Each row with its
    hash, outcome (inserted, duplicate, rejected_quality, rejected_no_date) and reason. Where raw has require_date, sources
    can do without a date; with now and a column date_fallback they can infer it (a source that infers and can't drops the row)."""
    x = raw.withColumn("url_hash", url_hash(F.col("url")))
    if known is not None:
        x = x.join(known.select("url_hash", F.lit(True).alias("is_known")).distinct(), "url_hash", "left")
    else:
        x = x.withColumn("is_known", F.lit(None).cast("boolean"))
    t, e = F.col("title"), F.col("excerpt")
    x = x.withColumn("reason", gates.article_reason(t, e, F.col("url")))
    if now is not None:  # sources that take a date from the title, or the time of capture, where a row has none
        back = fallback_date(t, now)
        use = F.col("published_at").isNull() & F.coalesce("date_fallback", F.lit(False))
        x = x.withColumn("published_at_source", F.when(use & back.isNotNull(), "scraper_default")).withColumn("published_at_confidence", F.when(use & back.isNotNull(), "low"))
        x = x.withColumn("published_at", F.when(use, back["at"].cast(dict(raw.dtypes)["published_at"])).otherwise(F.col("published_at")))
    optional = F.lit(False)
    if "require_date" in raw.columns:
        optional = ~F.coalesce("require_date", F.lit(True))
        if "date_fallback" in raw.columns:
            optional = optional & ~F.coalesce("date_fallback", F.lit(False))
    undated = F.col("published_at").isNull() & ~optional
    x = x.withColumn("outcome", F.when(F.col("is_known"), "duplicate").when(F.col("reason").isNotNull(), "rejected_quality").when(undated, "rejected_no_date").otherwise("inserted"))
    return x.drop("is_known")


def judge(raw: DataFrame, known: DataFrame | None = None, now: Column | None = None) -> DataFrame:
    """sift, and the derived columns: category, document_type, segments, content_quality, summary."""
    t, e = F.col("title"), F.col("excerpt")
    x = sift(raw, known, now)
    x = x.withColumn("category", enrich.category(t, e, F.col("category_hint"))["slug"])
    x = x.withColumn("document_type", enrich.document_type(F.col("category_hint"), F.col("source_name"), F.col("category"), t, e))
    x = x.withColumn("segments", enrich.segments(t, e, F.col("category"), F.col("source_name")))
    m = gates.moderate(t, e)
    x = x.withColumn("content_quality", gates.visibility(m["decision"], F.col("trust")))
    return x.withColumn("summary", summary(e))


def account(judged: DataFrame, peak_found: bool = True) -> DataFrame:
    """By source: what was found and where it went; unexplained is 0 unless rows got lost. Columns insert_failed and ai_error (boolean), where judged has
    them, tell rows that the store refused and rows whose model call failed."""
    flag = lambda c: F.coalesce(F.col(c), F.lit(False)) if c in judged.columns else F.lit(False)
    kept = (F.col("outcome") == "inserted") & ~flag("insert_failed")
    n = lambda o: F.count_if(F.col("outcome") == o)
    a = judged.groupBy("source_id").agg(
        F.count(F.lit(1)).alias("found"), F.count_if(kept).alias("inserted"), n("duplicate").alias("duplicates"), n("rejected_quality").alias("rejected_quality"), n("rejected_no_date").alias("rejected_no_date"),
        F.count_if((F.col("outcome") == "inserted") & flag("insert_failed")).alias("insert_failed"), F.count_if((F.col("outcome") == "inserted") & flag("ai_error")).alias("ai_errors"),
    )
    a = a.withColumn("unexplained", F.col("found") - F.col("inserted") - F.col("duplicates") - F.col("rejected_quality") - F.col("rejected_no_date") - F.col("insert_failed"))
    return a.withColumn("status", run_status(F.col("found"), F.col("inserted"), F.col("ai_errors"), F.lit(peak_found)))
