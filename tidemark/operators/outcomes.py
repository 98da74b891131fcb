"""The dry run and what follows it: one decision a row, the report, the write with its re-check and read-back, and the state of runs and sources."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import dates
from tidemark.functions.text import url_hash

THIN = 1100
#: In this order: the first that holds decides.
LADDER = ["pdf_too_large", "pdf_fetch_failed", "pdf_no_text", "paywalled_thin", "duplicate", "no_title", "no_date", "empty_body"]


def decide(items: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """items with url_hash, decision (would_insert, duplicate, rejected), reason, published_at_source and _confidence as the store writes them.

    items: url, title, excerpt, published_at, date_source, date_confidence, is_pdf, pdf_too_large, pdf_no_text, fetch_error,
    visible_length, paywalled. known: url_hash of the store.
    """
    x = items.withColumn("url_hash", url_hash(F.col("url")))
    if known is not None:
        x = x.join(known.select("url_hash", F.lit(True).alias("_dup")).distinct(), "url_hash", "left")
    else:
        x = x.withColumn("_dup", F.lit(False))
    sure = lambda c: F.coalesce(c, F.lit(False))
    conf = dates.db_confidence(F.col("date_confidence"))
    tests = [sure(F.col("pdf_too_large")), sure(F.col("is_pdf")) & F.col("fetch_error").isNotNull(), sure(F.col("pdf_no_text")), (F.coalesce("visible_length", F.lit(0)) < THIN) & sure(F.col("paywalled")), sure(F.col("_dup")),
        F.coalesce("title", F.lit("")) == "", F.col("published_at").isNull() | conf.isNull(), F.trim(F.coalesce("excerpt", F.lit(""))) == ""]
    reason = F.coalesce(*[F.when(t, F.lit(n)) for n, t in zip(LADDER, tests, strict=True)])
    x = x.withColumn("_r", reason)
    x = x.withColumn("decision", F.when(F.col("_r") == "duplicate", "duplicate").when(F.col("_r").isNotNull(), "rejected").otherwise("would_insert"))
    x = x.withColumn("reason", F.nullif("_r", F.lit("duplicate"))).withColumn("published_at_source", dates.db_provenance(F.col("date_source"))).withColumn("published_at_confidence", conf)
    return x.drop("_r", "_dup")


def report(decided: DataFrame) -> DataFrame:
    """By source: discovered, would_insert, duplicate, rejected, fetch_failed."""
    n = lambda d: F.count_if(F.col("decision") == d).alias(d)
    return decided.groupBy("source_name").agg(F.count(F.lit(1)).alias("discovered"), n("would_insert"), n("duplicate"), n("rejected"), F.count_if(F.col("fetch_error").isNotNull()).alias("fetch_failed"))


def apply_report(decided: DataFrame, store: str, audit: str, batch: str) -> dict[str, int]:
    """Appends what would be inserted and the store (Parquet, by batch) doesn't know by now, reads it back, and writes an audit row (JSON) for each
    from what was read, not from what was meant. A batch that is repeated overwrites its own folder. -> attempted, inserted, skipped, failed."""
    s = decided.sparkSession
    new = decided.filter("decision = 'would_insert'")
    attempted = new.count()
    fresh = new.dropDuplicates(["url_hash"]) if not _there(s, store) else new.dropDuplicates(["url_hash"]).join(_other_batches(s, store, batch), "url_hash", "left_anti")
    own = f"{store}/batch={batch}"
    fresh.write.mode("overwrite").parquet(own)
    back = s.read.schema("url_hash string").parquet(own).select("url_hash", F.lit(True).alias("_back")).distinct()
    seen = fresh.join(back, "url_hash", "left").select("url", "url_hash", "source_id", "title", "published_at", "published_at_source", "published_at_confidence", F.when(F.col("_back"), "inserted").otherwise("failed").alias("outcome"))
    seen.write.mode("overwrite").json(audit)
    n = {r["outcome"]: r["count"] for r in s.read.schema("outcome string").json(audit).groupBy("outcome").count().collect()}
    done, bad = n.get("inserted", 0), n.get("failed", 0)
    return {"attempted": attempted, "inserted": done, "skipped": attempted - done - bad, "failed": bad}


def _there(s, path: str) -> bool:
    try:
        s.read.parquet(path).limit(0).count()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return False
        raise  # a store that can't be read must not look empty
    return True


def _other_batches(s, store: str, batch: str) -> DataFrame:
    return s.read.option("basePath", store).schema("url_hash string, batch string").parquet(store).filter(F.col("batch") != batch).select("url_hash").distinct()


def tag_counts(bridge: DataFrame) -> DataFrame:
    """tag_id, articles from the bridge (article_id, tag_id); a repeated pair counts once."""
    return bridge.select("article_id", "tag_id").distinct().groupBy("tag_id").agg(F.count(F.lit(1)).alias("articles"))


def open_runs(sources: DataFrame, now: Column) -> DataFrame:
    """A running log row for each source."""
    return sources.select(F.concat_ws("/", F.col("source_id").cast("string"), F.unix_micros(now).cast("string")).alias("run_id"), "source_id", now.alias("started_at"), F.lit("running").alias("status"))


def close_runs(runs: DataFrame, accounts: DataFrame, now: Column) -> DataFrame:
    """Open rows with their outcome from the accounts (source_id, status, found, inserted, error); a source without one ends as an error."""
    x = runs.drop("status").join(accounts.select("source_id", "status", "found", "inserted", "error"), "source_id", "left")
    return x.withColumn("status", F.coalesce("status", F.lit("error"))).withColumn("finished_at", now)


def trace(due: DataFrame, now: Column) -> DataFrame:
    """One row for a tick with nothing due, none else."""
    return due.agg(F.count(F.lit(1)).alias("n")).filter("n = 0").select(F.lit("no-op").alias("status"), now.alias("started_at"))


def next_state(sources: DataFrame, accounts: DataFrame, now: Column) -> DataFrame:
    """sources (source_id, peak_found, last_group, last_status, last_scraped_at) after a run: the group moves on though the run failed, and peak_found stays once it is true."""
    a = accounts.select("source_id", F.col("status").alias("_s"), F.col("found").alias("_f"), F.lit(True).alias("_ran"))
    x = sources.join(a, "source_id", "left")
    ran = F.coalesce("_ran", F.lit(False))
    x = x.withColumn("peak_found", F.coalesce("peak_found", F.lit(False)) | (F.coalesce("_f", F.lit(0)) > 0)).withColumn("last_group", F.when(ran, F.coalesce("last_group", F.lit(-1)) + 1).otherwise(F.col("last_group")))
    return x.withColumn("last_status", F.when(ran, F.col("_s")).otherwise(F.col("last_status"))).withColumn("last_scraped_at", F.when(ran, now).otherwise(F.col("last_scraped_at"))).drop("_s", "_f", "_ran")


def rotated(groups: Column, last: Column) -> Column:
    """The job group whose turn it is: one of an array, by the rotation counter, whatever its sign."""
    return F.when(F.size(groups) > 0, F.element_at(groups, (F.pmod(F.coalesce(last, F.lit(0)), F.size(groups)) + 1).cast("int")))


def selected_text(title: Column, content: Column, excerpt: Column, most: int = 15) -> Column:
    """struct<text_source, content_terms, gate_reason>: terms from the first of content (4,000 characters) and excerpt that passes the gate."""
    from tidemark.operators import enrich, gates

    c, e = F.substring(F.coalesce(content, F.lit("")), 1, 4000), F.coalesce(excerpt, F.lit(""))
    rc, re_ = gates.gate_reason(title, c), gates.gate_reason(title, e)
    terms = lambda x: F.slice(gates.filter_terms(title, enrich.keywords(title, x, 45)), 1, most)
    chosen = F.when(rc.isNull(), c).when(re_.isNull(), e)
    where = F.when(rc.isNull(), "content").when(re_.isNull(), "excerpt").otherwise("none")
    return F.struct(where.alias("text_source"), F.when(where == "none", F.array().cast("array<string>")).otherwise(terms(chosen)).alias("content_terms"), F.when(where == "none", rc).alias("gate_reason"))


def limit_each(df: DataFrame, by: str, order: list, most: int) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(by).orderBy(*order))).filter(F.col("_n") <= most).drop("_n")


def bulk_insert(df: DataFrame, url: str, table: str, chunk: int = 200, properties: dict[str, str] | None = None) -> None:
    """Appends to a JDBC table, `chunk` rows a statement; a statement fails as a whole."""
    df.write.option("batchsize", chunk).jdbc(url, table, "append", properties or {})
