"""Health of sources from their run logs. Logs: source_id, run_id, started_at, status, found, new, error.

All windows are by source, and run over rows that are first cut to the latest `last` of each source
(a rank filter that Spark applies before the shuffle), so a source's full history is never sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.dedup import coverage_gap


def newest_first():
    return Window.partitionBy("source_id").orderBy(F.desc("started_at"), F.desc("run_id"))


def latest(logs: DataFrame, last: int = 20) -> DataFrame:
    """The latest runs of each source, with nth from 1."""
    return logs.withColumn("nth", F.row_number().over(newest_first())).filter(F.col("nth") <= last)


def upper_median(x: Column) -> Column:
    """The upper of two middle values; 0 without values."""
    s = F.sort_array(F.collect_list(x))
    return F.when(F.size(s) == 0, F.lit(0).cast("double")).otherwise(F.element_at(s, F.floor(F.size(s) / 2).cast("int") + 1).cast("double"))


def baselines(logs: DataFrame, last: int = 20) -> DataFrame:
    """By source over its latest runs: runs, found_sum, new_sum, reject_runs, median_found, zero_streak,
    error_streak, latest_two_max, last_started."""
    t = latest(logs, last)
    streak = lambda bad: F.coalesce(F.min(F.when(~bad, F.col("nth"))) - 1, F.count(F.lit(1)))
    return t.groupBy("source_id").agg(
        F.count(F.lit(1)).alias("runs"), F.sum("found").alias("found_sum"), F.sum("new").alias("new_sum"), F.count_if(F.lower(F.coalesce("error", F.lit(""))).contains("reject")).alias("reject_runs"),
        upper_median(F.col("found")).alias("median_found"), streak(F.col("found") == 0).alias("zero_streak"), streak(F.col("status") == "error").alias("error_streak"),
        F.max(F.when(F.col("nth") <= 2, F.col("found"))).alias("latest_two_max"), F.max("started_at").alias("last_started"),
    )


def publish_cadence(articles: DataFrame, now: Column, last: int = 120) -> DataFrame:
    """By source, over its latest `last` real dates (published_at up to now, where published_at_source, if it is a column, isn't scraper_default): dates, days,
    median_gap, threshold (days), newest, stale (days since the newest are above it; null under four dates)."""
    a = articles.filter(F.col("published_at").isNotNull() & (F.col("published_at") <= now))
    if "published_at_source" in a.columns:
        a = a.filter(F.col("published_at_source") != "scraper_default")
    nth = F.row_number().over(Window.partitionBy("source_id").orderBy(F.desc("published_at")))
    a = a.select("source_id", "published_at").withColumn("nth", nth).filter(F.col("nth") <= last)
    days = a.groupBy("source_id", F.to_date("published_at").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.max("published_at").alias("newest"))
    w = Window.partitionBy("source_id").orderBy("day")
    g = days.withColumn("gap", F.datediff("day", F.lag("day").over(w)))
    out = g.groupBy("source_id").agg(F.sum("n").alias("dates"), F.count(F.lit(1)).alias("days"), upper_median(F.col("gap")).alias("median_gap"), F.max("newest").alias("newest"))
    cadence = F.greatest(F.lit(3.0), F.least(F.lit(365.0), F.col("median_gap") * 3))
    out = out.withColumn("threshold", F.when(F.col("days") < 6, F.greatest(F.lit(60.0), cadence)).otherwise(cadence))
    return out.withColumn("stale", F.when(F.col("dates") >= 4, hours_between("newest", now) / 24.0 > F.col("threshold")))


def hours_between(before, after: Column) -> Column:
    return (F.unix_micros(after) - F.unix_micros(before)).cast("double") / 3_600_000_000.0


CRITICAL = ["ERROR_STREAK", "SILENT", "FOUND_COLLAPSE", "FEED_LAG", "FEED_STALE", "BASE_STALE", "MISSING_SOURCE"]


def flags(logs: DataFrame, articles: DataFrame, now: Column, live: DataFrame | None = None, sources: DataFrame | None = None, stale_days: int = 14, found_least: int = 5, lag_hours: float = 12.0, uncaptured_least: int = 3, last: int = 20) -> DataFrame:
    """source_id, the baselines, no_recent, peak_found, feed_lag, uncaptured, flags (every alarm of a source, in a fixed order) and bucket, the first
    report part that fits: critical, chronic, gaps or none.

    articles: source_id, published_at; created_at (the time of capture, which tells where there are under four dates; without it the
    newest date does), published_at_source and url_hash where they are there. live: source_id, url, url_hash, published_at of what sources
    show now. sources: source_id, peak_found (without it: any run that found something).
    """
    b = baselines(logs, last).join(publish_cadence(articles, now).select("source_id", "stale", "newest"), "source_id", "left")
    if "created_at" in articles.columns:
        b = b.join(articles.groupBy("source_id").agg(F.max("created_at").alias("captured")), "source_id", "left")
    else:
        b = b.withColumn("captured", F.col("newest"))
    b = b.withColumn("no_recent", F.coalesce("stale", F.coalesce(F.floor(hours_between("captured", now) / 24.0 + 0.5), F.lit(999)) > stale_days))
    peak = sources.select("source_id", "peak_found") if sources is not None else logs.groupBy("source_id").agg(F.max(F.col("found") > 0).alias("peak_found"))
    b = b.join(peak, "source_id", "left").withColumn("peak_found", F.coalesce("peak_found", F.lit(False)))
    if live is not None:
        shown = live.groupBy("source_id").agg(F.max("published_at").alias("shown"))
        gap = coverage_gap(live, articles).groupBy("source_id").agg(F.count("url").alias("uncaptured"))
        b = b.join(shown, "source_id", "left").join(gap, "source_id", "left").withColumn("uncaptured", F.coalesce("uncaptured", F.lit(0).cast("long"))).withColumn("feed_lag", hours_between("newest", F.col("shown"))).drop("shown")
    else:
        b = b.withColumn("uncaptured", F.lit(0).cast("long")).withColumn("feed_lag", F.lit(None).cast("double"))
    m = F.col("median_found")
    chronic = (F.col("found_sum") >= 20) & (F.col("new_sum") <= 2) & (F.col("reject_runs") >= 3)
    silent = F.col("no_recent") & (m == 0) & (F.col("runs") >= 4)
    collapse = F.col("no_recent") & (m >= found_least) & (F.col("runs") >= 2) & (F.col("latest_two_max") < F.greatest(F.lit(2.0), m * 0.3))
    dead = (F.col("zero_streak") >= 10) & F.col("peak_found")
    when = lambda c, name: F.when(c, F.lit(name))
    own = F.array_compact(F.array(when(F.col("error_streak") >= 3, "ERROR_STREAK"), when(dead, "SILENT_DEATH"), F.when(silent, "SILENT").when(collapse, "FOUND_COLLAPSE"), when(chronic, "CHRONIC_REJECTION"), when(F.col("feed_lag") > lag_hours, "FEED_LAG"), when(F.col("uncaptured") >= uncaptured_least, "UNCAPTURED_ITEMS")))
    return b.withColumn("own", own).withColumn("flags", F.array_join("own", ",")).withColumn("bucket", bucket(F.col("own"))).drop("own", "stale", "newest", "captured")


def bucket(own: Column) -> Column:
    """The report part of a row's flags."""
    return F.when(F.arrays_overlap(own, F.lit(CRITICAL)), "critical").when(F.array_contains(own, "CHRONIC_REJECTION"), "chronic").when(F.array_contains(own, "UNCAPTURED_ITEMS"), "gaps").otherwise("none")


def site_freshness(site: DataFrame, articles: DataFrame, now: Column, feed_hours: float = 4.0, base_days: float = 9.0) -> DataFrame:
    """site (one row): newest (the newest date on the site, null: none) and base_built (null: unknown) -> feed_lag in hours, base_age in days, flags.
    The store's newest date is that of visible or pending articles with a date of their own, up to now."""
    ok = F.col("content_quality").isin("visible", "pending") & (F.col("published_at_source") != "scraper_default") & (F.col("published_at") <= now)
    newest = articles.filter(ok).agg(F.max("published_at").alias("stored"))
    x = site.crossJoin(F.broadcast(newest))  # one row each
    lag, age = hours_between("newest", F.col("stored")), hours_between("base_built", now) / 24.0
    stale = F.when(F.col("newest").isNull(), F.col("stored").isNotNull()).otherwise(F.coalesce(lag > feed_hours, F.lit(False)))
    own = F.array_compact(F.array(F.when(stale, F.lit("FEED_STALE")), F.when(age > base_days, F.lit("BASE_STALE"))))
    return x.select(lag.alias("feed_lag"), age.alias("base_age"), F.array_join(own, ",").alias("flags"))


def due(sources: DataFrame, now: Column, force: bool = False) -> DataFrame:
    """Enabled sources never read, or read at least 0.8 of their interval ago."""
    minutes = (F.unix_micros(now) - F.unix_micros("last_scraped_at")).cast("double") / 60_000_000.0
    return sources.filter(F.col("enabled") & (F.lit(force) | F.col("last_scraped_at").isNull() | (minutes >= F.col("scrape_interval_minutes") * F.lit(0.8))))


def heartbeat(logs: DataFrame, now: Column, hours: float = 6.0) -> DataFrame:
    """One row: last_ok, hours_since (null: never) and alarm."""
    x = logs.filter(F.col("status").isin("success", "partial")).agg(F.max("started_at").alias("last_ok"))
    since = (F.unix_micros(now) - F.unix_micros("last_ok")).cast("double") / 3_600_000_000.0
    return x.withColumn("hours_since", since).withColumn("alarm", since.isNull() | (since > hours))


def repair_stuck(logs: DataFrame, now: Column, minutes: int = 30) -> tuple[DataFrame, DataFrame]:
    """logs with stuck runs closed as errors, and the sources (source_id) that they block."""
    old = (F.col("status") == "running") & (F.unix_micros(now) - F.unix_micros("started_at") > minutes * 60_000_000)
    fixed = logs.withColumn("error", F.when(old, F.lit("timed out: still running")).otherwise(F.col("error"))).withColumn("status", F.when(old, F.lit("error")).otherwise(F.col("status")))
    return fixed, stuck(logs, now, minutes).select("source_id").distinct()


def stuck(logs: DataFrame, now: Column, minutes: int = 30) -> DataFrame:
    return logs.filter((F.col("status") == "running") & (F.unix_micros(now) - F.unix_micros("started_at") > minutes * 60_000_000))


def transition(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """key, state: newly, persisting or recovered."""
    a = before.select(key).distinct().withColumn("was", F.lit(True))
    b = after.select(key).distinct().withColumn("is", F.lit(True))
    return a.join(b, key, "full_outer").select(key, F.when(F.col("was").isNull(), "newly").when(F.col("is").isNull(), "recovered").otherwise("persisting").alias("state"))


def run_status(found: Column, inserted: Column, ai_errors: Column, peak_found: Column) -> Column:
    return F.when(found > 0, F.when((ai_errors > 0) & (inserted > 0), "partial").otherwise("success")).when(peak_found, "empty").otherwise("unknown")


def date_integrity(articles: DataFrame, seconds: int = 600) -> DataFrame:
    """Visible articles whose date is the time of the scrape."""
    near = F.abs(F.unix_micros("published_at") - F.unix_micros("created_at")) < seconds * 1_000_000
    return articles.filter((F.col("content_quality").isNull() | F.col("content_quality").isin("visible", "pending")) & (F.col("published_at_source") == "scraper_default") & near)
