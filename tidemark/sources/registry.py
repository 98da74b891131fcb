"""Sources by their settings: which are due, which job group's turn it is, and how each landed payload becomes rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.monitor import due
from tidemark.operators.outcomes import limit_each, rotated
from tidemark.sources import feeds, pages

CONFIG = "source_id string, enabled boolean, runner string, mode string, url string, url_pattern string, selector string, max_items int, jobs array<array<string>>, last_group int, last_scraped_at timestamp, scrape_interval_minutes int"


def chosen(sources: DataFrame, now: Column, runner: str | None = None, force: bool = False) -> DataFrame:
    """Enabled sources that are due, of one runner where sources have runners (a source without one belongs to any), with the job group whose turn it is (jobs_now)."""
    x = due(sources, now, force)
    if runner is not None and "runner" in x.columns:
        x = x.filter(F.col("runner").isNull() | (F.col("runner") == runner))
    return x.withColumn("jobs_now", rotated(F.col("jobs"), F.col("last_group"))) if "jobs" in x.columns else x


def _items(p: DataFrame) -> DataFrame:
    return feeds.feed_items(p.select(F.col("source_id").alias("feed_url"), "payload")).select(F.col("feed_url").alias("source_id"), F.col("link").alias("url"), "title", "excerpt", F.col("published").alias("raw_label"), "image")


def _posts(p: DataFrame) -> DataFrame:
    return feeds.posts(p.select(F.col("source_id").alias("site"), "payload")).select(F.col("site").alias("source_id"), F.col("link").alias("url"), "title", "excerpt", F.col("published_at").alias("raw_label"))


def _sitemap(p: DataFrame) -> DataFrame:
    return feeds.sitemap_entries(p.select(F.col("source_id").alias("sitemap_url"), "payload")).select(F.col("sitemap_url").alias("source_id"), F.col("loc").alias("url"), F.col("lastmod").cast("string").alias("raw_label"), F.col("nth").alias("position"))


def _links(p: DataFrame) -> DataFrame:
    k = p.select(F.struct("source_id", F.col("url").alias("base")).alias("k"), F.col("payload").alias("html"), "url")
    return pages.rows_of(k, "k", "html", "position int, link string, title string", pages.listing_links, "url").select("k.source_id", F.col("link").alias("url"), "title", "position")


def _cards(p: DataFrame) -> DataFrame:
    k = p.select("source_id", F.col("payload").alias("html"), "url")
    return pages.rows_of(k, "source_id", "html", pages.CARD, pages.card_rows, "url").select("source_id", "url", "title", "excerpt", F.col("date_text").alias("raw_label"), "image", "position")


#: How each mode reads its payloads (source_id, url, payload).
MODES: dict[str, Callable[[DataFrame], DataFrame]] = {"rss": _items, "rest": _posts, "sitemap": _sitemap, "html_list": _links, "cards": _cards}


def discover(configs: DataFrame, payloads: DataFrame) -> DataFrame:
    """source_id, path (the mode), url, title, excerpt, raw_label, image: the rows of all sources by their own modes, cut to those whose URL matches
    url_pattern and to max_items a source (15 where it isn't set), the first of each address. payloads: source_id, url, payload."""
    x = payloads.join(configs.select("source_id", "mode"), "source_id")
    parts = {m: read(x.filter(F.col("mode") == m)) for m, read in MODES.items()}
    rows = feeds.union_sources(parts).join(configs.select("source_id", "url_pattern", "max_items"), "source_id")
    rows = rows.filter(F.col("url_pattern").isNull() | F.regexp_like("url", F.coalesce("url_pattern", F.lit(""))))
    rows = rows.withColumn("position", F.coalesce("position", F.lit(1 << 30))).withColumn("_key", F.concat_ws(" ", "source_id", "url"))
    first = limit_each(rows, "_key", ["position", "title"], 1)
    w = Window.partitionBy("source_id").orderBy("position", "url")
    kept = first.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= F.coalesce("max_items", F.lit(15)))
    return kept.select("source_id", "path", "url", "title", "excerpt", "raw_label", "image")
