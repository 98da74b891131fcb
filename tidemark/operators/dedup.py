"""Known and repeated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def unknown(fresh: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't known. Repeats inside fresh stay. A null key is unknown."""
    return fresh.join(known.select(key).filter(F.col(key).isNotNull()).distinct(), key, "left_anti")


def first_seen(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key; a rank filter, applied before the shuffle as well."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_tm_nth", F.row_number().over(w)).filter("_tm_nth = 1").drop("_tm_nth")


def repeats(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Every row after the first of its key, with nth."""
    return df.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("nth") > 1)


def repeated_prefix(df: DataFrame, text: str, size: int = 250) -> DataFrame:
    """prefix_hash, rows: prefixes of `size` characters that two or more rows share."""
    own = df.filter(F.length(text) >= size).select(F.md5(F.substring(text, 1, size).cast("binary")).alias("prefix_hash"))
    return own.groupBy("prefix_hash").agg(F.count(F.lit(1)).alias("rows")).filter("rows >= 2")


def uncovered(live: DataFrame, stored: DataFrame) -> DataFrame:
    """Live (source_id, url_hash, url) rows that the store lacks. Repeats inside live stay. A null hash is lacking."""
    return live.join(stored.select("source_id", "url_hash").distinct(), ["source_id", "url_hash"], "left_anti")


def coverage_gap(live: DataFrame, stored: DataFrame) -> DataFrame:
    """What the store lacks, once for each source and address."""
    return uncovered(live, stored).dropDuplicates(["source_id", "url"])


def systematic(df: DataFrame, order: str, wanted: int) -> DataFrame:
    """Every floor(rows / wanted)-th row by `order`. Ranks come from ranges: each row's range is a value of its own, found once
    from the ranges' bounds, so that both uses of it agree whatever partitions the executors coalesce."""
    n = df.count()
    step = max(1, n // max(1, wanted))
    parts = max(1, min(4096, n // 100_000))
    # bounds from about 10,000 rows by hash: they only balance the ranges, whatever the column's type
    few = sorted(r[0] for r in df.select(order).filter(F.col(order).isNotNull() & (F.pmod(F.xxhash64(order), F.lit(max(1, n // 10_000))) == 0)).distinct().collect()) if parts > 1 else []
    bounds = [few[k * len(few) // parts] for k in range(1, parts)] if len(few) >= parts else few
    own = df.withColumn("_tm_p", F.size(F.filter(F.lit(bounds or []).cast(f"array<{dict(df.dtypes)[order]}>"), lambda b: b < F.col(order))))
    base = own.groupBy("_tm_p").count().withColumn("_tm_b", F.coalesce(F.sum("count").over(Window.orderBy("_tm_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("count")
    own = own.withColumn("_tm_i", F.row_number().over(Window.partitionBy("_tm_p").orderBy(order)) - 1)
    return own.join(F.broadcast(base), "_tm_p").filter((F.col("_tm_i") + F.col("_tm_b")) % step == 0).drop("_tm_p", "_tm_i", "_tm_b")
