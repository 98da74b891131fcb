"""Sharding: indivisible groups into the fewest fixed-capacity shards by best-fit decreasing.

One global packing, not one a partition: groups are aggregated where they lie, the (size, count)
histogram goes to a single task that packs it exactly (binpack.best_fit_decreasing; its input follows
the number of distinct sizes, at most the capacity), and the plan comes back to the groups as a join on
(size, block of ranks). Ranks are counted in salted parts of each size and a block has BLOCK ranks at most, so a
frequent size doesn't meet in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.binpack import best_fit_decreasing
from tidemark.llm.common import cut, narrow

PLAN = "part long, size long, lo long, hi long, first long, per_bin long"
BLOCK = 1 << 16


def plan_of(capacity: int):
    """Packs histograms of (part, size, n), each batch of rows a whole one."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = [f for f in frames if len(f)]
        if not whole:
            return
        x = pd.concat(whole)
        for part, g in x.groupby("part"):
            rows, _ = best_fit_decreasing(g["size"].to_numpy(), g["n"].to_numpy(), capacity)
            yield pd.DataFrame([(part, *r) for r in rows], columns=["part", "size", "lo", "hi", "first", "per_bin"])

    return run


def ranked(items: DataFrame, keys: list[str], order: str, salts: int = 64) -> DataFrame:
    """items with rank: 0, 1, ... within equal keys, by salt and then order. order must be unique."""
    salted = items.withColumn("salt", F.pmod(F.xxhash64(order), F.lit(salts)).cast("int"))
    before = Window.partitionBy(*keys).orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = salted.groupBy(*keys, "salt").count().withColumn("base", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    within = Window.partitionBy(*keys, "salt").orderBy(order)
    return salted.withColumn("rank", F.row_number().over(within) - 1).join(base, [*keys, "salt"]).withColumn("rank", F.col("rank") + F.col("base")).drop("salt", "base")


def placed(items: DataFrame, plan: DataFrame, keys: list[str]) -> DataFrame:
    """items (with rank) with first, per_bin and lo of the plan's row of their keys that holds their rank. Both
    sides meet on a block of ranks as well as on the keys."""
    p = plan.select(*[F.col(k).alias("_p" + k) for k in keys], "lo", "hi", "first", "per_bin")
    p = p.withColumn("_pblock", F.explode(F.sequence(F.floor(F.col("lo") / BLOCK), F.floor((F.col("hi") - 1) / BLOCK))))
    on = [F.col(k) == F.col("_p" + k) for k in keys] + [F.floor(F.col("rank") / BLOCK) == F.col("_pblock"), F.col("rank") >= F.col("lo"), F.col("rank") < F.col("hi")]
    return items.join(p, on).drop("_pblock", *["_p" + k for k in keys])


def shard_groups(groups: DataFrame, capacity: int) -> DataFrame:
    """(group_key, size) rows, group_key unique and not null -> group_key, size, shard_id, oversized.

    A size under 0 or null counts as 0. A group larger than the capacity has a shard of its own and is
    marked oversized. Groups of size 0 go to the fullest shard. Equal sizes are taken in the order of a
    salt and the key, so repeated runs agree. No groups: no rows.
    """
    g = groups.select("group_key", F.greatest(F.coalesce(F.col("size"), F.lit(0)), F.lit(0)).cast("long").alias("size"))
    g = cut(g)
    hist = g.groupBy("size").agg(F.count(F.lit(1)).alias("n")).select(F.lit(0).cast("long").alias("part"), "size", "n")
    plan = hist.repartition(1).mapInPandas(plan_of(capacity), PLAN).drop("part")
    r = ranked(g, ["size"], "group_key")
    hit = placed(r, plan, ["size"])
    return hit.select("group_key", "size", (F.col("first") + F.floor((F.col("rank") - F.col("lo")) / F.col("per_bin"))).cast("long").alias("shard_id"), (F.col("size") > capacity).alias("oversized"))


def shard_documents(docs: DataFrame, capacity: int = 8 << 20) -> DataFrame:
    """Documents into shards of at most capacity text bytes, exact copies of a text always together.

    Rows: doc_id, group_key, group_bytes, shard_id, oversized, one for each row of docs.
    A group is a text's copies (its MD5 is the key; "" is a text, of size 0); its size is the bytes of
    all its copies. A null text is a group of its own, of size 0, keyed by doc_id; rows with null text
    and the same doc_id (null included) are one group. Repeated rows count as copies. Other columns are
    ignored. Very long texts are one group each, by length alone. An empty table gives no rows.
    """
    d = narrow(docs, "doc_id", "text").select(
        "doc_id",
        F.coalesce(F.md5(F.col("text").cast("binary")), F.concat(F.lit("null:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("group_key"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"),
    )
    d = cut(d)
    s = shard_groups(d.groupBy("group_key").agg(F.sum("bytes").alias("size")), capacity)
    return d.join(s, "group_key").select("doc_id", "group_key", F.col("size").alias("group_bytes"), "shard_id", "oversized")
