"""Best-fit packing with certificates: documents into fixed windows.

Documents are cut into pieces of at most a window. Partitions pack their pieces by best-fit decreasing;
dual-feasible functions give a lower bound on each partition's windows. Where count and bound agree, the
packing is proven optimal for the partition. The others (with a gap) keep their full windows and
exchange the rest: the pieces are pooled anew, by hash, in half as many partitions and packed again, as
long as that saves windows. Python sees (partition, size, count) histograms only. with_bytes gives the
placed pieces their bytes.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.binpack import best_fit_decreasing, lower_bound
from tidemark.llm.common import cut, narrow
from tidemark.llm.sharding import placed, ranked

PLAN = "part long, size long, lo long, hi long, first long, per_bin long, bins long, bound long"


def pieces(docs: DataFrame, window: int) -> DataFrame:
    """doc_id, text_md5, copy, piece, start, size: each text's bytes in runs of at most window.

    copy tells repeated doc_ids apart. A null or empty text has no pieces.
    """
    d = narrow(docs, "doc_id", "text").select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes")).filter("bytes > 0")
    d = cut(d.groupBy("doc_id", "bytes", "text_md5").agg(F.count(F.lit(1)).alias("n")))
    before = Window.partitionBy("doc_id").orderBy("bytes", "text_md5").rowsBetween(Window.unboundedPreceding, -1)
    # only ids (and the null id) with more than one text meet in a window
    several = d.groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("_several"))
    many = d.join(several, F.col("doc_id").eqNullSafe(F.col("_several")), "left_semi").withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    d = d.join(several, F.col("doc_id").eqNullSafe(F.col("_several")), "left_anti").withColumn("base", F.lit(0).cast("long")).unionByName(many)
    d = d.select("doc_id", "text_md5", "bytes", F.explode(F.sequence(F.col("base"), F.col("base") + F.col("n") - 1)).alias("copy"))
    last = F.floor((F.col("bytes") - 1) / window)
    d = d.select("doc_id", "text_md5", "copy", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
    start = F.col("piece") * window
    return d.select("doc_id", "text_md5", "copy", "piece", start.alias("start"), F.least(F.col("bytes") - start, F.lit(window)).cast("long").alias("size"))


def with_bytes(packed: DataFrame, docs: DataFrame) -> DataFrame:
    """packed with content, the piece's own bytes (binary: a piece may begin or end inside a character). Every
    piece finds its text by text_md5 and length alone, so null and repeated doc_ids do no harm; a text that many
    rows share travels once. Very long texts are cut where they lie, before anything is shuffled."""
    step = packed.agg(F.max("size")).first()[0]
    t = narrow(docs, "text").filter(F.octet_length("text") > 0).select(F.md5(F.col("text").cast("binary")).alias("text_md5"), F.col("text").cast("binary").alias("_b"))
    if step is None:
        return packed.withColumn("content", F.lit(None).cast("binary"))
    # any piece but a text's last is as long as a window, so the largest piece is a window where any text was cut
    t = t.select("text_md5", "_b", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.octet_length("_b") - 1) / step))).alias("_piece"))
    t = t.select("text_md5", "_piece", F.substring("_b", (F.col("_piece") * step + 1).cast("int"), F.lit(int(step))).alias("content")).dropDuplicates(["text_md5", "_piece"])
    return packed.join(t.select(F.col("text_md5").alias("_md5"), "_piece", "content"), (F.col("text_md5") == F.col("_md5")) & (F.col("piece") == F.col("_piece")), "left").drop("_md5", "_piece")


def pack(items: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """items with a part -> items with bin (in the part), and (part, bins, bound) of every part."""

    def run(g: pd.DataFrame) -> pd.DataFrame:
        s, n = g["size"].to_numpy(), g["n"].to_numpy()
        rows, bins = best_fit_decreasing(s, n, window)
        bound = lower_bound(s, n, window)
        return pd.DataFrame([(g["part"].iloc[0], *r, bins, bound) for r in rows], columns=["part", "size", "lo", "hi", "first", "per_bin", "bins", "bound"])

    plan = cut(items.groupBy("part", "size").agg(F.count(F.lit(1)).alias("n")).groupBy("part").applyInPandas(run, PLAN))
    hit = placed(ranked(items, ["part", "size"], "uid", 8), plan, ["part", "size"])
    hit = hit.withColumn("bin", (F.col("first") + F.floor((F.col("rank") - F.col("lo")) / F.col("per_bin"))).cast("long"))
    return hit.select(*items.columns, "bin"), plan.select("part", "bins", "bound").distinct()


def pack_documents(docs: DataFrame, window: int = 32768, part_rows: int = 50_000) -> DataFrame:
    """Every byte of every text into windows of window bytes.

    Rows: doc_id, text_md5, copy, piece, start, size (the piece is bytes start .. start + size of the text
    with that MD5), pack_id, pack_offset (where the piece begins in its window), part_packs and part_bound (windows of
    the partition that holds it, and the proven least for its pieces; equal: certified).
    Exchange ends when a round saves no window or one partition alone has a gap; so some partitions can stay
    uncertified, and part_packs and part_bound say by how much.
    copy numbers the rows that share a doc_id, by length (0 where ids are unique; null ids share one).
    Repeated rows are packed each. Very long texts fill as many windows as they need.
    Null and empty texts have nothing to pack and no rows. Other columns are ignored. Sizes that tie are
    taken in the order of a hash of the piece. An empty table gives no rows.
    """
    items = pieces(docs, window).withColumn("uid", F.concat_ws("/", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "copy", "piece", "text_md5"))
    items = cut(items)
    parts = max(1, -(-items.count() // part_rows))
    part = lambda salt, n: F.pmod(F.xxhash64("uid", F.lit(salt)), F.lit(n)).cast("long")
    done: list[DataFrame] = []
    now, stats = pack(items.withColumn("part", part(0, parts)), window)
    now = cut(now)
    salt = 0
    while True:
        salt += 1
        gaps = stats.filter("bins > bound").count()
        if gaps < 2:  # one alone has nobody to exchange with
            break
        ids = stats.filter("bins > bound").select("part")
        loose_bins = cut(now.join(ids, "part", "left_semi").groupBy("part", "bin").agg(F.sum("size").alias("fill")).filter(F.col("fill") < window).select("part", "bin"))
        loose = now.join(loose_bins, ["part", "bin"], "left_semi").drop("part", "bin")
        again, found = pack(loose.withColumn("part", part(salt, gaps // 2)), window)
        if found.agg(F.sum("bins")).first()[0] >= loose_bins.count():
            break
        done.append(cut(now.join(loose_bins, ["part", "bin"], "left_anti")))
        now, stats = cut(again), found
    # what settled early is certified: whole partitions without a gap, and full windows
    rows = now.withColumn("round", F.lit(len(done)))
    for k, x in enumerate(done):
        rows = rows.unionByName(x.withColumn("round", F.lit(k)))
    per = rows.groupBy("round", "part").agg(F.max("bin").alias("top"), F.countDistinct("bin").alias("part_packs"))
    per = per.join(stats.select(F.lit(len(done)).alias("round"), "part", "bound"), ["round", "part"], "left")
    earlier = Window.orderBy("round", "part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    per = per.select("round", "part", "part_packs", F.coalesce("bound", "part_packs").alias("part_bound"), F.coalesce(F.sum(F.col("top") + 1).over(earlier), F.lit(0)).alias("shift"))
    rows = rows.join(per, ["round", "part"]).withColumn("pack_id", F.col("shift") + F.col("bin"))
    at = Window.partitionBy("pack_id").orderBy(F.desc("size"), "uid").rowsBetween(Window.unboundedPreceding, -1)
    return rows.select("doc_id", "text_md5", "copy", "piece", "start", "size", "pack_id", F.coalesce(F.sum("size").over(at), F.lit(0)).alias("pack_offset"), "part_packs", "part_bound")
