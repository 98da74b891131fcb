"""Mixing sources to target weights by Poisson replication.

A source's documents repeat at the rate target bytes / own bytes. Each document's count is the inverse
of the Poisson distribution with that mean at a uniform number hashed from the seed and the document, so
it doesn't depend on partitions, order or retries. The copies are then spread over all partitions by
another hash and sorted by it inside each: a global shuffle in one exchange, in the JVM throughout (but for
the distributions of rates above DIRECT, one row a source).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut

BITS = 13  # hex digits of the hash in use: 52 bits
DIRECT = 700.0  # the largest mean whose terms can start from exp(-mean)


def uniform(*parts: Column) -> Column:
    """In [0, 1), from the MD5 of the parts joined by '|'."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, BITS), 16, 10).cast("double") / float(16**BITS)


def terms_for(mean: float) -> int:
    """Counts above this have a chance below 2**-60."""
    return int(mean + 12 * math.sqrt(mean) + 40)


def large_cdf(mean: float) -> tuple[int, np.ndarray]:
    """k0, and P(X <= k) for k = k0, k0 + 1, ...; below k0 the chance is less than 2**-60. The terms are taken
    from the mode outwards, relative to it."""
    mode, first = int(mean), max(0, int(mean - 12 * math.sqrt(mean) - 40))
    up = np.cumprod(mean / np.arange(mode + 1, terms_for(mean) + 1))
    down = np.cumprod(np.arange(mode, first, -1) / mean)
    p = np.concatenate((down[::-1], [1.0], up))
    return first, np.cumsum(p / p.sum())


def _large(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i, m in enumerate(b.column("rate").to_pylist()):
            first, cdf = large_cdf(m)
            yield pa.RecordBatch.from_arrays([*(b.column(c).slice(i, 1) for c in ("_tm_source", "rate")), pa.array([first], pa.int64()), pa.array([cdf], pa.list_(pa.float64()))], names=["_tm_source", "rate", "_tm_first", "cdf"])


def cdfs(rates: DataFrame) -> DataFrame:
    """_tm_source, rate -> _tm_source, rate, _tm_first, cdf: P(X <= k) for k = _tm_first, _tm_first + 1, ..., once a source."""
    top = rates.agg(F.max("rate")).first()[0] or 0.0
    small = rates.select("_tm_source", "rate", F.lit(0).cast("long").alias("_tm_first")).filter(F.col("rate") <= DIRECT)
    terms = terms_for(min(top, DIRECT))
    m = F.col("rate")
    p0 = F.exp(-m)
    grow = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.struct(p0.alias("p"), F.array(p0).alias("cdf")),
        lambda a, k: F.struct((a["p"] * m / k).alias("p"), F.concat(a["cdf"], F.array(F.element_at(a["cdf"], -1) + a["p"] * m / k)).alias("cdf")),
        lambda a: a["cdf"],
    )
    small = small.withColumn("cdf", grow)
    if top <= DIRECT:
        return small
    return small.union(rates.select("_tm_source", "rate").filter(F.col("rate") > DIRECT).mapInArrow(_large, "_tm_source string, rate double, _tm_first long, cdf array<double>"))


def rates(docs: DataFrame, weights: dict[str, float] | None, total: float = 1.0) -> DataFrame:
    """source, bytes, rate. Without weights every source gets the square root of its share.

    rate = total * all bytes * weight / sum of weights / own bytes; a source without bytes, or without
    a weight where weights are given, has rate 0.
    """
    own = docs.groupBy("_tm_source").agg(F.sum("_tm_bytes").alias("bytes"))
    if weights is None:
        w = F.sqrt(F.col("bytes").cast("double"))
    else:
        w = F.lit(0.0)
        for k, v in weights.items():
            w = F.when(F.col("_tm_source") == F.lit(k), F.lit(float(v))).otherwise(w)
    own = cut(own.withColumn("w", w))
    s = own.agg(F.sum("bytes").cast("double").alias("b"), F.sum(F.when(F.col("bytes") > 0, F.col("w"))).alias("w")).first()
    rate = F.when((F.col("bytes") > 0) & (F.lit(s["w"] or 0.0) > 0), F.lit(total) * F.lit(s["b"] or 0.0) * F.col("w") / F.lit(s["w"] or 1.0) / F.col("bytes")).otherwise(0.0)
    return cut(own.select("_tm_source", "bytes", rate.alias("rate")))


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, total: float = 1.0, seed: str = "mix-1", most_sources: int = 100_000, keep_order_columns: bool = True) -> DataFrame:
    """docs, each row as often as its count says, in random order.

    Adds copy_no (from 0) and shuffle_key (the uniform number that orders the copies), unless
    keep_order_columns is false; columns of docs by these names give way. The count is hashed from the
    seed, doc_id (or, where it is null, the text) and the text's length, so repeated rows repeat equally often. Ties in the order
    (repeated rows) are in any order. Very long texts are only measured and copied. A null source is a source
    of its own (weights can't name it: rate 0 under given weights). Null and empty texts have 0 bytes:
    they count at their source's rate; a source with no bytes at all has rate 0. An empty table gives no
    rows. Up to most_sources sources (or as many KB of distributions) the rates are broadcast; beyond, they are joined
    on source and a salt of 64, since one source can hold most rows.
    """
    names = docs.columns
    tmp = docs.toDF(*[f"_tm{i}" for i in range(len(names))])
    col = lambda c: F.col(f"_tm{names.index(c)}")
    d = tmp.withColumn("_tm_source", F.coalesce(F.concat(F.lit("="), col("source").cast("string")), F.lit("null")))
    d = d.withColumn("_tm_bytes", F.coalesce(F.octet_length(col("text")), F.lit(0)).cast("long"))
    if weights is not None:
        weights = {f"={k}": v for k, v in weights.items()}
    r = cut(cdfs(rates(d, weights, total)).select("_tm_source", "_tm_first", "cdf"))
    n, terms = r.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("cdf")), F.lit(0))).first()
    if n <= most_sources and terms <= 128 * most_sources:
        d = d.join(F.broadcast(r), "_tm_source")
    else:
        d = d.withColumn("_tm_salt", F.pmod(F.xxhash64(col("doc_id")), F.lit(64)).cast("int"))
        d = d.join(r.withColumn("_tm_salt", F.explode(F.sequence(F.lit(0), F.lit(63)))), ["_tm_source", "_tm_salt"])
    ident = F.coalesce(col("doc_id").cast("string"), F.concat(F.lit("="), F.md5(F.coalesce(col("text"), F.lit("")).cast("binary"))))
    u = uniform(F.lit(seed), ident, F.col("_tm_bytes").cast("string"))
    d = d.withColumn("_tm_u", u).withColumn("_tm_n", (F.col("_tm_first") + F.size(F.filter("cdf", lambda c: F.col("_tm_u") >= c))).cast("int"))
    d = d.filter("_tm_n > 0").withColumn("_tm_copy", F.explode(F.sequence(F.lit(0), F.col("_tm_n") - 1)))
    d = d.withColumn("_tm_key", uniform(F.lit(seed + "/order"), ident, F.col("_tm_bytes").cast("string"), F.col("_tm_copy").cast("string")))
    d = d.repartition(F.col("_tm_key")).sortWithinPartitions("_tm_key")
    keep = [F.col(f"_tm{i}").alias(c) for i, c in enumerate(names) if not keep_order_columns or c not in ("copy_no", "shuffle_key")]
    return d.select(*keep, *([F.col("_tm_copy").cast("int").alias("copy_no"), F.col("_tm_key").alias("shuffle_key")] if keep_order_columns else []))


SQL = """
WITH d AS (SELECT *, strlen(text) AS b FROM documents),
own AS (SELECT source, sum(b)::BIGINT AS bytes FROM d GROUP BY source),
tot AS (SELECT sum(bytes)::DOUBLE AS tb, sum(sqrt(bytes::DOUBLE)) AS tw FROM own),
rate AS (SELECT source, tb * sqrt(bytes::DOUBLE) / tw / bytes AS rate FROM own, tot),
terms AS (SELECT source, k, exp(-rate + k * ln(rate) - lgamma(k + 1)) AS p FROM rate, (SELECT unnest(range(0, (SELECT max(rate) + 12 * sqrt(max(rate)) + 40 FROM rate)::BIGINT)) AS k)),
cdf AS (SELECT source, list(c ORDER BY k) AS cdf FROM (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms) GROUP BY source),
u AS (SELECT d.*, ('0x' || substr(md5('mix-1|' || coalesce(doc_id::VARCHAR, '=' || md5(coalesce(text, ''))) || '|' || b), 1, 13))::UBIGINT::DOUBLE / 4503599627370496.0 AS u FROM d),
n AS (SELECT u.*, len(list_filter(cdf, lambda c: u.u >= c)) AS n FROM u JOIN cdf USING (source)),
x AS (SELECT *, unnest(range(0, n)) AS copy_no FROM n)
SELECT doc_id, text, lang, source, n_chars, copy_no::INT AS copy_no,
  ('0x' || substr(md5('mix-1/order|' || coalesce(doc_id::VARCHAR, '=' || md5(coalesce(text, ''))) || '|' || b || '|' || copy_no), 1, 13))::UBIGINT::DOUBLE / 4503599627370496.0 AS shuffle_key
FROM x
"""
