"""Incremental ingest: what has landed since the last run, less what the store knows, appended to the store; and each source's state, kept as its runs come in."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.functions.text import url_hash


def stored_hashes(spark: SparkSession, store: str) -> DataFrame | None:
    """url_hash, batch, shard of the store, or None where it isn't there yet. Any other failure to read it is an error: a store that can't be read must not look empty."""
    try:
        return spark.read.option("basePath", store).schema("url_hash string, batch long, shard string").parquet(store)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def ingest(spark: SparkSession, landed: str, schema: str, store: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None, files_per_batch: int = 1000) -> StreamingQuery:
    """Reads new Parquet files under landed in batches, and appends rows whose url_hash the store lacks.

    The store lies in folders by batch and by the first two digits of the hash, so that a batch reads only the folders whose hashes it can have,
    and only the hash column of these. A batch that is repeated after a failure overwrites its own folder (batch=N), so that rows are written
    once. A store that can't be read, other than for not being there yet, fails the batch and nothing is written. Rows of one batch that share
    a hash are all kept, as are rows without a URL.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(landed)

    def write(batch: DataFrame, number: int) -> None:
        s = batch.sparkSession
        fresh = batch.withColumn("url_hash", url_hash(F.col("url"))).withColumn("shard", F.coalesce(F.substring("url_hash", 1, 2), F.lit("none")))
        known = stored_hashes(s, store)
        if known is not None:
            shards = [r[0] for r in fresh.select("shard").distinct().collect()]  # 257 at most
            known = known.filter((F.col("batch") != number) & F.col("shard").isin(shards))
            fresh = fresh.join(known.select("url_hash").distinct(), "url_hash", "left_anti")
        out = transform(fresh) if transform else fresh
        out.repartition("shard").write.mode("overwrite").partitionBy("shard").parquet(f"{store}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


STATE = "source_id string, runs long, zero_streak long, error_streak long, peak_found boolean, last_started timestamp"


def track_sources(runs: DataFrame) -> DataFrame:
    """A stream of runs (source_id string, started_at timestamp, status string, found long) -> STATE, a row for each source in each batch that has runs of it: how
    long it has found nothing or failed, up to its newest run, and whether it ever found anything. Runs older than the newest seen only count."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, zero, errors, peak, last = state.get if state.exists else (0, 0, 0, False, pd.Timestamp(0))
        rows = pd.concat(list(frames)).sort_values("started_at", kind="stable")
        for at, status, found in zip(rows["started_at"], rows["status"], rows["found"].fillna(0), strict=True):
            n, peak = n + 1, peak or found > 0
            if at >= last:
                zero, errors, last = (zero + 1 if found == 0 else 0), (errors + 1 if status == "error" else 0), at
        state.update((n, zero, errors, bool(peak), last))
        yield pd.DataFrame([(key[0], n, zero, errors, bool(peak), last)], columns=[c.split()[0] for c in STATE.split(", ")])

    return runs.groupBy("source_id").applyInPandasWithState(step, STATE, "runs long, zero long, errors long, peak boolean, last timestamp", "update", GroupStateTimeout.NoTimeout)
