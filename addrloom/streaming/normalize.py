"""The normalisation job on a stream of feature files.

Micro-batches take the place of buffers and queues: ``max_files`` bounds what one batch reads, the
checkpoint replays a batch that broke, and every batch writer replaces its own output when its
batch runs again. Output is named after the query and the batch, so neither a restart on the same
checkpoint nor another query with the same target replaces rows that it did not write itself.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from addrloom.operators.tables import (
    OUTPUT_COLUMN,
    Sink,
    absent_rows,
    output_rows,
    read_or_empty,
    stage,
    write_csv,
)
from addrloom.operators.records import plausible, with_canonical
from addrloom.operators.tagging import with_structured_tags
from addrloom.plans.normalize import Tagger, canonical_rows, checked_records
from addrloom.session import tune
from addrloom.sources.geojson import stream_features

log = logging.getLogger(__name__)

# Seconds between status lines by default, and the least that is used.
STATUS_SECONDS = 5.0
LEAST_STATUS_SECONDS = 0.5

# Rows and the name of their batch: the query's id and the batch number.
BatchWriter = Callable[[DataFrame, str], None]

# Parts that merged output is kept in; a batch reads only the parts that its own keys fall into.
MERGED_PARTS = 256


def batch_output(path: str) -> BatchWriter:
    """Write each batch to its own folder; duplicates across batches stay."""
    return lambda rows, batch: stage(rows, path, batch)


def csv_output(path: str) -> BatchWriter:
    """Write each batch as gzip CSV files in a folder of its own."""
    return lambda rows, batch: write_csv(output_rows(rows), f"{path.rstrip('/')}/batch_id={batch}")


def sink_output(sink: Sink) -> BatchWriter:
    """Any sink of the batch job that may see a batch again, such as the merging table sink."""
    return lambda rows, batch: sink(rows)


def merged_output(path: str, key: str = OUTPUT_COLUMN, *, parts: int = MERGED_PARTS) -> BatchWriter:
    """Write only rows that no other batch has written yet.

    The target is kept by ``part``, a digest of the key, so a batch reads and shuffles the parts that
    it touches and not the whole target.
    """

    def write(rows: DataFrame, batch: str) -> None:
        parted = rows.withColumn("part", F.pmod(F.xxhash64(key), F.lit(parts)).cast("int"))
        # At most ``parts`` numbers come to the driver.
        touched = [row["part"] for row in parted.select("part").distinct().collect()]
        schema = parted.withColumn("batch_id", F.lit("")).schema
        written = read_or_empty(rows.sparkSession, path, schema).where(
            F.col("part").isin(touched) & (F.col("batch_id") != batch)
        )
        new = absent_rows(parted, written, key).withColumn("batch_id", F.lit(batch))
        # Only this batch's own folders are replaced.
        new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "part", "batch_id"
        ).parquet(path)

    return write


def checked_stream(
    spark: SparkSession,
    source_path: str,
    jobs: DataFrame,
    *,
    max_files: int | None = None,
    tagger: Tagger = with_structured_tags,
) -> DataFrame:
    """Stream of checked records that reports its counters with every batch."""
    features = stream_features(tune(spark), source_path, max_files=max_files)
    checked = checked_records(features, jobs, tagger=tagger)
    return checked.observe(
        "checked",
        F.count(F.lit(1)).alias("processed"),
        F.count_if(F.col("reason").isNotNull()).alias("invalids"),
    )


def start_normalize_stream(
    checked: DataFrame,
    write: BatchWriter,
    checkpoint: str,
    *,
    scope: str | None = "batch",
    until_done: bool = True,
) -> StreamingQuery:
    """Run checked records to a batch writer, duplicates removed within each micro-batch.

    ``checkpoint`` is a folder that outlives the run: a start on the same one goes on where the last
    run ended, and a batch that broke is written again in place. ``until_done`` takes the files that are there, writes the last batch and ends; otherwise the
    query keeps waiting for new files.
    """

    # A micro-batch is the batch, so the whole-frame distinct is the per-batch one.
    return _start(
        checked,
        lambda batch: canonical_rows(batch, scope=None if scope is None else "global"),
        write,
        checkpoint,
        until_done,
    )


def _start(
    rows: DataFrame,
    of_batch: Callable[[DataFrame], DataFrame],
    write: BatchWriter,
    checkpoint: str,
    until_done: bool,
) -> StreamingQuery:
    query_id: list[str] = []

    def run(batch: DataFrame, batch_id: int) -> None:
        if not query_id:
            metadata = batch.sparkSession.read.json(f"{checkpoint.rstrip('/')}/metadata")
            query_id.append(metadata.first()["id"])
        write(of_batch(batch), f"{query_id[0]}-{batch_id}")

    writer = rows.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if until_done else writer).start()


def keep_state_on_disk(spark: SparkSession) -> SparkSession:
    """Streams started from here on keep their state in RocksDB, not in the executors' memory, and
    checkpoint what changed in a batch, not the whole state."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return spark


def unique_stream(
    checked: DataFrame,
    *,
    keep: str | None = None,
    time_column: str = "file_time",
    columns: Sequence[str] = (OUTPUT_COLUMN,),
) -> DataFrame:
    """Plausible records of a stream with repeats dropped across micro-batches, without a look at the target.

    State is one entry per canonical string, dealt over the shuffle partitions by the string, so a
    string with a third of all rows is one entry like any other and no partition gathers its rows.
    Without ``keep`` a string is written once for ever. With ``keep`` (such as ``30 days``) the state is
    bounded: a string is dropped from it when the stream's ``time_column`` has gone on by more than
    that, so repeats within the interval never pass and later ones may. Rows without a time count
    as the oldest.
    """
    valid = with_canonical(plausible(checked))
    if keep is None:
        return valid.select(*columns).dropDuplicates([OUTPUT_COLUMN])
    timed = valid.select(
        *columns, F.coalesce(time_column, F.timestamp_seconds(F.lit(0))).alias(time_column)
    )
    unique = timed.withWatermark(time_column, keep).dropDuplicatesWithinWatermark([OUTPUT_COLUMN])
    return unique.select(*columns)


def start_unique_stream(
    checked: DataFrame,
    write: BatchWriter,
    checkpoint: str,
    *,
    keep: str | None = None,
    columns: Sequence[str] = (OUTPUT_COLUMN,),
    until_done: bool = True,
) -> StreamingQuery:
    """Run checked records to a batch writer, each canonical string once over all micro-batches.

    State and output go together: a batch that broke runs again on the state it began with and
    replaces its own output, so the output is the same after a restart on ``checkpoint``. The number of
    shuffle partitions of the first start stays.
    """
    keep_state_on_disk(checked.sparkSession)
    unique = unique_stream(checked, keep=keep, columns=columns)
    return _start(unique, lambda batch: batch, write, checkpoint, until_done)


class StatusLog(StreamingQueryListener):
    """Logs counters and rates of a running stream at most every ``seconds``; ``None`` is silent.

    Totals are kept in ``processed`` and ``invalids``.
    """

    def __init__(self, seconds: float | None = STATUS_SECONDS) -> None:
        self.seconds = None if seconds is None else max(LEAST_STATUS_SECONDS, seconds)
        self.processed = 0
        self.invalids = 0
        self._elapsed = 0.0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        counts = progress.observedMetrics.get("checked")
        if counts is not None:
            self.processed += counts["processed"]
            self.invalids += counts["invalids"]
        self._elapsed += progress.batchDuration / 1000
        if self.seconds is not None and self._elapsed >= self.seconds:
            self._elapsed = 0.0
            log.info(
                "batch %s: processed=%s invalids=%s rates: in=%.1f/s done=%.1f/s",
                progress.batchId,
                self.processed,
                self.invalids,
                progress.inputRowsPerSecond,
                progress.processedRowsPerSecond,
            )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
