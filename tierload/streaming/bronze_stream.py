"""Bronze -> Silver as Structured Streaming.

The file source tracks processed files in the checkpoint, so every
micro-batch holds only new Bronze files; ``foreachBatch`` merges each
one into the Silver table with the batch MERGE (``merge_latest``).
``trigger(availableNow=True)`` drains what is there and stops, which
makes it a drop-in scheduled job.  Unlike the state-based batch load,
late files (older batch ids) ARE processed here.  Re-running an epoch
after a failure is harmless for keyed tables (the MERGE is idempotent).
An append-only table takes each epoch as a segment; the epoch's number is
committed in the same statement as its rows, so a replayed epoch is
either skipped or was never there.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..config import DateValidation, SilverDataset
from ..plans import silver_frames as sf
from ..plans.tables import SnapshotTable

EPOCH_PROP = "tierload.stream"      # + "." + stream id: last epoch that the table holds


def bronze_stream(spark: SparkSession, location: str, data_schema: T.StructType,
                  partition_names: list[str], max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of a Hive-partitioned Bronze folder, partition
    columns as strings."""
    part = {n.lower() for n in partition_names}
    fields = [f for f in data_schema.fields if f.name.lower() not in part]
    fields += [T.StructField(n, T.StringType()) for n in partition_names]
    r = spark.readStream.schema(T.StructType(fields)).option("basePath", location.rstrip("/"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.parquet(location.rstrip("/"))


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark keeps for a stream in its checkpoint (a new checkpoint is a new stream)."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def merge_batches(table: SnapshotTable, ds: SilverDataset, validation: DateValidation,
                  as_of=None, run_ts=None, checkpoint: str | None = None):
    """The ``foreachBatch`` function: initial load for the first batch,
    MERGE (or append) for the next ones.  With the stream's
    ``checkpoint``, an append-only table takes each epoch once."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        if ds.mode != "dedupe_latest":
            append(batch, epoch_id)
        elif not table.exists():
            table.write(sf.initial_load(batch, ds, validation, as_of, run_ts))
        else:
            table.merge(sf.merge_keys(batch, ds, validation, None, as_of),
                        lambda current: sf.merge_load(current, batch, ds, validation, None, as_of, run_ts,
                                                      partitions=table.join_partitions()))

    def append(batch: DataFrame, epoch_id: int) -> None:
        props = {}
        if checkpoint is not None:
            prop = f"{EPOCH_PROP}.{stream_id(batch.sparkSession, checkpoint)}"
            done = table.stored_prop(prop)
            if done is not None and int(done) >= epoch_id:
                return
            props[prop] = str(epoch_id)
        table.append(sf.append_load(batch, ds, validation, None, as_of, run_ts), props)
    return run


def stream_silver(spark: SparkSession, location: str, data_schema: T.StructType,
                  partition_names: list[str], table: SnapshotTable, ds: SilverDataset,
                  checkpoint: str, validation: DateValidation = DateValidation(),
                  as_of=None, run_ts=None, max_files_per_trigger: int | None = None,
                  available_now: bool = True) -> StreamingQuery:
    src = bronze_stream(spark, location, data_schema, partition_names, max_files_per_trigger)
    w = (src.writeStream.foreachBatch(merge_batches(table, ds, validation, as_of, run_ts, checkpoint))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
