"""Transaction messages: publish (batch) and consume into bronze (stream).

Publishing turns file rows into JSON messages and writes them to a Kafka
topic, or, where no broker is available, to a folder of JSON-lines files.
Consuming is a Structured Streaming query: the source is read from its
earliest offset (``availableNow``: stop when drained), each micro-batch is decoded and merged into the bronze table with the ordered
keyed upsert, and offsets are committed to the checkpoint only after the
batch's table version is committed (at-least-once; a replayed batch id is a
no-op).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace import schemas
from terrace.operators.merge import keyed_upsert
from terrace.session import stream_checkpoint
from terrace.sinks.tables import VersionedTable
from terrace.streaming import messages

TOPIC = "ppd.raw"
# One stream (position and batch ids) for all runs over a bronze table.
STREAM = "transactions"
# Producer delivery settings: wait for all replicas, gzip, 20 ms linger,
# 5,000-message batches.
PRODUCER_OPTIONS = {
    "kafka.acks": "all",
    "kafka.compression.type": "gzip",
    "kafka.linger.ms": "20",
    "kafka.batch.size": str(5000 * 512),
    "kafka.retries": "5",
}


def publish(ppd_text: DataFrame, ingested_at: _dt.datetime, mode: str, *,
            bootstrap_servers: str | None = None, topic: str = TOPIC,
            folder: str | None = None) -> None:
    """Write one message per file row (to Kafka, or JSON-lines files)."""
    msgs = messages.encode(ppd_text, ingested_at, mode)
    if bootstrap_servers:
        (msgs.write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
             .option("topic", topic).options(**PRODUCER_OPTIONS).save())
    elif folder:
        msgs.select("value").write.mode("append").text(folder)
    else:
        raise ValueError("give bootstrap_servers or folder")


def message_stream(spark: SparkSession, *, bootstrap_servers: str | None = None, topic: str = TOPIC,
                   folder: str | None = None, max_per_trigger: int | None = None,
                   files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of (value, order columns) from the earliest offset.

    ``None`` limits mean one micro-batch takes the whole backlog.
    """
    if bootstrap_servers:
        r = (spark.readStream.format("kafka")
             .option("kafka.bootstrap.servers", bootstrap_servers)
             .option("subscribe", topic).option("startingOffsets", "earliest"))
        if max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", max_per_trigger)
        src = r.load()
        return src.select(F.col("value").cast("string").alias("value"),
                          F.col("partition").cast("long").alias("_src"),
                          F.col("offset").alias("_pos"))
    r = spark.readStream.format("text")
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    src = r.load(folder)
    # File order: modification time, then name; within a file, read order
    # (numbered per micro-batch in ``merge_batch``).
    return src.select("value",
                      F.concat_ws("/", F.lpad(F.unix_micros("_metadata.file_modification_time").cast("string"), 20, "0"),
                                  F.col("_metadata.file_name")).alias("_src"))


def _bronze_partition():
    return F.year("transfer_date")


def _rejects(bronze_path: str) -> str:
    return f"{bronze_path.rstrip('/')}_rejected"


def rejected(spark: SparkSession, bronze_path: str) -> int:
    """Messages set aside so far because no transaction id could be read."""
    try:
        return spark.read.parquet(_rejects(bronze_path)).count()
    except Exception as exc:
        if "PATH_NOT_FOUND" in str(exc) or "UNABLE_TO_INFER_SCHEMA" in str(exc):
            return 0
        raise


def merge_batch(table: VersionedTable, batch: DataFrame, batch_id: int, stream: str) -> int:
    """Decode one micro-batch and upsert it into the bronze table.

    Messages without a transaction id (malformed ones too) go to the table's
    reject folder, one sub-folder per batch, so a replay writes them once.
    They are written before the batch is committed, so a committed batch has
    nothing left to do.  Every message is parsed once: the decoded batch is
    written, and the rejects and the merge read it from there.
    """
    if table.taken(batch_id, stream):
        return table.version()
    if "_pos" not in batch.columns:
        batch = batch.withColumn("_pos", F.monotonically_increasing_id())
    unread = F.col("transaction_id").isNull()
    decoded = messages.decode(batch, keep=["_src", "_pos", "value"]).withColumn("value", F.when(unread, F.col("value")))

    def combine(current, incoming):
        if current is None:
            current = table.spark.createDataFrame([], schemas.RAW_PPD)
        return keyed_upsert(current, incoming, "transaction_id", ["_src", "_pos"],
                            schemas.UPSERT_UPDATE_COLUMNS)

    combine.accepts_empty = True
    kept = table.incoming_path()
    try:
        decoded.write.parquet(kept)
        decoded = table.spark.read.schema(decoded.schema).parquet(kept)
        bad = decoded.where(unread).select("value", "_src", "_pos")
        bad.write.mode("overwrite").parquet(f"{_rejects(table.path)}/stream={stream}/batch={batch_id}")
        rows = decoded.where(~unread).drop("value")
        return table.upsert(rows, "transaction_id", combine, batch_id=batch_id, stream=stream, stored=True)
    finally:
        table.delete(kept)


def consume(spark: SparkSession, bronze_path: str, mode: str, *, bootstrap_servers: str | None = None,
            topic: str = TOPIC, folder: str | None = None, name: str = STREAM,
            max_per_trigger: int | None = None, files_per_trigger: int | None = None,
            run_id: _dt.datetime | None = None) -> int:
    """Drain the topic into ``bronze_path``; returns the committed table version.

    Both modes read on from one position: a message is taken once, whichever
    run takes it.  ``full`` empties the table first (once per ``run_id``, so a
    repeated run goes on where it stopped) and loads what has been published
    since the last run; ``incremental`` merges into the existing rows.

    A micro-batch is distributed, so its size is a cost trade-off, not a memory
    bound; by default one batch takes the whole backlog, and each partition it
    touches is rewritten once.
    """
    table = VersionedTable(spark, bronze_path, _bronze_partition, ["transaction_id"], marks=["transfer_date"])
    if mode == "full":
        reset, mark = f"{name} emptied for", int((run_id or _dt.datetime.now()).timestamp() * 1_000_000)
        if table.manifest().streams.get(reset) != mark:
            table.overwrite(spark.createDataFrame([], schemas.RAW_PPD), mark, reset)
    stream = message_stream(spark, bootstrap_servers=bootstrap_servers, topic=topic, folder=folder,
                            max_per_trigger=max_per_trigger, files_per_trigger=files_per_trigger)
    q = (stream.writeStream.foreachBatch(lambda df, bid: merge_batch(table, df, bid, name))
         .option("checkpointLocation", stream_checkpoint(spark, bronze_path, name))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return table.version()
