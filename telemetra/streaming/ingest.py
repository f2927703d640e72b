"""Stream ingest (S6, K6, C2): JSON messages -> keyed items, last arrival wins.

``readStream`` over a folder of JSON-lines files (one message per line; a
broker connector can replace the file source without changing the rest) ->
per micro-batch, ``foreachBatch``:

* keep the messages on the topic (F4);
* parse every body once (P2-P5), tag and stringify its attributes (P6, P7) and
  split good rows from rejects (F6); ``item`` holds every attribute with its
  tag, ``extras`` the text of those that are no reading or do not cast to one;
* write the whole batch, good and rejected, to ``<log>/batch_id=<n>`` with
  ``mode("overwrite")`` — a batch replayed after a failure replaces its own
  folder, so the log is exactly-once under the checkpoint;
* every row carries its arrival position: file modification time, file name,
  block start and the line position inside that block.

The keyed table (K6) is the log folded to the latest row per key
(:func:`latest_items`): whole rows replace whole rows, the later batch wins,
inside a batch the later line wins.  Folding into the lake table is a batch
upsert (:meth:`telemetra.sinks.lake.LakeTable.upsert`) with the same order; the
last batch folded is a mark of the commit.  :func:`current_items` reads the
folded table and only the batches after that mark.

:func:`start_keyed_state` keeps the latest row of each key in the stream's state
store instead and upserts each batch's changed keys into a lake table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..constants import READINGS, RECORD_KEY, TOPIC
from ..functions.attributes import ITEM_TYPE, flatten_attrs
from ..functions.evaluation import where_once
from ..functions.messages import parse_messages
from ..functions.predicates import topic_is
from ..operators.keyed import delete_keys, latest_per_key

ARRIVAL = ("_arrival_time", "_arrival_file", "_arrival_block", "_arrival_pos")
ARRIVAL_ORDER = ("batch_id", *ARRIVAL)


def log_schema(readings: Sequence[str] = READINGS) -> str:
    cols = ", ".join(f"{r} double" for r in readings)
    return (
        "device_id string, timestamp string, "
        f"{cols}, extras map<string,string>, item {ITEM_TYPE}, body string, reason string, "
        "_arrival_time timestamp, _arrival_file string, _arrival_block bigint, _arrival_pos bigint, "
        "batch_id bigint"
    )


def broker_rows(raw: DataFrame) -> DataFrame:
    """Broker records (value, topic, partition, offset) as message bodies.

    Inside a partition the offset alone orders them: a timestamp set by a late
    or wrong clock has no say, so ``_arrival_time`` is NULL.  Between
    partitions there is no order but a fixed one, by topic and partition.
    """
    return raw.select(
        F.col("value").cast("string").alias("body"),
        F.lit(None).cast("timestamp").alias("_arrival_time"),
        F.col("topic").alias("_arrival_file"),
        F.col("partition").cast("bigint").alias("_arrival_block"),
        F.col("offset").alias("_arrival_pos"),
        F.col("topic").alias("_topic"),
    )


def message_stream(
    spark: SparkSession,
    source: str,
    max_files_per_trigger: int | None = None,
    source_format: str = "text",
    options: dict[str, str] | None = None,
    max_records_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming message bodies with their arrival position.

    ``source_format="text"``: ``source`` is a folder (or glob) of JSON-lines
    files; arrival = (file time, file name, block start) and the line
    position is added per micro-batch; the topic of a file below a folder
    ``topic=<name>`` is that name, of any other file the default one.
    ``source_format="kafka"``: ``source``
    is the topic (the connector package must be on the classpath; it is not
    in this image); arrival = (topic, partition, offset), see
    :func:`broker_rows`.  ``max_files_per_trigger`` bounds a micro-batch of
    the file source, ``max_records_per_trigger`` one of the broker.
    """
    if source_format == "kafka":
        reader = spark.readStream.format("kafka").option("subscribe", source)
        for k, v in (options or {}).items():
            reader = reader.option(k, v)
        if max_records_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", str(max_records_per_trigger))
        return broker_rows(reader.load())
    reader = spark.readStream.format(source_format)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.load(source)
    return raw.select(
        F.col("value").alias("body"),
        F.col("_metadata.file_modification_time").alias("_arrival_time"),
        F.col("_metadata.file_name").alias("_arrival_file"),
        F.col("_metadata.file_block_start").alias("_arrival_block"),
        _folder_topic().alias("_topic"),
    )


def _folder_topic() -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(F.col("_metadata.file_path"), "/topic=([^/]+)/", 1), F.lit("")), F.lit(TOPIC))


def line_stream(spark: SparkSession, source: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """S6 from files of moderate size, each read whole: the line number is part
    of the message itself, so a streaming aggregate can order by it."""
    reader = spark.readStream.option("maxFilesPerTrigger", str(max_files_per_trigger)) if max_files_per_trigger else spark.readStream
    files = reader.text(source, wholetext=True).select(
        "value", F.col("_metadata.file_modification_time").alias("_arrival_time"), F.col("_metadata.file_name").alias("_arrival_file"), _folder_topic().alias("_topic")
    )
    lines = files.select("*", F.posexplode(F.split("value", "\r?\n")).alias("_arrival_pos", "body")).where("body <> ''")
    return lines.select("body", "_arrival_time", "_arrival_file", F.lit(0).cast("bigint").alias("_arrival_block"), F.col("_arrival_pos").cast("bigint"), "_topic")


def batch_rows(batch: DataFrame, batch_id: int, readings: Sequence[str] = READINGS, topic: str = TOPIC) -> DataFrame:
    """One micro-batch -> log rows of the topic (good rows typed, rejects with body and reason).

    The line position is taken right above the file scan (no shuffle in
    between), so it increases with the line order inside each file block; it
    is only ever compared within one (file, block).
    """
    with_pos = batch
    if "_arrival_pos" not in batch.columns:
        with_pos = batch.withColumn("_arrival_pos", F.monotonically_increasing_id())
    parsed = parse_messages(with_pos.where(topic_is(F.col("_topic"), topic)), keep=ARRIVAL, items=True)
    good = F.col("reason").isNull()
    return parsed.select(
        "device_id",
        "timestamp",
        *flatten_attrs(F.col("data"), readings),
        "item",
        F.when(~good, F.col("body")).alias("body"),
        "reason",
        *ARRIVAL,
        F.lit(batch_id).cast("bigint").alias("batch_id"),
    )


def write_batch(batch: DataFrame, batch_id: int, log_dir: str, readings: Sequence[str] = READINGS, topic: str = TOPIC) -> None:
    rows = batch_rows(batch, batch_id, readings, topic).drop("batch_id")
    rows.write.mode("overwrite").parquet(f"{log_dir}/batch_id={batch_id}")


def keyed_state(messages: DataFrame, keys: Sequence[str] = RECORD_KEY, readings: Sequence[str] = READINGS, topic: str = TOPIC) -> DataFrame:
    """K6 as a streaming aggregate: the latest good row of each key by arrival.

    ``max_by`` keeps one row per key in the state store and combines map-side,
    so a hot key sends one row per task.  In update mode each batch gives the
    keys whose row changed.  The state holds every key ever seen (the key
    contains the message's time): on a cluster use the RocksDB provider, or
    :func:`start_ingest` and :func:`fold_log`, which keep no state.
    """
    parsed = parse_messages(messages.where(topic_is(F.col("_topic"), topic)), keep=ARRIVAL, items=True)
    good = where_once(parsed, F.col("reason").isNull())
    others = [r for r in readings if r not in keys]
    rows = good.select(*keys, F.struct(*flatten_attrs(F.col("data"), others), "item").alias("row"), F.struct(*ARRIVAL).alias("arrival"))
    latest = rows.groupBy(*keys).agg(F.max_by("row", "arrival").alias("row"), F.max("arrival").alias("arrival"))
    return latest.select(*keys, "row.*", "arrival.*")


def start_keyed_state(
    table,
    spark: SparkSession,
    source: str,
    checkpoint_dir: str,
    max_files_per_trigger: int | None = None,
    mark: str = "state",
) -> StreamingQuery:
    """K6: drain the files at ``source`` into ``table`` through the stream's state.

    Each micro-batch upserts its changed keys; its number is a mark of that
    commit, so a batch that is repeated after a crash is not applied again.
    """

    def put(changed: DataFrame, batch_id: int) -> None:
        if batch_id > table.mark(mark):
            table.upsert(changed, list(ARRIVAL), marks={mark: batch_id})

    state = keyed_state(line_stream(spark, source, max_files_per_trigger))
    return state.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start()


def start_ingest(
    spark: SparkSession,
    source: str,
    log_dir: str,
    checkpoint_dir: str,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    source_format: str = "text",
    options: dict[str, str] | None = None,
) -> StreamingQuery:
    """Start the ingest; ``available_now`` drains what is there and stops."""
    topic = source if source_format == "kafka" else TOPIC
    stream = message_stream(spark, source, max_files_per_trigger, source_format, options)
    writer = (
        stream.writeStream.foreachBatch(lambda df, bid: write_batch(df, bid, log_dir, topic=topic))
        .option("checkpointLocation", checkpoint_dir)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def read_log(spark: SparkSession, log_dir: str, readings: Sequence[str] = READINGS) -> DataFrame:
    return spark.read.schema(log_schema(readings)).parquet(log_dir)


def rejected_messages(spark: SparkSession, log_dir: str) -> DataFrame:
    """The reject output: (body, reason, arrival) of every message not stored."""
    return read_log(spark, log_dir).where(F.col("reason").isNotNull()).select("body", "reason", *ARRIVAL_ORDER)


def latest_items(
    spark: SparkSession,
    log_dir: str,
    keys: Sequence[str] = RECORD_KEY,
    readings: Sequence[str] = READINGS,
) -> DataFrame:
    """K6: the keyed item table — one row per key, the last arrival's whole row."""
    good = read_log(spark, log_dir, readings).where(F.col("reason").isNull())
    latest = latest_per_key(good, keys, list(ARRIVAL_ORDER), null_safe=False)  # good rows have both keys
    return latest.select(*keys, *[r for r in readings if r not in keys], "extras", "item")


def unfolded(spark: SparkSession, log_dir: str, after_batch: int, readings: Sequence[str] = READINGS) -> DataFrame:
    """The good log rows of the batches after ``after_batch``; only their folders are read."""
    return read_log(spark, log_dir, readings).where(F.col("reason").isNull() & (F.col("batch_id") > after_batch))


def fold_log(table, spark: SparkSession, log_dir: str, after_batch: int = -1, mark: str = "log") -> int:
    """Fold the ingest log's batches that are not folded yet into a lake table;
    returns the last batch folded.

    How far the log has been folded is a mark of the table's commit, set in the
    same view switch as the rows: a fold repeated after a crash either finds
    its mark and does nothing, or none of its rows.  (``after_batch`` holds
    batches back that were folded without a mark.)  The last batch is read
    first and bounds the fold, so one that lands meanwhile is left to the next.
    Without a new batch nothing is committed.

    A batch upsert (K2) with the arrival order as precombine: the lake table
    ends up with exactly the rows :func:`latest_items` shows.  Only the
    partitions the new batches touch are rewritten.
    """
    done = max(after_batch, table.mark(mark))
    last = spark.read.schema("batch_id bigint").parquet(log_dir).agg(F.max("batch_id")).first()[0]
    if last is None or last <= done:
        return done
    good = unfolded(spark, log_dir, done).where(F.col("batch_id") <= last)
    table.upsert(good.drop("body", "reason"), list(ARRIVAL_ORDER), marks={mark: last})
    return last


def current_items(
    table,
    spark: SparkSession,
    log_dir: str,
    readings: Sequence[str] = READINGS,
    mark: str = "log",
) -> DataFrame:
    """K6 merged on read: the folded table, with the batches after its mark on top.

    The rows are those of :func:`latest_items`, but only unfolded batches are
    read and de-duplicated, and one anti-join replaces their keys in the folded
    rows.  Table and mark are of one version: a fold that commits between this
    call and its evaluation changes nothing.
    """
    keys = table.keys
    columns = [*keys, *[r for r in readings if r not in keys], "extras", "item"]
    if not table.exists():
        return latest_items(spark, log_dir, keys, readings)
    folded, marks = table.read_marked()
    folded, done = folded.select(*columns), marks.get(mark, -1)
    fresh = latest_per_key(unfolded(spark, log_dir, done, readings), keys, list(ARRIVAL_ORDER), null_safe=False).select(*columns)
    return delete_keys(folded, fresh.select(*keys), keys, distinct=False).unionByName(fresh)
