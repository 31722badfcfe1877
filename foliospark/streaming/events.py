"""Streams: sessions, windows, latest facts and deliveries without repetition."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Fixed schema of the event table (its times carry no zone; they are read as UTC).
EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def event_stream(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """Events of a folder as a stream, with ``ts`` as a timestamp (watermarks need one)."""
    stream = spark.readStream.schema(EVENTS).option(
        "maxFilesPerTrigger", files_per_trigger
    ).option("pathGlobFilter", "events*.parquet").parquet(folder)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def sessions(events: DataFrame, gap: str = "30 minutes", late: str | None = None) -> DataFrame:
    """Sessions of each user: start, end (last event and ``gap``), events, value.  ``late`` sets the watermark of a
    stream.
    """
    e = events.withWatermark("ts", late) if late else events
    s = e.groupBy("user_id", F.session_window("ts", gap).alias("s")).agg(
        F.count("*").alias("events"), F.sum("value").alias("value")
    )
    return s.select("user_id", F.col("s.start").alias("start"), F.col("s.end").alias("end"), "events", "value")


def windows(events: DataFrame, width: str = "1 hour", slide: str | None = None, late: str | None = None) -> DataFrame:
    """Counts and sums by event type in tumbling or sliding windows."""
    e = events.withWatermark("ts", late) if late else events
    w = F.window("ts", width, slide) if slide else F.window("ts", width)
    g = e.groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("events"), F.sum("value").alias("value"))
    return g.select(F.col("w.start").alias("start"), "event_type", "events", "value")


def once(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """Events without repeated deliveries of an event_id within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def upsert_facts(folder: str, buckets: int = 64, keep: int = 2):
    """``foreachBatch`` function that keeps the latest value of each user and event type in Parquet below ``folder``.

    The facts are spread over ``buckets`` by user.  A batch writes only the
    buckets that it touches, as versions numbered by batch, so a repeated batch
    writes its versions again and changes nothing.  Of each bucket the last
    ``keep`` versions stay.  Read it with ``stored_facts``.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.select("user_id", F.col("event_type").alias("key"), "value", "ts").withColumn(
            "bucket", F.pmod(F.xxhash64("user_id"), F.lit(buckets)).cast("int")
        )
        rows = rows.groupBy("bucket", "user_id", "key").agg(
            F.max_by("value", F.struct("ts", "value")).alias("value"), F.max("ts").alias("ts")
        ).persist()
        touched = [r["bucket"] for r in rows.select("bucket").distinct().collect()]  # at most ``buckets``
        versions = {
            b: sorted(v for v in found if v < number) for b, found in _versions(spark, folder).items() if b in touched
        }
        old = [f"{folder}/bucket={b}/v={found[-1]}" for b, found in versions.items() if found]
        if old:
            rows = rows.unionByName(spark.read.option("basePath", folder).parquet(*old).drop("v"))
        latest = rows.groupBy("bucket", "user_id", "key").agg(
            F.max_by("value", F.struct("ts", "value")).alias("value"), F.max("ts").alias("ts")
        ).withColumn("v", F.lit(number))
        latest.repartition("bucket").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("bucket", "v").parquet(folder)
        files, path = _files(spark, folder)
        for b, found in versions.items():
            for v in found[: max(0, len(found) + 1 - keep)]:
                files.delete(path(f"{folder}/bucket={b}/v={v}"), True)

    return write


def _files(spark: SparkSession, folder: str):
    """The file system of ``folder`` and its path class."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(folder).getFileSystem(spark._jsc.hadoopConfiguration()), path


def _versions(spark: SparkSession, folder: str) -> dict[int, list[int]]:
    """Complete versions of each bucket."""
    files, path = _files(spark, folder)
    out: dict[int, list[int]] = {}
    for status in files.globStatus(path(f"{folder}/bucket=*/v=*")) or []:
        v, b = status.getPath(), status.getPath().getParent()
        out.setdefault(int(b.getName().split("=")[1]), []).append(int(v.getName().split("=")[1]))
    return {b: sorted(v) for b, v in out.items()}


def stored_facts(spark: SparkSession, folder: str) -> DataFrame:
    """user_id, key, value, ts of the last version of each bucket."""
    last = [f"{folder}/bucket={b}/v={v[-1]}" for b, v in _versions(spark, folder).items()]
    return spark.read.option("basePath", folder).parquet(*last).drop("bucket", "v")


def forward_fill(
    events: DataFrame, column: str, keys: tuple[str, ...] = ("user_id",), time: str = "ts", tie: str = "event_id",
    seconds: int = 86_400
) -> DataFrame:
    """``filled``: the last value of ``column`` that is not null, up to the row in order of ``time`` and ``tie``.

    The last values of ranges of ``seconds`` are carried over the ranges, so a key
    with a large part of all events is many tasks.
    """
    e = events.withColumn(
        "_r",
        F.coalesce(F.floor(F.unix_micros(F.col(time).cast("timestamp")) / (seconds * 1_000_000)), F.lit(-(1 << 62)))
    )
    named = F.concat_ws("\n", *[F.coalesce(F.concat(F.lit("k"), F.col(k).cast("string")), F.lit("")) for k in keys])
    e = e.withColumn("_k", named)
    ends = e.where(F.col(column).isNotNull()).groupBy("_k", "_r").agg(F.max_by(column, F.struct(time, tie)).alias("_e"))
    spans = e.select("_k", "_r").distinct().join(ends, ["_k", "_r"], "left")
    upto = Window.partitionBy("_k").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    before = spans.select("_k", "_r", F.last("_e", ignorenulls=True).over(upto).alias("_b"))
    inside = Window.partitionBy("_k", "_r").orderBy(time, tie).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return e.join(before, ["_k", "_r"]).withColumn(
        "filled", F.coalesce(F.last(column, ignorenulls=True).over(inside), "_b")
    ).select(*events.columns, "filled")
