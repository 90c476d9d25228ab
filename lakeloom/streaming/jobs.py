"""Streams of change records and the real-time view beside the batch view."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from lakeloom.operators.ranking import latest_by_key
from lakeloom.sources.files import TIME_FORMAT

BATCH = "_batch"
FOLD = "folded-"
CUT = "_valid_until"


def drain(writer: DataStreamWriter) -> StreamingQuery:
    """Process everything available now and stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def follow(writer: DataStreamWriter, every: str = "5 seconds") -> StreamingQuery:
    """Keep polling the source."""
    return writer.trigger(processingTime=every).start()


def land_by_table(records: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append raw change records to one folder per table, exactly once.

    The folder's key is the whole topic: tables of one name in two schemas stay apart.
    """
    return (
        records.writeStream.format("json")
        .options(**TIME_FORMAT)
        .partitionBy("topic")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def append_rows(rows: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append typed rows as Parquet, exactly once."""
    return (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def dedupe(rows: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """Drop re-delivered records; state is kept only as long as the delay."""
    return rows.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def _committed(spark: SparkSession, path: str, start: str) -> dict[int, str]:
    """Folders ``start`` + number that have their commit marker, by number."""
    jvm = spark._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{path}/{start}*/_SUCCESS")
    files = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getParent().getName() for f in files.globStatus(pattern) or []]
    return {int(n.removeprefix(start)): n for n in names}


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all committed micro-batches, with the number of their batch.

    Starts from the newest fold; batches that are still being written do not count.
    """
    folds, batches = _committed(spark, path, FOLD), _committed(spark, path, f"{BATCH}=")
    last = max(folds, default=-1)
    parts = [spark.read.parquet(f"{path}/{folds[last]}")] if folds else []
    later = [f"{path}/{name}" for number, name in sorted(batches.items()) if number > last]
    if later:
        rows = spark.read.option("basePath", path).parquet(*later)
        parts.append(rows.withColumn(BATCH, F.col(BATCH).cast("bigint")))
    if not parts:
        raise FileNotFoundError(f"no committed batch below {path}")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def fold_batches(spark: SparkSession, path: str, keys: Sequence[str], newest: Sequence[str] = ()) -> None:
    """Fold the committed micro-batches into one folder with the newest row per key.

    To be run regularly, beside the stream: readers then open one fold and the few batches
    after it instead of every batch there ever was. ``newest`` as in the reader; among
    equals the later batch counts.
    """
    done = max(_committed(spark, path, f"{BATCH}="), default=-1)
    if done <= max(_committed(spark, path, FOLD), default=-1):
        return
    rows = read_batches(spark, path).filter(F.col(BATCH) <= done)
    folded = latest_by_key(rows, keys, [*newest, BATCH])
    folded.write.mode("overwrite").parquet(f"{path}/{FOLD}{done}")


def keep_latest(rows: DataFrame, path: str, checkpoint: str, keys: Sequence[str],
                newest: Sequence[str]) -> DataStreamWriter:
    """Write the newest row per key of each micro-batch to its own folder.

    A repeated micro-batch overwrites its folder, so nothing is counted twice.
    """

    def save(batch: DataFrame, number: int) -> None:
        latest_by_key(batch, keys, newest).write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")

    return rows.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)


def latest_state(spark: SparkSession, path: str, keys: Sequence[str], newest: Sequence[str],
                 base: DataFrame | None = None) -> DataFrame:
    """Newest row per key over all committed micro-batches, on top of an older table."""
    rows = read_batches(spark, path)
    if base is not None:
        rows = base.withColumn(BATCH, F.lit(-1).cast("bigint")).unionByName(rows)
    return latest_by_key(rows, keys, [*newest, BATCH]).drop(BATCH)


def windowed(rows: DataFrame, ts: str, length: str, by: Sequence[str], measures: Sequence[Column],
             delay: str | None = None) -> DataFrame:
    """Aggregate per event-time window; the same plan serves batch and stream.

    With a delay, rows later than it are dropped by the stream and are put
    right by the next batch run.
    """
    timely = rows.withWatermark(ts, delay) if delay else rows
    per_window = timely.groupBy(F.window(ts, length).alias("_w"), *by).agg(*measures)
    return per_window.select(
        F.col("_w.start").alias("window_start"),
        F.col("_w.end").alias("window_end"),
        *[c for c in per_window.columns if c != "_w"],
    )


def publish_updates(view: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Write the windows that changed in each micro-batch to its own folder."""

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")

    return (
        view.writeStream.outputMode("update")
        .foreachBatch(save)
        .option("checkpointLocation", checkpoint)
    )


def read_updates(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Current value of every window: its newest update."""
    return latest_by_key(read_batches(spark, path), keys, [BATCH]).drop(BATCH)


def stamp_batch_view(view: DataFrame, cut: str) -> DataFrame:
    """A batch view with the time up to which it is complete."""
    return view.withColumn(CUT, F.lit(cut).cast("timestamp"))


def serve(batch_view: DataFrame, speed_view: DataFrame, cut: object | None = None) -> DataFrame:
    """Batch windows up to the cut time and real-time windows after it.

    Both sides use one cut, so no window is taken twice. Without ``cut`` it is read from
    the batch view, which should then be a stored table, as it is read once more.
    """
    if cut is None and CUT in batch_view.columns:
        cut = batch_view.agg(F.max(CUT)).first()[0]
    final = batch_view.drop(CUT)
    if cut is None:
        return speed_view.select(*final.columns)
    at = F.lit(cut).cast("timestamp")
    old = final.filter(F.col("window_end") <= at)
    new = speed_view.filter(F.col("window_end") > at)
    return old.unionByName(new.select(*final.columns))
