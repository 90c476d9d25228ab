"""Streaming jobs, drained over the whole event table and read back."""

from lakeloom.checks.registry import check, stamp
from lakeloom.functions.money import money
from lakeloom.session import scratch_path
from lakeloom.sources.changes import BAD, parse_changes, read_change_files
from lakeloom.sources.files import TIME_FORMAT
from lakeloom.sources.schemas import CHANGE_RECORD
from lakeloom.sources.segments import append_segments, read_segments
from lakeloom.streaming import jobs
from pyspark.sql import functions as F

ROW = "event_id bigint, user_id bigint, event_type string, value double"


def _span(d) -> str:
    """A delay as long as the table's time range: no event counts as late."""
    ends = d.events().agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    return f"{(ends.b - ends.a).days + 1 if ends.a else 1} days"


def _records(d, damage: bool = False, events=None, schema=None):
    """Change records of all events as JSON files; returns folder and files per batch."""
    path = scratch_path(d.spark, "records")
    schema = F.lit("public") if schema is None else schema
    value = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    if damage:
        value = F.when(F.col("event_type") == "error", F.concat(F.lit("{broken "), "event_id")).otherwise(value)
    files = max(d.spark.sparkContext.defaultParallelism, 3)
    rows = d.events() if events is None else events
    rows.select(
        F.concat(F.lit("shop."), schema, F.lit("."), "event_type").alias("topic"),
        F.col("user_id").cast("string").alias("key"),
        value.alias("value"),
        F.col("ts").cast("timestamp").alias("ts"),
    ).repartition(files).write.options(**TIME_FORMAT).json(path)
    return path, max(files // 3, 1)


def _stream(d, damage: bool = False):
    return read_change_files(d.spark, *_records(d, damage))


def _typed(d):
    return parse_changes(_stream(d), ROW).select("event_id", "ts", "user_id", "event_type", "value")


def _place(d, label):
    root = scratch_path(d.spark, label)
    return f"{root}/data", f"{root}/checkpoint"


EVENT = f"event_id, {stamp('ts')} as ts, user_id, event_type, value"


@check(
    "str_01_parsed_changes",
    f"""select 'shop.public.' || event_type as topic, cast(user_id as varchar) as key, {stamp('ts')} as ts,
        case when event_type <> 'error' then event_id end as event_id,
        case when event_type <> 'error' then user_id end as user_id,
        case when event_type <> 'error' then event_type end as event_type,
        case when event_type <> 'error' then value end as value,
        case when event_type = 'error' then '{{broken ' || event_id end as bad
    from events""",
)
def str_01_parsed_changes(d):
    path, checkpoint = _place(d, "parsed")
    jobs.drain(jobs.append_rows(parse_changes(_stream(d, damage=True), ROW), path, checkpoint))
    return d.spark.read.parquet(path).withColumnRenamed(BAD, "bad")


# Two schemas have tables of the same names.
@check(
    "str_02_landed_by_table",
    f"""select 'shop.' || case when event_id % 2 = 0 then 'public' else 'audit' end || '.' || event_type as topic,
        cast(user_id as varchar) as key, {stamp('ts')} as ts from events""",
)
def str_02_landed_by_table(d):
    path, checkpoint = _place(d, "landed")
    schema = F.when(F.col("event_id") % 2 == 0, "public").otherwise("audit")
    records = read_change_files(d.spark, *_records(d, schema=schema))
    jobs.drain(jobs.land_by_table(records, path, checkpoint))
    columns = "key string, value string, ts timestamp, topic string"
    return d.spark.read.schema(columns).json(path).select("topic", "key", "ts")


@check("str_03_exactly_once", f"select {EVENT} from events")
def str_03_exactly_once(d):
    path, checkpoint = _place(d, "appended")
    rows = _typed(d)
    jobs.drain(jobs.append_rows(rows, path, checkpoint))
    jobs.drain(jobs.append_rows(rows, path, checkpoint))  # restarted: nothing is written twice
    return d.spark.read.parquet(path)


@check(
    "str_04_latest_state",
    f"""select {EVENT} from events
    qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""",
)
def str_04_latest_state(d):
    path, checkpoint = _place(d, "state")
    keys, newest = ["user_id"], ["ts", "event_id"]
    rows = _typed(d)
    jobs.drain(jobs.keep_latest(rows, path, checkpoint, keys, newest))
    jobs.fold_batches(d.spark, path, keys, newest)
    return jobs.latest_state(d.spark, path, keys, newest)


WINDOW_KEYS = ["window_start", "window_end", "event_type"]
DAILY = f"""select {stamp("date_trunc('day', ts)")} as window_start,
    {stamp("date_trunc('day', ts) + interval 1 day")} as window_end, event_type, count(*) as n,
    cast(sum(cast(value as decimal(18,2))) as double) as total from events group by 1, 2, 3"""


def _daily(rows, delay=None):
    measures = [F.count("*").alias("n"), F.sum(money("value")).alias("total")]
    return jobs.windowed(rows, "ts", "1 day", ["event_type"], measures, delay)


def _zoned(rows):
    """Watermarks need timestamps with a zone; the test table's have none."""
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def _speed_view(d):
    path, checkpoint = _place(d, "speed")
    jobs.drain(jobs.publish_updates(_daily(_typed(d), _span(d)), path, checkpoint))
    jobs.fold_batches(d.spark, path, WINDOW_KEYS)
    return jobs.read_updates(d.spark, path, WINDOW_KEYS)


@check("str_05_speed_view", DAILY)
def str_05_speed_view(d):
    return _speed_view(d)


@check("str_06_served_view", DAILY)
def str_06_served_view(d):
    cut = "2024-01-20 00:00:00"
    batch = jobs.stamp_batch_view(_daily(_zoned(d.events().filter(f"ts < '{cut}'"))), cut)
    return jobs.serve(batch, _speed_view(d), cut)


@check("str_07_redelivered", f"select {EVENT} from events")
def str_07_redelivered(d):
    path, checkpoint = _place(d, "deduped")
    folder, per_batch = _records(d)
    once = parse_changes(read_change_files(d.spark, folder, per_batch), ROW)
    again = parse_changes(read_change_files(d.spark, folder, per_batch), ROW)
    rows = once.unionByName(again).select("event_id", "ts", "user_id", "event_type", "value")
    jobs.drain(jobs.append_rows(jobs.dedupe(rows, ["event_id"], "ts", _span(d)), path, checkpoint))
    return d.spark.read.parquet(path)


# The newer events come first; of the older ones only those in windows that end after the
# watermark, 20 days before the newest event, still count.
@check(
    "str_08_late_rows",
    DAILY.replace(
        "from events",
        f"""from events where ts >= timestamp '2024-01-16 00:00:00'
        or date_trunc('day', ts) + interval 1 day > (select max(ts) - interval 20 day from events)""",
    ),
)
def str_08_late_rows(d):
    path, checkpoint = _place(d, "late")
    newer, older = (d.events().filter(f"ts {sign} '2024-01-16 00:00:00'") for sign in (">=", "<"))
    source, _ = _records(d, events=newer)

    def drain():
        rows = parse_changes(read_change_files(d.spark, source), ROW)
        jobs.drain(jobs.publish_updates(_daily(rows, "20 days"), path, checkpoint))

    drain()
    late, _ = _records(d, events=older)
    d.spark.read.schema(CHANGE_RECORD).json(late).write.options(**TIME_FORMAT).mode("append").json(source)
    drain()
    return jobs.read_updates(d.spark, path, WINDOW_KEYS)


def _appended(d, path, segment, rows):
    records = rows.select(
        F.concat(F.lit("shop.public."), "event_type").alias("topic"),
        F.col("user_id").cast("string").alias("key"),
        F.to_json(F.struct("event_id", "user_id", "event_type", "value")).alias("value"),
        F.col("ts").cast("timestamp").alias("ts"),
    )
    append_segments(records, path, "key", 4, segment)


# Three segments a partition; the stream is stopped after two and goes on with the third.
@check("src_13_segment_topic", f"select {EVENT} from events")
def src_13_segment_topic(d):
    path, checkpoint = _place(d, "replayed")
    topic = scratch_path(d.spark, "topic")

    def drain():
        rows = parse_changes(read_segments(d.spark, topic, segments_per_task=1), ROW)
        rows = rows.select("event_id", "ts", "user_id", "event_type", "value")
        jobs.drain(jobs.append_rows(rows, path, checkpoint))

    for segment in range(3):
        _appended(d, topic, segment, d.events().filter(F.col("event_id") % 3 == segment))
        if segment:
            drain()
    drain()  # nothing is new
    return d.spark.read.parquet(path)
