"""Incremental loads on the event and order tables."""

from lakeloom.checks.registry import check, day, having, stamp
from lakeloom.operators import incremental as inc
from lakeloom.session import scratch_path
from pyspark.sql import functions as F

CUT = "2024-01-12 00:00:00"
EVENT = f"event_id, {stamp('ts')} as ts, user_id, event_type, value"


def _events(d):
    return d.events().select("event_id", "ts", "user_id", "event_type", "value")


def _split(d):
    rows = _events(d)
    return rows.filter(f"ts < '{CUT}'"), rows


@check(
    "inc_01_append",
    f"""select {EVENT} from events where ts < timestamp '{CUT}' union all
    select {EVENT} from events
    where event_id > (select max(event_id) from events where ts < timestamp '{CUT}')""",
)
def inc_01_append(d):
    stored, source = _split(d)
    last = inc.high_water(stored, "event_id")
    return stored.unionByName(inc.rows_after(source, "event_id", last[0]))


@check(
    "inc_02_last_modified",
    f"""select {EVENT} from events where ts > timestamp '{CUT}' and ts <= timestamp '2024-01-20 00:00:00'""",
)
def inc_02_last_modified(d):
    last = F.lit(CUT)
    return inc.rows_changed(_events(d), "ts", last, F.lit("2024-01-20 00:00:00"))


NEWEST = "qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1"


@check("inc_03_merge", f"select {EVENT} from events {NEWEST}")
def inc_03_merge(d):
    stored, source = _split(d)
    root = scratch_path(d.spark, "state")
    state = inc.VersionedTable(d.spark, root, ("user_id",), ("ts", "event_id"))
    state.add(stored)
    delta = inc.rows_after(source, "ts", F.lit(CUT))
    state.add(delta)
    state.compact()
    state.add(delta)  # delivered again: no change
    return state.read()


@check(
    "inc_03_merge_with_deletes",
    f"select * from (select {EVENT} from events {NEWEST}) where event_type <> 'error'",
)
def inc_03_merge_with_deletes(d):
    """Deltas with and without operations, folded; then older changes of all keys arrive."""
    kind = F.when(F.col("event_type") == "error", inc.DELETE).otherwise(inc.UPDATE)
    stored, source = _split(d)
    table = inc.VersionedTable(d.spark, scratch_path(d.spark, "deletes"), ("user_id",), ("ts", "event_id"))
    table.add(stored.withColumn(inc.OP, kind))
    recent = inc.rows_after(source, "ts", F.lit(CUT))
    table.add(recent.filter("event_type <> 'error'"))
    table.add(recent.filter("event_type = 'error'").withColumn(inc.OP, F.lit(inc.DELETE)))
    table.compact()
    table.add(stored.filter("event_type <> 'error'"))
    return table.read()


@check(
    "inc_04_timestamp_and_key_poll",
    """with hourly as (select event_id, date_trunc('hour', ts) as hour, user_id from events),
    middle as (select hour, event_id from hourly where event_id = (select max(event_id) // 2 from events))
    select h.event_id, strftime(h.hour, '%Y-%m-%d %H:%M:%S.%f') as hour, h.user_id from hourly h, middle m
    where h.hour > m.hour or (h.hour = m.hour and h.event_id > m.event_id)""",
)
def inc_04_timestamp_and_key_poll(d):
    hourly = d.events().select("event_id", F.date_trunc("hour", "ts").alias("hour"), "user_id")
    middle = hourly.agg(F.max("event_id")).first()[0] // 2
    seen = hourly.filter(F.col("event_id") <= middle)
    return inc.rows_polled(hourly, "hour", "event_id", inc.high_water(seen, "hour", "event_id"))


def _sync(d):
    """Two runs of a two-table sync, then everything. The first cut falls inside equal days."""
    root = scratch_path(d.spark, "sync")
    marks = inc.Bookmarks(d.spark, f"{root}/marks")
    orders = d.raw("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    days = d.events().select("event_id", F.to_date("ts").alias("day"))  # no key, many ties
    plan = [
        (inc.SyncRule("orders", "o_orderdate", ("o_orderkey",)), orders, "o_orderdate < '1997-12-31' or o_orderdate < '1998-01-01' and o_orderkey % 2 = 0"),
        (inc.SyncRule("events", "event_id"), _events(d), f"ts < '{CUT}'"),
        (inc.SyncRule("days", "day"), days, "day < '2024-01-12' and event_id % 3 > 0 or day < '2024-01-11'"),
    ]
    for rule, source, early in plan:
        inc.sync_table(source.filter(early), f"{root}/{rule.table}", marks, rule)
    targets = {}
    for rule, source, _ in plan:
        inc.sync_table(source, f"{root}/{rule.table}", marks, rule)
        targets[rule.table] = inc.sync_table(source, f"{root}/{rule.table}", marks, rule)  # nothing new
    return targets, marks


@check(
    "inc_05_sync_tables",
    """select 'orders' as table_name, o_orderkey as key, o_totalprice as value from orders
    union all select 'events', event_id, value from events
    union all select 'days', event_id, cast(day(ts) as double) from events""",
)
def inc_05_sync_tables(d):
    targets, _ = _sync(d)
    orders = targets["orders"].read().select(
        F.lit("orders").alias("table_name"), F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("value")
    )
    events = targets["events"].read().select(F.lit("events").alias("table_name"), F.col("event_id").alias("key"), "value")
    days = targets["days"].read().select(
        F.lit("days").alias("table_name"), F.col("event_id").alias("key"), F.day("day").cast("double").alias("value")
    )
    return orders.unionByName(events).unionByName(days)


@check(
    "inc_05_sync_late_rows",
    f"""select event_id, {stamp('ts')} as changed, event_type from events where event_id % 10 > 0
    union all
    select event_id, null, case when event_id % 20 = 0 then 'second' else event_type end
    from events where event_id % 10 = 0""",
)
def inc_05_sync_late_rows(d):
    """Three runs over rows with a zoned time: late commits and rows without a time."""
    time = F.when(F.col("event_id") % 10 > 0, F.col("ts").cast("timestamp"))
    rows = d.events().select("event_id", time.alias("changed"), "event_type")
    untimed = F.col("changed").isNull()
    second = F.when(untimed & (F.col("event_id") % 20 == 0), "second").otherwise(F.col("event_type"))
    cut = F.lit(CUT).cast("timestamp")
    # Every seventh row of the two days before the cut is committed after the first run.
    late = (F.col("changed") >= cut - F.expr("interval 2 days")) & (F.col("event_id") % 7 == 0)
    rule = inc.SyncRule("events", "changed", ("event_id",), overlap="interval 2 days")
    root = scratch_path(d.spark, "late")
    marks = inc.Bookmarks(d.spark, f"{root}/marks")
    first = rows.filter(untimed | (F.col("changed") < cut) & ~late)
    inc.sync_table(first, f"{root}/events", marks, rule)
    inc.sync_table(rows.filter(untimed | (F.col("changed") < cut)), f"{root}/events", marks, rule)
    return inc.sync_table(rows.withColumn("event_type", second), f"{root}/events", marks, rule).read()


@check(
    "inc_06_deleted_keys",
    "select o_orderkey from orders where o_orderstatus = 'P'",
)
def inc_06_deleted_keys(d):
    before = d.raw("orders")
    return inc.deleted_keys(before, before.filter("o_orderstatus <> 'P'"), ["o_orderkey"])


# Every part was listed once; sizes below 10 were deleted, below 20 renamed, 40 and above are new.
@check(
    "inc_07_derived_text",
    """select p_partkey as film_id, case when p_size < 20 then 'NEW ' || p_name else p_name end as title,
        p_type as description from part where p_size >= 10""",
)
def inc_07_derived_text(d):
    films = d.raw("part").select(
        F.col("p_partkey").alias("film_id"), F.col("p_name").alias("title"), F.col("p_type").alias("description"), "p_size"
    )
    listed = films.filter("p_size < 40").drop("p_size")
    op = F.when(F.col("p_size") < 10, "D").when(F.col("p_size") < 20, "U").otherwise("I")
    changed = films.filter("p_size < 20 or p_size >= 40").withColumn(inc.OP, op)
    renamed = F.when(F.col(inc.OP) == "U", F.concat(F.lit("NEW "), "title")).otherwise(F.col("title"))
    # An older change of the same film must lose against the newer one.
    older = changed.withColumn(inc.OP, F.lit("U")).withColumn("title", F.lit("old")).withColumn("at", F.lit(1))
    newer = changed.withColumn("title", renamed).withColumn("at", F.lit(2))
    changes = older.unionByName(newer).drop("p_size")
    return inc.apply_changes(listed, changes, "film_id", ["at"])


@check(
    "inc_08_touched_rows",
    """select c_custkey, nullif(c_mktsegment, 'BUILDING') as segment,
        case when c_mktsegment in ('BUILDING', 'MACHINERY') then '2024-02-01' else '2024-01-01' end as touched
    from customer""",
)
def inc_08_touched_rows(d):
    then, now = F.lit("2024-01-01").cast("date"), F.lit("2024-02-01").cast("date")
    rows = d.raw("customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    stored = rows.withColumn("segment", F.nullif("segment", F.lit("MACHINERY"))).withColumn("touched", then)
    incoming = rows.withColumn("segment", F.nullif("segment", F.lit("BUILDING")))
    return inc.touch_changed(stored, incoming, ["c_custkey"], "touched", now)


@check(
    "inc_09_bookmarks",
    f"""select 'orders' as source, {day('max(o_orderdate)')} as last from orders
    union all select 'events', cast(max(event_id) as varchar) from events
    union all select 'days', cast(cast(max(ts) as date) as varchar) from events""",
)
def inc_09_bookmarks(d):
    _, marks = _sync(d)
    return marks.table().select("source", F.substring(F.col("last")[0], 1, 10).alias("last"))
