"""Sources, sinks, cleaning and streams on awkward input."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakeloom.functions.text import null_tokens
from lakeloom.operators import quality
from lakeloom.operators.incremental import Bookmarks, high_water, rows_polled, touch_changed
from lakeloom.plans import medallion
from lakeloom.session import scratch_root, shuffle_partitions
from lakeloom.sources import files
from lakeloom.sources.changes import BAD, parse_changes, read_change_files
from lakeloom.sources.federation import jdbc_catalog_settings, register_frames
from lakeloom.sources.lake import Lake, write_csv
from lakeloom.sources.relational import FrameSource, JdbcSource, for_each_table, import_all
from lakeloom.sources.schemas import RATINGS, RENTAL_STORE, SALES, struct
from lakeloom.streaming import jobs
from tests import store

CUSTOMER = "customer_id bigint, first_name string, last_name string, email string, active boolean, last_update timestamp"


def at(hour: int) -> dt.datetime:
    return dt.datetime(2024, 1, 1, hour)


def test_clean_customer(spark):
    rows = [
        (1, " Ann ", "Lee", " Ann.Lee@Mail.ORG ", None, at(1)),
        (1, "Ann", "Old", "old@mail.org", True, at(0)),
        (2, "Bob", "Ray", "bob at mail.org", True, at(1)),
        (3, "Cy", "No", None, True, at(1)),
        (None, "Di", "X", "di@mail.org", True, at(1)),
        # The newest row is invalid, so the older valid one stays.
        (4, "Ed", "Y", "ed@mail.org", False, at(1)),
        (4, "Ed", "Y", "broken", False, at(2)),
    ]
    df = spark.createDataFrame(rows, CUSTOMER)
    got = quality.clean(df, quality.default_rules()["customer"])
    assert sorted((r.customer_id, r.first_name, r.email, r.active) for r in got.collect()) == [
        (1, "Ann", "ann.lee@mail.org", True), (4, "Ed", "ed@mail.org", False)]
    rejected = quality.split_valid(df, quality.default_rules()["customer"])[1]
    reasons = sorted(r._reject_reason for r in rejected.collect())
    assert reasons == ["customer_id_missing", "email_invalid", "email_invalid", "email_invalid"]


def test_clean_rental_duration(spark):
    rows = [(1, 1, at(0), dt.datetime(2024, 1, 2, 12)), (2, 1, at(0), None), (3, None, at(0), None)]
    df = spark.createDataFrame(rows, "rental_id bigint, customer_id bigint, rental_date timestamp, return_date timestamp")
    got = {r.rental_id: r.rental_duration_days for r in quality.clean(df, quality.default_rules()["rental"]).collect()}
    assert got == {1: 1.5, 2: None}


def test_clean_film_rating_and_inventory(spark):
    film = spark.createDataFrame([(1, " A ", None), (2, "B", " pg "), (3, None, "R")], "film_id bigint, title string, rating string")
    got = {r.film_id: (r.title, r.rating) for r in quality.clean(film, quality.default_rules()["film"]).collect()}
    assert got == {1: ("A", "G"), 2: ("B", "PG")}
    copies = spark.createDataFrame([(1, 5), (1, 5), (2, None), (None, 5)], "inventory_id bigint, film_id bigint")
    assert quality.clean(copies, quality.default_rules()["inventory"]).count() == 1


def test_clean_empty_table(spark):
    empty = spark.createDataFrame([], CUSTOMER)
    rules = quality.default_rules()["customer"]
    assert quality.clean(empty, rules).count() == 0
    report = quality.quality_report(empty, rules, "customer").first()
    assert report.table_name == "customer" and not report.rows_in


def test_domain_and_foreign_keys(spark):
    film = store.film(spark)
    assert quality.check_domain(film, "rating", RATINGS).count() == 0
    payment = spark.createDataFrame([(1, 7), (2, None), (3, 1)], "payment_id int, rental_id bigint")
    found = quality.check_fk(payment, store.rental(spark).filter("rental_id < 5"), ["rental_id"], ["rental_id"], "r").first()
    assert (found.orphan_rows, found.orphan_keys) == (1, 1)


def test_scratch_is_taken_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert scratch_root(spark) == named.rstrip("/")
    assert scratch_root(spark) == scratch_root(spark)


def test_shuffle_partitions_grow_with_the_input():
    assert shuffle_partitions(8) == 24
    assert shuffle_partitions(8, 1 << 40) == 8192


def test_csv_quotes_and_header_blanks(spark, folder):
    path = Path(folder.removeprefix("file:"))
    path.mkdir(parents=True)
    (path / "a.csv").write_text('Index,First Name,Company\n1,Ann,"Lee, Ray and Co"\n2,Bob,"The ""Best"""\n')
    got = files.read_csv(spark, folder, snake_names=True)
    assert got.columns == ["index", "first_name", "company"]
    assert [r.company for r in got.orderBy("index").collect()] == ["Lee, Ray and Co", 'The "Best"']


def test_sales_csv_round_trip(spark, folder):
    write_csv(store.sales(spark), folder, single_file=True)
    got = files.read_csv(spark, folder, SALES)
    assert sorted(got.collect()) == sorted(store.sales(spark).collect())


def test_json_with_broken_line_and_missing_column(spark, folder):
    path = Path(folder.removeprefix("file:"))
    path.mkdir(parents=True)
    (path / "a.json").write_text('{"id": 1, "at": "2024-01-01T00:00:00.123456Z"}\n{"id": broken\n')
    got = files.read_json(spark, folder, "id bigint, at timestamp, note string")
    rows = {r.id: r for r in got.collect()}
    assert rows[1].at.microsecond == 123456 and rows[1].note is None
    assert rows[None][files.CORRUPT] == '{"id": broken'


def test_null_tokens_by_type(spark):
    df = spark.createDataFrame([(None, None, None, bytearray(b"x"))], "s string, n int, d date, b binary")
    got = null_tokens(df, "none", "0").first().asDict()
    assert got == {"s": "none", "n": "0", "d": "0"}


def test_literal_rows_and_reproducible_range(spark):
    people = files.from_rows(spark, [("Ann", 30), ("Bob", 25)], ["name", "age"])
    assert people.count() == 2
    first, again = (files.gen_range(spark, 20_000, 12) for _ in range(2))
    assert first.rdd.getNumPartitions() == 12
    assert first.agg(F.sum("random_value")).first() == again.agg(F.sum("random_value")).first()
    from lakeloom.plans.marts import bucket_aggregate

    buckets = bucket_aggregate(first, "id", "random_value").collect()
    assert len(buckets) == 100 and all(b["count(id)"] == 200 for b in buckets)
    assert all(0.3 < b["avg(random_value)"] < 0.7 for b in buckets)


def test_jdbc_options_carry_no_built_in_credentials():
    source = JdbcSource("jdbc:example:db", "org.example.Driver", {"user": "u", "password": "p"}, ["a"])
    assert source.options() == {
        "user": "u", "password": "p", "url": "jdbc:example:db", "driver": "org.example.Driver", "fetchsize": "10000"}
    assert source.split_options(1, 90, "id", 4) == {
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "90", "numPartitions": "4"}
    settings = jdbc_catalog_settings("live", {"url": "jdbc:example:db"})
    assert settings["spark.sql.catalog.live.url"] == "jdbc:example:db" and len(settings) == 2


def test_failing_table_does_not_stop_the_others(spark, folder):
    lake = Lake(spark, folder)
    source = FrameSource({"film": lambda: store.film(spark), "bad": lambda: spark.table("does_not_exist")})
    status = {s.table: s for s in medallion.run_bronze(lake, source)}
    assert status["film"].ok and status["film"].rows == 10
    assert not status["bad"].ok and "does_not_exist" in status["bad"].error
    assert for_each_table(["x"], lambda t: 1 / 0)[0].ok is False
    assert import_all(spark, FrameSource({}), None) == []


def test_layers_of_the_rental_store(spark, folder):
    lake = Lake(spark, folder)
    stamp = F.lit("2024-03-01").cast("timestamp")
    tables = {
        "customer": store.customer(spark),
        "rental": store.rental(spark),
        "payment": store.payment(spark),
        "film": store.film(spark),
        "inventory": store.inventory(spark),
    }
    source = FrameSource({n: df.withColumn("last_update", stamp) for n, df in tables.items()})
    # The same load twice: duplicates go when the tables are cleaned.
    medallion.run_bronze(lake, source)
    medallion.run_bronze(lake, source)
    rules = {n: r for n, r in quality.default_rules().items() if n in tables}
    status = {s.table: s.rows for s in medallion.run_silver(lake, RENTAL_STORE, rules)}
    assert status == {"customer": 10, "rental": 20, "payment": 20, "film": 10, "inventory": 20}
    done = {s.table: s.rows for s in medallion.run_gold(lake)}
    assert done == {"monthly_revenue": 7, "customer_lifetime_value": 10, "film_performance": 10, "store_performance": 4}
    june = lake.read_gold("monthly_revenue").filter("year = 2024 and month = 1")
    assert june.agg(F.sum("total_revenue")).first()[0] == Decimal("56.85")
    assert "PartitionFilters: [isnotnull(year" in june._jdf.queryExecution().toString()
    amount = [f for f in lake.read_silver("payment").schema if f.name == "amount"][0]
    assert amount.dataType.simpleString() == "decimal(18,2)"


def test_gold_refresh_keeps_other_partitions(spark, folder):
    lake = Lake(spark, folder)
    rows = spark.createDataFrame([(1, 10), (2, 20)], "month int, n int")
    assert lake.write_gold(rows, "t", ["month"]).rows == 2
    assert lake.write_gold(rows.filter("month = 2").withColumn("n", F.lit(21)), "t", ["month"], mode="partitions").rows == 1
    assert sorted((r.month, r.n) for r in lake.read_gold("t").collect()) == [(1, 10), (2, 21)]
    assert lake.write_gold(rows.limit(0), "empty").rows == 0


def test_conform_reports_bad_values(spark):
    loose = spark.createDataFrame([("1", "x", "2024-13-01"), ("2", "3.5", None)], "a string, b string, c string")
    got = quality.conform(loose, struct("a int, b decimal(5,2), c date, d string")).orderBy("a").collect()
    assert got[0]._bad_columns == ["b", "c"] and got[0].b is None
    assert got[1]._bad_columns == [] and got[1].b == Decimal("3.50")


def test_poll_continues_within_equal_timestamps(spark):
    df = spark.createDataFrame([(at(1), 1), (at(1), 2), (at(2), 1)], "ts timestamp, id int")
    assert high_water(df.limit(0), "ts", "id") is None
    assert sorted(r.id for r in rows_polled(df, "ts", "id", (at(1), 1)).collect()) == [1, 2]
    assert rows_polled(df, "ts", "id", high_water(df, "ts", "id")).count() == 0


def test_touch_is_null_safe(spark):
    stored = spark.createDataFrame([(1, None, 5), (2, "a", 5), (3, None, 5)], "k int, v string, at int")
    now = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "n")], "k int, v string")
    got = {r.k: r.at for r in touch_changed(stored, now, ["k"], "at", F.lit(9)).collect()}
    assert got == {1: 9, 2: 5, 3: 5, 4: 9}


def test_bookmarks_remember_the_newest(spark, folder):
    marks = Bookmarks(spark, folder)
    assert marks.last("orders") is None
    marks.save("orders", [1])
    marks.save("orders", [2])
    assert marks.last("orders") == ["2"] and marks.last("other") is None


def test_views_of_two_systems(spark):
    register_frames(spark, "here", {"film": store.film(spark)})
    register_frames(spark, "there", {"stock": store.inventory(spark)})
    got = spark.sql("select count(*) n from here_film f join there_stock s on f.film_id = s.film_id where f.rating = 'G'")
    assert got.first().n == 6


def put(folder, name, records):
    path = Path(folder.removeprefix("file:")) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(json.dumps(r) + "\n" for r in records))


def record(key, value, ts):
    return {"topic": "db.public.t", "key": str(key), "value": value, "ts": ts}


def test_stream_restart_and_bad_json(spark, folder):
    source, out, mark = f"{folder}/in", f"{folder}/out", f"{folder}/mark"
    put(source, "1.json", [record(1, '{"x": 1}', "2024-01-01T00:00:00Z"), record(2, "{oops", "2024-01-01T00:00:01Z")])
    rows = parse_changes(read_change_files(spark, source), "x int")
    jobs.drain(jobs.append_rows(rows, out, mark))
    put(source, "2.json", [record(1, '{"x": 2}', "2024-01-02T00:00:00Z")])
    jobs.drain(jobs.append_rows(parse_changes(read_change_files(spark, source), "x int"), out, mark))
    got = spark.read.parquet(out).collect()
    assert sorted((r.key, r.x, r[BAD]) for r in got if r.x is not None) == [("1", 1, None), ("1", 2, None)]
    assert [(r.key, r[BAD]) for r in got if r.x is None] == [("2", "{oops")]


def test_stream_latest_state_over_batches(spark, folder):
    source, out, mark = f"{folder}/in", f"{folder}/out", f"{folder}/mark"
    for i, x in enumerate((5, 7, 6)):
        put(source, f"{i}.json", [record(1, json.dumps({"x": x}), f"2024-01-0{x}T00:00:00Z"),
                                  record(2, json.dumps({"x": i}), f"2024-01-0{i + 1}T00:00:00Z")])
    rows = parse_changes(read_change_files(spark, source, 1), "x int").select("key", "ts", "x")
    jobs.drain(jobs.keep_latest(rows, out, mark, ["key"], ["ts"]))
    got = {r.key: r.x for r in jobs.latest_state(spark, out, ["key"], ["ts"]).collect()}
    assert got == {"1": 7, "2": 2}
    base = spark.createDataFrame([("3", at(1), 33)], "key string, ts timestamp, x int")
    assert jobs.latest_state(spark, out, ["key"], ["ts"], base).count() == 3


def test_late_records_leave_the_stream_view_and_the_batch_puts_them_right(spark, folder):
    source, out, mark = f"{folder}/in", f"{folder}/out", f"{folder}/mark"
    schema = "v int"

    def view(rows, delay=None):
        return jobs.windowed(rows, "ts", "1 hour", [], [F.sum("v").alias("total")], delay)

    def drain():
        rows = parse_changes(read_change_files(spark, source), schema)
        jobs.drain(jobs.publish_updates(view(rows, "10 minutes"), out, mark))

    put(source, "1.json", [record(1, '{"v": 1}', "2024-01-01T00:10:00Z"), record(1, '{"v": 2}', "2024-01-01T05:00:00Z")])
    drain()
    put(source, "2.json", [record(1, '{"v": 100}', "2024-01-01T00:20:00Z"), record(1, '{"v": 3}', "2024-01-01T05:30:00Z")])
    drain()
    keys = ["window_start", "window_end"]
    speed = jobs.read_updates(spark, out, keys)
    assert {r.window_start.hour: r.total for r in speed.collect()} == {0: 1, 5: 5}
    landed = parse_changes(spark.read.schema("topic string, key string, value string, ts timestamp").json(source), schema)
    batch = jobs.stamp_batch_view(view(landed.filter("ts < timestamp'2024-01-01 01:00:00Z'")), "2024-01-01 01:00:00")
    served = {r.window_start.hour: r.total for r in jobs.serve(batch, speed).collect()}
    assert served == {0: 101, 5: 5}


@pytest.mark.parametrize("table", sorted(RENTAL_STORE))
def test_schemas_parse(table):
    assert struct(RENTAL_STORE[table]).fields


def test_late_older_change_does_not_revive_a_deleted_key(spark, folder):
    from lakeloom.operators.incremental import VersionedTable

    schema = "k int, t int, x string, op string"
    table = VersionedTable(spark, folder, ("k",), ("t",))
    table.add(spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "k int, t int, x string"))
    table.add(spark.createDataFrame([(1, 5, None, "D")], schema))  # with operation
    table.add(spark.createDataFrame([(2, 2, "c")], "k int, t int, x string"))  # without
    assert {r.k: r.x for r in table.read().collect()} == {2: "c"}
    table.compact()
    table.add(spark.createDataFrame([(1, 3, "late", "U")], schema))
    assert {r.k: r.x for r in table.read().collect()} == {2: "c"}
    table.compact(drop_deletes=F.col("t") < 4)  # not old enough
    assert {r.k: r.x for r in table.read().collect()} == {2: "c"}
    table.add(spark.createDataFrame([(1, 6, "new", "U")], schema))
    assert {r.k: r.x for r in table.read().collect()} == {1: "new", 2: "c"}


def test_sync_reads_ties_and_keeps_data_and_bookmark_together(spark, folder):
    from lakeloom.operators.incremental import SyncRule, sync_table

    marks = Bookmarks(spark, f"{folder}/marks")
    rule = SyncRule("log", "day")
    rows = [(1, 1), (2, 2), (3, 2)]
    schema = "id int, day int"
    sync_table(spark.createDataFrame(rows, schema), f"{folder}/log", marks, rule)
    rows += [(4, 2), (4, 2), (5, 3)]
    target = sync_table(spark.createDataFrame(rows, schema), f"{folder}/log", marks, rule)
    assert sorted((r.id, r.day) for r in target.read().collect()) == sorted(rows)
    # The report of a bookmark is lost: the data's own bookmark still counts.
    lost = Bookmarks(spark, f"{folder}/other")
    again = sync_table(spark.createDataFrame(rows, schema), f"{folder}/log", lost, rule)
    assert again.mark() == "3" and again.read().count() == len(rows)


def test_federation_leaves_other_tables_alone(spark, folder):
    from lakeloom.sources.federation import register_folders, unused_system

    system = unused_system("mine")
    spark.sql(f"create database {system} location '{folder}/db'")
    spark.sql(f"create table {system}.t using parquet as select 7 as x")
    spark.range(3).write.parquet(f"{folder}/t")
    with pytest.raises(ValueError):
        register_folders(spark, system, {"t": f"{folder}/t"})
    assert spark.table(f"{system}.t").first().x == 7
    register_folders(spark, system, {"u": f"{folder}/t"})
    spark.range(5).write.parquet(f"{folder}/u")
    register_folders(spark, system, {"u": f"{folder}/u"})
    assert spark.table(f"{system}.u").count() == 5
    assert spark.read.parquet(f"{folder}/t").count() == 3
    spark.sql(f"drop database {system} cascade")


def test_federation_leaves_nothing_behind(spark, folder):
    from lakeloom.sources.federation import federated, register_frames

    spark.range(3).write.parquet(f"{folder}/t")
    before = {d.name for d in spark.catalog.listDatabases()}
    with federated(spark, {"lake": {"t": f"{folder}/t"}}, {"live": {"u": spark.range(5)}}) as at:
        found = spark.sql(f"select * from {at['lake']}.t join {at['live']}_u using (id)")
    assert {d.name for d in spark.catalog.listDatabases()} == before
    assert not any("live_" in t.name for t in spark.catalog.listTables())
    assert found.count() == 3  # the files stay
    spark.range(1).createOrReplaceTempView("mine_t")
    with pytest.raises(ValueError, match="mine_t"):
        register_frames(spark, "mine", {"t": spark.range(2)})
    assert spark.table("mine_t").count() == 1
    spark.catalog.dropTempView("mine_t")


def test_parallel_imports(spark):
    from lakeloom.sources.relational import TableStatus

    source = JdbcSource("jdbc:example:db", "org.example.Driver")
    assert source.bounds_query("film", "film_id") == (
        "(select min(film_id) as lo, max(film_id) as hi from film) bounds")
    assert source.split_options(1, 9, "film_id", 4) == {
        "partitionColumn": "film_id", "lowerBound": "1", "upperBound": "9", "numPartitions": "4"}
    asked = []

    class Source(FrameSource):
        def read_split(self, spark, table, column, parts):
            asked.append((table, column, parts))
            return self.read(spark, table)

    frames = {f"t{i}": spark.range(i) for i in range(6)}
    status = import_all(spark, Source(frames), lambda df, t: TableStatus(t, True, df.count()),
                        splits={"t3": ("id", 4)}, at_once=3)
    assert [(s.table, s.rows) for s in status] == [(f"t{i}", i) for i in range(6)]
    assert asked == [("t3", "id", 4)]


def test_folded_and_uncommitted_batches(spark, folder):
    def batch(number, rows, committed=True):
        writer = spark.createDataFrame(rows, "k int, t int, x int").write
        if not committed:
            writer = writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
        writer.parquet(f"{folder}/{jobs.BATCH}={number}")

    def state():
        return {r.k: r.x for r in jobs.latest_state(spark, folder, ["k"], ["t"]).collect()}

    batch(0, [(1, 1, 1), (2, 5, 2)])
    batch(1, [(1, 2, 3), (2, 4, 4)])
    batch(2, [(1, 9, 99)], committed=False)
    assert state() == {1: 3, 2: 2}
    jobs.fold_batches(spark, folder, ["k"], ["t"])
    jobs.fold_batches(spark, folder, ["k"], ["t"])
    assert state() == {1: 3, 2: 2}
    batch(3, [(2, 6, 7), (3, 1, 8)])
    assert state() == {1: 3, 2: 7, 3: 8}
    assert jobs.read_batches(spark, folder).count() == 4


@pytest.mark.parametrize("codec", ["zstd", "snappy"])
def test_files_have_the_codec_asked_for(spark, folder, codec):
    import pyarrow.parquet as pq

    lake = Lake(spark, folder)
    lake.write_silver(spark.range(100), "s", compression=codec)
    lake.write_gold(spark.range(100), "g", compression=codec)
    found = [p for p in Path(folder.removeprefix("file:")).rglob("*.parquet")]
    assert len(found) >= 2
    assert {pq.ParquetFile(p).metadata.row_group(0).column(0).compression for p in found} == {codec.upper()}


def test_single_file_keeps_its_order(spark, folder):
    write_csv(spark.range(1000).repartition(7), f"{folder}/one", single_file=True, sort_by=[F.desc("id")])
    parts = list(Path(f"{folder}/one".removeprefix("file:")).glob("part-*.csv"))
    assert len(parts) == 1
    assert [int(x) for x in parts[0].read_text().split()[1:]] == list(range(999, -1, -1))


def test_scratch_is_removed_on_request(spark, monkeypatch):
    from lakeloom import session

    monkeypatch.setattr(session, "_made_here", [])
    first = session.materialize(spark.range(3), "gone")
    assert first.count() == 3
    path = session._made_here[0]
    assert session.clear_scratch(spark) == 1 and session._made_here == []
    assert not Path(path.removeprefix("file:")).exists()


@pytest.mark.parametrize("zone", ["America/New_York", "Europe/Berlin", "UTC"])
def test_sync_does_not_depend_on_the_time_zone(spark, folder, monkeypatch, zone):
    import time

    from lakeloom.operators.incremental import SyncRule, sync_table

    monkeypatch.setenv("TZ", zone)
    time.tzset()
    try:
        marks = Bookmarks(spark, f"{folder}/marks")
        rule = SyncRule("log", "at", ("id",))

        def source(*rows):
            df = spark.createDataFrame(list(rows), "id int, text string")
            return df.select("id", F.to_timestamp("text").alias("at"))

        rows = [(1, "2024-03-01 10:00:00"), (2, "2024-03-01 11:00:00"), (3, None)]
        first = sync_table(source(*rows), f"{folder}/log", marks, rule)
        assert sorted(r.id for r in first.read().collect()) == [1, 2, 3]
        rows += [(4, "2024-03-01 11:30:00"), (5, None)]
        again = sync_table(source(*rows), f"{folder}/log", marks, rule)
        got = again.read().select("id", F.col("at").cast("string").alias("at")).collect()
        assert sorted(map(tuple, got)) == rows
        assert marks.last("log") == ["2024-03-01 11:30:00"]
    finally:
        monkeypatch.undo()
        time.tzset()


def test_sync_reads_late_rows_within_the_overlap(spark, folder):
    from lakeloom.operators.incremental import SyncRule, sync_table

    marks = Bookmarks(spark, f"{folder}/marks")
    schema = "id int, at int, x string"
    keyed, log = SyncRule("t", "at", ("id",), overlap="10"), SyncRule("l", "at", overlap="10")

    def run(rows):
        return [
            sorted(map(tuple, sync_table(spark.createDataFrame(rows, schema), f"{folder}/{r.table}", marks, r).read().collect()), key=repr)
            for r in (keyed, log)
        ]

    rows = [(1, 100, "a"), (2, 95, "b"), (3, None, "c"), (3, None, "c")]
    by_key, all_rows = run(rows)
    assert by_key == sorted(rows[:3], key=repr) and all_rows == sorted(rows, key=repr)
    rows += [(4, 91, "late"), (4, 91, "late"), (5, 89, "too late"), (6, None, "new")]
    by_key, all_rows = run(rows)
    assert [r[0] for r in by_key] == [1, 2, 3, 4, 6] and len(all_rows) == 7
    # Late rows do not move the bookmark back, and a second run adds nothing.
    assert marks.last("t") == ["100"]
    assert run(rows) == [by_key, all_rows]
    # Content of a row without a check value changes: the last loaded counts.
    by_key, _ = run([(3, None, "B"), (3, None, "B")])
    assert (3, None, "B") in by_key and (3, None, "c") not in by_key
    by_key, _ = run([(3, None, "A")])
    assert (3, None, "A") in by_key


def test_merge_reads_the_table_once(spark, folder):
    from lakeloom.operators.incremental import merge

    spark.range(1000).selectExpr("id as k", "id as at", "'x' as wide").write.parquet(f"{folder}/base")
    base = spark.read.parquet(f"{folder}/base")
    delta = spark.createDataFrame([(1, 5000, "new"), (2, -1, "old"), (5000, 1, "added")], "k bigint, at bigint, wide string")
    merged = merge(base, delta, ["k"], ["at"])
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    scans = [line for line in plan.splitlines() if "Relation" in line and "parquet" in line]
    assert len(scans) == 2
    physical = merged._jdf.queryExecution().executedPlan().toString()
    assert physical.count("ReadSchema: struct<k:bigint,at:bigint,wide:string>") == 1
    assert physical.count("ReadSchema: struct<k:bigint>") == 1
    rows = {r.k: (r.at, r.wide) for r in merged.collect()}
    assert len(rows) == 1001 and rows[1] == (5000, "new") and rows[2] == (2, "x") and rows[5000] == (1, "added")


def test_raw_files_are_compressed_and_read_back(spark, folder):
    lake = Lake(spark, folder)
    rows = spark.range(20000).select("id", F.lit("some text").alias("label"))
    for _ in range(2):
        lake.write_bronze(rows, "t")
    parts = list(Path(lake.path("bronze", "t")).rglob("part-*"))
    assert parts and sum(f.stat().st_size for f in parts) < 20 * 2 * 20000
    back = lake.read_bronze("t", "id bigint, label string")
    assert back.count() == 40000
    assert back.select(F.sum("id")).first()[0] == 2 * sum(range(20000))
