"""Imports, file formats and exports, each written and read back."""

from lakeloom.checks.registry import check, day, having
from lakeloom.functions.money import money
from lakeloom.plans import marts
from lakeloom.session import scratch_path
from lakeloom.sources import files
from lakeloom.sources.lake import Lake, export_text, write_csv
from lakeloom.sources.relational import FolderSource, TableStatus, import_all, import_table
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders"]


@check("src_01_table_scan", "select * from supplier")
def src_01_table_scan(d):
    return import_table(d.spark, FolderSource(d.folder), "supplier")


@check(
    "src_03_filtered_import",
    "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer where c_acctbal > 5000",
)
def src_03_filtered_import(d):
    return import_table(d.spark, FolderSource(d.folder), "customer", where="c_acctbal > 5000")


@check(
    "src_04_column_import",
    "select c_custkey, c_mktsegment from customer where c_acctbal > 5000",
)
def src_04_column_import(d):
    columns = ["c_custkey", "c_mktsegment"]
    return import_table(d.spark, FolderSource(d.folder), "customer", "c_acctbal > 5000", columns)


@check(
    "src_05_import_all",
    " union all ".join(f"select '{t}' as table_name, true as ok, count(*) as n_rows from {t}" for t in TABLES)
    + " union all select 'absent', false, 0",
)
def src_05_import_all(d):
    lake = Lake(d.spark, scratch_path(d.spark, "import"))

    def write(df, table):
        done = lake.write_silver(df, table)
        return TableStatus(table, ok=True, rows=done.rows, path=done.path)

    status = import_all(d.spark, FolderSource(d.folder, [*TABLES, "absent"]), write)
    rows = [(s.table, s.ok, s.rows) for s in status]
    reported = d.spark.createDataFrame(rows, "table_name string, ok boolean, n_rows bigint")
    # Read every imported table back; the report must agree with what is stored.
    stored = None
    for s in status:
        if s.ok:
            one = lake.read_silver(s.table).agg(F.lit(s.table).alias("table_name"), F.count("*").alias("stored"))
            stored = one if stored is None else stored.unionByName(one)
    agreed = reported.join(stored, "table_name", "left")
    return agreed.select("table_name", "ok", F.coalesce("stored", "n_rows").alias("n_rows"))


@check(
    "src_06_csv_with_schema",
    f"""select l_orderkey as order_id, {day('l_shipdate')} as ship_date, cast(l_quantity as bigint) as quantity,
        cast(cast(l_extendedprice as decimal(18,2)) as double) as price from lineitem""",
)
def src_06_csv_with_schema(d):
    path = scratch_path(d.spark, "csv")
    write_csv(
        d.raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.to_date("l_shipdate").alias("ship_date"),
            F.col("l_quantity").cast("int").alias("quantity"),
            money("l_extendedprice").alias("price"),
        ),
        path,
    )
    schema = "order_id bigint, ship_date date, quantity int, price decimal(18,2)"
    return files.read_csv(d.spark, path, schema)


@check(
    "src_07_csv_quoted",
    """select c_custkey as customer_id, c_name || ', ' || c_mktsegment || ' "Ltd"' as company_name,
        c_acctbal as balance from customer""",
)
def src_07_csv_quoted(d):
    path = scratch_path(d.spark, "csv")
    company = F.concat("c_name", F.lit(", "), "c_mktsegment", F.lit(' "Ltd"'))
    rows = d.raw("customer").select(
        F.col("c_custkey").alias("Customer Id"), company.alias("Company Name"), F.col("c_acctbal").alias("Balance")
    )
    rows.write.option("header", True).option("escape", '"').csv(path)
    return files.read_csv(d.spark, path, snake_names=True).withColumn("customer_id", F.col("customer_id").cast("bigint"))


@check("src_08_json_scan", "select event_id, user_id, event_type, value, props from events")
def src_08_json_scan(d):
    path = scratch_path(d.spark, "json")
    d.events().drop("ts").write.json(path)
    schema = "event_id bigint, user_id bigint, event_type string, value double, props string"
    return files.read_json(d.spark, path, schema).drop(files.CORRUPT)


@check(
    "snk_02_csv_report",
    having("sales")
    + """select product, cast(sum(quantity) as bigint) as total_quantity,
        cast(sum(quantity * price) as double) as total_revenue from sales group by 1""",
)
def snk_02_csv_report(d):
    path = scratch_path(d.spark, "report")
    write_csv(marts.product_sales(d.sales()), path, single_file=True, sort_by=[F.desc("total_revenue"), "product"])
    return files.read_csv(d.spark, path, "product string, total_quantity bigint, total_revenue decimal(28,2)")


@check(
    "snk_09_text_export",
    """select cast(c_custkey as varchar) as c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), 'none given') as segment,
        coalesce(cast(nullif(c_nationkey, 3) as varchar), '-1') as nation from customer""",
)
def snk_09_text_export(d):
    path = scratch_path(d.spark, "text")
    rows = d.raw("customer").select(
        "c_custkey",
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
        F.nullif("c_nationkey", F.lit(3)).alias("nation"),
    )
    export_text(rows, path, null_string="none given", null_non_string="-1")
    return files.read_csv(d.spark, path, "c_custkey string, segment string, nation string")
