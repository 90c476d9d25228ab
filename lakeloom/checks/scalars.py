"""Scalar functions."""

from lakeloom.checks.registry import check, day, having
from lakeloom.functions.dates import days_between, fractional_days, previous_month
from lakeloom.functions.text import EMAIL_PATTERN, capitalise, is_email, tokens, words
from lakeloom.functions.money import money, rounded_ratio
from lakeloom.operators.relational import search_tokens
from pyspark.sql import functions as F

MAIL_SQL = """mails as (
    select c_custkey, lower(trim(case when c_custkey % 7 = 0 then ' C.' || c_custkey || ' at Example.com'
        else '  C.' || c_custkey || '@' || c_mktsegment || '.Example.com ' end)) as email from customer)"""


def _mails(d):
    key = F.col("c_custkey").cast("string")
    good = F.concat(F.lit("  C."), key, F.lit("@"), "c_mktsegment", F.lit(".Example.com "))
    bad = F.concat(F.lit(" C."), key, F.lit(" at Example.com"))
    raw = F.when(F.col("c_custkey") % 7 == 0, bad).otherwise(good)
    return d.raw("customer").select("c_custkey", F.lower(F.trim(raw)).alias("email"))


@check(
    "flt_03_email_pattern",
    f"with {MAIL_SQL} select c_custkey, email from mails where regexp_full_match(email, '{EMAIL_PATTERN}')",
)
def flt_03_email_pattern(d):
    return _mails(d).filter(is_email(F.col("email")))


@check(
    "fn_01_trim_case",
    """select s_suppkey, trim('  ' || s_name || ' ') as trimmed, lower(s_name) as low, upper(s_name) as up
    from supplier""",
)
def fn_01_trim_case(d):
    padded = F.concat(F.lit("  "), "s_name", F.lit(" "))
    return d.raw("supplier").select(
        "s_suppkey", F.trim(padded).alias("trimmed"), F.lower("s_name").alias("low"), F.upper("s_name").alias("up")
    )


@check(
    "fn_03_capitalise",
    "select p_partkey, upper(p_type[1]) || lower(p_type[2:]) as type_name, "
    "upper(p_name[1]) || lower(p_name[2:]) as part_name from part",
)
def fn_03_capitalise(d):
    return d.raw("part").select(
        "p_partkey",
        capitalise(F.col("p_type")).alias("type_name"),
        capitalise(F.col("p_name")).alias("part_name"),
    )


@check(
    "fn_04_concat",
    """select c_custkey, c_name || ', ' || nullif(c_mktsegment, 'BUILDING') as strict,
        concat_ws(', ', c_name, nullif(c_mktsegment, 'BUILDING')) as lenient from customer""",
)
def fn_04_concat(d):
    segment = F.nullif("c_mktsegment", F.lit("BUILDING"))
    return d.raw("customer").select(
        "c_custkey",
        F.concat(F.col("c_name"), F.lit(", "), segment).alias("strict"),
        F.concat_ws(", ", F.col("c_name"), segment).alias("lenient"),
    )


@check(
    "fn_05_words_per_document",
    "select doc_id, len(string_split(text, ' ')) as n_words from documents",
)
def fn_05_words_per_document(d):
    return d.raw("documents").select("doc_id", F.size(words(F.col("text"))).alias("n_words"))


@check(
    "fn_07_defaults",
    """select o_orderkey, coalesce(nullif(o_orderpriority, '5-LOW'), 'none') as priority,
        case when o_totalprice > 250000 then 'large' else 'small' end as size,
        coalesce(nullif(o_orderstatus, 'P'), 'G') as status from orders""",
)
def fn_07_defaults(d):
    return d.raw("orders").select(
        "o_orderkey",
        F.coalesce(F.nullif("o_orderpriority", F.lit("5-LOW")), F.lit("none")).alias("priority"),
        F.when(F.col("o_totalprice") > 250000, "large").otherwise("small").alias("size"),
        F.coalesce(F.nullif("o_orderstatus", F.lit("P")), F.lit("G")).alias("status"),
    )


@check(
    "fn_09_dates",
    f"""select o_orderkey, year(o_orderdate) as y, month(o_orderdate) as m,
        {day("date_trunc('month', o_orderdate) - interval 1 month")} as previous_start,
        {day("last_day(date_trunc('month', o_orderdate) - interval 1 month)")} as previous_end,
        {day('o_orderdate')} as order_day from orders""",
)
def fn_09_dates(d):
    start, end = previous_month(F.col("o_orderdate"))
    return d.raw("orders").select(
        "o_orderkey",
        F.year("o_orderdate").alias("y"),
        F.month("o_orderdate").alias("m"),
        start.alias("previous_start"),
        end.alias("previous_end"),
        F.to_date("o_orderdate").alias("order_day"),
    )


@check(
    "fn_12_day_differences",
    """select event_id, date_diff('day', timestamp '2024-01-01 18:00:00', ts) as whole_days,
        cast(epoch(date_trunc('second', ts))
             - epoch(timestamp '2024-01-01 18:00:00') as bigint) / 86400 as fraction
    from events""",
)
def fn_12_day_differences(d):
    start = F.lit("2024-01-01 18:00:00").cast("timestamp_ntz")
    return d.events().select(
        "event_id",
        days_between(F.col("ts"), start).alias("whole_days"),
        fractional_days(F.col("ts"), start).alias("fraction"),
    )


@check(
    "fn_14_arithmetic",
    """select l_orderkey, l_partkey, l_suppkey, cast(l_linenumber as bigint) as l_linenumber,
        l_orderkey % 7 as rest, cast(cast(l_extendedprice as decimal(18,2)) * cast(l_quantity as integer) as double) as gross,
        case when true then cast((2 * cast(cast(l_extendedprice as decimal(18,2)) * 100 as hugeint) + cast(l_quantity as hugeint))
             // (2 * cast(l_quantity as hugeint)) as double) / 100 end as unit_price,
        cast(l_quantity as bigint) - l_linenumber as difference
    from lineitem""",
)
def fn_14_arithmetic(d):
    quantity = F.col("l_quantity").cast("int")
    return d.raw("lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        (F.col("l_orderkey") % 7).alias("rest"),
        (money("l_extendedprice") * quantity).alias("gross"),
        rounded_ratio(money("l_extendedprice"), quantity).alias("unit_price"),
        (quantity - F.col("l_linenumber")).alias("difference"),
    )


@check(
    "fn_16_casts",
    """select event_id, try_cast(case when event_type = 'click' then event_type else cast(user_id as varchar) end
        as bigint) as maybe, cast(floor(value) as bigint) as whole from events""",
)
def fn_16_casts(d):
    mixed = F.when(F.col("event_type") == "click", F.col("event_type")).otherwise(F.col("user_id").cast("string"))
    return d.raw("events").select(
        "event_id", mixed.try_cast("bigint").alias("maybe"), F.floor("value").alias("whole")
    )


@check(
    "fn_18_json_fields",
    "select event_id, cast(json_extract(props, '$.k') as bigint) as k from events",
)
def fn_18_json_fields(d):
    return d.raw("events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@check(
    "fn_20_set_membership",
    """select p_partkey, len(string_split(p_name, ' ')) as n_features,
        list_contains(string_split(p_name, ' '), 'red') as has_red from part""",
)
def fn_20_set_membership(d):
    features = F.split("p_name", " ")
    return d.raw("part").select(
        "p_partkey",
        F.size(features).alias("n_features"),
        F.array_contains(features, "red").alias("has_red"),
    )


@check(
    "fn_21_search_tokens",
    """select token, count(*) as n_documents from (
        select distinct doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) as token
        from documents) where token <> '' group by 1""",
)
def fn_21_search_tokens(d):
    found = search_tokens(d.raw("documents"), "doc_id", ["text"])
    return found.groupBy("token").agg(F.count("*").alias("n_documents"))
