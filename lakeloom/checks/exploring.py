"""Exploratory queries on labelled documents."""

from lakeloom.checks.registry import check, having, ratio
from lakeloom.operators.relational import condition_effects, rate_by_value
from lakeloom.plans import explore


@check(
    "common_value_by_group",
    having("cases")
    + """select group_start, lang, n from (
        select (n_chars // 500) * 500 as group_start, lang, count(*) as n from cases group by 1, 2)
    qualify row_number() over (partition by group_start order by n desc, lang) = 1""",
)
def common_value_by_group(d):
    return explore.common_value_by_group(d.cases(), "n_chars", 500, "lang")


def _effect_sql(condition: str, column: str) -> str:
    crossed, against = "(positives_with * n_without)", "(positives_without * n_with)"
    return f"""select '{condition}' as condition, *,
        {ratio('positives_with', 'n_with', 4)} as rate_with,
        {ratio('positives_without', 'n_without', 4)} as rate_without,
        {ratio(crossed, against, 4)} as risk_ratio
    from (select count(*) filter (where {column} = 1) as n_with,
                 count(*) filter (where {column} = 1 and quality = 1) as positives_with,
                 count(*) filter (where {column} <> 1) as n_without,
                 count(*) filter (where {column} <> 1 and quality = 1) as positives_without
          from flagged)"""


@check(
    "condition_effect",
    having("cases")
    + """, flagged as (select *, case when n_chars >= 2000 then 1 else 0 end as hypertension from cases)
    """
    + _effect_sql("toxic", "toxic")
    + "\nunion all\n"
    + _effect_sql("hypertension", "hypertension"),
)
def condition_effect(d):
    cases = explore.with_hypertension(d.cases(), "n_chars", 2000)
    return condition_effects(cases, ["toxic", "hypertension"], "quality")


@check(
    "outcome_rate_by_source",
    having("cases")
    + f"""select source, toxic, n, positives, {ratio('positives', 'n', 4)} as rate
    from (select source, cast(toxic as bigint) as toxic, count(quality) as n,
                 cast(sum(quality) as bigint) as positives from cases group by 1, 2)""",
)
def outcome_rate_by_source(d):
    return rate_by_value(d.cases(), ["source", "toxic"], "quality")


# The data part of the model: which cases are learnt from and which are judged.
@check(
    "outcome_split",
    having("cases")
    + """select case when (doc_id % 100 * 37) % 100 < 80 then 'train' else 'test' end as split,
        cast(quality as bigint) as quality, count(*) as n from cases group by 1, 2""",
)
def outcome_split(d):
    return explore.split_counts(d.cases(), "doc_id", "quality")


# Model training has no SQL form.
@check("outcome_model")
def outcome_model(d):
    return explore.outcome_model(
        d.cases(), "doc_id", ["n_chars", "toxic"], ["lang", "source"], "quality"
    )
