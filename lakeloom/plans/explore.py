"""Exploratory questions and a first outcome model on a table of cases."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.ranking import most_frequent, running_totals
from lakeloom.operators.relational import bucket
from lakeloom.session import materialize, scratch_path


def common_value_by_group(cases: DataFrame, group: str, width: int, value: str) -> DataFrame:
    """Most frequent category per numeric group (e.g. per age group of ten years)."""
    grouped = cases.select(bucket(group, width).alias("group_start"), value)
    return most_frequent(grouped, ["group_start"], value).orderBy("group_start")


def with_hypertension(cases: DataFrame, pressure: str = "systolic", limit: int = 140) -> DataFrame:
    """Add a 0/1 flag for high blood pressure."""
    return cases.withColumn("hypertension", (F.col(pressure) >= limit).cast("int"))


def split_cases(cases: DataFrame, key: str, train_pct: int = 80) -> tuple[DataFrame, DataFrame]:
    """Reproducible split by a whole-number key, independent of row order.

    A prime multiple modulo 100 spreads neighbouring keys; a NULL key is unseen.
    """
    slot = F.coalesce(F.pmod(F.col(key).cast("bigint") % 100 * 37, F.lit(100)), F.lit(99))
    return cases.filter(slot < train_pct), cases.filter(slot >= train_pct)


def split_counts(cases: DataFrame, key: str, outcome: str) -> DataFrame:
    """Cases per split and outcome, as the model uses them."""
    train, test = split_cases(cases, key)
    both = train.withColumn("split", F.lit("train")).unionByName(
        test.withColumn("split", F.lit("test"))
    )
    return both.groupBy("split", outcome).agg(F.count("*").alias("n"))


def area_under_curve(scored: DataFrame, score: str, label: str) -> DataFrame:
    """Probability that a positive case scores above a negative one (ties count half).

    Exact, from the running counts over distinct scores; NULL without both
    kinds of cases.
    """
    positive = F.sum(F.col(label).cast("bigint"))
    run = running_totals(scored, score, {"_pos": positive, "_neg": F.count("*") - positive})
    pairs = run.totals["_pos"] * run.totals["_neg"]
    ahead = F.col("_pos_before") * 2 + F.col("_pos")
    won = F.sum(F.col("_neg").cast("decimal(19,0)") * ahead.cast("decimal(19,0)"))
    return run.table.agg((won.cast("double") / F.lit(2.0 * pairs if pairs else None)).alias("auc"))


def outcome_model(cases: DataFrame, key: str, numeric: Sequence[str], categorical: Sequence[str],
                  outcome: str, iterations: int = 50) -> DataFrame:
    """Train a logistic regression and report its quality on unseen cases, as one row.

    A missing number counts as the training cases' mean, a missing category as one of its
    own, so every case with an outcome is used; cases without one are counted apart.
    Jobs run while the plan is built.
    """
    typed = cases.withColumns(
        {"label": F.col(outcome).cast("double"), **{c: F.col(c).cast("double") for c in numeric}}
    )
    judged = typed.filter("label is not null")
    train, test = split_cases(judged, key)
    filled = [f"_{c}_filled" for c in numeric]
    indexed = [f"_{c}_index" for c in categorical]
    encoded = [f"_{c}_code" for c in categorical]
    stages = [
        StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, handleInvalid="keep"),
        Imputer(inputCols=list(numeric), outputCols=filled, strategy="mean"),
        VectorAssembler(inputCols=[*filled, *encoded], outputCol="_raw", handleInvalid="error"),
        StandardScaler(inputCol="_raw", outputCol="features"),
        LogisticRegression(maxIter=iterations, regParam=0.01),
    ]
    # The stored model is used for scoring: a freshly trained one still refers to
    # its training session, which cannot be shipped to tasks once metrics were observed.
    stored = scratch_path(cases.sparkSession, "model")
    Pipeline(stages=stages).fit(train).write().save(stored)
    model = PipelineModel.load(stored)
    scores = materialize(
        model.transform(test).select(
            "label", "prediction", vector_to_array("probability")[1].alias("score")
        ),
        "scores",
    )
    auc = area_under_curve(scores, "score", "label").first()["auc"]
    without = typed.filter("label is null").count()
    right = F.avg((F.col("prediction") == F.col("label")).cast("double"))
    return scores.agg(
        F.count("*").alias("n_test"),
        right.alias("accuracy"),
        F.lit(auc).cast("double").alias("auc"),
        F.lit(without).cast("bigint").alias("n_without_outcome"),
    )
