"""Confusion counts and everything that follows from them.

Rows are touched once, by a grouped count. Metrics read that small table: at most
labels x labels rows per group, whatever the number of predictions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from triagelake import constants as C
from triagelake.functions import scalars as S
from triagelake.session import materialise

DRAWS_PER_TASK_ROW = 10_000


def outcomes(predictions: DataFrame) -> DataFrame:
    """Wide predictions -> target, true_label, pred_label."""
    pairs = F.array(*[
        F.struct(F.lit(t).alias("target"), F.col(f"true_{t}").alias("true_label"), F.col(f"pred_{t}").alias("pred_label"))
        for t in ("issuetype", "resolution")
    ])
    return predictions.select(F.inline(pairs))


def confusion(rows: DataFrame, by: Sequence[str] = ("target",)) -> DataFrame:
    return rows.groupBy(*by, "true_label", "pred_label").agg(F.count("*").alias("n"))


def confusion_matrix(rows: DataFrame, labels: Sequence[str]) -> DataFrame:
    """True label x one column per predicted label, 0-filled."""
    return rows.groupBy("true_label").pivot("pred_label", list(labels)).count().na.fill(0)


def per_class(
    counts: DataFrame, by: Sequence[str] = ("target",), labels: str = "true", undefined: str = "null"
) -> DataFrame:
    """tp, fp, fn, support, precision, recall, f1 per label, unrounded.

    ``labels``: 'true' (labels that occur as truth) or 'union' (also those only
    predicted). ``undefined``: a score without denominator is 'null' or 'zero'."""
    sides = F.array(
        F.struct(F.col("true_label").alias("label"), F.lit(1).alias("is_true")),
        F.struct(F.col("pred_label").alias("label"), F.lit(0).alias("is_true")),
    )
    hit = F.col("true_label") == F.col("pred_label")
    own = F.col("is_true") == 1

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    classes = (
        counts.withColumn("_side", F.explode(sides))
        .select(*by, "true_label", "pred_label", "n", "_side.*")
        .groupBy(*by, "label")
        .agg(
            total(own & hit).alias("tp"), total(~own & ~hit).alias("fp"),
            total(own & ~hit).alias("fn"), total(own).alias("support"),
        )
    )
    if labels == "true":
        classes = classes.where(F.col("support") > 0)
    precision = S.safe_ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = S.safe_ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    p, r = F.col("precision"), F.col("recall")
    scored = classes.withColumn("precision", precision).withColumn("recall", recall).withColumn(
        "f1", 2.0 * p * r / F.nullif(p + r, F.lit(0.0))
    )
    if undefined == "zero":
        for name in ("precision", "recall", "f1"):
            scored = scored.withColumn(name, F.coalesce(name, F.lit(0.0)))
    return scored


def summary(
    counts: DataFrame, by: Sequence[str] = ("target",), labels: str = "true", undefined: str = "null"
) -> DataFrame:
    """accuracy, macro and support-weighted F1, rows, per group."""
    n_right = F.sum("tp")
    return per_class(counts, by, labels, undefined).groupBy(*by).agg(
        S.safe_ratio(n_right, F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("macro_f1"),
        S.safe_ratio(F.sum(F.coalesce("f1", F.lit(0.0)) * F.col("support")), F.sum("support")).alias("weighted_f1"),
        F.sum("support").alias("n_total"),
    )


def target_status(summary_rows: DataFrame) -> DataFrame:
    """Accuracy in percent against the target of its label kind."""
    goal = None
    for target, value in C.ACCURACY_TARGETS.items():
        goal = (F if goal is None else goal).when(F.col("target") == target, value)
    percent = S.round_half_up(F.col("accuracy") * 100.0, 2)
    return summary_rows.select(
        "target", percent.alias("accuracy_pct"), S.round_half_up(F.col("macro_f1"), 4).alias("macro_f1"),
        S.round_half_up(F.col("weighted_f1"), 4).alias("weighted_f1"), "n_total",
        F.when(percent >= goal, "OK").otherwise("BELOW_TARGET").alias("target_status"),
    )


def routing_share(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows and percent of all rows per routing combination. The total is taken over the
    counts, a few rows, so the input is planned once."""
    counts = rows.groupBy(*columns).agg(F.count("*").alias("n_tickets"))
    everything = F.sum("n_tickets").over(Window.partitionBy())
    return counts.withColumn("pct", S.pct(F.col("n_tickets"), everything, 1))


def draw_index(replicate: Column, draw: Column, n: Column) -> Column:
    """Hash-derived draw in [0, n): the same in every engine."""
    digits = F.substring(F.md5(F.concat_ws(":", replicate, draw)), 1, 15)
    return F.conv(digits, 16, 10).cast("bigint") % n


def bootstrap_macro_f1(
    counts: DataFrame, by: Sequence[str] = ("target",), replicates: int = C.BOOTSTRAP_REPLICATES,
    labels: str = "union",
) -> DataFrame:
    """2.5 / 50 / 97.5 percentiles of macro F1 over resamples with replacement.

    Rows with the same truth and prediction are interchangeable, so a draw in
    [0, n) is looked up in the running totals of the confusion cells instead of
    in the rows. Draws are made in short runs spread over the cluster and counted
    per cell where they are made. Labels of a group stay fixed over its
    replicates; one that was not drawn scores 0. The counts are read several times,
    so they are stored first: a few rows, instead of the whole job before them."""
    counts = materialise(counts, "confusion")
    order = Window.partitionBy(*by).orderBy("true_label", "pred_label")
    cells = counts.withColumn("_hi", F.sum("n").over(order)).withColumn(
        "_cell", F.row_number().over(order) - 1
    )
    groups = cells.groupBy(*by).agg(
        F.sort_array(F.collect_list("_hi")).alias("_bounds"), F.sum("n").alias("_n")
    )
    runs = groups.withColumn("replicate", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1)))).withColumn(
        "_from", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1, F.lit(DRAWS_PER_TASK_ROW).cast("bigint")))
    ).repartition("replicate", "_from")
    upto = F.least(F.col("_from") + DRAWS_PER_TASK_ROW, F.col("_n")) - 1

    # drawn first, looked up second: inside one lambda every comparison would hash again
    at = F.transform(F.sequence("_from", upto), lambda draw: draw_index(F.col("replicate"), draw, F.col("_n")))
    found = F.transform(at, lambda x: F.size(F.filter("_bounds", lambda hi: hi <= x)))

    drawn = (
        runs.select(*by, "replicate", F.explode(found).alias("_cell"))
        .groupBy(*by, "replicate", "_cell")
        .agg(F.count("*").alias("n"))
        .join(cells.select(*by, "_cell", "true_label", "pred_label"), [*by, "_cell"])
    )
    scored = per_class(drawn, [*by, "replicate"], "union", "zero")
    universe = per_class(counts, by, labels, "zero").select(*by, "label")
    sizes = universe.groupBy(*by).agg(F.count("*").alias("_classes"))
    macro = (
        scored.join(universe, [*by, "label"], "left_semi")
        .groupBy(*by, "replicate")
        .agg(F.sum("f1").alias("_f1"))
        .join(sizes, list(by))
        .select(*by, (F.col("_f1") / F.col("_classes")).alias("macro_f1"))
    )
    marks = F.percentile("macro_f1", [0.025, 0.5, 0.975])
    return macro.groupBy(*by).agg(marks.alias("_p")).select(
        *by, *[S.round_half_up(F.col("_p")[i], 4).alias(n) for i, n in enumerate(("ci_low", "ci_mid", "ci_high"))]
    )
