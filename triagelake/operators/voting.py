"""Weighted votes over neighbours, confidence gates and label normalisation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagelake import constants as C
from triagelake.functions import scalars as S
from triagelake.functions import text as X
from triagelake.operators import grid

TARGETS = ("issuetype", "resolution")


def by_target(neighbours: DataFrame, targets: Sequence[str] = TARGETS) -> DataFrame:
    """One row per neighbour and target: both votes run as one job."""
    pairs = F.array(*[F.struct(F.lit(t).alias("target"), F.col(t).alias("label")) for t in targets])
    return neighbours.withColumn("_t", F.explode(pairs)).select(
        "*", "_t.target", "_t.label"
    ).drop("_t", *targets)


def class_weights(train: DataFrame, targets: Sequence[str] = TARGETS) -> DataFrame:
    """Balanced weights n / (classes * count) per target and label."""
    counts = by_target(train.select(*targets), targets).groupBy("target", "label").agg(F.count("*").alias("_n"))
    totals = counts.groupBy("target").agg(F.sum("_n").alias("_all"), F.count("*").alias("_classes"))
    return counts.join(totals, "target").select(
        "target", "label",
        (F.col("_all").cast("double") / (F.col("_classes") * F.col("_n"))).alias("multiplier"),
    )


def label_scores(
    neighbours: DataFrame, by: Sequence[str], weight: str = "weight", multipliers: DataFrame | None = None
) -> DataFrame:
    w = F.col(weight)
    if multipliers is not None:
        # a row per target and consolidated label
        neighbours = neighbours.join(F.broadcast(multipliers), ["target", "label"], "left")
        w = w * F.coalesce("multiplier", F.lit(1.0))
    return neighbours.groupBy(*by, "label").agg(
        S.round_half_up(F.sum(w), grid.SCORE_DECIMALS).alias("label_score"),
        F.min("rk").alias("best_rk"),
    )


def tally(scores: DataFrame, by: Sequence[str]) -> DataFrame:
    """Winner, its score, the runner-up's, the total and the number of labels. Equal
    scores go to the label of the best-ranked neighbour. A group has at most as
    many rows as there are labels."""
    order = F.sort_array(F.collect_list(F.struct(-F.col("label_score"), F.col("best_rk"), F.col("label"), F.col("label_score"))))
    return (
        scores.groupBy(*by)
        .agg(
            order.alias("_o"),
            S.round_half_up(F.sum("label_score"), grid.SCORE_DECIMALS).alias("total"),
            F.count("*").alias("div"),
        )
        .select(
            *by,
            F.col("_o")[0]["label"].alias("label"),
            F.col("_o")[0]["label_score"].alias("top1"),
            F.coalesce(F.get("_o", F.lit(1))["label_score"], F.lit(0.0)).alias("top2"),
            "total", "div",
        )
    )


def vote(
    neighbours: DataFrame, by: Sequence[str] = ("query_key", "target"), weight: str = "weight",
    multipliers: DataFrame | None = None,
) -> DataFrame:
    """Weighted vote with conf = s1/total and margin = (s1-s2)/total; a total that is
    not positive gives 0."""
    won = tally(label_scores(neighbours, by, weight, multipliers), by)
    positive = F.col("total") > 0
    return won.withColumn(
        "conf", F.when(positive, F.col("top1") / F.col("total")).otherwise(0.0)
    ).withColumn(
        "margin", F.when(positive, (F.col("top1") - F.col("top2")) / F.col("total")).otherwise(0.0)
    )


def margin_gate(conf: Column, margin: Column) -> Column:
    low_conf, low_margin = C.MARGIN_GATE
    return F.when((conf >= low_conf) & (margin >= low_margin), "DIRECT").otherwise("LLM_REQUIRED")


def diversity_gate(
    votes: DataFrame, gates: Mapping[str, tuple[float, int, float]] = C.DIVERSITY_GATES
) -> DataFrame:
    """The gate on share, number of labels and lead over the winner's own score."""
    share = S.safe_ratio(F.col("top1"), F.col("total"))
    lead = S.safe_ratio(F.col("top1") - F.col("top2"), F.col("top1"))
    passes = F.lit(False)
    for target, (conf, div, margin) in gates.items():
        passes = passes | (
            (F.col("target") == target) & (share >= conf) & (F.col("div") <= div) & (lead >= margin)
        )
    return votes.withColumn("conf", share).withColumn("margin", lead).withColumn(
        "method", F.when(passes, "DIRECT").otherwise("LLM")
    )


def predictions(votes: DataFrame, queries: DataFrame) -> DataFrame:
    """One row per query: truth, both predictions, confidence, margin and routing; NULL
    predictions for a query without neighbours."""
    def of(target: str, value: Column, name: str) -> Column:
        return F.max(F.when(F.col("target") == target, value)).alias(name)

    rounded = {n: S.round_half_up(F.col(n), 4) for n in ("conf", "margin")}
    route = margin_gate(F.col("conf"), F.col("margin"))
    wide = votes.groupBy("query_key").agg(
        *[of(t, F.col("label"), f"pred_{t}") for t in TARGETS],
        *[of(t, rounded["conf"], f"conf_{t}") for t in TARGETS],
        *[of(t, route, f"routing_{t}") for t in TARGETS],
        *[of(t, rounded["margin"], f"margin_{t}") for t in TARGETS],
    )
    truth = queries.select(
        F.col("key").alias("query_key"), F.col("issuetype").alias("true_issuetype"),
        F.col("resolution").alias("true_resolution"),
    )
    return truth.join(wide, "query_key", "left").select(
        F.col("query_key").alias("key"), "true_issuetype", "true_resolution", "pred_issuetype",
        "pred_resolution", "conf_issuetype", "conf_resolution", "routing_issuetype",
        "margin_issuetype", "routing_resolution", "margin_resolution", F.lit("").alias("fix_summary"),
    )


# --- answers of an external labeller ----------------------------------------------------


def nearest_label(answer: Column, labels: Sequence[str], ignore_case: bool = False) -> Column:
    """Valid label closest to free text: exact match first, then smallest edit
    distance on upper case, list order on ties. With ``ignore_case`` quotes are
    stripped and the exact match ignores case."""
    text = X.tidy_response(answer) if ignore_case else answer
    choices = []
    for place, label in enumerate(labels):
        same = (F.lower(text) == label.lower()) if ignore_case else (text == label)
        distance = F.levenshtein(F.upper(text), F.lit(label.upper())) + 1
        choices.append(F.struct(F.when(same, 0).otherwise(distance).alias("d"), F.lit(place).alias("p"), F.lit(label).alias("label")))
    return F.when(text.isNotNull(), F.array_min(F.array(*choices))["label"])


def apply_answers(
    votes: DataFrame, answers: DataFrame, by: Sequence[str] = ("query_key", "target"),
    gate: str = "method", ignore_case: bool = False,
) -> DataFrame:
    """Gated rows take the normalised answer, if one came; the rest keep the vote."""
    joined = votes.join(answers.select(*by, "answer"), list(by), "left")
    chosen = F.when(F.col(gate) == "DIRECT", F.col("label")).otherwise(F.coalesce("answer", "label"))
    resolution_order = C.RESOLUTIONS_BATCH_ORDER if ignore_case else C.RESOLUTIONS
    return joined.withColumn("_chosen", chosen).withColumn(
        "final_label",
        F.when(F.col("target") == "issuetype", nearest_label(F.col("_chosen"), C.ISSUE_TYPES, ignore_case))
        .otherwise(nearest_label(F.col("_chosen"), resolution_order, ignore_case)),
    ).drop("_chosen")
