"""Text vectors, prompt tables, external answers, summaries and triage reports."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagelake import constants as C
from triagelake.functions import scalars as S
from triagelake.functions import text as X
from triagelake.session import materialise, ship_package

#: Rows up to which a table of known size is sent to every task.
BROADCAST_ROWS = 100_000

Encoder = Callable[[list[str]], np.ndarray]
Responder = Callable[[list[str]], list[str | None]]

# --- vectors from text ------------------------------------------------------------


def embed(
    df: DataFrame, text: str, make_encoder: Callable[[], Encoder], max_chars: int | None = None,
    prefix: str = "", name: str = "vector",
) -> DataFrame:
    """key and unit vector of a text by a caller's model, loaded once per task and
    fed in Arrow batches."""
    value = F.coalesce(F.col(text), F.lit(""))
    if max_chars:
        value = F.substring(value, 1, max_chars)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = None
        for batch in batches:
            encoder = encoder or make_encoder()
            v = np.asarray(encoder(batch["_text"].tolist()), dtype=np.float32).reshape(len(batch), -1)
            norm = np.linalg.norm(v, axis=1, keepdims=True)
            v = np.divide(v, norm, out=np.zeros_like(v), where=norm > 0)
            yield pd.DataFrame({"key": batch["key"], name: list(v)})

    ship_package(df.sparkSession)
    return df.select("key", X.with_query_prefix(value, prefix).alias("_text")).mapInPandas(
        run, f"key string, {name} array<float>"
    )


def term_bucket(term: Column, dims: int) -> Column:
    return (F.conv(F.substring(F.md5(term), 1, 8), 16, 10).cast("bigint") % dims).cast("int")


def hashed_weights(df: DataFrame, text: str, dims: int = 256) -> DataFrame:
    """Default vectors without a model: words hashed to ``dims`` buckets, tf-idf
    weights, unit length; non-zero entries as key, bucket, weight. Texts are spread
    by key once; counting, weighting and the norm then stay where the text is. The
    counts are stored (a job), as the idf needs them too. The idf table has at most
    ``dims`` rows; up to ``BROADCAST_ROWS`` it goes to every task."""
    counts = materialise(
        df.select("key", text).repartition("key")
        .select("key", F.explode(X.tokens(F.col(text))).alias("_term"))
        .groupBy("key", term_bucket(F.col("_term"), dims).alias("bucket"))
        .agg(F.count("*").alias("tf")),
        "bucket-counts",
    )
    n = df.agg(F.count("*")).scalar()
    idf = counts.groupBy("bucket").agg(F.count("*").alias("df")).select(
        "bucket", F.log((n + 1.0) / (F.col("df") + 1.0)).alias("idf")
    )
    weighted = counts.join(F.broadcast(idf) if dims <= BROADCAST_ROWS else idf, "bucket").withColumn("w", F.col("tf") * F.col("idf"))
    packed = weighted.groupBy("key").agg(
        F.collect_list(F.struct("bucket", "w")).alias("_e"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("_norm")
    )
    return packed.select("key", "_norm", F.inline("_e")).select(
        "key", "bucket", S.safe_ratio(F.col("w"), F.col("_norm")).alias("weight")
    ).where(F.col("weight") != 0)


def hashed_vectors(df: DataFrame, text: str, dims: int = 256, name: str = "vector") -> DataFrame:
    """Dense form of ``hashed_weights``; a text without words gives the zero vector."""
    entries = hashed_weights(df, text, dims).groupBy("key").agg(
        F.map_from_entries(F.collect_list(F.struct("bucket", "weight"))).alias("_m")
    )
    dense = F.transform(
        F.sequence(F.lit(0), F.lit(dims - 1)), lambda i: F.coalesce(F.try_element_at("_m", i), F.lit(0.0))
    )
    return df.select("key").join(entries, "key", "left").select("key", dense.alias(name))


# --- which vectors are stale ---------------------------------------------------------


def text_hashes(df: DataFrame, text: str) -> DataFrame:
    return df.select("key", F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("text_hash"))


def stale_rows(hashes: DataFrame, cache: DataFrame, model: str) -> DataFrame:
    """New or changed rows, or rows encoded by another model."""
    known = cache.where(F.col("model") == model).select("key", "text_hash")
    return hashes.join(known, ["key", "text_hash"], "left_anti")


def corpus_fingerprint(hashes: DataFrame, model: str) -> DataFrame:
    """model, n_rows and a hash that does not depend on row order: digests of key and
    text hash are summed piece by piece, which needs no sort and no single task."""
    of_row = F.sha2(F.concat_ws(":", F.coalesce("key", F.lit("")), "text_hash"), 256)
    sums = [
        F.coalesce(F.sum(F.conv(F.substring("_h", at, 8), 16, 10).cast("decimal(28,0)")), F.lit(0)).cast("decimal(38,0)").cast("string")
        for at in range(1, 65, 8)
    ]
    return hashes.withColumn("_h", of_row).agg(
        F.count("*").alias("n_rows"), F.substring(F.sha2(F.concat_ws(":", *sums), 256), 1, 16).alias("corpus_hash")
    ).select(F.lit(model).alias("model"), "n_rows", "corpus_hash")


# --- prompts -----------------------------------------------------------------------------

DOMAIN = "software project"
# sections of a root-cause summary
CAUSE_FIELDS = ["CONTEXT", "SYMPTOMS", "TECHNICAL_DETAIL", "AFFECTED_AREA", "EVIDENCE", "ACTION"]


def _lines(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def cause_prompt(text: Column, domain: str = DOMAIN) -> Column:
    return _lines(
        f"Summarise this {domain} ticket from the facts it states, under these headings, one or two "
        "sentences each, without naming its type or outcome: " + ", ".join(CAUSE_FIELDS) + ".\n\n"
        "TICKET\n", text,
    )


def joined_neighbours(
    neighbours: DataFrame, line: Column, first: int, sep: str, name: str, cut: int | None = None
) -> DataFrame:
    """Lines of the first neighbours of a query in rank order: at most ``first``."""
    rows = neighbours.where(F.col("rk") <= first).select("query_key", "rk", line.alias("_line"))
    text = F.array_join(
        F.transform(F.sort_array(F.collect_list(F.struct("rk", "_line"))), lambda s: s["_line"]), sep
    )
    return rows.groupBy("query_key").agg((F.substring(text, 1, cut) if cut else text).alias(name))


def candidate_lines(scores: DataFrame, first: int = 5) -> DataFrame:
    """Numbered label lines per query and target, best first."""
    order = F.sort_array(F.collect_list(F.struct(-F.col("label_score"), F.col("best_rk"), F.col("label"), F.col("label_score"))))
    lines = F.transform(
        F.slice(order, 1, first), lambda s, i: S.numbered_line(i + 1, s["label"], s["label_score"])
    )
    return scores.groupBy("query_key", "target").agg(F.array_join(lines, "\n").alias("candidates"))


def neighbour_line(chars: int) -> Column:
    return _lines("[", F.col("issuetype"), "/", F.col("resolution"), "]\n", S.excerpt(F.col("text_rich"), chars))


def label_prompts(
    votes: DataFrame, scores: DataFrame, neighbours: DataFrame, queries: DataFrame,
    gate: str = "method", domain: str = DOMAIN,
) -> DataFrame:
    """query_key, target, prompt for gated votes only: ranked candidates, five
    neighbours of 250 characters (1200 in all), 1500 characters of the ticket."""
    context = joined_neighbours(neighbours, neighbour_line(250), 5, "\n---\n", "context")
    ticket = queries.select(F.col("key").alias("query_key"), F.col("text_noco"))
    prompt = _lines(
        f"Choose the best label for this {domain} ticket.\n\nCANDIDATES\n", F.col("candidates"),
        "\n\nEVIDENCE\n", S.excerpt(F.col("context"), 1200), "\n\nTICKET\n", S.excerpt(F.col("text_noco"), 1500),
        "\n\nThe first candidate is usually right. Answer with one candidate label only.",
    )
    return (
        votes.where(F.col(gate) != "DIRECT").select("query_key", "target")
        .join(candidate_lines(scores), ["query_key", "target"])
        .join(context, "query_key")
        .join(ticket, "query_key")
        .select("query_key", "target", prompt.alias("prompt"))
    )


def list_prompts(
    votes: DataFrame, neighbours: DataFrame, queries: DataFrame, gate: str = "routing", domain: str = DOMAIN
) -> DataFrame:
    """Variant that offers the whole label list and shows ``[label] excerpt`` lines.
    ``neighbours`` has one row per neighbour and target."""
    rows = neighbours.where(F.col("rk") <= 5).select(
        "query_key", "target", "rk", _lines("[", F.col("label"), "] ", S.excerpt(F.col("text_noco"), 250)).alias("_line")
    )
    evidence = rows.groupBy("query_key", "target").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rk", "_line"))), lambda s: s["_line"]), "\n").alias("evidence")
    )
    labels = F.when(F.col("target") == "issuetype", ", ".join(C.ISSUE_TYPES)).otherwise(", ".join(C.RESOLUTIONS_BATCH_ORDER))
    ticket = queries.select(F.col("key").alias("query_key"), "text_noco")
    prompt = _lines(
        f"Pick one {domain} ", F.col("target"), " from: ", labels, "\n\nTICKET\n", S.excerpt(F.col("text_noco"), 1500),
        "\n\nSIMILAR\n", F.col("evidence"), "\n\nAnswer with the label only.",
    )
    return (
        votes.where(F.col(gate) != "DIRECT").select("query_key", "target")
        .join(evidence, ["query_key", "target"]).join(ticket, "query_key")
        .select("query_key", "target", prompt.alias("prompt"))
    )


def fix_prompts(predicted: DataFrame, neighbours: DataFrame, queries: DataFrame, domain: str = DOMAIN) -> DataFrame:
    """Prompt for the likely fix of every ticket: predicted labels, 1200 characters
    of the ticket, three neighbours of 400 characters (1500 in all)."""
    fixes = joined_neighbours(neighbours, neighbour_line(400), 3, "\n---\n", "fixes", 1500)
    ticket = queries.select(F.col("key").alias("query_key"), "text_noco")
    prompt = _lines(
        f"State the likely fix of this {domain} ticket in one or two sentences.\n\nTYPE ", F.col("issuetype"),
        "\nRESOLUTION ", F.col("resolution"), "\n\nTICKET\n", S.excerpt(F.col("text_noco"), 1200), "\n\nFIXED BEFORE\n", F.col("fixes"),
    )
    return predicted.select("query_key", "issuetype", "resolution").join(fixes, "query_key").join(ticket, "query_key").select(
        "query_key", prompt.alias("prompt")
    )


def summary_prompt(summary: Column, description: Column, comments: Column, resolution: Column, domain: str = DOMAIN) -> Column:
    """Prompt for the stored summary of a known ticket (300 / 1000 / 1500 characters)."""
    def part(x: Column, n: int) -> Column:
        return S.excerpt(F.coalesce(x, F.lit("")), n)

    return _lines(
        f"Summarise cause and resolution of this {domain} ticket in at most 250 characters.\n\nTICKET: ", part(summary, 300),
        "\nDESCRIPTION: ", part(description, 1000), "\nCOMMENTS: ", part(comments, 1500),
        "\nRESOLUTION: ", F.coalesce(resolution, F.lit("Unknown")),
    )


def answer(df: DataFrame, prompt: str, make_responder: Callable[[], Responder], name: str = "answer") -> DataFrame:
    """Adds a caller's answer per row; the responder is made once per task."""
    columns = [c for c in df.columns if c != prompt]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        responder = None
        for batch in batches:
            responder = responder or make_responder()
            out = batch[columns].copy()
            out[name] = responder(batch[prompt].tolist())
            yield out

    ship_package(df.sparkSession)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema if f.name != prompt)
    return df.mapInPandas(run, f"{fields}, {name} string")


# --- stored summaries --------------------------------------------------------------------


def split_by_cache(wanted: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with their cached summary, and rows without one."""
    hits = wanted.join(cache.select("key", "fix_summary"), "key")
    return hits, wanted.join(cache.select("key"), "key", "left_anti")


def missing_summaries(neighbours: DataFrame, corpus: DataFrame, cache: DataFrame, first: int = 5) -> DataFrame:
    """key, prompt of corpus tickets that occur among the first neighbours of any
    query and have no summary yet."""
    used = neighbours.where(F.col("rk") <= first).select("key").distinct()
    _, misses = split_by_cache(used, cache)
    prompt = summary_prompt(F.col("summary_clean"), F.col("description_clean"), F.col("comments_concat"), F.col("resolution"))
    return corpus.join(misses, "key", "left_semi").select("key", prompt.alias("prompt"))


def merged_cache(cache: DataFrame, prompts: DataFrame, make_responder: Callable[[], Responder]) -> DataFrame:
    """Cache plus new summaries cut to 250; unanswered ones stay missing."""
    fresh = answer(prompts, "prompt", make_responder, "fix_summary").where(F.col("fix_summary").isNotNull())
    return cache.select("key", "fix_summary").unionByName(
        fresh.select("key", S.excerpt(F.col("fix_summary"), 250).alias("fix_summary"))
    )


# --- triage report -----------------------------------------------------------------------


def whole_percent(x: Column) -> Column:
    return F.concat(S.round_half_up(x * 100.0, 0).cast("int").cast("string"), F.lit("%"))


#: Where a ticket goes and what comes next, unless the caller has tables of their own.
ROUTES = [("Bug", "Repair queue"), ("Question", "Support desk")]
ROUTE_ELSE = "Planning board"
STEPS = [("Fixed", "Plan the change."), ("Duplicate", "Look for the earlier ticket.")]
STEP_ELSE = "Read the evidence and decide."


def guidance(label: Column, table: Sequence[tuple[str, str]], default: str) -> Column:
    """Guidance of a label from a table of a few rows."""
    out = None
    for name, text in table:
        out = (F if out is None else out).when(label == name, text)
    return out.otherwise(default)


def analysis_sentence(issuetype: Column, conf_type: Column, conf_resolution: Column, key: Column, sim: Column, resolution: Column) -> Column:
    """Plain sentence used where no external analysis is available."""
    tail = F.when(conf_resolution >= C.CONFIDENCE_BANDS[0], "Past tickets strongly support this.").otherwise(
        "Check the evidence before acting."
    )
    return _lines(
        "Classified as ", issuetype, " with ", whole_percent(conf_type), " confidence. Closest ticket ", key, " (",
        whole_percent(sim), " similar) was resolved as ", resolution, ". ", tail,
    )


def triage_report(
    predicted: DataFrame, neighbours: DataFrame, cache: DataFrame | None = None,
    routes: tuple[Sequence[tuple[str, str]], str] = (ROUTES, ROUTE_ELSE),
    steps: tuple[Sequence[tuple[str, str]], str] = (STEPS, STEP_ELSE),
) -> DataFrame:
    """One row per ticket: prediction, bands, guidance, warning, analysis and the
    five nearest tickets as text."""
    rows = neighbours.where(F.col("rk") <= 5).withColumn("sim", S.round_half_up(F.col("weight"), 4))
    if cache is not None:
        rows = rows.join(cache.select("key", "fix_summary"), "key", "left")
        fix = F.when(F.col("fix_summary") != "", F.concat(F.lit(" fix: "), F.col("fix_summary")))
    else:
        fix = F.lit(None).cast("string")
    line = _lines(
        F.col("key"), " ", F.floor(F.col("sim") * 100.0).cast("string"), "% match [", F.col("issuetype"), " / ",
        F.col("resolution"), '] "', F.coalesce("summary_clean", F.lit("")), '"', F.coalesce(fix, F.lit("")),
    )
    lines = F.sort_array(F.collect_list(F.struct("rk", line.alias("line"), "key", "sim", "resolution")))
    evidence = rows.groupBy("query_key").agg(lines.alias("_e")).select(
        F.col("query_key").alias("key"), F.col("_e")[0].alias("_near"),
        F.array_join(F.transform("_e", lambda s: s["line"]), "\n").alias("evidence"),
    )
    it, res = F.col("pred_issuetype"), F.col("pred_resolution")
    ci, cr = F.col("conf_issuetype"), F.col("conf_resolution")
    low = C.CONFIDENCE_BANDS[1]
    return predicted.join(evidence, "key").select(
        "key", it.alias("issuetype"), S.confidence_band(ci).alias("issuetype_band"), "routing_issuetype",
        res.alias("resolution"), S.confidence_band(cr).alias("resolution_band"), "routing_resolution",
        S.flag((ci < low) | (cr < low)).alias("low_confidence"),
        guidance(it, *routes).alias("routing_guidance"),
        guidance(res, *steps).alias("next_step"),
        analysis_sentence(it, ci, cr, F.col("_near.key"), F.col("_near.sim"), F.col("_near.resolution")).alias("analysis"),
        "evidence",
    )


def valid_input(summary: Column, description: Column) -> Column:
    """Tickets with enough text to classify."""
    return (F.length(X.stripped(summary)) >= 10) & (F.length(X.stripped(description)) >= 20)
