"""Registered queries: retrieval, votes, evaluation, comparisons, enrichment and
the streaming job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagelake import constants as C
from triagelake.functions import scalars as S
from triagelake.functions import text as X
from triagelake.operators import ablations as A
from triagelake.operators import enrichment as N
from triagelake.operators import evaluation as E
from triagelake.operators import features, lexical, retrieval, voting
from triagelake.plans import jobs, registry
from triagelake.plans.oracle_base import NL, block, case, clean, q, rnd, vote
from triagelake.plans.registry import long, query, rounded, sides, vectors
from triagelake.plans.tables import CACHE_SQL, _cache, scratch
from triagelake.session import materialise
from triagelake.sources import tables
from triagelake.sources.bindings import Tracker
from triagelake.streaming import scoring

METADATA = C.METADATA_WEIGHTS

# --- neighbours ---------------------------------------------------------------------------

query("m3_cosine_top15", lambda t: retrieval.top_k(*sides(t), "vec_a", C.FINAL_K).select(
    "query_key", "key", *rounded(6, "sim"), *long("rk")), f"""
SELECT query_key, key, {rnd('sim_a', 6)} AS sim, rk FROM (SELECT *, row_number() OVER (PARTITION BY query_key ORDER BY sim_a DESC, key) AS rk FROM pairs) WHERE rk <= 15
""")
block("boost15", f"""
SELECT query_key, key, score, rk FROM (SELECT *, row_number() OVER (PARTITION BY query_key ORDER BY score DESC, key) AS rk
FROM (SELECT *, {rnd('sim_a + b_priority + b_status + b_reporter', 9)} AS score FROM pairs)) WHERE rk <= 15
""")


def boosted(t: Tracker) -> DataFrame:
    return retrieval.top_k(*sides(t), "vec_a", C.FINAL_K, METADATA)


query("m4_boosted_top15", lambda t: boosted(t).select("query_key", "key", *rounded(6, "score"), *long("rk")),
      f"SELECT query_key, key, {rnd('score', 6)} AS score, rk FROM boost15")
query("j7_query_corpus", lambda t: retrieval.top_k(*sides(t), "vec_b", 5).select("query_key", "key", *rounded(6, "sim"), *long("rk")), f"""
SELECT query_key, key, {rnd('sim_b', 6)} AS sim, rk FROM (SELECT *, row_number() OVER (PARTITION BY query_key ORDER BY sim_b DESC, key) AS rk FROM pairs) WHERE rk <= 5
""")
query("h4_vector_cosine", lambda t: vectors(t).select("key", retrieval.cosine(F.col("vec_a"), F.col("vec_b")).alias("c")).select("key", *rounded(6, "c")),
      f"SELECT key, {rnd(rnd('list_inner_product(vec_a, vec_b)', 9), 6)} AS c FROM vectors")
query("w5_top_k_per_group", lambda t: retrieval.top_k(*sides(t), "vec_b", C.FINAL_K, {"priority": 0.1}).select("query_key", "key", *long("rk")), f"""
SELECT query_key, key, rk FROM (SELECT *, row_number() OVER (PARTITION BY query_key ORDER BY {rnd('sim_b + b_priority', 9)} DESC, key) AS rk FROM pairs) WHERE rk <= 15
""")
query("m5_rrf_top30", lambda t: retrieval.rrf_top(*sides(t)).select("query_key", "key", *long("rank_a", "rank_b", "rk"), *rounded(9, "rrf"), *rounded(6, "sim_a", "sim_b")), f"""
SELECT query_key, key, rank_a, rank_b, rk, {rnd('rrf', 9)} AS rrf, {rnd('sim_a', 6)} AS sim_a, {rnd('sim_b', 6)} AS sim_b FROM rrf30
""")


def ranked(t: Tracker, scaled: bool = True) -> DataFrame:
    queries, corpus = sides(t)
    return retrieval.rerank(retrieval.rrf_top(queries, corpus), queries, corpus, scaled)


query("m6_metadata_boost", lambda t: ranked(t).select("query_key", "key", *rounded(6, "metadata")), f"SELECT query_key, key, {rnd('metadata', 6)} AS metadata FROM boosted_pairs")


def _scaler(t: Tracker) -> DataFrame:
    _, corpus = sides(t)
    fitted = corpus.limit(0).agg(F.count("*")).select(retrieval.fit_scaler(corpus).alias("s"))
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"s.mean_{c}").alias("mean"), F.col(f"s.std_{c}").alias("std")) for c in C.CHANGE_FEATURES])
    return fitted.select(F.inline(rows)).select("feature", *rounded(6, "mean", "std"))


query("m7_scaler", _scaler, " UNION ALL ".join(f"SELECT {q(c)} AS feature, {rnd(f'mean_{c}', 6)} AS mean, {rnd(f'std_{c}', 6)} AS std FROM scaler" for c in C.CHANGE_FEATURES))


def _both_similarities(t: Tracker) -> DataFrame:
    queries, corpus = sides(t)
    pairs = retrieval.with_both_sides(retrieval.rrf_top(queries, corpus), queries, corpus)
    return pairs.select("query_key", "key", retrieval.change_similarity(retrieval.fit_scaler(corpus)).alias("scaled"),
                        retrieval.change_similarity().alias("raw")).select("query_key", "key", *rounded(6, "scaled", "raw"))


query("m8_change_similarity", _both_similarities, f"SELECT query_key, key, {rnd('change_sim', 6)} AS scaled, {rnd('change_sim_raw', 6)} AS raw FROM boosted_pairs")
query("m9_fused", lambda t: ranked(t).select("query_key", "key", *rounded(6, "score")), f"SELECT query_key, key, {rnd('score', 6)} AS score FROM fused_rows")
query("m10_retrieve_top15", lambda t: retrieval.retrieve(*sides(t)).select("query_key", "key", *long("rk"), *rounded(6, "score", "weight")), f"""
SELECT query_key, key, rk, {rnd('score', 6)} AS score, {rnd('weight', 6)} AS weight FROM weighted_rows
""")

# --- votes --------------------------------------------------------------------------------------


def neighbours(t: Tracker) -> DataFrame:
    return retrieval.retrieve(*sides(t))


def votes(t: Tracker) -> DataFrame:
    return voting.vote(voting.by_target(neighbours(t)))


def predicted(t: Tracker) -> DataFrame:
    return voting.predictions(votes(t), sides(t)[0])


query("m11_weighted_vote", lambda t: votes(t).select("query_key", "target", "label", *rounded(6, "conf", "margin")),
      f"SELECT query_key, target, label, {rnd('conf', 6)} AS conf, {rnd('margin', 6)} AS margin FROM gated_votes")
query("m12_class_weights", lambda t: voting.class_weights(sides(t)[1]).select("target", "label", *rounded(6, "multiplier")), f"""
SELECT target, label, {rnd('sum(n) OVER (PARTITION BY target) / (count(*) OVER (PARTITION BY target) * n)::DOUBLE', 6)} AS multiplier FROM (
  SELECT 'issuetype' AS target, issuetype AS label, count(*) AS n FROM train_rows GROUP BY ALL
  UNION ALL SELECT 'resolution', resolution, count(*) FROM train_rows GROUP BY ALL)
""")
block("class_multipliers", """
SELECT target, label, sum(n) OVER (PARTITION BY target)::DOUBLE / (count(*) OVER (PARTITION BY target) * n) AS multiplier FROM (
  SELECT 'issuetype' AS target, issuetype AS label, count(*) AS n FROM train_rows GROUP BY ALL
  UNION ALL SELECT 'resolution', resolution, count(*) FROM train_rows GROUP BY ALL)
""")


def _class_weighted(t: Tracker) -> DataFrame:
    return voting.vote(voting.by_target(neighbours(t)), multipliers=voting.class_weights(sides(t)[1]))


query("m11_class_weighted_vote", lambda t: _class_weighted(t).select("query_key", "target", "label", *rounded(6, "conf")), f"""
SELECT query_key, target, label, {rnd('CASE WHEN total > 0 THEN top1 / total ELSE 0.0::DOUBLE END', 6)} AS conf FROM ({vote(
    '(SELECT n.query_key, n.target, n.label, n.rk, n.weight * m.multiplier AS weight FROM neighbours n JOIN class_multipliers m ON m.target = n.target AND m.label = n.label)', 'query_key, target')})
""")


def boosted_rows(t: Tracker) -> DataFrame:
    corpus = sides(t)[1].select("key", "issuetype", "resolution", "text_rich")
    return boosted(t).join(corpus, "key")


def boosted_scores(t: Tracker) -> DataFrame:
    return voting.label_scores(voting.by_target(boosted_rows(t)), ["query_key", "target"], "score")


def boosted_gate(t: Tracker) -> DataFrame:
    return voting.diversity_gate(voting.tally(boosted_scores(t), ["query_key", "target"]))


block("boost_neighbours", """
SELECT b.query_key, 'issuetype' AS target, t.issuetype AS label, b.score AS weight, b.rk FROM boost15 b JOIN train_rows t ON t.key = b.key
UNION ALL SELECT b.query_key, 'resolution', t.resolution, b.score, b.rk FROM boost15 b JOIN train_rows t ON t.key = b.key
""")
block("boost_votes", vote("boost_neighbours", "query_key, target"))
_gate_sql = " OR ".join(f"(target = {q(g)} AND conf >= {c} AND div <= {d} AND margin >= {m})" for g, (c, d, m) in C.DIVERSITY_GATES.items())
block("boost_gated", f"""
SELECT *, CASE WHEN {_gate_sql} THEN 'DIRECT' ELSE 'LLM' END AS method FROM (SELECT *, top1 / nullif(total, 0) AS conf, (top1 - top2) / nullif(top1, 0) AS margin FROM boost_votes)
""")
query("m13_diversity_vote", lambda t: boosted_gate(t).select("query_key", "target", "label", *long("div"), *rounded(6, "top1", "top2", "total")), f"""
SELECT query_key, target, label, div, {rnd('top1', 6)} AS top1, {rnd('top2', 6)} AS top2, {rnd('total', 6)} AS total FROM boost_votes
""")
query("m14_diversity_gate", lambda t: boosted_gate(t).select("query_key", "target", "label", "method", *rounded(6, "conf", "margin")), f"""
SELECT query_key, target, label, method, {rnd('conf', 6)} AS conf, {rnd('margin', 6)} AS margin FROM boost_gated
""")
query("m15_margin_gate", lambda t: votes(t).select("query_key", "target", voting.margin_gate(F.col("conf"), F.col("margin")).alias("routing")),
      "SELECT query_key, target, routing FROM gated_votes")
query("w6_label_rank", lambda t: boosted_scores(t).select("query_key", "target", "label", F.row_number().over(
    features.Window.partitionBy("query_key", "target").orderBy(F.desc("label_score"), "best_rk", "label")).cast("bigint").alias("rnk")), f"""
SELECT query_key, target, label, row_number() OVER (PARTITION BY query_key, target ORDER BY s DESC, b, label) AS rnk FROM (
  SELECT query_key, target, label, {rnd('sum(weight)', 9)} AS s, min(rk) AS b FROM boost_neighbours GROUP BY ALL)
""")
query("j11_runner_up", lambda t: boosted_gate(t).select("query_key", "target", *rounded(6, "top2")), f"SELECT query_key, target, {rnd('top2', 6)} AS top2 FROM boost_votes")
_PRED = ["key", "true_issuetype", "true_resolution", "pred_issuetype", "pred_resolution", "conf_issuetype", "conf_resolution",
         "routing_issuetype", "margin_issuetype", "routing_resolution", "margin_resolution", "fix_summary"]
query("m16_predictions", predicted, f"SELECT {', '.join(_PRED)} FROM predictions")
query("s13_predictions_sink", lambda t: tables.write_predictions(predicted(t), scratch(t, "sink")), f"SELECT {', '.join(_PRED)} FROM predictions")
query("p26_bands", lambda t: predicted(t).select("key", S.confidence_band(F.col("conf_issuetype")).alias("band_issuetype"), S.confidence_band(F.col("conf_resolution")).alias("band_resolution")), """
SELECT key, CASE WHEN conf_issuetype >= 0.65 THEN 'High' WHEN conf_issuetype >= 0.45 THEN 'Medium' ELSE 'Low' END AS band_issuetype,
  CASE WHEN conf_resolution >= 0.65 THEN 'High' WHEN conf_resolution >= 0.45 THEN 'Medium' ELSE 'Low' END AS band_resolution FROM predictions
""")

# --- words --------------------------------------------------------------------------------------


def _documents(t: Tracker) -> DataFrame:
    return t.table("documents").select(F.concat(F.lit("D-"), "doc_id").alias("key"), "text")


def _asked(t: Tracker) -> DataFrame:
    return t.table("benchmark").select(F.concat(F.lit("Q-"), "item_id").alias("key"), "text")


def _bm25_blocks(prefix: str, docs: str, asked: str) -> None:
    words = registry.WORDS
    block(f"{prefix}_docs", f"SELECT key, {words} AS w FROM ({docs})")
    block(f"{prefix}_tf", f"SELECT key, dl, term, count(*) AS tf FROM (SELECT key, len(w) AS dl, unnest(w) AS term FROM {prefix}_docs) GROUP BY ALL")
    block(f"{prefix}_stats", f"SELECT count(*) AS n, avg(len(w)) AS mean FROM {prefix}_docs")
    block(f"{prefix}_idf0", f"SELECT term, ln(n - df + 0.5::DOUBLE) - ln(df + 0.5::DOUBLE) AS raw FROM (SELECT term, count(*)::DOUBLE AS df FROM {prefix}_tf GROUP BY 1), {prefix}_stats")
    block(f"{prefix}_idf", f"SELECT term, CASE WHEN raw < 0 THEN (SELECT 0.25::DOUBLE * avg(raw) FROM {prefix}_idf0) ELSE raw END AS idf FROM {prefix}_idf0")
    block(f"{prefix}_asked", f"SELECT query_key, term, count(*) AS n FROM (SELECT key AS query_key, unnest({words}) AS term FROM ({asked})) GROUP BY ALL")
    block(f"{prefix}_hits", f"""
SELECT a.query_key, f.key, sum(a.n * i.idf * f.tf * 2.5::DOUBLE / (f.tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * f.dl / s.mean))) AS bm25
FROM {prefix}_asked a JOIN {prefix}_idf i ON i.term = a.term JOIN {prefix}_tf f ON f.term = a.term, {prefix}_stats s GROUP BY ALL""")
    block(f"{prefix}_ranked", f"""
SELECT *, row_number() OVER (PARTITION BY query_key ORDER BY bm25 DESC, key) AS rk FROM (
  SELECT q.key AS query_key, d.key, {rnd('coalesce(h.bm25, 0)', 9)} AS bm25 FROM ({asked}) q CROSS JOIN {prefix}_docs d
  LEFT JOIN {prefix}_hits h ON h.query_key = q.key AND h.key = d.key)""")


_bm25_blocks("bmd", "SELECT 'D-' || doc_id AS key, text FROM documents", "SELECT 'Q-' || item_id AS key, text FROM benchmark")
_bm25_blocks("bmt", "SELECT key, text_noco AS text FROM train_rows", "SELECT key, text_noco AS text FROM eval_rows")
query("m17_bm25", lambda t: lexical.bm25_top_k(lexical.tokenised(_asked(t), "text"), lexical.tokenised(_documents(t), "text"), C.FINAL_K).select(
    "query_key", "key", *rounded(6, "score"), *long("rk")), f"SELECT query_key, key, {rnd('bm25', 6)} AS score, rk FROM bmd_ranked WHERE rk <= 15")
query("m17_bm25_tickets", lambda t: lexical.bm25_top_k(*[lexical.tokenised(x, "text_noco") for x in sides(t)], C.FINAL_K).select(
    "query_key", "key", *rounded(6, "score"), *long("rk")), f"SELECT query_key, key, {rnd('bm25', 6)} AS score, rk FROM bmt_ranked WHERE rk <= 15")


def _scale(x: str) -> str:
    lo, hi = f"min({x}) OVER (PARTITION BY query_key)", f"max({x}) OVER (PARTITION BY query_key)"
    return f"CASE WHEN {hi} - {lo} < 1e-9 THEN 0.0::DOUBLE ELSE ({x} - {lo}) / ({hi} - {lo}) END"


block("hybrid_scaled", f"""
SELECT r.query_key, r.key, r.rrf, b.bm25, {_scale('r.rrf').replace('PARTITION BY query_key', 'PARTITION BY r.query_key')} AS e,
  {_scale('b.bm25').replace('PARTITION BY query_key', 'PARTITION BY r.query_key')} AS l
FROM rrf30 r JOIN bmt_ranked b ON b.query_key = r.query_key AND b.key = r.key
""")
block("hybrid15", f"""
SELECT query_key, key, score, bm25, rk FROM (SELECT *, row_number() OVER (PARTITION BY query_key ORDER BY score DESC, key) AS rk
FROM (SELECT *, {rnd('0.5::DOUBLE * e + 0.5::DOUBLE * l', 9)} AS score FROM hybrid_scaled)) WHERE rk <= 15
""")


def _hybrid(t: Tracker) -> DataFrame:
    queries, corpus = sides(t)
    return lexical.hybrid_top(retrieval.rrf_top(queries, corpus), queries, corpus)


query("m18_hybrid", lambda t: _hybrid(t).select("query_key", "key", *rounded(6, "score", "bm25"), *long("rk")),
      f"SELECT query_key, key, {rnd('score', 6)} AS score, {rnd('bm25', 6)} AS bm25, rk FROM hybrid15")


def _scaled(t: Tracker) -> DataFrame:
    queries, corpus = sides(t)
    scored = lexical.bm25_of_pairs(retrieval.rrf_top(queries, corpus), *[lexical.tokenised(x, "text_noco") for x in (queries, corpus)])
    return scored.withColumn("e", lexical.min_max("rrf")).withColumn("l", lexical.min_max("bm25")).select("query_key", "key", *rounded(6, "e", "l"))


query("a25_min_max", _scaled, f"SELECT query_key, key, {rnd('e', 6)} AS e, {rnd('l', 6)} AS l FROM hybrid_scaled")

# --- evaluation -----------------------------------------------------------------------------------

block("confusion_cells", "SELECT target, true_label, pred_label, count(*) AS n FROM outcomes GROUP BY ALL")


def counts(t: Tracker) -> DataFrame:
    return E.confusion(E.outcomes(predicted(t)))


query("a21_confusion", counts, "SELECT target, true_label, pred_label, n FROM confusion_cells")
query("a21_confusion_matrix", lambda t: E.confusion_matrix(E.outcomes(predicted(t)).where("target = 'issuetype'"), C.ISSUE_TYPES),
      "SELECT true_label, " + ", ".join(f"count(CASE WHEN pred_label = {q(x)} THEN 1 END) AS \"{x}\"" for x in C.ISSUE_TYPES) + " FROM outcomes WHERE target = 'issuetype' GROUP BY 1")
query("u3_label_union", lambda t: (lambda o: o.select("target", F.col("true_label").alias("label")).union(o.select("target", "pred_label")).distinct())(E.outcomes(predicted(t))),
      "SELECT target, true_label AS label FROM outcomes UNION SELECT target, pred_label FROM outcomes")


def class_sql(source: str, by: str, labels: str, undefined: str) -> str:
    """Per-class scores by the literal class x rows comparison."""
    universe = f"SELECT DISTINCT {by}, true_label AS label FROM {source}"
    if labels == "union":
        universe += f" UNION SELECT DISTINCT {by}, pred_label FROM {source}"
    keys = [k.strip() for k in by.split(",")]
    on = " AND ".join(f"o.{k} = c.{k}" for k in keys)
    group = ", ".join(f"c.{k}" for k in keys)
    inner = f"""SELECT {group}, c.label, sum(CASE WHEN pred_label = c.label AND true_label = c.label THEN o.n ELSE 0 END)::DOUBLE AS tp,
  sum(CASE WHEN pred_label = c.label AND true_label <> c.label THEN o.n ELSE 0 END)::DOUBLE AS fp,
  sum(CASE WHEN pred_label <> c.label AND true_label = c.label THEN o.n ELSE 0 END)::DOUBLE AS fn,
  sum(CASE WHEN true_label = c.label THEN o.n ELSE 0 END)::DOUBLE AS support FROM ({universe}) c JOIN {source} o ON {on} GROUP BY {group}, c.label"""
    scored = f"SELECT *, tp / nullif(tp + fp, 0) AS p, tp / nullif(tp + fn, 0) AS r FROM ({inner})"
    f1 = f"SELECT *, 2.0::DOUBLE * p * r / nullif(p + r, 0) AS f FROM ({scored})"
    if undefined == "zero":
        return f"SELECT * REPLACE (coalesce(p, 0) AS p, coalesce(r, 0) AS r, coalesce(f, 0) AS f) FROM ({f1})"
    return f1


def summary_sql(source: str, by: str, labels: str, undefined: str) -> str:
    return f"""SELECT {by}, sum(tp) / sum(support) AS accuracy, avg(f) AS macro_f1, sum(coalesce(f, 0) * support) / sum(support) AS weighted_f1,
  sum(support)::BIGINT AS n_total FROM ({class_sql(source, by, labels, undefined)}) GROUP BY ALL"""


_COUNTS = ["tp", "fp", "fn", "support"]
_COUNT_SQL = ", ".join(f"{c}::BIGINT AS {c}" for c in _COUNTS)
query("j10_class_counts", lambda t: E.per_class(counts(t), labels="union").select("target", "label", *_COUNTS),
      f"SELECT target, label, {_COUNT_SQL} FROM ({class_sql('confusion_cells', 'target', 'union', 'null')})")
query("m29_per_class", lambda t: E.per_class(counts(t)).select("target", "label", *_COUNTS, *rounded(4, "precision", "recall", "f1")), f"""
SELECT target, label, {_COUNT_SQL}, {rnd('p', 4)} AS precision, {rnd('r', 4)} AS recall, {rnd('f', 4)} AS f1 FROM ({class_sql('confusion_cells', 'target', 'true', 'null')})
""")
query("m29_per_class_zero_union", lambda t: E.per_class(counts(t), labels="union", undefined="zero").select("target", "label", *_COUNTS, *rounded(4, "precision", "recall", "f1")), f"""
SELECT target, label, {_COUNT_SQL}, {rnd('p', 4)} AS precision, {rnd('r', 4)} AS recall, {rnd('f', 4)} AS f1 FROM ({class_sql('confusion_cells', 'target', 'union', 'zero')})
""")
block("quality_cells", "SELECT 'quality' AS target, quality::VARCHAR AS true_label, toxic::VARCHAR AS pred_label, count(*) AS n FROM labels GROUP BY ALL")


def _rare_class(t: Tracker) -> DataFrame:
    rows = t.table("labels").select(F.lit("quality").alias("target"), F.col("quality").cast("string").alias("true_label"), F.col("toxic").cast("string").alias("pred_label"))
    return E.per_class(E.confusion(rows), labels="union", undefined="zero").select("target", "label", *_COUNTS, *rounded(4, "precision", "recall", "f1"))


query("m29_rare_class", _rare_class, f"""
SELECT target, label, {_COUNT_SQL}, {rnd('p', 4)} AS precision, {rnd('r', 4)} AS recall, {rnd('f', 4)} AS f1 FROM ({class_sql('quality_cells', 'target', 'union', 'zero')})
""")
_status = f"CASE WHEN {rnd('accuracy * 100.0::DOUBLE', 2)} >= CASE target WHEN 'issuetype' THEN 70.0 ELSE 75.0 END THEN 'OK' ELSE 'BELOW_TARGET' END AS target_status"
query("m28_summary", lambda t: E.target_status(E.summary(counts(t))), f"""
SELECT target, {rnd('accuracy * 100.0::DOUBLE', 2)} AS accuracy_pct, {rnd('macro_f1', 4)} AS macro_f1, {rnd('weighted_f1', 4)} AS weighted_f1, n_total, {_status}
FROM ({summary_sql('confusion_cells', 'target', 'true', 'null')})
""")
query("m28_summary_zero_union", lambda t: E.target_status(E.summary(counts(t), labels="union", undefined="zero")), f"""
SELECT target, {rnd('accuracy * 100.0::DOUBLE', 2)} AS accuracy_pct, {rnd('macro_f1', 4)} AS macro_f1, {rnd('weighted_f1', 4)} AS weighted_f1, n_total, {_status}
FROM ({summary_sql('confusion_cells', 'target', 'union', 'zero')})
""")


def _overall(t: Tracker) -> DataFrame:
    """One row with both targets side by side."""
    s = E.target_status(E.summary(counts(t)))

    def of(target: str, name: str, alias: str):
        return F.max(F.when(F.col("target") == target, F.col(name))).alias(alias)

    return s.agg(of("issuetype", "accuracy_pct", "accuracy_issuetype"), of("issuetype", "macro_f1", "macro_f1_issuetype"),
                 of("resolution", "accuracy_pct", "accuracy_resolution"), of("resolution", "macro_f1", "macro_f1_resolution"), F.max("n_total").alias("n_total"))


def _one(target: str) -> str:
    return f"(SELECT {rnd('accuracy * 100.0::DOUBLE', 2)} AS a, {rnd('macro_f1', 4)} AS f, n_total FROM ({summary_sql('confusion_cells', 'target', 'true', 'null')}) WHERE target = {q(target)})"


query("j9_overall_row", _overall, f"""
SELECT i.a AS accuracy_issuetype, i.f AS macro_f1_issuetype, r.a AS accuracy_resolution, r.f AS macro_f1_resolution, i.n_total FROM {_one('issuetype')} i CROSS JOIN {_one('resolution')} r
""")
_ROUTES = ["routing_issuetype", "routing_resolution"]
_share_sql = f"SELECT routing_issuetype, routing_resolution, count(*) AS n_tickets, {rnd('100.0::DOUBLE * count(*) / sum(count(*)) OVER ()', 1)} AS pct FROM predictions GROUP BY 1, 2"
query("m31_routing", lambda t: E.routing_share(predicted(t), _ROUTES), _share_sql)
query("a23_share_of_total", lambda t: E.routing_share(t.cleaned(), ["issuetype", "resolution"]), f"""
SELECT issuetype, resolution, count(*) AS n_tickets, {rnd('100.0::DOUBLE * count(*) / sum(count(*)) OVER ()', 1)} AS pct FROM int_issues GROUP BY 1, 2
""")


def bootstrap_blocks(prefix: str, source: str, by: str, labels: str, replicates: int = C.BOOTSTRAP_REPLICATES) -> None:
    keys = [k.strip() for k in by.split(",")]
    on = " AND ".join(f"c.{k} = g.{k}" for k in keys)
    block(f"{prefix}_cells", f"SELECT *, sum(n) OVER (PARTITION BY {by} ORDER BY true_label, pred_label) - n AS lo, sum(n) OVER (PARTITION BY {by} ORDER BY true_label, pred_label) AS hi FROM {source}")
    block(f"{prefix}_sizes", f"SELECT {by}, sum(n)::BIGINT AS total FROM {source} GROUP BY ALL")
    block(f"{prefix}_draws", f"""
SELECT {by}, replicate, ('0x' || substr(md5(replicate || ':' || draw), 1, 15))::BIGINT % total AS at FROM (
  SELECT {by}, total, replicate, unnest(range(total)) AS draw FROM {prefix}_sizes, (SELECT unnest(range({replicates})) AS replicate))""")
    groups = ", ".join(f"g.{k}" for k in keys)
    block(f"{prefix}_resamples", f"""
SELECT {groups}, g.replicate, c.true_label, c.pred_label, count(*) AS n FROM {prefix}_draws g JOIN {prefix}_cells c ON {on} AND g.at >= c.lo AND g.at < c.hi GROUP BY ALL""")
    universe = class_sql(source, by, labels, "zero")
    join = " AND ".join(f"u.{k} = b.{k}" for k in keys)
    names = ", ".join(f"u.{k}" for k in keys)
    block(f"{prefix}_macro", f"""
SELECT {names}, r.replicate, avg(coalesce(b.f, 0.0::DOUBLE)) AS macro_f1 FROM ({universe}) u CROSS JOIN (SELECT unnest(range({replicates})) AS replicate) r
LEFT JOIN ({class_sql(f'{prefix}_resamples', by + ', replicate', 'union', 'zero')}) b ON {join} AND b.label = u.label AND b.replicate = r.replicate GROUP BY ALL""")
    block(f"{prefix}_interval", f"""
SELECT {by}, {rnd('quantile_cont(macro_f1, 0.025)', 4)} AS ci_low, {rnd('quantile_cont(macro_f1, 0.5)', 4)} AS ci_mid, {rnd('quantile_cont(macro_f1, 0.975)', 4)} AS ci_high FROM {prefix}_macro GROUP BY ALL""")


bootstrap_blocks("boot", "confusion_cells", "target", "union")
query("m30_bootstrap", lambda t: E.bootstrap_macro_f1(counts(t)), "SELECT target, ci_low, ci_mid, ci_high FROM boot_interval")


def _report_lines(t: Tracker) -> DataFrame:
    s = E.target_status(E.summary(counts(t)))
    return tables.markdown_rows(s, ["target", "accuracy_pct", "macro_f1", "n_total", "target_status"])


query("s14_report_rows", _report_lines, f"""
SELECT '| ' || target || ' | ' || printf('%.4f', {rnd('accuracy * 100.0::DOUBLE', 2)}) || ' | ' || printf('%.4f', {rnd('macro_f1', 4)}) || ' | ' || n_total || ' | '
  || {_status.replace(' AS target_status', '')} || ' |' AS line FROM ({summary_sql('confusion_cells', 'target', 'true', 'null')})
""")

# --- comparisons -------------------------------------------------------------------------------------


def report_blocks(prefix: str, votes_sql: str) -> str:
    """Blocks from votes (config, query_key, target, label); returns the report SELECT."""
    block(f"{prefix}_votes", votes_sql)
    block(f"{prefix}_outcomes", f"""
SELECT v.config, v.target, CASE v.target WHEN 'issuetype' THEN e.issuetype ELSE e.resolution END AS true_label, v.label AS pred_label
FROM {prefix}_votes v JOIN eval_rows e ON e.key = v.query_key""")
    block(f"{prefix}_cfgcells", f"SELECT config, target, true_label, pred_label, count(*) AS n FROM {prefix}_outcomes GROUP BY ALL")
    block(f"{prefix}_summary", summary_sql(f"{prefix}_cfgcells", "config, target", "true", "zero"))

    def of(target: str, name: str) -> str:
        return rnd(f"max(CASE WHEN target = {q(target)} THEN {name} END)", 4)

    return (f"SELECT config, {of('issuetype', 'accuracy')} AS acc_issuetype, {of('issuetype', 'macro_f1')} AS macro_f1_it, "
            f"{of('resolution', 'accuracy')} AS acc_resolution, {of('resolution', 'macro_f1')} AS macro_f1_res FROM {prefix}_summary GROUP BY config")


def both_targets(source: str, score: str, config: str = "config") -> str:
    """Neighbour rows (config, query_key, key, rk, score) as rows per target."""
    parts = [f"SELECT s.{config} AS config, s.query_key, {q(g)} AS target, t.{g} AS label, s.{score} AS weight, s.rk FROM {source} s JOIN train_rows t ON t.key = s.key"
             for g in voting.TARGETS]
    return "(" + " UNION ALL ".join(parts) + ")"


block("sweep_rows", f"SELECT k.k AS config, query_key, key, rk, (sim_a + sim_b) / 2.0::DOUBLE AS score FROM rrf_ranked, (SELECT unnest([{', '.join(map(str, C.SWEEP_KS))}]) AS k) k WHERE rk <= k.k")
_sweep = report_blocks("sweep", vote(both_targets("sweep_rows", "score"), "config, query_key, target"))
query("m21_k_sweep", lambda t: A.k_sweep(*sides(t)), f"SELECT * RENAME (config AS k) FROM ({_sweep})")
_cfg_values = ", ".join("(" + ", ".join(q(v) for v in c) + ")" for c in C.BOOST_CONFIGS)
block("switches", f"SELECT * FROM (VALUES {_cfg_values}) v(config, sp, ss, sr, sc)")
block("switched", f"""
SELECT config, query_key, key, score, row_number() OVER (PARTITION BY config, query_key ORDER BY score DESC, key) AS rk FROM (
  SELECT s.config, b.query_key, b.key, {rnd('b.rrf + 0.15::DOUBLE * (s.sp * b.b_priority + s.ss * b.b_status + s.sr * b.b_reporter) + 0.10::DOUBLE * s.sc * b.change_sim', 9)} AS score
  FROM boosted_pairs b CROSS JOIN switches s)""")
block("switched15", "SELECT * FROM switched WHERE rk <= 15")
_boost = report_blocks("loo", vote(both_targets("switched15", "score"), "config, query_key, target"))
query("m22_boost_ablation", lambda t: A.boost_ablation(*sides(t)), _boost)

block("own_majority", """
SELECT priority, target, label FROM (SELECT priority, 'issuetype' AS target, issuetype AS label, count(*) AS n FROM train_rows GROUP BY ALL
  UNION ALL SELECT priority, 'resolution', resolution, count(*) FROM train_rows GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY priority, target ORDER BY n DESC, label) = 1
""")
block("all_majority", """
SELECT target, label FROM (SELECT 'issuetype' AS target, issuetype AS label, count(*) AS n FROM train_rows GROUP BY ALL
  UNION ALL SELECT 'resolution', resolution, count(*) FROM train_rows GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY target ORDER BY n DESC, label) = 1
""")
block("majority_votes", """
SELECT e.key AS query_key, a.target, coalesce(o.label, a.label) AS label FROM eval_rows e CROSS JOIN all_majority a
LEFT JOIN own_majority o ON o.priority = e.priority AND o.target = a.target
""")
query("m19_metadata_only", lambda t: A.majority_labels(*sides(t)), "SELECT query_key, target, label FROM majority_votes")
query("j14_match_or_fallback", lambda t: A.majority_labels(sides(t)[0], sides(t)[1].where(~F.col("priority").isin("Major", "Minor"))), """
SELECT e.key AS query_key, a.target, coalesce(o.label, a.label) AS label FROM eval_rows e CROSS JOIN (
  SELECT target, label FROM (SELECT 'issuetype' AS target, issuetype AS label, count(*) AS n FROM train_rows WHERE priority NOT IN ('Major', 'Minor') GROUP BY ALL
  UNION ALL SELECT 'resolution', resolution, count(*) FROM train_rows WHERE priority NOT IN ('Major', 'Minor') GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY target ORDER BY n DESC, label) = 1) a
LEFT JOIN (SELECT * FROM own_majority WHERE priority NOT IN ('Major', 'Minor')) o ON o.priority = e.priority AND o.target = a.target
""")
block("single_heads", "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_key ORDER BY sim_a DESC, key) AS rk FROM pairs) WHERE rk <= 30")
block("single_boosted", f"""
SELECT * FROM (SELECT query_key, key, score, row_number() OVER (PARTITION BY query_key ORDER BY score DESC, key) AS rk FROM (
  SELECT *, {rnd('sim_a + 0.15::DOUBLE * (b_priority + b_status + b_reporter)', 9)} AS score FROM single_heads)) WHERE rk <= 15
""")
query("m20_single_view", lambda t: A.single_view(*sides(t), boosted=False).select("query_key", "key", *rounded(6, "score"), *long("rk")),
      f"SELECT query_key, key, {rnd('sim_a', 6)} AS score, rk FROM single_heads WHERE rk <= 15")
query("m20_single_view_boost", lambda t: A.single_view(*sides(t), boosted=True).select("query_key", "key", *rounded(6, "score"), *long("rk")),
      f"SELECT query_key, key, {rnd('score', 6)} AS score, rk FROM single_boosted")
_n = C.ARCHITECTURE_CONFIGS
block("dual_plain", f"""
SELECT * FROM (SELECT query_key, key, score, row_number() OVER (PARTITION BY query_key ORDER BY score DESC, key) AS rk FROM (
  SELECT *, {rnd('rrf + 0.15::DOUBLE * metadata', 9)} AS score FROM boosted_pairs)) WHERE rk <= 15
""")
block("arch_rows", f"""
SELECT {q(_n[1])} AS config, query_key, key, sim_a AS score, rk FROM single_heads WHERE rk <= 15
UNION ALL SELECT {q(_n[2])}, query_key, key, score, rk FROM single_boosted UNION ALL SELECT {q(_n[3])}, query_key, key, score, rk FROM dual_plain
UNION ALL SELECT {q(_n[4])}, query_key, key, score, rk FROM top15 UNION ALL SELECT {q(_n[5])}, query_key, key, score, rk FROM top15
""")
block("arch_all", vote(both_targets("arch_rows", "score"), "config, query_key, target"))
_arch = report_blocks("arch", f"""
SELECT config, query_key, target, label, CASE WHEN config = {q(_n[5])} THEN CASE WHEN total > 0 AND top1 / total >= 0.65 AND (top1 - top2) / total >= 0.10 THEN 'DIRECT' ELSE 'LLM_REQUIRED' END END AS routing FROM arch_all
UNION ALL SELECT {q(_n[0])}, query_key, target, label, NULL FROM majority_votes
""")
bootstrap_blocks("archb", "arch_cfgcells", "config, target", "true")


def _ci(target: str, name: str) -> str:
    return f"max(CASE WHEN target = {q(target)} THEN {name} END)"


query("m23_architecture", lambda t: A.architecture_report(*sides(t)), f"""
SELECT a.*, c.ci_low_it, c.ci_high_it, c.ci_low_res, c.ci_high_res, d.pct_direct FROM ({_arch}) a
JOIN (SELECT config, {_ci('issuetype', 'ci_low')} AS ci_low_it, {_ci('issuetype', 'ci_high')} AS ci_high_it, {_ci('resolution', 'ci_low')} AS ci_low_res,
  {_ci('resolution', 'ci_high')} AS ci_high_res FROM archb_interval GROUP BY 1) c ON c.config = a.config
JOIN (SELECT config, {rnd("100.0::DOUBLE * count(CASE WHEN routing = 'DIRECT' THEN 1 END) / nullif(count(routing), 0)", 1)} AS pct_direct FROM arch_votes WHERE target = 'issuetype' GROUP BY 1) d ON d.config = a.config
""")
_l = C.LEXICAL_CONFIGS
block("lex_rows", f"""
SELECT {q(_l[0])} AS config, query_key, key, rrf AS score, rk FROM rrf_ranked WHERE rk <= 15
UNION ALL SELECT {q(_l[1])}, query_key, key, bm25, rk FROM bmt_ranked WHERE rk <= 15 UNION ALL SELECT {q(_l[2])}, query_key, key, score, rk FROM hybrid15
""")
_lex = report_blocks("lex", vote(both_targets("lex_rows", "score"), "config, query_key, target"))
query("m18_strategy_comparison", lambda t: A.lexical_report(*sides(t)), _lex)

# --- prompts, answers, summaries -----------------------------------------------------------------------


def _gated_prompts(t: Tracker) -> DataFrame:
    rows, scores = boosted_rows(t), boosted_scores(t)
    prompts = N.label_prompts(boosted_gate(t), scores, rows, sides(t)[0])
    return prompts


_line = "'[' || t.issuetype || '/' || t.resolution || ']' || " + NL + " || left(t.text_rich, {})"
block("boost_text", "SELECT b.query_key, b.rk, t.issuetype, t.resolution, t.text_rich FROM boost15 b JOIN train_rows t ON t.key = b.key")


def _context(chars: int, first: int, cut: int | None = None) -> str:
    text = f"string_agg({_line.format(chars)}, {NL} || '---' || {NL} ORDER BY t.rk)"
    return f"(SELECT t.query_key, {f'left({text}, {cut})' if cut else text} AS context FROM boost_text t WHERE t.rk <= {first} GROUP BY 1)"


block("candidate_text", f"""
SELECT query_key, target, string_agg(lpad(rnk::VARCHAR, 2, ' ') || '. ' || label || ' (score: ' || printf('%.4f', {rnd('s', 4)}) || ')', {NL} ORDER BY rnk) AS candidates FROM (
  SELECT *, row_number() OVER (PARTITION BY query_key, target ORDER BY s DESC, b, label) AS rnk FROM (
    SELECT query_key, target, label, {rnd('sum(weight)', 9)} AS s, min(rk) AS b FROM boost_neighbours GROUP BY ALL)) WHERE rnk <= 5 GROUP BY 1, 2
""")
query("p22_candidate_lines", lambda t: N.candidate_lines(boosted_scores(t)), "SELECT query_key, target, candidates FROM candidate_text")
_PROMPT_SQL = f"""
SELECT g.query_key, g.target, 'Choose the best label for this software project ticket.' || {NL} || {NL} || 'CANDIDATES' || {NL} || c.candidates || {NL} || {NL} || 'EVIDENCE' || {NL}
  || left(x.context, 1200) || {NL} || {NL} || 'TICKET' || {NL} || left(e.text_noco, 1500) || {NL} || {NL}
  || 'The first candidate is usually right. Answer with one candidate label only.' AS prompt
FROM boost_gated g JOIN candidate_text c ON c.query_key = g.query_key AND c.target = g.target JOIN {_context(250, 5)} x ON x.query_key = g.query_key
JOIN eval_rows e ON e.key = g.query_key WHERE g.method <> 'DIRECT'
"""
block("gated_prompts", _PROMPT_SQL)
query("m24_label_prompts", _gated_prompts, _PROMPT_SQL)


def _list_prompts(t: Tracker) -> DataFrame:
    v = votes(t).withColumn("routing", voting.margin_gate(F.col("conf"), F.col("margin")))
    return N.list_prompts(v, voting.by_target(neighbours(t)), sides(t)[0])


query("m24_list_prompts", _list_prompts, f"""
SELECT g.query_key, g.target, 'Pick one software project ' || g.target || ' from: ' || CASE g.target WHEN 'issuetype' THEN {q(', '.join(C.ISSUE_TYPES))} ELSE {q(', '.join(C.RESOLUTIONS_BATCH_ORDER))} END
  || {NL} || {NL} || 'TICKET' || {NL} || left(e.text_noco, 1500) || {NL} || {NL} || 'SIMILAR' || {NL} || x.evidence || {NL} || {NL} || 'Answer with the label only.' AS prompt
FROM gated_votes g JOIN eval_rows e ON e.key = g.query_key JOIN (SELECT query_key, target, string_agg('[' || label || '] ' || left(cand_text, 250), {NL} ORDER BY rk) AS evidence FROM (
  SELECT query_key, 'issuetype' AS target, issuetype AS label, cand_text, rk FROM weighted_rows UNION ALL SELECT query_key, 'resolution', resolution, cand_text, rk FROM weighted_rows) WHERE rk <= 5 GROUP BY 1, 2) x
  ON x.query_key = g.query_key AND x.target = g.target WHERE g.routing <> 'DIRECT'
""")


def _fix_prompts(t: Tracker) -> DataFrame:
    gate = boosted_gate(t)
    wide = gate.groupBy("query_key").agg(*[F.max(F.when(F.col("target") == g, F.col("label"))).alias(g) for g in voting.TARGETS])
    return N.fix_prompts(wide, boosted_rows(t), sides(t)[0])


query("m24_fix_prompts", _fix_prompts, f"""
SELECT i.query_key, 'State the likely fix of this software project ticket in one or two sentences.' || {NL} || {NL} || 'TYPE ' || i.label || {NL} || 'RESOLUTION ' || r.label || {NL} || {NL}
  || 'TICKET' || {NL} || left(e.text_noco, 1200) || {NL} || {NL} || 'FIXED BEFORE' || {NL} || x.context AS prompt
FROM boost_votes i JOIN boost_votes r ON r.query_key = i.query_key AND i.target = 'issuetype' AND r.target = 'resolution'
JOIN eval_rows e ON e.key = i.query_key JOIN {_context(400, 3, 1500)} x ON x.query_key = i.query_key
""")
_cause_fields = ", ".join(N.CAUSE_FIELDS)


def _cause_prompts(t: Tracker) -> DataFrame:
    m = t.ml_mart().where("split = 'train'")
    text = X.text_cause_input(F.col("summary_clean"), F.col("priority"), F.col("status"), F.col("description_clean"), F.col("comments_concat"))
    return m.select("key", N.cause_prompt(text).alias("prompt"))


query("m24_cause_prompts", _cause_prompts, f"""
SELECT key, 'Summarise this software project ticket from the facts it states, under these headings, one or two sentences each, without naming its type or outcome: {_cause_fields}.' || {NL} || {NL} || 'TICKET' || {NL}
  || left('Summary: ' || summary_clean || {NL} || 'Priority: ' || coalesce(priority, '') || {NL} || 'Status: ' || coalesce(status, '') || {NL} || 'Description: '
  || left(description_clean, 1500) || {NL} || 'Comments: ' || left(comments_concat, 1000), 3500) AS prompt FROM mart_ml WHERE split = 'train'
""")


def _answers(t: Tracker) -> DataFrame:
    """Answers as an outside labeller might give them: the true label misspelt in
    lower case, for tickets that are not pending."""
    truth = voting.by_target(sides(t)[0].where("status <> 'P'").select(F.col("key").alias("query_key"), *voting.TARGETS))
    return truth.select("query_key", "target", F.concat(F.lower("label"), F.lit("x")).alias("answer"))


def nearest_join_sql(source: str, keys: str, text: str, labels, name: str, ignore_case: bool = False) -> str:
    """Rows of ``source`` with their nearest label, by the literal cross join."""
    pairs = ", ".join(f"({i}, {q(x)})" for i, x in enumerate(labels))
    same = f"lower(v.label) = lower({text})" if ignore_case else f"v.label = {text}"
    return f"""SELECT {keys}, v.label AS {name} FROM {source} CROSS JOIN (VALUES {pairs}) v(place, label)
QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY CASE WHEN {same} THEN 0 ELSE 1 + levenshtein(upper({text}), upper(v.label)) END, v.place) = 1"""


block("answered", """
SELECT g.query_key, g.target, CASE WHEN g.method = 'DIRECT' OR e.status = 'P' THEN g.label
  ELSE lower(CASE g.target WHEN 'issuetype' THEN e.issuetype ELSE e.resolution END) || 'x' END AS chosen
FROM boost_gated g JOIN eval_rows e ON e.key = g.query_key
""")
query("m25_arbitration", lambda t: voting.apply_answers(boosted_gate(t), _answers(t)).select("query_key", "target", "final_label"),
      nearest_join_sql("(SELECT query_key, target, chosen FROM answered WHERE target = 'issuetype')", "query_key, target", "chosen", C.ISSUE_TYPES, "final_label")
      + " UNION ALL (" + nearest_join_sql("(SELECT query_key, target, chosen FROM answered WHERE target = 'resolution')", "query_key, target", "chosen", C.RESOLUTIONS, "final_label") + ")")


def _normalised(t: Tracker) -> DataFrame:
    return t.issues().select("key", voting.nearest_label(F.col("issuetype_raw"), C.ISSUE_TYPES).alias("nearest"))


query("m26_nearest_label", _normalised, nearest_join_sql("stg_issues", "key", "issuetype_raw", C.ISSUE_TYPES, "nearest"))
query("m26_nearest_ignoring_case", lambda t: t.issues().select("key", voting.nearest_label(
    F.concat(F.lit('"'), F.lower("resolution_raw"), F.lit('" ')), C.RESOLUTIONS_BATCH_ORDER, ignore_case=True).alias("nearest")),
    nearest_join_sql("stg_issues", "key", "lower(resolution_raw)", C.RESOLUTIONS_BATCH_ORDER, "nearest", True))
query("w7_nearest_per_row", lambda t: t.issues().select("key", voting.nearest_label(F.col("resolution_raw"), C.RESOLUTIONS).alias("nearest")),
      nearest_join_sql("stg_issues", "key", "resolution_raw", C.RESOLUTIONS, "nearest"))
query("j8_label_list", lambda t: t.issues().select("key", "issuetype_raw", F.explode(F.array(*[F.struct(
    F.lit(x).alias("label"), F.levenshtein(F.upper("issuetype_raw"), F.lit(x.upper())).cast("bigint").alias("distance")) for x in C.ISSUE_TYPES])).alias("s")).select("key", "issuetype_raw", "s.*"),
    f"SELECT key, issuetype_raw, v.label, levenshtein(upper(issuetype_raw), upper(v.label)) AS distance FROM stg_issues CROSS JOIN (VALUES {', '.join('(' + q(x) + ')' for x in C.ISSUE_TYPES)}) v(label)")
query("h5_edit_distance", lambda t: t.issues().select("key", F.levenshtein("issuetype_raw", "resolution_raw").cast("bigint").alias("distance")),
      "SELECT key, levenshtein(issuetype_raw, resolution_raw) AS distance FROM stg_issues")
query("p23_tidy_response", lambda t: t.table("pages").select("page_id", F.lower(X.tidy_response(F.concat(F.lit(' "'), "url", F.lit('" ')))).alias("answer")),
      "SELECT page_id, lower(url) AS answer FROM pages")


def _missing(t: Tracker) -> DataFrame:
    return N.missing_summaries(neighbours(t), sides(t)[1], _cache(t))


query("m27_missing_summaries", _missing, f"""
SELECT t.key, 'Summarise cause and resolution of this software project ticket in at most 250 characters.' || {NL} || {NL} || 'TICKET: ' || left(t.summary_clean, 300) || {NL}
  || 'DESCRIPTION: ' || left(t.description_clean, 1000) || {NL} || 'COMMENTS: ' || left(t.comments_concat, 1500) || {NL} || 'RESOLUTION: ' || t.resolution AS prompt
FROM train_rows t WHERE t.key IN (SELECT key FROM top15 WHERE rk <= 5) AND t.key NOT IN (SELECT key FROM {CACHE_SQL})
""")


def length_responder():
    return lambda prompts: [f"{len(p)} characters" for p in prompts]


query("m27_merged_cache", lambda t: N.merged_cache(_cache(t), _missing(t), length_responder), f"""
SELECT key, fix_summary FROM {CACHE_SQL} UNION ALL SELECT t.key, (length('Summarise cause and resolution of this software project ticket in at most 250 characters.') + 2
  + length('TICKET: ') + length(left(t.summary_clean, 300)) + 1 + length('DESCRIPTION: ') + length(left(t.description_clean, 1000)) + 1 + length('COMMENTS: ')
  + length(left(t.comments_concat, 1500)) + 1 + length('RESOLUTION: ') + length(t.resolution)) || ' characters'
FROM train_rows t WHERE t.key IN (SELECT key FROM top15 WHERE rk <= 5) AND t.key NOT IN (SELECT key FROM {CACHE_SQL})
""")
block("gated_answers", """
SELECT g.query_key, g.target, g.method, coalesce(length(p.prompt) || ' characters', g.label) AS chosen
FROM boost_gated g LEFT JOIN gated_prompts p ON p.query_key = g.query_key AND p.target = g.target
""")
for _target, _labels in (("issuetype", C.ISSUE_TYPES), ("resolution", C.RESOLUTIONS)):
    block(f"gated_{_target}", nearest_join_sql(
        f"(SELECT query_key, method, chosen FROM gated_answers WHERE target = '{_target}')", "query_key, method", "chosen", _labels, "label"))
query("m25_gated_predictions", lambda t: jobs.gated_predictions(*sides(t), length_responder, METADATA), f"""
SELECT i.query_key AS key, i.label AS predicted_issuetype, r.label AS predicted_resolution,
  length('State the likely fix of this software project ticket in one or two sentences.' || {NL} || {NL} || 'TYPE ' || i.label || {NL} || 'RESOLUTION ' || r.label || {NL} || {NL}
  || 'TICKET' || {NL} || left(e.text_noco, 1200) || {NL} || {NL} || 'FIXED BEFORE' || {NL} || x.context) || ' characters' AS fix_summary,
  i.method AS method_issuetype, r.method AS method_resolution
FROM gated_issuetype i JOIN gated_resolution r ON r.query_key = i.query_key JOIN eval_rows e ON e.key = i.query_key JOIN {_context(400, 3, 1500)} x ON x.query_key = i.query_key
""")
query("h1_column_macro", lambda t: t.comments().select("comment_id", X.clean_ticket_text(F.col("comment_body")).alias("cleaned")),
      f"SELECT comment_id, {clean('comment_body')} AS cleaned FROM stg_comments")
query("h2_completion_hook", lambda t: N.answer(t.comments().select("comment_id", "comment_body"), "comment_body", length_responder),
      "SELECT comment_id, length(comment_body) || ' characters' AS answer FROM stg_comments")


def vowel_encoder():
    import numpy as np

    return lambda texts: np.array([[len(x), x.count("a"), x.count("e"), 1.0] for x in texts], dtype=float)


def _encoded(t: Tracker) -> DataFrame:
    v = N.embed(_documents(t), "text", vowel_encoder)
    return v.select("key", *[S.round_half_up(F.col("vector")[i].cast("double"), 4).alias(f"v{i}") for i in range(4)])


_e = ["length(text)", "(length(text) - length(replace(text, 'a', '')))", "(length(text) - length(replace(text, 'e', '')))", "1"]
_norm = "sqrt(" + " + ".join(f"({x})::DOUBLE * ({x})" for x in _e) + ")"
query("h3_encoder_hook", _encoded, "SELECT 'D-' || doc_id AS key, " + ", ".join(f"{rnd(f'(({x}) / {_norm})::FLOAT', 4)} AS v{i}" for i, x in enumerate(_e)) + " FROM documents")

# --- vectors from text --------------------------------------------------------------------------------

_words = registry.WORDS
block("bucket_tf", f"SELECT key, (('0x' || substr(md5(term), 1, 8))::BIGINT % 256)::INTEGER AS bucket, count(*) AS tf FROM (SELECT doc_id AS key, unnest({_words}) AS term FROM documents) GROUP BY ALL")
block("bucket_w", "SELECT key, bucket, tf * ln(((SELECT count(*) FROM documents) + 1.0::DOUBLE) / (count(*) OVER (PARTITION BY bucket) + 1.0::DOUBLE)) AS w FROM bucket_tf")
query("m1_hashed_vectors", lambda t: N.hashed_weights(t.table("documents").select(F.col("doc_id").alias("key"), "text"), "text").select("key", "bucket", *rounded(6, "weight")), f"""
SELECT key, bucket, {rnd('weight', 6)} AS weight FROM (SELECT key, bucket, w / nullif(sqrt(sum(w * w) OVER (PARTITION BY key)), 0) AS weight FROM bucket_w) WHERE weight <> 0
""")



def _text_neighbours(t: Tracker) -> DataFrame:
    """Benchmark passages against all documents, from text to neighbours."""
    texts = t.table("documents").select(F.concat(F.lit("D-"), "doc_id").alias("key"), "text").unionByName(
        t.table("benchmark").select(F.concat(F.lit("B-"), "item_id").alias("key"), "text"))
    found = materialise(N.hashed_vectors(texts, "text", 64), "text-vectors")
    asked, known = (found.where(F.col("key").startswith(x)) for x in ("B-", "D-"))
    return retrieval.top_k(asked, known, "vector", 3).select("query_key", "key", *rounded(6, "sim"), *long("rk"))


block("small_tf", f"""SELECT key, (('0x' || substr(md5(term), 1, 8))::BIGINT % 64)::INTEGER AS bucket, count(*) AS tf FROM (SELECT key, unnest({_words}) AS term FROM (
  SELECT 'D-' || doc_id AS key, text FROM documents UNION ALL SELECT 'B-' || item_id, text FROM benchmark)) GROUP BY ALL""")
block("small_w", """SELECT key, bucket, tf * ln(((SELECT count(*) FROM documents) + (SELECT count(*) FROM benchmark) + 1.0::DOUBLE) / (count(*) OVER (PARTITION BY bucket) + 1.0::DOUBLE)) AS w FROM small_tf""")
block("small_unit", "SELECT key, bucket, w / nullif(sqrt(sum(w * w) OVER (PARTITION BY key)), 0) AS w FROM small_w")
query("m1_text_neighbours", _text_neighbours, f"""
SELECT query_key, key, {rnd('sim', 6)} AS sim, rk FROM (SELECT *, row_number() OVER (PARTITION BY query_key ORDER BY sim DESC, key) AS rk FROM (
  SELECT a.query_key, k.key, {rnd('coalesce(p.s, 0)', 9)} AS sim FROM (SELECT 'B-' || item_id AS query_key FROM benchmark) a CROSS JOIN (SELECT 'D-' || doc_id AS key FROM documents) k
  LEFT JOIN (SELECT x.key AS query_key, y.key, sum(x.w * y.w) AS s FROM small_unit x JOIN small_unit y ON y.bucket = x.bucket AND x.key LIKE 'B-%' AND y.key LIKE 'D-%' GROUP BY 1, 2) p
  ON p.query_key = a.query_key AND p.key = k.key)) WHERE rk <= 3
""")


def _stale(t: Tracker) -> DataFrame:
    """Cached hashes hold the texts of English documents; other languages and their
    copies are to be encoded."""
    docs = _documents(t)
    known = t.table("documents").where("lang = 'en'").select(F.concat(F.lit("D-"), "doc_id").alias("key"), "text")
    cache = N.text_hashes(known, "text").withColumn("model", F.lit("m1"))
    return N.stale_rows(N.text_hashes(docs, "text"), cache, "m1")


query("m2_stale_rows", _stale, "SELECT 'D-' || doc_id AS key, sha256(coalesce(text, '')) AS text_hash FROM documents WHERE lang <> 'en'")
_sums = ", ".join(f"sum(('0x' || substr(h, {at}, 8))::BIGINT::HUGEINT)::VARCHAR" for at in range(1, 65, 8))
query("m2_fingerprint", lambda t: N.corpus_fingerprint(N.text_hashes(_documents(t), "text"), "m1"), f"""
SELECT 'm1' AS model, count(*) AS n_rows, substr(sha256(concat_ws(':', {_sums})), 1, 16) AS corpus_hash
FROM (SELECT sha256('D-' || doc_id || ':' || sha256(coalesce(text, ''))) AS h FROM documents)
""")

# --- reports and streaming --------------------------------------------------------------------------------

def _whole(x: str) -> str:
    return f"({rnd(f'({x}) * 100.0::DOUBLE', 0)})::INTEGER::VARCHAR || '%'"


block("report_near", f"SELECT *, {rnd('weight', 4)} AS sim FROM weighted_rows WHERE rk <= 5")
_analysis = f"""'Classified as ' || p.pred_issuetype || ' with ' || {_whole('p.conf_issuetype')} || ' confidence. Closest ticket ' || n.key || ' (' || {_whole('n.sim')}
  || ' similar) was resolved as ' || n.resolution || '. ' || CASE WHEN p.conf_resolution >= 0.65 THEN 'Past tickets strongly support this.' ELSE 'Check the evidence before acting.' END"""


def _reported(t: Tracker, cached: bool) -> DataFrame:
    near = materialise(neighbours(t), "neighbours")  # read by the votes and as evidence
    said = voting.predictions(voting.vote(voting.by_target(near)), sides(t)[0])
    return N.triage_report(said, near, _cache(t) if cached else None)


query("m34_analysis", lambda t: _reported(t, False).select("key", "analysis"),
      f"SELECT p.key, {_analysis} AS analysis FROM predictions p JOIN report_near n ON n.query_key = p.key AND n.rk = 1")


def _band(x: str) -> str:
    return f"CASE WHEN {x} >= 0.65 THEN 'High' WHEN {x} >= 0.45 THEN 'Medium' ELSE 'Low' END"


query("m33_triage_report", lambda t: _reported(t, True), f"""
SELECT p.key, p.pred_issuetype AS issuetype, {_band('p.conf_issuetype')} AS issuetype_band, p.routing_issuetype, p.pred_resolution AS resolution,
  {_band('p.conf_resolution')} AS resolution_band, p.routing_resolution, CASE WHEN p.conf_issuetype < 0.45 OR p.conf_resolution < 0.45 THEN 1 ELSE 0 END AS low_confidence,
  {case('p.pred_issuetype', N.ROUTES, q(N.ROUTE_ELSE))} AS routing_guidance, {case('p.pred_resolution', N.STEPS, q(N.STEP_ELSE))} AS next_step,
  {_analysis} AS analysis, x.evidence FROM predictions p JOIN report_near n ON n.query_key = p.key AND n.rk = 1
JOIN (SELECT r.query_key, string_agg(r.key || ' ' || floor(r.sim * 100.0::DOUBLE)::BIGINT || '% match [' || r.issuetype || ' / ' || r.resolution || '] "' || coalesce(r.cand_summary, '') || '"'
  || CASE WHEN coalesce(c.fix_summary, '') <> '' THEN ' fix: ' || c.fix_summary ELSE '' END, {NL} ORDER BY r.rk) AS evidence
  FROM report_near r LEFT JOIN {CACHE_SQL} c ON c.key = r.key GROUP BY 1) x ON x.query_key = p.key
""")


def _streamed(t: Tracker) -> DataFrame:
    """New tickets arrive as files; the stored scores are read back."""
    queries, corpus = sides(t)
    root = scratch(t, "stream")
    queries.write.parquet(f"{root}/in")
    run = scoring.score_new_tickets(t.spark, f"{root}/in", queries.schema, corpus, f"{root}/out", f"{root}/state")
    run.awaitTermination()
    return t.spark.read.parquet(f"{root}/out/scores").drop("batch_id")


query("g1_streamed_scores", _streamed, f"""
SELECT {', '.join('p.' + c for c in _PRED)} FROM predictions p JOIN eval_rows e ON e.key = p.key
WHERE length({registry.stripped('e.summary_clean')}) >= 10 AND length({registry.stripped('e.description_clean')}) >= 20
""")
