"""Named SQL blocks that restate the derived tables independently, and ``sql``,
which puts the blocks a statement uses in front of it."""

from __future__ import annotations

import re

from triagelake import constants as C
from triagelake.sources import bindings as B


def q(value: object) -> str:
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def values(rows) -> str:
    return ", ".join("(" + ", ".join(q(v) for v in row) + ")" for row in rows)


def strings(items) -> str:
    return ", ".join(q(i) for i in items)


def case(x: str, pairs, default: str = "NULL") -> str:
    return f"CASE {x} " + " ".join(f"WHEN {q(a)} THEN {q(b)}" for a, b in pairs) + f" ELSE {default} END"


def rnd(x: str, digits: int) -> str:
    """Half away from zero on the double."""
    scale = f"{float(10**digits)!r}::DOUBLE"
    return f"(sign(({x})::DOUBLE) * floor(abs(({x})::DOUBLE) * {scale} + 0.5) / {scale} + 0.0)"


def pct(x: str, y: str, digits: int = 2) -> str:
    return rnd(f"(({x})::DOUBLE * 100.0::DOUBLE / nullif(({y})::DOUBLE, 0))", digits)


def clean(x: str) -> str:
    out = f"coalesce({x}, '')"
    for pattern in C.CLEANING_PATTERNS:
        out = f"regexp_replace({out}, {q(pattern)}, ' ', 'g')"
    return f"trim({out})"


NL = "chr(10)"
LO, MID, HI = B.SPLIT_BOUNDS

BLOCKS: dict[str, str] = {}


def block(name: str, text: str) -> None:
    BLOCKS[name] = text.strip()


block("first_line", """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey,
  l_suppkey, l_shipdate, l_quantity, l_extendedprice) AS rn_first FROM lineitem) WHERE rn_first = 1
""")
block("raw_issues", f"""
SELECT o_orderkey::VARCHAR AS id, 'TKT-' || o_orderkey AS key, substr(text, 1, 120) AS summary,
  text AS description, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS created,
  CASE WHEN o_orderstatus = 'P' THEN '' ELSE strftime(last_ship, '%Y-%m-%d %H:%M:%S') END AS resolutiondate,
  {case('c_mktsegment', B.SEGMENT_TYPES, 'c_mktsegment')} AS issuetype_name,
  {case('(l_returnflag || l_linestatus)', B.FLAG_RESOLUTIONS, 'l_returnflag || l_linestatus')} AS resolution_name,
  l_returnflag || l_linestatus AS resolution_description,
  {case('substr(o_orderpriority, 1, 1)', B.PRIORITY_NAMES)} AS priority_name,
  o_orderstatus AS status_name,
  CASE WHEN l_returnflag IS NULL THEN 'SIDE' ELSE {q(B.PROJECT)} END AS project_key,
  CASE WHEN l_suppkey % 10 = 0 THEN ' ' ELSE s_name END AS assignee,
  o_custkey::VARCHAR AS reporter, o_custkey::VARCHAR AS creator,
  CASE WHEN o_custkey % 11 = 0 THEN 'n/a' ELSE (o_custkey % 17)::VARCHAR END AS votes_votes,
  (o_custkey % 23)::VARCHAR AS watches_watchcount
FROM orders LEFT JOIN first_line f ON f.l_orderkey = o_orderkey
LEFT JOIN (SELECT l_orderkey AS ok, max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1) e ON e.ok = o_orderkey
LEFT JOIN customer ON c_custkey = o_custkey
LEFT JOIN supplier ON s_suppkey = l_suppkey
LEFT JOIN documents ON doc_id = o_orderkey % (SELECT max(doc_id) + 1 FROM documents)
""")
block("raw_comments", """
SELECT 'TKT-' || conv_id AS key, conv_id || '-' || turn AS comment_id, role AS comment_author,
  text AS comment_body,
  strftime(TIMESTAMP '2020-01-01' + to_minutes(turn), '%Y-%m-%d %H:%M:%S') AS comment_created,
  strftime(TIMESTAMP '2020-01-01' + to_minutes(turn + 60), '%Y-%m-%d %H:%M:%S') AS comment_updated
FROM conversations
""")
_names = "[" + strings(B.EVENT_PRIORITIES) + "]"
block("raw_changelog", f"""
SELECT 'TKT-' || (user_id * 30 + day(ts) - 1) AS key, json_extract_string(props, '$.k') AS author,
  strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS created,
  {case('event_type', B.EVENT_FIELDS)} AS field,
  CASE WHEN event_type = 'purchase' THEN {_names}[(event_id + 1) % 6 + 1] END AS fromstring,
  CASE WHEN event_type = 'purchase' THEN {_names}[event_id % 6 + 1]
       ELSE json_extract_string(props, '$.k') END AS tostring
FROM events
""")
block("raw_links", """
SELECT 'TKT-' || l_orderkey AS key,
  CASE WHEN l_returnflag = 'A' THEN 'Duplicate' WHEN l_returnflag = 'R' THEN 'Blocks'
       WHEN l_returnflag || l_linestatus = 'NF' THEN 'Relates' ELSE 'is clones of' END AS type_name,
  CASE WHEN l_linestatus = 'F' THEN l_partkey::VARCHAR END AS inwardissue_key,
  CASE WHEN l_linestatus = 'O' THEN l_partkey::VARCHAR END AS outwardissue_key
FROM lineitem
""")
block("stg_issues", f"""
SELECT id AS issue_id, key, summary, description, try_cast(created AS TIMESTAMP) AS created_at,
  try_cast(resolutiondate AS TIMESTAMP) AS resolved_at, issuetype_name AS issuetype_raw,
  resolution_name AS resolution_raw, priority_name AS priority, status_name AS status,
  project_key AS project, coalesce(nullif(trim(assignee), ''), 'Unassigned') AS assignee,
  reporter, creator, try_cast(votes_votes AS BIGINT) AS votes, try_cast(watches_watchcount AS BIGINT) AS watches
FROM raw_issues WHERE project_key = {q(B.PROJECT)}
QUALIFY row_number() OVER (PARTITION BY key ORDER BY id, created, summary) = 1
""")
block("stg_comments", """
SELECT key, comment_id, comment_author, comment_body, try_cast(comment_created AS TIMESTAMP) AS comment_created,
  try_cast(comment_updated AS TIMESTAMP) AS comment_updated
FROM raw_comments WHERE key IN (SELECT key FROM stg_issues)
""")
block("stg_changelog", f"""
SELECT key, author, try_cast(created AS TIMESTAMP) AS created, field, fromstring AS from_string, tostring AS to_string
FROM raw_changelog WHERE key IN (SELECT key FROM stg_issues) AND upper(field) IN ({strings(C.STAGED_CHANGE_FIELDS)})
""")
block("stg_links", """
SELECT key, type_name, inwardissue_key, outwardissue_key FROM raw_links WHERE key IN (SELECT key FROM stg_issues)
""")
block("seed_types", f"SELECT * FROM (VALUES {values(C.ISSUE_TYPE_SEED)}) v(issuetype_raw, issuetype)")
block("seed_resolutions", f"SELECT * FROM (VALUES {values(C.RESOLUTION_SEED)}) v(resolution_raw, resolution)")
block("int_issues", f"""
SELECT * FROM (SELECT b.key, issue_id, created_at, resolved_at, priority, status, project, assignee, reporter,
  creator, votes, watches, b.issuetype_raw, b.resolution_raw, coalesce(t.issuetype, 'Other') AS issuetype,
  r.resolution, {clean('b.summary')} AS summary, {clean('b.description')} AS description,
  least(coalesce(date_diff('day', created_at, resolved_at), 0), 5000) AS resolution_days,
  length(coalesce(b.summary, '')) AS summary_length, length(coalesce(b.description, '')) AS description_length,
  CASE WHEN created_at < TIMESTAMP '{LO}' THEN 'train'
       WHEN created_at >= TIMESTAMP '{LO}' AND created_at < TIMESTAMP '{MID}' THEN 'validation'
       WHEN created_at >= TIMESTAMP '{MID}' AND created_at < TIMESTAMP '{HI}' THEN 'test'
       ELSE 'excluded' END AS split
FROM stg_issues b LEFT JOIN seed_types t ON b.issuetype_raw = t.issuetype_raw
LEFT JOIN seed_resolutions r ON b.resolution_raw = r.resolution_raw) WHERE resolution IS NOT NULL
""")
block("clean_comments", f"""
SELECT * FROM (SELECT *, {clean('comment_body')} AS body FROM stg_comments) WHERE length(coalesce(body, '')) >= 10
""")
block("int_comments", """
SELECT key, left(string_agg(body, ' | ' ORDER BY comment_created, comment_id), 3000) AS all_comments,
  count(*) AS n_comments, count(DISTINCT comment_author) AS n_commenters,
  min(comment_created) AS first_comment_at, max(comment_created) AS last_comment_at
FROM clean_comments WHERE key IN (SELECT key FROM int_issues) GROUP BY key
""")
block("counted_changes", f"SELECT * FROM stg_changelog WHERE upper(field) IN ({strings(C.COUNTED_CHANGE_FIELDS)})")
_rank = "CASE upper({}) " + " ".join(f"WHEN {q(n)} THEN {r}" for n, r in C.PRIORITY_RANKS) + " END"
block("priority_events", f"""
SELECT key, created, from_string, to_string, {_rank.format('to_string')} AS prank, {_rank.format('from_string')} AS frank,
  row_number() OVER (PARTITION BY key ORDER BY created, author, to_string, from_string) AS change_order
FROM counted_changes WHERE upper(field) = 'PRIORITY'
""")
block("escalations", """
SELECT a.key, max(CASE WHEN b.prank > a.prank THEN 1 ELSE 0 END) AS was_escalated,
  max(CASE WHEN b.prank < a.prank THEN 1 ELSE 0 END) AS was_deescalated
FROM priority_events a JOIN priority_events b ON a.key = b.key AND b.change_order = a.change_order + 1 GROUP BY a.key
""")
block("first_assignees", """
SELECT key, to_string AS first_assignee FROM counted_changes WHERE upper(field) = 'ASSIGNEE' AND to_string IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY key ORDER BY created, author, to_string, from_string) = 1
""")
block("int_changelog", """
SELECT a.*, coalesce(e.was_escalated, 0)::INTEGER AS was_escalated,
  coalesce(e.was_deescalated, 0)::INTEGER AS was_deescalated, f.first_assignee
FROM (SELECT key, count(*) AS n_total_changes,
  count(CASE WHEN upper(field) = 'STATUS' THEN 1 END) AS n_status_changes,
  count(CASE WHEN upper(field) = 'PRIORITY' THEN 1 END) AS n_priority_changes,
  count(CASE WHEN upper(field) = 'ASSIGNEE' THEN 1 END) AS n_assignee_changes,
  count(CASE WHEN upper(field) = 'RESOLUTION' THEN 1 END) AS n_resolution_changes,
  count(DISTINCT author) AS n_people_involved FROM counted_changes GROUP BY key) a
LEFT JOIN escalations e ON a.key = e.key LEFT JOIN first_assignees f ON a.key = f.key
WHERE a.key IN (SELECT key FROM int_issues)
""")
block("int_links", """
SELECT key, count(*) AS n_links_total, count(CASE WHEN upper(type_name) = 'DUPLICATE' THEN 1 END) AS n_duplicates,
  count(CASE WHEN upper(type_name) = 'BLOCKS' AND inwardissue_key IS NOT NULL THEN 1 END) AS n_blocks,
  count(CASE WHEN upper(type_name) = 'BLOCKS' AND outwardissue_key IS NOT NULL THEN 1 END) AS n_blocked_by,
  count(CASE WHEN upper(type_name) = 'RELATES' THEN 1 END) AS n_relates,
  count(CASE WHEN upper(type_name) LIKE '%CLONES%' THEN 1 END) AS n_clones
FROM stg_links WHERE key IN (SELECT key FROM int_issues) GROUP BY key
""")
block("mart_ml", f"""
SELECT i.key, i.created_at, i.split, i.issuetype, i.resolution, i.summary AS summary_clean,
  i.description AS description_clean, coalesce(c.all_comments, '') AS comments_concat,
  left('TICKET: ' || coalesce(i.summary, '') || {NL} || 'PRI: ' || coalesce(i.priority, '') || {NL} || 'STATUS: '
    || coalesce(i.status, '') || {NL} || 'DESC: ' || left(coalesce(i.description, ''), 1500), 2000) AS text_noco,
  left('TICKET: ' || coalesce(i.summary, '') || {NL} || 'PRIORITY: ' || coalesce(i.priority, 'Unknown') || {NL}
    || 'STATUS: ' || coalesce(i.status, 'Unknown') || {NL} || 'N_COMMENTS: ' || coalesce(c.n_comments, 0)::VARCHAR || {NL}
    || 'DESCRIPTION: ' || left(coalesce(i.description, ''), 2000) || {NL} || 'DISCUSSION: '
    || left(coalesce(c.all_comments, ''), 2500), 6000) AS text_rich,
  i.priority, i.status, i.reporter, i.assignee,
  coalesce(l.n_total_changes, 0) AS n_total_changes, coalesce(l.n_status_changes, 0) AS n_status_changes,
  coalesce(l.n_priority_changes, 0) AS n_priority_changes, coalesce(l.n_assignee_changes, 0) AS n_assignee_changes,
  coalesce(l.n_resolution_changes, 0) AS n_resolution_changes, coalesce(l.was_escalated, 0) AS was_escalated,
  coalesce(l.was_deescalated, 0) AS was_deescalated, coalesce(l.n_people_involved, 0) AS n_people_involved,
  l.first_assignee, coalesce(k.n_links_total, 0) AS n_links_total, coalesce(k.n_duplicates, 0) AS n_duplicates,
  coalesce(k.n_blocks, 0) AS n_blocks, coalesce(k.n_blocked_by, 0) AS n_blocked_by,
  coalesce(k.n_relates, 0) AS n_relates, coalesce(c.n_comments, 0) AS n_comments,
  coalesce(c.n_commenters, 0) AS n_commenters, i.resolution_days, i.summary_length, i.description_length
FROM int_issues i LEFT JOIN int_comments c ON i.key = c.key LEFT JOIN int_changelog l ON i.key = l.key
LEFT JOIN int_links k ON i.key = k.key WHERE i.split IN ('train', 'validation', 'test')
""")


def _share(label: str) -> str:
    return pct(f"count(CASE WHEN resolution = {q(label)} THEN 1 END)", "count(*)")


block("mart_ops", f"""
SELECT month, issuetype, count(*) AS total_issues, sum(is_resolved)::BIGINT AS total_resolved,
  median(CASE WHEN is_resolved = 1 THEN resolution_days END)::DOUBLE AS median_resolution_days,
  avg(CASE WHEN is_resolved = 1 THEN resolution_days END)::DOUBLE AS avg_resolution_days,
  {_share('Fixed')} AS pct_fixed, {_share("Won't Fix")} AS pct_wontfix, {_share('Duplicate')} AS pct_duplicate,
  {_share('Cannot Reproduce')} AS pct_cannot_reproduce,
  {rnd('avg(summary_length)', 1)} AS avg_summary_length, {rnd('avg(description_length)', 1)} AS avg_description_length,
  {rnd('avg(n_comments)', 2)} AS avg_n_comments
FROM (SELECT date_trunc('month', i.created_at)::DATE AS month, issuetype, resolution, resolution_days, summary_length,
  description_length, coalesce(c.n_comments, 0) AS n_comments,
  CASE WHEN resolved_at IS NOT NULL THEN 1 ELSE 0 END AS is_resolved
  FROM int_issues i LEFT JOIN int_comments c ON i.key = c.key) GROUP BY month, issuetype
""")
block("type_counts", """
SELECT assignee, issuetype, count(*) AS n FROM int_issues GROUP BY 1, 2
""")
block("mart_workload", f"""
SELECT i.assignee, count(*) AS n_assigned, count(CASE WHEN resolution = 'Fixed' THEN 1 END) AS n_fixed,
  {rnd('avg(CASE WHEN resolved_at IS NOT NULL THEN resolution_days END)', 1)} AS avg_resolution_days,
  any_value(t.issuetype) AS top_issuetype, count(DISTINCT i.issuetype) AS n_distinct_issuetypes
FROM int_issues i JOIN (SELECT assignee, issuetype FROM type_counts
  QUALIFY row_number() OVER (PARTITION BY assignee ORDER BY n DESC, issuetype) = 1) t ON i.assignee = t.assignee
WHERE i.assignee IS NOT NULL AND i.assignee <> 'Unassigned' GROUP BY i.assignee
""")
block("mart_links", """
SELECT key, n_links_total, n_duplicates, n_blocks, n_blocked_by, n_relates,
  n_duplicates + n_blocks + n_blocked_by AS n_outgoing_plus_incoming FROM int_links WHERE n_links_total > 0
""")
block("anomaly_base", """
SELECT c.key, i.issuetype, i.resolution, i.priority, i.created_at, year(i.created_at)::INTEGER AS year_created,
  least(i.resolution_days, 5000)::INTEGER AS resolution_days, c.n_status_changes, c.n_assignee_changes,
  c.n_priority_changes, c.n_people_involved, c.was_escalated, c.was_deescalated, left(i.summary, 100) AS summary_excerpt,
  CASE WHEN c.n_status_changes > 5 OR c.n_assignee_changes > 3 THEN 1 ELSE 0 END AS flag_high_churn,
  CASE WHEN c.was_escalated = 1 AND c.was_deescalated = 1 THEN 1 ELSE 0 END AS flag_escalation_reversed,
  CASE WHEN c.n_people_involved > 5 THEN 1 ELSE 0 END AS flag_many_people
FROM int_changelog c JOIN int_issues i ON c.key = i.key
""")
block("anomalies", """
SELECT b.*, p.p99, CASE WHEN b.resolution_days >= p.p99 THEN 1 ELSE 0 END AS flag_outlier_resolution
FROM anomaly_base b JOIN (SELECT issuetype, quantile_cont(resolution_days, 0.99)::DOUBLE AS p99 FROM anomaly_base
GROUP BY 1) p ON b.issuetype = p.issuetype
""")

# --- vectors and scores -----------------------------------------------------------


def _unit(lo: int, hi: int) -> str:
    part = f"embedding[{lo}:{hi}]::DOUBLE[]"
    return f"list_transform({part}, lambda v: v / sqrt(list_inner_product({part}, {part})))"


block("vectors", f"""
SELECT m.*, e.vec_a, e.vec_b FROM mart_ml m JOIN (SELECT 'TKT-' || vec_id AS key, {_unit(1, 32)} AS vec_a,
  {_unit(33, 64)} AS vec_b FROM embeddings) e ON m.key = e.key
""")
block("train_rows", "SELECT * FROM vectors WHERE split = 'train'")
block("eval_rows", "SELECT * FROM vectors WHERE split = 'validation'")
block("pairs", f"""
SELECT e.key AS query_key, t.key AS key, {rnd('list_inner_product(e.vec_a, t.vec_a)', 9)} AS sim_a,
  {rnd('list_inner_product(e.vec_b, t.vec_b)', 9)} AS sim_b,
  (CASE WHEN e.priority = t.priority THEN 0.10::DOUBLE ELSE 0.0::DOUBLE END) AS b_priority,
  (CASE WHEN e.status = t.status THEN 0.08::DOUBLE ELSE 0.0::DOUBLE END) AS b_status,
  (CASE WHEN e.reporter = t.reporter THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END) AS b_reporter
FROM eval_rows e, train_rows t
""")
block("rrf_all", f"""
SELECT *, 1::DOUBLE / ({C.RRF_K} + rank_a) + 1::DOUBLE / ({C.RRF_K} + rank_b) AS rrf FROM (SELECT *,
  row_number() OVER (PARTITION BY query_key ORDER BY sim_a DESC, key) AS rank_a,
  row_number() OVER (PARTITION BY query_key ORDER BY sim_b DESC, key) AS rank_b FROM pairs)
""")
block("rrf_ranked", "SELECT *, row_number() OVER (PARTITION BY query_key ORDER BY rrf DESC, key) AS rk FROM rrf_all")
block("rrf30", f"SELECT * FROM rrf_ranked WHERE rk <= {C.RRF_TOP}")
block("scaler", "SELECT " + ", ".join(
    f"avg({c})::DOUBLE AS mean_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0::DOUBLE ELSE stddev_pop({c})::DOUBLE END AS std_{c}"
    for c in C.CHANGE_FEATURES) + " FROM train_rows")


def _distance(scaled: bool) -> str:
    terms = []
    for c in C.CHANGE_FEATURES:
        d = f"(t.{c} - e.{c})::DOUBLE" + (f" / s.std_{c}" if scaled else "")
        terms.append(f"({d}) * ({d})")
    return " + ".join(terms)


block("boosted_pairs", f"""
SELECT r.*, r.b_priority + r.b_status + r.b_reporter AS metadata,
  1::DOUBLE / (1 + sqrt({_distance(True)})) AS change_sim, 1::DOUBLE / (1 + sqrt({_distance(False)})) AS change_sim_raw,
  t.issuetype, t.resolution, t.text_noco AS cand_text, t.text_rich AS cand_text_rich, t.summary_clean AS cand_summary
FROM rrf30 r JOIN eval_rows e ON e.key = r.query_key JOIN train_rows t ON t.key = r.key CROSS JOIN scaler s
""")
block("fused_rows", f"""
SELECT *, {rnd('rrf + 0.15::DOUBLE * metadata + 0.10::DOUBLE * change_sim', 9)} AS score FROM boosted_pairs
""")
block("top15", f"""
SELECT * EXCLUDE (rk), rank AS rk FROM (SELECT *, row_number() OVER (PARTITION BY query_key ORDER BY score DESC, key) AS rank
FROM fused_rows) WHERE rank <= {C.FINAL_K}
""")
block("weighted_rows", "SELECT *, (sim_a + sim_b) / 2.0::DOUBLE AS weight FROM top15")


def vote(source: str, by: str = "query_key", weight: str = "weight", label: str = "label") -> str:
    """SELECT giving by, label, conf, margin, div, total, top1, top2 from neighbour rows."""
    return f"""
SELECT {by}, max(CASE WHEN rnk = 1 THEN {label} END) AS label, max(CASE WHEN rnk = 1 THEN label_score END) AS top1,
  coalesce(max(CASE WHEN rnk = 2 THEN label_score END), 0.0::DOUBLE) AS top2, max(total) AS total, count(*) AS div
FROM (SELECT *, {rnd(f'sum(label_score) OVER (PARTITION BY {by})', 9)} AS total,
  row_number() OVER (PARTITION BY {by} ORDER BY label_score DESC, best_rk, {label}) AS rnk
  FROM (SELECT {by}, {label}, {rnd(f'sum({weight})', 9)} AS label_score, min(rk) AS best_rk FROM {source} GROUP BY ALL))
GROUP BY ALL"""


CONF = "CASE WHEN total > 0 THEN top1 / total ELSE 0.0::DOUBLE END"
MARGIN = "CASE WHEN total > 0 THEN (top1 - top2) / total ELSE 0.0::DOUBLE END"

block("neighbours", """
SELECT query_key, 'issuetype' AS target, issuetype AS label, weight, rk, score FROM weighted_rows
UNION ALL SELECT query_key, 'resolution', resolution, weight, rk, score FROM weighted_rows
""")
block("label_votes", vote("neighbours", "query_key, target"))
block("gated_votes", f"""
SELECT *, {CONF} AS conf, {MARGIN} AS margin,
  CASE WHEN {CONF} >= 0.65 AND {MARGIN} >= 0.10 THEN 'DIRECT' ELSE 'LLM_REQUIRED' END AS routing FROM label_votes
""")
block("predictions", f"""
SELECT e.key, e.issuetype AS true_issuetype, e.resolution AS true_resolution, a.label AS pred_issuetype,
  b.label AS pred_resolution, {rnd('a.conf', 4)} AS conf_issuetype, {rnd('b.conf', 4)} AS conf_resolution,
  a.routing AS routing_issuetype, {rnd('a.margin', 4)} AS margin_issuetype, b.routing AS routing_resolution,
  {rnd('b.margin', 4)} AS margin_resolution, '' AS fix_summary
FROM eval_rows e JOIN gated_votes a ON a.query_key = e.key AND a.target = 'issuetype'
JOIN gated_votes b ON b.query_key = e.key AND b.target = 'resolution'
""")
block("outcomes", """
SELECT 'issuetype' AS target, true_issuetype AS true_label, pred_issuetype AS pred_label FROM predictions
UNION ALL SELECT 'resolution', true_resolution, pred_resolution FROM predictions
""")


def needed(text: str, seen: list[str] | None = None) -> list[str]:
    """Blocks used by ``text``, dependencies first."""
    order = seen if seen is not None else []
    for name in set(re.findall(r"[a-z_][a-z_0-9]*", text)):
        if name in BLOCKS and name not in order:
            needed(re.sub(rf"\b{name}\b", "", BLOCKS[name]), order)
            if name not in order:
                order.append(name)
    return order


def sql(body: str) -> str:
    names = needed(body)
    # names a body defines itself are its own
    if not names:
        return body.strip()
    head = ",\n".join(f"{n} AS ({BLOCKS[n]})" for n in names)
    return f"WITH {head}\n{body.strip()}"
