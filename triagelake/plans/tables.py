"""Registered queries: sources, scalar expressions, joins, aggregates, windows,
dashboards and data checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagelake import constants as C
from triagelake.functions import scalars as S
from triagelake.functions import text as X
from triagelake.operators import dashboards as D
from triagelake.operators import enrichment as N
from triagelake.operators import features, marts, quality, staging
from triagelake.plans import incremental, jobs, registry
from triagelake.plans.oracle_base import NL, case, clean, pct, q, rnd, strings, values
from triagelake.plans.registry import DAY, STAMP, day, files_of, long, query, rounded, stamp
from triagelake.session import materialise, scratch_path
from triagelake.sources import bindings as B
from triagelake.sources import raw_files, tables, versions
from triagelake.sources.bindings import Tracker
from triagelake.streaming import changes


def scratch(t: Tracker, name: str) -> str:
    return scratch_path(t.spark, name)


# --- sources and sinks ---------------------------------------------------------------


def _bronze_csv(t: Tracker) -> DataFrame:
    path = scratch(t, "comments-csv")
    raw_files.write_csv(t.raw_comments(), path, null_value="None")
    return raw_files.read_raw_table(t.spark, path, "comments").withColumn("comment_body", F.md5("comment_body"))


query("s1_bronze_csv", _bronze_csv, """
SELECT key, comment_id, comment_author, md5(comment_body) AS comment_body, comment_created, comment_updated FROM raw_comments
""")
query("s2_project_positions", lambda t: raw_files.project_positions(
    t.table("lineitem"), {"key": 1, "line": 4, "flag": 9, "state": 10}), """
SELECT l_orderkey AS key, l_linenumber AS line, l_returnflag AS flag, l_linestatus AS state FROM lineitem
""")


def _header_contract(t: Tracker) -> DataFrame:
    """Headers of the customers' CSV export, read from its files."""
    path = scratch(t, "customers-csv")
    raw_files.write_csv(t.table("customer"), path)
    header = raw_files.header_of(t.spark, path)
    return raw_files.header_contract(t.spark, header, ["c_name", "c_custkey", "c_phone", "c_mktsegment", "comment.id"])


query("s4_header_contract", _header_contract, """
SELECT n.column_name, (h.cid + 1)::INTEGER AS position, CASE WHEN h.cid IS NULL THEN 'NOT FOUND' ELSE 'OK' END AS status
FROM (VALUES ('c_name'), ('c_custkey'), ('c_phone'), ('c_mktsegment'), ('comment.id')) n(column_name) LEFT JOIN pragma_table_info('customer') h ON h.name = n.column_name
""")


def _tolerant_rows(t: Tracker) -> DataFrame:
    """Event lines of which the error events lost their tail."""
    path = scratch(t, "events-csv")
    bad = F.col("event_type") == "error"
    fields = [F.col(c).cast("string") for c in ("event_id", "event_type", "user_id", "value")]
    line = F.when(bad, F.concat_ws(",", *fields[:2])).otherwise(F.concat_ws(",", *fields))
    t.table("events").select(line.alias("value")).write.text(path)
    rows = raw_files.read_raw_csv(t.spark, path, 4, multi_line=False, header=False)
    good, bad_rows = raw_files.split_quarantine(rows)
    return good.select(F.col("c1").alias("event_id"), F.lit("good").alias("outcome"), F.col("c3").alias("user_id")).unionByName(
        bad_rows.select(F.col("c1").alias("event_id"), F.lit("quarantine").alias("outcome"),
                        F.lit(None).cast("string").alias("user_id")))


query("s3_tolerant_load", _tolerant_rows, """
SELECT event_id::VARCHAR AS event_id, CASE WHEN event_type = 'error' THEN 'quarantine' ELSE 'good' END AS outcome,
  CASE WHEN event_type = 'error' THEN NULL ELSE user_id::VARCHAR END AS user_id FROM events
""")

_OPS = ["issuetype", "total_issues", "total_resolved", "median_resolution_days"]
_OPS_SQL = ["pct_fixed", "pct_wontfix", "pct_duplicate", "pct_cannot_reproduce", "avg_summary_length",
            "avg_description_length", "avg_n_comments"]


def _ops_out(df: DataFrame) -> DataFrame:
    return df.select(day("month"), *_OPS, *rounded(6, "avg_resolution_days"), *_OPS_SQL)


_OPS_STATEMENT = f"""
SELECT {DAY.format('month')} AS month, {', '.join(_OPS)}, {rnd('avg_resolution_days', 6)} AS avg_resolution_days,
  {', '.join(_OPS_SQL)} FROM mart_ops
"""


def _snapshot(t: Tracker) -> DataFrame:
    """The first version of a table that was overwritten since."""
    root, layer, name = scratch(t, "layers"), "marts_analytics", "mart_analytics_ops"
    first = tables.write_table(t.ops_mart(), root, layer, name)
    tables.write_table(first.where(F.col("total_issues") > 1), root, layer, name)
    return tables.read_table(t.spark, root, layer, name, 1)


query("s5_snapshot_read", lambda t: _ops_out(_snapshot(t)), _OPS_STATEMENT)
query("s5_layer_table", lambda t: _ops_out(tables.write_table(
    t.ops_mart(), scratch(t, "layers"), "marts_analytics", "mart_analytics_ops")), _OPS_STATEMENT)


def _raw(t: Tracker) -> dict[str, DataFrame]:
    return {"issues": t.table("orders"), "comments": t.table("conversations"), "changelog": t.table("events"),
            "issuelinks": t.table("lineitem")}


_RAW_SQL = {"issues": "orders", "comments": "conversations", "changelog": "events", "issuelinks": "lineitem"}
query("s6_row_counts", lambda t: quality.row_counts(_raw(t), C.MIN_ROWS), " UNION ALL ".join(
    f"SELECT {q(n)} AS table_name, count(*) AS row_count, {C.MIN_ROWS[n]}::BIGINT AS min_expected, "
    f"CASE WHEN count(*) >= {C.MIN_ROWS[n]} THEN 'OK' ELSE 'BELOW THRESHOLD' END AS status FROM {s}" for n, s in _RAW_SQL.items()))
query("s7_project_range", lambda t: quality.count_in_range(
    t.raw_issues().where(F.col("project_key") == B.PROJECT), *C.PROJECT_ROW_RANGE), f"""
SELECT count(*) AS row_count, CASE WHEN count(*) BETWEEN {C.PROJECT_ROW_RANGE[0]} AND {C.PROJECT_ROW_RANGE[1]} THEN 'OK'
  ELSE 'CHECK DATA' END AS status FROM raw_issues WHERE project_key = {q(B.PROJECT)}
""")
query("s8_count_tolerance", lambda t: quality.count_near(_raw(t), C.EXPECTED_ROWS), " UNION ALL ".join(
    f"SELECT {q(n)} AS table_name, count(*) AS row_count, {C.EXPECTED_ROWS[n]}::BIGINT AS expected, "
    f"CASE WHEN abs(count(*) - {C.EXPECTED_ROWS[n]})::DOUBLE / {C.EXPECTED_ROWS[n]} < 0.01 THEN 'OK' ELSE 'VERIFY' END AS status FROM {s}"
    for n, s in _RAW_SQL.items()))
query("s9_value_profile", lambda t: quality.value_profile(t.issues(), "resolution_raw"),
      "SELECT resolution_raw, count(*) AS n FROM stg_issues GROUP BY 1")


def _seed_use(t: Tracker) -> DataFrame:
    issues = t.issues()
    seed = features.seed_frame(issues, C.ISSUE_TYPE_SEED, ("issuetype_raw", "issuetype"))
    used = issues.groupBy("issuetype_raw").agg(F.count("*").alias("_n"))
    return seed.join(used, "issuetype_raw", "left").select(
        "issuetype_raw", "issuetype", F.coalesce("_n", F.lit(0)).cast("bigint").alias("n"))


query("s10_seed_use", _seed_use, """
SELECT s.issuetype_raw, s.issuetype, count(i.key) AS n FROM seed_types s
LEFT JOIN stg_issues i ON i.issuetype_raw = s.issuetype_raw GROUP BY 1, 2
""")


def _split_read(t: Tracker) -> DataFrame:
    root = scratch(t, "layers")
    columns = ["key", "split", "issuetype", "resolution", "priority", "status", "reporter", *C.CHANGE_FEATURES]
    tables.write_table(t.ml_mart().select(*columns), root, "MARTS_ML", "mart_ml", ["split"])
    return tables.read_split(t.spark, root, columns, ["train", "validation"]).select(
        *columns[:7], *long(*C.CHANGE_FEATURES))


_FEATURES = ", ".join(f"{c}::BIGINT AS {c}" for c in C.CHANGE_FEATURES)
query("s11_split_read", _split_read, f"""
SELECT key, split, issuetype, resolution, priority, status, reporter, {_FEATURES} FROM mart_ml WHERE split IN ('train', 'validation')
""")


def _typed_insert(t: Tracker) -> DataFrame:
    root, columns = scratch(t, "layers"), {"key": "string", "issuetype": "string", "resolution": "string",
                                           "resolution_days": "double"}
    for split in ("train", "validation"):
        tables.insert_into(t.cleaned().where(F.col("split") == split), root, "TRIAGE", "typed", columns, run=split)
        # a repeated run replaces its rows
        out = tables.insert_into(t.cleaned().where(F.col("split") == split), root, "TRIAGE", "typed", columns, run=split)
    return out


query("s12_typed_insert", _typed_insert, """
SELECT key, issuetype, resolution, resolution_days::DOUBLE AS resolution_days FROM int_issues WHERE split IN ('train', 'validation')
""")

# --- projections and scalar expressions -------------------------------------------------

query("p1_project_filter", lambda t: t.raw_issues().where(F.col("project_key") == B.PROJECT).select("key", "project_key"),
      f"SELECT key, project_key FROM raw_issues WHERE project_key = {q(B.PROJECT)}")
query("p2_staged_issues", lambda t: t.issues().select(
    "issue_id", "key", "summary", F.md5("description").alias("description_md5"), stamp("created_at"), stamp("resolved_at"),
    "issuetype_raw", "resolution_raw", "priority", "status", "project", "assignee", "reporter", "creator", "votes", "watches"), f"""
SELECT issue_id, key, summary, md5(description) AS description_md5, {STAMP.format('created_at')} AS created_at,
  {STAMP.format('resolved_at')} AS resolved_at, issuetype_raw, resolution_raw, priority, status, project, assignee,
  reporter, creator, votes, watches FROM stg_issues
""")
query("p3_safe_timestamp", lambda t: t.raw_issues().select(
    "key", F.date_format(S.try_timestamp(F.col("resolutiondate")), "yyyy-MM-dd HH:mm:ss").alias("ended"),
    F.date_format(S.try_timestamp(F.col("votes_votes"), ["yyyy-MM-dd", "yyyy/MM/dd"]), "yyyy-MM-dd").alias("never")), f"""
SELECT key, {STAMP.format('try_cast(resolutiondate AS TIMESTAMP)')} AS ended, NULL::VARCHAR AS never FROM raw_issues
""")
query("p4_safe_number", lambda t: t.raw_issues().select("key", S.try_long(F.col("votes_votes")).alias("votes")),
      "SELECT key, try_cast(votes_votes AS BIGINT) AS votes FROM raw_issues")
query("p5_blank_default", lambda t: t.raw_issues().select("key", S.blank_to(F.col("assignee"), "Unassigned").alias("assignee")),
      "SELECT key, coalesce(nullif(trim(assignee), ''), 'Unassigned') AS assignee FROM raw_issues")
query("p6_field_filter", lambda t: staging.type_changelog(t.raw_changelog()).select("key", "field", stamp("created"), "to_string"), f"""
SELECT key, field, {STAMP.format('try_cast(created AS TIMESTAMP)')} AS created, tostring AS to_string
FROM raw_changelog WHERE upper(field) IN ({strings(C.STAGED_CHANGE_FIELDS)})
""")
query("p7_clean_text", lambda t: t.table("pages").select("page_id", X.clean_ticket_text(F.col("html")).alias("cleaned")),
      f"SELECT page_id, {clean('html')} AS cleaned FROM pages")
query("p8_min_length", lambda t: features.clean_comments(t.comments()).select("key", "comment_id", "body"),
      "SELECT key, comment_id, body FROM clean_comments")
query("p9_text_length", lambda t: t.raw_issues().select(
    "key", X.text_length(F.col("summary")).cast("bigint").alias("summary_length"),
    X.text_length(F.col("description")).cast("bigint").alias("description_length")), """
SELECT key, length(coalesce(summary, '')) AS summary_length, length(coalesce(description, '')) AS description_length FROM raw_issues
""")
query("p10_capped_days", lambda t: t.issues().select("key", S.capped_days(F.col("created_at"), F.col("resolved_at")).cast("bigint").alias("days"),
    S.capped_days(F.col("created_at"), F.col("resolved_at"), 365).cast("bigint").alias("days_365")), """
SELECT key, least(coalesce(date_diff('day', created_at, resolved_at), 0), 5000) AS days,
  least(coalesce(date_diff('day', created_at, resolved_at), 0), 365) AS days_365 FROM stg_issues
""")
query("p11_temporal_split", lambda t: t.cleaned().select("key", "split"), "SELECT key, split FROM int_issues")
query("p12_priority_rank", lambda t: staging.type_changelog(t.raw_changelog()).where(F.upper("field") == "PRIORITY").select(
    "key", stamp("created"), "to_string", S.category_rank(F.col("to_string")).alias("prank")), f"""
SELECT key, {STAMP.format('try_cast(created AS TIMESTAMP)')} AS created, tostring AS to_string,
  CASE upper(tostring) {' '.join(f'WHEN {q(n)} THEN {r}' for n, r in C.PRIORITY_RANKS)} END AS prank
FROM raw_changelog WHERE upper(field) = 'PRIORITY'
""")
query("p13_text_noco", lambda t: t.ml_mart().select("key", "text_noco"), "SELECT key, text_noco FROM mart_ml")
query("p14_text_rich", lambda t: t.ml_mart().select("key", F.length("text_rich").cast("bigint").alias("n"), F.md5("text_rich").alias("text_rich")),
      "SELECT key, length(text_rich) AS n, md5(text_rich) AS text_rich FROM mart_ml")


def _cause_texts(t: Tracker) -> DataFrame:
    m = t.ml_mart()
    summary, pri, status, c = F.col("summary_clean"), F.col("priority"), F.col("status"), F.col("comments_concat")
    cause = X.text_cause_input(summary, pri, status, F.col("description_clean"), c)
    return m.select("key", cause.alias("cause_input"),
                    X.text_enriched(summary, pri, status, summary, c).alias("enriched"),
                    X.text_enriched(summary, pri, status, summary, c, F.col("issuetype")).alias("enriched_leaky"))


_head = f"left('TICKET: ' || summary_clean || {NL} || {{}} || coalesce(priority, '') || {NL} || 'STATUS: ' || coalesce(status, '') || {NL} || 'RCA: ' || summary_clean || {NL} || 'COMMENTS: ' || left(comments_concat, 1500), 2500)"
query("p15_cause_texts", _cause_texts, f"""
SELECT key, left('Summary: ' || summary_clean || {NL} || 'Priority: ' || coalesce(priority, '') || {NL} || 'Status: '
  || coalesce(status, '') || {NL} || 'Description: ' || left(description_clean, 1500) || {NL} || 'Comments: '
  || left(comments_concat, 1000), 3500) AS cause_input, {_head.format("'PRI: '")} AS enriched,
  {_head.format("'TYPE: ' || issuetype || ' | PRI: '")} AS enriched_leaky FROM mart_ml
""")
query("p16_month_year", lambda t: t.issues().select("key", F.date_format(S.month_of(F.col("created_at")), "yyyy-MM-dd").alias("month"),
    F.year("created_at").cast("bigint").alias("year")), f"""
SELECT key, {DAY.format("date_trunc('month', created_at)")} AS month, year(created_at) AS year FROM stg_issues
""")
query("p17_excerpt", lambda t: t.cleaned().select("key", S.excerpt(F.col("summary"), 80).alias("e80"), S.excerpt(F.col("description"), 100).alias("e100")),
      "SELECT key, left(summary, 80) AS e80, left(description, 100) AS e100 FROM int_issues")
query("p18_filled_features", lambda t: t.ml_mart().select("key", *[F.col(c).cast("double").alias(c) for c in C.CHANGE_FEATURES]),
      f"SELECT key, {', '.join(f'{c}::DOUBLE AS {c}' for c in C.CHANGE_FEATURES)} FROM mart_ml")
query("p19_flags", lambda t: D.anomaly_base(t.all_change_features(), t.cleaned()).select(
    "key", "flag_high_churn", "flag_escalation_reversed", "flag_many_people"),
    "SELECT key, flag_high_churn, flag_escalation_reversed, flag_many_people FROM anomaly_base")
query("p20_safe_ratio", lambda t: t.change_features().select("key", S.round_half_up(
    S.safe_ratio(F.col("n_status_changes"), F.col("n_priority_changes")), 4).alias("ratio"),
    S.pct(F.col("n_assignee_changes"), F.col("n_total_changes"), 2).alias("pct_assignee")), f"""
SELECT key, {rnd('n_status_changes::DOUBLE / nullif(n_priority_changes::DOUBLE, 0)', 4)} AS ratio,
  {pct('n_assignee_changes', 'n_total_changes')} AS pct_assignee FROM int_changelog
""")
query("p21_like", lambda t: t.links().where(F.upper("type_name").like("%CLONES%")).select("key", "type_name", F.lower("type_name").alias("lower_name")),
      "SELECT key, type_name, lower(type_name) AS lower_name FROM stg_links WHERE upper(type_name) LIKE '%CLONES%'")
query("p24_tokens", lambda t: t.table("documents").select(
    "doc_id", F.size(X.tokens(F.col("text"))).cast("bigint").alias("n_words"),
    F.md5(F.array_join(X.tokens(F.col("text")), " ")).alias("words_md5")),
    f"SELECT doc_id, len(w) AS n_words, md5(array_to_string(w, ' ')) AS words_md5 FROM (SELECT doc_id, {registry.WORDS} AS w FROM documents)")
query("p25_query_prefix", lambda t: t.table("benchmark").select("item_id", X.with_query_prefix(F.col("text")).alias("asked")),
      f"SELECT item_id, {q(C.QUERY_PREFIX)} || coalesce(text, '') AS asked FROM benchmark")
query("p27_valid_input", lambda t: t.cleaned().select("key", F.when(N.valid_input(F.col("summary"), F.col("description")), "valid").otherwise("quarantine").alias("outcome")), f"""
SELECT key, CASE WHEN length({registry.stripped('summary')}) >= 10 AND length({registry.stripped('description')}) >= 20 THEN 'valid' ELSE 'quarantine' END AS outcome FROM int_issues
""")
query("p28_selection", lambda t: D.selected(D.resolution_times(t.cleaned()), ["Bug", "Task"], ["Major", "Minor", "Blocker"], (1996, 1999)).select(
    "key", "issuetype", "priority", *long("year_created", "days")), """
SELECT key, issuetype, priority, year(created_at) AS year_created, least(resolution_days, 365)::BIGINT AS days FROM int_issues
WHERE resolved_at IS NOT NULL AND issuetype IN ('Bug', 'Task') AND priority IN ('Major', 'Minor', 'Blocker') AND year(created_at) BETWEEN 1996 AND 1999
""")
_flag_sql = "concat_ws(', ', " + ", ".join(f"CASE WHEN {c} = 1 THEN {q(n)} END" for c, n in C.ANOMALY_LABELS) + ")"
query("p29_flag_names", lambda t: D.anomalies(t.all_change_features(), t.cleaned()).select("key", S.flag_names().alias("anomalies")),
      f"SELECT key, {_flag_sql} AS anomalies FROM anomalies")
query("p30_any_flag", lambda t: D.anomalies(t.all_change_features(), t.cleaned()).where(
    S.any_flag(["flag_high_churn", "flag_outlier_resolution"])).select("key", "resolution_days"),
    "SELECT key, resolution_days FROM anomalies WHERE greatest(flag_high_churn, flag_outlier_resolution) = 1")
query("p31_guidance", lambda t: t.cleaned().select(
    "key", N.guidance(F.col("issuetype"), N.ROUTES, N.ROUTE_ELSE).alias("routing_guidance"),
    N.guidance(F.col("resolution"), N.STEPS, N.STEP_ELSE).alias("next_step")), f"""
SELECT key, {case('issuetype', N.ROUTES, q(N.ROUTE_ELSE))} AS routing_guidance,
  {case('resolution', N.STEPS, q(N.STEP_ELSE))} AS next_step FROM int_issues
""")

# --- joins -----------------------------------------------------------------------------------

query("j1_label_consolidation", lambda t: features.consolidate_labels(t.issues()).select(
    "key", "issuetype_raw", "resolution_raw", "issuetype", "resolution"), """
SELECT b.key, b.issuetype_raw, b.resolution_raw, coalesce(t.issuetype, 'Other') AS issuetype, r.resolution FROM stg_issues b
LEFT JOIN seed_types t ON b.issuetype_raw = t.issuetype_raw LEFT JOIN seed_resolutions r ON b.resolution_raw = r.resolution_raw
""")
query("j2_staged_comments", lambda t: t.comments().select(
    "key", "comment_id", "comment_author", "comment_body", stamp("comment_created"), stamp("comment_updated")), f"""
SELECT key, comment_id, comment_author, comment_body, {STAMP.format('comment_created')} AS comment_created,
  {STAMP.format('comment_updated')} AS comment_updated FROM stg_comments
""")
query("j2_staged_changelog", lambda t: t.changelog().select("key", "author", stamp("created"), "field", "from_string", "to_string"), f"""
SELECT key, author, {STAMP.format('created')} AS created, field, from_string, to_string FROM stg_changelog
""")
query("j2_staged_links", lambda t: t.links(), "SELECT key, type_name, inwardissue_key, outwardissue_key FROM stg_links")
_MART_LONGS = ["n_total_changes", "n_status_changes", "n_priority_changes", "n_assignee_changes", "n_resolution_changes",
               "was_escalated", "was_deescalated", "n_people_involved", "n_links_total", "n_duplicates", "n_blocks",
               "n_blocked_by", "n_relates", "n_comments", "n_commenters", "resolution_days", "summary_length", "description_length"]
_MART_TEXTS = ["summary_clean", "description_clean", "comments_concat", "text_noco", "text_rich"]
_MART_PLAIN = ["key", "split", "issuetype", "resolution", "priority", "status", "reporter", "assignee", "first_assignee"]
query("j3_ml_mart", lambda t: t.ml_mart().select(
    *_MART_PLAIN, day("created_at"), *[F.md5(c).alias(c) for c in _MART_TEXTS], *long(*_MART_LONGS)), f"""
SELECT {', '.join(_MART_PLAIN)}, {DAY.format('created_at')} AS created_at, {', '.join(f'md5({c}) AS {c}' for c in _MART_TEXTS)},
  {', '.join(f'{c}::BIGINT AS {c}' for c in _MART_LONGS)} FROM mart_ml
""")


def _steps(t: Tracker) -> DataFrame:
    """Consecutive priority events of a key; the global positions come from range
    slices, so neighbours meet on (key, position)."""
    events = features.event_order(t.changelog()).select("key", "change_order", S.category_rank(F.col("to_string")).alias("prank"))
    after = events.select("key", (F.col("change_order") - 1).alias("change_order"), F.col("prank").alias("next_rank"))
    return events.join(after, ["key", "change_order"]).select("key", *long("change_order"), "prank", "next_rank")


query("j4_consecutive_events", _steps, """
SELECT a.key, a.change_order, a.prank, b.prank AS next_rank FROM priority_events a
JOIN priority_events b ON a.key = b.key AND b.change_order = a.change_order + 1
""")
query("j5_first_assignee", lambda t: t.change_features().select("key", "first_assignee"), "SELECT key, first_assignee FROM int_changelog")
query("j6_links_with_issues", lambda t: t.all_links_mart().join(t.cleaned().select("key", "issuetype", "resolution"), "key").select(
    "key", "n_links_total", "issuetype", "resolution"), """
SELECT l.key, l.n_links_total, i.issuetype, i.resolution FROM mart_links l JOIN int_issues i ON l.key = i.key
""")


def _cache(t: Tracker) -> DataFrame:
    """Stored summaries: those of tickets that never changed."""
    return t.ml_mart().where("n_total_changes = 0").select("key", F.concat(F.lit("cached: "), S.excerpt(F.col("summary_clean"), 40)).alias("fix_summary"))


CACHE_SQL = "(SELECT key, 'cached: ' || left(summary_clean, 40) AS fix_summary FROM mart_ml WHERE n_total_changes = 0)"


def _hit_or_miss(t: Tracker) -> DataFrame:
    hits, misses = N.split_by_cache(t.cleaned().select("key"), _cache(t))
    return hits.unionByName(misses, allowMissingColumns=True)


query("j12_cache_split", _hit_or_miss, f"SELECT i.key, c.fix_summary FROM int_issues i LEFT JOIN {CACHE_SQL} c ON c.key = i.key")
query("j13_group_stat_join", lambda t: D.anomalies(t.all_change_features(), t.cleaned()).select("key", "issuetype", *rounded(6, "p99"), "flag_outlier_resolution"),
      f"SELECT key, issuetype, {rnd('p99', 6)} AS p99, flag_outlier_resolution FROM anomalies")

# --- aggregates --------------------------------------------------------------------------------

_CH = ["n_total_changes", "n_status_changes", "n_priority_changes", "n_assignee_changes", "n_resolution_changes", "n_people_involved"]
query("a1_change_counts", lambda t: t.change_features().select("key", *_CH), f"SELECT key, {', '.join(_CH)} FROM int_changelog")
query("a1_link_counts", lambda t: t.link_features(), "SELECT * FROM int_links")
query("a2_distinct_people", lambda t: features.comment_stats(features.clean_comments(t.comments())).select("key", "n_comments", "n_commenters"),
      "SELECT key, count(*) AS n_comments, count(DISTINCT comment_author) AS n_commenters FROM clean_comments GROUP BY key")
query("a3_comment_rollup", lambda t: t.comment_features().select("key", "all_comments"), "SELECT key, all_comments FROM int_comments")
query("a4_comment_snippets", lambda t: features.comment_snippets(features.clean_comments(t.comments())), """
SELECT key, string_agg(left(body, 400), ' || ' ORDER BY comment_created, comment_id, left(body, 400)) AS comment_snippets FROM (SELECT *,
  row_number() OVER (PARTITION BY key ORDER BY comment_created, comment_id, left(body, 400)) AS up,
  row_number() OVER (PARTITION BY key ORDER BY comment_created DESC, comment_id DESC, left(body, 400) DESC) AS down FROM clean_comments)
WHERE up <= 5 OR down <= 3 GROUP BY key
""")
query("a5_first_last", lambda t: t.comment_features().select("key", stamp("first_comment_at"), stamp("last_comment_at")), f"""
SELECT key, {STAMP.format('first_comment_at')} AS first_comment_at, {STAMP.format('last_comment_at')} AS last_comment_at FROM int_comments
""")
query("a6_conditional_median", lambda t: t.ops_mart().select(day("month"), "issuetype", "median_resolution_days"),
      f"SELECT {DAY.format('month')} AS month, issuetype, median_resolution_days FROM mart_ops")
query("a7_conditional_mean", lambda t: t.ops_mart().select(day("month"), "issuetype", *rounded(6, "avg_resolution_days"), "avg_summary_length", "avg_n_comments"),
      f"SELECT {DAY.format('month')} AS month, issuetype, {rnd('avg_resolution_days', 6)} AS avg_resolution_days, avg_summary_length, avg_n_comments FROM mart_ops")
_SHARES = ["pct_fixed", "pct_wontfix", "pct_duplicate", "pct_cannot_reproduce"]
query("a8_class_shares", lambda t: t.ops_mart().select(day("month"), "issuetype", *_SHARES),
      f"SELECT {DAY.format('month')} AS month, issuetype, {', '.join(_SHARES)} FROM mart_ops")
query("a9_mode", lambda t: marts.most_frequent(t.cleaned(), ["assignee"], "issuetype", "top_issuetype"), """
SELECT assignee, issuetype AS top_issuetype FROM type_counts QUALIFY row_number() OVER (PARTITION BY assignee ORDER BY n DESC, issuetype) = 1
""")
query("a10_ops_monthly", lambda t: _ops_out(t.ops_mart()), _OPS_STATEMENT)
query("a11_workload", lambda t: t.workload_mart(), "SELECT * FROM mart_workload")


def _in_three_updates(t: Tracker) -> str:
    """A folder brought up to date with a third of all raw rows at a time; all that
    arrive later change tickets that are there."""
    at = (t.spark.sparkContext.applicationId, t.folder, files_of(t))
    if at not in _UPDATED:
        root = scratch(t, "incremental")
        raw = {"issues": t.raw_issues(), "comments": t.raw_comments(), "changelog": t.raw_changelog(), "issuelinks": t.raw_links()}
        raw = {name: materialise(df.withColumn("_turn", F.pmod(F.xxhash64(*df.columns), F.lit(3))), f"turns-{name}", "zstd") for name, df in raw.items()}
        for turn in range(3):
            arrived = {name: df.where(F.col("_turn") == turn).drop("_turn") for name, df in raw.items()}
            incremental.update(t.spark, root, arrived, f"turn-{turn}", B.PROJECT, B.SPLIT_BOUNDS, buckets=4)
            versions.forget_past(t.spark, root)  # nobody reads the updates before
        _UPDATED[at] = root
    return _UPDATED[at]


_UPDATED: dict[tuple, str] = {}
query("j3_incremental_mart", lambda t: incremental.read(t.spark, _in_three_updates(t), "mart_ml").select(
    *_MART_PLAIN, day("created_at"), *[F.md5(c).alias(c) for c in _MART_TEXTS], *long(*_MART_LONGS)), f"""
SELECT {', '.join(_MART_PLAIN)}, {DAY.format('created_at')} AS created_at, {', '.join(f'md5({c}) AS {c}' for c in _MART_TEXTS)},
  {', '.join(f'{c}::BIGINT AS {c}' for c in _MART_LONGS)} FROM mart_ml
""")
query("a10_incremental_ops", lambda t: _ops_out(incremental.ops(t.spark, _in_three_updates(t))), _OPS_STATEMENT)
query("a11_incremental_workload", lambda t: incremental.workload(t.spark, _in_three_updates(t)), "SELECT * FROM mart_workload")
query("a12_links_mart", lambda t: t.links_mart(), "SELECT * FROM mart_links")
query("a13_kpis", lambda t: D.kpis(t.ops_mart()), f"""
SELECT sum(total_issues)::BIGINT AS total_issues, sum(total_resolved)::BIGINT AS total_resolved,
  {pct('sum(total_resolved)', 'sum(total_issues)', 1)} AS pct_resolved, {rnd('avg(median_resolution_days)', 1)} AS avg_median_resolution_days,
  {pct("sum(CASE WHEN issuetype = 'Bug' THEN total_issues END)", 'sum(total_issues)', 1)} AS pct_bug,
  {pct("sum(CASE WHEN issuetype = 'Improvement' THEN total_issues END)", 'sum(total_issues)', 1)} AS pct_improvement FROM mart_ops
""")
query("a14_totals_by_type", lambda t: D.totals_by_type(t.ops_mart()), "SELECT issuetype, sum(total_issues)::BIGINT AS n FROM mart_ops GROUP BY 1")
query("a15_resolution_totals", lambda t: D.resolution_totals(t.ops_mart()).select(*rounded(4, "fixed", "wontfix", "duplicate", "cannot_reproduce"), "total"),
      "SELECT " + ", ".join(f"{rnd(f'sum({c} * total_issues / 100.0::DOUBLE)', 4)} AS {n}" for c, n in zip(_SHARES, ["fixed", "wontfix", "duplicate", "cannot_reproduce"]))
      + ", sum(total_issues)::BIGINT AS total FROM mart_ops")
query("a14_monthly_trend", lambda t: D.monthly_trend(t.ops_mart()).select(day("month"), "issuetype", *long("total_issues")),
      f"SELECT {DAY.format('month')} AS month, issuetype, total_issues::BIGINT AS total_issues FROM mart_ops")
query("a16_type_by_resolution", lambda t: D.type_by_resolution_matrix(t.cleaned()), "SELECT issuetype, " + ", ".join(
    f"count(CASE WHEN resolution = {q(r)} THEN 1 END) AS \"{r}\"" for r in C.RESOLUTIONS) + " FROM int_issues GROUP BY 1")
_TIMES = "(SELECT key, issuetype, priority, least(resolution_days, 365)::INTEGER AS days FROM int_issues WHERE resolved_at IS NOT NULL)"


def _box_sql(by: str) -> str:
    return f"""
SELECT {by}, any_value(n) AS n, any_value(low) AS low, any_value(q1) AS q1, any_value(med) AS median, any_value(q3) AS q3,
  any_value(high) AS high, min(CASE WHEN days BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN days END) AS whisker_low,
  max(CASE WHEN days BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN days END) AS whisker_high
FROM {_TIMES} x JOIN (SELECT {by} AS g, count(*) AS n, min(days)::DOUBLE AS low, quantile_cont(days, 0.25)::DOUBLE AS q1,
  quantile_cont(days, 0.5)::DOUBLE AS med, quantile_cont(days, 0.75)::DOUBLE AS q3, max(days)::DOUBLE AS high FROM {_TIMES} GROUP BY 1) s
ON x.{by} = s.g GROUP BY 1"""


query("a17_box_by_type", lambda t: D.box_stats(D.resolution_times(t.cleaned()), "issuetype"), _box_sql("issuetype"))
query("a17_box_by_priority", lambda t: D.box_stats(D.resolution_times(t.cleaned()), "priority"), _box_sql("priority"))
query("a18_histogram", lambda t: D.histogram(D.resolution_times(t.cleaned())).select("bin", "n", "low_edge"), f"""
SELECT bin, n, {rnd('lo + bin * (hi - lo) / 50', 6)} AS low_edge FROM (SELECT lo, hi, least(floor((days - lo) / ((hi - lo) / 50)), 49)::BIGINT AS bin, count(*) AS n
FROM {_TIMES}, (SELECT min(days)::DOUBLE AS lo, max(days)::DOUBLE AS hi FROM {_TIMES}) GROUP BY ALL)
""")
query("a19_count_of_counts", lambda t: D.count_of_counts(t.change_features()), "SELECT n_assignee_changes, count(*) AS n_tickets FROM int_changelog GROUP BY 1")
query("a20_group_quantile", lambda t: D.group_quantile(D.anomaly_base(t.all_change_features(), t.cleaned()), "issuetype", "resolution_days", 0.99, "p99").select("issuetype", *rounded(6, "p99")),
      f"SELECT issuetype, {rnd('quantile_cont(resolution_days, 0.99)', 6)} AS p99 FROM anomaly_base GROUP BY 1")
query("a22_distinct_values", lambda t: t.cleaned().select("issuetype", "priority").distinct(), "SELECT DISTINCT issuetype, priority FROM int_issues")
query("a24_monthly_anomalies", lambda t: D.monthly_anomalies(t.all_change_features(), t.cleaned()).select(day("month"), "high_churn", "escalation_reversed", "many_people"), f"""
SELECT {DAY.format("date_trunc('month', created_at)")} AS month, sum(flag_high_churn)::BIGINT AS high_churn,
  sum(flag_escalation_reversed)::BIGINT AS escalation_reversed, sum(flag_many_people)::BIGINT AS many_people FROM anomaly_base GROUP BY 1
""")
_MISSING = ["resolved_at", "votes", "resolution_raw", "priority"]
query("a26_missing_values", lambda t: quality.missing_values(t.issues(), _MISSING),
      "SELECT " + ", ".join(f"count(CASE WHEN {c} IS NULL THEN 1 END) AS n_missing_{c}" for c in _MISSING) + " FROM stg_issues")

# --- windows, order, sets -----------------------------------------------------------------------

query("w1_keep_first", lambda t: t.first_lines().select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"),
      "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag FROM first_line")
query("w2_event_order", lambda t: features.event_order(t.changelog()).select("key", stamp("created"), "to_string", *long("change_order")),
      f"SELECT key, {STAMP.format('created')} AS created, to_string, change_order FROM priority_events")
query("w3_first_event", lambda t: staging.keep_first(
    t.changelog().where(F.upper("field") == "ASSIGNEE"), ["key"], ["created", "author", "to_string", "from_string"]).select("key", stamp("created"), "to_string"), f"""
SELECT key, {STAMP.format('created')} AS created, to_string FROM stg_changelog WHERE upper(field) = 'ASSIGNEE'
QUALIFY row_number() OVER (PARTITION BY key ORDER BY created, author, to_string, from_string) = 1
""")
query("w4_escalation", lambda t: t.change_features().select("key", "was_escalated", "was_deescalated"), "SELECT key, was_escalated, was_deescalated FROM int_changelog")


def _streamed_changes(t: Tracker) -> DataFrame:
    """The change events as a stream of files, one to a batch."""
    root, typed = scratch(t, "changes"), t.changelog()
    typed.repartitionByRange(3, "created").write.parquet(f"{root}/in")
    changes.watch_changes(t.spark, f"{root}/in", typed.schema, f"{root}/out", f"{root}/state", "36500 days", files_per_trigger=1).awaitTermination()
    return staging.only_known_keys(changes.current(t.spark, f"{root}/out"), t.cleaned())


query("w4_streamed_changes", _streamed_changes, """
SELECT key, was_escalated, was_deescalated, first_assignee FROM int_changelog
WHERE key IN (SELECT key FROM stg_changelog WHERE upper(field) IN ('PRIORITY', 'ASSIGNEE'))
""")
query("w4_escalation_with_initial", lambda t: t.change_features(include_initial=True).select("key", "was_escalated", "was_deescalated"), """
SELECT c.key, coalesce(max(CASE WHEN after > before THEN 1 ELSE 0 END), 0)::INTEGER AS was_escalated,
  coalesce(max(CASE WHEN after < before THEN 1 ELSE 0 END), 0)::INTEGER AS was_deescalated FROM int_changelog c
LEFT JOIN (SELECT a.key, a.prank AS before, b.prank AS after FROM priority_events a JOIN priority_events b
  ON a.key = b.key AND b.change_order = a.change_order + 1
  UNION ALL SELECT key, frank, prank FROM priority_events WHERE change_order = 1) s ON s.key = c.key GROUP BY c.key
""")
query("o1_anomaly_table", lambda t: D.anomaly_table(D.anomalies(t.all_change_features(), t.cleaned())).withColumn("year_created", F.col("year_created").cast("bigint")), f"""
SELECT key, issuetype, resolution, priority, year_created::BIGINT AS year_created, resolution_days, n_status_changes, n_assignee_changes,
  n_people_involved, {_flag_sql} AS anomalies, summary_excerpt FROM anomalies
WHERE greatest(flag_high_churn, flag_escalation_reversed, flag_many_people, flag_outlier_resolution) = 1
""")
query("o2_busiest", lambda t: D.busiest(t.workload_mart()), """
SELECT assignee, n_assigned, n_fixed, avg_resolution_days, top_issuetype AS dominant_issuetype FROM mart_workload
WHERE n_assigned >= 5 ORDER BY n_assigned DESC, assignee LIMIT 20
""")
for _name, _column in (("o2_most_duplicated", "n_duplicates"), ("o2_most_blocked", "n_blocked_by")):
    query(_name, lambda t, c=_column: D.top_linked(t.all_links_mart(), t.cleaned(), c), f"""
SELECT l.key, l.{_column}, i.issuetype, i.resolution, left(i.summary, 80) AS summary_excerpt FROM mart_links l
JOIN int_issues i ON l.key = i.key WHERE l.{_column} > 0 ORDER BY l.{_column} DESC, l.key LIMIT 20
""")
query("u1_link_totals", lambda t: D.link_totals(t.links_mart()), " UNION ALL ".join(
    f"SELECT {q(n)} AS type_name, sum({c})::BIGINT AS n_links FROM mart_links" for n, c in
    [("Duplicate", "n_duplicates"), ("Blocks", "n_blocks"), ("Blocked By", "n_blocked_by"), ("Relates", "n_relates")]))
_MONTH = DAY.format("date_trunc('month', created_at)")
query("u2_anomalies_long", lambda t: D.monthly_anomalies_long(D.monthly_anomalies(t.all_change_features(), t.cleaned())).select(day("month"), "anomaly", "n"), " UNION ALL ".join(
    f"SELECT {_MONTH} AS month, {q(n)} AS anomaly, sum({c})::BIGINT AS n FROM anomaly_base GROUP BY 1"
    for n, c in [("High churn", "flag_high_churn"), ("Escalation reversed", "flag_escalation_reversed"), ("Many people", "flag_many_people")]))


def _label_use(t: Tracker) -> DataFrame:
    """Inline label list with the number of issues of each label."""
    labels = t.spark.createDataFrame([(n, i) for i, n in enumerate(C.ISSUE_TYPES)], "issuetype string, place int")
    used = t.cleaned().groupBy("issuetype").agg(F.count("*").alias("_n"))
    return labels.join(used, "issuetype", "left").select("issuetype", "place", F.coalesce("_n", F.lit(0)).cast("bigint").alias("n"))


query("u4_inline_labels", _label_use, f"""
SELECT v.issuetype, v.place, count(i.key) AS n FROM (VALUES {values([(n, i) for i, n in enumerate(C.ISSUE_TYPES)])}) v(issuetype, place)
LEFT JOIN int_issues i ON i.issuetype = v.issuetype GROUP BY 1, 2
""")
query("m32_anomalies", lambda t: D.anomalies(t.all_change_features(), t.cleaned()).select("key", "resolution_days", *D.FLAGS),
      f"SELECT key, resolution_days, {', '.join(D.FLAGS)} FROM anomalies")
query("m32_anomaly_totals", lambda t: D.anomaly_totals(D.anomalies(t.all_change_features(), t.cleaned())), """
SELECT sum(greatest(flag_high_churn, flag_escalation_reversed, flag_many_people, flag_outlier_resolution))::BIGINT AS n_any,
  sum(flag_high_churn)::BIGINT AS n_high_churn, sum(flag_escalation_reversed)::BIGINT AS n_escalation_reversed,
  sum(flag_outlier_resolution)::BIGINT AS n_outlier_resolution, sum(flag_many_people)::BIGINT AS n_many_people FROM anomalies
""")

# --- data checks ------------------------------------------------------------------------------------

query("q1_not_null", lambda t: quality.row_failures(t.issues(), [(c, "not_null", None) for c in ("key", "votes", "resolved_at")]), " UNION ALL ".join(
    f"SELECT {q(c)} AS column_name, 'not_null' AS check_name, count(CASE WHEN {c} IS NULL THEN 1 END) AS failures FROM stg_issues" for c in ("key", "votes", "resolved_at")))
query("q2_unique", lambda t: quality.duplicated(t.table("lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_key")), "line_key"),
      "SELECT l_orderkey || '-' || l_linenumber AS line_key, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1")
query("q3_accepted_values", lambda t: quality.row_failures(t.issues(), [("issuetype_raw", "accepted_values", C.ISSUE_TYPES)]), f"""
SELECT 'issuetype_raw' AS column_name, 'accepted_values' AS check_name, count(*) AS failures FROM stg_issues WHERE issuetype_raw NOT IN ({strings(C.ISSUE_TYPES)})
""")
query("q4_relationship", lambda t: quality.orphans(t.raw_comments().unionByName(t.raw_changelog(), allowMissingColumns=True).select("key"), "key", t.cleaned()).groupBy("key").agg(F.count("*").alias("n")), """
SELECT key, count(*) AS n FROM (SELECT key FROM raw_comments UNION ALL SELECT key FROM raw_changelog)
WHERE key NOT IN (SELECT key FROM int_issues) GROUP BY 1
""")
query("q5_expression", lambda t: quality.row_failures(t.cleaned(), [("resolution_days", "expression", ">= 0 AND resolution_days <= 5000"), ("votes", "expression", "> 3")]), """
SELECT 'resolution_days' AS column_name, 'expression' AS check_name, count(*) AS failures FROM int_issues WHERE NOT (resolution_days >= 0 AND resolution_days <= 5000)
UNION ALL SELECT 'votes', 'expression', count(*) FROM int_issues WHERE NOT (votes > 3)
""")

_SUITE_BLOCKS = {
    "stg_issues": "stg_issues", "stg_comments": "stg_comments", "stg_changelog": "stg_changelog", "stg_issuelinks": "stg_links",
    "int_issues_cleaned": "int_issues", "int_comments_aggregated": "int_comments", "int_changelog_features": "int_changelog",
    "int_issuelinks_features": "int_links", "mart_ml": "mart_ml", "mart_analytics_ops": "mart_ops",
    "mart_analytics_workload": "mart_workload", "mart_analytics_links": "mart_links",
}


def _built_suite(t: Tracker) -> DataFrame:
    """The checks on the tables of a whole build, each stored once and read back."""
    raw = {"issues": t.raw_issues(), "comments": t.raw_comments(), "changelog": t.raw_changelog(), "issuelinks": t.raw_links()}
    return quality.run_suite(jobs.build(raw, scratch(t, "layers"), B.PROJECT, B.SPLIT_BOUNDS), project=B.PROJECT)


def _suite_sql() -> str:
    parts = []
    for table, column, kind, arg in quality.SUITE:
        source = _SUITE_BLOCKS[table]
        if kind == "not_null":
            test = f"SELECT count(*) FROM {source} WHERE {column} IS NULL"
        elif kind == "unique":
            test = f"SELECT count(*) FROM (SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
        elif kind == "accepted_values":
            test = f"SELECT count(*) FROM {source} WHERE {column} NOT IN ({strings([B.PROJECT] if arg == 'PROJECT' else arg)})"
        elif kind == "expression":
            test = f"SELECT count(*) FROM {source} WHERE NOT ({column} {arg})"
        else:
            test = f"SELECT count(*) FROM {source} WHERE {column} NOT IN (SELECT key FROM {_SUITE_BLOCKS[arg]})"
        parts.append(f"SELECT {q(table)} AS table_name, {q(column)} AS column_name, {q(kind)} AS check_name, ({test}) AS failures")
    return "SELECT *, CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (" + " UNION ALL ".join(parts) + ")"


query("q6_suite", _built_suite, _suite_sql())
