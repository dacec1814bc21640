"""The vector table is made of the tickets that have a vector; rows of others are left out where they are read."""

from __future__ import annotations

from triagelake.operators import staging
from triagelake.sources.bindings import Tracker

TABLES = {
    "documents": ("doc_id long, text string", [(i, f"Text number {i} of a document that says something") for i in range(5)]),
    "customer": ("c_custkey long, c_mktsegment string", [(1, "BUILDING"), (2, "MACHINERY")]),
    "supplier": ("s_suppkey long, s_name string", [(1, "ann"), (2, "bob")]),
    "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string",
               [(i, 1 + i % 2, "F", None, "1-URGENT") for i in range(40)]),
    "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                 "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
                 [(i, 1, 1, n, 1.0, 1.0, "A", "F", None) for i in range(40) for n in (1, 2)]),
    "events": ("event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
               [(i, None, i % 2, "purchase", 1.0, '{"k": 1}') for i in range(20)]),
    "conversations": ("conv_id long, turn long, role string, text string", [(i, 0, "user", "a comment long enough") for i in range(40)]),
    "embeddings": ("vec_id long, embedding array<float>, label string", [(i, [1.0] * 64, "x") for i in (3, 7, 7, 99)]),
}


def test_only_tickets_with_a_vector_are_staged(spark, tmp_path, monkeypatch):
    for name, (schema, rows) in TABLES.items():
        df = spark.createDataFrame(rows, schema)
        for day in ("o_orderdate", "l_shipdate", "ts"):
            if day in df.columns:
                df = df.selectExpr(*[f"timestamp_ntz'1998-05-05 00:00:00' AS {day}" if c == day else c for c in df.columns])
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    staged, typed = [], []
    issues, comments = staging.stage_issues, staging.type_comments
    monkeypatch.setattr(staging, "stage_issues", lambda raw, *more: staged.append(raw) or issues(raw, *more))
    monkeypatch.setattr(staging, "type_comments", lambda raw, *more: typed.append(raw) or comments(raw, *more))
    made = Tracker(spark, str(tmp_path)).vectors()
    assert sorted(r.key for r in made.select("key").collect()) == ["TKT-3", "TKT-7", "TKT-7"]
    assert {r.key for raw in staged for r in raw.select("key").collect()} == {"TKT-3", "TKT-7"}
    assert {r.key for raw in typed for r in raw.select("key").collect()} == {"TKT-3", "TKT-7"}
