"""Raw files, layers and sinks."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from triagelake import constants as C
from triagelake.sources import raw_files, tables


def test_null_spellings_quotes_and_line_breaks(spark, tmp_path):
    (tmp_path / "x.csv").write_text('key,body,n\nA,"two\nlines, ""quoted""",1\nB,NULL,nan\nC,,NaN\nD,none,None\nE,nones,0\n', encoding="utf-8")
    got = [tuple(r)[:3] for r in raw_files.read_raw_csv(spark, str(tmp_path / "x.csv"), 3).orderBy("c1").collect()]
    assert got == [("A", 'two\nlines, "quoted"', "1"), ("B", None, None), ("C", None, None), ("D", None, None), ("E", "nones", "0")]
    short = raw_files.read_raw_csv(spark, str(tmp_path / "x.csv"), 3, C.NULL_TOKENS_SHORT).where("c1 = 'D'").first()
    assert tuple(short)[:3] == ("D", "none", "None")


def test_bad_rows_are_set_aside_whatever_is_read(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b,c\n1,2,3\n4,5\n6,7,8,9\n", encoding="utf-8")
    good, bad = raw_files.split_quarantine(raw_files.read_raw_csv(spark, str(tmp_path / "x.csv"), 3))
    assert [r[0] for r in good.select("c1").collect()] == ["1"]
    assert sorted(r[1] for r in bad.collect()) == ["4,5", "6,7,8,9"]


@pytest.mark.parametrize("table", list(C.RAW_POSITIONS))
def test_positions_pick_the_named_columns(spark, tmp_path, table):
    width, positions = C.RAW_WIDTHS[table], C.RAW_POSITIONS[table]
    header = ",".join(f"h{i}" for i in range(1, width + 1))
    (tmp_path / "x.csv").write_text(f"{header}\n" + ",".join(f"v{i}" for i in range(1, width + 1)) + "\n", encoding="utf-8")
    row = raw_files.read_raw_table(spark, str(tmp_path / "x.csv"), table).first().asDict()
    assert row == {name: f"v{n}" for name, n in positions.items()}


def test_gzip_is_read(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "x.csv.gz", "wt", encoding="utf-8") as f:
        f.write("a,b\n1,é\n")
    assert tuple(raw_files.read_raw_csv(spark, str(tmp_path / "x.csv.gz"), 2).first())[:2] == ("1", "é")


def test_header_contract(spark, tmp_path):
    (tmp_path / "x.csv").write_text("key,comment.id,other\n1,2,3\n", encoding="utf-8")
    header = raw_files.header_of(spark, str(tmp_path / "x.csv"))
    got = {r.column_name: (r.position, r.status) for r in raw_files.header_contract(spark, header, ["key", "comment.id", "comment.body"]).collect()}
    assert got == {"key": (1, "OK"), "comment.id": (2, "OK"), "comment.body": (None, "NOT FOUND")}


def test_csv_round_trip(spark, tmp_path):
    rows = [("1", ' lead "q", x\n y '), ("2", None), ("3", "plain")]
    df = spark.createDataFrame(rows, "a string, b string")
    raw_files.write_csv(df, str(tmp_path / "c"))
    assert [tuple(r)[:2] for r in raw_files.read_raw_csv(spark, str(tmp_path / "c"), 2).orderBy("c1").collect()] == rows


def test_layers_and_split_pruning(spark, tmp_path):
    df = spark.createDataFrame([("a", "train", 1), ("b", "test", 2)], "key string, split string, n int")
    tables.write_table(df, str(tmp_path), " marts_ml ", "mart_ml", ["split"])
    assert (tmp_path / "MARTS_ML" / "mart_ml").exists()
    got = tables.read_split(spark, str(tmp_path), ["key"], ["train"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert [r.key for r in got.collect()] == ["a"] and "PartitionFilters: [isnotnull(split" in plan and "ReadSchema: struct<key:string>" in plan


def test_typed_insert_appends(spark, tmp_path):
    for n in ("1", "x"):
        df = spark.createDataFrame([(n, "k")], "n string, key string").withColumn("n", F.col("n").try_cast("int"))
        got = tables.insert_into(df, str(tmp_path), "triage", "t", {"key": "string", "n": "double"})
    assert got.columns == ["key", "n"] and sorted(r.n or 0 for r in got.collect()) == [0, 1.0]


def test_report_is_written_three_ways(spark, tmp_path):
    df = spark.createDataFrame([("full", 0.5)], "config string, acc double")
    tables.write_report(df, str(tmp_path), "r")
    assert spark.read.text(str(tmp_path / "TRIAGE" / "r_md")).first()[0] == "| full | 0.5000 |"
    assert spark.read.json(str(tmp_path / "TRIAGE" / "r_json")).count() == 1


def test_staging_view(spark):
    tables.as_view(spark.range(3).toDF("n"), " STAGING ", "stg_x")
    assert spark.sql("SELECT count(*) FROM staging_stg_x").first()[0] == 3
