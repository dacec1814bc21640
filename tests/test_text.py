"""Text cleaning, layouts and scalar helpers."""

from __future__ import annotations

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from triagelake import constants as C
from triagelake.functions import scalars as S
from triagelake.functions import text as X

CASES = [
    ("a <b>bold</b> word", "a bold word"),
    ("x {code:java}int i;\nint j;{code} y", "x y"),
    ("x {CODE}a{Code} y {code}b{code} z", "x y z"),
    ("x {noformat}a\nb{noformat} y", "x y"),
    ("hi [~jane.doe] there", "hi there"),
    ("see https://example.com/a?b=1 now", "see now"),
    ("a\n\n\tb    c", "a b c"),
    ("{code}<p>{code} tail", "tail"),
    ("<a href='http://x.y'>link</a> end", "link end"),
    ("  lead and trail  ", "lead and trail"),
    ("one\ntwo", "one\ntwo"),
    (None, ""),
    ("{code}open block", "{code}open block"),
]


def test_cleaner_steps_alone_and_nested(spark):
    df = spark.createDataFrame(CASES, "raw string, want string")
    for row in df.select("raw", "want", X.clean_ticket_text(F.col("raw")).alias("got")).collect():
        assert row.got == row.want, row


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab<>[]~ \n\tx", max_size=60), min_size=1, max_size=40))
def test_cleaner_leaves_no_tag_and_no_run_of_blanks(spark, texts):
    """Without block markers nothing that is removed can uncover a new tag."""
    df = spark.createDataFrame([(t,) for t in texts], "raw string")
    for (got,) in df.select(X.clean_ticket_text(F.col("raw"))).collect():
        assert not re.search(r"<[^>]+>", got)
        assert not re.search(r"[\n\r\t ]{2,}", got) and got == got.strip(" ")


def test_layouts_fill_defaults_and_cut(spark):
    df = spark.createDataFrame([("s", None, None, "d" * 3000, "c" * 4000)], "s string, p string, t string, d string, c string")
    noco, rich = df.select(
        X.text_noco(F.col("s"), F.col("p"), F.col("t"), F.col("d")),
        X.text_rich(F.col("s"), F.col("p"), F.col("t"), F.lit(2), F.col("d"), F.col("c")),
    ).first()
    assert noco == "TICKET: s\nPRI: \nSTATUS: \nDESC: " + "d" * 1500
    assert rich == ("TICKET: s\nPRIORITY: Unknown\nSTATUS: Unknown\nN_COMMENTS: 2\nDESCRIPTION: " + "d" * 2000
                    + "\nDISCUSSION: " + "c" * 2500)


def test_enriched_layout_leaks_label_only_on_request(spark):
    df = spark.createDataFrame([("s", "Major", "Open", "why", "talk", "Bug")], "s string, p string, t string, r string, c string, l string")
    cols = [F.col(c) for c in "sptrc"]
    plain, leaky = df.select(X.text_enriched(*cols), X.text_enriched(*cols, F.col("l"))).first()
    assert "Bug" not in plain and leaky.startswith("TICKET: s\nTYPE: Bug | PRI: Major\n")


@pytest.mark.parametrize("value, digits, want", [
    (0.125, 2, 0.13), (-0.125, 2, -0.13), (2.5, 0, 3.0), (0.0, 2, 0.0), (-0.0001, 2, 0.0), (34.615384, 2, 34.62),
])
def test_rounding_is_half_away_from_zero(spark, value, digits, want):
    assert spark.range(1).select(S.round_half_up(F.lit(value), digits)).first()[0] == want


def test_days_are_capped_above_only(spark):
    rows = [("2000-01-01 23:59:00", "2000-01-02 00:01:00", 1), ("2000-01-01 00:00:00", None, 0),
            ("2000-01-01 00:00:00", "2030-01-01 00:00:00", 5000), ("2000-01-10 00:00:00", "2000-01-01 00:00:00", -9)]
    df = spark.createDataFrame(rows, "a string, b string, want int")
    got = df.select("want", S.capped_days(F.to_timestamp("a"), F.to_timestamp("b")).alias("got")).collect()
    assert all(r.want == r.got for r in got)


def test_split_boundaries_are_half_open(spark):
    rows = [("2021-12-31 23:59:59", "train"), ("2022-01-01 00:00:00", "validation"), ("2022-12-31 23:59:59", "validation"),
            ("2023-01-01 00:00:00", "test"), ("2024-01-01 00:00:00", "excluded"), (None, "excluded")]
    df = spark.createDataFrame(rows, "t string, want string")
    got = df.select("want", S.temporal_split(F.to_timestamp("t")).alias("got")).collect()
    assert all(r.want == r.got for r in got)


def test_safe_parsers_give_null(spark):
    df = spark.createDataFrame([("7", "2020-01-02"), ("x", "2020/01/03"), (None, "nope")], "n string, t string")
    got = df.select(S.try_long(F.col("n")), S.try_timestamp(F.col("t"), ["yyyy-MM-dd", "yyyy/MM/dd"]).cast("string")).collect()
    assert [tuple(r) for r in got] == [(7, "2020-01-02 00:00:00"), (None, "2020-01-03 00:00:00"), (None, None)]


def test_flag_names_skip_unset_and_unknown(spark):
    df = spark.createDataFrame([(1, 0, None, 1), (0, 0, 0, 0)], ", ".join(f"{c} int" for c, _ in C.ANOMALY_LABELS))
    assert [r[0] for r in df.select(S.flag_names()).collect()] == ["Churn, People", ""]


def test_numbered_line(spark):
    row = spark.range(1).select(S.numbered_line(F.lit(1), F.lit("Bug"), F.lit(0.12345)), S.numbered_line(F.lit(12), F.lit("Task"), F.lit(1.0))).first()
    assert tuple(row) == (" 1. Bug (score: 0.1235)", "12. Task (score: 1.0000)")


def test_tidy_response_strips_quotes_and_blanks(spark):
    df = spark.createDataFrame([(' "Bug"\n',), ("'New Feature'",), ("plain",)], "a string")
    assert [r[0] for r in df.select(X.tidy_response(F.col("a"))).collect()] == ["Bug", "New Feature", "plain"]
