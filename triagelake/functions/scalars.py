"""Column -> Column helpers for numbers, dates and categories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from triagelake import constants as C


def round_half_up(x: Column, digits: int) -> Column:
    """Round half away from zero on the binary value, which every engine
    computes alike (decimal rounding of doubles differs between engines)."""
    scale = float(10**digits)
    x = x.cast("double")
    return F.signum(x) * F.floor(F.abs(x) * scale + 0.5) / scale + F.lit(0.0)


def blank_to(x: Column, default: str) -> Column:
    return F.coalesce(F.nullif(F.trim(x), F.lit("")), F.lit(default))


def try_timestamp(x: Column, formats: Sequence[str] | None = None) -> Column:
    """First format that parses, else NULL; without formats the ISO casts."""
    if not formats:
        return F.try_to_timestamp(x)
    return F.coalesce(*[F.try_to_timestamp(x, F.lit(f)) for f in formats])


def try_long(x: Column) -> Column:
    return x.try_cast("bigint")


def capped_days(start: Column, end: Column, cap: int = 5000) -> Column:
    """Day boundaries between two times; no end counts 0; capped above only."""
    return F.least(F.coalesce(F.datediff(end, start), F.lit(0)), F.lit(cap))


def temporal_split(ts: Column, bounds: Sequence[str] = C.SPLIT_BOUNDS) -> Column:
    """Half-open ranges train | validation | test; the rest, NULL included, is
    'excluded'."""
    lo, mid, hi = (F.lit(b).cast("timestamp_ntz") for b in bounds)
    t = ts.cast("timestamp_ntz")
    return (
        F.when(t < lo, "train")
        .when((t >= lo) & (t < mid), "validation")
        .when((t >= mid) & (t < hi), "test")
        .otherwise("excluded")
    )


def category_rank(x: Column, ranks: Sequence[tuple[str, int]] = tuple(C.PRIORITY_RANKS)) -> Column:
    """Case-insensitive rank of a category; unknown and NULL give NULL."""
    out = None
    for name, rank in ranks:
        hit = F.upper(x) == name
        out = F.when(hit, rank) if out is None else out.when(hit, rank)
    return out


def in_ignoring_case(x: Column, values: Sequence[str]) -> Column:
    return F.upper(x).isin([v.upper() for v in values])


def flag(condition: Column) -> Column:
    """1 where true, 0 where false or unknown."""
    return F.when(condition, 1).otherwise(0)


def safe_ratio(x: Column, y: Column) -> Column:
    y = y.cast("double")
    return x.cast("double") / F.nullif(y, F.lit(0.0))


def pct(x: Column, y: Column, digits: int = 2) -> Column:
    return round_half_up(safe_ratio(x.cast("double") * 100.0, y), digits)


def month_of(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "month")


def excerpt(x: Column, n: int) -> Column:
    return F.substring(x, 1, n)


def confidence_band(conf: Column) -> Column:
    high, medium = C.CONFIDENCE_BANDS
    return F.when(conf >= high, "High").when(conf >= medium, "Medium").otherwise("Low")


def flag_names(pairs: Sequence[tuple[str, str]] = tuple(C.ANOMALY_LABELS)) -> Column:
    """Names of the set flags joined with ', '."""
    return F.concat_ws(", ", *[F.when(F.col(c) == 1, name) for c, name in pairs])


def any_flag(columns: Sequence[str]) -> Column:
    """True where at least one of the 0/1 columns is set; no column means all rows."""
    if not columns:
        return F.lit(True)
    return F.greatest(*[F.col(c) for c in columns], F.lit(0)) == 1


def numbered_line(rank: Column, label: Column, score: Column) -> Column:
    """`` 1. label (score: 0.1234)`` with the rank padded to two places."""
    return F.concat(
        F.lpad(rank.cast("string"), 2, " "), F.lit(". "), label,
        F.lit(" (score: "), F.format_string("%.4f", round_half_up(score, 4)), F.lit(")"),
    )
