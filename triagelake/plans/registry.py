"""Registry of named queries with the SQL that restates them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from triagelake.plans.oracle_base import sql
from triagelake.session import materialise
from triagelake.sources.bindings import Tracker

Build = Callable[[Tracker], DataFrame]

_BUILDS: dict[str, Build] = {}
_SQL: dict[str, str] = {}


def query(name: str, build: Build, statement: str | None) -> None:
    assert name not in _BUILDS, name
    _BUILDS[name] = build
    if statement is not None:
        _SQL[name] = sql(statement)


def _runner(build: Build) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: build(Tracker(spark, folder))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _runner(build) for name, build in _BUILDS.items()}


def all_sql() -> dict[str, str]:
    return dict(_SQL)


# the vector table is written once per session and state of the folder's files; every retrieval reads it
_WRITTEN: dict[tuple, DataFrame] = {}


def files_of(t: Tracker) -> tuple:
    """Number, bytes, last change and names of the Parquet files of a folder, listed
    through its file system without a job."""
    path = t.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(t.folder)
    fs = path.getFileSystem(t.spark.sparkContext._jsc.hadoopConfiguration())
    found, open_ = [], [path]
    while open_:
        for status in fs.listStatus(open_.pop()):
            if status.isDirectory():
                open_.append(status.getPath())
            elif status.getPath().getName().endswith(".parquet"):
                found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return tuple(sorted(found))


def vectors(t: Tracker) -> DataFrame:
    at = (t.spark.sparkContext.applicationId, t.folder, files_of(t))
    if at not in _WRITTEN:
        _WRITTEN[at] = materialise(t.vectors(), "vectors")
    return _WRITTEN[at]


def sides(t: Tracker) -> tuple[DataFrame, DataFrame]:
    """Query tickets (validation) and corpus (train)."""
    v = vectors(t)
    return v.where("split = 'validation'"), v.where("split = 'train'")


def stamp(x: str, name: str | None = None) -> Column:
    return F.date_format(x, "yyyy-MM-dd HH:mm:ss").alias(name or x)


def day(x: str, name: str | None = None) -> Column:
    return F.date_format(x, "yyyy-MM-dd").alias(name or x)


#: All blanks of Unicode, for engines whose \\s knows the ASCII ones only.
BLANK = r"[\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
WORDS = f"list_filter(string_split_regex(lower(coalesce(text, '')), '{BLANK}+'), lambda x: x <> '')"


def stripped(x: str) -> str:
    return f"regexp_replace(coalesce({x}, ''), '^{BLANK}+|{BLANK}+$', '', 'g')"


STAMP = "strftime({0}, '%Y-%m-%d %H:%M:%S')"
DAY = "strftime({0}, '%Y-%m-%d')"


def long(*names: str) -> list[Column]:
    return [F.col(n).cast("bigint").alias(n) for n in names]


def rounded(digits: int, *names: str) -> list[Column]:
    from triagelake.functions.scalars import round_half_up

    return [round_half_up(F.col(n), digits).alias(n) for n in names]
