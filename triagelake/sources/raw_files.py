"""Reading raw CSV exports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triagelake import constants as C

CORRUPT = "_corrupt_record"


def csv_schema(width: int) -> T.StructType:
    names = [f"c{i}" for i in range(1, width + 1)] + [CORRUPT]
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def null_out(df: DataFrame, tokens: Sequence[str] = tuple(C.NULL_TOKENS)) -> DataFrame:
    """Every null spelling becomes NULL in all string columns."""
    def cleaned(name: str):
        return F.when(~F.col(name).isin(list(tokens)), F.col(name)).alias(name)

    return df.select(*[
        cleaned(f.name) if isinstance(f.dataType, T.StringType) and f.name != CORRUPT else F.col(f.name)
        for f in df.schema
    ])


def read_raw_csv(
    spark: SparkSession, path: str | list[str], width: int, null_tokens: Sequence[str] = tuple(C.NULL_TOKENS),
    multi_line: bool = True, header: bool = True,
) -> DataFrame:
    """All columns as strings c1..cN plus the raw text of a row that does not fit.

    Texts hold line breaks, so a file is read by one task; deliver many files and
    turn them into Parquet once. With ``multi_line=False`` plain files split. Rows
    are always parsed in full: a pruned parse would not notice missing fields."""
    reader = spark.read.schema(csv_schema(width)).options(
        header=header, quote='"', escape='"', multiLine=multi_line, encoding="UTF-8", mode="PERMISSIVE",
        columnNameOfCorruptRecord=CORRUPT, enforceSchema=True, columnPruning=False,
    )
    return null_out(reader.csv(path), null_tokens)


def split_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that fit, and the first field and raw text of those that do not (Spark
    reads the raw text only next to a parsed column). Give it stored rows: on a plain
    read each side parses the files."""
    good = df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, df.where(F.col(CORRUPT).isNotNull()).select(df.columns[0], CORRUPT)


def project_positions(df: DataFrame, positions: Mapping[str, int]) -> DataFrame:
    """Pick and name columns by 1-based ordinal."""
    return df.select(*[F.col(df.columns[n - 1]).alias(name) for name, n in positions.items()])


def read_raw_table(spark: SparkSession, path: str | list[str], table: str, **options) -> DataFrame:
    """One of the four raw tables: rows that fit, needed columns by position."""
    good, _ = split_quarantine(read_raw_csv(spark, path, C.RAW_WIDTHS[table], **options))
    return project_positions(good, C.RAW_POSITIONS[table])


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Header names of a CSV file; reads one line."""
    return spark.read.options(header=True, quote='"', escape='"').csv(path).columns


def header_contract(spark: SparkSession, header: Sequence[str], needed: Sequence[str]) -> DataFrame:
    """Needed column, its 1-based position or NULL, and a status."""
    have = spark.createDataFrame([(list(header),)], "h array<string>").select(F.posexplode("h").alias("_p", "column_name"))
    first = have.groupBy("column_name").agg((F.min("_p") + 1).alias("position"))
    want = spark.createDataFrame([(list(needed),)], "h array<string>").select(F.explode("h").alias("column_name"))
    return want.join(first, "column_name", "left").withColumn(
        "status", F.when(F.col("position").isNull(), "NOT FOUND").otherwise("OK")
    )


def moved_columns(
    spark: SparkSession, path: str | list[str], names: Sequence[str], positions: Sequence[int]
) -> list[tuple[str, str, int, int | None]]:
    """Per file: needed columns that do not stand at their position (file, name, due,
    found). Reads one line of each file."""
    out = []
    for file in [path] if isinstance(path, str) else path:
        header = [h.strip().lower() for h in header_of(spark, file)]
        for name, due in zip(names, positions):
            found = header.index(name.lower()) + 1 if name.lower() in header else None
            if found != due and (len(header) < due or header[due - 1] != name.lower()):
                out.append((file, name, due, found))
    return out


def write_csv(df: DataFrame, path: str, null_value: str = "") -> None:
    """CSV that ``read_raw_csv`` reads back unchanged."""
    df.write.mode("overwrite").options(
        header=True, quote='"', escape='"', nullValue=null_value, emptyValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(path)
