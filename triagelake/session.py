"""Session defaults and shared scratch storage."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join side even where that costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def get_session(app: str = "triagelake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


_OWN_DIRS: dict[str, str] = {}


def on_one_machine(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``. Only a session on
    one machine (tests) may name none; a temporary folder stands in."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not on_one_machine(spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _OWN_DIRS:
            _OWN_DIRS[app] = tempfile.mkdtemp(prefix="triagelake-")
        configured = _OWN_DIRS[app]
    return configured.rstrip("/")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, wherever they start. Done
    once per application, ahead of the first function that runs in a worker."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="triagelake-")) / "triagelake_package.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for source in sorted(package.rglob("*.py")):
                z.write(source, source.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(archive))
        _SHIPPED.add(app)


_SCOPES: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path per use; all of an application lie in one folder, those of a job in
    a folder of that."""
    inside = "/".join([spark.sparkContext.applicationId, *_SCOPES])
    return f"{shared_dir(spark)}/triagelake/{inside}/{name}-{uuid.uuid4().hex}"


@contextmanager
def job_scratch(spark: SparkSession) -> Iterator[None]:
    """Removes at its end what was stored meanwhile; only for jobs whose results are
    tables of their own."""
    _SCOPES.append(f"job-{uuid.uuid4().hex}")
    path = f"{shared_dir(spark)}/triagelake/{'/'.join([spark.sparkContext.applicationId, *_SCOPES])}"
    try:
        yield
    finally:
        _SCOPES.pop()
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def materialise(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back. Cuts
    the lineage, survives lost executors and keeps column pruning for readers.
    ``compression`` is that of the session unless named."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("error")
    (writer.option("compression", compression) if compression else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
