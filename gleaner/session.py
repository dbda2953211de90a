"""Session helpers: a local session for tests and bench, and the shared folder for stage tables."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, tempfile.TemporaryDirectory] = {}
_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def local_session(name: str, cores: int | str = "*", **conf: str) -> SparkSession:
    """A session for tests and benches. On a cluster the session comes from spark-submit."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application, wherever the driver was started."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).parent
    folder = tempfile.TemporaryDirectory(prefix="gleaner-")
    archive = Path(folder.name) / "gleaner.zip"
    with zipfile.ZipFile(archive, "w") as bundle:
        for source in sorted(package.rglob("*.py")):
            bundle.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    # Executors fetch the file from the driver when they need it, so it stays until the driver ends.
    _shipped[app] = folder


def stage_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; on a cluster a
    machine-local folder would not be seen by the other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        app = context.applicationId
        if app not in _local_roots:
            _local_roots[app] = tempfile.TemporaryDirectory(prefix="gleaner-")
        root = _local_roots[app].name
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write a stage once as Parquet and read it back: later steps start from files, not from lineage."""
    path = stage_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Stages as by ``staged`` whose files go at the end, with the shuffle files that led to them."""
    paths = []

    def stage(df: DataFrame, label: str) -> DataFrame:
        paths.append(stage_path(df.sparkSession, label))
        df.write.option("compression", "zstd").parquet(paths[-1])
        return df.sparkSession.read.schema(df.schema).parquet(paths[-1])

    try:
        yield stage
    finally:
        for path in paths:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        let_go(spark)


def let_go(spark: SparkSession) -> None:
    """Plans that are no longer held give up their shuffle files now, not at some later collection."""
    gc.collect()
    spark._jvm.System.gc()


@contextmanager
def settings(spark: SparkSession, values: dict[str, object]) -> Iterator[None]:
    """Settings of the session for the jobs that run within."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, str(value))
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def read_source(spark: SparkSession, path: str) -> DataFrame:
    """Read Parquet; spread it out if it has fewer splits than there are cores.

    Spark cuts files so that every core gets a split of at least some megabytes, so fewer
    splits than cores means a small table. In one row group it would keep all its text work
    in one task; only such a small table is shuffled, a large one is left as it is.
    """
    df = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(2 * cores)
    return df
