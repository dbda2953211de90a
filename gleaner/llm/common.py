"""Helpers shared by the operators of this subpackage: stage tables, let-bindings and plain byte classes."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.session import stage_path

#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD_GAP = r"[\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


_collecting: list[list[str]] = []
_left: dict[str, list[str]] = {}


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Stage files that are made within last until the next scope of the application begins.

    A pipeline stage runs in such a scope: by the time the next one begins, its result has been written and its stage
    files are no longer read. Files made outside of a scope stay.
    """
    app = spark.sparkContext.applicationId
    remove(spark, _left.pop(app, []))
    let_go(spark)
    _collecting.append([])
    try:
        yield
    finally:
        _left[app] = _collecting.pop()


def let_go(spark: SparkSession) -> None:
    """Plans that are no longer held give up their shuffle files, broadcasts and driver memory now, not at some later collection."""
    gc.collect()
    spark._jvm.System.gc()


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000, size: int | None = None) -> Iterator[None]:
    """Jobs that run within get Arrow batches of at most so many rows, and of about so many bytes, so that a batch of whole texts stays small."""
    limits = {"spark.sql.execution.arrow.maxRecordsPerBatch": rows} | ({"spark.sql.execution.arrow.maxBytesPerBatch": size} if size else {})
    before = {name: spark.conf.get(name) for name in limits}
    for name, most in limits.items():
        held = int(before[name].lower().rstrip("b")) if before[name].lower().rstrip("b").lstrip("-").isdigit() else most
        spark.conf.set(name, min(most, held) if held > 0 else most)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders that this library has made, wherever Spark keeps them."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path that goes with the scope, if there is one."""
    path = stage_path(spark, label)
    if _collecting:
        _collecting[-1].append(path)
    return path


def stage(df: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """Write a stage as Parquet into the shared folder and go on from its files, not from lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, whatever the optimizer does with projections."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; ``lower`` would also change other letters."""
    return F.translate(text, UPPER, UPPER.lower())


def words_of(text: Column) -> Column:
    """The words of a text; a null text has none."""
    parts = F.split(F.coalesce(text, F.lit("")), WORD_GAP)
    return F.filter(parts, lambda w: w != "")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> dict[str, str]:
    """Column names for an operator's own use that do not clash with those of ``df`` (case apart)."""
    taken = {c.lower() for c in df.columns}
    found = {}
    for name in names:
        own = name
        while own.lower() in taken:
            own = f"_{own}"
        taken.add(own.lower())
        found[name] = own
    return found
