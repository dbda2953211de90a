"""Catalog tables: save, read by name, create with a typed schema, append."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EMBEDDING_TABLE_SCHEMA = "id BIGINT, pdf_name STRING, content STRING, embedding ARRAY<FLOAT>"


def save_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Overwrite a table and read it back, so that later steps use the stored rows."""
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return read_table(df.sparkSession, name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def create_table(
    spark: SparkSession, name: str, schema: str = EMBEDDING_TABLE_SCHEMA, path: str | None = None
) -> None:
    """Create the table unless it exists. Parquet tables have no identity column: keys come with the rows."""
    location = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet{location}")


def append_rows(df: DataFrame, name: str) -> None:
    """Append by column name; a missing or extra column is an error."""
    target = df.sparkSession.table(name)
    if set(target.columns) != set(df.columns):
        raise ValueError(f"columns of {name} are {target.columns}, got {df.columns}")
    df.select(*target.columns).write.mode("append").format("parquet").saveAsTable(name)


def rows_from_columns(df: DataFrame, keep: list[str], arrays: list[str]) -> DataFrame:
    """Parallel arrays of a row to table rows, with their place in the arrays."""
    zipped = F.posexplode_outer(F.arrays_zip(*arrays)).alias("place", "_z")
    rows = df.select(*keep, zipped).where("place IS NOT NULL")
    return rows.select(*keep, "place", *[F.col(f"_z.{a}").alias(a) for a in arrays])
