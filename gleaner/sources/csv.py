"""Quoted CSV with a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_csv(spark: SparkSession, path: str, schema: str | None = None, multi_line: bool = False) -> DataFrame:
    """Quotes are doubled inside quoted fields; fields may hold commas.

    Fields with line breaks need ``multi_line``; a file is then read by one task, so write such a table as many files.
    Without a schema the types are inferred, which costs one more pass over the files.
    """
    reader = (
        spark.read.option("header", True)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
    )
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    (
        df.write.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("quoteAll", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
