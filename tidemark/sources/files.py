"""CSV landing folders, read whole or as a stream of unseen files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    corrupt_column: str | None = None,
) -> DataFrame:
    """CSV with a header from all nested folders; without a schema the types are inferred.

    ``corrupt_column`` keeps the text of every malformed line, so that it can be quarantined. Store
    the rows before selecting columns: only cells that a query reads are parsed and can be malformed.
    """
    reader = spark.read.option("header", True).option("recursiveFileLookup", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    if corrupt_column:
        schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.schema(schema).csv(path)


def stream_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Unseen CSV files of a landing folder; the checkpoint of the query remembers the seen ones.

    Without a schema the types are inferred once, from the files already there.
    ``max_files`` bounds a micro-batch when a backlog is drained.
    """
    if schema is None:
        schema = read_csv(spark, path).schema
    reader = (
        spark.readStream.schema(schema).option("header", True).option("recursiveFileLookup", True)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(path)
