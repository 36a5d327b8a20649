"""Helpers of the corpus operators: tables, words, shared intermediate tables, checked broadcasts.

A *word* is a run of characters other than space, tab, line feed, vertical tab, form feed and
carriage return. ``bytes.split()`` without an argument splits at exactly these.

Rows are told apart by ``DOC_KEY``: the id and a hash of the text, so that two texts under one id
(or under no id) stay apart. Rows that agree in both are repeated rows and get equal results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import workspace

SPACE = r"[\x20\x09-\x0D]+"
# Bytes in the files of a broadcast table; a larger one is joined by a shuffle.
BROADCAST_BYTES = 32 * 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(rows: DataFrame, label: str) -> DataFrame:
    """``rows``, written below the shared checkpoint folder and read again.

    Later jobs read files instead of repeating the work, also after an executor is lost, and a
    non-deterministic column keeps its value.
    """
    path = workspace(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def small_enough(rows: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A stored table with a broadcast hint, if its files have at most ``limit`` bytes.

    For joins whose other side carries whole texts, which a shuffle would move; in all others Spark
    decides by its own threshold.
    """
    size = int(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return F.broadcast(rows) if size <= limit else rows


def as_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def text_hash(column: str = "text") -> Column:
    return F.xxhash64(as_text(column))


def word_count(column: str = "text") -> Column:
    """Number of words, by SQL functions; NULL text has none."""
    inner = F.btrim(as_text(column), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(inner == "", F.lit(0)).otherwise(F.size(F.split(inner, SPACE))).cast("bigint")


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def matched(docs: DataFrame, found: DataFrame, how: str, *keys: str) -> DataFrame:
    """``docs`` as ``mine`` joined with ``found`` as ``theirs`` by text hash and the columns ``keys``.

    Columns are told apart by these two names, so ``docs`` may have further columns of any name.
    """
    match = text_hash("mine.text") == F.col("theirs.text_hash")
    for key in keys:
        match = match & same(F.col(f"mine.{key}"), F.col(f"theirs.{key}"))
    # A hint must stand above the alias to be seen by the join.
    return docs.alias("mine").join(small_enough(found.alias("theirs")), match, how)


def unused(docs: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``docs`` has it."""
    taken = {column.lower() for column in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def remainder(modulus: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus``; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def crc32_sql(text: str) -> str:
    """DuckDB SQL for the unsigned crc32 of an ASCII text, bit by bit."""
    bit = "CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"
    byte = f"list_reduce(list_prepend(xor(a, x), [0::BIGINT for j in range(8)]), lambda c, unused: {bit})"
    codes = f"[ascii(substr({text}, i::INT, 1))::BIGINT for i in range(1, strlen({text}) + 1)]"
    crc = f"list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda a, x: {byte})"
    return f"xor({crc}, 4294967295)"


def slices(batch: pa.RecordBatch, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """``batch`` halved until each part has at most ``most_bytes`` or a single row."""
    if batch.num_rows < 2 or batch.nbytes <= most_bytes:
        yield batch
    else:
        half = batch.num_rows // 2
        yield from slices(batch.slice(0, half), most_bytes)
        yield from slices(batch.slice(half), most_bytes)


def map_rows(
    rows: DataFrame,
    function: Callable[[dict[str, list]], dict[str, list]],
    schema: str,
    most_bytes: int | None = None,
) -> DataFrame:
    """Applies ``function`` to column lists of each Arrow batch; it returns column lists or arrays.

    With ``most_bytes``, batches are handled in slices of that size. An Arrow batch has 10,000 rows
    however long they are, and a worker that makes many rows of each holds all of them at once.
    """
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(StructType.fromDDL(schema))

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (p for b in source for p in (slices(b, most_bytes) if most_bytes else (b,)))
        for batch in parts:
            columns = function({n: c.to_pylist() for n, c in zip(batch.schema.names, batch.columns)})
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], f.type) for f in target], schema=target
            )

    return rows.mapInArrow(batches, schema)


def renamed(rows: DataFrame, names: Sequence[str], prefix: str) -> DataFrame:
    return rows.withColumnsRenamed({name: f"{prefix}{name}" for name in names})
