"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is lower-cased, and every run of characters that are no letters becomes one space, with one
at both ends. Its features are all its n-grams of the given orders, hashed into buckets. Training is
one pass that counts buckets per language inside each task and adds the counts up; the model is the
matrix of smoothed log-probabilities, broadcast to the tasks, which score batches of documents as
sparse rows: the matrix rows of a document's buckets are gathered and added.

The matrix has at most ``CELLS`` cells whatever the corpus: with many languages there are fewer
buckets. Everything else is linear in the text, in arrays of bounded size per step.

Defined cases: a NULL text or one without a letter is ``und`` with score 0, as is every text if no
language was learned. A NULL language is not learned from. Ties go to the first language in byte
order. Repeated rows count, and are predicted, once each. An empty table gives no rows. Very long
texts are used whole. Other columns of the input are kept out, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import remainder, table

ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
# Cells of the matrix (32 MB as counts, 16 MB as log-probabilities) and of each step of a task.
CELLS = 1 << 22
# Added to every count.
SMOOTHING = 0.1
UNKNOWN = "und"
SPACE = 32


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def normalized(text: str | None) -> np.ndarray:
    """Code points of the lower-cased text, runs of others than letters as one space; or empty."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = _letters()[codes]
    if not letters.any():
        return np.zeros(0, np.uint32)
    codes = np.concatenate([[SPACE], np.where(letters, codes, SPACE), [SPACE]]).astype(np.uint32)
    space = codes == SPACE
    return codes[~(space & np.append(False, space[:-1]))]


def grams(
    texts: Sequence[np.ndarray], orders: Sequence[int], buckets: int, step: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Steps of at most ``step`` windows: the index of the text, ascending, and the bucket."""
    if not texts:
        return
    codes = np.concatenate(texts)
    lengths = np.array([len(t) for t in texts])
    ends = np.cumsum(lengths)
    for begin in range(0, len(codes), step):
        part = codes[begin : begin + step + max(orders) - 1].astype(np.uint64)
        starts = np.arange(begin, min(begin + step, len(codes)))
        text = np.searchsorted(ends, starts, "right")
        left = ends[text] - starts
        rolled = np.zeros(len(part) + 1, np.uint64)
        for order in range(1, max(orders) + 1):
            rolled = rolled[: len(part) - order + 1] * np.uint64(0x100000001B3) + part[order - 1 :]
            if order in orders:
                inside = left[: len(rolled)] >= order
                mixed = rolled[: len(inside)][inside] * np.uint64(0x9E3779B97F4A7C15)
                mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(2 * order + 0xBF58476D)
                bucket = (mixed >> np.uint64(20)) & np.uint64(buckets - 1)
                yield text[: len(inside)][inside], bucket.astype(np.int64)


def batched(texts: Sequence[str | None], step: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Runs of normalized texts with the index of the first; a run ends once it has ``step`` characters."""
    first, run, size = 0, [], 0
    for i, text in enumerate(texts):
        run.append(normalized(text))
        size += len(run[-1])
        if size >= step or i == len(texts) - 1:
            yield first, run
            first, run, size = i + 1, [], 0


@dataclass(frozen=True)
class Model:
    """``weights[bucket, language]`` and ``prior[language]`` are natural logarithms."""

    languages: list[str]
    weights: np.ndarray
    prior: np.ndarray
    orders: tuple[int, ...]

    def log_joint(self, texts: Sequence[str | None]) -> np.ndarray:
        """For each text, the log-probability of each language together with the text's n-grams."""
        buckets, width = self.weights.shape
        out = np.tile(self.prior, (len(texts), 1))
        for first, run in batched(texts, CELLS // 8):
            for text, bucket in grams(run, self.orders, buckets, max(1, CELLS // 4 // width)):
                if len(text):
                    at = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
                    summed = np.add.reduceat(self.weights[bucket], at, axis=0, dtype=np.float64)
                    out[first + text[at]] += summed
        return out

    def predict(self, texts: Sequence[str | None]) -> tuple[list[str], list[float]]:
        """The likeliest language of each text and its posterior probability."""
        known = [bool(self.languages) and bool(_has_letter(t)) for t in texts]
        if not any(known):
            return [UNKNOWN] * len(known), [0.0] * len(known)
        joint = self.log_joint(texts)
        best = joint.argmax(axis=1)
        share = 1 / np.exp(joint - joint.max(axis=1, keepdims=True)).sum(axis=1)
        names = [self.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
        return names, [float(s) if k else 0.0 for s, k in zip(share, known)]


def _has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def bucket_count(languages: int, buckets: int = BUCKETS, cells: int = CELLS) -> int:
    """A power of two, so that all languages fit into ``cells``."""
    return max(1, min(buckets, 1 << max(0, (cells // max(1, languages)).bit_length() - 1)))


def train(
    docs: DataFrame,
    language: str = "lang",
    orders: Sequence[int] = ORDERS,
    smoothing: float = SMOOTHING,
    buckets: int = BUCKETS,
) -> Model:
    """Counts all rows with a language; the driver gets one row per language, and per cell in use."""
    rows = docs.filter(F.col(language).isNotNull()).select(
        F.col(language).cast("string").alias("language"), F.col("text").cast("string").alias("text")
    )
    sizes = {r[0]: r[1] for r in rows.groupBy("language").count().collect()}
    languages = sorted(sizes, key=str.encode)
    buckets = bucket_count(len(languages), buckets)
    index, orders = {name: i for i, name in enumerate(languages)}, tuple(orders)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(index) * buckets, np.int64)
        for batch in batches:
            own = np.array([index[name] for name in batch.column(0).to_pylist()], np.int64)
            for first, run in batched(batch.column(1).to_pylist(), CELLS // 8):
                for text, bucket in grams(run, orders, buckets, CELLS // 8):
                    np.add.at(counts, own[first + text] * buckets + bucket, 1)
        cell = np.flatnonzero(counts)
        for at in range(0, len(cell), 1 << 16):
            some = cell[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some), pa.array(counts[some])], names=["cell", "n"]
            )

    cells = rows.mapInArrow(counted, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    found = cells.toArrow()
    counts = np.zeros(len(languages) * buckets)
    counts[found["cell"].to_numpy()] = found["n"].to_numpy()
    counts = counts.reshape(len(languages), buckets).T + smoothing
    documents = np.array([sizes[name] for name in languages], float)
    return Model(
        languages,
        np.log(counts / counts.sum(axis=0)).astype(np.float32),
        np.log(documents / documents.sum()) if languages else documents,
        orders,
    )


def identify(docs: DataFrame, model: Model, kept: Sequence[Column]) -> DataFrame:
    """The columns ``kept`` of each row, and ``lang_pred, score`` of its ``text``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*kept, F.col("text").cast("string").alias("_text"))
    if len(set(rows.columns)) < len(rows.columns):
        raise ValueError("name the kept columns differently")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last = batch.num_columns - 1
            names, scores = shared.value.predict(batch.column(last).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:last], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names[:last], "lang_pred", "score"],
            )

    schema = rows.drop("_text").schema.add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(scored, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document, learned from two thirds of them."""
    docs = table(spark, sf_dir, "documents")
    held_out = remainder(3) == 1
    model = train(docs.filter(~held_out))
    return identify(docs, model, [F.col("doc_id"), held_out.alias("held_out")])
