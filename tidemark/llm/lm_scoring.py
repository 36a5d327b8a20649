"""Log-probabilities of whole documents under a gated recurrent language model.

Tokens are the lower-cased (A-Z) words of a text and one end. Counts come from all training documents,
those whose crc32 of the id is not 1 modulo ``FOLDS``. The output softmax is factored by classes,

    P(token | earlier tokens) = P(class | earlier classes) * P(token | class),

where the first factor is the recurrent network's (``llm.gru``, trained by truncated backpropagation)
and the second the softmax of the tokens' log counts: ``(c + 0.5)`` over its sum in the class, with
0.5 in each class for what was never seen. The end and the most frequent words are classes of their
own; other words fall into ``ENDING_CLASSES`` of about equal mass by their last two bytes, which also
places unseen words. Both factors sum to one.

Scale: counts are a grouped sum over all training documents. Only the most frequent words, at most
``HEAD``, go to every task; the rest of each document's words meet their counts in a shuffle join. A
second pass writes each document as one byte a token, and the network reads just those bytes: each task
trains on its share of the documents, with one optimizer from its first to its last, and the weights
are averaged by a grouped sum, ``ROUNDS`` times. The rounds divide the training documents among them by
row number: every token of each is a target in exactly one round, in segments where a document is long. So the weights, and with them ``score``, depend
on how documents are dealt to files and tasks; counts, masses and base scores do not, and all cover
every document. In scoring, a document's state is carried from window to window to its end.

Defined cases: NULL or empty text is the end alone; a NULL id has the crc32 of empty text; repeated rows
are scored alike and each counts in training; without training documents N and V are 0, and every
token is unseen; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import gru
from tidemark.llm.common import map_rows, remainder, slices, stored, table

FOLDS, HELD_OUT = 5, 1
# Frequent words kept by every task; their number is fixed, whatever the corpus.
HEAD = 200_000
SINGLE_CLASSES = 40
ENDING_CLASSES = 23
HIDDEN = 24
ROUNDS = 2
# Step size in the first round; a k-th of it in the k-th.
RATE = 0.015
# Text that a task splits into words at a time.
SLICE_BYTES = 8 * 1024 * 1024

END = 0
CLASSES = 1 + SINGLE_CLASSES + ENDING_CLASSES


def words_of(texts: pa.Array) -> pa.ListArray:
    """The words of each text, by Arrow's kernels; NULL has none."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    # A text that begins or ends with white space, or has nothing else, gives empty words there.
    filled = pc.greater(pc.binary_length(words.values), 0)
    upto = np.append(0, np.cumsum(filled.to_numpy(zero_copy_only=False)))
    return pa.ListArray.from_arrays(
        pa.array(upto[words.offsets.to_numpy()], pa.int32()), words.values.filter(filled)
    )


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, c`` over the given documents; Spark adds up a task's words before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                found = pc.value_counts(words_of(part["text"]).values)
                yield pa.RecordBatch.from_arrays(
                    [found.field("values").cast(pa.binary()), found.field("counts")], ["word", "c"]
                )

    partial = docs.select(F.col("text").cast("string")).mapInArrow(count, "word binary, c bigint")
    return partial.groupBy("word").agg(F.sum("c").alias("c"))


def _ending(word: bytes) -> int:
    return (word[-1] << 8 | word[-2]) if len(word) > 1 else word[-1] << 8


def _endings(words: pa.Array) -> np.ndarray:
    """``_ending`` of each of the words, none of them empty."""
    _, offsets, data = words.buffers()
    borders = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1]
    letters = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    last = borders[1:] - 1
    before = np.where(np.diff(borders) > 1, letters[last - 1], 0)
    return letters[last].astype(np.int64) << 8 | before


class Classes:
    """Classes and log10 counts of the head words, and the class of any ending."""

    def __init__(self, head: list[tuple[bytes, int]], endings: dict[int, tuple[int, int]], documents: int):
        """``endings``: words in the corpus and different words, by ending, over all words."""
        self.words = pa.array([word for word, _ in head], pa.binary())
        counts = np.array([c for _, c in head], np.float64)
        self.log_count = np.log10(counts + 0.5)
        mass, kinds = np.zeros(1 << 16), np.zeros(1 << 16)
        for ending, (c, words) in endings.items():
            mass[ending], kinds[ending] = c, words
        single = min(SINGLE_CLASSES, len(head))
        for word, c in head[:single]:
            mass[_ending(word)] -= c
            kinds[_ending(word)] -= 1
        upto = np.cumsum(mass)
        middle = (upto - mass / 2) / max(upto[-1], 1)
        self.by_ending = (1 + SINGLE_CLASSES + np.minimum(ENDING_CLASSES - 1, (middle * ENDING_CLASSES).astype(int))).astype(np.uint8)
        self.of_head = np.array([self.by_ending[_ending(word)] for word, _ in head], np.uint8)
        self.of_head[:single] = np.arange(1, single + 1)
        total = np.bincount(self.by_ending, mass + 0.5 * kinds, minlength=CLASSES)
        share = total + 0.5
        share[1 : single + 1] = counts[:single] + 0.5
        share[END] = documents + 0.5
        self.log_share = np.log(share / share.sum())
        self.end_log = float(np.log10(documents + 0.5))
        # What turns a token's log10 count into log10 P(token | class), by class.
        self.to_class = -np.log10(total + 0.5)

    @property
    def index(self) -> dict[bytes, int]:
        """The place of each head word."""
        return {word: i for i, word in enumerate(self.words.to_pylist())}

    def encode(self, texts: pa.Array) -> dict[str, pa.Array]:
        """By text: classes, tokens, known head tokens, sums of log counts and of class terms, other words.

        Words are looked up once each, however often they occur in ``texts``.
        """
        lists = words_of(texts)
        borders = lists.offsets.to_numpy().astype(np.int64)
        sizes = np.diff(borders)
        coded = lists.values.dictionary_encode()
        words, at = coded.dictionary.cast(pa.binary()), coded.indices.to_numpy()
        place = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy()
        known, kind = place >= 0, self.by_ending[_endings(words)]
        kind[known] = self.of_head[place[known]]
        inside, kinds = known[at], kind[at]

        # Each text's classes, and the end behind them.
        rows = np.repeat(np.arange(len(texts)), sizes)
        ends = borders[1:] + np.arange(len(texts))
        classes = np.full(len(at) + len(texts), END, np.uint8)
        classes[np.arange(len(at)) + rows] = kinds
        upto = pa.array(np.append(0, ends + 1), pa.int32())

        logs = self.log_count[place[at[inside]]]
        alone = kinds[inside] <= SINGLE_CLASSES
        alone_logs = logs[alone]
        shared = kinds > SINGLE_CLASSES
        terms = self.to_class[kinds[shared]]
        heads = np.append(0, np.cumsum(inside))[borders]
        singles = np.append(0, np.cumsum(alone))[heads]
        plural = np.append(0, np.cumsum(shared))[borders]
        sums = lambda values, by: np.array([values[a:b].sum() for a, b in zip(by[:-1], by[1:])])

        # Words outside the head: each once a text, with its number there.
        pairs, times = np.unique(rows[~inside] * len(words) + at[~inside], return_counts=True)
        starts = np.searchsorted(pairs, np.arange(len(texts) + 1) * len(words))
        starts = pa.array(starts, pa.int32())
        return {
            "classes": pa.Array.from_buffers(pa.binary(), len(texts), [None, upto.buffers()[1], pa.py_buffer(classes)]),
            "n_tokens": pa.array(sizes + 1),
            "n_head": pa.array(np.diff(heads)),
            "head_log": pa.array(sums(logs, heads) + self.end_log),
            "class_log": pa.array(sums(terms, plural) - (sums(alone_logs, singles) + self.end_log)),
            "others": pa.ListArray.from_arrays(starts, words.take(pa.array(pairs % max(len(words), 1)))),
            "times": pa.ListArray.from_arrays(starts, pa.array(times, pa.int64())),
        }


def head_words(counts: DataFrame, head: int = HEAD) -> list[tuple[bytes, int]]:
    """The most frequent words, most frequent first: as many as ``head`` holds without parting a step.

    Counts fall into steps, eight bits of each count's leading digits; a histogram of the steps tells
    the lowest one whose words, with all above, are at most ``head``. Only those words travel.
    """
    digits = F.greatest(F.length(F.bin("c")) - 8, F.lit(0)).cast("int")
    step = digits * 256 + F.expr("shiftright(c, greatest(length(bin(c)) - 8, 0))").cast("int")
    stepped = counts.withColumn("step", step)
    words, least = 0, None
    sizes = stepped.groupBy("step").count().collect()  # at most 56 * 256 rows
    for row in sorted(sizes, key=lambda r: -r["step"]):
        words += row["count"]
        if words > head:
            break
        least = row["step"]
    if least is None:
        return []
    found = stepped.filter(F.col("step") >= least).select("word", "c").toArrow()
    pairs = zip(found["word"].to_pylist(), found["c"].to_pylist())
    return sorted(pairs, key=lambda pair: (-pair[1], pair[0]))


def class_table(counts: DataFrame, documents: int, head: int = HEAD) -> Classes:
    top = head_words(counts, head)
    last, before = F.expr("ascii(decode(substr(word, -1), 'ISO-8859-1'))"), F.expr("ascii(decode(substr(word, -2, 1), 'ISO-8859-1'))")
    ending = last * 256 + F.when(F.octet_length("word") > 1, before).otherwise(0)
    sums = counts.groupBy(ending.alias("ending")).agg(F.sum("c").alias("c"), F.count("*").alias("words"))
    endings = {r.ending: (r.c, r.words) for r in sums.collect()}  # at most 65,536 rows
    return Classes(top, endings, documents)


def encoded(docs: DataFrame, classes: Classes) -> DataFrame:
    """One row a document: its classes as bytes, its sums, and the words outside the head with their numbers."""
    shipped = docs.sparkSession.sparkContext.broadcast(classes)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                columns = {k: part[k] for k in ("doc_id", "held_out")} | shipped.value.encode(part["text"])
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    kind = dict(docs.dtypes)["doc_id"]
    source = docs.select("doc_id", (remainder(FOLDS) == HELD_OUT).alias("held_out"), F.col("text").cast("string"))
    schema = (
        f"doc_id {kind}, held_out boolean, classes binary, n_tokens bigint, n_head bigint, "
        "head_log double, class_log double, others array<binary>, times array<bigint>"
    )
    rows = source.mapInArrow(encode, schema)
    # Written at once, so the row number stays what it is.
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), "encoded")


def _sequences(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(b, np.uint8).astype(np.int64) for b in batch["classes"].to_pylist()]


def trained(rows: DataFrame, classes: Classes, rounds: int = ROUNDS) -> gru.Parameters:
    """Weights after one pass over all training documents, averaged over the tasks in each of ``rounds`` parts."""
    params = gru.initial(CLASSES, HIDDEN, classes.log_share)
    training = rows.filter("not held_out")
    size = gru.flat(params).size
    for turn in range(rounds):
        shipped = rows.sparkSession.sparkContext.broadcast(params)

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trainer = gru.Trainer(shipped.value, END, rate=RATE / (1 + turn))
            for batch in batches:
                trainer.read(_sequences(batch))
            if trainer.tokens:
                values = gru.flat(trainer.params)
                yield pa.RecordBatch.from_pydict(
                    {"tokens": pa.array([trainer.tokens], pa.int64()), "weights": pa.array([values.tolist()], pa.list_(pa.float64()))}
                )

        part = training.filter(F.pmod("row", F.lit(rounds)) == turn).select("classes")
        parts = part.mapInArrow(learn, "tokens bigint, weights array<double>")
        each = parts.select("tokens", F.posexplode("weights").alias("at", "value"))
        mean = each.groupBy("at").agg((F.sum(F.col("value") * F.col("tokens")) / F.sum("tokens")).alias("value"))
        found = mean.collect()  # one row a weight
        if len(found) == size:
            values = np.empty(size)
            for r in found:
                values[r.at] = r.value
            params = gru.unflat(values, params)
    return params


def scored(docs: DataFrame, head: int = HEAD, rounds: int = ROUNDS) -> DataFrame:
    """The contract's columns and ``class_score``, the network's part, for each row of ``docs``."""
    training = docs.filter(remainder(FOLDS) != HELD_OUT)
    counts = stored(word_counts(training), "word-counts")
    documents = training.count()
    words, kinds = counts.agg(F.sum("c"), F.count("*")).first()
    total, different = (words or 0) + documents, kinds + bool(documents)
    classes = class_table(counts, documents, head)
    rows = encoded(docs, classes)

    # Words outside the head meet their counts; what has no count was never seen in training.
    others = rows.select("row", F.inline(F.arrays_zip("others", "times")).alias("word", "times"))
    met = others.join(counts, "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    tails = met.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("c") + 0.5)).alias("tail_log"),
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("n_tail"),
    )

    params = rows.sparkSession.sparkContext.broadcast(trained(rows, classes, rounds))

    def read(columns: dict[str, list]) -> dict[str, list]:
        sequences = [np.frombuffer(b, np.uint8).astype(np.int64) for b in columns["classes"]]
        return {"row": columns["row"], "class_score": gru.log10_probability(params.value, sequences, END).tolist()}

    network = map_rows(rows.select("row", "classes"), read, "row bigint, class_score double")
    sums = rows.drop("classes", "others", "times").join(network, "row").join(tails, "row", "left")
    logs = F.col("head_log") + F.coalesce("tail_log", F.lit(0.0))
    known = F.col("n_head") + F.coalesce("n_tail", F.lit(0)) + F.lit(int(documents > 0))
    return sums.select(
        "doc_id",
        "held_out",
        "n_tokens",
        known.alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.log10(F.lit(total + 0.5 * (different + 1)))).alias("base_score"),
        (logs + F.col("class_log") + F.col("class_score")).alias("score"),
        "class_score",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"))
