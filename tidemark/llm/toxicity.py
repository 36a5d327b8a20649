"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence has a logistic score of the features of its distinct
words, a word's features being itself and its beginnings of ``PREFIXES`` letters, so inflected forms
share what they have in common; the document's score is the noisy-or of its sentences, ``1 - product(1 - p)``. Only documents carry
labels: the likelihood of those labels trains the word weights, and the trained sentence scores then
locate the offending sentences.

The model is fitted on at most ``TRAIN_ROWS`` labelled rows, the ones of least id hash, with repeated
texts taken once. It uses the features whose document frequencies differ between the classes by
``LEAST_Z`` standard errors, so their number does not grow with the corpus. Everything else covers
all rows: each whole text is scored in one pass.

Defined cases: NULL or empty text has no sentence and scores 0; rows without labels are scored like
others; a NULL label is no label, and an id that is labelled twice counts as toxic if one of its
labels is; of several texts under one id the least is fitted on; without any toxic training row all
scores are 0; repeated rows score alike.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, remainder, table

HELD_OUT = 5
TRAIN_ROWS = 8_000
LEAST_Z = 4.0
LEAST_DOCUMENTS = 5
STEPS = 400
START = 0.25
RATE = 0.1
DECAY = 1e-5
MOST_FEATURES = 20_000
PREFIXES = (3, 4, 5, 6, 7)
# Words whose weights a Python worker remembers.
CACHE_ENTRIES = 400_000

_END = re.compile(r"[.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")


def sentences(text: str | None) -> Iterator[tuple[int, int, list[str]]]:
    """``(start, end, words)`` of each sentence with a word; positions are code points."""
    start = 0
    text = text or ""
    for mark in _END.finditer(text):
        words = _WORD.findall(text[start : mark.start()].lower())
        if words:
            yield start, mark.start(), words
        start = mark.end()
    words = _WORD.findall(text[start:].lower())
    if words:
        yield start, len(text), words


def features(words: list[str]) -> set[str]:
    """The words and their beginnings, marked by a star."""
    found = set(words)
    for word in tuple(found):
        found.update(word[:n] + "*" for n in PREFIXES if len(word) > n)
    return found


class WordWeights(dict):
    """Sum of the weights of a word's features."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        self[word] = value = sum(self.weights.get(f, 0.0) for f in features([word]))
        return value


def fit(texts: list[str], labels: list[int]) -> dict[str, float]:
    """Word weights by full-batch descent; the bias is under the empty word."""
    toxic = np.array(labels, bool)
    positives, negatives = int(toxic.sum()), int((~toxic).sum())
    if not positives or not negatives:
        return {}
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    for text, label in zip(texts, toxic):
        seen[int(label)].update(features([w for _, _, words in sentences(text) for w in words]))
    chosen = []
    for word in seen[0].keys() | seen[1].keys():
        a, b = seen[1][word], seen[0][word]
        if a + b < LEAST_DOCUMENTS:
            continue
        p, q, both = a / positives, b / negatives, (a + b) / (positives + negatives)
        error = math.sqrt(both * (1 - both) * (1 / positives + 1 / negatives)) or math.inf
        if abs(p - q) / error >= LEAST_Z:
            odds = math.log((a + 0.5) / (positives - a + 0.5)) - math.log((b + 0.5) / (negatives - b + 0.5))
            chosen.append((-abs(p - q) / error, word, odds))
    chosen = sorted(chosen)[:MOST_FEATURES]
    number = {word: i for i, (_, word, _) in enumerate(chosen)}

    feature, sentence_of, bag_of, sentence = array("i"), array("i"), array("i"), 0
    for b, text in enumerate(texts):
        for _, _, words in sentences(text):
            known = sorted(number[w] for w in features(words) if w in number)
            feature.extend(known)
            sentence_of.extend([sentence] * len(known))
            bag_of.append(b)
            sentence += 1
    feature, sentence_of, bag_of = (np.array(x, np.int64) for x in (feature, sentence_of, bag_of))
    # A start at the log odds gives words that never occur alone their share of the weight.
    weights, bias = START * np.array([odds for _, _, odds in chosen]), -6.0
    state = np.zeros((2, len(number) + 1))
    for step in range(1, STEPS + 1):
        z = bias + np.bincount(sentence_of, weights[feature], minlength=sentence)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        clean = np.exp(np.bincount(bag_of, np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(texts)))
        clean = np.clip(clean, 1e-9, 1 - 1e-9)
        slope = np.where(toxic, -clean / (1 - clean), 1.0)[bag_of] * p / len(texts)
        gradient = np.bincount(feature, slope[sentence_of], minlength=len(number)) + DECAY * weights
        gradient = np.append(gradient, slope.sum())
        state[0] = 0.9 * state[0] + 0.1 * gradient
        state[1] = 0.99 * state[1] + 0.01 * gradient**2
        move = RATE * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.99**step)) + 1e-8)
        weights -= move[:-1]
        bias -= move[-1]
    return {"": float(bias)} | {w: float(weights[i]) for w, i in number.items()}


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> dict[str, float]:
    """Fits on the labelled documents that are not held out; one task reads the bounded sample."""
    marked = labels.filter("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marked = marked.filter(remainder(HELD_OUT) != 0)
    chance = F.xxhash64(F.col("doc_id").cast("string"))
    chosen = F.broadcast(marked.orderBy(chance, "doc_id").limit(train_rows))  # at most train_rows
    sample = docs.select("doc_id", F.col("text").cast("string")).join(chosen, "doc_id")
    sample = sample.filter("text is not null").groupBy("doc_id", F.col("toxic").cast("int").alias("toxic"))
    sample = sample.agg(F.min("text").alias("text"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: dict[str, int] = {}
        for batch in batches:
            for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
                texts[text] = max(texts.get(text, 0), toxic)
        ordered = sorted(texts)
        weights = fit(ordered, [texts[t] for t in ordered])
        yield pa.RecordBatch.from_pydict(
            {"word": pa.array(list(weights), pa.string()), "weight": pa.array(list(weights.values()), pa.float64())}
        )

    fitted = sample.repartition(1).mapInArrow(learn, "word string, weight double")
    return {row.word: row.weight for row in fitted.collect()}  # at most MOST_FEATURES + 1


def document_scores(
    text: str | None, bias: float | None, of_word: WordWeights
) -> tuple[float, int, int, float]:
    """Noisy-or of the sentences, and the worst sentence: its start, end and score."""
    if bias is None:
        return 0.0, 0, 0, 0.0
    none = math.log1p(math.exp(min(bias, 30)))
    logs, worst = 0.0, (-math.inf, 0, 0)
    for start, end, words in sentences(text):
        z = bias + sum(map(of_word.__getitem__, set(words)))
        logs += none if z == bias else math.log1p(math.exp(min(z, 30)))
        if z > worst[0]:
            worst = (z, start, end)
    if worst[0] == -math.inf:
        return 0.0, 0, 0, 0.0
    z = max(-30.0, min(30.0, worst[0]))
    return 1 - math.exp(-logs), worst[1], worst[2], 1 / (1 + math.exp(-z))


def toxicity(docs: DataFrame, weights: dict[str, float]) -> DataFrame:
    """``doc_id, score, worst_start, worst_end, worst_score`` for each row of ``docs``."""
    shipped = docs.sparkSession.sparkContext.broadcast(weights)

    def score(columns: dict[str, list]) -> dict[str, list]:
        of_word = WordWeights(shipped.value)
        bias = shipped.value.get("")
        rows = [document_scores(text, bias, of_word) for text in columns["text"]]
        names = ("score", "worst_start", "worst_end", "worst_score")
        return {"doc_id": columns["doc_id"]} | dict(zip(names, list(zip(*rows)) or [()] * 4))

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, score double, worst_start bigint, worst_end bigint, worst_score double"
    return map_rows(docs.select("doc_id", F.col("text").cast("string")), score, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    weights = train(docs, table(spark, sf_dir, "labels"))
    return toxicity(docs, weights).select(
        "doc_id",
        (remainder(HELD_OUT) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "worst_start",
        "worst_end",
        "worst_score",
    )
