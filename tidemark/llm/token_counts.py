"""Token counts under a unigram tokenizer, without building the tokens.

The tokenizer is the usual *unigram* model behind a word-start split: each space becomes ``▁``, the
text gets one ``▁`` in front unless it begins with one, and it is cut before every ``▁``. Each cut is
tokenized by the segmentation of the largest score sum. A character that no piece covers alone
scores 10 below the least piece; it counts as one token for each of its UTF-8 bytes where the
vocabulary has byte pieces, and otherwise a run of such characters counts as one token.

Ties follow the library's forward pass: starts are tried in ascending order and only a strictly
better sum replaces an earlier one, so the earliest start (the longest last piece) wins. Sums are
taken in the same order in double precision.

Defined cases: NULL or empty text has 0 tokens; a row with a NULL id is counted like any other;
repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import ahocorasick
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
# Distinct cuts whose counts a Python worker remembers; when it is full, it starts afresh.
CACHE_ENTRIES = 400_000

Vocabulary = tuple[tuple[tuple[str, float], ...], bool]


def load_vocabulary(path: str = VOCABULARY) -> Vocabulary:
    """Pieces with their scores, and whether all 256 byte pieces exist, from a model file.

    The file's own scores serve as the unigram log weights. A vocabulary has tens of thousands of
    pieces whatever the corpus, so the driver reads it and ships it with the tasks.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    usable = [i for i in ids if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i))]
    pieces = tuple((model.id_to_piece(i), model.get_score(i)) for i in usable)
    return pieces, sum(map(model.is_byte, ids)) == 256


class TokenCounter(dict):
    """Maps a cut (with its ``▁``) to its number of tokens; remembers a bounded number of cuts."""

    def __init__(self, vocabulary: Vocabulary, entries: int = CACHE_ENTRIES):
        super().__init__()
        pieces, self.bytewise = vocabulary
        self.entries = entries
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        if pieces:
            self.automaton.make_automaton()
        self.unknown = min((score for _, score in pieces), default=0.0) - UNKNOWN_PENALTY

    def __missing__(self, cut: str) -> int:
        if len(self) >= self.entries:
            self.clear()
        self[cut] = tokens = self.viterbi(cut)
        return tokens

    def viterbi(self, cut: str) -> int:
        matches: list[list[tuple[int, float]]] = [[] for _ in cut]
        if len(self.automaton):
            # Matches that end at one place come longest first, that is by ascending start.
            for end, match in self.automaton.iter(cut):
                matches[end].append(match)
        best, tokens, open_run = [0.0], [0], [False]
        for end, found in enumerate(matches):
            score, count, unknown = None, 0, False
            alone = False
            for length, weight in found:
                start = end + 1 - length
                alone = alone or length == 1
                candidate = weight + best[start]
                if score is None or candidate > score:
                    score, count = candidate, tokens[start] + 1
            if not alone:
                candidate = self.unknown + best[end]
                if score is None or candidate > score:
                    score, unknown = candidate, True
                    if self.bytewise:
                        count = tokens[end] + len(cut[end].encode())
                    else:
                        count = tokens[end] + (not open_run[end])
            best.append(score)
            tokens.append(count)
            open_run.append(unknown)
        return tokens[-1]

    def text(self, text: str | None) -> int:
        if not text:
            return 0
        marked = text.replace(" ", MARK)
        if marked[0] == MARK:
            marked = marked[1:]
        # After the split every cut has lost its mark; the counter is asked with the mark.
        return sum(map(self.__getitem__, [MARK + cut for cut in marked.split(MARK)]))


_COUNTERS: dict[int, TokenCounter] = {}


def _counter(vocabulary: Vocabulary) -> TokenCounter:
    """One counter a Python worker, kept over its tasks."""
    key = hash(vocabulary)
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = TokenCounter(vocabulary)
    return _COUNTERS[key]


def token_counts(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """``doc_id, n_chars_read, n_tokens`` for each row of ``docs``, in one pass without a shuffle."""
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(columns: dict[str, list]) -> dict[str, list]:
        counter = _counter(shipped.value)
        texts = columns["text"]
        return {
            "doc_id": columns["doc_id"],
            "n_chars_read": [len(t or "") for t in texts],
            "n_tokens": [counter.text(t) for t in texts],
        }

    kind = dict(docs.dtypes)["doc_id"]
    source = docs.select("doc_id", F.col(text).cast("string").alias("text"))
    return map_rows(source, count, f"doc_id {kind}, n_chars_read bigint, n_tokens bigint")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return token_counts(docs, load_vocabulary())
