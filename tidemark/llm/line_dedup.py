"""Removing lines that repeat an earlier line, exactly or with one edit, in DataFrame functions only.

Lines are compared without outer blanks; empty ones are left alone. Two lines of ``EDITED_CHARS``
characters or more are *linked* if one edit (a character changed, added or taken out) turns one into
the other; a class is what links connect, or the copies of a line without links. Shorter lines go only
if they are equal: one edit makes another word or number of them. Of each class the first line stays, in the order of document id
(NULL last), text and place; all others go.

The join cuts a line into threshold-plus-one segments, here two: one of them must occur unchanged in
a linked line, at the same distance from the beginning or from the end. So a line is indexed, under
its length, by its first half and by its second half, and looked up, by a line one character longer,
under the shorter length. An equality join on (length, segment) finds the candidates, and a banded
bit-parallel edit distance verifies them.

A segment that more than ``PAIRS_WITHIN`` lines share is not paired up. There, the half that may
differ is halved again, and the key grows by the quarter that must be unchanged, and so on down to
single characters, where lines under one key are linked without a check. Each level doubles the rows
of the crowded lines at most, so a template with a third of all lines stays linear, and the classes
are the same as with all pairs.

Defined cases: NULL text has no lines and stays NULL; empty texts stay as they are; rows equal in id
and text are one document, whose copies all keep the same lines (finding them is document
deduplication); a text may become empty; other columns pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import as_text, matched, same, small_enough, stored, table, text_hash
from tidemark.llm.components import connected_components

LEAST_CHARS = 1
EDITED_CHARS = 20
PAIRS_WITHIN = 32
EDITS = 1


def line_rows(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``doc_id, text_hash, line_no, line, line_id, size`` for each line long enough."""
    lines = docs.filter("text is not null").select(
        "doc_id", text_hash().alias("text_hash"), F.posexplode(F.split(as_text(), "\n")).alias("line_no", "raw")
    )
    lines = lines.withColumn("line", F.btrim("raw", F.lit(" \t\r\x0b\x0c"))).drop("raw")
    lines = lines.withColumn("size", F.char_length("line")).filter(F.col("size") >= least_chars)
    return lines.withColumn("line_id", F.unhex(F.md5(F.col("line").cast("binary"))))


def edits_within(left: str, right: str, limit: int) -> Column:
    """Whether two strings are within ``limit`` edits, over a band of ``2 * limit + 1`` diagonals.

    Bit i of the state for d edits tells whether d edits suffice to reach row ``j - limit + i`` of
    column j; a column takes a constant number of bit operations.
    """
    lengths = F.char_length(right) - F.char_length(left)
    names = [f"r{d}" for d in range(limit + 1)]
    band = (1 << (2 * limit + 1)) - 1
    start = F.struct(
        *[F.lit(sum(1 << (limit + i) for i in range(d + 1)) & band).alias(n) for d, n in enumerate(names)]
    )

    def step(letters: Column, state: Column, j: Column) -> Column:
        letter = F.get(letters["b"], j)
        bits = [
            F.when(F.get(letters["a"], F.greatest(j - limit + i, F.lit(-1))) == letter, 1 << i).otherwise(0)
            for i in range(2 * limit + 1)
        ]
        equal = bits[0]
        for bit in bits[1:]:
            equal = equal.bitwiseOR(bit)
        new: list[Column] = []
        for d, name in enumerate(names):
            reached = state[name].bitwiseAND(equal)
            if d:
                before = state[names[d - 1]]
                reached = reached.bitwiseOR(before).bitwiseOR(F.shiftright(before, 1))
                reached = reached.bitwiseOR(F.shiftleft(new[-1], 1)).bitwiseAND(F.lit(band))
            new.append(reached)
        return F.struct(*[value.alias(name) for value, name in zip(new, names)])

    # Bound to a lambda variable, the letters are split once a pair and not once a step.
    letters = F.array(F.struct(F.split(left, "").alias("a"), F.split(right, "").alias("b")))

    def over_columns(pair: Column) -> Column:
        columns = F.sequence(F.lit(0), F.size(pair["b"]) - 1)
        return F.aggregate(columns, start, lambda state, j: step(pair, state, j), lambda state: state[names[-1]])

    final = F.get(F.transform(letters, over_columns), F.lit(0))
    hits = [
        (lengths == by) & (F.shiftright(final, limit - by).bitwiseAND(F.lit(1)) == 1)
        for by in range(-limit, limit + 1)
    ]
    hit = hits[0]
    for one in hits[1:]:
        hit = hit | one
    return hit


def _key(size: Column, begin: Column, width: Column, line: Column) -> Column:
    """Hash of what must be unchanged: all before ``begin`` and all after ``begin + width``.

    ``size`` is the length of the shorter line; what stands after is counted from the end.
    """
    tail = size - begin - width
    before = F.substr(line, F.lit(1), begin)
    after = F.when(tail > 0, F.substr(line, F.char_length(line) - tail + 1, tail)).otherwise("")
    return F.xxhash64(size, begin, width, before, after)


def _halves(begin: Column, width: Column) -> Column:
    """The two halves of a stretch that may differ."""
    half = F.floor(width / 2).cast("int")
    return F.array(
        F.struct(begin.alias("begin"), half.alias("width")),
        F.struct((begin + half).alias("begin"), (width - half).alias("width")),
    )


def _keyed(lines: DataFrame) -> DataFrame:
    """Four rows a line: ``line_id, line, longer, size, begin, width, key``."""
    roles = F.explode(F.array(F.lit(0), F.lit(1))).alias("longer")
    rows = lines.select("line_id", "line", "size", roles)
    rows = rows.withColumn("size", F.col("size") - F.col("longer"))
    rows = rows.withColumn("cut", F.explode(_halves(F.lit(0), F.col("size")))).select(
        "line_id", "line", "longer", "size", "cut.begin", "cut.width"
    )
    return rows.withColumn("key", _key(F.col("size"), F.col("begin"), F.col("width"), F.col("line")))


def _level(rows: DataFrame, pairs_within: int) -> tuple[DataFrame, DataFrame]:
    """Verified links among the rows of one level, and the crowded rows, with ``key``."""
    sizes = rows.groupBy("key").agg(
        F.count("*").alias("members"), F.sum(1 - F.col("longer")).alias("shorter")
    )
    rows = rows.join(sizes.filter("members > 1 and shorter > 0").drop("shorter"), "key")
    few = rows.filter(F.col("members") <= pairs_within)
    left = few.filter("longer = 0").select("key", F.col("line_id").alias("u"), F.col("line").alias("a"))
    right = few.select("key", "longer", F.col("line_id").alias("v"), F.col("line").alias("b"))
    pairs = left.join(right, "key").filter("u <> v and (longer = 1 or u < v)")
    pairs = pairs.select("u", "v", "a", "b").dropDuplicates(["u", "v"])
    links = pairs.filter(edits_within("a", "b", EDITS)).select("u", "v")
    return links, rows.filter(F.col("members") > pairs_within).drop("members")


def links(lines: DataFrame, pairs_within: int = PAIRS_WITHIN) -> DataFrame:
    """Links ``u, v`` between the distinct lines ``line_id, line, size``; classes are whole."""
    rows = stored(_keyed(lines), "line-keys")
    found, crowded = _level(rows, pairs_within)
    found, crowded = stored(found, "line-links"), stored(crowded, "crowded-lines")
    while crowded.limit(1).count():
        # One character may differ: all shorter lines under the key are one change apart.
        single = crowded.filter("width <= 1 and (width = 0 or longer = 0)")
        hubs = single.filter("longer = 0").groupBy("key").agg(F.min("line_id").alias("u"))
        stars = single.join(hubs, "key").select("u", F.col("line_id").alias("v")).filter("u <> v")
        # An added character may stand on either side of that single one.
        gaps = F.array(
            F.struct("begin", F.lit(0).alias("width")),
            F.struct((F.col("begin") + 1).alias("begin"), F.lit(0).alias("width")),
        )
        cuts = F.when(F.col("width") > 1, _halves(F.col("begin"), F.col("width"))).otherwise(gaps)
        finer = crowded.filter("width > 0").withColumn("cut", F.explode(cuts))
        finer = finer.select("line_id", "line", "longer", "size", "cut.begin", "cut.width")
        finer = finer.withColumn("key", _key(F.col("size"), F.col("begin"), F.col("width"), F.col("line")))
        more, crowded = _level(stored(finer, "finer-keys"), pairs_within)
        found = stored(found.unionByName(stars).unionByName(more).distinct(), "line-links")
        crowded = stored(crowded, "crowded-lines")
    return found


def _indexed(rows: DataFrame) -> DataFrame:
    """``line_id, place, print`` and the four keys of each line, first the two under its length; a short line has none."""
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "line_no")
    keys = []
    for longer in (0, 1):
        size = F.col("size") - longer
        half = F.floor(size / 2).cast("int")
        for begin, width in ((F.lit(0), half), (half, size - half)):
            keys.append(_key(size, begin, width, F.col("line")))
    return rows.select(
        "line_id", place.alias("place"), F.xxhash64("line").alias("print"),
        F.when(F.col("size") >= EDITED_CHARS, F.array(*keys)).otherwise(F.array().cast("array<bigint>")).alias("keys"),
    )


def _candidates(rows: DataFrame, indexed: DataFrame) -> DataFrame:
    """Distinct lines of which some segment occurs in another line."""
    keyed = indexed.select("print", F.posexplode("keys").alias("at", "key"))
    shared = keyed.groupBy("key").agg(
        F.min("print").alias("low"), F.max("print").alias("high"), F.min("at").alias("at")
    )
    shared = stored(shared.filter("low < high and at < 2").select("key"), "shared-segments")
    prints = keyed.join(shared, "key").select(F.col("print").alias("_print"))
    prints = stored(prints.distinct(), "candidate-prints")
    chosen = rows.join(small_enough(prints), F.xxhash64("line") == F.col("_print"), "left_semi")
    return chosen.select("line_id", "line", "size").dropDuplicates(["line_id"])


def removed_lines(
    docs: DataFrame, least_chars: int = LEAST_CHARS, pairs_within: int = PAIRS_WITHIN
) -> DataFrame:
    """``doc_id, text_hash, removed``: the line numbers that go, for documents that lose some."""
    rows = line_rows(docs, least_chars)
    indexed = stored(_indexed(rows), "line-index")
    firsts = indexed.groupBy("line_id").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    firsts = stored(firsts, "line-firsts")

    long = F.col("size") >= EDITED_CHARS
    lines = stored(_candidates(rows.filter(long), indexed.filter(F.size("keys") > 0)), "candidate-lines")
    classes = connected_components(links(lines, pairs_within))
    classes = classes.withColumnsRenamed({"node": "line_id"})
    members = firsts.join(classes, "line_id")
    earliest = members.groupBy("component").agg(F.min("first").alias("earliest"))
    classed = members.join(earliest, "component").select("line_id", "earliest")
    classed = stored(classed, "classed-lines")
    alone = firsts.filter("n > 1").join(classed.select("line_id"), "line_id", "left_anti")
    alone = alone.select("line_id", F.col("first").alias("earliest"))
    repeated = stored(classed.unionByName(alone), "repeated-lines")
    gone = indexed.select("line_id", "place").join(repeated, "line_id")
    gone = gone.filter("place <> earliest").select("place.*")
    found = gone.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("line_no")).alias("removed"))
    return stored(found, "removed-lines")


def without_repeats(docs: DataFrame, least_chars: int = LEAST_CHARS, pairs_within: int = PAIRS_WITHIN) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text``."""
    removed = removed_lines(docs, least_chars, pairs_within)
    joined = matched(docs, removed, "left", "doc_id")
    gone = F.col("theirs.removed")
    # One mark a line, up to the last one that goes.
    gap = lambda at, i: at - F.when(i == 0, 0).otherwise(F.get(gone, i - 1) + 1)
    marks = F.array_join(F.transform(gone, lambda at, i: F.concat(F.repeat(F.lit("0"), gap(at, i)), F.lit("1"))), "")
    marked = F.zip_with(
        F.split("mine.text", "\n"), F.split(marks, ""), lambda line, mark: F.when(F.coalesce(mark, F.lit("0")) != "1", line)
    )
    kept = F.array_join(F.filter(marked, lambda line: line.isNotNull()), "\n")
    text = F.when(gone.isNull(), F.col("mine.text")).otherwise(kept).alias("text")
    return joined.select(*[text if c == "text" else F.col(f"mine.`{c}`") for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    removed = removed_lines(docs).withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    lines = docs.select("doc_id", text_hash().alias("text_hash"), F.size(F.split("text", "\n")).alias("n_lines"))
    joined = lines.join(
        removed, same(F.col("doc_id"), F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left"
    )
    return joined.select(
        "doc_id",
        F.when(F.col("n_lines") < 0, 0).otherwise(F.col("n_lines")).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce(F.array_join("removed", ","), F.lit("")).alias("removed_lines"),
    )
