"""Merkle manifest, conversation trie and language identification against brute-force versions."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import helpers as H
from tidemark.llm import conversation_trie, language_id, merkle_manifest

SF_DIR = "/root/testdata/sf0.001"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def stored_as(spark, tmp_path, name, frame):
    frame.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


# --- manifest


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def folded(nodes, at):
    """Levels above ``nodes`` to the last one, and for the node ``at`` its (left, right) siblings."""
    path = []
    while len(nodes) > 1:
        run = at // 8 * 8
        path.append(("".join(nodes[run:at]), "".join(nodes[at + 1 : run + 8])))
        nodes = [sha(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
        at //= 8
    return nodes[0], path


def manifest(rows):
    """Expected rows of the query for (doc_id, text, lang, source, n_chars)."""
    def leaf(row, text):
        return sha(*[field(v) for v in (row[0], row[3], row[2], row[4], text)])

    trees = defaultdict(list)
    for row in rows:
        trees[row[2]].append(row)
    none_first = lambda v: (v is not None, v)
    langs = sorted(trees, key=lambda v: (v is not None, (v or "").encode()))
    for own in trees.values():
        own.sort(key=lambda r: (none_first(r[0]), leaf(r, r[1])))
    leaves = {lang: [leaf(r, r[1]) for r in trees[lang]] for lang in langs}
    subroots = [folded(leaves[lang], 0)[0] for lang in langs]
    out = []
    for top, lang in enumerate(langs):
        root, above = folded(subroots, top)
        for at, row in enumerate(trees[lang]):
            path = folded(leaves[lang], at)[1] + above
            text = row[1]
            if zlib.crc32(str("" if row[0] is None else row[0]).encode()) % 3 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            node = leaf(row, text)
            for left, right in path:
                node = sha(left, node, right)
            proof = sha(*[a + b for a, b in path])
            out.append((row[0], leaves[lang][at], subroots[top], root, proof, node, node == root))
    return sorted(map(str, out))


def manifest_rows():
    rows = [(d, t, lang, f"s{(d or 0) % 3}", 1) for d, t, *_ in H.edge_rows() for lang in ("en", "", None)]
    rows += [(d, f"Text {d} Ä", "de", "s", d) for d in range(100, 165)]
    rows += [(7, "Alone", "xx", None, None)] + [(None, "Same Ids", "zz", "s", 2)] * 20
    return rows


def test_manifest_equals_brute_force_and_sql(spark, tmp_path):
    rows = manifest_rows()
    sf_dir = stored_as(spark, tmp_path, "documents", spark.createDataFrame(rows, H.DOCS).repartition(5))
    got = sorted(str(tuple(r)) for r in merkle_manifest.query(spark, sf_dir).collect())
    assert got == manifest(rows)
    assert "False" in "".join(got) and "True" in "".join(got)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet/*.parquet'")
    assert sorted(map(str, duck.sql(merkle_manifest.sql()).fetchall())) == got


def test_manifest_of_nothing_and_of_one_row(spark, tmp_path):
    empty = spark.createDataFrame([], H.DOCS)
    assert merkle_manifest.query(spark, stored_as(spark, tmp_path / "a", "documents", empty)).count() == 0
    rows = [(5, "Alone", "xx", None, None)]
    one = spark.createDataFrame(rows, H.DOCS)
    got = merkle_manifest.query(spark, stored_as(spark, tmp_path / "b", "documents", one)).collect()
    assert sorted(str(tuple(r)) for r in got) == manifest(rows)


def test_manifest_ignores_extra_columns(spark, tmp_path):
    clash = ", digest string, pos string, size string, c0 string, path string, root string, _place string"
    rows = [(d, f"T{d}", "en", "s", d, *["x"] * 7) for d in range(20)]
    sf_dir = stored_as(spark, tmp_path, "documents", spark.createDataFrame(rows, H.DOCS + clash))
    got = merkle_manifest.query(spark, sf_dir).collect()
    assert sorted(str(tuple(r)) for r in got) == manifest([r[:5] for r in rows])


def test_no_parent_gathers_more_than_its_slots(spark):
    """A group with every row is dealt over tasks; other fanouts give other trees."""
    leaves = spark.range(1000).select(
        F.lit("en").alias("lang"), F.col("id").alias("doc_id"), F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest")
    )
    tree = merkle_manifest.build(leaves, ["lang"], ["doc_id"], 3)
    assert [level.count() for level in tree.levels] == [334, 112, 38, 13, 5, 2, 1]
    assert len([c for c in tree.levels[0].columns if c.startswith("c")]) == 3


# --- conversation trie


def rebuilt(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            turns[conv].append(((turn is not None, turn or 0), role, key, text))
    own = {c: [(r, x) for _, r, _, x in sorted(t)] for c, t in turns.items()}
    out = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + t[h:]
    return out


def expected_nodes(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, own in members.items():
        words = len(node[-1][1].encode().split()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children.get(node)
            saved[node[:d]] += (len(own) - 1) * words
    return sorted(
        str((
            min(own), len(node), min(members[node[:-1]]) if node else None, len(own),
            children.get(node, 0), leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, sorted(c for c in own if len(convs[c]) == len(node)))).encode()).hexdigest(),
        ))
        for node, own in members.items()
    )


TURNS = "conv_id bigint, turn bigint, role string, text string"


def conversation_rows():
    rng = random.Random(5)
    rows = []
    for c in range(300):
        for t in range(rng.choice([1, 1, 2, 3, 6])):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["a b", "a", "", "x\ny z"])))
    rows += [(c, t, "user", f"same {t}") for c in range(1000, 1200) for t in range(4)]
    rows += [(20_020, t, "user", f"long {t}") for t in range(500)]
    rows += [(20_025, t, "user", f"long {t}") for t in range(490)] + [(20_025, 600, None, H.LONG)]
    rows += [(41, None, None, None), (41, None, "user", "tie"), (41, None, "user", "tie"), (41, 0, "", "")]
    rows += [(None, 0, "user", "nobody"), (-27, 0, "user", "below zero"), (-27, 1, "user", "é x")]
    return rows


@pytest.mark.parametrize("shard_turns", [1 << 17, 60, 7])
def test_trie_equals_brute_force(spark, shard_turns):
    rows = conversation_rows()
    frame = spark.createDataFrame(rows, TURNS).repartition(4)
    lists = conversation_trie.rebuilt(conversation_trie.turn_lists(frame))
    got = conversation_trie.trie(lists, shard_turns).collect()
    assert sorted(str(tuple(r)) for r in got) == expected_nodes(rebuilt(rows))


def test_trie_query_equals_sql_with_extra_columns(spark, tmp_path):
    rows = [(*r, "x", 1, b"y") for r in conversation_rows()]
    frame = spark.createDataFrame(rows, TURNS + ", path string, n bigint, seq binary")
    sf_dir = stored_as(spark, tmp_path, "conversations", frame)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf_dir}/conversations.parquet/*.parquet'")
    got = sorted(str(tuple(r)) for r in conversation_trie.query(spark, sf_dir).collect())
    assert got == sorted(map(str, duck.sql(conversation_trie.sql()).fetchall()))


def test_trie_of_nothing_and_of_turnless_conversations(spark, tmp_path):
    empty = spark.createDataFrame([], TURNS)
    assert conversation_trie.query(spark, stored_as(spark, tmp_path, "conversations", empty)).count() == 0
    turnless = [c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4]
    rows = [(c, 0, "user", "x") for c in turnless]
    lists = conversation_trie.rebuilt(conversation_trie.turn_lists(spark.createDataFrame(rows, TURNS)))
    (root,) = conversation_trie.trie(lists).collect()
    assert str(tuple(root)) == expected_nodes(rebuilt(rows))[0]
    assert (root.depth, root.n_convs, root.n_leaves) == (0, len(turnless), 1)


def test_ids_that_end_at_one_node_are_streamed(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "BLOCK_IDS", 7)
    ids = spark.range(0, 5000, 1, 9).selectExpr("IF(id % 3 = 0, binary('a'), binary('b')) AS seq", "id * 7 AS conv_id")
    got = {bytes(r.seq): tuple(r)[1:] for r in conversation_trie._stream_ends(ids).collect()}
    for seq, own in ((b"a", range(0, 5000, 3)), (b"b", [i for i in range(5000) if i % 3])):
        own = [7 * i for i in own]
        assert got[seq] == (len(own), own[0], hashlib.sha256(",".join(map(str, own)).encode()).hexdigest())


def test_double_array_finds_all_prefixes_and_nothing_else():
    rng = np.random.default_rng(3)
    sequences = sorted({tuple(rng.integers(0, 40, rng.integers(0, 6))) for _ in range(2000)})
    trie = conversation_trie.DoubleArray([np.array(s, np.int64) for s in sequences], 40)
    prefixes = {s[:d] for s in sequences for d in range(len(s) + 1)}
    slots = {p: trie.find(p) for p in prefixes}
    assert conversation_trie.FREE not in slots.values() and len(set(slots.values())) == len(prefixes)
    assert sum(len(level) for level in trie.levels) == len(prefixes)
    others = [tuple(rng.integers(0, 40, rng.integers(1, 7))) for _ in range(3000)]
    assert all((trie.find(o) != conversation_trie.FREE) == (o in prefixes) for o in others)
    assert len(trie.check) < 8 * len(prefixes)


# --- language identification


def plain_joint(model, text):
    """The same sum, n-gram by n-gram."""
    codes = language_id.normalized(text)
    total = model.prior.copy()
    for order in model.orders:
        for i in range(len(codes) - order + 1):
            ((_, bucket),) = [
                g for g in language_id.grams([codes[i : i + order]], [order], len(model.weights), 99) if len(g[0])
            ]
            total = total + model.weights[bucket[0]].astype(float)
    return total


def language_docs(spark, extra=""):
    rows = [(d, H.prose(d, 40), "en", "a", 1) for d in range(60)]
    rows += [(d, H.prose(d, 40, "der die und das haus fluss straße über grün wolke".split()), "de", "b", 1) for d in range(60, 90)]
    return rows


def test_batched_scores_equal_plain_sums(spark, monkeypatch):
    docs = spark.createDataFrame(language_docs(spark), H.DOCS)
    model = language_id.train(docs)
    texts = ["Haus und 12 Fluss!", "the river", "", None, "é", "漢字" * 5, H.prose(1, 90)]
    plain = [plain_joint(model, t) for t in texts]
    for cells in (1 << 22, 1 << 7):
        monkeypatch.setattr(language_id, "CELLS", cells)
        assert np.allclose(model.log_joint(texts), plain)
    names, scores = model.predict(texts)
    assert names == ["de", "en", "und", "und", *names[4:6], "en"]
    assert scores[2:4] == [0.0, 0.0] and all(0 <= s <= 1 for s in scores)
    exact = [np.exp(p - np.logaddexp.reduce(p)).max() for p in plain]
    assert np.allclose([s for s, n in zip(scores, names) if n != "und"], [e for e, n in zip(exact, names) if n != "und"])


def test_training_counts_every_row_in_any_split(spark):
    rows = language_docs(spark)
    one = language_id.train(spark.createDataFrame(rows, H.DOCS).coalesce(1))
    many = language_id.train(spark.createDataFrame(rows, H.DOCS).repartition(7))
    assert one.languages == many.languages == ["de", "en"] and np.array_equal(one.weights, many.weights)
    twice = language_id.train(spark.createDataFrame(rows + rows[:60], H.DOCS))
    assert not np.array_equal(one.prior, twice.prior)
    counts = defaultdict(int)
    for _, text, lang, *_ in rows:
        for _, buckets in language_id.grams([language_id.normalized(text)], (1, 2, 3), len(one.weights), 1 << 20):
            for b in buckets:
                counts[lang, int(b)] += 1
    for i, lang in enumerate(one.languages):
        own = np.array([counts[lang, b] for b in range(len(one.weights))]) + language_id.SMOOTHING
        assert np.allclose(one.weights[:, i], np.log(own / own.sum()), atol=1e-5)


def test_buckets_shrink_so_that_the_matrix_stays_bounded():
    assert language_id.bucket_count(4) == language_id.BUCKETS
    assert all(language_id.bucket_count(n) * n <= language_id.CELLS for n in (1, 7, 500, 10**5, 1 << 22))
    assert language_id.bucket_count(0) and language_id.bucket_count(10**9) == 1


def test_held_out_documents_and_defined_cases(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = [(-1, None, "en", "a", 0), (-2, "", None, "a", 0), (-3, "12 .. 34", "de", None, 0), (-4, H.LONG, None, None, 1),
           (None, "the and of", "en", "a", 1), (None, None, None, None, None)]
    rows = docs.unionByName(spark.createDataFrame(odd, H.DOCS)).withColumns(
        {"score": F.lit("clash"), "lang_pred": F.lit("clash"), "held_out": F.lit("clash"), "_text": F.lit("clash")}
    )
    sf_dir = stored_as(spark, tmp_path, "documents", rows)
    found = language_id.query(spark, sf_dir)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    got = {r.doc_id: r for r in found.collect()}
    assert found.count() == rows.count()
    for doc_id in (-1, -2, -3):
        assert (got[doc_id].lang_pred, got[doc_id].score) == ("und", 0.0)
    truth = {r.doc_id: r.lang for r in docs.collect()}
    held = [d for d in truth if zlib.crc32(str(d).encode()) % 3 == 1]
    assert all(got[d].held_out == (d in set(held)) for d in truth)
    assert np.mean([got[d].lang_pred == truth[d] for d in held]) > 0.95


def test_language_of_an_empty_table_and_without_labels(spark, tmp_path):
    empty = spark.createDataFrame([], H.DOCS)
    assert language_id.query(spark, stored_as(spark, tmp_path / "a", "documents", empty)).count() == 0
    none = spark.createDataFrame([(i, "some words", None, "a", 1) for i in range(9)], H.DOCS)
    got = language_id.query(spark, stored_as(spark, tmp_path / "b", "documents", none)).collect()
    assert {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}
