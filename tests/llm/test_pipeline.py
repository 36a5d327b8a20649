"""The corpus pipeline, stage by stage, against plain versions of each stage on its own input."""

import random
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import helpers as H
from tests.llm.test_operators import line_twin
from tidemark.llm import quality_rules

STAGES = dict(corpus_pipeline.STAGES)
ITEMS = [
    (1, "which of the seven rivers that leave the northern lake runs past the old stone bridge first"),
    (2, "name the green cloud over river 7"),
    (3, None),
    (4, "  "),
]


def corpus():
    rng = random.Random(9)
    rows = [(d, H.prose(1000 + d, rng.randint(40, 160)), "en", rng.choice("ab")) for d in range(90)]
    rows += [(200 + d, "too short", "en", "a") for d in range(5)]
    rows += [(300 + d, " ".join(["again and again we say the same"] * 12), "en", "b") for d in range(4)]
    shared = "this line about cookies and terms stands in many documents"
    rows += [(400 + d, H.prose(2000 + d, 60) + f"\n{shared}{'.' * (d % 2)}\n" + H.prose(3000 + d, 30), "en", "a") for d in range(9)]
    rows += [(500 + d, H.prose(7, 120), "en", "b") for d in range(6)]
    rows += [(600, H.prose(8, 60) + " " + ITEMS[0][1] + " " + H.prose(9, 30), "en", "a")]
    rows += [(601, H.prose(10, 60) + " " + ITEMS[1][1].upper() + ", " + H.prose(11, 30), None, None)]
    rows += [(None, H.prose(12, 70), "en", "a"), (None, None, None, None), (700, "", "en", "b"), (1, H.prose(13, 50), "en", "a")]
    rows += [(800, H.prose(14, 90), "en", "a")] * 2
    return rows


@pytest.fixture
def sf_dir(spark, tmp_path):
    path = str(tmp_path / uuid.uuid4().hex)
    spark.createDataFrame(ITEMS, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def rows_of(frame):
    return [tuple(r) for r in frame.select("doc_id", "text", "lang", "source").collect()]


@pytest.mark.parametrize("extra", [False, True])
def test_stages_equal_plain_versions(spark, sf_dir, extra):
    docs = H.frame(spark, corpus(), extra).repartition(3)
    before = rows_of(docs)

    kept = STAGES["quality rules"](spark, docs, sf_dir)
    assert kept.columns == docs.columns
    passed = Counter(rows_of(kept))
    verdicts = {(r.doc_id, r.text_hash, r.lang, r.source): r.kept for r in quality_rules.judged(docs).collect()}
    hashes = {r.text: r.h for r in docs.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    assert passed == Counter(r for r in before if verdicts[(r[0], hashes[r[1]], r[2], r[3])])
    for row in before:
        words = (row[1] or "").split()
        if len(words) < 20 or len(words) > 8 and len(set(zip(*[words[i:] for i in range(8)]))) * 3 < len(words):
            assert row not in passed
    assert sum(passed.values()) > 100

    kept = spark.createDataFrame(kept.collect(), kept.schema)
    lined = STAGES["line dedup"](spark, kept, sf_dir)
    assert lined.columns == docs.columns
    want = line_twin([r[:2] for r in rows_of(kept)])
    got = [(-1 if d is None else d, t or "", t is None) for d, t, *_ in rows_of(lined)]
    assert sorted(got) == want

    lined = spark.createDataFrame(lined.collect(), lined.schema)
    one = STAGES["simhash near-dedup"](spark, lined, sf_dir)
    assert one.columns == docs.columns
    rows = set(rows_of(lined))
    prints = {t: H.simhash(t) for _, t, *_ in rows}
    values = sorted(set(prints.values()))
    linked = [(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 2]
    group = H.groups(values, linked)
    hashes = {r.text: r.h for r in lined.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    first = {}
    for row in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, hashes[r[1]])):
        first.setdefault(group[prints[row[1]]], row)
    assert Counter(rows_of(one)) == Counter(first.values())
    assert len(first) < len(rows)

    one = spark.createDataFrame(one.collect(), one.schema)
    clean = STAGES["benchmark decontamination"](spark, one, sf_dir)
    assert clean.columns == docs.columns
    dirty = [r for r in rows_of(one) if any(t and t.strip() and t in (r[1] or "").lower() for _, t in ITEMS)]
    assert {r[0] for r in dirty} == {600, 601}
    assert Counter(rows_of(clean)) == Counter(rows_of(one)) - Counter(dirty)

    clean = spark.createDataFrame(clean.collect(), clean.schema)
    mixed = STAGES["mixing sources to target weights"](spark, clean, sf_dir).collect()
    sizes = [(d, s, len((t or "").split())) for d, t, _, s in rows_of(clean)]
    assert Counter((r.doc_id, r.source, r.size) for r in mixed) == Counter(sizes)
    assert all(r.taken in (0, r.size, 2 * r.size) for r in mixed)
    assert sum(r.taken for r in mixed) == pytest.approx(1.5 * sum(n for *_, n in sizes), rel=0.05)


def test_run_chains_the_stages_over_stored_rows(spark, sf_dir):
    H.frame(spark, corpus()).write.parquet(f"{sf_dir}/documents.parquet")
    mixed = lambda frame: Counter((r.doc_id, r.source, r.size, r.taken) for r in frame.collect())
    got = mixed(corpus_pipeline.run(spark, sf_dir))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        docs = spark.createDataFrame(out.collect(), out.schema)
    assert got == mixed(docs) and got


def test_run_over_an_empty_table(spark, sf_dir):
    H.frame(spark, []).write.parquet(f"{sf_dir}/documents.parquet")
    assert corpus_pipeline.run(spark, sf_dir).count() == 0
