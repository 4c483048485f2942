"""The pipeline's stages against brute-force versions on a small table."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tests.llm.helpers import EDGES, clashing, documents, edited, prose
from tests.llm.test_classifiers import fixture
from tests.llm.test_decontaminate import brute as brute_items
from tests.llm.test_mixing import brute_targets, count
from tests.llm.test_near_dedup import brute as brute_near


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A table folder: insults, copies, near copies and benchmark passages planted."""
    path = str(tmp_path_factory.mktemp("sf"))
    rows, labels = fixture(300)
    rows += [(1000 + i, edited(prose(7, 100), i, i % 4)) for i in range(20)] + [(1100 + i, prose(8, 60)) for i in range(10)]
    items = [(i, prose(700 + i, 20)) for i in range(5)]
    rows += [(1200 + i, f"{prose(i, 15)} {items[i % 5][1]} {prose(i + 1, 9)}", "en", "leaky") for i in range(15)]
    rows += [(2000 + d, t) for d, t, *_ in EDGES if d is not None and d != 10]
    documents(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, items


def test_stages(spark, folder):
    path, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    names = [n for n, _ in cp.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    clean = cp.toxicity(spark, docs, path).cache()
    assert clean.columns == docs.columns
    insulted = {i for i in range(300) if i % 5 == 1}
    left = {r.doc_id for r in clean.collect()}
    assert not insulted & left and len(left) >= docs.select("doc_id").distinct().count() - len(insulted) - 3

    rows = [(r.doc_id, r.text) for r in clean.collect()]
    single = cp.near_duplicates(spark, clean, path).cache()
    keep = {d for d, (_, c) in brute_near(rows, 80).items() if d == c}
    assert {r.doc_id for r in single.collect()} == keep and single.columns == docs.columns

    rows = [(r.doc_id, r.text) for r in single.collect()]
    fresh = cp.decontamination(spark, single, path).cache()
    keep = {d for d, hit, _, _ in brute_items(rows, items, 0.06, 40) if not hit}
    assert {r.doc_id for r in fresh.collect()} == keep and fresh.columns == docs.columns

    mixed = cp.mix(spark, fresh, path).cache()
    assert mixed.columns == docs.columns
    sizes, taken, largest = {}, {}, {}
    for r in fresh.collect():
        sizes[r.source] = sizes.get(r.source, 0) + count(r.text)
        largest[r.source] = max(count(r.text), largest.get(r.source, 0))
    for r in mixed.collect():
        taken[r.source] = taken.get(r.source, 0) + count(r.text)
    for s, target in brute_targets(sizes).items():
        assert abs(taken.get(s, 0) - target) <= largest[s] / 2 + 1e-6

    out = cp.shard(spark, mixed, path).collect()
    assert len(out) == mixed.count()
    sizes = [sum(r.shard == s for r in out) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1
    whole = cp.run(spark, path)
    assert sorted(r.doc_id for r in whole.collect()) == sorted(r.doc_id for r in out)


def test_odd_tables(spark, folder):
    """Every stage takes the edges, clashing names and empty tables, and keeps columns."""
    path, _ = folder
    for docs in (clashing(documents(spark, EDGES)), documents(spark, []).limit(0)):
        for name, stage in cp.STAGES:
            out = stage(spark, docs, path)
            rows = out.count()
            assert (rows > 0) == (docs.count() > 0), name
            if name != "sharding":
                assert out.columns == docs.columns, name
            else:
                assert rows == docs.count()
    nulls = cp.near_duplicates(spark, documents(spark, EDGES), path).where(F.col("doc_id").isNull()).count()
    assert nulls == 2


def test_decisions_hold_for_null_and_repeated_ids(spark, folder):
    """A row goes or stays by its own text; the rows that share its id don't matter."""
    path, items = folder
    insult = prose(1, 40).replace(" ", " zurgle ", 3)
    leak = f"{prose(800, 9)} {items[0][1]} {prose(801, 9)}"
    clean = [prose(900 + i, 40) for i in range(4)]
    copy, family = prose(950, 60), prose(960, 120)
    rows = [(None, insult, "en", "odd"), (5000, insult, "en", "odd"), (5000, clean[0], "en", "odd"), (None, clean[1], "en", "odd")]
    docs = spark.read.parquet(f"{path}/documents.parquet").unionByName(documents(spark, rows))
    assert sorted(r.text for r in cp.toxicity(spark, docs, path).where("source = 'odd'").collect()) == sorted(clean[:2])
    rows = [(None, leak), (2, leak), (2, clean[2]), (None, clean[3])]
    assert sorted(r.text for r in cp.decontamination(spark, documents(spark, rows), path).collect()) == sorted(clean[2:])
    rows = [(3, copy)] * 3 + [(3, clean[0]), (None, clean[1]), (None, None), (None, None), (4, ""), (4, "")]
    rows += [(9, family), (8, edited(family, 1, 1)), (8, edited(family, 2, 1)), (7, edited(family, 3, 1))] + [(6, clean[2]), (None, clean[2]), (None, clean[2])]
    docs = clashing(documents(spark, rows))
    out = cp.near_duplicates(spark, docs, path)
    assert out.columns == docs.columns
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in out.collect())
    want = [(3, copy), (3, clean[0]), (None, clean[1]), (None, None), (None, None), (4, ""), (4, ""), (7, edited(family, 3, 1)), (None, clean[2])]
    assert got == sorted((d is not None, d or 0, t or "") for d, t in want)
