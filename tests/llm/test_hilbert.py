import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from costlens.llm import hilbert as hb
from costlens.llm import prefix
from tests.llm.helpers import EDGES, clashing, documents, prose


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbours(spark, dims, bits):
    side = 1 << bits
    cells = spark.range(side**dims).select(*[(F.floor(F.col("id") / side**i) % side).cast("long").alias(f"d{i}") for i in range(dims)])
    rows = sorted(hb._along_curve(cells, [f"d{i}" for i in range(dims)], bits).collect(), key=lambda r: r["__curve"])
    assert [r["__curve"] for r in rows] == list(range(side**dims))
    assert all(sum(abs(a[i] - b[i]) for i in range(dims)) == 1 for a, b in zip(rows, rows[1:], strict=False))


def check(rows, got, shards):
    assert len(got) == len(rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in got) == sorted(
        (r[0] is None, r[0] or 0, len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows
    )
    for s in range(shards):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    sizes = [sum(r.shard == s for r in got) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(rows)
    in_order = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in in_order] == sorted(r.curve for r in got)


def test_edges_and_clashing_names(spark):
    df = clashing(documents(spark, EDGES))
    out = hb.hilbert_shards(df, hb.document_dims())
    assert {"kept", "score", "text"} <= set(out.columns) and len(set(out.columns)) == len(out.columns)
    check(EDGES, out.collect(), 8)


def test_hot_cell_ties_and_reruns(spark, monkeypatch):
    monkeypatch.setattr(prefix, "BUCKET_ROWS", 16)  # the hot cell is dealt over many buckets
    rows = [(i, prose(i % 5, 10), "en", "hot") for i in range(600)] + [(i % 50, "same", f"l{i % 3}", f"s{i % 7}") for i in range(300)]
    runs = [hb.hilbert_shards(documents(spark, rows), hb.document_dims()).collect() for _ in range(2)]
    check(rows, runs[0], 8)
    places = [sorted((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in run) for run in runs]
    assert places[0] == places[1]


def test_brute_force_order(spark):
    """Slots along the curve, in each cell by the hash of id, size and checksum, cut into even runs."""
    rows = [(i % 90 if i % 3 else None, prose(i % 40, 3 + i % 25), f"l{i % 2}", f"s{i % 3}") for i in range(500)]
    got = hb.hilbert_shards(documents(spark, rows), hb.document_dims()).collect()

    def order(r):
        named = ":".join(str(x) for x in (r.doc_id, r.size, r.text_crc32) if x is not None)
        return r.curve, int(hashlib.md5(named.encode()).hexdigest()[:15], 16)

    ranked = sorted(got, key=order)
    n, ends = len(ranked), [-(-s * len(ranked) // 8) for s in range(9)]
    for s in range(8):
        assert [r.slot for r in sorted((r for r in got if r.shard == s), key=lambda r: r.slot)] == list(range(ends[s + 1] - ends[s]))
    want = [(order(r), i * 8 // n) for i, r in enumerate(ranked)]
    assert sorted(want) == sorted((order(r), r.shard) for r in got)


def test_shards_are_narrow(spark):
    rows = [(i, prose(i, 5 + i % 90), f"l{i % 4}", f"src{i % 16}") for i in range(2000)]
    got = hb.hilbert_shards(documents(spark, rows), hb.document_dims()).collect()
    pairs = [{(r.lang, r.source) for r in got if r.shard == s} for s in range(8)]
    every = {(r[2], r[3]) for r in rows}
    assert sum(map(len, pairs)) < 0.6 * 8 * len(every)


def test_empty_table_and_bad_arguments(spark):
    empty = documents(spark, []).limit(0)
    assert hb.hilbert_shards(empty, hb.document_dims()).collect() == []
    with pytest.raises(ValueError):
        hb.hilbert_shards(empty, {"lang": F.col("lang")})


def test_written_shards(spark, tmp_path):
    rows = [(i, prose(i, 8), "en", f"s{i % 3}") for i in range(40)]
    hb.write_shards(hb.hilbert_shards(documents(spark, rows), hb.document_dims(), shards=4), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r["count"] for r in back.groupBy("shard").count().collect()) == [10, 10, 10, 10]
