import re

import pytest
from pyspark.sql import functions as F

from costlens.llm import mixing, prefix
from tests.llm.helpers import EDGES, clashing, documents, prose


def brute_targets(sizes, weights=(5, 2, 1), volume=1.5, most=2.0):
    """Targets by sharing the excess out again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = volume * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        if not free:
            return {s: most * sizes[s] for s in names}
        level = (total - sum(most * sizes[s] for s in capped)) / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in capped else weight[s] * level for s in names}
        capped |= over


def count(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(spark, rows, prepare=lambda df: df):
    got = mixing.plan(prepare(documents(spark, rows))).collect()
    assert len(got) == len(rows)
    sizes = {}
    for r in rows:
        s = r[3] if len(r) > 3 else "src0"
        sizes[s] = sizes.get(s, 0) + count(r[1])
    want = brute_targets(sizes)
    largest = {s: max((r.size for r in got if r.source == s), default=0) for s in sizes}
    for s, target in want.items():
        mine = [r for r in got if r.source == s]
        assert all(r.source_size == sizes[s] and r.target == pytest.approx(target) for r in mine)
        assert abs(sum(r.taken for r in mine) - target) <= largest[s] / 2 + 1e-6
    for r in got:
        assert r.taken == r.size * len(r.positions) <= 2 * r.size
        assert all(0 <= p <= 1 for p in r.positions) and r.positions == sorted(r.positions)
    return got


def test_edges(spark):
    check(spark, EDGES, clashing)


def test_sources_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(prefix, "BUCKET_ROWS", 8)
    rows = [(i, prose(i, 1 + i * 7 % 60), "en", "hot" if i % 3 == 0 else f"s{i % 13}") for i in range(500)]
    rows += [(1000 + i, prose(i, 30), "en", None) for i in range(20)] + [(2000, "  ", "en", "blank"), (2001, None, "en", "blank")]
    first = check(spark, rows)
    assert sorted(map(tuple, first)) == sorted(map(tuple, check(spark, rows)))  # reruns agree


def test_empty_table(spark):
    empty = documents(spark, []).limit(0)
    assert mixing.plan(empty).collect() == [] and mixing.training_order(empty).collect() == []


def test_training_order_holds_every_copy(spark):
    rows = [(i, prose(i, 5 + i % 40), "en", f"s{i % 5}") for i in range(200)] + [(3, "a b c", "en", "s1")] * 4 + [(None, "x y", "en", None)] * 2
    df = clashing(documents(spark, rows))
    out = mixing.training_order(df).collect()
    assert [r.position for r in out] == sorted(r.position for r in out)
    planned = mixing.plan(df).agg(F.sum("taken"), F.sum(F.size("positions"))).first()
    assert (sum(count(r.text) for r in out), len(out)) == tuple(planned)
    assert set(df.columns) <= set(mixing.training_order(df).columns)


@pytest.mark.parametrize("knots", [*mixing.SCHEDULES, ((0.0, 0.0), (0.3, 2.0), (0.3001, 0.5), (1.0, 0.0))])
def test_inversion(spark, knots):
    shares = [i / 50 for i in range(51)]
    times = [r[0] for r in spark.createDataFrame([(s,) for s in shares], "s double").select(mixing.invert(knots, F.col("s"))).collect()]
    assert times == sorted(times) and all(0 <= t <= 1 for t in times)
    for s, t in zip(shares, times, strict=True):  # integrate the schedule up to t
        area = total = 0.0
        for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False):
            total += (t1 - t0) * (w0 + w1) / 2
            if t > t0:
                end = min(t, t1)
                w = w0 + (w1 - w0) * (end - t0) / (t1 - t0)
                area += (end - t0) * (w0 + w) / 2
        assert area / total == pytest.approx(s, abs=1e-7)


def test_bad_schedules():
    for knots in (((0.0, -1.0), (1.0, 1.0)), ((0.0, 0.0), (1.0, 0.0)), ((1.0, 1.0), (0.0, 1.0))):
        with pytest.raises(ValueError):
            mixing.integrated(knots)
