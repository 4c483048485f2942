import numpy as np

from costlens.llm import embedding_dedup as ed
from tests.llm.helpers import clashing

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, least=0.95):
    good = {}
    for i, (vec_id, v, _) in enumerate(rows):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = np.array(v, np.float32).astype(np.float64)
    links = {i: set() for i in range(len(rows))}
    for i, x in good.items():
        for j, y in good.items():
            if i != j and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                links[i].add(j)
    comp = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            for k in links[todo.pop()] - seen:
                seen.add(k)
                todo.append(k)
        named = [rows[k][0] for k in seen if rows[k][0] is not None]
        comp[i] = min(named) if named and rows[i][0] is not None else None
    return sorted((rows[i][0] if rows[i][0] is not None else -1, len(links[i]), comp[i] if comp[i] is not None else -1) for i in links)


def run(spark, rows, prepare=lambda df: df):
    df = prepare(spark.createDataFrame(rows, SCHEMA).repartition(4))
    out = ed.embedding_dedup(df).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)
    return sorted((r.vec_id if r.vec_id is not None else -1, r.n_links, r.component_id if r.component_id is not None else -1) for r in out)


def family(rng, n, dim, spread):
    base = rng.normal(size=dim)
    return [(base + rng.normal(size=dim) * spread).tolist() for _ in range(n)]


def test_groups_copies_and_edges(spark):
    rng = np.random.default_rng(5)
    vectors = family(rng, 120, 64, 0.2) + family(rng, 30, 64, 0.25) + rng.normal(size=(200, 64)).tolist()
    vectors += [vectors[0]] * 40 + [[2 * x for x in vectors[3]]]
    vectors += [None, [], [0.0] * 64, [None] + [1.0] * 63, [float("nan")] * 64, [float("inf")] + [0.0] * 63, [1.0], [-1.0], [3.0], [1.0, 0.0, 0.5], [1.0, 0.0, 0.5]]
    rows = [(i * 31 % 1009, v, i % 2) for i, v in enumerate(vectors)] + [(None, vectors[1], 0), (None, vectors[200], 1)]
    assert run(spark, rows, clashing) == brute(rows)


def test_blocks_count_every_pair_once(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, v, 0) for i, v in enumerate(family(rng, 150, 16, 0.15) + family(rng, 60, 16, 0.12))]
    monkeypatch.setattr(ed, "BLOCK", 16)
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, [], lambda df: df) == []


def test_hadamard_keeps_length():
    x = np.random.default_rng(0).normal(size=(5, 32))
    y = ed.hadamard(x)
    assert np.allclose((y * y).sum(1), 32 * (x * x).sum(1)) and np.allclose(ed.hadamard(y), 32 * x)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(1)
    for dim in (24, 64, 256):
        a = rng.normal(size=(4000, dim))
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        b = rng.normal(size=a.shape)
        b -= (a * b).sum(1, keepdims=True) * a
        b = 0.95 * a + np.sqrt(1 - 0.95**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
        for hashes in ed.PROBES:
            h = ed.Hasher(dim, hashes)
            met = (h.keys(a)[:, :, :, None] == h.keys(b)[:, :, None, :]).any((1, 2, 3))
            assert met.mean() > 0.999, (dim, hashes)


def test_a_common_vector_and_negative_zeros(spark):
    """A third of the rows hold one vector, another third none; zeros of either sign are equal."""
    rng = np.random.default_rng(9)
    base = rng.normal(size=16).tolist()
    rows = [(i, base, 0) for i in range(100)] + [(200 + i, None if i % 2 else [0.0] * 16, 0) for i in range(100)] + [(400 + i, v, 0) for i, v in enumerate(family(rng, 60, 16, 0.3))]
    rows += [(600, [0.0, 1.0], 0), (601, [-0.0, 1.0], 0), (602, [0.0, -1.0], 0)]
    assert run(spark, rows) == brute(rows)
