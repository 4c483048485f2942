import pytest

from costlens.llm import near_dedup as nd
from tests.llm.helpers import EDGES, clashing, documents, edited, prose
from tests.llm.test_textbytes import words_of


def brute(rows, percent):
    """doc_id -> (n, component) by comparing all pairs of full shingle sets."""
    sets = {}
    for doc_id, text, *_ in rows:
        w = words_of(text)
        sets[doc_id] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    ids = sorted(k for k in sets if k is not None)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def check(spark, rows, percent=85, **options):
    got = nd.near_dedup(documents(spark, rows), percent=percent, **options).collect()
    want = brute(rows, percent)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id], r
            assert r.kept == (r.doc_id == r.component_id)
    return got


def test_edges(spark):
    check(spark, EDGES)


@pytest.mark.parametrize("percent", [85, 80])
def test_families_passages_and_copies(spark, percent):
    """Near copies around the threshold, a passage in many documents, exact copies, tiny sets."""
    rows, n = [], 0

    def add(text):
        nonlocal n
        rows.append(((n * 7919) % 100_003, text))
        n += 1

    base, passage = prose(1, 130), prose(2, 70)
    for i in range(60):
        add(edited(base, i, 1 + i % 4))
        add(passage + " " + prose(100 + i, 20 + i % 40))
    for i in range(40):
        add(prose(5, 90))
        add(" ".join(prose(6, 12).split()[: 6 + i % 6]))
        add(edited(prose(1000 + i // 4, 400), i, i % 6))
    got = check(spark, rows, percent, rare_df=4)  # most lists are longer: the dense path works too
    assert sum(not r.kept for r in got) > 40


def test_blocks(spark, monkeypatch):
    """Lists of several blocks give the same components."""
    base = prose(9, 120)
    rows = [(i, edited(base, i, 2 + i % 3)) for i in range(80)]
    monkeypatch.setattr(nd, "BLOCK_SHINGLES", 2000)
    check(spark, rows, rare_df=2)


def test_empty_and_clashing_columns(spark):
    assert nd.near_dedup(documents(spark, []).limit(0)).collect() == []
    rows = [(1, prose(1, 50)), (2, prose(1, 50)), (3, None)]
    got = {r.doc_id: r.component_id for r in nd.near_dedup(clashing(documents(spark, rows))).collect()}
    assert got == {1: 1, 2: 1, 3: 3}
    with pytest.raises(ValueError):
        nd.near_dedup(documents(spark, rows), percent=40)


def test_an_id_with_many_texts(spark):
    """A third of the rows under one id: one node, whose links are those of all its texts."""
    rows = [(77, prose(5000 + i, 30)) for i in range(150)] + [(i % 40 + 200, edited(prose(5000 + i, 30), i, i % 3)) for i in range(150)] + [(i, prose(i, 30)) for i in range(60)]
    each = {i: sets for i, (_, sets) in enumerate((d, {tuple(words_of(t)[j : j + 5]) for j in range(len(words_of(t)) - 4)}) for d, t in rows)}
    root = {d: d for d, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in each.items():
        for j in range(i):
            both = len(a & each[j])
            if both and 100 * both >= 85 * len(a | each[j]):
                x, y = find(rows[i][0]), find(rows[j][0])
                root[max(x, y)] = min(x, y)
    got = nd.near_dedup(documents(spark, rows)).collect()
    assert len(got) == len(rows) and all(r.component_id == find(r.doc_id) and r.kept == (r.doc_id == r.component_id) for r in got)
    assert len({r.component_id for r in got}) < 90
