import re
from collections import Counter
from math import floor, log

import pyarrow as pa
import pytest

from costlens.llm import search as S
from tests.llm.helpers import EDGES, clashing, documents, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, k=20):
    bags = [Counter(terms(r[1])) for r in docs]
    n_docs, n_terms = sum(bool(b) for b in bags), sum(sum(b.values()) for b in bags)
    df = Counter(t for b in bags for t in b)
    out = []
    for item_id, text in items:
        scored = []
        for (doc_id, *_), bag in zip(docs, bags, strict=True):
            m = 75 + (25 * sum(bag.values()) * n_docs) // max(1, n_terms)
            score = sum(floor(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 12 * m)) for t in terms(text) if bag[t])
            if score:
                scored.append((-score, doc_id is None, doc_id or 0))
        out += [(item_id, rank, None if null else doc_id, -score) for rank, (score, null, doc_id) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def run(spark, docs, items, prepare=lambda df: df, k=20):
    items = spark.createDataFrame(items, "item_id long, text string")
    return sorted([tuple(r) for r in S.lexical_search(prepare(documents(spark, docs)), prepare(items), k).collect()], key=str)


ITEMS = [(1, "baran dolek RIMOS baran"), (2, "漢字 one"), (3, None), (4, ""), (None, "dolek"), (5, "nowhere"), (2, "漢字 one"), (6, prose(4, 40)), (7, "x" * 200_000)]


def corpus(seed, n):
    return [(i, prose(seed * 1000 + i % (n // 2), 5 + i * 7 % 90)) for i in range(n)]


@pytest.fixture()
def small_blocks(monkeypatch):
    monkeypatch.setattr(S, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(S, "PART_TERMS", 500)


def test_edges_ties_and_clashing_columns(spark):
    docs = EDGES + corpus(1, 60)
    assert run(spark, docs, ITEMS) == brute(docs, ITEMS)
    assert run(spark, docs, ITEMS, clashing) == brute(docs, ITEMS)


def test_many_blocks_and_query_blocks(spark, small_blocks, monkeypatch):
    monkeypatch.setattr(S, "QUERY_ROWS", 4)
    docs = corpus(2, 400) + [(1000 + i, prose(9, 30)) for i in range(200)] + [(None, prose(9, 30))] * 30  # a hot stratum of equal texts
    items = [(i, prose(i, 6)) for i in range(9)] + [(50, prose(9, 30))]
    assert run(spark, docs, items) == brute(docs, items)
    assert run(spark, docs, items, k=3) == brute(docs, items, 3)


def test_empty_tables(spark):
    assert run(spark, [], ITEMS) == []
    assert run(spark, corpus(1, 20), []) == []
    assert run(spark, [(1, None), (2, "...")], ITEMS) == []


def test_strata_and_impacts_of_a_block():
    texts = ["a a b", "a b b", "a", "b c d e"]
    rows = pa.table({"m": [80, 80, 78, 84], "doc_id": [3, 1, 2, 4], "text": texts})
    block = S._block(rows).to_pylist()[0]
    assert block["ids"] == [2, 1, 3, 4]  # by stratum, then id
    assert sorted(zip(block["level_stratum"], block["level_impact"], strict=True)) == sorted(
        [(0, 10**9 // (1000 + 12 * 78)), (1, 2 * 10**9 // (2000 + 12 * 80)), (1, 10**9 // (1000 + 12 * 80)), (2, 10**9 // (1000 + 12 * 84))]
    )
    for a, b in zip(block["start"], block["start"][1:], strict=False):
        level = block["level"][a:b]
        assert level == sorted(level)  # by stratum, greatest impact first


def test_parts_are_even():
    first, count = S._layout({0: 10, 3: 20, 5: 4 * S.PART_TERMS, 6: 5, 40: 1})
    assert first[0] == first[3] and count[5] == 4 and first[6] == first[5] + 4 and first[40] == first[6]
