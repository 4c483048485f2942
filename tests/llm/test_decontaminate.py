import random
import unicodedata

import numpy as np

from pyspark.sql import functions as F

from costlens.llm import decontaminate as dc
from tests.llm.helpers import EDGES, clashing, documents, prose

ITEMS = "item_id long, text string"


def distance(p, t):
    """Least edit distance of p to a substring of t."""
    row = list(range(len(p) + 1))
    best = row[-1]
    for c in t:
        new = [0]
        for i in range(1, len(p) + 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (p[i - 1] != c)))
        row, best = new, min(best, new[-1])
    return best


def test_myers_matches_the_table():
    rng = random.Random(3)
    patterns, texts = [], []
    for _ in range(200):
        p = [rng.choice("abcd") for _ in range(rng.choice([1, 5, 63, 64, 65, 128, 130, 200]))]
        patterns.append(p)
        texts.append([rng.choice("abcd") for _ in range(rng.randrange(60))] + [c for c in p if rng.random() > 0.1] + ["a"] * rng.randrange(9))
    size = np.array([len(p) for p in patterns])
    a = np.zeros((200, size.max()), np.uint32)
    b = np.ones((200, max(map(len, texts))), np.uint32)
    for i, (p, t) in enumerate(zip(patterns, texts, strict=True)):
        a[i, : len(p)], b[i, : len(t)] = [ord(c) for c in p], [ord(c) for c in t]
    assert dc.myers(a, size, b).tolist() == [distance(p, t) for p, t in zip(patterns, texts, strict=True)]


def stream(text, digits=False):
    raw = (text or "").encode()
    points, _ = dc.tb.letter_stream(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), digits)
    return "".join(map(chr, points))


def whole_words(text):
    return " " + " ".join("".join(c if c.isalnum() or unicodedata.category(c)[0] == "M" else " " for c in (text or "").lower()).split()) + " "


def brute(docs, items, rate, least):
    out = []
    for doc_id, text, *_ in docs:
        hits = {}
        for item_id, item in items:
            p = stream(item).strip()
            if len(p) >= max(least, 1):
                d = distance(p, stream(text))
                if d <= int(rate * len(p)):
                    hits[item_id] = min(d, hits.get(item_id, d))
            elif whole_words(item).strip() and whole_words(item) in whole_words(text):
                hits[item_id] = 0
        out.append((doc_id if doc_id is not None else -1, bool(hits), sorted(x for x in hits if x is not None), min(hits.values(), default=-1)))
    return sorted(out)


def test_edited_passages(spark):
    rng = random.Random(8)
    items = [(i, prose(500 + i, 12 + i)) for i in range(12)] + [(3, prose(900, 20)), (50, None), (51, ""), (52, "too short"), (None, prose(7, 30)), (53, prose(504, 16))]
    docs = [(i, prose(i, 30)) for i in range(10)]
    for n, (item_id, item) in enumerate(x for x in items[:13] for _ in range(4)):
        chars = list(item)
        for _ in range(n % 4 * 3):  # 0, 3, 6 or 9 edits: within the budget or beyond
            at = rng.randrange(len(chars))
            chars[at : at + 1] = rng.choice([["q"], [], [chars[at], "z"]])
        docs.append((100 + n, prose(n, n % 7) + ",\n" + "".join(chars).upper() + "! " + prose(n + 1, n % 5)))
    docs.append((500, items[0][1] + " " + items[1][1] + " " + items[0][1]))
    got = dc.decontaminate(documents(spark, docs), spark.createDataFrame(items, ITEMS), error_rate=0.06).collect()
    got = sorted((r.doc_id, r.contaminated, r.item_ids, -1 if r.least_distance is None else r.least_distance) for r in got)
    want = brute(docs, items, 0.06, 40)
    assert got == want and 20 < sum(x[1] for x in want) < len(docs) - 10


def test_blocks_of_items_agree(spark, monkeypatch):
    items = [(i, prose(i, 25)) for i in range(8)]
    docs = [(i, f"{prose(90 + i, 10)} {prose(i % 10, 25)}") for i in range(20)] + [(5, prose(5, 25))]
    frames = documents(spark, docs), spark.createDataFrame(items, ITEMS)
    one = sorted(map(tuple, dc.decontaminate(*frames).collect()))
    monkeypatch.setattr(dc, "BLOCK_CHARS", 300)
    assert sorted(map(tuple, dc.decontaminate(*frames).collect())) == one


def test_edges(spark):
    items = spark.createDataFrame([(1, prose(3, 50)), (2, prose(4, 40))], ITEMS)
    got = dc.decontaminate(clashing(documents(spark, EDGES)), clashing(items)).collect()
    assert len(got) == len(EDGES)
    assert sorted((r.doc_id, tuple(r.item_ids)) for r in got if r.contaminated and r.doc_id) == [(10, (1,)), (11, (1,)), (14, (2,))]
    none = spark.createDataFrame([], ITEMS)
    assert not any(r.contaminated for r in dc.decontaminate(documents(spark, EDGES), none).collect())
    assert dc.decontaminate(documents(spark, []).limit(0), items).collect() == []


def test_short_numeric_and_nameless_items(spark):
    """Items of any length are sought: without an error budget, as whole words with their digits."""
    items = [(1, "17 + 25 = 42"), (2, "Quel age?"), (3, "x"), (4, "7"), (5, "+ -"), (6, ""), (7, "漢字 仮名"), (None, "only once here"), (8, "ab " * 12), (9, "Ⅳ 2")]
    items += [(20 + n, prose(600 + n, 5)[:n].strip()) for n in range(1, 40)]
    docs = [(1, "So 17 25, 42!"), (2, "17 25 421"), (3, "quel AGE"), (4, "quel ages"), (5, "a x b"), (6, "axb 77"), (7, "7"), (8, "又 漢字 仮名。"), (9, "Only once, here"), (10, "ab " * 13), (11, "ⅳ 2"), (12, None), (13, "+ -")]
    docs += [(100 + n, f"{prose(n, 3)} {t.upper()}. {prose(n, 2)}") for n, (_, t) in enumerate(items[10:])]
    got = dc.decontaminate(documents(spark, docs), spark.createDataFrame(items, ITEMS)).collect()
    got = sorted((r.doc_id, r.contaminated, r.item_ids, -1 if r.least_distance is None else r.least_distance) for r in got)
    assert got == brute(docs, items, 0.06, dc.LEAST_CHARS)
    clean = {r.doc_id for r in dc.without_items(documents(spark, docs), spark.createDataFrame(items, ITEMS)).collect()}
    assert clean == {d for d, hit, _, _ in got if not hit} and 9 not in clean and 13 in clean


def test_candidates_are_bounded_by_characters(spark, monkeypatch):
    items = [(i, prose(i, 20 + 40 * (i % 3))) for i in range(9)]
    docs = [(i, f"{prose(90 + i, 10)} {prose(i % 12, 20 + 40 * (i % 3))}") for i in range(40)]
    frames = documents(spark, docs), spark.createDataFrame(items, ITEMS)
    one = sorted(map(tuple, dc.decontaminate(*frames).collect()))
    monkeypatch.setattr(dc, "CELLS", 500)
    assert sorted(map(tuple, dc.decontaminate(*frames).collect())) == one


def test_rows_of_files_are_numbered_in_place(spark, tmp_path):
    from costlens.llm import staging

    documents(spark, [(i % 5, prose(i, 4)) for i in range(60)]).repartition(3).write.parquet(f"{tmp_path}/t")
    read = spark.read.parquet(f"{tmp_path}/t")
    for df in (read, read.select("doc_id", F.col("text").cast("string").alias("text")), read.where("doc_id > 0")):
        assert staging._in_files(df) is not None
        rows = staging.numbered(df)
        assert rows.columns == [*df.columns, "__row"]
        assert rows.select("__row").distinct().count() == rows.count() == df.count()
        assert sorted(map(tuple, rows.collect()), key=str) == sorted(map(tuple, rows.repartition(2).collect()), key=str)
    assert staging._in_files(documents(spark, [(1, "a")])) is None
