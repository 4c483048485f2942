"""Small document tables for the operator tests."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use or return: a table may bring columns of these names.
CLASHES = ("kept", "component_id", "shard", "slot", "size", "copy", "position", "score", "id", "v", "n", "label", "key")

WORDS = [a + b for a in ("ba", "do", "ri", "mu", "ke", "lo", "sa", "ti") for b in ("ran", "lek", "mos", "pid", "fu", "gar")]


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edited(text: str, seed: int, edits: int) -> str:
    rng = random.Random(seed)
    words = text.split(" ")
    for i in rng.sample(range(len(words)), edits):
        words[i] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def documents(spark, rows):
    """Rows of (doc_id, text[, lang[, source]])."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src0", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def clashing(df):
    """The table with extra columns named as the operators' own."""
    return df.withColumns({c: F.lit("x") for c in CLASHES if c not in df.columns})


EDGES = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "One"), (6, "a b c d e"), (7, "a b c d e"), (7, "a b c d e"),
    (8, "漢字 仮名 交じり 文 です"), (9, "😀 😀 😀 😀 😀 😀"), (10, prose(3, 30_000)), (11, prose(3, 30_000)), (None, prose(4, 40)), (None, None),
    (12, "x" * 200_000), (13, "!!! ??? ***"), (14, prose(4, 40), None, None),
]
