"""Text / key helpers as native Spark column expressions (no UDFs).

Python's ``str.strip()`` removes every Unicode whitespace character, while
Spark's ``trim`` removes only U+0020; ``trim_ws`` reproduces the former with
one JVM-side regex so the normalisation stays inside whole-stage codegen.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the source system's conventions.
# Characters Python's str.isspace() treats as whitespace beyond Java's
# Unicode White_Space class: the four ASCII separators U+001C..U+001F.
_WS = r"[\s\x{1c}-\x{1f}]"
_EDGE_WS = r"(?U)^" + _WS + r"+|" + _WS + r"+$"
NBSP = " "
NULL_CHAPTER = "None"          # label given to blank / missing chapters
PROJECT_PREFIX = "PY_00"       # prefix of projects derived from a business unit


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_ws(c) -> Column:
    """Strip leading/trailing Unicode whitespace (Python ``str.strip``)."""
    return F.regexp_replace(_col(c).cast("string"), _EDGE_WS, "")


@cache
def _foldings() -> tuple[str, str, dict[str, str]]:
    """Full Unicode case folding, by the rule of ``str.casefold``: the characters that fold, the
    first character of what each becomes, and by what follows it the characters of longer ones."""
    before, after, tails = [], [], {}
    for point in range(0x110000):
        c = chr(point)
        folded = c.casefold()
        if folded != c:
            before.append(c)
            after.append(folded[0])
            if len(folded) > 1:
                tails[folded[1:]] = tails.get(folded[1:], "") + c
    return "".join(before), "".join(after), tails


def casefold(c) -> Column:
    """Full case folding (``str.casefold``) as a native expression. Plain ASCII, told by its
    length in bytes, is lower-cased; in other text the tails of characters that become
    several are inserted behind them, then every character is translated."""
    s = _col(c).cast("string")
    before, after, tails = _foldings()
    insert = F.array(*[F.struct(F.lit(f"([{chars}])").alias("at"), F.lit(f"$1{tail}").alias("with")) for tail, chars in tails.items()])
    longer = F.aggregate(insert, s, lambda text, m: F.regexp_replace(text, m["at"], m["with"]))
    return F.when(F.octet_length(s) == F.char_length(s), F.lower(s)).otherwise(F.translate(longer, before, after))


def normalize_text(c) -> Column:
    """NBSP -> space, strip, case-fold; NULL renders as 'none' like ``str(None)``.

    Meant for few rows (distinct spellings, aggregated keys): see ``operators.spelling``."""
    s = F.coalesce(_col(c).cast("string"), F.lit("None"))
    return casefold(trim_ws(F.regexp_replace(s, NBSP, " ")))


def normalize_chapter(c) -> Column:
    """NULL -> '', strip, '' -> 'None'."""
    return F.coalesce(F.nullif(trim_ws(c), F.lit("")), F.lit(NULL_CHAPTER))


def clean_chapter(c) -> Column:
    """Chapter cleaning done by the summary load: NBSP -> space, then strip."""
    s = F.coalesce(_col(c).cast("string"), F.lit("None"))
    return trim_ws(F.regexp_replace(s, NBSP, " "))


def clean_value(c) -> Column:
    """Sink-side cleaning of text cells: strip, blank -> NULL."""
    return F.nullif(trim_ws(c), F.lit(""))


def is_blank(c) -> Column:
    """NULL or empty after stripping."""
    return F.coalesce(trim_ws(c), F.lit("")) == F.lit("")


def contains_ci(c, token: str) -> Column:
    """Upper-cased text contains ``token`` (upper-case); NULL counts as ''."""
    return F.upper(F.coalesce(_col(c).cast("string"), F.lit(""))).contains(token)


def derive_project(project, unit) -> Column:
    """Blank project -> 'PY_00' + first run of four digits of the business unit.

    No digits (or no unit) gives NULL. ``regexp_extract`` returns '' on no
    match, hence the ``nullif``.
    """
    digits = F.nullif(F.regexp_extract(_col(unit).cast("string"), r"(?U)(\d{4})", 1), F.lit(""))
    derived = F.concat(F.lit(PROJECT_PREFIX), digits)
    return F.when(is_blank(project), derived).otherwise(_col(project))
