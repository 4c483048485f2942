from costlens.functions.text import (
    trim_ws,
    normalize_text,
    normalize_chapter,
    clean_chapter,
    clean_value,
    is_blank,
    derive_project,
    contains_ci,
)
from costlens.functions.money import DEC, PCT, round_money, clamp_pct
from costlens.functions.dates import as_date, as_ts, in_window

__all__ = [
    "trim_ws", "normalize_text", "normalize_chapter", "clean_chapter", "clean_value",
    "is_blank", "derive_project", "contains_ci",
    "DEC", "PCT", "round_money", "clamp_pct",
    "as_date", "as_ts", "in_window",
]
