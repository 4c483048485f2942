"""Money and percentage arithmetic.

Amounts are summed as DECIMAL so that results do not depend on summation
order (partitioning), rounded half-up to cents, and converted to DOUBLE only
at the output edge.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

DEC = DecimalType(18, 6)      # canonical amount type of every source
CENTS = DecimalType(18, 2)    # project totals before multiplying by a percentage
PCT = DecimalType(10, 8)      # a fraction in [0, 1]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """Coerce to the canonical amount type; unparsable -> NULL."""
    return _col(c).try_cast(DEC)


def round_money(c) -> Column:
    return F.round(_col(c), 2)


def clamp_pct(raw) -> Column:
    """Percentage given 'per hundred' (8 -> 0.08), clipped to [0, 1], NULL -> 0."""
    frac = money(raw) * F.lit(0.01).cast(DecimalType(3, 2))
    clipped = F.least(F.greatest(frac, F.lit(0).cast(PCT)), F.lit(1).cast(PCT))
    return F.coalesce(clipped, F.lit(0)).cast(PCT)
