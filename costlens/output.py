"""Output-edge conversions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Money is DECIMAL inside every plan and DOUBLE at the output edge."""
    return df.select(*[
        F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])
