"""Frame helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def evaluated(df: DataFrame) -> DataFrame:
    """The same rows, with their columns fixed at this point of the plan.

    Spark copies a column's expression into every filter on it, so filtering on an expensive
    result computes it twice. Filters on the output of a generator stay behind it; this is a
    generator of exactly one row.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))
