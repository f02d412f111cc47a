"""Plan-shape helpers shared by operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fence(df: DataFrame) -> DataFrame:
    """Pass rows through a one-row generator (``inline`` of a one-element
    array). Catalyst pushes a filter through a projection by inlining the
    projected expressions into the filter, so a filter on a parsed JSON
    field would parse (or serialise) every row once more. A predicate on a
    generator's output cannot be pushed below it, so the expensive
    expressions above run once per row. Whole-stage codegen is kept."""
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))
