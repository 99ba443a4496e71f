"""Scalar helpers shared by the reports: guarded ratios, buckets, category codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields NULL where the divisor is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def right_closed_bucket(value: Column, edges: Sequence, labels: Sequence[str]) -> Column:
    """Label of the right-closed interval holding ``value``.

    ``edges`` are the inner cuts in ascending order (numbers or columns); the
    first label takes everything up to and including the first cut, the last
    one everything above the last cut.  NULL stays NULL.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("one more label than inner edges is needed")
    branch = F.when(value.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        branch = branch.when(value <= (edge if isinstance(edge, Column) else F.lit(edge)), label)
    return branch.otherwise(labels[-1])


def code_for(value: Column, codes: dict[str, int]) -> Column:
    """Fixed category codes as a CASE; unknown categories become NULL."""
    branch = None
    for category, code in codes.items():
        hit = value == F.lit(category)
        branch = F.when(hit, F.lit(float(code))) if branch is None else branch.when(
            hit, F.lit(float(code))
        )
    return branch


