"""All earlier-later pairs of a ranked table, grouped without forming any pair.

Two different ranks first differ in exactly one binary digit.  Rows grouped by
(digit, leading digits) therefore hold every pair of different ranks in exactly
one group: the earlier row has a 0 at that digit, the later one a 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def digit_groups(df: DataFrame, ranks: int, rank: str = "_rank") -> DataFrame:
    """Repeat every row once per binary digit of the largest rank.

    Adds ``_digit`` and ``_head`` (the group) and ``_bit`` (0 earlier, 1 later).
    """
    digits = F.sequence(F.lit(0), F.lit(max(ranks.bit_length() - 1, 0)))
    return (
        df.withColumn("_digit", F.explode(digits))
        .withColumn("_bit", F.expr(f"shiftright({rank}, _digit) & 1"))
        .withColumn("_head", F.expr(f"shiftright({rank}, _digit + 1)"))
    )
