"""A bounded sample of labelled documents, and rows that no model learns from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bound of the sample that a classifier is fitted on.
MOST_ROWS = 8_000


def held_out(modulus: int, remainder: int, key: str = "doc_id"):
    """True where crc32 of the id as text leaves ``remainder``; a null id is never held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(modulus)) == remainder, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, remainder: int, most: int = MOST_ROWS, text: str = "text") -> DataFrame:
    """(doc_id, place, label, text) of at most about ``most`` labelled rows outside the held-out part.

    Both classes get half of the bound, and a class with fewer rows is taken
    whole.  Rows are taken by the hash of the id, so any run takes the same
    ones.  The ids are bounded by ``most``, hence the broadcast.  Null ids and
    null labels are left out; an id labelled twice counts once per label, and
    of rows with the same id the smallest text is taken.
    """
    usable = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & F.col("_id").isNotNull() & ~held_out(modulus, remainder, "_id")
    ).distinct()
    counts = {r["label"]: r["count"] for r in usable.groupBy("label").count().collect()}
    place = F.pmod(F.xxhash64("_id", F.lit(label)), F.lit(1 << 30))
    wanted = F.lit(0.0)
    for value, n in counts.items():
        wanted = F.when(F.col("label") == value, F.lit(min(1.0, most / 2 / n))).otherwise(wanted)
    chosen = usable.withColumn("place", place).where(F.col("place") < wanted * float(1 << 30))
    kept = docs.select(F.col("doc_id").alias("_doc"), F.col(text).alias("text"))
    taken = kept.join(F.broadcast(chosen), F.col("_doc") == F.col("_id"))
    return taken.groupBy(F.col("_id").alias("doc_id"), "place", "label").agg(F.min("text").alias("text"))
