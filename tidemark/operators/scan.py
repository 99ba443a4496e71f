"""Running totals and ranks that never put a whole ordered table in one task.

A window ordered over all rows sends them to a single task.  Here the ordered
axis is cut into bins first: every bin runs its own window, one small row per
(key, bin) carries the offsets, and a join on (key, bin) adds them back.
Inputs are aggregated to one row per (keys, order value) beforehand, so a value
shared by a third of all rows is one row here.

The aggregated input is materialised once in the checkpoint folder, because
cutting, scanning and offsets all read it; a lost executor then costs a re-read
instead of a second pass over the raw table.  Its row count decides the path:
a small table (months, rounded scores) is scanned by one window as it is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.runtime import cut_lineage

# Aggregated rows up to which a plain window is used.
FEW_ROWS = 100_000
ROWS_PER_BIN = 50_000
MAX_BINS = 4096
#: Hex digits of the hash that name a bin of a stratum: 65,536 bins.
HASH_DIGITS = 4


def materialise(df: DataFrame) -> tuple[DataFrame, int]:
    """Checkpoint an aggregated table and count it."""
    table = cut_lineage(df)
    return table, table.count()


def _with_bin(df: DataFrame, order: str, rows: int) -> DataFrame:
    bins = max(2, min(MAX_BINS, -(-rows // ROWS_PER_BIN)))
    cuts = [i / bins for i in range(1, bins)]
    edges = sorted(set(df.approxQuantile(order, cuts, 0.25 / bins)))
    # Position of the value among the edges by binary search would need a UDF;
    # splitting the edges in two levels keeps the comparison count low.
    width = max(1, int(len(edges) ** 0.5))
    blocks = [edges[i : i + width] for i in range(0, len(edges), width)]
    block = F.array(*[F.array(*[F.lit(float(e)) for e in part]) for part in blocks])
    firsts = F.array(*[F.lit(float(part[0])) for part in blocks])
    value = F.col(order).cast("double")
    return (
        df.withColumn("_block", F.size(F.filter(firsts, lambda e: e < value)))
        .withColumn(
            "_bin",
            F.when(F.col("_block") == 0, F.lit(0)).otherwise(
                (F.col("_block") - 1) * width
                + F.size(F.filter(F.get(block, F.col("_block") - 1), lambda e: e < value))
            ),
        )
        .drop("_block")
    )


def _null_safe(keys: Sequence[str]) -> Column:
    condition = F.col("l._bin") == F.col("r._bin")
    for key in keys:
        condition = condition & F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}"))
    return condition


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    sums: Sequence[str] = (),
    products: Sequence[str] = (),
    lasts: Sequence[str] = (),
    descending: bool = False,
    rows: int | None = None,
    few: int | None = None,
) -> DataFrame:
    """Add inclusive running sums, products and last-seen values along ``order``.

    ``df`` holds one row per (keys, order).  New columns are ``<name>_run``.
    ``lasts`` carries the most recent non-null value forward.  ``rows`` is the
    row count if the caller has materialised the table already.  Cost beyond
    ``few`` rows: one shuffle on (keys, bin), plus one row per (key, bin).
    """
    keys = list(keys)
    few = FEW_ROWS if few is None else few
    if rows is None:
        df, rows = materialise(df)
    axis = F.col(order).desc() if descending else F.col(order).asc()

    def scanned(table: DataFrame, inside) -> DataFrame:
        return table.select(
            "*",
            *[F.sum(c).over(inside).alias(f"{c}_run") for c in sums],
            *[F.product(F.col(c)).over(inside).alias(f"{c}_run") for c in products],
            *[F.last(c, ignorenulls=True).over(inside).alias(f"{c}_run") for c in lasts],
        )

    if rows <= few:
        return scanned(df, W.partitionBy(*keys).orderBy(axis).rowsBetween(W.unboundedPreceding, 0))

    binned = _with_bin(df, order, rows)
    inside = W.partitionBy(*keys, "_bin").orderBy(axis).rowsBetween(W.unboundedPreceding, 0)
    bin_axis = F.col("_bin").desc() if descending else F.col("_bin").asc()
    before = W.partitionBy(*keys).orderBy(bin_axis).rowsBetween(W.unboundedPreceding, -1)
    pick = F.min_by if descending else F.max_by
    totals = binned.groupBy(*keys, "_bin").agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.sum(c).alias(f"{c}_bin") for c in sums],
        *[F.product(F.col(c)).alias(f"{c}_bin") for c in products],
        *[
            pick(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"{c}_bin")
            for c in lasts
        ],
    )
    offsets = totals.select(
        *keys,
        "_bin",
        *[F.coalesce(F.sum(f"{c}_bin").over(before), F.lit(0)).alias(f"{c}_off") for c in sums],
        *[
            F.coalesce(F.product(F.col(f"{c}_bin")).over(before), F.lit(1.0)).alias(f"{c}_off")
            for c in products
        ],
        *[F.last(f"{c}_bin", ignorenulls=True).over(before).alias(f"{c}_off") for c in lasts],
    )
    joined = scanned(binned, inside).alias("l").join(offsets.alias("r"), _null_safe(keys), "inner")
    return joined.select(
        *[F.col(f"l.{c}") for c in df.columns],
        *[(F.col(f"l.{c}_run") + F.col(f"r.{c}_off")).alias(f"{c}_run") for c in sums],
        *[(F.col(f"l.{c}_run") * F.col(f"r.{c}_off")).alias(f"{c}_run") for c in products],
        *[F.coalesce(f"l.{c}_run", f"r.{c}_off").alias(f"{c}_run") for c in lasts],
    )


def affine(
    df: DataFrame, keys: Sequence[str], order: str, bins: Column, slope: Column, shift: Column, start: Column, carry: Sequence[str] = (),
) -> DataFrame:
    """The state before each row of a chain s -> slope * s + shift, which starts at the first row's ``start``.

    ``bins`` numbers runs of rows in the order of ``order``.  Maps compose, so
    every bin becomes one map on its own, the maps of a series are composed
    from one small row per bin, and each row's state follows from the two.
    ``df`` holds one row per (keys, order).  Output: keys, order, ``carry``,
    ``state`` and ``position`` (from 0).
    """
    keys = list(keys)
    entry = F.struct(F.col(order), slope.alias("_a"), shift.alias("_b"), start.alias("_s"), *carry)
    binned = df.groupBy(*keys, bins.alias("_bin")).agg(F.array_sort(F.collect_list(entry)).alias("_rows"))
    map_of = lambda a, b: F.struct(a.alias("a"), b.alias("b"))
    then = lambda m, a, b: map_of(m["a"] * a, a * m["b"] + b)
    inside = F.aggregate(
        "_rows", F.array(map_of(F.lit(1.0), F.lit(0.0))), lambda maps, r: F.concat(maps, F.array(then(F.element_at(maps, -1), r["_a"], r["_b"])))
    )
    held = cut_lineage(binned.withColumn("_maps", inside))
    whole = F.element_at("_maps", -1)
    one = F.struct("_bin", whole["a"].alias("a"), whole["b"].alias("b"), F.size("_rows").alias("n"), F.col("_rows")[0]["_s"].alias("s"))
    chains = held.groupBy(*keys).agg(F.array_sort(F.collect_list(one)).alias("_chain"))
    first = F.struct(F.lit(1.0).alias("a"), F.lit(0.0).alias("b"), F.lit(0).alias("n"))

    def join_bin(before: Column, r: Column) -> Column:
        last = F.element_at(before, -1)
        return F.concat(before, F.array(F.struct((last["a"] * r["a"]).alias("a"), (r["a"] * last["b"] + r["b"]).alias("b"), (last["n"] + r["n"]).alias("n"))))

    before = F.aggregate("_chain", F.array(first), join_bin)
    offsets = chains.select(*keys, F.col("_chain")[0]["s"].alias("_start"), F.explode(F.arrays_zip(F.col("_chain._bin").alias("_bin"), F.slice(before, F.lit(1), F.size("_chain")).alias("_off"))).alias("_at"))
    offsets = offsets.select(*keys, "_start", "_at._bin", "_at._off")
    joined = held.alias("l").join(offsets.alias("r"), _null_safe(keys)).select(
        *[F.col(f"l.{c}") for c in keys], "r._start", "r._off", F.posexplode(F.arrays_zip("_rows", F.slice("_maps", F.lit(1), F.size("_rows")).alias("_map"))).alias("_i", "_each")
    )
    entering = F.col("_off.a") * F.col("_start") + F.col("_off.b")
    return joined.select(
        *keys, F.col(f"_each._rows.{order}").alias(order), *[F.col(f"_each._rows.{c}").alias(c) for c in carry],
        (F.col("_each._map.a") * entering + F.col("_each._map.b")).alias("state"), (F.col("_off.n") + F.col("_i")).alias("position"),
    )


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probabilities: Sequence[float],
    few: int | None = None,
) -> DataFrame:
    """Linearly interpolated quantiles per key, from running counts.

    ``quantiles`` is an array in the order of ``probabilities``, ``n`` the
    number of non-null values.  No task ever holds the values of a whole key:
    the neighbours of each wanted position are found by their running count.
    """
    keys = list(keys)
    counts, rows = materialise(
        df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_k"))
    )
    ranked = running(counts, keys, value, sums=["_k"], rows=rows, few=few)
    if keys:
        # One row per key on the right-hand side.
        ranked = ranked.join(counts.groupBy(*keys).agg(F.sum("_k").alias("_n")), keys, "inner")
    else:
        ranked = ranked.withColumn("_n", F.lit(counts.agg(F.sum("_k")).first()[0] or 0))
    picks = []
    for i, p in enumerate(probabilities):
        at = (F.col("_n") - 1) * F.lit(float(p))
        low = F.floor(at)
        picks += [
            F.min(F.when(F.col("_k_run") >= low + 1, F.col(value))).alias(f"_lo{i}"),
            F.min(F.when(F.col("_k_run") >= F.ceil(at) + 1, F.col(value))).alias(f"_hi{i}"),
            F.max(at - low).alias(f"_w{i}"),
        ]
    found = ranked.groupBy(*keys).agg(F.max("_n").alias("n"), *picks)
    parts = [
        F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_w{i}")
        for i in range(len(probabilities))
    ]
    return found.select(*keys, "n", F.array(*parts).alias("quantiles"))


def shuffle_key(id_column: str | Column, seed: int) -> Column:
    """A reproducible pseudo-random string per row, the same in any SQL engine."""
    id_column = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.md5(F.concat(id_column.cast("string"), F.lit(f":{seed}")))


def shuffled_rank(
    df: DataFrame, strata: Sequence[str], id_column: str, seed: int, rank: str = "rank",
    size: str | None = None, total: str | None = None, digits: int = HASH_DIGITS,
) -> DataFrame:
    """Number the rows of each stratum 1..n in a reproducible random order.

    The hash is uniform, so its first ``digits`` hex digits cut every stratum
    into 16 ** digits even bins; a stratum with most of the table is still
    spread over them.  The ranks do not depend on the number of digits.
    ``size`` and ``total`` name optional columns with the row counts of the
    stratum and of the whole.
    """
    strata = list(strata)
    keyed = df.withColumn("_hash", shuffle_key(id_column, seed)).withColumn(
        "_bin", F.substring("_hash", 1, digits)
    )
    inside = W.partitionBy(*strata, "_bin").orderBy("_hash", id_column)
    before = W.partitionBy(*strata).orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)
    counts = keyed.groupBy(*strata, "_bin").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        *strata, "_bin",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        F.sum("_n").over(W.partitionBy(*strata)).alias("_size"),
    )
    if total:
        offsets = offsets.withColumn("_total", counts.agg(F.sum("_n")).scalar())
    local = keyed.withColumn("_local", F.row_number().over(inside))
    joined = local.alias("l").join(offsets.alias("r"), _null_safe(strata), "inner")
    extra = [F.col("r._size").alias(size)] if size else []
    extra += [F.col("r._total").alias(total)] if total else []
    return joined.select(
        *[F.col(f"l.{c}") for c in df.columns],
        (F.col("l._local") + F.col("r._offset")).cast("bigint").alias(rank),
        *extra,
    )
