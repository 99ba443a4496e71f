"""Vector codes: integer codebooks per part, learnt with anchors-hierarchy trees that are built once.

Each task turns its rows into blocks of up to ``BLOCK_ROWS`` vectors and
builds one metric tree per part.  The trees are written to the shared folder
once.  A round sends the codebooks (``PARTS * ENTRIES`` entries, whatever the
rows) to all trees, adds counts and sums per entry, and divides.  All
arithmetic is in integers, so neither blocks nor tasks change a result.
"""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import anchors
from tidemark.llm.vectors import finite, longest, matrix
from tidemark.runtime import cut_lineage

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
BLOCK_ROWS = 2048
#: Integer components beyond this are held at it: squares and sums then stay exact in 64 bits.
MOST = 1 << 26


def integers(column: pa.Array, width: int) -> np.ndarray:
    """floor(SCALE * x) of each component, in (PARTS, rows, components of a part)."""
    whole = np.clip(np.floor(matrix(column, width) * SCALE), -MOST, MOST).astype(np.int64)
    each = -(-width // PARTS) or 1
    out = np.zeros((len(whole), PARTS * each), np.int64)
    out[:, :width] = whole
    return out.reshape(len(whole), PARTS, each).transpose(1, 0, 2)


def usable(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", label: str = "label") -> DataFrame:
    """vec_id, label and vector of the rows whose vector is not null and holds only finite components."""
    return vectors.select(F.col(key).alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vector")).where(finite("vector"))


def forest(rows: DataFrame, width: int) -> DataFrame:
    """One row per block of vectors: ids, labels and the trees of all parts; kept in the shared folder."""

    def grown(batch: pa.RecordBatch):
        for lo in range(0, len(batch), BLOCK_ROWS):
            block = batch.slice(lo, BLOCK_ROWS)
            trees = [anchors.build(part) for part in integers(block.column(2), width)]
            held = [pa.ListArray.from_arrays(pa.array([0, len(block)], pa.int32()), block.column(i)) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*held, pa.array([pickle.dumps(trees)], pa.binary())], names=["vec_id", "label", "trees"])

    def batches(stream):
        waiting: list[pa.RecordBatch] = []
        for batch in stream:
            waiting.append(batch)
            if sum(map(len, waiting)) >= BLOCK_ROWS:
                whole = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
                full = len(whole) // BLOCK_ROWS * BLOCK_ROWS
                yield from grown(whole.slice(0, full))
                waiting = [whole.slice(full)]
        if sum(map(len, waiting)):
            yield from grown(pa.Table.from_batches(waiting).combine_chunks().to_batches()[0])

    kinds = dict(rows.dtypes)
    return cut_lineage(rows.mapInArrow(batches, f"vec_id array<{kinds['vec_id']}>, label array<{kinds['label']}>, trees binary"))


def seeds(rows: DataFrame, width: int) -> np.ndarray:
    """The parts of the vectors with the smallest ids, ties in the order of the vectors, null ids last."""
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(ENTRIES).select("vector").toArrow()
    return integers(first["vector"].combine_chunks(), width)


def step(trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round; an entry that no part is nearest to stays."""
    _, entries, each = books.shape

    def counted(stream):
        count, sums = np.zeros((PARTS, entries), np.int64), np.zeros((PARTS, entries, each), np.int64)
        for batch in stream:
            for blob in batch.column(0):
                for part, tree in enumerate(pickle.loads(blob.as_py())):
                    n, s = anchors.totals(tree, books[part])
                    count[part] += n
                    sums[part] += s
        part, entry = np.nonzero(count)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * each, pa.int32()), pa.array(sums[part, entry].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(entry), pa.array(count[part, entry]), lists], names=["part", "entry", "n", "sums"])

    partial = trees.select("trees").mapInArrow(counted, "part long, entry long, n long, sums array<long>")
    total = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(each)]).alias("sums"))
    out = books.copy()
    for row in total.collect():  # at most PARTS * ENTRIES rows
        out[row.part, row.entry] = np.array(row.sums) // row.n
    return out


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and position, with commas between."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def learn(rows: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """The trees of usable rows and the codebooks after all rounds."""
    width = longest(rows, "vector")
    trees, books = forest(rows, width), seeds(rows, width)
    for _ in range(ROUNDS):
        books = step(trees, books)
    return trees, books


def encode(trees: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code and error of every row of the trees."""
    schema = trees.schema
    kinds = [schema[c].dataType.elementType.simpleString() for c in ("vec_id", "label")]

    def coded(stream):
        for batch in stream:
            ids, labels = batch.column(0), batch.column(1)
            for i in range(len(batch)):
                found = [anchors.assign(tree, books[part]) for part, tree in enumerate(pickle.loads(batch.column(2)[i].as_py()))]
                code = np.stack([f[0] for f in found], 1).astype(np.uint8).tobytes().hex()
                codes = [code[2 * PARTS * j : 2 * PARTS * (j + 1)] for j in range(len(found[0][0]))]
                yield pa.RecordBatch.from_arrays([ids[i].values, labels[i].values, pa.array(codes), pa.array(sum(f[1] for f in found))], names=["vec_id", "label", "code", "error"])

    return trees.mapInArrow(coded, f"vec_id {kinds[0]}, label {kinds[1]}, code string, error long")


def compress(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", label: str = "label") -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every usable row.

    Rows whose vector is null or holds a null or not finite component go; a
    vector of zeros or without components stays.  Shorter vectors, and lengths
    that ``PARTS`` doesn't divide, count as if filled up with zeros.  Null ids
    and repeated rows are rows like others; null labels are one label.  With
    fewer than ``ENTRIES`` rows each part has as many entries as rows.  An
    empty table gives an empty result.
    """
    rows = usable(vectors, vector, key, label)
    trees, books = learn(rows)
    coded = cut_lineage(encode(trees, books))
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "same")
    joined = coded.join(totals, F.col("label").eqNullSafe(F.col("same")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
