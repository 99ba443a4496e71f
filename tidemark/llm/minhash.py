"""Near-duplicate groups by b-bit MinHash: bands find candidates, bit counts rank them, full sets decide.

1. Each text becomes its set of hashed shingles, a fingerprint of the set,
   ``BANDS * ROWS`` minima, hashes of the bands of minima, and a signature of
   the two lowest bits of each minimum, packed into 64-bit words.
2. Texts with the same set are one class, named by the smallest id.  Only
   class names go on, so thousands of exact copies cost one row each.
3. Names that share a band are candidates.  Every name meets the smallest name
   of its buckets first.  Afterwards only buckets whose names are still in
   several components are looked at, and all pairs of different components in
   them are compared inside tasks, block by block.
4. Bits that agree by chance are taken out of the estimate; pairs whose
   estimate is more than ``SLACK`` under the threshold go, and the full sets
   decide about the rest.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import components
from tidemark.llm import textbytes as tb
from tidemark.runtime import cut_lineage

THRESHOLD = 80
BANDS, ROWS = 32, 5
PLACES = BANDS * ROWS
#: Low bits of each minimum in the signature, and 64-bit words that hold them.
BITS, WORDS = 2, 5
#: Over five standard deviations of the estimate at a similarity of 0.8.
SLACK = 0.2
#: Sets with fewer members are always compared in full: their estimate is too rough.
ROUGH = 64
#: Names of a bucket that one side of a cell holds, in the mean.
BLOCK = 256
#: Bits of the field of wanted ids that documents are held against before their sets are made.
FIELD_BITS = 22


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int, hasher: tb.Hasher, word: np.ndarray):
    """Hashes of all shingles in order of rows, and the edges of each row; a text with fewer words is one shingle."""
    starts, ends = tb.spans(word[data], offsets)
    row, edges = tb.owner(starts, offsets), np.searchsorted(starts, offsets)
    hashed = hasher.spans(tb.lower_ascii(data), starts, ends)
    n = max(len(hashed) - words + 1, 0)
    total = np.zeros(n, np.uint64)
    for k in range(words):
        total = tb.mix(total + hashed[k : k + n] + np.uint64(k + 1))
    inside = row[:n] == row[words - 1 : words - 1 + n]
    shingle, owner = total[inside], row[:n][inside]
    size = np.diff(edges)
    short = np.flatnonzero((size > 0) & (size < words))
    if len(short):
        add = lambda t, h: tb.mix(t * np.uint64(3) + h + np.uint64(1))
        whole = [reduce(add, hashed[edges[i] : edges[i + 1], None], np.full(1, size[i], np.uint64))[0] for i in short]
        shingle, owner = np.concatenate([shingle, np.array(whole, np.uint64)]), np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        shingle, owner = shingle[order], owner[order]
    return shingle, np.searchsorted(owner, np.arange(len(offsets)))


class Sketcher:
    """Minima of sets by one permutation: a hash says the place of a shingle and its rank there.

    An empty place borrows from the first filled one in an order of its own,
    which is the same for all sets, so sets of any size have all minima.
    """

    def __init__(self, words: int):
        self.words, self.hasher = words, tb.Hasher()
        self.word = ~tb.byte_table(tb.WHITE)
        rng = np.random.default_rng(20240229)
        self.order = np.stack([rng.permutation(PLACES) for _ in range(PLACES)], 1).astype(np.int16)
        self.bounds = ((np.arange(PLACES + 1, dtype=object) << 64) // PLACES)[:-1].astype(np.uint64)
        self.shift = (BITS * (np.arange(WORDS * 64 // BITS) % (64 // BITS))).astype(np.uint64)

    def minima(self, ordered: np.ndarray) -> np.ndarray:
        first = np.searchsorted(ordered, self.bounds)
        filled = np.append(first[1:], len(ordered)) > first
        empty = np.flatnonzero(~filled)
        out = ordered[np.minimum(first, len(ordered) - 1)]
        for lo, hi in ((0, 8), (8, PLACES)):
            if len(empty):
                found = filled[self.order[lo:hi, empty]]
                which, hit = found.argmax(0), found.any(0)
                out[empty[hit]] = out[self.order[lo + which[hit], empty[hit]]]
                empty = empty[~hit]
        return out

    def __call__(self, data: np.ndarray, offsets: np.ndarray):
        shingle, edges = shingle_sets(data, offsets, self.words, self.hasher, self.word)
        n = len(offsets) - 1
        size, prints, least = np.zeros(n, np.int64), np.zeros((n, 2), np.uint64), np.zeros((n, PLACES), np.uint64)
        for i in np.flatnonzero(np.diff(edges)):
            own = np.unique(shingle[edges[i] : edges[i + 1]])
            size[i] = len(own)
            prints[i] = own.sum(), tb.mix(own ^ np.uint64(tb.BASE)).sum()
            least[i] = self.minima(own)
        total = np.zeros((n, BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
        for k in range(ROWS):
            total = tb.mix(total * np.uint64(5) + least[:, k::ROWS])
        lanes = np.zeros((n, WORDS * 64 // BITS), np.uint64)
        lanes[:, :PLACES] = least & np.uint64((1 << BITS) - 1)
        packed = np.bitwise_or.reduce((lanes << self.shift).reshape(n, WORDS, -1), 2)
        as_lists = lambda m: pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * m.shape[1], pa.int32()), pa.array(m.ravel().view(np.int64)))
        return [size, prints[:, 0].copy().view(np.int64), prints[:, 1].copy().view(np.int64), as_lists(packed), as_lists(total)]


def sketch(docs: DataFrame, words: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, two halves of the set's fingerprint, signature and band hashes of every row."""
    maker = None

    def run(data, offsets):
        nonlocal maker
        maker = maker or Sketcher(words)
        return maker(data, offsets)

    named = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return tb.score_rows(named, ["doc_id"], "text", run, "n_shingles long, print_a long, print_b long, signature array<long>, bands array<long>")


def sets_of(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """doc_id and the distinct shingle hashes of the rows of (doc_id, text) whose id is wanted.

    A bit field of the wanted ids goes to every task, so that of a large table
    only the sets of few documents are made and shuffled; the join is exact.
    """
    place = F.xxhash64("doc_id")
    field = tb.bit_field(wanted.select(place.alias("h")), "h", FIELD_BITS)

    def batches(stream):
        hasher, word = tb.Hasher(), ~tb.byte_table(tb.WHITE)
        for batch in stream:
            batch = batch.filter(pa.array(tb.in_field(batch.column(2).to_numpy(), field, FIELD_BITS)))
            for lo, hi, data, offsets in tb.text_runs(batch.column(1)):
                shingle, edges = shingle_sets(data, offsets, words, hasher, word)
                sets = pa.array([np.unique(shingle[a:b]).view(np.int64) for a, b in zip(edges[:-1], edges[1:])], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), sets], names=["doc_id", "members"])

    kind = dict(docs.dtypes)["doc_id"]
    held = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text", place.alias("h"))
    return held.mapInArrow(batches, f"doc_id {kind}, members array<long>").join(wanted, "doc_id", "left_semi")


def estimate(left: str, right: str):
    """Similarity from two signatures: equal lanes by bit counts, less those equal by chance."""
    low = F.lit(0x5555555555555555).cast("long")
    apart = None
    for k in range(WORDS):
        x = F.col(left)[k].bitwiseXOR(F.col(right)[k])
        count = F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(low))
        apart = count if apart is None else apart + count
    chance = 1.0 / (1 << BITS)
    return (1 - apart / PLACES - chance) / (1 - chance)


def promising(pairs: DataFrame, names: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) whose estimate does not speak against them, with the estimate."""
    side = lambda c: names.select(F.col("doc_id").alias(c), F.col("n_shingles").alias(f"n{c}"), F.col("signature").alias(f"s{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    fits = 100 * F.least("na", "nb") >= threshold * F.greatest("na", "nb")
    rough = F.least("na", "nb") < ROUGH
    return both.withColumn("near", estimate("sa", "sb")).where(fits & (rough | (F.col("near") >= threshold / 100 - SLACK))).select("a", "b", "near")


def confirmed(pairs: DataFrame, docs: DataFrame, words: int, threshold: int) -> DataFrame:
    """Pairs (a, b) whose full sets reach the threshold: 100 * common >= threshold * union."""
    wanted = cut_lineage(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    sets = sets_of(docs, wanted, words)
    side = lambda c: sets.select(F.col("doc_id").alias(c), F.col("members").alias(f"m{c}"))
    common = F.size(F.array_intersect("ma", "mb"))
    union = F.size("ma") + F.size("mb") - F.col("common")
    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").withColumn("common", common)
    return both.where(F.lit(100) * F.col("common") >= F.lit(threshold) * union).select("a", "b").distinct()


def _open(buckets: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows (h, name, found) of the buckets whose names are in several components."""
    held = buckets.select("h", "name").join(groups.select(F.col("node").alias("name"), F.col("component").alias("found")), "name", "left")
    held = held.withColumn("found", F.coalesce("found", "name"))
    sizes = held.groupBy("h").agg(F.min("found").alias("lo"), F.max("found").alias("hi"))
    return cut_lineage(held.join(sizes.where(F.col("lo") != F.col("hi")).select("h"), "h"))


CELL = ["h", "kind", "low", "high"]


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows (cell, name, found): every pair of a bucket in different components meets in a cell.

    Names of a bucket's largest component need not meet each other.  They and
    the others are cut into blocks of about ``BLOCK`` by a hash; the others
    meet in a triangle of blocks (kind 0) and each of their blocks meets each
    block of the largest component (kind 1), so a bucket of any size is spread
    over tasks and no cell grows with it.
    """
    parts = rows.groupBy("h", "found").agg(F.count("*").alias("k"))
    main = parts.groupBy("h").agg(F.max_by("found", F.struct("k", "found")).alias("main"), F.max("k").alias("most"), F.sum("k").alias("m"))
    blocks = lambda n: F.greatest(F.ceil(n / BLOCK), F.lit(1)).cast("int")
    held = rows.join(main, "h").withColumns({"_main": blocks(F.col("most")), "_rest": blocks(F.col("m") - F.col("most"))})
    inside = F.col("found") == F.col("main")
    held = held.withColumn("_own", F.pmod(F.xxhash64("name"), F.when(inside, F.col("_main")).otherwise(F.col("_rest"))).cast("int"))
    cell = lambda kind, low, high: F.struct(F.lit(kind).alias("kind"), low.alias("low"), high.alias("high"))
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    as_main = F.transform(upto(F.col("_rest")), lambda i: cell(1, i, F.col("_own")))
    as_rest = F.concat(
        F.transform(upto(F.col("_main")), lambda j: cell(1, F.col("_own"), j)),
        F.transform(upto(F.col("_rest")), lambda x: cell(0, F.least(F.col("_own"), x), F.greatest(F.col("_own"), x))),
    )
    return held.withColumn("_cell", F.explode(F.when(inside, as_main).otherwise(as_rest))).select("h", "_cell.*", "name", "found")


def _codes(column: pa.ChunkedArray) -> np.ndarray:
    """Equal values as equal numbers."""
    return column.combine_chunks().dictionary_encode().indices.to_numpy()


def _near_rows(threshold: int):
    """Of the sorted rows of cells: those with a pair that may be linked, in the first band that the pair shares."""

    def rows_of(cell: pa.Table) -> np.ndarray:
        fixed = lambda name, width: cell[name].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, width)
        found, size, lanes = _codes(cell["found"]), cell["n_shingles"].to_numpy(), fixed("signature", WORDS)
        need = np.zeros(len(found), bool)
        for lo in range(0, len(found), 64):
            x = lanes[lo : lo + 64, None] ^ lanes[None]
            apart = np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(0x5555555555555555)).sum(2, dtype=np.int64)
            chance = 1.0 / (1 << BITS)
            near = (1 - apart / PLACES - chance) / (1 - chance)
            small, large = np.minimum(size[lo : lo + 64, None], size), np.maximum(size[lo : lo + 64, None], size)
            fits = (found[lo : lo + 64, None] != found) & (100 * small >= threshold * large) & ((small < ROUGH) | (near >= threshold / 100 - SLACK))
            i, j = np.nonzero(fits)
            if len(i):
                bands = fixed("bands", BANDS)
                shared = bands[i + lo] == bands[j]
                first = bands[j, shared.argmax(1)]
                mine = shared.any(1) & (first == cell["h"].to_numpy()[:1].view(np.uint64))
                need[i[mine] + lo] = need[j[mine]] = True
        return need

    def run(stream):
        kept = [*CELL, "name", "found"]
        for cell in _cells(stream):
            if len(cell) > 1:
                need = rows_of(cell)
                if need.any():
                    yield from cell.select(kept).filter(pa.array(need)).combine_chunks().to_batches()

    return run


def _cells(stream):
    """The cells of a stream of batches that is sorted by cell, whole."""
    waiting: list[pa.RecordBatch] = []
    for batch in stream:
        if not len(batch):
            continue
        keys = np.stack([batch.column(i).to_numpy() for i in range(len(CELL))])
        edges = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
        for lo, hi in zip([0, *edges], [*edges, len(batch)]):
            part = batch.slice(lo, hi - lo)
            if waiting and any(waiting[-1].column(i)[-1] != part.column(i)[0] for i in range(len(CELL))):
                yield pa.Table.from_batches(waiting)
                waiting = []
            waiting.append(part)
    if waiting:
        yield pa.Table.from_batches(waiting)


def _links(threshold: int, columns: int = 1 << 13):
    """Links (a, b) of one cell that join its components, by counting common members of whole sets."""

    def run(cell: pa.Table) -> pa.Table:
        cell = cell.combine_chunks()
        name, found = cell["name"], _codes(cell["found"])
        members = cell["members"].combine_chunks()
        size = np.diff(members.offsets.to_numpy())
        value, place = np.unique(members.flatten().to_numpy(), return_inverse=True)
        row = np.repeat(np.arange(len(size)), size)
        often = np.bincount(place, minlength=len(value)) > 1  # a member of one set only is common to none
        place = (np.cumsum(often) - 1)[place[often[place]]], row[often[place]]
        common = np.zeros((len(size), len(size)), np.int64)
        order = np.argsort(place[0], kind="stable")
        at, row = place[0][order], place[1][order]
        for lo in range(0, int(often.sum()), columns):
            a, b = np.searchsorted(at, [lo, lo + columns])
            block = np.zeros((len(size), columns), np.float32)
            block[row[a:b], at[a:b] - lo] = 1
            common += (block @ block.T).astype(np.int64)
        union = size[:, None] + size - common
        i, j = np.nonzero((100 * common >= threshold * union) & (found[:, None] != found))
        parent = list(range(int(found.max(initial=0)) + 1))

        def top(x):
            while parent[x] != x:
                x = parent[x]
            return x

        a, b = [], []
        for x, y in zip(i.tolist(), j.tolist()):
            left, right = top(found[x]), top(found[y])
            if left != right:
                parent[max(left, right)] = min(left, right)
                a.append(x)
                b.append(y)
        take = lambda at: name.take(pa.array(at, pa.int64()))
        return pa.table([take(a), take(b)], names=["a", "b"])

    return run


def settle(buckets: DataFrame, links: DataFrame, names: DataFrame, docs: DataFrame, words: int, threshold: int) -> DataFrame:
    """Components once every pair of names that shares a bucket is decided.

    Buckets with one component have nothing left to find.  In the others all
    pairs of different components are met in cells (``_dealt``): first with
    signatures, which leaves the names of pairs that may be linked, each pair
    in the first band it shares; then those names with their whole sets.  So no
    pair is given up, no pair becomes a row, and links that leave a cell only
    join components of it.
    """
    groups = components.connected(links)
    rows = _open(buckets, groups)
    if rows.isEmpty():
        return groups
    sides = names.select(F.col("doc_id").alias("name"), "n_shingles", "signature", "bands")
    kind = dict(names.dtypes)["doc_id"]
    met = _dealt(rows).join(sides, "name").select(*CELL, "name", "found", "n_shingles", "signature", "bands")
    sorted_cells = met.repartition(*[F.col(c) for c in CELL]).sortWithinPartitions(*CELL)
    schema = f"h long, kind int, low int, high int, name {kind}, found {kind}"
    near = cut_lineage(sorted_cells.mapInArrow(_near_rows(threshold), schema).distinct())
    if near.isEmpty():
        return groups
    wanted = cut_lineage(near.select(F.col("name").alias("doc_id")).distinct())
    # rows with the same id and text count once, so that repeats do not multiply
    sets = sets_of(docs, wanted, words).groupBy(F.col("doc_id").alias("name"), F.xxhash64("members")).agg(F.first("members").alias("members")).select("name", "members")
    more = near.join(sets, "name").groupBy(*CELL).applyInArrow(_links(threshold), f"a {kind}, b {kind}")
    return components.connected(links.unionByName(cut_lineage(more.distinct())))


PRINTS = ["print_a", "print_b", "n_shingles"]


def _grouped(named: DataFrame, words: int, threshold: int) -> tuple[DataFrame, DataFrame]:
    """Sketches of the rows of (doc_id, text), written, and the result of ``group``."""
    sketches = cut_lineage(sketch(named, words))
    usable = sketches.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = usable.groupBy(*PRINTS).agg(F.min("doc_id").alias("name"))
    names = usable.join(classes.withColumnRenamed("name", "doc_id"), [*PRINTS, "doc_id"], "left_semi")

    spread = names.select(F.col("doc_id").alias("name"), F.posexplode("bands").alias("band", "h"))
    shared = spread.groupBy("h").agg(F.min("name").alias("pivot"), F.max("name").alias("last")).where(F.col("pivot") != F.col("last")).drop("last")
    buckets = cut_lineage(spread.join(shared, "h"))
    first = buckets.where(F.col("name") != F.col("pivot")).select(F.col("name").alias("a"), F.col("pivot").alias("b")).distinct()
    best = promising(first, names, threshold).groupBy("a").agg(F.min_by("b", F.struct(-F.col("near"), "b")).alias("b"))
    links = cut_lineage(confirmed(cut_lineage(best), named, words, threshold))
    groups = settle(buckets, links, names, named, words, threshold)

    rows = sketches.select("doc_id", *PRINTS).join(classes, PRINTS, "left")
    rows = rows.join(groups.select(F.col("node").alias("name"), "component"), "name", "left")
    found = F.coalesce("component", F.when(F.col("doc_id").isNotNull(), F.col("name")), "doc_id")
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return sketches, rows.select("doc_id", "n_shingles", found.alias("component_id")).withColumn("kept", kept)


def group(docs: DataFrame, words: int = 5, threshold: int = THRESHOLD, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``.

    Two documents are linked if 100 * common >= ``threshold`` * union of their
    sets of distinct shingles of ``words`` words, A-Z in lower case.  A text
    with fewer words is one shingle; a null text or one without words has no
    set and is linked with nothing.  ``component_id`` is the smallest id that
    links reach.  Rows with the same id are one node.  A row with a null id is
    a group of its own: component_id null, kept true.
    """
    return _grouped(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), words, threshold)[1]


def keep_one(docs: DataFrame, words: int = 5, threshold: int = THRESHOLD, text: str = "text", key: str = "doc_id") -> DataFrame:
    """All columns of one row of each group: the row with its smallest id.

    Of several rows with that id one stays, the one whose text has the least
    hash.  A row with a null id goes if a row with an id has the same set of
    shingles; of rows with null ids and the same set one stays.  Texts without
    words are groups of their own, but rows with the same id are one.
    """
    sketches, found = _grouped(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), words, threshold)
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias(key)).distinct()
    repeated = found.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias(key)).count().where(F.col("count") > 1).select(key)
    mark, columns = F.xxhash64(text), docs.columns
    whole = F.struct(*[F.col(c) for c in columns])

    def one_of(rows: DataFrame, *by) -> DataFrame:
        return rows.groupBy(*by).agg(F.min_by(whole, mark).alias("_row")).select("_row.*")

    named = docs.where(F.col(key).isNotNull()).join(gone, key, "left_anti").select(*columns)
    kept = named.join(repeated, key, "left_anti").select(*columns).unionByName(one_of(named.join(repeated, key, "left_semi").select(*columns), F.col(key)))
    nameless = docs.where(F.col(key).isNull())
    if nameless.isEmpty():
        return kept
    marks = sketch(nameless.select(mark.alias("doc_id"), F.col(text).alias("text")), words).select(F.col("doc_id").alias("_mark"), *PRINTS).distinct()
    taken = sketches.where(F.col("doc_id").isNotNull()).select(*PRINTS).distinct()
    free = marks.where(F.col("n_shingles") > 0).join(taken, PRINTS, "left_anti").groupBy(*PRINTS).agg(F.min("_mark").alias("_mark"))
    # a set's row is found by the hash of its text, as it has no id
    blank = marks.where(F.col("n_shingles") == 0)
    of = lambda some: nameless.join(some, F.xxhash64(nameless[text]) == some["_mark"], "left_semi").select(*columns)
    return kept.unionByName(one_of(of(free), mark)).unionByName(of(blank))
