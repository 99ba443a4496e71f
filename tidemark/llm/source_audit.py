"""Source divergence audit: exact term counts of each source of a language, and how far apart sources are.

1. Tasks put texts together and write what stands for them to the shared
   folder, by language: the documents of each term as ``MIN_DF`` term lists,
   and the counts of each source as a term list per binary digit.  Per language a ``CountVectorizer``
   with ``minDF`` and the largest integer as ``vocabSize`` fits the vocabulary
   over the former and makes sparse vectors of the latter; nothing is cut off.
2. Like ``Summarizer.sum`` with a weight, but sparse, the vectors are added up
   per source: one sum per source and index, combined before the shuffle.
3. Shares are whole numbers of ``ONE``.  A term that a source lacks has the
   source's base share, so a pair of sources is its terms plus one product
   for all terms that both lack.  Pairs are worked out in cells of
   ``SOURCES`` by ``SOURCES`` sources and ``TERMS`` indices.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import textbytes as tb
from tidemark.runtime import cut_lineage, ensure_checkpoint_dir, run_parallel

MIN_DF, MOST_TERMS = 30, 2**31 - 1
ONE, SMOOTH = 1_000_000_000, 5
TOP = 50
#: Sources and indices on a side of a cell of pairs.
SOURCES, TERMS = 64, 1 << 15
#: Bytes of texts that are counted at once, of counts that a task puts together, and of a row group of their term lists.
RUN_BYTES, HELD_BYTES, GROUP_BYTES = 1 << 22, 1 << 25, 1 << 24
#: Bytes of terms: letters of ASCII and everything beyond.
LETTERS = [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]
LOWER = bytes(tb.lower_ascii(np.arange(256, dtype=np.uint8)))


def added(keys: np.ndarray, amounts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of the amounts of each."""
    order = np.argsort(keys)
    keys = keys[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
    return keys[heads], np.add.reduceat(amounts[order], heads) if len(heads) else amounts


def counted_keys(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each is there."""
    keys = np.sort(keys)
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
    return keys[heads], np.diff(np.append(heads, len(keys)))


def one_dictionary(parts: list[pa.Array], places: list[np.ndarray]) -> tuple[pa.Array, np.ndarray]:
    """The distinct strings of all parts, and where the places of each part are among them."""
    coded = pa.concat_arrays(parts).dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    firsts = np.cumsum([0, *map(len, parts)])
    return coded.dictionary, np.concatenate([code[place + first] for place, first in zip(places, firsts)])


def term_lists(owner: np.ndarray, term: np.ndarray, picks: list[np.ndarray], n: int, terms: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """A list per pick and owner below ``n``: the owners, and the terms of the picked entries, which are in order of their owners."""
    sizes = [np.bincount(owner[pick], minlength=n) for pick in picks]
    edges = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32)
    return np.tile(np.arange(n), len(picks)), pa.ListArray.from_arrays(pa.array(edges), terms.take(pa.array(term[np.concatenate(picks)])))


def put_together(docs: DataFrame) -> DataFrame:
    """Term lists (part, k, source, weight, terms) that stand for the texts of rows (k, source, text), A-Z in lower case.

    ``seen``: of texts put together, a term that ``d`` documents of a language
    hold is in the first ``d`` of ``MIN_DF`` lists.  So ``MIN_DF`` or more of
    all lists hold a term exactly if so many documents do.
    ``sum``: list ``b`` of a source holds the terms whose count there has the
    binary digit ``b``, and weighs ``2 ** b``.  Every language has both parts.
    """
    inside, least = tb.byte_table(LETTERS), MIN_DF
    others = bytes(np.flatnonzero(~inside).astype(np.uint8))

    def run(k, source, data, offsets):
        """Terms and sources of some texts; documents per language and term, occurrences per language, source and term."""
        starts, ends = tb.spans(inside[data], offsets)
        places = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
        letters = pa.StringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(data.tobytes().translate(LOWER, others)))
        coded, named = letters.dictionary_encode(), source.dictionary_encode()
        word, name = (c.indices.to_numpy(zero_copy_only=False).astype(np.int64) for c in (coded, named))
        n, m = max(len(coded.dictionary), 1), len(named.dictionary)
        row = np.repeat(np.arange(len(k)), np.diff(tb.first_of_row(starts, offsets)))
        pairs, _ = counted_keys(row * n + word)
        held, docs_ = counted_keys(k[pairs // n] * n + pairs % n)
        groups, group = np.unique(k * m + name, return_inverse=True)
        there, count = counted_keys(group[row] * n + word)
        at = groups[there // n]
        return coded.dictionary, named.dictionary, groups // m, groups % m, (held // n, held % n, docs_), (at // m, at % m, there % n, count)

    def lists(runs):
        terms, sources, langs, names, seen, sums = zip(*runs)
        k, k_seen, k_sum = (np.concatenate(c) for c in (langs, [x[0] for x in seen], [x[0] for x in sums]))
        langs = np.unique(k)
        words, word = one_dictionary(terms, [x[1] for x in seen])
        n = max(len(words), 1)
        keys, held = added(np.searchsorted(langs, k_seen) * n + word, np.concatenate([x[2] for x in seen]))
        at, made = term_lists(keys // n, keys % n, [np.flatnonzero(held > j) for j in range(least)], len(langs), words)
        yield "seen", langs[at], pa.nulls(len(at), pa.string()), np.zeros(len(at), np.int64), made

        named, name = one_dictionary(sources, names)
        m = len(named)
        groups = np.unique(k * m + name)
        _, word = one_dictionary(terms, [x[2] for x in sums])
        _, name = one_dictionary(sources, [x[1] for x in sums])
        keys, count = added(np.searchsorted(groups, k_sum * m + name) * n + word, np.concatenate([x[3] for x in sums]))
        digits = max(int(count.max(initial=0)).bit_length(), 1)
        at, made = term_lists(keys // n, keys % n, [np.flatnonzero(count >> b & 1) for b in range(digits)], len(groups), words)
        yield "sum", groups[at] // m, named.take(pa.array(groups[at] % m)), np.repeat(1 << np.arange(digits), len(groups)), made

    def rows(runs):
        for part, k, *columns, made in lists(runs):
            columns = [pa.array([part] * len(made)), pa.array(k, pa.int32()), *map(pa.array, columns), made]
            batch = pa.RecordBatch.from_arrays(columns, names=["part", "k", "source", "weight", "terms"])
            yield batch.filter(pa.array((np.diff(made.offsets.to_numpy()) > 0) | (batch["weight"].to_numpy() < 2)))

    def batches(stream):
        runs, size = [], 0
        for batch in stream:
            k, source = batch.column(0).to_numpy().astype(np.int64), batch.column(1)
            for lo, hi, data, offsets in tb.text_runs(batch.column(2), RUN_BYTES):
                runs.append(run(k[lo:hi], source.slice(lo, hi - lo), data, offsets))
                size += runs[-1][0].nbytes + sum(c.nbytes for part in runs[-1][4:] for c in part)
                if size >= HELD_BYTES:
                    yield from rows(runs)
                    runs, size = [], 0
        if runs:
            yield from rows(runs)

    return docs.select("k", "source", "text").mapInArrow(batches, "part string, k int, source string, weight long, terms array<string>")


def vocabulary(seen: DataFrame, lists: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Sums (source, index, n) of the kept terms of one language, and its vocabulary (index, term).

    Every ``seen`` list also holds the empty term, which no text has, so that a
    fit always has one; it leaves the vocabulary again.
    """
    marked = seen.withColumn("terms", F.array_append("terms", F.lit("")))
    model = CountVectorizer(inputCol="terms", outputCol="counts", minDF=float(MIN_DF), vocabSize=MOST_TERMS).fit(marked)
    model.write().save(folder)  # by the JVM: the vocabulary doesn't pass through Python
    kept = seen.sparkSession.read.parquet(f"{folder}/data").select(F.posexplode("vocabulary").alias("index", "term"))
    vector = F.unwrap_udt("counts")
    pairs = model.transform(lists).select("source", "weight", F.explode(F.arrays_zip(vector["indices"].alias("index"), vector["values"].alias("n"))).alias("at"))
    sums = pairs.groupBy("source", F.col("at.index").alias("index")).agg(F.sum(F.col("at.n").cast("long") * F.col("weight")).alias("n"))
    return sums, kept.where(F.col("term") != "")


def share(count: Column, size: Column, terms: Column) -> Column:
    """1 + floor(ONE * (count + SMOOTH) / (size + SMOOTH * terms)), exact beyond 64 bits."""
    whole = lambda c: c.cast("decimal(20,0)")
    part, total = (count + SMOOTH).cast("long"), size + SMOOTH * terms
    wide = F.call_function("div", F.lit(ONE).cast("decimal(12,0)") * whole(part), whole(total))
    return F.when(part <= (2**63 - 1) // ONE, F.call_function("div", part * ONE, total)).otherwise(wide) + 1


def counted(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Groups (lang, source), sums (lang, source, term, index, n) and kept terms (lang, term, index), all written.

    There is one fit per language, so languages are the one thing that must be few.
    """
    spark = docs.sparkSession
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    named = docs.select(text("text").alias("text"), text("lang").alias("lang"), text("source").alias("source"))
    home = f"{ensure_checkpoint_dir(spark).rstrip('/')}/source-audit-{uuid.uuid4().hex}"
    groups = cut_lineage(named.groupBy("lang", "source").agg(F.count("*").alias("docs")))
    langs = [(r.lang, r.docs) for r in groups.groupBy("lang").agg(F.sum("docs").alias("docs")).collect()]
    numbers = spark.createDataFrame([(lang, k) for k, (lang, _) in enumerate(langs)], "lang string, k int")
    # texts of one source side by side have more terms in common
    dealt = named.join(F.broadcast(numbers), "lang").select("k", "source", "text").sortWithinPartitions("k", "source")
    put_together(dealt).write.option("parquet.block.size", GROUP_BYTES).partitionBy("part", "k").parquet(f"{home}/lists")

    def fit(k: int) -> None:
        # a language is read by its own path, without a listing of the others
        own = [spark.read.schema("source string, weight long, terms array<string>").parquet(f"{home}/lists/part={part}/k={k}") for part in ("seen", "sum")]
        sums, kept = vocabulary(*own, f"{home}/model-{k}")
        label = F.lit(langs[k][0]).alias("lang")
        sums.join(kept, "index").select(label, "source", "term", "index", "n").write.parquet(f"{home}/sums/{k}")
        kept.select(label, "term", "index").write.parquet(f"{home}/kept/{k}")

    large = [k for k, (_, n) in enumerate(langs) if n >= MIN_DF]
    run_parallel(spark, [lambda k=k: fit(k) for k in large], threads=4)

    def read(name: str, schema: str) -> DataFrame:
        paths = [f"{home}/{name}/{k}" for k in large]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    return groups, read("sums", "lang string, source string, term string, index int, n long"), read("kept", "lang string, term string, index int")


def cell_sums(table: pa.Table) -> pa.Table:
    """Sums of absolute differences of all pairs of a cell, from its sources' shares at one run of indices."""
    column = lambda name: table[name].to_numpy()
    mark = column("index") < 0
    number, base = column("number")[mark], column("share")[mark]
    order = np.argsort(number)
    number, base = number[order], base[order]
    terms, place = np.unique(column("index")[~mark], return_inverse=True)
    held = np.repeat(base[:, None], len(terms), 1)
    held[np.searchsorted(number, column("number")[~mark]), place] = column("share")[~mark]
    lacking = int(column("width")[mark][0]) - len(terms)
    low, high = int(column("low")[0]), int(column("high")[0])
    a, b, value = [], [], []
    for i in np.flatnonzero(number // SOURCES == low):
        others = np.flatnonzero((number // SOURCES == high) & (number > number[i]))
        a.append(np.full(len(others), number[i]))
        b.append(number[others])
        value.append(np.abs(held[others] - held[i]).sum(1) + lacking * np.abs(base[others] - base[i]))
    join = lambda parts: np.concatenate(parts) if parts else np.empty(0, np.int64)
    lang = table["lang"][0].as_py()
    return pa.table({"lang": pa.array([lang] * sum(map(len, a)), pa.string()), "a": join(a).astype(np.int64), "b": join(b).astype(np.int64), "value": join(value).astype(np.int64)})


def pair_sums(groups: DataFrame, entries: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, a, b, value) of every pair a < b of source numbers of a language."""
    chunk = F.floor(F.col("index") / TERMS).cast("int")
    widths = kept.groupBy("lang", chunk.alias("chunk")).agg(F.count("*").alias("width"))
    runs = widths.groupBy("lang").agg(F.collect_list(F.struct("chunk", "width")).alias("runs"))
    none = F.array(F.struct(F.lit(0).alias("chunk"), F.lit(0).cast("long").alias("width")))
    # a group stands in each run of indices of its language, with the width of the run
    stands = groups.join(runs, "lang", "left").withColumn("run", F.explode(F.coalesce("runs", none)))
    marks = stands.select("lang", "blocks", "number", F.col("run.chunk").alias("chunk"), F.col("run.width").alias("width"), F.lit(-1).alias("index"), F.col("base").alias("share"))
    rows = marks.unionByName(entries.select("lang", "blocks", "number", chunk.alias("chunk"), F.lit(0).cast("long").alias("width"), "index", "share"))
    block = F.floor(F.col("number") / SOURCES).cast("int")
    dealt = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("low", F.least(block, "other")).withColumn("high", F.greatest(block, "other")).drop("other", "blocks")
    cells = dealt.groupBy("lang", "chunk", "low", "high").applyInArrow(cell_sums, "lang string, a long, b long, value long")
    return cells.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame) -> DataFrame:
    """lang, source, part, item, value and rank: how far the sources of a language are apart, and by which terms.

    Null text, lang and source are empty strings; an empty string is a
    language or a source like others.  A language with fewer than ``MIN_DF``
    documents keeps no term, so its pairs are 0 apart.  A source without terms
    takes part with base shares only.  Repeated rows count each time.  Part
    ``pair`` holds every other source of the language, part ``term`` up to
    ``TOP`` terms that the source has more of than its language; ranks go by
    value, ties by the bytes of the item.  An empty table gives an empty result.
    """
    groups, sums, kept = counted(docs)
    terms = kept.groupBy("lang").agg(F.count("*").alias("terms"))
    size = sums.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    known = groups.select("lang", "source").join(size, ["lang", "source"], "left").join(terms, "lang", "left").fillna(0, ["size", "terms"])
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    blocks = F.ceil(F.count("*").over(Window.partitionBy("lang")) / SOURCES).cast("int")
    base = share(F.lit(0), F.col("size"), F.greatest("terms", F.lit(1)))
    numbered = cut_lineage(known.withColumns({"number": number.cast("long"), "blocks": blocks, "base": base}))
    entries = sums.join(numbered, ["lang", "source"]).withColumn("share", share(F.col("n"), F.col("size"), F.col("terms")))

    sizes = numbered.groupBy("lang").agg(F.sum("size").alias("size"), F.max("terms").alias("terms"))
    whole = sums.groupBy("lang", "term").agg(F.sum("n").alias("n")).join(sizes, "lang")
    usual = whole.select("lang", "term", share(F.col("n"), F.col("size"), F.col("terms")).alias("usual"))
    more = entries.join(usual, ["lang", "term"]).where(F.col("share") > F.col("usual"))
    found = more.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("share") - F.col("usual")).alias("value"))

    halves = pair_sums(numbered, entries, kept)
    sides = halves.select("lang", F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("pair"), "value")
    name = lambda c, to: numbered.select("lang", F.col("number").alias(c), F.col("source").alias(to))
    apart = sides.select("lang", F.col("pair.a").alias("a"), F.col("pair.b").alias("b"), "value").join(name("a", "source"), ["lang", "a"]).join(name("b", "item"), ["lang", "b"])
    apart = apart.select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    top = found.withColumn("rank", place).where(F.col("rank") <= TOP)
    return apart.withColumn("rank", place).unionByName(top)
