"""Byte-level BPE: recursive DuckDB queries merge the words of a partition, an ordered aggregate decodes.

Text is cut into words by the pattern of the vocabulary.  A run of rows is
reduced to its distinct new words, whose bytes become token-position rows in a
DuckDB of the task.  A recursive query joins neighbours with the merge table
and contracts the leftmost pair of the lowest rank of every word, until no word
has a pair left.  Tokens of the texts are then gathered from those of their
words.  Decoding joins the ids with the vocabulary and concatenates in order.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm import textbytes as tb

#: Bytes of text that are encoded together: bounds the rows of one DuckDB query.
RUN_BYTES = 2 << 20
#: Distinct words whose ids a task remembers.
REMEMBERED = 400_000
#: Longer words (in bytes) are merged with a heap: one contraction a round would make the rounds as many as the bytes.
LONG_WORD = 128
DUCKDB_MEMORY = "300MB"

CONTRACT = """
WITH RECURSIVE steps AS (
    SELECT w, list(t ORDER BY p) AS ids, 0 AS step FROM bytes GROUP BY w
  UNION ALL
    SELECT steps.w, steps.ids[:pair.pos - 1] || [pair.made] || steps.ids[pair.pos + 2:], steps.step + 1
    FROM steps JOIN (
        SELECT w, arg_min(rank, (rank::BIGINT << 32) | pos) AS made, arg_min(pos, (rank::BIGINT << 32) | pos) AS pos
        FROM (SELECT w, unnest(ids[:-2]) AS l, unnest(ids[2:]) AS r, unnest(range(1, len(ids))) AS pos FROM steps WHERE len(ids) > 1)
        JOIN merges ON merges.pair = (l::BIGINT << 32) | r
        GROUP BY w
    ) AS pair ON steps.w = pair.w
)
SELECT w, arg_max(ids, step) AS ids FROM steps GROUP BY w ORDER BY w
"""
DECODE = "SELECT d, string_agg(s, '' ORDER BY p) AS s FROM tokens JOIN vocabulary USING (id) GROUP BY d ORDER BY d"


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank a line."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines.splitlines() if line)}


def merge_table(ranks: dict[bytes, int]) -> np.ndarray:
    """Rows (left id, right id, made id) of every way to put a token together from two tokens."""
    rows = [
        (ranks[token[:k]], ranks[token[k:]], made)
        for token, made in ranks.items()
        for k in range(1, len(token))
        if token[:k] in ranks and token[k:] in ranks
    ]
    return np.array(rows, np.int32).reshape(-1, 3)


class Vocabulary:
    """What a task needs of a rank file; made on the driver, its size is that of the file."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            self.lines = file.read()
        self.pattern = pattern
        self.merges = merge_table(read_ranks(self.lines))


def latin_pattern(pattern: str, last: int = 0x24F) -> str:
    """The pattern for texts without code points over ``last``, for the faster standard matcher.

    Classes become lists of their members there, so both matchers cut alike.
    """
    import regex

    def members(kind: str) -> str:
        return "".join(re.escape(chr(c)) for c in range(last + 1) if regex.match(kind, chr(c)))

    out = re.sub(r"\[\^([^\]]*)\]", lambda m: "[^" + re.sub(r"\\p\{.\}|\\s", lambda k: members(k[0]), m[1]) + "]", pattern)
    return re.sub(r"\\p\{.\}|\\s|\\S", lambda k: f"[^{members(chr(92) + 's')}]" if k[0] == r"\S" else f"[{members(k[0])}]", out)


class Coder:
    """Encodes and decodes in one task."""

    def __init__(self, vocabulary: Vocabulary):
        import duckdb
        import regex

        self.ranks = read_ranks(vocabulary.lines)
        self.full = regex.compile(vocabulary.pattern)
        self.wide = re.compile("[^\x00-\u024f]")
        self.quick = re.compile(latin_pattern(vocabulary.pattern))
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": DUCKDB_MEMORY, "preserve_insertion_order": False})
        left, right, made = vocabulary.merges.T.astype(np.int64)
        self._table("merges", pair=(left << 32) | right, rank=made)
        self._table("vocabulary", id=np.array(list(self.ranks.values()), np.int64), s=pa.array([t.decode("latin-1") for t in self.ranks]))
        self._forget()

    def _table(self, name: str, **columns) -> None:
        self.db.register("_given", pa.table(columns))
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM _given")
        self.db.unregister("_given")

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.ends = array("i"), array("q", [0])

    def words(self, text: str) -> list[str]:
        return (self.full if self.wide.search(text) else self.quick).findall(text)

    def _contract(self, words: list[bytes]) -> list[list[int]]:
        """Ids of words by the recursive query."""
        size = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words), np.uint8)
        self.db.register("bytes", pa.table({"w": np.repeat(np.arange(len(words)), size), "p": np.arange(len(data)), "t": self.byte_ids[data]}))
        made = self.db.sql(CONTRACT).to_arrow_table()["ids"].to_pylist()
        self.db.unregister("bytes")
        return made

    def _contract_long(self, word: bytes) -> list[int]:
        """The same merges for one long word with a heap of pairs: n log n instead of n rounds."""
        import heapq

        n = len(word)
        token = [word[i : i + 1] for i in range(n)]
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n:
                rank = self.ranks.get(token[i] + token[j])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, len(token[i]), len(token[j])))

        for i in range(n):
            offer(i)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if j >= n or len(token[i]) != left or len(token[j]) != right:
                continue
            token[i] += token[j]
            alive[j], after[i] = False, after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [self.ranks[token[i]] for i in range(n) if alive[i]]

    def _learn(self, words: list[str]) -> None:
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self._forget()
            new = words
        raw = [w.encode() for w in new]
        ids = [[self.ranks[w]] if w in self.ranks else None for w in raw]
        open_ = [i for i, x in enumerate(ids) if x is None and len(raw[i]) <= LONG_WORD]
        if open_:
            for i, made in zip(open_, self._contract([raw[i] for i in open_])):
                ids[i] = made
        for i, word in enumerate(new):
            self.known[word] = len(self.ends) - 1
            self.flat.extend(ids[i] if ids[i] is not None else self._contract_long(raw[i]))
            self.ends.append(len(self.flat))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts after each other, and the edges of each text."""
        cut = [self.words(t) for t in texts]
        many = np.array([len(c) for c in cut], np.int64)
        coded = pa.array(chain.from_iterable(cut), pa.string()).dictionary_encode()
        del cut
        distinct = coded.dictionary.to_pylist()
        self._learn(distinct)
        place = np.array([self.known[w] for w in distinct], np.int64)
        word = place[coded.indices.to_numpy(zero_copy_only=False)] if len(place) else np.empty(0, np.int64)
        ends = np.array(self.ends, np.int64)
        first, size = ends[word], ends[word + 1] - ends[word]
        edge = np.concatenate([[0], np.cumsum(size)])
        ids = np.array(self.flat, np.int32)[np.arange(edge[-1]) + np.repeat(first - edge[:-1], size)]
        return ids, edge[np.concatenate([[0], np.cumsum(many)])]

    def decode(self, ids: np.ndarray, edges: np.ndarray) -> list[bytes]:
        """Bytes of each text, from its ids in order."""
        size = np.diff(edges)
        out = [b""] * len(size)
        self.db.register("tokens", pa.table({"d": np.repeat(np.arange(len(size), dtype=np.int32), size), "p": np.arange(len(ids), dtype=np.int32), "id": ids}))
        made = self.db.sql(DECODE).to_arrow_table()
        self.db.unregister("tokens")
        for d, s in zip(made["d"].to_pylist(), made["s"].to_pylist()):
            out[d] = s.encode("latin-1")
        return out


def _coded(docs: DataFrame, vocabulary: Vocabulary, schema: str, make, text: str, key: str) -> DataFrame:
    """Run ``make`` (coder, ids, edges) over the texts, ``RUN_BYTES`` at a time."""
    names = [key] + [part.split()[0] for part in schema.split(",")]

    def batches(stream):
        coder = None
        for batch in stream:
            for lo, hi, data, offsets in tb.text_runs(batch.column(1), RUN_BYTES):
                coder = coder or Coder(vocabulary)
                raw = data.tobytes()
                texts = [raw[a:b].decode() for a, b in zip(offsets[:-1], offsets[1:])]
                made = make(coder, *coder.encode(texts))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *made], names=names)

    return docs.select(key, text).mapInArrow(batches, f"`{key}` {dict(docs.dtypes)[key]}, {schema}")


def _digests(coder: Coder, ids: np.ndarray, edges: np.ndarray) -> list[pa.Array]:
    little = ids.astype("<u4")
    of_ids = [hashlib.sha256(little[a:b]).hexdigest() for a, b in zip(edges[:-1], edges[1:])]
    of_text = [hashlib.sha256(t).hexdigest() for t in coder.decode(ids, edges)]
    return [pa.array(np.diff(edges)), pa.array(of_ids), pa.array(of_text)]


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and the ids of every row over its whole text.

    A null or empty text has no ids.  Repeated rows and null ids of rows stay.
    """
    def make(coder, ids, edges):
        return [*_digests(coder, ids, edges), pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(ids))]

    return _coded(docs, vocabulary, "n_tokens long, ids_sha256 string, decoded_sha256 string, ids array<int>", make, text, key)


def round_trip(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens and the digests of ids and of the text decoded from them, without handing out the ids."""
    return _coded(docs, vocabulary, "n_tokens long, ids_sha256 string, decoded_sha256 string", _digests, text, key)


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """doc_id and the bytes that each list of ids stands for; a null list is empty."""
    def batches(stream):
        coder = None
        for batch in stream:
            coder = coder or Coder(vocabulary)
            lists = batch.column(1).fill_null([]) if batch.column(1).null_count else batch.column(1)
            for lo in range(0, len(lists), 512):
                part = lists.slice(lo, 512)
                edges = np.concatenate([[0], np.cumsum(part.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
                made = coder.decode(part.flatten().to_numpy(zero_copy_only=False).astype(np.int32), edges)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, 512), pa.array(made, pa.binary())], names=[key, "decoded"])

    return encoded.select(key, ids).mapInArrow(batches, f"`{key}` {dict(encoded.dtypes)[key]}, decoded binary")
