"""Chat formatting at the level of tokens, with a loss mask from prefix sums.

A turn is ``<|im_start|> role <|im_sep|> text <|im_end|>``.  Role and text are
encoded on their own, so no merge crosses a border, and the three control
tokens are spliced in as reserved ids that no text can produce.  Control
strings inside a role or text are escaped before: in ``<``, backslashes, ``|``
one backslash more is put in, and one less on the way back.

The mask is the running sum of +1 after the separator of an assistant's turn
and -1 at its end, so it covers exactly the text of the assistant.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The control strings, in order of their reserved ids after the vocabulary.
CONTROL = ("<|im_start|>", "<|im_sep|>", "<|im_end|>")
START, SEPARATOR, END = range(3)
SPEAKER = "assistant"
_OPENS = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _OPENS.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


class Tokens:
    """A public vocabulary with reserved ids after its own."""

    def __init__(self, lines: bytes, pattern: str):
        import tiktoken

        ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in lines.splitlines() if line)}
        self.first = len(ranks) + 1
        self.coder = tiktoken.Encoding("chat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        return self.coder.encode_ordinary(escape(text))

    def raw(self, ids) -> str:
        return self.coder.decode_bytes(ids).decode()

    def turn(self, role: str, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of a turn."""
        head, body = self.encode(role), self.encode(text)
        ids = np.array([self.first + START, *head, self.first + SEPARATOR, *body, self.first + END], np.int32)
        step = np.zeros(len(ids), np.int8)
        if role == SPEAKER:
            step[len(head) + 2] += 1
            step[-1] -= 1
        return ids, np.cumsum(step, dtype=np.int8)


class Vocabulary:
    """Bytes of a rank file and its pattern, as a task gets them."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            self.lines = file.read()
        self.pattern = pattern

    def tokens(self) -> Tokens:
        return Tokens(self.lines, self.pattern)


def format_turns(conversations: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """conv_id, turn, ids and mask of every row; a conversation is its rows by turn.

    Null roles and texts are empty.  Each row is formatted where it lies:
    conversations of any length need no memory of their own.
    """
    def batches(stream: Iterator[pa.RecordBatch]):
        coder = None
        for batch in stream:
            coder = coder or vocabulary.tokens()
            for lo in range(0, len(batch), 256):
                part = batch.slice(lo, 256)
                made = [coder.turn(r or "", t or "") for r, t in zip(part.column(2).to_pylist(), part.column(3).to_pylist())]
                edges = pa.array(np.concatenate([[0], np.cumsum([len(i) for i, _ in made])]), pa.int32())
                lists = [pa.ListArray.from_arrays(edges, pa.array(np.concatenate([m[k] for m in made]))) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *lists], names=["conv_id", "turn", "ids", "mask"])

    kinds = dict(conversations.dtypes)
    held = conversations.select("conv_id", "turn", F.col("role").cast("string"), F.col("text").cast("string"))
    return held.mapInArrow(batches, f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, ids array<int>, mask array<tinyint>")


class Reader:
    """What is read back from the ids and masks of a conversation while its turns pass."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.count = self.loss_chars = self.chars = 0

    def feed(self, ids: np.ndarray, mask: np.ndarray, coder: Tokens) -> None:
        marks = np.flatnonzero(ids >= coder.first)
        kinds = (ids[marks] - coder.first).tolist()
        if kinds != [START, SEPARATOR, END] or marks[0] != 0 or marks[2] != len(ids) - 1:
            raise ValueError("a turn is not framed by its control tokens")
        role, text = coder.raw(ids[1 : marks[1]].tolist()), coder.raw(ids[marks[1] + 1 : -1].tolist())
        self.chars += len(role) + len(text) + sum(len(CONTROL[k]) for k in kinds)
        self.turns.update(f"{unescape(role)}\n{unescape(text)}\n".encode())
        self.count += 1
        if mask.any():
            lost = unescape(coder.raw(ids[mask > 0].tolist()))
            self.loss.update(lost.encode())
            self.loss_chars += len(lost)

    def row(self) -> tuple:
        return self.count, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(turns: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """One row per conversation from formatted turns: counts and digests of what ids and masks hold.

    Turns of a conversation are brought together in order and pass one by one:
    a digest needs them one after the other, but none are held, so a very long
    conversation costs time in one task, not memory.  Turns with the same
    number come in the order of their ids.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def batches(stream: Iterator[pa.RecordBatch]):
        coder, state, now, done, kind = None, None, None, [], None
        for batch in stream:
            coder, kind = coder or vocabulary.tokens(), batch.column(0).type
            ids, mask = batch.column(1), batch.column(2)
            for i, conv in enumerate(batch.column(0).to_pylist()):
                if state is None or conv != now:
                    if state is not None:
                        done.append((now, *state.row()))
                    state, now = Reader(), conv
                state.feed(ids[i].values.to_numpy(), mask[i].values.to_numpy(), coder)
            if len(done) >= 1000:
                yield emit(done, kind)
                done = []
        if state is not None:
            yield emit([*done, (now, *state.row())], kind)

    def emit(rows, kind):
        columns = list(zip(*rows))
        kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "ids").select("conv_id", "ids", "mask")
    kind = dict(turns.dtypes)["conv_id"]
    return ordered.mapInArrow(batches, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
