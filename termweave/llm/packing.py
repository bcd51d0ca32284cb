"""Hierarchical multi-length packing of tokenised documents into training sequences.

Documents are routed by what is left of them after their full 2048-token windows: to the
shortest context tier (256, 512, 1024 or 2048) that holds the rest.  Each tier is packed, long
windows first: the gap behind a long rest is filled with the longest rest of the shorter tiers
that fits, again and again, and what stays open is closed by cutting one more rest to measure.
The next tier goes on with what the longer ones left.  Every window is full, so nothing is
padded; the few tokens that remain at the end of a block become sequences of a power of two
(of 128, 64, 32 ... tokens).

Sequences of one tier are then dealt to step groups, which all hold the same number of tokens,
in snake order of their attention cost (the sum of squared piece lengths), so that the steps of
a tier take about equally long.

Tokenising and packing happen in one pass over the input partitions, in blocks of a bounded
number of rests; no shuffle, and no key that could be hot.  Sequence numbers are unique over the
whole result and the same when a lost task runs again.

The ids are those of the vocabulary's file for ``tokenizers``; they are computed with
``tiktoken`` from the same vocabulary and pattern (several times faster, equal on every text of
the test tables), or with ``tokenizers`` where ``tiktoken`` fails.  A string of a special token has that
token's id, as ``tokenizers`` gives it without being told otherwise.

Defined results: null and empty texts have the single closing id; repeated rows are packed each.
"""

from __future__ import annotations

import base64
import json
from bisect import bisect_right, insort
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

from termweave.llm.common import _arrow_schema, _blocks, id_text

WINDOW = 2048
TIERS = (256, 512, 1024, 2048)
END_ID = 1
STEP_TOKENS = 16 * WINDOW
BLOCK_RESTS = 2000

COLUMNS = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens",
           "step_group")


def special_tokens(json_path: str) -> dict[str, int]:
    """Strings and ids of the vocabulary's special tokens."""
    with open(json_path, encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f)["added_tokens"] if t["special"]}


def encoder(json_path: str, ranks_path: str, pattern: str, special: bool = False):
    """text -> ids of the public vocabulary; special strings are ordinary text, or with ``special``
    their own ids."""
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=ranks,
                             special_tokens=special_tokens(json_path) if special else {})
    slow = []

    def encode(text: str) -> list[int]:
        try:
            return fast.encode(text, allowed_special="all") if special else fast.encode_ordinary(text)
        except Exception:  # a text that its pattern engine gives up on
            if not slow:
                from tokenizers import Tokenizer

                t = Tokenizer.from_file(json_path)
                t.encode_special_tokens = not special
                slow.append(t)
            return slow[0].encode(text, add_special_tokens=False).ids
    return encode


class Rest:
    """An open stretch of one document: ids, where it starts, and the document's own size."""

    __slots__ = ("ids", "start", "row", "total")

    def __init__(self, ids, start, row, total):
        self.ids, self.start, self.row, self.total = ids, start, row, total

    def cut(self, n: int) -> tuple[Rest, Rest | None]:
        if n >= len(self.ids):
            return self, None
        return (Rest(self.ids[:n], self.start, self.row, self.total),
                Rest(self.ids[n:], self.start + n, self.row, self.total))


class _Pool:
    """Rests ordered by length."""

    def __init__(self):
        self.items: list[tuple[int, int, Rest]] = []
        self.added = 0

    def add(self, rest: Rest) -> None:
        self.added += 1
        insort(self.items, (len(rest.ids), -self.added, rest))

    def fitting(self, room: int) -> Rest | None:
        """The longest rest of at most ``room`` tokens."""
        i = bisect_right(self.items, (room, 1))
        return self.items.pop(i - 1)[2] if i else None

    def shortest(self) -> Rest | None:
        return self.items.pop(0)[2] if self.items else None

    def tokens(self) -> int:
        return sum(x[0] for x in self.items)


def pack_rests(rests: list[Rest], tiers=TIERS) -> list[list[Rest]]:
    """Sequences, each a list of stretches whose lengths add up to a power of two."""
    pool, out = _Pool(), []
    for r in sorted(rests, key=lambda r: (-len(r.ids), r.row, r.start)):
        pool.add(r)
    left = pool.tokens()

    def window(size: int) -> list[Rest]:
        seq, room = [], size
        while room:
            r = pool.fitting(room)
            if r is None:  # only longer ones: cut the shortest to measure
                r, over = pool.shortest().cut(room)
                if over:
                    pool.add(over)
            seq.append(r)
            room -= len(r.ids)
        return seq

    # Long tiers first: while a rest of the tier is there, it opens a window; then windows of
    # the shorter tiers take what is left.
    for size, shorter in zip(tiers[::-1], [*tiers[::-1][1:], 0], strict=True):
        while left >= size and pool.items[-1][0] > shorter:
            out.append(window(size))
            left -= size
    size = tiers[-1]
    while left:
        while size > left:
            size //= 2
        out.append(window(size))
        left -= size
    return out


def step_groups(sequences: list[list[Rest]], step_tokens: int = STEP_TOKENS) -> list[int]:
    """A group number per sequence: groups hold sequences of one length and as many tokens each."""
    by_size: dict[int, list[tuple[int, int]]] = {}
    for i, s in enumerate(sequences):
        by_size.setdefault(sum(len(r.ids) for r in s), []).append((-sum(len(r.ids) ** 2 for r in s), i))
    out, first = [0] * len(sequences), 0
    for size in sorted(by_size, reverse=True):
        items = sorted(by_size[size])
        groups = -(-len(items) // max(1, step_tokens // size))
        for k, (_, i) in enumerate(items):
            turn, at = divmod(k, groups)
            out[i] = first + (at if turn % 2 == 0 else groups - 1 - at)
        first += groups
    return out


class Packer:
    """Feeds on documents, yields piece rows block by block; full windows pass straight through."""

    def __init__(self, base: int, window: int = WINDOW, tiers=TIERS, step_tokens: int = STEP_TOKENS,
                 block_rests: int = BLOCK_RESTS):
        self.base, self.window, self.tiers = base, window, tiers
        self.step_tokens, self.block_rests = step_tokens, block_rests
        self.rests: list[Rest] = []
        self.full: list[list[Rest]] = []
        self.keys: list = []
        self.sequences = self.groups = 0

    def add(self, key, ids: np.ndarray) -> bool:
        """True when the block is full."""
        row, n = len(self.keys), len(ids)
        self.keys.append(key)
        whole = n - n % self.window
        for i in range(0, whole, self.window):
            self.full.append([Rest(ids[i:i + self.window], i, row, n)])
        if whole < n:
            self.rests.append(Rest(ids[whole:], whole, row, n))
        return len(self.keys) >= self.block_rests or len(self.full) >= 2 * self.block_rests

    def flush(self) -> tuple[list, dict[str, list]]:
        keys, cols = [], {c: [] for c in COLUMNS}
        sequences = self.full + pack_rests(self.rests, self.tiers)
        groups = step_groups(sequences, self.step_tokens)
        for seq, group in zip(sequences, groups, strict=True):
            offset, size = 0, sum(len(r.ids) for r in seq)
            for r in seq:
                keys.append(self.keys[r.row])
                row = (r.start, len(r.ids), crc32(r.ids.tobytes()), r.total, self.base + self.sequences,
                       offset, size, self.base + self.groups + group)
                for c, v in zip(COLUMNS, row, strict=True):
                    cols[c].append(v)
                offset += len(r.ids)
            self.sequences += 1
        self.groups += max(groups, default=-1) + 1
        self.rests, self.full, self.keys = [], [], []
        return keys, cols


def pack(docs: DataFrame, json_path: str, ranks_path: str, pattern: str, id_col: str = "doc_id",
         text_col: str = "text", end_id: int = END_ID, **params) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    sequence_tokens (the length of the whole sequence), step_group."""
    rows = id_text(docs, id_col, text_col)
    schema = StructType([rows.schema["doc_id"]] + [StructField(c, LongType()) for c in COLUMNS])
    arrow = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(json_path, ranks_path, pattern, special=True)
        packer = Packer(TaskContext.get().partitionId() << 36, **params)

        def emit():
            keys, cols = packer.flush()
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, arrow.field(0).type)] + [pa.array(cols[c], pa.int64()) for c in COLUMNS],
                schema=arrow)

        for batch in batches:
            ids, texts = (batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "text"))
            for lo, hi in _blocks(texts, 4 << 20):
                for key, text in zip(ids.slice(lo, hi - lo).to_pylist(),
                                     texts.slice(lo, hi - lo).to_pylist(), strict=True):
                    if packer.add(key, np.array([*encode(text), end_id], "<u4")):
                        yield emit()
        if packer.keys:
            yield emit()

    return rows.mapInArrow(run, schema)
