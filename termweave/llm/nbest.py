"""SentencePiece encoding and decoding with the N best segmentations.

A text's lattice has a node before every character and an edge for every vocabulary piece that
spells the characters it spans.  A forward Viterbi pass gives the best score up to every node.
The N best segmentations are then found by an A* search from the end backwards, whose estimate
of what is still ahead, the forward score of the node, is exact: a search state's priority is the score
of the best segmentation it can become, so that states below the N-th are dropped at once and at
most N are ever held.

No piece of the vocabulary crosses the border between a word and the space before the next one
(checked when the model is loaded), nor a character that has no piece.  Every segmentation passes
through these nodes, so the lattice falls into chunks and scores add up over them.  Chunks recur,
so each distinct one is searched once: the forward and a backward pass run over all new chunks of
a block of texts together as array operations, and also give the loss of a chunk's second-best
segmentation.  The N best of a text can differ from its best only in the N - 1 chunks with the
smallest loss; just these are searched by A*, and their lists are merged.

Spaces are written as U+2581 and one is put in front, as the model does; characters without a
piece, and U+2581 itself when it stands in the text, are spelled in byte pieces, each of which
scores ``byte_score``.  Decoding gives back every text exactly.

Ties: among equal scores the segmentation whose last piece is longer comes first in the Viterbi
pass; scores of the N best are those of an exhaustive enumeration.  Defined results: null and
empty texts have one segmentation, without pieces; repeated rows are encoded alike.
"""

from __future__ import annotations

import re
from heapq import nlargest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from termweave.llm.common import id_text, map_texts

SPACE = "▁"
N_BEST = 4
SHORT = 24  # characters; longer chunks are searched one by one
_CHUNKS = re.compile(" *[^ \n▁]+|▁|\n| +")
_P = np.uint64(0x100000001B3)
_MIX = np.uint64(0x9E3779B97F4A7C15)

SCHEMA = ("ids array<int>, score double, scores array<double>, "
          "changes array<array<struct<at:int, drop:int, ids:array<int>>>>, round_trip boolean")


class Vocabulary:
    def __init__(self, model_file: str, byte_score: float | None = None):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.scores = [sp.get_score(i) for i in range(len(self.pieces))]
        self.byte_ids = [0] * 256
        self.ids: dict[str, int] = {}
        self.bytes_of: list[bytes] = [b""] * len(self.pieces)
        for i, p in enumerate(self.pieces):
            if sp.is_byte(i):
                self.byte_ids[int(p[3:-1], 16)] = i
                self.bytes_of[i] = bytes([int(p[3:-1], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                if SPACE in p.lstrip(SPACE) or "\n" in p:
                    raise ValueError(f"piece {p!r} crosses a border that texts are cut at")
                self.ids[p] = i
                self.bytes_of[i] = p.replace(SPACE, " ").encode()
        self.longest = max(map(len, self.ids))
        # Below the least piece, so that a character with a piece is never worth spelling out.
        ordinary = [self.scores[i] for i in self.ids.values() if self.scores[i] > -1e8]
        self.byte_score = byte_score if byte_score is not None else min(ordinary) - 10.0
        self._table()

    def _table(self):
        """Pieces by hash, in an open table that array operations can look up."""
        by_hash = {}
        for p, i in self.ids.items():
            h = 0
            for c in p:
                h = (h * int(_P) + ord(c) + 1) & (2 ** 64 - 1)
            if by_hash.setdefault(h, i) != i:
                raise ValueError("two pieces share a hash")
        self.bits = max(4, (8 * len(by_hash)).bit_length())
        self.keys = np.zeros((1 << self.bits) + 64, np.uint64)
        self.values = np.full(len(self.keys), -1, np.int32)
        self.probes = 1
        for h, i in by_hash.items():
            at = (h * int(_MIX) & (2 ** 64 - 1)) >> (64 - self.bits)
            n = 1
            while self.values[at] >= 0:
                at, n = at + 1, n + 1
            if n > 60:
                raise ValueError("the table is too crowded")
            self.keys[at], self.values[at] = h, i
            self.probes = max(self.probes, n)
        self.score_of = np.array(self.scores + [-np.inf])

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """Piece ids of hashes, -1 where there is none."""
        at = ((h * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)
        out = np.where(self.keys[at] == h, self.values[at], -1)
        for k in range(1, self.probes):
            miss = np.flatnonzero(out < 0)
            if not len(miss):
                break
            sub = at[miss] + k
            out[miss] = np.where(self.keys[sub] == h[miss], self.values[sub], -1)
        return out

    def spelled(self, char: str) -> tuple[int, ...]:
        return tuple(self.byte_ids[b] for b in char.encode())

    def edges(self, chunk: str) -> list[list[tuple[int, float, tuple[int, ...]]]]:
        """Per end node the edges into it: (start, score, ids), longest first."""
        literal = chunk == SPACE  # spaces are escaped before; a lone one here stands for itself
        out = [[] for _ in range(len(chunk) + 1)]
        for i, c in enumerate(chunk):
            for j in range(i + 1, min(len(chunk), i + self.longest) + 1):
                k = None if literal else self.ids.get(chunk[i:j])
                if k is not None:
                    out[j].append((i, self.scores[k], (k,)))
                elif j == i + 1:
                    ids = self.spelled(c)
                    out[j].append((i, len(ids) * self.byte_score, ids))
        for e in out:
            e.sort()
        return out

    def decode(self, ids) -> str:
        data = b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")
        return data[1:] if data.startswith(" ") else data


def forward(edges) -> list[float]:
    best = [0.0] + [-np.inf] * (len(edges) - 1)
    for j in range(1, len(edges)):
        best[j] = max((best[i] + s for i, s, _ in edges[j]), default=-np.inf)
    return best


def search(edges, n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The ``n`` best segmentations, best first: A* from the end, forward scores as estimate."""
    ahead = forward(edges)
    states = [(ahead[-1], 0.0, len(edges) - 1, None)]  # priority, score so far, node, (ids, rest)
    done: list = []
    while states and len(done) < n:
        top = max(range(len(states)), key=lambda k: states[k][0])
        priority, behind, node, path = states.pop(top)
        if node == 0:
            done.append((priority, path))
            continue
        states += [(ahead[i] + (behind + s), behind + s, i, (ids, path)) for i, s, ids in edges[node]]
        if len(states) > n - len(done):
            states = nlargest(n - len(done), states, key=lambda x: x[0])
    out = []
    for score, path in done:
        ids = []
        while path:
            ids += path[0]
            path = path[1]
        out.append((score, tuple(ids)))
    return out


class Chunks(dict):
    """Distinct chunks to positions in arrays: best ids, score and the second-best's loss."""

    def __init__(self, vocabulary: Vocabulary, room: int):
        self.v, self.room = vocabulary, room
        self.new: list[str] = []
        self.flat = np.empty(8 * room, np.int32)
        self.used = 0
        self.start, self.count = np.zeros(room, np.int64), np.zeros(room, np.int64)
        self.score, self.loss = np.zeros(room), np.zeros(room)
        self.lists: dict[int, list] = {}
        self.text: list[str] = []

    def __missing__(self, chunk: str) -> int:
        at = self[chunk] = len(self)
        self.new.append(chunk)
        self.text.append(chunk)
        return at

    def settle(self) -> None:
        """Work off the chunks seen since the last call.  Long ones go one by one, and so do those
        that an array of strings cannot hold (NUL) or that stand for themselves (U+2581)."""
        if not self.new:
            return
        first = len(self) - len(self.new)
        if len(self) > len(self.start):
            more = max(len(self), 2 * len(self.start)) - len(self.start)
            self.start, self.count, self.score, self.loss = (
                np.concatenate([a, np.zeros(more, a.dtype)]) for a in (self.start, self.count, self.score, self.loss))
        by_size: dict[int, list[int]] = {}
        for k, c in enumerate(self.new):
            by_size.setdefault(len(c) if len(c) <= SHORT and c != SPACE and "\0" not in c else 0, []).append(k)
        for k in by_size.pop(0, []):
            best = search(self.v.edges(escaped(self.new[k])), 2)
            self._put(first + k, best[0][0], best[0][0] - best[1][0] if len(best) > 1 else np.inf, best[0][1])
        for size, members in by_size.items():
            for s in range(0, len(members), 20_000):
                part = members[s:s + 20_000]
                self._batch(size, [self.new[k] for k in part], np.array(part) + first)
        self.new = []

    def _reserve(self, n: int) -> int:
        if self.used + n > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty(max(n, len(self.flat)), np.int32)])
        self.used += n
        return self.used - n

    def _put(self, at, score, loss, ids):
        s = self._reserve(len(ids))
        self.flat[s:s + len(ids)] = ids
        self.start[at], self.count[at], self.score[at], self.loss[at] = s, len(ids), score, loss

    def _batch(self, m: int, chunks: list[str], where: np.ndarray) -> None:
        v, w = self.v, len(chunks)
        codes = np.array([c.replace(" ", SPACE) for c in chunks], f"U{m}").view(np.uint32).reshape(w, m)
        longest = min(m, v.longest)
        edge = np.full((longest + 1, w, m), -1, np.int32)  # [length, chunk, start]
        h = np.zeros((w, m), np.uint64)
        for n in range(1, longest + 1):
            h = h[:, :m - n + 1] * _P + codes[:, n - 1:].astype(np.uint64) + np.uint64(1)
            edge[n, :, :m - n + 1] = v.lookup(h.ravel()).reshape(h.shape)
        size = np.where(codes < 0x80, 1, np.where(codes < 0x800, 2, np.where(codes < 0x10000, 3, 4)))
        cost = v.score_of[edge]
        alone = edge[1] < 0
        cost[1] = np.where(alone, size * v.byte_score, cost[1])
        fore = np.full((w, m + 1), -np.inf)
        fore[:, 0] = 0
        step = np.zeros((w, m + 1), np.int64)
        for j in range(1, m + 1):
            for n in range(min(j, longest), 0, -1):  # longest first: it wins ties
                got = fore[:, j - n] + cost[n, :, j - n]
                better = got > fore[:, j]
                fore[better, j] = got[better]
                step[better, j] = n
        back = np.full((w, m + 1), -np.inf)
        back[:, m] = 0
        for i in range(m - 1, -1, -1):
            for n in range(1, min(m - i, longest) + 1):
                back[:, i] = np.maximum(back[:, i], cost[n, :, i] + back[:, i + n])
        # Every other segmentation has an edge that the best one lacks.
        on = np.zeros((w, m + 1), bool)
        on[:, m] = True
        rows = np.arange(w)
        here = np.full(w, m)
        pieces = np.zeros(w, np.int64)
        hops = []
        while (live := here > 0).any():
            n = np.where(live, step[rows, here], 0)
            here = here - n
            on[rows, here] = True
            k = edge[n, rows, np.minimum(here, m - 1)]
            k = np.where(live, k, -2)
            pieces += np.where(live, np.where(k >= 0, 1, size[rows, np.minimum(here, m - 1)]), 0)
            hops.append((here, k))
        second = np.full(w, -np.inf)
        for j in range(1, m + 1):
            for n in range(1, min(j, longest) + 1):
                through = fore[:, j - n] + cost[n, :, j - n] + back[:, j]
                second = np.maximum(second, np.where(on[:, j] & (step[:, j] == n), -np.inf, through))
        base = self._reserve(int(pieces.sum()))
        starts = base + np.cumsum(pieces) - pieces
        self.start[where], self.count[where] = starts, pieces
        self.score[where], self.loss[where] = fore[:, m], np.where(np.isinf(second), np.inf, fore[:, m] - second)
        end = starts + pieces  # filled from the back
        for here, k in hops:
            known = k >= 0
            end[known] -= 1
            self.flat[end[known]] = k[known]
            for r in np.flatnonzero(k == -1):
                ids = v.spelled(chr(codes[r, here[r]]))
                end[r] -= len(ids)
                self.flat[end[r]:end[r] + len(ids)] = ids

    def gather(self, at: np.ndarray) -> np.ndarray:
        n = self.count[at]
        ends = np.cumsum(n)
        return self.flat[np.repeat(self.start[at] - (ends - n), n) + np.arange(ends[-1])]

    def nbest(self, at: int, n: int) -> list:
        got = self.lists.get(at)
        if got is None:
            got = self.lists[at] = search(self.v.edges(escaped(self.text[at])), n)
        return got


def escaped(chunk: str) -> str:
    return chunk.replace(" ", SPACE)


def encode_texts(texts: list[str], chunks: Chunks, n: int) -> list[tuple]:
    """Rows of ``SCHEMA``."""
    at = [np.array(list(map(chunks.__getitem__, _CHUNKS.findall(" " + t))), np.int64) if t else None for t in texts]
    chunks.settle()
    out = []
    for t, a in zip(texts, at, strict=True):
        if a is None:
            out.append(([], 0.0, [0.0], [[]], True))
            continue
        ids = chunks.gather(a)
        score = float(chunks.score[a].sum())
        loss = chunks.loss[a]
        k = min(n - 1, len(a))
        # Smallest losses, earlier chunks first among equal ones.
        few = np.flatnonzero(loss <= np.partition(loss, k - 1)[k - 1]) if k else np.empty(0, np.int64)
        few = few[np.argsort(loss[few], kind="stable")][:k]
        few = np.sort(few[np.isfinite(loss[few])])
        ways = [(0.0, ())]
        for p in few.tolist():
            best = chunks.nbest(int(a[p]), n)
            more = [(g + (s - best[0][0]), w + (((p, x),) if x else ())) for g, w in ways
                    for x, (s, _) in enumerate(best)]
            ways = sorted(more, key=lambda z: -z[0])[:n]
        before = np.cumsum(chunks.count[a]) - chunks.count[a]
        changes = [[{"at": int(before[p]), "drop": int(chunks.count[a[p]]),
                     "ids": list(chunks.nbest(int(a[p]), n)[x][1])} for p, x in w] for _, w in ways]
        out.append((ids, score, [score + g for g, _ in ways], changes, chunks.v.decode(ids.tolist()) == t))
    return out


def encode_nbest(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text",
                 n: int = N_BEST, byte_score: float | None = None, remembered: int = 200_000) -> DataFrame:
    """doc_id; ids and score of the best segmentation; the scores of the n best, and for each of
    them what it changes in ``ids`` (``drop`` ids from ``at`` on become ``ids``); whether decoding
    gives the text back.  One pass over whole texts, no shuffle."""
    def start():
        vocabulary = Vocabulary(model_file, byte_score)
        chunks = [Chunks(vocabulary, remembered)]

        def fn(texts):
            if len(chunks[0]) > remembered:
                chunks[0] = Chunks(vocabulary, remembered)
            rows = encode_texts(texts, chunks[0], n)
            ids = [np.asarray(r[0], np.int32) for r in rows]
            ends = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
            return {"ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids))),
                    "score": [r[1] for r in rows], "scores": [r[2] for r in rows],
                    "changes": [r[3] for r in rows], "round_trip": [r[4] for r in rows]}
        return fn

    return map_texts(id_text(docs, id_col, text_col), SCHEMA, start, block_bytes=2 << 20)


def decode(encoded: DataFrame, model_file: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, text of an array of piece ids (null: empty)."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import StringType, StructField, StructType

    rows = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))

    def run(batches):
        vocabulary = Vocabulary(model_file)
        for b in batches:
            text = [vocabulary.decode(x or ()) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(text, pa.string())], names=["doc_id", "text"])

    return rows.mapInArrow(run, StructType([rows.schema["doc_id"], StructField("text", StringType())]))
