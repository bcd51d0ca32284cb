"""Quality classifier: hashed word n-gram logistic regression, trained with FTRL.

A text becomes a sparse vector of hashed n-grams: runs of one and two words as they stand, and
runs of one to three word shapes (letters and digits reduced to their class, runs shortened,
a word equal to the one before it marked), which carry over to words never seen.  Counts are
damped by a logarithm and the vector is scaled to length one.  Weights are learnt one text at a
time with per-coordinate follow-the-regularised-leader steps; a score is the sparse dot product
of vector and weights through the logistic function.

The model is fitted on at most ``max_rows`` labelled rows, in the order of a hash of their id.
Every whole text is scored.  Defined results: null and empty texts have no n-grams and get the
score of the bias; without any labels every score is 0.5; repeated rows are scored alike.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termweave.llm.common import crc_of_id, id_text, map_texts
from termweave.llm.learning import labelled_sample

BITS = 18
MAX_ROWS = 6_000
EPOCHS = 2
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.1, 0.1
THRESHOLD = 0.3
HOLD_OUT_MOD, HOLD_OUT_REST = 5, 0

_RUNS = re.compile(r"(?P<u>[^\W\d_a-zß-öø-ÿ]{2,})|(?P<l>[^\W\d_]+)|(?P<d>\d+)|(?P<s>(.)\5*)", re.S)
_TAIL = re.compile(r"(.)\1+", re.S)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SALTS = [np.uint64(s) for s in (0x1B873593, 0x2545F491, 0x27D4EB2F, 0x165667B1, 0x85EBCA77)]


def shape(word: str) -> str:
    """Word class: a run of capitals to A, other letters to a, digits to 0, a repeated sign to
    one.  Plain words, with or without signs behind them, take a short way to the same result."""
    core = word.rstrip(".,;:!?*#$%&|<>")
    if core.isascii() and core.isalpha():
        if core.islower() or core[1:].islower() or len(core) == 1:
            return "a" + (_TAIL.sub(r"\1", word[len(core):]) if len(core) < len(word) else "")
        if core.isupper():
            return "A" + (_TAIL.sub(r"\1", word[len(core):]) if len(core) < len(word) else "")
    return _RUNS.sub(lambda m: "A" if m["u"] else "a" if m["l"] else "0" if m["d"] else m["s"][0], word)


class _Index(dict):
    """Word to position; a new word gets its hashes on first sight."""

    def __init__(self, room: int):
        self.word_hash = np.empty(room, np.uint64)
        self.shape_hash = np.empty(room, np.uint64)

    def __missing__(self, word: str) -> int:
        i = self[word] = len(self)
        self.word_hash[i] = crc32(word.encode())
        self.shape_hash[i] = crc32(shape(word).encode())
        return i


class Hasher:
    """Texts to (sorted bucket numbers, values); remembers words between texts."""

    def __init__(self, bits: int = BITS, remembered: int = 300_000):
        self.bits, self.remembered = bits, remembered
        self.index = _Index(remembered)

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        words = text.split()
        if not words:
            return np.empty(0, np.int64), np.empty(0)
        if len(self.index) + len(words) > len(self.index.word_hash):
            self.index = _Index(max(self.remembered, len(words)))
        at = np.array(list(map(self.index.__getitem__, words)))
        w, s = self.index.word_hash[at], self.index.shape_hash[at]
        same = np.zeros(len(at), bool)
        same[1:] = at[1:] == at[:-1]
        s[same] = np.uint64(1)
        grams = [w * _MIX + _SALTS[0], (w[:-1] * _SALTS[1] + w[1:]) * _MIX + _SALTS[1],
                 s * _MIX + _SALTS[2], (s[:-1] * _SALTS[1] + s[1:]) * _MIX + _SALTS[3],
                 ((s[:-2] * _SALTS[1] + s[1:-1]) * _SALTS[1] + s[2:]) * _MIX + _SALTS[4]]
        b = (np.concatenate(grams) >> np.uint64(64 - self.bits)).astype(np.int64)
        idx, n = np.unique(b, return_counts=True)
        v = 1.0 + np.log(n)
        return idx, v / np.sqrt(v @ v)


@dataclass
class Model:
    bias: float
    weights: np.ndarray
    bits: int

    def score(self, idx: np.ndarray, values: np.ndarray) -> float:
        return 1.0 / (1.0 + float(np.exp(-(self.bias + self.weights[idx] @ values))))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], bits: int = BITS, epochs: int = EPOCHS,
        alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2) -> Model:
    """FTRL-proximal: z and n per coordinate; a weight is zero while |z| <= l1."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    bz = bn = 0.0

    def weights(z, n):
        w = -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2)
        return np.where(np.abs(z) <= l1, 0.0, w)

    for _ in range(epochs):
        for idx, v, y in rows:
            zi, ni = z[idx], n[idx]
            w = weights(zi, ni)
            bw = -bz / ((beta + bn ** 0.5) / alpha)
            g0 = 1.0 / (1.0 + np.exp(-np.clip(w @ v + bw, -30, 30))) - y
            g = g0 * v
            g2 = g * g
            z[idx] = zi + g - (np.sqrt(ni + g2) - np.sqrt(ni)) / alpha * w
            n[idx] = ni + g2
            bz += g0 - ((bn + g0 * g0) ** 0.5 - bn ** 0.5) / alpha * bw
            bn += g0 * g0
    return Model(float(-bz / ((beta + bn ** 0.5) / alpha)), weights(z, n), bits)


def train(docs: DataFrame, labels: DataFrame, allowed: Column, label: str = "quality",
          max_rows: int = MAX_ROWS, id_col: str = "doc_id", text_col: str = "text",
          bits: int = BITS, **params) -> Model:
    """Fit on at most ``max_rows`` labelled rows; only hashed vectors reach the driver."""
    def start():
        hasher = Hasher(bits)

        def fn(texts):
            vectors = [hasher(t) for t in texts]
            return {"idx": [i.astype(np.int32) for i, _ in vectors],
                    "val": [v.astype(np.float32) for _, v in vectors]}
        return fn

    sample = labelled_sample(docs, labels, label, allowed, max_rows, id_col, text_col)
    got = map_texts(sample.withColumn("turn", F.xxhash64("doc_id")), "idx array<int>, val array<float>",
                    start, passed=("doc_id", "label", "turn")).toArrow()
    got = got.sort_by([("turn", "ascending"), ("doc_id", "ascending")]).combine_chunks()
    if not got.num_rows:
        return Model(0.0, np.zeros(1 << bits), bits)
    idx, val = got["idx"].chunk(0), got["val"].chunk(0)
    ends = np.cumsum(idx.value_lengths().to_numpy())[:-1]
    rows = zip(np.split(idx.flatten().to_numpy().astype(np.int64), ends),
               np.split(val.flatten().to_numpy().astype(float), ends), got["label"].to_pylist(), strict=True)
    return fit(list(rows), bits, **params)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted for every whole text; one pass, no shuffle."""
    def start():
        hasher = Hasher(model.bits)

        def fn(texts):
            p = np.array([model.score(*hasher(t)) for t in texts], float)
            return {"score": pa.array(p), "predicted": pa.array((p >= threshold).astype(np.int32))}
        return fn

    return map_texts(id_text(docs, id_col, text_col), "score double, predicted int", start)


def held_out(id_col: str = "doc_id", mod: int = HOLD_OUT_MOD, rest: int = HOLD_OUT_REST) -> Column:
    return F.coalesce(F.pmod(crc_of_id(id_col), F.lit(mod)) == rest, F.lit(False))


def quality(docs: DataFrame, labels: DataFrame, **params) -> DataFrame:
    """Train on the labelled rows that are not held out, score every document."""
    model = train(docs, labels, ~held_out(), **params)
    return (score(docs, model).withColumn("held_out", held_out())
            .select("doc_id", "held_out", "score", "predicted"))
