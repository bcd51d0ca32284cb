"""Toxicity: a counterfactual-regularised linear classifier.

A logistic model over the presence of hashed words, word beginnings and word endings is
fitted with an L1 penalty (most features carry nothing) and a fairness penalty: every labelled text that mentions a group is copied with the
mention swapped for the other groups of its list, and the squared change of the score between
the text and each copy is penalised.  Words that merely name a group then carry the same,
small, weight whatever group they name, so neutral mentions stay unflagged.

The model is fitted on a sample of at most ``max_rows`` labelled rows.  Scores are computed
for every whole text.  Defined results: null and empty texts get the score of a text without
words; without any labels the score is 0.5 everywhere; repeated rows are scored alike.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termweave.llm.common import crc_of_id, id_text, map_texts, staged
from termweave.llm.learning import labelled_sample

BUCKETS = 1 << 18
MAX_ROWS = 6_000
MAX_FEATURES = 3_000
AFFIXES = (3, 4, 5, 6)
THRESHOLD = 0.7
HOLD_OUT_MOD, HOLD_OUT_REST = 3, 1
L1_PER_TEXT, LEAST_L1 = 0.5, 5e-5  # the penalty falls with the number of texts
COUNTERFACTUAL = 1.0
STEPS = 200
MIN_DF = 3

# Words that name a group, by kind.  A mention is swapped within its kind.
IDENTITY_TERMS = {
    "gender": ["women", "men", "girls", "boys", "frauen", "männer", "femmes", "hommes",
               "mujeres", "hombres"],
    "religion": ["christians", "muslims", "jews", "hindus", "buddhists", "atheists", "christen",
                 "muslime", "juden", "chrétiens", "musulmans", "juifs", "cristianos",
                 "musulmanes", "judíos"],
    "origin": ["africans", "asians", "europeans", "americans", "arabs", "latinos", "immigrants",
               "refugees", "natives", "foreigners"],
    "colour": ["black", "white", "brown"],
    "orientation": ["gay", "lesbian", "straight", "bisexual", "transgender", "queer"],
    "ability": ["deaf", "blind", "disabled", "autistic"],
    "age": ["old", "young", "elderly", "teenagers"],
}

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def bucket(feature: str, buckets: int = BUCKETS) -> int:
    return crc32(feature.encode()) % buckets


def features_of(word: str, buckets: int = BUCKETS) -> list[int]:
    """A word counts as itself, and by its beginnings and endings, so that an insulting stem
    is known in forms that the sample does not hold."""
    out = [bucket(word, buckets)]
    for n in AFFIXES:
        if len(word) > n:
            out.append(bucket(f"{word[:n]}-", buckets))
            out.append(bucket(f"-{word[-n:]}", buckets))
    return out


def swaps(words: set[str], terms: dict[str, list[str]]) -> list[tuple[str, str]]:
    """(mentioned term, term put in its place) for every counterfactual copy."""
    out = []
    for group in terms.values():
        here = words.intersection(group)
        out += [(a, b) for a in sorted(here) for b in group if b not in here]
    return out


@dataclass
class Model:
    bias: float = 0.0
    weights: dict[int, float] = field(default_factory=dict)
    buckets: int = BUCKETS

    def carried(self, word: str) -> tuple[int, ...]:
        """Features of a word that have a weight."""
        return tuple(f for f in features_of(word, self.buckets) if f in self.weights)

    def score(self, text: str) -> float:
        present = sorted({f for w in words_of(text) for f in self.carried(w)})
        return 1.0 / (1.0 + float(np.exp(-(self.bias + sum(self.weights[f] for f in present)))))


def text_features(text: str, terms: dict[str, list[str]] = IDENTITY_TERMS,
                  buckets: int = BUCKETS) -> tuple[list[int], list[int], list[int]]:
    """Features present; then, copy by copy with equal length, what a swap takes out and puts in.

    A copy is written as the features that vanish (``-f - 1``) and appear (``f``) and closed by
    the number of them, so that copies of any size fit in one list."""
    words = words_of(text)
    present = {f for w in words for f in features_of(w, buckets)}
    diff, ends = [], []
    for a, b in swaps(words, terms):
        rest = {f for w in words - {a} for f in features_of(w, buckets)}
        swapped = rest.union(features_of(b, buckets))
        diff += [-f - 1 for f in sorted(present - swapped)] + sorted(swapped - present)
        ends.append(len(diff))
    return sorted(present), diff, ends


def fit(feats: list, y, diffs: list = (), l1: float | None = None, counterfactual: float = COUNTERFACTUAL,
        steps: int = STEPS, buckets: int = BUCKETS, min_df: int = MIN_DF,
        max_features: int = MAX_FEATURES) -> Model:
    """``feats``: the features of each text; ``diffs``: the signed features of each copy.

    Features are screened by the strength of their link with the label, then accelerated
    proximal gradient minimises mean log loss + l1 * |w| + counterfactual * mean squared score
    change over the copies."""
    y = np.asarray(y, float)
    n = len(y)
    if not n:
        return Model(0.0, {}, buckets)
    if l1 is None:
        l1 = max(LEAST_L1, L1_PER_TEXT / n)
    flat = np.concatenate([np.asarray(f, np.int32) for f in feats])
    owner = np.repeat(np.arange(n, dtype=np.int32), [len(f) for f in feats])
    rate = (y.sum() + 0.5) / (n + 1.0)
    df = np.bincount(flat, minlength=buckets)
    pos = np.bincount(flat[y[owner] > 0], minlength=buckets)
    z = np.abs(pos - rate * df) / np.sqrt(rate * (1 - rate) * np.maximum(df, 1))
    z[df < min_df] = 0
    used = np.zeros(buckets, bool)
    used[np.argsort(-z, kind="stable")[:max_features]] = True
    used &= z > 0
    copies = [np.asarray(d, np.int64) for d in diffs]
    d_flat = np.concatenate(copies) if copies else np.empty(0, np.int64)
    d_owner = np.repeat(np.arange(len(copies)), [len(d) for d in copies])
    d_sign = np.where(d_flat < 0, -1.0, 1.0)
    d_flat = np.where(d_flat < 0, -d_flat - 1, d_flat)
    cols = np.flatnonzero(used)
    m = len(cols)
    at = np.full(buckets, -1, np.int64)
    at[cols] = np.arange(m)
    keep = used[flat]
    idx, owner = at[flat[keep]], owner[keep]
    keep = used[d_flat]
    d_idx, d_owner, d_sign = at[d_flat[keep]], d_owner[keep], d_sign[keep]
    w = v = np.zeros(m)
    b = vb = float(np.log(rate / (1 - rate)))
    t, lipschitz = 1.0, 1.0
    many = max(1, len(copies))

    def loss_grad(w, b):
        s = np.bincount(owner, weights=w[idx], minlength=n) + b
        p = 1.0 / (1.0 + np.exp(-s))
        loss = float(np.mean(np.logaddexp(0, s) - y * s))
        g = np.bincount(idx, weights=(p - y)[owner], minlength=m) / n
        change = np.bincount(d_owner, weights=w[d_idx] * d_sign, minlength=len(copies))
        loss += counterfactual * float(change @ change) / many
        g += (2 * counterfactual / many) * np.bincount(d_idx, weights=change[d_owner] * d_sign, minlength=m)
        return loss, g, float(np.mean(p - y))

    for _ in range(steps):
        loss, g, gb = loss_grad(v, vb)
        while True:  # backtracking: a step that the quadratic bound holds for
            new = v - g / lipschitz
            new = np.sign(new) * np.maximum(np.abs(new) - l1 / lipschitz, 0)
            new_b = vb - gb / lipschitz
            dw, db = new - v, new_b - vb
            bound = loss + g @ dw + gb * db + lipschitz / 2 * (dw @ dw + db * db)
            if loss_grad(new, new_b)[0] <= bound + 1e-12 or lipschitz > 1e9:
                break
            lipschitz *= 2
        if (v - new) @ (new - w) + (vb - new_b) * (new_b - b) > 0:  # uphill: restart the momentum
            t = 1.0
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = new + (t - 1) / t_new * (new - w), new_b + (t - 1) / t_new * (new_b - b)
        w, b, t, lipschitz = new, new_b, t_new, lipschitz * 0.9
    return Model(float(b), {int(cols[i]): float(w[i]) for i in np.flatnonzero(np.abs(w) > 1e-9)}, buckets)


def train(docs: DataFrame, labels: DataFrame, allowed: Column, label: str = "toxic",
          max_rows: int = MAX_ROWS, id_col: str = "doc_id", text_col: str = "text",
          terms: dict[str, list[str]] = IDENTITY_TERMS, buckets: int = BUCKETS, **params) -> Model:
    """Fit on at most ``max_rows`` labelled rows.  Features are counted and screened on the
    executors; the chosen ones' numbers, text by text, are all that reaches the driver."""
    def start():
        def fn(texts):
            rows = [text_features(t, terms, buckets) for t in texts]
            return {"feats": [r[0] for r in rows], "diff": [r[1] for r in rows], "ends": [r[2] for r in rows]}
        return fn

    sample = labelled_sample(docs, labels, label, allowed, max_rows, id_col, text_col)
    made = staged(map_texts(sample, "feats array<int>, diff array<int>, ends array<int>", start,
                            passed=("doc_id", "label")), "toxicity-sample")
    used = screened(made, params.get("max_features", MAX_FEATURES), params.get("min_df", MIN_DF))
    rows = only_features(made, used, buckets).toArrow().combine_chunks()
    if not rows.num_rows:
        return fit([], [], buckets=buckets, **params)
    rows = rows.sort_by([("doc_id", "ascending")]).combine_chunks()

    def lists(name):
        col = rows[name].chunk(0)
        values, offsets = col.flatten().to_numpy(), np.concatenate(
            [[0], np.cumsum(col.value_lengths().to_numpy())])
        return [values[i:j] for i, j in zip(offsets[:-1], offsets[1:], strict=True)]

    copies = [c for d, e in zip(lists("diff"), lists("ends"), strict=True)
              for c in np.split(d, e[:-1]) if len(e)]
    return fit(lists("feats"), rows["label"].to_numpy(), copies, buckets=buckets, **params)


def screened(rows: DataFrame, max_features: int, min_df: int) -> list[int]:
    """The features of the strongest link with the label, as ``fit`` chooses them."""
    n, positive = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum((F.col("label") > 0).cast("long")), F.lit(0))).first()
    rate = (positive + 0.5) / (n + 1.0)
    counts = rows.select("label", F.explode("feats").alias("f")).groupBy("f").agg(
        F.count(F.lit(1)).alias("df"), F.sum((F.col("label") > 0).cast("long")).alias("pos")).where(F.col("df") >= min_df)
    z = F.abs(F.col("pos") - rate * F.col("df")) / F.sqrt(F.lit(rate * (1 - rate)) * F.col("df"))
    top = counts.select("f", z.alias("z")).where("z > 0").orderBy(F.desc("z"), "f").limit(max_features)
    return [r["f"] for r in top.select("f").collect()]


def only_features(rows: DataFrame, used: list[int], buckets: int) -> DataFrame:
    """The rows with no other features; copies keep their number, if without features."""
    def run(batches):
        known = np.zeros(buckets, bool)
        known[used] = True
        for b in batches:
            feats, diffs, ends = [], [], []
            for f, d, e in zip(*(b.column(c) for c in (2, 3, 4)), strict=True):
                f, d, e = (np.asarray(x.values, np.int32) for x in (f, d, e))
                feats.append(f[known[f]])
                keep = known[np.where(d < 0, -d - 1, d)]
                diffs.append(d[keep])
                ends.append(np.concatenate([[0], np.cumsum(keep)]).astype(np.int32)[e])
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array(x, kind) for x in (feats, diffs, ends)]],
                                             names=["doc_id", "label", "feats", "diff", "ends"])
    return rows.select("doc_id", "label", "feats", "diff", "ends").mapInArrow(run, rows.schema)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted for every whole text; one pass, no shuffle."""
    def start():
        known: dict[str, tuple[int, ...]] = {}
        weights = model.weights

        def fn(texts):
            z = []
            for t in texts:
                if len(known) > 300_000:
                    known.clear()
                found = set()
                for w in words_of(t):
                    f = known.get(w)
                    if f is None:
                        f = known[w] = model.carried(w)
                    if f:
                        found.update(f)
                z.append(sum(weights[f] for f in sorted(found)))
            p = 1.0 / (1.0 + np.exp(-(np.array(z, float) + model.bias)))
            return {"score": pa.array(p), "predicted": pa.array((p >= threshold).astype(np.int32))}
        return fn

    return map_texts(id_text(docs, id_col, text_col), "score double, predicted int", start)


def held_out(id_col: str = "doc_id", mod: int = HOLD_OUT_MOD, rest: int = HOLD_OUT_REST) -> Column:
    return F.coalesce(F.pmod(crc_of_id(id_col), F.lit(mod)) == rest, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, **params) -> DataFrame:
    """Train on the labelled rows that are not held out, score every document."""
    model = train(docs, labels, ~held_out(), **params)
    return (score(docs, model).withColumn("held_out", held_out())
            .select("doc_id", "held_out", "score", "predicted"))
