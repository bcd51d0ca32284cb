"""JOIN-1: containment (theta) join of texts with dictionary terms.

``contains_join(texts, terms, text_col, term_col, on)`` returns every (text row, term
row) pair with ``term`` a substring of ``text`` (both already lower-cased by the caller
when case-insensitive semantics are wanted), equal on the ``on`` keys.  An empty term
matches nothing, whichever plan runs.

Two exact plans:

* **broadcast** — the term table is small (its row count is checked first): broadcast
  hash join on ``on`` with a ``contains`` residual.  No shuffle of the text side.
* **anchor-gram** — large dictionaries: every term picks its rarest character trigram
  (frequency estimated on a hash sample of the texts) as anchor, a shorter term itself;
  texts explode their *distinct* grams of those lengths and probe the anchor table with
  an equi-join on ``(on, gram)``; candidates are verified with ``contains``.  A term
  contained in a text has all its trigrams there, so no pair is lost whichever anchor
  was chosen.  The anchor table (one row per term) is broadcast below a checked size.  Beyond
  it, given the texts' id columns, only ids and grams are shuffled, and texts are fetched once
  per row with a candidate; without ids the rows go along (AQE splits skewed gram keys).

A dictionary beyond the broadcast plan is mostly terms of letters alone.  Such a term lies inside one
run of letters, so the anchor plan meets the *distinct* runs of all texts with them once (runs shorter
than every term left out, anchors as long as the shortest term), and texts probe the resulting table,
a row per run with the list of its terms: a text's grams are never exploded.  Terms with any other
character go by the texts' own grams.

``contains_pairs`` gives the same pairs without the texts, for texts that are costly to make: their runs
are written once.

The right-hand keys are renamed before either join and dropped by name, so the texts and
the terms may come from the same frame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termweave.operators.parallel import BROADCAST_BYTES, fits
from termweave.session import scratch_path

# Measured crossover (sf0.1, best-sentence plan): broadcast wins at 500 terms, the anchor
# join at 2,000; nested-loop work grows with terms x sentences, anchor work barely does.
BROADCAST_TERM_LIMIT = 1_000
GRAM = 3
SAMPLE_ONE_IN = 50


def grams(c, n: int = GRAM):
    """Distinct character n-grams of a string column (empty for shorter strings)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.length(c) < n, F.array().cast("array<string>")).otherwise(F.array_distinct(
        F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - n + 1, F.lit(1))),
                    lambda i: F.substring(c, i, n))))


def _right_keys(df: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(f"__k_{c}") if c in on else F.col(c) for c in df.columns])


def _same_keys(on: Sequence[str]) -> list:
    return [F.col(k) == F.col(f"__k_{k}") for k in on]


def _broadcast_join(texts: DataFrame, terms: DataFrame, text_col: str, term_col: str,
                    on: Sequence[str]) -> DataFrame:
    cond = [*_same_keys(on), F.contains(F.col(text_col), F.col(term_col))]
    joined = texts.join(F.broadcast(_right_keys(terms, on)), cond, "inner")
    return joined.drop(*[f"__k_{k}" for k in on])


def _anchor_join(texts: DataFrame, terms: DataFrame, text_col: str, term_col: str,
                 on: Sequence[str], sample_one_in: int = SAMPLE_ONE_IN,
                 broadcast_bytes: int = BROADCAST_BYTES, ids: Sequence[str] | None = None,
                 gram: int = GRAM) -> DataFrame:
    """``gram``: length of the anchors; a shorter term is its own."""
    on = list(on)
    distinct = terms.select(*on, term_col).distinct()
    long_t = distinct.where(F.length(term_col) >= gram)
    term_grams = long_t.select(*on, term_col, F.explode(grams(term_col, gram)).alias("gram"))
    # Gram frequencies from a sample of the texts, chosen by a hash of the text so that a
    # recomputed partition chooses alike.  They only steer the choice of anchor (any
    # gram of a term is a correct anchor), so the result stays exact; a rare anchor
    # keeps both the candidate count and the per-key skew low.
    sample = texts.where(F.pmod(F.xxhash64(text_col), F.lit(sample_one_in)) == 0).select(
        *on, F.explode(grams(text_col, gram)).alias("gram"))
    freq = (sample.join(term_grams.select(*on, "gram").distinct(), on + ["gram"], "left_semi")
            .groupBy(*on, "gram").agg(F.count(F.lit(1)).alias("__freq")))
    anchors = (term_grams.join(freq, on + ["gram"], "left")
               .groupBy(*on, term_col)
               .agg(F.min_by("gram", F.struct(F.coalesce("__freq", F.lit(0)), "gram")).alias("__anchor")))
    short = distinct.where((F.length(term_col) < gram) & (F.col(term_col) != ""))
    anchors = anchors.unionByName(short.withColumn("__anchor", F.col(term_col)))
    anchored = terms.join(anchors, on + [term_col])
    # Lengths of the anchors in use: at most ``gram`` numbers.
    sizes = sorted(r[0] for r in terms.where(F.length(term_col) > 0)
                   .select(F.least(F.length(term_col), F.lit(gram))).distinct().collect())
    every = F.concat(*[grams(text_col, n) for n in sizes]) if sizes else F.array().cast("array<string>")
    side = _right_keys(anchored, on)
    if fits(anchored, broadcast_bytes):
        side = F.broadcast(side)
    elif ids is not None:
        return _late_join(texts, anchored, every, text_col, term_col, on, list(ids), broadcast_bytes)
    x = texts.select("*", F.explode(every).alias("__gram"))
    cond = [*_same_keys(on), F.col("__gram") == F.col("__anchor"), F.contains(F.col(text_col), F.col(term_col))]
    return x.join(side, cond, "inner").drop(*[f"__k_{k}" for k in on], "__gram", "__anchor")


def _late_join(texts: DataFrame, anchored: DataFrame, every, text_col: str, term_col: str,
               on: list[str], ids: list[str], broadcast_bytes: int) -> DataFrame:
    """The anchor plan when the anchors must be hash-joined: only row ids and grams are exploded,
    reduced to grams that are anchors (distinct grams are few) and shuffled; what they meet is
    gathered per row id, and the text is fetched once per row that has a candidate and verified."""
    keys = [*ids, *[k for k in on if k not in ids]]
    g = texts.select(*keys, F.explode(every).alias("__gram"))
    known = anchored.select(*on, F.col("__anchor").alias("__gram")).distinct()
    g = g.join(F.broadcast(known) if fits(known, broadcast_bytes) else known, [*on, "__gram"], "left_semi")
    side = _right_keys(anchored, on)
    rest = [c for c in anchored.columns if c not in on and c != "__anchor"]
    met = g.join(side, [*_same_keys(on), F.col("__gram") == F.col("__anchor")])
    lists = met.groupBy(*keys).agg(F.collect_list(F.struct(*rest)).alias("__ts"))
    lists = lists.select(*[F.col(k).alias(f"__i_{k}") for k in keys], "__ts")
    x = texts.join(lists, [F.col(k) == F.col(f"__i_{k}") for k in keys])
    held = F.filter("__ts", lambda t: F.contains(F.col(text_col), t[term_col]))
    return x.select(*texts.columns, F.inline(held))


def _letter_runs(text_col: str, least: int):
    """A text's distinct runs of ``least`` and more letters."""
    return F.array_distinct(F.regexp_extract_all(F.col(text_col), F.lit(rf"\p{{L}}{{{least},}}"), F.lit(0)))


def _least_length(terms: DataFrame, term_col: str) -> int:
    return terms.agg(F.min(F.length(term_col))).first()[0]


def _written(df: DataFrame, tag: str, **options: str) -> DataFrame:
    path = scratch_path(df.sparkSession, tag)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _runs_join(rows: DataFrame, terms: DataFrame, runs_col: str, term_col: str, on: list[str], least: int,
               broadcast_bytes: int, once: bool = True) -> tuple[DataFrame, int]:
    """Pairs, and their number to a factor of two.

    The anchor plan for terms of letters alone, of ``least`` and more: it joins the rows' distinct runs of
    letters with the terms; rows meet the runs' lists of terms by an equi-join.  The runs that rows hold most
    often, as many as may be broadcast, are met in place; only rows of the rarer ones are shuffled.  With
    ``once``, a term that several runs of a row hold is kept with the first only: a run comes with the
    runs before it, which must not hold the term."""
    keep, rest = [c for c in rows.columns if c != runs_col], [c for c in terms.columns if c not in on]
    # How often a run is met, as a power of two.
    known = _written(rows.select(*on, F.explode(runs_col).alias("__run")).groupBy(*on, "__run").agg(
        F.floor(F.log2(F.count(F.lit(1)))).alias("__often")), "runs")
    met = _anchor_join(known, terms, "__run", term_col, on, broadcast_bytes=broadcast_bytes, gram=max(GRAM, least))
    held = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c, t in terms.dtypes if c in rest and t == "string"), F.lit(40))
    lists = _written(met.groupBy(*on, "__run", "__often").agg(
        F.collect_list(F.struct(*rest)).alias("__ts"), F.sum(held).alias("__bytes")), "run-terms")
    least_often, about = _broadcast_from(lists, broadcast_bytes)
    side = _right_keys(lists.drop("__bytes"), on).withColumnRenamed("__run", "__of")
    often = F.col("__often") >= least_often
    same = [*_same_keys(on), F.col("__run") == F.col("__of")]
    joined = [F.concat(F.lit(" "), F.array_join(runs_col, " "), F.lit(" ")).alias("__joined")] if once else []
    x = rows.select(*keep, *joined, F.explode(runs_col).alias("__run"))

    def with_before(df: DataFrame, *more: str) -> DataFrame:
        """Only rows whose run has terms need the runs before it."""
        if not once:
            return df
        before = F.call_function("substring_index", F.col("__joined"), F.concat(F.lit(" "), F.col("__run"), F.lit(" ")), F.lit(1))
        return df.select(*keep, "__run", before.alias("__before"), *more)

    def pairs(met: DataFrame) -> DataFrame:
        if not once:
            return met.select(*keep, F.inline("__ts"))
        new = ~F.contains(F.col("__before"), F.col(term_col))
        return met.select(*keep, "__before", F.inline("__ts")).where(new).drop("__before")

    found = pairs(with_before(x.join(F.broadcast(side.where(often).drop("__often")), same), "__ts"))
    if least_often == 0:
        return found, about
    rare = side.where(~often).drop("__often")
    others = x.join(F.broadcast(side.where(often).select(*[c for c in side.columns if c not in ("__often", "__ts")])),
                    same, "left_anti")
    return found.unionByName(pairs(with_before(others).join(rare.hint("shuffle_hash"), same))), about


def _broadcast_from(lists: DataFrame, broadcast_bytes: int) -> tuple[int, int]:
    """The least ``__often`` from which the runs' lists may be broadcast, and about how many pairs
    the lists give (a row per power of two)."""
    size = F.sum(F.col("__bytes") + F.octet_length("__run") + F.lit(96))
    rows = lists.groupBy("__often").agg(size.alias("size"), F.sum(F.size("__ts").cast("bigint")).alias("n")).collect()
    held = {r["__often"]: r["size"] for r in rows}
    least, total = max(held, default=-1) + 1, 0
    while least > 0 and total + held.get(least - 1, 0) <= broadcast_bytes:
        least -= 1
        total += held.get(least, 0)
    return least, sum(r["n"] << r["__often"] for r in rows)


def _strategy(terms: DataFrame, strategy: str, broadcast_limit: int) -> str:
    if strategy == "auto":
        return "broadcast" if fits(terms, BROADCAST_BYTES, broadcast_limit) else "anchor"
    if strategy not in ("broadcast", "anchor"):
        raise ValueError(f"unknown strategy {strategy!r}")
    return strategy


def _by_letters(terms: DataFrame, term_col: str) -> tuple[DataFrame | None, DataFrame | None]:
    """Terms of letters alone and the others; None where there are none (if there are none at all, they count as others)."""
    lettered = F.regexp_like(F.col(term_col), F.lit(r"^\p{L}+$"))
    letters, others = terms.where(lettered), terms.where(~lettered)
    some = not letters.isEmpty()
    return letters if some else None, others if not some or not others.isEmpty() else None


def contains_pairs(texts: DataFrame, terms: DataFrame, text_col: str, term_col: str, keep: Sequence[str],
                   on: Sequence[str] = (), strategy: str = "auto", ids: Sequence[str] | None = None,
                   once: bool = True, broadcast_limit: int = BROADCAST_TERM_LIMIT,
                   broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``contains_pairs_sized`` without the number."""
    return contains_pairs_sized(texts, terms, text_col, term_col, keep, on, strategy, ids, once, broadcast_limit, broadcast_bytes)[0]


def contains_pairs_sized(texts: DataFrame, terms: DataFrame, text_col: str, term_col: str, keep: Sequence[str],
                         on: Sequence[str] = (), strategy: str = "auto", ids: Sequence[str] | None = None,
                         once: bool = True, broadcast_limit: int = BROADCAST_TERM_LIMIT,
                         broadcast_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, int | None]:
    """The pairs of ``contains_join`` as the texts' columns ``keep`` (``on`` among them), the terms' columns and
    ``at_start``, whether the text starts with the term.  Without ``once``, a pair may come several times.
    Beyond the broadcast plan, ``keep`` and the texts' runs of letters are written, so that what makes the texts
    runs once for them.  The number is that of pairs with terms of letters, to a factor of two; None where the
    plan doesn't tell."""
    keep, on = list(keep), list(on)
    terms = terms.where(F.col(term_col) != "")
    rest = [c for c in terms.columns if c not in on]

    def started(df: DataFrame, text: str) -> DataFrame:
        return df.select(*keep, *rest, F.startswith(F.col(text), F.col(term_col)).alias("at_start"))

    if _strategy(terms, strategy, broadcast_limit) == "broadcast":
        return started(_broadcast_join(texts, terms, text_col, term_col, on), text_col), None
    letters, others = _by_letters(terms, term_col)
    parts, about = [], None
    if letters is not None:
        least = _least_length(letters, term_col)
        # Words hardly repeat inside a page: dictionaries cost time only.
        rows = _written(texts.select(*keep, F.regexp_extract(text_col, r"^\p{L}+", 0).alias("__head"),
                                     _letter_runs(text_col, least).alias("__runs")).where(F.size("__runs") > 0),
                        "letter-runs", **{"parquet.enable.dictionary": "false", "compression": "zstd"})
        met, about = _runs_join(rows, letters, "__runs", term_col, on, least, broadcast_bytes, once)
        parts.append(started(met, "__head"))
    if others is not None:
        parts.append(started(_anchor_join(texts, others, text_col, term_col, on, broadcast_bytes=broadcast_bytes, ids=ids),
                             text_col))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]), about


def contains_join(texts: DataFrame, terms: DataFrame, text_col: str, term_col: str,
                  on: Sequence[str] = (), strategy: str = "auto",
                  broadcast_limit: int = BROADCAST_TERM_LIMIT, ids: Sequence[str] | None = None,
                  broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Exact containment join; see module doc.  ``strategy`` is ``auto``, ``broadcast``
    or ``anchor``.  ``auto`` measures the terms once and broadcasts only up to
    ``broadcast_limit`` rows of ``BROADCAST_BYTES``.  Empty terms are dropped first.
    ``ids``: columns that identify a row of ``texts`` (without nulls); with them, a dictionary
    whose anchors exceed ``broadcast_bytes`` is joined without moving the texts' grams along
    with the texts."""
    terms, on = terms.where(F.col(term_col) != ""), list(on)
    if _strategy(terms, strategy, broadcast_limit) == "broadcast":
        return _broadcast_join(texts, terms, text_col, term_col, on)
    letters, others = _by_letters(terms, term_col)
    parts = []
    if letters is not None:
        least = _least_length(letters, term_col)
        rows = texts.withColumn("__runs", _letter_runs(text_col, least))
        parts.append(_runs_join(rows, letters, "__runs", term_col, on, least, broadcast_bytes)[0])
    if others is not None:
        parts.append(_anchor_join(texts, others, text_col, term_col, on, broadcast_bytes=broadcast_bytes, ids=ids))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
