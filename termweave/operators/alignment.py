"""A bilingual lexicon from aligned text pairs: word alignment by expectation-maximisation (IBM model 1).

``t(f | e)`` is the probability that source word ``e`` gives target word ``f``.  In every round each
target word of a pair is shared out among the pair's source words, and the one empty word every
pair has, in proportion to ``t``; the shares, summed over all pairs, give the next ``t``.

* Equal pairs are counted first and aligned once, with their number as weight.
* A target word is shared out by the ``t`` of that word alone; what all target words have in common is each
  source word's sum of shares in a round.  So target words are dealt to blocks, a pair is cut into a row per
  block (its source words, its target words of the block), and only those sums, a row per source word, are
  kept between rounds.  A block takes its words' rounds anew from them in every pass: neither the
  links (pair, source word, target word) nor ``t`` are written or shuffled, but for the last ``t``.
* A pass is one shuffle of the cut pairs and the sums by block.  In a block, links are built for
  some target words at a time, at most about ``LINKS``; a word with more is taken by slices of its pairs.
  Blocks have about ``BLOCK_WORDS`` words of text, and a word brings one pair's source text along at
  most, which bounds a block; a word that is itself in more pairs makes a larger one.
* Shares are whole millionths and probabilities whole billionths: sums don't depend on the order they are
  added in, and the result is the same on every run and any number of tasks or blocks.

Defined results: words are the lower-cased pieces between white space; null or blank texts have
no words, and a pair with such a side adds nothing; ties go to the smaller target word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termweave.functions import text as T
from termweave.operators.corpus import whitespace_tokens
from termweave.operators.parallel import PER_CORE
from termweave.session import scratch_path

ROUNDS = 4
EMPTY = ""  # the empty source word
SHARE, UNIT = 1e6, 1e9
BLOCK_WORDS = 8_000_000
LINKS = 1 << 20

CUT = "block int, weight bigint, a string, b string, sums array<bigint>"


def _written(df: DataFrame, tag: str) -> DataFrame:
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _distinct_pairs(pairs: DataFrame, src: str, tgt: str) -> DataFrame:
    """(src, tgt, weight): different pairs of word sequences, words joined by one space."""
    words = pairs.select(*[F.array_join(whitespace_tokens(F.lower(c)), " ").alias(a) for c, a in ((src, "src"), (tgt, "tgt"))])
    return words.where("src <> '' and tgt <> ''").groupBy("src", "tgt").agg(F.count(F.lit(1)).alias("weight"))


def _cut(n_blocks: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A row per pair and block with target words of the pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            row, words = _words(x["tgt"])
            words = words.dictionary_encode()
            block = np.array([crc32(w.encode()) % n_blocks for w in words.dictionary.to_pylist()], "i8")[words.indices.to_numpy()]
            order = np.argsort(row * n_blocks + block, kind="stable")
            key, first = np.unique((row * n_blocks + block)[order], return_index=True)
            lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(order)), pa.int32()), words.take(pa.array(order)).cast(pa.string()))
            at = pa.array(key // n_blocks)
            yield pa.RecordBatch.from_arrays([
                pa.array((key % n_blocks).astype("i4")), x["weight"].take(at), x["src"].take(at),
                pc.binary_join(lists, " "), pa.nulls(len(key), pa.list_(pa.int64()))],
                ["block", "weight", "a", "b", "sums"])
    return run


def _words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(row, word) of texts of words joined by one space."""
    lists = pc.split_pattern(texts.cast(pa.large_string()), " ")
    return pc.list_parent_indices(lists).to_numpy(), lists.flatten()


def _coded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(row, code, count) of the different words of texts, by row, and the words in their order."""
    row, words = _words(texts)
    words = words.dictionary_encode()
    order = pc.array_sort_indices(words.dictionary)
    code = np.empty(len(order), "i8")
    code[order.to_numpy()] = np.arange(len(order))
    key, n = np.unique(row * len(order) + code[words.indices.to_numpy()], return_counts=True)
    return key // len(order), key % len(order), n, words.dictionary.take(order)


class _Block:
    """Target words of a block: their links, and rounds over them."""

    def __init__(self, batches: Iterator[pa.RecordBatch]):
        x = pa.Table.from_batches(list(batches), None)
        x = x.set_column(2, "a", x["a"].cast(pa.large_string())).set_column(3, "b", x["b"].cast(pa.large_string()))
        x = x.combine_chunks()
        pairs, sums = x.filter(pc.is_valid(x["b"])).combine_chunks(), x.filter(pc.is_null(x["b"])).combine_chunks()
        row, e, n, self.src = _coded(pairs["a"].combine_chunks())
        n_rows, empty = len(pairs), len(self.src)
        self.src = pa.concat_arrays([self.src, pa.array([EMPTY], pa.large_string())])
        row, e, n = np.append(row, np.arange(n_rows)), np.append(e, np.full(n_rows, empty)), np.append(n, np.ones(n_rows, "i8"))
        by_row = np.argsort(row, kind="stable")
        self.e, self.n_e = e[by_row].astype("i4"), n[by_row]
        self.size = np.bincount(row, minlength=n_rows)
        self.start = np.cumsum(self.size) - self.size
        at = pc.index_in(self.src, value_set=sums["a"].combine_chunks()).to_numpy()
        known = pc.list_flatten(sums["sums"].combine_chunks()).to_numpy().reshape(len(sums), -1)
        self.sums = known[at].T.astype("f8")  # a row per round
        row, f, n, self.tgt = _coded(pairs["b"].combine_chunks())
        by_word = np.argsort(f, kind="stable")
        self.row, self.f = row[by_word], f[by_word]
        self.n_f = n[by_word] * pairs["weight"].to_numpy()[self.row]

    def chunks(self) -> Iterator[slice]:
        """Postings of whole target words, of about ``LINKS`` links."""
        first = np.flatnonzero(np.diff(self.f, prepend=-1))
        before = np.append(0, np.cumsum(self.size[self.row]))
        ends, at = np.append(first[1:], len(self.f)), 0
        while at < len(first):
            more = max(at + 1, int(np.searchsorted(before[ends], before[first[at]] + LINKS, "right")))
            yield slice(int(first[at]), int(ends[more - 1]))
            at = more

    def links(self, p: slice) -> tuple[np.ndarray, ...]:
        """(posting, place of the source word) of every link of the postings, by posting."""
        size = self.size[self.row[p]]
        start = np.cumsum(size) - size
        posting = np.repeat(np.arange(len(size)), size)
        return posting, np.arange(len(posting)) - (start - self.start[self.row[p]])[posting], start

    def rounds(self, p: slice, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(e, f, sum of shares) of the postings' links in round ``rounds``."""
        before = np.cumsum(self.size[self.row[p]])
        if before[-1] <= 2 * LINKS or self.f[p.start] != self.f[p.stop - 1]:
            posting, place, start = self.links(p)
            key, slot = np.unique((self.f[p] - self.f[p.start])[posting] * len(self.src) + self.e[place], return_inverse=True)
            e, f = key % len(self.src), key // len(self.src) + self.f[p.start]
            parts = [(slot, self.n_e[place], posting, start, self.n_f[p])]
            again = lambda: parts
        else:  # one word: a slot per source word, links by slices of its pairs
            e, f = np.arange(len(self.src)), np.full(len(self.src), self.f[p.start])
            cuts = np.unique(np.append(np.searchsorted(before, np.arange(LINKS, before[-1], LINKS)), len(before)))

            def again():
                for i, j in zip(np.append(0, cuts), cuts):
                    q = slice(p.start + int(i), p.start + int(j))
                    if i < j:
                        posting, place, start = self.links(q)
                        yield self.e[place], self.n_e[place], posting, start, self.n_f[q]
        t = np.full(len(e), int(UNIT))
        met = np.zeros(len(e), bool)
        for k in range(rounds):
            c = np.zeros(len(e), "i8")
            for slot, n_e, posting, start, n_f in again():
                part = n_e * t[slot]
                whole = np.add.reduceat(part, start).astype("f8")[posting]
                share = np.floor(np.divide(SHARE * part, whole, out=np.zeros(len(part)), where=whole > 0))
                c += np.bincount(slot, share * n_f[posting], len(e)).astype("i8")  # exact below 2^53
                met[slot] = True
            if k < rounds - 1:
                t = self.probabilities(c, e, k)
        return e[met], f[met], c[met]

    def probabilities(self, c: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
        whole = self.sums[k][e]
        return np.floor(np.divide(UNIT * c, whole, out=np.zeros(len(c)), where=whole > 0)).astype("i8")


def _sums(rounds: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(e, c): a block's shares of every source word in round ``rounds``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            c = np.zeros(len(block.src), "i8")
            for p in block.chunks():
                e, _, shares = block.rounds(p, rounds)
                np.add.at(c, e, shares)
            yield pa.RecordBatch.from_arrays([block.src.cast(pa.string()), pa.array(c)], ["e", "c"])
    return run


def _last(rounds: int, likeliest: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(e, f, t) of a block's links after ``rounds`` rounds, or of every source word's likeliest target word there."""
    def rows(block: _Block, e, f, t) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(e), 100_000):
            j = slice(i, i + 100_000)
            yield pa.RecordBatch.from_arrays([block.src.take(pa.array(e[j])).cast(pa.string()),
                                              block.tgt.take(pa.array(f[j])).cast(pa.string()), pa.array(t[j])], ["e", "f", "t"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            best_t, best_f = np.full(len(block.src), -1), np.zeros(len(block.src), "i8")
            for p in block.chunks():
                e, f, c = block.rounds(p, rounds)
                t = block.probabilities(c, e, rounds - 1)
                if not likeliest:
                    yield from rows(block, e, f, t)
                    continue
                top = best_t.copy()
                np.maximum.at(top, e, t)
                better = np.flatnonzero((t == top[e]) & (t > best_t[e]))  # words come in order: of equals, the first stays
                at, first = np.unique(e[better], return_index=True)
                best_t[at], best_f[at] = top[at], f[better[first]]
            if likeliest:
                e = np.flatnonzero(best_t >= 0)
                yield from rows(block, e, best_f[e], best_t[e])
    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    """The block of a partition, if it has pairs."""
    held = list(batches)
    if any(x["b"].null_count < len(x) for x in held):
        yield _Block(held)


def align(pairs: DataFrame, rounds: int = ROUNDS, key: str = "row_no", src: str = "src", tgt: str = "tgt",
          likeliest: bool = False, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(e, f, t): translation probabilities in billionths after ``rounds`` rounds, the empty word
    included.  ``likeliest``: of each source word, only the likeliest target word of every block of
    target words is returned, which is what ``lexicon`` chooses from."""
    if rounds < 1:
        raise ValueError("at least one round")
    spark = pairs.sparkSession
    same = _written(_distinct_pairs(pairs, src, tgt), "pairs")
    n_words = same.agg(F.coalesce(F.sum(T.word_count_clean("tgt")), F.lit(0))).first()[0]
    n_blocks = max(PER_CORE * spark.sparkContext.defaultParallelism, -(-n_words // block_words))
    cut = _written(same.mapInArrow(_cut(n_blocks), CUT), "cut")

    def blocks(sums: DataFrame) -> DataFrame:
        every = sums.select(F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"),
                            F.lit(None).cast("bigint").alias("weight"), F.col("e").alias("a"),
                            F.lit(None).cast("string").alias("b"), "sums")
        return cut.unionByName(every).repartitionById(n_blocks, "block")

    sums = _written(_first_sums(same), "sums")
    for k in range(2, rounds + 1):
        # Sums of one word may pass 2^53 but are whole; as a double they are rounded once.
        c = blocks(sums).mapInArrow(_sums(k), "e string, c bigint").groupBy("e").agg(F.sum("c").alias("c"))
        sums = _written(sums.join(c, "e").select("e", F.concat("sums", F.array("c")).alias("sums")), "sums")
    return _written(blocks(sums).mapInArrow(_last(rounds, likeliest), "e string, f string, t bigint"), "translations")


def _first_sums(same: DataFrame) -> DataFrame:
    """(e, sums): every source word's shares in the first round, when all words are alike, so that a
    pair's target words are shared out the same way."""
    words = F.array_append(F.split("src", " ", -1), F.lit(EMPTY))
    x = (same.select(F.monotonically_increasing_id().alias("pair"), words.alias("words"),
                     (F.col("weight") * T.word_count_clean("tgt")).alias("n_f"))
         .select("pair", F.size("words").alias("n"), "n_f", F.explode("words").alias("e"))
         .groupBy("pair", "n", "n_f", "e").agg(F.count(F.lit(1)).alias("n_e")))
    share = F.floor(F.lit(SHARE) * F.col("n_e").cast("double") / F.col("n").cast("double"))
    return x.groupBy("e").agg(F.array(F.sum(F.col("n_f") * share)).alias("sums"))


def lexicon(translations: DataFrame, least: int = 0) -> DataFrame:
    """(src, tgt, score): the likeliest target word of each source word whose probability is at least
    ``least`` billionths."""
    best = Window.partitionBy("e").orderBy(F.desc("t"), F.asc("f"))
    return (translations.where((F.col("e") != EMPTY) & (F.col("t") >= least))
            .withColumn("__n", F.row_number().over(best)).where("__n = 1")
            .select(F.col("e").alias("src"), F.col("f").alias("tgt"), F.col("t").alias("score")))
