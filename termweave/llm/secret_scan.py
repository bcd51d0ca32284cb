"""Secret scan: fixed patterns, and a randomness test battery for everything else.

Assignments, access keys and long hexadecimal runs are found by pattern.  Other tokens that
might be keys (all long runs of letters, digits and the signs of base64) are tested for randomness.  The
encoding is inferred from the characters, as the smallest of the known alphabets that holds
them, and gives each character its number.  Three tests follow:

* chi-squared: how uniformly the alphabet is used;
* runs: how often neighbours change between the lower and the upper half of the alphabet;
* serial correlation of neighbouring numbers.

Runs and serial correlation must be those of independent characters.  The chi-squared value is
held against what ordinary text of the same length in that alphabet gives: the p-value is the
probability that such text looks as uniform as this token.  It falls with the length, as short
tokens cannot be told apart well.  The false discovery rate is controlled over all candidates of
the corpus, separately by length band and by whether a token holds both a digit and a letter (long
words, which do not, would raise the limit for those that do): discoveries are those below the largest p-value that the
step-up rule allows (p-values are rounded up to a fixed grid, so the rule works on counts).

Built-in functions only; one pass over the texts, whose spans are written to the shared folder.

Candidates are runs of 20 and more characters; shorter keys are found by the patterns only, as the
tests cannot tell them from words.  Where patterns found spans in a token, what is left before,
between and behind them is tested, each piece of that length by itself.

Defined results: null and empty texts have no spans; repeated rows are scanned alike; an empty table
has no rows.  Texts are scanned whole, however long.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termweave.llm.common import id_text, staged
from termweave.llm.native_spans import found, normal_cdf, replaced

# Kinds in the order of listing, and their patterns.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = (r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
          r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""")
ASSIGN_HEAD = r"""^[A-Za-z_]+["']?\x20*[:=]\x20*["']?"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_VALUE = 12

# Encodings from small to large alphabet; the characters in order, and how much
# further from uniform ordinary text is, per character (alphabet size times the probability that
# two characters are equal, less one).
DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()
ENCODINGS = {
    "hex": (DIGITS + "abcdef", 0.9),
    "hex_upper": (DIGITS + "ABCDEF", 0.9),
    "base32": (UPPER + "234567", 1.0),
    "base36": (DIGITS + LOWER, 1.2),
    "base36_upper": (DIGITS + UPPER, 1.2),
    "base62": (UPPER + LOWER + DIGITS, 2.1),
    "base64": (UPPER + LOWER + DIGITS + "+/", 2.2),
    "base64_url": (UPPER + LOWER + DIGITS + "-_", 2.2),
    "base64_any": (UPPER + LOWER + DIGITS + "+/-_", 2.4),
}
TOKEN = r"[A-Za-z0-9+/_-]{20,}"
BANDS = (20, 28, 40, 64)
FALSE_DISCOVERIES = 0.05
MOST_DEVIATION = 3.0
GRID = 20.0  # steps per power of ten of the p-value


def _as_spans(hits: Column, kind: str, keep=None) -> Column:
    if keep is not None:
        hits = F.filter(hits, keep)
    return F.transform(hits, lambda h: F.struct(
        F.lit(kind).alias("kind"), F.lit(KINDS.index(kind)).alias("rank"),
        h["start"].alias("start"), h["end"].alias("end")))


def _encoding(token: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, (alphabet, _) in reversed(ENCODINGS.items()):
        out = F.when(F.translate(token, alphabet, "") == "", name).otherwise(out)
    return out


def _by_encoding(encoding: Column, values: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])[encoding]


def battery(token: Column) -> Column:
    """struct<encoding, z_runs, z_serial, p_text> of a token."""
    def tested(t, enc):
        alphabet = _by_encoding(enc, {k: a for k, (a, _) in ENCODINGS.items()})
        halves = _by_encoding(enc, {k: "L" * (len(a) // 2) + "H" * (len(a) - len(a) // 2)
                                    for k, (a, _) in ENCODINGS.items()})
        size = F.length(alphabet).cast("double")
        excess = _by_encoding(enc, {k: x for k, (_, x) in ENCODINGS.items()})
        n = F.length(t).cast("double")
        chars = F.split(t, "")
        squares = F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda s, c: s + F.pow(
            n - F.length(F.replace(t, c, F.lit(""))), F.lit(2.0)))
        chi = size / n * squares - n
        away = excess * n
        z_text = (chi - (size - 1 + away)) / F.sqrt(2 * (size - 1 + 2 * away))
        bits = F.call_function("translate", t, alphabet, halves)
        high = F.length(F.replace(bits, F.lit("L"), F.lit(""))).cast("double")
        runs = 1 + F.regexp_count(bits, F.lit("(?<=L)H|(?<=H)L"))
        two = 2 * high * (n - high)
        spread = F.sqrt(F.greatest(two * (two - n) / (n * n * (n - 1)), F.lit(1e-9)))
        z_runs = F.when((high == 0) | (high == n), F.lit(99.0)).otherwise((runs - 1 - two / n) / spread)
        x = F.transform(chars, lambda c: F.call_function("locate", c, alphabet).cast("double"))
        mean = F.aggregate(x, F.lit(0.0), lambda s, v: s + v) / n
        sq = F.aggregate(x, F.lit(0.0), lambda s, v: s + v * v) - n * mean * mean
        lag = F.aggregate(F.zip_with(F.slice(x, F.lit(1), F.length(t) - 1), F.slice(x, F.lit(2), F.length(t) - 1),
                                     lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
        ends = n * mean * 2 - x[0] - F.element_at(x, -1)
        cov = lag - mean * ends + (n - 1) * mean * mean
        z_serial = F.when(sq <= 0, F.lit(99.0)).otherwise((cov / sq + 1 / n) * F.sqrt(n))
        return F.struct(enc.alias("encoding"), z_runs.alias("z_runs"), z_serial.alias("z_serial"),
                        normal_cdf(z_text).alias("p_text"))

    return tested(token, _encoding(token))


def _outside(token: Column, spans: Column) -> Column:
    """The stretches of a token that no span covers, as long as tokens must be."""
    touching = F.filter(spans, lambda b: (b["start"] < token["end"]) & (token["start"] < b["end"]))

    def blanked(t, b):
        at = F.greatest(b["start"] - token["start"], F.lit(0))
        size = F.least(b["end"], token["end"]) - token["start"] - at
        return F.overlay(t, F.repeat(F.lit(" "), size), at + 1, size)

    left = F.transform(found(F.aggregate(touching, token["match"], blanked), TOKEN), lambda h: F.struct(
        (token["start"] + h["start"]).alias("start"), (token["start"] + h["end"]).alias("end"), h["match"].alias("match")))
    return F.when(F.size(touching) == 0, F.array(token)).otherwise(left)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base (array of spans), tokens (tested candidates outside them)."""
    rows = id_text(docs, id_col, text_col)
    text = F.col("text")
    hits = rows.select("doc_id", found(text, ASSIGN).alias("h_assign"), found(text, ACCESS).alias("h_access"),
                       found(text, HEX).alias("h_hex"), found(text, TOKEN).alias("h_token"))
    base = hits.select("doc_id", "h_token", F.concat(
        _as_spans(F.col("h_assign"), "assign", lambda h: F.length(
            F.regexp_replace(h["match"], ASSIGN_HEAD, "")) >= ASSIGN_VALUE),
        _as_spans(F.col("h_access"), "access"), _as_spans(F.col("h_hex"), "hex")).alias("base"))
    apart = F.when(F.size("base") == 0, F.col("h_token")).otherwise(
        F.flatten(F.transform("h_token", lambda h: _outside(h, F.col("base")))))
    cands = base.select("doc_id", "base", apart.alias("h_token"))
    return cands.select("doc_id", "base", F.transform("h_token", lambda h: F.struct(
        h["start"].alias("start"), h["end"].alias("end"),
        (h["match"].rlike("[0-9]") & h["match"].rlike("[A-Za-z]")).alias("mixed"),
        battery(h["match"]).alias("test"))).alias("tokens"))


def _band(t: Column) -> Column:
    """Number of a token's length band, even or odd by whether it holds both a digit and a letter."""
    length = t["end"] - t["start"]
    return 2 * sum(((length >= b).cast("int") for b in BANDS), F.lit(0)) + t["mixed"].cast("int")


def _step(p: Column) -> Column:
    """Grid step of a p-value; the step's own p-value is never smaller."""
    return F.floor(-GRID * F.log10(F.greatest(p, F.lit(1e-30)))).cast("int")


def _plausible(t: Column, most: float) -> Column:
    return (F.abs(t["test"]["z_runs"]) <= most) & (F.abs(t["test"]["z_serial"]) <= most)


def discovery_steps(scanned: DataFrame, rate: float = FALSE_DISCOVERIES,
                    most: float = MOST_DEVIATION) -> DataFrame:
    """band, step: the least grid step that counts as a discovery, by length band.

    All candidates of a band are tests.  At most bands x grid steps rows are ranked."""
    t = scanned.select(F.explode("tokens").alias("t"))
    counts = t.select(_band(F.col("t")).alias("band"),
                      F.when(_plausible(F.col("t"), most), _step(F.col("t.test.p_text"))).otherwise(-1).alias("step")
                      ).groupBy("band", "step").agg(F.count("*").alias("n"))
    by = Window.partitionBy("band")
    ranked = counts.select("band", "step", F.sum("n").over(by).alias("tests"),
                           F.sum("n").over(by.orderBy(F.col("step").desc())).alias("found"))
    return (ranked.where((F.col("step") >= 0) & (F.pow(F.lit(10.0), -F.col("step") / GRID)
                                                 <= rate * F.col("found") / F.col("tests")))
            .groupBy("band").agg(F.min("step").alias("step")))


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            rate: float = FALSE_DISCOVERIES, most: float = MOST_DEVIATION, rescan: bool = False) -> DataFrame:
    """doc_id, base, spans: arrays of struct<kind, rank, start, end>; one row per input row.

    What the scan finds is written to the shared folder between counting and deciding; with
    ``rescan`` it is computed a second time instead, for keys as wide as a row."""
    scanned = scan(docs, id_col, text_col)
    if not rescan:
        scanned = staged(scanned, "secrets")
    steps = discovery_steps(scanned, rate, most)
    by_band = {r["band"]: r["step"] for r in steps.collect()}  # two rows per length band at most
    limits = {b: by_band.get(b, 10 ** 6) for b in range(2 * len(BANDS) + 2)}
    least = lambda t: _by_encoding(_band(t), limits)
    random = F.filter("tokens", lambda t: _plausible(t, most) & (
        _step(t["test"]["p_text"]) >= least(t)))
    return scanned.select("doc_id", "base", F.concat("base", F.transform(random, lambda t: F.struct(
        F.lit("random").alias("kind"), F.lit(KINDS.index("random")).alias("rank"),
        t["start"].alias("start"), t["end"].alias("end")))).alias("spans"))


def redacted(text: Column, spans: Column, by: str = "[secret]") -> Column:
    return replaced(text, spans, by)
