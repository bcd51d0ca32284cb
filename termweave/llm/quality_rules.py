"""Compression-band quality rules.

Text that a general compressor shrinks far more than prose of its length is repetitive;
text that it hardly shrinks is noise.  Each document is compressed whole, and again in fixed
chunks, so that a repetitive stretch inside a long clean text is seen as well.  Ratios are
held against bands that depend on the length, because short inputs compress less.

What is compressed is not UTF-8, which spends two to four bytes on a letter of most scripts and so
compresses better the farther a script is from ASCII, but a form of about one byte a letter (see
``units``); lengths, chunks and bands count its bytes.  The last chunk may be short and is held
against the band of its own length.

Defined results: null and empty text have no words (``base_failed``); a text shorter than two
chunks is judged by its whole-document band only; repeated rows give repeated results.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termweave.llm.common import WORD_SPACE, id_text, map_texts

# Fixed values: (least units, lowest ratio, highest ratio) of zstandard level 3.
# Highest ratios lie about a tenth above what clean labelled prose of that length reaches,
# lowest ones well below it.
BANDS = [
    (0, 0.00, 1.20),
    (64, 0.60, 1.60),
    (128, 0.80, 2.10),
    (256, 1.00, 2.15),
    (512, 1.10, 2.25),
    (1024, 1.20, 2.40),
    (2048, 1.25, 2.50),
    (4096, 1.30, 2.60),
    (8192, 1.30, 2.70),
    (16384, 1.30, 2.80),
    (32768, 1.30, 2.95),
    (131072, 1.30, 3.20),
]
CHUNK_BYTES = 1024
MAX_BAD_CHUNKS = 0.25  # as a share of the text's units
LEVEL = 3

MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PERCENT = 30
_SYMBOLS = "#*$%&|<>"

SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "n_bytes long, n_units long, ratio double, n_chunks long, n_low_chunks long, n_high_chunks long, "
          "low_units long, high_units long")

# Han signs carry as much as a short word, Hangul syllables two or three letters.
_HAN = re.compile("[\u2e80-\u303f\u3100-\u31ef\u3200-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
_HANGUL = re.compile("[\uac00-\ud7a3]")
_ASCII = {i: i for i in range(128)}
_SINGLE = 112


def units(text: str) -> bytes:
    """The text in about as many bytes as it has letters, whatever its script.

    ASCII stands for itself.  Other characters are numbered by how often the text has them: letters
    and signs of short syllabaries take one byte (the rarest of more than 112 two), Hangul syllables
    two, and Han signs keep the three or four bytes of UTF-8."""
    if text.isascii():
        return text.encode()
    n = Counter(text)
    table, single, double = dict(_ASCII), 0, 0
    for c in sorted((c for c in n if c >= "\x80"), key=lambda c: (-n[c], c)):
        if _HAN.match(c):
            table[ord(c)] = c.encode().decode("latin-1")
        elif single < _SINGLE and not _HANGUL.match(c):
            table[ord(c)] = 0x80 + single
            single += 1
        else:
            table[ord(c)] = chr(0xF0 + double // 256 % 16) + chr(double % 256)
            double += 1
    return text.translate(table).encode("latin-1")


def repeat_words(words: list, window: int = REPEAT_WINDOW) -> int:
    """Words that lie in a window of ``window`` words which occurs more than once."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    grams = list(zip(*(words[i:] for i in range(window)), strict=False))
    if len(set(grams)) == n:
        return 0
    seen: dict = {}
    twice = set()
    for g in grams:
        if g in seen:
            twice.add(g)
        else:
            seen[g] = True
    covered = upto = 0
    for i, g in enumerate(grams):
        if g in twice:
            covered += i + window - max(i, upto)
            upto = i + window
    return covered


def dup_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = text.split("\n")
    if len(lines) < 2:
        return 0
    worded = [x for x in lines if x.strip(WORD_SPACE)]
    return len(worded) - len(set(worded))


def _prepare(bands, chunk_bytes, level):
    def start():
        import zstandard

        z = zstandard.ZstdCompressor(level=level, write_content_size=True)
        floors = [b[0] for b in bands]
        limits = [b[1:] for b in bands]

        def chunks(u):
            """Chunks of ``u``, those below and above their band, and the units in these."""
            got = [0] * 5
            for i in range(0, len(u), chunk_bytes):
                part = u[i:i + chunk_bytes]
                r = len(part) / len(z.compress(part))
                lowest, highest = limits[bisect_right(floors, len(part)) - 1]
                got[0] += 1
                got[1] += r < lowest
                got[2] += r > highest
                got[3] += len(part) * (r < lowest)
                got[4] += len(part) * (r > highest)
            return got

        symbols = re.compile("[" + re.escape(_SYMBOLS) + "]")

        def fn(texts):
            out = {k.split()[0]: [] for k in SCHEMA.split(", ")}
            for t in texts:
                b = t.encode()
                words = b.split()
                u = units(t)
                row = (len(words), len(t) - sum(map(t.count, WORD_SPACE)), len(symbols.findall(t)),
                       dup_lines(t), repeat_words(words), len(b), len(u),
                       len(u) / len(z.compress(u)) if u else 0.0,
                       *(chunks(u) if len(u) >= 2 * chunk_bytes else [0] * 5))
                for k, v in zip(out, row, strict=True):
                    out[k].append(v)
            return out
        return fn
    return start


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands=BANDS,
            chunk_bytes: int = CHUNK_BYTES, level: int = LEVEL) -> DataFrame:
    """Counts and compression ratios per document; one pass, no shuffle."""
    return map_texts(id_text(docs, id_col, text_col), SCHEMA, _prepare(bands, chunk_bytes, level))


def judge(measured: DataFrame, bands=BANDS, max_bad_chunks: float = MAX_BAD_CHUNKS) -> DataFrame:
    """Adds ``base_failed``, ``reason`` (null if kept) and ``kept``."""
    low = F.lit(bands[0][1])
    high = F.lit(bands[0][2])
    for floor, lo, hi in bands[1:]:
        low = F.when(F.col("n_units") >= floor, F.lit(lo)).otherwise(low)
        high = F.when(F.col("n_units") >= floor, F.lit(hi)).otherwise(high)
    base_failed = ((F.col("n_words") < MIN_WORDS)
                   | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    reason = (F.when(F.col("n_words") < MIN_WORDS, "few_words")
              .when(base_failed, "repeated_windows")
              .when(F.col("ratio") > high, "repetitive")
              .when(F.col("ratio") < low, "incompressible")
              .when(F.col("high_units") > max_bad_chunks * F.col("n_units"), "repetitive_chunks")
              .when(F.col("low_units") > max_bad_chunks * F.col("n_units"), "incompressible_chunks"))
    return (measured.withColumn("base_failed", base_failed)
            .withColumn("reason", reason).withColumn("kept", F.col("reason").isNull()))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands=BANDS,
                  chunk_bytes: int = CHUNK_BYTES, max_bad_chunks: float = MAX_BAD_CHUNKS,
                  level: int = LEVEL) -> DataFrame:
    return judge(measure(docs, id_col, text_col, bands, chunk_bytes, level), bands, max_bad_chunks)
