"""Column functions for text rules.

Every function takes and returns ``pyspark.sql.Column`` objects, so it runs inside
whole-stage codegen; nothing here calls back into Python per row.  Regex patterns use
an explicit whitespace class equal to Python's notion of whitespace (Java's ``\\s`` is
ASCII-only and Spark's ``trim`` removes only the space character).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from termweave.functions import constants as K


def _cls(codepoints: Sequence[int], negate: bool = False) -> str:
    body = "".join(f"\\x{{{c:x}}}" for c in codepoints)
    return f"[{'^' if negate else ''}{body}]"


# Portable regex classes (Java regex and RE2 read them the same way); the oracle uses these.
WS = _cls(K.WHITESPACE_CODEPOINTS)
NON_WS = _cls(K.WHITESPACE_CODEPOINTS, negate=True)
# Java-only equivalents used by the Spark expressions: one Unicode White_Space property
# test plus the four separators Python also strips.  Same set, ~3x faster than the
# explicit class.  The inline (?U) turns on Unicode classes from that point of a pattern.
JWS = r"(?U)[\s\x{1c}-\x{1f}]"
JNON_WS = r"(?U)[^\s\x{1c}-\x{1f}]"


_END = "".join("\\" + ch for ch in K.SENTENCE_END_CHARS)


def _ASCII_DIGITS(pattern: str) -> str:
    """Java's and RE2's ``\\d`` are ASCII digits; spell that out."""
    return pattern.replace(r"\d", "[0-9]")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _any(cols: Sequence[Column]) -> Column:
    out = cols[0]
    for c in cols[1:]:
        out = out | c
    return out


def _let(x, fn) -> Column:
    """``fn`` of a value that is computed once, however often ``fn`` uses it."""
    return F.get(F.transform(F.array(x), fn), 0)


def strip(c) -> Column:
    """Python ``str.strip()``: remove Unicode whitespace at both ends."""
    return F.btrim(_col(c), F.lit(K.WHITESPACE_CHARS))


def strip_text(c) -> Column:
    """``strip`` for long strings: trimming goes through every character, so it is left out where neither
    end is white space."""
    ws = F.lit(K.WHITESPACE_CHARS)
    return _let(c, lambda s: F.when(F.contains(ws, F.substring(s, 1, 1)) | F.contains(ws, F.substring(s, -1, 1)), strip(s))
                .otherwise(s))


def strip_or_empty(c) -> Column:
    """``row.get(k, '').strip()`` where a missing CSV field is null (PRJ-3)."""
    return strip(F.coalesce(_col(c), F.lit("")))


def clean_sentence(c) -> Column:
    """SCA-1: strip, then remove one layer of matching surrounding quotes, strip again."""
    def unquoted(s):
        quoted = (F.startswith(s, F.lit('"')) & F.endswith(s, F.lit('"'))) | (
            F.startswith(s, F.lit("'")) & F.endswith(s, F.lit("'"))
        )
        inner = F.substring(s, 2, F.length(s) - 2)
        return F.when(quoted, strip_text(inner)).otherwise(s)

    return _let(strip_text(F.coalesce(_col(c), F.lit(""))), unquoted)


# What else than the two cases of a letter the pattern's (?iu) takes for it.
_FOLDED = {"i": "\u0130\u0131", "k": "\u212a", "s": "\u017f"}


def _phrase_class(k: int) -> str:
    letters = sorted({p[k] for p in K.BOILERPLATE_PHRASES})
    return "[" + "".join(c + c.upper() + _FOLDED.get(c, "") for c in letters) + "]"


# The lookahead on the phrases' first three letters lets most positions fail fast.
_BOILERPLATE_RE = f"(?={''.join(map(_phrase_class, range(3)))})(?iu)(" + "|".join(K.BOILERPLATE_PHRASES) + ")"


# A text that holds a phrase holds the phrases inside it, so only these are looked for.
_LEAST_PHRASES = [p for p in K.BOILERPLATE_PHRASES if not any(q != p and q in p for q in K.BOILERPLATE_PHRASES)]


def _may_hold_boilerplate(text: Column) -> Column:
    """False only where ``_BOILERPLATE_RE`` finds nothing: no phrase in the lower-cased text, and none of
    the letters that fold to a phrase's letter but are not lower-cased to it."""
    return _any([F.contains(text, F.lit(c)) for c in "\u0130\u0131\u017f"]) | _let(
        F.lower(text), lambda low: _any([F.contains(low, F.lit(p)) for p in _LEAST_PHRASES]))


def drop_noise(c) -> Column:
    """SCA-2 without its last steps: drop ``[...]`` (single line), ``(...)`` and boilerplate phrases.  Null
    gives ``''``.  A pattern runs only on texts that hold what it needs."""
    def without(t, held, pattern):
        return _let(t, lambda x: F.when(held(x), F.regexp_replace(x, pattern, "")).otherwise(x))

    t = F.coalesce(_col(c), F.lit(""))
    t = without(t, lambda x: F.contains(x, F.lit("[")), "(?d)" + K.BRACKET_PATTERN)  # (?d): '.' stops only at \n
    t = without(t, lambda x: F.contains(x, F.lit("(")), K.PAREN_PATTERN)
    return without(t, _may_hold_boilerplate, _BOILERPLATE_RE)


def collapse(c) -> Column:
    """SCA-2, last steps: collapse whitespace, strip (spaces: no other white space is left)."""
    return F.trim(F.regexp_replace(_col(c), JWS + "+", " "))


def clean_text(c) -> Column:
    """SCA-2: drop ``[...]`` (single line), ``(...)``, boilerplate phrases, collapse
    whitespace, strip.  Null gives ``''``."""
    return collapse(drop_noise(c))


def split_sentences(c) -> Column:
    """SCA-3: split on whitespace that follows ``.``, ``!`` or ``?``; delimiters stay."""
    return F.split(_col(c), f"(?<=[{_END}])" + JWS + "+", -1)


def split_clean_sentences(c) -> Column:
    """SCA-3 for text produced by ``clean_text``, whose white space is single spaces: a place is looked at
    only where a space is."""
    return F.split(_col(c), f" (?<=[{_END}] )", -1)


def split_uncollapsed(c) -> Column:
    """SCA-3 for a text from ``drop_noise``: a sentence that is then collapsed is the one at this place in
    the sentences of the collapsed text.  A place is looked at only where white space is."""
    return F.split(strip_text(_col(c)), JWS + f"(?<=[{_END}]" + JWS + ")" + JWS + "*", -1)


def split_examples(c) -> Column:
    """SCA-4: split on ``[.!?]`` plus whitespace (delimiter dropped), strip, drop empties."""
    parts = F.split(_col(c), f"[{_END}]" + JWS + "+", -1)
    return F.filter(F.transform(parts, strip), lambda x: x != F.lit(""))


def word_count(c) -> Column:
    """SCA-7: ``len(s.split())``."""
    return F.regexp_count(_col(c), F.lit(JNON_WS + "+"))


def contains_ci(text, term) -> Column:
    """SCA-24: case-insensitive substring test."""
    return F.contains(F.lower(_col(text)), F.lower(_col(term)))


def sentence_rejected(sentence_lower) -> Column:
    """SCA-8 rejection tests on the lower-cased sentence: too short, web noise, or a
    boilerplate prefix."""
    s = _col(sentence_lower)
    noise = _any([F.contains(s, F.lit(w)) for w in K.NOISE_WORDS])
    prefix = _any([F.startswith(s, F.lit(p)) for p in K.BOILERPLATE_PREFIXES])
    return (F.length(s) < K.MIN_SHORT_SENTENCE_CHARS) | noise | prefix


def sentence_bonus(sentence_lower, n_words, keywords) -> Column:
    """SCA-8 term-independent bonus: keywords contained, word-count range, final
    punctuation."""
    s = _col(sentence_lower)
    wc = _col(n_words)
    kw_hits = F.size(F.filter(F.coalesce(_col(keywords), F.array().cast("array<string>")),
                              lambda x: F.contains(s, x)))
    end = _any([F.endswith(s, F.lit(ch)) for ch in K.SENTENCE_END_CHARS])
    return (kw_hits * K.SCORE_PER_KEYWORD
            + F.when(wc.between(K.MIN_WORDS, K.MAX_WORDS), K.SCORE_WORDS_IN_RANGE)
            .otherwise(K.SCORE_WORDS_OUT_OF_RANGE)
            + F.when(end, K.SCORE_END_PUNCT).otherwise(K.SCORE_NO_END_PUNCT))


def sentence_base(sentence, keywords) -> Column:
    """Term-independent part of SCA-8: SCORE_REJECT for short / noisy / boilerplate
    sentences, else keyword bonus + word-count term + end-punctuation term.  Computed
    once per sentence, however many terms it meets."""
    s = F.lower(_col(sentence))
    return (F.when(sentence_rejected(s), K.SCORE_REJECT)
            .otherwise(sentence_bonus(s, word_count(_col(sentence)), keywords)).cast("int"))


def word_count_clean(c) -> Column:
    """SCA-7 for text produced by ``clean_text`` (single spaces, no edge whitespace):
    spaces + 1, without a regex.  Empty string -> 0."""
    x = _col(c)
    return F.when(x == F.lit(""), F.lit(0)).otherwise(
        F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + F.lit(1)).cast("int")


def term_score(base, sentence_lower, term_lower) -> Column:
    """SCA-8 from the per-sentence base and the lower-cased sentence and term."""
    b, s, k = _col(base), _col(sentence_lower), _col(term_lower)
    return F.when(b == K.SCORE_REJECT, b).otherwise(
        b + F.when(F.contains(s, k), K.SCORE_CONTAINS_TERM).otherwise(0)
        + F.when(F.startswith(s, k), K.SCORE_STARTS_WITH_TERM).otherwise(0)).cast("int")


def score_sentence(sentence, keyword, keywords) -> Column:
    """SCA-8 sentence score (see SURVEY §2.15).

    ``keywords`` is an ``array<string>`` column of language keywords; each one contained
    in the lower-cased sentence adds a fixed bonus once.
    """
    return term_score(sentence_base(sentence, keywords), F.lower(_col(sentence)),
                      F.lower(_col(keyword)))


def is_candidate(sentence, keyword) -> Column:
    """FIL-7 (first two tests): sentence contains the keyword case-insensitively and has
    at least MIN_WORDS words.  The third test is ``score > 0``."""
    return contains_ci(sentence, keyword) & (word_count(sentence) >= K.MIN_WORDS)


def best_sentence_of(sentences, keyword, keywords) -> Column:
    """AGG-6 over an in-row sentence array: the highest-scoring candidate, earliest on
    ties, only if its score is positive.  Returns ``struct(score, neg_pos, pos, sentence)``
    or null.  Runs per row, so no shuffle is needed when the array is already in the row.
    """
    kw = _col(keyword)
    indexed = F.transform(_col(sentences), lambda x, i: F.struct(i.alias("pos"), x.alias("sentence")))
    cands = F.filter(indexed, lambda e: is_candidate(e["sentence"], kw))
    scored = F.transform(
        cands,
        lambda e: F.struct(
            score_sentence(e["sentence"], kw, keywords).alias("score"),
            (-e["pos"]).alias("neg_pos"),
            e["pos"].alias("pos"),
            e["sentence"].alias("sentence"),
        ),
    )
    return F.array_max(F.filter(scored, lambda e: e["score"] > 0))


def last_word(c) -> Column:
    """SCA-9: ``term.split()[-1]``."""
    return F.element_at(F.split(strip(_col(c)), JWS + "+", -1), -1)


def ascii_share(c) -> Column:
    """SCA-22: share of ASCII characters, ``0`` for an empty string."""
    s = F.coalesce(_col(c), F.lit(""))
    n_ascii = F.length(F.regexp_replace(s, r"[^\x00-\x7F]", ""))
    return n_ascii / F.greatest(F.length(s), F.lit(1))


def valid_output(vi_sentence, vi_term) -> Column:
    """FIL-3: non-empty and contains the target term (case-sensitive, raw code points)."""
    s, t = _col(vi_sentence), _col(vi_term)
    return (
        s.isNotNull() & t.isNotNull() & (s != F.lit("")) & (t != F.lit("")) & F.contains(s, t)
    )


_INT_RE = r"^[+-]?[0-9]+(_[0-9]+)*$"


def python_int(c) -> Column:
    """``int(s.strip())`` as Python does it for plain decimal strings; null when Python
    would raise.  Underscore digit groups are accepted like Python."""
    s = strip(_col(c))
    return F.when(F.regexp_like(s, F.lit(_INT_RE)),
                  F.regexp_replace(s, "_", "").try_cast("bigint"))


def parse_llm_output(c) -> Column:
    """SCA-12: ``index | en | vi`` -> struct(index bigint, en string, vi string).

    Fewer than three ``|`` parts, or a first part that is not an int, give all-null.
    Parts beyond the third are ignored."""
    parts = F.split(_col(c), r"\|", -1)  # one escaped character: split without a pattern
    ok = (F.size(parts) >= 3) & python_int(F.get(parts, 0)).isNotNull()
    return F.struct(
        F.when(ok, python_int(F.get(parts, 0))).alias("index"),
        F.when(ok, strip(F.get(parts, 1))).alias("en"),
        F.when(ok, strip(F.get(parts, 2))).alias("vi"),
    )


def prepare_vi_examples(c) -> Column:
    """SCA-6: two example lines from the (cleaned) target sentence, which is split once."""
    def lines(s, parts):
        return (
            F.when(s == F.lit(""), F.lit(""))
            .when(F.size(parts) >= 2, F.array_join(F.slice(parts, 1, 2), "\n"))
            .when(F.size(parts) == 1, F.concat(F.get(parts, 0), F.lit("\n"), F.get(parts, 0)))
            .otherwise(F.concat(s, F.lit("\n"), s))
        )
    return _let(clean_sentence(c), lambda s: _let(split_examples(s), lambda parts: lines(s, parts)))


def prompt_input(index, en_term, vi_term, en_sentence, vi_examples) -> Column:
    """SCA-10: the five fields joined by one space."""
    return F.concat_ws(" ", _col(index).cast("string"), _col(en_term), _col(vi_term),
                       _col(en_sentence), _col(vi_examples))


def full_prompt(template: str, prompt_in) -> Column:
    """SCA-10: template, blank line, prompt input."""
    return F.concat(F.lit(template + "\n\n"), _col(prompt_in))


def retry_prompt(prompt_in, vi_term) -> Column:
    """SCA-11: base prompt input plus the retry instruction."""
    head, tail = K.RETRY_INSTRUCTION.split("{term}")
    return F.concat(_col(prompt_in), F.lit(head), _col(vi_term), F.lit(tail))


def url_quote(c) -> Column:
    """SCA-14: ``urllib.parse.quote(s)`` (safe ``/``) from Spark's form encoder."""
    q = F.url_encode(_col(c))
    for a, b in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        q = F.replace(q, F.lit(a), F.lit(b))
    return q


def search_queries(term, lang) -> Column:
    """SCA-13: ordered query strings for a term: quoted term plus a language suffix."""
    t = _col(term)
    quoted = F.concat(F.lit('"'), t, F.lit('"'))

    def arr(suffixes):
        return F.array(*[F.concat(quoted, F.lit(sfx)) for sfx in suffixes])

    return F.when(_col(lang) == F.lit("en"), arr(K.SEARCH_QUERY_SUFFIXES["en"])).otherwise(
        arr(K.SEARCH_QUERY_SUFFIXES["vi"]))


def default_keywords(lang) -> Column:
    """Default clinical keyword array for a language column ('en' or the other)."""
    en = F.array(*[F.lit(x) for x in K.CLINICAL_KEYWORDS["en"]])
    vi = F.array(*[F.lit(x) for x in K.CLINICAL_KEYWORDS["vi"]])
    return F.when(_col(lang) == F.lit("en"), en).otherwise(vi)


def map_lines(m) -> Column:
    """SCA-18: ``key: value`` lines of a map in its entry order."""
    return F.array_join(
        F.transform(F.map_entries(_col(m)), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n"
    )


def report_score(text) -> Column:
    """SCA-17 on one line: the first decimal number of a line that mentions ``BLEU`` or
    ``score`` (case-insensitive for ``score``), else null."""
    t = _col(text)
    hit = F.contains(t, F.lit("BLEU")) | F.contains(F.lower(t), F.lit("score"))
    num = F.regexp_extract(t, f"({_ASCII_DIGITS(K.DECIMAL_PATTERN)})", 1)
    return F.when(hit & (num != F.lit("")), num.cast("double"))


def json_line(*cols) -> Column:
    """SCA-16: ``json.dumps(obj, ensure_ascii=False)`` of a flat record; null fields are
    written as ``null`` rather than dropped.  (Key order follows the columns; the
    separators are Spark's compact ones.)"""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
