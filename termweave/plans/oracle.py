"""DuckDB oracle SQL for every registered query.

Each query is written independently in SQL over the driver tables (views named like
the tables).  Shared derived views (FIXTURES.md §3) are CTEs assembled on demand by
``sql(body, *ctes)``.  SQL helpers below mirror the rules of
``termweave.functions.text`` in DuckDB dialect (RE2 regex, no lookbehind).
"""

from __future__ import annotations

from termweave.functions import constants as K
from termweave.functions.text import NON_WS, WS

# -- expression helpers -----------------------------------------------------

WS_CHARS = "(" + " || ".join(f"chr({c})" for c in K.WHITESPACE_CODEPOINTS) + ")"
_END = "".join("\\" + ch for ch in K.SENTENCE_END_CHARS)


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"trim({x}, {WS_CHARS})"


def clean_sentence(x: str) -> str:
    s = strip(f"coalesce({x}, '')")
    return (f"(CASE WHEN (starts_with({s}, '\"') AND ends_with({s}, '\"')) "
            f"OR (starts_with({s}, '''') AND ends_with({s}, '''')) "
            f"THEN {strip(f'substring({s}, 2, length({s}) - 2)')} ELSE {s} END)")


def clean_text(x: str) -> str:
    t = f"coalesce({x}, '')"
    t = f"regexp_replace({t}, {q(K.BRACKET_PATTERN)}, '', 'g')"
    t = f"regexp_replace({t}, {q(K.PAREN_PATTERN)}, '', 'g')"
    t = f"regexp_replace({t}, {q('(?i)(' + '|'.join(K.BOILERPLATE_PHRASES) + ')')}, '', 'g')"
    t = f"regexp_replace({t}, {q(WS + '+')}, ' ', 'g')"
    return strip(t)


def split_sentences(x: str) -> str:
    marked = f"regexp_replace({x}, {q('([' + _END + '])' + WS + '+')}, '\\1' || chr(1), 'g')"
    return f"string_split({marked}, chr(1))"


def split_examples(x: str) -> str:
    marked = f"regexp_replace({x}, {q('[' + _END + ']' + WS + '+')}, chr(1), 'g')"
    return (f"list_filter(list_transform(string_split({marked}, chr(1)), lambda p: {strip('p')}), "
            f"lambda p: p <> '')")


def word_count(x: str) -> str:
    return f"len(regexp_extract_all({x}, {q(NON_WS + '+')}))"


def score_sentence(s: str, k: str, kws: str) -> str:
    sl, kl = f"lower({s})", f"lower({k})"
    noise = " OR ".join(f"contains({sl}, {q(w)})" for w in K.NOISE_WORDS)
    prefix = " OR ".join(f"starts_with({sl}, {q(p)})" for p in K.BOILERPLATE_PREFIXES)
    wc = word_count(s)
    return f"""(CASE WHEN length({sl}) < {K.MIN_SHORT_SENTENCE_CHARS} THEN {K.SCORE_REJECT}
        WHEN {noise} OR {prefix} THEN {K.SCORE_REJECT}
        ELSE (CASE WHEN contains({sl}, {kl}) THEN {K.SCORE_CONTAINS_TERM} ELSE 0 END)
           + (CASE WHEN starts_with({sl}, {kl}) THEN {K.SCORE_STARTS_WITH_TERM} ELSE 0 END)
           + {K.SCORE_PER_KEYWORD} * len(list_filter(coalesce({kws}, []::VARCHAR[]), lambda x: contains({sl}, x)))
           + (CASE WHEN {wc} BETWEEN {K.MIN_WORDS} AND {K.MAX_WORDS} THEN {K.SCORE_WORDS_IN_RANGE}
                   ELSE {K.SCORE_WORDS_OUT_OF_RANGE} END)
           + (CASE WHEN regexp_matches({sl}, '[.!?]\\z') THEN {K.SCORE_END_PUNCT}
                   ELSE {K.SCORE_NO_END_PUNCT} END)
        END)::INTEGER"""


# -- shared views -------------------------------------------------------------

CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, body: str, *deps: str) -> None:
    CTES[name] = (body, deps)


def sql(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in CTES[n][1]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    parts = []
    for n in order:
        text = CTES[n][0]
        mat = " MATERIALIZED" if n == "d" else ""
        parts.append(f"{n} AS{mat} (\n{text}\n)")
    return "WITH " + ",\n".join(parts) + "\n" + body


cte("d", "SELECT doc_id, text, lang FROM documents")
cte("ranked", """
SELECT lang, term, df, rk FROM (
  SELECT lang, term, count(*) AS df,
         row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, term) AS rk
  FROM (SELECT DISTINCT doc_id, lang, t AS term
        FROM (SELECT doc_id, lang, unnest(string_split_regex(lower(text), '[^\\p{L}]+')) AS t
              FROM d WHERE lang IN ('en', 'fr', 'de', 'es'))
        WHERE length(t) >= 5)
  GROUP BY lang, term)
WHERE rk <= 69 OR df >= 12""", "d")
cte("terms", "SELECT lang, term, rk FROM ranked WHERE df >= 12", "ranked")
cte("term_counts", "SELECT lang, count(*) AS n_terms FROM terms GROUP BY lang", "terms")
cte("keywords", "SELECT lang, term AS keyword FROM ranked WHERE rk BETWEEN 51 AND 69", "ranked")
cte("kw", "SELECT lang, list(keyword ORDER BY keyword) AS keywords FROM keywords GROUP BY lang",
    "keywords")
cte("dclean", f"SELECT doc_id, lang, {clean_text('text')} AS clean FROM d", "d")
cte("sents", f"""
SELECT doc_id, lang, pos, sentence FROM (
  SELECT doc_id, lang, unnest(arr) AS sentence, generate_subscripts(arr, 1) - 1 AS pos
  FROM (SELECT doc_id, lang, {split_sentences('clean')} AS arr FROM dclean))
WHERE sentence <> ''""", "dclean")
cte("sent_scores", f"""
SELECT s.doc_id, s.lang, s.pos, t.term, s.sentence,
       {word_count('s.sentence')}::INTEGER AS n_words,
       {score_sentence('s.sentence', 't.term', 'k.keywords')} AS score
FROM (SELECT *, lower(sentence) AS low FROM sents) s JOIN terms t ON s.lang = t.lang AND contains(s.low, t.term)
LEFT JOIN kw k ON k.lang = s.lang""", "sents", "terms", "kw")


# -- queries -------------------------------------------------------------------

ORACLE: dict[str, str] = {}

ORACLE["best_sentence"] = sql("""
SELECT doc_id, lang, term, pos::INTEGER AS pos, sentence, score FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, term ORDER BY score DESC, pos) AS rn
  FROM sent_scores WHERE n_words >= 8 AND score > 0)
WHERE rn = 1""", "sent_scores")

cte("dictionary", """
SELECT lang, t AS term FROM (
  SELECT DISTINCT doc_id, lang, t FROM (
    SELECT doc_id, lang, unnest(string_split_regex(lower(text), '[^\\p{L}]+')) AS t FROM d) WHERE length(t) >= 5)
GROUP BY lang, t HAVING count(*) >= 12""", "d")
ORACLE["best_sentence_anchor"] = sql(f"""
SELECT doc_id, lang, term, pos::INTEGER AS pos, score FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, term ORDER BY score DESC, pos) AS rn FROM (
    SELECT s.doc_id, s.lang, s.pos, t.term, {score_sentence('s.sentence', 't.term', 'k.keywords')} AS score
    FROM (SELECT *, lower(sentence) AS low FROM sents WHERE {word_count('sentence')} >= 8) s
    JOIN dictionary t ON s.lang = t.lang AND contains(s.low, t.term) LEFT JOIN kw k ON k.lang = s.lang)
  WHERE score > 0)
WHERE rn = 1""", "sents", "dictionary", "kw")

ORACLE["sentence_scores"] = sql("""
SELECT doc_id, lang, pos::INTEGER AS pos, term, n_words, score FROM sent_scores""", "sent_scores")

ORACLE["clean_text"] = sql("SELECT doc_id, clean FROM dclean", "dclean")

ORACLE["split_sentences"] = sql(f"""
SELECT doc_id, pos::INTEGER AS pos, sentence, {word_count('sentence')}::INTEGER AS n_words
FROM sents""", "sents")


# -- prompting -------------------------------------------------------------------

INT_RE = q(r"^[+-]?[0-9]+(_[0-9]+)*$")


def python_int(x: str) -> str:
    s = strip(x)
    return f"(CASE WHEN regexp_matches({s}, {INT_RE}) THEN TRY_CAST(replace({s}, '_', '') AS BIGINT) END)"


def prepare_vi_examples(x: str) -> str:
    s = clean_sentence(x)
    parts = split_examples(s)
    return (f"(CASE WHEN {s} = '' THEN '' "
            f"WHEN len({parts}) >= 2 THEN {parts}[1] || chr(10) || {parts}[2] "
            f"WHEN len({parts}) = 1 THEN {parts}[1] || chr(10) || {parts}[1] "
            f"ELSE {s} || chr(10) || {s} END)")


cte("pairs", """
SELECT e.lang AS src_lang, f.lang AS tgt_lang, e.rk AS term_id, e.term AS en_term, f.term AS vi_term
FROM terms e JOIN terms f ON e.rk = f.rk AND (e.lang = 'en' AND f.lang = 'fr' OR e.lang = 'de' AND f.lang = 'es')""", "terms")
cte("en_docs", f"""
SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) AS row_no,
       {split_sentences(clean_text('text'))} AS sents
FROM d WHERE lang IN ('en', 'de')""", "d")
cte("fr_docs", f"""
SELECT CASE lang WHEN 'fr' THEN 'en' ELSE 'de' END AS src_lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS fr_no,
       count(*) OVER (PARTITION BY lang) AS n, {clean_text('text')} AS fr_text
FROM d WHERE lang IN ('fr', 'es')""", "d")
_EN_S = ("coalesce(list_filter(e.sents, lambda s: contains(lower(s), lower(o.en_term)))[1], "
         "e.sents[1], '')")
cte("own_tokens", """
SELECT doc_id, arg_min(t, md5(doc_id::VARCHAR || ':' || t)) AS en_term FROM (
  SELECT DISTINCT doc_id, unnest(string_split_regex(lower(text), '[^\\p{L}]+')) AS t
  FROM d WHERE lang IN ('en', 'de'))
WHERE length(t) >= 5 GROUP BY doc_id""", "d")
cte("rows", f"""
SELECT e.row_no,
  CASE e.doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'x' WHEN 2 THEN e.doc_id::VARCHAR
       ELSE '  ' || e.doc_id::VARCHAR || ' ' END AS "index",
  CASE WHEN e.doc_id % 17 = 0 THEN '' WHEN e.doc_id % 7 = 3 THEN reverse(o.en_term) ELSE o.en_term END AS "English",
  CASE WHEN e.doc_id % 19 = 0 THEN '  ' ELSE p.vi_term END AS "Vietnamese",
  CASE WHEN e.doc_id % 5 = 0 THEN '"' || {_EN_S} || '"' ELSE {_EN_S} END AS "English Sentence",
  CASE WHEN e.doc_id % 23 = 0 THEN '' ELSE coalesce(f.fr_text, '') END AS "Vietnamese Sentence"
FROM en_docs e
LEFT JOIN own_tokens o USING (doc_id)
LEFT JOIN pairs p ON p.src_lang = e.lang AND p.en_term = o.en_term
LEFT JOIN fr_docs f ON f.src_lang = e.lang AND f.fr_no = e.row_no % f.n""",
    "en_docs", "fr_docs", "pairs", "own_tokens")
cte("indexed", f"""
SELECT * EXCLUDE (pidx, "index"),
       coalesce(pidx, sum(CASE WHEN pidx IS NULL THEN 1 ELSE 0 END)
                      OVER (ORDER BY row_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT
         AS "index",
       pidx IS NULL AS is_auto
FROM (SELECT *, {python_int('coalesce("index", \'\')')} AS pidx FROM rows)""", "rows")
cte("validated", f"""
SELECT *,
  CASE WHEN en_term = '' THEN {q(K.REASON_MISSING_EN_TERM)}
       WHEN vi_term = '' THEN {q(K.REASON_MISSING_VI_TERM)}
       WHEN en_sentence = '' THEN {q(K.REASON_MISSING_EN_SENTENCE)}
       WHEN vi_sentence = '' THEN {q(K.REASON_MISSING_VI_SENTENCE)}
       WHEN NOT contains(lower(en_sentence), lower(en_term))
         THEN {q(K.REASON_TERM_NOT_IN_SENTENCE.split('{term}')[0])} || en_term
              || {q(K.REASON_TERM_NOT_IN_SENTENCE.split('{term}')[1])}
  END AS reason
FROM (SELECT *, {strip('coalesce("English", \'\')')} AS en_term,
             {strip('coalesce("Vietnamese", \'\')')} AS vi_term,
             {clean_sentence('"English Sentence"')} AS en_sentence,
             {clean_sentence('"Vietnamese Sentence"')} AS vi_sentence
      FROM indexed)""", "indexed")
cte("accepted", """
SELECT *, concat_ws(' ', "index"::VARCHAR, en_term, vi_term, en_sentence, vi_examples) AS prompt_input
FROM (SELECT *, {ex} AS vi_examples FROM validated WHERE reason IS NULL)""".replace(
    "{ex}", prepare_vi_examples("vi_sentence")), "validated")

_VALID = "\"index\"::VARCHAR || ' | ' || en_sentence || ' | ' || vi_term || ' ' || vi_sentence"
_NOTERM = "\"index\"::VARCHAR || ' | ' || en_sentence || ' | ' || vi_sentence"
_TWO = "\"index\"::VARCHAR || ' | ' || en_sentence"
_NONINT = "'x | ' || en_sentence || ' | ' || vi_term || ' ' || vi_sentence"
_ERR = q("LLM API error: timeout")
cte("attempts", f"""
SELECT row_no, 0 AS attempt,
  CASE row_no % 6 WHEN 0 THEN {_VALID} WHEN 1 THEN {_NOTERM} WHEN 2 THEN {_NOTERM}
       WHEN 3 THEN NULL WHEN 4 THEN {_TWO} ELSE {_NONINT} END AS raw_response,
  CASE row_no % 6 WHEN 3 THEN {_ERR} ELSE 'success' END AS error
FROM accepted
UNION ALL
SELECT row_no, 1 AS attempt,
  CASE row_no % 6 WHEN 0 THEN {_NOTERM} WHEN 1 THEN {_VALID} WHEN 2 THEN {_NOTERM}
       WHEN 3 THEN NULL WHEN 4 THEN {_TWO} ELSE {_NONINT} END,
  CASE row_no % 6 WHEN 3 THEN {_ERR} ELSE 'success' END
FROM accepted
UNION ALL
SELECT row_no, 2 AS attempt,
  CASE row_no % 6 WHEN 2 THEN {_NOTERM} WHEN 3 THEN {_VALID} WHEN 4 THEN '' ELSE NULL END,
  CASE row_no % 6 WHEN 5 THEN {_ERR} ELSE 'success' END
FROM accepted WHERE row_no % 6 NOT IN (0, 1)""", "accepted")
cte("parsed", f"""
SELECT row_no, attempt, raw_response, error,
  CASE WHEN ok THEN pidx END AS parsed_index,
  CASE WHEN ok THEN {strip('parts[2]')} END AS en_echo,
  CASE WHEN ok THEN {strip('parts[3]')} END AS vi_gen,
  coalesce(ok, false) AS parsed
FROM (SELECT *, len(parts) >= 3 AND pidx IS NOT NULL AS ok
      FROM (SELECT *, {python_int('parts[1]')} AS pidx
            FROM (SELECT *, string_split(raw_response, '|') AS parts FROM attempts)))""", "attempts")
cte("att_v", """
SELECT p.*, (p.raw_response IS NOT NULL AND p.raw_response <> '' AND p.vi_gen IS NOT NULL
             AND p.vi_gen <> '' AND a.vi_term <> '' AND contains(p.vi_gen, a.vi_term)) AS valid
FROM parsed p JOIN accepted a USING (row_no)""", "parsed", "accepted")
cte("resolved", f"""
SELECT a.row_no, a."index", a.en_term, a.vi_term, a.en_sentence, a.prompt_input,
  CASE WHEN r.fv IS NOT NULL THEN 'success'
       WHEN coalesce(l.raw_response, '') <> '' THEN {q(K.STATUS_FAILED_VALIDATION)} || l.error
       ELSE {q(K.STATUS_FAILED_API)} || l.error END AS status,
  CASE WHEN r.fv IS NOT NULL THEN f.raw_response
       WHEN coalesce(l.raw_response, '') <> '' THEN l.raw_response ELSE '' END AS raw_response,
  CASE WHEN r.fv IS NOT NULL THEN f.vi_gen END AS vi_sentence_gen
FROM accepted a
JOIN (SELECT row_no, min(attempt) FILTER (WHERE valid) AS fv, max(attempt) AS la
      FROM att_v GROUP BY row_no) r USING (row_no)
LEFT JOIN att_v f ON f.row_no = r.row_no AND f.attempt = r.fv
JOIN att_v l ON l.row_no = r.row_no AND l.attempt = r.la""", "att_v", "accepted")
cte("rejects", """
SELECT row_no, "index", coalesce("English", '') AS en_term, coalesce("Vietnamese", '') AS vi_term, reason
FROM validated WHERE reason IS NOT NULL
UNION ALL
SELECT row_no, "index", en_term, vi_term, status AS reason FROM resolved WHERE status <> 'success'""",
    "validated", "resolved")

ORACLE["clean_quotes"] = sql(f"""
SELECT row_no, {clean_sentence('"English Sentence"')} AS en_clean,
       {clean_sentence('"Vietnamese Sentence"')} AS vi_clean FROM rows""", "rows")
ORACLE["auto_index"] = sql('SELECT row_no, "index", is_auto FROM indexed', "indexed")
ORACLE["validate_rows"] = sql('SELECT row_no, "index", reason FROM validated', "validated")
ORACLE["vi_examples"] = sql("SELECT row_no, vi_examples FROM accepted", "accepted")
ORACLE["prompt_text"] = sql(f"""
SELECT row_no, "index", prompt_input,
       {q(K.DEFAULT_PROMPT_TEMPLATE + chr(10) + chr(10))} || prompt_input AS full_prompt,
       {q(K.DEFAULT_PROMPT_TEMPLATE + chr(10) + chr(10))} || prompt_input
         || {q(K.RETRY_INSTRUCTION.split('{term}')[0])} || vi_term
         || {q(K.RETRY_INSTRUCTION.split('{term}')[1])} AS retry_prompt
FROM accepted""", "accepted")
ORACLE["parse_responses"] = sql(
    "SELECT row_no, attempt, parsed_index, en_echo, vi_gen, parsed FROM parsed", "parsed")
ORACLE["resolve_attempts"] = sql(
    'SELECT row_no, "index", prompt_input, raw_response, status FROM resolved', "resolved")
ORACLE["synthetic_pairs"] = sql("""
SELECT row_no, "index", en_term, vi_term, en_sentence, vi_sentence_gen
FROM resolved WHERE status = 'success'""", "resolved")
ORACLE["reject_table"] = sql("SELECT * FROM rejects", "rejects")
ORACLE["reject_reasons"] = sql("SELECT reason, count(*) AS n FROM rejects GROUP BY reason", "rejects")
ORACLE["run_counts"] = sql("""
SELECT outcome, count(*) AS n FROM (
  SELECT CASE WHEN status = 'success' THEN 'success' ELSE 'failed' END AS outcome FROM resolved
  UNION ALL SELECT 'failed' FROM validated WHERE reason IS NOT NULL)
GROUP BY outcome""", "resolved", "validated")


# -- evaluation --------------------------------------------------------------------

# The symbols that stand alone.
_SYMBOLS = r"""([ !"#$%&()*+/:;<=>?@\[\\\]^_`{|}~])"""


def tokens(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, {q(WS + '+')}), lambda t: t <> '')"


def tokenize_13a(x: str) -> str:
    s = f"replace(replace(replace({x}, '<skipped>', ''), '-' || chr(10), ''), chr(10), ' ')"
    s = f"replace(replace(replace(replace({s}, '&quot;', '\"'), '&amp;', '&'), '&lt;', '<'), '&gt;', '>')"
    s = f"(' ' || {s} || ' ')"
    s = f"regexp_replace({s}, {q(_SYMBOLS)}, ' \\1 ', 'g')"
    s = f"regexp_replace({s}, '([^0-9])([.,])', '\\1 \\2 ', 'g')"
    s = f"regexp_replace({s}, '([.,])([^0-9])', ' \\1 \\2', 'g')"
    s = f"regexp_replace({s}, '([0-9])(-)', '\\1 \\2 ', 'g')"
    return tokens(s)


cte("refs", "SELECT item_id AS line_no, replace(text, chr(10), ' ') AS text FROM benchmark")
cte("preds", """
SELECT 'baseline' AS system, line_no,
       array_to_string(list_filter(string_split(text, ' '), lambda w, i: i % 5 <> 0), ' ') AS text
FROM refs
UNION ALL
SELECT 'tuned' AS system, line_no,
       array_to_string(list_filter(string_split(text, ' '), lambda w, i: i % 9 <> 0), ' ') AS text
FROM refs""", "refs")
cte("bl_lines", f"""
SELECT p.system, p.line_no, {tokenize_13a('p.text')} AS ht, {tokenize_13a('r.text')} AS rt
FROM preds p JOIN refs r USING (line_no)""", "preds", "refs")
cte("bl_h", """
SELECT system, line_no, n, gram, count(*) AS h FROM (
  SELECT system, line_no, n, array_to_string(ht[i:i + n - 1], ' ') AS gram
  FROM (SELECT system, line_no, ht, n, unnest(generate_series(1, len(ht) - n + 1)) AS i
        FROM bl_lines, (SELECT unnest([1, 2, 3, 4]) AS n)))
GROUP BY ALL""", "bl_lines")
cte("bl_r", """
SELECT system, line_no, n, gram, count(*) AS r FROM (
  SELECT system, line_no, n, array_to_string(rt[i:i + n - 1], ' ') AS gram
  FROM (SELECT system, line_no, rt, n, unnest(generate_series(1, len(rt) - n + 1)) AS i
        FROM bl_lines, (SELECT unnest([1, 2, 3, 4]) AS n)))
GROUP BY ALL""", "bl_lines")
cte("bl_stats", """
SELECT l.system, l.sys_len, l.ref_len, l.t1, l.t2, l.t3, l.t4,
       coalesce(c.c1, 0)::BIGINT AS c1, coalesce(c.c2, 0)::BIGINT AS c2,
       coalesce(c.c3, 0)::BIGINT AS c3, coalesce(c.c4, 0)::BIGINT AS c4
FROM (SELECT system, sum(len(ht))::BIGINT AS sys_len, sum(len(rt))::BIGINT AS ref_len,
             sum(greatest(len(ht) - 0, 0))::BIGINT AS t1, sum(greatest(len(ht) - 1, 0))::BIGINT AS t2,
             sum(greatest(len(ht) - 2, 0))::BIGINT AS t3, sum(greatest(len(ht) - 3, 0))::BIGINT AS t4
      FROM bl_lines GROUP BY system) l
LEFT JOIN (SELECT h.system,
             sum(CASE WHEN h.n = 1 THEN least(h.h, coalesce(r.r, 0)) ELSE 0 END) AS c1,
             sum(CASE WHEN h.n = 2 THEN least(h.h, coalesce(r.r, 0)) ELSE 0 END) AS c2,
             sum(CASE WHEN h.n = 3 THEN least(h.h, coalesce(r.r, 0)) ELSE 0 END) AS c3,
             sum(CASE WHEN h.n = 4 THEN least(h.h, coalesce(r.r, 0)) ELSE 0 END) AS c4
           FROM bl_h h LEFT JOIN bl_r r USING (system, line_no, n, gram) GROUP BY h.system) c
USING (system)""", "bl_h", "bl_r")


def _prec(n: int) -> str:
    zeros = " + ".join(f"(CASE WHEN c{m} = 0 THEN 1 ELSE 0 END)" for m in range(1, n + 1))
    return f"(CASE WHEN c{n} = 0 THEN 100.0 / (pow(2.0, {zeros}) * t{n}) ELSE 100.0 * c{n} / t{n} END)"


cte("bl_scores", f"""
SELECT *, CASE WHEN c1 + c2 + c3 + c4 = 0 OR t1 = 0 OR t2 = 0 OR t3 = 0 OR t4 = 0 THEN 0.0
               ELSE bp * exp((ln({_prec(1)}) + ln({_prec(2)}) + ln({_prec(3)}) + ln({_prec(4)})) / 4) END
          AS bleu
FROM (SELECT *, CASE WHEN sys_len >= ref_len THEN 1.0 WHEN sys_len > 0 THEN exp(1.0 - ref_len / sys_len)
                     ELSE 0.0 END AS bp FROM bl_stats)""", "bl_stats")
cte("term_map", "SELECT term AS src_term, term AS tgt_term FROM terms WHERE lang = 'en'", "terms")
_SIG = q("BLEU|nrefs:1|case:mixed|eff:no|tok:13a|smooth:exp|version:2.4.0 = ")
cte("reports", f"""
SELECT system, 1 AS line_no,
       CASE WHEN system = 'baseline' THEN 'score: ' || sys_len::VARCHAR ELSE 'chrF not computed' END AS text
FROM bl_scores
UNION ALL
SELECT system, 2 AS line_no,
       CASE WHEN system = 'baseline'
            THEN 'BLEU = ' || bleu::DECIMAL(10, 2)::VARCHAR || ' (hyp_len = ' || sys_len::VARCHAR
                 || ' ref_len = ' || ref_len::VARCHAR || ')'
            ELSE {_SIG} || bleu::DECIMAL(10, 2)::VARCHAR END
FROM bl_scores""", "bl_scores")
_FALLBACK = q(K.BLEU_FALLBACK_PATTERN.replace(r"\s", WS))

ORACLE["corpus_bleu"] = sql("""
SELECT system, round(bleu, 6) AS bleu, sys_len, ref_len, c1, c2, c3, c4, t1, t2, t3, t4
FROM bl_scores""", "bl_scores")
ORACLE["bleu_delta"] = sql("""
SELECT round(b, 6) AS baseline_bleu, round(t, 6) AS tuned_bleu, round(t - b, 6) AS delta,
       CASE WHEN t - b > 0 THEN 'improved' WHEN t - b < 0 THEN 'decreased'
            WHEN t - b = 0 THEN 'unchanged' END AS verdict
FROM (SELECT max(CASE WHEN system = 'baseline' THEN bleu END) AS b,
             max(CASE WHEN system = 'tuned' THEN bleu END) AS t FROM bl_scores)""", "bl_scores")
ORACLE["term_accuracy"] = sql("""
SELECT p.system, count(*)::BIGINT AS n_pairs, count_if(contains(p.text, x.tgt_term))::BIGINT AS n_hits,
       round(count_if(contains(p.text, x.tgt_term)) / count(*), 6) AS term_accuracy
FROM (SELECT r.line_no, m.tgt_term FROM refs r JOIN term_map m
      ON contains(lower(r.text), lower(m.src_term))) x
JOIN preds p USING (line_no)
GROUP BY p.system""", "refs", "preds", "term_map")
ORACLE["report_score"] = sql(f"""
SELECT system,
       coalesce(arg_min(v, line_no) FILTER (WHERE v IS NOT NULL),
                CASE WHEN regexp_extract(string_agg(text, chr(10) ORDER BY line_no), {_FALLBACK}, 1) <> ''
                     THEN regexp_extract(string_agg(text, chr(10) ORDER BY line_no), {_FALLBACK}, 1)::DOUBLE
                END) AS bleu
FROM (SELECT *, CASE WHEN (contains(text, 'BLEU') OR contains(lower(text), 'score'))
                      AND regexp_extract(text, {q('(' + K.DECIMAL_PATTERN + ')')}, 1) <> ''
                     THEN regexp_extract(text, {q('(' + K.DECIMAL_PATTERN + ')')}, 1)::DOUBLE END AS v
      FROM reports)
GROUP BY system""", "reports")
ORACLE["evaluation_report"] = sql("""
SELECT system, round(bleu, 6) AS bleu,
       CASE WHEN system = 'tuned' THEN round(bleu - (SELECT bleu FROM bl_scores WHERE system = 'baseline'), 6) END AS delta,
       sys_len, ref_len
FROM bl_scores""", "bl_scores")
ORACLE["zip_lines"] = sql(f"""
SELECT coalesce(r.line_no, p.line_no) AS line_no, r.text AS left_text, p.text AS right_text,
       CASE WHEN r.text IS NULL THEN 'missing_left' WHEN p.text IS NULL THEN 'missing_right'
            WHEN {strip('r.text')} = '' OR {strip('p.text')} = '' THEN 'blank' ELSE 'ok' END AS status
FROM refs r FULL OUTER JOIN (SELECT * FROM preds WHERE system = 'baseline') p USING (line_no)""",
                          "refs", "preds")

# -- corpus ------------------------------------------------------------------------

cte("vocab", f"""
SELECT token, n, (row_number() OVER (ORDER BY n DESC, token) + 1)::INTEGER AS id FROM (
  SELECT token, count(*) AS n FROM (SELECT unnest({tokens('text')}) AS token FROM d)
  GROUP BY token)""", "d")
cte("lexicon", """
SELECT en_term AS src, vi_term AS tgt FROM pairs WHERE src_lang = 'en'""", "pairs")
cte("pairs_ok", f"""
SELECT row_no, {strip("coalesce(en_sentence, '')")} AS src, {strip("coalesce(vi_sentence_gen, '')")} AS tgt
FROM resolved WHERE status = 'success'""", "resolved")

ORACLE["pair_corpus"] = sql("""
SELECT row_no, src, tgt FROM pairs_ok
WHERE src <> '' AND tgt <> '' AND row_no IN (SELECT row_no FROM accepted)""", "pairs_ok", "accepted")
ORACLE["train_config"] = sql("""
SELECT 'base-model' AS base_model, 'checkpoints/ft_model' AS checkpoint_dir,
       count(*)::BIGINT AS num_training_samples, 42 AS seed, 'transformers' AS framework
FROM pairs_ok WHERE src <> '' AND tgt <> '' AND row_no IN (SELECT row_no FROM accepted)""",
                             "pairs_ok", "accepted")
ORACLE["vocabulary"] = sql("SELECT token, n, id FROM vocab", "vocab")
ORACLE["encode_fixed"] = sql(f"""
SELECT d.doc_id, coalesce(len(e.arr), 0)::INTEGER AS n_tokens,
       list_resize(coalesce(e.arr, []::INTEGER[]), 512, 0) AS input_ids
FROM d LEFT JOIN (
  SELECT doc_id, list(coalesce(v.id, 1) ORDER BY pos) AS arr FROM (
    SELECT doc_id, unnest(toks[1:512]) AS token, generate_subscripts(toks[1:512], 1) AS pos
    FROM (SELECT doc_id, {tokens('text')} AS toks FROM d)) tk
  LEFT JOIN vocab v USING (token) GROUP BY doc_id) e USING (doc_id)""", "d", "vocab")
cte("pair_corpus", """
SELECT row_no, src, tgt FROM pairs_ok
WHERE src <> '' AND tgt <> '' AND row_no IN (SELECT row_no FROM accepted)""", "pairs_ok", "accepted")
cte("pair_vocab", f"""
SELECT token, (row_number() OVER (ORDER BY n DESC, token) + 1)::INTEGER AS id FROM (
  SELECT token, count(*) AS n FROM (SELECT unnest({tokens('src')}) AS token FROM pair_corpus
                                    UNION ALL SELECT unnest({tokens('tgt')}) FROM pair_corpus)
  GROUP BY token)""", "pair_corpus")
_SIDE = """
  SELECT row_no, list(v.id ORDER BY pos) AS arr FROM (
    SELECT row_no, unnest(toks[1:512]) AS token, generate_subscripts(toks[1:512], 1) AS pos
    FROM (SELECT row_no, {} AS toks FROM pair_corpus)) JOIN pair_vocab v USING (token) GROUP BY row_no"""
ORACLE["encode_pairs"] = sql(f"""
SELECT row_no, list_resize(s.arr, 512, 0) AS input_ids, list_resize(t.arr, 512, 0) AS labels
FROM ({_SIDE.format(tokens('src'))}) s JOIN ({_SIDE.format(tokens('tgt'))}) t USING (row_no)""", "pair_vocab")
ORACLE["line_round_trip"] = f"""
SELECT line_no, left_text, right_text,
       CASE WHEN {strip('left_text')} = '' OR {strip('right_text')} = '' THEN 'blank' ELSE 'ok' END AS status
FROM (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS line_no,
             CASE WHEN doc_id % 11 = 0 THEN ' ' ELSE regexp_replace(text, '[\r\n]', ' ', 'g') END AS left_text,
             CASE WHEN doc_id % 13 = 0 THEN '' ELSE lang || ' ' || doc_id::VARCHAR END AS right_text
      FROM documents)"""
ORACLE["csv_round_trip"] = """
SELECT row_number() OVER (ORDER BY doc_id) AS row_no, doc_id, nullif(lang, '') AS lang,
       CASE doc_id % 9 WHEN 0 THEN 'NA' WHEN 1 THEN ' NA ' ELSE nullif(source, '') END AS source,
       '"' || lang || '", "' AS quoted, nullif(text, '') AS text,
       CASE doc_id % 9 WHEN 0 THEN true WHEN 1 THEN false ELSE coalesce(source, '') = '' END AS no_source
FROM documents"""
ORACLE["json_lines_round_trip"] = """
SELECT doc_id, lang, CASE WHEN doc_id % 5 > 0 THEN source END AS note, text, false AS torn, NULL AS torn_id FROM documents
UNION ALL
SELECT NULL, NULL, NULL, NULL, true, doc_id::VARCHAR FROM documents WHERE doc_id % 10 = 0"""
ORACLE["translate_batches"] = """
SELECT doc_id AS line_no, length(text)::VARCHAR || ':' || text AS text FROM documents"""
ORACLE["lexicon_translate"] = sql(f"""
SELECT r.line_no, coalesce(string_agg(coalesce(l.tgt, tk.token), ' ' ORDER BY tk.pos), '') AS text
FROM refs r
LEFT JOIN (SELECT line_no, unnest(toks) AS token, generate_subscripts(toks, 1) AS pos
           FROM (SELECT line_no, {tokens('text')} AS toks FROM refs)) tk USING (line_no)
LEFT JOIN lexicon l ON lower(tk.token) = l.src
GROUP BY r.line_no""", "refs", "lexicon")


cte("al_e", f"""
SELECT row_no, e, count(*) AS n_e FROM (SELECT row_no, unnest({tokens('lower(src)')}) AS e FROM pair_corpus) GROUP BY ALL
UNION ALL SELECT row_no, '', 1 FROM pair_corpus""", "pair_corpus")
cte("al_f", f"""
SELECT row_no, f, count(*) AS n_f FROM (SELECT row_no, unnest({tokens('lower(tgt)')}) AS f FROM pair_corpus) GROUP BY ALL""",
    "pair_corpus")
cte("al_t0", "SELECT DISTINCT e, f, 1000000000::BIGINT AS t FROM al_e JOIN al_f USING (row_no)", "al_e", "al_f")
for _i in range(1, 5):
    cte(f"al_c{_i}", f"""
SELECT e, f, sum(n_f * floor(1e6 * part::DOUBLE / whole::DOUBLE)::BIGINT) AS c FROM (
  SELECT row_no, e, f, n_f, n_e * t AS part, sum(n_e * t) OVER (PARTITION BY row_no, f) AS whole
  FROM al_e JOIN al_f USING (row_no) JOIN al_t{_i - 1} USING (e, f))
WHERE whole > 0 GROUP BY e, f""", "al_e", "al_f", f"al_t{_i - 1}")
    cte(f"al_t{_i}", f"""
SELECT e, f, CASE WHEN total > 0 THEN floor(1e9 * c::DOUBLE / total::DOUBLE)::BIGINT ELSE 0 END AS t
FROM (SELECT *, sum(c) OVER (PARTITION BY e) AS total FROM al_c{_i})""", f"al_c{_i}")
cte("aligned", """
SELECT e AS src, f AS tgt, t AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY e ORDER BY t DESC, f) AS n FROM al_t4 WHERE e <> '')
WHERE n = 1""", "al_t4")
ORACLE["align_lexicon"] = sql("SELECT src, tgt, score FROM aligned", "aligned")
ORACLE["aligned_translate"] = sql(f"""
SELECT r.line_no, coalesce(string_agg(coalesce(l.tgt, tk.token), ' ' ORDER BY tk.pos), '') AS text
FROM refs r
LEFT JOIN (SELECT line_no, unnest(toks) AS token, generate_subscripts(toks, 1) AS pos
           FROM (SELECT line_no, {tokens('text')} AS toks FROM refs)) tk USING (line_no)
LEFT JOIN aligned l ON lower(tk.token) = l.src
GROUP BY r.line_no""", "refs", "aligned")


# -- web pages, search and enrichment ------------------------------------------------

_FILE_EXT = q(r"(?i)\.(pdf|docx?|xlsx?|pptx?|zip)\z")
_URL_PATH = q(r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)")


def url_usable(x: str) -> str:
    return (f"coalesce(starts_with({x}, 'http') AND NOT regexp_matches(regexp_extract({x}, {_URL_PATH}, 1), "
            f"{_FILE_EXT}), false)")


# Pages in SQL, independently: all markup is unnested with its place; a running sum of opened and
# closed removed elements tells what is inside one; references are replaced name by name.
_REMOVED = "|".join(e for e in K.DROPPED_HTML_ELEMENTS if e not in ("script", "style"))
_MARKS = (r"(?is)<!--.*?-->|<![^>]*>|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"
          r"""|</?[a-z](?:[^>"']|"[^"]*"|'[^']*')*>""")


def _references(x: str) -> str:
    for name, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("nbsp", "\u00a0"),
                       ("eacute", "é"), ("#39", "'"), ("#x27", "'")):
        x = f"regexp_replace({x}, '&{name}(;|([^A-Za-z0-9])|\\z)', {q(char)} || '\\2', 'g')"
    # Twice: the character behind a reference without ; may itself start one.
    for _ in range(2):
        x = f"regexp_replace({x}, '&amp(;|([^A-Za-z0-9;])|\\z)', chr(3) || '\\2', 'g')"
    return f"replace({x}, chr(3), '&')"


cte("page_pieces", f"""
SELECT page_id, i, {strip(_references('piece'))} AS piece,
       sum(CASE WHEN regexp_matches(mark, '(?i)^<({_REMOVED})[\\s/>]') AND NOT ends_with(mark, '/>') THEN 1
                WHEN regexp_matches(mark, '(?i)^</({_REMOVED})[\\s/>]') THEN -1 ELSE 0 END)
         OVER (PARTITION BY page_id ORDER BY i) AS inside
FROM (SELECT page_id, unnest(string_split_regex(html, {q(_MARKS)})) AS piece,
             unnest(list_prepend('', regexp_extract_all(html, {q(_MARKS)}))) AS mark,
             generate_subscripts(string_split_regex(html, {q(_MARKS)}), 1) AS i FROM pages)""")
cte("page_texts", """
SELECT p.page_id, p.url, coalesce(x.text, '') AS text FROM pages p LEFT JOIN (
  SELECT page_id, string_agg(piece, chr(10) ORDER BY i) AS text FROM page_pieces WHERE inside = 0 AND piece <> ''
  GROUP BY page_id) x USING (page_id)""", "page_pieces")


def last_word(x: str) -> str:
    return f"(regexp_split_to_array({strip(x)}, {q(WS + '+')}))[-1]"


def ascii_share(x: str) -> str:
    s = f"coalesce({x}, '')"
    return f"(length(regexp_replace({s}, '[^\\x00-\\x7F]', '', 'g')) / greatest(length({s}), 1))"


cte("hits", """
SELECT t.term, d.lang, (1 + floor(d.doc_id / 50) % 3)::INTEGER AS query_rank,
       d.doc_id + 1 AS result_rank,
       'http://example.org/' || d.doc_id::VARCHAR
         || CASE WHEN d.doc_id % 7 = 0 THEN '.pdf' ELSE '' END AS url,
       d.text AS body
FROM d JOIN term_counts n ON d.lang = n.lang JOIN terms t ON d.lang = t.lang AND d.doc_id % n.n_terms + 1 = t.rk""",
    "d", "terms", "term_counts")
cte("abstracts", """
SELECT t.term, 'http://abstracts.example.org/' || min(b.item_id)::VARCHAR AS url,
       arg_min(b.text, b.item_id) AS body
FROM benchmark b JOIN terms t ON t.lang = 'en' AND contains(lower(b.text), t.term)
GROUP BY t.term""", "terms")


def _existing(r: str) -> str:
    return (f"CASE WHEN {r} % 5 = 0 THEN 'PENDING' WHEN {r} % 5 = 1 THEN 'UNOBSERVED' "
            f"WHEN {r} % 5 = 2 THEN NULL WHEN {r} % 5 = 3 THEN 'short' "
            f"ELSE 'kept example ' || lpad(({r})::VARCHAR, 7, '0') END")


cte("enriched", f"""
SELECT 2 * term_id::BIGINT + (src_lang = 'de')::INTEGER AS row_no, src_lang, tgt_lang, en_term AS "English",
       CASE WHEN term_id % 13 = 0 THEN ' ' ELSE vi_term END AS "Vietnamese",
       {_existing('term_id')} AS "English example", {_existing('(term_id + 2)')} AS "Vietnamese example",
       'http://kept.example.org/' || term_id::VARCHAR AS "English source URL",
       'http://kept.example.org/' || term_id::VARCHAR AS "Vietnamese source URL"
FROM pairs""", "pairs")
ORACLE["prompt_inputs"] = sql("""
SELECT row_no, '' AS "index", "English", "Vietnamese",
       CASE WHEN "English example" IN ('PENDING', 'UNOBSERVED') THEN '' ELSE "English example" END AS en_sentence,
       '' AS vi_sentence, 'PENDING' AS state
FROM enriched""", "enriched")
cte("items", f"""
SELECT *, CASE WHEN value IS NOT NULL AND value NOT IN ('PENDING', 'UNOBSERVED') AND length(value) > 10
               THEN 'done'
               WHEN coalesce({strip('term')}, '') = '' THEN 'blank' ELSE 'todo' END AS state
FROM (SELECT row_no, 'en' AS side, src_lang AS lang, "English" AS term, "English example" AS value,
             "English source URL" AS url FROM enriched
      UNION ALL
      SELECT row_no, 'vi', tgt_lang, "Vietnamese", "Vietnamese example", "Vietnamese source URL"
      FROM enriched)""", "enriched")
cte("enrich_cand", f"""
SELECT i.row_no, i.side, i.lang, i.term, l.url, l.body, 0 AS source_rank, l.url_rank
FROM items i JOIN (
  SELECT *, row_number() OVER (PARTITION BY term, lang ORDER BY result_rank) AS url_rank FROM (
    SELECT *, min(query_rank) OVER (PARTITION BY term, lang) AS q0
    FROM (SELECT *, row_number() OVER (PARTITION BY term, lang, query_rank ORDER BY result_rank) AS rn0
          FROM hits) WHERE rn0 <= 2 AND {url_usable('url')})
  WHERE query_rank = q0) l ON l.term = i.term AND l.lang = i.lang
WHERE i.state = 'todo' AND length(l.body) >= 50
UNION ALL
SELECT i.row_no, i.side, i.lang, i.term, a.url, a.body, 1 AS source_rank, 0 AS url_rank
FROM items i JOIN abstracts a ON a.term = i.term
WHERE i.state = 'todo' AND i.side = 'en'""", "items", "hits", "abstracts")
cte("enrich_found", f"""
SELECT row_no, side, sentence, url FROM (
  SELECT *, row_number() OVER (PARTITION BY row_no, side ORDER BY source_rank, url_rank, term_rank) AS pick
  FROM (
    SELECT *, row_number() OVER (PARTITION BY row_no, side, source_rank, url_rank, term_rank
                                 ORDER BY score DESC, pos) AS rn
    FROM (
      SELECT c.*, {score_sentence('c.sentence', 'c.kwd', 'k.keywords')} AS score
      FROM (
        SELECT *, unnest(arr) AS sentence, generate_subscripts(arr, 1) - 1 AS pos FROM (
          SELECT c.*, t.term_rank,
                 CASE WHEN t.term_rank = 0 THEN c.term ELSE {last_word('c.term')} END AS kwd,
                 {split_sentences(clean_text('c.body'))} AS arr
          FROM enrich_cand c, (SELECT unnest([0, 1]) AS term_rank) t)) c
      LEFT JOIN kw k ON k.lang = c.lang
      WHERE contains(lower(c.sentence), lower(c.kwd)) AND {word_count('c.sentence')} >= 8)
    WHERE score > 0)
  WHERE rn = 1)
WHERE pick = 1""", "enrich_cand", "kw")
cte("enrich_out", """
SELECT i.row_no, i.side,
       CASE WHEN i.state = 'done' THEN i.value WHEN f.sentence IS NOT NULL THEN f.sentence
            ELSE 'UNOBSERVED' END AS example,
       CASE WHEN i.state = 'done' THEN i.url WHEN f.sentence IS NOT NULL THEN f.url ELSE '' END AS source_url
FROM items i LEFT JOIN enrich_found f USING (row_no, side)""", "items", "enrich_found")

ORACLE["html_text"] = sql("SELECT page_id, text FROM page_texts WHERE length(text) >= 50", "page_texts")
ORACLE["url_filter"] = sql(f"""
SELECT url, regexp_extract(url, {_URL_PATH}, 1) AS path, {url_usable('url')} AS usable
FROM (SELECT url FROM hits UNION ALL SELECT url FROM pages)""", "hits")
ORACLE["enrich_terms"] = sql("SELECT * FROM enrich_out", "enrich_out")
ORACLE["enriched_table"] = sql("""
SELECT e.row_no, e."English", e."Vietnamese", en.example AS en_example, en.source_url AS en_source_url,
       vi.example AS vi_example, vi.source_url AS vi_source_url
FROM enriched e
LEFT JOIN enrich_out en ON en.row_no = e.row_no AND en.side = 'en'
LEFT JOIN enrich_out vi ON vi.row_no = e.row_no AND vi.side = 'vi'""", "enriched", "enrich_out")
ORACLE["resume_work_set"] = sql(
    "SELECT row_no, side, lang, term FROM items WHERE state = 'todo'", "items")
_SFX = ", ".join(f"({q('en' if lang == 'en' else 'vi')}, {i + 1}, {q(s)})"
                 for lang in ("en", "vi") for i, s in enumerate(K.SEARCH_QUERY_SUFFIXES[lang]))
ORACLE["search_queries"] = sql(f"""
SELECT t.lang, t.term, s.query_rank, '"' || t.term || '"' || s.sfx AS query,
       replace(url_encode(t.term), '%2F', '/') AS quoted_term
FROM terms t JOIN (VALUES {_SFX}) s(l, query_rank, sfx)
  ON s.l = CASE WHEN t.lang = 'en' THEN 'en' ELSE 'vi' END""", "terms")

# -- evidence and answers --------------------------------------------------------------

cte("snippets", f"""
SELECT term, lang, 3 * result_rank + query_rank AS result_rank, url, {clean_text('body')} AS body
FROM hits""", "hits")
cte("ascii_ev", f"""
SELECT term, lang,
       CASE WHEN count(*) FILTER (WHERE keep) > 0
            THEN string_agg(body, ' | ' ORDER BY result_rank) FILTER (WHERE keep)
            ELSE {q(K.NO_ENGLISH_EVIDENCE)} END AS evidence
FROM (SELECT *, {ascii_share('body')} > 0.8 AS keep FROM (
        SELECT *, row_number() OVER (PARTITION BY term, lang ORDER BY result_rank) AS rn FROM snippets)
      WHERE rn <= 3)
GROUP BY term, lang""", "snippets")
cte("questions", f"""
SELECT 'q' || b.item_id::VARCHAR AS id, b.item_id,
       array_to_string({tokens('b.text')}, ' ') AS question, o.options,
       ['multi_choice', 'open_ended_multi_choice', 'open_ended', 'other'][b.item_id % 4 + 1] AS question_type
FROM benchmark b LEFT JOIN (
  SELECT x.item_id, list({{'k': x.letter, 'v': t.term}} ORDER BY x.letter) AS options
  FROM (SELECT b.item_id, l.k, l.letter FROM benchmark b,
        (VALUES (0, 'A'), (1, 'B'), (2, 'C'), (3, 'D')) l(k, letter)) x
  JOIN term_counts n ON n.lang = 'en'
  JOIN terms t ON t.lang = 'en' AND t.rk = (4 * x.item_id + x.k) % n.n_terms + 1
  GROUP BY x.item_id) o USING (item_id)""", "terms", "term_counts")
cte("answers_raw", """
SELECT id, CASE item_id % 7
  WHEN 6 THEN NULL
  WHEN 0 THEN '{"selected_option": "' || letter || '", "reasoning": "' || reason || '"}'
  WHEN 1 THEN '{"reasoning": "' || reason || '"}'
  WHEN 2 THEN reason
  WHEN 3 THEN '{"selected_option": null, "reasoning": "' || reason || '"}'
  WHEN 4 THEN '[1]'
  ELSE '```json' || chr(10) || '{"selected_option": "' || letter || '"}' || chr(10) || '```' END AS response
FROM (SELECT id, item_id, ['A', 'B', 'C', 'D'][item_id % 4 + 1] AS letter,
             'Evidence supports ' || coalesce(list_filter(options, lambda e: e.k = 'A')[1].v, '') AS reason
      FROM questions)""", "questions")


def _field(f: str) -> str:
    return (f"CASE WHEN NOT json_exists(response, '$.{f}') THEN '' "
            f"WHEN json_type(json_extract(response, '$.{f}')) = 'NULL' THEN NULL "
            f"ELSE json_extract_string(response, '$.{f}') END")


cte("parsed_answers", f"""
SELECT id, response, coalesce(json_valid(response), false) AS valid,
       coalesce(jt = 'OBJECT', false) AS is_object,
       CASE WHEN jt = 'OBJECT' THEN {_field('selected_option')} END AS selected_option,
       CASE WHEN jt = 'OBJECT' THEN {_field('reasoning')} END AS reasoning
FROM (SELECT *, CASE WHEN json_valid(response) THEN json_type(response) END AS jt FROM answers_raw)""",
    "answers_raw")
_CHOICE = "q.question_type IN ('multi_choice', 'open_ended_multi_choice')"
_OPEN = "q.question_type = 'open_ended'"
cte("answer_rows", f"""
SELECT q.id, {_CHOICE} AS is_choice, {_OPEN} AS is_open,
       CASE WHEN p.is_object THEN p.selected_option ELSE '' END AS sel,
       CASE WHEN p.is_object THEN p.reasoning ELSE p.response END AS rea,
       ({_CHOICE} OR {_OPEN}) AND coalesce(p.valid, false) AND NOT coalesce(p.is_object, false) AS failed,
       ({_CHOICE} OR {_OPEN}) AND p.response IS NULL AS silent
FROM questions q LEFT JOIN parsed_answers p USING (id)""", "questions", "parsed_answers")

ORACLE["provider_evidence"] = sql(f"""
SELECT t.term, t.lang, coalesce(e1, e2, e3, {q(K.NO_ENGLISH_EVIDENCE)}) AS evidence
FROM terms t LEFT JOIN (
  SELECT term, lang, string_agg(text, ' | ' ORDER BY result_rank) FILTER (WHERE provider = 1) AS e1,
         string_agg(text, ' | ' ORDER BY result_rank) FILTER (WHERE provider = 2) AS e2,
         string_agg(text, ' | ' ORDER BY result_rank) FILTER (WHERE provider = 3) AS e3
  FROM (SELECT term, lang, provider, result_rank,
               CASE WHEN provider = 1 THEN url || ': ' || body ELSE body END AS text
        FROM (SELECT *, row_number() OVER (PARTITION BY term, lang, provider ORDER BY result_rank) AS n
              FROM (SELECT *, query_rank AS provider FROM hits WHERE query_rank > length(term) % 3))
        WHERE n <= CASE WHEN provider = 1 THEN 5 ELSE 3 END AND (provider <> 3 OR {ascii_share('body')} > 0.8))
  GROUP BY term, lang) USING (term, lang)""", "hits", "terms")
ORACLE["top_hits"] = sql("""
SELECT term, lang, query_rank, result_rank, url FROM (
  SELECT *, row_number() OVER (PARTITION BY term, lang, query_rank ORDER BY result_rank) AS rn FROM hits)
WHERE rn <= 3""", "hits")
ORACLE["ascii_evidence"] = sql("SELECT term, lang, evidence FROM ascii_ev", "ascii_ev")
cte("postings", """
SELECT token, doc_id, count(*) AS tf, any_value(dl) AS dl FROM (
  SELECT doc_id, len(w) AS dl, unnest(w) AS token FROM (
    SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w FROM d))
GROUP BY token, doc_id""", "d")
cte("collection", "SELECT count(*) AS n, sum(dl) / count(*) AS mean FROM (SELECT doc_id, any_value(dl) AS dl FROM postings GROUP BY doc_id)",
    "postings")
cte("searches", """
SELECT DISTINCT id, opt_key, unnest(string_split_regex(lower(opt || ' ' || question), '[^\\p{L}\\p{N}]+')) AS token
FROM (SELECT id, question, unnest(options).k AS opt_key, unnest(options).v AS opt FROM questions)""", "questions")
cte("option_hits", """
SELECT id, opt_key, rank, doc, score FROM (
  SELECT *, row_number() OVER (PARTITION BY id, opt_key ORDER BY score DESC, doc) AS rank FROM (
    SELECT s.id, s.opt_key, p.doc_id AS doc,
           sum(round(1e6 * ln(1 + (c.n - f.df + 0.5) / (f.df + 0.5)) * p.tf * 2.2
                     / (p.tf + 1.2 * (0.25 + 0.75 * p.dl / c.mean)))::BIGINT)::BIGINT AS score
    FROM searches s JOIN postings p USING (token)
    JOIN (SELECT token, count(*) AS df FROM postings GROUP BY token) f USING (token) CROSS JOIN collection c
    WHERE f.df <= 0.5 * c.n
    GROUP BY ALL))
WHERE rank <= 3""", "searches", "postings", "collection")
ORACLE["search_evidence"] = sql("SELECT id, opt_key, rank::INTEGER AS rank, doc, score FROM option_hits", "option_hits")
cte("evidence_text", f"""
SELECT o.id, string_agg(e.k || ': ' || coalesce(evidence, {q(K.NO_EVIDENCE)}), chr(10) ORDER BY pos)
         AS evidence_text
FROM (SELECT id, unnest(options) AS e, generate_subscripts(options, 1) AS pos FROM questions) o
LEFT JOIN (
  SELECT id, opt_key, coalesce(string_agg(body, ' | ' ORDER BY rank) FILTER (WHERE {ascii_share('body')} > 0.8),
                               {q(K.NO_ENGLISH_EVIDENCE)}) AS evidence
  FROM option_hits JOIN (SELECT doc_id AS doc, clean AS body FROM dclean) USING (doc) GROUP BY id, opt_key) ev
  ON ev.id = o.id AND ev.opt_key = o.e.k
GROUP BY o.id""", "questions", "option_hits", "dclean")
ORACLE["evidence_map"] = sql("SELECT id, evidence_text FROM evidence_text", "evidence_text")


def _fill(tpl: str, with_options: bool) -> str:
    parts, rest = [], tpl
    for key, col in (("{stem}", "q.question"),
                     ("{options}", "array_to_string(list_transform(q.options, lambda e: e.k || ': ' || e.v), chr(10))"
                      if with_options else None),
                     ("{evidence}", "m.evidence_text")):
        if key not in rest:
            continue
        head, rest = rest.split(key, 1)
        parts += [q(head), col]
    parts.append(q(rest))
    return " || ".join(parts)


def _answer_prompt_sql() -> str:
    from termweave.operators.answering import CHOICE_PROMPT, OPEN_PROMPT
    return sql(f"""
SELECT q.id, CASE WHEN q.question_type IN ('multi_choice', 'open_ended_multi_choice')
                  THEN {_fill(CHOICE_PROMPT, True)}
                  WHEN q.question_type = 'open_ended' THEN {_fill(OPEN_PROMPT, False)} END AS prompt
FROM questions q LEFT JOIN evidence_text m USING (id)
WHERE q.question_type IN ('multi_choice', 'open_ended_multi_choice', 'open_ended')""",
               "questions", "evidence_text")


ORACLE["answer_prompts"] = _answer_prompt_sql()
ORACLE["answer_batches"] = f"""
SELECT a.id,
       CASE WHEN NOT asked THEN '' WHEN is_open THEN reasoning ELSE selected END AS prediction,
       CASE WHEN NOT asked THEN {q(K.UNSUPPORTED_REASONING)} ELSE reasoning END AS reasoning_trace,
       CASE WHEN NOT asked THEN '' WHEN is_open AND coalesce(selected, '') = '' THEN 'A' ELSE selected END AS choice
FROM (SELECT 'q' || item_id::VARCHAR AS id, p.id IS NOT NULL AS asked, item_id % 4 = 2 AS is_open,
             CASE WHEN length(prompt) % 7 IN (0, 1) THEN '' ELSE 'B' END AS selected,
             CASE length(prompt) % 7 WHEN 0 THEN NULL WHEN 1 THEN 'free text ' || length(prompt)::VARCHAR
                  ELSE length(prompt)::VARCHAR || ' characters' END AS reasoning
      FROM benchmark b LEFT JOIN ({ORACLE["answer_prompts"]}) p ON p.id = 'q' || item_id::VARCHAR) a"""
ORACLE["parse_answers"] = sql(
    "SELECT id, valid, is_object, selected_option, reasoning FROM parsed_answers", "parsed_answers")
ORACLE["answers"] = sql(f"""
SELECT id,
       CASE WHEN is_choice THEN sel WHEN is_open THEN rea ELSE '' END AS prediction,
       CASE WHEN is_choice OR is_open THEN rea ELSE {q(K.UNSUPPORTED_REASONING)} END AS reasoning_trace,
       CASE WHEN is_choice THEN sel
            WHEN is_open THEN CASE WHEN coalesce(sel, '') <> '' THEN sel ELSE 'A' END ELSE '' END AS choice
FROM answer_rows WHERE NOT failed""", "answer_rows")
ORACLE["answer_rejects"] = sql(
    "SELECT id, CASE WHEN failed THEN 'response is not a JSON object' ELSE 'no response' END AS reason "
    "FROM answer_rows WHERE failed OR silent", "answer_rows")


# -- incremental runs, batching and slices ------------------------------------------------

ORACLE["incremental_mine"] = ORACLE["best_sentence"]
ORACLE["incremental_delta"] = ORACLE["best_sentence"]
ORACLE["append_batches"] = sql("""
SELECT doc_id, lang, length(text)::INTEGER AS n_chars, clean FROM d JOIN dclean USING (doc_id, lang)""", "d", "dclean")
ORACLE["slice_rows"] = """
SELECT doc_id, row_no, row_no < 100 AS in_head, row_no >= 100 AND row_no < 300 AS in_slice,
       row_no >= 50 AS after_skip
FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_no FROM documents)"""
ORACLE["append_batches"] = f"""
SELECT doc_id, lang, {word_count('text')}::INTEGER AS n_words, {clean_text('text')} AS clean FROM documents"""

ORACLE["batch_ids"] = """
SELECT doc_id, row_no, (row_no // 5)::BIGINT AS q_batch, (row_no // 8)::BIGINT AS t_batch
FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_no FROM documents)"""


# -- JOIN-3: links to pages by URL ----------------------------------------------------

cte("page_hits", """
SELECT t.term, p.lang, (1 + floor(p.page_id / 50) % 3)::INTEGER AS query_rank,
       p.page_id + 1 AS result_rank, p.url
FROM (SELECT page_id, url, regexp_extract(url, '/(en|fr|de|es)/', 1) AS lang FROM pages) p
JOIN term_counts n ON p.lang = n.lang
JOIN terms t ON p.lang = t.lang AND p.page_id % n.n_terms + 1 = t.rk""", "terms", "term_counts")
cte("page_hits_body", """
SELECT h.*, x.text AS body FROM page_hits h LEFT JOIN (SELECT url, text FROM page_texts WHERE length(text) >= 50) x
USING (url)""", "page_hits", "page_texts")


def _enrich_with(hits_view: str) -> str:
    cand = CTES["enrich_cand"][0].replace("FROM hits)", f"FROM {hits_view})").replace(
        "WHERE i.state = 'todo' AND length(l.body) >= 50",
        "WHERE i.state = 'todo' AND l.body IS NOT NULL AND length(l.body) >= 50")
    found = CTES["enrich_found"][0].replace("FROM enrich_cand c", "FROM enrich_cand2 c")
    out = CTES["enrich_out"][0].replace("LEFT JOIN enrich_found f", "LEFT JOIN enrich_found2 f")
    assert hits_view in cand
    cte("enrich_cand2", cand, "items", hits_view, "abstracts")
    cte("enrich_found2", found, "enrich_cand2", "kw")
    cte("enrich_out2", out, "items", "enrich_found2")
    return sql("SELECT * FROM enrich_out2", "enrich_out2")


ORACLE["enrich_from_pages"] = _enrich_with("page_hits_body")


# -- UDF-1 with the deterministic echo generator ------------------------------------------

def _echo_attempt(body: str) -> str:
    """Echo generator answer for a prompt whose text after the template is ``body``."""
    flat = f"replace({body}, chr(10), ' ')"
    return f"split_part({flat}, ' ', 1) || ' | ' || {flat} || ' | ' || {flat}"


def _valid(raw: str) -> str:
    parts = f"string_split({raw}, '|')"
    vi = strip(f"{parts}[3]")
    return (f"(len({parts}) >= 3 AND {python_int(f'{parts}[1]')} IS NOT NULL AND {vi} <> '' "
            f"AND vi_term <> '' AND contains({vi}, vi_term))")


_RETRY_HEAD, _RETRY_TAIL = K.RETRY_INSTRUCTION.split("{term}")
cte("echo", f"""
SELECT *, {_valid('raw0')} AS ok0, {_valid('raw1')} AS ok1 FROM (
  SELECT row_no, "index", prompt_input, vi_term,
         {_echo_attempt('prompt_input')} AS raw0,
         {_echo_attempt(f"prompt_input || {q(_RETRY_HEAD)} || vi_term || {q(_RETRY_TAIL)}")} AS raw1
  FROM accepted)""", "accepted")
ORACLE["generate_batches"] = sql("""
SELECT row_no, "index", prompt_input,
       CASE WHEN ok0 THEN raw0 WHEN ok1 THEN raw1 WHEN coalesce(raw1, '') <> '' THEN raw1 ELSE '' END
         AS raw_response,
       CASE WHEN ok0 OR ok1 THEN 'success'
            WHEN coalesce(raw1, '') <> '' THEN 'failed_validation: success'
            ELSE 'failed_api: success' END AS status
FROM echo""", "echo")
