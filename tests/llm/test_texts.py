"""Quality rules, N-best segmentation and packing."""

import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers as public
import pytest
from llm_data import MEDIUM, SMALL, none, odd  # noqa: F401

from termweave.llm import nbest, packing, quality_rules, queries


def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]


# ------------------------------------------------------------------------------- quality rules

def brute_counts(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    repeated = {k for i in range(len(w) - 7) if grams[tuple(w[i:i + 8])] > 1 for k in range(i, i + 8)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(repeated),
            len(w) < 20 or 100 * len(repeated) > 30 * len(w))


def test_quality_counts(spark):
    r = random.Random(4)
    parts = ["a ", "b ", "c\n", "# ", "\x0b", "é ", "\x85x ", "  ", "<b> ", "\n", "d d d d "]
    docs = documents(spark) + [(10_000 + i, "".join(r.choice(parts) for _ in range(r.randint(0, 60))))
                               for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {x[0]: tuple(x)[1:] for x in quality_rules.quality_rules(df).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()}
    assert got == {i: brute_counts(t) for i, t in docs}


def test_quality_verdicts(spark):
    r = random.Random(9)
    syllables = ["the", "on", "er", "ing", "at", "is", "ou", "me", "ra", "lo", "du", "pi", "sk", "ve", "no", "ch", "wh", "ay"]
    prose = " ".join("".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(900))
    noise = " ".join("".join(chr(r.randint(0x4E00, 0x9FFF)) for _ in range(8)) for _ in range(300))
    noisy = " ".join("".join(chr(r.randint(33, 126)) for _ in range(40)) for _ in range(200))
    repeated = " ".join(f"line {i % 7}{'x' * (i % 5)} of the same old story told again" for i in range(300))
    part = prose + " " + " ".join(f"{i % 3}abcabcabcabcabcabcabcabc{i}" for i in range(400))
    df = spark.createDataFrame([(1, prose), (2, noisy), (3, repeated), (4, part), (5, noise)], "doc_id long, text string")
    got = {x["doc_id"]: x for x in quality_rules.quality_rules(df).collect()}
    assert got[1]["kept"] and got[1]["reason"] is None
    assert got[2]["reason"] == "incompressible"
    assert got[3]["reason"] in ("repetitive", "repeated_windows")
    assert got[4]["reason"] in ("repetitive", "repetitive_chunks")


def other_script(text, first):
    """Letter by letter in another script; capitals and small letters stay apart."""
    return "".join(chr(first + (ord(c) - 65)) if c.isalpha() and c.isascii() else c for c in text)


@pytest.mark.parametrize("first", [0x400, 0x5D0, 0x900, 0x10A0, 0x10400])
def test_quality_is_the_same_in_every_script(spark, first):
    good = {r[0] for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").where("quality = 1").select("doc_id").collect()}
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text").collect()
            if r[0] in good and r[1] and len(r[1].split()) >= 20]
    r = random.Random(3)
    noise = "".join(chr(r.randint(33, 126)) if r.random() < 0.9 else " " for _ in range(6000))
    noise = " ".join("".join(chr(0x400 + r.randint(0, 105)) for _ in range(40)) for _ in range(200)), noise
    bad = [(-1, other_script("the same words and letters " * 200, first)), *((-2 - i, x) for i, x in enumerate(noise))]
    df = spark.createDataFrame([(i, other_script(t, first)) for i, t in docs] + bad, "doc_id long, text string")
    plain = spark.createDataFrame(docs, "doc_id long, text string")
    kept = {x[0] for x in quality_rules.quality_rules(df).where("kept").select("doc_id").collect()}
    assert kept == {x[0] for x in quality_rules.quality_rules(plain).where("kept").select("doc_id").collect()}
    assert len(docs) > 200 and len(kept) == len(docs)


def test_quality_units():
    u = quality_rules.units
    assert u("plain text") == b"plain text" and u("") == b""
    assert len(u("é à ö é")) == 7 and len(u("привет мир")) == 10 and len(u("नमस्ते")) == 6
    assert len(u("漢字")) == 6 and len(u("한글")) == 4 and len(u("かな")) == 2
    many = "".join(map(chr, range(0x100, 0x300)))
    assert len(u(many)) == 112 + 2 * 400 and len(set(many)) == 512


def test_quality_last_chunk(spark):
    r = random.Random(5)
    words = lambda n: " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9)))
                               for _ in range(n))[:2048]
    rows = [(1, words(600) + "xy" * 475), (2, words(600) + "-" * 70), (3, words(600)), (4, words(600) + " " + words(100))]
    got = {x["doc_id"]: x for x in quality_rules.quality_rules(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1]["reason"] == "repetitive_chunks" and (got[1]["n_chunks"], got[1]["n_high_chunks"]) == (3, 1)
    assert all(got[i]["kept"] for i in (2, 3, 4))


def test_quality_odd_rows(odd, none):
    got = quality_rules.quality_rules(odd).collect()
    assert len(got) == odd.count()
    assert all(r["base_failed"] and not r["kept"] for r in got)
    assert quality_rules.quality_rules(none).count() == 0


# -------------------------------------------------------------------------------------- n-best

@pytest.fixture(scope="module")
def vocabulary():
    return nbest.Vocabulary(public.path("piece_bpe_32k.model"))


def best_scores(v, text, n):
    """Scores of the n best, by enumeration of the whole text's lattice."""
    if not text:
        return [0.0]
    chars = [None if c == "▁" else c for c in " " + text]
    best = [[0.0]]
    for j in range(1, len(chars) + 1):
        here = []
        for i in range(max(0, j - v.longest), j):
            part = chars[i:j]
            k = None if None in part else v.ids.get("".join(part).replace(" ", "▁"))
            if k is not None:
                s = v.scores[k]
            elif j == i + 1:
                s = len((chars[i] or "▁").encode()) * v.byte_score
            else:
                continue
            here += [x + s for x in best[i]]
        best.append(sorted(here, reverse=True)[:n])
    return best[-1]


@pytest.mark.parametrize("n", [1, 2, 5])
def test_nbest_equals_enumeration(vocabulary, n):
    r = random.Random(n)
    texts = ["", "a", "  a  b", "\n\n", " ", "▁", "the cat\nsat ▁ on é 𝒳 mats", "\0x\0", "a" * 70, "　 x"]
    texts += ["".join(r.choice("ab the ing\n▁é,.") for _ in range(r.randint(1, 40))) for _ in range(150)]
    chunks = nbest.Chunks(vocabulary, 10)
    for text, (ids, score, scores, changes, same) in zip(texts, nbest.encode_texts(texts, chunks, n), strict=True):
        want = best_scores(vocabulary, text, n)
        assert same and score == scores[0]
        assert scores == pytest.approx(want)
        ways = set()
        for s, change in zip(scores, changes, strict=True):
            way = list(ids)
            for c in reversed(change):
                way[c["at"]:c["at"] + c["drop"]] = c["ids"]
            assert vocabulary.decode(way) == text
            bytes_ = set(vocabulary.byte_ids)
            assert sum(vocabulary.byte_score if i in bytes_ else vocabulary.scores[i] for i in way) == pytest.approx(s)
            ways.add(tuple(way))
        assert len(ways) == len(scores)


def test_search_holds_few_states(vocabulary):
    got = nbest.search(vocabulary.edges("ab" * 3000), 3)
    assert [s for s, _ in got] == sorted((s for s, _ in got), reverse=True) and len({i for _, i in got}) == 3


def test_nbest_query_and_decode(spark, odd, none):
    got = queries.op3_sentencepiece_nbest(spark, SMALL).collect()
    assert len(got) == len(documents(spark)) and all(r["round_trip"] for r in got)
    assert all(len(r["scores"]) == len(r["changes"]) and r["scores"] == sorted(r["scores"], reverse=True) for r in got)
    model = public.path("piece_bpe_32k.model")
    encoded = nbest.encode_nbest(odd, model)
    back = nbest.decode(encoded, model)
    key = lambda r: (str(r[0]), r[1])
    assert sorted(map(tuple, back.collect()), key=key) == sorted(
        ((r["doc_id"], r["text"] or "") for r in odd.collect()), key=key)
    assert nbest.encode_nbest(none, model).count() == 0


# ------------------------------------------------------------------------------------- packing

def ids_of(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return [np.array(t.encode(x or "", add_special_tokens=False).ids + [1], "<u4") for x in texts]


def check_packing(rows, docs):
    """Every id once, in gapless sequences of a power of two; equal step groups."""
    want = defaultdict(list)
    for (i, _), ids in zip(docs, ids_of([t for _, t in docs]), strict=True):
        want[i].append(ids)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(pieces) == set(want)
    for i, many in want.items():
        got = Counter((r["start"], r["length"], r["ids_crc32"]) for r in pieces[i])
        assert sum(r["length"] for r in pieces[i]) == sum(map(len, many))
        for (start, length, crc), _ in got.items():
            assert any(crc32(ids[start:start + length].tobytes()) == crc for ids in many)
        if len(many) == 1:
            at = 0
            for r in sorted(pieces[i], key=lambda r: r["start"]):
                assert r["start"] == at and r["doc_tokens"] == len(many[0])
                at += r["length"]
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == s[0]["sequence_tokens"] <= 2048 and at & (at - 1) == 0
    steps = defaultdict(set)
    for k, s in sequences.items():
        steps[s[0]["step_group"]].add((k, s[0]["sequence_tokens"]))
    for s in steps.values():
        assert len({n for _, n in s}) == 1 and sum(n for _, n in s) <= packing.STEP_TOKENS


def test_packing_query(spark):
    check_packing(queries.op7_packing(spark, SMALL).collect(), documents(spark))


def test_packing_odd_rows(odd, none):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    check_packing(queries.pack_documents(odd).collect(), rows)
    assert queries.pack_documents(none).count() == 0


def test_pack_rests_wastes_nothing():
    r = random.Random(0)
    for _ in range(60):
        rests = [packing.Rest(np.arange(r.choice([1, 5, 200, 300, 900, 1500, 2047])), 0, k, 0)
                 for k in range(r.randint(0, 40))]
        out = packing.pack_rests(rests)
        sizes = [sum(len(x.ids) for x in s) for s in out]
        assert sum(sizes) == sum(len(x.ids) for x in rests) and all(n & (n - 1) == 0 for n in sizes)
        small = [n for n in sizes if n < 256]
        assert len(small) == len(set(small))


def test_tokens_are_those_of_the_json_file():
    encode = packing.encoder(public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN)
    texts = ["", "it's  12 o'clock\n\n  <|endoftext|> é 𝒳", " \t x", "a" * 5000, "\0\x85  y"]
    assert [encode(t) + [1] for t in texts] == [x.tolist() for x in ids_of(texts)]


def test_special_strings_have_their_id(spark, monkeypatch):
    """The ids of the plain call of ``tokenizers``, in the query and in the encoder's fallback."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    plain = lambda x: t.encode(x, add_special_tokens=False).ids
    texts = ["before <|endoftext|> after", "<|endoftext|>", "a<|endoftext|><|endoftext|>\n\n b", "x  \n <|endoftext|>  y",
             "it's  <|endoftext|>'s é<|endoftext|>𝒳", "<|endoftext|", "< |endoftext|>", "<|endoftext|> " * 400, ""]
    assert plain(texts[0]) == [19052, 220, 50256, 706]
    paths = public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken")
    assert [packing.encoder(*paths, public.PATTERN, special=True)(x) for x in texts] == [plain(x) for x in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    rows = defaultdict(list)
    for r in queries.pack_documents(df).collect():
        rows[r["doc_id"]].append(r)
    for i, x in enumerate(texts):
        ids = np.array([*plain(x), 1], "<u4")
        assert sum(r["length"] for r in rows[i]) == len(ids) == rows[i][0]["doc_tokens"]
        for r in rows[i]:
            assert crc32(ids[r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
    import tiktoken

    def gives_up(*_, **__):
        raise ValueError("stack overflow")

    monkeypatch.setattr(tiktoken.Encoding, "encode", gives_up)
    assert packing.encoder(*paths, public.PATTERN, special=True)(texts[0]) == plain(texts[0])
