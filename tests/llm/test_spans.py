"""Secret scan and personal data against plain regular expressions."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest
from llm_data import SMALL, none, odd  # noqa: F401
from pyspark.sql import functions as F

from termweave.llm import native_spans, pii, queries, secret_scan

SECRET_KINDS = [
    ("assign", r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"""
               r"""[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
     lambda m: len(m[1]) >= 12),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 16),
]


def digits(s):
    return re.sub("[^0-9]", "", s)


def luhn(s):
    total = 0
    for i, c in enumerate(reversed(digits(s))):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


PII_KINDS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m[0])) <= 19 and luhn(m[0])),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m[0])) <= 15),
]


def expected(text, kinds):
    spans = sorted((m.start(), rank, m.end(), kind) for rank, (kind, p, ok) in enumerate(kinds)
                   for m in re.finditer(p, text or "") if ok(m))
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)


PARTS = ["password=", "token: ", "API_KEY = '", "secret", "passwd:", "AKIA", "ABCD1234EFGH5678", "0123456789abcdef",
         "deadbeef", " ", "\n", "'", "=", "x", "é", "𝒳", "a@b.co", "@", ".", "1.2.3.4", "300.1.2.3", "4111 1111 1111 1111",
         "4111111111111112", "+1 (234) 555-6789", "+", "9", "-", "5500-0000-0000-0004", "user.name+x@mail.example.org",
         "_x", "00", "1.2.3.4.5.6.7.8", "a@b.c_d@e.f"]


@pytest.fixture(scope="module")
def mixed(spark):
    r = random.Random(7)
    texts = ["".join(r.choice(PARTS) for _ in range(r.randint(0, 25))) for _ in range(400)]
    texts += ["7" * 30_000, "1." * 5_000, "a" * 30_000 + "@b." + "c." * 5_000 + "d", "1 " * 20_000, None, ""]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), texts


def test_secret_base_spans(mixed):
    df, texts = mixed
    got = dict(secret_scan.scan(df).select("doc_id", native_spans.written(F.col("base"))).collect())
    assert got == {i: expected(t, SECRET_KINDS) for i, t in enumerate(texts)}


def test_pii_base_spans(mixed):
    df, texts = mixed
    got = dict(pii.scan(df).select("doc_id", native_spans.written(F.col("base"))).collect())
    assert got == {i: expected(t, PII_KINDS) for i, t in enumerate(texts)}


def test_queries_on_documents(spark):
    import pyarrow.dataset as ds

    docs = ds.dataset(f"{SMALL}/documents.parquet").to_table(columns=["doc_id", "text"]).to_pydict()
    for query, kinds in ((queries.op1_secret_scan, SECRET_KINDS), (queries.op2_pii_weak_supervision, PII_KINDS)):
        got = {r["doc_id"]: r.asDict() for r in query(spark, SMALL).collect()}
        assert sorted(got) == sorted(docs["doc_id"])
        for i, text in zip(docs["doc_id"], docs["text"], strict=True):
            want = expected(text, kinds)
            assert got[i]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
            n = Counter(x.split(":")[0] for x in want.split(",") if x)
            assert all(got[i][f"n_{k}"] == n[k] for k, _, _ in kinds)
            assert set(want.split(",")) - {""} <= set(got[i]["spans"].split(","))


def test_random_tokens_are_discovered(spark):
    r = random.Random(5)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    secrets = ["".join(r.choice(alphabet) for _ in range(44)) for _ in range(20)]
    plain = [f"chapter-{i}-of-the-long-story-about-nothing-much-at-all" for i in range(20)]
    plain += ["x1" * 25, "x" * 40 + "1", "img-20240101-front-page-headline-picture", "src/main/java/org/example/HelloWorld2"]
    df = spark.createDataFrame([(i, f"so {t} it is") for i, t in enumerate(secrets + plain)], "doc_id long, text string")
    got = {r["doc_id"] for r in secret_scan.secrets(df).where(F.size("spans") > 0).collect()}
    assert not any(i >= len(secrets) for i in got)
    assert len(got) >= 17
    again = {r["doc_id"] for r in secret_scan.secrets(df, rescan=True).where(F.size("spans") > 0).collect()}
    assert again == got


def test_random_tokens_without_a_digit(spark):
    """Keys of letters only are candidates, and long words do not hide the others."""
    r = random.Random(6)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    keys = ["".join(r.choice(letters) for _ in range(44)) for _ in range(20)]
    mixed = ["".join(r.choice(letters + "0123456789") for _ in range(21)) + "7a" for _ in range(20)]
    syllables = ["the", "on", "er", "ing", "at", "is", "ou", "me", "ra", "lo", "du", "pi", "sk"]
    words = ["".join(r.choice(syllables) for _ in range(r.randint(11, 16))) for _ in range(200)]
    frame = lambda rows: spark.createDataFrame(
        [(i, f"so {t} it is") for i, t in rows], "doc_id long, text string")
    hits = lambda rows: {x["doc_id"] for x in secret_scan.secrets(frame(rows)).where(
        F.size("spans") > 0).collect()}
    rows = list(enumerate(keys + mixed + words))
    got = hits(rows)
    assert len(got & set(range(20))) >= 17 and not any(i >= 40 for i in got)
    assert got & set(range(20, 40)) == hits(rows[20:40])


def battery_by_hand(t):
    """The battery of one token, from its definitions."""
    names = [(k, a, x) for k, (a, x) in secret_scan.ENCODINGS.items() if set(t) <= set(a)]
    name, alphabet, excess = names[0]
    n, size = len(t), len(alphabet)
    chi = sum((t.count(c) - n / size) ** 2 / (n / size) for c in alphabet)
    z = (chi - (size - 1 + excess * n)) / math.sqrt(2 * (size - 1 + 2 * excess * n))
    p = 1 / (1 + math.exp(-(1.5976 * z + 0.07056 * z ** 3)))
    high = [alphabet.index(c) >= size // 2 for c in t]
    h, two = sum(high), 2 * sum(high) * (n - sum(high))
    changes = sum(a != b for a, b in zip(high, high[1:]))
    spread = math.sqrt(max(two * (two - n) / (n * n * (n - 1)), 1e-9))
    z_runs = 99.0 if h in (0, n) else (changes - two / n) / spread
    x = [alphabet.index(c) for c in t]
    mean = sum(x) / n
    sq = sum((v - mean) ** 2 for v in x)
    lag = sum((a - mean) * (b - mean) for a, b in zip(x, x[1:]))
    return name, z_runs, (99.0 if sq < 1e-9 else (lag / sq + 1 / n) * math.sqrt(n)), p


def test_battery_equals_its_definitions(spark):
    r = random.Random(12)
    tokens = ["".join(r.choice(a[:r.randint(2, len(a))]) for _ in range(r.randint(20, 90)))
              for a, _ in secret_scan.ENCODINGS.values() for _ in range(25)]
    tokens += ["a" * 20, "ab" * 12, "Z" * 33, "the-quick-brown-fox-jumps", "0" * 19 + "1"]
    df = spark.createDataFrame([(t,) for t in tokens], "t string")
    for row in df.select("t", secret_scan.battery(F.col("t")).alias("b")).collect():
        name, runs, serial, p = battery_by_hand(row["t"])
        b = row["b"]
        assert b["encoding"] == name, row["t"]
        assert b["z_runs"] == pytest.approx(runs, abs=1e-6) and b["p_text"] == pytest.approx(p, abs=1e-9)
        assert b["z_serial"] == pytest.approx(serial, abs=1e-6), row["t"]


def test_discoveries_follow_the_step_up_rule(spark):
    """Spans of the query's operator against the rule applied by hand to the scan's own p-values."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    r = random.Random(13)
    keys = spark.createDataFrame([(-1 - i, "key " + "".join(r.choice("ABCDEFGHabcdefgh0123456789+/xyzXYZ") for _ in range(
        r.randint(20, 60)))) for i in range(60)], docs.schema)
    both = docs.unionByName(keys)
    bands = {}
    for row in secret_scan.scan(both).select("doc_id", F.explode("tokens").alias("t")).collect():
        t = row["t"]
        size, b = t["end"] - t["start"], t["test"]
        fine = abs(b["z_runs"]) <= 3 and abs(b["z_serial"]) <= 3
        step = math.floor(-20 * math.log10(max(b["p_text"], 1e-30))) if fine else -1
        bands.setdefault((sum(size >= x for x in secret_scan.BANDS), t["mixed"]), []).append(
            (step, row["doc_id"], t["start"], t["end"]))
    want = set()
    for tests in bands.values():
        passing = [s for s in {x[0] for x in tests} if s >= 0 and 10 ** (-s / 20) <= 0.05 * sum(
            x[0] >= s for x in tests) / len(tests)]
        want |= {x[1:] for x in tests if passing and x[0] >= min(passing)}
    got = {(x["doc_id"], x["s"]["start"], x["s"]["end"]) for x in secret_scan.secrets(both).select(
        "doc_id", F.explode("spans").alias("s")).where("s.kind = 'random'").collect()}
    assert got == want and len(want) > 20


def test_rest_of_a_token_beside_pattern_spans(spark):
    """What patterns leave of a token is tested by itself, at its own place."""
    r = random.Random(8)
    key = lambda: "".join(r.choice("GHIJKLMNOPQRSTUVWXYZghijklmnopqrstuvwxyz") for _ in range(44))
    rows, want = [], {}
    for i in range(20):
        a, b = key(), key()
        rows.append((i, f"é {a}0123456789abcdef{b} short0123456789abcdefleft"))
        want[i] = {("hex", 46, 62), ("random", 2, 46), ("random", 62, 106), ("hex", 112, 128)}
    rows.append((20, "/" * 4 + "0123456789abcdef" * 3))
    want[20] = {("hex", 4, 52)}
    got = {x["doc_id"]: {(s["kind"], s["start"], s["end"]) for s in x["spans"]} for x in secret_scan.secrets(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[20] == want[20] and sum(len(want[i] - got[i]) for i in range(20)) <= 6
    for i in range(20):
        assert got[i] <= want[i] and {s for s in want[i] if s[0] == "hex" and s[1] == 46} <= got[i], got[i]


def test_redaction_covers_overlaps(spark):
    df = spark.createDataFrame([("ab𝒳cdefgh",), ("",)], "text string")
    spans = F.when(F.col("text") == "", F.array().cast("array<struct<start:int,end:int>>")).otherwise(
        F.array(*[F.struct(F.lit(a).alias("start"), F.lit(b).alias("end")) for a, b in ((3, 5), (1, 2), (4, 6), (3, 4))]))
    assert [x[0] for x in df.select(native_spans.replaced(F.col("text"), spans, "#")).collect()] == ["a#𝒳#fgh", ""]


def test_em_finds_the_reliable_labelers(spark):
    r = random.Random(3)
    counts = Counter()
    for _ in range(4000):
        true = r.random() < 0.3
        say = lambda p: (1 if true else -1) if r.random() < p else (-1 if true else 1)
        counts[(say(0.97), say(0.95), say(0.5), say(0.9), 0), true] += 1
    by = Counter()
    for (votes, _), n in counts.items():
        by[votes] += n
    patterns = spark.createDataFrame([("name", list(v), [0] * 5, n) for v, n in by.items()],
                                     "kind string, votes array<int>, shape array<int>, n long")
    q = {tuple(x["votes"]): x["q"] for x in pii.estimate(patterns).collect()}
    right = sum(n for (v, true), n in counts.items() if (q[v] > 0.5) == true)
    assert right / 4000 > 0.96
    assert q[(1, 1, -1, 1, 0)] > 0.95 and q[(-1, -1, 1, -1, 0)] < 0.05


def test_odd_rows(odd, none):
    for run in (secret_scan.secrets, pii.private_spans):
        got = run(odd)
        assert got.count() == odd.count()
        assert run(none).count() == 0
        assert got.where("doc_id <= 3 and size(spans) > 0").count() == 0
