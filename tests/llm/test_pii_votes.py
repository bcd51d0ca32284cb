"""Looser personal data is told from its look-alikes by the votes."""

import random

import pytest
from llm_data import MEDIUM

from termweave.llm import pii

EACH = 40
NAMES = ["Alice", "Carlos", "Hans", "Marie", "Robert", "Sabine", "Pedro", "Claire"]
WORDS = "lorem dolor amet elit tempor magna aliqua veniam nostrud laboris".split()


def iban(r, good):
    digits = "".join(r.choice("0123456789") for _ in range(18))
    check = 98 - int(digits + "131400") % 97
    if not good:
        check = (check + r.randint(1, 95) - 2) % 97 + 2
        if (int(digits + f"1314{check:02d}")) % 97 == 1:
            check = check % 97 + 1
    x = f"DE{check:02d}{digits}"
    return " ".join(x[i:i + 4] for i in range(0, len(x), 4))


def d(r, n, first="0123456789"):
    return r.choice(first) + "".join(r.choice("0123456789") for _ in range(n - 1))


def planted(r):
    """(kind, text before, candidate, whether it is personal data)."""
    ssn = lambda: f"{r.randint(100, 599)}-{d(r, 2, '123456789')}-{d(r, 4, '123456789')}"
    phones = [lambda: f"({d(r, 3, '2345678')}) {d(r, 3, '23456789')}-{d(r, 4)}",
              lambda: f"0{d(r, 1, '123456789')} {d(r, 2)} {d(r, 2)} {d(r, 2)} {d(r, 2)}",
              lambda: f"0{d(r, 2, '23456789')}/{d(r, 7)}", lambda: f"6{d(r, 2)} {d(r, 3)} {d(r, 3)}"]
    for i in range(EACH):
        yield "iban", "account", iban(r, True), True
        yield "iban", "account", iban(r, False), False
        yield "ssn", "her SSN is", ssn(), True
        yield "ssn", "see order", ssn(), False
        yield "phone_local", "please call", phones[i % 4](), True
        yield "phone_local", "spare part", phones[i % 4](), False
        yield "email_spelled", "write to", f"{r.choice(WORDS)}.{i} [at] {r.choice(WORDS)}{i} [dot] com", True
        yield "email_spelled", "we met", f"{r.choice(WORDS)} [at] {r.choice(WORDS)} [dot] sharp", False
        yield "name", "with", f"Dr. {r.choice(NAMES)} {r.choice(WORDS).title()}", True
        yield "name", "a can of", f"Dr. {r.choice(WORDS).title()} {r.choice(WORDS).title()}", False


@pytest.fixture(scope="module")
def corpus(spark):
    r = random.Random(17)
    base = [x["text"] for x in spark.read.parquet(f"{MEDIUM}/documents.parquet").where("text is not null").limit(600).collect()]
    rows, told = [], []
    for i, (kind, before, x, real) in enumerate(planted(r)):
        head = f"{' '.join(r.choices(WORDS, k=12))} {before} "
        rows.append((i, f"{head}{x} {' '.join(r.choices(WORDS, k=8))}"))
        told.append((i, kind, len(head), real))
    rows += [(10_000 + i, t) for i, t in enumerate(base)]
    return spark.createDataFrame(rows, "doc_id long, text string"), told


def reported(df, **params):
    return {(r["doc_id"], s["kind"], s["start"]) for r in pii.private_spans(df, **params).collect() for s in r["spans"]}


def test_true_ones_are_reported_and_false_ones_not(corpus):
    df, told = corpus
    got = reported(df)
    for kind in pii.SURE:
        for real in (True, False):
            mine = [(i, k, at) in got for i, k, at, good in told if k == kind and good == real]
            share = sum(mine) / len(mine)
            assert share >= 0.9 if real else share <= 0.1, (kind, real, share)


@pytest.mark.parametrize("removed, kind", [("checks", "iban"), ("context", "ssn"), ("gazetteer", "name")])
def test_a_labeler_less_changes_the_result(corpus, removed, kind):
    df, told = corpus
    less = reported(df, labelers=tuple(x for x in pii.LABELERS if x != removed))
    kept = {(i, k, at) for i, k, at, _ in told if k == kind}
    assert reported(df) & kept != less & kept


@pytest.mark.parametrize("number, rest", [("DE89 3704 0044 0532 0130 00", 1), ("GB82WEST12345698765432", 1),
                                          ("FR1420041010050500013M02606", 1), ("DE88 3704 0044 0532 0130 00", 0)])
def test_account_checksum(spark, number, rest):
    got = spark.createDataFrame([(number,)], "x string").select(pii.mod_97(pii.F.col("x"))).first()[0]
    assert (got == 1) == bool(rest)
