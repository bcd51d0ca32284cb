"""Personal data by weak supervision.

Base kinds (email, ip, card, phone) are found by fixed patterns and always reported.  Looser
patterns give further candidates: national phone numbers (North America, France, Germany, Spain),
social security numbers, account numbers, spelled-out e-mail addresses and titled names.  Nobody labels them; instead

1. labelers vote on every candidate, base ones included: 1 (personal data), -1 (not), 0 (no
   opinion).  They look at the form (regex), at lists of known values (gazetteer), at checksums
   and ranges, at the words in front (context), and at the characters next to it;
2. expectation-maximisation over the vote patterns of the whole corpus estimates, per kind, how
   reliable each labeler is, and with that the probability that a candidate is personal data; for
   each kind one labeler is sure enough to anchor the two classes (a checksum, a
   list, the words in front), and what labelers are worth is shared between kinds;
3. these probabilities train the final span classifier: log-odds of vote and shape features
   (length, share of digits and signs, neighbours), summed per span.

A looser candidate is reported if the classifier gives at least ``least`` and it touches no span
of a base kind.

Built-in functions only.  The texts are read once; spans with their votes are written to the
shared folder.  What EM and training work on are counts of vote patterns: kinds x 3^labelers rows
at most, whatever the corpus' size.

Defined results: null and empty texts have no spans; repeated rows are scanned alike; a corpus
without candidates trains nothing and reports nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termweave.llm.common import id_text, staged
from termweave.llm.native_spans import found

# Kinds in the order of listing; the first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "phone_local", "ssn", "iban", "email_spelled", "name")
BASE = KINDS[:4]
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # North America; France; Spain; Germany.
    "phone_local": (r"(?<![0-9A-Za-z+.-])(?:(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.\x20])[0-9]{3}[-.\x20][0-9]{4}"
                    r"|0[1-9](?:[-.\x20][0-9]{2}){4}|[6-9][0-9]{2}(?:[-.\x20][0-9]{3}){2}|[6-9][0-9]{2}(?:[-.\x20][0-9]{2}){3}"
                    r"|(?:\(0[1-9][0-9]{1,4}\)\x20?|0[1-9][0-9]{1,4}[-/\x20])[0-9]{3,8}(?:[-\x20][0-9]{1,5})?)"
                    r"(?!(?:[.-]|\x20)?[0-9]|[A-Za-z])"),
    "ssn": r"(?<![0-9A-Za-z.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z.-])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "email_spelled": (r"(?<![A-Za-z0-9])[A-Za-z0-9._-]{1,64}\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]{1,63}"
                      r"(?:\x20?[\[(]dot[\])]\x20?[A-Za-z0-9-]{1,63}){1,4}"),
    "name": r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof)\.?\x20[A-Z][a-z]+\x20[A-Z][a-z]+(?![a-z])",
}
# A form that leaves little doubt, per kind.
STRICT = {
    "email": r"^[A-Za-z0-9][A-Za-z0-9._%+-]*+@(?:[A-Za-z0-9-]++\.)++[A-Za-z]{2,}$",
    "ip": r"^(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?:\.|$)){4}",
    "card": r"^(?:[0-9]{4}([\x20-]?)[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{4}([\x20-]?)[0-9]{6}\2[0-9]{5}|[0-9]{12,19})$",
    "phone": r"^\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{1,4}\)[\x20.-]?)?[0-9]{2,4}(?:[\x20.-]?[0-9]{2,4}){1,3}$",
    "phone_local": (r"^\([2-9][0-9]{2}\)\x20?[2-9][0-9]{2}-[0-9]{4}$|^[2-9][0-9]{2}([-.\x20])[2-9][0-9]{2}\1[0-9]{4}$"
                    r"|^0[1-9](?:([-.\x20])[0-9]{2})(?:\2[0-9]{2}){3}$|^[6-9][0-9]{2}([-.\x20])[0-9]{3}\3[0-9]{3}$"
                    r"|^[6-9][0-9]{2}([-.\x20])[0-9]{2}\4[0-9]{2}\4[0-9]{2}$"
                    r"|^\(?0[1-9][0-9]{1,4}[)/\x20-]\x20?[0-9]{3,8}(?:[-\x20][0-9]{1,5})?$"),
    "ssn": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$",
    "iban": r"^[A-Z]{2}[0-9]{2}(?:\x20[A-Z0-9]{4})*(?:\x20[A-Z0-9]{1,4})?$|^[A-Z]{2}[0-9]{2}[A-Z0-9]+$",
    "email_spelled": r"^[A-Za-z0-9._-]+\x20?\[at\]|^[A-Za-z0-9._-]+\x20?\(at\)",
    "name": r"^(?:Mr|Mrs|Ms|Dr|Prof)\.",
}
# Known beginnings or endings, per kind: domains, issuers, country codes, given names.
GAZETTEER = {
    "email": r"\.(?:com|org|net|edu|gov|io|info|de|fr|es|uk|eu|it|nl|ch|at)$",
    "ip": r"^(?!0\.|127\.|255\.)",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)",
    "phone": r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])",
    "phone_local": r"^\(?(?:0[1-9]|2(?:0[1-9]|1[0-9]|[2-9][0-9])|[3-9][0-9]{2})",
    "ssn": r"^[0-7]",
    "iban": r"^(?:DE|FR|ES|GB|IT|NL|CH|AT|BE|IE|PL|PT|SE|NO|DK|FI)",
    "email_spelled": r"(?i)(?:com|org|net|edu|de|fr|es|uk|eu)$",
    "name": r"\x20(?:" + "|".join((
        "Adam Alan Albert Alexander Alice Amy Andrew Angela Ann Anna Anne Anthony Barbara Benjamin Betty Brian Carl Carol "
        "Catherine Charles Christopher Daniel David Deborah Dennis Donald Donna Dorothy Edward Elizabeth Emily Emma Eric "
        "Frank George Grace Hannah Harry Helen Henry Jack James Jane Janet Jason Jennifer Jessica Joan John Joseph Julia "
        "Karen Kevin Laura Linda Lisa Margaret Mark Mary Matthew Michael Nancy Nicholas Oliver Olivia Patricia Patrick Paul "
        "Peter Rebecca Richard Robert Ruth Samuel Sandra Sarah Scott Sophie Stephen Steven Susan Thomas Timothy Victoria William "
        "Andreas Bernd Birgit Christian Claudia Dieter Friedrich Hans Heike Ingrid Johannes Karl Katharina Klaus Martin Petra "
        "Sabine Stefan Ursula Wolfgang Camille Claire Denis Dominique Jacques Jean Luc Marie Michel Nathalie Olivier Philippe "
        "Pierre Sylvie Antonio Carlos Carmen Elena Isabel Javier Jose Juan Lucia Luis Manuel Maria Miguel Pablo Pedro Rosa").split())
             + r")\x20",
}
CONTEXT = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write|address|correo|courriel)\b",
    "ip": r"(?i)\b(?:ip|host|server|address|login|client|from)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|credit|payment|karte|carte|tarjeta)\b",
    "phone": r"(?i)\b(?:phone|call|tel|fax|mobile|cell|contact|telefon|téléphone|teléfono)\b",
    "phone_local": r"(?i)\b(?:phone|call|tel|fax|mobile|cell|contact|telefon|téléphone|teléfono)\b",
    "ssn": r"(?i)\b(?:ssn|social security|insurance|tax)\b",
    "iban": r"(?i)\b(?:iban|account|bank|konto|compte|cuenta)\b",
    "email_spelled": r"(?i)\b(?:e-?mail|mail|contact|write|address|correo|courriel)\b",
    "name": r"(?i)\b(?:dear|contact|with|by|from|signed|patient|client)\b",
}
AGAINST = (r"(?i)\b(?:version|order|isbn|invoice|chapter|build|release|serial|page|figure|section|part|item|ticket|model"
           r"|reference|code|sku|article|artikel|bestellung|rechnung|référence|commande|facture|pedido|factura)\b")
NEAR = 40
LABELERS = ("form", "gazetteer", "checks", "context", "neighbours")
# The labeler whose votes anchor the estimation, per looser kind.
SURE = {"phone_local": "context", "ssn": "context", "iban": "checks", "email_spelled": "gazetteer", "name": "gazetteer"}
ANCHOR = 0.98  # probability of an anchored candidate, or one less it
SHARED = 5.0  # weight, in candidates, of what all kinds together say about a labeler
LEAST = 0.9
ROUNDS = 6


def luhn(digits: Column) -> Column:
    """Whether the checksum of a string of digits holds."""
    back = F.reverse(digits)
    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + F.when(
        i % 2 == 1, back.substr(i, F.lit(1)).cast("int")).otherwise(
        F.when(back.substr(i, F.lit(1)).cast("int") > 4, 2 * back.substr(i, F.lit(1)).cast("int") - 9)
        .otherwise(2 * back.substr(i, F.lit(1)).cast("int"))))
    return total % 10 == 0


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _small_parts(match: Column) -> Column:
    return F.forall(F.split(match, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3) & F.forall(
        F.split(match, r"\."), lambda p: F.coalesce(F.expr("0") + F.substring(
            F.regexp_replace(p, "^0+", ""), 1, 3).try_cast("int"), F.lit(0)) <= 255)


def _valid(kind: str, match: Column) -> Column | None:
    """The condition that a base match must meet, or what checks a looser one."""
    n = F.length(_digits(match))
    if kind == "ip":
        return _small_parts(match)
    if kind == "card":
        return (n >= 12) & (n <= 19) & luhn(_digits(match))
    if kind == "phone":
        return (n >= 9) & (n <= 15)
    return None


def mod_97(iban: Column) -> Column:
    """The account number's remainder: first four characters last, letters as 10 to 35."""
    c = F.regexp_replace(iban, " ", "")
    order = F.split(F.concat(F.substring(c, 5, 40), F.substring(c, 1, 4)), "")
    return F.aggregate(order, F.lit(0), lambda r, x: F.when(
        x.rlike("^[0-9]$"), (10 * r + F.ascii(x) - 48) % 97).otherwise((100 * r + F.ascii(x) - 55) % 97).cast("int"))


def _checks(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.when(F.length(match) > 254, -1).otherwise(1)
    if kind == "iban":
        return F.when(mod_97(match) == 1, 1).otherwise(-1)
    if kind in BASE:
        return F.lit(1)  # what fails is no candidate
    return F.lit(0)


def _vote(yes: Column, no: Column | bool = True) -> Column:
    return F.when(yes, 1).when(no if isinstance(no, Column) else F.lit(no), -1).otherwise(0)


def _candidates(text: Column, kind: str, labelers: tuple[str, ...] = LABELERS) -> Column:
    hits = found(text, PATTERNS[kind])
    if _valid(kind, F.lit("")) is not None:
        hits = F.filter(hits, lambda h: _valid(kind, h["match"]))

    def one(h):
        m = h["match"]
        before = F.substring(text, F.greatest(h["start"] + 1 - NEAR, F.lit(1)), F.least(h["start"], F.lit(NEAR)))
        left = F.when(h["start"] > 0, F.substring(text, h["start"], F.lit(1))).otherwise("")
        right = F.substring(text, h["end"] + 1, F.lit(1))
        glued = left.rlike(r"[\p{L}\p{N}_]") | right.rlike(r"[\p{L}\p{N}_]")
        against = before.rlike(AGAINST)
        votes = F.array(*[v if name in labelers else F.lit(0) for name, v in zip(LABELERS, (
            _vote(m.rlike(STRICT[kind])),
            _vote(m.rlike(GAZETTEER[kind]), kind in BASE or SURE.get(kind) == "gazetteer"),
            _checks(kind, m),
            _vote(before.rlike(CONTEXT[kind]) & ~against, against),
            _vote(~glued)), strict=True)])
        n = F.length(m)
        shape = F.array(
            F.least(F.floor(n / 6), F.lit(6)).cast("int"),
            F.floor(4 * F.length(_digits(m)) / n).cast("int"),
            F.floor(4 * F.length(F.regexp_replace(m, r"[\p{L}\p{N}]", "")) / n).cast("int"),
            F.when(left == "", 0).when(left.rlike(r"\s"), 1).otherwise(2),
            F.when(right == "", 0).when(right.rlike(r"\s"), 1).when(right.rlike(r"[.,;:!?)]"), 2).otherwise(3))
        return F.struct(F.lit(kind).alias("kind"), F.lit(KINDS.index(kind)).alias("rank"),
                        h["start"].alias("start"), h["end"].alias("end"),
                        votes.alias("votes"), shape.alias("shape"))

    return F.transform(hits, one)


def _touches(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         labelers: tuple[str, ...] = LABELERS) -> DataFrame:
    """doc_id, base, loose: arrays of candidates with votes and shape; loose ones touch no base span."""
    rows = id_text(docs, id_col, text_col)
    text = F.col("text")
    got = rows.select("doc_id", F.concat(*[_candidates(text, k, labelers) for k in BASE]).alias("base"),
                      F.concat(*[_candidates(text, k, labelers) for k in KINDS if k not in BASE]).alias("loose"))
    free = F.filter("loose", lambda x: ~F.exists("base", lambda b: _touches(x, b)))
    return got.select("doc_id", "base", free.alias("loose"))


def _anchored(free: Column) -> Column:
    """``free``, or for a candidate whose votes are sure, the anchor: true if its kind's sure labeler is
    for it and no vote against; false if that labeler is against it, and is a checksum or is not
    contradicted by the words in front."""
    at = F.create_map(*[F.lit(x) for k in KINDS for x in (k, LABELERS.index(SURE.get(k, "checks")))])
    sure, context = F.get("votes", at[F.col("kind")]), F.get("votes", LABELERS.index("context"))
    no = (sure == -1) & ((at[F.col("kind")] == LABELERS.index("checks")) | (context < 1))
    yes = (sure == 1) & ~F.exists("votes", lambda v: v == -1)
    return F.when(no, F.lit(1 - ANCHOR)).when(yes, F.lit(ANCHOR)).otherwise(free)


def estimate(patterns: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Expectation-maximisation: adds ``q``, the probability that a candidate with these votes is
    personal data.  ``patterns``: kind, votes, shape, n.

    Starts from the majority of the votes.  Sure candidates keep their anchor, so that the two
    classes keep their meaning; the others are estimated.  The share of each vote among true and
    among false candidates is estimated per kind and labeler, with what all kinds say about
    the labeler counting as ``SHARED`` candidates more, so that kinds with few candidates, or with
    candidates of one class only, know what a vote is worth."""
    total = F.aggregate("votes", F.lit(0), lambda s, v: s + v)
    start = 1 / (1 + F.exp(-total.cast("double")))
    now = staged(patterns.groupBy("kind", "votes").agg(F.sum("n").alias("n"))
                 .withColumn("q", _anchored(start)).coalesce(1), "pii-votes")
    true, false = F.sum(F.col("n") * F.col("q")), F.sum(F.col("n") * (1 - F.col("q")))
    for _ in range(rounds):
        long = now.select("kind", "votes", "n", "q", F.posexplode("votes").alias("labeler", "vote"))
        sides = now.groupBy("kind").agg(true.alias("t1"), false.alias("t0"))
        every = now.agg(true.alias("a1"), false.alias("a0"))  # one row
        common = long.groupBy("labeler", "vote").agg(true.alias("c1"), false.alias("c0")).join(F.broadcast(every)).select(
            "labeler", "vote", ((F.col("c1") + 1) / (F.col("a1") + 3)).alias("g1"),
            ((F.col("c0") + 1) / (F.col("a0") + 3)).alias("g0"))
        shares = (long.groupBy("kind", "labeler", "vote").agg(true.alias("s1"), false.alias("s0"))
                  .join(sides, "kind").join(common, ["labeler", "vote"])
                  .select("kind", "labeler", "vote",
                          (F.log((F.col("s1") + SHARED * F.col("g1")) / (F.col("t1") + SHARED))
                           - F.log((F.col("s0") + SHARED * F.col("g0")) / (F.col("t0") + SHARED))).alias("odds"),
                          F.log((F.col("t1") + 1) / (F.col("t0") + 1)).alias("prior")))
        odds = long.join(shares, ["kind", "labeler", "vote"]).groupBy("kind", "votes", "n").agg(
            F.sum("odds").alias("odds"), F.first("prior").alias("prior"))
        now = staged(odds.select("kind", "votes", "n", _anchored(1 / (1 + F.exp(-F.col("odds") - F.col("prior")))).alias("q"))
                     .coalesce(1), "pii-votes")
    return now


def train(patterns: DataFrame, judged: DataFrame) -> DataFrame:
    """The final classifier: (kind, feature, value, odds); feature -1 is the kind's prior.

    ``q`` of each candidate's votes is its label; votes and shape are the features."""
    rows = patterns.join(judged.select("kind", "votes", "q"), ["kind", "votes"])
    one, zero = F.sum(F.col("n") * F.col("q")), F.sum(F.col("n") * (1 - F.col("q")))
    sides = rows.groupBy("kind").agg(one.alias("t1"), zero.alias("t0"))
    features = rows.select("kind", "n", "q", F.posexplode(F.concat("votes", "shape")).alias("feature", "value"))
    odds = (features.groupBy("kind", "feature", "value").agg(one.alias("s1"), zero.alias("s0")).join(sides, "kind")
            .select("kind", "feature", "value", (F.log((F.col("s1") + 1) / (F.col("t1") + 3))
                                                - F.log((F.col("s0") + 1) / (F.col("t0") + 3))).alias("odds")))
    prior = sides.select("kind", F.lit(-1).alias("feature"), F.lit(0).alias("value"),
                         F.log((F.col("t1") + 1) / (F.col("t0") + 1)).alias("odds"))
    return odds.unionByName(prior)


def private_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST,
                  rounds: int = ROUNDS, labelers: tuple[str, ...] = LABELERS) -> DataFrame:
    """doc_id, base, spans: arrays of struct<kind, rank, start, end, p>; one row per input row.
    ``labelers``: those that vote."""
    scanned = staged(scan(docs, id_col, text_col, labelers), "pii")
    patterns = staged(scanned.select(F.explode(F.concat("base", "loose")).alias("c"))
                      .groupBy("c.kind", "c.votes", "c.shape").agg(F.count("*").alias("n")).coalesce(1), "pii-patterns")
    weights = train(patterns, estimate(patterns, rounds))
    # kinds x features x values rows, a few hundred at most: they become part of the expression.
    table = {f"{r['kind']} {r['feature']} {r['value']}": r["odds"] for r in weights.collect()}
    known = F.create_map(*[F.lit(x) for kv in sorted(table.items()) for x in kv]) if table else F.lit(None).cast(
        "map<string,double>")

    def judged(c):
        values = F.concat(c["votes"], c["shape"])
        odds = F.aggregate(F.transform(values, lambda v, i: F.coalesce(
            known[F.concat_ws(" ", c["kind"], i, v)], F.lit(0.0))), F.lit(0.0), lambda s, v: s + v)
        prior = F.coalesce(known[F.concat_ws(" ", c["kind"], F.lit("-1"), F.lit("0"))], F.lit(0.0))
        return F.struct(c["kind"].alias("kind"), c["rank"].alias("rank"), c["start"].alias("start"),
                        c["end"].alias("end"), (1 / (1 + F.exp(-odds - prior))).alias("p"))

    return (scanned.select("doc_id", F.transform("base", judged).alias("base"),
                           F.filter(F.transform("loose", judged), lambda c: c["p"] >= least).alias("more"))
            .select("doc_id", "base", F.concat("base", "more").alias("spans")))
