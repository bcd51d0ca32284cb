"""Cheapest repair of damaged conversations, with the least audit string among the cheapest.

A conversation's rows pass an automaton for the role initials ``(s?(ua)+)?``: nothing yet, after
s, after u, after a.  A node is (rows read, state); arcs are the edits Delete, Insert, Keep and
Rerole with their costs.

* **Cost.**  A row turns the costs of four states into those of four states, a 4 x 4 matrix in
  (min, +) algebra.  Blocks of at most ``BLOCK`` rows are multiplied out, then blocks of blocks,
  until a conversation is one matrix, and the costs to the end are handed down again.  So a
  conversation may hold any share of all rows: no task sees more than a block of it.
* **Audit.**  With the costs known, only optimal arcs are left.  Prefix-doubling path ranking in
  each block: nodes are ranked by their first edit, then by audits of 2, 4, 8 ... edits, each
  from the rank of its first half and that of the node its first half leads to, with pointers
  that double alongside.  At the end, every node takes the arc of the least (edit, rank of the
  node it leads to), and the path is read off through the doubled pointers.  An edit leads from a
  node to one node only, so equal audits end in the same node, and the least audit of a block,
  which ends when its last row is read, needs no knowledge of the next one.
* **Text.**  At last the rows of a conversation pass, in order, through one task as a stream that
  follows the audit, as SHA-256 of one text asks for; memory holds a batch, and the audit.

Defined results: null roles and texts count as one space; rows are ordered by turn (nulls first),
then role, then a digest of the text; repeated rows are duplicates; a null id is a conversation of
its own; a role's initial is its first character and an empty role has none; a conversation with
all rows lost has zeros, an empty audit and the hash of the empty string; an empty table gives no
rows.  Only the named columns are read.  Texts are taken whole, whatever their length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from termweave.llm.common import WORD_SPACE, _arrow_schema, staged
from termweave.llm.ranks import ranked

BLOCK = 256
INSERT, RENAME, DROP, CUT = 2, 2, 3, 1  # fixed costs: Insert, Rerole, Delete, a truncated row that stays
FAR = 1 << 50
#: Costs from each state (nothing, after s, after u, after a) to the end, once all rows are read.
LAST = [0, 2 * INSERT, INSERT, 0]
#: The role that an inserted or renamed row gets in each state, and the state it leads to.
NEXT_ROLE, NEXT = ["user", "user", "assistant", "user"], [2, 2, 3, 2]
INITIALS = "sua"
OK, TRUNCATED, BLANK, DUPLICATE = range(4)


# -- rows ------------------------------------------------------------------------------------


def key_of(conv: Column) -> Column:
    """The conversation's id as text without nulls."""
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit(""))


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """(key, turn, role, text) after damage by crc32(``conv:turn``) % 20: 0 drops a row, 1 empties
    its text, 2 removes ``.!?`` from it, 3 repeats it, 4 sets the role user."""
    conv, turn = F.col(f"`{conv_col}`"), F.col(f"`{turn_col}`")
    sp = F.lit(" ")
    kind = F.crc32(F.concat(F.coalesce(conv.cast("string"), sp), F.lit(":"), F.coalesce(turn.cast("string"), sp))) % 20
    x = rows.select(key_of(conv).alias("key"), turn.alias("turn"), F.coalesce(F.col(f"`{role_col}`"), sp).alias("role"),
                    F.coalesce(F.col(f"`{text_col}`"), sp).alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, F.lit("")).when(
        F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return x.select("key", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def _faults(rows: DataFrame) -> DataFrame:
    """(key, pos, code): code = 4 * initial's number + first fault."""
    same = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))
    body, initial = F.rtrim(F.col("text"), F.lit(WORD_SPACE)), F.substring("role", 1, 1)
    x = rows.select("key", "pos", same.alias("same"), (F.length(body) == 0).alias("blank"),
                    F.substring(body, -1, 1).isin(".", "!", "?").alias("closed"),
                    F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(0).alias("initial"))
    x = staged(x, "conv-facts")
    first = x.groupBy("key", "same").agg(F.min("pos").alias("pos")).select("key", "pos", F.lit(True).alias("new"))
    fault = F.when(F.col("blank"), BLANK).when(F.col("new").isNull(), DUPLICATE).when(~F.col("closed"), TRUNCATED).otherwise(OK)
    return x.join(first, ["key", "pos"], "left").select("key", "pos", (F.col("initial") * 4 + fault).alias("code"))


# -- costs -----------------------------------------------------------------------------------


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(min, +) products of 4 x 4 matrices."""
    return np.minimum((a[..., :, :, None] + b[..., None, :, :]).min(-2), FAR)


def _keep(initial: int) -> list[int]:
    """The state that keeping a row of this initial leads to from each state, -1: not possible.
    Initials: 0 other, 1 s, 2 u, 3 a."""
    return {1: [1, -1, -1, -1], 2: [2, 2, -1, 2], 3: [-1, -1, 3, -1]}.get(initial, [-1] * 4)


def _inserts() -> np.ndarray:
    one = np.full((4, 4), FAR)
    for q in range(4):
        one[q, q] = 0
        one[q, NEXT[q]] = min(one[q, NEXT[q]], INSERT)
    return _times(_times(one, one), one)


def _row_matrix(code: int) -> np.ndarray:
    initial, fault = divmod(code, 4)
    m = np.full((4, 4), FAR)
    for q in range(4):
        m[q, q] = DROP
        if fault in (OK, TRUNCATED):
            stay = CUT if fault == TRUNCATED else 0
            m[q, NEXT[q]] = min(m[q, NEXT[q]], RENAME + stay)
            if (to := _keep(initial)[q]) >= 0:
                m[q, to] = min(m[q, to], stay)
    return _times(_inserts(), m)


#: Inserts and one edit of a row, for every code; the last one, past a block's end, changes nothing.
STEPS = np.stack([_row_matrix(c) for c in range(16)] + [np.where(np.eye(4), 0, FAR).astype(np.int64)])
PAST = 16


def _padded(codes: list[bytes]) -> np.ndarray:
    width = max(map(len, codes))
    return np.frombuffer(b"".join(c.ljust(width, bytes([PAST])) for c in codes), np.uint8).reshape(len(codes), width)


def _by_length(codes: list[bytes], most_cells: int = 1 << 15) -> Iterator[np.ndarray]:
    """Groups of blocks of like length, of bounded size together."""
    order = sorted(range(len(codes)), key=lambda i: len(codes[i]))
    lo = 0
    for hi in range(1, len(order) + 1):
        if hi == len(order) or (hi - lo + 1) * len(codes[order[hi]]) > most_cells or len(codes[order[hi]]) > 2 * len(codes[order[lo]]):
            yield np.array(order[lo:hi])
            lo = hi


def _block_matrices(codes: list[bytes]) -> np.ndarray:
    out = np.empty((len(codes), 4, 4), np.int64)
    for group in _by_length(codes):
        c = _padded([codes[i] for i in group])
        m = STEPS[c[:, 0]]
        for t in range(1, c.shape[1]):
            m = _times(m, STEPS[c[:, t]])
        out[group] = m
    return out


def _map_batches(df: DataFrame, fn, schema: str) -> DataFrame:
    """``fn(dict of column lists) -> dict of column lists`` on every Arrow batch."""
    arrow = _arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_pydict(fn(b.to_pydict()), schema=arrow)
    return df.mapInArrow(run, schema)


def _multiplied(b: dict) -> dict:
    m = _block_matrices(b["codes"])
    return {"key": b["key"], "block": b["block"], "matrix": m.reshape(-1, 16).tolist()}


def _folded(b: dict) -> dict:
    out = []
    for parts in b["parts"]:
        m = np.array(parts[0]["matrix"]).reshape(4, 4)
        for p in parts[1:]:
            m = _times(m, np.array(p["matrix"]).reshape(4, 4))
        out.append(m.ravel().tolist())
    return {"key": b["key"], "block": b["block"], "matrix": out}


def _handed_down(b: dict) -> dict:
    """Costs to the end after each part, from those after the whole."""
    out = {"key": [], "block": [], "exits": []}
    for key, parts, exits in zip(b["key"], b["parts"], b["exits"]):
        now = np.array(exits)
        for p in reversed(parts):
            out["key"].append(key)
            out["block"].append(p["block"])
            out["exits"].append(now.tolist())
            now = np.minimum((np.array(p["matrix"]).reshape(4, 4) + now).min(1), FAR)
    return out


def _exit_costs(blocks: DataFrame, n_blocks: int) -> DataFrame:
    """(key, block, exits): the costs to the end once the block's rows are read."""
    last = F.array(*[F.lit(x).cast("long") for x in LAST])
    if n_blocks <= 1:
        return blocks.select("key", "block", last.alias("exits"))
    level = staged(_map_batches(blocks.select("key", "block", "codes"), _multiplied,
                                "key string, block long, matrix array<long>"), "conv-matrices")
    levels = []
    while n_blocks > 1:
        part = F.struct("block", "matrix")
        groups = staged(level.groupBy("key", F.floor(F.col("block") / BLOCK).cast("long").alias("block"))
                        .agg(F.array_sort(F.collect_list(part)).alias("parts")), "conv-groups")  # BLOCK parts at most
        levels.append(groups)
        n_blocks = -(-n_blocks // BLOCK)
        if n_blocks > 1:
            level = staged(_map_batches(groups, _folded, "key string, block long, matrix array<long>"), "conv-matrices")
    exits = levels[-1].select("key", "block", last.alias("exits"))
    for groups in reversed(levels):
        exits = staged(_map_batches(groups.join(exits, ["key", "block"]), _handed_down,
                                    "key string, block long, exits array<long>"), "conv-exits")
    return exits


# -- least audits ------------------------------------------------------------------------------


def least_audits(codes: np.ndarray, exits: np.ndarray) -> tuple[list[list[str]], np.ndarray, np.ndarray]:
    """For blocks of codes (padded) and their exit costs: the least cheapest audit from each state
    at the block's start until its last row is read, the state it ends in, and the cost from
    there to the conversation's end."""
    n, width = codes.shape
    cost = np.empty((n, width + 1, 4), np.int64)
    cost[:, width] = exits
    for t in range(width - 1, -1, -1):
        cost[:, t] = np.minimum((STEPS[codes[:, t]] + cost[:, t + 1, None, :]).min(-1), FAR)
    # Arcs in the order of their letters: D, I, K, R.  A node is ((block, row), state).
    node = np.arange(n * (width + 1) * 4).reshape(n, width + 1, 4)
    goal = np.full((4, n, width + 1, 4), -1, np.int64)
    here, initial, fault = cost[:, :-1], codes // 4, codes % 4
    past, stays = codes == PAST, (fault <= TRUNCATED) & (codes != PAST)
    extra = np.where(fault == TRUNCATED, CUT, 0)
    keep = np.array([_keep(i) for i in range(5)])[initial]
    for q in range(4):
        def arc(letter, ok, to_t, to_q, price):
            to = node[:, 1:] if to_t else node[:, :-1]
            to_cost = cost[:, 1:] if to_t else cost[:, :-1]
            idx = np.broadcast_to(np.asarray(to_q), codes.shape)[..., None]
            reached = np.take_along_axis(to, np.maximum(idx, 0), -1)[..., 0]
            left = np.take_along_axis(to_cost, np.maximum(idx, 0), -1)[..., 0]
            fits = ok & (idx[..., 0] >= 0) & (here[..., q] < FAR) & (price + left == here[..., q])
            goal[letter, :, :-1, q] = np.where(fits, reached, -1)
        arc(0, ~past, True, q, DROP)
        arc(1, ~past, False, NEXT[q], INSERT)
        arc(2, stays, True, keep[..., q], extra)
        arc(3, stays, True, NEXT[q], RENAME + extra)
    goal = goal.reshape(4, -1)
    flat_past = np.ones((n, width + 1, 4), bool)
    flat_past[:, :-1] = past[..., None]
    flat_past = flat_past.ravel()
    ends = np.arange(goal.shape[1])

    # Ranks by the first edit, then by audits twice as long; ends rank least and point to themselves.
    open_ = goal >= 0
    first = np.where(open_.any(0), open_.argmax(0), 0)
    stop = ~open_.any(0) | flat_past
    rank = np.where(stop, 0, first + 1)
    to = np.where(stop, ends, goal[first, ends])
    while not stop[to].all():
        rank = np.unique(rank * (rank.max() + 1) + rank[to], return_inverse=True)[1]
        to = to[to]

    # The arc of the least (edit, rank of the node it leads to), then its doubled pointers.
    worth = np.where(open_, np.arange(4)[:, None] * (rank.max() + 1) + rank[np.maximum(goal, 0)], FAR)
    best = worth.argmin(0)
    step = np.where(stop, ends, goal[best, ends])
    path, hop = node[:, 0, :].reshape(-1, 1), step
    while True:
        path = np.concatenate([path, hop[path]], 1)
        new = hop[hop]
        if (new == hop).all():
            break
        hop = new
    letters = np.where(stop, 0, np.frombuffer(b"DIKR", np.uint8)[best])[path]
    texts = [bytes(x[x > 0]).decode() for x in letters.astype(np.uint8)]
    final = path[:, -1]
    # A padded block ends before its last column: states do not change past the end.
    return [texts[i:i + 4] for i in range(0, len(texts), 4)], (final % 4).reshape(n, 4), cost[:, 0]


def _audited(b: dict) -> dict:
    codes, n = b["codes"], len(b["key"])
    out = {"key": b["key"], "block": b["block"], "audits": [None] * n, "ends": [None] * n, "costs": [None] * n}
    counts = {k: np.zeros(n, np.int64) for k in ("blank", "duplicate", "truncated", "illegal")}
    for group in _by_length(codes, 1 << 14):
        c = _padded([codes[i] for i in group])
        texts, ends, costs = least_audits(c, np.array([b["exits"][i] for i in group]))
        for j, i in enumerate(group):
            out["audits"][i], out["ends"][i], out["costs"][i] = texts[j], ends[j].tolist(), costs[j].tolist()
        real, fault, initial = c != PAST, c % 4, c // 4
        for name, f in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", TRUNCATED)):
            counts[name][group] = (real & (fault == f)).sum(1)
        a, z = initial[:, :-1], initial[:, 1:]
        legal = ((a == 1) & (z == 2)) | ((a == 2) & (z == 3)) | ((a == 3) & (z == 2))
        counts["illegal"][group] = (real[:, 1:] & ~legal).sum(1)
    edges = {"first": [c[0] // 4 for c in codes], "last": [c[-1] // 4 for c in codes]}
    return out | {k: v.tolist() for k, v in counts.items()} | edges


_PLANS = ("key string, block long, audits array<string>, ends array<int>, costs array<long>, blank long, "
          "duplicate long, truncated long, illegal long, first int, last int")
_LEGAL_CODES = {(1, 2), (2, 3), (3, 2)}


class _Conversation:
    """One conversation while its blocks and rows pass by in order."""

    def __init__(self, key: str):
        self.key, self.state, self.cost, self.audit = key, 0, None, []
        self.count = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.turns, self.low, self.high, self.last = 0, None, None, None
        self.hash, self.lines, self.edits, self.at = hashlib.sha256(), 0, "", 0

    def block(self, plan: dict) -> None:
        self.edits, self.at = plan["audits"][self.state], 0
        if self.cost is None:
            self.cost = plan["costs"][self.state]
        elif (self.last, plan["first"]) not in _LEGAL_CODES:
            self.count["illegal"] += 1
        self.audit.append(self.edits)
        self.last = plan["last"]
        for k in self.count:
            self.count[k] += plan[k]

    def _line(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.lines else "") + role + ":" + text).encode())
        self.lines += 1

    def _insert(self) -> None:
        self._line(NEXT_ROLE[self.state], "")
        self.state = NEXT[self.state]

    def row(self, turn, role: str, text: str) -> None:
        if turn is not None and turn != self.high:  # turns come in order
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        while (edit := self.edits[self.at]) == "I":
            self._insert()
            self.at += 1
        self.at += 1
        if edit == "R":
            self._line(NEXT_ROLE[self.state], text)
            self.state = NEXT[self.state]
        elif edit == "K":
            self._line(role, text)
            self.state = _keep(1 + INITIALS.find(role[0]))[self.state]

    def done(self) -> dict:
        tail = LAST[self.state] // INSERT
        for _ in range(tail):
            self._insert()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {"key": self.key, "gaps": gaps, **self.count, "cost": self.cost,
                "audit": "".join(self.audit) + "I" * tail, "repaired_sha256": self.hash.hexdigest()}


_RESULT = ("key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
           "audit string, repaired_sha256 string")


def _followed(arrow: pa.Schema):
    """The stream of plans and rows, in order, to one row a conversation."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                for key, plan, turn, role, text in zip(*[c.slice(lo, 1024).to_pylist() for c in b.columns]):
                    if now is None or now.key != key:
                        if now is not None:
                            out.append(now.done())
                        now = _Conversation(key)
                    if plan is not None:
                        now.block(plan)
                    else:
                        now.row(turn, role, text)
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=arrow)
                    out = []
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.done()], schema=arrow)
    return run


def repaired(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text", harmed: bool = True) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) for each
    conversation of ``rows``; ``harmed``: damage them first."""
    ids = rows.select(F.col(f"`{conv_col}`").alias("conv_id")).distinct().withColumn("key", key_of(F.col("conv_id")))
    if harmed:
        x = damaged(rows, conv_col, turn_col, role_col, text_col)
    else:
        x = rows.select(key_of(F.col(f"`{conv_col}`")).alias("key"), F.col(f"`{turn_col}`").alias("turn"),
                        F.coalesce(F.col(f"`{role_col}`"), F.lit(" ")).alias("role"),
                        F.coalesce(F.col(f"`{text_col}`"), F.lit(" ")).alias("text"))
    order = [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.sha2("text", 256).asc()]
    lines = staged(ranked(x, "key", order, "pos", "conv-rows"), "conv-rows")
    block = F.floor(F.col("pos") / BLOCK).cast("long").alias("block")
    coded = F.struct("pos", "code")
    codes = F.transform(F.array_sort(F.collect_list(coded)), lambda c: F.lpad(F.hex(c["code"]), 2, "0"))
    blocks = staged(_faults(lines).groupBy("key", block).agg(F.unhex(F.array_join(codes, "")).alias("codes")), "conv-blocks")
    most = blocks.agg(F.max("block")).first()[0]
    exits = _exit_costs(blocks, (most or 0) + 1)
    joined = blocks.join(exits, ["key", "block"]) if most else blocks.join(exits.drop("block"), "key")
    plans = _map_batches(joined.select("key", "block", "codes", "exits"), _audited, _PLANS)
    plan = F.struct(*[c for c in plans.columns if c not in ("key", "block")])
    text = lines.schema
    stream = plans.select("key", (F.col("block") * BLOCK).alias("pos"), F.lit(0).alias("kind"), plan.alias("plan"),
                          *[F.lit(None).cast(text[c].dataType).alias(c) for c in ("turn", "role", "text")])
    stream = stream.unionByName(lines.select("key", "pos", F.lit(1).alias("kind"), F.lit(None).cast(
        stream.schema["plan"].dataType).alias("plan"), "turn", "role", "text"))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    flow = stream.repartition(n, "key").sortWithinPartitions("key", "pos", "kind").select("key", "plan", "turn", "role", "text")
    found = flow.mapInArrow(_followed(_arrow_schema(StructType.fromDDL(_RESULT))), _RESULT)
    zero = F.lit(0).cast("long")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return ids.join(found, "key", "left").select(
        "conv_id", *[F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))
