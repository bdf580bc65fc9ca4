"""Repair of conversations: faulty turns are found and the turns aligned to the grammar of roles.

The roles' initials of a repaired conversation are ``(s?(ua)+)?``.  Edits: Keep costs 0, Rerole (to
user or assistant) 2, Delete 3 (required for blank and duplicate turns), Insert (an empty user or
assistant turn) 2; a truncated turn that stays adds 1.  The cheapest edits are taken, of equally
cheap ones those whose initials (the audit) come first in ASCII order.

Alignment is Wagner and Fischer's: turns against the alternating string of each feasible length.
Strings that end alike are ends of one another, so one table of costs, filled from the last turn
back, serves every length.  A greedy repair gives the incumbent cost; whatever beats it leaves out
and puts in fewer turns than half its excess over the unavoidable cost, and only that band of the
table (Ukkonen's) is filled.  The audits of all lengths of least cost are traced and compared.

Scale: turns get global numbers in conversation order by a range partitioning, and are aligned in
blocks of ``BLOCK`` turns, so no conversation, however long, meets in one task as text.  A block
gives, for every pair of grammar states before and after it, its cheapest audit; the blocks of a
conversation are chained in order, which is exact: two audits of one block between the same states
and of the same cost are never each other's beginning, so the lesser one stays the lesser.  Texts
pass once more beside the audits, one turn at a time.

Defined results: a null role or text counts as one space (such a text is blank); turns of one turn
number are taken by role, then text; a null turn number comes first; turns without conv_id are one
conversation.  Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actionlens.llm.common import numbered, pin

BLOCK = 256                     # turns aligned at once
BLANKS = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
BEGIN, SYSTEM, WANT_A, WANT_U = 0, 1, 2, 3      # nothing yet; s; ...u; ...ua
ACCEPTED = (BEGIN, WANT_U)
_FAR = 1 << 60
AUDIT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


# ---- one block ---------------------------------------------------------------------------------------------------


class Table:
    """Costs of aligning turns i.. to the last r letters of an alternating string that ends with ``last``."""

    def __init__(self, initials: str, faults: str, last: str):
        self.initials, self.faults, self.last = initials, faults, last
        n = len(initials)
        self.other = "u" if last == "a" else "a"
        stay = [0] * (n + 1)                                  # turns from i on that need not go
        for i in range(n - 1, -1, -1):
            stay[i] = stay[i + 1] + (faults[i] not in "bd")
        width = self._incumbent() // 2
        self.low = [max(0, s - width) for s in stay]
        self.rows: list[list[int]] = [[]] * (n + 1)
        for i in range(n, -1, -1):
            row = self.rows[i] = []
            for r in range(self.low[i], stay[i] + width + 1):
                best = row[-1] + INSERT if row else (INSERT * r if i == n else _FAR)
                if i < n:
                    best = min(best, DELETE + self.cost(i + 1, r))
                    if r and faults[i] not in "bd":
                        best = min(best, (KEEP if initials[i] == self.letter(r) else REROLE) + TRUNCATED * (faults[i] == "t") + self.cost(i + 1, r - 1))
                elif r == 0:
                    best = 0
                row.append(best)

    def letter(self, r: int) -> str:
        return self.last if r % 2 else self.other

    def cost(self, i: int, r: int) -> int:
        at = r - self.low[i]
        return self.rows[i][at] if 0 <= at < len(self.rows[i]) else _FAR

    def _incumbent(self) -> int:
        """Excess of a greedy repair over the unavoidable cost: put in what is missing, rename what is no u or a."""
        worst = 0
        for want in "ua":
            spent = 0
            for c, f in zip(self.initials, self.faults):
                if f in "bd":
                    continue
                if c != want:
                    spent += 2
                if c == want or c not in "ua":
                    want = "a" if want == "u" else "u"
            worst = max(worst, spent)
        return worst + 2 * INSERT

    def trace(self, i: int, r: int) -> str:
        """The first audit in ASCII order (D, I, K, R) among the cheapest."""
        out, n = [], len(self.initials)
        while i < n or r:
            left = self.cost(i, r)
            t = TRUNCATED * (i < n and self.faults[i] == "t")
            if i < n and left == DELETE + self.cost(i + 1, r):
                out.append("D")
                i += 1
            elif r and left == INSERT + self.cost(i, r - 1):
                out.append("I")
                r -= 1
            else:
                out.append("K" if self.initials[i] == self.letter(r) and left == KEEP + t + self.cost(i + 1, r - 1) else "R")
                i, r = i + 1, r - 1
        return "".join(out)


def block_audits(initials: str, faults: str) -> dict[tuple[int, int], tuple[int, str]]:
    """(state before, state after) -> (cost, audit) of the cheapest edits of a block of turns.

    ``initials`` has the roles' first letters, ``faults`` b, d, t or - for every turn.
    """
    n, best = len(initials), {}
    tables = {WANT_U: Table(initials, faults, "a"), WANT_A: Table(initials, faults, "u")}

    def offer(before: int, after: int, found: list[tuple[int, str, Table | None, int, int]]) -> None:
        """found: (cost, audit so far, table, turn, length) of every feasible length."""
        least = min((x[0] for x in found), default=_FAR)
        if least < _FAR:
            best[before, after] = least, min(head + (table.trace(i, r) if table else "") for cost, head, table, i, r in found if cost == least)

    def lengths(table: Table, i: int, want: str, after_nothing: bool) -> Iterator[int]:
        """Feasible lengths of strings that begin with ``want``; 0 only where the state may stay as it is."""
        for r in range(table.low[i], table.low[i] + len(table.rows[i])):
            if table.letter(r) == want if r else after_nothing:
                yield r

    systems = [i for i, (c, f) in enumerate(zip(initials, faults)) if c == "s" and f not in "bd"]
    gone = (DELETE * n, "D" * n, None, 0, 0)
    offer(BEGIN, BEGIN, [gone])
    kept = {i: DELETE * i + KEEP + TRUNCATED * (faults[i] == "t") for i in systems}
    offer(BEGIN, SYSTEM, [(kept[i] + DELETE * (n - 1 - i), "D" * i + "K" + "D" * (n - 1 - i), None, 0, 0) for i in systems])
    offer(SYSTEM, SYSTEM, [gone])
    for after, table in tables.items():
        for before, want in ((BEGIN, "u"), (SYSTEM, "u"), (WANT_A, "a"), (WANT_U, "u")):
            found = [(table.cost(0, r), "", table, 0, r) for r in lengths(table, 0, want, before == after)]
            if before == BEGIN:
                found += [(kept[i] + table.cost(i + 1, r), "D" * i + "K", table, i + 1, r) for i in systems for r in lengths(table, i + 1, "u", False)]
            offer(before, after, found)
    return best


# ---- streams over sorted rows ------------------------------------------------------------------------------------


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


_PATHS = pa.list_(pa.struct([("before", pa.int32()), ("after", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_SEGMENT = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("n_turns", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()),
                      ("truncated", pa.int64()), ("illegal", pa.int64()), ("head", pa.string()), ("tail", pa.string()), ("paths", _PATHS)])
SEGMENT = ("conv_id long, block long, first_turn long, last_turn long, n_turns long, blank long, duplicate long, truncated long, illegal long, head string, tail string, "
           "paths array<struct<before:int,after:int,cost:long,audit:string>>")


def _is_illegal(a: str, b: str) -> bool:
    return a + b not in ("su", "ua", "au")


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (conv_id, block, turn, initial, fault) in order: the summary of each conversation's part of a block."""
    key, part, out = None, [], []

    def summary() -> dict:
        turns = [t for t, _, _ in part if t is not None]          # sorted
        initials, faults = [c for _, c, _ in part], "".join(f for _, _, f in part)
        # An initial outside the grammar is one letter here whatever its code points are.
        letters = "".join(c if c in ("s", "u", "a") else "?" for c in initials)
        return {"conv_id": key[0], "block": key[1], "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None,
                "n_turns": sum(a != b for a, b in zip(turns, turns[1:])) + bool(turns), "blank": faults.count("b"), "duplicate": faults.count("d"), "truncated": faults.count("t"),
                "illegal": sum(map(_is_illegal, letters, letters[1:])), "head": letters[0], "tail": letters[-1],
                "paths": [{"before": b, "after": a, "cost": c, "audit": s} for (b, a), (c, s) in block_audits(letters, faults).items()]}

    for conv, block, *row in _rows(batches):
        if key != (conv, block):
            if part:
                out.append(summary())
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, _SEGMENT)
                out = []
            key, part = (conv, block), []
        part.append(row)
    if part:
        out.append(summary())
    if out:
        yield pa.RecordBatch.from_pylist(out, _SEGMENT)


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the segments in order: one audit a conversation."""
    names = _SEGMENT.names
    schema = pa.schema([(c, pa.string() if c == "audit" else pa.int64()) for c in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")])
    conv, state, sums, out = object(), {}, {}, []

    def result() -> dict:
        cost, audit = min(state[q] for q in ACCEPTED if q in state)
        gaps = 0 if sums["first"] is None else sums["last"] - sums["first"] + 1 - sums["n"]
        return {"conv_id": conv, "gaps": gaps, **{k: sums[k] for k in ("blank", "duplicate", "truncated", "illegal")}, "cost": cost, "audit": audit}

    for values in _rows(batches):
        x = dict(zip(names, values))
        if sums and conv == x["conv_id"]:
            sums["illegal"] += _is_illegal(sums["tail"], x["head"])
        else:
            if sums:
                out.append(result())
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
            conv, state = x["conv_id"], {BEGIN: (0, "")}
            sums = {"first": None, "last": None, "n": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        if x["first_turn"] is not None:
            sums["n"] += x["n_turns"] - (sums["last"] == x["first_turn"])
            sums["first"] = x["first_turn"] if sums["first"] is None else sums["first"]
            sums["last"] = x["last_turn"]
        for k in ("blank", "duplicate", "truncated", "illegal"):
            sums[k] += x[k]
        sums["tail"], after = x["tail"], {}
        for p in x["paths"]:
            if p["before"] in state:
                cost, audit = state[p["before"]]
                cost += p["cost"]
                if cost <= after.get(p["after"], (_FAR,))[0]:
                    after[p["after"]] = min(after.get(p["after"], (_FAR, "")), (cost, audit + p["audit"]))
        state = after
    if sums:
        out.append(result())
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, place, role, text) of the repaired turns, from each conversation's audit and then its turns in order."""
    conv, audit, at, place, want = None, "", 0, 0, "user"

    def inserted() -> Iterator[tuple]:
        nonlocal at, place, want
        while at < len(audit) and audit[at] == "I":
            yield conv, place, want, ""
            want = "assistant" if want == "user" else "user"
            at, place = at + 1, place + 1

    for c, row, role, text in _rows(batches):
        if row < 0:
            conv, audit, at, place, want = c, text, 0, 0, "user"
        else:
            edit = audit[at]
            at += 1
            if edit != "D":
                new = role if edit == "K" else want
                yield conv, place, new, text
                place += 1
                want = "assistant" if new[:1] == "u" else "user"
        yield from inserted()


def _turn_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, out, size = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())]), [], 0
    for row in _repaired(batches):
        out.append(row)
        size += len(row[3])
        if size > 1 << 20 or len(out) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out, size = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
    conv, digest, out = None, None, []
    for c, place, role, text in _repaired(batches):
        if place == 0:
            if digest:
                out.append({"conv_id": conv, "repaired_sha256": digest.hexdigest()})
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
            conv, digest = c, hashlib.sha256()
        else:
            digest.update(b"\n")
        digest.update(f"{role}:{text}".encode())
    if digest:
        out.append({"conv_id": conv, "repaired_sha256": digest.hexdigest()})
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


# ---- Spark jobs --------------------------------------------------------------------------------------------------


class Repair:
    """The numbered turns and the audits of a table of conversations (conv_id, turn, role, text)."""

    def __init__(self, conversations: DataFrame):
        plain = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                                     F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
        # The last key spreads equal rows over tasks; their order doesn't matter.
        self.turns, _ = numbered(plain.withColumn("spread", F.monotonically_increasing_id()), ["conv_id", "turn", "role", "text", "spread"], "turns")
        self.audits = pin(self._audits(), "audits")

    def _audits(self) -> DataFrame:
        bare = F.btrim("text", F.lit(BLANKS))
        same = [F.xxhash64("conv_id", "role", "text").alias("h1"), F.xxhash64(F.lit("second hash"), "conv_id", "role", "text").alias("h2")]
        seen = pin(self.turns.select("conv_id", "row", "turn", F.substring("role", 1, 1).alias("initial"), (bare == "").alias("is_blank"), (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("is_cut"), *same), "turn-faults")
        again = seen.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("row").alias("first_row")).where("n > 1").drop("n")
        fault = F.when(F.col("is_blank"), "b").when(F.col("row") > F.col("first_row"), "d").when(F.col("is_cut"), "t").otherwise("-")
        judged = seen.join(again, ["h1", "h2"], "left").select("conv_id", F.expr(f"row div {BLOCK}").alias("block"), "turn", "initial", fault.alias("fault"), "row")
        ordered = judged.repartition("block").sortWithinPartitions("block", "row").drop("row")
        segments = ordered.mapInArrow(_segments, SEGMENT)
        return segments.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(_chained, AUDIT)

    def _beside(self) -> DataFrame:
        audits = self.audits.select("conv_id", F.lit(-1).cast("long").alias("row"), F.lit("").alias("role"), F.col("audit").alias("text"))
        return self.turns.select("conv_id", "row", "role", "text").unionByName(audits).repartition("conv_id").sortWithinPartitions("conv_id", "row")

    def repaired(self) -> DataFrame:
        """(conv_id, place, role, text): the turns of every conversation after its repair."""
        return self._beside().mapInArrow(_turn_batches, "conv_id long, place long, role string, text string")

    def digests(self) -> DataFrame:
        """(conv_id, repaired_sha256) of the conversations that keep a turn: over ``role:text`` joined by newlines."""
        return self._beside().mapInArrow(_digest_batches, "conv_id long, repaired_sha256 string")

    def report(self) -> DataFrame:
        """The audits with the digest of the repaired turns."""
        digests = self.digests().select(F.col("conv_id").alias("d_conv"), "repaired_sha256")
        met = self.audits.join(digests, F.col("conv_id").eqNullSafe(F.col("d_conv")), "left").drop("d_conv")
        return met.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)))
