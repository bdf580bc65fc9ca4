"""Conversation repair, line de-duplication and periodic runs against brute force, with the odd inputs each must take."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from actionlens.llm import conversation_repair, line_dedup, periodic_runs, queries
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANKS = " \t\n\x0b\x0c\r"


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _clashing(df, *names):
    for name in names:
        df = df.withColumn(name, F.lit("x"))
    return df


# ---- 11 conversation repair ----------------------------------------------------------------------------------

NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def _cheapest(initials, faults):
    """Least (cost, audit) by trying every edit at every turn and grammar state."""
    @lru_cache(None)
    def best(i, q, put_in=0):
        found = [(0, "")] if i == len(initials) and q in (0, 3) else []

        def add(cost, letter, rest):
            if rest:
                found.append((cost + rest[0], letter + rest[1]))
        if i < len(initials):
            add(3, "D", best(i + 1, q))
            if faults[i] not in "bd":
                cut = faults[i] == "t"
                if (q, initials[i]) in NEXT:
                    add(cut, "K", best(i + 1, NEXT[q, initials[i]]))
                for letter in "ua":
                    if (q, letter) in NEXT:
                        add(2 + cut, "R", best(i + 1, NEXT[q, letter]))
        if put_in < 3:
            for letter in "ua":
                if (q, letter) in NEXT:
                    add(2, "I", best(i, NEXT[q, letter], put_in + 1))
        return min(found) if found else None
    return best(0, 0)


def _chain(initials, faults, cuts):
    state = {0: (0, "")}
    for a, b in zip([0, *cuts], [*cuts, len(initials)]):
        if a < b:
            after = {}
            for (p, q), (cost, audit) in conversation_repair.block_audits(initials[a:b], faults[a:b]).items():
                if p in state:
                    x = state[p][0] + cost, state[p][1] + audit
                    after[q] = min(after.get(q, x), x)
            state = after
    return min(state[q] for q in (0, 3) if q in state)


def test_alignment_is_the_cheapest_edit():
    rng = random.Random(11)
    for n in range(1, 5):
        for initials in itertools.product("sua?", repeat=n):
            faults = "".join(rng.choice("---bdt") for _ in range(n))
            assert _chain("".join(initials), faults, []) == _cheapest("".join(initials), faults), (initials, faults)
    for _ in range(600):
        n = rng.randrange(1, 30)
        initials = "".join(rng.choice("suauaua?") for _ in range(n)) if rng.random() < 0.5 else "".join("ua"[(k + (rng.random() < 0.15)) % 2] for k in range(n))
        faults, cuts = "".join(rng.choice("-----bdt") for _ in range(n)), sorted(rng.randrange(n + 1) for _ in range(rng.randrange(4)))
        assert _chain(initials, faults, cuts) == _cheapest(initials, faults), (initials, faults, cuts)


def _damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if code:
            row = (conv, turn, "user" if code == 4 else role, "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text)
            out += [row, row] if code == 3 else [row]
    return out


def _repair(rows):
    """{conv_id: (gaps, blank, duplicate, truncated, illegal, cost, audit, repaired turns)} of damaged rows."""
    groups, out = defaultdict(list), {}
    for r in rows:
        groups[r[0]].append(r[1:])
    for conv, turns in groups.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), ""
        for _, role, text in turns:
            bare = text.strip(BLANKS)
            faults += "b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "-"
            seen.add((role, text))
        initials = "".join(role[:1] if role[:1] in ("s", "u", "a") else "?" for _, role, _ in turns)
        cost, audit = _cheapest(initials, faults)
        told, at, want = [], 0, "user"
        for edit in audit:
            if edit != "D":
                role, text = (want, "") if edit == "I" else (turns[at][1] if edit == "K" else want, turns[at][2])
                told.append((role, text))
                want = "assistant" if role[0] == "u" else "user"
            at += edit != "I"
        numbers = [t for t, _, _ in turns if t is not None]
        out[conv] = (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, faults.count("b"), faults.count("d"), faults.count("t"),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, told)
    return out


def _expected_repairs(rows):
    found = _repair(_damage(rows))
    return {c: (*found[c][:7], _sha("\n".join(f"{r}:{t}" for r, t in found[c][7]))) if c in found else (0,) * 6 + ("", _sha("")) for c in {r[0] for r in rows}}


def _op11(spark, tmp_path, df):
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op11_conversation_repair(spark, str(tmp_path)).collect()
    assert len(got) == len({r.conv_id for r in got})
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in got}


CONVERSATION = "conv_id long, turn long, role string, text string"
ODD_TURNS = [(1, 0, "system", "Rules."), (1, 1, "user", "Hi?"), (1, 2, "assistant", "Yes."), (2, None, "user", "a."), (2, 0, None, "b."), (2, 1, "assistant", None), (2, 1, "assistant", " \t\n"),
             (None, 3, "user", "x."), (None, None, "assistant", "y"), (3, 0, "user", "z. " * 40_000), (3, 9, "tool", "é»"), (4, 0, "user", "same."), (4, 0, "user", "same."), (4, 0, "assistant", "same."),
             (5, 1, "", ""), (6, None, "assistant", "only."), (7, 5, "system", "late."), (7, 1, "user", "one."), (7, 2, "user", "two"), (8, 0, "User", "U."), (9, 0, "system", "s."), (9, 1, "system", "s2.")]


def test_repair_query(spark, tmp_path):
    rng = random.Random(5)
    rows = list(ODD_TURNS)
    for conv in range(20, 220):
        for turn in range(rng.randrange(1, 12)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "user", "assistant", "system"]), rng.choice(["Fine.", "No!", "cut off", "What? ", "", "more. text"])))
    rows += [(500, turn, ("user", "assistant")[turn % 2], f"Turn {turn}.") for turn in range(700)]      # over several blocks
    rng.shuffle(rows)
    df = _clashing(spark.createDataFrame(rows, CONVERSATION), "row", "fault", "audit", "block", "h1", "spread")
    expected = _expected_repairs(rows)
    assert _op11(spark, tmp_path, df) == expected
    assert any(v[4] for v in expected.values()) and any(v[2] for v in expected.values()) and {"K", "R", "D", "I"} <= set("".join(v[6] for v in expected.values()))


def test_repaired_turns(spark):
    rows = [(1, 1, "user", "q."), (1, 2, "user", "q2."), (1, 3, "assistant", "a."), (2, 0, "system", "s."), (2, 1, "assistant", "x"), (3, 0, "user", " ")]
    repair = conversation_repair.Repair(spark.createDataFrame(rows, CONVERSATION))
    told = defaultdict(list)
    for r in sorted(repair.repaired().collect(), key=lambda r: (r.conv_id, r.place)):
        told[r.conv_id].append((r.role, r.text))
    assert dict(told) == {c: v[7] for c, v in _repair(rows).items() if v[7]}


def test_repair_of_whole_table_and_of_nothing(spark, tmp_path):
    table = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert {r.conv_id: tuple(r)[1:] for r in queries.op11_conversation_repair(spark, SF_SMALL).collect()} == _expected_repairs(rows)
    assert _op11(spark, tmp_path, table.limit(0)) == {}


# ---- 12 line de-duplication ----------------------------------------------------------------------------------

LINE = "A line that is long enough to count as a repeated line"
ODD_LINES = ([(d, f"{LINE}\nown text of document number {d}, which no other one has\n{LINE.upper()} \n") for d in range(1, 7)]
             + [(8, None), (9, ""), (10, "\n\n"), (11, "short\nshort"), (12, "short\r\nshort"), (None, f"\t{LINE}\r"), (None, "null row " + "é" * 40), (4, f"again {LINE}\n{LINE}"), (5, f"{LINE}\nx"), (5, f"{LINE}\nx")]
             + [(d, "É" * 40 + " CASE\n" + "z" * 39) for d in range(20, 26)] + [(d, "é" * 20 + "\ny") for d in range(30, 35)]
             + [(40, "\n".join([LINE, "w " * 30] * 2000)), (41, "w " * 30), (42, "W " * 30), (43, " w" * 30), (44, "w " * 30 + "\x0b")])


def _deduplicated(rows, min_chars=40, min_docs=5):
    key = lambda line: line.strip(BLANKS).translate(LOW)
    where = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                where[key(line)].add(doc)
    keeper = {k: max(d, key=lambda x: (x is not None, x or 0)) for k, d in where.items() if len(d) >= min_docs}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if keeper.get(key(line), doc) == doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


def test_line_dedup(spark):
    df = _clashing(spark.createDataFrame(ODD_LINES, "doc_id long, text string"), "pos", "line", "h1", "keeper", "n_lines", "text_hash")
    got = Counter(tuple(r) for r in line_dedup.deduplicated(df).collect())
    assert got == _deduplicated(ODD_LINES) and sum(r[2] for r in got) > 2000
    assert Counter(tuple(r) for r in line_dedup.deduplicated(df, min_chars=5, min_docs=2).collect()) == _deduplicated(ODD_LINES, 5, 2)
    assert line_dedup.deduplicated(df.limit(0)).count() == 0


def test_keep_bitmaps_are_runs_of_kept_lines(spark):
    df = spark.createDataFrame(ODD_LINES, "doc_id long, text string")
    by_doc = {r.doc_id: r for r in line_dedup.keep_bitmaps(df).collect() if r.doc_id in (1, 3, 6)}
    assert [tuple(x) for x in by_doc[1].keep_runs] == [(1, 1), (3, 1)] and by_doc[1].n_dropped == 2
    assert set(by_doc) == {1, 3, 6}                       # document 40 keeps the line


def test_line_dedup_query_and_plan(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = queries.op12_line_dedup(spark, SF_SMALL)
    assert Counter(tuple(r) for r in got.collect()) == Counter({(d, n, m, _sha(t)): c for (d, n, m, t), c in _deduplicated(rows).items()})
    assert not re.search("Python|Arrow|Pandas", got._jdf.queryExecution().executedPlan().toString())
    plan = line_dedup.occurrences(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), 40)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "rangepartitioning" in plan         # the stream of first occurrences needs no second shuffle


def test_a_line_of_every_document_is_dealt_over_tasks(spark):
    n = 8000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit(LINE + "\nown "), F.sha2(F.col("id").cast("string"), 256)).alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")     # so few rows would be put together again
    try:
        parts = line_dedup.occurrences(docs, 40).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(parts) >= 6 and max(r["count"] for r in parts) < 2 * n / 3       # the line alone is half of the 2 n rows
    assert line_dedup.deduplicated(docs).where("n_dropped = 1").count() == n - 1


# ---- 13 periodic runs ----------------------------------------------------------------------------------------


def _runs(w, min_length=12):
    found, n = {}, len(w)
    for p in range(1, n // 2 + 1):
        i = 0
        while i < n - p:
            if w[i] != w[i + p]:
                i += 1
                continue
            s = i
            while i < n - p and w[i] == w[i + p]:
                i += 1
            if i + p - s >= max(min_length, 2 * p):
                found.setdefault((s, i + p), p)
    return sorted((s, p, e - s) for (s, e), p in found.items())


def _fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


def _words():
    rng = random.Random(13)
    yield from ([], ["a"], ["a"] * 200, _fibonacci(260), [str(i.bit_count() % 2) for i in range(300)], (["x", "y"] * 40 + ["x"]) * 4, ["x", "y"] * 20 + ["x"] + ["x", "y"] * 30)
    for _ in range(400):
        w = [rng.choice("abcde"[:rng.choice([2, 2, 3, 5])]) for _ in range(rng.randrange(90))]
        for _ in range(rng.randrange(3) if w else 0):
            a, p = rng.randrange(len(w)), rng.randrange(1, 20)
            r = w[a:a + p]
            w[a:a] = r * rng.randrange(1, 8) + r[:rng.randrange(len(r) + 1)]
        yield w
    for _ in range(200):                                  # roots that are highly periodic themselves
        q = [rng.choice("ab") for _ in range(rng.randrange(1, 5))]
        r = q * rng.randrange(3, 12) + q[:rng.randrange(len(q) + 1)] + [rng.choice("abc") for _ in range(rng.randrange(3))]
        r += q[rng.randrange(len(q)):] + q * rng.randrange(3, 12) if rng.random() < 0.5 else []
        yield r * rng.randrange(1, 4) + r[:rng.randrange(len(r) + 1)]


def test_all_runs_are_found():
    for w in _words():
        ids = np.unique(np.array(w, "U1"), return_inverse=True)[1]
        start, end, period = periodic_runs.all_runs(ids.astype(np.int64))
        assert sorted(zip(start.tolist(), period.tolist(), (end - start).tolist())) == _runs(w, 2), w


def _collapsed(w, runs):
    gone = {i for s, p, m in runs for i in range(s + p, s + m)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


ODD_LOOPS = [(1, "to be or not " * 9 + "end"), (2, None), (3, ""), (4, " \n\t"), (5, "a"), (6, "a\x0ba " * 12), (6, "a a"), (None, "x y " * 7), (7, "One two three. " * 900), (8, "é é é é " * 8),
             (9, "a b a b"), (10, ("p q " * 8 + "r ") * 3), (11, "it is it was " * 3), (11, "it is it was " * 3)]


def test_periodic_runs(spark):
    df = _clashing(spark.createDataFrame(ODD_LOOPS, "doc_id long, text string"), "runs", "start", "n_words", "collapsed")
    got = Counter((r.doc_id, r.n_words, tuple((x.start, x.period, x.length) for x in r.runs), r.collapsed) for r in periodic_runs.periodic_runs(df).collect())
    expected = Counter()
    for doc, text in ODD_LOOPS:
        w = WORD.findall(text or "")
        runs = _runs(w) if len(w) < 500 else [(0, 3, len(w))]
        expected[doc, len(w), tuple(runs), _collapsed(w, runs)] += 1
    assert got == expected
    assert periodic_runs.periodic_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(df, min_periods=1)


def _planted(doc, text):
    w = WORD.findall(text or "")
    h = None if doc is None else zlib.crc32(str(doc).encode())
    if h is None or h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def _op13_row(doc, text):
    w = _planted(doc, text)
    runs = _runs(w)
    best = min(runs, key=lambda r: (-r[2], r[0], r[1]), default=None)
    s, p, m = best if best else (None,) * 3
    return doc, len(runs), s, m, p, None if best is None else 1000 * m // p, _sha("".join(f"{a},{k},{q}\n" for a, q, k in runs)), _sha(_collapsed(w, runs))


def test_periodic_run_query(spark, tmp_path):
    rng = random.Random(7)
    rows = [r for r in ODD_LOOPS if len(r[1] or "") < 3000] + [(d, " ".join(rng.choice("abcdefghij") for _ in range(rng.randrange(120))) + "\n") for d in range(100, 400)]
    assert sum(d is not None and zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows) > 20
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_periodic_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == Counter(_op13_row(*r) for r in rows)
