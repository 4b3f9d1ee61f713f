"""Conversation repair against a search over all edits."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from gatelake.llm import repair

WHITE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, letters string, copies long, audit string, kind int, key binary"


def search(letters):
    """Cheapest edits, then the least initials, by Dijkstra over (place, grammar state) with whole audits."""
    goes = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    heap, done = [(0, "", 0, 0)], set()
    best = None
    while heap:
        cost, audit, i, q = heapq.heappop(heap)
        if best is not None and cost > best[0]:
            break
        if i == len(letters) and q in (0, 3):
            best = min(best, (cost, audit)) if best else (cost, audit)
        if (i, q, audit) in done:
            continue
        done.add((i, q, audit))
        for role, to in goes[q].items():
            if role != "s":
                heapq.heappush(heap, (cost + 5, audit + "I", i, to))
        if i < len(letters):
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, q))
            role, w = letters[i]
            if role != "X":
                for r, to in goes[q].items():
                    if r == role:
                        heapq.heappush(heap, (cost + w, audit + "K", i + 1, to))
                    if r != "s":
                        heapq.heappush(heap, (cost + 1 + w, audit + "R", i + 1, to))
    return best


def by_hand(rows):
    """``rows`` of (turn, role, text) in order: the whole result of one conversation."""
    seen, letters, count = set(), [], defaultdict(int)
    for _, role, text in rows:
        body = text.rstrip(WHITE)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        count[fault] += 1
        letters.append(("X", 0) if fault in ("blank", "duplicate") else (role[:1], 5 * (fault == "truncated")))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit = search(letters)
    out, state, it = [], "", iter(rows)
    for e in audit:
        row = None if e == "I" else next(it)
        if e == "D":
            continue
        role = "assistant" if state == "u" else "user"
        out.append(f"{row[1]}:{row[2]}" if e == "K" else f"{role}:{row[2] if row else ''}")
        state = out[-1][0]
    assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in out))
    sha = hashlib.sha256("\n".join(out).encode()).hexdigest()
    return gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, sha


def order(row):
    turn, role, text = row
    return turn is not None, turn or 0, role, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def expected(rows):
    """``rows`` of (conv_id, turn, role, text, copies)."""
    convs = defaultdict(list)
    for conv, turn, role, text, copies in rows:
        convs[conv] += [(turn, role if role is not None else " ", text if text is not None else " ")] * (1 if copies is None else copies)
    return {(c, *by_hand(sorted(r, key=order))) for c, r in convs.items()}


def table(spark, rows, parts=3):
    full = [(c, t, r, x, "x", n, "x", 7, None) for c, t, r, x, n in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def got(df):
    return {tuple(r) for r in df.collect()}


def random_rows(seed, convs, longest):
    r = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(r.randint(1, longest)):
            role = r.choice(["user", "assistant"] * 4 + ["system", "tool", "", "Ünder", None, "a", "ux"])
            text = r.choice(["Yes.", "No!", "Why?", "cut off", "same", "", " \t\n", None, "end. \n", f"{r.random()}.", f"{r.random()}"])
            rows.append((c, r.choice([t, t, t, t + 2, 3, None]), role, text, r.choice([None, 1, 1, 1, 2, 0])))
    return rows


def test_repair_equals_search(spark):
    rows = random_rows(1, 300, 8) + [(None, 1, "user", "A.", 1), (None, None, "assistant", "B.", 1), (None, 1, "user", "A.", 1), (900, 1, "user", "gone", 0)]
    assert got(repair.repair(table(spark, rows))) == expected(rows)


def test_all_short_signatures():
    audits, alphabet = repair.Audits(), "suaoSUAX"
    known = {c: ("X", 0) if c == "X" else (c.lower(), 5 * c.isupper()) for c in alphabet}
    todo = [""]
    for _ in range(3):
        todo += [c + s for s in todo for c in alphabet if len(s) < 3]
    r = random.Random(3)
    todo = sorted({*todo, *("".join(r.choice(alphabet) for _ in range(r.randint(4, 9))) for _ in range(150))}, key=lambda s: s[::-1])
    for s in todo:
        assert audits.of(s) == search([known[c] for c in s]), s
    assert len(audits.auto._costs) < 60  # suffixes share a few nodes


def test_suffixes_are_walked_once():
    audits, steps = repair.Audits(), []
    step = audits.auto.step
    audits.auto.step = lambda letter, node: steps.append(letter) or step(letter, node)
    for s in sorted(["uaua", "saua", "xaua".replace("x", "X"), "uaua"], key=lambda s: s[::-1]):
        audits.of(s)
    assert len(steps) == 3 + 3


def test_one_conversation_over_many_tasks(spark, monkeypatch):
    rows = [(1, t, ("user", "assistant")[t % 2 if t % 31 else 0], ("Fine.", "", "same words")[t % 3] if t % 7 == 0 else f"Turn {t}.", 1) for t in range(4000)]
    rows += [(2, 5, "user", "again and again.", 1)] * 3000 + [(3, None, "user", f"{k}.", 1) for k in range(500)]
    found = repair.signatures(table(spark, rows, 8))
    parts = found.collect()
    assert {r["conv_id"]: len(r["letters"]) for r in parts} == {1: 4000, 2: 3000, 3: 500}
    done = {r["conv_id"]: r for r in repair.repair(table(spark, rows, 8)).collect()}
    assert done[2]["duplicate"] == 2999 and done[2]["illegal"] == 2999 and done[2]["gaps"] == 0 and done[3]["gaps"] == 0 and done[1]["gaps"] == 0
    longs = [x for x in rows if x[0] == 1]
    audits = repair.Audits()
    letters = next(r["letters"] for r in parts if r["conv_id"] == 1)
    assert (done[1]["cost"], done[1]["audit"]) == audits.of(letters)
    assert done[1]["blank"] == sum(not x[3] for x in longs)


def test_repaired_rows(spark):
    rows = random_rows(2, 60, 7)
    shas = {r[0]: r[-1] for r in expected(rows)}
    texts = defaultdict(list)
    for r in sorted(repair.repaired_rows(table(spark, rows)).collect(), key=lambda r: r["position"]):
        texts[r["conv_id"]].append(f"{r['role']}:{r['text']}")
        assert r["edit"] in "KRI"
    assert {c: hashlib.sha256("\n".join(texts[c]).encode()).hexdigest() for c in shas} == shas


def test_damage(spark):
    rows = [(c, t, r, x, None) for c in (*range(60), None) for t, (r, x) in enumerate([("user", "a. b!? c"), (None, None), ("assistant", "d.")])] + [(5, None, "user", "x.", None)]
    want = []
    for c, t, r, x, _ in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = r if r is not None else " ", x if x is not None else " "
        want.append((c, t, "user" if k == 4 else r, "" if k == 1 else re.sub("[.!?]", "", x) if k == 2 else x, 0 if k == 0 else 2 if k == 3 else 1))
    damaged = repair.damage(table(spark, rows).drop("copies"))
    assert sorted(map(repr, (tuple(r) for r in damaged.collect()))) == sorted(map(repr, want))
    assert got(repair.repair(damaged)) == expected(want)


def test_empty_and_odd_columns(spark):
    assert repair.repair(table(spark, [(1, 1, "user", "a.", 1)]).where("false")).count() == 0
    named = spark.createDataFrame([("x", 1, "user", "A."), ("x", 2, "assistant", "B."), (" ", 1, "user", "C.")], "conv_id string, turn long, role string, text string")
    assert {r["conv_id"]: r["audit"] for r in repair.repair(named).collect()} == {"x": "KK", " ": "D"}
    assert repair.repair(named.withColumn("_c", F.lit(1)).withColumn("_k", F.lit(1)).withColumn("_first", F.lit(1))).count() == 2
