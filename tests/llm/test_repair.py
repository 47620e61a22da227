"""Conversation repair against all edit sequences, and long conversations against one table."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from stream_commerce.llm import queries, repair

GOOD = re.compile(r"(s?(ua)+)?\Z")
ROLES = ["user", "assistant", "system", "usher", "tool", "", " "]


def _faults(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(fault)
    return out


def _all_ways(rows, faults):
    """Cheapest edits by trying every way with at most two insertions in a gap."""
    gaps = [[], ["user"], ["assistant"], ["user", "assistant"], ["assistant", "user"]]
    best = None

    def go(i, cost, audit, out):
        nonlocal best
        if best and cost > best[0]:
            return
        for new in gaps:
            more, letters, held = cost + 3 * len(new), audit + "I" * len(new), out + [(r, "") for r in new]
            if i == len(rows):
                if GOOD.match("".join(r[:1] or "?" for r, _ in held)) and (best is None or (more, letters) < best[:2]):
                    best = (more, letters, held)
                continue
            (role, text), fault = rows[i], faults[i]
            go(i + 1, more + 4, letters + "D", held)
            if fault in ("", "truncated"):
                extra = 3 if fault else 0
                go(i + 1, more + extra, letters + "K", [*held, (role, text)])
                for r in ("user", "assistant"):
                    go(i + 1, more + extra + 3, letters + "R", [*held, (r, text)])

    go(0, 0, "", [])
    return best


def _figures(rows, turns, plan):
    faults = _faults(rows)
    known = [t for t in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    cost, audit, out = plan
    text = "\n".join(f"{r}:{t}" for r, t in out)
    return (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def _conversations(count, seed, longest):
    rng = random.Random(seed)
    texts = ["Yes.", "no", "What?", " ", "", "Go on! ", "cut off,", "Fine.\n"]
    for c in range(count):
        turns = sorted(rng.choices([None, *range(6)], k=rng.randint(0, longest)), key=lambda t: (t is not None, t))
        rows = [(t, rng.choice(ROLES if rng.random() < 0.3 else ROLES[:2]), rng.choice(texts)) for t in turns]
        yield c, sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def test_reports_match_all_ways(spark):
    convs = dict(_conversations(150, 1, 4))
    convs[9999] = [(0, "system", "Be brief."), (1, "assistant", "Hi."), (2, "user", "So?")]
    data = [(c, *r, 5) for c, rows in convs.items() for r in rows]
    random.Random(0).shuffle(data)
    turns = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, seq int").repartition(3)
    every = spark.createDataFrame([(c,) for c in convs], "conv_id long")
    found = {r["conv_id"]: tuple(r)[1:] for r in repair.report(turns, every).collect()}
    assert len(found) == len(convs)
    for c, rows in convs.items():
        plain = [r[1:] for r in rows]
        assert found[c] == _figures(plain, [r[0] for r in rows], _all_ways(plain, _faults(plain))), rows


def _table(codes):
    """One table over all rows with whole letter sequences."""
    best = {repair.START: (0, "")}
    for initial, fault, copies in codes:
        step, after = repair.ROW_STEPS[initial, fault], {}
        for s, (cost, audit) in best.items():
            for t in repair.STATES:
                if step.cost[s][t] < repair.FAR:
                    new = (cost + step.cost[s][t] + 4 * (copies - 1), audit + step.order[s][t] + "D" * (copies - 1))
                    after[t] = min(after.get(t, new), new)
        best = after
    ends = [(c + repair.ENDS[s], a + "I" * (repair.ENDS[s] // 3)) for s, (c, a) in best.items()]
    return min(ends)


def _letters(codes, states):
    edits = [repair.row_edits(*c, a, b) for c, a, b in zip(codes, [repair.START, *states], states, strict=False)]
    return "".join(e * n for x in edits for e, _, n in x) + "".join(e for e, _, _ in repair.last_edits(states[-1], repair.ENDS))


def test_crossings_take_the_least_letters():
    rng = random.Random(3)
    for _ in range(400):
        codes = [(rng.choice("sua?"), rng.choice([0, 0, 0, 1, 2]), rng.choice([1, 1, 1, 3])) for _ in range(rng.randint(1, 40))]
        states = repair.crossings(repair.row_steps(codes), repair.START, repair.ENDS)
        assert _letters(codes, states) == _table(codes)[1]


def test_runs_summed_up_give_the_same_crossings():
    rng = random.Random(8)
    for _ in range(60):
        codes = [(rng.choice("sua?"), rng.choice([0, 0, 1, 2]), 1) for _ in range(rng.randint(1, 60))]
        steps = repair.row_steps(codes)
        cuts = sorted({0, len(codes), *(rng.randint(0, len(codes)) for _ in range(5))})
        runs = [steps[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        tables = [repair.summed(r) for r in runs]
        states, entry, found = repair.crossings(tables, repair.START, repair.ENDS), repair.START, []
        for k, (run, state) in enumerate(zip(runs, states, strict=True)):
            ends = repair.ENDS if k == len(runs) - 1 else [0 if t == state else repair.FAR for t in repair.STATES]
            found += repair.crossings(run, entry, ends)
            entry = state
        assert _letters(codes, found) == _table(codes)[1]


def test_a_conversation_with_most_rows_is_cut_into_runs(spark, monkeypatch):
    monkeypatch.setattr(repair, "RUN_BITS", (3, 5, 7, 34, 63))
    rng = random.Random(5)
    rows = [(1 if c < 300 else c, c, rng.choice(ROLES[:3]), f"{rng.choice(['Yes', 'No', 'Perhaps'])} {c // 2}{rng.choice('.!,')}") for c in range(360)]
    rows += [(1, 5, "user", "Again.")] * 50 + [(None, 1, "user", "Nobody."), (None, None, None, None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r["conv_id"]: tuple(r)[1:] for r in repair.report(turns, turns).collect()}
    own = sorted([(t, r, x) for c, t, r, x in rows if c == 1], key=lambda r: (r[0], r[1].encode(), r[2].encode()))
    plain = [r[1:] for r in own]
    faults = _faults(plain)
    codes = [(r[:1], repair._code(f), 1) for (r, _), f in zip(plain, faults, strict=True)]
    cost, audit = _table(codes)
    assert found[1][5:7] == (cost, audit)
    out, k, state = [], 0, repair.START
    for letter in audit:
        role, text = plain[k] if letter != "I" and k < len(plain) else ("", "")
        k += letter != "I"
        if letter == "D":
            continue
        after = repair.SYSTEM if letter == "K" and role[:1] == "s" else repair.ASSISTANT if state == repair.USER else repair.USER
        name = role if letter == "K" else {repair.USER: "user", repair.ASSISTANT: "assistant"}[after]
        out.append((name, text))
        state = after
    assert found[1] == _figures(plain, [r[0] for r in own], (cost, audit, out))
    assert found[None][:4] == (0, 1, 0, 0)
    turns_out = repair.repaired(turns).filter("conv_id = 1").orderBy("seq", "place").collect()
    assert [(r["role"], r["text"]) for r in turns_out] == out


def test_damage_and_empty_conversations(spark):
    kinds = {}
    for c, t in product(range(60), range(3)):
        kinds[c, t] = zlib.crc32(f"{c}:{t}".encode()) % 20
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"Text {c} {t}. And!") for c, t in kinds]
    table = spark.createDataFrame([*rows, (None, None, None, None)], "conv_id long, turn long, role string, text string")
    left = {}
    for r in queries.damaged(table).collect():
        left.setdefault((r["conv_id"], r["turn"]), []).append((r["role"], r["text"]))
    for c, t, role, text in rows:
        kind = kinds[c, t]
        want = {0: [], 1: [(role, "")], 2: [(role, f"Text {c} {t} And")], 3: [(role, text)] * 2, 4: [("user", text)]}.get(kind, [(role, text)])
        assert left.get((c, t), []) == want
    assert {*kinds.values()} >= {0, 1, 2, 3, 4}
    gone = next(c for (c, t), k in kinds.items() if k == 0)
    one = table.filter(f"conv_id = {gone} and turn = {next(t for (c, t), k in kinds.items() if (c, k) == (gone, 0))}")
    assert [tuple(r) for r in repair.report(queries.damaged(one), one).collect()] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    none = table.limit(0)
    assert repair.report(queries.damaged(none), none).collect() == []


@pytest.mark.parametrize("role", ["user", "assistant"])
def test_very_long_texts(spark, role):
    text = "word " * 400_000 + "end."
    rows = [(1, 0, role, text), (1, 1, "assistant", "Short.")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = repair.report(turns, turns).collect()[0]
    assert found["audit"] == ("KK" if role == "user" else "RK")
    assert found["repaired_sha256"] == hashlib.sha256(f"user:{text}\nassistant:Short.".encode()).hexdigest()
