import hashlib
import itertools
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from answerloom.llm import repair

LEGAL = re.compile(r"(s?(ua)+)?")


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\f\r")
        out.append(1 if not body else 2 if (role, text) in seen else 0 if body[-1] in ".!?" else 3)
        seen.add((role, text))
    return out


def options(role, fault):
    """(edit, letter, cost) of a row."""
    out = [("D", "", 3)]
    if fault not in (1, 2):
        extra = int(fault == 3)
        out += [("K", role[:1], extra), ("R", "u", 2 + extra), ("R", "a", 2 + extra)]
    return out


def every_edit(rows, marks):
    """The least (cost, audit) of all edits with up to two insertions between rows."""
    gaps = [("", "", 0), *(("I", x, 2) for x in "ua"), *(("II", x + y, 4) for x in "ua" for y in "ua")]
    best = None
    for chosen in itertools.product(*[step for row, fault in zip(rows, marks) for step in (gaps, options(row[1], fault))], gaps):
        if LEGAL.fullmatch("".join(c[1] for c in chosen)):
            found = (sum(c[2] for c in chosen), "".join(c[0] for c in chosen))
            best = found if best is None else min(best, found)
    return best


def least_edit(rows, marks):
    """The same, state by state: the start, after s, after u, after a."""
    after = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def opened(states):
        for _ in range(2):
            for state, (cost, audit) in list(states.items()):
                for letter in "ua":
                    to = after.get((state, letter))
                    if to:
                        states[to] = min(states.get(to, (10**9, "")), (cost + 2, audit + "I"))
        return states

    states = opened({"0": (0, "")})
    for (_, role, _), fault in zip(rows, marks):
        new = {}
        for state, (cost, audit) in states.items():
            for edit, letter, more in options(role, fault):
                to = state if edit == "D" else after.get((state, letter))
                if to:
                    new[to] = min(new.get(to, (10**9, "")), (cost + more, audit + edit))
        states = opened(new)
    return min(states[s] for s in ("0", "a") if s in states)


def repaired(rows, audit):
    out, rows = [], iter(rows)
    for edit in audit:
        turn, role, text = (None, None, "") if edit == "I" else next(rows)
        if edit != "D":
            if edit != "K":
                role = "assistant" if out and out[-1][1][0] == "u" else "user"
            out.append((turn, role, text, edit))
    return out


def report(rows, audit_of):
    marks = faults(rows)
    cost, audit = audit_of(rows, marks)
    turns = [r[0] for r in rows if r[0] is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    lines = "\n".join(f"{role}:{text}" for _, role, text, _ in repaired(rows, audit))
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(marks.count(k) for k in (1, 2, 3)),
        sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(lines.encode()).hexdigest(),
    )


@pytest.fixture(scope="module")
def conversations():
    """Rows by conversation: any roles, blank, repeated and cut texts, missing and equal turns, none at all, one long."""
    rng = random.Random(11)
    out = {}
    for conv in [None, *range(60), 1000]:
        n = 700 if conv == 1000 else rng.randint(0, 4) if conv is None or conv % 2 else rng.randint(5, 20)
        by_turn = {}
        for _ in range(n):
            turn = rng.choice([None, *range(12)]) if n < 100 else rng.randint(0, 2000)
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "user2", None, ""])
            text = by_turn.setdefault((turn, role), rng.choice(["Yes.", "no", "", " \n", "wéll!", "one\ntwo? ", None, "…"]) if rng.random() < 0.5 else f"text {rng.randint(0, 10**6)}.")
            by_turn.setdefault("rows", []).append((turn, role, text))
        out[conv] = by_turn.get("rows", [])
    return out


@pytest.fixture(scope="module")
def frame(spark, conversations):
    rows = [(c, *r, False, "x", 1) for c, rs in conversations.items() for r in rs] + [(c, 3, "user", "gone", True, "x", 1) for c in [*conversations, 77]]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, gone boolean, audit string, fault int").repartition(6)


def in_order(rows):
    plain = [(t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows]
    return sorted(plain, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2]))


def test_reports_are_those_of_plain_search(frame, conversations):
    found = {x.conv_id: tuple(x)[1:] for x in repair.repair_report(frame, gone="gone").collect()}
    want = {c: report(in_order(rs), least_edit) for c, rs in (conversations | {77: []}).items()}
    assert found == want
    assert found[77] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_repaired_rows_are_whole(frame, conversations):
    found = defaultdict(list)
    for x in repair.repaired_turns(frame, gone="gone").collect():
        found[x.conv_id].append((x.place, x.turn, x.role, x.text, x.edit))
    for conv, rows in conversations.items():
        rows = in_order(rows)
        want = repaired(rows, least_edit(rows, faults(rows))[1])
        assert sorted(found[conv]) == [(k, *w) for k, w in enumerate(want)]
        assert LEGAL.fullmatch("".join(w[1][0] for w in want))


def test_states_and_all_edits_agree():
    rng = random.Random(2)
    for _ in range(40):
        rows = [(k, rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["a.", "b", "", "c."])) for k in range(rng.randint(0, 3))]
        assert every_edit(rows, faults(rows)) == least_edit(rows, faults(rows))


def test_empty_table_and_no_gone_column(frame):
    assert repair.repair_report(frame.filter("false")).count() == 0
    assert repair.repaired_turns(frame.filter("false")).count() == 0
    assert repair.repair_report(frame.drop("gone")).filter("conv_id = 77").first().audit in ("KI", "D")


def test_plain_joins_agree_with_numpy():
    """A conversation cut anywhere gives what it gives whole."""
    rng = random.Random(5)
    for _ in range(30):
        rows = [(k, rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["a.", "b", "", f"c{k}."])) for k in range(rng.randint(1, 30))]
        marks = faults(rows)
        code = np.array([{"s": 1, "u": 2, "a": 3}.get(r[1][0], 0) for r in rows])
        cells = repair.row_cells(code, np.isin(marks, (1, 2)), np.array(marks) == 3)
        spans = repair.Spans()
        at = 0
        while at < len(rows):
            size = min(rng.randint(1, repair.WIDEST), len(rows) - at)
            spans.add(size, repair.interval_cells(cells, np.array([at]), np.array([size])).plain()[0])
            at += size
        assert min(x for k, x in enumerate(spans.whole()) if k in repair.WHOLE and x) == least_edit(rows, marks)
