"""Repairs of conversations against enumeration, and their faults on odd rows."""

import random
import re
from itertools import product

import pytest

from corpusloom.llm import repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def enumerated(shape):
    """The best (cost, audit) of all strings of edits with up to four inserts, by the definition."""
    best = None
    for inserts in range(5):
        for places in product(range(len(shape) + 1), repeat=inserts):
            if list(places) != sorted(places):
                continue
            for letters in product("DKua", repeat=len(shape)):
                for inserted in product("ua", repeat=inserts):
                    cost, audit, out = 0, "", ""
                    new = iter(zip(places, inserted))
                    ahead = next(new, None)
                    for i in range(len(shape) + 1):
                        while ahead and ahead[0] == i:
                            cost, audit, out, ahead = cost + 5, audit + "I", out + ahead[1], next(new, None)
                        if i == len(shape):
                            break
                        turn, letter = shape[i], letters[i]
                        if letter == "D":
                            cost, audit = cost + 2, audit + "D"
                            continue
                        if turn == "x":
                            break
                        cost += 5 * (turn in "SUA!") + (letter != "K")
                        audit += "K" if letter == "K" else "R"
                        out += (turn.lower() if turn != "!" else "?") if letter == "K" else letter
                    else:
                        continue
                    if i == len(shape) and re.fullmatch("(s?(ua)+)?", out) and (best is None or (cost, audit) < best):
                        best = cost, audit
    return best


def by_states(shape):
    """The best (cost, audit) by what was placed last, turn by turn."""
    def grown(states):
        for before, after in (("E", "U"), ("S", "U"), ("A", "U"), ("U", "A")):
            if before in states:
                cost, audit = states[before]
                states[after] = min(states.get(after, (10**9, "")), (cost + 5, audit + "I"))
        return states

    states = {"E": (0, "")}
    for turn in shape:
        found = {}
        for state, (cost, audit) in grown(states).items():
            steps = [(state, 2, "D")]
            if turn != "x":
                more, role = 5 * (turn in "SUA!"), turn.lower()
                if role == "s" and state == "E":
                    steps.append(("S", more, "K"))
                wanted = "a" if state == "U" else "u"
                steps.append((wanted.upper(), more + (role != wanted), "K" if role == wanted else "R"))
            for after, price, letter in steps:
                found[after] = min(found.get(after, (10**9, "")), (cost + price, audit + letter))
        states = found
    return min(v for k, v in grown(states).items() if k in "EA")


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_cheapest_by_enumeration(n):
    rng = random.Random(n)
    for shape in {"".join(rng.choice("suaSUA?!x") for _ in range(n)) for _ in range(25)}:
        assert repair.cheapest(shape) == enumerated(shape) == by_states(shape), shape


def test_cheapest_by_states():
    rng = random.Random(9)
    for n in range(30):
        for _ in range(60):
            shape = "".join(rng.choice("suauauaSUA?!xx") for _ in range(n))
            assert repair.cheapest(shape) == by_states(shape), shape
    for shape in ("u" * 200, "x" * 150, "".join(("ua"[i % 2] if rng.random() > 0.2 else rng.choice("sUA?!x")) for i in range(600))):
        assert repair.cheapest(shape) == by_states(shape)


def test_small_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr(repair, "SHAPES", 1)
    repairer = repair.Repairer()
    assert [repairer.audit(s) for s in ("ua", "uu", "ua")] == [by_states(s) for s in ("ua", "uu", "ua")]


def test_faults_repairs_and_odd_rows(spark):
    rows = [
        (1, 2, "assistant", "Yes."), (1, None, "user", "First?"), (1, 5, "assistant", "Yes."), (1, 6, "user", " \n"), (1, 7, "user", "cut off"),
        (2, 1, None, None), (3, 1, "tool", "Out."), (3, 1, "tool", "Out."), (3, 1, "bot", "Other!"),
        (None, 1, "system", "Be kind."), (None, 2, "user", "Hi."), (None, 3, "assistant", "Hello."),
    ]
    turns = spark.createDataFrame(rows, SCHEMA).withColumn("audit", __import__("pyspark").sql.functions.lit("x"))
    found = {r.conv_id: r for r in repair.repaired(turns).collect()}
    one = found[1]
    assert (one.gaps, one.blank, one.duplicate, one.truncated, one.illegal) == (2, 1, 1, 1, 2)
    assert (one.cost, one.audit, [(t.role, t.text) for t in one.repaired]) == (6, "KKDDD", [("user", "First?"), ("assistant", "Yes.")])
    assert (found[2].blank, found[2].cost, found[2].audit, found[2].repaired) == (1, 2, "D", [])
    # The two tools' turns are one; the bot's comes first, by role.
    assert (found[3].duplicate, found[3].audit, [t.role for t in found[3].repaired]) == (1, "RRD", ["user", "assistant"])
    assert (found[None].cost, found[None].audit, found[None].gaps) == (0, "KKK", 0)
    assert repair.repaired(turns.limit(0)).count() == 0


def test_damage_and_ids_without_turns(spark):
    import zlib

    rows = [(c, t, "assistant", "One. Two!") for c in range(40) for t in (None, 0, 1)]
    turns = spark.createDataFrame(rows, SCHEMA)
    hurt = {}
    for r in repair.damaged(turns).collect():
        hurt.setdefault((r.conv_id, r.turn), []).append((r.role, r.text, r.present))
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20
        wanted = {0: [(role, text, False)], 1: [(role, "", True)], 2: [(role, "One Two", True)], 3: [(role, text, True)] * 2, 4: [("user", text, True)]}
        assert hurt[c, t] == wanted.get(kind, [(role, text, True)])
    kept = repair.repaired(repair.damaged(turns), "present")
    assert kept.count() == 40
    none = repair.repaired(turns.selectExpr("*", "false AS there"), "there").collect()
    assert len(none) == 40 and all((r.cost, r.audit, r.gaps, r.repaired) == (0, "", 0, []) for r in none)
