"""Repairs equal a search over all edits: costs, least audits, cuts, damaged tables, odd rows."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from tracklab.llm import conv_repair as C
from tracklab.llm.common import table
from tracklab.llm.queries import QUERIES

WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
GOOD = re.compile(r"(s?(ua)+)?\Z")


def row_faults(rows):
    seen, out = set(), []
    for role, text in rows:
        kept = text.rstrip(WHITE)
        out.append("blank" if not kept else "duplicate" if (role, text) in seen else "truncated" if kept[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def searched(rows, faults):
    """Cheapest, then least audit by trying ever more edits: a plain search over (row, initials)."""
    best = {(0, ""): (0, "")}
    for i in range(len(rows) + 1):
        for _ in range(2):
            for (at, last), (cost, audit) in list(best.items()):
                if at == i:
                    said = "u" if last in ("", "s", "a") else "a"
                    new = (cost + 5, audit + "I")
                    best[i, said] = min(best.get((i, said), new), new)
        if i == len(rows):
            break
        initial, extra = rows[i][0][:1], 5 if faults[i] == "truncated" else 0
        for (at, last), (cost, audit) in list(best.items()):
            if at != i:
                continue
            options = [(last, cost + 2, "D")]
            if faults[i] in ("", "truncated"):
                said = "u" if last in ("", "s", "a") else "a"
                options.append((said, cost + 1 + extra, "R"))
                if initial and last + initial in ("s", "u", "su", "ua", "au"):
                    options.append((initial, cost + extra, "K"))
            for said, c, letter in options:
                new = (c, audit + letter)
                best[i + 1, said] = min(best.get((i + 1, said), new), new)
    return min(v for (at, last), v in best.items() if at == len(rows) and last in ("", "a"))


def exhaustive(rows, faults):
    """The same by writing out every audit with at most three insertions."""
    best = None
    n = len(rows)
    for places in product(range(4), repeat=n + 1):
        if sum(places) > 3:
            continue
        for letters in product("KRD", repeat=n):
            audit = "".join("I" * k + c for k, c in zip(places, [*letters, ""]))
            cost, said = 5 * sum(places), ""
            i = 0
            for c in audit:
                if c == "I":
                    said += "u" if said[-1:] in ("", "s", "a") else "a"
                    continue
                initial, fault = rows[i][0][:1], faults[i]
                i += 1
                if c == "D":
                    cost += 2
                    continue
                if fault in ("blank", "duplicate"):
                    cost = 999
                    break
                cost += (5 if fault == "truncated" else 0) + (c == "R")
                said += initial if c == "K" else "u" if said[-1:] in ("", "s", "a") else "a"
            if cost < 999 and GOOD.match(said) and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


def plain(rows):
    """Summary of one conversation of (turn, role, text) rows in order."""
    pairs = [(role, text) for _, role, text in rows]
    faults = row_faults(pairs)
    cost, audit = searched(pairs, faults)
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    initials = [role[:1] for role, _ in pairs]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    lines, last, i = [], "", 0
    for c in audit:
        role, text = pairs[i] if c != "I" else ("", "")
        i += c != "I"
        if c == "D":
            continue
        if c in "RI":
            role = "assistant" if last == "u" else "user"
        last = role[:1]
        lines.append(f"{role}:{text}")
    assert GOOD.match("".join(x[0] for x in lines))
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)


def summaries(frame, rows, **more):
    df = frame([(*r, "x", 7, "y") for r in rows], "conv_id long, turn long, role string, text string, head string, n int, seg string", 3)
    return {r[0]: tuple(r)[1:] for r in C.digests(C.repair(df, **more)).collect()}


def expected(rows):
    out, rows = {}, [(c, t, *(" " if x is None else x for x in rest)) for c, t, *rest in rows]
    for conv, *message in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2:])):
        out.setdefault(conv, []).append(tuple(message))
    return {c: plain(r) for c, r in out.items()}


def some_rows(rng, conversations, longest):
    texts = ["Yes.", "No!", "cut", "", " \n", "Why? ", "so on...", "end. \t", "tail\n", "a b c."]
    out = []
    for c in range(conversations):
        for t in range(rng.randint(1, longest)):
            if rng.random() < 0.85:
                role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", None])
                out.append((c if c else None, rng.choice([t, t, t, t + 1, None]), role, rng.choice(texts + [f"t{t}.", f"c{c} t{t}!", None])))
    return out


def test_search_equals_all_audits():
    rng = random.Random(1)
    for _ in range(60):
        rows = [(rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["a.", "b.", "c", ""])) for _ in range(rng.randint(0, 4))]
        faults = row_faults(rows)
        assert searched(rows, faults) == exhaustive(rows, faults)


@pytest.mark.parametrize("rules", [[], [("u", "a"), (chr(C.FIRST_RULE), chr(C.FIRST_RULE)), ("d", "d"), ("s", chr(C.FIRST_RULE + 1))]])
def test_grammar_equals_search(rules):
    rng, grammar = random.Random(2), C.Grammar(rules)
    for _ in range(300):
        symbols = "".join(rng.choice("suauauaoSUAOd") for _ in range(rng.randint(0, 14)))
        rows = [({"d": "user"}.get(x, x.lower()), "") for x in symbols]
        faults = ["blank" if x == "d" else "truncated" if x.isupper() else "" for x in symbols]
        sequence = grammar.compressed([symbols])[0]
        walk = C.Walk()
        for x in sequence:
            walk.step(grammar.matrix[x])
        cost, end, tail = walk.finish()
        assert (cost, grammar.audit(sequence, 0, end) + "I" * tail) == searched(rows, faults)
        whole = grammar.product(sequence)
        assert whole.cost[end] == cost - 5 * tail


def test_pairs_of_runs_do_not_overlap():
    a, b, n = C.counted_pairs("ddddd\nuaua\nd")
    assert dict(zip(zip(map(chr, a), map(chr, b)), n)) == {("d", "d"): 2, ("u", "a"): 2, ("a", "u"): 1}
    assert len(C.counted_pairs("")[0]) == len(C.counted_pairs("x")[0]) == 0


@pytest.mark.parametrize("segment", [1, 2, 5, 8192])
def test_equals_search(frame, monkeypatch, segment):
    monkeypatch.setattr(C, "SEGMENT", segment)
    rows = some_rows(random.Random(segment), 40, 12)
    assert summaries(frame, rows) == expected(rows)


def test_repeated_messages_and_one_long_conversation(frame, monkeypatch):
    monkeypatch.setattr(C, "SEGMENT", 50)
    rng = random.Random(5)
    rows = [(1, t, rng.choice(["user", "assistant"]), rng.choice(["ok.", "cut", f"{t}."])) for t in range(700)]
    rows += [(2, 3, "user", "again.")] * 130 + [(2, None, "user", "again.")] * 3 + [(3, 1, "system", "x" * 300_000 + ".")]
    assert summaries(frame, rows) == expected(rows)


def test_steps_are_the_repair(frame):
    rows = [(1, 1, "system", "Be kind."), (1, 2, "assistant", "Hello."), (1, 3, "user", " "), (1, 4, "assistant", "The end.")]
    df = frame(rows, "conv_id long, turn long, role string, text string")
    got = [(r.step, r.edit, r.role, r.text) for r in C.repair(df).orderBy("step").collect()]
    cost, audit = searched([r[2:] for r in rows], row_faults([r[2:] for r in rows]))
    assert "".join(e for _, e, _, _ in got[1:]) == audit and got[0][1:] == (None, None, None)
    assert [s for s, *_ in got] == list(range(len(audit) + 1))
    assert "".join(r[:1] for _, e, r, _ in got[1:] if e != "D") == "sua"


def test_damaged_table(spark, sf):
    given = {}
    for r in table(spark, sf, "conversations").collect():
        given.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    want = {}
    for conv, rows in given.items():
        out = []
        for turn, role, text in sorted(rows):
            harm = zlib.crc32(f"{conv}:{turn}".encode()) % 20
            text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
            out += [(turn, "user" if harm == 4 else role, text)] * (0 if harm == 0 else 2 if harm == 3 else 1)
        want[conv] = plain(out)
    df = QUERIES["op13_conversation_repair"](spark, sf)
    assert {r[0]: tuple(r)[1:] for r in df.collect()} == want
    assert df.columns[1:] == ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_conversations_without_messages(frame):
    df = frame([(1, 1, "user", "a.", 0), (1, 2, "user", "b.", 0), (2, 1, "user", "c.", 0), (2, 2, "user", "c.", 1)],
               "conv_id long, turn long, role string, text string, k int")
    got = {r[0]: tuple(r)[1:] for r in C.digests(C.repair(df, copies=F.col("k"))).collect()}
    assert got == {1: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()), 2: plain([(2, "user", "c.")])}
    assert C.digests(C.repair(df.limit(0), copies=F.col("k"))).count() == 0
