"""Cheapest repair of conversations: blank, repeated and cut-off messages, and turns out of order.

A message becomes a symbol of its role and fault.  Editing one message (with insertions before
it) is a min-plus matrix over the states of the grammar ``(s?(ua)+)?`` of role initials, and a
conversation is the product of its symbols' matrices.  Re-Pair replaces the corpus' most frequent
pairs of symbols by rules, in rounds; a rule's matrix is the product of its two halves, computed
once and used for every conversation.  Every entry of a matrix holds its cost, the place of its
audit text among the matrix' entries, and the state between the halves, which makes the audit a
rope: it is spelled out only for the entry that a conversation takes.  Audits of one matrix
describe the same messages and never end in an insertion, so none is the beginning of another
and places are enough to compare joined audits.  What the bounded set of rules leaves
uncompressed is multiplied symbol by symbol, so the rules never change a result.

A conversation of any length is cut into segments over a global sort; segments are evaluated
apart and a fold over their matrices finds the state at every cut.  Only the last step, the
messages in order, passes a conversation through one task, as a sorted stream.

Null roles and texts are one space.  Messages are taken by turn (nulls first), then role, then
text (64 code points and a digest of the whole); equal messages are counted before they are
sorted.  A null id is a conversation of its own.  Empty and very long texts are whole.  Other
columns, whatever their names, are not read.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tracklab.llm.common import WORD
from tracklab.sources.staging import stage

# Costs of edits and of a truncated message that stays.
RENAME, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
# Symbols of a segment, rules of the grammar, rounds of counting and rules of a round at most.
SEGMENT, RULES, ROUNDS, ROUND_RULES = 8192, 256, 10, 32
# Sequences whose product a task remembers, and the longest it does; rows and characters of a result batch.
MEMO, MEMO_SYMBOLS, BATCH_ROWS, BATCH_CHARS = 50_000, 64, 4096, 1 << 22

# States: nothing said, a system message, a user's, an assistant's.  The first and last may end.
_NONE, _SYSTEM, _USER, _ASSISTANT = range(4)
_SAID = {"s": {_NONE: _SYSTEM}, "u": {_NONE: _USER, _SYSTEM: _USER, _ASSISTANT: _USER}, "a": {_USER: _ASSISTANT}}
_LEGAL = {"su", "ua", "au"}
# Symbols: initials of sound messages, in upper case of truncated ones; any that must go.
GONE, FIRST_RULE = "d", 0xE000
_NEVER = 1 << 60


class Matrix(NamedTuple):
    """16 entries (from state * 4 + to state): costs, places of their audits, states in between."""

    cost: tuple[int, ...]
    place: tuple[int, ...]
    middle: tuple[int, ...]


IDENTITY = Matrix(tuple(0 if i % 5 == 0 else _NEVER for i in range(16)), (0,) * 16, (0,) * 16)


def _insertions() -> dict[tuple[int, int], int]:
    """(from, to) -> fewest inserted messages that lead there."""
    out = {(s, s): 0 for s in range(4)}
    for _ in range(4):
        for (a, b), n in list(out.items()):
            for said in "ua":
                if (c := _SAID[said].get(b)) is not None and n + 1 < out.get((a, c), 9):
                    out[a, c] = n + 1
    return out


_INSERTED = _insertions()


def _edits(symbol: str) -> Iterator[tuple[int, int, int, str]]:
    """(from, to, cost, letter) of the edits of one message."""
    for s in range(4):
        yield s, s, DELETE, "D"
    if symbol != GONE:
        extra = CUT_OFF if symbol.isupper() else 0
        for s, t in _SAID.get(symbol.lower(), {}).items():
            yield s, t, extra, "K"
        for said in "ua":
            for s, t in _SAID[said].items():
                yield s, t, extra + RENAME, "R"


def _places(keys: list) -> tuple[int, ...]:
    order = {k: i for i, k in enumerate(sorted(set(keys)))}
    return tuple(order[k] for k in keys)


def terminal(symbol: str) -> tuple[Matrix, list[str]]:
    """Matrix and audits of one message with the insertions before it."""
    best: list[tuple[int, str]] = [(_NEVER, "")] * 16
    for (a, b), n in _INSERTED.items():
        for s, t, cost, letter in _edits(symbol):
            if s == b:
                best[a * 4 + t] = min(best[a * 4 + t], (INSERT * n + cost, "I" * n + letter))
    audits = [audit for _, audit in best]
    return Matrix(tuple(c for c, _ in best), _places(audits), (0,) * 16), audits


def times(a: Matrix, b: Matrix) -> Matrix:
    """Min-plus product; among equal costs the entry with the least audit."""
    cost, keys, middle = [], [], []
    for i in range(0, 16, 4):
        for j in range(4):
            found = min((a.cost[i + k] + b.cost[4 * k + j], a.place[i + k], b.place[4 * k + j], k) for k in range(4))
            cost.append(min(found[0], _NEVER))
            keys.append(found[1:3])
            middle.append(found[3])
    return Matrix(tuple(cost), _places(keys), tuple(middle))


class Grammar:
    """Terminals and rules with their matrices; audits are spelled out on demand."""

    def __init__(self, rules: list[tuple[str, str]] = ()):
        self.rules: list[tuple[str, str]] = []
        self.matrix: dict[str, Matrix] = {}
        self.audits: dict[str, list[str]] = {}
        self.halves: dict[str, tuple[str, str]] = {}
        self.spelled: dict[tuple[str, int], str] = {}
        self.memo: dict[str, Matrix] = {}
        for symbol in "suaoSUAO" + GONE:
            self.matrix[symbol], self.audits[symbol] = terminal(symbol)
        for a, b in rules:
            self.add(a, b)

    def add(self, a: str, b: str) -> None:
        """A rule for the pair, evaluated from its halves."""
        symbol = chr(FIRST_RULE + len(self.rules))
        self.rules.append((a, b))
        self.halves[symbol] = (a, b)
        self.matrix[symbol] = times(self.matrix[a], self.matrix[b])

    def compressed(self, sequences: list[str]) -> list[str]:
        """Sequences after all rules, in the order in which they were found."""
        text = "\n".join(sequences)
        for i, (a, b) in enumerate(self.rules):
            text = text.replace(a + b, chr(FIRST_RULE + i))
        return text.split("\n") if sequences else []

    def product(self, sequence: str) -> Matrix:
        """Matrix of a compressed sequence."""
        if (found := self.memo.get(sequence)) is None:
            found = IDENTITY
            for i, symbol in enumerate(sequence):
                found = times(found, self.matrix[symbol]) if i else self.matrix[symbol]
            if len(sequence) <= MEMO_SYMBOLS:
                if len(self.memo) >= MEMO:
                    self.memo.clear()
                self.memo[sequence] = found
        return found

    def spell(self, symbol: str, entry: int) -> str:
        """Audit of one entry of a symbol's matrix."""
        if symbol not in self.halves:
            return self.audits[symbol][entry]
        if (found := self.spelled.get((symbol, entry))) is None:
            k, (a, b) = self.matrix[symbol].middle[entry], self.halves[symbol]
            found = self.spell(a, entry // 4 * 4 + k) + self.spell(b, k * 4 + entry % 4)
            self.spelled[symbol, entry] = found
        return found

    def audit(self, sequence: str, begin: int, end: int) -> str:
        """Cheapest and least audit of a compressed sequence between two states."""
        walk = Walk(begin)
        for symbol in sequence:
            walk.step(self.matrix[symbol])
        states = walk.path(end)
        return "".join(self.spell(x, s * 4 + t) for x, s, t in zip(sequence, states, states[1:]))


class Walk:
    """The cheapest way from one state through matrices in a row, with the least audit."""

    def __init__(self, begin: int = _NONE):
        self.cost = [0 if s == begin else _NEVER for s in range(4)]
        self.place = [0] * 4
        self.back: list[tuple[int, ...]] = []

    def step(self, m: Matrix) -> None:
        found = [min((self.cost[k] + m.cost[4 * k + j], self.place[k], m.place[4 * k + j], k) for k in range(4)) for j in range(4)]
        self.cost = [min(f[0], _NEVER) for f in found]
        self.place = list(_places([f[1:3] for f in found]))
        self.back.append(tuple(f[3] for f in found))

    def path(self, end: int) -> list[int]:
        """States before, between and after the matrices."""
        out = [end]
        for back in reversed(self.back):
            out.append(back[out[-1]])
        return out[::-1]

    def finish(self) -> tuple[int, int, int]:
        """(cost, last state, insertions at the end) of the best complete conversation."""
        ends = []
        for s in range(4):
            n = min(_INSERTED[s, t] for t in (_NONE, _ASSISTANT) if (s, t) in _INSERTED)
            ends.append((self.cost[s] + INSERT * n, self.place[s], n, s))
        cost, _, n, s = min(ends)
        return cost, s, n


def counted_pairs(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, second, times) of adjacent symbols in lines; of a run of equals every second pair."""
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
    a, b = codes[:-1], codes[1:]
    starts = np.append(True, a[1:] != a[:-1]) if len(a) else np.empty(0, bool)
    at = np.arange(len(a))
    odd = (at - np.maximum.accumulate(np.where(starts, at, 0))) % 2 == 1 if len(a) else starts
    use = (a != 10) & (b != 10) & ~((a == b) & odd)
    pairs, n = np.unique((a[use] << 32) | b[use], return_counts=True)
    return pairs >> 32, pairs & 0xFFFFFFFF, n


def learn(segments: DataFrame) -> list[tuple[str, str]]:
    """Rules of the column ``symbols``: per round, frequent pairs that cannot overlap each other.

    At most ``RULES`` rules leave the cluster; pairs are counted over all segments.
    """
    rules: list[tuple[str, str]] = []

    def counts(known):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            grammar = Grammar(known)
            for batch in batches:
                lines = grammar.compressed(batch.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in counted_pairs("\n".join(lines))], ["a", "b", "n"])
        return run

    for _ in range(ROUNDS):
        found = segments.select("symbols").mapInArrow(counts(list(rules)), "a long, b long, n long")
        best = found.groupBy("a", "b").agg(F.sum("n").alias("n")).filter("n >= 2").orderBy(F.desc("n"), "a", "b").limit(4 * ROUND_RULES).collect()
        firsts, seconds, new = set(), set(), []
        for row in best:
            if row.a not in seconds and row.b not in firsts and len(new) < min(ROUND_RULES, RULES - len(rules)):
                firsts.add(row.a)
                seconds.add(row.b)
                new.append((chr(row.a), chr(row.b)))
        if not new:
            break
        rules += new
    return rules


_SUMMARY = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


class _Segment:
    """Symbols and counts of consecutive messages of one conversation."""

    def __init__(self, key: tuple):
        self.key, self.symbols = key, []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.least = self.most = None

    def add(self, initial: str, turn, blank: bool, cut_off: bool, repeated: bool, n: int) -> None:
        """``n`` equal messages, of which the first may be the first of its role and text."""
        sound = not blank and not repeated
        self.symbols.append(((initial.upper() if cut_off else initial) if sound else GONE) + GONE * (n - 1))
        if blank:
            self.blank += n
        else:
            self.duplicate += n - sound
            self.truncated += sound and cut_off
        self.illegal += n - 1 + (self.last is not None and self.last + initial not in _LEGAL)
        self.first, self.last = self.first or initial, initial
        if turn is not None:
            self.turns += turn != self.most
            self.least = turn if self.least is None else self.least
            self.most = turn


_SEGMENT_COLUMNS = ("seg long, symbols string, blank long, duplicate long, truncated long, illegal long, n_turns long, "
                    "first string, last string, least long, most long")


def _segments(schema: pa.Schema):
    """Sorted messages -> segments, numbered in order over all partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, current, size, out = TaskContext.get().partitionId() << 40, None, 0, []

        def closed(s: _Segment) -> tuple:
            return (*s.key, number, "".join(s.symbols), s.blank, s.duplicate, s.truncated, s.illegal, s.turns, s.first, s.last, s.least, s.most)

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                conv, turn, role, head, digest, blank, cut_off, n, repeated = row
                if current is None or conv != current.key[0] or size >= SEGMENT:
                    if current is not None:
                        out.append(closed(current))
                        number += 1
                    current, size = _Segment((conv, turn, role, head, digest)), 0
                initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
                while n > 0:
                    some = min(n, SEGMENT - size)
                    current.add(initial, turn, blank, cut_off, repeated, some)
                    n, size, repeated = n - some, size + some, True
                    if n:
                        out.append(closed(current))
                        number += 1
                        current, size = _Segment((conv, turn, role, head, digest)), 0
                if len(out) >= 256:
                    yield _batch(out, schema)
                    out = []
        if current is not None:
            out.append(closed(current))
        if out:
            yield _batch(out, schema)

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def _with_matrices(rules: list[tuple[str, str]], schema: pa.Schema):
    """Segments without their symbols, with cost and place of every entry."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(rules)
        for batch in batches:
            found = [grammar.product(s) for s in grammar.compressed(batch.column("symbols").to_pylist())]
            kept = [batch.column(n) for n in schema.names[:-2]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array([m.cost for m in found], schema.types[-2]),
                                              pa.array([m.place for m in found], schema.types[-1])], schema=schema)
    return run


def _folded(schema: pa.Schema):
    """Segments of conversations in order -> states at both ends of each; totals with the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def close(segs: list[int], walk: Walk, total: dict) -> None:
            cost, end, tail = walk.finish()
            states = walk.path(end)
            span = 0 if total["least"] is None else total["most"] - total["least"] + 1 - total["n_turns"]
            for i, seg in enumerate(segs):
                sums = (span, total["blank"], total["duplicate"], total["truncated"], total["illegal"], cost) if i == 0 else (None,) * 6
                out.append((seg, states[i], states[i + 1], tail if i == len(segs) - 1 else 0, *sums))

        conv, segs, walk, total = None, [], None, None
        for batch in batches:
            for row in batch.to_pylist():
                if not segs or row["conv_id"] != conv:
                    if segs:
                        close(segs, walk, total)
                    conv, segs, walk = row["conv_id"], [], Walk()
                    total = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "n_turns"), 0) | dict.fromkeys(("last", "least", "most"))
                segs.append(row["seg"])
                walk.step(Matrix(row["cost"], row["place"], ()))
                for c in ("blank", "duplicate", "truncated", "illegal", "n_turns"):
                    total[c] += row[c]
                if row["first"] is not None:
                    total["illegal"] += total["last"] is not None and total["last"] + row["first"] not in _LEGAL
                    total["last"] = row["last"]
                if row["least"] is not None:
                    total["n_turns"] -= row["least"] == total["most"]
                    total["least"] = row["least"] if total["least"] is None else total["least"]
                    total["most"] = row["most"]
                if len(out) >= BATCH_ROWS:
                    yield _batch(out, schema)
                    out = []
        if segs:
            close(segs, walk, total)
        if out:
            yield _batch(out, schema)

    return run


def _spelled(rules: list[tuple[str, str]], schema: pa.Schema):
    """Segments with their states -> the audit of each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(rules)
        for batch in batches:
            sequences = grammar.compressed(batch.column("symbols").to_pylist())
            ends = zip(*(batch.column(c).to_pylist() for c in ("begin", "end", "tail")))
            audits = [grammar.audit(s, a, b) + "I" * n for s, (a, b, n) in zip(sequences, ends)]
            yield pa.RecordBatch.from_arrays([pa.array(audits, pa.string()) if n == "audit" else batch.column(n) for n in schema.names], schema=schema)
    return run


def _repaired(schema: pa.Schema):
    """Audits and messages of conversations in order -> a head row and a row per edit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, step, state, letters = None, 0, _NONE, deque()

        def edits(n: int, role: str, text: str) -> Iterator[tuple]:
            """Edits up to and with those of ``n`` messages; of all that are left if ``n`` is 0."""
            nonlocal step, state
            while letters and (n or letters[0] == "I"):
                edit, step = letters.popleft(), step + 1
                next_role = "assistant" if state == _USER else "user"
                shown = {"I": (next_role, ""), "R": (next_role, text)}.get(edit, (role, text))
                if edit != "D":
                    state = _SAID[shown[0][:1]][state]
                n -= edit != "I"
                yield (conv, step, edit, *shown, *(None,) * 6)

        def rows() -> Iterator[tuple]:
            nonlocal conv, step, state
            for batch in batches:
                for r in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                    one, kind, audit, role, text, n, *summary = r
                    if kind:
                        yield from edits(n, role, text)
                        continue
                    if summary[-1] is not None:
                        yield from edits(0, "", "")
                        conv, step, state = one, 0, _NONE
                        yield (conv, 0, None, None, None, *summary)
                    letters.extend(audit)
            yield from edits(0, "", "")

        out, chars = [], 0
        for row in rows():
            out.append(row)
            chars += len(row[4] or "")
            if len(out) >= BATCH_ROWS or chars >= BATCH_CHARS:
                yield _batch(out, schema)
                out, chars = [], 0
        if out:
            yield _batch(out, schema)

    return run


def _arrow(df: DataFrame, fields: str) -> tuple[T.StructType, pa.Schema]:
    """A schema that begins with the frame's own conversation id."""
    struct = T.StructType([df.schema["conv_id"], *T._parse_datatype_string(fields).fields])
    return struct, to_arrow_schema(struct)


def faults(rows: DataFrame) -> DataFrame:
    """Messages without their texts, equal ones counted, with what is wrong with each.

    ``rows``: (conv_id, turn, role, text, n).  ``repeated``: an earlier turn has the same role
    and text.  Only texts that come in several turns are looked up, through a staged table, so
    that the rows of a hot conversation can be split.
    """
    text = F.col("text")
    light = rows.select(
        "conv_id", "turn", "role", F.substring(text, 1, 64).alias("head"), F.sha2(text, 256).alias("digest"),
        (~text.rlike(WORD)).alias("blank"), (~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut_off"), "n")
    light = stage(light.groupBy(*light.columns[:-1]).agg(F.sum("n").alias("n")), "repair-messages")
    again = light.filter("n > 0 AND NOT blank").groupBy("conv_id", "role", "digest").agg(
        F.count("*").alias("turns"), F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("least"))
    again = stage(again.filter("turns > 1").select(
        F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), F.col("least.turn").alias("first")), "repair-repeats")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    repeated = F.col("d").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first"))
    return light.join(again, same, "left").select(*light.columns, repeated.alias("repeated"))


def repair(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           copies: Column | None = None) -> DataFrame:
    """Conversations with the cheapest edits that make their roles ``(s?(ua)+)?``.

    Gives (conv_id, step, edit, role, text, gaps, blank, duplicate, truncated, illegal, cost), the rows
    of a conversation together and in order within one partition: step 0 holds the counts and
    the cost, the steps after it one edit each (Keep, Rerole, Delete, Insert) with the role and
    text that it leaves, or deletes.  ``copies`` says how often a row counts (once if not given);
    a row of no copies only names its conversation.
    """
    n = F.lit(1).cast("long") if copies is None else copies.cast("long")
    rows = df.select(F.col(f"`{conv_id}`").alias("conv_id"), F.col(f"`{turn}`").cast("long").alias("turn"), *[
        F.coalesce(F.col(f"`{c}`"), F.lit(" ")).alias(name) for c, name in ((role, "role"), (text, "text"))], n.alias("n"))
    rows = rows.select("conv_id", F.when(F.col("n") > 0, F.col("turn")).alias("turn"), *[
        F.when(F.col("n") > 0, F.col(c)).otherwise("").alias(c) for c in ("role", "text")], "n")
    order = ["conv_id", "turn", "role", "head", "digest"]

    found = faults(rows).select(*order, "blank", "cut_off", "n", "repeated")
    key = "turn long, role string, head string, digest string"
    struct, arrow = _arrow(rows, f"{key}, {_SEGMENT_COLUMNS}")
    segments = found.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_segments(arrow), struct)
    segments = stage(segments, "repair-segments")
    rules = learn(segments)

    kept = "seg long, blank long, duplicate long, truncated long, illegal long, n_turns long, first string, last string, least long, most long"
    struct, arrow = _arrow(rows, f"{kept}, cost array<long>, place array<int>")
    measured = segments.select("conv_id", "symbols", *[f.split(" ")[0] for f in kept.split(", ")]).mapInArrow(_with_matrices(rules, arrow), struct)
    ends = T._parse_datatype_string("seg long, begin int, end int, tail int, " + ", ".join(f"{c} long" for c in _SUMMARY))
    states = stage(measured.repartition("conv_id").sortWithinPartitions("conv_id", "seg").mapInArrow(_folded(to_arrow_schema(ends)), ends),
                   "repair-states")

    struct, arrow = _arrow(rows, f"{key}, seg long, audit string, " + ", ".join(f"{c} long" for c in _SUMMARY))
    asked = segments.select(*order, "seg", "symbols").join(states, "seg")
    plans = asked.mapInArrow(_spelled(rules, arrow), struct)
    none = F.lit(None)
    plans = plans.select(*order, F.lit(0).alias("kind"), "seg", "audit", none.cast("string").alias("text"), none.cast("long").alias("n"), *_SUMMARY)
    said = rows.filter("n > 0").select(
        "conv_id", "turn", "role", F.substring("text", 1, 64).alias("head"), F.sha2("text", 256).alias("digest"), F.lit(1).alias("kind"),
        F.lit(0).cast("long").alias("seg"), none.cast("string").alias("audit"), "text", "n", *[none.cast("long").alias(c) for c in _SUMMARY])
    stream = plans.unionByName(said).repartition("conv_id").sortWithinPartitions(*order, "kind", "seg")
    struct, arrow = _arrow(rows, "step long, edit string, role string, text string, " + ", ".join(f"{c} long" for c in _SUMMARY))
    return stream.select("conv_id", "kind", "audit", "role", "text", "n", *_SUMMARY).mapInArrow(_repaired(arrow), struct)


def digests(repaired: DataFrame) -> DataFrame:
    """A row per conversation of ``repair``: counts, cost, ``audit`` and ``repaired_sha256``.

    The digest is of the repaired ``role:text`` lines, which a hash takes one after the other.
    """
    struct, arrow = _arrow(repaired, ", ".join(f"{c} long" for c in _SUMMARY) + ", audit string, repaired_sha256 string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, letters, digest, first, out = None, [], None, True, []

        def closed() -> tuple:
            return (*head, "".join(letters), digest.hexdigest())

        for batch in batches:
            for conv, step, edit, role, text, *summary in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                if step == 0:
                    if head is not None:
                        out.append(closed())
                    head, letters, digest, first = (conv, *summary), [], hashlib.sha256(), True
                    if len(out) >= 256:
                        yield _batch(out, arrow)
                        out = []
                    continue
                letters.append(edit)
                if edit != "D":
                    digest.update((("" if first else "\n") + f"{role}:{text}").encode("utf-8"))
                    first = False
        if head is not None:
            out.append(closed())
        if out:
            yield _batch(out, arrow)

    return repaired.mapInArrow(run, struct)
