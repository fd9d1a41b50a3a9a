"""Benchmark decontamination by pigeonhole pieces and bit-parallel edit distance.

A test item with an error budget of k is cut into k + 1 pieces: a passage within k edits of
the item holds at least one piece unchanged.  One automaton finds all pieces of all items in
a text.  Around a hit, Myers' bit-parallel distance verifies the enclosing groups of pieces,
each with one error less than it has pieces, up to the whole item: if a group is within its
budget, one of its halves is within its own, so no passage is missed and chance hits end
after a few characters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Edits allowed per character of a normalised item.
ERROR_RATE = 0.08
# Characters of items that one pass broadcasts; larger benchmarks take several passes.
BLOCK_CHARS = 8_000_000

_WORDS = re.compile(r"[^\W_]+")
MATCH = "item_id long, n_errors int, start long, stop long"


def normal(text: str) -> str:
    """Lower-case words, one blank between them; marks and white space go."""
    return " ".join(_WORDS.findall(text.lower()))


def origins(text: str) -> list[int]:
    """For each character of ``normal(text)`` its position in the text."""
    low, where = [], []
    for i, c in enumerate(text):
        for x in c.lower():
            low.append(x)
            where.append(i)
    out = []
    for m in _WORDS.finditer("".join(low)):
        if out:
            out.append(where[m.start()])  # the blank
        out.extend(where[m.start():m.end()])
    return out


def masks(pattern: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


def best_match(eq: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """Least edits of a pattern of ``m`` characters against any part of ``text``, and where it first ends."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for i, c in enumerate(text, 1):
        e = eq.get(c, 0)
        v = e | minus
        h = (((e & plus) + plus) ^ plus) | e
        up, down = minus | (full & ~(h | plus)), plus & h
        if up & top:
            score += 1
        elif down & top:
            score -= 1
            if score < best:
                best, end = score, i
        up, down = (up << 1) & full, (down << 1) & full
        plus, minus = down | (full & ~(v | up)), up & v
    return best, end


class Matcher:
    """Finds passages of texts within the budget of an item."""

    def __init__(self, items: list[tuple[int, str]], rate: float = ERROR_RATE):
        self.items = []
        pieces: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            body = normal(text or "")
            if not body:
                continue
            k = int(rate * len(body))
            cuts = [len(body) * j // (k + 1) for j in range(k + 2)]
            for j in range(k + 1):
                pieces.setdefault(body[cuts[j]:cuts[j + 1]], []).append((len(self.items), j))
            self.items.append((item_id, body, cuts))
        self.auto = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.auto.add_word(piece, (len(piece), places))
        if pieces:
            self.auto.make_automaton()
        self.groups: dict[tuple[int, int, int], dict[str, int]] = {}

    def _climb(self, number: int, j: int, at: int, text: str) -> tuple[int, int] | None:
        """Edits and end of a passage around piece ``j``, found at ``at``; None if a group fails."""
        _, body, cuts = self.items[number]
        path, lo, hi = [], 0, len(cuts) - 1
        while hi - lo > 1:
            path.append((lo, hi))
            mid = (lo + hi) // 2
            lo, hi = (lo, mid) if j < mid else (mid, hi)
        edits, stop = 0, at + cuts[j + 1] - cuts[j]
        for lo, hi in reversed(path):
            budget, a, b = hi - lo - 1, cuts[lo], cuts[hi]
            first = max(0, at - (cuts[j] - a) - budget)
            window = text[first:at + (b - cuts[j]) + budget]
            if (eq := self.groups.get((number, lo, hi))) is None:
                eq = self.groups[number, lo, hi] = masks(body[a:b])
            edits, end = best_match(eq, b - a, window)
            if edits > budget:
                return None
            stop = first + end
        return edits, stop

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item_id, edits, start, stop) of the best passage of each item, in characters of the text."""
        body = normal(text)
        if not body or not self.items:
            return []
        best: dict[int, tuple[int, int]] = {}
        seen: dict[int, list[int]] = {}
        for last, (size, places) in self.auto.iter(body):
            at = last + 1 - size
            for number, j in places:
                cuts = self.items[number][2]
                line, k = at - cuts[j], len(cuts) - 2
                near = seen.get(number)
                if near is not None and any(abs(line - x) <= k for x in near[-4:]):
                    continue  # inside a passage already verified
                found = self._climb(number, j, at, body)
                if found:
                    seen.setdefault(number, []).append(line)
                    if number not in best or found < best[number]:
                        best[number] = found
        if not best:
            return []
        where, out = origins(text), []
        for number, (edits, stop) in sorted(best.items()):
            item_id, pattern, _ = self.items[number]
            back = body[max(0, stop - len(pattern) - edits):stop][::-1]
            _, length = best_match(masks(pattern[::-1]), len(pattern), back)
            start = stop - length
            out.append((item_id, edits, where[start], where[stop - 1] + 1))
        return out


def _blocks(items: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[int, str]]]:
    """The items in groups of a bounded number of characters, each small enough to broadcast."""
    rows = items.select(F.col(item_id).cast("long"), F.col(text)).filter(F.col(text).isNotNull())
    held, size = [], 0
    for row in rows.toLocalIterator():
        held.append((row[0], row[1]))
        size += len(row[1])
        if size >= BLOCK_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def matches(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
            item_id: str = "item_id", item_text: str = "text", rate: float = ERROR_RATE) -> DataFrame:
    """(doc_id, item_id, n_errors, start, stop): the best passage of each item in each document.

    The items are the stated query set; they go to the tasks in blocks of bounded size, and
    the documents are scanned once per block, whole and without a shuffle.  Null or empty
    texts and items match nothing; repeated documents and items each report their matches.
    ``start`` and ``stop`` count characters of the document's text.
    """
    id_type = docs.schema[doc_id].dataType
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter(F.col("text").isNotNull())
    schema = f"doc_id {id_type.simpleString()}, {MATCH}"
    out = None
    for block in _blocks(items, item_id, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value, rate)
            for batch in batches:
                rows, texts = [], batch.column(1)
                for n in range(batch.num_rows):
                    rows.extend((n, *m) for m in matcher.find(texts[n].as_py()))
                if rows:
                    n, item, errors, start, stop = zip(*rows)
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).take(pa.array(n, pa.int64())), pa.array(item, pa.int64()),
                        pa.array(errors, pa.int32()), pa.array(start, pa.int64()), pa.array(stop, pa.int64()),
                    ], names=["doc_id", "item_id", "n_errors", "start", "stop"])

        part = base.mapInArrow(scan, schema)
        out = part if out is None else out.unionAll(part)
    if out is None:
        out = docs.sparkSession.createDataFrame([], schema)
    return out


def decontaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   item_id: str = "item_id", item_text: str = "text", rate: float = ERROR_RATE) -> DataFrame:
    """Rows of ``docs`` in whose text no item is found; every column stays as it is.

    Each row is judged by its own text, so nothing is joined back: null ids, repeated rows
    and null texts (kept) need no care.
    """
    kept = docs
    for block in _blocks(items, item_id, item_text):
        clean = _clean(docs.sparkSession.sparkContext.broadcast(block), rate)
        kept = kept.filter(clean(F.coalesce(F.col(text), F.lit(""))))
    return kept


def _clean(shared, rate: float):
    """A function text -> whether no item of the broadcast block is in it."""

    @F.arrow_udf("boolean")
    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = Matcher(shared.value, rate)
        for batch in batches:
            yield pa.array([not matcher.find(t) for t in batch.to_pylist()], pa.bool_())

    return clean
