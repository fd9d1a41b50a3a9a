"""Byte-level BPE: encoding with token offsets, and decoding, both over whole arrays.

Pre-tokens are found without a regular expression.  Every code point has a class (one array
lookup); class and the next two code points give one of few symbols; a symbol is a function
from state to state.  These functions are closed under composition, so one small integer stands
for each and a table composes two.  Composition is associative: a prefix scan over blocks
gives the state before every code point of many texts at once, and the state says where a
pre-token starts.  The slices between starts go through cached pair merging.

Token numbers and the byte offsets at which tokens start are kept packed (little-endian
unsigned 32-bit integers), so hashing and length are plain column functions, and decoding
copies vocabulary bytes to the kept offsets.

Null and empty texts have no tokens.  Very long texts are scanned in windows that hand the
state on.  Repeated rows are encoded alike, an empty table gives an empty table, and result
columns replace input columns of the same name.
"""

from __future__ import annotations

import base64
import heapq
import os
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklab.llm.common import free_name

# The broadcast tables are a few times the size of the rank file.
MAX_FILE_BYTES = 64 << 20
# Code points scanned at a time, and columns of the scan's first level.
WINDOW, WIDTH = 1 << 19, 64
# Encoded slices that a worker remembers, and the longest it does.
MEMO_ENTRIES, MEMO_CHARS = 200_000, 64
# Tokens decoded at a time, and code points of the texts whose results leave a task together.
DECODED, RESULT_CHARS = 1 << 17, 1 << 21
# Slices of at most so many bytes are scanned for their best pair; ``NONE`` ranks after all.
SCAN_BYTES, NONE = 40, 1 << 60

# Classes of code points; an apostrophe is told from other marks by its code point.
LETTER, NUMBER, BLANK, SPACE, OTHER = range(5)
# Symbols: an apostrophe may begin a contraction of one or two letters, and a white space may
# be the last one before other text.
_L, _N, _O, _Q1, _Q2, _WS, _BLANK_LAST, _SPACE_LAST = range(8)
_SYMBOLS = 8
# States: what the code points before belong to.
_FRESH, _LETTERS, _NUMBERS, _MARKS, _RUN, _GLUED, _ONE_MORE, _TWO_MORE = range(8)
_STATES = 8
# Tails of contractions.
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """State after a symbol, and whether a pre-token starts at it."""
    if symbol == _L and state in (_ONE_MORE, _TWO_MORE):
        return (_FRESH if state == _ONE_MORE else _ONE_MORE), False
    if symbol in (_L, _N, _O):
        own = {_L: _LETTERS, _N: _NUMBERS, _O: _MARKS}[symbol]
        return own, state not in (own, _GLUED)
    if symbol in (_Q1, _Q2):
        if state in (_MARKS, _GLUED):
            return _MARKS, False
        return (_ONE_MORE if symbol == _Q1 else _TWO_MORE), True
    if symbol == _WS:
        return _RUN, state != _RUN
    return (_GLUED if symbol == _BLANK_LAST else _FRESH), True


class Scan(NamedTuple):
    """The transition functions as numbers: of symbols, composed, applied, and the start flags."""

    of_symbol: np.ndarray   # symbol (+ _SYMBOLS at the start of a text) -> function
    compose: np.ndarray     # flat table: first function * n + second function -> function
    apply: np.ndarray       # function, state -> state
    starts: np.ndarray      # state, symbol -> does a pre-token start
    count: int


def scan_tables() -> Scan:
    """All functions that the symbols generate, and their composition table."""
    step = [tuple(_step(s, x)[0] for s in range(_STATES)) for x in range(_SYMBOLS)]
    step += [(f[_FRESH],) * _STATES for f in step]
    number = {tuple(range(_STATES)): 0}
    for f in step:
        number.setdefault(f, len(number))
    functions = list(number)
    for f in functions:  # grows while it is walked
        for g in step:
            h = tuple(g[s] for s in f)
            if h not in number:
                number[h] = len(number)
                functions.append(h)
    n = len(functions)
    compose = np.empty((n, n), np.uint16)
    for i, f in enumerate(functions):
        for j, g in enumerate(functions):
            compose[i, j] = number[tuple(g[s] for s in f)]
    starts = np.array([[_step(s, x)[1] for x in range(_SYMBOLS)] for s in range(_STATES)])
    return Scan(np.array([number[f] for f in step], np.uint16), compose.ravel(),
                np.array(functions, np.uint8), starts, n)


def prefixes(functions: np.ndarray, scan: Scan) -> np.ndarray:
    """Exclusive prefix compositions of an array of functions, by blocks of ``WIDTH``."""
    n = len(functions)
    if n <= WIDTH:
        out, f, table, m = np.empty(n, np.uint16), 0, scan.compose, scan.count
        for i, g in enumerate(functions.tolist()):
            out[i] = f
            f = table[f * m + g]
        return out
    rows = -(-n // WIDTH)
    grid = np.zeros(rows * WIDTH, np.uint16)
    grid[:n] = functions
    grid = np.ascontiguousarray(grid.reshape(rows, WIDTH).T)
    inside = np.empty((WIDTH + 1, rows), np.uint16)
    inside[0] = 0
    for j in range(WIDTH):
        inside[j + 1] = scan.compose[inside[j].astype(np.int32) * scan.count + grid[j]]
    before = prefixes(inside[WIDTH], scan).astype(np.int32) * scan.count
    return scan.compose[before + inside[:WIDTH]].T.ravel()[:n]


class Tables(NamedTuple):
    """What encoding and decoding need: classes, ranks, vocabulary bytes, scan functions."""

    classes: np.ndarray     # code point -> class
    ranks: dict[bytes, int]
    blob: np.ndarray        # bytes of all tokens in a row
    begin: np.ndarray       # token -> its first byte in ``blob``
    length: np.ndarray      # token -> its number of bytes
    scan: Scan


def class_table() -> np.ndarray:
    """Class of every code point, as the library's own character classes have it.

    The library's tables of letters and numbers are of one Unicode version, so they are asked
    for here, once on the driver: every code point that a class matches comes back as bytes.
    """
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = {bytes([b]): b for b in range(256)}
    table = np.full(0x110000, OTHER, np.uint8)
    for pattern, cls in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACE)):
        probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        found = bytes(probe.encode_ordinary(every)).decode("utf-8")
        table[np.frombuffer(found.encode("utf-32-le"), "<u4")] = cls
    table[ord(" ")] = BLANK
    return table


def load(path: str) -> Tables:
    """Tables of a rank file: a base64 token and its rank on every line."""
    if os.path.getsize(path) > MAX_FILE_BYTES:
        raise ValueError(f"{path} is larger than {MAX_FILE_BYTES} bytes")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    if missing := [b for b in range(256) if bytes([b]) not in ranks]:
        raise ValueError(f"no rank for the bytes {missing[:5]}")
    length = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        length[rank] = len(token)
    begin = np.cumsum(length) - length
    blob = np.zeros(int(length.sum()), np.uint8)
    for token, rank in ranks.items():
        blob[begin[rank]:begin[rank] + len(token)] = np.frombuffer(token, np.uint8)
    return Tables(class_table(), ranks, blob, begin, length, scan_tables())


def symbols(codes: np.ndarray, last: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Symbol of every code point; ``last`` marks the final code points of texts."""
    cls = classes[codes]
    out = np.array([_L, _N, _WS, _WS, _O], np.uint8)[cls]
    white = (cls == BLANK) | (cls == SPACE)
    text_next = np.zeros(len(codes), bool)
    text_next[:-1] = ~white[1:] & ~last[:-1]
    ends_run = white & text_next
    out[ends_run & (cls == BLANK)] = _BLANK_LAST
    out[ends_run & (cls == SPACE)] = _SPACE_LAST
    marks = np.flatnonzero((codes == ord("'")) & ~last)
    if len(marks):
        padded = np.append(codes, [0, 0])
        one, two = padded[marks + 1], padded[marks + 2]
        out[marks[np.isin(one, [ord(c) for c in ONE_LETTER])]] = _Q1
        pair = np.zeros(len(marks), bool)
        for a, b in TWO_LETTERS:
            pair |= (one == ord(a)) & (two == ord(b))
        out[marks[pair & ~np.append(last, True)[marks + 1]]] = _Q2
    return out


def merge_pairs(data: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Tokens of one slice: the adjacent pair of lowest rank, leftmost first, is merged until
    none has a rank.  Short slices are scanned for the best pair; a heap over a linked list of
    parts keeps long ones near linear."""
    if (whole := ranks.get(data)) is not None:
        return [whole]
    n = len(data)
    if n <= SCAN_BYTES:
        get, cuts = ranks.get, list(range(n + 1))
        found = [get(data[i:i + 2], NONE) for i in range(n - 1)]
        while found and (best := min(found)) < NONE:
            i = found.index(best)
            del cuts[i + 1], found[i]
            if i:
                found[i - 1] = get(data[cuts[i - 1]:cuts[i + 1]], NONE)
            if i < len(found):
                found[i] = get(data[cuts[i]:cuts[i + 2]], NONE)
        return [ranks[data[a:b]] for a, b in zip(cuts, cuts[1:])]
    end, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap = []
    for i in range(n - 1):
        if (rank := ranks.get(data[i:i + 2])) is not None:
            heap.append((rank, i, i + 2))
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i]
        if not alive[i] or j >= n or end[j] != stop:
            continue  # one of the two has been merged since
        alive[j], end[i] = False, stop
        if stop < n:
            before[stop] = i
            if (rank := ranks.get(data[i:end[stop]])) is not None:
                heapq.heappush(heap, (rank, i, end[stop]))
        if (h := before[i]) >= 0 and (rank := ranks.get(data[h:stop])) is not None:
            heapq.heappush(heap, (rank, h, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[data[i:end[i]]])
        i = end[i]
    return out


class Encoder:
    """Texts -> packed token numbers, with a bounded memory of encoded slices."""

    def __init__(self, tables: Tables):
        self.tables, self.memo = tables, {}

    def _packed(self, piece: str) -> bytes:
        if (found := self.memo.get(piece)) is None:
            found = np.array(merge_pairs(piece.encode("utf-8"), self.tables.ranks), "<u4").tobytes()
            if len(piece) <= MEMO_CHARS:
                if len(self.memo) >= MEMO_ENTRIES:
                    self.memo.clear()
                self.memo[piece] = found
        return found

    def _starts(self, codes: np.ndarray, first: np.ndarray, last: np.ndarray, state: int, keep: int) -> tuple[np.ndarray, int]:
        """Positions below ``keep`` at which pre-tokens start, and the state at ``keep``."""
        scan = self.tables.scan
        symbol = symbols(codes, last, self.tables.classes)
        function = scan.of_symbol[symbol + np.where(first, _SYMBOLS, 0)]
        states = scan.apply[prefixes(function, scan), state]
        states[first] = _FRESH
        after = int(scan.apply[function[keep - 1], states[keep - 1]])
        return np.flatnonzero(scan.starts[states, symbol][:keep]), after

    def _group(self, texts: list[str]) -> list[bytes]:
        """Packed tokens of non-empty texts that fit one window together."""
        joined = "".join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        ends = np.cumsum([len(t) for t in texts])
        first, last = np.zeros(len(codes), bool), np.zeros(len(codes), bool)
        first[0], first[ends[:-1]], last[ends - 1] = True, True, True
        starts, _ = self._starts(codes, first, last, _FRESH, len(codes))
        cuts = [*starts.tolist(), len(codes)]
        get, packed = self.memo.get, self._packed
        pieces = [get(p := joined[a:b]) or packed(p) for a, b in zip(cuts, cuts[1:])]
        bounds = [0, *np.searchsorted(starts, ends).tolist()]
        return [b"".join(pieces[a:b]) for a, b in zip(bounds, bounds[1:])]

    def _long(self, text: str) -> bytes:
        """Packed tokens of a text longer than a window."""
        out, state, open_at = [], _FRESH, 0
        for at in range(0, len(text), WINDOW):
            keep = min(WINDOW, len(text) - at)
            codes = np.frombuffer(text[at:at + keep + 2].encode("utf-32-le"), "<u4")
            first, last = np.zeros(len(codes), bool), np.zeros(len(codes), bool)
            first[0], last[-1] = at == 0, at + len(codes) == len(text)
            starts, state = self._starts(codes, first, last, state, keep)
            cuts = (starts + at).tolist()
            for cut in cuts[1:] if at == 0 else cuts:
                out.append(self._packed(text[open_at:cut]))
                open_at = cut
        out.append(self._packed(text[open_at:]))
        return b"".join(out)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed tokens of every text, in order."""
        out: list[bytes] = [b""] * len(texts)
        group: list[int] = []
        size = 0

        def flush() -> None:
            for i, found in zip(group, self._group([texts[i] for i in group])) if group else ():
                out[i] = found

        for i, text in enumerate(texts):
            if len(text) > WINDOW:
                out[i] = self._long(text)
            elif text:
                if size + len(text) > WINDOW:
                    flush()
                    group, size = [], 0
                group.append(i)
                size += len(text)
        flush()
        return out


def offsets(packed: bytes, tables: Tables) -> bytes:
    """Packed byte offsets at which the tokens start."""
    lengths = tables.length[np.frombuffer(packed, "<u4")]
    return (np.cumsum(lengths) - lengths).astype("<u4").tobytes()


def decode_tokens(packed: bytes, starts: bytes, tables: Tables) -> bytes:
    """Bytes of packed tokens, every token copied to its kept offset."""
    ids, at = np.frombuffer(packed, "<u4"), np.frombuffer(starts, "<u4").astype(np.int64)
    if not len(ids):
        return b""
    out = np.empty(int(at[-1] + tables.length[ids[-1]]), np.uint8)
    for i in range(0, len(ids), DECODED):
        some, to = ids[i:i + DECODED], at[i:i + DECODED]
        lengths = tables.length[some]
        low, high = int(to[0]), int(to[-1] + lengths[-1])
        out[low:high] = tables.blob[np.repeat(tables.begin[some] - to, lengths) + np.arange(low, high)]
    return out.tobytes()


def decode_span(packed: bytes, starts: bytes, begin: int, end: int, tables: Tables) -> bytes:
    """Bytes ``begin`` to ``end`` of the text, decoding only the tokens that touch them."""
    at = np.frombuffer(starts, "<u4")
    if end <= begin or not len(at):
        return b""
    a, b = max(int(np.searchsorted(at, begin, "right")) - 1, 0), int(np.searchsorted(at, end, "left"))
    low = int(at[a])
    part = decode_tokens(packed[4 * a:4 * b], (at[a:b] - low).astype("<u4").tobytes(), tables)
    return part[begin - low:end - low]


def _tables(values: tuple) -> Tables:
    return Tables(*values[:-1], Scan(*values[-1]))


def portions(texts: list[str]) -> Iterator[list[str]]:
    """Consecutive texts of about ``RESULT_CHARS`` code points, one text at least."""
    part: list[str] = []
    size = 0
    for text in texts:
        if part and size + len(text) > RESULT_CHARS:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def encode_column(spark, text: Column, tables: Tables, with_decoded: bool = False) -> Column:
    """Struct of packed ``ids`` and ``offsets`` of a text, and what they decode to if asked for.

    Results leave in small batches, so that memory is bounded by the input's.
    """
    shared = spark.sparkContext.broadcast((*tables[:-1], tuple(tables.scan)))  # plain values: tasks bring the classes

    @F.pandas_udf("ids binary, offsets binary" + (", decoded binary" if with_decoded else ""))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = _tables(shared.value)
        encoder = Encoder(known)
        for batch in batches:
            for part in portions(batch.tolist()):
                ids = encoder.encode(part)
                out = {"ids": ids, "offsets": [offsets(p, known) for p in ids]}
                if with_decoded:
                    out["decoded"] = [decode_tokens(p, o, known) for p, o in zip(ids, out["offsets"])]
                yield pd.DataFrame(out, dtype=object)

    return encode(F.coalesce(text, F.lit("")))


def decode_column(spark, ids: Column, starts: Column, tables: Tables) -> Column:
    """Bytes of packed token numbers and offsets; null where either is null."""
    shared = spark.sparkContext.broadcast((*tables[:-1], tuple(tables.scan)))

    @F.pandas_udf("binary")
    def decode(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for some, at in batches:
            yield pd.Series([None if p is None or o is None else decode_tokens(p, o, _tables(shared.value))
                             for p, o in zip(some, at)], dtype=object)

    return decode(ids, starts)


def encode(df: DataFrame, tables: Tables, text: str = "text", decoded: str | None = None) -> DataFrame:
    """``df`` with packed ``ids`` and ``offsets`` and with ``n_tokens`` (replaced where they exist).

    ``decoded`` names a further column: the bytes that the numbers decode to, in the same pass.
    """
    new = {"ids", "offsets", "n_tokens", (decoded or "ids").lower()}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in new]
    coded = free_name(df, "coded")
    out = df.select(*kept, encode_column(df.sparkSession, F.col(f"`{text}`"), tables, decoded is not None).alias(coded))
    more = [F.col(f"{coded}.decoded").alias(decoded)] if decoded else []
    return out.select(*kept, F.col(f"{coded}.ids").alias("ids"), F.col(f"{coded}.offsets").alias("offsets"),
                      F.floor(F.octet_length(f"{coded}.ids") / 4).cast("long").alias("n_tokens"), *more)


def decode(df: DataFrame, tables: Tables, name: str = "decoded") -> DataFrame:
    """``df`` with the bytes of its packed ``ids`` as binary column ``name`` (replaced where it exists)."""
    return df.withColumn(name, decode_column(df.sparkSession, F.col("ids"), F.col("offsets"), tables))
