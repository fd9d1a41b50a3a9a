"""Token counts of a byte-level BPE tokenizer by the whole-token shortcut.

Offline, the driver proves for each vocabulary string that its merges end in one token.  A
pre-token among the proven strings then counts 1 by a set lookup; only the others are merged.
"""

from __future__ import annotations

import heapq
import json
import os
from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The pre-token pattern of byte-level BPE, as the tokenizer file's
# ``ByteLevel`` pre-tokenizer defines it.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# The broadcast tables are a few times the size of the tokenizer's file.
MAX_FILE_BYTES = 64 << 20
# Merged pre-tokens that a worker remembers, and the longest it does.
MEMO_ENTRIES, MEMO_CHARS = 200_000, 64
# Words of at most so many bytes are scanned; ``NONE`` ranks after every merge.
SCAN_BYTES, NONE = 32, (1 << 60, -1)
# Pre-tokens of one text that are held at a time.
CHUNK = 100_000


class Tables(NamedTuple):
    """What counting needs of a tokenizer: merges by token numbers, proven strings, specials."""

    byte_ids: list[int]
    merges: dict[tuple[int, int], tuple[int, int]]
    whole: frozenset[str]
    specials: tuple[str, ...]


def byte_chars() -> dict[int, str]:
    """Byte -> its character in the vocabulary: printable bytes stand for themselves."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in printable}
    for b in range(256):
        if b not in out:
            out[b] = chr(0x100 + len(out) - len(printable))
    return out


def merged_length(data: bytes, byte_ids: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> int:
    """Tokens left when the pair of lowest rank, leftmost first, is merged until none is known.

    Short words are scanned for their best pair; longer ones keep a heap of pairs over a
    linked list, near linear in the length.
    """
    ids = [byte_ids[b] for b in data]
    n = len(ids)
    if n <= SCAN_BYTES:
        get = merges.get
        found = [get(pair, NONE) for pair in zip(ids, ids[1:])]
        while found and (best := min(found))[1] >= 0:
            i = found.index(best)
            ids[i:i + 2] = [best[1]]
            del found[i]
            if i:
                found[i - 1] = get((ids[i - 1], ids[i]), NONE)
            if i < len(found):
                found[i] = get((ids[i], ids[i + 1]), NONE)
        return len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        if (found := merges.get((ids[i], ids[i + 1]))) is not None:
            heap.append((found[0], i, found[1], ids[i], ids[i + 1]))
    heapq.heapify(heap)
    left = n
    while heap:
        _, i, new, a, b = heapq.heappop(heap)
        j = after[i]
        if ids[i] != a or j >= n or ids[j] != b:
            continue
        ids[i], ids[j] = new, -1
        after[i] = k = after[j]
        left -= 1
        if k < n:
            before[k] = i
            if (found := merges.get((new, ids[k]))) is not None:
                heapq.heappush(heap, (found[0], i, found[1], new, ids[k]))
        h = before[i]
        if h >= 0 and (found := merges.get((ids[h], new))) is not None:
            heapq.heappush(heap, (found[0], h, found[1], ids[h], new))
    return left


def load(path: str) -> Tables:
    """Tables of a byte-level BPE tokenizer file, with the proven whole tokens."""
    if os.path.getsize(path) > MAX_FILE_BYTES:
        raise ValueError(f"{path} is larger than {MAX_FILE_BYTES} bytes")
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec["pre_tokenizer"] or {}
    if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex") or spec.get("normalizer") or model.get("ignore_merges"):
        raise ValueError("only byte-level BPE without normalizer or prefix space is counted")
    vocab, chars = model["vocab"], byte_chars()
    merges = {}
    for rank, pair in enumerate(model["merges"]):
        a, b = pair.split(" ") if isinstance(pair, str) else pair
        merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
    byte_ids = [vocab[chars[b]] for b in range(256)]
    of_char = {c: b for b, c in chars.items()}
    whole = set()
    for token in vocab:
        data = bytes(of_char[c] for c in token)
        try:
            text = data.decode("utf-8")
        except UnicodeDecodeError:
            continue  # no text is a part of a character
        if merged_length(data, byte_ids, merges) == 1:
            whole.add(text)
    specials = tuple(t["content"] for t in spec.get("added_tokens", ()))
    return Tables(byte_ids, merges, frozenset(whole), specials)


def counter(tables: Tables):
    """A function text -> number of tokens, with a bounded memory of merged pre-tokens."""
    pre_token = regex.compile(PRE_TOKEN)
    special = regex.compile("|".join(regex.escape(s) for s in sorted(tables.specials, key=len, reverse=True))) if tables.specials else None
    whole, memo = tables.whole, {}

    def merged(token: str) -> int:
        if (n := memo.get(token)) is None:
            n = merged_length(token.encode("utf-8"), tables.byte_ids, tables.merges)
            if len(token) <= MEMO_CHARS:
                if len(memo) >= MEMO_ENTRIES:
                    memo.clear()
                memo[token] = n
        return n

    def of_tokens(tokens: list[str]) -> int:
        rest = [t for t in tokens if t not in whole]
        return len(tokens) - len(rest) + sum(map(merged, rest))

    def of_part(part: str) -> int:
        if len(part) <= CHUNK:
            return of_tokens(pre_token.findall(part))
        found, total = (m.group() for m in pre_token.finditer(part)), 0
        while chunk := list(islice(found, CHUNK)):
            total += of_tokens(chunk)
        return total

    def count(text: str | None) -> int:
        if not text:
            return 0
        if special is None:
            return of_part(text)
        parts = special.split(text)
        return len(parts) - 1 + sum(map(of_part, parts))

    return count


def token_count(spark, text: Column, tables: Tables) -> Column:
    """Number of tokens of a text as long; null and empty texts have none."""
    shared = spark.sparkContext.broadcast(tables)

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = counter(shared.value)
        for batch in batches:
            yield pd.Series([count(t) for t in batch], dtype="int64")

    return tokens(F.coalesce(text, F.lit("")))


def count_tokens(df: DataFrame, tables: Tables, text: str = "text", limit: int = 1024) -> DataFrame:
    """``df`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` (replaced where they exist).

    Strings of special tokens inside a text count as one token each, as the library has it by
    default.  A null text counts as empty: 0 bytes, 0 tokens.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in ("n_bytes", "n_tokens", "over_limit")]
    out = df.select(*kept, F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("n_bytes"),
                    token_count(df.sparkSession, F.col(text), tables).alias("n_tokens"))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)

