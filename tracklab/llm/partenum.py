"""N-gram Jaccard join by PartEnum signatures.

Two sets with Jaccard similarity of at least g differ in at most (1 - g) / (1 + g) * (sum of
sizes) elements.  Sizes are cut into bands so narrow that similar sets are in the same or in
neighbouring bands; each band pair has an error budget k.  The element domain is hashed into
n1 partitions of n2 parts.  k differences leave more than as many partitions as the slack,
and one more, with at most k2 of them, and in such a partition the two sets agree on some subset of n2 - k2 parts.  A set's
signatures are its projections on all these subsets, so similar sets share signatures in more
partitions than the slack.

Equal sets are one node from the start.  Nodes that share a signature are joined to clusters
(an edge to the group's first node, never all pairs).  Clusters of more than one block are cut
by the parities of their sets, a bit per element at most two: sets whose parities differ in more places than
similar sets have different elements are not linked, and what stays connected is a smaller cluster.
Inside a cluster the sets are compared exactly, block against block, so that no task holds more than two blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklab.operators.small import checked_broadcast
from tracklab.llm.common import sheltered
from tracklab.sources.staging import stage

U = np.uint64


class Join(NamedTuple):
    """Words per shingle, similarity as a fraction, parts and left-out parts of a partition, and the
    spare partitions: a number and a share of the error budget."""

    words: int = 3
    similar: int = 90
    of: int = 100
    parts: int = 2
    left_out: int = 1
    slack: int = 2
    slack_share: float = 0.06


# Near copies among documents: five words, 80 percent.
# With one part the subsets of a partition are the partition itself.
NEAR = Join(words=5, similar=80, parts=1, left_out=0, slack=3, slack_share=0.15)

# Sets from which the common shingles are taken, and in how many of them a shingle is common.
# They decide only which signatures are weak, never which sets are found.
SAMPLE_SETS, SAMPLE_SHINGLES, COMMON_IN, COMMON_MOST = 4_000, 20_000, 3, 1_000_000
# Nodes of a block; clusters of at most one block are compared whole.
BLOCK = 512
# Sets whose parities are compared in one task, rows and places of a step there, and the fewest places.
PARITY_BLOCK, STRIP, PLACES, LEAST_WIDTH = 4_096, 512, 2_048, 64
# Sets of a large cluster that all its blocks are compared with, about.
HUBS = 64
# Rows of texts or sets that Python gets at a time.
TEXT_ROWS = 1_000
# Sets that a task remembers so as to give the signatures of copies once.
REMEMBERED = 200_000


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixing."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word runs of a text, A-Z in lower case.

    With fewer words the whole sequence is one run; a text without words has none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, U)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), U, len(words))
    width = min(n, len(words))
    runs = np.full(len(words) - width + 1, U(width))
    for i in range(width):
        runs = mixed(runs * U(0x9E3779B97F4A7C15) + h[i:len(words) - width + 1 + i])
    return np.unique(runs)


def fingerprint(elements: np.ndarray) -> int:
    """64-bit hash of a whole set."""
    return xxhash.xxh3_64_intdigest(elements.tobytes(), seed=len(elements)) - (1 << 63)


_EDGES: dict[Join, list[int]] = {}


def band_edges(size: int, join: Join) -> tuple[int, int, int]:
    """(band, its largest size, the next band's largest size)."""
    edges = _EDGES.setdefault(join, [1])
    while edges[-1] < size or len(edges) < 3:
        edges.append(max(edges[-1] + 1, (edges[-1] + 1) * join.of // join.similar))
    while True:
        i = int(np.searchsorted(edges, size))
        if i + 1 < len(edges):
            return i, edges[i], edges[i + 1]
        edges.append(max(edges[-1] + 1, (edges[-1] + 1) * join.of // join.similar))


def budget(largest: int, join: Join) -> int:
    """Most elements in which two similar sets of at most ``largest`` elements differ."""
    return 2 * largest * (join.of - join.similar) // (join.of + join.similar)


def signatures(elements: np.ndarray, join: Join, common: np.ndarray) -> np.ndarray:
    """Signatures of a set for its own band pair and the next: 64-bit numbers.

    A projection is weak if all its elements are in ``common`` (sorted), or it has none.  Weak
    ones are left out unless more partitions than the slack have one.  No pair is lost,
    whatever ``common`` is: similar sets agree in more partitions than the slack, and a
    projection on which they agree is weak for both or for none.
    """
    size = len(elements)
    if not size:
        return np.empty(0, U)
    i, own, above = band_edges(size, join)
    out = []
    outs = list(combinations(range(join.parts), join.left_out))
    key = mixed(elements + U(0x632BE59BD9B4E019))
    value = mixed(elements ^ U(0xD6E8FEB86659FD93))
    if len(common):
        at = np.minimum(np.searchsorted(common, elements), len(common) - 1)
        strong = (common[at] != elements).astype(np.float64)
    else:
        strong = None
    for pair, largest in ((i, own), (i + 1, above)):
        k = budget(largest, join)
        slack = join.slack + int(join.slack_share * k)
        n1 = k // (join.left_out + 1) + 1 + slack if k else 1  # without budget only equal sets match
        cell = ((key >> U(32)) * U(n1) >> U(32)) * U(join.parts) + ((key & U(0xFFFFFFFF)) * U(join.parts) >> U(32))
        cell = cell.astype(np.int64)
        sums = np.zeros(n1 * join.parts, U)
        np.add.at(sums, cell, value)
        counts = np.bincount(cell, strong, n1 * join.parts).reshape(n1, join.parts)
        sums = sums.reshape(n1, join.parts)
        whole, number = sums.sum(axis=1, dtype=U), counts.sum(axis=1)
        content, filled = [], []
        for left in outs:
            content.append(whole - sums[:, left].sum(axis=1, dtype=U))
            filled.append(number - counts[:, left].sum(axis=1) > 0)
        content, filled = np.array(content), np.array(filled)
        salt = mixed((np.arange(content.size, dtype=U) + U(pair << 32)) * U(0x9E3779B97F4A7C15)).reshape(content.shape)
        sig = mixed(content + salt)
        if int((~filled).any(axis=0).sum()) <= slack and k:
            out.append(sig[filled])
        else:
            out.append(sig.ravel())
    return np.unique(np.concatenate(out))


def _nodes(docs: DataFrame, doc_id: str, text: str, join: Join) -> DataFrame:
    """(doc_id, fp, n): fingerprint and size of every document's set; fp is null for empty sets."""
    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, fp long, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp, n = [], []
            for x in batch.column(1):
                elements = shingles(x.as_py(), join.words)
                fp.append(fingerprint(elements) if len(elements) else None)
                n.append(len(elements))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fp, pa.int64()), pa.array(n, pa.int64())], names=["doc_id", "fp", "n"])

    return stage(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema), "join-nodes", TEXT_ROWS)


def _common(docs: DataFrame, doc_id: str, text: str, nodes: DataFrame, join: Join) -> np.ndarray:
    """Shingles of several sets of a bounded sample, sorted."""
    sets = nodes.filter("fp is not null and doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("_d"), F.first("n").alias("n"))
    total = nodes.filter("fp is not null").agg(F.approx_count_distinct("fp")).first()[0]
    if total > SAMPLE_SETS:
        sets = sets.filter(F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < F.lit((1 << 30) * SAMPLE_SETS // total))
    ids = checked_broadcast(sets.filter(F.col("n") <= SAMPLE_SHINGLES).select("_d"), 2 * SAMPLE_SETS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(shingles(x.as_py(), join.words).view(np.int64))], names=["s"])

    picked = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_t")).join(ids, F.col("_id") == F.col("_d"), "left_semi")
    counts = picked.select("_t").mapInArrow(run, "s long").groupBy("s").agg(F.count(F.lit(1)).alias("n"))
    rows = counts.filter(F.col("n") >= COMMON_IN).orderBy(F.desc("n"), "s").limit(COMMON_MOST).select("s").toArrow()
    return np.sort(rows.column("s").to_numpy().view(U)) if rows.num_rows else np.empty(0, U)


def _meetings(docs: DataFrame, text: str, join: Join, common: np.ndarray) -> DataFrame:
    """(a, b): the first node of every signature with each other node that has it, distinct."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        for batch in batches:
            sigs, fps, held = [], [], 0
            for x in batch.column(0):
                elements = shingles(x.as_py(), join.words)
                if not len(elements) or (fp := fingerprint(elements)) in known:
                    continue
                if len(known) >= REMEMBERED:
                    known.clear()
                known.add(fp)
                sigs.append(signatures(elements, join, shared.value))
                fps.append(np.full(len(sigs[-1]), fp, np.int64))
                held += len(sigs[-1])
                if held >= 500_000:
                    yield _batch(["sig", "fp"], np.concatenate(sigs).view(np.int64), np.concatenate(fps))
                    sigs, fps, held = [], [], 0
            if sigs:
                yield _batch(["sig", "fp"], np.concatenate(sigs).view(np.int64), np.concatenate(fps))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted; a group may go on in the next batch, of which only its key and first node are kept.
        last = first = None
        for batch in batches:
            if not batch.num_rows:
                continue
            sig, fp = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            start = np.r_[last is None or sig[0] != last, sig[1:] != sig[:-1]]
            heads = fp[start]
            if first is not None:
                heads = np.r_[first, heads]
                head = heads[np.cumsum(start)]
            else:
                head = heads[np.cumsum(start) - 1]
            last, first = sig[-1], head[-1]
            other = fp != head
            if other.any():
                pairs = np.unique(np.stack([head[other], fp[other]], axis=1), axis=0)
                yield _batch(["a", "b"], pairs[:, 0], pairs[:, 1])

    signed = docs.select(F.col(text).alias("text")).mapInArrow(sign, "sig long, fp long")
    grouped = signed.repartition("sig").sortWithinPartitions("sig", "fp")
    return stage(grouped.mapInArrow(meet, "a long, b long").distinct(), "join-meetings", 4 * TEXT_ROWS)


def _batch(names: list[str], *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node of the edges: equal labels within a connected component.

    Every round joins each node with its least neighbour and keeps the edges between
    different results, until none is left; rounds grow with the logarithm of the longest path.
    """
    edges = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    rounds = []
    while True:
        least = edges.unionAll(edges.select("b", "a")).groupBy("a").agg(F.min("b").alias("m"))
        parent = stage(least.select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "join-parents")
        rounds.append(parent)
        up = parent.select(F.col("node").alias("_n"), F.col("label").alias("_p"))
        edges = edges.join(up, F.col("a") == F.col("_n")).select(F.col("_p").alias("a"), "b")
        edges = edges.join(up, F.col("b") == F.col("_n")).select("a", F.col("_p").alias("b"))
        edges = stage(edges.filter("a <> b").distinct(), "join-edges")
        if edges.isEmpty():
            break
    out = rounds[0]
    for parent in rounds[1:]:
        up = parent.select(F.col("node").alias("_n"), F.col("label").alias("_p"))
        out = out.join(up, F.col("label") == F.col("_n"), "left").select("node", F.coalesce("_p", "label").alias("label"))
    return stage(out, "join-components")


def links_of(sets: list[np.ndarray], left: np.ndarray, join: Join) -> Iterator[tuple[int, int]]:
    """Similar pairs of the sets with at least one in ``left`` (a mask), fewer where others connect them.

    A pair whose sets are already connected by pairs given before is left out.
    """
    m = len(sets)
    group = list(range(m))

    def root(i: int) -> int:
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(m), sizes)
    _, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[place] > 1
    place, owner = place[shared], owner[shared]
    _, place = np.unique(place, return_inverse=True)
    width = int(place.max()) + 1 if len(place) else 0
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    rows = np.flatnonzero(left)
    both = np.zeros((len(rows), m), np.float32)
    step = max(1, (16 << 20) // (4 * m))
    for start in range(0, width, step):
        lo, hi = np.searchsorted(place, [start, start + step])
        x = np.zeros((m, min(step, width - start)), np.float32)
        x[owner[lo:hi], place[lo:hi] - start] = 1
        both += x[rows] @ x.T
    inside = both.astype(np.int64)
    total = sizes[rows][:, None] + sizes[None, :] - inside
    similar = join.of * inside >= join.similar * total
    for i, j in zip(*np.nonzero(similar)):
        a = int(rows[i])
        ra, rb = root(a), root(int(j))
        if ra != rb:
            group[max(ra, rb)] = min(ra, rb)
            yield a, int(j)


def _compare(cells: DataFrame, join: Join) -> DataFrame:
    """(a, b) links inside cells; rows (cell, side, fp, elements), side 0 is compared with all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3))

        for _, members in groupby(rows(), key=lambda r: r[0]):
            # Rows of one set, from repeated ids, follow each other.
            members = [next(same) for _, same in groupby(members, key=lambda r: r[1:3])]
            members = [(side, fp, np.frombuffer(e.as_py(), U)) for _, side, fp, e in members]
            if len(members) < 2:
                continue
            fps = [fp for _, fp, _ in members]
            found = list(links_of([e for *_, e in members], np.array([s == 0 for s, *_ in members]), join))
            if found:
                yield _batch(["a", "b"], np.array([fps[i] for i, _ in found]), np.array([fps[j] for _, j in found]))

    grouped = cells.select("cell", "side", "fp", "elements").repartition("cell").sortWithinPartitions("cell", "side", "fp")
    return grouped.mapInArrow(run, "a long, b long")


def _full() -> float:
    """Nodes that a block of a large group has on average."""
    return BLOCK * 0.75


def _block(fp, n):
    """Number of a node's block in a group of ``n`` nodes."""
    return F.pmod(F.xxhash64(fp), F.greatest(F.ceil(n / _full()), F.lit(1)))


def parity(elements: np.ndarray, width: int) -> np.ndarray:
    """Parity of the elements dealt to each of ``width`` places (a power of two), eight to a byte.

    Sets whose parities differ in d places differ in d elements at least.  Halves of the bytes, one
    flipped by the other, are the parity of half the width.
    """
    place = (mixed(elements + U(0xA0761D6478BD642F)) & U(width - 1)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=width) & 1).astype(np.uint8))


def parities(elements: np.ndarray, join: Join) -> Iterator[tuple[int, bool, np.ndarray]]:
    """(width, own, parity): by the power of two not below the size, and by its halves if sets that small may be similar."""
    n = len(elements)
    width = max(LEAST_WIDTH, 1 << (n - 1).bit_length())
    bits = parity(elements, width)
    yield width, True, bits
    while width > LEAST_WIDTH and join.similar * n <= join.of * (width // 2):
        width, bits = width // 2, bits[:len(bits) // 2] ^ bits[len(bits) // 2:]
        yield width, False, bits


def _signs(bits: np.ndarray, lo: int, hi: int) -> np.ndarray:
    return np.unpackbits(bits[:, lo // 8:hi // 8], axis=1).astype(np.float32) * 2 - 1


def connected(left: tuple[np.ndarray, ...], right: tuple[np.ndarray, ...], join: Join) -> Iterator[tuple[int, int]]:
    """Pairs of a set of ``left`` and one of ``right`` that may be similar, fewer where others connect them.

    Sides are (n, own, parities); of two that are not in their own width nothing is said.  Pairs number the
    sets of both sides through, and at most as many are given as there are sets.
    """
    (n_left, own_left, bits_left), (n, own, bits) = left, right
    m, width = len(n_left), 8 * bits.shape[1]
    group = np.arange(m + len(n))
    whole = _signs(bits, 0, width) if width <= PLACES else None
    for start in range(0, m, STRIP):
        some = slice(start, start + STRIP)
        product = np.zeros((len(n_left[some]), len(n)), np.float32)
        for lo in range(0, width, PLACES):
            hi = min(lo + PLACES, width)
            product += _signs(bits_left[some], lo, hi) @ (whole if whole is not None else _signs(bits, lo, hi)).T
        differ = (width - product.astype(np.int64)) // 2
        a, b = n_left[some][:, None], n[None, :]
        near = (differ * (join.of + join.similar) <= (a + b) * (join.of - join.similar)) & (own_left[some][:, None] | own[None, :])
        near &= join.similar * np.maximum(a, b) <= join.of * np.minimum(a, b)
        for i in np.flatnonzero(near.any(axis=1)):
            mine = start + int(i)
            others = m + np.flatnonzero(near[i])
            known, first = np.unique(group[others], return_index=True)
            fresh = known != group[mine]
            if fresh.any():
                yield from ((mine, int(others[j])) for j in first[fresh])
                group[np.isin(group, known)] = group[mine]


def _refined(sets: DataFrame, join: Join) -> DataFrame:
    """(node, label): ``sets`` of large clusters in smaller ones, within which all similar pairs are; lone sets are left out.

    Sets are compared with those of their cluster and of a similar size only, by parities: an eighth of a byte or a
    quarter per element goes to as many tasks as the sets of a cluster and width have blocks.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(fp, label, len(e), *p) for fp, label, e in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), (np.frombuffer(x.as_py(), U) for x in batch.column(2)))
                for p in parities(e, join)]
            if rows:
                fp, label, n, width, own, bits = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fp, pa.int64()), pa.array(label, pa.int64()), pa.array(n, pa.int64()), pa.array(width, pa.int64()), pa.array(own),
                     pa.array([b.tobytes() for b in bits], pa.binary())], names=["fp", "label", "n", "width", "own", "bits"])

    rows = stage(sets.select("fp", "label", "elements").mapInArrow(
        run, "fp long, label long, n long, width long, own boolean, bits binary"), "join-parities", TEXT_ROWS)
    sizes = rows.groupBy(F.col("label").alias("_l"), F.col("width").alias("_w")).agg(F.ceil(F.count(F.lit(1)) / PARITY_BLOCK).alias("blocks"))
    block = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    cells = rows.join(sizes, (F.col("label") == F.col("_l")) & (F.col("width") == F.col("_w"))).withColumn("block", block).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    cells = cells.select("label", "width", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "fp", "n", "own", "bits")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(*(batch.column(i).to_pylist() for i in range(9)))

        for (_, _, i, j), members in groupby(rows(), key=lambda r: r[:4]):
            members = list(members)
            block, fp, n, own = (np.array([r[c] for r in members]) for c in range(4, 8))
            bits = np.array([np.frombuffer(r[8], np.uint8) for r in members])
            at, to = np.flatnonzero(block == i), np.flatnonzero(block == j)
            if len(at) and len(to):
                found = list(connected((n[at], own[at], bits[at]), (n[to], own[to], bits[to]), join))
                if found:
                    both = np.array(found)
                    names = np.concatenate([fp[at], fp[to]])
                    yield _batch(["a", "b"], names[both[:, 0]], names[both[:, 1]])

    key = ["label", "width", "i", "j"]
    met = cells.repartition(*key).sortWithinPartitions(*key).mapInArrow(compare, "a long, b long").filter("a <> b")
    return components(stage(met, "join-refined", TEXT_ROWS))


def _links(docs: DataFrame, doc_id: str, text: str, nodes: DataFrame, clusters: DataFrame, join: Join) -> DataFrame:
    """Links within clusters: enough of them to connect all similar sets, and only between similar sets."""
    first = nodes.filter("fp is not null").groupBy("fp").agg(F.min("doc_id").alias("_d"))
    members = stage(_sized(clusters).join(first, F.col("node") == F.col("fp")).select("_d", "fp", "label", "size"), "join-members")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # rows of one id come to one task
        for batch in batches:
            keep, data = [], []
            for i, (fp, x) in enumerate(zip(batch.column(0).to_pylist(), batch.column(3))):
                if fp in seen:
                    continue
                elements = shingles(x.as_py(), join.words)
                if len(elements) and fingerprint(elements) == fp:  # another row may have the same id
                    seen.add(fp)
                    keep.append(i)
                    data.append(elements.tobytes())
            if keep:
                rest = batch.select([0, 1, 2]).take(pa.array(keep))
                yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(data, pa.binary())], names=["fp", "label", "size", "elements"])

    texts = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_t")).join(members, F.col("_id") == F.col("_d"))
    sets = texts.select("fp", "label", "size", "_t").mapInArrow(run, "fp long, label long, size long, elements binary")
    if members.filter(F.col("size") > _full()).isEmpty():
        return stage(_compare(_inner(sets), join), "join-links", TEXT_ROWS)
    sets = stage(sets, "join-sets", TEXT_ROWS)
    large = sets.filter(F.col("size") > _full())
    smaller = stage(_sized(_refined(large, join)), "join-smaller")
    large = large.select("fp", "elements").join(smaller, F.col("fp") == F.col("node")).select("fp", "label", "size", "elements")
    sets = sets.filter(F.col("size") <= _full()).unionByName(large)
    if smaller.filter(F.col("size") > _full()).isEmpty():
        return stage(_compare(_inner(sets), join), "join-links", TEXT_ROWS)
    return _links_of_blocks(sets, large.filter(F.col("size") > _full()), join)


def _sized(clusters: DataFrame) -> DataFrame:
    """(node, label, size): the clusters with their sizes."""
    sizes = clusters.groupBy(F.col("label").alias("_l")).agg(F.count(F.lit(1)).alias("size"))
    return clusters.join(sizes, F.col("label") == F.col("_l")).select("node", "label", "size")


def _inner(sets: DataFrame) -> DataFrame:
    return sets.select(
        F.xxhash64("label", _block(F.col("fp"), F.col("size"))).alias("cell"), F.lit(0).alias("side"), "fp", "elements")


def _links_of_blocks(sets: DataFrame, large: DataFrame, join: Join) -> DataFrame:
    """Links within clusters, of which ``large`` have several blocks."""
    large = stage(large.dropDuplicates(["fp"]), "join-large", TEXT_ROWS)
    # Some sets meet all blocks, so that the copies of one text are one component over all of them.
    last = F.greatest(F.ceil(F.col("size") / _full()), F.lit(1)) - 1
    hubs = large.filter(F.pmod(F.xxhash64(F.col("fp"), F.lit("hub")), F.col("size")) < HUBS).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), last))).filter(F.col("block") != _block(F.col("fp"), F.col("size")))
    hubs = hubs.select(F.xxhash64("label", "block").alias("cell"), F.lit(1).alias("side"), "fp", "elements")
    links = stage(_compare(_inner(sets).unionByName(hubs), join), "join-links", TEXT_ROWS)
    # What these links leave outside a cluster's largest component meets all other blocks.
    known = components(links).withColumnRenamed("label", "group")
    state = large.select("fp", "label", "size").join(known, F.col("fp") == F.col("node"), "left").withColumn(
        "group", F.coalesce("group", "fp"))
    most = state.groupBy("label", "group").agg(F.count(F.lit(1)).alias("k")).groupBy(F.col("label").alias("_l")).agg(
        F.max(F.struct("k", "group"))["group"].alias("main"))
    state = stage(state.join(most, F.col("label") == F.col("_l")).withColumn("rest", F.col("group") != F.col("main"))
                  .select("fp", "label", "size", "rest"), "join-state")
    rests = state.filter("rest").groupBy(F.col("label").alias("_l")).agg(F.count(F.lit(1)).alias("n_rest"))
    grown = state.join(rests, F.col("label") == F.col("_l")).select(
        F.col("fp").alias("_f"), "rest", _block(F.col("fp"), F.col("size")).alias("block"),
        _block(F.col("fp"), F.col("n_rest")).alias("rest_block"),
        F.greatest(F.ceil(F.col("size") / _full()), F.lit(1)).alias("blocks"),
        F.greatest(F.ceil(F.col("n_rest") / _full()), F.lit(1)).alias("rest_blocks"))
    both = large.join(grown, F.col("fp") == F.col("_f"))
    left = both.filter("rest").select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("j"), F.col("rest_block").alias("i"),
        "label", F.lit(0).alias("side"), "fp", "elements")
    right = both.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("rest_blocks") - 1)).alias("i"), F.col("block").alias("j"),
        "label", F.lit(1).alias("side"), "fp", "elements")
    outer = left.unionByName(right).withColumn("cell", F.xxhash64("label", "i", "j"))
    return stage(links.unionAll(_compare(outer, join)), "join-links", TEXT_ROWS)


def join_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", join: Join = Join()) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``.

    Rows link when the Jaccard similarity of their shingle sets is at least the join's.
    ``component_id`` is the least id that links lead to, the row's own included.  Texts
    without words have no shingles and link with nothing.  Equal sets are one node, so
    repeated rows and copies cost nothing more.  Rows without an id link with nothing but
    equal sets, and a component of such rows has no id.  Sets are compared by 64-bit hashes
    of their shingles and by nothing shorter.
    """
    nodes = _nodes(docs, doc_id, text, join)
    common = _common(docs, doc_id, text, nodes, join)
    met = _meetings(docs, text, join, common)
    key = F.coalesce(F.col("fp"), F.xxhash64("doc_id"))
    if met.isEmpty():
        named = nodes.withColumn("_key", key)
    else:
        links = _links(docs, doc_id, text, nodes, components(met), join)
        labels = components(links)
        named = nodes.join(labels, F.col("fp") == F.col("node"), "left").withColumn("_key", F.coalesce("label", key))
    named = named.select("doc_id", "n", F.when(F.col("n") > 0, F.col("_key")).alias("_key"))
    # Staged, so that both sides of the join are exchanged and a hot key's rows can be split.
    first = stage(named.filter("_key is not null").groupBy(F.col("_key").alias("_k")).agg(F.min("doc_id").alias("_first")), "join-first")
    out = named.join(first, F.col("_key") == F.col("_k"), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("_first", "doc_id").alias("component_id"))


@sheltered("_leave", "_r")
def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", join: Join = NEAR) -> DataFrame:
    """``docs`` with one document of every component: that with the least id.

    Rows of one id are one document; it leaves if any of its rows links to a smaller id, and
    of repeated rows of a staying id one stays.  Rows without an id and texts without words
    stay.
    """
    found = stage(join_components(docs, doc_id, text, join), "join-result")
    leave = found.filter(F.col("component_id") < F.col("doc_id")).select(F.col("doc_id").alias("_leave")).distinct()
    kept = docs.join(leave, F.col(doc_id) == F.col("_leave"), "left_anti")
    repeated = found.filter("doc_id is not null").groupBy(F.col("doc_id").alias("_r")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("_r")
    if repeated.isEmpty():
        return kept
    once = kept.join(repeated, F.col(doc_id) == F.col("_r"), "left_semi").dropDuplicates([doc_id])
    return kept.join(repeated, F.col(doc_id) == F.col("_r"), "left_anti").unionByName(once)
