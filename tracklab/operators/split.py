"""Exact stratified splits, subsamples and folds (M1-M4).

Every row gets a hash key; a class is ordered by that key and cut at exact ranks.
Only the hash range around each cut is ever sorted.  Once the cut keys are known,
assigning a row is a comparison with its class's cut keys: the table itself is not
shuffled, and the assignment is a pure function of data and seed.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tracklab import schema as S
from tracklab.operators.small import checked_broadcast, literal_table, small_rows
from tracklab.sources.staging import settle, stage

# Leading digits of a key that make its range: a class has at most 16 ** 3 ranges, few enough to be counted in every
# task before the shuffle, and only those at a cut are sorted.
RANGE_DIGITS = 3
BELOW_ALL, ABOVE_ALL = "", "g"  # md5 digits end at 'f'


def hash_key(id_columns: Sequence[str], seed: int = S.SEED) -> Column:
    """md5 of the id columns and the seed; the ids together must be unique."""
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in id_columns], F.lit(str(seed))))


def allocate(seats: int, counts: dict[str, int]) -> dict[str, int]:
    """Proportional seats per class: floors first, the rest by largest remainder, then name."""
    total = sum(counts.values())
    floors = {c: seats * n // total for c, n in counts.items()}
    spare = seats - sum(floors.values())
    order = sorted(counts, key=lambda c: (-(seats * counts[c] % total), c))
    return {c: floors[c] + (1 if c in order[:spare] else 0) for c in counts}


def split_quotas(counts: dict[str, int], test_ratio: float = S.TEST_RATIO,
                 val_ratio: float = S.VAL_RATIO) -> dict[str, tuple[int, int]]:
    """(test rows, validation rows) per class: test first, validation from the rest."""
    total = sum(counts.values())
    test_rows = math.ceil(test_ratio * total)
    test = allocate(test_rows, counts)
    rest = {c: n - test[c] for c, n in counts.items()}
    val_rows = math.ceil(val_ratio / (1 - test_ratio) * (total - test_rows))
    val = allocate(val_rows, rest)
    return {c: (test[c], val[c]) for c in counts}


def _cut_keys(keyed: DataFrame, ranges: DataFrame, cuts: dict[str, list[int]], counts: dict[str, int]) -> dict[str, list[str]]:
    """The hash key at each cut rank (1-based, inclusive) of each class."""
    inner = sorted({(c, r) for c, ranks in cuts.items() for r in ranks if 0 < r < counts[c]})
    keys: dict[tuple[str, int], str] = {}
    if inner:
        label_type = keyed.schema["_label"].dataType.simpleString()
        ranks = F.broadcast(literal_table(keyed.sparkSession, inner, f"_label {label_type}, _rank long"))
        before = W.partitionBy("_label").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
        holding = checked_broadcast(
            ranges.withColumn("_before", F.coalesce(F.sum("_c").over(before), F.lit(0))).join(ranks, "_label")
            .filter((F.col("_rank") > F.col("_before")) & (F.col("_rank") <= F.col("_before") + F.col("_c")))
            .select("_label", "_range", "_rank", "_before")
        )
        in_range = W.partitionBy("_label", "_range", "_rank").orderBy("_key")
        around = (
            keyed.withColumn("_range", _range_of_key()).join(holding, ["_label", "_range"])
            .withColumn("_pos", F.row_number().over(in_range) + F.col("_before"))
            .withColumn("_next", F.lead("_key").over(in_range))
            .filter(F.col("_pos") == F.col("_rank"))
        )
        for row in small_rows(around.select("_label", "_rank", "_key", "_next")):
            if row["_key"] == row["_next"]:
                raise ValueError("id columns are not unique: two rows share the key at a cut")
            keys[(row["_label"], row["_rank"])] = row["_key"]

    def at(c, r):
        return BELOW_ALL if r <= 0 else ABOVE_ALL if r >= counts[c] else keys[(c, r)]

    return {c: [at(c, r) for r in ranks] for c, ranks in cuts.items()}


def _range_of_key() -> Column:
    return F.substring("_key", 1, RANGE_DIGITS)


def cut_keys(df: DataFrame, label: str, id_columns: Sequence[str],
             cuts_of: Callable[[dict[str, int]], dict[str, list[int]]], seed: int = S.SEED,
             reread: bool = False) -> dict[str, list[str]]:
    """The hash keys at the ranks that ``cuts_of`` names for the class sizes.

    Labels and keys are staged, so that ranges, class sizes and cuts read them only; with ``reread``
    they come from ``df`` each time, which is right for a staged table.
    """
    keyed = df.filter(F.col(label).isNotNull()).select(F.col(label).alias("_label"), hash_key(id_columns, seed).alias("_key"))
    if not reread:
        keyed = stage(keyed, "split-keys")
    ranges = settle(keyed.groupBy("_label", _range_of_key().alias("_range")).agg(F.count("*").alias("_c")), "split-ranges")
    counts = {r[0]: r[1] for r in small_rows(ranges.groupBy("_label").agg(F.sum("_c")))}
    return _cut_keys(keyed, ranges, cuts_of(counts), counts)


def assign(df: DataFrame, label: str, id_columns: Sequence[str], cuts: dict[str, list[str]], out: str,
           seed: int = S.SEED) -> DataFrame:
    """Number of cuts strictly before each row in its class's hash order, as column ``out``; map-only.

    Rows with a null label get null.
    """
    label_type = df.schema[label].dataType.simpleString()
    table = F.broadcast(literal_table(
        df.sparkSession, cuts.items(), f"{label} {label_type}, _cuts array<string>"
    ))
    passed = F.aggregate(
        F.col("_cuts"), F.lit(0), lambda n, cut: F.when(F.col("_key") > cut, n + 1).otherwise(n)
    )
    return (
        df.withColumn("_key", hash_key(id_columns, seed))
        .join(table, label, "left")
        .withColumn(out, F.when(F.col("_cuts").isNotNull(), passed))
        .drop("_key", "_cuts")
    )


def assign_by_cuts(df: DataFrame, label: str, id_columns: Sequence[str],
                   cuts_of: Callable[[dict[str, int]], dict[str, list[int]]],
                   out: str, seed: int = S.SEED, reread: bool = False) -> DataFrame:
    """The cuts of ``cut_keys`` assigned as column ``out``."""
    return assign(df, label, id_columns, cut_keys(df, label, id_columns, cuts_of, seed, reread), out, seed)


def split_cuts(df: DataFrame, label: str, id_columns: Sequence[str], test_ratio: float = S.TEST_RATIO,
               val_ratio: float = S.VAL_RATIO, seed: int = S.SEED, reread: bool = False) -> dict[str, list[str]]:
    """Keys of the last test and the last validation row per class."""
    def cuts(counts):
        if min(counts.values()) < 2:
            raise ValueError("a class needs at least two rows to be split")
        return {c: [t, t + v] for c, (t, v) in split_quotas(counts, test_ratio, val_ratio).items()}

    return cut_keys(df, label, id_columns, cuts, seed, reread)


def split_by(df: DataFrame, label: str, id_columns: Sequence[str], cuts: dict[str, list[str]],
             seed: int = S.SEED) -> DataFrame:
    """Add ``split`` = test / val / train by the keys of ``split_cuts``; map-only."""
    name = F.when(F.col("_part") == 0, "test").when(F.col("_part") == 1, "val").when(
        F.col("_part") == 2, "train")
    return assign(df, label, id_columns, cuts, "_part", seed).withColumn("split", name).drop("_part")


def stratified_split(df: DataFrame, label: str, id_columns: Sequence[str],
                     test_ratio: float = S.TEST_RATIO, val_ratio: float = S.VAL_RATIO,
                     seed: int = S.SEED) -> DataFrame:
    """Add ``split`` = test / val / train with exact per-class sizes (M1)."""
    return split_by(df, label, id_columns, split_cuts(df, label, id_columns, test_ratio, val_ratio, seed), seed)


def stratified_sample(df: DataFrame, label: str, id_columns: Sequence[str],
                      rows: int = S.CV_SUBSAMPLE, seed: int = S.SEED, reread: bool = False) -> DataFrame:
    """Exactly ``rows`` rows with class shares kept; the frame itself if it is not larger (M2)."""
    if df.count() <= rows:
        return df
    part = assign_by_cuts(
        df, label, id_columns,
        lambda counts: {c: [n] for c, n in allocate(rows, counts).items()}, "_part", seed, reread,
    )
    return part.filter(F.col("_part") == 0).drop("_part")


def fold_sizes(rows: int, folds: int, offset: int) -> list[int]:
    """Fold sizes of one class: equal up to one row, the extra rows starting at ``offset``."""
    return [rows // folds + (1 if (j - offset) % folds < rows % folds else 0) for j in range(folds)]


def stratified_folds(df: DataFrame, label: str, id_columns: Sequence[str],
                     folds: int = S.CV_FOLDS, seed: int = S.SEED) -> DataFrame:
    """Add ``fold`` = 0..folds-1, spread evenly in every class (M3)."""
    def cuts(counts):
        result = {}
        for offset, c in enumerate(sorted(counts)):
            sizes = fold_sizes(counts[c], folds, offset)
            result[c] = [sum(sizes[: j + 1]) for j in range(folds - 1)]
        return result

    return assign_by_cuts(df, label, id_columns, cuts, "fold", seed)


def sampled_classes(df: DataFrame, label: str, n: int = 10, seed: int = S.SEED) -> DataFrame:
    """All classes if there are at most ``n``, else ``n`` chosen by hash (M4)."""
    classes = df.select(label).filter(F.col(label).isNotNull()).distinct()
    return classes.orderBy(F.md5(F.concat_ws("|", F.col(label), F.lit(str(seed)))), label).limit(n)
