"""Toxicity by a classifier chain: categories in order, each fed the earlier probabilities.

Every category has a linear model over words and a few ratios of the text, plus the
probabilities of the categories before it.  A model is trained with out-of-fold
probabilities of the earlier ones, so it sees inputs as uncertain as those at scoring time.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklab.llm.common import free_name
from tracklab.operators.small import checked_broadcast
from tracklab.sources.staging import stage

# Labelled rows that training uses, about: those whose hash is below a threshold.
TRAIN_ROWS = 20_000
# Words kept per category at most; each is in so many sampled texts and so clearly associated.
WORDS_PER_CATEGORY, MIN_TEXTS, MIN_ROOT = 1024, 3, 4.5
STEM = 6
FOLDS = 3
REGULARISATION, STEPS = 0.0001, 100
THRESHOLD = 0.5
SEED = 17

_WORD = re.compile(r"[^\W\d_]+")
MARKS = "#*$%&|!"
N_RATIOS = 3


class Chain(NamedTuple):
    """A trained chain: word numbers, and per category weights (words, ratios, earlier categories) and bias."""

    words: dict[str, int]
    categories: tuple[str, ...]
    models: list[tuple[np.ndarray, float]]


def word_list(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def ratios(text: str, words: list[str], distinct: int) -> tuple[float, float, float]:
    """Length on a log scale, marks per word and share of repeated words."""
    n = max(len(words), 1)
    marks = sum(map(text.count, MARKS))
    return math.log1p(n) / 10, min(marks / n, 4.0) / 4, 1 - distinct / n


def terms(words: list[str]) -> set[str]:
    """The distinct words, and the stems of the longer ones."""
    distinct = set(words)
    return distinct | {w[:STEM] + "*" for w in distinct if len(w) > STEM}


def features(text: str, words: dict[str, int]) -> tuple[list[int], tuple[float, float, float]]:
    """Numbers of the known words and stems that occur, and the ratios."""
    found = word_list(text)
    return sorted(words[w] for w in terms(found) & words.keys()), ratios(text, found, len(set(found)))


def _sample(labels: DataFrame, doc_id: str, categories: tuple[str, ...], rows: int) -> DataFrame:
    """About ``rows`` labelled ids with all their categories; several labels of an id give the largest."""
    known = labels.select(F.col(doc_id).alias("_id"), *[F.col(c).cast("int").alias(c) for c in categories])
    known = known.dropna().groupBy("_id").agg(*[F.max(c).alias(c) for c in categories])
    total = known.count()
    if total > rows:
        known = known.filter(F.pmod(F.xxhash64(F.lit(SEED), "_id"), F.lit(1_000_000)) < F.lit(int(1e6 * rows / total)))
    return checked_broadcast(known, 2 * rows + 1000)


def near_copy_key(words: list[str]) -> int:
    """Least hash of the text's three-word runs: near copies mostly share it, other texts do not."""
    runs = zip(words, words[1:], words[2:]) if len(words) > 2 else [tuple(words)]
    return min(zlib.crc32(" ".join(r).encode()) for r in runs)


def _vocabulary(texts: DataFrame, categories: tuple[str, ...]) -> dict[str, int]:
    """The words that mark each category: signed root of the likelihood ratio of at least ``MIN_ROOT``.

    Near copies of a text count as one, with the mean of their labels.
    """

    @F.pandas_udf("struct<key: long, words: array<string>>")
    def parts(batch: pd.Series) -> pd.DataFrame:
        found = [word_list(t) for t in batch]
        return pd.DataFrame({"key": [near_copy_key(f) for f in found], "words": [sorted(terms(f)) for f in found]})

    def x_log(x, over):
        return F.when(x <= 0, 0.0).otherwise(x * F.log(x / over))

    units = texts.select(parts("text").alias("t"), *categories).select("t.*", *categories)
    means = [F.avg(c).alias(c) for c in categories]
    rate = units.groupBy("key").agg(*means).agg(*means).first().asDict()
    counts = units.select("key", F.explode("words").alias("w"), *categories).groupBy("w", "key").agg(*means)
    counts = counts.groupBy("w").agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in categories])
    counts = stage(counts.filter(F.col("n") >= MIN_TEXTS), "toxicity-words")
    chosen = set()
    for c in categories:
        p = rate[c] or 0.0
        if not 0 < p < 1:
            continue
        n, k = F.col("n"), F.col(c)
        ratio = 2 * (x_log(k, n * p) + x_log(n - k, n * (1 - p)))
        top = counts.select("w", ratio.alias("g")).filter((k > n * p) & (F.col("g") >= MIN_ROOT ** 2))
        chosen.update(r["w"] for r in top.orderBy(F.desc("g"), "w").limit(WORDS_PER_CATEGORY).collect())
    return {w: i for i, w in enumerate(sorted(chosen))}


def train(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...], doc_id: str = "doc_id", text: str = "text",
          rows: int = TRAIN_ROWS) -> Chain:
    """Chain over 0/1 columns of ``labels``, from at most about ``rows`` labelled documents.

    Labels with a null category or without a text are left out.  A category whose sampled
    labels are all equal gets their rate as a constant probability; without labels it is 0.
    """
    known = _sample(labels, doc_id, categories, rows)
    texts = stage(
        docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("text")).filter(F.col("text").isNotNull())
        .join(known, F.col("_doc") == F.col("_id")).drop("_id"), "toxicity-sample")
    words = _vocabulary(texts, categories)
    width = len(words) + N_RATIOS

    @F.pandas_udf("array<double>")
    def row_features(batch: pd.Series) -> pd.Series:
        def dense(t):
            out = np.zeros(width)
            found, rest = features(t, words)
            out[found] = 1.0
            out[-N_RATIOS:] = rest
            return out
        return batch.map(dense)

    fold = F.pmod(F.xxhash64(F.lit(SEED + 1), "_doc"), F.lit(FOLDS)).cast("int")
    data = stage(texts.select("_doc", fold.alias("fold"), *categories, row_features("text").alias("x")), "toxicity-rows")
    earlier: list[str] = []
    models = []
    for n, c in enumerate(categories):
        model = _fit(data, c, earlier, width)
        models.append(model)
        if n + 1 < len(categories):
            parts = [_fit(data.filter(F.col("fold") != k), c, earlier, width) for k in range(FOLDS)]
            p = _probability_column(parts, earlier)
            data = stage(data.withColumn(f"p_{n}", p), "toxicity-rows")
            earlier.append(f"p_{n}")
    return Chain(words, tuple(categories), models)


def _inputs(earlier: list[str]):
    return F.concat("x", F.array(*earlier).cast("array<double>")) if earlier else F.col("x")


def _fit(data: DataFrame, category: str, earlier: list[str], width: int) -> tuple[np.ndarray, float]:
    got = data.agg(F.count(F.lit(1)).alias("n"), F.sum(category).alias("k")).first()
    n, k = got["n"], got["k"] or 0
    size = width + len(earlier)
    if not n or k in (0, n):
        rate = (k + 0.0) / n if n else 0.0
        return np.zeros(size), 30.0 if rate else -30.0
    lr = LogisticRegression(featuresCol="v", labelCol=category, regParam=REGULARISATION, maxIter=STEPS, standardization=False, tol=1e-6)
    model = lr.fit(data.select(F.col(category).cast("double").alias(category), array_to_vector(_inputs(earlier)).alias("v")))
    return model.coefficients.toArray(), float(model.intercept)


def _probability_column(parts: list[tuple[np.ndarray, float]], earlier: list[str]):
    """Out-of-fold probability: row by row, by the model that has not seen its fold."""

    @F.pandas_udf("double")
    def probability(x: pd.Series, fold: pd.Series) -> pd.Series:
        rows = zip(x, fold)
        return pd.Series([sigmoid(float(parts[k][0] @ np.asarray(v)) + parts[k][1]) for v, k in rows], dtype="float64")

    return probability(_inputs(earlier), F.col("fold"))


def sigmoid(z: float) -> float:
    return 1 / (1 + math.exp(-z)) if z >= 0 else 1 - 1 / (1 + math.exp(z))


def predict(chain: Chain, text: str) -> list[float]:
    """Probabilities of all categories, in their order."""
    found, rest = features(text, chain.words)
    n, out = len(chain.words), []
    for weights, bias in chain.models:
        z = bias + float(weights[found].sum()) + float(np.dot(weights[n:n + N_RATIOS], rest))
        out.append(sigmoid(z + float(np.dot(weights[n + N_RATIOS:], out))))
    return out


def probabilities(spark, text: Column, chain: Chain) -> Column:
    """Array of the probabilities of all categories of a text; null counts as empty."""
    shared = spark.sparkContext.broadcast(chain)

    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        for batch in batches:
            yield pd.Series([predict(model, t) for t in batch], dtype="object")

    return run(F.coalesce(text, F.lit("")))


def score(df: DataFrame, chain: Chain, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``df`` with ``p_<category>`` per category and ``is_<last category>`` (replaced where they exist).

    Null and empty texts are scored as empty; whole texts are read; equal texts score equal.
    """
    last = chain.categories[-1]
    p = free_name(df, "_p")
    new = {f"p_{c}": F.get(F.col(p), F.lit(i)) for i, c in enumerate(chain.categories)}
    new[f"is_{last}"] = F.get(F.col(p), F.lit(len(chain.categories) - 1)) >= threshold
    low = {k.lower() for k in new}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in low]
    return df.withColumn(p, probabilities(df.sparkSession, F.col(text), chain)).select(
        *kept, *[c.alias(k) for k, c in new.items()])


def without(df: DataFrame, chain: Chain, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``df`` whose last category is less probable than ``threshold``; all columns stay."""
    p = probabilities(df.sparkSession, F.col(text), chain)
    return df.filter(F.get(p, F.lit(len(chain.categories) - 1)) < threshold)


def label_categories(labels: DataFrame) -> DataFrame:
    """The two categories of the label table, in chain order: low quality, then toxic."""
    return labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), F.col("toxic"))


CATEGORIES = ("low_quality", "toxic")
