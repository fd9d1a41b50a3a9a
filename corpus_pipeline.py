"""From raw documents to a training mix: five stages, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as
Parquet and read again as the next stage's documents.  All but the last return the columns of
the documents, and extra columns pass through.  Empty tables give empty results; what nulls,
repeated rows and empty texts become is said at the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklab.llm import decontam, mixing, partenum, pii, toxicity
from tracklab.llm.common import free_name, sheltered, table
from tracklab.llm.common import words as words_of
from tracklab.session import scratch_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain, trained on the label table, does not find toxic."""
    labels = toxicity.label_categories(table(spark, sf_dir, "labels"))
    return toxicity.without(docs, toxicity.train(docs, labels, toxicity.CATEGORIES))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of five-word shingles with a similarity of 80 percent."""
    return partenum.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontam.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for private values, and their lengths anew."""
    out = pii.pseudonymised(docs, count=(count := free_name(docs, "n_private"))).drop(count)
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row per repetition of a document, with ``repetition`` from 1 and its ``words``.

    The document at a source's cut gives its last repetition up to the cut, its words joined
    by blanks; documents of which nothing is taken are not in the mix.  ``source_size``, ``target``,
    ``repetition`` and ``words`` are results and replace columns of these names.
    """
    return _mixed(docs)


@sheltered("size", "order_key", "taken")
def _mixed(docs: DataFrame) -> DataFrame:
    taken = mixing.mix(mixing.sized(docs)).filter("taken > 0")
    part = F.least(F.col("size"), F.col("taken") - (F.col("repetition") - 1) * F.col("size"))
    out = taken.withColumn("repetition", F.explode(F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int"))))
    out = out.withColumn("words", part)
    cut = F.array_join(F.slice(words_of(F.col("text")), F.lit(1), F.col("words").cast("int")), " ")
    out = out.withColumn("text", F.when(F.col("words") < F.col("size"), cut).otherwise(F.col("text")))
    return out.withColumn("n_chars", F.length("text").cast("long")).drop("order_key", "size", "taken")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("private_values", replace_private),
    ("mixing", mix_sources),
]

# A trained model decides in the first stage, so SQL cannot give these rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
