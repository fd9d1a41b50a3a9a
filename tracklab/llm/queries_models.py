"""Queries of the trained operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tracklab.llm import html_crf, toxicity
from tracklab.llm.common import query, table


@query()
def op1_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities of the chain's categories and the toxic verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity.train(docs, toxicity.label_categories(table(spark, sf_dir, "labels")), toxicity.CATEGORIES)
    return toxicity.score(docs, chain).drop("text")


@query()
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_crf.extract(pages, html_crf.train(pages)).drop("html")
