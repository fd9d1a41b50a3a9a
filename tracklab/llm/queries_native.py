"""Queries of the operators that use DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tracklab.llm import chat, pii
from tracklab.llm.common import query, table


@query()
def op4_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its private values replaced, and how many they were."""
    return pii.pseudonymised(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query()
def op9_chat_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message without quotes, with the message that it answers, in reply order."""
    return chat.conversations(table(spark, sf_dir, "conversations"))
