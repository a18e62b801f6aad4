"""The corpus pipeline: five stages over ``documents``, each by one operator of the library.

Every function takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's
result as Parquet in the shared folder and reads it back for the next.  All stages but the
last return the columns of ``documents``.  Null texts count as empty in every stage and stay
documents; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermoflux.llm import buckets, common, feistel, line_dedup, rule_ensemble, simhash
from thermoflux.llm.queries import DEMO_KEY
from thermoflux.sources.tables import read_table


def _like(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` in their order and types; ``n_chars`` follows the text."""
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores 0.7 or more; labels of held-out rows are unused.
    With no labels, or of one class only, no rule is learned and every document stays."""
    common.reachable(spark)
    model = rule_ensemble.fit_quality(docs, read_table(spark, sf_dir, "labels"))
    if not model.rules:
        return docs
    score = "quality_score"
    while score in docs.columns:
        score += "_"
    return rule_ensemble.with_score(docs, model, score).where(F.col(score) >= 0.7).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier line, within one word edit in five, are taken out."""
    common.reachable(spark)
    return _like(line_dedup.dedup_lines(docs, least=1, growing=True), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: that of the smallest ``doc_id``."""
    common.reachable(spark)
    return simhash.one_of_each(docs, shingle=3, bits=3)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal numbers, dates and addresses are replaced by pseudonyms of their format."""
    common.reachable(spark)
    return _like(feistel.with_pseudonyms(docs, DEMO_KEY), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's length bucket, batch and slot; lengths are tokens."""
    common.reachable(spark)
    return buckets.pack_tokens(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality), ("line_dedup", lines), ("simhash", near_duplicates), ("pii", pseudonyms), ("packing", packing)]

#: Trained scores, SimHash components and keyed permutations are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
