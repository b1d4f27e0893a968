"""A corpus pipeline of five stages, each one operator of cliploom.llm on what the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliploom.llm import line_dedup, ngram_join, packing, pairwise_quality, queries, suffix_dedup
from cliploom.llm._util import Workspace


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise ranker, fitted on the labels, predicts to be good.

    Null and empty texts are judged as the empty text; labels of null ids and null labels count for nothing, without
    labels all stay; repeated rows are judged alike; extra columns of any name come through; no rows give none.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = pairwise_quality.fit(docs, labels, use=queries.remainder("id") != 1)
    name = "_score"
    while name in docs.columns:
        name += "_"
    return pairwise_quality.score(docs, model, name=name).filter(f"{name} >= 0.5").drop(name)


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One line of each group of like lines stays; documents left without lines go.

    Rows of null, empty or blank text have no lines and stay as they are. A null id is one id like any other and
    comes first; repeated rows stay together. Extra columns of any name come through; no rows give none.
    """
    return _counted(line_dedup.clean(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at a similarity of 0.8 stays: that of least id.

    Rows without words or with a null id are never removed; rows of one id stay or go together. Extra columns of any
    name come through; no rows give none.
    """
    linked = ngram_join.join(docs, k=5, percent=80)
    gone = linked.filter("component_id <> doc_id").select("doc_id")
    return docs.hint("merge").join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of over 50 words or of 400 bytes that stand more than once go, all occurrences; documents left without words go.

    The bytes are judged on the text as it is, the words (split at ASCII white space) one by one; both on the stage's
    input. Rows of null, empty or blank text stay as they are; repeated rows are occurrences of each other; a null id
    is one id like any other. Extra columns of any name come through; no rows give none.
    """
    return _counted(suffix_dedup.clean(docs, width=400, words=51))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences of at most 4096 tokens.

    A null or empty text is one piece of its closing token; repeated rows are packed each; no rows give none.
    """
    return packing.pack(docs, queries.tokenizer(), capacity=4096)


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("repeats", repeats), ("packing", pack)]

#: SQL can't express the stages; tests/llm/test_pipeline.py holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; each stage's rows are written and read again by the next."""
    ws = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = ws.save(stage(spark, docs, sf_dir))
    return docs
