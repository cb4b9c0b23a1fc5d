"""A corpus pipeline: quality, repeated lines, near copies, mixing, tokens.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which ``run`` writes as Parquet and reads again as the
next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.llm import line_dedup, mixing, ngram_join, quality
from tessera.llm.common import materialise, small
from tessera.llm.queries import bpe_digests, byte_bpe_file


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model).where(F.col("score") >= quality.THRESHOLD).select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove later occurrences of three-line windows; ``n_chars`` follows the text."""
    found = line_dedup.dedup_lines(docs)
    own = {"text": F.col("clean_text"), "n_chars": F.length("clean_text").cast("long")}
    return found.select(*[own.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 5-word shingles at 0.8 or more, the one with the least id stays."""
    groups = ngram_join.jaccard_components(docs.select("doc_id", "text"), words=5, percent=80)
    gone = materialise(groups.where("component_id <> doc_id").select("doc_id"), "near-copies")
    return docs.join(small(gone, ngram_join.BROADCAST_ROWS), "doc_id", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents as the mix by source says."""
    mixed = mixing.mix(docs, mixing.quality_weights(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    copies = F.explode(F.when(F.col("times") > 0, F.sequence(F.lit(1), "times")).otherwise(F.array().cast("array<int>")))
    return mixed.select("row", copies.alias("copy")).select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Count and digest every document's tokens and what they decode to."""
    coded = bpe_digests(docs.select("doc_id", "source", "text"), *byte_bpe_file())
    return coded.select("row.doc_id", "row.source", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs


#: The classifier and the encoder can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None
