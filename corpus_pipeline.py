"""The training-data pipeline: five stages, each on all that its predecessor kept.

Toxic documents go, repeated line windows lose their later occurrences, one document of each near-duplicate group
stays (five-word shingles, similarity 0.8), documents that hold benchmark items go, the rest gets its tokens.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortforge.llm import decontaminate, jaccard_join, line_dedup, sentencepiece_bpe, toxicity
from cohortforge.llm.queries import TOXIC_FROM, tokenizer_path, toxicity_model
from cohortforge.llm.tables import materialize, packed, table

#: No SQL expresses the fitted classifier or the tokens; the tests hold the rows against a brute-force version.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below the threshold, as fitted on the labelled ones outside the held-out fold."""
    return toxicity.score_texts(docs, toxicity_model(spark, sf_dir, docs), TOXIC_FROM, keep_only_clean=True)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the later occurrences of repeated three-line windows; n_chars follows the text."""
    rows = line_dedup.drop_repeated_lines(docs)
    column = {"text": F.col("kept"), "n_chars": F.when(F.col("lines_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("row.n_chars"))}
    return rows.select(*[column.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id; of repeated rows of it, one."""
    groups = jaccard_join.jaccard_components(docs, width=5, percent=80)
    first = groups.where("n_shingles > 0").groupBy("component").agg(F.min(F.struct("doc_id", "ver")).alias("first")).select("first.*")
    empty = groups.where("n_shingles = 0").select("doc_id", "ver").distinct()
    keys = first.unionAll(empty).select(F.col("doc_id").alias("key_id"), F.col("ver").alias("key_text"))
    rows = packed(docs).withColumn("key_text", F.xxhash64("row.text")).join(keys, "key_text").where(F.col("row.doc_id").eqNullSafe(F.col("key_id")))
    return rows.dropDuplicates(["key_text", "key_id"]).select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is confirmed."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def add_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns, the ids of the whole text, and their number."""
    rows = sentencepiece_bpe.encode(docs, tokenizer_path())
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns], "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("jaccard_join", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("sentencepiece", add_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
