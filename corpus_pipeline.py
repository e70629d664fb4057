"""A training corpus from raw documents, in stages; each takes what the one before kept.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame; all but the last give the columns of docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyrelake.llm.common import beside, components, cut, gathered, matched, small_batches, table, unused
from pyrelake.llm.near_copies import WIDTH, near_links
from pyrelake.llm.op4_bpe import encode_and_check
from pyrelake.llm.op5_simhash import simhash_groups
from pyrelake.llm.op7_decontamination import without_leaks
from pyrelake.llm.op9_line_dedup import dedup_lines
from pyrelake.llm.op10_language import UNKNOWN, language, train

#: Documents whose language is less certain are rejected.
LEAST_SCORE = 0.35


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language the network names with at least LEAST_SCORE; null texts and texts without a letter go."""
    small_batches(spark)
    name = unused("said", docs)
    said = docs.withColumn(name, language(train(docs))("text"))
    return said.where((F.col(f"{name}.lang_pred") != UNKNOWN) & (F.col(f"{name}.score") >= LEAST_SCORE)).select(*docs.columns)


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out lines that repeat earlier ones; documents of which nothing is left go."""
    left = dedup_lines(docs).where(F.length(F.trim("text")) > 0)
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def one_of_each(docs: DataFrame) -> DataFrame:
    """docs, of rows that share an id and a text one."""
    body = unused("body", docs)
    keyed = docs.withColumn(body, F.xxhash64("text"))
    again = cut(keyed.where("doc_id IS NOT NULL").groupBy("doc_id", body).count().where("count > 1").select("doc_id", body))
    if again.isEmpty():
        return docs
    several = matched(keyed, again, ["doc_id", body], "left_semi").dropDuplicates(["doc_id", body])
    return matched(keyed, again, ["doc_id", body], "left_anti").unionByName(several).select(*docs.columns)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group of near-duplicates; rows without an id stay.

    Documents are linked by their SimHash as in op5, over shingles of five words, and where these have a Jaccard of 0.8
    or more. Of rows that share an id and a text one stays; rows that share only an id stay or go together.
    """
    small_batches(spark)
    alike = simhash_groups(docs, WIDTH).where("doc_id != component_id").select(F.col("doc_id").alias("u"), F.col("component_id").alias("v"))
    gone = cut(components(alike.unionByName(near_links(docs))).where("node != component").select(F.col("node").alias("doc_id")).distinct())
    docs, n = one_of_each(docs), gone.count()
    return beside(docs, gathered(gone, n), ["doc_id"], n, "left_anti").select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a benchmark item is found."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids, and the digests of the ids and of what they decode to."""
    small_batches(spark)
    return encode_and_check(docs)


STAGES = [
    ("language", known_language),
    ("line_dedup", distinct_lines),
    ("simhash", distinct_documents),
    ("decontamination", without_benchmark),
    ("bpe", encoded),
]

#: The stages learn, hash and tokenize in ways that SQL does not have; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut(docs)
    return docs
