"""The corpus pipeline: five operators in turn over the documents, each stage written as Parquet and read again."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyloom.llm import lines, mixing, packing, quality, simhash, similar
from keyloom.llm.common import free_names, shared_dir, table
from keyloom.llm.queries import graded

#: No stage but the mix can be put in SQL; the tests hold every stage against a brute-force version.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of a grade above the lowest is at least a half; the model learns from all labels of ``sf_dir``.

    Null and empty texts are scored by their size alone; repeated rows fare alike; an empty table gives no rows; without
    labels all rows stay. Other columns pass through, whatever their names.
    """
    model = quality.train(docs, graded(table(spark, sf_dir, "labels")), F.lit(True))
    return quality.select_documents(docs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without runs of lines of 50 words or more that an earlier one holds; ``n_chars`` follows a changed text.

    Nulls, repeated rows, empty tables and clashing names as in ``lines.dedup_lines``.
    """
    (removed,) = free_names(docs, "lines")
    found = lines.dedup_lines(docs, lines_as=removed)
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.when(F.col(removed) > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return found.select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of texts of a similarity of 0.8 or more in five-word shingles.

    Null, empty and wordless texts are one group; of rows that repeat an id one stays; rows with a null id as in
    ``simhash.keep_one``; an empty table gives no rows. Other columns pass through, whatever their names.
    """
    return simhash.keep_one(docs, similar.similar_groups(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, the last at each source's budget cut to its share.

    Nulls, ties, repeated rows, empty tables and clashing names as in ``mixing.mixed_documents``.
    """
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences of 1024 tokens, with their token ids; odd rows as in ``packing.pack``."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("simhash near-dedup", simhash_near_dedup),
    ("mixing sources", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents of ``sf_dir``; each but the last is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = f"{shared_dir(spark)}/keyloom-stage-{uuid.uuid4().hex}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
