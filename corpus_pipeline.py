"""A training corpus in five stages, from documents to token ids.

Each stage takes (spark, docs, sf_dir) with docs what the stage before has written, and returns the rows to write; all
but the last return the columns of documents. Rows stand for themselves: ids may be null or repeated, and columns beside
those of documents, whatever their names, are carried along. Empty tables stay empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mosaicflow.llm.common import drop_path, new_path, numbered, stored, table, unused
from mosaicflow.llm.decontaminate import contamination
from mosaicflow.llm.language import UNKNOWN, fit, predict, train_rows
from mosaicflow.llm.minhash import near_duplicates
from mosaicflow.llm.mixing import mix_documents
from mosaicflow.llm.token_output import token_digest, write_tokens

#: A document whose language is told with less certainty than this is rejected.
LEAST_SCORE = 0.5


def prefix_for(docs: DataFrame, names: list[str]) -> str:
    """A prefix that makes no name of a column of docs out of these."""
    taken, prefix = {c.lower() for c in docs.columns}, "told_"
    while any((prefix + n).lower() in taken for n in names):
        prefix += "_"
    return prefix


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text has letters and a language told with a score of LEAST_SCORE at least; null and empty texts go."""
    prefix = prefix_for(docs, ["lang_pred", "score"])
    told = predict(docs, fit(train_rows(docs)), docs.columns, prefix=prefix)
    return told.filter((F.col(f"{prefix}lang_pred") != UNKNOWN) & (F.col(f"{prefix}score") >= LEAST_SCORE)).select(*docs.columns)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies (five-word shingles, similarity 0.8), the one of smallest id.

    Ids may be null (last) or repeated, of rows of one id the first stays. Rows without words are near nothing and stay.
    """
    (row,) = unused(docs, "row_number")
    own = numbered(docs, row)
    groups = near_duplicates(own.select(F.col(row).alias("doc_id"), "text"))
    # rows of groups of two or more; the smallest id of each is found before rows are brought together
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", row)
    linked = groups.filter("not kept").select("component_id").distinct()
    members = groups.join(linked, "component_id").select(F.col("doc_id").alias(row), "component_id").join(own.select(row, "doc_id"), row)
    members = stored(members, "pipeline-members")
    first = members.groupBy("component_id").agg(F.min(place).alias("first")).select(F.col(f"first.{row}").alias(row))
    gone = members.select(row).join(first, row, "left_anti")
    return own.join(gone, row, "left_anti").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that are not contaminated by the benchmark; null and empty texts stay."""
    (row,) = unused(docs, "row_number")
    own = numbered(docs, row)
    bad = contamination(own, table(spark, sf_dir, "benchmark"), [row]).filter("contaminated").select(row)
    return own.join(bad, row, "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources at their target weights: each row with the words that the mix takes of it, others go."""
    return mix_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all rows as Parquet list columns, in ascending id order (null first); the rows are read back from the files."""
    path = write_tokens(docs, new_path(spark, "pipeline-tokens"), public_tokenizers.path("word_bpe_49k.json"))
    return token_digest(spark, path, docs.schema["doc_id"].dataType)


STAGES = [
    ("language ID", language_id),
    ("MinHash near-dedup", minhash_dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix_sources),
    ("token-ID output", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on sf_dir's documents, each written as Parquet and read again for the next, which lets go of what it read."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = new_path(spark, "pipeline-" + name.split()[0].lower())
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            drop_path(spark, before)
        before = path
    out = STAGES[-1][1](spark, docs, sf_dir)
    drop_path(spark, before)
    return out


#: The classifier and the tokenizer cannot be written in SQL; tests hold each stage against brute force.
ORACLE_SQL = None
