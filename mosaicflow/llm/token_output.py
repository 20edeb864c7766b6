"""Token-ID output: Parquet list columns in ascending id order, and reading them back.

The files' layout is what a training reader wants: one row a document with its ids as a list column, dictionary
encoded (a vocabulary of 49k fits one dictionary page), row groups and pages of set sizes, page indexes from the
writer, so that a reader of some documents or of `doc_id` and `n_tokens` alone skips the rest.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from . import kernels as K
from .common import cleaned, new_path, small_batches, table
from .tokens import ENCODE_BYTES, encoder_of

ROW_GROUP_BYTES, PAGE_BYTES, PAGE_ROWS = 32 << 20, 256 << 10, 2000
END_ID = 2


def encode_documents(docs: DataFrame, tokenizer_path: str, end_id: int | None = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, tokens (array of int) of each row, in the order of the rows; end_id goes behind each document's ids.

    Null and empty texts have no ids of their own, so only the end id where there is one; repeated rows and rows without
    id are encoded each; other columns are left out; no rows give none.
    """
    small_batches(docs.sparkSession)

    @K.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer_path)
        for batch in K.gathered(batches, ENCODE_BYTES):
            data, offsets = K.utf8(batch.column(1))
            for i, j in K.slices(offsets, ENCODE_BYTES):
                ids, counts = encoder.encode(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                if end_id is not None:
                    full = np.full(len(ids) + j - i, end_id, dtype=np.int32)
                    full[np.arange(len(ids)) + np.repeat(np.arange(j - i), counts)] = ids
                    ids, counts = full, counts + 1
                yield from K.parts(pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(counts), K.nested(pa.array(ids.astype(np.int32)), counts)], names=["doc_id", "n_tokens", "tokens"]))

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, f"doc_id {kind}, n_tokens long, tokens array<int>")


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int | None = END_ID, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Encode all documents and write them in ascending id order (null ids first): file by file, each a range of ids.

    Rows of one id, or of none, follow each other by text (null first), so their places do not hang on where rows are stored.
    """
    ordered = docs.select(F.col(id_col), F.col(text_col)).repartitionByRange(id_col).sortWithinPartitions(id_col, text_col)
    with cleaned(docs.sparkSession):
        (
            encode_documents(ordered, tokenizer_path, end_id, id_col, text_col)
            .write.option("compression", "zstd")
            .option("parquet.enable.dictionary", "true")
            .option("parquet.block.size", str(ROW_GROUP_BYTES))
            .option("parquet.page.size", str(PAGE_BYTES))
            .option("parquet.page.row.count.limit", str(PAGE_ROWS))
            .parquet(path)
        )
    return path


def read_tokens(spark: SparkSession, path: str, id_type: T.DataType | None = None) -> DataFrame:
    """doc_id, n_tokens, tokens of the written files, with each row's file and place in it."""
    schema = T.StructType([T.StructField("doc_id", id_type or T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("tokens", T.ArrayType(T.IntegerType()))])
    return spark.read.schema(schema).parquet(path).select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))


def token_digest(spark: SparkSession, path: str, id_type: T.DataType | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each written document, all from the files.

    Rows of one id follow each other in the files' order (by text, as write_tokens has them), rows without id come first; a folder without rows gives none.
    start: files hold ranges of ids, so a file starts behind all ids of the files of smaller ids; inside a file a
    running sum goes in row order. The sum over files has one row a file, no more.
    """
    small_batches(spark)

    @K.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            off = lists.offsets.to_numpy().astype(np.int64)
            flat = lists.values.to_numpy().astype("<u4")
            raw = memoryview(flat).cast("B")
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(off)), pa.array(crc, pa.int64()), batch.column(2), batch.column(3)], names=["doc_id", "n_tokens", "ids_crc32", "file", "row"])

    kind = (id_type or T.LongType()).simpleString()
    rows = read_tokens(spark, path, id_type).select("doc_id", "tokens", "file", "row").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_crc32 long, file string, row long")
    files = read_tokens(spark, path, id_type).groupBy("file").agg(F.sum("n_tokens").alias("in_file"))
    files = files.withColumn("before", F.sum("in_file").over(Window.orderBy(F.regexp_extract("file", r"part-(\d+)", 1).cast("long")).rowsBetween(Window.unboundedPreceding, -1))).select("file", F.coalesce("before", F.lit(0)).alias("before"))
    inner = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("inner", inner).join(files, "file").select("doc_id", (F.col("before") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the token ids of all documents and read them back; see encode_documents and token_digest for edges."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    path = write_tokens(docs, new_path(spark, "tokens"), public_tokenizers.path("word_bpe_49k.json"))
    return token_digest(spark, path, docs.schema["doc_id"].dataType)
