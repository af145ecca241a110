"""Token counts from a cache of content digests."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from importlib import metadata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import pieces, ship_code
from tidemark.llm.tokens import encoder
from tidemark.session import shared_dir

PIECE_BYTES = 8 << 20
CACHE = "content string, n_tokens long, tokenizer string"  # partitioned by the last


def tokenizer_version(path: str) -> str:
    """Digest of the vocabulary file and the library that reads it: another of either is another version."""
    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    with open(path, "rb") as file:
        return hashlib.sha256(f"{library} {metadata.version(library)}\n".encode() + file.read()).hexdigest()


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = encoder(path)
        for batch in batches:
            for first, texts in pieces(batch.column(1), PIECE_BYTES):
                _, lengths = of.encode(texts)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), pa.array(lengths, pa.int64())],
                                                 names=["content", "n_tokens"])
    return run


def count_tokens(docs: DataFrame, path: str, cache: str | None = None, limit: int = 1024,
                 doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit, content)`` per row of ``docs``.

    Content is normalised only as far as the tokenizer cannot tell: a null text counts as an empty one.
    Its SHA-256 digest and that of the tokenizer's version are the key of the cache, a Parquet table at
    ``cache``, a folder for each version, in storage that all executors reach (a new one in the shared folder where none is named).
    Digests that the cache lacks are encoded once each, however many rows hold them, and appended; the
    rows then take their counts from the cache. Copies are dropped map-side before the one shuffle of
    texts. Null ids, repeated rows and empty tables need nothing special; other columns are ignored.
    """
    spark = docs.sparkSession
    ship_code(spark)
    version = tokenizer_version(path)
    place = cache or shared_dir(spark, "token-counts")
    schema = StructType.fromDDL(CACHE)
    empty = spark.createDataFrame([], schema)
    empty.write.mode("append").partitionBy("tokenizer").parquet(place)  # the table exists from here on
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc).alias(doc), body.alias("text"), F.sha2(body, 256).alias("content"))

    def known() -> DataFrame:
        return spark.read.schema(schema).parquet(place).where(F.col("tokenizer") == version)

    missing = (rows.groupBy("content").agg(F.first("text").alias("text"))
               .join(known().select("content"), "content", "left_anti").select("content", "text"))
    (missing.mapInArrow(_count(path), "content string, n_tokens long")
     .select("content", "n_tokens", F.lit(version).alias("tokenizer")).write.mode("append").partitionBy("tokenizer").parquet(place))
    # A writer that ran at the same time may have added the same digest.
    stored = known().groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))
    return rows.select(doc, F.octet_length("text").cast("long").alias("n_bytes"), "content").join(
        stored, "content").select(doc, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "content")
