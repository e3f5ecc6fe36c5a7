"""Byte-balanced contiguous shards from global prefix sums [native]."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import materialize, ordered, text_or_empty


def document_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text plus 8; a null text has none) and the text's CRC-32."""
    return docs.select("doc_id", (F.octet_length(text_or_empty()) + 8).cast("long").alias("size"),
                       F.crc32(text_or_empty().cast("binary")).alias("text_crc32"))


def byte_shards(docs: DataFrame, n_shards: int = 24) -> DataFrame:
    """Cut the documents, in doc_id order, into ``n_shards`` contiguous shards of near-equal bytes.

    Each document's global byte prefix sum comes from its partition's running sum plus the
    totals of earlier partitions; the shard is the equal target interval that holds the middle
    of the document's bytes, so a shard's size differs from the target by less than one
    document at each end. ``slot`` numbers a shard's documents from 0 in the same order.

    Only doc_id, size and CRC are shuffled, never a text. Null doc_ids come first; equal
    doc_ids are ordered by CRC and size, and wholly equal rows take consecutive places.
    A single document larger than a target leaves the shards it covers empty. An empty
    table gives no rows. Other columns of the input are ignored.
    """
    sizes = materialize(document_sizes(docs), "sizes")
    t = ordered(sizes, [F.col("doc_id").asc_nulls_first(), F.col("text_crc32"), F.col("size")],
                ("size",), "size-order")
    middle = (F.col("_before_size") * 2 + F.col("size")).cast("decimal(38,0)") * n_shards
    shard = F.least(F.lit(n_shards - 1), F.floor(middle / (F.col("_all_size") * 2)).cast("int"))
    t = t.withColumn("shard", shard)
    firsts = t.groupBy("shard").agg(F.min("_row").alias("_first"))  # n_shards rows at most
    return (t.join(F.broadcast(firsts), "shard")
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("_row") - F.col("_first")).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
