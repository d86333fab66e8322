"""Flat token files without an index: writing them, and finding their documents again."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbline.llm.textscan import trimmed
from kerbline.session import settle

#: Tokens in a block of the scan, about.
BLOCK = 1 << 20


def write_token_files(docs: DataFrame, path: str, model: bytes, separator: int = 2, text: str = "text") -> None:
    """Write the ids of every whole text, each followed by ``separator``, as 16-bit little-endian files.

    ``model`` is a SentencePiece model below 65,536 ids that never emits the separator for a
    text. Each task writes one file and nothing else; a null text is empty. Spark's text sink
    writes the bytes as they are, so the two bytes of the separator must be ASCII.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    ends = int(separator).to_bytes(2, "little").decode("ascii")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        tokenizer = sentencepiece.SentencePieceProcessor(model_proto=shared.value)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                texts = [x or "" for x in batch.column(0).slice(i, 256).to_pylist()]
                ids = tokenizer.encode(texts, num_threads=1)
                yield pa.RecordBatch.from_arrays([pa.array([np.array(x, "<u2").tobytes() for x in ids], pa.binary())], names=["value"])

    raw = docs.select(text).mapInArrow(trimmed(run), "value binary").select(F.col("value").cast("string"))
    raw.write.option("lineSep", ends).text(path)


def scan_token_files(spark: SparkSession, path: str, separator: int = 2, block: int = BLOCK) -> DataFrame:
    """(file, doc_no, start, n_tokens, closed): the documents of all token files of a folder.

    Spark's text source cuts every file into blocks of about ``block`` ids (32 Ki ids at least) and finds the
    two bytes of the separator in them, wherever the files lie; a file is never one row. Only the lengths between
    these places go on. A prefix scan over the blocks of a file (bytes, separators, last separator) says where
    each place lies: at an odd byte it is parts of two ids and none, at an even one it ends a document. Ids
    after a file's last separator are a document with ``closed`` false. An empty file has no documents.
    """
    ends = int(separator).to_bytes(2, "little").decode("ascii")
    files = spark.read.format("text").option("pathGlobFilter", "part-*").option("lineSep", ends).load(path)
    lines = files.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_size").alias("size"),
        F.monotonically_increasing_id().alias("i"), (F.octet_length("value") + 2).cast("long").alias("bytes"),
    )
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, str(max(2 * block, 1 << 16)))
    try:
        lines = settle(lines)
    finally:
        spark.conf.set(name, before)

    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("file", "block", "size").agg(F.sum("bytes").alias("bytes"))
    total = F.sum("bytes").over(Window.partitionBy("file"))
    # the source takes three bytes for a mark of the encoding if a file begins with them
    mark = F.when(total.isin(F.col("size") - 3, F.col("size") - 1), 3).otherwise(0)
    begin = blocks.select("file", "block", (F.coalesce(F.sum("bytes").over(earlier), F.lit(0)) + mark).alias("begin"))
    inside = Window.partitionBy("file", "block").orderBy("i")
    at = F.sum("bytes").over(inside.rowsBetween(Window.unboundedPreceding, 0)) + F.col("begin") - 2
    found = lines.join(begin, ["file", "block"]).withColumn("at", at).where("at % 2 = 0 AND at + 2 <= size")
    stops = found.select("file", "block", "i", F.expr("at div 2").alias("stop"))

    each = stops.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.max("stop").alias("stop"))
    here = each.select("file", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), F.coalesce(F.max("stop").over(earlier), F.lit(-1)).alias("last"))
    previous = F.coalesce(F.lag("stop").over(inside), F.col("last"))
    closed = stops.join(here, ["file", "block"]).select(
        "file", (F.col("before") + F.row_number().over(inside) - 1).alias("doc_no"), (previous + 1).alias("start"),
        (F.col("stop") - previous - 1).alias("n_tokens"), F.lit(True).alias("closed"),
    )
    whole = blocks.select("file", "size").distinct().join(each.groupBy("file").agg(F.sum("n").alias("n"), F.max("stop").alias("stop")), "file", "left")
    start = F.coalesce(F.col("stop") + 1, F.lit(0).cast("long"))
    rest = whole.select("file", F.coalesce("n", F.lit(0).cast("long")).alias("doc_no"), start.alias("start"), (F.expr("size div 2") - start).alias("n_tokens"), F.lit(False).alias("closed"))
    return closed.unionByName(rest.where("n_tokens > 0"))
