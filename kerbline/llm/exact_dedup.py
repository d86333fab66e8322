"""Exact duplicates by two passes over a bitmap of hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbline.llm.bloom import build, drop_rows, maybe, size_for
from kerbline.session import settle


def normalised(text: Column) -> Column:
    """The text with each run of ASCII white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``key, keep_id, group_size, kept, text_sha256``.

    First pass: texts become hashes (the only read of the texts, written out), and a bitmap
    marks hashes seen at least twice. Second pass: rows whose hash is not marked are unique and
    pass without a shuffle; marked rows are grouped, pre-aggregated in each task, and joined
    back, so a large group of copies is neither collected nor sent to one task (adaptive
    execution splits it). A false mark only sends a row the long way.

    Equal means equal after white-space runs become one space; null equals the empty text. The
    smallest id stays. Rows without an id count in ``group_size``; they stay only where no row
    of the group has one. Repeated rows with one id are one document and share their fate. An
    empty table gives no rows; other columns are ignored.
    """
    digest = F.sha2(normalised(F.col(text)), 256)
    hashed = settle(docs.select(F.col(key).cast("long").alias(key), digest.alias("text_sha256")).withColumn("__h", F.xxhash64("text_sha256")))
    bitmap = build(hashed, "__h", size_for(hashed.count()), twice=True)
    flagged = hashed.withColumn("__maybe", maybe(hashed, bitmap, "__h")).drop("__h")
    alone = flagged.where("not __maybe").select(key, F.col(key).alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "text_sha256")
    doubtful = flagged.where("__maybe")
    groups = doubtful.groupBy("text_sha256").agg(F.min(key).alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    grouped = doubtful.join(groups, "text_sha256").select(key, "keep_id", "group_size", "text_sha256")
    return alone.unionByName(grouped).select(key, "keep_id", "group_size", F.col(key).eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without later copies; rows that stay are not shuffled."""
    groups = exact_groups(docs, key, text)
    return drop_rows(docs, settle(groups.where("not kept").select(key)), key)
