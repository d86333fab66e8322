"""Quality by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbline.llm.bloom import drop_rows
from kerbline.llm.textscan import mix, slices, span_hashes, trimmed
from kerbline.session import settle

#: Byte classes: 0 white space, 1 small letter or non-ASCII, 2 capital, 3 digit, 4 other.
CLASS = np.full(256, 4, np.uint8)
CLASS[[9, 10, 11, 12, 13, 32]] = 0
CLASS[97:123] = CLASS[128:] = 1
CLASS[65:91] = 2
CLASS[48:58] = 3


def features(data: np.ndarray, offs: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of the rows (bucket, row).

    Tokens are runs of letters and digits and runs of other signs; a token equal to the one
    before it counts as the token "again". The n-grams are tokens, pairs of tokens, and pairs
    of shapes (which byte classes a token holds, its first class, its length up to 15).
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = CLASS[data]
    group = np.where(kind == 4, 2, np.minimum(kind, 1))
    cut = np.zeros(n + 1, bool)
    cut[offs] = True
    cut[1:n] |= group[1:] != group[:-1]
    edge = np.flatnonzero(cut)
    if edge[-1] != n:
        edge = np.append(edge, n)
    starts, ends = edge[:-1], edge[1:]
    real = group[starts] > 0
    starts, ends = starts[real], ends[real]
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    row = np.searchsorted(offs, starts, "right") - 1
    token = span_hashes(data, starts, ends)
    same_row = np.append(False, row[1:] == row[:-1])
    again = same_row & np.append(False, token[1:] == token[:-1])
    token[again] = 1
    flags = np.bitwise_or.reduceat(np.left_shift(1, kind).astype(np.uint8), starts)
    # reduceat runs on to the next token's start: white space in between only sets bit 0
    shape = (flags & 0xFE).astype(np.uint64) << np.uint64(8) | kind[starts].astype(np.uint64) << np.uint64(4) | np.minimum(ends - starts, 15).astype(np.uint64)
    shape[again] = 0
    pair = np.flatnonzero(same_row)
    salt = np.uint64(0x9E3779B97F4A7C15)
    grams = np.concatenate((token, mix(token[pair - 1] * salt + token[pair]), mix((shape[pair - 1] << np.uint64(20) | shape[pair]) + salt)))
    return (mix(grams) % np.uint64(buckets)).astype(np.int64), np.concatenate((row, row[pair], row[pair]))


@dataclass(frozen=True)
class Model:
    """Log ratio of target to raw text per bucket, and the cut that the labels suggest."""

    ratio: np.ndarray
    cut: float = 0.0


def bounded_labels(labels: DataFrame, value: str, most: int, key: str = "doc_id") -> tuple[np.ndarray, np.ndarray]:
    """At most ``most`` labelled ids, those with the smallest hash, sorted, and their labels."""
    rows = labels.where(F.col(value).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias(key)).agg(F.min(value).alias(value))
    got = rows.orderBy(F.xxhash64(key), key).limit(most).toPandas().sort_values(key)
    return got[key].to_numpy(np.int64), got[value].to_numpy(np.int64)


def find(sorted_ids: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``ids`` in a sorted array, and whether each is there."""
    at = np.searchsorted(sorted_ids, ids)
    at[at == len(sorted_ids)] = 0
    return at, (sorted_ids[at] == ids) if len(sorted_ids) else np.zeros(len(ids), bool)


def _counts(docs: DataFrame, ids: np.ndarray, good: np.ndarray, buckets: int, key: str, text: str) -> tuple[np.ndarray, np.ndarray]:
    """n-grams by bucket of all texts, and of the target texts: two sums over all documents."""
    sample = docs.sparkSession.sparkContext.broadcast((ids, good))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, labels = sample.value
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            at, known = find(names, batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False))
            is_target = known & (labels[at] > 0) if len(labels) else known
            for first, data, offs in slices(batch.column(1)):
                bucket, row = features(data, offs, buckets)
                raw += np.bincount(bucket, minlength=buckets)
                target += np.bincount(bucket[is_target[first + row]], minlength=buckets)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets)), pa.array(raw), pa.array(target)], names=["bucket", "raw", "target"])

    rows = docs.select(F.col(key).cast("long").alias(key), text).mapInArrow(trimmed(run), "bucket long, raw long, target long")
    got = rows.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()  # one row per bucket
    raw, target = np.zeros(buckets), np.zeros(buckets)
    raw[got["bucket"]], target[got["bucket"]] = got["raw"], got["target"]
    return raw, target


def weight(spark, ratio: np.ndarray, text: Column) -> Column:
    """(weight, grams) of a text: the sum of the log ratios of its n-grams, and their number."""
    shared = spark.sparkContext.broadcast(ratio)

    @F.arrow_udf("struct<weight: double, grams: bigint>")
    def score(column: pa.Array) -> pa.Array:
        table = shared.value
        total, grams = np.zeros(len(column)), np.zeros(len(column), np.int64)
        for first, data, offs in slices(column):
            bucket, row = features(data, offs, len(table))
            total[first : first + len(offs) - 1] = np.bincount(row, table[bucket], len(offs) - 1)
            grams[first : first + len(offs) - 1] = np.bincount(row, minlength=len(offs) - 1)
        return pa.StructArray.from_arrays([pa.array(total), pa.array(grams)], names=["weight", "grams"])

    return score(text)


def kth_largest(df: DataFrame, column: str, k: int) -> float:
    """The k-th largest value of a double column, by rounds of counts over ever narrower bins."""
    with_key = df.select(F.col(column).alias("v"))
    low, high = with_key.agg(F.min("v"), F.max("v")).first()
    while low < high:
        step = (high - low) / 4096
        if step == 0 or low + step == low:
            break
        bin_of = F.least(F.floor((F.col("v") - F.lit(low)) / F.lit(step)), F.lit(4095)).alias("b")
        inside = with_key.where((F.col("v") >= low) & (F.col("v") <= high))
        rows = inside.groupBy(bin_of).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy(F.desc("b")).collect()
        for row in rows:  # at most 4096
            if k <= row["n"]:
                low, high = row["lo"], row["hi"]
                break
            k -= row["n"]
    return low


def score_documents(
    docs: DataFrame, labels: DataFrame, buckets: int = 16_384, most_labels: int = 20_000, temperature: float = 0.004,
    seed: int = 17, key: str = "doc_id", text: str = "text", quality: str = "quality",
) -> DataFrame:
    """``key, log_weight, n_grams, score, draw, kept`` per row: which documents a resample keeps.

    Target text is what ``labels`` call good, among at most ``most_labels`` labelled ids; raw
    text is all of ``docs``. Both are models of independent hashed n-grams, smoothed with one
    count per bucket. A document's ``log_weight`` is the sum of its n-grams' log ratios,
    ``score`` that sum per n-gram. ``k`` documents are drawn without replacement by Gumbel
    top-k over ``score / temperature``; ``k`` is how many documents score above the cut that
    splits the labelled ones best. The noise of a row comes from its id and ``seed``, so a run
    repeats itself. Rows that tie with the last one drawn are drawn too.

    A null or empty text has no n-grams and score 0 per n-gram; it is kept if 0 is above the
    cut. Without labels of both kinds the cut is 0. An empty table gives no rows.
    """
    spark = docs.sparkSession
    ids, good = bounded_labels(labels, quality, most_labels)
    raw, target = _counts(docs, ids, good, buckets, key, text)
    ratio = np.log((target + 1) / (target.sum() + buckets)) - np.log((raw + 1) / (raw.sum() + buckets)) if target.sum() else np.zeros(buckets)
    named = docs.select(F.col(key).cast("long").alias(key), weight(spark, ratio, F.col(text)).alias("w"))
    uniform = (F.shiftrightunsigned(F.xxhash64(F.col(key), F.lit(seed)), 11).cast("double") + 0.5) / float(1 << 53)
    scored = settle(
        named.select(key, F.col("w.weight").alias("log_weight"), F.col("w.grams").alias("n_grams"))
        .withColumn("score", F.col("log_weight") / F.greatest(F.col("n_grams"), F.lit(1)))
        .withColumn("draw", F.col("score") / temperature - F.log(-F.log(uniform)))
    )
    cut = _best_cut(scored, ids, good, key)
    k = scored.where(F.col("score") > cut).count()
    last = kth_largest(scored, "draw", k) if k else math.inf
    return scored.withColumn("kept", F.col("draw") >= last)


def _best_cut(scored: DataFrame, ids: np.ndarray, good: np.ndarray, key: str) -> float:
    """The score that parts good from bad labelled rows with the fewest errors (rates count)."""
    if not len(ids) or good.min() == good.max():
        return 0.0
    sample = scored.sparkSession.sparkContext.broadcast(ids)

    @F.pandas_udf("boolean")
    def known(values: pd.Series) -> pd.Series:
        return pd.Series(find(sample.value, values.fillna(-1).to_numpy(np.int64))[1], index=values.index)

    got = scored.where(known(F.col(key))).groupBy(key).agg(F.first("score").alias("score")).toPandas()  # at most the sample
    if got.empty:
        return 0.0
    score = got["score"].to_numpy()
    label = good[find(ids, got[key].to_numpy(np.int64))[0]] > 0
    if label.all() or not label.any():
        return 0.0
    order = np.argsort(score)
    score, label = score[order], label[order]
    errors = np.append(0, np.cumsum(label)) / label.sum() + np.append(np.cumsum((~label)[::-1])[::-1], 0) / (~label).sum()
    best = np.flatnonzero(errors <= errors.min() + 1e-12)
    i = int(best[0])
    if i == 0:
        return float(score[0]) - 1e-9
    return float(score[i - 1] + score[min(i, len(score) - 1)]) / 2


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the documents that the resample leaves out; a null id always stays."""
    scored = score_documents(docs, labels, key=key, **options)
    return drop_rows(docs, settle(scored.where("not kept").select(key)), key)
