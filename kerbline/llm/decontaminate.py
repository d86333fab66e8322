"""Passages of benchmark items in documents: a prefix-filtered set join, in DataFrame functions only.

Items are cut into windows of ``window`` words, and a window is the set of its shingles (runs of
``shingle`` words, each at its place). A document can only hold a window that it holds every
shingle of, so one shingle of each window, its prefix, is all that has to be joined; the one
that is rarest in the documents is taken. What meets is bounded by place and length (the window
must begin and end inside the document) and then compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbline.session import settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LONGS = "array<bigint>"


@dataclass(frozen=True)
class Rule:
    """``portion`` rows of the benchmark side, of some hundred bytes each, are broadcast at once;
    a longer side takes more passes over the documents, each with a portion of its own."""

    window: int = 10
    shingle: int = 3
    portion: int = 100_000


def words_of(text: Column) -> Column:
    """Words of a text: A-Z in lower case, ASCII letters and digits and all else beyond ASCII."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, GAP), "")


def _count(words: Column, size: int) -> Column:
    return F.greatest(F.size(words) - (size - 1), F.lit(0))


def shingle_keys(words: Column, size: int) -> Column:
    """Hash of every run of ``size`` words, in order of its place."""

    def key(i: Column) -> Column:
        return F.xxhash64(*[F.get(words, i + j) for j in range(size)])

    n = _count(words, size)
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), key)).otherwise(F.expr(f"CAST(array() AS {LONGS})"))


def _portions(table: DataFrame, key: str, rule: Rule) -> Iterator[DataFrame]:
    """``table`` in parts of about ``rule.portion`` rows, by key, each marked for broadcast."""
    parts = max(1, -(-table.count() // rule.portion))
    for part in range(parts):
        yield F.broadcast(table if parts == 1 else table.where(F.pmod(F.col(key), F.lit(parts)) == part))


def _united(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def benchmark_windows(items: DataFrame, rule: Rule, item: str = "item_id", text: str = "text") -> DataFrame:
    """``window`` (its words with one space between), ``item``: each window of each item once."""
    words = items.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), words_of(F.col(text)).alias("w")).where(F.size("w") > 0)
    starts = words.select("item", "w", F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - (rule.window - 1), F.lit(1)))).alias("at"))
    return starts.select(F.array_join(F.slice("w", F.col("at"), rule.window), " ").alias("window"), "item").distinct()


def occurrences(docs: DataFrame, windows: DataFrame, rule: Rule, text: str = "text") -> DataFrame:
    """``docs``' columns but the text, with ``window, start, length`` of every place of a window.

    ``windows`` has one row per distinct ``window``. The rarity of shingles is counted over all
    documents. The documents are read where they lie and never shuffled.
    """
    rest = [c for c in docs.columns if c != text]
    split = windows.select("window", F.split("window", " ").alias("__w")).withColumn("__k", F.least(F.size("__w"), F.lit(rule.shingle)))
    sizes = sorted(r[0] for r in split.select("__k").distinct().collect())  # at most ``rule.shingle`` numbers
    if not sizes:
        nothing = docs.select(*rest).where(F.lit(False))
        return nothing.select(*rest, F.lit("").alias("window"), F.lit(0).alias("start"), F.lit(0).alias("length"))
    own = F.when(F.col("__k") == sizes[0], shingle_keys(F.col("__w"), sizes[0]))
    for size in sizes[1:]:
        own = own.when(F.col("__k") == size, shingle_keys(F.col("__w"), size))
    parts = settle(split.select("window", "__w", "__k", F.posexplode(own).alias("__offset", "__key")))

    words = docs.select(*rest, words_of(F.col(text)).alias("__words"))
    keys = shingle_keys(F.col("__words"), sizes[0])
    for size in sizes[1:]:
        keys = F.concat(keys, shingle_keys(F.col("__words"), size))
    met = words.select(*rest, "__words", F.posexplode(keys).alias("__i", "__key"))

    known = settle(parts.select("__key").distinct())
    counted = [met.select("__key").join(part, "__key").groupBy("__key").agg(F.count(F.lit(1)).alias("__n")) for part in _portions(known, "__key", rule)]
    rarity = settle(_united(counted))
    ranked = parts.join(rarity, "__key", "left")
    rarest = F.min_by(F.struct("__key", "__offset", "__k"), F.struct("__n", "__key", "__offset"))
    possible = (F.count("__n") == F.count(F.lit(1))).alias("__all")  # a window with a shingle that no document has is nowhere
    prefix = ranked.groupBy("window").agg(rarest.alias("__p"), possible).where("__all")
    prefix = settle(prefix.select("window", F.split("window", " ").alias("__w"), "__p.__key", "__p.__offset", "__p.__k"))

    n, place, before = F.size("__words"), F.lit(None).cast("int"), F.lit(0)
    for size in sizes:  # where in the words the i-th key stands, given the size that it was made for
        place = F.when(F.col("__k") == size, F.col("__i") - before).otherwise(place)
        before = before + _count(F.col("__words"), size)
    start, length = place - F.col("__offset"), F.size("__w")
    found = []
    for part in _portions(prefix, "__key", rule):
        inside = met.join(part, "__key").where((start >= 0) & (start + length <= n))
        same = inside.where(F.slice("__words", start + 1, length) == F.col("__w"))
        found.append(same.select(*rest, "window", start.alias("start"), length.alias("length")))
    return _united(found).distinct()


def contamination(docs: DataFrame, items: DataFrame, rule: Rule = Rule(), key: str = "doc_id", text: str = "text", item: str = "item_id") -> DataFrame:
    """One row per row of ``docs``: ``key, n_words, n_hit, items``.

    A window is ``rule.window`` consecutive words of an item, or the whole item if it has fewer
    but not none. ``n_hit`` counts the words of the document inside any window, ``items`` the
    ids, sorted as strings, of the items with a window in it.

    Null texts have no words; null item ids count as the empty string; repeated items, items
    with equal texts and repeated documents are each found for themselves. Empty tables give no
    rows, or documents without hits. Other columns are ignored.
    """
    rows = docs.select(F.col(key).alias("__id"), F.sha2(F.coalesce(text, F.lit("")), 256).alias("__text"), F.col(text).alias("__words_of"))
    windows = settle(benchmark_windows(items, rule, item, text))
    met = settle(occurrences(rows, windows.select("window").distinct(), rule, "__words_of"))
    same = ["__id", "__text"]
    spans = met.select(*same, "start", (F.col("start") + F.col("length")).alias("__end")).distinct()
    walk = Window.partitionBy(*same).orderBy("start", "__end").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.col("__end") - F.greatest("start", F.coalesce(F.max("__end").over(walk), F.lit(0))), F.lit(0))
    hits = spans.withColumn("__fresh", fresh).groupBy(*same).agg(F.sum("__fresh").alias("n_hit"))
    owners = met.select(*same, "window").distinct().join(windows, "window").select(*same, "item").distinct()
    listed = owners.groupBy(*same).agg(F.array_sort(F.collect_list("item")).alias("items"))
    plain = rows.select(*same, F.size(words_of(F.col("__words_of"))).cast("long").alias("n_words"))
    out = _joined(plain, _joined(hits, listed, same), same, "left")
    return out.select(F.col("__id").alias(key), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.expr("CAST(array() AS array<string>)")).alias("items"))


def _joined(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, null with null."""
    right = right.withColumnsRenamed({k: f"__r{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__r{k}"))
    return left.join(right, same, how).drop(*[f"__r{k}" for k in keys])
