"""Order-based columns over long tracks without putting a track into one task.

A window over ``(session ORDER BY time)`` would send one vehicle's whole history to one task.
Here :func:`cut` first deals every track into parts of about equal row count, however the rows
lie in time, and :func:`scan` works out what each part inherits. The rows are shuffled once, by
part. Within a part ordinary windows run; the first and last row of each part, two rows with
what was found in between, are the summary that a small window per key scans; its result is
joined back to the part, which is already where it belongs. One scan yields neighbours, columns
derived from them, running sums, last and next known values together; several scans over
rows that were cut once share the shuffle.

The first order column must be a BIGINT. Rows of a key that share its value stay in one part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from kerbline.session import settle

KEY = "__part_key"
PART_ROWS = 1_000_000
FIRST, LAST = "__first", "__last"
AT, START, N, PART = "__at", "__start", "__n", "__part_no"
#: Bins per part on the first count, and how much finer the bins of a dense one are.
BINS_PER_PART, FINER_BITS = 8, 6


def _same(left: list[Column], right: list[Column]) -> Column:
    out = F.lit(True)
    for a, b in zip(left, right, strict=True):
        out = out & a.eqNullSafe(b)
    return out


def match(df: DataFrame, other: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, null with null; the keys of ``other`` are dropped."""
    right = other.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = _same([F.col(k) for k in keys], [F.col(f"__r_{k}") for k in keys])
    return df.join(right, on, how).drop(*[f"__r_{k}" for k in keys])


def _bin(bits: int) -> Column:
    return F.col(AT) - F.pmod(F.col(AT), F.lit(1 << bits))


def _counts(df: DataFrame, by: list[str], order: list[str], part_rows: int) -> list[tuple[int, DataFrame]]:
    """Row counts per key and bin of time, as (bits of the bin width, counts), coarse to fine.

    Bins above ``part_rows`` rows are counted again in finer ones until none is left or a bin
    is one value wide. Only counts are kept; each finer round reads the rows of dense bins.
    """
    seen = df.select(*by, F.col(order[0]).cast("long").alias(AT)).where(F.col(AT).isNotNull())
    rows, low, high = seen.agg(F.count(F.lit(1)), F.min(AT), F.max(AT)).first()
    parts = max(1, -(-rows // part_rows))
    bits = max((high - low) // (BINS_PER_PART * parts), 1).bit_length() if rows else 0
    levels = []
    while True:
        most = Observation()
        counts = seen.groupBy(*by, _bin(bits).alias(START)).agg(F.count(F.lit(1)).alias(N))
        counts = settle(counts.observe(most, F.max(N).alias("n")))
        levels.append((bits, counts))
        if bits == 0 or (most.get["n"] or 0) <= part_rows:
            return levels
        dense = counts.where(F.col(N) > part_rows)
        coarse = dense.select(*[F.col(c).alias(f"__d_{c}") for c in (*by, START)])
        here = [*[F.col(c) for c in by], _bin(bits)]
        seen = seen.join(coarse, _same(here, [F.col(f"__d_{c}") for c in (*by, START)]), "left_semi")
        bits = max(0, bits - FINER_BITS)


def cut(df: DataFrame, by: list[str], order: list[str], part_rows: int = PART_ROWS) -> DataFrame:
    """``df`` dealt into parts of at most about ``2 * part_rows`` rows; rows that are cut stay as they are.

    Adds the column ``KEY``, a struct of ``by`` and the part's number, which ascends with the
    order. A key with few rows is one part; a busy stretch of a key is cut as finely as its
    rows demand. The row counts are taken when this is called.
    """
    if KEY in df.columns:
        return df
    levels = _counts(df, by, order, part_rows)
    leaves = None
    for i, (_, counts) in enumerate(levels):
        own = counts if i == len(levels) - 1 else counts.where(F.col(N) <= part_rows)
        own = own.withColumn("__level", F.lit(i))
        leaves = own if leaves is None else leaves.unionByName(own)
    before = F.sum(N).over(Window.partitionBy(*by).orderBy(START)) - F.col(N)
    dealt = leaves.withColumn(PART, F.floor((before + F.col(N) / 2) / part_rows))
    rows, found = df.withColumn(AT, F.col(order[0]).cast("long")), []
    for i, (bits, _) in enumerate(levels):
        mine = dealt.where(F.col("__level") == i).select(
            *[F.col(c).alias(f"__{i}_{c}") for c in (*by, START)], F.col(PART).alias(f"{PART}{i}"))
        keys = [*[F.col(c) for c in by], _bin(bits)]
        rows = rows.join(mine, _same(keys, [F.col(f"__{i}_{c}") for c in (*by, START)]), "left")
        found.append(F.col(f"{PART}{i}"))
    part = F.coalesce(*found, F.lit(-1)).cast("long").alias("part")
    return rows.select(*df.columns, F.struct(*by, part).alias(KEY)).repartition(KEY)


def _within(rows: DataFrame, by: list[str]) -> list[str]:
    """What an ordinary window may hold together: the part, and keys added since the cut."""
    known = rows.schema[KEY].dataType.names
    return [KEY, *[c for c in by if c not in known]]


def _inherit(rows: DataFrame, base: DataFrame, within: list[str]) -> DataFrame:
    """``rows`` with the columns of ``base``, one row per part."""
    base = base.withColumnsRenamed({c: f"__j_{c}" for c in within})
    on = F.col(KEY) == F.col(f"__j_{KEY}")  # a struct is never null
    return rows.join(base, on & _same([F.col(c) for c in within[1:]], [F.col(f"__j_{c}") for c in within[1:]]), "left")


def _line(by: list[str]):
    """The summary rows of a key in order."""
    return Window.partitionBy(*by).orderBy(F.col(KEY)["part"], F.desc(FIRST))


def _upto(window):
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _known_ahead(column: str, keys: list[str], order: list[str]) -> Column:
    """The next value that is not null, after the row itself."""
    spread = f"PARTITION BY {', '.join(f'`{k}`' for k in keys)} " if keys else ""
    return F.expr(f"lead(`{column}`, 1) IGNORE NULLS OVER ({spread}ORDER BY {', '.join(order)})")


def scan(df: DataFrame, by: list[str], order: list[str], prev: dict[str, Column] | None = None,
         following: dict[str, Column] | None = None, derive: dict[str, Column] | None = None,
         sums: dict[str, Column] | None = None, last: dict[str, Column] | None = None,
         ahead: dict[str, Column] | None = None, totals: dict[str, str] | None = None,
         part_rows: int = PART_ROWS) -> DataFrame:
    """Add columns that follow the order of each key, all in one pass.

    ``prev`` and ``following`` are values of the neighbour rows; ``derive`` may use ``prev``;
    ``sums`` are inclusive running sums (null counts as zero), ``last`` the latest non-null
    value up to the row, both of expressions that may use ``prev`` and ``derive``; ``ahead`` is
    the first non-null value from the row on; ``totals`` names the sums' values over the key.
    """
    prev, following, derive, sums = prev or {}, following or {}, derive or {}, sums or {}
    last, ahead, totals = last or {}, ahead or {}, totals or {}
    rows = cut(df, by, order, part_rows)
    within = _within(rows, by)
    here = Window.partitionBy(*within).orderBy(*order)
    local = rows.withColumns({
        FIRST: F.lag(F.lit(1)).over(here).isNull(), LAST: F.lead(F.lit(1)).over(here).isNull(),
        **{n: F.lag(c).over(here) for n, c in prev.items()},
        **{n: F.lead(c).over(here) for n, c in following.items()},
        **{f"__v_{n}": c for n, c in ahead.items()},
    })
    local = _derived(local, derive)
    # the first row's share is not known yet: it depends on the part before
    inner = {f"__s_{n}": F.sum(F.when(~F.col(FIRST), c)).over(_upto(here)) for n, c in sums.items()}
    inner |= {f"__l_{n}": F.last(F.when(~F.col(FIRST), c), ignorenulls=True).over(_upto(here)) for n, c in last.items()}
    inner |= {f"__a_{n}": F.coalesce(F.col(f"__v_{n}"), _known_ahead(f"__v_{n}", within, [f"`{c}`" for c in order])) for n in ahead}
    local = local.withColumns(inner) if inner else local

    line = _line(by)
    ends = local.where(F.col(FIRST) | F.col(LAST))
    if prev:
        ends = ends.withColumns({n: F.when(F.col(FIRST), F.lag(c).over(line)) for n, c in prev.items()})
    ends = _derived(ends, derive)
    zero = F.lit(0)
    share = {n: F.coalesce(F.when(F.col(FIRST), c), zero) + F.coalesce(F.when(F.col(LAST), F.col(f"__s_{n}")), zero) for n, c in sums.items()}
    carried = {f"__b_{n}": F.col(n) for n in prev}
    carried |= {f"__b_{n}": F.when(F.col(LAST), F.lead(c).over(line)).otherwise(F.lead(c, 2).over(line)) for n, c in following.items()}
    carried |= {f"__b_{n}": F.sum(s).over(_upto(line)) for n, s in share.items()}
    carried |= {f"__b_{n}": F.sum(share[s]).over(Window.partitionBy(*by)) for n, s in totals.items()}
    carried |= {
        f"__b_{n}": F.last(F.coalesce(F.when(F.col(LAST), F.col(f"__l_{n}")), F.when(F.col(FIRST), c)), ignorenulls=True).over(_upto(line))
        for n, c in last.items()
    }
    ends = ends.withColumns({f"__f_{n}": F.when(F.col(FIRST), F.col(f"__a_{n}")) for n in ahead}) if ahead else ends
    carried |= {f"__b_{n}": _known_ahead(f"__f_{n}", by, [f"{KEY}.part", f"{FIRST} DESC"]) for n in ahead}
    base = ends.select(*within, FIRST, *[c.alias(n) for n, c in carried.items()]).where(FIRST).drop(FIRST)

    out = _inherit(local.drop(*derive), base, within)
    out = out.withColumns({
        **{n: F.when(F.col(FIRST), F.col(f"__b_{n}")).otherwise(F.col(n)) for n in prev},
        **{n: F.when(F.col(LAST), F.col(f"__b_{n}")).otherwise(F.col(n)) for n in following},
        **{n: F.col(f"__b_{n}") + F.coalesce(F.col(f"__s_{n}"), zero) for n in sums},
        **{n: F.coalesce(f"__l_{n}", f"__b_{n}") for n in last},
        **{n: F.coalesce(f"__a_{n}", f"__b_{n}") for n in ahead},
        **{n: F.col(f"__b_{n}") for n in totals},
    })
    return _derived(out, derive).select(*df.columns, *prev, *following, *derive, *sums, *last, *ahead, *totals)


def _derived(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    for name, value in columns.items():
        df = df.withColumn(name, value)
    return df


def neighbour(df: DataFrame, by: list[str], order: list[str], cols: dict[str, Column],
              part_rows: int = PART_ROWS, step: int = -1) -> DataFrame:
    """Add values of the previous (``step=-1``) or next (``step=1``) row of the same key."""
    if step < 0:
        return scan(df, by, order, prev=cols, part_rows=part_rows)
    return scan(df, by, order, following=cols, part_rows=part_rows)


def running_sum(df: DataFrame, by: list[str], order: list[str], cols: dict[str, Column],
                part_rows: int = PART_ROWS) -> DataFrame:
    """Add inclusive running sums; nulls count as zero."""
    return scan(df, by, order, sums=cols, part_rows=part_rows)


def row_index(df: DataFrame, by: list[str], order: list[str], name: str = "row_idx",
              part_rows: int = PART_ROWS, total: str | None = None) -> DataFrame:
    """Add the zero-based position in the key, and the key's row count as ``total``."""
    counted = scan(df, by, order, sums={name: F.lit(1)}, totals={total: name} if total else None, part_rows=part_rows)
    return counted.withColumn(name, (F.col(name) - 1).cast("long"))


def last_known(df: DataFrame, by: list[str], order: list[str], cols: dict[str, Column],
               part_rows: int = PART_ROWS, after: dict[str, Column] | None = None) -> DataFrame:
    """Add the latest non-null value up to each row, and the first one from it on for ``after``."""
    return scan(df, by, order, last=cols, ahead=after, part_rows=part_rows)


def running_max_before(df: DataFrame, by: list[str], order: list[str], cols: dict[str, Column],
                       part_rows: int = PART_ROWS) -> DataFrame:
    """Add the maximum over all earlier rows of the key (null on the first row)."""
    rows = cut(df, by, order, part_rows)
    within = _within(rows, by)
    here = Window.partitionBy(*within).orderBy(*order)
    earlier = here.rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumns({
        LAST: F.lead(F.lit(1)).over(here).isNull(),
        **{f"__m_{n}": F.max(c).over(earlier) for n, c in cols.items()},
    })
    before = Window.partitionBy(*by).orderBy(F.col(KEY)["part"]).rowsBetween(Window.unboundedPreceding, -1)
    base = local.where(LAST).select(*within, *[F.max(F.greatest(c, f"__m_{n}")).over(before).alias(f"__b_{n}") for n, c in cols.items()])
    return _inherit(local, base, within).select(*df.columns, *[F.greatest(f"__m_{n}", f"__b_{n}").alias(n) for n in cols])


def rolling_sum(df: DataFrame, by: list[str], order: list[str], cols: dict[str, Column], n: int,
                part_rows: int = PART_ROWS) -> DataFrame:
    """Add sums over the last ``n`` rows of the key (fewer at its beginning), the row included.

    Each part gets the last ``n - 1`` values before it; only its first rows look at them.
    """
    rows = cut(df, by, order, part_rows)
    within = _within(rows, by)
    here = Window.partitionBy(*within).orderBy(*order)
    back = Window.partitionBy(*within).orderBy(*[F.desc(c) for c in order])
    local = rows.withColumns({"__i": F.row_number().over(here), **{f"__v_{c}": v for c, v in cols.items()}})
    tails = local.withColumn("__tail", F.row_number().over(back)).where((F.col("__tail") < n) | (F.col("__i") == 1))
    line = Window.partitionBy(*by).orderBy(F.col(KEY)["part"], "__i").rowsBetween(-(n - 1), -1)
    halo = F.collect_list(F.struct(*[F.coalesce(f"__v_{c}", F.lit(0)).alias(c) for c in cols])).over(line)
    base = tails.select(*within, "__i", halo.alias("__halo")).where("__i = 1").drop("__i")
    near = here.rowsBetween(-(n - 1), Window.currentRow)
    local = local.withColumns({f"__s_{c}": F.sum(f"__v_{c}").over(near) for c in cols})
    local = _inherit(local, base, within)
    lacking = F.greatest(F.lit(n) - F.col("__i"), F.lit(0))
    rest = F.slice("__halo", F.greatest(F.size("__halo") - lacking + 1, F.lit(1)), lacking)

    def total(c: str) -> Column:
        extra = F.aggregate(rest[c], F.lit(0.0), lambda a, v: a + v)
        return F.coalesce(f"__s_{c}", F.lit(0.0)) + F.when(lacking > 0, extra).otherwise(F.lit(0.0))

    return local.select(*df.columns, *[total(c).alias(c) for c in cols])
