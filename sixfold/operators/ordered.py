"""Ordered windows (row number, previous, next, last seen, first, running sum) that survive a hot key.

A plain ``Window.partitionBy(key).orderBy(t)`` sorts every row of one key in one task. Here a key that holds more than its
share of the rows is cut along the whole order into chunks; the window runs per (key, chunk), and one small row per chunk
carries the value over each cut:

* hot keys: more than a share, ``max(hot_rows, total / MAX_HOT_KEYS)`` rows, so there are fewer than ``MAX_HOT_KEYS`` of them;
* cuts: places of sampled rows, ``CUTS`` for each share of rows that a key holds. A place is the row's values in all order columns,
  so rows of one time are cut apart by the columns after it; only rows that are equal in all of them stay in one chunk;
* carries: one row per chunk of a hot key.

Counts and sample come from one read of the key and order columns: rows of a key are counted together, sampled ones one by one. A key
holds ``CUTS`` cuts per share, so both side tables have at most ``2 * CUTS * MAX_HOT_KEYS`` entries whatever the data holds. The cuts
are narrow and are broadcast, in blocks of ``BLOCK``, so that no row meets more than that many; the carries hold whole values, so Spark
measures them and chooses. Everything that decides a row's chunk (counts, a sample chosen by hash) is the same however often and in
whatever order tasks run, so the branches of the plan and repeated tasks agree. Keys that are not hot keep the plain window, and with
no hot key at all adaptive execution drops the extra branches as empty.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOT_ROWS = 1_000_000
MAX_HOT_KEYS = 8192
#: Cuts, and sampled rows, for each share of rows of a hot key.
CUTS, SAMPLE = 2, 32
#: Cuts of one block, a power of two; its square is at least ``CUTS * MAX_HOT_KEYS``.
BLOCK = 128
FLOOR = -1.0e300


def position(df: DataFrame, name: str) -> Column:
    """The order column as a DOUBLE that never decreases along the order; NULL sorts first."""
    kind = df.schema[name].dataType
    column = F.col(name)
    if isinstance(kind, T.TimestampNTZType):
        value = (column - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).cast("decimal(20,6)").cast("double")
    elif isinstance(kind, T.TimestampType):
        value = F.unix_micros(column).cast("double")
    elif isinstance(kind, T.DateType):
        value = F.unix_date(column).cast("double")
    elif isinstance(kind, (T.NumericType, T.BooleanType)):
        value = column.cast("double")
    else:
        raise TypeError(f"the first order column must be numeric, date or timestamp, {name} is {kind.simpleString()}")
    return F.greatest(value, F.lit(FLOOR))


def same_key(left: Iterable[Column], right: Iterable[Column]) -> Column:
    """Null-safe equality over two key lists."""
    condition = F.lit(True)
    for a, b in zip(left, right):
        condition = condition & a.eqNullSafe(b)
    return condition


def _hot_cuts(df: DataFrame, keys: list[str], order: list[str], place: Column, hot_rows: int) -> DataFrame:
    """One row per hot key: the rising places where it is cut."""
    hot_keys = [f"_hot_{k}" for k in keys]
    sampled = F.pmod(F.xxhash64(*order), F.lit(max(1, hot_rows // SAMPLE))) == 0
    picked = df.select(*[F.col(k).alias(h) for k, h in zip(keys, hot_keys)], F.when(sampled, F.struct(place.alias("place"))).alias("_at"))
    # Places that are equal count once: they cannot be cut.
    counts = picked.groupBy(*hot_keys, "_at").agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_total"))
    share = F.greatest(F.lit(float(hot_rows)), total.scalar() / float(MAX_HOT_KEYS))
    hot = counts.groupBy(*hot_keys).agg(F.sum("_n").alias("_rows")).withColumn("_share", share).where("_rows > _share")
    hot = hot.select(*[F.col(h).alias(f"_of{h}") for h in hot_keys], "_rows", "_share")
    on_key = same_key([F.col(h) for h in hot_keys], [F.col(f"_of{h}") for h in hot_keys])
    # Where a share is more than ``hot_rows``, the sample is thinned by as much.
    thinned = F.expr(f"_n > 0 AND pmod(xxhash64(_at, 1), floor(_share / {hot_rows})) = 0")
    lines = counts.join(F.broadcast(hot), on_key).groupBy(*hot_keys, "_rows", "_share").agg(F.collect_list(F.when(thinned, F.col("_at"))).alias("_sample"))
    kept = [f"`{h}`" for h in hot_keys]
    line = "transform(sort_array(_sample), s -> s.place) AS _line"
    many = f"least(ceil({CUTS} * _rows / _share), size(_sample)) AS _m"
    spread = "transform(sequence(1, greatest(_m, 1)), i -> get(_line, cast(floor((i - 0.5) * size(_line) / _m) AS int)))"
    return lines.selectExpr(*kept, line, many).selectExpr(*kept, f"if(_m > 0, {spread}, _line) AS _cuts")


def _at_or_before(cuts: str, out: str) -> list[str]:
    """Expressions, each over the ones before, for how many of at most ``BLOCK`` rising cuts a place has reached, by halving."""
    steps, at, step = [f"0 AS {out}_0"], 0, BLOCK
    while step:
        before, at = at, at + 1
        steps.append(f"{out}_{before} + if(get({cuts}, {out}_{before} + {step - 1}) <= _place, {step}, 0) AS {out if step == 1 else f'{out}_{at}'}")
        step //= 2
    return steps


def _with_chunk(df: DataFrame, keys: list[str], cuts: DataFrame, place: Column, how: str) -> DataFrame:
    """Add the chunk number within a hot key; it rises with the place. Other rows get NULL (left) or are dropped (inner)."""
    hot_keys = [f"_hot_{k}" for k in keys]
    of = [F.col(k) for k in keys]
    kept = [f"`{c}`" for c in df.columns]
    firsts = f"transform(sequence(1, greatest(1, ceil(size(_cuts) / {BLOCK}) - 1)), b -> get(_cuts, cast(b * {BLOCK} AS int))) AS _firsts"
    coarse = cuts.selectExpr(*[f"`{h}`" for h in hot_keys], firsts)
    parts = f"transform(sequence(0, greatest(0, ceil(size(_cuts) / {BLOCK}) - 1)), b -> struct(cast(b AS int) AS b, slice(_cuts, cast(b * {BLOCK} + 1 AS int), {BLOCK}) AS c))"
    fine = cuts.selectExpr(*[f"`{h}` AS `_fine{h}`" for h in hot_keys], f"inline({parts}) AS (_b, _block)")
    found = df.withColumn("_place", place).join(F.broadcast(coarse), same_key(of, [F.col(h) for h in hot_keys]), how)
    found = found.selectExpr(*kept, "_place", "_firsts IS NOT NULL AS _is_hot", *_at_or_before("_firsts", "_part"))
    found = found.select(*[F.col(c) for c in df.columns], "_place", F.expr("if(_is_hot, _part, null)").alias("_part"))
    on_part = same_key(of, [F.col(f"_fine{h}") for h in hot_keys]) & (F.col("_part") == F.col("_b"))
    found = found.join(F.broadcast(fine), on_part, how)
    return found.selectExpr(*kept, "_part", *_at_or_before("_block", "_in")).selectExpr(*kept, f"_part * {BLOCK} + _in AS _chunk")


def with_ordered(
    df: DataFrame,
    keys: Iterable[str],
    order: Iterable[str],
    *,
    row_number: str | None = None,
    previous: Mapping[str, str] | None = None,
    following: Mapping[str, str] | None = None,
    last_seen: Mapping[str, str] | None = None,
    first: Mapping[str, str] | None = None,
    running_sum: Mapping[str, str] | None = None,
    key_sum: Mapping[str, str] | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add ordered columns per key, ascending with NULLs first.

    ``row_number`` names the 1-based number. The mappings give ``{new column: source column}``: ``previous`` / ``following`` are
    LAG / LEAD by one, ``last_seen`` the latest non-null value up to and including the row, ``first`` the value of the first row,
    ``running_sum`` the sum up to and including the row, ``key_sum`` the sum over the whole key. ``order`` should end in a unique
    column, or ties are numbered at random. ``hot_rows=None`` takes the plain window: only for groups whose size is bounded by construction.
    """
    keys, order = list(keys), list(order)
    previous, following, last_seen = dict(previous or {}), dict(following or {}), dict(last_seen or {})
    first, running_sum, key_sum = dict(first or {}), dict(running_sum or {}), dict(key_sum or {})
    kept = df.columns
    if not keys:
        # Always 0, but no constant: the joins below keep a key to join on.
        df, keys = df.withColumn("_all", F.pmod(F.xxhash64(order[0]), F.lit(1))), ["_all"]

    split = hot_rows is not None
    if split:
        place = F.struct(position(df, order[0]).alias("number"), *[F.col(c).alias(f"at_{i}") for i, c in enumerate(order)])
        cuts = _hot_cuts(df, keys, order, place, hot_rows)
        hot = _with_chunk(df, keys, cuts, place, "inner")
        df = _with_chunk(df, keys, cuts, place, "left")
        per_key = Window.partitionBy(*keys, "_chunk")
    else:
        per_key = Window.partitionBy(*keys)

    asc = [F.col(c).asc_nulls_first() for c in order]
    window = per_key.orderBy(*asc)
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    columns: dict[str, Column] = {}
    if row_number or (split and (previous or first)):
        columns["_rn"] = F.row_number().over(window).cast("bigint")
    for out, source in previous.items():
        columns[out] = F.lag(source).over(window)
    for out, source in following.items():
        columns[out] = F.lead(source).over(window)
    for out, source in last_seen.items():
        columns[out] = F.last(source, ignorenulls=True).over(so_far)
    for out, source in first.items():
        columns[out] = F.first(source).over(so_far)
    for out, source in running_sum.items():
        columns[out] = F.sum(source).over(so_far)
    for out, source in key_sum.items():
        columns[out] = F.sum(source).over(per_key)
    if split and following:
        columns["_is_last"] = F.lead(F.lit(1)).over(window).isNull()
    result = df.select("*", *[c.alias(out) for out, c in columns.items()])
    if split:
        result = _stitch(result, hot, keys, order, previous, following, last_seen, first, running_sum, key_sum, row_number)
    elif row_number:
        result = result.withColumn(row_number, F.col("_rn"))
    outputs = [row_number] if row_number else []
    outputs += [*previous, *following, *last_seen, *first, *running_sum, *key_sum]
    return result.select(*[c for c in kept if c not in outputs], *outputs)


def _stitch(result, hot_rows, keys, order, previous, following, last_seen, first, running_sum, key_sum, row_number) -> DataFrame:
    """Carry values over the cuts between the chunks of the hot keys."""
    at = F.struct(*order)
    ends = [F.count(F.lit(1)).alias("_n")]
    if previous:
        ends.append(F.max_by(F.struct(*sorted(set(previous.values()))), at).alias("_end"))
    if following or first:
        ends.append(F.min_by(F.struct(*sorted({*following.values(), *first.values()})), at).alias("_start"))
    for source in sorted(set(last_seen.values())):
        ends.append(F.max_by(source, F.when(F.col(source).isNotNull(), at)).alias(f"_seen_{source}"))
    for source in sorted({*running_sum.values(), *key_sum.values()}):
        ends.append(F.sum(source).alias(f"_sum_{source}"))
    # One row per chunk of a hot key: a bounded table, so its windows per key are bounded too.
    chunks = hot_rows.groupBy(*keys, "_chunk").agg(*ends)
    line = Window.partitionBy(*keys).orderBy("_chunk")
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    carried = [*[F.col(k).alias(f"_carry_{k}") for k in keys], F.col("_chunk").alias("_carry_chunk")]
    if row_number:
        carried.append(F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_rows_before"))
    for out, source in previous.items():
        carried.append(F.lag(F.col("_end")[source]).over(line).alias(f"_c_{out}"))
    for out, source in following.items():
        carried.append(F.lead(F.col("_start")[source]).over(line).alias(f"_c_{out}"))
    for out, source in last_seen.items():
        carried.append(F.last(f"_seen_{source}", ignorenulls=True).over(before).alias(f"_c_{out}"))
    for out, source in first.items():
        carried.append(F.first(F.col("_start")[source]).over(line).alias(f"_c_{out}"))
    for out, source in running_sum.items():
        carried.append(F.sum(f"_sum_{source}").over(before).alias(f"_c_{out}"))
    for out, source in key_sum.items():
        carried.append(F.sum(f"_sum_{source}").over(Window.partitionBy(*keys)).alias(f"_c_{out}"))
    carry = chunks.select(*carried)
    on_chunk = same_key([F.col(k) for k in keys], [F.col(f"_carry_{k}") for k in keys]) & (F.col("_chunk") == F.col("_carry_chunk"))
    result = result.join(carry, on_chunk, "left")  # its rows are bounded, its bytes are not: Spark measures it

    hot = F.col("_chunk").isNotNull()
    fixed: dict[str, Column] = {}
    if row_number:
        fixed[row_number] = F.col("_rn") + F.coalesce(F.col("_rows_before"), F.lit(0))
    for out in previous:
        fixed[out] = F.when(hot & (F.col("_rn") == 1), F.col(f"_c_{out}")).otherwise(F.col(out))
    for out in following:
        fixed[out] = F.when(hot & F.col("_is_last"), F.col(f"_c_{out}")).otherwise(F.col(out))
    for out in last_seen:
        fixed[out] = F.coalesce(F.col(out), F.col(f"_c_{out}"))
    for out in first:
        fixed[out] = F.when(hot, F.col(f"_c_{out}")).otherwise(F.col(out))
    for out in running_sum:
        carried_sum = F.col(f"_c_{out}")
        fixed[out] = F.when(carried_sum.isNull(), F.col(out)).otherwise(carried_sum + F.coalesce(F.col(out), carried_sum - carried_sum))
    for out in key_sum:
        fixed[out] = F.when(hot, F.col(f"_c_{out}")).otherwise(F.col(out))
    return result.withColumns(fixed)


def stride_sample(df: DataFrame, n: int, keys: Iterable[str], order: Iterable[str], hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Every n-th row per key along the order, starting with the first."""
    numbered = with_ordered(df, keys, order, row_number="_stride", hot_rows=hot_rows)
    return numbered.where((F.col("_stride") - 1) % n == 0).drop("_stride")
