"""Order-dependent work without putting a whole group into one task.

Row numbers and running totals sort the rows over all tasks by sampled ranges, write them, and
carry one aggregate per range; a group may be of any size and its order values of any spread.
Exact ranks and running maxima go by buckets: rows fall into buckets by a fixed,
order-preserving function of the sort key, a small table holds an aggregate per bucket, and a
window runs inside each bucket only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palisade.session import scratch_path, settled

# Narrow rows of a group that one task sums; larger groups are cut into ranges.
GROUP_ROWS = 100_000
# Rows of a range that one window takes.
RUN_ROWS = 4096
# Buckets per unit of the logarithm: each spans 1.6 % of its values.
LOG_STEPS = 64
# Parts each such bucket is cut into at the second level.
FINE_STEPS = 4096


def log_position(value: Column) -> Column:
    """A non-decreasing function of a double, between -1500 and 1500."""
    size = F.lit(746.0) + F.ln(F.abs(value))
    return F.when(value > 0, size).when(value < 0, -size).otherwise(F.lit(0.0))


def coarse_bucket(value: Column) -> Column:
    """Order-preserving bucket; at most 200,000 of them whatever the data.

    Never null, so that joins on it add no null test below an exchange they could share.
    """
    return F.coalesce(F.floor(log_position(value) * LOG_STEPS), F.lit(0))


def fine_bucket(value: Column) -> Column:
    scaled = log_position(value) * LOG_STEPS
    return F.coalesce(F.floor((scaled - F.floor(scaled)) * FINE_STEPS), F.lit(0))


def sorted_by_range(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The rows sorted over all tasks, with `_place`: its upper bits count the range a row fell into,
    the lower 33 the rows before it there.

    They are written to the shared folder, as ranges are sampled anew each time they are asked for.
    Equal keys are told apart by the order they are read in, so a run of them spreads too.
    """
    path = scratch_path(df.sparkSession, name)
    order = [*keys, "_tie"]
    (
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("_tie")
        .withColumn("_place", F.monotonically_increasing_id())
        .write.parquet(path)
    )
    schema = df.withColumn("_place", F.lit(0).cast("long")).schema
    return df.sparkSession.read.schema(schema).parquet(path)


def running_total(
    df: DataFrame,
    group: str,
    order: str,
    amount: str,
    out: str,
    width: int = RUN_ROWS,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Sum of `amount` over the rows of the group that come before this one.

    `order` is unique within the group.  (group, order, amount) are written first and alone, as
    narrow rows.  Groups of up to `GROUP_ROWS` are summed as they are; where there is a larger one, the
    narrow rows are sorted by range, and totals are carried from range to range, and inside a range
    from one run of `width` rows (a power of two) to the next, so no task sees more than a range of
    any group.  The sums then meet the rows by (group, order).
    """
    path = scratch_path(df.sparkSession, "amounts")
    narrow = df.select(F.col(group).alias("_group"), F.col(order).alias("_order"), F.col(amount).alias("_amount"))
    narrow.write.parquet(path)
    narrow = df.sparkSession.read.schema(narrow.schema).parquet(path)
    largest = narrow.groupBy("_group").count().agg(F.max("count")).first()[0] or 0
    if largest <= group_rows:
        before = Window.partitionBy("_group").orderBy("_order").rowsBetween(Window.unboundedPreceding, -1)
        summed = narrow.select(
            "_group", "_order", F.coalesce(F.sum("_amount").over(before), F.lit(0)).alias("_sum")
        )
    else:
        summed = _total_by_range(narrow, width)
    same = F.col(group).eqNullSafe(F.col("_group")) & F.col(order).eqNullSafe(F.col("_order"))
    return df.join(summed, same).withColumn(out, F.col("_sum")).drop("_group", "_order", "_sum")


def _total_by_range(narrow: DataFrame, width: int) -> DataFrame:
    """(_group, _order, _sum) of (_group, _order, _amount), whatever the groups."""
    placed = sorted_by_range(narrow, ["_group", "_order"], "running")
    part, run = F.shiftright("_place", 33), F.shiftright("_place", width.bit_length() - 1)
    placed = placed.withColumn("_run", run)
    before = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    runs = placed.groupBy("_group", part.alias("_part"), "_run").agg(F.sum("_amount").alias("_total"))
    parts = runs.groupBy("_group", "_part").agg(F.sum("_total").alias("_total"))
    from_parts = parts.select(
        F.col("_group").alias("_g"), F.col("_part").alias("_p"),
        F.sum("_total").over(before("_group").orderBy("_part")).alias("_earlier"),
    )
    carried = (
        runs.withColumn("_inside", F.sum("_total").over(before("_group", "_part").orderBy("_run")))
        .join(from_parts, F.col("_group").eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p")))
        .select(
            F.col("_group").alias("_g"), F.col("_run").alias("_r"),
            (F.coalesce("_inside", F.lit(0)) + F.coalesce("_earlier", F.lit(0))).alias("_carry"),
        )
    )
    within = F.sum("_amount").over(before("_group", "_run").orderBy("_place"))
    return (
        placed.withColumn("_within", F.coalesce(within, F.lit(0)))
        .join(settled(carried), F.col("_group").eqNullSafe(F.col("_g")) & (F.col("_run") == F.col("_r")))
        .select("_group", "_order", (F.col("_within") + F.col("_carry")).alias("_sum"))
    )


def numbered(
    df: DataFrame, group: list[str], order: list[str], out: str = "number", size: str | None = None
) -> DataFrame:
    """Number the rows of each group from 0 in the order of some columns, nulls first; `size`, if
    named, is the group's number of rows.

    Each range of the sorted rows brings one row a group to the carry: a group meets one row
    per range there, whatever its size, and a hot group or a run of equal keys spreads over tasks.
    Equal keys are numbered in the order they are read.  Columns `_tie` and `_place` are used.
    """
    rows = sorted_by_range(df, [*group, *order], "numbered")
    part = F.shiftright("_place", 33).alias("_part")
    names = [f"_group{i}" for i in range(len(group))]
    parts = rows.groupBy(*[F.col(g).alias(n) for g, n in zip(group, names)], part).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first")
    )
    whole = Window.partitionBy(*(names or [F.lit(0)]))
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select(
        *names,
        "_part",
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(whole).alias("_size"),
    )
    same = F.shiftright(rows["_place"], 33) == F.col("_part")
    for g, n in zip(group, names):
        same = same & F.col(g).eqNullSafe(F.col(n))
    found = rows.join(settled(carried), same).withColumn(out, F.col("_place") + F.col("_shift"))
    if size:
        found = found.withColumn(size, F.col("_size"))
    return found.drop(*names, "_part", "_shift", "_size", "_place")


def value_at_rank(
    df: DataFrame, group: str, value: str, fraction: float, out: str, weight: str | None = None
) -> DataFrame:
    """The group's value at 0-based index min(floor(n * fraction), n - 1), exactly.

    A histogram over coarse buckets, small whatever the data, tells which bucket holds
    the rank (this first pass runs at once).  Only that bucket's values are then counted
    and shuffled, and a finer bucket of them sorted.  Rows without a group or a value do
    not count; a row stands for `weight` rows, one if no column is named.
    """
    times = F.lit(1) if weight is None else F.col(weight)
    df = df.where(F.col(group).isNotNull() & F.col(value).isNotNull()).select(
        group, value, coarse_bucket(F.col(value)).alias("_coarse"), times.alias("_times")
    )
    size = F.sum("_n").over(Window.partitionBy(group))
    wanted = F.least(F.floor(size * F.lit(fraction)), size - 1)
    histogram = df.groupBy(group, "_coarse").agg(F.sum("_times").alias("_n"))
    coarse = _holding(histogram.withColumn("_rank", wanted), group, "_coarse")
    chosen = settled(coarse.select(group, "_coarse", "_rank"))
    counts = (
        df.join(chosen, [group, "_coarse"])
        .groupBy(group, "_rank", value)
        .agg(F.sum("_times").alias("_n"))
        .withColumn("_fine", fine_bucket(F.col(value)))
    )
    totals = counts.groupBy(group, "_rank", "_fine").agg(F.sum("_n").alias("_n"))
    fine = _holding(totals, group, "_fine").select(group, "_fine", "_rank")
    left = counts.drop("_rank").join(fine, [group, "_fine"])
    return _holding(left, group, value).select(group, F.col(value).alias(out))


def _holding(counts: DataFrame, group: str, order: str) -> DataFrame:
    """The row of each group in which `_rank` falls, `_rank` then counting from its start."""
    end = F.sum("_n").over(Window.partitionBy(group).orderBy(order))
    start = F.col("_end") - F.col("_n")
    return (
        counts.withColumn("_end", end)
        .where((F.col("_rank") < F.col("_end")) & (F.col("_rank") >= start))
        .withColumn("_rank", F.col("_rank") - start)
    )


def best_so_far(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keep the rows whose value exceeds every value at a strictly smaller key.

    One row per key comes in.  Rows fall into coarse buckets and these into fine ones, so that keys
    within one coarse bucket spread as well.  A fine bucket only keeps rows above the maximum of all
    buckets before it, which removes nearly all, and a window runs inside it.  A window over
    maxima meets 200,000 rows at most, or the 4,096 of one coarse bucket.
    """
    before = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn("_bucket", coarse_bucket(F.col(key))).withColumn("_fine", fine_bucket(F.col(key)))
    maxima = rows.groupBy("_bucket", "_fine").agg(F.max(value).alias("_max"))
    coarse = maxima.groupBy("_bucket").agg(F.max("_max").alias("_max"))
    earlier = coarse.select("_bucket", F.max("_max").over(before(F.lit(0)).orderBy("_bucket")).alias("_earlier"))
    inside = F.max("_max").over(before("_bucket").orderBy("_fine"))
    carried = maxima.withColumn("_inside", inside).join(earlier, "_bucket").select(
        "_bucket", "_fine", F.greatest("_inside", "_earlier").alias("_carry")
    )
    kept = rows.join(carried, ["_bucket", "_fine"]).where(
        F.col("_carry").isNull() | (F.col(value) > F.col("_carry"))
    )
    return (
        kept.withColumn("_seen", F.max(value).over(before("_bucket", "_fine").orderBy(key)))
        .where(F.col("_seen").isNull() | (F.col(value) > F.col("_seen")))
        .drop("_bucket", "_fine", "_carry", "_seen")
    )
