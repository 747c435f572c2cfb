"""Verdicts against labels: counts, rates, latency, misses and exports.

A verdict table is (setup, case_id, text, expected, actual, latency_ms, error).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palisade.functions.formatting import fixed, milliseconds, percent, rounded
from palisade.functions.text import cut
from palisade.operators.ordering import value_at_rank
from palisade.session import scratch_path


def ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where there is nothing to divide by."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _counts() -> dict[str, Column]:
    expected, actual = F.col("expected"), F.col("actual")
    return {
        "total": F.count("*"),
        "tp": F.count_if(expected & actual),
        "fn": F.count_if(expected & ~actual),
        "fp": F.count_if(~expected & actual),
        "tn": F.count_if(~expected & ~actual),
        "blocked": F.count_if(actual),
        "correct": F.count_if(expected == actual),
        "errors": F.count_if(F.col("error").isNotNull()),
    }


def confusion(verdicts: DataFrame, by: str = "setup") -> DataFrame:
    """All counts of a set-up in one pass over its verdicts."""
    return verdicts.groupBy(by).agg(
        *[c.alias(n) for n, c in _counts().items()], F.avg("latency_ms").alias("avg_latency_ms")
    )


def with_rates(counts: DataFrame) -> DataFrame:
    precision = ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return counts.withColumns(
        {
            "accuracy": ratio(F.col("correct"), F.col("total")),
            "precision": precision,
            "recall": recall,
        }
    ).withColumn(
        "f1",
        ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
    )


def p95_latency(verdicts: DataFrame, by: str = "setup") -> DataFrame:
    return value_at_rank(verdicts, by, "latency_ms", 0.95, "p95_latency_ms")


def p95_latency_approx(verdicts: DataFrame, by: str = "setup") -> DataFrame:
    """One pass, approximate: for dashboards over very large verdict tables."""
    return verdicts.groupBy(by).agg(
        F.percentile_approx("latency_ms", 0.95, 10_000).alias("p95_latency_ms")
    )


def eval_metrics(verdicts: DataFrame, by: str = "setup") -> DataFrame:
    """Counts, accuracy, precision, recall, F1, mean and p95 latency per set-up.

    The verdicts are worked out once: counted per latency value, written to the shared folder, and
    all numbers are taken from those counts, the exact p95 too.
    """
    counted = verdicts.groupBy(by, "latency_ms").agg(*[c.alias(n) for n, c in _counts().items()])
    path = scratch_path(verdicts.sparkSession, "verdict-counts")
    counted.write.parquet(path)
    counted = verdicts.sparkSession.read.schema(counted.schema).parquet(path)
    timed = F.col("latency_ms").isNotNull()
    mean = F.try_divide(
        F.sum(F.col("latency_ms") * F.col("total")), F.sum(F.when(timed, F.col("total"))).cast("double")
    )
    sums = counted.groupBy(by).agg(
        *[F.sum(n).alias(n) for n in _counts()], mean.alias("avg_latency_ms")
    )
    p95 = value_at_rank(counted, by, "latency_ms", 0.95, "p95_latency_ms", "total")
    return with_rates(sums).join(p95, by, "left")


def rounded_metrics(metrics: DataFrame, by: str = "setup") -> DataFrame:
    names = ["accuracy", "precision", "recall", "f1"]
    return metrics.select(
        by,
        "total",
        "tp",
        "fn",
        "fp",
        "tn",
        *[rounded(F.col(n), 4).alias(n) for n in names],
        rounded(F.col("avg_latency_ms"), 4).alias("avg_latency_ms"),
        "p95_latency_ms",
    )


def misses(verdicts: DataFrame, cut_at: int = 80) -> DataFrame:
    return verdicts.where(F.col("expected") != F.col("actual")).select(
        "setup",
        "case_id",
        F.when(F.col("expected"), F.lit("FN")).otherwise(F.lit("FP")).alias("label"),
        cut(F.col("text"), cut_at).alias("text"),
    )


def top_misses(verdicts: DataFrame, shown: int = 8) -> DataFrame:
    """The first misses of each set-up and how many more there are.

    The rank limit is applied before the shuffle, and the total is a plain count, so a
    set-up with very many misses is not gathered in one task.
    """
    missed = misses(verdicts)
    order = Window.partitionBy("setup").orderBy("case_id")
    first = missed.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= shown)
    totals = missed.groupBy("setup").agg(F.count("*").alias("n_misses"))
    return first.join(totals, "setup").withColumn(
        "more", F.greatest(F.col("n_misses") - shown, F.lit(0))
    )


def case_balance(cases: DataFrame) -> DataFrame:
    return cases.groupBy("expected").agg(F.count("*").alias("n"))


def checked_cases(cases: DataFrame, should_block: int, should_pass: int) -> DataFrame:
    """The case table, failing when it is not the suite it is meant to be."""
    counts = {r["expected"]: r["n"] for r in case_balance(cases).collect()}
    found = (counts.get(True, 0), counts.get(False, 0))
    if found != (should_block, should_pass):
        raise ValueError(f"expected {should_block}/{should_pass} cases, found {found}")
    return cases


def first_cases(cases: DataFrame, n: int) -> DataFrame:
    """The first n cases by number, which starts at 0."""
    return cases.where(F.col("case_id") < n)


def select_setups(verdicts: DataFrame, wanted: list[str] | None, skipped: list[str]) -> DataFrame:
    out = verdicts.where(F.col("setup").isin(wanted)) if wanted else verdicts
    return out.where(~F.col("setup").isin(skipped)) if skipped else out


def threshold_sweep(scored: DataFrame, thresholds: list[float], by: str = "setup", score: str = "similarity") -> DataFrame:
    """Counts and rates at every threshold, from one pass over (by, expected, score).

    A case is counted once, in the bin between the thresholds its score lies between, with a null
    score below all; summing the bins from the highest down gives what each threshold blocks.  At a
    threshold is blocked; there are as many rows per group as thresholds, and never more cases in
    a task than one batch.  Cases without `expected` do not count.
    """
    steps = sorted(set(thresholds))
    if not steps:
        raise ValueError("a sweep needs a threshold")
    limits = F.array(*[F.lit(float(t)) for t in steps])
    passed = F.coalesce(F.size(F.filter(limits, lambda t: t <= F.col(score))), F.lit(0))
    rows = scored.where("expected is not null")
    bins = rows.groupBy(by, F.when(F.col(score).isNull(), 0).otherwise(passed).alias("_bin")).agg(
        F.count_if("expected").alias("_bad"), F.count_if(~F.col("expected")).alias("_good")
    )
    # every threshold has its row, also where no score lies between it and the next
    every = bins.select(by).distinct().select(by, F.explode(F.sequence(F.lit(0), F.lit(len(steps)))).alias("_bin"))
    empty = every.withColumns({"_bad": F.lit(0).cast("long"), "_good": F.lit(0).cast("long")})
    summed = bins.unionByName(empty).groupBy(by, "_bin").agg(F.sum("_bad").alias("_bad"), F.sum("_good").alias("_good"))
    whole = Window.partitionBy(by)
    above = whole.orderBy(F.desc("_bin"))
    counts = summed.select(
        by,
        "_bin",
        F.sum("_bad").over(above).alias("tp"),
        F.sum("_good").over(above).alias("fp"),
        F.sum("_bad").over(whole).alias("_all_bad"),
        F.sum("_good").over(whole).alias("_all_good"),
    ).where("_bin > 0")
    return with_rates(
        counts.select(
            by,
            F.get(limits, F.col("_bin") - 1).alias("threshold"),
            (F.col("_all_bad") + F.col("_all_good")).alias("total"),
            "tp",
            (F.col("_all_bad") - F.col("tp")).alias("fn"),
            "fp",
            (F.col("_all_good") - F.col("fp")).alias("tn"),
            (F.col("tp") + F.col("_all_good") - F.col("fp")).alias("correct"),
        )
    )


def best_threshold(sweep: DataFrame, by: str = "setup") -> DataFrame:
    """The row of the highest F1 of each group; ties go to the lowest threshold."""
    order = Window.partitionBy(by).orderBy(F.desc("f1"), "threshold")
    return sweep.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def summary_export(metrics: DataFrame) -> DataFrame:
    """The summary table as text, rates to four places and latencies to one."""
    return metrics.select(
        F.col("setup").alias("Setup"),
        fixed(F.col("accuracy"), 4).alias("Accuracy"),
        fixed(F.col("precision"), 4).alias("Precision"),
        fixed(F.col("recall"), 4).alias("Recall"),
        fixed(F.col("f1"), 4).alias("F1"),
        F.col("fn").alias("FalseNegatives"),
        F.col("fp").alias("FalsePositives"),
        fixed(F.col("avg_latency_ms"), 1).alias("AvgLatencyMs"),
        fixed(F.col("p95_latency_ms"), 1).alias("P95LatencyMs"),
    )


def detail_pivot(verdicts: DataFrame, setups: list[str]) -> DataFrame:
    """One row per case: a verdict and a latency column for each set-up."""
    wide = (
        verdicts.groupBy("case_id", "expected")
        .pivot("setup", setups)
        .agg(F.first("actual").alias("actual"), F.first("latency_ms").alias("ms"))
    )
    names = [F.col(f"{s}_actual").alias(s) for s in setups]
    times = [fixed(F.col(f"{s}_ms"), 1).alias(f"{s}_ms") for s in setups]
    return wide.select("case_id", "expected", *names, *times)


def format_metrics(metrics: DataFrame) -> DataFrame:
    return metrics.select(
        "setup",
        *[percent(F.col(n)).alias(n) for n in ("accuracy", "precision", "recall", "f1")],
        "fn",
        "fp",
        milliseconds(F.col("avg_latency_ms")).alias("avg"),
        milliseconds(F.col("p95_latency_ms")).alias("p95"),
    )


def report_lines(metrics: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The Markdown report as (section, setup, line_no, line): sort by these to print.

    Section 1 has one table row per set-up, section 2 one line per miss.
    """
    shown = format_metrics(metrics)
    rows = shown.select(
        F.lit(1).alias("section"),
        "setup",
        F.lit(0).cast("bigint").alias("line_no"),
        F.concat(
            F.lit("| "),
            F.concat_ws(
                " | ", "setup", "accuracy", "precision", "recall", "f1",
                F.col("fn").cast("string"), F.col("fp").cast("string"), "avg", "p95",
            ),
            F.lit(" |"),
        ).alias("line"),
    )
    missed = verdicts.where(F.col("expected") != F.col("actual")).select(
        F.lit(2).alias("section"),
        "setup",
        F.col("case_id").alias("line_no"),
        F.concat(
            F.when(F.col("expected"), F.lit("- 🔴 False Negative: *")).otherwise(
                F.lit("- 🟡 False Positive: *")
            ),
            F.col("text"),
            F.lit("*"),
        ).alias("line"),
    )
    return rows.unionByName(missed)


def gate_summary(audited: DataFrame, by: str) -> DataFrame:
    """Blocked, total and mean latency of an audited table."""
    return audited.groupBy(by).agg(
        F.count_if("blocked").alias("blocked"),
        F.count("*").alias("total"),
        rounded(F.avg("latency_ms"), 4).alias("avg_latency_ms"),
    )
