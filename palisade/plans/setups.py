"""Benchmarks: many gate set-ups, or many models' replies, over one case table."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palisade.fixed_values import BENCH_THRESHOLD, DEFAULT_ENTITIES
from palisade.functions import gates as G
from palisade.operators.scrub import mask_entities, scrub
from palisade.operators.semantic import best_topic


class Scrub(NamedTuple):
    """Substitute the patterns of a profile."""

    profile: str

    def apply(self, df: DataFrame, text: str, out: str) -> DataFrame:
        return scrub(df, self.profile, text, out)


class Mask(NamedTuple):
    """Mask structured entities."""

    entities: tuple[str, ...] = tuple(DEFAULT_ENTITIES)

    def apply(self, df: DataFrame, text: str, out: str) -> DataFrame:
        return mask_entities(df, list(self.entities), text=text, out=out)


class Rules(NamedTuple):
    """Block by keywords, then patterns, on the text as the steps before left it."""

    keywords: tuple[str, ...] = ()
    patterns: tuple[str, ...] = ()

    def blocks(self, text: Column, lowered: Column) -> Column:
        return G.keyword_hit(lowered, list(self.keywords)).isNotNull() | G.pattern_hit(text, list(self.patterns))


class Custom(NamedTuple):
    """Block by any (text, lower-cased text) -> boolean column."""

    run: Callable[[Column, Column], Column]

    def blocks(self, text: Column, lowered: Column) -> Column:
        return self.run(text, lowered)


class Vectors(NamedTuple):
    """Block what is as similar as this to a topic; a case without a vector passes."""

    threshold: float = BENCH_THRESHOLD

    def blocks(self, text: Column, lowered: Column) -> Column:
        return F.coalesce(F.col("similarity") >= self.threshold, F.lit(False))


Step = Scrub | Mask | Rules | Custom | Vectors


class Setup(NamedTuple):
    """A set-up in its usual form: an optional scrub profile, then keywords, then patterns.

    `run` replaces the rules by any (text, lower-cased text) -> boolean column.
    """

    keywords: list[str] = []
    patterns: list[str] = []
    profile: str | None = None
    run: Callable[[Column, Column], Column] | None = None

    @property
    def steps(self) -> list[Step]:
        first = [Scrub(self.profile)] if self.profile else []
        return [*first, Custom(self.run) if self.run else Rules(tuple(self.keywords), tuple(self.patterns))]


def setup_verdicts(
    cases: DataFrame,
    setups: dict[str, Setup | list[Step]],
    topics: DataFrame | None = None,
    vector: str = "vector",
) -> DataFrame:
    """Verdicts of every set-up over every case, from one read of the cases.

    `cases` is (case_id, text, expected, latency_ms), and `vector` where a set-up asks for it, with
    `topics` as in `best_topic`.  A set-up is a list of steps: those that change the text (Scrub, Mask)
    hand it on, those that block (Rules, Custom, Vectors) judge the text as it is by then, and the first to
    block decides.  Steps that several set-ups begin with are computed once a case, and so is the
    similarity; a case then becomes one row per set-up, which runs that set-up's gates only.
    """
    programs = {name: s.steps if isinstance(s, Setup) else list(s) for name, s in setups.items()}
    prepared, chains, lowered = cases, {(): "text"}, set()
    for steps in programs.values():
        chain = ()
        for step in steps:
            if isinstance(step, Scrub | Mask):
                before, chain = chain, (*chain, step)
                if chain not in chains:
                    chains[chain] = f"_text{len(chains)}"
                    prepared = step.apply(prepared, chains[before], chains[chain])
            elif not isinstance(step, Vectors) and chains[chain] not in lowered:
                lowered.add(chains[chain])
                prepared = prepared.withColumn(f"_low_{chains[chain]}", F.lower(chains[chain]))
    if any(isinstance(step, Vectors) for steps in programs.values() for step in steps):
        if topics is None:
            raise ValueError("a set-up with vectors needs topics")
        prepared = best_topic(prepared, topics, vector)
    rows = prepared.withColumn("setup", F.explode(F.array(*[F.lit(n) for n in setups])))
    actual = F.lit(None).cast("boolean")
    for name, steps in programs.items():
        chain, blocked = (), F.lit(False)
        for step in steps:
            if isinstance(step, Scrub | Mask):
                chain = (*chain, step)
            else:
                text = chains[chain]
                blocked = blocked | step.blocks(F.col(text), F.col(f"_low_{text}"))
        actual = F.when(F.col("setup") == name, blocked).otherwise(actual)
    return rows.select(
        "setup",
        "case_id",
        "text",
        "expected",
        "latency_ms",
        actual.alias("actual"),
        F.lit(None).cast("string").alias("error"),
    )


def vector_verdicts(
    scored: DataFrame, name: str = "embeddings", threshold: float = BENCH_THRESHOLD
) -> DataFrame:
    """Verdicts of a similarity gate as one more contender beside models: `scored` is (case_id, text,
    expected, latency_ms, similarity).  A case without a similarity is an error and passes."""
    missing = F.col("similarity").isNull()
    return scored.select(
        F.lit(name).alias("setup"),
        "case_id",
        "text",
        "expected",
        "latency_ms",
        F.coalesce(F.col("similarity") >= threshold, F.lit(False)).alias("actual"),
        F.when(missing, F.lit("ERROR: no embedding")).alias("error"),
    )


def reply_verdicts(responses: DataFrame, fail_closed: bool = False) -> DataFrame:
    """Verdicts of models from their replies: (setup, case_id, text, expected, reply, latency_ms).

    A reply that starts with ERROR, or is missing, goes to the error column.
    """
    status = F.when(
        F.col("reply").isNull() | F.startswith("reply", F.lit("ERROR")), F.lit("ERROR")
    ).otherwise(G.normalize_reply(F.col("reply")))
    return responses.withColumn("status", status).select(
        "setup",
        "case_id",
        "text",
        "expected",
        "latency_ms",
        G.counts_as_blocked(F.col("status"), fail_closed).alias("actual"),
        F.when(F.col("status") == "ERROR", F.coalesce("reply", F.lit("ERROR"))).alias("error"),
    )
