"""Sources."""

from __future__ import annotations

import csv
import os
import re
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palisade.fixed_values import DEFAULT_ENTITIES, DEFAULT_THRESHOLD, DEFAULT_TOPICS, LAB_KEYWORDS, RULE_PATTERNS
from palisade.functions.scoring import run_stamp
from palisade.functions.text import strip
from palisade.session import settled
from palisade.sources import schemas

RUN_NAMES = {"Final Score": "final_score"}


def _snake(name: str) -> str:
    return RUN_NAMES.get(name, name.lower())


def _csv_by_name(spark: SparkSession, path: str, types: dict[str, str]) -> DataFrame | None:
    """CSV files of a folder, their columns bound by the names in their own headers.

    Files of equal headers are read together; a known column that a file lacks is null, an unknown one
    is text.  None where there is no file.  Only the first line of each file reaches the driver.
    """
    try:
        lines = spark.read.option("pathGlobFilter", "*.csv").text(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    top = lines.where(F.col("_metadata.file_block_start") == 0).select(
        F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("n"), "value"
    )
    headers: dict[tuple, list[str]] = {}
    for file, header in top.groupBy("file").agg(F.min_by("value", "n")).collect():
        names = tuple(n.strip() for n in next(csv.reader([header.removeprefix("\ufeff")])))
        headers.setdefault(names, []).append(re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(file)))
    out = None
    for names, files in sorted(headers.items()):
        known = ", ".join(f"`{n}` {types.get(n, 'STRING')}" for n in names)
        reader = spark.read.option("header", True).schema(known)
        if os.path.splitext(path)[1] != ".csv":
            reader = reader.option("basePath", path)
        part = reader.csv(sorted(files)).withColumn("_file", F.col("_metadata"))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        return None
    return out.withColumns({n: F.lit(None).cast(t) for n, t in types.items() if n not in out.columns})


def load_runs(spark: SparkSession, path: str, run_from: str = "mtime") -> DataFrame:
    """Run CSVs of a folder with the run they belong to; no folder gives no rows.

    Columns are found by name in each file's header, in any order; those of the usual six that
    a file lacks are null.  `run_from` is `mtime` (file time to the second), `filename`, or
    `partition` for folders written with `write_runs`.
    """
    if run_from not in ("mtime", "filename", "partition"):
        raise ValueError("run_from must be 'mtime', 'filename' or 'partition'")
    raw = _csv_by_name(spark, path, schemas.RUN_CSV)
    if raw is None:
        names = ", ".join(f"`{n}` {t}" for n, t in schemas.RUN_CSV.items())
        raw = spark.createDataFrame([], names + ", run STRING")
    elif run_from == "mtime":
        raw = raw.withColumn("run", run_stamp(F.col("_file.file_modification_time")))
    elif run_from == "filename":
        raw = raw.withColumn("run", F.regexp_replace(F.col("_file.file_name"), r"\.csv$", ""))
    else:
        raw = raw.withColumn("run", F.col("run").cast("string"))
    others = [c for c in raw.columns if c not in (*schemas.RUN_CSV, "run", "_file")]
    return raw.select(*[F.col(f"`{c}`").alias(_snake(c)) for c in (*schemas.RUN_CSV, *others, "run")])


def union_uploads(spark: SparkSession, uploads: dict[str, str]) -> DataFrame:
    """Concatenate CSVs of unequal columns; `uploads` maps a run name to its path.

    Columns missing from a file are null; score, cost and latency become numbers.
    """
    frames = [
        spark.read.option("header", True).csv(path).withColumn("Run", F.lit(name))
        for name, path in uploads.items()
    ]
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame, allowMissingColumns=True)
    casts = {c: F.col(f"`{c}`").cast("double") for c in ("Final Score", "Cost", "Latency")}
    numbers = union.withColumns(casts)
    return numbers.toDF(*[_snake(c) for c in numbers.columns])


def stripped_lines(lines: DataFrame) -> DataFrame:
    """Trimmed, non-blank lines of a batch or streaming text source."""
    return lines.select(strip(F.col("value")).alias("line")).where(F.length("line") > 0)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return stripped_lines(spark.read.text(path))


def load_policies(spark: SparkSession, path: str) -> DataFrame:
    """Policy files, with a default per field; no file gives the default policy.

    A file holds one object or an array of them, pretty-printed or not, or one object per line.
    A file that is not such JSON is an error: a policy half read would be an open gate.
    """
    try:
        files = spark.read.text(path, wholetext=True)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return default_policy(spark)
    kind = f"array<struct<{schemas.POLICY}>>"
    lines = F.filter(F.split("value", "\n"), lambda x: F.length(F.trim(x)) > 0)
    whole = F.exists(lines, lambda x: ~F.rlike(x, F.lit(r"^\s*\{.*\}\s*$")))
    texts = files.select(F.explode(F.when(whole, F.array("value")).otherwise(lines)).alias("text"))
    parsed = F.from_json("text", kind, {"mode": "FAILFAST"})
    return with_policy_defaults(texts.select(F.inline(parsed)))


def policy_versions(spark: SparkSession, path: str) -> DataFrame:
    """Every row of a versioned policy table (`writers.append_policies`) with its `version`."""
    return spark.read.schema(schemas.POLICY + ", version BIGINT").json(path)


def policies_at(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The policies in force at a version, the latest if none is named: of each name the rows of
    its greatest version up to that one, with defaults for missing fields."""
    rows = policy_versions(spark, path)
    if version is not None:
        rows = rows.where(F.col("version") <= version)
    newest = Window.partitionBy("policy_name").orderBy(F.desc("version"))
    in_force = rows.withColumn("_rank", F.rank().over(newest)).where("_rank = 1")
    return with_policy_defaults(in_force)


def with_policy_defaults(raw: DataFrame) -> DataFrame:
    """Rules default to none; topics, threshold and entities to the built-in ones."""
    nothing = F.array().cast("array<string>")
    texts = lambda xs: F.array(*[F.lit(x) for x in xs])
    return raw.select(
        F.coalesce("policy_name", F.lit("Unnamed")).alias("policy_name"),
        F.coalesce("keyword_rules", nothing).alias("keyword_rules"),
        F.coalesce("pattern_rules", nothing).alias("pattern_rules"),
        F.coalesce("semantic_topics", texts(DEFAULT_TOPICS)).alias("semantic_topics"),
        F.coalesce("semantic_threshold", F.lit(DEFAULT_THRESHOLD)).alias("semantic_threshold"),
        F.coalesce("pii_entities", texts(DEFAULT_ENTITIES)).alias("pii_entities"),
    )


def default_policy(spark: SparkSession) -> DataFrame:
    """The policy used when no file is given."""
    row = ("default", LAB_KEYWORDS, RULE_PATTERNS, DEFAULT_TOPICS, DEFAULT_THRESHOLD, DEFAULT_ENTITIES)
    return spark.createDataFrame([row], schemas.POLICY)


def policy_rules(policies: DataFrame) -> DataFrame:
    """(policy_name, kind, ord, rule): every rule as a row, in list order."""
    kinds = {"keyword": "keyword_rules", "pattern": "pattern_rules", "topic": "semantic_topics"}
    listed = F.array(
        *[F.struct(F.lit(k).alias("kind"), F.col(c).alias("rules")) for k, c in kinds.items()]
    )
    return (
        policies.select("policy_name", F.inline(listed))
        .select("policy_name", "kind", F.posexplode("rules").alias("ord", "rule"))
    )


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.REGISTRY).json(path)


def registry_questions(registry: DataFrame) -> DataFrame:
    return registry.select(
        F.col("id").alias("doc_id"), "title", F.inline("questions").alias("question_id", "topic", "question")
    )


def pick_documents(registry: DataFrame, ids: list[str]) -> DataFrame:
    """The documents with these ids; an unknown id is an error that lists it."""
    picked = registry.where(F.col("id").isin(ids))
    known = {r["id"] for r in picked.select("id").distinct().collect()}
    unknown = sorted(set(ids) - known)
    if unknown:
        raise ValueError(f"unknown documents: {', '.join(unknown)}")
    return picked


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """The vector store as it stands: of every (collection, chunk_id) the version of the latest load.

    Only ids and load numbers are grouped; the chunks themselves stay where they are and lose what
    is superseded in a join with the few ids that were loaded more than once.
    """
    stored = spark.read.parquet(path)
    keys = ["collection", "chunk_id"]
    again = (
        stored.groupBy(*keys)
        .agg(F.max("load").alias("_latest"), F.min("load").alias("_first"))
        .where("_latest > _first")
        .drop("_first")
    )
    versions = stored.join(settled(again), keys, "left")
    return versions.where(F.col("_latest").isNull() | (F.col("load") == F.col("_latest"))).drop("_latest")


def read_retrieval_results(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    return spark.read.schema(schemas.RETRIEVAL_RESULT).option("multiLine", multi_line).json(path)


def explode_results(results: DataFrame) -> DataFrame:
    """One row per retrieved chunk, ranked from 1 in list order.  Question ids repeat from
    document to document, so both are kept."""
    return results.select(
        "doc_id", "question_id", F.posexplode("retrieved_chunks").alias("_pos", "c")
    ).select(
        "doc_id",
        "question_id",
        (F.col("_pos") + 1).alias("rank"),
        F.col("c.page_num").alias("page_num"),
        F.col("c.distance").alias("distance"),
        F.col("c.text").alias("text"),
    )


def read_stress_results(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    return spark.read.schema(schemas.STRESS_RESULT).option("multiLine", multi_line).json(path)


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """A summary export, its columns found by name; no folder gives no rows."""
    found = _csv_by_name(spark, path, schemas.SUMMARY_CSV)
    if found is None:
        return spark.createDataFrame([], ", ".join(f"{n} {t}" for n, t in schemas.SUMMARY_CSV.items()))
    return found.select(*schemas.SUMMARY_CSV)
