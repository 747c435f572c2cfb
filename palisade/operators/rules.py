"""Gates over a text table: literal rules, or rules held in a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palisade.functions import gates as G
from palisade.session import DIMENSION_ROWS, scratch_path, settled

# Characters of the runs that keywords are filed under.
GRAM = 4
# Keywords of a policy that every text is tried for before the others are looked up.
EARLY = 64
# A pattern with back references, named groups, flags or quoting is not made part of a
# common alternation.
STANDS_ALONE = r"\\[1-9kQ]|\(\?[a-zA-Z<-]"


def rule_gate(
    df: DataFrame,
    keywords: list[str],
    patterns: list[str],
    text: str = "text",
    whole_word: bool = False,
) -> DataFrame:
    """Add `keyword`, `pattern_match` and `verdict`: keywords first, then patterns."""
    return (
        df.withColumn("_lowered", F.lower(text))
        .withColumn("keyword", G.keyword_hit(F.col("_lowered"), keywords, whole_word))
        .withColumn("pattern_match", G.pattern_hit(F.col(text), patterns))
        .withColumn("verdict", G.rule_verdict(F.col("keyword"), F.col("pattern_match")))
        .drop("_lowered")
    )


def rule_join(
    texts: DataFrame,
    rules: DataFrame,
    text: str = "text",
    policy: str = "policy_name",
    block_rows: int = DIMENSION_ROWS,
) -> DataFrame:
    """Gate each text by the rules of its policy.

    `rules` holds (policy_name, kind, ord, rule), kind `keyword` or `pattern`.  The first
    keyword found is the one of the smallest `ord`, any number or null (last), then of the smallest
    text.  A null or empty rule matches nothing; a keyword listed twice counts where it is first.

    The first `EARLY` keywords of a policy are tried one after the other until one is found, which
    then needs no further look.  The others are looked up in an index: each is filed under its
    rarest run of `GRAM` characters, the runs of a text's words are equi-joined with it, and what
    meets there is verified.  So work grows with the texts and the meetings, not with texts times
    rules.  Keywords without a word that long are tried in turn like the first ones, and
    keywords behind one that was found are not looked up.  Texts stay in place as long as no more
    than `block_rows` different ones have a hit from the index; beyond, they are joined with their
    hits by a shuffle.
    """
    lowered = F.when(F.col("kind") == "keyword", F.lower("rule")).otherwise(F.col("rule"))
    place = F.struct(F.col("ord").isNull().alias("late"), "ord", "rule")
    once = (
        rules.where(F.length("rule") > 0)
        .groupBy(policy, "kind", lowered.alias("lowered"))
        .agg(F.min(place).alias("place"))
    )
    # Rules of the usual number are worked out once, and lists and index made of them in one step.
    held = settled(once, block_rows)
    once = once if held is once else held.coalesce(1)
    in_order = Window.partitionBy(policy).orderBy("place")
    first = once.where("kind = 'keyword'").withColumn("rank", F.row_number().over(in_order)).where(F.col("rank") <= EARLY)
    last = first.groupBy(policy).agg(F.max("place").alias("last"))
    later = F.coalesce(F.col("place") > F.col("last"), F.lit(True))
    once = (
        once.join(last, policy, "left")
        .withColumn("part", _longest_word(F.col("lowered")))
        .withColumn("filed", (F.col("kind") == "keyword") & (F.length("part") >= GRAM) & later)
    )
    lists = settled(_lists(once, policy), block_rows)
    nowhere = F.lit(None).cast(once.schema["place"].dataType)
    in_turn = F.aggregate(
        "_short",
        nowhere,
        lambda at, r: F.when(at.isNotNull(), at).when(F.contains(F.col("_lowered"), r["lowered"]), r["place"]),
    )
    pattern = F.exists("_patterns", lambda p: F.rlike(F.col(text), F.concat(F.lit("(?iU)"), p)))
    marked = (
        texts.withColumn("_lowered", F.lower(text))
        .join(lists, policy, "left")
        .withColumn("_at", in_turn)
        .withColumn("pattern_match", F.coalesce(pattern, F.lit(False)))
        .withColumn("_key", F.sha2("_lowered", 256))
    )
    found = _look_up(marked, settled(_index(once, policy), block_rows), policy)
    path = scratch_path(texts.sparkSession, "rule-hits")
    found.write.parquet(path)
    hits = settled(texts.sparkSession.read.schema(found.schema).parquet(path), block_rows)
    verified = F.filter(F.array_sort("_maybe"), lambda r: F.contains(F.col("_lowered"), r["lowered"]))
    first = F.least("_at", "_best", F.get(verified, F.lit(0))["place"])
    added = ["keyword", "pattern_match", "verdict"]
    return (
        marked.join(hits, [policy, "_key"], "left")
        .withColumn("keyword", first["rule"])
        .withColumn("verdict", G.rule_verdict(F.col("keyword"), F.col("pattern_match")))
        .select(*[c for c in texts.columns if c not in added], *added)
    )


def _longest_word(text: Column) -> Column:
    words = F.split(text, " ")
    longest = F.array_max(F.transform(words, lambda w: F.struct(F.length(w), w.alias("word"))))
    return longest["word"]


def _runs(word: Column) -> Column:
    """All runs of `GRAM` characters of a word that long; a long word is gone through by a
    look-ahead, as each cut from a string counts its characters from the start."""
    cuts = F.transform(
        F.sequence(F.lit(1), F.length(word) - (GRAM - 1)),
        lambda i: F.call_function("substring", word, i, F.lit(GRAM)),
    )
    ahead = F.regexp_extract_all(word, F.lit(f"(?s)(?=(.{{{GRAM}}}))"), F.lit(1))
    return F.when(F.length(word) > 16 * GRAM, ahead).otherwise(cuts)


def _lists(once: DataFrame, policy: str) -> DataFrame:
    """One row a policy: keywords not in the index, in order; patterns; the first place in the index."""
    is_pattern = F.col("kind") == "pattern"
    short = ~is_pattern & ~F.col("filed")
    alone = F.col("lowered").rlike(STANDS_ALONE)
    merged = F.array_join(
        F.collect_list(F.when(is_pattern & ~alone, F.concat(F.lit("(?:"), "lowered", F.lit(")")))), "|"
    )
    patterns = F.concat(F.collect_list(F.when(is_pattern & alone, F.col("lowered"))), F.array(merged))
    return once.groupBy(policy).agg(
        F.array_sort(F.collect_list(F.when(short, F.struct("place", "lowered")))).alias("_short"),
        F.filter(patterns, lambda p: F.length(p) > 0).alias("_patterns"),
        F.min(F.when(F.col("filed"), F.col("place"))).alias("_least"),
    )


def _index(once: DataFrame, policy: str) -> DataFrame:
    """(policy, run, part, place, lowered): each keyword under the run that fewest keywords have."""
    filed = once.where("filed").select(
        policy, "place", "lowered", "part", F.explode(F.array_distinct(_runs(F.col("part")))).alias("run")
    )
    sharing = Window.partitionBy(policy, "run")
    counted = filed.withColumn("n", F.count(F.lit(1)).over(sharing))
    return counted.groupBy(policy, "place", "lowered", "part").agg(F.min(F.struct("n", "run")).alias("rarest")).select(
        F.col(policy), F.col("rarest.run").alias("run"), "part", "place", "lowered"
    )


def _look_up(marked: DataFrame, index: DataFrame, policy: str) -> DataFrame:
    """(policy, _key, _best, _maybe): for texts with keywords of the index before the one at `_at`
    the first of a single word, and those whose longest word alone is known to be there."""
    undecided = F.col("_least").isNotNull() & (F.col("_at").isNull() | (F.col("_least") < F.col("_at")))
    words = marked.where(undecided).select(
        policy, "_key", "_at", F.explode(F.array_distinct(F.split("_lowered", " "))).alias("word")
    )
    runs = words.where(F.length("word") >= GRAM).withColumn("run", F.explode(_runs(F.col("word"))))
    met = runs.join(index, [policy, "run"]).where(
        (F.col("_at").isNull() | (F.col("place") < F.col("_at"))) & F.contains("word", F.col("part"))
    )
    single = F.col("part") == F.col("lowered")
    return met.groupBy(policy, "_key").agg(
        F.min(F.when(single, F.col("place"))).alias("_best"),
        F.collect_set(F.when(~single, F.struct("place", "lowered"))).alias("_maybe"),
    )
