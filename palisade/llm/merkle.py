"""A Merkle tree over the rows of a dataset: leaves, one subtree a group, a root over the groups,
and each row's proof.

The tree is built by slot pivots: an aggregate with one condition a slot spreads the children of
a parent into columns; the columns hashed together are the parent, and all but a child's own are
its siblings.  Rows are shuffled by block of consecutive leaves, so that all levels inside a
block follow without another shuffle; the tree over the blocks is built the same way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palisade.llm.common import materialize
from palisade.operators.ordering import numbered
from palisade.session import settled

FANOUT = 2
# Leaves of a block at most: so many rows with their proofs inside it make one row.
BLOCK = 256

_PATH = "array<struct<before:string,after:string>>"


def digest(parts: list[Column]) -> Column:
    """Lower-case hex SHA-256 of strings laid end to end."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def row_digest(columns: list[Column]) -> Column:
    """The leaf of a row: each value as its UTF-8 length, a colon and itself, a null as a dash."""
    texts = [c.cast("string") for c in columns]
    return digest(
        [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    )


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path lead to."""
    return F.aggregate(path, leaf, lambda h, p: digest([p["before"], h, p["after"]]))


def proof_digest(path: Column) -> Column:
    """One hash of all siblings of a path, from the leaf up and from left to right."""
    siblings = F.transform(path, lambda p: F.concat(p["before"], p["after"]))
    return F.sha2(F.array_join(siblings, "").cast("binary"), 256)


def _stepped(members: Column, step: Column) -> Column:
    """The members of a child with the step from it to its parent put to their paths."""
    return F.transform(members, lambda m: F.struct(m["key"].alias("key"), F.concat(m["path"], step).alias("path")))


def _blocks(nodes: DataFrame, largest: int, fanout: int) -> tuple[DataFrame, int]:
    """Subtrees over blocks of consecutive nodes: (grp, size, block, hash, members), and how many nodes a
    block spans.  Members are (key, path inside the block).  `nodes` is (grp, size, pos, hash, key)."""
    levels = 1
    while fanout ** (levels + 1) <= BLOCK:
        levels += 1
    width = fanout**levels
    member = F.struct("key", F.array().cast(_PATH).alias("path"))
    rows = nodes.select(
        "grp", "size", F.call_function("div", "pos", F.lit(width)).alias("block"), "pos", "hash",
        F.array(member).alias("members"),
    ).repartition("grp", "block")
    empty = f"array<struct<key:{nodes.schema['key'].dataType.simpleString()},path:{_PATH}>>"
    for level in range(levels):
        if largest <= fanout**level:
            break
        several = F.col("size") > fanout**level
        slots = [
            F.first(F.when(F.col("pos") % fanout == i, F.struct("hash", "members")), ignorenulls=True).alias(f"slot{i}")
            for i in range(fanout)
        ]
        parent = F.call_function("div", "pos", F.lit(fanout)).alias("pos")
        spread = rows.groupBy("grp", "size", "block", parent).agg(*slots)
        hashes = [F.coalesce(F.col(f"slot{i}.hash"), F.lit("")) for i in range(fanout)]
        members = []
        for i in range(fanout):
            beside = F.struct(
                F.concat(F.lit(""), *hashes[:i]).alias("before"), F.concat(F.lit(""), *hashes[i + 1 :]).alias("after")
            )
            step = F.when(several, F.array(beside)).otherwise(F.array().cast(_PATH))
            members.append(F.coalesce(_stepped(F.col(f"slot{i}.members"), step), F.array().cast(empty)))
        rows = spread.select(
            "grp", "size", "block", "pos",
            F.when(several, digest(hashes)).otherwise(hashes[0]).alias("hash"),
            F.concat(*members).alias("members"),
        )
    return rows.select("grp", "size", "block", "hash", "members"), width


def paths(nodes: DataFrame, largest: int, fanout: int = FANOUT) -> DataFrame:
    """One row a block of leaves: (grp, block, root, up, members).

    `nodes` is (grp, size, pos, hash, key): the `size` leaves of a group numbered from 0, `largest`
    the greatest size, `key` what is carried along; `grp` is not null.  `members` are (key, path)
    of the leaves, `path` the siblings inside the block and `up` those above it.
    """
    found, width = _blocks(nodes, largest, fanout)
    found = materialize(found, "merkle-blocks")
    if largest <= width:
        return found.select(
            "grp", "block", F.col("hash").alias("root"), F.array().cast(_PATH).alias("up"), "members"
        )
    above = paths(
        found.select(
            "grp", F.ceil(F.col("size") / width).cast("long").alias("size"), F.col("block").alias("pos"), "hash",
            F.struct("block").alias("key"),
        ),
        -(-largest // width),
        fanout,
    )
    up = above.select("grp", "root", "up", F.inline("members")).select(
        "grp", F.col("key.block").alias("block"), "root", F.concat("path", "up").alias("up")
    )
    return found.select("grp", "block", "members").join(settled(up), ["grp", "block"])


def merkle_manifest(
    df: DataFrame,
    fields: list[str],
    order: str = "doc_id",
    group: str = "lang",
    carried: dict[str, Column] | None = None,
    fanout: int = FANOUT,
) -> DataFrame:
    """One row per row of `df`: (order column, leaf, subroot, root, path, and the `carried` columns).

    The leaf is the hash of `fields`.  The rows of a group (a null one counts) ascend by `order`,
    nulls first, equal ones by leaf; `fanout` consecutive nodes make the next level's node until one is left,
    the last of a level of fewer, a lone leaf being its own subroot.  The subroots, the null
    group first and then bytewise, lead to `root` likewise.  `path` lists the siblings before and
    after, level by level from the leaf to the root; `folded(leaf, path)` gives the root.

    Repeated rows are leaves of their own; other columns of `df` take no part; an empty
    table gives no rows.  Carried columns must not be named like the others.
    """
    if fanout < 2:
        raise ValueError("a node needs two children at least")
    group_key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    extra = {} if carried is None else carried
    taken = [order, "leaf", "subroot", "root", "path"]
    if {c.lower() for c in extra} & set(taken):
        raise ValueError(f"carried columns may not be named {taken}")
    key = F.struct(F.col(order).alias("id"), F.struct(F.lit(0).alias("none"), *[c.alias(n) for n, c in extra.items()]).alias("extra"))
    leaves = materialize(
        df.select(
            group_key.alias("grp"), row_digest([F.col(c) for c in fields]).alias("hash"), key.alias("key")
        ),
        "merkle-leaves",
    )
    placed = numbered(
        leaves.withColumn("first", F.col("key.id")), ["grp"], ["first", "hash"], "pos", "size"
    ).select("grp", "size", "pos", "hash", F.struct("key", "hash").alias("key"))
    largest = leaves.groupBy("grp").count().agg(F.max("count")).first()[0] or 0
    trees = paths(placed, largest, fanout)
    tops = materialize(trees.where("block = 0").select("grp", F.col("root").alias("hash")), "merkle-subroots")
    n_groups = tops.count()
    whole = paths(
        numbered(tops, [], ["grp"], "pos").select(
            F.lit("").alias("grp"), F.lit(n_groups).cast("long").alias("size"), "pos", "hash", F.struct("grp").alias("key")
        ),
        n_groups,
        fanout,
    )
    over = whole.select("root", "up", F.inline("members")).select(
        F.col("key.grp").alias("grp"), F.col("root").alias("top"), F.concat("path", "up").alias("over")
    )
    rows = trees.join(settled(over), "grp").select("root", "up", "top", "over", F.inline("members"))
    return rows.select(
        F.col("key.key.id").alias(order),
        F.col("key.hash").alias("leaf"),
        F.col("root").alias("subroot"),
        F.col("top").alias("root"),
        F.concat("path", "up", "over").alias("path"),
        *[F.col(f"key.key.extra.`{n}`").alias(n) for n in extra],
    )
