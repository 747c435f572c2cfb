"""Near duplicates by bands of MinHash signatures, confirmed on full sets.

Each of TREES bands is a stretch of DEPTH signature values; texts that agree in all of them form a
region.  Bands are equality keys of plain joins: no order is sorted and no prefix measured.  A pair at
the similarity threshold of 0.8 shares a region in at least one band but for a chance of
(1 - 0.8**DEPTH)**TREES, 3 in ten million.

Few texts of a region are compared with each other outright.  More are first cut by one further
value of the signature into blocks that are linked each by itself; what is not in the region's largest
component after that is compared with the whole region, block by block, so no link is left out
and texts already connected are not compared again.  All links are confirmed on full sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.llm.common import materialize, unused
from palisade.llm.components import components
from palisade.llm.shingles import PERMUTATIONS, shingle_sets, signatures
from palisade.llm.suffixes import numbered

DEPTH = 3
TREES = PERMUTATIONS // DEPTH
# Trees looked at before the first components are known.
FIRST_TREES = 3
WIDTH = 5
PERCENT = 80
# Texts of a region that are compared outright.
BLOCK = 512
# Characters of text worked on in one step.
STEP = 1_000_000


def _steps(texts):
    at, size = 0, 0
    for i, t in enumerate(texts):
        if i > at and size + len(t or "") > STEP:
            yield at, i
            at, size = i, 0
        size += len(t or "")
    if at < len(texts):
        yield at, len(texts)


def sketch(rows: DataFrame, width: int) -> DataFrame:
    """(row, n, same, keys): size and fingerprint of each text's set, and its region in every
    tree, with a deeper value of that tree's order after each."""

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            count, same, keys = [], [], []
            for a, b in _steps(texts):
                sets = shingle_sets(texts[a:b], width)
                some = [s for s in sets if len(s)]
                sig = signatures(some).astype(np.uint64) if some else np.zeros((0, PERMUTATIONS), np.uint64)
                found = iter(range(len(some)))
                base = np.uint64(0x9E3779B97F4A7C15)
                tree = [sig[:, t * DEPTH : (t + 1) * DEPTH] for t in range(TREES)]
                region = np.stack([((x[:, 0] * base + x[:, 1]) * base + x[:, 2]) * base + np.uint64(t) for t, x in enumerate(tree)], 1)
                deeper = np.roll(sig, -DEPTH, 1)[:, : TREES * DEPTH : DEPTH]
                both = np.stack([region, deeper], 2).reshape(len(sig), 2 * TREES).view(np.int64)
                for s in sets:
                    count.append(len(s))
                    if len(s):
                        same.append(s[0].tobytes() + s.sum(dtype=np.uint64).tobytes() + np.bitwise_xor.reduce(s * base).tobytes() + len(s).to_bytes(8, "little"))
                        keys.append(both[next(found)].tolist())
                    else:
                        same.append(None)
                        keys.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(count, pa.int64()), pa.array(same, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["row", "n", "same", "keys"],
            )

    return rows.select(F.col("_row").alias("row"), "text").mapInArrow(run, "row long, n long, same binary, keys array<long>")


class _Sets:
    """Union-find over the members of one comparison."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return int(i)

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.parent[max(i, j)] = min(i, j)
        return i != j


def link_members(component: np.ndarray, asks: np.ndarray, sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Pairs of components joined by a link of a member that asks with any other member.

    Sizes of intersections come from lists of who has each shingle; what is connected already
    is not looked at again.
    """
    own, number = np.unique(component, return_inverse=True)
    if len(own) < 2:
        return []
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, token, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = df[token] > 1
    token, owner = token[shared], owner[shared]
    order = np.argsort(token, kind="stable")
    holders = owner[order]
    begin = np.searchsorted(token[order], np.arange(len(df) + 1))
    cut = np.searchsorted(owner, np.arange(len(sets) + 1))
    groups, out = _Sets(len(own)), []
    root = np.arange(len(own))
    for i in np.flatnonzero(asks):
        outside = root[number] != root[number[i]]
        if not outside.any():
            continue
        tokens = token[cut[i] : cut[i + 1]]
        if not len(tokens):
            continue
        a, n = begin[tokens], begin[tokens + 1] - begin[tokens]
        at = np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())
        common = np.bincount(holders[at], minlength=len(sets))
        linked = outside & (100 * common >= percent * (sizes + sizes[i] - common))
        fresh = False
        for j in np.flatnonzero(linked):
            if groups.join(int(number[i]), int(number[j])):
                out.append((int(component[i]), int(component[j])))
                fresh = True
        if fresh:
            root = np.array([groups.find(k) for k in range(len(own))])
    return out


def _compare(asked: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) between components: `asked` is (row, component, task struct<key, f, m>,
    asks) and all texts of a task are compared together."""
    wanted = asked.groupBy("row", "component").agg(F.collect_list(F.struct("key", "f", "m", "asks")).alias("tasks"))
    rows = (
        texts.join(wanted, "row")
        .select("component", "text", F.explode("tasks").alias("t"))
        .select("t.key", "t.f", "t.m", "t.asks", "component", "text")
    )

    def run(batches):
        def work(held):
            _, _, _, asks, component, texts = zip(*held)
            sets = []
            for a, b in _steps(texts):
                sets += shingle_sets(list(texts[a:b]), width)
            return link_members(np.array(component), np.array(asks, bool), sets, percent)

        held, last = [], None
        for batch in batches:
            links = []
            for values in zip(*(c.to_pylist() for c in batch.columns)):
                if values[:3] != last and held:
                    links += work(held)
                    held = []
                last = values[:3]
                held.append(values)
            yield pa.RecordBatch.from_pydict({"a": pa.array([x[0] for x in links], pa.int64()), "b": pa.array([x[1] for x in links], pa.int64())})
        if held:
            links = work(held)
            yield pa.RecordBatch.from_pydict({"a": pa.array([x[0] for x in links], pa.int64()), "b": pa.array([x[1] for x in links], pa.int64())})

    return rows.repartition("key", "f", "m").sortWithinPartitions("key", "f", "m").mapInArrow(run, "a long, b long")


def _blocks(n, block: int):
    return F.ceil(n / F.lit(block)).cast("int")


def near_duplicates(
    docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, block: int = BLOCK, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """`docs` with `n_shingles`, `component_id` and `kept`.

    Texts are linked when 100 * intersection >= percent * union of their sets of `width`-word
    shingles; `component_id` is the smallest id reachable by links, and one row of each component is
    `kept`, the first by id.  Texts without a word (null or empty ones) are linked with nothing; equal texts
    with words are one component.  A row whose id is null counts after all others.  Columns of `docs` of
    the three names are replaced, all others stay.
    """
    number = unused(docs, "_row")
    rows = numbered(docs, doc_id, number)
    texts = rows.select(F.col(number).alias("row"), F.col(text).alias("text")).where("text is not null")
    sketched = materialize(sketch(rows.select(F.col(number).alias("_row"), F.col(text).alias("text")), width), "sketches")
    # Equal sets are one node from here on.
    nodes = materialize(
        sketched.where("n > 0").groupBy("same").agg(F.min("row").alias("row"), F.first("keys").alias("keys")), "nodes"
    )
    trees = F.transform(
        F.sequence(F.lit(0), F.lit(TREES - 1)),
        lambda t: F.struct(t.alias("tree"), F.get("keys", 2 * t).alias("key"), F.get("keys", 2 * t + 1).alias("deep")),
    )
    members = nodes.select("row", F.explode(trees).alias("t")).select("row", "t.*")
    # Written first, so that a join with a crowded region can be split.
    sized = materialize(members.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "regions")
    members = materialize(members.join(sized, "key"), "members")

    # First trees: regions, or blocks of them by the deeper value, linked each by itself.
    first = members.where(F.col("tree") < FIRST_TREES).select(
        "row",
        F.col("row").alias("component"),
        "key",
        F.pmod(F.xxhash64("deep", F.when(F.col("size") > 8 * block, F.col("row"))), _blocks(F.col("size"), block)).cast("int").alias("f"),
        F.lit(0).alias("m"),
        F.lit(True).alias("asks"),
    )
    links = materialize(_compare(first, texts, width, percent), "links")
    known = components(links)

    # All trees: regions that hold several components.
    placed = materialize(
        members.join(known, F.col("row") == F.col("node"), "left").select(
            "row", "key", "tree", "size", F.coalesce("component", "row").alias("component")
        ),
        "placed",
    )
    parts = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    regions = materialize(
        parts.groupBy("key")
        .agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.max("n").alias("most"), F.sum("n").alias("all"))
        .where("most < all")
        .select("key", "main", _blocks(F.col("all") - F.col("most"), block).alias("fs"), _blocks(F.col("all"), block).alias("ms")),
        "regions",
    )
    open_ = placed.where((F.col("tree") >= FIRST_TREES) | (F.col("size") > block)).join(regions, "key")
    small = F.col("ms") == 1
    lot = lambda n: F.pmod(F.xxhash64("row"), n).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    together = open_.where(small).select("row", "component", "key", F.lit(0).alias("f"), F.lit(0).alias("m"), (F.col("component") != F.col("main")).alias("asks"))
    apart = open_.where(~small & (F.col("component") != F.col("main"))).select(
        "row", "component", "key", lot(F.col("fs")).alias("f"), upto("ms").alias("m"), F.lit(True).alias("asks")
    )
    whole = open_.where(~small).select(
        "row", "component", "key", upto("fs").alias("f"), lot(F.col("ms")).alias("m"), F.lit(False).alias("asks")
    )
    more = materialize(_compare(together.unionByName(apart).unionByName(whole), texts, width, percent), "links")
    edges = known.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more)
    final = components(edges)

    # Back to all rows: by equal sets, then by component.
    node_of = nodes.select("same", F.col("row").alias("node0")).join(final, F.col("node0") == F.col("node"), "left")
    node_of = node_of.select("same", F.coalesce("component", "node0").alias("group"))
    alone = F.coalesce("group", "row")
    labelled = sketched.select("row", "n", "same").join(node_of, "same", "left").select("row", "n", alone.alias("group"))
    ids = rows.select(F.col(number).alias("row"), F.col(doc_id).alias("id")).join(labelled, "row")
    rank = F.struct(F.col("id").isNull(), F.col("id"), F.col("row"))
    heads = ids.groupBy("group").agg(F.min(rank).alias("head"))
    out = ids.join(heads, "group").select(
        F.col("row").alias(number),
        F.col("n").alias("n_shingles"),
        F.col("head.id").alias("component_id"),
        (F.col("row") == F.col("head.row")).alias("kept"),
    )
    plain = [c for c in docs.columns if c not in ("n_shingles", "component_id", "kept")]
    return rows.select(number, *plain).join(out, number).select(*plain, "n_shingles", "component_id", "kept")
