"""Near-duplicate embeddings by a forest of random-projection trees.

Each tree splits the vectors of a label by a random direction, at the median, then both halves by directions and
medians of their own, again and again. A vector nearer to a split than the spill margin goes to both sides, so near
vectors are rarely parted in a tree, and hardly in all. A split is only made if few vectors lie in its margin; of
several directions the best one is taken, and a node that none divides, such as a tight cluster, is a leaf.
So the leaves of a vector are few whatever the data. Splits are fitted on a sample of at most
some thousand vectors of a node; then every vector of the node goes down. Leaves that turn out too
large are fitted and split in a further round. Within a leaf all pairs are compared exactly in double precision; a
leaf that no split divides is compared in square tiles, so no task ever holds more than two tiles. Trees
that end in the same set of vectors compare it once.

Nothing is emitted per pair. A pair that meets in several leaves is counted in the one with the smallest
key (every vector carries its list of leaves), and a tile returns, per vector, its number of links and
one representative of its linked group. Equal vectors are one class with a multiplicity.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teletally.llm.common import arrow_schema
from teletally.llm.components import connected_components
from teletally.storage import store

THRESHOLD = 0.93
TREES = 12
CAPACITY = 1024
# Spill margin as a share of the deviation that two vectors at the threshold have along a direction.
SPILL = 0.25
# Most of a node that may lie in a split's margin, and directions tried for one that is below it.
MOST_SPILLED = 0.25
TRIES = 6
# Vectors of a node that its splits are fitted on (chosen by hash, so their number varies a little), fewest of them
# that are split further, and vectors of a node that go down in one task.
SAMPLE = 4096
FEWEST = 64
BLOCK = 8192
SEED = 20240101


def _direction(seed: int, size: int) -> np.ndarray:
    """Unit direction of one split."""
    found = np.random.default_rng([SEED, seed]).standard_normal(size)
    return found / np.linalg.norm(found)


def _unit(rows: list[bytes]) -> np.ndarray:
    vectors = np.frombuffer(b"".join(rows), dtype=np.float64).reshape(len(rows), -1)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def prepared(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``digest`` (label and vector), ``space`` (label and dimension), ``vector`` (doubles as bytes).

    Left out: rows without an id or a label, and vectors that are null, empty, zero, or hold a null or a
    non-finite component.
    """
    target = arrow_schema("vec_id long, digest binary, space string, vector binary")

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found: dict[str, list] = {"vec_id": [], "digest": [], "space": [], "vector": []}
            for row in part.to_pylist():
                vector = np.array([math.nan if x is None else x for x in row["embedding"]], dtype=np.float64)
                # Scaled first: a square could over- or underflow.
                most = np.abs(vector).max(initial=0.0)
                if not np.isfinite(most) or most == 0 or np.isnan(vector).any():
                    continue
                data = (vector / most).tobytes()
                space = f"{row['label']}/{len(vector)}"
                found["vec_id"].append(row["vec_id"])
                found["digest"].append(blake2b(vector.tobytes() + space.encode(), digest_size=16).digest())
                found["space"].append(space)
                found["vector"].append(data)
            yield pa.RecordBatch.from_pydict(found, schema=target)

    wanted = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        F.col("label").cast("string").alias("label"),
    )
    wanted = wanted.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
    return wanted.mapInArrow(batches, "vec_id long, digest binary, space string, vector binary")


class Tree:
    """Splits of one node, numbered; a child below zero is a leaf."""

    def __init__(self, unit: np.ndarray, total: int, number: int, capacity: int, margin: float):
        """Fitted on sampled vectors of a node of ``total`` vectors."""
        self.margin = margin
        self.seeds: list[int] = []
        self.cuts: list[float] = []
        self.children: list[tuple[int, int]] = []
        self.stuck: list[bool] = []
        chance = np.random.default_rng([SEED, number % 2**63])
        scale = total / max(1, len(unit))

        def leaf(stuck: bool) -> int:
            self.stuck.append(stuck)
            return -len(self.stuck)

        def grown(at: np.ndarray) -> int:
            if len(at) * scale <= capacity:
                return leaf(False)
            if len(at) < min(FEWEST, 2 * capacity) and len(at) < total:
                return leaf(False)
            best = None
            for _ in range(TRIES):
                seed = int(chance.integers(2**62))
                side = unit[at] @ _direction(seed, unit.shape[1])
                cut = float(np.median(side))
                spilled = float((np.abs(side - cut) < margin).mean())
                if best is None or spilled < best[0]:
                    best = spilled, seed, side, cut
            spilled, seed, side, cut = best
            if spilled > MOST_SPILLED:
                return leaf(True)
            here = len(self.seeds)
            self.seeds.append(seed)
            self.cuts.append(cut)
            self.children.append((0, 0))
            self.children[here] = grown(at[side < cut + margin]), grown(at[side > cut - margin])
            return here

        self.root = grown(np.arange(len(unit)))

    def down(self, unit: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves and the positions of the vectors that reach them."""
        waiting = [(self.root, np.arange(len(unit)))]
        while waiting:
            node, at = waiting.pop()
            if not len(at):
                continue
            if node < 0:
                yield -node - 1, at
                continue
            side = unit[at] @ _direction(self.seeds[node], unit.shape[1]) - self.cuts[node]
            left, right = self.children[node]
            waiting += [(left, at[side < self.margin]), (right, at[side > -self.margin])]


def _number(*parts: object) -> int:
    """64-bit number of some names."""
    return int.from_bytes(blake2b("/".join(map(str, parts)).encode(), digest_size=8).digest(), "little", signed=True)


def _split(nodes: DataFrame, vectors: DataFrame, trees: int, capacity: int, margin_of) -> DataFrame:
    """``space``, ``cls``, ``leaf``, ``stuck`` of all vectors of some nodes, one tree further down.

    ``nodes``: space, node, cls. ``vectors``: space, cls, vector. ``trees``: how many trees start at each node.
    """
    rows = nodes.join(vectors, ["space", "cls"])
    counts = store(nodes.groupBy("space", "node").agg(F.count("*").alias("total")), "node-sizes")
    sized = rows.join(counts, ["space", "node"])
    chosen = F.pmod(F.xxhash64("cls", "node"), F.lit(2**40)) < F.lit(float(2**40)) * SAMPLE / F.col("total")

    def fitted(frame: pd.DataFrame) -> pd.DataFrame:
        unit, space, node = _unit(list(frame["vector"])), frame["space"].iloc[0], int(frame["node"].iloc[0])
        total, margin = int(frame["total"].iloc[0]), margin_of(unit.shape[1])
        # Rows come in any order; a forest must not depend on it.
        unit = unit[np.argsort(frame["cls"].to_numpy(), kind="stable")]
        forest = [Tree(unit, total, _number(space, node, k), capacity, margin) for k in range(trees)]
        return pd.DataFrame({"space": [space], "node": [node], "total": [total], "forest": [pickle.dumps(forest)]})

    forests = sized.where(chosen).groupBy("space", "node").applyInPandas(
        fitted, "space string, node long, total long, forest binary"
    )
    # A node goes down in blocks, each with its forest: a large one is no single task.
    blocks = F.ceil(F.col("total") / BLOCK).cast("int")
    forests = forests.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = sized.withColumn("block", F.pmod(F.xxhash64("cls"), blocks).cast("int"))

    def down(key: tuple, given: pd.DataFrame, forest: pd.DataFrame) -> pd.DataFrame:
        cls, leaf, stuck = [], [], []
        if len(given) and len(forest):
            space, node = key[0], int(key[1])
            unit, own = _unit(list(given["vector"])), given["cls"].to_numpy()
            for k, tree in enumerate(pickle.loads(forest["forest"].iloc[0])):
                for number, at in tree.down(unit):
                    cls.append(own[at])
                    leaf.append(np.full(len(at), _number(space, node, k, number), dtype=np.int64))
                    stuck.append(np.full(len(at), tree.stuck[number]))
        whole = [np.concatenate(c) if c else [] for c in (cls, leaf, stuck)]
        return pd.DataFrame({"space": [key[0]] * len(whole[0]), "cls": whole[0], "leaf": whole[1], "stuck": whole[2]})

    keys = ["space", "node", "block"]
    left = dealt.select(*keys, "cls", "vector")
    left, right = left.toDF(*left.columns), forests.select(*keys, "forest")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        down, "space string, cls binary, leaf long, stuck boolean"
    )


def _leaves(classes: DataFrame, trees: int, capacity: int, spill: float, threshold: float) -> DataFrame:
    """``space``, ``cls``, ``leaf``, ``size`` (vectors in it): leaves of at most ``capacity``, or that no split divides."""

    def margin_of(size: int) -> float:
        return spill * math.sqrt(2 - 2 * threshold) / math.sqrt(size)

    vectors = classes.select("space", "cls", "vector")
    nodes, started, done = classes.select("space", F.lit(0).cast("long").alias("node"), "cls"), trees, None
    while True:
        reached = store(_split(nodes, vectors, started, capacity, margin_of), "nodes")
        sizes = reached.groupBy("space", "leaf").agg(
            F.count("*").alias("size"),
            F.bool_or("stuck").alias("stuck"),
            F.bit_xor(F.xxhash64("cls")).alias("first_sum"),
            F.bit_xor(F.xxhash64("cls", F.lit(1))).alias("second_sum"),
        )
        sizes = store(sizes.withColumn("split", (F.col("size") > capacity) & ~F.col("stuck")), "leaf-sizes")
        sized = reached.drop("stuck").join(sizes.drop("stuck"), ["space", "leaf"])
        ended = sized.where(~F.col("split")).drop("split")
        done = ended if done is None else done.union(ended)
        if sizes.where("split").isEmpty():
            break
        nodes, started = sized.where("split").select("space", F.col("leaf").alias("node"), "cls"), 1
    done = store(done, "leaves")
    # The same vectors in leaves of several trees are compared in one of them.
    same = ["space", "size", "first_sum", "second_sum"]
    kept = done.groupBy(*same).agg(F.min("leaf").alias("leaf")).select("space", "leaf")
    return store(done.join(kept, ["space", "leaf"], "left_semi").select("space", "cls", "leaf", "size"), "kept-leaves")


def _compare(frame: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links of one tile of a leaf: per class the number of linked vectors, and a class of its group."""
    leaf = frame["leaf"].iloc[0]
    unit = _unit(list(frame["vector"]))
    cls, number = frame["cls"].to_numpy(), frame["number"].to_numpy()
    own, apart = frame["own"].to_numpy(), frame["first"].iloc[0] != frame["second"].iloc[0]
    sizes = frame["leaves"].map(len).to_numpy()
    known = np.arange(sizes.max()) < sizes[:, None]
    held = np.full(known.shape, np.iinfo(np.int64).min, dtype=np.int64)
    held[known] = np.concatenate(list(frame["leaves"]))
    links, root = np.zeros(len(cls), dtype=np.int64), np.arange(len(cls))
    step = 512
    edges = []
    for start in range(0, len(cls), step):
        a, b = np.nonzero(unit[start : start + step] @ unit.T >= threshold)
        a = a + start
        # Each pair once; in a tile of two parts only across them.
        wanted = (a < b) & (own[a] != own[b]) if apart else a < b
        a, b = a[wanted], b[wanted]
        edges.append((a, b))
        for low in range(0, len(a), 50_000):
            x, y = a[low : low + 50_000], b[low : low + 50_000]
            shared = ((held[x][:, :, None] == held[y][:, None, :]) & known[x][:, :, None] & known[y][:, None, :]).any(axis=2)
            lowest = np.where(shared, held[x], np.iinfo(np.int64).max).min(axis=1)
            here = lowest == leaf
            np.add.at(links, x[here], number[y[here]])
            np.add.at(links, y[here], number[x[here]])
    a, b = (np.concatenate([e[k] for e in edges]) for k in (0, 1))
    while len(a):
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            break
    found = (links > 0) | (root != np.arange(len(cls)))
    return pd.DataFrame({"cls": cls[found], "links": links[found], "other": cls[root[found]]})


def near_vectors(
    vectors: DataFrame,
    *,
    threshold: float = THRESHOLD,
    trees: int = TREES,
    capacity: int = CAPACITY,
    spill: float = SPILL,
) -> DataFrame:
    """Links between vectors of equal labels: one row per input row.

    Returns vec_id, n_links (other vectors at a cosine of at least ``threshold``), component_id (smallest vec_id
    reachable), kept. Vectors that are null, zero or hold null or non-finite components, and rows without a
    label, have no links; rows without an id are in no component and kept. Vectors of different
    dimensions are not compared. Equal vectors are one class. Rows that share an id are in one component; where their
    vectors differ, the links of each of them count. An empty table gives an empty result; other columns are ignored.
    """
    rows = store(prepared(vectors).withColumnRenamed("digest", "cls"), "vectors")
    members = store(rows.select("vec_id", "cls").distinct(), "members")
    classes = rows.groupBy("space", "cls").agg(F.first("vector").alias("vector"))
    numbers = members.groupBy("cls").agg(F.count("*").alias("number"), F.min("vec_id").alias("smallest"))
    classes = store(classes.join(numbers, "cls"), "vector-classes")

    leaves = _leaves(classes, trees, capacity, spill, threshold)
    lists = leaves.groupBy("cls").agg(F.array_sort(F.collect_set("leaf")).alias("leaves"))
    tiles = F.ceil(F.col("size") / capacity).cast("int")
    placed = leaves.distinct().withColumn("tiles", tiles).withColumn("own", F.pmod(F.xxhash64("cls"), F.col("tiles")).cast("int"))
    placed = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    placed = placed.select(
        "cls", "space", "leaf", "own", F.least("own", "with").alias("first"), F.greatest("own", "with").alias("second")
    )
    full = placed.join(classes.select("cls", "vector", "number").join(lists, "cls"), "cls")
    compared = full.groupBy("space", "leaf", "first", "second").applyInPandas(
        lambda frame: _compare(frame, threshold), "cls binary, links long, other binary"
    )
    compared = store(compared, "vector-links")
    # Ids of several vectors tie their classes together.
    shared = members.groupBy("vec_id").agg(F.min("cls").alias("a"), F.max("cls").alias("b")).where("a < b")
    tied = members.join(shared.select("vec_id", "a"), "vec_id").select("a", F.col("cls").alias("b"))
    ties = compared.select(F.col("cls").alias("a"), F.col("other").alias("b")).union(tied).where("a <> b")
    parts = connected_components(ties).withColumnRenamed("node", "cls")
    links = compared.groupBy("cls").agg(F.sum("links").alias("links"))
    known = classes.select("cls", "number", "smallest").join(links, "cls", "left").join(parts, "cls", "left")
    known = known.withColumn("component", F.coalesce("component", "cls"))
    lowest = known.groupBy("component").agg(F.min("smallest").alias("component_id"))
    known = known.join(lowest, "component").select(
        "cls", (F.coalesce("links", F.lit(0)) + F.col("number") - 1).alias("n_links"), "component_id"
    )
    named = members.join(known, "cls").groupBy("vec_id").agg(
        F.sum("n_links").alias("n_links"), F.min("component_id").alias("component_id")
    )
    found = vectors.select(F.col("vec_id").cast("long").alias("vec_id")).join(named, "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return found.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
