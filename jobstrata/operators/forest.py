"""Random forests over 0/1 features, grown on distinct feature sets and their counts.

A split of 0/1 features needs no more than how many rows of each class have a set of
features, so rows are counted by their set first; the bootstrap gives a set with n rows a
Poisson weight of mean n, as n rows of mean 1 would have together. Several training rounds
(folds left out) are grown in one go, as more trees over the same sets.

Sets are packed into chunks of bounded size and trees into blocks; a task holds one block's
nodes for one chunk's sets. A level is grown by adding up the tasks' class counts by node and
feature, choosing each node's split where its counts meet, and moving the sets on. Only the
level's splits of a block travel back to its chunks; the forest itself is in no closure and
never at the driver. Where one chunk holds all sets its tasks have all counts themselves and
grow the same trees without a shuffle. Sets that are only scored move along with no weight,
so a set's score is there when its trees are done.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from jobstrata.session import checkpointed

#: feature sets of a chunk
CHUNK_SETS = 1 << 15
#: trees of a block at least, and tree x set cells of a task at most
LEAST_TREES, TASK_CELLS = 8, 1 << 23
_HEAP_BITS = 40
_LAST = np.int64((1 << _HEAP_BITS) - 1)


@dataclass(frozen=True)
class ForestPlan:
    """What to grow: ``trees`` for every round in ``rounds`` (the fold left out, -1: none)."""

    trees: int
    rounds: tuple[int, ...]
    folds: int
    depth: int
    leaf: int
    seed: int
    features: int

    @property
    def tried(self) -> int:
        return max(1, int(np.sqrt(self.features)))


def feature_sets(rows: DataFrame, folds: int) -> DataFrame:
    """(active, counts): how many rows of each fold and label have a set of features; places
    2 * fold + label, the test set's after the last fold's."""
    place = 2 * F.coalesce("fold", F.lit(folds)) + F.col("label")
    cells = [F.count_if(place == i).alias(f"c{i}") for i in range(2 * folds + 2)]
    counted = rows.groupBy("active").agg(*cells)
    return counted.select("active", F.array(*[c for c in counted.columns[1:]]).alias("counts"))


class Chunk:
    """The sets of one chunk, as numpy arrays."""

    def __init__(self, members: pa.Scalar, plan: ForestPlan, number: int) -> None:
        members = members.values
        active = members.field("active")
        self.n, self.plan, self.number = len(members), plan, number
        sizes = np.diff(active.offsets.to_numpy())
        self.feature = active.flatten().to_numpy().astype(np.int64)
        self.owner = np.repeat(np.arange(self.n), sizes)
        counts = members.field("counts").flatten().to_numpy()
        self.counts = counts.reshape(self.n, -1)
        self.has = np.sort(self.owner * plan.features + self.feature)

    def weights(self, tree: int) -> np.ndarray:
        """(set, label): the tree's bootstrap weights."""
        left_out = self.plan.rounds[tree // self.plan.trees]
        rng = np.random.default_rng([self.plan.seed, tree, self.number])
        trained = [f for f in range(self.plan.folds) if f != left_out]
        n = np.stack([self.counts[:, [2 * f + c for f in trained]].sum(1) for c in (0, 1)], 1)
        return rng.poisson(n)

    def holds(self, sets: np.ndarray, features: np.ndarray) -> np.ndarray:
        keys = sets * self.plan.features + features
        at = np.searchsorted(self.has, keys)
        return self.has[np.minimum(at, len(self.has) - 1)] == keys if len(self.has) else keys < 0


class Growth:
    """One block's trees over one chunk: each set's node in each tree, or the leaf's share."""

    def __init__(self, chunk: Chunk, trees: range, nodes=None, share=None) -> None:
        self.chunk, self.trees = chunk, trees
        shape = (len(trees), chunk.n)
        roots = np.asarray(trees, np.int64)[:, None] << _HEAP_BITS
        self.nodes = (roots | 1) + np.zeros(shape, np.int64) if nodes is None else nodes.reshape(shape)
        self.share = np.full(shape, np.nan, np.float32) if share is None else share.reshape(shape)
        self.weight = np.stack([chunk.weights(t) for t in trees])

    def histogram(self) -> np.ndarray:
        """(node, feature, weight of label 0, of label 1) of the open nodes; feature -1: all."""
        live = np.isnan(self.share) & (self.weight.sum(2) > 0)
        tree, at = np.nonzero(live)
        totals = _summed(self.nodes[tree, at], np.full(len(at), -1), self.weight[tree, at])
        both = live[:, self.chunk.owner]
        tree, entry = np.nonzero(both)
        owner = self.chunk.owner[entry]
        ones = _summed(self.nodes[tree, owner], self.chunk.feature[entry], self.weight[tree, owner])
        return np.concatenate([totals, ones])

    def move(self, splits: np.ndarray) -> None:
        """Sends sets to their next node, or notes their leaf's share of label 1."""
        tree, at = np.nonzero(np.isnan(self.share))
        node = self.nodes[tree, at]
        place = np.searchsorted(splits["node"], node)
        place = np.minimum(place, max(len(splits) - 1, 0))
        known = splits["node"][place] == node if len(splits) else np.zeros(len(node), bool)
        # both sides of a split have a leaf's weight, so every open node has counts
        tree, at, node, place = tree[known], at[known], node[known], place[known]
        own = splits[place]
        done = own["feature"] < 0
        self.share[tree[done], at[done]] = own["share"][done]
        go = ~done
        has = self.chunk.holds(at[go], own["feature"][go])
        heap = node[go] & _LAST
        self.nodes[tree[go], at[go]] = (node[go] - heap) | (2 * heap + has)


SPLIT = np.dtype([("node", "<i8"), ("feature", "<i4"), ("share", "<f4"), ("gain", "<f8")])
COUNT = np.dtype([("node", "<i8"), ("feature", "<i4"), ("w0", "<i8"), ("w1", "<i8")])


def _summed(node: np.ndarray, feature: np.ndarray, weight: np.ndarray) -> np.ndarray:
    order = np.lexsort([feature, node])
    node, feature, weight = node[order], feature[order], weight[order]
    fresh = np.ones(len(node), bool)
    fresh[1:] = (node[1:] != node[:-1]) | (feature[1:] != feature[:-1])
    at = np.flatnonzero(fresh)
    out = np.empty(len(at), COUNT)
    out["node"], out["feature"] = node[at], feature[at]
    if len(at):
        sums = np.add.reduceat(weight, at, axis=0)
        out["w0"], out["w1"] = sums[:, 0], sums[:, 1]
    return out


def _mixed(values: np.ndarray) -> np.ndarray:
    v = values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    v = (v ^ (v >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return v ^ (v >> np.uint64(32))


def _gini(a, b):
    """Gini impurity times weight."""
    n = a + b
    return np.where(n > 0, 2.0 * a * b / np.maximum(n, 1), 0.0)


def chosen(counts: np.ndarray, plan: ForestPlan) -> np.ndarray:
    """The split of every node (feature -1: a leaf), ordered by node.

    Of a node's features that are not constant in it, ``tried`` are drawn by a hash of node
    and feature; the one with the greatest fall in Gini impurity is taken, if both sides
    have ``leaf`` weight or more.
    """
    totals = counts[counts["feature"] < 0]
    totals = totals[np.argsort(totals["node"])]
    out = np.zeros(len(totals), SPLIT)
    n = totals["w0"] + totals["w1"]
    out["node"], out["feature"], out["share"] = totals["node"], -1, totals["w1"] / np.maximum(n, 1)
    ones = counts[counts["feature"] >= 0]
    of = np.searchsorted(totals["node"], ones["node"])
    a1, b1 = ones["w0"], ones["w1"]
    a0, b0 = totals["w0"][of] - a1, totals["w1"][of] - b1
    depth = np.frexp((totals["node"] & _LAST).astype(np.float64))[1] - 1
    open_ = (totals["w0"] > 0) & (totals["w1"] > 0) & (depth < plan.depth)
    varies = open_[of] & (a0 + b0 > 0)
    ones, of, a0, b0, a1, b1 = (x[varies] for x in (ones, of, a0, b0, a1, b1))
    drawn = _mixed(_mixed(ones["node"] + np.int64(plan.seed)) ^ ones["feature"].astype(np.uint64))
    order = np.lexsort([drawn, of])
    first = np.searchsorted(of[order], np.arange(len(totals)))
    nth = np.empty(len(of), np.int64)
    nth[order] = np.arange(len(of)) - first[of[order]]
    gain = _gini(a0 + a1, b0 + b1) - _gini(a0, b0) - _gini(a1, b1)
    fits = (nth < plan.tried) & (a0 + b0 >= plan.leaf) & (a1 + b1 >= plan.leaf) & (gain > 1e-9)
    ones, of, gain = ones[fits], of[fits], gain[fits]
    order = np.lexsort([ones["feature"], -gain, of])
    best = order[np.flatnonzero(np.append(True, of[order][1:] != of[order][:-1])[: len(of)])]
    out["feature"][of[best]], out["gain"][of[best]] = ones["feature"][best], gain[best]
    return out


def _blocks(plan: ForestPlan, chunks: int, cores: int) -> int:
    """Blocks of trees: as many as keep the cores busy, and small enough for a task."""
    total = plan.trees * len(plan.rounds)
    busy = -(-3 * cores // chunks)
    small = -(-total * CHUNK_SETS // TASK_CELLS)
    return max(1, min(max(busy, small), total // LEAST_TREES or 1))


def _trees(block: int, blocks: int, plan: ForestPlan) -> range:
    total = plan.trees * len(plan.rounds)
    return range(block * total // blocks, (block + 1) * total // blocks)


_RESULT = "round int, chunk int, place int, share double, tree int, feature int, gain double"
_NAMES = [c.split()[0] for c in _RESULT.split(", ")]
_TYPES = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.float64()]


def _result(n: int, **given) -> pa.RecordBatch:
    cells = [
        pa.array(np.asarray(given[c]), t) if c in given else pa.nulls(n, t) for c, t in zip(_NAMES, _TYPES)
    ]
    return pa.record_batch(cells, names=_NAMES)


def _shares(growth: Growth, plan: ForestPlan) -> Iterator[pa.RecordBatch]:
    """Each set's sum of leaf shares over the block's trees of a round."""
    rounds = np.asarray(growth.trees) // plan.trees
    for i in np.unique(rounds):
        n = growth.chunk.n
        share = np.nansum(growth.share[rounds == i], axis=0, dtype=np.float64)
        yield _result(
            n, round=np.full(n, plan.rounds[i]), chunk=np.full(n, growth.chunk.number),
            place=np.arange(n), share=share,
        )


def _gains(splits: np.ndarray) -> pa.RecordBatch:
    used = splits[splits["feature"] >= 0]
    trees = (used["node"] >> _HEAP_BITS).astype(np.int32)
    return _result(len(used), tree=trees, feature=used["feature"], gain=used["gain"])


def grow_forest(sets: DataFrame, plan: ForestPlan, cores: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(active, round, share): each set's mean leaf share of label 1 in each round's trees; and
    (round, feature, importance), adding up to 1 in every round that has a split.

    Runs jobs while it is built; their tables are checkpointed. An empty table gives none.
    """
    spark = sets.sparkSession
    sets = checkpointed(sets)
    chunks = max(1, -(-sets.count() // CHUNK_SETS))
    packed = sets.groupBy(F.pmod(F.xxhash64("active"), F.lit(chunks)).cast("int").alias("chunk")).agg(
        F.sort_array(F.collect_list(F.struct("active", "counts"))).alias("members")
    )
    packed = checkpointed(packed)
    blocks = _blocks(plan, chunks, cores or spark.sparkContext.defaultParallelism)
    grid = packed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    grid = grid.repartition(min(blocks * chunks, 4096), "chunk", "block")
    grown = _grown_in_place(grid, plan, blocks) if chunks == 1 else _grown_by_level(grid, plan, blocks)
    grown = checkpointed(grown)
    places = packed.select("chunk", F.posexplode("members").alias("place", "member"))
    shares = (
        grown.where("share IS NOT NULL")
        .groupBy("round", "chunk", "place")
        .agg((F.sum("share") / plan.trees).alias("share"))
        .join(places, ["chunk", "place"])
        .select(F.col("member.active").alias("active"), "round", "share")
    )
    gains = grown.where("gain IS NOT NULL").groupBy("tree", "feature").agg(F.sum("gain").alias("gain"))
    whole = gains.groupBy("tree").agg(F.sum("gain").alias("whole"))
    rounds = F.array(*[F.lit(r) for r in plan.rounds])
    in_tree = gains.join(whole, "tree").withColumn(
        "round", F.element_at(rounds, (F.col("tree") / plan.trees).cast("int") + 1)
    )
    summed = in_tree.groupBy("round", "feature").agg(F.sum(F.col("gain") / F.col("whole")).alias("gain"))
    whole = summed.groupBy("round").agg(F.sum("gain").alias("whole"))
    importance = summed.join(whole, "round").select(
        "round", "feature", (F.col("gain") / F.col("whole")).alias("importance")
    )
    return shares, importance


def _grown_in_place(grid: DataFrame, plan: ForestPlan, blocks: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                number, members, block = (batch.column(c)[i] for c in range(3))
                trees = _trees(block.as_py(), blocks, plan)
                growth = Growth(Chunk(members, plan, number.as_py()), trees)
                while True:
                    splits = chosen(growth.histogram(), plan)
                    if not len(splits):
                        break
                    yield _gains(splits)
                    growth.move(splits)
                yield from _shares(growth, plan)

    return grid.select("chunk", "members", "block").mapInArrow(run, _RESULT)


def _grown_by_level(grid: DataFrame, plan: ForestPlan, blocks: int) -> DataFrame:
    none = F.lit(None).cast("binary")
    state = grid.select("chunk", "members", "block", none.alias("nodes"), none.alias("share"))
    found = None
    for _ in range(plan.depth + 1):
        splits = checkpointed(_level_splits(state, plan, blocks))
        if splits.agg(F.sum("n")).first()[0] in (None, 0):
            break
        state = checkpointed(_moved(state, splits, plan, blocks))
        gains = splits.select("splits").mapInArrow(
            lambda batches: (
                _gains(np.frombuffer(x.as_py(), SPLIT)) for b in batches for x in b.column(0)
            ),
            _RESULT,
        )
        found = gains if found is None else found.unionByName(gains)

    def run(batches):
        for _, growth in _growths(batches, plan, blocks):
            yield from _shares(growth, plan)

    shares = state.mapInArrow(run, _RESULT)
    return shares if found is None else found.unionByName(shares)


def _growths(batches, plan: ForestPlan, blocks: int):
    for batch in batches:
        for i in range(batch.num_rows):
            number, members, block, nodes, share = (batch.column(c)[i] for c in range(5))
            kept = (
                (np.frombuffer(nodes.as_py(), "<i8").copy(), np.frombuffer(share.as_py(), "<f4").copy())
                if nodes.is_valid
                else ()
            )
            trees = _trees(block.as_py(), blocks, plan)
            yield batch.slice(i, 1), Growth(Chunk(members, plan, number.as_py()), trees, *kept)


def _level_splits(state: DataFrame, plan: ForestPlan, blocks: int) -> DataFrame:
    """(block, tree, n, splits): the level's splits of each tree, packed, n of them."""

    def counts(batches):
        for row, growth in _growths(batches, plan, blocks):
            found = growth.histogram()
            of = found["node"] >> _HEAP_BITS
            for tree in np.unique(of):
                body = found[of == tree].tobytes()
                yield pa.record_batch(
                    [row.column(2), pa.array([tree], pa.int32()), pa.array([body])],
                    names=["block", "tree", "body"],
                )

    def splits(batches):
        key, total = None, None
        for batch in batches:
            for block, tree, body in zip(*(c.to_pylist() for c in batch.columns)):
                own = np.frombuffer(body, COUNT)
                if (block, tree) != key:
                    if key:
                        yield split(key, total)
                    key, total = (block, tree), own
                    continue
                both = np.concatenate([total, own])
                total = _summed(both["node"], both["feature"], np.stack([both["w0"], both["w1"]], 1))
        if key:
            yield split(key, total)

    def split(key, total):
        own = chosen(total, plan)
        return pa.record_batch(
            [
                pa.array([key[0]], pa.int32()),
                pa.array([key[1]], pa.int32()),
                pa.array([len(own)], pa.int32()),
                pa.array([own.tobytes()]),
            ],
            names=["block", "tree", "n", "splits"],
        )

    return (
        state.mapInArrow(counts, "block int, tree int, body binary")
        .repartition("block", "tree")
        .sortWithinPartitions("block", "tree")
        .mapInArrow(splits, "block int, tree int, n int, splits binary")
    )


def _moved(state: DataFrame, splits: DataFrame, plan: ForestPlan, blocks: int) -> DataFrame:
    of_block = splits.groupBy("block").agg(F.collect_list("splits").alias("splits"))

    def run(batches):
        for batch in batches:
            for row, growth in _growths([batch], plan, blocks):
                given = row.column(5)[0].as_py()
                own = np.concatenate([np.frombuffer(x, SPLIT) for x in given or [b""]])
                growth.move(own[np.argsort(own["node"])])
                yield pa.record_batch(
                    [
                        *row.columns[:3],
                        pa.array([growth.nodes.tobytes()]),
                        pa.array([growth.share.tobytes()]),
                    ],
                    names=row.schema.names[:5],
                )

    joined = state.join(of_block, "block", "left").select(*state.columns, "splits")
    return joined.mapInArrow(run, state.schema)
