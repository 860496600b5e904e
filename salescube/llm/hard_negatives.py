"""Hard negatives by maximum inner product in a window below each positive's score, over cover trees.

Components become floor(256 x) in double precision; scores are inner products of these whole numbers, and exact: sums that stay below
2**53 run as floating point, others as Python integers. More similar comes first, ties by smaller vec_id.

1. Candidates are dealt to tasks by ranges of (label, vec_id), so a label that holds a third of all rows spreads over tasks. A task
   cuts its rows into groups of one label and `TREE` rows at most and builds a cover tree of each: vectors get one more component
   that brings all to the largest norm M of the tree, so they lie on a sphere and inner products order as angles do. A
   farthest-first walk gives nested centres; level by level the covering radius shrinks to `STEP` of the one above. Every node keeps
   the exact largest angle to what lies below it. Trees are raw arrays in the shared folder, packed by task.
2. Queries (anchors) are dealt to tasks, which map the packs into memory. A node whose centre has angle t to the query and covering
   radius r holds inner products between |q| M cos(t + r) and |q| M cos(t - r). Roots are taken best bound first; below a root
   the levels are cut by the bounds, leaves come best bound first, their vectors are multiplied exactly, and what can no longer
   reach the k-th best (or lies outside every window) is skipped.
   First the trees of the anchor's own label give its positives, then all other trees serve the windows of all its positives.

The index holds every row and the search is exact, so recall is 1. A task holds one pack while building (`_pack_rows`, some 10^5
vectors at most), one root per tree while searching (a `TREE`-th of the rows); vectors stay in mapped files.

Defined cases: rows with a null vec_id, a null label, a null vector, or a null or non-finite component take no part; vectors of
unequal lengths count as filled up with zeros, an empty one as zero; a repeated row is one more candidate (and anchor) and not
a positive of itself, since an anchor's own vec_id never is; an empty table, or anchors without positives, give no rows; other
columns are ignored; a score beyond 64 bits is an error.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from salescube.llm.store import get, new_path, put

TREE, LEAF, STEP = 2048, 32, 0.8
POSITIVES, NEGATIVES, LOW, HIGH = 5, 5, 80, 100
_ANGLE = 1e-6
_TREES = ("label", "points", "nodes", "dims")
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _pack_rows(rows: int) -> int:
    return min(max(rows // 16, 1 << 14), 1 << 18)


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id, label and vector (doubles) of the rows that take part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").where(finite)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                       F.col("embedding").cast("array<double>").alias("vector"))


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Whole-number components, short vectors filled with zeros."""
    sizes = np.diff(np.asarray(vectors.offsets))
    flat = np.floor(256 * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


def cover(points: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Order of the points and the nodes by level: parent, centre (a point's place in that order), low and high place, angle."""
    n = len(points)
    norms = np.einsum("ij,ij->i", points, points)
    reach = norms.max()
    unit = np.c_[points, np.sqrt(np.maximum(reach - norms, 0))] / np.sqrt(reach) if reach else np.c_[points, np.ones(n)]
    chosen, near, close = [0], np.zeros(n, np.int64), unit @ unit[0]
    gaps = [np.inf]
    while len(chosen) < -(-n // LEAF):
        far = int(np.argmin(close))
        if close[far] >= 1 - 1e-12:
            break
        gaps.append(np.arccos(max(close[far], -1.0)))
        cosine = unit @ unit[far]
        nearer = cosine > close
        near[nearer], close[nearer] = len(chosen), cosine[nearer]
        near[far], close[far] = len(chosen), 2.0  # a centre stays with itself
        chosen.append(far)
    gaps, centres, counts = np.array(gaps), np.array(chosen), [1]
    radius = gaps[1] if len(gaps) > 1 else 0.0
    while counts[-1] < len(centres):
        radius *= STEP
        counts.append(max(counts[-1], int((gaps > radius).sum())))
    counts = sorted(set(counts))
    under, parents = [near], []
    for k in counts[-2::-1]:
        own = np.argmax(unit[centres] @ unit[centres[:k]].T, axis=1)
        own[:k] = np.arange(k)
        parents.append(own)
        under.append(own[under[-1]])
    under, parents = under[::-1], parents[::-1]
    order = np.lexsort(under[::-1])
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    found = {c: [] for c in ("parent", "centre", "low", "high", "angle")}
    base = 0
    for level, owner in enumerate(under):
        mine = owner[order]
        low = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]])
        names = mine[low]
        cosines = np.einsum("ij,ij->i", unit[order], unit[centres[mine]])
        where = np.zeros(len(centres), np.int64)
        found["parent"].append(before[parents[level - 1][names]] if level else np.array([-1]))
        found["centre"].append(place[centres[names]])
        found["low"].append(low)
        found["high"].append(np.r_[low[1:], n])
        found["angle"].append(np.arccos(np.clip(np.minimum.reduceat(cosines, low), -1, 1)) + _ANGLE)
        where[names] = base + np.arange(len(names))
        before, base = where, base + len(names)
    nodes = {c: np.concatenate(v) for c, v in found.items()}
    nodes["level"] = np.repeat(np.arange(len(under)), [len(x) for x in found["low"]])
    return order, nodes


def _build(root: str):
    """Cut a task's sorted rows into trees and write them as one pack; the row says where it is."""
    def run(batches):
        trees, held, label = [], [], None

        def close():
            if held:
                ids = np.concatenate([i for i, _ in held])
                width = max(m.shape[1] for _, m in held)
                points = np.concatenate([np.pad(m, ((0, 0), (0, width - m.shape[1]))) for _, m in held])
                order, nodes = cover(points)
                trees.append((label, ids[order], points[order], nodes))
                held.clear()

        size = 0
        for batch in batches:
            ids, labels = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            points, at = _matrix(batch.column(2)), 0
            while at < len(ids):
                if held and (labels[at] != label or size >= TREE):
                    close()
                if not held:
                    label, size = int(labels[at]), 0
                to = min(at + int(np.searchsorted(labels[at:], label, side="right")), at + TREE - size)
                held.append((ids[at:to], points[at:to]))
                size, at = size + to - at, to
        close()
        if trees:
            name = uuid.uuid4().hex
            _write_pack(f"{root}/{name}", trees)
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([sum(len(t[1]) for t in trees)], pa.int64())], names=["pack", "n"])
    return run


def _write_pack(path: str, trees: list) -> None:
    put(f"{path}/trees", np.array([(label, len(ids), len(nodes["low"]), points.shape[1]) for label, ids, points, nodes in trees], np.int64))
    put(f"{path}/ids", np.concatenate([t[1] for t in trees]))
    put(f"{path}/points", np.concatenate([t[2].ravel() for t in trees]))
    put(f"{path}/centres", np.concatenate([t[2][t[3]["centre"]].ravel() for t in trees]))
    put(f"{path}/shape", np.concatenate([np.c_[t[3]["parent"], t[3]["low"], t[3]["high"], t[3]["level"]] for t in trees]).astype(np.int64))
    put(f"{path}/angle", np.concatenate([t[3]["angle"] for t in trees]))


class _Tree:
    """One tree of a mapped pack."""

    def __init__(self, label, ids, points, centres, shape, angle):
        self.label, self.ids, self.points, self.centres, self.angle = int(label), ids, points, np.asarray(centres), np.asarray(angle)
        self.parent, self.low, self.high, level = np.asarray(shape).T
        self.levels = np.searchsorted(level, np.arange(level[-1] + 2))
        inner = np.zeros(len(level), bool)
        inner[self.parent[1:]] = True
        self.leaf = ~inner
        # all augmented vectors have the tree's largest norm
        self.reach, self.most = 0.0, 0.0
        for at in range(0, len(ids), 1 << 12):
            part = np.asarray(points[at:at + (1 << 12)])
            self.reach = max(self.reach, float(np.sqrt(np.einsum("ij,ij->i", part, part).max())))
            self.most = max(self.most, float(np.abs(part).max(initial=0)))

    def bounds(self, query: np.ndarray, length: float, nodes=slice(None)) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest inner product below each node."""
        scale = self.reach * length
        if not scale:
            zero = np.zeros(len(self.angle[nodes]))
            return zero, zero
        theta = np.arccos(np.clip(self.centres[nodes] @ query / scale, -1, 1))
        slack = 1e-9 * scale + 1e-3
        return (scale * np.cos(np.minimum(theta + self.angle[nodes], np.pi)) - slack, scale * np.cos(np.maximum(theta - self.angle[nodes], 0)) + slack)

    def scores(self, query: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and exact scores of the points of some leaves."""
        sizes = high - low
        if 2 * sizes.sum() >= len(self.ids):
            places, points = np.arange(len(self.ids)), self.points
            wanted = np.zeros(len(places) + 1, np.int64)
            wanted[low] += 1
            wanted[high] -= 1
            wanted = np.cumsum(wanted[:-1]) > 0
        else:
            places = np.repeat(low - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
            points, wanted = self.points[places], slice(None)
        if self.most * np.abs(query).max(initial=0) * max(len(query), 1) < 2.0 ** 53:
            return places[wanted], (points @ query)[wanted].astype(np.int64)
        whole = np.array([int(x) for x in query], object)
        found = [int(sum((int(a) * b for a, b in zip(row, whole)), 0)) for row in points]
        return places[wanted], np.array(found, object)[wanted].astype(np.int64)


class _Forest:
    """All trees of an index, mapped into memory."""

    def __init__(self, paths: list[str]):
        self.trees: list[_Tree] = []
        for path in paths:
            table = np.asarray(get(f"{path}/trees", np.int64)).reshape(-1, len(_TREES))
            ids, points, centres = (get(f"{path}/{n}", t) for n, t in (("ids", np.int64), ("points", np.float64), ("centres", np.float64)))
            shape, angle = get(f"{path}/shape", np.int64).reshape(-1, 4), get(f"{path}/angle", np.float64)
            i = p = c = m = 0
            for label, n, nodes, dims in table.tolist():
                self.trees.append(_Tree(label, ids[i:i + n], points[p:p + n * dims].reshape(n, dims), centres[c:c + nodes * dims].reshape(nodes, dims),
                                        shape[m:m + nodes], angle[m:m + nodes]))
                i, p, c, m = i + n, p + n * dims, c + nodes * dims, m + nodes
        self.labels = np.array([t.label for t in self.trees], np.int64)

    def search(self, query: np.ndarray, trees: np.ndarray, windows: list[tuple[int, int]], k: int, skip: int | None = None) -> list[list[tuple[int, int]]]:
        """The k best (score, vec_id) inside each window of scores, over the given trees."""
        low, high = (np.array([w[i] for w in windows], np.float64) for i in (0, 1))
        best, floor = [[] for _ in windows], low.copy()
        length = float(np.sqrt(query @ query))
        shaped = {d: np.r_[query[:d], np.zeros(max(0, d - len(query)))] for d in {self.trees[t].points.shape[1] for t in trees.tolist()}}
        roots = [(self.trees[t], *self.trees[t].bounds(shaped[self.trees[t].points.shape[1]], length, slice(0, 1))) for t in trees.tolist()]
        roots.sort(key=lambda r: -r[2][0])
        for tree, least, most in roots:
            if most[0] < floor.min():
                break
            if not ((most[0] >= floor) & (least[0] <= high)).any():
                continue
            mine = shaped[tree.points.shape[1]]
            least, most = tree.bounds(mine, length)
            alive = ((most[:, None] >= floor) & (least[:, None] <= high)).any(axis=1)
            for a, b in zip(tree.levels[1:-1], tree.levels[2:]):
                alive[a:b] &= alive[tree.parent[a:b]]
            leaves = np.flatnonzero(alive & tree.leaf)
            leaves = leaves[np.argsort(-most[leaves], kind="stable")]
            step = 8
            while len(leaves):
                now, leaves, step = leaves[:step], leaves[step:], step * 8
                places, scores = tree.scores(mine, tree.low[now], tree.high[now])
                for w in range(len(windows)):
                    hit = np.flatnonzero((scores >= floor[w]) & (scores <= high[w]))
                    if len(hit):
                        found = [(s, i) for s, i in zip(scores[hit].tolist(), tree.ids[places[hit]].tolist()) if i != skip]
                        best[w] = sorted(best[w] + found, key=lambda x: (-x[0], x[1]))[:k]
                        if len(best[w]) == k:
                            floor[w] = max(floor[w], best[w][-1][0])
                leaves = leaves[((most[leaves][:, None] >= floor) & (least[leaves][:, None] <= high)).any(axis=1)]
        return best


def _mine(paths: list[str], positives: int, negatives: int, share: tuple[int, int]):
    def run(batches):
        forest = None
        for batch in batches:
            forest = forest or _Forest(paths)
            out = []
            for anchor, label, query in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _matrix(batch.column(2))):
                own = forest.labels == label
                (first,) = forest.search(query, np.flatnonzero(own), [(-np.inf, np.inf)], positives, skip=anchor)
                first = [(s, i, -(-share[0] * s // share[1]), s) for s, i in first]
                first = [x for x in first if x[2] <= x[3]]
                if first:
                    found = forest.search(query, np.flatnonzero(~own), [x[2:] for x in first], negatives)
                    out += [(anchor, i, rank, other, s, score) for (s, i, *_), best in zip(first, found) for rank, (score, other) in enumerate(best, 1)]
            columns = list(zip(*out)) if out else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if n == 2 else pa.int64()) for n, c in enumerate(columns)],
                                             names=[x.split()[0] for x in RESULT.split(", ")])
    return run


def build_index(rows: DataFrame) -> list[str]:
    """Cover trees of all rows (vec_id, label, vector) in the shared folder: the paths of their packs, one per task."""
    root = new_path(rows.sparkSession, "trees")
    packs = max(1, -(-(n := rows.count()) // _pack_rows(n)))
    sorted_rows = rows.repartitionByRange(packs, "label", "vec_id").sortWithinPartitions("label", "vec_id")
    return [f"{root}/{r.pack}" for r in sorted_rows.mapInArrow(_build(root), "pack string, n long").collect()]


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """For every anchor (vec_id, label, vector) and each of its best `positives` of its own label: the best `negatives` of other labels whose
    score is `low` / `high` of the positive's score or more, and not above it."""
    if not 0 < low <= high:
        raise ValueError("the window is from low / high of the positive's score up to that score: 0 < low <= high")
    paths = build_index(rows)
    tasks = max(anchors.sparkSession.sparkContext.defaultParallelism * 2, anchors.count() // 256)
    return anchors.repartition(tasks, "vec_id").mapInArrow(_mine(paths, positives, negatives, (low, high)), RESULT)


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector among all others, after the labels of every seventh have moved on."""
    rows = usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "label", "embedding"))
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(rows, rows.where("vec_id % 100 = 0"))
