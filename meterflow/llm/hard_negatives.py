"""Hard negatives by an STR-packed R-tree.

Vectors become integers, so inner products are exact. The rows are packed sort-tile-recursively: Spark cuts the table
into slabs along the coordinate of greatest variance and each slab into tiles along the second (identifiers break
ties, so equal vectors are spread as well); inside a tile the next coordinates tile its rows into leaves, and leaves
that follow each other form nodes. Each box keeps its least and greatest value per coordinate. A coordinate of an
anchor times that interval is an interval of products; their sum bounds every inner product in the box.

Anchors are searched in blocks of bounded size, each sent to all tiles. Per anchor a best-first queue takes the box
of greatest bound. It leaves out boxes outside all score windows, strictly below the kth result, or equal to it with
larger identifiers alone. Tasks return their k best, which Spark merges. A first search finds the positives, whose
scores set the windows of the second.

Defined cases: rows with a null identifier, label or vector, a null or non-finite component, or one of more than
``LARGEST`` in size once scaled take no part; of rows that share an identifier the smallest (label, vector) takes
part; shorter vectors count as ending in zeros; ties go to the smaller identifier; a window of a score below zero is
empty; labels are read as integers; an empty table, or one without anchors, gives no row; other columns are ignored.
"""

from __future__ import annotations

import bisect
import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import save, shared_dir

#: Greatest size of a scaled component: sums of products fit a long for vectors of up to 2^14 components.
LARGEST = 1 << 24
TILE_ROWS, LEAF_ROWS, NODE_LEAVES, LOCAL_AXES = 4096, 128, 8, 3
TILE = "ids binary, labels binary, vectors binary, bounds binary, low binary, high binary"


def scaled(rows: DataFrame, label: Column, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(id, label, v) of the rows that take part, v in whole numbers."""
    x = rows.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
                    F.transform(F.col(vector_col), lambda c: c.cast("double")).alias("x"))
    ok = F.forall("x", lambda c: c.isNotNull() & (F.abs(c) < float("inf")))    # NaN is greater than that
    v = F.transform("x", lambda c: F.floor(c * float(scale)))
    x = x.filter("id is not null and label is not null and x is not null").filter(ok).select("id", "label", v.alias("v"))
    x = x.filter(F.forall("v", lambda c: F.abs(c) <= LARGEST)).withColumn("v", F.col("v").cast("array<int>"))
    return x.groupBy("id").agg(F.min(F.struct("label", "v")).alias("row")).select("id", "row.*")


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Vectors as rows, ended by zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return values.reshape(len(lengths), width).astype(np.int64)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def str_leaves(v: np.ndarray, rows: np.ndarray, axes: list[int], leaf: int) -> list[np.ndarray]:
    """``rows`` sort-tile-recursively in leaves: slabs along the first axis, each tiled along the others."""
    rows = rows[np.argsort(v[rows, axes[0]], kind="stable")] if axes else rows
    pages = -(-len(rows) // leaf)
    if len(axes) < 2 or pages < 2:
        return [rows[i:i + leaf] for i in range(0, len(rows), leaf)]
    slabs = int(np.ceil(pages ** (1 / len(axes)) - 1e-9))
    size = -(-pages // slabs) * leaf
    return [x for i in range(0, len(rows), size) for x in str_leaves(v, rows[i:i + size], axes[1:], leaf)]


def pack(rows: DataFrame, width: int, axes: list[int], n_rows: int) -> DataFrame:
    """Tiles of the tree, one row each."""
    spark = rows.sparkSession
    tiles = -(-n_rows // TILE_ROWS)
    by = [F.coalesce(F.get("v", F.lit(a)), F.lit(0)) for a in axes[:2]]
    cuts: list[float] = []
    if len(axes) > 1 and tiles > 1:
        slabs = int(np.ceil(tiles ** 0.5))
        cuts = sorted(set(rows.select(by[0].alias("c")).approxQuantile("c", [i / slabs for i in range(1, slabs)], 0.01)))
    slab = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < by[0])) if cuts else F.lit(0)
    # The axes are in order of variance; vectors of one component have one.
    dealt = rows.select("id", "label", "v", slab.alias("slab"), by[-1].alias("along"))
    dealt = dealt.repartitionByRange(max(tiles, 1), "slab", "along", "id").sortWithinPartitions("slab", "along", "id")
    local = axes[2:2 + LOCAL_AXES] or axes[:1]

    def tile(ids, labels, v):
        leaves = str_leaves(v, np.arange(len(ids)), local, LEAF_ROWS)
        at = np.concatenate(leaves)
        ids, labels, v = ids[at], labels[at], v[at]
        bounds = np.cumsum([0, *map(len, leaves)])
        low, high = (f.reduceat(v, bounds[:-1], axis=0) for f in (np.minimum, np.maximum))
        parts = [ids.astype(np.int64), labels.astype(np.int64), v.astype(np.int32), bounds.astype(np.int64), low.astype(np.int32), high.astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in parts], [p.split()[0] for p in TILE.split(", ")])

    def build(batches):
        held: list[tuple] = []
        for b in batches:
            held.append((b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False), matrix(b.column(2), width)))
            if sum(len(h[0]) for h in held) >= TILE_ROWS:
                ids, labels, v = (np.concatenate([h[k] for h in held]) for k in range(3))
                full = len(ids) // TILE_ROWS * TILE_ROWS
                for i in range(0, full, TILE_ROWS):
                    yield tile(ids[i:i + TILE_ROWS], labels[i:i + TILE_ROWS], v[i:i + TILE_ROWS])
                held = [(ids[full:], labels[full:], v[full:])]
        if sum(len(h[0]) for h in held):
            yield tile(*(np.concatenate([h[k] for h in held]) for k in range(3)))

    if width == 0:
        raise ValueError("vectors without components have no tree")
    return save(dealt.select("id", "label", "v").mapInArrow(build, TILE), "rtree-tiles")


@dataclass
class Boxes:
    """Boxes of a level: first and last child (rows for leaves), bounds per coordinate, least identifier."""
    first: np.ndarray
    last: np.ndarray
    low: np.ndarray
    high: np.ndarray
    least_id: np.ndarray


class Tile:
    def __init__(self, row: dict, width: int, number):
        self.ids, self.labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
        self.v = np.frombuffer(row["vectors"], np.int32).reshape(-1, width).astype(number)
        bounds = np.frombuffer(row["bounds"], np.int64)
        low, high = (np.frombuffer(row[k], np.int32).reshape(-1, width).astype(number) for k in ("low", "high"))
        self.levels = [Boxes(bounds[:-1], bounds[1:], low, high, np.minimum.reduceat(self.ids, bounds[:-1]))]
        while len(self.levels[-1].first) > 1:
            b = self.levels[-1]
            first = np.arange(0, len(b.first), NODE_LEAVES)
            last = np.minimum(first + NODE_LEAVES, len(b.first))
            self.levels.append(Boxes(first, last, np.minimum.reduceat(b.low, first), np.maximum.reduceat(b.high, first),
                                     np.minimum.reduceat(b.least_id, first)))

    def intervals(self, up: np.ndarray, down: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per level the least and greatest inner product of each anchor (row) with each box; ``up`` and ``down`` are
        the anchors' positive and negative components."""
        return [(up @ b.low.T + down @ b.high.T, up @ b.high.T + down @ b.low.T) for b in self.levels]


class Best:
    """The ``k`` best (score, id) with a score in [low, high]: greater scores first, then smaller ids."""

    def __init__(self, k: int, low=None, high=None):
        self.k, self.low, self.high, self.found = k, low, high, []

    def wants(self, least, greatest, least_id) -> bool:
        """Whether a box of scores in [least, greatest] can hold a result."""
        if self.low is not None:
            if greatest < self.low or least > self.high:
                return False
            greatest = min(greatest, self.high)
        if len(self.found) < self.k:
            return True
        score, top = self.found[-1]
        return greatest > -score or greatest == -score and least_id < top

    def floor(self):
        """No score below this is a result."""
        if len(self.found) == self.k:
            return -self.found[-1][0]
        return -np.inf if self.low is None else self.low

    def add(self, score: int, row_id: int) -> None:
        if self.low is not None and not self.low <= score <= self.high:
            return
        if len(self.found) < self.k or (-score, row_id) < self.found[-1]:
            bisect.insort(self.found, (-score, row_id))
            del self.found[self.k:]


def best_first(tile: Tile, bounds: list, at: int, anchor: np.ndarray, best: list[Best], fits) -> None:
    """Feed the tile's rows to ``best``, boxes of greatest bound first; ``fits(id, label)`` picks rows."""
    top = len(tile.levels) - 1
    queue = [(-float(bounds[top][1][at, 0]), top, 0)]
    while queue:
        _, level, box = heapq.heappop(queue)
        boxes = tile.levels[level]
        if not any(b.wants(bounds[level][0][at, box], bounds[level][1][at, box], boxes.least_id[box]) for b in best):
            continue
        first, last = int(boxes.first[box]), int(boxes.last[box])
        if level:
            for child in range(first, last):
                heapq.heappush(queue, (-float(bounds[level - 1][1][at, child]), level - 1, child))
            continue
        scores = tile.v[first:last] @ anchor
        for row in np.flatnonzero(scores >= min(b.floor() for b in best)).tolist():
            if fits(tile.ids[first + row], tile.labels[first + row]):
                for b in best:
                    b.add(int(scores[row]), int(tile.ids[first + row]))


def search(tiles: DataFrame, anchors: list, width: int, k: int, windows: dict[int, list[tuple[int, int, int]]] | None) -> DataFrame:
    """(anchor_id, goal, score, id): per task the k best of each anchor. Without ``windows`` rows of the anchor's own
    label but itself, goal null; with them, per (goal, low, high) of the anchor, rows of other labels in the window."""
    ids, labels = [a["id"] for a in anchors], [a["label"] for a in anchors]
    v = np.zeros((len(anchors), width), np.int32)
    for i, a in enumerate(anchors):
        v[i, :len(a["v"])] = a["v"]
    shared = tiles.sparkSession.sparkContext.broadcast((ids, labels, v, windows))

    def run(batches):
        ids, labels, v, windows = shared.value
        # Sums of products below 2^53 are exact in doubles, whose products are the faster ones.
        number = np.float64 if len(v) and int(np.abs(v).max()) * LARGEST * width < 1 << 53 else np.int64
        v = v.astype(number)
        up, down = np.maximum(v, 0), np.minimum(v, 0)
        goals = [[(None, None, None)] if windows is None else windows.get(i, []) for i in ids]
        best = [[Best(k, low, high) for _, low, high in g] for g in goals]
        for b in batches:
            for row in b.to_pylist():
                tile = Tile(row, width, number)
                bounds = tile.intervals(up, down)
                for at, i in enumerate(ids):
                    own = labels[at]
                    fits = (lambda x, y, i=i, own=own: y == own and x != i) if windows is None else (lambda x, y, own=own: y != own)
                    best_first(tile, bounds, at, v[at], best[at], fits)
        out = [(i, goal, -s, x) for i, g, bs in zip(ids, goals, best) for (goal, _, _), b in zip(g, bs) for s, x in b.found]
        yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], pa.int64()) for c in range(4)], ["anchor_id", "goal", "score", "id"])

    return tiles.mapInArrow(run, "anchor_id long, goal long, score long, id long")


def merged(found: DataFrame, k: int) -> DataFrame:
    """The k best of all tasks' results, with their rank."""
    order = Window.partitionBy("anchor_id", "goal").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(rows: DataFrame, label: Column, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding",
         positives: int = 5, negatives: int = 10, low_percent: int = 30, high_percent: int = 90, block: int = 4096) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. ``is_anchor`` is over the identifier as ``id``.

    Anchors pass through the driver ``block`` at a time."""
    spark = rows.sparkSession
    x = save(scaled(rows, label, id_col, vector_col), "rtree-rows")
    path = shared_dir(spark, "hard-negatives")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(path)
    n, width, n_anchors = x.agg(F.count(F.lit(1)), F.max(F.size("v")), F.count_if(is_anchor)).first()
    if not n_anchors or not width:
        return spark.read.schema(schema).parquet(path)
    spread = x.select(F.posexplode("v").alias("axis", "c")).groupBy("axis").agg(F.var_pop("c").alias("spread"))
    axes = [r["axis"] for r in spread.orderBy(F.desc("spread"), "axis").limit(2 + LOCAL_AXES).collect()]
    tiles = pack(x, width, axes, n)
    blocks = -(-n_anchors // block)
    for b in range(blocks):
        anchors = x.filter(is_anchor).filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).collect()
        near = save(merged(search(tiles, anchors, width, positives, None), positives).select(
            "anchor_id", F.col("score").alias("positive_score"), F.col("id").alias("positive_id")), "positives")
        windows: dict[int, list] = {}
        for a, s in near.select("anchor_id", "positive_score").distinct().collect():
            low, high = -(-low_percent * s // 100), high_percent * s // 100
            if low <= high:
                windows.setdefault(a, []).append((s, low, high))
        hard = merged(search(tiles, anchors, width, negatives, windows), negatives)
        hard = hard.select("anchor_id", F.col("goal").alias("positive_score"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        out = near.join(hard, ["anchor_id", "positive_score"]).select(
            "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
        out.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)
