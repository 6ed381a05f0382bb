"""Hard negatives by spanning-tree bounds over anchors.

Anchors are grouped in blocks of like vectors and each block gets a spanning tree of least total edge
length. For a candidate ``c``, the score at a parent anchor ``p`` bounds the one at its child ``a``:
``|<a, c> - <p, c>| <= |a - p| * |c|``. So an interval of scores walks down the tree, from the exact
score at the root, and only candidates whose interval meets an anchor's window are scored again; their
exact score is what the children's intervals start from. An anchor that most of a block's candidates
reach is scored with the whole block in one matrix product.

1. Positives: the window of an anchor is open above and begins at the last of its best rows of the same label so far.
2. Negatives: each positive is a window of scores, whose lower end rises as soon as it has enough rows.

Anchor blocks and candidate blocks meet in cells: a cell holds a bounded share of the anchors and its share of
the candidates streams past, so every pair of blocks meets once and none is gathered. Cells return the best
few rows of each window, and the best of all cells are picked by window functions.

Arithmetic is exact: components are whole numbers after scaling, scores are kept as doubles below 2^52
and as Python integers where a block could pass that; a score beyond 64 bits counts as the nearest 64-bit number.

Rows without an id or label, without a vector, or with a null or non-finite component take no part. An empty
vector scores 0, a shorter one counts as filled up with zeros. Each repeated row is a row of its own;
anchors with one id, label and vector count once, and an anchor's other rows are those of other ids. Ties go to the
smaller id. An anchor without positives, and an empty table, give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kerbside.llm.cells import boxed, led, rows_of, unboxed
from kerbside.llm.graph import stored
from kerbside.llm.text import table

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100

CANDIDATE_ROWS = 2048
ANCHOR_ROWS = 1024
# Bytes of anchors that one cell holds, and shares into which the candidates are dealt at most.
CELL_BYTES = 16 << 20
SHARES = 256
# Anchors of a level of the tree that are looked at together, and the share of candidates from which all are scored.
STEP = 64
DENSE = 0.125
EXACT = float(1 << 52)


def rows_to_mine(df: DataFrame, ident: str, label: str | Column, vector: str, is_anchor: Column) -> DataFrame:
    """``ident, label, vector, anchor``: the columns that the operator works on."""
    return df.select(
        F.col(ident).cast("long").alias("ident"), (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"),
        F.col(vector).cast("array<double>").alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))


def hard_negatives(
    rows: DataFrame, scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` from ``rows_to_mine``.

    For each anchor and each of its best ``positives`` rows of the same label, the best ``negatives`` rows of another label
    whose score is within ``low`` and ``high`` hundredths of the positive's.
    """
    candidates = stored(
        rows.select("ident", "label", "vector").mapInArrow(_packed(scale), "n long, data binary")
        .select(F.monotonically_increasing_id().alias("block"), "n", "data"), "candidates")
    # Whole anchors are told apart by content, then put in the order of label and orthant, like ones together.
    single = rows.where("anchor").select("ident", "label", "vector").mapInArrow(
        _singles(scale), "label long, orthant long, ident long, data binary").dropDuplicates(["ident", "label", "data"])
    sorted_ = single.repartitionByRange("label", "orthant").sortWithinPartitions("label", "orthant", "ident", "data")
    anchors = stored(
        sorted_.mapInArrow(_trees, "n long, data binary")
        .select(F.monotonically_increasing_id().alias("block"), "n", "data"), "anchors")

    found = _best(candidates, anchors, _Same(positives), positives).select(
        "block", "slot", F.col("rank").alias("place"), "anchor_id", F.col("ident").alias("positive_id"), F.col("score").alias("positive_score"))
    found = stored(found, "positives")
    windows = found.groupBy("block").agg(
        F.collect_list(F.struct("slot", "place", "positive_score")).alias("windows"))
    ready = anchors.join(windows, "block")
    return _best(candidates, ready, _Other(negatives, positives, low, high), negatives).join(
        found.select("block", "slot", "place", "positive_id", "positive_score"), ["block", "slot", "place"]
    ).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("ident").alias("negative_id"),
             "positive_score", F.col("score").alias("negative_score"))


def _best(candidates: DataFrame, anchors: DataFrame, walk, most: int) -> DataFrame:
    """The ``most`` best rows of each window over all cells: ``block, slot, place, anchor_id, ident, score, rank``."""
    held = anchors.agg(F.sum(F.length("data"))).first()[0] or 0
    blocks = candidates.count()
    columns, shares = 1 + held // CELL_BYTES, max(1, min(blocks, SHARES))

    def run(cell, leaders, followers):
        trees = [walk.tree(unboxed(d)) for d in leaders]
        for data in followers if trees else ():
            block = Candidates(*unboxed(data))
            for tree in trees:
                tree.take(block)
        for tree in trees:
            yield from tree.rows()

    fields = [c for c in anchors.columns if c not in ("n", "data")]
    leaders = anchors.mapInArrow(_with_windows(fields), "block long, data binary")
    # Every block of anchors meets every share of candidates, in the column of cells that holds it.
    leaders = leaders.select("data", F.pmod(F.hash("block"), F.lit(columns)).alias("column"), F.explode(
        F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"))
    followers = candidates.select("data", F.pmod(F.hash("block"), F.lit(shares)).alias("share"), F.explode(
        F.sequence(F.lit(0), F.lit(columns - 1))).alias("column"))
    cell = (F.col("share") * columns + F.col("column")).alias("cell")
    leaders, followers = leaders.select(cell, "data"), followers.select(cell, "data")
    offers = led(leaders, followers, shares * columns, run,
                 "block long, slot int, place int, anchor_id long, ident long, score long")
    window = Window.partitionBy("block", "slot", "place").orderBy(F.desc("score"), "ident")
    return offers.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= most)


def _matrix(batch: pa.RecordBatch, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, labels and whole-numbered vectors of the rows that take part."""
    column = batch.column("vector")
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore", invalid="ignore"):
        flat = np.floor(flat * scale)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    good = np.ones(batch.num_rows, bool)
    for name in ("ident", "label", "vector"):
        good &= batch.column(name).is_valid().to_numpy(zero_copy_only=False)
    good[owner[~np.isfinite(flat)]] = False
    out = np.zeros((batch.num_rows, sizes.max(initial=0)))
    out[owner, place] = flat
    return (*(pc.fill_null(batch.column(n), 0).to_numpy()[good] for n in ("ident", "label")), out[good])


def _small(vectors: np.ndarray) -> np.ndarray:
    return vectors.astype(np.int16) if np.abs(vectors).max(initial=0) < 1 << 15 else vectors


def _packed(scale: int):
    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, CANDIDATE_ROWS):
                ids, labels, vectors = _matrix(batch.slice(start, CANDIDATE_ROWS), scale)
                if len(ids):
                    yield pa.RecordBatch.from_pydict({"n": [len(ids)], "data": [boxed((ids, labels, _small(vectors)))]})

    return run


def _singles(scale: int):
    def run(batches):
        for batch in batches:
            ids, labels, vectors = _matrix(batch, scale)
            signs = vectors[:, :32] > 0
            orthant = signs.astype(np.int64) @ (1 << np.arange(signs.shape[1] - 1, -1, -1, dtype=np.int64))
            # Trailing zeros are left out, so that equal vectors are equal bytes.
            data = [np.trim_zeros(v, "b").astype("<f8").tobytes() for v in vectors]
            yield pa.RecordBatch.from_pydict({"label": labels, "orthant": orthant, "ident": ids, "data": pa.array(data, pa.binary())})

    return run


def _trees(batches):
    held: list[tuple] = []
    for label, ident, data in rows_of(batches, "label", "ident", "data"):
        held.append((ident, label, np.frombuffer(data, "<f8")))
        if len(held) == ANCHOR_ROWS:
            yield _tree_row(held)
            held = []
    if held:
        yield _tree_row(held)


def _tree_row(held: list[tuple]) -> pa.RecordBatch:
    ids, labels = (np.array([h[k] for h in held], np.int64) for k in (0, 1))
    vectors = np.zeros((len(held), max(len(h[2]) for h in held)))
    for row, (_, _, v) in zip(vectors, held):
        row[: len(v)] = v
    return pa.RecordBatch.from_pydict(
        {"n": [len(ids)], "data": [boxed((ids, labels, _small(vectors), *spanning_tree(vectors)))]})


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(parent, depth)`` of a tree of least total edge length; the root is its own parent.

    Lengths are compared as doubles; which tree is chosen changes the work and never a result.
    """
    n = len(vectors)
    with np.errstate(over="ignore", invalid="ignore"):
        squares = np.einsum("ij,ij->i", vectors, vectors)
        apart = np.nan_to_num(squares[:, None] + squares - 2 * (vectors @ vectors.T), nan=np.inf)
        root = int(apart.sum(1).argmin())
    parent, depth = np.full(n, root), np.zeros(n, np.int64)
    left = np.ones(n, bool)
    left[root] = False
    near = apart[root].copy()
    for _ in range(n - 1):
        node = int(np.where(left, near, np.inf).argmin())
        if not left[node]:  # only infinite lengths are left
            node = int(left.argmax())
        left[node] = False
        depth[node] = depth[parent[node]] + 1
        closer = left & (apart[node] < near)
        near[closer], parent[closer] = apart[node][closer], node
    return parent, depth


def _norms(squares: np.ndarray) -> np.ndarray:
    """A whole number above the root of each sum of squares."""
    if squares.dtype == object:
        return np.array([math.isqrt(s) + 1 for s in squares], object)
    return np.floor(np.sqrt(squares)) + 1


def _whole(vectors: np.ndarray, exact: bool) -> np.ndarray:
    if exact:
        return vectors.astype(np.float64)
    return np.array([[int(x) for x in row] for row in vectors], object).reshape(vectors.shape)


def _cut(scores: np.ndarray) -> np.ndarray:
    """Exact scores as 64-bit numbers; doubles are far below that bound already."""
    return scores if scores.dtype != object else np.maximum(np.minimum(scores, (1 << 63) - 1), -(1 << 63))


class Candidates:
    """A block of candidate rows."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.top = float(np.abs(vectors.astype(np.float64)).max(initial=0))
        self._kinds: dict = {}

    def kind(self, exact: bool, width: int) -> tuple[np.ndarray, np.ndarray]:
        if (exact, width) not in self._kinds:
            v = _whole(self.vectors, exact)
            v = np.concatenate([v, np.zeros((len(v), max(0, width - v.shape[1])), v.dtype)], 1)
            self._kinds[exact, width] = v, _norms((v * v).sum(1))
        return self._kinds[exact, width]


def _with_windows(fields: list[str]):
    """Blocks of anchors with their number and, where there are any, their windows."""
    windows = "windows" in fields

    def run(batches):
        for block, data, *more in rows_of(batches, "block", "data", *(["windows"] if windows else [])):
            found = [(w["slot"], w["place"], w["positive_score"]) for w in more[0]] if windows else []
            yield pa.RecordBatch.from_pydict({"block": [block], "data": [boxed((block, data, found))]})

    return run


class Tree:
    """A block of anchors, its tree, and the best rows of each of its windows so far."""

    def __init__(self, boxed_block: tuple, windows: int, most: int, same: bool):
        self.block, data, found = boxed_block
        self.ids, self.labels, self.vectors, self.parent, self.depth = unboxed(data)
        self.levels = [np.flatnonzero(self.depth == d) for d in range(int(self.depth.max(initial=0)) + 1)]
        self.windows, self.most, self.same = windows, most, same
        n = len(self.ids)
        # The window of scores, and the rows found in it; an empty window ends below where it begins.
        self.low = np.full((n, windows), -math.inf, object)
        self.high = np.full((n, windows), math.inf if same else -math.inf, object)
        self.best: list[list[tuple]] = [[] for _ in range(n * windows)]
        self.floor = self.low.copy()
        self.found = found
        self._kinds: dict = {}

    def open(self, slot: int, window: int, low, high) -> None:
        self.low[slot, window], self.high[slot, window] = low, high
        self.floor[slot, window] = low

    def _kind(self, exact: bool, width: int):
        if (exact, width) not in self._kinds:
            v = _whole(self.vectors, exact)
            v = np.concatenate([v, np.zeros((len(v), max(0, width - v.shape[1])), v.dtype)], 1)
            gap = v - v[self.parent]
            self._kinds[exact, width] = v, _norms((gap * gap).sum(1))
        return self._kinds[exact, width]

    def take(self, block: Candidates) -> None:
        """Offers the candidates of ``block`` to every window."""
        n, width = len(block.ids), max(block.vectors.shape[1], self.vectors.shape[1])
        top = float(np.abs(self.vectors.astype(np.float64)).max(initial=0))
        exact = 8 * (width + 1) * max(top, block.top, 1) ** 2 < EXACT
        anchors, edge = self._kind(exact, width)
        rows, norm = block.kind(exact, width)
        kind = np.float64 if exact else object
        low, high = np.empty((n, len(self.ids)), kind), np.empty((n, len(self.ids)), kind)
        for level in self.levels:
            for at in range(0, len(level), STEP):
                self._step(level[at : at + STEP], block, anchors, edge, rows, norm, low, high, kind)

    def _step(self, nodes, block, anchors, edge, rows, norm, low, high, kind) -> None:
        floor, ceiling = self.floor[nodes].astype(kind), self.high[nodes].astype(kind)
        fits = block.labels[:, None] == self.labels[nodes]
        fits = fits & (block.ids[:, None] != self.ids[nodes]) if self.same else ~fits
        if self.depth[nodes[0]] == 0:
            low[:, nodes] = high[:, nodes] = _cut(rows @ anchors[nodes].T)
            near = fits
        else:
            reach = norm[:, None] * edge[nodes]
            lo, hi = low[:, self.parent[nodes]] - reach, high[:, self.parent[nodes]] + reach
            near = np.zeros(fits.shape, bool)
            for w in range(self.windows):
                near |= ((hi >= floor[:, w]) & (lo <= ceiling[:, w])).astype(bool)
            near &= fits
            dense = near.mean(0) > DENSE
            if dense.any():
                lo[:, dense] = hi[:, dense] = _cut(rows @ anchors[nodes[dense]].T)
            r, c = np.nonzero(near & ~dense)
            lo[r, c] = hi[r, c] = _cut((rows[r] * anchors[nodes[c]]).sum(1))
            low[:, nodes], high[:, nodes] = lo, hi
        scores = low[:, nodes]
        for w in range(self.windows):
            r, c = np.nonzero(near & (scores >= floor[:, w]).astype(bool) & (scores <= ceiling[:, w]).astype(bool))
            if len(r):
                self._keep(nodes[c] * self.windows + w, scores[r, c], block.ids[r])

    def _keep(self, slots: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        if scores.dtype == object:
            order = np.array(sorted(range(len(slots)), key=lambda i: (slots[i], -scores[i], ids[i])))
        else:
            order = np.lexsort((ids, -scores, slots))
        slots, scores, ids = slots[order], scores[order], ids[order]
        head = np.flatnonzero(np.r_[True, slots[1:] != slots[:-1]])
        for a, b in zip(head, [*head[1:], len(slots)]):
            slot, b = int(slots[a]), min(b, a + self.most)
            new = zip((-int(s) for s in scores[a:b]), ids[a:b].tolist())
            best = sorted([*self.best[slot], *new])[: self.most]
            self.best[slot] = best
            if len(best) == self.most:
                self.floor[slot // self.windows, slot % self.windows] = -best[-1][0]

    def rows(self) -> Iterator[pa.RecordBatch]:
        out = [(self.block, slot // self.windows, slot % self.windows + 1, int(self.ids[slot // self.windows]), ident,
                -score)
               for slot, best in enumerate(self.best) for score, ident in best]
        for at in range(0, len(out), 10_000):
            names = ("block", "slot", "place", "anchor_id", "ident", "score")
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            columns = zip(*out[at : at + 10_000])
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


class _Same:
    """Best rows of the anchor's own label."""

    def __init__(self, most: int):
        self.most = most

    def tree(self, block: tuple) -> Tree:
        return Tree(block, 1, self.most, True)


class _Other:
    """Best rows of other labels in the windows of the positives."""

    def __init__(self, most: int, windows: int, low: int, high: int):
        self.most, self.windows, self.low, self.high = most, windows, low, high

    def tree(self, block: tuple) -> Tree:
        tree = Tree(block, self.windows, self.most, False)
        for slot, place, score in tree.found:
            # The whole numbers s with low * score <= 100 * s <= high * score.
            tree.open(slot, place - 1, -(-self.low * score // 100), self.high * score // 100)
        return tree


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth row of ``embeddings`` among all rows."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows_to_mine(rows, "vec_id", label, "embedding", F.col("vec_id") % 100 == 0))


SQL = f"""
WITH parts AS (
    SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i, len(embedding) AS dims
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL
), vectors AS (
    SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
           list(CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS DOUBLE) ORDER BY i) AS v
    FROM parts GROUP BY vec_id, label, dims HAVING count(x) = dims AND bool_and(isfinite(CAST(x AS DOUBLE)))
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
           CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM vectors a, vectors b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT * FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {POSITIVES}
)
SELECT p.anchor_id, p.other_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank,
       n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
     AND {LOW} * p.score <= 100 * n.score AND 100 * n.score <= {HIGH} * p.score
QUALIFY rank <= {NEGATIVES}
"""
