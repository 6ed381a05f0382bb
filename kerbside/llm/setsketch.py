"""Near-duplicate documents by SetSketch registers, banded, estimated and then confirmed.

A document's set is its distinct 5-word shingles (words ``[^\\x20\\x09-\\x0D]+`` after A-Z are
lower-cased). Register ``i`` of its sketch is ``floor(1 - log_b(x_i))``, cut to ``0..q + 1``, where
``x_i`` is the least of exponentially distributed values that a hash gives the shingles:
exponentially spaced, truncated minima. Equal registers of two sketches are about as likely as
their sets are alike, and the sketch of a union is the registers' maximum (``merge``).

1. Equal sets are one class from the start, named by their least doc_id; the rest of the work
   is on one document of each class.
2. Bands of ``rows`` registers are keys. Classes that share a key are compared by their sketches:
   the similarity of highest likelihood, given the joint registers, drops pairs far below the
   bound (six standard errors). What stays connected is a candidate group. Keys whose classes are connected by then
   are not compared (``alike``).
3. Members of a candidate group are confirmed pair by pair on their full shingle sets. Tasks return
   a forest of the links they find, never all pairs, and no task holds a whole wide group
   (``near_components``).
4. The components of the confirmed links are the result.

With 240 registers in 60 bands of 4, a pair at the bound of 0.75 shares no band with a probability
of ``(1 - 0.75 ** 4) ** 60 < 2e-10``. Shingles and sets are compared
by 64-bit and 128-bit hashes.

Null, empty and wordless texts have an empty set, and are linked with nothing. A text of fewer
than five words is one shingle. Repeated rows are copies: each stays a row and gets the
component of its text; rows without a doc_id do not take part, get no component and are kept.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.graph import components, stored
from kerbside.llm.text import LOWER, WordHashes, bounded, free_name, gram_hashes, mix, table, text_bytes

SHINGLE = 5
BOUND = (75, 100)
ROWS, BANDS = 4, 60
# Bands that are compared first; of the others only keys whose classes these have not brought together.
FIRST_BANDS = 10
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 2
# Members that one task compares with each other, by their sketches and by their full sets.
WIDE_SKETCHES, WIDE_SETS = 512, 256
# Bytes of payloads that one task compares, leaders apart; a single longer set stands alone.
SET_BYTES = 8 << 20


def shingle_set(text: bytes | None, hashes: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a text."""
    words = text.translate(LOWER).split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    values = hashes.array(words)
    if len(values) < size:
        return mix(gram_hashes(values, len(values)) + np.uint64(len(values)))
    return np.unique(gram_hashes(values, size))


def registers(sets: list[np.ndarray], count: int, seed: int = 0x5EED) -> np.ndarray:
    """A sketch per set: ``count`` registers of 16 bits."""
    out = np.zeros((len(sets), count), np.uint16)
    filled = [k for k, s in enumerate(sets) if len(s)]
    if not filled:
        return out
    values = np.concatenate([sets[k] for k in filled])
    starts = np.cumsum([0, *(len(sets[k]) for k in filled[:-1])])
    keys = mix(np.arange(seed, seed + 2 * count, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    scale = 1 / math.log(BASE)
    for i in range(count):
        # The values are hashes already: their order by the high bits of a product is a fresh one.
        least = np.minimum.reduceat((values ^ keys[2 * i]) * (keys[2 * i + 1] | np.uint64(1)), starts)
        x = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
        out[filled, i] = np.clip(np.floor(1 - np.log(x) * scale), 0, TOP + 1).astype(np.uint16)
    return out


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sketched sets."""
    return np.maximum(a, b)


def likely_jaccard(more, less, same, n_a, n_b):
    """Similarity of highest likelihood, from the order of paired registers and both set sizes.

    ``more``, ``less`` and ``same`` count the registers of the first sketch that are above, below and
    equal to the second's. Closed form of the maximum for a base close to one.
    """
    u = n_a / (n_a + n_b)
    v = 1 - u
    left, right = u * u * (same + less), v * v * (same + more)
    root = np.sqrt((left - right) ** 2 + 4 * more * less * u * u * v * v)
    return np.clip((left + right - root) / (2 * u * v * (more + less + same)), 0, 1)


def sketch_documents(docs: DataFrame, count: int = ROWS * BANDS) -> DataFrame:
    """``doc_id, n_shingles, set_id, sketch`` of every document."""

    def run(batches):
        hashes = WordHashes()
        for batch in bounded(batches):
            sets = [shingle_set(t, hashes) for t in text_bytes(batch.column("text"))]
            sketches = registers(sets, count)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                pa.array([s.tobytes() for s in sketches], pa.binary()),
            ], ["doc_id", "n_shingles", "set_id", "sketch"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return plain.mapInArrow(run, "doc_id long, n_shingles long, set_id binary, sketch binary")


def _band_keys(classes: DataFrame, rows: int, bands: int) -> DataFrame:
    """``rep, band, first``: a 64-bit key for each band of each class's registers, and whether it is one of the first bands."""

    def run(batches):
        for batch in batches:
            sketches = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint16)
            sketches = sketches.reshape(batch.num_rows, -1).astype(np.uint64)
            keys = np.stack([
                mix(gram_hashes(np.ascontiguousarray(sketches[:, k * rows : (k + 1) * rows]).reshape(-1), rows)[::rows]
                    + np.uint64(k)) if batch.num_rows else np.empty(0, np.uint64)
                for k in range(bands)
            ], 1)
            reps = np.repeat(batch.column("rep").to_numpy(), bands)
            first = np.tile(np.arange(bands) < FIRST_BANDS, batch.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(reps, pa.int64()), pa.array(keys.reshape(-1).view(np.int64)), pa.array(first)],
                                             ["rep", "band", "first"])

    return classes.select("rep", "sketch").mapInArrow(run, "rep long, band long, first boolean")


def _whole_groups(batches, most_rows: int = 2000, most_bytes: int = 8 << 20):
    """Tables of whole groups, from batches sorted by ``key`` and ``block``, with the groups' starts.

    A group that goes on in the next batch waits for it; about ``most_rows`` or ``most_bytes`` of payload are gathered.
    """
    held: list[pa.RecordBatch] = []
    rows = size = 0
    for batch in bounded(batches, "payload", most_bytes):
        held.append(batch)
        rows += batch.num_rows
        size += pc.sum(pc.binary_length(batch.column("payload"))).as_py() or 0
        if rows >= most_rows or size >= most_bytes:
            found = pa.Table.from_batches(held).combine_chunks()
            starts = _starts(found)
            if len(starts) > 1:
                yield found.slice(0, starts[-1]), starts[:-1]
                # Copied, so that the rows before it can go.
                rest = found.take(pa.array(np.arange(starts[-1], found.num_rows)))
                held, rows = rest.to_batches(), rest.num_rows
                size = pc.sum(pc.binary_length(rest.column("payload"))).as_py() or 0
    if held:
        found = pa.Table.from_batches(held).combine_chunks()
        yield found, _starts(found)


def _starts(found: pa.Table) -> np.ndarray:
    key, block = found.column("key").to_numpy(), found.column("block").to_numpy()
    return np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (block[1:] != block[:-1])])


class _Forest:
    """Union-find over the row numbers of one group."""

    def __init__(self, size: int):
        self.up = list(range(size))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _linked_rows(compare, batches):
    """Edges between components that connect, within each group, what the links of ``compare`` connect: stars around the least."""
    for found, starts in _whole_groups(batches):
        ends = [*starts[1:].tolist(), found.num_rows]
        of, side = (found.column(c).to_numpy() for c in ("component", "side"))
        edges_a, edges_b = [], []
        for start, end, x, y in compare(found, starts.tolist(), ends, side):
            forest, base = _Forest(end - start), {}
            for k, component in enumerate(of[start:end].tolist()):  # what is already known
                forest.join(base.setdefault(component, k), k)
            if not any([forest.join(i, j) for i, j in zip(x.tolist(), y.tolist())]):
                continue
            least = {}
            for component in sorted(base):
                center = least.setdefault(forest.root(base[component]), component)
                if center != component:
                    edges_a.append(component)
                    edges_b.append(center)
        yield pa.RecordBatch.from_arrays([pa.array(edges_a, pa.int64()), pa.array(edges_b, pa.int64())], ["a", "b"])


def _pairs_of(side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs to compare: each with each, or the rows of side 1 with all others."""
    if not side.any():
        return np.triu_indices(len(side), 1)
    x, y = np.meshgrid(np.flatnonzero(side == 1), np.arange(len(side)), indexing="ij")
    x, y = x.ravel(), y.ravel()
    keep = (x != y) & ((side[y] == 0) | (x < y))
    return x[keep], y[keep]


def _by_sketch(similarity: float, registers_: int):
    """Links of pairs whose sketches don't rule the bound out, by six standard errors."""
    least = similarity - 6 * math.sqrt(similarity * (1 - similarity) / registers_)

    def likely(sketch, size, x, y):
        keep = np.minimum(size[x], size[y]) >= similarity * np.maximum(size[x], size[y])
        x, y = x[keep], y[keep]
        good = np.empty(len(x), bool)
        for at in range(0, len(x), 20_000):
            i, j = x[at : at + 20_000], y[at : at + 20_000]
            p, q = sketch[i], sketch[j]
            more, less = (p > q).sum(1), (p < q).sum(1)
            good[at : at + 20_000] = likely_jaccard(more, less, sketch.shape[1] - more - less, size[i], size[j]) >= least
        return x[good], y[good]

    def compare(found, starts, ends, side):
        sketch = np.frombuffer(b"".join(found.column("payload").to_pylist()), np.uint16).reshape(found.num_rows, -1)
        size = found.column("size").to_numpy().astype(np.float64)
        firsts, xs, ys = [], [], []
        for start, end in zip(starts, ends):
            x, y = _pairs_of(side[start:end])
            if len(x) > 20_000:
                yield start, end, *likely(sketch[start:end], size[start:end], x, y)
            elif len(x):
                firsts.append(np.full(len(x), start)), xs.append(x + start), ys.append(y + start)
        if xs:  # the many small groups go through in one call
            first = np.concatenate(firsts)
            at, end_of = np.concatenate(xs), dict(zip(starts, ends))
            x, y = likely(sketch, size, at, np.concatenate(ys))
            first = np.repeat(np.array(starts), np.diff([*starts, found.num_rows]))[x]
            cut = np.flatnonzero(np.r_[True, first[1:] != first[:-1]]) if len(first) else np.empty(0, int)
            for lo, hi in zip(cut.tolist(), [*cut[1:].tolist(), len(first)]):
                start = int(first[lo])
                yield start, end_of[start], x[lo:hi] - start, y[lo:hi] - start

    return compare


def _by_sets(bound: tuple[int, int]):
    """Links of pairs that meet the bound on their full sets; shared items are counted by matrix products."""

    def compare(found, starts, ends, side):
        payload = found.column("payload")
        for start, end in zip(starts, ends):
            if end - start < 2:
                continue
            sets = [np.frombuffer(payload[k].as_py(), np.uint64) for k in range(start, end)]
            size = np.array([len(s) for s in sets])
            rows = np.repeat(np.arange(len(sets)), size)
            _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
            shared = count[column] > 1
            rows, column = rows[shared], (np.cumsum(count > 1) - 1)[column[shared]]
            order = np.argsort(column, kind="stable")
            rows, column = rows[order], column[order]
            columns = int(column[-1]) + 1 if len(column) else 0
            width = min(columns, max(1, (8 << 20) // len(sets)))
            left = np.flatnonzero(side[start:end] == 1) if side[start:end].any() else np.arange(len(sets))
            both = np.zeros((len(left), len(sets)))
            for at in range(0, columns, max(1, width)):
                lo, hi = np.searchsorted(column, [at, at + width])
                matrix = np.zeros((len(sets), width), np.float32)
                matrix[rows[lo:hi], column[lo:hi] - at] = 1
                both += matrix[left] @ matrix.T
            meets = bound[1] * both >= bound[0] * (size[left][:, None] + size[None, :] - both)
            x, y = np.nonzero(meets)
            x = left[x]
            yield start, end, x[x != y], y[x != y]

    return compare


def _sized(members: DataFrame, width: int, most_bytes: int = SET_BYTES) -> DataFrame:
    """``members(key, n, bytes, ...)`` with ``k``, the number of blocks of about ``width`` members and ``most_bytes`` that their key needs."""
    return members.where("n > 1").withColumn("k", F.ceil(F.greatest(F.col("n") / width, F.col("bytes") / most_bytes)))


def _links(rows: DataFrame, payloads: DataFrame, compare) -> DataFrame:
    """Edges ``(a, b)`` between the components of ``rows(key, block, node, component, side)``: members of one block are compared.

    Members are ids until they are compared; then each gets its row of ``payloads(node, size, payload)``.
    """
    columns = ["key", "block", "node", "component", "side", "size", "payload"]
    # Comparing takes long for its bytes, so the tasks are not merged by size.
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.join(payloads, "node").select(*columns).repartition(tasks, "key", "block").sortWithinPartitions("key", "block")
    return stored(dealt.mapInArrow(lambda b: _linked_rows(compare, b), "a long, b long"), "links")


def _in_blocks(members: DataFrame) -> DataFrame:
    """Members of ``_sized`` dealt into ``k`` blocks a key, with the same few leaders in each.

    That connects a group of copies at a cost linear in its size.
    """
    leaders = 16
    block = F.pmod(F.xxhash64("node"), F.col("k"))
    lead = (F.col("k") > 1) & (F.pmod(F.xxhash64(F.lit(1), "node"), F.ceil(F.col("n") / leaders)) == 0)
    blocks = F.when(lead, F.sequence(F.lit(0).cast("long"), F.col("k") - 1)).otherwise(F.array(block))
    return members.withColumn("block", F.explode(blocks)).withColumn("side", F.lit(0))


def _outsiders(members: DataFrame, width: int, most_bytes: int = SET_BYTES) -> DataFrame:
    """Members of ``_sized`` in blocks where those outside their key's largest component meet all others of the key.

    Keys whose members are in one component are left out.
    """
    held = members.groupBy("key", "component").agg(F.count("*").alias("n"), F.sum("weight").alias("bytes"))
    main = held.groupBy("key").agg(F.max(F.struct("n", "component", "bytes")).alias("main"), F.sum("n").alias("all"), F.sum("bytes").alias("whole"))
    kl = F.ceil(F.greatest((F.col("all") - F.col("main.n")) / width, (F.col("whole") - F.col("main.bytes")) / most_bytes))
    members = members.join(main.select("key", F.col("main.component").alias("main"), kl.alias("kl")).where("kl > 0"), "key")
    outside = F.col("component") != F.col("main")
    # Block numbers pair a block of outsiders with a block of all members.
    row = F.pmod(F.xxhash64(F.lit(2), "node"), F.col("kl"))
    block = F.pmod(F.xxhash64("node"), F.col("k"))
    as_left = F.transform(F.sequence(F.lit(0).cast("long"), F.col("k") - 1), lambda c: row * F.col("k") + c)
    as_right = F.transform(F.sequence(F.lit(0).cast("long"), F.col("kl") - 1), lambda r: r * F.col("k") + block)
    return members.where(outside).withColumn("side", F.lit(1)).withColumn("block", F.explode(as_left)).unionByName(
        members.withColumn("side", F.lit(0)).withColumn("block", F.explode(as_right)))


def _renamed(known: DataFrame, links: DataFrame) -> DataFrame:
    """``known(node, component)`` after ``links`` between components, and the nodes that only the links name."""
    now = components(links).select(F.col("node").alias("was"), F.col("component").alias("now"))
    moved = known.join(now, known.component == now.was, "left").select("node", F.coalesce("now", "component").alias("component"))
    new = now.join(known, now.was == known.node, "left_anti").select(F.col("was").alias("node"), F.col("now").alias("component"))
    return stored(moved.unionByName(new), "components")


def _of(members: DataFrame, known: DataFrame) -> DataFrame:
    """``members`` with their ``component``; a node that is not known is its own."""
    known = known.select(F.col("node").alias("_of"), "component")
    return members.join(known, members.node == known._of, "left").drop("_of").withColumn("component", F.coalesce("component", "node"))


def alike(classes: DataFrame, similarity: float, rows: int, bands: int) -> DataFrame:
    """``node, component``: what is connected by pairs that share a band and whose sketches allow for the bound.

    The first bands connect most of what there is, in blocks. In each of the others, classes that are in one component already
    learn nothing from each other, so only keys with several components are compared, and those of the first bands that took
    several blocks; a large group of near copies is met in a few bands and not in all. Of keys with the same nodes one is
    compared: near copies share most of their bands. Sets of nodes are told apart by their number and two 64-bit sums without
    carry of their hashed ids.
    """
    keys = _band_keys(classes, rows, bands)
    often = keys.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    weight = F.lit(2 * rows * bands)
    keys = stored(keys.join(often, "band"), "bands").select(
        F.col("band").alias("key"), F.col("rep").alias("node"), "first", "n", weight.alias("weight"), (F.col("n") * weight).alias("bytes"))
    keys = _sized(keys, WIDE_SKETCHES)
    sketches = classes.select(F.col("rep").alias("node"), F.col("n_shingles").alias("size"), F.col("sketch").alias("payload"))
    compare = _by_sketch(similarity, rows * bands)
    known = components(_links(_in_blocks(keys.where("first").withColumn("component", F.col("node"))), sketches, compare))
    late = _of(keys.where("not first or k > 1").drop("first"), known)
    held = late.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("y"))
    once = held.where("low <> high").groupBy("n", "x", "y").agg(F.min("key").alias("key"))
    late = stored(late.join(once.select("key"), "key", "left_semi"), "members")
    if late.isEmpty():
        return known
    # A wide key that the first bands left in many components is one of unlike members, which leaders don't connect either.
    return _renamed(known, _links(_outsiders(late, WIDE_SKETCHES), sketches, compare))


def near_components(docs: DataFrame, classes: DataFrame, bound: tuple[int, int] = BOUND, rows: int = ROWS,
                    bands: int = BANDS) -> DataFrame:
    """``node, component``: classes that links connect, confirmed on full sets.

    Members of a wide group meet in blocks first; then only those outside its largest component meet all others.
    """
    groups = alike(classes, bound[0] / bound[1], rows, bands)
    sets = _full_sets(docs, groups.select(F.col("node").alias("rep")))
    members = groups.join(classes, groups.node == classes.rep).select(
        F.col("component").alias("key"), "node", (8 * F.col("n_shingles")).alias("weight"), F.col("node").alias("component"))
    sizes = members.groupBy("key").agg(F.count("*").alias("n"), F.sum("weight").alias("bytes"))
    members = stored(_sized(members.join(sizes, "key"), WIDE_SETS), "members")
    payloads = sets.select(F.col("rep").alias("node"), F.lit(0).alias("size"), F.col("items").alias("payload"))
    compare = _by_sets(bound)
    joined = components(_links(_in_blocks(members), payloads, compare))
    wide = members.where("k > 1").drop("component")
    if wide.isEmpty():
        return joined
    rest = stored(_outsiders(_of(wide, joined), WIDE_SETS), "wide")
    return joined if rest.isEmpty() else _renamed(joined, _links(rest, payloads, compare))


def _full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``rep, items``: the sorted shingle hashes of the wanted documents."""

    def run(batches):
        hashes = WordHashes()
        for batch in bounded(batches):
            sets = [shingle_set(t, hashes).tobytes() for t in text_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(sets, pa.binary())], ["rep", "items"])

    plain = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("rep"), "text")
    return stored(plain.join(wanted, "rep", "left_semi").mapInArrow(run, "rep long, items binary"), "sets")


def near_duplicates(docs: DataFrame, bound: tuple[int, int] = BOUND) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``."""
    sketched = stored(sketch_documents(docs), "sketches")
    classes = sketched.where("n_shingles > 0 and doc_id is not null").groupBy("set_id").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("copies"),
        F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"))
    classes = stored(classes, "classes")
    joined = near_components(docs, classes.drop("copies", "set_id"), bound)
    named = classes.join(joined, classes.rep == joined.node, "left").select(
        "set_id", "copies", "rep", F.coalesce("component", "rep").alias("component"))
    named = named.where("copies > 1 or component <> rep").select("set_id", "component")
    with_id = sketched.join(named, "set_id", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
    return with_id.withColumn("kept", F.col("component_id").eqNullSafe(F.col("doc_id")))


def drop_near_duplicates(docs: DataFrame, bound: tuple[int, int] = BOUND) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, columns as they were.

    The row with the group's least doc_id stays; of rows that repeat it, one stays. Rows without an
    id belong to no group and stay.
    """
    others = near_duplicates(docs, bound).where("not kept").select("doc_id").distinct()
    apart = free_name(docs, "apart")
    left = docs.join(others, "doc_id", "left_anti").withColumn(
        apart, F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()))
    return left.dropDuplicates(["doc_id", apart]).select(*docs.columns)


def op10_near_duplicates(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN 'all ' ELSE '' END || array_to_string(ws[i : i + 4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
step AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM w UNION SELECT reach.doc_id, step.b FROM reach JOIN step ON step.a = reach.r),
c AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)
"""
