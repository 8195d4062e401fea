"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors with cosine >= t are at most eps = sqrt(2 - 2t) apart. The vectors are rotated
to their principal dimensions (a rotation keeps distances), the leading ones are cut into
cells of width eps, and the vectors are sorted by cell, then by value: the epsilon grid
order. Intervals of that sequence have a box on the leading dimensions; two intervals whose
boxes are more than eps apart hold no link. Pairs of intervals are refined level by level
(parts, which are folders, blocks, which are rows, and leaves within a block), each pair into
the pairs of its parts, and only what is not provably distant goes on. The leaf pairs left are
compared by exact cosines in double precision.

Vectors are moved once, into the sequence, as the numbers they came as. The tasks that compare
blocks read both sides where they lie, so what a join writes does not grow with its pairs.

Equal vectors are one row with a count. A block pair gives link counts per vector and a
forest of its links (fewer edges than vectors), never the pairs themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from revlens.llm.common import map_arrow, rows_of, shuffle_width, smallest_reachable, stage, table
from revlens.session import scratch_path

COSINE = 0.95
LEADING = 8
LEAF = 512
BLOCK = 8_192
BLOCK_BYTES = 2**21
SLICE = 4_096
TILE = 1_024
BLOCKS_KEPT = 8
PARTS = 32
EXACT_CELLS = 2**20


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(node, embedding) to (width, nodes, copies, vectors), each vector once in a batch."""
    for batch in rows_of(batches):
        nodes, first, copies = np.unique(batch.column(0).to_numpy(), return_index=True, return_counts=True)
        lists = batch.column(1).take(pa.array(first))
        widths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        for width in np.unique(widths):
            at = np.flatnonzero(widths == width)
            vectors = lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
            yield int(width), nodes[at], copies[at], vectors.reshape(len(at), -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors in doubles; those whose length is no number of that size link with nothing.

    Sums go column by column, so equal rows get equal results in any company.
    """
    rows = vectors.astype(np.float64)
    squares = np.zeros(len(rows))
    with np.errstate(over="ignore"):
        for column in rows.T:
            squares += column * column
    length = np.sqrt(squares)[:, None]
    return np.divide(rows, length, out=np.zeros_like(rows), where=length > 0)


def _lead(units: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Coordinates on the leading axes, equal for equal rows as in ``_unit``."""
    lead = np.zeros((len(units), axes.shape[1]))
    for column, axis in zip(units.T, axes, strict=True):
        lead += column[:, None] * axis
    return lead


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, embedding) to one row of sums per width: count, sum and outer product."""
    sums: dict[int, np.ndarray] = {}
    for width, _, _, vectors in _distinct(batches):
        x = np.pad(_unit(vectors), ((0, 0), (0, 1)), constant_values=1.0)
        total = sums.setdefault(width, np.zeros((width + 1, width + 1)))
        total += x.T @ x
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(list(sums), pa.int32()),
            pa.array([s.tobytes() for s in sums.values()], pa.binary()),
        ],
        ["width", "sums"],
    )


def _axes(plain: DataFrame) -> dict[int, np.ndarray]:
    """Leading principal axes by vector width, from sums over all rows.

    Each task sends one matrix per width; they are added pairwise by width in the tasks of
    one shuffle, and one matrix per width reaches the driver.
    """

    def add(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in rows:
            for width, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[width] = total.get(width, 0) + np.frombuffer(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([s.tobytes() for s in total.values()], pa.binary())],
            ["width", "sums"],
        )

    parts = map_arrow(plain, _moments, "width int, sums binary")
    whole = map_arrow(parts.repartition("width"), add, "width int, sums binary")
    axes = {}
    for width, sums in whole.collect():
        matrix = np.frombuffer(bytes(sums)).reshape(width + 1, width + 1)
        count = max(matrix[-1, -1], 1.0)
        mean = matrix[-1, :-1] / count
        _, vectors = np.linalg.eigh(matrix[:-1, :-1] / count - np.outer(mean, mean))
        axes[width] = np.ascontiguousarray(vectors[:, ::-1][:, :LEADING])
    return axes


def _cells(axes: dict[int, np.ndarray], eps: float):
    """(node, embedding) to (width, place, node, copies, vector as bytes).

    ``place`` is the cell on the leading dimensions, then the place within it in 256ths.
    """
    kind = next(k for k in (">u1", ">u2", ">u4") if 1 / eps + 2 < 2 ** (8 * np.dtype(k).itemsize - 1))
    middle = 2 ** (8 * np.dtype(kind).itemsize - 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for width, nodes, copies, vectors in _distinct(batches):
            steps = _lead(_unit(vectors), axes[width]) / eps
            whole = np.floor(steps)
            # Big-endian offsets sort as bytes do; cells lie within +-1/eps.
            cells = np.ascontiguousarray((whole + middle).astype(kind)).view(np.uint8).reshape(len(nodes), -1)
            within = np.minimum((steps - whole) * 256, 255).astype(np.uint8)
            places = [x.tobytes() for x in np.concatenate([cells, within], axis=1)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([width] * len(nodes), pa.int32()),
                    pa.array(places, pa.binary()),
                    pa.array(nodes),
                    pa.array(copies.astype(np.int64)),
                    pa.array([x.tobytes() for x in vectors], pa.binary()),
                ],
                ["width", "place", "node", "copies", "vector"],
            )

    return place


def _blocks(axes: dict[int, np.ndarray], kind: type, most: int, leaf: int):
    """Sorted rows to packed blocks: ids, vectors and boxes of up to ``most`` rows of one width."""

    def packed(width: int, nodes: np.ndarray, copies: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
        lead = _lead(_unit(vectors), axes[width])
        starts = np.arange(0, len(nodes), leaf)
        low, high = np.minimum.reduceat(lead, starts), np.maximum.reduceat(lead, starts)
        return pa.RecordBatch.from_pylist(
            [
                {
                    "width": width,
                    "nodes": nodes.tobytes(),
                    "copies": copies.tobytes(),
                    "vectors": vectors.tobytes(),
                    "boxes": np.stack([low, high]).tobytes(),
                    "low": low.min(axis=0).tolist(),
                    "high": high.max(axis=0).tolist(),
                }
            ],
            schema=pa.schema(
                [
                    ("width", pa.int32()),
                    *[(name, pa.binary()) for name in ("nodes", "copies", "vectors", "boxes")],
                    ("low", pa.list_(pa.float64())),
                    ("high", pa.list_(pa.float64())),
                ]
            ),
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, held = None, None
        for batch in rows_of(batches):
            widths, nodes, copies = (batch.column(c).to_numpy() for c in (0, 2, 3))
            cuts = [0, *(np.flatnonzero(np.diff(widths)) + 1).tolist(), batch.num_rows]
            for start, stop in zip(cuts, cuts[1:]):
                vectors = np.frombuffer(b"".join(batch.column(4)[start:stop].to_pylist()), kind)
                run = nodes[start:stop], copies[start:stop], vectors.reshape(stop - start, -1)
                if width is not None and width != widths[start]:
                    yield packed(width, *held)
                    held = None
                width = int(widths[start])
                held = _merged(*(run if held is None else map(np.concatenate, zip(held, run, strict=True))))
                size = max(64, min(most, BLOCK_BYTES // (width * np.dtype(kind).itemsize)))
                while len(held[0]) > size:  # the last row may have copies to come
                    yield packed(width, *(x[:size] for x in held))
                    held = tuple(x[size:] for x in held)
        if held is not None:
            yield packed(width, *held)

    return pack


def _merged(nodes: np.ndarray, copies: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours that are one vector as one row."""
    first = np.flatnonzero(np.append(True, np.diff(nodes) != 0))
    return nodes[first], np.add.reduceat(copies, first), vectors[first]


class _Block:
    """A block read from its row, with what screens its vectors."""

    def __init__(self, row: dict, side: str, kind: type, leaf: int) -> None:
        width = row["width_a"].as_py()
        self.ids = np.frombuffer(row[f"nodes_{side}"].as_buffer(), np.int64)
        self.copies = np.frombuffer(row[f"copies_{side}"].as_buffer(), np.int64)
        self.units = _unit(np.frombuffer(row[f"vectors_{side}"].as_buffer(), kind).reshape(-1, width))
        self.low, self.high = np.frombuffer(row[f"boxes_{side}"].as_buffer()).reshape(2, -(-len(self.ids) // leaf), -1)
        self.screens = _screens(self.units)


def _screens(units: np.ndarray) -> list[np.ndarray]:
    """Rows whose products are no less than the cosines: some components and the length of the rest; all."""
    some = units[:, : max(1, 3 * units.shape[1] // 8)]
    rest = np.sqrt(np.maximum(0, (units * units).sum(axis=1) - (some * some).sum(axis=1)))
    return [np.column_stack([some, rest]).astype(np.float32), units.astype(np.float32)]


def _compare(cosine: float, eps: float, kind: type, leaf: int):
    """(left, right blocks) to rows (node, links, other): counts, and edges of a forest."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, _Block] = {}
        for batch in rows_of(batches, 1):
            row = {name: batch.column(name)[0] for name in batch.schema.names}
            names = [row[f"block_{side}"].as_py() for side in "ab"]
            for side, name in zip("ab", names, strict=True):
                if name not in blocks:
                    blocks[name] = _Block(row, side, kind, leaf)
            found = _compare_blocks(*(blocks[name] for name in names), cosine, eps, leaf)
            if found.num_rows:
                yield found
            while len(blocks) > BLOCKS_KEPT:
                del blocks[next(iter(blocks))]

    return compare


def _compare_blocks(a: _Block, b: _Block, cosine: float, eps: float, leaf: int) -> pa.RecordBatch:
    apart = np.maximum(np.maximum(a.low[:, None] - b.high, b.low - a.high[:, None]), 0)
    near = (apart * apart).sum(axis=2) <= eps * eps * (1 + 1e-9)
    if a is b:
        near = np.triu(near)
    links_a = np.zeros(len(a.ids), np.int64)
    links_b = links_a if a is b else np.zeros(len(b.ids), np.int64)
    edges = [np.zeros((0, 2), np.int64)]
    for i in np.flatnonzero(near.any(axis=1)):
        others = np.flatnonzero(np.repeat(near[i], leaf)[: len(b.ids)])
        for start in range(0, len(others), TILE):
            left, right = _hits(a, slice(i * leaf, (i + 1) * leaf), b, others[start : start + TILE], cosine)
            if a is b:
                left, right = left[left < right], right[left < right]
            if len(left):
                links_a += np.bincount(left, b.copies[right], len(a.ids)).astype(np.int64)
                links_b += np.bincount(right, a.copies[left], len(b.ids)).astype(np.int64)
                edges.append(_forest(a.ids[left], b.ids[right]))
    edges = np.concatenate(edges)
    edges = _forest(edges[:, 0], edges[:, 1])
    nodes, links = (a.ids, links_a) if a is b else (np.append(a.ids, b.ids), np.append(links_a, links_b))
    some = links > 0
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([nodes[some], edges[:, 0]])),
            pa.array(np.concatenate([links[some], np.zeros(len(edges), np.int64)])),
            pa.array([None] * int(some.sum()) + edges[:, 1].tolist(), pa.int64()),
        ],
        ["node", "links", "other"],
    )


def _hits(a: _Block, rows: slice, b: _Block, others: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (left, right) of cosines of at least ``cosine``, judged in double precision.

    Products in single precision, wrong by less than ``slack``, leave out what is below.
    """
    width = a.units.shape[1]
    slack = (width + 4) * 2.0**-22
    at = slice(others[0], others[-1] + 1) if others[-1] - others[0] < len(others) else others
    for left, right in zip(a.screens, b.screens, strict=True):
        products = left[rows] @ right[at].T
        left, right = np.divmod(np.flatnonzero(products >= np.float32(cosine - slack)), len(others))
        if len(left) * width <= EXACT_CELLS:
            left, right = left + rows.start, others[right]
            linked = np.einsum("ij,ij->i", a.units[left], b.units[right]) >= cosine
            return left[linked], right[linked]
    left, right = np.nonzero(a.units[rows] @ b.units[at].T >= cosine)
    return left + rows.start, others[right]


def _forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Edges to the root of each component, instead of all links between two leaves."""
    names, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = place[: len(a)], place[len(a) :]
    root = np.arange(len(names))
    while True:
        new = root.copy()
        np.minimum.at(new, left, root[right])
        np.minimum.at(new, right, root[left])
        new = new[new]
        if (new == root).all():
            break
        root = new
    moved = root != np.arange(len(names))
    return np.stack([names[moved], names[root[moved]]], axis=1)


def _near(side_a: str, side_b: str, eps: float) -> Column:
    """Whether two intervals have vectors of one width and boxes at most eps apart."""
    gap = F.lit(0.0)
    for i in range(LEADING):
        low_a, high_a, low_b, high_b = (F.get(f"{edge}_{x}", F.lit(i)) for x in (side_a, side_b) for edge in ("low", "high"))
        apart = F.greatest(low_a - high_b, low_b - high_a, F.lit(0.0))
        # A dimension that the narrower vectors lack counts as equal.
        gap = gap + F.coalesce(apart * apart, F.lit(0.0))
    # No equality of two columns, by which a planner would deal out the vectors.
    return (F.col(f"width_{side_a}") - F.col(f"width_{side_b}") == 0) & (gap <= eps * eps * (1 + 1e-9))


def _side(intervals: DataFrame, name: str) -> DataFrame:
    return intervals.toDF(*[f"{column}_{name}" for column in intervals.columns])


def _near_parts(blocks: DataFrame, eps: float) -> dict[int, list[int]]:
    """Parts by part, itself and later ones, that hold intervals at most eps apart."""
    low = F.array(*[F.min(F.get("low", F.lit(i))) for i in range(LEADING)]).alias("low")
    high = F.array(*[F.max(F.get("high", F.lit(i))) for i in range(LEADING)]).alias("high")
    boxes = blocks.groupBy("part", "width").agg(low, high)
    pairs = _side(boxes, "a").join(_side(boxes, "b"), _near("a", "b", eps) & F.expr("part_a <= part_b"))
    near: dict[int, list[int]] = {}
    for a, b in pairs.select("part_a", "part_b").distinct().collect():
        near.setdefault(a, []).append(b)
    return near


def _near_blocks(blocks: DataFrame, eps: float) -> DataFrame:
    """Pairs of blocks at most eps apart, each once, with both blocks' columns (..._a, ..._b).

    A task makes the pairs of a slice of one part and a slice of another, and reads both from
    the written blocks; no block is sent anywhere, whatever the number of its pairs.
    """
    pairs = []
    for part, others in (_near_parts(blocks, eps) or {0: [0]}).items():
        left = _side(blocks.filter(F.col("part") == part), "a").hint("shuffle_replicate_nl")
        right = _side(blocks.filter(F.col("part").isin(others)), "b")
        pairs.append(left.join(right, _near("a", "b", eps) & F.expr("block_a <= block_b")))
    names = ["block", "nodes", "copies", "vectors", "boxes"]
    return reduce(DataFrame.unionAll, pairs).select("width_a", *[f"{name}_{x}" for x in "ab" for name in names])


def _stage_parts(blocks: DataFrame) -> DataFrame:
    """``stage`` with a folder for each part, in small groups of rows that readers can hold."""
    path = scratch_path(blocks.sparkSession, "blocks")
    options = {"block.size": 2**24, "block.size.row.check.min": 4, "page.size.row.check.min": 1, "enable.dictionary": "false"}
    blocks.write.options(**{f"parquet.{k}": v for k, v in options.items()}).partitionBy("part").parquet(path)
    return blocks.sparkSession.read.schema(blocks.schema).parquet(path)


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one per row of ``vectors``.

    ``vectors`` has vec_id and embedding (array of float or double); other columns are
    ignored. Two rows are linked if the cosine of their vectors is at least ``cosine``.
    Vectors that are null, empty, zero, or hold null or non-finite components link with
    nothing; so do vectors of different lengths. n_links counts other rows, so equal
    vectors count each other. component_id is the smallest vec_id reachable; null ids count
    as the largest. An empty table gives no rows.
    """
    single = isinstance(vectors.schema["embedding"].dataType, ArrayType) and isinstance(
        vectors.schema["embedding"].dataType.elementType, FloatType
    )
    kind = np.float32 if single else np.float64
    zero = F.lit(0.0).cast("float" if single else "double")
    sane = (
        F.col("e").isNotNull()
        & (F.size("e") > 0)
        & F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("e", lambda x: x != 0)
    )
    read = vectors.select("vec_id", F.col("embedding").cast(f"array<{'float' if single else 'double'}>").alias("e"))
    # -0.0 and 0.0 are one value; so the node of a vector is the hash of its plain form.
    plain = read.withColumn("ok", F.coalesce(sane, F.lit(False))).withColumn(
        "e", F.when(F.col("ok"), F.transform("e", lambda x: x + zero))
    ).withColumn("node", F.when(F.col("ok"), F.xxhash64(F.col("e").cast("array<double>"), F.lit(1))))
    keyed = stage(plain.select("vec_id", "node"), "vectors")
    nodes = stage(
        keyed.filter("node is not null").groupBy("node").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies")),
        "distinct",
    )
    usable = plain.filter("ok").select("node", "e")
    axes = _axes(usable)
    eps = float(np.sqrt(max(0.0, 2 - 2 * cosine))) + 1e-9
    order = ["width", "place", "node"]
    width = shuffle_width(vectors.sparkSession)
    slices = max(1, min(width, -(-nodes.count() // SLICE)))
    sequence = map_arrow(usable, _cells(axes, eps), "width int, place binary, node long, copies long, vector binary")
    packed = map_arrow(
        sequence.repartitionByRange(slices, *order).sortWithinPartitions(*order),
        _blocks(axes, kind, BLOCK, LEAF),
        "width int, nodes binary, copies binary, vectors binary, boxes binary, low array<double>, high array<double>",
    )
    # Blocks are numbered by task and place in it, that is, along the sequence; parts are runs of tasks.
    numbered = packed.withColumn("block", F.monotonically_increasing_id()).withColumn(
        "part", F.floor(F.shiftright("block", 33) / -(-width // PARTS)).cast("int")
    )
    found = stage(
        map_arrow(_near_blocks(_stage_parts(numbered), eps), _compare(cosine, eps, kind, LEAF), "node long, links long, other long"),
        "found",
    )
    counts = found.filter("other is null").groupBy("node").agg(F.sum("links").alias("links"))
    roots = smallest_reachable(found.filter("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    # Only linked vectors have a root; the others are components of their own.
    rooted = nodes.select("node", "first_id").join(roots, "node").join(counts, "node")
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = rooted.join(ids, "root").select("node", "links", "component_id")
    labels = stage(
        nodes.join(linked, "node", "left").select(
            F.col("node").alias("_node"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component_id", "first_id").alias("component_id"),
        ),
        "labels",
    )
    return (
        keyed.join(labels, F.col("node") == F.col("_node"), "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.when(F.col("_node").isNotNull(), F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )


def op3_grid_order_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``near_vectors`` over all embeddings."""
    return near_vectors(table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
), ok AS (
  SELECT vec_id, e FROM v WHERE e IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND list_max(list_transform(e, lambda x: abs(x))) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id
    AND CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) >= 0.95 ELSE false END
), r AS (
  WITH RECURSIVE reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a)
  SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
), n AS (
  SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a
)
SELECT v.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN r ON v.vec_id = r.vec_id LEFT JOIN n ON v.vec_id = n.vec_id
"""
