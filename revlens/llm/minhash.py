"""MinHash near-duplicates by a multi-index Hamming join.

A document's signature has 70 symbols of 16 bits, one per hash function. Signatures of sets
with Jaccard similarity s agree in each symbol with probability s. The index cuts signatures
into 14 chunks of 5 symbols and stores each chunk once per symbol left out, so chunks that
differ in at most one symbol meet. Two signatures that differ in at most 27 symbols have such
a chunk (28 errors are needed for two in each of 14), so every pair within distance 27 meets;
of pairs at similarity 0.8 about one in 1e8 has no such chunk. Pairs that meet go on if they
differ in at most 32 symbols (at similarity 0.8 they differ in 14 on average, and in more
than 32 with a probability below 1e-6) and are confirmed on the whole shingle sets.

Groups of copies are never expanded into pairs. Equal sets are one node. Each node is first
compared with one other, the bucket leader it shares the most buckets with. After the confirmed
links are joined into components, members of buckets that still hold several are compared
with three others, of each of three kinds of leaders the one they share the most of these buckets
with, unless they are in one component already; after these links, a member
outside the component of its bucket's smallest node is compared, by whole sets, with all of
that component, and reports one link a block at most; what is outside, or in a bucket whose
smallest node has no link, is compared with its like, by
signatures and then by whole sets. That finds every link that could still join two components.
Pairs stay inside their block, which reports the members that are near another, then fewer links
than members; so the rows made per block grow with its members, not with their pairs. Large components
and buckets are cut into blocks, and a pair is compared by whole sets in the first bucket it shares.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import (
    map_arrow,
    rows_of,
    shuffle_width,
    smallest_reachable,
    spread,
    stage,
    table,
    word_hashes,
)

# Words per shingle of the query, and of a stage that removes near-duplicates.
SHINGLE = 2
STAGE_SHINGLE = 5
# The signatures and their index are made for this similarity and those above.
SIMILARITY_PERCENT = 80
SYMBOLS = 70
CHUNK = 5
# Pairs within 2 * (SYMBOLS // CHUNK) - 1 are certain to meet; those beyond this are not near.
DISTANCE = 32
# Members per block of a large bucket, and shingles on average.
BLOCK = 2000
BLOCK_SHINGLES = 4_000_000
# Members per block of a large component.
COMPONENT_BLOCK = 500


def shingles(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text, A-Z lower-cased.

    A text of fewer than ``width`` words gives its whole sequence as one shingle; without
    words, or null, none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    return _shingles_of(word_hashes(words), min(width, len(words)))


def _shingles_of(hashes: np.ndarray, width: int) -> np.ndarray:
    count = len(hashes) - width + 1
    mixed = np.full(count, width, np.uint64)
    for offset in range(width):
        mixed = spread(mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[offset : offset + count])
    return np.unique(mixed)


@lru_cache(1)
def _functions() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.RandomState(20240501)
    factors = random.randint(0, 2**62, SYMBOLS).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    return factors, random.randint(0, 2**62, SYMBOLS).astype(np.uint64)


def signature(values: np.ndarray) -> np.ndarray:
    """The symbols of a non-empty shingle set; bounded memory for any length."""
    factors, offsets = _functions()
    least = np.full(SYMBOLS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(values), 2048):
        part = values[start : start + 2048, None] * factors + offsets
        np.minimum(least, part.min(axis=0), out=least)
    return (spread(least) >> np.uint64(48)).astype(np.uint16)


def _sketch(width: int):
    """(doc_id, textkey, text) to (doc_id, textkey, n, node, sig)."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            counts, nodes, signatures = [], [], []
            for text in batch.column(2).to_pylist():
                values = shingles(text, width)
                counts.append(len(values))
                nodes.append(int(np.bitwise_xor.reduce(spread(values))) - 2**63 if len(values) else 0)
                signatures.append(signature(values).tobytes() if len(values) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(counts, pa.int64()),
                    pa.array(nodes, pa.int64()),
                    pa.array(signatures, pa.binary()),
                ],
                ["doc_id", "textkey", "n", "node", "sig"],
            )

    return sketch


def _keys(symbols: np.ndarray) -> np.ndarray:
    """Index entries of signatures, by row: each chunk, once per symbol left out."""
    kept = np.array([[i for i in range(CHUNK) if i != out] for out in range(CHUNK)])
    chunks = SYMBOLS // CHUNK
    parts = symbols.reshape(-1, chunks, CHUNK)[:, :, kept].astype(np.uint64)
    keys = np.arange(chunks * CHUNK, dtype=np.uint64).reshape(1, chunks, CHUNK)
    for i in range(CHUNK - 1):
        keys = spread((keys << np.uint64(16)) ^ parts[..., i])
    return keys.view(np.int64).reshape(len(parts), -1)


def _symbols(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, SYMBOLS)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, sig) to (key, node)."""
    for batch in rows_of(batches, 10_000):
        keys = _keys(_symbols(batch.column(1)))
        nodes = batch.column(0).to_numpy()
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.ravel()), pa.array(np.repeat(nodes, keys.shape[1]))], ["key", "node"]
        )


def _near_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, o, m, left, right, node, root, sig), sorted by the first three, to those near another.

    One (key, o, m) at a time: two blocks of members outside the main component, ``left`` of the
    first and ``right`` of the second. A block has about BLOCK rows, whatever the bucket. Rows
    stay ``left`` or ``right`` if they are near one of the other side.
    """
    yield from _by_group(batches, 3, _members)


def _members(table_: pa.Table, cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
    left, right = np.zeros(table_.num_rows, bool), np.zeros(table_.num_rows, bool)
    for _, i, j in _pairs(table_, cuts):
        left[i] = right[j] = True
    for name, flags in (("left", left), ("right", right)):
        table_ = table_.set_column(table_.schema.get_field_index(name), name, pa.array(flags))
    yield from table_.filter(pa.array(left | right)).to_batches()


def _join_members(percent: int):
    """Rows as of ``_near_members``, with items, sorted by key, o and m, to links (a, b)."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _by_group(batches, 3, lambda table_, cuts: _joined(table_, cuts, percent))

    return join


def _by_group(batches, width: int, work) -> Iterator[pa.RecordBatch]:
    """``work(table, cuts)`` on sorted rows, whole groups of the first ``width`` columns."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        table_ = pa.Table.from_batches(held).combine_chunks()
        new = _cuts(table_, width)
        if not len(new):
            continue
        # The last block may go on in the next batch.
        done, held = table_.slice(0, new[-1]), table_.slice(new[-1]).to_batches()
        yield from work(done, np.append(0, new))
    if held:
        table_ = pa.Table.from_batches(held).combine_chunks()
        yield from work(table_, np.concatenate([[0], _cuts(table_, width), [table_.num_rows]]))


def _cuts(table_: pa.Table, width: int) -> np.ndarray:
    names = [table_.column(i).to_numpy() for i in range(width)]
    return np.flatnonzero(np.any([n[1:] != n[:-1] for n in names], axis=0)) + 1


def _join_components(percent: int):
    """Rows (root, block, outside, node, items), sorted by the first two, to links (a, b)."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _by_group(batches, 2, lambda table_, cuts: _linked(table_, cuts, percent))

    return join


def _linked(table_: pa.Table, cuts: np.ndarray, percent: int) -> Iterator[pa.RecordBatch]:
    """Per outside node and block one link to a member, if there is any, by whole sets."""
    outside, nodes = table_.column("outside").to_numpy(), table_.column("node").to_numpy()
    offsets, items = _items(table_)
    sizes = np.diff(offsets)
    for begin, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        rows = np.arange(begin, end)
        asked, members = rows[outside[rows]], rows[~outside[rows]]
        if not len(asked) or not len(members):
            continue
        values = np.concatenate([items[offsets[r] : offsets[r + 1]] for r in members])
        owner = np.repeat(np.arange(len(members)), sizes[members])
        order = np.argsort(values, kind="stable")
        values, owner = values[order], owner[order]
        found = []
        for row in asked:
            own = items[offsets[row] : offsets[row + 1]]
            low, high = np.searchsorted(values, own), np.searchsorted(values, own, "right")
            count = high - low
            at = np.repeat(high - np.cumsum(count), count) + np.arange(count.sum())
            both = np.bincount(owner[at], minlength=len(members))
            union = len(own) + sizes[members] - both
            hits = np.flatnonzero(100 * both >= percent * union)
            if len(hits):
                found.append((nodes[row], nodes[members[hits[0]]]))
        if found:
            a, b = np.array(found).T
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def _items(table_: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    column = table_.column("items").combine_chunks()
    offsets = column.offsets.to_numpy()
    return offsets - offsets[0], column.flatten().to_numpy()


def _pairs(table_: pa.Table, cuts: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(group, i, j): rows of near pairs of a left and a right member, in their first bucket."""
    keys, left, right, nodes, roots = (
        table_.column(c).to_numpy() for c in ("key", "left", "right", "node", "root")
    )
    symbols = _symbols(table_.column("sig"))
    for begin, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        rows = np.arange(begin, end)
        others = rows[right[rows]]
        asked = rows[left[rows]]
        for start in range(0, len(asked), 64):
            part = asked[start : start + 64]
            near = (symbols[part][:, None] != symbols[others][None]).sum(axis=2) <= DISTANCE
            near &= roots[part][:, None] != roots[others][None]
            near &= nodes[part][:, None] < nodes[others][None]
            i, j = np.nonzero(near)
            if not len(i):
                continue
            i, j = part[i], others[j]
            first = np.argmax(_keys(symbols[i]) == _keys(symbols[j]), axis=1)
            here = _keys(symbols[i])[np.arange(len(i)), first] == keys[begin]
            yield begin, i[here], j[here]


def _joined(table_: pa.Table, cuts: np.ndarray, percent: int) -> Iterator[pa.RecordBatch]:
    """Links by whole sets; per group only those that join two components not joined before."""
    nodes, roots = table_.column("node").to_numpy(), table_.column("root").to_numpy().tolist()
    offsets, items = _items(table_)
    sizes = np.diff(offsets)
    group, parents, found = -1, {}, []

    def top(root: int) -> int:
        while root in parents:
            root = parents[root]
        return root

    for begin, i, j in _pairs(table_, cuts):
        if begin != group:
            group, parents = begin, {}
        for row in np.unique(i).tolist():
            own, others = np.sort(items[offsets[row] : offsets[row + 1]]), j[i == row]
            sized = 100 * np.minimum(len(own), sizes[others]) >= percent * np.maximum(len(own), sizes[others])
            others = [r for r in others[sized].tolist() if top(roots[r]) != top(roots[row])]
            if not others:
                continue
            values = np.concatenate([items[offsets[r] : offsets[r + 1]] for r in others])
            at = np.minimum(np.searchsorted(own, values), len(own) - 1)
            ends = np.cumsum(sizes[others])
            both = np.diff(np.append(0, np.cumsum(own[at] == values)[ends - 1]))
            union = len(own) + sizes[others] - both
            for hit in np.flatnonzero(100 * both >= percent * union).tolist():
                low, high = sorted((top(roots[row]), top(roots[others[hit]])))
                if low != high:
                    parents[high] = low
                    found.append((nodes[row], nodes[others[hit]]))
    if found:
        a, b = np.array(found).T
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, sig_a, sig_b) to the pairs (a, b) within the signature distance."""
    for batch in batches:
        near = (_symbols(batch.column(2)) != _symbols(batch.column(3))).sum(axis=1) <= DISTANCE
        yield pa.RecordBatch.from_arrays(
            [batch.column(i).filter(pa.array(near)) for i in range(2)], ["a", "b"]
        )


def _sets(width: int):
    """(node, text) to (node, shingle set)."""

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches, 500):
            sets = [shingles(text, width).view(np.int64) for text in batch.column(1).to_pylist()]
            offsets = np.cumsum([0, *map(len, sets)])
            values = np.concatenate(sets) if sets else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int64())),
                ],
                ["node", "items"],
            )

    return sets_of


def _near(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose signatures are near and whose sizes allow the similarity."""
    left = nodes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("sig").alias("sig_a"))
    right = nodes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("sig").alias("sig_b"))
    joined = pairs.join(left, "a").join(right, "b")
    sized = joined.filter(
        100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    )
    return map_arrow(sized.select("a", "b", "sig_a", "sig_b"), _close, "a long, b long")


def _shingle_sets(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """(node, items): whole shingle sets of the wanted nodes, from one text each."""
    named = nodes.join(wanted, "node", "left_semi").select(
        "node", F.col("textkey").alias("_key"), F.col("doc").alias("_doc")
    )
    texts = docs.join(
        named, (F.col("textkey") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_doc"))
    ).dropDuplicates(["node"])
    return stage(map_arrow(texts.select("node", "text"), _sets(width), "node long, items array<long>"), "sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose whole sets have the similarity."""
    left = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    shared = F.size(F.array_intersect("x", "y"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .select("a", "b", shared.alias("both"), (F.size("x") + F.size("y")).alias("sum"))
        .filter(100 * F.col("both") >= percent * (F.col("sum") - F.col("both")))
        .select("a", "b")
    )


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()


def _every(count: str):
    return F.explode(F.sequence(F.lit(0), F.col(count) - 1))


def _block_of(node: str, count: str):
    return F.pmod(F.xxhash64(node), F.col(count)).cast("int")


def _mixed(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components, with three leaders of the bucket.

    Rows (key, size, node, root, leaders); leaders are structs (node, root): the bucket's smallest
    node, its largest, and one drawn by hash.
    """
    rows = buckets.join(roots, "node", "left").select("key", "size", "node", F.coalesce("root", "node").alias("root"))
    member, drawn = F.struct("node", "root"), F.struct(F.xxhash64("node").alias("h"), "node", "root")
    leaders = (
        rows.groupBy("key")
        .agg(
            F.min(member).alias("l"),
            F.max(member).alias("m"),
            F.max(drawn).alias("d"),
            F.min("root").alias("low"),
            F.max("root").alias("high"),
        )
        .filter("low <> high")
        .select("key", F.array("l", "m", F.struct("d.node", "d.root")).alias("leaders"))
    )
    return rows.join(leaders, "key")


def _nearest_leaders(mixed: DataFrame) -> DataFrame:
    """Pairs (a, b) of members and, of each kind of leaders, the one of another component they meet most."""
    led = mixed.select("node", "root", F.posexplode("leaders").alias("kind", "to")).filter("root <> to.root")
    nearest = led.groupBy("node", "kind").agg(F.mode("to.node", True).alias("to"))
    return nearest.select(F.least("node", "to").alias("a"), F.greatest("node", "to").alias("b")).distinct()


def _links_to_components(outside: DataFrame, roots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of ``outside`` (node, main) to members of the component ``main``."""
    asked = outside.select("node", F.col("main").alias("root")).distinct()
    counts = (
        roots.join(asked.select("root").distinct(), "root", "left_semi")
        .groupBy("root")
        .agg(F.ceil(F.count("*") / COMPONENT_BLOCK).cast("int").alias("blocks"))
    )
    members = roots.join(counts, "root").select(
        "root", _block_of("node", "blocks").alias("block"), F.lit(False).alias("outside"), "node"
    )
    others = asked.join(counts, "root").select("root", _every("blocks").alias("block"), F.lit(True).alias("outside"), "node")
    rows = members.unionByName(others).join(sets, "node").select("root", "block", "outside", "node", "items")
    dealt = rows.repartition(shuffle_width(sets.sparkSession), "root", "block")
    return map_arrow(dealt.sortWithinPartitions("root", "block"), _join_components(percent), "a long, b long")


def _links_outside(labelled: DataFrame, roots: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that join components of bucket members outside the main component.

    ``labelled``: (key, node, root, main) as of before ``roots``; without a main component, all
    members are outside.
    """
    spark = nodes.sparkSession
    outside = labelled.filter("main IS NULL OR root <> main").select("key", "node").join(nodes.select("node", "n", "sig"), "node")
    counts = (
        outside.groupBy("key")
        .agg(F.count("*").alias("members"), F.sum("n").alias("shingles"))
        .filter("members > 1")
        .select("key", F.ceil(F.greatest(F.col("members") / BLOCK, F.col("shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    )
    # A member is left in its block against every one, and right in every one against its own.
    own, every = F.col("own"), F.sequence(F.lit(0), F.col("blocks") - 1)
    places = F.concat(
        F.transform(every, lambda i: F.struct(own.alias("o"), i.alias("m"), F.lit(True).alias("left"), (i == own).alias("right"))),
        F.transform(
            F.filter(every, lambda i: i != own),
            lambda i: F.struct(i.alias("o"), own.alias("m"), F.lit(False).alias("left"), F.lit(True).alias("right")),
        ),
    )
    rows = (
        outside.join(counts, "key")
        .join(roots, "node", "left")
        .withColumn("own", _block_of("node", "blocks"))
        .select("key", F.explode(places).alias("at"), "node", F.coalesce("root", "node").alias("root"), "sig")
        .select("key", "at.*", "node", "root", "sig")
    )
    dealt = rows.repartition(shuffle_width(spark), "key", "o", "m").sortWithinPartitions("key", "o", "m")
    near = stage(map_arrow(dealt, _near_members, dealt.schema), "near")
    dealt = near.join(sets, "node").select(*near.columns, "items").repartition(shuffle_width(spark), "key", "o", "m")
    return map_arrow(dealt.sortWithinPartitions("key", "o", "m"), _join_members(percent), "a long, b long")


def near_duplicates(docs: DataFrame, width: int = SHINGLE, percent: int = SIMILARITY_PERCENT) -> DataFrame:
    """Rows (doc_id, textkey, n_shingles, component_id, kept), one per row of ``docs``.

    Two documents are linked if 100 * |intersection| >= percent * |union| of their sets of
    ``width``-word shingles; ``percent`` is 80 at least, as the index misses pairs below.
    component_id is the smallest doc_id reachable by links. A document without
    words is linked with nothing. Null ids count as the largest: a component that has none
    but null ids has a null component_id, and its rows are kept. Rows repeated with the same
    id and text are linked and all bear the kept id. Other columns are ignored; an empty
    table gives no rows. ``textkey`` is the 64-bit hash of the text.
    """
    if width < 1 or not SIMILARITY_PERCENT <= percent <= 100:
        raise ValueError(f"width {width}, similarity {percent}: at least 1, and {SIMILARITY_PERCENT} to 100")
    texts = docs.select("doc_id", F.xxhash64("text").alias("textkey"), "text")
    sketches = stage(
        map_arrow(
            texts.select("doc_id", "textkey", "text"),
            _sketch(width),
            "doc_id long, textkey long, n long, node long, sig binary",
        ),
        "sketches",
    )
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "textkey")
    nodes = stage(
        sketches.filter("n > 0")
        .groupBy("node")
        .agg(F.min(first).alias("m"), F.min("n").alias("n"), F.first("sig").alias("sig"))
        .select("node", "n", "sig", F.col("m.doc_id").alias("doc"), F.col("m.textkey").alias("textkey")),
        "nodes",
    )
    entries = map_arrow(nodes.select("node", "sig"), _index, "key long, node long")
    shared = entries.groupBy("key").agg(F.count("*").alias("size"), F.min("node").alias("leader"))
    buckets = stage(entries.join(shared.filter("size > 1"), "key"), "buckets")
    sets = _shingle_sets(buckets.select("node").distinct(), nodes, texts, width)
    # One pair a node: with the leader it shares the most buckets with.
    nearest = (
        buckets.filter("node <> leader")
        .groupBy("node")
        .agg(F.mode("leader", True).alias("a"))
        .select("a", F.col("node").alias("b"))
    )
    near_first = stage(_near(nearest, nodes, percent), "near")
    links = stage(_confirmed(near_first, sets, percent), "links")
    roots = stage(smallest_reachable(links), "roots")
    mixed = stage(_mixed(buckets, roots), "mixed")
    near_leader = stage(_near(_nearest_leaders(mixed), nodes, percent), "near")
    links = links.unionByName(stage(_confirmed(near_leader, sets, percent), "links"))
    roots = stage(smallest_reachable(links), "roots")
    # A bucket that is one component needs nothing more. A leader without links has no main component.
    labelled = stage(
        mixed.select("key", "node", F.col("leaders")[0]["node"].alias("leader"))
        .join(roots, "node", "left")
        .join(roots.select(F.col("node").alias("leader"), F.col("root").alias("main")), "leader", "left")
        .select("key", "node", F.coalesce("root", "node").alias("root"), "main"),
        "labelled",
    )
    more = stage(_links_to_components(labelled.filter("root <> main"), roots, sets, percent), "links")
    links = links.unionByName(more)
    roots = stage(smallest_reachable(links), "roots")
    more = stage(_links_outside(labelled, roots, nodes, sets, percent), "links")
    if not more.isEmpty():
        roots = stage(smallest_reachable(links.unionByName(more)), "roots")
    rooted = nodes.join(roots, "node", "left").select(
        "node", "doc", F.coalesce("root", "node").alias("root")
    )
    ids = rooted.groupBy("root").agg(F.min("doc").alias("component_id"))
    labels = rooted.join(ids, "root").select(F.col("node").alias("_node"), "component_id")
    return (
        sketches.join(labels, (F.col("node") == F.col("_node")) & (F.col("n") > 0), "left")
        .withColumn("component_id", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
        .select(
            "doc_id",
            "textkey",
            F.col("n").alias("n_shingles"),
            "component_id",
            F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        )
    )


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``near_duplicates`` by 2-word shingles over all documents."""
    return near_duplicates(table(spark, sf_dir, "documents"), SHINGLE).drop("textkey")


def keep_one_each(docs: DataFrame, width: int = SHINGLE, percent: int = SIMILARITY_PERCENT) -> DataFrame:
    """``docs`` without near-duplicates (see ``near_duplicates``): one row of each group stays.

    Of repeated rows with the kept id, one of those with the smallest text hash stays. A
    group that has only null ids keeps one row per text, as nothing else tells them apart.
    """
    kept = (
        near_duplicates(docs, width, percent)
        .filter("kept")
        .groupBy("doc_id", F.when(F.col("doc_id").isNull(), F.col("textkey")).alias("_null"))
        .agg(F.min("textkey").alias("_key"))
        .select(F.col("doc_id").alias("_id"), "_key")
    )
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    keyed = rows.select("row", F.col("row.doc_id").alias("id"), F.xxhash64("row.text").alias("textkey"))
    chosen = keyed.join(kept, F.col("id").eqNullSafe(F.col("_id")) & (F.col("textkey") == F.col("_key")))
    return chosen.dropDuplicates(["_id", "_key"]).select(
        *[F.col("row").getField(c).alias(c) for c in docs.columns]
    )


ORACLE = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
  FROM w
), u AS (
  SELECT doc_id, unnest(s) AS g FROM s
), n AS (
  SELECT doc_id, coalesce(len(s), 0)::BIGINT AS n FROM s
), i AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM u a JOIN u b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY ALL
), l AS (
  SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
), e AS (
  SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r AS (
  WITH RECURSIVE reach(a, b) AS (SELECT doc_id, doc_id FROM n UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a)
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT n.doc_id, n AS n_shingles, component_id, n.doc_id = component_id AS kept FROM n JOIN r ON n.doc_id = r.doc_id
"""
