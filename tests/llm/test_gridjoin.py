"""The grid order join: disk in proportion to its vectors, links across parts, blocks and leaves."""

import os

import numpy as np

from revlens.llm import gridjoin
from revlens.session import shared_dir


def bytes_on_disk(spark):
    """What shuffles and staged frames of the session hold."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    tops = [*manager.localDirsString(), shared_dir(spark).removeprefix("file:")]
    return sum(os.path.getsize(os.path.join(d, x)) for top in tops for d, _, names in os.walk(top) for x in names)


def plain(vectors, cosine=0.95):
    """(links, smallest reachable) by place, from all pairs."""
    linked = []
    for one in vectors:
        same = np.array([len(other) == len(one) for other in vectors])
        near = np.zeros(len(vectors), bool)
        others = np.array([v for v, s in zip(vectors, same) if s])
        near[same] = others @ one / np.sqrt((others * others).sum(axis=1) * (one @ one)) >= cosine
        linked.append(near)
    linked = np.array(linked)
    root = np.arange(len(vectors))
    while True:
        new = np.array([root[near].min() for near in linked])
        if (new == root).all():
            return linked.sum(axis=1) - 1, root
        root = new


def check(found, vectors):
    links, root = plain(vectors)
    assert len(found) == len(vectors)
    for r in found:
        i = r["vec_id"]
        assert (r["n_links"], r["component_id"], r["kept"]) == (links[i], root[i], i == root[i])
    return links, root


def test_disk_is_in_proportion_to_the_vectors(spark):
    generator = np.random.RandomState(2)
    vectors = generator.randn(6_000, 64).astype(np.float32)
    vectors[5_000:5_100] = vectors[:100] + generator.randn(100, 64) * 0.05
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    before = bytes_on_disk(spark)
    found = {r["vec_id"]: r for r in gridjoin.near_vectors(df).collect()}
    assert bytes_on_disk(spark) - before <= 4 * vectors.nbytes
    assert len(found) == 6_000 and sum(r["n_links"] for r in found.values()) == 200
    assert all(found[5_000 + i]["component_id"] == i and found[i]["kept"] for i in range(100))


def test_links_across_parts_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(gridjoin, "BLOCK", 64)
    monkeypatch.setattr(gridjoin, "LEAF", 16)
    generator = np.random.RandomState(4)
    centres = generator.randn(40, 20)
    vectors = [(centres[i % 40] + generator.randn(20) * 0.15 * (i % 5)).astype(np.float32).astype(float) for i in range(800)]
    vectors += [vectors[i % 7] for i in range(150)]
    vectors += [np.array([np.cos(i / 9), np.sin(i / 9), 0.0][: 2 + i % 2]) for i in range(60)]
    for kind in ("float", "double"):
        kept = [v.astype(np.float32).astype(float) for v in vectors] if kind == "float" else vectors
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(kept)], f"vec_id long, embedding array<{kind}>")
        links, root = check(gridjoin.near_vectors(df.repartition(7)).collect(), kept)
        assert links.max() > 30 and len(set(root)) > 40


def test_equal_vectors_get_equal_places():
    """Copies in batches of other sizes must lie side by side, or they count as two vectors."""
    generator = np.random.RandomState(5)
    vectors, axes = generator.randn(1_001, 37), generator.randn(37, 8)
    whole = gridjoin._lead(gridjoin._unit(vectors), axes)
    for start, stop in ((0, 1), (3, 10), (500, 1_001)):
        assert (gridjoin._lead(gridjoin._unit(vectors[start:stop]), axes) == whole[start:stop]).all()


def test_screens_lose_no_link():
    """The short products leave out only what the exact cosines do, at any threshold."""
    generator = np.random.RandomState(6)
    for width, cosine in ((1, 0.95), (2, 0.9999), (64, 0.95), (300, 0.5)):
        rows = generator.randn(6, width)[generator.randint(0, 6, 200)] + generator.randn(200, width) * 0.2
        a, b = (gridjoin._Block.__new__(gridjoin._Block) for _ in range(2))
        for block, own in ((a, rows[:120]), (b, rows[120:])):
            block.ids, block.units = np.arange(len(own)), gridjoin._unit(own)
            block.screens = gridjoin._screens(block.units)
        left, right = gridjoin._hits(a, slice(0, 120), b, np.arange(80), cosine)
        assert sorted(zip(left, right)) == sorted(zip(*np.nonzero(a.units @ b.units.T >= cosine)))


def test_lengths_out_of_range_link_with_nothing(spark):
    rows = [(1, [1e200, 1e200]), (2, [1e-200, 1e-200]), (3, [1.0, 1.0]), (4, [2.0, 2.0]), (5, [1e-200, 1e-200])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in gridjoin.near_vectors(df).collect()}
    assert found == {1: (0, 1), 2: (1, 2), 3: (1, 3), 4: (1, 3), 5: (1, 2)}
