"""Merkle dataset manifest: hash trees of documents, and a recursive query that climbs them.

Every language has a tree of its documents and one tree spans the languages. Built levels
are rows of one table, each node with the digests below it and the id of its parent. The
climb is a recursive SQL query: a leaf meets its parent node, hands on the digests beside
its own and folds its (maybe tampered) hash, until there is no parent.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import fold, running_total, stage, table

# Nodes of a run that become one parent.
FAN = 8
# A node is stored once for each stretch of leaves below it, so that no join key has more
# leaves than a stretch: this many leaves, or a part of the table in this many stretches.
STRETCH, STRETCHES = 64, 65_536
# Node ids are a level and a number: the first leaf below it or, in the tree of languages
# (levels from here on), the place in its level.
LEVEL_BITS, TOP = 56, 32

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
DIGEST = 32


def _hash(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _hexed(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _measured(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def leaf_hash(**changed: Column) -> Column:
    """SHA-256 (binary) of the row's fields; ``changed`` puts expressions in place of columns."""
    return _hash(F.concat(*[_measured(changed.get(name, F.col(name))) for name in FIELDS]))


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all else unchanged."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _node_id(level: int, number: Column) -> Column:
    return F.lit(level << LEVEL_BITS) + number


def _runs(level: DataFrame) -> DataFrame:
    """Parents of the nodes of every tree that has more than one at this level.

    ``level`` has tree, pos, digest, n (nodes of the tree at this level) and the first and
    last leaf below; so has the result, with ``kids``, the digests of the run in order.
    """
    ordered = F.sort_array(F.collect_list(F.struct("pos", F.hex("digest").alias("hexed"))))
    runs = (
        level.filter("n > 1")
        .groupBy("tree", F.floor(F.col("pos") / FAN).alias("run"))
        .agg(
            F.array_join(F.transform(ordered, lambda kid: kid["hexed"]), "").alias("kids"),
            F.min("first").alias("first"),
            F.max("last").alias("last"),
            F.ceil(F.max("n") / FAN).alias("n"),
        )
    )
    return runs.select(
        "tree",
        F.col("run").alias("pos"),
        F.unhex("kids").alias("kids"),
        _hash(F.lower("kids")).alias("digest"),
        "n",
        "first",
        "last",
    )


def _levels(level: DataFrame, widest: int) -> list[DataFrame]:
    """All levels above ``level``, each written; ``widest`` is the largest ``n`` there."""
    levels = []
    while widest > 1:
        level = stage(_runs(level), "merkle-level")
        levels.append(level)
        widest = -(-widest // FAN)
    return levels


def _linked(level: DataFrame, height: int, top: int, trees: int) -> DataFrame:
    """Columns ``parent`` and ``ord`` (place in the parent's run) for nodes at ``height``.

    ``top`` is 0 for trees of documents, which hang below the tree of ``trees`` languages.
    A parent's id counts from the first leaf of the tree, which ``base`` holds.
    """
    pos, more = F.col("pos"), F.col("n") > 1
    run = F.floor(pos / FAN)
    if top:
        parent = F.when(more, _node_id(top + height + 1, run))
        return level.withColumn("parent", parent).withColumn("ord", (pos % FAN).cast("int"))
    own = _node_id(height + 1, F.col("base") + run * FAN ** (height + 1))
    above = _node_id(TOP + 1, F.floor(F.col("tree") / FAN)) if trees > 1 else F.lit(None).cast("long")
    return level.withColumn("parent", F.when(more, own).otherwise(above)).withColumn(
        "ord", F.when(more, pos % FAN).otherwise(F.col("tree") % FAN).cast("int")
    )


def _placed(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leaves with their place, and the languages with theirs, both written.

    Leaves are numbered through in the order of language, doc_id and row number; a
    language's leaves are a stretch of these numbers, so its first and its count tell the
    place of each. Languages are few or many; the join on them is left to Catalyst.
    """
    numbered = stage(
        running_total(leaves.withColumn("one", F.lit(1)), "one", ["lang", "doc_id", "uid"], "number")
        .withColumn("number", F.col("number") - 1)
        .drop("one"),
        "merkle-numbered",
    )
    groups = numbered.groupBy("lang").agg(F.min("number").alias("base"), F.count("*").alias("n"))
    ranked = running_total(
        stage(groups, "merkle-groups").withColumn("one", F.lit(1)), "one", ["base"], "tree"
    )
    languages = stage(
        ranked.select("lang", "base", "n", (F.col("tree") - 1).alias("tree")), "merkle-languages"
    )
    named = languages.withColumnRenamed("lang", "_lang")
    placed = numbered.join(named, numbered["lang"].eqNullSafe(named["_lang"])).select(
        "uid",
        "doc_id",
        "leaf",
        "tampered",
        "tree",
        "base",
        "n",
        "number",
        (F.col("number") - F.col("base")).alias("pos"),
    )
    return stage(placed, "merkle-leaves"), languages


def _tree(leaves: DataFrame, languages: DataFrame) -> tuple[DataFrame, str | None, int]:
    """The node table (node, kids, first, last, parent, ord), the root and the number of languages."""
    totals = languages.agg(F.count("*"), F.max("n")).first()
    trees, widest = totals[0], totals[1] or 0
    bottom = leaves.select(
        "tree", "pos", F.col("leaf").alias("digest"), "n", F.col("number").alias("first"), F.col("number").alias("last")
    )
    own = _levels(bottom, widest)
    subroots = reduce(
        DataFrame.unionByName,
        [level.filter("n = 1").select("tree", "digest", "first", "last") for level in [bottom, *own]],
    )
    crown = stage(
        subroots.select(
            F.lit(-1).cast("long").alias("tree"),
            F.col("tree").alias("pos"),
            "digest",
            F.lit(trees).cast("long").alias("n"),
            "first",
            "last",
        ),
        "merkle-subroots",
    )
    upper = _levels(crown, trees)
    bases = languages.select("tree", "base")
    columns = ["node", "kids", "first", "last", "parent", "ord"]
    parts = [
        _linked(level.join(bases, "tree"), height, 0, trees)
        .withColumn("node", _node_id(height, F.col("base") + F.col("pos") * FAN**height))
        .select(columns)
        for height, level in enumerate(own, 1)
    ] + [
        _linked(level, height, TOP, trees)
        .withColumn("node", _node_id(TOP + height, F.col("pos")))
        .select(columns)
        for height, level in enumerate(upper, 1)
    ]
    top = (upper[-1] if upper else crown).select(_hexed(F.col("digest"))).first()
    if not parts:
        return _no_nodes(leaves.sparkSession), top and top[0], trees
    return reduce(DataFrame.unionByName, parts), top[0], trees


def _no_nodes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [], "node long, kids binary, first long, last long, parent long, ord int"
    )


# Every leaf climbs with a row of its own and folds its hash at each node it meets; one that
# has met all its ancestors has no parent left, which ends the recursion. What lies beside the
# path is the same for all leaves of a run from the second step on, so the run's first leaf
# alone (``lead``) appends it, a row per step; at the first step it appends the whole run.
CLIMB = f"""
WITH RECURSIVE climb(number, lead, step, folded, siblings, subroot, parent, ord) AS (
  SELECT number, lead, 0, folded, CAST(NULL AS BINARY), CAST(NULL AS BINARY), parent, ord FROM {{leaves}}
  UNION ALL
  SELECT c.number, c.lead, c.step + 1,
    unhex(sha2(lower(hex(concat(
      substring(n.kids, 1, {DIGEST} * c.ord), c.folded, substring(n.kids, {DIGEST} * c.ord + {DIGEST + 1})))), 256)),
    CASE WHEN c.lead AND c.step = 0 THEN n.kids WHEN c.lead THEN concat(
      substring(n.kids, 1, {DIGEST} * c.ord), substring(n.kids, {DIGEST} * c.ord + {DIGEST + 1})) END,
    CASE WHEN c.lead AND n.node >= {(TOP + 1) << LEVEL_BITS} AND n.node < {(TOP + 2) << LEVEL_BITS}
      THEN substring(n.kids, {DIGEST} * c.ord + 1, {DIGEST}) END,
    n.parent, n.ord
  FROM climb c JOIN {{nodes}} n ON c.parent = n.node AND c.number DIV :width = n.stretch
)
SELECT number, step, CASE WHEN parent IS NULL THEN folded END AS folded, siblings, subroot
FROM climb WHERE parent IS NULL OR lead LIMIT ALL
"""


def manifest(docs: DataFrame, tampered: Column | None = None, text: Column | None = None) -> DataFrame:
    """Rows (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), one per document.

    A leaf is the SHA-256 of doc_id, source, lang, n_chars and text. The leaves of a language
    ascend by doc_id (nulls first); every eight consecutive nodes become one until one is
    left, the subroot; subroots, null language first, become the root in the same way. The
    proof of a leaf is the digests beside its path, from the bottom to the root, left to
    right. ``folded_root`` follows the path from the leaf's own hash or, where ``tampered``
    holds, from that of the row with ``text`` in place of its text; ``verified`` says whether
    it ends at the root.

    Rows with equal doc_id are leaves of their own, in any order (equal rows give equal
    leaves). Null fields count as ``-``, an empty text as ``0:``. A lone leaf is its subroot
    and a lone subroot the root; without siblings the proof is the hash of nothing. Other
    columns of ``docs`` are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    changed = F.when(tampered, leaf_hash(text=text)) if tampered is not None else F.lit(None).cast("binary")
    leaves = stage(
        docs.select(
            F.monotonically_increasing_id().alias("uid"),
            "doc_id",
            "lang",
            leaf_hash().alias("leaf"),
            changed.alias("tampered"),
        ),
        "merkle-hashes",
    )
    leaves, languages = _placed(leaves)
    nodes, root, trees = _tree(leaves, languages)
    total = languages.agg(F.sum("n")).first()[0] or 0
    width = max(STRETCH, -(-total // STRETCHES))
    stored = stage(
        nodes.select(
            "node",
            "kids",
            "parent",
            "ord",
            F.explode(F.sequence(F.floor(F.col("first") / width), F.floor(F.col("last") / width))).alias("stretch"),
        ),
        "merkle-nodes",
    )
    linked = _linked(leaves, 0, 0, trees).withColumn("lead", F.col("number") - F.col("pos") % FAN)
    bottom = linked.select(
        "number",
        (F.col("number") == F.col("lead")).alias("lead"),
        F.coalesce("tampered", "leaf").alias("folded"),
        "parent",
        "ord",
    )
    steps = stage(spark.sql(CLIMB, args={"width": width}, leaves=bottom, nodes=stored), "merkle-steps")
    tops = steps.filter("folded is not null").select("number", "folded")
    path = F.sort_array(F.collect_list(F.when(F.col("step") > 1, F.struct("step", F.hex("siblings").alias("hexed")))))
    paths = steps.filter("siblings is not null").groupBy(F.col("number").alias("lead")).agg(
        F.max(F.when(F.col("step") == 1, F.col("siblings"))).alias("run"),
        F.array_join(F.transform(path, lambda s: s["hexed"]), "").alias("above"),
        F.max("subroot").alias("subroot"),
    )
    beside = F.concat(
        F.expr(f"substring(run, 1, {DIGEST} * ord)"), F.expr(f"substring(run, {DIGEST} * ord + {DIGEST + 1})")
    )
    proof = F.lower(F.concat(F.coalesce(F.hex(beside), F.lit("")), F.coalesce("above", F.lit(""))))
    return (
        linked.select("number", "doc_id", "leaf", "lead", "ord")
        .join(tops, "number")
        .join(paths, "lead", "left")
        .select(
            "doc_id",
            _hexed(F.col("leaf")).alias("leaf"),
            F.coalesce(_hexed(F.col("subroot")), F.lit(root)).alias("subroot"),
            F.lit(root).alias("root"),
            F.sha2(proof, 256).alias("proof_sha256"),
            _hexed(F.col("folded")).alias("folded_root"),
            (_hexed(F.col("folded")) == F.lit(root)).alias("verified"),
        )
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``manifest`` of all documents; a third of them (by crc32 of the id) are tampered with."""
    return manifest(
        table(spark, sf_dir, "documents"), fold(F.col("doc_id"), 3) == 0, lower_ascii(F.col("text"))
    )


def _oracle(levels: int = 12) -> str:
    """The levels one by one; trees of one node stay as they are."""

    def measured(column: str) -> str:
        return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen({column}::VARCHAR)::VARCHAR || ':' || {column}::VARCHAR END"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(measured(text if f == "text" else f) for f in FIELDS) + ")"

    def climb(name: str, start: str, nodes: str) -> list[str]:
        parts = []
        for k in range(levels):
            parts += [
                f"{name}r{k} AS (SELECT tree, pos // 8 AS pos, string_agg(digest, '' ORDER BY pos) AS kids, max(n) AS n "
                f"FROM {nodes if k == 0 else f'{name}n{k}'} GROUP BY ALL)",
                f"{name}n{k + 1} AS (SELECT tree, pos, CASE WHEN n = 1 THEN kids ELSE sha256(kids) END AS digest, "
                f"(n + 7) // 8 AS n FROM {name}r{k})",
                f"{name}c{k + 1} AS (SELECT c.uid, c.tree, c.pos // 8 AS pos, "
                "proof || CASE WHEN r.n = 1 THEN '' ELSE substr(kids, 1, 64 * (c.pos % 8)) || substr(kids, 64 * (c.pos % 8) + 65) END AS proof, "
                "CASE WHEN r.n = 1 THEN folded ELSE sha256(substr(kids, 1, 64 * (c.pos % 8)) || folded || substr(kids, 64 * (c.pos % 8) + 65)) END AS folded "
                f"FROM {start if k == 0 else f'{name}c{k}'} c JOIN {name}r{k} r ON c.tree = r.tree AND c.pos // 8 = r.pos)",
            ]
        return parts

    crc = (
        "xor(4294967295, list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ord(d)::BIGINT), "
        "lambda a, b: list_reduce([xor(a, b)] || [0, 0, 0, 0, 0, 0, 0, 0], "
        "lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"
    )
    parts = [
        f"hashed AS (SELECT row_number() OVER () AS uid, *, {leaf('text')} AS leaf, "
        f"CASE WHEN {crc} % 3 = 0 THEN {leaf('low')} END AS changed "
        "FROM (SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents))",
        "leaves AS (SELECT uid, doc_id, leaf, coalesce(changed, leaf) AS folded, '' AS proof, leaf AS digest, "
        "dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, "
        "row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, uid) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM hashed)",
        *climb("own", "leaves", "leaves"),
        f"crown AS (SELECT 0 AS tree, tree AS pos, digest, count(*) OVER () AS n FROM ownn{levels})",
        f"risen AS (SELECT uid, 0 AS tree, tree AS pos, proof, folded FROM ownc{levels})",
        *climb("top", "risen", "crown"),
    ]
    return (
        "WITH " + ",\n".join(parts) + f"\nSELECT l.doc_id, l.leaf, s.digest AS subroot, r.digest AS root, sha256(c.proof) AS proof_sha256, "
        f"c.folded AS folded_root, c.folded = r.digest AS verified FROM leaves l JOIN topc{levels} c USING (uid) "
        f"JOIN ownn{levels} s ON l.tree = s.tree CROSS JOIN topn{levels} r"
    )


ORACLE = _oracle()
