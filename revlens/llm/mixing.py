"""Mixing sources to target weights by weighted fair queueing, in DataFrame functions only.

Every source is a queue. Its documents stand in a repeatable shuffled order and are served
up to ``epochs`` times; a document finishes at the virtual time (words its source has served
by then) / (the source's target). The mix is the common order of all finish times, cut where
the words served reach the total budget. A source is due its whole target at time 1, so each
comes within about a document of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlens.llm.common import count_words, running_total, stage, table

WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2
SEED = "mix-1:"
_ENTRY = ["rank", "lot", "doc_id", "size"]


def source_targets(
    sizes: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    epochs: int = EPOCHS,
) -> DataFrame:
    """Rows (source, rank, source_size, target), one per source.

    Sources take the weights in turn, by code point, null last. ``share`` of all words is
    dealt by weight; a target stops at ``epochs`` times its source, and what is over is dealt
    again by weight until none is above. That is one level for all sources below their
    stop, found by ordering sources by stop / weight. The windows see one row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = Window.orderBy(F.col("source").isNull(), "source")
    ranked = (
        totals.withColumn("rank", F.row_number().over(named))
        .withColumn(
            "weight",
            F.element_at(
                F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") - 1) % len(weights) + 1
            ),
        )
        .withColumn("stop", (F.col("source_size") * epochs).cast("double"))
        .withColumn("ratio", F.col("stop") / F.col("weight"))
    )
    ahead = Window.orderBy("ratio", "rank").rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy("ratio", "rank").rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    levelled = ranked.withColumn(
        "level",
        (
            F.sum("source_size").over(whole) * share
            - F.coalesce(F.sum("stop").over(ahead), F.lit(0.0))
        )
        / F.sum("weight").over(onward),
    )
    open_level = F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "rank", "level"))
    common = F.min(open_level).over(whole)["level"]
    return levelled.withColumn("common", common).select(
        "source",
        "rank",
        "source_size",
        F.when(F.col("common").isNull(), F.col("stop"))
        .otherwise(F.least("stop", F.col("weight") * F.col("common")))
        .alias("target"),
    )


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    epochs: int = EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """How often the mix takes each document: one row per (doc_id, source, size).

    Columns: doc_id, source, size (words), source_size, target, copies (rows with this key),
    passes (times each of them is taken, 0 to ``epochs``).

    A null text has no words; a document without words is never taken. Rows that agree in
    doc_id, source and size (repeated rows, null ids) form one entry and share its fate.
    Other columns are ignored. An empty table gives no rows. The result depends on the rows
    and ``seed`` only. Sources are spread over tasks, whatever their share of the rows.
    """
    sizes = stage(
        docs.select("doc_id", "source", count_words(F.col("text")).alias("size"))
        .groupBy("doc_id", "source", "size")
        .agg(F.count("*").alias("copies")),
        "mix-sizes",
    )
    targets = stage(
        source_targets(
            sizes.select("source", (F.col("size") * F.col("copies")).alias("size")),
            weights,
            share,
            epochs,
        ),
        "mix-targets",
    )
    lot = F.substring(
        F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 16
    )
    entries = (
        sizes.withColumn("lot", lot)
        .join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
        .drop("_s")
        .withColumn("words", F.col("size") * F.col("copies"))
    )
    queued = stage(
        running_total(entries, "words", _ENTRY[1:], "served", group=["rank"]), "mix-queues"
    )
    passes = (
        queued.filter("size > 0 and target > 0")
        .select("*", F.explode(F.array(*[F.lit(e) for e in range(epochs)])).alias("epoch"))
        .withColumn("finish", _finish(F.col("epoch")))
        .select("finish", *_ENTRY, "words")
    )
    ordered = running_total(passes, "words", ["finish", *_ENTRY], "total")
    budget = sizes.agg((F.sum(F.col("size") * F.col("copies")) * share).alias("b")).first()["b"]
    key = F.struct("finish", *_ENTRY)
    # One row: the last place of the common order that still fits the budget.
    last = ordered.filter(F.col("total") <= F.lit(budget or 0.0)).agg(F.max(key).alias("k")).first()["k"]
    taken = F.lit(0)
    if last is not None:
        doc_id = F.lit(last["doc_id"]).cast(queued.schema["doc_id"].dataType)
        cut = F.struct(
            F.lit(last["finish"]).alias("finish"),
            F.lit(last["rank"]).alias("rank"),
            F.lit(last["lot"]).alias("lot"),
            doc_id.alias("doc_id"),
            F.lit(last["size"]).cast("long").alias("size"),
        )
        for epoch in range(epochs):
            place = F.struct(_finish(F.lit(epoch)).alias("finish"), *_ENTRY)
            taken = taken + F.when(
                (F.col("size") > 0) & (F.col("target") > 0) & (place <= cut), 1
            ).otherwise(0)
    return queued.select(
        "doc_id", "source", "size", "source_size", "target", "copies", taken.alias("passes")
    )


def _finish(epoch):
    """Virtual finish time of an entry's pass number ``epoch`` (from 0)."""
    return (F.col("served") + epoch * F.col("source_size")) / F.col("target")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``mix_sources`` over all documents, one row per document."""
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("passes")).cast("long").alias("taken"),
    )


def mix_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as the mix takes it."""
    mixed = mix_sources(docs).filter("passes > 0").select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"), "passes"
    )
    # The caller's columns travel in one struct, so none can clash.
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), count_words(F.col("text")).alias("words")
    )
    return (
        rows.join(
            mixed,
            F.col("row.doc_id").eqNullSafe(F.col("_id"))
            & F.col("row.source").eqNullSafe(F.col("_source"))
            & (F.col("words") == F.col("_size")),
        )
        .withColumn("_pass", F.explode(F.sequence(F.lit(1), F.col("passes"))))
        .select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM d GROUP BY source
), w AS (
  SELECT *, [5.0, 2.0, 1.0][((rank - 1) % 3 + 1)::INT]::DOUBLE AS weight, (2 * source_size)::DOUBLE AS stop
  FROM s
), l AS (
  SELECT *, stop / weight AS ratio,
    ((SELECT sum(size) FROM d)::DOUBLE * 1.5::DOUBLE - coalesce(sum(stop) OVER
      (ORDER BY stop / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY stop / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w
), t AS (
  SELECT source, rank, source_size, coalesce(least(stop, weight * (
    SELECT level FROM l WHERE ratio > level ORDER BY ratio, rank LIMIT 1)), stop) AS target
  FROM l
), q AS (
  SELECT d.doc_id, size, rank, source_size, target, left(md5('mix-1:' || coalesce(d.doc_id::VARCHAR, '')), 16) AS lot
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), v AS (
  SELECT *, sum(size) OVER (PARTITION BY rank ORDER BY lot, doc_id NULLS FIRST, size
    ROWS UNBOUNDED PRECEDING) AS served
  FROM q
), p AS (
  SELECT doc_id, size, rank, lot, (served + e * source_size)::DOUBLE / target AS finish
  FROM v, (VALUES (0), (1)) AS r(e) WHERE size > 0 AND target > 0
), o AS (
  SELECT *, sum(size) OVER (ORDER BY finish, rank, lot, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) AS total
  FROM p
), k AS (
  SELECT doc_id, sum(size) AS taken FROM o WHERE total <= (SELECT sum(size) * 1.5 FROM d) GROUP BY doc_id
)
SELECT q.doc_id, size, source_size, target, coalesce(k.taken, 0)::BIGINT AS taken
FROM q LEFT JOIN k ON q.doc_id = k.doc_id
"""
