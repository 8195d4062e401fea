"""Quality rules by a hashed n-gram log-likelihood ratio, in DataFrame functions only.

Words and word pairs are hashed into buckets. Two multinomials over the buckets are fitted,
one on the trusted documents and one on the whole corpus. A document's score is the mean,
over its n-grams, of log p_trusted - log p_corpus. It passes if the score reaches a threshold
taken from the trusted documents themselves: their mean less a number of standard deviations.
Fixed base rules are counted as well; a document is kept if it passes both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import BLANKS, WORD, stage, table

BUCKETS = 8192
# Fixed value. On check_s it rejects all 1,345 documents labelled bad that pass the base rules (8 would
# let 24 of them pass) and 10 of the 16,906 labelled good.
DEVIATIONS = 4.0
SMOOTHING = 1.0
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
WINDOW = 3
REPEAT_PERCENT = 50


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def _grams(words: str, width: int) -> Column:
    """64-bit hashes of all runs of ``width`` words in an array column."""
    last = F.size(words) - width
    starts = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]))


def base_counts(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with words and the counts of the base rules.

    n_words, word_chars (code points in words), n_symbols, n_dup_lines (lines with a word
    equal to an earlier line) and n_repeat_words (words in 3-word windows found twice or more
    in the text). A null text counts as empty.
    """
    text = F.coalesce("text", F.lit(""))
    symbol_free = F.translate(text, SYMBOLS, "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    worded = docs.select(
        "doc_id",
        _words(F.col("text")).alias("words"),
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(symbol_free)).cast("long").alias("n_symbols"),
        lines.alias("lines"),
    )
    counted = worded.select(
        "doc_id",
        "words",
        "word_chars",
        "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _grams("words", WINDOW).alias("windows"),
    )
    # Positions of windows by content; a window is repeated if a neighbour there is equal.
    ranked = counted.withColumn(
        "places",
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    repeated = ranked.withColumn(
        "repeated",
        F.sort_array(
            F.transform(
                F.filter(
                    F.transform(
                        "places",
                        lambda x, j: F.when(
                            (F.get("places", j - 1)["h"] == x["h"]) | (F.get("places", j + 1)["h"] == x["h"]),
                            x["i"],
                        ),
                    ),
                    lambda i: i.isNotNull(),
                ),
                lambda i: i,
            )
        ),
    )
    # Each repeated window adds the words up to the next one, at most its own three.
    covered = F.aggregate(
        F.transform(
            "repeated",
            lambda i, j: F.least(F.lit(WINDOW), F.coalesce(F.get("repeated", j + 1) - i, F.lit(WINDOW))),
        ),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    return repeated.select(
        "doc_id",
        "words",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def _buckets(words: str) -> Column:
    """Buckets of all words and word pairs; A-Z are not folded, as shouting is a signal."""
    grams = F.concat(_grams(words, 1), _grams(words, 2))
    return F.transform(grams, lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int"))


def bucket_weights(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """One row with the array ``weights``: log p_trusted - log p_corpus of every bucket.

    ``trusted`` has the doc_id of trusted documents, without repeats. Counts cover all
    documents; each task adds up its buckets before the shuffle, which carries at most
    BUCKETS rows a task. Both multinomials are smoothed by ``SMOOTHING`` per bucket.
    """
    # Null ids match nothing and are spread by text. The set of trusted ids grows with the
    # corpus, so it is merged at every size and never broadcast.
    spread_id = F.concat(F.lit("null:"), F.xxhash64("text").cast("string"))
    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), spread_id).alias("_id"), "text")
    good = trusted.select(F.col("doc_id").cast("string").alias("_id"), F.lit(1).alias("_good"))
    flagged = texts.join(good.hint("merge"), "_id", "left")
    grams = flagged.select(
        F.coalesce("_good", F.lit(0)).alias("good"), _words(F.col("text")).alias("words")
    ).select("good", F.explode(_buckets("words")).alias("bucket"))
    counts = grams.groupBy("bucket").agg(
        F.count("*").cast("double").alias("corpus"), F.sum("good").cast("double").alias("good")
    )
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    table_ = every.join(counts, "bucket", "left").na.fill(0.0)
    totals = table_.agg(F.sum("corpus").alias("all_corpus"), F.sum("good").alias("all_good"))
    ratio = F.log((F.col("good") + SMOOTHING) / (F.col("all_good") + SMOOTHING * BUCKETS)) - F.log(
        (F.col("corpus") + SMOOTHING) / (F.col("all_corpus") + SMOOTHING * BUCKETS)
    )
    rows = table_.join(F.broadcast(totals)).select("bucket", ratio.alias("weight"))
    return rows.agg(
        F.sort_array(F.collect_list(F.struct("bucket", "weight"))).alias("pairs")
    ).select(F.transform("pairs", lambda p: p["weight"]).alias("weights"))


def quality_rules(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """Rows (doc_id, n_words, counts of the base rules, base_failed, score, kept).

    ``trusted`` names trusted documents by doc_id; ids that are null or repeated there count
    once or not at all. base_failed is true below 50 words or if more than half of the words
    lie in repeated 3-word windows. kept is false if base_failed, else whether the score
    reaches the threshold. Without trusted documents the ratio means nothing and the base
    rules decide alone. A null text counts as empty and a document without words scores 0.
    Rows with equal doc_id are judged each on their own; an empty table gives no rows.
    """
    trusted = trusted.select("doc_id").filter("doc_id is not null").distinct()
    weights = stage(bucket_weights(docs, trusted), "weights")
    counted = base_counts(docs.select("doc_id", "text"))
    # One row of BUCKETS doubles, whatever the corpus.
    joined = counted.withColumn("buckets", _buckets("words")).join(F.broadcast(weights))
    total = F.aggregate(
        "buckets", F.lit(0.0), lambda acc, b: acc + F.get("weights", b)
    )
    scored = joined.select(
        *[c for c in counted.columns if c != "words"],
        F.when(F.size("buckets") > 0, total / F.size("buckets")).otherwise(0.0).alias("score"),
    )
    scored = stage(scored, "quality")
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")
    )
    good = (
        scored.filter(~base_failed)
        .join(trusted, "doc_id", "left_semi")
        .agg(F.avg("score").alias("m"), F.stddev_pop("score").alias("s"))
        .first()
    )
    threshold = None if good["m"] is None else good["m"] - DEVIATIONS * good["s"]
    passes = F.lit(True) if threshold is None else F.col("score") >= threshold
    return scored.withColumn("base_failed", base_failed).withColumn("kept", ~base_failed & passes)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``quality_rules`` over all documents; those labelled good and not toxic are trusted."""
    labels = table(spark, sf_dir, "labels")
    trusted = labels.filter("quality = 1 and coalesce(toxic, 0) = 0").select("doc_id")
    return quality_rules(table(spark, sf_dir, "documents"), trusted)
