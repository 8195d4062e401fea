"""License scan: an exact set-similarity join of text blocks with notice templates.

DataFrame functions only. Tokens are ordered by their frequency in the whole corpus, rarest
first. A block that holds enough of a template must share one of the template's rarest
tokens with it, must be long enough, and must share it at a place that leaves enough tokens
on both sides; pairs that pass these prefix, length and positional filters are compared whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import stage, table

# Share of a template's distinct words that a block must hold.
CONTAINMENT = 0.9

# Anything else between words: ASCII but digits and letters.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases of the base scan and their labels.
PHRASES = {
    "apache license": "apache",
    "cc by": "cc-by",
    "gnu general public license": "gpl",
    "mit license": "mit",
}

# Wordings of public license notices, as words.
TEMPLATES = [
    ("agpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "released under the mit license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]


def normalized(text: Column) -> Column:
    """Words of the text, A-Z lower-cased, joined by one blank; empty for null."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(F.trim(F.regexp_replace(lower, GAPS, " ")), F.lit(""))


def words_of(norm: Column) -> Column:
    """The words of a normalized text (an empty array for the empty one)."""
    return F.when(norm == "", F.array().cast("array<string>")).otherwise(F.split(norm, " "))


def _count(norm: Column) -> Column:
    return F.when(F.trim(norm) == "", F.lit(0)).otherwise(F.size(F.split(F.trim(norm), " "))).cast("long")


def base_columns(norm: Column) -> dict[str, Column]:
    """n_words, n_base, first_word, last_word, and base_found (labels, sorted) of a normalized text.

    A text with a phrase is cut before every place of one: the pieces tell number and places.
    """
    padded = F.concat(F.lit(" "), norm, F.lit(" "))
    holds = {phrase: F.contains(padded, F.lit(f" {phrase} ")) for phrase in PHRASES}
    some = F.lit(False)
    for found in holds.values():
        some = some | found
    pieces = F.when(some, F.split(padded, f"(?<= )(?=(?:{'|'.join(PHRASES)}) )", -1))
    last = F.element_at(pieces, -1)
    labels = [F.when(holds[phrase], F.lit(label)) for phrase, label in PHRASES.items()]
    return {
        "n_words": _count(norm),
        "n_base": F.coalesce(F.size(pieces) - 1, F.lit(0)).cast("long"),
        "first_word": _count(F.get(pieces, F.lit(0))),
        "last_word": _count(norm) - _count(last),
        "base_found": F.sort_array(F.array_distinct(F.array_compact(F.array(*labels)))),
        "some": some,
    }


def template_table(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    """Rows (template, label, tokens: distinct words); as many as there are templates."""
    rows = [
        F.struct(
            F.lit(i).alias("template"),
            F.lit(label).alias("label"),
            F.array_distinct(F.split(F.lit(text), " ")).alias("tokens"),
        )
        for i, (label, text) in enumerate(templates)
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def ordered_templates(docs: DataFrame, templates: list[tuple[str, str]], share: float) -> DataFrame:
    """Templates with tokens by ascending frequency in all texts, least (tokens a block needs)
    and prefix (tokens of which such a block must hold one).

    Only tokens of templates can be shared, so only they are counted; each task adds up its own.
    """
    vocabulary = sorted({word for _, text in templates for word in text.split(" ")})
    token = F.explode(words_of(normalized(F.col("text")))).alias("token")
    counts = docs.select(token).filter(F.col("token").isin(vocabulary)).groupBy("token").agg(
        F.count("*").alias("n")
    )
    single = template_table(docs.sparkSession, templates).select("template", "label", F.explode("tokens").alias("token"))
    ordered = (
        single.join(counts, "token", "left")
        .groupBy("template", "label")
        .agg(F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))).alias("order"))
        .withColumn("tokens", F.transform("order", lambda t: t["token"]))
    )
    size = F.size("tokens")
    least = ordered.withColumn("least", F.ceil(size * F.lit(share) - F.lit(1e-9)).cast("int"))
    return least.withColumn("prefix", F.slice("tokens", 1, size - F.col("least") + 1))


def _blocks(words: Column, step: int) -> Column:
    """Stretches of twice ``step`` words, one every ``step`` words: what is no longer than a
    step lies whole in one of them."""
    starts = F.sequence(F.lit(0), F.floor((F.size(words) - 1) / step).cast("int"))
    return F.when(
        F.size(words) > 0, F.transform(starts, lambda i: F.slice(words, i * step + 1, F.lit(2 * step)))
    ).otherwise(F.array().cast("array<array<string>>"))


def _matches(blocks: DataFrame, ordered: DataFrame) -> DataFrame:
    """Rows (uid, label, share): the join of blocks (uid, block, tokens) with the templates.

    Block tokens are those of templates in the same global order, rarest first. Templates are
    a parameter and their rows few, whatever the corpus.
    """
    prefixes = ordered.select(
        "template", "label", "tokens", "least", F.posexplode("prefix").alias("i", "token")
    ).withColumnRenamed("tokens", "wanted")
    single = blocks.select("uid", "block", "tokens", F.posexplode("tokens").alias("j", "token"))
    size, wanted = F.size("tokens"), F.size("wanted")
    left = F.least(wanted - F.col("i"), size - F.col("j"))
    candidates = (
        single.join(F.broadcast(prefixes), "token")
        .filter(size >= F.col("least"))
        .filter(F.col("j") <= size - F.col("least"))
        .filter(left >= F.col("least"))
    )
    shared = F.size(F.array_intersect("wanted", "tokens"))
    # A pair that shares several prefix tokens is there several times, with one result.
    return candidates.filter(shared >= F.col("least")).select("uid", "label", (shared / wanted).alias("share"))


def scan_licenses(
    docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, share: float = CONTAINMENT
) -> DataFrame:
    """Rows (doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score).

    Words are runs of ASCII digits and letters (A-Z lower-cased) and non-ASCII characters. The
    base columns tell the places of the four phrases and their labels; ``labels`` adds those of
    every template of which some block holds ``share`` of the distinct words. Blocks are
    stretches of twice the longest template's words that overlap by half. score is the largest
    share found, 1 for a phrase and 0 if nothing was found.

    Every row is judged on its own, repeated rows and ids too; a null or empty text has no
    words, no places (null) and empty labels. Columns but doc_id and text are not read. An
    empty table gives no rows.
    """
    vocabulary = sorted({word for _, text in templates for word in text.split(" ")})
    step = max(len(text.split(" ")) for _, text in templates)
    ordered = stage(ordered_templates(docs, templates, share), "license-templates")
    # One row: the prefix tokens, and the rank of every token of a template.
    tokens = ordered.select(F.explode("order").alias("t")).distinct()
    guide = tokens.agg(
        F.map_from_entries(
            F.transform(
                F.sort_array(F.collect_list("t")), lambda t, i: F.struct(t["token"], i)
            )
        ).alias("ranks")
    ).join(ordered.agg(F.array_distinct(F.flatten(F.collect_list("prefix"))).alias("rarest")))
    known = F.array(*[F.lit(word) for word in vocabulary])
    scanned = docs.select("doc_id", normalized(F.col("text")).alias("norm"))
    scanned = scanned.withColumns(base_columns(F.col("norm")) | {"words": words_of(F.col("norm"))})
    guided = scanned.join(F.broadcast(guide))
    # Most texts, and most blocks of the others, hold no rare token and end here.
    rare = F.when(F.arrays_overlap("words", "rarest"), _blocks(F.col("words"), step))
    kept = F.transform(
        F.filter(rare, lambda block: F.arrays_overlap(block, F.col("rarest"))),
        lambda block: F.transform(
            F.sort_array(
                F.transform(
                    F.array_intersect(block, known), lambda t: F.struct(F.col("ranks")[t].alias("r"), t.alias("t"))
                )
            ),
            lambda pair: pair["t"],
        ),
    )
    found = stage(
        guided.select(
            F.monotonically_increasing_id().alias("uid"),
            "doc_id",
            "n_words",
            "n_base",
            F.when(F.col("some"), F.col("first_word")).alias("first_word"),
            F.when(F.col("some"), F.col("last_word")).alias("last_word"),
            "base_found",
            kept.alias("blocks"),
        ),
        "license-blocks",
    )
    blocks = found.select("uid", F.posexplode("blocks").alias("block", "tokens"))
    added = _matches(blocks, ordered).groupBy("uid").agg(
        F.collect_set("label").alias("added"), F.max("share").alias("best")
    )
    labels = F.array_union("base_found", F.coalesce("added", F.array().cast("array<string>")))
    return found.join(added, "uid", "left").select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_found", ",").alias("base_labels"),
        F.array_join(F.sort_array(labels), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``scan_licenses`` of all documents with the built-in templates."""
    return scan_licenses(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    """Every block against every template, and the base phrases word by word."""
    templates = ", ".join(
        f"({i}, '{label}', {sorted(set(text.split(' ')))})" for i, (label, text) in enumerate(TEMPLATES)
    )
    step = max(len(text.split(" ")) for _, text in TEMPLATES)
    phrases = ", ".join(f"('{label}', {phrase.split(' ')})" for phrase, label in PHRASES.items())
    return rf"""
WITH templates(template, label, tokens) AS (VALUES {templates}),
phrases(label, p) AS (VALUES {phrases}),
docs AS (
  SELECT row_number() OVER () AS uid, doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
places AS (
  SELECT uid, unnest(range(0, len(w))) AS i, w FROM docs),
hits AS (
  SELECT uid, i, label FROM places JOIN phrases ON w[i + 1] = p[1] AND w[i + 1 : i + len(p)] = p),
base AS (
  SELECT uid, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list_sort(list(DISTINCT label)) AS labels
  FROM hits GROUP BY uid),
blocks AS (
  SELECT uid, w[{step} * b + 1 : {step} * b + {2 * step}] AS t
  FROM (SELECT uid, w, unnest(range(0, (len(w) + {step - 1}) // {step})) AS b FROM docs)),
pairs AS (
  SELECT uid, label, len(list_intersect(tokens, t)) / len(tokens) AS share FROM blocks, templates
  WHERE len(list_intersect(tokens, t)) >= ceil({CONTAINMENT} * len(tokens) - 1e-9)),
added AS (SELECT uid, list(DISTINCT label) AS labels, max(share) AS best FROM pairs GROUP BY uid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(array_to_string(b.labels, ','), '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(a.labels, [])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0)::DOUBLE END AS score
FROM docs LEFT JOIN base b USING (uid) LEFT JOIN added a USING (uid)
"""


ORACLE = _oracle()
