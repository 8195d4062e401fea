"""Substring dedup with repeated-phrase automata.

A window is 35 consecutive words. Finding the recurring ones takes three steps.

1. Every window names one of its 8-word runs: the one with the least hash. Equal windows name
   equal runs, so only about one hash in 14 words is counted over the corpus, and windows
   whose run occurs once are out.
2. The remaining windows are counted over the corpus, which confirms the recurring ones.
3. Documents are dealt to shards of bounded size. Each shard compiles an Aho-Corasick
   automaton from the confirmed passages its documents hold: per recurring stretch its first
   and last window and one at least every 35 words between, as word sequences. All its
   documents with such a passage stream through it, and the words of every occurrence go.

A shard sends each hash once, packed by hash range, and hears back which of them recur, so a
passage that a third of all documents share is one entry per shard, not one per document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import (
    map_arrow,
    rows_of,
    shuffle_width,
    spread,
    stage,
    table,
    word_hashes,
)

WINDOW = 35
RUN = 8
# Characters of text per shard, and candidate windows per hash range, at most on average.
SHARD_CHARS = 4_000_000
RANGE_CHARS = 5_000_000

_DOCS = "shard int, doc_id long, n_words long, n_removed long, kept_sha256 string, text string"


def words_of(text: str | None) -> list[bytes]:
    """Words of a text as bytes; none for null."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def _runs(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words (1 to 64), by doubling and one overlap."""
    if len(hashes) < width:
        return np.empty(0, np.uint64)
    size, level = 1, hashes
    factor = np.uint64(0x9E3779B97F4A7C15)
    while size * 2 <= width:
        level = spread(level[: len(level) - size] * factor + level[size:])
        size *= 2
    if size < width:
        rest = width - size
        level = spread(level[: len(level) - rest] * factor + level[rest:])
    return level


def _named(hashes: np.ndarray) -> np.ndarray:
    """Per window the place of the run it names; non-decreasing."""
    runs = _runs(hashes, RUN)
    span = WINDOW - RUN + 1
    view = np.lib.stride_tricks.sliding_window_view(runs, span)
    return np.arange(len(view)) + view.argmin(axis=1)


def _name_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shard, text) to (shard, run, n): named runs with their occurrences."""
    for batch in rows_of(batches):
        shards, runs = [], []
        for shard, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            hashes = word_hashes(words_of(text))
            if len(hashes) >= WINDOW:
                named = _runs(hashes, RUN)[np.unique(_named(hashes))]
                runs.append(named)
                shards.append(np.full(len(named), shard, np.int32))
        if not runs:
            continue
        run, shard = np.concatenate(runs), np.concatenate(shards)
        order = np.lexsort((run, shard))
        run, shard = run[order], shard[order]
        new = np.append(True, (run[1:] != run[:-1]) | (shard[1:] != shard[:-1]))
        starts = np.flatnonzero(new)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(shard[new]),
                pa.array(run[new].view(np.int64)),
                pa.array(np.diff(np.append(starts, len(run)))),
            ],
            ["shard", "run", "n"],
        )


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _column(table_: pa.Table, name: str) -> list:
    return table_.column(name).to_pylist()


def _candidates(ranges: int):
    """A shard's documents and recurring runs to results, open documents and packed hashes."""

    def find(docs: pa.Table, runs: pa.Table) -> pa.Table:
        known = np.unique(runs.column("run").to_numpy().astype(np.int64).view(np.uint64))
        rows, hashes, shard = [], [], None
        for shard, doc_id, text in zip(  # noqa: B007
            *(_column(docs, c) for c in ("shard", "doc_id", "text")), strict=True
        ):
            words = words_of(text)
            own = np.empty(0, np.uint64)
            if len(words) >= WINDOW and len(known):
                of_words = word_hashes(words)
                named = _runs(of_words, RUN)[_named(of_words)]
                own = _runs(of_words, WINDOW)[_within(named, known)]
            if len(own):
                hashes.append(own)
                rows.append((shard, doc_id, len(words), None, None, text, None, None, None))
            else:
                rows.append((shard, doc_id, len(words), 0, _digest(words), None, None, None, None))
        if hashes:
            every, counts = np.unique(np.concatenate(hashes), return_counts=True)
            part = (every % np.uint64(ranges)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            every, counts, part = every[order], counts[order], part[order]
            for begin, end in _groups(part):
                rows.append(
                    (shard, None, None, None, None, None, int(part[begin]),
                     every[begin:end].tobytes(), (counts[begin:end] > 1).tobytes())
                )
        return _table(rows, _FOUND)

    return find


_FOUND = pa.schema(
    [
        ("shard", pa.int32()),
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("kept_sha256", pa.string()),
        ("text", pa.string()),
        ("part", pa.int64()),
        ("hashes", pa.binary()),
        ("again", pa.binary()),
    ]
)
_RESULT = pa.schema([_FOUND.field(c) for c in ("doc_id", "n_words", "n_removed", "kept_sha256")] + [("kept_text", pa.string())])


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.table(
        [pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def _groups(sorted_values: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of each stretch of equal values."""
    if not len(sorted_values):
        return []
    cuts = np.flatnonzero(np.diff(sorted_values)) + 1
    return list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(sorted_values)], strict=True))


def _within(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each value is among the sorted ``known``."""
    place = np.searchsorted(known, values)
    place[place == len(known)] = 0
    return known[place] == values if len(known) else np.zeros(len(values), bool)


def _recurring(sent: pa.Table) -> pa.Table:
    """All shards' hashes of one range to the recurring ones of each shard."""
    shards = _column(sent, "shard")
    hashes = [np.frombuffer(h, np.uint64) for h in _column(sent, "hashes")]
    again = [np.frombuffer(a, bool) for a in _column(sent, "again")]
    every, counts = np.unique(np.concatenate(hashes), return_counts=True)
    shared = every[counts > 1]
    rows = []
    for shard, own, twice in zip(shards, hashes, again, strict=True):
        back = own[twice | _within(own, shared)]
        if len(back):
            rows.append((shard, back.tobytes()))
    return _table(rows, pa.schema([("shard", pa.int32()), ("hashes", pa.binary())]))


def _phrases(starts: np.ndarray) -> np.ndarray:
    """Of the recurring windows of a text, those to compile: stretch ends, and strides."""
    chosen = []
    for begin, end in _groups(starts - np.arange(len(starts))):
        chosen += [*range(int(starts[begin]), int(starts[end - 1]), WINDOW), int(starts[end - 1])]
    return np.array(chosen, np.int64)


def _remove(docs: pa.Table, confirmed: pa.Table) -> pa.Table:
    """A shard's open documents and confirmed windows to results, through its automaton."""
    import ahocorasick

    known = np.unique(
        np.concatenate([np.frombuffer(h, np.uint64) for h in _column(confirmed, "hashes")] or [np.empty(0, np.uint64)])
    )
    texts = [words_of(text) for text in _column(docs, "text")]
    ids: dict[bytes, int] = {}
    coded = [tuple(ids.setdefault(w, len(ids)) for w in words) for words in texts]
    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH, ahocorasick.KEY_SEQUENCE)
    for words, code in zip(texts, coded, strict=True):
        if len(words) >= WINDOW:
            starts = np.flatnonzero(_within(_runs(word_hashes(words), WINDOW), known))
            for start in _phrases(starts).tolist():
                automaton.add_word(code[start : start + WINDOW])
    automaton.make_automaton()
    rows = []
    for doc_id, words, code in zip(_column(docs, "doc_id"), texts, coded, strict=True):
        ends = [end for end, _ in automaton.iter(code)] if len(automaton) else []
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, np.array(ends, np.int64) - WINDOW + 1, 1)
        np.add.at(change, np.array(ends, np.int64) + 1, -1)
        gone = np.cumsum(change[:-1]) > 0
        kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
        rows.append(
            (doc_id, len(words), int(gone.sum()), _digest(kept), b" ".join(kept).decode("utf-8", "surrogatepass"))
        )
    return _table(rows, _RESULT)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n_words, n_removed, kept_sha256, kept_text), one per row of ``docs``.

    Every word covered by a 35-word window whose word sequence also starts anywhere else, in
    the same text or another, is removed. kept_sha256 is the digest of the kept words joined
    by one space; kept_text is that text where words were removed, else null. A null or empty
    text has no words; texts below 35 words lose none; rows repeated with one id and text
    count as copies of each other. Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    width = shuffle_width(spark)
    shards = max(4 * width, chars // SHARD_CHARS)
    ranges = max(width, chars // RANGE_CHARS)
    dealt = docs.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int").alias("shard"),
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
    )
    named = stage(map_arrow(dealt.select("shard", "text"), _name_runs, "shard int, run long, n long"), "runs")
    twice = named.groupBy("run").agg(F.sum("n").alias("n")).filter("n > 1").select("run")
    routed = named.join(twice, "run", "left_semi").select("shard", "run")
    found = stage(
        dealt.groupBy("shard")
        .cogroup(routed.groupBy("shard"))
        .applyInArrow(_candidates(ranges), f"{_DOCS}, part long, hashes binary, again binary"),
        "candidates",
    )
    confirmed = (
        found.filter("part is not null")
        .select("part", "shard", "hashes", "again")
        .groupBy("part")
        .applyInArrow(_recurring, "shard int, hashes binary")
    )
    open_docs = found.filter("part is null and n_removed is null").select("shard", "doc_id", "text")
    cleaned = (
        open_docs.groupBy("shard")
        .cogroup(confirmed.groupBy("shard"))
        .applyInArrow(
            _remove, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
        )
    )
    done = found.filter("n_removed is not null").select(
        "doc_id", "n_words", "n_removed", "kept_sha256", F.lit(None).cast("string").alias("kept_text")
    )
    return done.unionByName(cleaned)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``remove_repeats`` over all documents."""
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


ORACLE = r"""
WITH w AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), x AS (
  SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS s FROM (
    SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM w WHERE len(w) >= 35)
), r AS (
  SELECT doc_id, i FROM x JOIN (SELECT s FROM x GROUP BY s HAVING count(*) > 1) USING (s)
), g AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM r
), n AS (
  SELECT doc_id, count(*) AS n, list(p) AS gone FROM g GROUP BY doc_id
), u AS (
  SELECT doc_id, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS p FROM w
), k AS (
  SELECT u.doc_id, string_agg(t, ' ' ORDER BY u.p) AS kept FROM u LEFT JOIN g ON u.doc_id = g.doc_id AND u.p = g.p
  WHERE g.p IS NULL GROUP BY u.doc_id
)
SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(n.n, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN n ON w.doc_id = n.doc_id LEFT JOIN k ON w.doc_id = k.doc_id
"""
