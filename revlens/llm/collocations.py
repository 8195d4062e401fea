"""Phrase collocation mining with weighted acyclic automata.

Each task turns its texts into count transducers, cut at the bounds of prefix ranges. All
shards' automata of a range are united, weights summed. Part counts are looked up by
composition: a range asks the others for the parts of its candidates with an automaton of
them, which comes back weighed. So nothing is keyed by a word and no word is too frequent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlens.llm import transducers as tr
from revlens.llm.common import map_arrow, shuffle_width, stage, table

UNKNOWN = "und"
LONGEST, LEAST, TOP, SHARE = 3, 10, 2_000, 50
SCALE = 1_000_000

# Bytes of text that are counted at a time, and arcs a task gathers before it ships them.
SEGMENT, ARCS = 1 << 21, 1_200_000
# A prefix range is bounded by phrases of a sample: this many per task, this many in all.
# Bounds only deal the work; no result depends on them.
PER_TASK, SAMPLE = 64, 20_000
# Shares of a language in which its top is found first.
SLICES = 32

# 0xFF is in no UTF-8 text, so it can stand for the end of a piece.
MARK = b"\xff"
_ENDS = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes(
    0xFF if i in _ENDS else 0x20 if i == 9 else i + 32 if 65 <= i <= 90 else i for i in range(256)
)

Bound = tuple[str, tuple[bytes, ...]]


def _tokens(text: bytes) -> list[bytes]:
    """Lower-cased words (A-Z only) and a mark for every end of a piece."""
    # split() without a separator takes \x0b and the like as blanks, but those are marks by now.
    return text.translate(_FOLD).replace(MARK, b" \xff ").split()


def _segments(texts: Iterator[bytes]) -> Iterator[bytes]:
    """The texts joined by marks and cut at blanks into segments, a long text into several."""
    held, size = [], 0
    for text in texts:
        start = 0
        while start < len(text):
            stop = len(text)
            if stop - start > SEGMENT:
                blank = text.find(b" ", start + SEGMENT)
                stop = blank if blank >= 0 else stop
            held.append(text[start:stop] + (b"\n" if stop == len(text) else b" "))
            size += stop - start
            start = stop
            if size >= SEGMENT:
                yield b"".join(held)
                held, size = [], 0
    if held:
        yield b"".join(held)


def _counted(texts: Iterator[bytes], longest: int) -> Iterator[tr.Transducer]:
    """Count transducers of the texts' segments; phrases across a cut are counted once."""
    tail: list[bytes] = []
    for segment in _segments(texts):
        tokens = tail + _tokens(segment)
        starts = max(len(tokens) - (longest - 1), 0)
        tail = tokens[starts:]
        part = tr.count_windows(tokens, MARK, longest, starts)
        if len(part):
            yield part
    part = tr.count_windows(tail, MARK, longest, len(tail))
    if len(part):
        yield part


def _by_language(batch: pa.RecordBatch) -> dict[str, list[bytes]]:
    texts: dict[str, list[bytes]] = {}
    langs, bodies = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())
    for i, lang in enumerate(langs):
        if bodies[i].is_valid:
            texts.setdefault(UNKNOWN if lang is None else lang, []).append(bodies[i].as_py())
    return texts


def _share(bounds: list[Bound], lang: str) -> tuple[int, list[tuple[bytes, ...]]]:
    """Number of the first range that can hold the language, and the bounds within it."""
    name = lang.encode()
    first = sum(b[0].encode() < name for b in bounds)
    return first, [b[1] for b in bounds if b[0] == lang]


def _rows(columns: dict[str, tuple[pa.DataType, list]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values, kind) for kind, values in columns.values()], list(columns)
    )


def _cut_rows(bounds: list[Bound], lang: str, part: tr.Transducer) -> Iterator[tuple[int, bytes]]:
    first, inner = _share(bounds, lang)
    for i, piece in enumerate(tr.cut(part, inner)):
        if piece is not None:
            yield first + i, tr.pack(piece)


def range_bounds(texts: DataFrame, longest: int, ranges: int) -> list[Bound]:
    """At most ``ranges`` - 1 ascending bounds, from phrases of each task's first texts."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, keys = [], []
            for lang, bodies in _by_language(batch.slice(0, 500)).items():
                segment = next(_segments(iter(bodies)), b"")
                part = tr.count_windows(tokens := _tokens(segment), MARK, longest, len(tokens))
                for depth, level in enumerate(part.levels):
                    step = max(1, len(part) // PER_TASK)
                    columns = [column[step // 2 :: step] for column in tr.paths(part, depth)]
                    for row in zip(*[column.tolist() for column in columns]):
                        langs.append(lang)
                        keys.append(b" ".join(part.words[i] for i in row))
            yield _rows({"lang": (pa.string(), langs), "key": (pa.binary(), keys)})
            return

    drawn = map_arrow(texts, sample, "lang string, key binary")
    # Ordered by hash, a bounded number of rows reaches the driver.
    kept = drawn.orderBy(F.xxhash64("lang", "key")).limit(SAMPLE).collect()
    keys = sorted({(r["lang"], tuple(bytes(r["key"]).split(b" "))) for r in kept}, key=lambda k: (k[0].encode(), k[1]))
    if len(keys) <= ranges:
        return keys
    return [keys[len(keys) * i // ranges] for i in range(1, ranges)]


def shard_counts(texts: DataFrame, bounds: list[Bound], longest: int) -> DataFrame:
    """Rows (range, lang, shard): count transducers of what each task read."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: dict[str, list[tr.Transducer]] = {}

        def ship(lang: str) -> pa.RecordBatch:
            numbers, packed = zip(*_cut_rows(bounds, lang, tr.union(gathered.pop(lang))))
            return _rows(
                {
                    "range": (pa.int32(), numbers),
                    "lang": (pa.string(), [lang] * len(numbers)),
                    "shard": (pa.binary(), packed),
                }
            )

        for batch in batches:
            for lang, bodies in _by_language(batch).items():
                for part in _counted(iter(bodies), longest):
                    gathered.setdefault(lang, []).append(part)
                    if sum(map(len, gathered[lang])) >= ARCS:
                        yield ship(lang)
            # Languages share the bound.
            while sum(len(p) for parts in gathered.values() for p in parts) >= ARCS:
                yield ship(max(gathered, key=lambda lang: sum(map(len, gathered[lang]))))
        for lang in list(gathered):
            yield ship(lang)

    return map_arrow(texts, count, "range int, lang string, shard binary")


def _united(packed: list[bytes]) -> tr.Transducer:
    """Union in pairs of equal rank, so that few whole automata are unpacked at a time."""
    ranks: dict[int, tr.Transducer] = {}
    for blob in packed:
        part, rank = tr.unpack(blob), 0
        while rank in ranks:
            part, rank = tr.union([ranks.pop(rank), part]), rank + 1
        ranks[rank] = part
    return tr.union(list(ranks.values()))


def _grouped(rows: pa.Table, column: str) -> dict[str, list[bytes]]:
    groups: dict[str, list[bytes]] = {}
    for lang, blob in zip(rows.column("lang").to_pylist(), rows.column(column).to_pylist()):
        groups.setdefault(lang, []).append(blob)
    return groups


def united_counts(shards: DataFrame, least: int) -> DataFrame:
    """Rows (range, lang, words, counts): one automaton per range and language.

    ``words`` is the number of words whose one-word phrase lies in the range, and the
    automaton has the phrases that occur ``least`` times or more: a candidate's parts are as
    frequent as itself, so they are among these.
    """

    def unite(key: tuple, rows: pa.Table) -> pa.Table:
        out: dict[str, list] = {"range": [], "lang": [], "words": [], "counts": []}
        for lang, packed in _grouped(rows, "shard").items():
            whole = _united(packed)
            out["range"].append(key[0].as_py())
            out["lang"].append(lang)
            out["words"].append(int(whole.levels[0].weight.sum()))
            out["counts"].append(tr.pack(tr.pruned(whole, least)))
        types = {"range": pa.int32(), "lang": pa.string(), "words": pa.int64(), "counts": pa.binary()}
        return pa.table({name: pa.array(values, types[name]) for name, values in out.items()})

    return shards.groupBy("range").applyInArrow(unite, "range int, lang string, words long, counts binary")


def _candidates(part: tr.Transducer, least: int) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Word numbers and counts of the phrases of two words or more, by length."""
    for depth in range(1, len(part.levels)):
        weight = part.levels[depth].weight
        own = weight >= least
        if own.any():
            yield [column[own] for column in tr.paths(part, depth)], weight[own]


def _parts(columns: list[np.ndarray]) -> list[list[np.ndarray]]:
    """All that is asked of a phrase: both sides of each cut, and every phrase within it."""
    size = len(columns)
    return [columns[i:j] for i in range(size) for j in range(i + 1, size + 1)
            if j - i < size and (i == 0 or j == size or j - i > 1)]


def part_requests(counts: DataFrame, bounds: list[Bound], least: int) -> DataFrame:
    """Rows (range, lang, origin, parts): what range ``origin`` asks of ``range``."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for origin, lang, packed in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                own = tr.unpack(packed)
                depth = len(own.levels) - 1
                asked = [part for columns, _ in _candidates(own, least) for part in _parts(columns)]
                if not asked:
                    continue
                zeros = [np.zeros(len(part[0]), np.int64) for part in asked]
                padded = [
                    np.concatenate([part[i] + 1 if i < len(part) else zero for part, zero in zip(asked, zeros)])
                    for i in range(depth)
                ]
                rows, _ = tr.distinct_rows(padded, len(own.words) + 1)
                parts = tr.from_rows(own.words, rows, np.ones(len(rows[0]), np.int64), whole=True)
                numbers, blobs = zip(*_cut_rows(bounds, lang, parts))
                yield _rows(
                    {
                        "range": (pa.int32(), numbers),
                        "lang": (pa.string(), [lang] * len(numbers)),
                        "origin": (pa.int32(), [origin] * len(numbers)),
                        "parts": (pa.binary(), blobs),
                    }
                )

    return map_arrow(
        counts.select("range", "lang", "counts"), ask, "range int, lang string, origin int, parts binary"
    )


def part_counts(counts: DataFrame, requests: DataFrame) -> DataFrame:
    """Rows (range, lang, parts): each request composed with the range's counts, sent back."""

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        known = {lang: tr.unpack(blobs[0]) for lang, blobs in _grouped(left, "counts").items()}
        out: dict[str, list] = {"range": [], "lang": [], "parts": []}
        for origin, lang, blob in zip(*[right.column(c).to_pylist() for c in ("origin", "lang", "parts")]):
            if lang in known:
                out["range"].append(origin)
                out["lang"].append(lang)
                out["parts"].append(tr.pack(tr.compose(tr.unpack(blob), known[lang])))
        types = {"range": pa.int32(), "lang": pa.string(), "parts": pa.binary()}
        return pa.table({name: pa.array(values, types[name]) for name, values in out.items()})

    left, right = counts.groupBy("range"), requests.groupBy("range")
    return left.cogroup(right).applyInArrow(answer, "range int, lang string, parts binary")


FOUND = "lang string, phrase string, a long, l long, r long, score long, inside boolean"


def scored_phrases(counts: DataFrame, answers: DataFrame, least: int, share: int) -> DataFrame:
    """Candidates with the counts of their lowest cut, and the phrases that they displace.

    Rows with ``inside`` name a phrase to be dropped: it lies in a longer candidate that
    occurs in ``share`` percent of its places or more. Products are Python integers.
    """

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        answered = _grouped(right, "parts")
        out: dict[str, list] = {name: [] for name in ("lang", "phrase", "a", "l", "r", "score", "inside")}

        def add(*row) -> None:
            for values, value in zip(out.values(), row):
                values.append(value)

        for lang, blobs in _grouped(left, "counts").items():
            own = tr.unpack(blobs[0])
            if lang not in answered:
                continue
            known = _united(answered[lang])
            number = {word: i for i, word in enumerate(known.words)}
            mapped = np.fromiter((number.get(w, -1) for w in own.words), np.int64, len(own.words))

            def weight(columns: list[np.ndarray]) -> list[int]:
                return tr.weights_of(known, [mapped[column] for column in columns]).tolist()

            for columns, a in _candidates(own, least):
                size = len(columns)
                cuts = [(weight(columns[:k]), weight(columns[k:])) for k in range(1, size)]
                within = [part for part in _parts(columns) if len(part) > 1]
                counted = [weight(part) for part in within]
                rows = list(zip(*[column.tolist() for column in columns]))
                named = [[list(zip(*[c.tolist() for c in part])) for part in within], counted]
                for i, (row, n) in enumerate(zip(rows, a.tolist())):
                    value, k = min((SCALE * n * n // (l[i] * r[i]), k) for k, (l, r) in enumerate(cuts))
                    add(lang, b" ".join(own.words[w] for w in row), n, cuts[k][0][i], cuts[k][1][i], value, False)
                    for part, times in zip(*named):
                        if 100 * n >= share * times[i]:
                            add(lang, b" ".join(own.words[w] for w in part[i]), None, None, None, None, True)
        types = [pa.string(), pa.binary(), *[pa.int64()] * 4, pa.bool_()]
        built = {name: pa.array(values, kind) for (name, values), kind in zip(out.items(), types)}
        built["phrase"] = built["phrase"].cast(pa.string())
        return pa.table(built)

    left, right = counts.groupBy("range"), answers.groupBy("range")
    return left.cogroup(right).applyInArrow(score, FOUND)


def collocations(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP, share: int = SHARE
) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score): each language's best phrases.

    Texts are lower-cased (A-Z), cut at ``.,;:!?`` and line ends into pieces, these at blanks
    into words. Candidates are phrases of 2 to ``longest`` words of one piece that occur
    ``least`` times (a) or more; each is scored at its lowest cut into two parts that occur l
    and r times: floor(1000000 a a / (l r)). One that lies in a longer candidate with at least
    ``share`` percent of its places is dropped. n counts all words of the language.

    Rows count however often they are repeated and whatever their id; null and empty texts
    have no words, a null lang counts as ``und``, as the lang of that name does. Equal scores
    are ordered by count, then by phrase in byte order. Columns but lang and text are not
    read. An empty table, or one without a candidate, gives no rows.
    """
    texts = docs.select("lang", "text")
    bounds = range_bounds(texts, longest, shuffle_width(docs.sparkSession))
    counts = stage(united_counts(shard_counts(texts, bounds, longest), least), "phrase-counts")
    answers = part_counts(counts, part_requests(counts, bounds, least))
    found = stage(scored_phrases(counts, answers, least, share), "phrases")
    dropped = found.filter("inside").select("lang", "phrase").distinct()
    left = found.filter("not inside").join(dropped, ["lang", "phrase"], "left_anti")
    # A language may hold most phrases, so its slices are cut to the top first.
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    sliced = left.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(SLICES)))
    inner = Window.partitionBy("lang", "slice").orderBy(*order)
    best = sliced.withColumn("rank", F.row_number().over(inner)).filter(F.col("rank") <= top)
    outer = Window.partitionBy("lang").orderBy(*order)
    ranked = best.withColumn("rank", F.row_number().over(outer)).filter(F.col("rank") <= top)
    totals = counts.groupBy("lang").agg(F.sum("words").alias("n"))
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``collocations`` of all documents."""
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
lists AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
windows AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists),
spans AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3 FROM windows),
f1 AS (SELECT lang, w1, count(*) AS f FROM spans GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, count(*) AS f FROM spans WHERE w2 IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM spans WHERE w3 IS NOT NULL GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang),
cuts AS (
  SELECT c.lang, c.w1 || ' ' || c.w2 AS phrase, c.f AS a, x.f AS l, y.f AS r, 1 AS k
  FROM f2 c JOIN f1 x ON c.lang = x.lang AND c.w1 = x.w1 JOIN f1 y ON c.lang = y.lang AND c.w2 = y.w1 WHERE c.f >= 10
  UNION ALL
  SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.f, x.f, y.f, 1
  FROM f3 c JOIN f1 x ON c.lang = x.lang AND c.w1 = x.w1
  JOIN f2 y ON c.lang = y.lang AND c.w2 = y.w1 AND c.w3 = y.w2 WHERE c.f >= 10
  UNION ALL
  SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.f, x.f, y.f, 2
  FROM f3 c JOIN f2 x ON c.lang = x.lang AND c.w1 = x.w1 AND c.w2 = x.w2
  JOIN f1 y ON c.lang = y.lang AND c.w3 = y.w1 WHERE c.f >= 10),
scored AS (
  SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT c.lang, c.w1 || ' ' || c.w2 AS phrase FROM f3 c JOIN f2 p ON c.lang = p.lang AND c.w1 = p.w1 AND c.w2 = p.w2
  WHERE c.f >= 10 AND 100 * c.f >= 50 * p.f
  UNION
  SELECT c.lang, c.w2 || ' ' || c.w3 FROM f3 c JOIN f2 p ON c.lang = p.lang AND c.w2 = p.w1 AND c.w3 = p.w2
  WHERE c.f >= 10 AND 100 * c.f >= 50 * p.f),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM scored WHERE (lang, phrase) NOT IN (SELECT (lang, phrase) FROM inside))
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
