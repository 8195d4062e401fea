"""Language identification by prediction by partial matching over bytes.

Per language a context tree of order 3 counts which byte follows which context. The code
length of a byte is that of its longest known context: log2((n + q) / c) if it was seen c
times there, out of n followers of q kinds; if it was not, an escape of log2((n + q) / q)
and the length in the context shorter by one byte, down to 8 bits a byte. Statistics are
frozen after training, so a text's length in a language is a sum over its bytes. The
language with the least length is predicted.

Training counts four-byte runs, which hold all shorter contexts; each task adds up its
documents before the shuffle. Languages are taken in groups of at most ``GROUP``; a group's
table holds about ``NODES`` runs, of which each language has an equal share for its most
frequent ones (what a language leaves over goes to the others). Every run and context in it
has the code length of the whole counts in every language of the group, so what is left out
changes no other length; only runs in no language's share are told by shorter contexts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm.common import fold, map_arrow, release_memory, running_total, slices_of, stage, table

ORDER = 3
# Runs of four bytes kept in a table of languages, and byte pairs that can start or end one.
NODES = 500_000
PAIRS = 2048
# Languages in a table; there are as many tables as it takes.
GROUP = 16
# Classes by hash in which runs of equal frequency are taken.
CLASSES = 4096
UNKNOWN = "und"
FOLDS, HELD_OUT = 3, 1
# A text whose best language needs as many bits a byte as plain bytes is in no learned one.
PLAIN_BITS = 8.0
# Bytes put before each text, so that its first bytes have a context.
START = b"\n" * ORDER


def codes_of(text: str) -> np.ndarray:
    """The four-byte run that ends at each byte of a text, as 32-bit numbers."""
    data = np.frombuffer(START + text.encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    size = len(data) - ORDER
    code = data[:size] << np.uint32(24)
    for i in range(1, ORDER + 1):
        code |= data[i : i + size] << np.uint32(24 - 8 * i)
    return code


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) to (lang, code, n), added up over the task."""
    sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for batch in slices_of(batches, lambda b: b.column(1)):
        parts: dict[str, list[np.ndarray]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            parts.setdefault(lang, []).append(codes_of(text))
        for lang, codes in parts.items():
            new, counts = np.unique(np.concatenate(codes), return_counts=True)
            if lang in sums:
                new, counts = _added(*sums[lang], new, counts)
            sums[lang] = new, counts
    for lang, (codes, counts) in sums.items():
        for start in range(0, len(codes), 50_000):
            part = slice(start, start + 50_000)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(codes[part]), pa.string()),
                    pa.array(codes[part].astype(np.int64)),
                    pa.array(counts[part].astype(np.int64)),
                ],
                ["lang", "code", "n"],
            )


def _added(a, na, b, nb):
    codes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    return codes, np.bincount(place, np.concatenate([na, nb]), len(codes)).astype(np.int64)


def train(docs: DataFrame) -> DataFrame:
    """Rows (lang, code, n): how often each four-byte run occurs in each language.

    ``docs`` has lang and text; rows where either is null teach nothing.
    """
    known = docs.filter("lang is not null and text is not null").select("lang", "text")
    counts = map_arrow(known, _count, "lang string, code long, n long")
    return counts.groupBy("lang", "code").agg(F.sum("n").alias("n"))


class Trees:
    """Frozen context trees of some languages, as tables of code lengths."""

    def __init__(self, langs: list[str], rows: list[tuple[int, np.ndarray, np.ndarray]], levels=None):
        """``rows``: per language its number, sorted codes and their counts.

        Or ``levels``: per order and language (names, counts), and (contexts, followers,
        kinds of them), both sorted and the second for all contexts of any language's names.
        """
        self.langs = langs
        if levels is None:
            levels = [[_level(order, codes, counts) for _, codes, counts in rows] for order in range(ORDER + 1)]
        width = len(langs)
        # Code lengths by order: a table of known contexts + byte, and escapes by context.
        self.names: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []
        self.escapes: list[np.ndarray] = []
        for order, level in enumerate(levels):
            names = np.unique(np.concatenate([own for (own, _), _ in level]))
            contexts = np.unique(names >> np.uint64(8))
            lengths = np.empty((len(names), width), np.float32)
            escapes = np.zeros((len(contexts) + 1, width), np.float32)
            for lang, ((own, seen), (places, followers, sorts)) in enumerate(level):
                total, kinds = np.zeros(len(contexts)), np.zeros(len(contexts))
                at = np.searchsorted(contexts, places)
                total[at], kinds[at] = followers, sorts
                escape = np.where(kinds > 0, np.log2((total + kinds + (kinds == 0)) / np.maximum(kinds, 1)), 0.0)
                escapes[:-1, lang] = escape
                shorter = self._shorter(order, names, lang)
                column = escape[np.searchsorted(contexts, names >> np.uint64(8))] + shorter
                at = np.searchsorted(contexts, own >> np.uint64(8))
                column[np.searchsorted(names, own)] = np.log2((total[at] + kinds[at]) / seen)
                lengths[:, lang] = column
            self.names.append(names)
            self.lengths.append(lengths)
            self.escapes.append(escapes)
        self.contexts = [np.unique(names >> np.uint64(8)) for names in self.names]
        self.run: np.ndarray | None = None

    def _shorter(self, order: int, names: np.ndarray, lang: int) -> np.ndarray:
        """Code lengths of the last bytes of ``names`` in the context shorter by one byte."""
        if not order:
            return np.full(len(names), 8.0)
        below = names & np.uint64(2 ** (8 * order) - 1)
        return self.lengths[order - 1][np.searchsorted(self.names[order - 1], below), lang]

    def _index(self) -> None:
        """Direct tables: pair of bytes to a small number, two such numbers to the run.

        Made where they are used: they are larger than what they are made from.
        """
        names = self.names[ORDER]
        halves = np.concatenate([names >> np.uint64(16), names & np.uint64(0xFFFF)])
        pairs, counts = np.unique(halves, return_counts=True)
        pairs = pairs[np.argsort(-counts, kind="stable")][: PAIRS - 1]
        self.pair = np.zeros(65536, np.uint32)
        self.pair[pairs.astype(np.int64)] = np.arange(1, len(pairs) + 1, dtype=np.uint32)
        left, right = self.pair[(names >> np.uint64(16)).astype(np.int64)], self.pair[(names & np.uint64(0xFFFF)).astype(np.int64)]
        self.run = np.full(PAIRS * PAIRS, -1, np.int32)
        whole = (left > 0) & (right > 0)
        self.run[left[whole].astype(np.int64) * PAIRS + right[whole]] = np.flatnonzero(whole)

    def code_lengths(self, codes: np.ndarray) -> np.ndarray:
        """Code length in bits of each run's last byte, by language."""
        if self.run is None:
            self._index()
        at = self.run[self.pair[codes >> np.uint32(16)] * np.uint32(PAIRS) + self.pair[codes & np.uint32(0xFFFF)]]
        lengths = self.lengths[ORDER][at]  # what the direct tables lack has place -1 and is set below
        missing = np.flatnonzero(at < 0)
        if len(missing):
            lengths[missing] = self._by_search(codes[missing].astype(np.uint64))
        return lengths

    def _by_search(self, codes: np.ndarray) -> np.ndarray:
        """Code lengths by sorted tables, for what the direct tables lack; escapes add up."""
        lengths = np.zeros((len(codes), len(self.langs)), np.float32)
        open_ = np.arange(len(codes))
        for order in range(ORDER, -1, -1):
            part = codes[open_] & np.uint64(2 ** (8 * (order + 1)) - 1)
            place = np.minimum(np.searchsorted(self.names[order], part), len(self.names[order]) - 1)
            found = self.names[order][place] == part
            lengths[open_[found]] += self.lengths[order][place[found]]
            open_, part = open_[~found], part[~found] >> np.uint64(8)
            if not len(open_):
                return lengths
            place = np.minimum(np.searchsorted(self.contexts[order], part), len(self.contexts[order]) - 1)
            known = self.contexts[order][place] == part
            lengths[open_[known]] += self.escapes[order][place[known]]
        lengths[open_] += 8.0
        return lengths

    def text_lengths(self, texts: list[str]) -> np.ndarray:
        """Code length of each whole text by language, a bounded part at a time."""
        out = np.zeros((len(texts), len(self.langs)))
        for i, text in enumerate(texts):
            codes = codes_of(text)
            for start in range(0, len(codes), 100_000):
                out[i] += self.code_lengths(codes[start : start + 100_000]).sum(axis=0, dtype=np.float64)
        return out


def _level(order: int, codes: np.ndarray, counts: np.ndarray):
    """Names of an order with their counts, and their contexts with followers and kinds."""
    names, place = np.unique(codes & np.uint64(2 ** (8 * (order + 1)) - 1), return_inverse=True)
    seen = np.bincount(place, counts, len(names))
    contexts, place = np.unique(names >> np.uint64(8), return_inverse=True)
    return (names, seen), (contexts, np.bincount(place, seen, len(contexts)), np.bincount(place, minlength=len(contexts)))


class Forest:
    """Trees of all languages, a group of languages in each."""

    def __init__(self, trees: list[Trees]):
        self.trees = trees
        self.langs = [lang for tree in trees for lang in tree.langs]

    def text_lengths(self, texts: list[str]) -> np.ndarray:
        """Code length of each whole text by language."""
        return np.hstack([tree.text_lengths(texts) for tree in self.trees])


def shares(sizes: list[int], bound: int) -> int:
    """The largest share with which languages of ``sizes`` runs keep at most ``bound``."""
    left = bound
    for place, size in enumerate(sorted(sizes)):
        share = left // (len(sizes) - place)
        if size > share:
            return share
        left -= size
    return max(sizes)


def _kept(counts: DataFrame, share: int) -> DataFrame:
    """Codes (code) among the ``share`` most frequent ones of any language.

    Whole classes by frequency and hash are taken from the top, so no task orders a language.
    """
    classed = counts.withColumn("_down", -F.col("n")).withColumn(
        "_class", F.pmod(F.xxhash64("code"), F.lit(CLASSES)).cast("int")
    )
    classes = classed.groupBy("lang", "_down", "_class").agg(F.count("*").alias("_rows"))
    last = (
        running_total(classes, "_rows", ["_down", "_class"], "_total", ["lang"])
        .filter(F.col("_total") <= share)
        .groupBy("lang")
        .agg(F.max(F.struct("_down", "_class")).alias("_last"))
    )
    inside = classed.join(F.broadcast(last), "lang").filter(F.struct("_down", "_class") <= F.col("_last"))
    return stage(inside.select("code").distinct(), "kept")


def _by_level(rows: DataFrame, langs: list[str], key: str, values: list[str]) -> list[list[tuple[np.ndarray, ...]]]:
    """Per order and language the sorted keys and their values; both reach the driver as one number."""
    numbers = F.create_map(*[F.lit(x) for i, lang in enumerate(langs) for x in (lang, i)])
    place = (F.col("order") * len(langs) + numbers[F.col("lang")]).cast("short")
    table_ = rows.select(place.alias("place"), key, *values).toArrow()
    places, keys = table_["place"].to_numpy(), table_[key].to_numpy().astype(np.uint64)
    order = np.lexsort((keys, places))
    cuts = np.searchsorted(places[order], np.arange((ORDER + 1) * len(langs) + 1))
    columns = [keys, *(table_[v].to_numpy().astype(np.float64) for v in values)]
    parts = [tuple(c[order[start:end]] for c in columns) for start, end in zip(cuts[:-1], cuts[1:], strict=True)]
    return [parts[i : i + len(langs)] for i in range(0, len(parts), len(langs))]


def _named(runs: DataFrame, *more: str) -> DataFrame:
    """Rows (order, name) and ``more``: each run's last bytes, for every order."""
    by_order = [F.struct(F.lit(o).alias("order"), F.col("code").bitwiseAND(F.lit(2 ** (8 * (o + 1)) - 1)).alias("name")) for o in range(ORDER + 1)]
    return runs.select(F.inline(F.array(*by_order)), *more)


def _trees(counts: DataFrame, langs: list[str], share: int) -> Trees:
    """Trees of some languages; followers and kinds are those of all ``counts``."""
    own = counts.filter(F.col("lang").isin(langs))
    wanted, context = _named(_kept(own, share)).distinct(), F.shiftright("name", 8).alias("context")
    levels = stage(_named(own, "lang", "n").groupBy("lang", "order", "name").agg(F.sum("n").alias("seen")), "levels")
    contexts = levels.groupBy("lang", "order", context).agg(F.sum("seen").alias("followers"), F.count("*").alias("kinds"))
    names = levels.join(wanted, ["order", "name"], "left_semi")
    contexts = contexts.join(wanted.select("order", context).distinct(), ["order", "context"], "left_semi")
    by_name = _by_level(names, langs, "name", ["seen"])
    by_context = _by_level(contexts, langs, "context", ["followers", "kinds"])
    return Trees(langs, [], [list(zip(*level, strict=True)) for level in zip(by_name, by_context, strict=True)])


def fit(counts: DataFrame) -> Forest | None:
    """Trees of all languages in ``train``'s rows; None if there are none.

    Groups of at most ``GROUP`` languages follow one another by code point. Of a group at
    most ``NODES`` runs, in each of its languages, reach the driver at once; what is sent to
    the tasks grows with the number of groups only. ``counts`` is a written table.
    """
    sizes = dict(counts.groupBy("lang").agg(F.count("*")).collect())
    if not sizes:
        return None
    groups = [list(map(str, g)) for g in np.array_split(np.array(sorted(sizes), object), -(-len(sizes) // GROUP))]
    return Forest([_trees(counts, g, shares([sizes[lang] for lang in g], NODES)) for g in groups])


def has_letter(text: str) -> bool:
    """Whether a text has a letter of any script."""
    return any(map(str.isalpha, text))


def predict(docs: DataFrame, trees: Forest | None) -> DataFrame:
    """Rows (row, lang, share, bits): each row of ``docs`` whole, and what is told of its text.

    share is the predicted language's share of exp2(-bits per 16 characters) over all
    languages, between 0 and 1; bits is its code length per byte. A null text, one without a
    letter, or a lack of languages gives ``und``, 0 and null. Ties go to the language first
    by code point. Columns of ``docs`` may have any name or type; repeated rows stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def guess(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices_of(batches, lambda b: b.column(0).field("text")):
            texts = batch.column(0).field("text").to_pylist()
            langs, scores, rates = [UNKNOWN] * len(texts), [0.0] * len(texts), [None] * len(texts)
            some = [i for i, t in enumerate(texts) if t and has_letter(t)] if model else []
            if some:
                bits = model.text_lengths([texts[i] for i in some])
                best, least = bits.argmin(axis=1), bits.min(axis=1)
                sizes = np.array([len(texts[i]) for i in some])
                gap = (bits - least[:, None]) / sizes[:, None] * 16
                share = 1 / np.exp2(-np.minimum(gap, 1000)).sum(axis=1)
                for i, b, s, n in zip(some, best.tolist(), share.tolist(), least.tolist(), strict=True):
                    langs[i], scores[i] = model.langs[b], s
                    rates[i] = n / len(texts[i].encode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rates, pa.float64())],
                ["row", "lang", "share", "bits"],
            )
        release_memory()

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    told = [T.StructField("lang", T.StringType()), T.StructField("share", T.DoubleType()), T.StructField("bits", T.DoubleType())]
    return map_arrow(rows, guess, T.StructType([*rows.schema.fields, *told]))


def learned(docs: DataFrame) -> Forest | None:
    """Trees from the documents outside the held-out fold; null ids are outside it."""
    training = docs.filter(F.coalesce(fold(F.col("doc_id"), FOLDS) != HELD_OUT, F.lit(True)))
    return fit(stage(train(training), "contexts"))


def identify_languages(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, held_out, lang_pred, score), one per row of ``docs``.

    Learns from text and lang of the rows whose crc32(doc_id as text) modulo 3 is not 1, and
    predicts from the text alone. A null id is not held out. Other columns are ignored; an
    empty table gives no rows.
    """
    held = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    told = predict(docs.select("doc_id", "text"), learned(docs))
    return told.select(F.col("row.doc_id").alias("doc_id"), "lang", "share").select(
        "doc_id", held.alias("held_out"), F.col("lang").alias("lang_pred"), F.col("share").alias("score")
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``identify_languages`` over all documents."""
    return identify_languages(table(spark, sf_dir, "documents"))


def keep_identified(docs: DataFrame, most_bits: float = PLAIN_BITS) -> DataFrame:
    """``docs`` without the rows whose language is not identified.

    These are rows with a null text, one without a letter, or one that its best language
    codes in ``most_bits`` a byte or more, that is no shorter than plain bytes. Where no row
    has a language to learn from, the model can reject nothing and all rows stay. Repeated
    rows fare alike; an empty table gives no rows; other columns pass through, whatever their
    names.
    """
    trees = learned(docs)
    if trees is None:
        return docs
    told = predict(docs, trees).filter((F.col("lang") != UNKNOWN) & (F.col("bits") < most_bits))
    return told.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
