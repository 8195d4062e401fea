"""Language-model scores by a hierarchical Pitman-Yor model.

Restaurants serve words, and every previous word has one. Those of the ``CONTEXTS`` most
frequent previous words and of the start of a text send a customer per table to the root. Those
of all other previous words ("deep" ones) send theirs to one restaurant for other words, which
sends its own to the root. The root's base measure is spread over unboundedly many words, so
words never seen in training share the mass of its new tables and count as one class.

Seatings are sampled by Gibbs sweeps in blocks: all customers of one word in one context
stand up and are seated again one by one by the Chinese restaurant rule. That proposal is
accepted with the ratio of its normalisers to those of the old seating (as they were when it
was made), so that sweeps follow the posterior and not the seating order. Only numbers of tables
are kept. Beyond ``FEW`` customers, the tables that open are drawn for a block of customers at
once, with the weights of its middle, so a million customers cost some 170 steps.
Tables of other words in a restaurant are taken from the previous epoch; deep restaurants have
one epoch, which starts from one table a pair. Predictive probabilities are averaged over the
samples.

All statistics cover the whole training corpus. Counts of pairs are spread by the previous word
over buckets, whose number follows the session's shuffle width; a frequent one takes several, and
its pairs with other than frequent words are spread by the word. Frequent words (at most ``HEAD``)
and pairs (at most ``FREQUENT``) are scored where the texts lie, from tables of bounded size. Other
pairs are looked up in their bucket, which also holds the model's entries of other words; only
other words after other words are joined with the model by word.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import discard, fold, map_arrow, rows_of, shuffle_width, spread, stage, table, word_hashes

CONTEXTS = 62
OTHER, START = 0, CONTEXTS + 1
WIDTH = CONTEXTS + 2
HEAD = 131_072
# Deep pairs whose scores each task holds.
FREQUENT = 1_000_000
STRENGTH = 1.0
BURN_IN, SAMPLES = 2, 3
FOLDS, HELD_OUT = 5, 1
# Customers that are seated one by one.
FEW = 32
# Entries a task adds up before it sends them on.
BUFFER = 2_000_000
# Pairs of words and contexts that a task samples at a time.
SAMPLED = 400_000
# The id of what stands before a text.
BEFORE = -1


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct tokens of texts, the tokens as places in them, and tokens per text.

    The tokens of a text are its words, A-Z lower-cased, and one end (the empty word).
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words = lists.flatten()
    is_word = pc.not_equal(pc.binary_length(words), 0)
    ends = np.append(0, np.cumsum(is_word.to_numpy(zero_copy_only=False)))[np.append(0, np.cumsum(pc.list_value_length(lists)))]
    coded = words.filter(is_word).dictionary_encode()
    names = coded.dictionary.cast(pa.binary()).to_pylist()
    sizes = np.diff(ends) + 1
    tokens = np.full(sizes.sum(), len(names))
    inside = np.ones(len(tokens), bool)
    inside[np.cumsum(sizes) - 1] = False
    tokens[inside] = coded.indices.to_numpy()
    return word_hashes([*names, b""]), tokens, sizes


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) to (w, n), added up over the task."""
    parts, size = [], 0

    def flush():
        names, place = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
        sums = np.bincount(place, np.concatenate([n for _, n in parts]), len(names)).astype(np.int64)
        for start in range(0, len(names), 100_000):
            part = slice(start, start + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(names[part].view(np.int64)), pa.array(sums[part])], ["w", "n"])

    for batch in rows_of(batches):
        names, tokens, _ = _words(batch.column(0))
        parts.append((names, np.bincount(tokens, minlength=len(names))))
        size += len(names)
        if size > BUFFER:
            yield from flush()
            parts, size = [], 0
    if parts:
        yield from flush()


def _found(keys: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Place of each asked key among sorted ones, or -1."""
    if not len(keys):
        return np.full(len(asked), -1)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, at, -1)


class Head:
    """The frequent words by hash, the contexts among them, and the buckets of pairs.

    A word's id is its place among the frequent words, else its hash with the top bit set.
    """

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, tokens: int, buckets: int):
        order = np.argsort(hashes)
        self.hashes, self.counts = hashes[order], counts[order]
        end = word_hashes([b""])[0]
        by_count = np.lexsort((self.hashes, -self.counts))
        by_count = by_count[self.hashes[by_count] != end][:CONTEXTS]
        self.context = np.full(len(hashes) + 1, OTHER)
        self.context[by_count] = np.arange(1, len(by_count) + 1)
        # Buckets of each previous word, by its share of all tokens.
        self.shares = np.append(1 + self.counts * buckets // max(1, tokens), 1).astype(np.uint64)
        self.count = buckets

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of words by their hashes."""
        place = _found(self.hashes, hashes)
        return np.where(place >= 0, place, (hashes | np.uint64(1 << 63)).view(np.int64))

    def places(self, ids: np.ndarray) -> np.ndarray:
        """Place of each id in an array that has one more entry, for all other words."""
        return np.where(ids >= 0, ids, len(self.hashes))

    def pair(self, u: np.ndarray, w: np.ndarray) -> np.ndarray:
        """A number for each pair of frequent words."""
        return u * len(self.hashes) + w

    def contexts(self, previous: np.ndarray) -> np.ndarray:
        """Context of each previous word; deep ones have OTHER."""
        return np.where(previous == BEFORE, START, self.context[self.places(previous)])

    def buckets(self, u: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Bucket of each pair (previous word, word). All pairs of a rare previous word share one,
        as do the pairs of a rare word with other previous words."""
        shares = np.where(u == BEFORE, np.uint64(self.count), self.shares[self.places(u)])
        part = spread(w.view(np.uint64)) % shares
        key = u.view(np.uint64) + part * np.uint64(0x9E3779B97F4A7C15)
        return (spread(np.where(self.by_word(u, w), w.view(np.uint64), key)) % np.uint64(self.count)).astype(np.int32)

    def by_word(self, u: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Whether the word, not the previous one, chooses a pair's bucket."""
        return (w < 0) & ((u >= 0) | (u == BEFORE))


def _joined(texts: pa.Array, head: Head) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the tokens of texts one after another, of the words before them, and the text of each."""
    names, tokens, sizes = _words(texts)
    tokens = head.ids(names)[tokens]
    previous = np.append(BEFORE, tokens[:-1])
    previous[np.cumsum(sizes) - sizes] = BEFORE
    return tokens, previous, np.repeat(np.arange(len(sizes)), sizes)


# --- pairs ------------------------------------------------------------------------------


def _pair_keys(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    return spread(spread(u.view(np.uint64)) + w.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _by_pair(u: np.ndarray, w: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs with their counts added up."""
    keys = _pair_keys(u, w)
    order = np.argsort(keys)
    keys = keys[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    first = order[starts]
    return u[first], w[first], np.add.reduceat(n[order], starts)


def _packed(bucket: np.ndarray, columns: list, names: list[str]) -> pa.RecordBatch:
    """One row per bucket: (b, a list per column)."""
    order = np.lexsort((columns[0], bucket))
    bucket = bucket[order]
    starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    place = pa.array(np.append(starts, len(bucket)), pa.int32())
    lists = [pa.ListArray.from_arrays(place, pa.array(c[order])) for c in columns]
    return pa.RecordBatch.from_arrays([pa.array(bucket[starts]), *lists], ["b", *names])


def _unpacked(batch: pa.RecordBatch, width: int) -> Iterator[tuple]:
    """(b, an array per column) of each row whose first list is not null."""
    lists = [batch.column(i + 1) for i in range(width)]
    values = [c.flatten().to_numpy(zero_copy_only=False) for c in lists]
    sizes = [np.diff(c.offsets.to_numpy()) * c.is_valid().to_numpy(zero_copy_only=False) for c in lists]
    ends = [np.append(0, np.cumsum(s)) for s in sizes]
    for i, b in enumerate(batch.column(0).to_pylist()):
        if lists[0][i].is_valid:
            yield b, *[v[e[i] : e[i + 1]] for v, e in zip(values, ends, strict=True)]


_PAIRS = "b int, u array<long>, w array<long>, n array<long>"


def _count_pairs(shared):
    """(text) to (b, u, w, n): counts of each word after each previous one, added up over the task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, held, size = shared.value, [], 0

        def flush():
            u, w, n = _by_pair(*map(np.concatenate, zip(*held, strict=True)))
            return _packed(head.buckets(u, w), [u, w, n], ["u", "w", "n"])

        for batch in rows_of(batches):
            tokens, previous, _ = _joined(batch.column(0), head)
            held.append(_by_pair(previous, tokens, np.ones(len(tokens), np.int64)))
            size += len(held[-1][0])
            if size > BUFFER:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return count


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (b, u, w, n) to one row per bucket."""
    held = defaultdict(list)
    for batch in batches:
        for b, *columns in _unpacked(batch, 3):
            held[b].append(columns)
    for b in list(held):
        u, w, n = _by_pair(*map(np.concatenate, zip(*held.pop(b), strict=True)))
        yield _packed(np.full(len(u), b, np.int32), [u, w, n], ["u", "w", "n"])


def _over_pairs(shared, work, names: list[str]):
    """``work(head, b, u, w, n, deep)`` on each bucket; it gives the columns of the result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = shared.value
        for batch in batches:
            for b, u, w, n in _unpacked(batch, 3):
                columns = work(head, b, u, w, n, head.contexts(u) == OTHER)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return run


def _entries(head, b, u, w, n, deep):
    """(w, ctx, n, c): customers of each word in each restaurant below the root, and its tokens.

    Those of OTHER, if each deep pair has one table.
    """
    names, place = np.unique(w[deep], return_inverse=True)
    context = head.contexts(u[~deep])
    return (
        np.append(names, w[~deep]),
        np.append(np.full(len(names), OTHER), context).astype(np.int32),
        np.append(np.bincount(place, minlength=len(names)), n[~deep]),
        np.append(np.bincount(place, n[deep], len(names)).astype(np.int64), n[~deep]),
    )


# Classes of counts, at most 1,100, and of what _statistics gives.
_GRADES = 16
_OWN, _GRADE, _SMALL = 0, 1, 2


def _statistics(head, b, u, w, n, deep):
    """(what, x, p, q) of deep pairs: customers and pairs of each frequent previous word, the
    number of pairs of frequent words by the class of their count, of pairs seen once and twice."""
    u, w, n = u[deep], w[deep], n[deep]
    own, place = np.unique(u[u >= 0], return_inverse=True)
    grades = np.bincount(np.floor(np.log2(n[(u >= 0) & (w >= 0)]) * _GRADES).astype(np.int64))
    seen = np.flatnonzero(grades)
    return (
        np.concatenate([np.full(len(own), _OWN), np.full(len(seen), _GRADE), [_SMALL]]).astype(np.int32),
        np.concatenate([own, seen, [0]]).astype(np.int64),
        np.concatenate([np.bincount(place, n[u >= 0], len(own)), grades[seen], [(n == 1).sum()]]).astype(np.int64),
        np.concatenate([np.bincount(place, minlength=len(own)), np.zeros(len(seen)), [(n == 2).sum()]]).astype(np.int64),
    )


def _repeated(kinds_shared):
    """(b, u, w, n, k): deep pairs seen twice or more, and the pairs of their previous word."""

    def work(head, b, u, w, n, deep):
        u, w, n = u[deep], w[deep], n[deep]
        _, place, kinds = np.unique(u, return_inverse=True, return_counts=True)
        known = kinds_shared.value[head.places(u)]
        many = n > 1
        k = np.where(u >= 0, known, kinds[place])[many]
        return np.full(len(k), b, np.int32), u[many], w[many], n[many], k.astype(np.int64)

    return work


def _frequent(grade: int):
    """(u, w, n): deep pairs of frequent words with a count of this class or above."""

    def work(head, b, u, w, n, deep):
        chosen = deep & (u >= 0) & (w >= 0)
        chosen[chosen] = np.floor(np.log2(n[chosen]) * _GRADES) >= grade
        return u[chosen], w[chosen], n[chosen]

    return work


# --- sampling ---------------------------------------------------------------------------


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, for arguments of at least 16 (error below 1e-9)."""
    return (x - 0.5) * np.log(x) - x + 0.9189385332046727 + 1 / (12 * x) - 1 / (360 * x**3)


def _uniform(key: np.ndarray, sweep: int, step: int) -> np.ndarray:
    """Repeatable uniforms in (0, 1) by word and context, sweep and step."""
    salt = ((sweep + 1) * 0x9E3779B97F4A7C15 + step * 0xD1B54A32D192ED03) % 2**64
    mixed = spread(key + np.uint64(salt))
    return ((mixed >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


def _binomial(size, chance, key, sweep: int, step: int) -> np.ndarray:
    """Repeatable binomial numbers; those of mean above 16 are rounded normal ones."""
    mean = size * chance
    uniform = _uniform(key, sweep, step)
    second = _uniform(key, sweep, step + 1_000_000)
    normal = np.sqrt(-2 * np.log(uniform)) * np.cos(2 * np.pi * second)
    out = np.clip(np.rint(mean + normal * np.sqrt(mean * (1 - chance))), 0, size)
    live = np.flatnonzero(mean <= 16)
    if not len(live):
        return out
    n, odds, left = size[live], chance[live] / (1 - chance[live]), uniform[live]
    weight = (1 - chance[live]) ** n
    k = 0
    while len(live):
        left = left - weight
        over = (left > 0) & (k < n) & (k < 100)
        out[live[~over]] = k
        live, n, odds, left = live[over], n[over], odds[over], left[over]
        weight = weight[over] * (n - k) / (k + 1) * odds
        k += 1
    return out


def seat(counts, others, parent, discount, strength, key, sweep):
    """Seat ``counts`` customers per pair one by one: tables, and log of the normalisers.

    ``others`` are the restaurant's tables with other words, ``parent`` the parent's
    probability of the word. A customer opens a table with weight (strength + discount *
    tables) * parent and joins one with weight (customers - discount * own tables).
    """
    order = np.argsort(-counts, kind="stable")
    c, p, key = counts[order], parent[order], key[order]
    base = strength + discount * others[order]
    tables, norm = np.ones(len(c)), np.zeros(len(c))
    for k in range(2, FEW + 1):
        n = np.searchsorted(-c, -k, side="right")  # pairs with at least k customers
        if not n:
            break
        opens = (base[:n] + discount * tables[:n]) * p[:n]
        joins = k - 1 - discount * tables[:n]
        norm[:n] += np.log(opens + joins)
        tables[:n] += _uniform(key[:n], sweep, k) * (opens + joins) < opens
    # Beyond: a block of a sixteenth of the customers so far at a time.
    at = float(FEW)
    n = np.searchsorted(-c, -FEW - 1, side="right")
    step = FEW + 1
    while n:
        t, size = tables[:n], np.minimum(max(1.0, at // 16), c[:n] - at)
        opened = np.zeros(n)
        for draws in (False, True):  # the first round estimates the block's middle
            middle = t + opened / 2
            opens = (base[:n] + discount * middle) * p[:n]
            x = opens - discount * middle
            chance = opens / (x + at + (size - 1) / 2)
            opened = _binomial(size, chance, key[:n], sweep, step) if draws else size * chance
        norm[:n] += _log_gamma(at + size + x) - _log_gamma(at + x)
        tables[:n] += opened
        at += max(1.0, at // 16)
        n = np.searchsorted(-c[:n], -at, side="left")  # pairs with more than ``at`` customers
        step += 1
    out_tables, out_norm = np.empty(len(c)), np.empty(len(c))
    out_tables[order], out_norm[order] = tables, norm
    return out_tables, out_norm


def _gibbs(words, sizes, contexts, counts, model, samples: int):
    """Mean numbers of tables per pair over ``samples`` sweeps after the burn-in.

    ``sizes``: pairs per word. ``model``: tables by context, customers of the root, words
    of the vocabulary, discounts of context and root.
    """
    tables_of, root_total, vocabulary, discount, root_discount = model
    word = np.repeat(np.arange(len(words)), sizes)
    key = spread(np.repeat(words, sizes) + contexts.astype(np.uint64) * np.uint64(0x632BE59BD9B4E019))
    many = np.flatnonzero(counts > 1)
    tables = np.ones(len(counts))
    norm = np.full(len(many), -np.inf)
    fresh = (STRENGTH + root_discount * vocabulary) / (vocabulary + 1)
    total = np.zeros(len(counts))
    for sweep in range(-1, BURN_IN + samples):
        root = np.bincount(word, tables, len(words))
        alone = root[word[many]] - tables[many]  # the word's root customers from elsewhere
        parent = (np.maximum(alone - root_discount, 0) + fresh) / (STRENGTH + root_total)
        others = np.maximum(tables_of[contexts[many]] - tables[many], 0)
        new, new_norm = seat(counts[many], others, parent, discount, STRENGTH, key[many], sweep)
        ratio = np.exp(np.minimum(new_norm - norm, 0)) if sweep >= 0 else np.ones(len(many))
        accept = _uniform(key[many], sweep, 0) < ratio
        tables[many] = np.where(accept, new, tables[many])
        norm = np.where(accept, new_norm, norm)
        if sweep >= BURN_IN:
            total += tables
    return total / samples if samples else tables


def _sample(model, samples: int):
    """(w, c, ctxs, ns) to (w, c, root, ctxs, tables, seats): averaged seatings of each word's pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _together(batches, lambda b: len(b.column(2).flatten())):
            words = batch.column("w").to_numpy().view(np.uint64)
            contexts, counts = batch.column("ctxs").combine_chunks(), batch.column("ns").combine_chunks()
            sizes = np.diff(contexts.offsets.to_numpy())
            ctx = contexts.flatten().to_numpy().astype(np.int64)
            n = counts.flatten().to_numpy().astype(np.int64)
            tables = _gibbs(words, sizes, ctx, n, model, samples)
            word = np.repeat(np.arange(len(words)), sizes)
            place = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("w").combine_chunks(),
                    batch.column("c").combine_chunks(),
                    pa.array(np.bincount(word, tables, len(words))),
                    pa.ListArray.from_arrays(place, pa.array(ctx.astype(np.int32))),
                    pa.ListArray.from_arrays(place, pa.array(tables)),
                    pa.ListArray.from_arrays(place, pa.array(n - model[3] * tables)),
                ],
                ["w", "c", "root", "ctxs", "tables", "seats"],
            )

    return run


def _together(batches: Iterator[pa.RecordBatch], pairs) -> Iterator[pa.Table]:
    """Batches put together to about ``SAMPLED`` pairs, as each step of a sweep has its own cost."""
    held, size = [], 0
    for batch in rows_of(batches, 10_000):
        held.append(batch)
        size += pairs(batch)
        if size > SAMPLED:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _seat_repeated(pairs: float, vocabulary: int, discount: float):
    """(b, u, w, n, k, kw) to (b, u, w, n, e, o): tables beyond the first, mean and last sample.

    ``k``, ``kw``: pairs of the previous word and of the word, a table each; ``pairs``: all.
    """
    fresh = (STRENGTH + discount * vocabulary) / (vocabulary + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _together(batches, lambda b: b.num_rows):
            u, w, n, k, kw = (batch.column(i).to_numpy() for i in range(1, 6))
            parent = (np.maximum(kw - 1 - discount, 0) + fresh) / (STRENGTH + pairs)
            key, total = _pair_keys(u, w), np.zeros(len(u))
            for sweep in range(SAMPLES):
                tables, _ = seat(n, k - 1, parent, discount, STRENGTH, key, sweep)
                total += tables - 1
            some = pa.array(total > 0)
            columns = [*(batch.column(i).combine_chunks() for i in range(4)), pa.array(total / SAMPLES), pa.array((tables - 1).astype(np.int64))]
            yield pa.RecordBatch.from_arrays([c.filter(some) for c in columns], ["b", "u", "w", "n", "e", "o"])

    return run


_MODEL = "w long, c long, root double, ctxs array<int>, tables array<double>, seats array<double>"


def _tables_by_context(model: DataFrame) -> np.ndarray:
    """Tables in each restaurant: one number per context reaches the driver."""
    pairs = model.select(F.explode(F.arrays_zip("ctxs", "tables")).alias("p"))
    sums = pairs.groupBy("p.ctxs").agg(F.sum("p.tables").alias("t")).collect()
    out = np.zeros(WIDTH)
    for ctx, t in sums:
        out[ctx] = t
    return out


class Model:
    """A trained model: its word table, its pairs, and the bounded statistics around them."""

    def __init__(self, words, pairs, extras, deep, head, customers, tables, vocabulary, tokens, discount, root_discount):
        self.words, self.head = words, head
        # Deep pairs by bucket, and the mean number of tables beyond the first of those that have any.
        self.pairs, self.extras, self.deep = pairs, extras, deep
        self.vocabulary, self.tokens = vocabulary, tokens
        self.discount, self.root_discount = discount, root_discount
        self.scale = 1 / (STRENGTH + customers)
        self.backoff = (STRENGTH + discount * tables) / (STRENGTH + customers)
        self.root_total = STRENGTH + tables.sum()
        self.root_new = (STRENGTH + root_discount * vocabulary) / self.root_total
        self.base_total = tokens + 0.5 * (vocabulary + 1)


class Deep:
    """Of deep restaurants: the discount, and scale and backoff of frequent previous words.

    The last entry is that of a previous word without a restaurant. ``grade`` is the least class
    of the counts of frequent pairs.
    """

    def __init__(self, customers: np.ndarray, tables: np.ndarray, discount: float, grade: int):
        self.discount, self.grade = discount, grade
        self.scale, self.backoff = self.of(customers, tables)

    def of(self, customers: np.ndarray, tables: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        total = STRENGTH + customers
        return 1 / total, (STRENGTH + self.discount * tables) / total


def _discount(ones: int | None, twos: int | None) -> float:
    ones, twos = ones or 0, twos or 0
    return float(np.clip(ones / max(1, ones + 2 * twos), 0.1, 0.95))


def train(texts: DataFrame) -> Model:
    """A model of the column ``text`` of all rows of ``texts``; null texts count as empty."""
    spark = texts.sparkSession
    texts = texts.select("text")
    vocabulary = stage(
        map_arrow(texts, _count_words, "w long, n long").groupBy("w").agg(F.sum("n").alias("c")), "vocabulary"
    )
    sums = vocabulary.agg(F.count("*"), F.coalesce(F.sum("c"), F.lit(0))).first()
    # The least count with at most HEAD words, from a histogram of at most 1,100 classes.
    grade = F.floor(F.log2("c") * _GRADES)
    grades = vocabulary.groupBy(grade.alias("g")).agg(F.count("*").alias("n")).collect()
    least = _least_class(grades, HEAD)
    chosen = vocabulary.filter(grade >= least) if least is not None else vocabulary.limit(0)
    frequent = chosen.toPandas()
    width = shuffle_width(spark)
    head = Head(frequent["w"].to_numpy().view(np.uint64), frequent["c"].to_numpy(), sums[1], 4 * width)
    shared = spark.sparkContext.broadcast(head)
    # Frames of finished shuffles are not kept, so that Spark can remove those files.
    pairs = stage(
        map_arrow(map_arrow(texts, _count_pairs(shared), _PAIRS).repartition(width, "b"), _merge, _PAIRS), "pairs"
    )
    # At most WIDTH entries a word.
    is_other = F.col("ctx") == OTHER
    counted = stage(
        map_arrow(pairs, _over_pairs(shared, _entries, ["w", "ctx", "n", "c"]), "w long, ctx int, n long, c long")
        .groupBy("w")
        .agg(
            F.sum("c").alias("c"),
            F.sum(F.when(is_other, F.col("n"))).alias("k"),
            F.sort_array(F.collect_list(F.when(~is_other, F.struct("ctx", "n")))).alias("p"),
        ),
        "entries",
    )
    extras, deep = _deep_restaurants(pairs, counted, shared, sums[0])
    opened = extras.groupBy(F.col("w").alias("_w")).agg(F.sum("o").alias("o"))
    customers = F.array((F.col("k") + F.coalesce("o", F.lit(0))).cast("long"))
    grouped = stage(
        counted.join(opened, F.col("w") == F.col("_w"), "left").select(
            "w",
            "c",
            F.when(F.col("k").isNull(), F.col("p.ctx")).otherwise(F.concat(F.array(F.lit(OTHER)), "p.ctx")).alias("ctxs"),
            F.when(F.col("k").isNull(), F.col("p.n")).otherwise(F.concat(customers, "p.n")).alias("ns"),
        ),
        "grouped",
    )
    flat = grouped.select(F.explode(F.arrays_zip("ctxs", "ns")).alias("p")).select("p.ctxs", "p.ns")
    customers, kinds, ones, twos = (np.zeros(WIDTH) for _ in range(4))
    for ctx, n, k, one, two in flat.groupBy("ctxs").agg(
        F.sum("ns"), F.count("*"), F.count_if(F.col("ns") == 1), F.count_if(F.col("ns") == 2)
    ).collect():
        customers[ctx], kinds[ctx], ones[ctx], twos[ctx] = n, k, one, two
    single = grouped.agg(
        F.count_if(F.size("ctxs") == 1), F.count_if(F.size("ctxs") == 2)
    ).first()
    discount, root_discount = _discount(ones.sum(), twos.sum()), _discount(*single)
    # First epoch: tables by context, from one a pair; second: samples given those.
    tables = kinds
    for samples in (0, SAMPLES):
        model = (tables, tables.sum(), sums[0], discount, root_discount)
        words = map_arrow(grouped, _sample(model, samples), _MODEL)
        if samples:
            words = stage(words, "model")
        tables = _tables_by_context(words)
    discard(vocabulary, counted, grouped)
    return Model(words, pairs, extras, deep, head, customers, tables, sums[0], sums[1], discount, root_discount)


def _least_class(grades: list, limit: int) -> int | None:
    """The least class of (class, number) that has at most ``limit`` members with those above."""
    least, held = None, 0
    for g, n in sorted(grades, reverse=True):
        held += n
        if held > limit:
            break
        least = g
    return least


def _deep_restaurants(pairs: DataFrame, counted: DataFrame, shared, vocabulary: int) -> tuple[DataFrame, Deep]:
    """Tables beyond the first of each deep pair that has any, and statistics of the restaurants."""
    spark, head = pairs.sparkSession, shared.value
    said = map_arrow(pairs, _over_pairs(shared, _statistics, ["what", "x", "p", "q"]), "what int, x long, p long, q long")
    rows = said.groupBy("what", "x").agg(F.sum("p").alias("p"), F.sum("q").alias("q")).toArrow().to_pydict()
    what, x, p, q = (np.array(rows[c], np.int64) for c in ("what", "x", "p", "q"))
    customers, kinds = np.zeros(len(head.hashes) + 1), np.zeros(len(head.hashes) + 1)
    customers[x[what == _OWN]], kinds[x[what == _OWN]] = p[what == _OWN], q[what == _OWN]
    discount = _discount(int(p[what == _SMALL].sum()), int(q[what == _SMALL].sum()))
    grade = _least_class(list(zip(x[what == _GRADE].tolist(), p[what == _GRADE].tolist(), strict=True)), FREQUENT)
    all_pairs = counted.agg(F.coalesce(F.sum("k"), F.lit(0))).first()[0]
    own_kinds = spark.sparkContext.broadcast(kinds)
    repeated = map_arrow(
        pairs, _over_pairs(shared, _repeated(own_kinds), ["b", "u", "w", "n", "k"]), "b int, u long, w long, n long, k long"
    )
    known = counted.select(F.col("w").alias("_w"), F.col("k").alias("kw"))
    joined = repeated.join(known, F.col("w") == F.col("_w")).select("b", "u", "w", "n", "k", "kw")
    extras = stage(
        map_arrow(
            joined, _seat_repeated(float(all_pairs), vocabulary, discount), "b int, u long, w long, n long, e double, o long"
        ),
        "extras",
    )
    tables = kinds.copy()
    for u, e in extras.filter("u >= 0").groupBy("u").agg(F.sum("e")).collect():
        tables[u] += e
    return extras, Deep(customers, tables, discount, 2**31 if grade is None else grade)


# --- scoring ----------------------------------------------------------------------------


def _head_scores(model: Model) -> np.ndarray:
    """log10 probability of each frequent word in each context, at most HEAD rows."""
    head = model.head
    rows = model.words.filter("w >= 0").select("w", "root", "ctxs", "seats").toArrow()
    scores = np.empty((len(head.hashes), WIDTH), np.float32)
    at = rows.column("w").to_numpy()
    root = (rows.column("root").to_numpy() - model.root_discount) / model.root_total
    ctxs, seats = rows.column("ctxs").combine_chunks(), rows.column("seats").combine_chunks()
    offsets, ctx, seat_ = ctxs.offsets.to_numpy(), ctxs.flatten().to_numpy(), seats.flatten().to_numpy()
    for i in range(len(at)):
        p = model.backoff * root[i]
        own = slice(offsets[i], offsets[i + 1])
        p[ctx[own]] += seat_[own] * model.scale[ctx[own]]
        scores[at[i]] = np.log10(p)
    return scores


def _frequent_scores(model: Model, shared, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys of the frequent deep pairs, and their log10 probabilities, at most FREQUENT."""
    deep = model.deep
    rows = map_arrow(
        model.pairs, _over_pairs(shared, _frequent(deep.grade), ["u", "w", "n"]), "u long, w long, n long"
    ).toArrow()
    u, w, n = (rows.column(c).to_numpy() for c in ("u", "w", "n"))
    keys = shared.value.pair(u, w)
    order = np.argsort(keys)
    u, w, n, keys = u[order], w[order], n[order].astype(np.float64), keys[order]
    more = model.extras.filter((F.col("u") >= 0) & (F.col("w") >= 0) & (F.floor(F.log2("n") * _GRADES) >= deep.grade))
    more = more.select("u", "w", "e").toArrow()
    tables = np.ones(len(keys))
    asked = shared.value.pair(more.column("u").to_numpy(), more.column("w").to_numpy())
    tables[np.searchsorted(keys, asked)] += more.column("e").to_numpy()
    p = (n - deep.discount * tables) * deep.scale[u] + deep.backoff[u] * 10.0 ** scores[w, OTHER]
    return keys, np.log10(p).astype(np.float32)


_SUMS = ["rid", "doc_id", "n_tokens", "n_known", "base", "score"]
_ASKED = (
    "b int, u array<long>, w array<long>, rid array<long>, doc_id array<long>, n_tokens array<long>, "
    "n_known array<long>, base array<double>, score array<double>, first long, at array<short>"
)


def _score(shared, base_total: float):
    """(rid, doc_id, text) to packed rows: per bucket the tokens (u, w, first + at: rid) that are
    not scored here, and per batch the sums of each text over those that are."""
    names = ["b", "u", "w", *_SUMS, "first", "at"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, scores, keys, key_scores = shared.value
        base = np.log10((head.counts + 0.5) / base_total)
        for batch in rows_of(batches, 1_000):
            tokens, previous, text = _joined(batch.column(2), head)
            contexts = head.contexts(previous)
            rids, rows = batch.column(0).to_numpy(), batch.num_rows
            common = tokens >= 0
            at, where = tokens[common], text[common]
            total = np.bincount(where, minlength=rows)
            sums = [np.bincount(text, minlength=rows), total, np.bincount(where, base[at], rows)]
            known = common & (contexts != OTHER)
            value = np.zeros(len(tokens))
            value[known] = scores[tokens[known], contexts[known]]
            both = common & (contexts == OTHER) & (previous >= 0)
            place = _found(keys, head.pair(previous[both], tokens[both]))
            value[np.flatnonzero(both)[place >= 0]] = key_scores[place[place >= 0]]
            known[both] = place >= 0
            sums.append(np.bincount(text, value, rows))
            own = [
                batch.column(0),
                batch.column(1),
                *map(pa.array, (sums[0].astype(np.int64), sums[1].astype(np.int64), sums[2].astype(float), sums[3].astype(float))),
            ]
            whole = pa.array([0, rows], pa.int32())
            spread_by = int(spread(rids[:1].view(np.uint64))[0] % np.uint64(head.count))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([spread_by], pa.int32()),
                    *[pa.array([None], pa.list_(pa.int64()))] * 2,
                    *[pa.ListArray.from_arrays(whole, c) for c in own],
                    pa.nulls(1, pa.int64()),
                    pa.nulls(1, pa.list_(pa.int16())),
                ],
                names,
            )
            left = ~known
            if left.any():
                u, w = previous[left], tokens[left]
                asked = _packed(head.buckets(u, w), [u, w, (rids - rids[0])[text[left]]], ["u", "w", "at"])
                size = asked.num_rows
                nothing = [pa.nulls(size, pa.list_(pa.int64()))] * 4 + [pa.nulls(size, pa.list_(pa.float64()))] * 2
                first = pa.array(np.full(size, rids[0]))
                at = asked.column(3).cast(pa.list_(pa.int16()))  # fails if it does not fit
                yield pa.RecordBatch.from_arrays([*asked.columns[:3], *nothing, first, at], names)

    return score


_PARTS = (
    "rid long, w long, ctx int, a float, f float, doc_id long, n_tokens long, n_known long, base double, score double"
)


_WORDS = "b int, x array<long>, c array<long>, root array<double>, many array<int>, ctx array<int>, seats array<double>"


def _pack_words(shared):
    """The model's rows of other words to packed rows: per bucket the words (x), the number of
    restaurants of each (many), and their seats one after another."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = shared.value
        for batch in _together(batches, lambda b: b.num_rows):
            w = batch.column("w").to_numpy()
            b = head.buckets(np.full(len(w), BEFORE), w)
            order = np.lexsort((w, b))
            b, rows = b[order], batch.take(pa.array(order))
            ctxs, seats = rows.column("ctxs").combine_chunks(), rows.column("seats").combine_chunks()
            many = pc.list_value_length(ctxs).to_numpy()
            starts = np.append(np.flatnonzero(np.append(True, b[1:] != b[:-1])), len(b))
            place, inner = pa.array(starts, pa.int32()), pa.array(np.append(0, np.cumsum(many))[starts], pa.int32())
            own = [*(rows.column(c).combine_chunks() for c in ("w", "c", "root")), pa.array(many)]
            columns = [*(pa.ListArray.from_arrays(place, c) for c in own), *(pa.ListArray.from_arrays(inner, c.flatten()) for c in (ctxs, seats))]
            yield pa.RecordBatch.from_arrays([pa.array(b[starts[:-1]]), *columns], ["b", "x", "c", "root", "many", "ctx", "seats"])

    return pack


class Shallow:
    """What the probabilities of other words in the shallow restaurants need beside their entries."""

    def __init__(self, model: Model):
        self.scale, self.backoff = model.scale, model.backoff
        self.root_discount, self.root_total, self.root_new = model.root_discount, model.root_total, model.root_new
        self.base_total = model.base_total

    def of(self, entries: list, w: np.ndarray, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of each word in its context, and its tokens, from the entries of a bucket."""
        x, c, root, many, ctx, seats = map(np.concatenate, zip(*entries, strict=True))
        order = np.argsort(x)
        rank = np.empty(len(x), np.int64)
        rank[order] = np.arange(len(x))
        keys = np.repeat(rank, many) * WIDTH + ctx
        by_key = np.argsort(keys)
        keys, seats = keys[by_key], seats[by_key]
        place = _found(x[order], w)
        there = place >= 0
        tokens, from_root = np.zeros(len(w), np.int64), np.full(len(w), float(self.root_new))
        tokens[there] = c[order][place[there]]
        from_root[there] = (root[order][place[there]] - self.root_discount) / self.root_total
        at = np.where(there, _found(keys, place * WIDTH + contexts), -1)
        own = np.zeros(len(w))
        own[at >= 0] = seats[at[at >= 0]]
        return own * self.scale[contexts] + self.backoff[contexts] * from_root, tokens


_NO_WORDS = tuple(np.empty(0, kind) for kind in (np.int64, np.int64, float, np.int32, np.int32, float))


def _look_up(shared, deep: Deep, shallow: Shallow):
    """Packed rows of tokens, sums, pairs (n), extra tables (e) and words (x) to rows of two kinds.

    Sums of texts (ctx -1, or -2 with frequent words' score in a; w is the rid, which no other word has), and other
    words (w) after other words, whose probability is a + f * that of the context's shallow restaurant.
    """
    names = [x.split()[0] for x in _PARTS.split(", ")]

    def rows(rid, size, **given):
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.float32(), pa.float32(), *[pa.int64()] * 3, *[pa.float64()] * 2]
        columns = [given.get(c) for c in names[1:]]
        arrays = [pa.nulls(size, k) if c is None else c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds[1:], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(rid, kinds[0]), *arrays], names)

    def sums_of(batch):
        for i in range(batch.num_rows):
            if batch.column(6)[i].is_valid:
                rid, *values = (batch.column(k)[i].values for k in range(3, 9))
                own = rid.to_numpy()
                given = dict(zip(_SUMS[1:], values, strict=True))
                yield rows(own, len(own), w=own, ctx=np.full(len(own), -1), **given)

    def bucket(asked, pairs, extras, words, head, scores, totals):
        u, w, rid = map(np.concatenate, zip(*asked, strict=True))
        contexts = head.contexts(u)
        seats, scale, backoff = np.zeros(len(u)), np.ones(len(u)), np.ones(len(u))
        inside = contexts == OTHER
        scale[inside], backoff[inside] = deep.scale[head.places(u[inside])], deep.backoff[head.places(u[inside])]
        if pairs:
            pu, pw, pn = map(np.concatenate, zip(*pairs, strict=True))
            keys = _pair_keys(pu, pw)
            order = np.argsort(keys)
            pu, pn, keys = pu[order], pn[order], keys[order]
            tables = np.ones(len(keys))
            for eu, ew, e in extras:
                tables[np.searchsorted(keys, _pair_keys(eu, ew))] += e
            place = _found(keys, _pair_keys(u, w))
            found = inside & (place >= 0)
            seats[found] = pn[place[found]] - deep.discount * tables[place[found]]
            # Rare previous words have all their pairs here.
            rare = (pu < 0) & (pu != BEFORE)
            names_, own = np.unique(pu[rare], return_inverse=True)
            by_name = deep.of(np.bincount(own, pn[rare], len(names_)), np.bincount(own, tables[rare], len(names_)))
            place = _found(names_, u)
            there = inside & (u < 0) & (place >= 0)
            scale[there], backoff[there] = by_name[0][place[there]], by_name[1][place[there]]
        seats *= scale
        common, here = w >= 0, head.by_word(u, w)
        score, base, known = np.zeros((2, len(w))), np.zeros(len(w)), np.zeros(len(w), np.int64)
        score[0, common] = np.log10(seats[common] + backoff[common] * 10.0 ** scores[w[common], contexts[common]])
        own, tokens = shallow.of(words or [_NO_WORDS], w[here], contexts[here])
        # a and f are floats for all other words, also in the rows below.
        score[1, here] = np.log10(seats[here].astype(np.float32) + backoff[here].astype(np.float32) * own)
        base[here], known[here] = np.log10((tokens + 0.5) / shallow.base_total), tokens > 0
        told = common | here
        texts, place = np.unique(rid[told], return_inverse=True)
        totals.append((texts, *(np.bincount(place, v[told], len(texts)) for v in (known, base, *score))))
        other = ~told
        if other.any():
            yield rows(rid[other], int(other.sum()), w=w[other], ctx=contexts[other], a=seats[other], f=backoff[other])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, scores, *_ = shared.value
        asked, pairs, extras, words, totals = *(defaultdict(list) for _ in range(4)), []
        for batch in batches:
            yield from sums_of(batch)
            tokens = batch.filter(batch.column(9).is_valid()).select([0, 1, 2, 10, 9])
            for (b, u, w, at), first in zip(_unpacked(tokens, 3), tokens.column(4).to_pylist(), strict=True):
                asked[b].append((u, w, first + at.astype(np.int64)))
            for held, first, columns in ((pairs, 11, [1, 2, 11]), (extras, 12, [1, 2, 12]), (words, 13, [*range(13, 19)])):
                some = batch.filter(batch.column(first).is_valid()).select([0, *columns])
                for b, *values in _unpacked(some, len(columns)):
                    held[b].append(values)
        for b in list(asked):
            yield from bucket(asked.pop(b), pairs.pop(b, []), extras.pop(b, []), words.pop(b, []), head, scores, totals)
        if totals:
            texts, place = np.unique(np.concatenate([t for t, *_ in totals]), return_inverse=True)
            known, base, common, here = (np.bincount(place, np.concatenate([t[k] for t in totals]), len(texts)) for k in range(1, 5))
            for start in range(0, len(texts), 100_000):
                part = slice(start, start + 100_000)
                own = texts[part]
                given = {"n_known": known[part].astype(np.int64), "base": base[part], "a": common[part], "score": here[part]}
                yield rows(own, len(own), w=own, ctx=np.full(len(own), -2), **given)

    return run


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """Rows (doc_id, n_tokens, n_known, train_tokens, base_score, score), one per row.

    Scores are log10 probabilities of the whole text, end included. A null text is empty.
    """
    spark, context = docs.sparkSession, docs.sparkSession.sparkContext
    scores = _head_scores(model)
    shared = context.broadcast((model.head, scores, *_frequent_scores(model, context.broadcast(model.head), scores)))
    numbered = docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    asked = map_arrow(numbered, _score(shared, float(model.base_total)), _ASKED)
    tables = model.extras.groupBy("b").agg(F.collect_list(F.struct("u", "w", "e")).alias("p"))
    tables = tables.select("b", F.col("p.u").alias("u"), F.col("p.w").alias("w"), F.col("p.e").alias("e"))
    rare = model.words.filter("w < 0").select("w", "c", "root", "ctxs", "seats")
    words = map_arrow(rare, _pack_words(context.broadcast(model.head)), _WORDS)
    together = asked.unionByName(model.pairs, True).unionByName(tables, True).unionByName(words, True)
    look_up = _look_up(shared, model.deep, Shallow(model))
    parts = map_arrow(together.repartition(shuffle_width(spark), "b"), look_up, _PARTS)
    joined = parts.join(rare, "w", "left")

    def by_context(values: np.ndarray):
        return F.element_at(F.array(*[F.lit(float(v)) for v in values]), F.col("ctx") + 1)

    place = F.array_position("ctxs", F.col("ctx")).cast("int")
    seats = F.when(place > 0, F.get("seats", place - 1)).otherwise(0.0) * by_context(model.scale)
    root = F.when(
        F.col("root").isNotNull(), (F.col("root") - model.root_discount) / float(model.root_total)
    ).otherwise(float(model.root_new))
    shallow = F.coalesce(seats, F.lit(0.0)) + by_context(model.backoff) * root
    probability = F.col("a") + F.col("f") * shallow
    is_word = F.col("ctx") >= 0
    found = F.coalesce("c", F.lit(0))
    valued = joined.select(
        "rid",
        "doc_id",
        "n_tokens",
        F.when(is_word, (found > 0).cast("long")).otherwise(F.col("n_known")).alias("known"),
        F.when(is_word, F.log10((found + 0.5) / float(model.base_total))).otherwise(F.col("base")).alias("base"),
        F.when(is_word, F.log10(probability)).otherwise(F.coalesce("a", F.lit(0.0)) + F.col("score")).alias("score"),
    )
    return valued.groupBy("rid").agg(
        F.max("doc_id").alias("doc_id"),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum("known").alias("n_known"),
        F.lit(int(model.tokens)).cast("long").alias("train_tokens"),
        F.sum("base").alias("base_score"),
        F.sum("score").alias("score"),
    ).drop("rid")


def perplexity(scored: DataFrame) -> DataFrame:
    """One row: tokens and perplexity of the scored texts."""
    per_token = -F.sum("score") / F.sum("n_tokens")
    return scored.agg(F.sum("n_tokens").alias("n_tokens"), F.pow(F.lit(10.0), per_token).alias("perplexity"))


def score_documents(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    Learns from the rows whose crc32(doc_id as text) modulo 5 is not 1 and scores all of
    them; a null id is not held out. Other columns are ignored; an empty table gives no
    rows. Repeated rows are scored each; equal texts get equal scores.
    """
    held = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    scored = score_texts(docs, train(docs.filter(~held)))
    return scored.select(
        "doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op6_pitman_yor_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``score_documents`` over all documents."""
    return score_documents(table(spark, sf_dir, "documents"))
