"""Weighted acyclic automata over words: what phrase mining counts, ships and looks up.

While it is worked on, an automaton is a tree of arcs in levels: arc i of a level has a word,
a weight and the arc of the level above that it continues; arcs are sorted by that and by
word. The weight is the count of the phrase that ends with the arc, 0 if the phrase is only
passed on the way to longer ones. ``pack`` shares equal states bottom-up, so what is written
is the minimal automaton of its paths.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import zstandard

from revlens.llm.common import spread


@dataclass
class Level:
    """Arcs of one depth: word (index), weight and arc above, sorted by (above, word)."""

    word: np.ndarray
    weight: np.ndarray
    above: np.ndarray

    def __len__(self) -> int:
        return len(self.word)

    def slice(self, start: int, stop: int) -> Level:
        return Level(self.word[start:stop], self.weight[start:stop], self.above[start:stop])


@dataclass
class Transducer:
    """``words`` ascend bytewise; level d holds the arcs that end phrases of d + 1 words."""

    words: list[bytes]
    levels: list[Level]

    def __len__(self) -> int:
        return sum(map(len, self.levels))


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Where rows start that differ from the one before."""
    size = len(columns[0])
    new = np.zeros(size, bool)
    if size:
        new[0] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return new


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of all ranges, one after the other."""
    before = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) + np.repeat(starts - before, sizes)


def from_rows(words: list[bytes], columns: list[np.ndarray], weight: np.ndarray, whole: bool) -> Transducer:
    """The automaton of sorted rows of word numbers (from 1; 0 after the end of a shorter row).

    Sorted input lets every state be closed once its prefix has passed. ``whole`` weighs only
    the row itself; else its prefixes get its weight too, as windows of running text need.
    """
    levels, at = [], np.arange(len(weight))
    above = np.zeros(len(weight), np.int64)
    for depth, column in enumerate(columns):
        longer = column[at] > 0
        at, above = at[longer], above[longer]
        word = column[at]
        new = _heads(above, word)
        first = np.flatnonzero(new)
        gained = weight[at]
        if whole and depth + 1 < len(columns):
            gained = np.where(columns[depth + 1][at] > 0, 0, gained)
        total = np.add.reduceat(gained, first) if len(first) else gained
        levels.append(Level(word[first] - 1, total, above[first]))
        above = np.cumsum(new) - 1
    return Transducer(words, levels)


def distinct_rows(columns: list[np.ndarray], base: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted distinct rows of numbers below ``base`` and how often each occurs."""
    if float(base) ** len(columns) < 2**62:
        code = np.zeros(len(columns[0]), np.int64)
        for column in columns:
            code = code * base + column
        code, counts = np.unique(code, return_counts=True)
        parts = []
        for _ in columns:
            code, part = np.divmod(code, base)
            parts.append(part)
        return parts[::-1], counts
    order = np.lexsort(columns[::-1])
    columns = [column[order] for column in columns]
    first = np.flatnonzero(_heads(*columns))
    return [column[first] for column in columns], np.diff(np.append(first, len(order)))


def count_windows(tokens: list[bytes], mark: bytes, longest: int, starts: int) -> Transducer:
    """Counts of all phrases up to ``longest`` words that begin at the first ``starts`` tokens.

    ``mark`` is no word; no phrase crosses it.
    """
    words = sorted(set(tokens) - {mark})
    number = {word: i for i, word in enumerate(words, 1)}
    number[mark] = 0
    ids = np.zeros(len(tokens) + longest, np.int64)
    ids[: len(tokens)] = np.fromiter(map(number.__getitem__, tokens), np.int64, len(tokens))
    columns = [ids[i : i + starts] for i in range(longest)]
    begins = columns[0] > 0
    columns = [column[begins] for column in columns]
    for left, right in zip(columns, columns[1:]):
        right[left == 0] = 0
    rows, counts = distinct_rows(columns, len(words) + 1)
    return from_rows(words, rows, counts, whole=False)


def union(parts: list[Transducer]) -> Transducer:
    """All paths of ``parts``, weights summed, level by level from the root."""
    if len(parts) == 1:
        return parts[0]
    words = sorted(set().union(*[part.words for part in parts]))
    number = {word: i for i, word in enumerate(words)}
    mapped = [np.fromiter(map(number.__getitem__, p.words), np.int64, len(p.words)) for p in parts]
    levels, joined = [], None
    sizes = np.zeros(len(parts), np.int64)
    for depth in range(max(len(part.levels) for part in parts)):
        found = [part.levels[depth] for part in parts]
        word = np.concatenate([m[level.word] for m, level in zip(mapped, found)])
        weight = np.concatenate([level.weight for level in found])
        if joined is None:
            above = np.zeros(len(word), np.int64)
        else:
            before = np.cumsum(sizes) - sizes
            above = joined[np.concatenate([level.above + b for level, b in zip(found, before)])]
        order = np.argsort(above * max(len(words), 1) + word, kind="stable")
        word, weight, above = word[order], weight[order], above[order]
        new = _heads(above, word)
        first = np.flatnonzero(new)
        total = np.add.reduceat(weight, first) if len(first) else weight
        levels.append(Level(word[first], total, above[first]))
        joined = np.empty(len(order), np.int64)
        joined[order] = np.cumsum(new) - 1
        sizes = np.array([len(level) for level in found])
    return Transducer(words, levels)


def narrowed(part: Transducer) -> Transducer:
    """The same automaton with no more words than its arcs bear."""
    used = np.unique(np.concatenate([level.word for level in part.levels]))
    levels = [Level(np.searchsorted(used, level.word), level.weight, level.above) for level in part.levels]
    return Transducer([part.words[i] for i in used.tolist()], levels)


def _begin(part: Transducer, bound: tuple[bytes, ...]) -> list[int]:
    """How many arcs of each level end phrases before ``bound`` (shorter ones come first)."""
    cuts, start, stop = [], 0, len(part.levels[0])
    exact = True
    for depth, level in enumerate(part.levels):
        if not exact or depth >= len(bound):
            # Nothing below equals the bound: its arcs are those below the last cut.
            cut = int(np.searchsorted(level.above, cuts[-1])) if depth else 0
            cuts.append(cut)
            continue
        at = bisect_left(part.words, bound[depth])
        cut = start + int(np.searchsorted(level.word[start:stop], at))
        exact = at < len(part.words) and part.words[at] == bound[depth] and cut < stop and level.word[cut] == at
        more = depth + 1 < len(bound)
        if exact and depth + 1 < len(part.levels):
            below = part.levels[depth + 1].above
            start, stop = (int(np.searchsorted(below, cut + i)) for i in (0, 1))
        # The phrase that is a true prefix of the bound comes before it.
        cuts.append(cut + 1 if exact and more else cut)
        if exact and not more:
            exact = False
    return cuts


def cut(part: Transducer, bounds: list[tuple[bytes, ...]]) -> list[Transducer | None]:
    """One automaton for each prefix range between ``bounds`` (ascending), None for empty ones.

    Arcs that lead to a range from outside are kept with weight 0.
    """
    edges = [[0] * len(part.levels)] + [_begin(part, b) for b in bounds] + [[len(level) for level in part.levels]]
    pieces = []
    for low, high in zip(edges, edges[1:]):
        if low == high:
            pieces.append(None)
            continue
        levels: list[Level] = []
        keep = None
        for depth in reversed(range(len(part.levels))):
            level, start, stop = part.levels[depth], low[depth], high[depth]
            first, last = start, stop
            if keep is not None:
                # The next level was cut to ``keep``: its arcs need the ones above them.
                above = part.levels[depth + 1].above[keep[0] : keep[1]]
                if len(above):
                    first = min(start, int(above[0])) if start < stop else int(above[0])
                    last = max(stop, int(above[-1]) + 1) if start < stop else int(above[-1]) + 1
                levels[0].above = above - first
            taken = level.slice(first, last)
            weight = taken.weight.copy()
            weight[: max(start - first, 0)] = 0
            weight[max(stop - first, 0) :] = 0
            levels.insert(0, Level(taken.word, weight, np.zeros(len(taken), np.int64)))
            keep = (first, last)
        pieces.append(Transducer(part.words, levels))
    return pieces


def pruned(part: Transducer, least: int) -> Transducer:
    """Only phrases that weigh ``least`` or more, and the arcs that lead to them."""
    needed = None
    kept: list[np.ndarray] = []
    for depth in reversed(range(len(part.levels))):
        level = part.levels[depth]
        keep = level.weight >= least
        if needed is not None:
            keep[needed] = True
        needed = np.unique(level.above[keep])
        kept.insert(0, keep)
    levels, place = [], None
    for level, keep in zip(part.levels, kept):
        above = level.above[keep]
        weight = np.where(level.weight[keep] >= least, level.weight[keep], 0)
        levels.append(Level(level.word[keep], weight, above if place is None else place[above]))
        place = np.cumsum(keep) - 1
    return narrowed(Transducer(part.words, levels))


def paths(part: Transducer, depth: int) -> list[np.ndarray]:
    """Word numbers of every arc of a level and of the arcs it continues, first word first."""
    level = part.levels[depth]
    columns, above = [level.word], level.above
    for upper in reversed(part.levels[:depth]):
        columns.insert(0, upper.word[above])
        above = upper.above[above]
    return columns


def weights_of(part: Transducer, columns: list[np.ndarray]) -> np.ndarray:
    """Weights of phrases given by word numbers of ``part`` (-1: no word of it); 0 if not there."""
    at = np.zeros(len(columns[0]), np.int64)
    there = np.ones(len(at), bool)
    weight = np.zeros(len(at), np.int64)
    base = max(len(part.words), 1)
    for level, column in zip(part.levels, columns):
        arcs = level.above * base + level.word
        wanted = at * base + column
        place = np.minimum(np.searchsorted(arcs, wanted), max(len(arcs) - 1, 0))
        there &= (column >= 0) & (arcs[place] == wanted) if len(arcs) else False
        at = place
        weight = level.weight[place] if len(arcs) else weight
    return np.where(there, weight, 0)


def compose(wanted: Transducer, counts: Transducer) -> Transducer:
    """The paths of ``wanted``, its phrases weighed by ``counts``; passed arcs weigh 0."""
    number = {word: i for i, word in enumerate(counts.words)}
    mapped = np.fromiter((number.get(word, -1) for word in wanted.words), np.int64, len(wanted.words))
    levels = []
    for depth, level in enumerate(wanted.levels):
        columns = [mapped[column] for column in paths(wanted, depth)]
        weight = weights_of(counts, columns) if len(level) else level.weight
        levels.append(Level(level.word, np.where(level.weight > 0, weight, 0), level.above))
    return Transducer(wanted.words, levels)


def _register(level: Level, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal states of a level shared: (arc above, its state; arcs of the states that stay)."""
    first = np.flatnonzero(_heads(level.above))
    sizes = np.diff(np.append(first, len(level)))
    mixed = spread(
        spread(level.word.astype(np.uint64) + np.uint64(1))
        ^ spread(level.weight.astype(np.uint64) + (target + 2).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    )
    marks = np.add.reduceat(mixed, first)
    order = np.lexsort((marks, sizes))
    new = _heads(sizes[order], marks[order])
    model = np.empty(len(first), np.int64)
    model[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    # Equal marks may lie: compare every arc with that of the model, and let liars stay apart.
    arcs = _ranges(first[model], sizes)
    differs = (level.word != level.word[arcs]) | (level.weight != level.weight[arcs]) | (target != target[arcs])
    apart = np.add.reduceat(differs, first) > 0
    model = np.where(apart, np.arange(len(first)), model)
    stay, state = np.unique(model, return_inverse=True)
    return state, sizes[stay], _ranges(first[stay], sizes[stay])


def pack(part: Transducer) -> bytes:
    """The minimal automaton as bytes."""
    part = narrowed(part)
    arrays: list[np.ndarray] = []
    target = np.full(len(part.levels[-1]), -1, np.int64)
    for depth in reversed(range(len(part.levels))):
        level = part.levels[depth]
        sizes, arcs = np.zeros(0, np.int64), np.zeros(0, np.int64)
        state = np.zeros(0, np.int64)
        if len(level):
            state, sizes, arcs = _register(level, target)
        arrays += [sizes, level.word[arcs], level.weight[arcs], target[arcs]]
        if depth:
            target = np.full(len(part.levels[depth - 1]), -1, np.int64)
            if len(level):
                target[level.above[np.flatnonzero(_heads(level.above))]] = state
    words = b" ".join(part.words)
    narrow = [a.astype(np.int32) if not len(a) or a.max() < 2**31 else a for a in arrays]
    head = np.array([len(words)] + [len(a) * (1 if a.itemsize == 4 else -1) for a in narrow], np.int64)
    body = b"".join([np.int64(len(head)).tobytes(), head.tobytes(), words, *[a.tobytes() for a in narrow]])
    return zstandard.ZstdCompressor(level=3).compress(body)


def unpack(packed: bytes) -> Transducer:
    """What ``pack`` wrote, as a tree again."""
    body = zstandard.ZstdDecompressor().decompress(packed)
    head = np.frombuffer(body, np.int64, int(np.frombuffer(body, np.int64, 1)[0]), 8)
    at = 8 + head.nbytes
    text = body[at : at + int(head[0])]
    words = text.split(b" ") if text else []
    at += len(text)
    arrays = []
    for size in head[1:].tolist():
        kind = np.int32 if size >= 0 else np.int64
        arrays.append(np.frombuffer(body, kind, abs(size), at).astype(np.int64))
        at += arrays[-1].size * np.dtype(kind).itemsize
    levels: list[Level] = []
    target = np.zeros(1, np.int64)
    for depth in range(len(arrays) // 4):
        sizes, word, weight, leads = arrays[4 * (len(arrays) // 4 - 1 - depth) :][:4]
        known = np.flatnonzero(target >= 0) if len(sizes) else np.zeros(0, np.int64)
        states = target[known]
        starts = np.cumsum(sizes) - sizes
        arcs = _ranges(starts[states], sizes[states]) if len(states) else np.zeros(0, np.int64)
        above = np.repeat(known, sizes[states]) if len(states) else arcs
        levels.append(Level(word[arcs], weight[arcs], above))
        target = leads[arcs]
    return Transducer(words, levels)
