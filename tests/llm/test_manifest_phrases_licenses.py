"""Merkle manifest, phrase mining and license scan against plain versions."""

import bisect
import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from revlens.llm import collocations, licenses, manifest
from revlens.llm import transducers as tr

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, uid string, number int"


@pytest.fixture
def full_docs(spark):
    """Rows (doc_id, source, lang, n_chars, text) beside columns with clashing names."""
    return lambda rows: spark.createDataFrame([(*r, "x", None, 1) for r in rows], SCHEMA)


def ordered(rows):
    return sorted(map(str, rows))


# --- manifest ---------------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_levels(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def plain_climb(levels, pos, folded):
    beside = ""
    for level in levels[:-1]:
        run = level[pos // 8 * 8 :][:8]
        others = [d for i, d in enumerate(run) if i != pos % 8]
        folded = sha("".join(folded if i == pos % 8 else d for i, d in enumerate(run)))
        beside, pos = beside + "".join(others), pos // 8
    return beside, folded


def plain_manifest(rows):
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row[2], []).append(row)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in langs:
        by_lang[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees.append(plain_levels([plain_leaf(r) for r in by_lang[lang]]))
    crown = plain_levels([t[-1][0] for t in trees])
    out = []
    for i, lang in enumerate(langs):
        for pos, row in enumerate(by_lang[lang]):
            folded = plain_leaf(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None:
                low = re.sub("[A-Z]", lambda m: m[0].lower(), row[4])
                folded = plain_leaf((*row[:4], low))
            proof, folded = plain_climb(trees[i], pos, folded)
            above, folded = plain_climb(crown, i, folded)
            out.append((row[0], plain_leaf(row), trees[i][-1][0], crown[-1][0], sha(proof + above), folded, folded == crown[-1][0]))
    return out


def manifest_of(df):
    low = manifest.lower_ascii(F.col("text"))
    return manifest.manifest(df, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, low)


@pytest.mark.parametrize(
    "rows",
    [
        # Languages of 1, 8, 9, 65 and more leaves; a null and an empty language; many languages.
        [(i, None if i % 5 else "S", f"l{i % 7}" if i % 3 else "big", i, f"Text {i} É") for i in range(250)]
        + [(None, None, None, None, None), (7, "", "", 0, ""), (8, "s", "", 1, "A" * 30_000)],
        [(i, "s", f"lang {i}", 1, "T") for i in range(70)],
        [(5, "s", "en", 3, "One")],
        [(i, "s", "en", 3, "One") for i in range(9)],
    ],
)
def test_manifest_matches_plain(full_docs, rows):
    assert ordered(manifest_of(full_docs(rows).repartition(3)).collect()) == ordered(
        [manifest_row(r) for r in plain_manifest(rows)]
    )


def manifest_row(values):
    from pyspark.sql import Row

    names = "doc_id leaf subroot root proof_sha256 folded_root verified".split()
    return Row(**dict(zip(names, values)))


def test_manifest_of_equal_rows_and_hot_null_ids(full_docs):
    """Equal rows are leaves of their own, and null ids keep no common order but their hashes."""
    rows = [(None, "s", "en", 1, "Same")] * 40 + [(3, "s", "en", 1, "Same")] * 40
    assert ordered(manifest_of(full_docs(rows)).collect()) == ordered(map(manifest_row, plain_manifest(rows)))
    assert manifest_of(full_docs(rows).limit(0)).count() == 0


def test_stretches_part_the_leaves_of_hot_nodes(full_docs, monkeypatch):
    monkeypatch.setattr(manifest, "STRETCHES", 3)
    monkeypatch.setattr(manifest, "STRETCH", 1)
    rows = [(i, "s", f"l{i % 2}", 1, f"T{i}") for i in range(100)]
    assert ordered(manifest_of(full_docs(rows)).collect()) == ordered(map(manifest_row, plain_manifest(rows)))


# --- automata ---------------------------------------------------------------------------


def phrases_of(part):
    found = {}
    for depth, level in enumerate(part.levels):
        columns = [c.tolist() for c in tr.paths(part, depth)]
        for row, weight in zip(zip(*columns), level.weight.tolist()):
            if weight:
                found[tuple(part.words[i] for i in row)] = weight
    return found


def test_automata_keep_all_counts():
    draw = random.Random(3)
    for _ in range(120):
        words = [b"w%d" % i for i in range(draw.choice([2, 3, 9, 40]))]
        shards = [[draw.choice([b"\xff", *words]) for _ in range(draw.randint(0, 90))] for _ in range(3)]
        want = Counter()
        for tokens in shards:
            for size in (1, 2, 3):
                want.update(
                    t for i in range(len(tokens) - size + 1) if b"\xff" not in (t := tuple(tokens[i : i + size]))
                )
        parts = [tr.unpack(tr.pack(p)) if len(p := tr.count_windows(t, b"\xff", 3, len(t))) else p for t in shards]
        whole = tr.union(parts)
        assert phrases_of(whole) == want
        bounds = sorted({tuple(draw.choice([*words, b"a", b"z"]) for _ in range(draw.randint(1, 3))) for _ in range(4)})
        ranges = [{} for _ in range(len(bounds) + 1)]
        for phrase, n in want.items():
            ranges[bisect.bisect_right(bounds, phrase)][phrase] = n
        for piece, expected in zip(tr.cut(whole, bounds), ranges):
            assert ({} if piece is None else phrases_of(tr.unpack(tr.pack(piece)))) == expected
        assert phrases_of(tr.pruned(whole, 3)) == {p: n for p, n in want.items() if n >= 3}


def test_equal_states_are_shared():
    tokens = b" \xff ".join(b"a%d same tail" % i for i in range(500)).split()
    part = tr.count_windows(tokens, b"\xff", 3, len(tokens))
    level = part.levels[1]
    states, sizes, _ = tr._register(level, level.word * 0 - 1)
    assert len(states) == 501 and len(sizes) == 2


# --- phrases ----------------------------------------------------------------------------


def plain_collocations(rows, longest, least, top, share):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    key = lang, tuple(words[i : i + size])
                    counts[key] = counts.get(key, 0) + 1
    found = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    inside = {
        (lang, p[i:j])
        for (lang, p), a in found.items()
        for i in range(len(p))
        for j in range(i + 2, len(p) + 1)
        if j - i < len(p) and 100 * a >= share * counts[lang, p[i:j]]
    }
    out = []
    for lang in totals:
        scored = []
        for (own, p), a in found.items():
            if own == lang and (lang, p) not in inside:
                cuts = [(counts[lang, p[:k]], counts[lang, p[k:]], k) for k in range(1, len(p))]
                score, _, l, r = min((10**6 * a * a // (l * r), k, l, r) for l, r, k in cuts)
                scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return out


@pytest.mark.parametrize("longest, least, top, share", [(3, 4, 2000, 50), (4, 3, 25, 80), (2, 2, 5, 50)])
def test_collocations_match_plain(docs, monkeypatch, longest, least, top, share):
    draw = random.Random(5)
    words = ["The", "the", "of", "new", "york", "été", "\x1f", "ß", *[f"w{i}" for i in range(25)]]
    weights = [30, 20, 10, 8, 8, 4, 2, 2, *[2] * 25]

    def text():
        return "".join(
            w + draw.choices([" ", "\t ", ". ", ",", "\n", "\x0b", "  "], [30, 2, 2, 1, 1, 1, 3])[0]
            for w in draw.choices(words, weights, k=draw.randint(0, 60))
        )

    rows = [(i, text(), draw.choice(["en", "en", "de", None, "und", ""])) for i in range(150)]
    rows += [(None, None, "en"), (3, "", None), (4, " \t.,", "de")] + [(9, "new york the new york", "en")] * 30
    rows.append((10, " ".join(draw.choices(words, weights, k=5000)), "en"))
    # Small segments, so that phrases run across them.
    monkeypatch.setattr(collocations, "SEGMENT", 300)
    monkeypatch.setattr(collocations, "ARCS", 500)
    got = collocations.collocations(docs(*rows), longest, least, top, share)
    assert ordered(map(tuple, got.collect())) == ordered(
        plain_collocations([(lang, text) for _, text, lang in rows], longest, least, top, share)
    )


def test_collocations_of_nothing(docs):
    assert collocations.collocations(docs((1, "a b", "en")).limit(0)).count() == 0
    assert collocations.collocations(docs((1, "a b", "en"), (2, None, None))).count() == 0


# --- licenses ---------------------------------------------------------------------------


def plain_licenses(rows, templates, share):
    step = max(len(text.split()) for _, text in templates)
    out = []
    for doc_id, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
        base = []
        for phrase, label in licenses.PHRASES.items():
            p = phrase.split()
            base += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
        labels, best = {label for _, label in base}, 1.0 if base else 0.0
        base_labels = ",".join(sorted(labels))
        for start in range(0, len(words), step):
            block = set(words[start : start + 2 * step])
            for label, template in templates:
                wanted = set(template.split())
                if len(block & wanted) >= share * len(wanted) - 1e-9:
                    labels.add(label)
                    best = max(best, len(block & wanted) / len(wanted))
        places = sorted(i for i, _ in base)
        out.append(
            (doc_id, len(words), len(base), places[0] if base else None, places[-1] if base else None, base_labels, ",".join(sorted(labels)), best)
        )
    return out


def test_licenses_match_plain(docs):
    draw = random.Random(9)
    common = "the of a is license software free work under this permission 2 0".split()
    rows = []
    for i in range(120):
        words = draw.choices([*common, *[f"w{k}" for k in range(30)]], k=draw.randint(0, 150))
        for _ in range(draw.randint(0, 3)):
            _, template = draw.choice(licenses.TEMPLATES)
            notice = template.split()
            for _ in range(draw.randint(0, 4)):
                notice[draw.randrange(len(notice))] = draw.choice(common)
            at = draw.randint(0, len(words))
            words[at:at] = notice
        rows.append((i, draw.choice([" ", "\n", "--", ", "]).join(words).title()))
    rows += [(None, "CC-BY cc_by ccby CC BY"), (500, None), (501, ""), (502, "--"), (503, "mit license"), (503, "mit license")]
    rows += [(504, "MIT License apache license É " * 3000), (505, "gnu general public licenses cc by4")]
    got = licenses.scan_licenses(docs(*rows))
    want = plain_licenses(rows, licenses.TEMPLATES, licenses.CONTAINMENT)
    assert ordered(map(tuple, got.collect())) == ordered(want)
    assert sum(r[6] != r[5] for r in want) > 20
    assert licenses.scan_licenses(docs(*rows).limit(0)).count() == 0


def test_licenses_with_other_templates_and_share(docs):
    templates = [("house", "all rights reserved by the house of letters"), ("tiny", "no license")]
    rows = [(1, "All rights reserved by the house."), (2, "license: no"), (3, "the house of letters"), (4, "rights")]
    got = licenses.scan_licenses(docs(*rows), templates, 0.75)
    assert ordered(map(tuple, got.collect())) == ordered(plain_licenses(rows, templates, 0.75))
    assert {r["doc_id"]: r["labels"] for r in got.collect()} == {1: "house", 2: "tiny", 3: "", 4: ""}


def test_license_scan_runs_no_python(docs):
    plan = licenses.scan_licenses(docs((1, "mit license")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
