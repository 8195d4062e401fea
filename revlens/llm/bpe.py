"""BPE encoding and decoding by a tokenization automaton.

The merges are compiled once into a deterministic automaton over tokens that accepts exactly
the token sequences BPE produces. It starts as one state with a loop per symbol. The gadget
of merge number k, (u, v) to uv: the state p that arcs labelled u lead to gets a copy without
its v arc, u arcs lead to the copy from then on, and wherever u could be read, uv can now be
read too, leading where the v arc of p led. All arcs with one label lead to one state, and a
copy differs from its original in one arc, so the whole automaton is a table of arcs taken
away, with the number of the gadget that took each, and the parts of each merged token.

A word's encoding is the only path whose labels spell it. It is found by moving over the
word's symbols and keeping, for each prefix, the one token that may end it. Decoding walks
the ids and emits the arcs' labels.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from revlens.llm.common import map_arrow, release_memory, rows_of, slices_of, table

# Letters and numbers that Unicode 16 added to the 15.1 known to this Python, as
# the public tokenizer library splits by Unicode 16; and capitals of newer versions that it
# lower-cases, as (first, last, first small letter).
ADDED_LETTERS = """1C89-1C8A A7CB-A7CD A7DA-A7DC 105C0-105F3 10D4A-10D65 10D6F-10D85 10EC2-10EC4 11380-11389
1138B 1138E 11390-113B5 113B7 113D1 113D3 11BC0-11BE0 13460-143FA 16100-1611D 16D40-16D6C 18CFF 1E5D0-1E5ED 1E5F0"""
ADDED_NUMBERS = "10D40-10D49 116D0-116E3 11BF0-11BF9 16130-16139 16D70-16D79 1CCF0-1CCF9 1E5F1-1E5FA"
NEW_CAPITALS = [
    (0x1C89, 0x1C89, 0x1C8A),
    (0xA7CB, 0xA7CB, 0x0264),
    (0xA7CC, 0xA7CC, 0xA7CD),
    (0xA7CE, 0xA7CE, 0xA7CF),
    (0xA7D2, 0xA7D2, 0xA7D3),
    (0xA7D4, 0xA7D4, 0xA7D5),
    (0xA7DA, 0xA7DA, 0xA7DB),
    (0xA7DC, 0xA7DC, 0x019B),
    (0x10D50, 0x10D65, 0x10D70),
    (0x16EA0, 0x16EB8, 0x16EBB),
]

# Words kept in a worker's memo of encodings, and transitions in its table; both start anew when full.
MEMO_WORDS = 150_000
MEMO_STEPS = 300_000
LONGEST_MEMO = 64


def default_vocabulary() -> str:
    """Path of the public word-level BPE vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Automaton:
    """The tokenization automaton of a merge list.

    ``labels`` are the vocabulary's token strings by id; ``merges`` pairs of token strings in
    order of priority, each pair's parts known before it and no token merged twice.
    """

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]]):
        self.ids = vocabulary
        self.labels = {i: label for label, i in vocabulary.items()}
        # Per merged token its merge number and parts; per arc taken away the merge number.
        self.born: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.taken: dict[tuple[int, int], int] = {}
        for number, (u, v) in enumerate(merges):
            self._merge(number, vocabulary[u], vocabulary[v], vocabulary[u + v])
        # Every ending of a merged token; the token's id where the ending is a whole one.
        self.endings: dict[str, int] = {}
        for token in self.born:
            label = self.labels[token]
            self.endings[label] = token
            for start in range(1, len(label)):
                self.endings.setdefault(label[start:], -1)
        self.steps: dict[int, bool] = {}

    def _merge(self, number: int, u: int, v: int, uv: int) -> None:
        if self.allows(u, v):
            self.born[uv], self.parts[uv] = number, (u, v)
            self.taken[u, v] = number

    def allows(self, last: int, token: int) -> bool:
        """Whether the state that arcs labelled ``last`` lead to has an arc ``token``.

        That state lost one arc per gadget with left part ``last``; it began as the state of
        the right part of ``last`` at the time of its merge, and so on down. The arc itself
        was added where its left part stood, and so on down. So the arc is missing if, at a
        time before the copy was made, and no later than the longer arc was added, a gadget
        took it (in the same gadget only if both parts are one token: rrr is rr r, not r rr).
        """
        taken, born, parts = self.taken, self.born, self.parts
        never = len(born) + 10**9
        until = never
        while True:
            arc, added = token, never
            while True:
                number = taken.get((last, arc))
                if number is not None and number < until and number <= added:
                    return False
                if arc not in parts:
                    break
                added, arc = born[arc], parts[arc][0]
            if last not in parts:
                return True
            until, last = min(until, born[last]), parts[last][1]

    def _learn(self, key: int, last: int, token: int) -> bool:
        """``allows``, put into the table of transitions."""
        if len(self.steps) >= MEMO_STEPS:
            self.steps.clear()
        self.steps[key] = allowed = self.allows(last, token)
        return allowed

    def encode(self, symbols: list[str]) -> list[int]:
        """Token ids of one word, given as its symbols. Linear in the word's length.

        A symbol without a token is skipped, as the model has no unknown token.
        """
        ids, endings, steps = self.ids, self.endings, self.steps
        symbols = [s for s in symbols if s in ids]
        # Per prefix: its last token, and where that starts.
        lasts, starts = [-1], [0]
        for end in range(1, len(symbols) + 1):
            start = end - 1
            text = symbols[start]
            token = ids[text]
            while True:
                if token >= 0:
                    last = lasts[start]
                    if last < 0:
                        break
                    key = last << 32 | token
                    allowed = steps.get(key)
                    if allowed or (allowed is None and self._learn(key, last, token)):
                        break
                start -= 1
                text = symbols[start] + text
                token = endings[text]
            lasts.append(token)
            starts.append(start)
        out, end = [], len(symbols)
        while end:
            out.append(lasts[end])
            end = starts[end]
        return out[::-1]


def _ranges(text: str) -> list[range]:
    """Ranges of code points written as hexadecimal ``first-last`` or ``only``."""
    ends = [[int(x, 16) for x in item.split("-")] for item in text.split()]
    return [range(e[0], e[-1] + 1) for e in ends]


@lru_cache(1)
def _unknown_letters() -> str:
    """A character class of what the regex library takes for letters or numbers, but Unicode
    16 does not know."""
    import regex

    added = {c for r in _ranges(ADDED_LETTERS + " " + ADDED_NUMBERS) for c in r}
    everything = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    newer = [
        ord(c)
        for c in regex.findall(r"[\p{L}\p{N}]", everything)
        if unicodedata.category(c) == "Cn" and ord(c) not in added
    ]
    return "[" + "".join(f"\\U{c:08x}" for c in newer) + "]"


@lru_cache(1)
def byte_characters() -> tuple[str, ...]:
    """The printable stand-in of each byte: itself if printable Latin-1, else from U+0100 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    shown, spare = [], 256
    for byte in range(256):
        shown.append(chr(byte) if byte in own else chr(spare))
        spare += byte not in own
    return tuple(shown)


def _latin(text: str) -> bool:
    """Whether a text has Latin-1 characters only (a fast test)."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Codec:
    """Encoding and decoding of whole texts with one vocabulary file.

    Follows the file's pipeline: the two special tokens are taken out of the raw text, the
    rest is composed (NFC), its blanks made spaces, lower-cased character by character, and
    split by the file's pattern; each piece's bytes, the last with the word end, are encoded.
    """

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.automaton = Automaton(model["vocab"], [tuple(m) for m in model["merges"]])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels = dict(self.automaton.labels) | {i: s for s, i in self.special.items()}
        size = max(self.labels) + 1
        self.label_list = [self.labels.get(i, "") for i in range(size)]
        self.specials = regex.compile("|".join(map(regex.escape, self.special)))
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.split = regex.compile(split).findall
        # The same pattern where letters unknown to Unicode 16 are neither letters nor numbers.
        unknown = _unknown_letters()
        careful = split.replace(r"[^\s\p{L}\p{N}]+", rf"(?:{unknown}|[^\s\p{{L}}\p{{N}}])+")
        careful = careful.replace(r"[\p{L}]+", rf"(?:(?!{unknown})\p{{L}})+")
        self.careful_split = regex.compile(careful.replace(r"[\p{N}]", rf"(?!{unknown})\p{{N}}")).findall
        self.has_unknown = regex.compile(unknown).search
        self.capitals = {
            c: small + c - first for first, last, small in NEW_CAPITALS for c in range(first, last + 1)
        }
        self.has_capital = regex.compile("[" + "".join(map(chr, self.capitals)) + "]").search
        self.blanks = regex.compile(r"\s+").sub
        self.shown = dict(enumerate(byte_characters()))
        self.memo: dict[str, bytes] = {}

    def normalize(self, text: str) -> str:
        """NFC, then every run of blanks one space, then lower case."""
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            # Lower-casing one character at a time knows no final sigma.
            text = text.replace("Σ", "σ")
            if not _latin(text) and self.has_capital(text):
                text = text.translate(self.capitals)
        return self.blanks(" ", text).lower()

    def pieces(self, text: str) -> list[str]:
        """A normalized text cut by the file's pattern."""
        if _latin(text) or not self.has_unknown(text):
            return self.split(text)
        return self.careful_split(text)

    def piece(self, piece: str) -> bytes:
        """Ids of one piece as little-endian 32-bit integers."""
        data = piece.encode("utf-8", "surrogatepass")
        symbols = list(data.decode("latin-1").translate(self.shown))
        symbols[-1] += self.end
        ids = self.automaton.encode(symbols)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _learn(self, pieces: list[str]) -> list[bytes]:
        """Encodings of pieces, through the memo."""
        memo, out = self.memo, []
        for piece in pieces:
            code = memo.get(piece)
            if code is None:
                code = self.piece(piece)
                if len(piece) <= LONGEST_MEMO:
                    if len(memo) >= MEMO_WORDS:
                        memo.clear()
                    memo[piece] = code
            out.append(code)
        return out

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian 32-bit integers."""
        text = text or ""
        if "<|" not in text:
            return b"".join(self._learn(self.pieces(self.normalize(text))))
        out, at = [], 0
        for match in self.specials.finditer(text):
            out += self._learn(self.pieces(self.normalize(text[at : match.start()])))
            out.append(np.array([self.special[match[0]]], "<u4").tobytes())
            at = match.end()
        out += self._learn(self.pieces(self.normalize(text[at:])))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The labels of the ids' arcs, parted by spaces (the file names no decoder)."""
        return " ".join(map(self.label_list.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def count(self, text: str | None) -> int:
        """Number of tokens of a whole text."""
        return len(self.encode(text)) // 4


@lru_cache(2)
def codec(path: str) -> Codec:
    """One codec per worker process and vocabulary."""
    return Codec(path)


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs`` with the column ids (binary, little-endian 32-bit); a column ids is replaced.

    A null text is encoded as the empty one, which has no ids. Every row is encoded on its
    own, so repeated rows agree; an empty table gives no rows. Rows are encoded where they
    lie, a few texts at a time; only the memo of frequent words stays in memory.
    """
    path, fields = path or default_vocabulary(), [f for f in docs.schema.fields if f.name != "ids"]
    names = [f.name for f in fields]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(path)
        for batch in rows_of(batches):
            ids = [code.encode(text) for text in batch.column(names.index("text")).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(ids, pa.binary())], [*names, "ids"]
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return map_arrow(docs.select(*names), encode, f"{schema}, ids binary")


def decode_documents(encoded: DataFrame, path: str | None = None, keep: bool = False) -> DataFrame:
    """(doc_id, ids) to (doc_id, decoded): the exact text of the labels; null ids give ''.

    With ``keep`` all columns stay beside the new one (a column decoded is replaced).
    """
    path = path or default_vocabulary()
    fields = [f for f in encoded.schema.fields if f.name != "decoded" and (keep or f.name in ("doc_id", "ids"))]
    names = [f.name for f in fields]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(path)
        for batch in rows_of(batches):
            texts = [code.decode(ids or b"") for ids in batch.column(names.index("ids")).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], [*names, "decoded"]
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    decoded = map_arrow(encoded.select(*names), decode, f"{schema}, decoded string")
    return decoded if keep else decoded.select("doc_id", "decoded")


def encode_and_decode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs`` without text, with n_tokens, ids and decoded_sha256 (of the ids' decoding).

    As ``encode_documents`` and ``decode_documents`` one after the other, but a task has one
    Python worker for both, a megabyte of texts at a time, and decoded texts stay in it.
    """
    path, fields = path or default_vocabulary(), docs.schema.fields
    at = [f.name for f in fields].index("text")
    told = [("n_tokens", T.LongType()), ("ids", T.BinaryType()), ("decoded_sha256", T.StringType())]
    schema = T.StructType([*fields[:at], *fields[at + 1 :], *[T.StructField(*x) for x in told]])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(path)
        for batch in slices_of(batches, lambda b: b.column(at), size=1_000_000):
            counts, ids, decoded = [], [], []
            for text in batch.column(at).to_pylist():
                ids.append(code.encode(text))
                counts.append(len(ids[-1]) // 4)
                decoded.append(hashlib.sha256(code.decode(ids[-1]).encode()).hexdigest())
            kept = [c for i, c in enumerate(batch.columns) if i != at]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(counts, pa.int64()), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())], schema.names
            )
        release_memory()

    return map_arrow(docs, encode, schema)


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) per document, encoded and then decoded.

    Both directions run in one pass, so ids and decoded texts need not leave the task.
    """
    path = path or default_vocabulary()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(path)
        for batch in rows_of(batches):
            counts, ids, decoded = [], [], []
            for text in batch.column(1).to_pylist():
                codes = code.encode(text)
                counts.append(len(codes) // 4)
                ids.append(hashlib.sha256(codes).hexdigest())
                decoded.append(hashlib.sha256(code.decode(codes).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids), pa.array(decoded)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_arrow(docs.select("doc_id", "text"), digest, schema)


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``round_trip`` over all documents."""
    return round_trip(table(spark, sf_dir, "documents"))
