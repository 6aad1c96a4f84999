"""Byte-level BPE vocabulary shared by the counting and the coding operator: file, byte alphabet, pre-tokens.

The vocabulary file (``tokenizers`` JSON) is read on the driver from a path
that is a parameter, checked against ``MAX_VOCABULARY_BYTES`` and broadcast,
so executors need no copy of it.
"""

from __future__ import annotations

import json
import re
import zlib

import regex
from pyspark.sql import SparkSession

#: A vocabulary file is broadcast only up to this size.
MAX_VOCABULARY_BYTES = 64 << 20

#: Fixed value: the published split pattern of the byte-level vocabulary.
PIECES = regex.compile(
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")

#: Code points whose letter, number and space classes are the same in every Unicode version in use.
#: Text with any other code point is split by the tokenizers library itself.
SETTLED = re.compile("[^\u0000-ԯ‐-‧₠-₿぀-ゖァ-ヺ一-龥가-힣]")

#: A line break before a visible character ends a piece; so does a space before one.
LINE_CUT = re.compile(r"\n(?=\S)")
UNIT_CUT = re.compile(r" (?=\S)")


def vocabulary_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        data = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY_BYTES} bytes")
    return data


def broadcast_vocabulary(spark: SparkSession, path: str):
    return spark.sparkContext.broadcast(zlib.compress(vocabulary_bytes(path)))


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself if visible Latin-1, else the next from U+0100."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table, spare = {}, 0x100
    for b in range(256):
        if b in visible:
            table[b] = chr(b)
        else:
            table[b], spare = chr(spare), spare + 1
    return [table[b] for b in range(256)]


class ByteVocabulary:
    """Ids, merges and special tokens of a byte-level BPE file, with its pre-tokenization.

    Tokens are renumbered by rank: single bytes first, then one number for
    each merge in order, which is what both operators compare.
    """

    def __init__(self, compressed: bytes):
        from tokenizers import Tokenizer

        data = zlib.decompress(compressed)
        spec = json.loads(data)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec["normalizer"]:
            raise ValueError("a byte-level BPE vocabulary without normalizer and prefix space is needed")
        self.library = Tokenizer.from_str(data.decode())
        self.alphabet = byte_alphabet()
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = (re.compile("(" + "|".join(sorted(map(re.escape, self.specials), key=len, reverse=True)) + ")")
                              if self.specials else None)
        vocab = model["vocab"]
        self.rank_of = {c: b for b, c in enumerate(self.alphabet)}
        self.strings = list(self.alphabet)
        self.parts: list[tuple[int, int]] = [(b, b) for b in range(256)]
        self.merge: dict[int, int] = {}
        for left, right in (m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            a, b, new = self.rank_of[left], self.rank_of[right], len(self.strings)
            if left + right in self.rank_of:
                raise ValueError("two merges build the same token")
            self.merge[a << 24 | b] = new
            self.rank_of[left + right] = new
            self.strings.append(left + right)
            self.parts.append((a, b))
        self.ids = [vocab[s] for s in self.strings]
        self.byte_of = {c: b for b, c in enumerate(self.alphabet)}

    def bytes_of(self, string: str) -> bytes:
        return bytes(map(self.byte_of.__getitem__, string))

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens of a text without special tokens."""
        letters = text[1:].rstrip(",.;:!?")
        if text[:1] == " " and letters.isalpha() and not SETTLED.search(text):
            # the common unit: a space and a word, with or without marks at its end
            return [text] if len(letters) + 1 == len(text) else [text[:len(letters) + 1], text[len(letters) + 1:]]
        if SETTLED.search(text):
            return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]
        return PIECES.findall(text)


class PieceCache(dict):
    """``unit -> value``, computed once while it stays in use.

    Holds two generations of at most ``limit`` units: when the young one is
    full it becomes the old one, and units asked for again move back, so
    frequent units survive and memory is bounded.  Units longer than
    ``longest`` are not kept.
    """

    def __init__(self, compute, limit: int = 200_000, longest: int = 64):
        super().__init__()
        self.compute, self.limit, self.longest, self.old = compute, limit, longest, {}

    def __missing__(self, unit):
        value = self.old.get(unit)
        if value is None:
            value = self.compute(unit)
            if len(unit) > self.longest:
                return value
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[unit] = value
        return value


#: What the operator that runs in this Python worker keeps between tasks; one operator's state at a time.
_kept: dict[tuple, object] = {}


def worker_state(kind: str, source: object, build):
    """The state ``build(source)`` of this worker, built once; the state of any other operator is let go."""
    key = (kind, source if source is None else hash(source))
    if key not in _kept:
        _kept.clear()
        _kept[key] = build(source) if source is not None else build()
    return _kept[key]


def trim(*caches: PieceCache) -> None:
    """At a task's end: an idle worker keeps the young generations only."""
    for cache in caches:
        cache.old = {}


def ordinary_parts(vocabulary: ByteVocabulary, text: str):
    """(is_special, part) runs of a text; special strings match as the library's default does."""
    if vocabulary.special_split is None or not vocabulary.special_split.search(text):
        yield False, text
        return
    for part in vocabulary.special_split.split(text):
        if part:
            yield part in vocabulary.specials, part


def units(text: str):
    """Whole pre-token runs of one ordinary text, as (head, [words that follow a space]) for each line.

    Cutting a text before `` x`` or ``\\n x`` (x visible) never cuts a
    pre-token, so units can be counted or coded on their own and cached.
    """
    for line in LINE_CUT.split(text):
        head, *words = UNIT_CUT.split(line)
        yield head, words
