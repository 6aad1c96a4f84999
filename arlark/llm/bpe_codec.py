"""BPE encoding by dynamic programming over prefixes, and decoding, with exact library ids.

For every prefix of a pre-token exactly one token can be the last one of its
encoding.  An Aho-Corasick automaton over the vocabulary gives the tokens that
end at a position (suffix matches, longest first); a candidate t of length m
is that last token if the prefix without its last m symbols is empty or has
last token s and the pair (s, t) is compatible: merging s and t's symbols
together would give back s, t.  Only one back-pointer is kept per prefix; following them
from the end emits the ids.  A pair test undoes merges along the touching ends
only, so it is O(depth of the two merge trees).

Rows: null and empty texts have no ids and decode to the empty text; repeated
rows are coded each; columns other than the id and the text are not read.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arlark.llm.token_count import count_symbols
from arlark.llm.vocabulary import (ByteVocabulary, PieceCache, broadcast_vocabulary, ordinary_parts, trim, units,
                                   worker_state)


class BpeCodec:
    """Encoder and decoder of one vocabulary; ids travel as little-endian unsigned 32-bit bytes."""

    def __init__(self, compressed: bytes):
        v = self.vocabulary = ByteVocabulary(compressed)
        self.length = [len(s) for s in v.strings]
        self.automaton = ahocorasick.Automaton()
        byte_of = v.byte_of
        for rank, string in enumerate(v.strings):
            # tokens that merging never yields from their own bytes cannot occur in an encoding
            if rank < 256 or count_symbols([byte_of[c] for c in string], v.merge) == 1:
                self.automaton.add_word(string, rank)
        self.automaton.make_automaton()
        self.compatible_pairs = PieceCache(self._compatible, longest=2)
        self.symbol = str.maketrans({chr(b): c for b, c in enumerate(v.alphabet)})
        self.id_bytes = [i.to_bytes(4, "little") for i in v.ids]
        self.token_bytes = {i: v.bytes_of(s) for s, i in zip(v.strings, v.ids)}
        self.token_bytes.update({i: s.encode() for s, i in v.specials.items()})
        self.by_piece = PieceCache(self._piece)
        self.by_word = PieceCache(self._word)
        self.by_head = PieceCache(self._head)

    def _compatible(self, pair: tuple[int, int]) -> bool:
        """Whether the symbols of ``left`` followed by those of ``right`` encode as exactly these two tokens.

        The two merge trees are undone from the later merge to the earlier.  A
        merge across the border that comes before the one just undone would
        have fired first and destroyed the pair.
        """
        left, right = pair
        merge, parts = self.vocabulary.merge, self.vocabulary.parts
        # border merges up to ``ceiling`` would have run while both present ends existed
        ceiling = len(parts)
        while True:
            across = merge.get(left << 24 | right)
            if across is not None and across < ceiling:
                return False
            if left < 256 and right < 256:
                return True
            # of equal ranks the left one is merged first, so the right one is undone first
            if left > right:
                ceiling = left
                left = parts[left][1]
            else:
                ceiling = right + 1
                right = parts[right][0]

    def _piece(self, piece: str) -> bytes:
        symbols = piece.encode().decode("latin-1").translate(self.symbol)
        n = len(symbols)
        last = [-1] * (n + 1)
        ok, length = self.compatible_pairs, self.length
        for end, token in self.automaton.iter(symbols):
            end += 1
            if last[end] >= 0:
                continue
            start = end - length[token]
            if start == 0 or ok[last[start], token]:
                last[end] = token
        out, end = [], n
        while end:
            token = last[end]
            out.append(self.id_bytes[token])
            end -= length[token]
        out.reverse()
        return b"".join(out)

    def _head(self, unit: str) -> bytes:
        return b"".join(map(self.by_piece.__getitem__, self.vocabulary.pieces(unit)))

    def _word(self, word: str) -> bytes:
        return self._head(" " + word)

    def encode(self, text: str) -> bytes:
        out = []
        for special, part in ordinary_parts(self.vocabulary, text):
            if special:
                out.append(self.vocabulary.specials[part].to_bytes(4, "little"))
                continue
            for i, (head, words) in enumerate(units(part)):
                if i:
                    out.append(self.by_head["\n"])
                out.append(self.by_head[head])
                out.extend(map(self.by_word.__getitem__, words))
        return b"".join(out)

    def rest(self) -> None:
        """Lets go of what an idle worker need not hold."""
        trim(self.by_piece, self.by_word, self.by_head, self.compatible_pairs)

    def decode(self, ids: bytes) -> str:
        """The text of ids; special tokens give their strings, ill-formed bytes U+FFFD."""
        return b"".join(map(self.token_bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def encode_documents(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids) for every row: ``ids`` is binary, little-endian unsigned 32-bit; one narrow pass."""
    shared = broadcast_vocabulary(docs.sparkSession, vocabulary_path)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        codec = worker_state("bpe codec", shared.value, BpeCodec)
        for batch in batches:
            ids = [codec.encode(t) if t else b"" for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(ids, pa.binary())], names=["id", "ids"])
        codec.rest()

    id_type = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {id_type}, ids binary").withColumnRenamed("id", id_col)


def decode_documents(encoded: DataFrame, vocabulary_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of encoded rows; one narrow pass.  Null ids give the empty text."""
    shared = broadcast_vocabulary(encoded.sparkSession, vocabulary_path)
    source = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))

    def run(batches):
        codec = worker_state("bpe codec", shared.value, BpeCodec)
        for batch in batches:
            texts = [codec.decode(i) if i else "" for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], names=["id", "text"])

    id_type = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {id_type}, text string").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): encode and decode in the same pass, so no ids are shuffled."""
    shared = broadcast_vocabulary(docs.sparkSession, vocabulary_path)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        codec = worker_state("bpe codec", shared.value, BpeCodec)
        for batch in batches:
            counts, digests, decoded = [], [], []
            for text in batch.column("text").to_pylist():
                ids = codec.encode(text) if text else b""
                counts.append(len(ids) // 4)
                digests.append(hashlib.sha256(ids).hexdigest())
                decoded.append(hashlib.sha256(codec.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])
        codec.rest()

    id_type = source.schema["id"].dataType.simpleString()
    out = source.mapInArrow(run, f"id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)
