"""Token counts by heap-and-linked-list byte-pair merging; no token ids are made.

A pre-token starts as one symbol for each byte, in a doubly linked list.  A
heap holds every adjacent pair that some merge joins, keyed by (rank,
position); the lowest is popped, the two symbols become one and the two new
neighbour pairs are pushed.  The count is the initial symbols less the merges.
The work on a pre-token of n bytes is O(n log n), so one endless "word" is
fine.  Special strings in a text count as one token each, the library's default.

Rows: a null or empty text has 0 bytes and 0 tokens; repeated rows are counted
each; columns other than the id and the text are not read.
"""

from __future__ import annotations

from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arlark.llm.common import byte_length
from arlark.llm.vocabulary import (ByteVocabulary, PieceCache, broadcast_vocabulary, ordinary_parts, trim, units,
                                   worker_state)


def count_symbols(symbols: list[int], merge: dict[int, int]) -> int:
    """Symbols left after merging ``symbols`` (ranks) by ``merge`` ((left << 24 | right) -> new rank)."""
    n = len(symbols)
    find = merge.get
    heap = []
    for i in range(n - 1):
        new = find(symbols[i] << 24 | symbols[i + 1])
        if new is not None:
            heap.append(new << 40 | i)
    if not heap:
        return n
    heapify(heap)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    mask, left_over = (1 << 40) - 1, n
    while heap:
        entry = heappop(heap)
        new, i = entry >> 40, entry & mask
        j = after[i]
        # an entry is stale when either symbol was merged away or has changed since it was pushed
        if j >= n or symbols[i] < 0 or find(symbols[i] << 24 | symbols[j]) != new:
            continue
        symbols[i], symbols[j] = new, -1
        k = after[i] = after[j]
        left_over -= 1
        if k < n:
            before[k] = i
            joined = find(new << 24 | symbols[k])
            if joined is not None:
                heappush(heap, joined << 40 | i)
        h = before[i]
        if h >= 0:
            joined = find(symbols[h] << 24 | new)
            if joined is not None:
                heappush(heap, joined << 40 | h)
    return left_over


class TokenCounter:
    def __init__(self, compressed: bytes):
        self.vocabulary = ByteVocabulary(compressed)
        self.by_piece = PieceCache(self._piece)
        self.by_word = PieceCache(self._word)
        self.by_head = PieceCache(self._head)

    def _piece(self, piece: str) -> int:
        return count_symbols(list(piece.encode()), self.vocabulary.merge)

    def _head(self, unit: str) -> int:
        return sum(map(self.by_piece.__getitem__, self.vocabulary.pieces(unit)))

    def _word(self, word: str) -> int:
        return self._head(" " + word)

    def count(self, text: str) -> int:
        total = 0
        for special, part in ordinary_parts(self.vocabulary, text):
            if special:
                total += 1
                continue
            lines = 0
            for head, words in units(part):
                total += self.by_head[head] + sum(map(self.by_word.__getitem__, words))
                lines += 1
            total += (lines - 1) * self.by_head["\n"]
        return total


def token_counts(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 1024) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for every row of ``docs``; one narrow pass, no shuffle."""
    shared = broadcast_vocabulary(docs.sparkSession, vocabulary_path)
    source = docs.select(F.col(id_col).alias("id"), byte_length(F.col(text_col)).alias("n_bytes"),
                         F.col(text_col).alias("text"))

    def run(batches):
        counter = worker_state("token counts", shared.value, TokenCounter)
        for batch in batches:
            counts = [counter.count(t) if t else 0 for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                                             names=["id", "n_bytes", "n_tokens"])
        trim(counter.by_piece, counter.by_word, counter.by_head)

    id_type = source.schema["id"].dataType.simpleString()
    out = source.mapInArrow(run, f"id {id_type}, n_bytes long, n_tokens long")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
