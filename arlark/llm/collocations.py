"""Phrase collocation mining by stripes.

A stripe is a first word (in a language) with an associative counter of what follows it: the next
``longest - 1`` words of its piece, filled up with an end mark.  Tasks count stripes of
chunks of text, stripes of one key are merged elementwise after the shuffle, and one merged stripe
yields everything about its prefixes: the count of each extension, of each prefix (the total
of what starts with it, end marks included) and the largest count among a prefix's extensions, which is
what subsumption needs on the right side.  The left side is the largest count among the phrases that
end in a phrase.  Cuts of a candidate look the counts of their two parts up in the table of frequent phrases:
a part of a frequent phrase is itself frequent.

A hot first word's stripe is cut into parts by hash of the words that follow, further where these are hot too, so a
part holds at most about ``1 / (4 tasks)`` of all words; prefix counts of such stripes are partial and are added up.  Which words are hot
comes from an exact bound: a word with that share of all words has a quarter of it in
some chunk, so chunks send only such words.

Rows: null or empty texts hold no words; a null language is ``und``; rows repeat as often as they come; the id is
not read; an empty table gives an empty result; other columns are not read.  Counts may reach
10^15 - 1 (scores are computed in 38-digit decimals); beyond, the job fails.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arlark.llm.common import byte_length, staged

#: Bytes that end a piece, and the byte for a piece's end inside tasks; words hold neither it nor a space.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
END = b"\n"
LEAST_COUNT, LONGEST, TOP, COVER_PERCENT = 10, 3, 2000, 50
#: Text counted together, entries merged together, text for each task after the shuffle.
CHUNK_BYTES, MERGED_ENTRIES, TASK_BYTES = 4 << 20, 400_000, 32 << 20

_CLEAN = bytearray(range(256))
for _c in PIECE_ENDS:
    _CLEAN[_c] = END[0]
_CLEAN[ord("\t")] = ord(" ")
for _c in range(ord("A"), ord("Z") + 1):
    _CLEAN[_c] = _c + 32
_CLEAN = bytes(_CLEAN)


class Vocabulary(dict):
    """Numbers of words as they come; 0 is the empty token, 1 the end mark."""

    def __init__(self):
        super().__init__({b"": 0, END: 1})

    def __missing__(self, word: bytes) -> int:
        self[word] = len(self)
        return self[word]

    def numbers(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))


def segments(text: bytes):
    """Parts of at most about ``CHUNK_BYTES`` of a cleaned text, cut after a space or an end mark."""
    at = 0
    while len(text) - at > CHUNK_BYTES:
        cut = max(text.rfind(b" ", at, at + CHUNK_BYTES), text.rfind(END, at, at + CHUNK_BYTES))
        if cut < 0:         # one word longer than a part
            ends = [c for c in (text.find(b" ", at), text.find(END, at)) if c >= 0]
            cut = min(ends, default=len(text) - 1)
        yield text[at:cut + 1]
        at = cut + 1
    yield text[at:]


def tokens_of(cleaned: bytes, longest: int) -> list[bytes]:
    """Words and end marks, ``longest - 1`` for each end of a piece; empty tokens between."""
    return cleaned.replace(END, (b" " + END) * (longest - 1) + b" ").split(b" ")


def distinct_windows(columns: list[np.ndarray], counts: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Equal rows of the columns (numbers from 0) merged, their counts (one each by default) added, in sorted order."""
    if not len(columns[0]):
        return columns, np.zeros(0, np.int64)
    radices = [int(c.max()) + 1 for c in columns]
    if math.prod(radices) >= 1 << 63:       # too many numbers for one sort key
        order = np.lexsort(columns[::-1])
        columns = [c[order] for c in columns]
        new = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
        at = np.flatnonzero(np.append(True, new))
        return [c[at] for c in columns], np.add.reduceat(np.ones(len(order), np.int64) if counts is None else counts[order], at)
    key = columns[0]
    for column, radix in zip(columns[1:], radices[1:]):
        key = key * radix + column
    if counts is None:
        key = np.sort(key)
    else:
        order = np.argsort(key)
        key, counts = key[order], counts[order]
    at = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    counts = np.diff(np.append(at, len(key))) if counts is None else np.add.reduceat(counts, at)
    key, out = key[at], []
    for radix in radices[:0:-1]:
        key, column = np.divmod(key, radix)
        out.append(column)
    return [key, *out[::-1]], counts


def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    """64-bit hashes of a language's words."""
    seed = xxhash.xxh32_intdigest(lang.encode())
    return np.array([xxhash.xxh3_64_intdigest(w, seed=seed) for w in words], np.uint64)


def ways_of(parts: dict[int, int], lang: str, words: list[bytes]) -> np.ndarray:
    """Into how many parts the stripes of the words may be cut; 1 for words that are not hot."""
    if not parts:
        return np.ones(len(words), np.int64)
    return np.array([parts.get(h, 1) for h in word_hashes(lang, words).view(np.int64).tolist()], np.int64)


class Chunks:
    """Collects cleaned texts by language; yields (lang, vocabulary, token numbers, tokens that open no window)."""

    def __init__(self, longest: int):
        self.longest, self.texts, self.held = longest, {}, {}

    def add(self, lang: str, text: bytes):
        text = text.translate(_CLEAN)
        if len(text) > CHUNK_BYTES:
            yield from self._long(lang, text)
            return
        self.texts.setdefault(lang, []).append(text)
        self.held[lang] = self.held.get(lang, 0) + len(text)
        if self.held[lang] >= CHUNK_BYTES:
            yield self._take(lang)

    def rest(self):
        for lang in list(self.texts):
            yield self._take(lang)

    def _take(self, lang: str):
        self.held.pop(lang)
        return self._numbered(lang, tokens_of(END.join([*self.texts.pop(lang), b""]), self.longest), 0)

    def _numbered(self, lang, tokens, later):
        words = Vocabulary()
        numbers = words.numbers(tokens)
        return lang, words, numbers[numbers > 0], later

    def _long(self, lang: str, text: bytes):
        """A long text in parts; the last words of a part open the next one."""
        tail: list[bytes] = []
        parts = segments(text + END)
        part = next(parts)
        while part is not None:
            following = next(parts, None)
            tokens = tail + [t for t in tokens_of(part, self.longest) if t]
            later = self.longest - 1 if following is not None else 0
            if following is not None and len(tokens) <= later:
                tail = tokens
            else:
                yield self._numbered(lang, tokens, later)
                tail = tokens[len(tokens) - later:]
            part = following

    def windows(self, numbers: np.ndarray, later: int) -> tuple[list[np.ndarray], np.ndarray]:
        """Distinct windows that open with a word, and their counts."""
        starts = np.arange(max(0, len(numbers) - later))
        starts = starts[numbers[starts] > 1]
        padded = np.append(numbers, np.ones(self.longest - 1, np.int64)) if not later else numbers
        return distinct_windows([padded[starts + j] for j in range(self.longest)])


def _cleaned_chunks(batches, longest: int):
    chunks = Chunks(longest)
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), (v.as_py() for v in batch.column("text"))):
            yield from ((chunks, c) for c in chunks.add(lang, text))
    yield from ((chunks, c) for c in chunks.rest())


def heavy_words(source: DataFrame, share: float) -> dict[int, int]:
    """Words that may hold ``share`` of all words -> parts of their stripe; at most ``4 / (3 share)`` words.

    Undercounts of a chunk are below a quarter of the share, so no word above it is missed.
    """
    def heavy(lang: str, counts: Counter) -> pa.RecordBatch:
        total = counts.total()
        most = [(w, n) for w, n in counts.items() if 4 * n >= share * total]
        hashes = word_hashes(lang, [w for w, _ in most]).view(np.int64).tolist()
        return pa.RecordBatch.from_arrays(
            [pa.array([0, *hashes], pa.int64()), pa.array([total, *(n for _, n in most)], pa.int64()), pa.array([True] + [False] * len(most))],
            names=["word", "n", "whole"])

    def run(batches):
        held: dict[str, list] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), (v.as_py() for v in batch.column("text"))):
                for part in segments(text.translate(_CLEAN)):
                    chunk = held.setdefault(lang, [0, Counter()])
                    chunk[0] += len(part)
                    chunk[1].update(part.split())
                    if chunk[0] >= CHUNK_BYTES:
                        yield heavy(lang, held.pop(lang)[1])
        for lang, (_, counts) in held.items():
            yield heavy(lang, counts)

    found = staged(source.mapInArrow(run, "word long, n long, whole boolean").groupBy("whole", "word").agg(F.sum("n").alias("n")), "heavy-words")
    total = found.where("whole").agg(F.sum("n")).first()[0] or 0
    heavy = found.where((~F.col("whole")) & (F.col("n") >= 0.75 * share * total)).collect()      # at most 4 / (3 share) rows
    return {r["word"]: math.ceil(r["n"] / (share * total)) + 1 for r in heavy}


STRIPES = pa.schema([("lang", pa.string()), ("first", pa.binary()), ("part", pa.int32()), ("rest", pa.binary()), ("counts", pa.binary())])


def _mix(h: np.ndarray, more: np.ndarray) -> np.ndarray:
    h = (h ^ more) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _stripes(batches, longest: int, parts: dict[int, int]):
    """Stripe rows of each chunk: what follows a first word, with counts."""
    for chunks, (lang, words, numbers, later) in _cleaned_chunks(batches, longest):
        columns, counts = chunks.windows(numbers, later)
        first = columns[0]
        if not len(first):
            continue
        names = list(words)
        cuts, part = ways_of(parts, lang, names), np.zeros(len(first), np.int64)
        if (cuts > 1).any():
            hashes, limit, mixed = word_hashes(lang, names), cuts[first], np.zeros(len(first), np.uint64)
            for column in columns[1:]:
                # as many ways as the words so far can be hot; one way adds nothing
                mixed = np.where(limit > 1, _mix(mixed, hashes[column] % limit.astype(np.uint64)), mixed)
                limit = np.minimum(limit, cuts[column])
            part = (mixed % cuts[first].astype(np.uint64)).astype(np.int64)
            order = np.lexsort((part, first))       # stable: windows stay in order
            columns, part, counts = [c[order] for c in columns], part[order], counts[order]
            first = columns[0]
        edge = np.flatnonzero(np.append(True, (first[1:] != first[:-1]) | (part[1:] != part[:-1])))
        offsets = np.append(edge, len(first))
        flat = np.stack(columns[1:], axis=1).ravel()
        vocabulary = pa.array(names, pa.binary())
        rest = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets * (longest - 1), pa.int32()), vocabulary.take(pa.array(flat))), b" ")
        packed = counts.astype("<u4").tobytes()
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(edge)), vocabulary.take(pa.array(first[edge])), pa.array(part[edge], pa.int32()), rest,
             pa.array([packed[4 * a:4 * b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())], pa.binary())], schema=STRIPES)


PHRASES = pa.schema([("lang", pa.string()), ("words", pa.int32()), ("phrase", pa.binary()), ("f", pa.int64()), ("right", pa.int64()),
                     ("whole", pa.bool_())])


def _phrases(lang: str, rows: list[tuple], longest: int, least: int, parts: dict[int, int]):
    """The frequent phrases of a language's merged stripes (first, part, rest, counts), which come in order; counts of
    prefixes that are cut into parts are partial (``whole`` false)."""
    keys, index, words = [], [], Vocabulary()
    for first, part, _, _ in rows:
        if not keys or keys[-1] != (first, part):
            keys.append((first, part))
        index.append(len(keys) - 1)
    # all rows at once: a stripe of few entries costs no more than its entries
    group = np.repeat(index, [len(row[3]) // 4 for row in rows])
    counts = np.frombuffer(b"".join([row[3] for row in rows]), "<u4").astype(np.int64)
    flat = words.numbers(b" ".join([row[2] for row in rows]).split(b" ")).reshape(-1, longest - 1)
    columns, counts = distinct_windows([group, *[flat[:, j] for j in range(longest - 1)]], counts)
    names, firsts = list(words), [first for first, _ in keys]
    out = [(lang, 0, b"", int(counts.sum()), 0, False)]
    first_ways, word_ways = ways_of(parts, lang, firsts), ways_of(parts, lang, names)
    rows_, values, right = columns, counts, np.zeros(len(counts), np.int64)
    for size in range(longest, 0, -1):
        # rows_: the prefixes of ``size`` words (group, then the words after the first)
        real = rows_[-1] > 1 if size > 1 else np.ones(len(values), bool)
        ways = first_ways[rows_[0]]
        for j in range(1, size):
            ways = np.minimum(ways, word_ways[rows_[j]])
        whole = ways == 1 if size < longest else np.ones(len(values), bool)
        for i in np.flatnonzero(real & (~whole | (values >= least))).tolist():
            phrase = b" ".join([firsts[rows_[0][i]], *[names[rows_[j][i]] for j in range(1, size)]])
            out.append((lang, size, phrase, int(values[i]), int(right[i]), bool(whole[i])))
        if size == 1:
            break
        new = np.ones(len(values), bool)
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in rows_[:-1]])
        at = np.flatnonzero(new)
        right = np.maximum.reduceat(np.where(real, values, 0), at)
        values, rows_ = np.add.reduceat(values, at), [c[at] for c in rows_[:-1]]
    columns = list(zip(*out))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PHRASES)], schema=PHRASES)


def _merge(batches, longest: int, least: int, parts: dict[int, int]):
    """Merges the stripes, which arrive sorted by key, several keys of a language at a time."""
    lang, held, entries = None, [], 0
    for batch in batches:
        for of, *row in zip(*[batch.column(c).to_pylist() for c in STRIPES.names]):
            if held and (of != lang or (entries >= MERGED_ENTRIES and held[-1][:2] != row[:2])):
                yield _phrases(lang, held, longest, least, parts)
                held, entries = [], 0
            lang = of
            held.append(row)
            entries += len(row[3]) // 4
    if held:
        yield _phrases(lang, held, longest, least, parts)


def phrase_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", longest: int = LONGEST,
                  least: int = LEAST_COUNT) -> DataFrame:
    """(lang, words, phrase, f, right): every phrase of up to ``longest`` words found ``least`` times or more; ``right``
    is the largest count among its extensions by one word (longest phrases: 0).  The row of no words counts all words of a language."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    source = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), text.alias("text"))
    total = source.agg(F.sum(byte_length(F.col("text")))).first()[0] or 0
    width = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / TASK_BYTES))
    parts = docs.sparkSession.sparkContext.broadcast(heavy_words(source, 1 / (4 * width)))      # at most 6 * width pairs of numbers
    stripes = source.mapInArrow(lambda b: _stripes(b, longest, parts.value), "lang string, first binary, part int, rest binary, counts binary")
    merged = stripes.repartition(width, "lang", "first", "part").sortWithinPartitions("lang", "first", "part").mapInArrow(
        lambda b: _merge(b, longest, least, parts.value), "lang string, words int, phrase binary, f long, right long, whole boolean")
    merged = staged(merged, "phrases")
    added = merged.where("not whole").groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f"), F.max("right").alias("right"))
    return merged.where("whole").drop("whole").unionByName(added).where((F.col("f") >= least) | (F.col("words") == 0)).select(
        "lang", "words", F.col("phrase").cast("string").alias("phrase"), "f", "right")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", longest: int = LONGEST, least: int = LEAST_COUNT,
                 cover_percent: int = COVER_PERCENT, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` candidates of each language.

    A candidate is dropped if a longer one that holds it has ``cover_percent`` of its count
    or more; one word more is enough to look at, as counts fall with length.
    """
    counts = staged(phrase_counts(docs, lang_col, text_col, longest, least), "frequent-phrases")
    candidates = counts.where("words >= 2")
    left = counts.where("words >= 3").groupBy("lang", F.expr("substr(phrase, instr(phrase, ' ') + 1)").alias("phrase")).agg(
        F.max("f").alias("left"))
    longer = F.greatest("right", F.coalesce("left", F.lit(0)))
    covered = (longer >= least) & (longer * 100 >= F.col("f") * cover_percent)
    stay = candidates.join(left, ["lang", "phrase"], "left").where(~covered)

    split = F.split("phrase", " ")
    cuts = stay.select("lang", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"), split.alias("parts"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("parts", F.lit(1), F.col("k")), " ").alias("head"),
                       F.array_join(F.slice("parts", F.col("k") + 1, F.size("parts")), " ").alias("tail"))
    known = counts.where("words >= 1")
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    number = "decimal(15,0)"
    score = F.expr(f"cast(1000000 * cast(a as {number}) * cast(a as {number}) as decimal(38,0)) div "
                   f"cast(cast(l as {number}) * cast(r as {number}) as decimal(38,0))")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.first("a").alias("a"))
    found = best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = found.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    totals = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle_sql() -> str:
    """DuckDB text of the registered query."""
    ends = " || ".join(["'.,;:!?'", *[f"chr({c})" for c in (10, 11, 12, 13)]])
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split(translate(text, '{capitals}' || {ends} || chr(9), '{capitals.lower()}' || repeat(chr(10), 10) || ' '), chr(10))) AS piece
  FROM documents),
worded AS (SELECT lang, list_filter(string_split(piece, ' '), lambda w: w <> '') AS w FROM pieces),
spots AS (SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM worded WHERE len(w) > 0),
grams AS (
  SELECT lang, 1 AS words, w[i] AS phrase FROM spots
  UNION ALL SELECT lang, 2, w[i] || ' ' || w[i + 1] FROM spots WHERE i + 1 <= len(w)
  UNION ALL SELECT lang, 3, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM spots WHERE i + 2 <= len(w)),
f AS (SELECT lang, words, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE words = 1 GROUP BY lang),
candidates AS (SELECT *, string_split(phrase, ' ') AS p FROM f WHERE words >= 2 AND f >= {LEAST_COUNT}),
covers AS (
  SELECT lang, p[1] || ' ' || p[2] AS phrase, f FROM candidates WHERE words = 3
  UNION ALL SELECT lang, p[2] || ' ' || p[3], f FROM candidates WHERE words = 3),
most AS (SELECT lang, phrase, max(f) AS longer FROM covers GROUP BY ALL),
stay AS (
  SELECT c.* FROM candidates c LEFT JOIN most m ON m.lang = c.lang AND m.phrase = c.phrase
  WHERE m.longer IS NULL OR 100 * m.longer < {COVER_PERCENT} * c.f),
cuts AS (
  SELECT lang, phrase, f, 1 AS k, p[1] AS head, substr(phrase, length(p[1]) + 2) AS tail FROM stay
  UNION ALL SELECT lang, phrase, f, 2, p[1] || ' ' || p[2], p[3] FROM stay WHERE words = 3),
scored AS (
  SELECT c.lang, c.phrase, c.f AS a, c.k, h.f AS l, t.f AS r,
         (1000000::HUGEINT * c.f * c.f // (h.f::HUGEINT * t.f))::BIGINT AS score
  FROM cuts c JOIN f h ON h.lang = c.lang AND h.phrase = c.head JOIN f t ON t.lang = c.lang AND t.phrase = c.tail),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS pos FROM scored),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM best WHERE pos = 1)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score
FROM ranked JOIN totals USING (lang) WHERE rank <= {TOP}"""
