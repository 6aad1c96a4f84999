"""Phrase mining against brute force: counts, cuts, subsumption, exact scores, cut stripes, long texts, odd rows."""

import collections
import random
import re

import numpy as np
import pytest

from arlark.llm import collocations as op

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, longest=3, least=10, cover=50, top=2000):
    f = collections.defaultdict(collections.Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    f["und" if lang is None else lang][tuple(words[i:i + size])] += 1
    out = []
    for lang, counts in f.items():
        n = sum(c for p, c in counts.items() if len(p) == 1)
        candidates = {p: c for p, c in counts.items() if len(p) > 1 and c >= least}
        longer = collections.Counter()
        for p, c in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    longer[p[i:i + size]] = max(longer[p[i:i + size]], c)
        found = []
        for p, a in candidates.items():
            if longer[p] and 100 * longer[p] >= cover * a:
                continue
            score, _, l, r = min((1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def texts(seed, number=150):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "of", "new", "york", "city", "é", "É", "x y", "naïve", "a", "b", "c", "𝔘"] + [f"w{k}" for k in range(12)]
    out = []
    for _ in range(number):
        words = []
        for _ in range(rng.randrange(60)):
            words.append(rng.choice(["new york city", "the the the", "a b", *vocabulary]))
            words.append(rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", "!? "]))
        out.append((rng.choice(["en", "en", "en", "de", None, "und", ""]), "".join(words)))
    return out + [("en", None), ("en", ""), (None, " \t\n"), ("fr", "..."), ("en", "new york city " * 3000), ("xx", "one"), ("en", out[0][1])]


def frame(spark, rows):
    return spark.createDataFrame([(lang, text, "q") for lang, text in rows], "lang string, text string, phrase string")


@pytest.mark.parametrize("options", [{}, {"longest": 2, "least": 3}, {"longest": 5, "least": 4, "cover_percent": 80, "top": 40}])
def test_against_brute_force(spark, options):
    rows = texts(1)
    names = {"cover_percent": "cover"}
    expected = brute(rows, **{names.get(k, k): v for k, v in options.items()})
    got = op.collocations(frame(spark, rows), **options)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == expected and len(expected) > 10


def test_many_tasks_cut_hot_stripes_into_parts(spark):
    rows = texts(2, 300)
    width = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        df = frame(spark, rows).repartition(7)
        source = df.selectExpr("coalesce(lang, 'und') lang", "cast(coalesce(text, '') as binary) text")
        parts = op.heavy_words(source, 1 / 256)
        assert max(parts.values()) > 3
        assert sorted(map(tuple, op.collocations(df).collect())) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)


def test_empty_table_gives_nothing(spark):
    assert op.collocations(frame(spark, [])).collect() == []
    assert op.collocations(frame(spark, [("en", None)])).collect() == []


def test_scores_beyond_64_bits(spark):
    a, l, r = 3 * 10**14, 9 * 10**14, 7 * 10**14 + 1
    df = spark.createDataFrame([(a, l, r)], "a long, l long, r long")
    number = "decimal(15,0)"
    got = df.selectExpr(f"cast(1000000 * cast(a as {number}) * cast(a as {number}) as decimal(38,0)) div "
                        f"cast(cast(l as {number}) * cast(r as {number}) as decimal(38,0)) s").first()[0]
    assert got == 1000000 * a * a // (l * r)


@pytest.mark.parametrize("longest", [2, 3, 5])
@pytest.mark.parametrize("size", [7, 40, 300])
def test_long_texts_are_counted_across_their_parts(monkeypatch, longest, size):
    monkeypatch.setattr(op, "CHUNK_BYTES", size)
    for lang, text in texts(3, 12) + [("en", "monster" * 100 + " a b a b " + "x" * 90)]:
        if not text or len(text) > 5000:
            continue
        got = collections.Counter()
        chunks = op.Chunks(longest)
        for _, words, numbers, later in [*chunks.add("en", text.encode()), *chunks.rest()]:
            columns, counts = chunks.windows(numbers, later)
            names = list(words)
            for row, n in zip(zip(*columns), counts.tolist()):
                got[tuple(names[k] for k in row)] += n
        expected = collections.Counter()
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", text.translate(LOWER).encode()):
            tokens = re.findall(rb"[^\x20\x09]+", piece) + [op.END] * (longest - 1)
            for i in range(len(tokens) - longest + 1):
                expected[tuple(tokens[i:i + longest])] += 1
        assert got == expected


@pytest.mark.parametrize("big", [0, 1 << 40])
def test_distinct_windows_adds_counts(big):
    """With and without numbers that fit one sort key."""
    given = [np.array([2, 1, 2, big]), np.array([5, 5, 5, big])]
    columns, counts = op.distinct_windows(given, np.array([1, 2, 4, 9]))
    expected = sorted([((1, 5), 2), ((2, 5), 5), ((big, big), 9)])
    assert list(zip(zip(*[c.tolist() for c in columns]), counts.tolist())) == expected
    columns, counts = op.distinct_windows(given)
    assert list(zip(zip(*[c.tolist() for c in columns]), counts.tolist())) == [(w, 2 if w == (2, 5) else 1) for w, _ in expected]
