"""MinHash near-dedup, embeddings and repeated passages against brute force; the pipeline's stages."""

import hashlib
import random

import numpy as np
import pytest

from arlark.llm import components, embeddings, minhash, repeats

WORDS = [f"w{i}" for i in range(400)]


class Union(dict):
    def find(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)


def near_texts(seed=4):
    rng = random.Random(seed)
    texts = [None, "", " \t", "One two", "one TWO", "one two three four five", "É ä", "é ä"]
    base = [rng.choice(WORDS) for _ in range(300)]
    for k in range(60):  # a chain of drifting copies and a cloud around one text
        base = list(base)
        for _ in range(3):
            base[rng.randrange(len(base))] = rng.choice(WORDS)
        texts.append(" ".join(base))
    centre = [rng.choice(WORDS) for _ in range(120)]
    for _ in range(60):
        copy = list(centre)
        for _ in range(rng.randrange(9)):
            copy[rng.randrange(len(copy))] = rng.choice(WORDS)
        texts.append(" ".join(copy))
    texts += [" ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 80))) for _ in range(60)]
    texts += [texts[20].upper().replace("W", "w"), texts[20].replace(" ", "\n\n"), "z " * 9000]
    return texts


def brute_components(rows):
    sets = {}
    for i, t in rows:
        words = (t or "").encode().lower().split()
        sets.setdefault(i, []).append({tuple(words)} if 0 < len(words) < 5 else {tuple(words[k:k + 5]) for k in range(len(words) - 4)})
    groups = Union()
    ids = list(sets)
    for x, i in enumerate(ids):
        for j in ids[:x + 1]:
            for a in sets[i]:
                for b in sets[j]:
                    if a and b and 100 * len(a & b) >= 75 * len(a | b):
                        groups.join(i, j)
    return {i: groups.find(i) for i in ids}, {i: len(s[0]) for i, s in sets.items()}


@pytest.mark.parametrize("block, per_copy", [(2048, 256), (3, 2)])
def test_minhash_components(spark, monkeypatch, block, per_copy):
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "MEMBERS_PER_COPY", per_copy)
    monkeypatch.setattr(minhash, "CHUNK", per_copy * 2)
    rows = list(enumerate(near_texts()))
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in rows] + [(None, rows[30][1], "k", 1), (20, rows[20][1], "k", 1)],
                                 "doc_id long, text string, kept string, a int").repartition(4)
    got = minhash.near_duplicates(docs).collect()
    component, sizes = brute_components(rows)
    assert len(got) == len(rows) + 2
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
            continue
        assert (r.component_id, r.n_shingles, r.kept) == (component[r.doc_id], sizes[r.doc_id], component[r.doc_id] == r.doc_id)


def test_minhash_texts_of_one_id_are_one_node(spark):
    rng = random.Random(4)
    text = lambda: " ".join(rng.choice("abcdefghijklmnop") * 3 for _ in range(60))
    one, two, three, four = (text() for _ in range(4))
    # 5 holds copies of two smaller ids' texts; 6 and 7 share one; 8 and 9 hold an empty text, or two of their own
    rows = [(1, one), (2, two), (5, one), (5, two), (6, three), (7, three), (7, four), (8, four), (8, ""), (9, text()), (9, text()),
            (10, None), (10, ""), (5, text()), (None, one), (None, two)]
    component, _ = brute_components([r for r in rows if r[0] is not None])
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert len(got) == len(rows) and component[5] == component[2] == 1 and component[8] == 6
    for r in got:
        want = None if r.doc_id is None else component[r.doc_id]
        assert (r.component_id, r.kept) == (want, r.doc_id in (None, want)), r


def test_minhash_empty_and_unlinked(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(empty).count() == 0
    assert minhash.without_near_duplicates(empty).columns == ["doc_id", "text"]
    alone = spark.createDataFrame([(1, "a b c d e f"), (2, None)], "doc_id long, text string")
    assert sorted((r.doc_id, r.component_id) for r in minhash.near_duplicates(alone).collect()) == [(1, 1), (2, 2)]


def test_components_of_paths_stars_and_cycles(spark):
    rng = random.Random(9)
    links = [(i, i + 1) for i in range(0, 60)] + [(1000, i) for i in range(1001, 1080)] + [(2000, 2000), (5, None), (3000, 3001), (3001, 3000)]
    links += [(rng.randrange(4000, 4100), rng.randrange(4000, 4100)) for _ in range(80)]
    rng.shuffle(links)
    groups = Union()
    for a, b in links:
        if b is not None and a != b:
            groups.join(a, b)
    frame = spark.createDataFrame(links, "a long, b long").repartition(6)
    got = {r.node: r.component for r in components.connected_components(frame).collect()}
    assert got == {x: groups.find(x) for x in list(groups)}
    assert components.connected_components(frame.limit(0)).count() == 0


@pytest.mark.parametrize("chunk, pivots", [(4096, (8, 32, 128, 512)), (7, (2, 4)), (50, (16,))])
def test_embedding_links_and_components(spark, monkeypatch, chunk, pivots):
    monkeypatch.setattr(embeddings, "CHUNK", chunk)
    monkeypatch.setattr(embeddings, "STREAM", 16)
    monkeypatch.setattr(embeddings, "PIVOT_COUNTS", pivots)
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(6, 8))
    vectors = [c + rng.normal(size=8) * s for c in centres for s in np.linspace(0, 0.4, 40)]
    vectors += [vectors[3]] * 5 + [vectors[7] * 4.0] + list(rng.normal(size=(60, 8)))
    u = np.array(vectors)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    cosine = u @ u.T
    cosine[np.abs(cosine - 0.95) < 1e-12] = 1
    near = cosine >= 0.95
    groups = Union()
    for i, j in np.argwhere(near).tolist():
        groups.join(i, j)
    rows = [(i, v.tolist(), 1, "x") for i, v in enumerate(vectors)]
    odd = [(900, None), (901, [0.0] * 8), (902, [None] + [1.0] * 7), (903, [float("nan")] * 8), (904, []), (905, [1.0, 2.0]),
           (906, [2.0, 4.0]), (907, [float("inf")] + [0.0] * 7), (None, vectors[0].tolist()), (908, [1e-300] * 3)]
    frame = spark.createDataFrame(rows + [(i, v, 1, "x") for i, v in odd],
                                  "vec_id long, embedding array<double>, links int, cell string").repartition(5)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(frame).collect()}
    expected = {i: (int(near[i].sum()) - 1, groups.find(i), groups.find(i) == i) for i in range(len(vectors))}
    expected |= {i: (0, i, True) for i in (900, 901, 902, 903, 904, 907, 908)} | {None: (0, None, True)}
    expected |= {905: (1, 905, True), 906: (1, 905, False)}
    assert got == expected
    assert embeddings.near_duplicates(frame.limit(0)).count() == 0
    assert embeddings.near_duplicates(frame.where("vec_id = 900")).count() == 1


def test_an_embedding_id_with_several_vectors_is_one_node(spark):
    rng = np.random.default_rng(3)
    base = [rng.normal(size=12) for _ in range(12)]
    rows = [(1, base[0]), (7, base[1]), (5, base[0]), (5, base[1]), (5, base[1]),            # 1 - 5 - 7, one row twice
            (20, base[2]), (20, base[3]), (30, base[2] + 0.01), (31, base[3] + 0.01),          # two classes with one smallest id
            (20, base[4]), (40, None), (40, base[4]), (41, None), (50, base[5]), (50, base[6]), (51, base[6]), (52, base[7]), (52, base[7])]
    rows += [(60 + k // 3, base[8 + k % 3] * (1 + k)) for k in range(9)]                       # scaled copies link, though they differ
    def cosine(a, b):
        return float(a @ b) / float(np.linalg.norm(a) * np.linalg.norm(b))
    groups, expected = Union(), []
    for i, v in rows:
        groups.find(i)
        for j, w in rows:
            if v is not None and w is not None and cosine(v, w) >= 0.95:
                groups.join(i, j)
    for i, v in rows:
        others = {} if v is None else {w.tobytes(): {j for j, x in rows if x is not None and x.tobytes() == w.tobytes()}
                                       for _, w in rows if w is not None and cosine(v, w) >= 0.95}
        links = sum(len(ids) - (key == v.tobytes()) for key, ids in others.items())
        expected.append((i, links, groups.find(i), groups.find(i) == i))
    frame = spark.createDataFrame([(i, None if v is None else v.tolist()) for i, v in rows], "vec_id long, embedding array<double>").repartition(3)
    assert sorted(map(tuple, embeddings.near_duplicates(frame).collect())) == sorted(expected)
    assert {g for i, _, g, _ in expected if i in (1, 5, 7)} == {1}


def test_vectors_lie_once_however_many_files_they_are_compared_with(spark, monkeypatch):
    plans, folders, keep, name = {}, [], embeddings.staged, embeddings.shared_uri if hasattr(embeddings, "shared_uri") else None

    def seen(df, tag):
        plans[tag] = df._jdf.queryExecution().executedPlan().toString()
        return keep(df, tag)

    def named(session, tag):
        folders.append(name(session, tag))
        return folders[-1]

    monkeypatch.setattr(embeddings, "staged", seen)
    monkeypatch.setattr(embeddings, "shared_uri", named, raising=False)
    monkeypatch.setattr(embeddings, "CHUNK", 5)
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(160, 16))
    vectors = np.concatenate([vectors, vectors[:30] + rng.normal(size=(30, 16)) * 0.01, vectors[:9]])
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>").repartition(4)
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(frame).collect()}
    expected = {i: (0, i) for i in range(199)} | {i: (1, i % 160) for i in list(range(30)) + list(range(160, 190))}
    expected |= {i: (2, i % 190 % 160) for i in [*range(9), *range(160, 169), *range(190, 199)]}
    assert got == expected
    # what the comparing tasks are sent names files; no vector travels for it, and each lies in one file
    assert "unit" not in plans["range-join"] and "vector" not in plans["range-join"]
    stored = spark.read.parquet(folders[0])
    assert stored.count() == 190 and stored.select("home", "file").distinct().count() >= 30
    assert stored.selectExpr("max(length(vector))").first()[0] == 16 * 4


def brute_repeats(rows, threshold):
    first = {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        body = (t or "").encode()
        for k in range(len(body) - threshold + 1):
            first.setdefault(body[k:k + threshold], i)
    out = []
    for i, t in rows:
        body = (t or "").encode()
        gone = bytearray(len(body))
        for k in range(len(body) - threshold + 1):
            if i is not None and first[body[k:k + threshold]] < i:
                gone[k:k + threshold] = b"\1" * threshold
        kept = bytes(c for c, g in zip(body, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out.append((i, len(body), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def repeat_rows():
    rng = random.Random(6)
    text = lambda n: "".join(rng.choice("abcdefé \n") for _ in range(n))
    passage, long = text(300), text(4000)
    rows = [(i, text(rng.randrange(200)) + passage[rng.randrange(100):200 + rng.randrange(100)] + text(rng.randrange(200))) for i in range(40)]
    rows += [(50 + i, text(rng.randrange(60)) + long[rng.randrange(3000):][:rng.randrange(40, 900)]) for i in range(20)]
    rows += [(90, None), (91, ""), (92, "a" * 49), (93, "a" * 50), (94, "a" * 500), (95, "ab" * 300), (96, "ba" * 300), (97, rows[3][1]),
             (98, passage), (None, passage), (7, passage + text(30)), (3, rows[3][1]), (99, long * 3), (100, text(20) + "é" * 80)]
    return rows


@pytest.mark.parametrize("hot, block, buffer", [(32, 8 << 20, 1 << 19), (0, 3000, 1 << 19), (1, 20_000, 700)])
def test_repeated_passages(spark, monkeypatch, hot, block, buffer):
    monkeypatch.setattr(repeats, "HOT_SOURCES", hot)
    monkeypatch.setattr(repeats, "BLOCK_BYTES", block)
    monkeypatch.setattr(repeats, "BUFFER_BYTES", buffer)
    monkeypatch.setattr(repeats, "WINDOWS_AT_ONCE", 500)
    rows = repeat_rows()
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n_bytes int, row string").repartition(5)
    got = sorted(map(str, map(tuple, repeats.remove_repeats(docs).collect())))
    assert got == sorted(map(str, brute_repeats(rows, 50)))


def test_repeated_ids_with_whole_copies(spark):
    rng = random.Random(8)
    text = lambda: "".join(rng.choice("abcdefgh") for _ in range(200))
    copied, other, third = text(), text(), text()
    # 5 copies the text of 1 and has one of its own, which 7 copies and 8 quotes
    rows = [(1, copied), (5, copied), (5, other), (7, other), (8, third[:80] + other[20:150] + third[80:]), (9, copied), (9, third), (9, other)]
    got = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute_repeats(rows, 50)))
    assert {(r.doc_id, r.n_bytes, r.n_removed) for r in got if r.doc_id == 5} == {(5, 200, 200), (5, 200, 0)}


def test_repeats_text_spans_and_columns(spark):
    rows = repeat_rows()
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n_bytes int, row string")
    short = repeats.remove_repeats(docs, threshold=20, gram=8).collect()
    assert sorted(map(str, map(tuple, short))) == sorted(map(str, brute_repeats(rows, 20)))
    trimmed = repeats.trimmed_documents(docs)
    assert trimmed.columns == docs.columns and trimmed.schema.simpleString() == docs.schema.simpleString()
    texts = {r.doc_id: r.text for r in trimmed.collect()}
    assert texts[97] == "" and texts[90] == "" and texts[92] == "a" * 49
    assert repeats.remove_repeats(docs.limit(0)).count() == 0


def test_equal_windows_groups():
    rng = np.random.default_rng(1)
    windows = rng.integers(0, 2, (300, 11)).astype(np.uint8)
    groups = rng.integers(0, 3, 300)
    got = repeats.equal_windows(groups, windows)
    keys = [(g, w.tobytes()) for g, w in zip(groups.tolist(), windows)]
    for i, a in enumerate(keys):
        same = [j for j, b in enumerate(keys) if a == b]
        assert (got[i] == -1) == (len(same) == 1)
        assert all(got[j] == got[i] for j in same)
