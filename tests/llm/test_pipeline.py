"""The pipeline against a stage-by-stage brute-force version of its own, rows and order."""

import collections
import hashlib
import os
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_quality(text):
    """The base limits and the threshold table, from their descriptions."""
    from arlark.llm.quality import STOP_WORDS

    text = text or ""
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    n, chars = len(words), sum(map(len, words))
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    repeated = {q for p in range(n - 2) if windows[tuple(words[p:p + 3])] > 1 for q in (p, p + 1, p + 2)}
    if n < 50 or len(repeated) * 2 > n:
        return False
    common = sum(w.lower() in STOP_WORDS for w in words)
    if common * 100 < n:
        common = sum(c for c in collections.Counter(words).values() if c >= 3)
    short = sum(len(x) < 10 for x in lines)
    bullets = sum(x.lstrip(" ")[:1] in ("*", "-", "•") for x in lines)
    return (2 * n <= chars <= 20 * n and sum(c in "#*$%&|<>" for c in text) * 10 <= chars and common * 100 >= n
            and (len(lines) < 4 or (len(lines) - len(set(lines))) * 10 <= 3 * len(lines))
            and (len(lines) < 10 or max(short, bullets) * 10 <= 9 * len(lines)))


def brute_cut(rows):
    """Texts by row without the bytes that 50 bytes of a smaller id cover; rows without an id stay whole."""
    first = {}
    for doc, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        body = text.encode()
        for k in range(len(body) - 49):
            first.setdefault(body[k:k + 50], doc)
    out = []
    for doc, text in rows:
        body = text.encode()
        gone = bytearray(len(body))
        for k in range(len(body) - 49):
            if doc is not None and first[body[k:k + 50]] < doc:
                gone[k:k + 50] = b"\1" * 50
        out.append(bytes(c for c, g in zip(body, gone) if not g).decode("utf-8", "ignore"))
    return out


def when(weight, share):
    """Training time of a share of demand, by bisection of the integrated schedule."""
    knots = {1: [(0, 1.5), (0.5, 1.0), (1, 0.5)], 2: [(0, 2.0), (1, 2.0)], 3: [(0, 1.5), (0.5, 3.0), (1, 4.5)]}[weight]
    total = sum((a[1] + b[1]) / 2 * (b[0] - a[0]) for a, b in zip(knots, knots[1:]))

    def area(t):
        out = 0.0
        for (t0, g0), (t1, g1) in zip(knots, knots[1:]):
            if t > t0:
                d = min(t, t1) - t0
                out += g0 * d + (g1 - g0) / (t1 - t0) * d * d / 2
        return out

    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if area(mid) < share * total else (low, mid)
    return low


def brute_mix(rows):
    """(row number, position) of every copy; rows are (id, text, source)."""
    from test_quality_mixing_sharding import water_fill

    size = [len(WORD.findall(t)) for _, t, _ in rows]
    sizes = collections.Counter()
    for (_, _, s), n in zip(rows, size):
        sizes[s] += n
    targets = water_fill(sizes, (1, 2, 3))
    order = sorted([s for s in sizes if s is not None]) + ([None] if None in sizes else [])
    out = []
    for turn, source in enumerate(order):
        target, total, start = targets[source], sizes[source], 0
        passes = min(3, int(target // total)) if total else 1
        mine = [k for k, r in enumerate(rows) if r[2] == source]
        mine.sort(key=lambda k: (hashlib.md5(b"" if rows[k][0] is None else str(rows[k][0]).encode()).hexdigest(),
                                 (rows[k][0] is not None, rows[k][0] or 0), size[k]))
        for k in mine:
            extra = passes < 3 and start + size[k] / 2 < target - passes * total
            for p in range(passes + extra):
                share = (p * total + start + size[k] / 2) / target if target else 0.0
                out.append((k, when(1 + turn % 3, min(1.0, share))))
            start += size[k]
    return out


def check_against_brute_force(spark, sf_dir):
    """Expected rows: (id, count, digests) of each copy with its position; got rows are in the order of theirs."""
    from test_duplicates import brute_components

    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    rows = [tuple(r) for r in table.collect() if brute_quality(r.text)]
    component, _ = brute_components([r[:2] for r in rows if r[0] is not None])
    rows = [r for r in rows if r[0] is None or component[r[0]] == r[0]]
    rows = [(i, t, s) for (i, _, s), t in zip(rows, brute_cut([r[:2] for r in rows]))]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    digest = []
    for i, text, _ in rows:
        ids = library.encode(text, add_special_tokens=False).ids
        digest.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    places = collections.defaultdict(list)
    for k, position in brute_mix(rows):
        places[digest[k]].append(position)
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == ["doc_id", "position", "n_tokens", "ids_sha256", "decoded_sha256"]
    got = sorted(got.collect(), key=lambda r: r.position)
    assert len({r.position for r in got}) == len(got)
    assert collections.Counter((r.doc_id, *r[2:]) for r in got) == collections.Counter({k: len(v) for k, v in places.items()})
    turn, sequence = {k: iter(sorted(v)) for k, v in places.items()}, []
    for r in got:
        sequence.append(next(turn[(r.doc_id, *r[2:])]))
    assert all(a <= b + 1e-9 for a, b in zip(sequence, sequence[1:]))
    return len(got)


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables are not here")
def test_pipeline_rows_and_order(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "minhash_near_dedup", "suffix_array_dedup", "mixing_sources", "bpe_encoding"]
    assert check_against_brute_force(spark, SF) > 50


def odd_table(path, rows):
    names = {"doc_id": pa.int64(), "text": pa.string(), "lang": pa.string(), "source": pa.string(), "n_chars": pa.int64(),
             "position": pa.int64(), "a.b": pa.string(), "row": pa.string(), "_position": pa.int64(), "kept": pa.bool_()}
    columns = list(zip(*[(*r, 5, "dot", "r", 6, False) for r in rows])) or [[] for _ in names]
    os.makedirs(path)
    pq.write_table(pa.table({n: pa.array(c, t) for (n, t), c in zip(names.items(), columns)}), f"{path}/documents.parquet")


def odd_rows():
    rng = random.Random(8)
    words = ["the", "of", "and", "water", "stone", "river", *(f"term{k}" for k in range(300))]
    make = lambda n: " ".join(rng.choice(words[:3]) if rng.random() < 0.2 else rng.choice(words) for _ in range(n))
    texts = [make(rng.randrange(60, 200)) for _ in range(25)]
    near = texts[3].split(" ")
    near[10] = "changed"
    shared = make(20)
    rows = [(i * 3, t, "en", f"s{i % 4}" if i % 5 else None, len(t)) for i, t in enumerate(texts)]
    rows += [(900, " ".join(near), "en", "s1", 1), (901, texts[4], None, "s2", 1), (902, make(40) + " " + shared + " " + make(40), "en", "s1", 1),
             (903, make(60) + "\n" + shared + "\n" + make(50), "de", "s3", 1), (904, None, "en", "s1", 0), (905, "", None, None, 0),
             (906, make(6000), "en", "s0", 1), (None, make(80), "en", "s1", 1), (None, make(90), "en", None, 1),
             (907, "é " + make(70), "fr", "s2", 1), (908, "1 2 3", "en", "s2", 1)]
    return rows


def test_nulls_long_texts_and_columns_of_any_name(spark, tmp_path):
    odd_table(str(tmp_path / "odd"), odd_rows())
    assert check_against_brute_force(spark, str(tmp_path / "odd")) > 25


def test_stages_keep_the_columns_and_repeated_rows(spark, tmp_path):
    rows = odd_rows()
    odd_table(str(tmp_path / "odd"), rows + rows[:2] * 2)
    docs = spark.read.parquet(str(tmp_path / "odd" / "documents.parquet"))
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, "").write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns, name
        if name == "suffix_array_dedup":        # all rows of a kept id are still there
            assert docs.where("doc_id = 0").count() == 3
    assert docs.where("`a.b` = 'dot' and row = 'r' and _position = 6 and not kept and position = 5").count() == docs.count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").where("doc_id = 0").count() >= 3


def test_an_empty_table(spark, tmp_path):
    odd_table(str(tmp_path / "none"), [])
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).collect() == []
