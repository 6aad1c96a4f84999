"""Quality rules, source mixing and sharding against brute force."""

import collections
import random
import re
import zlib

import duckdb
import pytest

from arlark.llm import mixing, quality, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_measures(text):
    words = WORD.findall(text or "")
    seen = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {q for p in range(len(words) - 2) if seen[tuple(words[p:p + 3])] > 1 for q in (p, p + 1, p + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def corpus():
    rng = random.Random(11)
    texts = [None, "", " \n\t", "the", "a b a b a b a", "x y z x y z", "á é í\x85", "# * $ | <tag>", "same\nsame\n\nsame ",
             "the of and " * 40, "lorem " * 20_000, " lead and trail "]
    texts += [" ".join(rng.choice(["the", "of", "ab", "cd", "ef#", "*", "la\nde"]) for _ in range(rng.randrange(200))) for _ in range(60)]
    rows = [(i, t, rng.choice(["a", "b", None, "ä", "Z"]), f"k{i % 3}") for i, t in enumerate(texts)]
    return rows + [rows[20], (None, "null id of the row", "a", "k")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), "doc_id long, text string, source string, kept string").repartition(5).cache()


def test_quality_measures_and_verdict(spark, docs):
    got = quality.assess(docs.select("doc_id", "text")).collect()
    rows = collections.defaultdict(list)
    for doc_id, text, *_ in corpus():
        rows[doc_id].append(brute_measures(text))
    for r in got:
        want = rows[r.doc_id][0]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, r.doc_id
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r.kept == (not r.base_failed and not r.broken)
    assert len(got) == len(corpus())
    assert {b for r in got for b in r.broken} >= {"symbols", "word_length"}
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").where("doc_id != 20").toPandas())
    oracle = sorted(con.execute(f"select doc_id, kept, n_repeat_words from ({quality.oracle_sql()})").fetchall())
    assert oracle == sorted((r.doc_id, r.kept, r.n_repeat_words) for r in got if r.doc_id not in (None, 20))


def test_gibberish_is_rejected_whatever_its_label(spark):
    rng = random.Random(3)
    text = " ".join("".join(rng.choice("aeioklmnpst") for _ in range(7)) for _ in range(200))
    rows = [(i, text, lang) for i, lang in enumerate(["pl", "fi", "ru-RU", None, "en", "de-AT", "english"])]
    langs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {tuple(r.broken) for r in quality.assess(langs).collect()} == {("common_words",)}
    assert quality.apply_rules(langs).count() == 0 and quality.assess(langs.drop("lang")).where("kept").count() == 0
    assert [tuple(r) for r in quality.rejections(langs).collect()] == [("common_words", 7, 7)]


def test_clean_texts_of_many_languages_stay(spark):
    texts = {
        "pl": "Wieczorem nad jeziorem zrobiło się cicho, a potem przyszła burza i wszyscy wrócili do domu, bo nikt nie chciał czekać na deszcz. "
              "Rano okazało się, że wiatr połamał kilka gałęzi, ale dom jest cały, więc dzieci poszły nad wodę i szukały muszli w piasku. "
              "Potem zjedli śniadanie na tarasie i patrzyli, jak mgła powoli znika z pola za rzeką.",
        "fi": "Aamulla satoi lunta ja tie oli liukas, mutta bussi tuli silti ajoissa ja kaikki ehtivät töihin. Illalla sää muuttui, ja lumi alkoi sulaa, "
              "koska lämpötila nousi nopeasti. Lapset sanoivat, että he haluavat vielä laskea mäkeä, mutta äiti ei ollut samaa mieltä, ja niin he "
              "jäivät sisälle pelaamaan. Seuraavana päivänä aurinko paistoi ja piha oli jo melkein kuiva, eikä lunta enää näkynyt missään muualla.",
        "ru": "Утром мы вышли из дома и пошли к реке, потому что погода была хорошая и никто не хотел сидеть в комнате. По дороге встретили соседа, "
              "он сказал, что на мосту идёт ремонт и надо обходить через парк. Мы так и сделали, а потом долго сидели на берегу, смотрели на воду и "
              "говорили о том, что было летом. Вернулись поздно, уже в темноте, и сразу легли спать.",
        # not in the list: Swahili
        "sw": "Asubuhi watoto walikwenda shule kwa miguu kwa sababu basi halikuja kwa wakati. Mwalimu aliwaambia kwa upole kwamba mvua ya jana iliharibu "
              "barabara ya mji na daraja la mto. Baada ya masomo walirudi nyumbani, wakala chakula na kulala mapema. Siku ya pili jua liliwaka na watu wa "
              "kijiji walianza kutengeneza barabara pamoja na vijana wote wa shule na wazee wa mtaa.",
    }
    rows = [(i, text, lang) for i, text in enumerate(texts.values()) for lang in (None, "en", "xx")]
    judged = quality.assess(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert len(judged) == 12 and all(r.kept for r in judged), [(r.doc_id, r.broken, r.n_words) for r in judged if not r.kept]


def test_quality_takes_columns_of_any_name(spark, docs):
    odd = docs.selectExpr("doc_id", "text", "source as `a.b`", "kept as `_m`", "doc_id as `m`", "text as `r`", "source as `row`", "1 as `_judged_lang`",
                          "2 as n_words", "3 as `_text`")
    kept = quality.apply_rules(odd)
    assert kept.columns == odd.columns and kept.count() == quality.apply_rules(docs).count()
    judged = quality.assess(odd)
    assert set(odd.columns) <= set(judged.columns) and judged.count() == odd.count()
    assert judged.where("n_words = 2").count() < odd.count()
    assert sorted(str(tuple(r)) for r in kept.select("m", "`a.b`", "r").collect()) == sorted(
        str(tuple(r)) for r in quality.apply_rules(docs).select("doc_id", "source", "text").collect())


def test_quality_filter_keeps_columns_and_uses_no_python(spark, docs):
    kept = quality.apply_rules(docs)
    assert kept.columns == docs.columns
    assert kept.count() == quality.assess(docs).where("kept").count()
    plan = quality.assess(docs.select("doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert quality.assess(docs.limit(0)).count() == 0


def test_a_rule_table_of_ones_own(spark):
    docs = spark.createDataFrame([(1, "one two three " * 30), (2, "one two " * 40)], "doc_id long, text string")
    strict = [quality.Rule("three", "n_words", "word_chars", most=1)]
    assert {r.doc_id: r.broken for r in quality.assess(docs, rules=strict).collect()} == {1: ["three"], 2: ["three"]}


def water_fill(sizes, weights):
    total = sum(sizes.values())
    order = sorted([s for s in sizes if s is not None]) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    fixed, target = set(), {}
    while True:
        rest = total - sum(3 * sizes[s] for s in fixed)
        free = [s for s in order if s not in fixed]
        target = {s: 3.0 * sizes[s] for s in fixed} | {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if target[s] > 3 * sizes[s]}
        if not over:
            return target
        fixed |= over


def test_mixing_targets_and_words_taken(spark, docs):
    rows = mixing.mix_sources(docs).collect()
    again = mixing.mix_sources(docs.repartition(7)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    sizes, source_of = collections.Counter(), {}
    for doc_id, text, source, _ in corpus():
        sizes[source] += len(WORD.findall(text or ""))
        source_of[doc_id] = source
    targets = water_fill(sizes, mixing.WEIGHTS)
    taken, largest = collections.Counter(), collections.Counter()
    for r in rows:
        s = source_of[r.doc_id]
        assert r.source_size == sizes[s] and abs(r.target - targets[s]) < 1e-6 * max(1, targets[s])
        assert r.taken <= 3 * r.size and r.taken == r.size * r.repeats == r.size * len(r.positions)
        assert all(0 <= p <= 1 for p in r.positions) and r.positions == sorted(r.positions)
        taken[s] += r.taken
        largest[s] = max(largest[s], r.size)
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= max(1, largest[s]), s
    assert len(rows) == len(corpus())


def test_mixing_positions_follow_the_schedule(spark):
    docs = spark.createDataFrame([(i, "w " * 10, "abc"[i % 3]) for i in range(600)], "doc_id long, text string, source string")
    rows = mixing.mix_sources(docs).collect()
    for source, knots in zip("abc", (mixing.SCHEDULES[w] for w in (1, 2, 3))):
        at = sorted(p for r in rows if "abc"[r.doc_id % 3] == source for p in r.positions)
        early = sum(p < 0.5 for p in at) / len(at)
        total = sum((g0 + g1) / 2 * (t1 - t0) for (t0, g0), (t1, g1) in zip(knots, knots[1:]))
        middle = knots[1][1] if len(knots) == 3 else (knots[0][1] + knots[-1][1]) / 2
        assert abs(early - (knots[0][1] + middle) / 4 / total) < 0.02
    ordered = mixing.training_documents(docs)
    assert ordered.columns == docs.columns and ordered.count() == sum(r.repeats for r in rows)
    assert mixing.mix_sources(docs.limit(0)).count() == 0
    assert mixing.training_documents(docs.limit(0)).count() == 0


def test_mixing_sources_without_words(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (3, "x y", None)], "doc_id long, text string, source string")
    rows = {r.doc_id: r for r in mixing.mix_sources(docs).collect()}
    assert [rows[i].taken for i in (1, 2)] == [0, 0] and rows[3].taken == 2


def brute_capacity(sizes, shards):
    def fits(capacity):
        used, now = 1, 0
        for s in sizes:
            if s > capacity:
                return False
            if now + s > capacity:
                used, now = used + 1, 0
            now += s
        return used <= shards
    return next(c for c in range(max(sizes), sum(sizes) + 1) if fits(c))


@pytest.mark.parametrize("summary", [4, 64, 16_384])
def test_minimax_cuts_are_exact_at_every_summary_size(spark, monkeypatch, summary):
    monkeypatch.setattr(sharding, "SUMMARY_ROWS", summary)
    rng = random.Random(summary)
    for shards, n, heavy in ((3, 40, 0), (8, 60, 500), (8, 5, 0)):
        firsts = sorted(rng.sample(range(-1000, 100_000), n))
        sizes = [rng.randrange(1, 60) for _ in firsts]
        sizes[n // 2] += heavy
        groups = spark.createDataFrame(list(zip(firsts, sizes)), "first long, bytes long")
        capacity, cuts = sharding.minimax_cuts(groups, shards)
        assert capacity == brute_capacity(sizes, shards)
        loads = collections.Counter()
        for first, size in zip(firsts, sizes):
            loads[sum(c <= first for c in cuts)] += size
        assert max(loads.values()) <= capacity and len(cuts) < shards


def test_sharding_rows(spark, docs):
    rows = sharding.shard_documents(docs).collect()
    text = collections.defaultdict(set)
    by_id = {}
    for doc_id, t, *_ in corpus():
        by_id[doc_id] = (t or "").encode()
    for r in rows:
        body = by_id[r.doc_id]
        assert (r.size, r.text_crc32) == (len(body) + 1, zlib.crc32(body))
        text[body].add(r.shard)
    assert all(len(s) == 1 for s in text.values())
    for shard in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert len(rows) == len(corpus())
    assert sharding.shard_documents(docs.limit(0)).count() == 0
