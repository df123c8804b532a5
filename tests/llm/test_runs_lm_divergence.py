"""Periodic runs, the language model and the source audit, against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from tallyguard.llm.neural_lm import ClassStats, LmParams, LogBilinear, _coded, _counted, score_texts
from tallyguard.llm.oracles import DIVERGENCE
from tallyguard.llm.periodic_runs import _Texts, derivation, find_runs, periodic_runs
from tallyguard.llm.queries import op11_periodic_runs
from tallyguard.llm.source_divergence import DivergenceParams, divergence

SCHEMA = "doc_id long, text string, lang string, source string, n long, word string, rank int"


def word_text(rng, n, k):
    return " ".join(f"w{rng.randrange(k)}" for _ in range(n))


def rows():
    """Nulls in every column, empty and blank texts, repeated rows, periods and a long text."""
    rng = random.Random(3)
    long = word_text(rng, 30_000, 2_000)
    texts = ["", None, " \t\n", "a " * 40, "a b c " * 9 + "d", "one two", long + " " + "x y z " * 500, "É é " * 8 + "Z"]
    texts += [word_text(rng, rng.randrange(150), rng.choice([1, 2, 3, 50])) for _ in range(60)]
    found = [
        (i, t, ["en", "fr", None, ""][i % 4], f"s{i % 3}" if i % 5 else None, i, "k", 1) for i, t in enumerate(texts)
    ]
    return [*found, found[4], found[9], (None, "no number here", None, None, None, None, None), (None,) * 7]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def runs_of(w, least=12):
    """All (start, length, period), by trying every period."""
    best = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i < len(w) - q:
            start = i
            while i < len(w) - q and w[i] == w[i + q]:
                i += 1
            if i + q - start >= max(least, 2 * q):
                best.setdefault((start, i + q), q)
            i += 1
    return sorted((s, e - s, q) for (s, e), q in best.items())


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


# The long text's runs by hand: no period among its drawn words, then x y z.
def expected_runs(text):
    w = words(text)
    return runs_of(w) if len(w) < 1_000 else [(30_000, 1_500, 3)]


def test_runs_of_random_texts():
    rng = random.Random(11)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(1, 4)):
            k, n = rng.choice([1, 2, 3, 20]), rng.randint(0, 70)
            w = [rng.randrange(k) for _ in range(n)]
            if n and rng.random() < 0.5:
                a, p = rng.randrange(n), rng.randint(1, 9)
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            texts.append(w)
        codes = np.array(sum(texts, []), np.int64)
        borders = np.concatenate([[0], np.cumsum([len(w) for w in texts])]).astype(np.int64)
        start, end, period = find_runs(codes, borders, 12)
        want = [(b + s, n, q) for w, b in zip(texts, borders.tolist()) for s, n, q in runs_of(w)]
        assert list(zip(start.tolist(), (end - start).tolist(), period.tolist())) == want


def test_derivation_covers_each_text_and_equal_symbols_are_equal_words():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 4, 600)
    symbol, start, middle, end = derivation(codes, np.array([0, 200, 200, 600]))
    assert len(symbol) == 199 + 399 and ((start < middle) & (middle < end)).all()
    seen = {}
    for s, a, b in zip(symbol.tolist(), start.tolist(), end.tolist()):
        assert seen.setdefault(s, tuple(codes[a:b])) == tuple(codes[a:b])


def test_hashes_that_fail_are_found_out():
    """The sequence on which power sums modulo 2**64 collide still gives the exact runs."""
    w = np.array([bin(i).count("1") % 2 for i in range(1 << 13)], np.int64)
    start, end, period = find_runs(w, np.array([0, len(w)]), 12)
    assert ((end - start) == 2 * period).all() and (w[start] == w[start + period]).all()
    a, b, most = np.array([0, 5]), np.array([3, 9]), np.array([50, 50])
    for step in (1, -1):
        by_hash = _Texts(w, True).agree(a, b, np.minimum(most, a) if step < 0 else most, step)
        assert (by_hash == _Texts(w, False).agree(a, b, np.minimum(most, a) if step < 0 else most, step)).all()


def test_periodic_runs(docs, empty):
    got = sorted(periodic_runs(docs).collect(), key=str)
    want = []
    for doc_id, text, *_ in rows():
        runs = expected_runs(text)
        want.append((doc_id, len(words(text)), runs, collapsed(words(text), runs)))
    assert sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got), key=str) == sorted(want, key=str)
    assert periodic_runs(empty).count() == 0


def test_op11_on_a_written_table(spark, tmp_path):
    rng = random.Random(8)
    data = [(i, word_text(rng, rng.randrange(90), rng.choice([2, 30])) if i % 7 else None) for i in range(80)]
    spark.createDataFrame(data, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op11_periodic_runs(spark, str(tmp_path)).collect()}
    planted = 0
    for doc_id, text in data:
        w, h = words(text), zlib.crc32(str(doc_id).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            planted += 1
        runs, r = runs_of(w), got[doc_id]
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(w, runs).encode()).hexdigest()
    assert planted


LM = LmParams(own_classes=12, end_classes=6, width=6, batch_tokens=256, noise=16)


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


def test_base_scores(docs, empty):
    counts = Counter()
    for doc_id, text, *_ in rows():
        if not held(doc_id):
            counts.update([*words(lower(text)), None])
    total, kinds = sum(counts.values()), len(counts)
    want = []
    for doc_id, text, *_ in rows():
        tokens = [*words(lower(text)), None]
        base = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (kinds + 1))) for t in tokens)
        want.append((doc_id, held(doc_id), len(tokens), sum(t in counts for t in tokens), total, round(base, 4)))
    got = score_texts(docs, LM).collect()
    assert sorted(((*r[:5], round(r.base_score, 4)) for r in got), key=str) == sorted(want, key=str)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)
    assert score_texts(empty, LM).count() == 0


def test_model_learns_and_is_normalised(spark):
    """Words that follow each other in a fixed way become likely; all scores of a context add up to one."""
    rng = random.Random(4)
    cycle = [f"c{i}" for i in range(8)]
    texts = []
    for i in range(600):
        at = rng.randrange(8)
        texts.append((i, " ".join(cycle[(at + k) % 8] for k in range(40))))
    table = spark.createDataFrame(texts, "doc_id long, text string").repartition(2)
    got = [r for r in score_texts(table, LM).collect() if r.held_out]
    # A unigram model gives each word about 1/8; the order is fixed but for the first word.
    assert sum(r.score for r in got) > 0.7 * sum(r.base_score for r in got)
    stats = ClassStats(np.arange(LM.classes), np.ones(LM.classes, np.int64))
    model = LogBilinear.start(stats, LM)
    near, far = np.array([3, 0]), np.array([1, 0])
    table = np.zeros((LM.classes, LM.classes))
    table[near, far] = model.normalisers(near, far)
    for a, b in zip(near, far):
        all_classes = np.arange(LM.classes)
        each = model.log_probabilities(all_classes, np.full(LM.classes, a), np.full(LM.classes, b), table)
        assert abs(np.exp(each).sum() - 1) < 1e-9


def audit(data):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", data)
    return sorted(con.execute(DIVERGENCE).fetchall())


@pytest.fixture(scope="module")
def sourced(spark):
    rng = random.Random(6)
    names = "stone river Été ÉTÉ été it's lake night garden market bridge".split() + [f"t{c}" for c in "abcdefghij"]
    data = []
    for i in range(700):
        weights = [1 + (k * (i % 9)) % 7 for k in range(len(names))]
        text = " ".join(rng.choices(names, weights, k=rng.randrange(25))) if i % 11 else None
        lang, source = ["en", "fr", None][i % 3], f"s{i % 9}" if i % 8 else None
        data.append((i // 2, text, lang, source))
    data += [(1, "rare words only", "xx", "a"), (2, "", "xx", "b"), (3, None, "yy", None), (4, "1234 _", "en", "lonely")]
    return data


@pytest.mark.parametrize("tile", [256, 3, 1])
def test_divergence_equals_its_sql(spark, sourced, tile):
    table = spark.createDataFrame(sourced, "doc_id long, text string, lang string, source string").repartition(3)
    got = divergence(table.withColumn("rank", table.doc_id).withColumn("p", table.doc_id), DivergenceParams(tile=tile))
    assert sorted(tuple(r) for r in got.collect()) == audit(sourced)


def test_divergence_edges(spark, docs, empty):
    plain = [(r[0], r[1], r[2], r[3]) for r in rows()]
    assert sorted(tuple(r) for r in divergence(docs).collect()) == audit(plain)
    assert divergence(empty).count() == 0


def test_a_word_on_top_of_no_slice_has_its_class(spark):
    """Each text is a slice of its own, in which ``common`` comes second; in all of them it comes first."""
    params = LmParams(own_classes=1, held_out=10**9, slice_bytes=1)
    rows = [(n, f"top{n} top{n} top{n} common common") for n in range(1, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    words = _counted(_coded(docs, params, "doc_id", "text"), params).where("class = 1")
    assert {(r.code, r.c) for r in words.collect()} == {(2, 8)}
