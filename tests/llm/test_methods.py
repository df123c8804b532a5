"""Where a method decides: exact decoding, spans beyond the patterns, split names, common words of any length."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from tallyguard.llm.quality import QualityParams, common_words, keep_good, quality
from tallyguard.llm.secret_scan import BEGIN, INSIDE, OUTSIDE, Field, scan_secrets
from tallyguard.llm.url_filter import filter_urls


def spans_of(tags):
    found = []
    for t in np.flatnonzero(tags == BEGIN):
        stop = t
        while stop + 1 < len(tags) and tags[stop + 1] == INSIDE:
            stop += 1
        found.append((int(t), int(stop)))
    return found


def test_pruned_decoding_equals_full_decoding():
    rng, n_spans = np.random.default_rng(3), 0
    for turn in range(3000):
        pairs = rng.uniform(-2, 2, (3, 3))
        pairs[OUTSIDE, INSIDE] = -30
        field = Field(np.zeros((1, 3)), pairs)
        n = int(rng.integers(1, 40))
        scores = rng.normal(0, rng.choice([1, 3, 8]), (n, 3))
        scores[:, OUTSIDE] += rng.choice([0, 4, 9])
        row = np.sort(rng.integers(0, 3, n))
        want = []
        for r in np.unique(row):
            first = int(np.searchsorted(row, r))
            want += [(a + first, b + first) for a, b in spans_of(field.decode(scores[row == r]))]
        assert field.secrets(scores, row) == want
        n_spans += len(want)
    assert n_spans > 2000


def test_field_spans_beyond_the_patterns(spark):
    """Secrets in lines that no pattern has, in long documents of their own, and clean documents beside them."""
    rng = random.Random(8)
    signs = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    plain = lambda n: " ".join(rng.choice("river stone market winter garden letter window".split()) for _ in range(n))
    rows, secrets = [], {}
    for i in range(60):
        secret = "".join(rng.choice(signs) for _ in range(30)) + "7aB"
        lead = plain(80) + ". my password is "
        secrets[i] = (len(lead), len(lead) + len(secret))
        rows.append((i, lead + secret + " and " + plain(80)))
    rows += [(100 + i, plain(200)) for i in range(40)]
    got = {r.doc_id: r for r in scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    spans = {i: [(int(a), int(b)) for a, b in re.findall(r"crf:(\d+):(\d+)", got[i].spans)] for i in got}
    hit = sum(any(a <= s and e <= b for a, b in spans[i]) for i, (s, e) in secrets.items())
    assert hit >= 54
    assert all(not spans[i] for i in range(100, 140))


def test_a_host_named_on_its_own_page_is_split(spark):
    text = "winter garden market stone river window letter " * 20
    names = ["wintergarden", "stonemarket", "riverwindow", "letterstone"]
    rows = [(i, f"https://www.{n}.org/a/{i}", f"<html><script>var {n}=1</script><p>{text} see https://{n}.org/a or {n}.org</p><!-- {n} --></html>", None) for i, n in enumerate(names)]
    got = filter_urls(spark.createDataFrame(rows, "page_id long, url string, html string, host string")).collect()
    words = {r.page_id: [t[2:] for t in r.tokens if t.startswith("h:")] for r in got}
    assert words == {0: ["winter", "garden"], 1: ["stone", "market"], 2: ["river", "window"], 3: ["letter", "stone"]}


def test_names_are_split_on_a_page_of_long_words(spark):
    long = "x" * 40
    rows = [(1, "https://wintergarden.org/", f"winter garden {long} {long}", None), (2, None, None, None)]
    got = {r.page_id: r for r in filter_urls(spark.createDataFrame(rows, "page_id long, url string, html string, host string")).collect()}
    assert got[1].tokens == ["h:winter", "h:garden"] and got[2].tokens == []


def test_common_words_have_any_length(spark):
    rows = [(1, "en", "that there would because a a that there would because that " * 3), (2, None, "uncommonlylongword b"), (3, "fr", None)]
    docs = spark.createDataFrame(rows, "doc_id long, _lang string, text string").withColumn("_lang", F.coalesce("_lang", F.lit("")))
    got = {r._lang: r._common for r in common_words(docs, QualityParams(common_words=3)).collect()}
    assert got == {"en": ["that", "there", "would"], "": ["b", "uncommonlylongword"]} or got["en"][0] == "a"
    assert "that" in got["en"]


SPACE = re.compile(r"[\x20\x09-\x0D]+")


def plain_counts(text):
    words = [w for w in SPACE.split(text or "") if w]
    lines = [line for line in (text or "").split("\n") if SPACE.sub("", line)]
    places = {}
    for i in range(len(words) - 4):
        places.setdefault(tuple(words[i : i + 5]), []).append(i)
    again = {k for p in places.values() if len(p) > 1 for i in p for k in range(i, i + 5)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(words) < 10 or 100 * len(again) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(again), failed


def test_quality_counts_equal_plain_ones(spark):
    rng = random.Random(4)
    texts = [None, "", " \n ", "few words", "a b c d e " * 30]
    for _ in range(80):
        words = [rng.choice(["alpha", "be", "#x", "é|<", "日本", "word9"]) + str(rng.randrange(8)) for _ in range(rng.randrange(120))]
        texts.append("".join(w + rng.choice([" ", " ", "\n", "\t ", "\x0b", "\n\n"]) for w in words))
    docs = spark.createDataFrame([(i, t, None, "c", "d") for i, t in enumerate(texts)], "doc_id long, text string, lang string, kept string, n_words string")
    got = {r.doc_id: r for r in quality(docs).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain_counts(t), i
        assert not (r.base_failed and r.kept)
    good = keep_good(docs)
    assert good.columns == docs.columns
    assert sorted(r.doc_id for r in good.collect()) == sorted(i for i in got if got[i].kept)
