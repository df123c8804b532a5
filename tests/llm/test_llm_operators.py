"""The operators on small tables, against brute force, the library or held-out lines."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from tallyguard.llm.exact_dedup import drop_copies, exact_groups
from tallyguard.llm.minhash import near_groups
from tallyguard.llm.mixing import mix_sources, take_mix, with_targets
from tallyguard.llm.piece_encoding import PieceEncoder, encode_and_decode
from tallyguard.llm.quality import quality
from tallyguard.llm.secret_scan import SecretParams, _made_up, scan_secrets, tokens_and_features, train, trained
from tallyguard.llm.sentence_dedup import remove_repeated_sentences
from tallyguard.llm.suffix_array import common_prefixes, suffix_array
from tallyguard.llm.suffix_dedup import SuffixParams, remove_repeats
from tallyguard.llm.token_counts import PieceCounter, count_tokens
from tallyguard.llm.url_filter import Segmenter, filter_urls

SCHEMA = "doc_id long, text string, lang string, source string, key string, norm string"
PAGES = "page_id long, url string, html string, host string"
WORDS = "river stone market winter garden letter window summer castle bridge forest".split()


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 99)) for _ in range(n)) + "."


def rows():
    """Nulls in every column, empty, blank and long texts, repeated rows, clashing column names."""
    base = prose(400, 1)
    texts = [base, base, base.replace(" ", "\n"), base + " more words", prose(60, 2), "", None, " \t\n", prose(9000, 3), "few words"]
    found = [(i, t, "en" if i % 2 else None, None if i == 4 else f"s{i % 3}", "k", None) for i, t in enumerate(texts)]
    return found + [found[4], (None, "no identifier here", None, None, None, None), (None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_groups(docs, empty):
    got = exact_groups(docs).collect()
    assert len(got) == len(rows())
    by_text = {}
    for r in rows():
        by_text.setdefault(hashlib.sha256(norm(r[1]).encode()).hexdigest(), []).append(r[0])
    for r in got:
        ids = by_text[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == min((i for i in ids if i is not None), default=None)
    assert sum(r.kept for r in got) == len(by_text)
    kept = drop_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len(by_text)
    assert exact_groups(empty).count() == 0


def test_near_groups(docs, empty):
    got = {(r.doc_id, r.n_shingles): r for r in near_groups(docs).collect()}
    assert {k[0]: r.component_id for k, r in got.items() if k[0] in (0, 1, 2, 3)} == {0: 0, 1: 0, 2: 0, 3: 0}
    assert got[(9, 1)].kept and got[(5, 0)].component_id == 5 and got[(6, 0)].kept
    assert near_groups(docs).count() == len(rows())
    assert near_groups(empty).count() == 0


def test_suffix_array_by_brute_force():
    rng = random.Random(4)
    for trial in range(60):
        text = bytes(rng.choice(b"ab\xff" if trial % 2 else b"abcd") for _ in range(rng.randint(1, 120))) * (1 + trial % 3)
        order = suffix_array(np.frombuffer(text, np.uint8))
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
        shared = common_prefixes(np.frombuffer(text, np.uint8), order).tolist()
        for k in range(1, len(text)):
            a, b = text[order[k - 1] :], text[order[k] :]
            assert shared[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def brute_repeats(pairs, length=100):
    seen, out = set(), {}
    for doc, text in pairs:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            window = raw[i : i + length]
            gone[i : i + length] |= window in seen
            seen.add(window)
        starts = int((gone & ~np.append(False, gone[:-1])).sum()) if len(raw) else 0
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out[doc] = (len(raw), int(gone.sum()), starts, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("stretches", [10_000, 1])
def test_suffix_dedup(spark, stretches):
    shared = prose(40, 7)
    texts = [prose(80, 8), prose(30, 9) + shared + prose(30, 10), shared, "é" * 130 + shared[:150], "ab" * 200, None, "", shared + shared]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r[0]: tuple(r[1:5]) for r in remove_repeats(frame, params=SuffixParams(stretches=stretches)).collect()}
    assert got == brute_repeats(enumerate(texts))


def test_suffix_dedup_odd_rows(docs, empty):
    got = remove_repeats(docs).collect()
    assert len(got) == len(rows())
    assert sorted(r.n_removed for r in got if r.doc_id == 4) == [0, max(r.n_bytes for r in got if r.doc_id == 4)]
    assert remove_repeats(empty).count() == 0


def test_sentence_spans(spark, docs, empty):
    part = "One two three four five six. Seven eight nine ten eleven. Twelve thirteen fourteen fifteen."
    frame = spark.createDataFrame([(1, f"{prose(9, 1)} {part} End."), (2, f"Start of it. {part} Own end here."), (3, "A. B. C.")], "doc_id long, text string")
    got = {r.doc_id: r for r in remove_repeated_sentences(frame).collect()}
    assert [got[i].n_removed for i in (1, 2, 3)] == [0, 3, 0]
    assert got[2].kept_text == "Start of it. Own end here."
    assert remove_repeated_sentences(docs).count() == len(rows())
    assert remove_repeated_sentences(empty).count() == 0


def test_passages_of_few_or_long_sentences(spark):
    two = prose(25, 31) + " " + prose(26, 32)
    endless = prose(70, 33)[:-1]
    lines = "".join(f"{w} {w}x\n" for w in prose(26, 34).split())
    texts = [f"{prose(4, 41)} {two} {prose(5, 42)}", f"Own start {two} and own end.", f"so it goes {endless} on and on", f"quite other {endless} words here", "Top.\n" + lines + "End.", lines + "Tail.", prose(14, 35), prose(14, 35), two, prose(300, 36)]
    got = {r.doc_id: r for r in remove_repeated_sentences(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i].n_removed > 0 for i in range(10)] == [False, True] * 3 + [False, True, True, False]
    assert got[7].kept_text == got[8].kept_text == ""
    assert "Own start" in got[1].kept_text and len(got[3].kept_text.split()) < 25 and got[5].kept_text == "Tail."


def test_secrets(docs, empty, spark):
    frame = spark.createDataFrame([(1, 'é password = "abcdefgh1" AKIAABCDEFGHIJKL ' + "0a" * 20), (2, "token: short"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in scan_secrets(frame).collect()}
    assert (got[1].n_assign, got[1].n_access, got[1].n_hex) == (1, 1, 1)
    assert got[1].spans.startswith("assign:2:23,access:25:41,hex:42:82")
    assert (got[2].n_assign, got[3].spans) == (0, "")
    assert scan_secrets(docs).count() == len(rows())
    assert scan_secrets(empty).count() == 0


def test_field_on_held_out_lines(spark, docs):
    field = trained(docs.selectExpr("doc_id", "coalesce(text, '') text"), SecretParams())
    hits = 0
    held_out = _made_up(SecretParams(seed=99, made_up=120))
    for line, start, end in held_out:
        data = np.frombuffer(line.encode(), np.uint8)
        starts, ends, row, x = tokens_and_features(data, np.array([0, len(data)]))
        hits += any(starts[a] <= start and ends[b] >= end for a, b in field.secrets(field.scores(x), row))
    assert hits >= 0.9 * len(held_out)
    data = np.frombuffer(b"plain words of a letter that goes on and on without any of it", np.uint8)
    starts, _, row, x = tokens_and_features(data, np.array([0, len(data)]))
    assert field.secrets(field.scores(x), row) == [] and train is not None


ODD = ["", " ", "  a  b\n\tc ", "x ▁ y", "aaaa" * 300, "日本語 😀 ñandú", " lead", "trail ", "a\x00b <s> <0x0A>", "ab" * 3000 + " c", None, "1 2  3   4"]


def test_tokens_equal_the_library(docs, empty):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    want = [library.encode(t or "") for t in ODD]
    assert [x.tolist() for x in PieceEncoder(path).encode(pa.array(ODD, pa.string()))] == want
    assert PieceCounter(path).counts(pa.array(ODD, pa.string())).tolist() == [len(x) for x in want]
    got = {(r.doc_id, r.n_bytes): r.n_tokens for r in count_tokens(docs).collect()}
    assert all(got[(r[0], len((r[1] or "").encode()))] == len(library.encode(r[1] or "")) for r in rows())
    coded = encode_and_decode(docs).collect()
    assert len(coded) == len(rows()) and all(r.exact for r in coded)
    assert count_tokens(empty).count() == 0 and encode_and_decode(empty).count() == 0


def test_mixing(docs, empty, spark):
    plan = with_targets(spark.createDataFrame([("a", 10, 1), ("b", 100, 2), ("c", 10, 3)], "source string, size long, weight long"))
    assert {r.source: r.target for r in plan.collect()} == {"a": 30.0, "b": 60.0, "c": 30.0}
    frame = spark.createDataFrame([(i, prose(5 + i % 40, i), f"s{i % 4}") for i in range(3000)], "doc_id long, text string, source string")
    got = mix_sources(frame, block_rows=64, fan_in=4).toPandas()
    sums = got.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    assert (abs(sums.taken - sums.target) <= got["size"].max()).all() and got.copies.max() <= 3
    again = mix_sources(frame, block_rows=64, fan_in=4).toPandas()
    assert got.sort_values("doc_id").taken.tolist() == again.sort_values("doc_id").taken.tolist()
    assert mix_sources(docs).count() == len(rows()) and mix_sources(empty).count() == 0
    assert take_mix(docs).columns == docs.columns


def test_quality(docs, empty):
    got = {(r.doc_id, r.n_words): r for r in quality(docs).collect()}
    assert sum(1 for _ in quality(docs).collect()) == len(rows())
    assert got[(0, 400)].n_repeat_words == 0 and got[(5, 0)].base_failed and not got[(9, 2)].kept
    assert quality(empty).count() == 0


def test_quality_counts(spark):
    text = "a b c d e a b c d e x\nsame line\n\nsame line\n #$ <|>"
    got = quality(spark.createDataFrame([(1, text, "en")], "doc_id long, text string, lang string")).first()
    assert (got.n_words, got.word_chars, got.n_symbols, got.n_dup_lines, got.n_repeat_words) == (17, 32, 5, 1, 10)


def test_urls(spark):
    counts = {"cheap": 90, "pills": 80, "garden": 70, "pill": 5, "s": 2}
    assert Segmenter(counts).split("cheappills") == ("cheap", "pills")
    found = [(1, "http://A.Com/x", None, None), (2, "https://www.example.com/en/1?q", "<p>cheap pills</p>", None), (3, "http://b.example.com/en/", None, None),
             (4, "x", None, None), (5, None, None, None), (6, "http://m.net/es/#a", None, None), (7, "http://casinoslots.org/win", None, None)]
    got = {r.page_id: r for r in filter_urls(spark.createDataFrame(found, PAGES)).collect()}
    assert [got[i].rule for i in range(1, 8)] == ["com/", "www.example.com/en/", "example.com/en/", None, None, "net/es/", None]
    assert [got[i].verdict for i in range(1, 8)] == ["allow", "allow", "block", "allow", "allow", "block", "block"]
    assert (got[1].host, got[1].path, got[4].host) == ("a.com", "/x", "")
    assert filter_urls(spark.createDataFrame([], PAGES)).count() == 0


def test_url_models_keep_rare_words(spark):
    letters = "bcdfhjlm"
    common = ["".join(letters[i // 8**k % 8] for k in range(6)) for i in range(60_000)]
    html = " ".join(common * 2) + " quokka garden"
    paths = [(10 + i, "http://a.com/" + "/".join(common[i::60] * 2), None, None) for i in range(60)]
    found = [(1, "http://quokkagarden.org/zzz/yyy", html, None), (2, "http://m.net/es/zzz/yyy", None, None), *paths]
    got = {r.page_id: r for r in filter_urls(spark.createDataFrame(found, PAGES)).collect()}
    assert len(got) == 62
    assert got[1].tokens == ["h:quokka", "h:garden", "p:zzz", "p:yyy"]
    assert (got[1].rule, got[1].verdict) == (None, "block")
