"""Sentence spans against a plain version on strings: no hashes, no slices."""

import hashlib
import random
import re

import numpy as np
import pytest

from tallyguard.llm.sentence_dedup import SpanParams, cut_sentences, remove_repeated_sentences

SPACE = "\x20\x09-\x0d"
WORD = re.compile(f"[^{SPACE}]+")
MARKS = ["", "", "", "", ".", "!", "?", "...", ",", "é."]
GAPS = [" ", " ", " ", " ", "  ", "\n", " \n\t", "\x0b", "\r\n"]


def cut(texts, params):
    """The operator's own sentences as strings."""
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    borders = np.cumsum([0] + [len(t) for t in raw])
    found = cut_sentences(data, borders, params)
    whole = data.tobytes()
    return [[whole[found.starts[i] : found.ends[i]].decode() for i in range(a, b)] for a, b in zip(found.first, found.last)]


def plain_sentences(text):
    """By the rule of ends alone, without cuts inside long sentences."""
    out, start = [], 0
    for end in [m.end() for m in re.finditer(rf"[.!?]+[{SPACE}]+|\n[{SPACE}]*", text)] + [len(text)]:
        if WORD.search(text, start, end):
            out.append(text[start:end])
            start = end
    return out + [text[start:]] * (start < len(text))


def random_text(rng, n, words=30):
    if not n:
        return rng.choice(["", " \n ", "\t"])
    parts = [f"w{rng.randrange(words)}" + rng.choice(MARKS) + rng.choice(GAPS) for _ in range(n)]
    return rng.choice(["", " ", "\n"]) + "".join(parts) + rng.choice(["", ".", " \n"])


def test_sentence_ends():
    rng = random.Random(5)
    texts = [random_text(rng, rng.randrange(60)) for _ in range(400)]
    assert cut(texts, SpanParams(long_words=10**6)) == [plain_sentences(t) for t in texts]


def test_long_sentences_are_cut_by_the_words_nearby():
    rng, params = random.Random(6), SpanParams()
    passage = " ".join(f"p{rng.randrange(10**6)}" for _ in range(60))
    texts = [" ".join(f"{k}x{i}" for i in range(rng.randrange(40))) + " " + passage + " " + " ".join(f"{k}y{i}" for i in range(rng.randrange(40))) for k in range(50)]
    found = cut(texts, params)
    assert ["".join(s) for s in found] == texts
    assert max(len(p.split()) for s in found for p in s[1:-1]) <= params.cut_window
    # Sixteen words from the ends of the passage on, all have the same cuts.
    inner = passage.split()[16:-16]
    places = [{p.split()[0] for p in s} & set(inner) for s in found]
    assert len(places[0]) > 2 and all(p == places[0] for p in places)


def plain_runs(sizes, p):
    """All shortest runs with enough words from each start and to each end, by trying every stretch."""
    n = len(sizes)
    if n < p.span:
        return {(0, n)} if n and sum(sizes) >= p.min_words else set()
    good = {(a, b) for a in range(n) for b in range(a + p.span, min(n, a + p.span + p.min_words) + 1) if sum(sizes[a:b]) >= p.min_words}
    found = {(i, 1) for i in range(n) if sizes[i] >= 2 * p.min_words}
    for i in range(n + 1):
        ahead, behind = [b for a, b in good if a == i], [a for a, b in good if b == i]
        if ahead:
            found.add((i, min(ahead) - i))
        if behind:
            found.add((max(behind), i - max(behind)))
    return found


def plain_removal(rows, params):
    """doc_id, sentences, removed ones and the kept text of each row; identifiers are all different."""
    texts = [t or "" for _, t in rows]
    parts = cut(texts, params)
    first, runs = {}, []
    for (doc, _), sentences in zip(rows, parts):
        words = [WORD.findall(s) for s in sentences]
        runs.append([(i, n, " ".join(w for s in words[i : i + n] for w in s)) for i, n in plain_runs([len(w) for w in words], params)])
        for i, n, run in runs[-1]:
            first[run] = min(first.get(run, (doc, i)), (doc, i))
    out = []
    for (doc, _), sentences, own in zip(rows, parts, runs):
        gone = {k for i, n, run in own if first[run] != (doc, i) for k in range(i, i + n)}
        kept = "".join(s for k, s in enumerate(sentences) if k not in gone)
        out.append((doc, len(sentences), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out)


@pytest.mark.parametrize("params", [SpanParams(), SpanParams(slice_bytes=300), SpanParams(span=3, min_words=5, long_words=8, cut_window=4)])
def test_equals_the_plain_version(spark, params):
    rng = random.Random(params.slice_bytes + params.span)
    shared = [random_text(rng, rng.randrange(5, 60), 5000) for _ in range(8)]
    texts = []
    for _ in range(150):
        pieces = [random_text(rng, rng.randrange(30), 5000) if rng.random() < 0.6 else rng.choice(shared) for _ in range(rng.randrange(5))]
        texts.append("".join(pieces))
    texts += [None, "", " \n", texts[3], texts[3], shared[0] * 40]
    ids = rng.sample(range(-1000, 1000), len(texts))
    rows = list(zip(ids, texts))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted(tuple(r) for r in remove_repeated_sentences(frame, params=params).collect())
    assert got == plain_removal(rows, params)
    assert sum(r[2] for r in got) > 100


def test_rows_that_share_an_identifier(spark):
    rng = random.Random(9)
    one, other = (" ".join(f"{k}{rng.randrange(10**6)}" for _ in range(80)) + "." for k in "ab")
    rows = [(1, one), (1, one), (1, other), (1, one), (2, other), (None, one), (None, one), (None, None), (3, "own words only here")]
    frame = spark.createDataFrame([(i, t, "x", "y", "z", 0) for i, t in rows], "doc_id long, text string, twin string, doc string, at string, h long")
    got = remove_repeated_sentences(frame.repartition(3)).collect()
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r.kept_text)
    # Of equal rows one stays; another text under the identifier is not touched.
    assert sorted(by_id[1]) == sorted(["", "", one, other])
    assert by_id[2] == [""] and sorted(by_id[None]) == ["", one, one] and by_id[3] == ["own words only here"]


def test_a_text_of_some_mb(spark):
    rng = random.Random(11)
    long = " ".join(f"w{rng.randrange(10**7)}" for _ in range(400_000))
    rows = [(1, long), (2, "Before it. " + long[1_000_000:1_200_000] + " behind"), (3, "word " * 300_000)]
    got = {r.doc_id: r for r in remove_repeated_sentences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].n_removed == 0 and got[1].kept_text == long
    assert len(got[2].kept_text.split()) < 40
    assert len(got[3].kept_text.split()) < 40


def test_settings_that_cannot_be_packed():
    with pytest.raises(ValueError):
        SpanParams(min_words=5000)
