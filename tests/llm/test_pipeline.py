"""The pipeline stage by stage and as a whole, against plain versions of its rules."""

import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from tallyguard.llm.exact_dedup import drop_copies
from tallyguard.llm.minhash import one_of_each
from tallyguard.llm.mixing import mix_sources, take_mix
from tallyguard.llm.quality import QualityParams, keep_good

SPACES = re.compile(r"[\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, `row` string, `_key` string, `_all` long, `_copy` string, sha string, `_lang` string"


def words_of(text):
    return [w for w in SPACES.split(text or "") if w]


def plain_texts():
    """Prose of two languages, exact copies, near copies, chains of near copies, bad texts and nulls."""
    rng = random.Random(12)
    common = {"en": "the of and to in is that it was for".split(), "de": "der die und in den von zu das mit sich".split()}
    texts = []
    for i in range(150):
        lang = ("en", "de")[i % 2]
        size = rng.choice([12, 30, 90, 200])
        words = [rng.choice(common[lang]) if rng.random() < 0.4 else "w" + "".join(rng.choices("abcdefghij", k=6)) for _ in range(size)]
        texts.append((" ".join(words), lang))
        if i % 10 == 0:
            texts.append((" \n".join(words), lang))
        if i % 7 == 0 and size >= 90:
            for k in range(1, 4):  # each one word further from the first
                words = words[: 20 * k] + ["changed"] + words[20 * k + 1 :]
                texts.append((" ".join(words), lang))
    texts += [(None, "en"), ("", None), ("too few words", "de"), ("a b c d e " * 20, "en"), ("#|<> " * 30 + "1234 " * 60, "en")]
    texts += [(" ".join(f"ÄÖÜ{k}{j}" for j in range(60)), "en") for k in range(2)]
    return texts


def plain_rows():
    rng = random.Random(13)
    found = [(i, t, lang, rng.choice(["web", "books", "code", None]), "r", "k", 7, None, "s", "l") for i, (t, lang) in enumerate(plain_texts())]
    rng.shuffle(found)
    return found


def js(p, q):
    def part(a, m):
        return a * math.log2(a / m) if a else 0.0

    return math.sqrt(max(sum((part(a, (a + b) / 2) + part(b, (a + b) / 2)) / 2 for a, b in zip(p, q)), 0.0))


def shares(counts):
    return [c / max(sum(counts), 1) for c in counts]


def plain_good(rows, params=QualityParams()):
    """Identifiers of the rows that the quality rules keep."""
    by_lang = defaultdict(list)
    for r in rows:
        by_lang[r[2] or ""].append(r)
    kept = set()
    for group in by_lang.values():
        counts = Counter(w for r in group for w in words_of(r[1]))
        top = [w for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0].encode()))[: params.common_words]]
        passed = []
        for r in group:
            text, words = r[1] or "", words_of(r[1])
            places = defaultdict(list)
            for i in range(len(words) - 4):
                places[tuple(words[i : i + 5])].append(i)
            again = {k for p in places.values() if len(p) > 1 for i in p for k in range(i, i + 5)}
            if len(words) < 10 or 100 * len(again) > 20 * len(words):
                continue
            tests = ["[a-z]", "[A-Z]", "[0-9]", r"[^\x00-\x7f]", r"[\x20\x09-\x0D]", r"[#*$%&|<>]"]
            classes = [len(re.findall(t, text)) for t in tests]
            hits = [words.count(w) for w in sorted(top)]
            passed.append((r[0], len(words), [*classes, len(text) - sum(classes)], [*hits, len(words) - sum(hits)]))
        if not passed:
            continue
        ref_classes = shares([sum(c) for c in zip(*(p[2] for p in passed))])
        ref_hits = shares([sum(c) for c in zip(*(p[3] for p in passed))])
        for name, n, classes, hits in passed:
            far = js(shares(classes), ref_classes) > params.max_class_distance or js(shares(hits), ref_hits) > params.max_word_distance
            if n < params.min_divergence_words or not far:
                kept.add(name)
    return kept


def plain_first_of_equal(rows):
    first = {}
    for r in rows:
        key = SPACES.sub(" ", r[1] or "")
        first[key] = min(first.get(key, r[0]), r[0])
    return set(first.values())


def plain_first_of_near(rows):
    sets, label = {}, {}
    for r in rows:
        words = words_of(re.sub("[A-Z]", lambda m: m.group().lower(), r[1] or ""))
        sets[r[0]] = {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()
        label[r[0]] = r[0]
    names = sorted(sets)

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                one, two = root(a), root(b)
                label[max(one, two)] = min(one, two)
    return {x for x in names if root(x) == x}


def plain_targets(sizes, weights, most=3):
    """Shares by weight in exact fractions; what is above goes to the others until none is above."""
    found, left, todo = [Fraction(0)] * len(sizes), Fraction(sum(sizes)), list(range(len(sizes)))
    while todo:
        total = sum(weights[i] for i in todo)
        above = [i for i in todo if left * weights[i] > most * sizes[i] * total]
        if not above:
            for i in todo:
                found[i] = left * weights[i] / total
            return found
        for i in above:
            found[i] = Fraction(most * sizes[i])
        left -= sum(found[i] for i in above)
        todo = [i for i in todo if i not in above]
    return found


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(plain_rows(), SCHEMA).repartition(5).cache()


def test_each_filtering_stage_keeps_what_its_rule_keeps(docs):
    rows = plain_rows()
    for stage, plain in ((keep_good, plain_good), (drop_copies, plain_first_of_equal), (one_of_each, plain_first_of_near)):
        got = stage(docs)
        want = plain(rows)
        assert got.columns == docs.columns and 0 < len(want) < len(rows)
        assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == sorted((r for r in rows if r[0] in want), key=lambda r: r[0])


def test_stages_on_repeated_rows_and_null_identifiers(spark):
    text = " ".join(f"word{i}" for i in range(30))
    rows = [(1, text), (1, text), (1, text + " more"), (None, text), (None, None), (2, text.replace(" ", "\t"))]
    rows = [(i, t, None, None, None, None, None, None, None, None) for i, t in rows]
    odd = spark.createDataFrame(rows, SCHEMA)
    assert sorted((r.doc_id or 0, r.text or "") for r in drop_copies(odd).collect()) == sorted([(1, text), (1, text + " more"), (0, "")])
    assert sorted(r.doc_id or 0 for r in one_of_each(odd).collect()) == [0, 0, 1]
    mix = take_mix(odd)
    # One source: as many words as there are, near enough, and no row more than three times.
    assert mix.columns == odd.columns and all(n <= 3 * 2 for n in Counter((r.doc_id, r.text) for r in mix.collect()).values())
    none = spark.createDataFrame([], SCHEMA)
    for stage in (keep_good, drop_copies, one_of_each, take_mix):
        assert stage(none).columns == none.columns and stage(none).count() == 0


def test_targets_of_many_sources(spark):
    rng = random.Random(14)
    names = [f"s{rng.randrange(10**6):06d}" for _ in range(300)] + ["", "Ä", "😀", "￮", None]
    names = sorted(set(names), key=lambda x: (x is None, x or ""))
    # Sizes over many powers of two: several rounds of stopped sources.
    sizes = [rng.choice([0, 1, 3, 2 ** (i % 9), 2 ** (i % 9)]) for i in range(len(names))]
    rows = [(i, "w " * n, name) for i, (name, n) in enumerate(zip(names, sizes))]
    got = {r.source: r for r in mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)).collect()}
    want = plain_targets(sizes, [1 + i % 3 for i in range(len(sizes))])
    assert len(got) == len(names) and sum(t == 3 * s for t, s in zip(want, sizes)) > 50
    for name, size, goal in zip(names, sizes, want):
        assert got[name].source_size == size and math.isclose(got[name].target, float(goal), abs_tol=1e-9), name
        assert got[name].copies <= 3


def test_pipeline_as_a_whole(spark, docs, tmp_path):
    rows = plain_rows()
    docs.select("doc_id", "text", "lang", "source").write.parquet(f"{tmp_path}/documents.parquet")
    good = plain_good(rows)
    rows = [r for r in rows if r[0] in good]
    first = plain_first_of_equal(rows)
    rows = [r for r in rows if r[0] in first]
    apart = plain_first_of_near(rows)
    left = {r[0]: r for r in rows if r[0] in apart}
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    copies = Counter(r.doc_id for r in got)
    assert set(copies) <= set(left) and max(copies.values()) <= 3
    for r in got:
        assert r.exact and list(r.ids) == library.encode(left[r.doc_id][1]) and r.n_ids == len(r.ids)
    names = sorted({r[3] for r in left.values()}, key=lambda x: (x is None, x or ""))
    sizes = [sum(len(words_of(r[1])) for r in left.values() if r[3] == name) for name in names]
    for name, goal in zip(names, plain_targets(sizes, [1 + i % 3 for i in range(len(names))])):
        taken = sum(copies[i] * len(words_of(r[1])) for i, r in left.items() if r[3] == name)
        assert abs(taken - goal) <= max(len(words_of(r[1])) for r in left.values() if r[3] == name), name
    assert Counter(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == copies
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "near_dedup", "mixing", "encoding"]
