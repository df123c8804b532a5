"""URL filter: rules by host and path, then words hidden in host names.

Rules decide first. For other urls a unigram model splits concatenated host
names into words (Viterbi), and a multinomial naive Bayes model scores host and
path tokens. The unigram counts come from the words of all pages, the classes
from all urls that a rule decides, and from a list of words known for spam.

Both models are tables of any size. Urls go in groups of GROUP_ROWS: a group asks a
model for the words it could use, each once, and is judged with the answers.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyguard.llm.common import byte_slices, written

#: Host, path, verdict.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

#: Words that mark unwanted hosts, as prior counts: each counts as seen in blocked urls so often that
#: it has SEED_ODDS before anything is learned, and SEED_COUNT times more as a word of the unigram model.
SEED_WORDS = ("adult", "bet", "bonus", "casino", "cheap", "free", "jackpot", "loan", "pills", "poker", "porn", "replica", "sex", "slots", "viagra", "win", "xxx")
SEED_COUNT = 50
SEED_ODDS = 20

LONGEST_WORD = 24
#: The model blocks only at such odds. Classes weigh alike: rules say nothing of the shares elsewhere.
BLOCK_ODDS = 9.0
#: Urls of a group, and about their bytes of host and path; a longer url is alone.
GROUP_ROWS = 2_000
GROUP_BYTES = 1 << 16

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), "^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def by_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, rule_verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, rule_verdict).otherwise(verdict)
    return name, verdict


class Segmenter:
    """Splits run-together words by the likeliest sequence of unigrams.

    ``total`` is the sum of all counts, where ``counts`` has only some of them.
    """

    def __init__(self, counts: dict[str, int], total: int | None = None) -> None:
        self.total = total or sum(counts.values()) or 1
        self.costs = {w: math.log(self.total) - math.log(n) for w, n in counts.items() if n > 0}
        self.split = lru_cache(maxsize=GROUP_ROWS)(self._split)

    def cost(self, word: str) -> float:
        """An unknown word costs more the longer it is."""
        known = self.costs.get(word)
        return known if known is not None else math.log(self.total) + 1 + len(word) * math.log(10)

    def _split(self, text: str) -> tuple[str, ...]:
        best, back = [0.0], [0]
        for end in range(1, len(text) + 1):
            cost, start = min((best[s] + self.cost(text[s:end]), s) for s in range(max(0, end - LONGEST_WORD), end))
            best.append(cost)
            back.append(start)
        words, end = [], len(text)
        while end:
            words.append(text[back[end] : end])
            end = back[end]
        return tuple(reversed(words))


_RUNS = re.compile(r"[^\W\d_]+|\d+")


def host_runs(host: str) -> Iterator[str]:
    """Runs of letters and of digits, without the last label and www."""
    labels = host.split(".")
    for label in labels[:-1] if len(labels) > 1 else labels:
        if label != "www":
            yield from _RUNS.findall(label)


def url_tokens(host: str, path: str, segmenter: Segmenter) -> list[str]:
    """Host words without the last label and www, and path words; numbers are one token."""
    found = []
    for run in host_runs(host):
        found += ["h:#"] if run.isdigit() else ["h:" + word for word in segmenter.split(run)]
    for run in _RUNS.findall(path.lower()):
        found.append("p:#" if run.isdigit() else "p:" + run)
    return found


def host_substrings(hosts: Iterable[str]) -> set[str]:
    """All that could be a word of these hosts."""
    runs = {run for host in set(hosts) for run in host_runs(host) if not run.isdigit()}
    return {run[i:j] for run in runs for i in range(len(run)) for j in range(i + 1, min(i + LONGEST_WORD, len(run)) + 1)}


#: What is no running text: scripts, styles and comments, tags, and dotted names as in addresses.
#: A host's name would else be a word of its own page, and never be split.
_NO_TEXT = r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>"
_DOTTED = r"[\p{L}\p{N}_-]+(?:\.[\p{L}\p{N}_-]+)+"


def unigram_counts(pages: DataFrame, html_col: str) -> DataFrame:
    """(word, n): all words of the pages' running text, and the known spam words."""
    text = F.regexp_replace(F.coalesce(F.col(html_col), F.lit("")), _NO_TEXT, " ")
    text = F.lower(F.regexp_replace(text, _DOTTED, " "))
    words = pages.select(F.explode(F.split(text, r"[^\p{L}]+")).alias("word"))
    words = words.where("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    seeds = pages.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, SEED_WORDS))).alias("word"), F.lit(SEED_COUNT).cast("long").alias("n"))
    return words.union(seeds).groupBy("word").agg(F.sum("n").alias("n"))


def _log_ratios(told: DataFrame) -> DataFrame:
    """(token, ratio): log P(token | block) - log P(token | allow) of all tokens of urls that a rule decides."""
    row = F.explode("rows").alias("row")
    tokens = told.select(row).where("row.rule_verdict is not null").select((F.col("row.rule_verdict") == "block").alias("b"), F.explode("row.tokens").alias("token"))
    learned = tokens.groupBy("token").agg(F.count_if("b").alias("block"), F.count_if(~F.col("b")).alias("allow"))
    learned = written(learned, "url-token-counts")
    sums = learned.agg(F.count(F.lit(1)).alias("n"), F.sum("block").alias("block"), F.sum("allow").alias("allow")).first()
    all_block, all_allow = ((sums[k] or 0) + sums["n"] + 1 for k in ("block", "allow"))
    prior = F.explode(F.array(*(F.lit("h:" + w) for w in SEED_WORDS))).alias("token")
    seeds = told.sparkSession.range(1).select(prior, F.lit(SEED_ODDS - 1).cast("long").alias("block"), F.lit(0).cast("long").alias("allow"))
    counts = learned.union(seeds).groupBy("token").agg(F.sum("block").alias("block"), F.sum("allow").alias("allow"))
    ratio = (F.log(F.col("block") + 1.0) - math.log(all_block)) - (F.log(F.col("allow") + 1.0) - math.log(all_allow))
    return counts.select("token", ratio.alias("ratio"))


_KINDS = {"long": pa.int64(), "string": pa.string(), "double": pa.float64(), "array<string>": pa.list_(pa.string())}


def _fields(kinds: str) -> str:
    return kinds.replace(" ", ":").replace(",:", ", ")


def _arrow(kinds: str) -> pa.DataType:
    """Arrow's type of a list of rows with these columns."""
    return pa.list_(pa.struct([(name, _KINDS[kind]) for name, kind in (k.split() for k in kinds.split(", "))]))


_ROW = "page_id long, host string, path string, rule string, rule_verdict string"
_TOLD = _ROW + ", tokens array<string>"


def _asked(groups: DataFrame, name: str, wanted: Callable[[list[dict]], set[str]], model: DataFrame) -> DataFrame:
    """``groups`` with ``known``: the model's entries for what ``wanted`` finds in each group's rows."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group, rows in zip(batch.column("group").to_pylist(), batch.column("rows")):
                words = sorted(wanted(rows.as_py()))
                yield pa.record_batch([pa.array([group] * len(words), pa.string()), pa.array(words, pa.string())], names=["group", name])

    asked = groups.mapInArrow(ask, f"group string, {name} string").join(model, name)
    known = asked.groupBy("group").agg(F.collect_list(F.struct(*model.columns)).alias("known"))
    return groups.join(known, "group", "left")


def filter_urls(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    rules=RULES,
) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, score, tokens.

    A url that is null or has no ``://`` has an empty host and path and no tokens;
    it is allowed. Tokens that the model has not seen say nothing for either class.
    Repeated rows are judged alike; other columns are ignored.
    """
    words = written(unigram_counts(pages, html_col), "url-words")
    total = words.agg(F.sum("n")).first()[0]
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rule, verdict = by_rule(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", rule.alias("rule"), verdict.alias("rule_verdict"), F.concat("host", "path").alias("both"))

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, batch.schema.get_field_index("both"), GROUP_BYTES):
                for start in range(0, part.num_rows, GROUP_ROWS):
                    found = part.slice(start, GROUP_ROWS).drop_columns(["both"]).to_pylist()
                    yield pa.record_batch([pa.array([uuid4().hex]), pa.array([found], _arrow(_ROW))], names=["group", "rows"])

    groups = written(rows.mapInArrow(grouped, f"group string, rows array<struct<{_fields(_ROW)}>>"), "url-groups")

    def with_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group, found, known in zip(*(batch.column(c) for c in ("group", "rows", "known"))):
                segmenter = Segmenter({k["word"]: k["n"] for k in known.as_py() or ()}, total)
                found = found.as_py()
                for row in found:
                    row["tokens"] = url_tokens(row["host"], row["path"], segmenter)
                yield pa.record_batch([pa.array([group.as_py()]), pa.array([found], _arrow(_TOLD))], names=["group", "rows"])

    asked = _asked(groups, "word", lambda found: host_substrings(r["host"] for r in found), words)
    told = written(asked.mapInArrow(with_tokens, f"group string, rows array<struct<{_fields(_TOLD)}>>"), "url-tokens")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found, known in zip(batch.column("rows"), batch.column("known")):
                ratios = {k["token"]: k["ratio"] for k in known.as_py() or ()}
                found = found.as_py()
                for row in found:
                    row["score"] = math.fsum(ratios.get(t, 0.0) for t in row["tokens"])
                yield pa.RecordBatch.from_pylist(found, pa.schema(list(_arrow(_TOLD + ", score double").value_type)))

    asked = _asked(told, "token", lambda found: {t for r in found for t in r["tokens"]}, _log_ratios(told))
    found = asked.mapInArrow(scored, f"{_TOLD}, score double")
    judged = F.when(F.col("score") > math.log(BLOCK_ODDS), "block").otherwise("allow")
    return found.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", judged).alias("verdict"), "score", "tokens")
