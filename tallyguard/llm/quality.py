"""Quality rules: counts over whole texts, and how far a text is from its language.

Everything is built-in column functions. Per document there are counts of seven
character classes and of the most frequent words of its language. Summed
over all documents of a language they are its reference; the Jensen-Shannon
distance to it is the verdict, for texts long enough to tell.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyguard.llm.common import SPACE, whole_text, written


@dataclass(frozen=True)
class QualityParams:
    min_words: int = 10
    max_repeat_pct: int = 20
    window: int = 5
    common_words: int = 12
    #: Shorter texts say too little about their distribution.
    min_divergence_words: int = 40
    max_class_distance: float = 0.32
    max_word_distance: float = 0.42


CLASSES = ("lower", "upper", "digit", "wide", "space", "symbol", "other")


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of_text(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def removed_length(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _window_hashes(words: Column, width: int) -> Column:
    def hashes(w: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(w) - width)
        found = F.transform(places, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]))
        return F.when(F.size(w) >= width, found).otherwise(F.array().cast("array<bigint>"))

    return let(words, hashes)


def _covered(hashes: Column, width: int) -> Column:
    """Words in windows whose hash occurs again: sorted by hash, then by place."""

    def of_sorted(s: Column) -> Column:
        def hash_at(k: Column) -> Column:
            return F.get(s, k)["h"]

        def again(k: Column) -> Column:
            return F.coalesce(hash_at(k) == F.when(k > 0, hash_at(k - 1)), F.lit(False)) | F.coalesce(
                hash_at(k) == hash_at(k + 1), F.lit(False)
            )

        return F.transform(F.filter(F.sequence(F.lit(0), F.size(s) - 1), again), lambda k: F.get(s, k)["i"])

    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    start = F.struct(F.lit(-width).alias("last"), F.lit(0).cast("bigint").alias("total"))

    def add(a: Column, p: Column) -> Column:
        new = F.least(F.lit(width), p - a["last"]).cast("bigint")
        return F.struct(p.alias("last"), (a["total"] + new).alias("total"))

    return F.aggregate(F.sort_array(let(ordered, of_sorted)), start, add, lambda a: a["total"])


def text_counts(docs: DataFrame, common: DataFrame, params: QualityParams, text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` and, in ``_c``, the counts of each row's text."""
    text = whole_text(text_col)
    cut = docs.select("*", text.alias("_text"), words_of_text(text).alias("_words"))
    cut = cut.join(common, "_lang", "left")
    joined = F.array_join("_words", "")
    cut = cut.select(
        "*",
        joined.alias("_joined"),
        _window_hashes(F.col("_words"), params.window).alias("_hashes"),
    )
    # Few characters are not lower case, so the other classes are counted in what is left.
    cut = cut.withColumn("_rest", F.regexp_replace("_joined", "[a-z]+", ""))
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    dup_lines = let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    repeated = F.size("_hashes") != F.size(F.array_distinct("_hashes"))
    chars, n_words = F.length("_joined"), F.size("_words")
    symbols = F.length(F.regexp_replace("_rest", "[^#*$%&|<>]+", ""))
    classes = {
        "lower": chars - F.length("_rest"),
        "upper": removed_length(F.col("_rest"), "[A-Z]+"),
        "digit": removed_length(F.col("_rest"), "[0-9]+"),
        "wide": removed_length(F.col("_rest"), r"[^\x00-\x7F]+"),
        "space": F.length("_text") - chars,
        "symbol": symbols,
    }
    hits = F.transform("_common", lambda c: (F.size("_words") - F.size(F.array_remove("_words", c))).cast("long"))
    counted = cut.select(
        *[F.col(f"`{name}`") for name in docs.columns],
        n_words.cast("long").alias("_n_words"),
        chars.cast("long").alias("_word_chars"),
        symbols.cast("long").alias("_n_symbols"),
        dup_lines.cast("long").alias("_n_dup_lines"),
        F.when(repeated, _covered(F.col("_hashes"), params.window)).otherwise(F.lit(0)).cast("long").alias("_n_repeat_words"),
        F.length("_text").cast("long").alias("_n_chars"),
        *[value.cast("long").alias(f"_{name}") for name, value in classes.items()],
        F.coalesce(hits, F.array().cast("array<bigint>")).alias("_hits"),
    )
    known = sum((F.col(f"_{name}") for name in CLASSES[1:-1]), F.col("_lower"))
    return counted.withColumn("_other", F.col("_n_chars") - known)


def common_words(docs: DataFrame, params: QualityParams, text_col: str = "text") -> DataFrame:
    """The most frequent words of each language, over all documents."""
    words = words_of_text(whole_text(text_col))
    counts = docs.select("_lang", F.explode(words).alias("word")).groupBy("_lang", "word").count()
    ranked = counts.withColumn(
        "rank", F.row_number().over(Window.partitionBy("_lang").orderBy(F.desc("count"), "word"))
    ).where(F.col("rank") <= params.common_words)
    return ranked.groupBy("_lang").agg(F.array_sort(F.collect_list("word")).alias("_common"))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of shares, from 0 to 1."""

    def part(a: Column, m: Column) -> Column:
        return F.when(a > 0, a * F.log2(a / m)).otherwise(F.lit(0.0))

    terms = F.zip_with(p, q, lambda a, b: (part(a, (a + b) / 2) + part(b, (a + b) / 2)) / 2)
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda s, x: s + x), F.lit(0.0)))


def _shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0).cast("bigint"), lambda s, x: s + x)
    return let(total, lambda t: F.transform(counts, lambda x: x / F.greatest(t, F.lit(1))))


def judge(counted: DataFrame, params: QualityParams) -> DataFrame:
    """Add ``_class_distance``, ``_word_distance``, ``_base_failed`` and ``_kept``."""
    own = counted.withColumn("_classes", F.array(*[F.col(f"_{name}") for name in CLASSES]))
    rest = F.col("_n_words") - F.aggregate("_hits", F.lit(0).cast("bigint"), lambda s, x: s + x)
    own = own.withColumn("_hist", F.concat("_hits", F.array(rest)))
    base_failed = (F.col("_n_words") < params.min_words) | (
        100 * F.col("_n_repeat_words") > params.max_repeat_pct * F.col("_n_words")
    )
    own = own.withColumn("_base_failed", base_failed)
    # A language's reference: the sums over all its documents that pass the base rules.
    totals = own.where(~F.col("_base_failed")).groupBy("_lang").agg(
        *[F.sum(f"_{name}").alias(f"_{name}") for name in CLASSES],
        F.sum("_n_words").alias("_total"),
        *[F.sum(F.get("_hits", F.lit(i))).alias(f"_w{i}") for i in range(params.common_words)],
    )
    seen = F.array_compact(F.array(*[F.col(f"_w{i}") for i in range(params.common_words)]))
    reference = totals.select(
        "_lang",
        _shares(F.array(*[F.col(f"_{name}") for name in CLASSES])).alias("_ref_classes"),
        let(seen, lambda s: _shares(F.concat(s, F.array(F.col("_total") - F.aggregate(s, F.lit(0).cast("bigint"), lambda a, x: a + x))))).alias("_ref_hist"),
    )
    told = own.join(reference, "_lang", "left").withColumns(
        {
            "_class_distance": js_distance(_shares(F.col("_classes")), F.col("_ref_classes")),
            "_word_distance": js_distance(_shares(F.col("_hist")), F.col("_ref_hist")),
        }
    )
    far = (F.col("_n_words") >= params.min_divergence_words) & (
        (F.coalesce("_class_distance", F.lit(0.0)) > params.max_class_distance)
        | (F.coalesce("_word_distance", F.lit(0.0)) > params.max_word_distance)
    )
    return told.withColumn("_kept", ~F.col("_base_failed") & ~far)


def quality(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    params: QualityParams | None = None,
) -> DataFrame:
    """One row per row of ``docs``: its counts, distances, base_failed and kept.

    A null text has no words and fails the base rules, as an empty one does; a null
    language is a language of its own. Repeated rows are judged alike, other columns
    are ignored. Distances are null where no document of the language passes.
    """
    params = params or QualityParams()
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("_lang"),
    )
    common = written(common_words(rows, params), "quality-words")
    counted = text_counts(rows, common, params).drop("text")
    told = judge(written(counted, "quality-counts"), params)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "word_distance")
    return told.select("doc_id", *[F.col(f"_{name}").alias(name) for name in names])


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", params: QualityParams | None = None) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns."""
    params = params or QualityParams()
    rows = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("_row"),
        F.col(text_col).alias("text"),
        F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("_lang"),
    )
    common = written(common_words(rows, params), "quality-words")
    # The rows travel in the table of counts, so a repeated identifier needs no join back.
    counted = written(text_counts(rows, common, params).drop("text"), "quality-counts")
    return judge(counted, params).where("_kept").select("_row.*")
