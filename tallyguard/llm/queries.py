"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard.llm.exact_dedup import exact_groups
from tallyguard.llm.minhash import near_groups
from tallyguard.llm.mixing import mix_sources
from tallyguard.llm.neural_lm import score_texts
from tallyguard.llm.periodic_runs import periodic_runs
from tallyguard.llm.piece_encoding import encode_and_decode
from tallyguard.llm.quality import let, quality, words_of_text
from tallyguard.llm.secret_scan import scan_secrets
from tallyguard.llm.sentence_dedup import remove_repeated_sentences
from tallyguard.llm.source_divergence import divergence
from tallyguard.llm.suffix_dedup import remove_repeats
from tallyguard.llm.token_counts import count_tokens
from tallyguard.llm.url_filter import filter_urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(_table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents"))


def op3_sentence_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_sentences(_table(spark, sf_dir, "documents")).drop("kept_text")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(_table(spark, sf_dir, "documents"))


def op5_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_and_decode(_table(spark, sf_dir, "documents"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_ids"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "exact",
    )


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mix_sources(_table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(_table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(_table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(_table(spark, sf_dir, "pages"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with a period written over the end of every tenth text, by a hash of the identifier."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def planted(words: F.Column) -> F.Column:
        n = F.size(words)
        a = g % n
        p = F.floor((n - a) / (g % 8 + 3)) + 1
        at = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, at(i))), " "))

    text = F.when(h % 10 == 0, let(words_of_text(F.col("text")), planted))
    return docs.select("doc_id", F.coalesce(text, "text").alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_periods(_table(spark, sf_dir, "documents").select("doc_id", "text")))
    # The greatest length is the smallest negative one.
    keys = F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.withColumn("best", F.array_min(keys))
    length, period = -F.col("best.less"), F.col("best.period")
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.call_function("div", 1000 * length, period).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )


def op12_neural_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(_table(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash": op1_minhash,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_sentence_dedup": op3_sentence_dedup,
    "op4_secret_scan": op4_secret_scan,
    "op5_piece_encoding": op5_piece_encoding,
    "op6_mixing": op6_mixing,
    "op7_token_counts": op7_token_counts,
    "op8_quality_rules": op8_quality_rules,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_url_filter": op10_url_filter,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_neural_lm": op12_neural_lm,
    "op13_source_divergence": op13_source_divergence,
}
