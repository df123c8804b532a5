"""Scoring texts by a log-bilinear language model, and by the unigram counts of the corpus.

Counts of all words of all training texts are a Spark table. The frequent words are
classes of their own (those with the largest counts in all training texts, ties by the
word), all others share a class with words of the same
ending, and the end of a text is a class. The model predicts the class of a token from the classes of
the two before it: their vectors, each through a matrix of its place, add up to a
prediction, whose product with a class's output vector, plus a bias, is the class's
score. It is trained by noise-contrastive estimation over all training tokens, in tasks
that start from the same values and whose results are averaged, weighted by tokens. For
scoring, matrix products over all classes give the normaliser of each context, so that
probabilities add up to one. A word's probability is that of its class times its own
smoothed share of the class, which the table of counts gives.

Only the model has a fixed size. Texts are coded in slices; a slice's distinct words meet
those of all others in one shuffle, which counts them, and come back to its codes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyguard.llm.common import byte_slices, utf8
from tallyguard.llm.words import NOT_SPACE, cut_words
from tallyguard.session import scratch_path


@dataclass(frozen=True)
class LmParams:
    #: Share of the documents that are not learned from: one in so many, by a hash of the identifier.
    held_out: int = 10
    smoothing: float = 0.1
    #: Words with a class of their own, and classes by ending for all others.
    own_classes: int = 319
    end_classes: int = 192
    end_chars: int = 2
    width: int = 16
    #: Passes over the training texts; the tasks' models are averaged after each.
    rounds: int = 2
    batch_tokens: int = 2048
    noise: int = 32
    rate: float = 0.15
    seed: int = 7
    slice_bytes: int = 16 << 20

    @property
    def classes(self) -> int:
        return 1 + self.own_classes + self.end_classes


#: Stands for the end of a text among the words, none of which has white space.
END = "\n"
#: Averages of parameters are exact sums in this unit.
_UNIT = 1 << 20
_SHUFFLED = 1 << 20
_CODED = (
    "g long, ids array<long>, held_out array<boolean>, sizes array<int>, raw long, codes binary, "
    "code int, word string, n long"
)
_CLASSED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, "
    "within double, classes binary"
)


def score_texts(
    docs: DataFrame, params: LmParams | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, and score, the model's log10 probability of the text.

    Tokens are lower-cased words and one end. Null and empty texts are their end alone.
    A null identifier is learned from. Repeated rows are learned from and scored each.
    Without training texts every probability of the base is 1. Other columns are ignored.
    Reruns agree where rows meet the same partitions; else the model's last digits may differ.
    """
    params = params or LmParams()
    coded = _packed(_coded(docs, params, id_col, text_col), "lm-codes")
    words = _packed(_counted(coded, params), "lm-words")
    stats = _class_stats(words, params)
    slices = coded.where("code IS NULL").select("g", "ids", "held_out", "sizes", "raw", "codes")
    answers = words.select(F.col("g").alias("slice"), "code", "c", "class")
    classed = _packed(
        slices.groupBy("g").cogroup(answers.groupBy("slice")).applyInArrow(_classer(stats, params), _CLASSED), "lm-classes"
    )
    model = train(classed.where("NOT held_out"), stats, params)
    scorer = _scorer(model, normaliser_table(docs.sparkSession, model))
    scored = classed.mapInArrow(scorer, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.withColumn("train_tokens", F.lit(stats.tokens)).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def _packed(df: DataFrame, label: str) -> DataFrame:
    """As ``written``, with a denser compression: these tables are as many numbers as the corpus has words."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _coded(docs: DataFrame, params: LmParams, id_col: str, text_col: str) -> DataFrame:
    """Per slice of texts a row with its tokens as codes, and one row for each distinct word."""

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in byte_slices(batch, 1, params.slice_bytes):
                yield from _code_slice(part, group, params)
                group += 1

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(coded, _CODED)


_SLICE_FIELDS = pa.schema(
    [
        ("g", pa.int64()),
        ("ids", pa.list_(pa.int64())),
        ("held_out", pa.list_(pa.bool_())),
        ("sizes", pa.list_(pa.int32())),
        ("raw", pa.int64()),
        ("codes", pa.binary()),
    ]
)
_WORD_FIELDS = pa.schema([("code", pa.int32()), ("word", pa.string()), ("n", pa.int64())])
_ALL_FIELDS = pa.schema([*_SLICE_FIELDS, *_WORD_FIELDS])


def _code_slice(part: pa.RecordBatch, group: int, params: LmParams) -> Iterator[pa.RecordBatch]:
    ids = part.column(0).to_pylist()
    held = np.array([i is not None and zlib.crc32(str(i).encode()) % params.held_out == 0 for i in ids], bool)
    words, counts = cut_words(*utf8(part.column(1)), NOT_SPACE, lower=True)
    own = words.indices.to_numpy()
    # Code 0 is the end of a text, the others are words by falling frequency in the slice.
    order = np.argsort(-np.bincount(own, minlength=len(words.dictionary)), kind="stable")
    code = np.empty(len(order), np.int32)
    code[order] = np.arange(1, len(order) + 1)
    tokens = np.insert(code[own], np.cumsum(counts), 0)
    sizes = (counts + 1).astype(np.int32)
    learned = np.bincount(tokens[np.repeat(~held, sizes)], minlength=len(order) + 1)
    # Low and high halves apart, as the high ones are nearly all 0.
    halves = tokens.astype("<u4").view("<u2").reshape(-1, 2).T.tobytes()
    codes = pa.compress(halves, "zstd", asbytes=True)
    row = [[group], [ids], [held.tolist()], [sizes.tolist()], [len(halves)], [codes], [None], [None], [None]]
    yield pa.record_batch([pa.array(v, f.type) for v, f in zip(row, _ALL_FIELDS)], schema=_ALL_FIELDS)
    n = len(order) + 1
    names = pa.concat_arrays([pa.array([END], pa.large_string()), words.dictionary.take(pa.array(order))])
    others = [pa.nulls(n, f.type) for f in list(_SLICE_FIELDS)[1:]]
    own_columns = [pa.array(np.arange(n, dtype=np.int32)), names.cast(pa.string()), pa.array(learned.astype(np.int64))]
    yield pa.record_batch([pa.array(np.full(n, group)), *others, *own_columns], schema=_ALL_FIELDS)


def _tokens(codes: bytes, raw: int) -> np.ndarray:
    halves = np.frombuffer(pa.decompress(codes, raw, "zstd", asbytes=True), "<u2").reshape(2, -1)
    return halves[0] | (halves[1].astype(np.int32) << 16)


def _counted(coded: DataFrame, params: LmParams) -> DataFrame:
    """For each slice's words (g, code) the count ``c`` in all training texts, 0 too, and the class.

    ``first`` marks one row of each word.
    """
    words = coded.where("code IS NOT NULL").select("g", "code", "word", "n")
    # Summed over all slices for every word, as a word may be frequent in all and on top of none.
    # The list has a row for each class of its own, so a known bound.
    frequent = (
        words.where((F.col("code") > 0) & (F.col("n") > 0))
        .groupBy("word")
        .agg(F.sum("n").alias("often"))
        .orderBy(F.desc("often"), "word")
        .limit(params.own_classes)
        .collect()
    )
    own = coded.sparkSession.createDataFrame(
        [(row["word"], k) for k, row in enumerate(frequent, 1)], "word string, own int"
    )
    # A word has a row a slice at most, so none has more than a small part of the rows.
    same = Window.partitionBy("word")
    total, first = F.sum("n").over(same), F.row_number().over(same.orderBy("g")) == 1
    ending = F.pmod(F.xxhash64(F.right("word", F.lit(params.end_chars))), F.lit(params.end_classes))
    number = F.when(F.col("word") == END, 0).otherwise(F.coalesce("own", ending + params.own_classes + 1))
    counted = words.select("*", total.alias("c"), first.alias("first"))
    return counted.join(F.broadcast(own), "word", "left").select(
        "g", "code", "c", number.cast("int").alias("class"), "first"
    )


@dataclass(frozen=True)
class ClassStats:
    """Training tokens and distinct training words of each class."""

    counts: np.ndarray
    words: np.ndarray

    @property
    def tokens(self) -> int:
        return int(self.counts.sum())

    @property
    def vocabulary(self) -> int:
        return int(self.words.sum())

    def unigram(self) -> np.ndarray:
        """Smoothed shares of the classes: the noise, and the model's first biases."""
        return (self.counts + 1.0) / (self.counts.sum() + len(self.counts))


def _class_stats(words: DataFrame, params: LmParams) -> ClassStats:
    counts, kinds = np.zeros(params.classes, np.int64), np.zeros(params.classes, np.int64)
    known = words.where(F.col("first") & (F.col("c") > 0))
    for row in known.groupBy("class").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("kinds")).collect():
        counts[row["class"]], kinds[row["class"]] = row["c"], row["kinds"]
    return ClassStats(counts, kinds)


def _classer(stats: ClassStats, params: LmParams):
    """The tokens of a slice as classes, with what its words' counts say of each text."""
    base = stats.tokens + params.smoothing * (stats.vocabulary + 1)
    within = stats.counts + params.smoothing * (stats.words + 1)
    alone = params.own_classes

    def classed(slices: pa.Table, answers: pa.Table) -> pa.Table:
        code = answers.column("code").to_numpy()
        c, kind = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
        c[code], kind[code] = answers.column("c").to_numpy(), answers.column("class").to_numpy()
        base_of = np.log10((c + params.smoothing) / base)
        within_of = np.where(kind > alone, np.log10((c + params.smoothing) / within[kind]), 0.0)
        whole = slices.slice(0, 1).to_pylist()[0]
        tokens = _tokens(whole["codes"], whole["raw"])
        sizes = np.array(whole["sizes"], np.int64)
        upto = np.cumsum(sizes)
        starts = upto - sizes
        borders = np.concatenate([[0], upto]) * 2
        return pa.table(
            [
                pa.array(whole["ids"], pa.int64()),
                pa.array(whole["held_out"], pa.bool_()),
                pa.array(sizes),
                pa.array(np.add.reduceat((c > 0)[tokens].astype(np.int64), starts)),
                pa.array(np.add.reduceat(base_of[tokens], starts)),
                pa.array(np.add.reduceat(within_of[tokens], starts)),
                pa.BinaryArray.from_buffers(
                    pa.binary(),
                    len(sizes),
                    [None, pa.py_buffer(borders.astype(np.int32)), pa.py_buffer(kind.astype("<u2")[tokens].tobytes())],
                ),
            ],
            names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "within", "classes"],
        )

    return classed


@dataclass
class LogBilinear:
    """Context vectors, a matrix for each of the two places, output vectors and biases."""

    inputs: np.ndarray
    near: np.ndarray
    far: np.ndarray
    outputs: np.ndarray
    bias: np.ndarray

    @classmethod
    def start(cls, stats: ClassStats, params: LmParams) -> LogBilinear:
        rng = np.random.default_rng(params.seed)
        shape = (params.classes, params.width)
        draw = lambda: rng.normal(0, 0.1, shape)
        eye = np.eye(params.width)
        return cls(draw(), eye.copy(), eye / 2, draw(), np.log(stats.unigram()))

    def parts(self) -> list[np.ndarray]:
        return [self.inputs, self.near, self.far, self.outputs, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.parts()])

    def like(self, flat: np.ndarray) -> LogBilinear:
        cuts = np.cumsum([x.size for x in self.parts()])[:-1]
        return LogBilinear(*[a.reshape(b.shape) for a, b in zip(np.split(flat, cuts), self.parts())])

    def normalisers(self, near: np.ndarray, far: np.ndarray) -> np.ndarray:
        """Logarithms of the sums over all classes, for each context, from one matrix product."""
        scores = ((self.inputs @ self.near)[near] + (self.inputs @ self.far)[far]) @ self.outputs.T
        scores += self.bias
        top = scores.max(axis=1)
        scores -= top[:, None]
        return top + np.log(np.exp(scores, out=scores).sum(axis=1))

    def log_probabilities(
        self, token: np.ndarray, near: np.ndarray, far: np.ndarray, normalisers: np.ndarray
    ) -> np.ndarray:
        """Natural logarithms of the normalised probabilities of classes in their contexts."""
        predicted = (self.inputs @ self.near)[near] + (self.inputs @ self.far)[far]
        score = np.einsum("ij,ij->i", predicted, self.outputs[token]) + self.bias[token]
        return score - normalisers[near, far]


class Trainer:
    """Noise-contrastive estimation in batches, with step sizes by past gradients."""

    def __init__(self, model: LogBilinear, noise: np.ndarray, params: LmParams) -> None:
        self.p = params
        self.parts = [x.astype(np.float32) for x in model.parts()]
        self.past = [np.full_like(x, 1e-2) for x in self.parts]
        self.noise = noise
        self.log_noise = np.log(noise * params.noise).astype(np.float32)
        self.rng = np.random.default_rng(params.seed)

    def learn(self, token: np.ndarray, near: np.ndarray, far: np.ndarray) -> None:
        order = self.rng.permutation(len(token))
        step = self.p.batch_tokens
        noise = self.rng.choice(len(self.noise), (-(-len(token) // step), self.p.noise), p=self.noise)
        for at, drawn in zip(range(0, len(token), step), noise):
            some = order[at : at + step]
            self._step(token[some], near[some], far[some], drawn)

    def _step(self, token: np.ndarray, near: np.ndarray, far: np.ndarray, drawn: np.ndarray) -> None:
        inputs, by_near, by_far, outputs, bias = self.parts
        k, width = inputs.shape
        predicted = (inputs @ by_near)[near] + (inputs @ by_far)[far]
        own = outputs[token]
        seen = np.einsum("ij,ij->i", predicted, own) + bias[token] - self.log_noise[token]
        other = predicted @ outputs[drawn].T + (bias[drawn] - self.log_noise[drawn])
        # Gradients of the logistic loss that tells a token from the noise.
        seen = -1 / (1 + np.exp(seen)) / len(token)
        other = 1 / (1 + np.exp(-other)) / len(token)
        back = seen[:, None] * own + other @ outputs[drawn]
        d_near, d_far = self._gathered(near, back), self._gathered(far, back)
        d_out = self._gathered(token, seen[:, None] * predicted)
        np.add.at(d_out, drawn, other.T @ predicted)
        d_bias = np.bincount(token, seen, k) + np.bincount(drawn, other.sum(axis=0), k)
        changes = [
            d_near @ by_near.T + d_far @ by_far.T,
            inputs.T @ d_near,
            inputs.T @ d_far,
            d_out,
            d_bias.astype(np.float32),
        ]
        for part, past, change in zip(self.parts, self.past, changes):
            change *= len(token) ** 0.5
            past += change * change
            part -= self.p.rate * change / np.sqrt(past)

    def _gathered(self, at: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Sums of rows by class."""
        k, width = self.parts[0].shape
        places = at[:, None].astype(np.int64) * width + np.arange(width)
        return np.bincount(places.ravel(), rows.ravel(), k * width).reshape(k, width).astype(np.float32)


def contexts(classes: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of texts end to end, the class before each, the one before that, and the texts' borders."""
    data, borders = utf8(classes)
    tokens, borders = np.frombuffer(data.tobytes(), "<u2").astype(np.int32), borders // 2
    near, far = np.zeros_like(tokens), np.zeros_like(tokens)
    near[1:] = tokens[:-1]
    far[2:] = tokens[:-2]
    # A text begins as after an end.
    heads = borders[:-1]
    near[heads] = far[heads] = 0
    second = heads[np.diff(borders) > 1] + 1
    far[second] = 0
    return tokens, near, far, borders


def train(classed: DataFrame, stats: ClassStats, params: LmParams) -> LogBilinear:
    """The model after all rounds; a task's share of the texts makes one model, and these are averaged."""
    model = LogBilinear.start(stats, params)
    noise = stats.unigram()
    for _ in range(params.rounds):
        flat = model.flat()

        def learned(batches: Iterator[pa.RecordBatch], flat=flat, model=model) -> Iterator[pa.RecordBatch]:
            trainer, tokens = Trainer(model.like(flat), noise, params), 0
            for batch in batches:
                for part in byte_slices(batch, 0, 2 * _SHUFFLED):
                    token, near, far, _ = contexts(part.column(0))
                    trainer.learn(token, near, far)
                    tokens += len(token)
            if tokens:
                mine = np.concatenate([x.ravel() for x in trainer.parts]).astype(np.float64)
                value = np.rint(mine * _UNIT).astype(np.int64) * tokens
                yield pa.record_batch(
                    [pa.array(np.arange(len(mine), dtype=np.int32)), pa.array(value), pa.array(np.full(len(mine), tokens))],
                    names=["place", "value", "tokens"],
                )

        shares = classed.select("classes").mapInArrow(learned, "place int, value long, tokens long")
        exact = F.sum(F.col("value").cast("decimal(20,0)")) / F.sum("tokens")
        # As many rows as the model has parameters, whatever the input.
        for row in shares.groupBy("place").agg(exact.cast("double").alias("value")).collect():
            flat[row["place"]] = row["value"] / _UNIT
        model = model.like(flat)
    return model


def normaliser_table(spark: SparkSession, model: LogBilinear) -> np.ndarray:
    """The normalisers of all contexts, a square of the classes: a task computes some rows."""
    k = len(model.bias)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = batch.column(0).to_numpy()
            found = [model.normalisers(np.full(k, c), np.arange(k)).tobytes() for c in near]
            yield pa.record_batch([batch.column(0), pa.array(found, pa.binary())], names=["near", "sums"])

    table = np.zeros((k, k))
    tasks = min(k, spark.sparkContext.defaultParallelism)
    # The table has a fixed size, classes by classes, whatever the input.
    for row in spark.range(0, k, 1, tasks).mapInArrow(rows, "near long, sums binary").collect():
        table[row["near"]] = np.frombuffer(row["sums"])
    return table


def _scorer(model: LogBilinear, normalisers: np.ndarray):
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, 6, 2 * _SHUFFLED):
                token, near, far, borders = contexts(part.column(6))
                each = model.log_probabilities(token, near, far, normalisers)
                # Every text has a token, its end.
                score = np.add.reduceat(each, borders[:-1]) / np.log(10) + part.column(5).to_numpy()
                yield pa.record_batch(
                    [*[part.column(k) for k in range(5)], pa.array(score)],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
                )

    return scored
