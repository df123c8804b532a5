"""Near-duplicates by min-max hashing.

Every permutation of the shingles gives two values, its smallest and its largest,
so a signature needs half as many hash evaluations. Bands of signature values
bring similar documents together; equal shingle sets are one class from the start.
Buckets are compared by signature inside tasks, in two passes. The first gives each
class at most one likely partner in a bucket, so near copies come out as a tree and
not as pairs; these links are confirmed on the full sets. The second looks at classes
that share a bucket and are still apart, and gives all likely links between them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.llm.common import byte_slices, mixed, span_hashes, utf8, words_of, written
from tallyguard.llm.components import components


@dataclass(frozen=True)
class MinHashParams:
    shingle_words: int = 5
    #: Link where 100 * intersection >= percent * union.
    percent: int = 75
    #: 250 permutations give 500 values. 50 bands of 5 of them miss a pair at 0.75 once in 700,000 times.
    permutations: int = 250
    bands: int = 50
    band_values: int = 5
    #: A pair at 0.75 agrees in fewer values than this share once in 500,000 times.
    least_estimate: float = 0.66
    #: Members of a bucket that one task compares; a larger bucket is compared in pairs of such blocks.
    block_members: int = 32_768


def _constants(n: int, seed: int, kind) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, np.iinfo(kind).max, n, kind)


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of all rows end to end, and the rows' borders."""
    data, borders = utf8(texts)
    n = len(borders) - 1
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    starts, ends, row = words_of(data, borders)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    words = span_hashes(data, starts, ends)
    counts = np.bincount(row, minlength=n)
    first = np.concatenate([[0], np.cumsum(counts)])
    factors = _constants(width, 11, np.uint64) | np.uint64(1)
    sizes = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    sets = np.concatenate([[0], np.cumsum(sizes)])
    hashes = np.empty(sets[-1], np.uint64)
    if len(words) >= width:
        rolled = np.zeros(len(words) - width + 1, np.uint64)
        for k in range(width):
            rolled += words[k : len(rolled) + k] * factors[k]
        full = np.flatnonzero(row[: len(rolled)] == row[width - 1 :])
        hashes[sets[row[full]] + full - first[row[full]]] = mixed(rolled[full] + np.uint64(width))
    for r in np.flatnonzero((counts > 0) & (counts < width)):  # fewer words are one shingle
        few = words[first[r] : first[r + 1]] * factors[: counts[r]]
        hashes[sets[r]] = mixed(np.array([few.sum(dtype=np.uint64) + np.uint64(counts[r])]))[0]
    for r in np.flatnonzero(sizes > 1):
        hashes[sets[r] : sets[r + 1]].sort()
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    new[sets[:-1][sizes > 0]] = True
    kept = np.concatenate([[0], np.cumsum(new)])
    return hashes[new], kept[sets]


class Signer:
    def __init__(self, params: MinHashParams) -> None:
        self.masks = _constants(params.permutations, 21, np.uint32)
        self.odd = _constants(params.permutations, 22, np.uint32) | np.uint32(1)
        self.width = params.band_values
        self.bands = params.bands
        self.factors = _constants(params.band_values, 23, np.uint64) | np.uint64(1)

    def signatures(self, hashes: np.ndarray, heads: np.ndarray) -> np.ndarray:
        """Row 2p and 2p + 1: the smallest and the largest value under permutation p."""
        short = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
        out = np.empty((2 * len(self.odd), len(heads)), np.uint32)
        for p, (mask, odd) in enumerate(zip(self.masks, self.odd)):
            values = (short ^ mask) * odd
            np.minimum.reduceat(values, heads, out=out[2 * p])
            np.maximum.reduceat(values, heads, out=out[2 * p + 1])
        return out

    def band_keys(self, signatures: np.ndarray) -> np.ndarray:
        """(documents, bands): a 64-bit key of each band's values and number."""
        parts = signatures[: self.bands * self.width].reshape(self.bands, self.width, -1).astype(np.uint64)
        keys = (parts * self.factors[None, :, None]).sum(1, dtype=np.uint64)
        return mixed(keys + np.arange(1, self.bands + 1, dtype=np.uint64)[:, None]).T


_SIGNED = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, signature binary"


def _fixed_lists(values: np.ndarray) -> pa.Array:
    """Rows of a matrix as lists."""
    rows, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * width), pa.array(values.reshape(-1)))


def signed(docs: DataFrame, params: MinHashParams) -> DataFrame:
    """Set size, set fingerprint, band keys and signature (a byte a value) of each row."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(params)
        for batch in batches:
            for part in byte_slices(batch, 1):
                hashes, sets = shingle_sets(part.column(1), params.shingle_words)
                sizes = np.diff(sets)
                some = np.flatnonzero(sizes)
                n = part.num_rows
                prints = np.zeros((2, n), np.uint64)
                bands = np.zeros((n, signer.bands), np.uint64)
                short = np.zeros((n, 2 * params.permutations), np.uint8)
                if len(some):
                    heads = sets[some]
                    prints[0, some] = np.add.reduceat(mixed(hashes), heads)
                    prints[1, some] = np.bitwise_xor.reduceat(mixed(hashes + np.uint64(0xABCDEF12345)), heads)
                    signatures = signer.signatures(hashes, heads)
                    bands[some] = signer.band_keys(signatures)
                    short[some] = (signatures.T >> np.uint32(8)).astype(np.uint8)
                yield pa.record_batch(
                    [
                        part.column(0),
                        pa.array(sizes),
                        pa.array(prints[0].view(np.int64)),
                        pa.array(prints[1].view(np.int64)),
                        _fixed_lists(bands.view(np.int64)),
                        pa.array([row.tobytes() for row in short], pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "bands", "signature"],
                )

    return docs.mapInArrow(sign, _SIGNED)


def _full_sets(docs: DataFrame, width: int) -> DataFrame:
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, 1):
                hashes, borders = shingle_sets(part.column(1), width)
                found = [hashes[s:e].tobytes() for s, e in zip(borders[:-1], borders[1:])]
                yield pa.record_batch([part.column(0), pa.array(found, pa.binary())], names=["rep", "set"])

    return docs.mapInArrow(sets, "rep long, set binary")


def _tree_pairs(signs: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (leader, member): the first free row leads all free ones that agree with it often enough."""
    free, ones, twos = np.arange(len(signs)), [], []
    while len(free) > 1:
        lead, free = free[0], free[1:]
        low, high = np.minimum(sizes[free], sizes[lead]), np.maximum(sizes[free], sizes[lead])
        led = 100 * low >= percent * high
        led[led] = 100 * (signs[free[led]] == signs[lead]).mean(1) >= percent
        ones.append(np.full(int(led.sum()), lead))
        twos.append(free[led])
        free = free[~led]
    return (np.concatenate(ones), np.concatenate(twos)) if ones else (np.zeros(0, int), np.zeros(0, int))


_PAIRS = "a long, b long, label_a long, label_b long"


def _likely_in_buckets(members: DataFrame, reps: DataFrame, params: MinHashParams, tree: bool) -> DataFrame:
    """Pairs (a, b, label_a, label_b) of different components in one bucket whose signatures agree often enough.

    ``members`` has (key, rep, label, n): n members share the key. Signatures are compared
    inside the task, so pairs that fail are never rows. With ``tree`` a member comes out with
    one partner of its block at most; without, with each later one that it is apart from.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        last = None

        def flush() -> pa.RecordBatch:
            ids, labels, sizes = (np.array([row[k] for row in held], np.int64) for k in ("rep", "label", "n_shingles"))
            signs = np.frombuffer(b"".join(row["signature"] for row in held), np.uint8).reshape(len(held), -1)
            if tree:
                one, two = _tree_pairs(signs, sizes, params.percent)
            else:
                one, two = apart(labels, sizes, signs)
            swap = ids[one] > ids[two]
            a, b = np.where(swap, two, one), np.where(swap, one, two)
            return pa.record_batch([pa.array(x) for x in (ids[a], ids[b], labels[a], labels[b])], names=["a", "b", "label_a", "label_b"])

        def apart(labels: np.ndarray, sizes: np.ndarray, signs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            bands = np.array([row["bands"] for row in held], np.int64)
            block = np.array([row["block"] for row in held])
            crossed = last[1] != last[2]
            ones, twos = [], []
            # Members of the largest component come last: they are apart from none of their own.
            names, number, sizes_of = np.unique(labels, return_inverse=True, return_counts=True)
            by = np.argsort(sizes_of[number] * len(names) + number, kind="stable")
            for place in range(len(held) - int(sizes_of.max())):
                i, later = by[place], by[place + 1 :]
                differs = labels[later] != labels[i]
                if crossed:  # pairs within a block belong to that block's own task
                    differs &= block[later] != block[i]
                low, high = np.minimum(sizes[later], sizes[i]), np.maximum(sizes[later], sizes[i])
                later = later[differs & (100 * low >= params.percent * high)]
                later = later[(signs[later] == signs[i]).mean(1) >= params.least_estimate]
                # A pair comes out of the first bucket that it shares only.
                first = (bands[later] == bands[i]).argmax(1)
                later = later[bands[i][first] == last[0]]
                ones.append(np.full(len(later), i))
                twos.append(later)
            return (np.concatenate(ones), np.concatenate(twos)) if ones else (np.zeros(0, int), np.zeros(0, int))

        for batch in batches:
            for row in batch.to_pylist():
                place = (row["key"], row["low"], row["high"])
                if place != last:
                    if len(held) > 1:
                        yield flush()
                    held, last = [], place
                held.append(row)
        if len(held) > 1:
            yield flush()

    blocks = F.ceil(F.col("n") / params.block_members).cast("long")
    # Other blocks for each key: members that a tree cannot join in one bucket meet in another.
    dealt = members.withColumn("block", F.pmod(F.xxhash64("rep", "key"), blocks))
    if tree:
        dealt = dealt.withColumn("other", F.col("block"))
    else:
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    dealt = dealt.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    whole = dealt.join(reps.select("rep", "n_shingles", "signature", "bands"), "rep").repartition("key", "low", "high")
    whole = whole.select("key", "low", "high", "rep", "label", "block", "n_shingles", "signature", "bands")
    return whole.sortWithinPartitions("key", "low", "high", "rep").mapInArrow(compare, _PAIRS)


def _confirmed(pairs: DataFrame, sets: DataFrame, params: MinHashParams) -> DataFrame:
    """The pairs that are links on their full sets."""

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist()):
                a, b = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
                if len(a) > len(b):
                    a, b = b, a
                at = np.searchsorted(b, a)
                shared = int((b[np.minimum(at, len(b) - 1)] == a).sum())
                keep.append(100 * shared >= params.percent * (len(a) + len(b) - shared))
            yield batch.drop_columns(["set_a", "set_b"]).filter(pa.array(keep, pa.bool_()))

    def side(name: str) -> DataFrame:
        return sets.select(F.col("rep").alias(name), F.col("set").alias(f"set_{name}"))

    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return joined.select(*pairs.columns, "set_a", "set_b").mapInArrow(exact, _PAIRS)


def _relabelled(frame: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """``frame`` with ``column`` replaced by its component's label where it has one."""
    found = frame.join(labels.select(F.col("node").alias(column), F.col("label").alias("_to")), column, "left")
    return found.withColumn(column, F.coalesce("_to", column)).drop("_to")


def _open_members(members: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components, with the bucket's size."""
    ends = members.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("n"))
    return members.join(ends.where("low < high").select("key", "n"), "key")


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: MinHashParams | None = None
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept, class_id.

    Null, empty and blank texts have no shingles and are linked with nothing, as are
    rows without an identifier (component_id null). Equal sets form a class, named by
    its smallest identifier. Rows that share an identifier stand for one document in
    links. Other columns are ignored; an empty table gives an empty result.
    """
    params = params or MinHashParams()
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = written(signed(own, params), "minhash-signed")
    linked = rows.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    same_set = ["n_shingles", "set_a", "set_b"]
    classes = linked.groupBy(*same_set).agg(F.min("doc_id").alias("rep"))
    reps = linked.groupBy(*same_set).agg(
        F.min("doc_id").alias("rep"), F.min_by(F.struct("bands", "signature"), "doc_id").alias("of")
    )
    reps = written(reps.select("rep", "n_shingles", "of.bands", "of.signature"), "minhash-classes")
    keyed = reps.select(F.explode("bands").alias("key"), "rep")
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = written(keyed.join(shared, "key").withColumn("label", F.col("rep")), "minhash-buckets")
    near = written(_likely_in_buckets(members, reps, params, tree=True).distinct(), "minhash-tree")
    named = rows.join(classes, same_set, "left").withColumn("label", F.coalesce("rep", "doc_id"))
    wanted = members.select(F.col("rep").alias("doc_id")).distinct()
    found = _full_sets(own.join(wanted, "doc_id", "left_semi"), params.shingle_words)
    sets = written(found.dropDuplicates(["rep"]), "minhash-sets")
    # Links of the second pass are between components of the first.
    labels = components(written(_confirmed(near, sets, params), "minhash-links"))
    now = written(_relabelled(members.drop("n"), labels, "label"), "minhash-labelled")
    near = written(_likely_in_buckets(_open_members(now), reps, params, tree=False), "minhash-pairs")
    between = _confirmed(near, sets, params).select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
    joined = components(written(between.distinct(), "minhash-links"))
    named = _relabelled(_relabelled(named, labels, "label"), joined, "label")
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("label"))
    return named.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        F.coalesce("rep", "doc_id").alias("class_id"),
    )


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: MinHashParams | None = None
) -> DataFrame:
    """The rows of ``docs`` that stay: the smallest identifier of each group, with their columns.

    Rows without an identifier all stay; of rows that share a kept identifier one stays.
    """
    keep = near_groups(docs, id_col, text_col, params).where("kept and doc_id is not null").select("doc_id").distinct()
    # The rows travel as one column, so no name of theirs can clash.
    own = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), own.alias("row"))
    found = rows.join(keep, "doc_id").dropDuplicates(["doc_id"])
    return found.union(rows.where(F.col("doc_id").isNull())).select("row.*")
