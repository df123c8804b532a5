"""How far the sources of each language are apart, and which terms set each one apart.

Terms and their counts are gathered in one pass, summed per slice of texts before the
shuffle. The kept terms of a language get numbers by rising frequency, so that 64
neighbours have few different counts in a source. For each source and count a bitset
says which of 64 terms have that count there. Two sources are compared by these
bitsets: AND and popcount give how many terms have count c in one and d in the other,
and each such cell is multiplied by the difference of the two shares. Terms that a
source lacks are the complement of its other bitsets. Work is cut into tiles of sources
and blocks of terms, so no task holds more than two tiles of one block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyguard.llm.common import byte_slices, utf8, written
from tallyguard.llm.words import LETTER, cut_words


@dataclass(frozen=True)
class DivergenceParams:
    #: A language keeps the terms that so many of its documents have.
    min_docs: int = 30
    #: Added to every count.
    smoothing: int = 5
    #: Shares are whole parts of this number.
    scale: int = 1_000_000_000
    #: How many terms are listed for a source.
    top_terms: int = 50
    #: Sources of a language that are compared in one task with as many others, on average.
    tile: int = 256
    slice_bytes: int = 4 << 20


#: Terms in a bitset, and bitsets in a block; bits of a term's number below its block's.
_WORD_BITS, _BLOCK_BITS = 6, 10
#: Entries of one comparison table held in memory at a time.
_CELLS = 1 << 20
_COUNTED = "lang string, source string, term string, n long, docs long"
_ROWS = ["lang", "i", "j", "block", "source", "tile", "word", "p", "bits"]


def divergence(
    docs: DataFrame,
    params: DivergenceParams | None = None,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """Rows lang, source, part, item, value, rank: ``pair`` rows compare two sources of a
    language over all kept terms, ``term`` rows list the terms a source overuses most.

    Null text, language and source count as empty; each row is a document, repeated rows
    too. A group without terms still has its pairs. Without kept terms all pairs have
    value 0. An empty table gives no rows. Other columns are ignored.
    """
    params = params or DivergenceParams()
    counts = written(_term_counts(docs, params, text_col, lang_col, source_col), "term-counts")
    terms = written(_numbered(counts, params), "term-numbers")
    in_lang = terms.select("lang", "term", "id", "lang_n")
    kept = written(counts.join(in_lang, ["lang", "term"]), "kept-terms")
    groups = written(_groups(counts, terms, kept, params), "term-groups")
    pairs, top = _pairs(kept, terms, groups, params), _top_terms(kept, groups, params)
    return pairs.unionByName(top)


def _term_counts(
    docs: DataFrame, params: DivergenceParams, text_col: str, lang_col: str, source_col: str
) -> DataFrame:
    """Occurrences and documents of each term of a (lang, source); the empty term marks the group."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, 2, params.slice_bytes):
                yield _slice_counts(part)

    rows = docs.select(
        *[F.coalesce(F.col(name).cast("string"), F.lit("")) for name in (lang_col, source_col)],
        F.coalesce(F.col(text_col), F.lit("")),
    ).toDF("lang", "source", "text")
    found = rows.mapInArrow(counted, _COUNTED)
    return found.groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    )


def _slice_counts(part: pa.RecordBatch) -> pa.RecordBatch:
    langs, sources = part.column(0).dictionary_encode(), part.column(1).dictionary_encode()
    lang, source = langs.indices.to_numpy().astype(np.int64), sources.indices.to_numpy()
    group = lang * len(sources.dictionary) + source
    words, counts = cut_words(*utf8(part.column(2)), LETTER, lower=True)
    size = len(words.dictionary) + 1
    row = np.repeat(np.arange(len(part), dtype=np.int64), counts)
    # Per document first, then per group; number 0 is the empty term.
    in_doc, n = np.unique(row * size + words.indices.to_numpy() + 1, return_counts=True)
    keys = np.concatenate([group[in_doc // size] * size + in_doc % size, np.unique(group) * size])
    n = np.concatenate([n, np.zeros(len(keys) - len(n), n.dtype)])
    found, at = np.unique(keys, return_inverse=True)
    total, docs = np.bincount(at, n).astype(np.int64), np.bincount(at).astype(np.int64)
    names = pa.concat_arrays([pa.array([""], pa.large_string()), words.dictionary])
    group = found // size
    return pa.record_batch(
        [
            langs.dictionary.take(pa.array(group // len(sources.dictionary))),
            sources.dictionary.take(pa.array(group % len(sources.dictionary))),
            names.take(pa.array(found % size)).cast(pa.string()),
            pa.array(total),
            pa.array(docs),
        ],
        names=["lang", "source", "term", "n", "docs"],
    )


def _numbered(counts: DataFrame, params: DivergenceParams) -> DataFrame:
    """The kept terms of each language in order of frequency, with rising numbers."""
    kept = (
        counts.where("term <> ''")
        .groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
        .where(F.col("docs") >= params.min_docs)
    )
    order = ["lang", "lang_n", "term"]
    placed = kept.repartitionByRange(*order).sortWithinPartitions(*order)
    return placed.withColumn("id", F.monotonically_increasing_id())


def _share(count: Column, total: Column, terms: Column, params: DivergenceParams) -> Column:
    """1 + floor(scale * (count + smoothing) / (total + smoothing * terms)), exactly."""
    wide = "decimal(20,0)"
    above = F.lit(params.scale).cast("decimal(10,0)") * (count + params.smoothing).cast(wide)
    below = (total + params.smoothing * terms).cast(wide)
    return F.when(terms > 0, F.call_function("div", above, below) + 1).otherwise(0)


def _groups(
    counts: DataFrame, terms: DataFrame, kept: DataFrame, params: DivergenceParams
) -> DataFrame:
    """Each (lang, source) with its total, its language's total and terms, its tile and its share of none."""
    groups = counts.where("term = ''").select("lang", "source")
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    per_lang = terms.groupBy("lang").agg(
        F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total")
    )
    tiles = groups.groupBy("lang").agg(
        F.ceil(F.count(F.lit(1)) / params.tile).alias("tiles")
    )
    zero = F.lit(0).cast("long")
    return (
        groups.join(own, ["lang", "source"], "left")
        .join(per_lang, "lang", "left")
        .join(tiles, "lang")
        .select(
            "lang",
            "source",
            "tiles",
            F.pmod(F.xxhash64("source"), F.col("tiles")).alias("tile"),
            *[F.coalesce(name, zero).alias(name) for name in ("total", "v", "lang_total")],
        )
        .withColumn("p0", _share(zero, F.col("total"), F.col("v"), params))
    )


def _pairs(
    kept: DataFrame, terms: DataFrame, groups: DataFrame, params: DivergenceParams
) -> DataFrame:
    block = F.shiftright("id", _BLOCK_BITS)
    word = F.shiftright("id", _WORD_BITS).bitwiseAND((1 << _BLOCK_BITS - _WORD_BITS) - 1)
    bit = F.expr(f"shiftleft(1L, cast(id & {(1 << _WORD_BITS) - 1} AS int))")
    levels = (
        kept.join(groups.select("lang", "source", "tile", "tiles", "total", "v"), ["lang", "source"])
        .groupBy("lang", "source", "tile", "tiles", "total", "v", block.alias("block"), word.alias("word"), "n")
        .agg(F.bit_or(bit).alias("bits"))
        .withColumn("p", _share(F.col("n"), F.col("total"), F.col("v"), params))
    )
    none = F.lit(-1).cast("long")
    masks = terms.groupBy("lang", block.alias("block"), word.alias("word")).agg(
        F.bit_or(bit).alias("bits")
    )
    # Every language has a block without terms, so that pairs without common terms appear.
    blocks = masks.select("lang", "block").union(groups.select("lang", none)).distinct()
    heads = groups.join(blocks, "lang").select(
        "lang", "source", "tile", "tiles", "block", none.alias("word"), F.lit(0).cast("long").alias("bits"), F.col("p0").alias("p")
    )
    placed = (
        levels.unionByName(heads, allowMissingColumns=True)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
        .withColumn("i", F.least("tile", "other"))
        .withColumn("j", F.greatest("tile", "other"))
        .select(*_ROWS)
    )
    last = F.col("tiles") - 1
    squares = (
        groups.select("lang", "tiles")
        .distinct()
        .withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        .withColumn("j", F.explode(F.sequence(F.col("i"), last)))
    )
    limits = masks.join(squares, "lang").select(
        "lang", "i", "j", "block", F.lit(None).cast("string").alias("source"), none.alias("tile"), "word", none.alias("p"), "bits"
    )
    rows = placed.unionByName(limits)
    # A given number of partitions, as a few bytes of bitsets mean much work.
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sums = (
        rows.repartition(tasks, "lang", "i", "j", "block")
        .groupBy("lang", "i", "j", "block")
        .applyInArrow(_compare, "lang string, a string, b string, value long")
        .groupBy("lang", "a", "b")
        .agg(F.sum("value").alias("value"))
    )
    both = sums.select("lang", F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("x"), "value")
    return _ranked(both.select("lang", F.col("x.a").alias("source"), F.col("x.b").alias("item"), "value"), "pair")


def _compare(table: pa.Table) -> pa.Table:
    """Sums over one block of terms for all pairs of sources of two tiles, or of one with itself."""
    lang, i, j = (table.column(k)[0].as_py() for k in range(3))
    tile, word, p = (table.column(k).to_numpy() for k in (5, 6, 7))
    bits = table.column("bits").to_numpy().view(np.uint64)
    coded = pc.fill_null(pc.dictionary_encode(table.column("source").combine_chunks()).indices, -1)
    names = pc.dictionary_encode(table.column("source").combine_chunks()).dictionary.to_pylist()
    source = coded.to_numpy(zero_copy_only=False).astype(np.int64)
    head = (word < 0) & (source >= 0)
    p0, tile_of = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
    p0[source[head]], tile_of[source[head]] = p[head], tile[head]
    # Sources of the first tile come first; a source is compared with those of later numbers.
    order = np.lexsort((np.array(names, object), tile_of)) if names else np.zeros(0, np.int64)
    rank = np.empty(len(names), np.int64)
    rank[order] = np.arange(len(names))
    names, p0 = [names[k] for k in order], p0[order]
    split = int((tile_of == i).sum())
    sums = np.zeros((len(names), len(names)), np.int64)
    limits = np.flatnonzero((source < 0) & (word >= 0))
    level = np.flatnonzero((source >= 0) & (word >= 0))
    level = level[np.argsort(word[level], kind="stable")]
    cuts = np.searchsorted(word[level], word[limits]), np.searchsorted(word[level], word[limits], "right")
    for at, low, high in zip(limits, *cuts):
        own = level[low:high]
        _add_cells(sums, rank[source[own]], p[own], bits[own], bits[at], p0)
    a, b = np.triu_indices(len(names), 1)
    if i != j:
        a, b = (x.ravel() for x in np.meshgrid(np.arange(split), np.arange(split, len(names)), indexing="ij"))
    found = pa.array(names, pa.string())
    return pa.table(
        [pa.array([lang] * len(a), pa.string()), found.take(pa.array(a)), found.take(pa.array(b)), pa.array(sums[a, b])],
        names=["lang", "a", "b", "value"],
    )


def _add_cells(
    sums: np.ndarray, source: np.ndarray, p: np.ndarray, bits: np.ndarray, mask: np.uint64, p0: np.ndarray
) -> None:
    """Add, for every two sources, the cells of one word of terms to ``sums``."""
    present = np.zeros(len(p0), np.uint64)
    np.bitwise_or.at(present, source, bits)
    lacking = mask & ~present
    source = np.concatenate([source, np.arange(len(p0))])
    p, bits = np.concatenate([p, p0]), np.concatenate([bits, lacking])
    some = np.flatnonzero(bits)
    if not len(some):
        return
    some = some[np.argsort(source[some], kind="stable")]
    source, p, bits = source[some], p[some], bits[some]
    heads = np.flatnonzero(np.concatenate([[True], source[1:] != source[:-1]]))
    starts = np.concatenate([heads, [len(source)]])
    first = 0
    while first < len(heads):
        # As many sources at a time as fit, each with all sources from the first of them on.
        rest = len(source) - starts[first]
        stop = int(np.searchsorted(starts, starts[first] + max(1, _CELLS // rest), "right")) - 1
        stop = min(max(stop, first + 1), len(heads))
        mine, others = slice(starts[first], starts[stop]), slice(starts[first], None)
        cells = np.bitwise_count(bits[mine, None] & bits[None, others]).astype(np.int64)
        cells *= np.abs(p[mine, None] - p[None, others])
        by_source = np.add.reduceat(cells, heads[first:] - starts[first], axis=1)
        by_source = np.add.reduceat(by_source, heads[first:stop] - starts[first], axis=0)
        sums[np.ix_(source[heads[first:stop]], source[heads[first:]])] += by_source
        first = stop


def _top_terms(kept: DataFrame, groups: DataFrame, params: DivergenceParams) -> DataFrame:
    with_facts = kept.where("n > 0").join(
        groups.select("lang", "source", "total", "v", "lang_total"), ["lang", "source"]
    )
    p = _share(F.col("n"), F.col("total"), F.col("v"), params)
    q = _share(F.col("lang_n"), F.col("lang_total"), F.col("v"), params)
    above = with_facts.select("lang", "source", F.col("term").alias("item"), (p - q).alias("value"))
    return _ranked(above.where("value > 0"), "term").where(F.col("rank") <= params.top_terms)


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order)).select(
        "lang", "source", F.lit(part).alias("part"), "item", "value", "rank"
    )
