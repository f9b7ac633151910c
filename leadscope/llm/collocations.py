"""Phrase collocation mining over sorted count streams.

The layout is that of external language-model estimation: each order (phrases of m words) has its stream of counts,
and a phrase of m words is a pair: the phrase of its first m - 1 words and that of its last m - 1 words, both of order
m - 1. Sorted by the first, the stream is in prefix order, and a merge with the stream of order m - 1 gives the
counts left of every cut; sorted by the second it is in suffix order, and a merge gives the counts right of every
cut. Read against the stream of order m + 1 in its two orders, the same merges give the largest left and right extension.
All joins of streams are sort-merge joins (a hint asks for them), which walk two sorted streams in step without hash tables.

Counting. Texts are cut into blocks of one language in a partition; a block numbers its words and keeps its text as
such numbers, packed. Word counts per block are summed over blocks by sorting (a window over block counts, one shuffle), and the
blocks get back the ids of frequent words. Order by order, a block then counts pairs of frequent phrases that overlap in place:
every part of a frequent phrase is frequent, so none is missed and rare phrases never leave their block. A word or
phrase makes one row per block, not one per occurrence, so frequent ones are no hot keys. Blocks and streams of an order
are tables in the shared checkpoint folder; blocks lie in buckets of their number, so that the answers come to them and
their texts are never shuffled. The blocks of the order before are deleted once the next ones stand.

Score of a cut: floor(1000 a n / (l r)) in decimals of 38 digits (exact up to a n < 10**35). A longer candidate that
counts against a phrase always has an extension by one word, left or right, that counts against it, too, since counts
fall with length: so extensions by one word decide.

Edge cases: a null text is empty and has no words; a null lang counts as ``und``, as does the lang ``und`` itself. Ties of
score go by count, then by phrase in byte order; of equal cuts the first counts. Repeated rows are rows. Long texts are taken
whole (a block holds at least one text). A lang without candidates, or an empty table, gives no rows. Extra columns play
no part.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Tables, prepare

LEAST, LONGEST, FACTOR, PERCENT, TOP = 100, 5, 1000, 100, 2000
BLOCK_BYTES = 8 << 20
#: What ends a piece; A-Z are lower-cased, and all ends become one that no word holds.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_BYTES = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + _ENDS, b"abcdefghijklmnopqrstuvwxyz" + b"!" * len(_ENDS))
END = b"!"


def words_and_ends(text: bytes) -> list[bytes]:
    """The lower-cased words, with END at every end of a piece."""
    return text.translate(_BYTES).replace(END, b" ! ").split()


def _packed(x: np.ndarray) -> bytes:
    """Numbers from -1, in bytes of one place after the other, as higher ones are mostly zero."""
    planes = (x + 1).astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int32) - 1


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of texts of one lang: block, lang, places (word number at every place, -1 for an end), words and counts."""
    held: dict[str, list[bytes]] = defaultdict(list)
    size: dict[str, int] = defaultdict(int)
    number = TaskContext.get().partitionId() << 32

    def block(lang: str) -> pa.RecordBatch:
        nonlocal number
        number += 1
        ids: dict[bytes, int] = defaultdict()
        ids.default_factory = ids.__len__
        ids[END] = 0
        parts = []
        for text in held.pop(lang):
            found = words_and_ends(text)
            parts.append(np.fromiter(map(ids.__getitem__, found), dtype=np.int32, count=len(found)))
            parts.append(np.zeros(1, dtype=np.int32))
        size.pop(lang)
        places = np.concatenate(parts)
        counts = np.bincount(places, minlength=len(ids))[1:]
        words = pa.array(list(ids)[1:], pa.binary())
        return pa.record_batch([pa.array([number]), pa.array([lang]), pa.array([_packed(places - 1)], pa.binary()),
                                pa.array([words], pa.list_(pa.binary())), pa.array([counts.tolist()], pa.list_(pa.int64()))],
                               names=["block", "lang", "places", "words", "counts"])

    for batch in batches:
        for lang, text in zip(*batch.columns):
            lang, text = lang.as_py(), text.as_py()
            if text:
                held[lang].append(text)
                size[lang] += len(text)
                if size[lang] >= BLOCK_BYTES:
                    yield block(lang)
                elif sum(size.values()) >= 4 * BLOCK_BYTES:  # many langs at once
                    yield block(max(size, key=size.get))
    for lang in list(held):
        yield block(lang)


def _named_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks whose places show their frequent words: block, places, ids (of the numbers at the places)."""
    for block, places, numbers, ids in _rows(batches):
        yield _state(block, _unpacked(places), numbers, ids)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
    for batch in batches:
        for row in zip(*batch.columns):
            yield [x.as_py() if x.type in (pa.int64(), pa.binary()) else x.values.to_numpy(zero_copy_only=False) for x in row]


def _state(block: int, at: np.ndarray, numbers: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    """A block whose places keep the given numbers alone, numbered anew."""
    new = np.full(int(at.max(initial=-1)) + 2, -1, dtype=np.int32)  # the last cell is for places that have none
    order = np.argsort(numbers)
    new[numbers[order]] = np.arange(len(numbers), dtype=np.int32)
    return pa.record_batch([pa.array([block]), pa.array([_packed(new[at])], pa.binary()), pa.array([ids[order]], pa.list_(pa.int64()))], names=["block", "places", "ids"])


def _pairs(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of phrases that follow each other by one word: first and second, counts; where pairs begin, and which."""
    both = np.flatnonzero((at[:-1] >= 0) & (at[1:] >= 0))
    keys, which, counts = np.unique(at[both].astype(np.int64) << 32 | at[both + 1], return_inverse=True, return_counts=True)
    return keys >> 32, keys & 0xFFFFFFFF, counts, both, which


def _counted_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per pair of a block: pre, suf (ids), tally (the pair's count above its number, 32 bits each), block. In this
    order a row ends as the one before it does, from the number's higher bytes on, and shuffles compress best."""
    for block, places, ids in _rows(batches):
        first, second, counts, *_ = _pairs(_unpacked(places))
        for k in range(0, len(first), 1 << 16):
            some = slice(k, k + (1 << 16))
            tally = counts[some] << 32 | np.arange(k, k + len(first[some]))
            found = [ids[first[some]], ids[second[some]], tally, np.full(len(tally), block)]
            yield pa.record_batch([pa.array(x, pa.int64()) for x in found], names=["pre", "suf", "tally", "block"])


def _named_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the next order: places show the frequent pairs."""
    for block, places, numbers, ids in _rows(batches):
        at = _unpacked(places)
        *_, both, which = _pairs(at)
        after = np.full(len(at), -1, dtype=np.int32)
        after[both] = which
        yield _state(block, after, numbers, ids)


def _streams(tables: Tables, rows: DataFrame, key: list[str], least: int, name: str) -> tuple[DataFrame, DataFrame]:
    """From rows (key, tally, block): the stream of frequent keys (id, key, f) and the ids that each block's numbers
    have (block, numbers, ids). One shuffle: a key's rows lie together, and the least of their own ids becomes the key's."""
    together = rows.repartition(*key).sortWithinPartitions(*key).withColumn("own", F.monotonically_increasing_id())
    same = Window.partitionBy(*key)
    named = together.withColumn("f", F.sum(F.shiftright("tally", 32)).over(same)).withColumn("id", F.min("own").over(same)).filter(F.col("f") >= least)
    named = tables.keep(named.withColumn("number", F.col("tally").bitwiseAND(0xFFFFFFFF)).drop("tally"), f"{name}-rows")
    found = named.groupBy("block").agg(F.collect_list("number").alias("numbers"), F.collect_list("id").alias("ids"))
    return tables.keep(named.filter("own = id").select("id", *key, "f"), f"{name}-stream"), found


def counted(documents: DataFrame, tables: Tables, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, list[DataFrame]]:
    """Words per lang (lang, n) and a stream of frequent phrases per order: id, f and lang, word or pre, suf (ids)."""
    texts = documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))
    texts = tables.keep_by(texts.mapInArrow(_cut, "block long, lang string, places binary, words array<binary>, counts array<long>"), "texts", "block")
    total = texts.select("lang", F.expr("aggregate(counts, 0L, (a, b) -> a + b)").alias("n")).groupBy("lang").agg(F.sum("n").alias("n"))
    total = tables.keep(total, "total")
    rows = texts.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("number", "x"))
    rows = rows.select("lang", F.col("x.words").cast("string").alias("word"), F.shiftleft("x.counts", 32).bitwiseOR(F.col("number").cast("bigint")).alias("tally"), "block")
    state, named, last = texts, _named_words, "texts"
    streams = []
    for order in range(1, longest + 1):
        stream, found = _streams(tables, rows, ["lang", "word"] if order == 1 else ["pre", "suf"], least, f"order{order}")
        streams.append(stream)
        if order < longest:
            met = state.select("block", "places").hint("merge").join(found, "block").select("block", "places", "numbers", found["ids"])
            state = tables.keep_by(met.mapInArrow(named, "block long, places binary, ids array<long>"), f"order{order}", "block")
            rows, named = state.mapInArrow(_counted_pairs, "pre long, suf long, tally long, block long"), _named_pairs
        tables.drop(last, f"order{order}-rows")
        last = f"order{order}"
    return total, streams


def _cut_at(k: int, order: int, factor: int) -> Column:
    """score, k, l, r of the cut after k words, for an array whose least member is the cut that counts."""
    l, r = (F.col(c)[at].cast("decimal(38,0)") for c, at in (("lefts", k - 1), ("rights", order - k - 1)))
    whole = F.lit(factor).cast("decimal(38,0)") * F.col("f").cast("decimal(38,0)") * F.col("n").cast("decimal(38,0)")
    return F.struct(F.call_function("div", whole, l * r).alias("score"), F.lit(k).alias("k"), F.col("lefts")[k - 1].alias("l"), F.col("rights")[order - k - 1].alias("r"))


def scored(documents: DataFrame, tables: Tables, least: int = LEAST, longest: int = LONGEST, factor: int = FACTOR, percent: int = PERCENT) -> DataFrame:
    """lang, phrase, a, l, r, n, score of the candidates that no longer candidate makes redundant."""
    total, streams = counted(documents, tables, least, longest)
    # per phrase: its counts, those of its prefixes and of its suffixes, by length
    lower = streams[0].select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f", F.expr("array(f)").alias("lefts"), F.expr("array(f)").alias("rights"))
    out = None
    for order in range(2, longest + 1):
        stream = streams[order - 1]
        left = lower.select(F.col("id").alias("pre"), "lang", F.col("phrase").alias("start"), "lefts")
        right = lower.select(F.col("id").alias("suf"), "last", "rights")
        full = stream.join(left.hint("merge"), "pre").join(right.hint("merge"), "suf")
        full = full.select("id", "lang", F.concat_ws(" ", "start", "last").alias("phrase"), "last", "f",
                           F.concat("lefts", F.array("f")).alias("lefts"), F.concat("rights", F.array("f")).alias("rights"))
        lower = tables.keep(full, f"full{order}")
        open_ = lower
        if order < longest:
            for end in ("pre", "suf"):  # the longer phrases in prefix order give right extensions, in suffix order left ones
                most = streams[order].groupBy(F.col(end).alias("id")).agg(F.max("f").alias(f"by_{end}"))
                open_ = open_.join(most.hint("merge"), "id", "left")
            open_ = open_.filter(100 * F.greatest(F.coalesce("by_pre", F.lit(0)), F.coalesce("by_suf", F.lit(0))) < percent * F.col("f"))
        cuts = F.array(*[_cut_at(k, order, factor) for k in range(1, order)])
        judged = open_.join(total, "lang").withColumn("cut", F.array_min(cuts))
        judged = judged.select("lang", "phrase", F.col("f").alias("a"), "cut.l", "cut.r", "n", "cut.score")
        out = judged if out is None else out.unionByName(judged)
    return out


def collocations(documents: DataFrame, top: int = TOP, **settings: int) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each lang's first phrases."""
    tables = Tables(prepare(documents.sparkSession), "collocations")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = scored(documents, tables, **settings).withColumn("rank", F.row_number().over(order).cast("bigint")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
