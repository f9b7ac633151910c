"""Substring deduplication with a compressed FM-index per shard.

A window is ``WINDOW`` consecutive words of a document. Every word covered by a window that also starts anywhere else
is removed. Repeats are found by backward search in FM-indexes over words (Burrows-Wheeler transform, wavelet
matrix with sampled ranks); the matching statistic of a position is the number of words ending there that occur
at least twice, and windows are the positions where it reaches the threshold.

To stream every document through every shard's index would cost the square of the corpus. Instead, texts are routed:
the minimizer of a window (smallest hash of its 16-word runs) is the same for equal windows, so consecutive windows
with one minimizer form a segment, and equal windows only stand in segments of one minimizer.
 1. Blocks of documents find their segments. The minimizers, packed, are exchanged (``common.exchange``): segments whose
    minimizer is nowhere else hold no repeat and go no further.
 2. The others are counted per minimizer and content. A content that occurs twice repeats as a whole. Where a
    minimizer has several contents, a representative of each goes to a shard. A minimizer with many contents (a
    passage in a third of all documents, with all its different neighbourhoods) is split into single windows that
    are dealt out by a hash of their words, so a shard's size is bounded.
 3. Each shard builds its index over its segments and searches it with them.
 4. The repeated windows go back to all places of the content, and the words are cut from the documents.

Edge cases: a null text has no words, and nothing of it is removed; a text shorter than a window loses nothing.
Repeated rows repeat each other and lose all windows. Rows with a null id count. Long texts are cut into segments like
any other. An empty table gives no rows. Extra columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, bucket_count, doc_key, exchange, grouped_words, having, joined_answers, mix, pack_keys, prepare, range_hash, stored

WINDOW = 35
GRAM = 16
RUN = 32  # windows in a segment at most
MANY = 256  # contents of a minimizer beyond which windows are dealt out one by one
SHARD_WORDS = 600_000
_BLOCK = "block long, ids array<long>, th array<long>, segments binary, parts array<binary>"
SEGMENT = np.dtype([("doc", "<i4"), ("start", "<i4"), ("n", "<i2"), ("sure", "?"), ("minimizer", "<i8"), ("content", "<i8")])


# ------------------------------------------------------------------ segments

def segments(hashes: np.ndarray, bounds: np.ndarray, window: int, gram: int = GRAM) -> np.ndarray:
    """Segments of several documents: runs of windows with one minimizer, at most RUN windows each.

    hashes: of all words; bounds: where each document's words begin and end. sure: the segment holds a window twice.
    """
    gram = min(gram, window)
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, dtype=SEGMENT)
    least = range_hash(hashes, np.arange(len(hashes) - gram + 1), np.arange(gram, len(hashes) + 1))
    width, span = 1, window - gram + 1
    while width < span:  # minima of a window's runs, by doubling
        step = min(width, span - width)
        least = np.minimum(least[: len(least) - step], least[step:])
        width += step
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    whole = doc[:n] == doc[window - 1 :]
    change = np.ones(n, dtype=bool)
    change[1:] = (least[1:] != least[:-1]) | ~whole[1:] | ~whole[:-1] | (doc[1:n] != doc[: n - 1])
    begin = np.maximum.accumulate(np.where(change, np.arange(n), 0))
    start = np.flatnonzero((((np.arange(n) - begin) % RUN) == 0) & whole)
    if not len(start):
        return np.zeros(0, dtype=SEGMENT)
    index = np.cumsum(np.bincount(start, minlength=n)[:n]) - 1  # segment of each window
    size = np.bincount(index[whole], minlength=len(start))
    out = np.zeros(len(start), dtype=SEGMENT)
    out["doc"], out["start"], out["n"] = doc[start], start - bounds[doc[start]], size
    out["minimizer"] = least[start].view(np.int64)
    out["content"] = range_hash(hashes, start, start + size + window - 1).view(np.int64)
    each = range_hash(hashes, np.flatnonzero(whole), np.flatnonzero(whole) + window)
    order = np.argsort(each, kind="stable")
    same = (each[order[1:]] == each[order[:-1]]) & (index[whole][order[1:]] == index[whole][order[:-1]])
    out["sure"][index[whole][order[1:][same]]] = True
    return out


def _block_rows(documents: DataFrame, window: int, n_buckets: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, (ids, th, texts) in blocks(batches, ["doc_id", "th", "text"]):
            found = []
            for first, _, hashes, bounds in grouped_words(texts):
                part = segments(hashes, bounds, window)
                part["doc"] += first
                found.append(part)
            every = np.concatenate(found)
            keys = mix(every["minimizer"].view(np.uint64))
            order, parts = pack_keys(keys, n_buckets)
            # in the order of the keys: the answers come in it
            row = [block, ids, th, every[order].tobytes(), parts]
            types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.binary())]
            yield pa.record_batch([pa.array([x], t) for x, t in zip(row, types)], names=[c.split()[0] for c in _BLOCK.split(", ")])

    return stored(documents.select(*doc_key(), F.coalesce("text", F.lit("")).cast("binary").alias("text")).mapInArrow(cut, _BLOCK))


def _candidates(rows: DataFrame) -> DataFrame:
    """doc_id, th, start, n, minimizer, content of the segments whose minimizer occurs again."""
    schema = "doc_id long, th long, start int, n int, minimizer long, content long"

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                every = np.frombuffer(r["segments"], dtype=SEGMENT)
                keep = every[every["sure"] | (joined_answers(r["answers"]) > 0)]
                ids, th = pa.array(r["ids"], pa.int64()), pa.array(r["th"], pa.int64())
                doc = pa.array(keep["doc"])
                yield pa.record_batch([ids.take(doc), th.take(doc), pa.array(keep["start"]), pa.array(keep["n"].astype(np.int32)),
                                       pa.array(keep["minimizer"]), pa.array(keep["content"])], names=[c.split()[0] for c in schema.split(", ")])

    return rows.select("block", "ids", "th", "segments").join(exchange(rows), "block", "left").mapInArrow(pick, schema)


# ------------------------------------------------------------------ the index

class WaveletMatrix:
    """A sequence of small numbers with rank queries: one bit row per binary digit, ranks sampled every 64 bits."""

    def __init__(self, x: np.ndarray, top: int):
        self.n, self.bits, self.rows = len(x), max(1, int(top).bit_length()), []
        for k in reversed(range(self.bits)):
            bit = (x >> k & 1).astype(bool)
            padded = np.zeros((len(x) // 64 + 1) * 64, dtype=np.uint8)
            padded[: len(x)] = bit
            packed = np.packbits(padded, bitorder="little").view(np.uint64)
            sampled = np.concatenate(([0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)))
            self.rows.append((packed, sampled, len(x) - int(bit.sum())))
            x = np.concatenate((x[~bit], x[bit]))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each position."""
        first = np.zeros(len(at), dtype=np.int64)
        for k, (packed, sampled, zeros) in zip(reversed(range(self.bits)), self.rows):
            one = (symbol >> k & 1).astype(bool)
            ones_first, ones_at = self._ones(packed, sampled, first), self._ones(packed, sampled, at)
            first = np.where(one, zeros + ones_first, first - ones_first)
            at = np.where(one, zeros + ones_at, at - ones_at)
        return at - first

    @staticmethod
    def _ones(packed: np.ndarray, sampled: np.ndarray, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return sampled[word] + np.bitwise_count(packed[word] & mask)


def suffix_order(x: np.ndarray) -> np.ndarray:
    """Places of the sequence's suffixes in order, by prefix doubling."""
    _, rank = np.unique(x, return_inverse=True)
    width = 1
    while True:
        after = np.zeros(len(x), dtype=np.int64)
        after[:-width or None] = rank[width:] + 1 if width < len(x) else 0
        key = rank.astype(np.int64) * (len(x) + 2) + after
        order = np.argsort(key, kind="stable")
        new = np.concatenate(([0], np.cumsum(key[order[1:]] != key[order[:-1]])))
        rank = np.empty(len(x), dtype=np.int64)
        rank[order] = new
        width *= 2
        if new[-1] == len(x) - 1 or width >= len(x):
            return order


class FMIndex:
    """Counts occurrences of word sequences in a set of texts by backward search."""

    def __init__(self, texts: list[list[int]], times: list[int]):
        """texts: numbers from 1 up; times: how often each text occurs (counted in full)."""
        n = len(texts)
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        # every text is followed by an end of its own, smaller than all words: no match crosses it
        ends = np.cumsum(sizes + 1) - 1
        x = np.zeros(int(ends[-1]) + 1 if n else 0, dtype=np.int64)
        inside = np.ones(len(x), dtype=bool)
        inside[ends] = False
        x[inside] = np.concatenate([np.asarray(t, dtype=np.int64) for t in texts]) + n if n else 0
        x[ends] = np.arange(n)
        self.x, self.n_texts = x, n
        order = suffix_order(x)
        before = x[order - 1]
        # the ends need no ranks: one symbol for all of them keeps the matrix small
        words = np.maximum(before - n + 1, 0)
        top = int(words.max(initial=0))
        self.matrix = WaveletMatrix(words, top)
        counts = np.bincount(words, minlength=top + 1)
        self.below = np.concatenate(([0], np.cumsum(counts)))
        text_of = np.repeat(np.arange(n), sizes + 1)
        self.weight = np.concatenate(([0], np.cumsum(np.asarray(times, dtype=np.int64)[text_of[order]])))

    def occurs_twice(self, size: int) -> np.ndarray:
        """For every position of the indexed texts, whether the ``size`` words from there occur at least twice.

        All positions search at the same time, backwards from their last word; one whose interval stands for a
        single occurrence has reached its matching statistic below the threshold and stops.
        """
        x = np.where(self.x >= self.n_texts, self.x - self.n_texts + 1, 0)
        end = np.cumsum(x == 0)
        whole = np.zeros(len(x), dtype=bool)
        if len(x) >= size:
            whole[: len(x) - size + 1] = end[size - 1 :] == end[: len(x) - size + 1] - (x[: len(x) - size + 1] == 0)
            whole &= x > 0
        alive = np.flatnonzero(whole)
        low, high = np.zeros(len(alive), dtype=np.int64), np.full(len(alive), len(x), dtype=np.int64)
        for k in reversed(range(size)):
            symbol = x[alive + k]
            low = self.below[symbol] + self.matrix.rank(symbol, low)
            high = self.below[symbol] + self.matrix.rank(symbol, high)
            go = self.weight[high] - self.weight[low] > 1
            alive, low, high = alive[go], low[go], high[go]
        out = np.zeros(len(x), dtype=bool)
        out[alive] = True
        return out


def _searched(words: list[bytes], times: list[int], window: int) -> list[tuple[int, int, int]]:
    """Runs of repeated windows in distinct texts: (text, first, number)."""
    number: dict[bytes, int] = {}
    texts = [[number.setdefault(w, len(number) + 1) for w in t.split(b" ")] for t in words]
    again = FMIndex(texts, times).occurs_twice(window)
    out, at = [], 0
    for i, t in enumerate(texts):
        edge = np.flatnonzero(np.diff(np.concatenate(([False], again[at : at + len(t)], [False])).astype(np.int8)))
        out += [(i, int(a), int(b - a)) for a, b in zip(edge[::2], edge[1::2])]
        at += len(t) + 1
    return out


# ------------------------------------------------------------------ the operator

def _repeats(documents: DataFrame, window: int, shard_words: int) -> DataFrame:
    """doc_id, th, runs: array of (first window, number of windows) that occur elsewhere."""
    rows = _block_rows(documents, window, bucket_count(documents, 1 / 100))
    found = stored(_candidates(rows))
    contents = found.groupBy("minimizer", "content", "n").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("doc_id", "th", "start")).alias("one"))
    contents = stored(contents)
    per = contents.groupBy("minimizer").agg(F.count(F.lit(1)).alias("several"))
    # a content that occurs twice repeats as a whole; one that occurs once may hold windows of the minimizer's other contents, or a window twice
    whole = contents.filter("times > 1").select("minimizer", "content", "n", F.array(F.struct(F.lit(0).alias("first"), F.col("n").alias("number"))).alias("runs"))
    per = per.filter("several > 1").unionByName(_own_repeats(found)).groupBy("minimizer").agg(F.max("several").alias("several"))
    unsure = stored(contents.join(per, "minimizer"))
    n_shards = max(int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                   int((unsure.agg(F.sum(F.when(F.col("several") > MANY, F.col("n") * window).otherwise(F.col("n") + window - 1))).first()[0] or 0) / shard_words) + 1)
    needs = (unsure.groupBy(F.col("one.doc_id").alias("n_id"), F.col("one.th").alias("n_th"))
             .agg(F.collect_list(F.struct(F.col("one.start").alias("start"), "n", "minimizer", "content", "times", "several")).alias("needs")))
    texts = documents.select(*doc_key(), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    needs = stored(needs)
    fetched = having(texts, needs.select(F.col("n_th").alias("th")), "th").join(needs, (F.col("th") == F.col("n_th")) & F.col("doc_id").eqNullSafe(F.col("n_id"))).select("text", "needs")
    schema = "shard int, times long, members array<struct<minimizer:long,content:long,n:int,at:int>>, words binary"
    row_type = pa.schema([("shard", pa.int32()), ("times", pa.int64()), ("members", pa.list_(pa.struct([("minimizer", pa.int64()), ("content", pa.int64()), ("n", pa.int32()), ("at", pa.int32())]))), ("words", pa.binary())])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            # single windows of crowded minimizers, put together before they are shuffled: (times, members) by words
            singles: dict[bytes, list] = {}
            for text, wanted in zip(batch.column("text").to_pylist(), batch.column("needs").to_pylist()):
                words = text.split()
                for x in wanted:
                    base = {"minimizer": x["minimizer"], "content": x["content"], "n": x["n"]}
                    if x["several"] <= MANY:
                        shard = int(mix(np.array([x["minimizer"]]).view(np.uint64))[0] % np.uint64(n_shards))
                        out.append({"shard": shard, "times": x["times"], "members": [base | {"at": 0}], "words": b" ".join(words[x["start"] : x["start"] + x["n"] + window - 1])})
                        continue
                    for k in range(x["n"]):
                        one = singles.setdefault(b" ".join(words[x["start"] + k : x["start"] + k + window]), [0, []])
                        one[0] += x["times"]
                        one[1].append(base | {"at": k})
            out += [{"shard": int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little") % n_shards, "times": times, "members": members, "words": w} for w, (times, members) in singles.items()]
            for at in range(0, len(out), 20_000):
                yield pa.RecordBatch.from_pylist(out[at : at + 20_000], schema=row_type)

    def search(group: pd.DataFrame) -> pd.DataFrame:
        texts = group.groupby("words", sort=False)["times"].sum()
        runs: dict[bytes, list[tuple[int, int]]] = {}
        for i, first, number in _searched(texts.index.tolist(), texts.tolist(), window):
            runs.setdefault(texts.index[i], []).append((first, number))
        found = [(m["minimizer"], m["content"], m["n"], m["at"] + first, number)
                 for words, members in zip(group["words"], group["members"]) for first, number in runs.get(words, ()) for m in members]
        return pd.DataFrame(found, columns=["minimizer", "content", "n", "first", "number"])

    searched = (fetched.mapInArrow(fetch, schema).groupBy("shard").applyInPandas(search, "minimizer long, content long, n int, first int, number int")
                .groupBy("minimizer", "content", "n").agg(F.collect_set(F.struct("first", "number")).alias("runs")))
    part = searched.join(whole.select("minimizer", "content", "n"), ["minimizer", "content", "n"], "left_anti")
    runs = whole.unionByName(part)
    return (found.join(runs, ["minimizer", "content", "n"])
            .groupBy("doc_id", "th").agg(F.collect_list(F.struct("start", "runs")).alias("runs")))


def _own_repeats(found: DataFrame) -> DataFrame:
    """Minimizers of contents that may hold a window twice: they are searched even when they stand alone."""
    return found.filter("n > 1").groupBy("minimizer").agg(F.count(F.lit(1)).alias("several")).filter("several = 1")


def removed(documents: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept_text per row."""
    prepare(documents.sparkSession)
    runs = _repeats(documents, window, shard_words).withColumnsRenamed({"doc_id": "r_id", "th": "r_th"})
    texts = documents.select(*doc_key(), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    rows = texts.join(runs, (F.col("th") == F.col("r_th")) & F.col("doc_id").eqNullSafe(F.col("r_id")), "left").select("doc_id", "text", "runs")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept_text = [], [], []
            for text, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist()):
                words = text.split()
                n_words.append(len(words))
                if not runs:
                    n_removed.append(0)
                    kept_text.append(b" ".join(words))
                    continue
                cover = np.zeros(len(words) + 1, dtype=np.int64)
                for s in runs:
                    for r in s["runs"]:
                        first = s["start"] + r["first"]
                        cover[first] += 1
                        cover[first + r["number"] + window - 1] -= 1
                gone = np.cumsum(cover)[:-1] > 0
                n_removed.append(int(gone.sum()))
                kept_text.append(b" ".join([w for w, g in zip(words, gone.tolist()) if not g]))
            digest = [hashlib.sha256(t).hexdigest() for t in kept_text]
            yield pa.record_batch([batch.column("doc_id").cast(pa.int64()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digest), pa.array(kept_text, pa.binary())],
                                  names=[c.split()[0] for c in schema.split(", ")])

    return rows.mapInArrow(cut, schema)
