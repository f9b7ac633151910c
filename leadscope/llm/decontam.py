"""Benchmark decontamination with an Aho-Corasick automaton.

Texts are reduced to words (runs of letters and digits after lower-casing A-Z; all non-ASCII characters belong to
words). Every 13 consecutive words of a benchmark item, or all of a shorter one, are a window. The windows of all
items form one automaton; each document's word stream passes through it once, in the executors. Hits are word
ranges; ``spans`` maps them to character offsets of the original text.

The benchmark is the broadcast side, so its size is checked: windows are cut into blocks of at most ``BLOCK_BYTES``
of pattern text, one automaton each. One block is the normal case; beyond it documents pass through each block and
the ranges of a document are united. The cost is the text's size times the number of blocks, never pairs of rows.

Edge cases: a null or empty text has no words, no hits, and isn't contaminated; an item without words has no window.
Items with equal texts each count. An item id that repeats counts once; a null item id is written as an empty text.
Rows are judged one by one, so ties and repeated rows behave alike. An empty benchmark or table gives no hits or rows.
Other columns are untouched.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare_texts

WINDOW = 13
SHARE = 20  # contaminated: at least one of SHARE words is hit
BLOCK_BYTES = 32 << 20
_KEEP = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text: str | None) -> list[bytes]:
    """Words of the text after lower-casing A-Z, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_KEEP).split() if text else []


def windows(text: str | None, size: int = WINDOW) -> set[bytes]:
    w = words(text)
    return {b" ".join(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def window_blocks(benchmark: DataFrame, size: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> Iterator[dict[bytes, list[str]]]:
    """window -> ids of the items that hold it, in blocks of bounded size; items arrive one partition at a time."""
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text").orderBy("item_id", "text")
    block, held = {}, 0
    for row in rows.toLocalIterator():
        for w in windows(row.text, size):
            ids = block.setdefault(w, [])
            held += len(w) * (not ids) + 16
            if row.item_id not in ids[-1:]:
                ids.append(row.item_id)
        if held >= block_bytes:
            yield block
            block, held = {}, 0
    if block:
        yield block


class Matcher:
    """The automaton over the windows of one block; words are framed by spaces, so that only whole words match."""

    def __init__(self, block: dict[bytes, list[str]]):
        self.items = list(block.values())
        self.automaton = ahocorasick.Automaton()
        for i, w in enumerate(block):
            self.automaton.add_word(f" {w.decode('latin-1')} ", (i, len(w) + 2, w.count(b" ") + 1))
        if block:
            self.automaton.make_automaton()

    def find(self, text: str | None) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words; hit word ranges (first, last + 1), joined where they meet; ids of the items found."""
        w = words(text)
        if not w or not self.items:
            return len(w), [], set()
        stream = f" {b' '.join(w).decode('latin-1')} "
        hits = list(self.automaton.iter(stream))
        if not hits:
            return len(w), [], set()
        # a hit's first character is the space before its first word: the number of spaces before it is that word's number
        spaces = np.flatnonzero(np.frombuffer(stream.encode("latin-1"), dtype=np.uint8) == 32)
        first = np.searchsorted(spaces, [end - length + 1 for end, (_, length, _) in hits])
        ranges = sorted((int(a), int(a) + n) for a, (_, (_, _, n)) in zip(first, hits))
        return len(w), united(ranges), {x for _, (i, _, _) in hits for x in self.items[i]}


def united(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def offsets(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character offsets in the original text of word ranges in the normalised one."""
    # lower-casing A-Z changes no character's place, but A-Z aren't in the pattern
    at = [m.span() for m in _WORD.finditer(text.translate(_LOWER))]
    return [(at[a][0], at[b - 1][1]) for a, b in ranges]


_LOWER = {c: c + 32 for c in range(65, 91)}
_FOUND = "n_words bigint, ranges array<struct<first:int,last:int>>, items array<string>, n_hit bigint, n_items bigint, items_sha256 string"


def _items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def _found(text: Column, block: dict[bytes, list[str]]) -> Column:
    shared = []

    @F.pandas_udf(_FOUND)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        if not shared:
            shared.append(Matcher(block))
        for batch in batches:
            found = [shared[0].find(t if isinstance(t, str) else None) for t in batch]
            items = [sorted(i) for _, _, i in found]
            yield pd.DataFrame({"n_words": [n for n, _, _ in found],
                                "ranges": [[{"first": a, "last": b} for a, b in r] for _, r, _ in found],
                                "items": items, "n_hit": [sum(b - a for a, b in r) for _, r, _ in found],
                                "n_items": [len(i) for i in items], "items_sha256": [_items_digest(i) for i in items]})

    return find(text)


def _joined(ranges: Column, items: Column) -> Column:
    @F.pandas_udf("n_hit bigint, items_sha256 string, n_items bigint")
    def join(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for firsts, lasts, found in batches:
            hit = [sum(b - a for a, b in united([(int(a), int(b)) for a, b in zip(x, y)])) for x, y in zip(firsts, lasts)]
            ids = [sorted(set(i)) for i in found]
            yield pd.DataFrame({"n_hit": hit, "items_sha256": [_items_digest(i) for i in ids], "n_items": [len(i) for i in ids]})

    return join(ranges["first"], ranges["last"], items)


def judged(documents: DataFrame, benchmark: DataFrame, size: int = WINDOW, block_bytes: int = BLOCK_BYTES, name: str = "contamination") -> DataFrame:
    """The documents with one more column: struct<n_words, n_hit, n_items, items_sha256, contaminated, ranges>.

    Each block's automaton reads the rows in place; a row's findings are joined within the row.
    """
    prepare_texts(documents.sparkSession)
    own = documents.columns
    rows = documents.select(F.struct(*[documents[c] for c in own]).alias("r"))
    found = [_found(F.col("r.text"), block) for block in window_blocks(benchmark, size, block_bytes)] or [_found(F.col("r.text"), {})]
    if len(found) == 1:
        rows = rows.select("r", found[0].alias("u")).select("r", "u", F.col("u.n_words").alias("n_words"), F.col("u.ranges").alias("ranges"))
    else:
        rows = rows.select("r", F.array(*found).alias("f"))
        rows = rows.select("r", _joined(F.flatten("f.ranges"), F.flatten("f.items")).alias("u"), F.col("f")[0]["n_words"].alias("n_words"), F.flatten("f.ranges").alias("ranges"))
    n_words, n_hit = F.col("n_words"), F.col("u.n_hit")
    verdict = F.struct("n_words", n_hit.alias("n_hit"), F.col("u.n_items").alias("n_items"), F.col("u.items_sha256").alias("items_sha256"),
                       ((n_hit > 0) & (SHARE * n_hit >= n_words)).alias("contaminated"), "ranges")
    return rows.select(*[F.col("r").getField(c).alias(c) for c in own], verdict.alias(name))


def report(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated per row."""
    return judged(documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), benchmark).select("doc_id", *[f"contamination.{c}" for c in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")])


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that aren't contaminated, with their own columns only."""
    own = documents.columns
    name = "contamination"
    while name in own:
        name += "_"
    out = judged(documents, benchmark, name=name)
    return out.filter(~F.col(name)["contaminated"]).select(*[out[c] for c in own])


def spans(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, start, end per hit passage: character offsets (end exclusive) in the original text."""
    rows = judged(documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), benchmark)
    hit = rows.filter(F.col("contamination.n_hit") > 0)

    @F.pandas_udf("array<struct<start:int,end:int>>")
    def located(texts: pd.Series, firsts: pd.Series, lasts: pd.Series) -> pd.Series:
        return pd.Series([[{"start": a, "end": b} for a, b in offsets(t, united([(int(a), int(b)) for a, b in zip(x, y)]))] for t, x, y in zip(texts, firsts, lasts)])

    return hit.select("doc_id", F.explode(located("text", F.col("contamination.ranges.first"), F.col("contamination.ranges.last"))).alias("s")).select("doc_id", "s.start", "s.end")
