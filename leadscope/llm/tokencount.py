"""Token counts: pieces are counted once per distinct pre-token and summed by pre-token frequency.

A byte-level BPE never joins pieces across pre-tokens, so a text has as many tokens as its pre-tokens have pieces.
No ids are materialised. The documents are split into pre-tokens in blocks; a block's distinct pre-tokens go, packed
by hash bucket, to one task per bucket, where each distinct pre-token is encoded once; the piece counts come back as
one byte per pre-token and are joined to the per-document frequencies of the block. So the shuffle carries a
pre-token once per block, not once per document, and neither a frequent pre-token nor a hot source is a hot key.

Edge cases: a null text counts as empty; an empty text has 0 bytes and 0 tokens. Special strings in a text count as one
token each, as in the library. Long texts are taken whole (a block holds at least one document). Repeated rows give
repeated results; an empty table gives no rows. Extra columns play no part.
"""

from __future__ import annotations

import json
import os
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .bpe import WS, split_words
from .common import blocks, bucket_count, exchange, joined_answers, prepare, stored

LIMIT = 1024
#: Fixed value: the splitting pattern of byte-level BPE vocabularies, white space written out.
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WS}\p{{L}}\p{{N}}]+|[{WS}]+(?![^{WS}])|[{WS}]+"
_BLOCK = "block long, ids array<long>, n_bytes array<long>, special array<int>, sizes array<int>, places binary, counts binary, parts array<binary>"
KEPT = 300_000


def pretokens(text: str, pattern: regex.Pattern, special: regex.Pattern | None) -> tuple[list[str], int]:
    """The text's pre-tokens and the number of special strings in it."""
    if special is None:
        return split_words(pattern, text), 0
    pieces = special.split(text)
    return (split_words(pattern, text), 0) if len(pieces) == 1 else ([w for p in pieces[::2] for w in split_words(pattern, p)], len(pieces) // 2)


def _special(spec: str) -> regex.Pattern | None:
    found = sorted((t["content"] for t in json.loads(spec)["added_tokens"]), key=len, reverse=True)
    return regex.compile("(" + "|".join(map(regex.escape, found)) + ")") if found else None


def counted(documents: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit per row."""
    spark = prepare(documents.sparkSession)
    with open(path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    # about one distinct pre-token of a block per 40 bytes of text
    n_buckets = bucket_count(documents, 1 / 40, 500_000)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern, special = regex.compile(PATTERN), _special(spec.value)
        for block, (ids, texts) in blocks(batches, ["doc_id", "text"]):
            place: dict[str, int] = {}
            places, counts, sizes, specials = [], [], [], []
            for text in texts:
                found, n = pretokens(text, pattern, special)
                tally = Counter(found)
                at = np.array([place.setdefault(w, len(place)) for w in tally], dtype=np.uint32)
                places.append(at)
                counts.append(np.fromiter(tally.values(), dtype=np.uint32, count=len(tally)))
                sizes.append(len(at))
                specials.append(n)
            words = list(place)
            bucket = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) % n_buckets for w in words], dtype=np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
            packed = [_pack([words[i] for i in order[a:b].tolist()]) if b > a else b"" for a, b in zip(cuts[:-1], cuts[1:])]
            rank = np.empty(len(words), dtype=np.uint32)
            rank[order] = np.arange(len(words), dtype=np.uint32)
            # per document ascending places, as differences: they are small, and so compress
            both = [_ascending(rank[p], c) for p, c in zip(places, counts)]
            none = np.zeros(0, dtype=np.uint32)
            yield _batch([block, ids, [len(t.encode("utf-8", "replace")) for t in texts], specials, sizes,
                          _small(np.concatenate([p for p, _ in both] or [none])), _small(np.concatenate([c for _, c in both] or [none])), packed])

    rows = stored(documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
                  .mapInArrow(split, _BLOCK))

    def pieces(group: pd.DataFrame) -> pd.DataFrame:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the work
        tokenizer = Tokenizer.from_str(spec.value)
        known: dict[str, int] = {}
        out = []
        for packed in group["keys"]:
            words = _unpack(packed)
            new = [w for w in words if w not in known]
            if len(known) + len(new) > KEPT * 4:
                known.clear()
                new = words
            for at in range(0, len(new), 4096):
                some = new[at : at + 4096]
                known.update(zip(some, (len(e) for e in tokenizer.encode_batch_fast(some, add_special_tokens=False))))
            # 255 and more take several bytes, see _sizes
            out.append(b"".join([_byte(known[w]) for w in words]))
        return pd.DataFrame({"block": group["block"], "bucket": group["bucket"], "answer": out})

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                pieces_of = _sizes(joined_answers(r["answers"]))
                steps, counts = _large(r["places"]), _large(r["counts"])
                out, at = [], 0
                for n, special in zip(r["sizes"], r["special"]):
                    out.append(int(pieces_of[np.cumsum(steps[at : at + n])] @ counts[at : at + n]) + special if n else special)
                    at += n
                yield pa.record_batch([pa.array(r["ids"], pa.int64()), pa.array(r["n_bytes"], pa.int64()), pa.array(out, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    answers = exchange(rows, pieces)
    out = rows.drop("parts").join(answers, "block", "left").mapInArrow(summed, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def _batch(row: list) -> pa.RecordBatch:
    types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.list_(pa.binary())]
    names = [c.split()[0] for c in _BLOCK.split(", ")]
    return pa.record_batch([pa.array([x], t) for x, t in zip(row, types)], names=names)


def _ascending(places: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(places)
    return np.diff(places[order], prepend=np.uint32(0)), counts[order]


def _small(x: np.ndarray) -> bytes:
    """Unsigned numbers: low and high bytes apart, compressed."""
    x = x.astype(np.uint32)
    return zlib.compress(b"".join([(x >> np.uint32(8 * k)).astype(np.uint8).tobytes() for k in range(4)]), 1)


def _large(data: bytes) -> np.ndarray:
    x = np.frombuffer(zlib.decompress(data), dtype=np.uint8).reshape(4, -1).astype(np.int64)
    return x[0] | x[1] << 8 | x[2] << 16 | x[3] << 24


def _pack(words: list[str]) -> bytes:
    """Strings with their lengths, as pre-tokens may hold any character."""
    data = [w.encode("utf-8", "surrogatepass") for w in words]
    return zlib.compress(np.array([len(words), *map(len, data)], dtype=np.uint32).tobytes() + b"".join(data), 1)


def _unpack(packed: bytes) -> list[str]:
    data = zlib.decompress(packed)
    n = int(np.frombuffer(data, dtype=np.uint32, count=1)[0])
    ends = np.cumsum(np.frombuffer(data, dtype=np.uint32, count=n, offset=4)) + 4 * (n + 1)
    return [data[a:b].decode("utf-8", "surrogatepass") for a, b in zip([4 * (n + 1), *ends[:-1].tolist()], ends.tolist())]


def _byte(n: int) -> bytes:
    """A number as bytes: as many 255 as it holds, then the rest."""
    return b"\xff" * (n // 255) + bytes([n % 255])


def _sizes(data: np.ndarray) -> np.ndarray:
    """The numbers that _byte wrote."""
    end = np.flatnonzero(data != 255)
    total = np.concatenate(([0], np.cumsum(data, dtype=np.int64)))
    return np.diff(total[end + 1], prepend=0)
