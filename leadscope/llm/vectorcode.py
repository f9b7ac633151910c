"""Vector code compression: product codes by integer k-means, distances by a Walsh-Hadamard transform.

Components become integers (floor of 4096 x). A vector is cut into 8 parts, and each part position has a codebook of
16 entries, which 6 rounds of assignment and floored means refine. To find a part's nearest entry, part and entries are
padded with zeros to a power of two and transformed (Walsh-Hadamard, sums and differences only). The transform
scales every squared distance by the same power of two, so squared differences of coefficients, added up in
sequency order, are lower bounds of the scaled distance: an entry goes as soon as its sum passes the whole distance of
the part's best entry so far. Equal distances go to the lower index. No floating point takes part after the first
floor, which is exact: 4096 is a power of two.

A round is one pass over the vectors. Every partition adds up its parts per entry and sends one row for each entry and
component; Spark sums these, and the codebooks (8 x 16 entries) are all that the driver sees. Numbers that 64 bits
can't hold are taken as Python integers; sums travel in limbs of 32 bits, so they are exact at any size.

Edge cases: vectors that are null or hold null or non-finite components are dropped. Vectors of different lengths, or
lengths that 8 doesn't divide, are padded with zeros at the end to the next multiple of 8 of the longest. Of rows
that repeat one of the 16 smallest vec_ids, the one with the smallest components starts the codebook; a null vec_id counts
as the largest. With fewer than 16 ids the codebooks are shorter. An error beyond 64 bits is null, and so is the sum
over its label. Extra columns play no part; an empty table, or one whose vectors are all dropped, gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction
from math import floor, isfinite

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, stored

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Rows that are judged together.
STEP = 16_384
LIMB = 32
SHARE = 1e-5


def sequency_order(size: int) -> np.ndarray:
    """Rows of the (natural order) Walsh-Hadamard matrix by their number of sign changes: bit-reversed Gray code."""
    bits = max(size - 1, 0).bit_length()
    return np.array([int(format(k ^ k >> 1, f"0{bits}b")[::-1], 2) if bits else 0 for k in range(size)], dtype=np.int64)


def transformed(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the last axis, padded with zeros to a power of two, coefficients by sequency."""
    size = 1 << max(x.shape[-1] - 1, 0).bit_length()
    y = np.zeros((*x.shape[:-1], size), dtype=x.dtype)
    y[..., : x.shape[-1]] = x
    half = 1
    while half < size:
        z = y.reshape(*x.shape[:-1], size // (2 * half), 2, half)
        y = np.stack((z[..., 0, :] + z[..., 1, :], z[..., 0, :] - z[..., 1, :]), axis=-2).reshape(*x.shape[:-1], size)
        half *= 2
    return y[..., sequency_order(size)]


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each part, and the squared distance; ties to the lower index."""
    n, size = len(parts), 1 << max(parts.shape[1] - 1, 0).bit_length()
    of_part, of_entry = transformed(parts), transformed(entries)
    first = (of_part[:, :1] - of_entry[:, 0]) ** 2
    # an upper bound: the whole distance of the entry that the first coefficient favours
    guess = first.argmin(axis=1)
    bound = ((of_part - of_entry[guess]) ** 2).sum(axis=1)
    row, entry = np.nonzero(first <= bound[:, None])
    total = first[row, entry]
    at, step = 1, 1
    while at < size:
        end = min(size, at + step)
        total = total + ((of_part[row, at:end] - of_entry[entry, at:end]) ** 2).sum(axis=1)
        alive = total <= bound[row]
        row, entry, total = row[alive], entry[alive], total[alive]
        at, step = end, step * 2
    # what is left is complete: the least total, then the lowest index
    best = np.full(n, -1, dtype=np.int64)
    least = bound.copy()
    np.minimum.at(least, row, total)
    hit = total == least[row]
    row, entry = row[hit][::-1], entry[hit][::-1]
    best[row] = entry  # the lowest index of a row is written last
    return best, least // size


def _fits(most: int, wide: int) -> bool:
    """Whether scaled distances of parts with such components stay within 64 bits."""
    size = 1 << max(wide - 1, 0).bit_length()
    return 4 * size**3 * most**2 < 1 << 62


def _integers(column: pa.Array, width: int | None = None) -> tuple[list[int], np.ndarray | list[list[int]]]:
    """The rows to keep, and their components as integers: one array, or lists where lengths or sizes ask for it."""
    flat = column.flatten()
    if column.null_count == 0 and flat.null_count == 0 and pa.types.is_floating(flat.type) and len(flat):
        x, sizes = flat.to_numpy(zero_copy_only=False).astype(np.float64), np.asarray(column.value_lengths())
        if (sizes == (width or sizes[0])).all() and np.isfinite(x).all() and np.abs(x).max() < 2.0**40:
            return list(range(len(column))), np.floor(x * SCALE).astype(np.int64).reshape(len(column), -1)
    rows = [(at, row) for at, row in enumerate(column.to_pylist()) if row is not None and all(x is not None and isfinite(x) for x in row)]
    return [at for at, _ in rows], [[floor(Fraction(x) * SCALE) for x in row] for _, row in rows]


def _vectors(column: pa.Array, width: int) -> Iterator[tuple[list[int], np.ndarray]]:
    """Places and vectors of the kept rows, padded to the width; Python integers where 64 bits may not do."""
    for at in range(0, len(column), STEP):
        keep, rows = _integers(column.slice(at, STEP), width)
        if keep:
            if isinstance(rows, list):
                rows = np.array([r + [0] * (width - len(r)) for r in rows], dtype=object).reshape(len(rows), width)
                if all(abs(x) < 1 << 60 for x in rows.ravel().tolist()):
                    rows = rows.astype(np.int64)
            yield [at + k for k in keep], rows


class Codebooks:
    """Entries per part position; integers of any size."""

    def __init__(self, entries: list[list[list[int]]]):
        self.entries = entries
        self.wide = len(entries[0][0])
        self.most = max((abs(x) for book in entries for entry in book for x in entry), default=0)

    def assigned(self, vectors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per part position: the parts, their entries and squared distances."""
        most = max(self.most, *(abs(int(x)) for x in (vectors.min(), vectors.max()))) if vectors.size else 0
        kind = np.int64 if _fits(most, self.wide) else object
        for p, entries in enumerate(self.entries):
            parts = vectors[:, p * self.wide : (p + 1) * self.wide].astype(kind)
            yield (parts, *nearest(parts, np.array(entries, dtype=kind).reshape(len(entries), self.wide)))

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(x) for book in self.entries for entry in book for x in entry).encode()).hexdigest()


def _survey(embeddings: DataFrame, n_entries: int) -> tuple[list, int | None]:
    """The smallest distinct vec_ids of kept rows, and the longest vector; some rows per partition travel."""
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        smallest, none, longest = np.zeros(0, dtype=np.int64), False, -1
        for batch in batches:
            keep, rows = _integers(batch.column(1))
            if keep:
                ids = batch.column(0).take(pa.array(keep))
                none = none or ids.null_count > 0
                smallest = np.unique(np.concatenate((smallest, ids.drop_null().to_numpy())))[:n_entries]
                longest = max(longest, max(map(len, rows)))
        if longest >= 0:
            found = [*smallest.tolist(), *([None] if none else [])]
            yield pa.record_batch([pa.array(found, pa.int64()), pa.array([longest] * len(found), pa.int64())], names=["vec_id", "longest"])

    found = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").mapInArrow(look, "vec_id long, longest long")
    found = found.groupBy("vec_id").agg(F.max("longest").alias("longest"))
    rows = found.orderBy(F.col("vec_id").asc_nulls_last()).limit(n_entries).collect()
    return [r.vec_id for r in rows], found.agg(F.max("longest")).first()[0] if rows else None


def fit(embeddings: DataFrame, rounds: int = ROUNDS, n_entries: int = ENTRIES) -> Codebooks | None:
    """Codebooks after the rounds; None where no vector is kept."""
    prepare(embeddings.sparkSession)
    ids, longest = _survey(embeddings, n_entries)
    if longest is None:
        return None
    wide = -(-longest // PARTS)
    with_id = F.col("vec_id").isin([i for i in ids if i is not None])
    chosen = embeddings.filter(with_id | F.col("vec_id").isNull() if None in ids else with_id).filter(
        F.col("embedding").isNotNull() & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    start = chosen.groupBy("vec_id").agg(F.min("embedding").alias("embedding")).orderBy(F.col("vec_id").asc_nulls_last()).collect()
    vectors = [[floor(Fraction(x) * SCALE) for x in r.embedding] + [0] * (PARTS * wide - len(r.embedding)) for r in start]
    books = Codebooks([[v[p * wide : (p + 1) * wide] for v in vectors] for p in range(PARTS)])
    for _ in range(rounds):
        books = _refined(embeddings, books)
    return books


def _refined(embeddings: DataFrame, books: Codebooks) -> Codebooks:
    """One round: each entry becomes the floored mean of its parts; entries without parts stay."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], list[int]] = {}
        for batch in batches:
            for _, vectors in _vectors(batch.column(0), PARTS * books.wide):
                for p, (parts, entry, _) in enumerate(books.assigned(vectors)):
                    for e in np.unique(entry).tolist():
                        members = parts[entry == e]
                        # a batch's sum fits where the scaled distances do
                        new = [len(members), *(int(x) for x in members.sum(axis=0))]
                        total[p, e] = [a + b for a, b in zip(total[p, e], new)] if (p, e) in total else new
        rows = [(p, e, at, k, limb) for (p, e), values in total.items() for at, x in enumerate(values) for k, limb in enumerate(_limbs(x))]
        if rows:
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows)], names=["part", "entry", "at", "limb", "value"])

    found = embeddings.select("embedding").mapInArrow(sums, "part long, entry long, at long, limb long, value long")
    totals: dict[tuple[int, int], list[int]] = {}
    for r in found.groupBy("part", "entry", "at", "limb").agg(F.sum("value").alias("value")).collect():
        totals.setdefault((r.part, r.entry), [0] * (books.wide + 1))[r.at] += r.value << LIMB * r.limb
    new = [[[x // totals[p, e][0] for x in totals[p, e][1:]] if (p, e) in totals else entry for e, entry in enumerate(book)]
           for p, book in enumerate(books.entries)]
    return Codebooks(new)


def _limbs(x: int) -> list[int]:
    """x as a sum of limbs times powers of 2**32; the last one carries the sign."""
    out = []
    while not -(1 << LIMB) < x < 1 << LIMB:
        out.append(x & (1 << LIMB) - 1)
        x >>= LIMB
    return [*out, x]


def encoded(embeddings: DataFrame, books: Codebooks | None) -> DataFrame:
    """vec_id, code, error, label (as text) of the kept rows."""
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hexes = np.array([f"{k:02x}" for k in range(256)])
        for batch in batches:
            for keep, vectors in _vectors(batch.column(2), PARTS * books.wide) if books else ():
                codes, error = [], np.zeros(len(keep), dtype=object)
                for _, entry, distance in books.assigned(vectors):
                    codes.append(hexes[entry])
                    error = error + distance
                values = [int(e) if e < 1 << 63 else None for e in error]
                rows = pa.array(keep)
                yield pa.record_batch([batch.column(0).take(rows), pa.array(list(map("".join, zip(*codes)))), pa.array(values, pa.int64()), batch.column(1).take(rows)],
                                      names=["vec_id", "code", "error", "label"])

    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("string").alias("label"), "embedding")
    return rows.mapInArrow(assign, "vec_id long, code string, error long, label string")


def coded(embeddings: DataFrame, rounds: int = ROUNDS, n_entries: int = ENTRIES, share: float = SHARE) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 per kept row."""
    books = fit(embeddings, rounds, n_entries)
    rows = stored(encoded(embeddings, books).select("vec_id", "code", "error", F.col("label").isNull().alias("no_label"), F.coalesce("label", F.lit("")).alias("label")))
    label = ["no_label", "label"]
    sums = rows.groupBy(*label).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("error").cast("decimal(38,0)")).alias("total"), F.count("error").alias("known"))
    sums = stored(sums.select(*label, "n", F.when(F.col("known") == F.col("n"), F.expr("try_cast(total AS bigint)")).alias("label_error")))
    # a label may hold a third of all rows: the sums of labels beyond a share of the rows, 1 / share at most, are broadcast
    total = sums.agg(F.sum("n")).first()[0] or 0
    hot, cold = sums.filter(F.col("n") > share * total).drop("n"), sums.filter(F.col("n") <= share * total).drop("n")
    out = rows.join(F.broadcast(hot), label)
    if not cold.isEmpty():
        rest = rows.join(F.broadcast(hot.select(*label)), label, "left_anti")
        out = out.unionByName(rest.join(cold, label))
    return out.select("vec_id", "code", "error", "label_error", F.lit(books.digest() if books else "").alias("codebooks_sha256"))
