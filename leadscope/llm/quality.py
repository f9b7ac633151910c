"""Quality classifier: supervised subword embeddings.

Every word, every pair of neighbouring words (without order) and every character n-gram within a word (word boundaries
count as characters) is hashed to a bucket with a learned vector. A document is the average of its vectors; a softmax layer gives class probabilities. Both
layers are trained by stochastic gradient descent in numpy.

Learning reads a bounded, documented sample (``sample`` labelled documents, the smallest by a hash of their id,
split evenly between the classes; of each its bucket counts, so at most ``buckets`` numbers). Scoring reads every
whole text. As the output layer is linear in the average, a bucket contributes a fixed amount to each class, and
scoring sums those amounts; that is the same number as multiplying the averaged vector.

Edge cases: a null or empty text has no n-grams and gets the score of the bias alone, as the average of no vectors
is zero. Null labels are not learned from. A row whose id repeats is scored once per row; a label whose id repeats
counts once per row. Without labels of both classes every score is 0.5. Long texts are taken in pieces of whole
words. Other columns are untouched.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix, prepare_texts, range_hash, sampled

BUCKETS, DIM, SAMPLE, EPOCHS, RATE, THRESHOLD = 1 << 16, 16, 4000, 6, 0.4, 0.3
NGRAMS = (2, 3, 4)


def _pieces(text: str, size: int = 1 << 20) -> Iterator[str]:
    at = 0
    while at < len(text):
        end = at + size
        if end < len(text):
            cut = text.find(" ", end)
            end = len(text) if cut < 0 else cut
        yield text[at:end]
        at = end


def _piece_buckets(text: str, buckets: int) -> np.ndarray:
    words = text.split()
    if not words:
        return np.zeros(0, dtype=np.int64)
    x = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    space = np.flatnonzero(x == 32)
    word = range_hash(x, space[:-1], space[1:])
    # a pair's hash is symmetric, so that all pairs of a word with itself share one vector
    found = [word, mix((word[1:] ^ word[:-1]) + np.uint64(1))]
    inside = np.cumsum(x == 32)
    for n in NGRAMS:
        if len(x) < n:
            continue
        h = np.zeros(len(x) - n + 1, dtype=np.uint64)
        for k in range(n):
            h = h * np.uint64(0x100000001B3) + x[k : len(x) - n + 1 + k]
        # spaces may stand at the ends of an n-gram, not within it
        whole = inside[n - 2 : len(inside) - 1] - inside[: len(h)] == 0 if n > 2 else np.ones(len(h), dtype=bool)
        found.append(mix(h[whole] + np.uint64(n)))
    return (np.concatenate(found) % np.uint64(buckets)).astype(np.int64)


def text_buckets(text: str | None, buckets: int = BUCKETS) -> Iterator[np.ndarray]:
    """Buckets of all words and n-grams of the text, in pieces that bound memory."""
    for piece in _pieces(text or ""):
        yield _piece_buckets(piece, buckets)


@dataclass
class QualityModel:
    vectors: np.ndarray  # buckets x dim
    weights: np.ndarray  # dim x classes
    bias: np.ndarray

    def probability(self, texts: list[str | None]) -> np.ndarray:
        """Probability of class 1 for every text."""
        share = (self.vectors @ self.weights).astype(np.float64)
        buckets = len(share)
        margin = share[:, 1] - share[:, 0]
        out = np.empty(len(texts))
        for i, text in enumerate(texts):
            total, n = 0.0, 0
            for found in text_buckets(text, buckets):
                total += margin[found].sum()
                n += len(found)
            out[i] = self.bias[1] - self.bias[0] + (total / n if n else 0.0)
        return 1.0 / (1.0 + np.exp(-np.clip(out, -500, 500)))


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], buckets: int = BUCKETS, dim: int = DIM,
          epochs: int = EPOCHS, rate: float = RATE) -> QualityModel:
    """rows: (class, buckets, counts) per document. Each class weighs the same in sum."""
    rng = np.random.default_rng(7)
    model = QualityModel((rng.random((buckets, dim), dtype=np.float32) - 0.5) / dim, np.zeros((dim, 2), dtype=np.float32), np.zeros(2, dtype=np.float32))
    classes = np.bincount([y for y, _, _ in rows], minlength=2)
    if not rows or not classes.all():
        return model
    weight = len(rows) / (2 * classes)
    steps, total = 0, epochs * len(rows)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            y, found, counts = rows[i]
            lr = np.float32(rate * (1 - steps / total) * weight[y])
            steps += 1
            share = (counts / max(1, counts.sum(dtype=np.int64))).astype(np.float32)
            hidden = share @ model.vectors[found]
            z = hidden @ model.weights + model.bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = model.weights @ p
            model.weights -= lr * np.outer(hidden, p)
            model.bias -= np.float32(0.1) * lr * p
            model.vectors[found] -= lr * len(NGRAMS) * share[:, None] * back[None, :]
    return model


def _packed(x: np.ndarray) -> bytes:
    """Numbers in the fewest bytes that hold them all (named by the first byte), compressed: the driver keeps the sample."""
    kind = np.min_scalar_type(int(x.max(initial=0)))
    return kind.char.encode() + zlib.compress(x.astype(kind).tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data[1:]), dtype=np.dtype(data[:1].decode()))


def learnable() -> Column:
    """Documents whose labels may be learned from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, buckets: int = BUCKETS) -> QualityModel:
    """Learn from a bounded sample of the labelled documents (columns doc_id, text and doc_id, quality)."""
    spark = prepare_texts(documents.sparkSession)
    marked = (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("y"))
              .filter(F.col("y").isin(0, 1) & learnable()))
    # which rows: decided on ids alone, so that only the sample's texts move; at most `sample` rows of two numbers
    ids = sampled(marked, "y", sample // 2).collect()
    if not ids:
        return train([], buckets)
    wanted = spark.createDataFrame(ids, marked.schema)
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(wanted), "doc_id")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text, y in zip(batch["doc_id"], batch["text"], batch["y"]):
                tally = np.zeros(buckets, dtype=np.int64)
                for found in text_buckets(text, buckets):
                    tally += np.bincount(found, minlength=buckets)
                found = np.flatnonzero(tally)
                out.append((doc_id, y, _packed(found), _packed(tally[found])))
            yield pd.DataFrame(out, columns=["doc_id", "y", "found", "counts"])

    # copies of an id would unbound the sample: again the first `sample` rows
    rows = texts.mapInPandas(count, "doc_id long, y int, found binary, counts binary").orderBy("doc_id", "y", "found", "counts").limit(sample).collect()
    return train([(r.y, _unpacked(r.found), _unpacked(r.counts)) for r in rows], buckets)


def score(text: Column, model: QualityModel) -> Column:
    """Column of the probability that the text is of class 1."""
    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(model.probability([t if isinstance(t, str) else None for t in batch]))

    return probability(text)


def scored(documents: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    prepare_texts(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), score(F.col("text"), model).alias("score"))
    return rows.select("doc_id", (~F.coalesce(learnable(), F.lit(True))).alias("held_out"), "score",
                       (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(documents: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier doesn't reject, with their own columns only."""
    prepare_texts(documents.sparkSession)
    return documents.filter(score(F.col("text"), model) >= threshold)
