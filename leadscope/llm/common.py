"""Helpers shared by the corpus operators: worker setup, word hashing, blocks and the packed key exchange."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import ensure_checkpoint_dir

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
#: Multiplier of the polynomial hashes (odd, so that it has an inverse modulo 2**64).
A = 0x9E3779B97F4A7C15
A_INV = pow(A, -1, 1 << 64)
WHITE = re.compile(rb"[\t-\r ]")
#: Spark's setting of the bytes that go to a Python worker in one batch, and the bound where whole texts or sets are sent.
BATCHES, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Set the checkpoint folder and let Python workers find this package where the driver did."""
    ensure_checkpoint_dir(spark)
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    return spark


def prepare_texts(spark: SparkSession) -> SparkSession:
    """``prepare``; and batches of rows for Python workers are bounded in bytes, unless the session has a bound of its own.

    The executor's JVM and the worker each hold a batch in several copies, and keep the room. By default 10,000 rows
    make a batch. The bound splits batches, never rows, and it stays set: plans are made when the caller runs them.
    """
    if spark.conf.get(BATCHES, None) is None:
        spark.conf.set(BATCHES, str(BATCH_BYTES))
    return prepare(spark)


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage: rows go to the shared checkpoint folder, so that lost executors cost no recomputation."""
    prepare(df.sparkSession)
    return df.checkpoint()


def forget(*frames: DataFrame) -> None:
    """Delete the files of stored frames, of which nothing will be read any more: all that was made from them is stored."""
    for df in frames:
        file = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
        if file.isDefined():
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(file.get())
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


#: Spark's setting by which the shuffle files of a plan go when its execution ends, not when the driver's memory is next cleaned.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written within leaves no shuffle files: a write plans its own shuffles, so nothing else reads them."""
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, before)


class Tables:
    """Tables of one run in the shared checkpoint folder: written as Parquet, read again, and deleted when not needed any more.

    A table is only deleted when all that was made from it has been written itself, so that a lost executor's tasks find
    what they read. The shuffle files of a write are deleted once the table stands.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.named: dict[str, str] = {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        with shuffles_dropped(self.spark):
            df.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def keep_by(self, df: DataFrame, name: str, key: str) -> DataFrame:
        """Kept in buckets of the key, as many as shuffle partitions: joins by the key leave these rows where they are."""
        table = f"{os.path.basename(self.folder)}_{name}".replace("-", "_")
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        with shuffles_dropped(self.spark):
            df.write.format("parquet").option("path", f"{self.folder}/{name}").bucketBy(n, key).saveAsTable(table)
        self.named[name] = table
        return self.spark.table(table)

    def drop(self, *names: str) -> None:
        for name in names:
            if name in self.named:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.named.pop(name)}")
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_key() -> list:
    """doc_id and a hash of the text: what a row is found by again when the table is read a second time."""
    return [F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("th")]


def sampled(rows: DataFrame, by: str, most: int, key: str = "doc_id") -> DataFrame:
    """Per value of ``by`` the ``most`` rows with the smallest hashes of the key, without sorting all rows.

    Counts (one row per value, few by contract) give the part of the hash range that holds enough rows; the rest is
    filtered away in place. Rows whose keys repeat may fall short of the part, so the part has room to spare.
    """
    counts = {r[by]: r["count"] for r in rows.groupBy(by).count().collect()}
    span = 1 << 31
    parts = {value: min(span, int(span * 1.5 * (most + 200) / n)) for value, n in counts.items()}
    hashed = F.pmod(F.xxhash64(key), F.lit(span))
    if len(parts) > 200:  # too many for an expression
        few = rows.sparkSession.createDataFrame(list(parts.items()), StructType([StructField("_by", rows.schema[by].dataType), StructField("_part", LongType())]))
        near = rows.withColumn("_hash", hashed).join(F.broadcast(few), F.col(by).eqNullSafe(F.col("_by"))).filter("_hash < _part").drop("_by", "_part")
    else:
        part = F.lit(0)
        for value, n in parts.items():
            part = F.when(F.col(by).eqNullSafe(F.lit(value)), F.lit(n)).otherwise(part)
        near = rows.withColumn("_hash", hashed).filter(F.col("_hash") < part)
    order = Window.partitionBy(by).orderBy("_hash", *rows.columns)
    return near.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= most).drop("_n", "_hash")


def having(rows: DataFrame, keys: DataFrame, key: str, most: int = 2_000_000) -> DataFrame:
    """The rows whose (bigint) key is among the keys, where these are few enough to broadcast; else all rows.

    For a join that follows: it then shuffles the rows it needs alone. The number of distinct keys is counted first.
    """
    few = keys.select(key).distinct()
    return rows.join(F.broadcast(few), key, "left_semi") if few.limit(most + 1).count() <= most else rows


# ------------------------------------------------------------------ hashing

def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads all bits (splitmix64's finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """A**i and A**-i modulo 2**64 for i < n."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", A), ("down", A_INV)):
            x = np.full(size, base, dtype=np.uint64)
            x[0] = 1
            _POWERS[name] = np.cumprod(x, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def range_hash(x: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of x[start:end] for each range; equal contents have equal hashes wherever they stand."""
    up, down = powers(len(x) + 1)
    total = np.zeros(len(x) + 1, dtype=np.uint64)
    np.cumsum(x * up[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _piece_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    b = np.frombuffer(data, dtype=np.uint8)
    edge = np.flatnonzero(np.diff(np.concatenate(([True], _SPACE[b], [True])).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    return range_hash(b.astype(np.uint64) + np.uint64(1), starts, ends), starts


def word_hashes(data: bytes, piece: int = 1 << 21) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and byte offsets of the words (runs of anything but x20, x09-x0D); in pieces, to bound memory."""
    if len(data) <= piece:
        return _piece_hashes(data)
    hashes, offsets, at = [], [], 0
    while at < len(data):
        cut = WHITE.search(data, min(at + piece, len(data)))
        end = cut.start() if cut else len(data)
        h, s = _piece_hashes(data[at:end])
        hashes.append(h)
        offsets.append(s + at)
        at = end
    return np.concatenate(hashes), np.concatenate(offsets)


def grouped_words(texts: list[bytes], size: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last + 1, word hashes, word bounds per text) for groups of texts of about ``size`` bytes."""
    at = 0
    while at < len(texts):
        end, total = at, 0
        while end < len(texts) and (end == at or total + len(texts[end]) <= size):
            total += len(texts[end]) + 1
            end += 1
        group = texts[at:end]
        hashes, starts = word_hashes(b"\n".join(group))
        offsets = np.cumsum([0, *(len(t) + 1 for t in group)])
        yield at, end, hashes, np.searchsorted(starts, offsets)
        at = end


# ------------------------------------------------------------------ blocks of documents and the key exchange

def blocks(batches: Iterable, columns: list[str], max_docs: int = 4096, max_bytes: int = 12 << 20) -> Iterator[tuple[int, list[list]]]:
    """Cut a partition's rows into blocks: (block id, one list per column); the last column is the text.

    Ids derive from the partition's number, so a retried task gives the same blocks.
    """
    n, base, rows, held = 0, TaskContext.get().partitionId() << 32, [[] for _ in columns], 0
    for batch in batches:
        for row in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns)):
            if rows[0] and (len(rows[0]) >= max_docs or held + len(row[-1]) > max_bytes):
                yield base + n, rows
                n, rows, held = n + 1, [[] for _ in columns], 0
            held += len(row[-1])
            for values, x in zip(rows, row):
                values.append(x)
    if rows[0]:
        yield base + n, rows


def bucket_count(docs: DataFrame, keys_per_byte: float, keys_in_bucket: int = 2_000_000) -> int:
    """Buckets for the key exchange: as many as shuffle partitions, or more where a bucket would get too many keys."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(size * keys_per_byte / keys_in_bucket) + 1)


def pack_keys(keys: np.ndarray, n_buckets: int) -> tuple[np.ndarray, list[bytes]]:
    """Keys dealt into buckets, 32 bits kept of each, in order; and which key stands at each place.

    Equal keys are equal after packing. Of different keys in one bucket one in thousands may meet, so what is
    found repeated is a candidate to be verified, and what is found single is single.
    """
    bucket = (keys & np.uint64(0xFFFFFFFF)) % np.uint64(n_buckets)
    joint = (bucket << np.uint64(32)) | (keys >> np.uint64(32))
    order = np.argsort(joint, kind="stable")
    joint = joint[order]
    cuts = np.searchsorted(joint, np.arange(n_buckets + 1, dtype=np.uint64) << np.uint64(32))
    rest = joint.astype(np.uint32)
    return order, [rest[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]


def _repeated_keys(group: pd.DataFrame) -> pd.DataFrame:
    parts = [np.frombuffer(x, dtype=np.uint32) for x in group["keys"]]
    keys = np.concatenate(parts)
    _, place, counts = np.unique(keys, return_inverse=True, return_counts=True)
    flags = (counts > 1)[place]
    ends = np.cumsum([len(x) for x in parts])
    return pd.DataFrame({"block": group["block"], "bucket": group["bucket"],
                         "answer": [x.tobytes() for x in np.split(flags.astype(np.uint8), ends[:-1])]})


def exchange(rows: DataFrame, answer: Callable[[pd.DataFrame], pd.DataFrame] = _repeated_keys) -> DataFrame:
    """Send the packed keys of every block (columns block, parts) to their buckets and the answers back.

    One row per block and bucket goes each way instead of one per key, and a key that is in every document is
    one key per block: no bucket is hot. ``answer`` gives, for the rows of one bucket, one byte per key; by
    default whether the key occurs more than once. Result: block, answers (all bytes in the order of ``pack_keys``).
    """
    sent = rows.select("block", F.posexplode("parts").alias("bucket", "keys")).filter(F.octet_length("keys") > 0)
    back = sent.groupBy("bucket").applyInPandas(answer, "block long, bucket int, answer binary")
    return back.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("bucket", "answer"))).alias("answers"))


def joined_answers(answers: list | None) -> np.ndarray:
    return np.frombuffer(b"".join(x["answer"] for x in answers or []), dtype=np.uint8)
