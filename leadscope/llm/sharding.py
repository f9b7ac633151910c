"""Sharding by extendible hashing.

A document's key is hashed to 60 bits. A directory starts at a global depth and, where a bucket holds more bytes
than a shard may have, only that bucket splits on further bits. A shard is the shortest hash prefix whose documents
fit the limit. Rows that no bit can tell apart (repeated rows of one id and text) fill overflow pages of the limit.
DataFrame functions only.

One aggregate gives the total and so the first depth (cells of about an eighth of a shard); a second one the bytes
per cell, with map-side sums. Depths above are sums over cells. Cells still over the limit are counted again on
deeper bits, those cells alone, until none is left or the bits are used up. No text moves: only ids, sizes, hashes.

Edge cases: a null id and a null text hash as such; an empty or null text has 0 bytes. A document larger than the
limit gets a shard for itself (oversized). Repeated rows share a prefix; together beyond the limit, they are
dealt to pages by their count. An empty table gives no rows. Other columns play no part.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, stored

LIMIT = 32 << 20
BITS = 60
STEP = 6


def hash_bits(key: Column) -> Column:
    """The first 60 bits of the key's md5, as a bigint."""
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("bigint")


def _prefix(bits: int) -> Column:
    return F.shiftright(F.col("hash"), BITS - bits)


def _split(cells: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """cells (cell of `high` bits, bytes): each cell's shard, the shortest prefix of `low` bits or more that fits.

    Result: cell, depth, shard (prefix), shard_bytes; cells that are over the limit themselves have depth null.
    """
    above = cells.select("cell", "bytes", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth"))
    above = above.withColumn("prefix", F.expr(f"shiftright(cell, {high} - depth)"))
    sums = above.groupBy("depth", "prefix").agg(F.sum("bytes").alias("shard_bytes")).filter(F.col("shard_bytes") <= limit)
    fit = above.join(sums, ["depth", "prefix"]).groupBy("cell").agg(
        F.min("depth").alias("depth"), F.min_by("prefix", "depth").alias("shard"), F.min_by("shard_bytes", "depth").alias("shard_bytes"))
    return cells.select("cell").join(fit, "cell", "left")


def assign(documents: DataFrame, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, shard (bits as text, and -page for overflow pages), depth, shard_bytes, oversized per row."""
    prepare(documents.sparkSession)
    key = F.concat_ws("\x1f", F.coalesce(F.col("doc_id").cast("string"), F.lit("\x00")), F.md5(F.coalesce(F.col("text"), F.lit("\x00")).cast("binary")))
    slim = stored(documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), hash_bits(key).alias("hash"),
                                   F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes")))
    total = slim.agg(F.sum("n_bytes")).first()[0] or 0
    low, high = 0, min(BITS, max(1, math.ceil(math.log2(max(1, 8 * total / limit)))))
    rows, done = slim, []
    while True:
        cells = stored(rows.groupBy(_prefix(high).alias("cell")).agg(F.sum("n_bytes").alias("bytes")))
        found = stored(_split(cells, low, high, limit))
        placed = rows.withColumn("cell", _prefix(high)).join(found, "cell")
        done.append(placed.filter("depth IS NOT NULL").select("doc_id", "n_bytes", "depth", "shard", "shard_bytes", F.lit(0).cast("bigint").alias("page")))
        if found.filter("depth IS NULL").isEmpty():
            break
        rows = stored(placed.filter("depth IS NULL").select("doc_id", "n_bytes", "hash"))
        if high == BITS:
            done.append(_pages(rows, limit))
            break
        low, high = high + 1, min(BITS, high + STEP)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    bits = F.when(F.col("depth") == 0, "").otherwise(F.expr("right(lpad(bin(shard), 64, '0'), depth)"))
    return out.select("doc_id", "n_bytes", F.concat(bits, F.when(F.col("page") > 0, F.concat(F.lit("-"), F.col("page").cast("string"))).otherwise("")).alias("shard"),
                      F.col("depth").cast("int").alias("depth"), "shard_bytes", (F.col("shard_bytes") > limit).alias("oversized"))


def _pages(rows: DataFrame, limit: int) -> DataFrame:
    """Rows that share all bits: those of one id and size are counted, then dealt to pages of the limit by number."""
    # counts per salt first, so that no row stands for more than a salt's share; a salt's rows begin where the last one's end
    salted = rows.groupBy("hash", "doc_id", "n_bytes", F.pmod(F.monotonically_increasing_id(), F.lit(1024)).alias("salt")).agg(F.count(F.lit(1)).alias("m"))
    same = Window.partitionBy("hash", "doc_id", "n_bytes")
    counted = stored(salted.withColumn("n", F.sum("m").over(same)).withColumn("first", F.sum("m").over(same.orderBy("salt")) - F.col("m")))
    fit = F.greatest(F.lit(1).cast("bigint"), F.floor(F.lit(limit) / F.greatest(F.col("n_bytes"), F.lit(1))))
    each = counted.withColumn("fit", fit).select("*", F.explode(F.expr("sequence(first, first + m - 1)")).alias("i"))
    page = F.floor(F.col("i") / F.col("fit"))
    size = F.least(F.col("fit"), F.col("n") - page * F.col("fit")) * F.col("n_bytes")
    return each.select("doc_id", "n_bytes", F.lit(BITS).alias("depth"), F.col("hash").alias("shard"), size.alias("shard_bytes"), (page.cast("bigint")).alias("page"))


def directory(shards: DataFrame) -> DataFrame:
    """One row per shard: shard, depth, rows, bytes."""
    return shards.groupBy("shard", "depth").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n_bytes").alias("n_bytes"))
