"""Line dedup: lines whose normalised form stands in many documents go, except in the document that keeps them.

Lines are exploded, normalised and hashed; the distinct documents of every hash are counted with map-side sums; lines
whose hash is in too many documents are dropped, and the rest is put together again by position. DataFrame functions
only. What travels is a hash of 128 bits, an id and a position for each line; a text is shuffled once, to meet the
positions that it loses.

A line that a third of all documents hold is no hot key: ids are counted per (hash, id) first, then summed per
partition. For dropping, hashes with more than ``SHARE`` of all (hash, id) rows, of which there are 1 / SHARE at most,
are broadcast; only lines of rarer hashes are shuffled to theirs.

Edge cases: a null or empty text is one empty line. A document is a doc_id: repeated rows of one id count once and lose
the same lines; null ids count as one document, which never keeps a line. A line repeated in one document counts
once and goes or stays as a whole. Ties don't arise, as the largest doc_id alone keeps a line. Long texts and lines
are taken whole. Texts without dropped lines come out as they are. Extra columns play no part; an empty table gives
no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, stored

MIN_CHARS, MIN_DOCUMENTS, SHARE = 40, 5, 1e-5
#: Fixed value: the white space that is stripped from lines.
STRIPPED = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(STRIPPED)), UPPER, LOWER)


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def _lines(documents: DataFrame, min_chars: int) -> DataFrame:
    """doc_id, th (hash of the text), pos and the key's hash (h1, h2) of every line that is long enough to be judged."""
    each = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("th"), F.posexplode(F.split(_text(), "\n", -1)).alias("pos", "line"))
    keyed = each.select("doc_id", "th", "pos", line_key(F.col("line")).alias("key")).filter(F.char_length("key") >= min_chars)
    return keyed.select("doc_id", "th", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def repeated_lines(documents: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """h1, h2, n_documents, keeper (largest doc_id) of the line keys in at least ``min_documents`` documents."""
    once = _lines(documents, min_chars).groupBy("h1", "h2", "doc_id").agg(F.lit(1).alias("one"))
    found = once.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_documents"), F.max("doc_id").alias("keeper"))
    return found.filter(F.col("n_documents") >= min_documents)


def dropped_lines(documents: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS, share: float = SHARE) -> DataFrame:
    """doc_id, th, pos of the lines to drop."""
    keys = stored(repeated_lines(documents, min_chars, min_documents))
    # these rows are among the (hash, id) rows, so that 1 / share keys at most hold more than the share
    total = keys.agg(F.sum("n_documents")).first()[0] or 0
    hot, cold = keys.filter(F.col("n_documents") > share * total), keys.filter(F.col("n_documents") <= share * total)
    lines = _lines(documents, min_chars)
    goes = (F.col("keeper") > F.col("doc_id")) | F.col("doc_id").isNull()
    found = lines.join(F.broadcast(hot.drop("n_documents")), ["h1", "h2"]).filter(goes).select("doc_id", "th", "pos")
    if cold.isEmpty():
        return found
    rest = lines.join(F.broadcast(hot.select("h1", "h2")), ["h1", "h2"], "left_anti")
    return found.unionByName(rest.join(cold.drop("n_documents"), ["h1", "h2"]).filter(goes).select("doc_id", "th", "pos"))


def deduplicated(documents: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS, share: float = SHARE) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_text per row."""
    prepare(documents.sparkSession)
    dropped = dropped_lines(documents, min_chars, min_documents, share)
    positions = dropped.groupBy("doc_id", "th").agg(F.collect_set("pos").alias("gone")).select(F.col("doc_id").alias("g_id"), F.col("th").alias("g_th"), "gone")
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("th"), _text().alias("text"))
    met = rows.join(positions, F.col("doc_id").eqNullSafe(F.col("g_id")) & (F.col("th") == F.col("g_th")), "left")
    n_lines = F.char_length("text") - F.char_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    # the lines are a column of their own before positions pick from them, or they would be split anew for every one
    split = met.select("doc_id", "text", "gone", n_lines.cast("bigint").alias("n_lines"), F.when(F.col("gone").isNotNull(), F.split("text", "\n", -1)).alias("lines"))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    kept = F.array_join(F.transform(left, lambda at: F.col("lines")[at]), "\n")
    return split.select("doc_id", "n_lines", F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_dropped"),
                        F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("kept_text"))


def digests(documents: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 per row."""
    return deduplicated(documents).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
