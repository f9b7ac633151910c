"""Exact deduplication by a tree merge of sorted digest runs.

Texts are normalised (every run of white space x20, x09-x0D becomes one space) and digested with SHA-256; length and
a 64-bit hash of other construction stand beside the digest, and only rows that agree in all three count as equal
(the verification). Every partition of the table is a leaf of the tree and forms a run: one row per digest, with the
smallest row and the count. In binomial rounds ``FAN`` neighbouring nodes exchange runs: the run of a node at level
r is the merge, sorted by digest, of the runs of the nodes below, and keeps the smallest id at every level. A digest
range of a node is one task's work, so the last level, too, is spread over all partitions; a text that a third of all
rows share is one row per leaf after the first level.

What the tree found goes down by the same paths: groups of more than one row are joined to the leaves' runs (one row
per leaf and digest), and those to the rows of the leaf. No join meets more rows of one key than a partition holds.

Edge cases: a null text counts as empty. A null id comes after all others; a group of null ids only has a null
keep_id and keeps its first row. Rows with one id and text are ties: one of them stays. An empty table gives no rows.
Extra columns are not read; ``kept_documents`` returns them as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, stored

FAN = 8
DIGEST = ["text_sha256", "size", "guard"]


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digests(documents: DataFrame) -> DataFrame:
    """doc_id, digest, length and guard of the normalised text, leaf (partition) and a row number."""
    text = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), normalised(F.col("text")).alias("text"))
    return text.select("doc_id", F.sha2("text", 256).alias("text_sha256"), F.octet_length("text").alias("size"),
                       F.xxhash64("text").alias("guard"), F.spark_partition_id().alias("leaf"), F.monotonically_increasing_id().alias("row"))


def groups(documents: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, row per row of the table."""
    prepare(documents.sparkSession)
    rows = stored(digests(documents))
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row").alias("first")
    leaves = rows.groupBy("leaf", *DIGEST).agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("n"))
    n_leaves = (rows.agg(F.max("leaf")).first()[0] or 0) + 1
    top, width = leaves.withColumnRenamed("leaf", "node"), 1
    while width < n_leaves:
        width *= FAN
        top = (top.withColumn("node", F.floor(F.col("node") / FAN).cast("int"))
               .groupBy("node", *DIGEST).agg(F.min("first").alias("first"), F.sum("n").alias("n")))
    several = top.filter("n > 1").select(*DIGEST, F.col("first").alias("keep"), F.col("n").alias("group_size"))
    down = leaves.select("leaf", *DIGEST).join(several, DIGEST)
    out = rows.join(down, ["leaf", *DIGEST], "left")
    return out.select("doc_id", F.when(F.col("keep").isNull(), F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
                      F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
                      F.coalesce(F.col("row") == F.col("keep.row"), F.lit(True)).alias("kept"), "text_sha256", "row")


def kept_documents(documents: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """One row of every group of equal texts, with its own columns.

    Rows are found again by id and digest. Where several kept-group rows have the same id and digest they are
    repeated rows: they alone are reduced to one.
    """
    found = groups(documents) if found is None else found
    keep = (found.groupBy("doc_id", "text_sha256").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
            .filter("kept").select(F.col("doc_id").alias("k_id"), F.col("text_sha256").alias("k_sha"), F.col("n").alias("k_n")))
    names = documents.columns
    packed = documents.select(F.struct(*[documents[c] for c in names]).alias("r"))
    joined = packed.join(keep, F.sha2(normalised(F.col("r.text")), 256).eqNullSafe(F.col("k_sha")) & F.col("r.doc_id").cast("bigint").eqNullSafe(F.col("k_id")))
    single = joined.filter("k_n = 1").select("r")
    repeated = joined.filter("k_n > 1").groupBy("k_id", "k_sha").agg(F.first("r").alias("r")).select("r")
    return single.unionByName(repeated).select(*[F.col("r").getField(c).alias(c) for c in names])
