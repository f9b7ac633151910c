"""DOC-1: duplicate leads.

Two leads are duplicates when they have
  - the same e-mail (valid by VAL-2's syntax; trimmed, lower case),
  - the same phone (valid by VAL-4's rule; its last ten digits), or
  - names and companies that are alike: Jaccard similarity of the character trigrams of "first last company" of 0.85
    or more (all three filled; lower case, white space as one space).
Clusters are what these links connect.

E-mail and phone are exact blocks: every lead is linked to the smallest id of its block, so a block of any size gives one
link per lead. Alike texts are found by MinHash: equal texts become one node, a node's trigrams give BANDS keys of ROWS
minima, and nodes that share a key are candidates (a pair at 0.85 is missed once in 10**8), each verified by its
trigrams. A key with more than ``most`` nodes is split on every other such key of its nodes (a pair that is alike shares
another key, too); what is still larger is compared in parts, one part of a block per task, so nothing is dropped.

Null and blank fields take part in no rule; a null id takes part in nothing. Repeated rows of an id are one lead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.components import components
from ..functions.joins import join_groups
from ..functions.text import digits, filled, strip
from ..sources.sinks import checkpointed
from .rules import EMAIL_SYNTAX, NANP, PHONE_CHARS

#: Fixed value: the configured threshold.
THRESHOLD = 0.85
BANDS, ROWS, MOST = 20, 3, 200


def email_key(c: Column) -> Column:
    x = strip(c)
    return F.when(x.rlike(EMAIL_SYNTAX), F.lower(x))


def phone_key(c: Column) -> Column:
    d = digits(c)
    return F.when(strip(c).rlike(PHONE_CHARS) & d.rlike(NANP), F.substring(d, -10, 10))


def text_key(first: Column, last: Column, company: Column) -> Column:
    whole = F.lower(F.concat_ws(" ", *[strip(c) for c in (first, last, company)]))
    return F.when(filled(first) & filled(last) & filled(company), F.regexp_replace(whole, r"\s+", " "))


def trigrams(text: Column) -> Column:
    padded = F.concat(F.lit("  "), text, F.lit(" "))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.char_length(padded) - 2), lambda i: F.substring(padded, i, 3)))


def similarity(a: Column, b: Column) -> Column:
    common = F.size(F.array_intersect(a, b))
    return common / (F.size(a) + F.size(b) - common)


def _profiles(leads: DataFrame) -> DataFrame:
    """One row per id: lead, email, phone, text; of repeated rows the smallest values."""
    keys = leads.filter(F.col("Id").isNotNull()).select(F.col("Id").alias("lead"), email_key(F.col("Email")).alias("email"),
                                                        phone_key(F.col("Phone")).alias("phone"), text_key(F.col("FirstName"), F.col("LastName"), F.col("Company")).alias("text"))
    return keys.groupBy("lead").agg(*[F.min(c).alias(c) for c in ("email", "phone", "text")])


def same_key_links(profiles: DataFrame, key: str) -> DataFrame:
    """a, b: every lead with the smallest lead of the same key."""
    rows = profiles.filter(F.col(key).isNotNull()).select("lead", key)
    blocks = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min("lead").alias("first")).filter("n > 1")
    return join_groups(rows, blocks, [key], "n").filter("lead <> first").select(F.col("first").alias("a"), F.col("lead").alias("b"))


def _band_keys(grams: Column) -> Column:
    """BANDS keys, each a hash of the band's number and its ROWS minima."""
    def least(k: int) -> Column:
        return F.array_min(F.transform(grams, lambda g: F.xxhash64(g, F.lit(k))))
    return F.array(*[F.xxhash64(F.lit(-1 - band), *[least(band * ROWS + row) for row in range(ROWS)]) for band in range(BANDS)])


def candidates(nodes: DataFrame, most: int = MOST) -> DataFrame:
    """a, b: pairs of nodes that share a band key, a < b. nodes: node, keys (array)."""
    rows = nodes.select("node", F.explode("keys").alias("block"))
    sizes = rows.groupBy("block").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    held = checkpointed(join_groups(rows, sizes, ["block"], "n"))
    small, large = held.filter(F.col("n") <= most), held.filter(F.col("n") > most)
    pairs = _pairs(small.select("block", "node", F.lit(1).alias("parts")))
    if large.isEmpty():
        return pairs.distinct()
    # a large block is split on every other large one that its nodes are in; what shares a small one is found already
    split = large.select("node", F.col("block").alias("x")).join(large.select("node", F.col("block").alias("y")), "node").filter("x < y")
    split = split.select("node", F.xxhash64("x", "y").alias("block"))
    sizes = split.groupBy("block").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    split = join_groups(split, sizes, ["block"], "n")
    return pairs.unionByName(_pairs(split.select("block", "node", F.ceil(F.col("n") / most).cast("int").alias("parts")))).distinct()


def _pairs(blocks: DataFrame) -> DataFrame:
    """Pairs in a block; of a large one, each part of its nodes meets all nodes in a task of its own."""
    part = F.pmod(F.xxhash64("node", F.lit(7)), F.col("parts")).cast("int")
    left = blocks.select("block", F.col("node").alias("a"), part.alias("part"))
    right = blocks.select("block", F.col("node").alias("b"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    return left.join(right, ["block", "part"]).filter("a < b").select("a", "b")


def alike_links(profiles: DataFrame, threshold: float = THRESHOLD, most: int = MOST) -> DataFrame:
    """a, b, similarity: links between the smallest leads of alike texts, and of every lead with its text's first."""
    texts = profiles.filter(F.col("text").isNotNull()).groupBy("text").agg(F.min("lead").alias("node"))
    grams = texts.select("node", trigrams(F.col("text")).alias("grams"))
    nodes = checkpointed(grams.select("node", "grams", _band_keys(F.col("grams")).alias("keys")))
    pairs = candidates(nodes.select("node", "keys"), most)
    for side in ("a", "b"):
        pairs = pairs.join(nodes.select(F.col("node").alias(side), F.col("grams").alias(f"{side}_grams")), side)
    found = pairs.withColumn("similarity", similarity(F.col("a_grams"), F.col("b_grams"))).filter(F.col("similarity") >= threshold)
    equal = same_key_links(profiles, "text").withColumn("similarity", F.lit(1.0))
    return found.select("a", "b", "similarity").unionByName(equal)


def duplicate_links(leads: DataFrame, threshold: float = THRESHOLD, most: int = MOST) -> DataFrame:
    """a, b, rule, similarity: links that connect all duplicates (in a block by its smallest lead)."""
    profiles = checkpointed(_profiles(leads))
    exact = [same_key_links(profiles, k).select("a", "b", F.lit(k).alias("rule"), F.lit(1.0).alias("similarity")) for k in ("email", "phone")]
    alike = alike_links(profiles, threshold, most).select("a", "b", F.lit("text").alias("rule"), "similarity")
    return exact[0].unionByName(exact[1]).unionByName(alike)


def duplicate_clusters(leads: DataFrame, threshold: float = THRESHOLD, most: int = MOST) -> DataFrame:
    """lead_id, cluster_id (the smallest lead of the cluster), cluster_size, is_duplicate (not the first of its cluster), per lead."""
    links = duplicate_links(leads, threshold, most)
    named = components(links)
    ids = leads.filter(F.col("Id").isNotNull()).select(F.col("Id").alias("lead_id")).distinct()
    rows = checkpointed(ids.join(named.withColumnRenamed("node", "lead_id"), "lead_id", "left").select("lead_id", F.coalesce("component", "lead_id").alias("cluster_id")))
    sizes = rows.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("cluster_size"))
    out = join_groups(rows, sizes, ["cluster_id"], "cluster_size")
    return out.select("lead_id", "cluster_id", "cluster_size", (F.col("lead_id") != F.col("cluster_id")).alias("is_duplicate"))
