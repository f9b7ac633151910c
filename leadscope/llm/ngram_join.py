"""N-gram Jaccard self-join with prefix filters under several global orders.

A document's set holds the hashes of its 5-word shingles. If two sets have a Jaccard similarity of at least 0.8, then
under every total order of the shingles their prefixes (the first n - ceil(0.8 n) + 1 of each) share a shingle. A
candidate pair must share one under all of ``ORDERS`` orders; only then are the sets compared.

 1. Blocks of documents build the sets and the prefixes under a hash order. The prefix shingles, packed, are exchanged
    (``common.exchange``). These prefixes are longer: linked sets share a tenth of their members in them,
    so a document with fewer shingles that stand in other prefixes has no link; a common line doesn't make a candidate.
 2. The others are reduced to distinct sets (copies are one node), and these are stored. Shingles that many sets
    hold (a common line) are moved to the end of every order. Only their order depends on them, so a bounded list
    (``HEAVY``, the most frequent ones) does.
 3. Inverted lists under the first order give pairs. First each node is paired with the smallest member of its lists,
    which connects most of a group of near copies. Lists whose members are connected by now are done. Of the others,
    a short one gives the pairs of members that aren't connected, a long one those of a pivot with every member that
    isn't connected to it, and goes on without the pivot; after ``ROUNDS`` such rounds the members of what is left are
    compared in squares. Shingles that no other set holds bound what a set can have in common: pairs beyond the bound
    aren't tested. Lists with the same members are one list. Pairs are tested
    against the other orders' prefixes and the sets' sketches, and what is left is verified on the whole sets.
 4. Links are contracted to components by alternating star steps.

A group of near copies is a few pivots' pairs. Only sets that share most members with many others, but are near to none,
are compared with each other in squares; rows are made for pairs that pass alone.

Edge cases: a null text, or one without words, has an empty set and links to nothing; fewer than five words are one
shingle. Copies and repeated rows are one node and get the smallest id among them. A null id is larger than any id:
component_id is null only if no linked document has an id. Long texts are taken whole. An empty table gives no rows.
Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.joins import join_groups
from .common import blocks, bucket_count, doc_key, exchange, forget, grouped_words, having, joined_answers, mix, pack_keys, prepare_texts, range_hash, stored

GRAM = 5
SHARE = 80  # percent of the union
ORDERS = 3
HEAVY = 1_000_000
FREQUENT = 6  # sets that hold a heavy shingle, at least
SHORT = 16  # members of a list whose pairs are all tested
ROUNDS = 1  # of pivots, before what is left of the lists is compared in squares of SIDE sets
SIDE = 128
_SEEDS = [np.uint64(0), np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)]


# ------------------------------------------------------------------ sets and prefixes

def shingle_sets(texts: list[bytes], gram: int = GRAM) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text (A-Z lower-cased)."""
    for first, last, hashes, bounds in grouped_words([t.lower() for t in texts]):
        n = max(0, len(hashes) - gram + 1)
        every = range_hash(hashes, np.arange(n), np.arange(n) + gram)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a >= gram:
                yield np.unique(every[a : b - gram + 1])
            else:
                yield range_hash(hashes[a:b], np.array([0]), np.array([b - a])) if b > a else np.zeros(0, dtype=np.uint64)


def shared_size(n: int) -> int:
    """How many members two linked sets, the smaller one of n members, are asked to share in longer prefixes."""
    return max(1, n // 10)


def prefix_size(n: int, shared: int = 1) -> int:
    """So many members of a set of n, first in any order, hold the first ``shared`` members in common with a linked set."""
    return n - _least_common(n) + shared if n else 0


def _least_common(n: int) -> int:
    """Members that a set of n has in common with any linked set, and the least size of such a set."""
    return (SHARE * n + 99) // 100


def prefix(shingles: np.ndarray, order: int, heavy: np.ndarray | None = None, shared: int = 1) -> np.ndarray:
    """The set's first members under a global order: heavy shingles last, the others by a hash."""
    key = mix(shingles ^ _SEEDS[order]) >> np.uint64(1) if order else shingles >> np.uint64(1)
    if heavy is not None and len(heavy):
        at = np.minimum(np.searchsorted(heavy, shingles), len(heavy) - 1)
        key |= (heavy[at] == shingles).astype(np.uint64) << np.uint64(63)
    # ties of the shortened key are broken by the shingle itself, the same way in every set
    return shingles[np.lexsort((shingles, key))[: prefix_size(len(shingles), shared)]]


def linked(common: int, n: int, m: int) -> bool:
    return 100 * common >= SHARE * (n + m - common)


# ------------------------------------------------------------------ the operator

_BLOCK = "block long, ids array<long>, th array<long>, sizes array<int>, high array<long>, low array<long>, docs binary, parts array<binary>"
_MEMBER = "doc_id long, th long, n_shingles long, high long, low long, candidate boolean"


def _members(documents: DataFrame) -> DataFrame:
    """Per row: id, size and 128-bit digest of its set, and whether a prefix shingle stands in another row."""
    n_buckets = bucket_count(documents, 1 / 30)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, (ids, th, texts) in blocks(batches, ["doc_id", "th", "text"]):
            sizes, high, low, prefixes = [], [], [], []
            for shingles in shingle_sets(texts):
                sizes.append(len(shingles))
                digest = xxhash.xxh3_128_digest(shingles.tobytes())
                high.append(int.from_bytes(digest[:8], "little", signed=True))
                low.append(int.from_bytes(digest[8:], "little", signed=True))
                prefixes.append(prefix(shingles, 0, shared=shared_size(len(shingles))))
            order, parts = pack_keys(mix(np.concatenate(prefixes)), n_buckets)
            docs = np.repeat(np.arange(len(ids), dtype=np.uint16), [len(p) for p in prefixes])[order]
            row = [block, ids, th, sizes, high, low, docs.tobytes(), parts]
            types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.binary())]
            yield pa.record_batch([pa.array([x], t) for x, t in zip(row, types)], names=[c.split()[0] for c in _BLOCK.split(", ")])

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                docs = np.frombuffer(r["docs"], dtype=np.uint16)
                again = np.bincount(docs[joined_answers(r["answers"]) > 0], minlength=len(r["sizes"]))
                wanted = np.array([shared_size(_least_common(n)) for n in r["sizes"]])
                candidate = again >= wanted
                yield pa.record_batch([pa.array(r["ids"], pa.int64()), pa.array(r["th"], pa.int64()), pa.array(r["sizes"], pa.int64()),
                                       pa.array(r["high"], pa.int64()), pa.array(r["low"], pa.int64()), pa.array(candidate)], names=[c.split()[0] for c in _MEMBER.split(", ")])

    rows = stored(documents.select(*doc_key(), F.coalesce("text", F.lit("")).cast("binary").alias("text")).mapInArrow(cut, _BLOCK))
    out = stored(rows.drop("parts").join(exchange(rows), "block", "left").mapInArrow(decide, _MEMBER))
    forget(rows)
    return out


def _nodes(documents: DataFrame, members: DataFrame) -> DataFrame:
    """Distinct sets of candidates: node (number), high, low, n, shingles (binary)."""
    one = members.filter("candidate").groupBy("high", "low").agg(F.min(F.struct("doc_id", "th")).alias("one"))
    wanted = stored(one.select(F.col("one.doc_id").alias("n_id"), F.col("one.th").alias("n_th")).distinct())
    texts = documents.select(*doc_key(), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    texts = having(texts, wanted.select(F.col("n_th").alias("th")), "th")
    fetched = texts.join(wanted, (F.col("th") == F.col("n_th")) & F.col("doc_id").eqNullSafe(F.col("n_id"))).select("text")
    schema = "high long, low long, n int, shingles binary"

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.tobytes() for s in shingle_sets(batch.column("text").to_pylist())]
            digests = [xxhash.xxh3_128_digest(s) for s in sets]
            for at in range(0, len(sets), 500):
                part = slice(at, at + 500)
                yield pa.record_batch([pa.array([int.from_bytes(d[:8], "little", signed=True) for d in digests[part]], pa.int64()),
                                       pa.array([int.from_bytes(d[8:], "little", signed=True) for d in digests[part]], pa.int64()),
                                       pa.array([len(s) // 8 for s in sets[part]], pa.int32()), pa.array(sets[part], pa.binary())], names=[c.split()[0] for c in schema.split(", ")])

    out = stored(fetched.mapInArrow(build, schema).withColumn("node", F.monotonically_increasing_id()))
    forget(wanted)
    return out


def _tokens(nodes: DataFrame, heavy: np.ndarray) -> DataFrame:
    """node, n, token: prefixes under the first order."""
    shared = nodes.sparkSession.sparkContext.broadcast(heavy)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, n, s in zip(*(batch.column(c).to_pylist() for c in ("node", "n", "shingles"))):
                tokens = prefix(np.frombuffer(s, dtype=np.uint64), 0, shared.value)
                yield pa.record_batch([pa.array(np.full(len(tokens), node)), pa.array(np.full(len(tokens), n, dtype=np.int32)), pa.array(tokens.view(np.int64))], names=["node", "n", "token"])

    return nodes.select("node", "n", "shingles").mapInArrow(cut, "node long, n int, token long")


def _frequencies(nodes: DataFrame) -> DataFrame:
    """token, sets, node: in how many sets a shingle stands, and one of them."""
    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, s in zip(batch.column("node").to_pylist(), batch.column("shingles").to_pylist()):
                tokens = np.frombuffer(s, dtype=np.int64)
                yield pa.record_batch([pa.array(np.full(len(tokens), node)), pa.array(tokens)], names=["node", "token"])

    rows = nodes.select("node", "shingles").mapInArrow(members, "node long, token long")
    return rows.groupBy("token").agg(F.count(F.lit(1)).alias("sets"), F.min("node").alias("node"))


def _heavy(nodes: DataFrame, most: int, least: int) -> np.ndarray:
    """The shingles that most sets hold, ascending: at most ``most`` numbers."""
    top = _frequencies(nodes).filter(F.col("sets") >= least).orderBy(F.desc("sets"), "token").limit(most).select("token").toPandas()
    return np.sort(top["token"].to_numpy().astype(np.int64).view(np.uint64))


def _single(nodes: DataFrame) -> DataFrame:
    """node, single: how many of a set's shingles stand in no other set."""
    return _frequencies(nodes).filter("sets = 1").groupBy("node").agg(F.count(F.lit(1)).cast("int").alias("single"))


def _lists(rows: DataFrame) -> DataFrame:
    """Inverted lists under the first order: token, node, n, size; of lists with equal members, one."""
    signature = [F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"x{k}") for k in (1, 2)]
    lists = rows.groupBy("token").agg(F.count(F.lit(1)).alias("size"), *signature).filter("size > 1")
    one = lists.groupBy("size", "x1", "x2").agg(F.min("token").alias("token"))
    return stored(rows.join(one.select("token", "size"), "token"))


def _may_link(n, held, m, other):
    """Whether sets of n and m members, of which so many stand in several sets, can have enough in common."""
    common = F.least(held, other)
    return 100 * common >= SHARE * (n + m - common)


def _both_sides(pairs: DataFrame, rows: DataFrame, column: str) -> DataFrame:
    for side in ("a", "b"):
        pairs = pairs.join(rows.select(F.col("node").alias(side), F.col(column).alias(f"{side}_{column}")), side)
    return pairs


def _of_pairs(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    return having(nodes, pairs.select(F.explode(F.array("a", "b")).alias("node")), "node")


def _sketched(nodes: DataFrame, heavy: np.ndarray | None, orders: int) -> DataFrame:
    """node, sketch: 32 bits of each member of the prefixes under the other orders, and of the set."""
    shared = nodes.sparkSession.sparkContext.broadcast(heavy)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sketches = []
            for s in batch.column("shingles").to_pylist():
                shingles = np.frombuffer(s, dtype=np.uint64)
                parts = [np.unique(x.astype(np.uint32)) for x in [*(prefix(shingles, k, shared.value) for k in range(1, orders)), shingles]]
                sketches.append(np.concatenate([np.array([len(shingles), *map(len, parts)], dtype=np.uint32), *parts]).tobytes())
            yield pa.record_batch([batch.column("node"), pa.array(sketches, pa.binary())], names=["node", "sketch"])

    return nodes.select("node", "shingles").mapInArrow(cut, "node long, sketch binary")


def _parts(sketch: bytes, orders: int) -> tuple[int, list[np.ndarray]]:
    x = np.frombuffer(sketch, dtype=np.uint32)
    return int(x[0]), np.split(x[orders + 1 :], np.cumsum(x[1:orders]))


def _may_be_linked(x: tuple[int, list[np.ndarray]], y: tuple[int, list[np.ndarray]]) -> bool:
    (n, xs), (m, ys) = x, y
    # members of one set that share 32 bits count as common, to be safe
    common = min(n, m, len(np.intersect1d(xs[-1], ys[-1], assume_unique=True)) + n - len(xs[-1]) + m - len(ys[-1]))
    return linked(common, n, m) and all(len(np.intersect1d(p, q, assume_unique=True)) for p, q in zip(xs[:-1], ys[:-1]))


def _filtered(pairs: DataFrame, nodes: DataFrame, heavy: np.ndarray | None, orders: int) -> DataFrame:
    """a, b: the pairs (made under the first order) that share a prefix shingle under every other order and may be
    linked by their sketches.

    Sketches keep 32 bits of a shingle: what differs there differs, so both tests rule out only pairs that aren't linked.
    """
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            passes = [_may_be_linked(_parts(x, orders), _parts(y, orders)) for x, y in zip(batch.column("a_sketch").to_pylist(), batch.column("b_sketch").to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(passes, pa.bool_()))

    sketches = _sketched(_of_pairs(nodes, pairs), heavy, orders)
    return stored(_both_sides(pairs, sketches, "sketch").mapInArrow(compare, "a long, b long"))


def _verified(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """a, b: the pairs that are linked, by their whole sets."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [[np.frombuffer(s, dtype=np.uint64) for s in batch.column(c).to_pylist()] for c in ("a_shingles", "b_shingles")]
            yield batch.select(["a", "b"]).filter(pa.array([linked(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)) for x, y in zip(*sets)], pa.bool_()))

    return stored(_both_sides(pairs, _of_pairs(nodes, pairs), "shingles").mapInArrow(compare, "a long, b long"))


def _open_lists(rows: DataFrame, connected: DataFrame) -> DataFrame:
    """token, node, n, held, part, size of the lists that are more than one component by now.

    connected: node, component; part: a member's component. Parts may be finer than components; that costs only tests.
    """
    rows = rows.select("token", "node", "n", "held").join(connected, "node", "left").withColumn("part", F.coalesce("component", "node")).drop("component")
    several = rows.groupBy("token").agg(F.count(F.lit(1)).alias("size"), F.min("part").alias("p"), F.max("part").alias("q")).filter("p <> q").select("token", "size")
    return stored(rows.join(several, "token"))


def _links(nodes: DataFrame, heavy: np.ndarray, short: int, orders: int) -> DataFrame:
    """a, b: enough links to connect all linked sets."""
    def tested(pairs: DataFrame) -> DataFrame:
        made = stored(pairs.distinct())
        left = _filtered(made, nodes, heavy, orders)
        forget(made)
        out = _verified(left, nodes)
        forget(left)
        return out

    inverted = _lists(_tokens(nodes, heavy))
    lists = inverted.join(_single(nodes), "node", "left").withColumn("held", F.col("n") - F.coalesce("single", F.lit(0)))
    lists = stored(lists.filter(100 * F.col("held") >= SHARE * F.col("n")).select("token", "node", "n", "held"))
    forget(inverted)
    # a list's pivot is the member with the fewest shingles of its own: what it has in common with others is most
    pivot = F.min(F.struct((-1000 * F.col("held") / F.col("n")).cast("int").alias("rank"), *[F.col(c) for c in ("node", "n", "held")])).alias("pivot")
    # first one pair for every node: with the best pivot of its lists; this connects most of a group of near copies
    own = lists.join(lists.groupBy("token").agg(pivot), "token").groupBy("node").agg(F.min("pivot").alias("pivot"))
    own = stored(own.select("node", F.col("pivot.node").alias("to")).filter("node <> to"))
    links = tested(own.select(F.least("node", "to").alias("a"), F.greatest("node", "to").alias("b")))
    # every node has one pair so far, so following it twice is enough to see most of what is connected
    up = own.join(links, (F.col("a") == F.least("node", "to")) & (F.col("b") == F.greatest("node", "to")), "left_semi")
    up = up.join(up.select(F.col("node").alias("to"), F.col("to").alias("top")), "to", "left").select("node", F.coalesce("top", "to").alias("component"))
    before, lists = lists, _open_lists(lists, up)
    forget(before, own)
    for _ in range(ROUNDS):
        if lists.isEmpty():
            return links
        small, large = lists.filter(F.col("size") <= short), lists.filter(F.col("size") > short)
        x, y = (small.select("token", *[F.col(c).alias(f"{side}_{c}") for c in ("node", "n", "held", "part")]) for side in ("a", "b"))
        pairs = x.join(y, "token").filter("a_node < b_node AND a_part <> b_part").filter(_may_link(*(F.col(c) for c in ("a_n", "a_held", "b_n", "b_held"))))
        pairs = pairs.select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))
        # the pivot is compared with every member that isn't connected to it
        parts = large.groupBy("token").agg(pivot).join(large.select("token", F.col("node").alias("p"), F.col("part").alias("p_part")), "token").filter("p = pivot.node")
        rays = stored(large.join(parts.drop("p"), "token").filter("node <> pivot.node"))
        outer = rays.filter("part <> p_part").filter(_may_link(F.col("n"), F.col("held"), F.col("pivot.n"), F.col("pivot.held")))
        pairs = pairs.unionByName(outer.select(F.least("node", "pivot.node").alias("a"), F.greatest("node", "pivot.node").alias("b")))
        links = links.unionByName(tested(pairs))
        # lists of one pivot go on as one
        before, lists = lists, _open_lists(rays.select(F.col("pivot.node").alias("token"), "node", "n", "held").distinct(), components(links))
        forget(before, rays)
    return links if lists.isEmpty() else links.unionByName(_verified(_in_squares(lists, nodes, heavy, orders).distinct(), nodes))


def _in_squares(lists: DataFrame, nodes: DataFrame, heavy: np.ndarray, orders: int) -> DataFrame:
    """a, b: the pairs of a list that may be linked and aren't connected; what is left when pivots don't connect more.

    A list is dealt into parts of about SIDE sets, and every two parts meet in a task of their own, so that no task
    holds more than two parts and no row is made for a pair that the sketches rule out.
    """
    sketches = _sketched(having(nodes, lists, "node"), heavy, orders)
    parts = F.ceil(F.col("size") / SIDE).cast("int")
    rows = lists.join(sketches, "node").withColumn("i", F.pmod(F.xxhash64("node"), parts).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), parts - 1)))
    rows = rows.select("token", F.least("i", "j").alias("x"), F.greatest("i", "j").alias("y"), "i", "node", "n", "held", "part", "sketch")

    def compare(found: pd.DataFrame) -> pd.DataFrame:
        x, y = int(found["x"].iloc[0]), int(found["y"].iloc[0])
        sketch = [_parts(s, orders) for s in found["sketch"]]
        node, n, held, part, i = (found[c].to_numpy() for c in ("node", "n", "held", "part", "i"))
        out = []
        for k in np.flatnonzero(i == x):
            common = np.minimum(held[k], held)
            other = (i == y) & (part != part[k]) & (100 * common >= SHARE * (n[k] + n - common)) & ((node > node[k]) if x == y else True)
            out += [(min(node[k], node[m]), max(node[k], node[m])) for m in np.flatnonzero(other) if _may_be_linked(sketch[k], sketch[m])]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return rows.groupBy("token", "x", "y").applyInPandas(compare, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """node, component (smallest node) for every node of the links a, b; alternating star steps."""
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: larger neighbours go to the smallest neighbour
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        # small star: so do the smaller neighbours and the node itself
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        before, edges = edges, stored(joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        forget(before)
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state:
            return edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
        state = now


def joined(documents: DataFrame, heavy: int = HEAVY, frequent: int = FREQUENT, short: int = SHORT, orders: int = ORDERS) -> DataFrame:
    """doc_id, n_shingles, component_id, th per row."""
    prepare_texts(documents.sparkSession)
    members = _members(documents)
    nodes = _nodes(documents, members)
    part = components(_links(nodes, _heavy(nodes, heavy, frequent), short, orders))
    # per distinct set: its rows and smallest id; of linked sets the component, and the smallest id of this
    sets = members.filter("n_shingles > 0").groupBy("high", "low").agg(F.count(F.lit(1)).alias("rows"), F.min("doc_id").alias("own"))
    stars = part.unionByName(part.select(F.col("component").alias("node"), "component")).distinct()  # with their centres
    of_set = nodes.join(stars, "node").groupBy("high", "low").agg(F.min("component").alias("component"))
    met = stored(sets.join(of_set, ["high", "low"]))
    least = met.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.min("own").alias("least"))
    met = join_groups(met, least, ["component"], "n").select("high", "low", F.lit(True).alias("met"), F.coalesce("least", "own").alias("least"))
    named = sets.join(met, ["high", "low"], "left").withColumn("component_id", F.when(F.col("met"), F.col("least")).otherwise(F.col("own")))
    # rows of one set may be a third of all: the names of sets with several rows or links are joined, all others keep their own id
    named = named.filter(~F.col("component_id").eqNullSafe(F.col("own")) | (F.col("rows") > 1)).select("high", "low", F.lit(True).alias("named"), "component_id")
    out = members.join(named, ["high", "low"], "left")
    set_id = F.when(F.col("n_shingles") == 0, F.col("doc_id")).when(F.col("named"), F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", set_id.alias("component_id"), "th")


def one_per_group(documents: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """The documents without near duplicates: of each component the row with the smallest id, with its own columns.

    Rows are found again by id and text. Rows with a null id stay if nothing with an id is linked to them; repeated
    rows stay or go together (exact deduplication is another stage).
    """
    found = joined(documents) if found is None else found
    keep = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("k_id"), F.col("th").alias("k_th")).distinct()
    names = documents.columns
    packed = documents.select(F.struct(*[documents[c] for c in names]).alias("r"))
    kept = packed.join(keep, (F.xxhash64("r.text") == F.col("k_th")) & F.col("r.doc_id").cast("bigint").eqNullSafe(F.col("k_id")), "left_semi")
    return kept.select(*[F.col("r").getField(c).alias(c) for c in names])
