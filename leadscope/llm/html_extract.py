"""Main text of web pages with a suffix array per host.

A page is cut into blocks: the text between block-level tags, with the path of elements around it. The words of the
blocks that markup doesn't rule out are a page's token stream, with a token for each block's end. Pages of a host whose
streams are equal (exact copies) count as one. A suffix array over the streams puts equal substrings side by side; a
substring of ``RUN`` tokens is boilerplate if it stands on ``SHARE`` percent of the host's distinct streams, ``PAGES``
at least. Then:
  - blocks in elements that aren't the article by markup (menus, headers and footers of the page, sidebars, forms,
    adverts, notices, reader comments ...) go;
  - other blocks, in the page's main container or not, go if boilerplate covers ``COVERED`` of their words (all of
    them in a block shorter than a run) and stay otherwise;
  - a page that boilerplate would empty keeps its container's blocks, or all that markup leaves where it has none.

A host's pages are taken in groups: hosts with more than ``GROUP`` pages are dealt into as many groups as needed by a
hash of the stream, so that a host with a third of all pages is many tasks of bounded size; streams with more than
``GROUP`` copies are dealt by a hash of the page's id, and one page counts for them. What is boilerplate doesn't
depend on the groups: a substring on a share of a host's streams has that share in one of its groups, so the groups
name candidates, each group counts all of them, and the counts are summed up by host. Substrings pass between the
tasks as 64-bit hashes. Page numbers are counted per host first; the tables of hosts that need groups and of streams
with many copies are broadcast only up to ``HOSTS`` rows and joined otherwise. Only compressed block texts are shuffled,
once: the steps over the groups share that shuffle.

Edge cases: a null or empty page, or one without text, gives an empty text and 0 code points. A page without host
belongs to the host of the empty name; a null id is kept. Repeated rows of one page are one page for counting, and
each gets its result. Very long pages are taken whole, as a group may hold a single page. An empty table gives no
rows. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, range_hash, word_hashes

RUN, PAGES, SHARE, COVERED, GROUP, HOSTS = 8, 3, 30, 0.5, 512, 200_000
#: The token of a block's end.
EDGE = np.uint64(0x5851F42D4C957F2D)
#: HTML's element names by their part in a page; all others, unknown ones too, are inline.
RAW = frozenset("script style textarea title iframe".split())
SKIPPED = RAW | frozenset("noscript template svg math object canvas select option button datalist audio video map".split())
NESTED = frozenset("template svg math object map".split())
OUTSIDE = frozenset("nav footer aside form menu dialog".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer
form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li link listing main menu meta nav ol optgroup p plaintext pre search section
summary table tbody td tfoot th thead tr ul""".split())
CONTAINER = frozenset("article main".split())
#: Elements whose start ends those named, as their end tags may be left out.
ENDS = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
#: Words that name a part of a page that isn't its article, as a class, an id or a role.
MARKS = frozenset("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus
footer form masthead menu nav navbar navigation newsletter notice notices notification pagination popup promo related respond
copyright disclaimer legal share sharing sidebar sitenav social sponsor sponsored subscribe subscription toolbar widget""".split())
ROLES = MARKS | frozenset("complementary contentinfo search alert".split())
#: Words that say where or how such a part stands; a name of other words besides (`social-science`) marks nothing.
PLACES = frozenset("""area bar block body bottom box button buttons card center column container content footer fixed global group header holder icons inline inner
item items left line link links list main message mobile overlay page panel post posts primary right row secondary section site slot small
text thread top unit wrap wrapper""".split())
#: With them `header` is the page's, alone or with other words the article's.
HEADERS = frozenset("site page top global main masthead".split())
# a quote opens a value only behind an equals sign, and only where another one closes it
_TAG = re.compile(r"""<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*"[^"]*"|=\s*'[^']*'|=)*+)(?:>|$)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|(\S*)))?""")
_SPLIT = re.compile(r"[^a-z0-9]+")


def _named(value: str, marks: frozenset) -> bool:
    """Whether one of the names (by white space) consists of marks, of words for places and of numbers, a mark at least."""
    for token in value.split():
        words = set(_SPLIT.split(token)) - {""}
        if words == {"header"} or "header" in words and not HEADERS.isdisjoint(words):
            return True
        if not marks.isdisjoint(words) and all(w in marks or w in PLACES or w.isdigit() for w in words):
            return True
    return False


def _marked(name: str, attributes: str) -> tuple[bool, bool]:
    """Whether the element is marked as something else than the article; whether it is the article's body."""
    outside = container = False
    for key, a, b, c in _ATTRIBUTE.findall(attributes):
        key = key.lower()
        if key == "hidden":
            outside = True
        elif key in ("class", "id", "role"):
            value = (a or b or c).lower()
            if key == "role" and value in ("main", "article"):
                container = True
            else:
                outside |= _named(value, ROLES if key == "role" else MARKS)
        elif key == "itemprop":
            container |= (a or b or c).lower() == "articlebody"
    return outside and name not in ("html", "body"), container


@lru_cache(maxsize=None)
def _end(name: str) -> re.Pattern:
    """What ends a skipped element: its end tag or, unless it holds plain text, what shows that it has none."""
    stops = "" if name in RAW else "|<(?:article|main|body)\\b" + ("" if name in NESTED else rf"|<{name}\b")
    return re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|$){stops}", re.I)


def page_blocks(page: str | None) -> list[tuple[int, str]]:
    """(zone, text) per block in page order; zone: 0 outside by markup, 1 neither, 2 in a main container.

    Time grows with the page alone, whatever its markup: what ends a skipped element is searched once per place, and
    end tags without an element are told by the number of open ones.
    """
    out: list[tuple[int, str]] = []
    if not page:
        return out
    stack: list[tuple[str, int]] = []  # element, zone of what it holds
    opened: Counter[str] = Counter()
    ends: dict[str, re.Match | None] = {}
    zone, held, at = 1, [], 0

    def end_block() -> None:
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text:
            out.append((zone, text))

    def push(name: str, new: int) -> None:
        nonlocal zone
        stack.append((name, new))
        opened[name] += 1
        zone = new

    def pop() -> str:
        nonlocal zone
        name = stack.pop()[0]
        opened[name] -= 1
        zone = stack[-1][1] if stack else 1
        return name

    def end_of(name: str) -> int | None:
        """Where a skipped element ends; None if it isn't closed."""
        if name not in ends or ends[name] is not None and ends[name].start() < at:
            ends[name] = _end(name).search(page, at)
        end = ends[name]
        if end is None:
            return len(page) if name in RAW else None
        return end.end() if end[0].startswith("</") else None

    # matches are sought from `at` on, so that nothing inside of a skipped element hides what follows it
    while tag := _TAG.search(page, at):
        held.append(page[at : tag.start()])
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            continue
        if tag[1]:
            if name in BLOCK:
                end_block()
            if opened[name]:
                if name not in BLOCK:
                    end_block()
                while pop() != name:
                    pass
            continue
        closed = tag[3].rstrip().endswith("/")
        if name in SKIPPED:
            end = at if closed and name not in RAW else end_of(name)
            if name not in ("button", "svg") or end is None:
                end_block()
            at = at if end is None else end
            continue
        if name not in BLOCK:
            if name == "br":
                held.append(" ")
            if name not in VOID and not closed:
                outside = bool(tag[3]) and _marked(name, tag[3])[0]
                if outside:
                    end_block()
                if outside or opened[name]:
                    push(name, 0 if outside else zone)
            continue
        end_block()
        if name in VOID or name == "head":
            continue
        while stack and stack[-1][0] in ENDS.get(name, ()):
            pop()
        outside, container = _marked(name, tag[3]) if tag[3] else (False, False)
        if closed:
            continue
        if zone and (outside or name in OUTSIDE or name == "header" and zone == 1):
            push(name, 0)
        elif zone and (container or name in CONTAINER):
            push(name, 2)
        else:
            push(name, zone)
    held.append(page[at:])
    end_block()
    return out


# ------------------------------------------------------------------ repeated runs

def run_classes(tokens: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray]:
    """Where a substring of ``run`` tokens without separator begins, and its class: equal substrings have equal ones.

    tokens: streams, each followed by a separator of its own (any negative number, all different).
    The suffixes are sorted by their first ``run`` tokens, by prefix doubling; neighbours with equal ones form a class.
    """
    n = len(tokens)
    if n < run:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    _, rank = np.unique(tokens, return_inverse=True)
    rank, width = rank.astype(np.int64), 1
    while width < run:
        step = min(width, run - width)
        after = np.zeros(n, dtype=np.int64)
        after[: n - step] = rank[step:] + 1
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        new = np.concatenate(([0], np.cumsum(key[order[1:]] != key[order[:-1]])))
        rank = np.empty(n, dtype=np.int64)
        rank[order] = new
        width += step
    inside = np.concatenate(([0], np.cumsum(tokens < 0)))
    start = np.flatnonzero(inside[run:] == inside[:-run])
    return start, rank[start]


def repeated_runs(tokens: np.ndarray, page: np.ndarray, run: int, pages: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all substrings of ``run`` tokens that stand on ``pages`` distinct pages, and their classes."""
    start, rank = run_classes(tokens, run)
    if not len(start):
        return start, rank
    both = np.unique(rank * (int(page.max()) + 1) + page[start])  # one per class and page
    classes, counts = np.unique(both // (int(page.max()) + 1), return_counts=True)
    often = np.isin(rank, classes[counts >= pages])
    return start[often], rank[often]


def covered(n: int, begin: np.ndarray, run: int) -> np.ndarray:
    """Whether each of n tokens is in a run that begins at one of the places."""
    cover = np.zeros(n + 1, dtype=np.int64)
    np.add.at(cover, begin, 1)
    np.add.at(cover, begin + run, -1)
    return np.cumsum(cover)[:-1] > 0


def repeated_tokens(tokens: np.ndarray, page: np.ndarray, run: int = 4, pages: int = 2) -> np.ndarray:
    """Whether each token is covered by a substring of ``run`` tokens that stands on ``pages`` distinct pages."""
    return covered(len(tokens), repeated_runs(tokens, page, run, pages)[0], run)


def stream(blocks_: list) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of the blocks that markup leaves, ``EDGE`` after each block; where each block begins."""
    texts = [t.encode("utf-8", "surrogatepass") for z, t in blocks_ if z]
    if not texts:
        return np.zeros(0, dtype=np.uint64), np.zeros(1, dtype=np.int64)
    words, starts = word_hashes(b"\n".join(texts))
    bounds = np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in texts)]))
    return np.insert(words, bounds[1:], EDGE), bounds + np.arange(len(bounds))


def hashes(tokens: np.ndarray, begin: np.ndarray | None = None, run: int = RUN) -> np.ndarray:
    """Hashes of the substrings of ``run`` tokens at the given places; by default at all."""
    begin = np.arange(max(0, len(tokens) - run + 1)) if begin is None else begin
    return range_hash(tokens, begin, begin + run)


def often(streams: list[np.ndarray], pages: int) -> np.ndarray:
    """Hashes of the runs that stand in ``pages`` of the streams, by a suffix array."""
    if not streams or pages > len(streams):
        return np.zeros(0, dtype=np.uint64)
    words = np.concatenate([np.append(x, EDGE) for x in streams])
    page = np.repeat(np.arange(len(streams)), [len(x) + 1 for x in streams])
    tokens = np.unique(words, return_inverse=True)[1].astype(np.int64)
    tokens[np.cumsum([len(x) + 1 for x in streams]) - 1] = -1 - np.arange(len(streams))
    start, rank = repeated_runs(tokens, page, RUN, pages)
    return np.unique(hashes(words, start[np.unique(rank, return_index=True)[1]]))


def main_text(blocks_: list, runs: np.ndarray) -> str:
    """Main text of a page (as blocks) on whose host the runs with these hashes (sorted) are boilerplate."""
    left = [(z, t) for z, t in blocks_ if z]
    kept = left
    if len(runs) and left:
        tokens, bounds = stream(blocks_)
        again = np.concatenate(([0], np.cumsum(covered(len(tokens), np.flatnonzero(np.isin(hashes(tokens), runs)), RUN))))
        words = np.diff(bounds) - 1
        shared = again[bounds[1:]] - again[bounds[:-1]]
        gone = np.where(words < RUN, shared == words + 1, (again[bounds[1:] - 1] - again[bounds[:-1]]) >= COVERED * words)
        kept = [b for b, g in zip(left, gone) if not g] or [b for b in left if b[0] == 2] or left
    return "\n\n".join(t for _, t in kept)


# ------------------------------------------------------------------ the operator

def host(url: Column) -> Column:
    """The host's name in lower case, without user and port; empty where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _content(blocks_: list) -> int:
    """Hash of what markup leaves of a page."""
    text = "\n".join(t for z, t in blocks_ if z)
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _unpacked(blocks_: bytes) -> list:
    return json.loads(zlib.decompress(blocks_))


def _streams(found: pd.DataFrame) -> list[np.ndarray]:
    """Streams of a group's distinct contents."""
    counted = found[found["counts"]].drop_duplicates("content")
    return [stream(_unpacked(b))[0] for b in counted["blocks"]]


def _runs(found: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(found["runs"].iloc[0], dtype=np.uint64) if len(found) else np.zeros(0, dtype=np.uint64)


def _few(table: DataFrame, most: int) -> tuple[DataFrame, int]:
    """The table, to be broadcast where it has at most that many rows; its rows, counted up to one more."""
    n = table.limit(most + 1).count()
    return (F.broadcast(table) if n <= most else table), n


def extracted(pages: DataFrame, group: int = GROUP, hosts: int = HOSTS) -> DataFrame:
    """page_id, url, text, n_chars per row of pages (page_id, url, html)."""
    prepare(pages.sparkSession)
    named = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), host(F.col("url")).alias("host"))
    named = named.withColumn("key", F.xxhash64("page_id", "url"))
    large = named.groupBy("host").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > group).select("host", F.ceil(F.col("n") / group).cast("int").alias("groups"))
    large, n_large = _few(large, hosts)

    @F.pandas_udf("blocks binary, content long")
    def parsed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [page_blocks(h if isinstance(h, str) else None) for h in batch]
            yield pd.DataFrame({"blocks": [zlib.compress(json.dumps(b, ensure_ascii=False).encode("utf-8", "surrogatepass"), 4) for b in found],
                                "content": pd.Series([_content(b) for b in found], dtype="int64")})

    @F.pandas_udf("long")
    def content(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([_content(page_blocks(h if isinstance(h, str) else None)) for h in batch], dtype="int64")

    # or a filter for nulls below the join would parse again
    content = content.asNondeterministic()

    rows = named.join(large, "host", "left").withColumn("groups", F.coalesce("groups", F.lit(1))).withColumn("p", parsed("html"))
    rows = rows.select("host", "groups", "key", F.col("page_id").cast("string").alias("page_id"), "url", "p.blocks", "p.content")
    place, counts = F.col("content"), F.lit(True)
    if n_large:
        # equal contents meet in a group, unless there are too many of them
        copies = named.join(large, "host").select("host", "key", content("html").alias("content"))
        copies = copies.groupBy("host", "content").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("first")).filter(F.col("n") > group).drop("n")
        rows = rows.join(_few(copies, hosts)[0], ["host", "content"], "left")
        place, counts = F.when(F.col("first").isNull(), F.col("content")).otherwise(F.col("key")), F.col("first").isNull() | (F.col("first") == F.col("key"))
    rows = rows.select("host", F.pmod(F.xxhash64(place), "groups").cast("int").alias("part"), "groups", "page_id", "url", "content", counts.alias("counts"), "blocks")
    grouped = rows.groupBy("host", "part")

    def candidates(found: pd.DataFrame) -> pd.DataFrame:
        streams, groups = _streams(found), int(found["groups"].iloc[0])
        least = max(1 if groups > 1 else PAGES, -(-SHARE * len(streams) // 100))
        return pd.DataFrame({"host": [found["host"].iloc[0]], "groups": [groups], "contents": [len(streams)], "runs": [often(streams, least).tobytes()]})

    def counted(key: tuple, found: pd.DataFrame, named: pd.DataFrame) -> pd.DataFrame:
        runs, n = _runs(named), np.zeros(0, dtype=np.int64)
        if len(runs) and len(found):
            runs, n = np.unique(np.concatenate([np.intersect1d(hashes(x), runs) for x in _streams(found)] or [runs[:0]]), return_counts=True)
        runs = runs[: len(n)]
        groups, contents = (int(named[c].iloc[0]) if len(named) else 0 for c in ("groups", "contents"))
        return pd.DataFrame({"host": pd.Series([key[0]] * len(runs), dtype=object), "groups": groups, "contents": contents, "run": runs.view(np.int64), "n": n})

    def extract(found: pd.DataFrame, repeated: pd.DataFrame) -> pd.DataFrame:
        ids = [i if isinstance(i, str) else None for i in found["page_id"]]
        urls = [u if isinstance(u, str) else None for u in found["url"]]
        runs = _runs(repeated)
        texts = [main_text(_unpacked(b), runs) for b in found["blocks"]]
        # a host's hash may leave a group without pages
        return pd.DataFrame({"page_id": ids, "url": urls, "text": texts, "n_chars": [len(t) for t in texts]}).astype({"page_id": object, "url": object, "text": object, "n_chars": "int64"})

    @F.pandas_udf("binary")
    def merged(lists: pd.Series) -> pd.Series:
        return pd.Series([np.unique(np.concatenate([np.frombuffer(r, dtype=np.uint64) for r in x])).tobytes() for x in lists])

    @F.pandas_udf("binary")
    def packed(lists: pd.Series) -> pd.Series:
        return pd.Series([np.unique(np.asarray(x, dtype=np.int64).view(np.uint64)).tobytes() for x in lists])

    def parts(by_host: DataFrame) -> DataFrame:
        """A row for each group of the host."""
        return by_host.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).groupBy("host", "part")

    runs = grouped.applyInPandas(candidates, "host string, groups int, contents long, runs binary")
    runs = runs.groupBy("host", "groups").agg(F.sum("contents").alias("contents"), F.collect_list("runs").alias("runs")).withColumn("runs", merged("runs"))
    if n_large:
        summed = grouped.cogroup(parts(runs)).applyInPandas(counted, "host string, groups int, contents long, run long, n long")
        summed = summed.groupBy("host", "groups", "contents", "run").agg(F.sum("n").alias("n"))
        repeated = summed.filter((100 * F.col("n") >= SHARE * F.col("contents")) & (F.col("n") >= PAGES))
        runs = repeated.groupBy("host", "groups").agg(F.collect_list("run").alias("run")).select("host", "groups", packed("run").alias("runs"))
    out = grouped.cogroup(parts(runs)).applyInPandas(extract, "page_id string, url string, text string, n_chars long")
    return out.withColumn("page_id", F.col("page_id").cast("bigint"))
