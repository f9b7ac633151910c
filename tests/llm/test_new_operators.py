"""Vector codes, line dedup and collocations against brute force, on whole small tables with awkward rows."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from math import floor, inf, nan

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadscope.llm import collocations, linededup, vectorcode
from leadscope.llm.common import Tables

from .conftest import EDGES, sentence

LOWER = {c: c + 32 for c in range(65, 91)}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ------------------------------------------------------------------ vector codes

def test_transform_and_nearest():
    rng = np.random.default_rng(1)
    for width in (1, 3, 8):
        size = 1 << max(width - 1, 0).bit_length()
        matrix = np.array([[(-1) ** bin(i & j).count("1") for j in range(size)] for i in range(size)])
        order = np.argsort([(np.diff(r) != 0).sum() for r in matrix])
        x = rng.integers(-9, 9, (5, width))
        padded = np.zeros((5, size), dtype=np.int64)
        padded[:, :width] = x
        assert (vectorcode.transformed(x) == (padded @ matrix.T)[:, order]).all()
        for kind in (np.int64, object):
            parts, entries = (rng.integers(-3, 3, (n, width)).astype(kind) for n in (300, 16))  # many ties
            distance = ((parts[:, None].astype(np.int64) - entries[None].astype(np.int64)) ** 2).sum(2)
            at, least = vectorcode.nearest(parts, entries)
            assert (at == distance.argmin(1)).all() and (least.astype(np.int64) == distance.min(1)).all()


def brute_codes(table, rounds=6):
    kept = [(i, label, [floor(4096 * int(x)) if abs(x) > 2**60 else floor(4096 * x) for x in v]) for i, v, label in table
            if v is not None and all(x is not None and abs(x) < inf for x in v)]
    wide = -(-max(len(v) for *_, v in kept) // 8)
    kept = [(i, label, v + [0] * (8 * wide - len(v))) for i, label, v in kept]
    by_id = {}
    for i, _, v in kept:
        by_id[i] = min(v, by_id.get(i, v))
    first = [by_id[i] for i in sorted(by_id, key=lambda i: (i is None, i or 0))[:16]]
    books = [[v[p * wide : (p + 1) * wide] for v in first] for p in range(8)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda x, book: min((dist(x, e), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p, book in enumerate(books):
            members = defaultdict(list)
            for *_, v in kept:
                x = v[p * wide : (p + 1) * wide]
                members[near(x, book)[1]].append(x)
            books[p] = [[sum(c) // len(c) for c in zip(*members[k])] if k in members else e for k, e in enumerate(book)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, by_label = [], defaultdict(int)
    for i, label, v in kept:
        found = [near(v[p * wide : (p + 1) * wide], book) for p, book in enumerate(books)]
        error = sum(d for d, _ in found)
        by_label[label] += error
        out.append((i, "".join(f"{k:02x}" for _, k in found), error, label))
    fits = lambda x: x if x < 1 << 63 else None
    return sorted(((i, code, fits(e), fits(by_label[label]), digest) for i, code, e, label in out), key=repr)


def embedding_rows(n, width, seed=1, spread=1.0):
    rng = random.Random(seed)
    f32 = lambda x: float(np.float32(x))
    return [(3 * k + 5, [f32(rng.gauss(0, spread)) for _ in range(width)], rng.choice([0, 1, 2, None])) for k in range(n)]


@pytest.mark.parametrize("case", ["plain", "edges", "huge", "few", "copies"])
def test_vector_codes(spark, case):
    table = embedding_rows(60, 16)
    if case == "edges":  # nulls, non-finite values, other lengths, a null id, repeated rows and ids
        table += [(1, None, 0), (2, [1.0, None], 0), (3, [nan] * 16, 1), (4, [inf] + [0.0] * 15, 1), (None, [0.5] * 16, None), (700, [0.25] * 13, 9), (701, [], 9)]
        table += [table[0], (5, [-9.0] * 16, 3), (8, [0.0] * 16, 3)]
    elif case == "huge":
        table += embedding_rows(10, 16, 2, 1e30)
    elif case == "few":
        table = table[:3]
    elif case == "copies":
        table = [(k, table[0][1] if k % 3 else table[k % 7][1], k % 2) for k in range(200)]
    df = spark.createDataFrame(table, "vec_id long, embedding array<float>, label int").withColumn("code", F.lit("x")).repartition(3)
    want = brute_codes(table)
    assert rows(vectorcode.coded(df)) == want
    assert rows(vectorcode.coded(df, share=2.0)) == want  # all labels by the shuffle


def test_vector_codes_of_nothing(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert vectorcode.coded(spark.createDataFrame([], schema)).count() == 0
    assert vectorcode.coded(spark.createDataFrame([(1, None, 1), (2, [nan], 2)], schema)).count() == 0


def test_limbs():
    for x in (0, 5, -5, 2**32, -(2**32), 2**63, -(2**200) + 7):
        assert sum(v << 32 * k for k, v in enumerate(vectorcode._limbs(x))) == x


# ------------------------------------------------------------------ line dedup

def brute_lines(table):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holds = defaultdict(set)
    for i, t in table:
        for line in (t or "").split("\n"):
            holds[key(line)].add(i)
    out = []
    for i, t in table:
        lines = (t or "").split("\n")
        goes = lambda line: len(key(line)) >= 40 and len(holds[key(line)]) >= 5 and (i is None or i < max(x for x in holds[key(line)] if x is not None))
        kept = [line for line in lines if not goes(line)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_line_dedup(documents):
    notice, short, rare = "  This LINE stands in many of the documents here, äöü\t", "short line " + "x" * 28, "this one stands in four documents, which is too few"
    table = [*EDGES, *[(100 + k, f"{sentence(k, 9)}\n{notice if k % 2 else notice.strip().lower()}\n\n{short}\n{rare if k < 4 else ''}\n{notice}") for k in range(9)]]
    table += [(100, table[-9][1]), (None, notice + "\n" + notice), (None, None), (200, "\n\n\n"), (201, notice), (202, notice + "\r\nleft"), (50, "\n".join([notice] * 5000 + ["end"]))]
    extra = documents(table).withColumn("th", F.lit("x")).withColumn("pos", F.lit(1)).withColumn("gone", F.lit(2)).repartition(3)
    want = brute_lines(table)
    assert sum(w[2] for w in want) > 5000 and rows(linededup.digests(extra)) == want
    by_shuffle = linededup.deduplicated(extra, share=2.0).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256))
    assert rows(by_shuffle) == want
    assert linededup.digests(documents([])).count() == 0


def test_line_dedup_runs_no_python(spark):
    from leadscope.llm import queries

    for query in (queries.op12_line_dedup, queries.op2_sharding):
        plan = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


# ------------------------------------------------------------------ collocations

def brute_phrases(table, least, percent=100, top=2000):
    count, n = defaultdict(Counter), Counter()
    for lang, text in table:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for m in range(1, 6):
                count[lang or "und"].update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, c in count.items():
        cands = {g: a for g, a in c.items() if a >= least and len(g) > 1}
        held = lambda g, q: any(q[i : i + len(g)] == g for i in range(len(q) - len(g) + 1))
        found = []
        for g, a in cands.items():
            if not any(len(q) > len(g) and 100 * b >= percent * a and held(g, q) for q, b in cands.items()):
                score, k = min((1000 * a * n[lang] // (c[g[:k]] * c[g[k:]]), k) for k in range(1, len(g)))
                found.append((-score, -a, " ".join(g).encode(), c[g[:k]], c[g[k:]]))
        out += [(lang, at + 1, p.decode(), -a, l, r, n[lang], -s) for at, (s, a, p, l, r) in enumerate(sorted(found)[:top])]
    return sorted(out, key=repr)


def phrase_table():
    rng = random.Random(4)
    words = ["the", "The", "of", "cat", "sat", "on", "mat", "ä", "日本", "x\x01y", "a\xa0b"]
    table = [(rng.choice(["en", "de", "und", None]), "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", "\r\n", ", "]) for _ in range(rng.randint(1, 60)))) for _ in range(200)]
    table += [("en", "one two three four five six. " * 30), ("en", None), (None, None), ("fr", "?!.\n"), ("es", ""), ("it", "solo " * 12), *[("pt", "same row again")] * 10]
    return table


@pytest.mark.parametrize("percent,block", [(100, 6 << 20), (70, 300)])
def test_collocations(documents, percent, block, monkeypatch):
    table = phrase_table()
    df = documents([(k, t, lang) for k, (lang, t) in enumerate(table)]).withColumn("n", F.lit(1)).withColumn("phrase", F.lit("x")).repartition(3)
    want = brute_phrases(table, 8, percent, 40)
    monkeypatch.setattr(collocations, "BLOCK_BYTES", block)
    got = collocations.collocations(df, top=40, least=8, percent=percent)
    assert rows(got) == want and {w[0] for w in want} >= {"en", "de", "und", "it", "pt"}


def test_collocation_scores_beyond_64_bits(spark):
    n = 3 * 10**15
    one = spark.createDataFrame([(n, [n // 3], [n // 3], 7 * 10**15)], "f long, lefts array<long>, rights array<long>, n long")
    assert one.select(collocations._cut_at(1, 2, 1000).alias("c")).first().c.score == 1000 * n * 7 * 10**15 // (n // 3) ** 2


def test_collocations_of_nothing(documents):
    assert collocations.collocations(documents([])).count() == 0
    assert collocations.collocations(documents([(1, None), (2, "only once")])).count() == 0


def test_streams_are_merged(documents, spark):
    table = documents([(k, t, lang) for k, (lang, t) in enumerate(phrase_table())])
    df = collocations.scored(table, Tables(spark, "test"), least=8, longest=3)
    plan = df._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "ShuffledHashJoin" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
