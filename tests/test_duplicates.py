"""DOC-1 against brute force: exact blocks, alike texts, large blocks, hot keys, awkward rows."""
import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from leadscope.functions.components import components
from leadscope.functions.joins import join_groups
from leadscope.operators import duplicates as dup
from leadscope.sources import fixtures as fx

SCHEMA = "Id string, FirstName string, LastName string, Email string, Phone string, Company string"


def grams(text):
    t = f"  {text} "
    return {t[i : i + 3] for i in range(len(t) - 2)}


def brute(rows):
    """Cluster (smallest id) of each id, by all pairs."""
    keys = {}
    for i, first, last, email, phone, company in rows:
        if i is not None:
            mail = email.strip().lower() if email and re.fullmatch(dup.EMAIL_SYNTAX, email.strip()) else None
            d = re.sub("[^0-9]", "", phone or "")
            tel = d[-10:] if phone and re.fullmatch(dup.PHONE_CHARS, phone.strip()) and re.fullmatch(dup.NANP, d) else None
            full = all(x and x.strip() for x in (first, last, company))
            text = re.sub(r"\s+", " ", " ".join(x.strip().lower() for x in (first, last, company))) if full else None
            keys[i] = (mail, tel, text)
    cluster = {i: i for i in keys}
    ids = sorted(keys)

    def root(i):
        while cluster[i] != i:
            i = cluster[i]
        return i

    for a in ids:
        for b in ids:
            if a < b:
                (m, p, t), (n, q, u) = keys[a], keys[b]
                if (m and m == n) or (p and p == q) or (t and u and len(grams(t) & grams(u)) / len(grams(t) | grams(u)) >= 0.85):
                    x, y = root(a), root(b)
                    cluster[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def people(n, seed=1):
    rng = random.Random(seed)
    firsts, lasts, firms = (["".join(rng.choice("abcdefgh ") for _ in range(k)).strip() or "x" for _ in range(30)] for k in (7, 9, 14))
    rows = []
    for k in range(n):
        first, last, firm = rng.choice(firsts), rng.choice(lasts), rng.choice(firms)
        if rng.random() < 0.3:
            firm = firm[:-1] + rng.choice("xyz")
        rows.append((f"L{k}", first.title(), last, f"u{rng.randrange(3 * n)}@corp.com" if rng.random() < 0.6 else None,
                     f"212-555-{rng.randrange(9000) + 1000}" if rng.random() < 0.5 else "12345", firm))
    return rows


EDGES = [("E1", None, None, None, None, None), ("E2", "", " ", "", "", ""), (None, "A", "B", "u1@corp.com", None, "C"), ("E3", "Ann", "Lee", "  Mail@Corp.com ", None, "Acme  Holdings"),
         ("E4", "ann", "LEE", "mail@corp.com", None, "acme holdings"), ("E4", "ann", "LEE", "mail@corp.com", None, "acme holdings"), ("E5", "ann", "lee", None, "+1 (212) 555-0000", "acme holdings"),
         ("E6", "Zoe", "Q", None, "212.555.0000", None), ("E7", "Zoe", "Q", None, None, None), ("E8", "Zoe", "Q", "not-an-email", None, None), ("E9", "ä" * 3000, "ö", None, None, "ß" * 3000), ("F1", "ä" * 3000, "ö", None, None, "ß" * 2999)]


def clusters(df, **settings):
    return {r.lead_id: r.cluster_id for r in dup.duplicate_clusters(df, **settings).collect()}


@pytest.mark.parametrize("most", [200, 2])
def test_clusters_are_those_of_all_pairs(spark, most):
    rows = people(150) + EDGES
    df = spark.createDataFrame(rows, SCHEMA).withColumn("lead", F.lit(1)).withColumn("text", F.lit("x"))
    want = brute(rows)
    assert clusters(df, most=most) == want and len(set(want.values())) < len(want)


def test_a_family_of_alike_texts_in_one_block(spark):
    rows = [(f"L{k:03d}", "maximilian", f"mustermann{k:03d}", None, None, "international business holdings company") for k in range(60)]
    assert clusters(spark.createDataFrame(rows, SCHEMA), most=5) == brute(rows)


def test_a_hot_key_is_one_link_per_lead(spark):
    rows = [(f"L{k:05d}", None, None, "same@corp.com" if k % 3 == 0 else f"u{k}@corp.com", None, None) for k in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert dup.duplicate_links(df).count() == 999
    got = clusters(df)
    assert sum(v == "L00000" for v in got.values()) == 1000 and len(got) == 3000


def test_no_leads(spark):
    assert dup.duplicate_clusters(spark.createDataFrame([], SCHEMA)).count() == 0


def test_recall_of_candidates_on_the_fixture(spark):
    """All pairs of distinct texts at 0.85 or more, by brute force, against the candidates that the bands give."""
    profiles = dup._profiles(fx.leads(spark, SF_SMALL))
    texts = profiles.filter("text IS NOT NULL").groupBy("text").agg(F.min("lead").alias("node")).collect()
    want = {tuple(sorted((x.node, y.node))) for x in texts for y in texts if x.node < y.node and len(grams(x.text) & grams(y.text)) / len(grams(x.text) | grams(y.text)) >= 0.85}
    got = {(r.a, r.b) for r in dup.alike_links(profiles).filter("similarity < 1").collect()}
    assert len(want & got) >= 0.9 * len(want) and not {p for p in got - want}


def test_plan_has_no_pairs_of_everything(spark):
    plan = dup.duplicate_links(fx.leads(spark, SF_SMALL))._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "Python" not in plan


def test_components(spark):
    rng = random.Random(2)
    links = [(f"n{rng.randrange(200):03d}", f"n{rng.randrange(200):03d}") for _ in range(120)] + [(f"c{k:03d}", f"c{k + 1:03d}") for k in range(60)] + [("s", "s")]
    parent = {x: x for link in links for x in link}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a string, b string")).collect()}
    assert got == {x: root(x) for x in parent if x != "s"}


def test_joined_groups(spark):
    rows = spark.createDataFrame([(k % 7 if k % 3 else 0, k) for k in range(100)], "g int, v int")
    groups = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n")).filter("g <> 5")
    want = sorted(map(tuple, rows.join(groups, "g").collect()))
    for share in (0, 0.2, 2):
        assert sorted(map(tuple, join_groups(rows, groups, ["g"], "n", share).collect())) == want
