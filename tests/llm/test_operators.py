"""Each operator against brute force, on whole small tables with the awkward rows of EDGES."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from leadscope.llm import bpe, decontam, exact, html_extract, langid, ngram_join, quality, queries, sharding, substring, tokencount

from .conftest import EDGES, SCHEMA, sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def family(seed=3):
    """Copies, near copies, shared passages and lines."""
    rng, out, n = random.Random(seed), [], 100
    passage, line = sentence(900, 60), "this line stands in very many of the documents here"
    for g in range(12):
        base = sentence(g, rng.randint(20, 300)).split()
        for _ in range(rng.randint(1, 7)):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5, 20])):
                words[rng.randrange(len(words))] = f"e{rng.randrange(9999)}"
            if rng.random() < 0.4:
                words[10:10] = passage.split()
            out.append((n, (line + "\n" if rng.random() < 0.5 else "") + " ".join(words)))
            n += 1
    return out


def test_exact(documents):
    table = [*EDGES, *family()]
    got = exact.groups(documents(table)).drop("row")
    groups = defaultdict(list)
    for i, t in table:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    want = Counter()
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        for i in ids:
            want[i, min(known) if known else None, len(ids), hashlib.sha256(t.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got.collect()) == want
    assert got.filter("kept").count() == len(groups)
    kept = exact.kept_documents(documents(table))
    assert kept.count() == len(groups) and kept.columns == documents([]).columns
    assert exact.groups(documents([])).count() == 0


def test_exact_keeps_clashing_columns(documents):
    table = documents([(2, "a  b"), (1, "a b")]).withColumn("k_id", F.lit(7)).withColumn("text_sha256", F.lit("mine"))
    assert [(r.doc_id, r.k_id, r.text_sha256) for r in exact.kept_documents(table).collect()] == [(1, 7, "mine")]


@pytest.mark.parametrize("limit", [300, 5000, 10**7])
def test_sharding(documents, limit):
    table = [*EDGES, *family(), *[(77, "same row")] * 100]
    got = sharding.assign(documents(table), limit)
    assert Counter((r.doc_id, r.n_bytes) for r in got.collect()) == Counter((i, len((t or "").encode())) for i, t in table)
    total, largest = defaultdict(int), defaultdict(int)
    for r in got.collect():
        total[r.shard] += r.n_bytes
        largest[r.shard] = max(largest[r.shard], r.n_bytes)
    assert all(n <= limit or n == largest[s] for s, n in total.items())
    names = [s for s in total if "-" not in s]
    assert not any(a != b and b.startswith(a) and total[a] for a in names for b in names if len(a) < 60)
    assert sharding.assign(documents([]), limit).count() == 0


def test_decontamination(documents, spark):
    items = [(1, sentence(2, 30)), (2, "Short, item"), (3, None), (4, sentence(2, 30)), (4, sentence(2, 30)), (5, "?!")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    table = [*EDGES, (50, "x. " + sentence(2, 30).upper() + " y"), (51, sentence(8, 400) + " " + sentence(2, 13)), (52, "a short: ITEM b"), (53, sentence(2, 12))]
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = {c: c + 32 for c in range(65, 91)}
    want = []
    for i, t in table:
        w, hit, found = word.findall((t or "").translate(lower)), set(), set()
        for item, text in items:
            v = word.findall((text or "").translate(lower))
            for k in range(len(v) - min(13, len(v)) + 1 if v else 0):
                win = v[k : k + 13]
                if win[0] in w:
                    for j in range(len(w) - len(win) + 1):
                        if w[j : j + len(win)] == win:
                            hit.update(range(j, j + len(win)))
                            found.add(str(item))
        want.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    assert rows(decontam.report(documents(table), benchmark)) == sorted(want, key=repr)
    in_blocks = decontam.judged(documents(table), benchmark, block_bytes=10).select("doc_id", "contamination.n_hit", "contamination.items_sha256")
    assert rows(in_blocks) == sorted(((w[0], w[2], w[4]) for w in want), key=repr)
    clean = decontam.clean(documents(table).withColumn("contamination", F.lit(1)), benchmark)
    assert clean.columns[-1] == "contamination" and clean.count() == sum(not w[5] for w in want)
    at = {r.doc_id: (r.start, r.end) for r in decontam.spans(documents(table), benchmark).collect()}
    assert table[-2][1][slice(*at[52])] == "short: ITEM"
    assert decontam.report(documents(table), benchmark.limit(0)).filter("n_hit > 0").count() == 0


def test_substring(documents):
    table = [*EDGES, *family(), (300, sentence(1, 20) + " " + " ".join(["again and"] * 40))]
    for window, many in ((35, 256), (7, 1)):
        where = Counter()
        texts = [WORD.findall(t or "") for _, t in table]
        for w in texts:
            where.update(tuple(w[k : k + window]) for k in range(len(w) - window + 1))
        want = []
        for (i, _), w in zip(table, texts):
            gone = {j for k in range(len(w) - window + 1) if where[tuple(w[k : k + window])] > 1 for j in range(k, k + window)}
            want.append((i, len(w), len(gone), hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in gone).encode()).hexdigest()))
        before, substring.MANY = substring.MANY, many
        try:
            assert rows(substring.removed(documents(table), window, 500).drop("kept_text")) == sorted(want, key=repr)
        finally:
            substring.MANY = before


def test_jaccard(documents):
    table = [*EDGES, *family(), *family(4)[:0]]
    sets = []
    for _, t in table:
        w = WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(table)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(table)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    ids = defaultdict(list)
    for k, (i, _) in enumerate(table):
        ids[root(k)].append(i)
    want = sorted(((i, len(sets[k]), min((x for x in ids[root(k)] if x is not None), default=None)) for k, (i, _) in enumerate(table)), key=repr)
    assert rows(ngram_join.joined(documents(table)).drop("th")) == want
    # lists that are long at once: pivots and squares
    before, ngram_join.SIDE = ngram_join.SIDE, 2
    try:
        assert rows(ngram_join.joined(documents(table), frequent=10**6, short=1).drop("th")) == want
    finally:
        ngram_join.SIDE = before
    assert ngram_join.joined(documents([])).count() == 0


def test_bpe(documents):
    from tokenizers import Tokenizer

    path = queries.vocabulary(queries.WORD_BPE)
    library = Tokenizer.from_file(path)
    table = [*EDGES, (70, "Hello World's a<|endoftext|>\x1c\x1d b <|startoftext|>"), (71, "aaaaaaaaaaaaa !!!!!!!! 1234"), (72, "é́   x ﬁ 🎉👍🏽"), (73, "a\u0558b \u058a\u058b")]
    want = []
    for i, t in table:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert rows(bpe.digests(documents(table), path)) == sorted(want, key=repr)
    back = bpe.decoded(bpe.encoded(documents(table).select("doc_id", "text"), path), path)
    assert all(r.decoded == library.decode(r.ids, skip_special_tokens=False) for r in back.collect())


def test_token_counts(documents):
    from tokenizers import Tokenizer

    path = queries.vocabulary(queries.BYTE_BPE)
    library = Tokenizer.from_file(path)
    table = [*EDGES, (70, "a <|endoftext|> b\n\n  c\t'll"), (71, "    x\x1c y"), (72, "a\u0558b \u058a\u058b")]
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 1024) for i, t in table]
    assert rows(tokencount.counted(documents(table), path)) == sorted(want, key=repr)
    assert tokencount.counted(documents([]), path).count() == 0


def test_quality_and_language_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = queries.op1_quality_classifier(spark, folder).collect()
    held = [r for r in got if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.95 * len(held) > 20
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    found = [r for r in queries.op5_language_id(spark, folder).collect() if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in found) >= 0.95 * len(found) > 100


def test_models_on_edges(documents, spark):
    table = documents(EDGES)
    labels = spark.createDataFrame([(7, 1, 0), (9, 0, 0), (4, None, None)], "doc_id long, quality int, toxic int")
    model = quality.fit(table, labels)
    got = quality.scored(table, model)
    assert got.count() == len(EDGES) and got.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert quality.scored(table, quality.fit(table, labels.limit(0))).filter("score <> 0.5").count() == 0
    assert quality.accepted(table.withColumn("score", F.lit("x")), model).columns[-1] == "score"
    speaker = langid.fit(table)
    found = {(r.doc_id, r.lang_pred) for r in langid.predicted(table, speaker).collect()}
    assert (1, "und") in found and (3, "und") in found and (7, "en") in found
    assert langid.predicted(table, langid.fit(documents([]))).filter("lang_pred <> 'und'").count() == 0


def test_language_of_long_texts():
    def words(seed):
        rng = random.Random(seed)
        return ["".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 5))) for _ in range(3000)]
    vocabulary = {k: words(k) for k in "abc"}
    def text(kind, seed, size):
        rng, out = random.Random(seed), []
        for _ in range(size // 2):
            out.append(vocabulary[kind][min(int(rng.paretovariate(0.6)), 3000) - 1])
        return " ".join(out)[:size]
    model = langid.LanguageModel({k: text(k, 1, langid.DICT_BYTES).encode() for k in "ab"})
    assert langid.pieces_of(b"x" * (langid.PIECE + 1)) == [b"x" * (langid.PIECE // 2), b"x" * (langid.PIECE // 2 + 1)] and langid.pieces_of(b"xy") == [b"xy"]
    whole = {n: model.predict(text("a", 2, n)) for n in (30_000, 300_000, 4_000_000)}
    assert all(lang == "a" and not rejected for lang, _, rejected in whole.values())
    # each part counts: what most of the text is written in wins, wherever the rest stands
    for first, then in (("b", "a"), ("c", "a"), ("a", "b")):
        lang, _, rejected = model.predict(text(first, 3, 256 << 10) + " " + text(then, 4, 1 << 20))
        assert lang == then and not rejected


def test_every_language_is_learned(documents):
    def prose(lang, doc):
        rng, doc_rng = random.Random(lang), random.Random(doc)
        words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(20)]
        return " ".join(doc_rng.choices(words, k=60))
    table = documents([(1000 * k + j, prose(k, j), f"l{k:03d}") for k in range(230) for j in range(6 if k < 220 else 5)])
    model = langid.fit(table)
    assert len(model.dictionaries) == 230 and sum(map(len, langid.fit(table, total_bytes=46_000).dictionaries.values())) <= 46_000
    assert all(model.predict(prose(k, 77))[:1] == (f"l{k:03d}",) for k in (0, 199, 210, 225, 229))


def test_html(spark):
    menu = "<nav><a href=x>Home</a> <a>News</a></nav>"
    page = f"<html><head><title>t</title></head><body>{menu}<div class='cookie-notice'>ok?</div><article><h1>A &amp; B</h1><p>one<br>two  three<p>four</article><div class=comments><p>bad</p></div><footer>f</footer></body></html>"
    plain = ["<body><div>Our site has the best of all news</div><div><p>{}</p></div><form>Search<input></form>".format(sentence(k, 30)) for k in range(3)]
    table = spark.createDataFrame([(1, "http://a.org/1", page, 0), (2, "http://a.org/2", page, 0), (2, "http://a.org/2", page, 0), (3, None, None, 0), (None, "x", "", 0),
                                   *[(10 + k, "http://b.org/", h, 0) for k, h in enumerate(plain)]], "page_id long, url string, html string, text int")
    got = html_extract.extracted(table)
    text = {r.page_id: r.text for r in got.collect()}
    assert got.count() == 8 and text[1] == text[2] == "A & B\n\none two three\n\nfour" and text[3] == text[None] == ""
    assert [text[10 + k] for k in range(3)] == [sentence(k, 30) for k in range(3)]
    assert html_extract.extracted(table, group=1).count() == 8 and html_extract.extracted(table.limit(0)).count() == 0
    # suffix classes against all substrings
    rng = random.Random(1)
    import numpy as np
    tokens = np.array([rng.randrange(3) for _ in range(200)])
    tokens[::25] = -np.arange(1, 9)
    pages = np.arange(200) // 25
    want = np.zeros(200, dtype=bool)
    for a in range(197):
        win = tokens[a : a + 4]
        if (win >= 0).all() and len({pages[b] for b in range(197) if (tokens[b : b + 4] == win).all()}) >= 2:
            want[a : a + 4] = True
    assert (html_extract.repeated_tokens(tokens, pages) == want).all()


def html_pages(spark, bodies, host="h.org"):
    return spark.createDataFrame([(k, f"http://{host}/{k}", f"<body>{b}</body>") for k, b in enumerate(bodies)], "page_id long, url string, html string")


def html_texts(pages, **sizes):
    return {r.page_id: r.text for r in html_extract.extracted(pages, **sizes).collect()}


def test_html_copies_and_phrases_stay(spark):
    article = [sentence(k, 60) for k in range(12)]
    bodies = [f"<div>{a}</div><p>as we said the other day {sentence(50 + k, 6)}</p>" for k, a in enumerate(article)]
    got = html_texts(html_pages(spark, bodies + bodies[:2] + [bodies[0]] * 3))  # copies under other urls, a common phrase
    assert all(got[k] == f"{a}\n\nas we said the other day {sentence(50 + k, 6)}" for k, a in enumerate(article))
    assert got[12] == got[0] == got[14] and got[13] == got[1]
    # repetition alone doesn't empty a page
    notice = "<div>" + sentence(99, 20) + "</div>"
    got = html_texts(html_pages(spark, [notice + f"<div>{a}</div>" for a in article] + [notice]))
    assert got[12] == sentence(99, 20) and all(got[k] == a for k, a in enumerate(article))


def test_html_groups_dont_change_texts(spark):
    notice, rare = "<div>" + sentence(99, 20) + "</div>", "<div>" + sentence(98, 20) + "</div>"
    bodies = [(notice if k % 3 else "") + (rare if k < 4 else "") + f"<div>{sentence(k, 40)}</div>" for k in range(30)]
    pages = html_pages(spark, bodies + [bodies[1]] * 5)
    want = html_texts(pages)
    assert want[1] == f"{sentence(98, 20)}\n\n{sentence(1, 40)}" and want[0] == f"{sentence(98, 20)}\n\n{sentence(0, 40)}" and want[29] == sentence(29, 40)
    assert all(html_texts(pages, group=n) == want for n in (1, 4, 30, 35)) and html_texts(pages, group=4, hosts=0) == want


def test_html_containers(spark):
    advert = "<p>" + sentence(99, 20) + "</p>"
    pages = [f"<h1>Title {k} of it</h1><article><p>{sentence(k, 40)}</p>{advert}</article>" for k in range(4)]
    teaser = [f"<div role=main><p>{sentence(20 + k, 40)}</p></div><div>{sentence(40 + k, 12)}</div><div>Home</div><div>News of the day</div><div>About us and more</div>" for k in range(4)]
    got = html_texts(html_pages(spark, pages))
    assert [got[k] for k in range(4)] == [f"Title {k} of it\n\n{sentence(k, 40)}" for k in range(4)]
    got = html_texts(html_pages(spark, teaser))
    assert [got[k] for k in range(4)] == [f"{sentence(20 + k, 40)}\n\n{sentence(40 + k, 12)}" for k in range(4)]


def test_html_legal_but_careless_markup():
    def kept(page):
        return [text for zone, text in html_extract.page_blocks(page) if zone]

    assert kept("<head><title>t</title><p>One") == ["One"]
    assert kept("<p>One.<button>x<article><p>Two</article>") == ["One.", "x", "Two"]
    assert kept("<p>a<video src=x><p>b<article>c</article>") == ["a", "b", "c"]
    assert kept("<p>a<button>no</button>b<button>no</button>c<video>no</video>") == ["abc"]
    assert kept("<article><p data-x=it's>A</p><p>That's</p></article>") == ["A", "That's"]
    assert kept('<p title="foo>Text of it') == ["Text of it"] and kept('<p title="a > b">Text') == ["Text"]
    assert kept("c <d e> f</d> g") == ["c f g"]
    assert kept("<p>x<script>if (a < b) '</p>'</script>y<!-- z -->") == ["x", "y"]
    for name in ("social-science", "related-work", "share-price", "search", "ad-hoc", "notice-period"):
        assert kept(f"<article><div class='{name}'>in</div></article>") == ["in"], name
    for name in ("social", "share-bar", "ad ad-top", "x sidebar-left", "cookie_notice", "site-header", "ad-3"):
        assert kept(f"<article>a<div class='{name}'>out</div>b</article>") == ["a", "b"], name
    assert kept("<p title='a class=ad b'>in</p>") == ["in"]
    assert kept("<p><span class=ad>Buy <span>now</span> cheap</span> ok") == ["ok"]


def test_html_time_grows_with_the_page_alone():
    import time

    for unit in ("</i></div></x>", "<button>x", "<svg>", "<span class=ad>", "<p a='\"'", "<select><option>"):
        begin = time.process_time()
        html_extract.page_blocks("<div>" * 100_000 + unit * 100_000)
        assert time.process_time() - begin < 20, unit


def test_language_letters_and_places(spark):
    assert langid.letters("²½Ⅷ①_7٣") == b"" and langid.letters("Aª²b") == "aª b".encode()
    model = langid.LanguageModel({"a": b"abc " * 99, "b": b"xyz " * 99})
    assert all(model.predict(t) == ("und", 0.0, True) for t in ("½", "²", "", None, "12 ①"))
    even = langid.LanguageModel({"b": b"abc " * 99, "a": b"abc " * 99})
    assert even.predict("abc abc")[0] == "a" and even.predict("abc abc")[2]  # a tie: the first name, rejected
    # what stands late in a long text is learned too
    text = "kuzu " * 4000 + "mira " * 4000
    rows = spark.createDataFrame([(k, text, "x") for k in range(12)] + [(k, None, "y") for k in range(12)], "doc_id long, text string, lang string")
    found = langid.fit(rows)
    assert b"kuzu" in found.dictionaries["x"] and b"mira" in found.dictionaries["x"] and "y" not in found.dictionaries
    assert langid.predicted(rows.limit(0), found).count() == 0
    assert {r.lang_pred for r in langid.predicted(rows.withColumn("score", rows.doc_id), found).collect()} == {"x", "und"}
