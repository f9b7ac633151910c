"""DuckDB SQL of the operators that SQL can express, in plain form (no operator's method)."""

from __future__ import annotations

from .sharding import LIMIT


def sharding_sql(limit: int = LIMIT) -> str:
    """Shards over the limit after 60 bits don't occur here: no id and text repeat in the tables."""
    return f"""
WITH d AS (
    SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
           ('0x' || left(md5(coalesce(doc_id::VARCHAR, chr(0)) || chr(31) || md5(coalesce(text, chr(0)))), 15))::BIGINT AS hash
    FROM documents),
p AS (SELECT d.*, b.depth, hash // (1::BIGINT << (60 - b.depth)) AS prefix FROM d, range(0, 61) AS b(depth)),
s AS (SELECT depth, prefix, sum(n_bytes)::BIGINT AS shard_bytes FROM p GROUP BY ALL),
f AS (SELECT p.doc_id, p.hash, p.n_bytes, min(p.depth) AS depth
      FROM p JOIN s USING (depth, prefix) WHERE s.shard_bytes <= {limit} OR p.depth = 60 GROUP BY ALL)
SELECT f.doc_id, f.n_bytes,
       CASE WHEN f.depth = 0 THEN '' ELSE right(lpad(bin(f.hash // (1::BIGINT << (60 - f.depth))), 64, '0'), f.depth::INT) END AS shard,
       f.depth::INT AS depth, s.shard_bytes, s.shard_bytes > {limit} AS oversized
FROM f JOIN s ON s.depth = f.depth AND s.prefix = f.hash // (1::BIGINT << (60 - f.depth))"""


EXACT = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)"""

DECONTAMINATION = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
i AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[k : k + least(13, len(w)) - 1], ' ') AS x
      FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS k FROM iw WHERE len(w) > 0)),
t AS (SELECT DISTINCT n FROM i),
win AS (SELECT doc_id, t.n, k, array_to_string(w[k : k + t.n - 1], ' ') AS x
        FROM dw, t, unnest(range(1, greatest(0, len(w) - t.n + 1) + 1)) AS r(k)),
hit AS (SELECT win.doc_id, win.k, win.n, i.item_id FROM win JOIN i ON win.n = i.n AND win.x = i.x),
words AS (SELECT DISTINCT doc_id, unnest(range(k, k + n)) AS pos FROM hit),
h AS (SELECT doc_id, count(*) AS n_hit FROM words GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN h USING (doc_id) LEFT JOIN items USING (doc_id)"""

SUBSTRING = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, k, md5(array_to_string(w[k : k + 34], ' ')) AS x FROM d, unnest(range(1, len(w) - 33)) AS r(k) WHERE len(w) >= 35),
again AS (SELECT x FROM win GROUP BY x HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(k, k + 35)) AS pos FROM win SEMI JOIN again USING (x)),
kept AS (SELECT doc_id, string_agg(w[pos], ' ' ORDER BY pos) AS text
         FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS pos FROM d) ANTI JOIN gone USING (doc_id, pos) GROUP BY 1),
n AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)"""

JACCARD = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(w[k : k + 4], ' ')) AS x
      FROM d, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS r(k) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (x) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM least LEFT JOIN n USING (doc_id)"""



def vector_code_sql(rounds: int = 6, entries: int = 16) -> str:
    """Rounds one after the other; every table of a round is a common table expression."""
    steps = [f"""
WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v FROM embeddings
              WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS MATERIALIZED (SELECT vec_id, label, p, v[p * (len(v) // 8) + 1 : (p + 1) * (len(v) // 8)] AS x FROM kept, range(8) AS t(p)),
b0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x FROM part
                    WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY 1 LIMIT {entries}))"""]
    for k in range(rounds + 1):
        steps.append(f"""
a{k} AS MATERIALIZED (SELECT vec_id, label, p, part.x, min(struct_pack(d := list_sum(list_transform(list_zip(part.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, e := e)) AS m
                      FROM part JOIN b{k} AS b USING (p) GROUP BY ALL)""")
        if k < rounds:
            steps.append(f"""
s{k} AS (SELECT p, m.e AS e, i, sum(x[i])::BIGINT AS s, count(*) AS n FROM a{k}, unnest(range(1, len(x) + 1)) AS t(i) GROUP BY ALL),
m{k} AS (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM s{k} GROUP BY ALL),
b{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.x, b.x) AS x FROM b{k} AS b LEFT JOIN m{k} AS m USING (p, e))""")
    return ",".join(steps) + f""",
book AS (SELECT sha256(string_agg(x[i]::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256 FROM b{rounds}, unnest(range(1, len(x) + 1)) AS t(i)),
code AS (SELECT vec_id, label, string_agg(lpad(to_hex(m.e), 2, '0'), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error FROM a{rounds} GROUP BY ALL)
SELECT vec_id, lower(code) AS code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM code, book"""


LINES = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM d),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
often AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT k.*, coalesce(keeper > doc_id, false) AS gone FROM k LEFT JOIN often USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id"""

COLLOCATIONS = r"""
WITH piece AS (SELECT coalesce(lang, 'und') AS lang,
                      regexp_extract_all(unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w
               FROM documents),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM piece GROUP BY 1),
gram AS MATERIALIZED (SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase, count(*) AS f
         FROM piece, range(1, 6) AS t(m), unnest(range(1, greatest(0, len(w) - m + 1) + 1)) AS r(i) GROUP BY ALL HAVING count(*) >= 100),
cand AS MATERIALIZED (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM gram WHERE m > 1),
cut AS (SELECT c.lang, c.m, c.phrase, a, l.f AS l, r.f AS r, n, k, (1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS score
        FROM cand c JOIN total USING (lang), unnest(range(1, c.m)) AS t(k)
        JOIN gram l ON l.lang = c.lang AND l.m = k AND l.phrase = array_to_string(w[1 : k], ' ')
        JOIN gram r ON r.lang = c.lang AND r.m = c.m - k AND r.phrase = array_to_string(w[k + 1 :], ' ')),
least AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
free AS (SELECT * FROM least p WHERE NOT EXISTS (SELECT 1 FROM cand q WHERE q.lang = p.lang AND q.m > p.m AND 100 * q.a >= 100 * p.a
                                                 AND contains(' ' || q.phrase || ' ', ' ' || p.phrase || ' ')))
SELECT lang, row_number() OVER g AS rank, phrase, a, l, r, n, score::BIGINT AS score FROM free
WINDOW g AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) QUALIFY rank <= 2000"""

ORACLE = {"op2_sharding": sharding_sql(), "op3_exact_dedup": EXACT, "op4_decontamination": DECONTAMINATION,
          "op8_substring_dedup": SUBSTRING, "op9_ngram_jaccard_join": JACCARD, "op11_vector_code": vector_code_sql(),
          "op12_line_dedup": LINES, "op13_collocations": COLLOCATIONS}
