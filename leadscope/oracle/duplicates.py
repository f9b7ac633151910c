"""DuckDB oracle SQL of DOC-1: links by equal keys and by all pairs of distinct texts, then what they reach."""

from ..sources.fixtures import with_ctes

# Syntax of e-mails and phones (SURVEY's stand-ins for the external validators).
EMAIL = (r"[A-Za-z0-9!#$%&''*+/=?^_{|}~-]+(\.[A-Za-z0-9!#$%&''*+/=?^_{|}~-]+)*@([A-Za-z0-9]([A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}")

DOC1 = with_ctes(rf"""
WITH RECURSIVE p AS (
  SELECT Id AS lead, CASE WHEN regexp_full_match(trim(Email), '{EMAIL}') THEN lower(trim(Email)) END AS email,
         CASE WHEN regexp_full_match(trim(Phone), '[0-9()+.\- ]+') AND regexp_full_match(regexp_replace(Phone, '[^0-9]', '', 'g'), '1?[2-9][0-9]{{2}}[2-9][0-9]{{6}}')
              THEN right(regexp_replace(Phone, '[^0-9]', '', 'g'), 10) END AS phone,
         CASE WHEN trim(FirstName) <> '' AND trim(LastName) <> '' AND trim(Company) <> ''
              THEN '  ' || regexp_replace(lower(trim(FirstName) || ' ' || trim(LastName) || ' ' || trim(Company)), '\s+', ' ', 'g') || ' ' END AS text
  FROM leads),
t AS (SELECT text, min(lead) AS node, list_distinct(list_transform(range(1, length(text) - 1), lambda i: substring(text, i, 3))) AS grams
      FROM p WHERE text IS NOT NULL GROUP BY text),
alike AS (SELECT x.node AS a, y.node AS b FROM t x JOIN t y ON x.node < y.node
          WHERE len(list_intersect(x.grams, y.grams)) / (len(x.grams) + len(y.grams) - len(list_intersect(x.grams, y.grams))) >= 0.85),
star AS (SELECT a, b FROM alike
         UNION SELECT min(lead) OVER (PARTITION BY email), lead FROM p WHERE email IS NOT NULL
         UNION SELECT min(lead) OVER (PARTITION BY phone), lead FROM p WHERE phone IS NOT NULL
         UNION SELECT min(lead) OVER (PARTITION BY text), lead FROM p WHERE text IS NOT NULL),
both_ways AS (SELECT a, b FROM star WHERE a <> b UNION SELECT b, a FROM star WHERE a <> b),
reach AS (SELECT lead AS a, lead AS b FROM p UNION SELECT reach.a, w.b FROM reach JOIN both_ways w ON reach.b = w.a),
c AS (SELECT a AS lead_id, min(b) AS cluster_id FROM reach GROUP BY a)
SELECT lead_id, cluster_id, count(*) OVER (PARTITION BY cluster_id) AS cluster_size, lead_id <> cluster_id AS is_duplicate FROM c
""", "leads")

ORACLE = {"doc1_lead_clusters": DOC1}
