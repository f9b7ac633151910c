"""DuckDB oracle SQL of DOC-3, DOC-4, DOC-6 and of AGG-12's lists in pieces."""

from ..sources.fixtures import with_ctes
from .rules import ORACLE as RULES

DOC3 = with_ctes("SELECT task_id, created_date FROM pv WHERE created_date IS NULL OR date_diff('day', CAST(created_date AS DATE), DATE '2001-08-01') <= 90", "pv")

DOC4 = f"SELECT lead_id, completeness_score, COALESCE(completeness_score >= 0.7, FALSE) AS meets_minimum FROM ({RULES['val7_completeness']}) c"

DOC6 = with_ctes("""
SELECT hour, count(*) AS total_leads, count(*) FILTER (WHERE fake) AS fake_leads, count(DISTINCT source) AS sources,
       round(100.0 * count(*) FILTER (WHERE fake) / count(*), 2) AS fake_percentage
FROM (SELECT extract(hour FROM created_date) AS hour, api_fake_lead IS TRUE AS fake, COALESCE(lead_source, 'Unknown') AS source
      FROM pv WHERE parse_error IS NULL AND created_date IS NOT NULL) h
GROUP BY hour
""", "pv")

CHUNKS = with_ctes("""
WITH fakes AS (
  SELECT date_trunc('day', created_date) AS day, COALESCE(lead_source, 'Unknown') AS lead_source, task_id,
         concat(api_first_name, ' ', api_last_name, ' (', task_id, ')') AS label
  FROM pv WHERE parse_error IS NULL AND api_fake_lead AND task_id IS NOT NULL),
numbered AS (SELECT *, (row_number() OVER (PARTITION BY day, lead_source ORDER BY task_id) - 1) // 5 AS chunk FROM fakes)
SELECT day, lead_source, chunk, count(*) AS n, string_agg(label, '; ' ORDER BY task_id) AS fake_leads FROM numbered GROUP BY ALL
""", "pv")

ORACLE = {"doc3_retained": DOC3, "doc4_completeness": DOC4, "doc6_hourly_fraud": DOC6, "agg12_list_chunks": CHUNKS}
