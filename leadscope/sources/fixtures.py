"""Adapters that derive the lead tables from the TPC-H-style test data.

Each adapter is a list of ``(column, SQL expression, type)`` triples written in
the common subset of Spark SQL and DuckDB SQL, so one definition feeds both the
Spark DataFrame (``selectExpr``) and the oracle's leading CTE. The base
relation joins are plain equi-joins: the optimizer broadcasts ``nation``
(25 rows) and picks broadcast or sort-merge for ``customer`` from statistics,
so the adapters scale with ``orders``/``events``.

Fixed values: the expressions below are the fixture definitions
(FIXTURES.md sections 4-6) and must stay literally as written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# pv and vr report dates (the maximum order date / the end of the events month).
PV_AS_OF = "2001-08-01"
VR_AS_OF = "2024-01-31"

_SPARK_TYPES = {"string": "STRING", "int": "INT", "boolean": "BOOLEAN",
                "double": "DOUBLE", "timestamp": "TIMESTAMP_NTZ"}
_DUCK_TYPES = {"string": "VARCHAR", "int": "INTEGER", "boolean": "BOOLEAN",
               "double": "DOUBLE", "timestamp": "TIMESTAMP"}

# ---- pv: orders o JOIN customer c JOIN nation n; k = o_orderkey, g = c_nationkey
PV_COLUMNS: list[tuple[str, str | None, str]] = [
    ("task_id", "concat('T', CAST(k AS STRING))", "string"),
    ("who_id", "concat('L', CAST(o_custkey AS STRING))", "string"),
    ("lead_source", "CASE WHEN k % 17 = 0 THEN NULL ELSE n_name END", "string"),
    ("lead_score", "CAST(k % 11 AS INT)", "int"),
    ("quality_score", "CAST(k % 11 AS INT)", "int"),
    ("data_quality", "CAST((k % 11) * 10 AS INT)", "int"),
    ("fraud_score", "CAST(k % 9 AS INT)", "int"),
    ("recommendation", "CASE k % 4 WHEN 0 THEN 'accept' WHEN 1 THEN 'Review' WHEN 2 THEN 'REJECT' ELSE NULL END", "string"),
    ("quality_level", None, "string"),
    ("fraud_risk", None, "string"),
    ("market_segment", None, "string"),
    ("phone_valid", "k % 3 = 0", "boolean"),
    ("phone_carrier", None, "string"),
    ("phone_type", None, "string"),
    ("phone_national_format", None, "string"),
    ("email_valid", "k % 4 <> 0", "boolean"),
    ("email_sendable", "k % 5 <> 0", "boolean"),
    ("bounce_likely", "k % 8 = 0", "boolean"),
    ("gibberish_score", None, "string"),
    ("total_emails", None, "int"),
    ("valid_emails", None, "int"),
    ("sendable_emails", None, "int"),
    ("email_quality_score", None, "int"),
    ("api_lead_score", "CAST(CASE WHEN k % 13 = 0 THEN NULL ELSE (k * 3) % 11 END AS INT)", "int"),
    ("api_quality_score", "CAST(CASE WHEN k % 5 = 0 THEN NULL ELSE greatest(0, least(10, 11 - g % 12 + k % 3 - 1)) END AS INT)", "int"),
    ("api_fraud_score", "CAST(CASE WHEN k % 7 = 0 THEN NULL ELSE least(10, k % 5 + g % 8) END AS INT)", "int"),
    ("api_data_quality_score", "CAST(CASE WHEN k % 6 = 0 THEN NULL ELSE (k + g) % 11 END AS INT)", "int"),
    ("api_business_strength_score", "CAST(CAST(floor(o_totalprice / 60000) AS INT) % 11 AS INT)", "int"),
    ("api_recommendation", "CASE k % 5 WHEN 0 THEN 'accept' WHEN 1 THEN 'reject' WHEN 2 THEN 'review' WHEN 3 THEN 'Accept' ELSE NULL END", "string"),
    ("api_quality_level", None, "string"),
    ("api_fraud_risk_level", None, "string"),
    ("api_market_segment", None, "string"),
    ("api_phone_valid", "CASE WHEN k % 3 = 2 THEN NULL ELSE k % 6 <> 3 END", "boolean"),
    ("api_email_valid", "CASE WHEN k % 3 = 0 THEN NULL ELSE k % 4 <> 1 END", "boolean"),
    ("api_email_sendable", "CASE WHEN k % 3 = 1 THEN NULL ELSE k % 5 <> 2 END", "boolean"),
    ("api_bounce_likely", "CASE WHEN k % 2 = 0 THEN NULL ELSE k % 15 = 0 END", "boolean"),
    ("api_gibberish_email", "k % 31 = 0", "boolean"),
    ("api_fake_phone", "k % 21 = 0", "boolean"),
    ("api_fake_lead", "CASE WHEN k % 19 = 0 THEN NULL ELSE k % 100 < (g % 9) * 8 - 8 END", "boolean"),
    ("api_disposable_email", "k % 22 = 0", "boolean"),
    ("api_phone_carrier", None, "string"),
    ("api_phone_location", None, "string"),
    ("api_first_name", "CASE WHEN k % 12 = 0 THEN NULL ELSE concat('First', CAST(k % 40 AS STRING)) END", "string"),
    ("api_last_name", "concat('Last', CAST(c_custkey % 60 AS STRING))", "string"),
    ("api_company", "CASE WHEN k % 14 = 0 THEN NULL ELSE concat(c_mktsegment, ' LLC') END", "string"),
    ("api_email", "CASE WHEN k % 10 = 0 THEN NULL ELSE concat('first', CAST(k % 40 AS STRING), '@site', CAST(g AS STRING), '.com') END", "string"),
    ("api_phone", "CASE WHEN k % 9 = 0 THEN NULL ELSE concat('(212) 555-', lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')) END", "string"),
    ("api_state", None, "string"),
    ("api_postal_code", None, "string"),
    ("api_total_emails", None, "int"),
    ("api_valid_emails", None, "int"),
    ("api_sendable_emails", None, "int"),
    ("api_email_summary_quality_score", None, "int"),
    ("api_quality_factors", "CASE WHEN k % 3 = 0 THEN 'Valid email format, Valid phone number, ZIP/state consistent, Data completeness (5/7)' ELSE NULL END", "string"),
    ("api_fraud_factors", "CASE WHEN k % 4 = 0 THEN 'Known fake lead from database, ML fraud model: HIGH RISK score: 87' WHEN k % 4 = 1 THEN 'Email not deliverable, Invalid phone' ELSE NULL END", "string"),
    ("api_summary_notes", None, "string"),
    ("lead_company", "c_name", "string"),
    ("lead_email", "concat('lead', CAST(c_custkey AS STRING), '@corp.example')", "string"),
    ("subject", None, "string"),
    ("parse_error", "CASE WHEN k % 50 = 49 THEN 'bad json' ELSE NULL END", "string"),
    ("raw_api_response", "concat('{\"leadStatus\":', CASE WHEN k % 2 = 0 THEN '\"Qualified\"' ELSE 'null' END, ',\"status\":\"Open\",\"hasGibberishNames\":', CASE WHEN k % 25 = 0 THEN 'true' ELSE 'false' END, '}')", "string"),
    ("raw_description", None, "string"),
    ("created_date", "o_orderdate + INTERVAL '1' HOUR * CAST(k % 24 AS INT)", "timestamp"),
    ("last_modified_date", None, "timestamp"),
    ("parsed_at", "o_orderdate + INTERVAL '1' DAY * CAST(k % 3 AS INT)", "timestamp"),
]

# ---- vr: events
VR_COLUMNS: list[tuple[str, str | None, str]] = [
    ("lead_id", "concat('L', CAST(user_id AS STRING))", "string"),
    ("validation_timestamp", "ts", "timestamp"),
    ("overall_score", "least(CAST(1.0 AS DOUBLE), value / CAST(100.0 AS DOUBLE)) * CAST(0.7 AS DOUBLE) + (CAST(1.0 AS DOUBLE) - CAST(event_id % 11 AS DOUBLE) / 10) * CAST(0.3 AS DOUBLE)", "double"),
    ("data_quality_score", "least(CAST(1.0 AS DOUBLE), value / CAST(100.0 AS DOUBLE))", "double"),
    ("fraud_score", "CAST(event_id % 11 AS DOUBLE) / 10", "double"),
    ("validation_status", None, "string"),  # derived below from overall_score
    ("validation_details", "concat('{\"email\":{\"score\":', CAST(CAST(event_id % 10 AS DOUBLE) / 10 AS STRING), '},\"phone\":{\"score\":', CAST(CAST(event_id % 7 AS DOUBLE) / 10 AS STRING), '}}')", "string"),
    ("first_name", None, "string"),
    ("last_name", None, "string"),
    ("email", None, "string"),
    ("phone", None, "string"),
    ("company", None, "string"),
    ("status", None, "string"),
    ("lead_source", "CASE WHEN event_id % 23 = 0 THEN NULL ELSE event_type END", "string"),
    ("created_date", "ts - INTERVAL '1' DAY * CAST(user_id % 90 AS INT)", "timestamp"),
    ("last_modified_date", None, "timestamp"),
    ("converted_date", "CASE WHEN event_type = 'purchase' AND event_id % 2 = 0 THEN ts ELSE NULL END", "timestamp"),
    ("is_converted", "event_type = 'purchase'", "boolean"),
    ("event_id", "event_id", "bigint"),  # tie-break for latest-per-lead
]
_VR_STATUS = ("CASE WHEN overall_score >= 0.9 THEN 'Excellent' WHEN overall_score >= 0.8 THEN 'Good' "
              "WHEN overall_score >= 0.6 THEN 'Fair' WHEN overall_score >= 0.4 THEN 'Poor' ELSE 'Invalid' END")

# ---- leads: customer JOIN nation; k = c_custkey
LEADS_COLUMNS: list[tuple[str, str | None, str]] = [
    ("Id", "concat('L', CAST(k AS STRING))", "string"),
    ("FirstName", "CASE k % 9 WHEN 0 THEN 'Test' WHEN 1 THEN 'J' WHEN 2 THEN 'Smith' WHEN 3 THEN NULL WHEN 4 THEN 'Alice' ELSE concat('Anna', CAST(k % 7 AS STRING)) END", "string"),
    ("LastName", "CASE WHEN k % 11 = 0 THEN NULL ELSE 'Smith' END", "string"),
    ("Email", "CASE k % 10 WHEN 0 THEN 'test.user@corp.com' WHEN 1 THEN 'bob@mailinator.com' WHEN 2 THEN 'a12345678@yopmail.com' WHEN 3 THEN 'alice.smith@gmial.com' WHEN 4 THEN NULL WHEN 5 THEN 'not-an-email' WHEN 6 THEN 'smith@gmail.com' WHEN 7 THEN 'qa12345678@corp.com' WHEN 8 THEN 'x@temp-mail.org' ELSE concat('u', CAST(k AS STRING), '@corp.com') END", "string"),
    ("Phone", "CASE k % 8 WHEN 0 THEN '(123) 456-7890' WHEN 1 THEN '555-555-5555' WHEN 2 THEN '1212121212' WHEN 3 THEN '0123456789' WHEN 4 THEN NULL WHEN 5 THEN '12345' ELSE concat('212555', lpad(CAST(k % 10000 AS STRING), 4, '0')) END", "string"),
    ("Company", "CASE k % 7 WHEN 0 THEN 'LLC' WHEN 1 THEN 'X' WHEN 2 THEN NULL WHEN 3 THEN 'none' ELSE concat(c_mktsegment, '  HOLDINGS') END", "string"),
    ("Status", "'Open'", "string"),
    ("Title", "CASE WHEN k % 2 = 0 THEN 'CEO' ELSE '' END", "string"),
    ("Industry", "c_mktsegment", "string"),
    ("LeadSource", "CASE WHEN k % 5 = 0 THEN NULL ELSE n_name END", "string"),
    ("City", "'tbd'", "string"),
    ("State", "CASE WHEN k % 3 = 0 THEN 'NY' ELSE NULL END", "string"),
    ("Country", "'US'", "string"),
]


def _render(columns, engine: str) -> list[str]:
    types = _SPARK_TYPES if engine == "spark" else _DUCK_TYPES
    out = []
    for name, expr, typ in columns:
        t = types.get(typ, typ.upper())
        body = f"CAST(NULL AS {t})" if expr is None else f"CAST({expr} AS {t})"
        out.append(f"{body} AS {name}")
    return out


# ---------------------------------------------------------------- Spark side

def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``parsed_validations`` (65 columns) derived from orders/customer/nation."""
    o = _read(spark, sf_dir, "orders")
    c = _read(spark, sf_dir, "customer")
    n = _read(spark, sf_dir, "nation")
    base = (o.join(c, o.o_custkey == c.c_custkey)
             .join(n, c.c_nationkey == n.n_nationkey)
             .withColumn("k", F.col("o_orderkey"))
             .withColumn("g", F.col("c_nationkey")))
    return base.selectExpr(*_render(PV_COLUMNS, "spark"))


def vr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``validation_results`` (0-1 doubles) derived from events."""
    e = _read(spark, sf_dir, "events")
    out = e.selectExpr(*_render(VR_COLUMNS, "spark"))
    return out.withColumn("validation_status", F.expr(_VR_STATUS))


def leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lead records (13 strings) derived from customer/nation."""
    c = _read(spark, sf_dir, "customer")
    n = _read(spark, sf_dir, "nation")
    base = c.join(n, c.c_nationkey == n.n_nationkey).withColumn("k", F.col("c_custkey"))
    return base.selectExpr(*_render(LEADS_COLUMNS, "spark"))


# ---------------------------------------------------------------- SQL side

def pv_sql() -> str:
    cols = ",\n    ".join(_render(PV_COLUMNS, "duckdb"))
    return ("SELECT\n    " + cols + "\nFROM (SELECT o.*, c.*, n.*, o.o_orderkey AS k, c.c_nationkey AS g\n"
            "      FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey\n"
            "      JOIN nation n ON c.c_nationkey = n.n_nationkey) base")


def vr_sql() -> str:
    cols = ",\n    ".join(c for c in _render(VR_COLUMNS, "duckdb") if not c.endswith(" AS validation_status"))
    return f"SELECT *, {_VR_STATUS} AS validation_status FROM (SELECT\n    {cols}\nFROM events) ev"


def leads_sql() -> str:
    cols = ",\n    ".join(_render(LEADS_COLUMNS, "duckdb"))
    return ("SELECT\n    " + cols + "\nFROM (SELECT c.*, n.*, c.c_custkey AS k FROM customer c\n"
            "      JOIN nation n ON c.c_nationkey = n.n_nationkey) base")


def with_ctes(body: str, *names: str) -> str:
    """Prefix ``body`` with the adapter CTEs it reads (``pv``, ``vr``, ``leads``)."""
    src = {"pv": pv_sql, "vr": vr_sql, "leads": leads_sql}
    ctes = ",\n".join(f"{n} AS (\n{src[n]()}\n)" for n in names)
    body = body.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
