import pytest
from pyspark.sql import functions as F

from leadscope.functions.text import fuzzy_ratio, lcs_length
from leadscope.operators import fraud, rules

LEAD_COLS = ["Id", "FirstName", "LastName", "Email", "Phone", "Company", "Status", "Title", "Industry",
             "LeadSource", "City", "State", "Country"]


def _lcs(a, b):
    prev = [0] * (len(b) + 1)
    for ca in a:
        cur = [0]
        for j, cb in enumerate(b, 1):
            cur.append(prev[j - 1] + 1 if ca == cb else max(prev[j], cur[j - 1]))
        prev = cur
    return prev[-1]


def test_lcs_and_ratio_against_bruteforce(spark):
    pairs = [("gmial.com", "gmail.com"), ("corp.com", "gmail.com"), ("yahoo.co", "yahoo.com"), ("", "x"),
             ("hotmial.com", "hotmail.com"), ("outlook.com", "outlook.com"), ("abc", "xyz"), ("a", "a")]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = df.select("a", "b", lcs_length("a", "b").alias("l"), fuzzy_ratio("a", "b").alias("r")).collect()
    for row in got:
        assert row.l == _lcs(row.a, row.b)
        t = len(row.a) + len(row.b)
        exp = 0 if t == 0 or not row.a or not row.b else round(100 * (2 * _lcs(row.a, row.b) / t))
        assert row.r == exp, row


def _lead(**kw):
    base = dict.fromkeys(LEAD_COLS)
    base.update(kw)
    return tuple(base[c] for c in LEAD_COLS)


def _run(spark, fn, **kw):
    df = spark.createDataFrame([_lead(Id="L1", **kw)], ", ".join(f"{c} string" for c in LEAD_COLS))
    return fn(df).collect()[0]


@pytest.mark.parametrize("email,score", [
    ("test.user@corp.com", 1.0), ("bob@mailinator.com", 1.0), ("x@yopmail.com", 0.9),
    ("a12345678@corp.com", 0.6), ("q@temp-mail.org", 0.9), ("fine@corp.com", 0.0), (None, 0.0)])
def test_email_fraud_indicator(spark, email, score):
    assert _run(spark, fraud.fraud_scores, Email=email).fraud_email_score == score


@pytest.mark.parametrize("phone,score", [
    ("(123) 456-7890", 1.0), ("555-555-5555", 1.0), ("1212121212", 0.9), ("0123456789", 0.95),
    ("2125550123", 0.0), ("", 0.0)])
def test_phone_fraud_indicator(spark, phone, score):
    assert _run(spark, fraud.fraud_scores, Phone=phone).fraud_phone_score == score


def test_max_reachable_fraud_score(spark):
    r = _run(spark, fraud.fraud_scores, FirstName="Test", LastName="test", Email="test@x.com",
             Phone="0000000000", Company="LLC")
    # email 1.0*.3 + phone 1.0*.25 + name .8*.2 + company .6*.15 + consistency 0 (names in email)
    assert r.fraud_score == pytest.approx(0.3 + 0.25 + 0.16 + 0.09)
    r2 = _run(spark, fraud.fraud_scores, FirstName="Test", LastName="Doe", Email="testx@mailinator.com",
              Phone="0000000000", Company="llc")
    assert r2.is_likely_fake and r2.risk_level in {"CRITICAL", "HIGH"}


def test_name_company_completeness_rules(spark):
    r = _run(spark, rules.validate_leads, FirstName="J", LastName="Smith", Company="none", Email="j@gmial.com",
             Phone="2125550123", Status="Open", City="tbd")
    assert r.name_score == 0.75 and not r.name_valid
    assert r.company_score == pytest.approx(0.8 * 0.3) and not r.company_valid
    assert r.email_valid and r.email_score == pytest.approx(0.8)
    assert any("gmail.com" in x for x in r.email_issues)
    assert r.required_fields_filled == 6 and r.important_fields_filled == 1
    assert r.phone_valid and r.phone_e164 == "+12125550123" and r.phone_national == "(212) 555-0123"
    assert r.lint_checks == 8 and r.lint_issue_count == 2   # 'none' and 'tbd' placeholders
    assert r.validation_status in {"Excellent", "Good", "Fair", "Poor", "Invalid"}


def test_rules_empty_lead(spark):
    r = _run(spark, rules.validate_leads)
    assert r.email_score == 0.0 and "Email is required" in r.email_issues
    assert r.name_score == 0.0 and r.company_score == 0.0 and r.completeness_score == 0.0
    assert r.lint_score == 1.0 and r.fraud_score == 0.0


def test_line_types_and_issue_counts_without_a_shuffle(spark):
    from leadscope.operators import rules as ru
    from pyspark.sql import functions as F
    v = spark.createDataFrame([("a", "+18005551234"), ("b", "+19005551234"), ("c", "+15215551234"), ("d", "+12125551234"), ("e", None)],
                              "Id string, phone_e164 string")
    got = {r.lead_id: (r.phone_line_type, r.is_mobile) for r in ru.line_types(v).collect()}
    assert got == {"a": ("toll_free", False), "b": ("premium_rate", False), "c": ("personal_number", False),
                   "d": ("fixed_line_or_mobile", False), "e": (None, None)}
    kinds = ("email", "phone", "name", "company", "completeness", "lint")
    issues = spark.range(1).select(F.lit("a").alias("Id"), *[F.array().cast("array<string>").alias(f"{k}_issues") for k in kinds[2:]],
                                   F.array(F.lit("x"), F.lit("y")).alias("email_issues"),
                                   F.lit(None).cast("array<string>").alias("phone_issues"))
    long = ru.issues_long(issues)
    assert sorted((r.check, r.issue, r.n_in_check) for r in long.collect()) == [("email", "x", 2), ("email", "y", 2)]
    assert "Exchange" not in long._jdf.queryExecution().executedPlan().toString()
