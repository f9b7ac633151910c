"""DuckDB oracle SQL for the rule engine (VAL-*) and fraud engine (FRD-*).

A single CTE chain computes every check per lead in plain SQL; the domain-typo
ratio uses a recursive CTE for the LCS dynamic program over distinct domains.
"""

from ..operators import fraud as FR
from ..operators import rules as RU
from ..sources.fixtures import with_ctes


def _lst(xs):
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in xs) + "]"


def _strip(x):
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _truthy(x):
    return f"COALESCE(length({x}) > 0, FALSE)"


def _filled(x):
    return f"COALESCE(length({_strip(x)}) > 0, FALSE)"


def _compact(items):
    return "list_filter([" + ", ".join(items) + "], lambda x: x IS NOT NULL)"


def _when(c, m):
    return f"CASE WHEN {c} THEN {m} END"


LEAD_FIELDS = ["Id", "FirstName", "LastName", "Email", "Phone", "Company", "Status", "Title", "Industry",
               "LeadSource", "City", "State", "Country"]

_common = ", ".join(f"('{d}', {i})" for i, d in enumerate(RU.COMMON_DOMAINS, 1))

_lint_checks = " + ".join(f"CASE WHEN {_truthy(f)} THEN 1 ELSE 0 END" for f in LEAD_FIELDS)
_lint_ph = {f: f"({_truthy(f)} AND list_contains({_lst(RU.PLACEHOLDERS)}, {_strip(f'lower({f})')}))" for f in LEAD_FIELDS}
_lint_caps = {f: f"({_truthy(f)} AND {f} = upper({f}) AND {f} <> lower({f}) AND length({f}) > 10)" for f in LEAD_FIELDS}
_lint_sp = {f: f"({_truthy(f)} AND contains({f}, '  '))" for f in LEAD_FIELDS}
_lint_bad = " + ".join(f"CAST({d[f]} AS INT)" for f in LEAD_FIELDS for d in (_lint_ph, _lint_caps, _lint_sp))
_lint_issues = _compact([_when(_lint_ph[f], f"'Placeholder value in {f}: ' || {f}") for f in LEAD_FIELDS]
                        + [x for f in LEAD_FIELDS for x in (_when(_lint_caps[f], f"'All caps formatting in {f}'"),
                                                            _when(_lint_sp[f], f"'Multiple spaces in {f}'"))])

_req = [(f, _filled(f)) for f in RU.REQUIRED_FIELDS]
_imp = [(f, _filled(f)) for f in RU.IMPORTANT_FIELDS]

BASE = rf"""
WITH RECURSIVE lx AS (SELECT *, lower(string_split(Email, '@')[2]) AS dom FROM leads),
pairs AS (
  SELECT d.a, c.b, c.ord FROM (SELECT DISTINCT dom AS a FROM lx WHERE dom IS NOT NULL) d,
  (VALUES {_common}) c(b, ord)
),
dp(a, b, ord, k, prev, cur) AS (
  SELECT a, b, ord, 0, list_transform(range(length(b) + 1), lambda x: 0), [0] FROM pairs
  UNION ALL
  SELECT a, b, ord, k + 1,
    CASE WHEN j = length(b) THEN newcur ELSE prev END,
    CASE WHEN j = length(b) THEN [0] ELSE newcur END
  FROM (SELECT a, b, ord, k, prev, cur, j,
          list_append(cur, CASE WHEN substr(a, i, 1) = substr(b, j, 1) THEN prev[j] + 1
                                ELSE greatest(prev[j + 1], cur[j]) END) AS newcur
        FROM (SELECT *, k // length(b) + 1 AS i, k % length(b) + 1 AS j FROM dp
              WHERE k < length(a) * length(b)) s1) s2
),
ratio AS (
  SELECT a, b, ord,
    CASE WHEN length(a) + length(b) = 0 THEN 0
         ELSE CAST(round_even(CAST(2 * prev[length(b) + 1] AS DOUBLE) / (length(a) + length(b)) * 100, 0) AS INT) END AS r
  FROM dp WHERE k = length(a) * length(b)
),
typo AS (SELECT a AS dom, arg_min(b, ord) AS typo FROM ratio WHERE r >= 60 AND r < 90 GROUP BY a),
s1 AS (
  SELECT lx.*, typo.typo,
    {_truthy('Email')} AS e_present,
    {_truthy('Email')} AND COALESCE(regexp_matches(Email, '{RU.EMAIL_SYNTAX.replace("'", "''")}'), FALSE) AS email_valid,
    length(Email) - length(replace(Email, '@', '')) <> 1 AS multi_at,
    lower(Email) AS el, COALESCE(lower(string_split(Email, '@')[2]), '') AS edom,
    {_truthy('Phone')} AS p_present, regexp_replace(Phone, '[^0-9]', '', 'g') AS pd,
    {_strip('FirstName')} AS fs_, {_strip('LastName')} AS ls_,
    {_truthy('Company')} AS c_present, {_strip('Company')} AS cclean
  FROM lx LEFT JOIN typo ON lx.dom = typo.dom
),
s2 AS (
  SELECT *,
    -- VAL-2
    CASE WHEN email_valid THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
      * CASE WHEN email_valid AND multi_at THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END
      * CASE WHEN email_valid AND typo IS NOT NULL THEN 0.8::DOUBLE ELSE 1.0::DOUBLE END AS email_score,
    {_compact([_when('NOT e_present', "'Email is required'"),
               _when('e_present AND NOT email_valid', "'Invalid email format'"),
               _when('email_valid AND multi_at', "'Multiple @ symbols'"),
               _when('email_valid AND typo IS NOT NULL', "'Possible domain typo: ' || typo")])} AS email_issues,
    -- VAL-4
    p_present AND COALESCE(regexp_matches(Phone, '{RU.PHONE_CHARS}'), FALSE)
      AND COALESCE(regexp_matches(pd, '{RU.NANP}'), FALSE) AS phone_valid,
    -- VAL-5 parts
    NOT {_truthy('FirstName')} OR COALESCE(length(fs_), 0) < 1 AS fmiss,
    NOT {_truthy('LastName')} OR COALESCE(length(ls_), 0) < 1 AS lmiss,
    {_truthy('FirstName')} AND {_truthy('LastName')}
      AND len(list_filter({_lst(RU.NAME_SUSPICIOUS)}, lambda p: contains(lower(FirstName || ' ' || LastName), p))) > 0
      AS name_sus,
    -- VAL-6
    length(cclean) < 2 AS c_short, list_contains({_lst(RU.COMPANY_SUSPICIOUS)}, lower(cclean)) AS c_sus,
    -- VAL-7
    {" + ".join(f"CAST({e} AS INT)" for _, e in _req)} AS required_fields_filled,
    {" + ".join(f"CAST({e} AS INT)" for _, e in _imp)} AS important_fields_filled,
    {_compact([_when(f"NOT {e}", f"'Missing required field: {f}'") for f, e in _req])} AS completeness_issues,
    -- VAL-8
    {_lint_checks} AS lint_checks, {_lint_bad} AS lint_issue_count, {_lint_issues} AS lint_issues
  FROM s1
),
s3 AS (
  SELECT *,
    CASE WHEN phone_valid THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS phone_score,
    {_compact([_when('NOT p_present', "'Phone number is required'"),
               _when('p_present AND NOT phone_valid', "'Invalid phone number'")])} AS phone_issues,
    CASE WHEN phone_valid THEN '+1' || right(pd, 10) END AS phone_e164,
    CASE WHEN phone_valid THEN '(' || substr(right(pd, 10), 1, 3) || ') ' || substr(right(pd, 10), 4, 3) || '-'
         || substr(right(pd, 10), 7, 4) END AS phone_national,
    0.0::DOUBLE
      + (CASE WHEN fmiss THEN 0.0 WHEN length(fs_) >= 2 THEN 0.5 ELSE 0.25 END)::DOUBLE
        * (CASE WHEN name_sus THEN 0.5 ELSE 1.0 END)::DOUBLE
      + (CASE WHEN lmiss THEN 0.0 WHEN length(ls_) >= 2 THEN 0.5 ELSE 0.25 END)::DOUBLE
        * (CASE WHEN name_sus THEN 0.5 ELSE 1.0 END)::DOUBLE AS name_score,
    {_compact([_when('fmiss', "'First name is required'"),
               _when('NOT fmiss AND length(fs_) < 2', "'First name too short'"),
               _when('lmiss', "'Last name is required'"),
               _when('NOT lmiss AND length(ls_) < 2', "'Last name too short'"),
               _when('name_sus', "'Suspicious name pattern detected'")])} AS name_issues,
    CASE WHEN NOT c_present THEN 0.0::DOUBLE
         WHEN c_sus THEN (CASE WHEN c_short THEN 0.2 ELSE 0.8 END)::DOUBLE * 0.3::DOUBLE
         ELSE (CASE WHEN c_short THEN 0.2 ELSE 0.8 END)::DOUBLE END AS company_score,
    c_present AND NOT c_short AND NOT c_sus AS company_valid,
    {_compact([_when('NOT c_present', "'Company name is required'"),
               _when('c_present AND c_short', "'Company name too short'"),
               _when('c_present AND c_sus', "'Suspicious company name'")])} AS company_issues,
    CAST(required_fields_filled AS DOUBLE) / 6.0 * 0.7::DOUBLE
      + CAST(important_fields_filled AS DOUBLE) / 6.0 * 0.3::DOUBLE AS completeness_score,
    required_fields_filled + important_fields_filled AS total_fields_filled,
    CASE WHEN lint_checks > 0 THEN greatest(0.0::DOUBLE, 1.0::DOUBLE - CAST(lint_issue_count AS DOUBLE) / lint_checks)
         ELSE 1.0::DOUBLE END AS lint_score,
    -- FRD-2
    COALESCE(regexp_matches(el, '{FR.FAKE_EMAIL_REGEX}'), FALSE) AS fe_fake,
    list_filter({_lst(FR.DISPOSABLE_DOMAINS)}, lambda d: contains(edom, d))[1] AS fe_disp,
    COALESCE(regexp_matches(el, '[0-9]{{8,}}'), FALSE) AS fe_long,
    -- FRD-3
    list_contains({_lst(FR.FAKE_PHONES)}, pd) AS fp_fake,
    CASE WHEN length(pd) = 0 THEN 0 ELSE len(list_distinct(string_split(pd, ''))) END <= 2 AND length(pd) >= 10 AS fp_few,
    list_contains({_lst(FR.SEQUENTIAL_PHONES)}, pd) AS fp_seq,
    -- FRD-4
    {_truthy('FirstName')} AND {_truthy('LastName')} AS fn_present,
    list_filter({_lst(FR.FAKE_NAME_PATTERNS)}, lambda p: contains(lower(FirstName || ' ' || LastName), p))[1] AS fn_hit,
    lower(FirstName) = lower(LastName) AS fn_same,
    length({_strip('FirstName')}) = 1 OR length({_strip('LastName')}) = 1 AS fn_single,
    -- FRD-5
    {_strip('lower(Company)')} AS clow,
    -- FRD-6
    lower(COALESCE(Email, '')) AS ce, lower(COALESCE(FirstName, '')) AS cf, lower(COALESCE(LastName, '')) AS cl
  FROM s2
),
s4 AS (
  SELECT *,
    CASE WHEN NOT e_present THEN 0.0 WHEN fe_fake THEN 1.0
         WHEN fe_long THEN greatest(CASE WHEN fe_disp IS NOT NULL THEN 0.9 ELSE 0.0 END, 0.6)
         ELSE CASE WHEN fe_disp IS NOT NULL THEN 0.9 ELSE 0.0 END END::DOUBLE AS fraud_email_score,
    CASE WHEN NOT p_present THEN 0.0 WHEN fp_fake THEN 1.0 WHEN fp_seq THEN 0.95 WHEN fp_few THEN 0.9
         ELSE 0.0 END::DOUBLE AS fraud_phone_score,
    CASE WHEN NOT fn_present THEN 0.0::DOUBLE ELSE
      greatest(greatest(CASE WHEN fn_hit IS NOT NULL THEN 0.8 ELSE 0.0 END, CASE WHEN fn_same THEN 0.7 ELSE 0.0 END),
               CASE WHEN fn_single THEN 0.5 ELSE 0.0 END)::DOUBLE END AS fraud_name_score,
    CASE WHEN NOT c_present THEN 0.0::DOUBLE ELSE
      greatest(CASE WHEN list_contains({_lst(FR.SUSPICIOUS_COMPANIES)}, clow) THEN 0.6 ELSE 0.0 END,
               CASE WHEN length(clow) <= 2 THEN 0.4 ELSE 0.0 END)::DOUBLE END AS fraud_company_score,
    CASE WHEN length(ce) > 0 AND length(cf) > 0 AND length(cl) > 0 AND NOT contains(ce, cf) AND NOT contains(ce, cl)
         THEN 0.3 ELSE 0.0 END::DOUBLE AS fraud_consistency_score,
    {_compact([_when('e_present AND fe_fake', "'Fake email pattern: ' || Email"),
               _when('e_present AND NOT fe_fake AND fe_disp IS NOT NULL', "'Disposable email domain: ' || edom"),
               _when('e_present AND NOT fe_fake AND fe_long', "'Email contains long number sequence'"),
               _when('p_present AND fp_fake', "'Fake phone pattern: ' || Phone"),
               _when('p_present AND NOT fp_fake AND fp_few', "'Phone has too few unique digits'"),
               _when('p_present AND NOT fp_fake AND fp_seq', "'Sequential phone number pattern'"),
               _when('fn_present AND fn_hit IS NOT NULL', "'Suspicious name pattern: ' || fn_hit"),
               _when('fn_present AND fn_same', "'Identical first and last name'"),
               _when('fn_present AND fn_single', "'Single character name'"),
               _when(f"c_present AND list_contains({_lst(FR.SUSPICIOUS_COMPANIES)}, clow)",
                     "'Generic company name: ' || Company"),
               _when('c_present AND length(clow) <= 2', "'Company name too short'"),
               _when('length(ce) > 0 AND length(cf) > 0 AND length(cl) > 0 AND NOT contains(ce, cf) '
                     'AND NOT contains(ce, cl)', "'Name not reflected in email address'")])} AS fraud_indicators
  FROM s3
),
s5 AS (
  SELECT *,
    0.0::DOUBLE + fraud_email_score * 0.3::DOUBLE + fraud_phone_score * 0.25::DOUBLE
      + fraud_name_score * 0.2::DOUBLE + fraud_company_score * 0.15::DOUBLE
      + fraud_consistency_score * 0.1::DOUBLE AS raw_fraud,
    (0.0::DOUBLE + email_score * 0.3::DOUBLE + phone_score * 0.3::DOUBLE + name_score * 0.15::DOUBLE
      + company_score * 0.1::DOUBLE + completeness_score * 0.15::DOUBLE) / 1.0::DOUBLE AS data_quality_score
  FROM s4
),
rules AS (
  SELECT *, least(raw_fraud, 1.0::DOUBLE) AS fraud_score, raw_fraud >= 0.7 AS is_likely_fake,
    CASE WHEN raw_fraud >= 0.8 THEN 'CRITICAL' WHEN raw_fraud >= 0.6 THEN 'HIGH' WHEN raw_fraud >= 0.4 THEN 'MEDIUM'
         WHEN raw_fraud >= 0.2 THEN 'LOW' ELSE 'MINIMAL' END AS risk_level,
    data_quality_score * 0.7::DOUBLE + (1.0::DOUBLE - least(raw_fraud, 1.0::DOUBLE)) * 0.3::DOUBLE AS overall_score
  FROM s5
)
"""


def _q(select: str) -> str:
    return with_ctes(BASE + select, "leads")


J = " | "


def _j(x):
    return f"array_to_string({x}, '{J}')"


FRD1 = _q(f"""SELECT Id AS lead_id, fraud_email_score, fraud_phone_score, fraud_name_score, fraud_company_score,
  fraud_consistency_score, fraud_score, is_likely_fake, risk_level, {_j('fraud_indicators')} AS fraud_indicators
FROM rules""")

FRD7 = _q("""SELECT risk_level, COUNT(*) AS leads, CAST(SUM(CASE WHEN is_likely_fake THEN 1 ELSE 0 END) AS BIGINT)
  AS likely_fake FROM rules GROUP BY 1""")

VAL2 = _q(f"SELECT Id AS lead_id, email_valid, email_score, {_j('email_issues')} AS email_issues FROM rules")
VAL3 = _q("SELECT dom AS domain, typo FROM (SELECT DISTINCT dom, typo FROM rules WHERE dom IS NOT NULL) t")
VAL4 = _q(f"""SELECT Id AS lead_id, phone_valid, phone_score, phone_e164, phone_national,
  {_j('phone_issues')} AS phone_issues FROM rules""")
VAL4_LINE = _q("""SELECT Id AS lead_id, kind AS phone_line_type, kind = 'mobile' AS is_mobile, kind = 'fixed_line' AS is_landline
FROM (SELECT Id, CASE WHEN phone_e164 IS NULL THEN NULL
    WHEN regexp_matches(phone_e164, '^.1(800|833|844|855|866|877|888)') THEN 'toll_free'
    WHEN regexp_matches(phone_e164, '^.1900') THEN 'premium_rate'
    WHEN regexp_matches(phone_e164, '^.15(00|21|22|33|44|66|77|88)') THEN 'personal_number'
    ELSE 'fixed_line_or_mobile' END AS kind FROM rules) kinds""")
VAL5 = _q(f"SELECT Id AS lead_id, name_score, name_score >= 0.8 AS name_valid, {_j('name_issues')} AS name_issues FROM rules")
VAL6 = _q(f"SELECT Id AS lead_id, company_score, company_valid, {_j('company_issues')} AS company_issues FROM rules")
VAL7 = _q(f"""SELECT Id AS lead_id, completeness_score, required_fields_filled, important_fields_filled,
  total_fields_filled, {_j('completeness_issues')} AS completeness_issues FROM rules""")
VAL8 = _q(f"""SELECT Id AS lead_id, lint_score, lint_checks, lint_issue_count, {_j('lint_issues')} AS lint_issues
FROM rules""")
VAL9 = _q("SELECT Id AS lead_id, data_quality_score FROM rules")
VAL11 = _q("""SELECT Id AS lead_id, data_quality_score, fraud_score, overall_score,
  CASE WHEN overall_score >= 0.9 THEN 'Excellent' WHEN overall_score >= 0.8 THEN 'Good'
       WHEN overall_score >= 0.6 THEN 'Fair' WHEN overall_score >= 0.4 THEN 'Poor' ELSE 'Invalid' END
    AS validation_status FROM rules""")
VAL13 = _q("""SELECT lead_id, "check", issue, COUNT(*) OVER (PARTITION BY lead_id, "check") AS n_in_check FROM (
  SELECT Id AS lead_id, 'email' AS "check", unnest(email_issues) AS issue FROM rules
  UNION ALL SELECT Id, 'phone', unnest(phone_issues) FROM rules
  UNION ALL SELECT Id, 'name', unnest(name_issues) FROM rules
  UNION ALL SELECT Id, 'company', unnest(company_issues) FROM rules
  UNION ALL SELECT Id, 'completeness', unnest(completeness_issues) FROM rules
  UNION ALL SELECT Id, 'data_quality', unnest(lint_issues) FROM rules) u""")

ORACLE = {
    "frd1_scores": FRD1, "frd7_levels": FRD7,
    "val2_email": VAL2, "val3_domain_typos": VAL3, "val4_phone": VAL4, "val4_line_type": VAL4_LINE, "val5_name": VAL5,
    "val6_company": VAL6, "val7_completeness": VAL7, "val8_data_quality": VAL8,
    "val9_quality_score": VAL9, "val11_status": VAL11, "val13_issues": VAL13,
}

VAL12 = _q(f"""SELECT Id AS lead_id, TIMESTAMP '2024-01-31 00:00:00' AS validation_timestamp, overall_score,
  data_quality_score, fraud_score,
  CASE WHEN overall_score >= 0.9 THEN 'Excellent' WHEN overall_score >= 0.8 THEN 'Good'
       WHEN overall_score >= 0.6 THEN 'Fair' WHEN overall_score >= 0.4 THEN 'Poor' ELSE 'Invalid' END
    AS validation_status,
  FirstName AS first_name, LastName AS last_name, Email AS email, Phone AS phone, Company AS company,
  Status AS status, LeadSource AS lead_source, CAST(NULL AS TIMESTAMP) AS created_date,
  CAST(NULL AS TIMESTAMP) AS last_modified_date, CAST(NULL AS TIMESTAMP) AS converted_date,
  lower(COALESCE(Status, '')) = 'converted' AS is_converted,
  email_score AS details_email_score, risk_level AS details_fraud_risk_level
FROM rules""")
ORACLE["val12_results"] = VAL12
