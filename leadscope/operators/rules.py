"""Lead validation rules (VAL-1 .. VAL-13) as Spark column expressions.

Every check of the rule engine becomes a column (score, validity, issue
array); the whole engine is one narrow projection over the leads table plus a
tiny aggregate over *distinct e-mail domains* for the typo check, joined back
on the domain. Deliverability (DNS) and carrier metadata lookups are not
reproduced: e-mail syntax and North-American phone numbering rules stated
below stand in for the third-party validators.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import contains_any, ladder, messages
from ..functions.text import digits, filled, fuzzy_ratio, is_upper, strip
from ..sources.sinks import checkpointed
from . import fraud as fraud_ops

# Field lists, patterns and weights of the rule engine.
REQUIRED_FIELDS = ["FirstName", "LastName", "Email", "Phone", "Company", "Status"]
IMPORTANT_FIELDS = ["Title", "Industry", "LeadSource", "City", "State", "Country"]
COMMON_DOMAINS = ["gmail.com", "yahoo.com", "hotmail.com", "outlook.com"]
NAME_SUSPICIOUS = ["test", "unknown", "n/a", "null", "admin"]
COMPANY_SUSPICIOUS = ["test", "unknown", "n/a", "null", "none", "company"]
PLACEHOLDERS = ["test", "unknown", "n/a", "null", "none", "tbd", "pending"]
QUALITY_WEIGHTS = (("email", 0.30), ("phone", 0.30), ("name", 0.15), ("company", 0.10), ("completeness", 0.15))
# Issue texts ("{f}" is the field name; a trailing ": " is followed by the value).
ISSUES = {"email_required": "Email is required", "email_invalid": "Invalid email format",
          "multiple_at": "Multiple @ symbols", "domain_typo": "Possible domain typo: ",
          "phone_required": "Phone number is required", "phone_invalid": "Invalid phone number",
          "first_required": "First name is required", "first_short": "First name too short",
          "last_required": "Last name is required", "last_short": "Last name too short",
          "name_suspicious": "Suspicious name pattern detected", "company_required": "Company name is required",
          "company_short": "Company name too short", "company_suspicious": "Suspicious company name",
          "missing_field": "Missing required field: {f}", "placeholder": "Placeholder value in {f}: ",
          "all_caps": "All caps formatting in {f}", "double_space": "Multiple spaces in {f}"}

# Our stated syntax rules (stand-ins for the external validators).
EMAIL_SYNTAX = (r"^[A-Za-z0-9!#$%&'*+/=?^_{|}~-]+(\.[A-Za-z0-9!#$%&'*+/=?^_{|}~-]+)*"
                r"@([A-Za-z0-9]([A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}$")
PHONE_CHARS = r"^[0-9()+.\- ]+$"
#: Domains that are broadcast at most.
TYPO_ROWS = 200_000
NANP = r"^1?[2-9][0-9]{2}[2-9][0-9]{6}$"


# North American area codes of service numbers.
TOLL_FREE = ("800", "833", "844", "855", "866", "877", "888")
PERSONAL = ("500", "521", "522", "533", "544", "566", "577", "588")
PREMIUM_RATE = "900"


def _issues(*pairs: tuple[Column, Column | str]) -> Column:
    return messages(*pairs)


# ------------------------------------------------------------------ VAL-3

def domain_typos(leads: DataFrame, email: str = "Email", common: Sequence[str] = COMMON_DOMAINS) -> DataFrame:
    """VAL-3 over distinct domains: first common domain with 60 <= ratio < 90.

    Work is proportional to the number of distinct domains, not leads; the
    result is joined back on the domain (an equi-join, so Spark may broadcast
    it when small and shuffle otherwise). Store the result before a filter on
    ``_typo``: a filter would be pushed below the distinct, to every lead."""
    dom = F.lower(F.get(F.split(F.col(email), "@"), 1))
    doms = leads.select(dom.alias("_domain")).filter(F.col("_domain").isNotNull()).distinct()
    length, hit, ratios = F.length("_domain"), None, {}
    for k, c in enumerate(common):
        # common characters are the shorter length at most, so other lengths can't reach the ratio (59.5 is rounded up)
        near = 200 * F.least(length, F.lit(len(c))) >= 59.5 * (length + len(c))
        ratios[f"_r{k}"] = F.when(near, fuzzy_ratio(F.col("_domain"), F.lit(c)))
        r = F.col(f"_r{k}")
        cond = (r >= 60) & (r < 90)
        hit = F.when(cond, F.lit(c)) if hit is None else hit.when(cond, F.lit(c))
    return doms.withColumns(ratios).select("_domain", hit.alias("_typo"))


# ------------------------------------------------------------------ VAL-2 .. VAL-8

def _email_cols(e: Column, typo: Column) -> dict[str, Column]:
    present = F.coalesce(F.length(e) > 0, F.lit(False))
    valid = present & F.coalesce(e.rlike(EMAIL_SYNTAX), F.lit(False))
    multi_at = (F.length(e) - F.length(F.regexp_replace(e, "@", ""))) != 1
    s = F.when(valid, F.lit(1.0)).otherwise(F.lit(0.0))
    s = F.when(valid & multi_at, s * 0.5).otherwise(s)
    s = F.when(valid & typo.isNotNull(), s * 0.8).otherwise(s)
    return {
        "email_valid": valid, "email_score": s,
        "email_issues": _issues((~present, ISSUES["email_required"]),
                                (present & ~valid, ISSUES["email_invalid"]),
                                (valid & multi_at, ISSUES["multiple_at"]),
                                (valid & typo.isNotNull(), F.concat(F.lit(ISSUES["domain_typo"]), typo))),
    }


def _phone_cols(p: Column) -> dict[str, Column]:
    present = F.coalesce(F.length(p) > 0, F.lit(False))
    d = digits(p)
    valid = present & F.coalesce(p.rlike(PHONE_CHARS), F.lit(False)) & F.coalesce(d.rlike(NANP), F.lit(False))
    ten = F.substring(d, -10, 10)
    return {
        "phone_valid": valid,
        "phone_score": F.when(valid, F.lit(1.0)).otherwise(F.lit(0.0)),
        "phone_e164": F.when(valid, F.concat(F.lit("+1"), ten)),
        "phone_national": F.when(valid, F.concat(F.lit("("), F.substring(ten, 1, 3), F.lit(") "),
                                                 F.substring(ten, 4, 3), F.lit("-"), F.substring(ten, 7, 4))),
        "phone_issues": _issues((~present, ISSUES["phone_required"]), (present & ~valid, ISSUES["phone_invalid"])),
    }


def _name_cols(first: Column, last: Column) -> dict[str, Column]:
    def part(x: Column) -> tuple[Column, Column, Column]:
        n = F.coalesce(F.length(strip(x)), F.lit(0))
        missing = ~F.coalesce(F.length(x) > 0, F.lit(False)) | (n < 1)
        return missing, n, F.when(missing, F.lit(0.0)).when(n >= 2, F.lit(0.5)).otherwise(F.lit(0.25))
    fm, fn_len, fs = part(first)
    lm, ln_len, ls = part(last)
    both = F.coalesce((F.length(first) > 0) & (F.length(last) > 0), F.lit(False))
    full = F.lower(F.concat(first, F.lit(" "), last))
    sus = both & contains_any(full, NAME_SUSPICIOUS)
    factor = F.when(sus, F.lit(0.5)).otherwise(F.lit(1.0))
    # components are appended first-name then last-name and summed in that order
    score = F.lit(0.0) + fs * factor + ls * factor
    return {
        "name_score": score, "name_valid": score >= 0.8,
        "name_issues": _issues((fm, ISSUES["first_required"]), (~fm & (fn_len < 2), ISSUES["first_short"]),
                               (lm, ISSUES["last_required"]), (~lm & (ln_len < 2), ISSUES["last_short"]),
                               (sus, ISSUES["name_suspicious"])),
    }


def _company_cols(c: Column) -> dict[str, Column]:
    present = F.coalesce(F.length(c) > 0, F.lit(False))
    clean = strip(c)
    short = F.length(clean) < 2
    sus = F.lower(clean).isin(*COMPANY_SUSPICIOUS)
    base = F.when(short, F.lit(0.2)).otherwise(F.lit(0.8))
    score = F.when(~present, F.lit(0.0)).when(sus, base * 0.3).otherwise(base)
    return {
        "company_score": score, "company_valid": present & ~short & ~sus,
        "company_issues": _issues((~present, ISSUES["company_required"]), (present & short, ISSUES["company_short"]),
                                  (present & sus, ISSUES["company_suspicious"])),
    }


def _completeness_cols(cols: Sequence[str]) -> dict[str, Column]:
    req = [filled(f) if f in cols else F.lit(False) for f in REQUIRED_FIELDS]
    imp = [filled(f) if f in cols else F.lit(False) for f in IMPORTANT_FIELDS]
    n_req = sum((F.when(x, 1).otherwise(0) for x in req), F.lit(0))
    n_imp = sum((F.when(x, 1).otherwise(0) for x in imp), F.lit(0))
    score = (n_req.cast("double") / float(len(REQUIRED_FIELDS))) * 0.7 \
        + (n_imp.cast("double") / float(len(IMPORTANT_FIELDS))) * 0.3
    return {
        "completeness_score": score,
        "required_fields_filled": n_req, "important_fields_filled": n_imp,
        "total_fields_filled": n_req + n_imp,
        "completeness_issues": _issues(*[(~x, ISSUES["missing_field"].format(f=f))
                                         for x, f in zip(req, REQUIRED_FIELDS)]),
    }


def _lint_cols(fields: Sequence[str]) -> dict[str, Column]:
    checks, issues_a, issues_b, n_issue = [], [], [], []
    for f in fields:
        v = F.col(f)
        present = F.coalesce(F.length(v) > 0, F.lit(False))
        ph = present & strip(F.lower(v)).isin(*PLACEHOLDERS)
        caps = present & is_upper(v) & (F.length(v) > 10)
        dbl_space = present & (F.instr(v, "  ") > 0)
        checks.append(F.when(present, 1).otherwise(0))
        n_issue += [F.when(ph, 1).otherwise(0), F.when(caps, 1).otherwise(0), F.when(dbl_space, 1).otherwise(0)]
        issues_a.append((ph, F.concat(F.lit(ISSUES["placeholder"].format(f=f)), v)))
        issues_b += [(caps, ISSUES["all_caps"].format(f=f)), (dbl_space, ISSUES["double_space"].format(f=f))]
    total = sum(checks, F.lit(0))
    bad = sum(n_issue, F.lit(0))
    score = F.when(total > 0, F.greatest(F.lit(0.0), F.lit(1.0) - bad.cast("double") / total.cast("double"))) \
        .otherwise(F.lit(1.0))
    return {"lint_score": score, "lint_checks": total, "lint_issue_count": bad,
            "lint_issues": _issues(*issues_a, *issues_b)}


# ------------------------------------------------------------------ VAL-1, VAL-9..VAL-12

def status_ladder(score: Column) -> Column:
    """VAL-11: Excellent/Good/Fair/Poor/Invalid at .9/.8/.6/.4."""
    return ladder([(score >= 0.9, "Excellent"), (score >= 0.8, "Good"), (score >= 0.6, "Fair"),
                   (score >= 0.4, "Poor")], "Invalid")


def _with_typos(leads: DataFrame, most: int = TYPO_ROWS) -> DataFrame:
    """Leads with ``_typo``. Only distinct domains that have one are joined. Up to ``most`` of them are broadcast, so no
    lead is shuffled by domain, whatever part of all leads a domain has; beyond that the join shuffles by domain and
    leaves a domain that is too large for a task to Spark's skew handling.

    Leads are dealt out evenly before the checks: a lead is some 20 bytes of a compressed table, so a scan gives all of
    them to a task or two, however many cores there are, while the checks take most of the time."""
    hits = checkpointed(domain_typos(leads)).filter(F.col("_typo").isNotNull())
    few = hits.limit(most + 1).count() <= most
    dom = F.lower(F.get(F.split(F.col("Email"), "@"), 1))
    rows = (leads.hint("rebalance") if few else leads).withColumn("_domain", dom)
    return rows.join(F.broadcast(hits) if few else hits, "_domain", "left").drop("_domain")


def validate_leads(leads: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """VAL-1: every check, the weighted quality score, the fraud score, the
    combined score and the status, for every lead (input columns kept)."""
    fields = list(fields) if fields is not None else [c for c, t in leads.dtypes if t == "string"]
    df = _with_typos(leads)
    cols: dict[str, Column] = {}
    cols.update(_email_cols(F.col("Email"), F.col("_typo")))
    cols.update(_phone_cols(F.col("Phone")))
    cols.update(_name_cols(F.col("FirstName"), F.col("LastName")))
    cols.update(_company_cols(F.col("Company")))
    cols.update(_completeness_cols(leads.columns))
    cols.update(_lint_cols(fields))
    df = df.withColumns(cols).drop("_typo")
    total, wsum = F.lit(0.0), 0.0
    for k, w in QUALITY_WEIGHTS:
        total = total + F.col(f"{k}_score") * F.lit(w)
        wsum += w
    df = df.withColumn("data_quality_score", total / F.lit(wsum))
    df = fraud_ops.fraud_scores(df)
    overall = F.col("data_quality_score") * 0.7 + (F.lit(1.0) - F.col("fraud_score")) * 0.3
    return df.withColumns({"overall_score": overall, "validation_status": status_ladder(overall)})


def _details_json() -> Column:
    def check(k: str, extra: list[str]) -> Column:
        return F.struct(F.col(f"{k}_score").alias("score"), *[F.col(x).alias(x.split("_", 1)[1]) for x in extra],
                        F.col(f"{k}_issues").alias("issues"))
    return F.to_json(F.struct(
        check("email", ["email_valid"]).alias("email"),
        check("phone", ["phone_valid", "phone_e164", "phone_national"]).alias("phone"),
        check("name", ["name_valid"]).alias("name"),
        check("company", ["company_valid"]).alias("company"),
        F.struct(F.col("completeness_score").alias("score"), "required_fields_filled", "important_fields_filled",
                 "total_fields_filled", F.col("completeness_issues").alias("issues")).alias("completeness"),
        F.struct(F.col("lint_score").alias("score"), F.col("lint_issues").alias("issues")).alias("data_quality"),
        F.struct("fraud_score", "fraud_indicators", "is_likely_fake", "risk_level").alias("fraud"),
    ))


def validation_results(leads: DataFrame, as_of) -> DataFrame:
    """VAL-12: materialise ``validation_results`` (0-1 scores + lead attributes)
    from raw leads; ``validation_timestamp`` is the run's ``as_of`` instant.
    CreatedDate, LastModifiedDate and ConvertedDate pass through where leads have them and are NULL otherwise."""
    v = validate_leads(leads)
    ts = F.lit(str(as_of)).cast("timestamp_ntz")

    def lead_date(name: str) -> Column:
        return (F.col(name) if name in leads.columns else F.lit(None)).cast("timestamp_ntz")

    return v.select(
        F.col("Id").alias("lead_id"), ts.alias("validation_timestamp"), "overall_score", "data_quality_score",
        "fraud_score", "validation_status", _details_json().alias("validation_details"),
        F.col("FirstName").alias("first_name"), F.col("LastName").alias("last_name"), F.col("Email").alias("email"),
        F.col("Phone").alias("phone"), F.col("Company").alias("company"), F.col("Status").alias("status"),
        F.col("LeadSource").alias("lead_source"), lead_date("CreatedDate").alias("created_date"),
        lead_date("LastModifiedDate").alias("last_modified_date"), lead_date("ConvertedDate").alias("converted_date"), (F.lower(F.coalesce("Status", F.lit(""))) == "converted").alias("is_converted"))


def issues_long(validated: DataFrame) -> DataFrame:
    """VAL-13: one row per (lead, check, issue) from the issue arrays; ``n_in_check`` is the length of the array."""
    kinds = ["email", "phone", "name", "company", "completeness", "lint"]
    tagged = F.array(*[F.struct(F.lit("data_quality" if k == "lint" else k).alias("check"),
                                F.col(f"{k}_issues").alias("issues")) for k in kinds])
    x = validated.select(F.col("Id").alias("lead_id"), F.inline(tagged)).withColumn("n_in_check", F.size("issues").cast("bigint"))
    return x.select("lead_id", "check", "n_in_check", F.posexplode("issues").alias("position", "issue"))


def line_types(validated: DataFrame) -> DataFrame:
    """VAL-4: kind of line of each valid phone, by its area code; NULL without a valid phone.

    North American numbers don't tell mobile from fixed lines, so both flags are false for them, as for service numbers."""
    area = F.substring("phone_e164", 3, 3)
    kind = F.when(area.isin(*TOLL_FREE), "toll_free").when(area == PREMIUM_RATE, "premium_rate") \
        .when(area.isin(*PERSONAL), "personal_number").when(area.isNotNull(), "fixed_line_or_mobile")
    return validated.select(F.col("Id").alias("lead_id"), kind.alias("phone_line_type"),
                            (kind == "mobile").alias("is_mobile"), (kind == "fixed_line").alias("is_landline"))
