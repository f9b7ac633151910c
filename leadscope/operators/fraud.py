"""Fraud scoring of raw lead records (FRD-1 .. FRD-9) as one projection.

Input: a leads DataFrame with string columns Id, FirstName, LastName, Email,
Phone, Company (others are passed through). Output adds the five component
scores, the weighted total (capped at 1), ``is_likely_fake`` (uncapped total
>= 0.7), the risk level and the ordered indicator list. The weighted total is
accumulated in the same order and precision as a scalar implementation would,
so thresholds behave identically.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import first_contained, ladder, messages
from ..functions.text import digits, distinct_chars, strip

# Indicator lists of the fraud engine (order matters: first hit wins).
FAKE_EMAIL_PATTERNS = [r"test.*@.*", r"fake.*@.*", r".*@test\.com", r".*@fake\.com", r".*@example\.com",
                       r".*@temp.*\.com", r".*@throwaway.*", r".*@guerrilla.*", r".*@mailinator.*"]
DISPOSABLE_DOMAINS = ["10minutemail", "tempmail", "throwaway", "guerrillamail", "mailinator", "yopmail", "temp-mail"]
FAKE_PHONES = ["1234567890", "0000000000", "1111111111", "5555555555", "8888888888", "9999999999"]
SEQUENTIAL_PHONES = ["1234567890", "0123456789", "9876543210"]
FAKE_NAME_PATTERNS = ["test", "fake", "john doe", "jane doe", "admin", "user", "sample", "demo", "example",
                      "unknown", "asdf", "qwerty", "temp", "temporary"]
SUSPICIOUS_COMPANIES = ["test", "fake", "company", "corp", "inc", "llc", "business", "enterprise", "solutions",
                        "services", "consulting", "group", "organization", "n/a", "none"]
WEIGHTS = (("email", 0.3), ("phone", 0.25), ("name", 0.2), ("company", 0.15), ("consistency", 0.1))
# Indicator texts (a trailing ": " is followed by the offending value).
INDICATORS = {"fake_email": "Fake email pattern: ", "disposable": "Disposable email domain: ",
              "long_number": "Email contains long number sequence", "fake_phone": "Fake phone pattern: ",
              "few_digits": "Phone has too few unique digits", "sequential": "Sequential phone number pattern",
              "name_pattern": "Suspicious name pattern: ", "same_name": "Identical first and last name",
              "single_char": "Single character name", "generic_company": "Generic company name: ",
              "short_company": "Company name too short", "inconsistent": "Name not reflected in email address"}

# Start-anchored alternation == "any pattern matches at position 0".
FAKE_EMAIL_REGEX = "^(?:" + "|".join(FAKE_EMAIL_PATTERNS) + ")"


def _truthy(c: Column) -> Column:
    return F.coalesce(F.length(c) > 0, F.lit(False))


def _email(email: Column) -> tuple[Column, Column]:
    low = F.lower(email)
    domain = F.coalesce(F.get(F.split(low, "@"), 1), F.lit(""))
    fake = F.coalesce(low.rlike(FAKE_EMAIL_REGEX), F.lit(False))
    disp = first_contained(domain, DISPOSABLE_DOMAINS)
    longnum = F.coalesce(low.rlike(r"[0-9]{8,}"), F.lit(False))
    present = _truthy(email)
    base = F.when(disp.isNotNull(), F.lit(0.9)).otherwise(F.lit(0.0))
    score = (F.when(~present, 0.0).when(fake, 1.0)
             .otherwise(F.when(longnum, F.greatest(base, F.lit(0.6))).otherwise(base)))
    return score, messages((present & fake, F.concat(F.lit(INDICATORS["fake_email"]), email)),
                           (present & ~fake & disp.isNotNull(), F.concat(F.lit(INDICATORS["disposable"]), domain)),
                           (present & ~fake & longnum, INDICATORS["long_number"]))


def _phone(phone: Column) -> tuple[Column, Column]:
    d = digits(phone)
    present = _truthy(phone)
    fake = d.isin(*FAKE_PHONES)
    few = (distinct_chars(d) <= 2) & (F.length(d) >= 10)
    seq = d.isin(*SEQUENTIAL_PHONES)
    score = (F.when(~present, 0.0).when(fake, 1.0).when(seq, 0.95).when(few, 0.9).otherwise(0.0))
    return score, messages((present & fake, F.concat(F.lit(INDICATORS["fake_phone"]), phone)),
                           (present & ~fake & few, INDICATORS["few_digits"]),
                           (present & ~fake & seq, INDICATORS["sequential"]))


def _name(first: Column, last: Column) -> tuple[Column, Column]:
    present = _truthy(first) & _truthy(last)
    full = F.lower(F.concat(first, F.lit(" "), last))
    hit = first_contained(full, FAKE_NAME_PATTERNS)
    same = F.lower(first) == F.lower(last)
    single = (F.length(strip(first)) == 1) | (F.length(strip(last)) == 1)
    s = F.when(hit.isNotNull(), F.lit(0.8)).otherwise(F.lit(0.0))
    s = F.when(same, F.greatest(s, F.lit(0.7))).otherwise(s)
    s = F.when(single, F.greatest(s, F.lit(0.5))).otherwise(s)
    score = F.when(present, s).otherwise(F.lit(0.0))
    return score, messages((present & hit.isNotNull(), F.concat(F.lit(INDICATORS["name_pattern"]), hit)),
                           (present & same, INDICATORS["same_name"]),
                           (present & single, INDICATORS["single_char"]))


def _company(company: Column) -> tuple[Column, Column]:
    present = _truthy(company)
    low = strip(F.lower(company))
    generic = low.isin(*SUSPICIOUS_COMPANIES)
    short = F.length(low) <= 2
    s = F.when(generic, F.lit(0.6)).otherwise(F.lit(0.0))
    s = F.when(short, F.greatest(s, F.lit(0.4))).otherwise(s)
    score = F.when(present, s).otherwise(F.lit(0.0))
    return score, messages((present & generic, F.concat(F.lit(INDICATORS["generic_company"]), company)),
                           (present & short, INDICATORS["short_company"]))


def _consistency(email: Column, first: Column, last: Column) -> tuple[Column, Column]:
    e, f, l_ = (F.lower(F.coalesce(c, F.lit(""))) for c in (email, first, last))
    present = (F.length(e) > 0) & (F.length(f) > 0) & (F.length(l_) > 0)
    miss = present & (F.instr(e, f) == 0) & (F.instr(e, l_) == 0)
    return F.when(miss, F.lit(0.3)).otherwise(F.lit(0.0)), messages((miss, INDICATORS["inconsistent"]))


def risk_level(score: Column) -> Column:
    """FRD-7: CRITICAL/HIGH/MEDIUM/LOW/MINIMAL at .8/.6/.4/.2."""
    return ladder([(score >= 0.8, "CRITICAL"), (score >= 0.6, "HIGH"), (score >= 0.4, "MEDIUM"),
                   (score >= 0.2, "LOW")], "MINIMAL")


def fraud_scores(leads: DataFrame, email: str = "Email", phone: str = "Phone", first: str = "FirstName",
                 last: str = "LastName", company: str = "Company") -> DataFrame:
    """FRD-1..FRD-9 for every lead; a pure narrow projection (no shuffle)."""
    E, P, FN, LN, C = (F.col(x) for x in (email, phone, first, last, company))
    parts = {"email": _email(E), "phone": _phone(P), "name": _name(FN, LN), "company": _company(C),
             "consistency": _consistency(E, FN, LN)}
    df = leads.withColumns({f"fraud_{k}_score": v[0] for k, v in parts.items()})
    total = F.lit(0.0)
    for k, w in WEIGHTS:
        total = total + F.col(f"fraud_{k}_score") * F.lit(w)
    indicators = F.concat(*[v[1] for v in parts.values()])
    return (df.withColumn("_raw_fraud", total)
              .withColumns({"fraud_score": F.least(F.col("_raw_fraud"), F.lit(1.0)),
                            "is_likely_fake": F.col("_raw_fraud") >= 0.7,
                            "risk_level": risk_level(F.col("_raw_fraud")),
                            "fraud_indicators": indicators})
              .drop("_raw_fraud"))


def batch_fraud_detection(leads: DataFrame) -> DataFrame:
    """FRD-8: per-lead fraud result keyed by ``lead_id``."""
    r = fraud_scores(leads)
    return r.select(F.col("Id").alias("lead_id"), "fraud_score", "fraud_indicators", "is_likely_fake", "risk_level")
