"""Salary functions.

Parsing is pure regex + ``try_cast``: dirty numbers give NULL instead of
raising (Spark runs with ANSI mode on).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postwise import rules as R
from postwise.functions.text import _OTHER_WS, _col, ascii_digits, normalize_text

SALARY_TYPE = "decimal(10,2)"
USD_TYPE = "decimal(12,2)"
_WORK_TYPE = "decimal(20,4)"


def _plain(c) -> Column:
    """ASCII digits, and a blank for each character that Python's ``\\s`` also matches."""
    return F.translate(ascii_digits(c), _OTHER_WS, " " * len(_OTHER_WS))


def _amount(s: Column, dtype: str) -> Column:
    return F.regexp_replace(s, ",", "").try_cast(dtype)


def salary_range(c, mode: str = "fixed", translated: bool = False) -> Column:
    """struct(salary_min, salary_max) as decimal(10,2) from free text.

    Text containing "Not disclosed"/"Negotiable" (case-sensitive) gives
    NULLs. The patterns are tried in order, the first that matches wins.
    ``mode="reference"`` uses the original patterns (so "USD 800 - 1500"
    gives max 150); ``"fixed"`` reads unseparated numbers and either dash.
    """
    t = _col(c) if translated else _plain(_col(c))
    patterns = R.SALARY_PATTERNS_REFERENCE if mode == "reference" else R.SALARY_PATTERNS_FIXED
    hit = None
    for p in reversed(patterns):
        pair = F.struct(
            _amount(F.regexp_extract(t, p, 1), SALARY_TYPE).alias("salary_min"),
            _amount(F.regexp_extract(t, p, 2), SALARY_TYPE).alias("salary_max"),
        )
        hit = F.when(t.rlike(p), pair) if hit is None else F.when(t.rlike(p), pair).otherwise(hit)
    skip = F.lit(False)
    for tok in R.SALARY_SKIP_TOKENS:
        skip = skip | t.contains(tok)
    empty = F.struct(F.lit(None).cast(SALARY_TYPE).alias("salary_min"),
                     F.lit(None).cast(SALARY_TYPE).alias("salary_max"))
    # Every pattern needs the literal "USD": a plain substring test spares
    # the regex engine on all other rows.
    needs = "USD" if all("USD" in p for p in patterns) else None
    if needs:
        skip = skip | ~t.contains(needs)
    return F.when(t.isNull() | skip, empty).otherwise(F.coalesce(hit, empty))


def _rate(currency: Column, rates: dict) -> Column:
    out = F.lit(1.0)
    for code, rate in rates.items():
        out = F.when(currency == code, F.lit(rate)).otherwise(out)
    return out


def to_usd(amount, currency, rates: dict | None = None) -> Column:
    """Amount x rate(currency) as decimal(12,2); unknown codes use 1.0."""
    rates = rates or R.CURRENCY_RATES
    rate = _rate(_col(currency), rates).cast("decimal(12,6)")
    return (_col(amount).cast(_WORK_TYPE) * rate).try_cast(USD_TYPE)


def _parts(t: Column, mode: str) -> dict[str, Column]:
    """Stage 2 of standard-profile parsing: pattern hits, currency text, amounts."""
    if mode == "reference":
        rng, single = R.SALARY_RANGE_PATTERN_REFERENCE, R.SALARY_SINGLE_PATTERN_REFERENCE
        r_cur, r_min, r_max = (F.regexp_extract(t, rng, i) for i in (1, 2, 3))
        s_cur, s_val = F.regexp_extract(t, single, 1), F.regexp_extract(t, single, 2)
    else:
        rng, single = R.SALARY_RANGE_PATTERN_FIXED, R.SALARY_SINGLE_PATTERN_FIXED
        r_cur = F.coalesce(F.nullif(F.regexp_extract(t, rng, 1), F.lit("")),
                           F.nullif(F.regexp_extract(t, rng, 5), F.lit("")),
                           F.regexp_extract(t, rng, 3))
        r_min, r_max = F.regexp_extract(t, rng, 2), F.regexp_extract(t, rng, 4)
        s_cur = F.coalesce(F.nullif(F.regexp_extract(t, single, 1), F.lit("")),
                           F.regexp_extract(t, single, 3))
        s_val = F.regexp_extract(t, single, 2)
    is_range = t.rlike(rng)
    return {
        "t": t,
        "is_range": is_range,
        "is_single": t.rlike(single),
        "raw_cur": F.when(is_range, r_cur).otherwise(s_cur),
        "lo": _amount(F.when(is_range, r_min).otherwise(s_val), _WORK_TYPE),
        "hi": _amount(F.when(is_range, r_max).otherwise(s_val), _WORK_TYPE),
    }


def _classify(p: dict[str, Column], default_currency: str, keywords: dict, mode: str) -> dict[str, Column]:
    """Stage 3: currency code and salary type."""
    t = p["t"]
    cur = F.upper(F.coalesce(F.nullif(p["raw_cur"], F.lit("")), F.lit(default_currency)))
    if mode == "reference":
        cur = F.replace(cur, F.lit("$"), F.lit("USD"))
    else:
        cur = F.when(cur.isin("$", "US$"), F.lit("USD")).when(cur == "៛", F.lit("KHR")).otherwise(cur)
    ok = (p["is_range"] | p["is_single"]) & p["lo"].isNotNull() & p["hi"].isNotNull()
    kind = F.when(ok, F.when(p["is_range"], F.lit("range")).otherwise(F.lit("fixed"))).otherwise(F.lit("undisclosed"))
    for label, pats in reversed(list(keywords.items())):
        cond = F.lit(False)
        for pat in pats:
            cond = cond | F.lower(t).contains(pat.lower())
        kind = F.when(cond, F.lit(label)).otherwise(kind)
    kind = F.when(t == "", F.lit("undisclosed")).otherwise(kind)
    return {"lo": p["lo"], "hi": p["hi"], "cur": cur, "salary_type": kind}


def _assemble(c: dict[str, Column], default_currency: str, rates: dict) -> dict[str, Column]:
    """Stage 4: USD amounts for range/fixed salaries, NULLs otherwise."""
    parsed = c["salary_type"].isin("range", "fixed")
    none = F.lit(None).cast(USD_TYPE)
    return {
        "salary_min_usd": F.when(parsed, to_usd(c["lo"], c["cur"], rates)).otherwise(none),
        "salary_max_usd": F.when(parsed, to_usd(c["hi"], c["cur"], rates)).otherwise(none),
        "salary_currency": F.when(parsed, c["cur"]).otherwise(F.lit(default_currency)),
        "salary_type": c["salary_type"],
    }


SALARY_FIELDS = ["salary_min_usd", "salary_max_usd", "salary_currency", "salary_type"]


def parse_salary(c, default_currency: str = R.DEFAULT_CURRENCY, keywords: dict | None = None,
                 mode: str = "fixed", rates: dict | None = None, use_nfkc: bool = True) -> Column:
    """P5: struct(salary_min_usd, salary_max_usd, salary_currency, salary_type).

    Order: blank -> undisclosed; keyword labels (case-insensitive substring)
    -> that label; a range -> "range"; a single number -> "fixed"; else
    "undisclosed". Amounts are converted to USD.

    ``mode="fixed"`` only takes known codes (USD, KHR, US$, $, ៛) before a
    number or after the last one as the currency, so "from 500" is USD and
    "$300-$500" is a range. ``"reference"`` takes any 0-3 letters/``$``
    before the first number as the currency ("from 500" -> "ROM").
    Unparseable numbers give "undisclosed" instead of an error.

    As one expression this is large; on DataFrames prefer
    :func:`with_parsed_salary`, which evaluates it in small stages.
    """
    keywords = R.SALARY_KEYWORDS if keywords is None else keywords
    t = _plain(normalize_text(c, use_nfkc))
    out = _assemble(_classify(_parts(t, mode), default_currency, keywords, mode), default_currency,
                    rates or R.CURRENCY_RATES)
    return F.struct(*[out[k].alias(k) for k in SALARY_FIELDS])


def with_parsed_salary(df, c, default_currency: str = R.DEFAULT_CURRENCY, keywords: dict | None = None,
                       mode: str = "fixed", rates: dict | None = None, use_nfkc: bool = True,
                       normalized: bool = False):
    """P5 on a DataFrame: adds the four salary columns in staged projections.

    Each stage references the previous stage's columns, so every regex runs
    once per row and each generated method stays small enough for
    whole-stage code generation.
    """
    keywords = R.SALARY_KEYWORDS if keywords is None else keywords
    cols = df.columns
    src = _col(c) if normalized else normalize_text(c, use_nfkc)
    s1 = df.select("*", _plain(src).alias("_sal_t"))
    p = _parts(F.col("_sal_t"), mode)
    s2 = s1.select(*cols, "_sal_t", *[v.alias(f"_sal_{k}") for k, v in p.items() if k != "t"])
    c3 = _classify({"t": F.col("_sal_t"), **{k: F.col(f"_sal_{k}") for k in p if k != "t"}},
                   default_currency, keywords, mode)
    s3 = s2.select(*cols, *[v.alias(f"_sal3_{k}") for k, v in c3.items()])
    out = _assemble({k: F.col(f"_sal3_{k}") for k in c3}, default_currency, rates or R.CURRENCY_RATES)
    return s3.select(*cols, *[out[k].alias(k) for k in SALARY_FIELDS])


def with_salary_range(df, c, mode: str = "fixed"):
    """P4 on a DataFrame: adds ``salary_min``/``salary_max`` (digits
    translated once in a first projection)."""
    cols = df.columns
    s1 = df.select("*", _plain(_col(c)).alias("_rng_t"))
    r = salary_range(F.col("_rng_t"), mode, translated=True)
    return s1.select(*cols, r["salary_min"].alias("salary_min"), r["salary_max"].alias("salary_max"))


def salary_avg(lo, hi) -> Column:
    """(min + max) / 2 stored as decimal(10,2); NULL if either is NULL."""
    return ((_col(lo) + _col(hi)) / F.lit(2)).try_cast(SALARY_TYPE)


def has_salary(lo) -> Column:
    """salary_min IS NOT NULL."""
    return _col(lo).isNotNull()
