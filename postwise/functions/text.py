"""Text functions.

Every function maps Column -> Column with built-in expressions, so they stay
inside whole-stage code generation. Python string semantics that Java lacks
are rebuilt explicitly: Unicode whitespace for ``strip``/``\\s``, Python's
``title()`` (every run of cased letters capitalised) and Khmer digits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postwise import rules as R

# Python's whitespace (str.isspace / re \s / str.strip), derived by rule:
# every BMP character Python calls whitespace (none lies above U+3000).
PY_WHITESPACE = "".join(chr(i) for i in range(0x10000) if chr(i).isspace())
_WS = "[" + "".join(f"\\x{{{ord(ch):x}}}" for ch in PY_WHITESPACE) + "]"
_OTHER_WS = PY_WHITESPACE.replace(" ", "")
_CASED = r"\p{Lu}\p{Ll}\p{Lt}"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace
    (``btrim`` with Python's whitespace set; no regex)."""
    return F.btrim(_col(c), F.lit(PY_WHITESPACE))


def blank_strip(c) -> Column:
    """Missing -> '' then strip (``fillna('').str.strip()``)."""
    return strip_ws(F.coalesce(_col(c), F.lit("")))


def nfkc(c) -> Column:
    """NFKC normalisation on the JVM (ICU, shipped with Spark).

    Only rows holding a non-ASCII character call the normaliser; ASCII text
    is already NFKC.
    """
    c = _col(c)
    normalized = F.call_function("reflect", F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(True))
    return F.when(c.rlike(r"[^\x00-\x7F]"), normalized).otherwise(c)


def normalize_text(c, use_nfkc: bool = True) -> Column:
    """P2: '' if missing, NFKC, NBSP -> space, strip, collapse whitespace runs."""
    v = F.coalesce(_col(c), F.lit(""))
    if use_nfkc:
        v = nfkc(v)
    # Every whitespace character becomes a blank (NBSP included), so the
    # strip is a plain trim and only runs of blanks are left to collapse.
    v = F.translate(v, _OTHER_WS, " " * len(_OTHER_WS))
    v = F.trim(v)
    return F.when(F.locate("  ", v) > 0, F.regexp_replace(v, " {2,}", " ")).otherwise(v)


def title_case(c) -> Column:
    """Python ``str.title()``.

    The text is cut into runs of cased letters and runs of anything else;
    each run is ``initcap``-ed (a letter run has no blank inside, so initcap
    upper-cases its first letter and lower-cases the rest; other runs are
    unchanged). ``ui/ux`` -> ``Ui/Ux``, ``3rd`` -> ``3Rd``, ``it's`` -> ``It'S``.
    """
    runs = F.regexp_extract_all(_col(c), F.lit("[" + _CASED + "]+|[^" + _CASED + "]+"), F.lit(0))
    return F.array_join(F.transform(runs, lambda t: F.initcap(t)), "")


def ascii_digits(c) -> Column:
    """Khmer digits -> ASCII digits (Python ``\\d``/``float`` accept them)."""
    return F.translate(_col(c), R.KHMER_DIGITS, "0123456789")


def _keyword_pattern(keyword: str, whole_word: bool) -> str:
    import re

    body = re.escape(keyword).replace("\\ ", " ")
    return r"(?i)\b" + body + (r"\b" if whole_word else "")


def _first_keyword(text: Column, keywords, mode: str, whole_words: set[str], otherwise: Column) -> Column:
    """Ordered keyword chain: substring (reference) or word-start match (fixed)."""
    out = otherwise
    for kw, value in reversed(list(keywords)):
        if mode == "reference":
            cond = F.lower(text).contains(kw.lower())
        else:
            cond = text.rlike(_keyword_pattern(kw, kw in whole_words))
        out = F.when(cond, F.lit(value)).otherwise(out)
    return out


def standardize_company(c, mode: str = "fixed", use_nfkc: bool = True, suffixes=R.COMPANY_SUFFIXES) -> Column:
    """Normalise, lower, drop the legal suffixes in order, normalise, title.

    ``mode="fixed"`` also strips punctuation left dangling at the end
    ("ABC Co., Ltd." -> "Abc"; the original gives "Abc .").
    """
    v = F.lower(normalize_text(c, use_nfkc))
    for suffix in suffixes:
        v = F.replace(v, F.lit(suffix), F.lit(""))
    v = normalize_text(v, use_nfkc=False)
    if mode != "reference":
        v = F.regexp_replace(v, "[" + _WS[1:-1] + ".,;:]+$", "")
    return title_case(v)


def standardize_title(c, mode: str = "fixed", use_nfkc: bool = True, keywords=R.TITLE_KEYWORDS) -> Column:
    """P10: struct(raw, std): normalised title and the first keyword's title.

    ``mode="fixed"`` matches keywords at a word start (and ``ux`` as a whole
    word) so "luxury" is not a UX job; ``"reference"`` matches substrings.
    """
    raw = normalize_text(c, use_nfkc)
    std = _first_keyword(raw, keywords, mode, {"ux"}, raw)
    return F.struct(raw.alias("raw"), std.alias("std"))


def split_location(c, use_nfkc: bool = True) -> Column:
    """struct(province, city). "city, province" splits at the first comma;
    anything else is the province with no city. Both parts title-cased."""
    t = normalize_text(c, use_nfkc)
    pos = F.locate(",", t)
    city = strip_ws(F.substring_index(t, ",", 1))
    rest = strip_ws(F.substr(t, pos + F.lit(1)))
    has = pos > 0
    province = F.when(has, title_case(rest)).otherwise(title_case(t))
    return F.struct(province.alias("province"), F.when(has, title_case(city)).alias("city"))


def experience_band(c, mode: str = "fixed", use_nfkc: bool = True, keywords=R.EXPERIENCE_KEYWORDS) -> Column:
    """Band by ordered keyword, else the normalised text.

    ``mode="fixed"`` matches at word starts and ``mid`` as a whole word
    (so "midwife" is not mid level)."""
    t = normalize_text(c, use_nfkc)
    return _first_keyword(F.lower(t), keywords, mode, {"mid"}, t)


def education_band(c, use_nfkc: bool = True, default: str = R.EDUCATION_DEFAULT) -> Column:
    """Normalised education, blank -> 'Not Specified'."""
    t = normalize_text(c, use_nfkc)
    return F.when(t == "", F.lit(default)).otherwise(t)
