"""Rule values: mappings, keywords, patterns, rates, thresholds and seeds.

Everything in the FIXED VALUES block must equal the values the original
warehouse uses, so results line up; they are stated here as plain text in
their natural order. ``Rules`` bundles them so callers can override any of
them (one typed object instead of an untyped config dict).
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the original warehouse's values)
# ---------------------------------------------------------------------------

INDUSTRY_MAPPING: dict[str, str] = {
    "Banking & Finance": "Finance",
    "Information Technology": "Technology",
    "Retail & Wholesale": "Retail",
    "Tourism & Hospitality": "Hospitality",
    "Logistics & Transportation": "Logistics",
    "Media & Advertising": "Media",
    "Energy & Utilities": "Energy",
    "Education": "Education",
    "Healthcare": "Healthcare",
    "Construction": "Construction",
    "Manufacturing": "Manufacturing",
    "Real Estate": "Real Estate",
    "Telecommunications": "Telecom",
    "Consultancy": "Consulting",
    "Government / Public Sector": "Government",
    "NGO / INGO": "NGO",
    "Automotive - Vehicle": "Automotive",
    "Catering": "Food Services",
    "Foods and drinks": "Food Services",
    "Clothing": "Fashion",
    "General Business Services": "Business Services",
    "Casino": "Entertainment",
    "Agriculture": "Agriculture",
    "Mechanical": "Engineering",
}

LOCATION_MAPPING: dict[str, str] = {
    "Phnom Penh": "Phnom Penh",
    "Siem Reap": "Siem Reap",
    "Kandal": "Kandal",
    "Preah Sihanouk": "Sihanoukville",
    "Kampong Speu": "Kampong Speu",
    "Battambang": "Battambang",
}

EXPERIENCE_MAPPING: dict[str, str] = {
    "Entry Level (0–1 year)": "Entry Level",
    "Junior Level (1–2 years)": "Junior Level",
    "Mid Level (2–5 years)": "Mid Level",
    "Senior Level (5+ years)": "Senior Level",
    "No experience": "Entry Level",
}

EDUCATION_MAPPING: dict[str, str] = {
    "Bachelor's Degree": "Bachelor",
    "Associate Degree": "Associate",
    "High School": "High School",
    "Professional Certificate": "Certificate",
    "Any education level": "Not Required",
    "No education level": "Not Required",
}

# Company suffixes removed (in this order) from the lower-cased name.
COMPANY_SUFFIXES: list[str] = [
    "co., ltd", "co.,ltd", "co. ltd", "ltd.", "plc.", "plc", "inc.", "(cambodia)", "(kh)",
]

# Job-title keywords (lower case), first match wins -> standard title.
TITLE_KEYWORDS: list[tuple[str, str]] = [
    ("ui/ux", "UI/UX Designer"),
    ("ux", "UX Designer"),
    ("developer", "Software Developer"),
    ("engineer", "Engineer"),
    ("officer", "Officer"),
    ("manager", "Manager"),
]

# Experience keywords (lower case), first match wins -> band.
EXPERIENCE_KEYWORDS: list[tuple[str, str]] = [
    ("no experience", "Entry Level (0–1 year)"),
    ("entry", "Entry Level (0–1 year)"),
    ("junior", "Junior Level (1–2 years)"),
    ("mid", "Mid Level (2–5 years)"),
    ("senior", "Senior Level (5+ years)"),
]

EDUCATION_DEFAULT = "Not Specified"

# Salary text that means "no figure" in the basic profile (case-sensitive).
SALARY_SKIP_TOKENS: list[str] = ["Not disclosed", "Negotiable"]

# Basic-profile salary patterns as the original applies them, in order.
SALARY_PATTERNS_REFERENCE: list[str] = [
    r"USD\s*(\d{1,3}(?:,\d{3})*)\s*[–\-]\s*(\d{1,3}(?:,\d{3})*)",
    r"USD\s*(\d+)\s*-\s*(\d+)",
    r"(\d+)\s*-\s*(\d+)\s*USD",
]

# Standard-profile salary patterns as the original applies them.
SALARY_RANGE_PATTERN_REFERENCE = r"([A-Za-z$]{0,3})\s*([\d,\.]+)\s*[-–]\s*([\d,\.]+)"
SALARY_SINGLE_PATTERN_REFERENCE = r"([A-Za-z$]{0,3})\s*([\d,\.]+)"

CURRENCY_RATES: dict[str, float] = {"USD": 1.0, "KHR": 0.00024}
DEFAULT_CURRENCY = "USD"
SALARY_KEYWORDS: dict[str, list[str]] = {
    "negotiable": ["Negotiable"],
    "undisclosed": ["Not disclosed"],
}

# Standard-profile posting-date formats, tried in order.
DATE_FORMATS: list[str] = ["M/d/yyyy", "M/d/yyyy H:m:s", "d/M/yyyy"]

# Khmer digits zero..nine.
KHMER_DIGITS = "០១២៣៤៥៦៧៨៩"

SEED_AGENCIES: list[tuple[str, str]] = [
    ("Facebook Page", "Social Media"),
    ("Jobify Cambodia", "Job Portal"),
    ("LinkedIn Cambodia", "Professional Network"),
    ("CamHR", "Job Portal"),
    ("BongThom", "Classifieds"),
    ("Khmer24 Jobs", "Classifieds"),
]

# Seeded locations, (city, province).
SEED_LOCATIONS: list[tuple[str, str]] = [
    ("Phnom Penh", "Phnom Penh"),
    ("Siem Reap", "Siem Reap"),
    ("Kandal", "Kandal"),
    ("Preah Sihanouk", "Preah Sihanouk"),
    ("Kampong Speu", "Kampong Speu"),
    ("Battambang", "Battambang"),
]

REQUIRED_FIELDS: list[str] = ["job_title", "company_name", "industry", "location"]
MIN_SALARY = 100
MAX_SALARY = 5000
DEDUP_FIELDS: list[str] = ["job_title", "company_name", "location", "posting_date"]
SIMILARITY_THRESHOLD = 0.9
TIME_WINDOW_DAYS = 7

DEFAULT_COMPANY_TYPE = "Private"
DEFAULT_COUNTRY = "Cambodia"

# ---------------------------------------------------------------------------
# Our own choices (not taken from the original)
# ---------------------------------------------------------------------------

# Basic-profile salary patterns, mode="fixed": separators are optional and
# both dash kinds are accepted, so "USD 800 - 1500" gives 1500, not 150.
SALARY_PATTERNS_FIXED: list[str] = [
    r"USD\s*(\d+(?:,\d+)*)\s*[–-]\s*(\d+(?:,\d+)*)",
    r"(\d+(?:,\d+)*)\s*[–-]\s*(\d+(?:,\d+)*)\s*USD",
]

# Standard-profile salary patterns, mode="fixed": only known currency codes
# count as a currency, before either number or after the last one.
_CODE = r"(USD|KHR|US\$|\$|៛)"
_NUM = r"(\d+(?:,\d+)*(?:\.\d+)?)"
SALARY_RANGE_PATTERN_FIXED = (
    r"(?i)" + _CODE + r"?\s*" + _NUM + r"\s*[-–]\s*" + _CODE + r"?\s*" + _NUM + r"(?:\s*" + _CODE + r")?"
)
SALARY_SINGLE_PATTERN_FIXED = r"(?i)" + _CODE + r"?\s*" + _NUM + r"(?:\s*" + _CODE + r")?"

# Basic-profile date formats: the standard list plus ISO dates.
BASIC_DATE_FORMATS: list[str] = DATE_FORMATS + ["yyyy-MM-dd"]

# Default run date used by the registered queries so results are stable.
DEFAULT_RUN_DATE = "2025-01-01"

# Inline CASE for mappings up to this size, a broadcast join beyond it.
INLINE_MAPPING_LIMIT = 200

# Collation that reproduces the original server's text equality
# (case- and accent-insensitive, trailing blanks ignored).
MATCH_COLLATION = "UNICODE_CI_AI_RTRIM"


@dataclass(frozen=True)
class Rules:
    """All tunable rule values in one typed object."""

    industry_mapping: dict = field(default_factory=lambda: dict(INDUSTRY_MAPPING))
    location_mapping: dict = field(default_factory=lambda: dict(LOCATION_MAPPING))
    experience_mapping: dict = field(default_factory=lambda: dict(EXPERIENCE_MAPPING))
    education_mapping: dict = field(default_factory=lambda: dict(EDUCATION_MAPPING))
    currency_default: str = DEFAULT_CURRENCY
    currency_rates: dict = field(default_factory=lambda: dict(CURRENCY_RATES))
    salary_keywords: dict = field(default_factory=lambda: {k: list(v) for k, v in SALARY_KEYWORDS.items()})
    company_suffixes: tuple = tuple(COMPANY_SUFFIXES)
    title_keywords: tuple = tuple(TITLE_KEYWORDS)
    experience_keywords: tuple = tuple(EXPERIENCE_KEYWORDS)
    education_default: str = EDUCATION_DEFAULT
    date_formats: tuple = tuple(DATE_FORMATS)
    basic_date_formats: tuple = tuple(BASIC_DATE_FORMATS)
    required_fields: tuple = tuple(REQUIRED_FIELDS)
    date_validation: bool = True
    salary_validation: bool = True
    min_salary: float = MIN_SALARY
    max_salary: float = MAX_SALARY
    dedup_enabled: bool = True
    dedup_fields: tuple = tuple(DEDUP_FIELDS)
    similarity_threshold: float = SIMILARITY_THRESHOLD
    time_window_days: int = TIME_WINDOW_DAYS
    mode: str = "fixed"  # "fixed" (our corrected rules) or "reference"
    nfkc: bool = True

    def replace(self, **kw) -> "Rules":
        from dataclasses import replace as _r

        return _r(self, **kw)


DEFAULT_RULES = Rules()

# Staging column widths of the original DDL (checked, not truncated).
STAGING_LENGTHS: dict[str, int] = {
    "job_title": 255, "company_name": 255, "industry": 255, "location": 100, "salary_range": 100,
    "job_type": 50, "experience_level": 50, "education_level": 100, "source_agency": 100,
}
