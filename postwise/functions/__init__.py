"""Column -> Column functions (text, salary, dates). All JVM-side."""

from postwise.functions.text import (  # noqa: F401
    ascii_digits, blank_strip, education_band, experience_band, nfkc, normalize_text,
    split_location, standardize_company, standardize_title, title_case,
)
from postwise.functions.salary import (  # noqa: F401
    has_salary, parse_salary, salary_avg, salary_range, to_usd, with_parsed_salary, with_salary_range,
)
from postwise.functions.dates import (  # noqa: F401
    parse_date, parse_date_or, time_attributes, week_mode1,
)
