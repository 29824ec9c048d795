"""Rule files (S13): mappings, keywords, formats and thresholds from JSON or YAML.

A file has up to three sections, each key optional; what it leaves out keeps the default:

    cleaning_rules:  industry_mapping, location_mapping, experience_mapping, education_mapping,
                     salary_extraction: {currency}, currency_rates, salary_keywords, company_suffixes,
                     title_keywords, experience_keywords, education_default, date_formats,
                     basic_date_formats, mode, nfkc
    deduplication:   enabled, fields, similarity_threshold, time_window_days
    data_quality:    required_fields, date_validation, salary_validation, min_salary, max_salary

(``etl`` is accepted and ignored: batch sizes and retries are the scheduler's.) A file that
has an unknown key, a value of the wrong type or out of range, a repeated key, an empty list
of required fields, or a date format that Spark does not take is refused with all that is wrong with it.
Mappings too large for a file are tables: see ``clean.map_values_table``.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import SparkSession

from postwise import rules as R


class RuleError(ValueError):
    """A rule file that is refused; ``problems`` lists why."""

    def __init__(self, problems: list[str]):
        super().__init__("; ".join(problems))
        self.problems = problems


def _texts(v) -> str | None:
    return None if isinstance(v, dict) and all(isinstance(x, str) for x in [*v, *v.values()]) else "not a mapping of texts"


def _numbers(v) -> str | None:
    good = isinstance(v, dict) and all(isinstance(x, (int, float)) and not isinstance(x, bool) and x > 0 for x in v.values())
    return None if good else "not a mapping to positive numbers"


def _lists(v) -> str | None:
    good = isinstance(v, dict) and all(isinstance(x, list) and all(isinstance(y, str) for y in x) for x in v.values())
    return None if good else "not a mapping to lists of texts"


def _list(v) -> str | None:
    return None if isinstance(v, list) and v and all(isinstance(x, str) and x for x in v) else "not a list of texts"


def _text(v) -> str | None:
    return None if isinstance(v, str) else "not a text"


def _flag(v) -> str | None:
    return None if isinstance(v, bool) else "neither true nor false"


def _number(low: float, high: float, whole: bool = False):
    def check(v) -> str | None:
        kinds = int if whole else (int, float)
        good = isinstance(v, kinds) and not isinstance(v, bool) and low <= v <= high
        return None if good else f"not a {'whole ' if whole else ''}number from {low} to {high}"
    return check


def _one_of(*values):
    return lambda v: None if v in values else f"none of {', '.join(values)}"


_MANY = 10 ** 12
#: section -> key -> (field of Rules, check)
KEYS = {
    "cleaning_rules": {
        "industry_mapping": ("industry_mapping", _texts), "location_mapping": ("location_mapping", _texts),
        "experience_mapping": ("experience_mapping", _texts), "education_mapping": ("education_mapping", _texts),
        "currency_rates": ("currency_rates", _numbers), "salary_keywords": ("salary_keywords", _lists),
        "company_suffixes": ("company_suffixes", _list), "title_keywords": ("title_keywords", _texts),
        "experience_keywords": ("experience_keywords", _texts), "education_default": ("education_default", _text),
        "date_formats": ("date_formats", _list), "basic_date_formats": ("basic_date_formats", _list),
        "mode": ("mode", _one_of("fixed", "reference")), "nfkc": ("nfkc", _flag)},
    "deduplication": {
        "enabled": ("dedup_enabled", _flag), "fields": ("dedup_fields", _list),
        "similarity_threshold": ("similarity_threshold", _number(0.05, 1)), "time_window_days": ("time_window_days", _number(0, 36500, True))},
    "data_quality": {
        "required_fields": ("required_fields", _list), "date_validation": ("date_validation", _flag),
        "salary_validation": ("salary_validation", _flag), "min_salary": ("min_salary", _number(0, _MANY)),
        "max_salary": ("max_salary", _number(0, _MANY))},
}
#: Keys of the original's salary section that say nothing here beyond the currency.
_SALARY = {"currency", "default_values"}


def _unique(pairs: list[tuple]) -> dict:
    out = {}
    for k, v in pairs:
        if k in out:
            raise RuleError([f"{k}: given twice"])
        out[k] = v
    return out


def parse_rules(text: str, yaml: bool = False) -> dict:
    """The content of a rule file as a dictionary."""
    try:
        if not yaml:
            return json.loads(text, object_pairs_hook=_unique)
        try:
            import yaml as y
        except ImportError as e:
            raise RuleError(["YAML needs the yaml package; use JSON"]) from e

        class Loader(y.SafeLoader):
            pass

        Loader.add_constructor(y.resolver.BaseResolver.DEFAULT_MAPPING_TAG,
                               lambda ld, node: _unique([(ld.construct_object(k, True), ld.construct_object(v, True)) for k, v in node.value]))
        try:
            return y.load(text, Loader)  # noqa: S506 - a SafeLoader
        except y.YAMLError as e:
            raise RuleError([f"not YAML: {e}"]) from e
    except json.JSONDecodeError as e:
        raise RuleError([f"not JSON: {e}"]) from e


def rules_from(content: dict, base: R.Rules = R.DEFAULT_RULES, spark: SparkSession | None = None) -> R.Rules:
    """Rules of a parsed file; :class:`RuleError` names everything that is wrong with it."""
    problems, values = [], {}
    if not isinstance(content, dict):
        raise RuleError(["no sections"])
    for section, entries in content.items():
        if section == "etl":
            continue
        if section not in KEYS:
            problems.append(f"{section}: unknown section")
            continue
        if not isinstance(entries, dict):
            problems.append(f"{section}: no keys")
            continue
        for key, value in entries.items():
            if section == "cleaning_rules" and key == "salary_extraction":
                unknown = set(value or {}) - _SALARY if isinstance(value, dict) else {"salary_extraction"}
                problems += [f"{section}.{key}.{k}: unknown" for k in sorted(unknown)]
                currency = value.get("currency") if isinstance(value, dict) else None
                if currency is not None:
                    values["currency_default"] = currency
                continue
            if key not in KEYS[section]:
                problems.append(f"{section}.{key}: unknown")
                continue
            name, check = KEYS[section][key]
            wrong = check(value)
            if wrong:
                problems.append(f"{section}.{key}: {wrong}")
            elif key in ("title_keywords", "experience_keywords"):
                values[name] = tuple(value.items())
            else:
                values[name] = tuple(value) if isinstance(value, list) else value
    if not problems:
        out = base.replace(**values)
        if out.min_salary > out.max_salary:
            problems.append("data_quality: min_salary is above max_salary")
        if out.currency_default not in out.currency_rates:
            problems.append(f"cleaning_rules.salary_extraction.currency: {out.currency_default} has no rate")
        if spark is not None:
            problems += _bad_formats(spark, [*out.date_formats, *out.basic_date_formats])
    if problems:
        raise RuleError(problems)
    return out


def _bad_formats(spark: SparkSession, formats: list[str]) -> list[str]:
    from pyspark.errors import PySparkException
    from pyspark.sql import functions as F
    bad = []
    for f in dict.fromkeys(formats):
        try:
            spark.range(1).select(F.try_to_timestamp(F.lit("1/1/2024"), F.lit(f))).collect()
        except PySparkException:
            bad.append(f"date format {f}: not taken by Spark")
    return bad


def load_rules(spark: SparkSession, path: str, base: R.Rules = R.DEFAULT_RULES) -> R.Rules:
    """Rules from a file of the driver, or on any store that Spark reads (.yaml and .yml: YAML, else JSON)."""
    if os.path.isfile(path):
        with open(path, encoding="utf-8") as f:
            text = f.read()
    else:
        row = spark.read.text(path, wholetext=True).first()
        text = row[0] if row else ""
    return rules_from(parse_rules(text, path.endswith((".yaml", ".yml"))), base, spark)
