"""Value rules shared by ingestion operators."""

from __future__ import annotations

# What stands for null, compared trimmed and in lower case.
NULL_VALUES = ["", "n/a", "na", "none", "null", "-", "--", "."]

# Fields read as booleans.
BOOLEAN_FIELDS = ["is_active", "is_open", "is_closed", "active", "approved", "verified"]


def lit(value) -> str:
    """A value as SQL; texts with their quotes and backslashes escaped."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return "null" if value is None else str(value).lower() if isinstance(value, bool) else str(value)


def sql_list(values: list[str]) -> str:
    return ", ".join(lit(v) for v in values)


def sanitised(df):
    """df with NaN as null and dates and times as ISO 8601 text, nested values as they are."""
    forms = {"float": "nanvl(`{0}`, null)", "double": "nanvl(`{0}`, null)", "date": "date_format(`{0}`, 'yyyy-MM-dd')"}
    iso = "regexp_replace(date_format(`{0}`, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), '[.]000000$', '')"
    return df.selectExpr(*[(forms | {"timestamp": iso, "timestamp_ntz": iso}).get(t, "`{0}`").format(c) + f" as `{c}`" for c, t in df.dtypes])


def is_null_marker(c: str) -> str:
    return f"lower(trim({c})) in ({sql_list(NULL_VALUES)})"
