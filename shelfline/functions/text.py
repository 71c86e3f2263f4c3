"""Text clean-up, identifiers and URL parts."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Fixed value: what a NULL field contributes to a surrogate key. Keys only match
# those already stored elsewhere if this text is kept as it is.
NULL_KEY_TOKEN = "_dbt_utils_surrogate_key_null_"


def collapse_spaces(value: Column) -> Column:
    """Every run of Unicode white space becomes one blank; text of printable ASCII and single blanks, as most is, stays as it is."""
    return F.when(value.rlike("[^!-~ ]|  "), F.regexp_replace(value, r"(?U)\s+", " ")).otherwise(value)


def tidy(value: Column) -> Column:
    return F.trim(collapse_spaces(value))


def store_label(value: Column) -> Column:
    return F.lower(tidy(value))


def supplier_label(value: Column) -> Column:
    return F.upper(tidy(value))


def level_label(value: Column) -> Column:
    """Category, department, sub-department and section names."""
    return F.upper(F.trim(value))


def is_focus_supplier(value: Column, pattern: str) -> Column:
    return F.when(F.upper(value).like(pattern), 1).otherwise(0)


def key_text(value: Column) -> Column:
    """A number as it stands in keys: two decimals, and more only where they are not zero."""
    return F.regexp_replace(value.cast("string"), r"(\.[0-9]{2}[0-9]*?)0+$", "$1")


def surrogate_key(*parts: Column, null_as_empty: bool = False) -> Column:
    """MD5 over the text of the parts, joined by a hyphen."""
    missing = F.lit("" if null_as_empty else NULL_KEY_TOKEN)
    return F.md5(F.concat_ws("-", *[F.coalesce(p.cast("string"), missing) for p in parts]))


def column_name(name: str) -> str:
    """Header clean-up: no outer blanks, underscores for blanks and hyphens."""
    return re.sub(r"[ -]", "_", name.strip())


def slug(name: str) -> str:
    """Identifier made from free text."""
    text = re.sub(r"[ -]+", "_", name.lower())
    text = re.sub(r"[^a-z0-9_]+", "", text)
    return f"_{text}" if text[:1].isdigit() else text


def slug_column(value: Column) -> Column:
    """The same clean-up over a column of names."""
    text = F.regexp_replace(F.lower(value), "[ -]+", "_")
    text = F.regexp_replace(text, "[^a-z0-9_]+", "")
    return F.regexp_replace(text, "^([0-9])", "_$1")


def _without(value: Column, *schemes: str) -> Column:
    for scheme in schemes:
        value = F.replace(value, F.lit(scheme), F.lit(""))
    return value


def _piece(value: Column, delimiter: str, number: int) -> Column:
    return F.split_part(value, F.lit(delimiter), F.lit(number))


def url_host(url: Column) -> Column:
    """Host name; works without a scheme and for Android app links."""
    bare = _without(url, "android-app://", "http://", "https://")
    return _piece(_piece(bare, "/", 1), "?", 1)


def url_path(url: Column) -> Column:
    """Text after the first slash up to the query string; '' when there is none."""
    bare = _without(url, "http://", "https://")
    slash = F.locate("/", bare)
    tail = F.when(slash > 0, F.substr(bare, slash + 1)).when(bare.isNotNull(), F.lit(""))
    return _piece(tail, "?", 1)


def url_parameter(url: Column, parameter: str) -> Column:
    """Value of one query parameter, NULL when absent or empty."""
    value = _piece(_piece(url, f"{parameter}=", 2), "&", 1)
    return F.when(value != "", value)
