"""Text normalizers as column expressions. Built-in functions throughout; a Python function (Arrow batches) only where
Spark has none: full HTML entities and Unicode composition, each run only on texts that need it."""

from __future__ import annotations

import html
import re
import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.contracts import has, log

# Entities decoded in arrays, in this order.
ENTITIES = [("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " ")]


@F.pandas_udf(T.StringType())
def _unescape(s: pd.Series) -> pd.Series:
    return s.map(lambda v: v if v is None else html.unescape(v))


@F.pandas_udf(T.StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda v: v if v is None else unicodedata.normalize("NFC", v))


def strip_html(c: Column) -> Column:
    """Entities decoded, then tags removed; so an escaped tag goes too."""
    decoded = F.when(c.contains("&"), _unescape(c)).otherwise(c)
    return F.regexp_replace(decoded, "<[^>]+>", "")


def strip_html_basic(c: Column) -> Column:
    """strip_html for texts with the six common entities only; all in the JVM."""
    return F.regexp_replace(reduce(lambda x, e: F.replace(x, F.lit(e[0]), F.lit(e[1])), ENTITIES, c), "<[^>]+>", "")


def strip_html_array(c: Column) -> Column:
    """Per element: tags removed, six entities decoded in order, white space collapsed, trimmed; empty elements go, null stays null."""

    def one(x: Column) -> Column:
        x = reduce(lambda y, e: F.replace(y, F.lit(e[0]), F.lit(e[1])), ENTITIES, F.regexp_replace(x, "<[^>]+>", ""))
        return F.trim(F.regexp_replace(x, r"(?U)\s+", " "))

    return F.filter(F.transform(c, one), lambda x: x.isNotNull() & (x != ""))


def lowercase(c: Column) -> Column:
    return F.lower(c)


def special_chars(c: Column, unicode: bool = False) -> Column:
    r"""Other characters than word characters, white space and . , ! ? ' " - become spaces. Word characters are ASCII unless `unicode`."""
    return F.regexp_replace(c, ("(?U)" if unicode else "") + r"""[^\w\s.,!?'"-]""", " ")


def compose(c: Column) -> Column:
    """Unicode form C; ASCII texts skip the Python function."""
    return F.when(c.rlike(r"[^\x00-\x7F]"), _nfc(c)).otherwise(c)


def whitespace(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def regex_replace(c: Column, rules: list[dict]) -> Column:
    """Rules {pattern, replacement} one after another."""
    return reduce(lambda x, r: F.regexp_replace(x, r["pattern"], r.get("replacement", "")), rules, c)


def regex_extract(c: Column, pattern: str, group: int = 1, remove: str = "", default: str = "") -> Column:
    """The group of the first match without the characters in `remove`; `default` where nothing is left."""
    found = F.regexp_extract(c, pattern, group)
    found = F.translate(found, remove, "") if remove else found
    return F.when((found == "") | found.isNull(), default).otherwise(found)


def valid_pattern(pattern: str) -> bool:
    try:
        re.compile(pattern)
        return True
    except re.error as e:
        log.warning("pattern %r is skipped: %s", pattern, e)
        return False


NORMALIZERS = {"html_normalizer": strip_html, "lowercase_normalizer": lowercase, "special_char_normalizer": special_chars, "unicode_normalizer": compose, "whitespace_normalizer": whitespace}


def normalize(df: DataFrame, config: list[dict]) -> DataFrame:
    """config: {normalizer, columns}, columns being names or {name, pattern, group, remove, default, rules}.

    Rules belong to their own column. A column that is missing or not of text (for
    html also array of text) is skipped; so is an unknown normalizer.
    """
    for step in config:
        kind = step.get("normalizer")
        for spec in step.get("columns", []):
            spec = {"name": spec} if isinstance(spec, str) else spec
            name = spec["name"]
            if not has(df, name, what=str(kind)):
                continue
            c, t = F.col(name), df.schema[name].dataType
            if isinstance(t, T.ArrayType) and isinstance(t.elementType, T.StringType) and kind == "html_normalizer":
                df = df.withColumn(name, strip_html_array(c))
            elif not isinstance(t, T.StringType):
                log.warning("%s doesn't take %s of type %s", kind, name, t.simpleString())
            elif kind == "regex_replace_normalizer":
                df = df.withColumn(name, regex_replace(c, [r for r in spec.get("rules", []) if valid_pattern(r["pattern"])]))
            elif kind == "regex_extract_normalizer":
                if valid_pattern(spec["pattern"]):
                    df = df.withColumn(name, regex_extract(c, spec["pattern"], spec.get("group", 1), spec.get("remove", ""), spec.get("default", "")))
            elif kind in NORMALIZERS:
                df = df.withColumn(name, NORMALIZERS[kind](c))
            else:
                log.warning("normalizer %s is unknown", kind)
    return df
