"""The tables' contracts, and the rule for operators whose column is missing."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger("tidewell")

USERS = ("user_id",)
ITEMS = ("item_id",)
INTERACTIONS = ("user_id", "item_id", "timestamp", "action")
CO_OCCURRENCE = ("item_id", "related_items")
CONTRACTS = {"users": USERS, "items": ITEMS, "interactions": INTERACTIONS, "co_occurrence": CO_OCCURRENCE}

REVIEW_NEW = "rating float, title string, text string, images string, asin string, parent_asin string, user_id string, timestamp long, helpful_vote int, verified_purchase string"
REVIEW_OLD = "overall float, summary string, reviewText string, reviewerID string, asin string, unixReviewTime int, verified string, reviewerName string, reviewTime string"
IMPRESSION_LOG = "impression_id string, user_id string, item_id string, position int, timestamp long, scene string, request_id string, is_clicked int, store_id string, ext string"
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def has(df: DataFrame, *columns: str | None, what: str = "operator") -> bool:
    """Whether df has all columns; if not, the operator warns and returns its input."""
    missing = [c for c in columns if c and c not in df.columns]
    if missing:
        log.warning("%s is skipped: no column %s", what, ", ".join(missing))
    return not missing


def check_contract(df: DataFrame, name: str) -> DataFrame:
    """df itself, or ValueError if a required column of the table is missing. Extra columns pass."""
    missing = [c for c in CONTRACTS[name] if c not in df.columns]
    if missing:
        raise ValueError(f"{name} lacks {missing}; it has {df.columns}")
    return df


def align(df: DataFrame, ddl: str) -> DataFrame:
    """df with exactly the columns of ddl: matched without regard to case, cast (what doesn't cast is null), missing ones null, others dropped."""
    have = {c.lower(): c for c in df.columns}
    schema = T._parse_datatype_string(ddl)
    return df.select([(F.col(have[f.name.lower()]).try_cast(f.dataType) if f.name.lower() in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema])


def not_blank(df: DataFrame, column: str):
    """Not null, and for text not ''. Only text is compared with ''."""
    c = F.col(column)
    return c.isNotNull() & (c != "") if isinstance(df.schema[column].dataType, T.StringType) else c.isNotNull()
