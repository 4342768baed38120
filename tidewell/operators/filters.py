"""Row filters. Each returns its input with a warning if its column is missing."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.contracts import has, not_blank

# Patterns of the review cleaner (matched in lower case, in text and title).
SPAM_REVIEW = [r"click\s*here", r"buy\s*now", r"limited\s*time", r"act\s*now", r"order\s*now", r"free\s*gift", r"special\s*offer", r"don'?t\s*miss", r"weight\s*loss", r"male\s*enhancement", "casino", "bitcoin", "cryptocurrency", r"make\s*money\s*fast", r"work\s*from\s*home", "http[s]?://", r"www\.", r"\.com\s*$", r"\.net\s*$", r"\.org\s*$"]
# Patterns of the four-step cleaner (case counts); a plus sign before a number is meant literally.
SPAM_FOUR_STEP = [r"click\s*here", r"buy\s*now", r"limited\s*time", r"act\s*now", r"order\s*now", r"free\s*trial", "100%\\s*free", r"make\s*money", r"earn\s*cash", r"work\s*from\s*home", "viagra", "casino", r"crypto\s*giveaway", r"telegram\s*@\w+", r"whatsapp\s*\+\d+"]
DAY = 86_400


def _seconds(as_of: int | None) -> int:
    return int(datetime.now(timezone.utc).timestamp()) if as_of is None else as_of


def field_completeness(df: DataFrame, required: tuple[str, ...] = ("user_id", "item_id", "timestamp")) -> DataFrame:
    """Rows with all required fields; a text must not be ''. Fields that df lacks are ignored."""
    for c in required:
        if c in df.columns:
            df = df.where(not_blank(df, c))
    return df


def recent(df: DataFrame, years: float = 10, column: str = "timestamp", as_of: int | None = None) -> DataFrame:
    """Rows of the last years * 365 days before as_of (unix seconds, default now); null times go."""
    if not has(df, column, what="recent"):
        return df
    return df.where(F.col(column) >= _seconds(as_of) - int(years * 365) * DAY)


def min_length(df: DataFrame, column: str = "review_text", least: int = 10, trim: bool = False) -> DataFrame:
    """Rows whose text has at least so many characters (after trimming, if asked); null goes."""
    if not has(df, column, what="min_length"):
        return df
    c = F.trim(F.col(column)) if trim else F.col(column)
    return df.where(F.length(c) >= least)


def max_length(df: DataFrame, column: str = "review_text", most: int = 700) -> DataFrame:
    """Rows whose text has at most so many characters; null goes."""
    return df.where(F.length(column) <= most) if has(df, column, what="max_length") else df


def outliers(df: DataFrame, min_rating: float = 1, max_rating: float = 5, min_year: int = 1990, rating: str = "rating", time: str = "timestamp", as_of: int | None = None, bound_above: bool = True) -> DataFrame:
    """Rows with rating and time in range; a missing column is not checked. bound_above: times after as_of go too."""
    if rating in df.columns:
        df = df.where(F.col(rating).between(min_rating, max_rating))
    if time in df.columns:
        df = df.where(F.col(time) >= int(datetime(min_year, 1, 1, tzinfo=timezone.utc).timestamp()))
        if bound_above:
            df = df.where(F.col(time) <= _seconds(as_of))
    return df


def spam(df: DataFrame, columns: tuple[str, ...] = ("review_text", "review_title"), patterns: list[str] | None = None, fold_case: bool = True) -> DataFrame:
    """Rows in which no pattern is found, one regex a column. The first column is needed; null texts go."""
    if not has(df, columns[0], what="spam"):
        return df
    one = "|".join(f"(?:{p})" for p in patterns or SPAM_REVIEW)
    for c in columns:
        if c in df.columns:
            df = df.where(~(F.lower(c) if fold_case else F.col(c)).rlike(one))
    return df


def known_keys(df: DataFrame, keys: DataFrame, column: str = "item_id") -> DataFrame:
    """Rows whose key is in `keys` (left semi join; null keys go)."""
    if not (has(df, column, what="known_keys") and has(keys, column, what="known_keys")):
        return df
    return df.join(keys.select(column).distinct(), column, "left_semi")


def blank_keys(df: DataFrame, columns: tuple[str, ...] = ("user_id", "item_id")) -> DataFrame:
    """Rows without a null or '' key."""
    return field_completeness(df, columns)


def cascade(users: DataFrame | None, items: DataFrame | None, interactions: DataFrame) -> tuple[DataFrame | None, DataFrame | None]:
    """Users and items that still occur in the interactions; their own repeats stay."""
    return (users and known_keys(users, interactions, "user_id")), (items and known_keys(items, interactions, "item_id"))
