"""Records that are the same but for formatting."""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_hexdigest

from tidewell.session import cut, partitions_of, spread

# Attributes of markup that are written without a value.
BARE = "allowfullscreen async autofocus autoplay checked controls default defer disabled hidden loop multiple muted nomodule novalidate open playsinline readonly required reversed selected"
# A tag as the markup grammar has it: a name, then attributes with values or of the few without; "x <y and z> w" holds none.
_TAG = regex.compile(rf"""</[A-Za-z][A-Za-z0-9:-]*\s*>|<[A-Za-z][A-Za-z0-9:-]*(?:\s+(?:[A-Za-z_:@][\w:.@-]*\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'=<>`]+)|(?i:{BARE.replace(" ", "|")})(?=[\s/>])))*\s*/?>|<!--.*?-->""", regex.S)
_ENTITY = regex.compile(r"&(?:#\d+|#[xX][0-9a-fA-F]+|\w+);")
# Letters, digits and marks stay, but those that are never shown: variation selectors, joiners, fillers.
_OTHER = regex.compile(r"(?:[^\p{L}\p{N}\p{M}]|\p{Default_Ignorable_Code_Point})+")
# What parts labelled parts: some marks anywhere, others before a label only, dashes there between white space.
_HARD, _HARD_WRAPPED = (regex.compile(rf"[;|/]+|[,.!?。！？…•·]+(?=\s*{label})|(?<=\s)\p{{Pd}}+(?=\s+{label})") for label in (r"[^\W\d_][^:,;|/\n]{0,40}:", r"[^\W\d_][^:,;|/]{0,40}:"))
_IGNORABLE = regex.compile(r"\p{Default_Ignorable_Code_Point}+")
_LABEL = regex.compile(r"[\W_]*[^\W\d_][^:\n]{0,40}:")
_LABEL_WRAPPED = regex.compile(r"[\W_]*[^\W\d_][^:\n.!?。！？]{0,40}\n[^:\n]{0,40}:")
_UNIT = regex.compile(r"\d\s*\n\s*\p{L}{1,3}\s*\n")
_LABELLED = regex.compile(r"^[\W_]*([^\W\d_][^:\n]{0,40}?)\s*:\s*(\S.*?)\s*$", regex.S)
_SENTENCE = regex.compile(r"[.!?。！？]\s*$")
_ANOTHER = regex.compile(r"[^\W\d_][^:]{0,40}:")


def _letters(text: str) -> str:
    return _OTHER.sub("", text)


def _labelled(parts: list[str]) -> list[regex.Match] | None:
    found = [_LABELLED.match(p) for p in parts if _letters(p)]
    return found if len(found) > 1 and all(found) else None


def _lines(piece: str) -> list[str]:
    """Parts of a piece, parted at the line breaks that a label follows once the part before has label and value; other breaks are white space.

    A line without a colon between two labelled ones could end the value before or begin the label after: it begins the label, unless it is a unit after a number.
    """
    lines = [x for x in piece.split("\n") if x.strip()]
    parts, cur = [], ""
    for k, line in enumerate(lines):
        rest = "\n".join(lines[k : k + 2])
        follows = _LABEL.match(line) or (_LABEL_WRAPPED.match(rest) and not _UNIT.search(f"{cur[-1:]}\n{line}\n"))
        if (follows and _LABELLED.match(cur)) or (":" not in cur and _SENTENCE.search(cur)):
            parts.append(cur)
            cur = line
        else:
            cur = f"{cur} {line}" if cur else line
    return [*parts, cur]


def _labelled_parts(text: str) -> list[regex.Match] | None:
    """Matches of _LABELLED, if the text consists of two or more labelled parts."""
    hard = _HARD.search(text)
    if hard and "\n" in text:  # all parts are parted by other marks, so line breaks are white space
        found = _labelled([p.replace("\n", " ") for p in _HARD_WRAPPED.split(text)])
        if found and not any(_ANOTHER.search(m[2]) for m in found):
            return found
    return _labelled([p for piece in _HARD.split(text) for p in _lines(piece)])


def canonical_text(text: str | None) -> str | None:
    """Letters, marks and digits of a text after markup, entities, case, width and composition are levelled; null if there are no letters or digits.

    A text that consists of labelled parts only ("Name: value", two or more, parted by
    line breaks, ; | / or before a label by commas, end marks and dashes) has its parts sorted. A line break within a label or value is white space.
    """
    if text is None:
        return None
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    for _ in range(2):  # entities may themselves be escaped
        if "&" not in text or not _ENTITY.search(text):
            break
        text = html.unescape(text)
    if "<" in text:
        text = _TAG.sub("\n" if ":" in text else " ", text)
    text = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold()) if not text.isascii() else text.lower()
    if ":" in text:
        text = _IGNORABLE.sub("", text)
        labelled = _labelled_parts(text.replace("\r", "\n"))
        if labelled:
            return "\x1f".join(sorted(f"{_letters(m[1])}\x1e{_letters(m[2])}" for m in labelled))
    return _letters(text) or None


def format_key(text: Column) -> Column:
    """128-bit hash of canonical_text, as hex."""

    @F.pandas_udf("string")
    def key(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            c = canonical_text(t)
            out.append(None if c is None else xxh3_128_hexdigest(c.encode("utf-8", "surrogatepass")))
        return pd.Series(out, dtype=object)

    return key(text)


def collapse(rows: DataFrame, scope: list[str], text: str, ident: str, hot: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(members, sets): members has scope, keep_id, copy_id for every copy; sets has scope, keep_id, n_copies for every different text.

    Copies agree in all of `scope` and in the canonical text; the representative is the smallest ident. Rows with a null in scope or without letters and digits in
    the text are left out, rows repeated with the same ident count once. Empty in, empty out.

    Keys get partial counts; those of `hot` or more records (default: an even
    task's load) are few - at most records / hot - and are told apart exactly. Their records are salted
    and reduced on two levels, and the copies get their representative from the small broadcast result; all other keys
    take one shuffle, in which a group is bounded by `hot`.
    """
    spark = rows.sparkSession
    ok = F.lit(True)
    for c in scope:
        ok = ok & F.col(c).isNotNull()
    texts = spread(rows.where(ok & F.col(text).isNotNull()).select(*scope, F.col(ident).cast("long").alias("_id"), F.col(text).alias("_text")), "_id", "_text")
    keyed = texts.select(*scope, "_id", format_key(F.col("_text")).alias("_form"))
    keys = cut(keyed.where("_form is not null and _id is not null").select(*scope, "_id", F.md5(F.to_json(F.struct(*scope, "_form"))).alias("_key")), "forms")
    parts = partitions_of(spark)
    hot = hot or max(10_000, keys.count() // (4 * parts))
    is_hot = keys.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= hot).select("_key")
    hot_keys = [r[0] for r in is_hot.collect()]  # at most records / hot, so 4 * parts
    cold = keys
    if hot_keys:
        # bounded as said above; sent as a table, not as a literal list
        marks = spark.createDataFrame([(k,) for k in hot_keys], "_key string")
        cold = keys.join(F.broadcast(marks), "_key", "left_anti")
    groups = cold.groupBy("_key", *scope).agg(F.sort_array(F.collect_set("_id")).alias("ids"))
    members = groups.where(F.size("ids") > 1).select(*scope, F.element_at("ids", 1).alias("keep_id"), F.explode(F.slice("ids", 2, hot)).alias("copy_id"))
    sets = groups.select(*scope, F.element_at("ids", 1).alias("keep_id"), F.size("ids").cast("long").alias("n_copies"))
    if hot_keys:
        warm = keys.join(F.broadcast(marks), "_key", "left_semi").withColumn("_salt", F.pmod(F.xxhash64("_id"), F.lit(parts)))
        once = warm.distinct()
        salted = once.groupBy("_key", "_salt", *scope).agg(F.min("_id").alias("keep_id"), F.count(F.lit(1)).alias("n_copies"))
        hot_sets = salted.groupBy("_key", *scope).agg(F.min("keep_id").alias("keep_id"), F.sum("n_copies").alias("n_copies"))
        keeps = hot_sets.select("_key", "keep_id")
        members = members.unionByName(once.join(F.broadcast(keeps), "_key").where("_id > keep_id").select(*scope, "keep_id", F.col("_id").alias("copy_id")))
        sets = sets.unionByName(hot_sets.select(*scope, "keep_id", "n_copies"))
    return members, sets
