"""Sinks: tables, standard outputs, reports, lines for other systems."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.operators.corpus import jsonl
from tidewell.operators.synonyms import solr_lines

FORMATS = ("parquet", "json", "csv")


def write(df: DataFrame, folder: str, name: str, form: str = "parquet", mode: str = "overwrite", single: bool = False) -> str:
    """Write a table to folder/name.form; csv with header. single puts a small result into one file."""
    if form not in FORMATS:
        raise ValueError(f"format {form!r} isn't one of {', '.join(FORMATS)}")
    path = f"{folder.rstrip('/')}/{name}.{form}"
    writer = (df.coalesce(1) if single else df).write.mode(mode)
    (writer.option("header", True) if form == "csv" else writer).format(form).save(path)
    return path


def write_all(tables: dict[str, DataFrame | None], folder: str, form: str = "parquet") -> dict[str, str]:
    """Write the tables that aren't None; arrays and structs become JSON in csv."""
    out = {}
    for name, df in tables.items():
        if df is None:
            continue
        if form == "csv":
            df = df.select([F.to_json(c).alias(c) if t.startswith(("array", "struct", "map")) else F.col(c) for c, t in df.dtypes])
        out[name] = write(df, folder, name, form)
    return out


def write_lines(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """One JSON object a line, all fields in fixed order, nulls kept."""
    jsonl(df, columns).write.mode("overwrite").text(path)


def profile_rows(df: DataFrame, declared: list[str], inferred: list[str]) -> DataFrame:
    """Declared columns with the inferred dimensions laid over them, also where these are null."""
    return df.select(*(c for c in declared if c in df.columns and c not in inferred), *(c for c in inferred if c in df.columns))


def write_solr(groups: DataFrame, folder: str, header: str | None = None) -> None:
    """ext_synonyms.txt: a line a group; ext_dict.txt: all tokens, sorted. Both are bounded by the search engine's limit of groups, so each is one file."""
    lines = solr_lines(groups).select(F.lit(1).alias("part"), "value")
    head = groups.sparkSession.createDataFrame([(0, f"# {x}") for x in (header or "").splitlines()], "part int, value string")
    head.unionByName(lines).orderBy("part", "value").select("value").coalesce(1).write.mode("overwrite").text(f"{folder}/ext_synonyms.txt")
    groups.select(F.explode("variants").alias("value")).distinct().orderBy("value").coalesce(1).write.mode("overwrite").text(f"{folder}/ext_dict.txt")


def report(metrics: dict, path: str, df: DataFrame) -> None:
    """A small report as JSON with the time it was made, written through the session so that any file system serves."""
    text = json.dumps(metrics | {"generated_at": datetime.now(timezone.utc).isoformat()}, ensure_ascii=False, default=str)
    df.sparkSession.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
