"""Command line: tidewell <command> --config file.json. The configuration may be YAML where a YAML library is installed."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import functions as F

from tidewell import models, sinks, sources
from tidewell.analytics import audit, detectors, reviews
from tidewell.operators import corpus, synonyms, tags
from tidewell.plans import corpora
from tidewell.plans.pipeline import Pipeline
from tidewell.sources import warehouse


def load_config(path: str, overrides: list[str] | None = None) -> dict:
    """A configuration file, with name.part=value overrides laid over it; values are JSON where they parse."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith((".yml", ".yaml")):
        import yaml  # optional

        config = yaml.safe_load(text)
    else:
        config = json.loads(text)
    for o in overrides or []:
        name, _, value = o.partition("=")
        at = config
        *path_, last = name.split(".")
        for p in path_:
            at = at.setdefault(p, {})
        try:
            at[last] = json.loads(value)
        except ValueError:
            at[last] = value
    return config


def _tables(spark, config: dict) -> dict:
    if config.get("input"):
        return warehouse.intermediate(spark, config["input"], config.get("input_format", "parquet"))
    s = sources.create(config["source"]["name"], spark, config["source"].get("config"))
    s.validate_config()
    return {t: s.get(t) for t in ("users", "items", "interactions", "co_occurrence")}


def ingest(spark, config: dict) -> dict:
    """Read a source and write the four tables."""
    return sinks.write_all(_tables(spark, config), config["output"], config.get("format", "parquet"))


def run(spark, config: dict) -> dict:
    """Clean, normalise and write; gives the row counts of the steps."""
    t = _tables(spark, config)
    pipe = Pipeline(config.get("pipeline", {}))
    out = pipe.process(t["users"], t["items"], t["interactions"], t["co_occurrence"])
    sinks.write_all(out, config["output"], config.get("format", "parquet"))
    return pipe.step_counts()


def analyze(spark, config: dict) -> dict:
    """Run the review analyzers and write each result; failures are told, not raised."""
    rows = spark.read.format(config.get("input_format", "json")).load(config["input"])
    plans, errors = reviews.run_all(reviews.derive(rows), config.get("analyzers"))
    written = []
    for name, df in plans.items():
        try:
            sinks.write(reviews.shown(name, df), config["output"], name, "csv", single=True)
            written.append(name)
        except Exception as e:  # noqa: BLE001  one analyzer's failure while it runs doesn't end the others
            errors[name] = str(e)
    return {"written": sorted(written), "errors": errors}


def campaign(spark, config: dict) -> dict:
    """Detect campaigns, write the flags and the summary."""
    t = _tables(spark, config)
    found = {}
    for name, options in config["detectors"].items():
        args = (t["interactions"], t["items"]) if name == "geo_mismatch" else (t["interactions"],)
        found[name] = detectors.DETECTORS[name](*args, **options)
    items = detectors.score_items(*(d for n, d in found.items() if n != "user_velocity_anomaly"))
    out = {"item_flags": items}
    if "user_velocity_anomaly" in found:
        out["user_flags"] = detectors.score_users(found["user_velocity_anomaly"])
    return sinks.write_all(out, config["output"], config.get("format", "csv"))


def check(spark, config: dict) -> dict:
    """Audit the tables."""
    return audit.audit({k: v for k, v in _tables(spark, config).items() if v is not None}, config.get("audit", {}))


def _lines(spark, path: str):
    return spark.read.json(path)


def tables_meta(spark, config: dict) -> dict:
    """Read table descriptions from a script and write them as lines."""
    with open(config["script"], encoding="utf-8") as f:
        metas = warehouse.parse_ddl(f.read())
    rows = [(m.db, m.name, m.role, json.dumps(m.columns, ensure_ascii=False), sorted(m.partition_keys)) for m in metas]
    df = spark.createDataFrame(rows, "db string, name string, role string, columns string, partition_keys array<string>")
    sinks.write_lines(df, f"{config['output']}/tables_meta.jsonl")
    return {"tables": len(rows)}


def extract_tags(spark, config: dict) -> dict:
    """Vocabularies of the observed columns {dim: {path, column}} against a dictionary (dim, value): differences and snapshot."""
    known = _lines(spark, config["dictionary"]).select("dim", "value")
    observed = {d: warehouse_rows(spark, o).select(F.col(o["column"]).alias("value"), F.lit(d).alias("source")) for d, o in config["observed"].items()}
    out, found = {}, tags.extract(observed, known, config.get("frequency_min", 10))
    for dim, parts in found.items():
        sinks.write_lines(parts["diff"], f"{config['output']}/{dim}_diff.jsonl")
        seen = parts["values"].select(F.lit(dim).alias("dim"), "value", "frequency")
        sinks.write_lines(tags.snapshot(seen, known.unionByName(parts["diff"].where("status = 'added'").select(F.lit(dim).alias("dim"), "value")), dim), f"{config['output']}/{dim}_snapshot.jsonl")
        out[dim] = _lines(spark, f"{config['output']}/{dim}_snapshot.jsonl").count()
    return out


def warehouse_rows(spark, source: dict):
    """Rows of a file: {path, format}; CSV with header."""
    form = source.get("format", "parquet")
    reader = spark.read.format(form)
    return (reader.option("header", True).option("sep", source.get("delimiter", ",")) if form == "csv" else reader).load(source["path"])


def enrich(spark, config: dict) -> dict:
    """Tag items {path, key, name} with a registered client; writes item_tags, rejected values and the state for the next run."""
    o = config["items"]
    state = spark.read.parquet(config["state"]) if config.get("state") else None
    out = corpora.enrich(warehouse_rows(spark, o), o["key"], o["name"], _lines(spark, config["dictionary"]), models.client(config.get("client", "offline")), state, config.get("raw"), config.get("versions"))
    for name in ("tags", "rejected", "coverage"):
        sinks.write_lines(out[name], f"{config['output']}/item_{name}.jsonl")
    sinks.write(out["state"], config["output"], "state")
    return {r: out[r].count() for r in ("tags", "rejected")} | {"coverage": out["coverage"].first().asDict()}


def sft(spark, config: dict) -> dict:
    """Dialogues of tagged items: corpus, errors, summary and warnings."""
    out = corpora.dialogues(_lines(spark, config["input"]), config.get("key", "item_id"), config.get("count_per_item", 8), config.get("max_message_turns", 9), config.get("templates"))
    sinks.write_lines(out["corpus"].drop("seq"), f"{config['output']}/sft_corpus.jsonl")
    sinks.write_lines(out["errors"], f"{config['output']}/errors.jsonl")
    sinks.write_lines(out["summary"], f"{config['output']}/summary.jsonl")
    return {"samples": out["corpus"].count(), "errors": out["errors"].count(), "warnings": sorted(r[0] for r in out["warnings"].collect())}


def generate_synonyms(spark, config: dict) -> dict:
    """Synonym groups of pairs {path, canonical, variant}, and a client's answers for their names if one is named; the search engine's files."""
    p = config["pairs"]
    rows = warehouse_rows(spark, p)
    anti = warehouse_rows(spark, config["antonyms"]) if config.get("antonyms") else spark.createDataFrame([], "a string, b string")
    make = models.client(config["client"]) if config.get("client") else None
    out = corpora.synonym_run([synonyms.groups_from_pairs(rows, p["canonical"], p["variant"], "rule")], anti, rows.select(F.col(p["canonical"]).alias("name")).distinct(), make)
    sinks.write_solr(out["groups"], config["output"], config.get("header"))
    return out["stats"].first().asDict() | {"checks": {r.check: r.passed for r in out["checks"].collect()}}


def split(spark, config: dict) -> dict:
    """train, val and test lines of a corpus, by the item's hash."""
    rows = corpus.split(_lines(spark, config["input"]), config.get("key", "item_id"))
    for part in ("train", "val", "test"):
        sinks.write_lines(rows.where(F.col("split") == part).drop("split"), f"{config['output']}/{part}.jsonl")
    return {r[0]: r[1] for r in rows.groupBy("split").count().collect()}


def verify(spark, config: dict) -> dict:
    """The self-check of a corpus, and of the tags if they are named."""
    rows = _lines(spark, config["input"])
    flat = F.from_json(F.to_json("params"), "map<string,array<struct<op:string,values:array<string>>>>")  # lines read maps as structs
    tagged = _lines(spark, config["tags"]) if config.get("tags") else None
    return {r.check: r.passed for r in corpora.verify(rows.withColumn("params", flat), config.get("key", "item_id"), tagged).collect()}


def everything(spark, config: dict) -> dict:
    """The stages that the configuration has sections for, in order."""
    return {name: COMMANDS[name](spark, config[name]) for name in ("tables_meta", "extract_tags", "enrich", "sft", "split", "generate_synonyms", "verify") if name in config}


COMMANDS = {f.__name__: f for f in (ingest, run, analyze, campaign, check, tables_meta, extract_tags, enrich, sft, generate_synonyms, split, verify, everything)}


def main(argv: list[str] | None = None, spark=None) -> int:
    p = argparse.ArgumentParser(prog="tidewell")
    p.add_argument("command", choices=sorted(COMMANDS))
    p.add_argument("--config", required=True)
    p.add_argument("--set", action="append", default=[], metavar="name.part=value")
    a = p.parse_args(argv)
    if spark is None:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.getOrCreate()
    result = COMMANDS[a.command](spark, load_config(a.config, a.set))
    print(json.dumps(result, ensure_ascii=False, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
