"""The pipeline: configured filters, cascade, normalizers, sequences, related items.

The plan is built step by step. Steps that run jobs while the plan is built (run-length
deduplication, k-core) get a table in the shared folder, written once before the first of them, so that the steps before
run once; the rest runs at the sink. Row counts of the steps come from observations of those runs, not from a job a step.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidewell.contracts import check_contract
from tidewell.functions import predicates, text
from tidewell.operators import behaviour, dedup, filters, sequences
from tidewell.session import cut

#: Steps that run jobs over what is before them.
EAGER = ("user_item", "kcore")

#: Order of the interaction filters by preset; k-core is last of those that count rows, as no other step may follow it without changing its result.
ORDERS = {
    "default": ("completeness", "product_exists", "time", "rules", "dedup", "burst", "user_item", "campaign", "kcore"),
    "four_step": ("completeness", "outlier", "time", "rules", "dedup", "burst", "user_item", "text_length", "spam", "quality", "campaign", "kcore", "product_exists"),
    "legacy_review": ("completeness", "outlier", "quality", "spam", "time", "length", "dedup", "burst", "user_product", "kcore"),
}


@dataclass
class Pipeline:
    """config: preset, filters {name: {enabled, ...}}, user_rules, item_rules, normalizers {table: [...]}, sequences {enabled, most}. Unknown sections are an error, as a misspelt one would be ignored silently."""

    config: dict = field(default_factory=dict)
    observations: dict[str, Observation] = field(default_factory=dict)
    KNOWN = ("preset", "filters", "user_rules", "item_rules", "normalizers", "sequences", "as_of")

    def __post_init__(self):
        unknown = set(self.config) - set(self.KNOWN)
        if unknown:
            raise ValueError(f"unknown sections {sorted(unknown)}; known are {', '.join(self.KNOWN)}")
        if self.config.get("preset", "default") not in ORDERS:
            raise ValueError(f"preset is one of {', '.join(ORDERS)}")

    def watch(self, df: DataFrame, name: str) -> DataFrame:
        o = Observation(f"step_{len(self.observations)}_{name}")
        self.observations[name] = o
        return df.observe(o, F.count(F.lit(1)).alias("rows"))

    def steps(self) -> list[str]:
        """The filters that will run, in order; a filter with enabled = false doesn't."""
        chosen = self.config.get("filters", {})
        return [s for s in ORDERS[self.config.get("preset", "default")] if s in chosen and chosen[s].get("enabled", True)]

    def filter(self, df: DataFrame, items: DataFrame | None = None, item_flags: DataFrame | None = None, user_flags: DataFrame | None = None) -> DataFrame:
        legacy, as_of = self.config.get("preset") == "legacy_review", self.config.get("as_of")
        for step in self.steps():
            c = {k: v for k, v in self.config["filters"][step].items() if k != "enabled"}
            if step in EAGER:
                df = cut(df, "steps")
            if step == "completeness":
                df = filters.field_completeness(df, tuple(c.get("required_fields", ("user_id", "item_id", "timestamp"))))
            elif step == "product_exists" and items is not None:
                df = filters.known_keys(df, items)
            elif step == "time":
                df = filters.recent(df, c.get("years", 10), as_of=as_of)
            elif step == "outlier":
                df = filters.outliers(df, c.get("min_rating", 1), c.get("max_rating", 5), c.get("min_year", 1990), as_of=as_of, bound_above=legacy)
            elif step == "rules":
                df = predicates.dynamic_filter(df, c)
            elif step == "dedup":
                df = dedup.deduplicate(df, c.get("key"), c.get("order_by"))
            elif step == "burst":
                df = behaviour.drop_bursts(df, c.get("time_window_minutes", 10), c.get("max_reviews", 50), exact=c.get("exact", False))
            elif step == "user_item":
                df = dedup.drop_repeats(df, keep=c.get("keep", "first"))
            elif step == "user_product":
                df = dedup.drop_all_repeats(df, keep=c.get("keep", "first"))
            elif step in ("quality", "text_length"):
                df = filters.min_length(df, c.get("text_column", "review_text"), c.get("min_text_length", 10 if step == "quality" else 5), trim=legacy or step == "text_length")
            elif step == "length":
                df = filters.max_length(df, c.get("text_column", "review_text"), c.get("max_length", 700))
            elif step == "spam":
                df = filters.spam(df, tuple(c["text_columns"]) if "text_columns" in c else (c["text_column"],) if "text_column" in c else ("review_text", "review_title"), patterns=c.get("patterns"), fold_case=legacy)
            elif step == "campaign":
                df = behaviour.campaign_filter(df, item_flags, user_flags, **c)
            elif step == "kcore":
                df = behaviour.k_core(df, c.get("k", 5))
            df = self.watch(df, step)
        return df

    def process(self, users: DataFrame | None, items: DataFrame | None, interactions: DataFrame, co_occurrence: DataFrame | None = None, **flags: DataFrame) -> dict[str, DataFrame | None]:
        check_contract(interactions, "interactions")
        inter = self.filter(self.watch(interactions, "input"), items, **flags)
        if users is not None and self.config.get("user_rules"):
            users = predicates.dynamic_filter(users, self.config["user_rules"])
        if items is not None and self.config.get("item_rules"):
            items = predicates.dynamic_filter(items, self.config["item_rules"])
        users, items = filters.cascade(users, items, inter)
        out = {"users": users, "items": items, "interactions": inter}
        for name, steps in self.config.get("normalizers", {}).items():
            if out.get(name) is not None:
                out[name] = text.normalize(out[name], steps)
        seq = self.config.get("sequences", {})
        if seq.get("enabled", True):
            out["user_interaction_seq"] = sequences.user_sequences(out["interactions"], most=seq.get("most"))
        if co_occurrence is not None and items is not None:
            out["co_occurrence"] = sequences.clean_related(co_occurrence, items)
        return out

    def step_counts(self) -> dict[str, int]:
        """Rows after each step, once the plan has run."""
        return {name: o.get["rows"] for name, o in self.observations.items()}


def cleaning_report(before: DataFrame, after: DataFrame, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """(stage, rows, users, items, kept_pct) of the frames before and after cleaning."""
    one = lambda d, s: d.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(user).alias("users"), F.countDistinct(item).alias("items")).withColumn("stage", F.lit(s))
    both = one(before, "before").unionByName(one(after, "after"))
    first = one(before, "before").select(F.col("rows").alias("_all"), F.lit(1).alias("_k"))
    return both.withColumn("_k", F.lit(1)).join(F.broadcast(first), "_k").select("stage", "rows", "users", "items", F.round(F.coalesce(F.try_divide(F.col("rows") * 100.0, "_all"), F.lit(0.0)), 2).alias("kept_pct"))
