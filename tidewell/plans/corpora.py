"""The training-data runs put together: vocabularies, enrichment, dialogues, synonyms, splits, self-check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell import models
from tidewell.operators import corpus, synonyms, tags
from tidewell.session import cut

#: The prompt of the tagger; {name} and the hints are filled in.
PROMPT = "Give JSON with category, consumable_type, brand, avg_prc, occasion, taste of the item {name}. It may be of category {category} and brand {brand}."
#: Templates of dialogues by scenario, for runs without a model.
TEMPLATES = {"direct": ["I want {brand}", "Is there {brand} nearby?"], "vague": ["Something of {category}, please", "Any good {category}?"], "gift": ["A gift from {brand} for a friend"]}
SCENARIOS = {"direct": 0.5, "vague": 0.3, "gift": 0.2}
#: Shares of intents of planned samples.
PLANNED = {"search_item": 0.4, "search_product": 0.2, "use_coupon": 0.1, "pay": 0.1, "view_order": 0.1, "browse": 0.1}


def constrain(df: DataFrame, key: str, dictionary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(df with the tags that the dictionary (dim, value) holds, rejected (key, dim, value)). A join, so dictionaries of any size do. Dimensions the dictionary lacks altogether stay as they are."""
    known = dictionary.select("dim", "value").distinct()
    dims = [r[0] for r in known.select("dim").distinct().collect() if r[0] in tags.DIMENSIONS and r[0] in df.columns]  # the dimensions, seven at most
    flat = tags.tag_rows(df.select(key, *dims), key)
    kept = flat.join(known, ["dim", "value"], "left_semi")
    back = kept.groupBy(key).agg(*((F.sort_array(F.collect_set(F.when(F.col("dim") == d, F.col("value")))) if d in tags.ARRAYS else F.max(F.when(F.col("dim") == d, F.col("value")))).alias(d) for d in dims)) if dims else flat.select(key).distinct()
    out = df.drop(*dims).join(back, key, "left")
    out = out.withColumns({d: F.when(F.size(d) > 0, F.col(d)) for d in dims if d in tags.ARRAYS})
    return out.select(df.columns), flat.join(known, ["dim", "value"], "left_anti").select(key, "dim", "value")


def enrich(items: DataFrame, key: str, name: str, dictionary: DataFrame, make: Callable = models.offline, state: DataFrame | None = None, raw: dict[str, list[str]] | None = None, versions: dict[str, str] | None = None, hints: bool = True, retries: int = 3) -> dict[str, DataFrame]:
    """Tags of items: hints from the name, prompt, answer, dictionary, hints where nothing was answered, origin of each tag.

    Gives tags (with tag_source and the answer's error), rejected values, coverage and the new state. With a state only new and changed
    items, or those made with other versions, are asked about; the others keep their row in the state. Items without key are left out.
    """
    items = items.where(F.col(key).isNotNull())
    columns = [c for c in items.columns if c != key]
    todo = tags.changed(items, state, key, columns, versions) if state is not None else items.withColumn("record_hash", tags.record_hash(items, columns)).withColumns({k: F.lit(v) for k, v in (versions or {}).items()})
    for dim in ("category", "brand"):
        values = dictionary.where(F.col("dim") == dim).select(F.col("value").alias(f"_{dim}"))
        todo = todo.join(tags.infer_longest(items, key, name, values, f"_{dim}"), key, "left")
    asked = models.complete(todo.withColumn("_prompt", models.fill(PROMPT, name=F.col(name), category=F.col("_category"), brand=F.col("_brand"))), "_prompt", make, "_answer", retries)
    asked = cut(asked, "answers")  # a model is asked once, however many branches read its answers
    parsed = asked.withColumn("_t", tags.parse_answer(F.coalesce("_answer", F.lit("{}"))))
    own = [d for d in tags.DIMENSIONS if d not in items.columns]
    found = parsed.select(key, *columns, "record_hash", *(versions or {}), "_category", "_brand", F.col("_answer_error").alias("answer_error"), *(F.col(f"_t.{d}").alias(d) for d in own))
    found, rejected = constrain(found, key, dictionary)
    found = found.withColumns({d: tags.fill_with_hints(F.col(d), F.col(f"_{d}"), hints) for d in ("category", "brand") if d in own}).drop("_category", "_brand")
    done = cut(tags.assemble(found, raw or {}), "tags")
    marks = done.select(key, "record_hash", *(versions or {}))
    return {"tags": done, "rejected": rejected, "coverage": tags.coverage(done), "state": tags.upsert(state, marks, key) if state is not None else marks}


def dialogues(items: DataFrame, key: str, per_item: int = 8, most_turns: int = 9, templates: dict[str, list[str]] | None = None, negative: float = 0.1, seed: int = 42) -> dict[str, DataFrame]:
    """Dialogues of tagged items from templates: planned samples without repeats, checked and cleaned; a sample more for each tag that none asks for.

    Gives corpus (valid rows), errors (seq, errors), summary (distribution) and warnings. The same for every run and layout.
    """
    dims = [d for d in ("brand", "category") if d in items.columns]
    plan = corpus.plan_samples(items, key, per_item, SCENARIOS, PLANNED, negative, seed)
    plan = corpus.plan_details(plan, key, most_turns, seed=seed)
    rows = plan.join(items.select(key, *dims), key)
    made = corpus.template_dialogues(rows, templates or TEMPLATES, dims, key, seed)
    made = corpus.without_repeats(made.withColumn("_said", F.get("messages", F.lit(0))["content"]), key, ["_said", "intent", "negative"], "n").drop("_said")
    gaps = corpus.cover(made, tags.tag_rows(items.select(key, *dims), key), key)
    more = gaps.join(items.select(key, *dims), key).withColumns({"scenario": F.lit("direct"), "intent": F.lit("search_item"), "negative": F.lit(False)})
    made = made.unionByName(corpus.template_dialogues(more, {"direct": templates["direct"] if templates and "direct" in templates else TEMPLATES["direct"]}, dims, key, seed))
    full = made.withColumn("guide_text", F.concat(F.lit("Items of "), F.coalesce(*(F.col(f"params.{d}")[0]["values"][0] for d in dims), F.lit("all kinds")))).withColumn("seq", F.xxhash64(key, "n"))
    full = cut(full, "dialogues")
    errors = full.select("seq", corpus.sample_errors(most_turns).alias("errors")).where(F.size("errors") > 0)
    good = full.join(errors.select("seq"), "seq", "left_anti")
    stats = corpus.distribution_stats(good)
    return {"corpus": good, "errors": errors, "summary": stats, "warnings": corpus.distribution_warnings(stats, negative)}


def synonym_run(groups: list[DataFrame], antonyms: DataFrame, names: DataFrame | None = None, make: Callable | None = None, most: int = 10_000) -> dict[str, DataFrame]:
    """Synonym groups of all sources, and of a model's answers for `names` (name) if one is given: built, counted and verified."""
    parts = list(groups)
    if names is not None and make is not None:
        asked = cut(models.complete(names.select("name", models.fill('Give JSON {"variants": [...]} with other names of {name}.', name=F.col("name")).alias("_prompt")), "_prompt", make, "_answer"), "synonyms")
        flat = asked.select("name", F.explode(F.from_json("_answer", "variants array<string>")["variants"]).alias("variant"))
        parts.append(synonyms.groups_from_pairs(flat, "name", "variant", "llm", confidence=0.8))
    built = cut(synonyms.build(parts, antonyms, most), "groups")
    return {"groups": built, "stats": synonyms.synonym_stats(built), "checks": synonyms.verify(built, antonyms, most)}


def verify(corpus_rows: DataFrame, key: str, tagged: DataFrame | None = None) -> DataFrame:
    """(check, passed): no item in two splits, dialogues valid, enough diversity, tags cover the goal if they are given."""
    ok = lambda c: c.alias("passed")
    checks = {
        "no_leak": corpus.leaks(corpus.split(corpus_rows, key), key).agg(ok(F.count(F.lit(1)) == 0)),
        "valid": corpus_rows.agg(ok(F.count_if(F.size(corpus.sample_errors(9)) > 0) == 0)),
        "diverse": corpus.diversity(corpus_rows).select(ok(F.col("passed"))),
    }
    if tagged is not None:
        checks["coverage"] = tags.coverage(tagged).select(ok(F.col("passed")))
    return corpus.verification(**checks)
