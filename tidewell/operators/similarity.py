"""Similar pairs and connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.session import cut, rounds_of

#: Bounds are compared with this much room for rounding.
EPS = 1e-9


def ngrams(c: Column, n: int = 2) -> Column:
    """The set of a text's character n-grams; empty for shorter texts, null for null."""
    return F.when(F.length(c) < n, F.array().cast("array<string>")).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - (n - 1)), lambda i: F.substring(c, i, n))))


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two sets; 0 if both are empty."""
    common = F.size(F.array_intersect(a, b))
    return F.coalesce(F.try_divide(common.cast("double"), (F.size(a) + F.size(b) - common).cast("double")), F.lit(0.0))


def similar_pairs(df: DataFrame, key: str, tokens: str, least: float) -> DataFrame:
    """(a, b, jaccard): pairs of keys, a < b, whose token sets have at least that Jaccard similarity (> 0).

    Tokens are ordered by rarity and only the rare prefixes are joined, so frequent
    tokens don't pair all their rows; sizes are compared in the join and the similarity is computed exactly.
    Keys are unique; rows without tokens have no pair.
    """
    rows = df.select(F.col(key).alias("k"), F.array_distinct(tokens).alias("t")).where(F.size("t") > 0)
    flat = rows.select("k", F.explode("t").alias("x"))
    freq = flat.groupBy("x").agg(F.count(F.lit(1)).alias("f"))
    ordered = flat.join(freq, "x").groupBy("k").agg(F.transform(F.array_sort(F.collect_list(F.struct("f", "x"))), lambda s: s["x"]).alias("t"))
    ordered = cut(ordered, "tokens")
    size = F.size("t")
    prefix = ordered.select("k", size.alias("n"), F.explode(F.slice("t", F.lit(1), size - F.ceil(size * F.lit(least) - EPS).cast("int") + 1)).alias("x"))
    pairs = prefix.select(F.col("k").alias("a"), F.col("n").alias("na"), "x").join(prefix.select(F.col("k").alias("b"), F.col("n").alias("nb"), "x"), "x").where((F.col("a") < F.col("b")) & (F.col("na") >= F.col("nb") * least - EPS) & (F.col("nb") >= F.col("na") * least - EPS)).select("a", "b").distinct()
    side = lambda s: ordered.select(F.col("k").alias(s), F.col("t").alias(f"t{s}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").withColumn("jaccard", jaccard(F.col("ta"), F.col("tb"))).where(F.col("jaccard") >= least - EPS).select("a", "b", "jaccard")


def connected_components(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """(node, component) of the nodes of edges (a, b); the component is its smallest node. Edges with a null end are left out.

    Each round every node takes the smallest label among its neighbours' and its
    label's own (pointer jumping), so long chains shorten quickly. State stays in the cluster and is cut into the shared folder each round.
    It goes on until no label changes; with `rounds`, an error if it takes more.
    """
    e = edges.select("a", "b").where("a is not null and b is not null and a <> b").distinct()
    both = cut(e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    loops = edges.where("a is not null and b is not null").select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = cut(loops.select("node", F.col("node").alias("label")), "labels")
    for _ in rounds_of(rounds, "connected_components"):
        labels_now = labels.select("node", "label")
        near = both.join(labels_now.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        stepped = labels_now.join(near, "node", "left").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels_now.select(F.col("node").alias("label"), F.col("label").alias("far"))
        moved = cut(stepped.join(jump, "label", "left").select("node", "old", F.least("label", "far").alias("label")), "labels", instead_of=labels)
        labels = moved
        if not moved.where("old <> label").take(1):
            break
    return labels.select("node", F.col("label").alias("component"))


def greedy_groups(ranked: DataFrame, pairs: DataFrame, rounds: int | None = None) -> DataFrame:
    """(name, canonical): taken in order of rank, each name joins the first canonical it is paired with, else becomes one.

    ranked: (name, rank) with unique ranks; pairs: (a, b). The sequential rule is
    resolved in rounds: a name is settled once all better names it is paired with,
    up to its first canonical, are settled. So no group meets in one task.
    It goes on until all are settled; with `rounds`, an error if it takes more.
    """
    r = ranked.select("name", "rank")
    both = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    up = both.join(r.select(F.col("name").alias("a"), F.col("rank").alias("ra")), "a").join(r.select(F.col("name").alias("b"), F.col("rank").alias("rb")), "b").where("rb < ra").select("a", "b", "rb").distinct()
    up = cut(up, "better")
    state = cut(r.select("name", F.lit(None).cast("string").alias("canonical")), "groups")
    unsettled = None
    for _ in rounds_of(rounds, "greedy_groups"):
        s = state.select(F.col("name").alias("b"), F.col("canonical").alias("cb"))
        own = F.col("cb") == F.col("b")
        seen = up.join(s, "b").groupBy(F.col("a").alias("name")).agg(
            F.min_by(F.when(own, F.col("b")), F.when(own, F.col("rb"))).alias("best"), F.min(F.when(own, F.col("rb"))).alias("best_rank"), F.min(F.when(F.col("cb").isNull(), F.col("rb"))).alias("open_rank")
        )
        joined = state.join(seen, "name", "left")
        settled = F.when(F.col("best").isNotNull() & (F.col("open_rank").isNull() | (F.col("best_rank") < F.col("open_rank"))), F.col("best")).when(F.col("best").isNull() & F.col("open_rank").isNull(), F.col("name"))
        state = cut(joined.select("name", F.coalesce("canonical", settled).alias("canonical")), "groups", instead_of=state)
        left = state.where("canonical is null").count()
        if not left:
            break
        if left == unsettled:
            raise ValueError("greedy_groups can't settle names that are null or have no unique rank")
        unsettled = left
    return state


def contains_join(names: DataFrame, key: str, name: str, values: DataFrame, value: str) -> DataFrame:
    """(key, value): values that occur in a name, found by an equi-join on their first two characters, not by comparing all with all.

    Every place of a name gives the piece that the longest value could take, so a long text is read once, not once a place. Null and empty values and names give nothing.
    """
    v = values.select(F.col(value).alias("v")).where("v is not null and v <> ''").distinct().withColumn("_p", F.substring("v", 1, 2))
    longest = v.agg(F.coalesce(F.max(F.length("v")), F.lit(0)).alias("m")).first().m
    n = names.select(F.col(key).alias("k"), F.col(name).alias("n")).where("n is not null and n <> ''")
    pieces = n.select("k", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("n")), lambda i: F.substring("n", i, F.lit(max(1, longest)))))).alias("x"))
    two = pieces.withColumn("_p", F.substring("x", 1, 2))
    one = pieces.withColumn("_p", F.substring("x", 1, 1))
    return two.unionByName(one).join(v, "_p").where(F.startswith("x", F.col("v"))).select(F.col("k").alias(key), F.col("v").alias(value)).distinct()
