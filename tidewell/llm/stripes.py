"""Items that appear together: stripes of co-occurring neighbours with log-likelihood ratio."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.operators import skew
from tidewell.session import cut

#: A basket of more items is taken in block pairs of about this many items, so that no task holds more.
BLOCK = 1_000
#: Pairs held at once when stripes are built.
PAIRS = 2_000_000
#: An item's neighbours are merged in parts, one part for so many baskets that hold the item.
PART = 5_000
#: The items' counts are broadcast up to so many items; beyond that the join splits items that many baskets hold over tasks.
SMALL_COUNTS = 20_000

_STRIPE = "a string, part int, n_a long, b array<string>, n_b array<long>, n array<long>"


def _xlogx(c):
    return F.when(c > 0, c * F.log(c)).otherwise(0.0)


def log_likelihood_ratio(both, a, b, n):
    """2 * log-likelihood ratio of independence in the 2 x 2 table of two items (column expressions)."""
    k = [both, a - both, b - both, n - a - b + both]
    h = lambda *x: _xlogx(sum(x[1:], x[0])) - sum((_xlogx(v) for v in x), F.lit(0.0))
    return F.greatest(F.lit(0.0), 2.0 * (h(k[0] + k[1], k[2] + k[3]) + h(k[0] + k[2], k[1] + k[3]) - h(*k)))


def implied_llr(least: int, lift: float) -> float:
    """The least log-likelihood ratio of a pair with `least` baskets or more and that lift or more: 2 * least * (ln lift - 1 + 1 / lift).

    With e expected and k = n_both, x = k - e, the first cell gives k ln(k / e), the two beside it -x at least each, as ln(1 + u) <= u, the
    last x at least; the sum k ln(k / e) - x grows with k and with k / e.
    """
    return 2.0 * least * (math.log(lift) - 1 + 1 / lift) if lift > 1 else 0.0


def _pairs_of(sizes_l: np.ndarray, sizes_r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (left, right) of every group's cross product, groups lying one behind the other."""
    cells = sizes_l * sizes_r
    group = np.repeat(np.arange(len(cells)), cells)
    within = np.arange(int(cells.sum())) - np.repeat(np.cumsum(cells) - cells, cells)
    r = sizes_r[group]
    return (np.cumsum(sizes_l) - sizes_l)[group] + within // r, (np.cumsum(sizes_r) - sizes_r)[group] + within % r


def _stripes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Baskets to stripes: for each item a the neighbours b > a with the number of baskets, merged over the batch."""
    for batch in batches:
        left, right, whole = batch.column("left"), batch.column("right"), batch.column("whole").to_numpy(zero_copy_only=False)
        ln = left.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        rn = right.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        lv, rv = left.flatten(), right.flatten()
        names = pa.concat_arrays([lv.field("item"), rv.field("item")]).dictionary_encode()
        if len(names) == 0:
            continue
        # codes in text order, so that a < b can be told from the codes
        words = names.dictionary.to_pandas().to_numpy()
        rank = np.empty(len(words), np.int64)
        rank[np.argsort(words)] = np.arange(len(words))
        words = np.sort(words)
        code = rank[names.indices.to_numpy(zero_copy_only=False)]
        counts = np.zeros(len(words), np.int64)
        counts[code] = np.concatenate([lv.field("n").to_numpy(zero_copy_only=False), rv.field("n").to_numpy(zero_copy_only=False)])
        lc, rc = code[: len(lv)], code[len(lv) :]
        lo, ro = np.append(0, np.cumsum(ln)), np.append(0, np.cumsum(rn))
        size = ln * rn
        at = 0
        while at < len(size):
            end = max(at + 1, int(np.searchsorted(np.cumsum(size[at:]), PAIRS)) + at)
            i, j = _pairs_of(ln[at:end], rn[at:end])
            x, y = lc[lo[at] :][i], rc[ro[at] :][j]
            w = np.repeat(whole[at:end], size[at:end])
            # a whole basket is its own other side: each pair is seen twice there, and kept once
            keep = (x != y) & (~w | (x < y))
            x, y = x[keep], y[keep]
            at = end
            if len(x) == 0:
                continue
            pair, n = np.unique(np.minimum(x, y) * len(words) + np.maximum(x, y), return_counts=True)
            a, b = np.divmod(pair, len(words))
            parts = counts[a] // PART + 1
            part = (pd.util.hash_array(words.astype(object))[b] % parts.astype(np.uint64)).astype(np.int64)
            by = np.lexsort((b, part, a))
            a, b, part, n = a[by], b[by], part[by], n[by]
            begins = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (part[1:] != part[:-1])))
            offsets = pa.array(np.append(begins, len(a)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(words[a[begins]], pa.string()), pa.array(part[begins], pa.int32()), pa.array(counts[a[begins]], pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(words[b], pa.string())), pa.ListArray.from_arrays(offsets, pa.array(counts[b], pa.int64())), pa.ListArray.from_arrays(offsets, pa.array(n, pa.int64()))],
                ["a", "part", "n_a", "b", "n_b", "n"],
            )


def _merged(least: int):
    """Stripes, sorted by item, to pairs: arrays with the same key are added up; pairs of fewer than `least` baskets go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pd.DataFrame | None = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            n = batch.column("b").value_lengths().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(batch.num_rows), n)
            flat = pd.DataFrame({
                "a": batch.column("a").to_pandas().to_numpy()[row], "part": batch.column("part").to_numpy()[row], "n_a": batch.column("n_a").to_numpy()[row],
                "b": batch.column("b").flatten().to_pandas().to_numpy(), "n_b": batch.column("n_b").flatten().to_numpy(), "n": batch.column("n").flatten().to_numpy(),
            })
            flat = flat if held is None else pd.concat([held, flat], ignore_index=True)
            flat = flat.groupby(["a", "part", "n_a", "b", "n_b"], sort=False, as_index=False)["n"].sum()
            last = (flat["a"] == batch.column("a")[batch.num_rows - 1].as_py()) & (flat["part"] == batch.column("part")[batch.num_rows - 1].as_py())
            held = flat[last]
            done = flat[~last & (flat["n"] >= least)]
            if len(done):
                yield pa.RecordBatch.from_pandas(done[["a", "b", "n", "n_a", "n_b"]], preserve_index=False)
        if held is not None and len(held := held[held["n"] >= least]):
            yield pa.RecordBatch.from_pandas(held[["a", "b", "n", "n_a", "n_b"]], preserve_index=False)

    return run


def co_occurrence(rows: DataFrame, basket: list[str], item: str, least: int = 4, lift: float = 5.0, least_llr: float | None = None) -> DataFrame:
    """(item_a, item_b, n_both, n_a, n_b, n_baskets, lift, llr) of the pairs, a < b as text, that at least `least` baskets
    hold, whose n_both * n_baskets >= lift * n_a * n_b and whose log-likelihood ratio is at least least_llr (None: what the first two imply).

    A basket is the set of its items: repeated rows count once. Rows without item or
    with a null in the basket's key are left out. Empty in, empty out. Other columns are ignored.

    Stripes: each item of a basket sends its neighbours as one array, arrays of one
    item are added up on the sending side and again after the shuffle. Before that, items go that cannot be in any
    result, which loses nothing: such a pair has n_both <= min(n_a, n_b), so items
    in fewer than `least` baskets and items in more than n_baskets / lift baskets are out - the hot ones.
    Baskets of more than BLOCK items are split into block pairs, and the array of an
    item with many baskets is merged in parts by neighbour.
    """
    keys = [F.col(c).alias(f"k{i}") for i, c in enumerate(basket)]
    names = [f"k{i}" for i in range(len(basket))]
    clean = rows.select(*keys, F.col(item).cast("string").alias("item")).where(F.col("item").isNotNull() & ~F.exists(F.array(*(F.col(c).isNull() for c in names)), lambda x: x))
    sets = cut(clean.distinct(), "baskets")
    sizes = sets.groupBy(*names).agg(F.count(F.lit(1)).alias("size"))
    n_baskets, largest = sizes.agg(F.count(F.lit(1)), F.coalesce(F.max("size"), F.lit(0))).first()
    most = n_baskets / lift
    counts = cut(sets.groupBy("item").agg(F.count(F.lit(1)).alias("n")).where((F.col("n") >= least) & (F.col("n") <= most)), "counts")
    if counts.count() <= SMALL_COUNTS:
        kept = sets.join(F.broadcast(counts), "item")
    else:
        kept = skew.balanced_join(sets.withColumn("_row", F.xxhash64(*names)), counts, skew.plan_load(sets, "item"), "_row", "inner").drop("_row")
    kept = kept.withColumn("it", F.struct("item", "n"))
    has_large = largest > BLOCK
    large = sizes.where(F.col("size") > BLOCK)
    few = kept
    if has_large:
        few = kept.join(large.select(names), names, "left_anti")
    whole = few.groupBy(*names).agg(F.collect_list("it").alias("left")).where(F.size("left") >= 2).select("left", F.col("left").alias("right"), F.lit(True).alias("whole"))
    if has_large:
        cuts = F.ceil(F.col("size") / (BLOCK / 2)).cast("int")
        blocks = kept.join(large.withColumn("cuts", cuts), names).withColumn("h", F.pmod(F.xxhash64("item"), F.col("cuts")).cast("int"))
        sent = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))).withColumn("i", F.least("h", "other")).withColumn("j", F.greatest("h", "other"))
        sides = sent.groupBy(*names, "i", "j").agg(F.collect_list(F.when(F.col("h") == F.col("i"), F.col("it"))).alias("left"), F.collect_list(F.when(F.col("h") == F.col("j"), F.col("it"))).alias("right"))
        whole = whole.unionByName(sides.select("left", "right", (F.col("i") == F.col("j")).alias("whole")))
    stripes = whole.mapInArrow(_stripes, _STRIPE)
    merged = stripes.repartition("a", "part").sortWithinPartitions("a", "part").mapInArrow(_merged(least), "a string, b string, n long, n_a long, n_b long")
    both, a, b, n = (c.cast("double") for c in (F.col("n"), F.col("n_a"), F.col("n_b"), F.lit(n_baskets)))
    llr = log_likelihood_ratio(both, a, b, n)
    significant = llr >= (implied_llr(least, lift) if least_llr is None else least_llr) - 1e-6
    return merged.where((F.col("n") * F.lit(n_baskets) >= lift * F.col("n_a") * F.col("n_b")) & significant).select(F.col("a").alias("item_a"), F.col("b").alias("item_b"), F.col("n").alias("n_both"), "n_a", "n_b", F.lit(n_baskets).cast("long").alias("n_baskets"), (both * n / (a * b)).alias("lift"), llr.alias("llr"))
