import random

import numpy as np
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewell.llm import runs


def brute(events, gap=100):
    rows = sorted({(u, t, len(i), i, s, e) for u, t, i, s, e in events if None not in (u, t, s, e) and i is not None})
    out, k = [], 0
    while k < len(rows):
        j = k
        while j + 1 < len(rows) and rows[j + 1][0] == rows[k][0] and rows[j + 1][4:] == rows[k][4:] and rows[j + 1][1] - rows[j][1] <= gap:
            j += 1
        if j > k:
            out.append((rows[k][0], rows[k][4], rows[k][5], rows[k][1], rows[j][1], j - k + 1))
        k = j + 1
    return sorted(out)


def got(spark, events, gap=100):
    df = spark.createDataFrame(events, "who string, ms long, eid string, shop string, ev string").withColumn("user", F.lit(1)).withColumn("key", F.lit(1)).withColumn("t", F.lit(None).cast("int"))
    return sorted((r.who, r.shop, r.ev, r.start_ms, r.end_ms, r.n_events) for r in runs.collapse_runs(df, "who", "ms", "eid", ["shop", "ev"], gap).collect())


def made(n=3_000):
    random.seed(6)
    rows = [(random.choice(["hot"] * 4 + ["a", "b", None]), k * 20 + random.randrange(60), str(k), random.choice(["1", "2", None]), random.choice("xxy")) for k in range(n)]
    return rows + random.sample(rows, 200) + [("tie", 5, str(k), "1", "x") for k in range(12)]


def test_brute(spark):
    assert got(spark, made()) == brute(made())


def test_small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        assert got(spark, made(300)) == brute(made(300))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_one_run_over_all_partitions(spark):
    rows = [("u", k, f"{k:05}", "1", "x") for k in range(5_000)]
    assert got(spark, rows) == [("u", "1", "x", 0, 4_999, 5_000)]


def test_edges(spark):
    assert got(spark, []) == []
    assert got(spark, [("u", 1, "a", None, "x"), ("u", 2, "b", "1", None), (None, 3, "c", "1", "x"), ("u", None, "d", "1", "x"), ("u", 4, "e", "1", "x")]) == []
    assert got(spark, [("u", 1, None, "1", "x"), ("u", 1, None, "1", "x")]) == [("u", "1", "x", 1, 1, 2)]  # without an id nothing says they are one
    assert got(spark, [("u", 1, "a", 'q"\\,', "x"), ("u", 2, "b", 'q"\\,', "x")]) == [("u", 'q"\\,', "x", 1, 2, 2)]


@given(st.lists(st.tuples(st.integers(0, 70_000), st.booleans()), max_size=60))
def test_symbol_strings(pairs):
    codes, stops = np.array([c for c, _ in pairs], np.int64), np.array([s for _, s in pairs], bool)
    text, rows = runs.symbol_string(codes, stops)
    spans = [(rows[m.start()], rows[m.end() - 1]) for m in runs.REPEATED.finditer(text)]
    want, k = [], 0
    while k < len(pairs):
        j = k
        while j + 1 < len(pairs) and codes[j + 1] == codes[k] and not stops[j + 1]:
            j += 1
        want.append((k, j))
        k = j + 1
    assert spans == want


def with_breaks(spark, events, gap=100):
    df = spark.createDataFrame(events, "who string, ms long, eid string, shop string, ev string")
    return sorted((r.who, r.shop, r.ev, r.start_ms, r.end_ms, r.n_events) for r in runs.collapse_runs(df, "who", "ms", "eid", ["shop", "ev"], gap, breaks=["ev"]).collect())


def brute_with_breaks(events):
    marked = [(u, t, i, s, e if e is not None else f"unknown {i}") for u, t, i, s, e in events]
    return [r for r in brute(marked) if not r[2].startswith("unknown")]


def test_unknown_event_ends_a_run(spark):
    a, b, c = (("u", k, str(k), "1", "x") for k in range(3))
    assert with_breaks(spark, [a, b, ("u", 2, "2", "1", None), ("u", 3, "3", "1", "x")]) == [("u", "1", "x", 0, 1, 2)]
    assert with_breaks(spark, [a, ("u", 1, "1", "1", None), c]) == [] and with_breaks(spark, [("u", k, str(k), "1", None) for k in range(4)]) == []
    random.seed(8)
    events = [(u, t, i, s, None if random.random() < 0.2 else e) for u, t, i, s, e in made(600)[:600]]
    few = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for size in ("3", few):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        assert with_breaks(spark, events) == brute_with_breaks(events)


def test_query_takes_blank_events_as_unknown(spark, tmp_path):
    rows = [("a", 10**12, "C", "7", "view"), ("b", 10**12 + 1, "C", "7", "  "), ("c", 10**12 + 2, "C", "7", "view"), ("d", 10**12 + 3, "C", "7", "View!"), ("e", 10**12 + 4, "D", "7", ""), ("f", 10**12 + 5, "D", "7", "")]
    spark.createDataFrame(rows, "event_id string, event_time long, custref_no string, shopid string, event string").write.parquet(str(tmp_path / "user_seq.parquet"))
    from tidewell.llm import queries

    assert [tuple(r) for r in queries.p7_found(spark, str(tmp_path)).collect()] == [("C", "7", 10**12 + 2, 10**12 + 3)]
