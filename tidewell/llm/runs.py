"""Repeated consecutive events: runs found as regex repetitions in a string of event symbols."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators.scan import join_ends, ordered_scan

#: A code point that no symbol gets: it stands where a run can't go on.
STOP = "\x00"
REPEATED = re.compile(f"([^{STOP}])\\1*")
_SURROGATES, _COUNT = 0xD800, 0x800


def symbol_string(codes: np.ndarray, stop_before: np.ndarray) -> tuple[str, np.ndarray]:
    """Symbols as one code point each, from U+0001 on without the surrogates, a STOP before every marked row; and the row of each character."""
    points = codes.astype(np.int64) + 1
    points[points >= _SURROGATES] += _COUNT
    rows = np.arange(len(points))
    at = np.flatnonzero(stop_before)
    points, rows = np.insert(points, at, 0), np.insert(rows, at, at)
    return points.astype("<u4").tobytes().decode("utf-32-le"), rows


class _Runs:
    """Scans ordered events batch by batch; holds the run that is open."""

    def __init__(self, gap: int):
        self.gap, self.open = gap, None

    def push(self, batch: pa.RecordBatch) -> pa.Table | None:
        batch = batch.filter(batch.column(4))
        if batch.num_rows == 0:
            return None
        user, key = batch.column(0).dictionary_encode(), batch.column(3).dictionary_encode()
        t = batch.column(1).to_numpy(zero_copy_only=False)
        known = key.indices.is_valid().to_numpy(zero_copy_only=False)
        u, k = (c.indices.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for c in (user, key))
        e = batch.column(2).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        again = np.zeros(len(t), bool)
        again[1:] = (u[1:] == u[:-1]) & (t[1:] == t[:-1]) & (e[1:] == e[:-1]) & (e[1:] >= 0)
        if self.open is not None and e[0] >= 0:
            again[0] = (user.dictionary[int(u[0])].as_py(), int(t[0]), batch.column(2)[0].as_py()) == (self.open[0], self.open[3], self.open[5])
        fresh = np.flatnonzero(~again)
        if len(fresh) == 0:
            return None
        u, t, k, known = u[fresh], t[fresh], k[fresh], known[fresh]
        _, codes = np.unique(u * max(1, len(key.dictionary)) + k, return_inverse=True)
        stop = np.zeros(len(t), bool)
        stop[1:] = (t[1:] - t[:-1] > self.gap) | ~known[:-1]
        stop |= ~known
        text, rows = symbol_string(codes, stop)
        spans = np.array([m.span() for m in REPEATED.finditer(text)], np.int64)
        first, last = rows[spans[:, 0]], rows[spans[:, 1] - 1]
        table = self._table(user.dictionary.take(pa.array(u[first])), key.dictionary.take(pa.array(k[first], mask=~known[first])), t[first], t[last], last - first + 1)
        if self.open is not None:
            o = self.open
            if o[1] is not None and (o[0], o[1]) == (table["user"][0].as_py(), table["key"][0].as_py()) and int(t[first[0]]) - o[3] <= self.gap:
                head = self._table([o[0]], [o[1]], [o[2]], [int(t[last[0]])], [o[4] + int(last[0] - first[0]) + 1])
                table = pa.concat_tables([head, table.slice(1)])
            else:
                table = pa.concat_tables([self._table(*([x] for x in o[:5])), table])
        n = table.num_rows
        end = table.slice(n - 1).to_pylist()[0]
        self.open = (end["user"], end["key"], end["start_ms"], end["end_ms"], end["n_events"], batch.column(2)[int(fresh[-1])].as_py())
        return table.slice(0, n - 1)

    def close(self) -> pa.Table | None:
        return self._table(*([x] for x in self.open[:5])) if self.open is not None else None

    @staticmethod
    def _table(user, key, start, end, n) -> pa.Table:
        text = lambda a: pa.array(a, pa.string()) if isinstance(a, list) else a.cast(pa.string())
        return pa.table({"user": text(user), "key": text(key), "start_ms": pa.array(start, pa.int64()), "end_ms": pa.array(end, pa.int64()), "n_events": pa.array(n, pa.int64())})


def collapse_runs(events: DataFrame, user: str, time_ms: str, event_id: str, same: list[str] | dict[str, Callable[[Column], Column]], gap_ms: int = 600_000, least: int = 2, breaks: list[str] | None = None) -> DataFrame:
    """(user, *same, start_ms, end_ms, duration_ms, n_events): every longest run of `least` or more events of a user, one after
    another in time, that agree in `same`, each at most gap_ms after the one before.

    same: columns, or for each column the expression of it that is compared; these are computed after the exchange, as
    a range partitioner's sampling would compute them a second time before it. Rows with a null in user, time or any value of `same` are left out before; but where a column of `same` that is among
    `breaks` is null, the row stays in the order as an event that is like no other, so it ends a run.
    An event stored again (same user, time and id) counts once; rows with null id each count. Ties in time are taken by length and
    text of the id, so the result is determined. An empty table gives none.

    Events become symbols (one code point for each user and content), joined to
    strings; a backreference finds the repetitions, whose spans give the rows. The
    strings are those of a range partition's batches, with runs carried over their
    ends, so a user with a third of all events is spread over many tasks.
    """
    level = same if isinstance(same, dict) else {c: lambda x: x for c in same}
    ident = F.col(event_id).cast("string")
    raw = [F.col(c).alias(f"raw{k}") for k, c in enumerate(level)]
    rows = events.select(F.col(user).cast("string").alias("user"), F.col(time_ms).cast("long").alias("t"), F.concat(F.lpad(F.length(ident).cast("string"), 9, "0"), ident).alias("id"), *raw).where("user is not null and t is not null")
    values = [f(F.col(f"raw{k}")).cast("string").alias(f"v{k}") for k, f in enumerate(level.values())]
    ok = known = F.lit(True)
    for k, c in enumerate(level):
        if c in (breaks or []):
            known = known & F.col(f"v{k}").isNotNull()
        else:
            ok = ok & F.col(f"v{k}").isNotNull()

    def levelled(df: DataFrame) -> DataFrame:
        return df.select("user", "t", "id", *values).select("user", "t", "id", F.when(known, F.to_json(F.array(*(f"v{k}" for k in range(len(level)))))).alias("key"), ok.alias("ok"))

    scanned = ordered_scan(rows, ["user", "t", "id"], lambda: _Runs(gap_ms), "user string, key string, start_ms long, end_ms long, n_events long", "runs", levelled)
    worth = scanned.where(F.col("edge") | (F.col("n_events") >= least))
    whole = join_ends(worth, ["user"], ["key"], gap_ms, ["n_events"]).where(F.col("key").isNotNull() & (F.col("n_events") >= least))
    parts = F.from_json("key", "array<string>")
    return whole.select(F.col("user").alias(user), *(parts[i].alias(c) for i, c in enumerate(level)), "start_ms", "end_ms", (F.col("end_ms") - F.col("start_ms")).alias("duration_ms"), "n_events")
