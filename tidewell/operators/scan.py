"""One ordered pass over every key's rows, without putting a key into one task.

The rows are range-partitioned by (key, time, ...), so a key that holds a third of
all rows is spread over many tasks, and sorted within each partition (Spark's
external sort: a secondary sort). A scanner then reads a partition once, batch by
batch, holding only the group that is open. Groups at a partition's two ends may go
on in the neighbour; they are marked and joined afterwards: at most two rows a
partition, whatever the input's size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.session import cut

#: Columns that a scanner adds to its own: marks a group at a partition's end, the partition, the group's place in it.
MARKS = "edge boolean, part int, place long"


def ordered_scan(df: DataFrame, order: list[str], scanner: Callable[[], object], schema: str, label: str, before: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Scan df's partitions in the order given; the result is a table in the shared folder with schema + MARKS.

    before: projection of the sorted rows that the scanner gets. Costly columns belong there and not into df, whose
    columns the range partitioner computes twice, once for its sample.

    scanner() makes an object with push(batch) and close(), each giving a list of
    dicts of columns (lists or arrays) for the groups that are complete.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, held = TaskContext.get().partitionId(), 0, None
        scan = scanner()

        def out(rows: pa.Table, edge: bool) -> pa.RecordBatch:
            nonlocal place
            n = rows.num_rows
            rows = rows.append_column("edge", pa.array([edge] * n, pa.bool_())).append_column("part", pa.array([part] * n, pa.int32())).append_column("place", pa.array(range(place, place + n), pa.int64()))
            place += n
            return rows.combine_chunks().to_batches()[0]

        for batch in batches:
            if batch.num_rows == 0:
                continue
            groups = scan.push(batch)
            if groups is None or groups.num_rows == 0:
                continue
            # the newest group is held back, as it may be the partition's last
            groups = groups if held is None else pa.concat_tables([held, groups])
            held = groups.slice(groups.num_rows - 1)
            groups = groups.slice(0, groups.num_rows - 1)
            if place == 0 and groups.num_rows:
                yield out(groups.slice(0, 1), True)
                groups = groups.slice(1)
            if groups.num_rows:
                yield out(groups, False)
        last = scan.close()
        rest = [t for t in (held, last) if t is not None and t.num_rows]
        if rest:
            groups = pa.concat_tables(rest)
            n = groups.num_rows
            if place == 0 and n > 1:
                yield out(groups.slice(0, 1), True)
                groups, n = groups.slice(1), n - 1
            if n > 1:
                yield out(groups.slice(0, n - 1), False)
            yield out(groups.slice(n - 1), True)

    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    if before is not None:
        ordered = before(ordered)
    return cut(ordered.mapInArrow(run, f"{schema}, {MARKS}"), label)


def join_ends(scanned: DataFrame, key: list[str], same: list[str], gap: int, totals: list[str]) -> DataFrame:
    """The scanned groups, those cut by a partition's end put together.

    Two end groups are one if they follow one another in different partitions, agree
    in `same` and lie at most `gap` apart. Groups have start_ms and end_ms; `totals`
    are added up. Only the marked rows are shuffled.
    """
    keep = [c for c in scanned.columns if c not in ("edge", "part", "place")]
    ends = scanned.where("edge")
    w = Window.partitionBy(*key).orderBy("part", "place")
    goes_on = (F.lag("part").over(w) != F.col("part")) & (F.col("start_ms") - F.lag("end_ms").over(w) <= gap)
    for c in same:
        goes_on = goes_on & F.lag(c).over(w).eqNullSafe(F.col(c))
    ends = ends.withColumn("_new", F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1)).withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    how = {"start_ms": F.min, "end_ms": F.max} | {c: F.sum for c in totals}
    whole = ends.groupBy(*key, "_run").agg(*(how.get(c, F.first)(c).alias(c) for c in keep if c not in key))
    return scanned.where("not edge").select(keep).unionByName(whole.select(keep))
