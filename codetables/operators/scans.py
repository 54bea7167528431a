"""Running numbers, sums and last values over ordered groups of any size: a group is many tasks, not one.

Rows are sorted by range over all groups, so a long group lies in several parts. Each part counts by itself; what a
group has in the parts before is a row for each part that begins inside a group, so at most one a part, and is added
afterwards. A window over the group would bring all of it into one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from codetables.sources.shared import written


def _running(total: bool, last: int, schema: pa.Schema):
    """Adds to each row (the group's name first, then what is to be added up, the last values, all other columns) its number, sum
    and last values within the part."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, number, added, held = None, 0, 0, [None] * last
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            group = batch.column(0)
            new = np.ones(n, bool)
            new[1:] = pc.not_equal(group[1:], group[:-1]).to_numpy(zero_copy_only=False)
            goes_on = group[0].as_py() == name
            new[0] = not goes_on
            at = np.arange(n)
            start = np.maximum.accumulate(np.where(new, at, -1))  # -1: the group of the batch before
            rank = np.where(start < 0, number + at + 1, at - start + 1)
            value = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64) if total else np.ones(n, np.int64)
            sums = np.cumsum(value)
            sums = np.where(start < 0, added + sums, sums - np.where(start > 0, sums[start - 1], 0))
            lasts = []
            for k in range(last):
                column = batch.column(1 + total + k)
                some = np.maximum.accumulate(np.where(pc.is_valid(column).to_numpy(zero_copy_only=False), at, -1))
                here = some >= np.maximum(start, 0)
                picked = column.take(pa.array(np.where(here, some, 0), mask=~here))
                if held[k] is not None:
                    before = pa.array((start < 0) & ~here)
                    picked = pc.if_else(before, pa.scalar(held[k], column.type), picked)
                lasts.append(picked)
            name, number, added, held = group[n - 1].as_py(), int(rank[-1]), int(sums[-1]), [x[n - 1].as_py() for x in lasts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rank), pa.array(sums), *lasts], schema=schema)

    return emit


def running(df: DataFrame, group: list[str], order: list[str | Column], total: str | None = None, last: list[str] = ()) -> DataFrame:
    """df with `rank` (from 1), `running` (the sum of `total`, whole numbers, up to the row; without it the rank) and for each
    column of `last` its last value that isn't null up to the row, as `last_<column>`, in each group's order. Rows of
    equal order are in any order."""
    name = F.to_json(F.struct(*[F.col(c).alias(f"c{k}") for k, c in enumerate(group)]))
    keyed = df.withColumn("_group", name)
    placed = keyed.repartitionByRange(F.col("_group"), *order).sortWithinPartitions("_group", *order)
    values = [F.coalesce(F.col(total), F.lit(0)).cast("long").alias("_value")] if total else []
    slim = placed.select("_group", *values, *[F.col(c).alias(f"_last{k}") for k, c in enumerate(last)], F.spark_partition_id().alias("_part"), *df.columns)
    fields = [*slim.schema.fields, *StructType.fromDDL("rank long, running long").fields]
    shape = StructType(fields)
    for k, c in enumerate(last):
        shape = shape.add(f"last_{c}", df.schema[c].dataType)
    for f in shape.fields:
        f.nullable = True
    made = written(slim.mapInArrow(_running(total is not None, len(last), to_arrow_schema(shape)), shape), "running")
    ends = [F.max("rank").alias("n"), F.max_by("running", "rank").alias("sum"), *[F.max_by(F.struct(f"last_{c}"), "rank").alias(f"l{k}") for k, c in enumerate(last)]]
    per = made.groupBy("_group", "_part").agg(*ends)
    earlier = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = [F.sum("n").over(earlier).alias("_n"), F.sum("sum").over(earlier).alias("_sum")]
    before += [F.last(F.col(f"l{k}")[f"last_{c}"], ignorenulls=True).over(earlier).alias(f"_l{k}") for k, c in enumerate(last)]
    carried = per.select("_group", "_part", *before).where("_n is not null")
    # At most one row a part, since only a part's first group can have begun before it.
    out = made.join(F.broadcast(carried), ["_group", "_part"], "left")
    numbers = [(F.col("rank") + F.coalesce("_n", F.lit(0))).alias("rank"), (F.col("running") + F.coalesce("_sum", F.lit(0))).alias("running")]
    return out.select(*df.columns, *numbers, *[F.coalesce(f"last_{c}", f"_l{k}").alias(f"last_{c}") for k, c in enumerate(last)])


def least(df: DataFrame, keys: list[str], value: str, k: int, held_rows: int = 200_000) -> DataFrame:
    """keys, n (rows) and least (the k least values, text, in order) of each group. Every task keeps k values of a group
    and hands them on, so a group's rows never meet; a task that holds too many groups hands them on early."""
    names = [*keys, "n", "least"]
    shape = StructType.fromDDL(", ".join([*[f"`{c}` {t}" for c, t in df.select(*keys).dtypes], "n long", "least array<string>"]))
    schema = to_arrow_schema(shape)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}

        def rows() -> pa.RecordBatch:
            out = [dict(zip(names, (*key, n, sorted(values)[:k]))) for key, (n, values) in held.items()]
            held.clear()
            return pa.RecordBatch.from_pylist(out, schema=schema)

        for batch in batches:
            for *key, value in zip(*(c.to_pylist() for c in batch.columns)):
                one = held.setdefault(tuple(key), [0, []])
                one[0] += 1
                if value is not None:
                    one[1].append(value)
                    if len(one[1]) >= 4 * k + 16:
                        one[1] = sorted(one[1])[:k]
            if len(held) > held_rows:
                yield rows()
        if held:
            yield rows()

    partial = df.select(*keys, F.col(value).cast("string")).mapInArrow(emit, shape)
    together = F.slice(F.array_sort(F.flatten(F.collect_list("least"))), 1, k)
    return partial.groupBy(*keys).agg(F.sum("n").alias("n"), together.alias("least"))
