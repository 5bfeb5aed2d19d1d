"""Running values over a global order, without one task that sees all rows.

Rows are split into ranges of the order, each range is passed once in its own task, and what a range carries
over to the next is added from a table with one row per range. A key with a third of all rows is many ranges.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.tables import written

_OPS = {"sum": np.add, "xor": np.bitwise_xor}


def running(df: DataFrame, order: Sequence[str], key: Sequence[str], values: dict[str, tuple[str, str]], name: str, partitions: int | None = None) -> DataFrame:
    """The rows with one running LONG column per entry ``new: (op, column)`` of ``values``, as a written table.

    ``key`` (the first columns of ``order``, LONG or INT and never null) names the groups that start anew. ``sum`` and
    ``xor`` include the row itself; ``last`` is the value of the row before it in the group, null for the first.
    The order should be total. Columns named ``__part``, ``__row`` and ``__first`` must not exist.
    """
    if list(order[: len(key)]) != list(key):
        raise ValueError("the order must start with the key")
    if partitions is None:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = T.StructType([*df.schema.fields, *[T.StructField(n, T.LongType()) for n in values]])
    for n, t in (("__part", T.IntegerType()), ("__row", T.LongType()), ("__first", T.BooleanType())):
        schema.add(n, t)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row = TaskContext.get().partitionId(), 0
        at_key: tuple | None = None  # key of the last row, and what has run up in its group
        carry: dict[str, int | None] = {}
        in_first = True
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in key]
            fresh = np.zeros(n, bool)
            for k in keys:
                fresh[1:] |= k[1:] != k[:-1]
            head = tuple(int(k[0]) for k in keys)
            fresh[0] = at_key is not None and head != at_key
            starts = np.flatnonzero(fresh)
            group = np.cumsum(fresh)  # 0: the group of the row before this batch
            columns = []
            for new, (op, source) in values.items():
                x = batch.column(source).to_numpy(zero_copy_only=False).astype(np.int64)
                if op == "last":
                    before = np.empty(n, np.int64)
                    before[1:] = x[:-1]
                    known = ~fresh
                    old = carry.get(new)
                    known[0] = known[0] and old is not None
                    before[0] = old if old is not None else 0
                    columns.append(pa.array(before, pa.int64(), mask=~known))
                    carry[new] = int(x[-1])
                    continue
                do = _OPS[op]
                total = do.accumulate(x)
                base = np.zeros(len(starts) + 1, np.int64)
                old = np.int64(carry.get(new) or 0)
                base[1:] = np.where(starts > 0, total[starts - 1], 0)
                out = (total ^ base[group]) if op == "xor" else total - base[group]
                out = np.where(group == 0, do(out, old), out)
                columns.append(pa.array(out, pa.int64()))
                carry[new] = int(out[-1])
            at_key = tuple(int(k[-1]) for k in keys)
            first = (group == 0) & in_first
            in_first = bool(first[-1])
            extra = [pa.array(np.full(n, part), pa.int32()), pa.array(np.arange(row, row + n), pa.int64()), pa.array(first)]
            row += n
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns, *extra], names=schema.names)

    ranged = df.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    passed = written(ranged.mapInArrow(walk, schema), name)
    # One row per range: its first and last key, and what it ends with.
    last = {n: (F.col(n) if op != "last" else F.col(source).cast("long")) for n, (op, source) in values.items()}
    tail = F.struct(*[F.col(k) for k in key], *[c.alias(f"__{n}") for n, c in last.items()])
    ends = passed.groupBy("__part").agg(
        F.min_by(F.struct(F.lit(0).alias("__none"), *key), "__row").alias("head"), F.max_by(tail, "__row").alias("tail")
    )
    by_key = Window.partitionBy(*[F.col("tail")[k] for k in key]).orderBy("__part")
    run = {
        n: (F.col("tail")[f"__{n}"] if op == "last" else F.sum(F.col("tail")[f"__{n}"]).over(by_key) if op == "sum" else F.bit_xor(F.col("tail")[f"__{n}"]).over(by_key))
        for n, (op, _) in values.items()
    }
    upto = ends.select("__part", "head", F.col("tail").alias("t"), F.struct(*[c.alias(n) for n, c in run.items()]).alias("r"))
    by_part = Window.orderBy("__part")
    same = F.lit(True)
    for k in key:
        same = same & (F.lag(F.col("t")[k]).over(by_part) == F.col("head")[k])
    carried = upto.select("__part", F.when(same, F.lag("r").over(by_part)).alias("__carry"))
    joined = passed.join(F.broadcast(carried), "__part", "left")
    out = {}
    for n, (op, _) in values.items():
        c = F.col("__carry")[n]
        if op == "last":
            out[n] = F.when(F.col("__row") == 0, c).otherwise(F.col(n))
        elif op == "sum":
            out[n] = F.when(F.col("__first"), F.col(n) + F.coalesce(c, F.lit(0))).otherwise(F.col(n))
        else:
            out[n] = F.when(F.col("__first"), F.col(n).bitwiseXOR(F.coalesce(c, F.lit(0)))).otherwise(F.col(n))
    return joined.withColumns(out).select(*df.columns, *values)
