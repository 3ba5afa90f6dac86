"""Scans over a sorted table that spread one group over as many tasks as it needs."""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from turnout.llm.tables import checked_broadcast, stored

#: The value before the first row of a group.
START = {"sum": 0, "xor": 0, "previous": -1}
_TOTAL = {"sum": F.sum, "xor": F.bit_xor, "previous": F.max}


def _before(kind: str, values: np.ndarray, starts: np.ndarray, carried: int) -> tuple[np.ndarray, int]:
    """What lies before each row in its group, and what the last group has come to."""
    group = np.zeros(len(values), np.int64)
    group[starts] = 1
    group = np.cumsum(group) - 1  # -1 while the group of the last batch goes on
    if kind == "previous":
        out = np.concatenate([[carried], values[:-1]])
        out[starts] = START[kind]
        return out, int(values[-1])
    if kind == "sum":
        upto = np.cumsum(values) - values
        base = np.concatenate([upto[starts], [-carried]])[group]
        out = upto - base
        return out, int(out[-1] + values[-1])
    upto = np.bitwise_xor.accumulate(values) ^ values
    out = upto ^ np.concatenate([upto[starts], [carried]])[group]
    return out, int(out[-1] ^ values[-1])


def _scan(group: list[str], scans: dict[str, tuple[str, str]]):
    def run(batches):
        part, key = TaskContext.get().partitionId(), None
        carried = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(c).to_numpy() for c in group]
            change = np.zeros(batch.num_rows, bool)
            for k in keys:
                change[1:] |= k[1:] != k[:-1]
            change[0] = key != [int(k[0]) for k in keys]
            key = [int(k[-1]) for k in keys]
            starts, columns = np.flatnonzero(change), []
            for name, (kind, column) in scans.items():
                values = batch.column(column).to_numpy()
                out, carried[name] = _before(kind, values, starts, carried.get(name, START[kind]))
                columns.append(pa.array(out, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *columns, pa.array(np.full(batch.num_rows, part), pa.int64())],
                [*batch.schema.names, *scans, "part"],
            )

    return run


def running(
    df: DataFrame, group: list[str], order: list[str], **scans: tuple[str, str]
) -> DataFrame:
    """``df`` with a column for each of ``scans``: what lies before a row in its group.

    A scan is ``("sum", column)``, ``("xor", column)`` or ``("previous", column)``, the last for
    values that ascend, -1 before the first.  Columns of ``group`` and of scans are long and not null.
    Rows are sorted over ranges of ``group`` and ``order``, scanned inside each, and what the earlier
    ranges add to a group that goes on, a row for each range at most, is joined to its rows.
    """
    keys = [*group, *order]
    schema = ", ".join(f"`{c}` {t}" for c, t in df.dtypes) + "".join(f", `{s}` long" for s in scans)
    scanned = stored(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(
            _scan(group, scans), f"{schema}, part long")
    )
    totals = scanned.groupBy("part", *group).agg(
        *[_TOTAL[kind](column).alias(f"_{name}") for name, (kind, column) in scans.items()])
    ranges = Window.partitionBy(*group).orderBy("part")
    earlier = ranges.rowsBetween(Window.unboundedPreceding, -1)
    carry = stored(
        totals.withColumn("_nth", F.row_number().over(ranges)).select(
            "part", *group, "_nth",
            *[_TOTAL[kind](f"_{name}").over(earlier).alias(f"_{name}") for name, (kind, _) in scans.items()],
        ).where("_nth > 1").drop("_nth")
    )
    joined = scanned.join(checked_broadcast(carry), ["part", *group], "left")
    full = {}
    for name, (kind, _) in scans.items():
        own, more = F.col(name), F.col(f"_{name}")
        full[name] = {
            "sum": own + F.coalesce(more, F.lit(0)),
            "xor": own.bitwiseXOR(F.coalesce(more, F.lit(0).cast("long"))),
            "previous": F.greatest(own, more),
        }[kind]
    return joined.withColumns(full).select(*df.columns, *scans)
