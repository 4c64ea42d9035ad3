"""Vectors of a table as whole numbers, and sums over tasks in several levels."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

#: States that one task adds up.
FAN_IN = 32


def whole_vectors(rows: DataFrame, vector: str, factor: int, offset: int, limit: int) -> DataFrame:
    """Rows with ``x array<long>``, floor(factor * c) + offset of each entry c, in place of ``vector``.

    Rows whose vector is null or holds a null or non-finite entry are left out, and so are rows with an entry of
    ``limit`` or more after scaling, which arithmetic on whole numbers could not carry. Vectors of another
    length than most have (of equally frequent ones the longest) are left out too.
    """
    entries = F.col(vector).cast("array<double>")
    scaled = F.floor(F.lit(float(factor)) * F.col("c"))
    usable = F.forall(entries, lambda c: c.isNotNull() & (F.abs(c * float(factor)) < float(limit)))  # NaN is above all
    kept = rows.where(F.col(vector).isNotNull() & usable)
    lengths = kept.groupBy(F.size(vector).alias("d")).agg(F.count("*").alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    x = F.transform(entries, lambda c: F.floor(F.lit(float(factor)) * c) + F.lit(offset))
    return kept.where(F.size(vector) == (most.d if most else 0)).withColumn("x", x).drop(vector)


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as the rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def merged(
    states: DataFrame, load: Callable[[dict], object], add: Callable[[object, object], object], save: Callable[[object], dict]
) -> dict | None:
    """One state from ``states (part, ...)`` of one row per task, added up in levels of ``FAN_IN``; None if there is none.

    Each level is a small shuffle in which a task adds up some ``FAN_IN`` states in order, so neither
    a task nor the driver ever holds more than that many. The result is one state.
    """
    names = states.columns

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, part = None, None
        for batch in batches:
            for row in batch.to_pylist():
                total = load(row) if total is None else add(total, load(row))
                part = row["part"] if part is None else part
        if total is not None:
            yield pa.RecordBatch.from_pylist([save(total) | {"part": part}], schema=pa_schema)

    pa_schema = to_arrow_schema(states.schema)
    left = states.rdd.getNumPartitions()
    while True:
        left = -(-left // FAN_IN)
        group = F.floor(F.col("part") / FAN_IN).cast("long")
        level = states.withColumn("part", group).repartition(left, "part").sortWithinPartitions("part")
        states = level.select(*names).mapInArrow(add_up, states.schema)
        if left == 1:
            rows = states.collect()
            return rows[0].asDict() if rows else None
