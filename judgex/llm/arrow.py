"""Running slab functions over DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from judgex.session import ship


def batched(df: DataFrame) -> DataFrame:
    """``df``, whose session's Python stages get this package and batches of bounded size."""
    ship(df.sparkSession)
    return df


def over(df: DataFrame, f: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Apply ``f`` to every Arrow batch of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield from f(b)

    return batched(df).mapInArrow(run, schema)


def table(**cols: object) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in cols.values()], names=list(cols))
