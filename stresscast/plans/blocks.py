"""Rows of one key packed into blocks: the unit that meets a model's parameters or draws.

A block is one row with its key, a matrix of doubles and the identifiers of its rows as arrays. Joining blocks instead
of rows to a table with one row per key copies the key's parameters once a block, and a hot key is many blocks that
any number of tasks share.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, StructField, StructType

#: Rows of a block at most.
BLOCK_ROWS = 2048


def matrix(packed: bytes, width: int) -> np.ndarray:
    return np.frombuffer(packed, float).reshape(-1, width)


def key_blocks(df: DataFrame, keys: Sequence[str], values: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """``keys``, ``block`` (row-major doubles of ``values``, NULL as NaN) and an array per column of ``ids``.

    Rows are sorted by key within their partition, so no row moves; a block ends with its key, its size or its Arrow batch.
    """
    keys, values, ids = list(keys), list(values), list(ids)
    src = df.select(*keys, *[c for c in ids if c not in keys], *values)
    schema = StructType([src.schema[k] for k in keys] + [StructField("block", BinaryType())] +
                        [StructField(f"_{c}", ArrayType(src.schema[c].dataType)) for c in ids])

    def pack(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            rows = list(zip(*(batch.column(k).to_pylist() for k in keys))) if keys else [()] * n
            starts = [0]
            for i in range(1, n):
                if rows[i] != rows[i - 1] or i - starts[-1] == BLOCK_ROWS:
                    starts.append(i)
            m = np.column_stack([batch.column(v).cast(pa.float64()).to_numpy(zero_copy_only=False) for v in values]
                                or [np.zeros((n, 0))])
            ends, first = [*starts[1:], n], pa.array(starts)
            bounds = pa.array([*starts, n], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).take(first) for k in keys),
                 pa.array([np.ascontiguousarray(m[a:b]).tobytes() for a, b in zip(starts, ends)], pa.binary()),
                 *(pa.ListArray.from_arrays(bounds, batch.column(c)) for c in ids)], names=schema.names)

    return (src.sortWithinPartitions(*keys) if keys else src).mapInArrow(pack, schema)
