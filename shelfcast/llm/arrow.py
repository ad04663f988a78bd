"""Arrow batches in, Arrow batches out, in slices of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Rows turned into Python objects at once.
SLICE_ROWS = 500


def _values(column: pa.Array) -> list:
    """Python objects; NumPy arrays where the values are lists of numbers."""
    if not (pa.types.is_list(column.type) and pa.types.is_primitive(column.type.value_type)):
        return column.to_pylist()
    ends, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    valid = column.is_valid().to_pylist()
    return [flat[i:j] if ok else None for ok, i, j in zip(valid, ends, ends[1:])]


def map_lists(
    df: DataFrame,
    start: Callable[[], Callable[..., dict[str, list]]],
    schema: StructType,
    carry: int = 0,
) -> DataFrame:
    """``mapInArrow`` over lists: ``start()`` is called once in a task and gives the function for a slice.

    The first ``carry`` columns of ``df`` pass through unread and come first in the result.  The
    function takes one list for each other column, in order, and returns a list or Arrow array for
    each column of ``schema``; it may change the number of rows where nothing is carried.
    """
    kept = df.schema.fields[:carry]
    whole = StructType(kept + schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, arrow = start(), to_arrow_schema(schema)
        for batch in batches:
            for low in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(low, SLICE_ROWS)
                new = work(*[_values(column) for column in part.columns[carry:]])
                made = [
                    n if isinstance(n := new[f.name], pa.Array) else pa.array(n, f.type)
                    for f in arrow
                ]
                yield pa.RecordBatch.from_arrays(part.columns[:carry] + made, names=whole.names)

    return df.mapInArrow(run, whole)


def batch_of(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    """Rows as one batch; ``schema`` lists ``name type`` with commas between."""
    kinds = {
        "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
        "string": pa.string(), "binary": pa.binary(),
    }
    kinds |= {f"array<{name}>": pa.list_(kind) for name, kind in list(kinds.items())}
    fields = [(name, kinds[kind]) for name, kind in (c.split() for c in schema.split(", "))]
    columns = list(zip(*rows)) or [()] * len(fields)
    arrays = [pa.array(list(c), t) for c, (_, t) in zip(columns, fields)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])
