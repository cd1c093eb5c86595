"""Plain functions of values over columns."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Rows whose values are Python's at once; the rest of a batch stays in Arrow.
ROWS = 500


def in_parts(f: Callable, kind: pa.DataType, *arrays: pa.Array) -> pa.Array:
    """f of each row's values, nulls as None, some rows at a time, so that of a batch of whole texts one copy is held."""
    starts = range(0, len(arrays[0]) or 1, ROWS)
    return pa.concat_arrays([pa.array([f(*(x.as_py() for x in row)) for row in zip(*(a[at : at + ROWS] for a in arrays))], kind) for at in starts])


def by_value(f: Callable, kind: pa.DataType, sql_kind: str) -> Callable[..., Column]:
    """f as a function of columns that gives values of sql_kind, which is kind in Arrow. f gets all rows, also those with
    nulls."""

    def values(*arrays: pa.Array) -> pa.Array:
        return in_parts(f, kind, *arrays)

    values.__annotations__ = {"arrays": pa.Array, "return": pa.Array}
    udf: Any = F.arrow_udf(values, sql_kind)
    return udf
