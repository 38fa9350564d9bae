"""Arrow functions that Spark evaluates once per row and reference."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T


def arrow_function(return_type: T.DataType) -> Callable:
    """Decorator for an Arrow UDF over whole batches.

    The functions are pure, but are declared non-deterministic: the optimizer may copy a deterministic function into every
    filter and projection that mentions its result, and would then run it several times per row.
    """
    return lambda function: F.arrow_udf(function, return_type).asNondeterministic()


CHUNK_ROWS = 64


def map_values(kind: pa.DataType, convert: Callable, *columns: pa.Array) -> pa.Array:
    """Apply a small helper value by value. Results are Arrow data after every CHUNK_ROWS, so few are held as Python objects, which take many times the room."""
    chunks = [pa.array([], kind)]
    for at in range(0, len(columns[0]), CHUNK_ROWS):
        chunks.append(pa.array([convert(*[value.as_py() for value in row]) for row in zip(*[c.slice(at, CHUNK_ROWS) for c in columns])], kind))
    return pa.concat_arrays(chunks)
