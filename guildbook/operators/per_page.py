"""Rows out of pages inside tasks, on Arrow batches: keys go through as they are, whatever their type."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _arrow(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    if isinstance(kind, T.MapType):
        return pa.map_(_arrow(kind.keyType), _arrow(kind.valueType))
    if isinstance(kind, T.StructType):
        return pa.struct([(f.name, _arrow(f.dataType)) for f in kind])
    return {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_()}[kind.simpleString()]


def each_page(pages: DataFrame, keys: list[str], given: list[str], one: Callable[..., Iterable[tuple]], fields: str) -> DataFrame:
    """keys and fields (a schema, "name type, ..."): the rows that one() gives for the given columns of each page. Keys aren't turned
    into Python or pandas values: a large number beside a null would come back as a rounded float."""
    kinds = [(f.name, _arrow(f.dataType)) for f in T.StructType.fromDDL(fields)]
    asked = [*keys, *[g for g in given if g not in keys]]

    def run(batches):
        for batch in batches:
            which, rows = [], []
            for k, values in enumerate(zip(*[batch.column(asked.index(g)).to_pylist() for g in given], strict=True)):
                found = list(one(*values))
                which += [k] * len(found)
                rows += found
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            kept = [batch.column(k).take(pa.array(which, pa.int64())) for k in range(len(keys))]
            yield pa.RecordBatch.from_arrays([*kept, *[pa.array(c, t) for c, (_, t) in zip(columns, kinds, strict=True)]], [*keys, *[n for n, _ in kinds]])

    types = ", ".join(f"`{k}` {pages.schema[k].dataType.simpleString()}" for k in keys)
    return pages.select(*asked).mapInArrow(run, f"{types}, {fields}")
