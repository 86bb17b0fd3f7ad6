"""Schemas of a table and of rows to write, compared and united at any depth: in structs, arrays and maps.

A field may get a wider type, one that holds every old value: whole numbers of more bytes, a double for a float or a
whole number of at most 4 bytes, a decimal with at least as many digits before and after the point. Whether a field
may be NULL plays no part; a table's fields all may.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}  # and their decimal digits
ORDER = list(WHOLE)


class SchemaMismatch(ValueError):
    """The rows to write do not fit the table's columns."""


def is_same(a: T.DataType, b: T.DataType) -> bool:
    return a.simpleString() == b.simpleString()


def holds(wide: T.DataType, narrow: T.DataType) -> bool:
    """Whether every value of the narrow simple type has an equal one in the wide type."""
    if is_same(wide, narrow):
        return True
    if isinstance(wide, T.DecimalType):
        if isinstance(narrow, T.DecimalType):
            return wide.scale >= narrow.scale and wide.precision - wide.scale >= narrow.precision - narrow.scale
        return type(narrow) in WHOLE and wide.precision - wide.scale >= WHOLE[type(narrow)]
    if isinstance(wide, T.DoubleType):
        return isinstance(narrow, (T.FloatType, T.ByteType, T.ShortType, T.IntegerType))
    if type(wide) in WHOLE and type(narrow) in WHOLE:
        return ORDER.index(type(wide)) >= ORDER.index(type(narrow))
    return False


def problems(have: T.DataType, new: T.DataType, path: str = "") -> list[str]:
    """What in a new type does not fit the table's: fields that it lacks, and types that it can't hold."""
    if isinstance(have, T.StructType) and isinstance(new, T.StructType):
        types = {f.name: f.dataType for f in have.fields}
        out = []
        for f in new.fields:
            name = f"{path}.{f.name}" if path else f.name
            out += problems(types[f.name], f.dataType, name) if f.name in types else [f"{name} is not in the table"]
        return out
    if isinstance(have, T.ArrayType) and isinstance(new, T.ArrayType):
        return problems(have.elementType, new.elementType, f"{path}.element")
    if isinstance(have, T.MapType) and isinstance(new, T.MapType):
        return problems(have.keyType, new.keyType, f"{path}.key") + problems(have.valueType, new.valueType, f"{path}.value")
    return [] if holds(have, new) else [f"{path} is {new.simpleString()}, not {have.simpleString()}"]


def check_fits(have: T.StructType, new: T.StructType) -> None:
    """Raise unless the table has all fields of the new rows, at any depth, with types that hold theirs."""
    found = problems(have, new)
    if found:
        raise SchemaMismatch("; ".join(found))


def united(have: T.DataType, new: T.DataType, path: str = "") -> T.DataType:
    """The table's type with the fields that only the new one has behind its own, and the wider of both types."""
    if isinstance(have, T.StructType) and isinstance(new, T.StructType):
        theirs = {f.name: f.dataType for f in new.fields}
        own = {f.name for f in have.fields}
        at = lambda name: f"{path}.{name}" if path else name
        fields = [T.StructField(f.name, united(f.dataType, theirs[f.name], at(f.name)) if f.name in theirs else f.dataType) for f in have.fields]
        return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in new.fields if f.name not in own])
    if isinstance(have, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(united(have.elementType, new.elementType, f"{path}.element"))
    if isinstance(have, T.MapType) and isinstance(new, T.MapType):
        return T.MapType(united(have.keyType, new.keyType, f"{path}.key"), united(have.valueType, new.valueType, f"{path}.value"))
    if holds(have, new):
        return have
    if holds(new, have):
        return new
    raise SchemaMismatch(f"{path} is {new.simpleString()}, not {have.simpleString()}, and neither holds the other")


def merged_schema(have: T.StructType, new: T.StructType) -> T.StructType:
    return united(have, new)


def brought(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value in another type that holds it; fields that it lacks are NULL, a NULL stays one."""
    if is_same(have, want):
        return value
    if isinstance(want, T.StructType):
        types = {f.name: f.dataType for f in have.fields}
        fields = [
            brought(value.getField(f.name), types[f.name], f.dataType) if f.name in types else F.lit(None).cast(f.dataType)
            for f in want.fields
        ]
        struct = F.struct(*(c.alias(f.name) for c, f in zip(fields, want.fields)))
        return F.when(value.isNotNull(), struct)
    if isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: brought(x, have.elementType, want.elementType))
    if isinstance(want, T.MapType):
        keys = F.transform(F.map_keys(value), lambda x: brought(x, have.keyType, want.keyType))
        values = F.transform(F.map_values(value), lambda x: brought(x, have.valueType, want.valueType))
        return F.map_from_arrays(keys, values)
    return value.cast(want)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows in a schema that has all their fields; what they lack becomes NULL."""
    types = {f.name: f.dataType for f in df.schema.fields}
    columns = []
    for f in schema.fields:
        own = F.col(f"`{f.name}`")
        columns.append((brought(own, types[f.name], f.dataType) if f.name in types else F.lit(None).cast(f.dataType)).alias(f.name))
    return df.select(*columns)
