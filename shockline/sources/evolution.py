"""Governed schemas: versions beside a table, additive changes only, reads under the latest version.

    <path>/_schemas/<version>.json    the schema that was in force from then on
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .committed import Files


class IncompatibleSchema(ValueError):
    """A change that old rows or old readers can't bear."""


#: Types that hold all values of another, which Parquet readers widen.
WIDER = {
    T.ByteType: (T.ShortType, T.IntegerType, T.LongType), T.ShortType: (T.IntegerType, T.LongType), T.IntegerType: (T.LongType, T.DoubleType),
    T.FloatType: (T.DoubleType,), T.DateType: (), T.LongType: (),
}


def widened(old: T.DataType, new: T.DataType, at: str) -> T.DataType:
    """The type that holds both: one that is as wide as the other, field by field in structs; otherwise an error."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return merged(old, new, f"{at}.")
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(widened(old.elementType, new.elementType, f"{at}[]"), True)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType) and old.keyType == new.keyType:
        return T.MapType(old.keyType, widened(old.valueType, new.valueType, f"{at}{{}}"), True)
    if old == new or type(old) in WIDER.get(type(new), ()):
        return old
    if type(new) in WIDER.get(type(old), ()):
        return new
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        scale, whole = max(old.scale, new.scale), max(old.precision - old.scale, new.precision - new.scale)
        if scale + whole <= 38 and (old.scale == new.scale):
            return T.DecimalType(scale + whole, scale)
    raise IncompatibleSchema(f"{at}: {old.simpleString()} doesn't go with {new.simpleString()}")


def merged(old: T.StructType, new: T.StructType, at: str = "") -> T.StructType:
    """Old fields in their order, widened where need be, then new ones, which are nullable. A field that the new schema lacks stays."""
    have = {f.name.lower(): f for f in new}
    if len(have) != len(new.fields):
        raise IncompatibleSchema(f"{at or 'schema'}: names differ in case only")
    fields = []
    for f in old:
        other = have.pop(f.name.lower(), None)
        if other is not None and other.name != f.name:
            raise IncompatibleSchema(f"{at}{f.name}: is also called {other.name}")
        fields.append(T.StructField(f.name, f.dataType if other is None else widened(f.dataType, other.dataType, f"{at}{f.name}"), True))
    return T.StructType([*fields, *(T.StructField(f.name, f.dataType, True) for f in new if f.name.lower() in have)])


def as_nullable(schema: T.StructType) -> T.StructType:
    return merged(schema, schema)


def versions(spark: SparkSession, path: str) -> list[tuple[int, T.StructType]]:
    files = Files(spark)
    names = [n for n in files.names(f"{path}/_schemas") if n.endswith(".json") and not n.startswith(".")]
    return [(int(n[:-5]), T.StructType.fromJson(json.loads(files.read(f"{path}/_schemas/{n}")))) for n in names]


def register(spark: SparkSession, path: str, schema: T.StructType, additive: bool, retries: int = 5) -> int:
    """Check a writer's schema before it starts, and put a version of the table's schema on record if it changes; the version in force.

    additive: whether the table may gain columns and wider types. A table of fixed columns takes the recorded ones only.
    Of two writers one makes a version, and the other one is checked again, against that.
    """
    for _ in range(retries):
        known = versions(spark, path)
        last, old = known[-1] if known else (0, None)
        wanted = as_nullable(schema) if old is None else merged(old, schema)
        if wanted == old:
            return last
        if old is not None and not additive:
            raise IncompatibleSchema(f"{path} has fixed columns; not among them, or of another type: {[f.name for f in wanted if f not in old.fields]}")
        if Files(spark).create(f"{path}/_schemas/{last + 1:08d}.json", json.dumps(wanted.jsonValue())):
            return last + 1
    raise IncompatibleSchema(f"{path}: other writers changed the schema {retries} times")


def read_governed(spark: SparkSession, path: str, version: int | None = None, format: str = "parquet") -> DataFrame:
    """All rows under a version's schema, the latest one if none is named: columns that a file lacks are null, narrower types are widened."""
    known = dict(versions(spark, path))
    if not known:
        raise ValueError(f"no schema on record for {path}")
    return spark.read.schema(known[max(known) if version is None else version]).format(format).load(path)
