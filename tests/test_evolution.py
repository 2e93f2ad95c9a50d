"""Tables that gain columns, and those that may not."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shockline.sources import write
from shockline.sources.evolution import IncompatibleSchema, merged, read_governed, register, versions


def run(spark, tmp_path, schema, rows, name="gold_associations", additive=True):
    """One more start of a stream, after a change of its columns."""
    n = sum(1 for _ in tmp_path.glob("in/*"))
    spark.createDataFrame(rows, schema).write.json(f"{tmp_path}/in/{n}")
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).json(f"{tmp_path}/in")
    q = write.append_stream(stream, f"{tmp_path}/t", f"{tmp_path}/c", name, additive=additive, once=True)
    q.awaitTermination()
    assert q.exception() is None


def test_a_column_that_is_added_reads_back(spark, tmp_path):
    run(spark, tmp_path, "id string, n int, price decimal(8,2)", [("a", 1, None)])
    run(spark, tmp_path, "id string, n bigint, price decimal(12,2), place struct<x: double>", [("b", 1 << 40, None, (1.5,))])
    run(spark, tmp_path, "id string, place struct<x: double, y: double>", [("c", (2.5, 3.5))])
    assert [v for v, _ in versions(spark, f"{tmp_path}/t")] == [1, 2, 3]
    rows = read_governed(spark, f"{tmp_path}/t")
    assert rows.schema.simpleString() == "struct<id:string,n:bigint,price:decimal(12,2),place:struct<x:double,y:double>>"
    got = {r.id: (r.n, None if r.place is None else (r.place.x, r.place.y)) for r in rows.collect()}
    assert got == {"a": (1, None), "b": (1 << 40, (1.5, None)), "c": (None, (2.5, 3.5))}
    assert read_governed(spark, f"{tmp_path}/t", 2).columns == ["id", "n", "price", "place"]
    run(spark, tmp_path, "id string, n int", [("d", 4)])  # an older writer makes no version
    assert len(versions(spark, f"{tmp_path}/t")) == 3 and read_governed(spark, f"{tmp_path}/t").where("id = 'd'").first().n == 4


@pytest.mark.parametrize("schema", ["id int, n int", "id string, n string", "id string, N int", "id string, n array<int>"])
def test_what_is_incompatible_is_refused_before_the_start(spark, tmp_path, schema):
    register(spark, f"{tmp_path}/t", T.StructType.fromDDL("id string, n int"), True)
    stream = spark.readStream.format("rate").load().select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(schema)))
    with pytest.raises(IncompatibleSchema):
        write.append_stream(stream, f"{tmp_path}/t", f"{tmp_path}/c", "gold_associations", additive=True, once=True)
    assert len(versions(spark, f"{tmp_path}/t")) == 1


def test_fixed_tables_gain_nothing(spark, tmp_path):
    schema = T.StructType.fromDDL("id string, n int")
    assert register(spark, str(tmp_path), schema, False) == 1 == register(spark, str(tmp_path), schema, False)
    for more in ("id string, n int, m int", "id string, n bigint"):
        with pytest.raises(IncompatibleSchema):
            register(spark, str(tmp_path), T.StructType.fromDDL(more), False)


def test_merging_keeps_order_and_is_idempotent():
    a, b = T.StructType.fromDDL("x int, y array<struct<p: float>>"), T.StructType.fromDDL("z map<string,int>, y array<struct<p: double, q: string>>, x bigint")
    both = merged(a, b)
    assert both.simpleString() == "struct<x:bigint,y:array<struct<p:double,q:string>>,z:map<string,int>>"
    assert merged(both, a) == both == merged(both, b)
