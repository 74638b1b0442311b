"""A value whose JSON kind is not its column's goes through the lenient rules with its kind worked out once."""

from pyspark.sql import types as T

from tidemark.functions.conform import conform


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toJSON()


def test_kind_of_a_value_is_worked_out_once(spark):
    df = spark.createDataFrame([('{"n": 12.7}',), ('{"n": "3"}',), ('{"n": 5}',)], "payload string")
    schema = T.StructType([T.StructField("n", T.LongType())])
    out = conform(df, "payload", schema)
    assert [r.n for r in out.collect()] == [12, 3, 5]
    # once for the value, the rest in the message of an error (88 times before)
    assert _plan(out).count("SchemaOfVariant") <= 4


def test_a_list_of_texts_keeps_its_items(spark):
    df = spark.createDataFrame([('{"tags": ["a", 1, true]}',), ('{"tags": "b"}',)], "payload string")
    schema = T.StructType([T.StructField("tags", T.ArrayType(T.StringType()))])
    assert [r.tags for r in conform(df, "payload", schema).collect()] == [["a", "1", "true"], ["b"]]
