import pytest
from pyspark.sql import functions as F

from sediment.operators import documents as docs

TEXTS = [
    (1, '{"a": {"b": [1, "two", null, {"c": 3}, [4]]}, "z": 0}', "keep"),
    (2, '{"a": {"b": {"y": 1, "x": "é"}}}', None),
    (3, '{"a": {"b": []}}', "keep"),
    (4, '{"a": {"b": 7}}', "keep"),
    (5, '{"a": null}', "keep"),
    (6, "[]", "keep"),
    (7, None, "keep"),
]


def opened(df, **how):
    rows = docs.explode_variant(df, "text", "$.a.b", "value", **how)
    assert rows.columns == ["doc_0", "text", "pos", "value", "value_pos", "value_key"]
    found = rows.select("doc_0", "pos", "value_pos", "value_key", F.to_json("value").alias("v"))
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_elements_and_fields_of_any_shape(spark):
    df = spark.createDataFrame(TEXTS, "doc_0 int, text string, pos string")  # names that the function uses itself
    want = [(1, "keep", i, None, v) for i, v in enumerate(["1", '"two"', "null", '{"c":3}', "[4]"])]
    want += [(2, None, 0, "x", '"é"'), (2, None, 1, "y", "1")]
    assert opened(df) == sorted(want, key=str)


def test_text_that_is_not_json(spark):
    df = spark.createDataFrame([*TEXTS, (8, '{"a": {"b": [1', "keep")], "doc_0 int, text string, pos string")
    assert {r[0] for r in opened(df, strict=False)} == {1, 2}
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        opened(df)


def test_same_rows_as_with_a_known_shape(spark):
    texts = [(i, '{"s": {"items": [' + ", ".join(f'{{"kind": "k{j}", "n": "{i * j}"}}' for j in range(i % 4)) + "]}}") for i in range(40)]
    df = spark.createDataFrame(texts, "i int, text string").repartition(3)
    typed = docs.explode_json(df, "text", "$.s.items", "x", "struct<kind:string,n:string>").select("i", "x.kind", "x.n")
    free = docs.explode_variant(df, "text", "$.s.items", "x").select(
        "i", docs.variant_value("x", "$.kind").alias("kind"), docs.variant_value("x", "$.n").alias("n")
    )
    assert sorted(map(tuple, typed.collect())) == sorted(map(tuple, free.collect()))


def test_values_of_other_types_are_null(spark):
    row = spark.sql("""select parse_json('{"a": "x", "b": 5, "c": null}') as v""").select(
        docs.variant_value("v", "$.a", "int"), docs.variant_value("v", "$.b", "int"), docs.variant_value("v", "$.c"), docs.variant_value("v", "$.d")
    ).first()
    assert tuple(row) == (None, 5, None, None)
