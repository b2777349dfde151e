import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medloom.functions.paths import Node
from medloom.operators.flatten import Col, Columns, ForEach, Repeat, UnionAll, View, column_names, descend, flatten_parsed
from medloom.plans.views import ALL_VIEWS


def run(spark, schema, value, view):
    dtype = T.DataType.fromDDL(schema)
    df = spark.createDataFrame([(json.dumps(v),) for v in value], "text string")
    return flatten_parsed(df.select(F.from_json("text", dtype).alias("r")), view, "r", dtype)


def col(name, path, **more):
    return Col(name, lambda n: n.get(path), **more)


def test_all_views_have_unique_columns():
    assert len(ALL_VIEWS) == 26
    for view in ALL_VIEWS.values():
        names = [n for p in view.select for n in column_names(p)]
        assert len(names) == len(set(names))


def test_for_each_and_or_null(spark):
    schema = "struct<id:string,name:array<struct<given:array<string>>>>"
    data = [{"id": "a", "name": [{"given": ["x", "y"]}, {"given": ["z"]}]}, {"id": "b"}]

    def view(or_null):
        inner = Columns((Col("given", lambda n: n.get("given").first()),))
        return View("v", "X", (Columns((col("id", "id"),)), ForEach(lambda n: n.get("name"), (inner,), or_null)))

    assert sorted(map(tuple, run(spark, schema, data, view(False)).collect())) == [("a", "x"), ("a", "z")]
    got = {tuple(r) for r in run(spark, schema, data, view(True)).collect()}
    assert got == {("a", "x"), ("a", "z"), ("b", None)}


def test_two_values_are_an_error_unless_collection(spark):
    schema, data = "struct<id:string,tags:array<string>>", [{"id": "a", "tags": ["x", "y"]}]
    keep = View("v", "X", (Columns((col("tags", "tags", collection=True),)),))
    assert run(spark, schema, data, keep).first()[0] == ["x", "y"]
    with pytest.raises(PySparkException, match="more than one value"):
        run(spark, schema, data, View("v", "X", (Columns((col("tags", "tags"),)),))).collect()


def test_where_takes_undefined_as_false_and_wants_booleans(spark):
    schema, data = "struct<id:string,active:boolean>", [{"id": "a", "active": True}, {"id": "b"}]
    cols = (Columns((col("id", "id"),)),)
    got = run(spark, schema, data, View("v", "X", cols, (lambda n: n.get("active").equals(True),)))
    assert [r[0] for r in got.collect()] == ["a"]
    with pytest.raises(TypeError):
        run(spark, schema, data, View("v", "X", cols, (lambda n: n.get("id"),)))


def test_union_branches_must_agree(spark):
    part = UnionAll((Columns((col("a", "id"),)), Columns((col("b", "id"),))))
    with pytest.raises(ValueError, match="differ"):
        column_names(part)


def test_repeat_descends_to_every_depth(spark):
    schema = "struct<id:string,item:array<struct<k:string,item:array<struct<k:string,item:array<struct<k:string>>>>>>>"
    data = [{"id": "a", "item": [{"k": "1", "item": [{"k": "1.1", "item": [{"k": "1.1.1"}]}, {"k": "1.2"}]}, {"k": "2"}]}]
    view = View("v", "X", (Columns((col("id", "id"),)), Repeat(lambda n: n.get("item"), (Columns((col("k", "k"),)),))))
    got = sorted(r.k for r in run(spark, schema, data, view).collect())
    assert got == ["1", "1.1", "1.1.1", "1.2", "2"]


def test_repeat_has_no_depth_of_its_own(spark):
    schema, item = "struct<k:string>", {"k": "12"}
    for level in range(11, 0, -1):
        schema, item = f"struct<k:string,item:array<{schema}>>", {"k": str(level), "item": [item]}
    view = View("v", "X", (Repeat(lambda n: n.get("item"), (Columns((col("k", "k"),)),)),))
    got = run(spark, f"struct<item:array<{schema}>>", [{"item": [item]}], view).collect()
    assert sorted(int(r.k) for r in got) == list(range(1, 13))


@pytest.mark.parametrize(
    ("reference", "kind", "want"),
    [
        ("Patient/p1", None, "p1"),
        ("Patient/p1", "Patient", "p1"),
        ("Patient/p1", "Group", None),
        ("urn:uuid:abc", None, "abc"),
        ("urn:uuid:abc", "Patient", None),
        ("https://host/fhir/Patient/p1/_history/3", "Patient", "p1"),
        ("", None, None),
    ],
)
def test_reference_key(spark, reference, kind, want):
    dtype = T.DataType.fromDDL("struct<reference:string>")
    df = spark.createDataFrame([((reference,),)], T.StructType([T.StructField("r", dtype)]))
    assert df.select(Node(F.col("r"), dtype).reference_key(kind).col).first()[0] == want


def test_unknown_element_fails_at_build_time():
    with pytest.raises(KeyError):
        Node(None, T.StructType([])).get("b")


def test_descend_has_no_depth_limit(spark):
    deep = {"linkId": "40"}
    for n in range(39, 0, -1):
        deep = {"linkId": str(n), "item": [deep, {"linkId": f"{n}b", "item": None}]}
    rows = [
        ("Q", "deep", json.dumps({"item": [deep]})),
        ("Q", "mixed", json.dumps({"item": {"linkId": "a", "answer": [{"item": [{"linkId": "b"}]}, 5, {"item": [{"linkId": 7}]}], "item": [{"x": 1}, None]}})),
        ("Q", "none", json.dumps({"id": "x"})),
        ("Q", "scalar", json.dumps({"item": 3})),
        ("Q", "broken", "{"),
        ("Q", None, None),
        ("P", "other", json.dumps({"item": [{"linkId": "z"}]})),
    ]
    df = spark.createDataFrame(rows, "resource_type string, id string, resource string")
    found = descend(df, "Q", ["item", "answer.item"], {"link": ("linkId", "string")})
    got = {}
    for r in sorted(found.collect(), key=lambda r: r.place):
        got.setdefault(r.id, []).append((r.link, r.depth))
    want = [(str(n), n) for n in range(1, 41)] + [(f"{n}b", n + 1) for n in range(39, 0, -1)]
    assert got["deep"] == want
    assert got["mixed"] == [("a", 1), (None, 2), ("b", 2), ("7", 2)]
    assert got["scalar"] == [(None, 1)] and set(got) == {"deep", "mixed", "scalar"}
    empty = descend(df.limit(0), "Q", ["item"], {"link": ("linkId", "string")})
    assert empty.columns == found.columns and empty.dtypes == found.dtypes and empty.isEmpty()
    with pytest.raises(ValueError, match="repeat"):
        descend(df, "Q", ["item"], {"depth": ("linkId", "string")})
