"""Documents of different shape in one column: typed fields, round trip, inferred shape."""

import json

from pyspark.sql import functions as F

from quarry.operators.documents import (field, nested_columns, process_documents, shape_of, table_documents, through_json)


def documents(spark):
    columns = spark.createDataFrame([("t", "a", "int", 1), ("t", "b", "string", 2), ("u", "c", "double", 1)],
                                    "table_name string, column_name string, data_type string, position int")
    profiles = spark.createDataFrame([("t", "a", 5, 0), ("t", "b", 5, 2), ("u", "c", 0, 0)],
                                     "table_name string, column_name string, row_count long, null_count long")
    processes = spark.createDataFrame([("etl.x", ["s.a, with a comma", "s.b"], [])], "process_qn string, inputs array<string>, outputs array<string>")
    return (table_documents(columns, profiles, "source").unionByName(table_documents(columns, profiles, "raw", "type"))
            .unionByName(process_documents(processes)))


def test_fields_meet_whatever_their_name(spark):
    got = {tuple(r) for r in nested_columns(documents(spark)).collect()}
    for layer in ("source", "raw"):
        assert {r[1:] for r in got if r[0] == f"{layer}.t"} == {(1, "a", "int", 0), (2, "b", "string", 2)}
    assert ("raw.u", 1, "c", "double", 0) in got and not any(r[0] == "etl.x" for r in got)


def test_through_json_and_back(spark):
    def text(df):
        return {r[0]: json.loads(r[1]) for r in df.select("qualified_name", F.to_json("document")).collect()}
    one = documents(spark)
    assert text(through_json(one)) == text(one)
    assert text(one)["etl.x"] == {"kind": "process", "name": "etl.x", "inputs": ["s.a, with a comma", "s.b"], "outputs": []}


def test_missing_and_unreadable_fields_are_null(spark):
    row = documents(spark).where("qualified_name = 'source.t'").select(
        field("document", ["$.nothing"], "string"), field("document", ["$.name"], "int"), field("document", ["$.none", "$.rows"], "long")).first()
    assert tuple(row) == (None, None, 5)


def test_shape_of_all_rows(spark):
    shapes = {r["kind"]: r["shape"] for r in shape_of(documents(spark)).collect()}
    assert "dataType: STRING" in shapes["table"] and "type: STRING" in shapes["table"] and "inputs: ARRAY<STRING>" in shapes["process"]
