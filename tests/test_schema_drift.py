import json

from tidelane.operators.schema_drift import damaged, held_fields, ingest, promote, schema_changes

SCHEMA = "feed string, no long, line string"


def records(spark, lines, target=None):
    df = spark.createDataFrame([(f, n, x if x is None or isinstance(x, str) else json.dumps(x)) for f, n, x in lines], SCHEMA)
    return df, ingest(df, "line", ["feed", "no"], target or {"n": "bigint", "name": "string"})


def changes(spark, lines):
    df, _ = records(spark, lines)
    return {tuple(r) for r in schema_changes(df, "line", {"ep": "string", "topic": "string", "fps": "bigint", "x": "double"}, feed="feed", file_no="no", pair_keys=["ep", "topic"]).collect()}


def test_strict_ingestion_tells_all_fields_by_columns_and_rescue(spark):
    lines = [("a", 1, {"n": 5, "name": "x"}), ("a", 1, {"n": "7", "name": 3, 'q"\n': [1]}), ("a", 1, {"n": None, "name": "", "o": {"p": 1}})]
    df = spark.createDataFrame([(f, n, json.dumps(x)) for f, n, x in lines], SCHEMA)
    rows = ingest(df, "line", ["feed", "no"], {"n": "bigint", "name": "string"}, strict=True)
    got = sorted(((r.t_n, r.t_name, json.loads(r.rescued) if r.rescued else None) for r in rows.collect()), key=str)
    assert got == sorted([(5, "x", None), (None, None, {"n": "7", "name": 3, 'q"\n': [1]}), (None, "", {"n": None, "o": {"p": 1}})], key=str)
    told = {(r.name, r.kind) for r in held_fields(rows, ["no"], {"n": "bigint", "name": "string"}, values=False).collect()}
    assert told == {("n", "number"), ("n", "string"), ("n", None), ("name", "string"), ("name", "number"), ('q"\n', "array"), ("o", "object")}


def test_typed_and_rescued_values(spark):
    _, rows = records(spark, [("a", 1, {"n": 5, "name": "x"}), ("a", 1, {"n": "7", "name": 3, "new": [1]}), ("a", 1, {"n": "seven", "name": None, "o": {"p": 1}})])
    got = {(r.t_n, r.t_name): json.loads(r.rescued) if r.rescued else None for r in rows.collect()}
    assert got == {(5, "x"): None, (7, "3"): {"new": [1]}, (None, None): {"n": "seven", "o": {"p": 1}}}


def test_promote_replays_rescued_values(spark):
    _, rows = records(spark, [("a", 1, {"k": 4}), ("a", 1, {"k": "four", "z": 1}), ("a", 1, {"z": 2})])
    got = sorted((r.t_k or 0, r.rescued or "") for r in promote(rows, "k", "bigint").collect())
    assert got == [(0, '{"k":"four","z":1}'), (0, '{"z":2}'), (4, "")]


def test_damaged_lines(spark, crowded):
    lines = [None, "", "   ", "null", "[1]", "3", '{"a": 1', '{"a": 1} tail', '{"a":1,"a":2}', "-- end --", '{"a": "' + "x" * 100_000 + '"}', "{}"]
    df = crowded(spark.createDataFrame([("a", 1, x) for x in lines], SCHEMA))
    assert damaged(df, "line").count() == 10
    assert ingest(df, "line", ["feed"], {"a": "string"}).count() == 2


def test_changes_between_files(spark):
    base = {"ep": "1", "topic": "t"}
    lines = [
        ("a", 1, base | {"fps": 3, "old": "q", "kind": "s", "gone": 1}),
        ("a", 1, {"ep": "2", "topic": "t", "fps": 4, "old": "p", "kind": None}),
        ("a", 4, base | {"fps": "3", "new": "q", "kind": "s", "extra": True}),
        ("a", 4, {"ep": "2", "topic": "t", "new": "p"}),
        ("a", 4, {"ep": "9", "topic": "t", "new": "other"}),
        ("b", 1, base),
        (None, 1, base | {"z": 1}),
        (None, 2, base),
    ]
    assert changes(spark, lines) == {("a", 4, "retyped", "fps", "fps"), ("a", 4, "renamed", "old", "new"), ("a", 4, "removed", "gone", "gone"), ("a", 4, "added", "extra", "extra")}


def test_rename_needs_equal_values_everywhere(spark):
    lines = [("a", 1, {"ep": "1", "topic": "t", "x": 1}), ("a", 1, {"ep": "2", "topic": "t", "x": 2}), ("a", 2, {"ep": "1", "topic": "t", "y": 1}), ("a", 2, {"ep": "2", "topic": "t", "y": 3})]
    assert changes(spark, lines) == {("a", 2, "removed", "x", "x"), ("a", 2, "added", "y", "y")}


def test_rename_takes_each_field_once(spark):
    lines = [("a", 1, {"ep": "1", "topic": "t", "x": 1}), ("a", 2, {"ep": "1", "topic": "t", "y": 1, "z": 1})]
    assert changes(spark, lines) == {("a", 2, "renamed", "x", "y"), ("a", 2, "added", "z", "z")}


def test_nulls_tell_nothing_and_damaged_files_are_present(spark):
    lines = [("a", 1, {"ep": "1", "x": None}), ("a", 2, {"ep": "1", "x": 3}), ("a", 3, "broken"), ("a", 3, {"ep": None, "x": "s"})]
    assert changes(spark, lines) == {("a", 3, "retyped", "x", "x")}
    assert changes(spark, []) == set()
