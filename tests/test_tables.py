"""Imported, layered and rebuilt tables, and what must fail."""

from __future__ import annotations

import json

import pytest

from tidemill.operators import layers
from tidemill.operators.layers import Step
from tidemill.sources import snapshots, tables

SCHEMA = "id string, language string, retained boolean, record_json string"


@pytest.fixture
def table(spark, tmp_path):
    from pyspark.sql.types import StructType

    lines = [{"id": f"r{i}", "language": "zh", "retained": True, "record_json": json.dumps({"metadata": {"n": 9007199254740993 + i}, "target": ""}, separators=(",", ":"))} for i in range(5)]
    (tmp_path / "in.jsonl").write_text("\n\n".join(map(json.dumps, lines)) + "\n")
    root = str(tmp_path / "table")
    schema = StructType.fromDDL(SCHEMA)
    tables.import_lines(spark, str(tmp_path / "in.jsonl"), schema, root)
    return root


def patches(spark, rows):
    return spark.createDataFrame(rows, "id string, changes map<string,string>, status string")


def test_layers_make_versions(spark, table):
    step = Step("fix", ("target", "$membership"), ("target",))
    layer = patches(spark, [("r1", {"target": '"x"'}, "keep"), ("r2", {}, "delete")])
    made = tables.materialise(spark, table, 0, layer, step)
    assert (made.version, made.parent, made.count) == (1, 0, 5)
    assert tables.materialise(spark, table, 0, layer, step) == made  # done already
    rows = {r["id"]: r for r in snapshots.open_version(spark, table, 1).collect()}
    assert json.loads(rows["r1"]["record_json"]) == {"metadata": {"n": 9007199254740994}, "target": "x"}
    assert not rows["r2"]["retained"] and rows["r3"]["retained"]
    again = tables.rebuilt(snapshots.open_version(spark, table, 0), [(layer, step)])
    assert tables.equivalent(again, snapshots.open_version(spark, table, 1))
    assert not tables.equivalent(again, snapshots.open_version(spark, table, 0))
    with pytest.raises(ValueError, match="latest"):
        tables.materialise(spark, table, 0, layer, Step("other", ("target",), ("target",)))
    with pytest.raises(ValueError, match="no visible parent"):
        tables.materialise(spark, table, 1, patches(spark, [("r2", {"target": '"y"'}, "keep")]), Step("late", ("target",), ("target",)))
    assert tables.inspect(spark, table) == {"versions": [0, 1], "unpublished": []}


@pytest.mark.parametrize("rows, step, match", [
    ([("nope", {"target": '"x"'}, "keep")], Step("s", ("target",), ("target",)), "no visible parent"),
    ([("r1", {"target": '"x"'}, "keep")] * 2, Step("s", ("target",), ("target",)), "given twice"),
    ([("r1", {"language": '"x"'}, "keep")], Step("s", ("target",)), "declared"),
    ([("r1", {"target": '"x"'}, "keep")], Step("s", ("target",)), "override"),
    ([("r1", {}, "delete")], Step("s", ("target",)), "delete"),
])
def test_broken_layers_publish_nothing(spark, table, rows, step, match):
    with pytest.raises(ValueError, match=match):
        tables.materialise(spark, table, 0, patches(spark, rows), step)
    assert tables.versions(spark, table) == [0]


def test_clean_up_and_shards(spark, table):
    snapshots.compact(spark, table, 0, 1, 3)
    snapshots.compact(spark, table, 1, 2, 4)
    assert tables.clean_up(spark, table, {0}) == [1] and tables.versions(spark, table) == [0, 1, 2]
    assert tables.clean_up(spark, table, {0}, dry_run=False) == [1] and tables.versions(spark, table) == [0, 2]
    assert snapshots.verify(spark, table, 0) and snapshots.verify(spark, table, 2)
    ids = [r["id"] for n in range(3) for r in tables.shard(spark, table, 2, 7, 1, 3, n).collect()]
    assert sorted(ids) == [f"r{i}" for i in range(5)]


def test_bad_input_isnt_imported(spark, tmp_path):
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(SCHEMA)
    good = json.dumps({"id": "a", "language": "zh", "retained": True, "record_json": "{}"})
    for name, text, match in (("bad", good + "\n{oops\n", "not a record"), ("twice", good + "\n" + good + "\n", "twice")):
        (tmp_path / name).write_text(text)
        with pytest.raises(ValueError, match=match):
            tables.import_lines(spark, str(tmp_path / name), schema, str(tmp_path / f"{name}-t"))
        assert tables.versions(spark, str(tmp_path / f"{name}-t")) == []


def test_lines_are_numbered_and_read_like_tables(spark, tmp_path):
    from pyspark.sql.types import StructType

    from tidemill.operators.records import RecordQuery
    from tidemill.sources import jsonl

    schema = StructType().add("id", "string").add("language", "string")
    text = "".join(f'{{"id":"r{i}","language":"{"en" if i % 3 else "de"}"}}\n' if i % 10 else ("\n" if i % 20 else "{broken\n") for i in range(400))
    (tmp_path / "a.jsonl").write_text(text)
    (tmp_path / "b.jsonl").write_text("\n" + text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        numbered = jsonl.numbered_lines(spark, f"file://{tmp_path}/a.jsonl").collect()
        assert len({r.line_no for r in numbered}) == 400 and all(r.value == text.split("\n")[r.line_no - 1] for r in numbered)
        good, bad = jsonl.read_lines(spark, f"file://{tmp_path}/*.jsonl", schema)
        assert good.count() == 720
        found = sorted((r.file[-7:], r.line_no) for r in bad.collect())
        assert found == sorted([("a.jsonl", i + 1) for i in range(0, 400, 20)] + [("b.jsonl", i + 2) for i in range(0, 400, 20)])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    table = str(tmp_path / "table")
    jsonl.read_lines(spark, f"file://{tmp_path}/a.jsonl", schema)[0].drop("file").write.parquet(table)
    query = RecordQuery(language="de")
    left, right = (sorted(map(tuple, jsonl.read_records(spark, s, schema, query).collect())) for s in (f"file://{tmp_path}/a.jsonl", table))
    assert left == right and len(left) == 120
    made = jsonl.export_verified(spark.read.parquet(table), str(tmp_path / "out"))
    assert made["count"] == 360 and len(made["digest"]) == 64


def test_written_layers(spark, tmp_path):
    parent = spark.createDataFrame([("a", '{"language":"en"}', True), ("b", "{}", True), ("c", "{}", False)], "id string, record_json string, retained boolean")
    step = layers.Step("s", ("metadata", "$membership"))
    layer = spark.createDataFrame([("b", {}, "delete"), ("a", {"metadata.x": "1"}, "keep")], "id string, changes map<string,string>, status string")
    counts = layers.written_layer(layer, parent, step, 3, str(tmp_path / "l")).first()
    assert (counts.input_count, counts.output_count, counts.parent_record_count, counts.result_record_count) == (2, 1, 2, 1)
    for wrong in ([("c", {}, "keep")], [("a", {}, "other")], [("a", {}, "keep"), ("a", {}, "keep")], [(None, {}, "keep")], [("a", {"target": "1"}, "keep")], []):
        with pytest.raises(ValueError):
            layers.written_layer(spark.createDataFrame(wrong, layer.schema), parent, step, 3, str(tmp_path / "w"))
    assert layers.check_step(layers.Step("s", ("target.x", "metadata", "labels.", "audio")), []) == ["target.x: not a field that layers write", "labels.: not a field that layers write", "audio: not a field that layers write"]
    assert layers.check_step(layers.Step("s", ("metadata.x.y",), ("metadata.x",)), [layers.Step("old", ("metadata",))]) == []
    assert layers.check_step(layers.Step("s", ("metadata",), ("metadata.x",)), [layers.Step("old", ("metadata.x",))]) != []
