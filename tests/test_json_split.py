import json
import random

import pytest
from pyspark.sql import types as T

from gleaner.sources import json_split, readers, writers

ODD = ["}", "{", "]", "[", '"', "\\", '\\"', "}{", 'a}"b', "\n", "é😀", "", "plain", "}" * 40, '","nodes":[{"id":"x"}]']


def graph(seed, n):
    rng = random.Random(seed)
    value = lambda: rng.choice(ODD) + rng.choice(ODD)
    record = lambda i: {"id": f"n{i}", "type": rng.choice(["t", None, "u}"]), "properties": {value(): value() for _ in range(rng.randrange(4))}}
    link = lambda i: {"source": f"n{i}", "target": value(), "type": "r", "properties": {}}
    return {
        "meta": {"a": {"b": [1, {"c": 2}]}, "name": "}]"}, "nested": [[{"x": 1}, {"y": [2]}], [], [[3]]], "strings": ["}", "]{"],
        "nodes": [record(i) for i in range(n)], "none": None, "relationships": [link(i) for i in range(n // 2)], "tail": [[{"z": "}"}]],
    }


def lists(spark, path):
    found = {}
    for row in json_split.record_lists(spark, str(path)).collect():
        found.setdefault(row.list, []).append(json.loads(row.text))
    return {name: sorted(rows, key=json.dumps) for name, rows in found.items()}


def plain(*graphs):
    found = {}
    for g in graphs:
        for name, rows in g.items():
            if isinstance(rows, list):
                found.setdefault(name, []).extend(r for r in rows if isinstance(r, dict))
    return {name: sorted(rows, key=json.dumps) for name, rows in found.items() if rows}


@pytest.fixture
def small_splits(spark):
    def size(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield size
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("size,indent", [(64, None), (251, 1), (1 << 20, None)])
def test_records_are_the_same_however_the_file_is_split(spark, tmp_path, small_splits, size, indent):
    graphs = [graph(1, 12), graph(2, 5)]
    for i, g in enumerate(graphs):
        (tmp_path / f"{i}.json").write_text(json.dumps(g, indent=indent, ensure_ascii=i == 0) + "\n" * i)
    small_splits(size)
    splits = json_split.split_starts(spark.read.option("lineSep", "}").text(str(tmp_path)).selectExpr(
        "value", "_metadata.file_path AS file", "_metadata.file_block_start AS start", "_metadata.file_size AS size"))
    assert splits.count() > 10 or size > 1000
    assert lists(spark, tmp_path) == plain(*graphs)


def test_long_records_span_splits_and_several_objects_follow(spark, tmp_path, small_splits):
    graphs = [{"nodes": [{"id": "a" * 900, "properties": {"k": "}" * 50}}, {"id": "b"}]}, {"nodes": []}, {"nodes": [{"id": "c"}], "x": None}]
    (tmp_path / "g.json").write_text("\n".join(map(json.dumps, graphs)) + " \n ")
    (tmp_path / "blank.json").write_text(" \n")
    (tmp_path / "zero.json").write_text("")
    small_splits(100)
    assert lists(spark, tmp_path) == plain(*graphs)
    nodes, links = readers.read_graph_file(spark, str(tmp_path))
    assert sorted(r.id[:1] for r in nodes.collect()) == ["a", "b", "c"] and links.count() == 0


@pytest.mark.parametrize("text", ['{"nodes": [{"id": "a"}', '{"nodes": [{"id": "a"}]', '{"nodes": []}}', '{"nodes": ["a]}', '[{"id": "a"}]', "{nodes: ["])
def test_broken_files_fail(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(Exception):
        json_split.record_lists(spark, str(tmp_path)).collect()


def test_broken_record_fails(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"nodes": [{"id": "a", oops}]}')
    schema = T.StructType([T.StructField("id", T.StringType())])
    with pytest.raises(Exception):
        json_split.records(json_split.record_lists(spark, str(tmp_path)), "nodes", schema).collect()


@pytest.mark.parametrize("files", [1, 3])
def test_graph_files_come_back(spark, tmp_path, small_splits, files):
    schema = readers.schemas
    nodes = spark.createDataFrame([(f"n{i}", "t" if i % 2 else None, {"k": ODD[i % len(ODD)]}) for i in range(40)], schema.NODE)
    for n, links in ((0, nodes.limit(0)), (1, nodes)):
        links = links.selectExpr("id AS source", "id AS target", "'r' AS type", "properties")
        writers.save_graph_file(nodes, links, str(tmp_path / f"g{n}"), files)
        assert len(list((tmp_path / f"g{n}").glob("*.txt"))) <= files
        small_splits(300)
        got, found = readers.read_graph_file(spark, str(tmp_path / f"g{n}"))
        assert sorted(map(str, got.collect())) == sorted(map(str, nodes.collect())) and found.count() == links.count()


def test_a_graph_file_is_written_without_a_sort(spark, tmp_path, monkeypatch):
    """A task that sorts its file's rows holds them; the rows are read in the order of the lists instead."""
    from pyspark.sql import DataFrame

    sorts = []
    plain = DataFrame.sortWithinPartitions
    monkeypatch.setattr(DataFrame, "sortWithinPartitions", lambda self, *a, **k: sorts.append(a) or plain(self, *a, **k))
    nodes = spark.range(300).selectExpr("cast(id as string) id", "'t' type", "map('k', 'v') properties").repartition(5)
    links = spark.range(900).selectExpr("cast(id as string) source", "'x' target", "'r' type", "map('k', 'v') properties").repartition(7)
    writers.save_graph_file(nodes, links, str(tmp_path / "g"), 3)
    assert not sorts
    files = [json.loads(path.read_text()) for path in (tmp_path / "g").glob("part-*")]
    assert len(files) == 3 and all(list(f) == ["nodes", "relationships"] for f in files)
    assert sorted(int(n["id"]) for f in files for n in f["nodes"]) == list(range(300))
    assert sorted(int(n["source"]) for f in files for n in f["relationships"]) == list(range(900))
