"""Graph operators against brute force, with a hub that holds a third of the edges."""

import itertools
import random
from collections import Counter, defaultdict, deque

import pytest
from pyspark.sql import functions as F

from gleaner.operators import graph, testset
from gleaner.plans import graphs
from gleaner.plans.registry import Tables


@pytest.fixture(scope="module")
def data():
    rng = random.Random(5)
    ids = [f"v{i:02d}" for i in range(45)]
    pairs = {tuple(sorted(rng.sample(ids[:30], 2))) for _ in range(35)}
    pairs |= {tuple(sorted((ids[0], v))) for v in ids[1:20]}  # hub
    pairs |= {tuple(sorted(p)) for p in zip(ids[30:40], ids[31:41])}  # a path of its own
    return ids, sorted(pairs)


@pytest.fixture(scope="module")
def frames(spark, data):
    ids, pairs = data
    return spark.createDataFrame([(i,) for i in ids], "id string"), spark.createDataFrame(pairs, "src string, dst string")


def neighbours(pairs):
    near = defaultdict(set)
    for a, b in pairs:
        near[a].add(b)
        near[b].add(a)
    return near


def test_components(data, frames):
    ids, pairs = data
    near, expected = neighbours(pairs), {}
    for start in ids:
        if start in expected:
            continue
        queue, members = deque([start]), {start}
        while queue:
            for v in near[queue.popleft()] - members:
                members.add(v)
                queue.append(v)
        expected.update({v: min(members) for v in members})
    found = {r.id: r.component for r in graph.connected_components(*frames).collect()}
    assert found == expected


def test_components_do_not_depend_on_edge_direction(frames):
    vertices, edges = frames
    flipped = edges.selectExpr("dst AS src", "src AS dst")
    one = sorted(graph.connected_components(vertices, edges).collect())
    assert one == sorted(graph.connected_components(vertices, flipped).collect())


def brute_betweenness(ids, pairs, pivots):
    near, total = neighbours(pairs), dict.fromkeys(ids, 0.0)
    for s in pivots:
        dist, paths, order = {s: 0}, Counter({s: 1}), [s]
        for v in order:
            for w in near[v]:
                if w not in dist:
                    dist[w] = dist[v] + 1
                    order.append(w)
                if dist[w] == dist[v] + 1:
                    paths[w] += paths[v]
        dep = Counter()
        for w in reversed(order):
            for v in near[w]:
                if dist.get(v) == dist[w] - 1:
                    dep[v] += paths[v] / paths[w] * (1 + dep[w])
            if w != s:
                total[w] += dep[w]
    n = len(ids)
    return {v: x * n / len(pivots) / ((n - 1) * (n - 2)) for v, x in total.items()}


def test_betweenness(spark, data, frames):
    ids, pairs = data
    pivots = [ids[3], ids[0], ids[33], ids[44]]
    found = graph.betweenness(*frames, spark.createDataFrame([(p,) for p in pivots], "id string"))
    expected = brute_betweenness(ids, pairs, pivots)
    assert {r.id: r.betweenness for r in found.collect()} == pytest.approx(expected)


def test_clustering(data, frames):
    ids, pairs = data
    near = neighbours(pairs)
    for row in graph.clustering(*frames).collect():
        closed = sum(b in near[a] for a, b in itertools.combinations(near[row.id], 2))
        size = len(near[row.id])
        assert (row.degree, row.triangles) == (size, closed)
        assert row.coefficient == pytest.approx(2 * closed / (size * (size - 1)) if size > 1 else 0.0)


def test_lists_are_sent_to_ends_with_a_list_and_only_what_comes_after(spark):
    pairs = [(0, 1), (0, 2), (0, 3), (0, 9), (1, 2), (1, 9), (2, 9), (3, 9)]
    directed = spark.createDataFrame(pairs, "a int, b int")
    onward = directed.groupBy("a").agg(F.collect_list("b").alias("onward"))
    sent = {(r.a, r.b): sorted(r.after) for r in graph._tails(directed, onward).collect()}
    assert sent == {(0, 1): [2, 3, 9], (0, 2): [3, 9], (0, 3): [9], (1, 2): [9]}


def test_trade_in_codes_is_the_same_graph(spark, tmp_path):
    lines = [(1, 10, 1), (2, 9, 2), (3, None, 1), (4, None, None), (9, 7, 7), (1, 10, 1)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(1, 1), (2, 2), (3, None), (4, None)], "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    names, vertices, edges = graphs.trade(Tables(spark, str(tmp_path)))
    of = {r.n: r.id for r in names.collect()} | {None: None}
    coded, pairs = graphs.coded_trade(Tables(spark, str(tmp_path)))
    named = [r.id for r in coded.select(graphs._name(F.col("id")).alias("id")).collect()]
    assert sorted(named, key=str) == sorted((of[r.id] for r in vertices.collect()), key=str)
    ends = {frozenset(r) for r in pairs.select(graphs._name(F.col("src")), graphs._name(F.col("dst"))).collect()}
    assert ends == {frozenset((of[r.src], of[r.dst])) for r in edges.collect()}


def test_communities(data, frames):
    ids, pairs = data
    near, labels = neighbours(pairs), {v: v for v in ids}
    states = []
    while labels not in states:
        states.append(labels)
        votes = {v: Counter(labels[w] for w in [*near[v], v]) for v in ids}
        labels = {v: min(votes[v], key=lambda c: (-votes[v][c], c)) for v in ids}
    rows = graph.communities(*frames).collect()
    assert {r.id: r.community for r in rows} == labels
    assert {r.converged for r in rows} == {labels == states[-1]}


def test_communities_move_numbers_as_labels(spark, frames, monkeypatch):
    stored = _stored(monkeypatch)
    labels = {(r.id, r.community) for r in graph.communities(*frames).collect()}
    rounds = [frame for name, frame in stored if name == "community"]
    assert rounds and all(dict(frame.dtypes)["community"] == "bigint" for frame in rounds)
    monkeypatch.setattr(graph, "PACKED_BITS", 0)  # the votes and the label of a larger graph
    assert {(r.id, r.community) for r in graph.communities(*frames).collect()} == labels


def test_communities_of_a_cycle_of_states(spark):
    """A double star swaps its labels for ever: the first state of the cycle comes back, flagged."""
    pairs = [(a, b) for a in ("a", "b") for b in ("x", "y", "z")]
    edges = spark.createDataFrame(pairs, "src string, dst string")
    vertices = spark.createDataFrame([(v,) for v in "abxyz"], "id string")
    assert len({r.converged for r in graph.communities(vertices, edges).collect()}) == 1


def test_long_paths_are_followed_to_the_end(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(12)], "src long, dst long")
    vertices = spark.range(13).toDF("id")
    found = {r.id: r.betweenness for r in graph.betweenness(vertices, edges, vertices).collect()}
    assert found == pytest.approx({i: 2 * i * (12 - i) / (12 * 11) for i in range(13)})


def test_embedding_paths_at_any_depth(spark):
    text = '{"an_embedding":1}'
    for _ in range(25):
        text = '{"k":' + text + "}"
    rows = spark.createDataFrame([({"top": text},)], "properties map<string,string>")
    assert [r.path.count(".") for r in graph.embedding_paths(rows).collect()] == [27]


def test_self_loop_counts_twice_and_endpoints_are_implicit(spark):
    nodes = spark.createDataFrame([("a",), ("lonely",)], "id string")
    edges = spark.createDataFrame([("a", "a"), ("a", "b")], "src string, dst string")
    vertices = graph.vertices_of(nodes, edges)
    assert {r.id: r.degree for r in graph.degrees(vertices, edges).collect()} == {"a": 3, "b": 1, "lonely": 0}


def test_parallel_edges_merge_key_by_key(spark):
    rows = [("a", "b", "t", 1, {"x": "1", "y": "old"}), ("b", "a", None, 2, {"y": "n" * 80})]
    rels = spark.createDataFrame(rows, "source string, target string, type string, ordinal int, properties map<string,string>")
    edge = graph.simple_edges(rels, "ordinal").first()
    assert (edge.src, edge.dst) == ("a", "b")
    assert edge.attributes == {"type": "unknown", "x": "1", "y": "n" * 80}
    cut = graph.simple_edges(rels, "ordinal", limit=50).first()
    assert cut.attributes["y"] == "n" * 50


def test_view_is_the_largest_component_by_degree(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (2, 4), (8, 9)], "src long, dst long")
    vertices = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 8, 9, 10)], "id long")
    members, inside = graph.largest_component(vertices, edges)
    assert sorted(r.id for r in members.collect()) == [1, 2, 3, 4] and inside.count() == 3
    chosen, kept = graph.view_subgraph(vertices, edges, top=2)
    assert sorted(r.id for r in chosen.collect()) == [1, 2] and kept.count() == 1
    assert graph.view_subgraph(vertices, edges, top=50)[1].count() == 3


def test_neighbourhood_keeps_the_smallest_hop(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("c", "d")], "src string, dst string")
    seeds = spark.createDataFrame([(1, "a")], "query_id long, id string")
    found = {r.id: r.hop for r in graph.neighbourhood(seeds, edges, 2).collect()}
    assert found == {"a": 0, "b": 1, "c": 1, "d": 2}


def test_copies_give_a_star(spark):
    rows = [(i, [1.0, 0.0]) for i in range(30)] + [(50, [0.8, 0.6])]
    edges = testset.similarity_edges(spark.createDataFrame(rows, "doc_id long, vector array<double>"), 2, 0.5, 2).collect()
    assert sum(e.type == "same" for e in edges) == 29
    assert [(e.source, e.target, e.score) for e in edges if e.type == "similar"] == [(0, 50, 0.8)]


def test_quotas_add_up():
    assert testset.quotas(10) == {"single_hop": 5, "multi_hop_abstract": 3, "multi_hop_specific": 2}
    for size in range(25):
        assert sum(testset.quotas(size, {"a": 0.6, "b": 0.3, "c": 0.1}).values()) == size


def test_questions_keep_inner_periods(spark):
    rows = spark.createDataFrame([("d", "1. What is v1.5?\n\n 2. Why?")], "doc_id string, text string")
    assert [r.question for r in testset.parse_questions(rows).orderBy("question_no").collect()] == ["What is v1.5?", "Why?"]


def test_structure_counts_all_nodes(spark):
    rows = [("a", "x", {"name": "1", "summary": '{"s":1,"t":2}'}), ("b", None, {"name": None, "other": "2"}), ("c", "x", None), ("d", "y", {"summary": "no json"})]
    nodes = spark.createDataFrame(rows, "id string, type string, properties map<string,string>")
    found = {(r.level, r.key): r.n for r in graph.structure(nodes).collect()}
    assert found == {
        ("node", "id"): 4, ("node", "type"): 3, ("node", "properties"): 3, ("properties", "name"): 1, ("properties", "summary"): 2,
        ("properties", "other"): 1, ("summary", "s"): 1, ("summary", "t"): 1,
    }
    assert graph.structure(nodes.limit(0)).count() == 0


def test_neighbours_move_as_lists_and_a_hub_is_cut(spark):
    edges = spark.createDataFrame([(0, i) for i in range(1, 900)] + [(5, 6), (6, 5), (7, 7)], "src long, dst long")
    vertices = spark.range(901)
    rows = graph._neighbours(vertices, edges).collect()
    assert len([r for r in rows if r.src == 0]) == graph.PIECES
    found = sorted((r.src, d) for r in rows for d in r.dsts)
    want = {(i, i) for i in range(901)} | {(0, i) for i in range(1, 900)} | {(i, 0) for i in range(1, 900)} | {(5, 6), (6, 5)}
    assert found == sorted(want)


def test_trade_is_numbered_in_the_order_of_ids(spark, tmp_path):
    from gleaner.plans.graphs import communities, trade
    from gleaner.plans.registry import Tables

    lines = [(1, 10, 1), (2, 9, 2), (3, None, 1), (4, None, None), (9, 7, 7)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(1, 1), (2, 2), (3, None), (4, None)], "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    names, vertices, edges = trade(Tables(spark, str(tmp_path)))
    known = [r.id for r in names.orderBy("n").collect()]
    assert known == ["customer:1", "customer:2", "part:10", "part:9", "supplier:1", "supplier:2"]
    assert dict(names.dtypes)["n"] == "bigint" and sorted(r.id for r in vertices.collect() if r.id is not None) == list(range(6))
    assert [r.id for r in vertices.collect()].count(None) == 1
    assert {(r.src, r.dst) for r in edges.collect()} == {(2, 4), (0, 4), (0, 2), (3, 5), (1, 5), (1, 3), (4, 4), (None, None)}
    found = {r.id: r.community for r in communities(Tables(spark, str(tmp_path))).collect()}
    assert found == {v: "customer:1" if v in ("customer:1", "part:10", "supplier:1") else "customer:2" for v in known}


def _stored(monkeypatch):
    """What the graph operators store from here on, by name."""
    seen, real = [], graph.materialise

    def spy(df, name):
        seen.append((name, real(df, name)))
        return seen[-1][1]

    monkeypatch.setattr(graph, "materialise", spy)
    return seen


def test_components_of_a_chain_store_a_few_times_its_length(spark, monkeypatch):
    n = 512
    seen = _stored(monkeypatch)
    vertices = spark.createDataFrame([(i,) for i in range(n)], "id long")
    chain = spark.createDataFrame([(i, i + 1) for i in range(n - 1)], "src long, dst long")
    assert {tuple(r) for r in graph.connected_components(vertices, chain).collect()} == {(i, 0) for i in range(n)}
    assert sum(stored.count() for _, stored in seen) < 10 * n


def test_repeated_vertices_stay_as_they_are_and_others_link_nothing(spark):
    vertices = spark.createDataFrame([(1,), (1,), (2,), (3,), (5,), (None,)], "id long")
    edges = spark.createDataFrame([(2, 1), (1, 2), (3, 4), (4, 5), (5, 5), (None, 3)], "src long, dst long")
    assert sorted(tuple(r) for r in graph.connected_components(vertices, edges).collect()) == [(1, 1), (1, 1), (2, 1), (3, 3), (5, 5)]


def test_betweenness_moves_neighbours_as_lists(spark, frames, monkeypatch):
    seen = _stored(monkeypatch)
    vertices, edges = frames
    graph.betweenness(vertices, edges, vertices.orderBy("id").limit(2))
    assert [stored.columns for name, stored in seen if name == "links"] == [["src", "piece", "dsts"]]


def test_vertex_numbers_stand_for_the_ids_of_the_graph(spark, tmp_path):
    tables = {
        "region": ([(0, "r")], "r_regionkey int, r_name string"), "nation": ([(7, "n", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(1, "c", "m", 7), (2, "c", "m", None)], "c_custkey long, c_name string, c_mktsegment string, c_nationkey int"),
        "supplier": ([(12, "s", 7)], "s_suppkey long, s_name string, s_nationkey int"),
        "part": ([(3, "p", 1, "t", "b")], "p_partkey long, p_name string, p_size int, p_type string, p_brand string"),
        "lineitem": ([(1, i, p, s, "A", "F") for i, (p, s) in enumerate([(3, 12), (3, 12), (9, 12), (None, 12), (None, None)])],
                     "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_returnflag string, l_linestatus string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    t = Tables(spark, str(tmp_path))
    (numbers, pairs), (ids, edges) = graphs.coded(t), graphs.simple(t)
    assert dict(numbers.dtypes + pairs.dtypes) == {"id": "bigint", "src": "bigint", "dst": "bigint"}
    assert Counter(r[0] for r in numbers.select(graphs._name(F.col("id"))).collect()) == Counter(r[0] for r in ids.collect())
    ends = lambda rows: Counter(frozenset(r) for r in rows.collect())
    assert ends(pairs.select(graphs._name(F.col("src")).alias("a"), graphs._name(F.col("dst")).alias("b"))) == ends(edges)


def test_equal_components_are_told_apart_by_name(spark):
    vertices = spark.createDataFrame([(i,) for i in (2, 3, 10, 11)], "id long")
    edges = spark.createDataFrame([(2, 3), (10, 11)], "src long, dst long")
    members, _ = graph.largest_component(vertices, edges, lambda id_: id_.cast("string"))
    assert sorted(r.id for r in members.collect()) == [10, 11]
