"""Knowledge-graph analytics over ``nodes(id, type, properties)`` and ``relationships(source, target, type, properties)``.

Graphs for the iterative operators are ``vertices(id)`` and ``edges(src, dst)``. Loops run on the driver
over joins only; each round is written to the shared folder, so lineage stays short and a lost
executor costs one round.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.operators.ordinal import with_ordinal
from gleaner.session import materialise

#: A vertex has its neighbours in at most so many lists.
PIECES = 8
#: Below so many vertices the votes for a label and the label fit in one whole number.
PACKED_BITS = 31


def graph_stats(nodes: DataFrame, relationships: DataFrame) -> DataFrame:
    """Node and relationship counts and their ratio (infinite without relationships)."""
    n_edges = relationships.agg(F.count(F.lit(1))).scalar()
    counts = nodes.agg(F.count(F.lit(1)).alias("num_nodes")).withColumn("num_relationships", n_edges)
    ratio = F.when(F.col("num_relationships") == 0, F.lit(float("inf"))).otherwise(
        F.col("num_nodes") / F.nullif("num_relationships", F.lit(0))
    )
    return counts.withColumn("node_to_rel_ratio", ratio)


def type_counts(rows: DataFrame, column: str = "type") -> DataFrame:
    """Rows per type, most common first; rows without a type are ignored."""
    counted = rows.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("type")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return counted.orderBy(F.desc("n"), F.asc("type"))


def property_type_counts(nodes: DataFrame, key: str = "type") -> DataFrame:
    """Counts of the values of one property of the nodes."""
    return type_counts(nodes.select(F.try_element_at("properties", F.lit(key)).alias("value")), "value")


def property_coverage(nodes: DataFrame) -> DataFrame:
    """Nodes that have each property, count and percentage, most common first."""
    total = nodes.agg(F.count(F.lit(1))).scalar()
    counted = (
        nodes.select(F.explode(F.map_keys("properties")).alias("property"))
        .groupBy("property")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.withColumn("pct", F.col("n") * 100.0 / total).orderBy(F.desc("n"), F.asc("property"))


def entity_counts(nodes: DataFrame, top: int = 10) -> DataFrame:
    """Most frequent entities. ``entities`` is JSON: a list, or an object of lists by entity type."""
    lists = F.from_json("entities", "array<string>")
    objects = F.from_json("entities", "map<string,array<string>>")
    is_list = F.startswith(F.ltrim("entities"), F.lit("["))
    plain = nodes.filter(is_list).select(F.lit(None).cast("string").alias("entity_type"), F.explode(lists).alias("entity"))
    typed = (
        nodes.filter(~is_list)
        .select(F.explode(objects).alias("entity_type", "entities"))
        .select("entity_type", F.explode("entities").alias("entity"))
    )
    counted = plain.unionByName(typed).groupBy("entity_type", "entity").agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), F.asc("entity"), F.asc_nulls_first("entity_type")).limit(top)


def structure(nodes: DataFrame) -> DataFrame:
    """``(level, key, n)``: the fields, property keys and ``summary`` keys of all nodes and how many nodes have them.

    A null field or property counts as absent. What is shuffled are the counts of each task.
    """
    level = lambda name, keys: F.transform(keys, lambda k: F.struct(F.lit(name).alias("level"), k.alias("key")))
    fields = F.filter(F.array(*[F.when(F.col(name).isNotNull(), F.lit(name)) for name in nodes.columns]), lambda k: k.isNotNull())
    held = F.map_keys(F.map_filter("properties", lambda _, v: v.isNotNull()))
    inner = F.json_object_keys(F.try_element_at("properties", F.lit("summary")))
    none = F.array().cast("array<string>")
    keys = F.concat(level("node", fields), level("properties", F.coalesce(held, none)), level("summary", F.coalesce(inner, none)))
    return nodes.select(F.inline(keys)).groupBy("level", "key").agg(F.count(F.lit(1)).alias("n"))


def embedding_paths(rows: DataFrame, word: str = "embedding") -> DataFrame:
    """Paths of the property keys that contain ``word``, with their row counts.

    Nested JSON objects are entered to any depth, lists by their first item only. One pass per level, until a level
    is empty.
    """
    level = rows.select(F.explode("properties").alias("key", "value")).withColumn("path", F.concat(F.lit("properties."), "key"))
    found = []
    while True:
        named = level.filter(F.contains(F.lower("key"), F.lit(word)))
        found.append(named.groupBy("path").agg(F.count(F.lit(1)).alias("n")))
        opened = F.ltrim("value")
        in_list = F.startswith(opened, F.lit("["))
        item = F.when(in_list, F.get_json_object("value", "$[0]")).otherwise(F.col("value"))
        nested = level.filter(F.startswith(opened, F.lit("{")) | in_list).select(
            F.when(in_list, F.concat("path", F.lit("[0]"))).otherwise(F.col("path")).alias("parent"), item.alias("item")
        )
        objects = nested.filter(F.startswith(F.ltrim("item"), F.lit("{")))
        level = materialise(
            objects.select("parent", F.explode(F.from_json("item", "map<string,string>")).alias("key", "value")).select(
                "key", "value", F.concat_ws(".", "parent", "key").alias("path")
            ),
            "level",
        )
        if level.isEmpty():
            break
    return reduce(DataFrame.unionByName, found).groupBy("path").agg(F.sum("n").alias("n"))


def simple_edges(relationships: DataFrame, ordinal: str, limit: int | None = None) -> DataFrame:
    """Undirected simple edges ``(src, dst, attributes)``.

    Parallel edges merge key by key: the relationship with the highest ``ordinal`` that has the key
    wins. With ``limit`` values are cut to so many characters; the type (``unknown`` if missing) is kept whole.
    """
    named = F.col("properties") if limit is None else F.map_from_arrays(
        F.map_keys("properties"), F.transform(F.map_values("properties"), lambda v: F.substring(v, 1, limit))
    )
    with_type = F.map_concat(
        F.map_filter(named, lambda key, _: key != "type"),
        F.create_map(F.lit("type"), F.coalesce("type", F.lit("unknown"))),
    )
    rows = relationships.select(
        F.least("source", "target").alias("src"),
        F.greatest("source", "target").alias("dst"),
        F.col(ordinal).alias("nth"),
        F.explode(with_type).alias("key", "value"),
    )
    merged = rows.groupBy("src", "dst", "key").agg(F.max_by("value", "nth").alias("value"))
    return merged.groupBy("src", "dst").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value")))).alias("attributes")
    )


def vertices_of(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Node ids, including endpoints that have no node row."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id"))
    return nodes.select("id").unionByName(ends).distinct()


def both_ways(edges: DataFrame) -> DataFrame:
    """Each edge in both directions, from one scan: ``(src, dst)``."""
    ends = F.array(
        F.struct(F.col("src").alias("src"), F.col("dst").alias("dst")),
        F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")),
    )
    return edges.select(F.inline(ends))


def degrees(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Degree per vertex, 0 for isolated ones; a self-loop counts twice."""
    counted = edges.select(F.explode(F.array("src", "dst")).alias("id")).groupBy("id").agg(
        F.count(F.lit(1)).alias("degree")
    )
    return vertices.join(counted, "id", "left").withColumn("degree", F.coalesce("degree", F.lit(0)))


def degree_summary(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    return degrees(vertices, edges).agg(
        F.count(F.lit(1)).alias("n_vertices"), F.avg("degree").alias("avg_degree"), F.max("degree").alias("max_degree")
    )


def top_degrees(vertices: DataFrame, edges: DataFrame, top: int = 5, name: Callable[[Column], Column] = lambda id_: id_) -> DataFrame:
    """The ``top`` vertices by degree, ties by the ``name`` of the id."""
    return degrees(vertices, edges).orderBy(F.desc("degree"), name(F.col("id")).asc()).limit(top)


def connected_components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """``(id, component)`` with the smallest vertex id of the component; an edge counts if both its ends are vertices.

    Each level every vertex goes over to one of its neighbours or stays, whichever a hash of the level puts first, and the
    edges are drawn between what is left. About half of a chain and all but one vertex of a star are gone after a level,
    so the levels together move little more than the first one. The choices are then followed back.
    """
    vertices = materialise(vertices.filter("id IS NOT NULL"), "vertices")
    inner = induced(edges.filter("src <> dst"), vertices)
    links = materialise(inner.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct(), "links")
    levels: list[DataFrame] = []
    while not links.isEmpty():
        first = lambda id_: F.xxhash64(F.lit(len(levels)), F.col(id_))  # noqa: B023, E731
        near = both_ways(links).groupBy("src").agg(F.min_by("dst", first("dst")).alias("near"))
        # Any neighbour will do, so equal hashes do no harm.
        chosen = F.when(first("src") <= first("near"), F.col("src")).otherwise(F.col("near"))
        levels.append(materialise(near.select(F.col("src").alias("id"), chosen.alias("next")), "chosen"))
        ends = links.join(levels[-1].select(F.col("id").alias("src"), F.col("next").alias("a")), "src").join(
            levels[-1].select(F.col("id").alias("dst"), F.col("next").alias("b")), "dst"
        )
        drawn = ends.filter("a <> b").select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst"))
        links = materialise(drawn.distinct(), "links")
    if not levels:
        return vertices.select("id", F.col("id").alias("component"))
    labels = levels.pop()
    while levels:
        after = labels.select(F.col("id").alias("next"), F.col("next").alias("last"))
        labels = materialise(levels.pop().join(after, "next", "left").select("id", F.coalesce("last", "next").alias("next")), "labels")
    smallest = materialise(labels.groupBy("next").agg(F.min("id").alias("component")), "smallest")
    known = labels.join(smallest, "next").select("id", "component")
    return materialise(vertices.join(known, "id", "left").select("id", F.coalesce("component", "id").alias("component")), "components")


def component_summary(components: DataFrame) -> DataFrame:
    sizes = components.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    return sizes.agg(F.count(F.lit(1)).alias("n_components"), F.max("size").alias("largest"))


def betweenness(vertices: DataFrame, edges: DataFrame, pivots: DataFrame) -> DataFrame:
    """Betweenness from the shortest paths that start in ``pivots(id)``, scaled up to all vertices.

    A breadth-first wave per pivot counts shortest paths outward; the dependencies are then summed back
    from the farthest level. One join per level, until a wave is empty; a wave of an undirected graph can
    only meet the two before it, so only these are compared. State is one row per (pivot, vertex); the neighbours of a
    vertex move as lists.
    """
    links = materialise(_lists(both_ways(edges).filter("src <> dst")), "links")
    wave = materialise(
        pivots.select(F.col("id").alias("pivot"), "id", F.lit(0).alias("level"), F.lit(1.0).alias("paths")), "wave"
    )
    levels = [wave]
    for level in count(1):
        seen = reduce(DataFrame.unionByName, [w.select("pivot", "id") for w in levels[-2:]])
        reached = (
            wave.select("pivot", F.col("id").alias("src"), "paths")
            .join(links, "src")
            .select("pivot", F.explode("dsts").alias("id"), "paths")
            .groupBy("pivot", "id")
            .agg(F.sum("paths").alias("paths"))
            .join(seen, ["pivot", "id"], "left_anti")
        )
        wave = materialise(reached.select("pivot", "id", F.lit(level).alias("level"), "paths"), "wave")
        if wave.isEmpty():
            break
        levels.append(wave)
    share = levels[-1].select("pivot", "id", "paths", F.lit(0.0).alias("dependency"))
    done = []
    for upper in reversed(levels[:-1]):
        done.append(share)
        given = (
            share.select("pivot", F.col("id").alias("src"), ((1 + F.col("dependency")) / F.col("paths")).alias("part"))
            .join(links, "src")
            .select("pivot", F.explode("dsts").alias("id"), "part")
            .groupBy("pivot", "id")
            .agg(F.sum("part").alias("part"))
        )
        share = materialise(
            upper.join(given, ["pivot", "id"], "left").select(
                "pivot", "id", "paths", F.coalesce(F.col("paths") * F.col("part"), F.lit(0.0)).alias("dependency")
            ),
            "dependency",
        )
    total = share
    for part in done:
        total = total.unionByName(part)
    n = vertices.agg(F.count(F.lit(1)).cast("double")).scalar()
    k = pivots.agg(F.count(F.lit(1)).cast("double")).scalar()
    # Ordered pairs of an undirected graph: divided by (n-1)(n-2), scaled from k pivots to n sources.
    scale = n / k / F.nullif((n - 1) * (n - 2), F.lit(0.0))
    summed = total.filter("pivot <> id").groupBy("id").agg(F.sum("dependency").alias("dependency"))
    return vertices.join(summed, "id", "left").select(
        "id", F.coalesce(F.col("dependency") * scale, F.lit(0.0)).alias("betweenness")
    )


def induced(edges: DataFrame, kept: DataFrame) -> DataFrame:
    """Edges with both ends in ``kept(id)``."""
    return edges.join(kept.select(F.col("id").alias("src")), "src", "left_semi").join(
        kept.select(F.col("id").alias("dst")), "dst", "left_semi"
    )


def largest_component(
    vertices: DataFrame, edges: DataFrame, name: Callable[[Column], Column] = lambda id_: id_
) -> tuple[DataFrame, DataFrame]:
    """The component with the most vertices (on ties the one with the smallest ``name`` of an id) and its edges."""
    components = connected_components(vertices, edges)
    sizes = components.groupBy("component").agg(F.count(F.lit(1)).alias("size"), F.min(name(F.col("id"))).alias("name"))
    largest = materialise(sizes.orderBy(F.desc("size"), F.asc("name")).limit(1), "largest")
    members = components.join(largest, "component", "left_semi").select("id")
    return members, induced(edges, members)


def top_subgraph(
    vertices: DataFrame, edges: DataFrame, top: int, name: Callable[[Column], Column] = lambda id_: id_
) -> tuple[DataFrame, DataFrame]:
    """The ``top`` vertices by degree and the edges among them."""
    chosen = materialise(top_degrees(vertices, edges, top, name).select("id"), "chosen")
    return chosen, induced(edges, chosen)


def view_subgraph(
    vertices: DataFrame, edges: DataFrame, top: int, name: Callable[[Column], Column] = lambda id_: id_
) -> tuple[DataFrame, DataFrame]:
    """A view of a graph of any size: the largest component's ``top`` vertices by degree, with their edges."""
    return top_subgraph(*largest_component(vertices, edges, name), top, name)


def filter_types(
    nodes: DataFrame, relationships: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Nodes of the wanted types and the relationships between them."""
    keep: Column = F.lit(True)
    if include:
        keep = keep & F.col("type").isin(include)
    if exclude:
        keep = keep & ~F.coalesce(F.col("type").isin(exclude), F.lit(False))
    chosen = nodes.filter(keep)
    ids = chosen.select("id")
    kept = relationships.join(ids.withColumnRenamed("id", "source"), "source", "left_semi").join(
        ids.withColumnRenamed("id", "target"), "target", "left_semi"
    )
    return chosen, kept


def neighbourhood(seeds: DataFrame, edges: DataFrame, hops: int) -> DataFrame:
    """Vertices within ``hops`` of each query's seeds: ``(query_id, id, hop)`` at the smallest hop."""
    links = both_ways(edges)
    reached = materialise(seeds.select("query_id", "id").distinct().withColumn("hop", F.lit(0)), "reached")
    wave = reached
    for hop in range(1, hops + 1):
        stepped = (
            wave.select("query_id", F.col("id").alias("src"))
            .join(links, "src")
            .select("query_id", F.col("dst").alias("id"))
            .distinct()
            .join(reached.select("query_id", "id"), ["query_id", "id"], "left_anti")
        )
        wave = materialise(stepped.withColumn("hop", F.lit(hop)), "reached")
        reached = reached.unionByName(wave)
    return reached


def clustering(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Triangles and clustering coefficient per vertex.

    Vertices are numbered by (degree, id) and edges point to the higher number. A hub then has few
    outgoing edges: at most the square root of twice the edge count, which bounds the neighbour lists
    that are intersected along each edge. A list is only sent to ends that have a list themselves, and of it
    only the vertices beyond that end: a triangle is counted where its second corner is.
    """
    simple = materialise(
        edges.filter("src <> dst")
        .select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
        .distinct(),
        "simple",
    )
    ranked = materialise(with_ordinal(degrees(vertices, simple), ["degree", "id"], "n"), "ranked")
    kind = "int" if ranked.count() < 1 << 31 else "bigint"
    number = lambda end, name: ranked.select(F.col("id").alias(end), F.col("n").cast(kind).alias(name))
    ends = simple.join(number("src", "x"), "src").join(number("dst", "y"), "dst")
    directed = materialise(ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")), "directed")
    onward = materialise(directed.groupBy("a").agg(F.collect_list("b").alias("onward")), "onward")
    closed = _tails(directed, onward).join(onward.select(F.col("a").alias("b"), F.col("onward").alias("beyond")), "b").select(
        "a", "b", F.array_intersect("after", "beyond").alias("third")
    )
    shared = F.size("third").cast("bigint")
    corners = F.concat(
        F.array(F.struct(F.col("a").alias("n"), shared.alias("c")), F.struct(F.col("b").alias("n"), shared.alias("c"))),
        F.transform("third", lambda v: F.struct(v.alias("n"), F.lit(1).cast("bigint").alias("c"))),
    )
    per_vertex = closed.select(F.inline(corners)).groupBy("n").agg(F.sum("c").alias("triangles"))
    counted = ranked.join(per_vertex, "n", "left").withColumn("triangles", F.coalesce("triangles", F.lit(0)))
    pairs = F.col("degree") * (F.col("degree") - 1)
    return counted.select(
        "id", "degree", "triangles",
        F.coalesce(2.0 * F.col("triangles") / F.nullif(pairs, F.lit(0)), F.lit(0.0)).alias("coefficient"),
    )


def _tails(directed: DataFrame, onward: DataFrame) -> DataFrame:
    """``(a, b, after)``: for each edge to an end with a list of its own, what comes after that end in the list of ``a``."""
    middle = directed.join(onward.select(F.col("a").alias("b")), "b", "left_semi").groupBy("a").agg(F.collect_list("b").alias("middles"))
    along = onward.join(middle, "a").select("a", F.explode("middles").alias("b"), "onward")
    return along.select("a", "b", F.filter("onward", lambda c: c > F.col("b")).alias("after")).filter(F.size("after") > 0)


def _neighbours(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """``(src, piece, dsts)``: the different neighbours of each vertex, itself among them, in lists. A hub has many lists."""
    return _lists(both_ways(edges).filter("src <> dst").unionByName(vertices.select(F.col("id").alias("src"), F.col("id").alias("dst"))))


def _lists(links: DataFrame) -> DataFrame:
    """``(src, piece, dsts)`` of ``links(src, dst)``, each link once."""
    piece = F.pmod(F.xxhash64("dst"), F.lit(PIECES)).cast("int")
    return links.groupBy("src", piece.alias("piece")).agg(F.collect_set("dst").alias("dsts"))


def communities(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Label propagation until nothing changes: ``(id, community, converged)``.

    Each vertex takes the most frequent label among its neighbours and itself, the smallest on ties. All vertices move
    at once; their own vote keeps most pairs from swapping labels for ever. If a state comes back all the same, the
    first state of that cycle is returned with ``converged`` false. Isolated vertices keep their own label. Labels are
    the vertices' numbers in the order of their ids, and a vertex without an id takes no part.
    """
    known = vertices.filter("id IS NOT NULL").distinct()
    numbers = materialise(with_ordinal(known, ["id"], "community"), "numbers")  # in the order of the ids, so ties go to the same label
    last = numbers.count()
    links = materialise(_neighbours(known, edges), "links")
    # All labels differ at first, so each has one vote: the smallest id around each vertex wins.
    nearest = links.groupBy(F.col("src").alias("id")).agg(F.min(F.array_min("dsts")).alias("first"))
    first = nearest.join(numbers.withColumnRenamed("id", "first"), "first").select("id", "community")
    labels, states = numbers, {}
    while True:
        digest = labels.agg(F.sum(F.xxhash64("id", "community").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("community", "id"))).first()
        if tuple(digest) in states:
            still = tuple(digest) == list(states)[-1]
            named = states[tuple(digest)].join(numbers.withColumnRenamed("id", "name"), "community")
            return named.select("id", F.col("name").alias("community"), F.lit(still).alias("converged"))
        states[tuple(digest)] = labels
        if len(states) == 1:
            labels = materialise(first, "community")
            continue
        said = links.join(labels.withColumnRenamed("id", "src"), "src").select(F.explode("dsts").alias("id"), "community")
        votes = said.groupBy("id", "community").agg(F.count(F.lit(1)).alias("votes"))
        if last < 1 << PACKED_BITS:
            # More votes first, then the smaller label, as one number: its largest is found without a sort.
            best = F.max(F.shiftleft("votes", PACKED_BITS) + (last - F.col("community"))).alias("best")
            label = last - F.col("best").bitwiseAND(F.lit((1 << PACKED_BITS) - 1))
        else:
            best, label = F.min(F.struct(-F.col("votes"), F.col("community"))).alias("best"), F.col("best.community")
        winner = votes.groupBy("id").agg(best).select("id", label.alias("community"))
        labels = materialise(winner, "community")
