"""Mixing sources to target weights: hierarchical budgets over a tree and token prefixes of seeded epochs.

The tree is domain - language - source. A total budget of tokens runs down it by weights. What a node cannot use (its
supply is the tokens of its documents times the allowed epochs) goes to its siblings in proportion to their weights
first; only what a whole family cannot use goes to the family's own siblings. Each leaf then takes documents in a
seeded order: the order of each epoch is a hash of seed, epoch and document, whole epochs are taken first, and of the
last one the documents up to and including the one in which the budget is reached.

The budgets are worked out from one row per leaf (the combination of three labels), which is collected; documents are
never grouped. Inside a leaf, however large, the place of a document in an epoch follows from token sums of equal
ranges of the hash: the ranges before the one where the budget is reached are taken whole, and only the documents of
that one range are put in order. The number of ranges grows with the table and changes no result.

Defined results: null labels form a branch of their own; null and empty texts have no tokens and are never taken;
repeated rows are documents of their own, ordered alike and taken together; missing weights are 1, negative ones are
refused; a budget above the whole supply takes all epochs of all; an empty table gives no row; other columns stay.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from gleaner.llm.common import WORD_BREAK
from gleaner.session import materialise

LEVELS = ("domain", "lang", "source")
#: Documents per range of the order, on average.
RANGE_ROWS = 4096
NONE = "\0"


@dataclass
class Node:
    """A node of the weight tree with its supply and its budget in tokens."""

    path: tuple[str, ...]
    weight: float = 1.0
    supply: int = 0
    budget: int = 0
    children: list[Node] = field(default_factory=list)


def word_tokens(text: Column) -> Column:
    """The number of words of a text."""
    blank = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(blank == "", 0).otherwise(F.regexp_count(blank, F.lit(WORD_BREAK)) + 1).cast("long")


def leaf_key(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(NONE))


def build_tree(leaves: dict[tuple[str, ...], int], weights: dict[tuple[str, ...], float]) -> Node:
    """The tree over leaf supplies; ``weights`` maps paths (tuples of labels from the top) to relative weights."""
    if any(w < 0 for w in weights.values()):
        raise ValueError("weights must not be negative")
    root = Node(())
    for path, supply in sorted(leaves.items()):
        node = root
        node.supply += supply
        for depth in range(1, len(path) + 1):
            child = next((c for c in node.children if c.path == path[:depth]), None)
            if child is None:
                child = Node(path[:depth], weights.get(path[:depth], 1.0))
                node.children.append(child)
            child.supply += supply
            node = child
    return root


def spread(node: Node, budget: int) -> None:
    """Set the budgets of a node and of all below it; the budget is at most what the node can use."""
    node.budget = min(budget, usable(node))
    if not node.children:
        return
    shares = fill([(c.weight, usable(c)) for c in node.children], node.budget)
    for child, share in zip(node.children, shares, strict=True):
        spread(child, share)


def usable(node: Node) -> int:
    """What a node can take: its supply, without branches of weight 0."""
    if node.weight == 0:
        return 0
    return sum(map(usable, node.children)) if node.children else node.supply


def fill(parts: list[tuple[float, int]], budget: int) -> list[int]:
    """Whole shares of a budget in proportion to weights, none above its limit; the rest goes round again."""
    given = [0] * len(parts)
    open_parts = [i for i, (w, limit) in enumerate(parts) if w > 0 and limit > 0]
    left = budget
    while open_parts and left > 0:
        total = sum(parts[i][0] for i in open_parts)
        full = [i for i in open_parts if parts[i][1] <= left * parts[i][0] / total]
        if full:
            for i in full:
                given[i] = parts[i][1]
                left -= parts[i][1]
            open_parts = [i for i in open_parts if i not in full]
            continue
        exact = {i: left * parts[i][0] / total for i in open_parts}
        for i in open_parts:
            given[i] = int(exact[i])
        # Largest remainders get the tokens that rounding left over.
        rest = left - sum(int(x) for x in exact.values())
        for i in sorted(open_parts, key=lambda i: (int(exact[i]) - exact[i], i))[:rest]:
            given[i] += 1
        left = 0
    return given


def budgets(leaves: dict[tuple[str, ...], int], weights: dict, total: int, epochs: int) -> dict[tuple[str, ...], int]:
    """The budget of each leaf, from the tokens of one epoch of it."""
    root = build_tree({path: tokens * epochs for path, tokens in leaves.items()}, weights)
    spread(root, total)
    found, stack = {}, [root]
    while stack:
        node = stack.pop()
        stack.extend(node.children)
        if node.path and not node.children:
            found[node.path] = node.budget
    return found


def mix(
    docs: DataFrame, tokens: Column, weights: dict[tuple[str, ...], float], total: int | None = None,
    fraction: float = 1.0, epochs: int = 1, seed: int = 0, levels: tuple[str, ...] = LEVELS, key: str = "doc_id",
) -> DataFrame:
    """``(key, levels, n_tokens, leaf_budget, copies)`` per document; copies: how many epochs it is taken in.

    ``total`` is the budget in tokens; without it, ``fraction`` of all tokens.
    """
    labels = [leaf_key(F.col(level)).alias(level) for level in levels]
    rows = materialise(docs.select(F.col(key), *labels, tokens.alias("n_tokens")), "tokens")
    leaves = {
        tuple(row[level] for level in levels): (row["tokens"], row["n"])
        for row in rows.groupBy(*levels).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n")).collect()
    }
    supply = {path: tokens for path, (tokens, _) in leaves.items()}
    count = sum(n for _, n in leaves.values())
    budget = int(fraction * sum(supply.values())) if total is None else total
    found = budgets(supply, weights, budget, epochs)
    spark = docs.sparkSession
    plan = [
        (*path, amount, amount // supply[path] if supply[path] else 0, amount % supply[path] if supply[path] else 0)
        for path, amount in found.items()
    ]
    schema = ", ".join([*(f"{level} string" for level in levels), "leaf_budget bigint", "whole bigint", "part bigint"])
    table = spark.createDataFrame(plan, schema)
    # One row per leaf, all of which the driver holds already: broadcast, so that a hot leaf stays spread out.
    ordered = rows.join(F.broadcast(table), list(levels)).withColumn(
        "place", F.xxhash64(F.lit(seed), F.col("whole"), F.col(key).cast("string"))
    )
    bits = max(0, (max(count, 1) // RANGE_ROWS).bit_length())
    cut = ordered.withColumn("range", F.shiftright("place", 64 - bits) if bits else F.lit(0).cast("long"))
    sums = cut.filter("part > 0").groupBy(*levels, "range").agg(F.sum("n_tokens").alias("held"))
    upto = W.Window.partitionBy(*levels).orderBy("range").rowsBetween(W.Window.unboundedPreceding, W.Window.currentRow)
    edge = sums.withColumn("upto", F.sum("held").over(upto)).withColumn("before", F.col("upto") - F.col("held"))
    # The budget is reached in one range of each leaf; it is below the leaf's tokens, so there always is one.
    border = edge.join(table, list(levels)).filter("before < part AND upto >= part").select(
        *levels, F.col("range").alias("border"), "before"
    )
    placed = materialise(cut.join(F.broadcast(border), list(levels), "left"), "placed")
    inside = W.Window.partitionBy(*levels).orderBy("place").rangeBetween(W.Window.unboundedPreceding, W.Window.currentRow)
    held = placed.filter("range = border")
    here = held.withColumn("earlier", F.col("before") + F.sum("n_tokens").over(inside) - _tied(levels)).withColumn(
        "taken", F.col("earlier") < F.col("part")
    )
    elsewhere = placed.filter("border IS NULL OR range <> border").withColumn(
        "taken", F.coalesce(F.col("range") < F.col("border"), F.lit(False))
    )
    both = here.drop("earlier").unionByName(elsewhere)
    copies = F.when(F.col("n_tokens") == 0, 0).otherwise(F.col("whole") + F.col("taken").cast("int")).cast("long")
    named = [F.when(F.col(level) != NONE, F.col(level)).alias(level) for level in levels]
    return both.select(key, *named, "n_tokens", "leaf_budget", copies.alias("copies"))


def _tied(levels: tuple[str, ...]) -> Column:
    """Tokens of all rows at the same place of a leaf, so that repeated rows are taken together."""
    return F.sum("n_tokens").over(W.Window.partitionBy(*levels, "place"))
