"""Retriever catalogue: names and aliases, characteristics, registry, sweep, response records."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accepted names and the retriever each stands for.
ALIASES = {
    "bm25": "bm25_retriever",
    "dense": "semantic_retriever",
    "hybrid": "ensemble_retriever",
    "semantic": "semantic_retriever",
    "naive": "naive_retriever",
    "contextual_compression": "contextual_compression_retriever",
    "multi_query": "multi_query_retriever",
    "parent_document": "parent_document_retriever",
    "ensemble": "ensemble_retriever",
}

# Retriever characteristics as (description, strength, weakness, best_for).
CHARACTERISTICS = {
    "bm25": (
        "Traditional lexical search using BM25 algorithm",
        "Good for exact keyword matching, fast, no training required",
        "Doesn't understand semantics, sensitive to vocabulary mismatch",
        "Precise keyword queries, straightforward information retrieval",
    ),
    "dense": (
        "Neural embedding-based semantic search using dense vectors",
        "Good semantic understanding, can find relevant content without exact matches",
        "More computationally expensive, requires training or pre-trained models",
        "Complex questions, conceptual similarity, handling paraphrases",
    ),
    "hybrid": (
        "Combined approach using both lexical and semantic matching",
        "Leverages benefits of both BM25 and dense retrieval",
        "More complex, potentially higher latency",
        "General-purpose retrieval with both keyword and semantic components",
    ),
    "semantic": (
        "Pure semantic search optimized for meaning rather than keywords",
        "High recall for semantically related content",
        "May miss exact matches, slower than lexical search",
        "Open-ended questions, conceptual exploration",
    ),
}

Retriever = Callable[..., DataFrame]
REGISTRY: dict[str, Retriever] = {}


def register(name: str, retriever: Retriever) -> None:
    """Add a retriever ``(corpus, queries, **options) -> hits`` under a name."""
    REGISTRY[name] = retriever


def lookup(mapping: dict[str, str], key: Column) -> Column:
    """A constant mapping as an expression: no join, no shuffle."""
    pairs = [F.lit(part) for item in mapping.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), key)


def resolve(requests: DataFrame, column: str = "retriever_type") -> DataFrame:
    """Add ``engine`` (the retriever a name stands for) and ``accepted``."""
    engine = lookup(ALIASES, F.col(column))
    return requests.withColumn("engine", engine).withColumn("accepted", F.col("engine").isNotNull())


def with_characteristics(results: DataFrame, column: str = "retriever_type") -> DataFrame:
    """Add the four characteristics of a retriever; NULL for unknown ones."""
    for place, name in enumerate(["description", "strength", "weakness", "best_for"]):
        mapping = {key: values[place] for key, values in CHARACTERISTICS.items()}
        results = results.withColumn(name, lookup(mapping, F.col(column)))
    return results


def sweep(runs: dict[str, DataFrame]) -> DataFrame:
    """Hits of several retrievers over one question set, as one table."""
    tagged = [hits.withColumn("retriever_type", F.lit(name)) for name, hits in runs.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def run_registered(names: list[str], corpus: DataFrame, queries: DataFrame, **options) -> DataFrame:
    """Sweep over registered retrievers."""
    return sweep({name: REGISTRY[name](corpus, queries, **options) for name in names})


def responses(hits: DataFrame, top_k: int) -> DataFrame:
    """Response record of each query and retriever: its documents in order and their count."""
    kept = hits.filter(F.col("rank") <= top_k)
    ordered = F.array_sort(F.collect_list(F.struct("rank", "doc_id", "score")))
    return kept.groupBy("query_id", "retriever_type").agg(
        F.lit(top_k).alias("top_k"),
        F.concat(F.lit("spark-"), F.first("retriever_type"), F.lit("-retriever")).alias("engine"),
        F.count(F.lit(1)).alias("document_count"),
        ordered.alias("documents"),
    )
