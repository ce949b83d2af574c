"""Whole-text containment: which documents contain which passages, as an equi-join."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gleaner.functions.text import words
from gleaner.operators.ordinal import with_ordinal
from gleaner.session import materialise


def _hashed_words(text: Column) -> Column:
    return F.transform(words(text), lambda word: F.xxhash64(word))


def _runs(hashes: str, size: int) -> Column:
    """Hashes of all runs of ``size`` consecutive words, from the word hashes in column ``hashes``.

    Shifted copies are zipped, so no lambda looks back into the whole array.
    """
    count = F.greatest(F.size(hashes) - (size - 1), F.lit(0))
    runs = F.slice(hashes, 1, count)
    for shift in range(1, size):
        runs = F.zip_with(runs, F.slice(hashes, shift + 1, count), lambda a, b: F.xxhash64(a, b))
    return runs


def containment(corpus: DataFrame, passages: DataFrame, size: int = 4) -> DataFrame:
    """``(query_id, doc_id)`` where ``corpus.text`` contains ``passages.text`` as a substring.

    A passage's inner words (all but the first and last, which may be cut inside the document's own
    words) occur whole and in order in any text that contains it, so its rarest inner run of ``size``
    words is a safe join key. Only documents with that run are checked by ``contains``. Passages too
    short to have an inner run go through shorter runs; those without an inner word, through a scan.
    """
    hashes = _hashed_words(F.col("text"))
    inner = F.slice("hashes", 2, F.greatest(F.size("hashes") - 2, F.lit(0)))
    asked = passages.select("query_id", "text", hashes.alias("hashes")).withColumn("inner", inner)
    long = asked.filter(F.size("inner") >= size)
    # Stored first, so that the planner knows the size of the asked runs and can broadcast them.
    runs = materialise(long.select("query_id", F.explode(_runs("inner", size)).alias("run")).distinct(), "asked")
    # One narrow pass over the corpus; the semi-join keeps only the runs that some passage asks for.
    seen = (
        corpus.select("doc_id", hashes.alias("hashes"))
        .select("doc_id", F.explode(_runs("hashes", size)).alias("run"))
        .join(runs.select("run").distinct(), "run", "left_semi")
        .distinct()
    )
    seen = materialise(seen, "runs")
    frequency = seen.groupBy("run").agg(F.count(F.lit(1)).alias("df"))
    rarest = W.partitionBy("query_id").orderBy("df", "run")
    anchors = (
        runs.join(frequency, "run")
        .withColumn("nth", F.row_number().over(rarest))
        .filter("nth = 1")
        .select("query_id", "run")
    )
    # A passage whose runs were not all seen cannot be contained anywhere.
    complete = (
        runs.join(frequency, "run", "left")
        .groupBy("query_id")
        .agg(F.bool_and(F.col("df").isNotNull()).alias("possible"))
        .filter("possible")
    )
    candidates = seen.join(anchors.join(complete, "query_id", "left_semi"), "run").select("query_id", "doc_id")
    candidates = materialise(candidates, "candidates")  # known size: the texts are then not shuffled if it is small
    texts = long.select("query_id", F.col("text").alias("passage"))
    found = (
        candidates.join(corpus.select("doc_id", "text"), "doc_id")
        .join(texts, "query_id")
        .filter(F.contains("text", "passage"))
        .select("query_id", "doc_id")
    )
    short = materialise(asked.filter(F.size("inner") < size).select("query_id", "text"), "short")
    if short.isEmpty():
        return found
    rest = containment(corpus, short, size - 1) if size > 1 else substring_scan(corpus, short)
    return found.unionByName(rest)


def substring_scan(corpus: DataFrame, passages: DataFrame, block: int = 1000) -> DataFrame:
    """Containment for passages without an inner word: ``block`` of them at a time on one corpus scan.

    Only matches leave a task.
    """
    query_type = passages.schema["query_id"].dataType.simpleString()
    doc_type = corpus.schema["doc_id"].dataType.simpleString()
    numbered = with_ordinal(passages, ["query_id"])
    blocks = -(-passages.count() // block)
    context = corpus.sparkSession.sparkContext
    results = []
    for number in range(blocks):
        chunk = numbered.filter(F.floor(F.col("ordinal") / block) == number).select("query_id", "text").toPandas()
        shipped = context.broadcast(list(chunk.itertuples(index=False, name=None)))

        def scan(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for query_id, text in shipped.value:
                    ids = batch.column("doc_id").filter(pc.match_substring(batch.column("text"), text))
                    if len(ids):
                        yield pa.RecordBatch.from_arrays([pa.array([query_id] * len(ids)), ids], ["query_id", "doc_id"])

        schema = f"query_id {query_type}, doc_id {doc_type}"
        results.append(corpus.select("doc_id", "text").mapInArrow(scan, schema))
    return reduce(DataFrame.unionByName, results)
