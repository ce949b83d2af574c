"""BM25: a stored index of term counts, then block scoring of the query set."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions.text import words
from gleaner.functions.vectors import list_lengths
from gleaner.operators.blocks import MATRIX_CELLS, Scorer, topk
from gleaner.operators.ordinal import placed
from gleaner.session import materialise

# The usual Okapi constants.
K1 = 1.5
B = 0.75
EPSILON = 0.25


@dataclass(frozen=True)
class LexicalIndex:
    """``docs(doc_id, terms, counts, dl)``, ``terms(term, df, idf)``, the corpus size and mean length.

    A document's different terms and their counts are two lists side by side, stored once: statistics and every search
    read them, and no text is tokenised again.
    """

    docs: DataFrame
    terms: DataFrame
    n_docs: int
    avgdl: float

    def postings(self) -> DataFrame:
        """``(term, doc_id, tf)``, one row per document and different term."""
        entries = F.arrays_zip(F.col("terms").alias("term"), F.col("counts").alias("tf"))
        return self.docs.select("doc_id", F.inline(entries)).select("term", "doc_id", F.col("tf").cast("bigint").alias("tf"))

    def save(self, path: str) -> None:
        """Write the index below ``path``; :func:`load_index` reads it in any session."""
        self.docs.write.parquet(f"{path}/docs")
        self.terms.write.parquet(f"{path}/terms")
        sizes = [(self.n_docs, self.avgdl)]
        self.docs.sparkSession.createDataFrame(sizes, "n_docs bigint, avgdl double").coalesce(1).write.parquet(f"{path}/sizes")


def load_index(spark: SparkSession, path: str) -> LexicalIndex:
    sizes = spark.read.parquet(f"{path}/sizes").first()
    return LexicalIndex(spark.read.parquet(f"{path}/docs"), spark.read.parquet(f"{path}/terms"), sizes.n_docs, sizes.avgdl)


def counted(corpus: DataFrame, text: str = "text") -> DataFrame:
    """``(doc_id, terms, counts, dl)``: the different words of each text, sorted, with their counts. No row moves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("tokens")
            lengths = list_lengths(lists)
            encoded = lists.flatten().dictionary_encode()
            width = max(1, len(encoded.dictionary))
            cells, counts = np.unique(
                np.repeat(np.arange(batch.num_rows), lengths) * width + encoded.indices.to_numpy(), return_counts=True
            )
            ends = pa.array(np.searchsorted(cells // width, np.arange(batch.num_rows + 1)), pa.int32())
            terms = pa.ListArray.from_arrays(ends, encoded.dictionary.take(pa.array(cells % width)))
            tf = pa.ListArray.from_arrays(ends, pa.array(counts, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), terms, tf, pa.array(lengths, pa.int64())], ["doc_id", "terms", "counts", "dl"]
            )

    kind = corpus.schema["doc_id"].dataType.simpleString()
    tokens = F.coalesce(words(F.col(text)), F.array().cast("array<string>"))
    listed = corpus.select("doc_id", tokens.alias("tokens"))
    return listed.mapInArrow(run, f"doc_id {kind}, terms array<string>, counts array<int>, dl bigint")


def build_index(corpus: DataFrame, text: str = "text", ordered: bool = False) -> LexicalIndex:
    """Index ``corpus(doc_id, <text>)``: tokenised and stored once, then statistics from what is stored.

    With ``ordered`` the texts are brought into the order of their ids first, and ``docs`` has the ``place`` of each.

    Every document gives its different words plus one NULL word that carries its length, so the same map-side combined
    aggregation yields document frequencies, corpus size and mean length.
    """
    if ordered:
        corpus = corpus.select("doc_id", text).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    listed = counted(corpus, text)
    docs = materialise(placed(listed) if ordered else listed, "lexical-docs")
    marked = docs.select("dl", F.explode(F.concat("terms", F.array(F.lit(None).cast("string")))).alias("term"))
    tallied = materialise(
        marked.groupBy("term").agg(
            F.count(F.lit(1)).alias("df"),
            F.sum(F.when(F.col("term").isNull(), F.col("dl"))).alias("total_dl"),
        ),
        "terms",
    )
    sizes = tallied.filter(F.col("term").isNull()).select("df", "total_dl").first()
    n_docs, avgdl = (sizes.df, sizes.total_dl / sizes.df) if sizes else (0, 1.0)
    raw = tallied.filter(F.col("term").isNotNull()).select(
        "term", "df", (F.log(F.lit(n_docs) - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)).alias("raw_idf")
    )
    # Words in more than half of the documents get a small positive weight instead of a negative one.
    mean_idf = raw.agg(F.avg("raw_idf")).first()[0] or 0.0
    idf = F.when(F.col("raw_idf") < 0, F.lit(EPSILON * mean_idf)).otherwise(F.col("raw_idf"))
    return LexicalIndex(docs, raw.select("term", "df", idf.alias("idf")), n_docs, avgdl)


def query_weights(index: LexicalIndex, queries: DataFrame, text: str = "text") -> DataFrame:
    """``(query_id, term, weight, avgdl)``: idf times the word's count in the query."""
    asked = (
        queries.select("query_id", F.explode(words(F.col(text))).alias("term"))
        .groupBy("query_id", "term")
        .agg(F.count(F.lit(1)).alias("qtf"))
    )
    # Stored first: with its size known, it is broadcast to the vocabulary rather than shuffled with it.
    return materialise(asked, "asked").join(index.terms, "term").select(
        "query_id",
        "term",
        (F.col("qtf") * F.col("idf")).alias("weight"),
        F.lit(index.avgdl).alias("avgdl"),
    )


def _prepare(block: pa.Table) -> dict:
    frame = block.to_pandas()
    query_codes, query_ids = pd.factorize(frame["query_id"], sort=True)
    term_codes, vocabulary = pd.factorize(frame["term"])
    order = np.argsort(term_codes, kind="stable")
    return {
        "ids": pd.Index(query_ids),
        "vocabulary": pa.array(vocabulary, pa.string()),
        "starts": np.searchsorted(term_codes[order], np.arange(len(vocabulary) + 1)),
        "queries": query_codes[order],
        "weights": frame["weight"].to_numpy()[order],
        "avgdl": float(frame["avgdl"].iloc[0]) if len(frame) else 1.0,
    }


def _bm25_scores(k1: float, b: float):
    def score(state: dict, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n_queries = max(1, len(state["ids"]))
        lists = batch.column("terms")
        codes = pc.index_in(lists.flatten(), value_set=state["vocabulary"])
        known = codes.is_valid().to_numpy(zero_copy_only=False)
        doc = np.repeat(np.arange(batch.num_rows), list_lengths(lists))[known]
        term = codes.drop_null().to_numpy().astype(np.int64)
        tf = batch.column("counts").flatten().to_numpy(zero_copy_only=False)[known]
        dl = batch.column("dl").to_numpy()
        gain = tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl[doc] / state["avgdl"]))
        # Spread every (document, term) gain over the queries that ask for the term, in bounded pieces; only pairs that
        # share a term are ever held.
        first = state["starts"][term]
        fan = state["starts"][term + 1] - first
        reach = np.cumsum(fan)
        pairs, totals = np.empty(0, np.int64), np.empty(0)
        start = 0
        while start < len(term):
            done = reach[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(reach, done + MATRIX_CELLS, side="right")))
            width = fan[start:stop]
            spread = np.repeat(np.arange(start, stop), width)
            slot = first[spread] + np.arange(len(spread)) - np.repeat(np.cumsum(width) - width, width)
            cells = np.concatenate([pairs, doc[spread] * n_queries + state["queries"][slot]])
            values = np.concatenate([totals, gain[spread] * state["weights"][slot]])
            pairs, place = np.unique(cells, return_inverse=True)
            totals = np.bincount(place, values, len(pairs))
            start = stop
        return pairs // n_queries, pairs % n_queries, totals

    return score


def bm25(
    index: LexicalIndex, queries: DataFrame, k: int = 4, k1: float = K1, b: float = B,
    text: str = "text", max_query_rows: int = 200_000,
) -> DataFrame:
    """Top-k by Okapi BM25. Only documents with a positive score are returned."""
    scorer = Scorer(_prepare, lambda state: state["ids"], _bm25_scores(k1, b), floor=0.0)
    return topk(index.docs, query_weights(index, queries, text), scorer, k, max_query_rows)


def expand_queries(queries: DataFrame, synonyms: DataFrame, text: str = "text") -> DataFrame:
    """Append the synonyms of a query's words: ``synonyms(term, synonym)``."""
    added = (
        queries.select("query_id", F.explode(F.array_distinct(words(F.col(text)))).alias("term"))
        .join(synonyms, "term")
        .groupBy("query_id")
        .agg(F.concat_ws(" ", F.array_sort(F.collect_set("synonym"))).alias("added"))
    )
    return queries.join(added, "query_id", "left").withColumn(text, F.concat_ws(" ", text, "added")).drop("added")
