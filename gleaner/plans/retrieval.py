"""Retrieval queries: documents searched with the benchmark passages, and the vector table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.functions.text import sentences, words
from gleaner.functions.vectors import as_double, dequantise, normalise, quantise, shorten
from gleaner.operators import catalog, chunking, dense, fusion, lexical, neighbours, postings, shaping, testset
from gleaner.operators.graph import neighbourhood
from gleaner.plans import sql
from gleaner.plans.registry import ORACLES, Tables, query
from gleaner.session import materialise


def posting_index(t: Tables) -> postings.PostingIndex:
    """The stored index of the documents: built by the first query that asks for it, read by all others of the session."""
    return t.stored("postings", lambda path: postings.build(t.corpus, path), lambda path: postings.load(t.spark, path))


def bm25_hits(t: Tables, k: int = 4, corpus: DataFrame | None = None, questions: DataFrame | None = None) -> DataFrame:
    """Hits from the stored postings; another corpus than the documents gets an index of its own."""
    index = posting_index(t) if corpus is None else postings.build(corpus, t.scratch("postings"))
    return postings.search(index, questions if questions is not None else t.questions, k)


def vectors(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Hashed vectors with the portable hash, so that the SQL side can repeat them."""
    return dense.embed(df, text, hashing="md5").select(key, "vector")


def dense_hits(t: Tables, k: int = 10) -> DataFrame:
    return dense.dense(vectors(t.corpus, "doc_id"), vectors(t.questions, "query_id"), k)


def label_queries(t: Tables) -> DataFrame:
    """One query per label of the vector table: the normalised sum of the label's vectors."""
    entries = t.embeddings.select("label", F.posexplode(as_double(F.col("embedding"))).alias("pos", "x"))
    sums = entries.groupBy("label", "pos").agg(F.sum("x").alias("x"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "x")))
    return sums.groupBy("label").agg(F.transform(ordered, lambda e: e["x"]).alias("v")).select(
        F.col("label").alias("query_id"), F.transform(normalise(F.col("v")), lambda x: F.round(x, 6)).alias("vector")
    )


def stored_vectors(t: Tables) -> DataFrame:
    return dense.unit_vectors(t.embeddings.withColumnRenamed("vec_id", "doc_id"), "doc_id", dims=64)


LABEL_SQL = """
unit AS (SELECT vec_id AS doc_id, label, list_transform(e, lambda x: x / n) AS v FROM (
  SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS n FROM (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings))),
ent AS (SELECT label, i, sum(e[i]) AS x FROM (SELECT label, embedding::DOUBLE[] AS e, unnest(range(1, 65)) AS i FROM embeddings) GROUP BY ALL),
cent0 AS (SELECT label, list(x ORDER BY i) AS c FROM ent GROUP BY label),
cent AS (SELECT label AS query_id, list_transform(c, lambda x: round(x / n, 6)) AS q
  FROM (SELECT label, c, sqrt(list_dot_product(c, c)) AS n FROM cent0))"""


def _rank_sql(scores: str, k: int) -> str:
    return f"""SELECT query_id, doc_id, score, rank FROM (SELECT *, row_number() OVER (
PARTITION BY query_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM ({scores})) WHERE rank <= {k}"""


@query("lexical_index", f"WITH {sql.idf('')} SELECT term, df, round(idf, 9) AS idf FROM idf")
def lexical_index(t: Tables) -> DataFrame:
    return posting_index(t).terms.select("term", "df", F.round("idf", 9).alias("idf"))


@query("lexical_postings", f"WITH tok AS (SELECT doc_id, unnest({sql.words('text')}) AS term FROM documents) "
       "SELECT term, doc_id, count(*) AS tf FROM tok GROUP BY ALL")
def lexical_postings(t: Tables) -> DataFrame:
    return postings.postings(posting_index(t))


@query("bm25_topk", f"WITH {sql.bm25('', 4)} SELECT * FROM hits")
def bm25_topk(t: Tables) -> DataFrame:
    return bm25_hits(t)


@query("dense_topk", f"WITH {sql.dense('', 10)} SELECT * FROM hits")
def dense_topk(t: Tables) -> DataFrame:
    return dense_hits(t)


@query("vector_topk", f"WITH {LABEL_SQL} " + _rank_sql(
    "SELECT query_id, doc_id, round(list_dot_product(q, v), 6) AS score FROM cent, unit", 10))
def vector_topk(t: Tables) -> DataFrame:
    return dense.dense(stored_vectors(t), label_queries(t), 10)


@query("shortened_topk", f"""WITH {LABEL_SQL},
su AS (SELECT doc_id, v, v[1:16] AS s FROM unit), sq AS (SELECT query_id, q, q[1:16] AS s FROM cent),
coarse AS ({_rank_sql("SELECT query_id, doc_id, round(list_dot_product(sq.s, su.s) / sqrt(list_dot_product(sq.s, sq.s)) / sqrt(list_dot_product(su.s, su.s)), 6) AS score FROM sq, su", 50)})
{_rank_sql("SELECT c.query_id, c.doc_id, round(list_dot_product(q, v), 6) AS score FROM coarse c JOIN unit USING (doc_id) JOIN cent USING (query_id)", 10)}""")
def shortened_topk(t: Tables) -> DataFrame:
    return dense.shortened_search(stored_vectors(t), label_queries(t), 10, coarse_dims=16, fetch=50)


@query("quantised_topk", f"WITH {LABEL_SQL} " + _rank_sql(
    "SELECT query_id, doc_id, round(list_dot_product(q, list_transform(v, lambda x: round(x * 127) / 127)), 6) AS score FROM cent, unit", 10))
def quantised_topk(t: Tables) -> DataFrame:
    return dense.quantised_search(stored_vectors(t), label_queries(t), 10)


CELL_SQL = f"""WITH {LABEL_SQL},
asg AS (SELECT doc_id, cell FROM (SELECT doc_id, query_id AS cell, row_number() OVER (PARTITION BY doc_id
  ORDER BY round(list_dot_product(q, v), 6) DESC, query_id) AS r FROM unit, cent) WHERE r = 1),
qc AS (SELECT query_id, cell FROM (SELECT a.query_id, b.query_id AS cell, row_number() OVER (PARTITION BY a.query_id
  ORDER BY round(list_dot_product(a.q, b.q), 6) DESC, b.query_id) AS r FROM cent a, cent b) WHERE r <= 2)"""


@query("cell_assignment", CELL_SQL + " SELECT doc_id, cell::BIGINT AS cell FROM asg")
def cell_assignment(t: Tables) -> DataFrame:
    cells = label_queries(t).select(F.col("query_id").cast("bigint").alias("cell"), "vector")
    return dense.assign_cells(stored_vectors(t), "doc_id", cells).select("doc_id", "cell")


@query("cell_topk", CELL_SQL + _rank_sql(
    "SELECT qc.query_id, doc_id, round(list_dot_product(q, v), 6) AS score "
    "FROM qc JOIN asg USING (cell) JOIN unit USING (doc_id) JOIN cent ON cent.query_id = qc.query_id", 10))
def cell_topk(t: Tables) -> DataFrame:
    questions = materialise(label_queries(t), "cells")
    cells = questions.select(F.col("query_id").cast("bigint").alias("cell"), "vector")
    indexed = dense.assign_cells(stored_vectors(t), "doc_id", cells)
    return dense.cell_search(indexed, questions, cells, k=10, probes=2)


@query("trained_cell_topk", ORACLES["vector_topk"])
def trained_cell_topk(t: Tables) -> DataFrame:
    """Search over trained cells with all of them probed, which is the exact search."""
    stored = materialise(stored_vectors(t), "vectors")
    cells = dense.train_cells(stored, 16)
    return dense.cell_search(dense.assign_cells(stored, "doc_id", cells), label_queries(t), cells, k=10, probes=16)


@query("code_topk", f"""WITH {LABEL_SQL},
cu AS (SELECT doc_id, v, list_transform(v, lambda x: round(x * 127)) AS c FROM unit), cq AS (SELECT query_id, q, list_transform(q, lambda x: round(x * 127)) AS c FROM cent),
coarse AS ({_rank_sql("SELECT query_id, doc_id, list_dot_product(cq.c, cu.c) AS score FROM cq, cu", 40)})
{_rank_sql("SELECT c.query_id, c.doc_id, round(list_dot_product(q, v), 6) AS score FROM coarse c JOIN unit USING (doc_id) JOIN cent USING (query_id)", 10)}""")
def code_topk(t: Tables) -> DataFrame:
    return dense.code_search(stored_vectors(t), label_queries(t), 10, fetch=40)


@query("approximate_recall")
def approximate_recall(t: Tables) -> DataFrame:
    """Recall of the graph, of trained cells and of codes at ten hits: every fiftieth vector searched among all of them."""
    stored = materialise(stored_vectors(t), "vectors")
    asked = materialise(stored.filter("doc_id % 50 = 0").withColumnRenamed("doc_id", "query_id"), "queries")
    exact = materialise(dense.dense(stored, asked, 10), "exact")
    cells = dense.train_cells(stored, 16)
    found = {
        "graph": neighbours.search(neighbours.build(stored, t.scratch("neighbours")), asked, 10),
        "cells": dense.cell_search(dense.assign_cells(stored, "doc_id", cells), asked, cells, k=10, probes=12),
        "codes": dense.code_search(stored, asked, 10, fetch=40),
    }
    rows = [neighbours.recall(hits, exact).withColumn("method", F.lit(name)) for name, hits in found.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query("hashed_embedding", f"""WITH {sql.buckets('', 'doc_id', sql.CORPUS)}
SELECT doc_id, b::INTEGER AS dim, round(x, 6) AS x FROM vec""")
def hashed_embedding(t: Tables) -> DataFrame:
    entries = vectors(t.corpus, "doc_id").select("doc_id", F.posexplode("vector").alias("dim", "x"))
    return entries.filter("x > 0").select("doc_id", "dim", F.round("x", 6).alias("x"))


@query("vector_codes", """WITH u AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)),
c AS (SELECT vec_id, unnest(range(1, 65)) AS i, e, n FROM u),
s AS (SELECT vec_id, sqrt(list_dot_product(e[1:16], e[1:16])) / n AS n16 FROM u)
SELECT vec_id, sum(round(e[i] / n * 127))::BIGINT AS code_sum, round(max(round(e[i] / n * 127) / 127), 6) AS largest,
round(max(n16), 6) AS kept_length FROM c JOIN s USING (vec_id) GROUP BY vec_id""")
def vector_codes(t: Tables) -> DataFrame:
    unit = dense.unit_vectors(t.embeddings, "vec_id", dims=64)
    coded = unit.withColumns({"codes": quantise(F.col("vector")), "short": F.slice("vector", 1, 16)})
    return coded.select(
        "vec_id",
        F.aggregate("codes", F.lit(0).cast("bigint"), lambda a, c: a + c).alias("code_sum"),
        F.round(F.array_max(dequantise(F.col("codes"))), 6).alias("largest"),
        F.round(F.sqrt(F.aggregate("short", F.lit(0.0), lambda a, x: a + x * x)), 6).alias("kept_length"),
    )


@query("shortened_vectors", """WITH u AS (SELECT vec_id, e[1:8] AS s FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)),
c AS (SELECT vec_id, s, sqrt(list_dot_product(s, s)) AS n, unnest(range(1, 9)) AS i FROM u)
SELECT vec_id, (i - 1)::INTEGER AS dim, round(s[i] / n, 6) AS x FROM c""")
def shortened_vectors(t: Tables) -> DataFrame:
    short = dense.unit_vectors(t.embeddings, "vec_id").select("vec_id", shorten(F.col("vector"), 8).alias("v"))
    return short.select("vec_id", F.posexplode("v").alias("dim", "x")).withColumn("x", F.round("x", 6))


def overlap_scores(hits: DataFrame, corpus: DataFrame, questions: DataFrame) -> DataFrame:
    """Pair score for re-ranking: share of the question's distinct words found in the document."""
    asked = questions.select("query_id", F.array_distinct(words(F.col("text"))).alias("asked"))
    pairs = hits.select("query_id", "doc_id").join(asked, "query_id").join(corpus, "doc_id")
    tokens = pairs.select("query_id", "doc_id", "asked", words(F.col("text")).alias("tokens"))
    share = F.size(F.array_intersect("asked", "tokens")) / F.size("asked")
    return tokens.select("query_id", "doc_id", F.round(share, 6).alias("score"))


def _rerank_sql(fetch: int, k: int) -> str:
    asked = sql.words("q.text")
    return f"""WITH {sql.dense('', fetch)},
p AS (SELECT query_id, h.doc_id, list_distinct({asked}) AS a, {sql.words('d.text')} AS w
  FROM hits h JOIN ({sql.QUESTIONS}) q USING (query_id) JOIN documents d USING (doc_id))
{_rank_sql("SELECT query_id, doc_id, round(len(list_intersect(a, w)) / len(a), 6) AS score FROM p", k)}"""


@query("compressed_topk", _rerank_sql(10, 3))
def compressed_topk(t: Tables) -> DataFrame:
    return dense.rerank(overlap_scores(dense_hits(t, 10), t.corpus, t.questions), 3)


@query("wide_rerank", _rerank_sql(20, 5))
def wide_rerank(t: Tables) -> DataFrame:
    return dense.rerank(overlap_scores(dense_hits(t, 20), t.corpus, t.questions), 5)


def halves(questions: DataFrame) -> DataFrame:
    """Two phrasings per question: the first and the second half of its words."""
    tokens = questions.select("query_id", words(F.col("text")).alias("w"))
    middle = F.floor(F.size("w") / 2).cast("int")
    parts = F.array(F.slice("w", F.lit(1), middle), F.slice("w", middle + 1, F.size("w") - middle))
    return tokens.select("query_id", F.posexplode(parts).alias("variant_no", "part")).select(
        F.concat_ws("-", "query_id", "variant_no").alias("variant_id"),
        "query_id", "variant_no", F.concat_ws(" ", "part").alias("text"),
    )


HALVES = f"""SELECT query_id || '-' || v AS query_id, query_id AS qid, v, CASE WHEN v = 0
THEN array_to_string(w[1:len(w) // 2], ' ') ELSE array_to_string(w[len(w) // 2 + 1:], ' ') END AS text
FROM (SELECT query_id, {sql.words('text')} AS w, unnest([0, 1]) AS v FROM ({sql.QUESTIONS}))"""


@query("multi_query", f"""WITH var AS ({HALVES}), {sql.bm25('', 4, queries='SELECT query_id, text FROM var')},
u AS (SELECT qid AS query_id, doc_id, min(v * 1000 + rank) AS o, max(score) AS score FROM hits JOIN var USING (query_id) GROUP BY ALL)
SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY o, doc_id)::INTEGER AS rank FROM u""")
def multi_query(t: Tables) -> DataFrame:
    variants = halves(t.questions)
    hits = bm25_hits(t, 4, questions=variants.select(F.col("variant_id").alias("query_id"), "text"))
    return fusion.variant_union(hits, variants.select("variant_id", "query_id", "variant_no"))


CHILDREN = """SELECT doc_id || '#' || i AS doc_id, doc_id AS parent_id, substr(text, (200 * i + 1)::BIGINT, 200) AS text
FROM (SELECT doc_id, text, unnest(range(0, greatest((length(text) + 199) // 200, 1))) AS i FROM documents)"""

PARENT_SQL = f"""WITH ch AS ({CHILDREN}), {sql.dense('', 10, 'SELECT doc_id, text FROM ch')}"""


def child_hits(t: Tables) -> DataFrame:
    children = chunking.child_chunks(t.corpus, 200)
    return dense.dense(vectors(children, "doc_id", "chunk_text"), vectors(t.questions, "query_id"), 10)


@query("parent_document", PARENT_SQL + """,
u AS (SELECT query_id, parent_id AS doc_id, min(rank) AS o, max(score) AS score FROM hits JOIN ch USING (doc_id) GROUP BY ALL)
SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY o, doc_id)::INTEGER AS rank FROM u""")
def parent_document(t: Tables) -> DataFrame:
    return fusion.parents_of(child_hits(t))


SEMANTIC = f"""
sen AS (SELECT doc_id, s, (i - 1)::INTEGER AS pos, array_to_string(s[greatest(i - 1, 1):least(i + 1, len(s))], ' ') AS win
  FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i FROM (SELECT doc_id, {sql.sentences('text')} AS s FROM documents))),
sb AS (SELECT doc_id, pos, ('0x' || substr(md5(t), 1, 8))::BIGINT % 64 AS b, count(*)::DOUBLE AS n
  FROM (SELECT doc_id, pos, unnest({sql.words('win')}) AS t FROM sen) GROUP BY ALL),
sn AS (SELECT doc_id, pos, sqrt(sum(n * n)) AS len FROM sb GROUP BY ALL),
sv AS (SELECT doc_id, pos, b, n / len AS x FROM sb JOIN sn USING (doc_id, pos)),
dist AS (SELECT x.doc_id, x.pos, round(1 - coalesce(d, 0), 6) AS distance FROM (SELECT doc_id, pos FROM sen WHERE pos > 0) x
  LEFT JOIN (SELECT a.doc_id, a.pos, sum(a.x * p.x) AS d FROM sv a JOIN sv p ON a.doc_id = p.doc_id AND a.b = p.b AND a.pos = p.pos + 1 GROUP BY ALL) y USING (doc_id, pos)),
lim AS (SELECT doc_id, quantile_cont(distance, 0.95) AS cut FROM dist GROUP BY doc_id),
mark AS (SELECT sen.doc_id, sen.pos, s[sen.pos + 1] AS sentence, CASE WHEN distance > cut THEN 1 ELSE 0 END AS c
  FROM sen LEFT JOIN dist USING (doc_id, pos) LEFT JOIN lim USING (doc_id)),
num AS (SELECT *, sum(c) OVER (PARTITION BY doc_id ORDER BY pos)::INTEGER AS chunk_id FROM mark),
chunk AS (SELECT doc_id, chunk_id, string_agg(sentence, ' ' ORDER BY pos) AS chunk_text, count(*) AS n_sentences FROM num GROUP BY ALL)"""


@query("semantic_chunks", f"WITH {SEMANTIC} SELECT doc_id, chunk_id, md5(chunk_text) AS chunk_print, n_sentences FROM chunk")
def semantic_chunks(t: Tables) -> DataFrame:
    chunks = chunking.semantic_chunks(t.corpus, hashing="md5")
    return chunks.select("doc_id", "chunk_id", F.md5("chunk_text").alias("chunk_print"), "n_sentences")


@query("semantic_topk", f"""WITH {SEMANTIC},
{sql.dense('', 10, "SELECT doc_id || '#' || chunk_id AS doc_id, chunk_text AS text FROM chunk")} SELECT * FROM hits""")
def semantic_topk(t: Tables) -> DataFrame:
    chunks = chunking.semantic_chunks(t.corpus, hashing="md5")
    keyed = chunks.select(F.concat_ws("#", "doc_id", "chunk_id").alias("doc_id"), "chunk_text")
    return dense.dense(vectors(keyed, "doc_id", "chunk_text"), vectors(t.questions, "query_id"), 10)


def two_lists(t: Tables) -> DataFrame:
    return catalog.sweep({"bm25": bm25_hits(t, 10), "dense": dense_hits(t, 10)})


TWO_LISTS = f"""WITH {sql.bm25('l', 10)}, {sql.dense('v', 10)},
both_ AS (SELECT 'bm25' AS retriever_type, * FROM lhits UNION ALL SELECT 'dense', * FROM vhits)"""


def _fuse_sql(weights: str, k: int) -> str:
    return TWO_LISTS + f", w AS ({weights}) " + _rank_sql(
        "SELECT query_id, doc_id, round(sum(weight / (rank + 60)), 9) AS score FROM both_ JOIN w USING (retriever_type) GROUP BY ALL", k)


def member_table(t: Tables, bm25: str, dense_: str) -> DataFrame:
    """Ensemble members with availability tested on the tables themselves."""
    return t.documents.agg(F.count(F.lit(1)).alias("n")).select(
        F.inline(F.array(
            F.struct(F.lit("bm25").alias("retriever_type"), F.expr(bm25).alias("available")),
            F.struct(F.lit("dense").alias("retriever_type"), F.expr(dense_).alias("available")),
        ))
    )


#: The members of the ensemble, and all registered retrievers.
MEMBERS = ["naive", "bm25", "contextual_compression", "multi_query", "parent_document"]
RETRIEVERS = [*MEMBERS, "ensemble", "semantic"]


def _union_sql(lists: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS retriever_type, query_id, doc_id, score, rank FROM {hits}" for name, hits in lists.items())


MEMBER_SQL = {"naive": "vhits", "bm25": "lhits", "contextual_compression": "comp_hits", "multi_query": "multi_hits", "parent_document": "parent_hits"}

SEVEN = f"""WITH {sql.bm25('l', 10)}, {sql.dense('v', 10)},
comp_pairs AS (SELECT query_id, h.doc_id, list_distinct({sql.words('q.text')}) AS a, {sql.words('d.text')} AS w
  FROM vhits h JOIN ({sql.QUESTIONS}) q USING (query_id) JOIN documents d USING (doc_id)),
comp_hits AS ({_rank_sql("SELECT query_id, doc_id, round(len(list_intersect(a, w)) / len(a), 6) AS score FROM comp_pairs", 3)}),
var AS ({HALVES}), {sql.bm25('m', 4, queries='SELECT query_id, text FROM var')},
multi_hits AS (SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY o, doc_id)::INTEGER AS rank FROM (
  SELECT qid AS query_id, doc_id, min(v * 1000 + rank) AS o, max(score) AS score FROM mhits JOIN var USING (query_id) GROUP BY ALL)),
ch AS ({CHILDREN}), {sql.dense('p', 10, 'SELECT doc_id, text FROM ch')},
parent_hits AS (SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY o, doc_id)::INTEGER AS rank FROM (
  SELECT query_id, parent_id AS doc_id, min(rank) AS o, max(score) AS score FROM phits JOIN ch USING (doc_id) GROUP BY ALL)),
{SEMANTIC}, {sql.dense('s', 10, "SELECT doc_id || '#' || chunk_id AS doc_id, chunk_text AS text FROM chunk")},
sem_hits AS (SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY o, doc_id)::INTEGER AS rank FROM (
  SELECT query_id, split_part(doc_id, '#', 1)::BIGINT AS doc_id, min(rank) AS o, max(score) AS score FROM shits GROUP BY ALL)),
members AS ({_union_sql(MEMBER_SQL)}),
fused AS ({_rank_sql(f"SELECT query_id, doc_id, round(sum(1.0 / {len(MEMBERS)} / (rank + 60)), 9) AS score FROM members GROUP BY ALL", 10)}),
seven AS MATERIALIZED (SELECT * FROM members UNION ALL {_union_sql({'ensemble': 'fused', 'semantic': 'sem_hits'})})"""


def seven_lists(t: Tables) -> DataFrame:
    """The hits of all registered retrievers over the questions, documents for chunks; searched once per session."""

    def search(path: str) -> DataFrame:
        fetched = materialise(dense_hits(t, 10), "naive")
        variants = halves(t.questions)
        by_variant = bm25_hits(t, 4, questions=variants.select(F.col("variant_id").alias("query_id"), "text"))
        runs = {
            "naive": fetched, "bm25": bm25_hits(t, 10),
            "contextual_compression": dense.rerank(overlap_scores(fetched, t.corpus, t.questions), 3),
            "multi_query": fusion.variant_union(by_variant, variants.select("variant_id", "query_id", "variant_no")),
            "parent_document": fusion.parents_of(child_hits(t)),
        }
        members = materialise(catalog.sweep(runs), "members")
        alive = t.documents.agg((F.count(F.lit(1)) > 0).alias("available")).select(
            F.explode(F.array(*map(F.lit, MEMBERS))).alias("retriever_type"), "available"
        )
        rest = {"ensemble": fusion.fuse(members, fusion.equal_weights(alive), 10), "semantic": fusion.parents_of(semantic_topk(t))}
        members.unionByName(catalog.sweep(rest)).write.parquet(path)
        return read(path)

    def read(path: str) -> DataFrame:
        return t.spark.read.parquet(path)

    return t.stored("seven-lists", search, read)


@query("rrf_ensemble", SEVEN + " SELECT * FROM fused")
def rrf_ensemble(t: Tables) -> DataFrame:
    return seven_lists(t).filter("retriever_type = 'ensemble'").drop("retriever_type")


@query("degraded_ensemble", _fuse_sql("SELECT * FROM (VALUES ('bm25', 1.0::DOUBLE)) v(retriever_type, weight)", 10))
def degraded_ensemble(t: Tables) -> DataFrame:
    return fusion.fuse(two_lists(t), fusion.equal_weights(member_table(t, "n > 0", "n < 0")), 10)


@query("weighted_hybrid", _fuse_sql("SELECT * FROM (VALUES ('bm25', 0.3::DOUBLE), ('dense', 0.7)) v(retriever_type, weight)", 10))
def weighted_hybrid(t: Tables) -> DataFrame:
    members = fusion.equal_weights(member_table(t, "n > 0", "n > 0"))
    weights = members.withColumn("weight", F.when(F.col("retriever_type") == "bm25", 0.3).otherwise(0.7))
    return fusion.fuse(two_lists(t), weights, 10)


@query("multi_index", TWO_LISTS + """, p(retriever_type, position, quota) AS (VALUES ('bm25', 1, 3), ('dense', 2, 4))
SELECT query_id, doc_id, retriever_type, score, r AS rank FROM (SELECT query_id, doc_id, retriever_type, score,
row_number() OVER (PARTITION BY query_id ORDER BY position, rank)::INTEGER AS r FROM both_ JOIN p USING (retriever_type) WHERE rank <= quota) WHERE r <= 5""")
def multi_index(t: Tables) -> DataFrame:
    members = fusion.equal_weights(member_table(t, "n > 0", "n > 0"))
    bm25 = F.col("retriever_type") == "bm25"
    quotas = members.select(
        "retriever_type", F.when(bm25, 1).otherwise(2).alias("position"), F.when(bm25, 3).otherwise(4).alias("quota")
    )
    return fusion.concatenate(two_lists(t), quotas, 5)


@query("retriever_sweep", SEVEN + """ SELECT query_id, retriever_type, 5 AS top_k, 'spark-' || retriever_type || '-retriever' AS engine,
count(*) AS document_count, string_agg(doc_id::VARCHAR, ',' ORDER BY rank) AS doc_ids FROM seven WHERE rank <= 5 GROUP BY ALL""")
def retriever_sweep(t: Tables) -> DataFrame:
    """All seven retrievers over one question set."""
    records = catalog.responses(seven_lists(t), top_k=5)
    ids = F.array_join(F.transform("documents", lambda d: d["doc_id"].cast("string")), ",")
    return records.withColumn("doc_ids", ids).drop("documents")


HYDE = f"""WITH hy AS (SELECT conv_id AS query_id, text FROM conversations WHERE role = 'assistant' AND turn = 1),
{sql.buckets('a', 'query_id', sql.QUESTIONS)}, {sql.buckets('h', 'query_id', 'SELECT * FROM hy')}, {sql.buckets('d', 'doc_id', sql.CORPUS)},
mix AS (SELECT query_id, b, sum(x) AS x FROM (SELECT * FROM avec UNION ALL SELECT * FROM hvec WHERE query_id IN (SELECT query_id FROM ({sql.QUESTIONS}))) GROUP BY ALL),
mn AS (SELECT query_id, sqrt(sum(x * x)) AS len FROM mix GROUP BY ALL),
mv AS (SELECT query_id, b, x / len AS x FROM mix JOIN mn USING (query_id)) """


@query("hyde_topk", HYDE + _rank_sql(
    "SELECT query_id, doc_id, round(sum(mv.x * dvec.x), 6) AS score FROM mv JOIN dvec USING (b) GROUP BY ALL", 5))
def hyde_topk(t: Tables) -> DataFrame:
    first_answers = t.conversations.filter("role = 'assistant' AND turn = 1")
    texts = vectors(first_answers.select(F.col("conv_id").alias("query_id"), "text"), "query_id")
    mixed = dense.blend(vectors(t.questions, "query_id"), texts)
    return dense.dense(vectors(t.corpus, "doc_id"), mixed, 5)


SYNONYMS = f"""SELECT DISTINCT w AS term, lower(w) AS synonym FROM (SELECT unnest({sql.words('text')}) AS w FROM benchmark) WHERE w <> lower(w)"""


@query("expanded_bm25", f"""WITH syn AS ({SYNONYMS}),
ad AS (SELECT query_id, string_agg(DISTINCT synonym, ' ') AS added FROM (SELECT DISTINCT query_id, unnest({sql.words('text')}) AS term FROM ({sql.QUESTIONS})) JOIN syn USING (term) GROUP BY query_id),
ex AS (SELECT query_id, text || coalesce(' ' || added, '') AS text FROM ({sql.QUESTIONS}) LEFT JOIN ad USING (query_id)),
{sql.bm25('', 4, queries='SELECT * FROM ex')} SELECT * FROM hits""")
def expanded_bm25(t: Tables) -> DataFrame:
    word = t.questions.select(F.explode(words(F.col("text"))).alias("term"))
    synonyms = word.withColumn("synonym", F.lower("term")).filter("term <> synonym").distinct()
    return bm25_hits(t, 4, questions=lexical.expand_queries(t.questions, synonyms))


@query("filtered_topk", "WITH " + sql.bm25(
    "", 4, "SELECT doc_id, text FROM documents JOIN labels USING (doc_id) WHERE lang = 'en' AND quality = 1 AND toxic = 0"
) + " SELECT * FROM hits")
def filtered_topk(t: Tables) -> DataFrame:
    good = t.labels.filter("quality = 1 AND toxic = 0").select("doc_id")
    english = t.spread("documents", "doc_id", "text", "lang").filter("lang = 'en'")
    return bm25_hits(t, 4, corpus=english.join(good, "doc_id", "left_semi").select("doc_id", "text"))


ENTITY_SQL = """SELECT DISTINCT doc_id, e FROM (SELECT doc_id, unnest(list_transform({words},
lambda w: regexp_replace(w, '[.,;:!?"()]', '', 'g'))) AS e FROM {source}) WHERE regexp_matches(e, '^[A-Z][A-Za-z]{{3,}}$')"""
MENTIONS = ENTITY_SQL.format(words=sql.words("text"), source="documents")


@query("graph_neighbourhood", f"""WITH {sql.bm25('', 4)}, m AS ({MENTIONS}),
n0 AS (SELECT query_id, 'doc:' || doc_id AS id, 0 AS hop FROM hits),
n1 AS (SELECT DISTINCT query_id, 'entity:' || e AS id, 1 AS hop FROM hits JOIN m USING (doc_id)),
n2 AS (SELECT DISTINCT query_id, 'doc:' || m.doc_id AS id, 2 AS hop FROM n1 JOIN m ON n1.id = 'entity:' || m.e)
SELECT * FROM n0 UNION ALL SELECT * FROM n1 UNION ALL SELECT n2.* FROM n2 ANTI JOIN n0 USING (query_id, id)""")
def graph_neighbourhood(t: Tables) -> DataFrame:
    seeds = bm25_hits(t).select("query_id", F.concat(F.lit("doc:"), F.col("doc_id").cast("string")).alias("id"))
    edges = testset.mentions(t.corpus).select(F.col("source").alias("src"), F.col("target").alias("dst"))
    return neighbourhood(seeds, edges, hops=2)


@query("compressed_context", f"""WITH {sql.bm25('', 4)},
s AS (SELECT query_id, h.doc_id, q.text AS qt, unnest({sql.sentences('d.text')}) AS sentence, generate_subscripts({sql.sentences('d.text')}, 1) AS pos
  FROM hits h JOIN documents d USING (doc_id) JOIN ({sql.QUESTIONS}) q USING (query_id))
SELECT query_id, doc_id, count(*) AS kept, md5(string_agg(sentence, ' ' ORDER BY pos)) AS kept_print FROM s
WHERE list_has_any({sql.words('sentence')}, {sql.words('qt')}) GROUP BY ALL""")
def compressed_context(t: Tables) -> DataFrame:
    """Extractive compression: of each hit, the sentences that share a word with the question."""
    asked = t.questions.select("query_id", words(F.col("text")).alias("asked"))
    parts = bm25_hits(t).join(t.corpus, "doc_id").select(
        "query_id", "doc_id", F.posexplode(sentences(F.col("text"))).alias("pos", "sentence")
    )
    kept = parts.join(asked, "query_id").filter(F.arrays_overlap(words(F.col("sentence")), F.col("asked")))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "sentence")))
    return kept.groupBy("query_id", "doc_id").agg(
        F.count(F.lit(1)).alias("kept"),
        F.md5(F.concat_ws(" ", F.transform(ordered, lambda s: s["sentence"]))).alias("kept_print"),
    )


def _greedy_sql(k: int) -> str:
    """The greedy choice, one step per rank, over ``hits`` (the fetch) and ``dvec`` (the documents' vectors)."""
    steps = ["""sim AS (SELECT x.query_id, x.doc_id AS a, y.doc_id AS b, coalesce(sum(u.x * v.x), 0) AS s FROM hits x JOIN hits y USING (query_id)
LEFT JOIN dvec u ON u.doc_id = x.doc_id LEFT JOIN dvec v ON v.doc_id = y.doc_id AND v.b = u.b GROUP BY ALL),
p0 AS (SELECT query_id, doc_id, score, 0 AS rank FROM hits WHERE false)"""]
    for n in range(1, k + 1):
        steps.append(f"""p{n} AS (SELECT * FROM p{n - 1} UNION ALL SELECT query_id, doc_id, score, {n} FROM (
SELECT h.query_id, h.doc_id, h.score, row_number() OVER (PARTITION BY h.query_id ORDER BY round(0.5 * h.score - 0.5 * coalesce(c.closest, 0), 9) DESC, h.score DESC, h.doc_id) AS r
FROM hits h LEFT JOIN (SELECT sim.query_id, sim.a, max(s) AS closest FROM sim JOIN p{n - 1} q ON q.query_id = sim.query_id AND q.doc_id = sim.b GROUP BY ALL) c
ON c.query_id = h.query_id AND c.a = h.doc_id WHERE NOT EXISTS (SELECT 1 FROM p{n - 1} q WHERE q.query_id = h.query_id AND q.doc_id = h.doc_id)) WHERE r = 1)""")
    return ", ".join(steps)


@query("mmr_topk", f"WITH {sql.dense('', 15)}, {_greedy_sql(5)} SELECT query_id, doc_id, score, rank::INTEGER AS rank FROM p5")
def mmr_topk(t: Tables) -> DataFrame:
    corpus = vectors(t.corpus, "doc_id")
    fetched = dense.dense(corpus, vectors(t.questions, "query_id"), 15).drop("rank")
    return dense.diversify(fetched.join(corpus, "doc_id"), k=5, balance=0.5)


NAMED = """CASE event_type WHEN 'click' THEN 'bm25' WHEN 'view' THEN 'dense' WHEN 'purchase' THEN 'hybrid'
WHEN 'signup' THEN 'semantic' ELSE 'legacy' END"""


def requests(t: Tables) -> DataFrame:
    """The event log read as a request log: one retriever name per event type, one of them unknown."""
    return t.events.withColumn("retriever_type", F.expr(NAMED))


@query("alias_resolution", f"""SELECT retriever_type, CASE retriever_type WHEN 'bm25' THEN 'bm25_retriever' WHEN 'dense' THEN 'semantic_retriever'
WHEN 'hybrid' THEN 'ensemble_retriever' WHEN 'semantic' THEN 'semantic_retriever' END AS engine,
retriever_type <> 'legacy' AS accepted, count(*) AS n FROM (SELECT {NAMED} AS retriever_type FROM events) GROUP BY ALL""")
def alias_resolution(t: Tables) -> DataFrame:
    resolved = catalog.resolve(requests(t))
    return resolved.groupBy("retriever_type", "engine", "accepted").agg(F.count(F.lit(1)).alias("n"))


@query("retriever_characteristics", f"""SELECT retriever_type, count(*) AS n, max(CASE retriever_type
WHEN 'bm25' THEN 'Traditional lexical search using BM25 algorithm' WHEN 'dense' THEN 'Neural embedding-based semantic search using dense vectors'
WHEN 'hybrid' THEN 'Combined approach using both lexical and semantic matching'
WHEN 'semantic' THEN 'Pure semantic search optimized for meaning rather than keywords' END) AS description
FROM (SELECT {NAMED} AS retriever_type FROM events) GROUP BY ALL""")
def retriever_characteristics(t: Tables) -> DataFrame:
    counted = requests(t).groupBy("retriever_type").agg(F.count(F.lit(1)).alias("n"))
    return catalog.with_characteristics(counted).select("retriever_type", "n", "description")


@query("hit_shaping", f"""WITH {sql.bm25('', 10)}
SELECT query_id, 'bm25' AS retriever_type, rank, doc_id::VARCHAR AS doc_id, md5(text) AS content_print,
round(CASE WHEN rank % 2 = 1 THEN score ELSE 1.0 - 0.05 * (rank - 1) END, 6) AS score, lang FROM hits JOIN documents USING (doc_id) WHERE rank <= 5""")
def hit_shaping(t: Tables) -> DataFrame:
    """Raw results with a score key on every other document; the others take the position score."""
    texts = t.spread("documents", "doc_id", "text", "lang")
    position = F.col("rank") - 1
    meta = F.create_map(
        F.lit("id"), F.col("doc_id").cast("string"), F.lit("lang"), F.col("lang"),
        F.lit("similarity"), F.when(position % 2 == 0, F.col("score").cast("string")),
    )
    raw = bm25_hits(t, 10).join(texts, "doc_id").select(
        "query_id", F.lit("bm25").alias("retriever_type"), position.alias("position"),
        F.col("text").alias("page_content"), meta.alias("metadata"),
    )
    shaped = shaping.shape_hits(raw, top_k=5)
    return shaped.select(
        "query_id", "retriever_type", "rank", "doc_id", F.md5("content").alias("content_print"),
        F.round("score", 6).alias("score"), F.try_element_at("metadata", F.lit("lang")).alias("lang"),
    )
