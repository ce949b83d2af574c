"""Evaluation queries: relevance, aggregates, judged metrics, statistics and reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.functions.text import sentences, words
from gleaner.operators import dense as dense_ops
from gleaner.operators import evaluation, judged, reports, shaping, stats, testset
from gleaner.operators.matching import containment
from gleaner.plans import sql
from gleaner.plans.registry import Tables, query
from gleaner.session import materialise
from gleaner.plans.retrieval import (
    CHILDREN, ENTITY_SQL, LABEL_SQL, RETRIEVERS, SEVEN, _rank_sql, bm25_hits, child_hits, label_queries, seven_lists, stored_vectors,
    two_lists, vectors,
)


def qrels(t: Tables) -> DataFrame:
    return containment(t.corpus, t.questions)


METRICS_SQL = """
rel AS ({qrels}), nr AS (SELECT query_id, count(DISTINCT doc_id) AS n_relevant FROM rel GROUP BY query_id),
f AS (SELECT query_id, count(*) AS n_retrieved, count(r.doc_id) AS n_hits, coalesce(1.0 / min(CASE WHEN r.doc_id IS NOT NULL THEN rank END), 0) AS mrr,
  coalesce(sum(CASE WHEN r.doc_id IS NOT NULL THEN 1 / log2(rank + 1) END), 0) AS dcg
  FROM {hits} h LEFT JOIN (SELECT DISTINCT * FROM rel) r USING (query_id, doc_id) GROUP BY query_id),
m AS (SELECT query_id, coalesce(n_retrieved, 0) AS n_retrieved, coalesce(n_relevant, 0) AS n_relevant, coalesce(n_hits, 0) AS n_hits,
  coalesce(n_hits / n_retrieved, 0) AS p, coalesce(n_hits / n_relevant, 0) AS r, coalesce(mrr, 0) AS mrr,
  coalesce(dcg / list_sum(list_transform(range(1, least(n_relevant, n_retrieved) + 1), lambda i: 1 / log2(i + 1))), 0) AS ndcg
  FROM f {join} JOIN nr USING (query_id)),
per AS (SELECT query_id, n_retrieved, n_relevant, n_hits, round(p, 6) AS precision, round(r, 6) AS recall,
  round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1, round(mrr, 6) AS mrr, round(ndcg, 6) AS ndcg FROM m)"""


def metrics_sql(qrels_: str = sql.QRELS, hits: str = "hits", join: str = "") -> str:
    return METRICS_SQL.format(qrels=qrels_, hits=hits, join=join)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded: summation order differs between engines."""
    return df.select(
        *[F.round(f.name, digits).alias(f.name) if f.dataType.typeName() == "double" else f.name for f in df.schema.fields]
    )


@query("containment_qrels", sql.QRELS)
def containment_qrels(t: Tables) -> DataFrame:
    return qrels(t)


@query("relevance_by_query", f"WITH {sql.bm25('', 4)}, {metrics_sql()} SELECT * FROM per")
def relevance_by_query(t: Tables) -> DataFrame:
    return rounded(evaluation.relevance_by_query(bm25_hits(t), qrels(t)))


MEANS = ", ".join(f"round(avg({m}), 4) AS {m}" for m in evaluation.RELEVANCE_METRICS)


@query("relevance_summary", f"WITH {sql.bm25('', 4)}, {metrics_sql()} SELECT {MEANS}, count(*) AS n_queries FROM per")
def relevance_summary(t: Tables) -> DataFrame:
    per = rounded(evaluation.relevance_by_query(bm25_hits(t), qrels(t)))
    return rounded(evaluation.macro_means(per), 4)


@query("relevance_zero_filled", f"WITH {sql.bm25('', 4)}, {metrics_sql(join='FULL')} SELECT * FROM per")
def relevance_zero_filled(t: Tables) -> DataFrame:
    return rounded(evaluation.relevance_by_query(bm25_hits(t), qrels(t), on_empty="zero"))


@query("relevance_subset", f"WITH {sql.bm25('', 4)}, {metrics_sql()} SELECT round(avg(recall), 4) AS recall, round(avg(mrr), 4) AS mrr, count(*) AS n_queries FROM per")
def relevance_subset(t: Tables) -> DataFrame:
    per = rounded(evaluation.relevance_by_query(bm25_hits(t), qrels(t)))
    return rounded(evaluation.macro_means(per, ["recall", "mrr"]), 4)


@query("relevance_repeated_hits", f"""WITH ch AS ({CHILDREN}), {sql.dense('', 10, 'SELECT doc_id, text FROM ch')},
up AS (SELECT query_id, parent_id AS doc_id, rank FROM hits JOIN ch USING (doc_id)), {metrics_sql(hits='up')} SELECT * FROM per""")
def relevance_repeated_hits(t: Tables) -> DataFrame:
    """Chunk hits scored at document level, so a document can be hit several times."""
    parent = F.substring_index("doc_id", "#", 1).cast("bigint")
    up = child_hits(t).select("query_id", parent.alias("doc_id"), "rank")
    return rounded(evaluation.relevance_by_query(up, qrels(t), dedupe=False))


@query("vector_relevance", f"""WITH {LABEL_SQL},
hits AS ({_rank_sql("SELECT query_id, doc_id, round(list_dot_product(q, v), 6) AS score FROM cent, unit", 10)}),
{metrics_sql('SELECT label AS query_id, vec_id AS doc_id FROM embeddings')} SELECT * FROM per""")
def vector_relevance(t: Tables) -> DataFrame:
    hits = dense_ops.dense(stored_vectors(t), label_queries(t), 10)
    same_label = t.embeddings.select(F.col("label").alias("query_id"), F.col("vec_id").alias("doc_id"))
    return rounded(evaluation.relevance_by_query(hits, same_label))


@query("sweep_relevance", f"""WITH {sql.bm25('l', 10)}, {sql.dense('v', 10)}, rel AS ({sql.QRELS}),
both_ AS (SELECT 'bm25' AS retriever_type, * FROM lhits UNION ALL SELECT 'dense', * FROM vhits),
nr AS (SELECT query_id, count(*) AS n FROM rel GROUP BY query_id),
per AS (SELECT retriever_type, query_id, count(r.doc_id) / count(*) AS p, count(r.doc_id) / max(n) AS rc
  FROM both_ LEFT JOIN rel r USING (query_id, doc_id) JOIN nr USING (query_id) GROUP BY ALL)
SELECT retriever_type, round(avg(p), 4) AS precision, round(avg(rc), 4) AS recall, count(*) AS n_queries FROM per GROUP BY retriever_type""")
def sweep_relevance(t: Tables) -> DataFrame:
    per = evaluation.relevance_by_query(two_lists(t), qrels(t), ["retriever_type", "query_id"])
    return rounded(evaluation.macro_means(per, ["precision", "recall"], ["retriever_type"]), 4)


@query("run_relevance_zero_filled", f"""WITH {sql.bm25('l', 10)}, {sql.dense('v', 10)}, rel AS ({sql.QRELS}),
both_ AS (SELECT 'bm25' AS retriever_type, * FROM lhits UNION ALL SELECT 'dense', * FROM vhits WHERE query_id % 3 <> 0),
nr AS (SELECT query_id, count(*) AS n FROM rel GROUP BY query_id),
f AS (SELECT retriever_type, query_id, count(*) AS c, count(r.doc_id) AS h FROM both_ LEFT JOIN rel r USING (query_id, doc_id) GROUP BY ALL),
grid AS (SELECT retriever_type, query_id FROM f UNION SELECT retriever_type, query_id FROM (SELECT DISTINCT retriever_type FROM f), nr)
SELECT retriever_type, query_id, coalesce(c, 0) AS n_retrieved, coalesce(h, 0) AS n_hits, round(coalesce(h / n, 0), 6) AS recall
FROM grid LEFT JOIN f USING (retriever_type, query_id) LEFT JOIN nr USING (query_id)""")
def run_relevance_zero_filled(t: Tables) -> DataFrame:
    """Two runs, one without hits for every third question: each run is scored on every question."""
    lists = two_lists(t).filter("retriever_type = 'bm25' OR query_id % 3 <> 0")
    per = evaluation.relevance_by_query(lists, qrels(t), ["retriever_type", "query_id"], on_empty="zero")
    return rounded(per.select("retriever_type", "query_id", "n_retrieved", "n_hits", "recall"))


@query("context_precision", f"""WITH {sql.bm25('', 10)}, rel AS ({sql.QRELS}),
j AS (SELECT query_id, rank, (r.doc_id IS NOT NULL)::INTEGER AS rel FROM hits LEFT JOIN rel r USING (query_id, doc_id)),
w AS (SELECT *, avg(rel) OVER (PARTITION BY query_id ORDER BY rank) AS pa FROM j)
SELECT query_id, round(avg(rel), 6) AS precision, round(coalesce(avg(CASE WHEN rel = 1 THEN pa END), 0), 6) AS weighted_precision FROM w GROUP BY query_id""")
def context_precision(t: Tables) -> DataFrame:
    return rounded(evaluation.context_precision(bm25_hits(t, 10), qrels(t)))


@query("context_efficiency", f"""WITH {sql.bm25('', 4)}, rel AS ({sql.QRELS}),
j AS (SELECT query_id, len({sql.words('text')}) AS n, r.doc_id AS rd FROM hits JOIN documents USING (doc_id) LEFT JOIN rel r USING (query_id, doc_id))
SELECT query_id, coalesce(sum(CASE WHEN rd IS NOT NULL THEN n END), 0)::BIGINT AS useful_words, sum(n)::BIGINT AS all_words,
round(coalesce(sum(CASE WHEN rd IS NOT NULL THEN n END), 0) / sum(n), 6) AS efficiency FROM j GROUP BY query_id""")
def context_efficiency(t: Tables) -> DataFrame:
    hits = bm25_hits(t).join(t.corpus.withColumnRenamed("text", "content"), "doc_id")
    return rounded(evaluation.context_efficiency(hits, qrels(t)))


TERMS_SQL = f"""SELECT DISTINCT left(term, 1) AS category, term FROM (
SELECT w AS term FROM (SELECT unnest({sql.words('text')}) AS w FROM benchmark) WHERE length(w) >= 8
UNION ALL SELECT unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM (SELECT {sql.words('text')} AS w FROM benchmark))"""


@query("term_coverage", f"""WITH terms AS ({TERMS_SQL}), n AS (SELECT category, count(*) AS n_terms FROM terms GROUP BY category),
tok AS (SELECT source, lang, {sql.words('text')} AS w FROM documents),
seen AS (SELECT DISTINCT source, lang, term FROM (SELECT source, lang, unnest(w) AS term FROM tok
  UNION ALL SELECT source, lang, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM tok)),
m AS (SELECT category, source, lang, count(*) AS k FROM seen JOIN terms USING (term) GROUP BY ALL),
grid AS (SELECT * FROM (SELECT DISTINCT source, lang FROM documents), n)
SELECT category, source, lang, coalesce(k, 0) AS n_mentioned, n_terms, round(coalesce(k, 0) / n_terms, 6) AS coverage
FROM grid LEFT JOIN m USING (category, source, lang)""")
def term_coverage(t: Tables) -> DataFrame:
    """Long words and all pairs of neighbouring words of the passages as terms."""
    tokens = words(F.col("text"))
    single = t.questions.select(F.explode(tokens).alias("term")).filter(F.length("term") >= 8)
    pairs = t.questions.select(F.explode(evaluation.word_runs(tokens, [2])).alias("term"))
    terms = single.unionByName(pairs).select(F.substring("term", 1, 1).alias("category"), "term").distinct()
    texts = t.spread("documents", "source", "lang", "text").select("source", "lang", words(F.col("text")).alias("tokens"))
    return rounded(evaluation.term_coverage(texts, terms, ["source", "lang"]))


# The event log read as a retrieval log: one row per question, its payload number giving the volume.
LOG_SQL = """log AS (SELECT event_id, event_type AS retriever_type, value AS latency_ms, k,
  CASE WHEN k < 10 THEN 'failed' ELSE 'success' END AS status, k % 5 + 1 AS document_count, (k % 5 + 1) * k / 100 AS score_sum, 40 * (k % 5 + 1) AS token_count
  FROM (SELECT *, (props::JSON->>'k')::INTEGER AS k FROM events))"""


def request_log(t: Tables) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    docs = k % 5 + 1
    log = t.events.select(
        "event_id", "ts", F.col("event_type").alias("retriever_type"), F.col("value").alias("latency_ms"),
        F.concat(F.lit("question "), F.col("event_id").cast("string")).alias("question"),
        docs.alias("document_count"), (docs * k / 100).alias("score_sum"), (docs * 40).alias("token_count"),
        (k < 10).alias("request_failed"),
    )
    return evaluation.mark_outcome(log, failed=F.col("request_failed"))


AGG_SQL = f"""WITH {LOG_SQL}, agg AS (SELECT retriever_type, count(*) AS total_questions, count(*) FILTER (status = 'success') AS successful,
count(*) FILTER (status = 'failed') AS failed, round(100.0 * count(*) FILTER (status = 'success') / count(*), 4) AS success_rate,
round(avg(latency_ms) FILTER (status = 'success'), 4) AS avg_latency_ms, round(avg(document_count) FILTER (status = 'success'), 4) AS avg_document_count,
round(sum(score_sum) FILTER (status = 'success') / sum(document_count) FILTER (status = 'success'), 4) AS avg_document_score,
round(avg(token_count) FILTER (status = 'success'), 4) AS avg_token_count FROM log GROUP BY retriever_type)"""

AGG_METRICS = ["success_rate", "avg_latency_ms", "avg_document_count", "avg_document_score", "avg_token_count"]


def aggregates(t: Tables) -> DataFrame:
    return rounded(evaluation.retriever_aggregates(request_log(t)), 4)


@query("retriever_aggregates", AGG_SQL + " SELECT * FROM agg")
def retriever_aggregates(t: Tables) -> DataFrame:
    return aggregates(t)


@query("detail_cap", f"""WITH {LOG_SQL} SELECT event_id, retriever_type, p AS place, n > 50 AS truncated FROM (SELECT event_id, retriever_type,
row_number() OVER (PARTITION BY retriever_type ORDER BY event_id)::INTEGER AS p, count(*) OVER (PARTITION BY retriever_type) AS n FROM log) WHERE p <= 50""")
def detail_cap(t: Tables) -> DataFrame:
    capped = evaluation.cap_details(request_log(t), ["event_id"], limit=50)
    return capped.select("event_id", "retriever_type", "place", "truncated")


@query("question_details", f"""WITH {sql.bm25('', 4)},
f AS (SELECT query_id, count(*) AS n, avg(score) AS a, sum(score) AS s, sum(len({sql.words('text')})) AS w FROM hits JOIN documents USING (doc_id) GROUP BY query_id)
SELECT item_id AS query_id, coalesce(n, 0) AS document_count, round(coalesce(a, 0), 4) AS avg_score, round(coalesce(s, 0), 4) AS score_sum,
coalesce(w, 0)::BIGINT AS token_count FROM benchmark LEFT JOIN f ON item_id = query_id""")
def question_details(t: Tables) -> DataFrame:
    hits = bm25_hits(t).join(t.corpus.withColumnRenamed("text", "content"), "doc_id")
    details = evaluation.question_details(t.questions, hits, ["query_id"])
    return details.withColumns({"avg_score": F.round("avg_score", 4), "score_sum": F.round("score_sum", 4)})


@query("question_outcomes", """SELECT role, CASE WHEN trim(coalesce(text, '')) = '' THEN 'failed' ELSE 'success' END AS status, count(*) AS n
FROM conversations GROUP BY ALL""")
def question_outcomes(t: Tables) -> DataFrame:
    return evaluation.mark_outcome(t.conversations, "text").groupBy("role", "status").agg(F.count(F.lit(1)).alias("n"))


TALL_SQL = AGG_SQL + ", tall AS (SELECT retriever_type, metric, value FROM agg UNPIVOT (value FOR metric IN (" + ", ".join(AGG_METRICS) + ")))"


def tall_metrics(t: Tables) -> DataFrame:
    return reports.tall(aggregates(t), ["retriever_type"], AGG_METRICS)


@query("metrics_tall", TALL_SQL + " SELECT retriever_type, metric, value, format('{:.4f}', value) AS shown FROM tall")
def metrics_tall(t: Tables) -> DataFrame:
    return tall_metrics(t)


@query("best_per_metric", TALL_SQL + """ SELECT metric, retriever_type, value FROM (SELECT *, row_number() OVER (PARTITION BY metric
ORDER BY CASE WHEN metric = 'avg_latency_ms' THEN value ELSE -value END, retriever_type) AS r FROM tall) WHERE r = 1""")
def best_per_metric(t: Tables) -> DataFrame:
    return reports.best_per_metric(tall_metrics(t))


@query("overall_score", TALL_SQL + " SELECT retriever_type, round(avg(value), 4) AS overall, count(*) AS n_metrics FROM tall GROUP BY retriever_type")
def overall_score(t: Tables) -> DataFrame:
    return rounded(reports.overall(tall_metrics(t)), 4)


@query("overall_directed", TALL_SQL + """ SELECT retriever_type, round(avg(CASE WHEN metric = 'avg_latency_ms' THEN -value ELSE value END), 4) AS overall,
count(*) AS n_metrics FROM tall GROUP BY retriever_type""")
def overall_directed(t: Tables) -> DataFrame:
    return rounded(reports.overall(tall_metrics(t), directed=True), 4)


RUN_METRICS = SEVEN + f""", rel AS (SELECT DISTINCT * FROM ({sql.QRELS})), nr AS (SELECT query_id, count(*) AS n_relevant FROM rel GROUP BY query_id),
facts AS (SELECT retriever_type, query_id, count(*) AS n, count(r.doc_id) AS h, coalesce(1.0 / min(CASE WHEN r.doc_id IS NOT NULL THEN rank END), 0) AS mrr,
  coalesce(sum(CASE WHEN r.doc_id IS NOT NULL THEN 1 / log2(rank + 1) END), 0) AS dcg FROM seven LEFT JOIN rel r USING (query_id, doc_id) GROUP BY ALL),
ratios AS (SELECT retriever_type, query_id, h / n AS precision, h / n_relevant AS recall, mrr,
  dcg / list_sum(list_transform(range(1, least(n_relevant, n) + 1), lambda i: 1 / log2(i + 1))) AS ndcg FROM facts JOIN nr USING (query_id)),
means AS (SELECT retriever_type, round(avg(precision), 4) AS precision, round(avg(recall), 4) AS recall,
  round(avg(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END), 4) AS f1,
  round(avg(mrr), 4) AS mrr, round(avg(ndcg), 4) AS ndcg FROM ratios GROUP BY retriever_type),
runs AS (SELECT ['{"', '".join(RETRIEVERS)}'][event_id % {len(RETRIEVERS)} + 1] AS retriever_type, value AS latency_ms, (props::JSON->>'k')::INTEGER AS k FROM events),
speed AS (SELECT retriever_type, round(100.0 * count(*) FILTER (k >= 10) / count(*), 4) AS success_rate,
  round(avg(latency_ms) FILTER (k >= 10), 4) AS avg_latency_ms FROM runs GROUP BY retriever_type)"""


def run_means(t: Tables) -> DataFrame:
    """Relevance of each registered retriever over all questions, and the success and latency of its requests.

    The event log stands in for the request log: requests are dealt to the retrievers in turn.
    """
    per = evaluation.relevance_by_query(seven_lists(t), qrels(t), ["retriever_type", "query_id"])
    means = evaluation.macro_means(per, by=["retriever_type"]).drop("n_queries")
    turn = F.get(F.array(*map(F.lit, RETRIEVERS)), (F.col("event_id") % len(RETRIEVERS)).cast("int"))
    speed = evaluation.retriever_aggregates(request_log(t).withColumn("retriever_type", turn))
    return rounded(means.join(speed.select("retriever_type", "success_rate", "avg_latency_ms"), "retriever_type", "full"), 4)


JUDGED = ["context_recall", "faithfulness", "factual_correctness", "answer_relevancy", "entity_recall", "noise_sensitivity"]

JUDGED_SQL = f""", rt AS (SELECT unnest(['{"', '".join(RETRIEVERS)}']) AS retriever_type),
ctx AS (SELECT retriever_type, query_id, rank, text FROM seven JOIN documents USING (doc_id)),
ask AS (SELECT retriever_type, query_id, text FROM ({sql.QUESTIONS}), rt),
want AS (SELECT retriever_type, query_id, unnest({sql.sentences('text')}) AS claim, generate_subscripts({sql.sentences('text')}, 1) AS no FROM ask),
said AS (SELECT retriever_type, query_id, unnest({sql.sentences('text')}) AS claim, generate_subscripts({sql.sentences('text')}, 1) AS no FROM ctx WHERE rank = 1),
j1 AS (SELECT retriever_type, query_id, avg(ok::INTEGER) AS x FROM (SELECT w.retriever_type, w.query_id, no, bool_or(coalesce(contains(c.text, claim), false)) AS ok
  FROM want w LEFT JOIN ctx c USING (retriever_type, query_id) GROUP BY ALL) GROUP BY ALL),
verdict AS (SELECT s.retriever_type, s.query_id, no, bool_or(coalesce(contains(c.text, claim), false)) AS ok, bool_or(contains(a.text, claim)) AS correct
  FROM said s LEFT JOIN (SELECT * FROM ctx WHERE rank > 1) c USING (retriever_type, query_id) JOIN ask a USING (retriever_type, query_id) GROUP BY ALL),
j2 AS (SELECT retriever_type, query_id, avg(ok::INTEGER) AS x FROM verdict GROUP BY ALL),
j3 AS (SELECT retriever_type, query_id, 2.0 * count(*) FILTER (a AND b) / (count(*) + count(*) FILTER (a AND b)) AS x FROM (
  SELECT retriever_type, query_id, claim, bool_or(own) AS a, bool_or(NOT own) AS b FROM (
    SELECT retriever_type, query_id, claim, true AS own FROM said UNION ALL SELECT retriever_type, query_id, claim, false FROM want) GROUP BY ALL) GROUP BY ALL),
{sql.buckets('jq', 'query_id', sql.QUESTIONS)}, {sql.buckets('jr', 'id', "SELECT retriever_type || '|' || query_id AS id, text FROM ctx WHERE rank = 1")},
j4 AS (SELECT retriever_type, c.query_id, coalesce(sum(q.x * r.x), 0) AS x FROM ctx c LEFT JOIN jqvec q USING (query_id)
  LEFT JOIN jrvec r ON r.id = retriever_type || '|' || c.query_id AND r.b = q.b WHERE rank = 1 GROUP BY ALL),
named AS ({ENTITY_SQL.format(words=sql.words('text'), source="(SELECT item_id AS doc_id, text FROM benchmark)")}),
held AS ({ENTITY_SQL.format(words=sql.words('text'), source="(SELECT retriever_type || '|' || query_id AS doc_id, text FROM ctx)")}),
j5 AS (SELECT retriever_type, n.doc_id AS query_id, count(h.e) / count(*) AS x FROM named n CROSS JOIN rt LEFT JOIN held h ON h.doc_id = retriever_type || '|' || n.doc_id AND h.e = n.e GROUP BY ALL),
j6 AS (SELECT retriever_type, query_id, count(*) FILTER (ok AND NOT correct) / count(*) AS x FROM verdict GROUP BY ALL),
judged AS (""" + " UNION ALL ".join(
    f"SELECT retriever_type, '{name}' AS metric, round(avg(x), 4) AS value FROM j{i} GROUP BY retriever_type" for i, name in enumerate(JUDGED, 1)
) + ")"


def judged_by_retriever(t: Tables) -> DataFrame:
    """``(retriever_type, metric, value)``: the six judged metrics of each retriever, its best hit taken as the response."""
    keys = ["retriever_type", "query_id"]
    every = F.explode(F.array(*map(F.lit, RETRIEVERS))).alias("retriever_type")
    texts = materialise(seven_lists(t).join(t.corpus, "doc_id").select(*keys, "rank", "text"), "contexts")
    asked = t.questions.select(every, "query_id", "text")
    best, others = texts.filter("rank = 1"), texts.filter("rank > 1")
    want, said = judged.claims_of(asked, keys, "text"), judged.claims_of(best, keys, "text")
    support = lambda claims, contexts: judged.lexical_support(claims, contexts, keys, "text")
    backed = materialise(support(said, others), "backed")
    right = support(said, asked).withColumnRenamed("supported", "correct")
    noisy = backed.withColumnRenamed("supported", "attributable").join(right, [*keys, "claim_no"])
    embedded = lambda rows: dense_ops.embed(rows, hashing="md5").select(*keys, "vector")
    held = texts.groupBy(*keys).agg(F.flatten(F.collect_set(testset.default_entities(F.col("text")))).alias("held"))
    named = asked.select(*keys, testset.default_entities(F.col("text")).alias("named")).join(held, keys, "left")
    named = named.withColumn("held", F.coalesce("held", F.array().cast("array<string>")))
    scores = {
        "context_recall": judged.supported_share(support(want, texts), keys, "context_recall"),
        "faithfulness": judged.supported_share(backed, keys, "faithfulness"),
        "factual_correctness": judged.factual_correctness(judged.claim_kinds(said, want, keys), keys),
        "answer_relevancy": judged.response_relevancy(embedded(asked), embedded(best), keys),
        "entity_recall": named.select(*keys, judged.entity_recall(named, "named", "held").alias("entity_recall")),
        "noise_sensitivity": judged.noise_sensitivity(noisy, keys),
    }
    rows = [
        reports.tall(rounded(judged.metric_means(frame, [name], ["retriever_type"]), 4), ["retriever_type"], ["judged_" + name])
        for name, frame in scores.items()
    ]
    return reduce(DataFrame.unionByName, rows)


@query("comparison_wide", RUN_METRICS + JUDGED_SQL + """ SELECT retriever_type, success_rate, avg_latency_ms, precision, recall, f1, mrr, ndcg, """ + ", ".join(
    f"coalesce(max(value) FILTER (metric = '{name}'), 0) AS judged_{name}" for name in JUDGED
) + " FROM means JOIN speed USING (retriever_type) LEFT JOIN judged USING (retriever_type) GROUP BY ALL")
def comparison_wide(t: Tables) -> DataFrame:
    """All registered retrievers with request, relevance and judged metrics."""
    measured = reports.tall(run_means(t), ["retriever_type"], reports.COMPARISON_METRICS)
    return reports.wide(materialise(measured.unionByName(judged_by_retriever(t)), "measured"))


@query("chart_series", RUN_METRICS + """, tall AS (SELECT retriever_type, metric, value FROM means JOIN speed USING (retriever_type)
  UNPIVOT (value FOR metric IN (precision, recall, f1, mrr, ndcg, avg_latency_ms)))
SELECT 'relevance' AS chart, metric AS series, retriever_type AS x, value AS y FROM tall WHERE metric IN ('precision', 'recall', 'f1')
UNION ALL SELECT 'latency', metric, retriever_type, value FROM tall WHERE metric = 'avg_latency_ms'
UNION ALL SELECT 'radar', retriever_type, metric, value FROM tall WHERE metric <> 'avg_latency_ms'""")
def chart_series(t: Tables) -> DataFrame:
    return reports.chart_series(reports.tall(run_means(t), ["retriever_type"], reports.COMPARISON_METRICS))


@query("run_summary", f"""WITH {LOG_SQL} SELECT string_agg(DISTINCT retriever_type, ',' ORDER BY retriever_type) AS retrievers,
count(DISTINCT event_id) AS dataset_size, 'run-1' AS run_id, TIMESTAMP '2024-02-01 00:00:00' AS run_ts, '0.1.0' AS version_gleaner FROM log""")
def run_summary(t: Tables) -> DataFrame:
    log = request_log(t).withColumnRenamed("event_id", "question_id")
    return reports.run_summary(log, "run-1", F.lit("2024-02-01 00:00:00").cast("timestamp"), {"gleaner": "0.1.0"})


@query("run_metadata", TALL_SQL + " SELECT retriever_type, metric, value, 'run-1' AS run_id, TIMESTAMP '2024-02-01 00:00:00' AS run_ts FROM tall")
def run_metadata(t: Tables) -> DataFrame:
    """Metric rows stamped with the run they belong to."""
    stamp = {"run_id": F.lit("run-1"), "run_ts": F.lit("2024-02-01 00:00:00").cast("timestamp")}
    return tall_metrics(t).drop("shown").withColumns(stamp)


def _period(t: Tables, condition: str) -> DataFrame:
    log = request_log(t).filter(condition)
    return reports.tall(rounded(evaluation.retriever_aggregates(log), 4), ["retriever_type"], AGG_METRICS)


@query("metric_delta", AGG_SQL.replace("FROM log GROUP BY retriever_type", "FROM log GROUP BY retriever_type, late").replace(
    "agg AS (SELECT retriever_type", "agg AS (SELECT retriever_type, late").replace("SELECT event_id,", "SELECT event_id, ts >= TIMESTAMP '2024-01-16' AS late,")
    + ", tall AS (SELECT retriever_type, late, metric, value FROM agg UNPIVOT (value FOR metric IN (" + ", ".join(AGG_METRICS) + ")))"
    + """ SELECT retriever_type, metric, a.value AS baseline, b.value AS current, round(b.value - a.value, 4) AS delta,
    CASE WHEN a.value IS NULL THEN 'baseline' WHEN b.value IS NULL THEN 'current' END AS missing_in
    FROM (SELECT * FROM tall WHERE NOT late) a FULL JOIN (SELECT * FROM tall WHERE late) b USING (retriever_type, metric)""")
def metric_delta(t: Tables) -> DataFrame:
    """Change between the first and the second half of the month, per retriever and metric."""
    return evaluation.metric_delta(_period(t, "ts < '2024-01-16'"), _period(t, "ts >= '2024-01-16'"), ["retriever_type"])


def samples(t: Tables) -> DataFrame:
    """Evaluation samples: the question, its hits' texts, and the first hit as a stand-in response."""
    hits = bm25_hits(t).join(t.corpus.withColumnRenamed("text", "content"), "doc_id")
    hits = hits.select(F.col("query_id").alias("question_id"), "rank", "content")
    asked = t.questions.select(F.col("query_id").alias("question_id"), F.col("text").alias("question"))
    return shaping.evaluation_samples(hits, asked)


SAMPLES_SQL = f"""WITH {sql.bm25('', 4)}, sam AS (SELECT query_id AS question_id, q.text AS user_input, list(d.text ORDER BY rank) AS ctx
FROM hits JOIN documents d USING (doc_id) JOIN ({sql.QUESTIONS}) q USING (query_id) GROUP BY ALL)"""


@query("evaluation_samples", SAMPLES_SQL + " SELECT question_id, user_input, len(ctx) AS n_contexts, md5(array_to_string(ctx, '|')) AS contexts_print FROM sam")
def evaluation_samples(t: Tables) -> DataFrame:
    return samples(t).select(
        "question_id", "user_input", F.size("retrieved_contexts").cast("bigint").alias("n_contexts"),
        F.md5(F.concat_ws("|", "retrieved_contexts")).alias("contexts_print"),
    )


@query("applicable_metrics", SAMPLES_SQL + """ SELECT bool_or(trim(ctx[1]) <> '') AS has_responses, bool_or(trim(ctx[1]) <> '') AS has_references, bool_and(len(ctx) > 0) AS has_contexts,
true AS "LLMContextRecall", true AS "ContextEntityRecall", true AS "NoiseSensitivity", true AS "Faithfulness", true AS "ResponseRelevancy", true AS "FactualCorrectness" FROM sam""")
def applicable_metrics(t: Tables) -> DataFrame:
    return judged.applicable_metrics(judged.mock_responses(samples(t)))


def contexts(t: Tables) -> DataFrame:
    hits = bm25_hits(t).join(t.corpus.withColumnRenamed("text", "content"), "doc_id")
    return hits.select("query_id", "rank", "content")


@query("context_recall", f"""WITH {sql.bm25('', 4)},
cl AS (SELECT query_id, unnest({sql.sentences('text')}) AS claim, generate_subscripts({sql.sentences('text')}, 1) AS no FROM ({sql.QUESTIONS})),
v AS (SELECT query_id, no, bool_or(coalesce(contains(d.text, claim), false)) AS ok FROM cl LEFT JOIN hits USING (query_id) LEFT JOIN documents d USING (doc_id) GROUP BY ALL)
SELECT query_id, round(avg(ok::INTEGER), 6) AS context_recall FROM v GROUP BY query_id""")
def context_recall(t: Tables) -> DataFrame:
    """Share of the passage's sentences that its hits contain."""
    claims = judged.claims_of(t.questions, ["query_id"], "text")
    verdicts = judged.lexical_support(claims, contexts(t), ["query_id"])
    return rounded(judged.supported_share(verdicts, ["query_id"], "context_recall"))


@query("faithfulness", f"""WITH {sql.bm25('', 4)}, h AS (SELECT query_id, rank, text FROM hits JOIN documents USING (doc_id)),
cl AS (SELECT query_id, unnest({sql.sentences('text')}) AS claim, generate_subscripts({sql.sentences('text')}, 1) AS no FROM h WHERE rank = 1),
v AS (SELECT query_id, no, bool_or(coalesce(contains(c.text, claim), false)) AS ok FROM cl LEFT JOIN (SELECT * FROM h WHERE rank > 1) c USING (query_id) GROUP BY ALL)
SELECT query_id, round(avg(ok::INTEGER), 6) AS faithfulness FROM v GROUP BY query_id""")
def faithfulness(t: Tables) -> DataFrame:
    """The best hit taken as the response, its sentences checked against the other hits."""
    ranked = contexts(t)
    claims = judged.claims_of(ranked.filter("rank = 1"), ["query_id"], "content")
    verdicts = judged.lexical_support(claims, ranked.filter("rank > 1"), ["query_id"])
    return rounded(judged.supported_share(verdicts, ["query_id"], "faithfulness"))


@query("factual_correctness", f"""WITH {sql.bm25('', 4)},
a AS (SELECT DISTINCT query_id, unnest({sql.sentences('d.text')}) AS claim FROM hits JOIN documents d USING (doc_id) WHERE rank = 1),
b AS (SELECT DISTINCT query_id, unnest({sql.sentences('text')}) AS claim FROM ({sql.QUESTIONS})),
k AS (SELECT coalesce(a.query_id, b.query_id) AS query_id, CASE WHEN a.claim IS NULL THEN 'fn' WHEN b.claim IS NULL THEN 'fp' ELSE 'tp' END AS kind
  FROM a FULL JOIN b ON a.query_id = b.query_id AND a.claim = b.claim)
SELECT query_id, count(*) FILTER (kind = 'tp') AS tp, count(*) FILTER (kind = 'fp') AS fp, count(*) FILTER (kind = 'fn') AS fn,
round(2.0 * count(*) FILTER (kind = 'tp') / (count(*) + count(*) FILTER (kind = 'tp')), 6) AS factual_correctness FROM k GROUP BY query_id""")
def factual_correctness(t: Tables) -> DataFrame:
    response = judged.claims_of(contexts(t).filter("rank = 1"), ["query_id"], "content")
    reference = judged.claims_of(t.questions, ["query_id"], "text")
    kinds = judged.claim_kinds(response, reference, ["query_id"])
    return rounded(judged.factual_correctness(kinds, ["query_id"]))


TURNS = "SELECT conv_id, turn, text FROM conversations WHERE role = '{role}'"


@query("response_relevancy", f"""WITH {sql.buckets('u', 'id', "SELECT conv_id || '-' || turn AS id, text FROM conversations WHERE role = 'user'")},
{sql.buckets('s', 'id', "SELECT conv_id || '-' || (turn - 1) AS id, text FROM conversations WHERE role = 'assistant'")},
ids AS (SELECT conv_id || '-' || turn AS id FROM conversations WHERE role = 'user' INTERSECT SELECT conv_id || '-' || (turn - 1) FROM conversations WHERE role = 'assistant')
SELECT id, round(coalesce(sum(u.x * s.x), 0), 6) AS answer_relevancy FROM ids LEFT JOIN uvec u USING (id) LEFT JOIN svec s USING (id, b) GROUP BY id""")
def response_relevancy(t: Tables) -> DataFrame:
    """Chat turns: the question against the text of the assistant turn that follows it."""
    chat = t.spread("conversations", "conv_id", "turn", "role", "text")

    def turns(role: str, turn: str) -> DataFrame:
        keyed = chat.filter(F.col("role") == role).select(
            F.concat_ws("-", F.col("conv_id").cast("string"), F.expr(turn).cast("string")).alias("id"), "text"
        )
        return vectors(keyed, "id")

    return rounded(judged.response_relevancy(turns("user", "turn"), turns("assistant", "turn - 1"), ["id"]))


@query("entity_recall", f"""WITH {sql.bm25('', 4)},
ref AS ({ENTITY_SQL.format(words=sql.words('text'), source="(SELECT item_id AS doc_id, text FROM benchmark)")}),
con AS ({ENTITY_SQL.format(words=sql.words('text'), source="(SELECT query_id AS doc_id, d.text FROM hits JOIN documents d USING (doc_id))")})
SELECT ref.doc_id AS query_id, round(count(con.e) / count(*), 6) AS entity_recall FROM ref LEFT JOIN con ON ref.doc_id = con.doc_id AND ref.e = con.e GROUP BY ref.doc_id""")
def entity_recall(t: Tables) -> DataFrame:
    found = contexts(t).groupBy("query_id").agg(
        F.flatten(F.collect_set(testset.default_entities(F.col("content")))).alias("found")
    )
    asked = t.questions.select("query_id", testset.default_entities(F.col("text")).alias("wanted"))
    scored = asked.join(found, "query_id", "left").withColumn("found", F.coalesce("found", F.array().cast("array<string>")))
    return rounded(scored.select("query_id", judged.entity_recall(scored, "wanted", "found").alias("entity_recall")).filter("entity_recall IS NOT NULL"))


@query("noise_sensitivity", f"""WITH {sql.bm25('', 4)}, h AS (SELECT query_id, rank, text FROM hits JOIN documents USING (doc_id)),
cl AS (SELECT query_id, unnest({sql.sentences('text')}) AS claim, generate_subscripts({sql.sentences('text')}, 1) AS no FROM h WHERE rank = 1),
v AS (SELECT query_id, no, bool_or(coalesce(contains(c.text, claim), false)) AS attributable, bool_or(contains(q.text, claim)) AS correct
  FROM cl LEFT JOIN (SELECT * FROM h WHERE rank > 1) c USING (query_id) JOIN ({sql.QUESTIONS}) q USING (query_id) GROUP BY ALL)
SELECT query_id, round(count(*) FILTER (attributable AND NOT correct) / count(*), 6) AS noise_sensitivity FROM v GROUP BY query_id""")
def noise_sensitivity(t: Tables) -> DataFrame:
    """Sentences of the best hit that other hits repeat although the passage does not say them."""
    ranked = contexts(t)
    claims = judged.claims_of(ranked.filter("rank = 1"), ["query_id"], "content")
    noisy = judged.lexical_support(claims, ranked.filter("rank > 1"), ["query_id"]).withColumnRenamed("supported", "attributable")
    right = judged.lexical_support(claims, t.questions, ["query_id"], "text").withColumnRenamed("supported", "correct")
    return rounded(judged.noise_sensitivity(noisy.join(right, ["query_id", "claim_no"]), ["query_id"]))


@query("judged_means", SEVEN + JUDGED_SQL + " SELECT retriever_type, metric, value FROM judged")
def judged_means(t: Tables) -> DataFrame:
    """The six judged metrics of each retriever under their own names; availability flags are left out."""
    means = judged_by_retriever(t).drop("shown")
    flags = means.select("retriever_type").distinct().select("retriever_type", F.lit("judged_available").alias("metric"), F.lit(1.0).alias("value"))
    return judged.summary_names(means.unionByName(flags)).select("retriever_type", "metric", "value")


@query("score_extraction", TALL_SQL + """, req(metric_class, metric) AS (VALUES ('Faithfulness', 'faithfulness'), ('avg_Latency_ms', 'avg_latency_ms'))
SELECT retriever_type, metric_class, metric, coalesce(value, 0) AS value, value IS NULL AS missing
FROM (SELECT DISTINCT retriever_type FROM tall) CROSS JOIN req LEFT JOIN tall USING (retriever_type, metric)""")
def score_extraction(t: Tables) -> DataFrame:
    """Requested metric classes looked up among a run's results, one of them missing."""
    results = tall_metrics(t).drop("shown")
    wanted = results.select("retriever_type").distinct().select(
        "retriever_type", F.explode(F.array(F.lit("Faithfulness"), F.lit("avg_Latency_ms"))).alias("metric_class")
    )
    return judged.extract_scores(wanted, results, ["retriever_type"])


@query("failed_fill", TALL_SQL + """, keep AS (SELECT * FROM tall WHERE value > 50),
grid AS (SELECT retriever_type, metric FROM tall)
SELECT retriever_type, metric, coalesce(value, 0) AS value, CASE WHEN value IS NULL THEN 'evaluation failed' END AS error FROM grid LEFT JOIN keep USING (retriever_type, metric)""")
def failed_fill(t: Tables) -> DataFrame:
    results = tall_metrics(t).drop("shown")
    grid = results.select("retriever_type", "metric")
    return judged.fill_failed(grid, results.filter("value > 50"), ["retriever_type"])


@query("failure_attribution", f"""WITH {sql.bm25('', 4)}, {metrics_sql(join='FULL')},
cl AS (SELECT query_id, unnest({sql.sentences('text')}) AS claim, generate_subscripts({sql.sentences('text')}, 1) AS no FROM ({sql.QUESTIONS})),
one AS (SELECT query_id, no, coalesce(bool_or(contains(d.text, claim)), false) AS s FROM cl LEFT JOIN hits USING (query_id) LEFT JOIN documents d USING (doc_id) GROUP BY ALL),
v AS (SELECT query_id, bool_and(s) AS supported FROM one GROUP BY query_id)
SELECT CASE WHEN n_hits > 0 AND supported THEN 'ok' WHEN n_hits > 0 THEN 'unused_context' WHEN supported THEN 'ungrounded_answer' ELSE 'retriever_miss' END AS cause,
count(*) AS n_questions FROM per LEFT JOIN v USING (query_id) GROUP BY ALL""")
def failure_attribution(t: Tables) -> DataFrame:
    """The passage is the answer; it is supported if each of its sentences is found in some hit."""
    per = evaluation.relevance_by_query(bm25_hits(t), qrels(t), on_empty="zero")
    claims = t.questions.select("query_id", F.posexplode(sentences(F.col("text"))).alias("claim_no", "claim"))
    judged_claims = judged.lexical_support(claims, contexts(t), ["query_id"])
    verdicts = judged_claims.groupBy("query_id").agg(F.every("supported").alias("supported"))
    return evaluation.attribute_failures(per, verdicts)


@query("response_table", """SELECT u.conv_id || '-' || u.turn AS question_id, u.text AS question, coalesce(a.text, '') AS answer,
CASE WHEN s.text IS NULL THEN 0 ELSE 1 END AS n_contexts FROM (SELECT * FROM conversations WHERE role = 'user') u
LEFT JOIN (SELECT * FROM conversations WHERE role = 'assistant') a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
LEFT JOIN (SELECT conv_id, max(text) AS text FROM conversations WHERE role = 'system' GROUP BY conv_id) s ON s.conv_id = u.conv_id""")
def response_table(t: Tables) -> DataFrame:
    """Chat as responses: question = user turn, answer = next assistant turn, context = system text."""
    def key(turn: str):
        return F.concat_ws("-", F.col("conv_id").cast("string"), F.expr(turn).cast("string")).alias("question_id")

    chat = t.conversations
    questions = chat.filter("role = 'user'").select(key("turn"), F.col("text").alias("question"), "conv_id")
    answers = chat.filter("role = 'assistant'").select(key("turn - 1"), F.col("text").alias("answer"))
    system = chat.filter("role = 'system'").groupBy("conv_id").agg(F.max("text").alias("text"))
    given = questions.join(system, "conv_id").select("question_id", F.array("text").alias("contexts"))
    table = shaping.response_table(questions, answers, given)
    return table.select("question_id", "question", "answer", F.size("contexts").alias("n_contexts"))


@query("joined_responses", """SELECT u.conv_id || '-' || u.turn AS question_id, u.text AS user_input, a.text AS response, u.text AS reference, 1 AS n_contexts
FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant'""")
def joined_responses(t: Tables) -> DataFrame:
    chat = t.conversations
    users = chat.filter("role = 'user'").select("conv_id", "turn", "text")
    replies = chat.filter("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reply"))
    pairs = users.join(replies, ["conv_id", "turn"]).withColumn(
        "question_id", F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    )
    responses = pairs.select("question_id", F.array("text").alias("retrieved_contexts"), F.col("reply").alias("response"))
    golden = pairs.select("question_id", F.col("text").alias("user_input"), F.col("text").alias("reference"))
    joined = shaping.join_responses(responses, golden)
    return joined.withColumn("n_contexts", F.size("retrieved_contexts")).drop("retrieved_contexts")


@query("prompts", SAMPLES_SQL + """ SELECT question_id, md5('Answer based on context:' || chr(10) || array_to_string(ctx, chr(10)) || chr(10) || 'Question: ' || user_input) AS prompt_print FROM sam""")
def prompts(t: Tables) -> DataFrame:
    text = shaping.prompt(F.col("user_input"), F.col("retrieved_contexts"), "short")
    return samples(t).select("question_id", F.md5(text).alias("prompt_print"))


@query("testset_stats", """SELECT count(*) AS example_count, true AS has_context, true AS has_answers,
round(avg((context_ok)::INTEGER), 6) AS context_share, round(avg((answer <> '')::INTEGER), 6) AS answer_share FROM (
SELECT coalesce(a.text, '') AS answer, s.text IS NOT NULL AS context_ok FROM (SELECT * FROM conversations WHERE role = 'user') u
LEFT JOIN (SELECT * FROM conversations WHERE role = 'assistant') a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
LEFT JOIN (SELECT conv_id, max(text) AS text FROM conversations WHERE role = 'system' GROUP BY conv_id) s ON s.conv_id = u.conv_id)""")
def testset_stats(t: Tables) -> DataFrame:
    chat = t.conversations
    users = chat.filter("role = 'user'").select("conv_id", "turn")
    replies = chat.filter("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    system = chat.filter("role = 'system'").groupBy("conv_id").agg(F.array(F.max("text")).alias("context"))
    examples = users.join(replies, ["conv_id", "turn"], "left").join(system, "conv_id", "left").select(
        F.coalesce("context", F.array().cast("array<string>")).alias("context"), F.coalesce("answer", F.lit("")).alias("answer")
    )
    return rounded(stats.test_set_stats(examples))


WANTED = "SELECT DISTINCT vec_id AS doc_id, CASE WHEN label < 5 THEN 'arxiv' ELSE 'web' END AS loader_type FROM embeddings"


def wanted(t: Tables) -> DataFrame:
    loader = F.when(F.col("label") < 5, "arxiv").otherwise("web")
    return t.embeddings.select(F.col("vec_id").alias("doc_id"), loader.alias("loader_type")).distinct()


@query("load_report", f"""WITH w AS ({WANTED}), l AS (SELECT doc_id, count(*) AS n FROM labels GROUP BY doc_id)
SELECT loader_type, count(*) AS requested, count(n) AS loaded, count(*) - count(n) AS failed, coalesce(sum(n), 0)::BIGINT AS documents FROM w LEFT JOIN l USING (doc_id) GROUP BY loader_type""")
def load_report(t: Tables) -> DataFrame:
    loaded = t.labels.join(wanted(t), "doc_id")
    return stats.load_report(wanted(t), loaded, "doc_id", "loader_type")


@query("load_failures", f"SELECT DISTINCT doc_id, 'not found' AS error FROM ({WANTED}) WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def load_failures(t: Tables) -> DataFrame:
    return stats.load_failures(wanted(t), t.labels, "doc_id")


@query("source_totals", "SELECT CASE WHEN grouping(source) = 1 THEN 'Total' ELSE source END AS source, count(*) AS documents FROM documents GROUP BY ROLLUP (source)")
def source_totals(t: Tables) -> DataFrame:
    return stats.counts_with_total(t.documents, "source")


@query("key_coverage", """SELECT key, count(*) AS present, (SELECT count(*) FROM pages) AS total, round(100.0 * count(*) / (SELECT count(*) FROM pages), 4) AS coverage_pct FROM (
SELECT 'url' AS key FROM pages WHERE url IS NOT NULL UNION ALL SELECT 'query' FROM pages WHERE contains(url, '?') UNION ALL SELECT 'anchor' FROM pages WHERE contains(url, '#')) GROUP BY key""")
def key_coverage(t: Tables) -> DataFrame:
    part = [("url", F.col("url")), ("query", F.when(F.contains("url", F.lit("?")), "y")), ("anchor", F.when(F.contains("url", F.lit("#")), "y"))]
    meta = F.create_map(*[c for name, value in part for c in (F.lit(name), value)])
    return rounded(stats.key_coverage(t.pages.select(meta.alias("metadata"))), 4)


@query("download_report", """SELECT count(*) FILTER (s = 'successful') AS successful, count(*) FILTER (s = 'failed') AS failed, count(*) FILTER (s = 'skipped') AS skipped,
count(*) FILTER (s <> 'failed') AS total FROM (SELECT CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'skipped' ELSE 'successful' END AS s FROM events)""")
def download_report(t: Tables) -> DataFrame:
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "view", "skipped").otherwise("successful")
    return stats.download_report(t.events.select(status.alias("status")))


@query("load_summary", "SELECT count(*) AS page_count, count(DISTINCT source) AS file_count FROM documents")
def load_summary(t: Tables) -> DataFrame:
    return stats.load_summary(t.documents, "source")


@query("loader_comparison", """WITH d AS (SELECT 'web' AS loader_type, length(html) AS n, ['url'] AS keys FROM pages UNION ALL
SELECT 'csv', length(text), ['source', 'lang'] FROM documents), a AS (SELECT loader_type, count(*) AS total, avg(n) AS avg_length FROM d GROUP BY loader_type)
SELECT loader_type, key, count(*) AS present, total, round(avg_length, 4) AS avg_length FROM (SELECT loader_type, unnest(keys) AS key FROM d) JOIN a USING (loader_type) GROUP BY ALL""")
def loader_comparison(t: Tables) -> DataFrame:
    web = t.pages.select(F.lit("web").alias("loader_type"), F.col("html").alias("page_content"), F.create_map(F.lit("url"), "url").alias("metadata"))
    csv = t.documents.select(F.lit("csv").alias("loader_type"), F.col("text").alias("page_content"),
                             F.create_map(F.lit("source"), "source", F.lit("lang"), "lang").alias("metadata"))
    return rounded(stats.loader_comparison(web.unionByName(csv)), 4)
