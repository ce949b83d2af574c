"""Relevance metrics, aggregates and reports: hand cases and properties."""

import math

import pytest
from pyspark.sql import functions as F

from gleaner.operators import evaluation, judged, reports, stats

HITS = "query_id string, doc_id string, rank int"


def hits_of(spark, lists):
    return spark.createDataFrame([(q, d, r) for q, docs in lists.items() for r, d in enumerate(docs, 1)], HITS)


def qrels_of(spark, lists):
    return spark.createDataFrame([(q, d) for q, docs in lists.items() for d in docs], "query_id string, doc_id string")


CASES = {
    "q1": ("abcd", "bdx", (0.5, 2 / 3, 4 / 7, 0.5, (1 / math.log2(3) + 1 / math.log2(5)) / (1 + 1 / math.log2(3) + 0.5))),
    "q2": ("a", "a", (1, 1, 1, 1, 1)),
    "q3": ("ab", "x", (0, 0, 0, 0, 0)),
    "q4": ("", "x", None),
    "q5": ("a", "", None),
}


def test_hand_cases(spark):
    hits = hits_of(spark, {q: c[0] for q, c in CASES.items()})
    qrels = qrels_of(spark, {q: c[1] for q, c in CASES.items()})
    found = {r.query_id: (r.precision, r.recall, r.f1, r.mrr, r.ndcg) for r in evaluation.relevance_by_query(hits, qrels).collect()}
    assert set(found) == {"q1", "q2", "q3"}
    for q, values in found.items():
        assert values == pytest.approx(CASES[q][2])


def test_zero_fill(spark):
    hits = hits_of(spark, {q: c[0] for q, c in CASES.items()})
    qrels = qrels_of(spark, {q: c[1] for q, c in CASES.items()})
    found = {r.query_id: r.recall for r in evaluation.relevance_by_query(hits, qrels, on_empty="zero").collect()}
    assert set(found) == set(CASES) and found["q4"] == 0 and found["q5"] == 0


def test_repeats_count_only_without_dedupe(spark):
    hits, qrels = hits_of(spark, {"q": "aab"}), qrels_of(spark, {"q": "a"})
    raw = evaluation.relevance_by_query(hits, qrels, dedupe=False).first()
    clean = evaluation.relevance_by_query(hits, qrels).first()
    assert raw.recall == 2.0 and raw.ndcg > 1
    assert clean.recall == 1.0 and clean.precision == 0.5 and clean.ndcg == 1.0


def test_recall_grows_with_k(spark):
    qrels = qrels_of(spark, {"q": "bdf"})
    recalls = [evaluation.relevance_by_query(hits_of(spark, {"q": "abcdef"[:k]}), qrels).first().recall for k in range(1, 7)]
    assert recalls == sorted(recalls) and recalls[-1] == 1.0


def test_means_are_null_without_queries(spark):
    row = evaluation.macro_means(evaluation.relevance_by_query(hits_of(spark, {"q": "a"}), qrels_of(spark, {"z": "a"}))).first()
    assert row.precision is None and row.n_queries == 0


def test_aggregates_use_micro_score(spark):
    rows = [("r", "success", 10.0, 1, 0.5, 7), ("r", "success", 20.0, 3, 3.0, 9), ("r", "failed", None, None, None, None), ("z", "failed", None, None, None, None)]
    details = spark.createDataFrame(rows, "retriever_type string, status string, latency_ms double, document_count int, score_sum double, token_count int")
    found = {r.retriever_type: r for r in evaluation.retriever_aggregates(details).collect()}
    assert found["r"].avg_document_score == pytest.approx(3.5 / 4) and found["r"].avg_latency_ms == 15.0
    assert found["r"].success_rate == pytest.approx(200 / 3)
    assert found["z"].avg_latency_ms == 0.0 and found["z"].avg_document_score == 0.0


def test_directions_and_ties(spark):
    rows = [("a", "avg_latency_ms", 5.0), ("b", "avg_latency_ms", 3.0), ("a", "recall", 0.5), ("b", "recall", 0.5)]
    tall = spark.createDataFrame(rows, "retriever_type string, metric string, value double")
    best = {r.metric: r.retriever_type for r in reports.best_per_metric(tall).collect()}
    assert best == {"avg_latency_ms": "b", "recall": "a"}


def test_wide_defaults_to_zero(spark):
    tall = spark.createDataFrame([("a", "recall", 0.5), ("b", "judged_x", 0.25)], "retriever_type string, metric string, value double")
    rows = {r.retriever_type: r.asDict() for r in reports.wide(tall).collect()}
    assert rows["a"]["judged_x"] == 0.0 and rows["b"]["recall"] == 0.0 and rows["b"]["judged_x"] == 0.25
    assert "judged_y" not in rows["a"]


def test_applicability_depends_on_the_samples(spark):
    schema = "user_input string, retrieved_contexts array<string>, response string, reference string"
    row = judged.applicable_metrics(spark.createDataFrame([("q", ["c"], "", None)], schema)).first()
    assert row.LLMContextRecall and not row.Faithfulness and not row.FactualCorrectness
    empty = judged.applicable_metrics(spark.createDataFrame([("q", [], "", None)], schema)).first()
    assert empty.LLMContextRecall and not empty.ContextEntityRecall


def test_missing_scores_are_flagged(spark):
    requested = spark.createDataFrame([("r", "FactualCorrectness"), ("r", "Other")], "run string, metric_class string")
    results = spark.createDataFrame([("r", "factual_correctness(mode=f1)", 0.7)], "run string, metric string, value double")
    found = {r.metric_class: (r.value, r.missing) for r in judged.extract_scores(requested, results, ["run"]).collect()}
    assert found == {"FactualCorrectness": (0.7, False), "Other": (0.0, True)}


def test_noise_and_correctness(spark):
    verdicts = spark.createDataFrame([("s", True, True), ("s", False, True), ("s", False, False), ("s", True, False)], "s string, correct boolean, attributable boolean")
    assert judged.noise_sensitivity(verdicts, ["s"]).first().noise_sensitivity == 0.25
    kinds = spark.createDataFrame([("s", "tp"), ("s", "fp"), ("s", "fn"), ("t", "fp")], "s string, kind string")
    found = {r.s: r.factual_correctness for r in judged.factual_correctness(kinds, ["s"]).collect()}
    assert found == {"s": 0.5, "t": 0.0}


def test_empty_test_set_is_vacuously_complete(spark):
    row = stats.test_set_stats(spark.createDataFrame([], "context array<string>, answer string")).first()
    assert row.example_count == 0 and row.has_context and row.has_answers and row.context_share is None


def test_regressions_follow_direction(spark):
    deltas = spark.createDataFrame([("recall", -0.2), ("avg_latency_ms", 5.0), ("f1", 0.1)], "metric string, delta double")
    found = evaluation.regressions(deltas, reports.direction(F.col("metric")), 0.05)
    assert {r.metric for r in found.collect()} == {"recall", "avg_latency_ms"}


def test_runs_are_scored_on_every_judged_query(spark):
    rows = [("r1", "q1", "a", 1), ("r1", "q2", "b", 1), ("r2", "q1", "z", 1), ("r2", "q9", "z", 1)]
    hits = spark.createDataFrame(rows, "run string, query_id string, doc_id string, rank int")
    qrels = spark.createDataFrame([("q1", "a"), ("q2", "b"), ("q3", "c")], "query_id string, doc_id string")
    found = evaluation.relevance_by_query(hits, qrels, ["run", "query_id"], on_empty="zero").collect()
    assert {(r.run, r.query_id): r.recall for r in found} == {
        ("r1", "q1"): 1.0, ("r1", "q2"): 1.0, ("r1", "q3"): 0.0, ("r2", "q1"): 0.0, ("r2", "q2"): 0.0, ("r2", "q3"): 0.0, ("r2", "q9"): 0.0,
    }


def test_empty_sides_stay(spark):
    questions = spark.createDataFrame([("q",), ("none",)], "query_id string")
    hits = spark.createDataFrame([("q", 0.5, "two words")], "query_id string, score double, content string")
    rows = {r.query_id: r[1:] for r in evaluation.question_details(questions, hits, ["query_id"]).collect()}
    assert rows == {"q": (1, 0.5, 0.5, 2), "none": (0, 0.0, 0.0, 0)}
    old = spark.createDataFrame([("m", 1.0), ("gone", 2.0)], "metric string, value double")
    new = spark.createDataFrame([("m", 1.5), ("new", 3.0)], "metric string, value double")
    deltas = {r.metric: (r.delta, r.missing_in) for r in evaluation.metric_delta(old, new).collect()}
    assert deltas == {"m": (0.5, None), "gone": (None, "current"), "new": (None, "baseline")}
    texts = spark.createDataFrame([("en", ["aa"]), ("de", ["zz"])], "lang string, tokens array<string>")
    terms = spark.createDataFrame([("x", "aa"), ("y", "bb")], "category string, term string")
    cover = {(r.lang, r.category): r.coverage for r in evaluation.term_coverage(texts, terms, ["lang"]).collect()}
    assert cover == {("en", "x"): 1.0, ("en", "y"): 0.0, ("de", "x"): 0.0, ("de", "y"): 0.0}


def test_terms_of_several_words_are_found(spark):
    texts = spark.createDataFrame([("a", "new york city and san  francisco".split()), ("a", ["york", "new"]), ("b", None), ("c", [])], "g string, tokens array<string>")
    terms = spark.createDataFrame(
        [("x", "new york"), ("x", "new  york"), ("x", "york city and"), ("x", "city"), ("x", "york new"), ("y", "and new"), ("y", "francisco san"), ("y", " ")],
        "category string, term string",
    )
    found = {(r.g, r.category): (r.n_mentioned, r.n_terms) for r in evaluation.term_coverage(texts, terms, ["g"]).collect()}
    assert found == {("a", "x"): (4, 4), ("a", "y"): (0, 3), ("b", "x"): (0, 4), ("b", "y"): (0, 3), ("c", "x"): (0, 4), ("c", "y"): (0, 3)}
