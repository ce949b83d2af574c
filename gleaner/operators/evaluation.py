"""Retrieval evaluation: per-question facts, relevance metrics, aggregates, deltas, attribution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gleaner.functions.text import word_count, words
from gleaner.session import materialise

RELEVANCE_METRICS = ["precision", "recall", "f1", "mrr", "ndcg"]


def mark_outcome(questions: DataFrame, question: str = "question", failed: Column | None = None) -> DataFrame:
    """Add ``status``: a question fails when its text is empty or the request failed."""
    bad = F.coalesce(F.trim(question), F.lit("")) == ""
    if failed is not None:
        bad = bad | F.coalesce(failed, F.lit(False))
    return questions.withColumn("status", F.when(bad, F.lit("failed")).otherwise(F.lit("success")))


def question_details(questions: DataFrame, hits: DataFrame, keys: list[str]) -> DataFrame:
    """Per question: document count, mean score, words; zeros for a question without hits.

    ``questions(keys)`` has each question once, ``hits(keys, score, content)`` its documents.
    """
    found = hits.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("document_count"),
        F.avg("score").alias("avg_score"),
        F.sum("score").alias("score_sum"),
        F.sum(word_count(F.col("content"))).alias("token_count"),
    )
    zero = {"document_count": 0, "avg_score": 0.0, "score_sum": 0.0, "token_count": 0}
    return questions.select(*keys).join(found, keys, "left").fillna(zero)


def retriever_aggregates(details: DataFrame) -> DataFrame:
    """Aggregates per retriever; 0 where no question succeeded.

    ``details(retriever_type, status, latency_ms, document_count, score_sum, token_count)``. The mean
    score is over documents (micro), the other means are over questions.
    """
    good = F.col("status") == "success"

    def mean(column: str) -> Column:
        return F.coalesce(F.avg(F.when(good, F.col(column))), F.lit(0.0))

    docs = F.sum(F.when(good, F.col("document_count")))
    return details.groupBy("retriever_type").agg(
        F.count(F.lit(1)).alias("total_questions"),
        F.count_if(good).alias("successful"),
        F.count_if(~good).alias("failed"),
        (F.count_if(good) * 100.0 / F.count(F.lit(1))).alias("success_rate"),
        mean("latency_ms").alias("avg_latency_ms"),
        mean("document_count").alias("avg_document_count"),
        F.coalesce(F.sum(F.when(good, F.col("score_sum"))) / F.nullif(docs, F.lit(0)), F.lit(0.0)).alias(
            "avg_document_score"
        ),
        mean("token_count").alias("avg_token_count"),
    )


def cap_details(details: DataFrame, order: list[str], limit: int) -> DataFrame:
    """The first ``limit`` detail rows of each retriever and whether some were left out."""
    place = F.row_number().over(W.partitionBy("retriever_type").orderBy(*order))
    first = details.withColumn("place", place).filter(F.col("place") <= limit)
    totals = details.groupBy("retriever_type").agg((F.count(F.lit(1)) > limit).alias("truncated"))
    return first.join(totals, "retriever_type")


def relevance_by_query(
    hits: DataFrame, qrels: DataFrame, keys: list[str] | None = None, dedupe: bool = True, on_empty: str = "skip"
) -> DataFrame:
    """Precision, recall, F1, reciprocal rank and nDCG (binary gain) per query.

    ``hits(keys.., doc_id, rank)``, ``qrels(query_id, doc_id)``; ``keys`` name a run and a query and
    include ``query_id``. With ``dedupe`` a repeated document counts once at its first rank; without,
    each repeat counts as a hit. A query without hits or without relevant documents is skipped, or
    scored 0 with ``on_empty="zero"``: then every run that has a hit at all is scored on every query that
    it or the judgements name.
    """
    keys = keys or ["query_id"]
    ranked = hits.select(*keys, "doc_id", "rank")
    if dedupe:
        ranked = ranked.groupBy(*keys, "doc_id").agg(F.min("rank").alias("rank"))
        ranked = ranked.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy("rank", "doc_id")))
    relevant = qrels.select("query_id", "doc_id").distinct()
    wanted = relevant.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_relevant"))
    judged = ranked.join(relevant.withColumn("rel", F.lit(1)), ["query_id", "doc_id"], "left")
    facts = judged.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_retrieved"),
        F.count("rel").alias("n_hits"),
        F.coalesce(1.0 / F.min(F.when(F.col("rel") == 1, F.col("rank"))), F.lit(0.0)).alias("mrr"),
        F.coalesce(F.sum(F.col("rel") / F.log2(F.col("rank") + 1)), F.lit(0.0)).alias("dcg"),
    )
    if on_empty == "skip":
        scored = facts.join(wanted, "query_id")
    elif keys == ["query_id"]:
        scored = facts.join(wanted, "query_id", "full")
    else:
        run = [key for key in keys if key != "query_id"]
        # One row per judged query and run: the size of the result, not of the hits.
        runs = facts.select(*run).distinct().agg(F.collect_set(F.struct(*run)).alias("runs"))
        grid = wanted.withColumn("run", F.explode(runs.scalar())).select("query_id", "n_relevant", "run.*")
        scored = facts.join(grid, keys, "full")
    n_relevant = F.coalesce("n_relevant", F.lit(0))
    n_retrieved = F.coalesce("n_retrieved", F.lit(0))
    precision = F.coalesce(F.col("n_hits") / F.nullif(n_retrieved, F.lit(0)), F.lit(0.0))
    recall = F.coalesce(F.col("n_hits") / F.nullif(n_relevant, F.lit(0)), F.lit(0.0))
    ideal_length = F.least(n_relevant, n_retrieved)
    ideal = F.when(
        ideal_length > 0,
        F.aggregate(F.sequence(F.lit(1).cast("bigint"), ideal_length), F.lit(0.0), lambda acc, i: acc + 1 / F.log2(i + 1)),
    )
    with_ratios = scored.withColumns({"precision": precision, "recall": recall})
    return with_ratios.select(
        *keys,
        n_retrieved.alias("n_retrieved"),
        n_relevant.alias("n_relevant"),
        F.coalesce("n_hits", F.lit(0)).alias("n_hits"),
        "precision",
        "recall",
        F.coalesce(
            2 * F.col("precision") * F.col("recall") / F.nullif(F.col("precision") + F.col("recall"), F.lit(0.0)),
            F.lit(0.0),
        ).alias("f1"),
        F.coalesce("mrr", F.lit(0.0)).alias("mrr"),
        F.coalesce(F.col("dcg") / ideal, F.lit(0.0)).alias("ndcg"),
    )


def macro_means(per_query: DataFrame, metrics: list[str] | None = None, by: list[str] | None = None) -> DataFrame:
    """Mean of the chosen metrics over queries; NULL when no query qualified."""
    chosen = metrics or RELEVANCE_METRICS
    return per_query.groupBy(*(by or [])).agg(
        *[F.avg(name).alias(name) for name in chosen], F.count(F.lit(1)).alias("n_queries")
    )


def context_precision(hits: DataFrame, qrels: DataFrame) -> DataFrame:
    """Share of relevant hits, and the mean of precision at the relevant ranks (0 without any)."""
    relevant = qrels.select("query_id", "doc_id").distinct().withColumn("rel", F.lit(1))
    judged = hits.select("query_id", "doc_id", "rank").join(relevant, ["query_id", "doc_id"], "left").fillna(0, ["rel"])
    upto = W.partitionBy("query_id").orderBy("rank").rowsBetween(W.unboundedPreceding, W.currentRow)
    running = judged.withColumn("precision_at", F.avg("rel").over(upto))
    return running.groupBy("query_id").agg(
        F.avg("rel").alias("precision"),
        F.coalesce(F.avg(F.when(F.col("rel") == 1, F.col("precision_at"))), F.lit(0.0)).alias("weighted_precision"),
    )


def context_efficiency(hits: DataFrame, qrels: DataFrame) -> DataFrame:
    """Words of relevant hits over words of all hits, per query. ``hits(query_id, doc_id, content)``."""
    relevant = qrels.select("query_id", "doc_id").distinct().withColumn("rel", F.lit(True))
    judged = hits.join(relevant, ["query_id", "doc_id"], "left").withColumn("n_words", word_count(F.col("content")))
    useful = F.coalesce(F.sum(F.when(F.col("rel"), F.col("n_words"))), F.lit(0))
    total = F.sum("n_words")
    return judged.groupBy("query_id").agg(
        useful.alias("useful_words"),
        total.alias("all_words"),
        F.coalesce(useful / F.nullif(total, F.lit(0)), F.lit(0.0)).alias("efficiency"),
    )


def word_runs(tokens: Column, lengths: list[int]) -> Column:
    """All different runs of so many words of a token list, joined by single spaces; a null list has none."""
    def runs(n: int) -> Column:
        starts = F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - (n - 1), F.lit(0)))
        return F.transform(starts, lambda _, i: F.array_join(F.slice(tokens, i + 1, n), " "))

    none = F.array().cast("array<string>")
    return F.array_distinct(F.concat(none, *(F.coalesce(tokens if n == 1 else runs(n), none) for n in lengths)))


def term_coverage(texts: DataFrame, terms: DataFrame, by: list[str]) -> DataFrame:
    """Share of a term list each group of texts mentions: ``texts(by.., tokens)``, ``terms(category, term)``.

    A term is one word or several; each text gives its runs of as many words as some term has, and an equi-join finds all
    terms in one pass. Partial distinct sets are merged per group, never the texts themselves. Every group has a row for
    every category, 0 where it mentions none of its terms. White space inside a term counts as one space; blank terms
    are in no text.
    """
    spaced = F.array_join(words(F.col("term")), " ")
    terms = materialise(terms.select("category", spaced.alias("term")).distinct(), "term-list")  # known size: broadcast if small
    lengths = sorted(row[0] for row in terms.filter("term <> ''").select(F.size(F.split("term", " "))).distinct().collect())
    sizes = terms.groupBy("category").agg(F.count(F.lit(1)).alias("n_terms"))
    mentioned = (
        texts.select(*by, F.explode(word_runs(F.col("tokens"), lengths)).alias("term"))
        .join(terms, "term")
        .select(*by, "category", "term")
        .distinct()
        .groupBy(*by, "category")
        .agg(F.count(F.lit(1)).alias("n_mentioned"))
    )
    every = sizes.agg(F.collect_list(F.struct("category", "n_terms")).alias("all")).scalar()
    grid = texts.select(*by).distinct().withColumn("c", F.explode(every)).select(*by, "c.category", "c.n_terms")
    counted = grid.join(mentioned, [*by, "category"], "left").fillna(0, ["n_mentioned"])
    return counted.withColumn("coverage", F.col("n_mentioned") / F.col("n_terms"))


def attribute_failures(per_query: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Why questions fail: ``retriever_miss``, ``unused_context``, ``ungrounded_answer`` or ``ok``.

    ``per_query(query_id, n_hits)``, ``verdicts(query_id, supported)``.
    """
    joined = per_query.join(verdicts, "query_id", "left").withColumn(
        "supported", F.coalesce("supported", F.lit(False))
    )
    found = F.col("n_hits") > 0
    cause = (
        F.when(found & F.col("supported"), "ok")
        .when(found, "unused_context")
        .when(F.col("supported"), "ungrounded_answer")
        .otherwise("retriever_miss")
    )
    return joined.groupBy(cause.alias("cause")).agg(F.count(F.lit(1)).alias("n_questions"))


def metric_delta(baseline: DataFrame, current: DataFrame, keys: list[str] | None = None, digits: int = 4) -> DataFrame:
    """Change of each metric between two tall runs ``(keys.., metric, value)``.

    A metric of one run only stays, with a NULL delta and the other run's name in ``missing_in``.
    """
    on = [*(keys or []), "metric"]
    old = baseline.select(*on, F.col("value").alias("baseline"), F.lit(True).alias("in_old"))
    new = current.select(*on, F.col("value").alias("current"), F.lit(True).alias("in_new"))
    missing = F.when(F.col("in_old").isNull(), "baseline").when(F.col("in_new").isNull(), "current")
    return old.join(new, on, "full").withColumns(
        {"delta": F.round(F.col("current") - F.col("baseline"), digits), "missing_in": missing}
    ).drop("in_old", "in_new")


def regressions(deltas: DataFrame, directions: Column, threshold: float) -> DataFrame:
    """Deltas that got worse by more than ``threshold``; ``directions`` is 1 or -1 per metric."""
    return deltas.filter(F.col("delta") * directions < -threshold)
