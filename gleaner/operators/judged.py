"""Judged metrics from verdict tables: claims, supports and entities are ordinary input rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.text import sentences
from gleaner.functions.vectors import cosine

# Metric class names and the keys their results carry.
RESULT_KEYS = {
    "LLMContextRecall": "context_recall",
    "Faithfulness": "faithfulness",
    "FactualCorrectness": "factual_correctness(mode=f1)",
    "ResponseRelevancy": "answer_relevancy",
    "ContextEntityRecall": "context_entity_recall",
    "NoiseSensitivity": "noise_sensitivity",
    "ContextPrecision": "context_precision",
    "ContextRecall": "context_recall",
}


def mock_responses(samples: DataFrame) -> DataFrame:
    """Optional stand-in: response and reference are both the first retrieved context."""
    first = F.try_element_at("retrieved_contexts", F.lit(1))
    return samples.withColumns({"response": first, "reference": first})


def applicable_metrics(samples: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Which judged metrics a sample table supports, one flag column each."""

    def filled(name: str) -> Column:
        return F.coalesce(F.trim(name) != "", F.lit(False))

    flags = samples.groupBy(*(by or [])).agg(
        F.bool_or(filled("response")).alias("has_responses"),
        F.bool_or(filled("reference")).alias("has_references"),
        F.bool_and(F.coalesce(F.size("retrieved_contexts") > 0, F.lit(False))).alias("has_contexts"),
    )
    contexts, responses, references = F.col("has_contexts"), F.col("has_responses"), F.col("has_references")
    nothing = ~contexts & ~(responses & references)
    return flags.withColumns(
        {
            "LLMContextRecall": contexts | nothing,
            "ContextEntityRecall": contexts,
            "NoiseSensitivity": contexts,
            "Faithfulness": responses & contexts,
            "ResponseRelevancy": responses & contexts,
            "FactualCorrectness": responses & references,
        }
    )


def claims_of(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Default claims: the sentences of a text, ``(keys, claim_no, claim)``."""
    return texts.select(*keys, F.posexplode(sentences(F.col(text))).alias("claim_no", "claim"))


def lexical_support(claims: DataFrame, contexts: DataFrame, keys: list[str], text: str = "content") -> DataFrame:
    """Default verdicts: a claim is supported when one of its own contexts contains it word for word.

    A claim meets only the contexts of its own sample, whose number the retrieval top-k bounds; the
    verdict is folded to one row per claim before it is shuffled on.
    """
    paired = claims.join(contexts.select(*keys, text), keys, "left")
    return paired.groupBy(*keys, "claim_no").agg(
        F.bool_or(F.coalesce(F.contains(text, F.col("claim")), F.lit(False))).alias("supported")
    )


def supported_share(verdicts: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Share of supported claims: context recall on reference claims, faithfulness on response claims."""
    return verdicts.groupBy(*keys).agg(F.avg(F.col("supported").cast("double")).alias(name))


def factual_correctness(verdicts: DataFrame, keys: list[str]) -> DataFrame:
    """F1 over claims: ``verdicts(keys.., kind)`` with kind ``tp``, ``fp`` or ``fn``."""
    counts = verdicts.groupBy(*keys).agg(
        *[F.count_if(F.col("kind") == kind).alias(kind) for kind in ("tp", "fp", "fn")]
    )
    doubled = 2.0 * F.col("tp")
    total = doubled + F.col("fp") + F.col("fn")
    return counts.withColumn("factual_correctness", F.coalesce(doubled / F.nullif(total, F.lit(0.0)), F.lit(0.0)))


def claim_kinds(response_claims: DataFrame, reference_claims: DataFrame, keys: list[str]) -> DataFrame:
    """Default TP/FP/FN: exact agreement of response and reference claims."""
    ours = response_claims.select(*keys, "claim").distinct().withColumn("in_response", F.lit(True))
    theirs = reference_claims.select(*keys, "claim").distinct().withColumn("in_reference", F.lit(True))
    both = ours.join(theirs, [*keys, "claim"], "full")
    kind = (
        F.when(F.col("in_response").isNotNull() & F.col("in_reference").isNotNull(), "tp")
        .when(F.col("in_response").isNotNull(), "fp")
        .otherwise("fn")
    )
    return both.select(*keys, "claim", kind.alias("kind"))


def response_relevancy(questions: DataFrame, regenerated: DataFrame, keys: list[str]) -> DataFrame:
    """Mean cosine between a question and the questions regenerated from its answer."""
    paired = questions.select(*keys, F.col("vector").alias("q")).join(
        regenerated.select(*keys, F.col("vector").alias("r")), keys
    )
    return paired.groupBy(*keys).agg(
        F.avg(F.coalesce(cosine(F.col("q"), F.col("r")), F.lit(0.0))).alias("answer_relevancy")
    )


def entity_recall(samples: DataFrame, reference_entities: str, context_entities: str) -> Column:
    """Share of the reference's distinct entities that the contexts mention; NULL without entities."""
    wanted = F.array_distinct(reference_entities)
    return F.size(F.array_intersect(wanted, F.col(context_entities))) / F.nullif(F.size(wanted), F.lit(0))


def noise_sensitivity(verdicts: DataFrame, keys: list[str]) -> DataFrame:
    """Share of response claims that are wrong and come from the contexts: ``verdicts(correct, attributable)``."""
    wrong = ~F.col("correct") & F.col("attributable")
    return verdicts.groupBy(*keys).agg((F.count_if(wrong) / F.count(F.lit(1))).alias("noise_sensitivity"))


def metric_means(scores: DataFrame, metrics: list[str], by: list[str] | None = None, prefix: str = "judged_") -> DataFrame:
    """Mean of each judged metric, its name prefixed."""
    return scores.groupBy(*(by or [])).agg(*[F.avg(name).alias(prefix + name) for name in metrics])


def summary_names(tall: DataFrame, prefix: str = "judged_") -> DataFrame:
    """Tall metrics with the prefix stripped; availability and error keys left out."""
    bookkeeping = [prefix + "available", prefix + "error"]
    kept = tall.filter(F.startswith("metric", F.lit(prefix)) & ~F.col("metric").isin(bookkeeping))
    return kept.withColumn("metric", F.regexp_replace("metric", "^" + prefix, ""))


def extract_scores(requested: DataFrame, results: DataFrame, keys: list[str]) -> DataFrame:
    """Scores of requested metric classes: mapped key, else lower-cased name, else 0 with a flag.

    ``requested(keys.., metric_class)``, ``results(keys.., metric, value)``.
    """
    pairs = [F.lit(part) for item in RESULT_KEYS.items() for part in item]
    key = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("metric_class")), F.lower("metric_class"))
    found = requested.withColumn("metric", key).join(results, [*keys, "metric"], "left")
    return found.select(
        *keys, "metric_class", "metric",
        F.coalesce("value", F.lit(0.0)).alias("value"), F.col("value").isNull().alias("missing"),
    )


def fill_failed(expected: DataFrame, results: DataFrame, keys: list[str]) -> DataFrame:
    """The expected (run, metric) grid with 0 and an error text where an evaluation gave nothing."""
    joined = expected.join(results, [*keys, "metric"], "left")
    return joined.withColumn("error", F.when(F.col("value").isNull(), F.lit("evaluation failed"))).withColumn(
        "value", F.coalesce("value", F.lit(0.0))
    )
