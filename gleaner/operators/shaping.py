"""Document shaping: metadata standardisation, flattening, hit records, prompts, validity, redaction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.text import preview, truncate

# The standard metadata columns.
STANDARD_KEYS = [
    "source", "title", "author", "created_at", "publication_date",
    "document_type", "url", "doi", "page", "total_pages", "file_path",
    "file_name", "loader_type", "abstract", "published", "journal",
    "publication", "entry_id",
]

# Document type by a word in the loader type, first match wins.
TYPE_BY_LOADER = [
    ("arxiv", "scientific_paper"),
    ("pubmed", "medical_paper"),
    ("pdf", "pdf"),
    ("web", "web_page"),
    ("csv", "tabular"),
]

# Document type by the ending or the host of the source, first match wins.
TYPE_BY_ENDING = [((".pdf",), "pdf"), ((".docx", ".doc"), "word"), ((".csv", ".tsv"), "tabular")]
TYPE_BY_HOST = [("arxiv.org", "scientific_paper"), ("pubmed", "medical_paper")]

# Source keys by loader family, as (standard key, loader's key).
ARXIV_KEYS = [("publication_date", "Published"), ("title", "Title"), ("author", "Authors"), ("abstract", "Summary")]
PUBMED_KEYS = [
    ("publication_date", "pubdate"),
    ("title", "article_title"),
    ("journal", "journal_title"),
    ("abstract", "abstract_text"),
]
PUBMED_URL = "https://pubmed.ncbi.nlm.nih.gov/%s/"

# Metadata keys that may hold a score, in probing order.
SCORE_KEYS = ["score", "similarity", "relevance_score", "relevancy_score"]

# Prompt templates.
PROMPTS = {
    "assistant": (
        "You are a helpful and kind assistant. Use the context provided below to answer the question.\n\n"
        "If you do not know the answer, or are unsure, say you don't know.\n\n"
        "Query:\n%1$s\n\nContext:\n%2$s\n"
    ),
    "short": "Answer based on context:\n%2$s\nQuestion: %1$s",
}


def _get(metadata: Column, key: str) -> Column:
    return F.try_element_at(metadata, F.lit(key))


def set_keys(docs: DataFrame, values: dict[str, Column], metadata: str = "metadata") -> DataFrame:
    """Set metadata keys to the non-NULL ``values``; other keys stay."""
    pairs = [part for key, value in values.items() for part in (F.lit(key), value.cast("string"))]
    filled = docs.withColumn("to_set", F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull()))
    kept = F.map_filter(metadata, lambda key, _: ~F.map_contains_key("to_set", key))
    return filled.withColumn(metadata, F.map_concat(kept, "to_set")).drop("to_set")


def document_type(source: Column, loader_type: str | None) -> Column:
    """By loader when a loader is named, by ending or host of the source otherwise."""
    if loader_type:
        named = [kind for word, kind in TYPE_BY_LOADER if word in loader_type.lower()]
        return F.lit(named[0]) if named else F.lit(None).cast("string")
    lowered = F.lower(source)
    rules = [(reduce(Column.__or__, [lowered.endswith(e) for e in ends]), kind) for ends, kind in TYPE_BY_ENDING]
    rules += [(F.contains(lowered, F.lit(host)), kind) for host, kind in TYPE_BY_HOST]
    return F.coalesce(*[F.when(test, F.lit(kind)) for test, kind in rules])


def standardise_metadata(docs: DataFrame, loader_type: str | None = None, ordinal: str | None = None) -> DataFrame:
    """Fill the standard keys of ``metadata`` (a string map). A NULL value counts as an absent key.

    ``ordinal`` names a column that gives ``chunk_id`` where it is missing.
    """
    meta = F.col("metadata")
    loader = (loader_type or "").lower()
    source = F.coalesce(*[_get(meta, k) for k in ("source", "file_path", "url", "entry_id")])
    values = {
        "source": source,
        "document_type": F.coalesce(_get(meta, "document_type"), document_type(source, loader_type)),
    }
    if loader_type:
        values["loader_type"] = F.coalesce(_get(meta, "loader_type"), F.lit(loader_type))
    if ordinal:
        values["chunk_id"] = F.coalesce(_get(meta, "chunk_id"), F.col(ordinal).cast("string"))
    if "arxiv" in loader:
        values.update({standard: _get(meta, own) for standard, own in ARXIV_KEYS})
        entry = _get(meta, "entry_id")
        hosted = F.contains(entry, F.lit("arxiv.org"))
        values["url"] = F.when(hosted, entry)
        values["arxiv_id"] = F.when(hosted, F.element_at(F.split(entry, "/"), -1))
    if "pubmed" in loader:
        values.update({std: F.coalesce(_get(meta, std), _get(meta, own)) for std, own in PUBMED_KEYS})
        pmid = _get(meta, "pmid")
        values["entry_id"] = pmid
        values["url"] = F.when(pmid.isNotNull(), F.format_string(PUBMED_URL, pmid))
    return set_keys(docs, values)


def enrich(docs: DataFrame, **values: Column) -> DataFrame:
    """Loader enrichment: set the given metadata keys."""
    return set_keys(docs, values)


def stamp_loaded(docs: DataFrame, as_of: Column, key: str = "load_timestamp") -> DataFrame:
    """Add a load time only where a source is known and no time is set."""
    meta = F.col("metadata")
    due = _get(meta, "source").isNotNull() & _get(meta, key).isNull()
    return set_keys(docs, {key: F.when(due, as_of)})


def flatten(
    docs: DataFrame, keep: list[str], keys: list[str] | None = None, content: str | None = "page_content",
    max_content: int | None = None, residual: bool = True,
) -> DataFrame:
    """One column per metadata key, optional content, and the remaining keys as a map."""
    keys = keys or STANDARD_KEYS
    meta = F.col("metadata")
    columns = [F.col(name) for name in keep]
    if content:
        text = F.col(content)
        columns.append((truncate(text, max_content) if max_content else text).alias("page_content"))
    columns += [_get(meta, key).alias(key) for key in keys]
    if residual:
        rest = F.map_filter(meta, lambda key, _: ~key.isin(keys))
        columns.append(F.when(F.size(rest) > 0, rest).alias("additional_metadata"))
    return docs.select(*columns)


def metadata_keys(docs: DataFrame) -> list[str]:
    """All metadata keys in use: one small aggregate, as wide as the key set."""
    keys = docs.select(F.explode(F.map_keys("metadata")).alias("key")).distinct().orderBy("key")
    return [row.key for row in keys.collect()]


def flatten_all(docs: DataFrame, keep: list[str], content: str | None = "page_content") -> DataFrame:
    """``flatten`` with the standard keys and every other key that occurs."""
    extra = [key for key in metadata_keys(docs) if key not in STANDARD_KEYS]
    return flatten(docs, keep, STANDARD_KEYS + extra, content, residual=False)


def json_order(metadata: Column) -> Column:
    """The map with its keys in order, so that its JSON text is stable."""
    return F.map_from_entries(F.array_sort(F.map_entries(metadata)))


def pruned_json(metadata: Column) -> Column:
    """JSON of the metadata without empty values (NULL, empty string, list or object)."""
    filled = F.map_filter(metadata, lambda _, v: v.isNotNull() & ~v.isin("", "[]", "{}"))
    return F.to_json(json_order(filled))


def serialisable(df: DataFrame, columns: list[str]) -> Column:
    """A string map of columns of any type: dates as ISO text, everything else cast."""
    pairs = []
    for name in columns:
        kind = df.schema[name].dataType.typeName()
        value = F.col(name)
        if kind in ("timestamp", "timestamp_ntz"):
            value = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")
        pairs += [F.lit(name), value.cast("string")]
    return F.create_map(*pairs)


def test_set_table(rows: DataFrame) -> DataFrame:
    """Test set to a table with 100-character previews of the source documents.

    ``rows(question, answer, contexts array<struct<content, source, title, page>>)``.
    """
    previews = F.transform(
        "contexts",
        lambda c: F.struct(
            preview(c["content"]).alias("content"),
            F.coalesce(c["source"], F.lit("Unknown")).alias("source"),
            c["title"].alias("title"),
            c["page"].alias("page"),
        ),
    )
    return rows.withColumn("source_documents", previews)


def shape_hits(hits: DataFrame, top_k: int) -> DataFrame:
    """Hit records from raw results ``(query_id, retriever_type, position, page_content, metadata)``.

    ``position`` counts from 0. The id is the metadata id or a hash of the content; the score is the
    first score key with a number, otherwise it falls with the position. A result without content
    takes the second fallback.
    """
    meta = F.col("metadata")
    found = F.coalesce(*[_get(meta, key).try_cast("double") for key in SCORE_KEYS])
    by_position = F.lit(1.0) - F.col("position") * 0.05
    generic = F.lit(0.9) - F.col("position") * 0.1
    broken = F.col("page_content").isNull()
    others = F.map_filter(meta, lambda key, _: ~key.isin(SCORE_KEYS))
    # A result's own ``retriever`` key stays.
    named = F.map_filter(
        F.create_map(F.lit("retriever"), F.col("retriever_type")), lambda key, _: ~F.map_contains_key(meta, key)
    )
    return hits.filter(F.col("position") < top_k).select(
        "query_id",
        "retriever_type",
        (F.col("position") + 1).cast("int").alias("rank"),
        F.coalesce(
            _get(meta, "id"),
            F.when(broken, F.concat(F.lit("doc_"), F.col("position").cast("string"))),
            F.concat(F.lit("doc_"), F.col("position").cast("string"), F.lit("_"), F.md5("page_content")),
        ).alias("doc_id"),
        F.coalesce("page_content", F.lit("")).alias("content"),
        F.when(broken, generic).otherwise(F.coalesce(found, by_position)).alias("score"),
        F.map_concat(others, named).alias("metadata"),
    )


def prompt(question: Column, contexts: Column, template: str = "assistant") -> Column:
    """The prompt of a question with its contexts, one per line."""
    return F.format_string(PROMPTS[template], question, F.concat_ws("\n", contexts))


def evaluation_samples(hits: DataFrame, questions: DataFrame) -> DataFrame:
    """``(question_id, user_input, retrieved_contexts)``; questions without documents are left out.

    ``hits(question_id, rank, content)``: a group is one question's hits, bounded by its top-k.
    """
    ordered = F.array_sort(F.collect_list(F.struct("rank", "content")))
    contexts = hits.groupBy("question_id").agg(F.transform(ordered, lambda h: h["content"]).alias("retrieved_contexts"))
    return contexts.join(questions.select("question_id", F.col("question").alias("user_input")), "question_id")


def join_responses(responses: DataFrame, golden: DataFrame) -> DataFrame:
    """Responses with their golden rows; a question on one side only fails the job.

    ``responses(question_id, retrieved_contexts, response)``, ``golden(question_id, user_input, reference)``.
    """
    joined = responses.withColumn("has_response", F.lit(True)).join(
        golden.withColumn("has_golden", F.lit(True)), "question_id", "full"
    )
    complete = F.col("has_response").isNotNull() & F.col("has_golden").isNotNull()
    mismatch = F.raise_error(F.concat(F.lit("no counterpart for question "), F.col("question_id").cast("string")))
    return joined.filter(F.when(complete, F.lit(True)).otherwise(mismatch.cast("boolean"))).select(
        "question_id", "user_input", "retrieved_contexts", "response", "reference"
    )


def response_table(questions: DataFrame, answers: DataFrame, contexts: DataFrame) -> DataFrame:
    """One row per question; a failed question has an empty answer and no contexts."""
    return (
        questions.select("question_id", "question")
        .join(answers.select("question_id", "answer"), "question_id", "left")
        .join(contexts.select("question_id", "contexts"), "question_id", "left")
        .withColumn("answer", F.coalesce("answer", F.lit("")))
        .withColumn("contexts", F.coalesce("contexts", F.array().cast("array<string>")))
    )


def validity(df: DataFrame, url: str) -> DataFrame:
    """Add ``valid`` and ``problem`` for a URL column."""
    problem = (
        F.when(F.col(url).isNull() | (F.trim(url) == ""), F.lit("empty"))
        .when(~(F.startswith(url, F.lit("http://")) | F.startswith(url, F.lit("https://"))), F.lit("not http"))
    )
    return df.withColumn("problem", problem).withColumn("valid", F.col("problem").isNull())


def drop_embeddings(graph_rows: DataFrame, properties: str = "properties") -> DataFrame:
    """Remove property keys that contain ``embedding``; count removals and JSON sizes."""
    kept = F.map_filter(properties, lambda key, _: ~F.contains(F.lower(key), F.lit("embedding")))
    return (
        graph_rows.withColumn("kept", kept)
        .withColumn("removed", (F.size(properties) - F.size("kept")).cast("bigint"))
        .withColumn("bytes_before", F.octet_length(F.to_json(properties)).cast("bigint"))
        .withColumn("bytes_after", F.octet_length(F.to_json("kept")).cast("bigint"))
        .drop(properties)
        .withColumnRenamed("kept", properties)
    )


def embedding_report(cleaned: DataFrame, by: list[str]) -> DataFrame:
    """Removals and size reduction per group of ``drop_embeddings`` rows."""
    before, after = F.sum("bytes_before"), F.sum("bytes_after")
    return cleaned.groupBy(*by).agg(
        F.sum("removed").alias("removed"),
        before.alias("bytes_before"),
        after.alias("bytes_after"),
        F.round((before - after) / before * 100, 4).alias("reduction_pct"),
    )


def field_paths(schema, word: str = "embedding", prefix: str = "") -> list[str]:
    """Paths of the fields of a schema whose name contains ``word``; arrays are entered once."""
    paths: list[str] = []
    for field in schema.fields:
        path = f"{prefix}{field.name}"
        if word in field.name.lower():
            paths.append(path)
        inner = field.dataType
        while inner.typeName() == "array":
            inner = inner.elementType
            path += "[0]"
        if inner.typeName() == "struct":
            paths += field_paths(inner, word, f"{path}.")
    return paths
