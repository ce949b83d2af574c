"""Document queries: sources, sinks, shaping and chunking on the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner import schemas
from gleaner.functions.text import mask, redact, word_count
from gleaner.operators import chunking, shaping
from gleaner.operators.evaluation import mark_outcome
from gleaner.operators.ordinal import batch_id, with_ordinal
from gleaner.plans import sql
from gleaner.plans.evaluation import AGG_SQL, aggregates
from gleaner.plans.registry import Tables, query
from gleaner.sources import readers, writers


def _text(name: str):
    return F.col(name).cast("string")


def _map(**values: Column) -> Column:
    return F.create_map(*[part for name, value in values.items() for part in (F.lit(name), value)])


# --- sources -------------------------------------------------------------------------------------

STRIPPED = "trim(regexp_replace(replace(replace(replace(replace(replace(replace({x}, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&'), '[ \\t\\n\\r]+', ' ', 'g'), ' ')"
BARE = "regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script.*?</script>|<style.*?</style>|<title.*?</title>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g')"


@query("html_documents", f"""SELECT page_id, url, {STRIPPED.format(x="regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")} AS title,
md5({STRIPPED.format(x=BARE)}) AS content_print, len({sql.words(STRIPPED.format(x=BARE))}) AS n_words FROM pages""")
def html_documents(t: Tables) -> DataFrame:
    docs = readers.html_documents(t.spread("pages", "page_id", "url", "html"))
    return docs.select("page_id", "url", "title", F.md5("page_content").alias("content_print"), word_count(F.col("page_content")).alias("n_words"))


@query("summaries_by_id", """SELECT vec_id AS doc_id, vec_id IN (SELECT doc_id FROM labels) AS found FROM (SELECT DISTINCT vec_id FROM embeddings)""")
def summaries_by_id(t: Tables) -> DataFrame:
    wanted = t.embeddings.select(F.col("vec_id").alias("doc_id"))
    found, failed = readers.summaries_by_id(t.labels, wanted, "doc_id")
    return found.select("doc_id", F.lit(True).alias("found")).unionByName(failed.withColumn("found", F.lit(False)))


REVIEW_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in [*schemas.REVIEW_METADATA, "text", "lang"]])


@query("csv_documents", """SELECT md5('text: ' || d.text || chr(10) || 'lang: ' || lang) AS content_print, 'doc ' || doc_id AS "Review_Title", source AS "Author",
coalesce(CASE WHEN toxic = 1 THEN 0 ELSE quality END, 0)::INTEGER AS "Rating", CASE WHEN toxic = 1 THEN 'bad' END AS bad_rating,
'Volume ' || (doc_id % 4 + 1) AS "Movie_Title", TIMESTAMP '2024-02-01' - to_days((4 - (doc_id % 4 + 1))::INTEGER) AS last_accessed_at
FROM documents d LEFT JOIN labels USING (doc_id)""")
def csv_documents(t: Tables) -> DataFrame:
    """Documents written as review CSVs in four volumes (texts hold quotes and newlines), then loaded."""
    rating = F.when(F.col("toxic") == 1, "bad").otherwise(_text("quality"))
    rows = t.spread("documents").join(t.labels, "doc_id", "left").select(
        F.lit("2024-01-01").alias("Review_Date"), F.concat(F.lit("doc "), _text("doc_id")).alias("Review_Title"),
        F.lit("").alias("Review_Url"), F.col("source").alias("Author"), rating.alias("Rating"), "text", "lang",
        (F.col("doc_id") % 4 + 1).alias("volume"),
    )
    path = t.scratch("reviews")
    rows.write.partitionBy("volume").options(header=True, quote='"', escape='"', emptyValue="").csv(path)
    paths = [f"{path}/volume={n}" for n in range(1, 6)]  # the fifth does not exist and is skipped
    docs = readers.read_csv_documents(t.spark, paths, REVIEW_SCHEMA, path_pattern=".*volume=([0-9]+)/.*", title="Volume $1", quoted_newlines=True)
    docs = readers.shifted_access(docs, F.lit("2024-02-01").cast("timestamp"), parts=4)
    return docs.select(F.md5("page_content").alias("content_print"), "Review_Title", "Author", "Rating", "bad_rating", "Movie_Title", "last_accessed_at")


@query("testset_json", """SELECT conv_id || '-' || turn AS question_id, text AS question, role AS answer, CASE WHEN role = 'system' THEN 0 ELSE 1 END AS n_context,
CASE WHEN trim(text) = '' THEN 'failed' ELSE 'success' END AS status FROM conversations""")
def testset_json(t: Tables) -> DataFrame:
    """Turns written as test-set lines in three shapes, loaded and mapped to one."""
    role = F.col("role")
    text = F.col("text")
    rows = t.conversations.select(
        F.concat_ws("-", _text("conv_id"), _text("turn")).alias("id"),
        F.when(role == "user", text).alias("question"),
        F.when(role == "assistant", text).alias("user_input"),
        F.when(role == "system", text).alias("text"),
        F.when(role == "user", F.array(text)).alias("documents"),
        F.when(role == "assistant", F.array(text)).alias("reference_contexts"),
        F.when(role == "user", F.struct(F.array(role).alias("text"))).alias("answers"),
        F.when(role == "assistant", role).alias("reference"),
        F.when(role == "system", role).alias("answer"),
    )
    path = t.scratch("testset")
    rows.write.json(path)
    mapped = readers.map_test_set(readers.read_test_lines(t.spark, path))
    return mark_outcome(mapped).select("question_id", "question", "answer", F.size("context").alias("n_context"), "status")


@query("testset_wrapped", """SELECT (row_number() OVER (PARTITION BY conv_id // 20 ORDER BY conv_id, turn) - 1)::VARCHAR AS question_id, text AS question, role AS answer,
conv_id // 20 AS part FROM conversations""")
def testset_wrapped(t: Tables) -> DataFrame:
    """Pretty-printed test sets, twenty conversations to a file, read with the positions as ids."""
    part = F.floor(F.col("conv_id") / 20).cast("bigint")
    row = F.struct("conv_id", "turn", F.col("text").alias("question"), F.col("role").alias("reference"), F.array(part.cast("string")).alias("context"))
    files = t.conversations.groupBy(part.alias("part")).agg(F.array_sort(F.collect_list(row)).alias("examples"))
    path = t.scratch("wrapped")
    files.select("part", F.to_json(F.struct("examples"), {"pretty": "true"}).alias("value")).write.partitionBy("part").text(path)
    mapped = readers.map_test_set(readers.read_test_set(t.spark, f"{path}/*"))
    return mapped.select("question_id", "question", "answer", F.col("context")[0].cast("bigint").alias("part"))


@query("split_choice", "SELECT conv_id, turn, text FROM conversations WHERE role = (SELECT min(role) FROM conversations)")
def split_choice(t: Tables) -> DataFrame:
    path = t.scratch("splits")
    t.conversations.withColumnRenamed("role", "split").write.partitionBy("split").parquet(path)
    return readers.read_split(t.spark, path).select("conv_id", "turn", "text")


@query("source_fallback", "SELECT 'local' AS source_used, role, count(*) AS n FROM conversations GROUP BY role")
def source_fallback(t: Tables) -> DataFrame:
    rows = readers.read_first({
        "hub": lambda: t.spark.read.parquet(t.scratch("absent")),
        "local": lambda: t.conversations,
    })
    return rows.groupBy("source_used", "role").agg(F.count(F.lit(1)).alias("n"))


@query("golden_corpus", """SELECT conv_id, turn, (generate_subscripts(string_split(text, chr(10)), 1) - 1)::INTEGER AS position, unnest(string_split(text, chr(10))) AS text FROM conversations WHERE role = 'assistant'""")
def golden_corpus(t: Tables) -> DataFrame:
    golden = t.conversations.filter("role = 'assistant'").select(
        "conv_id", "turn", F.lit("q").alias("user_input"), F.col("text").alias("reference"), F.split("text", "\n").alias("reference_contexts")
    )
    return readers.golden_corpus(readers.golden_set(golden), ["conv_id", "turn"])


@query("json_folder", "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events WHERE event_type <> 'click' GROUP BY event_type")
def json_folder(t: Tables) -> DataFrame:
    """Events written as JSON files; the files already processed (the clicks') are left out."""
    path = t.scratch("events")
    t.events.withColumn("kind", F.col("event_type")).write.partitionBy("kind").json(path)
    listed = readers.read_json_folder(t.spark, path, schemas.RUN_EVENT)
    processed = listed.filter("event_type = 'click'").select("file_path").distinct()
    fresh = readers.read_json_folder(t.spark, path, schemas.RUN_EVENT, processed=processed)
    return fresh.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("new_items", "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def new_items(t: Tables) -> DataFrame:
    return readers.new_items(t.documents.select("doc_id", "lang"), t.labels, "doc_id")


def passages(t: Tables, name: str) -> str:
    """The passages written as one text file each."""
    path = t.scratch(name)
    t.benchmark.select("item_id", "text").write.partitionBy("item_id").text(path)
    return path


def _item(path: str):
    return F.regexp_extract(path, "item_id=([0-9]+)/", 1).cast("bigint").alias("item_id")


@query("file_listing", """SELECT item_id, strlen(text) + 1 AS length, NULL AS warning FROM benchmark
UNION ALL SELECT max(item_id) + 1, 0, 'no content' FROM benchmark""")
def file_listing(t: Tables) -> DataFrame:
    """Listing of the passages' files and an empty one after them: sizes only, contents not read; the empty one is warned about."""
    path = passages(t, "listing")
    after = t.benchmark.agg(F.max("item_id") + 1).first()[0]
    place = t.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/item_id={after}/empty.txt")
    place.getFileSystem(t.spark._jsparkSession.sessionState().newHadoopConf()).create(place).close()
    files = readers.list_binary(t.spark, path, "*.txt")
    pages = readers.read_text_files(t.spark, f"{path}/*").select(F.element_at(F.split("source", "/"), -1).alias("file_name"), "page_content")
    warned = readers.files_without_content(files, pages).select("path", "warning")
    return files.join(warned, "path", "left").select(_item("path"), "length", "warning")


@query("text_directory", "SELECT item_id, md5(text || chr(10)) AS text_print FROM benchmark")
def text_directory(t: Tables) -> DataFrame:
    """The passages' files read back, one row per file."""
    read = readers.read_text_files(t.spark, f"{passages(t, 'texts')}/*")
    return read.select(_item("source"), F.md5("page_content").alias("text_print"))


ROW_PRINT = "md5(coalesce('=' || doc_id, '-') || chr(1) || coalesce('=' || text, '-') || chr(1) || coalesce('=' || lang, '-'))"


@query("folder_fingerprint", f"""SELECT source, count(*) AS n_rows, (sum(('0x' || substr({ROW_PRINT}, 1, 12))::BIGINT) % 4611686018427387904)::BIGINT AS digest_a,
(sum(('0x' || substr({ROW_PRINT}, 13, 12))::BIGINT) % 4611686018427387904)::BIGINT AS digest_b FROM documents GROUP BY source""")
def folder_fingerprint(t: Tables) -> DataFrame:
    """Fingerprint of the content of each source of the documents."""
    return readers.content_fingerprint(t.documents, ["source"], ["doc_id", "text", "lang"])


@query("changed_keys", """SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 'added' WHEN doc_id % 7 = 0 THEN 'removed' ELSE 'changed' END AS change
FROM documents WHERE (doc_id % 11 = 0 OR doc_id % 7 = 0 OR doc_id % 5 = 0) AND NOT (doc_id % 11 = 0 AND doc_id % 7 = 0)""")
def changed_keys(t: Tables) -> DataFrame:
    """Two loads of the documents: some are new, some gone, some have another text."""
    old = t.documents.filter("doc_id % 11 <> 0")
    edited = F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    new = t.documents.filter("doc_id % 7 <> 0").withColumn("text", edited)
    return readers.changed_keys(old, new, "doc_id", ["text"])


# --- sinks ---------------------------------------------------------------------------------------

EVENT_TEXT = "strftime(ts, '%Y-%m-%dT%H:%M:%S')"


@query("json_sink", f"SELECT event_id, event_type, {EVENT_TEXT} AS ts FROM events")
def json_sink(t: Tables) -> DataFrame:
    path = t.scratch("json")
    writers.save_json(t.events.select("event_id", "event_type", "ts"), path)
    return t.spark.read.schema("event_id bigint, event_type string, ts string").json(path)


@query("format_sink", """SELECT f AS format, count(*) AS n, sum(length(text))::BIGINT AS chars FROM documents, (SELECT unnest(['json', 'parquet', 'orc']) AS f) GROUP BY f""")
def format_sink(t: Tables) -> DataFrame:
    written = writers.save_formats(t.corpus, t.scratch("formats"), ["json", "parquet", "orc"])
    counted = [
        t.spark.read.format(path.rsplit("/", 1)[1]).schema("doc_id bigint, text string").load(path).agg(
            F.lit(path.rsplit("/", 1)[1]).alias("format"), F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")
        )
        for path in written
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@query("result_store", AGG_SQL + " SELECT retriever_type, 'r1' AS run_ts, success_rate, avg_latency_ms FROM agg")
def result_store(t: Tables) -> DataFrame:
    path = t.scratch("results")
    writers.store_results(aggregates(t), path, F.lit("r1"))
    back = t.spark.read.schema("retriever_type string, run_ts string, success_rate double, avg_latency_ms double").json(f"{path}/metrics")
    return back.select("retriever_type", "run_ts", "success_rate", "avg_latency_ms")


@query("comparison_csv", AGG_SQL + " SELECT retriever_type, success_rate, avg_latency_ms, avg_document_count FROM agg")
def comparison_csv(t: Tables) -> DataFrame:
    path = t.scratch("comparison")
    table = aggregates(t).select("retriever_type", "success_rate", "avg_latency_ms", "avg_document_count")
    writers.save_comparison(table, path)
    return t.spark.read.schema(table.schema).option("header", True).csv(path)


def document_records(t: Tables) -> DataFrame:
    """Documents in the library's form, with an empty value in some maps."""
    meta = _map(source=F.col("source"), lang=F.col("lang"), note=F.when(F.col("lang") == "en", "").otherwise(F.col("lang")))
    return t.spread("documents").select("doc_id", F.col("text").alias("page_content"), meta.alias("metadata"))


@query("hub_records", """SELECT md5(text) AS content_print, '{"lang":"' || lang || CASE WHEN lang = 'en' THEN '' ELSE '","note":"' || lang END || '","source":"' || source || '"}' AS metadata_json FROM documents""")
def hub_records(t: Tables) -> DataFrame:
    path = t.scratch("hub")
    writers.hub_records(document_records(t)).write.parquet(path)
    return t.spark.read.parquet(path).select(F.md5("page_content").alias("content_print"), "metadata_json")


@query("testset_sink", "SELECT count(*) AS written, 40::BIGINT * 0 + count(*) AS read_back FROM benchmark")
def testset_sink(t: Tables) -> DataFrame:
    path = t.scratch("testset")
    written = writers.save_test_set(t.benchmark, path)
    return t.spark.read.parquet(path).agg(F.lit(written).cast("bigint").alias("written"), F.count(F.lit(1)).alias("read_back"))


@query("metadata_csv", """SELECT doc_id, '{"lang":"' || lang || '","note":"' || CASE WHEN lang = 'en' THEN '' ELSE lang END || '","source":"' || source || '"}' AS metadata FROM documents""")
def metadata_csv(t: Tables) -> DataFrame:
    path = t.scratch("metadata")
    writers.save_metadata_csv(document_records(t).select("doc_id", "metadata"), path)
    return t.spark.read.schema("doc_id bigint, metadata string").options(header=True, quote='"', escape='"').csv(path)


# --- shaping -------------------------------------------------------------------------------------

@query("first_examples", "SELECT item_id, text FROM benchmark ORDER BY item_id LIMIT 10")
def first_examples(t: Tables) -> DataFrame:
    return readers.first_examples(t.benchmark, 10, "item_id")


@query("loader_enrichment", """SELECT page_id, 'web' AS loader_type, 'html' AS doc_type, url AS source_url, CASE WHEN contains(url, '?') THEN '2024-02-01 00:00:00' END AS load_timestamp FROM pages""")
def loader_enrichment(t: Tables) -> DataFrame:
    """Loader keys, and a load time only where a source is known."""
    source = F.when(F.contains("url", F.lit("?")), F.col("url"))
    docs = t.pages.select("page_id", "url", _map(source=source).alias("metadata"))
    enriched = shaping.enrich(docs, loader_type=F.lit("web"), doc_type=F.lit("html"), source_url=F.col("url"))
    stamped = shaping.stamp_loaded(enriched, F.lit("2024-02-01 00:00:00"))
    keys = ["loader_type", "doc_type", "source_url", "load_timestamp"]
    return stamped.select("page_id", *[F.try_element_at("metadata", F.lit(k)).alias(k) for k in keys])


SOURCES = "source || CASE lang WHEN 'en' THEN '.PDF' WHEN 'de' THEN '.docx' WHEN 'fr' THEN '.csv' ELSE ' at arxiv.org' END"


@query("standardise_inferred", f"""SELECT doc_id, {SOURCES} AS source, CASE lang WHEN 'en' THEN 'pdf' WHEN 'de' THEN 'word' WHEN 'fr' THEN 'tabular' ELSE 'scientific_paper' END AS document_type,
NULL::VARCHAR AS loader_type, NULL::VARCHAR AS url FROM documents""")
def standardise_inferred(t: Tables) -> DataFrame:
    docs = t.documents.select("doc_id", _map(file_path=F.expr(SOURCES)).alias("metadata"))
    flat = shaping.flatten(shaping.standardise_metadata(docs), ["doc_id"], content=None)
    return flat.select("doc_id", "source", "document_type", "loader_type", "url")


@query("standardise_web", """SELECT page_id, url AS source, url, 'web_page' AS document_type, 'WebBase' AS loader_type, (row_number() OVER (ORDER BY page_id) - 1)::VARCHAR AS chunk_id FROM pages""")
def standardise_web(t: Tables) -> DataFrame:
    docs = with_ordinal(t.pages.select("page_id", _map(url=F.col("url")).alias("metadata")), ["page_id"])
    done = shaping.standardise_metadata(docs, "WebBase", "ordinal")
    flat = shaping.flatten(done, ["page_id"], ["source", "url", "document_type", "loader_type", "chunk_id"], content=None, residual=False)
    return flat


@query("standardise_arxiv", """SELECT item_id, 'http://arxiv.org/abs/' || item_id AS url, item_id::VARCHAR AS arxiv_id, 'Title ' || item_id AS title, md5(text) AS abstract_print,
'scientific_paper' AS document_type, 'http://arxiv.org/abs/' || item_id AS source FROM benchmark""")
def standardise_arxiv(t: Tables) -> DataFrame:
    key = _text("item_id")
    meta = _map(entry_id=F.concat(F.lit("http://arxiv.org/abs/"), key), Title=F.concat(F.lit("Title "), key), Summary=F.col("text"))
    done = shaping.standardise_metadata(t.benchmark.select("item_id", meta.alias("metadata")), "ArxivLoader")
    flat = shaping.flatten(done, ["item_id"], ["url", "arxiv_id", "title", "abstract", "document_type", "source"], content=None, residual=False)
    return flat.withColumn("abstract_print", F.md5("abstract")).drop("abstract")


@query("standardise_pubmed", """SELECT conv_id, turn, 'https://pubmed.ncbi.nlm.nih.gov/' || conv_id || '/' AS url, conv_id::VARCHAR AS entry_id, CASE WHEN turn = 0 THEN 'kept' ELSE role END AS title,
'medical_paper' AS document_type, role AS journal FROM conversations""")
def standardise_pubmed(t: Tables) -> DataFrame:
    meta = _map(pmid=_text("conv_id"), article_title=F.col("role"), journal_title=F.col("role"), title=F.when(F.col("turn") == 0, "kept"))
    done = shaping.standardise_metadata(t.conversations.select("conv_id", "turn", meta.alias("metadata")), "PubMedLoader")
    return shaping.flatten(done, ["conv_id", "turn"], ["url", "entry_id", "title", "document_type", "journal"], content=None, residual=False)


@query("flatten_metadata", """SELECT doc_id, CASE WHEN length(text) > 120 THEN substr(text, 1, 120) || '...' ELSE text END AS page_content, source, NULL::VARCHAR AS title,
'{"lang":"' || lang || '","note":"' || CASE WHEN lang = 'en' THEN '' ELSE lang END || '"}' AS additional FROM documents""")
def flatten_metadata(t: Tables) -> DataFrame:
    flat = shaping.flatten(document_records(t), ["doc_id"], max_content=120)
    return flat.select("doc_id", "page_content", "source", "title", F.to_json(shaping.json_order(F.col("additional_metadata"))).alias("additional"))


@query("flatten_all_metadata", "SELECT doc_id, source, lang, CASE WHEN lang = 'en' THEN '' ELSE lang END AS note, NULL::VARCHAR AS journal FROM documents")
def flatten_all_metadata(t: Tables) -> DataFrame:
    return shaping.flatten_all(document_records(t), ["doc_id"], content=None).select("doc_id", "source", "lang", "note", "journal")


@query("testset_table", """SELECT conv_id, turn, substr(text, 1, 100) || '...' AS content, CASE WHEN role = 'system' THEN 'Unknown' ELSE role END AS source, turn::VARCHAR AS page FROM conversations""")
def testset_table(t: Tables) -> DataFrame:
    context = F.struct(
        F.col("text").alias("content"), F.when(F.col("role") != "system", F.col("role")).alias("source"),
        F.lit(None).cast("string").alias("title"), _text("turn").alias("page"),
    )
    rows = t.conversations.select("conv_id", "turn", F.lit("q").alias("question"), F.lit("a").alias("answer"), F.array(context).alias("contexts"))
    first = shaping.test_set_table(rows).withColumn("d", F.element_at("source_documents", 1))
    return first.select("conv_id", "turn", "d.content", "d.source", "d.page")


@query("pruned_metadata", """SELECT doc_id, '{"lang":"' || lang || CASE WHEN lang = 'en' THEN '' ELSE '","note":"' || lang END || '","source":"' || source || '"}' AS metadata_json FROM documents""")
def pruned_metadata(t: Tables) -> DataFrame:
    return document_records(t).select("doc_id", shaping.pruned_json(F.col("metadata")).alias("metadata_json"))


@query("serialisable_metadata", f"""SELECT event_id, '{{"event_type":"' || event_type || '","ts":"' || {EVENT_TEXT} || '","user_id":"' || user_id || '"}}' AS metadata_json FROM events""")
def serialisable_metadata(t: Tables) -> DataFrame:
    meta = shaping.serialisable(t.events, ["event_type", "ts", "user_id"])
    return t.events.select("event_id", F.to_json(meta).alias("metadata_json"))


@query("masked_values", """SELECT c_custkey, CASE WHEN length(c_name) <= 8 THEN repeat('*', length(c_name)) ELSE substr(c_name, 1, 4) || repeat('*', length(c_name) - 8) || right(c_name, 4) END AS name,
CASE WHEN length(c_mktsegment) <= 8 THEN repeat('*', length(c_mktsegment)) ELSE substr(c_mktsegment, 1, 4) || repeat('*', length(c_mktsegment) - 8) || right(c_mktsegment, 4) END AS segment FROM customer""")
def masked_values(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", mask(F.col("c_name")).alias("name"), mask(F.col("c_mktsegment")).alias("segment"))


@query("page_validity", """SELECT page_id, CASE WHEN url IS NULL OR trim(url) = '' THEN 'empty' WHEN NOT (starts_with(url, 'http://') OR starts_with(url, 'https://')) THEN 'not http' END AS problem,
coalesce(starts_with(url, 'http://') OR starts_with(url, 'https://'), false) AS valid FROM pages""")
def page_validity(t: Tables) -> DataFrame:
    return shaping.validity(t.pages.select("page_id", "url"), "url").drop("url")


REDACTED = """regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}', '<EMAIL>', 'g'),
'https?://[^ \\t\\n\\r<>\"]+', '<URL>', 'g'), '\\b[0-9]{1,3}\\.[0-9]{1,3}\\.[0-9]{1,3}\\.[0-9]{1,3}\\b', '<IP>', 'g'), '\\b[0-9]{3}-[0-9]{2}-[0-9]{4}\\b', '<SSN>', 'g'),
'\\+?[0-9]{1,3}[ -]\\(?[0-9]{3}\\)?[ -][0-9]{3}[ -][0-9]{4}', '<PHONE>', 'g')"""


@query("redacted_texts", f"SELECT doc_id, md5({REDACTED}) AS text_print, {REDACTED} <> text AS changed FROM documents")
def redacted_texts(t: Tables) -> DataFrame:
    done = t.corpus.withColumn("redacted", redact(F.col("text")))
    return done.select("doc_id", F.md5("redacted").alias("text_print"), (F.col("redacted") != F.col("text")).alias("changed"))


# --- chunking ------------------------------------------------------------------------------------

@query("fixed_windows", """SELECT doc_id, i::INTEGER AS chunk_id, md5(substr(text, (450 * i + 1)::BIGINT, 500)) AS chunk_print, (450 * i)::INTEGER AS start
FROM (SELECT doc_id, text, unnest(range(0, (greatest(length(text) - 50, 1) + 449) // 450)) AS i FROM documents)""")
def fixed_windows(t: Tables) -> DataFrame:
    chunks = chunking.fixed_windows(t.corpus, 500, 50, ["doc_id"])
    return chunks.select("doc_id", "chunk_id", F.md5("chunk_text").alias("chunk_print"), "start")


@query("token_windows", f"""SELECT doc_id, i::INTEGER AS chunk_id, md5(array_to_string(w[250 * i + 1:250 * i + 300], ' ')) AS chunk_print, (250 * i)::INTEGER AS start
FROM (SELECT doc_id, w, unnest(range(0, (greatest(len(w) - 50, 1) + 249) // 250)) AS i FROM (SELECT doc_id, {sql.words('text')} AS w FROM documents) WHERE len(w) > 0)""")
def token_windows(t: Tables) -> DataFrame:
    chunks = chunking.token_windows(t.corpus, 300, 50, ["doc_id"])
    return chunks.select("doc_id", "chunk_id", F.md5("chunk_text").alias("chunk_print"), "start")


@query("recursive_chunks")
def recursive_chunks(t: Tables) -> DataFrame:
    chunks = chunking.recursive_chunks(t.corpus, 500, 50)
    return chunks.select("doc_id", "chunk_id", F.length("chunk_text").alias("n_chars"), F.md5("chunk_text").alias("chunk_print"))


@query("recursive_chunk_checks", "SELECT doc_id, true AS short, true AS inside, true AS whole FROM documents WHERE trim(text) <> ''")
def recursive_chunk_checks(t: Tables) -> DataFrame:
    """What holds for the chunks of every text: none is longer than the size, each lies in the text, and the first and
    the last hold its two ends."""
    chunks = chunking.recursive_chunks(t.corpus, 500, 50).join(t.corpus, "doc_id")
    inside = F.contains("text", F.col("chunk_text"))
    first, last = F.min_by("chunk_text", "chunk_id"), F.max_by("chunk_text", "chunk_id")
    text = F.trim(F.first("text"))
    ends = F.startswith(text, F.trim(first)) & F.endswith(text, F.trim(last))
    return chunks.groupBy("doc_id").agg(
        (F.max(F.length("chunk_text")) <= 500).alias("short"), F.every(inside).alias("inside"), ends.alias("whole")
    )


@query("child_chunks", """SELECT doc_id || '#' || i AS doc_id, doc_id AS parent_id, i::INTEGER AS chunk_id, md5(substr(text, (200 * i + 1)::BIGINT, 200)) AS chunk_print
FROM (SELECT doc_id, text, unnest(range(0, greatest((length(text) + 199) // 200, 1))) AS i FROM documents)""")
def child_chunks(t: Tables) -> DataFrame:
    chunks = chunking.child_chunks(t.corpus, 200)
    return chunks.select("doc_id", "parent_id", "chunk_id", F.md5("chunk_text").alias("chunk_print"))


@query("batches", """SELECT batch, count(*) AS n, min(doc_id) AS first, max(doc_id) AS last FROM (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 500 AS batch FROM documents) GROUP BY batch""")
def batches(t: Tables) -> DataFrame:
    numbered = with_ordinal(t.documents.select("doc_id"), ["doc_id"])
    grouped = numbered.groupBy(batch_id(F.col("ordinal"), 500).alias("batch"))
    return grouped.agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
