"""Sources: CSV reviews, binary listings, text, HTML, JSON test sets and graphs, split exports, increments."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner import schemas
from gleaner.sources import json_split
from gleaner.functions.text import html_text, html_title


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_csv_documents(
    spark: SparkSession, paths: list[str], schema: T.StructType, metadata: list[str] | None = None,
    path_pattern: str = "([^/]*)$", title: str = "$1", quoted_newlines: bool = False,
) -> DataFrame:
    """CSV files to documents: named columns become metadata, the rest ``name: value`` content lines.

    Missing paths are skipped. ``title`` is made from the file path by ``path_pattern``, and ``part``
    is the pattern's number in it. A rating that is not a number is quarantined in ``bad_rating``. Files are split
    between tasks unless ``quoted_newlines`` says that a quoted value may hold a line feed.
    """
    named = metadata or schemas.REVIEW_METADATA
    present = [path for path in paths if _exists(spark, path)]
    raw = (
        spark.read.schema(schema)
        .options(header=True, multiLine=quoted_newlines, quote='"', escape='"')
        .csv(present)
        .withColumn("path", F.col("_metadata.file_path"))
    )
    content = [name for name in schema.names if name not in named]
    lines = [F.concat(F.lit(f"{name}: "), F.coalesce(F.col(name), F.lit(""))) for name in content]
    rating = F.expr("try_cast(Rating as int)")
    return raw.select(
        F.concat_ws("\n", *lines).alias("page_content"),
        *[F.col(name) for name in named if name != "Rating"],
        F.coalesce(rating, F.lit(0)).alias("Rating"),
        F.when(rating.isNull() & (F.trim("Rating") != ""), F.col("Rating")).alias("bad_rating"),
        F.regexp_replace(F.regexp_extract("path", path_pattern, 0), path_pattern, title).alias("Movie_Title"),
        F.expr(f"try_cast(regexp_extract(path, '{path_pattern}', 1) as int)").alias("part"),
    )


def shifted_access(docs: DataFrame, as_of: Column, parts: int) -> DataFrame:
    """Access time per file: ``as_of`` minus one day for each file after it."""
    days = F.lit(parts) - F.col("part")
    return docs.withColumn("last_accessed_at", as_of - F.make_dt_interval(days))


def list_binary(spark: SparkSession, path: str, glob: str = "*.pdf", fingerprint: bool = False) -> DataFrame:
    """Files of a folder with size and change time. Contents are read only for fingerprints.

    The scan leaves out files of zero bytes; they are added from the list of files that Spark made for the scan, with a
    length of 0 and no change time.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    found = files.select("path", "length", "modificationTime", *(["content"] if fingerprint else []))
    listed = spark.createDataFrame([(url,) for url in files.inputFiles()], "url string")
    # The list has encoded addresses; the scan has paths, without an empty authority.
    decoded = F.url_decode(F.replace("url", F.lit("+"), F.lit("%2B")))
    paths = listed.select(F.regexp_replace(decoded, "^file:/+", "file:/").alias("path"))
    empty = paths.join(found.select("path"), "path", "left_anti").select(
        "path", F.lit(0).cast("bigint").alias("length"), F.lit(None).cast("timestamp").alias("modificationTime"),
        *([F.lit(b"").alias("content")] if fingerprint else []),
    )
    columns = [
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("length"),
        F.col("modificationTime").alias("modified"),
        F.col("path"),
    ]
    if fingerprint:
        columns.append(F.sha2("content", 256).alias("sha256"))
    return found.unionByName(empty).select(*columns)


def files_without_content(files: DataFrame, pages: DataFrame) -> DataFrame:
    """Listed files that gave no page with text: ``pages(file_name, page_content)``."""
    filled = pages.filter(F.trim("page_content") != "").select("file_name")
    return files.join(filled, "file_name", "left_anti").withColumn("warning", F.lit("no content"))


def folder_fingerprint(files: DataFrame) -> DataFrame:
    """One digest per folder state, independent of order and combined without collecting the names.

    Two sums of hashes of the whole path, size and change time: files that swap places or cancel out in one of them
    show in the other.
    """
    facts = [F.col("path"), F.col("length"), F.col("modified")]
    add = lambda h: F.sum(h.cast("decimal(38,0)"))
    return files.agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"),
        F.sha2(F.concat_ws("|", add(F.xxhash64(*facts)), add(F.xxhash64(F.lit(1), *facts))), 256).alias("digest"),
    )


def row_digest(columns: list[str]) -> Column:
    """The md5 of a row's columns; NULL differs from every text."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.md5(F.concat_ws("\u0001", *parts))


def content_fingerprint(rows: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Row count and order-independent digest of the content of each group of rows."""
    def half(start: int) -> Column:
        number = F.conv(F.substring(row_digest(columns), start, 12), 16, 10).cast("decimal(38,0)")
        return (F.sum(number) % F.lit(1 << 62)).cast("bigint")

    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), half(1).alias("digest_a"), half(13).alias("digest_b"))


def changed_keys(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``(key, change)`` of the keys that were added, removed or changed between two loads."""
    before = old.select(key, row_digest(columns).alias("before"))
    after = new.select(key, row_digest(columns).alias("after"))
    change = F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "removed").otherwise("changed")
    return before.join(after, key, "full").filter(~F.col("before").eqNullSafe(F.col("after"))).select(key, change.alias("change"))


def read_text_files(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """One row per text file."""
    return (
        spark.read.option("pathGlobFilter", glob).text(path, wholetext=True)
        .select(F.col("_metadata.file_path").alias("source"), F.col("value").alias("page_content"))
    )


def html_documents(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Adds ``title`` and ``page_content`` of an HTML column."""
    return pages.withColumns({"title": html_title(F.col(html)), "page_content": html_text(F.col(html))})


def summaries_by_id(dump: DataFrame, wanted: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows of the wanted ids, and the wanted ids that are not in the dump."""
    ids = wanted.select(key).distinct()
    return dump.join(ids, key, "left_semi"), ids.join(dump.select(key), key, "left_anti")


def read_test_set(spark: SparkSession, path: str) -> DataFrame:
    """Test-set rows of JSON files ``{"examples": [...]}``, pretty-printed or not, one object per file.

    ``position`` counts the examples of a file from 0. Malformed files fail the job.
    """
    raw = spark.read.schema(schemas.TEST_SET_FILE).option("multiLine", True).option("mode", "FAILFAST").json(path)
    return raw.select(F.posexplode("examples").alias("position", "row")).select("position", "row.*")


def read_test_lines(spark: SparkSession, path: str) -> DataFrame:
    """Test-set rows of JSON-lines files, one example per line; splittable.

    Lines have no order, so ``position`` is NULL and a missing id becomes a digest of the content. Malformed lines
    fail the job.
    """
    rows = spark.read.schema(schemas.TEST_SET_ROW).option("mode", "FAILFAST").json(path)
    content = F.sha2(F.to_json(F.struct(*[name for name in rows.columns if name != "id"])), 256)
    return rows.withColumn("id", F.coalesce("id", content)).select(F.lit(None).cast("int").alias("position"), "*")


def map_test_set(rows: DataFrame) -> DataFrame:
    """One mapping for every source: ``(question_id, question, context, answer)``."""
    return rows.select(
        F.coalesce("id", F.col("position").cast("string")).alias("question_id"),
        F.coalesce("text", "question", "user_input").alias("question"),
        F.coalesce("context", "documents", "reference_contexts", F.array().cast("array<string>")).alias("context"),
        F.coalesce("answer", "reference", F.try_element_at("answers.text", F.lit(1)), F.lit("")).alias("answer"),
    )


def first_examples(rows: DataFrame, limit: int, order: str = "position") -> DataFrame:
    """The first ``limit`` rows; 0 keeps all."""
    return rows.orderBy(order).limit(limit) if limit else rows


def read_split(spark: SparkSession, base: str, preferred: str = "train", column: str = "split") -> DataFrame:
    """One split of an exported dataset (``base/split=*``): the preferred one, else the first by name."""
    exported = spark.read.parquet(base)
    names = [row[0] for row in exported.select(column).distinct().orderBy(column).collect()]
    chosen = preferred if preferred in names else names[0]
    return exported.filter(F.col(column) == chosen)


def read_first(sources: dict[str, Callable[[], DataFrame]]) -> DataFrame:
    """The first source that can be read, with its name in ``source_used``."""
    failure: Exception | None = None
    for name, read in sources.items():
        try:
            return read().withColumn("source_used", F.lit(name))
        except AnalysisException as error:
            failure = error
    raise ValueError("no source could be read") from failure


def golden_set(rows: DataFrame) -> DataFrame:
    """Check the golden columns; ``reference_contexts`` is optional and empty when absent."""
    missing = [name for name in ("user_input", "reference") if name not in rows.columns]
    if missing:
        raise ValueError(f"golden set lacks columns: {', '.join(missing)}")
    empty = F.array().cast("array<string>")
    contexts = empty
    if "reference_contexts" in rows.columns:
        contexts = F.col("reference_contexts")
        if rows.schema["reference_contexts"].dataType.typeName() != "array":
            contexts = F.array(contexts.cast("string"))
    return rows.withColumn("reference_contexts", F.coalesce(contexts, empty))


def golden_corpus(golden: DataFrame, keys: list[str]) -> DataFrame:
    """The corpus of a golden set: its contexts, one per row."""
    return golden.select(*keys, F.posexplode("reference_contexts").alias("position", "text")).withColumn(
        "text", F.col("text").cast("string")
    )


def read_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and relationships of ``path/nodes`` and ``path/relationships`` (JSON lines).

    A missing folder fails at once; a broken line fails the job that reads it.
    """
    def read(name: str, schema: T.StructType) -> DataFrame:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(f"{path}/{name}")

    return read("nodes", schemas.NODE), read("relationships", schemas.RELATIONSHIP)


def read_graph_file(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and relationships of JSON files ``{"nodes": [...], "relationships": [...]}``; many tasks read one file.

    A file that is cut off fails at once, a broken record fails the job that reads it.
    """
    lists = json_split.record_lists(spark, path)
    return json_split.records(lists, "nodes", schemas.NODE), json_split.records(lists, "relationships", schemas.RELATIONSHIP)


def read_json_folder(
    spark: SparkSession, path: str, schema: T.StructType, glob: str = "*.json", processed: DataFrame | None = None
) -> DataFrame:
    """JSON rows of a folder with their file. Files named in ``processed(file_path)`` are left out before the read."""
    reader = spark.read.schema(schema).option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    paths: str | list[str] = path
    if processed is not None:
        listed = list_binary(spark, path, glob).select(_plain_path("path").alias("file_path"))
        fresh = listed.join(processed.select(_plain_path("file_path").alias("file_path")), "file_path", "left_anti")
        # Names only, as the reader's own listing holds them.
        paths = [row.file_path for row in fresh.collect()]
    rows = reader.json(paths) if paths else spark.createDataFrame([], schema).withColumns(
        {"file_path": F.lit(None).cast("string"), "file_size": F.lit(None).cast("bigint")}
    )
    if not paths:
        return rows
    return rows.select("*", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size"))


def _plain_path(column: str) -> Column:
    """A file path with one slash after its scheme where it names no host."""
    return F.regexp_replace(column, "^(\\w+):///", "$1:/")


def new_items(items: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Items whose key the target does not hold yet."""
    return items.join(existing.select(key), key, "left_anti")
