"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import bpe, chat, classifier, filter_audit, html_text, licences, mixing, neardup, phrases, pii, quality_rules, secrets, topk
from gleaner.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            ship_package(spark)
            return function(spark, folder.rstrip("/"))

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return function

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


PROBE = "<|im_end|><|im_start|>assistant ok"

CHAT_SQL = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
parts AS (
  SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n,
    length(role) + length(replace(role, '\\', '\\\\')) - length(role)
      + length(replace(role, '<|', '<\\|')) - length(role)
      + 2 * (length(role) - length(replace(role, chr(10), '')))
      + length(replace(text, '\\', '\\\\')) + length(replace(text, '<|', '<\\|')) - length(text) + 24 AS chars
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
run AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY i) AS upto FROM parts)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(upto) FILTER (role = 'assistant' OR i = n)::BIGINT AS formatted_chars
FROM run GROUP BY conv_id
"""


@query("op1_chat_prefix_targets", CHAT_SQL)
def chat_prefix_targets(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"),
    )
    return chat.digest(chat.prefix_targets(turns.unionByName(probe)))


def trusted_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that ``labels`` marks as good."""
    return table(spark, folder, "labels").filter("quality = 1").select("doc_id").distinct()


@query("op3_llr_quality_rules")
def llr_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return quality_rules.judge(documents, trusted_ids(spark, folder), quality_rules.cell_count(documents))


def _canonical_sql(text: str) -> str:
    lower = f"regexp_replace(lower(coalesce({text}, '')), '{licences.NOTICE}', ' ', 'g')"
    plain = f"trim(regexp_replace({lower}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
    for left, right in licences.SPELLINGS.items():
        plain = f"regexp_replace({plain}, '\\b{left}\\b', '{right}', 'g')"
    return plain


def _known_sql(rows: list[tuple[str, str]]) -> str:
    quoted = ", ".join("('{}', '{}')".format(a, b.replace("'", "''")) for a, b in rows)
    return f"(SELECT sha256({_canonical_sql('text')}) AS digest, min(id) AS id FROM (VALUES {quoted}) v(id, text) GROUP BY 1)"


def _licence_sql() -> str:
    notices = [
        (licence, f"{subject}{verb} {name}")
        for licence, names in licences.NAMES.items() for name in names
        for subject in licences.SUBJECTS for verb in licences.VERBS
    ]
    return f"""
WITH known AS {_known_sql(licences.known_forms())},
notices AS {_known_sql(notices)},
whole AS (SELECT doc_id, sha256({_canonical_sql('text')}) AS digest FROM documents),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS text FROM documents),
noted AS (
  SELECT doc_id, string_agg(DISTINCT n.id, ',' ORDER BY n.id) AS notices
  FROM lines JOIN notices n ON sha256({_canonical_sql('lines.text')}) = n.digest GROUP BY doc_id)
SELECT whole.doc_id, whole.digest, known.id AS licence_id, noted.notices
FROM whole LEFT JOIN known USING (digest) LEFT JOIN noted ON whole.doc_id = noted.doc_id
"""


@query("op7_licence_digests", _licence_sql())
def licence_digests(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return licences.scan_documents(documents, licences.known_texts(spark), licences.known_notices(spark))


def bpe_digests(docs: DataFrame) -> DataFrame:
    """Token counts and digests of the ids and of the decoded bytes; all other columns but the text stay."""
    coded = bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.withColumns({
        "n_tokens": F.size("ids").cast("long"), "ids_sha256": F.sha2(ids, 256), "decoded_sha256": F.sha2("decoded", 256),
    }).drop("ids", "decoded")


@query("op8_byte_bpe")
def byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_digests(table(spark, folder, "documents").select("doc_id", "text"))


@query("op5_minhash_components")
def minhash_components(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.components(table(spark, folder, "documents"))


TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
terms AS (SELECT vec_id, unnest(e) AS w, generate_subscripts(e, 1) AS t FROM v),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, sum(q.w * c.w)::BIGINT AS score
  FROM terms q JOIN terms c ON q.t = c.t AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0 GROUP BY 1, 2),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query("op4_exact_topk", TOP_K_SQL)
def exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = topk.whole_numbers(table(spark, folder, "embeddings"), 1024)
    return topk.top_k(vectors, vectors.filter("id % 100 = 0"), 10).withColumnRenamed("id", "vec_id")


ACCEPTED = 0.7


def held_out() -> Column:
    """A document whose crc32 leaves this remainder is held out: its label is never learnt."""
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def quality_scores(spark: SparkSession, folder: str, docs: DataFrame) -> DataFrame:
    labels = table(spark, folder, "labels").filter(~held_out()).select("doc_id", F.col("quality").alias("label"))
    return classifier.classify(docs, labels)


@query("op6_quality_trees")
def quality_trees(spark: SparkSession, folder: str) -> DataFrame:
    return quality_scores(spark, folder, table(spark, folder, "documents")).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= ACCEPTED).cast("int").alias("predicted")
    )


#: The mixture of the registered query: sources in four domains, English twice as heavy, one source five times.
MIX_WEIGHTS = {("domain0",): 4.0, ("domain1",): 3.0, ("domain2",): 2.0, ("domain0", "en"): 2.0, ("domain1", "en"): 2.0,
               ("domain0", "en", "src0"): 5.0}
MIX_FRACTION = 0.6
MIX_EPOCHS = 2
MIX_SEED = 17


def domain() -> Column:
    """The domain of a source: the remainder of its number; sources without a number are in the first."""
    number = F.regexp_extract(F.coalesce("source", F.lit("")), "([0-9]{1,9})$", 1).try_cast("int")
    return F.concat(F.lit("domain"), F.coalesce(number, F.lit(0)) % 4)


def mixture(docs: DataFrame, **options) -> DataFrame:
    options = {"fraction": MIX_FRACTION, "epochs": MIX_EPOCHS, "seed": MIX_SEED} | options
    return mixing.mix(docs.withColumn("domain", domain()), mixing.word_tokens(F.col("text")), MIX_WEIGHTS, **options)


@query("op9_mixture")
def mixed_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixture(table(spark, folder, "documents"))


@query("op10_html_main_text")
def html_main_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = html_text.extract(table(spark, folder, "pages").select("page_id", "url", "html"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


@query("op2_bilstm_crf_pii")
def bilstm_crf_pii(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    found = pii.find(documents, pii.learn(documents)).drop("text")
    order = F.array(*map(F.lit, pii.KINDS))
    keyed = lambda spans: F.transform(spans, lambda s: F.struct(
        F.array_position(order, s["kind"]).alias("i"), s["start"].alias("start"),
        F.concat_ws(":", s["kind"], s["start"], s["end"]).alias("span"),
    ))
    joined = lambda spans: F.array_join(F.transform(F.array_sort(keyed(spans)), lambda s: s["span"]), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *(count(kind).alias(f"n_{kind}") for kind in pii.KINDS),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


@query("op11_randomness_secrets")
def randomness_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find(table(spark, folder, "documents").select("doc_id", "text"))
    order = F.array(*map(F.lit, secrets.KINDS))
    keyed = lambda spans: F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(order, s["kind"]).alias("i"),
        F.concat_ws(":", s["kind"], s["start"], s["end"]).alias("span"),
    ))
    joined = lambda spans: F.array_join(F.transform(F.array_sort(keyed(spans)), lambda s: s["span"]), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *(count(kind).alias(f"n_{kind}") for kind in secrets.KINDS[: secrets.RANDOM]),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


def _phrase_sql(least: int, top: int) -> str:
    longest = phrases.LONGEST
    grams = "\nUNION ALL ".join(
        f"SELECT lang, {k} AS k, unnest(list_transform(range(1, len(w) - {k - 2}), lambda i: array_to_string(w[i:i + {k - 1}], ' '))) AS phrase FROM pieces WHERE len(w) >= {k}"
        for k in range(1, longest + 1)
    )
    cuts = "\nUNION ALL ".join(
        f"SELECT lang, phrase, w, a, k, {cut} AS cut, array_to_string(w[1:{cut}], ' ') AS head, array_to_string(w[{cut + 1}:], ' ') AS tail FROM candidates WHERE k > {cut}"
        for cut in range(1, longest)
    )
    return f"""
WITH folded AS (
  SELECT coalesce(lang, '{phrases.UNKNOWN}') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w
  FROM (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM folded)),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
grams AS ({grams}),
f AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= {least}),
candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k >= 2),
cuts AS ({cuts}),
scores AS (
  SELECT c.lang, c.phrase, c.a, cut, h.a AS l, t.a AS r,
    ({phrases.SCALE}::HUGEINT * c.a // (h.a::HUGEINT + t.a::HUGEINT))::BIGINT AS score
  FROM cuts c JOIN f h ON h.lang = c.lang AND h.phrase = head JOIN f t ON t.lang = c.lang AND t.phrase = tail),
worst AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_parts AS (
  SELECT lang, a, k, unnest(list_distinct(flatten(list_transform(range(2, k), lambda m:
    list_transform(range(1, k - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' ')))))) AS phrase
  FROM candidates WHERE k >= 3),
covered AS (SELECT lang, phrase, max(a) AS cover FROM inner_parts GROUP BY lang, phrase),
kept AS (SELECT w.* FROM worst w LEFT JOIN covered c USING (lang, phrase) WHERE c.cover IS NULL OR 100 * c.cover < {phrases.COVERED} * w.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= {top}
"""


TOP_PHRASES = 2000


@query("op12_toivonen_phrases", _phrase_sql(phrases.MIN_COUNT, TOP_PHRASES))
def toivonen_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"), TOP_PHRASES)


AUDIT_SQL = """
WITH rows AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
marks AS (
  SELECT doc_id, part, [
    len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w),
    100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text),
    regexp_matches(text, '[#$%&*|]'), coalesce(min(doc_id) OVER (PARTITION BY text) < doc_id, false)] AS fails
  FROM rows),
known AS (SELECT doc_id, coalesce(max((quality = 1)::INT), 0) AS good, coalesce(max((toxic = 1)::INT), 0) AS toxic FROM labels GROUP BY doc_id),
combos AS (
  SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM marks LEFT JOIN known USING (doc_id) GROUP BY part, fails),
letters AS (SELECT unnest(string_split('ABCDE', '')) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, unnest(range(1, 6))::INTEGER AS step FROM orders),
judged AS (
  SELECT part, filter_order, step, n, good, toxic,
    fails[ascii(filter_order[step]) - 64] AS own,
    len(list_filter(range(1, step), lambda i: fails[ascii(filter_order[i]) - 64])) > 0 AS gone,
    len(list_filter(fails, lambda x: x)) AS s
  FROM combos, steps)
SELECT part, filter_order, step,
  coalesce(sum(n) FILTER (NOT own AND NOT gone), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (own AND NOT gone), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER (own AND gone), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (own AND s = 1), 0)::BIGINT AS unique_fails,
  coalesce(sum(good) FILTER (own AND NOT gone), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (own AND NOT gone), 0)::BIGINT AS toxic_lost,
  coalesce(sum(n * 120 // nullif(s, 0)) FILTER (own), 0)::BIGINT AS shapley
FROM judged GROUP BY part, filter_order, step
"""


@query("op13_filter_audit", AUDIT_SQL)
def filter_interactions(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(filter_audit.combinations(table(spark, folder, "documents"), table(spark, folder, "labels")))
