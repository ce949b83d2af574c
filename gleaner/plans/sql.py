"""Shared pieces of the SQL counterparts."""

from __future__ import annotations

QUESTIONS = "SELECT item_id AS query_id, text FROM benchmark"
CORPUS = "SELECT doc_id, text FROM documents"


def words(text: str) -> str:
    return f"list_filter(string_split_regex({text}, '[ \\t\\n\\r]+'), lambda w: w <> '')"


def strip(text: str) -> str:
    return f"regexp_replace({text}, '^[ \\t\\n\\r]+|[ \\t\\n\\r]+$', '', 'g')"


def sentences(text: str) -> str:
    parts = f"string_split(regexp_replace({text}, '([.?!])[ \\t\\n\\r]+', '\\1' || chr(1), 'g'), chr(1))"
    return f"list_filter(list_transform({parts}, lambda s: {strip('s')}), lambda s: s <> '')"


def idf(p: str, corpus: str = CORPUS) -> str:
    """CTEs ending in ``{p}idf(term, df, idf)``."""
    return f"""
{p}c AS MATERIALIZED (SELECT doc_id, {words('text')} AS w FROM ({corpus})),
{p}tok AS (SELECT doc_id, unnest(w) AS term FROM {p}c),
{p}dl AS (SELECT doc_id, len(w) AS dl FROM {p}c),
{p}st AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM {p}dl),
{p}df AS (SELECT term, count(DISTINCT doc_id) AS df FROM {p}tok GROUP BY term),
{p}raw AS MATERIALIZED (SELECT term, df, ln(n - df + 0.5) - ln(df + 0.5) AS w FROM {p}df, {p}st),
{p}mean AS (SELECT avg(w) AS mean FROM {p}raw),
{p}idf AS (SELECT term, df, CASE WHEN w < 0 THEN 0.25 * mean ELSE w END AS idf FROM {p}raw, {p}mean)"""


def bm25(p: str, k: int, corpus: str = CORPUS, queries: str = QUESTIONS) -> str:
    """CTEs ending in ``{p}hits(query_id, doc_id, score, rank)``."""
    return f"""{idf(p, corpus)}, {p}q AS ({queries}),
{p}qt AS (SELECT query_id, term, count(*) AS qtf FROM (SELECT query_id, unnest({words('text')}) AS term FROM {p}q) GROUP BY ALL),
{p}tf AS (SELECT doc_id, term, count(*) AS tf FROM {p}tok WHERE term IN (SELECT term FROM {p}qt) GROUP BY ALL),
{p}sc AS (SELECT query_id, doc_id, round(sum(qtf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))), 6) AS score
  FROM {p}qt JOIN {p}idf USING (term) JOIN {p}tf USING (term) JOIN {p}dl USING (doc_id), {p}st GROUP BY ALL),
{p}hits AS (SELECT query_id, doc_id, score, rank FROM (SELECT *, row_number() OVER (
  PARTITION BY query_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM {p}sc WHERE score > 0) WHERE rank <= {k})"""


def buckets(p: str, key: str, source: str, text: str = "text", dims: int = 64) -> str:
    """CTEs ending in ``{p}vec({key}, b, x)``: the non-zero entries of the hashed unit vectors."""
    return f"""
{p}b AS (SELECT {key}, ('0x' || substr(md5(t), 1, 8))::BIGINT % {dims} AS b, count(*)::DOUBLE AS n
  FROM (SELECT {key}, unnest({words(text)}) AS t FROM ({source})) GROUP BY ALL),
{p}n AS (SELECT {key}, sqrt(sum(n * n)) AS len FROM {p}b GROUP BY ALL),
{p}vec AS (SELECT {key}, b, n / len AS x FROM {p}b JOIN {p}n USING ({key}))"""


def dense(p: str, k: int, corpus: str = CORPUS, queries: str = QUESTIONS, text: str = "text") -> str:
    """CTEs ending in ``{p}hits``: cosine top-k of hashed vectors."""
    return f"""{buckets(p + 'd', 'doc_id', corpus, text)},{buckets(p + 'q', 'query_id', queries)},
{p}pair AS (SELECT query_id, doc_id FROM (SELECT DISTINCT query_id FROM {p}qvec), (SELECT doc_id FROM ({corpus}))),
{p}pos AS (SELECT query_id, doc_id, sum(q.x * d.x) AS s FROM {p}qvec q JOIN {p}dvec d USING (b) GROUP BY ALL),
{p}hits AS (SELECT query_id, doc_id, score, rank FROM (SELECT query_id, doc_id, score, row_number() OVER (
  PARTITION BY query_id ORDER BY score DESC, doc_id)::INTEGER AS rank
  FROM (SELECT query_id, doc_id, round(coalesce(s, 0), 6) AS score FROM {p}pair LEFT JOIN {p}pos USING (query_id, doc_id)))
  WHERE rank <= {k})"""


QRELS = "SELECT item_id AS query_id, doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)"
