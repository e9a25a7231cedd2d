"""Inputs and SQL building blocks that the registered queries share.

The SQL starts from the raw tables and states each step in its own way (windows,
QUALIFY, lateral series) rather than repeating the Spark expressions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.operators.fields import FieldRule, GateRule
from leafmill.plans.adapters import documents_as_files, web_pages_as_files
from leafmill.plans.answers import questions
from leafmill.plans.corpus import page_chunks
from leafmill.sources.files import spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents_as_files(spread(table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")))


def web_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web_pages_as_files(spread(table(spark, sf_dir, "pages").select("url", "html")))


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_chunks(files(spark, sf_dir))


def asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions(table(spark, sf_dir, "benchmark"), "item_id", "text")


CODE_PATTERN = r"\b(\d{3}-\d{4})\b"

# Rules for text found in the landed documents; the substation rules have none there.
GENERIC_RULES = (
    FieldRule("license", (r"(?i)licensed under (?:the )?([^\n]*[^\n.])",)),
    FieldRule("version", (r"(?i)\bversion (\d+(?:\.\d+)?)",), "double"),
    FieldRule("account", (r"\b(\d{16})\b",)),
    FieldRule("address", (r"\b(\d{1,3}(?:\.\d{1,3}){3})\b",)),
    FieldRule("codes", (CODE_PATTERN,), "list"),
    FieldRule("extension", (r"\b\d{3}-(\d{4})\b",), "int"),
    FieldRule("email", (r"([\w.+-]+@[\w-]+\.[\w.]*\w)",)),
)


def generic_gate() -> list[GateRule]:
    return [
        ("study without license", (F.col("source_kind") == "protection_study") & F.col("license").isNull()),
        ("no code or address", F.col("address").isNull() & (F.size("codes") == 0)),
    ]


# SQL: documents as files, lines, pages, canonical pages, chunks.
CORPUS_STEPS = {
    "files": """{p}files AS (
  SELECT '/corpus/' || source || '/' || doc_id AS path,
         sha256('/corpus/' || source || '/' || doc_id) AS did,
         CASE source WHEN 'src0' THEN 'oneline' WHEN 'src1' THEN 'protection_study' ELSE 'unknown' END AS kind,
         source, lang, doc_id AS raw_id, text
  FROM {documents})""",
    "lines": """{p}lines AS (
  SELECT path, did, kind, source, raw_id, lang, pos, line
  FROM (SELECT path, did, kind, source, raw_id, lang,
               unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
        FROM {p}files)
  WHERE line <> '')""",
    "pages": """{p}page_rows AS (
  SELECT path, did, kind, source, raw_id, lang, CAST(pos // 20 + 1 AS INTEGER) AS page,
         string_agg(line, chr(10) ORDER BY pos) AS body
  FROM {p}lines GROUP BY ALL)""",
    "canon": """{p}canon AS (
  SELECT * FROM {p}page_rows
  QUALIFY path = min(path) OVER (PARTITION BY sha256(body)))""",
    "chunks": """{p}chunk_rows AS (
  SELECT did || '_' || page || '_' || i AS chunk_id, did, path, kind, source, page,
         CAST(i AS INTEGER) AS idx, substr(body, CAST(i * 1000 + 1 AS BIGINT), 1200) AS body
  FROM (SELECT *, unnest(range(greatest(CAST(ceil(length(body) / 1000.0) AS BIGINT), 1))) AS i FROM {p}canon)
  WHERE length(substr(body, CAST(i * 1000 + 1 AS BIGINT), 1200)) > 0)""",
}


def corpus_sql(last: str, prefix: str = "", documents: str = "documents") -> str:
    """CTEs up to the named step, from the documents table or a subquery."""
    names = list(CORPUS_STEPS)
    return ",\n".join(
        CORPUS_STEPS[n].format(p=prefix, documents=documents) for n in names[: names.index(last) + 1]
    )


FILES_SQL = corpus_sql("files")
LINES_SQL = corpus_sql("lines")
PAGES_SQL = corpus_sql("pages")
CANON_SQL = corpus_sql("canon")
CHUNKS_SQL = corpus_sql("chunks")

# SQL: web pages cut into tags and text; each block tag starts a new run of text.
WEB_SQL = r"""web_tokens AS (
  SELECT url, unnest(t) AS token, generate_subscripts(t, 1) AS seq
  FROM (SELECT url, regexp_extract_all(
          regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<head\b[^>]*>.*?</head>', '', 'g'),
          '</?[A-Za-z][^>]*>|[^<]+|<') AS t FROM pages)),
web_marked AS (
  SELECT url, token, seq, regexp_matches(token, '^</?[A-Za-z][^>]*>$') AS is_tag,
         lower(regexp_extract(token, '^</?([A-Za-z][A-Za-z0-9]*)', 1)) AS name
  FROM web_tokens),
web_runs AS (
  SELECT *, is_tag AND NOT list_contains(string_split('a abbr b bdi bdo cite code del dfn em font i ins kbd mark q s samp small span strong sub sup time tt u var wbr', ' '), name) AS cuts
  FROM web_marked),
web_placed AS (
  SELECT *, CAST(count(CASE WHEN cuts THEN 1 END) OVER (PARTITION BY url ORDER BY seq) AS INTEGER) AS pos FROM web_runs),
web_elements AS (
  SELECT url, pos,
         coalesce(max(CASE WHEN cuts AND token NOT LIKE '</%' THEN name END), 'text') AS kind,
         replace(replace(replace(replace(replace(
           trim(regexp_replace(coalesce(string_agg(CASE WHEN NOT is_tag THEN token END, '' ORDER BY seq), ''), '[ \t\r\n\f]+', ' ', 'g')),
           '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&') AS body
  FROM web_placed GROUP BY url, pos)"""

TOKENS_SQL = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}]+(?:-[\p{{L}}\p{{N}}]+)*')"

TERMS_SQL = (
    CHUNKS_SQL
    + f""",
toks AS (SELECT chunk_id, unnest({TOKENS_SQL.format("body")}) AS term FROM chunk_rows),
postings AS (SELECT term, chunk_id, CAST(count(*) AS INTEGER) AS tf FROM toks GROUP BY ALL),
lens AS (
  SELECT c.chunk_id, CAST(count(t.term) AS INTEGER) AS len
  FROM chunk_rows c LEFT JOIN toks t USING (chunk_id) GROUP BY 1)"""
)

QUERY_TERMS_SQL = f"""qtoks AS (SELECT item_id AS query_id, unnest({TOKENS_SQL.format("text")}) AS term FROM benchmark),
qterms AS (SELECT DISTINCT query_id, term FROM qtoks)"""

KEYWORD_SQL = (
    TERMS_SQL
    + ",\n"
    + QUERY_TERMS_SQL
    + """,
dfs AS (SELECT term, count(*) AS df FROM postings GROUP BY 1),
tot AS (SELECT count(*) AS n, avg(len) AS mean FROM lens),
kw_scores AS (
  SELECT q.query_id, p.chunk_id,
         round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / mean))), 6) AS score
  FROM qterms q JOIN postings p USING (term) JOIN dfs USING (term) JOIN lens USING (chunk_id), tot
  GROUP BY ALL),
kw AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS pos FROM kw_scores)"""
)

VECTORS_SQL = """vec AS (
  SELECT chunk_id, b, n / sqrt(sum(n * n) OVER (PARTITION BY chunk_id)) AS w
  FROM (SELECT chunk_id, CAST(CAST('0x' || left(md5(term), 8) AS BIGINT) % 1024 AS INTEGER) AS b, count(*) AS n
        FROM toks GROUP BY ALL))"""

SEMANTIC_SQL = (
    VECTORS_SQL
    + """,
qvec AS (
  SELECT query_id, b, n / sqrt(sum(n * n) OVER (PARTITION BY query_id)) AS w
  FROM (SELECT query_id, CAST(CAST('0x' || left(md5(term), 8) AS BIGINT) % 1024 AS INTEGER) AS b, count(*) AS n
        FROM qtoks GROUP BY ALL)),
sem_scores AS (
  SELECT q.query_id, v.chunk_id, round(sum(q.w * v.w), 6) AS score
  FROM qvec q JOIN vec v USING (b) GROUP BY ALL),
sem AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS pos FROM sem_scores)"""
)

HYBRID_SQL = (
    KEYWORD_SQL
    + ",\n"
    + SEMANTIC_SQL
    + """,
fused AS (
  SELECT coalesce(k.query_id, s.query_id) AS query_id, coalesce(k.chunk_id, s.chunk_id) AS chunk_id,
         round(coalesce(1.0::DOUBLE / (60 + k.pos), 0) + coalesce(1.0::DOUBLE / (60 + s.pos), 0), 9) AS score
  FROM (SELECT * FROM kw WHERE pos <= 50) k
  FULL JOIN (SELECT * FROM sem WHERE pos <= 50) s ON k.query_id = s.query_id AND k.chunk_id = s.chunk_id),
best AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS pos FROM fused)
  WHERE pos <= 6),
hits AS (
  SELECT b.query_id, b.pos, b.chunk_id, c.did, c.path, c.kind, c.page, c.body, b.score
  FROM best b JOIN chunk_rows c USING (chunk_id))"""
)

TURNS_SQL = """talks AS (
  SELECT sha256('/transcripts/' || conv_id || '/' || part) AS debrief_id,
         '/transcripts/' || conv_id || '/' || part AS path, conv_id, part,
         string_agg(line, chr(10) ORDER BY turn, line) AS transcript
  FROM (SELECT *, CAST((row_number() OVER (PARTITION BY conv_id ORDER BY turn, line) - 1) // 1000 + 1 AS INTEGER) AS part
        FROM (SELECT DISTINCT conv_id, turn, role || ': ' || coalesce(text, '') AS line FROM conversations))
  GROUP BY conv_id, part)"""
