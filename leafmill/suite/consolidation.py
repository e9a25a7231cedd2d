"""Copies, joins, sources, chunks, transcripts, changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafmill.operators.chunks import apply_changes, chunk_text, diff_chunks, union_chunks
from leafmill.operators.consolidate import attach_fields, attach_fields_inline, attach_region, merge_sources
from leafmill.operators.debriefs import debrief_chunks, parse_header, structure, with_prompt
from leafmill.operators.evaluate import kind_counts
from leafmill.operators.fields import FieldRule, extract_fields, split_gate
from leafmill.operators.keyword import build_index, refresh_index
from leafmill.operators.pages import assemble_pages, canonical_copies, line_pages
from leafmill.operators.security import mask, register_functions, row_filter
from leafmill.operators.vectors import text_vectors, vector_changes
from leafmill.plans.adapters import documents_as_files, transcripts_as_files
from leafmill.plans.corpus import canonical_pages, corpus_chunks, fielded_chunks, page_chunks
from leafmill.session import stage
from leafmill.sources.elements import html_elements
from leafmill.sources.files import spread
from leafmill.sources.transcripts import assemble_transcripts
from leafmill.suite.common import (
    CANON_SQL,
    CHUNKS_SQL,
    CODE_PATTERN,
    GENERIC_RULES,
    PAGES_SQL,
    TERMS_SQL,
    TURNS_SQL,
    VECTORS_SQL,
    WEB_SQL,
    chunks,
    corpus_sql,
    files,
    generic_gate,
    register,
    table,
    web_files,
)
from leafmill.suite.digitize import FIELDS_SQL, as_text, gated_fields

CANON_OUT = "did AS doc_id, path, kind AS source_kind, page AS page_number, sha256(body) AS content_hash"


@register("canonical_copies_w1_a3_f2", f"WITH {CANON_SQL} SELECT {CANON_OUT} FROM canon")
def copies(spark, sf_dir):
    return canonical_pages(files(spark, sf_dir)).drop("page_text")


@register(
    "canonical_once_w1",
    f"""WITH {CANON_SQL} SELECT {CANON_OUT} FROM canon
    QUALIFY row_number() OVER (PARTITION BY sha256(body) ORDER BY page) = 1""",
)
def copies_once(spark, sf_dir):
    return canonical_copies(line_pages(files(spark, sf_dir)), within_file=True).drop("page_text")


DOCUMENT_FIELDS_SQL = f"""WITH {FIELDS_SQL},
    kept AS (SELECT * FROM judged QUALIFY path = min(path) OVER (PARTITION BY sha256(body)))
    SELECT did AS doc_id, path AS source_path, page AS page_number, sha256(body) AS content_hash,
      CASE WHEN NOT (undated OR unnamed) THEN license END AS license,
      CASE WHEN NOT (undated OR unnamed) THEN address END AS address,
      CASE WHEN NOT (undated OR unnamed) THEN version END AS version
    FROM kept"""

DOCUMENT_FIELD_NAMES = ["license", "address", "version"]


@register("document_fields_j1", DOCUMENT_FIELDS_SQL)
def document_fields(spark, sf_dir):
    """Canonical pages left-joined with the fields that passed the gate."""
    accepted, _ = split_gate(gated_fields(spark, sf_dir))
    joined = attach_fields(canonical_pages(files(spark, sf_dir)), accepted)
    return joined.select("doc_id", "source_path", "page_number", "content_hash", *DOCUMENT_FIELD_NAMES)


@register("document_fields_inline_j1", DOCUMENT_FIELDS_SQL)
def document_fields_inline(spark, sf_dir):
    """The same table with fields read from the canonical pages: no join."""
    extracted = extract_fields(canonical_pages(files(spark, sf_dir)), GENERIC_RULES)
    names = [rule.name for rule in GENERIC_RULES]
    return attach_fields_inline(extracted, generic_gate(), names).select(
        "doc_id", "source_path", "page_number", "content_hash", *DOCUMENT_FIELD_NAMES
    )


@register(
    "merged_sources_o2",
    rf"""WITH {PAGES_SQL}, {TURNS_SQL},
    {WEB_SQL},
    web AS (SELECT url AS path, string_agg(body, chr(10) ORDER BY pos) AS body FROM web_elements WHERE body <> '' GROUP BY url),
    talk_lines AS (
      SELECT path, unnest(string_split(transcript, chr(10))) AS line,
             generate_subscripts(string_split(transcript, chr(10)), 1) - 1 AS pos FROM talks),
    merged AS (
      SELECT 'corpus' AS source_system, path, kind, page, body FROM page_rows
      UNION ALL SELECT 'web', path, 'web_page', 1, body FROM web
      UNION ALL SELECT 'talk', path, 'debrief', CAST(pos // 20 + 1 AS INTEGER), string_agg(line, chr(10) ORDER BY pos)
        FROM talk_lines WHERE line <> '' GROUP BY path, pos // 20)
    SELECT source_system, sha256(path) AS doc_id, path, kind AS source_kind, page AS page_number,
           sha256(body) AS content_hash
    FROM merged QUALIFY path = min(path) OVER (PARTITION BY sha256(body))""",
)
def merged(spark, sf_dir):
    """Documents, web pages and transcripts in one page schema, then without copies."""
    talks = transcripts_as_files(assemble_transcripts(table(spark, sf_dir, "conversations")))
    pages = merge_sources(
        {
            "corpus": line_pages(files(spark, sf_dir)),
            "web": assemble_pages(html_elements(web_files(spark, sf_dir))),
            "talk": line_pages(talks),
        }
    )
    return canonical_copies(pages).drop("page_text")


CHUNK_OUT = """chunk_id, did AS doc_id, path AS source_path, kind AS source_kind, page AS page_number,
    idx AS chunk_index, sha256(body) AS text_hash"""


@register("chunks_g2_f4_p8", f"WITH {CHUNKS_SQL} SELECT {CHUNK_OUT} FROM chunk_rows")
def chunk_rows(spark, sf_dir):
    return chunks(spark, sf_dir).select(
        "chunk_id", "doc_id", "source_path", "source_kind", "page_number", "chunk_index",
        F.sha2("chunk_text", 256).alias("text_hash"),
    )


@register(
    "chunks_without_tail_g2",
    f"""WITH {CANON_SQL}, cut AS (
      SELECT did, page, length(body) AS total, body,
             unnest(range(greatest(CAST(ceil(length(body) / 1000.0) AS BIGINT), 1))) AS i FROM canon)
    SELECT did AS doc_id, page AS page_number, CAST(i AS INTEGER) AS chunk_index,
           sha256(substr(body, i * 1000 + 1, 1200)) AS text_hash
    FROM cut WHERE i = 0 OR total > i * 1000 + 200""",
)
def chunks_without_tail(spark, sf_dir):
    pages = canonical_pages(files(spark, sf_dir))
    return chunk_text(pages, drop_contained_tail=True).select(
        "doc_id", "page_number", "chunk_index", F.sha2("chunk_text", 256).alias("text_hash")
    )


CODED_RULES = (
    FieldRule("substation_name", (r"(?i)licensed under (?:the )?([^\n]*[^\n.])",)),
    FieldRule("voltage_class_kv", (r"(?i)\bversion (\d+(?:\.\d+)?)",), "double"),
    FieldRule("equipment_ids", (CODE_PATTERN,), "list"),
    FieldRule("address", (r"\b(\d{1,3}(?:\.\d{1,3}){3})\b",)),
)


def coded_gate():
    return [("no code or address", F.col("address").isNull() & (F.size("equipment_ids") == 0))]


@register(
    "fielded_chunks_j1_f3_p6",
    rf"""WITH {CHUNKS_SQL}, read AS (
      SELECT did, page, nullif(regexp_extract(body, '(?i)licensed under (?:the )?([^\n]*[^\n.])', 1), '') AS license,
             TRY_CAST(regexp_extract(body, '(?i)\bversion (\d+(?:\.\d+)?)', 1) AS DOUBLE) AS version,
             list_sort(list_distinct(regexp_extract_all(body, '{CODE_PATTERN}', 1))) AS codes,
             nullif(regexp_extract(body, '\b(\d{{1,3}}(?:\.\d{{1,3}}){{3}})\b', 1), '') IS NULL AND
             len(regexp_extract_all(body, '{CODE_PATTERN}', 1)) = 0 AS held
      FROM canon)
    SELECT chunk_id, CASE WHEN NOT held THEN license END AS substation_name,
           CASE WHEN NOT held THEN version END AS voltage_class_kv,
           CASE WHEN NOT held THEN codes::VARCHAR END AS equipment_ids
    FROM chunk_rows JOIN read USING (did, page)""",
)
def chunks_with_fields(spark, sf_dir):
    """Files to chunks with their page's fields, in one pass over the text."""
    made = fielded_chunks(files(spark, sf_dir), CODED_RULES, coded_gate(), [r.name for r in CODED_RULES])
    return made.select("chunk_id", "substation_name", "voltage_class_kv", as_text("equipment_ids").alias("equipment_ids"))


@register(
    "chunk_profile",
    f"""WITH {CHUNKS_SQL} SELECT source, count(*) AS n_chunks, count(DISTINCT did) AS n_documents,
    CAST(sum(length(body)) AS BIGINT) AS n_chars, min(sha256(body)) AS first_hash, max(sha256(body)) AS last_hash
    FROM chunk_rows GROUP BY source""",
)
def chunk_profile(spark, sf_dir):
    """Flagship: documents to lines, pages, canonical pages, chunks, counted by source."""
    text_hash = F.sha2("chunk_text", 256)
    per_document = (
        chunks(spark, sf_dir)
        .withColumn("source", F.element_at(F.split("source_path", "/"), 3))
        .groupBy("source", "doc_id")
        .agg(
            F.count("*").alias("n"), F.sum(F.length("chunk_text")).alias("chars"),
            F.min(text_hash).alias("lo"), F.max(text_hash).alias("hi"),
        )
    )
    return per_document.groupBy("source").agg(
        F.sum("n").alias("n_chunks"), F.count("*").alias("n_documents"), F.sum("chars").alias("n_chars"),
        F.min("lo").alias("first_hash"), F.max("hi").alias("last_hash"),
    )


@register(
    "transcripts_s8",
    f"WITH {TURNS_SQL} SELECT debrief_id, path AS source_path, part, transcript FROM talks",
)
def transcripts(spark, sf_dir):
    return assemble_transcripts(table(spark, sf_dir, "conversations"))


@register(
    "debrief_chunks_g3",
    f"""WITH {TURNS_SQL} SELECT 'debrief_' || debrief_id || CASE WHEN part > 1 THEN '_' || part ELSE '' END AS chunk_id,
    debrief_id AS doc_id, path AS source_path, 'debrief' AS source_kind, part AS page_number, 0 AS chunk_index, transcript AS chunk_text,
    CAST(NULL AS VARCHAR) AS substation_name, CAST(NULL AS DOUBLE) AS voltage_class_kv FROM talks""",
)
def debriefs(spark, sf_dir):
    return debrief_chunks(transcripts(spark, sf_dir)).drop("equipment_ids", "region")


@register(
    "long_transcript_s8_g3",
    """WITH lines AS (
      SELECT role || ': ' || coalesce(text, '') AS line, conv_id * 100000 + turn AS pos FROM conversations),
    parts AS (SELECT *, (row_number() OVER (ORDER BY pos, line) - 1) // 1000 + 1 AS part FROM (SELECT DISTINCT * FROM lines))
    SELECT 'debrief_' || sha256('/transcripts/0/' || part) || CASE WHEN part > 1 THEN '_' || part ELSE '' END AS chunk_id,
      CAST(part AS INTEGER) AS page_number, sha256(string_agg(line, chr(10) ORDER BY pos, line)) AS text_hash
    FROM parts GROUP BY part""",
)
def long_transcript(spark, sf_dir):
    """All turns of all conversations as one, with gaps between the turn numbers."""
    turns = table(spark, sf_dir, "conversations").select(
        F.lit(0).alias("conv_id"), (F.col("conv_id") * 100000 + F.col("turn")).alias("turn"), "role", "text"
    )
    made = debrief_chunks(assemble_transcripts(turns))
    return made.select("chunk_id", "page_number", F.sha2("chunk_text", 256).alias("text_hash"))


@register(
    "chunk_union_o1_a5",
    f"""WITH {CHUNKS_SQL}, {TURNS_SQL},
    everything AS (SELECT kind AS k FROM chunk_rows UNION ALL SELECT 'debrief' FROM talks)
    SELECT k AS source_kind, count(*) AS n FROM everything GROUP BY k""",
)
def chunk_union(spark, sf_dir):
    return kind_counts(corpus_chunks(files(spark, sf_dir), table(spark, sf_dir, "conversations")))


# Cues for the invented prose: frequent words stand in for the domain lexicon.
GENERIC_CUES = {
    "decisions": ("was", "fue", "war", "le"),
    "rationale": ("that", "que", "dass"),
    "failure_modes": ("not", "no", "nicht"),
    "cross_references": ("from", "des", "von"),
    "handshake_relationships": ("with", "avec", "mit"),
}


def _cue_sql(name: str, lead: str = r"(?:^|[^\p{L}\p{N}])") -> str:
    return "(?i)" + lead + "(?:" + "|".join(GENERIC_CUES[name]) + r")(?:$|[^\p{L}\p{N}])"


def _clause_sql() -> str:
    return r"(?i)(?:^|[^\p{L}\p{N}])((?:" + "|".join(GENERIC_CUES["rationale"]) + r")(?:[^\p{L}\p{N}].*)?)$"


@register(
    "transcript_structure_x5",
    rf"""WITH {TURNS_SQL},
    said AS (
      SELECT debrief_id, transcript, list_filter(list_transform(
        string_split_regex(regexp_replace(transcript, '([.!?])\s+', '\1' || chr(1), 'g'), '[' || chr(1) || '\n]+'),
        lambda s: trim(s)), lambda s: length(s) > 0) AS ss FROM talks),
    pairs AS (
      SELECT debrief_id, i, ss[i] AS decision,
        coalesce(nullif(regexp_extract(ss[i], '{_clause_sql()}', 1), ''),
                 CASE WHEN regexp_matches(ss[i + 1], '{_cue_sql("rationale", "^")}') THEN ss[i + 1] END) AS why
      FROM said, unnest(range(1, len(ss) + 1)) AS r(i)
      WHERE regexp_matches(ss[i], '{_cue_sql("decisions")}')),
    per AS (
      SELECT debrief_id, string_agg(decision, '|' ORDER BY i) AS decisions, string_agg(why, '|' ORDER BY i) AS rationales
      FROM pairs GROUP BY 1)
    SELECT s.debrief_id, coalesce(p.decisions, '') AS decisions, coalesce(p.rationales, '') AS rationales,
      array_to_string(list_filter(ss, lambda s: regexp_matches(s, '{_cue_sql("failure_modes")}')), '|') AS failure_modes,
      array_to_string(list_filter(ss, lambda s: regexp_matches(s, '{_cue_sql("cross_references")}')), '|') AS cross_references,
      array_to_string(list_filter(ss, lambda s: regexp_matches(s, '{_cue_sql("handshake_relationships")}')), '|') AS handshakes,
      CAST(len(list_distinct(regexp_extract_all(transcript, '\b(\d{{3}}-\d{{4}})\b', 1))) AS INTEGER) AS n_codes
    FROM said s LEFT JOIN per p USING (debrief_id)""",
)
def transcript_structure(spark, sf_dir):
    made = structure(transcripts(spark, sf_dir), cues=GENERIC_CUES, equipment=r"\b(\d{3}-\d{4})\b")
    s = "structured."
    return made.select(
        "debrief_id",
        F.array_join(s + "decisions.decision", "|").alias("decisions"),
        F.array_join(s + "decisions.rationale", "|").alias("rationales"),
        F.array_join(s + "failure_modes", "|").alias("failure_modes"),
        F.array_join(s + "cross_references", "|").alias("cross_references"),
        F.array_join(s + "handshake_relationships", "|").alias("handshakes"),
        F.size(s + "equipment_mentioned").alias("n_codes"),
    )


@register(
    "transcript_header_x6",
    """WITH turns AS (
      SELECT conv_id, turn, role, text, DATE '2026-01-01' + CAST(conv_id % 365 AS INTEGER) AS day FROM conversations)
    SELECT conv_id, turn, role AS interviewee, day AS debrief_date, 'Turn ' || turn AS topic,
           CAST(NULL AS VARCHAR) AS interviewer, trim(text, ' ' || chr(10)) AS body FROM turns""",
)
def transcript_header(spark, sf_dir):
    """Every turn as a transcript file with a header, read back."""
    day = F.date_add(F.lit("2026-01-01").cast("date"), (F.col("conv_id") % 365).cast("int"))
    written = F.concat(
        F.lit("Interview transcript\nInterviewee: "), "role",
        F.lit("\nDate: "), F.date_format(day, "yyyy-MM-dd"),
        F.lit("\nTopic: Turn "), F.col("turn").cast("string"),
        F.lit("\n---\n\n"), "text",
    )
    made = table(spark, sf_dir, "conversations").select("conv_id", "turn", written.alias("transcript"))
    return parse_header(made).drop("transcript")


@register(
    "prompt_c1",
    f"WITH {TURNS_SQL} SELECT debrief_id, sha256('Sort what is said; it''s all here: ' || transcript) AS prompt_hash FROM talks",
)
def prompts(spark, sf_dir):
    asked = with_prompt(transcripts(spark, sf_dir), "Sort what is said; it's all here: ", "transcript")
    return asked.select("debrief_id", F.sha2("prompt", 256).alias("prompt_hash"))


def two_versions(spark, sf_dir):
    """An older chunk table, before the Spanish documents came and the French ones
    were revised, and the present one."""
    present = spread(table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text"))
    older = present.where(F.col("lang") != "es").withColumn(
        "text", F.when(F.col("lang") == "fr", F.replace("text", F.lit("le "), F.lit("LE "))).otherwise(F.col("text"))
    )
    return page_chunks(documents_as_files(older)), page_chunks(documents_as_files(present))


OLD_CHUNKS_SQL = corpus_sql(
    "chunks",
    "old_",
    """(SELECT * REPLACE (CASE WHEN lang = 'fr' THEN replace(text, 'le ', 'LE ') ELSE text END AS text)
        FROM documents WHERE lang <> 'es')""",
)


@register(
    "chunk_changes_k8",
    f"""WITH {OLD_CHUNKS_SQL}, {CHUNKS_SQL}
    SELECT chunk_id, 'insert' AS change FROM chunk_rows ANTI JOIN old_chunk_rows USING (chunk_id)
    UNION ALL SELECT chunk_id, 'delete' FROM old_chunk_rows ANTI JOIN chunk_rows USING (chunk_id)
    UNION ALL SELECT n.chunk_id, 'update' FROM chunk_rows n JOIN old_chunk_rows o USING (chunk_id) WHERE n.body <> o.body""",
)
def chunk_changes(spark, sf_dir):
    old, new = two_versions(spark, sf_dir)
    return diff_chunks(old, new).select("chunk_id", "change")


@register("apply_changes_k8", f"WITH {CHUNKS_SQL} SELECT {CHUNK_OUT} FROM chunk_rows")
def changes_applied(spark, sf_dir):
    old, new = two_versions(spark, sf_dir)
    new = stage(new, "chunks")
    old = stage(old, "chunks")
    return apply_changes(old, new, diff_chunks(old, new)).select(
        "chunk_id", "doc_id", "source_path", "source_kind", "page_number", "chunk_index",
        F.sha2("chunk_text", 256).alias("text_hash"),
    )


def _staged_changes(spark, sf_dir):
    old, new = two_versions(spark, sf_dir)
    old, new = stage(old, "chunks"), stage(new, "chunks")
    return old, new, stage(diff_chunks(old, new), "changes")


@register(
    "keyword_refresh_r7",
    f"WITH {TERMS_SQL} SELECT term, chunk_id, tf, len AS chunk_len FROM postings JOIN lens USING (chunk_id)",
)
def keyword_refreshed(spark, sf_dir):
    old, new, changes = _staged_changes(spark, sf_dir)
    return refresh_index(build_index(old), changes, new).postings


@register(
    "vector_refresh_r7",
    f"WITH {TERMS_SQL}, {VECTORS_SQL} SELECT chunk_id, b AS bucket, round(w, 6) AS weight FROM vec",
)
def vectors_refreshed(spark, sf_dir):
    old, new, changes = _staged_changes(spark, sf_dir)
    stored = stage(text_vectors(old, "chunk_id", "chunk_text"), "vectors")
    vectors = vector_changes(stored, changes, new)
    zipped = vectors.select("chunk_id", F.explode(F.arrays_zip("buckets", "weights")).alias("p"))
    return zipped.select("chunk_id", F.col("p.buckets").alias("bucket"), F.round("p.weights", 6).alias("weight"))


def suppliers(spark, sf_dir):
    """Suppliers with their region, by nation key and name mappings."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    named = nation.join(region, "n_regionkey", "left")
    keyed = attach_region(table(spark, sf_dir, "supplier"), named, "s_nationkey", "n_name")
    return attach_region(keyed, named.select("n_name", F.col("r_name").alias("region")), "n_name", "region")


def desks(spark, sf_dir):
    """Two nations per desk, each with its region."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    desk = F.concat(F.lit("desk"), F.floor(F.col("n_nationkey") / 2).cast("string"), F.lit("@example.com"))
    return nation.join(region, "n_regionkey").select(desk.alias("user_email"), F.col("r_name").alias("region_code"))


SUPPLIER_SQL = """placed AS (
  SELECT s_suppkey, s_name, n_name, r_name AS region FROM supplier
  LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"""

DESK_SQL = """desks AS (
  SELECT 'desk' || (n_nationkey // 2) || '@example.com' AS user_email, r_name AS region_code
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""


@register("region_join_j2", f"WITH {SUPPLIER_SQL} SELECT s_suppkey, n_name, region FROM placed")
def region_join(spark, sf_dir):
    return suppliers(spark, sf_dir).select("s_suppkey", "n_name", "region")


@register(
    "row_filter_f6_j5",
    f"""WITH {SUPPLIER_SQL}, {DESK_SQL} SELECT s_suppkey, region FROM placed
    WHERE region IN (SELECT region_code FROM desks WHERE user_email = 'desk0@example.com')""",
)
def filtered_rows(spark, sf_dir):
    return row_filter(suppliers(spark, sf_dir), desks(spark, sf_dir), "desk0@example.com").select("s_suppkey", "region")


@register(
    "column_mask_f7",
    f"WITH {SUPPLIER_SQL} SELECT s_suppkey, CASE WHEN region = 'ASIA' THEN s_name ELSE '[redacted — request access]' END AS s_name FROM placed",
)
def masked_columns(spark, sf_dir):
    return mask(suppliers(spark, sf_dir), ["s_name"], F.col("region") == "ASIA").select("s_suppkey", "s_name")


@register(
    "sql_functions_m2",
    f"""WITH {SUPPLIER_SQL}, {DESK_SQL} SELECT s_suppkey, '[redacted — request access]' AS s_name FROM placed
    WHERE region IN (SELECT region_code FROM desks WHERE user_email = 'desk1@example.com')""",
)
def sql_functions(spark, sf_dir):
    desks(spark, sf_dir).createOrReplaceTempView("leafmill_user_regions")
    suppliers(spark, sf_dir).createOrReplaceTempView("leafmill_suppliers")
    register_functions(spark, "leafmill_user_regions", "desk1@example.com", in_group=False)
    return spark.sql(
        "SELECT s_suppkey, mask_sensitive(s_name) AS s_name FROM leafmill_suppliers WHERE region_visible(region)"
    )
