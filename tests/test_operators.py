from __future__ import annotations

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from leafmill.operators.security import register_functions
from leafmill.operators.consolidate import attach_region
from leafmill.operators.consolidate import region_conflicts
from leafmill.operators.hybrid import with_chunks
from leafmill.operators.evaluate import score_run
from pyspark.sql import functions as F

from leafmill.operators import chunks
from leafmill.operators.chunks import apply_changes, chunk_text, diff_chunks, document_chunks, union_chunks
from leafmill.operators.consolidate import attach_fields, attach_fields_inline, merge_sources
from leafmill.operators.debriefs import cues_from_table, debrief_chunks, parse_header, structure
from leafmill.operators.fields import (
    SUBSTATION_RULES,
    extract_fields,
    gate,
    promote,
    split_gate,
    substation_gate,
    typed_fields,
)
from leafmill.operators.order import with_positions
from leafmill.operators.pages import canonical_copies
from leafmill.operators.security import mask, row_filter
from leafmill.schemas import CHUNK, struct_of

RARE = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

PAGE = "doc_id string, path string, source_kind string, page_number int, page_text string, content_hash string"


def page(path, number, text, kind="oneline"):
    return (f"id-{path}", path, kind, number, text, f"hash-{text}")


def test_copies_across_files(spark, rows):
    data = [
        page("b", 1, "same"), page("a", 5, "same"), page("c", 1, "same", "protection_study"),
        page("a", 7, "same"), page("z", 1, "own"), page("z", 2, "own"), page("z", None, "own"),
    ]
    pages = spark.createDataFrame(data, PAGE).repartition(3)
    assert rows(canonical_copies(pages), "path", "page_number") == [("a", 5), ("a", 7), ("z", 1), ("z", 2), ("z", None)]
    assert rows(canonical_copies(pages, within_file=True), "path", "page_number") == [("a", 5), ("z", None)]


def test_copies_in_one_file_of_many_blocks(spark):
    """One file of 300,000 equal pages, and another that repeats it once."""
    pages = spark.range(300_000).select(
        F.lit("d").alias("doc_id"), F.lit("a").alias("path"), F.lit("k").alias("source_kind"),
        (F.col("id") + 1).cast("int").alias("page_number"), F.lit("t").alias("page_text"), F.lit("h").alias("content_hash"),
    )
    other = spark.createDataFrame([("e", "b", "k", 1, "t", "h")], PAGE)
    assert canonical_copies(pages.unionByName(other)).groupBy("path").count().collect() == [("a", 300_000)]
    assert canonical_copies(pages.unionByName(other), within_file=True).count() == 1


ONELINE = """Oak Ridge Substation — One-Line Summary
Region: NE  |  Nominal voltage: 138.00 kV  |  Commissioned: 1978
138L-1 138.00 ABB 1990
138B-2 138.00 GE 1991
• Bus arrangement is double-bus, single-breaker.
• SCADA RTU is SEL-3555; polling every 4 seconds.
• Last full thermal inspection: 2022.
Approved: A. Chen, P.E.    Date: 7/11/2023"""

STUDY = """Protection Coordination Study — Pine Hollow
Study date: 17/3/2020
Prepared by: B. Diaz, P.E.
Scope: 34 kV protection settings for all feeder breakers
• Kept 34L-1 at the existing time dial; 34L-1 is fine.
Approved: B. Diaz, P.E.    Date: 2/1/2024"""


def field_pages(spark):
    data = [page("o", 1, ONELINE), page("s", 1, STUDY, "protection_study"), page("s", 2, "nothing here", "protection_study"), page("n", 1, "x", None)]
    return spark.createDataFrame(data, PAGE)


def test_substation_fields(spark):
    made = {(r["path"], r["page_number"]): r for r in typed_fields(field_pages(spark)).collect()}
    one, study, blank = made["o", 1], made["s", 1], made["s", 2]
    assert (one["substation_name"], one["voltage_class_kv"], one["equipment_ids"]) == ("Oak Ridge", 138.0, ["138L-1", "138B-2"])
    assert (one["approving_engineer"], one["bus_arrangement"]) == ("A. Chen, P.E.", "double-bus, single-breaker")
    assert (one["scada_rtu_model"], one["last_thermal_inspection_year"], one["study_date"]) == ("SEL-3555", 2022, None)
    assert (study["substation_name"], study["voltage_class_kv"], study["equipment_ids"]) == ("Pine Hollow", 34.0, ["34L-1"])
    assert str(study["study_date"]) == "2020-03-17"
    assert blank["substation_name"] is None and blank["equipment_ids"] == []
    assert one["extraction_model_version"] == "rules"


FIELD = "doc_id string, source_kind string, substation_name string, study_date date"


def test_gate_reasons(spark, rows):
    data = [("a", "protection_study", "N", None), ("b", "oneline", None, None), ("c", None, "N", None), ("d", "oneline", "", None), ("e", None, None, None)]
    accepted, held = split_gate(gate(spark.createDataFrame(data, FIELD), substation_gate()))
    assert rows(accepted, "doc_id") == [("c",), ("d",)]
    assert rows(held, "doc_id", F.array_join("review_reasons", "; ")) == [
        ("a", "study without date"),
        ("b", "no substation name"),
        ("e", "no substation name"),
    ]


@RARE
@given(st.lists(st.tuples(st.sampled_from(["protection_study", "oneline", None]), st.sampled_from(["N", "", None])), min_size=1, max_size=30))
def test_gate_is_total_and_disjoint(spark, kinds):
    data = [(str(i), kind, name, None) for i, (kind, name) in enumerate(kinds)]
    accepted, held = split_gate(gate(spark.createDataFrame(data, FIELD), substation_gate()))
    ids = [r["doc_id"] for r in accepted.collect()] + [r["doc_id"] for r in held.collect()]
    assert sorted(ids) == sorted(str(i) for i in range(len(data)))


def test_promotion(spark, rows):
    data = [("a", "oneline", None, None), ("b", "oneline", None, None), ("c", "oneline", "N", None)]
    accepted, held = split_gate(gate(spark.createDataFrame(data, FIELD), substation_gate()))
    approved = spark.createDataFrame([("a",), ("a",), ("zz",)], "doc_id string")
    curated, rest = promote(held, accepted, approved, ["doc_id"])
    assert rows(curated, "doc_id") == [("a",), ("c",)]
    assert rows(rest, "doc_id") == [("b",)]


def test_fields_join_and_inline_agree(spark, rows):
    pages = field_pages(spark)
    accepted, _ = split_gate(gate(typed_fields(pages), substation_gate()))
    joined = attach_fields(pages, accepted)
    names = [rule.name for rule in SUBSTATION_RULES]
    inline = attach_fields_inline(extract_fields(pages), substation_gate(), names)
    columns = ["doc_id", "source_path", "page_number", *names]
    assert rows(joined, *columns) == rows(inline, *columns)
    assert {r["page_number"] for r in joined.where("substation_name is null").collect()} == {1, 2}


def expected_chunks(text, size, overlap, drop):
    step, out = size - overlap, []
    if not text:
        return out
    for i in range(max(math.ceil(len(text) / step), 1)):
        if drop and i and len(text) <= i * step + overlap:
            break
        out.append((i, text[i * step : i * step + size]))
    return out


@pytest.mark.parametrize("drop", [False, True])
def test_chunk_lengths(spark, drop):
    texts = ["x" * n for n in (0, 1, 1000, 1001, 1100, 1200, 1201, 2000)] + [None, "é\U0001d11eß" * 700]
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, page_text string")
    made = chunk_text(frame, drop_contained_tail=drop).collect()
    got = sorted((r["id"], r["chunk_index"], r["chunk_text"]) for r in made)
    assert got == [(i, n, c) for i, t in enumerate(texts) for n, c in expected_chunks(t, 1200, 200, drop)]


@RARE
@given(st.lists(st.text(alphabet="ab\n é\U0001d11e", max_size=60), min_size=1, max_size=12), st.integers(2, 9), st.data())
def test_chunks_rebuild_the_text(spark, texts, size, data):
    overlap = data.draw(st.integers(0, size - 1))
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, page_text string")
    parts: dict[int, dict[int, str]] = {}
    for r in chunk_text(frame, size=size, overlap=overlap).collect():
        parts.setdefault(r["id"], {})[r["chunk_index"]] = r["chunk_text"]
    step = size - overlap
    for i, text in enumerate(texts):
        pieces = parts.get(i, {})
        assert "".join(pieces[n][:step] for n in sorted(pieces)) == text


def test_very_long_text(spark):
    """Some ten thousand chunks of one text, across the pieces it is cut from."""
    text = "".join(chr(97 + i % 26) for i in range(99)) + "é"
    frame = spark.createDataFrame([(text,)], "t string").select(F.repeat("t", 100_000).alias("page_text"))
    made = {r["chunk_index"]: r["chunk_text"] for r in chunk_text(frame).select("chunk_index", "chunk_text").collect()}
    whole = text * 100_000
    assert sorted(made) == list(range(10_000))
    assert all(made[i] == whole[i * 1000 : i * 1000 + 1200] for i in range(0, 10_000, 7))


def test_chunk_arguments(spark):
    with pytest.raises(ValueError):
        chunk_text(spark.range(1), size=100, overlap=100)


def test_chunk_union_by_name(spark, rows):
    pages = spark.createDataFrame([("d", "/p", "oneline", 1, "text", ["138L-1"])], "doc_id string, source_path string, source_kind string, page_number int, page_text string, equipment_ids array<string>")
    talks = spark.createDataFrame([("t", "/t", 1, "said"), ("t", "/t", 2, "more")], "debrief_id string, source_path string, part int, transcript string")
    one, two = document_chunks(pages), debrief_chunks(talks)
    assert one.schema.simpleString() == two.schema.simpleString()
    assert [f.name for f in struct_of(CHUNK).fields] == one.columns
    both = union_chunks(one, two.select(*reversed(two.columns)))
    assert rows(both, "chunk_id", "page_number", "chunk_text") == [("d_1_0", 1, "text"), ("debrief_t", 1, "said"), ("debrief_t_2", 2, "more")]


def test_positions_count_within_groups(spark):
    data = [(None, 2), (None, 1), ("a", 5), ("a", None), ("a", 5)] + [("hot", 7 * i) for i in range(400)]
    frame = spark.createDataFrame(data, "k string, v int").repartition(5)
    got = with_positions(frame, ["k"], ["v"], "place").collect()
    assert sorted((r["v"], r["place"]) for r in got if r["k"] is None) == [(1, 0), (2, 1)]
    assert sorted((r["place"], r["v"]) for r in got if r["k"] == "a") == [(0, None), (1, 5), (2, 5)]
    assert all(r["v"] == 7 * r["place"] for r in got if r["k"] == "hot") and len(got) == len(data)
    assert with_positions(frame.limit(0), ["k"], ["v"], "place").collect() == []


CHUNK_ROW = "chunk_id string, chunk_text string"


def test_changes(spark, rows):
    old = spark.createDataFrame([("same", "x"), ("edit", "x"), ("gone", "x"), ("null", None), ("filled", None)], CHUNK_ROW)
    new = spark.createDataFrame([("same", "x"), ("edit", "y"), ("new", "x"), ("null", None), ("filled", "x")], CHUNK_ROW)
    assert rows(diff_chunks(old, new), "chunk_id", "change") == [
        ("edit", "update"), ("filled", "update"), ("gone", "delete"), ("new", "insert"),
    ]


def test_repeated_keys_are_compared_as_a_whole(spark, rows):
    old = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), ("b", "x"), ("c", "x")], CHUNK_ROW)
    new = spark.createDataFrame([("a", "y"), ("a", "x"), ("b", "x"), ("c", "x"), ("c", "z")], CHUNK_ROW)
    changes = diff_chunks(old, new)
    assert rows(changes, "chunk_id", "change") == [("b", "update"), ("c", "update")]
    assert rows(apply_changes(old, new, changes)) == rows(new)


@RARE
@given(*[st.dictionaries(st.sampled_from("abcdefgh"), st.sampled_from(["x", "y", None]), min_size=1) for _ in range(2)])
def test_changes_lead_to_the_new_table(spark, rows, before, after):
    old, new = (spark.createDataFrame(list(d.items()), CHUNK_ROW) for d in (before, after))
    assert rows(apply_changes(old, new, diff_chunks(old, new))) == rows(new)


def test_sources_merge_by_name(spark, rows):
    a = spark.createDataFrame([("1", "x")], "doc_id string, page_text string")
    b = spark.createDataFrame([("y", "2")], "page_text string, doc_id string").withColumn("extra", F.lit(3))
    assert rows(merge_sources({"a": a, "b": b}), "source_system", "doc_id", "page_text", "extra") == [("a", "1", "x", None), ("b", "2", "y", 3)]


TRANSCRIPT = """Interview transcript
Interviewee: Master Potter
Date: 2026-02-14
Topic: Glazing
Interviewer: Craft Museum
---

The glaze on vessel 138L-1 was thinned since humid weather thickens it. We also chose 138B-2. The cause was never written down. See the kiln diary for May.
Two potters shook hands on that.
---
not a header
"""


POTTERY = {
    "decisions": ("thinned", "chose"),
    "rationale": ("since", "the cause"),
    "failure_modes": ("cracked",),
    "cross_references": ("diary",),
    "handshake_relationships": ("shook hands",),
}


def test_header_and_structure(spark):
    frame = spark.createDataFrame([(TRANSCRIPT,), ("no header",), (None,)], "transcript string")
    made = structure(parse_header(frame), POTTERY, text="body", topic=F.col("topic")).collect()
    first, plain, empty = made
    assert (first["interviewee"], str(first["debrief_date"]), first["interviewer"]) == ("Master Potter", "2026-02-14", "Craft Museum")
    assert first["body"].startswith("The glaze") and first["body"].endswith("---\nnot a header")
    s = first["structured"]
    assert s["topics"] == ["Glazing"] and s["equipment_mentioned"] == ["138L-1", "138B-2"]
    assert [tuple(d) for d in s["decisions"]] == [
        ("The glaze on vessel 138L-1 was thinned since humid weather thickens it.", "since humid weather thickens it."),
        ("We also chose 138B-2.", "The cause was never written down."),
    ]
    assert s["cross_references"] == ["See the kiln diary for May."]
    assert s["handshake_relationships"] == ["Two potters shook hands on that."]
    assert s["failure_modes"] == []
    assert plain["body"] == "no header" and plain["topic"] is None
    for row in (plain, empty):
        assert all(getattr(row["structured"], f) == [] for f in row["structured"].asDict())


def test_cue_table(spark):
    table = spark.createDataFrame([("decisions", "chose"), ("decisions", "picked"), ("rationale", "as")], "category string, cue string")
    cues = cues_from_table(table)
    assert cues == {"decisions": ("chose", "picked"), "rationale": ("as",)}
    made = structure(spark.createDataFrame([("We chose A as B. We kept C.",)], "transcript string"), cues=cues).first()
    assert [tuple(d) for d in made["structured"]["decisions"]] == [("We chose A as B.", "as B.")]


def test_row_filter_and_mask(spark, rows):
    frame = spark.createDataFrame([("1", "NE", "s"), ("2", "SW", "s"), ("3", None, "s"), ("4", "MW", None)], "id string, region string, secret string")
    users = spark.createDataFrame([("u", "NE"), ("u", "SW"), ("u", "NE"), ("v", "MW")], "user_email string, region_code string")
    assert rows(row_filter(frame, users, "u"), "id") == [("1",), ("2",)]
    assert rows(row_filter(frame, users, "nobody"), "id") == []
    assert row_filter(frame, users, "x", is_admin=True).count() == 4
    assert rows(mask(frame, ["secret"], False), "secret") == [("[redacted — request access]",)] * 4
    assert rows(mask(frame, ["secret"], F.col("region") == "NE").where("id = '1'"), "secret") == [("s",)]


def test_user_names_cannot_open_the_row_filter(spark):
    spark.createDataFrame([("u", "NE")], "user_email string, region_code string").createOrReplaceTempView("leafmill_test_regions")
    for user, seen in (("u", True), ("\\' OR 1=1) --", False), ("' OR 'a'='a", False), ("nobody", False)):
        register_functions(spark, "leafmill_test_regions", user, in_group=False)
        assert spark.sql("SELECT region_visible('NE')").first()[0] is seen
    with pytest.raises(ValueError):
        register_functions(spark, "x) OR (1=1", "u", in_group=False)


def test_region_conflicts_stay_closed(spark, rows):
    names = spark.createDataFrame([("Oak", "NE"), ("Oak", "CE"), ("Elm", "SW"), ("Elm", "SW")], "substation_name string, region string")
    documents = spark.createDataFrame([("Oak",), ("Elm",), (None,)], "substation_name string")
    assert rows(attach_region(documents, names)) == [("Elm", "SW"), ("Oak", None), (None, None)]
    assert rows(region_conflicts(names)) == [("Oak", ["CE", "NE"])]


def test_changes_cover_every_column(spark, rows):
    kinds = "chunk_id string, chunk_text string, substation_name string"
    old = spark.createDataFrame([("a", "t", None), ("b", "t", "Oak")], kinds)
    new = spark.createDataFrame([("a", "t", "Elm"), ("b", "t", "Oak")], kinds)
    assert rows(diff_chunks(old, new)) == [("a", "update")]
    assert rows(diff_chunks(old, new, columns=["chunk_text"])) == []
    assert rows(apply_changes(old, new, diff_chunks(old, new))) == rows(new)


def test_hits_without_a_chunk_stay(spark):
    hits = spark.createDataFrame([(1, "gone", 1, 0.5)], "query_id long, chunk_id string, rank int, score double")
    chunks = spark.createDataFrame([], "chunk_id string, doc_id string, source_path string, source_kind string, page_number int, chunk_text string")
    assert tuple(with_chunks(hits, chunks).first()) == (1, 1, "gone", "", "", "", 0, "", 0.5)


def test_repeated_responses_do_not_multiply(spark):
    asked = spark.createDataFrame([("q", ["x"])], "request string, expected_contains_any array<string>")
    said = spark.createDataFrame([("q", "x"), ("q", "y")], "request string, response string")
    assert [r.response for r in score_run(asked, said, "r", F.current_timestamp()).collect()] == ["x"]


def test_refreshes_leave_wide_rows_in_place(spark, rows, monkeypatch):
    wide = spark.createDataFrame([(f"k{i % 300}", i) for i in range(400)] + [(None, -1), (None, -2)], "k string, v int").repartition(3)
    keys = spark.createDataFrame([(f"k{i}",) for i in range(0, 600, 2)] + [("k0",), (None,)], "k string")
    for words in (chunks.BITMAP_WORDS, 2):  # few words: most keys look alike, and are joined
        monkeypatch.setattr(chunks, "BITMAP_WORDS", words)
        inside, outside, unsure = chunks.told_apart(wide, "k", keys)
        assert (unsure.where("k is not null").count() == 0) == (words > 2)
        assert rows(chunks.rows_among(wide, "k", keys)) == rows(wide.join(keys, "k", "left_semi"))
        assert rows(chunks.rows_not_among(wide, "k", keys)) == rows(wide.join(keys, "k", "left_anti"))
        assert inside.count() + outside.count() + unsure.count() == wide.count()
    assert chunks.rows_among(wide, "k", keys.limit(0)).count() == 0
    assert chunks.rows_not_among(wide, "k", keys.limit(0)).count() == wide.count()
