from __future__ import annotations

from pyspark.sql import functions as F

from leafmill.functions.columns import file_name, page_suffix, path_id, route_kind, safe_name, title_case
from leafmill.functions import text
from leafmill.functions.text import counted, hash_bucket, hashed_vector, sentences, term_counts, tokens, unit_weights
from leafmill.functions.typed import to_date, to_double, to_int
from leafmill.operators.pages import assemble_pages, line_pages
from leafmill.sources.elements import (
    documents_without_elements,
    html_elements,
    line_elements,
    parse_payload,
    variant_elements,
)
from leafmill.sources.files import decode_text, identify, read_transcripts, scan_files, split_decodable
from leafmill.sources.transcripts import assemble_transcripts


def test_file_scan_is_recursive_and_filtered(spark, tmp_path, rows):
    (tmp_path / "onelines" / "deep").mkdir(parents=True)
    (tmp_path / "studies").mkdir()
    (tmp_path / "onelines" / "deep" / "a.txt").write_text("one")
    (tmp_path / "studies" / "b.txt").write_text("two")
    (tmp_path / "studies" / "c.log").write_text("not this")
    files = scan_files(spark, f"file://{tmp_path}", "*.txt")
    assert files.columns == ["path", "modificationTime", "length", "content", "doc_id", "source_kind"]
    assert rows(decode_text(files), "text", "source_kind") == [("one", "oneline"), ("two", "protection_study")]
    assert files.where(F.col("doc_id") == path_id(F.col("path"))).count() == 2


def test_unreadable_bytes_are_rejected_not_fatal(spark, tmp_path, rows):
    (tmp_path / "good.txt").write_bytes("Grüße".encode())
    (tmp_path / "bad.txt").write_bytes(b"\xff\xfe\x00broken")
    good, bad = split_decodable(decode_text(scan_files(spark, str(tmp_path))))
    assert rows(good, "text") == [("Grüße",)]
    assert [r["path"].split("/")[-1] for r in bad.collect()] == ["bad.txt"]
    assert "content" not in bad.columns
    made = read_transcripts(spark, str(tmp_path), "*.txt")
    assert made.columns == ["source_path", "transcript", "debrief_id"]
    assert made.where("transcript is null").count() == 1


def test_kind_routing(spark, rows):
    paths = [("/x/onelines/studies/a",), ("/x/studies/onelines/a",), ("/x/onelines/a/studies/b",), ("/y",), (None,)]
    made = spark.createDataFrame(paths, "path string").select("path", route_kind(F.col("path")).alias("kind"))
    assert dict(rows(made)) == {
        "/x/onelines/studies/a": "oneline",
        "/x/studies/onelines/a": "oneline",
        "/x/onelines/a/studies/b": "oneline",
        "/y": "unknown",
        None: "unknown",
    }


PAYLOADS = {
    "content": '{"document":{"elements":[{"id":1,"type":"p","content":"c","page_number":4,"bbox":[1,2]}]}}',
    "text": '{"document":{"elements":[{"id":"1","type":"p","text":"t","page":"3"}]}}',
    "both": '{"document":{"elements":[{"content":"c","text":"t","page_number":2,"page":9}]}}',
    "neither": '{"document":{"elements":[{"id":"1","type":"p"}]}}',
    "bad page": '{"document":{"elements":[{"content":"c","page":"x"}]}}',
    "empty": '{"document":{"elements":[{"content":""},{"content":" "}]}}',
    "no list": '{"document":{}}',
    "empty list": '{"document":{"elements":[]}}',
    "not json": "{oops",
}


def test_parsed_payloads(spark, rows):
    files = identify(spark.createDataFrame(list(PAYLOADS.items()), "path string, json string"))
    parsed = parse_payload(files, "json")
    assert rows(variant_elements(parsed), "path", "element_id", "element_text", "page_number") == [
        ("bad page", None, "c", 1),
        ("both", None, "c", 2),
        ("content", "1", "c", 4),
        ("empty", None, " ", 1),
        ("text", "1", "t", 3),
    ]
    boxed = variant_elements(parsed).where(F.col("path") == "content").select(F.to_json("bbox"))
    assert rows(boxed) == [("[1,2]",)]
    assert sorted(r["path"] for r in documents_without_elements(parsed).collect()) == ["empty list", "no list", "not json"]


def test_line_elements_and_pages_agree(spark, rows):
    texts = [
        ("a", "\n".join(f"line {i}" for i in range(45))),
        ("b", "\n\n\nlate\n" + "\n" * 30 + "end"),
        ("c", ""),
        ("d", None),
        ("e", "\n" * 25),
        ("f", " \nü\U0001d11e"),
    ]
    files = identify(spark.createDataFrame(texts, "path string, text string"))
    by_group, by_row = assemble_pages(line_elements(files)), line_pages(files)
    assert by_group.columns == by_row.columns
    assert rows(by_group) == rows(by_row)
    assert rows(by_row.groupBy("path").count()) == [("a", 3), ("b", 2), ("f", 1)]


def test_page_text_does_not_depend_on_row_order(spark, rows):
    data = [("d", "p", "k", 1, pos, text) for pos, text in [(2, "c"), (0, "a"), (1, None), (10, "d"), (3, "b")]]
    elements = spark.createDataFrame(data, "doc_id string, path string, source_kind string, page_number int, pos int, element_text string")
    assert rows(assemble_pages(elements.repartition(4)), "page_text") == [("a\nc\nb\nd",)]


def test_html_blocks(spark, rows):
    page = (
        "<HEAD lang='x'><p>no</p></head><body>before<script>var a='</p><p>no'</script><!-- <p>no --><h1 class='x'>Top</h1>"
        "<header>line</header><p>one <b>bold</b><p>two\n <ul><li>x &amp;lt; y</ul>after 1 < 2<H2>Sub</H2><table><tr><td>cell<td>two</table>"
        "<div>in <a href='#'>link</a><br>next</div><p> </p></body>"
    )
    files = identify(spark.createDataFrame([("u", page), ("v", None), ("w", "")], "path string, html string"))
    made = html_elements(files).orderBy("pos").collect()
    assert [(r.element_type, r.element_text) for r in made] == [
        ("body", "before"),
        ("h1", "Top"),
        ("header", "line"),
        ("p", "one bold"),
        ("p", "two"),
        ("li", "x &lt; y"),
        ("text", "after 1 < 2"),
        ("h2", "Sub"),
        ("td", "cell"),
        ("td", "two"),
        ("div", "in link"),
        ("br", "next"),
    ]


def test_tokens_counts_and_sentences(spark):
    frame = spark.createDataFrame([("B 138L-1 b --a-- Ünï 138l-1 x-",), ("",)], "t string")
    made = frame.select(tokens(F.col("t")).alias("w"), counted(tokens(F.col("t"))).alias("c")).collect()
    assert made[0]["w"] == ["b", "138l-1", "b", "a", "ünï", "138l-1", "x"]
    assert [tuple(c) for c in made[0]["c"]] == [("138l-1", 2), ("a", 1), ("b", 2), ("x", 1), ("ünï", 1)]
    assert made[1]["c"] == []
    said = spark.createDataFrame([("Rev 1.7 drifts. It is known!  Why?\nNew line ",)], "t string")
    assert said.select(sentences(F.col("t"))).first()[0] == ["Rev 1.7 drifts.", "It is known!", "Why?", "New line"]


def test_long_texts_do_not_break_patterns(spark):
    """Texts without any break, far longer than a regular-expression stack."""
    frame = spark.createDataFrame([("x" * 200_000,), ("a-" * 100_000,), ("." * 200_000,), (". " * 100_000,)], "t string")
    made = frame.select(F.size(tokens(F.col("t"))), F.size(sentences(F.col("t")))).collect()
    assert [tuple(r) for r in made] == [(1, 1), (1, 1), (0, 1), (0, 100_000)]


def test_tolerant_typing(spark, rows):
    texts = ["17/3/2020", "2020-03-17", "31/2/2020", "138 kV", "138.00", "n/a", "", None, " 7 "]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    made = frame.select("t", to_date(F.col("t")).cast("string"), to_double(F.col("t"), ["kV"]), to_int(F.col("t")))
    assert {r[0]: tuple(r)[1:] for r in made.collect()} == {
        "17/3/2020": ("2020-03-17", None, None),
        "2020-03-17": ("2020-03-17", None, None),
        "31/2/2020": (None, None, None),
        "138 kV": (None, 138.0, None),
        "138.00": (None, 138.0, None),
        "n/a": (None, None, None),
        "": (None, None, None),
        None: (None, None, None),
        " 7 ": (None, 7.0, 7),
    }


def test_display_helpers(spark):
    frame = spark.createDataFrame([("/a/b.pdf", 3), ("a/", None), (None, 1)], "p string, n int")
    made = frame.select(file_name(F.col("p"), F.lit("id")), page_suffix(F.col("n"))).collect()
    assert [tuple(r) for r in made] == [("b.pdf", " · p3"), ("id", ""), ("id", " · p1")]
    named = spark.range(1).select(title_case(F.lit("relay_firmware")), safe_name(F.lit("Oak Ridge"))).first()
    assert tuple(named) == ("Relay Firmware", "oak_ridge")


def test_transcripts_continue_in_parts(spark, rows):
    turns = [(7, t * 100_000, "user", f"t{t}") for t in range(5)] + [(7, 0, "user", "t0"), (8, 0, "user", None)]
    frame = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").repartition(3)
    made = assemble_transcripts(frame, turns_per_part=2)
    assert rows(made, "source_path", "part", "transcript") == [
        ("/transcripts/7/1", 1, "user: t0\nuser: t1"),
        ("/transcripts/7/2", 2, "user: t2\nuser: t3"),
        ("/transcripts/7/3", 3, "user: t4"),
        ("/transcripts/8/1", 1, "user: "),
    ]


def test_terms_counted_in_arrow_are_those_counted_in_the_row(spark, monkeypatch):
    letters = ["a", "B", "1", "é", "日", "𝕏", "-", "--", " ", ".", "\n", "\u0301", "²", "a-"]
    odd = [("".join(letters[(i * 7 + j * j + i // 5) % len(letters)] for j in range(i % 17)),) for i in range(800)]
    frame = spark.createDataFrame([*odd, (None,), ("",), ("--",), ("x-x x-x y " * 500,)], "t string").repartition(2)
    between = r"[^\p{L}\p{N}-]+|-(?![\p{L}\p{N}])|(?<![\p{L}\p{N}])-"
    words = F.array_remove(F.split(F.lower("t"), between), "")
    counts = counted(F.transform(words, lambda w: hash_bucket(w, 16)))
    plain = frame.select("t", counted(words).alias("a"), tokens(F.col("t")).alias("w"), words.alias("v"), counts.alias("c"))
    plain = plain.select("*", F.transform("c", lambda c: c["value"]).alias("buckets"), unit_weights(F.col("c")).alias("weights"))
    for together in (text.COUNTED_TOGETHER, 5):
        monkeypatch.setattr(text, "COUNTED_TOGETHER", together)
        made = plain.select("*", term_counts(F.col("t")).alias("b"), hashed_vector(F.col("t"), 16).alias("h"))
        wrong = made.where("not (a <=> b and w <=> v and buckets <=> h.buckets and weights <=> h.weights)")
        assert made.count() == len(odd) + 4 and wrong.collect() == []
