"""Evaluation, model calls, tables, incremental runs."""

from __future__ import annotations

import io
import math
import subprocess
import sys
from contextlib import redirect_stdout
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from leafmill import session
from leafmill.operators import models
from leafmill.operators.evaluate import contains_any, diff_runs, eval_set, kind_counts, latest_run, score_run, summarise_runs
from leafmill.operators.fields import gate, substation_gate
from leafmill.operators.keyword import _Block, _scan
from leafmill.operators.models import model_map
from leafmill.operators.pages import assemble_pages
from leafmill.session import checkpoint_folder, clear_staged, stage
from leafmill.sinks.tables import append_run, drop_schemas, ensure_schemas, overwrite_table, read_runs, stamped, write_counted, write_gated
from leafmill.sources.elements import line_elements
from leafmill.sources.files import decode_text, identify
from leafmill.streaming import refresh
from leafmill.streaming.ingest import file_stream, ingest, ingest_text_files, table_stream
from leafmill.streaming.refresh import current_corpus, full_corpus, refresh_corpus, refresh_from_stream


def test_containment_score(spark):
    data = [("It is a RING bus", ["ring"]), ("it is", ["ring", "IT"]), (None, ["x"]), ("x", []), ("<error: x>", ["ERROR"]), ("x", [None]), ("x", None)]
    frame = spark.createDataFrame(data, "r string, e array<string>")
    assert [r[0] for r in frame.select(contains_any(F.col("r"), F.col("e"))).collect()] == [1.0, 1.0, 0.0, 0.0, 1.0, 0.0, 0.0]


QUESTIONS = [
    {"request": "a", "expected_kind": "fact", "expected_contains_any": ["ring"]},
    {"request": "b", "expected_kind": "fact", "expected_contains_any": ["x"]},
    {"request": "c", "expected_kind": "refusal", "expected_contains_any": ["no"]},
]


def test_runs_are_scored_appended_and_compared(spark, tmp_path, rows):
    questions = eval_set(spark, QUESTIONS)
    path = str(tmp_path / "runs")
    stamps = [F.lit(f"2026-01-0{i}").cast("timestamp") for i in (1, 2)]
    first = spark.createDataFrame([("a", "a ring", None), ("b", "boom x", "Timeout: x")], "request string, response string, error string")
    second = spark.createDataFrame([("a", "none"), ("b", "x"), ("c", "NO")], "request string, response string")
    append_run(score_run(questions, first, "1", stamps[0]), path)
    later = score_run(questions, second, "2", stamps[1]).withColumn("model", F.lit("m"))
    append_run(later, path)
    append_run(later, path)  # a retried job
    runs = read_runs(spark, path)
    assert runs.count() == 6 and "model" in runs.columns
    assert rows(runs, "run_id", "request", "contains_score", "model") == [
        ("1", "a", 1.0, None), ("1", "b", 0.0, None), ("1", "c", 0.0, None),
        ("2", "a", 0.0, "m"), ("2", "b", 1.0, "m"), ("2", "c", 1.0, "m"),
    ]
    assert rows(summarise_runs(runs), "run_id", F.round("contains_score_mean", 3), "n_eval_rows", "n_errors") == [("1", 0.333, 3, 1), ("2", 0.667, 3, 0)]
    assert {r["run_id"] for r in latest_run(runs).collect()} == {"2"}
    assert rows(diff_runs(runs), "request", "run_id", "previous", "delta") == [
        ("a", "1", None, None), ("a", "2", 1.0, -1.0), ("b", "1", None, None), ("b", "2", 0.0, 1.0),
        ("c", "1", None, None), ("c", "2", 0.0, 1.0),
    ]
    assert rows(kind_counts(questions, "expected_kind")) == [("fact", 2), ("refusal", 1)]


def test_model_errors_stay_with_their_row(spark):
    def call(texts: pd.Series) -> list:
        if (texts == "bad").any():
            raise RuntimeError("no")
        return [{"n": len(t), "tags": [t]} for t in texts]

    frame = spark.createDataFrame([("ab",), ("bad",), ("c",)], "t string").coalesce(1)
    made = model_map(frame, call, "t", "n int, tags array<string>").collect()
    assert [(r["t"], r["result"]["error"]) for r in made] == [("ab", None), ("bad", "RuntimeError: no"), ("c", None)]
    assert made[0]["result"]["value"].asDict() == {"n": 2, "tags": ["ab"]} and made[1]["result"]["value"] is None


def test_task_code_travels_by_value():
    """Executors do not have the package, so no pickled function may import it."""
    assert "leafmill" in cloudpickle.list_registry_pickle_by_value()
    made = cloudpickle.dumps(_scan(_Block.of([], {}, 1, 1.0), 6, (None, None)))
    bare = "import sys; from pyspark import cloudpickle; cloudpickle.loads(sys.stdin.buffer.read()); assert 'leafmill' not in sys.modules"
    subprocess.run([sys.executable, "-c", bare], input=made, cwd="/", check=True, timeout=60)


def test_tables(spark, tmp_path, rows):
    ensure_schemas(spark, ["leafmill_test"])
    ensure_schemas(spark, ["leafmill_test"])
    try:
        assert overwrite_table(spark.range(5), "leafmill_test.t") == 5
        other = stamped(spark.createDataFrame([("x",)], "name string"), "ingested_at")
        assert overwrite_table(other, "leafmill_test.t") == 1
        assert spark.table("leafmill_test.t").columns == ["name", "ingested_at"]
    finally:
        spark.sql("DROP TABLE IF EXISTS leafmill_test.t")
        spark.sql("DROP SCHEMA IF EXISTS leafmill_test")
    counts = write_counted(spark.range(10), str(tmp_path / "c"), {"big": F.count_if(F.col("id") > 6)})
    assert counts == {"rows": 10, "big": 3}
    fields = spark.createDataFrame([("a", "oneline", "N", None), ("b", "oneline", None, None)], "doc_id string, source_kind string, substation_name string, study_date date")
    write_gated(gate(fields, substation_gate()), str(tmp_path / "g"))
    assert rows(spark.read.parquet(str(tmp_path / "g" / "side=review")), "doc_id") == [("b",)]
    assert rows(spark.read.parquet(str(tmp_path / "g")), "doc_id", "side") == [("a", "curated"), ("b", "review")]


def test_staged_tables_use_the_named_folder(spark):
    staged = stage(spark.range(3).select(F.col("id"), F.parse_json(F.lit('{"a":1}')).alias("v")), "x")
    assert staged.count() == 3 and staged.columns == ["id", "v"]
    folder = checkpoint_folder(spark).removeprefix("file:")
    assert staged.inputFiles()[0].removeprefix("file://").startswith(f"{folder}/leafmill-staged/x-")
    named = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: {"spark.checkpoint.dir": "/shared"}.get(key, default)))
    assert checkpoint_folder(named) == "/shared"
    bare = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: default),
        sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="yarn"),
    )
    with pytest.raises(ValueError):
        checkpoint_folder(bare)


def test_ingest_takes_only_new_files(spark, tmp_path):
    landing, out, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "progress")
    landing.mkdir()
    (landing / "a.txt").write_text("one\ntwo")
    (landing / "bad.txt").write_bytes(b"\xff\xfe")
    counts = []
    for arrival in (None, "b.txt", None):
        if arrival:
            (landing / arrival).write_text("three")
        ingest_text_files(spark, f"file://{landing}", out, progress)
        counts.append(spark.read.parquet(out).count())
    assert counts == [2, 3, 3]


def pages_of(spark, texts):
    return assemble_pages(line_elements(identify(spark.createDataFrame(texts, "path string, text string"))))


FIRST = [("/a", "shared page"), ("/c", "own\ntext"), ("/d", "to be changed"), ("/e", "once\nshared")]
THEN = [("/A", "shared page"), ("/d", "own\ntext"), ("/f", "to be changed"), ("/b", "once\nshared")]


@pytest.mark.parametrize("second", [THEN, [("/a", "now different")], [("/zz", "shared page")]])
def test_refresh_equals_a_full_run(spark, rows, second):
    arrived = pages_of(spark, second)
    got = refresh_corpus(full_corpus(pages_of(spark, FIRST)), arrived)
    merged = {**dict(FIRST), **dict(second)}
    want = full_corpus(pages_of(spark, list(merged.items())))
    for name in ("pages", "documents", "chunks"):
        frame = getattr(want, name)
        assert rows(getattr(got, name), *frame.columns) == rows(frame)


def test_emptied_documents_go(spark, rows):
    arrived = spark.createDataFrame([("/a", ""), ("/d", None), ("/new", "here")], "path string, text string")
    files = identify(arrived)
    got = refresh_corpus(full_corpus(pages_of(spark, FIRST)), assemble_pages(line_elements(files)), files)
    want = full_corpus(pages_of(spark, [("/c", "own\ntext"), ("/e", "once\nshared"), ("/new", "here")]))
    for name in ("pages", "documents", "chunks"):
        frame = getattr(want, name)
        assert rows(getattr(got, name), *frame.columns) == rows(frame)


def test_emptied_documents_go_from_a_stream(spark, tmp_path, rows):
    landing, root, progress = str(tmp_path / "in"), str(tmp_path / "corpus"), str(tmp_path / "progress")
    for texts in ([("/a", "one"), ("/b", "two")], [("/a", ""), ("/c", "three")]):
        frame = spark.createDataFrame(texts, "path string, text string")
        frame.coalesce(1).write.mode("append").parquet(landing)
        stream = identify(spark.readStream.schema(frame.schema).parquet(landing))
        refresh_from_stream(stream, root, progress, line_elements)
    assert rows(current_corpus(spark, root).chunks, "chunk_text") == [("three",), ("two",)]
    again = identify(spark.readStream.schema(frame.schema).parquet(landing))
    with pytest.raises(StreamingQueryException, match="from checkpoint"):
        refresh_from_stream(again, root, str(tmp_path / "other"), line_elements)
    assert rows(current_corpus(spark, root).chunks, "chunk_text") == [("three",), ("two",)]


def test_streamed_refresh(spark, tmp_path, rows, monkeypatch):
    monkeypatch.setattr(refresh, "FULL_EVERY", 3)
    landing, root, progress = tmp_path / "in", str(tmp_path / "corpus"), str(tmp_path / "progress")
    landing.mkdir()
    assert current_corpus(spark, root) is None
    seen = {}
    # Each path lands once: a file stream does not look at a known path again.
    arrivals = [FIRST, [("/A", "shared page"), ("/g", "own\ntext")], [("/b", "once\nshared")], [], [("/B", "own\ntext")], [("/C", "new")]]
    for texts in arrivals:
        for path, text in texts:
            (landing / (path.strip("/") + ".txt")).write_text(text)
            seen[path] = text
        stream = file_stream(spark, f"file://{landing}", "*.txt")
        refresh_from_stream(line_elements(decode_text(stream)), root, progress)
        files = [(f"file:{landing}{path}.txt", text) for path, text in seen.items()]
        want = full_corpus(pages_of(spark, files))
        assert rows(current_corpus(spark, root).chunks, *want.chunks.columns) == rows(want.chunks)


def test_a_small_batch_reads_no_text_of_other_pages(spark, tmp_path):
    """Of the pages before, narrow columns; of the documents, the folders of the hashes that move."""
    root, progress, landing = str(tmp_path / "corpus"), str(tmp_path / "progress"), str(tmp_path / "in")
    frame = spark.createDataFrame([(f"/p{i}", f"text {i}") for i in range(60)] + [("/q", "text 7")], "path string, text string")
    frame.write.parquet(landing)
    refresh_from_stream(identify(spark.readStream.schema(frame.schema).parquet(landing)), root, progress, line_elements)
    before = current_corpus(spark, root)
    arrived = assemble_pages(line_elements(identify(spark.createDataFrame([("/p7", "other")], "path string, text string"))))
    out = io.StringIO()
    changes = refresh.corpus_changes(before, arrived)
    with redirect_stdout(out):
        changes["documents"].come.explain("formatted")
    scans = [part for part in out.getvalue().split("\n\n") if "Scan parquet" in part]
    pages = [s for s in scans if "/full/pages" in s]
    stored = [s for s in scans if "/full/documents" in s and "page_text" in s]
    assert pages and not any("page_text" in s for s in pages)
    assert stored and all("hash_bucket" in s.split("PartitionFilters", 1)[1].split("\n", 1)[0] for s in stored)
    # The copy of the old text moves to the other file.
    assert [(r["source_path"], r["page_text"]) for r in changes["documents"].come.orderBy("source_path").collect()] == [("/p7", "other"), ("/q", "text 7")]


def test_a_bad_text_is_found_by_halving(spark):
    def calls_for(bad, n):
        counted = []

        def call(texts):
            counted.append(len(texts))
            if any(t == "bad" for t in texts):
                raise ValueError("no")
            return [len(t) for t in texts]

        batch = pd.DataFrame({"t": ["bad" if i in bad else "fine" for i in range(n)]})
        rows = models.results_of(call, batch["t"])
        assert [r["error"] is not None for r in rows] == [i in bad for i in range(n)]
        assert all(r["value"] == 4 for i, r in enumerate(rows) if i not in bad)
        return len(counted)

    for n in (1, 2, 100, 1024):
        assert calls_for({n // 3}, n) <= 2 * math.ceil(math.log2(n)) + 1
        assert calls_for(set(), n) == 1
    short = models.results_of(lambda texts: [1], pd.Series(["a", "b", "c"]))
    assert [r["value"] for r in short] == [1, 1, 1]
    assert "one value per text" in models.results_of(lambda texts: [], pd.Series(["a"]))[0]["error"]


def test_cleaning_up(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "checkpoint_folder", lambda _: f"file://{tmp_path}")
    assert clear_staged(spark) is False
    assert stage(spark.range(3), "x").count() == 3
    assert clear_staged(spark) is True and not (tmp_path / "leafmill-staged").exists()
    ensure_schemas(spark, ["leafmill_gone"], f"file://{tmp_path}")
    overwrite_table(spark.range(2), "leafmill_gone.numbers")
    drop_schemas(spark, ["leafmill_gone", "leafmill_never_there"])
    assert not spark.catalog.databaseExists("leafmill_gone")


@pytest.mark.parametrize("shape", ["a folder of files", "a file"])
def test_a_table_among_others_is_streamed_whole(spark, tmp_path, rows, shape):
    landed, made = tmp_path / "landed", tmp_path / "made"
    spark.createDataFrame([(k, f"t{k}") for k in range(9)], "doc_id bigint, text string").repartition(3).write.parquet(str(made))
    spark.range(5).write.parquet(str(landed / "labels.parquet"))
    if shape == "a file":
        spark.read.parquet(str(made)).coalesce(1).write.parquet(str(tmp_path / "one"))
        (part,) = (tmp_path / "one").glob("*.parquet")
        part.rename(landed / "documents.parquet")
    else:
        made.rename(landed / "documents.parquet")
    out = str(tmp_path / "out")
    for _ in range(2):
        stream = table_stream(spark, str(landed), "doc_id bigint, text string", "documents.parquet")
        ingest(stream, lambda r: r, out, str(tmp_path / "progress"))
    assert rows(spark.read.parquet(out), "doc_id", "text") == [(k, f"t{k}") for k in range(9)]
