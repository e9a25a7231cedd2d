"""Stored index, vector cells, two-level merge, labels."""

from __future__ import annotations

import io
import os
import random
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from leafmill.operators import blocks
from leafmill.operators.blocks import block_rows, block_top_k, build_blocks, deal_blocks, forward_rows, term_rows
from leafmill.operators.cells import build_cells, cell_top_k
from leafmill.operators.chunks import diff_chunks
from leafmill.operators.keyword import build_index, keyword_top_k
from leafmill.operators.security import user_labels
from leafmill.operators.topk import MERGE_TASKS, ranked, tree_ranked
from leafmill.operators.vectors import DIMS, dense_vectors, text_vectors, vector_top_k
from leafmill.plans.segments import (
    create_index,
    merge_segments,
    open_index,
    refresh_segments,
    stored_hybrid_top_k,
    user_hits,
    versions,
)
from leafmill.session import checkpoint_folder, freed_exchanges, staged
from leafmill.suite.search import dense_top6_cells, many_questions, refreshed

CHUNKS = "chunk_id string, chunk_text string, region string"


def plan_of(frame, mode="formatted"):
    out = io.StringIO()
    with redirect_stdout(out):
        frame.explain(mode)
    return out.getvalue()


def prose(rng, words, n):
    """Words of very uneven frequency."""
    return " ".join(words[min(int(rng.expovariate(0.08)), len(words) - 1)] for _ in range(n))


def corpus(spark, seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    rows = [(f"c{rng.random():.12f}", prose(rng, words, rng.randint(1, 60)), rng.choice(["N", "S", None])) for _ in range(n)]
    return rows + [("empty", "", "N"), ("null", None, "S"), ("marks", "--- !", None)]


def asked(spark, seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(330)]
    rows = [(k, prose(rng, words, rng.randint(1, 8))) for k in range(n)] + [(n, ""), (n + 1, None), (n + 2, "w299 w3"), (n + 2, "w0")]
    return spark.createDataFrame(rows, "query_id bigint, query_text string")


@pytest.fixture
def small(monkeypatch):
    """Ranges of eight chunks, so that blocks are many."""
    monkeypatch.setattr(blocks, "RANGE_BITS", 3)
    monkeypatch.setattr(blocks, "RANGE_CHUNKS", 8)


@pytest.mark.parametrize("k, block", [(1, 2048), (6, 2048), (6, 7), (100, 2048)])
def test_blocks_rank_like_the_scan(spark, rows, small, k, block):
    chunks = spark.createDataFrame(corpus(spark, 1, 400), CHUNKS)
    queries = asked(spark, 2, 40)
    want = keyword_top_k(queries, build_index(chunks), k)
    got = block_top_k(queries, build_blocks(chunks), k, block=block)
    assert rows(got, *want.columns) == rows(want)


def test_blocks_of_nothing(spark, rows):
    queries = asked(spark, 3, 3)
    none = spark.createDataFrame([], CHUNKS)
    assert block_top_k(queries, build_blocks(none)).collect() == []
    index = build_blocks(spark.createDataFrame([("a", "only this", None)], CHUNKS))
    assert block_top_k(queries.limit(0), index).collect() == []
    assert block_top_k(spark.createDataFrame([(1, "other words")], queries.schema), index).collect() == []
    assert rows(index.postings) == [("only", "a", 1, 2), ("this", "a", 1, 2)]


def test_blocks_are_skipped_and_folders_pruned(spark, small, tmp_path):
    """A rare word and a frequent one: only blocks that can reach the best are read, from the words' folders."""
    filler = [(f"c{i:04d}", "often " + "word " * 20, None) for i in range(400)]
    best = [(f"d{i}", "often seldom", None) for i in range(3)]
    chunks = spark.createDataFrame(filler + best, CHUNKS)
    create_index(chunks, str(tmp_path / "index"))
    index = open_index(spark, str(tmp_path / "index"))
    hits = block_top_k(spark.createDataFrame([(1, "often seldom")], "query_id bigint, query_text string"), index, 3)
    assert [r["chunk_id"] for r in hits.orderBy("rank").collect()] == ["d0", "d1", "d2"]
    plan = plan_of(hits)
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters", 1)[1].split("\n", 1)[0]
    # The blocks the questions want were staged: few of the fifty ranges.
    mine = index.blocks.where(F.col("term") == "often").count()
    mark = blocks.totals(index)
    assert mine >= 50 and mark[0] == 403


def by_rebuild(spark, rows, root, chunks, queries):
    """The stored index answers like one built anew from the chunks."""
    index, fresh = open_index(spark, root), build_index(chunks)
    want = keyword_top_k(queries, fresh)
    assert rows(block_top_k(queries, index), *want.columns) == rows(want)
    assert rows(index.postings, "term", "chunk_id", "tf", "chunk_len") == rows(fresh.postings, "term", "chunk_id", "tf", "chunk_len")
    vectors = text_vectors(chunks, "chunk_id", "chunk_text")
    assert rows(index.vectors) == rows(vectors)


def test_segments_refresh_and_merge(spark, rows, small, tmp_path):
    root = str(tmp_path / "index")
    first = corpus(spark, 4, 150)
    queries = asked(spark, 5, 15)
    old = spark.createDataFrame(first, CHUNKS)
    create_index(old, root, label="region")
    by_rebuild(spark, rows, root, old, queries)
    with pytest.raises(ValueError, match="already"):
        create_index(old, root)
    # Some go, some change, some come; then one only goes; then nothing changes.
    changed = [(k, (t or "") + " w5 w290", r) for k, t, r in first[10:40]] + first[50:] + [("new1", "w1 w2 w2 w290", "N"), ("new2", "w290", None)]
    for rows_now in (changed, changed[1:], changed[1:]):
        new = spark.createDataFrame(rows_now, CHUNKS)
        refresh_segments(spark, root, diff_chunks(old, new), new, label="region")
        by_rebuild(spark, rows, root, new, queries)
        old = new
    assert versions(spark, root) == [1, 2, 3, 4]
    assert merge_segments(spark, root) == 5
    by_rebuild(spark, rows, root, old, queries)
    assert merge_segments(spark, root) is None
    # A session of its own, and the version before.
    other = spark.newSession()
    assert open_index(other, root).forward.select("segment").distinct().count() == 1
    assert open_index(other, root, 1).alive.count() == len(first)
    with pytest.raises(ValueError, match="no version"):
        open_index(spark, root, 9)


def test_a_refresh_reads_changed_text_only(spark, tmp_path):
    root = str(tmp_path / "index")
    old = spark.createDataFrame([("a", "one", None), ("b", "two", None)], CHUNKS)
    create_index(old, root)
    changes = spark.createDataFrame([("b", "update"), ("c", "insert")], "chunk_id string, change string")
    # Text of unchanged chunks would fail.
    loud = F.when(F.col("chunk_id") == "a", F.raise_error(F.lit("read"))).otherwise(F.col("chunk_text"))
    new = spark.createDataFrame([("a", "one", None), ("b", "three", None), ("c", "four", None)], CHUNKS)
    refresh_segments(spark, root, changes, new.withColumn("chunk_text", loud))
    merge_segments(spark, root)
    assert sorted(r["term"] for r in open_index(spark, root).postings.collect()) == ["four", "one", "three"]


def test_an_unfinished_version_is_not_seen(spark, rows, tmp_path):
    root = str(tmp_path / "index")
    create_index(spark.createDataFrame([("a", "one", None)], CHUNKS), root)
    # What a refresh leaves that fails before the end.
    spark.createDataFrame([(1, 0, 1, [])], "segment int, number bigint, chunk_len int, terms array<struct<value:string,n:int>>").write.parquet(f"{root}/gone/2")
    (tmp_path / "index" / "versions" / "2").mkdir()
    assert versions(spark, root) == [1]
    assert rows(open_index(spark, root).postings, "term") == [("one",)]
    changes = spark.createDataFrame([("b", "insert")], "chunk_id string, change string")
    new = spark.createDataFrame([("a", "one", None), ("b", "two", None)], CHUNKS)
    assert refresh_segments(spark, root, changes, new) == 2
    assert rows(open_index(spark, root).postings, "term") == [("one",), ("two",)]


def test_hits_of_users(spark, rows, small, tmp_path):
    root, listed = str(tmp_path / "index"), corpus(spark, 6, 300)
    chunks = spark.createDataFrame(listed, CHUNKS)
    create_index(chunks, root, label="region")
    users = spark.createDataFrame([("n", "N"), ("ns", "N"), ("ns", "S"), ("ns", "S"), ("x", None)], "user_email string, region_code string")
    people = ["n", "ns", "admin", "x", "stranger"]
    queries = asked(spark, 7, 25).withColumn("user_email", F.element_at(F.array(*map(F.lit, people)), (F.col("query_id") % 5 + 1).cast("int")))
    got = user_hits(queries, open_index(spark, root), users, admins=["admin"])
    # All chunks ranked, then those that the user may see.
    region = {c: r for c, _, r in listed}
    sees = {"n": {"N"}, "ns": {"N", "S"}, "admin": {"N", "S", None}, "x": set(), "stranger": set()}
    who = {r["query_id"]: r["user_email"] for r in queries.collect()}
    every = keyword_top_k(queries, build_index(chunks), 1000).orderBy("query_id", "rank").collect()
    want: dict = {}
    for r in every:
        if region[r["chunk_id"]] in sees[who[r["query_id"]]]:
            want.setdefault(r["query_id"], []).append((r["chunk_id"], r["score"]))
    expected = sorted((q, c, s, i + 1) for q, hits in want.items() for i, (c, s) in enumerate(hits[:6]))
    assert sorted(tuple(r) for r in got.select("query_id", "chunk_id", "score", "rank").collect()) == expected
    assert {r["user_email"]: r["labels"] for r in user_labels(users, ["admin", "n"]).collect()} == {"n": None, "ns": ["N", "S"], "x": [], "admin": None}


def test_stored_hybrid_finds_what_both_lists_find(spark, small, tmp_path):
    chunks = spark.createDataFrame(corpus(spark, 8, 60), CHUNKS)
    create_index(chunks, str(tmp_path / "index"))
    hits = stored_hybrid_top_k(asked(spark, 9, 5), open_index(spark, str(tmp_path / "index")))
    assert hits.count() > 0 and hits.groupBy("query_id").count().where("count > 6").count() == 0


def test_merging_in_two_levels(spark, rows):
    rng = random.Random(10)
    scored = spark.createDataFrame([(q, f"c{i}", rng.randint(0, 30) / 10) for q in range(4) for i in range(600)], "query_id int, chunk_id string, score double")
    spread = scored.repartition(MERGE_TASKS + 40)
    assert rows(tree_ranked(spread, 6), "query_id", "chunk_id", "score", "rank") == rows(ranked(scored, 6), "query_id", "chunk_id", "score", "rank")
    # A limit per group of tasks, before the one per query.
    plan = plan_of(tree_ranked(spread, 6))
    assert plan.count("WindowGroupLimit") >= 2 and "_tasks" in plan


def test_cells_find_what_the_scan_finds(spark, rows):
    rng = random.Random(11)
    middles = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(6)]
    given = [(i, [m + rng.gauss(0, 0.2) for m in middles[i % 6]]) for i in range(500)] + [(900, [0.0] * 8), (901, middles[0]), (902, middles[0])]
    vectors = dense_vectors(spark.createDataFrame(given, "chunk_id bigint, v array<double>"), "chunk_id", "v")
    queries = vectors.where("chunk_id % 9 = 0 OR chunk_id > 900").withColumnRenamed("chunk_id", "query_id")
    for k, positive, block in ((1, True, 2048), (6, False, 2048), (6, True, 10), (600, False, 2048)):
        want = vector_top_k(queries, vectors, 8, k, positive)
        got = cell_top_k(queries, build_cells(vectors, 8, 40), k, positive, block)
        assert rows(got, *want.columns) == rows(want)


def test_cells_are_left_out_by_their_bound(spark):
    """Far cells are not read for a question whose neighbours are close."""
    given = [(i, [1.0, (i % 100) / 1e4]) for i in range(200)] + [(1000 + i, [(i % 100) / 1e4, 1.0]) for i in range(200)]
    vectors = dense_vectors(spark.createDataFrame(given, "chunk_id bigint, v array<double>"), "chunk_id", "v")
    index = build_cells(vectors, 2, 16)
    from leafmill.operators import cells

    question = cells.QueryVectors.of(vectors.where("chunk_id = 5").withColumnRenamed("chunk_id", "query_id").collect())
    ddl, types = cells.hit_schema(vectors.withColumnRenamed("chunk_id", "query_id"), vectors)
    wanted = cells._wanted(question, index, 3, True, ddl, types)[0]
    far = index.pivots[:, 1] > 0.9
    assert not wanted[far].any() and wanted[~far].any()


def test_cells_of_text_and_of_nothing(spark, rows):
    chunks = spark.createDataFrame(corpus(spark, 12, 120), CHUNKS)
    vectors = text_vectors(chunks, "chunk_id", "chunk_text")
    queries = text_vectors(asked(spark, 13, 20).dropDuplicates(["query_id"]), "query_id", "query_text")
    want = vector_top_k(queries, vectors, DIMS)
    assert rows(cell_top_k(queries, build_cells(vectors, DIMS, 20)), *want.columns) == rows(want)
    none = vectors.limit(0)
    assert cell_top_k(queries, build_cells(none, DIMS)).collect() == []
    assert cell_top_k(queries.limit(0), build_cells(vectors, DIMS)).collect() == []


@pytest.mark.parametrize("block", [2048, 3])
def test_repeated_query_ids_count_once(spark, rows, block):
    vectors = dense_vectors(spark.createDataFrame([(i, [1.0, i / 10]) for i in range(20)], "chunk_id bigint, v array<double>"), "chunk_id", "v")
    queries = vectors.select((F.col("chunk_id") % 7).alias("query_id"), "buckets", "weights")
    got = vector_top_k(queries, vectors, 2, 2, block=block)
    assert got.count() == 14 and got.select("query_id", "rank").distinct().count() == 14


def test_every_chunk_asks(spark, rows):
    """A question for each chunk, of its first words, whatever the number of its document."""
    made = [(f"{d}_{i}", f"/corpus/src{d % 3}/{d}", f"d{d} c{i} " * 20) for d in range(120) for i in range(2)]
    held = spark.createDataFrame(made, "chunk_id string, source_path string, chunk_text string")
    assert rows(many_questions(held)) == sorted([(c, t[:60]) for c, _, t in made], key=repr)


def test_every_vector_asks_among_all(spark, tmp_path):
    rng = random.Random(4)
    vectors = [(k, [rng.gauss(0, 1) for _ in range(64)]) for k in range(130)]
    spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    hits = dense_top6_cells(spark, str(tmp_path)).collect()
    assert {r["query_id"] for r in hits} == set(range(130)) and len(hits) == 780
    assert all(r["vec_id"] == r["query_id"] for r in hits if r["rank"] == 1)


def test_nothing_gone_exchanges_nothing(spark, tmp_path):
    """The join with an empty table exchanged every row of the index."""
    create_index(spark.createDataFrame([("a", "one", None)], CHUNKS), str(tmp_path / "index"))
    assert "Join" not in plan_of(open_index(spark, str(tmp_path / "index")).alive)


def test_dealt_blocks_and_their_terms(spark, rows, small, monkeypatch):
    monkeypatch.setattr(blocks, "PACKED_TOGETHER", 50)
    listed = corpus(spark, 14, 300)
    forward = forward_rows(spark.createDataFrame(listed, CHUNKS), 3, label="region").localCheckpoint()
    made = block_rows(forward)
    dealt = deal_blocks(made)
    assert rows(dealt) == rows(made) and dealt.rdd.getNumPartitions() == 4
    # By hand: a term's postings, and the best four of each block, of these the best CHAMPIONS.
    want: dict = {}
    for r in forward.collect():
        for t in r["terms"]:
            want.setdefault(t["value"], []).append((-t["n"], r["chunk_len"], r["number"], r["label"]))
    got = term_rows(dealt).collect()
    assert {r["term"]: r["df"] for r in got} == {t: len(p) for t, p in want.items()} and len(got) == len(want)
    assert max(map(len, want.values())) > 2 * blocks.CHAMPIONS
    for r in got:
        best: dict = {}
        for p in want[r["term"]]:
            best.setdefault(p[2] >> 3, []).append(p)
        kept = [(-c["count"], c["len"], c["number"], c["label"]) for c in r["champions"]]
        least = min(blocks.CHAMPIONS, sum(min(len(b), blocks.CHAMPIONS_PER_BLOCK) for b in best.values()))
        assert len(kept) == len(set(kept)) == least and kept == sorted(kept, key=lambda p: p[:3]) and set(kept) <= set(want[r["term"]])


def shuffle_files(spark):
    return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()


def test_exchanges_and_chunk_tables_go_with_their_last_reader(spark, tmp_path):
    dealt = spark.range(1000).repartition(5)
    before = shuffle_files(spark)
    with freed_exchanges(spark):
        dealt.write.parquet(str(tmp_path / "freed"))
    assert shuffle_files(spark) <= before
    with staged(dealt, "chunks") as held:
        place = held.inputFiles()[0].split("://")[-1].replace("file:", "").rsplit("/", 1)[0]
        assert held.count() == 1000 and os.path.isdir(place)
    assert not os.path.exists(place)


def test_a_refreshed_index_holds_no_chunk_table(spark, tmp_path):
    said = [(k, f"line {k} of text\nle mot {k}", ("en", "es", "fr")[k % 3], f"src{k % 2}", 20) for k in range(12)]
    spark.createDataFrame(said, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(str(tmp_path / "documents.parquet"))
    folder = checkpoint_folder(spark).replace("file:", "") + "/leafmill-staged"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    index = open_index(spark, refreshed(spark, str(tmp_path)))
    assert index.alive.count() == 12 and index.gone.count() == 4
    assert not {n for n in set(os.listdir(folder)) - before if n.startswith(("chunks", "segment-blocks"))}
