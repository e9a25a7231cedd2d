from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafmill.operators.chunks import diff_chunks
from leafmill.operators.context import (
    asset_contexts,
    asset_hits,
    asset_prompt,
    citations,
    cited,
    contexts,
    last_message,
    message_lists,
    message_rows,
)
from leafmill.operators import keyword
from leafmill.operators.hybrid import fuse, with_chunks
from leafmill.operators.keyword import KeywordIndex, build_index, joined_top_k, keyword_top_k, refresh_index
from leafmill.operators.topk import RunningBest
from leafmill.operators.vectors import dense_vectors, text_vectors, vector_changes, vector_top_k, vector_top_k_within
from leafmill.plans.answers import answer_hits, build_search_index

K1, B = 1.2, 0.75


def corpus(n=400, seed=5):
    """Texts with a few very common words, many rare ones, and repeated texts."""
    rng = random.Random(seed)
    common = ["the", "of", "and", "bus"]
    texts = []
    for i in range(n):
        words = rng.choices(common, k=rng.randint(0, 12)) + [f"w{int(rng.paretovariate(0.6))}" for _ in range(rng.randint(0, 8))]
        rng.shuffle(words)
        texts.append(" ".join(words))
    texts += ["the same text w1"] * (n // 2)
    return [(f"c{i:04d}", t) for i, t in enumerate(texts)]


QUESTIONS = [(1, "the bus w3 w17"), (2, "the of and"), (3, "w2 w2 w9"), (4, "nowhere"), (5, ""), (6, "the same text"), (7, "w1 w5 w7 w11 the the")]


def brute_bm25(chunks, questions, k):
    words = {c: Counter(t.split()) for c, t in chunks}
    lens = {c: sum(w.values()) for c, w in words.items()}
    mean = sum(lens.values()) / len(lens)
    df = Counter(t for w in words.values() for t in w)
    out = {}
    for q, text in questions:
        scored = []
        for c, w in words.items():
            s = sum(
                math.log(1 + (len(words) - df[t] + 0.5) / (df[t] + 0.5)) * w[t] * (K1 + 1) / (w[t] + K1 * (1 - B + B * lens[c] / mean))
                for t in set(text.split())
                if w[t]
            )
            if s > 0:
                scored.append((-round(s, 6), c))
        out[q] = [c for _, c in sorted(scored)[:k]]
    return {q: hits for q, hits in out.items() if hits}


def listed(hits):
    out: dict = {}
    for r in sorted(hits.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append(r["chunk_id"])
    return out


@pytest.fixture(scope="module")
def chunks(spark):
    return spark.createDataFrame(corpus(), "chunk_id string, chunk_text string").repartition(5).persist()


@pytest.fixture(scope="module")
def index(chunks):
    return build_index(chunks)


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame(QUESTIONS, "query_id bigint, query_text string")


@pytest.mark.parametrize("k", [1, 6, 50])
def test_keyword_ranking_is_exact(queries, index, k):
    assert listed(keyword_top_k(queries, index, k)) == brute_bm25(corpus(), QUESTIONS, k)


@pytest.mark.parametrize("share", [0.0, 0.02, 0.2, 1.0])
def test_join_form_is_exact_for_any_split_of_terms(queries, index, share):
    assert listed(joined_top_k(queries, index, 6, share)) == brute_bm25(corpus(), QUESTIONS, 6)


def test_join_form_settles_questions_with_rare_terms(spark):
    """Rare terms decide: frequent ones are completed for close chunks only."""
    data = [(f"c{i:03d}", "the of " + ("rare word here " * 3 if i < 9 else "x" * (i % 5 + 1))) for i in range(300)]
    index = build_index(spark.createDataFrame(data, "chunk_id string, chunk_text string"))
    asked = [(1, "rare word here the of")]
    got = joined_top_k(spark.createDataFrame(asked, "query_id bigint, query_text string"), index, 6, 0.05)
    assert listed(got) == brute_bm25(data, asked, 6)


def test_large_question_sets_take_the_join_form(queries, index):
    expected = listed(keyword_top_k(queries, index))
    assert listed(keyword_top_k(queries, index, block=2)) == expected
    assert listed(keyword_top_k(queries, index, term_block=3)) == expected


def test_questions_without_any_known_term(spark, index):
    none = spark.createDataFrame([(1, "nowhere"), (2, None)], "query_id bigint, query_text string")
    assert keyword_top_k(none, index).collect() == []


def test_index_is_stored_and_read(spark, tmp_path, queries, index):
    index.write(str(tmp_path / "index"))
    again = KeywordIndex.read(spark, str(tmp_path / "index"))
    assert listed(keyword_top_k(queries, again)) == listed(keyword_top_k(queries, index))


def brute_cosine(vectors, asked, k, positive):
    out = {}
    for q, a in asked:
        scored = []
        for c, b in vectors:
            s = sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(y * y for y in b))
            if not positive or round(s, 6) > 0:
                scored.append((-round(s, 6), c))
        out[q] = [c for _, c in sorted(scored)[:k]]
    return out


@pytest.mark.parametrize("positive", [True, False])
@pytest.mark.parametrize("block", [2048, 3])
def test_vector_ranking_is_exact(spark, positive, block):
    rng = random.Random(2)
    vectors = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(200)] + [(1000 + i, [1.0] * 8) for i in range(20)]
    asked = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(9)] + [(99, [1.0] * 8)]
    given = dense_vectors(spark.createDataFrame(vectors, "chunk_id bigint, v array<double>"), "chunk_id", "v")
    wanted = dense_vectors(spark.createDataFrame(asked, "query_id bigint, v array<double>"), "query_id", "v")
    got = vector_top_k(wanted, given.repartition(4), 8, 6, positive, block)
    assert listed(got) == brute_cosine(vectors, asked, 6, positive)


def test_vectors_within_groups(spark):
    vectors = [(i, i % 2, [float(i + 1), 1.0]) for i in range(10)]
    frame = spark.createDataFrame(vectors, "chunk_id bigint, g int, v array<double>")
    given = dense_vectors(frame, "chunk_id", "v", ["g"])
    asked = dense_vectors(spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "query_id int, v array<double>"), "query_id", "v")
    got = vector_top_k_within(asked.withColumn("g", F.col("query_id")), given, "g", 2)
    assert listed(got) == {0: [8, 6], 1: [1, 3]}


def test_zero_and_empty_vectors_drop_out(spark):
    frame = spark.createDataFrame([(1, [0.0, 0.0]), (2, [0.0, 2.0]), (3, None)], "id bigint, v array<double>")
    assert [tuple(r) for r in dense_vectors(frame, "id", "v").collect()] == [(2, [0, 1], [0.0, 1.0])]
    texts = spark.createDataFrame([(1, ""), (2, "a a"), (3, None), (4, "--")], "id bigint, t string")
    assert [(r["id"], r["weights"]) for r in text_vectors(texts, "id", "t").collect()] == [(2, [1.0])]


def test_refreshed_index_equals_a_rebuilt_one(spark, chunks, rows):
    newer = spark.createDataFrame(corpus(seed=6), "chunk_id string, chunk_text string").where("chunk_id > 'c0050'")
    older = chunks.where("chunk_id < 'c0500'")
    changes = diff_chunks(older, newer)
    refreshed, rebuilt = refresh_index(build_index(older), changes, newer), build_index(newer)
    assert rows(refreshed.postings, "term", "chunk_id", "tf", "chunk_len") == rows(rebuilt.postings, "term", "chunk_id", "tf", "chunk_len")
    assert rows(refreshed.rows, "chunk_id", "chunk_len") == rows(rebuilt.rows, "chunk_id", "chunk_len")
    old_vectors = text_vectors(older, "chunk_id", "chunk_text")
    assert rows(vector_changes(old_vectors, changes, newer)) == rows(text_vectors(newer, "chunk_id", "chunk_text"))


HIT = "query_id bigint, chunk_id string, rank int"


def test_fusion(spark):
    one = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "x", 1)], HIT)
    two = spark.createDataFrame([(1, "b", 1), (1, "c", 2), (3, "y", 1)], HIT)
    got = fuse(one, two, k=2)
    assert listed(got) == {1: ["b", "a"], 2: ["x"], 3: ["y"]}
    best = got.where("query_id = 1 and rank = 1").first()
    assert best["score"] == round(1 / 61 + 1 / 62, 9)


CHUNK = "chunk_id string, doc_id string, source_path string, source_kind string, page_number int, chunk_text string"


def served(spark):
    chunks = spark.createDataFrame(
        [("c1", "d1", "/x/one.pdf", "oneline", 2, "t" * 300), ("c2", "d2", None, None, None, None), ("c3", "d3", "dir/", "k", 1, "z")], CHUNK
    )
    hits = spark.createDataFrame([(1, "c1", 2, 0.5), (1, "c2", 1, None), (2, "c3", 1, 0.1)], HIT + ", score double")
    return with_chunks(hits, chunks)


def test_context_blocks(spark):
    queries = spark.createDataFrame([(1,), (2,), (3,)], "query_id bigint")
    made = {r["query_id"]: r["context"] for r in contexts(queries, served(spark)).collect()}
    assert made[1] == "[doc:c2]  source=c2  kind=  page=0\n\n\n---\n\n[doc:c1]  source=one.pdf  kind=oneline  page=2\n" + "t" * 300
    assert made[2] == "[doc:c3]  source=c3  kind=k  page=1\nz"
    assert made[3] == "(no relevant results)"


def test_citations(spark):
    made = {r["query_id"]: r["citations"] for r in citations(served(spark)).collect()}
    assert [c["chunk_id"] for c in made[1]] == ["c2", "c1"]
    assert made[1][1].asDict() == {
        "chunk_id": "c1", "doc_id": "d1", "source_path": "/x/one.pdf", "source_kind": "oneline", "page_number": 2,
        "snippet": "t" * 280, "score": 0.5,
    }
    answers = spark.createDataFrame([(1, "As [doc:c1] says, and [doc:zz].")], "query_id bigint, answer string")
    assert {(r["chunk_id"], r["cited"]) for r in cited(served(spark), answers).collect()} == {("c1", True), ("c2", False), ("c3", False)}


TURN = "conv_id bigint, turn bigint, role string, text string"


def test_messages(spark, rows):
    turns = spark.createDataFrame(
        [(1, 0, "system", "s"), (1, 1, "user", "q"), (1, 2, "assistant", "a"), (2, 0, "system", "only"), (3, 0, "user", "x"), (3, 1, "user", "y"), (3, 2, "user", "z")],
        TURN,
    )
    assert rows(last_message(turns, "user")) == [(1, "q"), (2, ""), (3, "z")]
    assert rows(last_message(turns, "assistant")) == [(1, "a"), (2, ""), (3, "")]
    context = spark.createDataFrame([(1, "ctx"), (2, "none"), (3, "c")], "conv_id bigint, context string")
    made = message_rows(turns, context, "rules", "lead")
    one = made.where("conv_id = 1").orderBy("place", "turn").collect()
    assert [(r["role"], r["content"]) for r in one] == [("system", "rules"), ("user", "q"), ("assistant", "a"), ("system", "lead\n\nctx")]
    parts = {(r["conv_id"], r["part"]): [m["content"] for m in r["messages"]] for r in message_lists(made, per_part=2).collect()}
    assert parts == {
        (1, 0): ["rules", "q", "a", "lead\n\nctx"], (2, 0): ["rules", "lead\n\nnone"],
        (3, 0): ["rules", "x", "y", "lead\n\nc"], (3, 1): ["rules", "z", "lead\n\nc"],
    }


def test_assets_are_keyed_by_code_and_place(spark, rows):
    chunks = spark.createDataFrame(
        [("c1", "138L-1 138L-1", "Oak"), ("c2", "138L-1", "Oak"), ("c3", "138L-1", "Pine"), ("c4", "none", "Oak")],
        "chunk_id string, chunk_text string, place string",
    )
    assets = spark.createDataFrame([("A", "138L-1", "Oak"), ("B", "138L-1", "Pine"), ("C", "9X", "Oak")], "asset_id string, code string, place string")
    codes = F.regexp_extract_all("chunk_text", F.lit(r"(\d+[LB]-\d)"), F.lit(1))
    assert rows(asset_hits(chunks, assets, codes, 6, "place"), "asset_id", "chunk_id", "rank") == [("A", "c1", 1), ("A", "c2", 2), ("B", "c3", 1)]
    assert rows(asset_hits(chunks, assets, codes, 2), "asset_id", "chunk_id") == [("A", "c1"), ("A", "c2"), ("B", "c1"), ("B", "c2")]
    assert "138L-1 at Oak" in spark.range(1).select(asset_prompt(F.lit("138L-1"), F.lit("Oak"), "%s at %s?")).first()[0]


def test_every_asset_has_a_context(spark):
    data = [("c1", "d", "/p/f.txt", "k", 2, "on 138L-1")]
    chunks = spark.createDataFrame(data, "chunk_id string, doc_id string, source_path string, source_kind string, page_number int, chunk_text string")
    assets = spark.createDataFrame([("A", "138L-1"), ("B", "9X"), ("N", None)], "asset_id string, code string")
    made = asset_contexts(chunks, assets, F.regexp_extract_all("chunk_text", F.lit(r"(\d+[LB]-\d)"), F.lit(1)))
    got = {r["asset_id"]: (r["context"], r["citations"] and [c["chunk_id"] for c in r["citations"]]) for r in made.collect()}
    none = ("(no relevant results)", None)
    assert got == {"A": ("[doc:c1]  source=f.txt  kind=k  page=2\non 138L-1", ["c1"]), "B": none, "N": none}


def test_hybrid_answers_find_the_passage(spark):
    data = [(f"c{i}", "d", "/p/f.txt", "k", 1, f"word{i} common text about topic{i % 7}") for i in range(60)]
    index = build_search_index(spark.createDataFrame(data, CHUNK))
    asked = spark.createDataFrame([(1, "common text about word17"), (2, "zzz")], "query_id bigint, query_text string")
    hits = answer_hits(asked, index, 3)
    assert [r["chunk_id"] for r in hits.where("rank = 1").collect()] == ["c17"]
    assert hits.count() == 3


def test_hits_are_decided_before_rounding():
    """A score that rounds to zero is still a hit; no score is none."""
    best = RunningBest(["q", "r"], 3, positive=True)
    best.add(np.array([[3e-8, 0.0], [0.0, 0.0], [2e-8, 0.0]]), np.array(["b", "c", "a"]))
    best.add(np.array([[0.0, 0.0], [1e-8, 0.0], [0.5, 0.0]]), np.array(["d", "e", "f"]))
    assert best.best[1] is None
    scores, ids = best.best[0]
    assert (scores.tolist(), ids.tolist()) == ([0.5, 0.0, 0.0], ["f", "a", "b"])


def test_scan_and_join_agree_on_a_word_of_all_chunks(spark):
    """A word that every chunk holds weighs little, but counts as shared in both forms."""
    chunks = spark.range(300).select(F.col("id").cast("string").alias("chunk_id"), F.lit("same word").alias("chunk_text"))
    asked = spark.createDataFrame([("q", "word"), ("none", "other")], "query_id string, query_text string")
    index = build_index(chunks)
    scan, join = (sorted(map(tuple, f(asked, index, 5).collect())) for f in (keyword_top_k, joined_top_k))
    assert scan == join and len(scan) == 5


def test_join_form_shuffles_no_pairs(spark):
    """Every chunk holds every word of every question; pairs are summed where their chunk is."""
    chunks = spark.range(400).select(F.col("id").cast("string").alias("chunk_id"), F.lit(" ".join(f"w{i}" for i in range(40))).alias("chunk_text"))
    asked = spark.createDataFrame([(q, " ".join(f"w{i}" for i in range(40))) for q in range(40)], "query_id bigint, query_text string")
    index = build_index(chunks)
    got = joined_top_k(asked, index, 1)
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(query_id" in plan and not re.search(r"hashpartitioning\(query_id#\d+L?, chunk_id#\d+", plan)
    blocks = joined_top_k(asked, index, 3, block=7)
    assert sorted(map(tuple, blocks.collect())) == sorted(map(tuple, joined_top_k(asked, index, 3).collect()))


def test_texts_of_chunks_without_a_hit_are_not_exchanged(spark):
    """Chunks meet the broadcast ids of the hits first; a hit whose chunk is gone, or without an id, stays."""
    made = spark.range(500).select(
        F.col("id").cast("string").alias("chunk_id"), F.lit("d").alias("doc_id"), F.lit("/p").alias("source_path"),
        F.lit("k").alias("source_kind"), F.lit(1).alias("page_number"), F.concat(F.lit("text "), "id").alias("chunk_text"),
    )
    rows = [(1, "7", 1, 0.5), (1, "gone", 2, 0.4), (2, "7", 1, 0.3), (2, None, 2, 0.2)]
    got = with_chunks(spark.createDataFrame(rows, "query_id bigint, chunk_id string, rank int, score double"), made)
    taken = sorted((r["query_id"], r["rank"], r["chunk_id"] or "", r["chunk_text"]) for r in got.collect())
    assert taken == [(1, 1, "7", "text 7"), (1, 2, "gone", ""), (2, 1, "7", "text 7"), (2, 2, "", "")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"BroadcastHashJoin \[chunk_id#\d+\], \[chunk_id#\d+\], LeftSemi", plan)


def test_the_scan_is_cut_by_what_it_holds(spark, queries, index, monkeypatch):
    """Pieces of a batch are cut by entries, so common words of many questions do not add up in a task."""
    expected = listed(keyword_top_k(queries, index, 6))
    monkeypatch.setattr(keyword, "ENTRIES_AT_A_TIME", 5)
    assert listed(keyword_top_k(queries, index, 6)) == expected == brute_bm25(corpus(), QUESTIONS, 6)
