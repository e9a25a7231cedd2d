"""Repeated word windows, filter audit and whitening on small tables, against brute force."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafmill.llm import audit, doubling, queries, whitening

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def spoken(seed: int, count: int, letters: str = "abcdefghij") -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 4))) for _ in range(count))


PASSAGE = spoken(1, 45)
TEXTS = [
    (0, spoken(2, 30) + " " + PASSAGE + " " + spoken(3, 40)),
    (1, PASSAGE.replace(" ", "\t\n", 7)),
    (2, spoken(4, 10) + " " + " ".join(PASSAGE.split()[3:23]) + " " + spoken(5, 10)),
    (3, spoken(6, 10) + " " + " ".join(PASSAGE.split()[3:22]) + " " + spoken(7, 10)),
    (4, None),
    (5, ""),
    (6, " \t\r\n"),
    (7, "na " * 200),
    (8, spoken(8, 3000, "ab")),
    (9, spoken(8, 3000, "ab")),
    (10, "é ü " * 25),
    (11, spoken(9, 19)),
    (12, spoken(9, 19)),
    (13, spoken(9, 20)),
    (14, PASSAGE.upper()),
    (15, spoken(10, 4000, "a")),
    (16, "x\x0by\x0cz " + PASSAGE),
]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def without_later(rows, length):
    """rows: (doc_id, text) in order of their ids."""
    seen, out = set(), []
    for key, text in rows:
        split = words(text)
        gone = [False] * len(split)
        for at in range(len(split) - length + 1):
            window = tuple(split[at : at + length])
            if window in seen:
                gone[at : at + length] = [True] * length
            seen.add(window)
        out.append((key, len(split), sum(gone), " ".join(w for w, g in zip(split, gone) if not g)))
    return out


@pytest.mark.parametrize("length, shortest, slice_bytes", [(20, 5, 1 << 21), (20, 5, 300), (6, 3, 200), (8, 1, 100)])
def test_later_windows(spark, monkeypatch, length, shortest, slice_bytes):
    monkeypatch.setattr(doubling, "SLICE_BYTES", slice_bytes)
    shuffled = random.Random(3).sample(TEXTS, len(TEXTS))
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in shuffled], DOCS).repartition(3)
    # Further columns are not read, even if they have the names of results.
    docs = docs.withColumns({"kept": F.lit(1), "n_words": F.lit("x"), "slice": F.lit(0)})
    got = sorted(tuple(r) for r in doubling.without_later_windows(docs, length=length, shortest=shortest).collect())
    assert got == without_later(TEXTS, length)


def test_later_windows_of_rows_without_an_id_of_their_own(spark):
    rows = [(1, PASSAGE + " end"), (1, PASSAGE), (None, PASSAGE), (None, PASSAGE), (2, PASSAGE), (3, None), (3, None)]
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in rows], DOCS)
    got = Counter(tuple(r)[:3] for r in doubling.without_later_windows(docs).collect())
    assert got[2, 45, 45] == 1 and got[None, 45, 45] == 2 and got[3, 0, 0] == 2
    # One of the two texts of id 1 is first, and stays whole.
    firsts = [k for k in got if k[0] == 1]
    assert sorted(firsts) in ([(1, 45, 0), (1, 46, 45)], [(1, 45, 45), (1, 46, 0)])


def test_later_windows_of_nothing(spark):
    empty = doubling.without_later_windows(spark.createDataFrame([], DOCS))
    assert empty.collect() == [] and empty.columns == ["doc_id", "n_words", "n_removed", "kept"]
    short = spark.createDataFrame([(1, "a b c", "en", "s", 5)], DOCS)
    assert [tuple(r) for r in doubling.without_later_windows(short).collect()] == [(1, 3, 0, "a b c")]


def test_later_windows_of_a_very_long_text(spark, monkeypatch):
    """A passage that many texts share, and one text much longer than a slice."""
    monkeypatch.setattr(doubling, "SLICE_BYTES", 1 << 14)
    rows = [(0, spoken(20, 40_000, "abcdefgh"))] + [(k, f"{spoken(100 + k, 5)} {PASSAGE} {spoken(500 + k, 5)}") for k in range(1, 120)]
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in rows], DOCS).repartition(4)
    got = sorted(tuple(r) for r in doubling.without_later_windows(docs).collect())
    assert got == without_later(rows, 20)


def test_levels():
    assert doubling.levels(20, 5) == [5, 10, 20]
    assert doubling.levels(6, 3) == [3, 6]
    with pytest.raises(ValueError):
        doubling.levels(7, 3)


def test_bytes_of_registered_windows(spark, tmp_path):
    spark.createDataFrame([(k, t, "en", "s", 0) for k, t in TEXTS], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in queries.op12_repeated_windows(spark, str(tmp_path)).collect())
    assert got == [(k, n, r, hashlib.sha256(t.encode()).hexdigest()) for k, n, r, t in without_later(TEXTS, 20)]


# Filter audit


def test_left_by_galloping():
    rng = random.Random(5)
    for _ in range(400):
        top = rng.choice([5, 50, 5000])
        lists = [sorted(rng.sample(range(top), rng.randint(0, min(top, 40)))) for _ in range(rng.randint(1, 5))]
        assert audit.left(lists[0], lists[1:]) == len(set(lists[0]).difference(*lists[1:]))


AUDITED = [
    (1, "word " * 60, "a"),
    (2, "word " * 60, "a"),
    (3, " ".join(f"w{i}" for i in range(60)), "a"),
    (4, " ".join(f"W{i}" for i in range(60)), "a"),
    (5, "cash $ only", "a"),
    (6, None, "a"),
    (7, "", None),
    (8, "CAPS & more", None),
    (9, "CAPS & more", "b"),
    (9, "CAPS & more", "b"),
    (None, "CAPS & more", "b"),
    (10, "é" * 5000 + " " + "w " * 70, "c"),
    (11, " ".join(f"w{i}" for i in range(60)), "c"),
]
LABELS = [(1, 1, 0), (2, 0, 1), (3, 1, 1), (8, 1, 0), (9, 0, 1), (9, 1, 0), (99, 1, 1), (None, 1, 1), (11, None, None)]


def audited(rows, labels):
    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, t in labels if t == 1 and k is not None}
    least: dict = {}
    for key, text, _ in rows:
        if key is not None:
            least[text or ""] = min(key, least.get(text or "", key))
    failing = []
    for key, text, part in rows:
        text, split = text or "", words(text)
        tests = {
            "A": len(split) < 50,
            "B": 100 * len(set(split)) < 65 * len(split),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": re.search(r"[#$%&*|]", text) is not None,
            "E": key is not None and least[text] < key,
        }
        failing.append((part or "", {f for f, yes in tests.items() if yes}, key in good, key in toxic))
    out = []
    for part in {p for p, *_ in failing}:
        mine = [f for f in failing if f[0] == part]
        shapley = Counter()
        listed = []
        for order in itertools.permutations("ABCDE"):
            for step, name in enumerate(order):
                before = set(order[:step])
                gone = [f for f in mine if name in f[1] and not f[1] & before]
                shapley[name] += len(gone)
                listed.append((
                    part, "".join(order), step + 1,
                    sum(not f[1] & (before | {name}) for f in mine), len(gone),
                    sum(name in f[1] and bool(f[1] & before) for f in mine), sum(f[1] == {name} for f in mine),
                    sum(f[2] for f in gone), sum(f[3] for f in gone),
                ))
        out += [(*row, shapley[row[1][row[2] - 1]]) for row in listed]
    return sorted(out)


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


@pytest.mark.parametrize("size", [audit.RANGE, 2])
def test_audit(spark, tmp_path, monkeypatch, size):
    monkeypatch.setattr(audit, "RANGE", size)
    docs = spark.createDataFrame([(k, t, "en", s, 0) for k, t, s in AUDITED], DOCS)
    docs.withColumn("part", F.lit("other")).withColumn("A", F.lit(True)).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(LABELS, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = queries.op13_filter_audit(spark, str(tmp_path))
    assert sorted(tuple(r) for r in got.select(*COLUMNS).collect()) == audited(AUDITED, LABELS)


def test_audit_of_nothing_and_of_other_filters(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert queries.op13_filter_audit(spark, str(tmp_path)).collect() == []
    rows = spark.createDataFrame([(None, 1), (None, None), ("x", 3)], "p string, v int")
    found = audit.interactions(rows, "p", {"lo": F.col("v") < 2, "hi": F.col("v") > 2}, {})
    got = {(r["part"], r["filter_order"], r["step"]): (r["kept"], r["removed"], r["shapley"]) for r in found.collect()}
    assert got == {
        (None, "lohi", 1): (1, 1, 2), (None, "lohi", 2): (1, 0, 0), (None, "hilo", 1): (2, 0, 0), (None, "hilo", 2): (1, 1, 2),
        ("x", "lohi", 1): (1, 0, 0), ("x", "lohi", 2): (0, 1, 2), ("x", "hilo", 1): (0, 1, 2), ("x", "hilo", 2): (0, 0, 0),
    }


# Whitening


def fit_by_library(vectors):
    """n, sums, eigenvalues and components by the symmetric eigensolver, from distinct whole vectors."""
    distinct = np.unique(np.array(vectors), axis=0)
    mean = distinct.mean(axis=0)
    values, axes = np.linalg.eigh((distinct - mean).T @ (distinct - mean) / len(distinct))
    return len(distinct), distinct.sum(axis=0), values[::-1], axes[:, ::-1]


def test_whitening(spark):
    rng = np.random.default_rng(1)
    good = [(int(k), (rng.normal(size=6) * [3, 2, 1.5, 1, 0.5, 0.2]).astype(np.float32).tolist()) for k in range(300)]
    good += [(1000, good[0][1]), (1000, good[0][1]), (None, good[1][1])]
    faulty = [
        (2000, None), (2001, []), (2002, [None] + [0.0] * 5), (2003, [float("nan")] + [0.0] * 5),
        (2004, [float("-inf")] + [0.0] * 5), (2005, [1.0] * 5), (2006, [3e38] + [0.0] * 5),
    ]
    frame = spark.createDataFrame(good + faulty, "vec_id bigint, embedding array<float>").withColumns({"n": F.lit("x"), "x": F.lit(1)})
    rows = whitening.whitened(frame.repartition(3)).collect()
    whole = [[math.floor(256 * float(np.float32(c))) for c in v] for _, v in good]
    n, sums, values, axes = fit_by_library(whole)
    assert len(rows) == 4 * len(good) and {r["n"] for r in rows} == {n}
    assert {r["component"] for r in rows} == {1, 2, 3, 4} and max(r["identity_error"] for r in rows) < 1e-9
    by_id: dict = {}
    for r in rows:
        by_id.setdefault(r["vec_id"], []).append(r)
    assert len(by_id[1000]) == 8 and None in by_id
    signs = None
    for (key, _), x in zip(good, whole):
        mine = {r["component"]: r for r in by_id[key]}
        want = (np.array(x) - sums / n) @ axes[:, :4] / np.sqrt(values[:4])
        got = np.array([mine[c]["whitened"] for c in range(1, 5)])
        signs = np.sign(got * want) if signs is None else signs
        assert np.allclose(got * signs, want, rtol=1e-9, atol=1e-9)
        assert mine[1]["deviation"] == sum((n * a - int(s)) ** 2 for a, s in zip(x, sums))
        assert np.allclose([mine[c]["explained"] for c in range(1, 5)], values[:4] / values.sum(), rtol=1e-10)


def test_whitening_of_few_or_equal_vectors(spark):
    schema = "vec_id bigint, embedding array<double>"
    assert whitening.whitened(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whitened(spark.createDataFrame([(1, None)], schema)).collect() == []
    assert whitening.whitened(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect() == []
    two = whitening.whitened(spark.createDataFrame([(1, [0.0, 1.0, 0.0]), (2, [1.0, 1.0, 0.0])], schema)).collect()
    # Two points span one component.
    assert sorted((r["vec_id"], r["component"], r["n"], r["deviation"], r["whitened"], r["explained"]) for r in two) == [
        (1, 1, 2, 65536, -1.0, 1.0), (2, 1, 2, 65536, 1.0, 1.0),
    ]


def test_whitening_of_large_entries(spark):
    rng = random.Random(2)
    rows = [(k, [rng.randint(-(2**45), 2**45) / 256 for _ in range(3)]) for k in range(50)]
    got = whitening.whitened(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    n, _, values, _ = fit_by_library([[math.floor(256 * c) for c in v] for _, v in rows])
    assert len(got) == 150 and {r["n"] for r in got} == {n}
    # The exact sum is beyond a bigint.
    assert all(r["deviation"] is None for r in got)
    assert np.allclose(sorted({r["explained"] for r in got}, reverse=True), values[:3] / values.sum(), rtol=1e-9)


def test_exact_products_and_scatter(spark):
    rng = np.random.default_rng(3)
    for top in (100, 1 << 30, 1 << 46):
        rows = rng.integers(-top, top, size=(300, 4))
        exact = sum((np.outer(r, r) for r in rows.astype(object)), np.zeros((4, 4), object))
        assert (whitening.exact_products(rows) == exact).all()


def test_rotations_equal_the_library():
    rng = np.random.default_rng(4)
    for size, rank in ((1, 1), (2, 2), (5, 5), (8, 3), (33, 33), (64, 64)):
        half = rng.normal(size=(size, rank)) * np.logspace(0, -4, rank)
        matrix = half @ half.T
        values, axes = whitening.rotated(whitening.trapezoid(matrix))
        expected = np.linalg.eigvalsh(matrix)[::-1][:rank]
        assert len(values) >= rank and np.allclose(values[:rank], expected, rtol=1e-6, atol=1e-14 * expected[0])
        assert np.allclose(axes[:rank] @ axes[:rank].T, np.eye(rank), atol=1e-8)
        assert np.allclose((axes.T * values) @ axes, matrix, atol=1e-12)


@pytest.mark.parametrize("name", ["op11_whitened_embeddings", "op12_repeated_windows", "op13_filter_audit"])
def test_registered(name):
    assert name in queries.QUERIES
