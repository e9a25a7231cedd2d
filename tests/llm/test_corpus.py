"""Corpus operators on small tables, against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import uuid
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from leafmill.llm import archives, bpe, counts, language, leaks, minmax, phrases, quality, queries, repeats, shards
from leafmill.llm.common import letters, packed, powers
from leafmill.session import checkpoint_folder

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words_of(seed: int, count: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(count))


BASE = words_of(1, 120)
EDITED = BASE.replace(BASE.split()[60], "changed", 1)
PASSAGE = words_of(2, 60)

TEXTS = {
    0: BASE,
    1: BASE,
    2: EDITED,
    3: words_of(3, 90) + " " + PASSAGE + " " + words_of(4, 30),
    4: words_of(5, 40) + "\n" + PASSAGE + "\n" + words_of(6, 80),
    5: "",
    6: None,
    7: "one two",
    8: "One  TWO",
    9: "é" * 500,
    10: " \t\n",
    11: "na na " * 200,
    12: words_of(7, 4000),
}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "en", "s", len(t) if t else 0) for k, t in TEXTS.items()]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def table_of(frame, key="doc_id"):
    return {r[key]: r for r in frame.collect()}


def shingles(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return {tuple(found)} if 0 < len(found) < 5 else {tuple(found[i : i + 5]) for i in range(len(found) - 4)}


def test_near_duplicates(spark, docs, nothing):
    sets = {k: shingles(t) for k, t in TEXTS.items()}
    label = {k: k for k in TEXTS}
    for _ in TEXTS:
        for a in TEXTS:
            for b in TEXTS:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    got = table_of(minmax.near_duplicates(docs))
    assert {k: (r.n_shingles, r.component_id, r.kept) for k, r in got.items()} == {
        k: (len(sets[k]), label[k], label[k] == k) for k in TEXTS
    }
    assert minmax.near_duplicates(nothing).count() == 0
    odd = spark.createDataFrame([(None, BASE), (3, BASE), (3, BASE)], "doc_id bigint, text string")
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in minmax.near_duplicates(odd).collect()) == [
        (-1, -1, True), (3, 3, True), (3, 3, True),
    ]


def test_near_duplicates_of_texts_that_share_an_id(spark):
    """A link of one text of an id is not a link of the other."""
    first = words_of(40, 120).split()
    second = [f"other{k}" if k % 20 == 10 else w for k, w in enumerate(first)]
    assert 0.5 < len(shingles(" ".join(first)) & shingles(" ".join(second))) / len(shingles(" ".join(first)) | shingles(" ".join(second))) < 0.75
    near = lambda words: " ".join([*words[:-1], "changed"])
    rows = [(5, " ".join(first)), (5, " ".join(second)), (2, near(first)), (3, near(second))]
    got = minmax.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got) == [(2, 2, True), (3, 3, True), (5, 2, False), (5, 3, False)]


def test_near_duplicates_chain_and_crowd(spark):
    """A chain joins through its links; members of one bucket that are not alike stay apart."""
    rng, rows, base = random.Random(5), [], words_of(8, 100).split()
    for k in range(60):
        line = list(base)
        for at in rng.sample(range(100), k % 7):
            line[at] = f"x{k}y{at}"
        rows.append((k, " ".join(line)))
    got = table_of(minmax.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")))
    sets, label = {k: shingles(t) for k, t in rows}, {k: k for k, _ in rows}
    for _ in range(8):
        for a in label:
            for b in label:
                if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    assert {k: r.component_id for k, r in got.items()} == label


def test_near_duplicates_of_many_unlike_edits(spark):
    """Copies too far from their original to be linked with it are linked with each other where they are alike."""
    rng, rows, base = random.Random(9), [], words_of(4, 160).split()
    for k in range(120):
        line = list(base)
        for at in rng.sample(range(160), 4 + k % 9):
            line[at] = f"e{k}y{at}"
        rows.append((k, " ".join(line)))
        if k % 10 == 0:
            line[rng.randrange(160)] = f"again{k}"
            rows.append((1000 + k, " ".join(line)))
    got = table_of(minmax.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")))
    sets, label = {k: shingles(t) for k, t in rows}, {k: k for k, _ in rows}
    for _ in range(8):
        for a in label:
            for b in label:
                if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    assert {k: r.component_id for k, r in got.items()} == label


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a bigint, b bigint")
    assert {r.node: r.label for r in minmax.components(edges).collect()} == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


@pytest.mark.parametrize("length", [4, 9, 40])
def test_factors(length):
    rng = np.random.default_rng(length)
    text = rng.integers(0, 3, 400)
    text[250:330] = text[20:100]
    strings = [bytes(text[i : i + length].astype(np.uint8)) for i in range(len(text) - length + 1)]
    earlier, later = repeats.factors(text, length)
    assert earlier.tolist() == [i for i, s in enumerate(strings) if s in strings[:i]]
    assert later.tolist() == [i for i, s in enumerate(strings) if s in strings[i + 1 :]]


def removed(texts, length, keep_first):
    seen, marks = Counter(), {}
    for key in sorted(texts):
        raw = (texts[key] or "").encode()
        seen.update(raw[i : i + length] for i in range(len(raw) - length + 1))
    met = set()
    for key in sorted(texts):
        raw = (texts[key] or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            piece = raw[i : i + length]
            if (piece in met) if keep_first else seen[piece] > 1:
                gone[i : i + length] = True
            met.add(piece)
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()) if len(raw) else 0
        marks[key] = (len(raw), int(gone.sum()), runs, bytes(np.frombuffer(raw, np.uint8)[~gone]))
    return marks


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("sorted_blocks", [256, 1])
def test_without_repeats(docs, nothing, monkeypatch, keep_first, sorted_blocks):
    monkeypatch.setattr(repeats, "SORTED_BLOCKS", sorted_blocks)
    got = table_of(repeats.without_repeats(docs, keep_first=keep_first))
    assert {k: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for k, r in got.items()} == removed(TEXTS, 200, keep_first)
    if sorted_blocks == 256 and keep_first:
        assert repeats.without_repeats(nothing).count() == 0
        assert {"lang", "source", "n_chars"} <= set(repeats.without_repeats(docs).columns)


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("sorted_blocks", [256, 1])
def test_without_repeats_of_rows_without_an_id_of_their_own(spark, monkeypatch, keep_first, sorted_blocks):
    """Every row is cut by its own bytes, whatever id it has."""
    monkeypatch.setattr(repeats, "SORTED_BLOCKS", sorted_blocks)
    clean, other = words_of(30, 200), words_of(31, 200)
    rows = [
        (None, clean), (None, words_of(32, 50) + PASSAGE), (None, PASSAGE + words_of(33, 90)), (None, other), (None, other), (None, None),
        (5, words_of(34, 150)), (5, words_of(35, 70) + PASSAGE + words_of(36, 5)), (5, other), (5, BASE), (5, BASE), (6, EDITED),
    ]
    frame = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id bigint, text string, k int")
    hashes = {r.k: r.h for r in frame.selectExpr("k", "xxhash64(text) AS h").collect()}
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] or -1, hashes[k]))
    expected = removed({i: rows[k][1] for i, k in enumerate(order)}, 200, keep_first)
    got = repeats.without_repeats(frame, keep_first=keep_first).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == Counter(
        (rows[k][0], *expected[i]) for i, k in enumerate(order)
    )


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("sorted_blocks", [256, 1])
def test_repeats_in_texts_of_a_short_period_are_a_few_runs(spark, monkeypatch, keep_first, sorted_blocks):
    """A text is not a row per period, and runs cover the bytes that their blocks cover."""
    monkeypatch.setattr(repeats, "SORTED_BLOCKS", sorted_blocks)
    short, odd = "spam and eggs ", words_of(50, 20) + "\n"
    assert 69 < len(odd) < 137
    texts = {
        1: words_of(51, 30) + short * 150,
        2: short * 90 + words_of(52, 40) + short * 60,
        3: odd * 25,
        4: words_of(53, 40) + odd[7:] + odd * 14 + odd[:30],
        5: "a" * 700,
        6: words_of(54, 80) + "a" * 420 + words_of(55, 20),
        7: "é" * 300,
        8: odd + odd + odd[:40],
        9: words_of(56, 90),
    }
    frame = spark.createDataFrame(sorted(texts.items()), "doc_id bigint, text string")
    expected = removed(texts, 200, keep_first)
    got = table_of(repeats.without_repeats(frame, keep_first=keep_first))
    assert {k: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for k, r in got.items()} == expected
    if sorted_blocks == 256:
        spans = repeats.repeated_spans(packed(frame, "text", "pack"), F.col("doc_id"), F.col("pack"), keep_first=keep_first)
        assert sum(v[1] > 0 for v in expected.values()) <= spans.count() <= 60


def test_run_heads():
    """Equal blocks are one run where they touch in one text."""
    row = np.array([0, 0, 0, 0, 0, 1, 1, 1])
    anchor = np.array([7, 7, 7, 7, 7, 7, 7, 8])
    content = np.array([1, 1, 1, 2, 1, 1, 1, 1])
    begin = np.array([0, 3, 6, 9, 11, 14, 18, 21])
    end = np.array([2, 5, 8, 10, 13, 16, 20, 23])
    assert repeats.run_heads(row, anchor, content, begin, end).tolist() == [0, 3, 4, 5, 6, 7]
    assert repeats.run_heads(*(np.zeros(0, np.int64) for _ in range(5))).tolist() == []


def test_token_counts(docs, nothing):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    known = Tokenizer.from_file(path)
    got = table_of(counts.token_counts(docs, path))
    for key, text in TEXTS.items():
        n = len(known.encode(text or "", add_special_tokens=False).ids)
        assert (got[key].n_tokens, got[key].n_bytes, got[key].over_limit) == (n, len((text or "").encode()), n > 512)
    assert counts.token_counts(nothing, path).count() == 0


def test_special_strings_count_as_one(spark):
    frame = spark.createDataFrame([(1, "a<|endoftext|> b<|endoftext|>")], "doc_id bigint, text string")
    assert counts.token_counts(frame, public_tokenizers.path("byte_bpe_50k.json")).first().n_tokens == 4


def test_bpe_equals_the_library_and_round_trips(spark, docs, nothing):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    odd = {100: "x" * 3000, 101: "<|endoftext|>", 102: "日本語 テスト　'll  \n\n z", 103: "ab" * 400}
    frame = docs.union(spark.createDataFrame([(k, t, "en", "s", 0) for k, t in odd.items()], SCHEMA))
    got = table_of(bpe.decoded(bpe.encoded(frame, path, public_tokenizers.PATTERN), path))
    for key, text in (TEXTS | odd).items():
        ids = known.encode_ordinary(text or "")
        assert got[key].token_ids == ids and got[key].n_tokens == len(ids) and got[key].text == (text or "")
        assert got[key].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[key].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.encoded(nothing, path, public_tokenizers.PATTERN).count() == 0


def test_bpe_holds_ids_of_some_rows_at_a_time(spark, monkeypatch):
    """Output batches are cut by text, so one batch's ids need not fit a task; no row is lost or changed."""
    texts = [None, "", "a b", "wörter " * 40, None, "x" * 300, "end"]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id bigint, text string").coalesce(1)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    whole = sorted(map(tuple, bpe.encoded(frame, path, public_tokenizers.PATTERN).collect()))
    monkeypatch.setattr(bpe, "BATCH_BYTES", 8)
    assert sorted(map(tuple, bpe.encoded(frame, path, public_tokenizers.PATTERN).collect())) == whole
    assert [r[0] for r in whole] == list(range(len(texts))) and whole[0][1] == whole[1][1] == 0


def test_phrase_fingerprints(docs, nothing, spark):
    kit, keys = (letters(), *powers()), sorted(TEXTS)
    got = table_of(phrases.neighbour_fingerprints(docs))
    own = lambda t: phrases.printed((t or "").encode(), kit)
    for key, after in zip(keys, [*keys[1:], keys[0]]):
        text, following = TEXTS[key] or "", TEXTS[after] or ""
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        row = got[key]
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.fingerprint == own(text).astype(">u2").tobytes().hex()
        assert row.edited_fingerprint == own(edited).astype(">u2").tobytes().hex()
        assert row.near_edited == phrases.likeness(own(text), own(edited))
        assert row.near_next == phrases.likeness(own(text), own(following))
    assert phrases.neighbour_fingerprints(nothing).count() == 0
    one = spark.createDataFrame([(None, "abcd")], "doc_id bigint, text string")
    assert [r.edited_sha256 for r in phrases.neighbour_fingerprints(one).collect()] == [hashlib.sha256(b"abca").hexdigest()]


def test_parse_restarts_when_full(monkeypatch):
    monkeypatch.setattr(phrases, "FULL", 20)
    parse, raw = phrases.Parse(), words_of(3, 200).encode()
    parse.feed(raw[:500])
    state = parse.state()
    added = parse.feed(raw[500:900])
    parse.back(state, added)
    parse.feed(raw[500:])
    whole = phrases.Parse()
    whole.feed(raw)
    assert whole.ends == parse.ends


def test_quality(spark, docs, nothing):
    rng = random.Random(3)
    rows, labels = [], []
    for k in range(400):
        good = rng.random() < 0.7
        text = words_of(k, 80).capitalize() + "." if good else " | ".join(words_of(k, 60).split()) + "$$$"
        rows.append((k, text))
        labels.append((k, int(good)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    known = spark.createDataFrame([*labels, (None, 1), (5000, None)], "doc_id bigint, quality int")
    model = quality.fitted(frame, known)
    unseen = quality.scored(frame.where(quality.held_out(frame.doc_id)), model).join(known, "doc_id").collect()
    assert len(unseen) > 50 and sum((r.score >= 0.7) == bool(r.quality) for r in unseen) > 0.97 * len(unseen)
    assert all(0 <= r.score <= 1 for r in quality.scored(docs, model).collect())
    assert {r.h for r in docs.select(quality.held_out(docs.doc_id).alias("h")).collect()} <= {True, False}
    empty = quality.fitted(nothing, known.limit(0))
    assert quality.scored(nothing, empty).count() == 0 and quality.scored(docs, empty).count() == len(TEXTS)
    hashes = [zlib.crc32(str(k).encode()) % 4 == 2 for k, _ in rows]
    assert [r.h for r in frame.orderBy("doc_id").select(quality.held_out(frame.doc_id).alias("h")).collect()] == hashes


def test_every_two_replaced_words_leave_a_seed():
    for x in range(leaks.WINDOW):
        for y in range(x):
            assert any(
                all(at + i not in (x, y) for i, c in enumerate(mask) if c == "1")
                for mask in leaks.MASKS
                for at in range(leaks.WINDOW - len(mask) + 1)
            )


@pytest.mark.parametrize("size", range(1, 14))
def test_every_allowed_replacement_leaves_a_seed(size):
    spare = max(k for k in range(size + 1) if size - k >= leaks.SHARE * size)
    for replaced in itertools.combinations(range(size), spare):
        assert any(
            all(at + i not in replaced for i, c in enumerate(mask) if c == "1")
            for mask in leaks.masks_of(size)
            for at in range(size - len(mask) + 1)
        )


def leaked(docs, tests):
    """(doc_id, item_id): every alignment of every item with every document, window by window."""
    split = lambda text: [w for w in re.split(r"[^a-z0-9]+", (text or "").lower()) if w]
    out = set()
    for doc, text in docs:
        body = split(text)
        for item, wanted in tests:
            parts = split(wanted)
            window = min(len(parts), leaks.WINDOW)
            for shift in range(1 - len(parts), len(body)) if parts else ():
                same = [0 <= shift + i < len(body) and body[shift + i] == w for i, w in enumerate(parts)]
                if any(sum(same[k : k + window]) >= leaks.SHARE * window for k in range(len(parts) - window + 1)):
                    out.add((doc, item))
    return out


@pytest.mark.parametrize("block_seeds", [leaks.BLOCK_SEEDS, 40])
def test_leaks_of_items_of_every_length(spark, block_seeds):
    rng = random.Random(6)
    tests, texts = [], []
    for size in [*range(1, 15), 20, 40]:
        item = [f"w{size}x{i}" for i in range(size)]
        tests.append((size, " ".join(item)))
        window = min(size, leaks.WINDOW)
        spare = max(k for k in range(window + 1) if window - k >= leaks.SHARE * window)
        for replaced in {0, spare, spare + 1}:
            for _ in range(4):
                copy = list(item)
                for at in rng.sample(range(window), min(replaced, window)):
                    copy[at] = "other"
                texts.append(" ".join([*(f"a{rng.random()}" for _ in range(rng.randint(0, 5))), *copy, "end"]))
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = leaks.leaks(docs, spark.createDataFrame(tests, "item_id bigint, text string"), block_seeds=block_seeds)
    got = [(r.doc_id, r.item_id) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == leaked(rows, tests)


def test_leaks(spark, nothing):
    item, other = words_of(20, 30), words_of(21, 30)
    swapped = item.split()
    for at in (4, 13, 22):
        swapped[at] = "other"
    rows = [
        (1, words_of(22, 50) + " " + item.upper() + ", " + words_of(23, 9)),
        (2, " ".join(swapped)),
        (3, words_of(24, 200)),
        (4, " ".join(item.split()[10:]) + " " + words_of(25, 40)),
        (5, " ".join(w + " z" for w in item.split())),
        (6, None), (7, ""), (None, item), (1, other),
    ]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id bigint, text string, item_id string")
    tests = spark.createDataFrame([(1, item), (2, other), (3, "too short"), (None, item), (4, None)], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): (r.matched_words, r.item_words, r.at_word) for r in leaks.leaks(docs, tests).collect()}
    # Rows without an id are searched too, and count as one document.
    assert got == {(1, 1): (30, 30, 50), (2, 1): (27, 30, 0), (4, 1): (20, 30, -10), (1, 2): (30, 30, 0), (None, 1): (30, 30, 0)}
    assert leaks.leaks(nothing, tests).count() == 0 and leaks.leaks(docs, tests.limit(0)).count() == 0


def test_shards(spark, docs, nothing):
    crowd = spark.createDataFrame([(k, "copy" if k % 3 else words_of(k, k % 40)) for k in range(1000, 1600)], "doc_id bigint, text string")
    frame = docs.select("doc_id", "text").union(crowd).union(spark.createDataFrame([(None, "x")], "doc_id bigint, text string"))
    rows = [(r.doc_id, r.text or "") for r in frame.collect()]
    order = sorted(rows, key=lambda r: (int(hashlib.md5(r[1].encode()).hexdigest()[:15], 16), -1 if r[0] is None else r[0]))
    total, before, taken, expected = sum(len(t.encode()) + 1 for _, t in rows), 0, Counter(), {}
    for key, text in order:
        shard = before * 16 // total
        expected[key] = (len(text.encode()) + 1, shard, taken[shard])
        taken[shard] += 1
        before += len(text.encode()) + 1
    got = shards.sharded(frame, pieces=8)
    assert {r.doc_id: (r["size"], r.shard, r.slot) for r in got.collect()} == expected
    assert shards.sharded(nothing).count() == 0


def test_archives(spark):
    page = "<p>" + "é\r\n\r\nWARC/1.1\r\n" * 20 + "</p>"
    rows = [(5, "http://a/", page), (3, "http://b/\r\nx", page), (4, None, page), (9, "http://c/", "short"), (8, "http://d/", "short"),
            (1, "http://e/", None), (2, "http://f/", "y" * 70_000), (7, "http://g/", "y" * 70_000), (None, "http://h/", "z" * 200), (6, "http://i/", "")]
    path = f"{checkpoint_folder(spark)}/warc-{uuid.uuid4().hex}"
    archives.write_archives(spark.createDataFrame(rows, "page_id bigint, url string, html string"), path)
    records = archives.read_records(spark, path)
    assert Counter(r.type for r in records.collect()) == {"request": 10, "metadata": 10, "response": 7, "revisit": 3}
    nested = archives.captures(records)
    assert all(len(r.requests) == 1 and len(r.metadata) == 1 for r in nested.collect())
    got = {r.page_id: tuple(r)[1:] for r in archives.page_rows(nested).collect()}
    of = lambda t: (len((t or "").encode()), hashlib.sha256((t or "").encode()).hexdigest())
    refers = {5: 3, 4: 3, 7: 2}
    assert got == {k: (*of(t), "revisit" if k in refers else "response", refers.get(k)) for k, _, t in rows}
    kept = {bytes(r.payload).decode() for r in archives.read_records(spark, path, payloads=True).where("type = 'response'").collect()}
    assert kept == {page, "short", "", "y" * 70_000, "z" * 200}


def page_facts(rows):
    """(page_id, bytes, digest, kind, refers_to) of (page_id, url, html) rows, by brute force."""
    least: dict = {}
    for key, _, html in rows:
        if key is not None:
            least[html or ""] = min(key, least.get(html or "", key))
    out = []
    for key, _, html in rows:
        body = (html or "").encode()
        first = least.get(html or "")
        again = len(body) >= 100 and first is not None and first != key
        out.append((key, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first if again else None))
    return out


def test_archives_of_repeated_and_missing_page_ids(spark, tmp_path):
    big, other = "a" * 150, "b" * 400
    rows = [(1, "u", big), (1, "v", other), (2, "w", big), (3, "x", other), (3, "x", other), (1, "u", big)]
    rows += [(None, f"n{k}", "c" * 120 if k % 3 else f"{k} " * 60) for k in range(200)] + [(7, "s", "c" * 120), (8, "t", "c" * 120)]
    pages = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id bigint, url string, html string, digest string, place int")
    pages.repartition(5).write.parquet(f"{tmp_path}/pages.parquet")
    got = Counter(tuple(r) for r in queries.op5_warc_captures(spark, str(tmp_path)).collect())
    assert got == Counter(page_facts(rows))
    path = f"{checkpoint_folder(spark)}/warc-{uuid.uuid4().hex}"
    archives.write_archives(spark.read.parquet(f"{tmp_path}/pages.parquet"), path)
    nested = archives.captures(archives.read_records(spark, path)).collect()
    assert len({r.record_id for r in nested}) == len(rows)
    assert all(len(r.requests) == 1 and len(r.metadata) == 1 for r in nested)


def test_archives_of_no_pages(spark, tmp_path):
    spark.createDataFrame([], "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert queries.op5_warc_captures(spark, str(tmp_path)).collect() == []


def test_languages(spark, nothing):
    rows = [(k, words_of(k, 60), "xx") for k in range(40)] + [(100 + k, words_of(k, 60).translate(str.maketrans("abcdefghij", "klmnopqrst")), "yy") for k in range(40)]
    docs = spark.createDataFrame([*rows, (500, None, "xx"), (501, "q", None)], "doc_id bigint, text string, lang string")
    model = language.fitted(docs)
    assert model.languages == ["xx", "yy"]
    known = {k: name for k, _, name in rows}
    assert all(r.lang == known[r.doc_id] for r in language.document_languages(docs, model).collect() if r.doc_id in known)
    html = lambda text, tag: f'<html lang="{tag}"><script>abc abc</script><body>{text}</body></html>'
    pages = [(k, f"http://{'a' if name == 'xx' else 'b'}.example.{name}/p", html(text, name)) for k, text, name in rows]
    pages += [(900, "http://b.example.yy/q", "<html></html>"), (901, None, None), (902, "no address", html("", "yy")), (902, "no address", html("", "yy"))]
    got = language.page_languages(spark.createDataFrame(pages, "page_id bigint, url string, html string"), model).collect()
    assert len(got) == len(pages) and all(0 < r.probability <= 1 for r in got)
    found = {r.page_id: r.lang for r in got}
    assert {k: found[k] for k in known} == known and found[900] == "yy" and found[902] == "yy"
    assert language.page_languages(spark.createDataFrame([], "page_id bigint, url string, html string"), model).count() == 0


def test_pipeline_stages_take_effect(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    rows = [(k, f"{words_of(50 + k, 80).capitalize()}.") for k in range(200)]
    junk = [(1000 + k, " | ".join(words_of(400 + k, 60).split()) + "$$$") for k in range(60)]
    item = words_of(900, 25)
    special = [(2000, rows[0][1]), (2001, f"{words_of(901, 50).capitalize()} {item}."), (2002, f"{words_of(902, 60)} {rows[5][1]}"), (2003, rows[7][1]), (2003, rows[7][1])]
    every = rows + junk + special
    docs = {"doc_id": [k for k, _ in every], "text": [t for _, t in every], "lang": ["en"] * len(every), "source": ["s"] * len(every), "n_chars": [len(t) for _, t in every]}
    pq.write_table(pa.table(docs), tmp_path / "documents.parquet")
    labelled = [(k, 1) for k, _ in rows] + [(k, 0) for k, _ in junk]
    pq.write_table(pa.table({"doc_id": [k for k, _ in labelled], "quality": [q for _, q in labelled], "toxic": [0] * len(labelled)}), tmp_path / "labels.parquet")
    pq.write_table(pa.table({"item_id": [1], "text": [item]}), tmp_path / "benchmark.parquet")
    frame, columns = spark.read.parquet(str(tmp_path / "documents.parquet")), list(corpus_pipeline.COLUMNS)
    kept = corpus_pipeline.quality(spark, frame, str(tmp_path))
    assert kept.columns == columns and not {k for k, _ in junk} & {r.doc_id for r in kept.collect()}
    single = corpus_pipeline.near_dedup(spark, kept, str(tmp_path))
    ids = [r.doc_id for r in single.collect()]
    assert single.columns == columns and sorted(ids) == sorted({k for k, _ in rows} | {2001, 2002})
    cut = table_of(corpus_pipeline.repeats(spark, single, str(tmp_path)))
    assert len(cut[2002].text) < len(special[2][1]) - 200 and cut[2002].n_chars == len(cut[2002].text) and cut[5].text == rows[5][1]
    final = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(r.doc_id for r in final.collect()) == sorted({k for k, _ in rows} | {2002})


def test_pipeline_stages_judge_rows_without_an_id_of_their_own(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    item, long = words_of(900, 25), [words_of(910 + k, 90) for k in range(9)]
    pq.write_table(pa.table({"item_id": [1], "text": [item]}), tmp_path / "benchmark.parquet")
    near = lambda text: text.replace(text.split()[50], "changed", 1)
    rows = [
        (1, long[0]), (1, long[1]), (1, long[1]), (2, near(long[1])), (3, long[2]), (None, near(long[2])),
        (None, long[3]), (None, near(long[3])), (None, long[4]), (4, None), (4, ""), (None, None),
    ]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    frame = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in rows], schema)
    got = Counter((r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, frame, str(tmp_path)).collect())
    third = [t for k, t in got if k is None and t in (long[3], near(long[3]))]
    assert len(third) == 1
    assert got == Counter([(1, long[0]), (1, long[1]), (3, long[2]), (None, third[0]), (None, long[4]), (4, None), (4, ""), (None, None)])

    leaked = [(7, f"{long[5]} {item}"), (7, long[5]), (None, f"{item} {long[6]}"), (None, long[7]), (None, None), (8, long[8])]
    frame = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in leaked], schema)
    got = Counter((r.doc_id, r.text) for r in corpus_pipeline.decontaminate(spark, frame, str(tmp_path)).collect())
    assert got == Counter([(7, long[5]), (None, long[7]), (None, None), (8, long[8])])


def test_registered_queries():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5


def test_sets_are_made_in_a_task_without_another_python_step(spark):
    from pyspark.sql import functions as F

    from leafmill.llm import minmax

    docs = spark.createDataFrame([(i, " ".join(f"w{(i // 2 + j) % 40}" for j in range(30))) for i in range(20)], "doc_id bigint, text string")
    sketch = docs.select("doc_id", (F.col("doc_id") + 100).alias("node"))
    pairs = spark.createDataFrame([(100, 101), (102, 103)], "a bigint, b bigint")
    plan = minmax.with_sets(pairs, docs, sketch, "doc_id", "text", 5)._jdf.queryExecution().executedPlan().toString()
    # By the first column that goes in: of packed texts, not of texts to be packed.
    assert set(re.findall(r"MapInArrow \w+\((\w+)#", plan)) == {"node"}
