"""Fingerprints, scores and language posteriors, computed again in plain Python."""

from __future__ import annotations

import math
import random
import re
from bisect import bisect_left
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from leafmill.llm import language, phrases, quality
from leafmill.llm.common import BASE, letters

ONES = (1 << 64) - 1


def mixed(value: int) -> int:
    value = (value ^ value >> 30) * 0xBF58476D1CE4E5B9 & ONES
    value = (value ^ value >> 27) * 0x94D049BB133111EB & ONES
    return value ^ value >> 31


def phrase_set(raw: bytes, full: int) -> list[bytes]:
    """Each phrase is the shortest string that the dictionary lacks; a full dictionary starts anew."""
    known, out, begin = set(), [], 0
    for end in range(1, len(raw) + 1):
        phrase = raw[begin:end]
        if phrase not in known:
            known.add(phrase)
            out.append(phrase)
            begin = end
            if len(known) + 1 >= full:
                known = set()
    return out


def plain_print(text: str | None) -> list[int]:
    codes = [int(c) for c in letters()]
    bins: dict[int, int] = {}
    for phrase in phrase_set((text or "").encode(), phrases.FULL):
        value = sum(codes[b] * pow(BASE, i, 1 << 64) for i, b in enumerate(phrase)) + len(phrase) * 0xD6E8FEB86659FD93
        hashed = mixed(value & ONES)
        bins[hashed >> 57] = min(hashed, bins.get(hashed >> 57, ONES))
    return [mixed(bins[k]) % phrases.EMPTY if k in bins else phrases.EMPTY for k in range(phrases.BINS)]


def plain_likeness(a: list[int], b: list[int]) -> float:
    used = [(x, y) for x, y in zip(a, b) if x != phrases.EMPTY or y != phrases.EMPTY]
    return sum(x == y for x, y in used) / len(used) if used else 1.0


def test_fingerprints_by_an_independent_parse(spark):
    rng = random.Random(1)
    texts = ["", None, "a", "aaaaaaaaaaaa", "abababababab" * 30, "é ü " * 50]
    texts += ["".join(rng.choice("ab c") for _ in range(rng.randint(1, 900))) for _ in range(12)]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in phrases.neighbour_fingerprints(docs).collect()}
    shown = lambda print_of: "".join(f"{v:04x}" for v in print_of)
    for key, text in rows:
        following = texts[(key + 1) % len(texts)] or ""
        moved = len(text or "") // 4
        edited = (text or "")[: len(text or "") - moved] + following[:moved]
        own, other = plain_print(text), plain_print(edited)
        assert got[key].fingerprint == shown(own) and got[key].edited_fingerprint == shown(other)
        assert got[key].near_edited == pytest.approx(plain_likeness(own, other))
        assert got[key].near_next == pytest.approx(plain_likeness(own, plain_print(following)))


def test_scores_are_sums_of_table_entries(spark):
    rng = random.Random(2)
    good = [(k, " ".join(rng.choice(["river", "Stone", "bread,", "light."]) for _ in range(rng.randint(20, 80))), 1) for k in range(60)]
    bad = [(100 + k, "!!! BUY " * rng.randint(1, 30), 0) for k in range(60)]
    rows = [*good, *bad, (500, None, None), (501, "", None), (501, "", None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, quality int").withColumnRenamed("quality", "label")
    labels = spark.createDataFrame([(k, q) for k, _, q in rows if q is not None], "doc_id bigint, quality int")
    model = quality.fitted(frame, labels)

    def plain(text):
        values = [float(v) for v in quality.features(text)]
        margin = float(model.base)
        for value, edges, table in zip(values, model.edges, model.tables):
            margin += table[bisect_left(list(edges), value)]
        coarse = [bisect_left(list(edges), value) for value, edges in zip(values, model.coarse)]
        for (i, j), table in zip(model.pairs, model.pair_tables):
            margin += table[coarse[i] * (len(model.coarse[j]) + 1) + coarse[j]]
        return 1 / (1 + math.exp(-margin))

    got = quality.scored(frame, model).collect()
    assert len(got) == len(rows)
    for row in got:
        assert row.score == pytest.approx(plain(row.text), abs=1e-12)


def test_language_posteriors(spark):
    rng = random.Random(3)
    alphabets = {"xx": "abcdef", "yy": "ghijkl", "zz": "abgjmn"}
    said = lambda name, n: " ".join("".join(rng.choice(alphabets[name]) for _ in range(rng.randint(2, 6))) for _ in range(n))
    docs = spark.createDataFrame([(k, said(n, 40), n) for k, n in enumerate(list(alphabets) * 20)], "doc_id bigint, text string, lang string")
    model = language.fitted(docs)
    names = model.languages
    pages = []
    for k in range(60):
        name, host = rng.choice(names), rng.choice(["a.one.xx", "b.one.xx", "www.two.yy", "lone", None])
        body = rng.choice([said(name, 6), said(name, 1), "", "12"])
        tag = rng.choice(["", ' lang="xx"', ' class="q" lang=YY'])
        pages.append((k % 50, None if host is None else f"https://u@{host}:80/p?q", rng.choice([None, f"<html{tag}><body>{body}</body></html>"]) if k % 7 == 0 else f"<html{tag}><body>{body}</body></html>"))
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string")

    evidence = []
    for key, url, html in pages:
        text = re.sub(r"<[^>]*>", " ", html or "")
        logs = [float(v) for v in model.likelihoods(pa.array([text], pa.string()))[0]]
        declared = re.search(r"<html\b[^>]*?\slang\s*=\s*[\"']?([A-Za-z]{2,3})\b", html or "")
        host = re.match(r"[a-z]+://(?:[^/?#@]*@)?([^/:?#]+)", url or "")
        host = host.group(1) if host else None
        parts = host.split(".") if host else []
        vote = names[logs.index(max(logs))] if max(logs) > min(logs) else None
        evidence.append({
            "key": key, "logs": logs, "vote": vote, "host": host, "domain": ".".join(parts[-2:]) if host else None,
            "suffix": parts[-1] if host else None, "declared": declared.group(1).lower() if declared else None,
        })
    tallies = {k: defaultdict(Counter) for k in ("declared", "suffix", "domain", "host")}
    everyone = Counter(e["vote"] for e in evidence if e["vote"])
    for e in evidence:
        for k, tally in tallies.items():
            if e[k] is not None and e["vote"]:
                tally[e[k]][e["vote"]] += 1

    def others(counts, e):
        return [max(counts[n] - (n == e["vote"]), 0) for n in names]

    want = []
    for e in evidence:
        world = others(everyone, e)
        base = [(c + 1) / (sum(world) + len(names)) for c in world]

        def smoothed(kind, parent):
            left = others(tallies[kind][e[kind]] if e[kind] is not None else Counter(), e)
            return [(c + language.SMOOTHING * p) / (sum(left) + language.SMOOTHING) for c, p in zip(left, parent)]

        host = smoothed("host", smoothed("domain", smoothed("suffix", base)))
        declared = smoothed("declared", base)
        fused = [l + math.log(h) + math.log(d) - math.log(b) for l, h, d, b in zip(e["logs"], host, declared, base)]
        probability = 1 / sum(math.exp(x - max(fused)) for x in fused)
        want.append((e["key"], names[fused.index(max(fused))], round(probability, 9), e["vote"], e["declared"], e["host"]))
    got = language.page_languages(frame, model).collect()
    found = [(r.page_id, r.lang, round(r.probability, 9), r.text_lang, r.declared, r.host) for r in got]
    assert sorted(found, key=repr) == sorted(want, key=repr)
