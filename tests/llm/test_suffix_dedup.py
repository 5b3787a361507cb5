from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from requestmill.llm import suffix_dedup
from requestmill.llm.suffix_dedup import LENGTH


def slow_spans(texts):
    """Covered ranges of each text, from a table of all strings."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[k : k + LENGTH] for d in data for k in range(len(d) - LENGTH + 1))
    out = []
    for d in data:
        spans = []
        for k in range(len(d) - LENGTH + 1):
            if seen[d[k : k + LENGTH]] > 1:
                if spans and k <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], k + LENGTH)
                else:
                    spans.append((k, k + LENGTH))
        out.append(spans)
    return data, out


def check(spark, texts):
    data, want = slow_spans(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in suffix_dedup.without_repeats(docs).collect()}
    assert sorted(got) == list(range(len(texts)))
    for i, (d, spans) in enumerate(zip(data, want, strict=True)):
        assert [(s["start"], s["end"]) for s in got[i]["spans"]] == spans, i
        kept = bytearray()
        done = 0
        for a, b in spans:
            kept += d[done:a]
            done = b
        assert got[i]["kept"] == bytes(kept + d[done:]) and got[i]["n_bytes"] == len(d)
    return want


def made_texts():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdé ") for _ in range(rng.randint(2, 9)))
    long = " ".join(word() for _ in range(300))
    texts = [" ".join(word() for _ in range(rng.randint(1, 120))) for _ in range(40)]
    for n in (198, 199, 200, 201, 260, 420):  # passages around the limit, in many documents
        passage = long[n : n + n]
        for k in range(0, 40, 3):
            at = rng.randint(0, len(texts[k]))
            texts[k] = texts[k][:at] + passage + texts[k][at:]
    texts += [texts[0], long, long[:500], long + "!" + long, "ab" * 400, "z" * 700]
    texts += [None, "", "short", "short", long[:LENGTH], long[1 : LENGTH + 1], long[5:204]]
    return texts


@pytest.mark.parametrize("limit", [1_000, 2])
def test_same_as_brute_force(spark, monkeypatch, limit):
    """With a small limit, groups are halved down to single strings."""
    monkeypatch.setattr(suffix_dedup, "GROUP_LIMIT", limit)
    want = check(spark, made_texts())
    assert sum(map(len, want)) > 30


def test_given_documents(spark, documents, texts):
    rows = {r["doc_id"]: r for r in suffix_dedup.without_repeats(documents).collect()}
    ids = sorted(texts)
    _, want = slow_spans([texts[i] for i in ids])
    assert [[tuple(s) for s in rows[i]["spans"]] for i in ids] == want


def test_odd_rows(odd_docs, odd_rows, no_docs):
    rows = suffix_dedup.without_repeats(odd_docs).collect()
    assert len(rows) == len(odd_rows)
    by_size = {r["n_bytes"]: r for r in rows}
    assert [tuple(s) for s in by_size[5_000]["spans"]] == [(0, 5_000)]
    assert not by_size[0]["spans"]
    assert suffix_dedup.without_repeats(no_docs).count() == 0


def test_rows_given_twice_repeat_each_other(spark):
    text = "".join(chr(97 + k * k % 23) for k in range(300))
    docs = spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string")
    assert [r["kept"] for r in suffix_dedup.without_repeats(docs).collect()] == [b"", b""]


def test_every_string_has_an_anchor_that_depends_on_it_alone(monkeypatch):
    rng = random.Random(5)
    data = bytes(rng.choice(b"abcd") for _ in range(3_000))
    places = suffix_dedup.anchors(data)
    reach = suffix_dedup.REACH
    for k in range(len(data) - LENGTH + 1):
        assert any(k <= p <= k + reach for p in places)
        own = [k + p for p in suffix_dedup.anchors(data[k : k + LENGTH])]
        assert own and set(own) <= set(places)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 257)
    assert suffix_dedup.anchors(data) == places


@pytest.mark.parametrize("together", [1, 900, 1 << 17])
def test_texts_searched_together(monkeypatch, together):
    rng = random.Random(6)
    texts = [bytes(rng.choice(b"ab ") for _ in range(rng.randint(0, 700))) for _ in range(60)]
    want = [suffix_dedup.anchors(t) for t in texts]
    monkeypatch.setattr(suffix_dedup, "TOGETHER", together)
    assert suffix_dedup.anchors_of_each(texts) == want
    assert suffix_dedup.anchors_of_each([]) == []


def test_deep_shallow_sort():
    rng = random.Random(7)
    stem = "".join(rng.choice("ab") for _ in range(60))
    suffixes = [
        (stem[: rng.randint(20, 60)] + "".join(rng.choice("abc") for _ in range(rng.randint(20, 40))))
        .encode()
        for _ in range(400)
    ]
    suffixes += suffixes[:30] + [s[:-3] for s in suffixes[:30]]
    order, lcps = suffix_dedup.deep_shallow_sort(suffixes)
    assert sorted(order.tolist()) == list(range(len(suffixes)))
    ranked = [suffixes[k] for k in order]
    assert ranked == sorted(suffixes)
    for a, b, n in zip(ranked, ranked[1:], lcps[1:].tolist(), strict=False):
        m = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert m == n
    assert isinstance(order, np.ndarray)
