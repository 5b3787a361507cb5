from __future__ import annotations

import re
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from requestmill.llm import decontaminate
from requestmill.llm.common import written
from requestmill.llm.decontaminate import Limits

from .conftest import SF, by_id

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))


def slow(texts, items, size=10):
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(size, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[k : k + n])].add(str(item))
    out = {}
    for doc_id, text in texts.items():
        w, hit, found = words(text), set(), set()
        for n in {len(g) for g in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        out[doc_id] = (len(w), len(hit), sorted(found), bool(hit))
    return out


@pytest.mark.parametrize("limits", [Limits(), Limits(0, 6)])
def test_same_as_brute_force(spark, documents, texts, limits):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [(r["item_id"], r["text"]) for r in benchmark.collect()]
    got = by_id(decontaminate.contamination(documents, benchmark, limits=limits))
    want = slow(texts, items)
    assert {i: tuple(r)[1:] for i, r in got.items()} == want
    assert any(w[3] for w in want.values())


@pytest.mark.parametrize("limits", [Limits(), Limits(0, 6)])
def test_short_repeated_and_empty_items(spark, odd_docs, odd_rows, no_docs, limits):
    items = [(1, "ONE"), (2, None), (3, "?!"), (4, "b C d"), (5, "b c d"), (6, "two words more")]
    items += [(7, "a b c d e f g h i j k")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.contamination(odd_docs, benchmark, limits=limits).collect()
    assert len(rows) == len(odd_rows)
    want = slow({(i, t): t for i, t, *_ in odd_rows}, items)
    got = sorted(tuple(r)[1:] for r in rows)
    assert got == sorted(want[i, t] for i, t, *_ in odd_rows)
    assert decontaminate.contamination(no_docs, benchmark).count() == 0
    nothing = decontaminate.contamination(odd_docs, benchmark.where("false"))
    assert nothing.where("contaminated").count() == 0 and nothing.count() == len(odd_rows)


def test_documents_and_spans_go(spark, odd_docs, odd_rows):
    benchmark = spark.createDataFrame([(4, "b C d"), (1, "one")], "item_id long, text string")
    clean = decontaminate.clean_documents(odd_docs, benchmark)
    assert clean.columns == odd_docs.columns
    want = sorted(str(t) for _, t, *_ in odd_rows if t != "one" and not str(t).startswith("a b"))
    assert sorted(str(r["text"]) for r in clean.collect()) == want
    cut = decontaminate.without_spans(odd_docs, benchmark)
    assert cut.columns == odd_docs.columns and cut.count() == len(odd_rows)
    texts = [r["text"] for r in cut.collect()]
    assert texts.count("a e f g h i j k l") == 2 and "one" not in texts
    assert "Two words" in texts and None in texts


def _disk(folder):
    return sum(f.stat().st_size for f in Path(folder).rglob("*.parquet"))


@pytest.mark.parametrize("many", [False, True])
def test_one_plan_for_few_and_many_windows(spark, monkeypatch, documents, texts, many):
    """Half a million windows that share their word pairs with the documents change neither results nor plan."""
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text")
    want = slow(texts, [(r["item_id"], r["text"]) for r in benchmark.collect()])
    if many:
        vocabulary = sorted({w for t in texts.values() for w in words(t)})[:200]
        pick = F.transform(
            F.sequence(F.lit(1), F.lit(500)),
            lambda k: F.get(F.lit(vocabulary), F.pmod(F.xxhash64(F.col("id"), k), F.lit(200)).cast("int")),
        )
        extra = spark.range(1_000).select((F.col("id") + 10_000).alias("item_id"), F.array_join(pick, " ").alias("text"))
        benchmark = benchmark.union(extra)
    folders = []
    monkeypatch.setattr(
        decontaminate, "written", lambda df, purpose: folders.append(written(df, purpose)) or folders[-1]
    )
    got = by_id(decontaminate.contamination(documents, benchmark))
    assert {i: tuple(r)[1:] for i, r in got.items()} == want
    scanned = folders[1].inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert _disk(scanned) < Path(f"{SF}/documents.parquet").stat().st_size
