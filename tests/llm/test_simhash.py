from __future__ import annotations

import re

import pytest
import xxhash
from pyspark.sql import functions as F

from requestmill.llm import simhash
from requestmill.llm.graph import connected_components

from .conftest import by_id

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_fingerprint(text, width=3):
    lowered = re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")
    words = WORD.findall(lowered)
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    shingles = [" ".join(words[k : k + width]) for k in range(n)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def slow_components(prints, max_bits):
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= max_bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in prints}


def test_fingerprints_and_components(documents, texts):
    got = by_id(simhash.near_duplicates(documents))
    prints = {i: slow_fingerprint(t) for i, t in texts.items()}
    assert {i: r["fp"] % (1 << 64) for i, r in got.items()} == prints
    assert {i: r["component_id"] for i, r in got.items()} == slow_components(prints, 2)


def test_hash_is_sparks(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("a b c")).alias("h")).first()
    assert simhash.fingerprint(b"A b\tc") == row["h"] % (1 << 64)


@pytest.mark.parametrize("max_bits", [0, 1, 2, 3])
def test_links_of_any_distance(spark, max_bits):
    prints = [0, 1, 3, 7, 1 << 63, (1 << 63) | 6, 255 << 20, 0xFFFFFFFFFFFFFFFF]
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"), max_bits)
    roots = {r["node"] % (1 << 64): r["root"] for r in connected_components(edges).collect()}
    want = slow_components({p: p for p in prints}, max_bits)
    for a in prints:
        for b in prints:
            assert (a == b or (a in roots and roots[a] == roots.get(b))) == (want[a] == want[b])


def test_components_of_a_chain_and_a_hub(spark):
    edges = [(k, k + 1) for k in range(60)] + [(1000, 1001 + k) for k in range(300)] + [(5, 5)]
    got = connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {(r["node"], r["root"]) for r in got} == {(k, 0) for k in range(61)} | {
        (1000 + k, 1000) for k in range(301)
    }


def test_odd_rows(odd_docs, odd_rows, no_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    assert len(rows) == len(odd_rows)
    assert {r["component_id"] for r in rows if r["fp"] == 0} == {0}  # no word at all
    assert {r["component_id"] for r in rows if r["doc_id"] == 6} == {6}
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.one_of_each(no_docs).count() == 0


def one_of_each_slowly(rows):
    """The first row by (doc_id nulls last, text nulls last) of each component over rows."""
    prints = {k: slow_fingerprint(t) for k, (_, t) in enumerate(rows)}
    roots = slow_components(prints, 2)
    last = lambda v: (v is None, v if v is not None else 0)
    best = {}
    for k, (doc_id, text) in enumerate(rows):
        key = (last(doc_id), (text is None, text or ""))
        if roots[k] not in best or key < best[roots[k]][0]:
            best[roots[k]] = (key, (doc_id, text))
    return sorted((row for _, row in best.values()), key=repr)


def kept_rows(docs):
    found = simhash.one_of_each(docs)
    assert found.columns == docs.columns
    return sorted(((r["doc_id"], r["text"]) for r in found.collect()), key=repr)


def test_one_of_each(odd_docs, odd_rows, documents, texts):
    assert kept_rows(odd_docs) == one_of_each_slowly([(r[0], r[1]) for r in odd_rows])
    want = slow_components({i: slow_fingerprint(t) for i, t in texts.items()}, 2)
    got = {r["doc_id"] for r in simhash.one_of_each(documents).select("doc_id").collect()}
    assert got == set(want.values())


A, B = "the first of all texts here", "something else that has no copy at all"


@pytest.mark.parametrize(
    "rows",
    [
        [(2, A), (5, A), (5, B)],
        [(1, A), (1, B), (7, B), (8, A)],
        [(None, A), (None, A), (None, B), (3, B)],
        [(4, A.upper()), (4, A), (4, A), (9, A.title())],  # texts of one id and one component
        [(None, None), (None, ""), (6, "  "), (None, "x")],
        [(None, A.upper()), (None, A)],
    ],
)
def test_one_of_each_with_repeated_and_null_ids(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS root", "2 AS n")
    assert kept_rows(docs.repartition(2)) == one_of_each_slowly(rows)


def test_one_of_each_of_many_copies(spark):
    docs = spark.range(3_000).selectExpr(
        "IF(id % 3 = 0, NULL, id) AS doc_id",
        "CASE WHEN id % 3 < 2 THEN 'one text that many have' "
        "ELSE concat_ws(' ', sha(CAST(id AS STRING)), md5(CAST(id AS STRING)), id) END AS text",
    )
    assert simhash.one_of_each(docs).where("doc_id = 1").count() == 1
    assert simhash.one_of_each(docs).where("text LIKE 'one text%'").count() == 1
