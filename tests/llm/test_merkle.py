"""Roots, proofs and folds against a plain level-by-level tree."""

from __future__ import annotations

import random
import zlib
from hashlib import sha256

import pytest

from requestmill.llm import merkle
from requestmill.llm.queries import op12_merkle_manifest


def h(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def tree(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """(root, witness of each node as (side, sibling) from below; a lone node's is ('.', ''))."""
    paths = [[] for _ in nodes]
    under = [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        up, up_under = [], []
        for k in range(0, len(nodes), 2):
            run = nodes[k : k + 2]
            for leaf in under[k]:
                paths[leaf].append((">", run[1]) if len(run) == 2 else (".", ""))
            for leaf in under[k + 1] if len(run) == 2 else []:
                paths[leaf].append(("<", run[0]))
            up.append(h(*run))
            up_under.append([x for u in under[k : k + 2] for x in u])
        nodes, under = up, up_under
    return nodes[0], paths


def fold(node: str, path) -> str:
    for side, other in path:
        node = h(other, node) if side == "<" else h(node, other)
    return node


def leaf(row, more: int = 0) -> str:
    n_chars = None if row[3] is None else row[3] + more
    fields = [row[0], row[1], row[2], n_chars, row[4]]
    return h(*("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def expected(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    parts = []
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        parts.append((own, *tree([leaf(r) for r in own])))
    root, tops = tree([p[1] for p in parts])
    for (own, subroot, paths), top in zip(parts, tops, strict=True):
        for row, path in zip(own, paths, strict=True):
            bad = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            whole = path + top
            folded = fold(leaf(row, int(bad)), whole)
            yield (row[0], leaf(row), subroot, root, h(*(s for _, s in whole)), folded, folded == root)


def found(df):
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


@pytest.mark.parametrize("bits", [1, 2, 3, 5])
def test_appender(bits):
    """Blocks of every size, as a whole tree and as the last part of a larger one."""
    block = merkle.Appender(bits)
    for n in range(1, (1 << bits) + 1):
        nodes = [sha256(b"%d" % k).digest() for k in range(n)]
        for node in nodes:
            block.append(node)
        root, levels = block.close(True)
        wanted, paths = tree([x.hex() for x in nodes])
        assert root.hex() == wanted
        for k in range(n):
            siblings, sides = block.witness(k, levels)
            assert sides.decode() == "".join(s for s, _ in paths[k])
            assert siblings.hex() == "".join(x for _, x in paths[k])
            assert merkle.folded(nodes[k], siblings, sides.decode()) == root
        block.clear()
        for node in nodes:
            block.append(node)
        padded, levels = block.close(False)
        assert levels == bits
        for k in range(n):
            siblings, sides = block.witness(k, levels)
            assert len(sides) == bits and merkle.folded(nodes[k], siblings, sides.decode()) == padded
        block.clear()


def test_odd_documents(spark, odd_docs):
    docs = odd_docs.selectExpr("*", "CASE WHEN doc_id % 2 = 0 THEN length(text) END AS n_chars", "1 AS tree", "2 AS size", "3 AS node", "4 AS top")
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    for bits in (1, 2, 12):
        assert found(merkle.checked(merkle.manifest(docs, bits))) == sorted(expected(rows), key=repr)


def test_many_rounds_and_a_hot_tree(spark):
    """Six rounds of blocks of two, a tree with two thirds of the rows, repeated rows, many small trees."""
    rng = random.Random(7)
    rows = [(k, "s", "en", k % 50, f"text {k}") for k in range(60)]
    rows += [(7, "s", "en", 7, "text 7")] * 20 + [(None, None, None, None, None)] * 9
    rows += [(k, "é", f"l{k}", 2**63 - 1 if k == 13 else 1, "ü" * (k % 4)) for k in range(300, 317)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    want = sorted(expected(rows), key=repr)
    for bits in (1, 3):
        assert found(merkle.checked(merkle.manifest(docs.repartition(5), bits))) == want


def test_no_and_one_document(spark, odd_docs):
    docs = odd_docs.selectExpr("*", "1L AS n_chars")
    assert found(merkle.checked(merkle.manifest(docs.where("false")))) == []
    one = docs.where("doc_id = 4")
    (row,) = merkle.manifest(one).collect()
    assert row["siblings"] == b"" and row["sides"] == "" and row["leaf"] == row["subroot"] == row["root"]


def test_tampering_is_found(spark):
    """Every altered leaf fails, every other one holds."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    result = found(op12_merkle_manifest(spark, sf))
    assert result == sorted(expected(rows), key=repr)
    assert {r[6] for r in result} == {True, False}
    assert all(r[6] == (zlib.crc32(str(r[0]).encode()) % 7 != 0) for r in result)


def test_places(spark):
    rows = spark.range(1_000).selectExpr("CASE WHEN id % 10 = 0 THEN NULL ELSE id % 2 END AS tree", "7 AS k", "id")
    placed = merkle.ranked(rows.repartition(7), "tree", ["k", "id"], "test-places").collect()
    for name in (None, 0, 1):
        own = sorted((r for r in placed if r["tree"] == name), key=lambda r: r["id"])
        assert [r["at"] for r in own] == list(range(len(own))) and {r["size"] for r in own} == {len(own)}
