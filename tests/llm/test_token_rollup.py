from __future__ import annotations

import os
import re
import shutil

import pytest

from requestmill.llm import queries, token_rollup
from requestmill.llm.token_rollup import TokenRollup, counted, deletes, inserts, revisions, tokens

from .conftest import SF


def rows(spark, data):
    frame = spark.createDataFrame(data, "source string, lang string, n long, c long")
    return counted(frame, "words-1", "n", "c")


def state(rollup):
    return {tuple(r)[:3]: tuple(r)[3:] for r in rollup.totals().collect()}


def test_inserts_revisions_deletes(spark, folder):
    rollup = TokenRollup(spark, f"{folder}/r")
    assert rollup.totals().count() == 0 and rollup.batches() == []
    old = rows(spark, [("a", "en", 10, 50), ("a", "en", 5, 20), ("b", None, 7, 30)])
    assert rollup.commit("1", inserts(old))
    assert state(rollup)["a", "en", "words-1"] == (2, 15, 70)
    assert state(rollup)["b", None, "words-1"] == (1, 7, 30)
    moved = revisions(
        rows(spark, [("a", "en", 5, 20)]), rows(spark, [("b", None, 6, 25)])
    )
    assert rollup.commit("2", moved)
    assert state(rollup) == {
        ("a", "en", "words-1"): (1, 10, 50),
        ("b", None, "words-1"): (2, 13, 55),
    }
    assert not rollup.commit("2", moved) and not rollup.commit("1", inserts(old))
    assert rollup.commit("3", deletes(rows(spark, [("a", "en", 10, 50)])))
    assert state(rollup) == {("b", None, "words-1"): (2, 13, 55)}
    assert rollup.commit("4", deletes(old.where("false")))
    assert rollup.batches() == ["1", "2", "3", "4"]


def test_a_failed_attempt_does_not_count(spark, folder):
    rollup = TokenRollup(spark, f"{folder}/r")
    data = rows(spark, [("a", "en", 10, 50)])
    rollup.commit("1", inserts(data))
    os.remove(f"{folder}/r/batch=1/_SUCCESS")  # as if the writer had died before it ended
    assert rollup.totals().count() == 0
    assert rollup.commit("1", inserts(data))
    assert state(rollup) == {("a", "en", "words-1"): (1, 10, 50)}


def test_other_rows_under_a_known_name_are_refused(spark, folder):
    rollup = TokenRollup(spark, f"{folder}/r")
    first = rows(spark, [("a", "en", 10, 50), (None, None, 1, 2)])
    rollup.commit("1", inserts(first))
    assert not rollup.commit("1", inserts(first.repartition(3)))
    for other in ([("a", "en", 10, 51), (None, None, 1, 2)], [("a", "en", 10, 50)], [("a", None, 10, 50), (None, "en", 1, 2)]):
        with pytest.raises(ValueError, match="other counts"):
            rollup.commit("1", inserts(rows(spark, other)))
    rollup.fold()
    assert not rollup.commit("1", inserts(first))
    with pytest.raises(ValueError, match="other counts"):
        rollup.commit("1", deletes(first))
    assert state(rollup)["a", "en", "words-1"] == (1, 10, 50)


def test_folds(spark, folder):
    rollup = TokenRollup(spark, f"{folder}/r")
    assert rollup.fold() == 0
    for n in range(7):
        rollup.commit(str(n), inserts(rows(spark, [("a", "en", n, 2 * n), (None, None, 1, 1)])))
        if n in (2, 5):
            assert rollup.fold() == 3 and rollup.batches() == []
    want = {("a", "en", "words-1"): (7, 21, 42), (None, None, "words-1"): (7, 7, 7)}
    assert state(rollup) == want and rollup.batches() == ["6"]
    assert all(rollup.committed(str(n)) for n in range(7)) and not rollup.committed("7")
    assert sum(n.startswith("fold=") for n in os.listdir(f"{folder}/r")) == 1


def test_a_fold_that_is_broken_off(spark, folder, tmp_path):
    rollup = TokenRollup(spark, f"{folder}/r")
    for n in range(3):
        rollup.commit(str(n), inserts(rows(spark, [("a", "en", 1, 1)])))
    shutil.copytree(f"{folder}/r", f"{folder}/before")
    rollup.fold()
    want = {("a", "en", "words-1"): (3, 3, 3)}
    # it ended before it deleted anything
    shutil.copytree(f"{folder}/before", f"{folder}/r", dirs_exist_ok=True)
    assert state(rollup) == want and rollup.batches() == [] and rollup.fold() == 0
    # it ended before its names were written
    fold = next(n for n in os.listdir(f"{folder}/r") if n.startswith("fold="))
    os.remove(f"{folder}/r/{fold}/names/_SUCCESS")
    assert state(rollup) == want and rollup.fold() == 3 and state(rollup) == want


def test_long_texts_and_clashing_columns(spark, folder, odd_docs, odd_rows, no_docs):
    docs = odd_docs.selectExpr("*", "1 AS tokenizer", "2 AS n_docs", "3 AS n_tokens", "4 AS n_chars")
    docs = docs.selectExpr("* EXCEPT (n_words)").withColumns(
        {"n_words": tokens(docs.text, "words-1"), "length": token_rollup.chars(docs.text)}
    )
    rollup = TokenRollup(spark, f"{folder}/r")
    rollup.commit("1", inserts(counted(docs, "words-1", "n_words", "length")))
    got = state(rollup)
    for source, lang in {(r[3], r[2]) for r in odd_rows}:
        own = [r[1] or "" for r in odd_rows if (r[3], r[2]) == (source, lang)]
        n_words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in own)
        assert got[source, lang, "words-1"] == (len(own), n_words, sum(map(len, own)))
    assert rollup.commit("2", inserts(counted(docs.where("false"), "words-1", "n_words", "length")))
    assert state(rollup) == got


def test_names(spark, folder):
    for name in ("", "a/b"):
        with pytest.raises(ValueError, match="name"):
            TokenRollup(spark, folder).commit(name, spark.range(0))


def test_tokens(spark):
    frame = spark.createDataFrame([(None,), ("",), (" \n",), ("a1 É!b",)], "t string")
    got = frame.select(tokens(frame.t, "words-1"), tokens(frame.t, "pieces-1")).collect()
    assert [tuple(r) for r in got] == [(0, 0), (0, 0), (0, 0), (2, 5)]
    assert set(token_rollup.TOKENIZERS) == {"words-1", "pieces-1"}


def test_one_group_is_summed_below_the_exchange(spark, folder, documents):
    data = counted(
        documents.selectExpr("source", "lang", "n_chars AS n", "n_chars AS c"), "words-1", "n", "c"
    )
    rollup = TokenRollup(spark, f"{folder}/r")
    rollup.commit("1", inserts(data))
    plan = rollup.totals()._jdf.queryExecution().toString()
    assert "partial_sum" in plan and "Python" not in plan
    assert sum(v[0] for v in state(rollup).values()) == documents.count()


def test_query(spark):
    got = queries.QUERIES["op1_token_count_rollup"](spark, SF).collect()
    words = [r for r in got if r["tokenizer"] == "words-1"]
    pieces = [r for r in got if r["tokenizer"] == "pieces-1"]
    assert sum(r["n_docs"] for r in words) == sum(r["n_docs"] for r in pieces)
    assert sum(r["n_tokens"] for r in pieces) > sum(r["n_tokens"] for r in words) > 0
