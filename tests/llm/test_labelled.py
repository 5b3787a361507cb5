"""All documents with a label: against a plain choice, and without a shuffle of their texts."""

from __future__ import annotations

import random
from zlib import crc32

import pytest

from requestmill.llm.labelled import SLOTS, Split, labelled

SPLIT = Split(3, 1)


@pytest.mark.parametrize("most_slots", [1, 7, SLOTS])
@pytest.mark.parametrize("ids", ["dense", "any", "wide"])
def test_texts_get_the_labels_of_their_ids(spark, ids, most_slots):
    """Repeated ids and ids that share a slot, null ids, and labels that are null or without a document."""
    rng = random.Random(3)
    kinds = {"dense": range(600), "any": [rng.getrandbits(64) - 2**63 for _ in range(600)], "wide": range(-5, 6 * 10**11, 10**9)}
    chosen = list(kinds[ids])
    rows = [(i, f"text {rng.random()}") for i in chosen]
    rows += [(i, rng.choice([None, "a", "zz"])) for i in chosen[:60]] + [(None, "x")] * 3
    given = [(i, rng.choice([0, 1, 0, None])) for i in chosen[::2]] + [(i, rng.choice([0, 1])) for i in chosen[:50]]
    given += [(None, 1), (-77, 1)]
    y = {}
    for i, label in given:
        if i is not None and label is not None and crc32(str(i).encode()) % 3 != 1:
            y[i] = max(label, y.get(i, 0))
    want = {}
    for i, text in rows:
        if i in y:
            want[i] = min(want.get(i, (True, "", y[i])), (text is None, text or "", y[i]))
    found = labelled(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(3),
        spark.createDataFrame(given, "doc_id long, toxic int"),
        "toxic",
        SPLIT,
        most_slots,
    )
    got = [(r["doc_id"], (r["text"] is None, r["text"] or "", r["y"])) for r in found.rows.collect()]
    assert len(got) == len(want) and dict(got) == want
    assert found.positives == sum(v[2] for v in want.values())
    assert found.positives + found.negatives == len(want)


def test_texts_stay_where_they_are_read(spark, folder):
    """Also where no table of ids is small enough to be broadcast by Spark itself."""
    docs = f"{folder}/docs"
    spark.range(3_000).selectExpr("id AS doc_id", "repeat('word ', 20) AS text").write.parquet(docs)
    former = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        labels = spark.range(3_000).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS toxic")
        rows = labelled(spark.read.parquet(docs), labels, "toxic", SPLIT).rows
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert rows.count() > 1_900
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", former)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "hashpartitioning" not in plan
