from __future__ import annotations

import re
from collections import Counter

import pytest

from requestmill.llm import mil_quality, quality_divergence

from .conftest import SF, by_id

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    count, hit = Counter(windows), set()
    for k, w in enumerate(windows):
        if count[w] > 1:
            hit |= set(range(k, k + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n, r = len(words), len(hit)
    return (
        n,
        len("".join(words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        r,
        n < 10 or 100 * r > 20 * n,
    )


def base(row):
    names = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed"
    return tuple(row[n] for n in names.split())


def test_base_rules(documents, texts, odd_docs, odd_rows, no_docs):
    got = by_id(quality_divergence.judged(documents))
    assert {i: base(r) for i, r in got.items()} == {i: slow_base(t) for i, t in texts.items()}
    odd = quality_divergence.judged(odd_docs).collect()
    assert sorted(map(base, odd)) == sorted(slow_base(t) for _, t, *_ in odd_rows)
    assert not any(r["kept"] for r in odd if r["n_words"] < 10)
    assert quality_divergence.judged(no_docs).count() == 0


def test_far_documents_are_dropped(spark):
    plain = "The men of the town went to the river and it was on for a while, with that said. "
    rows = [(i, plain * (3 + i), "en") for i in range(30)]
    rows += [(100, "THE!! MEN!! OF!! THE!! TOWN!! WENT!! HOME!! AT!! NIGHT!! " * 5, "en")]
    rows += [(101, " | ".join(f"cell{i}" for i in range(150)), "en")]
    rows += [(102, " ".join(f"zug{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)), "en")]
    rows += [(103, plain * 4, None), (104, plain * 4, "xx")]
    limits = quality_divergence.Thresholds(repeat_percent=100)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = by_id(quality_divergence.judged(docs, limits))
    dropped = {i for i, r in got.items() if not r["kept"]}
    assert dropped == {100, 101, 102}
    assert got[103]["class_distance"] == 0
    assert 0 <= got[0]["word_distance"] < 0.1 < got[102]["word_distance"] <= 1


def test_plan_has_no_python(documents):
    plan = quality_divergence.measures(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.fixture(scope="module")
def labelled(spark):
    """Good documents have plain passages; bad ones have a passage of signs somewhere."""
    plain = "the men of the town went to the river and stayed there for the night because of rain "
    rows, labels = [], []
    for i in range(400):
        good = i % 4 != 0
        parts = [plain * (1 + (i + k) % 3) for k in range(4)]
        if not good:
            parts[i // 4 % 4] = "### $$$ %%% ||| *** " * 20
        rows.append((i, "\n".join(parts)))
        labels.append((i, int(good)))
    return (
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, quality int"),
    )


def test_attention_finds_the_bad_passage(labelled, odd_docs, odd_rows, no_docs):
    docs, labels = labelled
    model = mil_quality.fit(docs, labels)
    scored = {r["doc_id"]: r["score"] for r in mil_quality.scores(docs, model).collect()}
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    held = [r["doc_id"] for r in docs.where(mil_quality.SPLIT.column(docs.doc_id)).collect()]
    assert len(held) > 50
    assert all((scored[i] >= 0.7) == (truth[i] == 1) for i in held)
    odd = mil_quality.scores(odd_docs, model).collect()
    assert len(odd) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in odd)
    assert mil_quality.scores(no_docs, model).count() == 0


def test_held_out_labels_are_not_learned(labelled):
    docs, labels = labelled
    held = mil_quality.SPLIT.column(labels.doc_id)
    turned = labels.withColumn(
        "quality", (labels.quality * 0 + held.cast("int") * (1 - labels.quality))
        + (1 - held.cast("int")) * labels.quality
    )
    one, two = mil_quality.fit(docs, labels), mil_quality.fit(docs, turned)
    assert all((one.weights[k] == two.weights[k]).all() for k in one.weights)


def test_without_labels(labelled, spark):
    docs, labels = labelled
    model = mil_quality.fit(docs, labels.where("false"))
    assert {r["score"] for r in mil_quality.scores(docs, model).collect()} == {0.5}
    nulls = labels.selectExpr("doc_id", "cast(null as int) quality")
    assert mil_quality.fit(docs, nulls) == 0.5


def test_labels_without_documents(labelled, no_docs):
    """No documents, and labels of other documents only."""
    docs, labels = labelled
    assert mil_quality.fit(no_docs, labels) == 0.5
    others = labels.selectExpr("doc_id + 100000 AS doc_id", "quality")
    assert mil_quality.fit(docs, others) == 0.5
    some = labels.selectExpr("IF(quality = 0, doc_id + 100000, doc_id) AS doc_id", "quality")
    assert 0.9 < mil_quality.fit(docs, some) < 1
    assert mil_quality.scores(no_docs, 0.5).count() == 0


def test_forward_pass_by_plain_loops():
    """Encoder, gates, softmax and mean of every bag, number by number."""
    import math

    import numpy as np

    rng = np.random.default_rng(3)
    bags = [rng.normal(size=(n, mil_quality.N_FEATURES)) * 3 for n in (1, 4, 2, 7)]
    x, starts = np.concatenate(bags), np.array([0, 1, 5, 7])
    net = mil_quality.Network.fresh(x, hidden=4, gate=3)
    for w in net.weights.values():
        w += rng.normal(size=w.shape) / 3
    w = {k: v.tolist() for k, v in net.weights.items()}

    def times(v, m, b):
        return [sum(v[i] * m[i][j] for i in range(len(v))) + b[j] for j in range(len(m[0]))]

    for bag, got in zip(bags, net.scores(x, starts), strict=True):
        codes, weights = [], []
        for row in bag.tolist():
            v = [max(-8, min(8, (a - m) / s)) for a, m, s in zip(row, net.mean, net.scale)]
            h = [math.tanh(a) for a in times(v, w["E"], w["e"])]
            t = [math.tanh(a) for a in times(h, w["V"], w["v"])]
            s = [1 / (1 + math.exp(-a)) for a in times(h, w["U"], w["u"])]
            codes.append(h)
            weights.append(math.exp(sum(a * b * c[0] for a, b, c in zip(t, s, w["a"]))))
        z = [sum(a * h[k] for a, h in zip(weights, codes)) / sum(weights) for k in range(4)]
        logit = sum(a * o[0] for a, o in zip(z, w["o"])) + w["b"][0]
        assert abs(1 / (1 + math.exp(-logit)) - got) < 1e-12


def test_training_takes_a_bounded_number_of_passages():
    assert mil_quality._spaced(list(range(10)), 4) == [0, 3, 6, 9]
    assert mil_quality._spaced([1, 2], 4) == [1, 2]


def test_gradients_match_differences():
    import numpy as np

    rng = np.random.default_rng(1)
    x, starts = rng.normal(size=(9, mil_quality.N_FEATURES)), np.array([0, 1, 4])
    y = np.array([1.0, 0.0, 1.0])
    net = mil_quality.Network.fresh(x, hidden=5, gate=3)

    def loss():
        p = net.scores(x, starts)
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).sum()

    f = net.forward(x, starts)
    grads = net.gradients(f, starts, 1 / (1 + np.exp(-f["logit"])) - y)
    for name, g in grads.items():
        w = net.weights[name]
        at = tuple(0 for _ in w.shape)
        old, step = w[at], 1e-5
        w[at] = old + step
        up = loss()
        w[at] = old - step
        down = loss()
        w[at] = old
        assert abs((up - down) / (2 * step) - g[at]) < 1e-5, name


def test_on_given_labels(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = mil_quality.scores(documents, mil_quality.fit(documents, labels))
    rows = scored.join(labels, "doc_id").where(mil_quality.SPLIT.column(labels.doc_id)).collect()
    right = sum((r["score"] >= 0.7) == (r["quality"] == 1) for r in rows)
    assert right >= 0.85 * len(rows)
