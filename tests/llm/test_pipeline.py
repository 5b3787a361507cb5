from __future__ import annotations

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from requestmill.llm import pii, toxicity
from requestmill.llm.queries import PII_KEY

from .conftest import SF
from .test_decontaminate import slow
from .test_simhash import slow_components, slow_fingerprint

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def steps(spark, documents, tmp_path_factory):
    """What each stage gets and gives, written in between as the pipeline does."""
    folder = tmp_path_factory.mktemp("stages")
    docs, out = documents, []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        out.append((docs, after))
        docs = after
    return out


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_names_and_columns(steps, documents):
    assert list(STAGES) == [
        "toxicity",
        "simhash_near_dedup",
        "benchmark_decontamination",
        "pii_pseudonyms",
        "bpe_encoding",
    ]
    assert all(after.columns == documents.columns for _, after in steps[:-1])
    assert corpus_pipeline.ORACLE_SQL is None


def test_toxic_documents_go(spark, steps):
    before, after = steps[0]
    model = toxicity.fit(before, spark.read.parquet(f"{SF}/labels.parquet"))
    scored = {r["doc_id"]: r["score"] for r in toxicity.scores(before, model).collect()}
    assert set(rows(after)) == {i for i, s in scored.items() if s < 0.7}
    assert 0 < after.count() < before.count()


def test_one_of_each_group_stays(steps):
    before, after = steps[1]
    prints = {i: slow_fingerprint(r["text"]) for i, r in rows(before).items()}
    assert set(rows(after)) == set(slow_components(prints, 2).values())


def test_contaminated_documents_go(spark, steps):
    before, after = steps[2]
    items = [
        (r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    ]
    found = slow({i: r["text"] for i, r in rows(before).items()}, items)
    assert set(rows(after)) == {i for i, f in found.items() if not f[3]}


def test_personal_data_are_replaced(steps):
    before, after = steps[3]
    own = pii.Pseudonymizer(PII_KEY)
    old, new = rows(before), rows(after)
    assert {i: r["text"] for i, r in new.items()} == {
        i: own.replaced(r["text"])[0] for i, r in old.items()
    }
    assert all(r["n_chars"] == len(r["text"]) for r in new.values())
    assert [r["lang"] for r in new.values()] == [old[i]["lang"] for i in new]


def test_what_is_left_is_encoded(steps):
    before, after = steps[4]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r["doc_id"]: (r["ids"], r["n_tokens"], r["decoded"]) for r in after.collect()}
    want = {}
    for i, r in rows(before).items():
        ids = library.encode(r["text"], add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want[i] = (" ".join(map(str, ids)), len(ids), text)
    assert got == want


def test_run_gives_the_last_stage(spark, steps):
    got = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, steps[-1][1].collect()))


@pytest.mark.parametrize("name", list(STAGES))
def test_odd_and_no_rows(spark, odd_docs, no_docs, name, tmp_path):
    found = STAGES[name](spark, odd_docs, SF)
    found.write.parquet(str(tmp_path / "odd"))
    again = spark.read.parquet(str(tmp_path / "odd"))
    if name != "bpe_encoding":
        assert again.columns == odd_docs.columns
    if name in ("toxicity", "benchmark_decontamination", "pii_pseudonyms", "bpe_encoding"):
        assert again.count() == odd_docs.count()
    assert STAGES[name](spark, no_docs, SF).count() == 0
