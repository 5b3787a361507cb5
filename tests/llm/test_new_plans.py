"""Plans of the archive, the manifest and the whitening: no cross join, nothing whole on the driver."""

from __future__ import annotations

import pytest

from requestmill.llm import merkle, warc, whitening

from .conftest import SF


def text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(f"{SF}/pages.parquet")


def test_archive_reads_no_payload_for_headers(spark, pages, folder):
    archive = warc.Archive(spark, folder).write(pages)
    scans = [x for x in text(archive.headers()).splitlines() if "ReadSchema" in x]
    assert scans and all("payload" not in x.split("ReadSchema")[1] for x in scans)
    plan = text(archive.contents())
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
    assert "NestedLoop" not in plan


def test_witnesses_shuffle_digests_only(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = text(merkle.checked(merkle.manifest(docs)))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "text" not in plan


def test_whitening_reads_two_columns(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    assert set(whitening.quantised(rows).columns) == {"vec_id", "x"}
    plan = text(whitening.whitened(rows))
    assert "CartesianProduct" not in plan and "Exchange" not in plan
