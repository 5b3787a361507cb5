"""Token counts kept by deltas.

A batch of changes is a set of signed rows: an insert adds a document's counts, a delete takes
them off, a revision does both. Batches are summed by source, language and tokenizer
version before anything is stored, so a batch adds as many rows as it has groups, and totals are
sums over batches. A batch is committed once: its folder is named after it, committing it again
changes nothing, and committing other rows under its name fails. Many batches are folded into one folder, which
remembers their names.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("source", "lang", "tokenizer")
AMOUNTS = ("n_docs", "n_tokens", "n_chars")
SCHEMA = "source string, lang string, tokenizer string, n_docs long, n_tokens long, n_chars long"

# Rule tokenizers by version: the pattern whose matches are the tokens.
TOKENIZERS = {
    "words-1": r"[^\x20\x09-\x0D]+",
    "pieces-1": r"[A-Za-z]+|[0-9]|[^\x00-\x7F]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]",
}


def tokens(text: Column, tokenizer: str) -> Column:
    """How many tokens a rule tokenizer finds; none in null."""
    found = F.regexp_count(text, F.lit(TOKENIZERS[tokenizer]))
    return F.coalesce(found, F.lit(0)).cast("long")


def chars(text: Column) -> Column:
    return F.coalesce(F.char_length(text), F.lit(0)).cast("long")


def counted(docs: DataFrame, tokenizer: str, n_tokens: str, n_chars: str) -> DataFrame:
    """One unsigned row for each document, from columns that hold its counts."""
    return docs.select(
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        F.lit(tokenizer).alias("tokenizer"),
        F.lit(1).cast("long").alias("n_docs"),
        F.col(n_tokens).alias("n_tokens"),
        F.col(n_chars).alias("n_chars"),
    )


def signed(rows: DataFrame, sign: int) -> DataFrame:
    return rows.select(*KEYS, *((F.col(a) * sign).alias(a) for a in AMOUNTS))


def inserts(rows: DataFrame) -> DataFrame:
    return signed(rows, 1)


def deletes(rows: DataFrame) -> DataFrame:
    return signed(rows, -1)


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old counts off, new counts on; the keys may change as well."""
    return signed(old, -1).unionByName(signed(new, 1))


class TokenRollup:
    """Totals in a folder that all executors share; one committer at a time."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, *parts: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.folder, *parts)))
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _exists(self, *parts: str) -> bool:
        path, files = self._path(*parts)
        return files.exists(path)

    def _folds(self) -> list[str]:
        """The fold that counts, as a list of at most one name: the last one that was finished."""
        root, files = self._path()
        names = [s.getPath().getName() for s in files.listStatus(root)] if files.exists(root) else []
        done = [n for n in names if n.startswith("fold=") and self._exists(n, "names", "_SUCCESS")]
        return sorted(done)[-1:]

    def _folded_names(self, fold: str) -> DataFrame:
        return self.spark.read.schema("batch string, digest string").parquet(f"{self.folder}/{fold}/names")

    def committed(self, batch: str) -> bool:
        """Spark's own mark of a finished write, or a name in the fold; a failed attempt left neither."""
        return self._exists(f"batch={batch}", "_SUCCESS") or self._known(batch) is not None

    def _known(self, batch: str) -> str | None:
        """The digest of a folded batch."""
        for fold in self._folds():
            found = self._folded_names(fold).where(F.col("batch") == batch).first()
            if found:
                return found["digest"]
        return None

    def batches(self) -> list[str]:
        """Committed batches that lie in folders of their own."""
        root, files = self._path()
        if not files.exists(root):
            return []
        names = [s.getPath().getName() for s in files.listStatus(root)]
        alone = [n.removeprefix("batch=") for n in names if n.startswith("batch=")]
        alone = sorted(n for n in alone if self._exists(f"batch={n}", "_SUCCESS"))
        # a fold that was broken off while it deleted: what it holds does not count twice
        for fold in self._folds():
            held = {r["batch"] for r in self._folded_names(fold).where(F.col("batch").isin(alone)).collect()}
            alone = [n for n in alone if n not in held]
        return alone

    @staticmethod
    def _digest(sums: DataFrame) -> str:
        """A few numbers that say which sums a batch has; the order of its rows does not matter."""
        row = F.xxhash64(*(F.coalesce(F.col(k), F.lit("\0")) for k in KEYS), *AMOUNTS)
        found = sums.agg(F.count("*"), F.bit_xor(row), *(F.sum(a) for a in AMOUNTS)).first()
        return json.dumps([v if v is None else int(v) for v in found])

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Store a batch of signed rows; False if it is stored already, ValueError if with other sums.

        A hot source or language is summed in the reading tasks first, so one row for each group and
        task is shuffled. Groups that cancel out are kept: they may be needed to see why.
        """
        if not batch or "/" in batch:
            raise ValueError("a batch needs a name without a slash")
        sums = changes.groupBy(*KEYS).agg(*(F.sum(a).alias(a) for a in AMOUNTS))
        if not self.committed(batch):
            sums.write.mode("overwrite").parquet(f"{self.folder}/batch={batch}")
            return True
        own = self._known(batch) or self._digest(self._read([batch]))
        if self._digest(sums) != own:
            raise ValueError(f"batch {batch} was committed with other counts")
        return False

    def fold(self) -> int:
        """Put all batches into one folder, with their names and digests; returns how many there were.

        The sums are written before the names, whose finished write makes the fold count, and the
        folders go last. Numbers of folds ascend, so a later fold holds the earlier one's batches.
        """
        alone, before = self.batches(), self._folds()
        if not alone:
            return 0
        number = int(before[0].split("=")[1].split("-")[0]) + 1 if before else 1
        new = f"fold={number:012d}-{uuid.uuid4().hex[:8]}"
        rows = self._read(alone)
        names = self.spark.createDataFrame(
            [(n, self._digest(self._read([n]))) for n in alone], "batch string, digest string"
        )
        for old in before:
            rows = rows.unionByName(self.spark.read.schema(SCHEMA).parquet(f"{self.folder}/{old}/sums"))
            names = names.unionByName(self._folded_names(old))
        sums = rows.groupBy(*KEYS).agg(*(F.sum(a).alias(a) for a in AMOUNTS))
        sums.write.parquet(f"{self.folder}/{new}/sums")
        names.coalesce(1).write.parquet(f"{self.folder}/{new}/names")
        for old in (*(f"batch={n}" for n in alone), *before):
            path, files = self._path(old)
            files.delete(path, True)
        return len(alone)

    def _read(self, names: list[str]) -> DataFrame:
        paths = [f"{self.folder}/batch={n}" for n in names]
        if not paths:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(*paths)

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens, n_chars) of groups that hold documents.

        Null keys are a group like any other. No batches: no rows.
        """
        rows = self._read(self.batches())
        for fold in self._folds():
            rows = rows.unionByName(self.spark.read.schema(SCHEMA).parquet(f"{self.folder}/{fold}/sums"))
        sums = rows.groupBy(*KEYS).agg(*(F.sum(a).alias(a) for a in AMOUNTS))
        return sums.where("n_docs <> 0 OR n_tokens <> 0 OR n_chars <> 0")
