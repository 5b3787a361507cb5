"""Benchmark decontamination with DataFrame functions only.

Windows of the benchmark's normalised words form a hash set. A bit set of their hashes, of a bounded
size, goes to every task and documents are scanned once: a window whose bit is set is a
candidate, candidates meet the set in a hash join on the window's 64-bit hash, and a hit is verified by
comparing the words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from requestmill.llm.common import ROW, let, window_hashes, written

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Limits:
    """Up to ``broadcast_bytes`` the windows are sent to every task, beyond them they are shuffled
    with the candidates, with the same result.

    The bit set has 16 bits for each window, a power of two of at most 2 ** ``log_bits`` (16 MB), so up to
    eight million windows let one in sixteen other windows pass, which the join drops.
    """

    broadcast_bytes: int = 32 << 20
    log_bits: int = 27


def lower_ascii(text: Column) -> Column:
    """A-Z only; lower() is faster and the same where all is ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def words(text: Column) -> Column:
    """Normalised words; null has none."""
    found = F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def _text_hash() -> Column:
    """With the doc_id it tells rows apart; null and empty texts never hit."""
    return F.xxhash64("text")


def _span(tokens: Column, start: Column, length: int) -> Column:
    return F.slice(tokens, start + 1, length)


def _starts(tokens: Column, length: int) -> Column:
    most = F.size(tokens) - length
    return F.when(most >= 0, F.sequence(F.lit(0), most)).otherwise(F.array().cast("array<int>"))


def windows_of(benchmark: DataFrame, size: int = 10) -> DataFrame:
    """(length, hash, gram, items): each distinct window and the items that hold it.

    A window has ``size`` words; an item of fewer words, but not none, is one window.
    """
    items = benchmark.select(
        F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w")
    ).where("size(w) > 0")
    spans = items.select(
        "item", "w", F.least(F.size("w"), F.lit(size)).alias("length")
    ).select(
        "item",
        "length",
        F.explode(
            F.expr("transform(sequence(0, size(w) - length), i -> slice(w, i + 1, length))")
        ).alias("gram"),
    )
    grams = spans.groupBy("length", "gram").agg(F.collect_set("item").alias("items"))
    hashes = (
        F.when(F.col("length") == k, F.element_at(window_hashes(F.col("gram"), k), 1))
        for k in range(1, size + 1)
    )
    return grams.select("length", F.coalesce(*hashes).alias("hash"), "gram", "items")


def _bit(hashes: Column, log_bits: int) -> tuple[Column, Column]:
    """(word, place in the word) of a hash's bit."""
    low = hashes.bitwiseAND(F.lit((1 << log_bits) - 1))
    return F.shiftright(low, 6).cast("int"), low.bitwiseAND(F.lit(63)).cast("int")


def bit_set(grams: DataFrame, limits: Limits) -> tuple[DataFrame, int]:
    """One row: the bits of all windows' hashes as an array of 64-bit words; and the bits' logarithm."""
    log_bits = max(6, min(limits.log_bits, max(16, (16 * grams.count()).bit_length())))
    word, place = _bit(F.col("hash"), log_bits)
    one = F.call_function("shiftleft", F.lit(1).cast("long"), place)
    full = grams.groupBy(word.alias("k")).agg(F.bit_or(one).alias("bits"))
    words = grams.sparkSession.range(1 << log_bits - 6).select(F.col("id").cast("int").alias("k"))
    each = F.struct("k", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    every = words.join(full, "k", "left").agg(F.sort_array(F.collect_list(each)).alias("all"))
    return every.select(F.col("all.bits").alias("bits")), log_bits


def _candidates(tokens: Column, bits: Column, lengths: list[int], log_bits: int) -> Column:
    """(at, length, hash, gram) of the windows whose bit is set."""

    def of(length: int) -> Column:
        def passing(hashes: Column) -> Column:
            def is_set(at: Column) -> Column:
                word, place = _bit(F.get(hashes, at), log_bits)
                return F.getbit(F.get(bits, word), place) == 1

            return F.transform(
                F.filter(_starts(tokens, length), is_set),
                lambda i: F.struct(
                    i.alias("at"),
                    F.lit(length).alias("length"),
                    F.get(hashes, i).alias("hash"),
                    _span(tokens, i, length).alias("gram"),
                ),
            )

        none = F.array().cast(kind)
        return F.when(F.size(tokens) < length, none).otherwise(
            let(window_hashes(tokens, length), passing)
        )

    kind = "array<struct<at:int,length:int,hash:bigint,gram:array<string>>>"
    if not lengths:
        return F.array().cast(kind)
    return F.concat(*(of(n) for n in lengths)).cast(kind)


def scan(docs: DataFrame, benchmark: DataFrame, size: int = 10, limits: Limits = Limits()):
    """(row data, hits): the scanned rows by a row number, and hits for each row that has any.

    Rows carry doc_id, text_hash and n_words; hits carry n_hit, covered (word positions) and items.
    """
    grams = written(windows_of(benchmark, size), "windows")
    lengths = sorted(r[0] for r in grams.select("length").distinct().collect())  # of 1 to ``size``
    bits, log_bits = bit_set(grams, limits)
    scanned = docs.select(
        F.monotonically_increasing_id().alias(ROW),
        "doc_id",
        "text",
        bits.scalar().alias("bits"),  # used once below: it stays a value beside the rows
    ).select(
        ROW,
        "doc_id",
        _text_hash().alias("text_hash"),
        let(
            F.struct(words(F.col("text")).alias("w"), F.col("bits").alias("bits")),
            lambda s: F.struct(
                F.size(s.w).cast("long").alias("n_words"),
                _candidates(s.w, s.bits, lengths, log_bits).alias("found"),
            ),
        ).alias("s"),
    ).select(ROW, "doc_id", "text_hash", "s.n_words", "s.found")
    rows = written(scanned, "scanned")
    found = rows.select(ROW, F.explode("found").alias("c")).select(ROW, "c.*")
    found = found.withColumnRenamed("gram", "seen")
    bound = grams.agg(
        F.sum(F.octet_length(F.concat_ws(" ", "gram")) + 24 * F.size("items") + 64)
    ).first()[0]
    known = F.broadcast(grams) if (bound or 0) <= limits.broadcast_bytes else grams
    hits = found.join(known, ["length", "hash"]).where("seen = gram")
    per_row = hits.groupBy(ROW).agg(
        F.collect_list(F.struct("at", "length")).alias("spans"),
        F.collect_set("items").alias("items"),
    )
    covered = F.array_distinct(
        F.flatten(F.transform("spans", lambda s: F.sequence(s.at, s.at + s.length - 1)))
    )
    return rows, per_row.select(
        ROW,
        F.array_sort(covered).alias("covered"),
        F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"),
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, size: int = 10, limits: Limits = Limits()
) -> DataFrame:
    """One row for each document row: doc_id, n_words, n_hit, items, contaminated.

    A null text has no words, like an empty one. Benchmark items without words match
    nothing, equal items all count, and an empty benchmark leaves every document clean. Rows given
    twice are judged twice. Other columns are not read.
    """
    rows, hits = scan(docs, benchmark, size, limits)
    joined = rows.select(ROW, "doc_id", "n_words").join(hits, ROW, "left")
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce(F.size("covered"), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("covered").isNotNull().alias("contaminated"),
    )


def clean_documents(
    docs: DataFrame, benchmark: DataFrame, size: int = 10, limits: Limits = Limits()
) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark window, with their columns.

    Rows are judged by their text, so rows without a doc_id, or with one that occurs
    twice, each get their own verdict.
    """
    rows, hits = scan(docs, benchmark, size, limits)
    bad = rows.join(hits.select(ROW), ROW).select(
        F.col("doc_id").alias("__llm_id"), F.col("text_hash").alias("__llm_hash")
    )
    same = F.col("doc_id").eqNullSafe(F.col("__llm_id")) & (
        _text_hash() == F.col("__llm_hash")
    )
    return docs.join(bad.distinct(), same, "left_anti")


def without_spans(
    docs: DataFrame, benchmark: DataFrame, size: int = 10, limits: Limits = Limits()
) -> DataFrame:
    """The rows of ``docs``; in each text the hit words and the gaps behind them are cut."""
    rows, hits = scan(docs, benchmark, size, limits)
    bad = rows.join(hits, ROW).select(
        F.col("doc_id").alias("__llm_id"),
        F.col("text_hash").alias("__llm_hash"),
        F.col("covered").alias("__llm_covered"),
    )
    bad = bad.dropDuplicates(["__llm_id", "__llm_hash"])
    same = F.col("doc_id").eqNullSafe(F.col("__llm_id")) & (
        _text_hash() == F.col("__llm_hash")
    )
    own = F.regexp_extract_all("text", F.lit(WORD_ANY_CASE), F.lit(0))
    gaps = F.split("text", WORD_ANY_CASE, -1)
    cut = let(
        F.struct(own.alias("w"), gaps.alias("g"), F.col("__llm_covered").alias("c")),
        lambda s: F.array_join(
            F.concat(
                F.array(F.get(s.g, F.lit(0))),
                F.transform(
                    F.array_except(_starts(s.w, 1), s.c),
                    lambda i: F.concat(F.get(s.w, i), F.get(s.g, i + 1)),
                ),
            ),
            "",
        ),
    )
    text = F.when(F.col("__llm_covered").isNotNull(), cut).otherwise(F.col("text"))
    return docs.join(bad, same, "left").select(
        *(text.alias(c) if c == "text" else F.col(c) for c in docs.columns)
    )
