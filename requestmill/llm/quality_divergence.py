"""Distribution divergence with DataFrame functions only.

A document's histograms of character classes and of common words are compared with those of
its language, by Jensen-Shannon distance. Texts are read once; the measures of a document
take a few hundred bytes, and language references are sums of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from requestmill.llm.common import let, window_hashes, written

WORD = r"[^\x20\x09-\x0D]+"
# Character classes besides lower-case letters with blanks, which are stripped first; what
# none of them holds is the last class.
PLAIN = "[a-z ]+"
SYMBOLS = r"[#*$%&|<>]+"
CLASSES = {
    "upper": "[A-Z]+",
    "digit": "[0-9]+",
    "mark": "[.,;:'\"?()-]+",
    "wide": r"[^\x00-\x7F]+",
}
# Frequent function words of four languages.
COMMON_WORDS = {
    "en": "the of and to in is that for it with on are".split(),
    "de": "der die und das den von zu mit ist des nicht ein".split(),
    "fr": "le la les de et des du une est pour que dans".split(),
    "es": "el los las y en un por con no se lo para".split(),
}


@dataclass(frozen=True)
class Thresholds:
    """A check is made only from its least length on; below it a histogram says too little.

    Short texts stray further: ``class_noise`` over the square root of the characters is added
    to ``class_distance``.
    """

    min_words: int = 10
    repeat_percent: int = 20
    window: int = 5
    class_chars: int = 200
    class_distance: float = 0.15
    class_noise: float = 0.8
    word_words: int = 100
    word_distance: float = 0.26


def _vocabulary() -> list[str]:
    return list(dict.fromkeys(w for words in COMMON_WORDS.values() for w in words))


def _left(text: Column, drop: str) -> Column:
    """Characters that remain without the pattern's matches."""
    return F.char_length(F.regexp_replace(text, drop, ""))


def _characters(text: Column) -> Column:
    """(n_symbols, classes); all but one pass read only what the first one leaves."""

    def counts(r: Column) -> Column:
        size = F.char_length(r)
        of = [size - _left(r, SYMBOLS), *(size - _left(r, p) for p in CLASSES.values())]
        rest = size
        for c in of:
            rest = rest - c
        classes = F.array(F.char_length(text) - size, *of, rest)
        return F.struct(of[0].cast("long").alias("n_symbols"), classes.alias("classes"))

    return let(F.regexp_replace(text, PLAIN, ""), counts)


def _word_counts(words: Column) -> Column:
    """How often each common word occurs, and how many words are none of them."""
    vocabulary = _vocabulary()
    common = F.filter(words, lambda w: w.isin(vocabulary))
    return let(
        F.struct(
            F.concat(F.lit(" "), F.array_join(common, "  "), F.lit(" ")).alias("line"),
            F.size(words).alias("n"),
            F.size(common).alias("c"),
        ),
        lambda s: F.array(
            *(
                F.floor(
                    (F.octet_length(s.line) - F.octet_length(F.replace(s.line, F.lit(f" {w} "))))
                    / F.lit(len(w.encode()) + 2)
                ).cast("int")
                for w in vocabulary
            ),
            s.n - s.c,
        ),
    )


def _again(items: Column, key: str) -> Column:
    """Elements of a sorted array whose neighbour has the same key."""
    marked = F.transform(
        items,
        lambda x, k: F.struct(
            x.alias("x"),
            (
                F.coalesce(F.get(items, k + 1)[key] == x[key], F.lit(False))
                | F.coalesce(F.get(items, k - 1)[key] == x[key], F.lit(False))
            ).alias("again"),
        ),
    )
    return F.transform(F.filter(marked, lambda y: y.again), lambda y: y.x)


def _repeated(words: Column, width: int) -> Column:
    """Words in windows that occur twice or more.

    Where all windows differ in their hash none repeats. Elsewhere those that share a hash
    are compared by their words.
    """
    last = F.size(words) - width

    def covered(starts: Column) -> Column:
        """Each window adds the words up to the next one's start, the last one all it has."""
        steps = F.transform(
            starts,
            lambda at, k: F.least(F.lit(width), F.coalesce(F.get(starts, k + 1) - at, F.lit(width))),
        )
        return F.aggregate(steps, F.lit(0), lambda total, n: total + n)

    def exact(hashes: Column) -> Column:
        by_hash = F.sort_array(
            F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        )
        same_hash = let(by_hash, lambda s: _again(s, "h"))
        by_text = F.sort_array(
            F.transform(
                same_hash,
                lambda x: F.struct(
                    F.array_join(F.slice(words, x.i + 1, width), " ").alias("g"), x.i.alias("i")
                ),
            )
        )
        same_text = let(by_text, lambda s: _again(s, "g"))
        return let(F.sort_array(F.transform(same_text, lambda x: x.i)), covered)

    return F.when(last < 1, 0).otherwise(
        let(
            window_hashes(words, width),
            lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(exact(h)),
        )
    )


def measures(docs: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """Base counts, base verdict and histograms of each document; the only pass over texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    found = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeated(w, limits.window).cast("long").alias("n_repeat_words"),
            _word_counts(w).alias("common"),
        )

    def with_verdict(m: Column) -> Column:
        failed = (m.n_words < limits.min_words) | (
            100 * m.n_repeat_words > limits.repeat_percent * m.n_words
        )
        return F.struct(m.alias("m"), failed.alias("base_failed"))

    return docs.select(
        "doc_id",
        "lang",
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
        .cast("long")
        .alias("n_dup_lines"),
        _characters(text).alias("c"),
        let(let(found, of_words), with_verdict).alias("w"),
    ).select("doc_id", "lang", "n_dup_lines", "c.*", "w.m.*", "w.base_failed")


def _sums(column: str, size: int) -> Column:
    return F.array(*(F.sum(F.get(column, F.lit(k))).cast("double") for k in range(size)))


def references(passing: DataFrame) -> DataFrame:
    """(lang, class_ref, word_ref): summed histograms of the documents of each language."""
    return (
        passing.where("lang IS NOT NULL")
        .groupBy("lang")
        .agg(
            _sums("classes", len(CLASSES) + 3).alias("class_ref"),
            _sums("common", len(_vocabulary()) + 1).alias("word_ref"),
        )
    )


def _distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance in bits' square root, 0 to 1; 0 if either is empty."""

    def total(xs: Column) -> Column:
        return F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)

    def part(p: Column, q: Column) -> Column:
        return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(F.lit(0.0))

    def divergence(s: Column) -> Column:
        terms = F.zip_with(
            s.p,
            s.q,
            lambda a, b: let(
                F.struct((a / s.n).alias("p"), (b / s.m).alias("q")),
                lambda r: part(r.p, r.q) + part(r.q, r.p),
            ),
        )
        return F.when((s.n > 0) & (s.m > 0), F.sqrt(F.greatest(F.lit(0.0), total(terms) / 2)))

    doubles = counts.cast("array<double>")
    return F.coalesce(
        let(
            F.struct(
                doubles.alias("p"),
                reference.alias("q"),
                total(doubles).alias("n"),
                total(reference).alias("m"),
            ),
            divergence,
        ),
        F.lit(0.0),
    )


def _compared(measured: DataFrame, found: DataFrame, limits: Thresholds) -> DataFrame:
    """Distances to the language's reference and whether one of them is too far."""
    # one row of some 60 numbers for each language: broadcast is left to Spark's size check
    distances = measured.join(found, "lang", "left").select(
        *measured.columns,
        _distance(F.col("classes"), F.col("class_ref")).alias("class_distance"),
        _distance(F.col("common"), F.col("word_ref")).alias("word_distance"),
    )
    n_chars = F.aggregate("classes", F.lit(0), lambda a, x: a + x)
    allowed = limits.class_distance + limits.class_noise / F.sqrt(n_chars)
    far = ((n_chars >= limits.class_chars) & (F.col("class_distance") > allowed)) | (
        (F.col("n_words") >= limits.word_words) & (F.col("word_distance") > limits.word_distance)
    )
    return distances.withColumn("far", far)


def judged(docs: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """One row for each row of ``docs`` with its measures, distances and verdict.

    References are sums over all documents that pass the base rules, then once more over
    those that were not far from the first ones, so that junk does not shift them.

    Null and empty texts have no words and fail the base rules. A document without a
    language, or in one without a reference, has distances of 0. Histograms
    shorter than the least length are not judged. Rows given twice are judged twice, an empty
    table gives no rows. Other columns are not read.
    """
    measured = written(measures(docs, limits), "measures")
    passing = measured.where("NOT base_failed")
    first = written(references(passing), "references")
    near = _compared(passing, first, limits).where("NOT far")
    last = written(references(near), "references")
    return _compared(measured, last, limits).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "class_distance",
        "word_distance",
        (~F.col("base_failed") & ~F.col("far")).alias("kept"),
    )
