"""The reporting table's contract: keys, mandatory columns, lengths, layout."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from requestmill import schemas as S

VIOLATIONS = "violations"


def _row_rules(
    df: DataFrame, required: Sequence[str], limits: Mapping[str, int]
) -> dict[str, Column]:
    """Rules one row can break by itself, by name."""
    rules = {f"{c}_missing": F.col(c).isNull() for c in required}
    for column, limit in limits.items():
        if column in df.columns:
            rules[f"{column}_too_long"] = F.coalesce(F.char_length(column) > limit, F.lit(False))
    return rules


def contract_violations(
    df: DataFrame,
    key: str = S.KEY,
    required: Sequence[str] = S.REQUIRED_COLUMNS,
    limits: Mapping[str, int] = S.TEXT_LIMITS,
) -> DataFrame:
    """Number of violations of each rule.

    Counted per key first, so the exchange carries one row per key and task;
    surplus rows of a key are what its uniqueness rule is broken by.
    """
    rules = _row_rules(df, required, limits)
    per_key = df.groupBy(key).agg(
        F.count("*").alias("n"), *[F.count_if(r).alias(name) for name, r in rules.items()]
    )
    surplus = F.when(F.col(key).isNotNull(), F.col("n") - 1)
    totals = per_key.agg(
        F.coalesce(F.sum(surplus), F.lit(0)).alias(f"{key}_duplicate"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in rules],
    )
    structs = [
        F.struct(F.lit(name).alias("rule"), F.col(name).alias("violations"))
        for name in totals.columns
    ]
    return totals.select(F.inline(F.array(*structs)))


def mark_violations(
    df: DataFrame,
    required: Sequence[str] = S.REQUIRED_COLUMNS,
    limits: Mapping[str, int] = S.TEXT_LIMITS,
) -> DataFrame:
    """Add the names of the row rules each row breaks. No shuffle."""
    broken = [F.when(r, F.lit(name)) for name, r in _row_rules(df, required, limits).items()]
    return df.withColumn(VIOLATIONS, F.array_compact(F.array(*broken)))


def accepted(marked: DataFrame) -> DataFrame:
    """Rows the reporting table takes."""
    return marked.where(F.size(VIOLATIONS) == 0).drop(VIOLATIONS)


def quarantined(marked: DataFrame) -> DataFrame:
    """Rows it refuses, with the reasons as text."""
    return marked.where(F.size(VIOLATIONS) > 0).withColumn(
        VIOLATIONS, F.array_join(VIOLATIONS, ",")
    )


def schema_contract(
    df: DataFrame,
    expected: T.StructType = S.PROCESSED_SCHEMA,
    limits: Mapping[str, int] = S.TEXT_LIMITS,
    required: Sequence[str] = S.REQUIRED_COLUMNS,
) -> DataFrame:
    """Compare a relation's columns with the expected layout, one row per column.

    ``status`` is ok, missing, extra, misplaced or wrong_type. The longest text
    and the NULL count come from one pass over the data.
    """
    actual = {f.name: (i, f.dataType.simpleString()) for i, f in enumerate(df.schema, 1)}
    wanted = {f.name: (i, f.dataType.simpleString()) for i, f in enumerate(expected, 1)}
    measures = [F.count("*").alias("rows")]
    for field in df.schema:
        measures.append(F.count_if(F.col(field.name).isNull()).alias(f"null_{field.name}"))
        if isinstance(field.dataType, T.StringType):
            measures.append(F.max(F.char_length(field.name)).alias(f"long_{field.name}"))
    measured = df.agg(*measures)

    structs = []
    for name in list(wanted) + [n for n in actual if n not in wanted]:
        place, kind = actual.get(name, (None, None))
        wanted_place, wanted_kind = wanted.get(name, (None, None))
        if place is None:
            status = "missing"
        elif wanted_place is None:
            status = "extra"
        elif place != wanted_place:
            status = "misplaced"
        else:
            status = "ok" if kind == wanted_kind else "wrong_type"
        longest = f"long_{name}"
        values = {
            "column_name": F.lit(name),
            "expected_position": F.lit(wanted_place).cast("int"),
            "actual_position": F.lit(place).cast("int"),
            "data_type": F.lit(kind or wanted_kind),
            "max_length": F.lit(limits.get(name)).cast("int"),
            "nullable": F.lit(name not in required),
            "status": F.lit(status),
            "longest": F.col(longest) if longest in measured.columns else F.lit(None).cast("int"),
            "nulls": F.col(f"null_{name}") if place else F.lit(None).cast("bigint"),
        }
        structs.append(F.struct(*[v.alias(n) for n, v in values.items()]))
    return measured.select(F.inline(F.array(*structs)))
