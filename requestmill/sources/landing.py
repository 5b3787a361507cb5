"""Raw records: the landing zone, increments of it, and raw text formats."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from requestmill import schemas as S
from requestmill.operators import clean

# Blanks belong to the values, and quotes are doubled inside quoted text.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
}
# Files that this library writes tell NULL from empty text. Its backslash is never followed by
# an N in a value, since ``escape_breaks`` marks every backslash.
OWN_CSV = {**CSV_OPTIONS, "nullValue": "\\N"}
ARRIVAL = "seq"


def read_landing(
    spark: SparkSession,
    path: str,
    fmt: str = "json",
    schema: T.StructType = S.RAW_SCHEMA,
    modified_after: str | None = None,
    paths: Sequence[str] | None = None,
    **options: str,
) -> DataFrame:
    """Raw records with a fixed schema; fields a record lacks are NULL.

    ``modified_after`` skips files last written before that time without opening
    them. A file cannot hold requests made after it was written, so the time of
    the wanted increment is a safe bound where files keep their writing time. ``paths``
    reads these files only.
    """
    reader = spark.read.schema(schema).options(**options)
    if fmt == "csv":  # landed files may hold quoted line breaks; one task reads a file then
        reader = reader.options(**{**CSV_OPTIONS, "multiLine": "true", **options})
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    return reader.format(fmt).load(path if paths is None else list(paths))


@dataclass(frozen=True)
class ArrivalFolders:
    """A landing zone whose folders are named by the day their files arrive.

    layout: such a name, as ``strftime`` writes it. Other names in the zone are listed in every run.
    look_back: folders of this span before the last listing are listed again, for files that arrive late.
    full_every: after this span a run lists the whole zone, for files in still older folders.
    """

    layout: str = "arrival_date=%Y-%m-%d"
    look_back: timedelta = timedelta(days=2)
    full_every: timedelta = timedelta(days=7)

    def day(self, name: str) -> datetime | None:
        try:
            return datetime.strptime(name, self.layout)
        except ValueError:
            return None

    def recent(self, names: Sequence[str], listed_at: datetime) -> list[str]:
        """The names whose day is not over by ``look_back`` before ``listed_at``, and those without a day."""
        since = listed_at - self.look_back - timedelta(days=1)
        days = {name: self.day(name) for name in names if not _hidden(name)}
        return [name for name, day in days.items() if day is None or day > since]


def _hidden(name: str) -> bool:
    """Names that Spark does not read."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


FILES_SCHEMA = T.StructType(
    [
        T.StructField("file_path", T.StringType()),
        T.StructField("file_time", T.TimestampType()),
        T.StructField("size_bytes", T.LongType()),
    ]
)


def landed_files(spark: SparkSession, path: str, names: Sequence[str] | None = None) -> DataFrame:
    """(file_path, file_time, size_bytes) of the landing zone; contents are not read.

    ``names``: only these folders and files of the zone are listed.
    """
    if names is not None and not names:
        return spark.createDataFrame([], FILES_SCHEMA)
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path if names is None else [f"{path}/{name}" for name in names])
        .select(
            F.col("path").alias("file_path"),
            F.col("modificationTime").alias("file_time"),
            F.col("length").alias("size_bytes"),
        )
    )


def with_file_place(df: DataFrame, column: str = ARRIVAL) -> DataFrame:
    """Add where each row of a file scan comes from: file age, path, block."""
    meta = F.col("_metadata")
    place = F.struct(
        meta["file_modification_time"].alias("file_time"),
        meta["file_path"].alias("file_path"),
        meta["file_block_start"].alias("block"),
    )
    return df.select("*", place.alias(column))


def with_row_place(df: DataFrame, column: str = ARRIVAL) -> DataFrame:
    """Complete the file place to a sortable arrival order.

    Rows of one file block are read by one task in their order, so a per-task
    running number orders them. A source column is preferable where there is one.
    """
    return df.withColumn(
        column, F.struct(f"{column}.*", F.monotonically_increasing_id().alias("row"))
    )


def parse_json_records(
    df: DataFrame, column: str, schema: T.StructType = S.RAW_SCHEMA
) -> DataFrame:
    """Records held as JSON text in a column."""
    return df.select(
        *[c for c in df.columns if c != column],
        F.from_json(F.col(column), schema).alias("record"),
    ).select(*[c for c in df.columns if c != column], "record.*")


def normalise_since(text: str) -> str:
    """A bound as the source takes it: no fraction, ``T`` between date and time."""
    return text.split(".", 1)[0].replace(" ", "T")


def extract_incremental(
    raw: DataFrame,
    since: str,
    column: str = "created_date",
    lookback: timedelta = timedelta(0),
) -> DataFrame:
    """Rows created at or after ``since``, bound included.

    Rows exactly at the bound come again; the merge absorbs them. ``lookback``
    re-reads a trailing span, to catch later changes of older requests. The bound
    on a TIMESTAMP column is pushed to the scan.
    """
    bound = datetime.fromisoformat(normalise_since(since)) - lookback
    parsed = clean.parse_timestamps(raw, (column, "closed_date"))
    return parsed.where(F.col(column) >= F.lit(bound.isoformat(sep=" ")).cast("timestamp"))


def extract_days_back(raw: DataFrame, as_of: str, days_back: int = 7) -> DataFrame:
    """Rows of the last days before ``as_of``, for a first or forced full load."""
    start = datetime.fromisoformat(normalise_since(as_of)) - timedelta(days=days_back)
    return extract_incremental(raw, start.isoformat())


def in_creation_order(df: DataFrame, ties: Sequence[str] = (ARRIVAL,)) -> DataFrame:
    """Sort by creation time. Ties are ordered too, so a frequent time can be split."""
    return df.orderBy(F.asc("created_date"), *[F.asc(c) for c in ties])


# Line breaks and the sign that marks them, in the order of writing.
_BREAKS = (("\\", "\\b"), ("\n", "\\n"), ("\r", "\\r"))


def _text_columns(df: DataFrame, columns: Sequence[str] | None) -> list[str]:
    return [
        f.name
        for f in df.schema
        if isinstance(f.dataType, T.StringType) and (columns is None or f.name in columns)
    ]


def _replaced(df: DataFrame, columns: Sequence[str] | None, pairs) -> DataFrame:
    def one(name: str):
        value = F.col(name)
        for old, new in pairs:
            value = F.replace(value, F.lit(old), F.lit(new))
        return value

    return df.withColumns({c: one(c) for c in _text_columns(df, columns)})


def escape_breaks(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Line breaks in texts written as signs, so that a line of a file is a record."""
    return _replaced(df, columns, _BREAKS)


def restore_breaks(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The texts that ``escape_breaks`` was given."""
    return _replaced(df, columns, [(new, old) for old, new in reversed(_BREAKS)])


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV that stays splittable: line breaks in texts are escaped."""
    escape_breaks(df).write.options(**OWN_CSV).mode(mode).csv(path)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = S.RAW_SCHEMA,
    na_tokens: Sequence[str] = S.NA_TOKENS,
    foreign: bool = False,
) -> DataFrame:
    """CSV read back as text; missing-value texts become NULL.

    Files that ``write_csv`` wrote have their line breaks restored. ``foreign`` files may hold
    quoted line breaks as they are; such a file is read by one task.
    """
    if foreign:
        rows = read_landing(spark, path, "csv", schema, multiLine="true")
    else:
        reader = spark.read.schema(schema).options(**OWN_CSV)
        rows = restore_breaks(reader.csv(path))
    return clean.null_na_tokens(rows, na_tokens)
