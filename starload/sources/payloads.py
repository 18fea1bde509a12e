"""Landed payload documents of the price service.

A landing folder holds `landed=<yyyymmdd>/symbol=<requested symbol>/<any name>` text files.
The symbol is the one that was asked for, taken from the folder, never from inside the
document. A run reads the folder of its day: its cost does not grow with the history.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starload.functions.checks import require
from starload.schemas import CSV_COLUMNS, FIELDS, SERIES_KEY
from starload.session import file_sizes, stored

LANDING_SCHEMA = "payload STRING, landed INT, symbol STRING"

_DOCUMENT = "`{}` MAP<STRING, STRUCT<{}>>, `_broken` STRING".format(
    SERIES_KEY, ", ".join(f"`{f}`: STRING" for f in FIELDS)
)
_STRICT_JSON = {"columnNameOfCorruptRecord": "_broken", "allowSingleQuotes": "false"}


def landed_path(path: str, run_date: dt.date) -> str:
    return f"{path.rstrip('/')}/landed={run_date:%Y%m%d}"


def read_landing(
    spark: SparkSession,
    path: str,
    run_date: dt.date | None = None,
    symbols: list[str] | None = None,
    packed: bool = False,
) -> DataFrame:
    """One row per document of a day, or of all days: payload, symbol, file, and when it landed:
    the day of its folder, `landed`, and the time of its file, `landed_at`.

    `packed` reads many one-line documents per file; at scale that beats a file per
    document. Asking for symbols prunes the folders that are listed and read. An empty file
    holds no document and gives no row.
    """
    folder = path if run_date is None else landed_path(path, run_date)
    reader = spark.read.schema(LANDING_SCHEMA).option("basePath", path)
    landed = reader.text(folder, wholetext=not packed)
    if symbols is not None:
        landed = landed.filter(F.col("symbol").isin(list(symbols)))
    return with_file(landed)


def landed_documents(
    spark: SparkSession, path: str, run_dates: Sequence[dt.date]
) -> DataFrame:
    """landed, exists, files, bytes: what the landing folder has for each of the days, from file
    listings alone. A day without a folder does not exist; a run of that day would fail."""
    found = []
    for day in run_dates:
        sizes = file_sizes(spark, landed_path(path, day))
        key = day.year * 10000 + day.month * 100 + day.day
        found.append((key, sizes is not None, len(sizes or ()), sum(sizes or ())))
    return spark.createDataFrame(found, "landed INT, exists BOOLEAN, files BIGINT, bytes BIGINT")


def stream_landing(
    spark: SparkSession, path: str, max_files: int | None = None, packed: bool = False
) -> DataFrame:
    """The same rows for files as they land. The folder must hold one symbol at least.

    A file counts however old it is when it comes; by default those would be left out that
    are a week older than the latest.
    """
    reader = spark.readStream.schema(LANDING_SCHEMA).format("text")
    reader = reader.option("wholetext", not packed).option("maxFileAge", "36500d")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return with_file(reader.load(path))


def with_file(landed: DataFrame) -> DataFrame:
    return landed.select(
        "payload",
        "symbol",
        F.col("_metadata.file_path").alias("file"),
        "landed",
        F.col("_metadata.file_modification_time").alias("landed_at"),
    )


def _alone(payload: Column) -> Column:
    """Whether the text is one JSON value and nothing follows it.

    Parsers of one value stop behind it. As the first element of an array whose second is
    known, a text with more in it puts something else in second place or breaks the array.
    """
    mark = F.xxhash64(payload).cast("string")
    listed = F.concat(F.lit("["), payload, F.lit(',"'), mark, F.lit('"]'))
    return F.get_json_object(listed, "$[1]").eqNullSafe(mark)


def parse_payloads(documents: DataFrame) -> DataFrame:
    """`documents` with `series`, the parsed days, and `reason`, why it is unusable or NULL.

    A text that holds more than one document, or anything behind it, is not a valid one.

    The one-element explode keeps a document on its row and makes the parsed value a column
    of its own: filters on it stay above, so that each text is parsed exactly once.
    """
    document = F.from_json("payload", _DOCUMENT, _STRICT_JSON)
    value = F.struct(document.alias("json"), _alone(F.col("payload")).alias("alone"))
    parsed = documents.select("*", F.explode(F.array(value)).alias("_doc"))
    series = F.col("_doc.json").getField(SERIES_KEY)
    broken = F.col("_doc.json._broken").isNotNull() | ~F.col("_doc.alone")
    reason = (
        F.when(broken, "not a valid document")
        .when(series.isNull(), "no daily series")
        .when(F.size(series) == 0, "empty daily series")
        .when(F.exists(F.map_values(series), lambda v: v.isNull()), "day without values")
    )
    return parsed.select(*documents.columns, series.alias("series"), reason.alias("reason"))


def explode_series(parsed: DataFrame) -> DataFrame:
    """One row of text per document and day, ascending by day, in the CSV columns.

    The days are sorted inside the document's row, so nothing is shuffled; of a repeated day
    the last one in the text is kept. Columns that came with the documents follow, except
    the raw text.
    """
    numbered = F.transform(
        F.map_entries("series"),
        lambda entry, position: F.struct(
            entry["key"].alias("timestamp"),
            position.alias("position"),
            entry["value"].alias("fields"),
        ),
    )

    def last_of_its_day(day: Column, position: Column) -> Column:
        following = F.get("_sorted", position + 1)
        return ~day["timestamp"].eqNullSafe(following["timestamp"])

    extra = [c for c in parsed.columns if c not in ("payload", "series", "reason", "symbol")]
    in_order = parsed.select("symbol", *extra, F.sort_array(numbered).alias("_sorted"))
    # Filtering inside the explode: on a named column the optimizer would add a check for
    # emptiness and evaluate sorting and parsing once more for it.
    rows = in_order.select(
        "symbol", *extra, F.explode(F.filter("_sorted", last_of_its_day)).alias("day")
    )
    fields = {to: F.col("day.fields").getField(name) for name, to in FIELDS.items()}
    fields |= {"timestamp": F.col("day.timestamp"), "symbol": F.col("symbol")}
    return rows.select(*[fields[c].alias(c) for c in CSV_COLUMNS], *extra)


def require_usable(parsed: DataFrame) -> DataFrame:
    """All documents; the job fails at the first unusable one."""
    message = F.concat(
        F.lit("unusable payload of symbol "), F.coalesce("symbol", F.lit("?")),
        F.lit(": "), F.coalesce("reason", F.lit("")),
    )
    return require(parsed, F.col("reason").isNull(), message)


def split_payloads(
    parsed: DataFrame, counted: Observation | None = None
) -> tuple[DataFrame, DataFrame]:
    """(usable documents, rejects with symbol, file and reason).

    The judged documents are written once, usable and unusable ones apart, and read back:
    texts are read and parsed once for both. `counted` observes `rows` and those `rejected`.
    """
    rejected = F.col("reason").isNotNull()
    judged = parsed.drop("payload")
    if counted is not None:
        both = F.count(F.lit(1)).alias("rows"), F.count_if(rejected).alias("rejected")
        judged = judged.observe(counted, *both)
    judged = stored(judged.withColumn("rejected", rejected), "documents", "rejected")
    good = judged.filter(~F.col("rejected")).drop("rejected")
    return good, judged.filter("rejected").select("symbol", "file", "reason")
