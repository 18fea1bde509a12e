"""Text rows -> typed staging rows.

All casts are the try_ kind, so that the outcome does not hang on the session's ANSI flag.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from starload import schemas
from starload.operators.merge import duplicate_keys
from starload.schemas import CSV_COLUMNS, CSV_TO_STAGING, STAGING, VERSION, names
from starload.session import observed, stored

_SOURCE = {to: name for name, to in CSV_TO_STAGING.items()}


def _typed(column: schemas.Column) -> Column:
    text = F.col(_SOURCE[column.name])
    if column.type == "date":
        return F.try_to_date(text, "yyyy-MM-dd")
    return text if column.max_length else text.try_cast(column.type)


def _unreadable(column: schemas.Column) -> str:
    return f"{column.name} is not a {column.type}"


def _text_problems(column: schemas.Column) -> list[tuple[Column, str]]:
    """What can be wrong with a text column."""
    text = F.col(_SOURCE[column.name])
    too_long = f"{column.name} is longer than {column.max_length}"
    problems = [(F.length(text) > column.max_length, too_long)]
    if column.required:
        problems.insert(0, (text.isNull(), f"{column.name} is missing"))
    return problems


def bad_reason() -> Column:
    """The first thing that keeps a text row out of the staging table, or NULL."""
    reasons = []
    for column in STAGING:
        if column.max_length:
            reasons += [F.when(bad, reason) for bad, reason in _text_problems(column)]
        else:
            text = F.col(_SOURCE[column.name])
            reasons.append(F.when(text.isNotNull() & _typed(column).isNull(), _unreadable(column)))
    return F.coalesce(*reasons)


def _fail(reason: str) -> Column:
    return F.raise_error(
        F.concat(
            F.lit("bad price row of symbol "), F.coalesce("symbol", F.lit("NULL")),
            F.lit(" on "), F.coalesce("timestamp", F.lit("NULL")),
            F.lit(f": {reason}"),
        )
    )


def _strict(column: schemas.Column) -> Column:
    """The typed value; evaluating it fails where the text does not fit.

    Built so that a good value is cast once: a filter on the whole row would have to cast
    every column for the check and again for the result.
    """
    text = F.col(_SOURCE[column.name])
    if not column.max_length:
        return F.coalesce(_typed(column), F.when(text.isNotNull(), _fail(_unreadable(column))))
    value = text
    for bad, reason in reversed(_text_problems(column)):
        value = F.when(bad, _fail(reason)).otherwise(value)
    return value


def _version_of(raw: DataFrame) -> list[str]:
    return [name for name in names(VERSION) if name in raw.columns]


def to_staging(raw: DataFrame, versioned: bool = False) -> DataFrame:
    """Typed rows; writing them fails at the first row that does not fit its types. If they are
    to be `versioned`, when they landed comes along as far as they say so."""
    typed = [_strict(column).alias(column.name) for column in STAGING]
    return raw.select(*typed, *(_version_of(raw) if versioned else ()))


def quarantine(
    raw: DataFrame, read: Observation | None = None, versioned: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(typed good rows, bad rows as the text they came as, with the reason).

    Beyond what cannot be stored, a row is bad that would fail the loads that follow: one
    without a day, and every one of several rows with the same day and symbol. Rows that
    come with a `reason` are bad for that one.

    The judged rows are written once, and read back for the good and the bad ones; `read`
    observes how many `rows` there are. Good rows can be `versioned` as in to_staging.
    """
    known = F.col("reason") if "reason" in raw.columns else F.lit(None).cast("string")
    missing = F.when(F.col("timestamp").isNull(), "date is missing")
    reason = F.coalesce(known, bad_reason(), missing)
    typed = [_typed(column).alias(column.name) for column in STAGING]
    whole = F.struct(*typed, *(_version_of(raw) if versioned else ()))
    judged = raw.select(*CSV_COLUMNS, reason.alias("reason"), whole.alias("typed"))
    judged = stored(observed(judged, read), "judged_rows")
    good = judged.filter(F.col("reason").isNull())
    keys = ["timestamp", "symbol"]
    repeated = duplicate_keys(good, keys).select(*keys)
    again = good.join(repeated, keys, "left_semi").withColumn("reason", F.lit("repeated key"))
    bad = judged.filter(F.col("reason").isNotNull()).unionByName(again)
    return (
        good.join(repeated, keys, "left_anti").select("typed.*"),
        bad.select(*CSV_COLUMNS, "reason"),
    )
