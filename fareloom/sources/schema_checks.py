"""Comparing a table with a declared schema, and making it conform."""

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType, TimestampNTZType, TimestampType

from fareloom.sources.footers import stored_schemas, survey

_REPORT = "field string, status string, expected string, actual string"


def _same_type(actual: DataType, expected: DataType, treat_ntz_as_timestamp: bool) -> bool:
    clock = (TimestampType, TimestampNTZType)
    if treat_ntz_as_timestamp and isinstance(actual, clock) and isinstance(expected, clock):
        return True
    return actual == expected


def validate_schema(
    df: DataFrame, expected: StructType, treat_ntz_as_timestamp: bool = False
) -> DataFrame:
    """One row per field of either side: field, status, expected, actual.

    ``status`` is ok, missing, extra or type_mismatch. Names are compared case-sensitively;
    order and nullability are not compared. Looks at the schema only and reads no data.
    """
    return df.sparkSession.createDataFrame(_compared(df.schema, expected, treat_ntz_as_timestamp), _REPORT)


def _compared(
    actual: StructType, expected: StructType, treat_ntz_as_timestamp: bool
) -> list[tuple[str, str, str | None, str | None]]:
    """(field, status, expected, actual) of every field of either side."""
    have = {f.name: f.dataType for f in actual}
    want = {f.name: f.dataType for f in expected}
    rows = []
    for name in [*want, *(n for n in have if n not in want)]:
        if name not in have:
            status = "missing"
        elif name not in want:
            status = "extra"
        elif _same_type(have[name], want[name], treat_ntz_as_timestamp):
            status = "ok"
        else:
            status = "type_mismatch"
        rows.append(
            (
                name,
                status,
                want[name].simpleString() if name in want else None,
                have[name].simpleString() if name in have else None,
            )
        )
    return rows


def validate_deliveries(
    spark: SparkSession, paths: Iterable[str], expected: StructType, treat_ntz_as_timestamp: bool = False
) -> DataFrame:
    """Which delivered file departs from the declared schema, and where: file, field, status, expected, actual.

    One row per file and field, as ``validate_schema`` reports them. One job reads the footers
    of all files, and the schema is inferred once for each distinct set of stored columns.
    """
    found = survey(spark, paths)
    rows = [
        (stored, *row)
        for stored, schema in stored_schemas(spark, found).items()
        for row in _compared(schema, expected, treat_ntz_as_timestamp)
    ]
    report = spark.createDataFrame(rows, f"stored string, {_REPORT}")
    return found.join(report, "stored").select("file", "field", "status", "expected", "actual")


def is_valid(df: DataFrame, expected: StructType, treat_ntz_as_timestamp: bool = False) -> bool:
    """Whether every declared field is present with its type and nothing else is."""
    have = {f.name: f.dataType for f in df.schema}
    want = {f.name: f.dataType for f in expected}
    return have.keys() == want.keys() and all(
        _same_type(have[name], want[name], treat_ntz_as_timestamp) for name in want
    )


def conform(df: DataFrame, expected: StructType, require_all: bool = True) -> DataFrame:
    """``df`` with exactly the declared columns, types and order.

    Undeclared columns are dropped. A declared column that is absent raises, or becomes
    a typed NULL with ``require_all=False``.
    """
    absent = [f.name for f in expected if f.name not in df.columns]
    if absent and require_all:
        raise ValueError(f"columns missing from the input: {', '.join(absent)}")
    return df.select(
        *(
            (F.lit(None) if f.name in absent else F.col(f"`{f.name}`")).cast(f.dataType).alias(f.name)
            for f in expected
        )
    )
