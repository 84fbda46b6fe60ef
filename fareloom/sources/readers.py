"""Readers. Paths and globs go to Spark, so any filesystem Spark can list will do."""

from collections.abc import Iterable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from fareloom.sources.footers import opened_by_arrow, qualified, stored_schemas, survey
from fareloom.sources.schema_checks import conform
from fareloom.sources.sinks import drop_staged


def list_files(spark: SparkSession, data_dir: str, pattern: str) -> DataFrame:
    """Files under ``data_dir`` whose path matches ``pattern``: path, length, modificationTime.

    File contents are not read: the ``content`` column is pruned from the scan.
    """
    return (
        spark.read.format("binaryFile")
        .load(f"{data_dir.rstrip('/')}/{pattern}")
        .select("path", "length", "modificationTime")
        .orderBy("path")
    )


def get_file_paths(spark: SparkSession, data_dir: str, pattern: str) -> list[str]:
    """Sorted file paths matching ``pattern``; an empty list if there are none."""
    try:
        files = spark.read.format("binaryFile").load(f"{data_dir.rstrip('/')}/{pattern}").inputFiles()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    return sorted(files)


def read_parquet(
    spark: SparkSession, paths: str | Iterable[str], schema: StructType | None = None
) -> DataFrame:
    """One scan over any number of files, folders or globs.

    With ``schema`` no footer is read up front and narrower stored types (an int
    column declared long, say) are widened by the scan itself.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*([paths] if isinstance(paths, str) else paths))


def load_from_parquet(spark: SparkSession, input_path: str) -> DataFrame:
    """A stored dataset, lazily. Callers who want its size call ``count()``."""
    return read_parquet(spark, input_path)


def _with_file(scan: DataFrame, source_file: str | None) -> DataFrame:
    """A scan of files, with the path of each row's file if a column is named for it."""
    return scan.withColumn(source_file, F.col("_metadata.file_path")) if source_file else scan


def read_merged(spark: SparkSession, path: str, source_file: str | None = None) -> DataFrame | None:
    """A scan with the columns of all files, from their footers read in one distributed job.

    ``source_file`` names a column for the file each row comes from. None if nothing matches ``path``; files that store a column in different types are an error.
    """
    try:
        return _with_file(spark.read.option("mergeSchema", True).parquet(path), source_file)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _shared_footers(spark: SparkSession, paths: list[str]) -> list[tuple[StructType, list[str]]]:
    """The paths in groups whose footers merge, each with its merged schema.

    For paths whose footers a survey cannot open. All footers are merged in one distributed job;
    only where types conflict is the list halved.
    """
    try:
        return [(spark.read.option("mergeSchema", True).parquet(*paths).schema, paths)]
    except (PySparkException, Py4JJavaError) as error:
        if len(paths) == 1 or "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
    half = len(paths) // 2
    return _agreeing([*_shared_footers(spark, paths[:half]), *_shared_footers(spark, paths[half:])])


def _agreeing(found: Iterable[tuple[StructType, list[str]]]) -> list[tuple[StructType, list[str]]]:
    """Schemas with their paths, put together where they agree in the types of their columns."""
    groups: list[tuple[StructType, list[str]]] = []
    for schema, paths in found:
        for k, (other, members) in enumerate(groups):
            types = {f.name: f.dataType for f in other}
            if all(types.get(f.name, f.dataType) == f.dataType for f in schema):
                more = [f for f in schema if f.name not in types]
                groups[k] = (StructType([*other, *more]), [*members, *paths])
                break
        else:
            groups.append((schema, paths))
    return groups


def _surveyed(spark: SparkSession, paths: list[str]) -> list[tuple[StructType, list[str]]]:
    """The deliveries in groups that one scan can read, each with its schema, from a survey of their footers."""
    found = survey(spark, paths)
    schemas = stored_schemas(spark, found)
    kinds = found.groupBy("delivery").agg(F.array_sort(F.collect_set("stored")).alias("kinds"))
    together = kinds.groupBy("kinds").agg(F.array_sort(F.collect_list("delivery")).alias("deliveries")).collect()
    drop_staged(found)
    out = []
    for r in sorted(together, key=lambda r: r.deliveries[0]):
        # Files of one delivery are read by one scan, so they have to agree.
        own = _agreeing((schemas[k], [k]) for k in r.kinds)
        if len(own) > 1:
            raise ValueError(f"files of one delivery store a column in different types: {r.deliveries[0]}")
        out.append((own[0][0], r.deliveries))
    return _agreeing(out)


def read_deliveries(
    spark: SparkSession, paths: Iterable[str], schema: StructType, source_file: str | None = None
) -> DataFrame:
    """Scan deliveries whose stored types drifted, as one table of the declared ``schema``.

    Each path is one delivery (a month, say). One job surveys the footers of all, whatever
    their number and order. Deliveries that agree in the types of their columns are read by one scan; each scan is cast to ``schema``,
    absent columns become NULL and undeclared ones are dropped. ``source_file`` names a
    column for the file each row comes from.
    """
    paths = sorted(paths)
    if source_file:
        schema = StructType([*schema, StructField(source_file, StringType())])
    if not paths:
        return spark.createDataFrame([], schema)
    by_survey = all(opened_by_arrow(p) for p in (qualified(spark, p) for p in paths))
    groups = _surveyed(spark, paths) if by_survey else _shared_footers(spark, paths)
    scans = [
        conform(_with_file(spark.read.schema(stored).parquet(*group), source_file), schema, require_all=False)
        for stored, group in groups
    ]
    return reduce(DataFrame.unionByName, scans)


def read_lookup_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header line whose names must agree with the declared schema."""
    return (
        spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
    )


def read_text_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(paths)


def file_row_counts(df: DataFrame) -> DataFrame:
    """Rows read from each file of a file scan: file_path, n_rows."""
    return df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
