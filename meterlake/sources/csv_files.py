"""CSV scans into all-text frames, with lineage."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from meterlake.functions.text import safe_names

SOURCE_FILE = "_source_file"
INGESTED_AT = "_ingested_at"
MALFORMED = "_malformed_row"


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None, **options) -> DataFrame:
    """Rows of one file or of every file a glob matches, one task per split.

    Without a schema the columns are named by the header and are text. Types are never inferred:
    that would read all files once more and make the types depend on the data. Headers are checked
    against the schema file by file, so a file of another shape fails instead of being misread.
    A row with too few or too many fields keeps what it has, and its whole text in ``_malformed_row``,
    which is null in all others.
    """
    settings = {
        "header": True, "mode": "PERMISSIVE", "enforceSchema": False, "columnNameOfCorruptRecord": MALFORMED, **options,
    }
    reader = spark.read.options(**settings)
    if schema is None:
        schema = reader.csv(path).schema
    whole_row = [StructField(settings["columnNameOfCorruptRecord"], StringType())] if settings["mode"] == "PERMISSIVE" else []
    return reader.schema(StructType(schema.fields + whole_row)).csv(path)


def read_csv_if_present(
    spark: SparkSession, path: str, schema: StructType | None = None, **options
) -> DataFrame | None:
    """As ``read_csv``, or None when no file is there."""
    try:
        return read_csv(spark, path, schema, **options)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def with_lineage(scan: DataFrame) -> DataFrame:
    """A file scan with the file and the time of ingest, under names any table format accepts."""
    stamped = scan.select(
        "*",
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.current_timestamp().alias(INGESTED_AT),
    )
    return stamped.toDF(*safe_names(stamped.columns))
