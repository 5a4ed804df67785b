"""Raw tables in, with explicit schemas and one notion of missing."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from cohortkit.constants import LABEL, MISSING_SPELLINGS, MISSING_TEXT, STAY
from cohortkit.functions.names import col
from cohortkit.functions.numeric import null_for_nan

SCHEMAS = {
    "patient": "patientunitstayid LONG, uniquepid STRING, age STRING, gender STRING,"
    " ethnicity STRING, hospitalid LONG, admissionheight DOUBLE, admissionweight DOUBLE,"
    " hospitaldischargestatus STRING, unitadmitoffset DOUBLE, unitdischargestatus STRING,"
    " hospitaldischargelocation STRING, unitdischargelocation STRING",
    "diagnosis": "patientunitstayid LONG, icd9code STRING, diagnosisstring STRING",
    "vitalPeriodic": "patientunitstayid LONG, observationoffset DOUBLE, heartrate DOUBLE,"
    " map DOUBLE, spo2 DOUBLE, temperature DOUBLE, respiration DOUBLE,"
    " systemicsystolic DOUBLE, systemicdiastolic DOUBLE, systemicmean DOUBLE, sao2 DOUBLE",
    "lab": "patientunitstayid LONG, labname STRING, labresult DOUBLE, labresultoffset DOUBLE",
}


def require_columns(df: DataFrame, columns: Iterable[str]) -> None:
    """Raise when a column is absent."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def normalize_missing(df: DataFrame, spellings: Sequence[str] = MISSING_SPELLINGS) -> DataFrame:
    """Turn NaN and the usual spellings of missing into NULL, in one projection."""

    def clean(field: T.StructField):
        c = col(field.name)
        if isinstance(field.dataType, T.StringType):
            c = F.when(~c.isin(list(spellings)), c) if spellings else c
        else:
            c = null_for_nan(c, field.dataType)
        return c.alias(field.name)

    return df.select(*[clean(f) for f in df.schema.fields])


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL; text is left as it is."""
    return normalize_missing(df, ())


def _with_types(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Give text columns the types the schema names; other columns pass through.

    A column the schema does not know becomes DOUBLE when every value that is
    present reads as a number, as type inference on the whole file would do.
    """
    known = {f.name: f.dataType for f in schema.fields}
    unknown = [c for c in df.columns if c not in known]
    numeric: set[str] = set()
    if unknown:
        bad = df.agg(*[
            F.count_if(col(c).isNotNull() & col(c).try_cast("double").isNull()).alias(c)
            for c in unknown
        ]).first()
        numeric = {c for c in unknown if bad[c] == 0}
    picked = []
    for c in df.columns:
        target = known.get(c, T.DoubleType() if c in numeric else T.StringType())
        value = col(c)
        if isinstance(target, T.StringType):
            picked.append(value.alias(c))
        elif isinstance(target, (T.IntegerType, T.LongType)):
            # "12.0" is a whole number too when the file was written with gaps.
            number = value.cast("double")
            fraction = F.raise_error(F.concat(F.lit(f"column '{c}' holds a fraction: "), value))
            whole = F.when(number == F.floor(number), number.cast(target)).when(number.isNotNull(), fraction.cast(target))
            picked.append(F.coalesce(value.try_cast(target), whole).alias(c))
        else:
            picked.append(value.cast(target).alias(c))
    return df.select(*picked)


def read_table(
    spark: SparkSession, path: str, schema: str | None = None, fmt: str | None = None, multi_line: bool = False
) -> DataFrame:
    """Read CSV or Parquet. CSV columns are matched by header name, not place.

    ``multi_line`` reads texts with quoted line breaks; such a file is one task.
    """
    fmt = fmt or ("csv" if path.rstrip("/").endswith((".csv", ".csv.gz")) else "parquet")
    if fmt == "csv":
        text = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line).csv(path)
        known = T.StructType.fromDDL(schema) if schema else T.StructType([])
        return _with_types(normalize_missing(text), known)
    return nan_to_null(spark.read.format(fmt).load(path))  # spellings are a matter of text files


def read_raw(spark: SparkSession, folder: str, fmt: str = "csv", multi_line: bool = False) -> dict[str, DataFrame]:
    """The four raw tables, lazily. Of a column that SCHEMAS names no type has to be guessed."""
    folder = folder.rstrip("/")
    return {
        name: read_table(spark, f"{folder}/{name}.{fmt}", schema, fmt, multi_line)
        for name, schema in SCHEMAS.items()
    }


def read_cleaned(spark: SparkSession, path: str, fmt: str | None = None, features: str = "") -> DataFrame:
    """The cleaned table with ``patient_id`` and a text ``site_id`` added.

    ``features`` names the types of further columns ("heartrate_mean DOUBLE, ..."). Types of
    text columns that neither names are found by one more scan.
    """
    schema = f"{STAY} LONG, age STRING, gender STRING, ethnicity STRING, site_id STRING, {LABEL} INT" + (f", {features}" if features else "")
    return with_identifiers(read_table(spark, path, schema, fmt))


def with_identifiers(df: DataFrame) -> DataFrame:
    """Add ``patient_id``; make ``site_id`` text, from the stay when absent."""
    require_columns(df, [STAY, LABEL])
    if "site_id" in df.columns:
        site = F.coalesce(F.col("site_id").cast("string"), F.lit(MISSING_TEXT))
    else:
        site = F.pmod(F.col(STAY).cast("long"), F.lit(10)).cast("string")
    return df.withColumns({"patient_id": F.col(STAY).cast("string"), "site_id": site})


def read_or_report(spark: SparkSession, path: str, fmt: str | None = None) -> tuple[DataFrame | None, str | None]:
    """The table and no message, or no table and the reason it cannot be read."""
    try:
        return read_table(spark, path, None, fmt), None
    except AnalysisException as error:
        return None, error.getCondition() or str(error)
