"""Raw CSV scans with every column as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import BENEFICIARY_FILE, CLAIM_FILES
from ..session import path_exists


#: Column with the text of a broken line.
CORRUPT = "_corrupt_record"


def _header(spark: SparkSession, path: str) -> list[str]:
    first = spark.read.option("header", False).csv(path).limit(1).collect()
    return [c for c in first[0]] if first else []


def read_text_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """CSV with a header row, all columns StringType (no inference pass). A part
    file whose header has other names or another order fails the read: its cells
    would land in the wrong columns. A line with too few or too many cells (an
    open quote swallows the rest of its line; two quotes inside quotes are one) keeps its text in ``CORRUPT``,
    which is null for whole lines."""
    from ..schemas import all_string_schema
    cols = columns or _header(spark, path)
    raw = (spark.read.schema(all_string_schema([*cols, "_broken"])).option("header", True).option("columnNameOfCorruptRecord", "_broken")
           .option("enforceSchema", False).option("mode", "PERMISSIVE").option("escape", '"')
           .option("columnPruning", False).csv(path))  # a parser of some columns doesn't see missing cells
    # Spark reads the text of a broken line only beside another column
    return raw.select(*cols, F.when(F.length(F.concat_ws("", cols[0])) >= 0, F.col("_broken")).alias(CORRUPT))


def read_beneficiaries(spark: SparkSession, cms_dir: str) -> DataFrame:
    """The beneficiary file is required."""
    path = f"{cms_dir.rstrip('/')}/{BENEFICIARY_FILE}"
    if not path_exists(spark, path):
        raise FileNotFoundError(f"Beneficiary file not found: {path}")
    return read_text_csv(spark, path)


def whole_lines(raw: DataFrame) -> DataFrame:
    """The rows of lines that had a cell for each column."""
    return raw.where(F.col(CORRUPT).isNull()).drop(CORRUPT) if CORRUPT in raw.columns else raw


def broken_lines(raw: DataFrame) -> DataFrame:
    """(line) of the others, for the reject output."""
    if CORRUPT not in raw.columns:
        return raw.sparkSession.createDataFrame([], "line string")
    return raw.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("line"))


def read_claim_files(spark: SparkSession, cms_dir: str) -> dict[str, DataFrame]:
    """One DataFrame per claim type; an absent file is skipped."""
    out = {}
    for ctype, (fname, _) in CLAIM_FILES.items():
        path = f"{cms_dir.rstrip('/')}/{fname}"
        if path_exists(spark, path):
            out[ctype] = read_text_csv(spark, path)
    return out


def write_text_csv(df: DataFrame, path: str) -> None:
    """Write an all-text frame as a CSV folder with a header (test fixtures,
    round trips)."""
    df.select([F.col(c).cast("string") for c in df.columns]).write.mode("overwrite") \
      .option("header", True).option("escape", '"').option("compression", "gzip").csv(path)


def write_raw_lines(df: DataFrame, line: Column, path: str) -> None:
    """Write ``line`` as it is, below the header of ``df``'s columns in each file
    (lines that no CSV writer would make)."""
    df.select(line.alias(",".join(df.columns))).write.mode("overwrite").option("header", True).option("sep", "\u0001") \
      .option("quote", "\u0000").option("escapeQuotes", False).option("emptyValue", "").csv(path)
