"""File writers. All replace what is at the path unless told otherwise."""

from __future__ import annotations

from pyspark.sql import DataFrame

NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def write_csv(
    df: DataFrame,
    path: str,
    sep: str = ",",
    mode: str = "overwrite",
    date_format: str = "yyyy-MM-dd",
) -> None:
    """CSV with a header row; ``sep="\\t"`` gives TSV."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("sep", sep)
        .option("dateFormat", date_format)
        .option("timestampNTZFormat", NTZ_FORMAT)
        .csv(path)
    )


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("timestampNTZFormat", NTZ_FORMAT).json(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)
