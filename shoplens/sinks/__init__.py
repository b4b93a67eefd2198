"""K1–K2: CSV export and the labelled result store (Parquet)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .store import CommitConflict, remove_old_versions, result_path, versions, write_results

__all__ = ["CommitConflict", "remove_old_versions", "result_path", "versions", "write_csv", "write_results"]


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """K1: overwrite a CSV folder with a header. ``single_file`` funnels the
    result through one task — only for small, final tables."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)
