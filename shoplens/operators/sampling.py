"""M1–M2: sampling and splitting that depend only on each row's key.

``sampleBy`` and ``randomSplit`` draw per row in partition order, so the
same seed keeps different rows after a repartition. Here a row is kept or
assigned by the md5 of its key and a salt: the same key always lands on the
same side, on any cluster layout, and the DuckDB oracle can reproduce it.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import hash_threshold, key_hash
from ..settings import DEFAULT


def stratified_sample(
    df: DataFrame,
    label: str,
    fractions: Mapping[int, float],
    key: str,
    seed: int = DEFAULT.seed,
) -> DataFrame:
    """Keep about ``fractions[v]`` of the rows whose label is v; labels not
    listed are dropped (as ``sampleBy`` does)."""
    h = key_hash(key, f"sample-{seed}")
    keep = F.lit(False)
    for value, frac in fractions.items():
        keep = keep | ((F.col(label) == value) & (h < F.lit(hash_threshold(frac))))
    return df.filter(keep)


def with_split(df: DataFrame, key: str, train_fraction: float = DEFAULT.train_fraction,
               seed: int = DEFAULT.seed, col: str = "split") -> DataFrame:
    """Label each row ``train`` or ``test`` by its key."""
    h = key_hash(key, f"split-{seed}")
    return df.withColumn(col, F.when(h < F.lit(hash_threshold(train_fraction)), "train").otherwise("test"))


def split_train_test(df: DataFrame, key: str, train_fraction: float = DEFAULT.train_fraction,
                     seed: int = DEFAULT.seed) -> tuple[DataFrame, DataFrame]:
    """M2: (train, test) as two filters of one labelled frame."""
    labelled = with_split(df, key, train_fraction, seed, "__split")
    return (
        labelled.filter(F.col("__split") == "train").drop("__split"),
        labelled.filter(F.col("__split") == "test").drop("__split"),
    )
