"""DataFrame-level vector operators: centroids (mean pooling) and signatures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mean_vectors(df: DataFrame, group_cols: list[str], vec_col: str, out_col: str = "centroid") -> DataFrame:
    """Element-wise mean of the vectors of each group (mean pooling).

    posexplode + avg per (group, position) aggregates map-side first, so the
    shuffle carries at most groups x dim partial sums per partition; the
    second step regroups dim rows per group into an ordered array.
    """
    long = (df.select(*group_cols, F.posexplode(vec_col).alias("pos", "x"))
            .groupBy(*group_cols, "pos").agg(F.avg(F.col("x").cast("double")).alias("m")))
    return (long.groupBy(*group_cols)
            .agg(F.array_sort(F.collect_list(F.struct("pos", "m"))).alias("_s"))
            .select(*group_cols, F.transform("_s", lambda s: s["m"]).alias(out_col)))


def signature(vec_col: str):
    """(nnz, l1, weighted sum) of a vector, rounded: compact equality check."""
    v = F.col(vec_col)
    nnz = F.size(F.filter(v, lambda x: x != 0)).cast("bigint")
    l1 = F.round(F.aggregate(v, F.lit(0.0), lambda a, x: a + F.abs(x.cast("double"))), 6)
    ws = F.round(F.aggregate(F.transform(v, lambda x, i: (i + 1) * x.cast("double")),
                             F.lit(0.0), lambda a, x: a + x), 6)
    return nnz.alias("nnz"), l1.alias("l1"), ws.alias("wsum")
