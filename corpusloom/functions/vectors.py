"""Vectors in ``array`` columns as expressions (double arithmetic)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(doubles(a), doubles(b), lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """0 where a vector has no length."""
    size = norm(a) * norm(b)
    return F.when(size == 0, 0.0).otherwise(dot(a, b) / size)


def _scaled(v: Column, factor: Column) -> Column:
    """``factor`` times ``v``; the factor stands in an array, as inside a lambda it would be computed anew for every element."""
    return F.zip_with(v, F.array_repeat(factor, F.size(v)), lambda x, y: x * y)


def unit(a: Column) -> Column:
    """Unit length; a vector without length stays as it is."""
    v = doubles(a)
    return F.zip_with(v, F.array_repeat(norm(a), F.size(v)), lambda x, y: F.when(y == 0, x).otherwise(x / y))


def blend(base: Column, extra: Column, weight: float) -> Column:
    """``(1 - weight) * base + weight * extra`` at unit length; without extra the base stays."""
    mixed = F.zip_with(doubles(base), doubles(extra), lambda x, y: (1 - weight) * x + weight * y)
    return F.when(extra.isNull(), doubles(base)).otherwise(unit(mixed))


def project_out(v: Column, basis: list[list[float]], rescale: bool = False) -> Column:
    """``v`` without its components along the orthonormal rows of ``basis``."""
    out = doubles(v)
    for row in basis:
        axis = F.array(*[F.lit(float(x)) for x in row])
        out = _less(out, axis, dot(v, axis))
    return unit(out) if rescale else out


def _less(v: Column, axis: Column, along: Column) -> Column:
    return F.zip_with(v, _scaled(axis, along), lambda x, y: x - y)


def otsu(rows: DataFrame, value: str, weight: str, low: float, high: float, bins: int = 256) -> float:
    """The threshold between two classes of ``value`` with the largest variance between
    them: the middle of one of ``bins`` equal bins from ``low`` to ``high``.

    The histogram is one aggregate; only its bins reach the cumulative window and the driver."""
    if low is None or high <= low:
        return low if low is not None else 0.0
    bin_ = F.least(F.floor((F.col(value) - low) / (high - low) * bins), F.lit(bins - 1)).cast("int")
    hist = rows.groupBy(bin_.alias("bin")).agg(F.sum(F.col(weight).cast("double")).alias("m"))
    mid = low + (F.col("bin") + 0.5) * (high - low) / bins
    order = Window.orderBy("bin")
    p = hist.withColumn("mid", mid).withColumn("p", F.col("m") / F.sum("m").over(Window.partitionBy()))
    c = p.select("bin", "mid", F.sum("p").over(order).alias("c"), F.sum(F.col("p") * F.col("mid")).over(order).alias("mu"), F.sum(F.col("p") * F.col("mid")).over(Window.partitionBy()).alias("total"))
    between = F.round((F.col("total") * F.col("c") - F.col("mu")) * (F.col("total") * F.col("c") - F.col("mu")) / (F.col("c") * (1 - F.col("c"))), 9)
    best = c.filter(F.col("c") < 1 - 1e-12).agg(F.max_by("mid", F.struct(between, -F.col("bin")))).first()[0]
    return best if best is not None else low


def group_mean(rows: DataFrame, group: str, vector: str) -> DataFrame:
    """``(group, mean)``: mean vectors by dimension, aggregated on the map side; null vectors are left out."""
    flat = rows.filter(F.col(vector).isNotNull()).select(group, F.posexplode(doubles(F.col(vector))).alias("_i", "_x"))
    means = flat.groupBy(group, "_i").agg(F.avg("_x").alias("_x"))
    return means.groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_x"))), lambda p: p["_x"]).alias("mean"))


def leading_directions(rows: DataFrame, vector: str, k: int) -> list[list[float]]:
    """The ``k`` leading right singular vectors of the uncentred matrix of all vectors.

    Every task adds up its part of the Gram matrix (dimension by dimension, so its
    size is that of the vectors, not of the rows); the parts are summed and its
    eigenvectors taken on the driver.  Signs are fixed so that the largest entry is
    positive.  Null vectors are left out; without any the result is empty."""
    import numpy as np
    import pandas as pd

    def parts(batches):
        total = None
        for batch in batches:
            x = np.array(batch["_v"].tolist(), float)
            if len(x):
                total = x.T @ x if total is None else total + x.T @ x
        if total is not None:
            yield pd.DataFrame({"i": range(len(total)), "row": list(total)})

    made = rows.filter(F.col(vector).isNotNull()).select(doubles(F.col(vector)).alias("_v")).mapInPandas(parts, "i int, row array<double>")
    summed = made.select("i", F.posexplode("row").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x")).collect()  # dimension squared
    if not summed:
        return []
    size = max(r.i for r in summed) + 1
    gram = np.zeros((size, size))
    for r in summed:
        gram[r.i, r.j] = r.x
    _, directions = np.linalg.eigh(gram)
    top = directions[:, ::-1][:, :k].T
    return [list(map(float, v * np.sign(v[np.argmax(np.abs(v))]))) for v in top]
