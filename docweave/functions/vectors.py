"""Vector Column functions and the built-in hashed text encoder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_DIM = 64


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def fit_dimension(vec: Column | str, dim: int) -> Column:
    """Cut a longer vector to ``dim`` values, pad a shorter one with zeros."""
    v = _c(vec)
    pad = F.array_repeat(F.lit(0.0).cast("float"), F.greatest(F.lit(dim) - F.size(v), F.lit(0)))
    return F.concat(F.slice(v, 1, dim), pad)


def dot(a: Column | str, b: Column | str) -> Column:
    """Dot product in double precision (floats widened before multiplying)."""
    prods = F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def norm(a: Column | str) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column | str, b: Column | str) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


def euclidean(a: Column | str, b: Column | str) -> Column:
    sq = F.zip_with(_c(a), _c(b), lambda x, y: F.pow(x.cast("double") - y.cast("double"), 2))
    return F.sqrt(F.aggregate(sq, F.lit(0.0).cast("double"), lambda acc, x: acc + x))


def similarity(a, b, metric: str = "cosine") -> Column:
    if metric == "cosine":
        return cosine(a, b)
    if metric == "dot":
        return dot(a, b)
    if metric == "euclidean":
        return euclidean(a, b)
    raise ValueError(f"unknown metric {metric!r}")


# --- hashed encoder -------------------------------------------------------

def token_codes(tokens: Column | str, dim: int = DEFAULT_DIM, max_tokens: int | None = None) -> Column:
    """Signed bucket code per token, computed in the JVM: bucket is the first
    32 bits of md5(token) mod ``dim``; the sign comes from the ninth hex
    digit (< 8 positive). Code = +/-(bucket + 1). ``max_tokens``, where given,
    is a model's input window: only that many leading tokens are encoded."""
    t = _c(tokens)
    if max_tokens:
        t = F.slice(t, 1, max_tokens)

    def code(tok):
        h = F.md5(tok)
        bucket = F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") % dim
        sign = F.when(F.conv(F.substring(h, 9, 1), 16, 10).cast("int") < 8, 1).otherwise(-1)
        return ((bucket + 1) * sign).cast("int")

    return F.transform(t, code)


def _pool_codes(codes: pd.Series, dim: int) -> pd.Series:
    n = len(codes)
    mat = np.zeros((n, dim), dtype=np.float64)
    lens = codes.map(lambda a: 0 if a is None else len(a)).to_numpy()
    if lens.sum():
        flat = np.concatenate([np.asarray(a, dtype=np.int64) for a in codes if a is not None and len(a)])
        rows = np.repeat(np.arange(n), lens)
        np.add.at(mat, (rows, np.abs(flat) - 1), np.sign(flat).astype(np.float64))
    # mean pooling then L2 normalisation: the 1/n factor cancels, so the
    # result is counts / ||counts|| (exact, order independent).
    nrm = np.sqrt((mat * mat).sum(axis=1))
    safe = np.where(nrm > 0, nrm, 1.0)
    out = (mat / safe[:, None]).astype(np.float32)
    return pd.Series(list(out))


def hashed_embedding(codes: Column | str, dim: int = DEFAULT_DIM) -> Column:
    """Mean-pooled, L2-normalised signed one-hot vectors (Arrow batched)."""

    from docweave.session import ship_package
    ship_package()

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def _pool(s: pd.Series) -> pd.Series:
        return _pool_codes(s, dim)

    return _pool(_c(codes))


def embed_tokens(tokens: Column | str, dim: int = DEFAULT_DIM, max_tokens: int | None = None) -> Column:
    return hashed_embedding(token_codes(tokens, dim, max_tokens), dim)


def plugin_encoder(factory, dim: int):
    """Encoder plug-in: ``factory()`` returns ``encode(list[str]) -> array-like
    (n, dim)``. The model is built once per Python worker (iterator pandas
    UDF) and fed Arrow batches, never one text at a time."""
    from docweave.session import ship_package
    ship_package()

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def _encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = factory()
        for texts in batches:
            out = np.asarray(encode(texts.fillna("").tolist()), dtype=np.float32).reshape(len(texts), dim)
            yield pd.Series(list(out))

    return _encode


def encoder_name(dim: int = DEFAULT_DIM, max_tokens: int | None = None) -> str:
    """The built-in encoder's identity: vectors of equal names may be compared."""
    return f"hashed-md5-{dim}" + (f"-first{max_tokens}" if max_tokens else "")
