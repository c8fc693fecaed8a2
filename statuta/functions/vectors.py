"""Column functions on vectors kept as arrays of floats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from statuta.functions.text import let

#: What a zero vector gets as its first component.
TINY = 1e-6


def squared_distance(a: Column, b: Column) -> Column:
    """Squared Euclidean distance, in double precision."""
    parts = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.aggregate(parts, F.lit(0.0), lambda s, x: s + x)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of the angle; null where a vector is zero."""
    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))


def sanitize(vector: Column) -> Column:
    """NaN and infinities as 0; a zero vector gets a tiny first component."""
    finite = F.transform(
        vector,
        lambda x: F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), F.lit(0.0)).otherwise(x.cast("double")).cast("float"),
    )
    zero = ~F.exists(finite, lambda x: x != 0)
    return F.when(
        zero & (F.size(finite) > 0),
        F.transform(finite, lambda x, k: F.when(k == 0, F.lit(TINY)).otherwise(x.cast("double")).cast("float")),
    ).otherwise(finite)


def hash_embedding(text: Column) -> Column:
    """Eight floats from a text's SHA-256, of unit length.

    Each four bytes, read as an unsigned number, are scaled to [-1, 1]; all
    steps are rounded to single precision.
    """
    digest = F.sha2(F.coalesce(text, F.lit("")), 256)
    words = let(digest, lambda d: F.array(*(F.conv(F.substring(d, 1 + 8 * k, 8), 16, 10).cast("double").cast("float") for k in range(8))))
    scaled = F.transform(words, lambda w: (w.cast("double") / F.lit(4294967295.0).cast("float").cast("double")).cast("float"))
    centred = F.transform(scaled, lambda x: (F.lit(2.0) * x.cast("double")).cast("float"))
    centred = F.transform(centred, lambda x: (x.cast("double") - F.lit(1.0)).cast("float"))
    norm = lambda c: F.sqrt(dot(c, c)).cast("float").cast("double")
    return let(centred, lambda c: let(norm(c), lambda n: F.transform(c, lambda x: (x.cast("double") / n).cast("float"))))


def hash_embedding_batch(text: Column) -> Column:
    """``hash_embedding`` in Arrow batches, for whole tables.

    The composition of built-in functions is inlined by the optimizer wherever
    the vector is used, and then computed again for each use; this is not.
    """

    @F.pandas_udf("array<float>")
    def run(texts):  # noqa: ANN001
        import hashlib

        import numpy as np
        import pandas as pd

        raw = b"".join(hashlib.sha256((t or "").encode("utf-8")).digest() for t in texts)
        words = np.frombuffer(raw, dtype=">u4").reshape(-1, 8).astype(np.float32)
        centred = np.float32(2.0) * (words / np.float32(4294967295.0)) - np.float32(1.0)
        norm = np.sqrt((centred.astype(float) ** 2).sum(axis=1)).astype(np.float32)
        norm[norm == 0] = 1.0
        return pd.Series(list((centred.astype(float) / norm.astype(float)[:, None]).astype(np.float32)))

    run.__annotations__ = {}
    return run(text)
