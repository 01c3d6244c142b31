"""Vector scalars on arrays, in double precision."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.text import col, let


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(col(a).cast("array<double>"), col(b).cast("array<double>"), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def l2_normalize(a, floor: float = 1e-12) -> Column:
    """The unit vector; a zero vector stays zero."""
    return let(F.greatest(norm(a), F.lit(floor)), lambda n: F.transform(col(a).cast("array<double>"), lambda x: x / n))


def usable(v) -> Column:
    """Whether a vector is there, not empty, and all its components are finite numbers."""
    e = col(v).cast("array<double>")
    return F.coalesce((F.size(e) > 0) & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def cosine(a, b) -> Column:
    return dot(l2_normalize(a), l2_normalize(b))


def hashed_embedding(text, dim: int = 64) -> Column:
    """The default encoder: token counts hashed to `dim` places (first hex digits of SHA-256), made a unit vector."""
    known: dict[str, int] = {}

    def place(token: str) -> int:
        if token not in known:
            if len(known) > 200_000:
                known.clear()
            known[token] = int(hashlib.sha256(token.encode()).hexdigest()[:7], 16) % dim
        return known[token]

    def encode(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            v = np.bincount([place(w) for w in re.findall("[a-z0-9]+", (t or "").lower())] or [0], minlength=dim).astype(float)
            if not t or not re.search("[a-z0-9]", t.lower()):
                v[:] = 0
            out.append(v / max(np.sqrt(v @ v), 1e-12))
        return pd.Series(out)

    return F.pandas_udf(encode, "array<double>")(col(text))


def last_logit(logits) -> Column:
    """A cross-encoder's score from one or two logits: the last."""
    return F.try_element_at(col(logits), F.lit(-1))
