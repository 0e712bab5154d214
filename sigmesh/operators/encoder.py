"""A text encoder behind ``predict_batch_udf``.

Any model can take its place: ``encoded`` asks only for a function that makes
the predict function, which Spark calls once in each Python worker and feeds
with batches of texts. The one given here needs no weights from outside: hashed
character n-grams, a fixed projection of signs, unit length.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

BATCH = 64
DIM = 64
GRAM = 4
SLOTS = 1 << 14


def ngram_encoder(dim: int = DIM, gram: int = GRAM, slots: int = SLOTS, seed: int = 42) -> Callable:
    """Makes a predict function: texts to unit vectors; an empty text is the zero vector."""
    def make():
        signs = np.random.default_rng(seed).choice(np.array([-1.0, 1.0]), size=(slots, dim))

        def one(text: str) -> np.ndarray:
            data = text.lower().encode("utf-8")
            if not data:
                return np.zeros(dim, dtype=np.float32)
            raw = np.frombuffer(data, dtype=np.uint8).astype(np.uint64)
            if len(raw) <= gram:
                at = np.array([zlib.crc32(data) % slots])
            else:
                code = np.zeros(len(raw) - gram + 1, dtype=np.uint64)
                for k in range(gram):
                    code = code * np.uint64(0x9E3779B97F4A7C15) + raw[k:len(raw) - gram + 1 + k]
                at = ((code * np.uint64(0xFF51AFD7ED558CCD)) >> np.uint64(50)).astype(np.int64) % slots
            count = np.bincount(at, minlength=slots)
            used = np.flatnonzero(count)
            v = (1.0 + np.log(count[used])) @ signs[used]
            length = np.linalg.norm(v)
            return (v / length if length else v).astype(np.float32)

        def predict(texts: np.ndarray) -> np.ndarray:
            return np.stack([one("" if t is None else str(t)) for t in texts])
        return predict
    return make


def encoded(texts: DataFrame, text: str = "text", make: Callable | None = None, batch: int = BATCH) -> DataFrame:
    """``texts`` with ``embedding``: the model's vector of each text."""
    model = predict_batch_udf(make or ngram_encoder(), return_type=ArrayType(FloatType()), batch_size=batch)
    return texts.withColumn("embedding", model(F.coalesce(F.col(text), F.lit(""))))
