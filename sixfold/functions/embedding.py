"""Text embeddings: a pluggable batch encoder, the hash encoder as its default, and a byte-scaled hash in pure columns."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

DIMENSIONS = 384
BATCH = 100

Encoder = Callable[[Sequence[str]], np.ndarray]


def hash_encoder(dimensions: int = DIMENSIONS) -> Callable[[], Encoder]:
    """Random unit vectors seeded by the text: equal texts get equal vectors, on every executor."""

    def build() -> Encoder:
        def encode(texts: Sequence[str]) -> np.ndarray:
            vectors = np.empty((len(texts), dimensions), dtype=np.float32)
            for i, value in enumerate(texts):
                seed = int.from_bytes(hashlib.sha256(value.encode("utf-8")).digest()[:4], "big")
                drawn = np.random.default_rng(seed).standard_normal(dimensions).astype(np.float32)
                vectors[i] = drawn / np.linalg.norm(drawn)
            return vectors

        return encode

    return build


def embed(value: Column | str, build: Callable[[], Encoder] | None = None, batch: int = BATCH) -> Column:
    """``array<float>`` per text; ``build`` makes the encoder once per task, which then sees ``batch`` texts at a time."""
    build = build or hash_encoder()

    @F.pandas_udf("array<float>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = build()
        for texts in parts:
            vectors: list = [None] * len(texts)
            filled = [i for i, t in enumerate(texts) if t is not None]
            for start in range(0, len(filled), batch):
                chosen = filled[start : start + batch]
                for i, vector in zip(chosen, encode([texts.iloc[i] for i in chosen])):
                    vectors[i] = np.asarray(vector, dtype=np.float32)
            yield pd.Series(vectors, dtype=object)

    return run(value)


def byte_embedding(value: Column | str) -> Column:
    """48 numbers ``byte / 255 - 0.5`` from the SHA-256 of the text: bytes 0-31, then bytes 16-31 again."""
    digest = F.sha2(F.encode(value, "utf-8"), 256)
    starts = F.concat(F.sequence(F.lit(1), F.lit(63), F.lit(2)), F.sequence(F.lit(33), F.lit(63), F.lit(2)))
    return F.transform(starts, lambda at: F.conv(F.substring(digest, at, F.lit(2)), 16, 10).cast("double") / 255 - 0.5)
