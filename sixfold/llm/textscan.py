"""Words and byte windows of Arrow string columns as numpy arrays: no Python object per word.

Hashes are two polynomials over random byte values modulo the prime 2**31 - 1, with two random bases, put together and finished by a bit
mixer. Equal words always have equal hashes; two different words of n bytes share one with a chance of at most about (n / 2**31)**2,
whatever their structure: a field has no such zero divisors as the whole numbers modulo 2**64, where whole families of texts collide.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from sixfold.llm.store import bounded_batches

#: Bytes of text that are worked on at once; a longer text is worked on alone.
PIECE = 1 << 19

#: The modulus, a Mersenne prime: a remainder takes a shift and a sum.
PRIME = (1 << 31) - 1
_P, _S = np.uint64(PRIME), np.uint64(31)
_rng = np.random.default_rng(20240229)
#: For each byte its value in either polynomial.
VALUES = _rng.integers(1, PRIME, (256, 2), dtype=np.uint64)
BASES = [int(x) for x in _rng.integers(1 << 20, PRIME - 1, 2)]
STEP = np.uint64(0x9E3779B97F4A7C15)
_powers: list[list[np.ndarray]] = []


def _byte_map(lower: bool) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    if lower:
        table[65:91] += 32
    return table


LOWER = _byte_map(True)
#: Words ``[^\x20\x09-\x0D]+``.
SPACED = np.ones(256, bool)
SPACED[[32, *range(9, 14)]] = False
#: Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def powers(n: int) -> list[list[np.ndarray]]:
    """For either base its powers and those of its inverse, at least ``n`` of each."""
    if not _powers or len(_powers[0][0]) < n:
        size = max(n, 2 * PIECE)
        _powers[:] = [[_powers_of(b, size), _powers_of(pow(b, -1, PRIME), size)] for b in BASES]
    return _powers


def _powers_of(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    have = 1
    while have < n:
        more = min(have, n - have)
        out[have : have + more] = remainder(out[:more] * np.uint64(pow(base, have, PRIME)))
        have += more
    return out


def _folded(x: np.ndarray) -> np.ndarray:
    """The same modulo ``PRIME``; below 2**33 for any ``x``, and below 2**32 for a product of two remainders."""
    return (x & _P) + (x >> _S)


def remainder(x: np.ndarray) -> np.ndarray:
    x = _folded(_folded(x))
    np.subtract(x, _P, out=x, where=x >= _P)
    return x


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h = h * np.uint64(0xCF1BBCDCB7A56463)
    return h ^ (h >> np.uint64(32))


#: Bytes or spans that are worked on together: what they need stays in a core's cache.
_RUN = 1 << 14


def sums(buf: np.ndarray, table: np.ndarray) -> list[np.ndarray]:
    """Running sums from which ``span_hash`` takes the hash of any span; ``table`` has a row per byte, as ``VALUES``."""
    out = []
    for k, (up, _) in enumerate(powers(len(buf))):
        values, c, high = np.ascontiguousarray(table[:, k]), np.zeros(len(buf) + 1, np.uint64), np.empty(_RUN, np.uint64)
        for a in range(0, len(buf), _RUN):
            x = values[buf[a : a + _RUN]]
            x *= up[a : a + len(x)]
            np.right_shift(x, _S, out=high[: len(x)])
            x &= _P
            x += high[: len(x)]  # below 2**32
            x[0] += c[a]
            np.cumsum(x, out=c[a + 1 : a + 1 + len(x)])
        out.append(c)
    return out


def span_hash(c: list[np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes [start, end) of the text that ``sums`` has read; the length counts too."""
    h, down = np.empty(len(start), np.uint64), [d for _, d in powers(len(c[0]))]
    for a in range(0, len(start), _RUN):
        first, last = start[a : a + _RUN], end[a : a + _RUN]
        both = np.zeros(len(first), np.uint64)
        for one, inverse in zip(c, down):
            x = one[last]
            x -= one[first]
            x = _folded(_folded(x))  # below 2**31 + 4
            x *= inverse[first]
            both <<= np.uint64(32)
            both |= remainder(x)
        both += (last - first).astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
        h[a : a + _RUN] = mix(both)
    return h


class Texts:
    """Some texts as one run of bytes. A null is an empty text here; ``missing`` tells them apart."""

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
        _, at, data = column.buffers()
        at = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1] if at is not None and len(column) else np.zeros(1, np.int64)
        first, last = int(at[0]), int(at[-1])
        self.buf = np.frombuffer(data, np.uint8)[first:last] if data is not None and last > first else np.zeros(0, np.uint8)
        self.at = at - first
        self.n = len(column)
        self.missing = np.asarray(column.is_null()) if len(column) else np.zeros(0, bool)

    def owner(self, position: np.ndarray) -> np.ndarray:
        """The text that holds each byte position."""
        return np.searchsorted(self.at, position, "right") - 1


class Words:
    """The words of some texts: start, end (byte positions), text and, per text, the place of its first word."""

    def __init__(self, texts: Texts, kind: np.ndarray):
        inside = kind[texts.buf]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        cuts = texts.at[1:-1]  # words end where their text ends
        cuts = cuts[(cuts > 0) & (cuts < len(inside))]
        first[cuts] |= inside[cuts]
        last[cuts - 1] |= inside[cuts - 1]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.text = texts.owner(self.start)
        self.first = np.searchsorted(self.text, np.arange(texts.n + 1))
        self.count = np.diff(self.first)

    def hashes(self, texts: Texts, lower: bool = True) -> np.ndarray:
        c = sums(texts.buf, VALUES[LOWER] if lower else VALUES)
        return span_hash(c, self.start, self.end)


def windows(words: Words, h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words inside one text, and the place of each run's first word."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(words.text[:n] == words.text[size - 1 :])
    return run_hash(h, at, size), at


def run_hash(h: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hash of ``size`` hashes in a row from each place; mixed at every step, so no sum of them cancels another."""
    out = np.zeros(len(at), np.uint64)
    for k in range(size):
        out = mix(out * STEP + h[at + k])
    return out


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Cut a batch into runs of rows of about ``limit`` bytes of text."""
    if not batch.num_rows:
        return
    place = batch.schema.get_field_index(column)
    whole = Texts(batch.column(place))
    cuts = [0]
    while cuts[-1] < batch.num_rows:
        end = int(np.searchsorted(whole.at, whole.at[cuts[-1]] + limit, "right")) - 1
        cuts.append(min(batch.num_rows, max(end, cuts[-1] + 1)))
    for a, b in zip(cuts, cuts[1:]):
        part = batch.slice(a, b - a)
        yield part, Texts(part.column(place))


def extend(docs, work: Callable[[pa.RecordBatch, Texts], dict], new: dict[str, tuple[str, pa.DataType]], column: str = "text", without: tuple[str, ...] = ()):
    """The rows of ``docs`` without the columns ``without`` and with those of ``work``: name -> (Spark type, Arrow type).

    ``work`` gets some rows and their texts and returns a sequence of values for every new column.
    """
    from pyspark.sql import types as T

    bounded_batches(docs.sparkSession)
    kept = [f for f in docs.schema if f.name not in without and f.name not in new]
    schema = T.StructType(kept + [T.StructField(name, T._parse_datatype_string(kind)) for name, (kind, _) in new.items()])
    names = [f.name for f in kept]

    def run(batches):
        for batch in batches:
            for part, texts in pieces(batch, column):
                made = work(part, texts)
                columns = [part.column(part.schema.get_field_index(n)) for n in names] + [pa.array(made[n], kind) for n, (_, kind) in new.items()]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, *new])

    return docs.mapInArrow(run, schema)
