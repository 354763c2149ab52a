"""Byte strings that repeat across a corpus, found by a difference cover of the positions."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sixfold.llm.store import cut, shared_folder
from sixfold.llm.textscan import VALUES, Texts, pieces, span_hash, sums

#: A difference cover of the numbers below 57: every difference modulo 57 is one of two of these. For any two positions there is a
#: shift below 57 that takes both to sampled ones.
MODULUS, COVER = 57, (0, 1, 3, 13, 32, 36, 43, 52)
#: Bytes of text of one block, and of the blocks that one task writes.
BLOCK, FILE = 4 << 20, 16 << 20
#: A chunk ends where the leading bits of a product of so many bytes are 0: at the same places in equal texts.
MARK, CHUNK_BITS = 8, 6
#: About as many names are compared by one task.
NAMES = 4_000_000


class Block:
    """The texts of one block, the starts of ``size``-byte strings in them, and what the answers so far say about these."""

    def __init__(self, texts: Texts, size: int):
        self.texts, self.size = texts, size
        self.c = sums(texts.buf, VALUES)
        n, length = len(texts.buf), np.diff(texts.at)
        change = np.zeros(n + 1, np.int8)
        long = length >= size
        change[texts.at[:-1][long]] += 1
        change[texts.at[1:][long] - size + 1] -= 1
        self.open = np.cumsum(change[:-1], dtype=np.int8) > 0  # starts that are not known to repeat an earlier string
        self.repeated = np.zeros(n, bool)

    def _name(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return span_hash(self.c, start, end)

    def _marks(self) -> np.ndarray:
        """Whether a chunk ends at a place: by the ``MARK`` bytes from there alone."""
        buf = self.texts.buf
        words = np.ndarray(max(len(buf) - MARK + 1, 0), f"<u{MARK}", np.ascontiguousarray(buf), strides=(1,))
        return (words * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - CHUNK_BITS) == 0

    def chunks(self) -> np.ndarray:
        """Names of the chunks of all starts: a chunk with all strings that begin in it."""
        starts = np.flatnonzero(self.open)
        if not len(starts):
            self.a = self.b = starts
            return np.zeros(0, np.uint64)
        begins = np.append(True, np.diff(starts) > 1)
        begins |= self._marks()[starts]
        ends = np.append(np.flatnonzero(begins)[1:], len(starts)) - 1
        self.a, self.b = starts[begins], starts[ends] + 1
        return self._name(self.a, self.b + self.size - 1)

    def drop_chunks(self, earlier: np.ndarray) -> None:
        change = np.zeros(len(self.open) + 1, np.int8)
        change[self.a[earlier]] += 1
        change[self.b[earlier]] -= 1
        self.repeated |= np.cumsum(change[:-1], dtype=np.int8) > 0
        self.open &= ~self.repeated

    def samples(self) -> np.ndarray:
        """Names of the sampled places that an open start has less than ``MODULUS`` bytes before it."""
        at, length = self.texts.at, np.diff(self.texts.at)
        short = self.size - MODULUS + 1
        found = [np.zeros(0, np.int64)]
        for i in np.flatnonzero(length >= self.size):
            p = (np.arange(0, length[i], MODULUS)[:, None] + np.array(COVER)).ravel()
            found.append(at[i] + p[p + short <= length[i]])
        p = np.concatenate(found)
        upto = np.concatenate([[0], np.cumsum(self.open)])
        self.places = p[upto[p + 1] > upto[np.maximum(p - MODULUS + 1, 0)]]
        return self._name(self.places, self.places + short)

    def keep_near(self, shared: np.ndarray) -> None:
        p = self.places[shared]
        change = np.zeros(len(self.open) + 1, np.int64)
        np.add.at(change, np.maximum(p - MODULUS + 1, 0), 1)
        np.add.at(change, p + 1, -1)
        self.open &= np.cumsum(change[:-1]) > 0

    def strings(self) -> np.ndarray:
        """Names of the strings that begin at the open starts that are left."""
        self.starts = np.flatnonzero(self.open)
        return self._name(self.starts, self.starts + self.size)

    def drop_strings(self, earlier: np.ndarray) -> None:
        self.repeated[self.starts[earlier]] = True

    def kept(self) -> tuple[list[int], list[int], list[bytes]]:
        """Per text the bytes removed, the runs of them, and the bytes that are left."""
        starts, n = np.flatnonzero(self.repeated), len(self.repeated)
        change = np.zeros(n + 1, np.int64)
        change[starts] += 1
        np.add.at(change, starts + self.size, -1)
        gone = np.cumsum(change[:-1]) > 0
        first = gone.copy()
        first[1:] &= ~gone[:-1]
        edges = self.texts.at[:-1]
        edges = edges[edges < n]
        first[edges] |= gone[edges]
        parts = list(zip(self.texts.at[:-1], self.texts.at[1:]))
        return [int(gone[a:b].sum()) for a, b in parts], [int(first[a:b].sum()) for a, b in parts], [self.texts.buf[a:b][~gone[a:b]].tobytes() for a, b in parts]


#: The rounds in order: which names a block sends, what it does with the answer, whether the answer is about earlier places only (or
#: about any other), bytes sent of a name, and the most names a byte of text can have.
ROUNDS = (
    (Block.chunks, Block.drop_chunks, True, 8, 1 / 32),
    (Block.samples, Block.keep_near, False, 4, len(COVER) / MODULUS),
    (Block.strings, Block.drop_strings, True, 8, 1 / 4),
)


def _bucket(names: np.ndarray, buckets: int) -> np.ndarray:
    """Rises with the name, so the sorted names of one bucket are one slice."""
    return ((names >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _answer(names: np.ndarray, bits, earlier: bool, buckets: int) -> np.ndarray:
    """For each name whether an earlier place has it (or any other), from the bits per bucket and from the block itself."""
    unique, first, inverse, count = np.unique(names, return_index=True, return_inverse=True, return_counts=True)
    said = np.zeros(len(unique), bool)
    if bits is not None and len(unique):
        slices = np.searchsorted(_bucket(unique, buckets), np.arange(buckets + 1))
        for one in bits:
            a, b = slices[one["bucket"]], slices[one["bucket"] + 1]
            said[a:b] = np.unpackbits(np.frombuffer(one["bits"], np.uint8), count=b - a).astype(bool)
    if not earlier:
        return (said | (count > 1))[inverse]
    out = np.ones(len(names), bool)
    out[first] = False
    return out | said[inverse]


def _blocks(batches, size: int, rounds: int, buckets: list[int]):
    """The blocks of some rows after so many rounds of answers."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(k)[i] for k, name in enumerate(batch.schema.names)}
            block = Block(Texts(row["text"].values), size)
            for k in range(rounds):
                send, take, earlier, _, _ = ROUNDS[k]
                take(block, _answer(send(block), row[f"bits_{k}"].as_py(), earlier, buckets[k]))
            yield row, block


def _compare(earlier: bool, width: int) -> Callable[[pa.Table], pa.Table]:
    """For the names that all blocks sent to one bucket: a bit for each, in the order sent. Blocks without a set bit get none."""

    def work(sent: pa.Table) -> pa.Table:
        sent = sent.sort_by("block")
        parts = [np.frombuffer(x.as_buffer(), f"<u{width}") for x in sent.column("names")]
        names = np.concatenate(parts)
        order = np.argsort(names, kind="stable")
        same = np.append(False, names[order][1:] == names[order][:-1])
        if not earlier:
            same[:-1] |= same[1:]
        said = np.zeros(len(names), bool)
        said[order] = same
        at = np.cumsum([0, *map(len, parts)])
        bits = [said[a:b] for a, b in zip(at, at[1:])]
        some = np.array([x.any() for x in bits], bool)
        picked = sent.select(["block", "bucket"]).filter(pa.array(some))
        return picked.append_column("bits", pa.array([np.packbits(x).tobytes() for x in bits if x.any()], pa.binary()))

    return work


def _ask(blocks: DataFrame, size: int, k: int, buckets: list[int]) -> DataFrame:
    """The answers of round ``k``: one row per block with its bits."""
    send, _, earlier, width, _ = ROUNDS[k]

    def messages(batches):
        for row, block in _blocks(batches, size, k, buckets):
            names = np.unique(send(block))
            at = np.searchsorted(_bucket(names, buckets[k]), np.arange(buckets[k] + 1))
            full = np.flatnonzero(np.diff(at))
            short = names.astype(f"<u{width}")
            if len(full):
                sent = pa.array([short[at[b] : at[b + 1]].tobytes() for b in full], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), pa.array(np.full(len(full), row["block"].as_py())), sent], names=["bucket", "block", "names"])

    sent = blocks.mapInArrow(messages, "bucket bigint, block bigint, names binary")
    said = sent.groupBy("bucket").applyInArrow(_compare(earlier, width), "block bigint, bucket bigint, bits binary")
    return cut(said.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias(f"bits_{k}")))


def _counted(batches):
    """Rows in order, each once, with how often it comes."""
    held = None
    for batch in batches:
        rows = pa.table({"doc": batch.column(0), "text": batch.column(1).cast(pa.large_string()), "times": np.ones(batch.num_rows, np.int64)})
        rows = (pa.concat_tables([held, rows]) if held is not None else rows).combine_chunks()
        if not rows.num_rows:
            continue
        doc, text, times = (rows.column(k) for k in range(3))
        same = np.zeros(rows.num_rows, bool)
        alike = pc.equal(pc.fill_null(text.slice(1), ""), pc.fill_null(text.slice(0, rows.num_rows - 1), ""))
        same[1:] = np.asarray(doc)[1:] == np.asarray(doc)[:-1]
        same[1:] &= np.asarray(alike)
        first = np.flatnonzero(~same)
        rows = rows.take(first).set_column(2, "times", pa.array(np.add.reduceat(np.asarray(times), first)))
        held = rows.slice(rows.num_rows - 1)
        yield from rows.slice(0, rows.num_rows - 1).combine_chunks().to_batches()
    if held is not None:
        yield from held.combine_chunks().to_batches()


def _pack(batches):
    """Rows in the order of their ids as blocks: (number, ids, texts, times); numbers rise with the ids."""
    number = TaskContext.get().partitionId() << 32
    for batch in _counted(batches):
        for part, _ in pieces(batch, "text", BLOCK):
            ends = pa.array([0, part.num_rows], pa.int32())
            kinds = (pa.int64(), pa.string(), pa.int64())
            lists = [pa.ListArray.from_arrays(ends, pa.concat_arrays([part.column(k).cast(kind)])) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *lists], names=["block", "doc", "text", "times"])
            number += 1


def remove_repeats(docs: DataFrame, size: int = 100) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (binary: the bytes that are left) for every row of ``docs`` (``doc_id, text``).

    Removed is each byte that a ``size``-byte string covers which also starts earlier in the corpus: in a document with a smaller id,
    or in the same one further left.

    Documents are sorted by id into blocks, a bucketed table in the shared folder. In each round blocks send the sorted different names
    of some of their strings, a slice to each task, and get one bit back for each name; texts do not travel again.

    1. Chunks, cut by content, are compared first: all strings that begin in a chunk that an earlier place has repeat it. This takes
       copies out before anything else is counted.
    2. Sampled places (``COVER``) are named by the bytes from there. Two equal strings both have a sampled place at the same shift, with
       equal names there, so a string that repeats begins at most ``MODULUS - 1`` bytes before a place whose name is shared.
    3. The strings that begin there, sampled or not, are named by all their bytes and compared: a string repeats unless it is in the
       first block that has its name, and there in the first place. The earliest place of a string is left in all rounds.

    Names are 64-bit hashes, so a false match has a chance of 2**-64 a pair; round 2 sends half of each, since its matches are checked.
    A block sends each name once, so a string with very many places has at most one entry a block. A null text is empty; rows with a
    null id take no part and are returned whole; rows with the same id and text are one document (each row is
    returned), rows with the same id and another text count in the order of their texts. An empty table gives
    no rows. Texts of any length are read whole; one longer than a block is a block of its own.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    total = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(12, -(-total // FILE))
    buckets = [max(12, int(total * share / NAMES) + 1) for *_, share in ROUNDS]
    name = f"repeats_{uuid.uuid4().hex}"
    ordered = narrow.where("doc_id IS NOT NULL").repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id", "text")
    packed = ordered.mapInArrow(_pack, "block bigint, doc array<bigint>, text array<string>, times array<bigint>")
    packed.write.bucketBy(files, "block").option("path", f"{shared_folder(spark)}/{name}").option("compression", "zstd").saveAsTable(name)
    blocks = spark.table(name)
    for k in range(len(ROUNDS)):
        blocks = blocks.join(_ask(blocks, size, k, buckets), "block", "left")

    def results(batches):
        for row, block in _blocks(batches, size, len(ROUNDS), buckets):
            removed, spans, kept = block.kept()
            columns = [row["doc"].values, np.diff(block.texts.at), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary()), row["times"].values]
            yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "times"])

    found = blocks.mapInArrow(results, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, times bigint")
    found = found.withColumn("times", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).drop("times")
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    zero = F.lit(0).cast("bigint")
    others = narrow.where("doc_id IS NULL").select("doc_id", F.octet_length(text).cast("bigint").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), text.alias("kept"))
    return found.unionByName(others)


def op7(spark, sf):
    found = remove_repeats(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op7_repeated_bytes": (op7, None)}
