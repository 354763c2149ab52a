"""Exact join of documents whose sets of word n-grams are similar, and its connected components."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sixfold.llm.components import components
from sixfold.llm.store import cut
from sixfold.llm.textscan import SPACED, Texts, Words, extend, mix, pieces, run_hash, windows

#: Sets in one block; a task joins one or two blocks.
BLOCK = 256
#: Elements times sets that are compared at once.
CELLS = 4_000_000
#: Sets that a task remembers, so that it sends the first shingles of equal sets once.
SEEN = 500_000
#: Counters of the sketch of shingle counts, and the rows in which they travel.
BITS, CHUNKS = 22, 16
#: A shingle that up to so many sets share gives all their pairs, to be counted.
FEW = 32
#: How often sets with too few shared shingles are taken out before families are made.
PRUNINGS = 2


def shingle_sets(texts: Texts, size: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's shingles: runs of ``size`` words, or all words if there are fewer."""
    words = Words(texts, SPACED)
    h = words.hashes(texts)
    key, at = windows(words, h, size)
    first = np.searchsorted(words.text[at], np.arange(texts.n + 1))
    out = []
    for i in range(texts.n):
        if 0 < words.count[i] < size:
            n = int(words.count[i])
            out.append(mix(run_hash(h, words.first[i : i + 1], n) + np.uint64(n)))
            continue
        s = np.sort(key[first[i] : first[i + 1]])
        out.append(s[np.append(True, s[1:] != s[:-1])] if len(s) else s)
    return out


def set_hash(s: np.ndarray) -> int:
    """One number for a set; equal sets have the same."""
    return int(mix(np.array([mix(s ^ np.uint64(0x51)).sum(dtype=np.uint64)], np.uint64) + np.uint64(len(s))).view(np.int64)[0])


class Counts:
    """How often shingles occur, in ``2**BITS`` counters however many shingles there are: a sketch, exact only in being the same everywhere.

    It gives the global order of shingles: by level, then by hash. Any order is right for the join; one that puts frequent shingles
    last keeps the groups of the first ones small. A shingle has a level above 0 if its counter stands out from what chance puts there.
    """

    def __init__(self):
        self.counts = np.zeros(1 << BITS, np.int32)

    def add(self, s: np.ndarray) -> None:
        np.add.at(self.counts, (s >> np.uint64(64 - BITS)).astype(np.int64), 1)

    def rows(self) -> list[tuple[int, bytes]]:
        return [(k, zlib.compress(part.tobytes(), 1)) for k, part in enumerate(np.split(self.counts, CHUNKS))]

    @staticmethod
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """From rows sorted by chunk: the sum of each chunk, holding one chunk at a time."""
        chunk, total = None, np.zeros(0, np.int64)
        for batch in batches:
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(zlib.decompress(raw), np.int32)
                if k != chunk:
                    if chunk is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())], names=["chunk", "counts"])
                    chunk, total = k, np.zeros(len(part), np.int64)
                total = total + part
        if chunk is not None:
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())], names=["chunk", "counts"])

    @staticmethod
    def levels(sums: dict[int, bytes]) -> np.ndarray:
        """One byte per counter: 0 up to four standard deviations above the mean, one more for each doubling beyond."""
        counts = np.concatenate([np.frombuffer(zlib.decompress(sums[k]), np.int64) for k in range(CHUNKS)]) if sums else np.zeros(1 << BITS, np.int64)
        mean = counts.mean()
        beyond = (counts - mean) / (4 * math.sqrt(mean) + 1)
        return np.where(beyond <= 1, 0, 1 + np.floor(np.log2(np.maximum(beyond, 1)))).astype(np.uint8)


def common(n: int) -> int:
    """How many of their first shingles linked sets share at least, the smaller of which has ``n`` elements."""
    return 1 + n // 20


def first_shingles(s: np.ndarray, levels: np.ndarray, num: int, den: int) -> np.ndarray:
    """The first elements of a set in the global order: so many that linked sets share ``common`` (of the smaller size) of them.

    A linked set has at least ceil(n * num / den) elements of this one; all but ceil(n * num / den) - common(n) elements are taken, so
    the first ``common(n)`` shared ones are among them.
    """
    size = len(s) - -(-num * len(s) // den) + common(len(s))
    order = np.argsort(levels[(s >> np.uint64(64 - BITS)).astype(np.int64)], kind="stable")
    return s[order[:size]]


def _held_by_several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (key, node), those whose key has several nodes; copies of a row go. One row is held back between batches."""
    held, shown = None, False  # the last row, and whether its key has had another node
    for batch in batches:
        key, node, need = (np.asarray(batch.column(k)) for k in range(3))
        if held is not None:
            key, node, need = (np.append(h, x) for h, x in zip(held, (key, node, need)))
        new = np.append(True, (key[1:] != key[:-1]) | (node[1:] != node[:-1]))
        key, node, need = key[new], node[new], need[new]
        if not len(key):
            continue
        alike = key[1:] == key[:-1]
        several = np.append(False, alike) | np.append(alike, False)
        if shown:
            several[0] = True
        out = several.copy()
        out[-1] = False
        held, shown = (key[-1:], node[-1:], need[-1:]), bool(several[-1])
        if out.any():
            yield pa.RecordBatch.from_arrays([pa.array(x[out]) for x in (key, node, need)], names=["key", "node", "need"])
    if held is not None and shown:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], names=["key", "node", "need"])


def _ties(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (key, node): all pairs of a key with up to ``FEW`` nodes; for other keys each node with the key's first one.

    At most ``FEW`` rows of an unfinished key are held between batches.
    """
    held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)]
    many = None  # key, first node and need of a key with more than FEW nodes that may go on

    def rows(a, b, need_a, need_b, large):
        columns = [a, b, need_a, need_b, np.full(len(a), large)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "b", "need_a", "need_b", "large"])

    def star(node, need, first, first_need):
        return rows(np.full(len(node), first), node, np.full(len(node), first_need, np.int32), need, True)

    def finished(node, need, start, size):
        for m in np.unique(size):
            at = start[size == m]
            if m <= FEW:
                i, j = np.triu_indices(m, 1)
                a, b = (at[:, None] + i).ravel(), (at[:, None] + j).ravel()
                if len(a):
                    yield rows(node[a], node[b], need[a], need[b], False)
            else:
                for k in at:
                    yield star(node[k : k + m], need[k : k + m], node[k], need[k])

    for batch in batches:
        key, node, need = (np.concatenate([h, np.asarray(batch.column(k))]) for k, h in enumerate(held))
        if many is not None:
            n = int(np.searchsorted(key, many[0], "right"))
            if n:
                yield star(node[:n], need[:n], many[1], many[2])
                key, node, need = key[n:], node[n:], need[n:]
        if not len(key):
            held = [key, node, need]
            continue
        start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(np.append(start, len(key)))
        yield from finished(node, need, start[:-1], size[:-1])
        last, many = int(start[-1]), None
        if size[-1] > FEW:
            many = key[last], node[last], need[last]
            yield star(node[last:], need[last:], many[1], many[2])
            last = len(key)
        held = [key[last:], node[last:], need[last:]]
    yield from finished(held[1], held[2], np.zeros(1, int), np.array([len(held[0])]))


def _candidates(shared: DataFrame) -> DataFrame:
    """Pairs of nodes that tie all linked nodes into the same components.

    Linked nodes share ``need`` first shingles, so half of that many either with few nodes or with many. Pairs with few are counted
    one by one; a shingle with many ties its nodes to the first one, for nodes that have half their need of such shingles.
    """
    ties = shared.mapInArrow(_ties, "a bigint, b bigint, need_a int, need_b int, large boolean")
    half = lambda c: F.ceil(F.col(c) / 2)
    few = ties.where("NOT large").groupBy("a", "b").agg(F.count("*").alias("n"), F.max("need_a").alias("x"), F.max("need_b").alias("y"))
    several = few.where(F.col("n") >= F.greatest(half("x"), half("y"))).select("a", "b")
    large = ties.where("large")
    full = large.groupBy("b").agg(F.count("*").alias("n"), F.max("need_b").alias("y")).where(F.col("n") >= half("y")).select("b")
    return several.union(large.where("a <> b").select("a", "b").distinct().join(full, "b", "left_semi").select("a", "b"))


class Trie:
    """Sets as sorted sequences in a prefix tree. An edge holds a run of elements; every node knows the bounds of the sizes below it."""

    __slots__ = ("edge", "children", "members", "depth", "longest", "least", "most")

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray, members: list[int], depth: int):
        """``members`` are in lexicographic order and share their first ``depth`` elements; ``sizes`` are those of the whole sets."""
        first, final = sets[members[0]], sets[members[-1]]
        room = min(len(first), len(final))
        same = first[depth:room] == final[depth:room]
        end = depth + (len(same) if same.all() else int(np.argmin(same)))
        self.edge, self.depth, self.longest = first[depth:end], end, max(len(sets[m]) for m in members)
        self.least, self.most = sizes[members].min(), sizes[members].max()
        self.members = [m for m in members if len(sets[m]) == end]
        self.children = []
        group: list[int] = []
        for m in members:
            if len(sets[m]) == end:
                continue
            if group and sets[group[-1]][end] != sets[m][end]:
                self.children.append(Trie(sets, sizes, group, end))
                group = []
            group.append(m)
        if group:
            self.children.append(Trie(sets, sizes, group, end))


def trie_links(sets: list[np.ndarray], known: list, num: int, den: int, sides: list[int] | None = None) -> list[tuple[int, int]]:
    """Links between sets that connect the same sets as all links do; sets that are equal in ``known`` are connected already.

    With ``sides``, only sets of different sides are compared. Elements that only one set has are left out first: they add nothing to
    an overlap. All sets walk down the trie of all sets together: the overlap with a shared path is counted once for each, and a set
    leaves a subtree when all that is left of both could not reach the share of the union any more.
    """
    if len(sets) < 2:
        return []
    sizes = np.array([len(s) for s in sets], np.int64)
    value, times = np.unique(np.concatenate(sets), return_counts=True)
    value = value[times > 1]
    if not len(value):
        return []
    short = []
    for s in sets:
        at = np.minimum(np.searchsorted(value, s), len(value) - 1)
        short.append(at[value[at] == s])
    order = sorted(range(len(sets)), key=lambda i: short[i].tolist())
    root = Trie(short, sizes, order, 0)
    side = np.array(sides if sides is not None else range(len(sets)))
    _, label = np.unique(np.array(known), return_inverse=True)
    out: list[tuple[int, int]] = []

    def walk(node: Trie, active: np.ndarray, overlap: np.ndarray) -> None:
        n = sizes[active]
        # den * overlap >= num * union  <=>  (num + den) * overlap >= num * (both sizes)
        need = -(-num * (n + np.maximum(node.least, -(-num * n // den))) // (num + den))
        keep = (den * node.most >= num * n) & (den * n >= num * node.least)
        for a in range(0, len(node.edge), 64):
            if not keep.all():
                active, overlap, need, keep = active[keep], overlap[keep], need[keep], keep[keep]
            if not len(active):
                return
            part = node.edge[a : a + 64]
            overlap = overlap + has[np.ix_(part, active - start)].sum(0)
            left = np.minimum(after[part[-1] + 1, active - start], node.longest - (node.depth - len(node.edge)) - a - len(part))
            keep = overlap + left >= need
        active, overlap = active[keep], overlap[keep]
        for y in node.members:
            hit = active[((num + den) * overlap >= num * (sizes[active] + sizes[y])) & (side[active] != side[y]) & (label[active] != label[y])]
            for x in hit:
                if label[x] != label[y]:
                    label[label == label[x]] = label[y]
                    out.append((int(x), y))
        if len(active):
            for child in node.children:
                walk(child, active, overlap)

    step = max(1, CELLS // len(value))
    for start in range(0, len(sets), step):
        probes = np.arange(start, min(start + step, len(sets)))
        has = np.zeros((len(value), len(probes)), np.int32)
        for k in probes:
            has[short[k], k - start] = 1
        after = np.zeros((len(value) + 1, len(probes)), np.int32)  # elements from here on
        after[:-1] = has[::-1].cumsum(0)[::-1]
        walk(root, probes, np.zeros(len(probes), np.int64))
    return out


def _joined_groups(num: int, den: int):
    """For ``mapInArrow`` over rows sorted by group: the links of each group, as pairs of nodes."""

    def links(rows: list[tuple]) -> list[tuple[int, int]]:
        two = len({r[4] for r in rows}) > 1
        sets = [np.frombuffer(r[3], np.uint64) for r in rows]
        found = trie_links(sets, [r[2] for r in rows], num, den, [r[4] for r in rows] if two and rows[0][5] else None)
        return [(rows[i][1], rows[j][1]) for i, j in found]

    def run(batches):
        group, rows = None, []
        for batch in batches:
            out = []
            for row in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("group", "node", "known", "shingles", "side", "across"))):
                if row[0] != group:
                    out += links(rows)
                    group, rows = row[0], []
                if not rows or rows[-1][1] != row[1]:  # copies of a row
                    rows.append(row)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], names=["a", "b"])
        out = links(rows)
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], names=["a", "b"])

    return run


def _links(grouped: DataFrame, num: int, den: int) -> DataFrame:
    columns = ["group", "node", "known", "shingles", "side", "across"]
    dealt = grouped.select(*columns).repartition("group").sortWithinPartitions("group", "node")
    return dealt.mapInArrow(_joined_groups(num, den), "a bigint, b bigint")


def similar_documents(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    r"""``doc_id, n_shingles, component_id`` for every row of ``docs`` (``doc_id, text``).

    A document's set holds its distinct shingles of ``words`` words ``[^\x20\x09-\x0D]+``, A-Z lower-cased; fewer words are one
    shingle. Documents are linked when ``den * intersection >= num * union``; ``component_id`` is the smallest id reachable by links.

    1. Equal sets become one node, known by a hash; everything after works on nodes, however many copies a text has.
    2. Shingles have a global order, rare ones first (``Counts``). Linked nodes share several of their first shingles (``common``), so
       nodes that hold too few shared ones drop out, and so do pairs (``_candidates``). A shingle of many nodes ties each to one of them
       only: a large group of near copies gives as many rows as it has members. A passage that many documents share is last in order.
    3. The sets of each family of candidates are joined by a prefix tree (``trie_links``) in blocks of about ``BLOCK`` sets: first each
       block with the family's first set; then, for families that are not yet one component, each pair of blocks across components.
    4. Components of the links.

    Nothing is capped and no pair of linked sets is missed, but for hash collisions (2**-64 for a pair). Null and empty texts and
    texts without words have an empty set and are linked with nothing, and neither are rows with a null id (component: null);
    repeated rows are equal sets; an empty table gives no rows.
    """
    return _similar(docs, words, num, den).drop("row")


def _similar(docs: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """``similar_documents`` with ``row``, the hash of each text."""
    spark = docs.sparkSession
    narrow = docs.select("doc_id", "text")

    def describe(batches):
        counts, seen = Counts(), set()
        for batch in batches:
            for part, texts in pieces(batch, "text"):
                sets = shingle_sets(texts, words)
                names = [set_hash(s) if len(s) else None for s in sets]
                for s, name in zip(sets, names):
                    if len(s) and name not in seen:
                        counts.add(s)
                        if len(seen) < SEEN:
                            seen.add(name)
                n = texts.n
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
                    names=["doc_id", "row", "n_shingles", "node", "chunk", "counts"],
                )
        rows = counts.rows()
        yield pa.RecordBatch.from_arrays(
            [*(pa.nulls(len(rows), pa.int64()) for _ in range(4)), pa.array([k for k, _ in rows], pa.int32()), pa.array([raw for _, raw in rows], pa.binary())],
            names=["doc_id", "row", "n_shingles", "node", "chunk", "counts"],
        )

    narrow = narrow.withColumn("doc_id", F.col("doc_id").cast("bigint"))
    described = cut(narrow.withColumn("row", F.xxhash64("text")).mapInArrow(describe, "doc_id bigint, row bigint, n_shingles bigint, node bigint, chunk int, counts binary"))
    sets = described.where("chunk IS NULL").select("doc_id", "row", "n_shingles", "node")
    sketch = described.where("chunk IS NOT NULL").select("chunk", "counts").repartition(CHUNKS, "chunk").sortWithinPartitions("chunk")
    sums = {r.chunk: bytes(r.counts) for r in sketch.mapInArrow(Counts.summed, "chunk int, counts binary").collect()}  # of fixed size
    levels = spark.sparkContext.broadcast(Counts.levels(sums))

    def send_keys(batches):
        seen = set()
        for batch in batches:
            for _, texts in pieces(batch, "text"):
                key, node, need = [], [], []
                for s in shingle_sets(texts, words):
                    if not len(s) or (name := set_hash(s)) in seen:
                        continue
                    if len(seen) < SEEN:
                        seen.add(name)
                    key.append(first_shingles(s, levels.value, num, den))
                    node.append(np.full(len(key[-1]), name, np.int64))
                    need.append(np.full(len(key[-1]), common(-(-num * len(s) // den)), np.int32))
                if key:
                    columns = (np.concatenate(key).view(np.int64), np.concatenate(node), np.concatenate(need))
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "node", "need"])

    triple = "key bigint, node bigint, need int"
    keyed = narrow.where("doc_id IS NOT NULL").select("text").mapInArrow(send_keys, triple)
    sort = lambda df: df.select("key", "node", "need").repartition("key").sortWithinPartitions("key", "node")
    shared = cut(sort(keyed).mapInArrow(_held_by_several, triple))
    # A set that has too few of its first shingles in common with any others has no link. When it goes, others may have too few.
    for _ in range(PRUNINGS):
        enough = shared.groupBy("node").agg(F.count("*").alias("n"), F.max("need").alias("need")).where("n >= need").select("node")
        shared = sort(shared.join(enough, "node", "left_semi")).mapInArrow(_held_by_several, triple)
    families = cut(components(_candidates(sort(cut(shared)))).withColumnRenamed("component", "family"))

    classes = sets.where("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least"))
    blocks = families.groupBy("family").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    placed = families.join(blocks, "family").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    # One text of each candidate set. An id that stands for several texts brings them all; the hash tells which is meant.
    wanted = placed.join(classes, "node").withColumnRenamed("least", "doc_id")

    def encode(_, texts: Texts) -> dict:
        found = shingle_sets(texts, words)
        return {"shingles": [s.tobytes() for s in found], "is": [set_hash(s) if len(s) else 0 for s in found]}

    new = {"shingles": ("binary", pa.binary()), "is": ("bigint", pa.int64())}
    members = cut(extend(wanted.join(narrow, "doc_id").drop("doc_id"), encode, new, without=("text",)).where(F.col("is") == F.col("node")).drop("is"))

    # The smallest node of a family is its name.
    with_all = F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)
    stars = members.withColumn("with", F.explode(F.when(F.col("node") == F.col("family"), with_all).otherwise(F.array("block")))).select(
        F.xxhash64("family", "with").alias("group"), "node", F.col("node").alias("known"), "shingles", F.lit(0).alias("side"), F.lit(False).alias("across")
    )
    near = cut(_links(stars, num, den))
    linked = cut(components(near))

    # Families of several blocks that are not one component yet: all pairs of blocks, across components.
    tied = placed.where("blocks > 1").join(linked, "node", "left").select("family", "node", F.coalesce("component", "node").alias("known"))
    split = tied.groupBy("family").agg(F.count_distinct("known").alias("parts")).where("parts > 1").select("family")
    open_ = cut(tied.join(split, "family", "left_semi").drop("family"))
    if not open_.isEmpty():
        other = members.join(open_, "node").withColumn("other", F.explode(with_all)).where("other <> block")
        across = other.select(
            F.xxhash64("family", F.least("block", "other"), F.greatest("block", "other")).alias("group"),
            "node",
            "known",
            "shingles",
            (F.col("block") > F.col("other")).cast("int").alias("side"),
            F.lit(True).alias("across"),
        )
        linked = cut(components(near.union(_links(across, num, den))))

    named = linked.join(classes, "node")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_node = named.select("node", "component").join(least, "component").select("node", "component_id")
    known = classes.join(of_node, "node", "left").select("node", F.coalesce("component_id", "least").alias("component_id"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return sets.join(known, "node", "left").select("doc_id", "n_shingles", component.alias("component_id"), "row")


def keep_one(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` that are the first of their component (smallest id); of rows with equal id and text one. See ``similar_documents``.

    Each text of an id stands for itself: one stays, another that is a near copy of an earlier document goes. Rows with a null id and rows
    without words are linked with nothing and all stay, repeated ones too.
    """
    first = _similar(docs, words, num, den).where("n_shingles > 0 AND doc_id = component_id").select(F.col("doc_id").alias("__id"), F.col("row").alias("__row")).distinct()
    linked = F.col("doc_id").isNotNull() & F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    named = docs.where(linked).withColumn("__text", F.xxhash64("text"))
    kept = named.join(first, (F.col("doc_id") == F.col("__id")) & (F.col("__text") == F.col("__row")), "left_semi").dropDuplicates(["doc_id", "__text"])
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return kept.select(*columns).union(docs.where(~linked).select(*columns))


def op4(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    return similar_documents(docs, 4, 85, 100)


OP4_SQL = r"""WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
e AS (SELECT a, b FROM o JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * o >= 85 * (x.n + y.n - o)),
pairs AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id, doc_id AS reach FROM w UNION SELECT r.doc_id, pairs.b FROM r JOIN pairs ON r.reach = pairs.a)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, c AS component_id
FROM w LEFT JOIN n ON w.doc_id = n.doc_id JOIN (SELECT doc_id, min(reach) AS c FROM r GROUP BY doc_id) m ON w.doc_id = m.doc_id"""

QUERIES = {"op4_ngram_jaccard": (op4, OP4_SQL)}
