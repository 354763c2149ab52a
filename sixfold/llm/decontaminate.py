"""Finding and removing test items in training texts with a generalised suffix automaton over words."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sixfold.llm.store import cut
from sixfold.llm.textscan import ALNUM, Texts, Words, extend

#: Words of test items in one automaton; more items go through the documents in further passes.
MAX_TOKENS = 1_000_000


class Automaton:
    """Generalised suffix automaton of items given as lists of word hashes.

    Its states stand for the factors of the items. A window is ``window`` words of an item in a row, or the whole of a shorter item.
    """

    def __init__(self, items: list[tuple[str | None, list[int]]], window: int):
        self.window = window
        self.next, self.link, self.len = [{}], [-1], [0]
        ends: list[tuple[str | None, list[int]]] = []
        for name, words in items:
            last, path = 0, []
            for w in words:
                last = self._add(last, w)
                path.append(last)
            ends.append((name, path))
        self.names: list[set] = [set() for _ in self.next]
        self.short: list[tuple] = [() for _ in self.next]
        whole: dict[int, set] = {}
        for (name, words), (_, path) in zip(items, ends):
            if 0 < len(words) < window:
                whole.setdefault(self._walk(words), set()).add((len(words), name))
                continue
            state = 0
            for w in words:
                state = self.next[state][w]
                up = state
                while up > 0 and self.len[up] >= window and name not in self.names[up]:
                    self.names[up].add(name)
                    up = self.link[up]
        for state in sorted(range(1, len(self.len)), key=self.len.__getitem__):  # links lead to shorter states
            self.short[state] = self.short[self.link[state]] + tuple(sorted(whole.get(state, ()), key=str))
        self.least = min([window, *(len(w) for _, w in items if w)])
        pairs = {(a, b) for _, words in items for a, b in zip(words, words[1:])}
        self.words = np.unique(np.array([w for _, words in items for w in words], np.uint64))
        place = {int(w): k for k, w in enumerate(self.words)}
        self.pairs = np.unique(np.array([place[a] * len(place) + place[b] for a, b in pairs], np.int64))

    def _walk(self, words: list[int]) -> int:
        state = 0
        for w in words:
            state = self.next[state][w]
        return state

    def _state(self, length: int, link: int, following: dict) -> int:
        self.next.append(following)
        self.link.append(link)
        self.len.append(length)
        return len(self.len) - 1

    def _split(self, p: int, q: int, w: int) -> int:
        clone = self._state(self.len[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _add(self, last: int, w: int) -> int:
        q = self.next[last].get(w)
        if q is not None:  # an earlier item has this factor
            return q if self.len[q] == self.len[last] + 1 else self._split(last, q, w)
        new, p = self._state(self.len[last] + 1, 0, {}), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.len[q] == self.len[p] + 1 else self._split(p, q, w)
        return new

    def stream(self, words: list[int], at: int, spans: list[tuple[int, int]], names: set) -> None:
        """Feed words; add the spans of windows (numbered from ``at``) and the names of their items."""
        state = length = 0
        for i, w in enumerate(words, at):
            following = self.next[state].get(w)
            while following is None and state:
                state = self.link[state]
                length = self.len[state]
                following = self.next[state].get(w)
            if following is None:
                continue
            state, length = following, length + 1
            if length >= self.window:
                spans.append((i - self.window + 1, i + 1))
                up = state
                while self.len[self.link[up]] >= self.window:
                    up = self.link[up]
                names |= self.names[up]
            for size, name in self.short[state]:
                if size <= length:
                    spans.append((i - size + 1, i + 1))
                    names.add(name)

    def find(self, texts: Texts) -> tuple[Words, dict[int, list], dict[int, set]]:
        """The words of some texts and, for texts with windows, the spans (word places) and item names.

        Only runs of words whose neighbours stand side by side in some item are streamed: a window lies inside such a run.
        """
        words = Words(texts, ALNUM)
        h = words.hashes(texts)
        spans: dict[int, list] = {}
        names: dict[int, set] = {}
        if not len(h) or not len(self.words):
            return words, spans, names
        place = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        known = self.words[place] == h
        joined = np.zeros(len(h), bool)  # to the word before
        both = np.flatnonzero(known[1:] & known[:-1] & (words.text[1:] == words.text[:-1])) + 1
        if len(self.pairs):
            key = place[both - 1].astype(np.int64) * len(self.words) + place[both]
            joined[both] = self.pairs[np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)] == key
        begin = np.flatnonzero(known & ~joined)
        stop = joined.copy()
        stop[:-1] &= ~joined[1:]
        stop |= known & ~joined & ~np.append(joined[1:], False)
        end = np.flatnonzero(stop) + 1
        for a, b in zip(*(x[(end - begin) >= self.least] for x in (begin, end))):
            text, found, hit = int(words.text[a]), [], set()
            self.stream(h[a:b].tolist(), int(a), found, hit)
            if found:
                spans.setdefault(text, []).extend(found)
                names.setdefault(text, set()).update(hit)
        return words, spans, names


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(map(tuple, spans)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _automata(benchmark: DataFrame, window: int, max_tokens: int):
    """One automaton for each part of the items. The parts are cut by a hash of the item so that each has about ``max_tokens`` words."""
    items = benchmark.select("item_id", "text").where("text IS NOT NULL")
    # A word takes two characters at least, with the space after it.
    size = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    parts = -(-size // (2 * max_tokens)) or 1
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    for k in range(parts):
        rows = items.where(part == k).collect()  # bounded by max_tokens
        texts = Texts(pa.array([r.text for r in rows], pa.large_string()))
        words = Words(texts, ALNUM)
        h = words.hashes(texts).tolist()
        yield Automaton([(None if r.item_id is None else str(r.item_id), h[words.first[i] : words.first[i + 1]]) for i, r in enumerate(rows)], window)


def find_items(docs: DataFrame, benchmark: DataFrame, window: int = 10, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Mark the words of ``docs`` (with ``text``) that lie in a window of a test item of ``benchmark`` (``item_id, text``).

    Returns the rows of ``docs`` with (in place of columns of these names) ``__n_words`` (bigint), ``__spans`` (word places from 0, end excluded, merged) and ``__items``
    (their ids as strings, sorted). The test items are a stated set: up to ``max_tokens`` words of them go to the tasks as one
    automaton, a larger set is cut into parts and the documents pass once for each. Documents are never shuffled.

    A null text has no words; an item without words has no windows; equal items count each with its own id; an item with a null id
    marks words and is not listed. Empty tables give no rows or no spans.
    """
    spark = docs.sparkSession
    out = docs.withColumns({"__spans": F.array().cast("array<array<int>>"), "__items": F.array().cast("array<string>")})
    new = {"__n_words": ("bigint", pa.int64()), "__spans": ("array<array<int>>", pa.list_(pa.list_(pa.int32()))), "__items": ("array<string>", pa.list_(pa.string()))}

    def searched(part):
        def work(batch: pa.RecordBatch, texts: Texts) -> dict:
            words, found, named = part.value.find(texts)
            spans, items = batch.column("__spans").to_pylist(), batch.column("__items").to_pylist()
            for i, more in found.items():
                spans[i] = merged(spans[i] + [(a - int(words.first[i]), b - int(words.first[i])) for a, b in more])
                items[i] = sorted({*items[i], *(x for x in named[i] if x is not None)})
            return {"__n_words": words.count, "__spans": spans, "__items": items}

        return work

    for k, automaton in enumerate(_automata(benchmark, window, max_tokens)):
        if k:
            out = cut(out)
        out = extend(out, searched(spark.sparkContext.broadcast(automaton)), new)
    return out


def remove_items(docs: DataFrame, benchmark: DataFrame, window: int = 10, max_coverage: float = 0.5) -> DataFrame:
    """``docs`` with every marked span cut out of the text; documents of which more than ``max_coverage`` of the words are marked go.

    A span goes from the first byte of its first word to the last byte of its last word; what stands between spans stays. Columns are
    those of ``docs``. See ``find_items`` for nulls and empty tables.
    """
    # The other columns stand in one struct, so that none of them meets a name used here.
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    marked = find_items(docs.select("text", F.struct(*others, F.lit(0).alias("__no_column")).alias("doc")), benchmark, window)
    length = F.aggregate("__spans", F.lit(0).cast("bigint"), lambda n, s: n + s[1] - s[0])
    kept = marked.where(length <= F.lit(max_coverage) * F.col("__n_words"))

    def work(batch: pa.RecordBatch, texts: Texts) -> dict:
        out, words = [], None
        for i, spans in enumerate(batch.column("__spans").to_pylist()):
            text = None if texts.missing[i] else texts.buf[texts.at[i] : texts.at[i + 1]].tobytes()
            if spans:
                words = words or Words(texts, ALNUM)
                parts, at = [], int(texts.at[i])
                for a, b in spans:
                    parts.append(texts.buf[at : words.start[words.first[i] + a]].tobytes())
                    at = int(words.end[words.first[i] + b - 1])
                text = b"".join([*parts, texts.buf[at : texts.at[i + 1]].tobytes()])
            out.append(None if text is None else text.decode())
        return {"cleaned": out}

    cleaned = extend(kept, work, {"cleaned": ("string", pa.string())})
    return cleaned.select(*[F.col("cleaned").alias("text") if c == "text" else F.col(f"doc.`{c}`") for c in docs.columns])


def op6(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    marked = find_items(docs, spark.read.parquet(f"{sf}/benchmark.parquet"))
    hit = F.aggregate("__spans", F.lit(0).cast("bigint"), lambda n, s: n + s[1] - s[0])
    return marked.select(
        "doc_id",
        F.col("__n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.array_join("__items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


WORDS_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP6_SQL = f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {WORDS_SQL} AS w FROM documents),
b AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark),
bw AS (SELECT item_id, w, least(len(w), 10) AS m, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0),
bk AS (SELECT DISTINCT item_id, m, array_to_string(w[i : i + m - 1], ' ') AS win FROM bw),
sizes AS (SELECT DISTINCT m FROM bk),
dw AS (SELECT rid, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, sizes WHERE len(w) >= m),
dk AS (SELECT rid, m, i, array_to_string(w[i : i + m - 1], ' ') AS win FROM dw),
hits AS (SELECT rid, i, dk.m, item_id FROM dk JOIN bk ON dk.m = bk.m AND dk.win = bk.win),
places AS (SELECT rid, unnest(range(i, i + m)) AS p FROM hits),
n AS (SELECT rid, count(DISTINCT p) AS n_hit FROM places GROUP BY rid),
names AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM hits) GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON d.rid = n.rid LEFT JOIN names ON d.rid = names.rid"""

QUERIES = {"op6_decontaminate": (op6, OP6_SQL)}
