"""Language of a text by unigram models over a fixed vocabulary of pieces, summed over all segmentations."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sixfold.llm.textscan import LOWER, VALUES, Texts, Words, extend, span_hash, sums

#: Path of the vocabulary; a parameter of ``predict_language``.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Words are scored together in blocks of so many rows and bytes (rows x longest word) at most; a longer word alone, by its positions.
ROWS, CELLS = 4096, 1 << 19
#: Positions after which the sums are scaled to 1, so that no length underflows.
SCALE = 16
#: Documents per language that the models are fitted on, about.
MAX_DOCS = 1_500
ROUNDS = 3
#: Words whose scores a task remembers.
REMEMBERED = 1_000_000

#: Words are runs of letters: A-Z, a-z and everything outside ASCII.
LETTERS = np.zeros(256, bool)
LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_MARK = 32  # a word's first byte in the pieces: a space


def __getattr__(name: str) -> int:
    """``LONGEST``: bytes of the longest piece of ``VOCABULARY`` that can stand in a word, with the mark of a word's start."""
    if name != "LONGEST":
        raise AttributeError(name)
    return vocabulary(VOCABULARY).longest


class Vocabulary:
    """The pieces as hashes; every single byte is one of them, so each word has a segmentation."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        found = {bytes([b]) for b in range(256)}
        for i in range(model.vocab_size()):
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
                piece = bytes(LOWER[np.frombuffer(model.id_to_piece(i).replace("▁", " ").encode(), np.uint8)])
                if piece:
                    found.add(piece)
        pieces = sorted(found)
        raw, length = np.frombuffer(b"".join(pieces), np.uint8), np.array([len(p) for p in pieces])
        end = np.cumsum(length)
        self.size = len(pieces)
        inside = [p for p in pieces if LETTERS[np.frombuffer(p[p[0] == _MARK :], np.uint8)].all()]  # the others never stand in a word
        self.sizes = sorted({len(p) for p in inside})
        self.longest = self.sizes[-1]
        h = span_hash(sums(raw, VALUES), end - length, end)
        self.order = np.argsort(h)
        self.hashes = h[self.order]
        self.maybe = np.zeros(1 << 20, bool)  # most spans are no piece: this tells it cheaply
        self.maybe[h >> np.uint64(44)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are pieces, and the numbers of these pieces."""
        at = np.flatnonzero(self.maybe[h >> np.uint64(44)])
        place = np.minimum(np.searchsorted(self.hashes, h[at]), self.size - 1)
        hit = self.hashes[place] == h[at]
        return at[hit], self.order[place[hit]]


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def blocks(words: list[bytes]):
    """Places in ``words`` of words of similar length, long ones first."""
    length = np.array([len(w) for w in words])
    order, at = np.argsort(-length, kind="stable"), 0
    while at < len(order):
        n = max(1, min(ROWS, CELLS // (int(length[order[at]]) + 1)))
        yield order[at : at + n]
        at += n


def lattice(voc: Vocabulary, words: list[bytes]):
    """Yield (start, rows, ends, pieces) for the starts of all pieces in the words, which are sorted by falling length, in order.

    The mark of a word's start is its first byte. Pieces are looked up for ``CELLS`` starts at once.
    """
    raw = np.frombuffer(b"".join(b" " + w for w in words), np.uint8)
    c = sums(raw, VALUES)
    length = np.array([len(w) + 1 for w in words])
    base = np.cumsum(length) - length
    first, most = 0, int(length[0])
    while first < most:
        active = int(np.searchsorted(-length, -first))  # words longer than ``first``
        last = min(most, first + max(1, CELLS // active))
        row = np.repeat(np.arange(active), np.minimum(length[:active], last) - first)
        count = np.bincount(row, minlength=active)
        start = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + first
        hits = []
        for size in voc.sizes:
            at = np.flatnonzero(start + size <= length[row])
            here = base[row[at]] + start[at]
            hit, piece = voc.find(span_hash(c, here, here + size))
            at = at[hit]
            hits.append((start[at], row[at], start[at] + size, piece))
        start, row, stop, piece = (np.concatenate(x) for x in zip(*hits))
        order = np.argsort(start, kind="stable")
        row, stop, piece = row[order], stop[order], piece[order]
        cuts = np.searchsorted(start[order], np.arange(first, last + 1))
        for i, a, b in zip(range(first, last), cuts[:-1].tolist(), cuts[1:].tolist()):
            yield i, row[a:b], stop[a:b], piece[a:b]
        first = last


def log_likelihood(voc: Vocabulary, words: list[bytes], p: np.ndarray) -> np.ndarray:
    """Log probability of each word in each language: the forward algorithm over all segmentations. ``p`` is pieces x languages.

    Only the sums that a piece can still reach are kept, and they are scaled on the way: a word may have any length.
    """
    out = np.zeros((len(words), p.shape[1]))
    ring = voc.longest + 1
    for at in blocks(words):
        block = [words[k] for k in at]
        ends = np.array([len(w) + 1 for w in block])
        alpha, log = np.zeros((ring, len(at), p.shape[1])), np.zeros((len(at), p.shape[1]))
        alpha[0] = 1
        for i, rows, stop, piece in lattice(voc, block):
            # An end and a row meet at one start once, so no sum is lost.
            alpha[stop % ring, rows] += alpha[i % ring, rows] * p[piece]
            alpha[i % ring] = 0
            done = slice(*np.searchsorted(-ends, [-(i + 1), -i]))
            if done.start < done.stop:
                out[at[done]] = np.log(alpha[(i + 1) % ring, done]) + log[done]
            if i % SCALE == SCALE - 1:
                top = alpha[:, : done.start].max(0)
                alpha[:, : done.start] /= top
                log[: done.start] += np.log(top)
    return out


def expected_counts(voc: Vocabulary, words: list[bytes], times: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Expected uses of each piece over all segmentations of the words under the piece probabilities ``p``.

    The logarithms of all sums of a block of words are kept, and its lattice.
    """
    out = np.zeros(voc.size)
    ring = voc.longest + 1
    for at in blocks(words):
        block = [words[k] for k in at]
        steps, ends = list(lattice(voc, block)), np.array([len(w) + 1 for w in block])
        n, every = int(ends[0]), np.arange(len(at))
        before, after = np.full((n + 1, len(at)), -np.inf), np.full((n + 1, len(at)), -np.inf)
        with np.errstate(divide="ignore"):  # sums far below the others of their window may be 0
            alpha, log = np.zeros((ring, len(at))), np.zeros(len(at))
            alpha[0], before[0] = 1, 0
            for i, rows, stop, piece in steps:
                alpha[stop % ring, rows] += alpha[i % ring, rows] * p[piece]
                alpha[i % ring] = 0
                open_ = int(np.searchsorted(-ends, -i))  # words longer than i
                before[i + 1, :open_] = np.log(alpha[(i + 1) % ring, :open_]) + log[:open_]
                if i % SCALE == SCALE - 1:
                    still = int(np.searchsorted(-ends, -(i + 1)))
                    top = alpha[:, :still].max(0)
                    alpha[:, :still] /= top
                    log[:still] += np.log(top)
            beta, log = np.zeros((ring, len(at))), np.zeros(len(at))
            beta[ends % ring, every] = 1
            after[ends, every] = 0
            for i, rows, stop, piece in reversed(steps):
                sums_ = np.bincount(rows, weights=beta[stop % ring, rows] * p[piece], minlength=len(at))
                open_ = int(np.searchsorted(-ends, -i))
                beta[i % ring, :open_] = sums_[:open_]
                after[i, :open_] = np.log(sums_[:open_]) + log[:open_]
                if i % SCALE == 0:
                    top = beta[:, :open_].max(0)
                    beta[:, :open_] /= top
                    log[:open_] += np.log(top)
        whole, weight, log_p = before[ends, every], times[at], np.log(p)
        for some in range(0, len(steps), 256):
            part = steps[some : some + 256]
            start = np.repeat([s[0] for s in part], [len(s[1]) for s in part])
            rows, stop, piece = (np.concatenate([s[k] for s in part]) for k in (1, 2, 3))
            use = np.exp(before[start, rows] + log_p[piece] + after[stop, rows] - whole[rows]) * weight[rows]
            out += np.bincount(piece, weights=use, minlength=voc.size)
    return out


def letter_runs(texts: Texts) -> tuple[Words, np.ndarray]:
    """The words and their hashes."""
    words = Words(texts, LETTERS)
    return words, words.hashes(texts)


def spelled(texts: Texts, words: Words, at: np.ndarray) -> list[bytes]:
    low = LOWER[texts.buf].tobytes()
    return [low[a:b] for a, b in zip(words.start[at].tolist(), words.end[at].tolist())]


def fit_language(texts: Texts, path: str, rounds: int = ROUNDS) -> np.ndarray:
    """Piece probabilities of one language by expectation maximisation, from equal ones."""
    voc = vocabulary(path)
    words, h = letter_runs(texts)
    _, first, times = np.unique(h, return_index=True, return_counts=True)
    distinct = spelled(texts, words, first)
    p = np.full(voc.size, 1 / voc.size)
    for _ in range(rounds):
        count = expected_counts(voc, distinct, times, p) + 0.1
        p = count / count.sum()
    return p


class Scorer:
    """Adds up word scores per text and remembers the scores of words, up to ``REMEMBERED``."""

    def __init__(self, path: str, languages: list[str], p: np.ndarray):
        self.path, self.languages, self.p = path, languages, p
        self._forget()

    def _forget(self) -> None:
        self.known, self.scores = np.zeros(0, np.uint64), np.zeros((0, len(self.languages)))

    def totals(self, texts: Texts) -> np.ndarray:
        words, h = letter_runs(texts)
        distinct, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        place = np.minimum(np.searchsorted(self.known, distinct), max(len(self.known) - 1, 0))
        old = self.known[place] == distinct if len(self.known) else np.zeros(len(distinct), bool)
        score = np.empty((len(distinct), len(self.languages)))
        score[old] = self.scores[place[old]]
        if not old.all():
            score[~old] = log_likelihood(vocabulary(self.path), spelled(texts, words, first[~old]), self.p)
            if len(self.known) > REMEMBERED:
                self._forget()
            known, scores = np.concatenate([self.known, distinct[~old]]), np.concatenate([self.scores, score[~old]])
            order = np.argsort(known)
            self.known, self.scores = known[order], scores[order]
        out = np.zeros((texts.n, len(self.languages)))
        for k in range(len(self.languages)):
            out[:, k] = np.bincount(words.text, weights=score[inverse, k], minlength=texts.n)
        return out

    def predict(self, texts: Texts) -> tuple[list[str], np.ndarray]:
        total = self.totals(texts) if self.languages else np.zeros((texts.n, 1))
        best = total.argmax(1)
        share = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
        names = [self.languages[b] if self.languages and has_letter(texts, i) else "und" for i, b in enumerate(best)]
        return names, np.where([n == "und" for n in names], 0.0, share)


def has_letter(texts: Texts, i: int) -> bool:
    raw = texts.buf[texts.at[i] : texts.at[i + 1]]
    if LETTERS[:128][raw[raw < 128]].any():
        return True
    return bool((raw >= 128).any()) and any(c.isalpha() for c in raw.tobytes().decode(errors="replace"))


def predict_language(docs: DataFrame, learn: DataFrame, path: str = VOCABULARY, max_docs: int = MAX_DOCS) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the posterior of that language among the learned ones (equal priors).

    ``docs`` has ``text``. ``learn`` has ``doc_id, text, lang``: for each language about ``max_docs`` of its documents, chosen by a
    hash of the id, go to one task that fits its piece probabilities; null texts, ids and languages are left out. A text of which no
    character is a letter, or null, is ``und`` with score 0; so is everything if nothing could be learned. Upper and lower case of
    A-Z are the same. ``path`` must lead to the same vocabulary file on every machine. Texts are never shuffled but for the sample.
    """
    usable = learn.where("text IS NOT NULL AND lang IS NOT NULL AND doc_id IS NOT NULL")
    sizes = {r.lang: r["count"] for r in usable.groupBy("lang").count().collect()}  # one row per language
    models: list[tuple[str, np.ndarray]] = []
    if sizes:
        chance = F.get(F.map_values(F.map_filter(F.create_map(*[x for name, n in sizes.items() for x in (F.lit(name), F.lit(min(1.0, max_docs / n)))]), lambda k, _: k == F.col("lang"))), F.lit(0))
        unit = F.shiftrightunsigned(F.xxhash64(F.lit(9), "doc_id"), 11) / F.lit(float(1 << 53))
        sample = usable.where(unit < chance).select("lang", "text")

        def fit(pdf):
            import pandas as pd

            p = fit_language(Texts(pa.array(sorted(pdf["text"]), pa.large_string())), path)
            return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "p": [p.astype(np.float64).tobytes()]})

        models = sorted((r.lang, np.frombuffer(bytes(r.p))) for r in sample.groupBy("lang").applyInPandas(fit, "lang string, p binary").collect())
    p = np.stack([m for _, m in models], 1) if models else np.zeros((0, 0))
    scorer = docs.sparkSession.sparkContext.broadcast(Scorer(path, [name for name, _ in models], p))

    def work(_, texts: Texts) -> dict:
        names, score = scorer.value.predict(texts)
        return {"lang_pred": names, "score": score}

    return extend(docs, work, {"lang_pred": ("string", pa.string()), "score": ("double", pa.float64())})


def op9(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("held_out", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    found = predict_language(docs.select("doc_id", "held_out", "text"), docs.where("NOT held_out").select("doc_id", "text", "lang"))
    return found.select("doc_id", F.coalesce("held_out", F.lit(False)).alias("held_out"), "lang_pred", "score")


QUERIES = {"op9_language_id": (op9, None)}
