"""Text hashes on texts that collide in sums modulo a power of two, and operators on the same texts."""

import numpy as np
import pyarrow as pa
import pytest

from sixfold.llm import decontaminate, jaccard, lines, quality, repeats
from sixfold.llm.textscan import LOWER, SPACED, VALUES, Texts, Words, powers, remainder, run_hash, span_hash, sums


def thue_morse(n: int, a: str = "a", b: str = "b") -> tuple[str, str]:
    word = [bin(i).count("1") % 2 for i in range(n)]
    return "".join((a, b)[x] for x in word), "".join((b, a)[x] for x in word)


@pytest.mark.parametrize("n", [512, 1024, 2048, 4096])
def test_no_structure_collides(n):
    one, other = thue_morse(n)
    texts = Texts(pa.array([one, other, one, one + "a"]))
    h = Words(texts, SPACED).hashes(texts)
    assert h[0] == h[2] and len(set(h.tolist())) == 3
    words = np.array([7, 11], np.uint64)
    runs = [np.array([words[int(c == "a")] for c in w], np.uint64) for w in (one, other)]
    assert run_hash(runs[0], np.array([0]), n) != run_hash(runs[1], np.array([0]), n)


def test_against_whole_numbers():
    rng = np.random.default_rng(3)
    buf = rng.integers(0, 256, 5000).astype(np.uint8)
    c = sums(buf, VALUES[LOWER])
    start = rng.integers(0, 4000, 300)
    end = start + rng.integers(0, 900, 300)
    h = span_hash(c, start, end)
    seen = {}
    for a, b, x in zip(start, end, h):
        raw = bytes(LOWER[buf[a:b]])
        assert seen.setdefault(raw, x) == x
        moved = np.concatenate([rng.integers(0, 256, int(rng.integers(0, 50))).astype(np.uint8), buf[a:b]])
        assert span_hash(sums(moved, VALUES[LOWER]), np.array([len(moved) - (b - a)]), np.array([len(moved)]))[0] == x
    assert len(set(seen.values())) == len(seen)
    x = rng.integers(0, 1 << 64, 1000, dtype=np.uint64)
    assert remainder(x).tolist() == [int(v) % ((1 << 31) - 1) for v in x]
    assert all((up[:100] * down[:100] % np.uint64((1 << 31) - 1) == 1).all() for up, down in powers(100))


def test_operators_tell_them_apart(spark):
    one, other = thue_morse(1024)
    docs = spark.createDataFrame([(1, f"{one}\n{other}"), (2, one), (3, other), (4, one), (5, f"x {other} y")], "doc_id bigint, text string")
    counts = quality.statistics(Texts(pa.array([f"{one}\n{other}\n{one}"])))
    assert counts["n_dup_lines"].tolist() == [1]
    component = {r.doc_id: r.component_id for r in jaccard.similar_documents(docs).collect()}
    assert component == {1: 1, 2: 2, 3: 3, 4: 2, 5: 5}
    bench = spark.createDataFrame([(9, other)], "item_id bigint, text string")
    hits = {r.doc_id: len(r["__spans"]) for r in decontaminate.find_items(docs, bench).collect()}
    assert hits == {1: 1, 2: 0, 3: 1, 4: 0, 5: 1}
    removed = {r.doc_id: r.n_removed for r in repeats.remove_repeats(docs, 1000).collect()}
    assert removed[2] == removed[4] == 1024 and removed[3] == 1024 and removed[1] < 1024
    assert {r.doc_id: r["__n_dropped"] for r in lines.drop_shared_lines(docs).collect()} == {1: 0, 2: 1, 3: 1, 4: 1, 5: 0}
