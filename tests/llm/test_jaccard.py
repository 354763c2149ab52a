import random

import numpy as np
import pytest

from sixfold.llm import jaccard
from sixfold.llm.jaccard import first_shingles, similar_documents, trie_links


def words_of(text):
    import re

    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def brute(rows, size, num, den):
    sets = []
    for _, text in rows:
        w = words_of(text)
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    comp = {i: r[0] for i, r in enumerate(rows)}
    changed = True
    links = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if sets[i] and sets[j] and rows[i][0] is not None and rows[j][0] is not None and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j])
    ]
    while changed:
        changed = False
        for i, j in links:
            low = min(comp[i], comp[j])
            for k in (i, j):
                if comp[k] != low:
                    comp[k], changed = low, True
    return sorted(((r[0], len(sets[i]), comp[i]) for i, r in enumerate(rows)), key=str)


def corpus(seed, families=12, size=18):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=30)
    rows = []
    for _ in range(families):
        base = rng.choices(vocabulary, k=rng.choice([2, 4, 5, 6, 9, 14, 30, 60, 200]))
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 18))):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                text = text + passage
            rows.append((len(rows) * 7 % 1009, rng.choice([" ", "\n", "\t "]).join(w.upper() if rng.random() < 0.1 else w for w in text)))
    return rows


@pytest.mark.parametrize("words, num, den, block", [(4, 85, 100, 256), (5, 80, 100, 4), (3, 60, 100, 3)])
def test_equals_brute_force(spark, monkeypatch, words, num, den, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = corpus(words) + [(5000, None), (5001, ""), (5002, " \n"), (None, "a b c d e f g"), (5003, "a b c d e f g"), (5003, "a b c d e f g")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in similar_documents(df, words, num, den).collect()), key=str)
    assert got == brute(rows, words, num, den)


def test_linked_sets_share_a_first_shingle():
    rng = np.random.default_rng(3)
    levels = rng.integers(0, 3, 1 << jaccard.BITS).astype(np.uint8)
    for num, den in ((85, 100), (80, 100), (50, 100)):
        for _ in range(400):
            n = int(rng.integers(1, 60))
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
            b = a.copy()
            for _ in range(int(rng.integers(0, 1 + len(a) // 4))):
                b = np.delete(b, rng.integers(len(b))) if rng.random() < 0.5 and len(b) > 1 else np.unique(np.append(b, rng.integers(0, 1 << 63, 1, dtype=np.uint64)))
            if den * len(np.intersect1d(a, b)) >= num * len(np.union1d(a, b)):
                shared = set(first_shingles(a, levels, num, den).tolist()) & set(first_shingles(b, levels, num, den).tolist())
                assert len(shared) >= jaccard.common(min(len(a), len(b))) >= max(jaccard.common(-(-num * len(x) // den)) for x in (a, b))


def test_trie_links_connect_what_all_pairs_connect():
    rng = random.Random(8)
    for _ in range(30):
        base = [sorted(rng.sample(range(500), rng.randint(1, 40))) for _ in range(4)]
        sets = []
        for _ in range(25):
            s = set(rng.choice(base))
            for _ in range(rng.randint(0, 3)):
                s ^= {rng.randrange(500)}
            if s:
                sets.append(np.array(sorted(s), np.uint64))
        expected = {(i, j) for i in range(len(sets)) for j in range(i) if 10 * len(np.intersect1d(sets[i], sets[j])) >= 8 * len(np.union1d(sets[i], sets[j]))}

        def parts(links):
            label = list(range(len(sets)))
            for _ in sets:
                for i, j in links:
                    label[i] = label[j] = min(label[i], label[j])
            return label

        assert parts(trie_links(sets, list(range(len(sets))), 8, 10)) == parts(expected)


def test_empty_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert similar_documents(empty).count() == 0
    clash = spark.createDataFrame([(1, "a b c", 5, 6), (2, "a b c", 7, 8)], "doc_id bigint, text string, node int, family int")
    assert [r.component_id for r in similar_documents(clash).collect()] == [1, 1]
    kept = jaccard.keep_one(clash)
    assert kept.columns == clash.columns and [r.node for r in kept.collect()] == [5]


def test_keep_one_of_repeated_ids_and_nulls(spark):
    copy, own, other = "p q r s t u v", "k l m n o p q r", "zz yy xx ww vv uu"
    stay = [(2, copy, "x"), (5, own, "x"), (7, other, "x"), (8, None, "x"), (8, None, "y"), (8, " \n", "x"), (None, None, "x"), (None, None, "y"), (None, copy, "x"), (None, copy, "y"), (None, copy, "y")]
    go = [(5, copy, "x"), (7, copy, "x"), (9, copy.upper(), "y")]
    same = [(1, "a b c d e f g", "x"), (1, "a b c d e f g", "y")]
    docs = spark.createDataFrame(stay + go + same, "doc_id bigint, text string, source string").repartition(3)
    got = [tuple(r) for r in jaccard.keep_one(docs).collect()]
    assert sorted((r for r in got if r not in same), key=str) == sorted(stay, key=str) and sum(r in same for r in got) == 1
