"""The Merkle manifest against a plain tree, with trees of one to many superblocks, nulls, ties and clashing names."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from sixfold.llm import manifest

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, tree string, pos int, node string, block int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def value(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def climb(nodes):
    """The top, and for each leaf the (left, right) digests on its way."""
    ways, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(places):
            run = p // 3 * 3
            ways[i].append((nodes[run:p], nodes[p + 1 : run + 3]))
        nodes = [h(*nodes[k : k + 3]) for k in range(0, len(nodes), 3)]
        places = [p // 3 for p in places]
    return nodes[0], ways


def expected(rows):
    leaf = lambda r, text: h(*map(value, (r[0], r[1], r[2], r[3], text)))
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        trees[s] = climb([leaf(r, r[4]) for r in groups[s]])
    root, above = climb([trees[s][0] for s in names])
    out = []
    for s, up in zip(names, above):
        for r, way in zip(groups[s], trees[s][1]):
            bad = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            now = leaf(r, r[4].replace("\n", "") if bad else r[4])
            for left, right in way + up:
                now = h(*left, now, *right)
            proof = h(*[x for left, right in way + up for x in left + right])
            out.append((str(r[0]), leaf(r, r[4]), trees[s][0], root, proof, now, now == root))
    return sorted(out)


def proofs(df, **how):
    leaf = lambda text: manifest.leaf_digest([*map(F.col, ("doc_id", "source", "lang", "n_chars")), text])
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    changed = leaf(F.when(tampered, F.translate("text", "\n", "")).otherwise(F.col("text")))
    made = manifest.manifest(df, "source", "doc_id", leaf(F.col("text")), changed, **how)
    return sorted((str(r.id), r.leaf, r.subroot, r.root, h(*r.proof), r.folded_root, r.verified) for r in made.collect())


@pytest.fixture(scope="module")
def rows():
    extra = ("x", 1, "y", 2)
    out = [((1 << 60) + i * 7 % 101, "hot", "en", i, f"line {i}\nüber\n", *extra) for i in range(101)]
    out += [(i, f"s{i % 14}", None, None, f"{i}\n" * (i % 4), *extra) for i in range(200, 232)]
    out += [(300, None, "de", 1, "null source", *extra), (301, None, None, None, None, *extra), (None, None, "de", 1, "a\nb", *extra)]
    out += [(400, "", "en", 0, "", *extra), (401, "ü", "en", 2, "\n" * 50_000, *extra), (402, "+", "-", 3, "x", *extra), out[3], out[3], (out[3][0], "hot", "en", 9, "same id\n", *extra)]
    return out


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_against_a_plain_tree(spark, rows, levels):
    assert proofs(spark.createDataFrame(rows, SCHEMA).repartition(3), block_levels=levels) == expected(rows)


@pytest.mark.parametrize("n", [0, 1, 3, 10])
def test_small_trees(spark, n):
    rows = [(i, "a", "en", 1, f"{i}\n", None, None, None, None) for i in range(n)]
    assert proofs(spark.createDataFrame(rows, SCHEMA), block_levels=1) == (expected(rows) if rows else [])


def test_values_cannot_run_into_each_other(spark):
    df = spark.createDataFrame([("1:-", None), ("1", ":-"), (None, "1:-"), ("", "")], "a string, b string")
    assert df.select(manifest.leaf_digest([F.col("a"), F.col("b")])).distinct().count() == 4
