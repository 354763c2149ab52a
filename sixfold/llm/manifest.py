"""A Merkle manifest of a dataset: a tree of digests per group, the groups' roots in a tree of their own, and a proof per row.

Rows are cut into superblocks of ``WIDTH ** LEVELS`` consecutive leaves. Bottom up, each superblock is reduced to one node, and
the nodes are the leaves of the next round. Top down, the nodes that a superblock needs from outside are sent to it, and leaves and
outer nodes meet by superblock in ``applyInPandas``, where the local reduction is finished, proofs are joined and rows are folded. A
task never holds more than one superblock, and only one small row per round and partition reaches the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from functools import reduce as fold_left

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sixfold.llm.store import cut

#: Children of a node.
WIDTH = 3
#: Levels of the tree inside one superblock, unless the caller says otherwise: 3 ** 6 = 729 leaves.
LEVELS = 6


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(columns: Sequence[Column]) -> Column:
    """One text that no other row of values has: ``-`` for a null, else the number of UTF-8 bytes, ``:`` and the value."""
    values = [c.cast("string") for c in columns]
    return F.concat(*[F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values])


def leaf_digest(columns: Sequence[Column]) -> Column:
    return F.sha2(encoded(columns), 256)


def numbered(rows: DataFrame, tree: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add ``pos``, the place from 0 of a row in its tree, and ``n``, the rows of that tree. ``rows`` must be fixed (read back).

    Rows are dealt to ranges of (tree, order), so a tree of any size is spread over tasks; a place is the rows of its tree in the ranges
    before plus the place in the own range. Only one row per tree and range is counted over.
    """
    keys = [*tree, *order]
    ranged = cut(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    counts = ranged.groupBy(*tree, part.alias("part")).agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    before = Window.partitionBy(*tree).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*tree)
    starts = counts.select(
        *[F.col(c).alias(f"s_{c}") for c in tree], "part", "first", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"), F.sum("rows").over(whole).alias("n")
    )
    same = fold_left(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"s_{c}")) for c in tree], F.col("p") == F.col("part"))
    met = ranged.withColumn("p", part).join(starts, same)
    return met.select(*rows.columns, (F.col("start") + F.col("at") - F.col("first")).alias("pos"), "n")


def levels_of(n: int, most: int) -> int:
    """Levels that a superblock of a tree with ``n`` nodes has: ``most``, or fewer where the whole tree is one superblock."""
    levels, nodes = 0, n
    while nodes > 1 and levels < most:
        levels, nodes = levels + 1, -(-nodes // WIDTH)
    return levels


def reduced(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes of each level, from the leaves to the top."""
    out = [nodes]
    for _ in range(levels):
        last = out[-1]
        out.append([digest("".join(last[i : i + WIDTH])) for i in range(0, len(last), WIDTH)])
    return out


def siblings(tree: list[list[str]], at: int) -> list[str]:
    """For each level below the top what stands left and what stands right of the node on the way up, as two texts."""
    out = []
    for level in tree[:-1]:
        first = at // WIDTH * WIDTH
        out += ["".join(level[first:at]), "".join(level[at + 1 : first + WIDTH])]
        at //= WIDTH
    return out


def folded(leaf: str, path: list[str]) -> str:
    for k in range(0, len(path), 2):
        leaf = digest(path[k] + leaf + path[k + 1])
    return leaf


def tops(nodes: DataFrame, most: int) -> DataFrame:
    """One round up: the superblocks of ``nodes`` (``tree, pos, n, node``) as nodes of the next round."""
    size = WIDTH**most

    def top(key, block: pd.DataFrame) -> pd.DataFrame:
        n = int(block["n"].iloc[0])
        node = reduced(block.sort_values("pos")["node"].tolist(), levels_of(n, most))[-1][0]
        return pd.DataFrame({"tree": [key[0]], "pos": [key[1]], "n": [-(-n // size)], "node": [node]})

    block = F.floor(F.col("pos") / size).cast("bigint").alias("block")
    return nodes.select("tree", "pos", "n", "node").groupBy("tree", block).applyInPandas(top, "tree string, pos bigint, n bigint, node string")


def exchanged(nodes: DataFrame, outer: DataFrame, work: Callable, schema: str, most: int) -> DataFrame:
    """Cogroup the nodes of each superblock with its row of ``outer`` (``tree, pos, path, subroot, root``).

    ``work(block, paths, above)`` makes the result from the nodes in order, each one's way up to the root, and that row.
    """
    size = WIDTH**most

    def meet(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        block, top = block.sort_values("pos"), above.iloc[0]
        levels, path = reduced(block["node"].tolist(), levels_of(int(block["n"].iloc[0]), most)), list(top["path"])
        return work(block, [siblings(levels, i) + path for i in range(len(block))], top)

    left = nodes.withColumn("block", F.floor(F.col("pos") / size).cast("bigint"))
    right = outer.withColumnRenamed("pos", "block")
    return left.groupBy("tree", "block").cogroup(right.groupBy("tree", "block")).applyInPandas(meet, schema)


def rounds_up(leaves: DataFrame, most: int) -> list[DataFrame]:
    """The nodes of all rounds, from the leaves to one node per tree."""
    rounds = [leaves]
    while (rounds[-1].agg(F.max("n")).first()[0] or 0) > 1:
        rounds.append(cut(tops(rounds[-1], most)))
    return rounds


def rounds_down(rounds: list[DataFrame], outer: DataFrame, most: int) -> DataFrame:
    """The outer row of each superblock of leaves; ``outer`` holds those of the trees' tops."""

    def down(block: pd.DataFrame, paths: list[list[str]], above) -> pd.DataFrame:
        return pd.DataFrame({"tree": block["tree"], "pos": block["pos"], "path": paths, "subroot": above["subroot"], "root": above["root"]})

    for nodes in reversed(rounds[1:]):
        outer = cut(exchanged(nodes, outer, down, OUTER, most))
    return outer


#: What a superblock needs from outside: digests left and right of the way up from its top, two texts a level, and where it leads.
OUTER = "tree string, pos bigint, path array<string>, subroot string, root string"


def manifest(rows: DataFrame, group: str, order: str, leaf: Column, changed: Column, block_levels: int = LEVELS) -> DataFrame:
    """A proof per row: ``id`` (the column ``order``), ``tree`` (``group`` as text), ``leaf, subroot, root, proof, folded_root, verified``.

    The rows of one group in ascending order of ``order`` are the leaves of a tree: while several nodes remain, every three
    consecutive ones (the last run: what is left, even one) become their digest; what remains is the ``subroot``. The subroots, in
    bytewise order of the group, likewise give ``root``. ``proof`` holds, level by level from the leaf to the root, the digests left and
    right of the node on the way up (two texts a level). ``folded_root`` is what ``changed``, a digest found anew, gives with that proof;
    ``verified`` says whether it is the root.

    Null is a group of its own and comes first, as does a row with a null ``order``. Rows of equal order stand by their digests, and
    equal rows are separate leaves. An empty table gives no rows. Other columns of ``rows`` may have any names.
    """
    # Texts are read once and leave here as two digests; the row's number tells equal rows apart.
    leaves = cut(rows.select(F.col(f"`{order}`").alias("id"), F.col(f"`{group}`").cast("string").alias("tree"), leaf.alias("node"), changed.alias("now"), F.monotonically_increasing_id().alias("row")))
    # In pandas a null would turn whole numbers into fractions, so ids travel as text.
    first = cut(numbered(leaves, ["tree"], ["id", "node", "now", "row"]).select("tree", "pos", "n", "node", "now", F.col("id").cast("string").alias("id")))
    rounds = rounds_up(first, block_levels)

    subroots = rounds[-1].select(F.lit("").alias("all"), F.col("tree").alias("name"), "node")
    roots = rounds_up(cut(numbered(subroots, ["all"], ["name"]).withColumnRenamed("all", "tree")), block_levels)
    none = F.array().cast("array<string>")
    peak = roots[-1].select("tree", "pos", none.alias("path"), F.lit(None).cast("string").alias("subroot"), F.col("node").alias("root"))

    def below_root(block: pd.DataFrame, paths: list[list[str]], above) -> pd.DataFrame:
        return pd.DataFrame({"tree": block["name"], "pos": 0, "path": paths, "subroot": block["node"], "root": above["root"]})

    above_groups = cut(exchanged(roots[0], rounds_down(roots, peak, block_levels), below_root, OUTER, block_levels))

    def finish(block: pd.DataFrame, paths: list[list[str]], above) -> pd.DataFrame:
        made = {"id": block["id"], "tree": block["tree"], "leaf": block["node"], "subroot": above["subroot"], "root": above["root"], "proof": paths}
        return pd.DataFrame(made | {"folded_root": [folded(x, path) for x, path in zip(block["now"], paths)]})

    schema = "id string, tree string, leaf string, subroot string, root string, proof array<string>, folded_root string"
    made = exchanged(first, rounds_down(rounds, above_groups, block_levels), finish, schema, block_levels)
    return made.withColumns({"id": F.col("id").cast(rows.schema[order].dataType), "verified": F.col("folded_root") == F.col("root")})


def op11(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = ["doc_id", "source", "lang", "n_chars"]
    leaf = lambda text: leaf_digest([*[F.col(c) for c in columns], text])
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    changed = leaf(F.when(tampered, F.translate("text", "\n", "")).otherwise(F.col("text")))
    return manifest(docs, "source", "doc_id", leaf(F.col("text")), changed).select(
        F.col("id").cast("long").alias("doc_id"), "leaf", "subroot", "root", F.sha2(F.array_join("proof", ""), 256).alias("proof_sha256"), "folded_root", "verified"
    )


_VALUE = "CASE WHEN {0} IS NULL THEN '-' ELSE octet_length(encode({0}::VARCHAR)) || ':' || {0}::VARCHAR END"
_LEAF = "sha256(" + " || ".join(_VALUE.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"
#: Bit by bit: the byte enters before the first of its eight steps. 3988292384 is the polynomial, 4294967295 the start and the final mask.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(8 * length(doc_id::VARCHAR)), lambda k:
  CASE WHEN k % 8 = 0 THEN 256 + ascii(substr(doc_id::VARCHAR, (k // 8 + 1)::INT, 1)) ELSE 0 END::BIGINT)),
  lambda c, b: xor(xor(c, b & 255) >> 1, CASE WHEN xor(c, b & 255) & 1 = 1 THEN 3988292384 ELSE 0 END::BIGINT)), 4294967295::BIGINT)"""


def _tree_sql(name: str, leaves: str) -> str:
    """CTEs ``name`` (every node of every level: tree, level, pos, node, n of the level) over leaves (tree, pos, node)."""
    return f"""{name} AS (
  SELECT tree, 0 AS level, pos, node, count(*) OVER (PARTITION BY tree) AS n FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, pos // {WIDTH}, sha256(string_agg(node, '' ORDER BY pos)), any_value((n + {WIDTH - 1}) // {WIDTH})
  FROM {name} WHERE n > 1 GROUP BY tree, level, pos // {WIDTH})"""


OP11_SQL = f"""WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, source, {_LEAF.format(text="text")} AS leaf, CASE WHEN ({_CRC}) % 2 = 0 THEN {_LEAF.format(text="replace(text, chr(10), '')")} ELSE {_LEAF.format(text="text")} END AS now,
         coalesce('+' || source, '') AS tree FROM documents),
f AS MATERIALIZED (SELECT *, leaf AS node, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
{_tree_sql("nodes", "f")},
s AS MATERIALIZED (SELECT tree AS name, node, '' AS tree, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos FROM nodes WHERE n = 1),
{_tree_sql("upper", "s")},
steps AS MATERIALIZED (
  SELECT tree, level, pos // {WIDTH} AS run, list(node ORDER BY pos) AS run_nodes FROM nodes WHERE n > 1 GROUP BY ALL),
upper_steps AS MATERIALIZED (
  SELECT level, pos // {WIDTH} AS run, list(node ORDER BY pos) AS run_nodes FROM upper WHERE n > 1 GROUP BY ALL),
inner_walk AS (
  SELECT tree, pos AS leaf_pos, pos, 0 AS level, '' AS proof, now AS h FROM f
  UNION ALL
  SELECT w.tree, leaf_pos, w.pos // {WIDTH}, w.level + 1,
         proof || array_to_string(list_concat(run_nodes[:w.pos % {WIDTH}], run_nodes[w.pos % {WIDTH} + 2:]), ''),
         sha256(array_to_string(list_concat(run_nodes[:w.pos % {WIDTH}], [h], run_nodes[w.pos % {WIDTH} + 2:]), ''))
  FROM inner_walk w JOIN steps t ON t.tree = w.tree AND t.level = w.level AND t.run = w.pos // {WIDTH}),
ended AS MATERIALIZED (SELECT tree, leaf_pos, max_by(proof, level) AS proof, max_by(h, level) AS h FROM inner_walk GROUP BY ALL),
outer_walk AS (
  SELECT e.tree, leaf_pos, s.pos, 0 AS level, proof, h FROM ended e JOIN s ON s.name = e.tree
  UNION ALL
  SELECT w.tree, leaf_pos, w.pos // {WIDTH}, w.level + 1,
         proof || array_to_string(list_concat(run_nodes[:w.pos % {WIDTH}], run_nodes[w.pos % {WIDTH} + 2:]), ''),
         sha256(array_to_string(list_concat(run_nodes[:w.pos % {WIDTH}], [h], run_nodes[w.pos % {WIDTH} + 2:]), ''))
  FROM outer_walk w JOIN upper_steps t ON t.level = w.level AND t.run = w.pos // {WIDTH}),
done AS (SELECT tree, leaf_pos, max_by(proof, level) AS proof, max_by(h, level) AS folded_root FROM outer_walk GROUP BY ALL),
top AS (SELECT node AS root FROM upper WHERE n = 1)
SELECT doc_id, leaf, s.node AS subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified
FROM f JOIN s ON s.name = f.tree JOIN done ON done.tree = f.tree AND done.leaf_pos = f.pos CROSS JOIN top"""

QUERIES = {"op11_merkle_manifest": (op11, OP11_SQL)}
