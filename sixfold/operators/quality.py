"""What a database would enforce, as a report; table counts; feeds as tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sixfold import schema
from sixfold.operators.ordered import same_key


def _report(df: DataFrame, table: str, rule: str) -> DataFrame:
    return df.select(F.lit(table).alias("table"), F.lit(rule).alias("rule"), F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations"))


def duplicate_keys(df: DataFrame, table: str, key: Sequence[str], kind: str = "primary key") -> DataFrame:
    """Keys that occur more than once (keys with a NULL are left to the null check)."""
    whole = df.dropna(subset=list(key)).groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return _report(whole.agg(F.count_if(F.col("_n") > 1).alias("violations")), table, f"{kind} {','.join(key)}")


def orphans(df: DataFrame, table: str, column: str, parent: DataFrame, parent_name: str, parent_column: str) -> DataFrame:
    """Rows whose foreign key has no parent. Values are counted before the join, so a frequent value travels once per task."""
    values = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    known = parent.select(F.col(parent_column).alias("_value")).distinct()
    lost = values.join(known, "_value", "left_anti").agg(F.sum("_n").alias("violations"))
    return _report(lost, table, f"foreign key {column} -> {parent_name}.{parent_column}")


def row_rules(
    df: DataFrame, table: str, required: Sequence[str] = (), json: Sequence[str] = (), vectors: Mapping[str, int] | None = None
) -> DataFrame:
    """Missing values, text that is no JSON, and vectors of a wrong length, all in one scan of the table."""
    checks = {f"not null {c}": F.count_if(F.col(c).isNull()) for c in required}
    checks |= {f"json {c}": F.count_if(F.col(c).isNotNull() & F.try_parse_json(c).isNull()) for c in json}
    checks |= {f"length {c} = {n}": F.count_if(F.col(c).isNotNull() & (F.size(c) != n)) for c, n in (vectors or {}).items()}
    counted = df.agg(F.array(*[F.struct(F.lit(rule).alias("rule"), n.alias("violations")) for rule, n in checks.items()]).alias("_rules"))
    return counted.select(F.inline("_rules")).select(F.lit(table).alias("table"), "rule", F.col("violations").cast("bigint").alias("violations"))


class Rule(NamedTuple):
    """One rule about a table of a report: ``kind`` is primary key, unique, foreign key, not null, json or length."""

    source: str
    kind: str
    columns: tuple[str, ...]
    parent: tuple[str, str] = ("", "")  # of a foreign key: table, column
    length: int = 0
    table: str = ""  # the names to report, if others
    parent_name: str = ""

    def text(self) -> str:
        names = ",".join(self.columns)
        if self.kind == "foreign key":
            return f"{self.kind} {names} -> {self.parent_name or self.parent[0]}.{self.parent[1]}"
        return f"length {names} = {self.length}" if self.kind == "length" else f"{self.kind} {names}"


WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _as_text(df: DataFrame, name: str) -> Column:
    """Equal values as equal texts."""
    kind = df.schema[name].dataType
    return (F.col(name) + F.lit(0.0) if isinstance(kind, (T.FloatType, T.DoubleType)) else F.col(name)).cast("string")


def rule_report(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """``table, rule, violations`` for every rule, in one scan of each table and one shuffle.

    Each row is opened into what it says to the rules: (key space, role, key). The rows of a table with a key have role 0 in its space,
    rows that refer to it one role per reference, so repeated keys and missing parents are both seen where the entries of a key meet.
    Entries are counted before they travel, so a frequent key is one row per task. A row that breaks a rule of its own (a missing
    value, text that is no JSON, a vector of a wrong length) sends an entry without a key; the others send none.

    A key with a NULL takes no part (the null rule sees it). A foreign key has its parent's type, or both are whole numbers. Empty
    tables break no rule but have a row for each; a rule that is given twice is reported twice.
    """
    spaces: dict[tuple[str, tuple[str, ...]], int] = {}
    roles: dict[int, list[int]] = {}  # for each space the foreign keys in the order of their roles
    says: dict[str, list[Column]] = {}
    space_of = lambda source, columns: spaces.setdefault((source, tuple(columns)), len(spaces))
    entry = lambda space, role, key: F.struct(F.lit(space).alias("space"), F.lit(role).alias("role"), key.alias("key"))
    nothing = F.lit(None).cast("array<string>")
    broken: dict[int, list[tuple[int, Column]]] = {}  # for each space its rules and their violations, of a key's counts
    n = lambda role: F.col(f"_{role}")

    for i, rule in enumerate(rules):
        df = tables[rule.source]
        if rule.kind in ("primary key", "unique"):
            broken.setdefault(space_of(rule.source, rule.columns), []).append((i, (n(0) > 1).cast("bigint")))
        elif rule.kind == "foreign key":
            (column,), (parent, parent_column) = rule.columns, rule.parent
            kinds = [df.schema[column].dataType, tables[parent].schema[parent_column].dataType]
            if kinds[0] != kinds[1] and not all(isinstance(k, WHOLE) for k in kinds):
                raise TypeError(f"{rule.source}.{column} is {kinds[0].simpleString()}, {parent}.{parent_column} is {kinds[1].simpleString()}")
            space = space_of(parent, [parent_column])
            roles.setdefault(space, []).append(i)
            role = len(roles[space])
            key = F.array(_as_text(df, column))
            says.setdefault(rule.source, []).append(F.when(F.col(column).isNotNull(), entry(space, role, key)))
            broken.setdefault(space, []).append((i, F.when(n(0) == 0, n(role)).otherwise(0)))
        else:
            c = F.col(rule.columns[0])
            bad = {"not null": c.isNull(), "json": c.isNotNull() & F.try_parse_json(c).isNull(), "length": c.isNotNull() & (F.size(c) != rule.length)}[rule.kind]
            says.setdefault(rule.source, []).append(F.when(bad, entry(-1 - i, 0, nothing)))
            broken[-1 - i] = [(i, n(0))]
    for (source, columns), space in spaces.items():
        df = tables[source]
        known = reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in columns])
        says.setdefault(source, []).append(F.when(known, entry(space, 0, F.array(*[_as_text(df, c) for c in columns]))))

    said = [tables[source].select(F.inline(F.filter(F.array(*entries), lambda e: e.isNotNull()))) for source, entries in says.items()]
    many = max(map(len, roles.values()), default=0)
    counted = reduce(DataFrame.unionByName, said).groupBy("space", "key").agg(*[F.count_if(F.col("role") == r).alias(f"_{r}") for r in range(many + 1)])
    found = None
    for space, parts in broken.items():
        each = F.array(*[F.struct(F.lit(i).alias("number"), violations.alias("n")) for i, violations in parts])
        found = F.when(F.col("space") == space, each) if found is None else found.when(F.col("space") == space, each)
    sums = counted.select(F.inline(F.filter(found, lambda e: e.n > 0))).groupBy("number").agg(F.sum("n").alias("violations"))
    named = [F.struct(F.lit(i).alias("number"), F.lit(r.table or r.source).alias("table"), F.lit(r.text()).alias("rule")) for i, r in enumerate(rules)]
    spark = next(iter(tables.values())).sparkSession
    return spark.range(1).select(F.inline(F.array(*named))).join(sums, "number", "left").select("table", "rule", F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations"))


def warehouse_rules(names: Iterable[str]) -> list[Rule]:
    """Every key, reference and column rule of the named warehouse tables."""
    rules = []
    for table in names:
        key = schema.PRIMARY_KEYS[table]
        rules.append(Rule(table, "primary key", key))
        if table in schema.UNIQUE_KEYS:
            rules.append(Rule(table, "unique", schema.UNIQUE_KEYS[table]))
        rules += [Rule(table, "not null", (c,)) for c in dict.fromkeys([*key, *schema.REQUIRED.get(table, ())])]
        if table == "f1_raw_documents":
            rules.append(Rule(table, "json", ("payload",)))
        if table == "f1_messages":
            rules.append(Rule(table, "length", ("embedding",), length=schema.VECTOR_LENGTH))
        rules += [Rule(table, "foreign key", (column,), parent=(parent, parent_column)) for column, parent, parent_column in schema.FOREIGN_KEYS.get(table, ())]
    return rules


def constraint_report(t: Mapping[str, DataFrame]) -> DataFrame:
    """``table, rule, violations`` for every key, reference and column rule of the warehouse."""
    return rule_report(t, warehouse_rules(t))


def violating_rows(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """All rows whose key occurs more than once, or has a NULL."""
    repeated = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    broken = repeated.where((F.col("_n") > 1) | reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])).drop("_n")
    rows, bad = df.alias("r"), broken.alias("b")
    return rows.join(bad, same_key([F.col(f"r.{k}") for k in key], [F.col(f"b.{k}") for k in key]), "left_semi")


def table_counts(t: Mapping[str, DataFrame | None], kinds: Sequence[tuple[str, str]] = schema.TABLE_KINDS) -> DataFrame:
    """``table_name, table_type, row_count``; a table that is not there counts 0, the type goes by the name's prefix."""
    spark = next(df.sparkSession for df in t.values() if df is not None)
    parts = []
    for name, df in t.items():
        source = spark.range(1).select(F.lit(0).cast("bigint").alias("row_count")) if df is None else df.agg(F.count(F.lit(1)).alias("row_count"))
        parts.append(source.select(F.lit(name).alias("table_name"), "row_count"))
    kind = F.lit("Other")
    for prefix, label in reversed(kinds):
        kind = F.when(F.col("table_name").startswith(prefix), F.lit(label)).otherwise(kind)
    return reduce(DataFrame.unionByName, parts).withColumn("table_type", kind)


def write_feed(df: DataFrame, root: str, name: str) -> str:
    """Store the table behind a chart as parquet."""
    path = f"{root}/{name}"
    df.write.mode("overwrite").parquet(path)
    return path
