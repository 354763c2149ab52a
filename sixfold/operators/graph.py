"""Property graph over tables, fixed-hop patterns as joins, and the overtaking network."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Vertices:
    """A vertex table: one row per key."""

    rows: DataFrame
    key: str
    properties: Sequence[str]


@dataclass(frozen=True)
class Edges:
    """An edge table between two vertex labels."""

    rows: DataFrame
    source: str
    source_key: str
    target: str
    target_key: str
    properties: Sequence[str] = ()


@dataclass(frozen=True)
class PropertyGraph:
    """Named vertex and edge tables; nothing is copied."""

    vertices: Mapping[str, Vertices]
    edges: Mapping[str, Edges]

    def match(self, start: str, edge: str, alias: str, end: str, reverse: bool = False) -> Pattern:
        """Start a pattern with one hop ``(start) -[alias IS edge]-> (end)``, or ``<-`` with ``reverse``."""
        labels, hop = self._hop(edge, alias, start, end, reverse)
        return Pattern(self, hop, labels)

    def _hop(self, edge: str, alias: str, start: str, end: str, reverse: bool) -> tuple[dict[str, str], DataFrame]:
        e = self.edges[edge]
        ends = [(e.source, e.source_key), (e.target, e.target_key)]
        (label_1, key_1), (label_2, key_2) = reversed(ends) if reverse else ends
        # A property that the edge also uses as a key keeps its own column, named after the edge.
        properties = [F.col(p).alias(f"{alias}.{p}") for p in e.properties]
        linked = e.rows.where(F.col(key_1).isNotNull() & F.col(key_2).isNotNull())
        return {start: label_1, end: label_2}, linked.select(F.col(key_1).alias(start), F.col(key_2).alias(end), *properties)


@dataclass(frozen=True)
class Pattern:
    """A partial match: one column per vertex variable (its key) and ``alias.property`` per edge property."""

    graph: PropertyGraph
    rows: DataFrame
    labels: Mapping[str, str] = field(default_factory=dict)

    def hop(self, start: str, edge: str, alias: str, end: str, reverse: bool = False, same: Mapping[str, str] | None = None) -> Pattern:
        """Extend the match over one more edge from a bound variable.

        ``same`` maps a property of the new edge to a bound column it must equal, e.g. ``{"event_id": "dt1.event_id"}``.
        """
        labels, step = self.graph._hop(edge, alias, start, end, reverse)
        if end in self.rows.columns:
            raise ValueError(f"{end} is already bound")
        condition = F.col(f"l.`{start}`") == F.col(f"r.`{start}`")
        for prop, bound in (same or {}).items():
            condition = condition & (F.col(f"r.`{alias}.{prop}`") == F.col(f"l.`{bound}`"))
        joined = self.rows.alias("l").join(step.alias("r"), condition)
        added = [F.col(f"r.`{c}`") for c in step.columns if c != start]
        return Pattern(self.graph, joined.select("l.*", *added), {**self.labels, **labels})

    def where(self, condition: Column) -> Pattern:
        return Pattern(self.graph, self.rows.where(condition), self.labels)

    def columns(self, **wanted: str) -> DataFrame:
        """Output columns: ``out="variable.property"`` for vertices or edges. Only the vertex tables asked for are joined."""
        rows, selected = self.rows, []
        for variable, label in self.labels.items():
            asked = {o: p.split(".", 1)[1] for o, p in wanted.items() if p.split(".", 1)[0] == variable}
            if not asked:
                continue
            v = self.graph.vertices[label]
            unknown = set(asked.values()) - {v.key, *v.properties}
            if unknown:
                raise ValueError(f"{label} has no {sorted(unknown)}")
            table = v.rows.select(F.col(v.key).alias(variable), *[F.col(p).alias(f"{variable}.{p}") for p in sorted(set(asked.values()))])
            rows = rows.join(table, variable)
        for out, path in wanted.items():
            selected.append(F.col(f"`{path}`").alias(out))
        return rows.select(*selected)


def racing_graph(t: Mapping[str, DataFrame]) -> PropertyGraph:
    """Drivers, teams and events; who drives for whom and who takes part in what."""
    return PropertyGraph(
        vertices={
            "driver": Vertices(t["dim_driver"], "driver_id", ("driver_id", "driver_code", "full_name", "driver_number")),
            "team": Vertices(t["dim_team"], "team_id", ("team_id", "team_name", "team_code")),
            "event": Vertices(t["dim_event"], "event_id", ("event_id", "session_id", "season", "gp_name", "session_name")),
        },
        edges={
            "drives_for": Edges(t["bridge_driver_team"], "driver", "driver_id", "team", "team_id", ("event_id",)),
            "participates_in": Edges(
                t["fact_result"], "driver", "driver_id", "event", "event_id", ("event_id", "final_position", "points", "status_id")
            ),
        },
    )


def teammates(graph: PropertyGraph, same_event: bool = True) -> DataFrame:
    """``(d1)-[drives_for]->(t)<-[drives_for]-(d2)``, each pair once; within one event unless ``same_event=False``."""
    same = {"event_id": "dt1.event_id"} if same_event else None
    found = graph.match("d1", "drives_for", "dt1", "t").hop("t", "drives_for", "dt2", "d2", reverse=True, same=same)
    return found.where(F.col("d1") < F.col("d2")).columns(
        driver1_code="d1.driver_code",
        driver1_name="d1.full_name",
        team_name="t.team_name",
        driver2_code="d2.driver_code",
        driver2_name="d2.full_name",
    )


def driver_network(graph: PropertyGraph, same_event: bool = True) -> DataFrame:
    """``(d)-[drives_for]->(t), (d)-[participates_in]->(e)`` with the result's position and points."""
    same = {"event_id": "dt.event_id"} if same_event else None
    found = graph.match("d", "drives_for", "dt", "t").hop("d", "participates_in", "p", "e", same=same)
    return found.columns(
        driver_code="d.driver_code",
        driver_name="d.full_name",
        team_name="t.team_name",
        final_position="p.final_position",
        points="p.points",
    )


def unordered_pairs(df: DataFrame, group: Sequence[str], member: str) -> DataFrame:
    """Each pair of members of a group once, smaller key first.

    The pairs are the result asked for, so the group must be small by its nature (a team within one event). The join is on the
    group, and a skewed group is split by adaptive execution.
    """
    one = df.select(*group, F.col(member).alias(f"{member}_1"))
    two = df.select(*group, F.col(member).alias(f"{member}_2"))
    return one.join(two, list(group)).where(F.col(f"{member}_1") < F.col(f"{member}_2"))


def overtakes(laps: DataFrame, changes: DataFrame, event: str = "event_id", driver: str = "driver_id") -> DataFrame:
    """How often each driver took a place held by another.

    A driver who moves from ``pos_before`` up to ``pos_after`` overtakes whoever held ``pos_after .. pos_before - 1`` on the lap
    before. Each such place is looked up by (event, lap, position), a unique key, instead of joining all drivers of a lap.
    """
    holders = (
        laps.where(F.col("position").isNotNull())
        .groupBy(event, "lap_number", "position")
        .agg(F.min(driver).alias("overtaken_id"))
    )
    gains = changes.where("pos_after < pos_before")
    places = gains.select(
        event, F.col(driver).alias("overtaker_id"), "lap_number", F.explode(F.sequence("pos_after", F.col("pos_before") - 1)).alias("position")
    )
    pairs = places.join(holders, [event, "lap_number", "position"]).where("overtaker_id != overtaken_id")
    return pairs.groupBy(event, "overtaker_id", "overtaken_id").agg(F.count(F.lit(1)).alias("weight"))


def edge_weights(edges: DataFrame) -> DataFrame:
    """Each weight as a share of the largest."""
    return edges.withColumn("normalized", F.col("weight") / edges.agg(F.max("weight").alias("_max")).scalar())


def net_gains(edges: DataFrame, event: str = "event_id") -> DataFrame:
    """Per driver: overtakes made minus overtakes suffered."""
    ends = F.array(
        F.struct(F.col("overtaker_id").alias("driver_id"), F.col("weight").alias("change")),
        F.struct(F.col("overtaken_id").alias("driver_id"), (-F.col("weight")).alias("change")),
    )
    # One scan of the edges: each counts for one end and against the other.
    return edges.select(event, F.inline(ends)).groupBy(event, "driver_id").agg(F.sum("change").alias("net_gain"))
