"""Graph load, edge upsert, neighbours, path patterns and breadth-first traversal.

Vertices have an id column (``rid``), edges the endpoint columns ``out`` and ``in``. A hub vertex may
own a large part of all edges, so edges always look their (unique) endpoints up through the
skew-safe join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlake.functions.links import RID_PATTERN
from recordlake.operators.load import assign_rids, bulk_load, ranged_load
from recordlake.operators.skew import join_to_one
from recordlake.operators.update import WriteResult
from recordlake.session import stored
from recordlake.sources.ranged import Merged, RangedTable

# Most endpoint records the bounded side of create_edges may hold.
MAX_ENDPOINTS = 10_000
# Largest frontier, in counted vertices, that is sent to every task.
MAX_BROADCAST_FRONTIER = 100_000


@dataclass
class GraphLoad:
    vertices: DataFrame
    edges: DataFrame
    id_map: DataFrame
    outcome: DataFrame


def graph_load(
    records: DataFrame, stored_rids: DataFrame | None = None, buckets: int = 8, next_pos: dict[int, int] | None = None
) -> GraphLoad:
    """Load vertices with temporary ids, then edges between temporary ids or rids.

    ``records``: seq, kind (vertex/edge), type, temp_id, from_ref, to_ref and property columns. A
    vertex after an edge is an error for the whole load. A repeated temporary id fails
    (``duplicate_temp_id``), and so does an edge end that resolves to nothing (``unresolved_ref``);
    a rid end is checked against ``stored_rids`` when given.
    """
    is_vertex = F.col("kind") == "vertex"
    order = records.agg(
        F.max(F.when(is_vertex, F.col("seq"))).alias("last_vertex"),
        F.min(F.when(~is_vertex, F.col("seq"))).alias("first_edge"),
    ).first()
    if order["last_vertex"] is not None and order["first_edge"] is not None and order["last_vertex"] > order["first_edge"]:
        raise ValueError("all vertex records must come before any edge record")
    body = [c for c in records.columns if c not in ("kind", "temp_id", "from_ref", "to_ref")]
    asked = records.where(is_vertex)
    firsts = asked.groupBy("temp_id").agg(F.min("seq").alias("_first"))
    marked = join_to_one(asked, firsts, ["temp_id"], "left").withColumn(
        "_fresh", F.coalesce(F.col("seq") == F.col("_first"), F.lit(True))
    )
    key = F.coalesce(F.col("temp_id"), F.concat(F.lit("\u0000"), F.col("seq").cast("string")))
    created = stored(assign_rids(
        marked.where("_fresh").withColumn("_key", key), ["_key"], buckets, next_pos).drop("_key", "_first", "_fresh"))
    id_map = created.where("temp_id IS NOT NULL").select("temp_id", "rid")
    edges = _resolve(_resolve(records.where(~is_vertex), id_map, stored_rids, "from_ref", "out"), id_map, stored_rids, "to_ref", "in")
    good = F.col("out").isNotNull() & F.col("in").isNotNull()
    code = F.lit("unresolved_ref")
    outcome = (
        marked.select("seq", F.lit("vertex").alias("kind"), F.when(F.col("_fresh"), "created").otherwise("failed").alias("action"),
                      F.when(~F.col("_fresh"), F.lit("duplicate_temp_id")).alias("code"))
        .unionByName(edges.select("seq", F.lit("edge").alias("kind"), F.when(good, "created").otherwise("failed").alias("action"),
                                  F.when(~good, code).alias("code")))
    )
    return GraphLoad(created.select("rid", "temp_id", *body), edges.where(good).select("out", "in", *body), id_map, outcome)


def _resolve(edges: DataFrame, id_map: DataFrame, rids: DataFrame | None, ref: str, name: str) -> DataFrame:
    found = join_to_one(edges, id_map.select(F.col("temp_id").alias(ref), F.col("rid").alias("_rid")), [ref], "left")
    is_rid = F.col(ref).rlike(RID_PATTERN)
    if rids is not None:
        known = rids.select(F.col("rid").alias(ref)).distinct().withColumn("_known", F.lit(True))
        found = join_to_one(found, known, [ref], "left")
        is_rid = is_rid & F.coalesce(F.col("_known"), F.lit(False))
    resolved = F.coalesce(F.col("_rid"), F.when(is_rid, F.col(ref)))
    return found.withColumn(name, resolved).drop("_rid", "_known")


def bidirectional(edges: DataFrame) -> DataFrame:
    """Both-way adjacency: every edge and its reverse, with a ``direction``."""
    forward = edges.withColumn("direction", F.lit("out"))
    swapped = {"out": "in", "in": "out"}
    reverse = edges.select(*[F.col(c).alias(swapped.get(c, c)) for c in edges.columns], F.lit("in").alias("direction"))
    return forward.unionByName(reverse)


def upsert_edges(base: DataFrame, incoming: DataFrame, row_index: str = "row_index", keys: Sequence[str] = ("out", "in")) -> WriteResult:
    """Create or update the edge identified by its two ends.

    Null properties are not given; an incoming edge without any property leaves an existing edge as
    it is. The ends themselves never change.
    """
    return bulk_load(base, incoming, list(keys), "UPDATE", row_index=row_index)


def upsert_stored_edges(edges: RangedTable, incoming: DataFrame, row_index: str = "row_index") -> tuple[DataFrame, Merged]:
    """``upsert_edges`` into stored edges in the order of their ends: files that hold none of the batch's edges stay as they are."""
    return ranged_load(edges, incoming, "UPDATE", row_index=row_index)


def create_edges(sources: DataFrame, targets: DataFrame, source_id: str = "rid", target_id: str = "rid", limit: int = MAX_ENDPOINTS) -> DataFrame:
    """An edge from every source to every target.

    One side must be small: it is read up to ``limit`` + 1 ids and refused beyond, then every row of
    the other side is expanded by that list. Nothing is shuffled.
    """
    small = [r[0] for r in targets.select(target_id).distinct().limit(limit + 1).collect()]
    if len(small) <= limit:
        ids = F.array(*[F.lit(v) for v in small]) if small else F.array().cast("array<string>")
        return sources.select(F.col(source_id).alias("out")).distinct().withColumn("in", F.explode(ids))
    small = [r[0] for r in sources.select(source_id).distinct().limit(limit + 1).collect()]
    if len(small) <= limit:
        ids = F.array(*[F.lit(v) for v in small]) if small else F.array().cast("array<string>")
        return targets.select(F.col(target_id).alias("in")).distinct().select(F.explode(ids).alias("out"), "in")
    raise ValueError(f"create_edges needs one side of at most {limit} records")


def out(vertices: DataFrame, edges: DataFrame, target: DataFrame | None = None, rid: str = "rid") -> DataFrame:
    """(source, neighbour) over edges leaving the given vertices; with ``target`` its columns too."""
    return _step(vertices, edges, "out", "in", target, rid)


def in_(vertices: DataFrame, edges: DataFrame, target: DataFrame | None = None, rid: str = "rid") -> DataFrame:
    return _step(vertices, edges, "in", "out", target, rid)


def both(vertices: DataFrame, edges: DataFrame, target: DataFrame | None = None, rid: str = "rid") -> DataFrame:
    return out(vertices, edges, target, rid).unionByName(in_(vertices, edges, target, rid))


def _step(vertices, edges, near: str, far: str, target, rid: str) -> DataFrame:
    chosen = vertices.select(F.col(rid).alias(near)).distinct()
    hits = join_to_one(edges.select(near, far), chosen, [near], "inner").select(
        F.col(near).alias("source"), F.col(far).alias("neighbour")
    )
    if target is None:
        return hits
    return join_to_one(hits, target.withColumnRenamed(rid, "neighbour"), ["neighbour"], "inner")


def out_e(vertices: DataFrame, edges: DataFrame, rid: str = "rid") -> DataFrame:
    """Edges leaving the given vertices."""
    return join_to_one(edges, vertices.select(F.col(rid).alias("out")).distinct(), ["out"], "left_semi")


def in_e(vertices: DataFrame, edges: DataFrame, rid: str = "rid") -> DataFrame:
    return join_to_one(edges, vertices.select(F.col(rid).alias("in")).distinct(), ["in"], "left_semi")


def expand(df: DataFrame, column: str, target: DataFrame, key: str = "rid") -> DataFrame:
    """A link column, or each link of a list column, as the record it points at."""
    listed = df.schema[column].dataType.typeName() == "array"
    links = df.withColumn(column, F.explode(column)) if listed else df
    body = [F.col(c).alias(c if c not in df.columns else f"{column}_{c}") for c in target.columns if c != key]
    return join_to_one(links, target.select(F.col(key).alias(column), *body), [column], "inner")


def delete_incident(edges: DataFrame, vertices: DataFrame, rid: str = "rid") -> WriteResult:
    """Remove every edge that touches a chosen vertex."""
    chosen = vertices.select(F.col(rid).alias("out")).distinct()
    kept = join_to_one(edges, chosen, ["out"], "left_anti")
    kept = join_to_one(kept, chosen.withColumnRenamed("out", "in"), ["in"], "left_anti")
    before = edges.agg(F.count(F.lit(1)).alias("n")).scalar()
    outcome = kept.agg(F.count(F.lit(1)).alias("edges_kept")).select("edges_kept", (before - F.col("edges_kept")).alias("edges_deleted"))
    return WriteResult(kept, outcome)


@dataclass(frozen=True)
class Hop:
    """One edge of a pattern: the edge table, its direction, and the vertex it leads to."""

    edges: DataFrame
    direction: str = "out"
    target: DataFrame | None = None
    name: str = "v"
    where: Column | None = None
    edge_where: Column | None = None


def match_path(start: DataFrame, hops: Sequence[Hop], name: str = "a", rid: str = "rid", where: Column | None = None) -> DataFrame:
    """Rows matching a fixed pattern start -hop-> v1 -hop-> v2 …

    Vertex columns come out as ``<name>_<column>``, edge properties as ``<hop name>_e_<column>``.
    Vertex and edge tests are applied before each join.
    """
    chosen = start.where(where) if where is not None else start
    paths = chosen.select(*[F.col(c).alias(f"{name}_{c}") for c in chosen.columns])
    last = f"{name}_{rid}"
    for hop in hops:
        near, far = ("out", "in") if hop.direction == "out" else ("in", "out")
        edges = hop.edges.where(hop.edge_where) if hop.edge_where is not None else hop.edges
        next_id = f"{hop.name}_{rid}"
        step = edges.select(
            F.col(near).alias(last), F.col(far).alias(next_id),
            *[F.col(c).alias(f"{hop.name}_e_{c}") for c in edges.columns if c not in ("out", "in")],
        )
        # Ids repeat on both sides here; the edges of a hub are spread, its paths repeated per salt.
        paths = join_to_one(step, paths, [last], "inner")
        if hop.target is not None:
            vertex = hop.target.where(hop.where) if hop.where is not None else hop.target
            renamed = vertex.select(*[F.col(c).alias(f"{hop.name}_{c}") for c in vertex.columns])
            paths = join_to_one(paths, renamed, [next_id], "inner")
        last = next_id
    return paths


def traverse(seeds: DataFrame, edges: DataFrame, max_depth: int, rid: str = "rid", direction: str = "out") -> DataFrame:
    """Breadth-first walk: every reached vertex once, with the first depth it was reached at.

    The edges are written out once. Each round joins them to the frontier (broadcast only when it
    has been counted and is small), keeps unseen vertices once, and writes the new frontier to the
    shared folder, so lineage stays short and a lost executor redoes one round.
    """
    links = stored(edges.select("out", "in"), "edges")
    ways = {"out": [("out", "in")], "in": [("in", "out")], "both": [("out", "in"), ("in", "out")]}[direction]
    visited = stored(seeds.select(F.col(rid).alias("rid")).distinct().withColumn("depth", F.lit(0)))
    frontier, size = visited, visited.count()
    for depth in range(1, max_depth + 1):
        found = [_neighbours(links, frontier, size, near, far) for near, far in ways]
        reached = reduce(DataFrame.unionByName, found).distinct()
        frontier = stored(
            reached.join(visited.select("rid"), ["rid"], "left_anti").withColumn("depth", F.lit(depth)))
        size = frontier.count()
        if size == 0:
            break
        visited = visited.unionByName(frontier)
    return visited


def _neighbours(edges: DataFrame, frontier: DataFrame, size: int, near: str, far: str) -> DataFrame:
    chosen = frontier.select(F.col("rid").alias(near))
    if size <= MAX_BROADCAST_FRONTIER:
        hits = edges.join(F.broadcast(chosen), [near], "left_semi")
    else:
        hits = join_to_one(edges, chosen, [near], "left_semi")
    return hits.select(F.col(far).alias("rid"))
