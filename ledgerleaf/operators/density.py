"""Topics by density: groups of any number and shape, and none for what lies between them.

The distance of two points is the largest of their own distance and the radius around each that
holds a few neighbours. Links come from the nearest-neighbour graph. They are taken in bands of
growing length; in each band what is connected already counts as one part, and every connected set of
parts is joined link by link in a task of its own (a spanning forest in rounds). Where two parts
that are both large enough meet, a topic splits (seen from the top); smaller parts only join. This
is the condensed tree, and the topics are those of its branches that last longest.

A band holds ``BAND`` links at most, and with them the largest set that one task joins. A part carries what its
branch has gathered, so that a branch is weighed against its descendants where it ends; which topic a branch
belongs to is then found by doubling steps towards the root. No part of the tree reaches the driver.
"""

from __future__ import annotations

from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerleaf.operators.graph import connected_parts
from ledgerleaf.operators.ordered import with_position
from ledgerleaf.operators.search import nearest
from ledgerleaf.session import checkpointed

BAND = 2_000_000
#: Distances below count as this, so that densities stay finite.
TOUCHING = 1e-6
#: Share of a branch's sum of densities that rounding may take.
ROUNDING = 1e-12


def neighbour_links(vectors: DataFrame, neighbours: int, linked: int) -> tuple[DataFrame, DataFrame]:
    """``id, vector, n, core`` of the distinct vectors and their links ``a, b, w``.

    ``vectors`` has ``id, vector``; copies are one point that counts ``n`` times. ``core`` is the radius that holds
    ``neighbours`` points, itself included; links go to the ``linked`` nearest points.
    """
    points = vectors.groupBy("vector").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))
    points = checkpointed(points.select("id", "vector", "n"))
    k = max(neighbours, linked) + 1
    near = nearest(points, "id", points, "id", k).select("query_id", "vec_id", F.sqrt("distance").alias("d"))
    near = near.join(points.select(F.col("id").alias("vec_id"), "n"), "vec_id")
    near = near.where("query_id <> vec_id").join(points.select(F.col("id").alias("query_id"), F.col("n").alias("_own")), "query_id")
    order = Window.partitionBy("query_id").orderBy("d", "vec_id")
    near = near.withColumn("held", F.col("_own") + F.sum("n").over(order)).withColumn("place", F.row_number().over(order))
    near = checkpointed(near)
    # Where the whole table has fewer points, the farthest of them bounds the radius.
    reach = F.coalesce(F.min(F.when(F.col("held") >= neighbours, F.col("d"))), F.max("d"))
    radius = near.groupBy("query_id").agg(reach.alias("_reach"))
    core = points.select("id", "n").join(radius.withColumnRenamed("query_id", "id"), "id", "left")
    core = core.select("id", F.when(F.col("n") >= neighbours, 0.0).otherwise(F.coalesce("_reach", F.lit(0.0))).alias("core"))
    points = checkpointed(points.join(core, "id"))
    radius = points.select("id", "core")
    links = near.where(F.col("place") <= linked)
    links = links.join(radius.select(F.col("id").alias("query_id"), F.col("core").alias("_p")), "query_id")
    links = links.join(radius.select(F.col("id").alias("vec_id"), F.col("core").alias("_q")), "vec_id")
    links = links.select(
        F.least("query_id", "vec_id").alias("a"), F.greatest("query_id", "vec_id").alias("b"),
        F.greatest("d", "_p", "_q", F.lit(TOUCHING)).alias("w"),
    )
    return points, links.groupBy("a", "b").agg(F.min("w").alias("w"))


class Branch(NamedTuple):
    """A branch that still grows: its points with those of its descendants, the sum of the densities ``1 / w`` at which they
    joined it (descendants: at which they ended), and the weight of the descendants that are topics so far."""

    name: str
    points: float
    density: float
    below: float

    def with_points(self, n: int, w: float) -> Branch:
        return self._replace(points=self.points + n, density=self.density + n / w)

    def chosen(self, born: float) -> tuple[bool, float]:
        """Whether the branch, which exists from a density on, outweighs its chosen descendants, and the larger weight.

        Its weight is what its points gain in density while it lasts; a branch that ends where it began weighs nothing, which
        rounding must not turn into less."""
        own = self.density - self.points * born
        return own >= self.below - ROUNDING * self.density, max(own, self.below)


def joined_parts(name: str, parts: list[tuple[int, int, Branch | None]], links: list[tuple[float, int, int]], size: int) -> list[tuple]:
    """Join a connected set of parts by its links, shortest first.

    ``parts`` are ``(part, points, branch)``. Returns rows ``(kind, part, branch, other, w, n, into, points, density, below)``:

    * ``fall``: the points of ``part``, so far without a branch, belong to ``branch`` from ``w`` on;
    * ``split``: two branches meet at ``w``; ``other`` is one of those that ``branch`` forks into, a topic if ``n`` is 1;
    * ``link``: a link of the spanning forest, of length ``w``;
    * ``root``: ``part`` is now a part of ``into``, which has ``n`` points and ends in ``branch`` with what that has gathered.
    """
    root = {p: p for p, _, _ in parts}
    count = {p: n for p, n, _ in parts}
    branch = {p: b for p, _, b in parts}
    waiting = {p: [p] if b is None else [] for p, _, b in parts}
    nothing = (0.0, 0.0, 0.0)
    out: list[tuple] = []
    made = 0

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def named() -> str:
        nonlocal made
        made += 1
        return f"{name}.{made}"

    def fall(members: list[int], into: str, w: float) -> None:
        out.extend(("fall", p, into, None, w, 0, 0, *nothing) for p in members)

    for w, a, b in sorted(links):
        a, b = sorted((find(a), find(b)))
        if a == b:
            continue
        out.append(("link", a, None, None, w, 0, 0, *nothing))
        one, other, members = branch[a], branch[b], waiting[a] + waiting[b]
        loose = (count[a] if one is None else 0) + (count[b] if other is None else 0)
        root[b] = a
        count[a] += count[b]
        if one is not None and other is not None:
            new, end, below = named(), 1 / w, 0.0
            for child in (one, other):
                picked, weight = child.chosen(end)
                out.append(("split", 0, new, child.name, w, int(picked), 0, *nothing))
                below += weight
            points = one.points + other.points
            branch[a] = Branch(new, points, points * end, below)
        elif one is not None or other is not None:
            branch[a] = (one if one is not None else other).with_points(loose, w)
            fall(members, branch[a].name, w)
            members = []
        elif count[a] >= size:
            branch[a] = Branch(named(), 0.0, 0.0, 0.0).with_points(loose, w)
            fall(members, branch[a].name, w)
            members = []
        waiting[a] = members
    for p, _, _ in parts:
        r = find(p)
        state = branch[r] or (None, *nothing)
        out.append(("root", p, state[0], None, 0.0, count[r], r, *state[1:]))
    return out


GATHERED = ["points", "density", "below"]
EVENTS = "kind string, part long, branch string, other string, w double, n long, into long, points double, density double, below double"


def _joiner(band: int, size: int):
    def join(key, own: pd.DataFrame, lines: pd.DataFrame) -> pd.DataFrame:
        held = [
            (int(p), int(n), None if pd.isna(b) else Branch(b, *state))
            for p, n, b, *state in zip(*(own[c] for c in ("part", "n", "branch", *GATHERED)))
        ]
        out = joined_parts(f"{band}.{int(key[0])}", held, list(zip(lines["w"], lines["p"], lines["q"])), size)
        return pd.DataFrame(out, columns=["kind", "part", "branch", "other", "w", "n", "into", *GATHERED])

    return join


def density_tree(points: DataFrame, links: DataFrame, size: int, single: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(assigned, forks, chosen links)``: ``id, branch, w`` of the points that belong to a branch; ``branch, child, born,
    picked`` of every branch as a child (of none at the root), the density from which it exists, and whether it outweighs its
    chosen descendants; and the lengths ``w`` of the links of the spanning forest.

    A part with ``size`` points is a branch. Points that never join one are missing from ``assigned``. The root of
    everything is no topic unless ``single``.
    """
    spark = points.sparkSession
    # Equal points are close enough: where they suffice they are a branch from the start.
    alone = F.when(F.col("n") >= size, F.concat(F.lit("0."), F.col("id").cast("string")))
    gathered = {"points": F.col("n").cast("double"), "density": F.col("n") / F.lit(TOUCHING), "below": F.lit(0.0)}
    parts = points.select(F.col("id").alias("part"), "n", alone.alias("branch"), *[v.alias(c) for c, v in gathered.items()])
    parts = checkpointed(parts)
    where = checkpointed(points.select("id", F.col("id").alias("part")))
    assigned = [parts.where(F.col("branch").isNotNull()).select(F.col("part").alias("id"), "branch", F.lit(TOUCHING).alias("w"))]
    forks, chosen = [], []
    links = checkpointed(links)
    total = links.count()
    bands = max(1, -(-total // BAND))
    edges = [r for r in (links.agg(F.percentile_approx("w", [i / bands for i in range(1, bands)], 100_000)).first()[0] if bands > 1 else [])]
    for number, (low, high) in enumerate(zip([0.0, *edges], [*edges, float("inf")]), 1):
        if low == high:
            continue
        band = links.where((F.col("w") > low) & (F.col("w") <= high))
        band = band.join(where.select(F.col("id").alias("a"), F.col("part").alias("p")), "a")
        band = band.join(where.select(F.col("id").alias("b"), F.col("part").alias("q")), "b").where("p <> q")
        band = band.groupBy(F.least("p", "q").alias("p"), F.greatest("p", "q").alias("q")).agg(F.min("w").alias("w"))
        band = checkpointed(band)
        sets = checkpointed(connected_parts(band.select(F.col("p").alias("a"), F.col("q").alias("b"))))
        inner = band.join(sets.select(F.col("node").alias("p"), F.col("root").alias("set")), "p")
        members = parts.join(sets.select(F.col("node").alias("part"), F.col("root").alias("own")), "part")

        events = members.groupBy("own").cogroup(inner.groupBy("set")).applyInPandas(_joiner(number, size), EVENTS)
        events = checkpointed(events)
        falls = events.where("kind = 'fall'").select("part", "branch", "w")
        assigned.append(checkpointed(where.join(falls, "part").select("id", "branch", "w")))
        split = events.where("kind = 'split'")
        forks.append(split.select("branch", F.col("other").alias("child"), (1 / F.col("w")).alias("born"), (F.col("n") == 1).alias("picked")))
        chosen.append(events.where("kind = 'link'").select("w"))
        roots = events.where("kind = 'root'").select("part", F.col("into").alias("_root"), "n", "branch", *GATHERED)
        where = checkpointed(where.join(roots.select("part", "_root"), "part", "left").select("id", F.coalesce("_root", "part").alias("part")))
        merged = roots.select(F.col("_root").alias("part"), "n", "branch", *GATHERED).distinct()
        parts = checkpointed(parts.join(roots.select("part"), "part", "left_anti").unionByName(merged))
    tops = parts.where(F.col("branch").isNotNull())
    alone = not single and tops.count() == 1
    kept = (F.col("density") * (1 + ROUNDING) >= F.col("below")) & F.lit(not alone)
    forks.append(tops.select(F.lit(None).cast("string").alias("branch"), F.col("branch").alias("child"), F.lit(0.0).alias("born"), kept.alias("picked")))

    def together(frames: list[DataFrame], schema: str) -> DataFrame:
        out = spark.createDataFrame([], schema)
        for f in frames:
            out = out.unionByName(f)
        return out

    kind = points.schema["id"].dataType.simpleString()
    return (
        together(assigned, f"id {kind}, branch string, w double"),
        together(forks, "branch string, child string, born double, picked boolean"), together(chosen, "w double"),
    )


def branch_topics(forks: DataFrame) -> DataFrame:
    """``branch, name, born``: the topic of every branch by the name of its topmost picked ancestor, itself included, or
    null, and the density from which that topic exists.

    ``forks`` are those of :func:`density_tree`. Every branch knows the best of its next ancestors and looks on from the last
    of them, so that the steps double; the number of rounds is the logarithm of the tree's depth.
    """
    own = [F.when(F.col("picked"), F.col(c)).alias(n) for c, n in (("child", "name"), ("born", "born"))]
    reached = checkpointed(forks.select(F.col("child").alias("branch"), F.col("branch").alias("above"), *own))
    while not reached.where(F.col("above").isNotNull()).isEmpty():
        higher = reached.select(
            F.col("branch").alias("above"), F.col("above").alias("_above"), F.col("name").alias("_name"), F.col("born").alias("_born")
        )
        found = reached.join(higher, "above", "left")
        better = F.col("_name").isNotNull()
        reached = checkpointed(found.select(
            "branch", F.col("_above").alias("above"), F.coalesce("_name", "name").alias("name"),
            F.when(better, F.col("_born")).otherwise(F.col("born")).alias("born"),
        ))
    return reached.select("branch", "name", F.coalesce("born", F.lit(0.0)).alias("born"))


class Topics:
    """Fitted topics: ``points`` (``id, vector, n, core, branch, topic``) and ``branches`` (``branch, topic, born``)."""

    def __init__(self, points: DataFrame, branches: DataFrame, neighbours: int):
        self.points, self.branches, self.neighbours = points, branches, neighbours


def fit_topics(vectors: DataFrame, neighbours: int = 10, size: int = 15, linked: int | None = None) -> tuple[DataFrame, Topics]:
    """``id, topic`` of every row of ``vectors`` (``id, vector``), and the fitted topics.

    Topics are numbered by size from 0; -1 is none. ``size`` points, two at least, make a topic, however many points there
    are. Rows with a null vector belong to no topic. Of links of equal length any may be taken first, which can move single points at the edge of a topic.
    """
    known = checkpointed(vectors.where(F.col("vector").isNotNull()).select("id", "vector"))
    size = max(size, 2)
    points, links = neighbour_links(known, neighbours, linked or 2 * neighbours)
    assigned, forks, _ = density_tree(points, links, size)
    placed = checkpointed(points.join(assigned, "id", "left"))
    named = checkpointed(branch_topics(forks))
    held = placed.join(named.where(F.col("name").isNotNull()).select("branch", "name"), "branch").groupBy("name")
    held = held.agg(F.sum("n").alias("n"), F.min("id").alias("first"))
    numbers = with_position(held, [F.desc("n"), F.asc("first")], "topic").select("name", F.col("topic").cast("int").alias("topic"))
    branches = named.join(numbers, "name", "left").select("branch", F.coalesce("topic", F.lit(-1)).alias("topic"), "born")
    branches = checkpointed(branches)
    placed = checkpointed(placed.join(branches.select("branch", "topic"), "branch", "left").fillna(-1, ["topic"]))
    found = known.join(placed.select("vector", "topic"), "vector").select("id", "topic")
    rest = vectors.where(F.col("vector").isNull()).select("id", F.lit(-1).alias("topic"))
    return found.unionByName(rest), Topics(placed, branches, neighbours)


def place_vectors(topics: Topics, vectors: DataFrame, key: str = "id") -> DataFrame:
    """``key, topic`` of new vectors, by the same distance: each joins its nearest point, if it is there dense enough
    for that point's topic; else it belongs to none."""
    queries = vectors.where(F.col("vector").isNotNull()).select(F.col(key).alias("query_id"), "vector")
    k = 2 * topics.neighbours
    near = nearest(topics.points.select("id", "vector"), "id", queries, "query_id", k).select("query_id", "vec_id", F.sqrt("distance").alias("d"))
    known = topics.points.select(F.col("id").alias("vec_id"), "n", F.col("core").alias("_q"), "branch")
    near = near.join(known, "vec_id")
    order = Window.partitionBy("query_id").orderBy("d", "vec_id")
    near = near.withColumn("held", F.sum("n").over(order) + 1)
    every = Window.partitionBy("query_id")
    own = F.min(F.when(F.col("held") >= topics.neighbours, F.col("d"))).over(every)
    near = near.withColumn("core", F.coalesce(own, F.max("d").over(every)))
    near = near.withColumn("w", F.greatest("d", "_q", "core", F.lit(TOUCHING)))
    best = near.groupBy("query_id").agg(F.min(F.struct("w", "d", "vec_id", "branch")).alias("m"))
    met = best.select("query_id", "m.w", "m.branch").join(topics.branches, "branch", "left")
    dense = (1 / F.col("w") >= F.col("born")) & F.col("topic").isNotNull()
    found = met.select(F.col("query_id").alias(key), F.when(dense, F.col("topic")).otherwise(F.lit(-1)).alias("topic"))
    rest = vectors.where(F.col("vector").isNull()).select(key, F.lit(-1).alias("topic"))
    return found.unionByName(rest)
