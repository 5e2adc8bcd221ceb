"""Connected components and exact linking of rows that share keys, without listing all pairs of a group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridframe.llm.common import BROADCAST_BYTES, ROW_BYTES, drop_stored, join_small, release, stored

#: Stars that are drawn in turn around the keys before what is left is compared pair by pair.
STARS = 2
#: Rounds in which each id tries rows drawn from its keys, after these, and how many.
DRAWS, TRIES = 2, 8
#: Rows on each side of a cell, where a key is compared pair by pair.
SIDE = 256
#: Bytes of a row of an id and its component, where it is broadcast; twice, as the driver builds two such tables at once.
_LABEL = 2 * (ROW_BYTES + 16)


def _least_labels(edges: DataFrame) -> DataFrame:
    """id, comp of a graph (a, b): least label of the neighbours and pointer jumping until nothing changes."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    own = edges.select(F.explode(F.array("a", "b")).alias("a")).distinct().withColumn("b", F.col("a"))
    edges = stored(both.unionByName(own), "edges")
    labels = stored(edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("comp")), "labels")
    size = _LABEL * labels.count()
    while True:
        # An edge to itself brings a row's own label, so one grouping gives the least label around and the one before.
        seen = join_small(edges, labels.select(F.col("id").alias("b"), "comp"), ["b"], "inner", size)
        seen = seen.groupBy(F.col("a").alias("id")).agg(F.min("comp").alias("near"), F.max(F.when(F.col("a") == F.col("b"), F.col("comp"))).alias("comp"))
        # A label is the id of a row itself, so its own label is a step further towards the least one.
        up = join_small(seen, labels.select(F.col("id").alias("near"), F.col("comp").alias("up")), ["near"], "left", size)
        new = stored(up.select("id", F.least("near", "up").alias("new"), "comp").select("id", F.col("new").alias("comp"), (F.col("new") < F.col("comp")).alias("moved")), "labels")
        drop_stored(labels)
        labels = new
        if size > BROADCAST_BYTES // 16:  # each round leaves the tables that it broadcast
            release(labels.sparkSession)
        if not new.where("moved").limit(1).count():
            drop_stored(edges)
            return labels.select("id", "comp")


def components(edges: DataFrame, labels: DataFrame | None = None) -> DataFrame | None:
    """id, comp (smallest id reachable) of every id in edges (a, b), on top of components known before; None without any."""
    if labels is not None:
        size = _LABEL * labels.count()
        edges = join_small(edges, labels.select(F.col("id").alias("a"), F.col("comp").alias("ca")), ["a"], "left", size)
        edges = join_small(edges, labels.select(F.col("id").alias("b"), F.col("comp").alias("cb")), ["b"], "left", size)
        edges = edges.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    edges = stored(edges.where("a <> b").distinct(), "contracted")
    if not edges.limit(1).count():
        return labels
    roots = _least_labels(edges)
    drop_stored(edges)
    if labels is None:
        return roots
    many = _LABEL * roots.count()
    moved = join_small(labels, roots.select(F.col("id").alias("comp"), F.col("comp").alias("root")), ["comp"], "left", many).select("id", F.coalesce("root", "comp").alias("comp"))
    fresh = join_small(roots, labels.select("id"), ["id"], "left_anti", size)
    return stored(moved.unionByName(fresh), "labels")


def labelled(postings: DataFrame, labels: DataFrame | None) -> DataFrame:
    """postings (key, id) with comp: the component of id so far."""
    if labels is None:
        return postings.select("key", "id", F.col("id").alias("comp"))
    return join_small(postings, labels, ["id"], "left", _LABEL * labels.count()).select("key", "id", F.coalesce("comp", "id").alias("comp"))


def crossing(postings: DataFrame, labels: DataFrame | None, seed: int, each: bool = False) -> DataFrame:
    """key, id, comp and a row of the key drawn by a hash (lead, lead_comp): postings of keys that lie in several components.

    The hash is one of the ids, so that keys with the same rows have one lead, or with `each` one of ids and keys.
    """
    rows = labelled(postings, labels)
    h = F.xxhash64("id", "key", F.lit(seed)) if each else F.xxhash64("id", F.lit(seed))
    draw = F.min(F.struct(h.alias("h"), "comp", "id")).alias("lead")
    first = rows.groupBy("key").agg(draw, F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi")
    return rows.join(first.select("key", F.col("lead.id").alias("lead"), F.col("lead.comp").alias("lead_comp")), "key")


def star_pairs(crossed: DataFrame) -> DataFrame:
    """(a, b): each row of a key with its lead, if they are in different components."""
    return crossed.where("comp <> lead_comp").select(F.least("lead", "id").alias("a"), F.greatest("lead", "id").alias("b")).distinct()


def drawn_pairs(crossed: DataFrame, seed: int) -> DataFrame:
    """(a, b): each row with up to TRIES of the leads of its keys, drawn by a hash, that are in other components."""
    leads = crossed.where("comp <> lead_comp").groupBy("id").agg(F.collect_set("lead").alias("leads"))
    drawn = F.slice(F.array_sort(F.transform("leads", lambda x: F.struct(F.xxhash64(x, "id", F.lit(seed)).alias("h"), x.alias("lead")))), 1, TRIES)
    pairs = leads.select("id", F.explode(drawn["lead"]).alias("lead"))
    return pairs.select(F.least("lead", "id").alias("a"), F.greatest("lead", "id").alias("b")).distinct()


def cross_pairs(postings: DataFrame, fit: Callable[[str, str], Column]) -> DataFrame:
    """(a, b) of different components that share a key, if `fit` holds for the other columns of both (key, id, comp and others).

    A key of many rows is a square of cells, each with about SIDE rows of either side, so no task compares a whole key.
    """
    names = [c for c in postings.columns if c != "key"]
    tasks = int(postings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    large = stored(postings.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > SIDE).select("key", F.ceil(F.col("n") / SIDE).cast("int").alias("cut")), "large")
    rows = join_small(postings, large, ["key"], "left", _LABEL * large.count()).withColumn("cut", F.coalesce("cut", F.lit(1)))
    own, others = F.pmod(F.xxhash64("id"), "cut").cast("int"), F.explode(F.sequence(F.lit(0), F.col("cut") - 1))

    def side(x: str, mine: str, other: str) -> DataFrame:
        cells = rows.select("key", own.alias(mine), others.alias(other), *[F.col(c).alias(f"{c}{x}") for c in names])
        return cells.repartition(tasks, "key", "row", "column")  # by number, as few bytes here are much work

    both = side("_a", "row", "column").join(side("_b", "column", "row"), ["key", "row", "column"]).where((F.col("comp_a") < F.col("comp_b")) & fit("_a", "_b"))
    return both.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).distinct()


def similar_pairs(pairs: DataFrame, sets: DataFrame, value: str, similar: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A stored table of the pairs (a, b) that `similar` leaves of pairs with na, nb and the values va, vb from sets (id, n, value).

    Only the sets that pairs name are moved.
    """
    ids = stored(pairs.select(F.col("a").alias("id")).distinct().unionByName(pairs.select(F.col("b").alias("id")).distinct()).distinct(), "wanted")
    wanted = stored(join_small(sets.select("id", "n", value), ids, ["id"], "left_semi"), "compared")
    one = lambda side: wanted.select(F.col("id").alias(side), F.col("n").alias(f"n{side}"), F.col(value).alias(f"v{side}"))
    both = pairs.join(one("b"), "b").join(one("a"), "a").where("4 * least(na, nb) >= 3 * greatest(na, nb)")
    out = stored(similar(both).select("a", "b"), "links")
    for t in (ids, wanted):
        drop_stored(t)
    return out


def link(postings: DataFrame, verify: Callable[[DataFrame], DataFrame], rest: Callable[[DataFrame, DataFrame | None], DataFrame]) -> DataFrame | None:
    """id, comp of ids that are linked to another; None if there is no link.

    The keys of `postings` (key, id) are the complete candidates. A star around one row of each key finds most links in a
    number of pairs that is linear in the rows, so large groups of near copies become one component at once; each further
    star tries another row of the keys that still cross components. In a family whose texts are each similar to a part of
    the others only, few are similar to one row: then each id tries TRIES rows, drawn from its keys anew. `rest` gives the
    pairs to compare of what is left then (key, id, comp; and the components so far), so no link is lost, and few pairs are
    compared that a component joins already. `verify` returns a stored table of the similar pairs.
    """
    labels, left = None, postings
    for step in range(STARS + DRAWS + 1):
        before = left
        left = stored(crossing(left.select("key", "id"), labels, step, each=step >= STARS), "crossing")
        if step:
            drop_stored(before)
        if not left.limit(1).count():
            drop_stored(left)
            return labels
        if step < STARS:
            pairs = star_pairs(left)
        else:
            pairs = drawn_pairs(left, step) if step < STARS + DRAWS else rest(left.select("key", "id", "comp"), labels)
        pairs = stored(pairs, "pairs")
        near = verify(pairs)
        labels = components(near, labels)
        for t in (pairs, near):
            drop_stored(t)
        release(postings.sparkSession)
    drop_stored(left)
    return labels
