"""Merkle manifest of a dataset: one tree per source, one tree over the sources' roots, a proof for every row.

H is lowercase hex sha256 over concatenated inputs, digests as hex text. A leaf is H of the fields, each `-` if null, else its UTF-8
byte count, `:` and the value. Leaves get consecutive places in their tree: narrow rows are range-partitioned by (source, doc_id,
leaf, row number), numbered within their partition as it is written, and shifted by a small table of counts (one row a partition
and source), so a source with most rows is no task's. Every level then joins its nodes with their siblings by computed place
- slot offsets within the run - and slot-zero rows emit the parents: equijoins on (tree, place), no group is gathered. Paths
go down the other way, each level joined with the one above it, which costs as much as the levels have nodes, half as many
again as leaves, instead of leaves times levels.

Null fields are `-`; a null source is a tree of its own and comes first; rows without doc_id come first in their tree; repeated
ids go by leaf, and equal rows have places of their own next to each other (their digests are equal, so which is which cannot be
told). A lone leaf is its subroot, a lone subroot the root. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridframe.llm.common import drop_stored, join_small, size_of, stored

FANOUT = 3
_PATH = "array<struct<left:string,right:string>>"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]



def field(c: str | Column) -> Column:
    """A field as it goes into a leaf."""
    text = (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def hashed(*parts: Column) -> Column:
    """H over UTF-8 text."""
    return F.sha2(F.concat(*parts), 256)


def leaf(fields: list[str | Column]) -> Column:
    return hashed(*map(field, fields))


def placed(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """rows with `place` (from 0 within `tree`, by `order`) and `size` (rows of the tree); `tree` isn't null.

    Rows are sorted by ranges; a partition holds a tree's rows without gaps, so its first place and how many rows the partitions
    before it hold of the tree place them all.
    """
    sort = [tree, *order, "_row"]
    numbered = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "rows")
    ranged = numbered.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn("_at", F.monotonically_increasing_id())
    dealt = stored(ranged.drop("_row").withColumn("_part", F.shiftright("_at", 33)), "places")
    counts = dealt.groupBy(tree, "_part").agg(F.min("_at").alias("_from"), F.count("*").alias("_n"))
    before = Window.partitionBy(tree).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(tree, "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_from")).alias("_shift"), F.sum("_n").over(Window.partitionBy(tree)).alias("size"))
    shifts = stored(shifts, "shifts")
    drop_stored(numbered)
    return join_small(dealt, shifts, [tree, "_part"], "inner").withColumn("place", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")


def with_siblings(nodes: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """nodes (tree, place, size, digest) with `left` and `right`: the run's digests before and after, as text."""
    slot, first = F.col("place") % fanout, F.col("place") - F.col("place") % fanout
    out = nodes.withColumns({f"_s{k}": first + (slot + k) % fanout for k in range(1, fanout)})
    for k in range(1, fanout):
        other = nodes.select(F.col("tree").alias("_t"), F.col("place").alias("_p"), F.col("digest").alias(f"_d{k}"))
        out = out.join(other, (F.col("tree") == F.col("_t")) & (F.col(f"_s{k}") == F.col("_p")), "left").drop("_t", "_p")
    # Sibling k stands k slots on, around the run's end: it is to the right while slot + k stays within the run.
    right = [F.when(slot + k < fanout, F.coalesce(f"_d{k}", F.lit(""))).otherwise(F.lit("")) for k in range(1, fanout)]
    left = [F.when(slot + k >= fanout, F.coalesce(f"_d{k}", F.lit(""))).otherwise(F.lit("")) for k in range(1, fanout)]
    return out.withColumns({"left": F.concat(*left), "right": F.concat(*right)}).drop(*[f"_{x}{k}" for x in "sd" for k in range(1, fanout)])


def levels(nodes: DataFrame, fanout: int = FANOUT) -> list[DataFrame]:
    """The trees' levels from the leaves up, stored: tree, place, size, digest, left, right; a node of size 1 is its tree's root.

    nodes: tree, place, size (nodes of the tree on this level), digest, stored.
    """
    out = []
    most = nodes.agg(F.max("size")).first()[0] or 0
    alone = lambda df: df.where("size = 1").withColumns({"left": F.lit(""), "right": F.lit("")})
    while most > 1:
        level = stored(with_siblings(nodes.where("size > 1"), fanout).unionByName(alone(nodes)), "level")
        out.append(level)
        up = level.where((F.col("place") % fanout == 0) & (F.col("size") > 1))
        nodes = up.select("tree", (F.col("place") / fanout).cast("long").alias("place"), F.ceil(F.col("size") / fanout).alias("size"), hashed("digest", "right").alias("digest"))
        most = -(-most // fanout)
    return [*out, stored(alone(nodes), "level")]


def paths(up: list[DataFrame], roots: DataFrame | None = None, fanout: int = FANOUT) -> DataFrame:
    """The leaves' level with `path`: left and right siblings level by level, then those of the tree's root in `roots` (tree, above).

    Each level meets the one above it by (tree, parent's place); a tree's root meets its row of `roots`.
    """
    own = F.array(F.struct("left", "right"))
    higher, size = None, roots is not None and size_of(roots)
    for k in range(len(up) - 1, -1, -1):
        level = up[k].where("size = 1")
        level = level.withColumn("path", F.array().cast(_PATH)) if roots is None else join_small(level, roots, ["tree"], "inner", size).withColumnRenamed("above", "path")
        if higher is not None:
            parents = higher.select(F.col("tree").alias("_t"), F.col("place").alias("_p"), F.col("path").alias("_above"))
            inner = up[k].where("size > 1").join(parents, (F.col("tree") == F.col("_t")) & (F.floor(F.col("place") / fanout) == F.col("_p")))
            level = level.unionByName(inner.withColumn("path", F.concat(own, "_above")).drop("_t", "_p", "_above"))
        last, higher = higher, stored(level, "paths") if k else level
        if k:
            drop_stored(last)
    return higher


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, start, lambda at, x: F.sha2(F.concat(x["left"], at, x["right"]), 256))


def manifest(docs: DataFrame, fields: list[str] | None = None, tree: str = "source", key: str = "doc_id", fanout: int = FANOUT, tampered: dict[str, Column] | None = None) -> DataFrame:
    """Each row's key, leaf, subroot, root, proof_sha256, folded_root and verified.

    `tampered` gives other values of some fields; the root is then folded from the leaf of these and the original siblings.
    """
    fields = fields or FIELDS
    name = F.coalesce(F.concat(F.lit("="), F.col(tree).cast("string")), F.lit(""))  # null is a name of its own, before all others
    other = leaf([(tampered or {}).get(c, c) for c in fields])
    rows = docs.select(name.alias("tree"), F.col(key).alias("_key"), leaf(fields).alias("digest"), other.alias("_now"))
    own = stored(placed(rows, "tree", ["_key", "digest"]), "leaves")
    up = levels(own.select("tree", "place", "size", "digest"), fanout)
    tops = up[-1].where("size = 1")
    for level in up[:-1]:
        tops = tops.unionByName(level.where("size = 1"))
    subroots = stored(tops.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), "subroots")
    over = stored(placed(subroots, "tree", ["name"]), "leaves")
    above = levels(over.select("tree", "place", "size", "digest"), fanout)
    root = above[-1].select("digest").first()
    top = paths(above, None, fanout)
    over = over.select(F.col("name").alias("tree"), F.col("digest").alias("subroot"), "place")
    roots = stored(over.join(top.select("place", F.col("path").alias("above")), "place").drop("place"), "roots")
    found = paths(up, roots.select("tree", "above"), fanout).select("tree", "place", "path")
    found = join_small(own.select("tree", "place", "_key", F.col("digest").alias("leaf"), "_now").join(found, ["tree", "place"]), roots.select("tree", "subroot"), ["tree"], "inner")
    proof = F.sha2(F.array_join(F.flatten(F.transform("path", lambda x: F.array(x["left"], x["right"]))), ""), 256)
    out = found.select(F.col("_key").alias(key), "leaf", "subroot", F.lit(root[0] if root else None).cast("string").alias("root"), proof.alias("proof_sha256"), folded(F.col("_now"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return manifest(docs, tampered={"text": F.when(hit, F.translate("text", "\n", "")).otherwise(F.col("text"))})


_CRC = "list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda z: ascii(z)::BIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)::BIGINT[]), lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))"
_F = "coalesce(octet_length(encode(CAST({0} AS VARCHAR))) || ':' || CAST({0} AS VARCHAR), '-')"
_L = "sha256(" + " || ".join(_F.format(c) for c in FIELDS[:4]) + " || {text})"
_STEP = """{0} AS (SELECT 0 AS level, g, place, n, digest FROM {1} UNION ALL
 SELECT level + 1, g, place // 3, any_value((n + 2) // 3), sha256(string_agg(digest, '' ORDER BY place)) FROM {0} WHERE n > 1 GROUP BY level, g, place // 3)"""
_SIBS = "coalesce((SELECT string_agg(o.digest, '' ORDER BY o.place) FROM {0} o WHERE o.level = x.level AND o.g = x.g AND o.place // 3 = x.place // 3 AND o.place {1} x.place), '')"
OP13_SQL = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, '') AS g, {_L.format(text=_F.format("text"))} AS digest,
 CASE WHEN ({_CRC}) & 1 = 1 THEN {_L.format(text=_F.format("replace(text, chr(10), '')"))} ELSE {_L.format(text=_F.format("text"))} END AS now FROM documents),
l0 AS (SELECT r, doc_id, g, digest, now, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, digest, r) - 1 AS place, count(*) OVER (PARTITION BY g) AS n FROM d),
{_STEP.format("u", "l0")},
s0 AS (SELECT '' AS g, g AS name, digest, row_number() OVER (ORDER BY g) - 1 AS place, count(*) OVER () AS n FROM u WHERE n = 1),
{_STEP.format("v", "s0")},
un AS (SELECT level, g, place, {_SIBS.format("u", "<")} AS lft, {_SIBS.format("u", ">")} AS rgt FROM u x WHERE n > 1),
vn AS (SELECT level, g, place, {_SIBS.format("v", "<")} AS lft, {_SIBS.format("v", ">")} AS rgt FROM v x WHERE n > 1),
p AS (SELECT r, doc_id, l0.digest AS leaf, now, l0.g, l0.place, s0.digest AS subroot, s0.place AS sp FROM l0 JOIN s0 ON l0.g = s0.name),
path AS (SELECT r, 0 AS tier, level, lft, rgt FROM p JOIN un ON un.g = p.g AND un.place = p.place // CAST(pow(3, level) AS BIGINT)
 UNION ALL SELECT r, 1, level, lft, rgt FROM p JOIN vn ON vn.place = p.sp // CAST(pow(3, level) AS BIGINT)),
lists AS (SELECT r, list({{'l': lft, 'r': rgt}} ORDER BY tier, level) AS path FROM path GROUP BY r),
f AS (SELECT r, 0 AS k, now AS cur FROM p UNION ALL SELECT f.r, k + 1, sha256(path[k + 1].l || cur || path[k + 1].r) FROM f JOIN lists ON f.r = lists.r WHERE k < len(path)),
last AS (SELECT r, max_by(cur, k) AS folded_root FROM f GROUP BY r)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(list_reduce(list_prepend('', list_transform(path, lambda x: x.l || x.r)), lambda a, b: a || b), '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM p JOIN last USING (r) LEFT JOIN lists USING (r), (SELECT digest AS root FROM v WHERE n = 1)"""
