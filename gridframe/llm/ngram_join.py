"""Jaccard join on sets of distinct five-word shingles, by extended prefixes and token combinations.

A token is the 64-bit hash of a shingle. Two sets with a Jaccard similarity of 0.75 miss at most n - ceil(0.75 n) tokens of
either one. So among the first (misses + k) tokens of both sets, in any order that all sets share, they have k in common.

1. Screening. Of each set the first tokens in hash order are looked at, with k = 1 + n // 16. A set with fewer tokens that
   another set has there too than the least k of sets it can link with is done; in most corpora that is nearly every document.
2. Order. The tokens of the other sets are counted and ordered by their frequency. Tokens of one set alone come first in
   it and use up its misses, so its prefix of tokens that others have is short: misses - alone + k tokens.
3. Index. Rare tokens of the prefix are keys singly, frequent ones (OFTEN sets or more) in 2-combinations. For a size class
   with B buckets the prefix is extended to k = B + 1 tokens in common; tokens are dealt to buckets by their hash, so two
   common tokens meet in one bucket and only combinations within buckets are keys: about as many as tokens, for sets of any
   size. B is a quarter of the class's least size, and sets are in each class where similar ones can be.
4. Verification on the whole sets: stars around the keys first (see linking). For sets that still cross components, single
   tokens of the shortest prefix are joined, if what each set is seen to miss of the other (its tokens before a first common
   one, and of its AHEAD first tokens) leaves room for the overlap.

The order only shapes the index, so the result is exact. Equal sets are one class. Null or wordless text has no shingles and
no link; fewer than five words make one shingle; repeated rows are copies; a row without doc_id is linked like any other, but
names no component unless all of its rows lack an id; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridframe.llm.common import drop_stored, hold, join_groups, join_small, release, stored
from gridframe.llm.linking import cross_pairs, crossing, link, similar_pairs

WORDS = 5
OFTEN = 32
AHEAD = 96
NO_ID = -(2**63)
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes (int64) of each text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    coded = lists.flatten().dictionary_encode()
    known = coded.dictionary.to_pylist()
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in known] or [0], np.uint64)
    where = coded.indices.to_numpy()
    bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    if "" in known:  # splitting leaves empty words at the ends
        keep = where != known.index("")
        bounds = np.concatenate(([0], np.cumsum(keep)))[bounds]
        where = where[keep]
    word = hashes[where]
    n = len(word)
    if n >= WORDS:
        grams = _mix(sum(word[i : n - WORDS + 1 + i] * _FACTORS[i] for i in range(WORDS))).view(np.int64)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= WORDS:
            out.append(np.unique(grams[a : b - WORDS + 1]))
        elif b > a:
            out.append(_mix((word[a:b] * _FACTORS[: b - a]).sum(keepdims=True) + np.uint64(b - a)).view(np.int64))
        else:
            out.append(np.zeros(0, np.int64))
    return out


def prefix_length(n: int) -> int:
    """n - ceil(0.75 n) + 1."""
    return n - (3 * n + 3) // 4 + 1


def _class_id(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def _batches(parts: Iterator[pa.RecordBatch], rows: int = 2000) -> Iterator[tuple[list, list[np.ndarray]]]:
    hold("ngram_join", lambda: None)
    for whole in parts:
        for at in range(0, whole.num_rows, rows):
            b = whole.slice(at, rows)
            yield b.column(0).to_pylist(), shingle_sets(pc.cast(b.column("text"), pa.string()))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int64)))


def _enough(n: int) -> int:
    """Tokens of the screened prefix that other sets must have too."""
    return 1 + n // 16


def scan_documents(docs: DataFrame) -> DataFrame:
    """kind, token, cid, k. Kind 0 is a document: its doc_id, its class (hash of the set) and the size of the set. Kind 1 is a
    token of a screened prefix, kind 2 a class with the number of its screened tokens that the task knows to be shared.

    A task counts a class once. A token that it met in several prefixes stands once, without a class, and is counted in kind
    2 for each of its classes, so no token has more rows than there are tasks.
    """

    def table(kind: int, *columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(columns[0]), kind, np.int32)), *[pa.array(c, pa.int64()) for c in columns]], names=["kind", "token", "cid", "k"])

    def counted(prefixes: list[np.ndarray], cids: list[int]) -> Iterator[pa.RecordBatch]:
        tokens = np.concatenate(prefixes)
        owner = np.repeat(np.arange(len(cids)), [len(x) for x in prefixes])
        order = np.argsort(tokens)
        tokens, owner = tokens[order], owner[order]
        first = np.concatenate(([True], tokens[1:] != tokens[:-1]))
        several = np.concatenate((~first[1:], [False])) | ~first
        classes = np.array(cids, np.int64)
        lead = np.flatnonzero(first)
        yield table(1, tokens[lead], pa.array(classes[owner[lead]], mask=several[lead]), np.ones(len(lead), np.int64))
        known = np.bincount(owner[several], minlength=len(cids))
        if (known > 0).any():
            yield table(2, np.zeros((known > 0).sum(), np.int64), classes[known > 0], known[known > 0])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[np.ndarray] = []
        cids: list[int] = []
        size = 0
        for ids, sets in _batches(parts):
            own = [_class_id(s) for s in sets]
            yield table(0, ids, own, [len(s) for s in sets])
            for c, s in zip(own, sets, strict=True):
                if len(s) and c not in seen:
                    seen.add(c)
                    held.append(s[: prefix_length(len(s)) - 1 + _enough(len(s))])
                    cids.append(c)
                    size += len(held[-1])
            if size > 2_000_000:
                yield from counted(held, cids)
                held, cids, size = [], [], 0
            if len(seen) > 1_000_000:
                seen.clear()
        if held:
            yield from counted(held, cids)

    return docs.select("doc_id", "text").mapInArrow(run, "kind int, token long, cid long, k long")


def touched_classes(scan: DataFrame, classes: DataFrame) -> DataFrame:
    """cid and doc_id of the classes that share enough tokens of their screened prefixes."""
    token = Window.partitionBy("token")
    rows = scan.where("kind = 1").select("token", "cid").withColumns({"lo": F.min("cid").over(token), "hi": F.max("cid").over(token), "own": F.count("cid").over(token), "all": F.count("*").over(token)})
    met = rows.where("cid is not null and (lo < hi or own < all)").groupBy("cid").agg(F.count("*").alias("k"))
    met = met.unionByName(scan.where("kind = 2").select("cid", "k")).groupBy("cid").agg(F.sum("k").alias("k"))
    return met.join(classes, "cid").where("k >= 1 + (3 * n + 3) div 4 div 16").select("cid", "doc_id")


def class_sets(docs: DataFrame, touched: DataFrame) -> DataFrame:
    """cid, n and the whole set (tokens) of each class in `touched` (cid, doc_id)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _batches(parts):
            sets = [s for s in sets if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array([_class_id(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int32()), _lists(sets)], names=["cid", "n", "tokens"])

    # Another row with the same id may have another set, so the class is told from the set itself.
    ids = touched.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id")).distinct()
    texts = join_small(docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "text"), ids, ["doc_id"], "left_semi")
    return texts.mapInArrow(run, "cid long, n int, tokens array<long>").join(touched.select("cid"), "cid", "left_semi").dropDuplicates(["cid"])


def ordered_tokens(sets: DataFrame) -> DataFrame:
    """id, n and the tokens that other sets have too with df and place, the least frequent first.

    The place is a number that follows the order of tokens: 8 bits for the frequency on a logarithmic scale, 23 of the token.
    """
    tokens = sets.select("cid", F.explode("tokens").alias("token"))
    counts = tokens.groupBy("token").agg(F.count("*").cast("int").alias("df")).where("df > 1")
    place = F.shiftleft(F.least(F.floor(F.log2("df") * 8), F.lit(255)).cast("int"), 23).bitwiseOR(F.shiftrightunsigned("token", 41).cast("int"))
    often = tokens.join(counts.withColumn("place", place), "token").groupBy("cid").agg(F.array_sort(F.collect_list(F.struct("place", "token", "df"))).alias("often"))
    out = often.join(sets.select("cid", "n"), "cid")
    return out.select(F.col("cid").alias("id"), "n", F.col("often.df").alias("df"), F.col("often.token").alias("tokens"), F.col("often.place").alias("places"))


def size_classes(n: int) -> list[int]:
    """The size classes of a set: that of its own size, and that of the largest sets that are similar to it."""
    return sorted({n.bit_length() - 1, (4 * n // 3).bit_length() - 1})


def index_keys(n: int, df: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Keys of a set of n tokens from those that others have: rare ones singly, frequent ones in 2-combinations within buckets."""
    left = prefix_length(n) - 1 - (n - len(tokens))  # misses that tokens of this set alone leave
    if left < 0:
        return tokens[:0]
    keys = []
    for c in size_classes(n):
        buckets = max(1, (1 << c) // 4)
        reach = left + 1 + buckets
        keys.append(tokens[:reach][df[:reach] < OFTEN])
        x = tokens[:reach][df[:reach] >= OFTEN].view(np.uint64)
        order = np.argsort(x % np.uint64(buckets), kind="stable")  # within a bucket the common order stays
        x = x[order]
        bucket = x % np.uint64(buckets)
        for step in range(1, len(x)):
            i = np.flatnonzero(bucket[step:] == bucket[:-step])
            if not len(i):
                break
            keys.append(_mix(x[i] * _FACTORS[0] + x[i + step] * _FACTORS[1] + np.uint64(c)).view(np.int64))
    return np.unique(np.concatenate(keys))


def postings(ordered: DataFrame) -> DataFrame:
    """key, id: the index entries of every class."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            df, tokens = (batch.column(c) for c in ("df", "tokens"))
            ends = tokens.offsets.to_numpy()
            df, tokens = df.flatten().to_numpy(), tokens.flatten().to_numpy()
            ends = ends - ends[0]
            keys = [index_keys(n, df[a:b], tokens[a:b]) for n, a, b in zip(batch.column("n").to_pylist(), ends[:-1], ends[1:], strict=True)]
            ids = np.repeat(batch.column("id").to_numpy(), [len(k) for k in keys])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*keys, np.zeros(0, np.int64)])), pa.array(ids)], names=["key", "id"])

    return ordered.mapInArrow(run, "key long, id long")


def rest_pairs(ordered: DataFrame, left: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(a, b) of sets in different components that can still be similar, among those that `left` names, by single tokens."""
    ids = stored(left.select("id").distinct(), "rest")
    alone = F.col("n") - F.size("tokens")
    misses = F.col("n") - F.ceil(F.col("n") * 3 / 4).cast("int") - alone
    rows = join_small(ordered, ids, ["id"], "left_semi").select("id", "n", alone.alias("alone"), "tokens", "places", misses.alias("misses")).where("misses >= 0")
    last = F.when(F.size("places") <= AHEAD, F.lit(2**31 - 1)).otherwise(F.element_at("places", AHEAD))
    rows = stored(rows.select("id", "n", "alone", F.slice("places", 1, AHEAD).alias("ahead"), last.alias("last"), F.slice("tokens", F.lit(1), F.col("misses") + 1).alias("prefix")), "marks")
    keys = rows.select("id", F.posexplode("prefix").alias("position", "key")).select("key", "id", "position")
    crossed = crossing(keys.select("key", "id"), labels, 0).select("key", "id", "comp")
    return cross_pairs(crossed.join(keys, ["key", "id"]).join(rows.select("id", "n", "alone", "ahead", "last"), "id"), _fit)


def _fit(a: str, b: str) -> Column:
    """Whether neither set misses too much of the other as far as can be seen: before the key, if it is the first token that
    both have, and among the first tokens up to the place where both lists reach. Tokens of one place count as equal.
    """
    n = F.col(f"n{a}") + F.col(f"n{b}")
    fits = 4 * F.least(f"n{a}", f"n{b}") >= 3 * F.greatest(f"n{a}", f"n{b}")
    room = lambda x, missed: 7 * (F.col(f"n{x}") - F.col(f"alone{x}") - missed) >= 3 * n
    fits = fits & room(a, F.col(f"position{a}")) & room(b, F.col(f"position{b}"))
    end = F.least(f"last{a}", f"last{b}")
    for x, y in ((a, b), (b, a)):
        fits = fits & room(x, F.size(F.filter(F.array_except(f"ahead{x}", f"ahead{y}"), lambda t: t < end)))
    return fits


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) of every document."""
    spark = docs.sparkSession
    scan = stored(scan_documents(docs), "scan")
    rows = stored(scan.where("kind = 0").select(F.col("token").alias("doc_id"), F.col("k").alias("n"), "cid"), "documents")
    total = rows.count()
    classes = stored(rows.where("n > 0").groupBy("cid").agg(F.first("n").alias("n"), F.min("doc_id").alias("doc_id"), F.count("*").alias("size")), "class")
    touched = stored(touched_classes(scan, classes.select("cid", "n", "doc_id")), "touched")
    drop_stored(scan)
    release(spark)

    sets = stored(class_sets(docs, touched), "sets")
    ordered = stored(ordered_tokens(sets), "ordered")
    release(spark)
    keys = stored(postings(ordered), "keys")

    def verify(pairs: DataFrame) -> DataFrame:
        """The pairs whose sets have 100 |A and B| >= 75 |A or B|."""
        both = F.size(F.array_intersect("va", "vb"))
        return similar_pairs(pairs, sets.withColumnRenamed("cid", "id"), "tokens", lambda got: got.withColumn("both", both).where("100 * both >= 75 * (na + nb - both)"))

    labels = link(keys, verify, lambda left, known: rest_pairs(ordered, left, known))
    comp = classes.select("cid", "doc_id", "size")
    comp = comp.withColumn("comp", F.col("cid")) if labels is None else join_small(comp, labels.withColumnRenamed("id", "cid"), ["cid"], "left").withColumn("comp", F.coalesce("comp", "cid"))
    comp = stored(comp, "comp")
    low = comp.groupBy("comp").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("k"))
    found = join_groups(comp.select("comp", "cid", "size"), low, "comp", "k", total).select("cid", "size", "component_id")
    out = join_groups(rows.select("doc_id", "n", F.when(F.col("n") > 0, F.col("cid")).otherwise(F.xxhash64("doc_id")).alias("cid")), stored(found, "found"), "cid", "size", total)
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def op1_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
