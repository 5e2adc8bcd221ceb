"""Benchmark decontamination: a broadcast hash set of the items' word windows, training windows scanned and verified.

Words are those of `words`. A window is ten consecutive words of an item; an item with fewer words, but not none, is one window.
The distinct windows of all items are counted in bytes; up to BLOCK_BYTES of them go to every task as one sorted set of hashes
with the windows' word numbers. Documents are scanned window by window, a hash that is in the set is verified number by number,
and numbers stand for exact words, so no hash decides anything. Larger benchmarks are dealt into blocks of about that size:
the documents are scanned once a block and the verified spans are merged, with the same result.

Null texts have no words and no hits. Rows of a benchmark with one item_id are one item; a null item_id is an item whose id is
written as an empty string. Documents are judged row by row, so repeated rows and ids, null ids and ties need no rule. An
empty benchmark marks nothing, no documents give no rows. Columns of the input named like a result (n_words, spans, items) are
replaced, others pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridframe.llm.common import drop_stored, join_small, size_of, stored
from gridframe.llm.words import Vocabulary, read_words

WINDOW = 10
#: Bytes of windows in one broadcast.
BLOCK_BYTES = 64_000_000
_FOUND = "n_words long, spans array<struct<start:long,stop:long>>, items array<string>"
_WORDS = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct pairs of an item and a window's words, joined by spaces."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                words = _WORDS.findall((text or b"").lower())
                found = sorted({b" ".join(words[k : k + window]) for k in range(max(1, len(words) - window + 1))} - {b""})
                yield pa.record_batch({"item": pa.array([item] * len(found), pa.string()), "words": pa.array(found, pa.binary())})

    item = F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item")
    return benchmark.select(item, "text").mapInArrow(run, "item string, words binary").distinct()


class WindowSet:
    """Windows by their length, each with its word numbers, the hash of these and the items that have it."""

    def __init__(self, pairs: list[tuple[str, bytes]]) -> None:
        self.items = sorted({i for i, _ in pairs})
        number = {i: k for k, i in enumerate(self.items)}
        windows = sorted({w for _, w in pairs})
        place = {w: k for k, w in enumerate(windows)}
        split = [w.split(b" ") for w in windows]
        vocabulary = sorted({x for words in split for x in words})
        self.vocabulary = Vocabulary(vocabulary)
        of = {x: k for k, x in enumerate(vocabulary)}
        rng = np.random.default_rng(11)
        self.values = rng.integers(0, 1 << 63, len(vocabulary), np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        self.groups = []
        lengths = np.array([len(words) for words in split], np.int64)
        for n in np.unique(lengths).tolist():
            own = np.flatnonzero(lengths == n)
            ids = np.array([[of[x] for x in split[k]] for k in own.tolist()], np.int32)
            keys = self.hashes(ids.T)
            order = np.argsort(keys, kind="stable")
            shift = np.uint64(64 - max(12, min(24, len(own).bit_length() + 5)))
            seen = np.zeros(1 << (64 - int(shift)), bool)
            seen[keys >> shift] = True
            self.groups.append((n, keys[order], ids[order], own[order], shift, seen))
        by = np.array([place[w] for _, w in pairs], np.int64)
        order = np.argsort(by, kind="stable")
        self.item_of = np.array([number[i] for i, _ in pairs], np.int64)[order]
        self.item_at = np.searchsorted(by[order], np.arange(len(windows) + 1))

    def hashes(self, ids: Iterable[np.ndarray]) -> np.ndarray:
        """Hash of windows; ids: the first words of all windows, the second ones, and so on."""
        out = np.uint64(0)
        for x in ids:
            out = out * np.uint64(0xD6E8FEB86659FD93) + self.values[x]
        return out ^ (out >> np.uint64(31))

    def occurrences(self, ids: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Verified occurrences in the words of some texts: place, length, window."""
        out = [np.zeros((3, 0), np.int64)]
        unknown = np.concatenate([[0], np.cumsum(ids < 0)])
        for n, keys, windows, own, shift, seen in self.groups:
            last = len(ids) - n + 1
            if last < 1:
                continue
            at = np.flatnonzero((unknown[n:] == unknown[:last]) & (text[n - 1 :] == text[:last]))
            found = self.hashes(ids[at + k] for k in range(n))
            maybe = seen[found >> shift]
            at, found = at[maybe], found[maybe]
            low, high = np.searchsorted(keys, found), np.searchsorted(keys, found, "right")
            while len(at := at[low < high]):  # more than one round only where windows share a hash
                low, high = low[low < high], high[low < high]
                same = (windows[low] == ids[at[:, None] + np.arange(n)]).all(1)
                out.append(np.stack([at[same], np.full(same.sum(), n), own[low[same]]]))
                low = low + 1
        return tuple(np.concatenate(out, 1))

    def found(self, texts: pa.Array) -> Iterator[tuple[int, list, list]]:
        """Of each text the number of words, the maximal hit spans and the items, sorted."""
        for part in read_words(texts, self.vocabulary):
            begins = np.concatenate([[0], np.cumsum(part.counts)])
            place, length, window = self.occurrences(part.ids, part.text)
            hit = np.zeros(len(part.ids) + 1, np.int64)
            np.add.at(hit, place, 1)
            np.add.at(hit, place + length, -1)
            inside = np.concatenate([[0], (np.cumsum(hit[:-1]) > 0).astype(np.int8), [0]])
            # A text's end ends a span, also where the next text begins with one.
            ends = np.zeros(len(inside), bool)
            ends[begins] = True
            starts = np.flatnonzero((inside[1:] > 0) & ((inside[:-1] == 0) | ends[:-1]))
            stops = np.flatnonzero((inside[:-1] > 0) & ((inside[1:] == 0) | ends[:-1]))
            where = part.text[place]
            order = np.argsort(where, kind="stable")
            cuts = np.searchsorted(where[order], np.arange(len(part.counts) + 1))
            spans = np.searchsorted(starts, begins)
            for t, words in enumerate(part.counts.tolist()):
                if cuts[t] == cuts[t + 1]:
                    yield words, [], []
                    continue
                items = {i for w in np.unique(window[order[cuts[t] : cuts[t + 1]]]).tolist() for i in self.item_of[self.item_at[w] : self.item_at[w + 1]].tolist()}
                own = slice(spans[t], spans[t + 1])
                yield words, [{"start": a, "stop": b} for a, b in zip((starts[own] - begins[t]).tolist(), (stops[own] - begins[t]).tolist(), strict=True)], [self.items[i] for i in sorted(items)]


def _scan(docs: DataFrame, pairs: DataFrame, columns: list[str]) -> DataFrame:
    """Documents with n_words, spans and items, by one bounded set of windows."""
    rows = pairs.toArrow().to_pydict()
    shared = docs.sparkSession.sparkContext.broadcast(WindowSet(list(zip(rows["item"], rows["words"], strict=True))))
    schema = T.StructType([docs.schema[c] for c in columns] + T._parse_datatype_string(_FOUND).fields)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = dict(zip(("n_words", "spans", "items"), (pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])), pa.list_(pa.string())), strict=True))
        for batch in batches:
            found = list(zip(*shared.value.found(batch.column("_text")), strict=True)) or [[], [], []]
            yield pa.record_batch({c: batch.column(c) for c in columns} | {c: pa.array(v, types[c]) for c, v in zip(types, found, strict=True)})

    return docs.select(*columns, F.col("text").alias("_text")).mapInArrow(run, schema)


def _merged(spans: Column) -> Column:
    """Maximal spans of a list that may overlap or touch."""
    last = lambda a: F.element_at(a, -1)
    wider = lambda a, x: F.array(F.struct(last(a)["start"].alias("start"), F.greatest(last(a)["stop"], x["stop"]).alias("stop")))
    step = lambda a, x: F.when((F.size(a) > 0) & (last(a)["stop"] >= x["start"]), F.concat(F.slice(a, 1, F.size(a) - 1), wider(a, x))).otherwise(F.concat(a, F.array(x)))
    return F.aggregate(F.array_sort(spans), F.array().cast("array<struct<start:long,stop:long>>"), step)


def find_passages(docs: DataFrame, benchmark: DataFrame, columns: list[str] | None = None, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Each document's `columns` (all, if none are named) with n_words, spans (in words, maximal, stop excluded) and sorted items."""
    columns = [c for c in columns or docs.columns if c not in ("n_words", "spans", "items", "_text", "_key")]
    pairs = stored(item_windows(benchmark, window), "windows")
    blocks = max(1, -(-size_of(pairs) // block_bytes))
    block = lambda b: pairs.where(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == b)
    if blocks == 1:
        return _scan(docs, pairs, columns)
    # Spans depend on the text alone, so blocks meet by its digest and copies once.
    keyed = docs.withColumn("_key", F.sha2("text", 256))
    more = [stored(_scan(keyed, block(b), ["_key"]).where("size(items) > 0").dropDuplicates(["_key"]), "hits") for b in range(1, blocks)]
    rest = more[0]
    for part in more[1:]:
        rest = rest.unionByName(part)
    rest = stored(rest.groupBy("_key").agg(F.flatten(F.collect_list("spans")).alias("_spans"), F.flatten(F.collect_list("items")).alias("_items")), "hits")
    for part in more:
        drop_stored(part)
    out = join_small(_scan(keyed, block(0), [*columns, "_key"]), rest, ["_key"], "left")
    found = lambda own, other: F.when(F.col(other).isNull(), F.col(own)).otherwise(F.concat(own, F.col(other)))
    spans = F.when(F.col("_spans").isNull(), F.col("spans")).otherwise(_merged(found("spans", "_spans")))
    return out.select(*columns, "n_words", spans.alias("spans"), F.array_sort(F.array_distinct(found("items", "_items"))).alias("items"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "spans", window: int = WINDOW) -> DataFrame:
    """Documents without benchmark passages: hit spans are cut from the text, or documents with a hit are dropped."""
    found = find_passages(docs, benchmark, None, window)
    if remove == "documents":
        return found.where("size(items) = 0").select(*docs.columns)
    if remove != "spans":
        raise ValueError("remove is 'spans' or 'documents'")
    at = found.columns.index("text")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for k, spans in enumerate(batch.column("spans").to_pylist()):
                if spans:
                    words, kept, done = [m.span() for m in _WORDS.finditer(texts[k])], [], 0
                    for s in spans:
                        kept.append(texts[k][done : words[s["start"]][0]])
                        done = words[s["stop"] - 1][1]
                    texts[k] = b"".join([*kept, texts[k][done:]])
            yield batch.set_column(at, "text", pa.array(texts, pa.binary()).cast(batch.schema.field("text").type))

    return found.mapInArrow(cut, found.schema).select(*docs.columns)


def op11_decontamination(spark, sf_dir: str) -> DataFrame:
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return find_passages(docs, benchmark, ["doc_id"]).select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("items") > 0).alias("contaminated")
    )


_W = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP11_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_W}, []) AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_W} AS w FROM benchmark WHERE text IS NOT NULL),
win AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS g FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
occ AS (SELECT r, i, dw.n, item FROM dw JOIN win ON dw.n = win.n AND dw.g = win.g),
hits AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM occ)) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM occ) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
 sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN its USING (r)"""
