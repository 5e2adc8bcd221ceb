"""Ranked lexical search by dense blocked matrix products: item weights times document impacts.

Terms are the words of `words`. Every document is read once for its number of terms and the counts of those that the items use;
document frequencies, N and L are counted over all documents. A term's weight and a document's impact are integers, and so is
every score. Products run in float64 over tiles (items x a compact vocabulary, vocabulary x documents), and a tile's
vocabulary is cut so that no partial sum reaches 2^53: each product is exact, and tiles add up as 64-bit integers. A weight too
large for a tile by itself (a term that an item repeats very often) is laid over several tiles. Each task keeps the k best of
every item, ties at the last place included until ids decide; then tasks are merged in two steps.

Items are a query set: blocks of at most about BLOCK_BYTES of terms are worked on one after the other, each against all documents,
so neither the broadcast nor a task's memory grows with the number of items.

Rows of the benchmark are items of their own, also with the same or no item_id; null texts have no terms and rank nothing, and
documents without a shared term are never listed. Equal scores go by ascending doc_id, null ids last; repeated documents are
listed each. Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridframe.llm.common import stored
from gridframe.llm.words import Vocabulary, read_words

#: Bytes of the items' distinct terms, counted with repeats between items, in one block.
BLOCK_BYTES = 32_000_000
TOP = 10
ITEM_TILE, TERM_TILE, DOC_TILE = 256, 4096, 512
#: Partial sums stay below this; whole numbers up to it are exact in float64.
EXACT = 1 << 53
#: No impact is larger: (10^9 * tf) div (1000 * tf + 8 * m).
IMPACT = 1_000_000
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_POSTINGS = "doc_id long, n long, terms array<int>, tfs array<long>"
_BEST = "part int, item int, doc_id long, score long"


def item_terms(benchmark: DataFrame) -> DataFrame:
    """item (a number of the row), item_id, and the item's distinct terms with their counts; items without terms are left out."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [sorted(Counter(_TERM.findall((t or b"").lower())).items()) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.record_batch(
                {
                    "item_id": batch.column("item_id"),
                    "terms": pa.array([[w for w, _ in c] for c in counts], pa.list_(pa.binary())),
                    "counts": pa.array([[n for _, n in c] for c in counts], pa.list_(pa.int64())),
                }
            )

    kind = benchmark.schema["item_id"].dataType.simpleString()
    found = benchmark.select("item_id", "text").mapInArrow(run, f"item_id {kind}, terms array<binary>, counts array<long>")
    return found.where("size(terms) > 0").withColumn("item", F.monotonically_increasing_id())


def postings(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """Of each document the number of its terms, and the numbers and counts of those in `terms`."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(terms))
    width = max(len(terms), 1)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in read_words(batch.column("text"), shared.value):
                known = part.ids >= 0
                keys, tfs = np.unique(part.text[known] * width + part.ids[known], return_counts=True)
                at = np.searchsorted(keys, np.arange(len(part.counts) + 1) * width).astype(np.int32)
                lists = (pa.ListArray.from_arrays(pa.array(at), pa.array(v)) for v in ((keys % width).astype(np.int32), tfs.astype(np.int64)))
                yield pa.record_batch(dict(zip(("doc_id", "n", "terms", "tfs"), (batch.column("doc_id").slice(part.first, len(part.counts)), pa.array(part.counts), *lists), strict=True)))

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _POSTINGS)


class Tile:
    """Weights of some items over some terms: dense, and small enough that no partial sum reaches 2^53."""

    def __init__(self, items: slice, terms: np.ndarray, rows: np.ndarray, cols: np.ndarray, weights: np.ndarray) -> None:
        self.items, self.terms, self.rows, self.cols, self.weights = items, terms, rows, cols, weights

    def dense(self) -> np.ndarray:
        out = np.zeros((self.items.stop - self.items.start, len(self.terms)))
        out[self.rows, self.cols] = self.weights
        return out


def tiles(n_items: int, item: np.ndarray, term: np.ndarray, weight: np.ndarray, exact: int = EXACT, item_tile: int = ITEM_TILE, term_tile: int = TERM_TILE) -> list[Tile]:
    """Cut sparse weights into tiles; the tiles of the same items add up to their scores."""
    most = max((exact - 1) // IMPACT, 1)
    out = []
    for first in range(0, n_items, item_tile):
        items = slice(first, min(first + item_tile, n_items))
        own = (item >= items.start) & (item < items.stop) & (weight > 0)
        rows, terms, left = item[own] - first, term[own], weight[own].copy()
        while len(left):  # once, unless a single weight is too large for a tile
            now = np.minimum(left, most)
            vocabulary, cols = np.unique(terms, return_inverse=True)
            # Weights summed per item over the vocabulary in order; a cut wherever some item would pass `most`, or at the width.
            order = np.argsort(cols, kind="stable")
            cut, start, sums = [0], 0, np.zeros(items.stop - items.start, np.int64)
            edges = np.searchsorted(cols[order], np.arange(len(vocabulary) + 1))
            for c in range(len(vocabulary)):
                column = order[edges[c] : edges[c + 1]]
                if c - start >= term_tile or np.any(sums[rows[column]] + now[column] > most):
                    cut.append(c)
                    start = c
                    sums[:] = 0
                sums[rows[column]] += now[column]
            for a, b in zip(cut, [*cut[1:], len(vocabulary)], strict=True):
                inside = (cols >= a) & (cols < b)
                out.append(Tile(items, vocabulary[a:b], rows[inside], cols[inside] - a, now[inside].astype(np.float64)))
            rest = left > now
            rows, terms, left = rows[rest], terms[rest], (left - now)[rest]
    return out


class Best:
    """The k best documents of each item so far, and those that tie with the last of them by score."""

    def __init__(self, n_items: int, k: int) -> None:
        self.k, self.n = k, n_items
        self.item = self.doc = self.none = self.score = np.zeros(0, np.int64)
        self.least = np.ones(n_items, np.int64)  # scores must be above 0

    def add(self, first: int, scores: np.ndarray, doc: np.ndarray, none: np.ndarray) -> None:
        least = self.least[first : first + len(scores)]
        if scores.shape[1] > self.k:
            least = np.maximum(least, np.partition(scores, -self.k, 1)[:, -self.k])
        item, at = np.nonzero(scores >= least[:, None])
        if len(item):
            new = item + first, doc[at], none[at], scores[item, at]
            self.item, self.doc, self.none, self.score = (np.concatenate(x) for x in zip((self.item, self.doc, self.none, self.score), new, strict=True))

    def settle(self) -> None:
        order = np.lexsort((self.doc, self.none, -self.score, self.item))
        item = self.item[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        keep = order[rank < self.k]
        self.item, self.doc, self.none, self.score = self.item[keep], self.doc[keep], self.none[keep], self.score[keep]
        last = np.flatnonzero(rank == self.k - 1)
        self.least[item[last]] = np.maximum(1, self.score[np.searchsorted(self.item, item[last], "right") - 1]) if len(last) else 1


def _impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _best(rows: DataFrame, weights: list[Tile], n_items: int, n_terms: int, docs: int, total: int, k: int) -> DataFrame:
    """Each task's k best documents an item."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        best, column = Best(n_items, k), np.full(n_terms, -1, np.int64)
        for batch in batches:
            for first in range(0, batch.num_rows, DOC_TILE):
                part = batch.slice(first, DOC_TILE)
                terms, tfs = (part.column(c).flatten().to_numpy() for c in ("terms", "tfs"))
                sizes = np.diff(part.column("terms").offsets.to_numpy())
                where = np.repeat(np.arange(part.num_rows), sizes)
                m = 25 + (75 * part.column("n").to_numpy() * docs) // max(total, 1)
                impact = _impacts(tfs, m[where]).astype(np.float64)
                ids = part.column("doc_id")
                doc, none = ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                scores, at = None, None
                for tile in shared.value:
                    if at is not None and tile.items != at:
                        best.add(at.start, scores, doc, none)
                        scores = None
                    column[tile.terms] = np.arange(len(tile.terms))
                    to = column[terms]
                    used = to >= 0
                    dense = np.zeros((len(tile.terms), part.num_rows))
                    dense[to[used], where[used]] = impact[used]
                    column[tile.terms] = -1
                    product = (tile.dense() @ dense).astype(np.int64)
                    scores, at = product if scores is None else scores + product, tile.items
                if scores is not None:
                    best.add(at.start, scores, doc, none)
                best.settle()
        n = len(best.item)
        part_id = TaskContext.get().partitionId()
        yield pa.record_batch({"part": pa.array(np.full(n, part_id, np.int32)), "item": pa.array(best.item.astype(np.int32)), "doc_id": pa.array(best.doc, mask=best.none > 0), "score": pa.array(best.score)})

    return rows.mapInArrow(run, _BEST)


def _ranked(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    place = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)


def _search_block(docs: DataFrame, items: list[dict], k: int) -> DataFrame:
    """Ranks of the items of one block: item (its place in `items`), rank, doc_id, score."""
    vocabulary = sorted({t for i in items for t in i["terms"]})
    of = {t: n for n, t in enumerate(vocabulary)}
    rows = stored(postings(docs, vocabulary), "postings")
    n_docs, total = rows.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), np.int64)
    counted = rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toArrow()  # at most a row a term of the block
    df[counted.column("term").to_numpy()] = counted.column("df").to_numpy()
    w = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
    item = np.repeat(np.arange(len(items)), [len(i["terms"]) for i in items])
    term = np.array([of[t] for i in items for t in i["terms"]], np.int64)
    count = np.array([c for i in items for c in i["counts"]], np.int64)
    weights = tiles(len(items), item, term, count * w[term] if len(term) else count)
    best = _best(rows.where("size(terms) > 0"), weights, len(items), max(len(vocabulary), 1), n_docs, total, k)
    return _ranked(_ranked(best.withColumn("part", F.floor(F.col("part") / 64)), ["item", "part"], k), ["item"], k)


def search(docs: DataFrame, benchmark: DataFrame, k: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The k best documents of every item: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    items = stored(item_terms(benchmark), "items")
    size = items.agg(F.coalesce(F.sum(F.aggregate("terms", F.lit(0).cast("long"), lambda n, t: n + 24 + F.octet_length(t))), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    out = None
    for b in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).select("item_id", "terms", "counts").toArrow().to_pylist()
        names = spark.createDataFrame([(n, i["item_id"]) for n, i in enumerate(own)], f"item int, item_id {items.schema['item_id'].dataType.simpleString()}")
        ranks = _search_block(docs, own, k).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        if blocks > 1:
            ranks = stored(ranks, "ranks")
        out = ranks if out is None else out.unionByName(ranks)
    return out


def op12_lexical_search(spark, sf_dir: str) -> DataFrame:
    return search(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark")))


_T = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP12_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_T} AS w FROM documents WHERE text IS NOT NULL),
i AS (SELECT row_number() OVER () AS q, item_id, unnest({_T}) AS t FROM benchmark WHERE text IS NOT NULL),
iq AS (SELECT q, t, count(*) AS c FROM i GROUP BY q, t),
s AS (SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM iq) GROUP BY r, t),
w AS (SELECT t, CAST(floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), s),
m AS (SELECT r, doc_id, 25 + (75 * len(w)::BIGINT * n) // l AS m FROM d, s WHERE len(w) > 0),
sc AS (SELECT q, r, doc_id, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score FROM iq JOIN tf USING (t) JOIN w USING (t) JOIN m USING (r) GROUP BY q, r, doc_id),
k AS (SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM sc WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k JOIN (SELECT DISTINCT q, item_id FROM i) USING (q) WHERE rank <= 10"""
