"""Removal of repeated byte strings with a logarithmic family of suffix indexes.

Every byte covered by a string of `length` bytes that also starts earlier (smaller doc_id, or earlier in the document) is
removed. An index holds the sampled suffixes of some documents in sorted order: the suffixes at synchronising positions,
chosen so that equal strings of `length` bytes have theirs at the same place (the least k-gram hash of each window). All
windows with one synchronising suffix form a run. A batch's sorted suffixes are merge-scanned with those of the existing
levels: equal runs are repeats as a whole, and runs that share a suffix's k-gram but differ are compared window by window.
New runs become a level of their own, and levels of equal size merge, so there are logarithmically many.

Suffixes that occur very often are dealt by their whole run instead of their k-gram, and their windows one by one, so no
task gets all rows of a common passage. Null text counts as empty, texts shorter than `length` lose nothing, rows of one
doc_id are at the same place and never repeats of each other, rows without doc_id lose nothing and repeat nothing, an empty
table gives an empty result, other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridframe.llm.common import join_small, stored

LENGTH = 100
GRAM = 24
LOCALLY_OFTEN = 128
OFTEN = 100_000
_M = np.uint64(0xD6E8FEB86659FD93)
_BASE = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(1).integers(1, 2**63, 256, dtype=np.int64).astype(np.uint64)
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _M
    x = (x ^ (x >> np.uint64(32))) * _M
    return x ^ (x >> np.uint64(32))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse mod 2^64."""
    if len(_POWERS["up"]) <= n:
        for name, factor in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            steps = np.full(2 * n + 1024, factor, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps)
    return _POWERS["up"], _POWERS["down"]


def _sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which the hash of any substring follows."""
    up, _ = _powers(len(data))
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * up[: len(data)])))


def _least(h: np.ndarray, w: int) -> np.ndarray:
    """Position of the leftmost minimum of every w neighbours (low bits of the values give way to positions)."""
    n = len(h)
    bits = np.uint64(w.bit_length())
    padded = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = h
    rows = (padded.reshape(-1, w) >> bits << bits) | np.arange(w, dtype=np.uint64)
    ahead = np.minimum.accumulate(rows, 1).ravel()[w - 1 : n]
    behind = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()[: n - w + 1]
    left = (behind >> bits) <= (ahead >> bits)
    low = (np.uint64(1) << bits) - np.uint64(1)
    at = np.arange(n - w + 1)
    return np.where(left, at - at % w + (behind & low).astype(np.int64), (at + w - 1) - (at + w - 1) % w + (ahead & low).astype(np.int64))


def runs_of(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of a text: k-gram hash, hash of the whole run, first window, number of windows."""
    n = len(data)
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, down = _powers(n)
    sums = _sums(data)
    grams = _mix((sums[gram:] - sums[:-gram]) * down[: n - gram + 1])
    least = _least(grams, length - gram + 1)
    first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    count = np.diff(np.append(first, n - length + 1))
    whole = _mix((sums[first + count - 1 + length] - sums[first]) * down[first]) ^ _mix(count.astype(np.uint64))
    return grams[least[first]].view(np.int64), whole.view(np.int64), first, count


def _texts(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    for batch in parts:
        ids = batch.column("doc_id").to_pylist()
        for i, t in zip(ids, pc.cast(pc.fill_null(batch.column("text"), ""), pa.binary()), strict=True):
            yield i, np.frombuffer(t.as_py(), np.uint8)


def _table(columns: dict[str, tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns.values()], names=list(columns))


def often(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """k-grams that begin very many runs (at most 100,000 of them): each must be common within some task."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush():
            grams, n = np.unique(np.concatenate(held), return_counts=True)
            keep = n >= max(LOCALLY_OFTEN, size // 1000)
            return _table({"h": (grams[keep], pa.int64()), "n": (n[keep], pa.int64())})

        for _, data in _texts(parts):
            held.append(runs_of(data, length, gram)[0])
            size += len(held[-1])
            if size > 3_000_000:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    rows = docs.select("doc_id", "text").mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    return np.sort(np.array([r["h"] for r in rows.orderBy(F.desc("n"), "h").limit(OFTEN).collect()], np.int64))


def _within(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(x), bool)
    return sorted_values[np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)] == x


_SUFFIX = "part long, h long, whole long, doc_id long, first int, count int, fresh boolean, known boolean"


def suffixes(docs: DataFrame, hot: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Sampled suffixes of a batch with the part they are dealt to; `known` ones repeat a run that this task met before."""
    common = docs.sparkSession.sparkContext.broadcast(hot)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[int, int] = {}
        held: list[tuple] = []
        size = 0

        def flush():
            h, whole, doc, first, count, known = (np.concatenate(c) for c in zip(*held, strict=True))
            # What a task knows to be a repeat needs no partner: it is dealt evenly.
            alone = _mix(doc.view(np.uint64) * _M + first.view(np.uint64)).view(np.int64)
            part = np.where(known, alone, np.where(_within(common.value, h), whole, h))
            return _table({"part": (part, pa.int64()), "h": (h, pa.int64()), "whole": (whole, pa.int64()), "doc_id": (doc, pa.int64()), "first": (first, pa.int32()), "count": (count, pa.int32()), "fresh": (np.ones(len(h), bool), pa.bool_()), "known": (known, pa.bool_())})

        for i, data in _texts(parts):
            if i is None:
                continue
            h, whole, first, count = runs_of(data, length, gram)
            known = np.fromiter((met.setdefault(x, i) < i for x in whole.tolist()), bool, len(whole))
            held.append((h, whole, np.full(len(h), i), first, count, known))
            size += len(h)
            if size > 200_000:
                yield flush()
                held, size = [], 0
                if len(met) > 500_000:
                    met.clear()
        if size:
            yield flush()

    return docs.select("doc_id", "text").mapInArrow(run, _SUFFIX)


_SCAN = "kind int, h long, whole long, doc_id long, first int, count int, fresh boolean"
_REPEAT, _COMPARE, _NEW = 0, 1, 2


def merge_scan(rows: DataFrame, hot: np.ndarray, keep_new: bool) -> DataFrame:
    """Rows of a batch and of the levels in sorted order -> whole repeats, runs to compare by window, and new runs."""
    common = rows.sparkSession.sparkContext.broadcast(hot)
    names = ["h", "whole", "doc_id", "first", "count", "fresh", "known"]

    def scan(c: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        h, whole, fresh = c["h"], c["whole"], c["fresh"]
        known = c["known"]
        lead = np.ones(len(h), bool)
        same = (h[1:] == h[:-1]) & (whole[1:] == whole[:-1])
        lead[1:] = ~same
        starts = np.flatnonzero(lead)
        group = np.cumsum(lead) - 1
        at_start = (c["doc_id"] == c["doc_id"][starts][group]) & (c["first"] == c["first"][starts][group])
        repeat = (known | ~(lead | at_start)) & fresh
        new_class = np.ones(len(h), bool)
        new_class[1:] = h[1:] != h[:-1]
        cls = np.cumsum(new_class) - 1
        runs = np.bincount(cls, weights=lead & ~known)
        has_fresh = np.bincount(cls, weights=fresh & lead & ~known) > 0
        compare = lead & ~known & (((runs > 1) & has_fresh)[cls] | _within(common.value, h))
        for kind, chosen in ((_REPEAT, repeat), (_COMPARE, compare), *([(_NEW, lead & fresh & ~known)] if keep_new else [])):
            k = np.flatnonzero(chosen)
            if len(k):
                yield _table({"kind": (np.full(len(k), kind), pa.int32()), **{n: (c[n][k], pa.from_numpy_dtype(c[n].dtype)) for n in names[:-1]}})

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry: dict[str, np.ndarray] | None = None
        for batch in parts:
            got = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in names}
            if carry is not None:
                got = {n: np.concatenate((carry[n], got[n])) for n in names}
            change = np.flatnonzero(got["h"][1:] != got["h"][:-1])
            cut = int(change[-1]) + 1 if len(change) else 0
            if cut:
                yield from scan({n: v[:cut] for n, v in got.items()})
            carry = {n: v[cut:] for n, v in got.items()}
        if carry is not None and len(carry["h"]):
            yield from scan(carry)

    # Runs that a task has met before need no look-up: they sort behind the first of their run and pass through.
    dealt = rows.repartition("part").sortWithinPartitions("h", "whole", "known", "doc_id", "first")
    return dealt.drop("part").mapInArrow(run, _SCAN)


def windows(docs: DataFrame, compare: DataFrame, hot: np.ndarray, length: int = LENGTH) -> DataFrame:
    """Runs to compare with their bytes; those of common k-grams window by window."""
    # Two integers a run keep the lists small: its k-gram, and place, number of windows and freshness together.
    packed = F.shiftleft(F.col("first").cast("long"), 20) + F.col("count") * 2 + F.col("fresh").cast("int")
    wanted = compare.groupBy("doc_id").agg(F.flatten(F.collect_list(F.array("h", packed))).alias("runs"))
    texts = join_small(docs.select("doc_id", "text"), stored(wanted, "runs"), ["doc_id"], "inner")
    common = docs.sparkSession.sparkContext.broadcast(hot)
    schema = "part long, h long, doc_id long, first int, fresh boolean, bytes binary"

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in parts:
            for at in range(0, whole_batch.num_rows, 500):
                batch = whole_batch.slice(at, 500)
                out: list[tuple] = []
                for (i, data), runs in zip(_texts(iter([batch])), batch.column("runs").to_pylist(), strict=True):
                    text = data.tobytes()
                    grams = np.array(runs[::2], np.int64)
                    for h, code, one_by_one in zip(runs[::2], runs[1::2], _within(common.value, grams).tolist(), strict=True):
                        a, n, fresh = code >> 20, (code & 0xFFFFF) >> 1, bool(code & 1)
                        if one_by_one:
                            for s in range(a, a + n):
                                key = int.from_bytes(hashlib.blake2b(text[s : s + length], digest_size=8).digest(), "little", signed=True)
                                out.append((key, h, i, s, fresh, text[s : s + length]))
                        else:
                            out.append((h, h, i, a, fresh, text[a : a + n - 1 + length]))
                cols = list(zip(*out, strict=True)) or [[]] * 6
                types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["part", "h", "doc_id", "first", "fresh", "bytes"])

    return texts.mapInArrow(run, schema)


def compare_windows(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, start, stop of windows of fresh runs that equal an earlier window of a run with the same k-gram."""

    def repeats(table: pa.Table) -> Iterator[pa.RecordBatch]:
        data = np.frombuffer(b"".join(table.column("bytes").to_pylist()), np.uint8)
        sizes = pc.binary_length(table.column("bytes")).to_numpy().astype(np.int64)
        counts = sizes - length + 1
        row = np.repeat(np.arange(len(counts)), counts)
        inside = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        at = (np.cumsum(sizes) - sizes)[row] + inside
        sums = _sums(data)
        _, down = _powers(len(data))
        key = _mix((sums[at + length] - sums[at]) * down[at]) ^ _mix(table.column("h").to_numpy().view(np.uint64))[row]
        doc, start = table.column("doc_id").to_numpy()[row], table.column("first").to_numpy().astype(np.int64)[row] + inside
        order = np.lexsort((start, doc, key))
        key, doc, start, fresh = key[order], doc[order], start[order], table.column("fresh").to_numpy()[row][order]
        lead = np.ones(len(key), bool)
        lead[1:] = key[1:] != key[:-1]
        first = np.flatnonzero(lead)[np.cumsum(lead) - 1]
        gone = fresh & ((doc != doc[first]) | (start != start[first]))
        d, s = doc[gone], start[gone]
        order = np.lexsort((s, d))
        d, s = d[order], s[order]
        if len(d):  # neighbouring windows as one interval
            cut = np.flatnonzero(np.concatenate(([True], (d[1:] != d[:-1]) | (s[1:] > s[:-1] + 1))))
            last = np.append(cut[1:] - 1, len(d) - 1)
            yield _table({"doc_id": (d[cut], pa.int64()), "start": (s[cut], pa.int64()), "stop": (s[last] + length, pa.int64())})

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry: list[pa.Table] = []
        held = 0
        for batch in parts:
            for at in range(0, batch.num_rows, 20_000):
                piece = pa.Table.from_batches([batch.slice(at, 20_000)])
                carry.append(piece)
                held += piece.num_rows
                if held < 20_000:
                    continue
                all_ = pa.concat_tables(carry).combine_chunks()
                part = all_.column("part").to_numpy()
                change = np.flatnonzero(part[1:] != part[:-1])
                cut = int(change[-1]) + 1 if len(change) else 0
                if cut:
                    yield from repeats(all_.slice(0, cut))
                carry, held = [all_.slice(cut)], all_.num_rows - cut
        if held:
            yield from repeats(pa.concat_tables(carry).combine_chunks())

    return rows.repartition("part").sortWithinPartitions("part").mapInArrow(run, "doc_id long, start long, stop long")


class SuffixIndex:
    """The levels: tables of runs (h, whole, doc_id, first, count) of earlier batches, the largest first."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM, hot: np.ndarray | None = None) -> None:
        self.length, self.gram = length, gram
        self.hot = np.zeros(0, np.int64) if hot is None else hot
        self.levels: list[tuple[int, DataFrame]] = []

    def add(self, batch: DataFrame, all_docs: DataFrame, more: bool = True) -> list[DataFrame]:
        """Intervals (doc_id, start, stop) to remove from the batch; `more`: whether batches follow, else no level is made."""
        rows = suffixes(batch, self.hot, self.length, self.gram)
        for _, level in self.levels:
            old = level.withColumn("part", F.col("h") if not len(self.hot) else _part(self.hot)("h", "whole"))
            rows = rows.unionByName(old.withColumns({"fresh": F.lit(False), "known": F.lit(False)}).select(*rows.columns))
        scan = stored(merge_scan(rows, self.hot, more), "scan")
        near = windows(all_docs, scan.where(F.col("kind") == _COMPARE), self.hot, self.length)
        whole = scan.where(F.col("kind") == _REPEAT)
        out = [whole.select("doc_id", F.col("first").cast("long").alias("start"), (F.col("first") + F.col("count") - 1 + self.length).cast("long").alias("stop")), compare_windows(near, self.length)]
        if more:
            level = scan.where(F.col("kind") == _NEW).select("h", "whole", "doc_id", "first", "count")
            self.levels.append((level.count(), level))
            while len(self.levels) > 1 and self.levels[-1][0] * 2 > self.levels[-2][0]:
                (n, small), (m, large) = self.levels.pop(), self.levels.pop()
                self.levels.append((n + m, stored(large.unionByName(small), "level")))
        return out


def _part(hot: np.ndarray):
    @F.pandas_udf("long")
    def part(h, whole):
        return whole.where(_within(hot, h.to_numpy()), h)

    return part


def _spans(intervals: DataFrame) -> DataFrame:
    """doc_id and its maximal removed spans (starts, stops)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            starts, stops = [], []
            for found in batch.column("found").to_pylist():
                a, b = [], []
                for x in sorted((r["start"], r["stop"]) for r in found):
                    if b and x[0] <= b[-1]:
                        b[-1] = max(b[-1], x[1])
                    else:
                        a.append(x[0])
                        b.append(x[1])
                starts.append(a)
                stops.append(b)
            yield _table({"doc_id": (batch.column("doc_id"), pa.int64()), "starts": (starts, pa.list_(pa.int64())), "stops": (stops, pa.list_(pa.int64()))})

    return intervals.groupBy("doc_id").agg(F.collect_list(F.struct("start", "stop")).alias("found")).mapInArrow(run, "doc_id long, starts array<long>, stops array<long>")


def repeated_spans(docs: DataFrame, batches: int = 8, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, starts, stops of the byte spans to remove; documents without any are absent."""
    docs = docs.select("doc_id", "text")
    index = SuffixIndex(length, gram, often(docs, length, gram))
    cuts = docs.agg(F.percentile_approx("doc_id", [k / batches for k in range(1, batches)] or [0.5], 10_000)).first()[0] or [0]
    edges = sorted(set(cuts)) if batches > 1 else []
    found: list[DataFrame] = []
    for k in range(len(edges) + 1):
        low = F.col("doc_id") > F.lit(edges[k - 1]) if k else F.lit(True)
        high = F.col("doc_id") <= F.lit(edges[k]) if k < len(edges) else F.lit(True)
        found += index.add(docs.where(low & high), docs, more=k < len(edges))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return stored(_spans(out), "spans")


def remove_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (the remaining bytes) of every document."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                rows = []
                for (i, data), starts, stops in zip(_texts(iter([batch])), batch.column("starts").to_pylist(), batch.column("stops").to_pylist(), strict=True):
                    text, kept, last = data.tobytes(), [], 0
                    for a, b in zip(starts or (), stops or (), strict=True):
                        kept.append(text[last:a])
                        last = b
                    left = b"".join([*kept, text[last:]])
                    rows.append((i, len(text), len(text) - len(left), len(starts or ()), left))
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 4 + [pa.binary()], strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    joined = join_small(docs.select("doc_id", "text"), spans, ["doc_id"], "left")
    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op6_repeated_spans(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = remove_spans(docs, repeated_spans(docs))
    return out.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
