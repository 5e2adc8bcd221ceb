"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over a bounded sample of labelled text. A text is parsed against each automaton
into longest matches, across words; the language with the least entropy wins: phrases per byte times the logarithm of the
sample's length (of MIN_BYTES where it is shorter), so samples of unequal size compare. Text is lower-cased UTF-8 with white
space runs as one space; digits and punctuation stay. A phrase ends at every SEGMENT bytes, the same for all languages,
so segments of many texts are parsed side by side. A tie goes to the label that sorts first.

The sample is bounded: `docs_per_lang` passages and `bytes_per_lang` bytes a language, and TOTAL_DOCS and TOTAL_BYTES over
all; where these are short the largest samples shrink first, every label stays. A passage is taken at a place that the hash of
the row's key chooses. Labels that are null teach nothing. Null or letterless text gives `und` with score 0; without labelled
text every text with letters gives `und`. Repeated rows are rows like any other; an empty table gives an empty result; other
columns pass through, but for lang_pred and score, which replace columns of these names.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridframe.llm.common import hold, join_small, stored

DOCS_PER_LANG = 200
BYTES_PER_LANG = 60_000
TOTAL_DOCS = 40_000
TOTAL_BYTES = 300_000
MIN_BYTES = 2_000
SEGMENT = 4096
BATCH_BYTES = 8_000_000
_PARTS = 1 << 30
_LETTER = re.compile(r"[^\W\d_]")


def plain(text: str) -> bytes:
    """The bytes that are parsed."""
    return " ".join(text.lower().split()).encode()


def suffix_automaton(data: bytes) -> list[dict[int, int]]:
    """Transitions of each state of the automaton of all substrings."""
    steps: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for ch in data:
        cur = len(steps)
        steps.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and ch not in steps[p]:
            steps[p][ch] = cur
            p = link[p]
        if p >= 0:
            q = steps[p][ch]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(steps)
                steps.append(dict(steps[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and steps[p].get(ch) == q:
                    steps[p][ch] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return steps


class Automaton:
    """A language's automaton as one table: for (state, byte) the next state and how many phrases end before it."""

    def __init__(self, sample: bytes) -> None:
        steps = suffix_automaton(sample)
        letters = sorted(set(sample))
        self.code = np.zeros(256, np.uint8)  # 0 is every byte that the sample lacks
        self.code[letters] = np.arange(1, len(letters) + 1)
        self.width = len(letters) + 1
        # Without a transition the phrase ends and the next one begins with the byte, or ends again if it is unknown.
        table = np.zeros((len(steps), self.width), np.int64)
        start = np.zeros(self.width, np.int64)
        for ch, to in steps[0].items():
            start[self.code[ch]] = to * self.width
        table[:] = start * 4 + 1
        table[:, 0] = 2
        table[0] -= 1
        rows = np.repeat(np.arange(len(steps)), [len(s) for s in steps])
        table[rows, self.code[[ch for s in steps for ch in s]]] = np.array([to for s in steps for to in s.values()], np.int64) * (4 * self.width)
        self.table = table.astype(np.int32).ravel()

    def phrases(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Longest matches that cover each segment of data; segments come the longest first."""
        coded = self.code[data]
        state, n, at = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), starts.copy()
        active = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), "left")
        for k in active.tolist():
            v = self.table[state[:k] + coded[at[:k]]]
            n[:k] += v & 3
            state[:k] = v >> 2
            at[:k] += 1
        return n + (state > 0)


class Model:
    """One automaton a language."""

    def __init__(self, samples: dict[str, bytes]) -> None:
        self.langs = sorted(samples)
        self.automata = [Automaton(samples[x]) for x in self.langs]
        self.bits = np.log(np.array([max(MIN_BYTES, len(samples[x])) for x in self.langs], np.float64))

    def rates(self, texts: list[bytes]) -> np.ndarray:
        """Entropy of each text (a row) under each language."""
        sizes = np.array([len(t) for t in texts], np.int64)
        parts = -(-sizes // SEGMENT)
        owner = np.repeat(np.arange(len(texts)), parts)
        inside = (np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)) * SEGMENT
        starts, length = (np.cumsum(sizes) - sizes)[owner] + inside, np.minimum(SEGMENT, sizes[owner] - inside)
        order = np.argsort(-length, kind="stable")
        data = np.frombuffer(b"".join(texts), np.uint8)
        found = [np.bincount(owner[order], weights=a.phrases(data, starts[order], length[order]), minlength=len(texts)) for a in self.automata]
        return np.stack(found, 1) * self.bits / np.maximum(sizes, 1)[:, None]

    def predict(self, texts: Iterable[str | None]) -> tuple[list[str], list[float]]:
        """Label and score of each text."""
        texts = list(texts)
        langs, scores = ["und"] * len(texts), [0.0] * len(texts)
        told = [i for i, t in enumerate(texts) if t and self.langs and _LETTER.search(t)]
        at = 0
        while at < len(told):
            part, size = [], 0
            while at < len(told) and size < BATCH_BYTES:
                part.append(told[at])
                size += len(texts[told[at]])
                at += 1
            rates = self.rates([plain(texts[i]) for i in part])
            best = rates.argmin(1)
            least = rates[np.arange(len(part)), best]
            second = np.partition(rates, 1, 1)[:, 1] if len(self.langs) > 1 else np.full(len(part), np.inf)
            for i, b, score in zip(part, best.tolist(), np.where(second > 0, 1 - least / np.maximum(second, 1e-300), 0.0).tolist(), strict=True):
                langs[i], scores[i] = self.langs[b], min(1.0, max(0.0, score))
        return langs, scores


_MODELS: dict[int, Model] = {}


def _model(samples: dict[str, bytes]) -> Model:
    """The automata are built once a worker process; another sample replaces them."""
    hold("langid", _MODELS.clear)
    key = hash(tuple(sorted(samples.items())))
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = Model(samples)
    return _MODELS[key]


def level(sizes: Iterable[tuple[int, int]], bound: int, total: int) -> int:
    """The largest cap up to `bound`, 1 at least, under which sizes (size, times) cut to it sum to at most `total`."""
    left = sum(times for _, times in sizes)
    for size, times in sorted(sizes):
        if size * left > total:
            return max(1, min(bound, total // left))
        total -= size * times
        left -= times
    return bound


def sample_texts(labelled: DataFrame, docs_per_lang: int = DOCS_PER_LANG, bytes_per_lang: int = BYTES_PER_LANG) -> dict[str, bytes]:
    """A bounded sample of labelled text (text, lang, key) a language, chosen by a hash of the key."""
    labelled = labelled.where("lang is not null")
    counts = stored(labelled.groupBy("lang").agg(F.count("*").alias("of")), "langs")
    sizes = [(min(row["of"], docs_per_lang), row["times"]) for row in counts.groupBy("of").agg(F.count("*").alias("times")).collect()]
    docs_each = level(sizes, docs_per_lang, TOTAL_DOCS)
    # So few rows a language reach the ranking, however many there are.
    share = F.ceil(F.lit(float(_PARTS * 4 * docs_each)) / F.col("of"))
    passage = F.greatest(F.lit(1), F.floor(F.lit(bytes_per_lang) / F.least("of", F.lit(docs_each)))).cast("int")
    chosen = counts.select("lang", share.alias("share"), passage.alias("passage"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("key"), "key")
    offset = F.pmod(F.xxhash64("key", F.lit(1)), F.greatest(F.length("text") - F.col("passage"), F.lit(0)) + 1) + 1
    few = (
        join_small(labelled.select("lang", "key", "text"), chosen, ["lang"], "inner")
        .where(F.pmod(F.xxhash64("key"), F.lit(_PARTS)) < F.col("share"))
        .where("text is not null and length(text) > 0")
        .select("lang", "key", F.substring("text", offset.cast("int"), F.col("passage")).alias("text"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= docs_each)
    )
    texts: dict[str, list[bytes]] = {}
    for row in few.orderBy("lang", "rank").collect():  # at most docs_per_lang passages a language, bytes_per_lang characters in all
        texts.setdefault(row["lang"], []).append(plain(row["text"]))
    out = {lang: (b" " + b" ".join(parts) + b" ")[:bytes_per_lang] for lang, parts in texts.items()}
    size = level([(len(v), 1) for v in out.values()], bytes_per_lang, TOTAL_BYTES)
    return {k: v[:size] for k, v in out.items()}


def predict_language(docs: DataFrame, samples: dict[str, bytes]) -> DataFrame:
    """docs with text -> every column of docs, lang_pred and score."""
    model = docs.sparkSession.sparkContext.broadcast(samples)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = _model(model.value)
        for part in texts:
            langs, scores = own.predict(part)
            yield pd.DataFrame({"lang_pred": langs, "score": scores})

    # A filter on the label that follows would be pushed below and predict once more, in workers of its own with models of their own.
    predict = predict.asNondeterministic()
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    told = docs.select(F.struct(*kept).alias("_row"), predict("text").alias("_told"))
    return told.select(*[F.col(f"_row.`{c}`") for c in kept], "_told.lang_pred", "_told.score")


def held_out(column: str = "doc_id"):
    """Whether a row is kept from learning: crc32 of the id as text, mod 5, is 0."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0


def identify(docs: DataFrame, docs_per_lang: int = DOCS_PER_LANG, bytes_per_lang: int = BYTES_PER_LANG) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document, learnt from those that aren't held out.

    A row without doc_id has no remainder: it is not held out, and teaches nothing.
    """
    flagged = docs.select("doc_id", "text", "lang", F.coalesce(held_out(), F.lit(False)).alias("held_out"))
    samples = sample_texts(flagged.where("not held_out and doc_id is not null").withColumn("key", F.col("doc_id")), docs_per_lang, bytes_per_lang)
    return predict_language(flagged.drop("lang"), samples).select("doc_id", "held_out", "lang_pred", "score")


def op5_language(spark, sf_dir: str) -> DataFrame:
    return identify(spark.read.parquet(f"{sf_dir}/documents.parquet"))
