"""Best-fit packing of tokenised documents into fixed-length sequences.

Documents become token ids (plus an end id), longer ones are cut into full pieces, and pieces are packed by hierarchical
residual packing: leaves of bounded size run best-fit-decreasing, nearly full bins are emitted, and the underfull bins of
eight nodes are merged as items by best fit again, round after round up to the root. A node passes at most `carry` of its
emptiest bins on, so no task holds more than a bounded number of items at any input size.

Null text counts as empty (one end id); special tokens that stand in a text get their ids, as the tokenizer gives them;
repeated rows are documents of their own; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridframe.llm.common import hold, stored

CAPACITY = 2048
LEAF_ITEMS = 8192
FAN_IN = 8
CARRY = 2048
CACHE_WORDS = 900_000
SLICE_ROWS = 2000
_PUNCTUATION = ".,!?;:"


def _ends_in_letter(core: str) -> bool:
    """Whether a word still ends in a letter when the tokenizer has composed and lower-cased it: some letters gain a mark."""
    if not core or not core[-1].isalpha():
        return False
    return core[-1].isascii() or unicodedata.normalize("NFC", core).lower()[-1].isalpha()


class WordIds:
    """Ids of white-space separated words, kept for words seen before; the tokenizer drops white space, so words are independent."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}

    def of(self, words: list[str]) -> list[bytes]:
        """The ids of each word as bytes of unsigned 32-bit integers."""
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        cores: dict[str, str] = {}  # closing ASCII punctuation after a letter is a token run of its own
        for w in words:
            if w not in known:
                core = w.rstrip(_PUNCTUATION)
                cores[w] = core if _ends_in_letter(core) else w
        new = list({x for w, core in cores.items() for x in (core, w[len(core) :]) if x not in known})
        for at in range(0, len(new), 4096):
            part = new[at : at + 4096]
            for w, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                known[w] = array("I", e.ids).tobytes()
        for w, core in cores.items():
            if len(core) < len(w):
                known[w] = known[core] + known[w[len(core) :]]
        return [known[w] for w in words]


_WORDS: dict[str, WordIds] = {}


def _words(path: str) -> WordIds:
    """One vocabulary and its known words a worker process."""
    hold("packing", _WORDS.clear)
    if path not in _WORDS:
        _WORDS[path] = WordIds(path)
    return _WORDS[path]


def _document_ids(texts: pa.Array, path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a batch in one array, and where each document's ids begin (one more entry than documents)."""
    words = _words(path)
    texts = pc.fill_null(texts, "")
    special, lower = np.zeros(len(texts), bool), pc.ascii_lower(texts)
    for token in words.special:
        special |= pc.match_substring(lower, token.lower()).to_numpy(zero_copy_only=False)
    # The tokenizer finds its special tokens in the raw text, whatever stands around them, and in capitals they are plain text:
    # texts that hold one either way go to it whole.
    whole = {i: words.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids for i in np.flatnonzero(special).tolist()}
    lists = pc.ascii_split_whitespace(pc.if_else(pa.array(special), "", lower))
    bounds = lists.offsets.to_numpy()
    coded = lists.flatten().dictionary_encode()
    where = coded.indices.to_numpy()
    per_word = words.of(coded.dictionary.to_pylist())
    sizes = np.fromiter(map(len, per_word), np.int64, len(per_word)) // 4
    flat, first = np.frombuffer(b"".join(per_word), np.uint32), np.cumsum(sizes) - sizes
    counts = sizes[where]
    ends = np.cumsum(counts)
    word_ends = np.concatenate(([0], ends))
    total = int(word_ends[-1])
    take = np.arange(total) - np.repeat(word_ends[:-1], counts) + np.repeat(first[where], counts)
    ids = flat[take]
    cuts = word_ends[bounds - bounds[0]]
    if whole:
        parts = [np.array(whole[i], np.uint32) if i in whole else ids[cuts[i] : cuts[i + 1]] for i in range(len(texts))]
        ids, cuts = np.concatenate(parts), np.concatenate(([0], np.cumsum([len(x) for x in parts])))
    return np.insert(ids, cuts[1:], np.uint32(end_id)).astype("<u4"), cuts + np.arange(len(cuts))


def tokenize_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0, output: str = "ids") -> DataFrame:
    """One row per piece: doc_id, piece, start, length and either its ids (output="ids") or their crc32 (output="crc32")."""
    extra = "ids array<int>" if output == "ids" else "ids_crc32 long"

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                ids, cuts = _document_ids(pc.cast(batch.column("text"), pa.string()), tokenizer_path, end_id)
                rows: list[tuple] = []
                for doc, a, b in zip(batch.column("doc_id").to_pylist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    for k, s in enumerate(range(a, b, capacity)):
                        part = ids[s : min(s + capacity, b)]
                        rows.append((doc, k, s - a, len(part), part.tolist() if output == "ids" else zlib.crc32(part.tobytes())))
                cols = list(zip(*rows, strict=True))
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int32()) if output == "ids" else pa.int64()]
                names = ["doc_id", "piece", "start", "length", extra.split()[0]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

    return docs.select("doc_id", "text").mapInArrow(pieces, f"doc_id long, piece int, start long, length long, {extra}")


def _best_fit(sizes: np.ndarray, capacity: int) -> tuple[list[int], list[int]]:
    """Best fit over sizes (in the given order): bin and offset of each."""
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by space left
    spaces = 0  # bit r set: some bin has r left
    bins, offsets, n = [], [], 0
    for size in sizes.tolist():
        fitting = spaces >> size
        if fitting:
            left = size + (fitting & -fitting).bit_length() - 1
            b = open_bins[left].pop()
            if not open_bins[left]:
                spaces &= ~(1 << left)
        else:
            b, left = n, capacity
            n += 1
        bins.append(b)
        offsets.append(capacity - left)
        left -= size
        if left:
            open_bins[left].append(b)
            spaces |= 1 << left
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = CAPACITY, leaf_items: int = LEAF_ITEMS, carry: int = CARRY, n_items: int | None = None) -> DataFrame:
    """pieces (doc_id, piece, length and others) with sequence_id and offset; sequences hold at most `capacity` and have no gaps."""
    n = pieces.count() if n_items is None else n_items
    nodes = max(1, -(-n // leaf_items))
    own = list(pieces.columns)
    keep = ", ".join(f"{n} {t}" for n, t in pieces.dtypes) + ", sequence_id long, offset long, fill long, done boolean"

    def round_of(number: int):
        def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
            node = int(key[0])
            part = part.sort_values(["fill", "sequence_id", "doc_id", "piece"], ascending=[False, True, True, True], kind="stable", ignore_index=True)
            if number:
                heads = ~part["sequence_id"].duplicated().to_numpy()
                item = np.cumsum(heads) - 1
                sizes = part["fill"].to_numpy()[heads]
            else:
                item, sizes = np.arange(len(part)), part["fill"].to_numpy()
            bins, offsets = (np.array(x, np.int64) for x in _best_fit(sizes, capacity))
            fills = np.bincount(bins, weights=sizes, minlength=int(bins.max()) + 1).astype(np.int64)
            done = fills >= capacity - capacity // 64
            rest = np.flatnonzero(~done)
            done[rest[np.argsort(fills[rest], kind="stable")[carry:]]] = True
            to = bins[item]
            part["offset"] = part["offset"].to_numpy() + offsets[item]
            part["sequence_id"] = (number << 57) | (node << 20) | to
            part["fill"], part["done"] = fills[to], done[to]
            return part[[*own, "sequence_id", "offset", "fill", "done"]]

        return run

    zero = F.lit(0).cast("long")
    items = pieces.select(*own, zero.alias("sequence_id"), zero.alias("offset"), F.col("length").alias("fill"))
    at = items.withColumn("node", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(nodes)))
    rounds, number = [], 0
    while True:
        made = stored(at.groupBy("node").applyInPandas(round_of(number), keep), f"pack{number}")
        last = nodes == 1
        rounds.append(made if last else made.where("done"))
        if last:
            break
        nodes = -(-nodes // FAN_IN)
        at = made.where("not done").drop("done").withColumn("node", F.pmod(F.shiftright("sequence_id", 20) % (1 << 37), F.lit(nodes)))
        number += 1
    out = rounds[0]
    for r in rounds[1:]:
        out = out.unionByName(r)
    return out.select(*own, "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their digests and places in the packed sequences."""
    pieces = stored(tokenize_pieces(docs, tokenizer_path, capacity, output="crc32"), "pieces")
    return pack(pieces, capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and its token ids, from packed pieces that carry ids; a sequence has a bounded number of ids."""
    part = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(part, lambda x: x["ids"])).alias("ids"))


def op2_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
