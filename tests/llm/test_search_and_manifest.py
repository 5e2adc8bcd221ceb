"""Decontamination, lexical search and the Merkle manifest: odd rows, ties, blocks and brute force beside their SQL."""

import collections
import hashlib
import math
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridframe.llm import decontam, lexical, merkle, words

SF = "/root/testdata/sf0.001"
PASSAGE = "alpha Beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
DOC = "doc_id long, text string, lang string, source string, n_chars long, spans int, rank string"
ITEM = "item_id long, text string, doc_id string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), 1, "r") for i, t, s in rows], DOC)


def low(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def cut(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t))


# ---- words


def test_words_equal_the_regex():
    rng = np.random.default_rng(1)
    pool = ["a", "B7", "é", "ÉÀ", "世界", "x" * 7, "y" * 8, "z" * 9, "w" * 17, "w" * 40, " ", "-", "\0", "_", "\n", "İ", "0"]
    texts = ["".join(rng.choice(pool, int(rng.integers(0, 60)))) for _ in range(400)] + [None, "", "w" * 70_000 + " end"]
    known = sorted({w.encode() for t in texts[:300] for w in cut(t)})
    v = words.Vocabulary(known)
    of = {w: k for k, w in enumerate(known)}
    want = [[of.get(w.encode(), -1) for w in cut(t)] for t in texts]
    for size in (words.PIECE_BYTES, 1_000):
        old, words.PIECE_BYTES = words.PIECE_BYTES, size
        got = [[] for _ in texts]
        for part in words.read_words(pa.array(texts), v):
            for t, i in zip(part.text.tolist(), part.ids.tolist(), strict=True):
                got[part.first + t].append(i)
            assert part.counts.tolist() == [len(x) for x in want[part.first : part.first + len(part.counts)]]
        words.PIECE_BYTES = old
        assert got == want
    assert words.Vocabulary([]).ids(b"a b", *words.word_spans(b"a b")).tolist() == [-1, -1]


# ---- 11


def brute_hits(docs, items):
    windows = collections.defaultdict(set)
    for i, t in items:
        w = cut(t)
        for k in range(max(1, len(w) - 9)):
            if w:
                windows[tuple(w[k : k + 10])].add("" if i is None else str(i))
    out = []
    for i, t in docs:
        w = cut(t)
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[x]
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


def hits_of(df):
    return sorted(((r.doc_id, r.n_words, sum(s.stop - s.start for s in r.spans), list(r["items"])) for r in df.collect()), key=repr)


@pytest.mark.parametrize("block_bytes", [decontam.BLOCK_BYTES, 700])
def test_decontamination_of_odd_rows(spark, block_bytes):
    long = " ".join(f"w{k}" for k in range(40_000))
    docs = [
        (1, f"before {PASSAGE.upper()} after", "a"), (1, f"{PASSAGE} {PASSAGE}", "a"), (2, None, None), (3, "", "a"), (4, "alpha beta gamma", "b"), (5, f"{long}, {PASSAGE}. {long}", "b"),
        (6, "short one", "a"), (7, "x short one short one y", "a"), (None, PASSAGE.replace(" ", "--"), "a"), (8, PASSAGE.replace("zeta", "zetta"), "a"), (9, "é" + PASSAGE, "a"),
        (10, "alpha beta gamma delta epsilon", "a"), (11, "zeta eta theta iota kappa lambda mu", "a"), (12, "Weißt du İ 世界 x", None),
    ]
    items = [(1, PASSAGE), (1, "short one"), (10, "gamma " + PASSAGE[11:]), (2, PASSAGE), (None, "SHORT one"), (3, None), (4, " .. "), (5, "weißt du İ 世界"), (2, PASSAGE)]
    got = hits_of(decontam.find_passages(frame(spark, docs), spark.createDataFrame([(*i, "z") for i in items], ITEM), block_bytes=block_bytes))
    assert got == brute_hits([d[:2] for d in docs], items)
    assert (None, 12, 12, ["1", "10", "2"]) in got and (6, 2, 2, ["", "1"]) in got


def test_decontamination_of_empty_tables(spark):
    docs, items = frame(spark, [(1, PASSAGE, "a")]), spark.createDataFrame([(1, PASSAGE, "z")], ITEM)
    assert hits_of(decontam.find_passages(docs, items.limit(0))) == [(1, 12, 0, [])]
    assert decontam.find_passages(docs.limit(0), items).count() == 0


def test_decontamination_removes_spans_or_documents(spark):
    docs = frame(spark, [(1, f"Keep this, {PASSAGE}! And this; {PASSAGE}", "a"), (2, "clean text", "a"), (3, None, "a")])
    items = spark.createDataFrame([(1, PASSAGE, "z")], ITEM)
    kept = decontam.decontaminate(docs, items)
    assert kept.columns == docs.columns
    assert {r.doc_id: r.text for r in kept.collect()} == {1: "Keep this, ! And this; ", 2: "clean text", 3: None}
    assert {r.doc_id for r in decontam.decontaminate(docs, items, "documents").collect()} == {2, 3}
    with pytest.raises(ValueError):
        decontam.decontaminate(docs, items, "words")


def test_decontamination_blocks_agree_on_the_tables(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    one, many = (hits_of(decontam.find_passages(docs, items, ["doc_id"], block_bytes=b)) for b in (decontam.BLOCK_BYTES, 40_000))
    assert one == many and any(r[2] for r in one)


# ---- 12


def brute_ranks(docs, items, k=10):
    counts = [(i, collections.Counter(cut(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = collections.Counter(t for _, c in counts for t in c)
    w = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * f + 1))) for t, f in df.items()}
    out = []
    for item, text in items:
        terms, found = collections.Counter(cut(text)), []
        for i, c in counts:
            m = 25 + 75 * sum(c.values()) * n // total
            if s := sum(x * w[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t, x in terms.items() if t in c):
                found.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def ranks_of(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=repr)


@pytest.mark.parametrize("block_bytes", [lexical.BLOCK_BYTES, 250])
def test_search_of_odd_rows_and_ties(spark, block_bytes):
    docs = [(k, "tie word here", "a") for k in range(40, 0, -1)] + [(None, "tie word here", "a"), (100, None, "a"), (101, " .. ", "a"), (102, "", None), (5, "tie Word WORD", "b"), (103, "only " * 30_000, "b"), (104, "É é 世界 07", "b")]
    items = [(1, "tie word"), (1, "only"), (None, "É 07"), (2, None), (3, "nothing known"), (4, "tie tie tie word"), (5, "É 07")]
    docs_df, items_df = frame(spark, docs).repartition(5), spark.createDataFrame([(*i, "z") for i in items], ITEM)
    got = ranks_of(lexical.search(docs_df, items_df, block_bytes=block_bytes))
    assert got == brute_ranks([d[:2] for d in docs], items)
    assert lexical.search(docs_df.limit(0), items_df).count() == lexical.search(docs_df, items_df.limit(0)).count() == 0


def test_search_ties_by_id_over_many_tiles(spark):
    docs = [(k, "same text" if k % 3 else "other text", "a") for k in range(3000, 0, -1)]
    got = ranks_of(lexical.search(frame(spark, docs).repartition(3), spark.createDataFrame([(7, "same", "z"), (8, "text", "z")], ITEM)))
    assert got == brute_ranks([d[:2] for d in docs], [(7, "same"), (8, "text")])


def test_tiles_are_exact_and_bounded():
    rng = np.random.default_rng(2)
    n, terms = 70, 900
    item, term = np.nonzero(rng.random((n, terms)) < 0.3)
    weight = rng.integers(0, 2_000, len(item))
    weight[:5] = 10**10  # more than a tile may hold, so it is laid over several
    exact = 10**4 * lexical.IMPACT
    cut_up = lexical.tiles(n, item, term, weight, exact, 16, 64)
    total = np.zeros((n, terms), np.int64)
    for t in cut_up[: 10**5]:
        dense = t.dense()
        assert dense.sum(1).max() * lexical.IMPACT < exact and dense.shape[1] <= 64 and dense.shape[0] <= 16
        total[t.items][:, t.terms] += dense.astype(np.int64)
    want = np.zeros((n, terms), np.int64)
    want[item, term] = weight
    small = want < 10**9
    assert small.sum() == n * terms - 5 and (lexical.tiles(n, item[5:], term[5:], weight[5:], exact, 16, 64) != [])
    again = np.zeros((n, terms), np.int64)
    for t in lexical.tiles(n, item[5:], term[5:], weight[5:], exact, 16, 64):
        np.add.at(again, (t.rows + t.items.start, t.terms[t.cols]), t.weights.astype(np.int64))
    assert (again[small] == want[small]).all()


# ---- 13


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_tree(digests, fanout):
    """Root and each leaf's (left, right) siblings, level by level."""
    paths, at, nodes = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(nodes) > 1:
        for k, p in enumerate(at):
            a = p - p % fanout
            paths[k].append(("".join(nodes[a:p]), "".join(nodes[p + 1 : a + fanout])))
        nodes = [h(*nodes[a : a + fanout]) for a in range(0, len(nodes), fanout)]
        at = [p // fanout for p in at]
    return nodes[0], paths


def brute_manifest(rows, fanout):
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    by = collections.defaultdict(list)
    for r in rows:
        by[r["source"]].append((r["doc_id"] is not None, r["doc_id"] or 0, h(*(enc(r[c]) for c in merkle.FIELDS)), r))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in names:
        by[s].sort(key=lambda x: x[:3])
        trees.append(brute_tree([x[2] for x in by[s]], fanout))
    root, above = brute_tree([t[0] for t in trees], fanout)
    return sorted((repr(x[3]["doc_id"]), x[2], sub, root, h(*(a + b for a, b in [*path, *up]))) for s, (sub, paths), up in zip(names, trees, above, strict=True) for x, path in zip(by[s], paths, strict=True))


@pytest.mark.parametrize("fanout", [2, 3])
def test_manifest_equals_brute_force(spark, fanout):
    sources = [None, "", "a", "b", "é", "z" * 300]
    rows = [(k if k % 17 else None, f"text\n{k % 5}" if k % 7 else None, sources[min(k % 11, 5)] if k % 2 else "a") for k in range(150)] + [(3, "again", "lone"), (5, "copy", "b"), (5, "copy", "b"), (5, "other", "b")]
    df = frame(spark, rows).repartition(7)
    got = merkle.manifest(df, fanout=fanout).collect()
    assert sorted((repr(r.doc_id), r.leaf, r.subroot, r.root, r.proof_sha256) for r in got) == brute_manifest([r.asDict() for r in df.collect()], fanout)
    assert all(r.verified and r.folded_root == r.root for r in got)


def test_manifest_of_a_changed_field_and_of_few_rows(spark):
    df = frame(spark, [(1, "a\nb", "s"), (2, "ab", "s"), (3, None, "s")])
    got = {r.doc_id: r.verified for r in merkle.manifest(df, tampered={"text": F.translate("text", "\n", "")}).collect()}
    assert got == {1: False, 2: True, 3: True}
    one = merkle.manifest(df.where("doc_id = 1")).collect()
    assert len(one) == 1 and one[0].leaf == one[0].subroot == one[0].root == one[0].folded_root and one[0].proof_sha256 == h()
    assert merkle.manifest(df.limit(0)).count() == 0


def test_places_without_gaps_for_a_large_tree(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("tree"), F.lit(1).alias("k"))
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    got = collections.defaultdict(list)
    for r in merkle.placed(df, "tree", ["k"]).collect():
        got[r.tree].append((r.place, r.size))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert all(sorted(v) == [(k, len(v)) for k in range(len(v))] for v in got.values()) and len(got["hot"]) == 3333


def test_sql_of_the_three_reads_whole_tables(spark):
    n = duckdb.sql(f"SELECT count(*) FROM '{SF}/documents.parquet'").fetchall()[0][0]
    assert decontam.op11_decontamination(spark, SF).count() == merkle.op13_merkle_manifest(spark, SF).count() == n
