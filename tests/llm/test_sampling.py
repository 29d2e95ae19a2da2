"""Mixing, packing, tokenization and top-k search against brute force."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm import mixing, packing, subwords, topk


def fill(sizes, budget, cap=2):
    """Water filling by the rule itself: share by weight, cap, reshare."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    while open_:
        left = budget - sum(target.values())
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > cap * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / total for s in open_}
        for s in over:
            target[s] = cap * sizes[s]
            open_.remove(s)
    return target


@pytest.fixture(scope="module")
def mixed(docs_of):
    rng = random.Random(5)
    rows = [(i, "w " * rng.choice([0, 1, 3, 20, 50]), rng.choice(["a", "a", "a", "a", "b", "", "Zé", None, "c", "d"])) for i in range(400)]
    rows += [(1000, None, "b"), (7, rows[7][1], rows[7][2]), (7, rows[7][1], rows[7][2]), (None, "x y", "a"), (1001, "one " * 3000, "d")]
    docs = docs_of(rows).withColumn("size", mixing.word_count("text")).withColumn("q", (F.col("doc_id") % 3).cast("double"))
    return rows, mixing.mix(docs, "size", quality="q", carry=("source",)).collect()


def test_mix_meets_its_targets(mixed):
    rows, got = mixed
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = fill(sizes, 1.5 * sum(sizes.values()))
    for s, target in want.items():
        mine = [r for r in got if r["source"] == s]
        assert all(r["source_size"] == sizes[s] and math.isclose(r["target"], target, rel_tol=1e-9, abs_tol=1e-9) for r in mine)
        assert all(0 <= r["copies"] <= 2 and r["taken"] == r["size"] * r["copies"] for r in mine)
        if sizes[s]:
            assert max(r["copies"] for r in mine) - min(r["copies"] for r in mine) <= 1  # whole epochs first
        assert abs(sum(r["taken"] for r in mine) - target) <= max(r["size"] for r in mine)


def test_mix_prefers_heavy_documents(docs_of):
    docs = docs_of([(i, "w", "a") for i in range(3000)] + [(5000 + i, "w", "b") for i in range(9000)])
    docs = docs.withColumn("size", F.lit(1)).withColumn("q", F.when(F.col("doc_id") % 2 == 0, 3.0).otherwise(1.0))
    got = mixing.mix(docs, "size", quality="q", carry=("source",), weights=(1, 1), share=0.5).where("source = 'b'").groupBy("doc_id").agg(F.sum("copies").alias("c"))
    even, odd = (got.where(f"doc_id % 2 = {i}").agg(F.avg("c")).first()[0] for i in (0, 1))
    assert even > 1.5 * odd > 0


def test_mix_of_empty_tables(docs_of):
    docs = docs_of([]).withColumn("size", mixing.word_count("text"))
    assert mixing.mix(docs, "size").collect() == []
    none = mixing.mix(docs_of([(1, None, "a"), (2, "", None)]).withColumn("size", F.lit(0)), "size").collect()
    assert [r["taken"] for r in none] == [0, 0]


ODD = ["Ünïcödé ÀÉ×÷ <|endoftext|>x it's I'LL can't 123abc!?..", "a b   c", "é ́x é", "İstanbul ǅ ß STRASSE",
       "\x00\x1c\x1f a\x85b", "日本語 text ½ ²³ªº µ", "<|startoftext|> hi", "a" * 3000, "'s'S's''ll'LL", "ﬁ ﬀ ﻿", "", " ", "We'Re"]


def test_ids_are_the_tokenizers_own(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(subwords, "CACHE_WORDS", 3)
    monkeypatch.setattr(subwords, "CACHE_PIECES", 3)
    bpe, whole = subwords.WordBpe(subwords.default_path()), Tokenizer.from_file(subwords.default_path())
    for t in [*ODD, " ".join(ODD)]:
        assert np.frombuffer(bpe.packed(t.encode()), "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids


def best_fit_plain(lengths, size):
    room, at = [], [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [(r, w) for w, r in enumerate(room) if r >= lengths[i]]
        if fits:
            least = min(r for r, _ in fits)
            w = next(w for r, w in fits if r == least)
        else:
            w = len(room)
            room.append(size)
        at[i] = w
        room[w] -= lengths[i]
    return sorted(room)


def test_best_fit_decreasing_fills_like_the_plain_search():
    rng = random.Random(2)
    for size in (1, 7, 100, 4096):
        lengths = np.array([rng.randint(1, size) for _ in range(300)])
        at, offset = packing.best_fit_decreasing(lengths, size)
        used = {}
        for w, o, n in sorted(zip(at.tolist(), offset.tolist(), lengths.tolist())):
            assert o == used.get(w, 0)
            used[w] = o + n
        assert sorted(size - u for u in used.values()) == best_fit_plain(lengths.tolist(), size)


def test_pack_places_every_id_once(docs_of):
    from tokenizers import Tokenizer

    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(ODD[:5]) for _ in range(rng.choice([0, 1, 4, 30])))) for i in range(80)]
    rows += [(200, None), (201, ""), (3, rows[3][1]), (None, "null key"), (202, "word " * 400)]
    got = packing.pack(docs_of(rows), window=64, group_pieces=40, with_ids=True).collect()
    whole, seqs, have = Tokenizer.from_file(subwords.default_path()), {}, []
    by = {}
    for r in got:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by.setdefault((r["doc_id"], r["start"]), []).append(np.frombuffer(r["ids"], "<u4").tolist())
    for s in seqs.values():
        end = 0
        for offset, n in sorted(s):
            assert offset == end
            end += n
        assert end <= 64
    for k, t in rows:
        ids = whole.encode(t or "", add_special_tokens=False).ids + [2]
        for start in range(0, len(ids), 64):
            by[k, start].remove(ids[start:start + 64])
            have.append(start)
    assert not any(by.values()) and len(have) == len(got)
    assert packing.pack(docs_of([])).collect() == []


def vector_table(spark, rows):
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                           T.StructField("block", T.StringType()), T.StructField("id", T.StringType())])
    return spark.createDataFrame([(*r, "x", "y") for r in rows], schema)


def top_brute(rows, k):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good[i] = max(good.get(i, v), v)
    ints = {i: [math.floor(256 * x) for x in v] for i, v in good.items()}
    out = []
    for q in sorted(i for i in ints if i % 5 == 0):
        held = {i: min(max(sum(a * b for a, b in zip(ints[q], v)), -2 ** 63), 2 ** 63 - 1) for i, v in ints.items() if i != q}
        out += [(q, n + 1, i, held[i]) for n, i in enumerate(sorted(held, key=lambda i: (-held[i], i))[:k])]
    return out


@pytest.mark.parametrize("lists", [1, 2, 4])
def test_top_k_equals_brute_force(spark, monkeypatch, lists):
    monkeypatch.setattr(topk, "VECTOR_BLOCK", 40)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 10)
    rng = random.Random(lists)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(8)]) for i in range(150)]
    rows += [(200 + i, rows[10][1]) for i in range(40)]  # ties
    rows += [(300, None), (301, [None] * 8), (302, [float("nan")] * 8), (303, [float("inf")] * 8), (None, rows[0][1]),
             (305, []), (310, [1.0, 2.0]), (20, rows[20][1]), (21, [9.0] * 8), (-5, rows[3][1]), (315, [0.0] * 8)]
    got = topk.top_k(vector_table(spark, rows), F.col("id") % 5 == 0, lists=lists).collect()
    assert sorted(tuple(r) for r in got) == top_brute(rows, 5)


def test_top_k_with_huge_components(spark):
    rows = [(i, [1e15 * i, -3.0, 1e300 if i == 7 else 0.5]) for i in range(9)]
    for k in (3, 8):
        got = topk.top_k(vector_table(spark, rows), F.col("id") % 5 == 0, k=k).collect()
        assert sorted(tuple(r) for r in got) == top_brute(rows, k)


def test_top_k_of_few_or_no_vectors(spark):
    assert topk.top_k(vector_table(spark, []), F.col("id") % 5 == 0).collect() == []
    assert topk.top_k(vector_table(spark, [(1, [1.0])]), F.col("id") % 5 == 0).collect() == []
    got = topk.top_k(vector_table(spark, [(5, [1.0]), (1, [1.0]), (2, [2.0])]), F.col("id") % 5 == 0).collect()
    assert sorted((r["rank"], r["vec_id"], r["score"]) for r in got) == [(1, 2, 512 * 256), (2, 1, 65536)]


def test_vectors_that_overflow_once_scaled_take_no_part(spark):
    rows = [(0, [1e307, 1.0]), (1, [1.0, 1.0]), (5, [2.0, 0.5]), (6, [-1e307, 0.0])]
    got = topk.top_k(vector_table(spark, rows), F.col("id") % 5 == 0).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got] == [(5, 1, 1, 512 * 256 + 128 * 256)]


def test_mix_carries_columns_of_clashing_names(docs_of):
    docs = docs_of([(1, "a b", "s"), (2, None, "s")]).withColumn("size", mixing.word_count("text"))
    got = mixing.mix(docs, "size", carry=("id", "n")).collect()
    assert sorted((r["doc_id"], r["id"], r["n"]) for r in got) == [(1, "x", "x"), (2, "x", "x")]
