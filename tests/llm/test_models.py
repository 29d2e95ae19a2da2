"""Quality classifier, language model and web archives: brute force, round trips, held-out accuracy."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from strata.llm import attention, attention_graph, lm, quality, subwords, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# quality -------------------------------------------------------------------------------------------

def junk(rng):
    w = [rng.choice(["stone", "river", "lamp", "salt"]) for _ in range(60)]
    return rng.choice([" ".join(x.upper() + "!!" for x in w), " | ".join(w), " ".join(x + "$$$" for x in w)])


def prose(rng):
    return ". ".join(" ".join(rng.choice(["stone", "river", "lamp", "salt", "and", "the", "of"]) for _ in range(8)).capitalize()
                     for _ in range(rng.choice([2, 8, 60])))


@pytest.fixture(scope="module")
def labelled(spark, docs_of):
    rng = random.Random(1)
    rows = [(i, junk(rng) if i % 4 == 0 else prose(rng)) for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(300)] + [(None, 0), (3, None), (9999, 1)],
                                   T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType())]))
    return rows, docs_of(rows), labels


def test_classifier_on_held_out_rows(labelled):
    rows, docs, labels = labelled
    model = quality.train(docs, labels.where(~quality.held_out()))
    got = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(got[i] >= quality.THRESHOLD) == (i % 4 != 0) for i in held]) >= 0.95
    assert all(0 <= s <= 1 for s in got.values())


def test_classifier_edges(labelled, docs_of):
    _, docs, labels = labelled
    assert quality.train(docs, labels.where("quality = 1")) is None
    assert quality.train(docs, labels.where("1 = 0")) is None
    odd = docs_of([(1, None), (2, ""), (2, ""), (None, "x" * 200_000)])
    assert [r["score"] for r in quality.score(odd, None).collect()] == [0.5] * 4
    got = sorted(((r["doc_id"] or -1), r["score"]) for r in quality.score(odd, quality.Network()).collect())
    assert len(got) == 4 and got[1][1] == got[2][1] == got[3][1]
    assert quality.score(docs_of([]), quality.Network()).collect() == []


def test_chunks_cover_every_window():
    sizes = [0, 1, 5, 255, 256, 257, 1000]
    raw = np.arange(sum(sizes)) % 251
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    chunks, first = quality.chunks_of(raw.astype(np.uint8), offsets)
    for i, n in enumerate(sizes):
        text, seen = raw[offsets[i]:offsets[i + 1]].tolist(), set()
        for j, c in enumerate(chunks[first[i]:first[i + 1]]):
            for w in range(quality.WINDOWS):
                at = j * quality.STEP + w * quality.STRIDE
                part = [x for x in c[w * quality.STRIDE:w * quality.STRIDE + quality.WIDTH].tolist() if x != quality.PAD]
                assert part == text[at:at + quality.WIDTH]
                seen.add(at)
        assert seen >= set(range(0, max(n - quality.WIDTH + 1, 0), quality.STRIDE))


def test_a_score_does_not_depend_on_its_batch():
    rng = random.Random(2)
    texts = [prose(rng).encode() for _ in range(5)] + [b"", b"x"]
    net = quality.Network()
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    together = net.score(np.frombuffer(b"".join(texts), np.uint8), offsets)
    alone = [net.score(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in texts]
    assert np.allclose(together, alone, atol=1e-5)


# language model ------------------------------------------------------------------------------------

def tables(seed=0):
    rng = np.random.default_rng(seed)
    return attention.fit_tables(rng.integers(0, 9, (50, attention.CONTEXTS)).astype(np.float32))


def test_gradients_match_differences():
    t, w = tables(), attention.start_weights()
    rng = np.random.default_rng(1)
    ids, sizes = rng.integers(0, 50, 75), np.array([40, 0, 35])
    keys, target, first, _ = attention.windows(ids, sizes, 49, 50)
    w = {k: x.astype(np.float64) + 0.01 for k, x in w.items()}
    t.code = t.code.astype(np.float64)
    _, g = attention.step(t, w, keys, target, first)
    for k in w:
        for at in [tuple(rng.integers(0, n) for n in w[k].shape) for _ in range(3)]:
            loss = []
            for d in (1e-5, -1e-5):
                w[k][at] += d
                loss.append(attention.step(t, w, keys, target, first)[0])
                w[k][at] -= d
            assert math.isclose((loss[0] - loss[1]) / 2e-5, g[k][at], rel_tol=2e-2, abs_tol=2e-4), k


def test_windows_score_each_id_once_with_only_what_precedes():
    t = tables()
    closes = np.arange(51) % 3 == 0
    s = attention.Scorer(t, attention.start_weights(), closes)
    rng = np.random.default_rng(3)
    for n in (1, 15, 16, 17, 33, 100):
        ids = rng.integers(0, 50, n)
        whole = s.log_probs(ids, np.array([n]), 49)
        assert len(whole) == n
        for cut in (1, n // 2, n - 1):
            if cut:
                changed = ids.copy()
                changed[cut:] = rng.integers(0, 50, n - cut)
                assert np.allclose(s.log_probs(changed, np.array([n]), 49)[:cut], whole[:cut], atol=1e-4)
    # all ids' probabilities after a context add up to 1
    context = rng.integers(0, 50, 20)
    total = sum(math.exp(s.log_probs(np.append(context, i), np.array([21]), 49)[-1]) for i in range(50))
    assert math.isclose(total, 1, abs_tol=1e-3)


def test_scores_against_counts(docs_of):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["the", "Stone", "river,", "of", "É", "lamp"]) for _ in range(rng.choice([0, 1, 30, 90])))) for i in range(60)]
    rows += [(100, None), (101, " \n"), (3, rows[3][1]), (None, "the null key"), (102, "neverseen " * 50)]
    got = lm.lm_scores(docs_of(rows)).collect()
    held = lambda k: zlib.crc32(("" if k is None else str(k)).encode()) % 7 == 2
    words = [[*WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), ""] for _, t in rows]
    c = Counter(w for (k, _), ws in zip(rows, words) if not held(k) for w in ws)
    n, v = sum(c.values()), len(c)
    want = [(k, held(k), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6))
            for (k, _), ws in zip(rows, words)]
    order = lambda r: (r[0] is None, r)
    have = [(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got]
    assert sorted(have, key=order) == sorted(want, key=order)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    trained = [r for r in got if r["held_out"] and r["n_tokens"] > 20]
    assert all(r["score"] / r["n_tokens"] > -3 for r in trained if r["doc_id"] != 102)


def test_scores_of_empty_and_untrained_tables(docs_of):
    assert lm.lm_scores(docs_of([])).collect() == []
    only = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = lm.lm_scores(docs_of([(only, "a held text")])).first()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) == (4, 0, 0, 0.0) and math.isfinite(r["score"])


def test_a_word_of_many_ids_leaves_its_neighbours_alone(docs_of):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["the", "stone", "river", "of", "lamp"]) for _ in range(40))) for i in range(30)]
    held = next(i for i in range(100, 200) if zlib.crc32(str(i).encode()) % 7 == 2)  # no part in training
    digits = "7" * 70_000  # one id each
    short, long = ({r["doc_id"]: r["attention_score"] for r in lm.lm_scores(docs_of([*rows, (held, t)], 1)).collect()}
                   for t in ("77", digits))
    assert all(math.isclose(short[i], long[i], rel_tol=1e-3) for i, _ in rows)
    assert long[held] < 1000 * short[held]


def test_rounds_learn_every_window_of_the_training_texts_once(docs_of):
    rng = random.Random(6)
    held = lambda k: zlib.crc32(str(k).encode()) % 7 == 2
    rows = [(i, " ".join(rng.choice(["the", "stone", "river", "of", "lamp"]) for _ in range(rng.choice([0, 1, 30, 900])))) for i in range(60)]
    docs = docs_of(rows).selectExpr("doc_id as id", "crc32(cast(cast(doc_id as string) as binary)) % 7 = 2 as held", "cast(text as binary) as body")
    blocks = [r.asDict() for r in docs.mapInArrow(lm._read(subwords.default_path(), 8), lm.ROWS).where(f"kind = {lm.TEXTS}").collect()]
    shares = [[lm.training_windows(b, r) for b in blocks] for r in range(lm.ROUNDS)]
    assert all(sum(len(keys) for keys, *_ in share) for share in shares)
    got = Counter((tuple(k), tuple(t), f) for share in shares for x in share for k, t, f in zip(*map(np.ndarray.tolist, x)))
    bpe, want = subwords.WordBpe(subwords.default_path()), Counter()
    for k, text in rows:
        if not held(k):
            ids = np.append(np.frombuffer(bpe.packed(text.encode()), "<u4").astype(np.int64), lm.END)
            keys, target, first, _ = attention.windows(ids, np.array([len(ids)]), lm.END, lm.VOCABULARY)
            want.update((tuple(a), tuple(b), c) for a, b, c in zip(keys.tolist(), target.tolist(), first.tolist()))
    assert got == want


def test_parts_follow_the_bytes_of_the_texts(docs_of, monkeypatch):
    monkeypatch.setattr(lm, "PART_BYTES", 10_000)
    assert lm.parts_for(docs_of([(1, "é" * 100_000), (2, None), (3, "x" * 5)])) == 21
    assert lm.parts_for(docs_of([(i, "x") for i in range(50)])) == lm.parts_for(docs_of([])) == 8


def test_masks_and_row_maxima_equal_the_plain_ones():
    rng = np.random.default_rng(7)
    a = rng.normal(size=(9, attention.QUERIES, attention.KEYS)).astype(np.float32)
    masks = attention.mask(rng.normal(size=attention.KEYS).astype(np.float32))
    assert masks.shape == (2, attention.QUERIES, attention.KEYS)
    for first in (rng.random(9) < 0.5, np.zeros(9, bool), np.ones(9, bool)):
        got, want = a.copy(), a + masks[first.astype(int)]
        attention.add_mask(got, masks, first)
        assert (got == want).all()
        assert (attention.peaks(got) == want.max(-1, keepdims=True)).all()
    assert attention.peaks(a[:0]).shape == (0, attention.QUERIES, 1)


def test_graphs_give_what_numpy_gives():
    pytest.importorskip("onnxruntime")
    assert lm.PRODUCTS is attention_graph
    t, rng = tables(), np.random.default_rng(9)
    t.kind[t.kind == 3] = 4  # a class without ids
    closes = np.arange(51) % 3 == 0
    for scale, near in ((1, 1e-5), (8, 1e-3)):
        w = {k: (x * scale + rng.normal(size=x.shape) * 0.1).astype(np.float32) for k, x in attention.start_weights().items()}
        sizes = np.array([0, 1, 15, 16, 17, 0, 300, 33])
        ids = rng.integers(0, 50, sizes.sum())
        windows = attention.windows(ids, sizes, 49, 50)[:3]
        g, want = attention_graph.Learner(t, w, 0.1).gradients(*windows), attention.step(t, w, *windows)[1]
        assert g.keys() == want.keys()
        for k in want:
            assert np.allclose(g[k].reshape(want[k].shape), want[k], atol=near * abs(want[k]).max()), k
        got = attention_graph.Scorer(t, w, closes).log_probs(ids, sizes, 49, 8)
        assert np.allclose(got, attention.Scorer(t, w, closes).log_probs(ids, sizes, 49), rtol=near, atol=near)
        assert len(attention_graph.Scorer(t, w, closes).log_probs(ids[:0], np.array([0, 0]), 49)) == 0
    both = [kind.Learner(t, attention.start_weights(), 1e-2) for kind in (attention, attention_graph)]
    for learner in both:
        for _ in range(5):
            learner.learn(*windows, batch=7)
    assert both[0].steps == both[1].steps and np.allclose(both[0].flat, both[1].flat, atol=1e-3)


def test_blocks_do_not_depend_on_the_batches(monkeypatch):
    monkeypatch.setattr(lm, "BLOCK", 1000)
    monkeypatch.setattr(lm, "RUN", 70)
    rng = random.Random(8)
    texts = [b"x" * rng.choice([0, 5, 200, 999, 1000, 1001, 3000]) for _ in range(300)]
    table = pa.RecordBatch.from_arrays([pa.array(range(300), pa.int64()), pa.array(texts, pa.binary())], names=["id", "body"])
    cuts = lambda batches: [b["id"].to_pylist() for b in batches]
    want = cuts(lm.by_size((table.slice(i, 70) for i in range(0, 300, 70)), "body", 1000))
    assert sum(want, []) == list(range(300))
    for n in (1, 7, 70, 300):
        assert cuts(lm.blocks(table.slice(i, n) for i in range(0, 300, n))) == want
    assert cuts(lm.blocks(iter([]))) == cuts(lm.blocks(iter([table.slice(0, 0)]))) == []


def test_words_cut_together_have_the_ids_of_words_cut_alone():
    bpe = subwords.WordBpe(subwords.default_path(), 50)
    words = ["the", "don't", "we'll.", "É", "çava", "x1234", "3.5%", "'s", "straße,", "×", "日本語", "a\x01b", "\x01", "<|endoftext|>", "a<|b",
             "ÉCOLE", "İx", "ΟΔΟΣ", "µm", "...", "7" * 300, "é" * 400, "�"]
    words = [w.encode() for w in [*words, *(f"w{i}q" for i in range(200)), *words]] + [b"\xff\xfebad"]
    want = [np.frombuffer(bpe.word(w), "<u4").tolist() for w in words]
    for _ in range(2):
        ids, sizes = bpe.cut(words)
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == want
    assert max(map(len, bpe.found)) <= subwords.LONGEST_KEPT
    assert [len(x) for x in bpe.cut([])] == [0, 0]


def test_forgotten_tokenizers_are_freed():
    import gc
    import weakref

    gone = weakref.ref(subwords.word_bpe(subwords.default_path(), 1000))
    gc.disable()
    try:
        subwords.forget()
        assert gone() is None
    finally:
        gc.enable()


def test_jobs_on_blocks_hold_one_at_a_time(spark, docs_of, monkeypatch):
    assert set(lm.AT_ONCE.values()) == {"1"}
    rows = []
    monkeypatch.setattr(lm.Stage, "save", lambda self, df, name, by=(), options=None, save=lm.Stage.save: (
        rows.append((name, options, spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))), save(self, df, name, by, options))[1])
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert lm.lm_scores(docs_of([(1, "a stone"), (2, "the river")])).count() == 2
    # the texts come some hundred at a time, the blocks one by one, and are written in pages of their own
    assert rows == [("read", lm.PAGES, "500"), ("added", None, before), ("scored", None, "1")]
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


# web archives --------------------------------------------------------------------------------------

def lines_of(data: bytes):
    got = data.split(b"\n")
    return iter(got[:-1] if got[-1] == b"" else got)


CONTENTS = [b"", b"\n", b"a\r\n\r\nb", b"HTTP/1.0 200 OK\r\nA: b\r\n\r\nbody\nhttp://x 1 2 text 5\n", b"HTTP/1.1 404 X\n\nlf only",
            b"HTTP/1.1 200 headers without an end", bytes(range(256)) * 3, b"WARC/1.1\r\nContent-Length: 5\r\n\r\n"]


@pytest.mark.parametrize("version", [1, 2])
def test_arc_round_trip(version):
    data = warc.arc_version_block(version, "test.arc") + b"\n" + b"".join(
        warc.arc_record(version, f"http://h/{i} é", c, ip="1.2.3.4", date="20010203040506") + b"\n" for i, c in enumerate(CONTENTS))
    got = list(warc.parse_arc(lines_of(data)))
    assert got[0].header["url"] == "filedesc://test.arc" and [r.content for r in got[1:]] == CONTENTS
    assert all(r.version == version and r.header["date"] == "20010203040506" for r in got[1:])
    out = [warc.convert(r) for r in got]
    assert [w.header["WARC-Type"] for w in out] == ["warcinfo", *(["resource"] * 3), "response", "response", "response", "resource", "resource"]
    back = list(warc.parse_warc(lines_of(b"".join(w.to_bytes() + b"\r\n\r\n" for w in out))))
    assert [(r.header, r.block) for r in back] == [(w.header, w.block) for w in out]
    assert back[4].header["WARC-Payload-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(CONTENTS[3].split(b"\r\n\r\n")[1]).digest()).decode()
    assert back[4].header["WARC-Date"] == "2001-02-03T04:05:06Z" and back[4].header["WARC-IP-Address"] == "1.2.3.4"


def test_arc_urls_with_blanks_and_bad_archives():
    old = b"http://h/a b c 1.2.3.4 19990101000000 text/html 3\nabc\n"
    assert [(r.header["url"], r.content) for r in warc.parse_arc(lines_of(old))] == [("http://h/a b c", b"abc")]
    for bad in (b"http://h 1.2.3.4 19990101 text/html 30\nabc\n", b"nonsense\n", b"http://h 1.2.3.4 1999 text/html x\n"):
        with pytest.raises(ValueError):
            list(warc.parse_arc(lines_of(bad)))


def test_dates():
    assert warc.warc_date("19990203") == "1999-02-03T00:00:00Z"
    assert warc.warc_date("") == warc.warc_date("99999999999999") == "2000-01-01T00:00:00Z"


def test_pages_round_trip(spark, tmp_path):
    rng = random.Random(1)
    html = [None, "", "<p>é\r\n\r\nWARC/1.1\r\n</p>", "same", "same", "line\n" * 5000, "\n", "\r\n"]
    rows = [(i, rng.choice([None, "http://h/x", "http://h/a b\n"]), rng.choice(html)) for i in range(60)]
    rows += [(70, "u", "once"), (70, "u", "once"), (None, "u", "same")]
    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                           T.StructField("html", T.StringType()), T.StructField("value", T.StringType()), T.StructField("id", T.StringType())])
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], schema).repartition(3)
    got = warc.archive_pages(df).where("type <> 'warcinfo'").collect()
    first = {}
    for k, _, h in rows:
        if k is not None:
            first[h or ""] = min(k, first.get(h or "", k))
    want = []
    for k, _, h in rows:
        body = (h or "").encode()
        again = k is not None and first[h or ""] != k
        want.append((k, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if again else "response",
                     first[h or ""] if again else None, None if again else body))
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    have = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["type"], r["refers_to_id"],
             None if r["payload"] is None else bytes(r["payload"])) for r in got]
    assert sorted(have, key=order) == sorted(want, key=order)
    ids = {r["record_id"] for r in got if r["type"] == "response"}
    assert all(r["refers_to"] in ids for r in got if r["type"] == "revisit")
    # a revisit must be long enough
    few = warc.archive_pages(df, min_revisit=5).where("type = 'revisit'").collect()
    assert few and all(r["payload_bytes"] >= 5 for r in few)
    assert warc.archive_pages(df.limit(0)).collect() == []


def test_archives_are_written_at_the_set_deflate_level(spark, tmp_path):
    rng = random.Random(5)
    html = " ".join(rng.choice(["<p>", "stone", "river", "lamp", str(rng.random())]) for _ in range(30_000))
    df = spark.createDataFrame([(1, "http://h/x", html)], "page_id long, url string, html string").coalesce(1)
    warc.write_arc(df, str(tmp_path / "arc"))
    (data,) = [f.read_bytes() for f in (tmp_path / "arc").glob("part-*.gz")]
    raw = zlib.decompress(data, 31)
    assert html.encode() in raw
    at = {level: len(zlib.compress(raw, level)) for level in (4, 6)}
    assert min(at, key=lambda level: abs(len(data) - at[level])) == 4 and at[4] > 1.01 * at[6]


def test_classifier_learns_from_long_texts(spark, docs_of, monkeypatch):
    rng = random.Random(2)
    rows = [(i, " ".join((junk if i % 2 else prose)(rng) for _ in range(1 + 70_000 // 400))) for i in range(12)]
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(12)] + [(1000 + i, 1) for i in range(50)], "doc_id long, quality int")
    docs = docs_of([*rows, rows[0]])
    assert min(len(t) for _, t in rows) > 30_000
    assert len(quality.training_rows(docs, labels)) == 12
    assert len(quality.training_rows(docs, labels, rows=3)) == 6
    few = quality.training_rows(docs, labels, most_bytes=1)
    assert len(few) == 2 and {y for _, y in few} == {0, 1}
    monkeypatch.setattr(quality, "EPOCHS", 2)
    assert quality.train(docs, labels) is not None


def test_word_counts_beyond_32_bits():
    import pandas as pd

    big = 2 ** 32 - 5
    words = np.array([3, 9], np.uint64).tobytes()
    lists = pd.DataFrame({"block": range(4), "part": [0] * 4, "a": [words] * 4,
                          "b": [np.array([big, 1], np.uint32).tobytes()] * 4})
    got = lm._add_up(lists)
    assert np.frombuffer(got["counts"][0], np.int64).tolist() == [4 * big, 4] and got["n"].sum() == 4 * big + 4
