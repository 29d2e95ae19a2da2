"""Fill-in-middle, byte-level BPE and tokenizer alignment against brute force."""

import hashlib
import random
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import align, byte_bpe, fim, perfect_hash, subwords

ODD = ["naïve café 日本語のテキスト。かな", "🙂👩‍👩‍👧 é́", "a <P> mark", "line\n\n two\r\n\tend ", "  lead", "\x00\x1c nul", "x" * 700,
       "I'LL can't 's <|endoftext|> <s> <0x0A>", "　wide   space ", "tail   ", "\n", " ", "half <", "P> S> <M"]


def rows_of(n=120):
    rng = random.Random(4)
    rows = [(i, "".join(rng.choice(ODD[:2] + ODD[3:]) for _ in range(rng.choice([1, 1, 2, 9])))) for i in range(n)]
    return rows + [(500, None), (501, ""), (None, "null key"), (7, rows[7][1]), (502, ODD[2]), (503, "<S>"), (504, "long é " * 40_000),
                   (-1, "negative")]


# fill-in-middle ------------------------------------------------------------------------------------

def fim_plain(key, text):
    h = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in range(0, 32, 8))
    n = len(text)
    if not n or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", a, b - a, f"<P>{pre}<S>{suf}<M>{mid}"


@pytest.mark.parametrize("part", [5000, 1 << 18])
def test_fill_in_middle(docs_of, monkeypatch, part):
    monkeypatch.setattr(fim, "PART", part)
    rows = rows_of()
    docs = docs_of(rows)
    made = fim.fill_in_middle(docs)
    got = fim.restore(made.withColumn("output2", F.col("output"))).collect()
    want = sorted(((k, *fim_plain(k, t or ""), t or "") for k, t in rows), key=repr)
    have = [(r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output2"], r["restored"]) for r in got]
    assert sorted(have, key=repr) == want
    assert {w[2] for w in want} == {"plain", "psm", "spm"}


def test_fill_in_middle_in_tiny_parts(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(fim, "PART", 3)
    texts = ["", "aé日🙂b", "abc", "x" * 10]
    for a, b in [(0, 0), (1, 4), (3, 3), (2, 9)]:
        n = np.array([len(t) for t in texts])
        one, two = np.minimum(n, a), np.minimum(n, b)
        got = [x.to_pylist() for x in fim._cut(pa.array(texts), n, one, two)]
        assert got == [[t[:a] for t in texts], [t[a:b] for t in texts], [t[b:] for t in texts]]


def test_fill_in_middle_edges(docs_of):
    assert fim.restore(fim.fill_in_middle(docs_of([]))).collect() == []
    got = fim.fill_in_middle(docs_of([(i, "abcd") for i in range(50)]), percent=0).collect()
    assert {r["form"] for r in got} == {"plain"}
    got = fim.fill_in_middle(docs_of([(i, "abcd") for i in range(50)]), percent=100, spm_percent=100).collect()
    assert {r["form"] for r in got} == {"spm"}


def test_restore_of_odd_rows(spark):
    made = spark.createDataFrame([(1, None, "psm"), (2, "<P>a<S>b<M>c", "psm"), (3, "x", None), (4, "<S>b<P><M>", "spm")],
                                 "none int, output string, form string")
    assert sorted((r["none"], r["restored"]) for r in fim.restore(made).collect()) == [(1, None), (2, "acb"), (3, "x"), (4, "b")]


# byte-level BPE --------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def whole():
    import tiktoken

    with open(byte_bpe.default_path(), "rb") as f:
        ranks = byte_bpe.parse_ranks(f.read())
    return tiktoken.Encoding("whole", pat_str=byte_bpe.default_pattern(), mergeable_ranks=ranks, special_tokens={})


def test_ids_and_bytes(docs_of, whole):
    rows = rows_of()
    got = byte_bpe.decode(byte_bpe.encode(docs_of(rows)).withColumn("own", F.col("ids"))).collect()
    want = sorted(((k, whole.encode_ordinary(t or ""), (t or "").encode()) for k, t in rows), key=repr)
    assert sorted(((r["doc_id"], list(r["own"]), bytes(r["decoded"])) for r in got), key=repr) == want
    assert all(r["n_tokens"] == len(r["own"]) for r in got)
    assert byte_bpe.decode(byte_bpe.encode(docs_of([]))).collect() == []


def test_cut_texts_keep_their_ids(whole, monkeypatch):
    monkeypatch.setattr(byte_bpe, "PART", 11)
    monkeypatch.setattr(byte_bpe, "LONG_RUN", 4)
    bpe = byte_bpe.ByteBpe(whole._mergeable_ranks, byte_bpe.default_pattern())
    rng = random.Random(9)
    pieces = [*ODD, " ", "  ", "     ", "\n", "\t\t\t\t\t\t", "word", "123", "!?", "語", "é", "'ll", "  "]
    for _ in range(1500):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))
        assert "".join(byte_bpe.safe_parts(text, 11)) == text
        assert bpe.encode(text).tolist() == whole.encode_ordinary(text)


def test_white_space_too_long_for_the_engine(whole):
    bpe = byte_bpe.ByteBpe(whole._mergeable_ranks, byte_bpe.default_pattern())
    text = "a" + " " * 1_200_000 + "b" + "\n" * 1_100_000
    ids = bpe.encode(text)
    assert bpe.decode(ids) == text.encode()
    short = whole.encode_ordinary("a" + " " * 50_000 + "b" + "\n" * 50_000)
    assert ids[0] == short[0] and ids[-1] == short[-1] and set(ids.tolist()) == set(short)


def test_cut_off_ids_give_raw_bytes(spark, whole):
    ids = whole.encode_ordinary("🙂 語")[:-1]
    got = byte_bpe.decode(spark.createDataFrame([(1, ids), (2, []), (3, None)], "k int, ids array<int>")).collect()
    assert [None if r["decoded"] is None else bytes(r["decoded"]) for r in got] == [whole.decode_bytes(ids), b"", None]


# tokenizer alignment ---------------------------------------------------------------------------------

def align_plain(rows):
    """Links of all pairs of tokens by their byte ranges, by the two libraries on whole texts."""
    import sentencepiece
    from tokenizers import Tokenizer

    path_a, path_b = align.default_paths()
    a_of, b_of = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
    a_of.encode_special_tokens = True
    letters = {c: b for b, c in subwords._byte_letters().items()}

    def spans(parts):
        at, out = 0, []
        for p in parts:
            out.append((at, at + len(p)))
            at += len(p)
        return out

    docs, count = [], Counter()
    for k, t in rows:
        a, b, links, said = [], [], [], ""
        if t:
            body = (" " + t).encode()
            a = a_of.encode(" " + t, add_special_tokens=False).ids
            b = b_of.encode(t)
            bytes_a = [bytes(letters[c] for c in a_of.id_to_token(i)) for i in a]
            bytes_b = [bytes([int(b_of.id_to_piece(i)[3:5], 16)]) if b_of.is_byte(i)
                       else b_of.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if b"".join(bytes_a) != body or b"".join(bytes_b) != body:
                a, b = [], []
            else:
                sa, sb = spans(bytes_a), spans(bytes_b)
                for (x, y), i in zip(sa, a):
                    links += [(i, j) for (u, v), j in zip(sb, b) if u < y and x < v]
                ends = sorted({y for _, y in sa} & {v for _, v in sb})
                groups, low = [], 0
                for e in ends:
                    groups.append(",".join(str(i) for (x, y), i in zip(sa, a) if low <= x and y <= e) + "|"
                                  + ",".join(str(j) for (u, v), j in zip(sb, b) if low <= u and v <= e))
                    low = e
                said = ";".join(groups)
        count.update(links)
        docs.append((k, len(a), len(b), said, links))
    top = {}
    for (_, j), n in count.items():
        top[j] = max(top.get(j, 0), n)
    return [(k, na, nb, len(said.split(";")) if said else 0, len(links), sum(count[x] == top[x[1]] for x in links),
             sum(count[x] for x in links), said) for k, na, nb, said, links in docs]


@pytest.mark.parametrize("small", [False, True])
def test_alignment_equals_brute_force(docs_of, monkeypatch, small):
    if small:  # several parts, rounds, caches, units and levels of the tree
        for name, n in (("PART_KEYS", 40), ("ROUND_KEYS", 300), ("CACHE_WORDS", 30), ("UNIT", 20), ("FAN_IN", 2),
                        ("LIST_PAIRS", 16), ("JOINED", 30), ("LONG_WORD", 9)):
            monkeypatch.setattr(align, name, n)
    rng = random.Random(3)
    words = ["stone", "River's", "naïve", "12,5", "x;\ry", "a▁b", "日本語。", "🙂", "end.", "<s>", "<0x0A>", "I'LL", " ", "\xa0", "\tq"]
    rows = [(i, rng.choice([" ", " ", "\n"]).join(rng.choice(words[:-1] if i % 3 else words[:5]) for _ in range(rng.choice([1, 6, 20]))))
            for i in range(60)]
    rows += [(100 + i, t) for i, t in enumerate(ODD)] + [(200, None), (201, ""), (None, "null key"), (7, rows[7][1]),
                                                         (300, "x" * 400), (301, "tail \n"), (302, "\nlead"), (303, " "), (304, "a  b")]
    got = sorted((tuple(r) for r in align.align(docs_of(rows, parts=5)).collect()), key=repr)
    want = sorted(align_plain(rows), key=repr)
    assert got == want
    assert sum(r[1] == 0 for r in want) > 2


def test_words_met_more_than_once_stay_when_the_word_cache_is_full(monkeypatch):
    files = tuple(open(p, "rb").read() for p in align.default_paths())
    learn, learnt = align.Aligner.learn, []
    monkeypatch.setattr(align.Aligner, "learn", lambda self, words: (learnt.extend(words), learn(self, words))[1])
    texts = [["stone lamp naïve stone lamp naïve " + " ".join(f"w{i}x{j}" for j in range(30)), "", "tail ", "x" * 300]
             for i in range(6)]

    def counted(most):
        monkeypatch.setattr(align, "CACHE_WORDS", most)
        align._LOADED.clear()
        learnt.clear()
        batches = [pa.RecordBatch.from_arrays([pa.array([t.encode() for t in some], pa.binary())], names=["body"]) for some in texts]
        total = Counter()
        for batch in align._count(f"trim-{most}", SimpleNamespace(value=files))(iter(batches)):
            for keys, counts in zip(batch["keys"], batch["counts"]):
                total.update(dict(zip(*(np.frombuffer(x.as_py(), "<i8").tolist() for x in (keys, counts)))))
        return total, Counter(learnt)

    (whole, _), (cut, words) = counted(10_000), counted(50)
    assert cut == whole and sum(whole.values()) > 500
    assert words["stone"] == words["naïve"] == 1 and words["w0x0"] == 1
    # what words met once leave behind is the same as before
    aligner = align.Aligner(*files, texts=True)
    first = aligner.texts_of(texts[0])
    said = [[aligner.groups[i] for i in units[0][0]] for units in first[:1]]
    aligner.trim()
    again = aligner.texts_of(texts[0])
    assert [[aligner.groups[i] for i in units[0][0]] for units in again[:1]] == said


def test_alignment_of_an_empty_table(docs_of):
    assert align.align(docs_of([])).collect() == []
    assert [tuple(r)[1:] for r in align.align(docs_of([(1, None), (2, "")])).collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2


def test_perfect_hash():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 31, 20_000))
    parts = 7
    built = [perfect_hash.build(keys[perfect_hash.part_of(keys, parts) == p]) for p in range(parts)]
    assert perfect_hash.build(np.empty(0, np.int64))[2].tolist() == []
    for first, last in ((0, 7), (2, 5)):
        some = built[first:last]
        table = perfect_hash.PerfectHash(parts, first, [s for s, _, _ in some], [b.tobytes() for _, b, _ in some])
        mine = keys[table.mine(keys)]
        slots = table.slots(mine)
        assert sorted(slots.tolist()) == list(range(len(mine)))
        assert (np.concatenate([k for _, _, k in some])[slots] == mine).all()
    with pytest.raises(ValueError):
        perfect_hash.build(np.array([5, 5]))
