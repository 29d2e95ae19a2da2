"""Exact, near, line and byte-string dedup against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import bytesnp, components, exact_dedup, line_dedup, minhash, suffix_dedup, suffix_hash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts_with_copies(seed=1, n=60):
    rng = random.Random(seed)
    vocab = ["the", "of", "Ünï", "word", "a", "line", "x1", "É", "stone", "river", "lamp", "grey", "nine", "salt"]
    base = [" ".join(rng.choice(vocab) for _ in range(rng.choice([0, 1, 2, 5, 40, 120]))) for _ in range(n)]
    rows = list(enumerate(base))
    rows += [(n + i, rng.choice(base)) for i in range(30)]
    for i in range(30):  # near copies
        w = rng.choice(base).split(" ")
        w[rng.randrange(len(w))] = "changed"
        rows.append((n + 30 + i, " ".join(w)))
    rows += [(1000, None), (1001, ""), (1002, " \t\n"), (1003, None), (5, base[5]), (None, base[40]), (None, "lonely words here")]
    rows.append((1004, "y" * 70_000 + " end"))
    rows.append((1005, "y" * 70_000 + " end"))
    rows.append((1006, "y" * 70_000 + " enD"))
    return rows


def test_exact_dedup_equals_grouping(docs_of):
    rows = texts_with_copies()
    got = exact_dedup.exact_dedup(docs_of(rows), carry=("text",), first_digit=4).collect()
    assert len(got) == len(rows)
    groups = defaultdict(list)
    for k, t in rows:
        groups[t or ""].append(k)
    kept = Counter()
    for r in got:
        members = groups[r["text"] or ""]
        best = max((k for k in members if k is not None), default=None)
        assert (r["keep_id"], r["group_size"]) == (best, len(members))
        assert not r["kept"] or r["doc_id"] == best
        kept[r["text"] or ""] += r["kept"]
    assert all(kept[t] == 1 for t in groups)


def test_exact_dedup_empty_table(docs_of):
    assert exact_dedup.exact_dedup(docs_of([])).collect() == []


def near_brute(rows, k, percent):
    sets = []
    for _, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    usable = [i for i, (key, _) in enumerate(rows) if key is not None and sets[i]]
    for x, i in enumerate(usable):
        for j in usable[:x]:
            inter = len(sets[i] & sets[j])
            if 100 * inter >= percent * (len(sets[i]) + len(sets[j]) - inter):
                parent[root(i)] = root(j)
    best = {}
    for i in usable:
        best[root(i)] = min(best.get(root(i), rows[i][0]), rows[i][0])
    return [(rows[i][0], len(sets[i]), best[root(i)] if i in set(usable) else rows[i][0]) for i in range(len(rows))]


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_equal_brute_force(docs_of, k):
    rows = texts_with_copies(seed=k)
    got = minhash.near_duplicates(docs_of(rows), shingle=k, carry=("source",)).collect()
    want = near_brute(rows, k, 80)
    order = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=order) == sorted(want, key=order)
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"]) for r in got)


def test_near_duplicates_find_links_between_members_that_miss_the_head(docs_of, monkeypatch):
    """A chain: neighbours are alike, ends are not; small blocks, so that several units meet."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(200)]
    rows, now = [], words[:100]
    for i in range(40):
        rows.append((rng.randrange(10 ** 6), " ".join(now)))
        now = now[2:] + [words[(100 + 2 * i + j) % 200] for j in range(2)]
    got = minhash.near_duplicates(docs_of(rows)).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sorted(near_brute(rows, 2, 80))


def test_near_duplicates_empty_table(docs_of):
    assert minhash.near_duplicates(docs_of([])).collect() == []
    assert len(minhash.near_duplicates(docs_of([(1, None), (2, "")])).where("kept").collect()) == 2


def test_shingle_hashes_follow_words():
    texts = ["a b  c", "A\tb C\n", "", " ", "one", "é É"]
    h, at = bytesnp.shingles(pa.array([t.encode() for t in texts], pa.binary()), 2)
    assert np.diff(at).tolist() == [2, 2, 0, 0, 1, 1]
    assert h[:2].tolist() == h[2:4].tolist() and h[4] != h[5]


def test_components_of_a_long_path(spark):
    n = 300
    ids = list(range(n))
    random.Random(1).shuffle(ids)
    edges = [(ids[i], ids[i + 1]) for i in range(n - 1)] + [(1000, 1001), (1001, 1000), (7, 7), (2000, 2000)]
    got = dict(components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(n)}, 1000: 1000, 1001: 1000}


def test_line_dedup_equals_brute_force(docs_of):
    rng = random.Random(3)
    lines = ["a", "b", "", "c c", "dé"]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.choice([0, 1, 2, 3, 8, 30]))) + rng.choice(["", "\n"])) for i in range(60)]
    rows += [(100, None), (101, ""), (102, rows[30][1]), (102, rows[30][1])]
    seen, want = set(), []
    for k, t in sorted(rows, key=lambda r: r[0]):
        ls = line_dedup.split_lines((t or "").encode())
        gone = set()
        for i in range(len(ls) - 2):
            w = tuple(ls[i:i + 3])
            if w in seen:
                gone |= {i, i + 1, i + 2}
            seen.add(w)
        kept = [x for i, x in enumerate(ls) if i not in gone]
        text = b"\n".join(kept) + (b"\n" if kept and (t or "").endswith("\n") else b"") if gone else (t or "").encode()
        want.append((k, len(ls), len(gone), text.decode()))
    got = line_dedup.line_dedup(docs_of(rows)).collect()
    assert sorted((r["doc_id"], r["n_lines"], r["n_removed"], r["kept_text"]) for r in got) == sorted(want)
    assert line_dedup.line_dedup(docs_of([])).collect() == []


def repeats_brute(texts, length):
    bodies = [(t or "").encode() for t in texts]
    count = Counter(b[i:i + length] for b in bodies for i in range(len(b) - length + 1))
    out = []
    for b in bodies:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if count[b[i:i + length]] > 1:
                gone[i:i + length] = True
        edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        out.append((len(b), [tuple(x) for x in edge.reshape(-1, 2).tolist()], bytes(np.frombuffer(b, np.uint8)[~gone])))
    return out


@pytest.mark.parametrize("group, bits", [(1024, 64), (1, 64), (1, 2)])
def test_remove_repeats_equals_brute_force(docs_of, group, bits):
    """With 2 bits, most strings of the large groups share both hashes with unlike ones."""
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdé ") for _ in range(150))
    rows = []
    for i in range(80):
        own = "".join(rng.choice("abcde ") for _ in range(rng.choice([0, 10, 100, 400])))
        cut = rng.randrange(len(passage))
        rows.append((i, own + passage[cut:cut + rng.choice([20, 60, 150])] + own[::-1][:rng.choice([5, 50])]))
    rows += [(100, None), (101, ""), (102, "ab" * 300), (103, "q" * 500), (104, rows[3][1]), (104, rows[3][1]), (None, rows[4][1]),
             (105, "xyz" + "pqrst" * 20), (106, "k" * 40), (107, "k" * 41)]
    want = repeats_brute([r[1] for r in rows], 40)
    got = suffix_dedup.remove_repeats(docs_of(rows), length=40, group=group, bits=bits).collect()
    order = lambda r: (r[0] is None, r)
    have = [(r["doc_id"], r["n_bytes"], [(s["lo"], s["hi"]) for s in r["spans"]], bytes(r["kept"])) for r in got]
    assert sorted(have, key=order) == sorted(((k[0], *w) for k, w in zip(rows, want)), key=order)


def test_remove_repeats_empty_table(docs_of):
    assert suffix_dedup.remove_repeats(docs_of([])).collect() == []


def test_sort_suffixes_classes_are_equal_prefixes():
    rng = np.random.default_rng(2)
    raw = rng.integers(97, 99, 3000).astype(np.uint8)
    raw[1000:1400] = raw[:400]
    at = np.arange(0, 2900)
    group = (at >= 2000).astype(np.int64)
    got = suffix_dedup.sort_suffixes(raw, at, group, 30)
    by = defaultdict(list)
    for i in at:
        by[int(group[i]), raw[i:i + 30].tobytes()].append(i)
    for members in by.values():
        assert len({int(got[i]) for i in members}) == 1 and (got[members[0]] >= 0) == (len(members) > 1)


def test_a_hash_collision_is_found_by_its_bytes():
    raw = np.frombuffer(b"abcdefgh" * 2 + b"abcdefgX" + bytes(8), np.uint8)
    got = suffix_dedup._verified(suffix_dedup.eight_bytes(raw), np.array([0, 8, 16]), np.array([4, 4, 4]), 8)
    assert got[0] == got[1] >= 0 and got[2] == -1


def test_segments_cover_every_window():
    rng = np.random.default_rng(1)
    sizes = [0, 199, 200, 201, 1000, 5]
    raw = rng.integers(0, 256, sum(sizes)).astype(np.uint8)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    text, start, windows, *_ = suffix_hash.segments(raw, offsets, 200)
    seen = Counter((int(t), int(s) + i) for t, s, n in zip(text, start, windows) for i in range(int(n)))
    assert seen == Counter((t, i) for t, n in enumerate(sizes) for i in range(n - 199))


def test_carried_columns_of_clashing_names(docs_of):
    docs = docs_of([(1, "a"), (2, "a"), (3, None)])
    got = exact_dedup.exact_dedup(docs, carry=("id", "rid", "source")).select("doc_id", "id", "rid", "kept").collect()
    assert sorted((r["doc_id"], r["id"], r["rid"], r["kept"]) for r in got) == [(1, "x", "x", False), (2, "x", "x", True), (3, "x", "x", True)]


@pytest.mark.parametrize("percent", [50, 30])
def test_bands_follow_the_threshold(docs_of, percent):
    rng = random.Random(percent)
    rows = []
    for i in range(60):
        base = [f"w{rng.randrange(400)}" for _ in range(40)]
        keep = rng.randint(12, 36)
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(base[:keep] + [f"v{rng.randrange(400)}" for _ in range(40 - keep)]))]
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs_of(rows), shingle=1, percent=percent).collect()}
    assert got == {k: c for k, _, c in near_brute(rows, 1, percent)}


def test_thresholds_that_minima_cannot_find_are_refused():
    assert [minhash.rows_per_band(p) for p in (80, 50, 30)] == [4, 2, 1]
    with pytest.raises(ValueError):
        minhash.rows_per_band(5)


def test_units_are_cut_by_shingles_too(docs_of, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 30)
    rng = random.Random(8)
    words = [f"w{i}" for i in range(12)]
    rows = [(i, " ".join(w for w in words if rng.random() < .85)) for i in range(70)]
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs_of(rows)).collect()}
    assert got == {k: c for k, _, c in near_brute(rows, 2, 80)}
