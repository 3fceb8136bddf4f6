"""Near duplicates, repeated bytes and repeated words against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from veleta.llm import frames, jaccard, substrings, suffixes
from veleta.llm.components import roots

EXTRA = "doc_id long, text string, id string, places int, n long"


def corpus(seed=1):
    """Copies, near copies, shared passages, runs of one letter, short, empty and null texts."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeéß") for _ in range(r.randint(1, 6)))
    base = [[word() for _ in range(r.randint(30, 160))] for _ in range(12)]
    shared = [word() for _ in range(40)]
    rows = []
    for k, b in enumerate(base):
        rows += [" ".join(b), " ".join(b)]
        for _ in range(4):
            c = list(b)
            for _ in range(r.randint(1, 5)):
                c[r.randrange(len(c))] = word()
            rows.append((" " if k % 2 else "\n").join(c))
        rows.append(" ".join(b[:20] + shared + b[20:]))
    rows += ["x" * 400, "y " * 300, "x" * 250, "one two", "one two", "one", "", None, "   ", "\t\n", "One Two",
             " ".join(word() for _ in range(4000)), "a b c d e", "a b c d e", "É a b c d", "é a b c d"]
    r.shuffle(rows)
    return [(k * 3 + 5, t, None, 1, 2) for k, t in enumerate(rows)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), EXTRA).repartition(3)


def test_jaccard_join(docs):
    sets = {}
    for d, t, *_ in corpus():
        w = (t or "").encode().lower().split()
        sets[d] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    got = {r[0]: (r[1], r[2]) for r in jaccard.join(docs).collect()}
    assert got == {d: (len(s), find(d)) for d, s in sets.items()}


def test_jaccard_links_through_a_chain(spark):
    """Neighbours link, the ends do not: only the last round finds pairs that share no leader."""
    words = [f"w{k}" for k in range(400)]
    rows = [(d, " ".join(words[d * 8:d * 8 + 90])) for d in range(30)]
    got = {r[2] for r in jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0}


def test_jaccard_links_behind_a_leader_of_another_size(spark):
    """The longer text leads every shingle of the two copies and is too long for both: no candidate, one link."""
    words = [f"w{k}" for k in range(104)]
    near = words[:94] + [f"v{k}" for k in range(10)]
    rows = [(1, " ".join(words + [f"u{k}" for k in range(50)])), (2, " ".join(words)), (3, " ".join(near))]
    got = {r[0]: (r[1], r[2]) for r in jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (150, 1), 2: (100, 2), 3: (100, 2)}


def brute_components(rows):
    """doc -> smallest id reachable, by comparing all pairs."""
    sets = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        sets[d] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    order = sorted(sets)
    for i, a in enumerate(order):
        for b in order[:i]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d)) for d in sets}


def star(copies, edits, centre, seed=4, words=120):
    """Copies of one text with some words replaced, and perhaps that text itself."""
    r = random.Random(seed)
    base = [f"w{k}" for k in range(words)]
    rows = [(0, " ".join(base))] if centre else []
    for d in range(1, copies + 1):
        c = list(base)
        for k in r.sample(range(words), edits):
            c[k] = f"x{d}.{k}"
        rows.append((d, " ".join(c)))
    return rows


@pytest.mark.parametrize("block,centre,edits", [(3, True, 3), (16, False, 3), (7, False, 2), (2048, True, 6)])
def test_jaccard_blocks_of_any_size(spark, monkeypatch, block, centre, edits):
    """A block in one task or cut into parts: the groups are those of all pairs."""
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", block)
    rows = star(40, edits, centre) + [(d + 100, t) for d, t in star(12, 2, True, 5, 60)] + [(d * 3 + 500, t) for d, t in star(9, 1, False, 6, 30)]
    got = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == brute_components(rows)


@pytest.mark.parametrize("centre", [True, False])
def test_jaccard_makes_no_row_for_a_pair(spark, monkeypatch, centre):
    """2,000 copies that hardly link to each other, and a line in a third of all texts: a step gives rows in proportion."""
    made = {}
    keep = jaccard.stored

    def counted(df, name):
        out = keep(df, name)
        made[name] = made.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(jaccard, "stored", counted)
    rows = star(2000, 3, centre, words=110)
    r = random.Random(9)
    line = " ".join(f"line{k}" for k in range(12))
    rows += [(d, line + " " + " ".join(f"v{r.randrange(400)}" for _ in range(30))) for d in range(3000, 4000)]
    got = {x[0]: x[2] for x in jaccard.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert made["links"] <= 4 * len(rows) and made["members"] <= len(rows) and made["probes"] <= len(rows)
    if centre:
        assert len({got[d] for d in range(2001)}) < 200


def test_spanning_links_agree_with_all_pairs():
    r = random.Random(3)
    for trial in range(60):
        m, words = r.randint(2, 25), r.choice([12, 40, 90])
        base = [r.sample(range(200), words) for _ in range(3)]
        cuts = []
        for _ in range(m):
            c = set(r.choice(base))
            c = (c - set(r.sample(sorted(c), r.randint(0, words // 6)))) | {r.randrange(10**6) for _ in range(r.randint(0, words // 6))}
            cuts.append(np.array(sorted(c), np.uint64))
        n, group = np.array([len(c) for c in cuts]), np.arange(m)
        side = np.array([r.randint(0, 1) for _ in range(m)]) if trial % 2 else np.zeros(m, int)
        two = len(set(side.tolist())) == 2
        links = jaccard.spanning_links(np.arange(m), n, group, side, cuts)
        alike = lambda i, j: (not two or side[i] != side[j]) and 100 * len(set(cuts[i]) & set(cuts[j])) >= 75 * len(set(cuts[i]) | set(cuts[j]))
        assert all(alike(i, j) for i, j in links) and len(links) < m
        root = list(range(m))
        for i, j in links:
            root = [root[i] if x == root[j] else x for x in root]
        assert all(root[i] == root[j] for i in range(m) for j in range(i) if alike(i, j))


def test_jaccard_one_id_with_different_texts(spark):
    """They are documents of their own, whatever their id."""
    a, b = " ".join(f"a{k}" for k in range(40)), " ".join(f"b{k}" for k in range(40))
    rows = [(5, a), (5, b), (3, a), (5, a), (9, b + " end"), (None, a)]
    got = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string"), keep_group=True).collect()
    assert sorted((r[0] or 0, r[1], r[2] or 0) for r in got) == [(0, 36, 0), (3, 36, 3), (5, 36, 3), (5, 36, 3), (5, 36, 5), (9, 37, 5)]
    assert len({r["grp"] for r in got if r["doc_id"]}) == 2


@pytest.mark.parametrize("per_document", [1, 8, 300])
def test_frames_do_not_grow_with_their_number(per_document):
    """Whatever the number of fragments, a value costs its own bytes and at most those of its place."""
    r = np.random.default_rng(1)
    ids = np.sort(r.choice(10**6, 400_000 // per_document, replace=False))
    counts = np.full(len(ids), per_document)
    values, entry = r.integers(0, 2**64, counts.sum(), dtype=np.uint64), np.arange(counts.sum())
    flags = r.random(len(entry)) < 0.1
    cost = {}
    for bits in (6, 10, 13):
        got = frames.pack(values, entry, flags, ids, counts, bits, False)
        size = sum(len(pa.compress(x, "lz4", asbytes=True)) for c in got.columns[1:] for x in (b"".join(c.to_pylist()),))
        cost[bits] = size / len(values)
        rests, some, owner, place, who = frames.unpack(list(zip(*(c.to_pylist() for c in got.columns[1:]))), False)
        assert len(rests) == len(values) and some.sum() == flags.sum()
        back = sorted(zip(who[owner].tolist(), place.tolist()))
        assert back == sorted((int(i), k) for i in ids for k in range(per_document))
    assert max(cost.values()) <= 4 + 1 / 8 + 8.5


def brute_bytes(rows, size):
    seen, out = set(), {}
    for d, t in sorted(rows):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - size + 1):
            if b[k:k + size] in seen:
                gone[k:k + size] = True
            seen.add(b[k:k + size])
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[d] = (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("size", [100, 37])
def test_suffix_dedup(docs, size):
    rows = suffixes.dedup(docs, size, keep_text=True, carry=("id", "places")).collect()
    assert {r.doc_id: tuple(r)[1:5] for r in rows} == brute_bytes([x[:2] for x in corpus()], size)
    assert {(r.id, r.places) for r in rows} == {(None, 1)}


def test_suffix_phrases_in_chunks(monkeypatch):
    text = " ".join(str(k * k) for k in range(3000)).encode()
    whole = suffixes.phrases(text, 100)
    monkeypatch.setattr(suffixes, "CHUNK", 700)
    for a, b in zip(whole, suffixes.phrases(text, 100)):
        assert (a == b).all()


def test_substring_dedup(docs):
    seen, want = set(), {}
    for d, t in sorted(x[:2] for x in corpus()):
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - 19):
            run = tuple(w[k:k + 20])
            if run in seen:
                gone[k:k + 20] = [True] * 20
            seen.add(run)
        want[d] = (len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest())
    assert {r[0]: tuple(r)[1:4] for r in substrings.dedup(docs).collect()} == want


@pytest.mark.parametrize("run", [jaccard.join, suffixes.dedup, substrings.dedup])
def test_empty_tables_null_and_repeated_ids(spark, run):
    assert run(spark.createDataFrame([], EXTRA)).count() == 0
    text = " ".join(f"w{k}" for k in range(60))
    rows = run(spark.createDataFrame([(1, text), (1, text), (None, text), (None, None), (2, text)],
                                     "doc_id long, text string")).collect()
    assert sorted(str(r[0]) for r in rows) == ["1", "1", "2", "None", "None"]
    one, two = (r for r in rows if r[0] == 1)
    assert one == two


def test_components(spark):
    links = [(a, a + 1) for a in range(1, 40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (200, 150)]
    got = dict(roots(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{k: 1 for k in range(2, 41)}, **{k: 100 for k in range(101, 130)}, 200: 150}


def test_coded_places():
    ids = np.array([5, 5, 5, 9, 9, 7])
    places = np.array([3, 700, 2_000_000_000, 0, 1, 128])
    rows = frames.coded(ids, places).to_pydict()
    assert {i: frames.decoded([p]).tolist() for i, p in zip(rows["id"], rows["places"])} == {
        5: [3, 700, 2_000_000_000], 7: [128], 9: [0, 1]}
    assert frames.decoded([rows["places"][0], rows["places"][1]]).tolist() == [3, 700, 2_000_000_000, 128]
