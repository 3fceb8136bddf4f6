"""Language-model scoring, importance resampling and vector codes against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from veleta.llm import attention, resample, vectorcodes

public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
EXTRA = "doc_id long, text string, id string, score double, n long, word string"


def sentences(n, seed=3):
    """Texts of a small grammar, so that the next word depends on the one before."""
    r = random.Random(seed)
    follow = {w: [r.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) for _ in range(3)]
              for w in "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()}
    rows = []
    for k in range(n):
        w, text = "alpha", []
        for _ in range(r.randint(1, 90)):
            text.append(w.upper() if r.random() < 0.05 else w)
            w = r.choice(follow[w])
        rows.append((k, " ".join(text), "x", 0.5, 1, "y"))
    return rows


ODD_TEXTS = [(900, None), (901, ""), (902, " \t\n"), (903, "unseen-Wörter only"), (904, "alpha\x0bbeta"), (None, "alpha beta"),
             (None, None), (905, "alpha beta"), (905, "alpha beta"), (906, "a b Ünïcode É é"), (907, "alpha beta " * 3000)]
ODD = [(i, t, None, None, None, None) for i, t in ODD_TEXTS]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(sentences(300) + ODD, EXTRA).repartition(3)


@pytest.fixture(scope="module")
def fitted(docs):
    return attention.fit(docs, TOKENIZER)


def held_out(doc):
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % 7 == 2


def test_word_scores(docs, fitted):
    words = lambda t: [w for w in (t or "").encode().lower().split()]
    rows = [(r[0], r[1]) for r in sentences(300) + ODD]
    count = Counter(w for i, t in rows if not held_out(i) for w in words(t))
    texts = sum(not held_out(i) for i, _ in rows)
    n, v = sum(count.values()) + texts, len(count) + 1
    want = Counter()
    for i, t in rows:
        base = math.log10((texts + 1) / (n + v + 1)) + sum(math.log10((count[w] + 1) / (n + v + 1)) for w in words(t))
        want[(i, held_out(i), len(words(t)) + 1, 1 + sum(count[w] > 0 for w in words(t)), n, round(base, 6))] += 1
    got = attention.score(docs, fitted)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    assert Counter((*r[:5], round(r[5], 6)) for r in got.collect()) == want


def test_rare_words_are_joined(docs, fitted, monkeypatch):
    """The same sums when only very frequent words are sent to the tasks."""
    whole = Counter((r[0], r[3], round(r[5], 6)) for r in attention.score(docs, fitted).collect())
    monkeypatch.setattr(attention, "HEAVY", 4)
    assert Counter((r[0], r[3], round(r[5], 6)) for r in attention.score(docs, fitted).collect()) == whole


def slow_log10(model, tokens):
    """One id at a time, its window cut out by hand."""
    p, s, d = model.parameters, attention.STRIDE, attention.WIDTH
    inputs, total = [model.end, *tokens[:-1]], 0.0
    for t, want in enumerate(tokens):
        begin = max(0, (t // s - 1) * s)
        x = p["emb"][model.row_of[inputs[begin:t + 1]]].astype(float)
        a = (x[-1] @ p["query"]) @ (x @ p["key"]).T / math.sqrt(d) + p["near"][t - np.arange(begin, t + 1)]
        a = np.exp(a - a.max())
        mixed = (a / a.sum()) @ (x @ p["value"])
        h = np.maximum(mixed @ p["out"] + x[-1] @ p["skip"] + p["bias"], 0)
        g, c = divmod(int(model.class_of[want]), attention.CLASSES)
        for z, k in ((h @ p["last"] + p["prior"], g), (h @ p["deep"][g] + p["deep_prior"][g], c)):
            total += z[k] - z.max() - math.log(np.exp(z - z.max()).sum())
        total += model.inside[want]
    return total / math.log(10)


def test_model_scores(docs, fitted):
    """Batched windows give what a window per id gives, whatever the text."""
    model, got = fitted.model, attention.score(docs, fitted).collect()
    ids = attention.WordIds(TOKENIZER)
    texts = {r[0]: r[1] for r in sentences(300) + ODD}
    for r in got:
        if r["doc_id"] in (0, 1, 2, 3, 4, 5, 6, 7, 900, 901, 902, 903, 904, 906):
            raw = ids.texts([(texts[r["doc_id"]] or "").encode().lower().split()], np.uint32(model.end).tobytes())[0]
            assert abs(slow_log10(model, np.frombuffer(raw, np.uint32).tolist()) - r["score"]) < 1e-3
    pairs = [r["score"] for r in got if r["doc_id"] == 905]
    assert len(pairs) == 2 and abs(pairs[0] - pairs[1]) < 1e-6
    assert all(math.isfinite(r["score"]) for r in got)


def test_probabilities_sum_to_one(fitted):
    model = fitted.model
    p, row = model.parameters, model.row_of[np.full((2, attention.STRIDE), model.end)]
    h = model.hidden(row, np.array([True]))[3]
    share = lambda z: np.exp(z - z.max()) / np.exp(z - z.max()).sum()
    classes = np.concatenate([share(h @ p["last"] + p["prior"])[g] * share(h @ p["deep"][g] + p["deep_prior"][g]) for g in range(attention.GROUPS)])
    assert abs(float((classes[model.class_of] * np.exp(model.inside)).sum()) - 1) < 1e-5


def test_words_encoded_together_give_their_own_ids():
    words = [w.encode() for w in ["alpha", "don't", "'s", "x\u00a0y", "\u00a0", "\u2003\u2003", "123abc", "émile", "--", "a" * 300, "<|endoftext|>", "\u200b"]]
    ids = attention.WordIds(TOKENIZER)
    ids.learn(words)
    for w in words:
        assert np.frombuffer(ids[w], np.uint32).tolist() == ids.encode(" " + w.decode())


def test_training_helps_on_held_out_texts(docs, fitted):
    """Context tells the next word of the grammar: better than the shares of the classes, the more so the
    more of the texts are learnt from."""
    counts = attention.subword_counts(fitted.words, TOKENIZER, len(fitted.model.inside))
    counts[fitted.model.end] += fitted.texts
    start = attention.start_model(counts, fitted.model.end, TOKENIZER, [b""] * len(counts))
    total = lambda f: sum(r["score"] for r in attention.score(docs, f).collect() if r["held_out"])
    untrained = total(attention.Fitted(start, fitted.words, fitted.texts, fitted.tokens, fitted.distinct))
    assert total(fitted) > 0.99 * untrained
    assert total(attention.fit(docs, TOKENIZER, share=1)) > 0.85 * untrained


def test_gradients():
    r = np.random.default_rng(1)
    rows, classes = 30, attention.GROUPS * attention.CLASSES
    flat = r.normal(0, 0.3, sum(int(np.prod(s)) for s in attention.shapes(rows).values())).astype(np.float64)
    p = attention.views(flat, rows)
    s = attention.STRIDE
    now, before = r.integers(0, rows, (3, s)), r.integers(0, rows, (3, s))
    want, real, first = r.integers(0, classes, (3, s)), r.random((3, s)) < 0.8, np.array([True, False, False])
    _, g = attention.gradients(p, now, before, first, want, real)
    whole = np.concatenate([g[n].ravel() for n in attention.shapes(rows)])
    for k in r.integers(0, len(flat), 60):
        keep = flat[k]
        flat[k] = keep + 1e-4
        up = attention.gradients(p, now, before, first, want, real)[0]
        flat[k] = keep - 1e-4
        down = attention.gradients(p, now, before, first, want, real)[0]
        flat[k] = keep
        assert abs((up - down) / 2e-4 - whole[k]) < 1e-3


def test_scores_of_empty_tables(spark):
    none = spark.createDataFrame([], EXTRA)
    fitted = attention.fit(none, TOKENIZER)
    assert fitted.tokens == 0 and attention.score(none, fitted).count() == 0
    only = [d for d in range(100) if held_out(d)][0]
    one = spark.createDataFrame([(only, "alpha", None, None, None, None)], EXTRA)
    row = attention.score(one, attention.fit(one, TOKENIZER)).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"]) == (2, 0, 0, 0.0)


# -- resampling ---------------------------------------------------------------------------------------------

def folded(text):
    raw = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    return "".join(chr(c) if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else " " for c in raw).encode("latin-1").split()


@pytest.mark.parametrize("least,most", [(1, 1), (1, 3), (2, 2)])
def test_checksums_of_all_runs(least, most):
    texts = [t for _, t in ODD_TEXTS] + [r[1] for r in sentences(20)] + ["x" * 500 + " " + "yz " * 90 + "é" * 5000]
    raw = [(t or "").encode() for t in texts]
    words, found = resample._checksums(raw, least, most)
    assert words.tolist() == [len(folded(t)) for t in texts]
    got = Counter((int(o), int(c)) for crc, owner in found for c, o in zip(crc, owner))
    want = Counter((k, zlib.crc32(b" ".join(w[i:i + n]))) for k, w in enumerate(map(folded, texts))
                   for n in range(least, most + 1) for i in range(len(w) - n + 1))
    assert got == want


@pytest.mark.parametrize("least,most", [(1, 1), (1, 2)])
def test_resample(spark, docs, least, most):
    rows = [(r[0], r[1]) for r in sentences(300) + ODD]
    aims = ["alpha beta beta", None, "", "Gamma! delta"]
    target = spark.createDataFrame([(t, 1) for t in aims], "text string, doc_id int")
    runs = lambda t: [zlib.crc32(b" ".join(w[i:i + n])) % 10000 for w in [folded(t)]
                      for n in range(least, most + 1) for i in range(len(w) - n + 1)]
    s, t = Counter(b for _, x in rows for b in runs(x)), Counter(b for x in aims for b in runs(x))
    ns, nt = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (ns + 10000) / ((s[b] + 1) * (nt + 10000))))
    out = []
    for i, x in rows:
        f = runs(x)
        weight = math.floor(sum(map(gain, f)) / len(f)) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(folded(x))])
    able = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = Counter((*r[:4], k + 1) for k, r in enumerate(able[:len(able) * 10 // 100]))
    got = Counter(tuple(r) for r in resample.resample(docs, target, least, most).collect())
    assert len(drawn) > 5 and not drawn - got
    assert Counter(k[:4] for k in got.elements()) == Counter(tuple(r[:4]) for r in out)
    assert sum(k[4] is not None for k in got.elements()) == sum(drawn.values())


def test_resample_of_nothing(spark):
    none = spark.createDataFrame([], EXTRA)
    assert resample.resample(none, none).count() == 0
    few = spark.createDataFrame([(1, None, None, None, None, None), (2, "a b", None, None, None, None)], EXTRA)
    assert sorted(tuple(r)[:3] for r in resample.resample(few, none).collect())[0][:3] == (1, 0, 0)


# -- vector codes --------------------------------------------------------------------------------------------

def plain_codes(rows, parts, entries, rounds):
    """Every part against every entry, by the contract."""
    keep = [(i, v, lab) for i, v, lab in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    ints = [[math.floor(4096 * c) for c in v] for _, v, _ in keep]
    width = len(ints[0]) // parts
    order = sorted(range(len(keep)), key=lambda k: keep[k][0])[:entries]
    books = [[ints[k][p * width:(p + 1) * width] for k in order] for p in range(parts)]
    cut = lambda x, p: x[p * width:(p + 1) * width]

    def nearest(x, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(x, p), e)), k) for k, e in enumerate(books[p]))

    for step in range(rounds + 1):
        got = [[nearest(x, p) for p in range(parts)] for x in ints]
        if step < rounds:
            for p in range(parts):
                for k in range(len(books[p])):
                    own = [cut(x, p) for x, g in zip(ints, got) if g[p][1] == k]
                    if own:
                        books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    errors = [sum(g[0] for g in r) for r in got]
    label = Counter()
    for (_, _, lab), e in zip(keep, errors):
        label[lab] += e
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted((i, "".join(f"{g[1]:02x}" for g in r), e, label[lab], sha) for (i, _, lab), r, e in zip(keep, got, errors))


VECTORS = "vec_id long, embedding array<float>, label int, code string, error long, x int"


@pytest.mark.parametrize("spread", [1.0, 0.0005])
def test_codes(spark, spread):
    """Clusters, repeated vectors and, with the small spread, many equal distances."""
    r = random.Random(5)
    centres = [[r.gauss(0, spread) for _ in range(16)] for _ in range(6)]
    rows = [(k, [float(np.float32(c + r.gauss(0, spread / 3))) for c in r.choice(centres)], r.choice([None, 1, 2, 3])) for k in range(400)]
    rows[7] = (7, rows[3][1], 1)
    rows[9] = (9, rows[3][1], None)
    r.shuffle(rows)
    bad = [(500, None, 1), (501, [], 1), (502, [1.0, None] * 8, 2), (503, [float("nan")] * 16, 2), (504, [float("inf")] + [0.0] * 15, None)]
    df = spark.createDataFrame([(*x, "c", 1, 1) for x in rows + bad], VECTORS).repartition(3)
    got = vectorcodes.encode(df, parts=4, entries=8, rounds=4)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.collect())) == plain_codes(rows + bad, 4, 8, 4)


def test_reassign_skips_and_agrees():
    r = np.random.default_rng(2)
    x = r.integers(-9, 9, (500, 3))
    book = r.integers(-9, 9, (12, 3))
    code = np.zeros(500, np.int64)
    moved = None
    for _ in range(4):
        d = ((x[:, None, :] - book[None]) ** 2).sum(2)
        near = vectorcodes.reassign(x, code, book, moved)
        assert (code == d.argmin(1)).all() and (near == d.min(1)).all()
        new = book.copy()
        new[r.integers(0, 12, 3)] += r.integers(-2, 3, (3, 3))
        moved, book = (new != book).any(1), new


def test_odd_vectors(spark):
    none = spark.createDataFrame([], VECTORS)
    assert vectorcodes.encode(none).count() == 0
    rows = [(1, [0.5] * 10, 1), (1, [0.25] * 10, 1), (None, [0.5] * 10, None), (2, [0.5] * 3, 1), (3, [0.5] * 10, None)]
    got = vectorcodes.encode(spark.createDataFrame([(*x, "c", 1, 1) for x in rows], VECTORS), parts=4, entries=16).collect()
    assert sorted((r[0] or 0, r["error"]) for r in got) == [(0, 0), (1, 0), (1, 0), (3, 0)]
    with pytest.raises(Exception, match="components must be below"):
        vectorcodes.encode(spark.createDataFrame([(1, [0.0] * 8, 1, "c", 1, 1), (2, [1e9] * 8, 1, "c", 1, 1)], VECTORS)).collect()


def test_every_place_of_every_training_text_is_learnt_from(docs, fitted, monkeypatch):
    counts = attention.subword_counts(fitted.words, TOKENIZER, len(fitted.model.inside))
    seen, averaged = [], attention._averaged

    def noted(rows, size):
        seen.append(rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
        return averaged(rows, size)

    monkeypatch.setattr(attention, "_averaged", noted)
    attention.fit(docs, TOKENIZER)
    assert sum(seen) == int(counts.sum()) + fitted.texts and min(seen) > 0


def test_gradients_of_a_run_of_chunks():
    """Chunks that follow each other give what each gives with a copy of the one before it."""
    r = np.random.default_rng(2)
    rows, classes, s = 30, attention.GROUPS * attention.CLASSES, attention.STRIDE
    flat = r.normal(0, 0.3, sum(int(np.prod(x)) for x in attention.shapes(rows).values()))
    p, run = attention.views(flat, rows), r.integers(0, rows, (7, s))
    want, real, first = r.integers(0, classes, (6, s)), r.random((6, s)) < 0.8, np.array([True, False, False, True, False, False])
    loss, g = attention.gradients(p, run[1:], run[:-1], first, want, real)
    again, h = attention.run_gradients(p, run, first, want, real, np.full(len(flat), np.nan))
    assert abs(loss - again) < 1e-9 and all(np.abs(g[n] - h[n]).max() < 1e-9 for n in attention.shapes(rows))


def test_texts_are_cut_into_ids_once(docs, fitted, monkeypatch):
    """The ids that the model was trained on are stored, and the same table is scored from them."""
    ids, close = attention.WordIds(TOKENIZER), np.uint32(fitted.model.end).tobytes()
    stored = fitted.coded.collect()
    for r in stored:
        raw = ids.texts([(r["text"] or "").encode().lower().split()], close)[0]
        assert np.frombuffer(r["ids"], np.uint16).tolist() == np.frombuffer(raw, np.uint32).tolist()
    counts = attention.subword_counts(fitted.words, TOKENIZER, len(fitted.model.inside))
    counts[fitted.model.end] += fitted.texts
    assert (attention.id_counts(fitted.coded, len(counts), fitted.model.end) == counts).all()
    other = sorted(map(str, attention.score(docs.select("*"), fitted).drop("score").collect()))

    def again(*_):
        raise AssertionError("cut again")

    monkeypatch.setattr(attention, "coded", again)
    assert sorted(map(str, attention.score(docs, fitted).drop("score").collect())) == other and len(stored) == len(other)


def test_long_texts_are_learnt_from_whole(spark, monkeypatch):
    """Pieces of a batch that are far smaller than a text, and steps that cross them, still take every place once."""
    rows = spark.createDataFrame([(k, "alpha beta gamma " * 400 * (1 + k % 2), None, None, None, None) for k in range(6)], EXTRA).coalesce(1)
    monkeypatch.setattr(attention, "SLICE", 1000)
    seen, averaged = [], attention._averaged

    def noted(found, size):
        seen.append(found.agg(F.sum("n")).first()[0] or 0)
        return averaged(found, size)

    monkeypatch.setattr(attention, "_averaged", noted)
    fitted = attention.fit(rows, TOKENIZER)
    counts = attention.subword_counts(fitted.words, TOKENIZER, len(fitted.model.inside))
    assert sum(seen) == int(counts.sum()) + fitted.texts
