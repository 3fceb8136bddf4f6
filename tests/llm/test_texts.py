"""Extraction, quality, decontamination, licenses and fingerprints on small fixtures."""

import hashlib
import random
import zlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from veleta.llm import decontaminate, extract, fingerprint, licenses, ordinal
from veleta.llm.htmlblocks import blocks


# -- op1

@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.01/pages.parquet")


@pytest.fixture(scope="module")
def labeller(pages):
    return extract.fit(pages)


def test_blocks_of_broken_markup():
    page = ("<html><head><title>T</title><style>p{}</style></head><body><p>a <b>b</b>c&amp;&eacute;&#33;<br>d\n\t e"
            "<script>var x='<p>no</p>';</script><ul><li>one<li>two</ul><!-- <p>gone</p> --><p title='a>b'>1 < 2 <a href=x>l</a><p>cut <im")
    assert [b.text for b in blocks(page)] == ["a bc&é!", "d e", "one", "two", "1 < 2 l", "cut"]
    assert blocks(None) == blocks("") == blocks("<div></div>") == []
    assert [b.tag for b in blocks("<nav><ul><li>x</li></ul></nav><p>y")] == ["li", "p"]


def test_labeller_reads_unseen_layouts(labeller):
    r = random.Random(5)
    texts = ["Words of an article go on and on, then stop.", "A second paragraph follows. It says more.", "Short one."] * 3
    right = total = 0
    for _ in range(60):
        page, labels = extract.rearranged(r, r.sample(texts, 6), texts)
        found = labeller.label([page])[0]
        right, total = right + int((found == np.array(labels, bool)).sum()), total + len(labels)
    assert right / total > 0.95


def test_extract(spark, pages, labeller):
    rows = [(1, "u", "<html><body><nav><a href='/'>Home</a></nav><article><h1>Title</h1><p>Some   text\nhere.</p>"
             "<aside>Related</aside><p>More &lt;text&gt;.</p></article><footer>&copy; Me</footer></body></html>", 1),
            (1, "u", None, 2), (None, None, "", 3), (3, "v", "<div>", 4)]
    got = extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text int"), labeller).collect()
    assert [(r.page_id, r.url) for r in got] == [(1, "u"), (1, "u"), (None, None), (3, "v")]
    assert got[0].text == "Title Some text here. More <text>." and got[0].n_chars == 34
    assert [(r.text, r.n_chars) for r in got[1:]] == [("", 0)] * 3
    assert extract.extract(pages.limit(0), labeller).count() == 0


def test_extract_keeps_whole_articles(pages, labeller):
    """Against the articles that the markup names, outside the training sample too."""
    for r in extract.extract(pages, labeller).join(pages.select("page_id", "html"), "page_id").collect():
        known = " ".join(b.text for b in blocks(r.html) if extract.known_label(b) == 1)
        assert abs(len(known) - r.n_chars) <= 0.02 * len(known) + 12


PROSE = "A fairly long paragraph of ordinary prose that tells the reader something about the matter at hand."
LAYOUTS = [  # (page, the blocks to keep)
    (f"<article><h1>Title here</h1><p>{PROSE}</p><p>{PROSE} {PROSE}</p><div class=comments><p>Great text, thanks!</p></div></article>",
     ["Title here", PROSE, f"{PROSE} {PROSE}"]),
    (f"<article><p>{PROSE}</p><p>{PROSE}</p><div class=discussion><p>I do not agree with this.</p><p>Me neither</p></div></article>", [PROSE] * 2),
    (f"<div class=post><h1>Rivers</h1><p>{PROSE}</p><p>{PROSE}</p></div>", ["Rivers", PROSE, PROSE]),
    (f"<article><p>{PROSE}</p><table><tr><td>Length</td><td>12 km</td></tr></table><p>{PROSE}</p></article>", [PROSE, "Length", "12 km", PROSE]),
    (f"<div class=content><p>{PROSE}</p><p>{PROSE}</p></div><div>Copyright 2020 The Site</div>", [PROSE] * 2),
    (f"<div class=site><div class=top><a href=/>Home</a><a href=/x>News</a></div><div class=col><h1>Rivers</h1><p>{PROSE}</p><p>{PROSE}</p></div>"
     "<div class=bottom>All rights reserved</div></div>", ["Rivers", PROSE, PROSE]),
    (f"<article><p>{PROSE}<svg><path d=1></p><p>{PROSE}</p></article>", [PROSE] * 2),
    (f"<article><script src=/a.js/>var a;</script><p>{PROSE}</p></article>", [PROSE]),
    (f"<article><p>{PROSE} <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p></article>", [f"{PROSE} x=2 holds."]),
    (f"<table><tr><td><h1>Rivers</h1><p>{PROSE}</p><p>{PROSE}</p><p>{PROSE}</p></td></tr></table>", ["Rivers", PROSE, PROSE, PROSE]),
    (f"<select><option>One<option>Two</select><article><p>{PROSE}</p><ul><li>{PROSE}</li></ul></article>", [PROSE] * 2),
    (f"<main><p>{PROSE}</p><aside class=ad><p>Buy now</p></aside><p>{PROSE}</p></main><footer><p>Terms of use</p></footer>", [PROSE] * 2),
]


def test_extract_other_layouts(spark, labeller):
    """Pages whose markup the test tables do not have, compared exactly."""
    rows = [(k, None, page) for k, (page, _) in enumerate(LAYOUTS)]
    got = {r.page_id: r.text for r in extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), labeller).collect()}
    assert got == {k: " ".join(keep) for k, (_, keep) in enumerate(LAYOUTS)}


def test_all_name_words_are_read():
    page = "<div class='col-12 col-md-8 offset-md-2 mt-4 mb-4 px-3 comments' id=x><p>t"
    path = blocks(page)[0].path
    assert ".comments" in path and ".x" in path


def test_equal_pages_fill_one_place_of_the_sample(spark, monkeypatch):
    class Seen(Exception):
        pass

    def seen(sample):
        raise Seen(sample)

    monkeypatch.setattr(extract, "training_pages", seen)
    own = spark.createDataFrame([(f"<p>page {k}",) for k in range(20)], "html string")
    first = own.orderBy(F.pmod(F.xxhash64("html"), F.lit(1 << 32))).limit(1)
    copies = first.crossJoin(spark.range(300)).select("html")
    with pytest.raises(Seen) as found:
        extract.fit(own.unionByName(copies))
    assert sorted(found.value.args[0]) == sorted(r.html for r in own.collect())


# -- op4

def test_gradients_of_the_ordinal_model():
    r = np.random.default_rng(1)
    words = [b"good", b"fine", b"bad", b"worse"]
    rows, grades = [], []
    for _ in range(300):
        g = int(r.integers(3))
        own = [b"the", b"a", words[3] if g == 0 else words[2] if g == 1 else words[int(r.integers(2))]]
        rows.append(ordinal.features(b" ".join(own)))
        grades.append(g)
    model = ordinal.train(rows, np.array(grades), 3)
    tails = model.tails(model.scores(rows))
    assert (np.diff(model.thresholds) > 0).all() and (tails[:, 0] >= tails[:, 1]).all()
    assert (np.round(tails.sum(1)) == grades).mean() > 0.95


def test_quality_is_learned_and_selects(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    grades = labels.select("doc_id", ordinal.grade_of(F.col("quality"), F.col("toxic")).alias("grade"))
    model = ordinal.fit(docs, grades.filter("doc_id % 4 <> 0"))
    held = ordinal.score(docs, model).join(grades, "doc_id").filter("doc_id % 4 = 0")
    kept = {r[0]: r[1] for r in held.groupBy("grade").agg(F.avg(F.col("keep").cast("int"))).collect()}
    assert kept[2] > 0.9 and kept[0] < 0.35
    assert ordinal.select(docs, model).columns == docs.columns
    odd = spark.createDataFrame([(None, None, 1), (2, "", 1), (2, "", 1), (3, "x " * 50000, 1)], "doc_id long, text string, keep int")
    assert ordinal.score(odd, model).count() == 4 and ordinal.score(odd.limit(0), model).count() == 0
    blind = ordinal.fit(odd, grades.limit(0))
    assert len({r.p_ge_2 for r in ordinal.score(odd, blind).collect()}) == 1


# -- op7

def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return "".join(c if c.isascii() and c.isalnum() or ord(c) > 127 else " " for c in low).split(" ")


def brute(docs, items):
    out = []
    for d, t in docs:
        w = [x for x in words_of(t) if x]
        hit, found = set(), set()
        for i, u in items:
            v = [x for x in words_of(u) if x]
            n = min(10, len(v))
            for k in range(len(v) - n + 1 if n else 0):
                for s in range(len(w) - n + 1):
                    if w[s:s + n] == v[k:k + n]:
                        hit.update(range(s, s + n))
                        found.add(str(i))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_decontamination(spark, block_bytes):
    r = random.Random(3)
    vocabulary = ["ab", "c", "Éa", "d9", "the", "of"]
    line = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = [(k, line(n)) for k, n in enumerate((12, 30, 3, 2, 10, 0, 14, 3))] + [(9, None), (10, "…!"), (2, "of the of")]
    docs = [(k, line(60) + r.choice(". ,-\n") + items[k % 7][1].upper() + "--" + line(9)) for k in range(40)] + [(40, None), (41, ""), (42, "of")]
    got = decontaminate.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"),
                                      spark.createDataFrame(items, "item_id long, text string"), block_bytes=block_bytes)
    assert sorted(tuple(x) for x in got.drop("items").collect()) == brute(docs, items)
    clean = decontaminate.uncontaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                                         spark.createDataFrame(items, "item_id long, text string"), block_bytes=block_bytes)
    assert {x[0] for x in clean.collect()} == {x[0] for x in brute(docs, items) if not x[5]}


def test_decontamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b"), (None, "a b"), (1, "a b")], "doc_id long, text string")
    assert [r.contaminated for r in decontaminate.decontaminate(docs, none).collect()] == [False] * 3
    assert decontaminate.decontaminate(docs.limit(0), none).count() == 0


# -- op9

def test_license_scan(spark):
    rows = [(1, "Under the MIT License. x UNDER the mit-license", 9), (2, "the Apache License, Version 2.0", 9), (3, "CC BY-NC 4.0 cc by nc", 9),
            (4, "mit license", 9), (5, None, 9), (6, "", 9), (7, "Éunder the mit license; under the mit licenses", 9),
            (8, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", 9),
            (8, "Permission is hereby granted, free of charge, to any person obtaining a copy of that book", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels int")
    got = sorted(tuple(r) for r in licenses.scan(docs).collect())
    assert [g[1:7] for g in got] == [
        (9, 2, 0, 5, "mit", "mit"), (6, 1, 1, 1, "apache-2", "apache-2"), (8, 2, 0, 5, "cc-by-nc", "cc-by-nc"),
        (2, 0, None, None, "", ""), (0, 0, None, None, "", ""), (0, 0, None, None, "", ""), (8, 0, None, None, "", ""),
        (16, 0, None, None, "", ""), (16, 0, None, None, "", "mit")]
    assert [round(g[7], 6) for g in got] == [1, 1, 1, 0, 0, 0, 0, 0, 1]
    assert licenses.scan(docs.limit(0)).count() == 0


def test_license_index_of_any_size(spark):
    """Two hundred templates: a longer literal, not a longer plan, and every notice is found where it stands."""
    words = lambda k: f"notice w{k % 7} w{k % 11} name{k} grants use of w{k % 5} under terms{k % 50}"
    many = tuple((f"l{k}", words(k), (f"name{k} grants use",)) for k in range(200))
    docs = spark.createDataFrame([(k, f"x {words(k)} y {words(k + 1)[:60]}") for k in range(0, 200, 9)], "doc_id long, text string")
    plan = lambda ts: len(licenses.scan(docs, ts)._jdf.queryExecution().optimizedPlan().toString().splitlines())
    assert plan(many) == plan(many[:2])
    got = {r.doc_id: r for r in licenses.scan(docs, many).collect()}
    for k, r in got.items():
        full = f"name{k + 1} grants use" in f"x {words(k)} y {words(k + 1)[:60]}"
        assert set(r.labels.split(",")) == {f"l{k}"} | ({f"l{k + 1}"} if full and k < 199 else set()) and abs(r.score - 1) < 1e-9


def test_license_scan_against_every_place(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    notices = [f"Word {w}, then: {w.upper()}. {' '.join(w.split()[:-1])}\n{p} {p}" for _, w, _ in licenses.TEMPLATES for p, _ in licenses.BASE]
    docs = docs.unionByName(spark.createDataFrame([(10**6 + k, t) for k, t in enumerate(notices)], docs.schema)).cache()
    before = lambda words, key: f" {words} ".split(f" {key} ")[0].split()
    templates = [(label, {len(before(words, key)) + j: w for key in keys for j, w in enumerate(key.split())})
                 for label, words, keys in licenses.TEMPLATES]
    want = []
    for d, t in docs.collect():
        w = [x for x in words_of(t) if x]
        at = [(k, label) for phrase, label in licenses.BASE for k in range(len(w)) if w[k:k + len(phrase.split())] == phrase.split()]
        base = {label for _, label in at}
        more = {label for label, must in templates
                if any(all(k + i < len(w) and w[k + i] == x for i, x in must.items()) for k in range(len(w)))}
        want.append((d, len(w), len(at), min(at)[0] if at else None, max(at)[0] if at else None,
                     ",".join(sorted(base)), ",".join(sorted(base | more))))
    got = licenses.scan(docs).drop("score").collect()
    assert sorted(map(tuple, got)) == sorted(want) and len({x[6] for x in want}) > 10


# -- op6

def test_fingerprints(spark):
    r = random.Random(2)
    text = lambda n: " ".join("".join(r.choice("abcdefghé") for _ in range(r.randint(1, 8))) for _ in range(n))
    rows = [(k * 7, text(r.choice((3, 50, 400, 3000))), "x") for k in range(30)]
    rows += [(1000, rows[0][1], "x"), (1001, "", "x"), (1002, None, "x"), (1003, "a" * 5000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, slice string").repartition(5)
    got = {x.doc_id: x for x in fingerprint.next_and_edited(docs).collect()}
    texts = {d: t or "" for d, t, _ in rows}
    order = sorted(texts, reverse=True)
    plain = {x.doc_id: x.fingerprint for x in fingerprint.fingerprints(docs).collect()}
    for d, e in zip(order, order[1:] + order[:1]):
        t, half = texts[d], len(texts[d]) // 2
        changed = t[:len(t) - half] + texts[e][:half]
        assert got[d].n_chars == len(t) and got[d].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert got[d].fingerprint == plain[d] == fingerprint.fingerprint_bytes(t.encode())
        assert 0 <= got[d].near_next <= 1 and 0 <= got[d].near_edited <= 1
    assert plain[0] == plain[1000]
    long = [d for d, t in texts.items() if 500 < len(t) and d < 900]
    assert np.mean([got[d].near_edited for d in long]) > np.mean([got[d].near_next for d in long]) + 0.2
    assert fingerprint.next_and_edited(docs.limit(0)).count() == 0
    single = fingerprint.next_and_edited(docs.filter("doc_id = 0")).first()
    assert single.near_next == 1.0


def plain_fingerprint(data: bytes) -> str:
    """The definition, byte by byte: boundaries where the hash of the last seven bytes ends in ones."""
    if not data:
        return "4::"
    odd, mask = int(fingerprint.ODD[3]), 2**64 - 1
    rolling = [(int.from_bytes((b"\0" * 7 + data)[k + 1:k + 8], "little") * odd & mask) >> 32 for k in range(len(data))]
    size = 4
    while size * 64 < len(data):
        size *= 2
    while size > 4 and sum(r % size == size - 1 for r in rolling) < 32:
        size //= 2

    def signature(block):
        out, chunk = "", b""
        for byte, r in zip(data, rolling):
            chunk += bytes([byte])
            if r % block == block - 1:
                out, chunk = out + fingerprint.CHARACTERS[zlib.crc32(chunk) * 2654435761 >> 20 & 63], b""
        return out + (fingerprint.CHARACTERS[zlib.crc32(chunk) * 2654435761 >> 20 & 63] if chunk else "")

    return f"{size}:{signature(size)}:{signature(2 * size)}"


def plain_likeness(a: str, b: str) -> float:
    if a == b:
        return 1.0

    def near(s, t):
        s, t = (re.sub(r"(.)\1{3,}", r"\1\1\1", v) for v in (s, t))
        row = list(range(len(t) + 1))
        for i, x in enumerate(s, 1):
            row, old = [i], row
            for j, y in enumerate(t, 1):
                row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
        return 1 - row[-1] / max(len(s), len(t)) if s or t else 0.0

    (n, s1, s2), (m, t1, t2) = a.split(":"), b.split(":")
    pairs = {(1, 1): [(s1, t1), (s2, t2)], (1, 2): [(s2, t1)], (2, 1): [(s1, t2)]}
    same = [p for (x, y), p in pairs.items() if int(n) * y == int(m) * x]
    return max((near(*p) for p in same[0]), default=0.0) if same else 0.0


def test_fingerprints_against_the_definition(spark):
    """Fingerprints and both likenesses of every row, repeated ids and missing ones among them."""
    r = random.Random(12)
    text = lambda n: " ".join("".join(r.choice("abcdé") for _ in range(r.randint(1, 7))) for _ in range(n))
    rows = [(k, text(r.choice((1, 5, 60, 300)))) for k in range(25)] + [(30, ""), (31, None), (32, "z" * 3000), (33, "z" * 2000 + text(40))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    texts = {d: t or "" for d, t in rows}
    order = sorted(texts, reverse=True)
    got = {x.doc_id: x for x in fingerprint.next_and_edited(docs).collect()}
    for d, e in zip(order, order[1:] + order[:1]):
        changed = texts[d][:len(texts[d]) - len(texts[d]) // 2] + texts[e][:len(texts[d]) // 2]
        own, other, edited = (plain_fingerprint(t.encode()) for t in (texts[d], texts[e], changed))
        assert (got[d].fingerprint, got[d].edited_fingerprint) == (own, edited)
        assert abs(got[d].near_next - plain_likeness(own, other)) < 1e-9 and abs(got[d].near_edited - plain_likeness(own, edited)) < 1e-9
    again = rows[:6] + rows[:3] + [(0, "another text"), (None, "a b"), (None, None), (None, "a b")]
    odd = fingerprint.next_and_edited(spark.createDataFrame(again, "doc_id long, text string").repartition(4)).collect()
    assert sorted((x.doc_id is None, x.doc_id or 0, x.fingerprint) for x in odd) == sorted(
        (d is None, d or 0, plain_fingerprint((t or "").encode())) for d, t in again)


def test_fingerprints_cover_repetitive_texts(spark):
    """A line said 400 times has hundreds of boundaries; its last half counts as much as its first."""
    text, other = "Line 1 is said over and over.\n" * 400, "Other words stand in passage 1.\n" * 400
    docs = spark.createDataFrame([(1, text), (2, other)], "doc_id long, text string")
    got = {r.doc_id: r for r in fingerprint.next_and_edited(docs).collect()}
    assert len(got[1].fingerprint.split(":")[1]) > 400
    assert 0.4 < got[1].near_edited < 0.6 and got[1].near_next < 0.1
