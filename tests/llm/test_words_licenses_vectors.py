"""Spelling variants, license scan and whitening against plain versions, and their odd inputs."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairnsift.llm import license_scan, license_texts, spelling, whitening
from cairnsift.llm.shared import shipped

DOCS = "doc_id bigint, text string, word string, n string, edited string, places string"  # the last four clash with the operators' own


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    shipped(spark)


def docs(spark, *rows):
    return spark.createDataFrame([(i, t, "x", "x", "x", "x") for i, t in rows], DOCS)


# ---- spelling variants ----------------------------------------------------------

def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(rows, spoil):
    count = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if spoil and h % spoil == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    n = {w: c for w, c in count.items() if len(w) >= 5 and c >= 3}
    others = {w: [x for x in n if near(w, x)] for w in n}
    form = {}
    for w, xs in others.items():
        if xs:
            top = min(xs, key=lambda x: (-n[x], x))
            if n[top] >= 2 * n[w]:
                form[w] = top
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n[w], len(others[w]), n.get(form.get(w)))
    return out


WORDS = ["colour"] * 40 + ["color"] * 18 + ["colou"] * 6 + ["coloür"] * 3 + ["Straße"] * 9 + ["STRASSE"] * 4 + ["strase"] * 4 + ["stras"] * 3 + ["aaaaaa"] * 7 + ["aaaaa"] * 3 + ["aaaaaaa"] * 3 + [
    "Äpfel"] * 4 + ["äpfel"] * 9 + ["tieab"] * 3 + ["tieac"] * 6 + ["tiead"] * 6 + ["z" * 3000] * 3 + ["z" * 2999] * 7 + ["four"] * 9


@pytest.mark.parametrize("most", [spelling.FILTER_BYTES, 64])
@pytest.mark.parametrize("spoil", [None, 5])
def test_variants_equal_brute_force(spark, most, spoil):
    rows = [(k % 11 if k % 13 else None, w + (" " if k % 2 else "\n1") + w) for k, w in enumerate(WORDS)] + [(7, None), (8, ""), (9, "?! 12")]
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(docs(spark, *rows), spoil=spoil, most=most).collect()}
    assert got == plain_variants(rows, spoil)
    if spoil is None:
        assert got["tieab"][0] == "tieac" and got["colou"][1] == "colour" and got["z" * 3000][1] == "z" * 2999 and got["äpfel"][2] == 18


def test_variants_of_nothing(spark):
    assert spelling.variants(docs(spark)).collect() == []
    assert spelling.variants(docs(spark, (1, None), (2, "a b c"))).collect() == []
    with pytest.raises(ValueError):
        spelling.variants(docs(spark), factor=1)


def test_filters_hold_every_word_and_few_others(spark):
    words = [f"word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(3000)]
    counts = Counter(map(len, words))
    shards = spelling.Shards.of(counts, 1 << 12)
    assert len(shards.groups(1 << 12)) > 1
    import pyarrow as pa
    held = np.zeros(int(shards.sizes().sum()) * 8, np.uint64)
    begin = np.cumsum(shards.sizes() * 8) - shards.sizes() * 8
    f = spelling.flat(pa.array(words))
    prints = spelling.mixed(f.whole)
    shard, block = shards.locate(prints, f.sizes)
    for w, mask in spelling.bits(prints):
        np.bitwise_or.at(held, begin[shard] + block * 8 + w, mask)
    filt = spelling.Filter(held, begin)
    assert len(filt.knows(shards, prints, f.sizes)) == len(words)
    g = spelling.flat(pa.array([w[:-1] + "é" for w in words]))
    assert len(filt.knows(shards, spelling.mixed(g.whole), g.sizes)) < 60


# ---- license scan ---------------------------------------------------------------

def plain_pattern(parts):
    out = ""
    for part in parts:
        out += (f"(?:{'[0-9]+' if part[3] else '[^ ]+'} ){{{part[1]},{part[2]}}}" if part[0] == "var" else
                {"word": re.escape(part[-1]) + " ", "begin": "(?:", "end": ")?"}[part[0]])
    return re.compile(out)


def plain_scan(text, templates, phrases):
    words = license_scan.words_of(text or "")
    joined = "".join(w + " " for w in words)
    starts, at = [], 0
    for w in words:
        starts.append(at)
        at += len(w) + 1
    rules = [(label, False, plain_pattern(license_scan.regions(t))) for label, t in templates] + [(label, True, plain_pattern(license_scan.regions(p))) for p, label in phrases.items()]
    found = set()
    for label, phrase, pattern in rules:
        for k, at in enumerate(starts):
            m = pattern.match(joined, at)
            if m:
                found.add((k, m[0].count(" "), label, phrase))
    covered = {p for k, n, *_ in found for p in range(k, k + n)}
    base = sorted(k for k, _, _, phrase in found if phrase)
    names = lambda rows: ",".join(sorted({r[2] for r in rows}))
    return (len(words), len(base), base[0] if base else None, base[-1] if base else None, names(x for x in found if x[3]), names(found), len(covered) / len(words) if words else 0.0)


def filled(template):
    return re.sub(r"<<var.*?match=digits>>", "4 0", re.sub(r"<<(begin|end)Optional>>", "", template)).replace("<<var;name=holder;words=1-16>>", "the authors").replace("<<var;name=scheme;words=1>>", "https").replace(
        "<<var;name=modal;words=1>>", "can").replace("<<var;name=what;words=1-3>>", "this file")


TEXTS = [None, "", " \n\t", "Released under the MIT License.", "mit license MIT\nLICENSE", "Licensed under CC BY-NC 4.0.", "licensed under cc by-nc-sa 4.0", "licensed under cc by nc four 0",
         "This work is licensed under the GNU General Public License, version 3.", "the mit licenses", "Apache  License / General-Public-License", "word " * 30_000 + "apache license",
         "licensed under " * 2000 + "cc by 4.0", "licensed under", "Lizenz: é MIT License ünd"]


def test_scan_equals_plain_search(spark):
    texts = TEXTS + [filled(t) for _, t in license_texts.TEMPLATES] + ["x " + filled(t) + " y" for _, t in license_texts.TEMPLATES]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, texts[4])]
    got = sorted(map(tuple, license_scan.scan(docs(spark, *rows)).collect()), key=str)
    want = sorted(((i, *plain_scan(t, license_texts.TEMPLATES, license_texts.PHRASES)) for i, t in rows), key=str)
    assert got == want
    full = {r.doc_id: r for r in license_scan.scan(docs(spark, *enumerate(filled(t) for _, t in license_texts.TEMPLATES))).collect()}
    assert all(label in full[i].labels.split(",") and full[i].score == 1.0 for i, (label, _) in enumerate(license_texts.TEMPLATES))


def test_mandatory_words_must_stand(spark):
    body = license_scan.words_of(filled(license_texts.ISC))
    texts = [" ".join(body)] + [" ".join(body[:k] + ["other"] + body[k + 1:]) for k in range(len(body))]
    found = {r.doc_id: r.labels for r in license_scan.scan(docs(spark, *enumerate(texts))).collect()}
    optional = body.index("or")  # "and/or distribute": the only word that may be missing
    assert found[0] == "isc" and all(found[k + 1] == "" for k in range(len(body)) if k != optional)
    assert license_scan.scan(docs(spark)).collect() == []


def test_templates_are_checked():
    assert license_scan.Automaton([("x", "a b<<var;name=v;words=0-2>> c")]).longest(iter("a b q c c".split())) == {"x": 5}
    for bad in ("a", "<<var;name=v>> b c", "a b <<beginOptional>> c", "a b <<strange>>"):
        with pytest.raises(ValueError):
            license_scan.Automaton([("x", bad)])


# ---- whitening ------------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<double>, vector string, n string, component string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", "x", "x") for i, v in rows], VECTORS)


def plain_whitening(values):
    x = np.floor(64 * np.array(values, float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    a = (n * x - s) / n
    e, u = np.linalg.eigh(a.T @ a / n)
    return x, n, s, a, e[::-1], u[:, ::-1]


def test_whitening_equals_the_eigenvectors(spark):
    rng = np.random.default_rng(7)
    values = rng.normal(size=(300, 40)) * np.linspace(1, 6, 40) + 5
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(values)]
    bad = [(900, None), (901, [float("nan")] * 40), (902, [None] * 40), (903, [float("inf")] + [0.0] * 39), (904, [0.0] * 39), (905, []), (906, [1e300] * 40)]
    got = whitening.whitened(vectors(spark, rows + bad)).toPandas()
    x, n, s, a, e, u = plain_whitening(values)
    assert set(got.vec_id) == set(range(300)) and set(got.component) == set(range(1, 33)) and len(got) == 300 * 32 and (got.n == n).all()
    assert dict(zip(got.vec_id, got.deviation)) == {i: int(sum((n * int(c) - int(t)) ** 2 for c, t in zip(x[i], s))) for i in range(300)}
    mine = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    want = (a @ u / np.sqrt(e))[:, :32]
    want *= np.sign((want * mine).sum(axis=0))
    assert np.abs(mine - want).max() < 1e-8
    assert np.allclose(got.groupby("component").explained.first(), e[:32] / e.sum(), rtol=1e-9) and got.identity_error.max() < 1e-9


@pytest.mark.parametrize("scale", [1e-1, 1e4])
def test_whitening_of_deficient_rows(spark, scale):
    rng = np.random.default_rng(3)
    values = np.round(rng.normal(size=(80, 3)) * 64 * 16) / 64 * scale
    values = np.hstack([values, values[:, :1], np.full((80, 1), 2.0), -values[:, 1:2]])
    rows = [(i % 5 or None, [float(c) for c in v]) for i, v in enumerate(values)]  # repeated and null ids
    fitted = whitening.fit(vectors(spark, rows).select("embedding"))
    *_, e, _ = plain_whitening(values)
    rank = int((e > e[0] * 1e-12).sum())
    assert fitted.size == rank and np.allclose(fitted.eigenvalues, e[:rank], rtol=1e-8) and fitted.identity_error < 1e-6


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(None, [])], [(1, None)]])
def test_whitening_without_variance(spark, rows):
    frame = whitening.whitened(vectors(spark, rows))
    assert frame.collect() == [] and frame.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_whitening_of_few_and_repeated_rows(spark):
    rows = [(1, [1.0, 2.0, 0.0]), (1, [1.0, 2.0, 0.0]), (2, [4.0, 0.0, 1.0])]
    got = whitening.whitened(vectors(spark, rows)).collect()
    assert len(got) == 3 and {r.component for r in got} == {1} and got[0].explained == pytest.approx(1)
    far = whitening.Whitening(4 << 20, np.zeros(1, np.int64), np.ones((1, 1)), np.ones(1), np.ones(1), 0.0, 1)
    assert far.deviation(np.array([[3], [1 << 30]])).to_pylist() == [(3 * (4 << 20)) ** 2, None]
