"""Operators with code inside Spark tasks, against plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cairnsift.llm import decontaminate, html_text, language_model, near_dup, substring_dedup, token_counts
from cairnsift.llm.shared import shipped
from tests.llm import plain

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(autouse=True)
def code(spark):
    shipped(spark)


def docs(spark, *texts):
    return spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in enumerate(texts)], DOCS)


def passages(seed, n=40, vocabulary=6):
    """Texts over few words, so that passages repeat by chance and by copying."""
    rng = random.Random(seed)
    base = [str(rng.randrange(vocabulary)) for _ in range(80)]
    out = []
    for _ in range(n):
        a = rng.randrange(60)
        out.append(" ".join([str(rng.randrange(vocabulary)) for _ in range(rng.randrange(9))] + base[a: a + rng.randrange(30)] + [str(rng.randrange(vocabulary)) for _ in range(rng.randrange(9))]))
    return out


@pytest.mark.parametrize("window,vocabulary", [(13, 6), (5, 2), (1, 9), (3, 1)])
def test_substring_dedup_against_brute_force(spark, window, vocabulary):
    texts = [*passages(window, vocabulary=vocabulary), None, "", " \t", "é\x0bü é"]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.remove(docs(spark, *texts), window).collect()}
    assert got == plain.kept_words(list(enumerate(texts)), window)


def test_windows_are_named_by_their_words_alone():
    rng = random.Random(5)
    for _ in range(60):
        v, width = rng.choice([1, 2, 3, 10]), rng.choice([1, 2, 5, 13])
        base = [str(rng.randrange(v)) for _ in range(50)]
        texts = [" ".join([str(rng.randrange(v)) for _ in range(rng.randrange(6))] + base[rng.randrange(25):] + [str(rng.randrange(v)) for _ in range(rng.randrange(6))]).encode() for _ in range(6)]
        w = substring_dedup.split(texts)
        seen = {}
        for d, first, n, name in zip(*substring_dedup.passages(w, width)):
            own = texts[d].split()
            for k in range(first - w.first[d], first - w.first[d] + n):
                assert seen.setdefault(tuple(own[k: k + width]), name) == name


def test_substring_dedup_rows_of_units_are_short(spark):
    """The name's cleared low bits and one value for first window and number are what a unit's row saves on disk."""
    texts = [" ".join(random.Random(k).choices(["ab", "cd", "ef", "gh"], k=90)) for k in range(3)]
    rows = substring_dedup.named_units(substring_dedup.keyed(docs(spark, *texts), "doc_id", "text"), 13).collect()
    w = substring_dedup.split([t.encode() for t in texts])
    want = {(int(d), int(first - w.first[d]), int(n)) for d, first, n, _ in zip(*substring_dedup.passages(w, 13))}
    assert {(r.doc_id, r.place & 0xFFFFFFFF, r.place >> 32) for r in rows} == want
    assert rows[0].__fields__ == ["name", "copy", "doc_id", "place"] and all(r.name & 0xFFFF == 0 for r in rows)


def test_substring_dedup_odd_tables(spark):
    long = " ".join(map(str, range(20)))
    frame = docs(spark, long, long, long).withColumn("doc_id", F.when(F.col("doc_id") > 0, F.col("doc_id")))
    assert sorted((r.doc_id is None, r.n_removed) for r in substring_dedup.remove(frame).collect()) == [(False, 0), (False, 20), (True, 0)]
    assert substring_dedup.remove(frame.limit(0)).count() == 0
    assert {r.n_removed for r in substring_dedup.remove(docs(spark, long).union(docs(spark, long))).collect()} == {0}


def test_substring_dedup_two_texts_of_one_id(spark):
    first, second = " ".join(f"a{k}" for k in range(20)), " ".join(f"b{k}" for k in range(30))
    frame = docs(spark, first, "own words before it " + first, second, "short").withColumn("doc_id", F.least("doc_id", F.lit(2)) % 2)
    # Ids 0, 1, 0, 0: only the text of id 1 repeats an earlier document.
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in substring_dedup.remove(frame).collect()) == [(0, 1, 0), (0, 20, 0), (0, 30, 0), (1, 24, 20)]
    torn = docs(spark, first, second + " " + first, "two").withColumn("doc_id", F.least("doc_id", F.lit(1)))
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in substring_dedup.remove(torn).collect()) == [(0, 20, 0), (1, 1, 0), (1, 50, 20)]


def test_near_duplicates_two_texts_of_one_id(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    frame = spark.createDataFrame([(3, a), (5, a + " more"), (5, b), (7, b), (9, c), (9, ""), (9, None), (None, a)], "doc_id bigint, text string")
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1, r.kept) for r in near_dup.groups(frame).collect())
    assert got == [(-1, 36, -1, True), (3, 36, 3, True), (5, 36, 3, False), (5, 37, 3, False), (7, 36, 3, False), (9, 0, 9, True), (9, 0, 9, True), (9, 36, 9, True)]


def near_texts(seed, groups=12, copies=6):
    rng = random.Random(seed)
    out = []
    for g in range(groups):
        base = [f"w{rng.randrange(300)}" for _ in range(rng.choice([3, 30, 120]))]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randrange(4)):
                text[rng.randrange(len(text))] = f"x{rng.randrange(1000)}"
            out.append(" ".join(text))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates_against_brute_force(spark, width):
    texts = [*near_texts(width), None, "", "  ", "One TWO three", "one two THREE", "Élan x", "élan x"]
    want = plain.components(list(enumerate(texts)), width)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.groups(docs(spark, *texts), width).collect()}
    assert got == want


def test_near_duplicates_chain_beyond_their_hub(spark):
    """Each text links with the next one only; all are one component, though most don't link with the least."""
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[k * 9: k * 9 + 100]) for k in range(25)]
    assert {r.component_id for r in near_dup.groups(docs(spark, *texts)).collect()} == {0}


def test_near_duplicates_meet_by_their_changes(spark):
    """Of a group of near copies in many components, few pairs beyond the links meet, and no link between components is lost."""
    rng = random.Random(8)
    base = [f"w{k}" for k in range(150)]
    texts = []
    for k in range(160):
        text = list(base)
        for at in rng.sample(range(150), rng.randrange(2, 8)):
            text[at] = f"x{k}-{at}"
        if k % 20 == 19:
            text = texts[-1].split()
            text[k % 150] = "y"
        texts.append(" ".join(text))
    rows = docs(spark, *texts).select("doc_id", "text")
    sets = [{tuple(t.split()[i:i + 4]) for i in range(147)} for t in texts]
    links = {(a, b) for a in range(160) for b in range(a + 1, 160) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    hub = max(range(160), key=lambda k: sum(k in x for x in links))
    part = {k: hub if k == hub or (min(k, hub), max(k, hub)) in links else k for k in range(160)}
    assert 20 < len(set(part.values())) < 140
    places = spark.createDataFrame([(hub, part[k], k) for k in range(160)], "anchor bigint, part bigint, node bigint")
    met = {tuple(sorted((r.a, r.b))) for r in near_dup.likely(places, near_dup.shingled(rows, places.select("node"), 4), 80).collect()}
    across = sum(part[a] != part[b] for a in range(160) for b in range(a))

    def joined(pairs):
        top = dict(part)
        for _ in range(160):
            for a, b in pairs:
                low, high = sorted((top[a], top[b]))
                top = {k: low if v == high else v for k, v in top.items()} if low != high else top
        return top

    crossing = {(a, b) for a, b in links if part[a] != part[b]}
    assert crossing and joined(met & links) == joined(crossing)
    assert 20 * len(met - links) < across


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 1 << 62, 1000).astype(np.uint64))
    b = np.unique(np.concatenate([a[:800], rng.integers(0, 1 << 62, 200).astype(np.uint64)]))
    table = near_dup.sketches([a, b, a[:1], a[:3], a[:0]])
    assert (table[:4] != np.iinfo(np.uint64).max).all() and (table[4] == np.iinfo(np.uint64).max).all()
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((table[0] == table[1]).mean() - true) < 0.12


def test_near_duplicates_odd_tables(spark):
    same = "a b c d e f g h"
    frame = docs(spark, same, same, same).withColumn("doc_id", F.when(F.col("doc_id") > 0, F.col("doc_id"))).withColumn("node", F.lit(1)).withColumn("hub", F.lit(2))
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in near_dup.groups(frame).collect()) == [(-1, -1, True), (1, 1, True), (2, 1, False)]
    assert near_dup.groups(frame.limit(0)).count() == 0


def coder():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return public_tokenizers.path("word_bpe_49k.json")


def test_token_counts_against_the_library(spark):
    path = coder()
    texts = [None, "", " ", "Don't stop,  naïve café\t42!", "a" * 5000, "ab " * 4000, "x<|endoftext|> y " * 500, "Ünïcödé’s 12345 $$$ " * 300, ("z" * 700 + " ") * 20, "\x1c\x1d mixed   spaces " * 200]
    plain_coder = token_counts.tokenizer(path)
    want = {i: len(plain_coder.encode(t, add_special_tokens=False).ids) if t else 0 for i, t in enumerate(texts)}
    for chunk, overlap in ((40_000, 1_000), (300, 40), (64, 8)):
        got = {r.doc_id: r for r in token_counts.count(docs(spark, *texts), path, chunk=chunk, overlap=overlap).collect()}
        assert {i: r.n_tokens for i, r in got.items()} == want
        assert all(got[i].n_bytes == len((t or "").encode()) and got[i].over_limit == (want[i] > 2048) for i, t in enumerate(texts))
    assert token_counts.count(docs(spark, "a").limit(0), path).count() == 0


ITEM = "Which of these seven old rivers, counted from the north, reaches the inner sea first after the spring floods have passed over the plain and left it dry again?"


def test_leaks_whole_edited_and_clean(spark):
    bench = spark.createDataFrame([(7, ITEM), (8, "short one"), (9, None), (10, "Name the capital city of the smallest northern island state, please.")], "item_id bigint, text string")
    edited = ITEM.replace("rivers", "river").replace("inner", "innner")
    filler = "nothing to see in this text at all, it only fills the space. " * 30
    texts = [filler + ITEM + filler, filler + edited.upper() + filler, filler, None, "", ITEM[:60], "see: NAME the Capital-city of the smallest northern island state please", ITEM[20:150] + filler, "short one"]
    got = {(r.doc_id, r.item_id): r.edits for r in decontaminate.find(docs(spark, *texts), bench).collect()}
    assert set(got) == {(0, 7), (1, 7), (6, 10), (7, 7)} and got[0, 7] == 0 and got[6, 10] == 0
    kept = decontaminate.clean(docs(spark, *texts).withColumn("item_id", F.lit(3)), bench)
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 5, 8]
    small = decontaminate.find(docs(spark, *texts), bench, block_chars=10)
    assert {(r.doc_id, r.item_id) for r in small.collect()} == set(got)
    assert decontaminate.find(docs(spark, *texts), bench.limit(0)).count() == 0
    assert decontaminate.find(docs(spark, *texts).limit(0), bench).count() == 0


def test_leaks_of_item_parts_at_every_offset():
    rng = random.Random(3)
    item = "".join(rng.choice("abcdefghij") for _ in range(390))
    index = decontaminate.build([(4, item), (5, "Who wrote the seven plays?")])
    size = decontaminate.PROBE + decontaminate.STRIDE - 1
    texts = [f"before it {item[k: k + size]} after it" for k in range(len(item) - size + 1)]
    assert all(hits[4][0] == 0 for hits in decontaminate.search(texts, index))
    assert [set(h) for h in decontaminate.search(["so: who wrote the sevem plays", "so: who read seven books"], index)] == [{5}, set()]


def test_clean_searches_items_without_id(spark):
    bench = spark.createDataFrame([(None, ITEM)], "item_id bigint, text string")
    assert [r.doc_id for r in decontaminate.clean(docs(spark, ITEM, "other"), bench).collect()] == [1]


def test_leaks_against_brute_force():
    rng = random.Random(8)
    chars = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    items = [(i, chars(rng.randrange(45, 200))) for i in range(6)]
    index = decontaminate.build(items)
    texts = []
    for _ in range(40):
        part = list(items[rng.randrange(6)][1])
        for _ in range(rng.randrange(14)):
            k = rng.randrange(len(part))
            part[k: k + 1] = rng.choice([[], ["x"], [part[k], "y"]])
        texts.append(chars(rng.randrange(100)) + " " + "".join(part) + " " + chars(rng.randrange(100)))
    got = decontaminate.search(texts, index)
    for text, hits in zip(texts, got):
        line = decontaminate.plain(text).tolist()
        want = {item for item, p in index.probes if plain.edit_distance_within(p.tolist(), line) <= len(p) // decontaminate.EDITS}
        assert set(hits) == want


PAGE = ("<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><ul><li><a href=/a>A</a></li></ul></nav>"
        "<div class='cookie-notice'>We use cookies on this page.</div><article><h1>A t&eacute;st</h1><p>First   paragraph of the\n article, with words.<br>More.</p>"
        "<div class=\"ad\">Buy this now.</div><p>Second &lt;b&gt; one.</p><section id=\"comments\"><p>I like this article very much indeed.</p></section></article>"
        "<aside>Related</aside><form>Name <input></form><script>var t='</p>';</script><footer>&copy; us</footer></body></html>")


def test_main_text(spark):
    pages = [PAGE, None, "", "plain", "<p", "<script>x", PAGE[:420]]
    frame = spark.createDataFrame([(i, f"u{i}", p) for i, p in enumerate(pages)], "page_id bigint, url string, html string").withColumn("text", F.lit(1))
    got = {r.page_id: r for r in html_text.main_text(frame).collect()}
    assert got[0].text == "A tést\nFirst paragraph of the article, with words. More.\nSecond <b> one."
    assert [got[i].text for i in (1, 2, 4, 5)] == [""] * 4 and got[0].n_chars == len(got[0].text)
    assert got[6].text.startswith("A tést\nFirst paragraph")
    assert html_text.main_text(frame.limit(0)).count() == 0


def test_minimum_cut_against_all_labellings():
    rng = random.Random(2)
    for _ in range(200):
        n = rng.randrange(1, 9)
        gain = [rng.uniform(-1, 1) for _ in range(n)]
        edges = [(i, i + 1, rng.uniform(0, 1)) for i in range(n - 1)] + [(rng.randrange(n), rng.randrange(n), rng.uniform(0, 1)) for _ in range(n)]
        edges = [(a, b, w) for a, b, w in edges if a != b]
        value = lambda bits: sum(g for g, k in zip(gain, bits) if k) - sum(w for a, b, w in edges if bits[a] != bits[b])
        best = max(value([m >> k & 1 == 1 for k in range(n)]) for m in range(1 << n))
        assert value(html_text.min_cut(gain, edges)) == pytest.approx(best)


def test_gradients_against_differences():
    p = {k: v.astype(float) for k, v in language_model.unpacked(language_model.start()).items()}
    rng = np.random.default_rng(0)
    lanes = language_model.laid([rng.integers(0, language_model.NET + 1, n).astype(np.int32) for n in (9, 5, 7, 3)], 2)
    cut, state = slice(0, language_model.WINDOW), np.zeros((lanes.inputs.shape[1], language_model.HIDDEN))

    def value(q):
        hidden, trace = language_model.forward(q, lanes.inputs[cut], lanes.fresh[cut], state)
        kept = lanes.targets[cut] >= 0
        logp, saved = language_model.outputs(q, hidden[kept], lanes.targets[cut][kept])
        return logp.mean(), trace, kept, saved

    _, trace, kept, saved = value(p)
    g = language_model.backward(p, lanes.inputs[cut], lanes.fresh[cut], trace, lanes.targets[cut][kept], kept, saved)
    for key in p:
        at = np.unravel_index(np.argmax(np.abs(g[key])), p[key].shape)
        up, down = ({k: v.copy() for k, v in p.items()} for _ in range(2))
        up[key][at] += 0.01
        down[key][at] -= 0.01
        assert g[key][at] == pytest.approx((value(up)[0] - value(down)[0]) / 0.02, rel=2e-2)


def test_probabilities_sum_to_one():
    p = language_model.unpacked(language_model.start())
    h = np.full((language_model.NET + 1, language_model.HIDDEN), 0.3, np.float32)
    logp, _ = language_model.outputs(p, h, np.arange(language_model.NET + 1))
    assert np.exp(logp).sum() == pytest.approx(1, abs=1e-4)


def test_networks_sent_follow_the_cores(spark):
    """One network a partition: many files are few networks."""
    many = docs(spark, *[f"text {k}" for k in range(100)]).repartition(64)
    assert language_model.gathered(many).rdd.getNumPartitions() <= max(spark.sparkContext.defaultParallelism, 8)


def test_scores_do_not_depend_on_lanes():
    p = language_model.unpacked(language_model.start())
    rng = np.random.default_rng(4)
    texts = [rng.integers(0, language_model.NET + 1, n).astype(np.int32) for n in (70, 1, 33, 5, 16)]
    alone = [language_model.score(p, [t])[0] for t in texts]
    assert language_model.score(p, texts) == pytest.approx(alone, rel=1e-4)


def test_named_tokens_follow_the_counts():
    counts = np.array([2000 - k for k in range(1500)] + [3] * 40)
    lexicon = language_model.Lexicon({str(i): i for i in range(len(counts))}, counts, int(counts.sum()), len(counts))
    assert lexicon.names == 1500
    p = language_model.unpacked(language_model.start(counts[:1500], lexicon.rest), 1500)
    h = np.zeros((1501, language_model.HIDDEN), np.float32)
    share = np.exp(language_model.outputs(p, h, np.arange(1501))[0])
    assert share.sum() == pytest.approx(1, abs=1e-4)
    assert share[:1500] == pytest.approx(counts[:1500] / (counts[:1500].sum() + lexicon.rest), rel=1e-3)
    # A pair of tokens far below the 512 most frequent is learnt.
    text = np.array([1400, 1450] * 200, np.int32)
    before = language_model.score(p, [text])[0]
    language_model.train(p, {k: np.full_like(v, 1e-3) for k, v in p.items()}, [text])
    assert language_model.score(p, [text])[0] > before + 100


def test_language_model_base_and_gain(spark):
    import math
    import zlib
    from collections import Counter

    rng = random.Random(6)
    texts = [" ".join(("The cat sat on the mat".split() if rng.random() < 0.5 else "A dog ran in my yard".split()) * rng.randrange(1, 30)) for _ in range(150)] + [None, "", "unseen WORDS here"]
    frame = docs(spark, *texts)
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    said = {i: [w.decode() for w in plain.words(t)] for i, t in enumerate(texts)}
    said = {i: [w.lower() for w in ws] + ["\n"] for i, ws in said.items()}
    c = Counter(w for i, ws in said.items() if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    # Few known tokens, so that most go through the join.
    for known in (5, 200_000):
        got = {r.doc_id: r for r in language_model.scored(frame, known=known).collect()}
        for i, ws in said.items():
            assert (got[i].held_out, got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (held(i), len(ws), sum(c[w] > 0 for w in ws), n)
            assert got[i].base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws))
        assert all(r.score < 0 for r in got.values())
    out = [got[i] for i in got if held(i) and len(said[i]) > 10]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    assert language_model.scored(frame.limit(0)).count() == 0


def test_pipeline_against_plain_steps(spark, tmp_path):
    good = "The quick brown fox number {0} jumps over lazy dog {0} and runs to house {0} before noon.\nThen it sleeps {0} hours under tree {0} near the river until the {0} bells ring out."
    rows = [good.format(f"k{i}") for i in range(30)]
    rows += [rows[0].replace("noon", "nine"), None, "", "too short", "a b c d e f " * 5, rows[5] + "\n" + ITEM]
    docs(spark, *rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, str(tmp_path))
        assert frame.columns == DOCS.replace(" bigint", "").replace(" string", "").split(", ")
        frame.write.parquet(f"{tmp_path}/{len(kept)}")
        frame = spark.read.parquet(f"{tmp_path}/{len(kept)}")
        kept.append({r.doc_id: r.text for r in frame.collect()})
    assert set(kept[0]) == set(range(30)) | {30, 35}
    texts = kept[1]
    want = plain.components(sorted(texts.items()), 5)
    assert set(kept[2]) == {i for i in texts if want[i][1] == i}
    assert set(kept[3]) == {i for i, t in kept[2].items() if ITEM not in t} and 35 not in kept[3]
    final = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in final.collect()} <= set(kept[3]) and "copy" in final.columns


def test_network_tells_kinds_of_text_apart(spark):
    """Two vocabularies that share no token: a text's first words tell which of them follows."""
    rng = random.Random(8)
    texts = [" ".join(f"{rng.choice('ab') if k == 0 else 'ab'[n % 2]}{rng.randrange(40)}" for k in range(60)) for n in range(300)]
    got = language_model.scored(docs(spark, *texts)).where("held_out").collect()
    # Knowing the vocabulary is worth log10(2) = 0.3 a token.
    assert sum(r.score - r.base_score for r in got) > 0.15 * sum(r.n_tokens for r in got)


def test_weights_are_sent_in_half_their_bits():
    values = np.array([0.0, -3.75, 1e-9, 123456.0, 2e8], np.float32)
    assert len(language_model.halved(values)) == 2 * len(values)
    assert language_model.whole(language_model.halved(values)) == pytest.approx(values, rel=2 ** -8)
