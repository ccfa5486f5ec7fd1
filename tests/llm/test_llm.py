"""Each operator against brute force, SQL, an exact round trip or held-out labels; edge cases for all."""

import collections
import os
import random
import re
import sys

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import oracle
from pyspark.sql import functions as F

import corpus_pipeline
from gleaner.llm import bitplanes, covertree, html, mixing, packing, quality, queries, simhash, substrings, topk, toxicity

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words_of(text):
    return re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").lower().encode())


def table(spark, name, folder=SMALL):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark, rows):
    """(doc_id, text) or (doc_id, text, source) rows as documents."""
    return spark.createDataFrame([(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, "documents").cache()


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls, empty and very long texts, repeated rows, ties, and columns named like those the operators add."""
    long = " ".join(f"w{k % 7919}" for k in range(60_000))
    rows = [(1, "one two three"), (1, "one two three"), (2, ""), (3, None), (None, "no number here"), (4, long), (5, long), (6, "   \n"), (7, "one two three"), (None, None)]
    found = spark.createDataFrame([(a, b, None if a == 2 else "en", None if a == 6 else "s", None if a == 3 else len(b or "")) for a, b in rows], DOCS)
    clashing = "_doc _source _rate _steps _u _n _k _s _spans _text copy shuffle_key label group_id score rank n length start key sequence Dropped s number salt toxicity quality a b f0".split()
    return found.select("*", *[F.lit("x").alias(c) for c in clashing])


@pytest.fixture(scope="module")
def labels(spark):
    return table(spark, "labels", MIDDLE)


# 1

def test_simhash_pairs_equal_brute_force(spark):
    marked = simhash.marks(table(spark, "documents", MIDDLE)).toPandas()
    f = marked[["f0", "f1", "f2"]].to_numpy().view(np.uint64)
    expected = set()
    for i in range(len(f)):
        d = np.bitwise_count(f[i + 1 :] ^ f[i])
        for j in np.flatnonzero((d[:, 0] <= simhash.TAU) & (d[:, 1] + d[:, 2] <= simhash.CONFIRM)):
            expected.add(tuple(sorted((int(marked.doc_id[i]), int(marked.doc_id[i + 1 + j])))))
    group = {}
    find = lambda x: x if group.setdefault(x, x) == x else find(group[x])
    for a, b in expected:
        a, b = find(a), find(b)
        group[max(a, b)] = min(a, b)
    got = {(r.doc_id, r.group_id) for r in simhash.near_duplicates(table(spark, "documents", MIDDLE)).collect()}
    assert got == {(x, find(x)) for x in list(group)}
    found = [(r.a, r.b) for r in simhash.pairs(simhash.marks(table(spark, "documents", MIDDLE)).cache()).collect()]
    assert sorted(found) == sorted(expected)


def test_simhash_finds_near_copies(spark):
    """Recall against word triples: pairs of documents that share half of theirs or more."""
    texts = {r.doc_id: words_of(r.text) for r in table(spark, "documents", MIDDLE).collect()}
    grams = {d: set(zip(w, w[1:], w[2:])) for d, w in texts.items() if len(w) > 2}
    holders = collections.defaultdict(list)
    for d, g in grams.items():
        for x in g:
            holders[x].append(d)
    shared = collections.Counter((min(a, b), max(a, b)) for ds in holders.values() if len(ds) < 100 for i, a in enumerate(ds) for b in ds[:i])
    near = [(a, b) for (a, b), n in shared.items() if n >= 0.5 * (len(grams[a]) + len(grams[b]) - n)]
    group = {r.doc_id: r.group_id for r in simhash.near_duplicates(table(spark, "documents", MIDDLE)).collect()}
    found = [group.get(a, -1) == group.get(b, -2) for a, b in near]
    assert len(near) > 100 and sum(found) >= 0.95 * len(near)
    linked = collections.defaultdict(set)
    for d, g in group.items():
        linked[g].add(d)
    touching = {x for p, n in shared.items() if n >= 0.3 * min(len(grams[p[0]]), len(grams[p[1]])) for x in p}
    assert all(d in touching or d not in grams for d in group)


def test_simhash_equals_sql(spark):
    assert oracle.compare(queries.op1_simhash(spark, MIDDLE), oracle.connect(MIDDLE), simhash.ORACLE)[0]


def test_simhash_of_a_repeated_id(spark):
    """Of two texts under one doc_id one counts, and copies of the other still find each other."""
    rng = random.Random(8)
    a, b = (" ".join(f"{k}{rng.randrange(10**6)}" for _ in range(200)) for k in "ab")
    group = {(r.doc_id, r.group_id) for r in simhash.near_duplicates(documents(spark, [(5, a), (5, b), (9, a), (12, a), (14, b), (16, b)])).collect()}
    assert group in ({(5, 5), (9, 5), (12, 5), (14, 14), (16, 14)}, {(5, 5), (14, 5), (16, 5), (9, 9), (12, 9)})


def test_simhash_of_far_bounds():
    costs = [np.arange(9.0)] * 4
    assert sum(simhash.allocate(costs, 25)) == 25


def test_simhash_thresholds():
    costs = [np.array([0.0, 5, 20, 60]), np.array([0.0, 1, 2, 3]), np.array([0.0, 9, 9, 90])]
    chosen = simhash.allocate(costs, 1)
    cost = lambda ts: sum(c[t + 1] for c, t in zip(costs, ts))
    options = [(a, b, c) for a in range(-1, 3) for b in range(-1, 3) for c in range(-1, 3) if a + b + c == 1]
    assert cost(chosen) == min(map(cost, options))
    counts = np.random.default_rng(1).integers(0, 5, 64).astype(float)
    apart = [sum(counts[x] * counts[y] for x in range(64) for y in range(64) if bin(x ^ y).count("1") <= t) for t in range(3)]
    assert np.allclose(simhash.candidates_by_radius(counts, 2), [0, *apart])


def test_simhash_awkward(spark, awkward):
    assert {(r.doc_id, r.group_id) for r in simhash.near_duplicates(awkward).collect()} == {(1, 1), (7, 1), (4, 4), (5, 4)}
    kept = simhash.keep_one(awkward)
    assert kept.columns == awkward.columns
    assert sorted(str(r.doc_id) for r in kept.select("doc_id").collect()) == ["1", "1", "2", "3", "4", "6", "None", "None"]
    assert simhash.near_duplicates(awkward.limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    order = list(range(300))
    random.Random(3).shuffle(order)
    edges = spark.createDataFrame(list(zip(order, order[1:])), "a long, b long")
    assert {(r.doc_id, r.group_id) for r in simhash.components(edges).collect()} == {(k, 0) for k in range(1, 300)}


# 2

def test_mixing_equals_sql(spark):
    assert oracle.compare(queries.op2_mixing(spark, MIDDLE), oracle.connect(MIDDLE), mixing.ORACLE)[0]


def test_mixing_meets_targets(spark):
    rows = documents(spark, [(k, "x" * 20, "ab"[k % 10 == 0]) for k in range(4000)])
    out = mixing.mixed(rows, weights={"a": 1, "b": 3})
    n = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    assert abs(n["b"] / (n["a"] + n["b"]) - 0.75) < 0.03
    keys = [r.shuffle_key for r in out.collect()]
    assert keys == sorted(keys)
    assert mixing.poisson_steps(2.0)[-1] == pytest.approx(1)


def test_mixing_awkward(spark, awkward):
    out = mixing.mixed(awkward)
    assert set(out.columns) == set(awkward.columns) and out.count() > 0
    assert {r.source for r in out.select("source").collect()} <= {"s", None}
    assert mixing.mixed(awkward.limit(0)).count() == 0
    assert mixing.mixed(awkward, weights={}).count() == 0


# 3

def exact_cover(texts, width=substrings.WORDS):
    """Positions of words that lie in a run which occurs in a document of lesser number.

    A run in which no eight words have three different ones among them is no passage.
    """
    first, cover = {}, {}
    for d in sorted(texts):
        w = words_of(texts[d])
        held = set()
        rich = np.cumsum([0, *[len(set(w[k : k + substrings.GRAM])) > 2 for k in range(len(w))]])
        for k in range(len(w) - width + 1):
            run = tuple(w[k : k + width])
            if rich[k] < rich[k + width - substrings.GRAM + 1] and first.setdefault(run, d) < d:
                held.update(range(k, k + width))
        cover[d] = held
    return cover


def test_substrings_cover_all_exact_repeats(spark):
    texts = {r.doc_id: r.text for r in table(spark, "documents", MIDDLE).collect()}
    rng = random.Random(5)
    vocabulary = [f"v{k}" for k in range(900)]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passages = [some(n) for n in (50, 51, 60, 75, 120, 400)]
    for k in range(60):
        body = some(rng.randrange(30, 200))
        p = passages[k % len(passages)]
        at = rng.randrange(len(body))
        texts[10_000 + k] = " ".join(body[:at] + p + body[at:])
    expected = exact_cover(texts)
    got = collections.defaultdict(set)
    for r in substrings.repeated_passages(documents(spark, texts.items())).collect():
        assert r.source_doc_id < r.doc_id and r.end - r.start >= substrings.WORDS
        got[r.doc_id].update(range(r.start, r.end))
    assert sum(map(len, expected.values())) > 3000
    for d, held in expected.items():
        assert held <= got[d]
    extra = {d for d in got if got[d] and not expected[d]}
    assert not {d for d in extra if d >= 10_000}


def test_substrings_leave_runs_of_one_or_two_words(spark):
    rng = random.Random(6)
    some = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    passage = some(60)
    rows = [(1, f"{some(40)} {'the ' * 90}{some(40)}"), (2, f"{some(30)} {'the ' * 70}{some(20)}"), (3, f"{'in the ' * 60}{some(9)}"), (4, f"{some(20)} {'in the ' * 40}"), (5, f"{'the ' * 60}{passage}"), (6, f"{passage} {'the ' * 60}")]
    texts = dict(rows)
    got = {(r.doc_id, r.start, r.end) for r in substrings.repeated_passages(documents(spark, rows)).collect()}
    assert got == {(6, 0, 60)}
    assert {d for d, held in exact_cover(texts).items() if held} == {6}


def test_substrings_near_repeats(spark):
    rng = random.Random(9)
    some = lambda n: [f"q{rng.randrange(3000)}" for _ in range(n)]
    rows, planted = [], 0
    for k in range(0, 80, 2):
        p = some(150)
        changed = list(p)
        for at in range(40, 150, 40):
            changed[at] = "changed"
        rows += [(k, " ".join(some(60) + p + some(40))), (k + 1, " ".join(some(30) + changed + some(50)))]
        planted += 1
    found = {r.doc_id for r in substrings.repeated_passages(documents(spark, rows)).collect()}
    assert all(d % 2 for d in found) and len(found) >= 0.9 * planted


def agreeing(a, b, words=substrings.WORDS, agree=substrings.AGREE):
    """Whether a run of ``words`` words, place by place, has ``agree`` of them equal and its first and last."""
    equal = [x == y for x, y in zip(a, b)]
    return any(equal[k] and equal[k + words - 1] and sum(equal[k : k + words]) >= agree * words for k in range(len(equal) - words + 1))


def edited_passages(seed, each=60):
    """{setting: [(doc_id, text, doc_id, edited text)]}: passages of 50 to 100 words, edited as far as ``agree`` allows."""
    rng = random.Random(seed)
    some = lambda n: [f"q{rng.randrange(3000)}" for _ in range(n)]
    share = lambda n, part: rng.sample(range(n), round(n * part))
    settings = {f"{n} words, {part:.0%}": (n, lambda n, part=part: share(n, part)) for n in (50, 60, 75, 100) for part in (0.02, 0.05, 0.08, 0.1)}
    settings |= {f"{n} words, each {k}th": (n, lambda n, k=k: range(rng.randrange(k), n, k)) for n in (60, 80, 100) for k in (10, 15, 20)}
    out, doc = {}, 0
    for name, (n, places) in settings.items():
        out[name] = []
        while len(out[name]) < each:
            passage = some(n)
            edited = list(passage)
            for k in places(n):
                edited[k] = f"edit{rng.randrange(3000)}"
            if agreeing(passage, edited):
                out[name].append((doc, " ".join(some(60) + passage + some(40)), doc + 1, " ".join(some(30) + edited + some(50))))
                doc += 2
    return out


def test_substrings_near_repeats_equal_brute_force(spark):
    cases = edited_passages(4)
    rows = [row for case in cases.values() for d, text, e, edited in case for row in ((d, text), (e, edited))]
    found = {(r.doc_id, r.source_doc_id) for r in substrings.repeated_passages(documents(spark, rows)).collect()}
    recall = {name: sum((e, d) in found for d, _, e, _ in case) / len(case) for name, case in cases.items()}
    assert set(recall.values()) == {1.0}, recall
    assert found <= {(e, d) for case in cases.values() for d, _, e, _ in case}


def test_near_repeats_go_on_to_further_rows():
    """A group in which only rows 2 and 3 agree, and one that is a chain: each agrees with the row before it only."""
    rng = np.random.default_rng(2)
    side = substrings.WORDS - substrings.SEED
    near = rng.integers(0, 1 << 16, (6, 2 * side + substrings.SEED)).astype(np.uint16)
    near[:, side : side + substrings.SEED] = 7
    near[2] = near[1]
    near[2, 3] += 1
    for k in (4, 5):
        near[k] = near[k - 1]
        near[k, 5 * (k - 4) : side : 10] += 1
        near[k, side + substrings.SEED + 5 * (k - 4) :: 10] += 1
    full = np.full(6, side)
    row, low, high, source = substrings.near_repeats(np.array([1, 1, 1, 3, 3, 3]), np.arange(10, 16), full, full, near, substrings.WORDS, substrings.SEED, substrings.AGREE)
    assert sorted(zip(row.tolist(), source.tolist())) == [(2, 11), (4, 13), (5, 14)]


def test_substrings_spans_of_far_ids_stay_apart():
    for far in (9000, 9_000_000, 1 << 25, (1 << 62) + 1):
        spans = np.array([(10, 0, 50, 3), (far, 100, 160, 5), (far, 150, 220, 4), (far, 900, 960, 7)], dtype=np.int64)
        assert [c.tolist() for c in substrings.islands(spans)] == [[10, far, far], [0, 100, 900], [50, 220, 960], [3, 4, 7]]


def test_substrings_of_far_ids(spark):
    rng = random.Random(3)
    some = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    a, b, c = some(60), some(60), some(60)
    far = 1 << 25
    rows = [(1, " ".join(a + some(20) + b)), (2, " ".join(c)), (10, " ".join(c)), (far, " ".join(some(100) + a + some(700) + b))]
    found = {(r.doc_id, r.start, r.end, r.source_doc_id) for r in substrings.repeated_passages(documents(spark, rows)).collect()}
    assert found == {(10, 0, 60, 2), (far, 100, 160, 1), (far, 860, 920, 1)}


def test_substrings_cut(spark):
    p = " ".join(f"p{k}" for k in range(70))
    rows = [(1, f"Before it. {p} After."), (2, f"Élan here: {p}, and an end."), (3, p), (4, "Nothing of that.")]
    out = {r.doc_id: r for r in substrings.without_passages(documents(spark, rows)).collect()}
    assert sorted(out) == [1, 2, 4]
    assert out[1].text == rows[0][1] and out[4].text == rows[3][1]
    assert out[2].text.startswith("Élan here:") and out[2].text.endswith("and an end.") and "p5" not in out[2].text
    assert out[2].n_chars == len(out[2].text)


def test_substrings_awkward(spark, awkward):
    found = substrings.repeated_passages(awkward).collect()
    assert {(r.doc_id, r.source_doc_id) for r in found} == {(5, 4)}
    assert [(r.start, r.end) for r in found] == [(0, 60_000)]
    kept = substrings.without_passages(awkward)
    assert kept.columns == awkward.columns
    assert sorted(str(r.doc_id) for r in kept.select("doc_id").collect()) == ["1", "1", "2", "3", "4", "6", "7", "None", "None"]
    assert substrings.without_passages(awkward.limit(0)).count() == 0


# 4 and 6

@pytest.mark.parametrize("label, score", [("quality", quality.scored), ("toxic", toxicity.scored)])
def test_classifiers_on_held_out_labels(spark, label, score):
    folder = "/root/testdata/sf0.1"
    known = table(spark, "labels", folder)
    held = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    seen, kept = known.where(~held), known.where(held)
    docs = table(spark, "documents", folder).join(known.select("doc_id"), "doc_id", "left_semi")
    column = "keep" if label == "quality" else "is_toxic"
    out = score(docs, seen).join(kept.select("doc_id", F.col(label).alias("true")), "doc_id").select(F.col(column).cast("int").alias("said"), "true").toPandas()
    right = [(out.said[out.true == k] == k).mean() for k in (0, 1)]
    assert right[0] >= 0.85 and right[1] >= 0.85, right
    if label == "toxic":
        assert right[0] >= 0.98


def test_classifiers_awkward(spark, awkward, docs, labels):
    for score, column, flag in ((quality.scored, "quality", "keep"), (toxicity.scored, "toxicity", "is_toxic")):
        known = spark.createDataFrame([(1, 1, 0), (4, 0, 1), (None, 1, 1), (3, None, None), (1, 1, 0)], "doc_id long, quality int, toxic int")
        out = score(awkward, known).collect()
        assert len(out) == awkward.count()
        for r in out:
            if r.doc_id in (2, 3):
                assert r[column] is None and r[flag] is False
        none = score(awkward, known.limit(0)).collect()
        assert len(none) == len(out) and all(r[column] is None and not r[flag] for r in none)
        assert score(awkward.limit(0), known).count() == 0
    assert toxicity.without_toxic(awkward, labels.limit(0)).count() == awkward.count()


def test_toxicity_features_match_plain_grams(monkeypatch):
    texts = ["abcabc", "", None, "Äbc", "ÄÄÄÄbcßß 漢字かな交じり文😀 x", "long " * 300 + "Ä tail"]
    plain = {i: len({t.lower()[k : k + n] for n in toxicity.SIZES for k in range(len(t) - n + 1)}) for i, t in enumerate(texts) if t and len(t) >= min(toxicity.SIZES)}
    for piece in (toxicity.PIECE, 100):  # the last text whole, and in pieces
        monkeypatch.setattr(toxicity, "PIECE", piece)
        assert {row: len(x) for row, x in toxicity.text_features(pa.array(texts), bits=20)} == plain
        assert {row: len(x) for row, x in toxicity.text_features(pa.array(texts[5:]), bits=20)} == {0: plain[5]}


# 5

PAGE = "<html><head><title>T</title><style>a{}</style></head><body><nav><a href=1>Home</a> <a href=2>News</a></nav>" + "".join(f"<p>{'A long sentence of the article, with its many words. ' * 3}{k}</p>" for k in range(8)) + "<script>var x=1</script><footer><a href=3>About</a></footer></body></html>"


def test_html_keeps_the_article():
    text, lines, kept = html.content(PAGE)
    assert "A long sentence" in text and "var x" not in text and "a{}" not in text
    assert "Home" not in text and "About" not in text
    assert kept == 8 < lines


def test_html_of_unclosed_elements():
    assert html.content("<html><head><p>hello world text")[0] == "hello world text"
    assert html.content("<head><title>T<div>hello</div>")[0] == "hello"
    shown = [x for x, _ in html.lines_of("<body><p>before</p><noscript><p>inside</p><p>after it all</p></body>") if x]
    assert shown == ["before", "inside", "after it all"]
    assert html.content("<body><p>shown</p><template><p>hidden</p></template><p>shown too</p></body>")[0] == "shown\nshown too"
    assert html.content("<body><p>shown</p><noscript>hidden</noscript></body>")[0] == "shown"


def test_html_one_long_line_leaves_the_others():
    lines = [f"<p>{'word ' * 30}{k}</p>" for k in range(60)]
    lines.insert(20, f"<p>{'long ' * 4000}</p>")
    text, _, kept = html.content("<body>" + "".join(lines) + "</body>")
    assert kept == 61


def test_html_keeps_the_text_of_articles(spark):
    """Of the characters inside the article element of the supplied pages at least 0.95 are kept, and of most others none."""
    inside = outside = kept = lost = 0
    for r in table(spark, "pages", MIDDLE).collect():
        found = re.search(r"(?is)<article[^>]*>(.*?)</article>", r.html or "")
        if found:
            article = {x for x, _ in html.lines_of(found[1]) if x}
            chosen = set(html.content(r.html)[0].split("\n"))
            for x, _ in html.lines_of(r.html):
                if x in article:
                    inside, kept = inside + len(x), kept + len(x) * (x in chosen)
                elif x:
                    outside, lost = outside + len(x), lost + len(x) * (x in chosen)
    assert inside and kept >= 0.95 * inside and lost <= 0.4 * outside


def test_html_feed_in_pieces_changes_nothing(spark, monkeypatch):
    pages = [r.html for r in table(spark, "pages").collect()][:40]
    whole = [html.content(p) for p in pages]
    monkeypatch.setattr(html, "FEED", 97)
    assert [html.content(p) for p in pages] == whole


def test_html_smoothing_is_a_weighted_mean():
    x = np.random.default_rng(2).random(30)
    w = lambda i: np.exp(-0.5 * ((np.arange(30) - i) / 1.5) ** 2) * (abs(np.arange(30) - i) <= 5)
    assert np.allclose(html.smoothed(x, 1.5), [(w(i) * x).sum() / w(i).sum() for i in range(30)])


def test_html_awkward(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>x"), (4, "u", "<" * 50_000), (5, "u", "plain"), (6, "u", "<div>" * 30_000 + "deep"), (7, "u", "<script>never closed"), (1, "u", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("t")).withColumn("c", F.lit(1))
    out = {r.page_id: r for r in html.extracted(pages).collect()}
    assert out[1].text is None and out[2].text == "" and out[5].text == "plain" and out[7].text == ""
    assert "deep" in out[6].text
    assert html.extracted(pages.limit(0)).count() == 0


# 7

def test_topk_equals_sql(spark):
    assert oracle.compare(queries.op7_topk(spark, MIDDLE), oracle.connect(MIDDLE), topk.ORACLE)[0]


def test_topk_awkward(spark, awkward):
    asked = spark.createDataFrame([(1, "two ONE"), (2, ""), (3, None), (None, "one"), (1, "two ONE"), (5, "unknownword")], "item_id long, text string")
    out = [(r.item_id, r["rank"], r.doc_id) for r in topk.top_documents(awkward, asked).collect()]
    assert sorted(out) == [(1, 1, 1), (1, 2, 7)]
    assert topk.top_documents(awkward.limit(0), asked).count() == 0
    assert topk.top_documents(awkward, asked.limit(0)).count() == 0


def test_topk_rows_of_one_item_are_one_query(spark):
    docs = documents(spark, [(1, "alpha here"), (2, "gamma there"), (3, "beta")])
    asked = spark.createDataFrame([(1, "alpha"), (1, "gamma"), (2, "beta")], "item_id long, text string")
    assert {(r.item_id, r.doc_id) for r in topk.top_documents(docs, asked).collect()} == {(1, 1), (1, 2), (2, 3)}


def test_topk_query_groups_change_nothing(spark, docs):
    asked = table(spark, "benchmark")
    one = {tuple(r) for r in topk.top_documents(docs, asked).collect()}
    assert {tuple(r) for r in topk.top_documents(docs, asked, group_bytes=4000).collect()} == one


# 8

def best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms[rooms.index(min(fits))] -= n
        else:
            rooms.append(capacity - n)
    return len(rooms)


def test_packing_is_best_fit():
    rng = random.Random(4)
    for capacity in (10, 37, 100):
        for _ in range(20):
            lengths = [min(capacity, 1 + int(rng.expovariate(3 / capacity))) for _ in range(200)]
            rows = packing.plan(dict(collections.Counter(lengths)), capacity)
            used = collections.defaultdict(list)
            seen = collections.Counter()
            want = collections.Counter(lengths)
            for length, rank, first, each, position in rows:
                after = min((r[1] for r in rows if r[0] == length and r[1] > rank), default=want[length])
                for k in range(after - rank):
                    used[first + k // each].append((position + k % each * length, length))
                    seen[length] += 1
            assert seen == want and len(used) == best_fit(lengths, capacity)
            for parts in used.values():
                parts.sort()
                assert all(a + n <= b for (a, n), (b, _) in zip(parts, parts[1:])) and parts[-1][0] + parts[-1][1] <= capacity


def test_packing_equals_sql(spark):
    assert oracle.compare(queries.op8_packing(spark, MIDDLE), oracle.connect(MIDDLE), packing.ORACLE)[0]


def test_packing_places_every_token_once(spark, docs):
    out = packing.packed(docs, capacity=256).toPandas()
    sizes = {r.doc_id: len(r.text.split()) for r in docs.collect()}
    assert out.groupby("doc_id").length.sum().to_dict() == {d: n for d, n in sizes.items() if n}
    for _, g in out.groupby("sequence"):
        g = g.sort_values("position")
        assert g.position.iloc[0] == 0 and (g.position + g.length).iloc[:-1].tolist() == g.position.iloc[1:].tolist()
        assert (g.position + g.length).iloc[-1] <= 256
    pieces = [min(256, n - s) for n in sizes.values() for s in range(0, n, 256)]
    assert out.sequence.nunique() == best_fit(pieces, 256)


def test_packing_awkward(spark, awkward):
    out = packing.packed(awkward).collect()
    count = collections.Counter(r.doc_id for r in out)
    assert count[1] == 2 and count[None] == 1 and count[4] == -(-60_000 // packing.CAPACITY) and not count[2] and not count[3] and not count[6]
    assert packing.packed(awkward.limit(0)).count() == 0


# 9

def test_covertree_pairs_equal_brute_force(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 24))
    x = np.concatenate([centres[k % 40] + rng.normal(size=24) * rng.choice([0.01, 0.15, 0.4]) for k in range(900)]).reshape(900, 24).astype(np.float32)
    x[100:110] = x[100]
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")
    u = (x / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)).astype(np.float32)
    s = u.astype(np.float64) @ u.T.astype(np.float64)
    sure = {(i, j) for i, j in zip(*np.nonzero(np.triu(s >= 0.95 + 1e-6, 1)))}
    maybe = {(i, j) for i, j in zip(*np.nonzero(np.triu(s >= 0.95 - 1e-6, 1)))}
    for cell in (4096, 50):
        found = [(r.vec_id_a, r.vec_id_b) for r in covertree.near_pairs(rows, cell=cell).collect()]
        assert len(found) == len(set(found)) and sure <= set(found) <= maybe and len(found) > 500


def classes_by_brute_force(ids, x, cosine=0.95):
    """{vec_id: (class, links)} and the pairs too close to the threshold to call."""
    u = x / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    s = u @ u.T
    assert not (abs(s - cosine) < 1e-6).any()
    near = (s >= cosine) & ~np.eye(len(x), dtype=bool)
    group = dict(zip(ids, ids))
    find = lambda k: k if group[k] == k else find(group[k])
    for i, j in zip(*np.nonzero(near)):
        a, b = find(ids[i]), find(ids[j])
        group[max(a, b)] = min(a, b)
    return {k: (find(k), int(n)) for k, n in zip(ids, near.sum(axis=1))}


def test_covertree_classes_equal_brute_force(spark):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(30, 16))
    x = np.concatenate([centres[k % 30] + rng.normal(size=16) * rng.choice([0.005, 0.1, 0.4]) for k in range(800)]).reshape(800, 16).astype(np.float32)
    x[200:260] = x[200]
    x[300] = 2 * x[200]
    ids = sorted({int(k) for k in rng.integers(0, 1 << 40, 900)})[:800]
    rng.shuffle(ids)
    expected = classes_by_brute_force(ids, x)
    odd = np.eye(5, dtype=np.float32)[[0, 0, 1]]  # of another dimension
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in zip(ids + [-1, -2, -3], [*x, *odd])], "vec_id long, embedding array<float>")
    expected |= {-1: (-2, 1), -2: (-2, 1), -3: (-3, 0)}
    for cell, pivots in ((4096, 4096), (60, 4096), (40, 3)):  # one cell, one level of pivots, several levels
        found = covertree.near_duplicates(rows, cell=cell, pivots=pivots).collect()
        assert len(found) == len(expected) and {r.vec_id: (r.class_id, r.links) for r in found} == expected
    assert sum(n for _, n in expected.values()) > 5000


def test_covertree_far_vectors_visit_each_bundle_once(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1500, 48))
    x[1000:] = x[:500] + rng.normal(size=(500, 48)) * 0.12
    x = x.astype(np.float32)
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")
    units = covertree._units(rows).withColumn("n", F.lit(1).cast("long"))
    reach = float(np.sqrt(2 - 2 * covertree.COSINE))
    assert covertree._cells(units, 20, 4096, reach).count() <= 3 * len(x)  # no pivot's radius leaves any out; a copy for each of 75 cells would make 38
    expected = classes_by_brute_force(list(range(len(x))), x)
    assert {r.vec_id: (r.class_id, r.links) for r in covertree.near_duplicates(rows, cell=20).collect()} == expected and sum(n for _, n in expected.values()) > 500


def test_covertree_runs_of_visitors_are_bounded(spark, monkeypatch):
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(size=(900, 48)), np.full((300, 48), 3) + rng.normal(size=(300, 48)) * 0.5]).astype(np.float32)
    units = covertree._units(spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")).withColumn("n", F.lit(1).cast("long"))
    monkeypatch.setattr(covertree, "RUN", 64)
    for most in (60, 200):
        placed = covertree._cells(units, 30, 4096, 0.4, most)
        batches = [placed.where(F.spark_partition_id() == k).toArrow().to_batches() for k in range(placed.rdd.getNumPartitions())]
        runs = [(p, ids) for b in batches for p, ids, _, _ in covertree._runs(iter(b))]
        own = [ids for p, ids in runs if not p & 1]
        assert sorted(np.concatenate(own)) == list(range(1200)) and max(map(len, own)) <= 2 * most
        assert max(len(ids) for p, ids in runs if p & 1) == 64 and len({p for p, _ in runs if not p & 1}) == len(own)


def test_covertree_bundles(spark):
    order, first, dealt = covertree._bundled(np.array([5, 40, 7, 300, 6, 60]), 50)
    assert order.tolist() == [0, 1, 2, 4, 3, 5] and dealt.tolist() == [1, 1, 1, 6, 1, 1]
    assert first.tolist() == [0, 0, 1, 2, 1, 8]
    one = np.array([[1.0] + [0.0] * 39]) + np.random.default_rng(3).normal(size=(500, 40)) * 0.02  # pivots tell none of them apart
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(one.astype(np.float32))], "vec_id long, embedding array<float>")
    for cell in (10, 600):
        assert {(r.class_id, r.links) for r in covertree.near_duplicates(rows, cell=cell).collect()} == {(0, 499)}


def test_covertree_equals_sql(spark):
    assert oracle.compare(queries.op9_covertree(spark, MIDDLE), oracle.connect(MIDDLE), covertree.ORACLE)[0]


def test_covertree_supplied_vectors(spark):
    rows = table(spark, "embeddings", MIDDLE).toPandas()
    x = np.stack(rows.embedding).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    s = np.triu(x @ x.T, 1)
    at = float(np.sort(s[s > 0])[-200])
    found = {(r.vec_id_a, r.vec_id_b) for r in covertree.near_pairs(table(spark, "embeddings", MIDDLE), cosine=at - 1e-5, cell=64).collect()}
    ids = rows.vec_id.to_numpy()
    assert found >= {(min(ids[i], ids[j]), max(ids[i], ids[j])) for i, j in zip(*np.nonzero(s > at))}


def test_covertree_awkward(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (None, [1.0, 0.0]), (5, [nan, 1.0]), (6, [1.0]), (7, [None, 1.0]), (8, [1e-20, 0.0]), (9, [])]
    found = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("cell", F.lit(1)).withColumn("own", F.lit(1))
    assert {(r.vec_id_a, r.vec_id_b) for r in covertree.near_pairs(found).collect()} == {(1, 2), (1, 8), (2, 8)}
    assert covertree.near_pairs(found.limit(0)).count() == 0
    same = spark.range(300).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0), F.lit(2.0)).cast("array<float>").alias("embedding"))
    assert covertree.near_pairs(same).count() == 300 * 299 // 2
    assert {(r.class_id, r.links) for r in covertree.near_duplicates(same).collect()} == {(0, 299)}
    out = {r.vec_id: (r.class_id, r.links) for r in covertree.near_duplicates(found).collect()}
    assert out == {1: (1, 2), 2: (1, 2), 6: (6, 0), 8: (1, 2)}
    assert covertree.near_duplicates(found.limit(0)).count() == 0


# 10

def restored(rows):
    parts = collections.defaultdict(list)
    for r in rows:
        ids = bitplanes.decode(r.n_ids, r.id_bytes, r.planes, r.payload)
        for d in r.documents:
            parts[d["doc_id"]].append((d["from"], ids[d["start"] : d["start"] + d["length"]]))
    return {d: np.concatenate([x for _, x in sorted(p, key=lambda t: t[0])]) for d, p in parts.items()}


@pytest.mark.parametrize("bits", [True, False])
def test_bitplanes_round_trip(spark, docs, bits):
    encoder = bitplanes.load(bitplanes.TOKENIZER)
    rows = bitplanes.blocks(docs, block=5000, bits=bits).collect()
    assert len({(r.shard, r.block) for r in rows}) == len(rows)
    got = restored(rows)
    for r in docs.collect():
        assert encoder.decode(got[r.doc_id].tolist()) == r.text


def test_bitplanes_planes():
    rng = np.random.default_rng(8)
    for kind in ("<u2", "<u4"):
        for n in (0, 1, 7, 8, 1000):
            ids = rng.integers(0, np.iinfo(kind).max, n).astype(kind)
            for bits in (True, False):
                assert np.array_equal(bitplanes.from_planes(bitplanes.to_planes(ids, bits), n, ids.dtype.itemsize), ids)


def test_bitplanes_awkward(spark, awkward):
    rows = bitplanes.blocks(awkward.coalesce(1), block=1000).collect()
    entries = collections.Counter(d["doc_id"] for r in rows for d in r.documents if d["from"] == 0)
    assert entries == collections.Counter({1: 2, None: 2, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1, 7: 1})
    assert bitplanes.blocks(awkward.limit(0)).count() == 0


# shared

def test_sizes_are_read_in_their_units():
    from gleaner.llm.shared import size_of

    assert [size_of(x) for x in ("4m", "64KB", "1048576", "1g", "-1", "8388608b", " 2mb ")] == [4 << 20, 64 << 10, 1 << 20, 1 << 30, -1, 8 << 20, 2 << 20]


# pipeline

def test_pipeline_stages(spark, tmp_path):
    docs, before = table(spark, "documents", MIDDLE), None
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before, docs = docs, stage(spark, docs, MIDDLE)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == before.columns, name
        docs.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        assert ids and ids <= {r.doc_id for r in before.select("doc_id").collect()}
        if name == "toxicity":
            bad = {r.doc_id for r in table(spark, "labels", MIDDLE).where("toxic = 1").collect()}
            assert len(ids & bad) <= 0.05 * len(bad)
        if name.startswith("simhash"):
            assert simhash.near_duplicates(docs).count() == 0
        if name.startswith("substring"):
            left = exact_cover({r.doc_id: r.text for r in docs.collect()})
            assert not any(left.values())
        if name == "packing":
            tokens = before.where("text IS NOT NULL").select(F.sum(F.regexp_count("text", F.lit(r"\S+")))).first()[0]
            assert docs.agg(F.sum("length")).first()[0] == tokens
    assert corpus_pipeline.run(spark, MIDDLE).count() == docs.count()


def test_pipeline_on_an_awkward_table(spark, awkward, tmp_path):
    docs = awkward
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, SMALL)
        docs.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    assert docs.columns == ["sequence", "position", "doc_id", "start", "length"]
