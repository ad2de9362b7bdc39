"""Hard negatives, ranked search and main text against brute force and odd input."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import oracle
import pytest
from pyspark.sql import functions as F

from incidentia.llm import hard_negatives, lexical, main_text
from incidentia.llm.oracles import ORACLES
from incidentia.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_lexical_search", "op13_main_text"])
def test_query_equals_sql(spark, name):
    with oracle.connect(SMALL) as connection:
        assert oracle.compare(QUERIES[name](spark, SMALL), connection, ORACLES[name]) == ""


# ---- Hard negatives ---------------------------------------------------------


def plain_mining(rows, anchors, k=5, most=10):
    """The contract, row by row."""
    used = set()
    for number, vector, label in rows:
        if None in (number, vector, label) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        used.add((number, label, tuple(math.floor(256 * x) for x in vector)))
    out = []
    for a, label, vector in used:
        if not anchors(a):
            continue
        scored = [
            (-sum(x * y for x, y in zip(vector, other)), n, kind)
            for n, kind, other in used
            if n != a and len(other) == len(vector)
        ]
        for s, p, _ in sorted(x for x in scored if x[2] == label)[:k]:
            near = sorted(x for x in scored if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s)
            out += [(a, p, i, n, -s, -t) for i, (t, n, _) in enumerate(near[:most], 1)]
    return sorted(out)


def mined(spark, rows, schema="vec_id long, embedding array<double>, label int", **options):
    found = hard_negatives.mine(spark.createDataFrame(rows, schema), F.col("vec_id") % 3 == 0, **options)
    return sorted(map(tuple, found.collect()))


def test_hard_negatives_against_brute_force(spark):
    draw = random.Random(3)
    centres = [[draw.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = [
        (i, [c + draw.gauss(0, 0.4) for c in centres[i % 5]], (i + draw.randrange(2)) % 4)
        for i in range(150)
    ]
    rows += [(1000 + i, rows[0][1], 1) for i in range(30)]  # one common vector: ties
    rows += [(2000, [0.0] * 6, 2), (2001, [1.0, 2.0], 2), (2004, [1.0, 2.1], 2), (2005, [1.0, 1.9], 3)]
    rows += [rows[5], (rows[6][0], rows[7][1], 3)]  # a repeated row, one id with two vectors
    rows += [
        (None, [1.0] * 6, 1), (3000, None, 1), (3003, [1.0] * 5 + [None], 1), (3006, [float("nan")] * 6, 1),
        (3009, [float("inf")] * 6, 1), (3012, [1.0] * 6, None), (3015, [], 1), (3018, [], 2),
    ]
    want = plain_mining(rows, lambda n: n % 3 == 0)
    assert len(want) > 500
    assert mined(spark, rows) == want
    assert mined(spark, rows, block_rows=16) == want


def test_hard_negatives_of_large_numbers(spark):
    rows = [(i, [1.5e6 * (i % 7) + i, 1e6, float(i)], i % 3) for i in range(40)]
    want = plain_mining(rows, lambda n: n % 3 == 0)
    assert 2**53 < max(r[5] for r in want) < 2**63
    assert mined(spark, rows, block_rows=8) == want


def test_hard_negatives_of_nothing_and_with_clashing_names(spark):
    assert mined(spark, []) == []
    rows = [(i, [float(i), 1.0], i % 2) for i in range(12)]
    wider = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns(
        {n: F.lit("x") for n in ("id", "vector", "asks", "key", "score", "rank", "windows", "block")}
    )
    found = hard_negatives.mine(wider, F.col("vec_id") % 3 == 0)
    assert sorted(map(tuple, found.collect())) == plain_mining(rows, lambda n: n % 3 == 0)


def test_cover_tree_covers(spark):
    draw = np.random.default_rng(1)
    vectors = np.unique(draw.integers(-50, 50, (300, 3)), axis=0)
    tree = hard_negatives.CoverTree(vectors)

    def below(node):
        if tree.first[node] == tree.last[node]:
            return [tree.point[node]]
        return [p for c in range(tree.first[node], tree.last[node]) for p in below(c)]

    assert sorted(below(0)) == list(range(len(vectors)))
    for node, (point, radius) in enumerate(zip(tree.point, tree.radius)):
        apart = np.sqrt(((tree.lifted[below(node)] - tree.lifted[point]) ** 2).sum(axis=1))
        assert apart.max() <= radius + 1e-9
    # A search opens few of the nodes.
    near = np.array([[1, 1, 1]]) * np.arange(1, 2000)[:, None]
    assert len(hard_negatives.CoverTree(near).point) < 2 * len(near) + 1


# ---- Ranked search ----------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_ranking(docs, items, k=10):
    counted = [(d, Counter(plain_terms(t))) for d, t in docs]
    sizes = [sum(c.values()) for _, c in counted]
    documents, tokens = sum(n > 0 for n in sizes), sum(sizes)
    held = Counter(t for _, c in counted for t in c)
    weight = {t: math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for t, n in held.items()}
    out = []
    for item, text in set(items):
        scored = []
        for (d, c), n in zip(counted, sizes):
            m = 25 + 75 * n * documents // tokens if tokens else 0
            score = sum(
                weight[t] * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in plain_terms(text) if c[t]
            )
            if score > 0:
                scored.append((-score, d is None, d))
        best = sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k]
        out += [(item, i, d, -s) for i, (s, _, d) in enumerate(best, 1)]
    return sorted(out, key=str)


def ranked(spark, docs, items):
    found = lexical.rank(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    return sorted(map(tuple, found.collect()), key=str)


def random_texts(count, seed, longest=60):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(200)] + ["Été", "日本", "A1", "ÀB", "x_y"]
    pick = [1 / (i + 1) for i in range(len(words))]
    return [
        draw.choice([" ", ", ", "\x00-"]).join(draw.choices(words, pick, k=draw.randrange(longest)))
        for _ in range(count)
    ]


def test_ranking_against_brute_force(spark):
    docs = list(enumerate(random_texts(600, 1)))
    docs += [(None, docs[7][1]), (None, None), (7, docs[7][1]), (700, ""), (701, "only ONCE here")]
    docs += [(800 + i, docs[9][1]) for i in range(40)]  # ties beyond k
    docs += [(900, " ".join(random_texts(3000, 5)))]
    items = list(enumerate(random_texts(30, 2, 30)))
    items += [(3, docs[9][1]), (3, docs[9][1]), (None, "once w3"), (50, None), (51, "nowhere"), (52, "W1 w1 w1 w5")]
    items += [(53, " ".join(random_texts(50, 6)))]
    assert ranked(spark, docs, items) == plain_ranking(docs, items)


@pytest.mark.parametrize("docs, items", [([], [(1, "a")]), ([(1, "a")], []), ([(1, None)], [(1, "a")])])
def test_ranking_of_nothing(spark, docs, items):
    assert ranked(spark, docs, items) == []


def test_ranking_with_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b", 5), (2, "a", 6)], "doc_id long, text string, score int")
    items = spark.createDataFrame([(4, "A", 1, 2)], "item_id long, text string, item_no int, rank int")
    docs = docs.withColumns({n: F.lit(1) for n in ("ids", "terms", "item_no", "lengths", "block")})
    found = [tuple(r) for r in lexical.rank(docs, items).collect()]
    assert found == plain_ranking([(1, "a b"), (2, "a")], [(4, "A")])


def test_index_without_a_list_of_terms(spark):
    docs = spark.createDataFrame(list(enumerate(random_texts(50, 8))), "doc_id long, text string")
    all_terms = lexical.index(docs, "doc_id", "text", None).agg(F.sum(F.size("terms"))).first()[0]
    few = lexical.index(docs, "doc_id", "text", frozenset([b"w1"])).agg(F.sum(F.size("terms"))).first()[0]
    assert few <= 8 < all_terms


@pytest.mark.parametrize("seed", range(20))
def test_best_positions_stop_early_and_right(seed):
    draw = np.random.default_rng(seed)
    docs, many, k = 3000, 1 + seed % 6, 10
    ids = draw.permutation(docs).astype(np.int64)
    lists, total = [], np.zeros(docs, dtype=np.int64)
    for _ in range(many):
        held = draw.choice(docs, draw.integers(1, docs), replace=False)
        scores = np.floor(1000 / draw.integers(1, 200, len(held))).astype(np.int64)
        order = np.argsort(-scores, kind="stable")
        lists.append((held[order], scores[order]))
        total[held] += scores
    best = lexical.Best(k)
    looked = lexical.search(lists, ids, best)
    want = sorted((-int(s), int(i)) for s, i in zip(total, ids) if s > 0)[:k]
    assert sorted((-s, -d) for s, d in best.heap) == want
    if many == 1 and len(lists[0][0]) > 1000:
        assert looked < docs / 2


# ---- Main text --------------------------------------------------------------

LONG = "This paragraph has enough words to be taken for a part of the article by its length alone."


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        ("only text &amp; no\n tags", "only text & no tags"),
        ("<article><h1>A</h1><p>b <b>c</b>d&nbsp;e<br>f</p><p>g</article><p>h</p>", "A b cd e f g"),
        (f"<article><p>{LONG}<p>Of.<p><b>Yes.</article><div class='ad'>{LONG}</div>", f"{LONG} Of. Yes."),
        (f"<nav>{LONG}</nav><article>x</article><footer>{LONG}", "x"),
        (f"<nav>never closed {LONG}<article>x</article>", "x"),
        (f"<article>x<section class='comments'><article>{LONG}</article></section></article>", "x"),
        (f"<article>x</article><article class='comment'>{LONG}</article>", "x"),
        (f"<body class='has-sidebar'><div class='page with-menu'><div id='main-menu'><a href=a>{LONG}</a></div>"
         f"<main><p>{LONG}</p><p>Of.</p></main></div>", f"{LONG} Of."),
        (f"<div class='cookie-notice'>{LONG}</div><div>{LONG}</div><form>{LONG}</form>", LONG),
        (f"<script>var a='</p>'; if (a<b) {{}}</script><style>p{{}}</style><p>{LONG}</p><!-- {LONG} -->", LONG),
        ("<p>&#65;&eacute;&#x1F600;&amp;lt; &am", "Aé😀&lt; &am"),
        ("<div aria-hidden='true'>no</div><p hidden>no</p><p>yes</p>", "yes"),
        ("<p>a <i>b</p></i><div>c</i></div>", "a b c"),
        ("</div></p><p", ""),
        ("<article>" + "<div><p>Short.</p></div>" * 3 + f"<p>{LONG}</p></article>", f"Short. Short. Short. {LONG}"),
        ("<ul>" + "<li><a href=x>Link</a></li>" * 9 + f"</ul><div><p>{LONG}</p></div>", LONG),
    ],
)
def test_main_text(html, text):
    assert main_text.main_text(html) == text


def test_pages_pass_one_by_one(spark):
    long = "<article>" + "<p>word <b>x</b></p>" * 50_000 + "</article>"
    rows = [(1, "u", "<p>a</p>", "z"), (1, "u", "<p>a</p>", "z"), (None, None, None, None), (2, "v", long, "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    pages = pages.withColumn("n_chars", F.lit("clash"))
    found = main_text.extract(pages)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted(map(tuple, found.collect()), key=str)
    want = [(1, "u", "a", 1)] * 2 + [(2, "v", " ".join(["word x"] * 50_000), 349_999), (None, None, "", 0)]
    assert got == sorted(want, key=str)
    assert main_text.extract(pages.limit(0)).collect() == []


def test_odd_markup_takes_linear_time():
    for piece in ("<b>", "</b>", "<div>", "</div>", "<i></b>", "<nav>", "<div class=ad>", "<article>", "<", "&"):
        main_text.main_text("<div><i>" + piece * 30_000)
