"""Corpus operators against brute force, SQL, round trips and odd input."""

from __future__ import annotations

import collections
import itertools
import math
import random
import textwrap
import time
import zlib

import numpy as np
import oracle
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from incidentia.llm import (
    common,
    decontamination,
    licenses,
    line_dedup,
    neighbours,
    packing,
    pitman_yor,
    quality,
    simhash,
    token_shards,
    tokens,
    warc,
)
from incidentia.llm.oracles import ORACLES
from incidentia.llm.queries import QUERIES
from incidentia.session import scratch_path

SMALL = "/root/testdata/sf0.001"
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long, keys string, own_id int"


def prose(number: int, words: int = 120) -> str:
    draw = random.Random(number)
    out = []
    for i in range(words):
        word = "".join(draw.choice(["ba", "ke", "lo", "mi", "nu", "ra", "se", "ti"]) for _ in range(3))
        out.append(word + (draw.choice([".", ".\n"]) if i % 9 == 8 else ""))
    return " ".join(out).replace("\n ", "\n")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, clashing extra columns."""
    same = prose(1)
    rows = [
        (1, same), (2, same), (3, None), (4, ""), (None, same), (5, prose(5)), (5, prose(5)),
        (6, " \n \t"), (7, prose(7, 30_000)), (8, "Zürich ÉTÉ 日本 <|endoftext|> it's"), (None, None),
        (9, "\n".join([prose(9, 40)] * 3)),
    ]
    full = [(i, t, "en", "s", None if t is None else len(t), "k", 1) for i, t in rows]
    return spark.createDataFrame(full, DOCUMENT)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCUMENT)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


# ---- 1: line dedup --------------------------------------------------------------


def expected_line_dedup(rows):
    """The texts after removal, by plain dictionaries; each row is a document."""
    texts = [((i is None, i or 0, place), (t or "").encode()) for place, (i, t) in enumerate(rows)]
    holders = collections.defaultdict(list)
    for i, t in texts:
        for chunk in {t[a:b].strip() for a, b, counted in line_dedup.chunks(t) if counted}:
            holders[chunk].append(i)
    out = []
    for i, t in texts:
        seen, kept = set(), b""
        for a, b, counted in line_dedup.chunks(t):
            chunk = t[a:b].strip()
            if not (counted and (chunk in seen or min(holders[chunk]) < i)):
                kept += t[a:b]
            seen.add(chunk)
        out.append(kept.decode())
    return out


def test_line_dedup_equals_brute_force(spark, documents, odd):
    for docs in (documents, odd):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        found = line_dedup.remove_repeated(docs, length="n_chars")
        assert found.schema == docs.schema
        got = [(r.doc_id, r.text or "", r.n_chars) for r in found.collect()]
        want = [(i, t) for (i, _), t in zip(rows, expected_line_dedup(rows))]
        key = lambda r: (r[0] is None, r[0] or 0, r[1])
        assert sorted(((i, t) for i, t, _ in got), key=key) == sorted(want, key=key)
        assert all(n == len(t) for _, t, n in got if t)


def test_line_dedup_chunks_make_up_the_text_and_resist_shifts():
    text = prose(3, 400).encode()
    assert b"".join(text[a:b] for a, b, _ in line_dedup.chunks(text)) == text
    before = {text[a:b].strip() for a, b, _ in line_dedup.chunks(text)}
    moved = b"Another first line.\n" + text
    after = {moved[a:b].strip() for a, b, _ in line_dedup.chunks(moved)}
    assert len(before & after) >= len(before) - 2


def test_line_dedup_removes_a_shared_paragraph(spark):
    shared = prose(77, 60).replace("\n", " ")
    rows = [(i, f"{prose(100 + i, 30)}\n{shared}\n{prose(200 + i, 30)}") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.text for r in line_dedup.remove_repeated(docs).collect()}
    assert found[0] == rows[0][1]
    middle = " ".join(shared.split()[20:40])
    assert not any(middle in found[i] for i in range(1, 6))
    for i in range(1, 6):
        assert found[i].startswith(prose(100 + i, 30)[:80])


def sentences(number: int, count: int, words: int) -> list[str]:
    draw = random.Random(number)
    return [" ".join(f"w{draw.randrange(10**9)}" for _ in range(words)) + "." for _ in range(count)]


def test_line_dedup_removes_all_of_planted_passages(spark):
    """Paragraphs of 2 to 8 sentences, and runs of lines of one sentence each, between own text."""
    shared = [" ".join(sentences(i, 2 + i % 7, 10 + i % 23)) for i in range(70)]
    shared += ["\n".join(sentences(i, 2 + i % 5, 20 + i % 30)) for i in range(100, 170)]
    shared += ["\n\n".join(sentences(i, 5, 30)) for i in range(200, 210)]
    shared += ["\n".join(sentences(i, 6, 12)) for i in range(300, 310)]
    before = [[" ".join(sentences(1000 + i, 4, 15)), sentences(2000 + i, 1, 30)[0], "Own head"] for i in range(3)]
    after = [[" ".join(sentences(3000 + i, 4, 15)), sentences(4000 + i, 1, 30)[0], "Own foot"] for i in range(3)]
    rows, kept = [], {}
    for i, passage in enumerate(shared):
        for copy in range(3):
            number = 1000 * copy + i
            a = before[copy][(i + copy) % 3].replace("w", f"a{number}w")
            b = after[copy][(i + 2 * copy) % 3].replace("w", f"b{number}w")
            rows.append((number, f"{a}\n{passage}\n{b}"))
            kept[number] = f"{a}\n{passage}\n{b}" if copy == 0 else f"{a}\n{b}"
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.text for r in line_dedup.remove_repeated(docs).collect()}
    assert found == kept


def test_line_dedup_of_rows_without_id_and_with_one_id(spark):
    passage = " ".join(sentences(9, 5, 12))
    rows = [(None, f"{passage}\n{prose(i, 20)}") for i in range(4)] + [(None, passage)] * 4
    rows += [(3, passage + f"\nOwn end {i}") for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = [tuple(r) for r in line_dedup.remove_repeated(docs).collect()]
    assert len(found) == len(rows)
    assert [i for i, t in found if passage in t] == [3]
    assert sum("Own end" in t for _, t in found) == 2


def test_line_dedup_leaves_units_that_share_a_key(spark):
    rows = [(" same", 5), ("also", 5), ("same\n", 5), ("once", 6), (" once\t", 6)]
    each = [(t, [(0, len(t), key, 7, False)]) for t, key in rows]
    schema = "text string, marks array<struct<begin int, until int, key long, rest long, goes boolean>>"
    clash = line_dedup.clashing_keys(spark.createDataFrame(each, schema), "text", "marks")
    assert [tuple(r) for r in clash.collect()] == [(5, 7)]


def test_line_dedup_keeps_the_first_of_equal_lines():
    def kept(text):
        return line_dedup.without(text, line_dedup.placed(text)[0])

    line = sentences(1, 1, 30)[0].encode() + b"\n"
    assert kept(line * 2) == line * 2
    pair = b"\n".join(s.encode() for s in sentences(2, 2, 30)) + b"\n"
    assert kept(pair + b"Own line\n" + pair) == pair + b"Own line\n"


def test_line_dedup_of_nothing(none):
    assert line_dedup.remove_repeated(none).count() == 0


# ---- 2: neighbours --------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    connection = oracle.connect(SMALL)
    assert oracle.compare(QUERIES[name](spark, SMALL), connection, ORACLES[name]) == ""


def test_neighbours_equal_full_search(spark):
    draw = np.random.default_rng(3)
    vectors = draw.normal(size=(600, 12))
    vectors[100:300] = vectors[100]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows += [
        (700, None), (701, [0.0] * 12), (702, [float("nan")] * 12), (703, [float("inf")] + [1.0] * 11),
        (704, [1.0, None]), (None, [1.0] * 12), (50, rows[50][1]), (705, [1.0, 2.0]), (750, [2.0, 4.0]), (706, []),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.nearest(table, F.col("vec_id") % 50 == 0).collect()
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    for q in range(0, 600, 50):
        score = np.round(unit @ unit[q], 9)
        score[q] = -9
        want = sorted(range(600), key=lambda i: (-score[i], i))[:5]
        got = sorted((r.rank, r.vec_id, r.score) for r in found if r.query_id == q)
        assert [r[0] for r in got] == [1, 2, 3, 4, 5]
        assert [round(r[2], 9) for r in got] == [score[i] for i in want]
        if q != 50:
            assert [r[1] for r in got] == want
    assert [(r.vec_id, round(r.score, 9)) for r in found if r.query_id == 750] == [(705, 1.0)]
    empty = neighbours.nearest(table.limit(0), F.col("vec_id") % 50 == 0)
    assert empty.count() == 0


def test_neighbours_with_many_vectors_of_one_id(spark):
    draw = np.random.default_rng(8)
    ask, others = draw.normal(size=12), draw.normal(size=(298, 12))
    rows = [(50, ask.tolist())]
    rows += [(1, (ask + draw.normal(size=12) / 100).tolist()) for _ in range(30)]
    rows += [(100 + 3 * i, v.tolist()) for i, v in enumerate(others)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.nearest(table, F.col("vec_id") == 50).orderBy("rank").collect()
    cosine = {}
    for i, v in rows[1:]:
        value = float(np.dot(ask, v) / np.linalg.norm(ask) / np.linalg.norm(v))
        cosine[i] = max(value, cosine.get(i, -2))
    want = sorted(cosine, key=lambda i: (-cosine[i], i))[:5]
    assert [r.vec_id for r in found] == want and want[0] == 1
    assert np.allclose([r.score for r in found], [cosine[i] for i in want])


# ---- 3: Pitman-Yor --------------------------------------------------------------


def test_pitman_yor_counts_and_held_out_score(spark, documents):
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    found = {r.doc_id: r for r in pitman_yor.score(documents, held).collect()}
    count, words = collections.Counter(), {}
    for r in documents.collect():
        words[r.doc_id] = [*r.text.encode().lower().split(), b" end"]
        if zlib.crc32(str(r.doc_id).encode()) % 7 != 2:
            count.update(words[r.doc_id])
    total, size = sum(count.values()), len(count)
    for i, own in words.items():
        base = sum(math.log10((count[w] + 1) / (total + size + 1)) for w in own)
        assert (found[i].n_tokens, found[i].train_tokens) == (len(own), total)
        assert found[i].n_known == sum(w in count for w in own)
        assert found[i].base_score == pytest.approx(base, rel=1e-9)
    aside = [r for r in found.values() if r.held_out]
    assert aside and sum(r.score for r in aside) > sum(r.base_score for r in aside)


def test_pitman_yor_is_a_distribution(spark):
    """Over all words, one unknown word and the end, each context adds up to 1.

    Texts x, x w and the empty one give P(x) E(x), P(x) P(w | x) E(w) and E,
    with P at the begin of a text and E of its end. If words after x add up to
    1 - E(x) for each x, then P solves linear equations; so must it add up.
    """
    train = [(i, " ".join(random.Random(i).choices(["a", "b", "c", "d."], k=30))) for i in range(40)]
    words = ["a", "b", "c", "d.", "never"]
    ask = [(1000, "")] + [(100 + i, w) for i, w in enumerate(words)]
    ask += [(200 + 10 * i + j, f"{v} {w}") for i, v in enumerate(words) for j, w in enumerate(words)]
    docs = spark.createDataFrame(train + ask, "doc_id long, text string")
    found = {r.doc_id: 10**r.score for r in pitman_yor.score(docs, F.col("doc_id") >= 100).collect()}
    one = np.array([found[100 + i] for i in range(5)])
    two = np.array([[found[200 + 10 * i + j] for j in range(5)] for i in range(5)])
    begin = np.linalg.solve(np.eye(5) - two / one, one)
    assert begin.min() > 0 and begin.sum() + found[1000] == pytest.approx(1, abs=1e-9)


def test_pitman_yor_tells_rare_words_apart_as_contexts(spark):
    """Words beyond the most frequent ones have contexts of their own, also if
    they end alike; the letters between buckets add up to the same."""
    many = " ".join(f"w{i}" for i in range(pitman_yor.CONTEXT_WORDS + 100))
    pairs = [("qxa", "left"), ("qya", "right"), ("qza", "left"), ("qva", "right")]
    train = [(i, many) for i in range(8)] + [(20 + i, "left right") for i in range(8)]
    train += [(30 + 10 * i + j, f"{v} {w}") for i, (v, w) in enumerate(pairs) for j in range(4)]
    ask = [(1000 + i, f"{v} {w}") for i, (v, w) in enumerate(pairs)]
    ask += [(2000 + i, f"{v} {'left' if w == 'right' else 'right'}") for i, (v, w) in enumerate(pairs)]
    docs = spark.createDataFrame(train + ask, "doc_id long, text string")
    found = {r.doc_id: r.score for r in pitman_yor.score(docs, F.col("doc_id") >= 1000).collect()}
    assert all(found[1000 + i] > found[2000 + i] + 0.5 for i in range(len(pairs)))


def test_pitman_yor_tables_of_contexts_add_up_over_buckets(spark, documents, monkeypatch):
    """With many buckets and all words, a distribution over words after a rare one."""
    monkeypatch.setattr(pitman_yor, "BUCKET_TOKENS", 300)
    many = " ".join(f"w{i}" for i in range(pitman_yor.CONTEXT_WORDS + 100))
    words = ["left", "right", "up", "never"]
    lines = [(i, "qxa " + random.Random(i).choice(words[:3]) + " qxa") for i in range(60)]
    # After qxa there also are the end and, once, each of the words w0, w1 ...
    train = [*lines, *((100 + i, many) for i in range(3))]
    ask = [(1000, "qxa")] + [(1001 + i, f"qxa {w}") for i, w in enumerate(["left", "right", "up"])]
    docs = spark.createDataFrame(train + ask, "doc_id long, text string")
    found = pitman_yor.score(docs, F.col("doc_id") >= 1000)
    one = {r.doc_id: r.score for r in found.where("doc_id >= 1000").collect()}
    monkeypatch.setattr(pitman_yor, "BUCKET_TOKENS", 10**9)
    whole = {r.doc_id: r.score for r in pitman_yor.score(docs, F.col("doc_id") >= 1000).where("doc_id >= 1000").collect()}
    # Draws differ by bucket, the law does not.
    assert all(one[i] == pytest.approx(whole[i], abs=0.15) for i in one)


def test_pitman_yor_slices_do_not_end_with_a_batch():
    texts = ["x" * n for n in (3, 5_000_000, 0, 4_000_000, 9_000_000, 20_000_000, 7, 1)]
    rows = pa.record_batch({"doc_id": list(range(8)), "text": texts})
    whole = [s["doc_id"].to_pylist() for s in pitman_yor._cut(iter([rows]))]
    for most in (1, 3):
        batches = [rows.slice(0, 0), *(rows.slice(i, most) for i in range(0, 8, most))]
        found = list(pitman_yor._cut(iter(batches)))
        assert pa.Table.from_batches(found).equals(pa.Table.from_batches([rows]))
        assert len(found) <= len(whole) + 1
    assert list(pitman_yor._cut(iter([]))) == []


def test_pitman_yor_answers_cost_their_pairs_not_the_bucket():
    """Many slices that ask for a few pairs each take about the work of one that asks for all."""
    words, each, slices = 2000, 200, 400
    size = words * each
    draw = np.random.default_rng(1)
    bucket = pitman_yor.Bucket(
        np.arange(words, dtype=np.uint64), np.full(words, -1, np.int16), np.full(words, each),
        np.tile(np.arange(each, dtype=np.uint32), words), draw.integers(1, 4, size),
        np.zeros(0, np.uint64), 1,
    )
    bucket.hear({}, None, True)
    bucket.drawn.append((bucket.tables[bucket.seated], bucket.in_parent(), bucket.seats))

    def asked(parts):
        begin = time.process_time()
        found = list(bucket.answers(np.array_split(np.arange(size), parts)))
        return found, time.process_time() - begin

    (whole, one), (parts, many) = asked(1), asked(slices)
    assert many < 20 * one + 0.2
    for i in (0, 1):
        assert np.array_equal(np.concatenate([p[i] for p in parts]), whole[0][i])
    # A word counts in each slice that asks for it.
    first = parts[0]
    assert np.array_equal(first[2], bucket.by_word(bucket.count)[: len(first[2])])


@pytest.mark.parametrize("most", [1000, 2**62])
def test_numbered_pairs_are_the_distinct_ones(most):
    keys = np.random.default_rng(2).integers(0, 1000, 5000) * (most // 1000)
    for k in (keys, keys[:1], keys[:0]):
        found, at = pitman_yor._numbered(k, most)
        want, place = np.unique(k, return_inverse=True)
        assert np.array_equal(found, want) and np.array_equal(at, place)


def test_dishes_of_a_band_are_drawn_as_each_size_alone():
    customers = np.sort(np.random.default_rng(3).integers(2, pitman_yor.EXACT + 1, 3000))
    full = lambda v: np.full(len(customers), v)
    law = pitman_yor.Law(customers, full(30.0), full(0.5), 0.8, full(1.5), full(5000.0))
    draw = np.random.default_rng(4)
    alone = [law._written_out(x, int(customers[x[0]]), draw)
             for x in np.split(np.arange(len(customers)), np.flatnonzero(np.diff(customers)) + 1)]
    found = law.draw(np.random.default_rng(4))
    assert np.array_equal(found, np.concatenate(alone)) and (found <= customers).all()


def one_by_one(c, start, discount, copies, seed):
    """Tables after c customers came in, one after the other."""
    draw, tables = np.random.default_rng(seed), np.ones(copies)
    for n in range(1, c):
        tables += draw.random(copies) * (start + n) < start + discount * tables
    return tables


def law_of(copies, c, start, discount, first=1.0, later=None, total=None):
    full = lambda v: None if v is None else np.full(copies, v)
    return pitman_yor.Law(full(c), full(start), full(first), discount, full(later), full(total))


@pytest.mark.parametrize("start", [0.5, 20.0, 800.0])
@pytest.mark.parametrize("customers", [10, 1000, 100_000])
def test_table_counts_are_those_of_plain_seating(customers, start):
    # If the parent has no other word, the law is that of coming in one by one.
    plain = one_by_one(customers, start, 0.8, 4000, 1)
    drawn = law_of(4000, customers, start, 0.8).draw(np.random.default_rng(2))
    assert drawn.mean() == pytest.approx(plain.mean(), rel=0.02)
    assert drawn.std() == pytest.approx(plain.std(), rel=0.1)


@pytest.mark.parametrize("discount", [0.7, 0.8])
def test_stirling_numbers_of_large_dishes(discount):
    size = 3000
    exact, t = np.full(size + 2, -np.inf), np.arange(1, size + 2)
    exact[1] = 0.0
    for c in range(1, size):
        stay = np.log(np.maximum(c - discount * t, 1e-300)) + exact[1:]
        exact[1:] = np.logaddexp(exact[:-1], stay)
    off = np.abs(pitman_yor.log_stirling(np.full(size, size), t[:-1], discount) - exact[1:-1])
    assert off[:-5].max() < 0.02 and off.max() < 0.1


@pytest.mark.parametrize("start, first, later", [(6.0, 0.5, 1.5), (400.0, 900.0, 901.0), (9.0, 0.5, 1.3)])
def test_steps_follow_the_law_that_is_written_out(start, first, later):
    c, draw, at = pitman_yor.EXACT, np.random.default_rng(4), np.arange(6000)
    law = law_of(6000, c, start, 0.8, first, later, 5000.0)
    whole, steps = law._written_out(at, c, draw), law._stepped(at, draw)
    assert steps.mean() == pytest.approx(whole.mean(), rel=0.02)
    assert steps.std() == pytest.approx(whole.std(), rel=0.1, abs=0.05)


@pytest.mark.parametrize("customers", [2, 30, 80])
@pytest.mark.parametrize("others", [0, 7])
def test_seating_equals_moves_of_single_customers(customers, others):
    """The plain sampler: one customer leaves and sits down again at a time, with
    tables of all sizes, the parent's tables held."""
    start, d, total, fresh = 6.0, 0.8, 40.0, 0.5
    later = others + 1 - 0.7 * 1 + fresh
    first = later - 1 if others else fresh
    draw, copies = np.random.default_rng(3), 300
    sizes = np.zeros((copies, customers + 1))
    sizes[:, 0] = customers
    rows, seen = np.arange(copies), []
    moves = customers * 120
    for n in range(moves):
        at = (np.cumsum(sizes, axis=1) <= draw.random((copies, 1)) * customers).sum(axis=1)
        sizes[rows, at] -= 1
        t = (sizes > 0).sum(axis=1)
        own = np.where(t == 0, first, later + t - 1)
        chance = np.where(sizes > 0, sizes - d, 0)
        chance[rows, (sizes == 0).argmax(axis=1)] = (start + d * t) * own / (total + t)
        summed = np.cumsum(chance, axis=1)
        at = (summed <= draw.random((copies, 1)) * summed[:, -1:]).sum(axis=1)
        sizes[rows, at] += 1
        if n > moves // 2 and n % max(1, customers // 4) == 0:
            seen.append((sizes > 0).sum(axis=1).mean())
    law = law_of(20_000, customers, start, d, first, later, total)
    assert law.draw(draw).mean() == pytest.approx(np.mean(seen), rel=0.03)


def test_pitman_yor_on_odd_input(spark, odd, none):
    found = pitman_yor.score(odd, F.col("doc_id") % 2 == 0).collect()
    assert len(found) == odd.count() and all(r.score < 0 or r.n_tokens == 1 for r in found)
    assert {r.n_tokens for r in found if r.doc_id in (3, 4, 6)} == {1}
    assert pitman_yor.score(none, F.lit(True)).count() == 0
    nothing = pitman_yor.score(odd, F.lit(True)).collect()
    assert {(r.train_tokens, r.n_known, r.score) for r in nothing} == {(0, 0, 0.0)}


# ---- 4: packing -----------------------------------------------------------------


def whole_ids(texts):
    tokenizer = tokens.WordEncoder(tokens.tokenizer_path()).tokenizer
    return [e.ids + [0] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check_packing(docs, size):
    rows = docs.collect()
    want = collections.Counter()
    for r, ids in zip(rows, whole_ids([r.text for r in rows])):
        for k, start in enumerate(range(0, len(ids), size)):
            want[(r.doc_id, k, start, tuple(ids[start : start + size]))] += 1
    found = packing.pack(docs, tokens.tokenizer_path(), size=size).collect()
    got = collections.Counter()
    places = collections.defaultdict(list)
    for r in found:
        ids = np.frombuffer(bytes(r.ids), "<u2")
        assert zlib.crc32(ids.astype("<u4").tobytes()) == r.ids_crc32 and len(ids) == r.length
        got[(r.doc_id, r.piece, r.start, tuple(ids.tolist()))] += 1
        places[r.sequence_id].append((r.offset, r.length))
    assert got == want
    for held in places.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= size
    return len(places), sum(r.length for r in found)


def test_packing_of_documents(documents):
    sequences, total = check_packing(documents, 2048)
    assert sequences <= 1.02 * -(-total // 2048) + 1


def test_packing_on_odd_input(odd, none):
    check_packing(odd, 64)
    assert packing.pack(none, tokens.tokenizer_path()).count() == 0


@pytest.mark.parametrize("shape", [0.5, 1.0, 1.6])
def test_plan_is_close_to_the_bound(shape):
    draw = np.random.default_rng(4)
    length = np.clip(draw.lognormal(6, shape, 20_000).astype(int), 1, 2048)
    counts = np.bincount(length, minlength=2049)
    recipes = packing.plan(counts)
    held = collections.Counter()
    for lengths, many in recipes:
        assert sum(lengths) <= 2048
        for n in lengths:
            held[n] += many
    assert held == collections.Counter(dict(enumerate(counts.tolist()))) - collections.Counter()
    halves = int((length > 1024).sum())
    bound = max(-(-int(length.sum()) // 2048), halves)
    assert sum(m for _, m in recipes) <= 1.02 * bound + 1


def test_least_squares_without_negative_numbers():
    draw = np.random.default_rng(5)
    a, x = draw.random((20, 60)), np.zeros(60)
    x[:8] = draw.random(8) * 100
    found = packing.nnls(a, a @ x)
    assert (found >= 0).all() and np.allclose(a @ found, a @ x, rtol=1e-4)


# ---- 5: WARC --------------------------------------------------------------------


def test_warc_round_trip_on_odd_input(spark):
    rows = [
        (1, "http://a.example/x", "same\r\n\r\nbody"), (2, "http://www.a.example/x?q=1", "same\r\n\r\nbody"),
        (3, None, ""), (4, "not a url\r\nX: y", None), (5, "http://[bad", "é日"), (None, "http://b.example", "same\r\n\r\nbody"),
        (6, "http://c.example", "z" * 300_000), (6, "http://c.example", "z" * 300_000),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("sha1", F.lit(1))
    at = F.timestamp_seconds(F.lit(1_700_000_000))
    found = warc.captures(pages, at, records=2).collect()
    assert len(found) == len(rows)
    by_id = {r.page_id: r for r in found}
    assert (by_id[1].record_type, by_id[1].refers_to) == ("revisit", 2)
    assert (by_id[None].record_type, by_id[None].refers_to) == ("revisit", 2)
    assert (by_id[2].record_type, by_id[2].refers_to, by_id[2].payload_bytes) == ("response", None, 12)
    assert (by_id[3].record_type, by_id[3].refers_to) == ("revisit", 4)
    assert by_id[1].payload_digest == by_id[2].payload_digest
    assert [r.record_type for r in found if r.page_id == 6] == ["response"] * 2
    assert warc.captures(pages.limit(0), at).count() == 0
    untimed = warc.captures(pages, F.when(F.col("page_id") != 6, at)).collect()
    assert len(untimed) == len(rows)
    times = collections.Counter(r.captured for r in untimed)
    assert times[warc.NO_TIME] == 3
    path = scratch_path(spark, "warc")
    warc.write_archives(pages, path, at, least_bytes=13)
    plain = {r.page_id: r.record_type for r in warc.runs(spark, path).collect()}
    assert plain[1] == plain[3] == "response"


def test_loser_tree_merges_runs():
    draw = random.Random(6)
    runs = [sorted((str(draw.randrange(50)), "t", draw.randrange(9), "a", i) for i in range(n)) for n in (0, 1, 7, 30, 30)]
    for count in range(len(runs) + 1):
        merged = list(warc.LoserTree([iter(r) for r in runs[:count]]))
        assert merged == sorted(itertools.chain(*runs[:count]))


def test_merged_index_is_in_global_order(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    path = scratch_path(spark, "warc")
    warc.write_archives(pages, path, F.timestamp_seconds(F.col("page_id")), records=7)
    ordered = warc.merged(warc.runs(spark, path)).withColumn("part", F.spark_partition_id())
    rows = [tuple(r)[:5] for r in ordered.collect()]
    assert rows == sorted(rows) and len(rows) == pages.count()


# ---- 6: token shards ------------------------------------------------------------


@pytest.mark.parametrize("count", [1, 2, 3, 17, 1000, 4096, 5001])
def test_permutation_is_a_bijection(count):
    p = token_shards.Permutation(count, 11)
    slots = p.slot(np.arange(count))
    assert sorted(slots.tolist()) == list(range(count))
    assert (p.sequence(slots) == np.arange(count)).all()
    assert count < 17 or (slots != np.arange(count)).any()


def test_shards_hold_the_stream(spark, documents, odd):
    for docs in (documents, odd):
        shards = token_shards.write_shards(
            docs, tokens.tokenizer_path(), scratch_path(spark, "shards"), size=128, records=32
        )
        stored = {r.slot: (r, np.frombuffer(bytes(r.ids), "<u2")) for r in token_shards.read_shards(spark, shards).collect()}
        assert sorted(stored) == list(range(shards.count))
        for slot, (r, ids) in stored.items():
            assert (r.shard, r.byte_offset) == (slot // 32, slot % 32 * 256)
            assert len(ids) == 128 and ids[-1] == 0
        spans = shards.spans.collect()
        texts = collections.defaultdict(list)
        for r in docs.collect():
            texts[r.doc_id].append(tuple(whole_ids([r.text])[0]))
        pieces = collections.defaultdict(list)
        for s in spans:
            ids = stored[s.slot][1][s.offset : s.offset + s.length]
            pieces[s.doc_id].append((s.sequence, s.offset, s.start, tuple(ids.tolist())))
        for doc_id, held in pieces.items():
            rebuilt = []
            for _, _, start, ids in sorted(held):
                if start == 0:
                    rebuilt.append(())
                rebuilt[-1] += ids
            assert sorted(rebuilt) == sorted(texts[doc_id])


@pytest.mark.parametrize("start", [0, 1, 7, 8, 20, 10**6])
def test_reading_goes_on_at_a_slot(spark, documents, start):
    path = scratch_path(spark, "shards")
    shards = token_shards.write_shards(documents, tokens.tokenizer_path(), path, size=512, records=8)
    key = lambda r: (r.slot, r.shard, r.byte_offset, bytes(r.ids))
    whole = sorted(map(key, token_shards.read_shards(spark, shards).collect()))
    assert [k[0] for k in whole] == list(range(shards.count)) and shards.count > 20
    rest = token_shards.read_shards(spark, shards, start=start)
    assert sorted(map(key, rest.collect())) == whole[start:]


def test_no_documents_give_no_shards(none):
    assert token_shards.materialise(none, tokens.tokenizer_path()).count() == 0


def test_shards_refuse_ids_above_16_bits(documents, monkeypatch):
    monkeypatch.setattr(token_shards, "largest_id", lambda path: 1 << 16)
    with pytest.raises(ValueError, match="16 bits"):
        token_shards.write_shards(documents, tokens.tokenizer_path(), "unused")


@pytest.mark.parametrize(("module", "table"), [(token_shards, "token-ids"), (packing, "pieces")])
def test_tokenising_holds_few_texts_at_a_time(spark, monkeypatch, module, table):
    """Batches are bounded while texts are encoded, and as before afterwards."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    docs = spark.range(4_000, numPartitions=1).selectExpr("id AS doc_id", "concat('some words ', id) AS text")

    def batch_sizes(batches):
        for batch in batches:
            yield pa.record_batch({"n": pa.array([batch.num_rows])})

    sizes = lambda: [r.n for r in docs.mapInArrow(batch_sizes, "n long").collect()]
    seen, write, usual = {}, module.written, spark.conf.get(setting)

    def spy(df, name):
        seen[name] = sizes()
        return write(df, name)

    def run():
        if module is packing:
            return packing.pack(docs, tokens.tokenizer_path()).count()
        return token_shards.materialise(docs, tokens.tokenizer_path(), size=64, records=512).count()

    monkeypatch.setattr(module, "written", spy)
    assert run() > 0
    assert max(seen[table]) <= 1_000 and sum(seen[table]) == 4_000
    assert spark.conf.get(setting) == usual and sizes() == [4_000]
    # A smaller limit of the user's own stays; a failure leaves no setting behind.
    spark.conf.set(setting, "100")
    try:
        with pytest.raises(ZeroDivisionError), common.few_texts(spark):
            assert max(sizes()) == 100
            1 / 0
        assert spark.conf.get(setting) == "100"
    finally:
        spark.conf.set(setting, usual)


# ---- 7: quality -----------------------------------------------------------------


def test_quality_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    found = QUERIES["op7_quality"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    aside = found.where("held_out").join(labels, "doc_id").collect()
    assert len(aside) > 50
    assert sum(r.predicted == r.quality for r in aside) >= 0.95 * len(aside)


def test_quality_on_odd_input(spark, odd, none):
    labels = spark.createDataFrame(
        [(1, 1), (5, 1), (7, 1), (4, 0), (6, 0), (None, 0), (9, None), (5, 1)], "doc_id long, quality int"
    )
    ranking = quality.train(odd, labels)
    scored = quality.scored(odd, ranking).collect()
    assert len(scored) == odd.count() and all(0 <= r.score <= 1 for r in scored)
    empty = {r.score for r in scored if not (r.text or "").split()}
    assert len(empty) == 1 and empty.pop() < quality.CUT
    kept = quality.keep_good(odd, ranking)
    assert kept.columns == odd.columns and 1 in {r.doc_id for r in kept.collect()}
    assert quality.keep_good(none, quality.train(none, labels)).count() == 0
    only_good = quality.train(odd, labels.where("quality = 1"))
    assert quality.keep_good(odd, only_good).count() == odd.count()


def test_threshold_is_the_quantile_of_rejects():
    draw = np.random.default_rng(7)
    x = draw.normal(size=(1000, quality.FEATURES))
    label = (x[:, 0] + 0.3 * draw.normal(size=1000) > -0.8).astype(int)
    ranking = quality.fit(x, label)
    assert ((x @ ranking.weights) < ranking.threshold).sum() == (label == 0).sum()
    assert quality.fit(x, label, quantile=0.5).threshold == pytest.approx(np.median(x @ quality.fit(x, label).weights))


def test_ranking_is_fitted_on_every_label(spark, monkeypatch):
    """More labels than a sample would take: the last ones count as well, the
    threshold is the quantile of all, and the weights are those of all pairs."""
    draw, many = np.random.default_rng(3), 12_000
    rows = [
        (i, " ".join(draw.choice(["ba", "kelo", "NU", "12", "tise."], 3 + int(draw.integers(20)))))
        for i in range(many)
    ]
    label = [(i, int(len(t.split()) + draw.normal() * 6 > 9)) for i, t in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(label, "doc_id long, quality int")
    ranking = quality.train(docs, labels)
    x = quality.features(pa.array([t for _, t in rows]))
    y = np.array([q for _, q in label])
    strength = x @ ranking.weights
    # (equal strengths are on one side)
    assert abs((strength < ranking.threshold).sum() - (y == 0).sum()) <= (strength == strength[0]).sum() + 20
    ordered = np.sort(strength)
    below = (y == 0).sum()
    assert ranking.threshold == pytest.approx((ordered[below - 1] + ordered[below]) / 2, abs=1e-9)
    local = quality.fit(x, y)
    assert np.allclose(local.weights, ranking.weights, rtol=1e-5, atol=1e-8)
    monkeypatch.setattr(quality, "BROADCAST_LABELS", 10)
    shuffled = quality.train(docs, labels)
    assert np.allclose(shuffled.weights, ranking.weights, rtol=1e-6, atol=1e-9)


def test_node_sums_stand_for_all_pairs():
    draw = np.random.default_rng(5)
    x = draw.normal(size=(300, quality.FEATURES))
    y = (x[:, 0] + draw.normal(size=300) > 0).astype(int)
    w = draw.normal(size=quality.FEATURES) * 2
    loss, slope, bend = quality._derivatives(quality.node_sums(x, y, w), w)
    diff = (x[y == 1][:, None] - x[y == 0]).reshape(-1, quality.FEATURES)
    p = 1 / (1 + np.exp(diff @ w))
    assert loss == pytest.approx(np.logaddexp(0, -(diff @ w)).mean() + quality.RIDGE * w @ w / 2, rel=1e-10)
    assert np.allclose(slope, quality.RIDGE * w - diff.T @ p / len(diff), atol=1e-10)
    whole = (diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + quality.RIDGE * np.eye(quality.FEATURES)
    assert np.allclose(bend, whole, atol=1e-10)


# ---- 8: SimHash -----------------------------------------------------------------


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = min(4, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + n]), 42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, distance=4):
    marks = [plain_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if (marks[i] ^ marks[j]).bit_count() <= distance:
            group[root(j)] = root(i)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return marks, [least.get(root(i)) for i in range(len(rows))]


def test_simhash_equals_brute_force(documents, odd):
    for docs in (documents, odd):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        marks, want = plain_components(rows)
        found = simhash.near_duplicates(docs).collect()
        got = sorted(((r.doc_id or -1), r.fp % 2**64, r.component_id) for r in found)
        assert got == sorted((i or -1, m, c) for (i, _), m, c in zip(rows, marks, want))


@pytest.mark.parametrize("part", [simhash.PART_LEAVES, 40])
def test_trie_join_finds_every_component(spark, monkeypatch, part):
    """Chains and clusters of fingerprints, also with tries cut into parts."""
    monkeypatch.setattr(simhash, "PART_LEAVES", part)
    draw = random.Random(8)
    marks = {draw.getrandbits(64) for _ in range(300)}
    for start in list(marks)[:6]:
        for _ in range(60):
            start ^= sum(1 << b for b in draw.sample(range(64), draw.choice([1, 3, 4, 5])))
            marks.add(start)
    marks = sorted(marks)
    signed = [(m - 2**64 if m >= 2**63 else m,) for m in marks]
    edges = simhash.links(spark.createDataFrame(signed, "fp long")).collect()
    got, want = list(range(len(marks))), list(range(len(marks)))
    at = {s[0]: i for i, s in enumerate(signed)}

    def join(group, i, j):
        a, b = group[i], group[j]
        if a != b:
            group[:] = [a if g == b else g for g in group]

    for e in edges:
        join(got, at[e.a], at[e.b])
    for i, j in itertools.combinations(range(len(marks)), 2):
        if (marks[i] ^ marks[j]).bit_count() <= 4:
            join(want, i, j)
    pairs = lambda g: {frozenset(i for i, x in enumerate(g) if x == y) for y in set(g)}
    assert pairs(got) == pairs(want)


def test_more_fingerprints_need_more_equal_blocks():
    assert [len(simhash.masks(n, 4)) for n in (10**3, 10**7, 10**10)] == [5, 15, 35]
    for family in (simhash.masks(10**3, 4), simhash.masks(10**10, 4)):
        for changed in itertools.islice(itertools.combinations(range(64), 4), 0, None, 997):
            flipped = sum(1 << b for b in changed)
            assert any(not mask & flipped for mask in family)


def test_keep_one(odd, none):
    found = simhash.keep_one(odd)
    assert found.columns == odd.columns
    assert sorted(r.doc_id for r in found.collect()) == [1, 3, 5, 7, 8, 9]
    assert simhash.keep_one(none).count() == 0


def test_keep_one_of_components_without_ids_and_of_ids_with_two_texts(spark):
    a, b, c, d, e, f = (prose(500 + i) for i in range(6))
    rows = [
        (None, a), (None, b), (None, c), (None, c), (7, d), (None, d), (8, e), (8, f), (8, f), (9, f), (6, e + " x"),
    ]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, k int")
    found = simhash.keep_one(docs)
    assert found.columns == docs.columns
    _, group = plain_components(rows)
    assert group[8] == group[9] != group[6] == group[10]
    got = sorted((r.doc_id or 0, r.text) for r in found.collect())
    assert got == sorted([(0, a), (0, b), (0, c), (7, d), (6, e + " x"), (8, f)])


# ---- 9: decontamination ---------------------------------------------------------


def test_masks_find_every_overlap():
    for size in range(decontamination.LEAST_WORDS, decontamination.WINDOW + 1):
        wrong = size - math.ceil(decontamination.AGREEMENT * size)
        for bad in itertools.combinations(range(size), wrong):
            assert any(
                all(start + m not in bad for m in mask)
                for mask in decontamination.MASKS
                for start in range(size - mask[-1])
            ), (size, bad)


def bare(text):
    from incidentia.llm.words import bare_words

    words, codes, _ = bare_words(pa.array([text]))
    own = words.to_pylist()
    return [own[c] for c in codes]


def plain_overlap(text, item):
    """(agreeing words, window, -first word) of the best window, or nothing."""
    a, b = bare(text), bare(item)
    window = min(decontamination.WINDOW, len(b))
    need = math.ceil(0.8 * window) if len(b) >= decontamination.LEAST_WORDS else window
    if not b or len(a) < window:
        return None
    same = np.array([[x == y for y in b] for x in a], int)
    rows, columns = len(a) - window + 1, len(b) - window + 1
    sums = sum(same[t : t + rows, t : t + columns] for t in range(window)).max(axis=1)
    at = int(sums.argmax())
    return (int(sums[at]), window, -at) if sums[at] >= need else None


def test_decontamination_equals_brute_force(spark):
    items = [(i, prose(1000 + i, 14 + 3 * i)) for i in range(6)] + [(9, "not in any text"), (10, None), (None, prose(2000, 9)),
             (11, "Paris is the capital of France"), (12, "of"), (-1, "")]
    docs = []
    for i in range(40):
        draw, words = random.Random(i), prose(i, 60).split()
        if i % 2:
            leak = items[i % 6][1].upper().split()
            leak = leak[: draw.randrange(8, len(leak) + 1)]
            for at in range(draw.randrange(0, 5), len(leak), draw.choice([4, 5, 6])):
                leak[at] = "changed"
            words[20:20] = leak
        docs.append((i, " ".join(words)))
    docs += [(100, None), (101, ""), (102, items[8][1]), (102, items[8][1])]
    docs += [(103, "It is so: PARIS is the capital of France, is it?"), (104, "Paris is a capital of France")]
    docs += [(None, items[1][1]), (105, " ".join(["of"] * 5000))]
    documents = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(1))
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(2))
    found = decontamination.overlaps(documents, benchmark).collect()
    got = collections.Counter((r.doc_id, r.item_id, r.agreeing, r.window, -r.first_word) for r in found)
    want, bad = collections.Counter(), set()
    for number, (d, t) in enumerate(docs):
        for i, b in items:
            best = plain_overlap(t or "", b or "")
            if best:
                want[(d, i, *best)] += 1
                bad |= {number} if len(bare(b)) >= decontamination.EVIDENCE_WORDS else set()
    assert got == want and len(got) > 5 and {11, 12, None} <= {k[1] for k in got}
    kept = decontamination.remove_contaminated(documents, benchmark)
    assert kept.columns == documents.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(
        d for k, (d, _) in enumerate(docs) if k not in bad
    )
    assert decontamination.overlaps(documents, benchmark.limit(0)).count() == 0
    assert decontamination.overlaps(documents.limit(0), benchmark).count() == 0


def test_hot_seeds_and_a_full_filter_give_the_same(spark, documents, monkeypatch):
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    whole = {tuple(r) for r in decontamination.overlaps(documents, benchmark).collect()}
    kept = {r.doc_id for r in decontamination.remove_contaminated(documents, benchmark).collect()}
    monkeypatch.setattr(decontamination, "SLICE_ROWS", 2)
    monkeypatch.setattr(decontamination, "FILTER_BITS", decontamination.BUCKET_BITS)
    assert whole and {tuple(r) for r in decontamination.overlaps(documents, benchmark).collect()} == whole
    again = decontamination.remove_contaminated(documents, benchmark).collect()
    assert {r.doc_id for r in again} == kept
    assert kept.isdisjoint(r[0] for r in whole)


def test_a_million_equal_words_are_few_seeds(spark):
    documents = spark.createDataFrame([(1, "very " * 1_000_000)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, "very " * 20)], "item_id long, text string")
    found = decontamination.overlaps(documents, benchmark).collect()
    assert [tuple(r) for r in found] == [(1, 1, 13, 13, 0)]


# ---- 10: licenses ---------------------------------------------------------------


def test_licenses_are_inherited_from_the_nearest_directory(spark):
    apache = dict((n, t) for n, t in licenses.TEMPLATES if len(t) > 100)["Apache-2.0"]
    rows = [
        ("a/LICENSE", "Released under the MIT License."), ("a/x.txt", "plain"), ("a/b/c/y.txt", None),
        ("a/b/COPYING.md", "\n\n" + apache + "\n"), ("a/b/own.txt", "text\nLicensed under CC BY-NC 4.0.\ntext"),
        ("other.txt", ""), (None, "Released under the MIT License."), ("z/LICENSE", "nothing of the kind"), ("z/f", "x"),
        ("a/x.txt", "plain"),
    ]
    files = spark.createDataFrame(rows, "path string, text string").withColumn("license", F.lit("old"))
    files = files.withColumn("directory", F.lit(1)).withColumn("n", F.lit(2))
    found = licenses.scan(files)
    assert found.columns == ["path", "text", "directory", "n", "license", "similarity", "origin", "license_path"]
    got = sorted((r.path or "", r.license, r.origin, r.license_path) for r in found.collect())
    assert got == [
        ("", None, None, None),
        ("a/LICENSE", "MIT", "own", "a/LICENSE"),
        ("a/b/COPYING.md", "Apache-2.0", "own", "a/b/COPYING.md"),
        ("a/b/c/y.txt", "Apache-2.0", "inherited", "a/b/COPYING.md"),
        ("a/b/own.txt", "CC-BY-NC-4.0", "own", "a/b/own.txt"),
        ("a/x.txt", "MIT", "inherited", "a/LICENSE"),
        ("a/x.txt", "MIT", "inherited", "a/LICENSE"),
        ("other.txt", None, None, None),
        ("z/LICENSE", None, None, None),
        ("z/f", None, None, None),
    ]
    assert licenses.scan(files.limit(0)).count() == 0


def test_licenses_of_wrapped_headers_and_whole_files(spark):
    texts = {(n, t[:30]): t for n, t in licenses.TEMPLATES}
    mit, agpl = texts["MIT", "Permission is hereby granted, "], texts["AGPL-3.0", "This program is free software:"]
    long = {n: t for n, t in licenses.TEMPLATES if len(t) > 500}
    lesser = texts["LGPL-2.1", "This library is free software;"]
    code = "\n".join(f"    value_{i} = compute(value_{i - 1}, table[{i}])" for i in range(400))
    wrap = lambda text, mark="": "\n".join(mark + line for line in textwrap.wrap(text, 72 - len(mark)))
    owner = "Copyright (c) 2021 The Owners of Something"
    rows = [
        ("MIT", f'"""{owner}\n\n{wrap(mit)}\n"""\n{code}'),
        ("MIT", wrap(f"{owner}. {mit}", "# ") + "\n" + code),
        ("MIT", f"{owner}\n\n" + wrap(long["MIT"])),
        ("ISC", f"ISC License\n\n{owner}\n\n" + wrap(long["ISC"])),
        ("BSD-2-Clause", f"{owner}\nAll rights reserved.\n\n" + wrap(long["BSD-2-Clause"])),
        ("BSD-3-Clause", f"/*\n * {owner}\n *\n{wrap(long['BSD-3-Clause'], ' * ')}\n */\n{code}"),
        ("LGPL-2.1", f"/* {owner}\n *\n{wrap(lesser, ' * ')}\n */\n{code}"),
        ("AGPL-3.0", f"// {owner}\n//\n{wrap(agpl, '// ')}\n{code}"),
        ("GPL-2.0", "        GNU GENERAL PUBLIC LICENSE\n           Version 2, June 1991\n\n" + prose(1, 900)),
        ("Apache-2.0", f"// SPDX-License-Identifier: Apache-2.0\n{code}"),
        (None, code), (None, prose(2, 500)), (None, "# SPDX-License-Identifier: Other-Terms\n" + code),
        (None, "\n" * 50_000 + "#\n" * 50_000),
    ]
    files = spark.createDataFrame([(f"f{i}", t) for i, (_, t) in enumerate(rows)], "path string, text string")
    found = {r.path: r.license for r in licenses.own_licenses(files).collect()}
    assert [found.get(f"f{i}") for i in range(len(rows))] == [n for n, _ in rows]


# ---- Pipeline -------------------------------------------------------------------


def test_stages_keep_the_columns_of_documents(spark, documents, none):
    for docs in (documents, none.select(documents.columns)):
        before = docs.count()
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, SMALL)
            assert after.dtypes == documents.dtypes, name
            assert name == "line dedup" or after.count() <= before
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "SimHash near-dedup", "benchmark decontamination", "best-fit packing",
    ]


def test_pipeline_equals_its_stages_by_brute_force(spark, documents):
    """Each stage's decisions, taken one after the other on the driver."""
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    from incidentia.llm.queries import quality_ranking

    ranking = quality_ranking(documents, labels)
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    score = ranking.scores(pa.array([t for _, t in rows]))
    rows = [r for r, s in zip(rows, score) if s >= quality.CUT]
    rows = [(i, t) for (i, _), t in zip(rows, expected_line_dedup(rows))]
    _, group = plain_components(rows)
    rows = [r for r, g in zip(rows, group) if r[0] == g]
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    rows = [(i, t) for i, t in rows if not any(plain_overlap(t, b) for b in items)]
    want = sorted((i, len(ids), zlib.crc32(np.array(ids[:2048], "<u4").tobytes())) for (i, _), ids in zip(rows, whole_ids([t for _, t in rows])))
    found = corpus_pipeline.run(spark, SMALL).collect()
    total = collections.Counter()
    for r in found:
        total[r.doc_id] += r.length
    got = sorted((r.doc_id, total[r.doc_id], r.ids_crc32) for r in found if r.piece == 0)
    assert got == want
