"""Hierarchical Pitman-Yor language model over words.

Each context has a restaurant of its own; all of them share one parent, whose
base is uniform over the training vocabulary and one unknown word. A table of a
context restaurant is a customer of the parent. The context of a word is the
word before it, whichever that is; a text begins after the end of another. So
every training word has a restaurant, and what comes after a word that is not
known is the parent's alone.

With ``c`` customers and ``t`` tables of a word in a restaurant (``C`` and
``T`` of all words), discount ``d`` and strength ``s``:

    P(word | context) = (c - d t + (s + d T) P(word)) / (s + C)

The seating is sampled by Gibbs, a dish at a time: all customers of a word leave
a restaurant and sit down again. No probability depends on the sizes of tables,
so these are summed out, and what is drawn is the number of tables. With ``T'``
tables of other words, ``S`` the generalised Stirling numbers (over all seatings
of c customers at t tables) and P_j the parent's probability of the word after j
of these tables,

    P(t) ~ S(c, t) * product over j < t of (s + d (T' + j)) P_j

Up to ``EXACT`` customers this law is drawn from as it stands. Beyond that the
Stirling numbers come from their finite sum (few tables) or a saddle point with
a correction, and the law is sampled by Metropolis steps. Dishes of one sweep are drawn at once,
given the totals before it. Predictive probabilities are averaged over sweeps.

The work is dealt out by dish. A bucket holds words with all their restaurants,
so seating them needs from outside the tables per context, and the counts of the
``CONTEXT_WORDS`` most frequent words, whose restaurants are spread over all
buckets. Both are refreshed once per sweep. What belongs to the most frequent
words is an array of bounded size. The tables in the contexts of all other
words are added up in the bucket that holds the word as a dish: buckets write
letters to each other, about contexts in which they have a dish to seat.

1. Documents become slices: word codes of a bounded number of texts, written once.
2. Each slice asks each bucket about its distinct (context, word) pairs and
   brings their counts along, so a frequent pair counts once per slice.
3. Buckets add up the counts and run the sweeps; letters go between them.
4. Buckets answer, and slices score their documents.

The customers of a context are the training occurrences of its word, as each is
followed by one token, so they need no count of their own.
"""

from __future__ import annotations

import functools
import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentia.llm.common import drop_written, few_texts, free_shuffles
from incidentia.llm.tokens import slices
from incidentia.llm.words import split_words
from incidentia.session import scratch_path, written

# Words whose contexts and dishes are spread over all buckets; the others are
# whole in one bucket. This has no effect on what a context is.
CONTEXT_WORDS = 2000
BUCKET_TOKENS = 2_000_000
BURN_IN = 1
SAMPLES = 2
# Customers of a dish up to which its law is written out; Metropolis steps beyond.
EXACT = 1000
STEPS = 8
TAIL = 4  # degrees of freedom of the law that offers
# Numbers of the law that are held at once.
CELLS = 4_000_000
DISCOUNT = 0.8
STRENGTH = 2.0
PARENT_DISCOUNT = 0.7
PARENT_STRENGTH = 10.0
SEED = 5
# No word holds a blank, so no word has these marks.
END_MARK = np.uint64(xxhash.xxh64_intdigest(b" end"))


def pack(*arrays: object) -> bytes:
    return zstandard.compress(pickle.dumps(arrays, 5), 1)


def unpack(data: bytes) -> tuple:
    return pickle.loads(zstandard.decompress(data))


def _planes(marks: np.ndarray) -> np.ndarray:
    """Ascending marks by byte, the highest first: those hardly differ and pack well."""
    return np.ascontiguousarray(marks.astype(">u8").view(np.uint8).reshape(-1, 8).T)


def _whole(planes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(planes.T).view(">u8").ravel().astype(np.uint64)


def _distinct(values: np.ndarray) -> np.ndarray:
    """Distinct values in order; sorting is quicker here than the hash table of numpy."""
    values = np.sort(values)
    return values[_starts(values)]


def _starts(values: np.ndarray) -> np.ndarray:
    """Whether a run of equal values begins here."""
    return np.concatenate((np.ones(min(1, len(values)), bool), values[1:] != values[:-1]))


def _numbered(keys: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys (from 0, less than ``most``) in order, and the number of each key among them."""
    bits = len(keys).bit_length()
    if most.bit_length() + bits > 63:
        return np.unique(keys, return_inverse=True)
    # Sorted along with their places, which is quicker than an argsort.
    keys = keys << bits
    keys |= np.arange(len(keys))
    keys.sort()
    place = keys & ((1 << bits) - 1)
    keys >>= bits
    new = _starts(keys)
    number = np.empty(len(keys), np.int64)
    number[place] = np.cumsum(new) - 1
    return keys[new], number


def _by_home(homes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of each home one after the other, in order, and where each home's begin (plus the end)."""
    order = np.argsort(homes.astype(np.min_scalar_type(buckets)), kind="stable")
    return order, np.concatenate(([0], np.cumsum(np.bincount(homes, minlength=buckets))))


# ---- Slices ---------------------------------------------------------------------

SLICE = "slice bigint, doc_ids array<bigint>, held array<boolean>, edges binary, words binary, tokens bigint"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices that go on from one batch to the next, so that batches may be small."""
    rest = []
    for batch in batches:
        found = list(slices(pa.concat_batches([*rest, batch])))
        yield from found[:-1]
        rest = found[-1:]
    yield from rest


def _sliced(docs: DataFrame, doc_id: str, text: str, held: Column) -> DataFrame:
    """One row per slice of documents. To be written once before use."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for rows in _cut(batches):
            words, edges = split_words(pc.ascii_lower(rows["text"]))
            coded = words.dictionary_encode()
            own = coded.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False)
            marks = np.array([END_MARK, *map(xxhash.xxh64_intdigest, own)], np.uint64)
            # Frequent words get small codes, which pack well.
            codes = coded.indices.to_numpy() + 1 if len(words) else np.zeros(0, np.int64)
            order = np.argsort(-np.bincount(codes, minlength=len(marks)), kind="stable")
            order = np.concatenate(([0], order[order != 0]))
            rank = np.empty_like(order)
            rank[order] = np.arange(len(order))
            texts = len(rows["text"])
            line = np.zeros(len(codes) + texts, np.uint32)
            line[np.arange(len(codes)) + np.repeat(np.arange(texts), np.diff(edges))] = rank[codes]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([rows["doc_id"].to_pylist()], pa.list_(pa.int64())),
                    pa.array([rows["held"].to_pylist()], pa.list_(pa.bool_())),
                    pa.array([(edges + np.arange(texts + 1)).astype(np.int64).tobytes()]),
                    pa.array(
                        [pack(marks[order], (line & 0xFFFF).astype(np.uint16),
                              (line >> 16).astype(np.uint16))], pa.binary()
                    ),
                    pa.array([len(line)], pa.int64()),
                ],
                names=[f.split()[0] for f in SLICE.split(", ")],
            )
            number += 1

    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        F.coalesce(held, F.lit(False)).alias("held"),
    )
    return rows.mapInArrow(run, SLICE)


class Slice:
    """The words of a slice, and its distinct (word, context) pairs by bucket."""

    def __init__(self, words: bytes, edges: bytes, held: list[bool]):
        self.marks, low, high = unpack(words)
        self.line = low.astype(np.int64) | high.astype(np.int64) << 16
        self.edges = np.frombuffer(edges, np.int64)
        self.train = np.repeat(~np.array(held, bool), np.diff(self.edges))

    def pairs(self, frequent: np.ndarray, buckets: int) -> None:
        """Number the pairs in the order of bucket, word and context, that of
        the most frequent words first."""
        at = np.minimum(np.searchsorted(frequent, self.marks), max(0, len(frequent) - 1))
        known = frequent[at] == self.marks if len(frequent) else np.zeros(len(self.marks), bool)
        self.top = np.where(known, at, -1)
        before = np.empty(len(self.line), np.int64)
        before[1:] = self.line[:-1]
        before[self.edges[:-1]] = 0  # the end of another text
        size = len(self.marks)
        # Numbered in the order of words and contexts, so that only buckets are left to sort by.
        by_mark, by_context = np.argsort(self.marks), np.lexsort((self.marks, ~known))
        as_word, as_context = np.empty(size, np.int64), np.empty(size, np.int64)
        as_word[by_mark] = as_context[by_context] = np.arange(size)
        pair, self.of = _numbered(as_word[self.line] * size + as_context[before], size**2)
        word, context = by_mark[pair // size], by_context[pair % size]
        count = np.bincount(self.of, self.train, len(pair)).astype(np.uint32)
        salt = np.where(known[word], self.marks[context], np.uint64(0))
        bucket = _home(self.marks[word] + salt * np.uint64(0x9E3779B97F4A7C15), buckets)
        order, self.cuts = _by_home(bucket, buckets)
        self.place = np.empty(len(pair), np.int64)
        self.place[order] = np.arange(len(pair))
        self.word, self.context, self.count = word[order], context[order], count[order]


# The contexts of the most frequent words; all others together are the last.
CONTEXTS = CONTEXT_WORDS + 1


def _home(marks: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of a word; that of the tables in its context, too."""
    return (_mixed(marks) % np.uint64(buckets)).astype(np.int64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


def _frequent_words(sliced: DataFrame) -> np.ndarray:
    """Marks of the most frequent training words (the end is one), in the order of marks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, edges, held in zip(*(batch[c].to_pylist() for c in ("words", "edges", "held"))):
                own = Slice(words, edges, held)
                n = np.bincount(own.line[own.train], minlength=len(own.marks))
                seen = np.flatnonzero(n)
                yield pa.record_batch({"mark": own.marks[seen].view(np.int64), "n": n[seen]})

    named = sliced.select("words", "edges", "held").mapInArrow(run, "mark bigint, n bigint")
    total = named.groupBy("mark").agg(F.sum("n").alias("n"))
    best = total.orderBy(F.col("n").desc(), "mark").limit(CONTEXT_WORDS).collect()
    return np.sort(np.array([r.mark for r in best], np.int64).view(np.uint64))


# ---- Seating --------------------------------------------------------------------


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function of positive numbers."""
    x = np.asarray(x, float)
    shift = np.where(x < 8, x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5) * (x + 6) * (x + 7), 1.0)
    z = np.where(x < 8, x + 8, x)
    series = (1 / 12 - (1 / 360 - 1 / 1260 / z**2) / z**2) / z
    return (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + series - np.log(shift)


@functools.cache
def _stirling_table(discount: float) -> np.ndarray:
    """Logarithms of S(c, t) for c and t up to ``EXACT``."""
    out = np.full((EXACT + 1, EXACT + 1), -np.inf)
    out[1, 1] = 0.0
    t = np.arange(1, EXACT + 1)
    for c in range(1, EXACT):
        stay = np.log(np.maximum(c - discount * t, 1e-300)) + out[c, 1:]
        out[c + 1, 1:] = np.logaddexp(out[c, :-1], stay)
    return out


def _saddle(customers: np.ndarray, tables: np.ndarray, discount: float) -> np.ndarray:
    """log S by the saddle point of c!/t! [z^c] ((1 - (1 - z)^d) / d)^t, t < c."""
    d, ratio = discount, customers / tables
    low, high = np.full(len(ratio), -45.0), np.full(len(ratio), 7.0)
    for _ in range(50):
        # log(1 - z) = -exp(middle); the growth rate rises with it.
        middle = (low + high) / 2
        y = -np.exp(middle)
        rate = np.log(-np.expm1(y)) + (d - 1) * y - np.log(-np.expm1(d * y)) + math.log(d)
        over = rate > np.log(ratio)
        low, high = np.where(over, low, middle), np.where(over, middle, high)
    y = -np.exp((low + high) / 2)
    z, g = -np.expm1(y), -np.expm1(d * y)
    spread = customers * np.maximum(1 + (1 - d) * z * np.exp(-y) - ratio, 1e-12)
    return (
        _log_gamma(customers + 1) - _log_gamma(tables + 1) + tables * np.log(g / d)
        - customers * np.log(z) - 0.5 * np.log(2 * np.pi * spread)
    )


def _finite_sum(customers: np.ndarray, tables: np.ndarray, discount: float) -> np.ndarray:
    """log S by its sum over j <= t of alternating terms, which fall quickly
    where the tables are few against c^d."""
    c, t, out = customers, tables, np.zeros(len(customers))
    of_tables, of_customers = _log_gamma(t + 1), _log_gamma(c)
    for j in range(1, 40):
        turn = j * discount
        if abs(turn - round(turn)) < 1e-9:
            continue  # the term has the factor 0
        sign = (-1) ** (j + 1) * math.copysign(1.0, -math.gamma(-turn))
        use = t >= j
        left = np.where(use, t - j, 0)
        size = (
            of_tables - math.lgamma(j + 1) - _log_gamma(left + 1)
            + _log_gamma(c - turn) - of_customers - math.lgamma(-turn)
        )
        out += np.where(use, sign * np.exp(np.where(use, size, 0)), 0)
    return np.log(np.maximum(out, 1e-300)) + of_customers - t * math.log(discount) - of_tables


@functools.cache
def _bands() -> np.ndarray:
    """Numbers of customers at which bands end: dishes in a band, whose numbers
    differ by an eighth at most, are drawn together."""
    ends = [1]
    while ends[-1] < EXACT:
        ends.append(ends[-1] + 1 + ends[-1] // 8)
    return np.array(ends)


@functools.cache
def _correction(discount: float) -> tuple[np.ndarray, np.ndarray]:
    """What the saddle point lacks, by t / c^d. With many customers and few
    tables for each, it depends on that alone; it is read off the last row of
    the table, where it is up to 1 near c^d and vanishes on both sides."""
    t = np.arange(1, EXACT * 4 // 5)
    lack = _stirling_table(discount)[EXACT, t] - _saddle(np.full(len(t), EXACT), t, discount)
    return t / EXACT**discount, lack


def log_stirling(customers: np.ndarray, tables: np.ndarray, discount: float) -> np.ndarray:
    """log S(c, t) of more than ``EXACT`` customers, 1 <= t <= c."""
    c, t = np.asarray(customers, float), np.asarray(tables, float)
    out = np.zeros(len(c))  # one seating has a table for each customer
    share = t / c**discount
    few = share <= 0.25
    many = ~few & (t < c)
    out[few] = _finite_sum(c[few], t[few], discount)
    known, lack = _correction(discount)
    out[many] = _saddle(c[many], t[many], discount) + np.interp(share[many], known, lack, right=0)
    return out


@dataclass
class Law:
    """Law of the number of tables of each dish, from what does not change with it.

    Table j (from 0) weighs (``start`` + d j) times the parent's probability of
    the word, when j such tables are its customers. Without ``total`` that is
    ``first`` for all of them. Else it is ``first`` / ``total`` for j = 0 and
    (``later`` + j - 1) / (``total`` + j) after that.
    """

    customers: np.ndarray
    start: np.ndarray  # s + d T'
    first: np.ndarray
    discount: float
    later: np.ndarray | None = None
    total: np.ndarray | None = None

    def draw(self, draw) -> np.ndarray:
        out = np.minimum(self.customers, 1).astype(np.int64)
        small = np.flatnonzero((self.customers > 1) & (self.customers <= EXACT))
        small = small[np.argsort(self.customers[small], kind="stable")]
        edges = np.searchsorted(self.customers[small], _bands(), side="right")
        for like in np.split(small, edges):
            c = int(self.customers[like[-1]]) if len(like) else 0
            for x in np.array_split(like, len(like) * c // CELLS + 1) if c else []:
                out[x] = self._written_out(x, c, draw)
        large = np.flatnonzero(self.customers > EXACT)
        for x in np.array_split(large, len(large) // 50_000 + 1) if len(large) else []:
            out[x] = self._stepped(x, draw)
        return out

    def _written_out(self, x: np.ndarray, c: int, draw) -> np.ndarray:
        """Dishes with up to ``c`` customers; to more tables than customers the law gives nothing."""
        j, customers = np.arange(c), self.customers[x].astype(np.int64)
        table = np.repeat(self.first[x, None], c, axis=1)
        if self.total is not None:
            table[:, 1:] = self.later[x, None] + j[:-1]
            table /= self.total[x, None] + j
        law = np.cumsum(np.log((self.start[x, None] + self.discount * j) * table), axis=1)
        law += _stirling_table(self.discount)[customers, 1 : c + 1]
        law = np.cumsum(np.exp(law - law.max(axis=1, keepdims=True)), axis=1)
        at = (law <= (draw.random(len(x)) * law[:, -1])[:, None]).sum(axis=1)
        return np.minimum(at, customers - 1) + 1

    def logarithm(self, x: np.ndarray, tables: np.ndarray) -> np.ndarray:
        t, d = tables.astype(float), self.discount
        a = self.start[x] / d
        out = log_stirling(self.customers[x], t, d) + np.log(self.first[x])
        out += t * math.log(d) + _log_gamma(a + t) - _log_gamma(a)
        if self.total is None:
            return out + (t - 1) * np.log(self.first[x])
        later, total = self.later[x], self.total[x]
        out += _log_gamma(later + t - 1) - _log_gamma(later)
        return out - _log_gamma(total + t) + _log_gamma(total)

    def _stepped(self, x: np.ndarray, draw) -> np.ndarray:
        """Metropolis steps from the mode, offered from a Student law around it,
        whose tails are heavier than those of the law sought."""
        c, d = self.customers[x].astype(float), self.discount
        low, high = np.full(len(x), -45.0), np.full(len(x), 7.0)
        for _ in range(50):
            # As above; the slope of the law falls with the number of tables.
            middle = (low + high) / 2
            y = -np.exp(middle)
            z, g = -np.expm1(y), -np.expm1(d * y)
            t = np.clip(c * g / (d * z) * np.exp((1 - d) * y), 1, c)
            step = np.log(g / d) + np.log(self.start[x] + d * t)
            step -= np.log(t)
            if self.total is None:
                step += np.log(self.first[x])
            else:
                step += np.log((self.later[x] + np.maximum(t - 1, 0)) / (self.total[x] + t))
            rises = step > 0
            low, high = np.where(rises, low, middle), np.where(rises, middle, high)
        centre = np.clip(np.round(t), 1, c)
        wide = np.maximum(1, np.round(np.sqrt(centre)))
        middle = np.clip(centre, 1 + wide, np.maximum(c - wide, 1 + wide))
        bend = 2 * self.logarithm(x, middle)
        bend -= self.logarithm(x, middle - wide) + self.logarithm(x, np.minimum(middle + wide, c))
        width = 1.2 * np.sqrt(np.clip(wide**2 / np.maximum(bend, 1e-9), 0.25, (centre + 1) ** 2)) + 0.3

        def over(tables: np.ndarray) -> np.ndarray:
            """The law over that of the offers."""
            far = ((tables - centre) / width) ** 2
            return self.logarithm(x, tables) + 0.5 * (TAIL + 1) * np.log1p(far / TAIL)

        now = centre
        value = over(now)
        for _ in range(STEPS):
            offer = np.round(centre + width * draw.standard_t(TAIL, len(x)))
            inside = (offer >= 1) & (offer <= c)
            offer = np.where(inside, offer, now)
            found = over(offer)
            taken = inside & (np.log(draw.random(len(x))) < found - value)
            now, value = np.where(taken, offer, now), np.where(taken, found, value)
        return now.astype(np.int64)


def _parent_tables(customers: np.ndarray, tables: np.ndarray, totals: Totals, draw) -> np.ndarray:
    """Draw the tables of words in the parent, whose base is uniform."""
    base = np.full(len(customers), 1 / (totals.vocabulary + 1))
    start = PARENT_STRENGTH + PARENT_DISCOUNT * (totals.parent_tables - tables)
    return Law(customers, start, base, PARENT_DISCOUNT).draw(draw)


@dataclass
class Totals:
    """What a sweep needs from all buckets; sizes depend on ``CONTEXTS`` only."""

    customers: np.ndarray  # by context
    tables: np.ndarray  # by context
    top_count: np.ndarray  # customers of the frequent words, in all contexts
    top_tables: np.ndarray  # their tables in all contexts
    top_parent: np.ndarray  # their tables in the parent; drawn once per sweep
    words: int  # other training words
    other: int  # tables of other words
    parent: int  # parent tables of other words

    def state(self) -> bytes:
        return pack(self.customers, self.tables, self.top_count, self.top_tables,
                    self.top_parent, self.words, self.other, self.parent)

    @property
    def vocabulary(self) -> int:
        return self.words + int((self.top_count > 0).sum())

    @property
    def parent_tables(self) -> int:
        return self.parent + int(self.top_parent.sum())

    @property
    def parent_customers(self) -> int:
        return self.other + int(self.top_tables.sum())

    @property
    def parent_new(self) -> float:
        """Weight of a new table in the parent."""
        return (PARENT_STRENGTH + PARENT_DISCOUNT * self.parent_tables) / (self.vocabulary + 1)

    def parent_probability(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """P(word) from the customers and tables of a word in the parent."""
        rest = self.parent_new
        return (customers - PARENT_DISCOUNT * tables + rest) / (PARENT_STRENGTH + self.parent_customers)


class Bucket:
    """Words, their (word, context) pairs with counts and tables, and the words'
    tables in the parent.

    Contexts below ``CONTEXT_WORDS`` are those of the most frequent words; the
    others follow in the order of ``rare``, the marks of their words.
    """

    def __init__(self, marks, top, many, context, count, rare, buckets, moved=None):
        self.marks, self.top, self.context, self.count = marks, top, context, count
        self.many, self.word = many, np.repeat(np.arange(len(marks)), many)
        self.begins = np.cumsum(many, dtype=np.int64) - many
        self.rare, self.buckets = rare, buckets
        self.seated = np.flatnonzero(count > 1)
        # At first each dish has one table.
        self.tables, self.drawn, self.spread = np.minimum(count, 1), [], []
        if moved is None:
            self.seats = np.minimum(self.in_parent(), 1)
        else:
            self.tables[self.seated], seats, self.drawn, self.spread = moved
            self.seats = seats.astype(np.int64)
        # Of these contexts the bucket must know all tables; by home, in the order of marks.
        asked = np.zeros(CONTEXT_WORDS + len(rare) + 1, bool)
        asked[context[self.seated]] = True
        self.asked = np.flatnonzero(asked[CONTEXT_WORDS:])
        self.homes = _home(rare, buckets)
        self.reach = np.zeros(len(rare), np.int64)

    def fixed(self) -> bytes:
        """What no sweep changes. After the first letters only contexts with
        dishes to seat must be told apart; all others become one."""
        place = np.full(len(self.rare), len(self.asked), np.uint32)
        place[self.asked] = np.arange(len(self.asked))
        context = self.context.astype(np.uint32)
        other = context >= CONTEXT_WORDS
        context[other] = CONTEXT_WORDS + place[context[other] - CONTEXT_WORDS]
        return pack(
            self.marks, self.top, self.many.astype(np.uint32), context, self.count,
            self.rare[self.asked], self.buckets,
        )

    def moved(self) -> bytes:
        tables, seats = (v.astype(np.uint32) for v in (self.tables[self.seated], self.seats))
        return pack(tables, seats, self.drawn, self.spread)

    def letters(self, first: bool) -> Iterator[tuple[int, bytes]]:
        """To each home the tables in its contexts, as far as they may change;
        at ``first`` also those of dishes with one customer, which do not."""
        sums = []
        for x in (np.flatnonzero(self.count == 1) if first else self.seated[:0], self.seated):
            x = x[self.context[x] >= CONTEXT_WORDS]
            sums.append(np.bincount(self.context[x] - CONTEXT_WORDS, self.tables[x], len(self.rare)))
        named = np.flatnonzero(sums[0]), self.asked
        dealt = [_by_home(self.homes[x], self.buckets) for x in named]
        for home in np.flatnonzero(np.diff(dealt[0][1]) + np.diff(dealt[1][1])):
            content = []
            for x, tables, (order, cuts) in zip(named, sums, dealt):
                own = x[order[cuts[home] : cuts[home + 1]]]
                content += [_planes(self.rare[own]), tables[own].astype(np.uint32)]
            yield int(home), pack(*content)

    def hear(self, sums: dict[int, bytes], own: bytes | None, keep: bool) -> None:
        """Take the tables of all buckets in the contexts that were asked for,
        and those in the contexts of the bucket's own words."""
        order, cuts = _by_home(self.homes[self.asked], self.buckets)
        for home, content in sums.items():
            (self.reach[self.asked[order[cuts[home] : cuts[home + 1]]]],) = unpack(content)
        if keep:
            tables = np.zeros(len(self.marks), np.uint32)
            if own is not None:
                marks, found = unpack(own)
                tables[np.searchsorted(self.marks, _whole(marks))] = found
            self.spread.append(tables)

    def in_parent(self) -> np.ndarray:
        return self.by_word(self.tables)

    def by_word(self, values: np.ndarray) -> np.ndarray:
        """Sums over the pairs of each word."""
        return np.add.reduceat(values, self.begins, dtype=np.int64)

    def totals(self) -> Totals:
        own = np.repeat(self.top < 0, self.many)
        context = np.minimum(self.context, CONTEXT_WORDS)
        by_context = [np.bincount(context, v, CONTEXTS) for v in (self.count, self.tables)]
        top = self.top[self.word[~own]]
        by_top = [np.bincount(top, v[~own], CONTEXT_WORDS) for v in (self.count, self.tables)]
        seats = self.seats[self.top < 0]
        return Totals(
            *(v.astype(np.int64) for v in (*by_context, *by_top)),
            np.zeros(CONTEXT_WORDS, np.int64),
            int((self.by_word(self.count)[self.top < 0] > 0).sum()),
            int(self.tables[own].sum()),
            int(seats.sum()),
        )

    def sweep(self, totals: Totals, draw, keep: bool) -> Totals:
        """Seat all dishes anew, then those of the parent."""
        x, frequent = self.seated, self.top >= 0
        customers, seats = self.in_parent(), self.seats.copy()
        customers[frequent] = totals.top_tables[self.top[frequent]]
        seats[frequent] = totals.top_parent[self.top[frequent]]
        # What the parent has of the word without these customers.
        others = customers[self.word[x]] - self.tables[x]
        tables = np.minimum(seats[self.word[x]], np.maximum(others, 1))
        total = PARENT_STRENGTH + totals.parent_customers - self.tables[x]
        later = others + 1 - PARENT_DISCOUNT * tables + totals.parent_new
        first = np.where(others > 0, later - 1, totals.parent_new)
        reach = np.concatenate((totals.tables[:CONTEXT_WORDS], self.reach))[self.context[x]]
        start = STRENGTH + DISCOUNT * (reach - self.tables[x])
        law = Law(self.count[x], start, first, DISCOUNT, later, total)
        self.tables[x] = law.draw(draw)
        in_parent = self.in_parent()
        self.seats = np.minimum(self.seats, in_parent)
        self.seats[~frequent] = _parent_tables(in_parent[~frequent], self.seats[~frequent], totals, draw)
        if keep:
            kept = (self.tables[x], in_parent, self.seats)
            self.drawn.append(tuple(v.astype(np.uint32) for v in kept))
        return self.totals()

    def answers(self, asked: Iterator[np.ndarray]) -> Iterator[tuple]:
        """For each array of ascending places: count and tables (over all samples)
        of these pairs; for each of their words the training count, customers and
        tables in the parent by sample, and the tables in its context by sample
        (unless it is one of the most frequent). Small whole numbers pack much
        better than the probabilities. What is the bucket's is made once, so that
        an answer takes no more work than its pairs."""
        tables = len(self.drawn) * np.minimum(self.count, 1).astype(np.uint32)
        tables[self.seated] = np.sum([d[0] for d in self.drawn], axis=0)
        count, of_word = self.count.astype(np.uint32), self.by_word(self.count).astype(np.uint64)
        for x in asked:
            word = self.word[x]
            word = word[_starts(word)]
            parent = [(d[1][word], d[2][word]) for d in self.drawn]
            yield count[x], tables[x], of_word[word], parent, [v[word] for v in self.spread]


# ---- Model ----------------------------------------------------------------------

# What buckets get, and from whom: their own state (what is fixed, and what a sweep
# moves), who asks them for what, what goes to the driver, tables in contexts from
# other buckets (and from the home's own list), and from homes the sums that were
# asked for or all of the own.
LETTERS = "kind string, bucket int, sender int, blob binary"
FIXED, MOVED, ASKS, TOTALS, TABLES, SUMS, OWN = "fixed", "moved", "asks", "totals", "tables", "sums", "own"


def _letters(rows: list[tuple[str, int, int, bytes]]) -> pa.Table:
    kinds = (pa.string(), pa.int32(), pa.int32(), pa.binary())
    columns = zip(*rows) if rows else [()] * 4
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], [f.split()[0] for f in LETTERS.split(", ")])


def _sent(letters: DataFrame) -> DataFrame:
    """Letters written once, by kind."""
    path = scratch_path(letters.sparkSession, "letters")
    letters.write.partitionBy("kind").parquet(path)
    columns = letters.schema[1:].add(letters.schema["kind"])
    return letters.sparkSession.read.schema(columns).parquet(path).select(letters.columns)


def _of(letters: DataFrame, *kinds: str) -> DataFrame:
    return letters.where(F.col("kind").isin(*kinds))


def _requests(sliced: DataFrame, frequent: np.ndarray, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, words, edges, held in zip(
                *(batch[c].to_pylist() for c in ("slice", "words", "edges", "held"))
            ):
                own = Slice(words, edges, held)
                own.pairs(frequent, buckets)
                for b in np.flatnonzero(np.diff(own.cuts)):
                    x = slice(own.cuts[b], own.cuts[b + 1])
                    first = _starts(own.word[x])
                    many = np.diff(np.append(np.flatnonzero(first), len(first)))
                    word = own.word[x][first]
                    context = own.top[own.context[x]]
                    other = context < 0
                    rare, at = np.unique(own.marks[own.context[x][other]], return_inverse=True)
                    context[other] = CONTEXT_WORDS + at
                    blob = pack(
                        _planes(own.marks[word]), own.top[word].astype(np.int16), many.astype(np.uint32),
                        context.astype(np.uint16 if len(rare) < 60_000 else np.uint32), own.count[x],
                        _planes(rare),
                    )
                    yield pa.record_batch(
                        {
                            "bucket": pa.array([b], pa.int32()),
                            "slice": pa.array([number], pa.int64()),
                            "blob": pa.array([blob], pa.binary()),
                        }
                    )

    columns = sliced.select("slice", "words", "edges", "held")
    return columns.mapInArrow(run, "bucket int, slice bigint, blob binary")


def _opened(requests: DataFrame, buckets: int) -> DataFrame:
    """The buckets, with counts added up and who asked for what."""

    def run(table: pa.Table) -> pa.Table:
        number = table["bucket"][0].as_py()
        asked = [unpack(b) for b in table["blob"].to_pylist()]
        named, word = np.unique(np.concatenate([_whole(a[0]) for a in asked]), return_inverse=True)
        top = np.empty(len(named), np.int16)
        top[word] = np.concatenate([a[1] for a in asked])
        word = np.repeat(word, np.concatenate([a[2] for a in asked]))
        others = [_whole(a[5]) for a in asked]
        rare = _distinct(np.concatenate(others))
        same, width = np.arange(CONTEXT_WORDS), CONTEXT_WORDS + len(rare)
        context = np.concatenate(
            [
                np.concatenate((same, CONTEXT_WORDS + np.searchsorted(rare, other)))[a[3]]
                for a, other in zip(asked, others)
            ]
        )
        pair, place = _numbered(word * width + context, len(named) * width)
        summed = np.bincount(place, np.concatenate([a[4] for a in asked])).astype(np.int64)
        context = (pair % width).astype(np.uint32)
        own = Bucket(named, top, np.bincount(pair // width), context, summed, rare, buckets)
        ends = np.cumsum([len(a[3]) for a in asked])
        steps = [np.diff(p, prepend=0).astype(np.uint32) for p in np.split(place, ends[:-1])]
        asks = pack(table["slice"].to_pylist(), steps)
        fixed = [(ASKS, number, number, asks), (FIXED, number, number, own.fixed())]
        return _letters([*fixed, *_written_by(own, number, own.totals(), first=True)])

    return requests.groupBy("bucket").applyInArrow(run, LETTERS)


def _written_by(bucket: Bucket, number: int, totals: Totals, first: bool = False) -> list[tuple]:
    tables = [(TABLES, home, number, content) for home, content in bucket.letters(first)]
    return [(MOVED, number, number, bucket.moved()), (TOTALS, number, number, totals.state()), *tables]


def _context_sums(letters: DataFrame, singles: DataFrame | None) -> DataFrame:
    """Each home adds up the tables in its contexts: the sums go back to who
    has dishes there, and to the home. ``singles`` are the tables of dishes
    with one customer, as the first call gives them."""
    first = singles is None

    def run(table: pa.Table) -> pa.Table:
        home = table["bucket"][0].as_py()
        sent = [unpack(b) for b in table["blob"].to_pylist()]
        named = [_whole(p) for a in sent for p in (a[0], a[2])]
        marks, at = np.unique(np.concatenate(named), return_inverse=True)
        cuts = np.cumsum([len(p) for p in named])[:-1]
        places = np.split(at, cuts)
        sums = np.zeros((2, len(marks)))
        for n, a in enumerate(sent):
            for j in (0, 1):
                sums[j, places[2 * n + j]] += a[2 * j + 1]
        total = sums.sum(axis=0).astype(np.uint32)
        rows = [(OWN, home, home, pack(_planes(marks), total))]
        if first:
            kept, none = sums[0] > 0, np.zeros(0, np.uint64)
            content = pack(_planes(marks[kept]), sums[0, kept].astype(np.uint32), _planes(none), none)
            rows.append((TABLES, home, -1, content))
        for n, sender in enumerate(table["sender"].to_pylist()):
            if len(places[2 * n + 1]):
                rows.append((SUMS, sender, home, pack(total[places[2 * n + 1]])))
        return _letters(rows)

    sent = _of(letters, TABLES)
    if not first:
        sent = sent.unionByName(_of(singles, TABLES))
    return sent.groupBy("bucket").applyInArrow(run, LETTERS)


def _read(table: pa.Table, keep: bool) -> tuple[int, Bucket, bytes | None]:
    """A bucket that has read its letters, and who asked it."""
    number, sums, one = table["bucket"][0].as_py(), {}, {}
    for kind, sender, blob in zip(*(table[c].to_pylist() for c in ("kind", "sender", "blob"))):
        if kind == SUMS:
            sums[sender] = blob
        else:
            one[kind] = blob
    bucket = Bucket(*unpack(one[FIXED]), unpack(one[MOVED]))
    bucket.hear(sums, one.get(OWN), keep)
    return number, bucket, one.get(ASKS)


def _summed(letters: DataFrame, buckets: int, number: int, before: Totals | None = None) -> Totals:
    """Totals of all buckets, added up in two steps; the frequent words' tables
    in the parent are drawn here."""
    groups = max(1, int(buckets**0.5))

    def add(table: pa.Table) -> pa.Table:
        rows = [unpack(t) for t in table["blob"].to_pylist()]
        return pa.table({"totals": pa.array([pack(*map(sum, zip(*rows)))], pa.binary())})

    parts = _of(letters, TOTALS).select(F.pmod("bucket", F.lit(groups)).alias("part"), "blob")
    found = parts.groupBy("part").applyInArrow(add, "totals binary").collect()
    total = Totals(*map(sum, zip(*(unpack(bytes(r.totals)) for r in found))))
    total.top_parent = np.minimum(total.top_tables, 1 if before is None else before.top_parent)
    if before is not None:
        draw = np.random.default_rng((SEED, number))
        total.top_parent = _parent_tables(total.top_tables, total.top_parent, total, draw)
    return total


def _swept(opened: DataFrame, letters: DataFrame, sums: DataFrame, totals: Totals, number: int) -> DataFrame:
    keep = number >= BURN_IN

    def run(table: pa.Table) -> pa.Table:
        # What is read are the tables after the sweep before.
        b, bucket, _ = _read(table, number > BURN_IN)
        # The same bucket draws the same numbers if its task runs again.
        found = bucket.sweep(totals, np.random.default_rng((SEED, number, b)), keep)
        return _letters(_written_by(bucket, b, found))

    heard = _of(opened, FIXED).unionByName(_of(letters, MOVED)).unionByName(_of(sums, SUMS, OWN))
    return heard.groupBy("bucket").applyInArrow(run, LETTERS)


def _answers(opened: DataFrame, letters: DataFrame, sums: DataFrame) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        b, bucket, asks = _read(table, True)
        slices_, steps = unpack(asks)
        places = (np.cumsum(s, dtype=np.int64) for s in steps)
        found = [pack(*answer) for answer in bucket.answers(places)]
        return pa.table(
            {
                "slice": pa.array(slices_, pa.int64()),
                "bucket": pa.array([b] * len(found), pa.int32()),
                "blob": pa.array(found, pa.binary()),
            }
        )

    heard = _of(opened, FIXED, ASKS).unionByName(_of(letters, MOVED)).unionByName(_of(sums, OWN))
    return heard.groupBy("bucket").applyInArrow(run, "slice bigint, bucket int, blob binary")


SCORE = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, score double"
)


def _scored(sliced: DataFrame, answers: DataFrame, frequent, buckets: int, samples: list[Totals]) -> DataFrame:
    first = samples[0]
    trained = int(first.customers.sum())
    unknown = [float(s.parent_probability(np.zeros(1), np.zeros(1))[0]) for s in samples]
    top = [s.parent_probability(s.top_tables, s.top_parent) for s in samples]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        own = Slice(*(left[c][0].as_py() for c in ("words", "edges", "held")))
        own.pairs(frequent, buckets)
        found = {b: unpack(x) for b, x in zip(right["bucket"].to_pylist(), right["blob"].to_pylist())}
        found = [found[b] for b in sorted(found)]
        count, tables = (np.concatenate([f[i] for f in found]) for i in (0, 1))
        pair = count - DISCOUNT * tables / len(samples)
        # Words come in runs, anew in each bucket.
        runs = _starts(own.word)
        runs[own.cuts[:-1][np.diff(own.cuts) > 0]] = True
        run_word = own.word[runs]
        known = np.zeros(len(own.marks))
        known[run_word] = np.concatenate([f[2] for f in found])
        frequent_here = own.top >= 0
        known[frequent_here] = first.top_count[own.top[frequent_here]]
        chance = np.zeros(len(pair))
        for s in range(len(samples)):
            tables = np.zeros(len(own.marks))
            tables[run_word] = np.concatenate([f[4][s] for f in found])
            tables[frequent_here] = samples[s].tables[own.top[frequent_here]]
            p = np.full(len(own.marks), unknown[s])
            seats = (np.concatenate([f[3][s][i] for f in found]) for i in (0, 1))
            p[run_word] = samples[s].parent_probability(*seats)
            p[frequent_here] = top[s][own.top[frequent_here]]
            chance += (STRENGTH + DISCOUNT * tables[own.context]) * p[own.word]
        # Each training occurrence of a word is a customer of its context.
        chance = (pair + chance / len(samples)) / (STRENGTH + known[own.context])
        base = np.log10((known + 1) / (trained + first.vocabulary + 1))
        at = own.place[own.of]
        starts = own.edges[:-1]
        add = lambda v: np.add.reduceat(v, starts)  # noqa: E731  each text has its end
        return pa.table(
            {
                "doc_id": left["doc_ids"][0].values,
                "held_out": left["held"][0].values,
                "n_tokens": np.diff(own.edges),
                "n_known": add((known > 0)[own.line].astype(np.int64)),
                "train_tokens": np.full(len(starts), trained, np.int64),
                "base_score": add(base[own.line]),
                "score": add(np.log10(chance)[at]),
            }
        )

    columns = sliced.select("slice", "doc_ids", "held", "edges", "words")
    return (
        columns.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(run, SCORE)
    )


def score(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Score every row of ``docs`` by a model of the rows that are not held out.

    Words are what lies between ASCII white space, with A-Z in lower case; each
    text ends with an end token. ``score`` is the log10 probability of the text,
    ``base_score`` that of single words with one added to each count. Null and
    empty texts are an end token alone. Rows without an id are scored as well;
    repeated rows train the model as often as they occur. If all rows are held
    out, every token is unknown with probability 1. An empty table gives none.
    """
    with few_texts(docs.sparkSession):
        sliced = written(_sliced(docs, doc_id, text, held_out), "slices")
    tokens = sliced.agg(F.sum("tokens")).first()[0]
    if not tokens:
        return docs.sparkSession.createDataFrame([], SCORE)
    buckets = -(-tokens // BUCKET_TOKENS)
    frequent = _frequent_words(sliced)
    opened = letters = _sent(_opened(_requests(sliced, frequent, buckets), buckets))
    totals, samples = _summed(opened, buckets, 0), []
    free_shuffles(docs.sparkSession)
    singles = sums = _sent(_context_sums(opened, None))
    for number in range(BURN_IN + SAMPLES):
        before = letters, sums
        letters = _sent(_swept(opened, letters, sums, totals, number))
        totals = _summed(letters, buckets, number, totals)
        free_shuffles(docs.sparkSession)
        sums = _sent(_context_sums(letters, singles))
        # What is fixed, what is asked and the tables that do not change are read again.
        drop_written(before[0], only=[f"kind={k}" for k in (MOVED, TOTALS, TABLES)])
        drop_written(before[1], only=[f"kind={k}" for k in (SUMS, OWN)])
        if number >= BURN_IN:
            samples.append(totals)
    answers = written(_answers(opened, letters, sums), "answers")
    for table in (opened, letters, singles, sums):
        drop_written(table)
    free_shuffles(docs.sparkSession)
    return _scored(sliced, answers, frequent, buckets, samples)
