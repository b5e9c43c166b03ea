"""Operator 13 against plain scoring of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidepool.llm import nra_search
from tidepool.llm.common import ship_package

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def plain_terms(text):
    return [t.translate(UPPER) for t in TERM.findall(text or "")]


def plain(docs, items, k):
    own = [(i, Counter(plain_terms(t))) for i, t in docs]
    own = [(i, c) for i, c in own if c]
    n_docs, total = len(own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in own:
            m = 50 + 50 * sum(c.values()) * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                    for t in set(plain_terms(text)) if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        for r, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1):
            out.append((item, r, i, -s))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("k,chunk,block", [(1, 7, 1 << 20), (5, 50, 40), (50, 3, 200), (1000, 8192, 1 << 20)])
def test_equals_plain_scoring(spark, k, chunk, block):
    ship_package(spark)
    rng = random.Random(k)
    words = ["the", "a", "É", "é", "Of", "x1", "zeta", "rare", "naïve", "中文"] + [f"w{i}" for i in range(30)]

    def text(n):
        return rng.choice([" ", "\n", ".-"]).join(rng.choice(words[:rng.choice([3, 10, 40])]) for _ in range(n))

    docs = [(i, text(rng.randint(0, 30))) for i in range(400)]
    docs += [(1000 + i, "The rare zeta of the W1") for i in range(60)]  # ties: copies
    docs += [(5, "zeta zeta"), (5, "zeta zeta"), (None, "rare w2"), (None, None), (77, ""), (78, "...")]
    items = [(i, text(rng.randint(1, 9))) for i in range(12)]
    items += [(3, "rare ZETA"), (None, "w1 w2"), (90, None), (91, "nowhere else"), (92, "?!")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    q = spark.createDataFrame(items, "item_id bigint, text string")
    got = nra_search.rank(d, q, k=k, chunk_docs=chunk, block_bytes=block)
    assert rows(got) == plain(docs, items, k)


def test_edge_tables(spark):
    ship_package(spark)
    d = spark.createDataFrame([(1, "one two", 9, 8)], "doc_id int, text string, score int, term int")
    q = spark.createDataFrame([("q", "TWO", 1)], "item_id string, text string, rank int")
    assert [r.asDict() for r in nra_search.rank(d, q).collect()] == [
        {"item_id": "q", "rank": 1, "doc_id": 1, "score": math.floor(1000 * math.log(4 / 3)) * (10**9 // 3000)}]
    assert nra_search.rank(d.limit(0), q).count() == 0
    assert nra_search.rank(d, q.limit(0)).count() == 0
    long = spark.createDataFrame([(1, "two " * 300_000), (2, "one")], "doc_id bigint, text string")
    assert rows(nra_search.rank(long, q.drop("rank"))) == plain([(1, "two " * 300_000), (2, "one")], [("q", "TWO")], 50)


def test_reading_stops_before_the_lists_end():
    """With the best already known, a chunk that can't reach them is left after its first step."""
    n = 20_000
    row = {"ids": np.arange(n).tobytes(), "no_id": np.zeros(n, np.int8).tobytes(),
           "length": np.full(n, 10).tobytes(), "doc": np.tile(np.arange(n, dtype=np.int32), 2).tobytes(),
           "term": np.repeat(np.arange(2, dtype=np.int32), n).tobytes(), "tf": np.ones(2 * n, np.int64).tobytes()}
    lists = nra_search.Lists(row, n, 10 * n, 2)

    class Counted(np.ndarray):
        read = 0

        def __getitem__(self, at):
            if isinstance(at, np.ndarray):
                Counted.read += len(at)
            return super().__getitem__(at)

    lists.impact = lists.impact.view(Counted)
    docs, _ = nra_search.search(lists, np.array([0, 1]), np.array([5, 7]), 2, np.array([10**9, 10**9]))
    assert len(docs) == 0 and Counted.read < 1000
