"""Similarity joins, components, counting and sharding against plain versions."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidepool.llm import backoff_automaton, e8, extendible, lattice_lsh, queries, trie_join
from tidepool.llm.common import ship_package
from tidepool.llm.components import connected_components

LONG = " ".join(f"w{i % 977}x{i // 977}" for i in range(30_000))


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def plain_components(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# ------------------------------------------------------------------ components
@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(4)
    edges = {"path": [(i, i + 1) for i in range(300)],
             "star": [(0, i) for i in range(1, 300)] + [(1000, 1001)],
             "random": [(rng.randrange(400), rng.randrange(400)) for _ in range(250)],
             "none": []}[shape]
    rng.shuffle(edges)
    df = spark.createDataFrame([*edges, *edges[:5], (7, 7), (None, 3)], "a bigint, b bigint")
    got = {r.node: r.component for r in connected_components(df.repartition(7)).collect()}
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert got == plain_components(nodes, [e for e in edges if e[0] != e[1]])


# ------------------------------------------------------------- n-gram Jaccard
def plain_sets(rows, k=5):
    out = []
    for doc, text in rows:
        ws = (text or "").encode().lower().split()
        n = min(k, len(ws))
        out.append((doc, frozenset(tuple(ws[i:i + n]) for i in range(len(ws) - n + 1)) if ws else frozenset()))
    return out


def plain_jaccard(rows):
    sets = plain_sets(rows)
    links, edges = Counter(), []
    for i, (a, x) in enumerate(sets):
        for b, y in sets[i + 1:]:
            inter = len(x & y)
            if x and y and 100 * inter >= 80 * (len(x) + len(y) - inter):
                links[a] += 1
                links[b] += 1
                edges.append((a, b))
    comp = plain_components([d for d, _ in sets], edges)
    return sorted((d, len(s), links[d], comp[d]) for d, s in sets)


def jaccard_rows():
    rng = random.Random(11)
    voc = [f"v{i}" for i in range(60)]
    rows = [(0, None), (1, ""), (2, " \n"), (3, "one two"), (4, "ONE two"), (5, "one two three"),
            (6, LONG), (7, LONG + " tail"), (8, "É a b c d e"), (9, "é a b c d e")]
    base = [[rng.choice(voc) for _ in range(rng.randint(6, 70))] for _ in range(12)]
    for i in range(10, 210):
        ws = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            ws[rng.randrange(len(ws))] = rng.choice(voc)
        rows.append((i, " ".join(ws)))
    return rows


@pytest.mark.parametrize("unit_tokens", [150_000, 150])
def test_near_duplicates_equal_the_plain_version(spark, unit_tokens):
    rows = jaccard_rows()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows],
                               "doc_id bigint, text string, cls string, n_links int").repartition(5)
    got = trie_join.near_duplicates(df, unit_tokens=unit_tokens).collect()
    assert sorted((r.doc_id, r.n_shingles, r.n_links, r.component_id) for r in got) == plain_jaccard(rows)


def test_near_duplicates_edge_tables(spark):
    df = spark.createDataFrame([(1, "a b c d e f")] * 3 + [(None, "q r"), (5, None)], "doc_id bigint, text string")
    got = Counter((r.doc_id, r.n_shingles, r.n_links, r.component_id)
                  for r in trie_join.near_duplicates(df).collect())
    assert got == Counter({(1, 2, 2, 1): 3, (None, 1, 0, None): 1, (5, 0, 0, 5): 1})
    assert trie_join.near_duplicates(df.limit(0)).count() == 0


def test_sets_with_one_64_bit_key_keep_their_own_links():
    """Classes whose digests agree in the first eight bytes stay two classes."""
    a, b, c = bytes(16), bytes(8) + b"\1" * 8, b"\2" * 16
    one, two = np.arange(10, 20, dtype=np.uint64), np.arange(50, 60, dtype=np.uint64)
    sets = [(a, one), (b, two), (c, np.concatenate([one, two]))]
    part = (trie_join._keys([k for k, _ in sets]).tobytes(),
            np.array([len(s) for _, s in sets], np.uint32).tobytes(),
            np.array([len(s) for _, s in sets], np.uint32).tobytes(),
            np.concatenate([s for _, s in sets]).tobytes())
    shared = trie_join._shared_in_bucket([part], 1)
    out = pa.concat_tables([pa.Table.from_batches([x]) for x in trie_join._assemble(1, 10)([shared])]).to_pydict()
    got = {k: set(np.frombuffer(t, np.uint64).tolist()) for k, t in zip(out["cls"], out["tokens"], strict=True)}
    assert got == {k: set(s.tolist()) for k, s in sets}


def test_rows_are_told_apart_by_id_and_text(spark):
    near = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    rows = [(1, near), (2, near + " more"), (2, "a different clean text of its own"),
            (3, "text a stands here with words enough"), (3, "text b is something else altogether now"),
            (None, near), (None, "no id and only once"), (4, "again and again the same row"),
            (4, "again and again the same row"), (5, None), (5, None), (6, " "), (7, LONG), (None, LONG), (8, LONG + " end")]
    df = spark.createDataFrame([(i, t, n % 2, "x") for n, (i, t) in enumerate(rows)],
                               "doc_id bigint, text string, stays int, text_key string")
    out = trie_join.one_of_each(df)
    assert out.columns == df.columns
    got = Counter((r.doc_id, r.text) for r in out.collect())
    gone = {(2, near + " more"), (None, near), (None, LONG), (8, LONG + " end")}
    want = Counter(r for r in rows if r not in gone)
    want[(4, rows[7][1])] = 1
    assert got == want
    assert trie_join.one_of_each(df.limit(0)).count() == 0
    again = {r.doc_id: r.component_id for r in trie_join.near_duplicates(df.where("doc_id in (1, 3, 8)")).collect()}
    assert again == {1: 1, 3: 3, 8: 8}


def test_tree_join_finds_every_pair():
    rng = np.random.default_rng(3)
    for _ in range(30):
        base = rng.integers(0, 300, 40)
        sets = []
        for _ in range(25):
            s = base.copy()
            s[rng.integers(0, 40, rng.integers(0, 8))] = rng.integers(0, 300)
            sets.append(np.unique(s).astype(np.uint64))
        sizes = np.array([len(s) for s in sets])
        everyone = np.ones(len(sets), bool)
        got = {(a, int(b)) for a, linked in trie_join.join_sets(sets, sizes, everyone, everyone) for b in linked}
        want = {(i, j) for i in range(25) for j in range(25) if i != j
                and 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
        assert got == want


# ----------------------------------------------------------------- embeddings
def plain_links(rows, cut=0.95):
    use = {i: np.array(v, float) / np.abs(v).max() for i, v in rows
           if v and all(x is not None and math.isfinite(x) for x in v) and any(v)}  # scaled: no overflow
    n, edges = Counter(), []
    ids = sorted(use)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            x, y = use[a], use[b]
            if len(x) == len(y) and x @ y >= cut * math.sqrt((x @ x) * (y @ y)):
                n[a] += 1
                n[b] += 1
                edges.append((a, b))
    comp = plain_components([i for i, _ in rows], edges)
    return sorted((i, n[i], comp[i], comp[i] == i) for i, _ in rows)


def test_lattice_links_equal_brute_force(spark):
    rng = np.random.default_rng(9)
    rows = [(0, None), (1, []), (2, [0.0] * 16), (3, [1.0] * 15 + [None]), (4, [float("nan")] * 16),
            (5, [float("inf")] * 16), (6, [1.0, 2.0]), (7, [2.0, 4.0]), (8, [1e200] * 16), (9, [1e-200] * 16)]
    base = rng.normal(size=(30, 16))
    for i in range(10, 400):
        v = base[rng.integers(30)] + rng.normal(size=16) * rng.choice([0, .05, .15, .25])
        rows.append((i, [float(x) for x in v * rng.choice([1.0, 3.0])]))
    df = spark.createDataFrame([(i, v, 5) for i, v in rows], "vec_id bigint, embedding array<double>, rep int")
    got = lattice_lsh.near_duplicates(df).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == plain_links(rows)


def test_lattice_edge_tables(spark):
    df = spark.createDataFrame([(4, [1.0, 0.0]), (4, [1.0, 0.0]), (2, [1.0, 0.0]), (None, [1.0, 0.0])],
                               "vec_id bigint, embedding array<float>")
    got = Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in lattice_lsh.near_duplicates(df).collect())
    assert got[4, 2, 2, False] == 2 and got[2, 2, 2, True] == 1 and sum(got.values()) == 4
    assert lattice_lsh.near_duplicates(df.limit(0)).count() == 0


def test_recall_at_the_cut():
    """Pairs at a cosine of exactly 0.95 meet in one of the tables."""
    rng = np.random.default_rng(0)
    a = rng.normal(size=(2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    u = rng.normal(size=a.shape)
    u -= (u * a).sum(1, keepdims=True) * a
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    b = 0.95 * a + math.sqrt(1 - 0.95 ** 2) * u
    found = np.zeros(len(a), bool)
    for t in range(lattice_lsh.TABLES):
        one, two = np.ones(len(a), bool), np.ones(len(a), bool)
        for k in range(lattice_lsh.BLOCKS):
            m = lattice_lsh._matrix(1, 64, t, k, lattice_lsh.SCALE)
            ca = e8.numbers(e8.cells(a @ m, lattice_lsh.PROBES), k)
            cb = e8.numbers(e8.cells(b @ m, lattice_lsh.PROBES), k)
            one &= (ca[:, :1] == cb).any(1)
            two &= (cb[:, :1] == ca).any(1)
        found |= one | two
    assert found.mean() > 0.995


def test_e8_points_are_nearest():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 8)) * 2
    near = e8.cells(x, 240)
    assert (((x[:, None] - near) ** 2).sum(-1).argmin(1) == 0).all()
    home = near[:, 0]
    assert (((home * 2) % 2).std(axis=1) == 0).all() and (home.sum(axis=1) % 2 == 0).all()
    assert len(e8.SHORTEST) == 240 and np.allclose((e8.SHORTEST ** 2).sum(1), 2)


# ----------------------------------------------------------------- LM scoring
def lm_rows():
    rng = random.Random(6)
    voc = [f"t{i}" for i in range(40)]
    rows = [(0, None), (1, ""), (2, LONG), (3, "T1 t1\tt2"), (3, "T1 t1\tt2")]
    for i in range(4, 200):
        at, ws = rng.randrange(40), []
        for _ in range(rng.randint(0, 30)):
            at = (at + rng.choice([1, 1, 1, 2, 7])) % 40
            ws.append(voc[at])
        rows.append((i, " ".join(ws)))
    return rows


def test_base_scores_are_exact(spark):
    rows = lm_rows()
    df = spark.createDataFrame([(i, t, zlib.crc32(str(i).encode()) % 7 != 2, 1) for i, t in rows],
                               "doc_id bigint, text string, train boolean, key int").repartition(4)
    got = backoff_automaton.score_documents(df).collect()
    tokens = {i: [*(t or "").encode().lower().split(), None] for i, t in rows}
    c = Counter(w for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2 for w in tokens[i])
    n, v = sum(c.values()), len(c)
    assert len(got) == len(rows)
    for r in got:
        ws = tokens[r.doc_id]
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(c[w] > 0 for w in ws), n)
    held = [r for r in got if not r.train]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def fitted(spark, rows, tau, order=3):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    c = Counter(w for _, t in rows for w in [*(t or "").encode().lower().split(), backoff_automaton.END])
    n = sum(c.values())
    often = sorted([w for w in c if c[w] >= max(1, tau * n)], key=lambda w: (-c[w], w))
    hashes = np.array([backoff_automaton.xxhash.xxh64_intdigest(w) for w in often], np.uint64)
    counts = np.array([c[w] for w in often])
    return backoff_automaton.fit(df, hashes, counts, n, len(c), tau=tau, order=order, discount=0.75), c


def plain_score(rows, ws, c, m, tau, d=0.75):
    """The model's definition, on word lists."""
    end = backoff_automaton.END
    n = sum(c.values())
    keep = max(1, tau * n)

    def sym(w):
        return w if c[w] >= keep else "RARE"

    seqs = [[sym(w) for w in [end, *(t or "").encode().lower().split(), end]] for _, t in rows]
    total = Counter()
    for w, k in c.items():
        total[sym(w)] += k
    types = {sym(w) for w in c} | {"RARE"}
    bi = {g: k for g, k in Counter(x for s in seqs for x in zip(s, s[1:])).items() if k >= keep}
    tri = {g: k for g, k in Counter(x for s in seqs for x in zip(s, s[1:], s[2:])).items()
           if k >= keep and g[:2] in bi and g[1:] in bi}

    def p1(w):
        return (total[w] + 1) / (n + len(types))

    def p2(u, w):
        own = {g: k for g, k in bi.items() if g[0] == u}
        left = max(1e-12, 1 - sum(k - d for k in own.values()) / total[u]) if own else 1.0
        return (bi[u, w] - d) / total[u] * ((u, w) in bi) + left * p1(w) if (u, w) in bi else left * p1(w)

    def p3(u, v, w):
        if (u, v) not in bi:
            return p2(v, w)
        own = {g: k for g, k in tri.items() if g[:2] == (u, v)}
        h = bi[u, v]
        left = max(1e-12, 1 - sum(k - d for k in own.values()) / h) if own else 1.0
        return ((tri[u, v, w] - d) / h if (u, v, w) in tri else 0) + left * p2(v, w)

    seq = [sym(w) for w in [end, *ws, end]]
    out = math.log10(p2(seq[0], seq[1]))
    for u, v, w in zip(seq, seq[1:], seq[2:]):
        out += math.log10(p3(u, v, w))
    return out + seq[1:].count("RARE") * -math.log10(m.rare_types + 1)


@pytest.mark.parametrize("tau", [1e-3, 0.01, 0.05, 0.5])  # at the last, even the end is rare
def test_automaton_equals_the_definition(spark, tau):
    rows = [r for r in lm_rows() if r[1] != LONG]
    m, c = fitted(spark, rows, tau)
    a = backoff_automaton.Automaton(m)
    for _, t in [*rows[:40], (0, "t3 unseen t4 t5 t6 unseen unseen")]:
        ws = (t or "").encode().lower().split()
        assert a.score(ws) == pytest.approx(plain_score(rows, ws, c, m, tau), rel=1e-9), t
    texts = [(t or "").encode().lower().split() for _, t in rows]
    end = a.start - 1
    ids = [end, *(i for ws in texts for i in (*map(a.symbols.__getitem__, ws), end))]
    ends = np.cumsum([0, *(len(ws) + 1 for ws in texts)])
    assert a.score_run(np.array(ids), ends) == pytest.approx([a.score(ws) for ws in texts], rel=1e-9)


def test_probabilities_add_up(spark):
    rows = [r for r in lm_rows() if r[1] != LONG]
    m, _ = fitted(spark, rows, 0.005)
    a = backoff_automaton.Automaton(m)
    for state in range(len(a.fail)):
        total = 0.0
        for s in range(len(m.counts)):
            at, w = state, 0.0
            while (arc := a.arcs.get((at << backoff_automaton.SYMBOL_BITS) | s)) is None:
                w += a.back[at]
                at = a.fail[at]
            total += 10 ** (w + arc[1])
        assert total == pytest.approx(1.0, abs=1e-9)


def test_scoring_edge_tables(spark):
    df = spark.createDataFrame([(1, "a b", False), (None, None, None)], "doc_id bigint, text string, train boolean")
    got = backoff_automaton.score_documents(df).collect()
    assert {(r.doc_id, r.n_tokens, r.n_known, r.train_tokens) for r in got} == {(1, 3, 0, 0), (None, 1, 0, 0)}
    assert all(r.base_score == 0.0 and math.isfinite(r.score) for r in got)
    assert backoff_automaton.score_documents(df.limit(0)).count() == 0


def test_kept_ngrams_do_not_shrink_with_the_corpus(spark):
    """A rare word's n-grams count however much other text there is: the scores
    equal the automaton over all words and all n-grams seen twice."""
    rows = [r for r in lm_rows() if r[1] != LONG]
    rows += [(i, "common words " * 400) for i in range(1000, 1400)]  # a share of 4e-6 is 1.3 of these tokens
    rows += [(2000 + i, "rarely seen pair") for i in range(2)]
    held = [(3000, "rarely seen pair"), (3001, "rarely unseen pair")]
    df = spark.createDataFrame([(i, t, True) for i, t in rows] + [(i, t, False) for i, t in held],
                               "doc_id bigint, text string, train boolean").repartition(4)
    c = Counter(w for _, t in rows for w in [*(t or "").encode().lower().split(), backoff_automaton.END])
    n = sum(c.values())
    hashes = np.array([backoff_automaton.xxhash.xxh64_intdigest(w) for w in c], np.uint64)
    train = spark.createDataFrame(rows, "doc_id bigint, text string")
    m = backoff_automaton.fit(train, hashes, np.array(list(c.values())), n, len(c), tau=2 / n, order=3, discount=0.75)
    a = backoff_automaton.Automaton(m)
    for tau in (4e-6, 0.01, 0.9):  # what is broadcast changes no score
        got = backoff_automaton.score_documents(df, tau=tau).collect()
        texts = dict(rows + held)
        assert len(got) == len(rows) + len(held)
        for r in got:
            ws = (texts[r.doc_id] or "").encode().lower().split()
            assert r.score == pytest.approx(a.score(ws), rel=1e-8), (tau, ws[:5])


def test_what_is_dealt_stays_small(spark, monkeypatch):
    """All that scoring deals among tasks, in bytes a token."""
    from pyspark.sql.classic.dataframe import DataFrame

    rng, sent = random.Random(9), []
    words = [f"w{rng.randrange(40_000)}" for _ in range(300_000)]
    df = spark.createDataFrame([(i, " ".join(words[i * 500:i * 500 + 500]), True) for i in range(600)],
                               "doc_id bigint, text string, train boolean").repartition(2)
    deal = DataFrame.repartition

    def recorded(self, *by):
        sizes = [F.sum(F.octet_length(c)) for c, kind in self.dtypes if kind == "binary"]
        sent.extend(x or 0 for x in self.agg(*sizes).first())
        return deal(self, *by)

    monkeypatch.setattr(DataFrame, "repartition", recorded)
    assert backoff_automaton.score_documents(df).count() == 600
    assert 0 < sum(sent) / len(words) < 20


def test_what_is_met_often_costs_little_and_is_dealt_once(spark, monkeypatch):
    """Where few words make up most of a text its questions are short, and answers
    already dealt to the chunks are not shuffled again."""
    from pyspark.sql.classic.dataframe import DataFrame

    rng, sent = np.random.default_rng(9), []
    words = [f"w{k}" for k in (1 / rng.random(300_000) ** 1.2).astype(int)]
    df = spark.createDataFrame([(i, " ".join(words[i * 500:i * 500 + 500]), True) for i in range(600)],
                               "doc_id bigint, text string, train boolean").repartition(2)
    deal = DataFrame.repartition

    def recorded(self, *by):
        if by[1] == "bucket":
            sizes = [F.sum(F.octet_length(c)) for c, kind in self.dtypes if kind == "binary"]
            sent.append(sum(x or 0 for x in self.agg(*sizes).first()))
        return deal(self, *by)

    monkeypatch.setattr(DataFrame, "repartition", recorded)
    scored = backoff_automaton.score_documents(df)
    assert scored.count() == 600
    assert len(sent) == 3 and 0 < sum(sent[1:]) / len(words) < 0.2, sent
    assert "Exchange" not in scored._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("least", [1, 3])
def test_least_count_holds_over_chunks(spark, least):
    """Counts come from many chunks, and what follows a history in other chunks counts too."""
    rows = [r for r in lm_rows() if r[1] != LONG]
    df = spark.createDataFrame([(i, t, True) for i, t in rows], "doc_id bigint, text string, train boolean").repartition(8)
    end = backoff_automaton.END
    seqs = {i: [end, *(t or "").encode().lower().split(), end] for i, t in rows}
    c = Counter(w for i, _ in rows for w in seqs[i][1:])
    n = sum(c.values())
    grams = [Counter(g for i, _ in rows for g in zip(*(seqs[i][k:] for k in range(m)))) for m in (2, 3)]
    kept = [{(w,): k for w, k in c.items()}, *({g: k for g, k in x.items() if k >= least} for x in grams)]
    after = defaultdict(list)
    for x in kept[1:]:
        for g, k in x.items():
            after[g[:-1]].append(k)

    def p(h, w):
        if not h:
            return (c[w] + 1) / (n + len(c) + 1)
        own = kept[len(h) - 1].get(h, 0)
        if not own:
            return p(h[1:], w)
        left = max(1e-12, 1 - sum(k - 0.75 for k in after[h]) / own)
        k = kept[len(h)].get((*h, w), 0)
        return (k - 0.75 if k else 0) / own + left * p(h[1:], w)

    for r in backoff_automaton.score_documents(df, min_count=least).collect():
        s = seqs[r.doc_id]
        want = sum(math.log10(p(tuple(s[max(0, i - 2):i]), s[i])) for i in range(1, len(s)))
        assert r.score == pytest.approx(want, rel=1e-8)


# -------------------------------------------------------------------- sharding
def plain_shards(rows, limit):
    copies = defaultdict(int)
    todo = []
    for key, text in sorted(rows, key=repr):
        n = len((text or "").encode())
        copies[key, n] += 1
        todo.append((key, n, copies[key, n] - 1))

    import hashlib

    def bits(key, n, copy):
        text = f"{chr(0) + 'null' if key is None else key}|{n}|{copy}"
        return bin(int(hashlib.md5(text.encode()).hexdigest(), 16))[2:].zfill(128)

    out = []

    def split(bucket, prefix):
        size = sum(n for _, n, _, _ in bucket)
        if size <= limit or len(prefix) == 120:
            out.extend((k, c, n, prefix, size, size > limit) for k, n, c, _ in bucket)
            return
        for b in "01":
            part = [r for r in bucket if r[3][len(prefix)] == b]
            if part:
                split(part, prefix + b)

    split([(k, n, c, bits(k, n, c)) for k, n, c in todo], "")
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit", [10_000_000, 4000, 300])
def test_shards_equal_the_plain_version(spark, limit):
    rng = random.Random(8)
    rows = [(i, "é" * rng.randint(0, 60)) for i in range(300)]
    rows += [(7, "same text")] * 150 + [(None, "x")] * 20 + [(8, None), (400, "y" * 1000)]
    df = spark.createDataFrame([(*r, "s") for r in rows], "doc_id bigint, text string, shard string")
    got = extendible.assign(df, limit_bytes=limit).collect()
    assert sorted([(r.key, r["copy"], r.n_bytes, r.shard, r.shard_bytes, r.oversized) for r in got],
                  key=repr) == plain_shards(rows, limit)


def test_shards_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert extendible.assign(df).count() == 0


def test_written_shards_hold_every_row(spark, tmp_path):
    rows = [(i, "t" * (i % 50), i % 3) for i in range(200)] + [(5, "same", 1)] * 40 + [(5, "emas", 2)] * 9
    df = spark.createDataFrame(rows, "doc_id bigint, text string, other int")
    path = str(tmp_path / "shards")
    extendible.write(df, path, limit_bytes=600)
    back = spark.read.parquet(path)
    assert Counter((r.doc_id, r.text, r.other) for r in back.collect()) == Counter(rows)
    sizes = back.groupBy("shard").agg(F.sum(F.octet_length("text")).alias("n")).collect()
    assert len(sizes) > 5 and max(r.n for r in sizes) <= 600


# ------------------------------------------------- whole queries on the tables
def test_toxicity_query_on_held_out_rows(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op8_toxicity"](spark, SF_SMALL).collect()}
    docs = pq.read_table(f"{SF_SMALL}/documents.parquet").column("doc_id").to_pylist()
    assert sorted(got) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
