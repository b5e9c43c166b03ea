"""Encoding, decontamination, toxicity and quality against plain versions."""

import gc
import hashlib
import math
import random
import re
import shutil
import weakref
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tidepool.llm import ftrl, kneser_ney, sentencepiece_bpe, trie_join, wu_manber
from tidepool.llm.common import Hasher, ship_package

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LONG = "abc def " * 20_000


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece_bpe.load(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)


PARTS = ["a", "b", "the", "  ", " ", "\n", "\t", "\r", "é", "ß", "▁", "　", "中", "😀", "\x00", "ing",
         "tion", "́", "1", "2026", ".", "...", ",", "(", ")", "_", "²", "'s", "\xa0", "<s>", "</s>",
         "<0x0A>", "Z", "http://", "ñ", ");\r", "aaaa", "▁▁"]


def test_encoding_equals_the_library(pieces):
    own, lib = pieces
    rng = random.Random(7)
    for _ in range(6000):
        s = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12)))
        ids = lib.encode(s)
        assert own.encode(s) == ids, s
        assert own.decode(ids) == lib.decode(ids), s


@pytest.mark.parametrize("word", ["", "a", "the", "中", "😀", "."])
def test_runs_of_spaces(pieces, word):
    own, lib = pieces
    for n in range(40):
        assert own.encode(" " * n + word) == lib.encode(" " * n + word)


def test_one_word_without_cuts(pieces):
    own, lib = pieces
    s = "abcdefghij" * 3000
    assert own.encode(s) == lib.encode(s)


def test_decoding_any_ids(pieces):
    own, lib = pieces
    rng = random.Random(8)
    for _ in range(2000):
        ids = [rng.randrange(32000) if rng.random() < .5 else rng.randrange(3, 259)
               for _ in range(rng.randint(0, 8))]
        assert own.decode(ids) == lib.decode(ids), ids


def test_prefix_table_is_the_encoding_of_each_prefix(pieces):
    own, lib = pieces
    s = "▁internationalization"
    table = own.last_tokens(s)
    for i in range(1, len(s)):
        assert table[i] == lib.encode(s[1:i + 1])[-1]


def test_encode_documents_rows(spark, pieces):
    _, lib = pieces
    texts = [None, "", " ", "hello world", "hello world", LONG, "x\x00y ▁ z"]
    df = spark.createDataFrame([(i, t, "k", 5) for i, t in enumerate(texts)] + [(None, "a", "k", 5)],
                               "doc_id bigint, text string, decoded string, n_tokens int")
    got = sentencepiece_bpe.encode_documents(df, MODEL, with_ids=True).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        ids = lib.encode(r.text or "")
        assert list(r.ids) == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded == lib.decode(ids)
    empty = sentencepiece_bpe.encode_documents(df.limit(0), MODEL)
    assert empty.count() == 0 and empty.columns[-1] == "decoded"


# ------------------------------------------------------------- decontamination
def plain_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain_contamination(docs, items, window=13):
    out = []
    wins = []
    for item, text in items:
        ws = plain_words(text)
        k = min(window, len(ws))
        wins += [(str(item) if item is not None else "null", ws[i:i + k]) for i in range(len(ws) - k + 1) if k]
    for doc, text in docs:
        ws, hit, found = plain_words(text), set(), set()
        for item, w in wins:
            for i in range(len(ws) - len(w) + 1):
                if ws[i:i + len(w)] == w:
                    hit.update(range(i, i + len(w)))
                    found.add(item)
        out.append((doc, len(ws), len(hit), tuple(sorted(found)), bool(hit) and 20 * len(hit) >= len(ws)))
    return sorted(out, key=repr)


def contamination_case():
    rng = random.Random(5)
    voc = [f"w{i}" for i in range(30)] + ["É", "ça"]
    items = [(i, " ".join(rng.choice(voc) for _ in range(n))) for i, n in enumerate([20, 13, 14, 5, 1, 2, 40])]
    items += [(7, items[0][1]), (8, None), (9, " ,;- "), (10, items[1][1].upper() + "!"), (0, items[2][1])]
    docs = [(0, None), (1, ""), (2, "?!"), (3, LONG + items[0][1])]
    for i in range(4, 60):
        ws = [rng.choice(voc) for _ in range(rng.randint(0, 60))]
        if i % 2:
            ws[rng.randint(0, len(ws)):0] = [re.sub(r"\s", "-", rng.choice(items)[1] or "")]
        docs.append((i, " ".join(ws)))
    return docs + [docs[5], (None, items[6][1])], items


@pytest.mark.parametrize("shard_bytes", [1 << 20, 60])
def test_contamination_equals_the_plain_version(spark, shard_bytes):
    docs, items = contamination_case()
    d = spark.createDataFrame([(*r, 1, 2) for r in docs], "doc_id bigint, text string, items int, n_words int")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    got = wu_manber.contamination(d, b, shard_bytes=shard_bytes, carry=True).collect()
    rows = sorted([(r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in got], key=repr)
    assert rows == plain_contamination(docs, items)
    assert all(r["row"].n_words == 2 for r in got)


def test_contamination_without_rows(spark):
    docs, items = contamination_case()
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    none = wu_manber.contamination(d, b.limit(0)).collect()
    assert len(none) == len(docs) and not any(r.contaminated or r.n_hit for r in none)
    assert wu_manber.contamination(d.limit(0), b).count() == 0


def test_shift_tables_jump():
    strings = {tuple(f"w{i}".encode() for i in range(k, k + 13)): ["x"] for k in range(3)}
    m = wu_manber.Matcher(13, strings)
    assert m.default == 12
    text = [b"z"] * 1000 + list(next(iter(strings))) + [b"z"] * 7
    assert [at for at, _ in m.search(text)] == [1000]


# -------------------------------------------------------------------- toxicity
def toxic_rows():
    rng = random.Random(3)
    voc = [f"word{i}" for i in range(200)]
    rows = []
    for i in range(600):
        ws = [rng.choice(voc) for _ in range(rng.randint(3, 40))]
        toxic = i % 5 == 0
        if toxic:
            ws[rng.randint(0, len(ws)):0] = [rng.choice(["grumble", "snarkish", "grumbled"])]
        rows.append((i, " ".join(ws), int(toxic)))
    return rows


def test_toxicity_on_held_out_rows(spark):
    rows = toxic_rows()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 3], "doc_id bigint, toxic int")
    got = {r.doc_id: r for r in ftrl.score(docs, ftrl.train(docs, labels)).collect()}
    held = [(got[i].score, y, got[i].predicted) for i, _, y in rows if i % 3 == 0]
    pos, neg = [s for s, y, _ in held if y], [s for s, y, _ in held if not y]
    auc = np.mean([(p > n) + .5 * (p == n) for p in pos for n in neg])
    assert auc > 0.97
    assert all((p == 1) == (s >= 0.3) for s, _, p in held)


def test_toxicity_edge_rows(spark):
    rows = toxic_rows()[:100]
    docs = spark.createDataFrame([(i, t, 9) for i, t, _ in rows] +
                                 [(None, None, 9), (1000, "", 9), (1001, LONG, 9), (0, rows[0][1], 9)],
                                 "doc_id bigint, text string, score int")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(0, 1), (0, 0), (5, None), (None, 1), (1, 7)],
                                   "doc_id bigint, toxic int")
    w = ftrl.train(docs, labels)
    got = ftrl.score(docs, w).collect()
    assert len(got) == 104 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (None, 1000)}) == 1
    again = ftrl.train(docs.repartition(5), labels.repartition(3))
    assert np.allclose(w, again)
    none = ftrl.train(docs, labels.limit(0))
    assert not none.any() and ftrl.score(docs, none).first().score == 0.5
    assert ftrl.score(docs.limit(0), w).count() == 0


def test_toxicity_of_very_long_texts(spark):
    """Length alone flags no clean text, and hides no toxic one."""
    rows = toxic_rows()
    new = " ".join(f"novel{i * 7919}" for i in range(150_000))
    held = [(5000, new, 0), (5001, new + " " + rows[1][1], 0), (5002, f"{new} grumble snarkish grumbled {new}", 1)]
    docs = spark.createDataFrame([r[:2] for r in rows + held], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")
    w, seen = ftrl.fit(docs, labels)
    got = {r.doc_id: r for r in ftrl.score(docs, w, seen).collect()}
    assert [got[i].predicted for i, _, _ in held] == [0, 0, 1]
    assert got[5000].score == pytest.approx(ftrl.probability(float(w[0])))


def test_weights_equal_plain_ftrl(spark):
    """Coordinate by coordinate with ordinary floats: every shard from the common
    state, their changes averaged after each round."""
    rows = toxic_rows()[:80]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")
    dims, shards, rounds = 1 << 17, 3, 4
    got = ftrl.fit(docs, labels, dims=dims, shards=shards, rounds=rounds)[0]
    where = {r.doc_id: (r.shard, r.ord) for r in docs.withColumn("ord", F.md5(F.col("doc_id").cast("string").cast("binary")))
             .withColumn("shard", F.expr(f"pmod(xxhash64(ord), {shards})")).collect()}
    a, b = Hasher(), Hasher()
    deals = {}
    for i, t, y in sorted(rows, key=lambda r: where[r[0]][1]):
        deals.setdefault(where[i][0], []).append((ftrl.features(t, a, b, dims).tolist(), y))
    def weight(z, n):
        if abs(z) <= ftrl.L1:
            return 0.0
        return -(z - (ftrl.L1 if z > 0 else -ftrl.L1)) / ((ftrl.BETA + n ** 0.5) / ftrl.ALPHA + ftrl.L2)
    z, n = {}, {}
    for _ in range(rounds):
        dz, dn = {}, {}
        for own in deals.values():
            zs, ns = dict(z), dict(n)
            for idx, y in own:
                w = {i: weight(zs.get(i, 0.0), ns.get(i, 0.0)) for i in idx}
                g = 1 / (1 + math.exp(-sum(w.values()))) - y
                for i in idx:
                    old = ns.get(i, 0.0)
                    zs[i] = zs.get(i, 0.0) + g - ((old + g * g) ** 0.5 - old ** 0.5) / ftrl.ALPHA * w[i]
                    ns[i] = old + g * g
            for i in zs:
                dz[i] = dz.get(i, 0.0) + (zs[i] - z.get(i, 0.0)) / shards
                dn[i] = dn.get(i, 0.0) + (ns[i] - n.get(i, 0.0)) / shards
        for i in dz:
            z[i], n[i] = z.get(i, 0.0) + dz[i], n.get(i, 0.0) + dn[i]
    want = np.zeros(dims)
    for i in z:
        want[i] = weight(z[i], n[i])
    assert np.count_nonzero(got) and np.allclose(got, want, atol=1e-4)


def test_filter_holds_what_was_put_in(spark):
    h = np.random.default_rng(5).integers(0, 1 << 63, 50_000).astype(np.uint64)
    part = ftrl._places(h)[0].astype(np.int32)
    batch = pa.RecordBatch.from_arrays([pa.array(part), pa.array(h.view(np.int64))], ["part", "h"])
    seen = np.zeros(ftrl.SEEN_PARTS * ftrl.SEEN_BITS // 8, np.uint8)
    for b in ftrl._filter_parts([batch]):
        at = b.column(0)[0].as_py() * (ftrl.SEEN_BITS // 8)
        seen[at:at + ftrl.SEEN_BITS // 8] = np.frombuffer(b.column(1)[0].as_py(), np.uint8)
    other = np.random.default_rng(6).integers(0, 1 << 63, 50_000).astype(np.uint64)
    assert ftrl.held(seen, h).all() and ftrl.held(seen, other).mean() < 1e-3


def test_features_are_the_named_ones():
    h, s = Hasher(), Hasher()
    a = set(ftrl.features("one two three", h, s).tolist())
    assert 0 in a and len(a) == 1 + 3 + 2 + 1 + 1  # bias, words, pairs, skip pair, beginning of "three"
    assert ftrl.features(None, h, s).tolist() == [0]


# --------------------------------------------------------------------- quality
def mkn_by_hand(texts, d):
    """Interpolated Kneser-Ney with the given discounts, straight from the definition."""
    from collections import Counter
    reader = kneser_ney.Reader()
    c3 = Counter()
    for t in texts:
        for s in reader.symbols(t):
            c3.update(zip(s[:-2].tolist(), s[1:-1].tolist(), s[2:].tolist()))
    c2 = Counter((b, c) for a, b, c in c3)
    c1 = Counter(c for b, c in c2)

    def cut(order, c):
        return d[order][min(c, 3) - 1]

    def p1(c):
        total = sum(c1.values())
        held = sum(cut(0, n) for n in c1.values())
        return (max(c1[c] - cut(0, c1[c]), 0) if c1[c] else 0) / total + held / total / kneser_ney.SYMBOLS

    def p2(b, c):
        own = {k: n for k, n in c2.items() if k[0] == b}
        if not own:
            return p1(c)
        total, held = sum(own.values()), sum(cut(1, n) for n in own.values())
        n = c2[b, c]
        return ((n - cut(1, n)) if n else 0) / total + held / total * p1(c)

    def p3(a, b, c):
        own = {k: n for k, n in c3.items() if k[:2] == (a, b)}
        if not own:
            return p2(b, c)
        total, held = sum(own.values()), sum(cut(2, n) for n in own.values())
        n = c3[a, b, c]
        return ((n - cut(2, n)) if n else 0) / total + held / total * p2(b, c)

    return p3


def test_model_equals_the_definition(spark, monkeypatch):
    d = [[0.5, 0.75, 0.9]] * 3
    monkeypatch.setattr(kneser_ney, "_discounts", lambda g: d[0])
    texts = ["the cat the the mat", "a cat sat", "", None, "Élan ça va"]
    logs = kneser_ney.fit(spark.createDataFrame([(t,) for t in texts], "text string"))
    n = kneser_ney.SYMBOLS
    table = np.exp(logs.astype(float)).reshape(n, n, n)
    assert np.allclose(table.sum(axis=2), 1.0, atol=1e-4)
    p3 = mkn_by_hand(texts, d)
    rng = random.Random(1)
    sym = kneser_ney._symbol
    for _ in range(200):
        a, b, c = (sym(ord(rng.choice("the cat sÉç"))) for _ in range(3))
        assert table[a, b, c] == pytest.approx(p3(a, b, c), rel=1e-4)


def quality_rows():
    rng = random.Random(2)
    syl = ["an", "or", "the", "ing", "st", "re", "ou"]

    def word():
        return "".join(rng.choice(syl) for _ in range(rng.randint(1, 3)))

    rows = []
    for i in range(500):
        good = " ".join(word() for _ in range(rng.randint(20, 120)))
        kind = i % 5
        text = good if kind else [good.upper(), "##".join(good.split()), " ".join([word()] * 80)][i % 3]
        rows.append((i, text, ["en", "de"][i % 2], int(bool(kind))))
    return rows


def test_quality_keeps_clean_and_drops_junk(spark):
    rows = quality_rows()
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows if r[0] % 4], "doc_id bigint, quality int")
    got = {r.doc_id: r.accepted for r in kneser_ney.classify(docs, labels).collect()}
    held = [r for r in rows if r[0] % 4 == 0]
    assert np.mean([got[r[0]] for r in held if r[3]]) > 0.97
    assert np.mean([got[r[0]] for r in held if not r[3]]) < 0.1


def test_quality_edge_rows(spark):
    rows = quality_rows()[:120]
    docs = spark.createDataFrame([(*r[:3], 1) for r in rows] + [
        (900, None, None, 1), (901, "", "xx", 1), (None, "the an", "en", 1), (902, LONG, "en", 1), (*rows[1][:3], 1)],
        "doc_id bigint, text string, lang string, limit int")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows] + [(1, 0), (None, 1), (2, None), (3, 9)],
                                   "doc_id bigint, quality int")
    got = kneser_ney.classify(docs, labels, carry=True).collect()
    assert len(got) == 125
    by = {r.doc_id: r for r in got}
    assert by[900].accepted and by[901].accepted and by[900].n_symbols == 0
    assert by[900].row.limit == 1
    bare = kneser_ney.classify(docs, labels.limit(0)).collect()
    assert all(r.accepted and r.limit is None for r in bare)
    assert kneser_ney.classify(docs.limit(0), labels).count() == 0


def test_limits_cover_all_trusted_documents(spark):
    """The sample bounds what the model is trained on, not the limits: languages
    that have few rows in it still have limits of their own."""
    rows = quality_rows()
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id bigint, quality int")
    got = kneser_ney.classify(docs, labels, max_rows=60).collect()
    limits = {r.lang: r.limit for r in got}
    assert len(set(limits.values())) == 2
    # the 200 trusted documents of each language but the few taught: nearly all within the limits
    assert np.mean([r.accepted for r in got if r.doc_id % 5]) > 0.97
    joined = kneser_ney.classify(docs, labels, max_rows=60, max_langs=1).collect()
    assert {r.lang: r.limit for r in joined} == pytest.approx(limits)


def test_model_is_trained_on_every_trusted_row_outside_the_fold(spark, monkeypatch):
    """However many labelled rows there are: 75,000 are more than the 60,000 that were once the most."""
    n = 75_000
    docs = spark.range(n).selectExpr("id as doc_id", "concat('ab ', id) as text", "'en' as lang")
    labels = spark.range(n).selectExpr("id as doc_id", "int(id % 10 != 0) as quality")
    taught = []

    def fit(trusted):
        taught.append(trusted.collect())

    monkeypatch.setattr(kneser_ney, "fit", fit)
    assert kneser_ney.classify(docs, labels).count() == n
    assert sorted(r.text for r in taught[0]) == sorted(
        f"ab {i}" for i in range(n) if i % 10 and zlib.crc32(str(i).encode()) % 5)


@pytest.mark.parametrize("task", [kneser_ney._count, trie_join._prefixes(80, 100)])
def test_a_worker_gives_up_another_operators_model(tmp_path, task):
    """Spark reuses workers: the encoder's tables must not add to the next stage's memory."""
    path = str(shutil.copy(MODEL, tmp_path / "own.model"))
    model = weakref.ref(sentencepiece_bpe.load(path))
    assert sentencepiece_bpe.load(path) is model()
    list(task(iter([pa.RecordBatch.from_pylist([], pa.schema([("text", pa.string())]))][:task is kneser_ney._count])))
    gc.collect()
    assert model() is None


def test_repeat_mark():
    reader = kneser_ney.Reader()
    s = np.concatenate(list(reader.symbols("no no  no yes")))
    marks = (s == kneser_ney._symbol(1)).sum()
    assert marks == 2 and len(s) == 2 + len("no") + 2 + len(" yes")
