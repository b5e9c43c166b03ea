"""Operator 11 against the tokenizers library on whole texts."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidepool.llm import token_counts
from tidepool.llm.common import ship_package

PATH = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def whole(texts, path=PATH):
    t = Tokenizer.from_file(path)
    return [len(e) for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def odd_text(rng, n):
    bits = ["the ", "Ünïcode ", "don't ", "''s", " 12345 ", "<|startoftext|>", "<|endoftext|>", "<|start", "\n\n",
            "\t", " ", "é", "é", "q̣̂", "각", "각", "漢字", "🙂👍🏽", "İΣς ", "…!?",
            "a" * 40, "\x1c", " ", "'re", "x.y,z ", "", "\x00"]
    return "".join(rng.choice(bits) for _ in range(n))


@pytest.mark.parametrize("path", [PATH, BYTES])
def test_counts_equal_the_library_with_many_small_chunks(spark, path):
    ship_package(spark)
    rng = random.Random(5)
    texts = [odd_text(rng, n) for n in (0, 1, 7, 40, 120, 400, 900)]
    texts += ["a" * 5000, "ab" * 3000 + " x" * 50, "é" * 999, "漢" * 2500, "1" * 1200, "!" * 1500, " " * 700,
              "́" * 800, "word " * 600, None, "", "<|endoftext|>" * 90]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in token_counts.count_tokens(df, path, chunk=64, overlap=24, limit=100).collect()}
    for i, (t, n) in enumerate(zip(texts, whole(texts, path), strict=True)):
        assert got[i].n_tokens == n, (i, (t or "")[:60])
        assert got[i].n_bytes == len((t or "").encode())
        assert got[i].over_limit == (n > 100)


def test_default_chunks_on_huge_texts(spark):
    ship_package(spark)
    rng = random.Random(6)
    texts = [odd_text(rng, 30_000), "z" * 80_000, "lorem ipsum, " * 9000, "y " * 16384, "short"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(df, PATH).collect()}
    assert [got[i] for i in range(len(texts))] == whole(texts)


def test_edge_rows(spark):
    """Repeated rows and ids, null ids, clashing columns, an empty table."""
    ship_package(spark)
    long = "one two " * 40
    rows = [(1, long, 5, "x"), (1, long, 5, "x"), (1, "other", 6, None), (None, long, 7, "k"), (None, None, 8, "r")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens int, text_key string")
    r = token_counts.count_tokens(df, PATH, chunk=50, overlap=20)
    assert r.columns == ["doc_id", "text", "text_key", "n_bytes", "n_tokens", "over_limit"]
    got = sorted((str(x.doc_id), x.text_key or "", x.n_tokens) for x in r.collect())
    n = whole([long])[0]
    assert got == sorted([("1", "x", n), ("1", "x", n), ("1", "", 1), ("None", "k", n), ("None", "r", 0)])
    assert token_counts.count_tokens(df.limit(0), PATH).count() == 0


def test_equal_texts_are_one_chunked_text(spark):
    ship_package(spark)
    df = spark.range(300).selectExpr("id as doc_id", "repeat('big words here ', 30) as text")
    r = token_counts.count_tokens(df, PATH, chunk=100, overlap=30)
    assert {(x.n_tokens, x["count"]) for x in r.groupBy("n_tokens").count().collect()} == {(90, 300)}


def test_a_tokenizer_that_looks_back_is_refused(tmp_path):
    import json
    with open(PATH) as f:
        spec = json.load(f)
    spec["pre_tokenizer"] = {"type": "Metaspace", "replacement": "▁", "prepend_scheme": "always", "split": False}
    bad = tmp_path / "t.json"
    bad.write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        token_counts.Counter(str(bad))
