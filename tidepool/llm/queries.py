"""Thin registered queries over the operators, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pick, scratch_path, ship_package, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        @wraps(fn)
        def build(spark, sf_dir):
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = build
        if sql:
            ORACLES[name] = sql.strip()
        return build
    return deco


@register("op10_decontamination", r"""
WITH w AS (SELECT doc_id, string_split_regex(trim(regexp_replace(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g')), ' ') AS ws FROM documents),
d AS (SELECT doc_id, list_filter(ws, lambda x: x <> '') AS ws FROM w),
v AS (SELECT item_id, string_split_regex(trim(regexp_replace(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g')), ' ') AS ws FROM benchmark),
b AS (SELECT item_id, list_filter(ws, lambda x: x <> '') AS ws FROM v),
bw AS (SELECT DISTINCT item_id, least(13, len(ws)) AS k, ws[i:i + least(13, len(ws)) - 1] AS win
       FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS i
             FROM b WHERE len(ws) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT doc_id, k, i, ws[i:i + k - 1] AS win
       FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM d, ks WHERE len(ws) >= k)),
m AS (SELECT DISTINCT doc_id, item_id, i, bw.k AS k FROM dw JOIN bw ON dw.k = bw.k AND dw.win = bw.win),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit
      FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)""")
def op10(spark, sf_dir):
    from . import wu_manber
    r = wu_manber.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return r.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                    F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
                    "contaminated")


PIECE_MODEL = "piece_bpe_32k.model"


@register("op2_sentencepiece")
def op2(spark, sf_dir):
    import public_tokenizers

    from . import sentencepiece_bpe
    docs = pick(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text")
    r = sentencepiece_bpe.encode_documents(docs, public_tokenizers.path(PIECE_MODEL))
    return r.select("doc_id", "n_tokens", "ids_sha256",
                    F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@register("op6_ngram_jaccard", r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
        lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, hash(ws[i:i + least(5, len(ws)) - 1]) AS sh
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - least(5, len(ws)) + 2)) AS i FROM w
            WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
rare AS (SELECT sh FROM s GROUP BY sh HAVING count(*) > 1),
x AS (SELECT s.* FROM s JOIN rare USING (sh)),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM x a JOIN x b USING (sh)
      WHERE a.doc_id <> b.doc_id GROUP BY ALL),
e AS MATERIALIZED (SELECT a, b FROM p JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id
      WHERE 100 * c >= 80 * (na.n + nb.n - c)),
r(a, b) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
l AS (SELECT a, count(*) AS n_links FROM e GROUP BY a)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id,
       CAST(coalesce(n_links, 0) AS BIGINT) AS n_links
FROM w LEFT JOIN n USING (doc_id) JOIN c ON c.a = w.doc_id LEFT JOIN l ON l.a = w.doc_id""")
def op6(spark, sf_dir):
    from . import trie_join
    r = trie_join.near_duplicates(table(spark, sf_dir, "documents"))
    return r.select("doc_id", "n_shingles", "component_id", "n_links")


def _remainder(column: str, of: int):
    return F.crc32(F.col(column).cast("string").cast("binary")) % of


@register("op8_toxicity")
def op8(spark, sf_dir):
    from . import ftrl
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(_remainder("doc_id", 4) != 2)
    scored = ftrl.score(docs, *ftrl.fit(docs, labels))
    return scored.select("doc_id", (_remainder("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


@register("op9_lm_scoring")
def op9(spark, sf_dir):
    from . import backoff_automaton
    docs = pick(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text")
    r = backoff_automaton.score_documents(docs.withColumn("train", _remainder("doc_id", 7) != 2))
    return r.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known",
                    "train_tokens", "base_score", "score")


@register("op3_quality")
def op3(spark, sf_dir):
    from . import kneser_ney
    r = kneser_ney.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return r.select("doc_id", "lang", "n_symbols", "perplexity", "figure", "limit", "accepted")


@register("op5_warc", """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
b AS (SELECT page_id, strlen(h) AS n, sha1(h) AS d, max(page_id) OVER (PARTITION BY h) AS keeper FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 1000 AND keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND keeper <> page_id THEN keeper END AS refers_to, true AS intact
FROM b""")
def op5(spark, sf_dir):
    from . import warc
    path = scratch_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    r = warc.payloads(warc.read(spark, path))

    def page(c):
        return F.regexp_extract(c, "^<urn:record:(-?[0-9]+)>$", 1).try_cast("bigint")

    return r.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest",
                    F.col("type").alias("record_type"), page("refers_to").alias("refers_to"), "intact")


@register("op7_sharding", f"""
WITH k AS (SELECT doc_id, strlen(coalesce(text, '')) AS n FROM documents),
c AS (SELECT doc_id, n, unnest(range(0, count(*))) AS copy FROM k GROUP BY doc_id, n),
h AS (SELECT *, md5(CAST(doc_id AS VARCHAR) || '|' || n || '|' || copy) AS hex FROM c),
b AS (SELECT *, lpad(bin(CAST('0x' || substr(hex, 1, 9) AS BIGINT)), 36, '0') AS bits FROM h),
d AS (SELECT doc_id, n, copy, bits, unnest(range(0, 37)) AS d FROM b),
s AS (SELECT *, sum(n) OVER (PARTITION BY d, substr(bits, 1, d)) AS total FROM d),
f AS (SELECT doc_id, copy, min(d) AS depth FROM s WHERE total <= {8 << 20} GROUP BY doc_id, copy, n)
SELECT s.doc_id, s.copy, CAST(s.n AS BIGINT) AS n_bytes, substr(bits, 1, d) AS shard,
       CAST(total AS BIGINT) AS shard_bytes, false AS oversized
FROM s JOIN f ON s.doc_id = f.doc_id AND s.copy = f.copy AND s.d = f.depth""")
def op7(spark, sf_dir):
    from . import extendible
    r = extendible.assign(table(spark, sf_dir, "documents"))
    return r.withColumnRenamed("key", "doc_id")


@register("op4_pii")
def op4(spark, sf_dir):
    from . import pii
    docs = pick(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text")
    found = pii.find_spans(docs, weights=pii.learn(docs))

    def count(kind):
        return F.size(F.filter("base_spans", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in pii.BASE],
                        F.sha2(pii.as_text("base_spans").cast("binary"), 256).alias("base_sha256"),
                        pii.as_text("spans").alias("spans"))


@register("op1_lattice_near_dups", """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
e AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
      ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.95),
r(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
l AS (SELECT a, count(*) AS n FROM e GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN c ON c.a = vec_id LEFT JOIN l ON l.a = vec_id""")
def op1(spark, sf_dir):
    from . import lattice_lsh
    r = lattice_lsh.near_duplicates(table(spark, sf_dir, "embeddings"))
    return r.select("vec_id", "n_links", "component_id", "kept")


COUNT_TOKENIZER = "word_bpe_49k.json"


@register("op11_token_counts")
def op11(spark, sf_dir):
    import public_tokenizers

    from . import token_counts
    docs = pick(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text")
    r = token_counts.count_tokens(docs, public_tokenizers.path(COUNT_TOKENIZER))
    return r.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def _search_terms(column: str) -> str:
    return rf"""list_filter(string_split_regex(translate(coalesce({column}, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')"""


@register("op13_ranked_search", f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_search_terms('text')} AS ws FROM documents),
g AS (SELECT count(*) AS nd, sum(len(ws)) AS nt FROM d WHERE len(ws) > 0),
q AS (SELECT row_number() OVER () AS i, item_id, unnest(list_distinct({_search_terms('text')})) AS t FROM benchmark),
o AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ws) AS t FROM d)
      WHERE t IN (SELECT t FROM q) GROUP BY ALL),
w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * nd + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
      FROM o, g GROUP BY t, nd),
m AS (SELECT r, doc_id, 50 + ((50 * len(ws) * nd) // nt) AS m FROM d, g WHERE len(ws) > 0),
s AS (SELECT i, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS score
      FROM q JOIN o USING (t) JOIN w USING (t) JOIN m USING (r) GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM k WHERE rank <= 50""")
def op13(spark, sf_dir):
    from . import nra_search
    return nra_search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op12_hard_negatives", """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same,
        CAST(list_inner_product(a.e, b.e) AS BIGINT) AS s
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT a, b, s, row_number() OVER (PARTITION BY a ORDER BY s DESC, b) AS r FROM s WHERE same),
n AS (SELECT p.a, p.b AS p, p.s AS ps, s.b AS n, s.s AS ns,
        row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.s DESC, s.b) AS r
      FROM p JOIN s ON s.a = p.a AND NOT same AND 50 * p.s <= 100 * s.s AND 100 * s.s <= 95 * p.s WHERE p.r <= 5)
SELECT a AS anchor_id, p AS positive_id, CAST(r AS INTEGER) AS rank, n AS negative_id, ps AS positive_score,
       ns AS negative_score FROM n WHERE r <= 3""")
def op12(spark, sf_dir):
    from . import gnat
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return gnat.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label=label)
