"""Ranked lexical search by NRA (no random access) over impact-sorted lists.

One pass over the texts turns documents into chunks: postings (document, term,
occurrences) of the terms that the queries hold, a row a chunk, kept below the
shared checkpoint folder.  Counts over all chunks give the terms' weights.  Then
each chunk is searched where it lies.  Per chunk a term's list is sorted by
impact.  A query's lists are read from their heads, a step at a time, all side by
side.  What has been read of a document gives its lower bound; for each list in
which it has not been met, the impact at that list's reading place is the most
that can follow, which gives its upper bound.  A document not met at all is
bounded by the sum of the reading places.  Reading goes on until every document
whose upper bound reaches the k-th best lower bound (equal ones included, since
a smaller id wins a tie) is settled, i.e. its bounds meet.

A task carries its k best per query from chunk to chunk, so later chunks stop
early, and gives them back when its input ends; a ranking over the tasks' rows
ends the job.  Nothing else is shuffled, so no term, document or source can pile
up in a task.

Queries are taken in blocks of at most ``BLOCK_BYTES`` of text (a longer query is
a block of its own).  A block's terms are broadcast, and the documents are read
once a block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import anchored, pick, utf8

BLOCK_BYTES = 4 << 20   # of query texts: bounds what is broadcast
CHUNK_DOCS = 8192
CHUNK_POSTINGS = 1 << 20
FIRST_STEP = 64         # postings of each list in the first round; doubled each round

# Code points that part terms, and letters that are lower-cased: all ASCII, so
# the UTF-8 bytes of other characters stay as they are.
_FOLD = bytes(0x20 if c < 0x30 or 0x3A <= c <= 0x40 or 0x5B <= c <= 0x60 or 0x7B <= c <= 0x7F
              else c + 0x20 if 0x41 <= c <= 0x5A else c for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and non-ASCII characters, A-Z in lower case."""
    return utf8(text).translate(_FOLD).split()


# ------------------------------------------------------------------ chunks
CHUNKS = "ids binary, no_id binary, length binary, doc binary, term binary, tf binary"


def _chunks(vocabulary, chunk_docs: int):
    """(doc_id, text) -> a row a chunk: ids, lengths and postings as packed numbers.

    A document without terms is left out: it can't be found, and no count holds it.
    """
    def packed(ids, lengths, at, found):
        doc = np.repeat(np.arange(len(at)), at)
        term = np.array(found, np.int64)
        key, tf = np.unique(doc * (len(vocabulary.value) + 1) + term, return_counts=True)
        doc, term = np.divmod(key, len(vocabulary.value) + 1)
        cols = [np.array([0 if i is None else i for i in ids], np.int64), np.array([i is None for i in ids], np.int8),
                np.array(lengths, np.int64), doc.astype(np.int32), term.astype(np.int32), tf.astype(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in cols],
                                          ["ids", "no_id", "length", "doc", "term", "tf"])

    def run(batches):
        number = vocabulary.value.get
        ids, lengths, at, found = [], [], [], []
        for b in batches:
            for i, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                ws = terms(text.as_py())
                if not ws:
                    continue
                mine = [t for t in map(number, ws) if t is not None]
                ids.append(i)
                lengths.append(len(ws))
                at.append(len(mine))
                found += mine
                if len(ids) >= chunk_docs or len(found) >= CHUNK_POSTINGS:
                    yield packed(ids, lengths, at, found)
                    ids, lengths, at, found = [], [], [], []
        if ids:
            yield packed(ids, lengths, at, found)
    return run


def _counted(n_terms: int):
    """Chunks -> (term, documents holding it); term -1 has the documents, -2 all their terms."""
    def run(batches):
        df, docs, total = np.zeros(n_terms, np.int64), 0, 0
        for b in batches:
            for lengths, term in zip(b.column("length").to_pylist(), b.column("term").to_pylist(), strict=True):
                df += np.bincount(np.frombuffer(term, np.int32), minlength=n_terms)
                lengths = np.frombuffer(lengths, np.int64)
                docs, total = docs + len(lengths), total + int(lengths.sum())
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(([-1, -2], held)), pa.int64()),
                                          pa.array(np.concatenate(([docs, total], df[held])), pa.int64())],
                                         ["term", "n"])
    return run


# ------------------------------------------------------------------ search
class Lists:
    """A chunk's postings as one list a term, by falling impact."""

    def __init__(self, row: dict, n_docs: int, n_terms_all: int, n_vocabulary: int):
        def numbers(name, kind):
            return np.frombuffer(row[name], kind)

        self.ids, self.no_id = numbers("ids", np.int64), numbers("no_id", np.int8)
        term, tf = numbers("term", np.int32), numbers("tf", np.int64)
        doc = numbers("doc", np.int32)
        lengths = numbers("length", np.int64)
        if 50 * int(lengths.max()) * n_docs < 1 << 63:
            m = 50 + 50 * lengths * n_docs // n_terms_all
        else:
            m = np.array([50 + 50 * n * n_docs // n_terms_all for n in lengths.tolist()], np.int64)
        impact = 1_000_000_000 * tf // (1000 * tf + 20 * m[doc])
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact = doc[order], impact[order]
        self.begin = np.searchsorted(term[order], np.arange(n_vocabulary + 1))


def search(lists: Lists, query: np.ndarray, weight: np.ndarray, k: int, best: np.ndarray,
           step: int = FIRST_STEP) -> tuple[np.ndarray, np.ndarray]:
    """Documents (places in the chunk) and scores that may be among the k best,
    all settled.  ``query``: term numbers; ``weight``: by term; ``best``: scores
    that the task holds already (at most k)."""
    at, end = lists.begin[query], lists.begin[query + 1]
    live = (at < end) & (weight[query] > 0)
    at, end, w = at[live].copy(), end[live], weight[query][live]
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lower = np.zeros(len(lists.ids), np.int64)
    met = np.zeros((len(at), len(lists.ids)), bool)
    while True:
        take = np.minimum(step, end - at)
        which = np.repeat(np.arange(len(at)), take)
        place = np.repeat(at - np.concatenate(([0], np.cumsum(take)[:-1])), take) + np.arange(len(which))
        doc = lists.doc[place]
        np.add.at(lower, doc, w[which] * lists.impact[place])
        met[which, doc] = True
        at += take
        frontier = np.where(at < end, w * lists.impact[np.minimum(at, end - 1)], 0)
        open_ = np.flatnonzero(frontier)
        scores = np.concatenate((best, lower[lower > 0]))
        limit = int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 1
        if not len(open_):
            upper = lower
        else:
            # what may still follow, less what can't, as it was met there
            upper = lower + frontier.sum() - frontier[open_] @ met[open_]
        reach = upper >= limit
        if not (reach & (upper > lower)).any():
            docs = np.flatnonzero(reach & (lower > 0))
            return docs, lower[docs]
        step *= 2


def _searched(plan, k: int):
    """Chunks -> item_no, doc_id, score: the task's k best of each query."""
    def run(batches):
        queries, weight, n_docs, n_terms = plan.value
        none = (np.zeros(0, np.int64), np.zeros(0, np.int8), np.zeros(0, np.int64))
        held = [none] * len(queries)
        for b in batches:
            for row in b.to_pylist():
                lists = Lists(row, n_docs, n_terms, len(weight))
                for q, query in enumerate(queries):
                    ids, no_id, scores = held[q]
                    docs, more = search(lists, query, weight, k, scores)
                    if not len(docs):
                        continue
                    ids = np.concatenate((ids, lists.ids[docs]))
                    no_id = np.concatenate((no_id, lists.no_id[docs]))
                    scores = np.concatenate((scores, more))
                    top = np.lexsort((ids, no_id, -scores))[:k]
                    held[q] = ids[top], no_id[top], scores[top]
        for q, (ids, no_id, scores) in enumerate(held):
            if len(ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), q), pa.int64()), pa.array(ids, pa.int64(), mask=no_id > 0),
                     pa.array(scores, pa.int64())], ["item_no", "doc_id", "score"])
    return run


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list]:
    """The queries in blocks of bounded text, one at a time on the driver."""
    block, size = [], 0
    for r in items.toLocalIterator():
        n = len(utf8(r["text"]))
        if block and size + n > block_bytes:
            yield block
            block, size = [], 0
        block.append((r["item_id"], r["text"]))
        size += n
    if block:
        yield block


def rank(docs: DataFrame, items: DataFrame, *, k: int = 50, doc_id: str = "doc_id", text_col: str = "text",
         item_id: str = "item_id", item_text: str = "text", chunk_docs: int = CHUNK_DOCS,
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``k`` best documents of each query: item_id, rank (int, from 1),
    doc_id (bigint), score (bigint, above 0).

    A term's weight is floor(1000 ln((2N + 2) / (2 df + 1))); a document's score
    is the sum over the query's distinct terms of weight times
    (10^9 tf) div (1000 tf + 20 m), m = 50 + (50 n N) div L.  N documents hold a
    term, L terms stand in them, n in the document.  Equal scores rank by smaller
    id, a null id last.

    Null and empty texts hold no terms: as a document they are in no count and no
    result, as a query they give no rows.  Repeated rows and rows that share an
    id are documents (queries) of their own.  Fewer than ``k`` matches give fewer
    rows, empty tables none.  Only the named columns are read, so others can't
    clash.  Texts have no length limit.
    """
    spark = docs.sparkSession
    docs = pick(docs, doc_id=doc_id, text=text_col).select(F.col("doc_id").cast("bigint"), "text")
    asked = pick(items, item_id=item_id, text=item_text)
    id_type = asked.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {id_type}, rank int, doc_id bigint, score bigint")
    for block in _blocks(asked, block_bytes):
        words = [set(terms(text)) for _, text in block]
        number = {t: i for i, t in enumerate(sorted(set().union(*words)))}
        if not number:
            continue
        vocabulary = spark.sparkContext.broadcast(number)
        chunks = anchored(docs.mapInArrow(_chunks(vocabulary, chunk_docs), CHUNKS))
        counted = (chunks.mapInArrow(_counted(len(number)), "term bigint, n bigint")
                   .groupBy("term").agg(F.sum("n").alias("n")))
        counts = {r["term"]: r["n"] for r in counted.collect()}  # at most one row a term of the block
        n_docs, n_terms = counts.pop(-1, 0), counts.pop(-2, 0)
        weight = np.zeros(len(number), np.int64)
        for t, df in counts.items():
            weight[t] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
        queries = [np.sort(np.fromiter(map(number.__getitem__, ws), np.int64, len(ws))) for ws in words]
        plan = spark.sparkContext.broadcast((queries, weight, n_docs, n_terms))
        found = chunks.mapInArrow(_searched(plan, k), "item_no bigint, doc_id bigint, score bigint")
        order = Window.partitionBy("item_no").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(block)], f"item_no bigint, item_id {id_type}")
        out = out.unionByName(ranked.join(names, "item_no").select("item_id", "rank", "doc_id", "score"))
    return out
