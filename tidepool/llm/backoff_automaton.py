"""Language-model scoring by a weighted backoff automaton, trained here.

Tokens: words (A-Z lower-cased, split at ASCII white space), then one end.

The model is a word n-gram model (n = ``order``) with absolute discounting over
all training text.  Every training word is a symbol; n-grams of two and more
words are kept when they are seen ``MIN_COUNT`` times, however large the input.
Words never seen share one class, RARE.  With D the discount::

    P(w)     = (c(w) + 1) / (all tokens + distinct tokens + 1)
    P(w | h) = max(c(hw) - D, 0) / c(h)   for kept hw
             + bow(h) * P(w | shorter h)
    bow(h)   = 1 - sum over kept hw of (c(hw) - D) / c(h)

so that the probabilities of all words after any history add up to one.

Kept n-grams of fewer than n words are the automaton's states.  A kept n-gram
is an arc from its history to the longest state that its end is; every state
but the empty one has a failure arc to its next shorter suffix, weighted
bow(h).  A text's score is the sum of the arcs it takes.  It is added up
n-gram by n-gram: each word brings P(w) and its own failure arc, and each kept
n-gram brings what its arc adds to the failure arc and the shorter arc that
would be taken without it, and its own failure arc::

    weight(hw) = log P(w | h) - log bow(h) - log P(w | shorter h) + log bow(hw)

So no task or driver holds the model.  Texts are written once as chunks of about
CHUNK_TOKENS tokens, bucketed by chunk, and stay where they are; questions about
their n-grams go out, one round for each n, and answers come back:

1. A chunk asks for each of its words once, with its count in training rows.  Hash
   buckets add the counts up, number the words kept and answer.
2. A chunk asks for each n-gram once as (number of its history, number of its last
   word), where its history and its suffix, both one word shorter, are seen
   ``MIN_COUNT`` times: no other is.  The history's bucket adds up, numbers and answers,
   also with the sum and number of all kept counts after the history, which give bow(h).
3. With all answers a chunk computes P(w | h) for its tokens, shorter histories first.

Numbers go as sorted differences, byte by byte, compressed.  They begin with the most
frequent (by the length of the count in bits), so what is met often costs little.
Answers say only what the chunk can't know: counts beyond its own, of each history what
follows it beyond the chunk's own n-grams.  They are dealt to the chunks once, into a table
with the chunks' buckets, which all later rounds read in place.  A history that makes
up at least ``tau`` of all training tokens and half a bucket is dealt over as many
buckets as it fills; its sums are added up and broadcast (at most ``1 / tau`` for each n).

``Automaton`` is the same model within one process, in its pass from left to
right (``fit`` learns it; ``tau`` there is the threshold of what is kept).

Null texts are empty: the end alone.  Words are told apart by 64-bit hashes,
longer n-grams exactly by their words' numbers.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import WORD_CACHE, Hasher, checkpoint_dir, mix64, release_model, words

END = b" end"  # no word holds a space
END_HASH = xxhash.xxh64_intdigest(END)
TAU = 1e-4  # histories with this share of the training tokens may take several buckets
MIN_COUNT = 2
ORDER = 3
DISCOUNT = 0.75
CHUNK_TOKENS = 2_000_000
CHUNK_DOCS = 20_000
SYMBOL_BITS = 20  # 1 / tau must stay below 2 ** 20
RARE = 0
CLASSES = 64  # lengths of counts in bits


# ------------------------------------------------------------- packed arrays
def _pack(a: np.ndarray) -> bytes:
    """Whole numbers from 0: their first bytes, then their second ones, …, compressed."""
    a = np.ascontiguousarray(a, np.uint64)
    width = (int(a.max()).bit_length() + 7) // 8 if len(a) else 0
    planes = a.view(np.uint8).reshape(len(a), 8)[:, :width].T.tobytes()
    return len(a).to_bytes(8, "little") + bytes([width]) + pa.compress(planes, "zstd", asbytes=True)


def _unpack(data: bytes) -> np.ndarray:
    n, width = int.from_bytes(data[:8], "little"), data[8]
    planes = pa.decompress(data[9:], n * width, "zstd", asbytes=True)
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, n).T
    return out.reshape(-1).view(np.int64)


def _rising(a: np.ndarray) -> bytes:
    """Numbers in ascending order, as their differences (modulo 2 ** 64, if not ascending)."""
    a = a.astype(np.uint64)
    return _pack(np.diff(a, prepend=a[:0] if not len(a) else np.zeros(1, np.uint64)))


def _risen(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data))


def _class(count: np.ndarray) -> np.ndarray:
    return np.frexp(count.astype(float))[1]


def _frequent_first(count: np.ndarray) -> np.ndarray:
    """Their order by class, the most frequent first, otherwise as they are."""
    return np.argsort((CLASSES - _class(count)).astype(np.uint8), kind="stable")


# ------------------------------------------------------------- chunks
def _chunks(batches):
    """Rows of about CHUNK_TOKENS tokens: (doc_id, train, tokens), the
    tokens hashed, with an end before the first and after the last."""
    hasher, rows, held = Hasher(), [], 0
    for b in batches:
        for doc, train, text in zip(*(b.column(c) for c in ("doc_id", "train", "text")), strict=True):
            t = hasher.array([END, *words(text.as_py()), END])
            rows.append((doc.as_py(), train.as_py(), t))
            held += len(t)
            if held >= CHUNK_TOKENS or len(rows) >= CHUNK_DOCS:
                yield rows
                rows, held = [], 0
    if rows:
        yield rows


CHUNK = "chunk bigint, ids array<{0}>, train binary, sizes binary, words binary, tokens binary, trained bigint"


def _chunk(ids: pa.DataType):
    """A row for each chunk: its documents, its words, those frequent in it first, then in
    the order of their hashes, and the places of its tokens among them."""
    def run(batches):
        release_model()
        task = TaskContext.get().partitionId()
        for no, rows in enumerate(_chunks(batches)):
            words_, at, count = np.unique(np.concatenate([r[2] for r in rows]), return_inverse=True, return_counts=True)
            order = _frequent_first(count)
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            words_, at = words_[order], place[at]
            train, sizes = np.array([r[1] for r in rows], np.uint64), np.array([len(r[2]) for r in rows], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([task << 32 | no]), pa.array([[r[0] for r in rows]], pa.list_(ids)),
                 *(pa.array([x], pa.binary()) for x in (_pack(train), _pack(sizes), _rising(words_), _pack(at))),
                 pa.array([int((train * (sizes - np.uint64(1))).sum())])],
                ["chunk", "ids", "train", "sizes", "words", "tokens", "trained"])
    return run


# ------------------------------------------------------------- questions
# histories, how many words follow each, the first of them, the steps to the others, counts in training rows
ASKED = "bucket int, chunk bigint, h binary, k binary, s binary, d binary, c binary"


def _questions(rows: list[tuple]) -> list[pa.Array]:
    cols = list(zip(*rows, strict=True)) or [[]] * 7
    return [pa.array(x, t) for x, t in zip(cols, (pa.int32(), pa.int64(), *[pa.binary()] * 5), strict=True)]


_ASKED = [c.split()[0] for c in ASKED.split(", ")]


def _followers(long: np.ndarray, first: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """The words after each history, from the first one and the steps to the others."""
    at = np.cumsum(long) - long
    out = np.zeros(int(long.sum()), np.int64)
    other = np.ones(len(out), bool)
    other[at] = False
    out[other] = steps
    out = np.cumsum(out)
    return out + np.repeat(first - out[at], long)


def _word_bucket(words_: np.ndarray, n_buckets: int) -> np.ndarray:
    """Buckets are ranges of hashes, so words stay in order."""
    return ((words_.view(np.uint64) >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int64)


def _split(bucket: np.ndarray):
    """(bucket, first, end) of the runs in an ascending array."""
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    ends = [0, *cuts.tolist(), len(bucket)]
    return [(int(bucket[a]), a, z) for a, z in zip(ends, ends[1:], strict=False) if z > a]


def _ask_words(n_buckets: int):
    """Each chunk's words with their numbers in its training rows, by bucket."""
    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                r = _Reading(row)
                u, c = r.words[r.by_hash], r.trained[r.by_hash]
                yield pa.RecordBatch.from_arrays(_questions(
                    [(place, row["chunk"], None, None, _rising(u[a:z]), None, _pack(c[a:z]))
                     for place, a, z in _split(_word_bucket(u, n_buckets))]), _ASKED)
    return run


@dataclass
class Known:
    """What is known of each n so far: at most CLASSES numbers a bucket and ``1 / tau`` n-grams."""
    n_buckets: int
    total: int
    least: int
    types: int                      # words kept
    shift: dict[int, np.ndarray]    # of each bucket and class what leads from places in the bucket to numbers
    often: dict[int, np.ndarray]    # frequent n-grams, ascending: what follows them is dealt one by one
    sums: dict[int, tuple]          # of the frequent histories of n: places in ``often``, counts that follow, how many


def _found(table: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the sorted table, and whether they hold the number."""
    if not len(table):
        return np.zeros(len(g), np.int64), np.zeros(len(g), bool)
    at = np.minimum(np.searchsorted(table, g), len(table) - 1)
    return at, table[at] == g


def _ranked(number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers, 0 first, and the place of each entry's among them."""
    numbers, rank = np.unique(np.append(number, 0), return_inverse=True)
    return numbers, rank[:-1]


class _Reading:
    """A chunk, read with n-grams of one word, then two, ….

    ``own``: for each token the place of the n-gram that ends there, if it is seen
    ``least`` times, or -1.
    """

    def __init__(self, row: dict):
        self.row = row
        self.train, self.sizes = _unpack(row["train"]), _unpack(row["sizes"])
        self.words, self.tokens = _risen(row["words"]), _unpack(row["tokens"])
        if len(self.tokens) < 1 << 31:
            self.tokens = self.tokens.astype(np.int32)
        self.owner = np.repeat(np.arange(len(self.sizes), dtype=np.int32), self.sizes)
        self.start = np.zeros(len(self.tokens), bool)
        self.start[np.cumsum(self.sizes) - self.sizes] = True
        self.learnt = self.train.astype(bool)[self.owner]
        self.by_hash = np.argsort(self.words.view(np.uint64))
        self.trained = np.bincount(self.tokens[self.learnt & ~self.start], minlength=len(self.words))

    def _answers(self, n: int, parts: list[tuple], own: np.ndarray, known: Known):
        """(counts, numbers) of the entries, in the order in which they were dealt."""
        more = [_unpack(c) for _, _, c, _, _ in parts]
        if sum(map(len, more)) != len(own):
            raise ValueError("answers don't fit the questions")
        count = own + np.concatenate(more)
        count[count < (1 if n == 1 else known.least)] = 0
        number = np.zeros(len(count), np.int64)
        a = 0
        for (b, at, *_), c in zip(parts, more, strict=True):
            if at is not None:
                told = a + np.flatnonzero(count[a:a + len(c)] >= known.least)
                told = told[_frequent_first(count[told])]
                number[told] = _risen(at) + known.shift[n][b, _class(count[told])]
            a += len(c)
        return count, number

    def hear_words(self, parts: list[tuple], known: Known) -> None:
        self.count, self.number = np.zeros((2, len(self.words)), np.int64)
        self.count[self.by_hash], self.number[self.by_hash] = self._answers(1, parts, self.trained[self.by_hash], known)
        self.word_count = self.count[self.tokens]
        self.word_numbers, self.word_rank = _ranked(self.number)
        self.own = np.where(self.word_count >= known.least, self.tokens, self.tokens.dtype.type(-1))

    def ask(self, n: int, known: Known) -> None:
        """The n-grams whose history is kept, each once: by bucket, history and last word.
        Where the suffix isn't kept the n-gram isn't either, and only the history is asked for."""
        self.at = np.flatnonzero((self.own[:-1] >= 0) & ~self.start[1:]) + 1
        # by places among the chunk's own numbers, which are small however many there are in all
        numbers, rank = _ranked(self.number)
        last = np.where(self.own[self.at] >= 0, self.word_rank[self.tokens[self.at]], 0)
        u, inverse = np.unique(rank[self.own[self.at - 1]] * len(self.word_numbers) + last, return_inverse=True)
        h, last = np.divmod(u, len(self.word_numbers))
        of_h, last = numbers[h], self.word_numbers[last]
        context = np.zeros(len(numbers), np.int64)
        context[rank] = self.count
        context = context[h]
        c = np.bincount(inverse[self.learnt[self.at]], minlength=len(u)) * (last > 0)
        # numbers go round the buckets; a frequent history takes as many as it fills
        bucket, code = of_h % known.n_buckets, of_h // known.n_buckets + len(known.often[n - 1])
        place, often = _found(known.often[n - 1], of_h)
        code[often] = place[often]
        over_buckets = np.minimum(known.n_buckets, 1 + 2 * known.n_buckets * context[often] // known.total)
        mixed = mix64(last[often].view(np.uint64)) % over_buckets.view(np.uint64)
        bucket[often] = (bucket[often] + mixed.view(np.int64)) % known.n_buckets
        by = 2 * bucket + ~often  # within it, codes ascend
        order = np.argsort(by.astype(np.uint16) if 2 * known.n_buckets < 1 << 16 else by, kind="stable")
        place = np.empty(len(u), np.int64)
        place[order] = np.arange(len(u))
        self.inverse = place[inverse].astype(self.tokens.dtype)
        self.context, self.code, self.last, self.c, self.bucket = (x[order] for x in (context, code, last, c, bucket))
        fresh = np.ones(len(u), bool)
        fresh[1:] = (self.code[1:] != self.code[:-1]) | (self.bucket[1:] != self.bucket[:-1])
        self.runs = np.flatnonzero(fresh)
        self.run_of = np.cumsum(fresh) - 1

    def questions(self) -> list[tuple]:
        long = np.diff(np.append(self.runs, len(self.c)))
        out = []
        for place, a, z in _split(self.bucket):
            i, j = np.searchsorted(self.runs, (a, z))
            steps = np.delete(np.diff(self.last[a:z], prepend=0), self.runs[i:j] - a)
            out.append((place, self.row["chunk"], _rising(self.code[self.runs[i:j]]), _pack(long[i:j]),
                        _pack(self.last[self.runs[i:j]]), _pack(steps), _pack(self.c[a:z])))
        return out

    def shares(self, n: int, count: np.ndarray, parts: list[tuple], known: Known,
               discount: float) -> tuple[np.ndarray, np.ndarray]:
        """For each token in ``at`` what its n-gram has of the history's probability, if
        it is kept, and what the history leaves to the suffix."""
        rest, some = (np.concatenate([_unpack(p[i]) for p in parts] or [self.runs]) for i in (3, 4))
        held = rest + np.bincount(self.run_of, weights=count, minlength=len(rest))
        many = np.bincount(self.run_of, weights=count > 0, minlength=len(rest))
        many[rest > 0] += 1
        many[rest >= 2 * known.least] += some
        held, many = held[self.run_of], many[self.run_of]
        of, total, types = known.sums[n]
        at, hit = _found(of, self.code)
        held[hit], many[hit] = total[at[hit]], types[at[hit]]
        left = np.maximum(1.0 - (held - discount * many) / self.context, 1e-12)
        own = np.where(count > 0, count - discount, 0.0) / self.context
        return own[self.inverse], left[self.inverse]

    def hear(self, n: int, parts: list[tuple], known: Known, discount: float | None = None):
        """Takes the answers: the n-grams kept are the histories of longer ones.
        With a discount: the ``shares`` of the tokens."""
        count = number = np.zeros(0, np.int64)
        if parts or len(self.c):
            count, number = self._answers(n, parts, self.c, known)
        out = None if discount is None else self.shares(n, count, parts, known, discount)
        self.count, self.number = count, number
        self.own = np.full(len(self.tokens), -1, self.tokens.dtype)
        self.own[self.at] = np.where(count[self.inverse] > 0, self.inverse, -1)
        return out


def _heard(answers: pa.Table) -> dict[int, list[tuple]]:
    """By n the answers of all buckets, in their order."""
    out: dict[int, list[tuple]] = {}
    for n, *part in sorted(zip(*(answers.column(c).to_pylist() for c in ("n", "bucket", "at", "c", "held", "many")),
                               strict=True), key=lambda x: x[:2]):
        out.setdefault(n, []).append(tuple(part))
    return out


def _ask(sent, n: int):
    """The questions of a chunk about its n-grams, from what it heard of shorter ones."""
    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        known, rows = sent.value, []
        heard = _heard(answers)
        for row in chunk.to_pylist():
            r = _Reading(row)
            r.hear_words(heard[1], known)
            for m in range(2, n):
                r.ask(m, known)
                r.hear(m, heard.get(m, []), known)
            r.ask(n, known)
            rows += r.questions()
        return pa.Table.from_arrays(_questions(rows), _ASKED)
    return run


def _score(sent, order: int, discount: float, total: int, places: int, ids: pa.DataType):
    """One row per document row of a chunk, from all answers."""
    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        known, out = sent.value, []
        heard = _heard(answers)
        for row in chunk.to_pylist():
            r = _Reading(row)
            r.hear_words(heard[1], known)
            c, docs, token = r.word_count, len(r.sizes), ~r.start
            p = (c + 1.0) / places
            base = np.bincount(r.owner[token], weights=np.log10(p[token]), minlength=docs)
            for n in range(2, order + 1):
                r.ask(n, known)
                own, left = r.hear(n, heard.get(n, []), known, discount)
                p[r.at] = own + left * p[r.at]
            score = np.bincount(r.owner[token], weights=np.log10(p[token]), minlength=docs)
            out.append(pa.Table.from_arrays(
                [pa.array(row["ids"], ids), pa.array(r.train.astype(bool)), pa.array(r.sizes - 1),
                 pa.array(np.bincount(r.owner[token & (c > 0)], minlength=docs)),
                 pa.array(np.full(docs, total, np.int64)), pa.array(base), pa.array(score)],
                ["doc_id", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"]))
        return pa.concat_tables(out)
    return run


# ------------------------------------------------------------- answers
# ``chunk`` below 0: of a bucket, the numbers kept by class and what is frequent
ANSWERED = "n tinyint, bucket int, chunk bigint, at binary, c binary, held binary, many binary, h binary"


def _answer(n: int, least: int, often_from: float, numbers: bool, sent):
    """Adds a bucket's counts up, numbers the n-grams seen ``least`` times (words: once), the
    frequent first, and answers each chunk: counts (beyond its own; 0 if not kept), numbers
    unless no longer n-grams come, and of each history the sum and number of the counts
    that follow it, beyond those of the chunk (the number only where the sum leaves it open)."""
    def bucket(at: int, parts: list[tuple]) -> list[tuple]:
        chunks, hs, ks, ss, ds, cs = zip(*parts, strict=True)
        c = [_unpack(x) for x in cs]
        if n == 1:
            u, inverse = np.unique(np.concatenate([_risen(x) for x in ss]).view(np.uint64), return_inverse=True)
            real = np.ones(len(u), bool)
        else:
            h, k = [_risen(x) for x in hs], [_unpack(x) for x in ks]
            before, of = np.unique(np.concatenate(h), return_inverse=True)
            long = np.concatenate(k)
            s = _followers(long, *(np.concatenate([_unpack(x) for x in xs]) for xs in (ss, ds)))
            bits = int(s.max()).bit_length()
            key = np.repeat(of, long) << bits | s
            u, inverse = np.unique(key, return_inverse=True)
            real = (u & ((1 << bits) - 1)) > 0
        count = np.bincount(inverse, weights=np.concatenate(c), minlength=len(u)).astype(np.int64)
        kept = real & (count >= (1 if n == 1 else least))
        count *= kept
        place = np.flatnonzero(kept)
        place = place[_frequent_first(count[place])]
        number = np.zeros(len(u), np.int64)
        number[place] = np.arange(len(place))
        out = []
        if n > 1:
            held = np.bincount(u >> bits, weights=count, minlength=len(before)).astype(np.int64)
            many = np.bincount(u >> bits, weights=kept, minlength=len(before)).astype(np.int64)
            hot = np.flatnonzero(before < len(sent.value.often[n - 1]))
        a = b = 0
        for i, chunk in enumerate(chunks):
            own = inverse[a:a + len(c[i])]
            a += len(own)
            told = own[count[own] >= least]
            told = told[_frequent_first(count[told])]
            sums = (None, None)
            if n > 1:
                who = of[b:b + len(h[i])]
                b += len(who)
                run = np.repeat(np.arange(len(who)), k[i])
                rest = held[who] - np.bincount(run, weights=count[own], minlength=len(who)).astype(np.int64)
                some = many[who] - np.bincount(run, weights=kept[own], minlength=len(who)).astype(np.int64)
                sums = _pack(rest), _pack(some[rest >= 2 * least] - 1)
            out.append((chunk, _rising(number[told]) if numbers else None,
                        _pack(np.where(kept[own], count[own] - c[i], 0)), *sums, None))
        frequent = _rising(np.sort(number[kept & (count >= often_from)]))
        sums = (_pack(held[hot]), _pack(many[hot]), _rising(before[hot])) if n > 1 else (None, None, None)
        out.append((-1 - at, frequent, _pack(np.bincount(_class(count[place]), minlength=CLASSES)), *sums))
        return out

    def run(batches):
        buckets: dict[int, list[tuple]] = {}
        for b in batches:
            for at, *part in zip(*(c.to_pylist() for c in b.columns), strict=True):
                buckets.setdefault(at, []).append(tuple(part))
        while buckets:
            at, parts = buckets.popitem()
            rows = bucket(at, parts)
            cols = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([n] * len(rows), pa.int8()), pa.array([at] * len(rows), pa.int32()),
                 *(pa.array(x, t) for x, t in zip(cols, (pa.int64(), *[pa.binary()] * 5), strict=True))],
                ["n", "bucket", "chunk", "at", "c", "held", "many", "h"])
    return run


def _sums(batches):
    """(h, held, many) of the frequent histories that a bucket met."""
    for b in batches:
        for h, held, many in zip(*(b.column(c).to_pylist() for c in ("h", "held", "many")), strict=True):
            yield pa.RecordBatch.from_arrays([pa.array(_risen(h)), pa.array(_unpack(held)), pa.array(_unpack(many))],
                                             ["h", "held", "many"])


def _learn(known: Known, n: int, answers: DataFrame) -> None:
    """Takes what the buckets report of n into ``known``."""
    of_buckets = answers.where((F.col("n") == n) & (F.col("chunk") < 0))
    kept = np.zeros((known.n_buckets, CLASSES), np.int64)
    got = of_buckets.select("bucket", "at", "c").collect()
    for r in got:
        kept[r.bucket] = _unpack(bytes(r.c))
    # numbers go by class, the highest first, then by bucket; places in a bucket by class
    ends = np.cumsum(kept[:, ::-1], axis=1)
    before = (ends - kept[:, ::-1])[:, ::-1]
    known.shift[n] = 1 + before.sum(axis=0) - before + np.cumsum(kept, axis=0) - kept
    known.often[n] = np.sort(np.concatenate([np.zeros(0, np.int64), *(
        at + known.shift[n][r.bucket, CLASSES - 1 - np.searchsorted(ends[r.bucket], at, side="right")]
        for r in got for at in [_risen(bytes(r["at"]))])]))
    if n == 1:
        known.types = int(kept.sum())
    else:
        t = (of_buckets.select("h", "held", "many").mapInArrow(_sums, "h bigint, held bigint, many bigint")
             .groupBy("h").agg(F.sum("held"), F.sum("many")).orderBy("h").toArrow())  # at most 1 / tau rows
        known.sums[n] = tuple(t.column(i).to_numpy() for i in range(3))


# ------------------------------------------------------------- the model
class Symbols(dict):
    """token -> symbol of the model (RARE for tokens without one of their own)."""

    def __init__(self, by_hash: dict[int, int]):
        super().__init__()
        self.by_hash = by_hash

    def __missing__(self, token: bytes) -> int:
        s = self.by_hash.get(xxhash.xxh64_intdigest(token), RARE)
        if len(self) < WORD_CACHE:
            self[token] = s
        return s


@dataclass
class Grams:
    """Kept n-grams of one n: history state, last symbol, count; sorted by key."""
    key: np.ndarray
    count: np.ndarray

    @property
    def history(self):
        return self.key >> SYMBOL_BITS

    @property
    def symbol(self):
        return self.key & ((1 << SYMBOL_BITS) - 1)


@dataclass
class Model:
    """What is broadcast: at most ``order / tau`` n-grams.

    States are numbered: 0 the empty one, then the symbols (as 1 + symbol),
    then the kept n-grams of 2, 3, ... words.
    """
    token: str
    hashes: np.ndarray      # symbol i + 1 is the token hashes[i]
    counts: np.ndarray      # by symbol, RARE first
    total: int
    rare_types: int
    discount: float
    grams: list[Grams]      # of 2, 3, ... words

    def states_of(self, ids: np.ndarray, n: int) -> np.ndarray:
        """For each position the state of the n symbols that end there, or -1."""
        if n == 1:
            return ids + 1
        before = self.states_of(ids, n - 1)
        out = np.full(len(ids), -1, np.int64)
        if len(ids) < 2:
            return out
        g = self.grams[n - 2]
        ok = before[:-1] >= 0
        want = (before[:-1] << SYMBOL_BITS) | ids[1:]
        at = np.searchsorted(g.key, want)
        at[at == len(g.key)] = 0
        hit = ok & (len(g.key) > 0)
        if len(g.key):
            hit &= g.key[at] == want
        out[1:][hit] = at[hit] + self.first_state(n)
        return out

    def first_state(self, n: int) -> int:
        """Number of the first state of n words."""
        at = 1 + len(self.counts)
        for g in self.grams[:n - 2]:
            at += len(g.key)
        return at


class Automaton:
    """Arcs, failure arcs and weights (log10) of a model."""

    def __init__(self, m: Model):
        self.symbols = Symbols({h: i + 1 for i, h in enumerate(m.hashes.tolist())})
        self.rare = -math.log10(m.rare_types + 1)
        n_sym = len(m.counts)
        # the empty history: counts plus one, over the total plus the symbols
        p1 = (m.counts + 1.0) / (m.total + n_sym)
        self.arcs: dict[int, tuple[int, float]] = {
            s: (1 + s, x) for s, x in enumerate(np.log10(p1).tolist())}
        prob = {s: x for s, x in enumerate(p1.tolist())}  # by state << bits | symbol
        self.fail = [0] * (1 + n_sym)
        self.back = [0.0] * (1 + n_sym)
        context = np.concatenate(([float(m.total)], m.counts.astype(float)))  # c(h) by state
        state_at = {}  # state << bits | symbol -> state of the longer n-gram
        for k, g in enumerate(m.grams):
            n = k + 2
            hist, sym = g.history, g.symbol
            gain = (g.count - m.discount) / context[hist]
            left = np.ones(len(context))
            np.subtract.at(left, hist, gain)
            left = np.clip(left, 1e-12, 1.0)
            lo = m.first_state(n - 1) if n > 2 else 1
            logs = np.log10(left)
            for h in range(lo, len(context)):
                self.back[h] = float(logs[h])
            first = m.first_state(n)
            longer = n < len(m.grams) + 1
            new_prob = {}
            for i, (key, h, s, gn) in enumerate(zip(g.key.tolist(), hist.tolist(), sym.tolist(),
                                                    gain.tolist(), strict=True)):
                p = gn + left[h] * self._p(prob, self.fail[h], s)
                new_prob[key] = p
                suffix = state_at.get((self.fail[h] << SYMBOL_BITS) | s, 1 + s)
                to = first + i if longer else suffix
                self.arcs[key] = (to, math.log10(p))
                if longer:
                    state_at[key] = first + i
                    self.fail.append(suffix)
                    self.back.append(0.0)
            prob |= new_prob
            if longer:
                context = np.concatenate((context, g.count.astype(float)))
        self.start = 1 + self.symbols[END]
        self.model = m
        self.arc_keys = np.array(sorted(self.arcs), np.int64)
        self.arc_weights = np.array([self.arcs[k][1] for k in self.arc_keys.tolist()])
        self.back_array, self.fail_array = np.array(self.back), np.array(self.fail, np.int64)

    def _p(self, prob, h, s) -> float:
        """Probability of a symbol after state h, from what is known so far."""
        w = 1.0
        while True:
            p = prob.get((h << SYMBOL_BITS) | s)
            if p is not None:
                return w * p
            w *= 10.0 ** self.back[h]
            h = self.fail[h]

    def score(self, tokens: list[bytes]) -> float:
        """log10 probability of the tokens and the end after them: one pass, left
        to right, carrying the state."""
        state, total = self.start, 0.0
        for s in map(self.symbols.__getitem__, (*tokens, END)):
            while (arc := self.arcs.get((state << SYMBOL_BITS) | s)) is None:
                total += self.back[state]
                state = self.fail[state]
            state = arc[0]
            total += arc[1] + (self.rare if s == RARE else 0.0)
        return total

    def score_run(self, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """``score`` of several texts at once.

        ``ids`` holds their symbols one text after another, an end before the
        first and after each, at the places ``ends``.  The state that the pass would be in after a word
        is the longest state among the last words, so all of them are looked up
        at once; then every position takes its arc, and those without one go
        back along their failure arcs together, until all have arrived.
        """
        m = self.model
        state = ids + 1
        for n in range(2, len(m.grams) + 1):
            longer = m.states_of(ids, n)
            state = np.where(longer >= 0, longer, state)
        state[ends] = self.start  # a text begins after an end, whatever came before
        state, symbol = state[:-1], ids[1:]
        weight = np.where(symbol == RARE, self.rare, 0.0)
        left = np.arange(len(symbol))
        while len(left):
            want = (state[left] << SYMBOL_BITS) | symbol[left]
            at = np.searchsorted(self.arc_keys, want)
            at[at == len(self.arc_keys)] = 0
            hit = self.arc_keys[at] == want
            weight[left[hit]] += self.arc_weights[at[hit]]
            left = left[~hit]
            weight[left] += self.back_array[state[left]]
            state[left] = self.fail_array[state[left]]
        return np.add.reduceat(weight, ends[:-1]) if len(ends) > 1 else np.empty(0)


_built: dict[str, Automaton] = {}


def automaton(m: Model) -> Automaton:
    """Built once a process."""
    if m.token not in _built:
        _built.clear()
        _built[m.token] = Automaton(m)
    return _built[m.token]


def _runs(texts, symbols: Symbols):
    """Texts one after another, in pieces of about CHUNK_TOKENS: (symbols with an
    end before the first and after each, the places of the ends, the texts)."""
    end = symbols[END]
    ids, ends, own = [end], [0], []
    for text in texts:
        own.append(text.as_py())
        ids.extend(map(symbols.__getitem__, words(own[-1])))
        ends.append(len(ids))
        ids.append(end)
        if len(ids) > CHUNK_TOKENS:
            yield np.array(ids, np.int64), np.array(ends), own
            ids, ends, own = [end], [0], []
    if own:
        yield np.array(ids, np.int64), np.array(ends), own


def _gram_counts(sent, n: int):
    """(key, count) of n-grams whose shorter parts are kept, added up by batch.

    Texts are read one after another with one end between them, which is the
    end of one and the beginning of the next; n-grams across it are left out.
    """
    def run(batches):
        m = sent.value
        symbols = Symbols({h: i + 1 for i, h in enumerate(m.hashes.tolist())})

        def count(ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
            state = m.states_of(ids, n - 1)
            ok = state[:-1] >= 0
            if n > 2:  # the n-gram without its first word is kept too, and it is of one text
                ok &= state[1:] >= 0
                ok[ends[1:-1]] = False
            return (state[:-1][ok] << SYMBOL_BITS) | ids[1:][ok]

        for b in batches:
            keys = [count(*run[:2]) for run in _runs(b.column("text"), symbols)]
            k, c = np.unique(np.concatenate(keys) if keys else np.empty(0, np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(c)], ["key", "c"])
    return run


def fit(train: DataFrame, hashes: np.ndarray, counts: np.ndarray, total: int, types: int, *,
        tau: float, order: int, discount: float) -> Model:
    """The model of the training rows, from their frequent tokens."""
    counts = counts.astype(np.int64)
    m = Model(uuid4().hex, hashes, np.concatenate(([total - counts.sum()], counts)), total,
              types - len(hashes), discount, [])
    sc = train.sparkSession.sparkContext
    for n in range(2, order + 1):
        sent = sc.broadcast(m)
        kept = (train.select("text").mapInArrow(_gram_counts(sent, n), "key bigint, c bigint")
                .groupBy("key").agg(F.sum("c").alias("c")).where(F.col("c") >= max(1.0, tau * total))
                .toArrow())  # at most 1 / tau rows
        key, c = kept.column("key").to_numpy(), kept.column("c").to_numpy()
        at = np.argsort(key)
        m = Model(uuid4().hex, m.hashes, m.counts, m.total, m.rare_types, discount,
                  [*m.grams, Grams(key[at], c[at])])
        sent.unpersist()
    return m


def _by_chunk(df: DataFrame, name: str, n_buckets: int) -> DataFrame:
    """Rows added to a table below the checkpoint folder, bucketed by chunk."""
    spark = df.sparkSession
    writer = df.write.format("parquet").bucketBy(n_buckets, "chunk").mode("append")
    writer.option("path", f"{checkpoint_dir(spark).rstrip('/')}/{name}").saveAsTable(name)
    return spark.table(name)


def score_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    train_col: str = "train", tau: float = TAU, min_count: int = MIN_COUNT, order: int = ORDER,
                    discount: float = DISCOUNT) -> DataFrame:
    """One row per document row: doc_id, train, n_tokens, n_known, train_tokens,
    base_score (add-one unigram), score (the model).

    ``train_col`` (boolean, null as false) marks the rows to learn from.
    ``tau`` only says which histories may be dealt over several buckets; it changes no score.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
                      F.coalesce(F.col(f"`{train_col}`"), F.lit(False)).alias("train"))
    n_buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    kind = src.schema["doc_id"].dataType.simpleString()
    ids = to_arrow_type(src.schema["doc_id"].dataType)
    # written by chunk, as the answers are, so that nothing is shuffled to the chunks twice
    chunks = _by_chunk(src.mapInArrow(_chunk(ids), CHUNK.format(kind)), f"lm_chunks_{uuid4().hex}", n_buckets)
    total = chunks.agg(F.coalesce(F.sum("trained"), F.lit(0))).first()[0]
    known = Known(n_buckets, total, min_count, 0, {}, {}, {})
    often = max(1.0, total * max(tau, 0.5 / n_buckets))
    asked = chunks.mapInArrow(_ask_words(n_buckets), ASKED)
    name = f"lm_answers_{uuid4().hex}"
    for n in range(1, order + 1):
        sent = spark.sparkContext.broadcast(known)
        if n > 1:
            heard = answers.where("chunk >= 0").withColumns({c: F.lit(None).cast("binary") for c in ("held", "many")})
            asked = (chunks.groupBy("chunk").cogroup(heard.groupBy("chunk")).applyInArrow(_ask(sent, n), ASKED))
        own = asked.repartition(n_buckets, "bucket").mapInArrow(_answer(n, min_count, often, n < order, sent), ANSWERED)
        answers = _by_chunk(own.repartition(n_buckets, "chunk"), name, n_buckets)
        known = Known(n_buckets, total, min_count, known.types, dict(known.shift), dict(known.often), dict(known.sums))
        _learn(known, n, answers)
    places = total + known.types + 1
    sent = spark.sparkContext.broadcast(known)
    return (chunks.groupBy("chunk").cogroup(answers.where("chunk >= 0").groupBy("chunk"))
            .applyInArrow(_score(sent, order, discount, total, places, ids),
                          f"doc_id {kind}, train boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
                          "base_score double, score double"))
