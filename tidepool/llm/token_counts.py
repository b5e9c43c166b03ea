"""Token counts of whole texts by a public tokenizer, huge texts in overlapping chunks.

A text of at most ``chunk`` characters is one call of the library.  A longer one
is cut into chunks of that length, each followed by ``overlap`` characters of the
next one; chunks travel as rows of their own, so one huge text is spread over
many tasks, and each is encoded with offsets.  Two neighbours are spliced at a
position in their overlap where a pre-token starts in both.

Why such a position is safe: the scan that cuts a text into pre-tokens looks
ahead but never back, and merges stay inside a pre-token.  So what follows a
pre-token's start depends on the text from there on alone.  The earlier chunk's
starts are those of the whole text (it begins at such a start, by induction, and
starts near its end, which unseen text could move, are left out); a start that
the later chunk has too is where the later chunk has fallen into step, and all
its tokens from there on are the whole text's.  Marks and jamos that may combine
with the character before them are never taken.

Where two neighbours share no start (one word longer than the overlap), the text
is done again with chunks and overlaps eight times as long, until they align or
one chunk holds it all.

If the tokenizer drops white space, a text of ordinary length is cut at spaces,
tabs and line ends, which no pre-token, normalisation or special string spans,
and the counts of such segments are remembered (a bounded number a process).
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import anchored, whole_row

CHUNK = 1 << 15    # characters of a chunk
OVERLAP = 256      # characters of the next chunk that a chunk sees
WIDER = 8          # times longer, where neighbours don't align
REMEMBERED = 400_000  # segments of a generation; two are held
BATCH = 2_000_000  # characters handed to the library at once
TOGETHER = 500     # segments of a call
MARK = "\ue000"    # stands between segments: private use, so no text means it
_CUT = re.compile("[ \n\t\r]+")
COUNTED = "n_bytes bigint, n_tokens bigint"
# What the proof above covers; other parts may look back or join pre-tokens.
NORMALIZERS = {"NFC", "NFD", "NFKC", "NFKD", "Lowercase", "Replace"}
PRE_TOKENIZERS = {"Split", "ByteLevel", "Digits", "Whitespace", "WhitespaceSplit"}


def _kinds(part: dict | None, inner: str) -> set[str]:
    if not part:
        return set()
    return {x["type"] for x in part[inner]} if part["type"] == "Sequence" else {part["type"]}


class Counter:
    """One tokenizer file with the remembered counts of short segments."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        odd = (_kinds(spec.get("normalizer"), "normalizers") - NORMALIZERS) | (
            _kinds(spec.get("pre_tokenizer"), "pretokenizers") - PRE_TOKENIZERS)
        if odd or spec["model"]["type"] != "BPE" or "(?<" in json.dumps(spec.get("pre_tokenizer")):
            raise ValueError(f"chunks of this tokenizer can't be spliced safely: {sorted(odd)}")
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.special = max((len(t["content"]) for t in spec["added_tokens"]), default=0)
        pre = self.tok.pre_tokenizer
        spaces = any(t.get("lstrip") or t.get("rstrip") or _CUT.search(t["content"]) for t in spec["added_tokens"])
        self.drops_space = pre is not None and not spaces and not pre.pre_tokenize_str(" \n\t\r")
        self.mark = self.tok.encode(MARK, add_special_tokens=False).ids
        self.recent: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def lengths(self, texts: list[str]) -> list[int]:
        """Tokens of each text, by the library."""
        out, at = [], 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= BATCH):
                size += len(texts[end])
                end += 1
            out += [len(e) for e in self.tok.encode_batch_fast(texts[at:end], add_special_tokens=False)]
            at = end
        return out

    def _segments(self, segments: list[str]) -> list[int]:
        """Tokens of each of many short segments: many to a call, a mark between
        them.  White space parts the mark from its neighbours, so its ids stand
        for it alone, and no segment given here holds the mark itself."""
        out = []
        for at in range(0, len(segments), TOGETHER):
            part = segments[at:at + TOGETHER]
            if any(MARK in s for s in part):
                out += self.lengths(part)
                continue
            ids = np.array(self.tok.encode(f" {MARK} ".join(part), add_special_tokens=False).ids, np.int64)
            m = len(self.mark)
            found = np.ones(max(0, len(ids) - m + 1), bool)
            for i, x in enumerate(self.mark):
                found &= ids[i:len(ids) - m + 1 + i] == x
            ends = np.append(np.flatnonzero(found), len(ids))
            begins = np.append(0, ends[:-1] + m)
            out += (ends - begins).tolist()
        return out

    def counts(self, texts: list[str]) -> list[int]:
        if not self.drops_space:
            return self.lengths(texts)
        parts = [_CUT.split(t) for t in texts]
        missed = set().union(*parts).difference(self.recent) if parts else set()
        if len(self.recent) > REMEMBERED:  # segments still in use move up again
            self.older, self.recent, missed = self.recent, {}, missed | set().union(*parts)
        known = self.recent
        for s in [s for s in missed if s in self.older]:
            known[s] = self.older[s]
            missed.discard(s)
        new = list(missed)
        passing = dict(zip(new, self._segments(new), strict=True))
        known.update((s, n) for s, n in passing.items() if len(s) < 64)
        long = {s: n for s, n in passing.items() if len(s) >= 64}
        if not long:
            return [sum(map(known.__getitem__, p)) for p in parts]
        return [sum(long[s] if s in long else known[s] for s in p) for p in parts]

    def starts(self, text: str, at: int, until: int) -> tuple[int, list[int], list[int]]:
        """All tokens of the text, and for the pre-token starts in [at, until) the
        position and the number of tokens before it."""
        e = self.tok.encode(text, add_special_tokens=False)
        where, before, last = [], [], object()
        for n, ((start, end), word) in enumerate(zip(e.offsets, e.word_ids, strict=True)):
            if (word is None or word != last) and at <= start < until and end > start and _starts_anew(text[start]):
                if not where or where[-1] != start:
                    where.append(start)
                    before.append(n)
            last = word
        return len(e), where, before


def _starts_anew(c: str) -> bool:
    """Whether normalisation can't join the character with the one before it."""
    return c.isascii() or not (unicodedata.category(c)[0] == "M" or "ᅠ" <= c <= "ᇿ")


@lru_cache(maxsize=2)
def load(path: str) -> Counter:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallel part
    return Counter(path)


def _counted(path: str, text_at: int):
    def run(batches):
        model = load(path)
        for b in batches:
            texts = [x or "" for x in b.column(text_at).to_pylist()]
            out, at = [], 0
            while at < len(texts):  # a bounded number of characters at a time
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) <= BATCH):
                    size += len(texts[end])
                    end += 1
                out += model.counts(texts[at:end])
                at = end
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(x.encode("utf-8", "surrogatepass")) for x in texts], pa.int64()),
                 pa.array(out, pa.int64())], ["r", "n_bytes", "n_tokens"])
    return run


def _cut(chunk: int, overlap: int):
    """(text_key, text) -> a row a chunk: text_key, k, last, chunk text."""
    def run(batches):
        for b in batches:
            for key, text in zip(b.column("text_key").to_pylist(), b.column("text"), strict=True):
                text = text.as_py()
                n = -(-len(text) // chunk)
                for first in range(0, n, 16):
                    ks = range(first, min(n, first + 16))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key] * len(ks)), pa.array(list(ks), pa.int64()),
                         pa.array([k == n - 1 for k in ks]),
                         pa.array([text[k * chunk:(k + 1) * chunk + overlap] for k in ks])],
                        ["text_key", "k", "last", "piece"])
    return run


def _encoded(path: str, chunk: int, overlap: int):
    """Chunk rows -> tokens, and the pre-token starts in both overlaps, counted from the overlap's begin."""
    ints = pa.list_(pa.int64())

    def run(batches):
        model = load(path)
        for b in batches:
            rows = []
            for key, k, last, piece in zip(*(b.column(n).to_pylist() for n in ("text_key", "k", "last", "piece")),
                                           strict=True):
                n, where, before = model.starts(piece, 0, len(piece))
                head = [i for i, p in enumerate(where) if p < overlap]
                # an unseen rest could still change the last pre-token and a special string
                sure = min(where[-1] if where else 0, len(piece) - model.special)
                tail = [] if last else [i for i, p in enumerate(where) if p >= chunk and p < sure]
                rows.append((key, k, last, n, [where[i] for i in head], [before[i] for i in head],
                             [where[i] - chunk for i in tail], [before[i] for i in tail]))
            cols = list(zip(*rows, strict=True)) or [()] * 8
            kinds = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), ints, ints, ints, ints]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                             ["text_key", "k", "last", "n", "head", "head_n", "tail", "tail_n"])
    return run


def _spliced(texts: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """text_key, n_tokens (null where two neighbours share no pre-token start)."""
    chunks = (texts.mapInArrow(_cut(chunk, overlap), "text_key string, k bigint, last boolean, piece string")
              .groupBy("text_key", "k").agg(F.first("last").alias("last"), F.first("piece").alias("piece")))
    e = anchored(chunks.mapInArrow(_encoded(path, chunk, overlap),
                                   "text_key string, k bigint, last boolean, n bigint, head array<bigint>, "
                                   "head_n array<bigint>, tail array<bigint>, tail_n array<bigint>"))
    after = e.select("text_key", (F.col("k") - 1).alias("k"), "head", "head_n")
    left = e.where(~F.col("last")).select("text_key", "k", "tail", "tail_n")
    at = F.array_min(F.array_intersect("tail", "head"))
    pair = left.join(after, ["text_key", "k"], "left").withColumn("at", at)
    # tokens of the earlier chunk up to the splice, less those the later one has before it
    gain = (F.element_at("tail_n", F.array_position("tail", F.col("at")).cast("int"))
            - F.element_at("head_n", F.array_position("head", F.col("at")).cast("int")))
    parts = pair.select("text_key", F.when(F.col("at").isNotNull(), gain).alias("n")).unionByName(
        e.where("last").select("text_key", "n"))
    return parts.groupBy("text_key").agg(
        F.when(F.count_if(F.col("n").isNull()) == 0, F.sum("n")).alias("n_tokens"))


def count_tokens(docs: DataFrame, tokenizer_path: str, *, text_col: str = "text", limit: int = 2048,
                 chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Every row of ``docs`` with its token count: all columns, then ``n_bytes``
    (of the UTF-8 form), ``n_tokens`` and ``over_limit`` (more than ``limit``).

    Counts are the library's on the whole text, without added special tokens,
    truncation or padding; special strings inside a text count as its default
    does.  Null texts count as empty: 0 bytes, 0 tokens.  Rows with equal texts
    (repeated rows, copies under several ids) each get their row; huge equal
    texts are encoded once.  Ids may be null or repeat: they are not used.  An
    empty table gives no rows.  Columns named like an added one are replaced; no
    other column can clash with the job's own.  The tokenizer file (.json, BPE)
    lies at the same path on every executor.
    """
    if overlap > chunk:
        raise ValueError("an overlap reaches into one chunk only")
    added = ["n_bytes", "n_tokens", "over_limit"]
    kept = docs.drop(*[c for c in added if c != text_col])
    rows = kept.select(whole_row(kept).alias("r"), F.col(f"`{text_col}`").cast("string").alias("text"))
    huge = F.coalesce(F.length("text") > chunk, F.lit(False))
    row_type = rows.schema["r"].dataType.simpleString()
    short = rows.where(~huge).mapInArrow(_counted(tokenizer_path, 1), f"r {row_type}, {COUNTED}")
    keyed = rows.where(huge).select("r", F.sha2(F.col("text").cast("binary"), 256).alias("text_key"), "text")

    done, size, lap, waiting = None, chunk, overlap, keyed.select("text_key", "text")
    while True:
        got = anchored(_spliced(waiting, tokenizer_path, size, lap))
        settled = got.where("n_tokens is not null")
        done = settled if done is None else done.unionByName(settled)
        failed = got.where("n_tokens is null").select("text_key")
        if failed.isEmpty():
            break
        size, lap = size * WIDER, lap * WIDER
        waiting = keyed.select("text_key", "text").join(failed, "text_key", "left_semi")
    spliced = (keyed.select("r", "text_key", F.octet_length("text").cast("bigint").alias("n_bytes"))
               .join(done, "text_key").select("r", "n_bytes", "n_tokens"))
    out = short.unionByName(spliced)
    plain = [c for c in kept.columns if c not in added]
    return out.select(*[F.col(f"r.`{c}`").alias(c) for c in plain], "n_bytes", "n_tokens",
                      (F.col("n_tokens") > limit).alias("over_limit"))
