"""SentencePiece (merge type) encoding by a prefix table, and decoding.

The merge encoding of every prefix of a text ends in one unique token.  The
table holds that token for each prefix: an Aho-Corasick automaton over the
pieces gives the candidates that end at a position, and a candidate is the
right one when it is pair-compatible with the last token of the prefix before
it, i.e. merging the two tokens' characters gives exactly those two tokens.
Walking back from the end recovers the ids.  One pass, linear in the text.

Pair compatibility is decided on the two tokens' edges only.  While its
characters merge, the right edge of the left token runs through a short chain
of pieces, and so does the left edge of the right token; the pair breaks when
a piece spanning the boundary would be merged earlier than the edges' own next
merges (on a tie the pair further left goes first).

Pieces of white space alone share one score, so their merges have no order of
ranks.  They come last of all and go left to right; a run of spaces before a
word is therefore settled by itself (``_spaces``).

A text is cut where no piece can span: before each run of spaces, around line
ends and tabs, and between a word and a mark that no piece holds after a letter.  The encodings of such segments are remembered (a bounded
number a process); segments have no length limit.

Null texts count as empty.  Characters without a piece are spelled in bytes.
"""

from __future__ import annotations

import hashlib
import re
import string
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import kept_model

SPACE = "▁"
CACHED_SEGMENTS = 250_000  # twice as many are held
KNOWN_PAIRS = 250_000
_WORD = re.compile(r"\w")
INF = float("inf")


class _Segments(dict):
    """segment -> its ids as two-byte numbers, of recent segments."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode
        self.older: dict[str, bytes] = {}

    def __missing__(self, s: str) -> bytes:
        got = self.older.get(s)
        if got is None:
            got = array("H", self.encode(s)).tobytes()
        if len(s) < 64:
            if len(self) >= CACHED_SEGMENTS:  # those still in use move up again
                self.older = dict(self)
                self.clear()
            self[s] = got
        return got


class PieceModel:
    """Tables of one model file.

    The file is read through the sentencepiece library; only its vocabulary
    (pieces, scores, kinds) is used, none of its encoding.
    """

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        if n > 1 << 16:
            raise ValueError("ids are kept in two bytes")
        self.piece = [sp.id_to_piece(i) for i in range(n)]
        self.byte_id = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_of = {i: b for b, i in enumerate(self.byte_id)}
        special = {i for i in range(n) if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)
                   or sp.is_unused(i)}
        self.special = special
        # ids that mean the same text wherever they stand: pieces and ASCII bytes
        self.surface = [p.replace(SPACE, " ") for p in self.piece]
        for b in range(128):
            self.surface[self.byte_id[b]] = chr(b)
        self.in_context = special - {self.byte_id[b] for b in range(128)}
        self.unknown = sp.unk_id()
        usable = [i for i in range(n) if i not in special]
        self.id_of = {self.piece[i]: i for i in usable}
        spaces = [i for i in usable if not self.piece[i].strip(SPACE)]
        self.space_id = {len(self.piece[i]): i for i in spaces}
        self.longest_space = max(self.space_id, default=0)
        if any(SPACE in self.piece[i].lstrip(SPACE) for i in usable) or any(
                c in self.piece[i] for i in usable if len(self.piece[i]) > 1 for c in "\n\t"):
            raise ValueError("a piece spans a segment boundary; this vocabulary needs another cut")
        if any(self.piece[i].startswith(SPACE * 2) and self.piece[i].strip(SPACE) for i in usable):
            raise ValueError("a piece starts with several spaces and goes on; not supported")
        # merge rank of the pieces that words are merged to (lower is earlier)
        self.rank = {self.piece[i]: -sp.get_score(i) for i in usable
                     if len(self.piece[i]) > 1 and self.piece[i].strip(SPACE)}
        if len(set(self.rank.values())) != len(self.rank):
            raise ValueError("two pieces share a score; their merges have no order")
        self.length = [len(p) for p in self.piece]
        self.left_chain: dict[int, tuple] = {}
        self.right_chain: dict[int, tuple] = {}
        self.automaton = ahocorasick.Automaton()
        for p, i in self.id_of.items():
            if (len(p) == 1 or p in self.rank) and self._chains(i, p):
                self.automaton.add_word(p, (i, len(p)))
        self.automaton.make_automaton()
        self._compatible: dict[tuple[int, int], bool] = {}
        self._segments = _Segments(self._segment)
        self.decimal = [str(i) for i in range(n)]
        # a word ends before a mark that no piece holds after the word's last character
        before: dict[str, set[str]] = {c: {"_"} for c in string.punctuation if c != "_"}
        for p in self.id_of:
            for x, y in zip(p, p[1:], strict=False):
                if y in before and _WORD.match(x):
                    before[y].add(x)
        marks = [c for c, xs in before.items() if len(xs) < 9]
        odd = "".join(sorted(set().union(*(before[c] for c in marks))))
        self._cut = re.compile(
            (f"{SPACE}*[^\\W{odd}]++(?![^{SPACE}\n\t{re.escape(''.join(marks))}])|" if marks else "")
            + f"{SPACE}+[^{SPACE}\n\t]*|[^{SPACE}\n\t]+|[\n\t]")

    # ------------------------------------------------------------- merges
    def _merge(self, chars: str) -> tuple[list[str], list[str], list[str]]:
        """Plain merging of a short string: the result and the pieces that its
        left and its right end went through."""
        parts, left, right = list(chars), [chars[0]], [chars[-1]]
        while len(parts) > 1:
            best = min(((self.rank.get(parts[i] + parts[i + 1], INF), i)
                        for i in range(len(parts) - 1)))
            if best[0] == INF:
                break
            i = best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            if i == 0:
                left.append(parts[0])
            if i == len(parts) - 1:
                right.append(parts[-1])
        return parts, left, right

    def _chains(self, i: int, p: str) -> bool:
        """Remember the edge chains of a piece; False if merging its characters
        gives something else, so that the piece never comes out."""
        parts, left, right = self._merge(p)
        if parts != [p]:
            return False
        for chains, own in ((self.left_chain, left), (self.right_chain, right)):
            at, steps = 0.0, []
            for k, x in enumerate(own):
                # alive from `at` until the next piece of the chain is merged
                at = max(at, self.rank.get(x, 0.0))
                end = max(at, self.rank[own[k + 1]]) if k + 1 < len(own) else INF
                steps.append((x, at, end, self.rank[own[k + 1]] if k + 1 < len(own) else INF))
            chains[i] = tuple(steps)
        return True

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the characters of the two tokens gives these two."""
        rank, known = self.rank, True
        for x, x_from, x_to, x_next in self.right_chain[a]:
            for y, y_from, y_to, y_next in self.left_chain[b]:
                r = rank.get(x + y)
                if (r is not None and x_from <= y_to and y_from <= x_to
                        and r < x_next and r <= y_next):
                    known = False
        if len(self._compatible) < KNOWN_PAIRS:
            self._compatible[a, b] = known
        return known

    # ------------------------------------------------------------- encoding
    def last_tokens(self, s: str) -> list[int]:
        """The prefix table: entry i is the last token of the merge encoding of
        s[:i + 1], or -1 for a character without a piece."""
        table = [-1] * len(s)
        known = self._compatible
        for end, (p, n) in self.automaton.iter(s):
            if table[end] < 0:
                before = table[end - n] if end >= n else -1
                if before >= 0:
                    fits = known.get((before, p))
                    if fits is None:
                        fits = self.compatible(before, p)
                    if not fits:
                        continue
                table[end] = p
        return table

    def _word(self, s: str) -> list[int]:
        """Ids of s, back to front from the prefix table."""
        table, length, out, i = self.last_tokens(s), self.length, [], len(s) - 1
        while i >= 0:
            t = table[i]
            if t < 0:
                out.extend(self.byte_id[b] for b in reversed(s[i].encode("utf-8")))
                i -= 1
            else:
                out.append(t)
                i -= length[t]
        out.reverse()
        return out

    def _spaces(self, n: int) -> list[int]:
        """Ids of n spaces in a row: equal scores, so the leftmost pair that
        makes a piece is merged until none does; a longest piece is final."""
        whole, rest = divmod(n, self.longest_space)
        parts = [1] * rest
        i = 0
        while i + 1 < len(parts):
            if parts[i] + parts[i + 1] in self.space_id:
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
                i = 0
            else:
                i += 1
        return [self.space_id[self.longest_space]] * whole + [self.space_id[k] for k in parts]

    def _segment(self, s: str) -> list[int]:
        if s[0] != SPACE:
            return self._word(s)
        n = len(s) - len(s.lstrip(SPACE))
        if n == len(s):
            return self._spaces(n)
        ids = self._word(s[n - 1:])
        if n > 1 and ids[0] == self.space_id[1]:  # the space stays alone, and joins those before it
            return self._spaces(n) + ids[1:]
        return self._spaces(n - 1) + ids

    def encode(self, text: str | None) -> list[int]:
        """Ids without begin or end ids."""
        if not text:
            return []
        parts = map(self._segments.__getitem__, self._cut.findall(SPACE + text.replace(" ", SPACE)))
        return array("H", b"".join(parts)).tolist()

    # ------------------------------------------------------------- decoding
    def decode(self, ids) -> str:
        """Text of ids: pieces joined, spaces restored, the leading space that
        encoding added dropped, runs of byte pieces read as UTF-8 (each byte
        that is part of no character becomes U+FFFD)."""
        if self.in_context.isdisjoint(ids):
            text = "".join(map(self.surface.__getitem__, ids))
            return text[1:] if ids and self.piece[ids[0]].startswith(SPACE) else text
        out, run, first = [], bytearray(), True
        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                run.append(b)
                first = False
                continue
            if run:
                out.append(_utf8_or_marks(run))
                run = bytearray()
            if i == self.unknown:
                out.append(" ⁇ ")
                first = False
                continue
            if i in self.special:
                continue
            p = self.piece[i]
            if first:
                p = p.removeprefix(SPACE)
                first = False
            out.append(p)
        if run:
            out.append(_utf8_or_marks(run))
        return "".join(out).replace(SPACE, " ")


def _utf8_or_marks(run: bytearray) -> str:
    try:
        return run.decode("utf-8")
    except UnicodeDecodeError:
        pass
    out, i = [], 0
    while i < len(run):
        n = 1 if run[i] < 0x80 else 2 if 0xC2 <= run[i] < 0xE0 else 3 if 0xE0 <= run[i] < 0xF0 else 4
        try:
            out.append(bytes(run[i:i + n]).decode("utf-8"))
            i += n
        except UnicodeDecodeError:
            out.append("�")
            i += 1
    return "".join(out)


def load(path: str) -> PieceModel:
    """Kept until another operator's task comes to this process."""
    return kept_model(("pieces", path), lambda: PieceModel(path))


def encode_documents(docs: DataFrame, model_path: str, *, id_col: str = "doc_id",
                     text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Every row of ``docs`` with its encoding, the other columns untouched.

    Adds ``n_tokens`` bigint, ``ids_sha256`` (of decimal ids joined by commas),
    ``decoded`` string (the decoded text) and, if asked, ``ids`` array<int>.
    The model file lies at the same path on every executor.  Columns of the
    input named like an added one are replaced.
    """
    added = ["n_tokens", "ids_sha256", "decoded"] + (["ids"] if with_ids else [])
    rest = [c for c in docs.columns if c not in added]
    src = docs.select(*[F.col(f"`{c}`") for c in rest], *[F.col(f"`{text_col}`")][:text_col not in rest])

    at = rest.index(text_col) if text_col in rest else len(rest)

    def run(batches):
        model = load(model_path)
        for b in batches:
            ns, digests, decoded, ids_of = [], [], [], array("i")
            for text in b.column(at):
                ids = model.encode(text.as_py())
                ns.append(len(ids))
                digests.append(hashlib.sha256(",".join(map(model.decimal.__getitem__, ids)).encode()).hexdigest())
                decoded.append(model.decode(ids))
                if with_ids:
                    ids_of.extend(ids)
            cols = [pa.array(ns, pa.int64()), pa.array(digests, pa.string()),
                    pa.array(decoded, pa.string())]
            if with_ids:
                ends = np.concatenate(([0], np.cumsum(ns))).astype(np.int32)
                cols.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(ids_of, np.int32))))
            yield pa.RecordBatch.from_arrays([*b.columns[:len(rest)], *cols], [*rest, *added])

    new = "n_tokens bigint, ids_sha256 string, decoded string" + ", ids array<int>" * with_ids
    return src.mapInArrow(run, StructType(src.schema.fields[:len(rest)] + StructType.fromDDL(new).fields))
