"""Personal data by weak supervision, in DataFrame operations only.

Base spans (email, ip, card, phone) are regular-expression matches that pass
their kind's test; they always stand.  Beside them, wider patterns propose
candidates of further kinds (secret, ssn, tel, name), and labelers vote on each:
a stricter expression (``shape``), a gazetteer of words that announce or rule
out such data just before it (``words``), the characters around it (``around``)
and its make-up (``mix``, ``size``).  A vote is 1, -1 or 0 (no opinion).

Nobody knows which candidates are right.  Expectation-maximisation estimates
it from the votes alone: every labeler has, for right and for wrong candidates
of a kind, its own probability of each vote; these reliabilities and the
candidates' probabilities are estimated in turn.  The work runs on counts of
vote patterns, added up over all documents; there are at most
``kinds * 3 ** labelers`` patterns whatever the corpus, and only they reach the
driver.  The probabilities then train the final span classifier, a logistic
regression over kind, votes and length class, which is applied as one column
expression: it also judges patterns on which the labelers disagree or stay out.

Positions are code points, end exclusive.  Text between matches and the
matches themselves are counted off in one pass a pattern; patterns start only
where a run of their characters starts and never backtrack into a run.  Places
are added up by doubling steps and read from pieces of the text, so a text with
n matches takes n log n steps, however long it is.

Null texts are empty.  Repeated rows are found each by itself, an empty table
gives no rows (and no weights), and other columns come back as they were; two
names are taken, ``base_spans`` and ``spans``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import whole_row

# Fixed patterns.  Each base pattern finds the matches of the expression in its
# comment; a run of the first class is entered at its start, or where the last
# match ended.
BASE = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?+[0-9])++",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KIND_ORDER = ["email", "ip", "card", "phone", "secret", "ssn", "tel", "name"]
CANDIDATES = {
    "secret": r"(?<![A-Za-z0-9])(?=[A-Za-z]{0,64}+[0-9])[A-Za-z0-9]{16,64}+(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "tel": r"(?<![0-9+).-])(?<!\+[0-9]{1,3} )(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "name": r"(?<![\p{L}])(?:Mr|Mrs|Ms|Dr|Herr|Frau|Señor|Señora|Monsieur|Madame)\.?\x20\p{Lu}\p{L}{1,30}(?![\p{L}])",
}
SHAPES = {
    "secret": r"^(?:AKIA[A-Z0-9]{16}|[0-9a-f]{16,64}|(?=[^0-9]*[0-9])(?=[^a-z]*[a-z])(?=[^A-Z]*[A-Z]).{20,64})$",
    "ssn": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$",
    "tel": r"^\(?[2-9]",
    "name": r"\p{Lu}\p{Ll}+$",
}
ANNOUNCE = (r"(?i)(?:password|passwd|pwd|passwort|contraseña|secret|token|api.?key|access.?key|credential|"
            r"phone|tel|call|fax|mobile|teléfono|téléphone|telefon|handy|ssn|social security|name|contact|from|to)"
            r"[\p{L}]{0,3}[\x20:=\"'(-]{0,4}$")
RULE_OUT = r"(?i)(?:version|licen[sc]e|section|page|isbn|issn|vol|chapter|figure|table)[\x20.:#]{0,3}$"
LABELERS = ("shape", "words", "around", "mix", "size")
BEFORE, AFTER = 28, 2
PIECE = 256
ROUNDS = 60


# ------------------------------------------------------------------ positions
def _let(value: Column, fn) -> Column:
    """``fn(value)`` with the value computed once, however often fn names it."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def _scan(arr: Column, join) -> Column:
    """Every element joined with all before and after it, by doubling steps:
    ``join(x, before, after)`` sees the elements 1, 2, 4, … places away (null
    beyond the ends), so n elements take n log n steps and no array grows."""
    def over(a: Column) -> Column:
        rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(a), F.lit(1)))).cast("int"))

        def step(acc, k):
            far = F.call_function("shiftleft", F.lit(1), k)
            return F.transform(acc, lambda x, i: join(x, F.get(acc, i - far), F.get(acc, i + far)))

        return F.aggregate(rounds, a, step)

    return _let(arr, over)


def _found(text: Column, pattern: str) -> Column:
    """array<struct<s, e, t>> of the matches, leftmost and non-overlapping."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # the last gap has no match after it
    steps = F.filter(F.arrays_zip(gaps.alias("g"), hits.alias("h")), lambda x: x["h"].isNotNull())
    ends = _scan(F.transform(steps, lambda x: F.struct((x["g"] + F.length(x["h"])).cast("bigint").alias("e"),
                                                       x["h"].alias("t"))),
                 lambda x, before, _: F.struct((x["e"] + F.coalesce(before["e"], F.lit(0))).alias("e"),
                                               x["t"].alias("t")))
    return F.transform(ends, lambda x: F.struct((x["e"] - F.length(x["t"])).alias("s"), x["e"].alias("e"),
                                                x["t"].alias("t")))


def _pieces(text: Column) -> Column:
    """The text in pieces of ``PIECE`` code points, so that reading at a place
    doesn't walk there from the beginning."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def _between(pieces: Column, start: Column, end: Column) -> Column:
    """The text from ``start`` to ``end`` (exclusive; may lie beyond the text)."""
    first = F.floor(start / PIECE).cast("int")
    last = F.floor((end - 1) / PIECE).cast("int")
    part = F.array_join(F.slice(pieces, first + 1, last - first + 1), "")
    return F.when(end > start, F.substring(part, (start - first * PIECE + 1).cast("int"),
                                           (end - start).cast("int"))).otherwise("")


def _passes(kind: str, t: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(t, r"\."), lambda p: F.coalesce(p.try_cast("bigint") <= 255, F.lit(False)))
    if kind == "card":
        digits = F.translate(t, " -", "")
        return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    return F.length(F.translate(t, "+ ().-", "")).between(10, 15)


_EMPTY = "cast(array() as array<struct<s:bigint,e:bigint,t:string>>)"


def _sparse(text: Column, needs: str, spans: Column) -> Column:
    """Look only into texts that hold a character the pattern needs."""
    holds = text.contains(needs) if len(needs) == 1 else text.rlike(needs)
    return F.when(holds, spans).otherwise(F.expr(_EMPTY))


def _with_base(rows: DataFrame) -> DataFrame:
    text = F.col("_text")
    needs = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]{2}|[0-9][ -][0-9]", "phone": "+"}

    def test(kind: str):
        return lambda x: _passes(kind, x["t"])

    return rows.withColumns({f"_{kind}": F.filter(_sparse(text, needs[kind], _found(text, p)), test(kind))
                             for kind, p in BASE.items()})


# ---------------------------------------------------------------- candidates
def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, F.lit(1)).when(no, F.lit(-1)).otherwise(F.lit(0))


def _described(kind: str, x: Column) -> Column:
    """A candidate with its votes; ``b`` and ``a`` are the text around it."""
    t, before, after = x["t"], x["b"], x["a"]
    digits = F.length(F.translate(F.lower(t), "abcdefghijklmnopqrstuvwxyz().- ", ""))
    share = digits / F.length(t)
    if kind == "secret":
        mix = _vote(share.between(0.15, 0.85), share < 0.08)
        size = _vote(F.length(t) >= 18, F.length(t) < 18)
    elif kind == "name":
        mix, size = F.lit(0), _vote(F.length(t) >= 8, F.length(t) < 5)
    else:
        mix = _vote(~t.rlike(r"^[^0-9]*([0-9])(?:[^0-9]|\1)*$"), F.lit(True))
        size = F.lit(0)
    votes = {
        "shape": _vote(t.rlike(SHAPES[kind]), F.lit(True)),
        "words": _vote(before.rlike(ANNOUNCE), before.rlike(RULE_OUT)),
        "around": _vote(before.rlike(r"[=:\"'(]\x20?$"),
                        before.rlike(r"[\p{L}0-9_/]$") | after.rlike(r"^[\p{L}0-9_/]")),
        "mix": mix, "size": size}
    return F.struct(F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e"),
                    *[votes[v].cast("tinyint").alias(v) for v in LABELERS],
                    F.least(F.expr("3"), F.floor(F.length(t) / 16)).cast("tinyint").alias("len"))


def _free(base: Column, cands: Column) -> Column:
    """The candidates that touch no base span: none that begins earlier reaches
    past the candidate's start, and none begins within it."""
    no = F.lit(None).cast("bigint")
    spans = F.transform(base, lambda x: F.struct(
        x["s"].alias("s"), F.lit(-1).alias("k"), x["e"].alias("e"), x["t"].alias("t"),
        x["e"].alias("hi"), x["s"].alias("lo")))
    others = F.transform(cands, lambda x: F.struct(
        x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"), x["t"].alias("t"), no.alias("hi"), no.alias("lo")))

    def join(x, before, after):
        return F.struct(*[x[c].alias(c) for c in ("s", "k", "e", "t")],
                        F.greatest(x["hi"], before["hi"]).alias("hi"), F.least(x["lo"], after["lo"]).alias("lo"))

    placed = _scan(F.array_sort(F.concat(spans, others)), join)
    return F.filter(placed, lambda x: (x["k"] >= 0) & (F.coalesce(x["hi"], x["s"]) <= x["s"])
                    & (F.coalesce(x["lo"], x["e"]) >= x["e"]))


def _with_candidates(rows: DataFrame) -> DataFrame:
    """Adds ``_cands``: candidates that touch no base span."""
    text = F.col("_text")
    needs = {"secret": "[0-9]", "ssn": "-[0-9]{2}-", "tel": "[0-9]{4}",
             "name": r"(?:Mr|Mrs|Ms|Dr|Herr|Frau|Señor|Señora|Monsieur|Madame)[\x20.]"}

    def numbered(n: int):
        return lambda x: F.struct(x["s"].alias("s"), F.lit(n).alias("k"), x["e"].alias("e"), x["t"].alias("t"))

    found = rows.withColumn("_found", F.concat(*[
        F.transform(_sparse(text, needs[k], _found(text, p)), numbered(n))
        for n, (k, p) in enumerate(CANDIDATES.items())]))
    base = F.concat(*[F.col(f"_{k}") for k in BASE])
    some = F.size("_found") > 0
    found = (found.withColumn("_left", F.when(some, _free(base, F.col("_found"))))
             .withColumn("_pieces", F.when(F.size("_left") > 0, _pieces(text))))
    around = F.transform("_left", lambda x: F.struct(
        x["s"].alias("s"), x["e"].alias("e"), x["t"].alias("t"), x["k"].alias("k"),
        _between(F.col("_pieces"), F.greatest(x["s"] - BEFORE, F.lit(0)), x["s"]).alias("b"),
        _between(F.col("_pieces"), x["e"], x["e"] + AFTER).alias("a")))

    def described(x):
        one = None
        for n, k in enumerate(CANDIDATES):
            one = (F.when(x["k"] == n, _described(k, x)) if one is None
                   else one.when(x["k"] == n, _described(k, x)))
        return one

    none = F.expr(f"cast(array() as array<struct<kind:string,s:bigint,e:bigint,"
                  f"{','.join(f'{v}:tinyint' for v in LABELERS)},len:tinyint>>)")
    return (found.withColumn("_around", F.when(F.size("_left") > 0, around))
            .withColumn("_cands", F.coalesce(F.transform("_around", described), none))
            .drop("_found", "_left", "_pieces", "_around"))


# ------------------------------------------------------- estimation (counts only)
def estimate(patterns: list[tuple[str, tuple[int, ...], float]], rounds: int = ROUNDS):
    """Expectation-maximisation over (kind, votes, count): the probability of
    each (kind, votes) of being right, and the reliabilities found.

    Starts from labelers that are right four times out of five; counts are
    smoothed, so votes that never occur keep a small probability.
    """
    kinds = sorted({k for k, _, _ in patterns})
    prior = {k: 0.5 for k in kinds}
    start = {True: {1: 0.6, 0: 0.25, -1: 0.15}, False: {1: 0.15, 0: 0.25, -1: 0.6}}
    given = {(k, i, y): dict(start[y]) for k in kinds for i in range(len(LABELERS)) for y in (True, False)}
    right: dict[tuple, float] = {}
    for _ in range(rounds):
        for k, votes, _n in patterns:
            odds = math.log(prior[k] / (1 - prior[k])) + sum(
                math.log(given[k, i, True][v] / given[k, i, False][v]) for i, v in enumerate(votes))
            right[k, votes] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        for k in kinds:
            own = [(v, n, right[k, v]) for kk, v, n in patterns if kk == k]
            total = sum(n for _, n, _ in own)
            prior[k] = min(0.99, max(0.01, sum(n * p for _, n, p in own) / total))
            for i in range(len(LABELERS)):
                for y in (True, False):
                    mass = {v: 1.0 * start[y][v] for v in (-1, 0, 1)}
                    for votes, n, p in own:
                        mass[votes[i]] += n * (p if y else 1 - p)
                    whole = sum(mass.values())
                    given[k, i, y] = {v: m / whole for v, m in mass.items()}
    return right, given


def _features(kind: str, votes: tuple[int, ...], length: int) -> list[float]:
    """Bias, kind, each vote for and against, length class."""
    return ([1.0] + [float(kind == k) for k in CANDIDATES] + [float(v == 1) for v in votes]
            + [float(v == -1) for v in votes] + [float(length == c) for c in range(1, 4)])


def train(counts: list[tuple[str, tuple[int, ...], int, float]], right: dict, steps: int = 300) -> list[float]:
    """Logistic regression on the estimated probabilities, by weighted gradient
    steps over the patterns (not over the candidates)."""
    rows = [(_features(k, v, c), n, right[k, v]) for k, v, c, n in counts]
    total = sum(n for _, n, _ in rows)
    w = [0.0] * len(rows[0][0])
    speed = [0.0] * len(w)
    for _ in range(steps):
        grad = [1e-4 * x for x in w]
        for x, n, y in rows:
            s = sum(a * b for a, b in zip(w, x, strict=True))
            err = (1 / (1 + math.exp(-max(-30.0, min(30.0, s)))) - y) * n / total
            for j, a in enumerate(x):
                if a:
                    grad[j] += err
        for j, g in enumerate(grad):
            speed[j] = 0.9 * speed[j] - 2.0 * g
            w[j] += speed[j]
    return w


def learn(docs: DataFrame, text_col: str = "text") -> list[float] | None:
    """Weights of the span classifier from all candidates of the documents;
    null if there are none."""
    cands = _with_candidates(_with_base(docs.select(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
                                                    .alias("_text"))))
    got = (cands.select(F.explode("_cands").alias("c")).groupBy("c.kind", *[f"c.{v}" for v in LABELERS], "c.len")
           .agg(F.count("*").alias("n")).collect())
    if not got:
        return None
    counts = sorted((r.kind, tuple(r[v] for v in LABELERS), r.len, float(r.n)) for r in got)
    merged: dict[tuple, float] = {}
    for k, v, _c, n in counts:
        merged[k, v] = merged.get((k, v), 0.0) + n
    right, _ = estimate([(k, v, n) for (k, v), n in sorted(merged.items())])
    return train(counts, right)


def _accepted(w: list[float], c: Column) -> Column:
    n, m = len(CANDIDATES), len(LABELERS)
    parts = [F.lit(w[0])]
    parts += [F.when(c["kind"] == k, w[1 + i]).otherwise(0.0) for i, k in enumerate(CANDIDATES)]
    for i, v in enumerate(LABELERS):
        parts.append(F.when(c[v] == 1, w[1 + n + i]).when(c[v] == -1, w[1 + n + m + i]).otherwise(0.0))
    parts.append(F.when(c["len"] >= 1, F.element_at(F.array(*[F.lit(x) for x in w[1 + n + 2 * m:]]),
                                                   F.greatest(c["len"].cast("int"), F.lit(1)))).otherwise(0.0))
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total > 0


# ------------------------------------------------------------------- operator
def find_spans(docs: DataFrame, *, text_col: str = "text", weights: list[float] | None = None) -> DataFrame:
    """Every row with two more columns: ``base_spans`` and ``spans`` (all of them),
    array<struct<start, kind_order, end, kind>> by start, then kind as listed.
    ``weights`` come from ``learn``; without them only base spans are found."""
    rest = [c for c in docs.columns if c not in ("base_spans", "spans")]
    rows = _with_base(docs.select(whole_row(docs.select(*[F.col(f"`{c}`") for c in rest])).alias("_row"),
                                  F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text")))

    def span(kind: Column, x: Column) -> Column:
        order = F.array_position(F.array(*[F.lit(k) for k in KIND_ORDER]), kind)
        return F.struct(x["s"].alias("start"), order.alias("kind_order"), x["e"].alias("end"), kind.alias("kind"))

    def named(kind: str):
        return lambda x: span(F.lit(kind), x)

    base = F.array_sort(F.concat(*[F.transform(f"_{k}", named(k)) for k in BASE]))
    if weights is None:
        return rows.select("_row.*", base.alias("base_spans"), base.alias("spans"))
    rows = _with_candidates(rows)
    more = F.transform(F.filter("_cands", lambda c: _accepted(weights, c)), lambda c: span(c["kind"], c))
    return (rows.withColumn("base_spans", base)
            .withColumn("spans", F.array_sort(F.concat("base_spans", more)))
            .select("_row.*", "base_spans", "spans"))


def as_text(spans: str) -> Column:
    """kind:start:end of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"),
                                                                 x["end"].cast("string"))), ",")


def redact(found: DataFrame, text_col: str = "text") -> DataFrame:
    """``text`` with every run of overlapping spans replaced by the first one's
    kind in angle brackets; a null text stays null."""
    text = F.col(f"`{text_col}`")
    reach = _scan(F.transform("spans", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"),
                                                          x["kind"].alias("kind"))),
                  lambda x, before, _: F.struct(x["start"].alias("start"),
                                                F.greatest(x["end"], before["end"]).alias("end"),
                                                x["kind"].alias("kind")))
    # ``end`` is now the furthest end so far: a run begins where a span starts beyond it
    steps = F.transform("_reach", lambda x, i: F.struct(
        x["start"].alias("start"), x["kind"].alias("kind"), i.alias("i"),
        F.coalesce(F.get("_reach", i - 1)["end"], F.lit(0)).alias("done")))
    runs = F.filter(steps, lambda x: (x["i"] == 0) | (x["start"] >= x["done"]))
    pieces = F.transform(runs, lambda x: F.concat(
        _between(F.col("_pieces"), x["done"], x["start"]), F.lit("<"), F.upper(x["kind"]), F.lit(">")))
    tail = _between(F.col("_pieces"), F.element_at("_reach", -1)["end"], F.length(text))
    some = F.size("spans") > 0
    return (found.withColumn("_reach", F.when(some, reach)).withColumn("_pieces", F.when(some, _pieces(text)))
            .withColumn(text_col, F.when(some, F.concat(F.array_join(pieces, ""), tail)).otherwise(text))
            .drop("_reach", "_pieces"))
