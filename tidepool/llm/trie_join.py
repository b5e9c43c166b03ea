"""N-gram Jaccard join of whole texts by a prefix tree, exact.

Link: ``100 * |A & B| >= 80 * |A | B|`` for the sets of distinct word n-grams.

1. ``members``: every document's set size and the digest of its set.  Equal
   sets are one class; copies are never paired.
2. Token frequencies.  Each task sends every class it meets once, as packets
   of 64-bit n-gram hashes dealt by hash bucket.  A bucket finds the n-grams
   that at least two classes hold, and returns these alone.  A class with
   fewer shared n-grams than any partner would need is out, exactly.
3. Groups.  In the global order (rare n-grams first, then by hash) two linked
   sets share an n-gram within their prefixes, so components of "share a
   prefix n-gram" separate the join: no link crosses groups.
4. ``join_sets``: within a group, sets ordered by the reverse of that idea
   (frequent n-grams first) form a prefix tree.  One traversal carries, for
   all probing sets at once, the overlap with the path from the root, so that
   sets with a common beginning share the work; a subtree is left as soon as
   the overlap plus the remaining length can't reach the bound for any probe.
   A group beyond ``unit_tokens`` is cut into blocks, and every pair of blocks
   is one unit, so a unit's memory is bounded however large a group is.
5. Components of the links.

Nothing is capped: hot n-grams, groups and classes only mean more units.
N-grams are compared by 64-bit hashes (an equal pair of hashes for different
n-grams would have to fall into the same two documents to matter).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Hasher, anchored, combine, pick, release_model, whole_row, words
from .components import connected_components

SHINGLE = 5
NUM, DEN = 80, 100
UNIT_TOKENS = 150_000
PACKET_TOKENS = 400_000


def shingle_set(text: str | None, hasher: Hasher, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; a text of fewer words is
    one shingle, a text without words has none."""
    ws = words(text)
    if not ws:
        return np.empty(0, np.uint64)
    h = hasher.array(ws)
    k = min(k, len(ws))
    return np.unique(combine(h[i:len(h) - k + 1 + i] for i in range(k)))


KEY = np.dtype("V16")  # a class's whole digest


def _digest(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def _keys(digests) -> np.ndarray:
    return np.frombuffer(b"".join(digests), KEY)


def members(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, cls (128-bit digest of the set; null for an empty set),
    then the other columns as they are."""
    rest = [f for f in docs.schema.fields if f.name not in ("doc_id", "text")]

    def run(batches):
        release_model()
        hasher = Hasher()
        for b in batches:
            ns, cls = [], []
            for text in b.column("text"):
                s = shingle_set(text.as_py(), hasher, k)
                ns.append(len(s))
                cls.append(_digest(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(ns, pa.int64()), pa.array(cls, pa.binary()),
                 *(b.column(f.name) for f in rest)],
                ["doc_id", "n_shingles", "cls", *(f.name for f in rest)])

    more = "".join(f", {f.name} {f.dataType.simpleString()}" for f in rest)
    return docs.mapInArrow(run, f"doc_id bigint, n_shingles bigint, cls binary{more}")


def _packets(docs: DataFrame, k: int, n_buckets: int) -> DataFrame:
    """Rows (bucket, keys, sizes, counts, tokens): the tokens of some classes
    that fall into a bucket, in the order of keys, as little-endian arrays."""
    def flush(sets, keys):
        sizes = np.array([len(s) for s in sets], np.uint32)
        tokens = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets), dtype=np.uint32), sizes)
        bucket = (tokens % np.uint64(n_buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        tokens, owner, bucket = tokens[order], owner[order], bucket[order]
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        keys = _keys(keys)
        rows = ([], [], [], [], [])
        for t, o, at in zip(np.split(tokens, cuts), np.split(owner, cuts),
                            bucket[np.concatenate(([0], cuts))], strict=True):
            who, n = np.unique(o, return_counts=True)
            for col, x in zip(rows, (int(at), keys[who].tobytes(), sizes[who].tobytes(),
                                     n.astype(np.uint32).tobytes(), t.tobytes()), strict=True):
                col.append(x)
        return pa.RecordBatch.from_arrays(
            [pa.array(rows[0], pa.int32()), *(pa.array(c, pa.binary()) for c in rows[1:])],
            ["bucket", "keys", "sizes", "counts", "tokens"])

    def run(batches):
        release_model()
        hasher, seen, sets, keys, held = Hasher(), set(), [], [], 0
        for b in batches:
            for text in b.column("text"):
                s = shingle_set(text.as_py(), hasher, k)
                if not len(s):
                    continue
                key = _digest(s)
                if key in seen:
                    continue
                seen.add(key)
                sets.append(s)
                keys.append(key)
                held += len(s)
                if held >= PACKET_TOKENS:
                    yield flush(sets, keys)
                    sets, keys, held = [], [], 0
        if sets:
            yield flush(sets, keys)

    return docs.mapInArrow(run, "bucket int, keys binary, sizes binary, counts binary, tokens binary")


def _shared_in_bucket(parts: list[tuple], n_groups: int) -> pa.RecordBatch | None:
    """Of one bucket: for each class the tokens that other classes hold too, with
    the number of classes that hold them."""
    index: dict[bytes, int] = {}
    sizes: list[int] = []
    owners, tokens = [], []
    for keys, ns, counts, toks in parts:
        at = []
        for key, n in zip(np.frombuffer(keys, KEY).tolist(),
                          np.frombuffer(ns, np.uint32).tolist(), strict=True):
            i = index.get(key)
            if i is None:
                i = index[key] = len(sizes)
                sizes.append(n)
            at.append(i)
        owners.append(np.repeat(np.array(at, np.uint32), np.frombuffer(counts, np.uint32)))
        tokens.append(np.frombuffer(toks, np.uint64))
    tokens, owners = np.concatenate(tokens), np.concatenate(owners)
    order = np.argsort(tokens)
    tokens, owners = tokens[order], owners[order]
    start = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
    many = np.minimum.reduceat(owners, start) != np.maximum.reduceat(owners, start)
    length = np.diff(np.append(start, len(tokens)))
    keep = np.repeat(many, length)
    tokens, owners = tokens[keep], owners[keep]
    if not len(tokens):
        return None
    order = np.lexsort((owners, tokens))
    tokens, owners = tokens[order], owners[order]
    fresh = np.concatenate(([True], (tokens[1:] != tokens[:-1]) | (owners[1:] != owners[:-1])))
    tokens, owners = tokens[fresh], owners[fresh]
    start = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
    length = np.diff(np.append(start, len(tokens)))
    df = np.repeat(length, length).astype(np.uint32)
    key = _keys(index)
    group = (key.view(np.uint64)[::2] % np.uint64(n_groups)).astype(np.int64)
    order = np.lexsort((owners, group[owners]))
    tokens, owners, df = tokens[order], owners[order], df[order]
    cuts = np.flatnonzero(np.diff(group[owners])) + 1
    sizes = np.array(sizes, np.uint32)
    rows = ([], [], [], [], [], [])
    for t, o, d in zip(np.split(tokens, cuts), np.split(owners, cuts), np.split(df, cuts), strict=True):
        who, n = np.unique(o, return_counts=True)
        for col, x in zip(rows, (int(group[o[0]]), key[who].tobytes(), sizes[who].tobytes(),
                                 n.astype(np.uint32).tobytes(), t.tobytes(), d.tobytes()), strict=True):
            col.append(x)
    return pa.RecordBatch.from_arrays(
        [pa.array(rows[0], pa.int32()), *(pa.array(c, pa.binary()) for c in rows[1:])],
        ["grp", "keys", "sizes", "counts", "tokens", "dfs"])


def _gathered(batches) -> dict[int, list[tuple]]:
    """The packets of a task by their first column."""
    out: dict[int, list[tuple]] = {}
    for b in batches:
        for at, *part in zip(*(c.to_pylist() for c in b.columns), strict=True):
            out.setdefault(at, []).append(tuple(part))
    return out


def _shared(n_groups: int):
    """All packets of a task, bucket by bucket; the answers are packets too, dealt
    by class."""
    def run(batches):
        release_model()
        buckets = _gathered(batches)
        while buckets:
            out = _shared_in_bucket(buckets.popitem()[1], n_groups)
            if out is not None:
                yield out
    return run


def _assemble(num: int, den: int):
    """(cls, n, s, tokens) of the classes that share enough n-grams to have a
    partner: their shared n-grams in the global order, rarest first, then by hash."""
    def run(batches):
        release_model()
        groups = _gathered(batches)
        while groups:
            parts = groups.popitem()[1]
            key = np.concatenate([np.frombuffer(p[0], KEY) for p in parts])
            n = np.concatenate([np.frombuffer(p[1], np.uint32) for p in parts])
            counts = np.concatenate([np.frombuffer(p[2], np.uint32) for p in parts])
            tokens = np.concatenate([np.frombuffer(p[3], np.uint64) for p in parts])
            df = np.concatenate([np.frombuffer(p[4], np.uint32) for p in parts])
            classes, first, owner = np.unique(key, return_index=True, return_inverse=True)
            n, owner = n[first].astype(np.int64), np.repeat(owner, counts)
            held = np.bincount(owner, minlength=len(classes))
            active = held * den >= n * num
            keep = active[owner]
            tokens, df, owner = tokens[keep], df[keep], owner[keep]
            order = np.lexsort((tokens, df, owner))
            cuts = np.cumsum(held[active])[:-1]
            if active.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(classes[active].tolist(), pa.binary()), pa.array(n[active]), pa.array(held[active]),
                     pa.array([t.tobytes() for t in np.split(tokens[order], cuts)], pa.binary())],
                    ["cls", "n", "s", "tokens"])
    return run


def _prefixes(num: int, den: int):
    def run(batches):
        release_model()
        for b in batches:
            toks, nodes = [], []
            for node, n, t in zip(*(b.column(c).to_pylist() for c in ("node", "n", "tokens")), strict=True):
                t = np.frombuffer(t, np.uint64)
                need = -(-num * n // den)
                p = t[:len(t) - need + 1]
                toks.append(p.view(np.int64))
                nodes.append(np.full(len(p), node, np.int64))
            if toks:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(toks)), pa.array(np.concatenate(nodes))],
                    ["token", "node"])
    return run


# ------------------------------------------------------------------- the tree
class _Trie:
    """Prefix tree over rank lists, kept as the sorted lists themselves: a node
    is a range of lists that agree up to a depth."""

    def __init__(self, lists: list[np.ndarray], sizes: np.ndarray):
        order = sorted(range(len(lists)), key=lambda i: lists[i].astype(">u4").tobytes())
        self.at = np.array(order, np.int64)
        self.lists = [lists[i] for i in order]
        self.sizes = sizes[self.at]
        self.lengths = np.array([len(x) for x in self.lists], np.int64)

    def common(self, lo: int, hi: int, depth: int) -> int:
        a, b = self.lists[lo], self.lists[hi - 1]
        n = min(len(a), len(b))
        diff = np.flatnonzero(a[depth:n] != b[depth:n])
        return depth + int(diff[0]) if len(diff) else n

    def children(self, lo: int, hi: int, depth: int):
        heads = np.fromiter((x[depth] for x in self.lists[lo:hi]), np.int64, hi - lo)
        cuts = [0, *(np.flatnonzero(np.diff(heads)) + 1).tolist(), hi - lo]
        return [(lo + a, lo + z) for a, z in zip(cuts, cuts[1:], strict=False)]


def join_sets(sets: list[np.ndarray], sizes: np.ndarray, is_tree: np.ndarray, is_probe: np.ndarray,
              num: int = NUM, den: int = DEN):
    """(tree set, array of probe sets linked with it) for every linked tree set.

    ``sizes`` are full set sizes (tokens that nobody shares are left out of
    ``sets``); a set never meets itself.
    """
    lens = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets) if len(sets) else np.empty(0, np.uint64)
    tokens, local, count = np.unique(flat, return_inverse=True, return_counts=True)
    rank_of = np.empty(len(tokens), np.uint32)
    rank_of[np.lexsort((tokens, -count))] = np.arange(len(tokens), dtype=np.uint32)
    ranks = rank_of[local]
    bounds = np.concatenate(([0], np.cumsum(lens)))
    useful = np.empty(len(tokens), bool)
    useful[rank_of] = count > 1
    lists = []
    for a, z in zip(bounds[:-1], bounds[1:], strict=True):
        r = ranks[a:z]
        lists.append(np.sort(r[useful[r]]))
    probes = np.flatnonzero(is_probe)
    trees = np.flatnonzero(is_tree)
    n_probe, p_size = len(probes), sizes[probes]
    p_len = np.array([len(lists[i]) for i in probes], np.int64)
    # which probes hold a rank: positions in `probes`, grouped by rank
    held = np.concatenate([lists[i] for i in probes]) if n_probe else np.empty(0, np.uint32)
    who = np.repeat(np.arange(n_probe), p_len)
    order = np.argsort(held, kind="stable")
    who = who[order]
    first = np.searchsorted(held[order], np.arange(len(tokens) + 1))
    tree = _Trie([lists[i] for i in trees], sizes[trees])
    stack = [(0, len(trees), 0, np.zeros(n_probe, np.int32))] if len(trees) and n_probe else []
    both = num + den
    while stack:
        lo, hi, depth, overlap = stack.pop()
        down = tree.common(lo, hi, depth)
        if down > depth:
            path = tree.lists[lo][depth:down]
            overlap = overlap + np.bincount(
                np.concatenate([who[first[r]:first[r + 1]] for r in path.tolist()]),
                minlength=n_probe).astype(np.int32)
        rest = int(tree.lengths[lo:hi].max()) - down
        reach = overlap + np.minimum(rest, p_len - overlap)
        if not (both * reach >= num * (int(tree.sizes[lo:hi].min()) + p_size)).any():
            continue  # no probe can still reach the bound below here
        while lo < hi and tree.lengths[lo] == down:
            me = trees[tree.at[lo]]
            linked = probes[both * overlap.astype(np.int64) >= num * (tree.sizes[lo] + p_size)]
            linked = linked[linked != me]
            if len(linked):
                yield int(me), linked
            lo += 1
        if lo < hi:
            stack.extend((a, z, down, overlap) for a, z in tree.children(lo, hi, down))


def _join_unit(num: int, den: int):
    def run(unit: pa.Table) -> pa.Table:
        release_model()
        nodes = np.array(unit.column("node").to_pylist(), np.int64)
        copies = np.array(unit.column("copies").to_pylist(), np.int64)
        sizes = np.array(unit.column("n").to_pylist(), np.int64)
        sets = [np.frombuffer(t, np.uint64) for t in unit.column("tokens").to_pylist()]
        block = np.array(unit.column("block").to_pylist(), np.int64)
        i, j = unit.column("i")[0].as_py(), unit.column("j")[0].as_py()
        links = np.zeros(len(nodes), np.int64)
        label = nodes.copy()
        for me, linked in join_sets(sets, sizes, block == i, block == j, num, den):
            links[me] += copies[linked].sum()
            if i != j:
                links[linked] += copies[me]
            if (label[linked] != label[me]).any():
                met = np.unique(np.append(label[linked], label[me]))
                label[np.isin(label, met)] = met[0]
        on = links > 0
        return pa.table({"node": pa.array(nodes[on]), "root": pa.array(label[on]),
                         "links": pa.array(links[on])})
    return run


def _linked(src: DataFrame, k: int, num: int, den: int, unit_tokens: int) -> tuple[DataFrame, DataFrame]:
    """``members`` of the documents, and a row for each class: cls, node (the
    class's own number), rep (its smallest doc_id), copies, links (documents of
    other classes linked with it), component (smallest node reachable)."""
    spark = src.sparkSession
    n_buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    member = anchored(members(src, k))
    # numbered once and written: documents that share an id are told apart, and so are null ids
    classes = anchored(member.where("cls is not null").groupBy("cls")
                       .agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
                       .withColumn("node", F.monotonically_increasing_id()))

    shared = (_packets(src.select("text"), k, n_buckets).repartition(n_buckets, "bucket")
              .mapInArrow(_shared(n_buckets), "grp int, keys binary, sizes binary, counts binary, "
                                              "tokens binary, dfs binary"))
    active = (shared.repartition(n_buckets, "grp")
              .mapInArrow(_assemble(num, den), "cls binary, n bigint, s bigint, tokens binary"))
    active = anchored(active.join(classes.select("cls", "node", "copies"), "cls").drop("cls"))

    prefix = active.select("node", "n", "tokens").mapInArrow(_prefixes(num, den),
                                                            "token bigint, node bigint")
    ends = prefix.groupBy("token").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a < z")
    edges = (prefix.join(ends, "token").where("node <> a").select("a", F.col("node").alias("b"))
             .distinct())
    group = connected_components(edges).withColumnRenamed("component", "grp")
    weight = group.join(active.select("node", "s"), "node").groupBy("grp").agg(
        F.ceil(F.sum("s") / unit_tokens).cast("int").alias("blocks"))
    placed = (active.join(group, "node").join(weight, "grp")
              .withColumn("block", F.expr("pmod(xxhash64(node), blocks)").cast("int"))
              .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
              .select("grp", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                      "block", "node", "copies", "n", "tokens"))
    found = anchored(placed.groupBy("grp", "i", "j").applyInArrow(
        _join_unit(num, den), "node bigint, root bigint, links bigint"))
    component = connected_components(found.where("node <> root").select("node", "root"), "node", "root")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    linked = links.join(component, "node", "left")
    return member, (classes.join(linked, "node", "left")
                    .withColumn("component", F.coalesce("component", "node")))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    k: int = SHINGLE, num: int = NUM, den: int = DEN,
                    unit_tokens: int = UNIT_TOKENS) -> DataFrame:
    """One row per document row: doc_id, n_shingles, class_id, n_links, component_id.

    ``class_id``: smallest doc_id with the same set; ``n_links``: documents
    linked directly, copies included; ``component_id``: smallest doc_id
    reachable by links, itself included.  Ids are integers.  A document without
    words (null text too) is linked with nothing and is its own class.
    Repeated rows count as copies; rows that share an id but not a text are
    documents of their own, and so is every row with a null id, which is
    passed over where an id is reported unless there is no other.  Very long
    texts count whole, an empty table gives no rows, and columns other than
    the two named are not read, whatever they are called.
    """
    src = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    member, classes = _linked(src, k, num, den, unit_tokens)
    least = (classes.where("links is not null").groupBy("component")
             .agg(F.min("rep").alias("component_id")))
    by_class = (classes.join(least, "component", "left")
                .select("cls", F.col("rep").alias("class_id"),
                        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                        F.coalesce("component_id", "rep").alias("component_id")))
    return (member.join(by_class, "cls", "left")
            .select("doc_id", "n_shingles", F.coalesce("class_id", "doc_id").alias("class_id"),
                    F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                    F.coalesce("component_id", "doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                k: int = SHINGLE, num: int = NUM, den: int = DEN,
                unit_tokens: int = UNIT_TOKENS) -> DataFrame:
    """The documents, one row of each component of linked ones: the row with the
    smallest id (null ids last), then the smallest SHA-256 of the text.

    A row is known by its id and its whole text, so rows that share an id but
    not a text stand and fall alone.  Of rows equal in both, the one that is
    smallest as JSON stays.  Rows without words all stay.  Columns come
    back as they were, whatever they are called; an empty table stays empty.
    """
    keyed = docs.select(whole_row(docs).alias("row"), F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                        F.unhex(F.sha2(F.col(f"`{text_col}`").cast("binary"), 256)).alias("text_key"))
    src = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
                      F.unhex(F.sha2(F.col(f"`{text_col}`").cast("binary"), 256)).alias("text_key"))
    member, classes = _linked(src, k, num, den, unit_tokens)
    rows = (member.where("cls is not null").groupBy("cls", "doc_id", "text_key").agg(F.count("*").alias("n"))
            .join(classes.select("cls", "component"), "cls"))
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    head = rows.groupBy("component").agg(F.min(place).alias("head"), F.sum("n").alias("all")).where("all > 1")
    # rows to look at: those that go, and those that stay once although they are there more often
    touched = anchored(rows.join(head, "component").withColumn("stays", F.col("head") == place)
                       .where("not stays or n > 1").select("doc_id", "text_key", "stays"))

    def meets(t: DataFrame):
        return (keyed["doc_id"].eqNullSafe(t["doc_id"])) & (keyed["text_key"] == t["text_key"])

    repeated = touched.where("stays")
    single = keyed.join(touched, meets(touched), "left_anti").select("row")
    once = (keyed.join(repeated, meets(repeated), "left_semi").groupBy("doc_id", "text_key")
            .agg(F.min_by("row", F.to_json("row")).alias("row")).select("row"))
    return single.unionByName(once).select("row.*")
