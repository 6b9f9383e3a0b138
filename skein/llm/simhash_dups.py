"""SimHash near-dedup: 64-bit fingerprints linked by a binary-trie self-join.

Fingerprints are joined with themselves by walking a binary trie in pairs of nodes: a pair's
differing bits are accumulated on the way down and the pair is dropped as soon as they exceed the Hamming budget. The
trie is cut into subtrees of bounded size. The top of the walk runs where the fingerprints lie: a task walks the
subtrees it has fingerprints of against all of the cut. Every surviving pair of subtrees is one Spark group, walked
on to the leaves there. Each group returns the links as a spanning forest, and a distributed star contraction joins the
forests into components.

Scale: copies share a fingerprint, so each distinct fingerprint enters the join once, after a
map-side combined aggregation: no group of copies ever forms. A subtree holds at most
``max(BLOCK, n / MAX_BLOCKS)`` fingerprints and never more than ``MAX_GROUP``, so the number of subtrees follows n and a
group stays at 16 MB of fingerprints at most. They are found by counting prefixes, 8 bits and then 4 at a time, and
refining only the heavy ones, so dense regions are cut deeper. A fingerprint is dealt to one group for each prefix
within the budget: ``1 + d + d(d-1)/2`` at depth d with two bits, 67 at 2,048 subtrees and 154 at 100,000. A fingerprint has at most 2,080
others within two bits, so links grow with the distinct fingerprints, not with their square. Edges
and components stay distributed; the driver sees prefix counts and the cut only (16 n / ``MAX_GROUP`` counts at most).

Defined results: a null, empty or blank text has fingerprint zero and is linked as any other. Equal
fingerprints are one component. Rows with a null id get the smallest non-null id of their component
(null if there is none). Repeated rows keep a row each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm import common

WORDS = 3
MAX_BITS = 2
SEED = 42
BLOCK = 1 << 13
MAX_BLOCKS = 1 << 11
#: Fingerprints of a subtree, at any number of them.
MAX_GROUP = 1 << 20
#: Node pairs walked at a time, and leaf products compared at once.
FRONTIER = 1 << 18


# --- fingerprints -----------------------------------------------------------------------------

def fingerprint(text: bytes | None, words: int = WORDS, seed: int = SEED) -> int:
    """64-bit SimHash over the XXH64 of the space-joined word shingles, repeats included."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return 0
    line = b" ".join(tokens)
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(sizes + 1) - 1
    width = min(words, len(tokens))
    first = (ends - sizes)[:len(tokens) - width + 1].tolist()
    last = ends[width - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    ones, n = np.zeros(64, np.int64), len(first)
    for lo in range(0, n, 1 << 18):
        part = zip(first[lo:lo + (1 << 18)], last[lo:lo + (1 << 18)], strict=True)
        h = np.fromiter((digest(line[a:b], seed) for a, b in part), np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(sum(1 << int(i) for i in np.flatnonzero(2 * ones > n)))


def fingerprints(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, thash, fp): a hash of the text and its fingerprint as a signed long."""
    text = F.col(text_col).cast("string")
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.xxhash64(text), F.lit(0)).alias("thash"),
                         text.alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t, words) for t in common.as_bytes(batch.column(2))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps.view(np.int64))],
                                             ["doc_id", "thash", "fp"])

    return narrow.mapInArrow(run, f"doc_id {kind}, thash long, fp long")


# --- the cut of the trie ----------------------------------------------------------------------

def trie_cut(nodes: DataFrame, block: int, max_blocks: int, max_group: int = MAX_GROUP) -> list[tuple[int, int]]:
    """(depth, prefix) of subtrees that cover all fingerprints and hold a bounded number each."""
    counts: dict[tuple[int, int], int] = {}
    depth, heavy, limit = 0, None, block
    while depth < 64 and heavy != []:
        here = nodes if heavy is None else nodes.filter(F.shiftrightunsigned("fp", 64 - depth).isin(heavy))
        depth += 8 if depth == 0 else 4
        prefix = F.shiftrightunsigned("fp", 64 - depth) if depth < 64 else F.col("fp")
        rows = here.groupBy(prefix.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
        if depth == 8:
            limit = min(max(block, sum(r["n"] for r in rows) // max_blocks), max_group)
        heavy = []
        for r in rows:
            counts[(depth, r["p"] & ((1 << depth) - 1))] = r["n"]
            if r["n"] > limit:
                heavy.append(r["p"])
    sums = dict(counts)  # counts of all nodes above the counted ones
    for d, p in sorted(counts, reverse=True):
        for up in range(1, 4 if d > 8 else 9):
            sums[(d - up, p >> up)] = sums.get((d - up, p >> up), 0) + counts[(d, p)]
    cut, todo = [], [(0, 0)]
    while todo:
        d, p = todo.pop()
        if (d, p) not in sums:
            continue
        children = [(d + 1, 2 * p), (d + 1, 2 * p + 1)]
        if sums[(d, p)] > limit and any(c in sums for c in children):
            todo += children
        else:
            cut.append((d, p))
    return sorted(cut, key=lambda c: c[1] << (64 - c[0]))


def cut_partners(lows: np.ndarray, depths: np.ndarray, mine: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``mine``, subtree): pairs of subtrees that can hold fingerprints within the budget.

    ``lows`` are the smallest fingerprints of the cut's subtrees, ascending, ``depths`` the bits they fix; ``mine`` are
    places in both. Each of ``mine`` goes down with the nodes above the cut (ranges of it), bit by bit, until it or the
    other side is a subtree of the cut; bits that a subtree leaves open do not differ.
    """
    ones_before = np.zeros(len(lows) + 1, np.int64)
    owner, diff = np.arange(len(mine)), np.zeros(len(mine), np.int64)
    lo, hi = np.zeros(len(mine), np.int64), np.full(len(mine), len(lows), np.int64)
    found = [(owner[:0], lo[:0])]
    for level in range(65):
        done = (depths[mine[owner]] <= level) | ((hi - lo == 1) & (depths[lo] <= level))
        n = (hi - lo)[done]
        places = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo[done], n)
        found.append((np.repeat(owner[done], n), places))
        owner, lo, hi, diff = (x[~done] for x in (owner, lo, hi, diff))
        if not len(owner):
            break
        bit = np.uint64(63 - level)
        np.cumsum((lows >> bit) & np.uint64(1), out=ones_before[1:])
        mid = hi - (ones_before[hi] - ones_before[lo])
        one = ((lows[mine[owner]] >> bit) & np.uint64(1)).astype(np.int64)
        nxt = [np.concatenate(x) for x in ((owner, owner), (lo, mid), (mid, hi), (diff + one, diff + 1 - one))]
        keep = (nxt[1] < nxt[2]) & (nxt[3] <= max_bits)
        owner, lo, hi, diff = (x[keep] for x in nxt)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


# --- the walk inside a pair of subtrees -------------------------------------------------------

def components(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest member of each node's component."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        while not np.array_equal(jump := new[new], new):
            new = jump
        if np.array_equal(new, label):
            return label
        label = new


def walk(a: np.ndarray, b: np.ndarray | None, max_bits: int):
    """Yield (i, j) index arrays of the pairs within the budget; b None: pairs of a with itself.

    Both arrays are sorted and distinct. A node is a range of an array; all pairs of a batch are at
    one depth.
    """
    self_join, other = b is None, a if b is None else b
    if not len(a) or not len(other):
        return

    def ones(x):  # per bit on demand: number of set bits before each place
        cache = {}

        def get(bit):
            if bit not in cache:
                cache.clear()
                cache[bit] = np.concatenate([[0], np.cumsum((x >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)])
            return cache[bit]
        return get

    ones_a = ones(a)
    ones_b = ones_a if self_join else ones(other)
    one = lambda x: np.array([x], np.int64)
    todo = [(63, one(0), one(len(a)), one(0), one(len(other)), one(0))]
    while todo:
        bit, alo, ahi, blo, bhi, diff = todo.pop()
        small = (ahi - alo) * (bhi - blo) <= 16
        if bit < 0:
            small[:] = True
        if small.any():
            yield from _compare(a, other, alo[small], ahi[small], blo[small], bhi[small], max_bits, self_join)
            alo, ahi, blo, bhi, diff = (x[~small] for x in (alo, ahi, blo, bhi, diff))
        if not len(alo):
            continue
        ca, cb = ones_a(bit), ones_b(bit)
        amid, bmid = ahi - (ca[ahi] - ca[alo]), bhi - (cb[bhi] - cb[blo])
        same = np.zeros(len(alo), bool) if not self_join else (alo == blo) & (ahi == bhi)
        parts = [(alo, amid, blo, bmid, diff), (amid, ahi, bmid, bhi, diff), (alo, amid, bmid, bhi, diff + 1),
                 tuple(x[~same] for x in (amid, ahi, blo, bmid, diff + 1))]
        nxt = [np.concatenate(x) for x in zip(*parts, strict=True)]
        keep = (nxt[0] < nxt[1]) & (nxt[2] < nxt[3]) & (nxt[4] <= max_bits)
        nxt = [x[keep] for x in nxt]
        for lo in range(0, len(nxt[0]), FRONTIER):
            todo.append((bit - 1, *(x[lo:lo + FRONTIER] for x in nxt)))


def _compare(a, b, alo, ahi, blo, bhi, max_bits, self_join):
    width = bhi - blo
    size = (ahi - alo) * width
    for lo, hi in _cuts(size, 1 << 20):
        n = size[lo:hi]
        pair = np.repeat(np.arange(lo, hi), n)
        k = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
        i, j = alo[pair] + k // width[pair], blo[pair] + k % width[pair]
        ok = np.bitwise_count(a[i] ^ b[j]) <= max_bits
        if self_join:
            ok &= i < j
        if ok.any():
            yield i[ok], j[ok]


def _cuts(size: np.ndarray, most: int):
    """Ranges of consecutive entries whose sizes add up to about ``most``."""
    block = (np.cumsum(size) - 1) // most
    edges = np.flatnonzero(np.diff(block)) + 1
    yield from zip([0, *edges.tolist()], [*edges.tolist(), len(size)], strict=True)


def forest(a: np.ndarray, b: np.ndarray | None, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, smallest fingerprint linked to it here) of all that have a link."""
    values = np.unique(a if b is None else np.concatenate([a, b]))
    at_a, at_b = np.searchsorted(values, a), np.searchsorted(values, a if b is None else b)
    us, vs, size = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    for i, j in walk(a, b, max_bits):
        us.append(at_a[i])
        vs.append(at_b[j])
        size += len(i)
        if size > 1 << 21:  # keep the forest only
            label = components(len(values), np.concatenate(us), np.concatenate(vs))
            linked = np.flatnonzero(label != np.arange(len(values)))
            us, vs, size = [linked], [label[linked]], 0
    label = components(len(values), np.concatenate(us), np.concatenate(vs))
    linked = np.flatnonzero(label != np.arange(len(values)))
    return values[linked], values[label[linked]]


def links(nodes: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """(u, v), u != v: edges between distinct fingerprints that span all links of ``nodes.fp``."""
    cut = trie_cut(nodes, block, max_blocks)
    lows = np.array([p << (64 - d) for d, p in cut], np.uint64)
    depths = np.array([d for d, _ in cut], np.int64)

    def deal(batches):
        for batch in batches:
            fp = np.sort(batch.column(0).to_numpy().view(np.uint64))
            nodes_here, first = np.unique(np.searchsorted(lows, fp, "right") - 1, return_index=True)
            ends = np.append(first, len(fp))
            for lo in range(0, len(nodes_here), 1024):
                mine = nodes_here[lo:lo + 1024]
                owner, other = cut_partners(lows, depths, mine, max_bits)
                order = np.argsort(owner, kind="stable")
                at = np.searchsorted(owner[order], np.arange(len(mine) + 1))
                for i, node in enumerate(mine):
                    others = other[order[at[i]:at[i + 1]]]
                    data = fp[ends[lo + i]:ends[lo + i + 1]].tobytes()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.minimum(others, node)), pa.array(np.maximum(others, node)),
                         pa.array((others < node).astype(np.int32)), pa.array([data] * len(others), pa.binary())],
                        ["a", "b", "side", "fps"])

    def join(group):
        a, b = (np.sort(np.frombuffer(b"".join(group["fps"][group["side"] == k]), np.uint64)) for k in (0, 1))
        u, v = forest(a, b if len(b) else None, max_bits)
        import pandas as pd

        return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    # a task's fingerprints of a subtree travel as one row of packed numbers for each pair
    dealt = nodes.select("fp").mapInArrow(deal, "a long, b long, side int, fps binary")
    return dealt.groupBy("a", "b").applyInPandas(join, "u long, v long").distinct()


# --- components of the whole graph ------------------------------------------------------------

def contract(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge: alternating large-star and small-star steps.

    Each step is a min-aggregation by node and an equi-join back; edges are stored after each round.
    """
    edges = common.materialise(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                               .filter("u <> v").distinct())
    state = None
    while True:
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        large = large.unionAll(low.filter("m < u").select("u", F.col("m").alias("v"))).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
                 .unionAll(low.select("u", F.col("m").alias("v"))).distinct())
        edges = common.materialise(small)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now


def _labelled(docs: DataFrame, words: int, max_bits: int, id_col: str, text_col: str, block: int,
              max_blocks: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, thash, fp) rows and (fp, root, component_id) of each distinct fingerprint, both stored."""
    common.prepare(docs.sparkSession)
    rows = common.materialise(fingerprints(docs, words, id_col, text_col))
    nodes = common.materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("low")))
    roots = contract(links(nodes, max_bits, block, max_blocks))
    placed = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    return rows, common.materialise(placed.join(least, "root").select("fp", "root", "component_id"))


def simhash_dups(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS, id_col: str = "doc_id",
                 text_col: str = "text", block: int = BLOCK, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """One row per input row: doc_id, fp (signed long), component_id."""
    rows, known = _labelled(docs, words, max_bits, id_col, text_col, block, max_blocks)
    return rows.join(known, "fp").select("doc_id", "fp", "component_id")


def apply_simhash(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS, id_col: str = "doc_id",
                  text_col: str = "text", block: int = BLOCK, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """The input's rows, one of each component: that of the smallest id (null ids last), and among
    rows of that id the one whose text has the smallest hash. Of rows that share both, one stays: the least
    by the other columns, in their order."""
    rows, known = _labelled(docs, words, max_bits, id_col, text_col, block, max_blocks)
    first = (rows.join(known, "fp").groupBy("root")
             .agg(F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "thash")).alias("k"))
             .select(F.col("k.doc_id").alias("__id"), F.col("k.thash").alias("__thash")))
    times = rows.groupBy(F.col("doc_id").alias("__id"), F.col("thash").alias("__thash")).agg(
        F.count(F.lit(1)).alias("__n"))
    a, b = first.alias("a"), times.alias("b")
    stay = common.materialise(a.join(b, F.col("a.__id").eqNullSafe(F.col("b.__id"))
                                     & (F.col("a.__thash") == F.col("b.__thash")))
                              .select("a.__id", "a.__thash", "b.__n"))
    text_hash = F.coalesce(F.xxhash64(docs[text_col].cast("string")), F.lit(0))

    def kept(keys: DataFrame) -> DataFrame:
        return docs.join(keys, docs[id_col].eqNullSafe(keys["__id"]) & (text_hash == keys["__thash"]), "left_semi")

    repeated = stay.filter("__n > 1")
    out = kept(stay.filter("__n = 1"))
    if repeated.isEmpty():
        return out
    columns = docs.columns
    order = [f"`{f.name}`" for f in docs.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    least = F.min_by(F.struct(*[F.col(f"`{c}`") for c in columns]), F.struct(*order)).alias("row")
    tied = kept(repeated).groupBy(F.col(id_col).alias("__id"), F.xxhash64(F.col(text_col).cast("string")).alias("__hash"))
    return out.unionByName(tied.agg(least).select("row.*"))


def op6_simhash_dups(spark, sf_dir: str) -> DataFrame:
    found = simhash_dups(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
