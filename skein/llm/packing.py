"""Packing: token sequences of a fixed window from a non-negative least-squares mix of lengths.

Every document is tokenised whole and cut at multiples of the window; what is left over (its rest)
has one of ``window - 1`` lengths. Shallow combinations of lengths that fill the window exactly
(m rests of one length and one of another) are enumerated; non-negative least squares finds how often
each should be repeated to match the histogram of rests; the counts are rounded down to what the
histogram holds. The rests that no combination takes are packed greedily one after the other and
cut where a sequence is full, so only the very last sequence can be short.

Scale: tokens are stored once (two or four bytes each) and shuffled once to meet their places. The
histogram has at most ``window`` rows and is all that reaches the driver. Documents are numbered
within their length in two steps (a running number in each stored partition, then offsets over
partitions and lengths), so one very common length needs no large sort, and a document's place follows
from its number by arithmetic on a table whose size depends on the window alone.

Defined results: a null or empty text is the end id alone. Repeated rows are packed each by itself.
An empty table gives no rows. Ids of texts that spell a special token are that token's, as the
tokenizer's defaults have it.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.llm import common

WINDOW = 4096
END_ID = 2
#: Most repeats of one length within a combination, and combinations that are kept.
MAX_REPEAT = 16
#: Chunks that a worker remembers at a time (twice as many while one generation follows another).
KNOWN_CHUNKS = 300_000

_TO_SPACE = bytes(32 if b in b" \t\n\x0b\x0c\r" else b for b in range(256))


# --- tokens -----------------------------------------------------------------------------------

class ChunkTokenizer:
    """Ids of whole texts by a tokenizer that drops white space and never merges across it.

    A text's ids are those of its chunks between ASCII white space, one after the other, so each
    distinct chunk is encoded once. Texts with special-token marks or combining accents, where
    lower-casing first could differ, are encoded whole.
    """

    def __init__(self, path: str, limit: int = KNOWN_CHUNKS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        # two generations: when the young one is full it becomes the old one, and what is used again
        # moves back, so frequent chunks are never forgotten
        self.known: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.limit = limit

    def _pack(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def _learn(self, chunks: list[bytes]) -> None:
        """Encode chunks some hundreds at a time, as one text, and part the ids at the chunks' bounds."""
        for lo in range(0, len(chunks), 512):
            part = [c.decode() for c in chunks[lo:lo + 512]]
            encoded = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids = np.array(encoded.ids, self.kind)
            first = np.fromiter((o[0] for o in encoded.offsets), np.int64, len(ids))
            begin = np.cumsum([0, *(len(c) + 1 for c in part)])
            edges = np.searchsorted(first, begin).tolist()
            raw, width = ids.tobytes(), ids.itemsize
            self.known.update(zip(chunks[lo:lo + 512], (raw[a * width:b * width] for a, b in zip(
                edges[:-1], edges[1:], strict=True)), strict=True))

    def _look_up(self, chunks: list[bytes]) -> list[bytes]:
        """Packed ids of each of some distinct chunks."""
        if len(self.known) > self.limit:
            self.old, self.known = self.known, {}
        known, old, new = self.known, self.old, []
        out = list(map(known.get, chunks))
        unknown = [i for i, x in enumerate(out) if x is None]
        for i in unknown:
            c = chunks[i]
            out[i] = x = old.get(c)
            if x is None:
                new.append(c)
            else:
                known[c] = x
        if new:
            self._learn(new)
            for i in unknown:
                if out[i] is None:
                    out[i] = known[chunks[i]]
        return out

    def ids(self, texts: list[bytes | None]) -> list[bytes]:
        """Packed ids of each text."""
        import pandas as pd

        plain = [b"" if not t or b"<|" in t or b"\xcc" in t or b"\xcd" in t else t for t in texts]
        blob = b" ".join(plain).lower().translate(_TO_SPACE)
        data = np.frombuffer(blob, np.uint8)
        starts, ends = common.word_spans(data)
        sizes = np.fromiter(map(len, plain), np.int64, len(plain))
        begin = np.cumsum(sizes + 1) - sizes - 1
        # a full stop or comma after a letter is a chunk of its own
        last, before = data[ends - 1], data[np.maximum(ends - 2, 0)]
        mark = ((last == 46) | (last == 44)) & (ends - starts > 1) & (before >= 97) & (before <= 122)
        ends = ends - mark
        code, distinct = pd.factorize(common.Prefix(data).raw(starts, ends) if len(starts) else np.zeros(0, np.uint64))
        first = np.zeros(len(distinct), np.int64)
        first[code[::-1]] = np.arange(len(code))[::-1]
        chunks = [b".", b",", *(blob[s:e] for s, e in zip(starts[first].tolist(), ends[first].tolist(), strict=True))]
        packed = self._look_up(chunks)
        width = np.dtype(self.kind).itemsize
        pool = np.frombuffer(b"".join(packed), self.kind)
        size = np.fromiter(map(len, packed), np.int64, len(packed)) // width
        pool_at = np.cumsum(size) - size
        where = np.flatnonzero(mark)
        item = np.insert(code + 2, where + 1, (last[where] == 44).astype(np.int64))
        text_of = np.insert(np.searchsorted(begin, starts, "right") - 1, where + 1,
                            np.searchsorted(begin, starts[where], "right") - 1)
        n = size[item]
        out = pool[np.repeat(pool_at[item] - (np.cumsum(n) - n), n) + np.arange(n.sum())].tobytes()
        edges = np.cumsum([0, *np.bincount(text_of, n, len(plain)).astype(np.int64)]) * width
        return [self._pack(self.tokenizer.encode(t.decode(), add_special_tokens=False).ids) if t and not p
                else out[a:b] for t, p, a, b in zip(texts, plain, edges[:-1].tolist(), edges[1:].tolist(), strict=True)]


_LOADED: dict[str, ChunkTokenizer] = {}


def _tokenizer(path: str) -> ChunkTokenizer:
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        _LOADED[path] = ChunkTokenizer(path)
    return _LOADED[path]


def tokenise(docs: DataFrame, vocabulary: str, end_id: int, window: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, ids, width, n, full_no, rest_no): ids as packed integers of ``width`` bytes, and running
    numbers within the task of the document's first full sequence and of its rest's length."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()

    def run(batches):
        encoder = _tokenizer(vocabulary)
        width = np.dtype(encoder.kind).itemsize
        end = np.array([end_id], encoder.kind).tobytes()
        fulls, seen = 0, [0] * window
        for batch in batches:
            ids, n_of, full_no, rest_no = [], [], [], []
            for _, texts in common.slices([batch.select(["text"])], 0, 2 * common.SLICE_BYTES):
                ids += [x + end for x in encoder.ids(texts)]
            for x in ids:
                n = len(x) // width
                n_of.append(n)
                full_no.append(fulls)
                rest_no.append(seen[n % window])
                fulls += n // window
                seen[n % window] += 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.binary()), pa.array([width] * len(ids), pa.int32()),
                 *(pa.array(x, pa.int64()) for x in (n_of, full_no, rest_no))],
                ["doc_id", "ids", "width", "n", "full_no", "rest_no"])

    return narrow.mapInArrow(run, f"doc_id {kind}, ids binary, width int, n long, full_no long, rest_no long")


# --- how often to repeat which combination ----------------------------------------------------

def combinations(lengths: np.ndarray, window: int, max_repeat: int = MAX_REPEAT) -> np.ndarray:
    """Rows (a, m, b): m rests of length a and one of length b (0: none) fill the window."""
    there = np.zeros(window + 1, bool)
    there[lengths] = True
    rows = []
    for m in range(1, max_repeat + 1):
        a = lengths[lengths * m <= window]
        b = window - m * a
        ok = (b == 0) | (there[b] & ((b < a) | (m > 1) & (b != a)) | (b == a) & (m == 1))
        rows.append(np.stack([a[ok], np.full(ok.sum(), m), b[ok]], 1))
    return np.concatenate(rows) if rows else np.zeros((0, 3), np.int64)


def solve(combos: np.ndarray, histogram: np.ndarray, steps: int = 400) -> np.ndarray:
    """Repeats x >= 0 that minimise |A x - histogram|^2 (accelerated projected gradient).

    A has m at row a and one at row b of each column; columns are scaled to length one.
    """
    a, m, b = combos.T
    paired = (b > 0).astype(float)
    scale = 1 / np.sqrt(np.where(a == b, (m + paired) ** 2, m * m + paired))
    size = len(histogram)

    def times(x):
        y = x * scale
        return np.bincount(a, m * y, size) + np.bincount(b, paired * y, size)

    def back(r):
        return scale * (m * r[a] + paired * r[b])

    v = np.ones(len(combos))
    for _ in range(20):  # largest eigenvalue of A'A
        v = back(times(v))
        bound = np.linalg.norm(v)
        v /= bound
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(steps):
        nxt = np.maximum(0, y - back(times(y) - histogram) / (1.05 * bound))
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = nxt + (t - 1) / t2 * (nxt - x)
        x, t = nxt, t2
    return x * scale


def plan(histogram: np.ndarray, window: int, max_repeat: int = MAX_REPEAT) -> list[tuple[int, int, int, int]]:
    """(a, m, b, repeats) that the histogram of rest lengths (index: length) can fill."""
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    combos = combinations(np.flatnonzero(left), window, max_repeat)
    if not len(combos):
        return []
    repeats = solve(combos, left.astype(float))
    out: dict[tuple[int, int, int], int] = {}
    order = np.argsort(-repeats * (combos[:, 1] * combos[:, 0] + combos[:, 2]), kind="stable")
    for most in (np.floor(repeats + 1e-6), np.full(len(combos), np.inf)):  # rounded, then what still fits
        for c in order.tolist():
            a, m, b = combos[c].tolist()
            room = left[a] // (m + 1) if a == b else min(left[a] // m, left[b] if b else left[a])
            r = int(min(most[c], room))
            if r > 0:
                left[a] -= r * m
                if b:
                    left[b] -= r
                out[(a, m, b)] = out.get((a, m, b), 0) + r
    return [(*k, r) for k, r in out.items()]


class Places:
    """Where the g-th rest of each length goes: segments of slots, then the greedy stream."""

    def __init__(self, histogram: np.ndarray, window: int, first_sequence: int):
        self.window = window
        segments, taken, sequence = [], np.zeros(window, np.int64), first_sequence
        for a, m, b, r in plan(histogram, window):
            # length, first number, slots in a sequence, sequences, first sequence, offset
            segments.append((a, int(taken[a]), m, r, sequence, 0))
            taken[a] += m * r
            if b:
                segments.append((b, int(taken[b]), 1, r, sequence, m * a))
                taken[b] += r
            sequence += r
        segments.sort()
        self.segments = np.array(segments, np.int64).reshape(-1, 6)
        self.keys = (self.segments[:, 0] << 44) + self.segments[:, 1]
        self.taken = taken
        lengths = np.arange(window)
        rest = (histogram - taken) * lengths
        self.stream_at = np.concatenate([[0], np.cumsum(rest)])[:window]
        self.stream_first = sequence

    def of(self, length: int, number: int) -> list[tuple[int, int, int, int]]:
        """Pieces (start in the rest, length, sequence, offset) of the numbered rest."""
        if number < self.taken[length]:
            s = int(np.searchsorted(self.keys, (length << 44) + number, "right")) - 1
            _, first, slots, _, sequence, offset = self.segments[s].tolist()
            k = number - first
            return [(0, length, sequence + k // slots, offset + k % slots * length)]
        at = int(self.stream_at[length]) + (number - int(self.taken[length])) * length
        pieces, start = [], 0
        while start < length:
            size = min(length - start, self.window - at % self.window)
            pieces.append((start, size, self.stream_first + at // self.window, at % self.window))
            start, at = start + size, at + size
        return pieces


def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW, end_id: int = END_ID, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens,
    sequence_id, offset."""
    common.prepare(docs.sparkSession)
    tokens = common.materialise(tokenise(docs, vocabulary, end_id, window, id_col, text_col))
    tokens = tokens.withColumn("row", F.monotonically_increasing_id())  # stable: the frame is stored
    part = F.shiftright("row", 33)
    rest = (F.col("n") % window).alias("rest")
    narrow = tokens.select("row", part.alias("part"), "n", rest, "full_no", "rest_no")
    # numbers of full sequences count as a length of their own (the window)
    sizes = (narrow.groupBy("part", F.col("rest").alias("len")).agg(F.count(F.lit(1)).alias("k"))
             .unionAll(narrow.groupBy("part").agg(F.sum(F.floor(F.col("n") / window)).cast("long").alias("k"))
                       .select("part", F.lit(window).cast("long").alias("len"), "k")))
    before = Window.partitionBy("len").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = common.materialise(sizes.select("part", "len", "k", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("base")))
    histogram = np.zeros(window + 1, np.int64)
    for r in offsets.groupBy("len").agg(F.sum("k").alias("k")).collect():  # at most window + 1 rows
        histogram[r["len"]] = r["k"]
    places = Places(histogram[:window], window, int(histogram[window]))
    shared = docs.sparkSession.sparkContext.broadcast(places)  # its size depends on the window alone

    rests = offsets.filter(F.col("len") < window).select("part", F.col("len").alias("rest"), F.col("base").alias("rest_base"))
    fulls = offsets.filter(F.col("len") == window).select("part", F.col("base").alias("full_base"))
    numbered = (narrow.join(rests, ["part", "rest"]).join(fulls, "part")
                .select("row", (F.col("full_no") + F.col("full_base")).alias("full_no"),
                        (F.col("rest_no") + F.col("rest_base")).alias("rest_no")))
    joined = tokens.select("row", "doc_id", "ids", "width", "n").join(numbered, "row")
    kind = joined.schema["doc_id"].dataType.simpleString()

    def place(batches):
        where = shared.value
        for batch in batches:
            take, rows = [], []
            columns = [batch.column(i).to_pylist() for i in range(2, 7)]
            for i, (ids, width, n, full_no, rest_no) in enumerate(zip(*columns, strict=True)):
                data = np.frombuffer(ids, np.uint16 if width == 2 else np.uint32)
                full = n // window
                pieces = [(k * window, window, full_no + k, 0) for k in range(full)]
                if n % window:
                    pieces += [(full * window + s, size, q, o) for s, size, q, o in where.of(n % window, rest_no)]
                for s, size, q, o in pieces:
                    take.append(i)
                    rows.append((s, size, data[s:s + size].astype("<u4").tobytes(), n, q, o))
            cols = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).take(pa.array(take, pa.int64())),
                 *(pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 3),
                                                  strict=True))],
                ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    return joined.mapInArrow(place, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, "
                                    "sequence_id long, offset long")


def op4_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    packed = pack(common.table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")
