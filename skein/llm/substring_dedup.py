"""Suffix-array dedup: a logarithmic family of suffix indexes finds repeated byte strings.

A string of ``length`` bytes that also starts earlier (smaller document id, or the same document
further left) is a repeat; every byte that a repeat covers is removed.

Suffixes are indexed sparsely and without loss. Each start of a ``length``-byte string has an anchor: the
k-gram of smallest hash inside the string, leftmost on ties. The choice depends on the string's bytes
alone, so equal strings have equal anchors at equal distances. The starts of one anchor are neighbours; the
bytes from the first start to the end of the last string are the anchor's span, and the suffix at its
first start, as long as the span, is the entry that is indexed (about one in ``(length - k) / 2``
bytes). Suffix arrays are kept in the order of a 64-bit fingerprint of that content instead of byte
order: equal content is adjacent in either, and only matches of at least ``length`` bytes matter.

1. A batch (about ``BATCH_BYTES`` of text of one task) builds its suffix array; entries that
   repeat an earlier one of the batch are reported, the others are dealt to buckets by anchor.
2. In a bucket the batches arrive one by one. A new batch's array is merge-scanned against every level
   of the family: of two equal entries the later is reported, the earlier stays. What is left
   becomes a level, and levels of about equal size merge, so sizes fall geometrically.
3. Equal anchors with different spans can still share shorter strings of ``length`` bytes and more.
   For these anchors (a second scan finds them by a bit array of fixed size, which lets all of them
   pass) the spans' bytes are sent along, and a dense array of every start in them is searched the same way.
   An anchor of more than ``SPREAD`` spans (found by a second such array) does not go to one bucket: every
   start in its spans is an entry of its own, with the fingerprint of its ``length`` bytes. A batch reports
   the starts that repeat an earlier one of the batch; the others are dealt to buckets by that fingerprint.

Scale: one narrow shuffle of entries, one of the few spans and starts of step 3, one of the texts to meet
their spans. A passage that a third of all documents hold arrives as one entry per batch, not per
document, and so does each string at its edges; strings that differ are spread over all buckets. Every stage is linear in the input; nothing but the bit arrays (bounded by
``2**FILTER_BITS`` bits each) reaches the driver.

Defined results: a null or empty text has no bytes. Null ids come before all others. Rows that
repeat an id are ordered by the CRC-32 of their texts; rows equal in both are one document, so their
bytes are not repeats of each other, and each row gets the same result. Texts shorter than ``length``
lose nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.llm import common
from skein.operators.long_lists import numbered

LENGTH = 100
GRAM = 32
BATCH_BYTES = 32 << 20
FILTER_BITS = 25
#: Bytes of text for which there is a bucket (entries take about as much as the text).
BUCKET_BYTES = 1 << 26
#: Spans of one anchor that go to one bucket; the starts of an anchor with more are spread over all.
SPREAD = 256
#: Levels merge when the older is at most this many times the newer.
RATIO = 2
NULL_ID = -(1 << 63)
_POS = np.uint64((1 << 31) - 1)

#: Columns of an entry as they travel: fingerprint, anchor, document, CRC-32, first start, starts.
ENTRY = np.dtype([("f", "<u8"), ("key", "<u8"), ("doc", "<i8"), ("crc", "<u4"), ("lo", "<u4"), ("n", "<u2")])


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have < width:
        step = min(have, width - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


def spans_of(texts: list[bytes | None], docs: np.ndarray, crcs: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(entries, first byte and end of each span in the joined texts, joined texts)."""
    blob = b"".join(t or b"" for t in texts)
    data = np.frombuffer(blob, np.uint8)
    if len(data) < length:
        return np.zeros(0, ENTRY), np.zeros(0, np.int64), np.zeros(0, np.int64), data
    sizes = np.array([len(t) if t else 0 for t in texts], np.int64)
    end = np.cumsum(sizes)
    prefix = common.Prefix(data)
    n = len(data) - gram + 1
    h = common.mix((prefix.sums[gram:] - prefix.sums[:-gram]) * prefix.inverse[:n])
    # hash in the upper bits, place in the lower: the minimum is the smallest hash, leftmost on ties
    low = _sliding_min((h & ~_POS) | np.arange(n, dtype=np.uint64), length - gram + 1)
    anchor = (low & _POS).astype(np.int64)
    starts = np.arange(len(anchor))
    of = np.repeat(np.arange(len(texts)), sizes)[:len(anchor)]
    inside = starts + length <= end[of]
    new = np.concatenate([[True], anchor[1:] != anchor[:-1]]) & inside
    new[1:] |= inside[1:] & (of[1:] != of[:-1])
    first = np.flatnonzero(new)
    # starts of an anchor end where the next anchor's begin or where strings leave the document
    stop = np.append(first[1:], len(anchor))
    stop = np.minimum(stop, end[of[first]] - length + 1)
    entries = np.zeros(len(first), ENTRY)
    last = stop + length - 1
    entries["key"] = common.mix(h[anchor[first]])
    width = (last - first).astype(np.uint64)
    entries["f"] = common.mix(prefix.raw(first, last) + width * np.uint64(0x9E3779B97F4A7C15))
    entries["doc"], entries["crc"] = docs[of[first]], crcs[of[first]]
    entries["lo"] = first - (end - sizes)[of[first]]
    entries["n"] = stop - first
    return entries, first, last, data


def _earliest(e: np.ndarray) -> np.ndarray:
    """Order by fingerprint, anchor and position."""
    return np.lexsort((e["lo"], e["crc"], e["doc"], e["key"], e["f"]))


def _same(e: np.ndarray) -> np.ndarray:
    """Which sorted entries equal the one before in content."""
    out = np.zeros(len(e), bool)
    out[1:] = (e["f"][1:] == e["f"][:-1]) & (e["key"][1:] == e["key"][:-1])
    return out


def _later(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which positions of a come after those of b."""
    out = a["lo"] > b["lo"]
    for c in ("crc", "doc"):
        out = (a[c] > b[c]) | (a[c] == b[c]) & out
    return out


def suffix_array(e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted first occurrences, entries that repeat one of them at a later position)."""
    e = e[_earliest(e)]
    same = _same(e)
    first = np.maximum.accumulate(np.where(same, 0, np.arange(len(e)))) if len(e) else np.zeros(0, np.int64)
    return e[~same], e[same & _later(e, e[first])] if len(e) else e


class Family:
    """Levels of sorted suffix arrays; the newest and smallest is last."""

    def __init__(self):
        self.levels: list[np.ndarray] = []
        self.repeats: list[np.ndarray] = []

    def add(self, new: np.ndarray) -> None:
        """Merge-scan a sorted array of distinct entries against all levels, then keep what is new."""
        for level in self.levels:
            if not len(new):
                return
            at = np.minimum(np.searchsorted(level["f"], new["f"]), len(level) - 1)
            hit = (level["f"][at] == new["f"]) & (level["key"][at] == new["key"])
            mine, theirs = new[hit], level[at[hit]]
            self.repeats.append(mine[_later(mine, theirs)])
            swap = _later(theirs, mine)  # the new one is earlier: it takes the level's place
            self.repeats.append(theirs[swap])
            level[at[hit][swap]] = mine[swap]
            new = new[~hit]
        if len(new):
            self.levels.append(new)
        while len(self.levels) > 1 and len(self.levels[-2]) <= RATIO * len(self.levels[-1]):
            newer, older = self.levels.pop(), self.levels.pop()
            both = np.concatenate([older, newer])
            self.levels.append(both[np.argsort(both["f"], kind="stable")])


def _intervals(e: np.ndarray, length: int) -> list[tuple[int, int, int, int]]:
    """(doc, crc, start, end) of the bytes covered, neighbours in a document joined."""
    if not len(e):
        return []
    e = e[np.lexsort((e["lo"], e["crc"], e["doc"]))]
    lo = e["lo"].astype(np.int64)
    end = lo + e["n"] + length - 1
    # an entry's span is short, so a running maximum within a document is the last end
    new = np.ones(len(e), bool)
    new[1:] = (e["doc"][1:] != e["doc"][:-1]) | (e["crc"][1:] != e["crc"][:-1]) | (lo[1:] > end[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(e)) - 1
    return list(zip(e["doc"][first].tolist(), e["crc"][first].tolist(), lo[first].tolist(), end[last].tolist(),
                    strict=True))


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc"),
                       F.crc32(text.cast("binary")).alias("crc"), text.alias("text"))


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


REPEATS = "kind int, doc long, crc long, start long, end long"


def _found(intervals, keys=()):
    """Rows of kind 0 (covered bytes) and kind 1 (an anchor with several spans, in ``doc``, and
    their number, in ``start``)."""
    import pandas as pd

    rows = [(0, *x) for x in intervals] + [(1, k, 0, n, 0) for k, n in keys]
    out = pd.DataFrame(rows, columns=["kind", "doc", "crc", "start", "end"])
    return out.astype({c: "int64" for c in out.columns} | {"kind": "int32"})


def _dealt(index: np.ndarray, repeats: np.ndarray, by: str, buckets: int, task: int, no: int) -> pa.RecordBatch:
    """A batch's suffix array by bucket of the field ``by`` (kind 0) and its repeats (kind 1)."""
    bucket = _bucket(index[by], buckets)
    order = np.argsort(bucket, kind="stable")
    index, bucket = index[order], bucket[order]
    edges = np.searchsorted(bucket, np.arange(buckets + 1))
    full = np.flatnonzero(np.diff(edges)).tolist()
    rows = [(b, 0, index[edges[b]:edges[b + 1]].tobytes()) for b in full]
    repeats = repeats[np.lexsort((repeats["lo"], repeats["crc"], repeats["doc"]))]
    rows += [((task + no * 7919 + i) % buckets, 1, repeats[i << 12:(i + 1) << 12].tobytes())
             for i in range((len(repeats) + 4095) >> 12)]
    cols = list(zip(*rows, strict=True)) or [()] * 3
    return pa.RecordBatch.from_arrays(
        [pa.array(cols[0], pa.int32()), pa.array([(task << 20) + no] * len(rows), pa.int64()),
         pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.binary())], ["bucket", "batch", "kind", "data"])


def index_batches(texts: DataFrame, buckets: int, length: int, gram: int, batch_bytes: int) -> DataFrame:
    """(bucket, batch, kind, data): every batch's suffix array by bucket (kind 0), and the entries that
    repeat inside the batch (kind 1, in any bucket)."""

    def run(batches):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        parts, size, no = [], 0, 0

        for (docs, crcs), part in common.slices(batches, 2):
            parts.append(spans_of(part, np.array(docs, np.int64), np.array(crcs, np.uint32), length, gram)[0])
            size += sum(map(len, part))
            if size >= batch_bytes:
                yield _dealt(*suffix_array(np.concatenate(parts)), "key", buckets, task, no)
                parts, size, no = [], 0, no + 1
        if parts:
            yield _dealt(*suffix_array(np.concatenate(parts)), "key", buckets, task, no)

    return texts.mapInArrow(run, "bucket int, batch long, kind int, data binary")


def _run_family(group, length: int) -> tuple[Family, list]:
    """(family of a bucket's batches, bytes covered by their repeats)."""
    family = Family()
    repeats = []
    for kind, data in group.sort_values("batch")[["kind", "data"]].itertuples(index=False, name=None):
        e = np.frombuffer(data, ENTRY)
        if kind:
            repeats.append(e)
        else:
            family.add(e.copy())
    return family, [*_intervals(np.concatenate([np.zeros(0, ENTRY), *repeats]), length),
                    *_intervals(np.concatenate([np.zeros(0, ENTRY), *family.repeats]), length)]


def scan_family(batches: DataFrame, length: int) -> DataFrame:
    """Run every bucket's batches through its family of levels."""

    def scan(group):
        family, covered = _run_family(group, length)
        keys, times = np.unique(np.concatenate([np.zeros(0, np.uint64), *(x["key"] for x in family.levels)]),
                                return_counts=True)
        several = times > 1
        return _found(covered, zip(keys[several].view(np.int64).tolist(), times[several].tolist(), strict=True))

    return batches.groupBy("bucket").applyInPandas(scan, REPEATS)


def dense_starts(e: np.ndarray, first: np.ndarray, data: np.ndarray, length: int) -> np.ndarray:
    """An entry for every start of the spans, with the fingerprint of the ``length`` bytes from there."""
    n = e["n"].astype(np.int64)
    which = np.repeat(np.arange(len(e)), n)
    step = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    dense = np.zeros(len(which), ENTRY)
    begin = first[which] + step
    dense["f"] = common.mix(common.Prefix(data).raw(begin, begin + length))
    for c in ("key", "doc", "crc"):
        dense[c] = e[c][which]
    dense["lo"] = e["lo"][which] + step
    dense["n"] = 1
    return dense


def start_batches(texts: DataFrame, several, spread, bits: int, buckets: int, length: int, gram: int,
                  batch_bytes: int) -> DataFrame:
    """(bucket, batch, kind, data, raw) of the spans of the anchors in the bit array ``several``.

    Anchors that are in ``spread`` too send starts: each content of a batch once, by bucket of its fingerprint
    (kind 0), and the starts that repeat inside the batch (kind 1). The others send their spans, once per slice
    and content, with their bytes (kind 2, by bucket of the anchor).
    """
    shared = texts.sparkSession.sparkContext.broadcast((several, spread))

    def run(batches):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        parts, size, no = [], 0, 0

        def flush():
            out = _dealt(*suffix_array(np.concatenate(parts)), "f", buckets, task, no)
            return out.append_column("raw", pa.nulls(out.num_rows, pa.binary()))

        for (docs, crcs), part in common.slices(batches, 2):
            e, first, last, data = spans_of(part, np.array(docs, np.int64), np.array(crcs, np.uint32), length, gram)
            ok = np.flatnonzero(common.in_filter(shared.value[0], e["key"], bits))
            if not len(ok):
                continue
            ok = ok[_earliest(e[ok])]
            ok = ok[~_same(e[ok])]  # spans of equal content are found by their own fingerprints
            hot = common.in_filter(shared.value[1], e["key"][ok], bits)
            if hot.any():
                parts.append(dense_starts(e[ok[hot]], first[ok[hot]], data, length))
                size += parts[-1].nbytes
                if size >= batch_bytes:
                    yield flush()
                    parts, size, no = [], 0, no + 1
            ok = ok[~hot]
            bucket = _bucket(e["key"][ok], buckets)
            order = np.argsort(bucket, kind="stable")
            ok, bucket = ok[order], bucket[order]
            rows = []
            for b in np.unique(bucket):
                at = ok[bucket == b]
                raw = b"".join(data[s:t].tobytes() for s, t in zip(first[at].tolist(), last[at].tolist(), strict=True))
                rows.append((int(b), e[at].tobytes(), raw))
            cols = list(zip(*rows, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int32()), pa.array([-1] * len(rows), pa.int64()),
                 pa.array([2] * len(rows), pa.int32()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.binary())],
                ["bucket", "batch", "kind", "data", "raw"])
        if parts:
            yield flush()

    return texts.mapInArrow(run, "bucket int, batch long, kind int, data binary, raw binary")


def scan_starts(batches: DataFrame, length: int) -> DataFrame:
    """Repeats among all starts of the spans that share an anchor."""

    def of_spans(group):
        e = np.concatenate([np.zeros(0, ENTRY), *(np.frombuffer(x, ENTRY) for x in group["data"])])
        data = np.frombuffer(b"".join(group["raw"]), np.uint8)
        size = e["n"].astype(np.int64) + length - 1
        at = np.cumsum(size) - size
        order = _earliest(e)
        order = order[~_same(e[order])]  # each content once, at its first position
        _, back, times = np.unique(e["key"][order], return_inverse=True, return_counts=True)
        order = order[times[back] > 1]
        if not len(order):
            return []
        return _intervals(suffix_array(dense_starts(e[order], at[order], data, length))[1], length)

    def scan(group):
        spans = group["kind"] == 2
        return _found([*of_spans(group[spans]), *_run_family(group[~spans], length)[1]])

    return batches.groupBy("bucket").applyInPandas(scan, REPEATS)


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id",
                   text_col: str = "text", batch_bytes: int = BATCH_BYTES, buckets: int | None = None,
                   filter_bits: int = FILTER_BITS, spread: int = SPREAD) -> DataFrame:
    """(doc, crc, start, end): stretches of repeated bytes; they can touch and overlap."""
    spark = docs.sparkSession
    common.prepare(spark)
    if buckets is None:
        size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")).cast("long"))).first()[0] or 0
        buckets = max(64, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    texts = _narrow(docs, id_col, text_col)
    found = common.materialise(scan_family(index_batches(texts, buckets, length, gram, batch_bytes), length))
    at = f"shiftrightunsigned(doc, {64 - filter_bits})"

    def bit_array(anchors):
        # at most 2**(filter_bits - 6) rows, whatever the size of the input
        words = (anchors.selectExpr(f"shiftright({at}, 6) AS i", f"shiftleft(1L, cast({at} & 63 AS int)) AS v")
                 .groupBy("i").agg(F.bit_or("v").alias("v")).toArrow())
        out = np.zeros(1 << (filter_bits - 6), np.uint64)
        out[words.column("i").to_numpy()] = words.column("v").to_numpy().view(np.uint64)
        return out

    anchors = found.filter("kind = 1")
    several, many = bit_array(anchors), bit_array(anchors.filter(F.col("start") > spread))
    more = scan_starts(start_batches(texts, several, many, filter_bits, buckets, length, gram, batch_bytes), length)
    return found.filter("kind = 0").unionAll(more).select("doc", "crc", "start", "end")


def _by_text_ids(docs: DataFrame, length: int, gram: int, id_col: str, text_col: str, *more) -> DataFrame:
    """Identifiers numbered in their order (a range sort; a row per distinct one), and put back into the result."""
    common.prepare(docs.sparkSession)
    name = F.col(id_col).cast("string")
    ids = common.materialise(numbered(docs.select(name.alias("name")).filter("name IS NOT NULL").distinct(), ["name"], "no"))
    mine = docs.select(name.alias("name"), F.col(text_col).alias("text")).join(ids, "name", "left").select("no", "text")
    found = substring_dedup(mine, length, gram, "no", "text", *more)
    back = ids.select(F.col("no").alias("doc_id"), F.col("name").cast(docs.schema[id_col].dataType).alias("name"))
    return found.join(back, "doc_id", "left").select(F.col("name").alias("doc_id"), *found.columns[1:])


def substring_dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id",
                    text_col: str = "text", batch_bytes: int = BATCH_BYTES, buckets: int | None = None,
                    filter_bits: int = FILTER_BITS, spread: int = SPREAD) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, removed (array of start, end in
    bytes), kept (the remaining bytes). Identifiers that are not whole numbers are ordered as text."""
    if not isinstance(docs.schema[id_col].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return _by_text_ids(docs, length, gram, id_col, text_col, batch_bytes, buckets, filter_bits, spread)
    per_doc = (repeated_spans(docs, length, gram, id_col, text_col, batch_bytes, buckets, filter_bits, spread)
               .groupBy("doc", "crc").agg(F.collect_list(F.struct("start", "end")).alias("spans")))
    narrow = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc"),
        F.crc32(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")).alias("crc"),
        F.col(text_col).cast("string").alias("text"))
    joined = narrow.join(per_doc, ["doc", "crc"], "left").select("doc_id", "text", "spans")
    kind = joined.schema["doc_id"].dataType.simpleString()
    pair = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def cut(batches):
        for batch in batches:
            rows = []
            for text, spans in zip(common.as_bytes(batch.column(1)), batch.column(2), strict=True):
                text = text or b""
                merged: list[list[int]] = []
                for s, t in sorted((x["start"], x["end"]) for x in spans.as_py() or ()):
                    if merged and s <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], t)
                    else:
                        merged.append([s, t])
                edges = [0, *(x for m in merged for x in m), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                rows.append((len(text), len(text) - len(kept), len(merged),
                             [{"start": s, "end": t} for s, t in merged], kept))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(
                    cols, (pa.int64(), pa.int64(), pa.int64(), pa.list_(pair), pa.binary()), strict=True))],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "removed", "kept"])

    return joined.mapInArrow(cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, "
                                  "removed array<struct<start:long,end:long>>, kept binary")


def op10_substring_dedup(spark, sf_dir: str) -> DataFrame:
    found = substring_dedup(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
