"""JSON-array files read by byte ranges.

A file that holds one top-level array is cut by Spark's text source into blocks at closing braces, wherever they are.
Whether a block begins inside a string, and at what depth of brackets, follows from the blocks before it: a first
pass sums each block up for either case (one row per block), the sums are chained per file, and a second
pass cuts the elements out at the commas of depth 1. An element that crosses blocks is put together from its
fragments. So one large file is read by many tasks, and an element's number in its file is the same for any
block size.

Defined results: an empty or blank file has no element. A file whose top level is not an array is one element.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.session import ship_code

#: Text scanned at once.
SLICE = 4 << 20

_ESCAPED = re.compile(rb"\\.", re.DOTALL)
_DEPTH = np.zeros(256, np.int8)
for _c, _d in ((b"[", 1), (b"{", 1), (b"]", -1), (b"}", -1)):
    _DEPTH[_c[0]] = _d


def scan(text: bytes, inside: bool) -> tuple[np.ndarray, np.ndarray, bool]:
    """(depth after each byte relative to the start, which bytes are commas outside strings, does a string go on).

    ``inside``: the text begins inside a string. An escape never crosses texts that end with a brace.
    """
    data = np.frombuffer(_ESCAPED.sub(b"..", text), np.uint8)
    quotes = np.cumsum(data == 0x22, dtype=np.int32) + int(inside)
    outside = quotes % 2 == 0
    depth = np.cumsum(np.where(outside, _DEPTH[data], 0), dtype=np.int32)
    return depth, outside & (data == 0x2C), bool(len(quotes) and quotes[-1] % 2) if len(data) else inside


def _blocks(batches, columns: int) -> Iterator[tuple[tuple, Iterator[bytes]]]:
    """(first columns, slices of the text) of every block; rows of a block follow each other."""
    def rows():
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    it = rows()
    row = next(it, None)
    while row is not None:
        key = row[:columns]

        def slices(key=key):
            nonlocal row
            held, size = [], 0
            while row is not None and row[:columns] == key:
                held.append(row[columns])
                size += len(held[-1])
                row = next(it, None)
                if size >= SLICE:
                    yield "".join(held).encode()
                    held, size = [], 0
            if held:
                yield "".join(held).encode()
        yield key, slices()
        while row is not None and row[:columns] == key:  # what the reader left
            row = next(it, None)


def read_elements(spark: SparkSession, path: str | list[str], folders: Column | str | None = None) -> DataFrame:
    """(file, pos, text): the elements of the top-level array of every file, numbered from 0 in their file.

    Blocks are as large as ``spark.sql.files.maxPartitionBytes`` says. ``folders`` is a condition on the partition
    columns in the folders' names (``run_date=...``): files of other folders are not opened.
    """
    ship_code(spark)
    landed = spark.read.option("lineSep", "}").text(path)
    pieces = (landed if folders is None else landed.filter(folders)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.concat("value", F.lit("}")).alias("text"), (F.col("_metadata.file_block_length") < F.col("_metadata.file_size")).alias("part"))

    def sum_up(batches):
        for (file, block), texts in _blocks(batches, 2):
            cases = [[inside, 0, {}] for inside in (False, True)]  # string goes on, depth, commas by depth
            array = None
            for text in texts:
                if array is None and text.strip():
                    array = _opens(text) >= 0
                for case in cases:
                    depth, comma, goes_on = scan(text, case[0])
                    at, n = np.unique(depth[comma] + case[1], return_counts=True)
                    for a, k in zip(at.tolist(), n.tolist(), strict=True):
                        case[2][a] = case[2].get(a, 0) + k
                    case[0], case[1] = goes_on, case[1] + (int(depth[-1]) if len(depth) else 0)
            cols = [[file], [block], [bool(array)]]
            for goes_on, depth, commas in cases:
                cols += [[goes_on], [depth], [list(commas)], [list(commas.values())]]
            types = [pa.string(), pa.int64(), pa.bool_(), *[pa.bool_(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())] * 2]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

    names = ["file", "block", "is_array", *(f"{n}{i}" for i in (0, 1) for n in ("goes_on", "depth", "at", "n"))]
    sums = pieces.filter("part").select("file", "block", "text").mapInArrow(
        sum_up, "file string, block long, is_array boolean, " + ", ".join(
            f"goes_on{i} boolean, depth{i} long, at{i} array<long>, n{i} array<long>" for i in (0, 1)))

    def chain(table: pa.Table) -> pa.Table:
        """What every block of a file begins with: inside a string, depth, elements before it."""
        inside, depth, before, out = False, 0, 0, []
        rows = sorted(table.to_pylist(), key=lambda r: r["block"])
        for r in rows:
            out.append((r["file"], r["block"], rows[0]["is_array"], inside, depth, before))
            i = int(inside)
            before += dict(zip(r[f"at{i}"], r[f"n{i}"], strict=True)).get(1 - depth, 0)
            inside, depth = r[f"goes_on{i}"], depth + r[f"depth{i}"]
        cols = list(zip(*out, strict=True))
        types = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64()]
        return pa.table([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                        names=["file", "block", "is_array", "inside", "depth", "before"])

    # one row for each block after a file's first: the input's bytes / maxPartitionBytes, some 100 bytes each
    chained = sums.groupBy("file").applyInArrow(
        chain, "file string, block long, is_array boolean, inside boolean, depth long, before long").filter("block > 0").collect()
    states = spark.sparkContext.broadcast({(r["file"], r["block"]): tuple(r)[2:] for r in chained})

    def batch(out):
        types = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
        cols = list(zip(*out, strict=True)) if out else [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                          ["file", "pos", "block", "whole", "text"])

    def cut(batches):
        for (file, block), texts in _blocks(batches, 2):
            array, inside, depth, pos = states.value.get((file, block), (None, False, 0, 0))
            began = block == 0  # the element in hand begins in this block
            ended, rest, out, size = False, [], [], 0
            for text in texts:
                if ended:
                    continue  # behind the closing bracket
                at = 0
                d, comma, goes_on = scan(text, inside)
                if array is None and text.strip():
                    at = _opens(text) + 1
                    array = at > 0
                level = d + depth
                stops = np.flatnonzero(comma & (level == 1)).tolist() if array else []
                closing = np.flatnonzero((level == 0) & (np.diff(level, prepend=depth) < 0))
                last = int(closing[0]) if len(closing) and array is not None else None
                if last is not None:  # the file's top level ends here; what the reader added behind it goes
                    stops = [x for x in stops if x < last] + [last + (not array)]
                    ended = True
                for end in stops:
                    out.append((file, pos, block, began, b"".join([*rest, text[at:end]]).decode()))
                    size += end - at
                    rest, at, began, pos = [], end + 1, True, pos + 1
                if not ended:
                    rest.append(text[at:])
                inside, depth = goes_on, depth + (int(d[-1]) if len(d) else 0)
                if size >= SLICE:
                    yield batch(out)
                    out, size = [], 0
            if rest and not ended:
                out.append((file, pos, block, False, b"".join(rest).decode()))
            yield batch(out)

    parts = pieces.select("file", "block", "text").mapInArrow(cut, "file string, pos long, block long, whole boolean, text string")
    whole = parts.filter("whole").select("file", "pos", "text")
    glued = parts.filter("NOT whole").groupBy("file", "pos").agg(F.array_sort(F.collect_list(F.struct("block", "text"))).alias("f")) \
        .select("file", "pos", F.array_join(F.transform("f", lambda x: x["text"]), "").alias("text"))  # one element's fragments
    return whole.unionAll(glued).filter(F.trim("text", F.lit(" \t\n\r}")) != "")


def _opens(text: bytes) -> int:
    """Place of the bracket that a text begins with, -1 if it begins otherwise (a byte-order mark is passed over)."""
    begin = re.match(rb"(?:\xef\xbb\xbf)?\s*", text).end()
    return begin if text[begin:begin + 1] == b"[" else -1
