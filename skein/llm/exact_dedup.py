"""Exact dedup: tree-merge of sorted digest runs.

Every task sorts the SHA-256 digests of its texts into runs. Partitions exchange their runs in rounds, as in
a binomial tree (with ``FAN_IN`` partners a round): a partition cuts its run at the next digit of the
digests, sends each piece to the partner of that digit, and merges the pieces it is sent. After the last
round each partition holds one range of digests with, for each, the identifier that stays, its row and the
number of rows. The answers go back the way the runs came, to the rows that asked.

Runs are merged by the first 64 bits of the digests. Before identifiers are reduced, at every level, equal
keys are verified by the whole digest and the length of the text.

Scale: a text is read once, where it lies; 64 bytes an entry travel. A digest has one entry in a run, so a
text held by a third of all rows arrives as one entry a partner in every round, and its rows are answered
run by run: no key gathers in a task. The number of rounds follows from the number of rows, so a
partition ends with about ``RUN_ROWS`` entries at any size. Each round's runs are stored in the shared
checkpoint folder.

Defined results: a null text equals the empty one. Identifiers are compared as numbers if their type is
integral, else as text. A null identifier stays only if its group has no other. Of rows that share the staying identifier, the one
read first stays, so exactly one row of a group stays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.llm import common

#: Partners of a round (a power of two).
FAN_IN = 8
#: Digests a partition holds after the last round, on average at most.
RUN_ROWS = 1 << 14
#: Rows sorted at once by a task.
LEAF_ROWS = 1 << 16


def normalised(text: Column) -> Column:
    """A-Z lower-cased; null counts as empty."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), common.UPPER, common.UPPER.lower())


def _id_kind(docs: DataFrame, id_col: str) -> str:
    kind = docs.schema[id_col].dataType
    return "long" if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)) else "string"


class Run:
    """Entries in columns: digest as four words, bytes of text, identifier, row, number of rows."""

    def __init__(self, words: np.ndarray, sizes: np.ndarray, ids: pa.Array, rows: np.ndarray, counts: np.ndarray):
        self.words, self.sizes, self.ids, self.rows, self.counts = words, sizes, ids, rows, counts

    @classmethod
    def read(cls, table: pa.Table, i: int) -> Run:
        get = lambda name, kind: np.frombuffer(table[name][i].as_buffer(), kind)
        return cls(get("digests", ">u8").astype(np.uint64).reshape(-1, 4), get("sizes", np.int64),
                   table["ids"][i].values, get("rows", np.int64), get("counts", np.int64))

    @classmethod
    def concat(cls, runs: list[Run]) -> Run:
        return cls(*(np.concatenate([getattr(r, k) for r in runs]) for k in ("words", "sizes")),
                   pa.concat_arrays([r.ids for r in runs]),
                   *(np.concatenate([getattr(r, k) for r in runs]) for k in ("rows", "counts")))

    def take(self, at: np.ndarray) -> Run:
        return Run(self.words[at], self.sizes[at], self.ids.take(pa.array(at)), self.rows[at], self.counts[at])

    def cells(self) -> dict:
        return {"digests": self.words.astype(">u8").tobytes(), "sizes": self.sizes.tobytes(), "ids": self.ids,
                "rows": self.rows.tobytes(), "counts": self.counts.tobytes()}

    def merge_order(self) -> tuple[np.ndarray, np.ndarray]:
        """(order, first of each group of equal texts): sorted by digest, equality verified in full.

        The runs in it are sorted, which the stable sort exploits.
        """
        order = np.argsort(self.words[:, 0], kind="stable")
        w, s = self.words[order], self.sizes[order]
        same_key = w[1:, 0] == w[:-1, 0]
        same = same_key & (w[1:] == w[:-1]).all(1) & (s[1:] == s[:-1])
        if (same != same_key).any():  # different texts share 64 bits
            order = np.lexsort((self.sizes, *self.words.T[::-1]))
            w, s = self.words[order], self.sizes[order]
            same = (w[1:] == w[:-1]).all(1) & (s[1:] == s[:-1])
        return order, np.concatenate([[True], ~same]) if len(order) else np.zeros(0, bool)

    def reduce(self, largest: bool) -> tuple[Run, np.ndarray]:
        """(one entry for each text with its staying row, for every entry of this run the place of its text)."""
        order, first = self.merge_order()
        group = np.cumsum(first) - 1
        has = self.ids.is_valid().to_numpy(zero_copy_only=False)[order]
        if pa.types.is_integer(self.ids.type):
            rank = self.ids.fill_null(0).to_numpy()[order]
        else:
            rank = np.unique(self.ids.fill_null("").to_numpy(zero_copy_only=False).astype(object),
                             return_inverse=True)[1][order]
        best = order[np.lexsort((self.rows[order], ~rank if largest else rank, ~has, group))[np.flatnonzero(first)]]
        out = self.take(best)
        out.counts = np.add.reduceat(self.counts[order], np.flatnonzero(first)) if len(order) else self.counts
        place = np.empty(len(order), np.int64)
        place[order] = group
        return out, place


def _run_ddl(kind: str) -> str:
    return f"digests binary, sizes binary, ids array<{kind}>, rows binary, counts binary"


def _answer_ddl(kind: str) -> str:
    return f"src long, dest long, ids array<{kind}>, rows binary, counts binary"


def _table(rows: list[dict], ddl: str, ids: pa.DataType) -> pa.Table:
    kinds = {"binary": pa.binary(), "long": pa.int64(), "array<binary>": pa.list_(pa.binary()),
             "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    cols = {}
    for part in ddl.split(", "):
        name, kind = part.split(" ")
        values = [r[name] for r in rows]
        if name == "ids":
            edges = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
            flat = pa.concat_arrays([v.cast(ids) for v in values]) if values else pa.array([], ids)
            cols[name] = pa.ListArray.from_arrays(pa.array(edges), flat)
        else:
            cols[name] = pa.array(values, kinds[kind])
    return pa.table(cols)


def sorted_runs(docs: DataFrame, id_col: str, text_col: str, row_col: str | None) -> DataFrame:
    """(run, digests, sizes, ids, rows, counts): every row of the input, sorted by digest within runs."""
    kind = _id_kind(docs, id_col)
    ids = pa.int64() if kind == "long" else pa.string()
    text = normalised(F.col(text_col))
    row = F.monotonically_increasing_id() if row_col is None else F.col(row_col)
    narrow = docs.select(F.col(id_col).cast(kind).alias("id"), row.alias("row"),
                         F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
                         F.octet_length(text).cast("long").alias("size"))
    ddl = f"run long, {_run_ddl(kind)}"

    def run(batches):
        held, n = [], 0

        def flush():
            t = pa.Table.from_batches(held).combine_chunks()
            digest = t["digest"].combine_chunks() if t["digest"].num_chunks != 1 else t["digest"].chunk(0)
            out = Run(np.frombuffer(b"".join(digest.to_pylist()), ">u8").astype(np.uint64).reshape(-1, 4),
                      t["size"].to_numpy(), pa.concat_arrays(t["id"].chunks).cast(ids), t["row"].to_numpy(),
                      np.ones(t.num_rows, np.int64))
            name = int(out.rows[0])
            return _table([{"run": name, **out.take(out.merge_order()[0]).cells()}], ddl, ids).to_batches()

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= LEAF_ROWS:
                yield from flush()
                held, n = [], 0
        if n:
            yield from flush()

    return narrow.mapInArrow(run, ddl)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
                row_col: str | None = None, fan_in: int = FAN_IN, run_rows: int = RUN_ROWS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, row.

    ``keep`` says which identifier of equal texts stays, ``smallest`` or ``largest``. ``row_col`` names a
    column that numbers the rows (without it they are numbered as read).
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep must be 'smallest' or 'largest'")
    common.prepare(docs.sparkSession)
    largest, bits = keep == "largest", fan_in.bit_length() - 1
    kind = _id_kind(docs, id_col)
    ids = pa.int64() if kind == "long" else pa.string()
    leaves = common.materialise(sorted_runs(docs, id_col, text_col, row_col))
    rows = leaves.agg(F.sum(F.length("rows") / 8)).first()[0] or 0
    rounds = 1
    while fan_in ** rounds * run_rows < rows:
        rounds += 1
    slots = fan_in ** rounds
    piece_ddl, merged_ddl = f"dest long, src long, {_run_ddl(kind)}", f"slot long, {_run_ddl(kind)}, srcs array<long>, places array<binary>"

    def cut(level: int):
        """Pieces of each run by the next digit of its digests."""
        weight = fan_in ** (rounds - 1 - level)

        def run(batches):
            for batch in batches:
                table = pa.Table.from_batches([batch])
                for i in range(table.num_rows):
                    one = Run.read(table, i)
                    src = table[0][i].as_py()
                    slot = src
                    if level == 0:  # a leaf's rows: one entry for each text
                        one, slot = one.reduce(largest)[0], int(common.mix(np.array([src], np.int64).view(np.uint64))[0] % np.uint64(slots))
                    digit = (one.words[:, 0] >> np.uint64(64 - bits * (level + 1))) & np.uint64(fan_in - 1)
                    base = slot - slot // weight % fan_in * weight
                    edges = np.searchsorted(digit, np.arange(fan_in + 1).astype(np.uint64))
                    out = [{"dest": base + d * weight, "src": src,
                            **one.take(np.arange(edges[d], edges[d + 1])).cells()}
                           for d in range(fan_in) if edges[d] < edges[d + 1]]
                    yield from _table(out, piece_ddl, ids).to_batches()
        return run

    def merge(table: pa.Table) -> pa.Table:
        order = np.argsort(table["src"].to_numpy())
        runs = [Run.read(table, i) for i in order.tolist()]
        merged, place = Run.concat(runs).reduce(largest)
        edges = np.cumsum([0, *(len(r.rows) for r in runs)])
        return _table([{"slot": table["dest"][0].as_py(), **merged.cells(), "srcs": table["src"].to_numpy()[order],
                        "places": [place[a:b].astype("<i4").tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]}],
                      merged_ddl, ids)

    def answers(table: pa.Table, i: int, found: tuple[pa.Array, np.ndarray, np.ndarray]) -> list[dict]:
        """What a merged run answers each of its sources, in the order of the piece it sent."""
        out = []
        for src, places in zip(table["srcs"][i].as_py(), table["places"][i].as_py(), strict=True):
            at = np.frombuffer(places, "<i4")
            out.append({"src": src, "dest": table["slot"][i].as_py(), "ids": found[0].take(pa.array(at)),
                        "rows": found[1][at].tobytes(), "counts": found[2][at].tobytes()})
        return out

    def collected(told: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The partners' answers put together in the order of the run (by digit)."""
        order = np.argsort(told["dest"].to_numpy()).tolist()
        get = lambda name: np.concatenate([np.frombuffer(told[name][i].as_buffer(), np.int64) for i in order])
        return pa.concat_arrays([told["ids"][i].values for i in order]), get("rows"), get("counts")

    def root(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for i in range(table.num_rows):
                one = Run.read(table, i)
                yield from _table(answers(table, i, (one.ids, one.rows, one.counts)), _answer_ddl(kind), ids).to_batches()

    def pass_on(told: pa.Table, held: pa.Table) -> pa.Table:
        return _table(answers(held, 0, collected(told)), _answer_ddl(kind), ids)

    def tell(told: pa.Table, held: pa.Table) -> pa.Table:
        leaf = Run.read(held, 0)
        keep_id, keep_row, count = collected(told)
        _, place = leaf.reduce(largest)
        at = pa.array(place)
        digests = leaf.words.astype(">u8").tobytes().hex()
        return pa.table({"doc_id": leaf.ids.cast(ids), "keep_id": keep_id.take(at).cast(ids),
                         "group_size": pa.array(count[place]), "kept": pa.array(keep_row[place] == leaf.rows),
                         "text_sha256": [digests[i:i + 64] for i in range(0, len(digests), 64)],
                         "row": pa.array(leaf.rows)})

    levels, runs = [], leaves
    for level in range(rounds):
        runs = common.materialise(runs.mapInArrow(cut(level), piece_ddl).groupBy("dest").applyInArrow(merge, merged_ddl))
        levels.append(runs)
    told = levels[-1].mapInArrow(root, _answer_ddl(kind))
    for held in levels[-2::-1]:
        told = told.groupBy("src").cogroup(held.groupBy("slot")).applyInArrow(pass_on, _answer_ddl(kind))
    return told.groupBy("src").cogroup(leaves.groupBy("run")).applyInArrow(
        tell, f"doc_id {kind}, keep_id {kind}, group_size long, kept boolean, text_sha256 string, row long")


def apply_exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The input's rows that stay, all columns as they are (the input is stored once, with numbered rows)."""
    name = "__row"
    while name in docs.columns:
        name += "_"
    stored = common.materialise(docs.withColumn(name, F.monotonically_increasing_id()))
    stays = exact_dedup(stored, id_col, text_col, keep, name).filter("kept").select(F.col("row").alias(name))
    return stored.join(stays, name, "left_semi").select(*docs.columns)


# --- registered query -------------------------------------------------------------------------

def op12_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(common.table(spark, sf_dir, "documents"), keep="largest").drop("row")


OP12_SQL = f"""
WITH n AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), '{common.UPPER}', '{common.UPPER.lower()}')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept, text_sha256
FROM n WINDOW w AS (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST)"""
