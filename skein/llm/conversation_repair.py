"""Conversation structure repair: a generalised LR parse with weighted edits.

The role grammar says which sequences of roles a conversation may have. Its LR automaton is driven over the
rows by edits instead of by the rows alone: keep a row, give it another role, delete it, or insert a
message. All stacks that some sequence of edits leads to are kept in one graph (stacks share what lies
under their tops), and stacks that become equal are merged by the least (cost, audit), the audit being the
initials of the edits so far. Reductions are made as soon as a rule is complete. At the end the accepted
stack of least (cost, audit) gives the edits.

Scale: rows are sorted by conversation and turn into range partitions (a conversation with a third of all rows
spreads over many) and read as a stream. A conversation that lies within a partition is parsed there and
then. Others are cut into pieces of ``PIECE_ROWS`` rows at most: a piece is parsed from every stack that may stand before
it, which gives a table (stack before, stack after) -> (cost, audit); tables of neighbours are joined in rounds
by partition, then by ``FAN_IN`` partitions and so on. The edits go back to the pieces, which write their messages;
the digest of such a conversation reads them piece by piece in order. A conversation's audit is one value of the
result, so it has to fit into one; nothing else grows with a conversation.

Merging is safe across pieces: of two audits of equal cost over the same rows neither is the beginning of
the other, so what follows does not change their order.

Defined results: null roles and texts are one space, so a null text is blank. Null identifiers form one conversation. Rows of
equal turn follow in the order of role and text (their first 64 characters, then a hash); wholly equal rows are alike.
Conversations without rows have an empty audit and the digest of the empty string.
"""

from __future__ import annotations

import hashlib
import heapq
from functools import cache, lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm import common

#: system? (user assistant)+, or nothing at all
GRAMMAR = (("S", ""), ("S", "P"), ("S", "sP"), ("P", "ua"), ("P", "Pua"))
ROLES = {"u": "user", "a": "assistant"}
LEGAL = frozenset(("su", "ua", "au"))
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Rows of a piece, and bytes of its texts (a longer text forms a piece alone).
PIECE_ROWS, PIECE_BYTES = 1024, 4 << 20
FAN_IN = 64

_BLANKS = common.BLANKS
#: A row as one letter: what its role begins with, and whether it is sound, truncated or has to go.
_CODE = {(i, f): chr(97 + 3 * k + f) for k, i in enumerate("sua?") for f in range(3)}
_ROW = {c: key for key, c in _CODE.items()}


class Stacks:
    """The LR automaton of a grammar, and the graph of its stacks: a node is a state on top of another node."""

    def __init__(self, grammar, start: str = "S"):
        self.grammar, self.start = grammar, start
        self.states = [self._closure({(k, 0) for k, (head, _) in enumerate(grammar) if head == start})]
        self.goto: list[dict[str, int]] = []
        for items in self.states:  # grows while it is read
            after: dict[str, set] = {}
            for k, dot in items:
                if dot < len(grammar[k][1]):
                    after.setdefault(grammar[k][1][dot], set()).add((k, dot + 1))
            row = {}
            for symbol, core in sorted(after.items()):
                target = self._closure(core)
                if target not in self.states:
                    self.states.append(target)
                row[symbol] = self.states.index(target)
            self.goto.append(row)
        self.nodes: list[tuple[int, int]] = [(0, -1)]  # (state, node below)
        self.known = {(0, -1): 0}
        self.shift, self.accepts = cache(self._shift), cache(self._accepts)
        self.reachable = self._reachable()  # numbers the nodes, alike in every process

    def _closure(self, items: set) -> frozenset:
        items = set(items)
        while True:
            heads = {self.grammar[k][1][dot] for k, dot in items if dot < len(self.grammar[k][1])}
            more = {(k, 0) for k, (head, _) in enumerate(self.grammar) if head in heads} - items
            if not more:
                return frozenset(items)
            items |= more

    def _push(self, node: int, symbol: str) -> int | None:
        state = self.goto[self.nodes[node][0]].get(symbol)
        if state is None:
            return None
        if (state, node) not in self.known:
            self.known[state, node] = len(self.nodes)
            self.nodes.append((state, node))
        return self.known[state, node]

    def _reduced(self, node: int, heads) -> list[int]:
        """Nodes after reducing a complete rule on top of a node."""
        out = []
        for k, dot in sorted(self.states[self.nodes[node][0]]):
            head, body = self.grammar[k]
            if dot == len(body) and heads(head):
                below = node
                for _ in body:
                    below = self.nodes[below][1]
                if head == self.start:
                    out.append(below)
                elif (top := self._push(below, head)) is not None:
                    out.append(top)
        return out

    def _shift(self, node: int, symbol: str) -> tuple[int, ...]:
        """The stacks after a symbol: every one that can take another symbol or end, rules reduced."""
        todo, seen = [self._push(node, symbol)], []
        while todo:
            top = todo.pop()
            if top is None or top in seen:
                continue
            seen.append(top)
            todo += self._reduced(top, lambda head: head != self.start)
        return tuple(t for t in seen if self.goto[self.nodes[t][0]] or self._accepts(t))

    def _accepts(self, node: int) -> bool:
        """Does the input may end here: some start rule is complete and nothing lies under it."""
        return 0 in self._reduced(node, lambda head: head == self.start)

    def _reachable(self) -> list[int]:
        """All stacks that any sequence of symbols leads to (a regular grammar has finitely many)."""
        out = [0]
        for node in out:
            for symbol in "sua":
                out += [t for t in self.shift(node, symbol) if t not in out]
        return out


STACKS = Stacks(GRAMMAR)
Best = tuple[int, str]


def _inserted(front: dict[int, Best]) -> dict[int, Best]:
    """The stacks reachable by inserted messages too, each with its least (cost, audit)."""
    out: dict[int, Best] = {}
    heap = [(cost, audit, node) for node, (cost, audit) in front.items()]
    heapq.heapify(heap)
    while heap:
        cost, audit, node = heapq.heappop(heap)
        if node in out:
            continue
        out[node] = (cost, audit)
        for symbol in ROLES:
            for top in STACKS.shift(node, symbol):
                if top not in out:
                    heapq.heappush(heap, (cost + INSERT, audit + "I", top))
    return out


def parse(codes: str, node: int = 0) -> dict[int, Best]:
    """Every stack after the rows (a letter each) with its least (cost, audit), from one stack before them."""
    front: dict[int, Best] = {node: (0, "")}
    for code in codes:
        initial, fault = _ROW[code]
        extra = TRUNCATED if fault == 1 else 0
        after: dict[int, Best] = {}

        def offer(top: int, best: Best, after=after) -> None:
            if top not in after or best < after[top]:
                after[top] = best

        for top, (cost, audit) in _inserted(front).items():
            offer(top, (cost + DELETE, audit + "D"))
            if fault == 2:
                continue
            for to in STACKS.shift(top, initial):
                offer(to, (cost + KEEP + extra, audit + "K"))
            for symbol in ROLES:
                for to in STACKS.shift(top, symbol):
                    offer(to, (cost + REROLE + extra, audit + "R"))
        front = after
    return front


def ended(front: dict[int, Best]) -> Best:
    """The least (cost, audit) of an accepted stack."""
    return min(best for node, best in _inserted(front).items() if STACKS.accepts(node))


@lru_cache(maxsize=1 << 14)
def repair_codes(codes: str) -> Best:
    return ended(parse(codes))


def messages(audit: str, roles: list[str], texts: list[str], before: int, system: bool) -> list[tuple[str, str]]:
    """The repaired (role, text) of rows under their edits; ``before`` messages stand before, ``system`` if the
    conversation begins with one."""
    out, row, n = [], 0, before
    for edit in audit:
        if edit != "D":
            role = "ua"[(n - system) % 2]
            out.append((ROLES[role], "") if edit == "I" else (roles[row] if edit == "K" else ROLES[role], texts[row]))
            n += 1
        row += edit != "I"
    return out


def begins_with_system(audit: str) -> bool:
    """Pairs of user and assistant are even in number, so an odd number of messages has a system one."""
    return (len(audit) - audit.count("D")) % 2 == 1


def written(pairs: list[tuple[str, str]]) -> bytes:
    return "\n".join(f"{role}:{text}" for role, text in pairs).encode()


class Figures:
    """Counts of consecutive rows; ``+`` puts neighbours together."""

    NAMES = ("blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "first", "last")

    def __init__(self, blank=0, duplicate=0, truncated=0, illegal=0, turns=0, low=None, high=None, first=None, last=None):
        self.blank, self.duplicate, self.truncated, self.illegal = blank, duplicate, truncated, illegal
        self.turns, self.low, self.high, self.first, self.last = turns, low, high, first, last

    def __add__(self, other: Figures) -> Figures:
        """Rows are sorted by turn, so a turn on both sides is the last of one and the first of the other."""
        out = Figures(self.blank + other.blank, self.duplicate + other.duplicate, self.truncated + other.truncated,
                      self.illegal + other.illegal, self.turns + other.turns, self.low, other.high, self.first, other.last)
        if self.first is None:
            out.first = other.first
        elif other.first is None:
            out.last = self.last
        else:
            out.illegal += self.last + other.first not in LEGAL
        if self.low is None:
            out.low = other.low
        elif other.low is None:
            out.high = self.high
        else:
            out.turns -= self.high == other.low
        return out

    def cells(self) -> list:
        return [getattr(self, k) for k in self.NAMES]

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


def examine(turns: list, roles: list[str], texts: list[str], seen_before: set[int] | None = None) -> tuple[str, Figures]:
    """(a letter for each row, counts). ``seen_before``: places of rows that an earlier piece has too."""
    out, seen, got = [], set(), Figures()
    for k, (role, text) in enumerate(zip(roles, texts, strict=True)):
        core = text.rstrip(_BLANKS)
        repeated = (role, text) in seen or bool(seen_before and k in seen_before)
        seen.add((role, text))
        if not core:
            fault, got.blank = 2, got.blank + 1
        elif repeated:
            fault, got.duplicate = 2, got.duplicate + 1
        elif core[-1] not in ".!?":
            fault, got.truncated = 1, got.truncated + 1
        else:
            fault = 0
        initial = role[:1]
        if got.first is None:
            got.first = initial
        else:
            got.illegal += got.last + initial not in LEGAL
        got.last = initial
        out.append(_CODE[initial if initial in ("s", "u", "a") else "?", fault])
    numbers = [t for t in turns if t is not None]
    if numbers:
        got.turns, got.low, got.high = len(set(numbers)), numbers[0], numbers[-1]
    return "".join(out), got


# --- on Spark ---------------------------------------------------------------------------------

def _ordered(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, gone_col: str | None) -> DataFrame:
    gone = F.lit(False) if gone_col is None else F.col(gone_col)
    narrow = rows.select(
        F.col(conv_col).alias("conv"), gone.alias("gone"), F.when(~gone, F.col(turn_col).cast("long")).alias("turn"),
        F.when(gone, "").otherwise(F.coalesce(F.col(role_col).cast("string"), F.lit(" "))).alias("role"),
        F.when(gone, "").otherwise(F.coalesce(F.col(text_col).cast("string"), F.lit(" "))).alias("text"))
    keys = [F.col("conv"), F.col("turn"), F.col("r"), F.col("t"), F.col("h"), F.col("n")]
    return (narrow.withColumn("r", F.substring("role", 1, 64)).withColumn("t", F.substring("text", 1, 64))
            .withColumn("h", F.xxhash64("role", "text")).withColumn("n", F.monotonically_increasing_id())
            .repartitionByRange(*keys).sortWithinPartitions(*keys).select("conv", "gone", "turn", "role", "text"))


_COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_TEXTS = "roles array<string>, texts array<string>"


def _row_key(conv, role: str, text: str) -> bytes:
    return hashlib.blake2b(f"{conv is None}:{conv}:{len(role)}:{role}:{text}".encode(), digest_size=16).digest()


def _first_pass(ordered: DataFrame, with_messages: bool, piece_rows: int) -> DataFrame:
    """Whole conversations repaired (``piece`` is null), others as pieces.

    A piece has its rows, and of the rows that are the first of their kind in it the places and keys.
    """
    kind = ordered.schema["conv"].dataType.simpleString()
    schema = f"conv {kind}, piece long, {_COUNTS}, digest string, turns array<long>, {_TEXTS}, places array<int>, keys array<binary>"

    def run(batches):
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 33
        types = None
        out: list[tuple] = []
        size = pieces = 0
        rows: list[tuple] = []
        held = 0
        conv = broken = started = None

        def flush():
            nonlocal size
            cols = list(zip(*out, strict=True)) if out else [()] * 15
            out.clear()
            size = 0
            t = [types, pa.int64(), *[pa.int64()] * 6, pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.string()),
                 pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.binary())]
            names = [x.split()[0] for x in schema.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, t, strict=True)], names)

        def close(whole: bool):
            nonlocal pieces, size, held
            turns, roles, texts = ([r[k] for r in rows] for k in range(3))
            if whole:
                codes, got = examine(turns, roles, texts)
                cost, audit = repair_codes(codes)
                now = messages(audit, roles, texts, 0, begins_with_system(audit))
                out.append((conv, None, got.gaps(), got.blank, got.duplicate, got.truncated, got.illegal, cost, audit,
                            hashlib.sha256(written(now)).hexdigest(), None, [m[0] for m in now] if with_messages else None,
                            [m[1] for m in now] if with_messages else None, None, None))
            else:
                first: dict[bytes, int] = {}
                for k, (role, text) in enumerate(zip(roles, texts, strict=True)):
                    first.setdefault(_row_key(conv, role, text), k)
                out.append((conv, base + pieces, *[None] * 8, turns, roles, texts, list(first.values()), list(first)))
                pieces += 1
            size += held
            rows.clear()
            held = 0

        for batch in batches:
            types = batch.schema.field(0).type
            for c, gone, turn, role, text in zip(*(col.to_pylist() for col in batch.columns), strict=True):
                if started is None or c != conv:
                    if started is not None:
                        # the partition's first conversation may have begun before it
                        close(whole=not broken and started == "inside")
                    started = "edge" if started is None else "inside"
                    conv, broken = c, False
                elif len(rows) >= piece_rows or held >= PIECE_BYTES:
                    close(whole=False)
                    broken = True
                if not gone:
                    rows.append((turn, role, text))
                    held += len(text)
                if size >= PIECE_BYTES or len(out) >= 4096:
                    yield flush()
        if started is not None:
            close(whole=False)
            yield flush()

    return common.materialise(ordered.mapInArrow(run, schema))


_TABLE = "entries array<int>, exits array<int>, costs array<long>, audits array<string>"
_FIGURES = "blank long, duplicate long, truncated long, illegal long, turns long, low long, high long, first string, last string"
_PART = f"{_FIGURES}, {_TABLE}, members array<long>, sizes array<long>"


def _joined(left: list[tuple], right: list[tuple]) -> list[tuple]:
    """(stack before, stack after, cost, audit) of two neighbours."""
    from_: dict[int, list] = {}
    for entry, exit_, cost, audit in right:
        from_.setdefault(entry, []).append((exit_, cost, audit))
    best: dict[tuple[int, int], tuple[int, list]] = {}
    for entry, middle, cost, audit in left:
        for exit_, more, rest in from_.get(middle, ()):
            old = best.get((entry, exit_))
            if old is None or cost + more < old[0]:
                best[entry, exit_] = (cost + more, [(audit, rest)])
            elif cost + more == old[0]:
                old[1].append((audit, rest))
    return [(*key, cost, min(a + b for a, b in ways)) for key, (cost, ways) in best.items()]


def _parts(pieces: DataFrame, kind: str) -> DataFrame:
    """One row for each conversation in pieces: its figures, its table and its pieces."""
    single = (pieces.select("piece", F.explode(F.arrays_zip("places", "keys")).alias("p"))
              .select("piece", F.col("p.places").alias("place"), F.col("p.keys").alias("key")))
    first = single.groupBy("key").agg(F.min(F.struct("piece", "place")).alias("f")).select("f.*")
    again = (single.join(first, ["piece", "place"], "left_anti").groupBy("piece")
             .agg(F.collect_list("place").alias("again")))  # at most a piece's rows
    nodes = STACKS.reachable
    ddl = f"conv {kind}, part long, {_PART}"
    names = [x.split()[0] for x in ddl.split(", ")]

    def batch_of(rows: list[list], conv_type) -> pa.RecordBatch:
        types = [conv_type, pa.int64(), *[pa.int64()] * 7, pa.string(), pa.string(), pa.list_(pa.int32()),
                 pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    def tabled(batches):
        for batch in batches:
            for row in batch.to_pylist():
                codes, got = examine(row["turns"], row["roles"], row["texts"], set(row["again"] or ()))
                table = [(node, top, *best) for node in nodes for top, best in parse(codes, node).items()]
                cols = [list(c) for c in zip(*table, strict=True)]
                yield batch_of([[row["conv"], row["piece"], *got.cells(), *cols, [row["piece"]], [len(codes)]]],
                               batch.schema.field(0).type)

    def merge(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["members"][0])
        figures, members, sizes = Figures(), [], []
        tables = []
        for r in rows:
            figures += Figures(*(r[k] for k in Figures.NAMES))
            members += r["members"]
            sizes += r["sizes"]
            tables.append(list(zip(r["entries"], r["exits"], r["costs"], r["audits"], strict=True)))
        while len(tables) > 1:  # neighbours pairwise
            tables = [_joined(*tables[i:i + 2]) if i + 1 < len(tables) else tables[i] for i in range(0, len(tables), 2)]
        cols = [list(c) for c in zip(*tables[0], strict=True)]
        return pa.Table.from_batches([batch_of([[rows[0]["conv"], 0, *figures.cells(), *cols, members, sizes]],
                                               table.schema.field(0).type)])

    parts = pieces.select("conv", "piece", "turns", "roles", "texts").join(again, "piece", "left").select(
        "conv", "piece", "turns", "roles", "texts", "again").mapInArrow(tabled, ddl)
    top = pieces.agg(F.max(F.shiftright("piece", 33))).first()[0]
    width = 1
    while True:  # pieces of a partition, then of FAN_IN partitions, then of FAN_IN times as many
        if width > 1:
            parts = common.materialise(parts)
        group = (F.shiftright(F.col("members")[0], 33) / width).cast("long")
        parts = parts.withColumn("part", group).groupBy("conv", "part").applyInArrow(merge, ddl)
        if top is None or width > top:
            return parts
        width *= FAN_IN


def _pieced(first: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, counts, audit) of the conversations in pieces, and (conv, piece, roles, texts) of their repaired pieces."""
    kind = first.schema["conv"].dataType.simpleString()
    pieces = first.filter(F.col("piece").isNotNull())
    parts = _parts(pieces, kind)

    def finish(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                got = Figures(*(r[k] for k in Figures.NAMES))
                front = {x: (c, a) for e, x, c, a in zip(r["entries"], r["exits"], r["costs"], r["audits"], strict=True) if e == 0}
                cost, audit = ended(front)
                out.append((r["conv"], got.gaps(), got.blank, got.duplicate, got.truncated, got.illegal, cost, audit,
                            r["members"], r["sizes"]))
            cols = list(zip(*out, strict=True)) if out else [()] * 10
            types = [batch.schema.field(0).type, *[pa.int64()] * 6, pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                             ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                                              "members", "sizes"])

    finished = common.materialise(parts.drop("part").mapInArrow(
        finish, f"conv {kind}, {_COUNTS}, members array<long>, sizes array<long>"))

    def deal(batches):
        """Every piece's edits, the number of messages before it and whether the first is a system message."""
        for batch in batches:
            for audit, members, sizes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                system, at, before, out = begins_with_system(audit), 0, 0, []
                for k, (member, size) in enumerate(zip(members, sizes, strict=True)):
                    end = at
                    while size:  # edits of this piece's rows, and what is inserted before them
                        size -= audit[end] != "I"
                        end += 1
                    if k == len(members) - 1:
                        end = len(audit)
                    mine = audit[at:end]
                    out.append((member, mine, before, system))
                    before += len(mine) - mine.count("D")
                    at = end
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0]), pa.array(cols[1]), pa.array(cols[2]), pa.array(cols[3])],
                                                 ["piece", "edits", "before", "system"])

    edits = finished.select("audit", "members", "sizes").mapInArrow(deal, "piece long, edits string, before long, system boolean")

    def rewrite(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                now = messages(r["edits"], r["roles"], r["texts"], r["before"], r["system"])
                out.append((r["conv"], r["piece"], r["before"], [m[0] for m in now], [m[1] for m in now]))
            cols = list(zip(*out, strict=True)) if out else [()] * 5
            types = [batch.schema.field(0).type, pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                             ["conv", "piece", "before", "roles", "texts"])

    texts = pieces.select("conv", "piece", "roles", "texts").join(edits, "piece").select(
        "conv", "piece", "roles", "texts", "edits", "before", "system").mapInArrow(
        rewrite, f"conv {kind}, piece long, before long, {_TEXTS}")
    return finished.drop("members", "sizes"), texts


def _digests(texts: DataFrame) -> DataFrame:
    """(conv, digest): the pieces of a conversation in order, a piece at a time."""
    kind = texts.schema["conv"].dataType.simpleString()

    def run(batches):
        conv = digest = some = None
        types = pa.int64()

        def done():
            return pa.RecordBatch.from_arrays([pa.array([conv], types), pa.array([digest.hexdigest()])], ["conv", "digest"])

        for batch in batches:
            types = batch.schema.field(0).type
            for i in range(batch.num_rows):
                c, roles, texts_ = (batch.column(k)[i].as_py() for k in (0, 1, 2))
                if digest is None or c != conv:
                    if digest is not None:
                        yield done()
                    conv, digest, some = c, hashlib.sha256(), False
                if roles:
                    digest.update((b"\n" if some else b"") + written(list(zip(roles, texts_, strict=True))))
                    some = True
        if digest is not None:
            yield done()

    return (texts.repartition("conv").sortWithinPartitions("conv", "piece").select("conv", "roles", "texts")
            .mapInArrow(run, f"conv {kind}, digest string"))


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", gone_col: str | None = None, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``gone_col`` marks rows that only say that their conversation exists.
    """
    common.prepare(rows.sparkSession)
    first = _first_pass(_ordered(rows, conv_col, turn_col, role_col, text_col, gone_col), False, piece_rows)
    finished, texts = _pieced(first)
    digests = _digests(texts).select(F.col("conv").alias("c"), "digest")
    pieced = finished.join(digests, finished["conv"].eqNullSafe(digests["c"])).drop("c")
    whole = first.filter(F.col("piece").isNull()).select(*pieced.columns)
    return whole.unionAll(pieced).withColumnsRenamed({"conv": "conv_id", "digest": "repaired_sha256"})


def repaired_messages(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                      text_col: str = "text", gone_col: str | None = None, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """The repaired conversations: conv_id, position (from 0), role, text."""
    common.prepare(rows.sparkSession)
    first = _first_pass(_ordered(rows, conv_col, turn_col, role_col, text_col, gone_col), True, piece_rows)
    _, texts = _pieced(first)
    whole = first.filter(F.col("piece").isNull()).select("conv", F.lit(0).cast("long").alias("before"), "roles", "texts")
    return (whole.unionAll(texts.select("conv", "before", "roles", "texts"))
            .select("conv", "before", F.posexplode(F.arrays_zip("roles", "texts")).alias("at", "m"))
            .select(F.col("conv").alias("conv_id"), (F.col("before") + F.col("at")).alias("position"),
                    F.col("m.roles").alias("role"), F.col("m.texts").alias("text")))


# --- registered query -------------------------------------------------------------------------

def damage(conversations: DataFrame) -> DataFrame:
    """Rows damaged by crc32(``conv_id:turn``) mod 20; dropped rows stay as markers (``gone``)."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("text", "role"))
    times = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (kind == 0).alias("gone"), F.explode(times).alias("copy")).drop("copy")


def op13_conversation_repair(spark, sf_dir: str) -> DataFrame:
    return repair(damage(common.table(spark, sf_dir, "conversations")), gone_col="gone")


def _crc32_sql(text: str) -> str:
    """crc32 of an ASCII string: the bits of each byte in turn."""
    byte = "xor(c, b)"
    bits = f"list_reduce(range(8), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)), {byte})"
    return f"xor(4294967295, list_reduce(list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT), lambda c, b: {bits}, 4294967295::BIGINT))"


def _least(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


def _then(state: str, cost: str, edit: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}'}}"


#: States of the parse in SQL: z (nothing yet), s (a system message), u (a user waits), a (pairs are complete).
_INSERT_SQL = "{'z': q.z, 's': q.s, 'u': %s, 'a': %s}" % (
    _least("q.u", *(_then(f"q.{x}", str(INSERT), "I") for x in "zsa")),
    _least("q.a", _then("q.u", str(INSERT), "I"), *(_then(f"q.{x}", str(2 * INSERT), "II") for x in "zsa")))
_EXTRA = f"(CASE WHEN t.x.fault = 1 THEN {TRUNCATED} ELSE 0 END)"


def _role_sql(state: str) -> str:
    """A row becomes a message of this role: kept if it is one, else with a new role."""
    below = {"s": "z", "u": "zsa", "a": "u"}[state]
    ways = [_then(f"t.q.{b}", f"{_EXTRA} + (CASE WHEN t.x.fault = 2 OR t.x.initial <> '{state}' THEN 1000000000 ELSE 0 END)", "K")
            for b in below]
    if state != "s":
        ways += [_then(f"t.q.{b}", f"{_EXTRA} + (CASE WHEN t.x.fault = 2 THEN 1000000000 ELSE {REROLE} END)", "R") for b in below]
    return _least(*ways, _then(f"t.q.{state}", str(DELETE), "D"))


_NONE = "{'c': 1000000000::BIGINT, 'a': ''}"
_SAID_SQL = "(CASE WHEN (n - odd) % 2 = 0 THEN 'user' ELSE 'assistant' END)"
OP13_SQL = f"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, k % 20 AS k FROM (
    SELECT *, {_crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} AS k FROM conversations)),
d AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN k = 1 THEN '' WHEN k = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN k = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM r WHERE k <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos FROM d),
f AS (
  SELECT *, rtrim(text, {" || ".join(f"chr({ord(c)})" for c in common.BLANKS)}) AS core, substr(role, 1, 1) AS initial,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again,
         lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before
  FROM o),
g AS (
  SELECT *, CASE WHEN core = '' THEN 3 WHEN again THEN 2 WHEN right(core, 1) NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS kind
  FROM f),
c AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         (count(*) FILTER (kind = 3))::BIGINT AS blank, (count(*) FILTER (kind = 2))::BIGINT AS duplicate,
         (count(*) FILTER (kind = 1))::BIGINT AS truncated,
         (count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')))::BIGINT AS illegal,
         list({{'initial': initial, 'fault': least(kind, 2)}} ORDER BY pos) AS rows,
         list({{'role': role, 'text': text}} ORDER BY pos) AS texts
  FROM g GROUP BY conv_id),
p AS (
  SELECT c.*, list_reduce(rows, lambda w, x: list_transform([{{'q': {_INSERT_SQL.replace("q.", "w.")}, 'x': x}}], lambda t:
      {{'z': {_then("t.q.z", str(DELETE), "D")}, 's': {_role_sql("s")}, 'u': {_role_sql("u")}, 'a': {_role_sql("a")}}})[1],
    {{'z': {{'c': 0::BIGINT, 'a': ''}}, 's': {_NONE}, 'u': {_NONE}, 'a': {_NONE}}}) AS q
  FROM c),
b AS (
  SELECT *, {_least("q.z", "q.a", _then("q.u", str(INSERT), "I"), _then("q.s", str(2 * INSERT), "II"))} AS best FROM p),
m AS (
  SELECT conv_id, texts, best.a AS audit, length(replace(best.a, 'D', '')) % 2 AS odd,
         unnest(range(1, length(best.a) + 1)) AS i FROM b),
w AS (
  SELECT conv_id, i, substr(audit, i, 1) AS edit, odd, length(replace(substr(audit, 1, i - 1), 'D', '')) AS n,
         texts[length(replace(substr(audit, 1, i), 'I', ''))] AS row
  FROM m),
l AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN row.role ELSE {_SAID_SQL} END || ':'
                             || CASE WHEN edit = 'I' THEN '' ELSE row.text END, chr(10) ORDER BY i) AS said
  FROM w WHERE edit <> 'D' GROUP BY conv_id)
SELECT a.conv_id, coalesce(b.gaps, 0) AS gaps, coalesce(b.blank, 0) AS blank, coalesce(b.duplicate, 0) AS duplicate,
       coalesce(b.truncated, 0) AS truncated, coalesce(b.illegal, 0) AS illegal, coalesce(b.best.c, 0) AS cost,
       coalesce(b.best.a, '') AS audit, sha256(coalesce(l.said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN l ON l.conv_id IS NOT DISTINCT FROM a.conv_id"""
