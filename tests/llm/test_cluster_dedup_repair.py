"""Centroid clustering, exact dedup and conversation repair against brute force; text ids and ties of earlier operators."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.llm import centroid_clusters, conversation_repair, exact_dedup, simhash_dups, substring_dedup
from tests.llm import brute

SCHEMA = "doc_id long, text string, row string, digest string, kept string, slot string"


# --- exact dedup ------------------------------------------------------------------------------

def _docs(spark, rows, kind="long"):
    return (spark.createDataFrame([(i, t, "x", "y", "z", "s") for i, t in rows], SCHEMA).repartition(7)
            .withColumn("doc_id", F.col("doc_id").cast(kind)))


DOCS = ([(i, f"text {i % 23} É") for i in range(150)] + [(i, "Big TEXT" if i % 2 else "big text") for i in range(700)]
        + [(900, None), (901, ""), (902, " "), (None, "é only"), (None, "É ONLY"), (None, "é only"), (903, "word " * 40000),
           (904, "WORD " * 40000), (5, "again"), (5, "again"), (5, "Again"), (None, "again"), (-3, "low"), (-(2**63), "low")])


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("kind", ["long", "string"])
def test_exact_dedup(spark, keep, kind):
    groups: dict = {}
    for i, t in DOCS:
        groups.setdefault((t or "").translate(brute.LOWER), []).append(i if i is None or kind == "long" else str(i))
    want = {}
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        want[hashlib.sha256(t.encode()).hexdigest()] = ((min if keep == "smallest" else max)(known) if known else None, len(ids))
    got = exact_dedup.exact_dedup(_docs(spark, DOCS, kind), keep=keep, fan_in=4, run_rows=32).collect()  # three rounds
    assert Counter(r["doc_id"] for r in got) == Counter(i if i is None or kind == "long" else str(i) for i, _ in DOCS)
    assert all((r["keep_id"], r["group_size"]) == want[r["text_sha256"]] for r in got)
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])
    assert Counter(r["text_sha256"] for r in got if r["kept"]) == dict.fromkeys(want, 1)


def test_exact_dedup_rows_and_empty_table(spark):
    kept = exact_dedup.apply_exact_dedup(_docs(spark, DOCS), keep="largest")
    assert kept.columns == ["doc_id", "text", "row", "digest", "kept", "slot"]
    rows = kept.collect()
    assert len(rows) == len({(t or "").translate(brute.LOWER) for _, t in DOCS}) and {r["row"] for r in rows} == {"x"}
    assert exact_dedup.exact_dedup(_docs(spark, [])).count() == 0
    with pytest.raises(ValueError, match="keep"):
        exact_dedup.exact_dedup(_docs(spark, DOCS), keep="first")


def test_equal_keys_are_verified_in_full():
    import pyarrow as pa

    words = np.array([[1, 2, 3, 4], [1, 2, 3, 5], [1, 2, 3, 4], [0, 9, 9, 9], [1, 2, 3, 4]], np.uint64)
    run = exact_dedup.Run(words, np.array([7, 7, 7, 7, 8]), pa.array([5, 6, 2, 1, 0]), np.arange(5), np.ones(5, np.int64))
    one, place = run.reduce(largest=False)
    assert len(one.rows) == 4 and one.counts.tolist() == [1, 2, 1, 1]  # 64 bits alike, the rest or the length not
    assert one.ids.to_pylist() == [1, 2, 0, 6] and place.tolist() == [1, 3, 1, 0, 2]


# --- centroid clustering ----------------------------------------------------------------------

def _kmeans(rows, k, rounds, dims, seed):
    keep = [(i, [max(-(1 << 27), min(1 << 27, math.floor(256 * x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(keep, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cs = [v for _, v in order[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(cs))
    for _ in range(rounds):
        at = [near(v)[1] for _, v in keep]
        cs = [[sum(x) // len(x) for x in zip(*mine, strict=True)]
              if (mine := [v for (_, v), a in zip(keep, at, strict=True) if a == j]) else c for j, c in enumerate(cs)]
    final = [(i, *near(v)) for i, v in keep]
    by = Counter()
    for _, d, j in final:
        by[j] += d
    top = 2**63 - 1
    return sorted(((i, j, d, min(by[j], top), min(sum(by.values()), top), hashlib.sha256(",".join(map(str, cs[j])).encode()).hexdigest())
                   for i, d, j in final), key=repr)


@pytest.mark.parametrize("scale", [1.0, 3000.0, 1e30])
def test_centroid_clusters(spark, scale):
    rnd = random.Random(5)
    middles = [[rnd.uniform(-1, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i, [m + rnd.gauss(0, 0.1) for m in rnd.choice(middles)]) for i in range(300)]
    rows += [(1000 + i, rows[3][1]) for i in range(200)] + [(7, rows[7][1]), (7, rows[9][1]), (None, rows[8][1])]
    rows = [(i, [x * scale for x in v]) for i, v in rows]
    rows += [(2000, None), (2001, []), (2002, [1.0] * 5), (2003, [1.0] * 5 + [None]), (2004, [float("nan")] * 6),
             (2005, [float("-inf")] * 6), (2006, [0.0] * 6), (2007, [1e38] * 6)]
    df = spark.createDataFrame([(i, v, "n", "k0") for i, v in rows], "vec_id long, embedding array<double>, x string, ids string")
    for k in (8, 1):
        got = centroid_clusters.cluster(df, k, 3, 6, 2, block_rows=16, part_rows=100)
        assert sorted(map(tuple, got.collect()), key=repr) == _kmeans(rows, k, 3, 6, 2)


def test_centroid_clusters_few_or_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    few = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [5.0, 5.0])]
    got = centroid_clusters.cluster(spark.createDataFrame(few, schema), 40, 2, 2)
    assert sorted(map(tuple, got.collect())) == _kmeans(few, 40, 2, 2, 2)
    assert centroid_clusters.cluster(spark.createDataFrame([], schema), 40, 2, 2).count() == 0


def test_hilbert_neighbours_and_box_bounds():
    for dims, bits in ((2, 4), (3, 3)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        keys = centroid_clusters.hilbert_key(cells, bits)
        path = cells[np.lexsort(keys.T[::-1])]
        assert len({k.tobytes() for k in keys}) == len(cells)
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()  # consecutive cells touch
    rng = np.random.default_rng(1)
    x, c = rng.integers(-50, 50, (40, 5)), rng.integers(-80, 80, (9, 5))
    near, far = centroid_clusters.box_bounds(x.min(0), x.max(0), c)
    d = ((x[:, None] - c[None]) ** 2).sum(2)
    assert (near <= d.min(0)).all() and (far >= d.max(0)).all()
    assert set(d.argmin(1)) <= set(centroid_clusters.candidates(x.min(0), x.max(0), c))


# --- conversation repair ----------------------------------------------------------------------

def _every_repair(codes):
    """All sequences of edits with up to two inserts in a gap."""
    best = None
    inserts = ["", "u", "a", "ua", "au"]

    def go(k, audit, cost, said):
        nonlocal best
        for more in inserts:
            a, c, o = audit + "I" * len(more), cost + 5 * len(more), said + more
            if best and c > best[0]:
                continue
            if k == len(codes):
                if re.fullmatch("(s?(ua)+)?", o) and (best is None or (c, a) < best):
                    best = (c, a)
                continue
            initial, fault = conversation_repair._ROW[codes[k]]
            go(k + 1, a + "D", c + 2, o)
            if fault < 2:
                extra = 5 * fault
                go(k + 1, a + "K", c + extra, o + initial)
                go(k + 1, a + "R", c + 1 + extra, o + "u")
                go(k + 1, a + "R", c + 1 + extra, o + "a")
    go(0, "", 0, "")
    return best


def test_parser_against_every_sequence_of_edits():
    rnd = random.Random(3)
    for n in range(200):
        codes = "".join(rnd.choice("abcdefghijkl" if n % 2 else "adgaehg") for _ in range(rnd.randrange(0, 5)))
        assert conversation_repair.repair_codes(codes) == _every_repair(codes), codes


def test_tables_of_pieces_join_to_the_whole():
    rnd = random.Random(4)
    stacks = conversation_repair.STACKS.reachable
    for _ in range(40):
        parts = ["".join(rnd.choice("abdefghjk") for _ in range(rnd.randrange(0, 4))) for _ in range(3)]
        tables = [[(n, t, *b) for n in stacks for t, b in conversation_repair.parse(p, n).items()] for p in parts]
        joined = conversation_repair._joined(conversation_repair._joined(tables[0], tables[1]), tables[2])
        front = {exit_: (cost, audit) for entry, exit_, cost, audit in joined if entry == 0}
        assert conversation_repair.ended(front) == conversation_repair.repair_codes("".join(parts))


def _repair_all(rows):
    """The contract said plainly: damage, faults, cheapest edits, digests. [(conv, turn, role, text)] -> sorted rows"""
    blank = " \t\n\x0b\x0c\r"
    show = lambda v: " " if v is None else str(v)
    convs: dict = {}
    for conv, turn, role, text in rows:
        role, text = show(role), show(text)
        k = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        mine = convs.setdefault(conv, [])
        if k:
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            mine += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    out = []
    for conv, mine in convs.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        codes, seen, n = "", set(), Counter()
        for _, role, text in mine:
            core = text.strip(blank)
            fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else ""
            seen.add((role, text))
            n[fault] += 1
            initial = role[:1] if role[:1] in ("s", "u", "a") else "?"
            codes += conversation_repair._CODE[initial, {"": 0, "truncated": 1}.get(fault, 2)]
        n["illegal"] = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(mine))
        cost, audit = conversation_repair.ended(conversation_repair.parse(codes))
        left, said, odd = list(mine), [], (len(audit) - audit.count("D")) % 2
        for edit in audit:
            row = None if edit == "I" else left.pop(0)
            if edit != "D":
                role = row[1] if edit == "K" else ("user", "assistant")[(len(said) - odd) % 2]
                said.append((role, "" if edit == "I" else row[2]))
        turns = {t for t, _, _ in mine} - {None}
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, n["blank"], n["duplicate"], n["truncated"],
                    n["illegal"], cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest(), said))
    return sorted(out, key=repr)


def _conversations():
    rnd = random.Random(9)
    texts = ["Hello there.", "What is it?", "no end", "", " \t", None, "Done!", "A\nB.", "x" * 3000 + ".", "é?"]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", None, "", "User"]
    rows = [(c, t if rnd.random() > 0.05 else None, rnd.choice(roles), rnd.choice(texts) if rnd.random() < 0.5 else f"Text {t}.")
            for c in range(60) for t in range(rnd.randrange(1, 9))]
    rows += [(777, t, "user" if t % 2 else "assistant", f"Turn {t % 40}{'.' if t % 3 else ''}") for t in range(-20, 330)]
    rows += [(888, 1, "user", "Same.")] * 90 + [(None, t, "user", f"q {t}?") for t in range(9)] + [(None, None, None, None)] * 3
    dropped = [t for t in range(400) if zlib.crc32(f"999:{t}".encode()) % 20 == 0]
    return rows + [(999, t, "user", "gone.") for t in dropped]


@pytest.mark.parametrize("piece_rows", [4, 1024])
def test_conversation_repair(spark, piece_rows):
    rows = _conversations()
    df = spark.createDataFrame([(*r, "p", "k") for r in rows],
                               "conv_id long, turn long, role string, text string, piece string, keys string").repartition(5)
    damaged = conversation_repair.damage(df)
    want = _repair_all(rows)
    got = conversation_repair.repair(damaged, gone_col="gone", piece_rows=piece_rows)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == [r[:-1] for r in want]
    said = conversation_repair.repaired_messages(damaged, gone_col="gone", piece_rows=piece_rows).collect()
    assert sorted(((r["conv_id"], r["position"], r["role"], r["text"]) for r in said), key=repr) == sorted(
        ((w[0], k, *m) for w in want for k, m in enumerate(w[-1])), key=repr)


def test_conversation_repair_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversation_repair.repair(conversation_repair.damage(empty), gone_col="gone").count() == 0
    assert conversation_repair.repaired_messages(empty).count() == 0


# --- text ids, ties ---------------------------------------------------------------------------

def test_substring_dedup_orders_text_ids(spark):
    passage = "".join(random.Random(8).choices("abcdefgh", k=150))
    rows = [("b10", "x" + passage), ("b9", "yy" + passage), ("a", "zzz" + passage), (None, passage + "!"), ("e", None), ("e", "")]
    df = spark.createDataFrame(rows, "doc_id string, text string").repartition(3)
    got = {(r["doc_id"], r["n_bytes"]): bytes(r["kept"]).decode() for r in substring_dedup.substring_dedup(df).collect()}
    first = (None, 151)  # null comes before every other
    want = {(i, len(t or "")): (t or "") if (i, len(t or "")) == first else (t or "").replace(passage, "") for i, t in rows}
    assert got == want


def test_simhash_ties_stay_once_in_a_fixed_order(spark):
    rows = [(1, "one two three four", "web"), (1, "one two three four", "book"), (2, "one two three four", "a"),
            (3, "quite another text here", "c"), (3, "quite another text here", "c")]
    for n in (1, 4):
        df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(n)
        assert sorted(map(tuple, simhash_dups.apply_simhash(df).collect())) == [
            (1, "one two three four", "book"), (3, "quite another text here", "c")]
