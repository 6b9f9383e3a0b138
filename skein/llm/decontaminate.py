"""Benchmark decontamination: prefix-filtered set join with exact verification.

A window is ``window`` consecutive words of a benchmark item (a shorter item is one window). Seen as
a set of word shingles, a window is contained in a document only if all its shingles are, so one
shingle is a necessary prefix; the rarest in the corpus is taken. Documents meet windows by an
equi-join on that shingle's hash; the shingle's place in the window fixes the only place where the window can
start; windows that would leave the matched run there are cut by position and length; the words
are then compared exactly.

Scale: one pass over the texts emits, for each document, its runs of words whose shingles may be
benchmark shingles. The test is a bit array of fixed size (``2**FILTER_BITS`` bits, whatever the
size of the benchmark); it lets all true shingles pass, false ones are removed by the join. Only
these runs are stored and shuffled, never whole texts. The join's benchmark side is broadcast by
Spark only under its own size threshold; beyond, it is a sort-merge join whose hot keys adaptive
execution splits.

Defined results: a null or empty text has no words, no hits, and is not contaminated. A benchmark
item without words has no window. Rows that repeat an item id are one item; a null item id counts as
the empty id. Repeated documents are judged each by itself. An empty benchmark hits nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.llm import common

WINDOW = 13
SHINGLE = 5
FILTER_BITS = 26
#: Contaminated if 20 times the hit words reach the words.
PER_WORD = 20

_WORDS = bytes(b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def normalise(text: bytes) -> bytes:
    """A-Z lower-cased, every byte that is not part of a word a blank."""
    return text.lower().translate(_WORDS)


def _word_hashes(blob: bytes):
    data = np.frombuffer(blob, np.uint8)
    starts, ends = common.word_spans(data)
    return starts, ends, common.mix(common.Prefix(data).raw(starts, ends)) if len(starts) else np.zeros(0, np.uint64)


def item_windows(benchmark: DataFrame, id_col: str, text_col: str, window: int, shingle: int) -> DataFrame:
    """(item, wtext, len, width, hs): every distinct window of every item with its shingle hashes."""

    def run(batches):
        for batch in batches:
            out = []
            for item, text in zip(batch.column(0).to_pylist(), common.as_bytes(batch.column(1)), strict=True):
                blob = normalise(text or b"")
                words = blob.split()
                if not words:
                    continue
                size = min(window, len(words))
                width = min(shingle, size)
                h = common.windows(_word_hashes(blob)[2], width).view(np.int64).tolist()
                for i in range(len(words) - size + 1):
                    out.append((item, b" ".join(words[i:i + size]).decode(), size, width, h[i:i + size - width + 1]))
            cols = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int32()),
                 pa.array(cols[3], pa.int32()), pa.array(cols[4], pa.list_(pa.int64()))],
                ["item", "wtext", "len", "width", "hs"])

    return (benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                             F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, "item string, wtext string, len int, width int, hs array<long>").distinct())


def _runs_of(docs: DataFrame, id_col: str, text_col: str, widths: list[int], bitmap, bits: int) -> DataFrame:
    """(doc_id, thash, n_words, runs): runs of words under shingles that pass the bit array."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("thash"),
                         F.col(text_col).cast("string").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)
    hit = pa.struct([("h", pa.int64()), ("pos", pa.int32())])
    run_type = pa.list_(pa.struct([("start", pa.int32()), ("words", pa.list_(pa.string())), ("hits", pa.list_(hit))]))

    def runs(texts):
        blob = b" ".join(normalise(t or b"") for t in texts)
        sizes = np.array([len(t) if t else 0 for t in texts], np.int64)
        begin = np.concatenate([[0], np.cumsum(sizes + 1)])[:len(texts)]
        starts, ends, word = _word_hashes(blob)
        of = np.searchsorted(begin, starts, "right") - 1
        first = np.searchsorted(of, np.arange(len(texts)))
        counts = np.bincount(of, minlength=len(texts))
        found = [[] for _ in texts]
        hits = []
        for width in widths:
            h = common.windows(word, width)
            ok = common.in_filter(shared.value, h, bits) & (of[:len(h)] == of[width - 1:])
            at = np.flatnonzero(ok)
            hits += zip(at.tolist(), (at + width).tolist(), h[at].view(np.int64).tolist(), strict=True)
        hits.sort()
        i = 0
        while i < len(hits):
            lo, hi, j = hits[i][0], hits[i][1], i + 1
            doc = int(of[lo])
            while j < len(hits) and hits[j][0] <= hi and of[hits[j][0]] == doc:
                hi = max(hi, hits[j][1])
                j += 1
            base = int(first[doc])
            found[doc].append({
                "start": lo - base,
                "words": [blob[s:e].decode() for s, e in zip(starts[lo:hi].tolist(), ends[lo:hi].tolist(), strict=True)],
                "hits": [{"h": h, "pos": p - base} for p, _, h in hits[i:j]]})
            i = j
        return counts, found

    def run(batches):
        for batch in batches:
            counts, found, done = [], [], 0
            for _, texts in common.slices([batch.select(["text"])], 0):
                c, f = runs(texts)
                counts += c.tolist()
                found += f
                done += len(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(found, run_type)],
                ["doc_id", "thash", "n_words", "runs"])

    return narrow.mapInArrow(run, f"doc_id {kind}, thash long, n_words long, runs array<struct<start:int,"
                                  "words:array<string>,hits:array<struct<h:long,pos:int>>>>")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", filter_bits: int = FILTER_BITS) -> DataFrame:
    """One row per document row: doc_id, thash (hash of its text), n_words, n_hit, items (sorted ids),
    contaminated."""
    spark = docs.sparkSession
    common.prepare(spark)
    wins = common.materialise(item_windows(benchmark, item_col, item_text_col, window, shingle))
    widths = sorted(r["width"] for r in wins.select("width").distinct().collect())  # at most `shingle` rows
    h = F.explode("hs").alias("h")
    at = F.shiftrightunsigned("h", 64 - filter_bits)
    # at most 2**(filter_bits - 6) rows, whatever the size of the benchmark
    words = (wins.select(h).select(F.shiftright(at, 6).alias("i"), F.expr("shiftleft(1L, cast(%s as int))" % (
        f"shiftrightunsigned(h, {64 - filter_bits}) & 63")).alias("v"))
             .groupBy("i").agg(F.bit_or("v").alias("v")).collect())
    bitmap = common.bit_filter(((r["i"], r["v"]) for r in words), filter_bits)
    base = common.materialise(_runs_of(docs, id_col, text_col, widths, bitmap, filter_bits))
    base = base.withColumn("row", F.monotonically_increasing_id())  # stable: the frame is stored

    hits = (base.filter(F.size("runs") > 0).select("row", F.explode("runs").alias("run"))
            .select("row", F.col("run.start").alias("start"), F.col("run.words").alias("words"),
                    F.explode("run.hits").alias("hit"))
            .select("row", "start", "words", F.col("hit.h").alias("h"), F.col("hit.pos").alias("pos")))
    # rarity in the corpus of every benchmark shingle; a window with an absent shingle occurs nowhere
    rarity = hits.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    texts = wins.select("wtext", "len", "hs").distinct()
    prefix = (texts.select("wtext", "len", F.posexplode("hs").alias("off", "h"))
              .join(rarity, "h", "left")
              .groupBy("wtext", "len").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "h", "off")).alias("p"))
              .filter(F.col("p.n") > 0)
              .select(F.col("p.h").alias("h"), F.col("p.off").alias("off"), "len", "wtext"))
    prefix = common.materialise(prefix)
    at_word = F.col("pos") - F.col("off")
    near = F.slice("words", F.greatest(F.lit(1), F.col("pos") - F.col("start") + 2 - window), 2 * window)
    found = (hits.select("row", "h", "pos", near.alias("words"),
                         F.greatest("start", F.col("pos") + 1 - window).alias("start"))
             .join(prefix, "h")
             .filter((at_word >= F.col("start"))
                     & (at_word + F.col("len") <= F.col("start") + F.size("words")))
             .filter(F.array_join(F.slice("words", at_word - F.col("start") + 1, F.col("len")), " ") == F.col("wtext"))
             .select("row", at_word.alias("at"), "len", F.xxhash64("wtext").alias("wid"), "wtext"))
    found = common.materialise(found)

    before = Window.partitionBy("row").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("at") + F.col("len")
    covered = (found.groupBy("row", "at").agg(F.max("len").alias("len"))
               .withColumn("seen", F.max(end).over(before))
               .groupBy("row").agg(F.sum(F.greatest(
                   F.lit(0), end - F.greatest("at", F.coalesce("seen", "at")))).cast("long").alias("n_hit")))
    items = (found.select("row", "wtext").distinct()
             .join(wins.select("wtext", "item").distinct(), "wtext")
             .groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items")))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return (base.select("row", "doc_id", "thash", "n_words").join(covered, "row", "left").join(items, "row", "left")
            .select("doc_id", "thash", "n_words", n_hit.alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                    ((n_hit > 0) & (PER_WORD * n_hit >= F.col("n_words"))).alias("contaminated")))


def apply_decontamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The input's rows that are not contaminated, all columns."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    bad = (decontaminate(docs, benchmark, **options).filter("contaminated")
           .select(F.col("doc_id").alias("__id"), F.col("thash").alias("__thash")).distinct())
    bad = common.materialise(bad)
    return docs.join(bad, docs[id_col].eqNullSafe(bad["__id"])
                     & (F.xxhash64(docs[text_col].cast("string")) == bad["__thash"]), "left_anti")


def op7_decontaminate(spark, sf_dir: str) -> DataFrame:
    found = decontaminate(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def _words_sql(column: str) -> str:
    return (f"regexp_extract_all(translate(coalesce({column}, ''), '{common.UPPER}', '{common.UPPER.lower()}'), "
            r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


OP7_SQL = f"""
WITH i AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_words_sql('text')} AS w FROM benchmark),
wi AS (SELECT DISTINCT item, least({WINDOW}, len(w)) AS n,
              array_to_string(w[p:p + least({WINDOW}, len(w)) - 1], ' ') AS t
       FROM (SELECT *, unnest(range(1, len(w) - least({WINDOW}, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)),
d AS (SELECT row_number() OVER () AS r, doc_id, {_words_sql('text')} AS w FROM documents),
dw AS (SELECT r, n, p, array_to_string(w[p:p + n - 1], ' ') AS t
       FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p
             FROM d, (SELECT DISTINCT n FROM wi) AS k WHERE len(w) >= n)),
hit AS (SELECT DISTINCT r, p, dw.n, item FROM dw JOIN wi ON wi.n = dw.n AND wi.t = dw.t),
pos AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM hit) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
        FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       (coalesce(n_hit, 0) > 0 AND {PER_WORD} * coalesce(n_hit, 0) >= len(w)) AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN its USING (r)"""
