"""Line dedup: drop lines whose normalised key occurs in too many documents.

Lines are exploded, normalised and hashed; distinct documents are counted per hash; lines of a hash
at or over the threshold are dropped from every document; the rest is reassembled by position.

Scale: only 128-bit line hashes are shuffled for the count (document by hash, then hash, both with
map-side combining, so a line found in a third of all documents arrives as one partial count per
task). The text is shuffled once, to meet its document's list of dropped hashes. The join of
(document, hash) pairs with the frequent hashes is a plain equi-join of narrow rows: adaptive
execution splits a hot hash on its large side, and the frequent side has one row per hash.

Defined results: a null or empty text is one empty line. Documents are told apart by their id: rows
that repeat an id count once per key, rows with a null id count together as one document. A row of
the result stands for each input row, repeated rows included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm import common


def line_key(line: Column) -> Column:
    """Both ends stripped of white space, A-Z lower-cased."""
    return F.translate(F.trim(line, F.lit(common.BLANKS)), common.UPPER, common.UPPER.lower())


def _hash(key: Column) -> Column:
    """128 bits of a key as two longs."""
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.concat(F.lit("\x01"), key)).alias("b"))


def _split(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def frequent_lines(docs: DataFrame, min_docs: int, min_chars: int = 1, id_col: str = "doc_id",
                   text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(distinct document-hash pairs, hashes found in at least ``min_docs`` documents)."""
    keys = F.transform(_split(F.col("text")), line_key)
    pairs = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
             .select("id", F.explode(F.array_distinct(F.transform(
                 F.filter(keys, lambda k: F.char_length(k) >= min_chars), _hash))).alias("h"))
             .select("id", "h.a", "h.b").distinct())
    frequent = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_docs)
    return pairs, frequent.select("a", "b")


def line_dedup(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """The input's columns with the text cleaned, plus ``n_lines`` and ``n_dropped``.

    Columns of these two names in the input are replaced.
    """
    common.prepare(docs.sparkSession)
    pairs, frequent = frequent_lines(docs, min_docs, min_chars, id_col, text_col)
    dropped = (pairs.join(frequent, ["a", "b"], "left_semi")
               .groupBy(F.col("id").alias("__id"))
               .agg(F.collect_list(F.concat_ws(":", "a", "b")).alias("__drop")))
    base = docs.drop("n_lines", "n_dropped", "__id", "__drop")
    cols = base.columns
    joined = base.join(dropped, base[id_col].eqNullSafe(dropped["__id"]), "left").drop("__id")
    return _reassemble(joined, cols, text_col, min_chars)


def _reassemble(joined: DataFrame, cols: list[str], text_col: str, min_chars: int) -> DataFrame:
    """Remove the dropped lines of each row and join the others in their order."""
    import pyarrow as pa
    import pyspark.sql.types as T
    import xxhash

    at = cols.index(text_col)
    schema = T.StructType([*[joined.schema[c] if c != text_col else T.StructField(c, T.StringType()) for c in cols],
                           T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    blanks = common.BLANKS.encode()

    def signed(x: int) -> int:
        return x - (1 << 64) if x >> 63 else x

    def clean(batches):
        for batch in batches:
            texts = common.as_bytes(batch.column(at).cast(pa.string()))
            drops = batch.column(len(cols))
            kept, lines_n, dropped_n = [], [], []
            for i, text in enumerate(texts):
                lines = (text or b"").split(b"\n")
                lines_n.append(len(lines))
                drop = drops[i].as_py()
                if drop:
                    bad = set(drop)
                    stay = []
                    for line in lines:
                        key = line.strip(blanks).lower()
                        name = (f"{signed(xxhash.xxh64_intdigest(key, 42))}:"
                                f"{signed(xxhash.xxh64_intdigest(b'\x01' + key, 42))}")
                        if name not in bad:
                            stay.append(line)
                    dropped_n.append(len(lines) - len(stay))
                    kept.append(b"\n".join(stay).decode("utf-8"))
                else:
                    dropped_n.append(0)
                    kept.append((text or b"").decode("utf-8"))
            arrays = [batch.column(i) for i in range(len(cols))]
            arrays[at] = pa.array(kept, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(lines_n, pa.int64()), pa.array(dropped_n, pa.int64())],
                [*cols, "n_lines", "n_dropped"])

    return joined.select(*cols, "__drop").mapInArrow(clean, schema)


# --- registered query -------------------------------------------------------------------------

MIN_DOCS = 10


def op2_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs, MIN_DOCS).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


_BLANKS_SQL = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
OP2_SQL = f"""
WITH l AS (
  SELECT doc_id, n_lines, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines,
               len(string_split(coalesce(text, ''), chr(10))) AS n_lines FROM documents)),
k AS (SELECT *, translate(trim(line, {_BLANKS_SQL}), '{common.UPPER}', '{common.UPPER.lower()}') AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
m AS (SELECT k.*, f.key IS NOT NULL AS gone FROM k LEFT JOIN f ON f.key = k.key)
SELECT doc_id, any_value(n_lines)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id"""
