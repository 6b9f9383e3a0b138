"""Readers (S1-S14). All take a path/URI that Hadoop understands (local, HDFS, s3a, ...).

Schemas are declared, never inferred, so a scan only reads the columns a query
needs and ids stay strings.
"""

from __future__ import annotations

import csv
import io
import urllib.parse

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.sources import schemas
from skein.sources.json_arrays import read_elements

#: Bytes of a CSV file read at once to find its header.
HEAD = 1 << 16


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath)) or len(fs.globStatus(hpath) or []) > 0


def empty(spark: SparkSession, ddl: str) -> DataFrame:
    return spark.createDataFrame([], schemas.struct_type(ddl))


def read_json_array(spark: SparkSession, path: str, ddl: str, strict: bool = False) -> DataFrame:
    """Files holding one top-level JSON array each; a missing path is an empty
    collection (``strict`` raises instead, as the older twins do).

    A file is read by as many tasks as it has blocks (``json_arrays``). Elements that are no objects give null rows,
    as Spark's reader of whole files does.
    """
    if not path_exists(spark, path):
        if strict:
            raise FileNotFoundError(path)
        return empty(spark, ddl)
    return read_elements(spark, path).select(F.from_json("text", schemas.struct_type(ddl)).alias("r")).select("r.*")


def read_ragged_json(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Arrays whose elements are objects, arrays of objects, or junk.

    One level of nesting is flattened, empty inner arrays vanish and non-object
    elements are dropped. ``file``, ``pos`` and ``sub`` keep the landing order
    (keep-first rules downstream need it).
    """
    if not path_exists(spark, path):
        return empty(spark, ddl).withColumns({"file": F.lit(None).cast("string"),
                                              "pos": F.lit(None).cast("int"), "sub": F.lit(None).cast("int")})
    top = read_elements(spark, path).select("file", F.col("pos").cast("int").alias("pos"), F.col("text").alias("e"))
    nested = top.filter(F.startswith(F.ltrim("e"), F.lit("["))).select(
        "file", "pos", F.posexplode(F.from_json("e", "array<string>")).alias("sub", "e"))
    flat = top.filter(F.startswith(F.ltrim("e"), F.lit("{"))).select("file", "pos", F.lit(0).alias("sub"), "e") \
        .unionByName(nested.filter(F.startswith(F.ltrim("e"), F.lit("{"))))
    return flat.select(F.from_json("e", schemas.struct_type(ddl)).alias("r"), "file", "pos", "sub") \
        .select("r.*", "file", "pos", "sub")


def read_network(spark: SparkSession, path: str) -> DataFrame:
    """S3: root documents (root > posts > retweeters, root > followers), with their place in the landed files
    (``file``, ``pos``), which orders them alike for any split of the files."""
    if not path_exists(spark, path):
        return empty(spark, f"{schemas.NET_ROOT}, file STRING, pos BIGINT")
    return read_elements(spark, path).select(F.from_json("text", schemas.struct_type(schemas.NET_ROOT)).alias("r"), "file", "pos") \
        .select("r.*", "file", "pos")


def csv_heads(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, names): the header of every CSV file; a task reads a file's first bytes only. A file without a record
    (empty, or blank lines) has no names."""
    from skein.session import ship_code
    from skein.sources.objects import file_system

    def run(batches):
        for batch in batches:
            out = []
            for uri in batch.column(0).to_pylist():
                fs, name = file_system(urllib.parse.unquote(uri))
                with fs.open_input_stream(name) as f:
                    data = f.read(HEAD)
                    # the first record ends at the first line end outside quotes, blank lines before it do not count
                    while (end := _record_end(data)) is None and (more := f.read(HEAD)):
                        data += more
                text = data[:end].decode("utf-8-sig", "replace").strip("\r\n")
                out.append(next(csv.reader(io.StringIO(text)), []))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.string()))], ["file", "names"])

    ship_code(spark)
    files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("file"))
    return files.mapInArrow(run, "file STRING, names ARRAY<STRING>")


def _record_end(data: bytes) -> int | None:
    lead = len(data) - len(data.removeprefix(b"\xef\xbb\xbf").lstrip(b"\r\n"))
    at = lead
    while (at := min((i for i in (data.find(b"\n", at), data.find(b"\r", at)) if i >= 0), default=-1)) >= 0:
        if data.count(b'"', lead, at) % 2 == 0:
            return at
        at += 1
    return None


def read_csv(spark: SparkSession, path: str | list[str], ddl: str) -> DataFrame:
    """Header CSV, columns taken by header name (any order, extra columns ignored,
    missing ones null, the first of equal names) and cast to the declared types; a UTF-8 byte-order mark is
    stripped. Files of one folder may have different headers.

    The data are scanned once, by position; the headers come from the files' first bytes. Files that all have
    one header need nothing else; else each row meets its file's header in a join on the file. No file name
    passes through the driver beyond Spark's own listing.
    """
    from skein.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    fields = schemas.struct_type(ddl).fields
    heads = csv_heads(spark, path).filter(F.size("names") > 0).checkpoint()
    kinds = heads.select("names").distinct().limit(2).collect()
    if not kinds:
        return empty(spark, ddl)
    width = heads.agg(F.max(F.size("names"))).first()[0]
    raw = spark.read.schema(T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)])) \
        .option("header", True).option("enforceSchema", True).option("multiLine", True).option("escape", '"').csv(path)
    if len(kinds) == 1:
        at = {n: i for i, n in reversed(list(enumerate(kinds[0]["names"])))}
        return raw.select(*[(F.col(f"_c{at[f.name]}") if f.name in at else F.lit(None)).cast(f.dataType).alias(f.name)
                            for f in fields])
    cells = raw.select(F.col("_metadata.file_path").alias("file"), F.array(*raw.columns).alias("cells")).join(heads, "file")

    def cell(name):
        at = F.array_position("names", F.lit(name))
        return F.when(at > 0, F.get("cells", (at - 1).cast("int")))

    return cells.select(*[cell(f.name).cast(f.dataType).alias(f.name) for f in fields])


def select_files(df: DataFrame, look: list[str], avoid: list[str] | None = None) -> DataFrame:
    """Keep rows whose source file name contains every ``look`` token and no ``avoid`` token."""
    name = F.col("_metadata.file_name")
    cond = F.lit(True)
    for t in look:
        cond = cond & F.contains(name, F.lit(t))
    for t in avoid or []:
        cond = cond & ~F.contains(name, F.lit(t))
    return df.filter(cond)


def read_dated(spark: SparkSession, root: str, ddl: str, dates: Column | str | None = None) -> DataFrame:
    """One folder per run date (``run_date=YYYY-MM-DD``) -> a partition column (pruned by filters).

    A task reads whole files. With ``dates``, a condition on ``run_date``, large files are read by blocks (S1): only files
    of those dates are opened, whatever is filtered later.
    """
    if dates is None:
        return spark.read.option("multiLine", True).schema(
            T.StructType(schemas.struct_type(ddl).fields + [T.StructField("run_date", T.DateType())])).json(root)
    day = F.regexp_extract("file", r"/run_date=(\d{4}-\d{2}-\d{2})/", 1).cast("date")
    return read_elements(spark, root, dates).select(F.from_json("text", schemas.struct_type(ddl)).alias("r"), day.alias("run_date")) \
        .select("r.*", "run_date")


def read_text_objects(spark: SparkSession, prefix: str) -> DataFrame:
    """``networks/{location}/classification/{user}/input/{name}.txt`` objects, or the table
    that K7 writes -> (location, user_id, name, value). An empty object has the empty text; one that
    cannot be read fails the job rather than vanish."""
    if path_exists(spark, f"{prefix.rstrip('/')}/_SUCCESS"):
        return spark.read.parquet(prefix).select("location", "user_id", "name", F.coalesce("value", F.lit("")).alias("value"))
    from skein.sources.objects import listing, read_objects
    rx = r"^([^/]+)/classification/([^/]+)/input/([^/]+)\.txt$"
    files = listing(spark, prefix).filter(F.col("relative").rlike(rx))
    return read_objects(files).select(F.regexp_extract("relative", rx, 1).alias("location"),
                                      F.regexp_extract("relative", rx, 2).alias("user_id"),
                                      F.regexp_extract("relative", rx, 3).alias("name"), "value")


def read_processed_ids(spark: SparkSession, path: str, fmt: str = "parquet", key: str = "user_id") -> DataFrame:
    """Ids already present in an output (empty when the output does not exist)."""
    if not path_exists(spark, path):
        return empty(spark, f"{key} STRING")
    return spark.read.format(fmt).load(path).select(key).distinct()


def land_pages(pages: list[DataFrame], key: str | list[str], page_col: str = "page", pos_col: str = "pos") -> DataFrame:
    """S11 + D5/D6: union landed result pages; the last page wins per id, the first record inside a page."""
    from skein.operators.dedupe import merge_pages, union_files
    return merge_pages(union_files(pages), key, page_col, pos_col)


def read_labelled(spark: SparkSession, path: str) -> DataFrame:
    """The labelled sample sheet (CSV export)."""
    return read_csv(spark, path, schemas.LABELLED)


def list_members(lists: DataFrame, members: DataFrame) -> DataFrame:
    """Members of each distinct non-null list id."""
    ids = lists.select("list_id").filter(F.col("list_id").isNotNull()).distinct()
    return members.join(ids, "list_id", "inner")


def list_memberships(users: DataFrame, memberships: DataFrame) -> DataFrame:
    """The lists of each user; users without lists are skipped."""
    return users.select("user_id").join(memberships, "user_id", "inner")
