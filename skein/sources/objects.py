"""Files as rows: text objects in the layout that other programs read (K7), listings (S5, S7) and tree synchronisation.

Tasks open, write and copy files through ``pyarrow.fs`` (local, ``hdfs``, ``s3``, ``gs`` URIs), so nothing passes through the
driver. An object is written under a temporary name and moved into place, so that a task that dies or runs twice leaves whole
objects only; the commit step then records how many there are.
"""

from __future__ import annotations

import json
import posixpath
import re
import uuid
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from skein.session import ship_code, stored
from skein.sources import schemas
from skein.sources.json_arrays import read_elements
from skein.sources.readers import empty

OBJECT = "location STRING, user_id STRING, name STRING, value STRING"
#: Bytes copied at once.
CHUNK = 4 << 20
#: Folders that a writing task remembers at most, so as not to create them again.
KNOWN = 1 << 16


def file_system(uri: str):
    """(file system, path) of a URI; a plain path is local."""
    from pyarrow import fs
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    uri = re.sub(r"^s3[an]://", "s3://", uri)
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def object_path(location: str, user_id: str, name: str) -> str:
    """``{location}/classification/{user}/input/{name}.txt``; a name that would leave its folder is an error."""
    for part in (location, user_id, name):
        if not part or "/" in part or part in (".", ".."):
            raise ValueError(f"not the name of an object: {part!r}")
    return f"{location}/classification/{user_id}/input/{name}.txt"


class _Written(WriterCommitMessage):
    def __init__(self, objects: int):
        self.objects = objects


class _ObjectWriter(DataSourceWriter):
    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")

    def write(self, rows):
        fs, base = file_system(self.path)
        known, n = set(), 0
        for location, user_id, name, value in rows:
            path = f"{base}/{object_path(location, user_id, name)}"
            folder = posixpath.dirname(path)
            if folder not in known:
                fs.create_dir(folder, recursive=True)
                if len(known) >= KNOWN:
                    known.clear()
                known.add(folder)
            draft = f"{folder}/.{uuid.uuid4().hex}"
            with fs.open_output_stream(draft) as out:
                out.write((value or "").encode("utf-8", "ignore"))
            fs.move(draft, path)
            n += 1
        return _Written(n)

    def commit(self, messages):
        fs, base = file_system(self.path)
        fs.create_dir(base, recursive=True)
        with fs.open_output_stream(f"{base}/_objects-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps({"objects": sum(m.objects for m in messages if m)}).encode())

    def abort(self, messages):
        """Objects in place are whole and are written again by the retry."""


class TextObjects(DataSource):
    """``df.write.format("text_objects").save(path)`` for (location, user_id, name, value) rows."""

    @classmethod
    def name(cls) -> str:
        return "text_objects"

    def schema(self) -> str:
        return OBJECT

    def writer(self, schema, overwrite) -> DataSourceWriter:
        return _ObjectWriter(self.options)


def write_object_files(objects: DataFrame, path: str) -> None:
    """K7: one UTF-8 ``.txt`` per object at ``path/{location}/classification/{user}/input/{name}.txt``. An object written again
    is replaced; rows that name the same object must agree.

    A file costs the same whatever it holds, so objects are dealt over the tasks by number: the splits of a small table, or
    parts merged by their bytes, leave hundreds of thousands of short objects to one task."""
    spark = objects.sparkSession
    ship_code(spark)
    spark.dataSource.register(TextObjects)
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    objects.select("location", "user_id", "name", F.coalesce("value", F.lit("")).alias("value")) \
        .repartition(tasks, "location", "user_id", "name") \
        .write.format("text_objects").mode("append").save(path)


# --------------------------------------------------------------------------- listings
#: Folders opened one level at a time; of more, each is listed whole, with all below it.
FOLDERS = 256
#: Rows of a batch at most.
ROWS = 1 << 16


def _entries(spark: SparkSession, folders: DataFrame, n: int, root: str, recursive: bool) -> DataFrame:
    """(path, length) of what ``n`` folders hold, dealt over the tasks; a folder has no length. Names that begin with ``.`` or
    ``_`` and what is below them are left out."""
    from pyarrow import fs as pf

    def run(batches):
        fs, base = file_system(root.rstrip("/"))
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                entries = fs.get_file_info(pf.FileSelector(folder, recursive=recursive))
                for at in range(0, len(entries), ROWS):
                    kept = [(e.path, e.size if e.type == pf.FileType.File else None) for e in entries[at:at + ROWS]
                            if e.type == pf.FileType.File or (e.type == pf.FileType.Directory and not recursive)]
                    kept = [(p, n) for p, n in kept if not re.search(r"(^|/)[._]", p[len(base):].lstrip("/"))]
                    yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in kept], pa.string()),
                                                      pa.array([n for _, n in kept], pa.int64())], ["path", "length"])

    tasks = max(spark.sparkContext.defaultParallelism, n // 1024)
    return folders.repartition(tasks).mapInArrow(run, "path STRING, length BIGINT")


def listing(spark: SparkSession, root: str) -> DataFrame:
    """(path, relative, name, length) of every file below a folder, empty ones too (names that begin with ``.`` or ``_`` are
    not of the tree); no file is opened. Tasks list the folders, level by level until there are enough to deal out, and the
    names stay with them: a level may hold a folder per user, so the driver only counts."""
    from pyarrow import fs as pf
    ddl = "path STRING, relative STRING, name STRING, length BIGINT"
    fs, base = file_system(root.rstrip("/"))
    if fs.get_file_info(base).type == pf.FileType.NotFound:
        return empty(spark, ddl)
    ship_code(spark)
    scheme = re.match(r"(file:|\w+://[^/]*(?=/)|)", root)[0] if not re.match(r"(s3\w?|gs)://", root) else root.split("//")[0] + "//"
    folders, n, found = spark.createDataFrame([(base,)], "path STRING"), 1, []
    while 0 < n < FOLDERS:
        level = stored(_entries(spark, folders, n, root, False), "listing")
        found.append(level.filter(F.col("length").isNotNull()))
        folders = level.filter(F.col("length").isNull()).select("path")
        n = folders.count()
    if n:
        found.append(_entries(spark, folders, n, root, True))
    relative = F.ltrim(F.substr("path", F.lit(len(base) + 1)), F.lit("/"))
    return reduce(DataFrame.unionByName, found).select(
        F.concat(F.lit(scheme), "path").alias("path"), relative.alias("relative"),
        F.substring_index(relative, "/", -1).alias("name"), "length")


def read_objects(files: DataFrame) -> DataFrame:
    """The listed files with their whole content as text (``value``)."""
    columns = files.columns

    def run(batches):
        for batch in batches:
            values = []
            for path in batch.column(columns.index("path")).to_pylist():
                fs, name = file_system(path)
                with fs.open_input_stream(name) as f:
                    values.append(f.read().decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.string())], [*columns, "value"])

    ship_code(files.sparkSession)
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in files.schema.fields)
    return files.mapInArrow(run, f"{ddl}, value STRING")


#: What the parts of a collected file's name say about it (fixed names of the landed files).
FAMILIES = {"users": (["users", "filtered"], ["expanded"]), "lists": (["list"], []), "expanded": (["expanded", "filtered"], [])}


def _named(name: Column, look: list[str], avoid: list[str]) -> Column:
    low = F.lower(name)
    cond = F.lit(True)
    for t in look:
        cond = cond & F.contains(low, F.lit(t.lower()))
    for t in avoid:
        cond = cond & ~F.contains(low, F.lit(t.lower()))
    return cond


def catalogue(spark: SparkSession, root: str, cities: list[str]) -> DataFrame:
    """The listing with what each name says: ``cities`` (those it contains, spaces as ``_``), one flag per kind of file
    and the ending. Readers choose their paths from it before any file is opened."""
    name = F.lower("relative")
    has = F.filter(F.array(*[F.lit(c.lower()) for c in cities]).cast("array<string>"),
                   lambda c: F.contains(name, c) | F.contains(name, F.replace(c, F.lit(" "), F.lit("_"))))
    return listing(spark, root).select(
        "*", has.alias("cities"), *[_named(F.col("relative"), *rule).alias(f"is_{kind}") for kind, rule in FAMILIES.items()],
        F.lower(F.regexp_extract("name", r"\.([^.]+)$", 1)).alias("ending"))


def select_paths(files: DataFrame, condition: Column | str, strict: bool = False) -> list[str]:
    """Paths of the listed files that fit (what a reader opens: one name per file); ``strict`` raises when none does."""
    paths = [r["path"] for r in files.filter(condition).select("path").orderBy("path").collect()]
    if strict and not paths:
        raise FileNotFoundError("no file fits")
    return paths


def read_city_files(spark: SparkSession, root: str, city: str, kind: str, ddl: str, strict: bool = False) -> DataFrame:
    """A city's files of one kind (``users``, ``lists``, ``expanded``), chosen by name from the catalogue; other files are
    not opened. Nothing fitting gives no rows, or with ``strict`` an error. Files are read by blocks, as S1 does."""
    files = catalogue(spark, root, [city])
    paths = select_paths(files, (F.size("cities") > 0) & F.col(f"is_{kind}"), strict)
    if not paths:
        return empty(spark, f"{ddl}, file_name STRING")
    return read_elements(spark, paths).select(F.from_json("text", schemas.struct_type(ddl)).alias("r"), "file") \
        .select("r.*", F.url_decode(F.replace(F.substring_index("file", "/", -1), F.lit("+"), F.lit("%2B"))).alias("file_name"))


def read_csv_family(spark: SparkSession, root: str, ddl: str, look: list[str], avoid: list[str] = (), strict: bool = False) -> DataFrame:
    """The CSV files whose name has every ``look`` and no ``avoid``, united by header name."""
    from skein.sources.readers import read_csv
    paths = select_paths(listing(spark, root).filter(F.endswith(F.lower("name"), F.lit(".csv"))),
                         _named(F.col("name"), list(look), list(avoid)), strict)
    return read_csv(spark, paths, ddl) if paths else empty(spark, ddl)


# --------------------------------------------------------------------------- synchronisation
def _digested(files: DataFrame) -> DataFrame:
    """With the content's digest, read in chunks where the rows lie."""
    def run(batches):
        import hashlib
        for batch in batches:
            out = []
            for path in batch.column(0).to_pylist():
                fs, name = file_system(path)
                digest = hashlib.sha256()
                with fs.open_input_stream(name) as f:
                    while data := f.read(CHUNK):
                        digest.update(data)
                out.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(out, pa.string())], ["relative", "digest"])

    ship_code(files.sparkSession)
    return files.select("path", "relative").mapInArrow(run, "relative STRING, digest STRING")


def changed_files(spark: SparkSession, source: str, target: str) -> DataFrame:
    """(path, relative, length) of the source's files that the target lacks or has with other content. Contents are compared
    only where the sizes agree."""
    mine, theirs = listing(spark, source), listing(spark, target).select("relative", F.col("length").alias("there"), F.col("path").alias("their_path"))
    j = mine.join(theirs, "relative", "left")
    same_size = j.filter(F.col("length") == F.col("there"))
    a = _digested(same_size.select("path", "relative"))
    b = _digested(same_size.select(F.col("their_path").alias("path"), "relative"))
    equal = a.join(b, ["relative", "digest"], "left_semi").select("relative")
    return mine.join(equal, "relative", "left_anti").select("path", "relative", "length")


def sync_directory(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Copy what changed, keeping relative paths; returns (relative, length) of the copied files. Tasks copy one file at a
    time in chunks, under a temporary name that is moved into place. Files that only the target has stay."""
    def run(batches):
        fs_to, base = file_system(target.rstrip("/"))
        for batch in batches:
            for path, relative in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                fs, name = file_system(path)
                goal = f"{base}/{relative}"
                fs_to.create_dir(posixpath.dirname(goal), recursive=True)
                draft = f"{posixpath.dirname(goal)}/.{uuid.uuid4().hex}"
                with fs.open_input_stream(name) as f, fs_to.open_output_stream(draft) as out:
                    while data := f.read(CHUNK):
                        out.write(data)
                fs_to.move(draft, goal)
            yield batch.select(["relative", "length"])

    ship_code(spark)
    todo = changed_files(spark, source, target).repartition("relative")  # one row per file
    done = todo.mapInArrow(run, "relative STRING, length BIGINT")
    rows = done.collect()  # names of the copied files
    return spark.createDataFrame(rows, "relative STRING, length BIGINT")
