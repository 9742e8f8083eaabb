"""The source corpus: units of text from files or columns, their lines, and files seen by name and size alone."""

from __future__ import annotations

import re
from fnmatch import fnmatchcase
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvane.functions import text as X
from corvane.session import cut


_LISTED = "path string, name string, grp string, byte_size bigint"


def _file_system(path: str):
    """The store of a path or URI, the place within it, and what makes a place there a path again.

    Only the scheme and authority are read as a URI, so names may hold ``#``, ``?`` and ``%``.
    """
    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem(), re.sub("^file:/*", "/", path), ""
    root, rest = re.fullmatch("([^:]+://[^/]*)(.*)", path, re.S).groups()
    store, top = fs.FileSystem.from_uri(f"{root}/")
    place = top.rstrip("/") + rest
    return store, place, path.removesuffix(place)


def listed(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """(path, name, grp, byte_size) of all files below ``path`` whose names match ``glob``; grp is the folder above the file's.

    Spark's own readers leave out empty files and names that begin with ``_`` or a
    point, and keep the list of all files in the driver, so the store is listed in
    tasks: level by level until there are as many folders as tasks, and then each
    folder with all that is below. Local paths are plain, others keep their scheme.
    """
    _, place, prefix = _file_system(path)
    schema = pa.schema([("path", pa.string()), ("is_folder", pa.bool_()), ("byte_size", pa.int64())])

    def found(deep: bool):
        def inside(batches):
            store = _file_system(path)[0]
            for batch in batches:
                folders = batch.column(0).to_pylist()
                while folders:
                    here = store.get_file_info(fs.FileSelector(folders.pop()))
                    rows = [(x.path, False, x.size) for x in here if x.type == fs.FileType.File and fnmatchcase(x.base_name, glob)]
                    inner = [x.path for x in here if x.type == fs.FileType.Directory]
                    if deep:
                        folders += inner
                    else:
                        rows += [(f, True, None) for f in inner]
                    for k in range(0, len(rows), 10_000):
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[k : k + 10_000], strict=True), schema, strict=True)], schema=schema)

        return inside

    def below(folders: DataFrame, n: int, deep: bool) -> DataFrame:
        # a row a folder, dealt out one by one
        return folders.repartition(min(n, 1000)).mapInArrow(found(deep), "path string, is_folder boolean, byte_size bigint")

    folders, n, parts = spark.createDataFrame([(place,)], "path string"), 1, []
    while 0 < n < max(2, spark.sparkContext.defaultParallelism):
        level = cut(below(folders, n, False))
        parts.append(level.where("not is_folder"))
        folders = level.where("is_folder").select("path")
        n = folders.count()
    if n:
        parts.append(below(folders, n, True))
    names = F.split("path", "/")
    return reduce(DataFrame.unionByName, parts).select(
        F.concat(F.lit(prefix), "path").alias("path"), F.element_at(names, -1).alias("name"), F.coalesce(F.try_element_at(names, F.lit(-3)), F.lit("")).alias("grp"), "byte_size"
    )


#: Files and bytes that a task reads before it passes them on.
FILES_A_BATCH, BYTES_A_BATCH = 1_000, 8 << 20


def _contents(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` of listed() below ``path`` with their files' contents, read in tasks."""
    schema = pa.schema([("path", pa.string()), ("name", pa.string()), ("grp", pa.string()), ("byte_size", pa.int64()), ("content", pa.binary())])

    def content(store, place: str) -> bytes:
        with store.open_input_stream(place) as f:
            return f.read()

    def read(batches):
        store, _, prefix = _file_system(path)
        for batch in batches:
            held, n, at = [], 0, 0
            for k, (where, size) in enumerate(zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True), 1):
                held.append(b"" if size == 0 else content(store, where.removeprefix(prefix)))
                n += len(held[-1])
                if k == batch.num_rows or len(held) == FILES_A_BATCH or n >= BYTES_A_BATCH:
                    yield pa.RecordBatch.from_arrays([*batch.slice(at, len(held)).columns, pa.array(held, pa.binary())], schema=schema)
                    held, n, at = [], 0, k

    return rows.mapInArrow(read, f"{_LISTED}, content binary")


def read_units(spark: SparkSession, path: str, glob: str = "*.m", root: str = "", new_root: str = "") -> DataFrame:
    """(path, unit, grp, byte_size, text) of files ``.../<group>/Routines/<unit>.m``; bytes that aren't UTF-8 are replaced.

    Empty units have empty text. Names that begin with ``_`` (percent units) are
    read like all others. Files are dealt out by their paths, whatever their
    folders, and the driver sees none of them.
    """
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    files = _contents(listed(spark, path, glob).repartition(tasks, "path"), path)
    return files.select(
        (X.moved_path(F.col("path"), root, new_root) if root else F.col("path")).alias("path"), F.regexp_extract("name", r"^(.+)\.[^.]+$", 1).alias("unit"), "grp", "byte_size",
        F.make_valid_utf8(F.col("content").cast("string")).alias("text"),
    )


def list_files(spark: SparkSession, path: str, glob: str = "*.zwr") -> DataFrame:
    """(path, name, grp, byte_size, kind, number, chunk, entity) by names and sizes alone: no file is read."""
    return listed(spark, path, glob).withColumn("c", X.file_class(F.col("name"))).select("path", "name", "grp", "byte_size", "c.*")


def lines(units: DataFrame, unit: str = "unit", text: str = "text", breaks: str = "\n", keep: tuple[str, ...] = ()) -> DataFrame:
    """(unit, ..., line_no from 1, line) of every unit; null and empty texts have no lines."""
    return units.select(F.col(unit).alias("unit"), *keep, F.posexplode(X.lines_of(F.col(text), breaks)).alias("at", "line")).select(
        "unit", *keep, (F.col("at") + 1).alias("line_no"), "line"
    )


def inventory(units: DataFrame, unit: str = "unit", grp: str = "grp", text: str = "text") -> DataFrame:
    """One row per unit: lines, bytes, first and version line, label and comment lines, percent flag."""
    found = X.lines_of(F.col(text))

    def of_class(name: str) -> Column:
        return F.size(F.filter("ls", lambda x: X.line_class(x) == name)).cast("long")

    return units.withColumn("ls", found).select(
        F.col(unit).alias("unit"),
        F.col(grp).alias("grp"),
        F.size("ls").cast("long").alias("line_count"),
        F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("byte_size"),
        X.shortened(X.first_line(F.col("ls"))).alias("first_line"),
        X.version_line(F.col("ls")).alias("version_line"),
        of_class("label").alias("tag_count"),
        of_class("comment").alias("comment_line_count"),
        F.when(F.col(unit).cast("string").startswith("_"), "Y").otherwise("N").alias("is_percent"),
    )


def unit_contract(manifest: DataFrame, found: DataFrame) -> DataFrame:
    """(check, unit) violations: units in several groups, listed units without a file, files that aren't listed."""
    several = manifest.groupBy("unit").agg(F.count_distinct("grp").alias("n")).where("n > 1").select(F.lit("several groups").alias("check"), "unit")
    missing = manifest.select("unit").distinct().join(found.select("unit"), "unit", "left_anti").select(F.lit("missing file").alias("check"), "unit")
    extra = found.select("unit").distinct().join(manifest.select("unit"), "unit", "left_anti").select(F.lit("not listed").alias("check"), "unit")
    return several.unionByName(missing).unionByName(extra)


def write_units(units: DataFrame, path: str, folder: str = "Routines", suffix: str = ".m") -> int:
    """Writes each row (unit, grp, text) as ``<path>/<grp>/<folder>/<unit><suffix>``, in tasks, and returns their number. Null texts are empty files.

    A task that runs again writes the same files again.
    """
    store, place, _ = _file_system(path)
    store.create_dir(place, recursive=True)

    def write(batches):
        for batch in batches:
            files, top, _ = _file_system(path)
            made = set()
            for unit, grp, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                where = f"{top}/{grp}/{folder}"
                if where not in made:
                    files.create_dir(where, recursive=True)
                    made.add(where)
                with files.open_output_stream(f"{where}/{unit}{suffix}") as f:
                    f.write((text or "").encode())
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    return units.select("unit", "grp", "text").mapInArrow(write, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]


#: Files of which one task adds up the sizes when they are dealt out.
FILES_A_RANGE = 20_000


def dealt_by_size(files: DataFrame, tasks: int, size: str = "byte_size", key: str = "path") -> DataFrame:
    """``files`` with ``task`` (from 0): bins of nearly equal sums of sizes, each filled in the order of a hash of ``key``.

    A bin's sum passes the mean by less than the largest file. Sums run over
    ranges of the hash that are added up on their own and begin at the sum of the
    ranges before, so no task sees all files. Files without size count as empty.
    """
    n_ranges = max(1, -(-files.count() // FILES_A_RANGE))
    n = F.coalesce(F.col(size), F.lit(0)).cast("long")
    rows = files.select("*", F.pmod(F.xxhash64(key), F.lit(n_ranges)).alias("range"), n.alias("of_size"))
    sums = rows.groupBy("range").agg(F.sum("of_size").alias("s"))
    before = sums.select("range", F.coalesce(F.sum("s").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    total = sums.agg(F.coalesce(F.sum("s"), F.lit(0)).alias("total"))
    inside = F.coalesce(F.sum("of_size").over(Window.partitionBy("range").orderBy(F.xxhash64(key), key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = rows.withColumn("inside", inside).join(F.broadcast(before), "range").crossJoin(F.broadcast(total))
    # the middle of a file decides, so that a large one at an edge goes where most of it lies
    middle = (F.col("before") + F.col("inside") + F.col("of_size") / 2) * tasks / F.greatest("total", F.lit(1))
    return placed.withColumn("task", F.least(F.floor(middle).cast("int"), F.lit(tasks - 1))).select(*files.columns, "task")


def read_by_manifest(spark: SparkSession, manifest: DataFrame, path: str, tasks: int | None = None, glob: str = "*.m") -> DataFrame:
    """(path, unit, grp, byte_size, text, task) of the files that ``manifest`` (unit, grp, path) lists below ``path``.

    The manifest drives the read: its paths meet what is there, are dealt to
    ``tasks`` (the session's parallelism by default) by their sizes, and each task
    reads its files one by one. Paths without a file give no row, nor do files
    that aren't listed; see manifest_contract().
    """
    tasks = tasks or spark.sparkContext.defaultParallelism
    there = listed(spark, path, glob).select("path", "name", "byte_size")
    wanted = manifest.select("path", "unit", "grp").dropDuplicates(["path"]).join(there, "path")
    # sizes are dealt with before anything is read
    dealt = dealt_by_size(cut(wanted), tasks)
    rows = dealt.repartitionById(tasks, F.col("task")).select("path", F.to_json(F.struct("unit", "task")).alias("name"), "grp", "byte_size")
    told = F.from_json("name", "unit string, task int")
    return _contents(rows, path).select("path", told["unit"].alias("unit"), "grp", "byte_size", F.make_valid_utf8(F.col("content").cast("string")).alias("text"), told["task"].alias("task"))


def manifest_contract(spark: SparkSession, manifest: DataFrame, path: str, glob: str = "*.m") -> DataFrame:
    """unit_contract() of a manifest (unit, grp, path) and the files below ``path``, without reading them; an extra file is named by its path."""
    there = listed(spark, path, glob).select("path")
    units = manifest.select("unit", "path").dropDuplicates(["path"])
    found = there.join(units, "path", "left").select(F.coalesce("unit", "path").alias("unit"))
    return unit_contract(manifest, found)
