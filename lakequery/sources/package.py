"""Files of several parts: state databases as one table, workbooks' sheets, and ZIP packages written by tasks."""

from __future__ import annotations

import glob
import io
import os
import re
import sqlite3
import struct
import zipfile
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from lakequery.functions.rank import running
from lakequery.sources.tables import persist_table

# Columns of state tables; the key may be spelled either way.
KEY_SPELLINGS = ("dataset_id", "key")
STATE_COLUMNS = {"key": "string", "source_id": "string", "status": "string", "bytes": "long", "bytes_in": "long", "bytes_out": "long", "error": "string"}


def local_path(path: str) -> str:
    """A path for Python's own calls, of one that may be written for Spark."""
    return re.sub(r"^file:/*", "/", path)


class RowRange(InputPartition):
    def __init__(self, path: str, first: int, last: int, key: str, columns: list[str]) -> None:
        super().__init__((path, first))
        self.path, self.first, self.last, self.key, self.columns = path, first, last, key, columns


class StateSource(DataSource):
    """`spark.read.format("state_db").load(path)`: the rows of all state databases (SQLite) that a pattern finds, as one table of file, position and STATE_COLUMNS. Options: table
    (files), rows (of a partition, 100,000). A key column is found in each file by its name, columns that a file lacks are null. Files must lie where all tasks
    see them. Equality and IN on key, source_id and status are answered by the databases; spark.sql.python.filterPushdown.enabled must be set, as read_states does."""

    @classmethod
    def name(cls) -> str:
        return "state_db"

    def schema(self) -> str:
        return "file string, position long, " + ", ".join(f"{c} {t}" for c, t in STATE_COLUMNS.items())

    def reader(self, schema) -> DataSourceReader:
        return StateReader(self.options)


def _connected(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True)


class StateReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.pattern, self.table, self.rows = local_path(options["path"]), options.get("table", "files"), int(options.get("rows", 100_000))
        if not re.fullmatch(r"\w+", self.table):
            raise ValueError(f"no table name: {self.table}")
        self.where: list[tuple[str, tuple]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802  Spark's name
        for f in filters:
            column = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            values = (f.value,) if isinstance(f, EqualTo) else tuple(f.value) if isinstance(f, In) else ()
            if column in ("key", "source_id", "status") and values and all(isinstance(v, str) for v in values):
                self.where.append((column, values))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        out: list[InputPartition] = []
        for path in sorted(glob.glob(self.pattern)):
            with _connected(path) as con:
                columns = [r[1] for r in con.execute(f"PRAGMA table_info({self.table})")]
                key = next((k for k in KEY_SPELLINGS if k in columns), None)
                if key is None:
                    raise ValueError(f"{path}: {self.table} has none of {', '.join(KEY_SPELLINGS)}")
                first, last = con.execute(f"SELECT min(rowid), max(rowid) FROM {self.table}").fetchone()
            if first is not None:
                out += [RowRange(path, a, min(a + self.rows - 1, last), key, columns) for a in range(first, last + 1, self.rows)]
        return out

    def read(self, partition: RowRange) -> Iterator[tuple]:
        own = {c: partition.key if c == "key" else c for c in STATE_COLUMNS}
        shown = [f'CAST("{own[c]}" AS {"TEXT" if t == "string" else "INTEGER"})' if own[c] in partition.columns else "NULL" for c, t in STATE_COLUMNS.items()]
        sql, args = f"SELECT rowid, {', '.join(shown)} FROM {self.table} WHERE rowid BETWEEN ? AND ?", [partition.first, partition.last]
        for column, values in self.where:
            if own[column] not in partition.columns:
                return  # null equals nothing
            sql += f' AND CAST("{own[column]}" AS TEXT) IN ({", ".join("?" * len(values))})'
            args += values
        con = _connected(partition.path)
        try:
            for row in con.execute(sql + " ORDER BY rowid", args):
                yield (os.path.basename(partition.path), *row)
        finally:
            con.close()


def read_states(spark: SparkSession, pattern: str, expected: int | None = None, **options: str) -> DataFrame:
    """All rows of the state databases that a pattern finds; an unexpected number of files is an error."""
    spark.dataSource.register(StateSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")  # a source that can be asked must be
    found = len(glob.glob(local_path(pattern)))
    if expected is not None and found != expected:
        raise ValueError(f"{found} state databases, {expected} expected")
    return spark.read.format("state_db").options(**options).load(pattern)


def curation_state(states: DataFrame) -> DataFrame:
    """key, status, bytes_in, bytes_out, position for curate.summarize_curated: rows in the order of their files and of the rows in each."""
    from lakequery.functions.rank import global_rank

    ranked = global_rank(states.select("file", "position", "key", "status", "bytes_in", "bytes_out"), [F.asc("file"), F.asc("position")], "place")
    return ranked.select("key", "status", "bytes_in", "bytes_out", F.col("place").alias("position"))


# Number formats of a workbook that are dates without saying so.
DATE_FORMATS = frozenset((*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)))
CELLS = "file string, sheet string, row int, col int, kind string, text string, shared int"


def _local(e) -> str:
    return e.tag.rpartition("}")[2]


def _column(ref: str) -> int:
    """Of a reference such as AB12, from 1."""
    n = 0
    for c in ref:
        if not c.isalpha():
            break
        n = n * 26 + ord(c.upper()) - 64
    return n


def _date_styles(z: zipfile.ZipFile) -> list[bool]:
    if "xl/styles.xml" not in z.namelist():
        return []
    root = ElementTree.fromstring(z.read("xl/styles.xml"))
    own = {int(e.get("numFmtId")): e.get("formatCode", "") for e in root.iter() if _local(e) == "numFmt"}
    said = lambda code: bool(re.search(r"[ymdhs]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", code), re.I))
    cells = next((e for e in root if _local(e) == "cellXfs"), ())
    ids = [int(x.get("numFmtId", 0)) for x in cells]
    return [i in DATE_FORMATS or said(own.get(i, "")) for i in ids]


def _sheets(z: zipfile.ZipFile) -> list[tuple[str, str]]:
    """(name, member) of the sheets in their order."""
    rels = {e.get("Id"): e.get("Target") for e in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
    book = ElementTree.fromstring(z.read("xl/workbook.xml"))
    of = lambda e: next(v for k, v in e.attrib.items() if k.rpartition("}")[2] == "id" and "}" in k)
    return [(e.get("name"), "xl/" + rels[of(e)].removeprefix("/xl/")) for e in book.iter() if _local(e) == "sheet"]


def _cells(content: bytes, file: str, wanted: str | None) -> Iterator[tuple]:
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        dates = _date_styles(z)
        for name, member in _sheets(z):
            if wanted is not None and name != wanted:
                continue
            row = 0
            with z.open(member) as f:
                for event, e in ElementTree.iterparse(f, ("start", "end")):
                    if event == "start":
                        if _local(e) == "row":
                            row, col = int(e.get("r", row + 1)), 0
                        continue
                    if _local(e) == "c":
                        col = _column(e.get("r")) if e.get("r") else col + 1
                        kind = e.get("t", "n")
                        v = next((x.text for x in e if _local(x) == "v"), None)
                        if kind == "inlineStr":
                            yield file, name, row, col, "text", "".join(x.text or "" for x in e.iter() if _local(x) == "t"), None
                        elif v is not None:
                            style = int(e.get("s", 0))
                            of = {"s": "text", "str": "text", "b": "boolean", "e": "error"}.get(kind, "date" if kind == "d" or kind == "n" and style < len(dates) and dates[style] else "number")
                            yield file, name, row, col, of, None if kind == "s" else v, int(v) if kind == "s" else None
                    elif _local(e) == "row":
                        e.clear()


def _strings(content: bytes, file: str) -> Iterator[tuple]:
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        if "xl/sharedStrings.xml" not in z.namelist():
            return
        with z.open("xl/sharedStrings.xml") as f:
            n = 0
            for _, e in ElementTree.iterparse(f, ("end",)):
                if _local(e) == "si":
                    yield file, n, "".join(x.text or "" for x in e.iter() if _local(x) == "t" and x.text)
                    n += 1
                    e.clear()


def read_sheet_cells(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """file, sheet, row, col, kind (text, number, date, boolean, error), text of every cell with a value in the workbooks (XLSX) at path; rows and columns count from 1. Sheets and
    shared strings are read as streams, by a task for each workbook, and strings are joined by their number; a date is told as ISO text, from the
    1900 calendar unless it is text already. Empty cells have no row."""
    files = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")

    def cut(of, schema: pa.Schema):
        def run(batches):
            for b in batches:
                for name, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    rows: list[tuple] = []
                    for row in of(content, name):
                        rows.append(row)
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        return run

    kinds = {"string": pa.string(), "int": pa.int32()}
    cells = files.mapInArrow(cut(lambda c, n: _cells(c, n, sheet), pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in CELLS.split(", ")])), CELLS)
    strings = files.mapInArrow(cut(_strings, pa.schema([("in_file", pa.string()), ("number", pa.int32()), ("said", pa.string())])), "in_file string, number int, said string")
    both = cells.join(strings, (F.col("file") == F.col("in_file")) & (F.col("shared") == F.col("number")), "left")
    days = F.col("text").try_cast("double")
    date = F.timestamp_seconds(F.round((days - 25569) * 86400))  # 1970-01-01 is day 25569
    iso = F.when(days.isNull(), F.col("text")).when(days == F.floor(days), F.date_format(date, "yyyy-MM-dd")).otherwise(F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss"))
    return both.select("file", "sheet", "row", "col", "kind", F.when(F.col("shared").isNotNull(), F.col("said")).when(F.col("kind") == "date", iso).otherwise(F.col("text")).alias("text"))


def read_sheet(spark: SparkSession, path: str, sheet: str, header: int = 1) -> DataFrame:
    """file, row and the columns that the header row names, as text; all workbooks at path need the first one's header. A column without a name is left out."""
    cells = persist_table(read_sheet_cells(spark, path, sheet))
    first = cells.where(F.col("row") == header).select(F.min("file")).first()[0]
    names = {r["col"]: r["text"] for r in cells.where((F.col("row") == header) & (F.col("file") == first) & (F.col("text") != "")).collect()}  # a header row
    return cells.where(F.col("row") > header).groupBy("file", "row").agg(*(F.max(F.when(F.col("col") == c, F.col("text"))).alias(n) for c, n in sorted(names.items())))


# Signatures of the ZIP format, and the time 1980-01-01 00:00.
LOCAL, CENTRAL, END64, LOCATOR, END = 0x04034B50, 0x02014B50, 0x06064B50, 0x07064B50, 0x06054B50
WIDE, DAY = 0xFFFFFFFF, 0x21


def _local_header(name: bytes, crc: int, packed: int, size: int) -> bytes:
    """Sizes always in the wide form, so that a header's length depends on the name alone."""
    extra = struct.pack("<HHQQ", 1, 16, size, packed)
    return struct.pack("<IHHHHHIIIHH", LOCAL, 45, 0x800, 8, 0, DAY, crc, WIDE, WIDE, len(name), len(extra)) + name + extra


def _central(name: bytes, crc: int, packed: int, size: int, at: int) -> bytes:
    extra = struct.pack("<HHQQQ", 1, 24, size, packed, at)
    return struct.pack("<IHHHHHHIIIHHHHHII", CENTRAL, 45, 45, 0x800, 8, 0, DAY, crc, WIDE, WIDE, len(name), len(extra), 0, 0, 0, 0, WIDE) + name + extra


def _end(count: int, size: int, at: int) -> bytes:
    wide = struct.pack("<IQHHIIQQQQ", END64, 44, 45, 45, 0, 0, count, count, size, at)
    return wide + struct.pack("<IIQI", LOCATOR, 0, at + size, 1) + struct.pack("<IHHHHIIH", END, 0, 0, 0xFFFF, 0xFFFF, WIDE, WIDE, 0)


def write_zip(members: DataFrame, path: str) -> int:
    """Write members (name, content) as one ZIP file at path, which all tasks must see as a file of the same name; tells its bytes. Members are deflated where they are; their
    places are running sums of packed sizes in the order of the names, so tasks write at their own offsets, all at once, and the directory comes last. A name that comes
    twice is an error. A repeated task writes the same bytes at the same place."""
    spark, path = members.sparkSession, local_path(path)

    def pack(batches):
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                squeeze = zlib.compressobj(6, zlib.DEFLATED, -15)
                data = squeeze.compress(content) + squeeze.flush()
                yield pa.RecordBatch.from_arrays([pa.array([name], pa.string()), pa.array([zlib.crc32(content)], pa.int64()), pa.array([len(content)], pa.int64()), pa.array([len(data)], pa.int64()), pa.array([data], pa.binary())], names=["name", "crc", "size", "packed", "data"])

    given = members.select(F.col("name").cast("string"), F.coalesce("content", F.lit(b"")).alias("content"))
    packed = persist_table(given.mapInArrow(pack, "name string, crc long, size long, packed long, data binary"))
    if not packed.groupBy("name").count().where("count > 1 or name is null").isEmpty():
        raise ValueError("a member's name is missing, or comes twice")
    places = packed.select("name", "crc", "size", "packed", (F.octet_length("name") + F.lit(50) + F.col("packed")).cast("long").alias("length"), (F.octet_length("name") + F.lit(74)).cast("long").alias("entry"))
    places = running(places, [F.asc("name")], F.col("length"), "upto")
    places = persist_table(running(places, [F.asc("name")], F.col("entry"), "listed"))
    whole = places.agg(F.coalesce(F.sum("length"), F.lit(0)), F.coalesce(F.sum("entry"), F.lit(0)), F.count("*")).first()
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    tail = _end(whole[2], whole[1], whole[0])
    with open(path, "wb") as f:  # gaps are filled by the tasks
        f.truncate(whole[0] + whole[1])
        f.seek(whole[0] + whole[1])
        f.write(tail)

    def put(batches):
        fd = os.open(path, os.O_WRONLY)
        try:
            n = 0
            for b in batches:
                for r in b.to_pylist():
                    name, at = r["name"].encode(), r["upto"] - r["length"]
                    for place, data in ((at, _local_header(name, r["crc"], r["packed"], r["size"]) + r["data"]), (whole[0] + r["listed"] - r["entry"], _central(name, r["crc"], r["packed"], r["size"], at))):
                        while data:
                            done = os.pwrite(fd, data, place)
                            place, data = place + done, data[done:]
                    n += 1
            os.fsync(fd)
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])
        finally:
            os.close(fd)

    at = places.select(F.col("name").alias("in_name"), "length", "entry", "upto", "listed")
    done = packed.join(at, F.col("name") == F.col("in_name")).drop("in_name").mapInArrow(put, "n long").agg(F.sum("n")).first()[0] or 0
    if done != whole[2]:
        raise RuntimeError(f"{done} of {whole[2]} members were written")
    return whole[0] + whole[1] + len(tail)


def write_folder_zip(spark: SparkSession, folder: str, path: str) -> int:
    """A ZIP file of all files below a folder, by their paths in it."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    cut = local_path(folder).rstrip("/") + "/"  # Spark writes file:/ where others write file:///
    top = spark._jvm.org.apache.hadoop.fs.Path(folder)
    listed, empty = top.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).listFiles(top, True), []
    while listed.hasNext():  # Spark reads no file without content
        f = listed.next()
        if not f.getLen():
            empty.append((f.getPath().toUri().getPath().removeprefix(cut), b""))
    none = spark.createDataFrame(empty, "name string, content binary")
    return write_zip(files.select(F.substring_index("path", cut, -1).alias("name"), "content").union(none), path)
