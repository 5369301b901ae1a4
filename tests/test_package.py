"""State databases, workbooks and packages."""

import sqlite3
import zipfile

import pytest
from pyspark.sql import functions as F

from lakequery.operators import curate
from lakequery.sources import package


def state(path, rows, key="key", extra=""):
    con = sqlite3.connect(path)
    con.execute(f"CREATE TABLE files({key} TEXT, status TEXT, bytes_in INTEGER, bytes_out INTEGER{extra})")
    con.executemany("INSERT INTO files VALUES(?, ?, ?, ?)" if not extra else "INSERT INTO files VALUES(?, ?, ?, ?, ?)", rows)
    con.commit()
    con.close()


def test_states(spark, tmp_path):
    """Fifteen files with two spellings of the key, ranges of rows, pushed filters, and the totals of the curation."""
    every = []
    for i in range(15):
        rows = [(f"k{i}_{j}" if j else "shared", ("OK", "FAILED")[(i + j) % 3 == 0], i * 10 + j, None if j == 2 else j) for j in range(12)]
        every += rows
        state(tmp_path / f"batch_{i:02}.sqlite", rows, ("key", "dataset_id")[i % 2])
    sqlite3.connect(tmp_path / "batch_05.sqlite").execute("DELETE FROM files WHERE rowid BETWEEN 3 AND 5").connection.commit()
    gone = every[5 * 12 + 2 : 5 * 12 + 5]
    every = [r for r in every if r not in gone]
    got = package.read_states(spark, f"{tmp_path}/batch_*.sqlite", expected=15, rows="5")
    assert sorted((r.key, r.status, r.bytes_in, r.bytes_out) for r in got.collect()) == sorted(every, key=str) or sorted(map(str, ((r.key, r.status, r.bytes_in, r.bytes_out) for r in got.collect()))) == sorted(map(str, every))
    assert got.rdd.getNumPartitions() == 15 * 3 and got.where("source_id is not null").count() == 0
    few = package.read_states(spark, f"{tmp_path}/batch_*.sqlite").where(F.col("status").isin("FAILED", "x") & (F.col("key") == "shared") & (F.col("bytes_in") < 100))
    assert sorted(r.bytes_in for r in few.collect()) == sorted(r[2] for r in every if r[0] == "shared" and r[1] == "FAILED" and r[2] < 100)
    assert package.read_states(spark, f"{tmp_path}/batch_*.sqlite").where("source_id = 'a'").count() == 0
    reader = package.StateReader({"path": f"{tmp_path}/batch_*.sqlite"})
    assert list(reader.pushFilters([package.EqualTo(("key",), "shared"), package.EqualTo(("bytes_in",), 3), package.In(("status",), ("OK", None))])) == [package.EqualTo(("bytes_in",), 3), package.In(("status",), ("OK", None))]
    assert [r[2] for r in reader.read(reader.partitions()[0])] == ["shared"]
    best = {}
    for k, s, a, b in every:  # a good row goes first, of good ones the first; of others the last
        if k not in best or (best[k][0] != "OK"):
            best[k] = (s, a or 0, b or 0)
    raw = spark.createDataFrame([(k, v[1]) for k, v in best.items()], "key string, bytes long")
    total = curate.summarize_curated(raw, package.curation_state(got))
    ok = [v for v in best.values() if v[0] == "OK"]
    assert (total["state_ok"], total["state_rows"], total["distinct_keys"], total["duplicate_rows"]) == (len(ok), len(every), len(best), len(every) - len(best))
    with pytest.raises(ValueError, match="15 state databases, 14 expected"):
        package.read_states(spark, f"{tmp_path}/batch_*.sqlite", expected=14)
    sqlite3.connect(tmp_path / "odd.sqlite").execute("CREATE TABLE files(name TEXT)").connection.commit()
    with pytest.raises(Exception, match="none of dataset_id, key"):
        package.read_states(spark, f"{tmp_path}/odd.sqlite").count()


def workbook(path, sheets, strings, styles=""):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", "<workbook xmlns='m' xmlns:r='r'><sheets>" + "".join(f"<sheet name='{n}' sheetId='{i}' r:id='x{i}'/>" for i, n in enumerate(sheets)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", "<R xmlns='p'>" + "".join(f"<Relationship Id='x{i}' Target='{'/xl/' if i else ''}worksheets/s{i}.xml'/>" for i in range(len(sheets))) + "</R>")
        for i, rows in enumerate(sheets.values()):
            z.writestr(f"xl/worksheets/s{i}.xml", f"<worksheet xmlns='m'><sheetData>{rows}</sheetData></worksheet>")
        if strings:
            z.writestr("xl/sharedStrings.xml", f"<sst xmlns='m'>{strings}</sst>")
        if styles:
            z.writestr("xl/styles.xml", styles)


def test_sheets(spark, tmp_path):
    """Shared strings of several runs, in-line strings, formulas, dates by built-in and own formats, empty cells, and cells without a reference."""
    styles = "<styleSheet xmlns='m'><numFmts><numFmt numFmtId='170' formatCode='yyyy\\-mm'/><numFmt numFmtId='171' formatCode='0.0&quot;d&quot;'/></numFmts><cellXfs><xf numFmtId='0'/><xf numFmtId='14'/><xf numFmtId='170'/><xf numFmtId='171'/></cellXfs></styleSheet>"
    head = "<row r='1'><c r='A1' t='s'><v>0</v></c><c r='B1' t='s'><v>1</v></c><c r='D1' t='inlineStr'><is><t>da</t></is></c></row>"
    one = "<row r='2'><c r='A2' t='s'><v>2</v></c><c r='B2'><v>1.5</v></c><c r='C2' s='3'><v>3</v></c><c r='D2' s='1'><v>45000</v></c></row>"
    two = "<row r='5'><c r='A5' t='str'><f>X</f><v>sum</v></c><c r='B5' s='0'/><c r='D5' s='2'><v>45000.5</v></c><c r='AB5' t='b'><v>1</v></c></row>"
    bare = "<row><c><v>7</v></c><c t='e'><v>#N/A</v></c></row>"
    strings = "<si><t>name</t></si><si><t>value</t></si><si><r><t>a </t></r><r><rPr/><t>b</t></r></si>"
    workbook(tmp_path / "one.xlsx", {"Data": head + one + two, "Other": bare}, strings, styles)
    workbook(tmp_path / "two.xlsx", {"Data": head + "<row r='2'><c r='A2' t='s'><v>1</v></c></row>"}, strings)
    got = {(r.file, r.sheet, r.row, r.col): (r.kind, r.text) for r in package.read_sheet_cells(spark, f"{tmp_path}/*.xlsx").collect()}
    a = lambda row, col, sheet="Data", file="one.xlsx": got[file, sheet, row, col]
    assert (a(2, 1), a(2, 2), a(2, 3), a(2, 4)) == (("text", "a b"), ("number", "1.5"), ("number", "3"), ("date", "2023-03-15"))
    assert (a(5, 1), a(5, 4), a(5, 28)) == (("text", "sum"), ("date", "2023-03-15T12:00:00"), ("boolean", "1"))
    assert (a(1, 1, "Other"), a(1, 2, "Other"), a(2, 1, file="two.xlsx")) == (("number", "7"), ("error", "#N/A"), ("text", "value"))
    assert ("one.xlsx", "Data", 5, 2) not in got and len(got) == 16
    rows = package.read_sheet(spark, f"{tmp_path}/*.xlsx", "Data")
    assert rows.columns == ["file", "row", "name", "value", "da"]
    assert sorted(map(tuple, rows.collect())) == [("one.xlsx", 2, "a b", "1.5", "2023-03-15"), ("one.xlsx", 5, "sum", None, "2023-03-15T12:00:00"), ("two.xlsx", 2, "value", None, None)]


def test_package(spark, tmp_path):
    want = {f"dir{i % 3}/file é{i}.txt": (f"line {i}\n" * i).encode() for i in range(60)} | {"empty": b"", "big.bin": bytes(range(256)) * 4000}
    df = spark.createDataFrame(list(want.items()), "name string, content binary").repartition(5)
    size = package.write_zip(df, f"file://{tmp_path}/out/p.zip")
    assert (tmp_path / "out/p.zip").stat().st_size == size
    with zipfile.ZipFile(tmp_path / "out/p.zip") as z:
        assert z.testzip() is None and z.namelist() == sorted(want, key=str.encode) and {n: z.read(n) for n in want} == want
    for n, data in want.items():
        (tmp_path / "tree" / n).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "tree" / n).write_bytes(data)
    package.write_folder_zip(spark, f"file://{tmp_path}/tree", f"{tmp_path}/tree.zip")
    with zipfile.ZipFile(tmp_path / "tree.zip") as z:
        assert {n: z.read(n) for n in z.namelist()} == want
    package.write_zip(df.limit(0), f"{tmp_path}/none.zip")
    assert zipfile.ZipFile(tmp_path / "none.zip").namelist() == []
    with pytest.raises(ValueError):
        package.write_zip(df.union(df.limit(1)), f"{tmp_path}/twice.zip")


def test_package_beyond_4_gb(tmp_path):
    """Headers hold sizes and places of more than 32 bits: a sparse file with a member behind the fifth thousand million."""
    import zlib

    path, at, data = tmp_path / "wide.zip", 5 * 10**9, b"far away"
    squeeze = zlib.compressobj(6, zlib.DEFLATED, -15)
    packed = squeeze.compress(data) + squeeze.flush()
    head = package._local_header(b"x", zlib.crc32(data), len(packed), len(data))
    entry = package._central(b"x", zlib.crc32(data), len(packed), len(data), at)
    with path.open("wb") as f:
        f.seek(at)
        f.write(head + packed + entry + package._end(1, len(entry), at + len(head) + len(packed)))
    assert len(head) == 1 + 50 and len(entry) == 1 + 74
    with zipfile.ZipFile(path) as z:
        assert z.read("x") == data
