"""System files and workbooks written here byte by byte, and read back."""

import datetime as dt
import struct
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from cohortica.sources import readers, spss

GONE = -1.7976931348623157e308
#: name, width, print format, missing values (count, values)
VARIABLES = [("ID", 0, 5, 0, []), ("TEXT", 11, 1, 0, []), ("SCORE", 0, 5, 1, [99.0]), ("RANGE", 0, 5, -3, [-9.0, -1.0, 77.0]), ("DAY", 0, 20, 0, []), ("AT", 0, 22, 0, [])]


def seconds(t):
    return (t - dt.datetime(1582, 10, 14)).total_seconds()


def sav(path, rows, compression, order="<"):
    i = lambda *v: struct.pack(f"{order}{len(v)}i", *v)
    n = lambda v: struct.pack(f"{order}d", v)
    out = bytearray((b"$FL3" if compression == 2 else b"$FL2") + b"x".ljust(60) + i(2, 7, compression, 0, len(rows)) + n(100.0) + b" " * 84)
    for name, width, shown, missing, values in VARIABLES:
        out += i(2, width, 1, missing, shown << 16 | 8 << 8, shown << 16 | 8 << 8) + name.encode().ljust(8) + i(5) + b"label\0\0\0" + b"".join(map(n, values))
        out += (i(2, -1, 0, 0, 0, 0) + b" " * 8) * (-(-width // 8) - 1 if width else 0)
    out += i(3, 1) + n(1.0) + b"\x03yes" + b"\0" * 4 + i(4, 1, 3) + i(6, 1) + b"d" * 80
    names = "ID=respondent_id\tTEXT=Größe".encode()
    out += i(7, 13, 1, len(names)) + names + i(7, 20, 1, 5) + b"UTF-8" + i(999, 0)
    values = []
    for r in rows:
        for (_, width, *_), v in zip(VARIABLES, r, strict=True):
            if width:
                b = v.encode().ljust(16)
                values += [b[:8], b[8:]]
            else:
                values.append(n(GONE if v is None else v))
    if not compression:
        path.write_bytes(bytes(out) + b"".join(values))
        return
    coded = bytearray()
    small = {n(c - 100.0): c for c in range(1, 252)}
    codes = [(small.get(v, 254 if v == b" " * 8 else 255 if v == n(GONE) else 253), v) for v in values] + [(252, b"")]
    for k in range(0, len(codes), 8):
        part = codes[k : k + 8]
        coded += bytes(c for c, _ in part).ljust(8, b"\0") + b"".join(v for c, v in part if c == 253)
    if compression == 1:
        path.write_bytes(bytes(out + coded))
        return
    q, start = (lambda *v: struct.pack(f"{order}{len(v)}q", *v)), len(out)
    blocks, at, index = b"", start + 24, b""
    for k in range(0, len(coded), 101):  # blocks that end amid values
        z = zlib.compress(bytes(coded[k : k + 101]))
        index += q(start + k, at) + i(len(coded[k : k + 101]), len(z))
        blocks, at = blocks + z, at + len(z)
    path.write_bytes(bytes(out) + q(start, at, 24 + len(index)) + blocks + q(-100, 0) + i(101, len(index) // 24) + index)


ROWS = [(float(i), ["", "ab", "größer ab 9", " x"][i % 4], [None, 99.0, 3.0, 2.5][i % 4], [-5.0, 77.0, 1e9, 0.0, None][i % 5], seconds(dt.datetime(2020, 2, 29)) if i % 3 else None, seconds(dt.datetime(1969, 12, 31, 23, 59, 58)) + 0.5) for i in range(500)]
ROWS = [(a, "grö 9 ab" if b.startswith("grö") else b, *rest) for a, b, *rest in ROWS]


@pytest.mark.parametrize(("compression", "order"), [(0, "<"), (1, "<"), (2, "<"), (0, ">"), (1, ">")])
def test_system_files(spark, tmp_path, compression, order):
    path = tmp_path / "t.sav"
    sav(path, ROWS, compression, order)
    df = readers.read_table(spark, str(path))
    assert df.dtypes == [("respondent_id", "double"), ("Größe", "string"), ("SCORE", "double"), ("RANGE", "double"), ("DAY", "date"), ("AT", "timestamp_ntz")]
    want = [(a, b, None if s == 99 else s, None if r in (-5, 77) else r, day and dt.date(2020, 2, 29), dt.datetime(1969, 12, 31, 23, 59, 58, 500_000)) for a, b, s, r, day, _ in ROWS]
    assert sorted(map(tuple, df.collect())) == want
    kept = spark.read.format("spss").option("userMissing", "true").load(str(path))
    assert [r.SCORE for r in kept.orderBy("respondent_id").collect()] == [r[2] for r in ROWS]
    assert df.select("SCORE").agg(F.sum("SCORE")).first()[0] == sum(r[2] for r in want if r[2] is not None)


def test_partitions_of_a_plain_file(tmp_path, monkeypatch):
    path = tmp_path / "t.sav"
    sav(path, ROWS, 0)
    monkeypatch.setattr(spss, "PARTITION_BYTES", 1000)
    monkeypatch.setattr(spss, "BATCH_BYTES", 300)
    source = spss.SpssSource({"path": str(path)})
    reader = source.reader(source.schema())
    parts = reader.partitions()
    assert len(parts) == -(-500 // (1000 // 56)) and [x for p in parts for b in reader.read(p) for x in b.column(0).to_pylist()] == [r[0] for r in ROWS]
    sav(path, ROWS, 1)
    assert len(reader.partitions()) == 1 and sum(b.num_rows for p in reader.partitions() for b in reader.read(p)) == 500
    sav(path, [], 0)
    assert [b for p in reader.partitions() for b in reader.read(p)] == []
    path.write_bytes(b"something else" * 20)
    with pytest.raises(ValueError, match="not an SPSS"):
        reader.partitions()


def workbook(path, sheets):
    """sheets: name -> rows of cells as XML."""
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>' + "".join(f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(f'<Relationship Id="rId{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1)) + "</Relationships>")
        z.writestr("xl/styles.xml", f'<styleSheet xmlns="{main}"><numFmts><numFmt numFmtId="164" formatCode="yyyy\\-mm"/><numFmt numFmtId="165" formatCode="0.0&quot;days&quot;"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/></cellXfs></styleSheet>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}"><si><t>name</t></si><si><r><t>rich </t></r><r><t>text</t></r><rPh><t>no</t></rPh></si></sst>')
        for i, rows in enumerate(sheets.values(), 1):
            z.writestr(f"xl/worksheets/sheet{i}.xml", f'<worksheet xmlns="{main}"><sheetData>' + "".join(f"<row>{r}</row>" for r in rows) + "</sheetData></worksheet>")


def cell(at, v):
    return f'<c r="{at}" t="inlineStr"><is><t>{v}</t></is></c>'


def test_workbooks(spark, tmp_path):
    path = str(tmp_path / "t.xlsx")
    head = '<c r="A1" t="s"><v>0</v></c>' + "".join(cell(f"{c}1", n) for c, n in zip("BCDEFG", ("n", "x", "day", "ok", "mixed", "days"), strict=True)) + cell("AB1", "NAME")
    first = [
        head,
        '<c r="A2" t="s"><v>1</v></c><c r="B2"><v>7</v></c><c r="C2"><v>1.5</v></c><c r="D2" s="1"><v>43890.25</v></c><c r="E2" t="b"><v>1</v></c><c r="F2"><v>3</v></c><c r="G2" s="3"><v>2</v></c><c r="AB2"><v>9</v></c>',
        "",
        '<c r="B3"><v>8</v></c><c r="C3"><v>2</v></c><c r="D3" s="2"><v>1</v></c><c r="E3" t="e"><v>#N/A</v></c><c r="F3" t="str"><v>sum</v></c>',
    ]
    workbook(path, {"one": first, "two": [cell("A1", "n") + cell("B1", "name"), '<c><v>5</v></c><c t="inlineStr"><is><t>z</t></is></c>'], "none": []})
    df = readers.read_table(spark, path)
    assert df.dtypes == [("name", "string"), ("n", "bigint"), ("x", "double"), ("day", "timestamp_ntz"), ("ok", "boolean"), ("mixed", "string"), ("days", "bigint"), ("NAME_28", "bigint")]
    a, b = sorted(map(tuple, df.collect()), key=lambda r: r[1])
    assert a == ("rich text", 7, 1.5, dt.datetime(2020, 2, 29, 6), True, "3", 2, 9) and b == (None, 8, 2.0, dt.datetime(1899, 12, 31), None, "sum", None, None)
    assert [tuple(r) for r in readers.read_table(spark, path, sheet="two").collect()] == [(5, "z")]
    both = spark.read.format("workbook").option("sheet", "*").load(path)
    assert sorted((r.n, r.name) for r in both.collect()) == [(5, "z"), (7, "rich text"), (8, None)]
    given = spark.read.format("workbook").schema("n string, other double, x int").load(path)
    assert sorted(map(tuple, given.collect())) == [("7", None, 1), ("8", None, 2)]
    with pytest.raises(Exception, match="no sheet nine"):
        readers.read_table(spark, path, sheet="nine").count()


def test_text_files_are_split_unless_lines_run_on(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b\n" + "".join(f"{i},x{i}\n" for i in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        df = readers.read_table(spark, str(path), schema=spark.createDataFrame([], "a int, b string").schema)
        assert df.rdd.getNumPartitions() > 2 and df.agg(F.sum("a")).first()[0] == sum(range(20_000))
        path.write_text('a,b\n1,"x\ny"\n')
        assert [tuple(r) for r in readers.read_table(spark, str(path), multi_line=True).collect()] == [(1, "x\ny")]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
