"""Workbooks (xlsx) as a Spark data source: spark.read.format("workbook").option("sheet", 0).load(path).

A sheet is a partition, read row by row. Its first row names the columns; types are those of
all its cells: whole numbers, numbers, truth values, dates by their style, and text for what is mixed.
"""

from __future__ import annotations

import datetime as dt
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from cohortica.sources.spss import opened

#: Fixed values of the format: numbers of the built-in styles that show dates or times.
DATE_STYLES = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
_RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _tag(e: ElementTree.Element) -> str:
    return e.tag.rpartition("}")[2]


def _each(book: zipfile.ZipFile, part: str, name: str) -> Iterator[ElementTree.Element]:
    """Elements of a part by name, each freed once it was seen."""
    if part not in book.namelist():
        return
    with book.open(part) as f:
        root = None
        for event, e in ElementTree.iterparse(f, ("start", "end")):
            root = e if root is None else root
            if event == "end" and _tag(e) == name:
                yield e
                e.clear()
                # the parser is ahead of what was seen, so parents let go of elements, but those aren't emptied
                for parent in [root] if name == "si" else [c for c in root if _tag(c) == "sheetData"] if name == "row" else []:
                    parent.clear()


def _text(e: ElementTree.Element) -> str:
    """Its runs of text together, without the reading aids of rich text; _xHHHH_ stands for a character."""
    if _tag(e) == "rPh":
        return ""
    return re.sub("_x([0-9A-Fa-f]{4})_", lambda m: chr(int(m[1], 16)), e.text or "") if _tag(e) == "t" else "".join(_text(c) for c in e)


class Book:
    """What all sheets of a workbook share: their names and parts, strings, styles and the first day."""

    def __init__(self, f):
        self.zip = zipfile.ZipFile(f)
        parts = {e.get("Id"): e.get("Target") for e in _each(self.zip, "xl/_rels/workbook.xml.rels", "Relationship")}
        full = lambda t: t.lstrip("/") if t.startswith("/") else f"xl/{t}"
        self.sheets = [(e.get("name"), full(parts[e.get(_RELATION)])) for e in _each(self.zip, "xl/workbook.xml", "sheet")]
        late = any(e.get("date1904") in ("1", "true") for e in _each(self.zip, "xl/workbook.xml", "workbookPr"))
        self.first_day = dt.datetime(1904, 1, 1) if late else dt.datetime(1899, 12, 30)
        own = {e.get("numFmtId"): re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", e.get("formatCode", "")) for e in _each(self.zip, "xl/styles.xml", "numFmt")}
        dated = {*map(str, DATE_STYLES - {int(i) for i in own}), *(i for i, code in own.items() if re.search("[dmyhs]", code, re.I) and code.lower() != "general")}
        formats = [[x.get("numFmtId") in dated for x in e] for e in _each(self.zip, "xl/styles.xml", "cellXfs")]
        self.dated = formats[0] if formats else []
        self.strings = [_text(e) for e in _each(self.zip, "xl/sharedStrings.xml", "si")]

    def pick(self, sheet: str) -> list[int]:
        """Numbers of the sheets that a name, a number or * (all of them) means."""
        names = [n for n, _ in self.sheets]
        if sheet == "*":
            return list(range(len(names)))
        if sheet in names:
            return [names.index(sheet)]
        if sheet.isdigit() and int(sheet) < len(names):
            return [int(sheet)]
        raise ValueError(f"no sheet {sheet} among {names}")

    def rows(self, sheet: int) -> Iterator[dict[int, object]]:
        """Of each row that has a value, its values by column, from 0."""
        for row in _each(self.zip, self.sheets[sheet][1], "row"):
            out, at = {}, -1
            for c in row:
                letters = re.match("[A-Z]*", c.get("r", ""))[0]
                at = at + 1
                if letters:
                    at = 0
                    for x in letters:
                        at = at * 26 + ord(x) - 64
                    at -= 1
                value = self._value(c)
                if value is not None:
                    out[at] = value
            if out:
                yield out

    def _value(self, c: ElementTree.Element) -> object:
        kind, held = c.get("t", "n"), {_tag(e): e for e in c}
        if kind == "inlineStr":
            return _text(held["is"]) if "is" in held else None
        raw = held["v"].text if "v" in held else None
        if raw is None or kind == "e":
            return None
        if kind == "s":
            return self.strings[int(raw)]
        if kind == "b":
            return raw == "1"
        if kind == "d":
            return dt.datetime.fromisoformat(raw.removesuffix("Z"))
        if kind == "str":
            return raw
        style = int(c.get("s", 0))
        number = float(raw)
        if style < len(self.dated) and self.dated[style]:
            return self.first_day + dt.timedelta(microseconds=round(number * 86_400_000) * 1000)
        return int(number) if number.is_integer() and abs(number) < 2**53 else number


def header(row: dict[int, object]) -> dict[int, str]:
    """Names by column; a repeated name, in whatever case, gets its column's number."""
    out, seen = {}, set()
    for i in sorted(row):
        name = str(row[i])
        name = name if name.lower() not in seen else f"{name}_{i + 1}"
        seen.add(name.lower())
        out[i] = name
    return out


def converted(value: object, kind: T.DataType) -> object:
    """A cell as a column's type; null where it can't be."""
    if value is None:
        return None
    if isinstance(kind, T.StringType):
        return ("true" if value else "false") if isinstance(value, bool) else value.isoformat(" ") if isinstance(value, dt.datetime) else str(value)
    if isinstance(kind, T.BooleanType):
        return value if isinstance(value, bool) else None
    if isinstance(kind, T.DateType):
        return value.date() if isinstance(value, dt.datetime) else None
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return value if isinstance(value, dt.datetime) else None
    if isinstance(value, dt.datetime):
        return None
    try:
        return int(value) if isinstance(kind, T.IntegralType) else float(value)
    except (ValueError, OverflowError):
        return None


def types_of(rows: Iterator[dict[int, object]], names: dict[int, str]) -> T.StructType:
    met: dict[int, set] = {i: set() for i in names}
    for row in rows:
        for i in row.keys() & met.keys():
            met[i].add(type(row[i]))

    def kind(of: set) -> T.DataType:
        if of == {bool}:
            return T.BooleanType()
        if of == {dt.datetime}:
            return T.TimestampNTZType()
        return T.LongType() if of == {int} else T.DoubleType() if of and of <= {int, float} else T.StringType()

    return T.StructType([T.StructField(names[i], kind(met[i])) for i in sorted(names)])


class Sheet(InputPartition):
    def __init__(self, number: int):
        super().__init__(number)
        self.number = number


class WorkbookReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType, sheet: str):
        self.path, self.schema, self.sheet = path, schema, sheet

    def partitions(self) -> list[InputPartition]:
        with opened(self.path) as f:
            return [Sheet(i) for i in Book(f).pick(self.sheet)]

    def read(self, partition: Sheet) -> Iterator[tuple]:
        with opened(self.path) as f:
            rows = Book(f).rows(partition.number)
            column = {name: i for i, name in header(next(rows, {})).items()}
            wanted = [(column.get(x.name, -1), x.dataType) for x in self.schema.fields]
            for row in rows:
                yield tuple(converted(row.get(i), kind) for i, kind in wanted)


class WorkbookSource(DataSource):
    """Option sheet: a name, a number from 0, or * for all sheets, each a partition; columns are the first one's, and null where another lacks them.

    Rows without a value are left out, as are errors and columns without a name. Without a schema, all rows are
    looked at for types; a given schema spares that.
    """

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def _sheet(self) -> str:
        return self.options.get("sheet", "0")

    def schema(self) -> T.StructType:
        with opened(self.options["path"]) as f:
            book = Book(f)
            chosen = book.pick(self._sheet())
            names = header(next(book.rows(chosen[0]), {}))
            place = {name: i for i, name in names.items()}

            def all_rows() -> Iterator[dict[int, object]]:
                for s in chosen:
                    rows = book.rows(s)
                    own = header(next(rows, {}))
                    for row in rows:
                        yield {place[own[i]]: v for i, v in row.items() if own.get(i) in place}

            return types_of(all_rows(), names)

    def reader(self, schema: T.StructType) -> WorkbookReader:
        return WorkbookReader(self.options["path"], schema, self._sheet())
