"""Workbooks (OOXML spreadsheets), written and read on the executors with the standard library.

A workbook is written by one task as a stream of rows; many workbooks by many tasks. The format
bounds a sheet to SHEET_ROWS rows, so a longer one goes on in further sheets ("name (2)", ...).
Files are written beside their place and moved there when all tasks have ended well; a failed job
leaves what was there before. The folder must be one that executors can write to through Arrow's
file systems (a mounted folder, S3, GCS, HDFS).
"""

from __future__ import annotations

import io
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from gondola.sources.shared import dealt, ship

#: Fixed values of the format.
SHEET_ROWS = 1_048_576
CELL_CHARACTERS = 32_767
NAME_CHARACTERS = 31
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_LINKS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'

#: What is written: a row of a sheet of a workbook, as XML. Sheets stand by place, rows by row.
ROWS = "book string, place int, sheet string, row long, xml string"
_CONTROLS = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]")


def _cell(cell) -> str:
    if cell is None or cell["text"] is None:
        return "<c/>"
    if cell["number"]:
        return f"<c><v>{cell['text']}</v></c>"
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(_CONTROLS.sub("", cell["text"])[:CELL_CHARACTERS])}</t></is></c>'


def _row_xml(cells: Column) -> Column:
    """A row of cells (text, number) as _Book.add writes it, made by Spark: Python then handles one text a row."""
    clean = lambda t: F.substring(F.regexp_replace(t, r"[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]", ""), 1, CELL_CHARACTERS)
    safe = lambda t: F.replace(F.replace(F.replace(t, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    number = lambda c: F.concat(F.lit("<c><v>"), c["text"], F.lit("</v></c>"))
    text = lambda c: F.concat(F.lit('<c t="inlineStr"><is><t xml:space="preserve">'), safe(clean(c["text"])), F.lit("</t></is></c>"))
    shown = F.transform(cells, lambda c: F.when(c["text"].isNull(), F.lit("<c/>")).when(c["number"], number(c)).otherwise(text(c)))
    return F.concat(F.lit("<row>"), F.array_join(shown, ""), F.lit("</row>"))


class _Book:
    """A workbook that is being written: sheets one after the other, each a stream of rows."""

    def __init__(self, out, sheet_rows: int = SHEET_ROWS):
        self.zip, self.sheet_rows = zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, compresslevel=1), sheet_rows
        self.names, self.sheet, self.at, self.part = [], None, None, 0

    def _open(self, name: str) -> None:
        self._close()
        shown = re.sub(r"[\\/?*\[\]:]", "_", name)[:NAME_CHARACTERS] or "_"
        k = 1
        while shown.lower() in (n.lower() for n in self.names):
            k += 1
            shown = re.sub(r"[\\/?*\[\]:]", "_", name)[: NAME_CHARACTERS - len(f" ({k})")] + f" ({k})"
        self.names.append(shown)
        self.sheet = self.zip.open(f"xl/worksheets/sheet{len(self.names)}.xml", "w", force_zip64=True)
        self.sheet.write(f'{_HEAD}<worksheet xmlns="{_MAIN}"><sheetData>'.encode())
        self.written = 0

    def _close(self) -> None:
        if self.sheet is not None:
            self.sheet.write(b"</sheetData></worksheet>")
            self.sheet.close()
            self.sheet = None

    def add(self, place: int, name: str, cells) -> None:
        self.add_xml(place, name, f"<row>{''.join(map(_cell, cells))}</row>")

    def add_xml(self, place: int, name: str, row: str) -> None:
        if (place, name) != self.at:
            self.at = (place, name)
            self._open(name)
        elif self.written == self.sheet_rows:
            self._open(name)
        self.sheet.write(row.encode())
        self.written += 1

    def close(self) -> None:
        self._close()
        if not self.names:
            self._open("_")
            self._close()
        each = list(enumerate(self.names, 1))
        sheets = "".join(f'<sheet name="{escape(n, {chr(34): "&quot;"})}" sheetId="{k}" r:id="rId{k}"/>' for k, n in each)
        links = "".join(f'<Relationship Id="rId{k}" Type="{_LINKS}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k, _ in each)
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for k, _ in each)
        parts = {
            "xl/workbook.xml": f'<workbook xmlns="{_MAIN}" xmlns:r="{_LINKS}"><sheets>{sheets}</sheets></workbook>',
            "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{_PACKAGE}/relationships">{links}</Relationships>',
            "_rels/.rels": f'<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="rId1" Type="{_LINKS}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
            "[Content_Types].xml": f'<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
            f'<Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{kinds}</Types>',
        }
        for name, text in parts.items():
            self.zip.writestr(name, _HEAD + text)
        self.zip.close()


def _file_system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


@dataclass
class _Written(WriterCommitMessage):
    files: list


class _BookWriter(DataSourceWriter):
    def __init__(self, path: str, overwrite: bool, run: str):
        self.path, self.overwrite, self.run = path, overwrite, run

    def _folder(self, files, folder: str) -> str:
        return f"{folder}/_writing-{self.run}"

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        from pyspark import TaskContext

        files, folder = _file_system(self.path)
        own = self._folder(files, folder)
        files.create_dir(own, recursive=True)
        done, name, book, out = [], None, None, None
        for r in iterator:
            if r["book"] != name:
                if book is not None:
                    book.close()
                    out.close()
                name = r["book"]
                temporary = f"{own}/{TaskContext.get().taskAttemptId()}-{len(done)}.xlsx"
                out = files.open_output_stream(temporary)
                book = _Book(out)
                done.append((temporary, name))
            book.add_xml(r["place"], r["sheet"], r["xml"])
        if book is not None:
            book.close()
            out.close()
        return _Written(done)

    def commit(self, messages) -> None:
        files, folder = _file_system(self.path)
        if self.overwrite:
            from pyarrow import fs

            for old in files.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
                if old.path.endswith(".xlsx"):
                    files.delete_file(old.path)
        for m in messages:
            for temporary, name in m.files if m is not None else ():
                files.move(temporary, f"{folder}/{re.sub(r'[^A-Za-z0-9_. -]', '_', name)}.xlsx")
        self.abort(messages)

    def abort(self, messages) -> None:
        files, folder = _file_system(self.path)
        from pyarrow import fs

        if files.get_file_info(self._folder(files, folder)).type == fs.FileType.Directory:
            files.delete_dir(self._folder(files, folder))


class WorkbookSource(DataSource):
    """spark.write.format("workbook"): rows as ROWS, sorted by book, place and row in their partitions."""

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> str:
        return ROWS

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _BookWriter(self.options["path"], overwrite, uuid.uuid4().hex)


def sheet(rows: DataFrame, book: Column, place: int, name: Column, order: list[str], hidden: tuple[str, ...] = ()) -> DataFrame:
    """rows as rows of a sheet (ROWS) below the columns' names; book and name are columns, so a table can be many sheets.

    order: columns that say how rows stand (ties by their cells). hidden: columns that are no cells.
    A name without rows makes no sheet.
    """
    shown = [f for f in rows.schema.fields if f.name not in hidden]
    number = lambda f: f.dataType.typeName() in ("byte", "short", "integer", "long", "float", "double") or f.dataType.typeName().startswith("decimal")
    cells = F.array(*[F.struct(F.col(f"`{f.name}`").cast("string").alias("text"), F.lit(number(f)).alias("number")) for f in shown])
    titles = F.array(*[F.struct(F.lit(f.name).alias("text"), F.lit(False).alias("number")) for f in shown])
    said = rows.select(book.alias("book"), F.lit(place).alias("place"), name.alias("sheet"), *[F.col(c).alias(f"_by{k}") for k, c in enumerate(order)], cells.alias("cells"))
    by = [F.col(f"_by{k}").asc_nulls_first() for k in range(len(order))]
    # a sheet is one task's work, as a workbook is: the format bounds it
    body = said.select("book", "place", "sheet", F.row_number().over(Window.partitionBy("book", "sheet").orderBy(*by, "cells")).cast("long").alias("row"), "cells")
    heads = said.select("book", "place", "sheet").distinct()
    return heads.select("*", F.lit(0).cast("long").alias("row"), titles.alias("cells")).unionByName(body)


def write_books(sheets: list[DataFrame], path: str) -> None:
    """Sheets (made by sheet) of any number of workbooks to a folder of .xlsx files, named by book."""
    spark = sheets[0].sparkSession
    ship(spark)
    spark.dataSource.register(WorkbookSource)
    every = reduce(DataFrame.unionByName, sheets).select("book", "place", "sheet", "row", _row_xml(F.col("cells")).alias("xml"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    every.repartition(parts, "book").sortWithinPartitions("book", "place", "sheet", "row").write.format("workbook").mode("overwrite").option("path", path).save()


def _column(reference: str) -> int:
    """Place of a cell's column: A1 is 0, AB7 is 27."""
    n = 0
    for c in re.match("[A-Za-z]+", reference)[0].upper():
        n = 26 * n + ord(c) - 64
    return n - 1


_tag = lambda e: e.tag.rpartition("}")[2]
_text_of = lambda e: "".join(t.text or "" for t in e.iter() if _tag(t) == "t")


def _packed(raw: bytes, z: zipfile.ZipFile, name: str) -> tuple[bytes, bool]:
    """A part of a workbook as it lies in the file, and whether it is deflated."""
    info = z.getinfo(name)
    if info.compress_type not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
        return z.read(name), False
    at = info.header_offset
    names, extra = struct.unpack("<HH", raw[at + 26 : at + 30])
    begin = at + 30 + names + extra
    return raw[begin : begin + info.compress_size], info.compress_type == zipfile.ZIP_DEFLATED


def _elements(packed: bytes, deflated: bool) -> Iterator:
    """The elements of an XML part at their ends, parsed as a stream."""
    parser, inflate = ElementTree.XMLPullParser(), zlib.decompressobj(-15)
    for at in range(0, len(packed), 1 << 16):
        chunk = packed[at : at + (1 << 16)]
        parser.feed(inflate.decompress(chunk) if deflated else chunk)
        yield from (e for _, e in parser.read_events())
    parser.feed(inflate.flush() if deflated else b"")
    parser.close()
    yield from (e for _, e in parser.read_events())


def parts_of(raw: bytes) -> Iterator[tuple[int, str, bytes, bool, bytes | None, bool]]:
    """place (from 0), name, XML, whether it is deflated, and the shared texts' XML (None: there are none) with that, of every sheet of a workbook."""
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        shared = _packed(raw, z, "xl/sharedStrings.xml") if "xl/sharedStrings.xml" in z.namelist() else (None, False)
        links = {e.get("Id"): e.get("Target") for e in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        listed = [e for e in ElementTree.fromstring(z.read("xl/workbook.xml")).iter() if _tag(e) == "sheet"]
        for place, e in enumerate(listed):
            target = links[e.get(f"{{{_LINKS}}}id")].lstrip("/")
            yield place, e.get("name"), *_packed(raw, z, target if target.startswith("xl/") else f"xl/{target}"), *shared


def rows_of(packed: bytes, deflated: bool, shared_packed: bytes | None, shared_deflated: bool) -> Iterator[tuple[int, list]]:
    """row (from 0) and texts of every row of a sheet, parsed as a stream."""
    shared = []
    for e in _elements(shared_packed, shared_deflated) if shared_packed is not None else ():
        if _tag(e) == "si":
            shared.append(_text_of(e))
            e.clear()
    row = 0
    for r in _elements(packed, deflated):
        if _tag(r) != "row":
            continue
        texts: list = []
        for c in r:
            if _tag(c) != "c":
                continue
            at = _column(c.get("r")) if c.get("r") else len(texts)
            texts += [None] * (at - len(texts))
            value = next((v.text for v in c if _tag(v) == "v"), None)
            texts.append(_text_of(c) if c.get("t") == "inlineStr" else shared[int(value)] if c.get("t") == "s" and value is not None else value)
        yield row, texts
        row += 1
        r.clear()


def sheet_rows(raw: bytes) -> Iterator[tuple[int, str, int, list]]:
    """place (from 0), name, row (from 0) and texts of every row of every sheet of a workbook, parsed as a stream."""
    for place, name, *parts in parts_of(raw):
        for row, texts in rows_of(*parts):
            yield place, name, row, texts


def _sheets(batches):
    """Of every file its sheets, as they lie there."""
    kinds = [pa.string(), pa.int32(), pa.string(), pa.binary(), pa.bool_(), pa.binary(), pa.bool_()]
    names = ["path", "place", "sheet", "xml", "deflated", "shared", "shared_deflated"]
    for b in batches:
        for path, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            for found in parts_of(raw):
                yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip((path, *found), kinds, strict=True)], names)


def _parsed(batches):
    names = ["path", "place", "sheet", "row", "cells"]
    for b in batches:
        for k in range(b.num_rows):
            path, place, name, *parts = (c[k].as_py() for c in b.columns)
            held: list = []
            for row, texts in rows_of(*parts):
                held.append((path, place, name, row, texts))
                if len(held) == 4096:
                    yield _batch(held, names)
                    held = []
            if held:
                yield _batch(held, names)


def _batch(rows: list, names: list[str]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int32(), pa.string(), pa.int64(), pa.list_(pa.string())]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], names)


def read_books(spark: SparkSession, path: str) -> DataFrame:
    """path, place, sheet, row (from 0), cells (texts) of all rows of all workbooks of a folder; a file is opened by one task, each sheet of it parsed by its own."""
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path).select("path", "content")
    sheets = files.mapInArrow(_sheets, "path string, place int, sheet string, xml binary, deflated boolean, shared binary, shared_deflated boolean")
    return dealt(sheets, "path", "place").mapInArrow(_parsed, "path string, place int, sheet string, row long, cells array<string>")


def table_of(rows: DataFrame, columns: list[str]) -> DataFrame:
    """path, sheet and columns (as texts) of read_books' rows below each sheet's first, which has the columns' names."""
    heads = F.broadcast(rows.where("row = 0").select("path", "place", F.col("cells").alias("_head")))  # a row a sheet, and a file has few
    at = lambda c: F.array_position("_head", c).cast("int")
    held = rows.where("row > 0").join(heads, ["path", "place"])
    return held.select("path", "sheet", *[F.when(at(c) > 0, F.get("cells", at(c) - 1)).alias(c) for c in columns])
