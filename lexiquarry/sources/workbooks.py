"""Workbooks as a Spark data source: tasks write beside the place, the driver moves whole sets into it."""

from __future__ import annotations

import json
import re
import tempfile
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from xml.sax.saxutils import escape

import pyarrow as pa
import pyarrow.fs
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from .answers import filesystem

WIDEST = 50
#: In each folder of workbooks: which of them the last write put there.
MANIFEST = "_workbooks.json"
CELLS = "name string, path string, row long, cells array<string>"
_CELLS = pa.schema([("name", pa.string()), ("path", pa.string()), ("row", pa.int64()), ("cells", pa.list_(pa.string()))])
#: Rows that a batch of read cells holds.
BATCH_ROWS = 10_000


def _column(n: int) -> str:
    name = ""
    while n >= 0:
        n, name = n // 26 - 1, chr(65 + n % 26) + name
    return name


class Workbook:
    """A one-sheet workbook, its rows kept on disk until it is closed."""

    def __init__(self, header: list[str], sheet: str = "Sheet"):
        self.sheet, self.rows, self.widths = sheet[:31], 0, [0] * len(header)
        self.body = tempfile.SpooledTemporaryFile(max_size=8 << 20)
        if header:
            self.append(header)

    def append(self, values: list) -> None:
        self.rows += 1
        cells = []
        for n, value in enumerate(values):
            if value is None:
                continue
            self.widths[n] = max(self.widths[n], len(str(value)))
            at = f"{_column(n)}{self.rows}"
            if isinstance(value, (int, float)) and not isinstance(value, bool):
                cells.append(f'<c r="{at}"><v>{value}</v></c>')
            else:
                text = escape("".join(c for c in str(value) if c in "\t\n\r" or ord(c) >= 32))
                cells.append(f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{text}</t></is></c>')
        self.body.write(f'<row r="{self.rows}">{"".join(cells)}</row>'.encode())

    def save(self, out) -> None:
        main, office = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        package = "http://schemas.openxmlformats.org/package/2006"
        xml = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
        kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("[Content_Types].xml", f'{xml}<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{kind}.worksheet+xml"/></Types>')
            z.writestr("_rels/.rels", f'{xml}<Relationships xmlns="{package}/relationships"><Relationship Id="rId1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
            z.writestr("xl/_rels/workbook.xml.rels", f'{xml}<Relationships xmlns="{package}/relationships"><Relationship Id="rId1" Type="{office}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
            z.writestr("xl/workbook.xml", f'{xml}<workbook xmlns="{main}" xmlns:r="{office}"><sheets><sheet name="{escape(self.sheet, {chr(34): "&quot;"})}" sheetId="1" r:id="rId1"/></sheets></workbook>')
            with z.open("xl/worksheets/sheet1.xml", "w", force_zip64=True) as sheet:
                cols = "".join(f'<col min="{n}" max="{n}" width="{min(w + 2, WIDEST)}" customWidth="1"/>' for n, w in enumerate(self.widths, 1))
                sheet.write(f'{xml}<worksheet xmlns="{main}">{f"<cols>{cols}</cols>" if cols else ""}<sheetData>'.encode())
                self.body.seek(0)
                while piece := self.body.read(1 << 20):
                    sheet.write(piece)
                sheet.write(b"</sheetData></worksheet>")


def rows_of(opened) -> Iterator[list[str | None]]:
    """The rows of a workbook's first sheet, one at a time; cells without a value are null."""
    tag = lambda e: e.tag.rpartition("}")[2]
    with zipfile.ZipFile(opened) as z, z.open("xl/worksheets/sheet1.xml") as sheet:
        for _, row in ET.iterparse(sheet):
            if tag(row) != "row":
                continue
            cells: list[str | None] = []
            for cell in row:
                at = 0
                for c in re.match("[A-Z]+", cell.get("r"))[0]:
                    at = 26 * at + ord(c) - 64
                cells += [None] * (at - 1 - len(cells))
                cells.append("".join(e.text or "" for e in cell.iter() if tag(e) in ("v", "t")))
            yield cells
            row.clear()


@dataclass
class Written(WriterCommitMessage):
    """A task's files: name, where it wrote it, its place in the end, rows."""

    files: list[tuple[str, str, str, int]]


@dataclass
class Book(InputPartition):
    path: str


def _report(base: str, job: str) -> str:
    return f"{base}/_written-{job}.json"


def take_written(folder: str, job: str) -> list[tuple[str, str, int]]:
    """``name, path, rows`` of the files that a write of that job put in place; the note of them goes."""
    files, base = filesystem(folder)
    with files.open_input_stream(_report(base, job)) as f:
        found = json.loads(f.read())
    files.delete_file(_report(base, job))
    return [tuple(x) for x in found]


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], columns: list[str]):
        self.folder, self.by, self.sheet = options["path"], options.get("by"), options.get("sheet", "Sheet")
        self.sheet_rows, self.job = int(options["sheet_rows"]), options["job"]
        self.header = [c for c in columns if c != self.by]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        task = TaskContext.get()
        files, base = filesystem(self.folder)
        own = f"{base}/_writing-{self.job}/{task.partitionId():05d}-{task.taskAttemptId()}"
        made: list[tuple[str, str, str, int]] = []
        book: Workbook | None = None
        name = self.sheet

        def close() -> None:
            files.create_dir(own, recursive=False)
            place = f"{base}/{name}" if self.by else base
            with files.open_output_stream(f"{own}/{len(made):05d}.xlsx", compression=None) as out:
                book.save(out)
            made.append((name, f"{own}/{len(made):05d}.xlsx", f"{place}/{name}-{task.partitionId():05d}-{len(made):03d}-{self.job[:8]}.xlsx", book.rows - 1))

        for batch in iterator:
            groups = batch[self.by].to_pylist() if self.by else [self.sheet] * batch.num_rows
            for group, row in zip(groups, zip(*(batch[c].to_pylist() for c in self.header), strict=True), strict=True):
                if book is not None and (book.rows > self.sheet_rows or group != name):
                    close()
                    book = None
                name = group
                book = book or Workbook(self.header, name)
                book.append(list(row))
        if book is not None:
            close()
        return Written(made)

    def _clear(self, files: pyarrow.fs.FileSystem, base: str) -> None:
        if files.get_file_info(f"{base}/_writing-{self.job}").type == pyarrow.fs.FileType.Directory:
            files.delete_dir(f"{base}/_writing-{self.job}")

    def commit(self, messages: list[Written | None]) -> None:
        files, base = filesystem(self.folder)
        made = [f for m in messages if m is not None for f in m.files]
        places: dict[str, list[str]] = {}
        for _, at, to, _ in made:
            place, _, file = to.rpartition("/")
            if place not in places:
                files.create_dir(place, recursive=True)
            places.setdefault(place, []).append(file)
            files.move(at, to)
        for place, now in places.items():
            before = []
            if files.get_file_info(f"{place}/{MANIFEST}").type == pyarrow.fs.FileType.File:
                with files.open_input_stream(f"{place}/{MANIFEST}") as f:
                    before = json.loads(f.read())
            with files.open_output_stream(f"{place}/{MANIFEST}", compression=None) as out:
                out.write(json.dumps(now).encode())
            for old in before:
                if old not in now and files.get_file_info(f"{place}/{old}").type == pyarrow.fs.FileType.File:
                    files.delete_file(f"{place}/{old}")
        self._clear(files, base)
        files.create_dir(base, recursive=True)
        with files.open_output_stream(_report(base, self.job), compression=None) as out:
            out.write(json.dumps([(name, to, rows) for name, _, to, rows in made]).encode())

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*filesystem(self.folder))


class _Reader(DataSourceReader):
    """A partition for each workbook."""

    def __init__(self, folder: str):
        self.folder = folder

    def partitions(self) -> list[Book]:
        files, base = filesystem(self.folder)
        found = files.get_file_info(pyarrow.fs.FileSelector(base, recursive=True))
        return [Book(i.path) for i in found if i.extension == "xlsx" and "/_writing-" not in i.path] or [Book("")]

    def read(self, partition: Book) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        files, _ = filesystem(self.folder)
        name = re.sub(r"-\d+-\d+-[0-9a-f]+\.xlsx$", "", partition.path.rpartition("/")[2])
        rows: list[tuple] = []
        with files.open_input_file(partition.path) as opened:
            for n, cells in enumerate(rows_of(opened), 1):
                rows.append((name, partition.path, n, cells))
                if len(rows) == BATCH_ROWS:
                    yield self._batch(rows)
                    rows = []
        if rows:
            yield self._batch(rows)

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _CELLS, strict=True)], schema=_CELLS)


class WorkbookSource(DataSource):
    """``workbooks``: writes a table as xlsx files below ``path``, and reads such files row by row."""

    @classmethod
    def name(cls) -> str:
        return "workbooks"

    def schema(self) -> str:
        return CELLS

    def writer(self, schema: StructType, overwrite: bool) -> _Writer:
        return _Writer(dict(self.options), schema.names)

    def reader(self, schema: StructType) -> _Reader:
        return _Reader(self.options["path"])
