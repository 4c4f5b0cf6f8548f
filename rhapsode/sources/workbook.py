"""A data source for the first sheet of Office Open XML workbooks: spark.read.format("first_sheet").load(path)."""

from __future__ import annotations

import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Fixed value: the spreadsheet namespace.
NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def sheet_rows(file) -> Iterator[dict[str, str]]:
    """The rows of the first sheet by the names in its first row; missing cells are empty."""
    with zipfile.ZipFile(file) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in s.iter(f"{NS}t")) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{NS}si")]
        names: dict[str, str] | None = None
        for row in ElementTree.fromstring(z.read("xl/worksheets/sheet1.xml")).iter(f"{NS}row"):
            cells = {}
            for c in row.iter(f"{NS}c"):
                at = "".join(x for x in c.get("r", "") if x.isalpha())
                kind, value = c.get("t"), c.find(f"{NS}v")
                if kind == "inlineStr":
                    cells[at] = "".join(t.text or "" for t in c.iter(f"{NS}t"))
                elif value is not None:
                    cells[at] = shared[int(value.text)] if kind == "s" else value.text or ""
            if names is None:
                names = {v: k for k, v in cells.items()}
            else:
                yield {name: cells.get(at, "") for name, at in names.items()}


class SheetReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        where, base = fs.FileSystem.from_uri(self.path if ":" in self.path else f"file://{self.path}")
        info = where.get_file_info(base)
        files = [base] if info.is_file else [f.path for f in where.get_file_info(fs.FileSelector(base)) if f.path.endswith(".xlsx")]
        prefix = self.path[: self.path.index(base)] if base in self.path else ""
        return [InputPartition(prefix + f) for f in sorted(files)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        from pyarrow import fs

        path = partition.value
        where, base = fs.FileSystem.from_uri(path if ":" in path else f"file://{path}")
        with where.open_input_file(base) as f:
            for i, row in enumerate(sheet_rows(f), start=2):
                yield path, i, row


class FirstSheet(DataSource):
    """Rows of workbooks: (path, row, cells map<string,string>)."""

    @classmethod
    def name(cls) -> str:
        return "first_sheet"

    def schema(self) -> str:
        return "path string, row int, cells map<string,string>"

    def reader(self, schema) -> SheetReader:
        return SheetReader(self.options["path"])


def frame_cues(rows, name="Video_Name", begin="Begin_Frame", end="End_Frame", text="Subtitle"):
    """(name, row, begin, end, text) of sheet rows: unnamed rows and names that begin with EA are skipped; a frame that is not whole, or below 0, is an error."""
    from pyspark.sql import functions as F

    cell = lambda c: F.coalesce(F.col("cells")[c], F.lit(""))
    named = rows.where((F.trim(cell(name)) != "") & ~F.trim(cell(name)).startswith("EA"))
    number = lambda c: cell(c).try_cast("double")
    ok = lambda x: F.coalesce((x >= 0) & (x == F.floor(x)), F.lit(False))
    whole = lambda c: F.when(ok(number(c)), number(c).cast("long")).otherwise(F.raise_error(F.lit("not a frame number")).cast("long"))
    return named.select(F.trim(cell(name)).alias("name"), "row", whole(begin).alias("begin"), whole(end).alias("end"), cell(text).alias("text"))
