"""Small option sheets in Excel's XML format, read without a library."""

from __future__ import annotations

import io
import re
import zipfile
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession

#: Fixed value: the name space of sheets.
_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"

#: Bytes of a sheet at most: it is read on the driver.
MOST_BYTES = 16 << 20


def _column(reference: str) -> int:
    """0 for A, 25 for Z, 26 for AA."""
    n = 0
    for c in re.match(r"[A-Z]+", reference)[0]:
        n = 26 * n + ord(c) - 64
    return n - 1


def sheet_rows(content: bytes) -> list[list]:
    """Cells of the first sheet: numbers, booleans, texts and None, in rows of one length."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = z.namelist()
        texts = []
        if "xl/sharedStrings.xml" in names:
            texts = ["".join(t.text or "" for t in item.iter(_NS + "t")) for item in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(_NS + "si")]
        sheets = sorted((n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.search(r"\d+", n)[0]))
        root = ElementTree.fromstring(z.read(sheets[0]))
    rows = []
    for row in root.iter(_NS + "row"):
        cells: dict[int, object] = {}
        for k, cell in enumerate(row.iter(_NS + "c")):
            at = _column(cell.get("r")) if cell.get("r") else k
            value, kind = cell.findtext(_NS + "v"), cell.get("t", "n")
            if kind == "s":
                cells[at] = texts[int(value)]
            elif kind == "inlineStr":
                cells[at] = "".join(t.text or "" for t in cell.iter(_NS + "t"))
            elif kind == "b":
                cells[at] = value == "1"
            elif kind == "n":
                cells[at] = None if value is None else float(value)
            else:
                cells[at] = value
        rows.append(cells)
    width = max((max(r, default=-1) for r in rows), default=-1) + 1
    return [[r.get(i) for i in range(width)] for r in rows]


def read_sheet(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The columns of ``schema`` from the first sheet of a workbook; its first row names them.

    Meant for tables of options, a row a region; a workbook beyond ``MOST_BYTES`` is an
    error. Columns that ``schema`` does not name are left out, missing ones are null."""
    found = spark.read.format("binaryFile").load(path).select("length", "content").where(f"length <= {MOST_BYTES}").head()
    if found is None:
        raise ValueError(f"{path} is no option sheet: larger than {MOST_BYTES} bytes, or not there")
    head, *rows = sheet_rows(bytes(found["content"])) or [[]]
    wanted = spark.createDataFrame([], schema).schema

    def typed(value, kind: str):
        if value is None or value == "":
            return None
        if kind in ("bigint", "int"):
            return int(float(value))
        if kind == "boolean":
            return value if isinstance(value, bool) else str(value).strip().lower() in ("1", "1.0", "true", "yes")
        if kind == "double":
            return float(value)
        return str(int(value)) if isinstance(value, float) and value.is_integer() else str(value)

    at = {str(name): i for i, name in enumerate(head)}
    data = [tuple(typed(r[at[f.name]], f.dataType.simpleString()) if f.name in at else None for f in wanted) for r in rows if any(v is not None for v in r)]
    return spark.createDataFrame(data, wanted)
