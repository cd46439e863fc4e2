"""Workbooks, read and written with the standard library.

A workbook is one zip file, so it is read whole by one task; many workbooks are
read in parallel. Numbers of rows come from the sheet itself.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _column(ref: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def sheet_rows(data: bytes, sheet: str | None = None) -> Iterator[tuple[int, list[str | None]]]:
    """(row number from 1, values as text) of the named sheet, else the first."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        sheets = {s.get("name"): s.get(REL) for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{NS}sheet")}
        if sheet is not None and sheet not in sheets:
            raise ValueError(f"no sheet named {sheet}")
        rels = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        target = rels[sheets[sheet] if sheet is not None else next(iter(sheets.values()))]
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{NS}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{NS}si")]
        with z.open(target.lstrip("/") if target.startswith("/") else f"xl/{target}") as f:
            for _, row in ElementTree.iterparse(f):
                if row.tag != f"{NS}row":
                    continue
                values: list[str | None] = []
                for i, c in enumerate(row.iter(f"{NS}c")):
                    at = _column(c.get("r")) if c.get("r") else i
                    values += [None] * (at + 1 - len(values))
                    v, kind = c.find(f"{NS}v"), c.get("t")
                    if kind == "inlineStr":
                        values[at] = "".join(t.text or "" for t in c.iter(f"{NS}t"))
                    elif v is not None and v.text is not None:
                        values[at] = shared[int(v.text)] if kind == "s" else v.text
                yield int(row.get("r") or 0), values
                row.clear()


def read_xlsx(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """Rows of workbooks under ``path`` as text, with source_workbook and source_row, the sheet's own row number (2 for the first).

    The header row of the first file names the columns; rows without any value
    are left out. A missing file or sheet and an empty workbook are errors.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    first = files.orderBy("path").first()
    if first is None:
        raise FileNotFoundError(path)
    header = next((v for _, v in sheet_rows(bytes(first.content), sheet)), None)
    if not header:
        raise ValueError(f"empty workbook: {first.path}")
    names = [c or f"column_{i + 1}" for i, c in enumerate(header)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for where, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows = [(n, v) for i, (n, v) in enumerate(sheet_rows(content, sheet)) if i and any(x is not None for x in v)]
                cells = [[v[i] if i < len(v) else None for _, v in rows] for i in range(len(names))]
                yield pa.RecordBatch.from_arrays([pa.array([where.rpartition("/")[2]] * len(rows), pa.string()), pa.array([n for n, _ in rows], pa.int64()), *(pa.array(c, pa.string()) for c in cells)], ["source_workbook", "source_row", *names])

    quoted = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    return files.mapInArrow(run, f"source_workbook string, source_row bigint, {quoted}")


def _cell(value: object) -> str:
    if value is None:
        return "<c/>"
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return f"<c><v>{value!r}</v></c>"
    text = escape(re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "", str(value)))
    return f'<c t="inlineStr"><is><t xml:space="preserve">{text}</t></is></c>'


def write_xlsx(sheets: dict[str, DataFrame], path: str, most_rows: int = 1_048_576) -> None:
    """One workbook of the named sheets, in a local file. Rows stream through the driver one partition at a time; a sheet holds ``most_rows`` at most, more are an error."""
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    pkg = "http://schemas.openxmlformats.org/package/2006"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
        parts = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{kind}.worksheet+xml"/>' for i in range(1, len(sheets) + 1))
        z.writestr("[Content_Types].xml", f'<Types xmlns="{pkg}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/>{parts}</Types>')
        z.writestr("_rels/.rels", f'<Relationships xmlns="{pkg}/relationships"><Relationship Id="r1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>' + "".join(f'<sheet name="{escape(n)}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets, 1)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{pkg}/relationships">' + "".join(f'<Relationship Id="r{i}" Type="{rel}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1)) + "</Relationships>")
        for i, df in enumerate(sheets.values(), 1):
            with z.open(f"xl/worksheets/sheet{i}.xml", "w", force_zip64=True) as f:
                f.write(f'<worksheet xmlns="{main}"><sheetData><row r="1">{"".join(map(_cell, df.columns))}</row>'.encode())
                for n, row in enumerate(df.toLocalIterator(), 2):
                    if n > most_rows:
                        raise ValueError(f"a sheet holds {most_rows} rows at most; write Parquet or CSV")
                    f.write(f'<row r="{n}">{"".join(map(_cell, row))}</row>'.encode())
                f.write(b"</sheetData></worksheet>")


def named_source(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn("source_workbook", F.lit(name))
