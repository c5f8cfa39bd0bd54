"""Excel workbooks (OOXML) with nothing but a ZIP and an XML reader, and header heuristics."""

from __future__ import annotations

import io
import re
import zipfile
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from cedarloom.functions.names import column_name

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships"}
# Words that speak for a header row, and for a row of sums.
HEADER_WORDS = ["id", "name", "date", "type", "total", "count", "number", "no.", "street", "year", "units"]
SUMMARY_WORDS = ["total", "subtotal", "grand total", "totals", "average", "avg", "summary"]
_DATE_FORMATS = {14, 15, 16, 17, 22}


def workbook(raw: bytes) -> dict[str, list[list]]:
    """Sheets as rows of values: texts, numbers, booleans, dates; None for empty cells."""
    z = zipfile.ZipFile(io.BytesIO(raw))
    xml = lambda n: ElementTree.fromstring(z.read(n)) if n in z.namelist() else None
    shared = [("".join(t.text or "" for t in s.iter(f"{{{_NS['m']}}}t"))) for s in (xml("xl/sharedStrings.xml") or [])]
    dates = set()
    if (st := xml("xl/styles.xml")) is not None:
        own = {f.get("numFmtId"): f.get("formatCode", "") for f in st.findall(".//m:numFmts/m:numFmt", _NS)}
        for i, x in enumerate(st.findall(".//m:cellXfs/m:xf", _NS)):
            n = x.get("numFmtId", "0")
            if int(n) in _DATE_FORMATS or re.search(r"[dmyh]", re.sub(r'"[^"]*"|\[[^\]]*\]', "", own.get(n, "")).lower()):
                dates.add(i)
    rels = {r.get("Id"): r.get("Target") for r in xml("xl/_rels/workbook.xml.rels")}
    out = {}
    for s in xml("xl/workbook.xml").findall(".//m:sheets/m:sheet", _NS):
        target = rels[s.get(f"{{{_NS['r']}}}id")].lstrip("/")
        sheet = xml(target if target.startswith("xl/") else f"xl/{target}")
        rows: dict[int, dict[int, object]] = {}
        for row in sheet.iter(f"{{{_NS['m']}}}row"):
            i = int(row.get("r", len(rows) + 1)) - 1
            own_row = rows.setdefault(i, {})
            for c in row.findall("m:c", _NS):
                letters = re.match(r"[A-Z]+", c.get("r", "")) if c.get("r") else None
                j = sum((ord(ch) - 64) * 26**k for k, ch in enumerate(reversed(letters[0]))) - 1 if letters else len(own_row)
                v, kind = c.find("m:v", _NS), c.get("t", "n")
                if kind == "inlineStr":
                    own_row[j] = "".join(t.text or "" for t in c.iter(f"{{{_NS['m']}}}t"))
                elif v is None or v.text is None:
                    own_row[j] = None
                elif kind == "s":
                    own_row[j] = shared[int(v.text)]
                elif kind == "b":
                    own_row[j] = v.text == "1"
                elif kind in ("str", "e", "d"):
                    own_row[j] = v.text
                elif int(c.get("s", 0)) in dates:
                    own_row[j] = datetime(1899, 12, 30) + timedelta(days=float(v.text))
                else:
                    own_row[j] = float(v.text) if re.search(r"[.eE]", v.text) else int(v.text)
        width = max((max(r, default=-1) + 1 for r in rows.values()), default=0)
        out[s.get("name")] = [[rows.get(i, {}).get(j) for j in range(width)] for i in range(max(rows, default=-1) + 1)]
    return out


def header_row(rows: list[list], most: int = 15) -> int:
    """The row likeliest to be the header: filled, of texts, with numbers below; ties to the first."""
    best, at = 0.0, 0
    for i in range(min(most, len(rows) - 1)):
        row, below = rows[i], rows[i + 1]
        n = len(row) or 1
        filled = sum(v is not None for v in row)
        if filled < n * 0.5:
            continue
        texts = sum(isinstance(v, str) and bool(v.strip()) for v in row)
        numbers = sum((isinstance(v, (int, float)) and v == v) or (isinstance(v, str) and v.strip().replace(".", "").replace("-", "").isdigit()) for v in below)
        score = filled / n * 30 + texts / n * 40 + numbers / n * 30
        if any(w in " ".join(str(v).lower() for v in row if v is not None) for w in HEADER_WORDS):
            score += 20
        if score > best:
            best, at = score, i
    return at


def clean_header(v: object) -> str:
    return "" if v is None or v != v else re.sub(r"\s+", " ", str(v)).strip()


def inferred_name(values: list, position: int) -> str:
    """period, date or id by the values of a column, else column_<position>."""
    have = [v for v in values if v is not None]
    if have and all(isinstance(v, datetime) for v in have):
        return "period"
    if have:
        month, s = "(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)", str(have[0])
        if re.match(rf"(?i)^(?:{month}[- ]?\d{{2,4}}|\d{{2,4}}[- ]?{month}|Q[1-4][- ]?\d{{2,4}}|\d{{4}}[- ]?Q[1-4])$", s):
            return "period"
        if re.match(r"^(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}-\d{2}-\d{4})", s):
            return "date"
        whole = len(have) == len(values) and all(isinstance(v, int) and not isinstance(v, bool) for v in have)
        if whole and (have == sorted(have) or have == sorted(have, reverse=True)):
            return "id"
    return f"column_{position}"


def percent_names(names: list[str]) -> list[str]:
    """Headers that only say percent are named after the last named column before them."""
    out, last, seen = [], "", {}
    for i, n in enumerate(names):
        if re.fullmatch(r"(?i)%(?:[._]\d+)?|pct|percent|percentage", n.strip()):
            base = f"{last}_Pct" if last else f"Percentage_{i}"
            seen[base] = seen.get(base, -1) + 1
            out.append(f"{base}_{seen[base]}" if seen[base] else base)
        else:
            last = n or last
            out.append(n)
    return out


def unique_names(names: list[str]) -> list[str]:
    seen: dict[str, int] = {}
    out = []
    for n in names:
        seen[n] = seen.get(n, -1) + 1
        out.append(f"{n}_{seen[n]}" if seen[n] else n)
    return out


def is_summary(row: list) -> bool:
    text = " ".join(str(v).lower() for v in row if v is not None)
    return any(w in text for w in SUMMARY_WORDS)


def table_of(rows: list[list], header: int | None = None, drop_summary: bool = True) -> pd.DataFrame:
    """A sheet as a table: header found and named, empty rows, nameless empty columns and rows of
    sums dropped, shares in columns named _pct as percentages with one decimal."""
    if not rows:
        return pd.DataFrame()
    at = header_row(rows) if header is None else header
    body = [r for r in rows[at + 1 :] if any(v is not None for v in r)]
    names = percent_names([clean_header(v) for v in rows[at]])
    cols = list(map(list, zip(*body, strict=True))) if body else [[] for _ in names]
    named = [(column_name(n) if n else "", c) for n, c in zip(names, cols, strict=True)]
    keep = [(n, c) for n, c in named if any(v is not None for v in c) or (n and not n.startswith(("column_", "unnamed")))]
    final = unique_names([n or inferred_name(c, i) for i, (n, c) in enumerate(keep)])
    df = pd.DataFrame({n: pd.Series(c, dtype=object) for n, (_, c) in zip(final, keep, strict=True)})
    if drop_summary and len(df):
        df = df[[not is_summary(r) for r in df.itertuples(index=False, name=None)]]
    for c in df.columns:
        if c.lower().endswith("_pct") and all(v is None or isinstance(v, (int, float)) for v in df[c]):
            df[c] = [None if v is None else round(v * 100, 1) for v in df[c]]
    return df.reset_index(drop=True)


def read_xlsx(spark: SparkSession, path: str, sheet: int | str = 0, header: int | None = None) -> DataFrame:
    """One sheet as a table of texts. Workbooks are read whole by one task each; Excel itself bounds
    a sheet to about a million rows. All files of `path` must have the columns of the first."""
    first = spark.read.format("binaryFile").load(path).orderBy("path").select("content").first()
    pick = lambda raw: (lambda b: b[sheet] if isinstance(sheet, str) else list(b.values())[sheet])(workbook(raw))
    names = list(table_of(pick(bytes(first[0])), header).columns)

    def parse(batches):
        for b in batches:
            for raw in b["content"]:
                t = table_of(pick(bytes(raw)), header).reindex(columns=names)
                yield t.map(lambda v: None if v is None or v != v else str(v)) if len(t) else t

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(parse, ", ".join(f"`{n}` string" for n in names))


def read_xlsx_sheets(spark: SparkSession, path: str, header: int | None = None) -> DataFrame:
    """(source_file, sheet, position, fields MAP): all sheets; one that can't be read has no rows."""

    def parse(batches):
        for b in batches:
            for p, raw in zip(b["path"], b["content"], strict=True):
                rows = []
                for name, sheet in workbook(bytes(raw)).items():
                    try:
                        t = table_of(sheet, header, drop_summary=False)
                    except (ValueError, IndexError):
                        continue
                    rows += [(p, name, i, {k: str(v) for k, v in r.items() if v is not None}) for i, r in enumerate(t.to_dict("records"))]
                if rows:
                    yield pd.DataFrame(rows, columns=["source_file", "sheet", "position", "fields"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(parse, "source_file string, sheet string, position int, fields map<string,string>")


def write_xlsx(path: str, tables: dict[str, list[list]]) -> None:
    """Rows of texts, numbers and empty cells, a sheet each, as a workbook."""
    from xml.sax.saxutils import escape, quoteattr

    main, rel = _NS["m"], _NS["r"]
    package = "http://schemas.openxmlformats.org/package/2006/relationships"
    cell = lambda v: "<c/>" if v is None else f"<c><v>{v}</v></c>" if isinstance(v, (int, float)) else f'<c t="inlineStr"><is><t>{escape(str(v))}</t></is></c>'
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        names = "".join(f'<sheet name={quoteattr(n)} sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(tables, 1))
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>{names}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{package}">' + "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(1, len(tables) + 1)) + "</Relationships>")
        for i, rows in enumerate(tables.values(), 1):
            body = "".join(f"<row>{''.join(map(cell, r))}</row>" for r in rows)
            z.writestr(f"xl/worksheets/s{i}.xml", f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>')
