"""Text formats: CSV, JSON and GeoJSON, XML, delimited or fixed-width text, ZIP archives."""

from __future__ import annotations

import os
import re
import zipfile
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cedarloom.functions.names import column_name

ENCODINGS = ["utf-8", "iso-8859-1", "windows-1252", "utf-16"]
# Keys that hold the records of a document, in the order they are tried.
LIST_KEYS = ["records", "data", "items", "results", "rows", "values"]


# Bytes are read one to one and decoded value by value, so that every file and every value has the
# encoding it is in, however far into the file it stands.
_HIGH = {i: bytes([i]).decode("cp1252", "ignore") for i in range(0x80, 0xA0)}
_C1, _SIGNS = "".join(chr(i) for i, t in _HIGH.items() if t), "".join(_HIGH.values())


def decoded(c: str) -> str:
    """SQL: a text read as Latin-1, as what its bytes say: UTF-8 if they are, else Windows-1252."""
    raw = f"encode({c}, 'ISO-8859-1')"
    return f"case when {c} rlike r'[^\x00-\x7f]' then case when is_valid_utf8(cast({raw} as string)) then cast({raw} as string) else translate({c}, '{_C1}', '{_SIGNS}') end else {c} end"


def _decoded_line(c: str) -> str:
    """The same of a line of a text source, whose bytes Spark keeps as they are."""
    return f"case when is_valid_utf8({c}) then {c} else translate(decode(cast({c} as binary), 'ISO-8859-1'), '{_C1}', '{_SIGNS}') end"


def _name(name: str) -> str:
    raw = name.encode("latin-1", "replace")
    try:
        return raw.decode().removeprefix("\ufeff")
    except UnicodeDecodeError:
        return raw.decode("cp1252", "replace")


def _is_utf16(spark: SparkSession, path: str) -> bool:
    """Whether the file, or the first of the folder, begins with the mark of UTF-16."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):  # a pattern: left to Spark
        return False
    if fs.getFileStatus(at).isDirectory():
        files = sorted(str(f.getPath()) for f in fs.listStatus(at) if f.isFile() and not f.getPath().getName().startswith(("_", ".")))
        if not files:
            return False
        at = jvm.org.apache.hadoop.fs.Path(files[0])
    stream = fs.open(at)
    try:
        return (stream.read(), stream.read()) in ((0xFF, 0xFE), (0xFE, 0xFF))
    finally:
        stream.close()


def encoding_of(path: str) -> str:
    """The encoding of one local file, all of it: UTF-16 with its mark, UTF-8 if it decodes, else Latin-1."""
    import codecs

    check = codecs.getincrementaldecoder("utf-8")()
    with open(path, "rb") as f:
        first = chunk = f.read(1 << 20)
        if first[:2] in (b"\xff\xfe", b"\xfe\xff"):
            return "utf-16"
        try:
            while chunk:
                check.decode(chunk)
                chunk = f.read(1 << 20)
            check.decode(b"", final=True)
            return "utf-8"
        except UnicodeDecodeError:
            return "iso-8859-1"


_BAD = "_malformed"


def _csv(spark: SparkSession, path: str, sep: str, encoding: str | None, infer: bool) -> DataFrame:
    """All lines, those that are malformed in the column _malformed."""
    enc = encoding or ("utf-16" if _is_utf16(spark, path) else "ISO-8859-1")
    # lines of UTF-16 can't be found before it is decoded: such files are not split
    read = spark.read.options(header=True, inferSchema=infer, sep=sep, encoding=enc, multiLine=enc.startswith("utf-16"), columnNameOfCorruptRecord=_BAD)
    schema = read.csv(path).schema
    df = read.schema(schema.add(_BAD, "string")).csv(path)
    if encoding is None and enc == "ISO-8859-1":
        df = df.selectExpr(*[(f"{decoded(f'`{c}`')} as `{_name(c)}`" if t == "string" else f"`{c}` as `{_name(c)}`") for c, t in df.dtypes])
    return df


def _parsed(df: DataFrame) -> str:
    """True of every row; it reads all columns, as Spark can't tell malformed lines by some."""
    return f"not length(concat_ws('', {', '.join(f'cast(`{c}` as string)' for c in df.columns if c != _BAD) or chr(39) * 2})) <=> -1"


def read_csv(spark: SparkSession, path: str, sep: str = ",", encoding: str | None = None, infer: bool = True) -> DataFrame:
    """With header, types inferred; empty fields are null. Without an encoding every value is decoded
    by its own bytes. Lines that are malformed (see malformed) are left out."""
    df = _csv(spark, path, sep, encoding, infer)
    return df.where(f"{_BAD} is null and {_parsed(df)}").drop(_BAD)


def malformed(spark: SparkSession, path: str, sep: str = ",", encoding: str | None = None) -> DataFrame:
    """(line): the lines read_csv leaves out, as they stand in the file: too many or too few fields, or
    values that have not the type of the others."""
    df = _csv(spark, path, sep, encoding, True)
    return df.where(f"{_BAD} is not null and {_parsed(df)}").select(F.col(_BAD).alias("line"))


def json_structure(v: str) -> str:
    """array, geojson, records, data, ckan, object or unknown, of a variant expression."""
    kind = lambda p: f"coalesce(schema_of_variant(try_variant_get({v}, '$.{p}', 'variant')), '')"
    return f"""case when {v} is null then 'unknown' when schema_of_variant({v}) like 'ARRAY%' then 'array'
        when try_variant_get({v}, '$.type', 'string') = 'FeatureCollection' or {kind('features')} like 'ARRAY%' then 'geojson'
        when {kind('records')} like 'ARRAY%' then 'records' when {kind('data')} like 'ARRAY%' then 'data'
        when {kind('result')} != '' then 'ckan' when schema_of_variant({v}) like 'OBJECT%' then 'object' else 'unknown' end"""


def record_list(v: str) -> str:
    """The records of a JSON document as an array of variants, by its shape: the list itself, the
    features of a collection, the first list under a usual key, that under result, else itself."""
    get = lambda p: f"try_variant_get({v}, '$.{p}', 'array<variant>')"
    keys = [get(k) for k in ["features", *LIST_KEYS, "result", *(f"result.{k}" for k in LIST_KEYS[:3])]]
    wrapped = f"case when try_variant_get({v}, '$.success', 'boolean') is not null then get(filter(map_values(try_variant_get({v}, '$', 'map<string,variant>')), x -> schema_of_variant(x) like 'ARRAY%'), 0)::array<variant> end"
    own = f"case when schema_of_variant({v}) like 'OBJECT%' then array({v}) else cast(array() as array<variant>) end"
    return f"coalesce(try_variant_get({v}, '$', 'array<variant>'), {', '.join(keys)}, {wrapped}, {own})"


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, structure, record VARIANT): one row a record, whatever the document's shape."""
    docs = spark.read.text(path, wholetext=True).selectExpr("_metadata.file_name as source_file", "try_parse_json(value) as doc").where("doc is not null")
    return docs.selectExpr("source_file", f"{json_structure('doc')} as structure", f"explode({record_list('doc')}) as record")


def flatten_features(records: DataFrame) -> DataFrame:
    """Features as rows: fields MAP<STRING, VARIANT> of the properties, geometry (JSON), _feature_type
    and _feature_id. What is no object is left out."""
    return records.where("schema_of_variant(record) like 'OBJECT%'").selectExpr(
        "source_file", "coalesce(try_variant_get(record, '$.properties', 'map<string,variant>'), cast(map() as map<string,variant>)) as fields",
        "to_json(try_variant_get(record, '$.geometry', 'variant')) as geometry", "try_variant_get(record, '$.type', 'string') as _feature_type", "try_variant_get(record, '$.id', 'string') as _feature_id",
    )


def read_enriched(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, dataset_id, position, record): files of the form {"_metadata", "records"}. The list
    is a column of its own, so that a record carries no copy of its document. A document beyond the size
    of a variant (128 MiB) is read as a list of variants, one a record."""
    keys = ["features", *LIST_KEYS]
    wide = f"from_json(value, '_metadata struct<dataset_id string>, {', '.join(f'{k} array<variant>' for k in keys)}')"
    docs = spark.read.text(path, wholetext=True).selectExpr("_metadata.file_name as source_file", "value", "try_parse_json(value) as doc")
    docs = docs.selectExpr("source_file", "doc", "case when doc is null and ltrim(value) like '[%' then from_json(value, 'array<variant>') end as list", f"case when doc is null and ltrim(value) like '{{%' then {wide} end as wide")
    whole = f"case when doc is not null then {record_list('doc')} else coalesce(list, {', '.join(f'wide.{k}' for k in keys)}) end"
    lists = docs.selectExpr("source_file", "coalesce(try_variant_get(doc, '$._metadata.dataset_id', 'string'), wide._metadata.dataset_id) as dataset_id", f"{whole} as records")
    return lists.selectExpr("source_file", "dataset_id", "posexplode(records) as (position, record)")


def _xml(raw: bytes):
    """The root of a document; if it is malformed, of what it is without control characters and with
    its bare ampersands escaped; if that is malformed too, nothing."""
    try:
        return ElementTree.fromstring(raw)
    except ElementTree.ParseError:
        pass
    try:
        mended = re.sub(rb"&(?!(?:[A-Za-z]+|#\d+|#x[0-9A-Fa-f]+);)", b"&amp;", re.sub(rb"[\x00-\x08\x0b\x0c\x0e-\x1f]", b"", raw))
        return ElementTree.fromstring(mended)
    except ElementTree.ParseError:
        return []


def read_xml(spark: SparkSession, path: str) -> DataFrame:
    """(position, fields MAP<STRING, STRING>): each child of the root; its children's texts by tag
    without namespace (the last of a tag wins), or its attributes and text. Empty ones are dropped; a
    document that can't be mended gives no rows, the others of the folder theirs."""
    bare = lambda t: t.rsplit("}", 1)[-1]

    def parse(batches):
        import pandas as pd

        for b in batches:
            rows = []
            for raw in b["content"]:
                for i, child in enumerate(_xml(bytes(raw))):
                    own = {bare(x.tag): (x.text or "").strip() for x in child} if len(child) else dict(child.attrib) | ({bare(child.tag): child.text.strip()} if (child.text or "").strip() else {})
                    if own:
                        rows.append((i, own))
            if rows:
                yield pd.DataFrame(rows, columns=["position", "fields"])

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(parse, "position int, fields map<string,string>")


def detect_delimiter(lines: list[str]) -> str | None:
    """The most frequent of tab, comma, pipe and semicolon in the first ten lines, if it comes up
    more often than there are lines in the sample of twenty."""
    text = "\n".join(lines[:10])
    counts = {d: text.count(d) for d in ("\t", ",", "|", ";")}
    best = max(counts, key=counts.get)
    return best if counts[best] > 20 else None


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, line_number, value): the lines of each file from 1, decoded, in any number of
    splits: the place of a line in its split, and the lines of the splits before it."""
    at = spark.read.text(path).selectExpr("_metadata.file_path as source_file", "_metadata.file_block_start as start", "monotonically_increasing_id() as i", f"{_decoded_line('value')} as value")
    splits = at.groupBy("source_file", "start").agg(F.min("i").alias("first"), F.count("*").alias("n"))
    splits = splits.selectExpr("source_file", "start", "first", "sum(n) over (partition by source_file order by start) - n as before")
    return at.join(F.broadcast(splits), ["source_file", "start"]).selectExpr("source_file", "i - first + before + 1 as line_number", "value")


def _first_lines(spark: SparkSession, path: str, n: int) -> list[str]:
    return [r["value"] for r in spark.read.text(path).selectExpr(f"{_decoded_line('value')} as value").limit(n).collect()]


def read_txt(spark: SparkSession, path: str, delimiter: str | None = None) -> DataFrame:
    """Delimited text as a table (headers normalised, columns without values dropped); else columns
    of fixed width, if the first lines have at least two gaps of two spaces or more in common; else
    a row for each line that is not blank: line_number, content."""
    first = _first_lines(spark, path, 20)
    delimiter = delimiter or detect_delimiter(first)
    if delimiter:
        df = read_csv(spark, path, delimiter)
        df = df.toDF(*[column_name(c) for c in df.columns])
        filled = df.agg(*[F.count(f"`{c}`").alias(c) for c in df.columns]).first()
        return df.select(*[f"`{c}`" for c in df.columns if filled[c]])
    if len(first) > 2 and len(_spans(first, 2)) > 2:
        return read_fixed_width(spark, path, 2)
    return lines(spark, path).where("trim(value) != ''").selectExpr("line_number", "trim(value) as content")


def _spans(first: list[str], gap: int = 1) -> list[tuple[int, int]]:
    """Places that some line fills, parted by `gap` places or more that none does."""
    own = [x for x in first if x.strip()]
    used = [i for i in range(max(map(len, own), default=0)) if any(i < len(x) and x[i] != " " for x in own)]
    spans: list[list[int]] = []
    for i in used:
        if spans and i - spans[-1][1] < gap:
            spans[-1][1] = i + 1
        else:
            spans.append([i, i + 1])
    return [(a, b) for a, b in spans]


def read_fixed_width(spark: SparkSession, path: str, gap: int = 1) -> DataFrame:
    """Columns by the runs of spaces that all sampled lines share; the first line of each file is the
    header. The last column reaches to the end of the line."""
    first = [x for x in _first_lines(spark, path, 100) if x.strip()]
    spans = _spans(first, gap)
    names = [column_name(first[0][a:b]) or f"column_{k}" for k, (a, b) in enumerate(spans)] if first else []
    body = lines(spark, path).where("line_number > 1 and trim(value) != ''")
    ends = [b - a for a, b in spans[:-1]] + [1 << 30]
    return body.selectExpr(*[f"nullif(trim(substring(value, {a + 1}, {w})), '') as `{n}`" for (a, _), w, n in zip(spans, ends, names, strict=False)])


# Formats of members, the most wanted first.
ZIP_ORDER = ["csv", "xlsx", "xls", "json", "xml", "txt", "shp", "geojson"]


def unzip(path: str, folder: str) -> list[str]:
    """Members written below the folder; those that would leave it are refused."""
    out, root = [], os.path.realpath(folder)
    with zipfile.ZipFile(path) as z:
        for m in z.infolist():
            target = os.path.realpath(os.path.join(root, m.filename))
            if m.is_dir() or not target.startswith(root + os.sep) or "__MACOSX" in m.filename:
                continue
            os.makedirs(os.path.dirname(target), exist_ok=True)
            with z.open(m) as src, open(target, "wb") as dst:
                while chunk := src.read(1 << 20):
                    dst.write(chunk)
            out.append(target)
    return sorted(out)


def read_zip(spark: SparkSession, path: str, folder: str) -> DataFrame:
    """The first member of the best format. `folder` must be one the executors see."""
    from cedarloom.sources.shapes import read_shp
    from cedarloom.sources.sheets import read_xlsx

    members = unzip(path, folder)
    best = next((m for e in ZIP_ORDER for m in members if m.lower().endswith(f".{e}")), None)
    if best is None:
        raise ValueError(f"{path} has no member of a known format")
    kind = best.rsplit(".", 1)[-1].lower()
    if kind == "xls":
        raise ValueError(f"{best}: workbooks of the old XLS format can't be read; save it as XLSX or CSV")
    readers = {"csv": read_csv, "json": read_json, "geojson": read_json, "xml": read_xml, "txt": read_txt, "shp": read_shp, "xlsx": read_xlsx}
    return readers[kind](spark, best)


def list_files(folder: str) -> list[str]:
    return sorted(os.path.relpath(os.path.join(d, f), folder) for d, _, fs in os.walk(folder) for f in fs if "__MACOSX" not in d and "__MACOSX" not in f)


def find_geospatial(folder: str) -> str | None:
    """The first geospatial file that the walk meets; a .json only if it begins like GeoJSON."""
    for d, subs, fs in os.walk(folder):
        subs[:] = [s for s in sorted(subs) if s != "__MACOSX"]
        for s in subs:
            if s.lower().endswith(".gdb"):
                return os.path.join(d, s)
        for ext in (".shp", ".geojson", ".gpkg", ".kml", ".gml"):
            for f in sorted(fs):
                if f.lower().endswith(ext):
                    return os.path.join(d, f)
        for f in sorted(fs):
            if f.lower().endswith(".json"):
                with open(os.path.join(d, f), "rb") as j:
                    if re.search(rb'"(?:FeatureCollection|features|geometry)"', j.read(500)):
                        return os.path.join(d, f)
    return None
