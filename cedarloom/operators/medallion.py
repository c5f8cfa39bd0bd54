"""Bronze, silver and gold forms of records, as projections over a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cedarloom.functions import classify as C
from cedarloom.functions.names import silver_name
from cedarloom.functions.rows import once
from cedarloom.functions.rules import FALLBACK_FIELDS, ID_FIELDS, SEARCH_FIELDS
from cedarloom.functions.values import BOOLEAN_FIELDS, is_null_marker


def canonical(columns: list[str]) -> str:
    """One text of a row that does not depend on the order of its columns."""
    parts = ", ".join(f"concat('{c}=', coalesce(cast(`{c}` as string), '~'))" for c in sorted(columns))
    return f"concat_ws('|', {parts})"


def record_id(dataset: str, scope: str | None, fallback: str, ids: list[str], text: str) -> str:
    """dataset:scope:id; the id is the first of `ids` that has a value other than 0, else a digest."""
    own = [f"nullif(nullif(cast(`{i}` as string), ''), '0')" for i in ids]
    rid = f"coalesce({', '.join([*own, f'left(md5({text}), 12)'])})"
    return f"concat_ws(':', {dataset}, coalesce({scope or 'null'}, '{fallback}'), {rid})"


def bronze(df: DataFrame, dataset: str, source_file: str | None = None, loaded_at: str = "current_timestamp()") -> DataFrame:
    """Raw records: _raw_id, _dataset_id, _source_file, _loaded_at, _checksum, _original (JSON).
    dataset, source_file and loaded_at are SQL. The checksum does not depend on column order."""
    ids = [c for c in ("_id", "id", "original_id") if c in df.columns]
    text = canonical(df.columns)
    original = ", ".join(f"`{c}`" for c in df.columns)
    return df.selectExpr(
        f"{record_id(dataset, source_file, 'unknown_source', ids, text)} as _raw_id", f"{dataset} as _dataset_id", f"{source_file or 'cast(null as string)'} as _source_file",
        f"{loaded_at} as _loaded_at", f"md5({text}) as _checksum", f"to_json(struct({original}), map('ignoreNullFields', 'false')) as _original",
    )


def integrity(stored: DataFrame, fresh: DataFrame, ids: int = 100) -> DataFrame:
    """(valid, invalid, invalid_ids): stored rows whose checksum is or is not that of the same fresh
    row, and the first ids of the latter; all of them are the rows of changed()."""
    at = stored.select("_raw_id", F.col("_checksum").alias("was")).join(fresh.select("_raw_id", F.col("_checksum").alias("now")), "_raw_id")
    bad = at.where("was != now").select("_raw_id").orderBy("_raw_id").limit(ids).agg(F.sort_array(F.collect_list("_raw_id")).alias("invalid_ids"))
    return at.agg(F.count_if(F.expr("was = now")).alias("valid"), F.count_if(F.expr("was != now")).alias("invalid")).join(F.broadcast(bad))


def changed(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """(_raw_id) of the stored rows whose fresh row has another checksum."""
    return stored.select("_raw_id", F.col("_checksum").alias("was")).join(fresh.select("_raw_id", F.col("_checksum").alias("now")), "_raw_id").where("was != now").select("_raw_id")


def normal_value(name: str, c: str, kind: str) -> str:
    """Trimmed, with null markers as null; boolean fields as booleans (any other text is false)."""
    if kind == "string":
        s = rf"regexp_replace({c}, r'(?U)^\s+|\s+$', '')"
        body = f"upper({s}) in ('Y', 'YES', 'TRUE', '1', 'ACTIVE')" if name in BOOLEAN_FIELDS else s
        return f"case when {is_null_marker(s)} then null else {body} end"
    return f"({c} != 0)" if name in BOOLEAN_FIELDS and kind != "boolean" else c


def normalised(df: DataFrame, field_names: dict[str, str] | None = None) -> DataFrame:
    """Columns under their normalised names, with normalised values. Keys that begin with an
    underscore are dropped, but for _id; of keys that come to one name the later stays."""
    out: dict[str, str] = {}
    for f in df.schema:
        name = (field_names or {}).get(f.name) or silver_name(f.name)
        if name:
            out.pop(name, None)
            c = f"`{f.name}`"
            out[name] = c if f.name == "_id" else normal_value(name, c, f.dataType.simpleString())
    return df.selectExpr(*[f"{v} as `{k}`" for k, v in out.items()])


def issue_fields(issue: str | None) -> list[str]:
    """The common fields of the searchable text and those of an issue, each once."""
    return list(dict.fromkeys([*SEARCH_FIELDS["common"], *SEARCH_FIELDS.get(issue or "", [])]))


def indexed_text(columns: list[str], kinds: dict[str, str], issue: str = "primary_issue") -> str:
    """The text the indexer makes: address fields, then those of the issue, between bars; where there
    is none of them, all texts of fewer than 500 characters whose names begin with no underscore."""
    text = lambda c: f"nullif(cast(`{c}` as string), '')"
    parts = [text(c) for c in ("address", "addrFull", "street_name", "neighbourhood", "ward") if c in columns]
    for name, own in SEARCH_FIELDS.items():
        if name != "common":
            parts += [f"case when {issue} = '{name}' then {text(c)} end" for c in own if c in columns]
    rest = [f"case when length(`{c}`) < 500 then `{c}` end" for c in columns if kinds[c] == "string" and not c.startswith("_")]
    return f"coalesce(nullif(concat_ws(' | ', {', '.join(parts or ['null'])}), ''), concat_ws(' | ', {', '.join(rest or ['null'])}))"


def searchable_text(columns: list[str], kinds: dict[str, str], issue: str = "primary_issue") -> str:
    """The texts of the common fields and those of the issue, the keywords, dataset and subcategory
    as words, and the issues; single spaces. Common fields count only if they are texts."""
    text = lambda c: f"nullif(trim(cast(`{c}` as string)), '')"
    parts = [text(c) for c in SEARCH_FIELDS["common"] if c in columns and kinds[c] == "string"]
    for name, fields in SEARCH_FIELDS.items():
        if name != "common":
            parts += [f"case when {issue} = '{name}' then {text(c) if kinds[c] == 'string' else f'nullif({text(c)}, {chr(39)}0{chr(39)})'} end" for c in fields if c in columns]
    parts += [
        f"array_join({c}, ' ')" if c.endswith("s") else c
        for c, have in (("issue_keywords", "issue_keywords"),) if have in columns
    ]
    parts += ["translate(dataset_id, '-_', '  ')"] * ("dataset_id" in columns) + ["translate(subcategory, '_', ' ')"] * ("subcategory" in columns) + [issue] * (issue in columns)
    parts += ["array_join(secondary_issues, ' ')"] * ("secondary_issues" in columns)
    return rf"trim(regexp_replace(concat_ws(' ', {', '.join(parts)}), r'\s+', ' '))"


def silver(df: DataFrame, dataset: str, resource: str | None = None, title: str = "''", loaded_at: str = "current_timestamp()", overrides: dict[str, str] | None = None) -> DataFrame:
    """Normalised records with id, taxonomy and searchable text. A field of the record replaces the
    metadata of its name; `overrides` (name to SQL) replaces the metadata before."""
    fields = normalised(df)
    ids = [c for c in ("original_id", "id") if c in fields.columns]
    over, have = overrides or {}, fields.columns
    uid = f"{record_id(dataset, resource, 'unknown_resource', ids, canonical(have))} as _unique_id"
    own = [c for c in have if c not in ("dataset_id", "_unique_id")]
    at = fields.selectExpr(uid, f"{'`dataset_id`' if 'dataset_id' in have else over.get('dataset_id', dataset)} as dataset_id", *[f"`{c}`" for c in own], *([f"{title} as _title"] if "primary_issue" not in have else []))
    # one after the other, each computed once: the chains are long and read each other's results
    chains = {
        "loaded_at": loaded_at, "primary_issue": C.primary_issue("dataset_id", "_title", "uncategorized"), "secondary_issues": C.secondary_issues("dataset_id"),
        "subcategory": C.subcategory("dataset_id", "primary_issue", "general"), "data_type": C.data_type("dataset_id"),
    } | over
    for name, sql in chains.items():
        if name not in at.columns:
            at = once(at, **{name: sql})
    at = once(at.drop("_title"), issue_keywords=C.issue_keywords("primary_issue", "subcategory"))
    kinds = {f.name: f.dataType.simpleString() for f in at.schema}
    return at.withColumn("searchable_text", F.expr(searchable_text(at.columns, kinds)))


def metadata(package: str, resource_name: str = "null", title: str = "null", notes: str = "null", extra: dict[str, str] | None = None) -> dict[str, str]:
    """Name to SQL of what is said of a dataset: ids, taxonomy, type, keywords, texts cut to 200 and
    500 characters. `extra` replaces what it names."""
    from cedarloom.functions.names import clean_id_sql

    issue = C.primary_issue(package, title)
    sub = C.subcategory(package, issue)
    out = {
        "dataset_id": f"concat({package}, '_', {clean_id_sql(f'coalesce(nullif({resource_name}, {chr(39) * 2}), {chr(39)}data{chr(39)})')})",
        "dataset_name": f"coalesce(nullif({resource_name}, ''), {package})", "package_name": package, "source": "'toronto-open-data'",
        "primary_issue": issue, "secondary_issues": C.secondary_issues(package), "subcategory": sub, "data_type": C.data_type(package, resource_name), "issue_keywords": C.issue_keywords(issue, sub),
        "package_title": f"nullif(left({title}, 200), '')", "package_notes": f"nullif(left({notes}, 500), '')",
    }
    return out | (extra or {})


def from_bronze(stored: DataFrame, schema: str, dataset: str = "_dataset_id", **kw) -> DataFrame:
    """Silver documents made anew from the raw records of a bronze table; `schema` is that of the
    records of its datasets."""
    raw = stored.select(F.col("_dataset_id").alias("_ds"), F.from_json("_original", schema).alias("r")).select("_ds", "r.*")
    return silver(raw.withColumnRenamed("_ds", "dataset_id"), "dataset_id", **kw)


def gold_location(columns: list[str]) -> str:
    """struct(lat, lon): centroid or latitude and longitude, 0 counting as missing; null else."""
    pick = lambda *names: "coalesce(" + ", ".join([f"nullif(try_cast(`{n}` as double), 0)" for n in names if n in columns] + ["cast(null as double)"]) + ")"
    lat, lon = pick("centroid_lat", "latitude"), pick("centroid_lon", "longitude")
    return f"case when {lat} is not null and {lon} is not null then struct({lat} as lat, {lon} as lon) end"


def gold_id(columns: list[str], dataset: str = "dataset_id") -> str:
    """The document's own id, else a digest of its identifying fields, else of all of it."""
    own = [c for c in ID_FIELDS if c in columns]
    known = [f"nullif(`{c}`, '')" for c in ("_unique_id", "unique_id") if c in columns]
    ident = f"concat_ws('|', {dataset}, {', '.join(f'nullif(cast(`{c}` as string), {chr(39) * 2})' for c in own)})" if own else canonical(columns)
    return f"coalesce({', '.join([*known, f'left(md5({ident}), 16)'])})"


def gold(docs: DataFrame, now: str = "current_timestamp()") -> DataFrame:
    """Documents for the search layer: without _id, with id, stamps, location and searchable text."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema if f.name != "_id"}
    cols = list(kinds)
    fallback = "concat_ws(' | ', " + ", ".join(f"nullif(cast(`{c}` as string), '')" for c in FALLBACK_FIELDS if c in cols) + ")" if any(c in cols for c in FALLBACK_FIELDS) else "''"
    text = f"coalesce(searchable_text, {fallback})" if "searchable_text" in cols else fallback
    own = [f"`{c}`" for c in cols if c not in ("_unique_id", "searchable_text", "indexed_at", "synced_at", "location", "centroid")]
    return docs.selectExpr(
        f"{gold_id(cols)} as _unique_id", *own, f"{text} as searchable_text", f"{now} as indexed_at", f"{now} as synced_at", f"{gold_location(cols)} as location", f"{gold_location(cols)} as centroid"
    )


# Fixed projections: fields, and the defaults of those that a document need not have.
TRANSFORMS = {
    "shelter": (
        ["occupancy_date", "capacity", "occupancy", "shelter_name", "facility_name", "sector", "shelter_address", "shelter_city", "shelter_postal_code", "shelter_province", "organization_name", "program_name", "data_collection_date"],
        {"dataset_id": "'daily-shelter-occupancy'", "primary_issue": "'housing'", "subcategory": "'shelter'", "data_type": "'record'"},
    ),
    "outbreak": (
        ["date_outbreak_began", "date_declared_over", "data_collection_date"],
        {"dataset_id": "'outbreaks-in-toronto-healthcare-institutions'", "primary_issue": "'health'", "data_type": "'record'"},
    ),
    "generic": (["data_collection_date", "collectionDate"], {"primary_issue": "'uncategorized'"}),
    "red_light_charges": (
        ["location_code", "ward_number", "location_name", "year", "charges", "enforcement_start_date", "enforcement_end_date"],
        {"dataset_id": "'red-light-camera-annual-charges'", "primary_issue": "'transportation'", "secondary_issues": "array('public_safety')", "subcategory": "'road_safety'", "data_type": "'record'"},
    ),
}
_HEAD = {"dataset_id": "string", "primary_issue": "string", "secondary_issues": "array<string>", "subcategory": "string", "data_type": "string", "issue_keywords": "array<string>", "searchable_text": "string"}


def ins_date(columns: list[str]) -> str:
    """The one date of a document as yyyy-MM-dd, by its dataset; null if it has none."""
    raw = lambda c: f"`{c}`" if c in columns else "cast(null as string)"
    occ, began, coll = raw("occupancy_date"), raw("date_outbreak_began"), raw("data_collection_date")
    first = lambda c: f"case when length({c}) >= 10 then left({c}, 10) end"
    return rf"""case when dataset_id = 'daily-shelter-occupancy' and {occ} rlike r'(?s)^.{{4}}-.{{2}}-.{{2}}' then left({occ}, 10)
        when dataset_id = 'daily-shelter-occupancy' and {occ} rlike r'^.{{2}}/.{{2}}/.{{4}}$' then cast(try_to_date({occ}, 'MM/dd/yyyy') as string)
        when dataset_id = 'outbreaks-in-toronto-healthcare-institutions' and length(coalesce(nullif({began}, ''), {coll})) >= 10 then left(coalesce(nullif({began}, ''), {coll}), 10)
        else {first(coll)} end"""


def transformed(docs: DataFrame, kind: str) -> DataFrame:
    """The fixed projection of one kind of dataset, with insDate. Defaults hold where the document
    has no such column; shelters also get the keyword and the word tenant."""
    fields, defaults = TRANSFORMS[kind]
    cols = docs.columns
    uid = "`_unique_id`" if "_unique_id" in cols else "cast(`_id` as string)"
    head = [f"{uid} as _unique_id", f"{uid} as doc_id"]
    for c, t in _HEAD.items():
        head.append(f"`{c}`" if c in cols else f"{defaults.get(c, 'cast(array() as array<string>)' if t.startswith('array') else f'cast(null as {t})')} as {c}")
    at = docs.selectExpr(*head, *[f"`{c}`" if c in cols else f"cast(null as string) as {c}" for c in fields])
    if kind == "shelter":
        words = F.expr("array_union(coalesce(issue_keywords, cast(array() as array<string>)), array('tenant'))")
        text = F.expr("case when coalesce(searchable_text, '') = '' then 'tenant' when contains(lower(searchable_text), 'tenant') then searchable_text else concat(searchable_text, ' tenant') end")
        at = at.withColumns({"issue_keywords": words, "searchable_text": text})
    return at.withColumn("insDate", F.expr(ins_date(at.columns)))


def tags(columns: list[str], domain: str = "null", issue: str = "null") -> str:
    """Sorted tags of a record by its contents."""
    first = lambda *names: "coalesce(" + ", ".join([f"nullif(cast(`{n}` as string), '')" for n in names if n in columns] + ["null"]) + ")"
    word = lambda c: f"replace(lower({c}), ' ', '_')"
    outbreak, agent = first("outbreak_type", "type_of_outbreak"), first("causative_agent_1")
    active, severity = first("is_active", "active"), first("severity", "infraction_severity")
    kind, status = first("establishment_type", "type"), first("establishment_status", "status")
    rows = [
        domain, issue, f"concat('outbreak_', {word(outbreak)})", f"case when {outbreak} is not null then 'outbreak' end",
        f"case when {active} in ('true', 'Y', 'Yes', 'YES') then 'active' when {active} in ('false', 'N', 'No', 'NO') then 'resolved' end",
        word(kind), f"concat('severity_', {word(severity)})", word(status), f"case when not {is_null_marker(agent)} then concat('agent_', {word(agent)}) end",
    ]
    return f"array_sort(array_distinct(filter(array({', '.join(rows)}), t -> t is not null)))"


def enriched(df: DataFrame, dataset: str, meta: dict[str, str]) -> DataFrame:
    """One JSON document a dataset, {"_metadata", "records"}: a sink for tables that are published as
    one file, so that the rows of a dataset must fit a task; written line by line otherwise."""
    head = ", ".join(f"{v} as {k}" for k, v in meta.items())
    rec = df.groupBy(F.expr(dataset).alias("dataset_id")).agg(F.expr(f"collect_list(struct({', '.join(f'`{c}`' for c in df.columns)}))").alias("records"))
    return rec.selectExpr(f"to_json(struct(struct(dataset_id, {head}, size(records) as record_count, 'toronto-open-data' as source, true as alignment_ready) as _metadata, records)) as value")
