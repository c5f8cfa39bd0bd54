"""Schemas that drift between files (problem 5).

Method: rescue-column ingestion. Each file is read under the schema of the file before it in its
dataset. What that schema does not know, or knows with another type, is rescued as JSON instead of
being lost; the rescued fields are the changes. A field that went and one that came are one renamed
field if they carry the same values for the same establishments; such names are promoted, and the
rescued values are replayed into typed columns.

Establishments are found without knowing which field identifies them: two records of neighbouring
files are linked if they share two identifying values, that is values of five characters or more
that stand in at most two records of each of the files. Where that links less than a tenth of the
smaller file, values in up to 8, 32, 128 and so on records count as well, until enough are linked or
every value counts that stands in no more than a hundredth of the file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cedarloom.functions.rows import once
from cedarloom.functions.values import is_null_marker
from cedarloom.io import cut

FILE = ["dataset_id", "file_seq", "source_file"]
AGREE = 0.75


def fields_of(records: DataFrame) -> DataFrame:
    """(raw_id, dataset_id, file_seq, source_file, field_name, value, json_type), one row for each
    field of each record. value is the same for one datum of different type (days as seconds since 1970 or
    month/day/year, yes and no, numbers as text); it is null, and so is json_type, for null markers. Records
    that are null or no JSON object have no rows."""
    raw = records.sparkSession.sql(
        f"""select raw_id, {", ".join(FILE)}, key as field_name, variant_get(value, '$', 'string') as v, schema_of_variant(value) as t
        from (select raw_id, {", ".join(FILE)}, try_parse_json(original) as doc from {{records}}), lateral variant_explode(doc)""",
        records=records,
    )
    raw = raw.withColumn(
        "json_type",
        F.expr(f"""case when v is null or (t = 'STRING' and {is_null_marker('v')}) then null when t = 'STRING' then 'string' when t = 'BOOLEAN' then 'boolean'
        when t = 'BIGINT' or t rlike '^DECIMAL\\\\((19|[23][0-9]),0\\\\)$' then 'integer' when t rlike '^(DECIMAL|DOUBLE|FLOAT)' then 'number' else 'other' end"""),
    )
    return raw.selectExpr("raw_id", *FILE, "field_name", f"case when json_type is not null then {normal('v')} end as value", "json_type", "v as raw_value")


def normal(v: str) -> str:
    """SQL: the one form of a datum whatever its type was: days as dates, yes and no as true and
    false, numbers without what adds nothing, all else trimmed and in lower case."""
    t = f"trim({v})"
    return f"""case when {t} rlike '^[0-9]{{9,10}}$' and try_cast({t} as bigint) % 86400 = 0 then cast(date_from_unix_date(cast(try_cast({t} as bigint) div 86400 as int)) as string)
        when {t} rlike '^[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}$' then coalesce(cast(try_to_date({t}, 'M/d/yyyy') as string), {t})
        when {t} rlike r'^[+-]?[0-9]+([.][0-9]+)?$' then regexp_replace(regexp_replace({t}, r'^[+]', ''), r'[.]0+$|([.][0-9]*[1-9])0+$', '$1')
        when lower({t}) in ('y', 'yes') then 'true' when lower({t}) in ('n', 'no') then 'false' else lower({t}) end"""


def file_schemas(fields: DataFrame) -> DataFrame:
    """(file, field_name, json_type): the type most of its values have, null if it has none."""
    n = fields.groupBy(*FILE, "field_name", "json_type").agg(F.count("*").alias("n"))
    order = F.when(F.col("json_type").isNotNull(), F.struct(F.col("n"), F.col("json_type")))
    return n.groupBy(*FILE, "field_name").agg(F.max(order).alias("m")).selectExpr(*FILE, "field_name", "m.json_type as json_type")


def files_before(records: DataFrame) -> DataFrame:
    """(file, before_seq): each file and the number of the file before it in its dataset."""
    files = records.groupBy(*FILE).agg(F.count("*").alias("n_records"))
    return files.selectExpr(*FILE, "lag(file_seq) over (partition by dataset_id order by file_seq, source_file) as before_seq").where("before_seq is not null")


def rescued(schemas: DataFrame, files: DataFrame) -> DataFrame:
    """What stays over when each file is read under the schema of the file before it: (file,
    before_seq, field_name, reason, new_type, old_type). reason: unknown (no such field before),
    cast (another type than before), missing (a field before that is no more), or null (it fits)."""
    now = files.join(schemas, FILE).withColumnRenamed("json_type", "new_type")
    old = schemas.selectExpr("dataset_id", "file_seq as before_seq", "field_name", "json_type as old_type", "true as was")
    old = files.join(old, ["dataset_id", "before_seq"])
    reason = "case when was is null then 'unknown' when is_ is null then 'missing' when new_type != old_type then 'cast' end as reason"
    both = now.withColumn("is_", F.lit(True)).join(old, [*FILE, "before_seq", "field_name"], "full")
    return both.selectExpr(*FILE, "before_seq", "field_name", reason, "new_type", "old_type")


def renames(fields: DataFrame, left: DataFrame) -> DataFrame:
    """(file, before_seq, old_name, new_name) of the fields in `left` (see rescued) that were
    renamed: the values agree for at least three quarters of the linked establishments, and neither
    name agrees better with another. Where no linked establishment has both, names that differ only
    in case and separators are one field."""
    went = left.where("reason = 'missing'").select(*FILE, "before_seq", F.col("field_name").alias("old_name"))
    came = left.where("reason = 'unknown'").select(*FILE, "before_seq", F.col("field_name").alias("new_name"))
    pair = went.join(came, [*FILE, "before_seq"])
    need = cut(pair.select("dataset_id", "file_seq", "before_seq").distinct(), "changed")

    def seen(need: DataFrame, seq: str, most: int) -> DataFrame:
        """Identifying values of the later (file_seq) or earlier (before_seq) file of a change."""
        own = fields.where("length(value) >= 5").join(need.selectExpr("dataset_id", f"{seq} as file_seq", "file_seq as at_seq"), ["dataset_id", "file_seq"]).select("dataset_id", "at_seq", "value", "raw_id")
        one = own.groupBy("dataset_id", "at_seq", "value").agg(F.min("raw_id").alias("a"), F.max("raw_id").alias("b"), F.count_distinct("raw_id").alias("n")).where(f"n <= {most}")
        if most <= 2:
            return one.selectExpr("dataset_id", "at_seq", "value", "explode(array_distinct(array(a, b))) as id")
        return own.withColumnRenamed("raw_id", "id").join(one.select("dataset_id", "at_seq", "value"), ["dataset_id", "at_seq", "value"]).distinct()

    def linked(need: DataFrame, most: int) -> DataFrame:
        now, old = seen(need, "file_seq", most).withColumnRenamed("id", "new_id"), seen(need, "before_seq", most).withColumnRenamed("id", "old_id")
        pairs = now.join(old, ["dataset_id", "at_seq", "value"]).groupBy("dataset_id", "at_seq", "old_id", "new_id").agg(F.count("*").alias("shared")).where("shared >= 2")
        return cut(pairs.withColumnRenamed("at_seq", "file_seq"), "links")

    sizes = fields.groupBy("dataset_id", "file_seq").agg(F.count_distinct("raw_id").alias("size"))
    need = need.join(sizes, ["dataset_id", "file_seq"]).join(sizes.selectExpr("dataset_id", "file_seq as before_seq", "size as before_size"), ["dataset_id", "before_seq"])
    need = cut(need.selectExpr("dataset_id", "file_seq", "before_seq", "least(size, before_size) as size"), "changed")
    link, most = linked(need, 2), 2
    while True:
        got = link.groupBy("dataset_id", "file_seq").agg(F.count_distinct("new_id").alias("links"))
        need = cut(need.join(got, ["dataset_id", "file_seq"], "left").where(f"coalesce(links, 0) < size / 10 and {4 * most} <= size / 100").drop("links"), "changed")
        if need.isEmpty():
            break
        most *= 4
        link = link.join(need, ["dataset_id", "file_seq"], "left_anti").unionByName(linked(need, most))
    filled = fields.where("value is not null")
    a = filled.join(went, on=[filled.dataset_id == went.dataset_id, filled.file_seq == went.before_seq, filled.field_name == went.old_name]).select(
        went.dataset_id, went.file_seq, F.col("raw_id").alias("old_id"), "old_name", F.col("value").alias("old_value")
    )
    b = filled.join(came.withColumnRenamed("new_name", "field_name").select("dataset_id", "file_seq", "field_name"), ["dataset_id", "file_seq", "field_name"]).selectExpr(
        "dataset_id", "file_seq", "raw_id as new_id", "field_name as new_name", "value as new_value"
    )
    key = ["dataset_id", "file_seq"]
    whole = "(old_value like '%.%') != (new_value like '%.%') and try_cast(old_value as double) > 20"  # a fraction that came or went
    same = f"old_value = new_value or ({whole} and floor(try_cast(old_value as double)) = floor(try_cast(new_value as double)))"
    vote = link.join(a, [*key, "old_id"]).join(b, [*key, "new_id"]).groupBy(*key, "old_name", "new_name")
    vote = vote.agg(F.count("*").alias("n"), F.count_if(F.expr(same)).alias("agree"))
    bare = lambda c: f"regexp_replace(lower({c}), '[^a-z0-9]', '')"
    judged = pair.join(vote, [*key, "old_name", "new_name"], "left").withColumn("alike", F.expr(f"{bare('old_name')} = {bare('new_name')}"))
    judged = judged.where(f"agree >= {AGREE} * n or (n is null and alike)")
    score = "struct(coalesce(agree / n, 0D) as rate, coalesce(n, 0L) as n, alike, {} as name)"
    best = lambda by, name: F.expr(f"(max({score.format(name)}) over (partition by dataset_id, file_seq, {by})).name")
    judged = judged.withColumns({"to_new": best("old_name", "new_name"), "to_old": best("new_name", "old_name")})
    return judged.where("to_new = new_name and to_old = old_name").select(*FILE, "before_seq", "old_name", "new_name")


class Drift:
    """The schemas of all files of `records` (raw_id, dataset_id, source_file, file_seq, original),
    what each file leaves over under the schema before it, and the renames. Empty tables give empty
    results; repeated and late records count once for names and types."""

    def __init__(self, records: DataFrame):
        self.fields = cut(fields_of(records), "fields")
        self.schemas = cut(file_schemas(self.fields), "schemas")
        self.left = cut(rescued(self.schemas, files_before(records)), "rescued")
        self.renamed = cut(renames(self.fields, self.left), "renames")

    def changes(self) -> DataFrame:
        """(dataset_id, source_file, field_name, change_kind)."""
        file = ["dataset_id", "source_file"]
        named = self.renamed.selectExpr(*FILE, "old_name", "new_name")
        gone = self.left.where("reason = 'missing'").join(named.selectExpr(*FILE, "old_name as field_name"), [*FILE, "field_name"], "left_anti")
        come = self.left.where("reason = 'unknown'").join(named.selectExpr(*FILE, "new_name as field_name"), [*FILE, "field_name"], "left_anti")
        old = self.left.where("reason = 'missing'").selectExpr(*FILE, "field_name as old_name", "old_type")
        new = self.left.where("reason = 'unknown'").selectExpr(*FILE, "field_name as new_name", "new_type")
        both = named.join(old, [*FILE, "old_name"]).join(new, [*FILE, "new_name"]).where("old_type != new_type")
        rows = [
            gone.selectExpr(*file, "field_name", "'removed' as change_kind"),
            come.selectExpr(*file, "field_name", "'added' as change_kind"),
            named.selectExpr(*file, "new_name as field_name", "'renamed' as change_kind"),
            self.left.where("reason = 'cast'").selectExpr(*file, "field_name", "'retyped' as change_kind"),
            both.selectExpr(*file, "new_name as field_name", "'retyped' as change_kind"),
        ]
        out = rows[0]
        for r in rows[1:]:
            out = out.unionByName(r)
        return out

    def lineages(self) -> DataFrame:
        """(dataset_id, file_seq, field_name, root_seq, root_name): the first name of each field,
        followed through its renames by pointer jumping."""
        up = self.renamed.selectExpr("dataset_id", "file_seq", "new_name as field_name", "before_seq as up_seq", "old_name as up_name")
        kept = self.left.where("reason is null or reason = 'cast'").selectExpr("dataset_id", "file_seq", "field_name", "before_seq as up_seq", "field_name as up_name")
        key = ["dataset_id", "file_seq", "field_name"]
        at = self.schemas.select(*key).join(up.unionByName(kept), key, "left")
        at = cut(at.selectExpr(*key, "coalesce(up_seq, file_seq) as up_seq", "coalesce(up_name, field_name) as up_name"), "lineage")
        while True:
            far = at.selectExpr("dataset_id", "file_seq as up_seq", "field_name as up_name", "up_seq as far_seq", "up_name as far_name")
            nxt = cut(at.join(far, ["dataset_id", "up_seq", "up_name"]).selectExpr(*key, "far_seq as up_seq", "far_name as up_name", "far_seq != up_seq as moved"), "lineage")
            at = nxt.drop("moved")
            if nxt.where("moved").isEmpty():
                return at.withColumnsRenamed({"up_seq": "root_seq", "up_name": "root_name"})


# The consistent table: column, type, and the names (lower case, letters and digits only) that are
# approved for it. A field whose lineage has an approved name is promoted under all its names.
TARGET = [
    ("establishment_id", "bigint", ["establishmentid", "estid", "premiseno"]),
    ("establishment_name", "string", ["establishmentname", "estname", "name"]),
    ("street_no", "string", ["streetno", "streetnumber", "civicno"]),
    ("street_name", "string", ["streetname", "thoroughfare"]),
    ("postal_code", "string", ["postalcode", "pcode"]),
    ("ward", "int", ["ward", "wardno", "districtno"]),
    ("inspection_date", "date", ["inspectiondate", "insdate", "visitedon"]),
    ("inspection_status", "string", ["inspectionstatus", "insstatus"]),
    ("severity", "string", ["severity", "infractionseverity"]),
    ("infraction_details", "string", ["infractiondetails", "deficiencydesc", "deficiencydescription"]),
    ("min_inspections", "int", ["mininspections", "mininspectionsperyear", "yearlyvisits"]),
    ("risk_score", "double", ["riskscore", "riskpoints"]),
    ("amount_fined", "double", ["amountfined", "finetotal"]),
    ("court_outcome", "string", ["courtoutcome", "courtresult", "outcomecode"]),
    ("is_open", "boolean", ["isopen", "opennow", "tradingflag"]),
    ("self_declared", "boolean", ["selfdeclared", "declaredbyowner"]),
    ("inspector_badge", "string", ["inspectorbadge", "badgeref"]),
]


def one_table(records: DataFrame, drift: Drift, salts: int = 32, target: list[tuple[str, str, list[str]]] = TARGET) -> DataFrame:
    """All records under the target schema: raw_id, dataset_id, source_file, the columns of target
    (column, type, approved names in lower case, letters and digits only), and rescued: JSON of the
    fields that are not promoted or can't be cast. Rescued values are replayed in the form they
    have in fields_of, so that a date in any of its notations comes to the date column. No record is
    dropped; one that is no JSON object has nulls and, as rescued, its text. Where names of one
    lineage are approved for different columns the earliest file's name decides, so that a column
    keeps its meaning over time."""
    bare = "regexp_replace(lower(field_name), '[^a-z0-9]', '')"
    names = ", ".join(f"'{a}', '{c}'" for c, _, al in target for a in al)
    line = drift.lineages().withColumn("target", F.expr(f"try_element_at(map({names}), {bare})"))
    root = ["dataset_id", "root_seq", "root_name"]
    of_root = line.where("target is not null").groupBy(*root).agg(F.min(F.struct("file_seq", "target")).alias("t")).selectExpr(*root, "t.target as promoted")
    promoted = line.join(of_root, root).selectExpr("dataset_id", "file_seq", "field_name", "promoted")
    per_file = promoted.groupBy("dataset_id", "file_seq").agg(F.expr("map_from_entries(collect_list(struct(field_name, promoted)))").alias("names"))
    per_file = per_file.selectExpr("dataset_id", "file_seq", "names", f"explode(sequence(0, {salts - 1})) as salt")
    at = records.selectExpr("raw_id", *FILE, "original", f"cast(pmod(xxhash64(raw_id), {salts}) as int) as salt").join(per_file, ["dataset_id", "file_seq", "salt"], "left")
    at = at.withColumn("doc", F.expr("from_json(original, 'map<string,string>')"))
    clean = f"transform_values(doc, (k, v) -> case when {is_null_marker('v')} then null else trim(v) end)"
    at = at.withColumn("doc", F.expr(clean)).withColumn("names", F.expr("coalesce(names, cast(map() as map<string,string>))"))
    # target -> value; where two fields claim a target the first that has a value is taken
    got = lambda c: f"get(filter(map_values(map_filter(doc, (k, v) -> try_element_at(names, k) = '{c}')), v -> v is not null), 0)"
    # what is no date (number, boolean) as it stands is replayed in its normal form
    cast = lambda v, t: v if t == "string" else f"coalesce(try_cast({v} as {t}), try_cast({normal(v)} as {t}))"
    at = once(at, **{f"_{c}": got(c) for c, _, _ in target})
    typed = [f"{cast(f'_{c}', t)} as {c}" for c, t, _ in target]
    types = ", ".join(f"'{c}', '{t}'" for c, t, _ in target)
    kind = f"try_element_at(map({types}), try_element_at(names, k))"
    other = sorted({t for _, t, _ in target} - {"string"})
    taken = "map(" + ", ".join(f"'{c}', _{c}" for c, _, _ in target) + ")"
    # a second field for a column whose value is not the one taken is rescued too
    bad = f"v is not null and ({kind} is null or v != try_element_at({taken}, try_element_at(names, k)) " + "".join(f"or ({kind} = '{t}' and {cast('v', t)} is null) " for t in other) + ")"
    rescue = f"case when doc is null or try_parse_json(original) is null then original when size(map_filter(doc, (k, v) -> {bad})) > 0 then to_json(map_filter(doc, (k, v) -> {bad})) end as rescued"
    return at.selectExpr("raw_id", "dataset_id", "source_file", *typed, rescue)
