"""Best representative of each duplicate group (problem 4).

Method: skyline selection. The kept entry is the lexicographic best of the records that no other
record of the group beats in trust (datastore_active), format and recency at once. Each field is
filled from the skyline of the records that have a value for it: these are the first dominance
layers in which the field is not null, and the lexicographic policy decides among them. (Taking the
layers strictly one after another would give a record of an outer layer precedence over a better
ranked one of an inner layer, which the wanted result does not allow.)

A group may hold any share of the rows: records are first reduced, by partial aggregation, to the
best of each combination of trust, format and filled fields, at most 2 x 11 x 8 a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cedarloom.functions.rows import once
from cedarloom.functions.values import is_null_marker

# Formats from the most to the least wanted; all others come last.
FORMAT_ORDER = ["json", "geojson", "csv", "xlsx", "xls", "xml", "txt", "zip", "shp"]
# Words that mention a format in a name or file name.
FORMAT_WORDS = [*FORMAT_ORDER, "pdf", "html"]
FIELDS = ["description", "licence", "size_bytes"]
MIME = {
    "geo+json": "geojson",
    "vnd.openxmlformats-officedocument.spreadsheetml.sheet": "xlsx",
    "vnd.ms-excel": "xls",
    "plain": "txt",
}


def name_key(c: str) -> str:
    """Words of a name without case, separators and mentions of a format."""
    words = f"split(regexp_replace(lower({c}), r'(?U)[^\\p{{L}}\\p{{N}}]+', ' '), ' ')"
    drop = ", ".join(f"'{w}'" for w in ["", *FORMAT_WORDS])
    return f"array_join(filter({words}, w -> w not in ({drop})), ' ')"


def file_key(url: str) -> str:
    """The same of the last part of a URL; null where there is none."""
    path = f"regexp_replace({url}, r'[?#].*$', '')"
    last = f"regexp_extract({path}, r'([^/]*)/?$', 1)"
    return f"case when {url} is not null and not {is_null_marker(url)} then {name_key(f'coalesce(try_url_decode({last}), {last})')} end"


def format_rank(c: str) -> str:
    """0 for the most wanted format, however it is spelt."""
    bare = f"regexp_replace(regexp_replace(lower(trim({c})), r'^[^/]*/(x-)?', ''), r'^[.]', '')"
    known = " ".join(f"when '{k}' then {FORMAT_ORDER.index(v)}" for k, v in [*MIME.items(), *((f, f) for f in FORMAT_ORDER)])
    return f"coalesce(case {bare} {known} end, {len(FORMAT_ORDER)})"


def survivors(resources: DataFrame) -> DataFrame:
    """(package_id, name_key, file_key, n, keep_pos, from_pos MAP<field, pos>) of each group of two
    entries or more: the same package and name and, where there is a url, file name (an entry
    without a url goes with the file that is named as it is). Entries without package or name are in
    no group. Ties in all ranks go to the smaller pos; a field no entry has is not in the map."""
    has = lambda f: f"({f} is not null)" if f == "size_bytes" else f"({f} is not null and not {is_null_marker(f)})"
    keyed = once(resources.select("pos", "package_id", "name", "format", "url", "datastore_active", "last_modified", *FIELDS), nk=name_key("name"), fk=file_key("url"))
    keyed = keyed.where("package_id is not null and name is not null").selectExpr(
        "package_id", "nk as name_key", "coalesce(fk, nk) as file_key", "case when datastore_active then 0 else 1 end as trust", f"{format_rank('format')} as fmt",
        "coalesce(-unix_micros(cast(last_modified as timestamp)), 9223372036854775807L) as age", "pos", *[f"{has(f)} as has_{f}" for f in FIELDS],
    )
    group = ["package_id", "name_key", "file_key"]
    reps = keyed.groupBy(*group, "trust", "fmt", *[f"has_{f}" for f in FIELDS]).agg(F.min(F.struct("age", "pos")).alias("b"), F.count("*").alias("n"))
    rep = "struct(trust, fmt, b.age as age, b.pos as pos, " + ", ".join(f"has_{f}" for f in FIELDS) + ")"
    whole = reps.groupBy(*group).agg(F.sum("n").alias("n"), F.expr(f"collect_list({rep})").alias("reps")).where("n > 1")
    beats = "o.trust <= r.trust and o.fmt <= r.fmt and o.age <= r.age and (o.trust < r.trust or o.fmt < r.fmt or o.age < r.age)"

    def best(of: str) -> str:
        skyline = f"filter({of}, r -> not exists({of}, o -> {beats}))"
        return f"array_min(transform({skyline}, r -> struct(r.trust, r.fmt, r.age, r.pos as pos))).pos"

    whole = once(whole, keep_pos=best("reps"), **{f"from_{f}": best(f"filter(reps, x -> x.has_{f})") for f in FIELDS})
    pairs = ", ".join(f"struct('{f}' as field_name, from_{f} as from_pos)" for f in FIELDS)
    return whole.selectExpr(*group, "n", "keep_pos", f"map_from_entries(filter(array({pairs}), p -> p.from_pos is not null)) as from_pos")
