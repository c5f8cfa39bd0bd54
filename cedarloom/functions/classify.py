"""Classification of datasets and resources as ordered CASE chains. A chain needs no join and no
shuffle, and its order is the order of the rule tables."""

from __future__ import annotations

from cedarloom.functions.rules import DATA_TYPES, DATASET_ISSUES, FORMAT_PRIORITY, GEO_WORDS, KEY_TYPES, TAXONOMY


def _any(text: str, words: list[str]) -> str:
    return "(" + " or ".join(f"contains({text}, '{w}')" for w in words) + ")"


def _explicit(c: str, i: int, known: dict) -> str:
    return f"case {c} " + " ".join(f"when '{k}' then '{v[i]}'" for k, v in known.items()) + " end" if known else "null"


def primary_issue(dataset: str, title: str = "''", default: str | None = None, taxonomy: dict = TAXONOMY, known: dict = DATASET_ISSUES) -> str:
    """The issue of a dataset: as it is known, else by the first words of the taxonomy that its name and
    title hold. taxonomy: issue to (words, {subcategory: words}); known: dataset to (issue, secondary
    issues, subcategory). Both may be others than the project's own."""
    text = f"lower(concat({dataset}, ' ', coalesce({title}, '')))"
    words = " ".join(f"when {_any(text, kw)} then '{issue}'" for issue, (kw, _) in taxonomy.items())
    rest = f"'{default}'" if default else "null"
    return f"coalesce({_explicit(dataset, 0, known)}, case {words} end, {rest})"


def subcategory(dataset: str, issue: str, default: str | None = None, taxonomy: dict = TAXONOMY, known: dict = DATASET_ISSUES) -> str:
    """Words are compared as they are written, so that those with capitals never match."""
    chains = []
    for i, (_, subs) in taxonomy.items():
        if subs:
            chains.append(f"when {issue} = '{i}' then case " + " ".join(f"when {_any(f'lower({dataset})', kw)} then '{s}'" for s, kw in subs.items()) + " end")
    rest = f"'{default}'" if default else "null"
    return f"coalesce({_explicit(dataset, 2, known)}, {'case ' + ' '.join(chains) + ' end' if chains else 'null'}, {rest})"


def secondary_issues(dataset: str) -> str:
    own = " ".join(f"when '{k}' then array({', '.join(repr(s) for s in v[1])})" for k, v in DATASET_ISSUES.items() if v[1])
    return f"coalesce(case {dataset} {own} end, cast(array() as array<string>))"


def issue_keywords(issue: str, sub: str, limit: int = 20) -> str:
    """The issue's first ten words and those of the subcategory, without repeats, in order."""
    rows = []
    for i, (kw, subs) in TAXONOMY.items():
        for s, more in [*subs.items(), (None, [])]:
            words = list(dict.fromkeys([*kw[:10], *more]))[:limit]
            test = f"{issue} = '{i}'" + (f" and {sub} = '{s}'" if s else "")
            rows.append(f"when {test} then array({', '.join(repr(w) for w in words)})")
    return f"coalesce(case {' '.join(rows)} end, cast(array() as array<string>))"


def data_type(dataset: str, resource: str = "''") -> str:
    text = f"lower(concat({dataset}, ' ', coalesce({resource}, '')))"
    return "case " + " ".join(f"when {_any(text, kw)} then '{t}'" for t, kw in DATA_TYPES.items()) + " else 'record' end"


def data_type_of_keys(keys: list[str]) -> str:
    """Of a table, by the names of its columns; a plan-time decision."""
    text = " ".join(k.lower() for k in keys)
    if not keys:
        return "unknown"
    return next((t for t, kw in KEY_TYPES.items() if any(w in text for w in kw)), "general")


def parse_boolean(c: str) -> str:
    s = f"lower(trim(cast({c} as string)))"
    return f"case when {s} in ('y', 'yes', 'true', '1', 'active', 'open') then true when {s} in ('n', 'no', 'false', '0', 'inactive', 'closed') then false end"


def is_geo_resource(name: str, url: str) -> str:
    return f"({_any(f'lower(coalesce({name}, {chr(39) * 2}))', GEO_WORDS)} or {_any(f'lower(coalesce({url}, {chr(39) * 2}))', GEO_WORDS)})"


def url_format(url: str) -> str:
    """The format a URL's ending names; nothing may follow it."""
    return rf"nullif(regexp_extract(lower({url}), r'\.(xlsx|xls|csv|json|geojson|xml|txt|zip|shp)$', 1), '')"


def resource_method(name: str, fmt: str, url: str, datastore: str) -> str:
    """struct(method, format): how to fetch a resource; nulls if there is no way."""
    f = f"lower(coalesce({fmt}, ''))"
    table = lambda f: (
        f"case when {f} in ('xlsx', 'xls') then struct('xlsx' as method, {f} as format) when {f} = 'csv' then struct('csv' as method, 'csv' as format) "
        f"when {f} in ('json', 'geojson') then struct('json_file' as method, {f} as format) when {f} in ('xml', 'txt') then struct({f} as method, {f} as format) "
        f"when {f} in ('shp', 'shapefile') then struct('shp' as method, 'shp' as format) "
        f"when {f} = 'zip' then struct(case when {is_geo_resource(name, url)} then 'shp' else 'zip' end as method, 'zip' as format) end"
    )
    none = "struct(cast(null as string) as method, cast(null as string) as format)"
    return (
        f"case when coalesce({url}, '') = '' then {none} when {url_format(url)} is not null then {table(url_format(url))} "
        f"when {datastore} then struct('datastore' as method, 'json' as format) else coalesce({table(f)}, {none}) end"
    )


def format_priority(fmt: str, datastore: str = "false") -> str:
    return f"case when coalesce({datastore}, false) then 0 else case lower({fmt}) " + " ".join(f"when '{f}' then {i}" for i, f in enumerate(FORMAT_PRIORITY)) + " else 99 end end"
