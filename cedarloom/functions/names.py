"""Names of columns, resources and files. Functions of one value are for plan time; those that end
in _sql give SQL text over a column."""

from __future__ import annotations

import re

from cedarloom.functions.rules import FIELD_NAMES, FORMAT_SUFFIXES, SEARCH_NAMES, SEARCH_SPELT

# Years, versions and mentions of a format in names.
YEAR = r"[_\-\s]?((?:19|20)\d{2})(?:[_\-\s]|$)"
VERSION = r"[_\-\s]?v?\d+(?:\.\d+)?(?:[_\-\s]|$)"
_FORMAT_PARENS = r"(?i)\s*\((csv|json|xml|xlsx|xls|txt|zip|shp)\)"


def snake(name: str) -> str:
    """Dashes and spaces to underscores, a boundary where a capital follows a small letter."""
    s = re.sub(r"([a-z])([A-Z])", r"\1_\2", re.sub(r"[- ]", "_", name))
    return re.sub(r"_+", "_", s).lower().strip("_")


def snake_sql(c: str) -> str:
    s = rf"regexp_replace(regexp_replace({c}, '[- ]', '_'), '([a-z])([A-Z])', '$1_$2')"
    return f"trim(both '_' from lower(regexp_replace({s}, '_+', '_')))"


def silver_name(name: str) -> str | None:
    """The normalised name of a key; None for keys that are dropped."""
    if name == "_id":
        return "original_id"
    return None if name.startswith("_") else FIELD_NAMES.get(name, snake(name))


def add_field_name(name: str, target: str) -> None:
    """Another spelling of a field, for all plans made from now on."""
    FIELD_NAMES[name] = target


def all_field_names() -> dict[str, str]:
    """Every known spelling and the field it stands for."""
    return dict(FIELD_NAMES)


def column_name(name: str) -> str:
    """Headers of files: a whole number loses its .0, signs become underscores."""
    s = str(name).strip()
    s = s[:-2] if re.fullmatch(r"\d+\.0", s) else s
    return re.sub(r"_+", "_", re.sub(r"[ \-.$/\\]", "_", s)).strip("_").lower()


def store_name(name: str) -> str:
    """Names a document store takes: no dots and dollars, at most one leading underscore."""
    s = re.sub(r"[.$]", "_", name)
    return re.sub(r"^_{2,}", "_", s)


def search_name(name: str) -> str:
    """The name of a field in the search layer; names that are not known keep their case."""
    if name in SEARCH_NAMES:
        return SEARCH_NAMES[name]
    if name.lower() in SEARCH_SPELT and name[:1].isupper():
        return name.lower()
    return re.sub(r"[.()]", "", re.sub(r"[ \-/]", "_", name)).replace("+", "_plus_")


def mapping_name(name: str) -> str:
    s = re.sub(r"[^A-Za-z0-9_]", "_", name)
    return re.sub(r"_+", "_", re.sub(r"([a-z])([A-Z])", r"\1_\2", s).lower()).strip("_")


def clean_id(name: str, length: int = 50) -> str:
    s = re.sub(r"[-\s]+", "_", re.sub(r"[^\w\s-]", "", name))
    return s.strip("_").lower()[:length]


def clean_id_sql(c: str, length: int = 50) -> str:
    s = rf"regexp_replace(regexp_replace({c}, r'(?U)[^\w\s-]', ''), r'(?U)[-\s]+', '_')"
    return f"left(lower(trim(both '_' from {s})), {length})"


def resource_name_sql(c: str) -> str:
    """A resource's name without mentions of its format, each suffix taken off once, in order."""
    s = f"trim(lower(coalesce({c}, '')))"
    for suffix in FORMAT_SUFFIXES:
        s = f"regexp_replace({s}, '{suffix.replace('.', '[.]')}$', '')"
    return rf"trim(regexp_replace({s}, r'{_FORMAT_PARENS}', ''))"


def base_name_sql(c: str) -> str:
    """Without year and version, to group what may be one series."""
    return rf"trim(regexp_replace(regexp_replace(regexp_replace({c}, r'(?i){YEAR}', ''), r'(?i){VERSION}', ''), r'[_\-]+$', ''))"


def url_name_sql(url: str) -> str:
    """The file name of a URL, normalised as resource names are."""
    return resource_name_sql(rf"regexp_extract(regexp_replace(coalesce({url}, ''), r'[?].*$', ''), r'([^/]*)$', 1)")


def signature_sql(normal: str, url_name: str, url: str, ident: str) -> str:
    """What tells data sources apart, of a normalised name and file name: the name, with the year in
    the URL or the file name where that says more and the name has no year; the id where there is
    neither."""
    year = rf"regexp_extract(coalesce({url}, ''), r'{YEAR}', 1)"
    more = f"case when {year} != '' then {year} when {url_name} != '' and {url_name} != {normal} then {url_name} else '' end"
    sig = rf"case when {more} != '' and regexp_extract({normal}, r'{YEAR}', 1) = '' then concat({normal}, ':', {more}) else {normal} end"
    return f"coalesce(nullif({sig}, ''), {ident}, 'unknown')"


def base_path(url: str) -> str:
    """A URL without what says its format."""
    m = re.fullmatch(r"(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?", url)
    scheme, host, path, query = (g or "" for g in m.groups())
    path = re.sub(r"(?i)[/.](?:csv|xml|json)$", "", path, count=1)
    keep = [p for p in query.split("&") if p and not re.search("output=|format=|xml=", p.lower())]
    return f"{scheme}://{host}{path}" + ("?" + "&".join(keep) if keep else "")


# Parts of a path that tell nothing.
UNTELLING = ["members", "api", "data", "export", "en", "fr"]


def file_name(url: str, fmt: str) -> str | None:
    """A file name for what a URL gives: the part before a format name, the last part's stem, or the
    last three telling parts of the path; None if none tells."""
    path = re.sub(r"^(?:[^:/?#]+:)?(?://[^/?#]*)?", "", url)
    parts = re.sub(r"[?#].*$", "", path).strip("/").split("/")
    last = parts[-1]
    if not last and len(parts) == 1:
        return f"parliament_votes.{fmt}"
    if last.lower() == fmt:
        return f"{parts[-2]}.{fmt}" if len(parts) > 1 else f"data.{fmt}"
    if "." in last:
        return f"{last.rsplit('.', 1)[0].lower()}.{fmt}"
    if last and not last.isdigit():
        return f"{last.lower()}.{fmt}"
    tell: list[str] = []
    for p in (p.lower() for p in parts):
        if p not in (*UNTELLING, fmt) and (tell or not p.isdigit()):
            tell.append(p)
    return f"{'_'.join(tell[-3:])}.{fmt}" if tell else None


def names_match(a: str, b: str) -> str:
    """SQL: whether two resource names are one but for mentions of a format."""
    return f"{resource_name_sql(a)} = {resource_name_sql(b)}"
