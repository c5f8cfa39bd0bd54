"""Coordinates as text, in several notations, to latitude and longitude."""

from __future__ import annotations

_N = r"([+-]?\d+(?:\.\d+)?)"
_DECIMAL = r"^[\s ]*([+-]?\d+(?:[.,]\d+)?)\s*°?\s*([NSEWnsew])?[\s ]*$"
_DMS = r"^\s*(\d{1,3})[°\s]+(\d{1,2})['′\s]+(\d{1,2}(?:[.,]\d+)?)[\"″\s]*([NSEWnsew])\s*$"
_POINT = rf"(?i)^\s*(?:SRID=\d+;)?\s*POINT\s*Z?\s*\(\s*{_N}[\s,]+{_N}.*$"
_PAIR = rf"^\s*[(\[]?\s*{_N}\s*[,; ]\s*{_N}\s*[)\]]?\s*$"
_GEOJSON = rf"(?s)^.*\"coordinates\"\s*:\s*[\[\s]+{_N}\s*,\s*{_N}.*$"
_LAT = rf"(?is)^.*\blat(?:itude)?\"?\s*[:=]\s*\"?{_N}.*$"
_LON = rf"(?is)^.*\blo?ng?(?:itude)?\"?\s*[:=]\s*\"?{_N}.*$"


def _group(s: str, pattern: str, form: str) -> str:
    return f"case when {s} rlike r'{pattern.replace(chr(39), chr(92) + 'x27')}' then regexp_replace({s}, r'{pattern.replace(chr(39), chr(92) + 'x27')}', '{form}') end"


def angle(s: str) -> str:
    """Degrees of one text: decimal, with a point or a comma, or degrees, minutes and seconds."""
    dec = f"split({_group(s, _DECIMAL, '$1~$2')}, '~', -1)"
    dms = f"split({_group(s, _DMS, '$1~$2~$3~$4')}, '~', -1)"
    num = lambda x: f"try_cast(replace({x}, ',', '.') as double)"
    sign = lambda x: f"case when upper({x}) in ('S', 'W') then -1 else 1 end"
    return f"""coalesce(
        (case when {dec}[1] != '' then abs({num(dec + '[0]')}) * {sign(dec + '[1]')} else {num(dec + '[0]')} end),
        ({num(dms + '[0]')} + {num(dms + '[1]')} / 60 + {num(dms + '[2]')} / 3600) * {sign(dms + '[3]')})"""


def place(s: str) -> str:
    """struct(lat, lon) of a text with both: WKT point, pair, or named values."""
    two = lambda pattern, form: f"split({_group(s, pattern, form)}, '~', -1)"
    wkt, pair, lat, lon = two(_POINT, "$2~$1"), two(_PAIR, "$1~$2"), _group(s, _LAT, "$1"), _group(s, _LON, "$1")
    st = lambda a, b: f"struct(try_cast({a} as double) as lat, try_cast({b} as double) as lon)"
    return f"case when {wkt} is not null then {st(wkt + '[0]', wkt + '[1]')} when {pair} is not null then {st(pair + '[0]', pair + '[1]')} else {st(lat, lon)} end"


def geojson_place(s: str) -> str:
    """struct(lat, lon) of the first position of a GeoJSON geometry, longitude first."""
    g = f"split({_group(s, _GEOJSON, '$2~$1')}, '~', -1)"
    return f"struct(try_cast({g}[0] as double) as lat, try_cast({g}[1] as double) as lon)"


def settle(p: str, box: tuple[float, float, float, float] | None) -> str:
    """The point a struct(lat, lon) means, or null. 0, impossible numbers and half a pair state
    nothing. With a box (south, north, west, east) a point outside it is tried with the sign of
    either changed and with latitude and longitude exchanged; what then lies in the box is meant."""
    ok = lambda a, b: f"({a} between -90 and 90 and {b} between -180 and 180 and {a} != 0 and {b} != 0)"
    a, b = f"{p}.lat", f"{p}.lon"
    if box is None:
        return f"case when {ok(a, b)} then {p} end"
    s, n, w, e = box
    inside = lambda x, y: f"{x} between {s} and {n} and {y} between {w} and {e}"
    forms = [(f"{i}{x}", f"{j}{y}") for x, y in ((a, b), (b, a)) for i in ("", "-") for j in ("", "-")]
    return "case " + " ".join(f"when {inside(x, y)} and {x} != 0 and {y} != 0 then struct({x} as lat, {y} as lon)" for x, y in forms) + " end"
