"""Mixed timestamp notations and zones to one instant (problem 6).

Method: an as-of join of the parsed local times to the intervals of constant offset of the zone.
Two matching intervals mean an ambiguous time (the earlier instant is taken), none a time that
never was, one gives the offset. The intervals are exploded to local years, so that the join is an
equi-join; the table has one row a year and is broadcast (its size is fixed by the years).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cedarloom.functions import instants as I
from cedarloom.functions.rows import once

ZONE = "America/Toronto"


def _readings(parsed: DataFrame, orders: dict[str, tuple[str, str]]) -> DataFrame:
    """For each named order of month and day a struct(utc, status)."""
    at = once(
        parsed,
        **{f"{k}_local": f"case when kind = 'n' then num_local else ({I.epoch_days('y', m, d)}) * {I.DAY_US}L + tod end" for k, (m, d) in orders.items()},
    )
    # the offsets of the intervals that hold the local time
    hits = "case when off is null and num_utc is null then transform(filter(spans, s -> s.lo <= {0}_local - zone_shift and {0}_local - zone_shift < s.hi), s -> s.off) end"
    at = once(at, **{f"{k}_hits": hits.format(k) for k in orders})
    reading = """case when num_utc is not null then struct(num_utc as utc, 'ok' as status)
        when {0}_local is null or (off is null and {0}_hits is null) then struct(cast(null as bigint) as utc, 'unreadable' as status)
        when off is not null then struct({0}_local - off as utc, 'ok' as status)
        when size({0}_hits) = 0 then struct(cast(null as bigint) as utc, 'nonexistent' as status)
        when size({0}_hits) > 1 then struct({0}_local - array_max({0}_hits) as utc, 'ambiguous' as status)
        else struct({0}_local - {0}_hits[0] as utc, 'ok' as status) end"""
    return once(at, **{k: reading.format(k) for k in orders})


def _parse(df: DataFrame, zone: str) -> DataFrame:
    """Adds kind, y, m, d, tod, off, num_local, num_utc and spans."""
    p = [f"p[{i}]" for i in range(10)]
    local, utc = I.number_us(p[1])
    cal = lambda sql: f"case when p[0] != 'n' then {sql} end"
    parsed = once(
        once(df, p=f"split({I.canonical('s')}, '~', -1)"),
        kind=p[0],
        y=cal(f"try_cast({p[1]} as int) + case when length({p[1]}) = 2 then 2000 else 0 end"),
        m=cal(I.month_of(p[2])),
        d=cal(f"try_cast({p[3]} as int)"),
        tod=cal(I.day_us(*p[4:9])),
        off=cal(I.zone_us(p[9])),
        num_local=f"case when p[0] = 'n' then {local} end",
        num_utc=f"case when p[0] = 'n' then {utc} end",
    ).drop("p")
    year = f"case when num_local is not null then year(date_from_unix_date(cast(num_local div {I.DAY_US}L as int))) else y end"
    parsed = once(once(parsed, local_year=year), zone_year=I.zone_year("local_year"))
    # how far a year of the table stands in for a later one; the first year's offset holds for all before
    shift = f"case when local_year = zone_year then 0L else ({I.epoch_days('local_year', '1', '1')} - ({I.epoch_days('zone_year', '1', '1')})) * {I.DAY_US}L end as zone_shift"
    spans = F.broadcast(I.offset_table(df.sparkSession, zone))
    return parsed.selectExpr("*", shift).join(spans, "zone_year", "left")


def normalise_instants(df: DataFrame, text_col: str, file_cols: list[str], zone: str = ZONE, salts: int = 32) -> DataFrame:
    """df with utc_us BIGINT and time_status STRING (ok, ambiguous, nonexistent, unreadable).

    Values without a zone are local time of `zone`; ambiguous ones get the earlier instant;
    nonexistent and unreadable ones get a null utc_us. Slashed dates are month first, unless in the
    same file (the values of `file_cols`) a value is readable day first and not month first.
    Null and empty text is unreadable. Rows without a file are read month first. Repeated rows
    come out as often as they went in; extra columns are kept, but for the working names
    s, kind, y, m, d, tod, off, num_local, num_utc, local_year, zone_year, zone_shift, spans and salt, which are renamed
    away from the input first. Only slashed rows are shuffled, on the file and a salt, so that one
    file may hold any share of them; the orders found are one row a file.
    """
    own = {c: f"_in{i}" for i, c in enumerate(df.columns)}
    src = df.selectExpr(*[f"`{c}` as {a}" for c, a in own.items()], f"{I.text(f'`{text_col}`')} as s")
    keep, files = [f"{a} as `{c}`" for c, a in own.items()], [own[c] for c in file_cols]
    slashed = r"coalesce(s rlike r'^\d{1,2}/\d{1,2}/\d', false)"

    plain = _readings(_parse(src.where(f"not {slashed}"), zone), {"r": ("m", "d")})
    plain = plain.selectExpr(*keep, "r.utc as utc_us", "r.status as time_status")

    both = _readings(_parse(src.where(slashed), zone), {"mf": ("m", "d"), "df": ("d", "m")}).select(*own.values(), "mf", "df")
    day_first = both.where("mf.utc is null and df.utc is not null").select(*files).distinct()
    day_first = day_first.selectExpr(*files, "true as day_first", f"explode(sequence(0, {salts - 1})) as salt")
    at = both.withColumn("salt", F.pmod(F.xxhash64(*own.values()), F.lit(salts)).cast("int")).join(day_first, [*files, "salt"], "left")
    r = "case when day_first then df else mf end"
    return plain.unionByName(at.selectExpr(*keep, f"({r}).utc as utc_us", f"({r}).status as time_status"))


def long_values(df: DataFrame, table_name: str, key: str, fields: list[str], file_col: str = "source_file") -> DataFrame:
    """One row for each field and row: table_name, rec_id, field_name, source_file, raw."""
    values = ", ".join(f"struct('{f}' as field_name, `{f}` as raw)" for f in fields)
    each = df.selectExpr(f"'{table_name}' as table_name", f"`{key}` as rec_id", f"`{file_col}` as source_file", f"explode(array({values})) as v")
    return each.selectExpr("table_name", "rec_id", "v.field_name as field_name", "source_file", "v.raw as raw")
