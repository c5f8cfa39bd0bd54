"""Same postal address written differently (problem 2).

Method: a self-built gazetteer. Every record is parsed into number, street name, type, direction,
city and postal code. Street spellings are clustered within localities, rare ones joining frequent
ones that are a typo or two away; each street (city, name, type, direction) gets an identifier.
Every address is then resolved by a beam search over the gazetteer entries of its name, city first,
then type, then direction, parts that are left out being free; and records are joined on identifier
and number. The first stage (city) is an aggregate over all cities that have the street, the others
run over the entries of the street in that city, of which there are types by directions at most. Units make no new location here, so they are parsed but are no part of the join.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from math import log

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cedarloom.functions.rows import once
from cedarloom.functions.values import NULL_VALUES
from cedarloom.io import cut
from cedarloom.llm.names import distance, edits, shard_keys

TYPES = {
    "avenue": ["avenue", "ave", "av", "aven"],
    "boulevard": ["boulevard", "blvd", "boul", "bvd", "blv"],
    "circle": ["circle", "cir", "circ"],
    "close": ["close"],
    "court": ["court", "ct", "crt"],
    "crescent": ["crescent", "cres", "cr", "crs", "cresc"],
    "drive": ["drive", "dr", "drv"],
    "gardens": ["gardens", "gdns", "gds", "gdn"],
    "gate": ["gate"],
    "grove": ["grove", "grv"],
    "heights": ["heights", "hts"],
    "highway": ["highway", "hwy"],
    "hill": ["hill"],
    "lane": ["lane", "la", "ln"],
    "parkway": ["parkway", "pkwy", "pky", "pkway"],
    "path": ["path"],
    "place": ["place", "pl", "plc"],
    "road": ["road", "rd", "chemin", "ch"],
    "square": ["square", "sq", "sqr"],
    "street": ["street", "st", "str", "rue"],
    "terrace": ["terrace", "ter", "terr", "tce"],
    "trail": ["trail", "trl", "tr"],
    "walk": ["walk"],
    "way": ["way"],
}
_TYPE = {v: k for k, own in TYPES.items() for v in own}
_DIR = {"n": "n", "north": "n", "nord": "n", "s": "s", "south": "s", "sud": "s", "e": "e", "east": "e", "est": "e", "w": "w", "west": "w", "ouest": "w", "o": "w"}
_PREFIX = {"old": "old", "olde": "old", "fort": "fort", "ft": "fort", "mount": "mount", "mt": "mount", "saint": "saint", "st": "saint", "sainte": "saint", "upper": "upper", "lower": "lower", "new": "new", "grand": "grand", "lake": "lake", "port": "port"}
_NUMBER = {w: str(i) for i, w in enumerate("one two three four five six seven eight nine ten eleven twelve".split(), 1)}
# the letter o is typed for zero
_POSTAL = re.compile(r"\b([a-z][\do][a-z])\s*-?\s*([\do][a-z][\do])\b")
_FSA = re.compile(r"\b([a-z]\d[a-z])\b\s*$")
_UNIT = re.compile(r"\b(?:unit|apt|apartment|suite|ste|rm|room)\b\.?\s*(?:#|no\.?)?\s*\d*[a-z]?\d*\b|#\s*\w+")
_REMARK = re.compile(r"\([^)]*\)|\b\d+(?:st|nd|rd|th)\s+floor\b|\b(?:ground|main|first|second|third)\s+floor\b|\bfloor\s+\d+\b|\b(?:side|rear|front|back|main|north|south|east|west)\s+(?:entrance|door)\b|\bbasement\b|\brear\b|\bentrance\b|\blower level\b|\bcanada\b|\b(?:ontario|ont|on)\b\.?")
_BUILDING = re.compile(r"\b[^\s,]+\s+(?:house|centre|center|plaza|mall|towers?|building|bldg|complex|hall|manor|lodge)\b")
_AT = re.compile(r"\b(?:at|near|corner of|opposite)\s+.*$")


def fold(s: str | None) -> str:
    """Lower case, without accents, with single spaces."""
    s = unicodedata.normalize("NFKD", (s or "").lower())
    return re.sub(r"\s+", " ", "".join(c for c in s if not unicodedata.combining(c))).strip()


def bare(s: str) -> str:
    return re.sub(r"[^a-z0-9]", "", s)


def zeros(code: str) -> str:
    """A postal code, or its first half, with the digits where digits stand."""
    return "".join("0" if c == "o" and i % 2 else c for i, c in enumerate(code))


def near_edits(b: str) -> int:
    """How many typos a locality of this spelling may have."""
    return 2 if len(b) > 6 else 1 if len(b) > 3 else 0


def words_of(text: str | None) -> tuple[str, list[list[str]]]:
    """(postal code or its first half, the words of each part between commas) of an address text."""
    s, postal = fold(text), ""
    if m := _POSTAL.search(s):
        postal, s = zeros(m[1] + m[2]), s[: m.start()] + " " + s[m.end() :]
    s = _REMARK.sub(" ", s)
    if not postal and (m := _FSA.search(s.rstrip(" ,.-"))):
        postal, s = m[1], s[: m.start()]
    s = _UNIT.sub(" , ", s)
    s = re.sub(r"\bno\.?\s*(?=\d|one|two|three|four|five|six|seven|eight|nine)", " ", s)
    s = re.sub(r"(?<=[a-z])-(?=[a-z])", "", s)
    parts = [[w for w in (x.strip(".;:'\"") for x in p.split()) if w and w != "-"] for p in s.split(",")]
    return postal, [p for p in parts if p]


def ends(parts: list[list[str]], near: bool) -> Iterator[tuple[list[str], list[tuple[int, int]]]]:
    """Up to three words at either end that could name a locality, with their places. Those that
    could do so with a typo (near) are no numbers and hold no type of street but a leading st."""
    flat = [(i, j) for i, p in enumerate(parts) for j in range(len(p))]
    for k in (3, 2, 1):
        for at in (flat[-k:], flat[:k]):
            if len(at) == k and len(flat) > k:
                own = [parts[i][j] for i, j in at]
                if any(w[0].isdigit() for w in own) or (k == 1 and (own[0] in _TYPE or own[0] in _DIR)):
                    continue
                if near and (any(w in _NUMBER for w in own) or any(w in _TYPE for w in own[1:]) or (own[0] in _TYPE and own[0] != "st")):
                    continue
                yield own, at


class Parser:
    """Reads addresses. Which words name a locality is what the table of localities says of the
    words at the ends of this record (knowing), or a list of bare spellings."""

    def __init__(self, cities: list[str] = ()):
        self.exact, self.close, self.known = {bare(fold(c)): bare(fold(c)) for c in cities}, None, {}

    def knowing(self, exact: dict[str, str], close: dict[str, str]) -> Parser:
        self.exact, self.close = exact, close
        return self

    def city(self, text: str | None, near: bool = True) -> str:
        """The locality a text names, by a typo or two; '' if none."""
        b = bare(fold(text))
        if b in self.exact or not b or not near:
            return self.exact.get(b, "")
        if self.close is not None:
            return self.close.get(b, "")
        if b not in self.known:
            best = min(((distance(b, c, 2), c) for c in self.exact), default=(3, ""))
            self.known[b] = best[1] if best[0] <= near_edits(b) else ""
        return self.known[b]

    def _split_city(self, parts: list[list[str]]) -> str:
        """Takes the city out of the parts (between commas) of words, from the ends."""
        for near in (False, True):
            for own, at in ends(parts, near):
                c = self.city(" ".join(own), near)
                if c and not (near and abs(len(bare(" ".join(own))) - len(c)) > 1):
                    for i, j in sorted(at, reverse=True):
                        parts[i].pop(j)
                    return c
        return ""

    def parse(self, text: str | None) -> dict | None:
        """number, name, type, direction, city, postal of an address text; None if it has no number
        and street. Parts that are left out are ''."""
        return self.parts(*words_of(text))

    def parts(self, postal: str, parts: list[list[str]]) -> dict | None:
        city = self._split_city(parts)
        number, rest = "", []
        for p in parts:
            own = []
            for w in p:
                m = re.fullmatch(r"(?:\d*[a-z]?\d*-)?0*(\d+)-?([a-z]?)", w)
                if m and not number:
                    number = m[1] + m[2]
                elif w in _NUMBER and not number:
                    number = _NUMBER[w]
                elif m:
                    continue
                else:
                    own.append(w)
            rest.append(own)
        if not number:
            return None
        words = [w for p in rest for w in _BUILDING.sub(" ", " ".join(p)).split()]
        if len(words) > 2 and words[0] in ("a", "b", "c", "d"):
            number, words = number + words[0] if number.isdigit() else number, words[1:]
        kind = direction = prefix = ""
        if len(words) > 1 and words[-1] in _DIR:
            direction = _DIR[words.pop()]
        if len(words) > 1 and words[0] in _DIR:
            direction = direction or _DIR[words[0]]
            words = words[1:]
        if len(words) > 1 and words[-1] in _TYPE:
            kind = _TYPE[words.pop()]
        if len(words) > 1 and not direction and words[-1] in _DIR:
            direction = _DIR[words.pop()]
        if len(words) > 1 and not kind and words[0] in _TYPE and not (words[0] == "st" and words[0] in _PREFIX):
            kind, words = _TYPE[words[0]], words[1:]
        if len(words) > 1 and words[0] in _PREFIX:
            prefix, words = _PREFIX[words[0]], words[1:]
        name = bare("".join(words))
        if not name or name in ("unknown", "addresswithheld"):
            return None
        return {"num": number, "name": name, "prefix": prefix, "kind": kind, "dir": direction, "city": city, "postal": postal}

    def record(self, texts: list[tuple[str, list[list[str]]]], city: str, postal: str) -> dict | None:
        """The parts of a record of several address texts (see words_of), the bare city and the bare
        postal code; the first text that is readable leads."""
        out = None
        for t in texts:
            if p := self.parts(*t):
                if out is None:
                    out = p
                elif p["num"] == out["num"]:
                    out |= {k: v for k, v in p.items() if v and (not out[k] or k == "postal" and len(v) > len(out[k]))}
        if out:
            out["city"] = self.exact.get(city, city) or out["city"]
            if re.fullmatch(r"[a-z]\d[a-z](\d[a-z]\d)?", postal) and len(postal) > len(out["postal"]):
                out["postal"] = postal
        return out


def prepared(premises: DataFrame) -> DataFrame:
    """(premise_id, texts, city, postal, words, typos): the address texts taken apart, each as postal
    code, bar, and parts between commas; the bare city; the words at the ends of the texts that could
    name a locality, and those that could do so with a typo, where no city is given."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for r in b.itertuples(index=False):
                texts = [words_of(t) for t in (r.addr_full, r.address, r.shelter_address) if isinstance(t, str)]
                texts = [t for t in texts if t[1]]
                if not texts:
                    continue
                city = bare(fold(r.city)) if isinstance(r.city, str) and r.city.strip().lower() not in NULL_VALUES else ""
                postal = zeros(bare(fold(r.postal_code))) if isinstance(r.postal_code, str) else ""
                words, typos = ({bare("".join(own)) for _, p in texts for own, _ in ends(p, near)} for near in (False, True))
                rows.append((r.premise_id, [f"{c}|" + ",".join(" ".join(p) for p in parts) for c, parts in texts], city, postal, sorted({city, *words} - {""}), [] if city else sorted(typos - {""})))
            if rows:
                yield pd.DataFrame(rows, columns=["premise_id", "texts", "city", "postal", "words", "typos"])

    own = premises.select("premise_id", "addr_full", "address", "shelter_address", "city", "postal_code")
    return own.mapInPandas(run, "premise_id bigint, texts array<string>, city string, postal string, words array<string>, typos array<string>")


def _keyed(df: DataFrame, text: str) -> DataFrame:
    """df with a row for each shard key of a text: texts within two edits share one (see names)."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            keys = [shard_keys(t) for t in b[text]]
            yield b.loc[b.index.repeat([len(k) for k in keys])].assign(form=np.concatenate(keys) if keys else [])

    return df.mapInPandas(run, schema + ", form bigint")


def followed(near: DataFrame, key: list[str], name: str) -> DataFrame:
    """(key, name, canon) with each canon followed to its end. Each step to a canon at least triples
    the count, so that chains are short; each round doubles what is followed."""
    at = cut(near.select(*key, name, "canon"), "canon")
    while True:
        far = at.select(*key, F.col(name).alias("canon"), F.col("canon").alias("far"))
        hop = lambda df: df.join(far, [*key, "canon"], "left").selectExpr(*key, name, "coalesce(far, canon) as canon", "far is not null as moved")  # noqa: B023, E731
        nxt = cut(hop(hop(at).drop("moved")), "canon")
        at = nxt.drop("moved")
        if nxt.where("moved").isEmpty():
            return at


def localities(rows: DataFrame) -> DataFrame:
    """(city, canon) of each bare spelling of a city in rows (city, postal); one that no other
    explains stands for itself, however rare it is. A spelling joins the nearest one that is one
    edit away and three times as frequent, or two edits (of seven letters or more) and six times,
    unless both have postal areas and none in common."""
    own = rows.where("city != ''").selectExpr("city", "case when postal rlike '^[a-z][0-9][a-z]' then left(postal, 3) end as fsa")
    counts = cut(own.groupBy("city", "fsa").agg(F.count("*").alias("n")), "cities")
    names = counts.groupBy("city").agg(F.sum("n").alias("n"))
    form = _keyed(names.where("length(city) >= 4"), "city")
    near = form.join(form.where("n >= 3").selectExpr("city as canon", "n as canon_n", "form"), "form").where("canon_n >= 3 * n and city != canon")
    near = once(near.drop("form").distinct(), d=edits("city", "canon")).where("d = 1 or (d = 2 and canon_n >= 6 * n and length(city) > 6)")
    areas = counts.where("fsa is not null").select("city", "fsa")
    common = near.join(areas, "city").join(areas.withColumnRenamed("city", "canon"), ["canon", "fsa"]).select("city", "canon").distinct().withColumn("common", F.lit(True))
    has = lambda c: areas.select(F.col("city").alias(c)).distinct().withColumn(f"{c}_has", F.lit(True))
    near = near.join(common, ["city", "canon"], "left").join(has("city"), "city", "left").join(has("canon"), "canon", "left").where("common or city_has is null or canon_has is null")
    best = near.groupBy("city").agg(F.max(F.struct(-F.col("d"), F.col("canon_n"), F.col("canon"))).alias("m")).selectExpr("city", "m.canon as canon")
    return names.select("city").join(followed(best, [], "city"), "city", "left").selectExpr("city", "coalesce(canon, city) as canon")


def parsed(premises: DataFrame) -> DataFrame:
    """(premise_id, num, name, prefix, kind, dir, city, postal) of the records with a usable address.
    The localities are a table that the words at the ends of the texts are joined to."""
    fields = ["num", "name", "prefix", "kind", "dir", "city", "postal"]
    at = cut(prepared(premises), "prepared")
    places = cut(localities(at), "localities")
    words = at.selectExpr("premise_id", "typos", "explode(words) as word")
    exact = words.join(places.withColumnRenamed("city", "word"), "word").select("premise_id", "word", "canon", F.lit(True).alias("exact"))
    typos = cut(at.where("size(typos) > 0").join(exact.select("premise_id").distinct(), "premise_id", "left_anti").selectExpr("premise_id", "explode(typos) as word"), "typos")
    form = _keyed(typos.select("word").distinct(), "word").join(_keyed(places.selectExpr("canon").distinct(), "canon"), "form").where("word != canon")
    form = once(form.drop("form").distinct(), d=edits("word", "canon")).where("d <= case when length(word) > 6 then 2 when length(word) > 3 then 1 end")
    close = form.groupBy("word").agg(F.min(F.struct("d", "canon")).alias("m")).selectExpr("word", "m.canon as canon")
    close = typos.join(close, "word").select("premise_id", "word", "canon", F.lit(False).alias("exact"))
    # at most six words for each of three texts, and the city
    known = exact.unionByName(close).groupBy("premise_id").agg(F.collect_list(F.struct("word", "canon", "exact")).alias("known"))
    at = at.join(known, "premise_id", "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parser = Parser()
        for b in batches:
            rows = []
            for r in b.itertuples(index=False):
                known = r.known if r.known is not None else []
                exact, close = ({k["word"]: k["canon"] for k in known if k["exact"] == e} for e in (True, False))
                if r.city and (own := exact.get(r.city)):
                    # a text that names the stated city with a typo
                    close |= {w: own for w in r.words if w not in exact and distance(w, own, 2) <= near_edits(w)}
                texts = [(c, [p.split(" ") for p in t.split(",")]) for c, t in (x.split("|", 1) for x in r.texts)]
                if p := parser.knowing(exact, close).record(texts, r.city, r.postal):
                    rows.append((r.premise_id, *(p[f] for f in fields)))
            if rows:
                yield pd.DataFrame(rows, columns=["premise_id", *fields])

    at = at.select("premise_id", "texts", "city", "postal", "words", "known")
    return at.mapInPandas(run, "premise_id bigint, " + ", ".join(f"{f} string" for f in fields))


def _spellings(names: DataFrame) -> DataFrame:
    """(city, name, canon) for names (city, name, n): a spelling joins the nearest, then most
    frequent one of its locality that is one edit away and three times as frequent, or two edits and
    six times; what that one joins is followed. Neighbours share a shard key; the join is on that."""
    each = cut(_keyed(names.where("length(name) >= 5"), "name"), "forms")
    often = each.where("n >= 3").selectExpr("city", "name as canon", "n as canon_n", "form")
    pairs = lambda rare: each.where(rare).join(often, ["city", "form"]).where("canon_n >= 3 * n and name != canon").drop("form")
    # of long names a pair is compared once, not for every key they share
    near = pairs("length(name) <= 32").unionByName(pairs("length(name) > 32").distinct())
    near = once(near, d=edits("name", "canon")).where("d = 1 or (d = 2 and canon_n >= 6 * n)")
    best = near.groupBy("city", "name").agg(F.max(F.struct(-F.col("d"), F.col("canon_n"), F.col("canon"))).alias("m"))
    return followed(best.selectExpr("city", "name", "m.canon as canon"), ["city"], "name")


def _agree(a: str, b: str) -> bool:
    return not a or not b or a == b


def beam(sig: dict, entries: list[tuple[str, str, int]], here: dict[tuple, int], full: set, part: set, width: int = 8) -> tuple | None:
    """The gazetteer entry (type, direction) of a street that fits a signature best, type first, then
    direction. entries: those of the street with their counts; here: those seen at the number, with
    their counts; full and part: those seen there with the postal code or the first half of it."""

    def weight(e: tuple, n: int) -> float:
        return log(1 + n) / 4 + 6.0 * (e in here) + log(1 + here.get(e, 0)) + 8.0 * (e in full) + 2.0 * (e in part)

    total = {e[:2]: weight(e[:2], e[2]) for e in entries if _agree(sig["kind"], e[0]) and _agree(sig["dir"], e[1])}
    states: list[tuple] = [()]
    for i in range(2):
        ahead = {e[: i + 1] for e in total if e[:i] in states}
        rank = lambda s: max(v for e, v in total.items() if e[: len(s)] == s)
        states = sorted(ahead, key=lambda s: (-rank(s), s))[:width]
    return states[0] if states else None


def _settled(ways: DataFrame, entry: DataFrame, homeless: DataFrame) -> DataFrame:
    """(sig, found): the city of the ways (sig, n) that give none, the first stage of the beam. The
    cities that have the street are ranked by whether they have the number, the postal area, and how
    many records; only those count that agree with type and direction. Each combination of what
    a way may leave out has its best city kept by an aggregate, so no group is collected."""
    held = ways.where("city != ''").select("street", "num", "city", F.col("kind").alias("k"), F.col("dir").alias("t"), F.expr("left(postal, 3) as fsa"), "n")
    held = held.join(entry.select("street", "city", "kind", "dir"), ["street", "city"]).where("(k = '' or k = kind) and (t = '' or dir = '' or t = dir)")
    held = held.join(homeless.select("street").distinct(), "street", "left_semi")
    held = held.groupBy("street", "num", "city", "kind", "dir", "fsa").agg(F.sum("n").alias("n"))
    held = held.withColumn("num", F.expr("explode(array_distinct(array(num, '')))")).withColumn("fsa", F.expr("explode(array_distinct(array(fsa, '')))"))
    held = held.groupBy("street", "num", "city", "kind", "dir", "fsa").agg(F.sum("n").alias("n"))
    held = held.withColumn("kind", F.expr("explode(array(kind, ''))")).withColumn("dir", F.expr("explode(array(case when dir = '' then '#' else dir end, ''))"))
    best = held.groupBy("street", "num", "kind", "dir", "fsa").agg(F.max(F.struct("n", "city")).alias("m"))
    keys = """explode(array_distinct(transform(array(0, 1, 2, 3, 4, 5, 6, 7), i -> struct(case when i div 4 = 0 then num else '' end as num,
        case when i div 2 % 2 = 0 then left(postal, 3) else '' end as fsa, case when dir != '' and i % 2 = 1 then '#' else dir end as dir)))) as look"""
    rank = "case when look.num != '' then 4 else 0 end + case when look.fsa != '' then 2 else 0 end + case when look.dir != '#' then 1 else 0 end as rank"
    look = homeless.selectExpr("num as own_num", "street", "kind", "dir as own_dir", "postal", keys).selectExpr("own_num", "street", "kind", "own_dir", "postal", "look.num as num", "look.fsa as fsa", "look.dir as dir", rank)
    found = look.join(best, ["street", "num", "kind", "dir", "fsa"]).groupBy("own_num", "street", "kind", "own_dir", "postal").agg(F.max(F.struct("rank", "m.n", "m.city")).alias("f"))
    return found.selectExpr("own_num as num", "street", "'' as city", "kind", "own_dir as dir", "postal", "f.city as found")


def resolved(parts: DataFrame) -> DataFrame:
    """(premise_id, street_id, num): the identifier of the street of each record, and its number."""
    parts = cut(parts, "parts")
    fsa = parts.where("city != '' and postal != ''").selectExpr("left(postal, 3) as fsa", "city").groupBy("fsa", "city").agg(F.count("*").alias("n"))
    # a forward sortation area is a letter, a digit and a letter: 6,760 at most
    town = fsa.groupBy("fsa").agg(F.max(F.struct("n", "city")).alias("m"), F.sum("n").alias("all")).where("m.n >= 0.8 * all").selectExpr("fsa", "m.city as fsa_city")
    at = parts.withColumn("fsa", F.expr("left(postal, 3)")).join(F.broadcast(town), "fsa", "left")
    at = at.withColumn("city", F.expr("case when city = '' then coalesce(fsa_city, '') else city end")).drop("fsa", "fsa_city")

    names = at.groupBy("city", "name").agg(F.count("*").alias("n"))
    # a name without a city is what it is in some city, or else near one that is frequent anywhere
    homed, lone = names.where("city != ''"), names.where("city = ''")
    other = lone.join(homed.select("name"), "name", "left_anti")
    often = homed.groupBy("name").agg(F.sum("n").alias("n")).where("n >= 3")
    canon = _spellings(homed.select("city", "name", "n").unionByName(often.selectExpr("'' as city", "name", "n")).unionByName(other.select("city", "name", "n")))
    known = homed.join(canon, ["city", "name"], "left").selectExpr("name", "coalesce(canon, name) as canon", "n").groupBy("name", "canon").agg(F.sum("n").alias("n"))
    known = known.groupBy("name").agg(F.max(F.struct("n", "canon")).alias("m")).selectExpr("name", "m.canon as known")
    far = lone.select("name").join(canon.where("city = ''").select("name", "canon"), "name", "left")
    far = far.withColumn("near", F.expr("coalesce(canon, name)")).drop("canon").join(known.withColumnRenamed("name", "near"), "near", "left")
    own = known.select("name", F.col("known").alias("own"))
    far = far.join(own, "name", "left").selectExpr("'' as city", "name", "coalesce(own, known, near) as canon")
    canon = canon.where("city != ''").select("city", "name", "canon").unionByName(far)
    at = at.join(canon, ["city", "name"], "left")
    at = at.withColumn("street", F.expr("concat_ws(' ', case when prefix != '' then prefix end, coalesce(canon, name))")).drop("canon", "name", "prefix")
    sig = ["num", "street", "city", "kind", "dir", "postal"]
    at = cut(at.select("premise_id", *sig), "named")

    # one row for each way a number of a street is written, however many records share it
    ways = cut(at.groupBy(*sig).agg(F.count("*").alias("n")), "ways")
    entry = ways.where("city != '' and kind != ''").groupBy("street", "city", "kind", "dir").agg(F.sum("n").alias("n"))
    # without a direction a street is its namesake with one, if there is one
    entry = entry.withColumn("turns", F.expr("max(dir != '') over (partition by street, city, kind)")).where("dir != '' or not turns").drop("turns")
    # where nobody gives both city and type the fullest way stands for the street
    place = ["street", "city"]
    only = ways.join(entry.select(*place).distinct(), place, "left_anti").groupBy(*place).agg(F.max(F.struct(F.expr("kind != ''"), F.expr("dir != ''"), "n", "kind", "dir")).alias("m"))
    entry = cut(entry.unionByName(only.selectExpr(*place, "m.kind as kind", "m.dir as dir", "m.n as n")), "entries")
    homeless = ways.where("city = ''")
    ways = ways.join(_settled(ways, entry.where("city != ''"), homeless), sig, "left").withColumn("home", F.expr("coalesce(found, city)")).drop("found")
    ways = cut(ways, "homes")

    # entries of a street in a city: types by directions, 125 at most; all groups below are of these
    spot = [F.col("num"), F.col("street"), F.col("home")]
    bound = ways.where("kind != ''").join(entry.selectExpr("street", "city as home", "kind", "dir as turn"), ["street", "home", "kind"])
    bound = bound.withColumn("alone", F.expr("dir = turn or turn = ''")).where("alone").select(*spot, "kind", F.col("turn").alias("dir"), "postal", "n")
    sets = lambda keys, where, name: bound.where(where).groupBy(*keys).agg(F.collect_set(F.struct("kind", "dir")).alias(name))
    seen = bound.groupBy(*spot, "kind", "dir").agg(F.sum("n").alias("n")).groupBy(*spot).agg(F.collect_list(F.struct("kind", "dir", "n")).alias("here"))
    book = entry.groupBy("street", F.col("city").alias("home")).agg(F.collect_list(F.struct("kind", "dir", "n")).alias("entries"))
    open_ways = ways.join(book, ["street", "home"], "left").join(seen, ["num", "street", "home"], "left")
    open_ways = open_ways.join(sets([*spot, F.col("postal")], "length(postal) = 6", "full"), ["num", "street", "home", "postal"], "left")
    open_ways = open_ways.withColumn("fsa", F.expr("left(postal, 3)")).join(sets([*spot, F.expr("left(postal, 3) as fsa")], "postal != ''", "part"), ["num", "street", "home", "fsa"], "left")
    clear = "exists(entries, e -> e.kind = kind and e.dir = dir)"
    open_ways = open_ways.selectExpr(*sig, "home", "entries", "here", "full", "part", f"coalesce({clear}, false) as clear")
    open_ways = cut(open_ways, "open")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pair = lambda rows: {(e["kind"], e["dir"]) for e in rows} if rows is not None else set()
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                entries = [(e["kind"], e["dir"], e["n"]) for e in r.entries] if r.entries is not None else []
                here = {(e["kind"], e["dir"]): e["n"] for e in r.here} if r.here is not None else {}
                own = {"kind": r.kind, "dir": r.dir}
                e = beam(own, entries, here, pair(r.full), pair(r.part)) or (r.kind, r.dir)
                out.append((*(getattr(r, c) for c in sig), "|".join((r.street, r.home, *e))))
            if out:
                yield pd.DataFrame(out, columns=[*sig, "street_id"])

    ids = open_ways.where("not clear").drop("clear").mapInPandas(run, ", ".join(f"{c} string" for c in sig) + ", street_id string")
    ids = ids.unionByName(open_ways.where("clear").selectExpr(*sig, "concat_ws('|', street, home, kind, dir) as street_id"))
    return at.join(ids, sig).select("premise_id", "street_id", "num")


def same_address(premises: DataFrame) -> DataFrame:
    """(premise_a, premise_b), smaller first: the pairs of records at one location. Records without
    a usable address are in no pair; null fields, empty and very long texts are read as they are;
    a location of many records gives all its pairs, which is what the result is."""
    at = cut(resolved(parsed(premises)), "resolved")
    a, b = at.withColumnRenamed("premise_id", "premise_a"), at.withColumnRenamed("premise_id", "premise_b")
    return a.join(b, ["street_id", "num"]).where("premise_a < premise_b").select("premise_a", "premise_b")
