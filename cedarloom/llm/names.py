"""Variant spellings of names typed by people (problem 3).

Method: a trie join. Each name is read into what tells its entity apart: for an organisation the
coined words and the word or number of its site, group or branch; for a person surname and given
name. Kinds of business, legal forms, remarks, former names and numbered companies make no
difference. The distinct spellings are dealt into shards that any two spellings within the bounded
distance share; each shard is a trie that is traversed with a Levenshtein automaton (a swap of
neighbours being one edit) for every spelling, in either order of its words. A spelling then joins
the most frequent one among its neighbours of the same kind, and records with one canonical
spelling and one qualifier are one entity.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cedarloom.functions.rows import once
from cedarloom.functions.values import NULL_VALUES
from cedarloom.io import cut

MOST = 2
BLOCK = 2048
LONG = 32
_POWERS = np.cumprod(np.full(LONG + MOST + 2, 0x9E3779B97F4A7C15, dtype="uint64"))
# Kinds of business: word and the ways it is shortened.
KINDS = {
    "association": ["assoc", "assn"], "bakery": [], "bar": [], "barbershop": [], "care": [], "catering": [],
    "centre": ["center", "ctr", "cntr"], "coffee": [], "community": ["comm", "cmty", "commun"], "company": ["co"], "day": [],
    "delicatessen": ["deli", "delic"], "dentistry": [], "development": ["dev", "devt"], "emergency": ["emerg"], "esthetics": [],
    "family": ["fam"], "food": [], "foundation": ["found", "fdn"], "grill": [], "grocery": [], "hair": [], "health": ["hlth"],
    "home": [], "hostel": [], "house": [], "housing": ["hous", "hsg"], "kitchen": ["kitch", "ktchn"], "lodge": [],
    "management": ["mgmt", "mgt"], "market": ["mkt"], "ministries": ["min", "mins"], "noodle": [], "outreach": [], "pizza": [],
    "programs": ["prog", "programmes", "program"], "relief": [], "residence": ["res", "resid"], "respite": [], "restaurant": ["rest", "resto", "rstrnt"],
    "services": ["svc", "svcs", "serv", "service"], "settlement": [], "shelter": ["shltr", "shelt"], "social": ["soc"], "society": [],
    "studio": [], "support": ["supp"], "sushi": [], "tattoo": [], "youth": [],
}
# Trades and institutions beyond those: a seed, and a parameter of Reader, that may be any public list.
TRADES = {
    "academy": ["acad"], "agency": ["agcy"], "automotive": ["auto", "autos"], "bank": [], "boutique": [], "butcher": [], "cafe": [], "church": [],
    "cleaners": ["cleaning"], "clinic": [], "club": [], "college": ["coll"], "construction": ["constr", "const"], "consulting": ["consultants"],
    "contracting": ["contractors"], "cooperative": ["coop"], "dental": ["dentist", "dentists"], "department": ["dept"], "electric": ["elec", "electrical"],
    "enterprises": ["ent", "enterprise"], "fitness": [], "garage": [], "group": ["grp"], "holdings": ["hldgs"], "hospital": ["hosp"], "industries": ["inds"],
    "institute": ["inst"], "insurance": ["ins"], "international": ["intl"], "laboratory": ["lab", "labs"], "landscaping": [], "laundry": [], "library": ["lib"],
    "logistics": [], "manufacturing": ["mfg"], "medical": ["med"], "motors": [], "museum": [], "painting": [], "pharmacy": ["pharm"], "plumbing": ["plbg"], "pub": [],
    "realty": [], "renovations": ["reno", "renos"], "repairs": ["repair"], "roofing": [], "salon": [], "school": ["sch"], "solutions": ["solns"], "spa": [], "store": ["stores"],
    "supermarket": [], "supplies": ["supply"], "tavern": [], "technologies": ["tech"], "theatre": ["theater"], "towing": [], "trucking": [], "university": ["univ"],
}
# of two words as near to a misspelt one the first is taken
_KIND = {v: k for own in (KINDS, TRADES) for k, more in own.items() for v in (k, *more) if own is KINDS or v not in {x for a, b in KINDS.items() for x in (a, *b)}}
_LEGAL = {"inc", "incorporated", "ltd", "limited", "corp", "corporation", "llc", "llp", "incorp", "ltee", "the", "of", "and", "n", "a", "an", "le", "la", "les", "de", "du"}
_LONG_LEGAL = dict.fromkeys(("incorporated", "corporation", "limited"), "x")
_CUT = [*KINDS, *_LONG_LEGAL, "temporary"]
_TITLE = {"dr", "mr", "mrs", "ms", "mme", "mlle", "prof", "miss"}
# Given names and the short forms people use for them.
GIVEN = {
    "anthony": ["tony", "ant"], "catherine": ["cathy", "kate", "katherine", "cat", "kathy", "katie"], "dmitri": ["dima", "mitya", "dmitry"],
    "elizabeth": ["beth", "betty", "liz", "lizzie", "eliza"], "francesca": ["fran", "frankie", "franca"], "giuseppe": ["joe", "beppe", "pino", "joseph"],
    "henrietta": ["etta", "hettie", "henny", "hetty"], "johanna": ["jo", "hanna", "joanna", "johana"], "leonard": ["len", "leo", "lenny"],
    "margaret": ["meg", "maggie", "peggy", "marge"], "nicholas": ["nick", "niko", "nico", "nicky", "nikolas"], "robert": ["bob", "rob", "bobby", "robbie"],
    "samantha": ["sam", "sammy"], "theodore": ["theo", "ted", "teddy"], "victoria": ["vicky", "tori", "vicki"], "william": ["will", "bill", "billy", "willy"],
    "yevgenia": ["zhenya", "eugenia", "jenya", "evgenia"], "zachary": ["zach", "zak", "zack"],
}
# Common English given names beyond those, likewise a seed.
MORE_GIVEN = {
    "alexander": ["alex", "sandy"], "andrew": ["andy", "drew"], "barbara": ["barb", "barbie"], "benjamin": ["ben", "benny"], "charles": ["charlie", "chuck"],
    "christopher": ["chris", "kit"], "daniel": ["dan", "danny"], "david": ["dave", "davey"], "deborah": ["deb", "debbie", "debra"], "donald": ["don", "donny"],
    "dorothy": ["dot", "dottie"], "edward": ["ed", "eddie", "ned"], "frederick": ["fred", "freddie"], "gregory": ["greg"], "james": ["jim", "jimmy", "jamie"],
    "jennifer": ["jen", "jenny", "jenn"], "jessica": ["jess", "jessie"], "john": ["jon", "johnny", "jonathan", "jonny"], "joshua": ["josh"], "judith": ["judy"],
    "kenneth": ["ken", "kenny"], "lawrence": ["larry", "laurence"], "matthew": ["matt"], "michael": ["mike", "mick", "mikey"], "mary": [], "nathaniel": ["nate", "nathan"],
    "pamela": ["pam"], "patricia": ["pat", "patty", "trish"], "patrick": ["paddy"], "peter": ["pete"], "philip": ["phil", "phillip"], "raymond": ["ray"], "rebecca": ["becky", "becca"],
    "richard": ["rick", "dick", "richie", "rich"], "ronald": ["ron", "ronnie"], "sarah": [], "stephen": ["steve", "steven"], "susan": ["sue", "susie", "suzanne"], "thomas": ["tom", "tommy"],
    "timothy": ["tim", "timmy"], "valerie": ["val"], "walter": ["walt", "wally"],
}
_GIVEN = {v: k for own in (GIVEN, MORE_GIVEN) for k, more in own.items() for v in (k, *more) if own is GIVEN or v not in {x for a, b in GIVEN.items() for x in (a, *b)}}
_QUALIFIER = {"north": "north", "south": "south", "east": "east", "west": "west", "upper": "upper", "lower": "lower", "men's": "men", "mens": "men", "women's": "women", "womens": "women"}
_REMARK = re.compile(r"\((?:formerly|see|temporary|closed|new|f/k/a)[^)]*\)|\b(?:c/o|attn:?|formerly)\b.*$|\*|\btemporary\b")
_NUMBERED = re.compile(r"^\s*\d{5,}\s+(?:ontario|canada|quebec)?\s*(?:inc|ltd|corp|limited|incorporated|corporation)?\.?\s*,?\s*(?:o/a|t/a|d/b/a|dba|operating as|trading as)\s+")
_NUMBER = re.compile(r"\(?\b(?:no|number|nr|unit)\.?\s*(\d+)\b\)?|#\s*(\d+)")


def distance(a: str, b: str, most: int = MOST) -> int:
    if abs(len(a) - len(b)) > most:
        return most + 1
    prev2, prev = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            v = min(prev[j] + 1, row[j - 1] + 1, prev[j - 1] + (x != y))
            if prev2 and i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, prev2[j - 2] + 1)
            row.append(v)
        if min(row) > most:
            return most + 1
        prev2, prev = prev, row
    return prev[-1]


class Reader:
    """Reads names; what words mean is kept. kinds: word of a business to what it is read as; given:
    given name, short or in full, to the one it is read as."""

    def __init__(self, kinds: dict[str, str] = _KIND, given: dict[str, str] = _GIVEN) -> None:
        self.kinds, self.given = kinds, given
        self.known: dict[tuple[int, str], str] = {}
        self.forms: dict[int, dict[str, list[str]]] = {}

    def _near(self, word: str, words: dict[str, str]) -> str:
        """The word of a list that this one is, by one typo in a word of five letters or more.
        Words one edit apart share a form with at most one letter less."""
        if word in words:
            return words[word]
        if len(word) < 4:
            return ""
        key = (id(words), word)
        if key not in self.known:
            if key[0] not in self.forms:
                own = self.forms[key[0]] = {}
                for k in words:
                    if len(k) >= 5:
                        for f in {k, *(k[:i] + k[i + 1 :] for i in range(len(k)))}:
                            own.setdefault(f, []).append(k)
            forms = self.forms[key[0]]
            near = {k for f in {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))} for k in forms.get(f, ()) if distance(word, k, 1) <= 1}
            self.known[key] = next((v for k, v in words.items() if k in near), "") if near else ""
        return self.known[key]

    def read(self, name: str | None) -> tuple[str, str, str, str, str, str] | None:
        """(sort, first, second, qualifier, kind, extra) of a name; None for null markers and names
        without a word of their own. Sort o, an organisation: first and second are its coined words.
        Sort p, a person: first is the surname, second the given name, extra a middle initial; an
        initial alone stands in place of the given name."""
        if name is None or name.strip().lower() in NULL_VALUES or name.strip().lower() in ("unknown", "tbd", "see notes"):
            return None
        s = re.sub(r"([a-z])([A-Z])", r"\1 \2", unicodedata.normalize("NFC", name))
        s = unicodedata.normalize("NFKD", s.lower())
        s = "".join(c for c in s if not unicodedata.combining(c)).replace("’", "'")
        s = _REMARK.sub(" ", _NUMBERED.sub("", s))
        qualifier = ""
        if m := _NUMBER.search(s):
            qualifier, s = (m[1] or m[2]).lstrip("0"), s[: m.start()] + " " + s[m.end() :]
        initials = re.findall(r"\b(?:[a-z]\.){2,}", s)
        s = re.sub(r"\b(?:[a-z]\.){2,}", " ", s)
        words = [w.strip("'") if not w.endswith("men's") else w for w in re.findall(r"[a-z0-9']+", s)]
        words = [w for w in words if w]
        kinds, core, given, single, at = [], [], [], [], []
        for w in words:
            if w in _LEGAL and not (len(w) == 1 and w != "n" and w != "a"):
                if len(w) == 1:
                    single.append(w)
                continue
            if w in _TITLE:
                continue
            if len(w) == 1:
                single.append(w)
            elif w in self.given:
                given.append(self.given[w])
            elif w in _QUALIFIER:
                at.append(_QUALIFIER[w])
            elif w in self.kinds:
                kinds.append(self.kinds[w])
            elif k := self._near(w, self.kinds):
                kinds.append(k)
            elif g := self._near(w, self.given):
                given.append(g)
            elif q := self._near(w, _QUALIFIER):
                at.append(q)
            elif not self._near(w, _LONG_LEGAL):
                core.append(w)
        # names are cut off at a length at times: what is left of a last word that is none of its own
        if len(core) > 1 and words[-1] == core[-1] and any(k.startswith(core[-1]) for k in _CUT) and not given:
            core.pop()
        # family and youth name a group unless they belong to the kind of business
        for w, wholes in (("family", ({"centre"}, {"dentistry"})), ("youth", ({"programs"},))):
            n, whole = kinds.count(w), {k for k in kinds if k != w} in wholes
            if n > whole:
                at.append(w)
                kinds = [k for k in kinds if k != w] + [w] * whole
        if "development" in kinds and "social" in kinds:
            kinds.append("society")
        if initials:
            kinds = kinds or ["~" + initials[0].replace(".", "")]
        qualifier = qualifier or "+".join(sorted(set(at)))
        kind = " ".join(sorted(set(kinds)))
        if len(core) == 1 and (given or single) and not qualifier:
            first = given[0] if given else single[0]
            middle = single[0] if given and single else single[1] if len(single) > 1 else ""
            return "p", core[0], first, "", kind, middle
        if not core and (whole := list(dict.fromkeys(kinds))) and not whole[0].startswith("~"):
            # a name of nothing but kinds of business: they are the name
            return "o", whole[0], "".join(whole[1:]), qualifier, "", ""
        if not core:
            return None
        if len(core) == 1:
            return "o", core[0], "", qualifier, kind, ""
        return "o", core[0], "".join(core[1:]), qualifier, kind, ""


def read_names(operators: DataFrame) -> DataFrame:
    """(operator_id, sort, first, second, qualifier, kind, extra, city) of the operators that have a name."""
    fields = ["sort", "first", "second", "qualifier", "kind", "extra"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader()
        for b in batches:
            rows = []
            for r in b.itertuples(index=False):
                for n in (r.est_name, r.organization_name, r.shelter_name):
                    if isinstance(n, str) and (p := reader.read(n)):
                        city = r.city.strip().lower() if isinstance(r.city, str) else ""
                        rows.append((r.operator_id, *p, "" if city in NULL_VALUES else city))
                        break
            if rows:
                yield pd.DataFrame(rows, columns=["operator_id", *fields, "city"])

    own = operators.select("operator_id", "est_name", "organization_name", "shelter_name", "city")
    return own.mapInPandas(run, "operator_id bigint, " + ", ".join(f"{f} string" for f in [*fields, "city"]))


def trie(words: list[str], root: dict | None = None) -> dict:
    root = {} if root is None else root
    for w in words:
        node = root
        for c in w:
            node = node.setdefault(c, {})
        node[""] = w
    return root


def neighbours(root: dict, word: str, most: int) -> Iterator[tuple[str, int]]:
    """(other, distance) of the words of a trie within `most` edits.

    The Levenshtein automaton of the word runs down the branches. Its state is one bit set for each
    number of errors: bit i says that i letters of the word are matched. A branch whose sets are all
    empty is left."""
    masks: dict[str, int] = {}
    for i, c in enumerate(word):
        masks[c] = masks.get(c, 0) | 1 << i
    end, full = 1 << len(word), (2 << len(word)) - 1
    first = [(2 << d) - 1 for d in range(most + 1)]
    stack = [(node, c, first, None, 0) for c, node in root.items() if c]
    while stack:
        node, c, state, before, last = stack.pop()
        mask, new, under = masks.get(c, 0), [], 0
        for d in range(most + 1):
            s = (state[d] & mask) << 1
            if d:
                # a letter more, another letter, a letter less
                s |= state[d - 1] | state[d - 1] << 1 | under << 1
                if before is not None:  # the two letters before, swapped
                    s |= (before[d - 1] & mask) << 2 & last << 1
            under = s & full
            new.append(under)
        if under:
            if "" in node:
                for d in range(most + 1):
                    if new[d] & end:
                        yield node[""], d
                        break
            stack += [(child, k, new, state, mask) for k, child in node.items() if k]


def _forms(text: str) -> np.ndarray:
    """Hashes of the text with up to MOST (two) letters deleted: sums of letter times power of the place."""
    c = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype("uint64") + np.uint64(1)
    n = len(c)
    moved = [np.concatenate([[np.uint64(0)], np.cumsum(c * np.roll(_POWERS[: n + 2], k)[:n])]).astype("uint64") for k in range(3)]
    i, j = np.triu_indices(n, 1)
    one = np.arange(n)
    return np.concatenate([[moved[0][n]], moved[0][one] + moved[1][n] - moved[1][one + 1], moved[0][i] + moved[1][j] - moved[1][i + 1] + moved[2][n] - moved[2][j + 1]])


def _pieces(text: str) -> np.ndarray:
    """Hashes of the fifths of a text as they stand in it if it or a text up to two letters shorter is cut in five."""
    n, out = len(text), []
    for short in range(max(n - MOST, LONG + 1), n + 1):
        ends = [k * short // 5 for k in range(6)]
        for k in range(5):
            for shift in range(-MOST, MOST + 1):
                if 0 <= ends[k] + shift and ends[k + 1] + shift <= n:
                    out.append(zlib.crc32(text[ends[k] + shift : ends[k + 1] + shift].encode()) << 32 | (short * 5 + k) % (1 << 32))
    return np.array(out, dtype="uint64")


def _swapped(a: str, i: str) -> str:
    return f"concat(left({a}, {i} - 1), substr({a}, {i} + 1, 1), substr({a}, {i}, 1), substr({a}, {i} + 2))"


def edits(a: str, b: str) -> str:
    """SQL: the edits between two texts, a swap of neighbours being one; null if more than two.
    A swap is two edits of plain Levenshtein distance, so that two edits are four at most."""
    lev = f"levenshtein({a}, {b}, 4)"
    some = lambda t: f"exists(sequence(1, length({a}) - 1), i -> {t})"
    one = _swapped(a, "i")
    two = f"levenshtein({one}, {b}, 1) >= 0 or (length({a}) = length({b}) and levenshtein({one}, {b}, 2) = 2 and exists(sequence(1, length({a}) - 1), j -> {_swapped(one, 'j')} = {b}))"
    return f"""case {lev} when -1 then null when 0 then 0 when 1 then 1 when 2 then case when length({a}) = length({b}) and {some(f"{one} = {b}")} then 1 else 2 end
        else case when {some(two)} then 2 end end"""


def shard_keys(text: str) -> np.ndarray:
    """Keys of the shards of a text; two texts within two edits share one, whatever their lengths.

    One edit (a swap too) is undone by deleting at most one letter on either side, so texts of up to
    LONG + 2 letters share what is left of them without two letters. If the shorter has more than
    LONG, two edits touch at most four of its fifths, a swap two of them; one is whole in the other
    text, moved by two letters at most. Texts of LONG + 1 and LONG + 2 letters get both kinds of key."""
    parts = ([_forms(text)] if len(text) <= LONG + MOST else []) + ([_pieces(text)] if len(text) > LONG else [])
    return np.unique(np.concatenate(parts)).view("int64")


def trie_join(spellings: DataFrame, most: int = MOST, block: int = BLOCK) -> DataFrame:
    """(id_a, id_b, d), id_a < id_b, of spellings (id, first, second) within `most` (at most MOST)
    edits as joined texts, in either order of the words.

    Shards larger than `block` are cut into blocks and every pair of blocks is a shard, so that no
    task gets more than two blocks and no pair is lost. Shards of the same texts are one."""
    written = spellings.selectExpr("id", "explode(array_distinct(array(concat(first, second), concat(second, first)))) as text")

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"text": b["text"], "keys": [shard_keys(t) for t in b["text"]]})

    keyed = written.select("text").distinct().mapInPandas(keys, "text string, keys array<bigint>").selectExpr("text", "explode(keys) as key")
    # what stands alone in its shard, most of it, goes no further
    at = cut(keyed.withColumn("n", F.expr("count(*) over (partition by key)")).where("n > 1").withColumn("nb", F.expr(f"cast(ceil(n / {block}D) as int)")), "shared")
    at = at.withColumn("own", F.expr("cast(pmod(xxhash64(text), nb) as int)")).withColumn("other", F.expr("explode(sequence(0, nb - 1))"))
    at = at.select("text", "key", F.expr("least(own, other) as lo"), F.expr("greatest(own, other) as hi")).repartition("key", "lo", "hi")
    shards = cut(at.groupBy("key", "lo", "hi").agg(F.expr("array_sort(collect_list(text)) as texts")).where("size(texts) > 1").select("texts").distinct(), "shards")

    def traverse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for texts in b["texts"]:
                root: dict = {}
                for text in texts:  # each against those before it
                    out += [(other, text, d) for other, d in neighbours(root, text, most)]
                    trie([text], root)
            if out:
                yield pd.DataFrame(out, columns=["text_a", "text_b", "d"]).drop_duplicates()

    # two texts need no trie
    two = once(shards.where("size(texts) = 2").selectExpr("texts[0] as text_a", "texts[1] as text_b"), d=edits("text_a", "text_b")).where(f"d <= {most}")
    tries = shards.where("size(texts) > 2").mapInPandas(traverse, "text_a string, text_b string, d int")
    close = tries.unionByName(two).distinct()
    close = close.unionByName(written.selectExpr("text as text_a", "text as text_b", "0 as d").distinct())
    pairs = close.join(written.selectExpr("text as text_a", "id as x"), "text_a").join(written.selectExpr("text as text_b", "id as y"), "text_b").where("x != y")
    return pairs.selectExpr("least(x, y) as id_a", "greatest(x, y) as id_b", "d").groupBy("id_a", "id_b").agg(F.min("d").alias("d"))


def entities(operators: DataFrame) -> DataFrame:
    """(operator_id, entity). Rows without a name, or with a null marker for one, are left out; very
    long names, repeated rows and ties are read as they are."""
    at = cut(read_names(operators), "names")
    spell = ["sort", "first", "second"]
    known = at.where("not (sort = 'p' and length(second) = 1)")
    # m: distinct records, so that copies are no evidence for a spelling
    kinds = known.groupBy(*spell, "kind").agg(F.count("*").alias("n"), F.count_distinct("qualifier", "extra", "city").alias("m"))
    cities = known.where("city != ''").groupBy(*spell, "city").agg(F.count("*").alias("c"))
    # a surname with an initial is a spelling too (sort i), whether the given name is written out or not
    bare = at.where("sort = 'p'").selectExpr("'i' as sort", "first", "left(second, 1) as second", "second as given", "kind", "extra", "city")
    kinds = kinds.unionByName(bare.groupBy(*spell).agg(F.lit("").alias("kind"), F.count("*").alias("n"), F.count_distinct("given", "kind", "extra", "city").alias("m")))
    cities = cities.unionByName(bare.where("city != ''").groupBy(*spell, "city").agg(F.count("*").alias("c")))
    spelled = kinds.groupBy(*spell).agg(F.sum("n").alias("n"), F.sum("m").alias("m"), F.max(F.expr("case when kind != '' then struct(n, kind) end")).alias("k"))
    cities = cities.groupBy(*spell).agg(F.max(F.struct("c", "city")).alias("most"))
    spelled = spelled.join(cities.selectExpr(*spell, "most.city as city"), spell, "left").selectExpr(*spell, "n", "m", "coalesce(k.kind, '') as kind", "coalesce(city, '') as city", "xxhash64(sort, first, second) as id")
    spelled = cut(spelled, "spellings")
    near = trie_join(spelled.selectExpr("id", "first", "case when sort = 'i' then '' else second end as second"))
    side = lambda p: spelled.selectExpr(f"id as id_{p}", f"sort as sort_{p}", f"n as n_{p}", f"m as m_{p}", f"kind as kind_{p}", f"city as city_{p}", f"first as first_{p}", f"second as second_{p}")
    near = near.join(side("a"), "id_a").join(side("b"), "id_b").where("sort_a = sort_b")
    # the same given name, but for typos in words that are no given name; a kind of business that does not contradict
    initials = lambda k: f"array_join(transform(split({k}, ' '), w -> left(w, 1)), '')"
    letters = lambda c: f"array_join(array_sort(split(translate({c}, 'an', ''), '')), '')"
    same_kind = f"""(kind_a = kind_b or kind_a = '' or kind_b = '' or sort_a = 'p'
        or (left(kind_a, 1) = '~' and {letters("substr(kind_a, 2)")} = {letters(initials('kind_b'))})
        or (left(kind_b, 1) = '~' and {letters("substr(kind_b, 2)")} = {letters(initials('kind_a'))}))"""
    near = near.where(f"{same_kind} and (sort_a = 'o' or second_a = second_b)")
    # few distinct records, a rarer one, or one city and kind speak for a typo; copies change none of these
    place, rarer = "(city_a = city_b or city_a = '' or city_b = '')", "least(m_a, m_b) <= 2 or greatest(m_a, m_b) >= 3 * least(m_a, m_b)"
    sure = f"(d <= 1 and ({rarer} or {place})) or (d = 2 and {place} and ({rarer} or (city_a = city_b and city_a != '' and kind_a = kind_b)))"
    near = cut(near.where(sure).select("id_a", "n_a", "id_b", "n_b", "d"), "near")
    both = near.unionByName(near.selectExpr("id_b as id_a", "n_b as n_a", "id_a as id_b", "n_a as n_b", "d"))
    up = both.where("n_b > n_a or (n_b = n_a and id_b > id_a)").groupBy("id_a").agg(F.max(F.struct(-F.col("d"), F.col("n_b"), F.col("id_b"))).alias("m")).selectExpr("id_a as id", "m.id_b as root")
    root = cut(spelled.select("id").join(up, "id", "left").selectExpr("id", "coalesce(root, id) as root"), "roots")
    while True:  # pointers are followed to their ends, twice as far each time
        nxt = cut(root.join(root.selectExpr("id as root", "root as far"), "root").selectExpr("id", "far as root", "far != root as moved"), "roots")
        root = nxt.select("id", "root")
        if nxt.where("moved").isEmpty():
            break
    full = known.withColumn("id", F.xxhash64(*spell)).join(root, "id")
    canon = cut(full.selectExpr("operator_id", "sort", "first", "second", "root", "qualifier", "kind", "extra", "city"), "canon")

    # initials: the one person of that surname or one near it and that initial, the likeliest by city,
    # trade, middle initial and spelling
    # each combination of what may agree has its best person kept by an aggregate, so that common
    # surnames pair nothing and collect nothing
    named = lambda df: df.withColumn("id", F.expr("xxhash64('i', first, left(second, 1))")).join(root.withColumnRenamed("root", "surname"), "id")
    part = ["first", "city", "kind", "extra"]
    some = "explode(array_distinct(transform(sequence(0, 15), i -> struct(" + ", ".join(f"case when i div {2**k} % 2 = 1 then {c} else '' end as {c}" for k, c in enumerate(part)) + ")))) as k"
    people = named(canon.where("sort = 'p'")).groupBy("surname", "root", *part).agg(F.count("*").alias("n"))
    people = people.selectExpr("surname", "root", "n", some).selectExpr("surname", "root", "n", *[f"k.{c} as {c}" for c in part])
    people = people.groupBy("surname", *part, "root").agg(F.sum("n").alias("n")).groupBy("surname", *part).agg(F.max(F.struct("n", "root")).alias("m"))
    short = named(at.where("sort = 'p' and length(second) = 1")).select("operator_id", "surname", *part)
    worth = " + ".join(f"case when k.{c} != '' then {1 if c == 'first' else 2} else 0 end" for c in part)
    asked = short.select("surname", *part).distinct()
    asked = asked.selectExpr("surname", *[f"{c} as own_{c}" for c in part], some).selectExpr("surname", *[f"own_{c}" for c in part], *[f"k.{c} as {c}" for c in part], f"{worth} as s")
    found = asked.join(people, ["surname", *part]).groupBy("surname", *[f"own_{c}" for c in part]).agg(F.max(F.struct("s", "m.n", "m.root")).alias("m"))
    short = short.join(found.withColumnsRenamed({f"own_{c}": c for c in part}), ["surname", *part], "left")
    short = short.selectExpr("operator_id", "case when m is null then concat('i|', surname) else concat('p|', m.root) end as entity")
    return canon.selectExpr("operator_id", "concat(sort, '|', root, '|', qualifier) as entity").withColumn("entity", F.expr("case when entity like 'p|%' then regexp_replace(entity, '[|]$', '') else entity end")).unionByName(short)


def same_name(operators: DataFrame) -> DataFrame:
    """(operator_a, operator_b), smaller first: pairs of records that name one organisation or person."""
    at = cut(entities(operators), "entities")
    a, b = at.withColumnRenamed("operator_id", "operator_a"), at.withColumnRenamed("operator_id", "operator_b")
    return a.join(b, "entity").where("operator_a < operator_b").select("operator_a", "operator_b")
