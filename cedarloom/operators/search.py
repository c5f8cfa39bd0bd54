"""Search over documents: analyser, inverted index, BM25, filters, facets, places.

The index is four tables (postings, lengths, vocabulary, corpus), made once by `build_index`. A
query reads only the postings of its terms; filters are a semi-join and never change the weights of
terms. Scores are exact BM25 over the whole corpus, k1 = 1.2, b = 0.75.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cedarloom.functions.rules import BOOSTS, STOP_WORDS
from cedarloom.functions.stem import stem
from cedarloom.functions.values import lit, sql_list

K1, B = 1.2, 0.75
EARTH_KM = 6371.0088
UNITS_KM = {"km": 1.0, "m": 0.001, "mi": 1.609344}


def tokens(c: str, stop: bool = True) -> str:
    """Words of letters and digits in lower case, without stop words."""
    keep = f" and t not in ({sql_list(STOP_WORDS)})" if stop else ""
    return rf"filter(split(lower({c}), r'[^\p{{L}}\p{{N}}]+'), t -> t != ''{keep})"


def _stemmed(words: DataFrame) -> DataFrame:
    """(word, tok) of distinct words. Not a function of a column: the optimizer would push conditions on
    the stem below the distinct, and stem every occurrence."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(tok=b["word"].map(stem))

    return words.mapInPandas(each, "word string, tok string")


@dataclass
class Index:
    """With stemming, an index that is not written has its words (word, tok) and their occurrences
    (field, doc_id, len, word), so that a query gathers the postings of its own terms only."""

    postings: DataFrame
    lengths: DataFrame
    vocab: DataFrame
    corpus: DataFrame
    stemmed: bool = False
    buckets: int | None = None
    words: DataFrame | None = None
    occurrences: DataFrame | None = None

    def of(self, hit: str) -> tuple[DataFrame, DataFrame]:
        """Postings and vocabulary of the terms for which `hit` (SQL over tok) holds."""
        if self.words is None:
            return self.postings.where(hit), self.vocab.where(hit)
        own = self.occurrences.join(F.broadcast(self.words.where(hit)), "word").groupBy("field", "tok", "doc_id", "len").agg(F.count("*").alias("tf"))
        return own, _vocabulary(own)


def _vocabulary(postings: DataFrame) -> DataFrame:
    return postings.groupBy("field", "tok").agg(F.count("*").alias("df"))


def save_index(index: Index, path: str, buckets: int = 64) -> None:
    """The tables of an index below `path`. Postings, lengths and vocabulary are partitioned by field
    and a bucket of what they are read by, so that a query reads the buckets of its terms only."""
    part = lambda c: F.expr(f"cast(pmod(xxhash64({c}), {buckets}) as int)")
    for name, df, by in (("postings", index.postings, "tok"), ("lengths", index.lengths, "doc_id"), ("vocab", index.vocab, "tok")):
        df.withColumn("bucket", part(by)).repartition("field", "bucket").sortWithinPartitions(by).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/{name}")
    index.corpus.selectExpr("*", f"{index.stemmed} as stemmed", f"{buckets} as buckets").coalesce(1).write.mode("overwrite").parquet(f"{path}/corpus")


def load_index(spark, path: str) -> Index:
    """An index that save_index wrote; nothing is read of it but the row of its settings."""
    corpus = spark.read.parquet(f"{path}/corpus")
    one = corpus.select("stemmed", "buckets").first()
    read = lambda n: spark.read.parquet(f"{path}/{n}")
    return Index(read("postings"), read("lengths").drop("bucket"), read("vocab"), corpus.drop("stemmed", "buckets"), bool(one and one["stemmed"]), one["buckets"] if one else None)


def build_index(docs: DataFrame, key: str, fields: list[str], stop: bool = True, stemming: bool = False) -> Index:
    """Tables over (key, field): tokens, lengths, document frequencies, and counts of documents that
    have the field. Stemming is done once for each distinct word, not for each occurrence."""
    words = ", ".join(f"struct('{f}' as field, {tokens(f'`{f}`', stop)} as toks)" for f in fields)
    # the tokens are a column of their own, so that none of them carries the others
    each = docs.selectExpr(f"`{key}` as doc_id", f"inline(array({words}))").where("size(toks) > 0")
    lengths = each.selectExpr("field", "doc_id", "size(toks) as len")
    corpus = lengths.groupBy("field").agg(F.count("*").alias("n"), F.avg("len").alias("avgdl"))
    if not stemming:
        postings = each.selectExpr("doc_id", "field", "explode(toks) as tok").groupBy("field", "tok", "doc_id").agg(F.count("*").alias("tf"))
        return Index(postings, lengths, _vocabulary(postings), corpus)
    occ = each.selectExpr("doc_id", "field", "size(toks) as len", "explode(toks) as word")
    stems = _stemmed(occ.select("word").distinct())
    postings = occ.groupBy("field", "word", "doc_id").agg(F.count("*").alias("tf")).join(stems, "word").groupBy("field", "tok", "doc_id").agg(F.sum("tf").alias("tf"))
    return Index(postings, lengths, _vocabulary(postings), corpus, True, words=stems, occurrences=occ)


def analyse(text: str, stop: bool = True, stemming: bool = False) -> list[str]:
    """The distinct tokens of a query, as the index has them."""
    out = [t for t in re.split(r"[\W_]+", text.lower()) if t and not (stop and t in STOP_WORDS)]
    return list(dict.fromkeys(stem(t) if stemming else t for t in out))


def edits_allowed(term: str) -> int:
    return 0 if len(term) < 3 else 1 if len(term) < 6 else 2


def near(c: str, term: str, most: int) -> str:
    """SQL: whether a word is within `most` (1 or 2) edits of a term; a swap of neighbours is one edit:
    the swaps of the term, which is known, are tried one by one."""
    swaps = {term[:i] + term[i + 1] + term[i] + term[i + 2 :] for i in range(len(term) - 1)} - {term}
    more = {t[:i] + t[i + 1] + t[i] + t[i + 2 :] for t in swaps for i in range(len(t) - 1)} if most > 1 else set()
    parts = [f"levenshtein({c}, {lit(term)}, {most}) >= 0", *([f"{c} in ({sql_list(sorted(swaps | more))})"] if swaps else [])]
    parts += [f"levenshtein({c}, {lit(t)}, {most - 1}) >= 0" for t in sorted(swaps)] if most > 1 else []
    return "(" + " or ".join(parts) + ")"


def _hit(terms: list[str], fuzzy: bool) -> str:
    return " or ".join(near("tok", t, edits_allowed(t)) if fuzzy and edits_allowed(t) else f"tok = {lit(t)}" for t in terms) or "false"


def expanded(index: Index, terms: list[str], fuzzy: bool) -> DataFrame:
    """(field, tok, df) of the vocabulary that the terms reach; with fuzzy, within 0, 1 or 2 edits by
    the length of the term. The terms are few; the vocabulary is scanned, not joined."""
    return index.of(_hit(terms, fuzzy))[1].select("field", "tok", "df")


def scored(index: Index, terms: list[str], boosts: dict[str, float] | None = None, fuzzy: bool = False) -> DataFrame:
    """(doc_id, score): the best field's BM25, times its boost. No terms: no rows."""
    boosts = boosts or BOOSTS
    boost = "case field " + " ".join(f"when '{f}' then {b}D" for f, b in boosts.items()) + " else 1D end"
    hits, vocab = index.of(_hit(terms, fuzzy))
    if index.buckets and terms and not fuzzy:
        own = hits.sparkSession.range(1).selectExpr(*[f"cast(pmod(xxhash64({lit(t)}), {index.buckets}) as int) as b{i}" for i, t in enumerate(terms)]).first()
        hits = hits.where(f"bucket in ({', '.join(str(b) for b in set(own))})")
    if index.buckets:
        hits = hits.drop("bucket")
    hits = hits.join(vocab.select("field", "tok", "df"), ["field", "tok"]).join(F.broadcast(index.corpus), "field")
    if "len" not in hits.columns:
        hits = hits.join(index.lengths, ["field", "doc_id"])
    score = f"ln(1 + (n - df + 0.5D) / (df + 0.5D)) * tf * ({K1} + 1) / (tf + {K1} * (1 - {B} + {B} * len / avgdl))"
    per_field = hits.groupBy("field", "doc_id").agg(F.sum(F.expr(score)).alias("s"))
    return per_field.groupBy("doc_id").agg(F.max(F.expr(f"s * {boost}")).alias("score"))


@dataclass
class Request:
    """A search: query text, filters (field to value or list), place, range of dates, sort."""

    query: str = ""
    filters: dict = field(default_factory=dict)
    near: tuple[float, float, str] | None = None
    date_range: tuple[str, str | None, str | None] | None = None
    sort: list | None = None
    size: int = 10
    offset: int = 0
    fields: list[str] | None = None
    fuzzy: bool = False
    time: str | None = None


def condition(docs: DataFrame, filters: dict) -> str:
    """Equality, membership for lists; on an array column any element counts. Parts are joined by and."""
    kinds = dict(docs.dtypes)
    parts = []
    for f, v in filters.items():
        values = list(v) if isinstance(v, (list, tuple, set)) else [v]
        many = ", ".join(lit(x) for x in values)
        parts.append(f"arrays_overlap(`{f}`, array({many}))" if kinds[f].startswith("array") else f"`{f}` in ({many})")
    return " and ".join(parts) or "true"


def distance_km(lat: str, lon: str, to_lat: float, to_lon: float) -> str:
    a = f"pow(sin(radians({lat} - {to_lat}) / 2), 2) + cos(radians({to_lat})) * cos(radians({lat})) * pow(sin(radians({lon} - {to_lon}) / 2), 2)"
    return f"2 * {EARTH_KM} * asin(sqrt({a}))"


def radius_km(text: str) -> float:
    unit = next(u for u in ("km", "mi", "m") if text.endswith(u))
    return float(text[: -len(unit)]) * UNITS_KM[unit]


def within(docs: DataFrame, lat: float, lon: float, radius: str, lat_col: str = "latitude", lon_col: str = "longitude") -> DataFrame:
    """Documents in the radius, with distance_km, nearest first. A box that the scan can use stands
    before the distance; documents without a place are left out."""
    import math

    r = radius_km(radius)
    dlat = math.degrees(r / EARTH_KM) * 1.001
    dlon = 180.0 if abs(lat) + dlat >= 90 else math.degrees(math.asin(min(1.0, math.sin(r / EARTH_KM) / math.cos(math.radians(lat))))) * 1.001
    box = f"{lat_col} between {lat - dlat} and {lat + dlat}" + (f" and {lon_col} between {lon - dlon} and {lon + dlon}" if lon - dlon > -180 and lon + dlon < 180 else "")
    at = docs.where(box).withColumn("distance_km", F.expr(distance_km(lat_col, lon_col, lat, lon)))
    return at.where(f"distance_km <= {r}")


def search(docs: DataFrame, index: Index, key: str, request: Request, boosts: dict[str, float] | None = None) -> tuple[DataFrame, DataFrame]:
    """(page of hits, one row with the exact total). Without a query all documents match, score 1; a
    query of stop words only matches none. Ties go to the smaller key. With `time` (the stamp of a document) the
    newest come first unless a sort is given, as in search by issue; else the best or nearest."""
    hits = docs.where(condition(docs, request.filters))
    if request.date_range:
        f, lo, hi = request.date_range
        hits = hits.where(" and ".join([*([f"`{f}` >= {lit(lo)}"] if lo else []), *([f"`{f}` <= {lit(hi)}"] if hi else [])]) or "true")
    if request.near:
        hits = within(hits, *request.near)
    if request.query.strip():
        hits = hits.join(scored(index, analyse(request.query, stemming=index.stemmed), boosts, request.fuzzy).withColumnRenamed("doc_id", key), key)
    else:
        hits = hits.withColumn("score", F.lit(1.0))
    ranked = [F.col("distance_km")] if request.near and not request.query.strip() else [F.col("score").desc()]
    order = request.sort or ([F.col(request.time).desc_nulls_last()] if request.time else ranked)
    page = hits.orderBy(*order, key).offset(request.offset).limit(request.size)
    if request.fields:
        page = page.select(*request.fields)
    return page, hits.agg(F.count("*").alias("total"))


def facets(docs: DataFrame, column: str, size: int | None = 50, where: str = "true") -> DataFrame:
    """(value, n), most frequent first, ties by value. Of an array each distinct element counts once
    a document; nulls don't count."""
    value = f"explode(array_distinct(`{column}`))" if dict(docs.dtypes)[column].startswith("array") else f"`{column}`"
    out = docs.where(where).selectExpr(f"{value} as value").where("value is not null").groupBy("value").agg(F.count("*").alias("n"))
    out = out.orderBy(F.desc("n"), "value")
    return out.limit(size) if size else out


def statistics(docs: DataFrame, dataset: str, category: str) -> DataFrame:
    """(kind, value, n): the total, and counts by dataset and category, in one pass and one shuffle."""
    each = f"inline(array(struct('total' as kind, cast(null as string) as value), struct('dataset' as kind, cast(`{dataset}` as string) as value), struct('category' as kind, cast(`{category}` as string) as value)))"
    return docs.selectExpr(each).groupBy("kind", "value").agg(F.count("*").alias("n"))


# Searches within one issue.
PRESETS = {"health": "health", "housing": "housing", "transportation": "transportation", "safety": "public_safety", "environment": "environment", "business": "business_and_economy", "permits": "permits"}


def search_issue(docs: DataFrame, index: Index, key: str, preset: str, query: str, size: int = 10) -> tuple[DataFrame, DataFrame]:
    """A search among the documents whose primary issue is that of the preset."""
    return search(docs, index, key, Request(query, {"primary_issue": PRESETS[preset]}, size=size))


def in_neighbourhood(docs: DataFrame, name: str, column: str = "neighbourhood") -> DataFrame:
    """Documents whose neighbourhood shares a word with the name."""
    return docs.where(f"arrays_overlap({tokens(f'`{column}`')}, array({sql_list(analyse(name))}))") if analyse(name) else docs.limit(0)


def in_ward(docs: DataFrame, index: Index, key: str, ward: str, query: str = "", issue: str | None = None, size: int = 50, **kw) -> tuple[DataFrame, DataFrame]:
    """A search among the documents of one ward, by number or name."""
    return search(docs, index, key, Request(query, {"ward": ward} | ({"primary_issue": issue} if issue else {}), size=size, **kw))


def recent(docs: DataFrame, time: str, days: int, now: str, size: int = 20) -> DataFrame:
    """The latest documents of the last days before `now` (SQL), newest first."""
    return docs.where(f"`{time}` >= {now} - interval {days} days").orderBy(F.desc(time)).limit(size)


def prefixes(c: str, least: int = 2, most: int = 20) -> str:
    """Edge n-grams of the words of a text."""
    grams = f"flatten(transform({tokens(c, False)}, t -> case when length(t) >= {least} then transform(sequence({least}, least({most}, length(t))), i -> left(t, i)) else cast(array() as array<string>) end))"
    return f"array_distinct({grams})"


def highlighted(c: str, terms: list[str]) -> str:
    words = lit(r"(?i)\b(" + "|".join(re.escape(t) for t in terms) + r")\b")
    return f"regexp_replace({c}, {words}, '<em>$1</em>')" if terms else c
