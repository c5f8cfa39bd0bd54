import time
from datetime import datetime

from pyspark.sql import functions as F

from cedarloom.operators import search as S
from cedarloom.operators.stores import Store
from cedarloom.streaming.sync import Sync, load, status

SCHEMA = "_unique_id string, dataset_id string, v int, loaded_at timestamp"


def docs(spark, rows):
    return spark.createDataFrame([(k, d, v, datetime(2024, 1, day)) for k, d, v, day in rows], SCHEMA)


def rows(store):
    return sorted((r["_unique_id"], r["dataset_id"], r["v"]) for r in store.read().collect())


def test_upsert_is_idempotent_and_last_wins(spark, tmp_path):
    s = Store(spark, str(tmp_path / "gold"), "_unique_id")
    a = docs(spark, [("a", "x", 1, 1), ("b", "x", 2, 1), ("c", "y/z", 3, 1), ("a", "x", 9, 2)])
    assert s.upsert(a, [F.desc("loaded_at")]) == {"stored": 3, "matched": 0, "upserted": 3}
    want = [("a", "x", 9), ("b", "x", 2), ("c", "y/z", 3)]
    assert rows(s) == want
    assert s.upsert(a, [F.desc("loaded_at")])["matched"] == 3 and rows(s) == want
    s.upsert(docs(spark, [("b", "y/z", 5, 3)]))
    assert rows(s) == [("a", "x", 9), ("b", "y/z", 5), ("c", "y/z", 3)]
    assert s.upsert(docs(spark, [])) == {"stored": 0, "matched": 0, "upserted": 0}
    assert s.delete("v = 5") == 1 and s.delete_dataset("y/z") == 1 and rows(s) == [("a", "x", 9)]
    assert s.count() == 1 and s.get("a").count() == 1 and s.by_dataset("x", 0).count() == 1


def test_merge_keeps_what_is_not_given(spark, tmp_path):
    s = Store(spark, str(tmp_path / "silver"), "_unique_id")
    s.upsert(docs(spark, [("a", "x", 1, 1)]).withColumn("extra", F.lit("kept")))
    s.upsert(docs(spark, [("a", "x", 2, 2)]).withColumn("extra", F.lit(None).cast("string")), merge=True)
    r = s.read().first()
    assert (r["v"], r["extra"]) == (2, "kept")


def test_incremental_equals_full(spark, tmp_path):
    first, second = [("a", "x", 1, 1), ("b", "y", 2, 2)], [("a", "x", 3, 5), ("c", "z", 4, 1)]
    one, two = (Store(spark, str(tmp_path / n), "_unique_id") for n in ("one", "two"))
    sync = Sync(spark, one, str(tmp_path / "state"))
    assert sync.run(docs(spark, first)) == {"processed": 2, "failed": 0}
    assert sync.run(docs(spark, first)) == {"processed": 0, "failed": 0}
    assert sync.run(docs(spark, first + second))["processed"] == 2
    Sync(spark, two, str(tmp_path / "state2")).full_resync(docs(spark, first + second))
    assert rows(one) == rows(two) == [("a", "x", 3), ("b", "y", 2), ("c", "z", 4)]
    assert status(sync.state()).first()["tracked"] == 3


def test_a_failure_is_noted_and_keeps_the_watermark(spark, tmp_path):
    def broken(df):
        return df.withColumn("v", F.raise_error(F.lit("no")).cast("int"))

    s = Sync(spark, Store(spark, str(tmp_path / "g"), "_unique_id"), str(tmp_path / "state"), broken)
    assert s.run(docs(spark, [("a", "x", 1, 1)]))["failed"] == 1
    r = s.state().first()
    assert (r["status"], r["watermark"]) == ("failed", None)
    s.transform = lambda df: df
    assert s.run(docs(spark, [("a", "x", 1, 1)]))["processed"] == 1


def test_stream_takes_new_files_once(spark, tmp_path):
    src = str(tmp_path / "in")
    store = Store(spark, str(tmp_path / "g"), "_unique_id")
    sync = Sync(spark, store, str(tmp_path / "state"))
    for batch in ([("a", "x", 1, 1)], [("a", "x", 2, 2), ("b", "x", 1, 1)]):
        docs(spark, batch).write.mode("append").parquet(src)
        sync.stream(spark.readStream.schema(SCHEMA).parquet(src), str(tmp_path / "ck")).awaitTermination()
    assert rows(store) == [("a", "x", 2), ("b", "x", 1)]


def test_load_through_all_layers(spark, tmp_path):
    b, s, g = Store(spark, str(tmp_path / "b"), "_raw_id"), Store(spark, str(tmp_path / "s"), "_unique_id"), Store(spark, str(tmp_path / "g"), "_unique_id")
    rec = spark.createDataFrame([(1, "Café", "-"), (2, "Bar", "x")], "_id int, Name string, Comments string")
    assert load(rec, "'dinesafe'", b, s, g) == {"bronze": True, "silver": True, "gold": True}
    assert {r["_unique_id"] for r in g.read().collect()} == {r["_unique_id"] for r in s.read().collect()} == {"dinesafe:unknown_resource:1", "dinesafe:unknown_resource:2"}


def test_search(spark):
    d = spark.createDataFrame([(1, "inspection of the kitchen", ["a", "b"], 43.65, -79.38), (2, "kitchens inspected twice, kitchen closed", ["b"], 43.70, -79.40), (3, None, None, None, None)], "id int, text string, tags array<string>, latitude double, longitude double")
    index = S.build_index(d, "id", ["text"], stemming=True)
    page, total = S.search(d, index, "id", S.Request("Kitchen inspections"))
    assert [r["id"] for r in page.collect()] == [2, 1] or [r["id"] for r in page.collect()] == [1, 2]
    assert total.first()[0] == 2
    assert S.search(d, index, "id", S.Request("the of"))[1].first()[0] == 0
    assert S.search(d, index, "id", S.Request(""))[1].first()[0] == 3
    assert S.search(d, index, "id", S.Request("kitchne", fuzzy=True))[1].first()[0] == 2
    assert [r["id"] for r in S.search(d, index, "id", S.Request("", {"tags": "a"}))[0].collect()] == [1]
    near = S.search(d, index, "id", S.Request("", near=(43.65, -79.38, "6km")))[0].collect()
    assert [(r["id"], round(r["distance_km"], 7)) for r in near] == [(1, 0.0), (2, 5.7877513)]
    assert [tuple(r) for r in S.facets(d, "tags").collect()] == [("b", 2), ("a", 1)]


def test_one_dataset_fails_and_the_others_go_on(spark, tmp_path):
    def some(df):
        return df.withColumn("v", F.expr("case when dataset_id = 'bad' then raise_error('no') else v end").cast("int")).withColumn("_unique_id", F.expr("nullif(_unique_id, 'none')"))

    s = Sync(spark, Store(spark, str(tmp_path / "g"), "_unique_id"), str(tmp_path / "state"), some)
    got = s.run(docs(spark, [("a", "x", 1, 1), ("b", "bad", 1, 1), ("none", "y", 1, 1), ("c", "y", 1, 2)]))
    assert got == {"processed": 2, "failed": 2}
    state = {r["dataset_id"]: (r["status"], r["documents_synced"], r["documents_failed"]) for r in s.state().collect()}
    assert state == {"x": ("completed", 1, 0), "bad": ("failed", 0, 1), "y": ("partial", 1, 1)}
    assert "in_progress" in {r["status"] for r in s.history().collect()}
    s.transform = lambda df: df
    assert s.run(docs(spark, [("a", "x", 7, 9), ("b", "bad", 1, 1)]), resume=True) == {"processed": 1, "failed": 0}
    assert s.run(docs(spark, [("z", "new", 1, 1), ("a", "x", 7, 9)]), new_only=True)["processed"] == 1


def test_rows_that_arrive_during_a_run_are_taken_by_the_next(spark, tmp_path):
    src = str(tmp_path / "src")
    docs(spark, [("a", "x", 1, 1)]).write.parquet(src)

    class Slow(Store):
        def upsert(self, *a, **k):
            out = super().upsert(*a, **k)
            if not late:
                late.append(1)
                docs(spark, [("b", "x", 2, 5)]).write.mode("append").parquet(src)
            return out

    late: list = []
    s = Sync(spark, Slow(spark, str(tmp_path / "g"), "_unique_id"), str(tmp_path / "state"))
    assert s.run(spark.read.parquet(src))["processed"] == 1
    assert s.run(spark.read.parquet(src))["processed"] == 1
    assert rows(s.target) == [("a", "x", 1), ("b", "x", 2)]


def test_a_broken_off_swap_is_finished(spark, tmp_path):
    s = Store(spark, str(tmp_path / "g"), "_unique_id")
    s.upsert(docs(spark, [("a", "x", 1, 1), ("b", "y", 1, 1)]))
    staged = tmp_path / "g__swap_1"
    Store(spark, str(staged / "new"), "_unique_id").upsert(docs(spark, [("a", "x", 2, 2), ("b", "y", 2, 2)]))
    (staged / "old").mkdir()
    (staged / "ready").mkdir()
    (tmp_path / "g" / "dataset_id=x").rename(staged / "old" / "dataset_id=x")
    s.upsert(docs(spark, [("c", "z", 1, 1)]))
    assert rows(s) == [("a", "x", 2), ("b", "y", 2), ("c", "z", 1)] and not staged.exists()


def test_quotes_in_values(spark, tmp_path):
    s = Store(spark, str(tmp_path / "g"), "_unique_id")
    s.upsert(docs(spark, [("a", "St. John's", 1, 1), ("b", "x", 1, 1)]).withColumn("primary_issue", F.lit("health")))
    d = s.read()
    assert d.where(S.condition(d, {"dataset_id": "St. John's"})).count() == 1
    assert s.delete_dataset("St. John's") == 1 and s.delete_by_category("health") == 1
    assert d.sparkSession.sql("select " + S.highlighted("'a.b (c) axb'", ["a.b", "(c"])).first()[0].startswith("<em>a.b</em>")


def test_index_that_is_written_once(spark, tmp_path):
    d = spark.createDataFrame([(i, f"kitchen w{i % 7} beach{i}") for i in range(50)], "id int, text string")
    S.save_index(S.build_index(d, "id", ["text"]), str(tmp_path / "ix"), buckets=8)
    read, made = S.load_index(spark, str(tmp_path / "ix")), S.build_index(d, "id", ["text"])
    for fuzzy, words in ((False, ["kitchen", "w3"]), (True, ["kitchne", "baech1"])):
        score = lambda ix: sorted((r["doc_id"], round(r["score"], 9)) for r in S.scored(ix, words, fuzzy=fuzzy).collect())  # noqa: B023, E731
        assert score(read) == score(made) != []


def test_newest_first_and_wards(spark):
    d = spark.createDataFrame([(1, "a kitchen", "5", 1), (2, "kitchen", "5", 3), (3, "kitchen", "6", 2)], "id int, text string, ward string, at int")
    ix = S.build_index(d, "id", ["text"])
    assert [r["id"] for r in S.search(d, ix, "id", S.Request("kitchen", time="at"))[0].collect()] == [2, 3, 1]
    assert {r["id"] for r in S.in_ward(d, ix, "id", "5", "kitchen")[0].collect()} == {1, 2}


def test_swaps_are_one_edit(spark):
    words = ["kitchen", "kitchne", "iktchne", "kithcen", "kitch", "ktchn", "xitchenx", "ikthcen", "other"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    assert {r[0] for r in df.where(S.near("w", "kitchen", 1)).collect()} == {"kitchen", "kitchne", "kithcen"}
    assert {r[0] for r in df.where(S.near("w", "kitchen", 2)).collect()} == {"kitchen", "kitchne", "iktchne", "kithcen", "kitch", "ktchn", "xitchenx", "ikthcen"}


def test_a_query_gathers_its_own_terms_only(spark):
    """With stemming too: words of other stems are neither shuffled nor stemmed once an occurrence."""
    d = spark.range(400).selectExpr("id", "concat(if(id % 40 = 0, 'broken handrails ', ''), array_join(transform(sequence(1, 300), i -> concat('word', (id * 7 + i) % 500)), ' ')) as text")
    index = S.build_index(d, "id", ["text"], stemming=True)
    assert index.of("tok = 'handrail'")[1].collect() == index.vocab.where("tok = 'handrail'").select("field", "tok", "df").collect() != []
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = lambda: {s.stageId(): s.shuffleWriteRecords() for s in spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), None))}
    before = stages()
    found = S.scored(index, S.analyse("broken handrail", stemming=True)).collect()
    assert {r["doc_id"] for r in found} == set(range(0, 400, 40)) and len({round(r["score"], 9) for r in found}) == 1
    time.sleep(2)
    assert sum(n for k, n in stages().items() if k not in before) < 8_000  # 120,000 occurrences
