import pytest

from cedarloom.functions import classify as C
from cedarloom.functions import names as N
from cedarloom.functions.stem import stem
from cedarloom.operators import medallion as M


@pytest.mark.parametrize("a,b", [("Three-  BedRoomUnits_Pct", "three_bed_room_units_pct"), ("E.Coli", "e.coli"), ("HTTPServer", "httpserver"), ("estName", "est_name")])
def test_snake(spark, a, b):
    assert N.snake(a) == b
    assert spark.createDataFrame([(a,)], "s string").selectExpr(N.snake_sql("s")).first()[0] == b


@pytest.mark.parametrize("f,a,b", [
    (N.silver_name, "_id", "original_id"), (N.silver_name, "_rank", None), (N.silver_name, "Type of Outbreak", "outbreak_type"), (N.column_name, "2016.0", "2016"), (N.column_name, "A - B/C$", "a_b_c"),
    (N.store_name, "__a.b$c", "_a_b_c"), (N.search_name, "Establishment_Name", "estName"), (N.search_name, "STREET_NAME", "street_name"), (N.search_name, "Three_+_Bedroom_Units", "three_plus_bedroom_units"),
    (N.search_name, "someField", "someField"), (N.mapping_name, "E.Coli Level", "e_coli_level"), (N.clean_id, "Data - set (1)", "data_set_1"),
])
def test_plan_time_names(f, a, b):
    assert f(a) == b


@pytest.mark.parametrize("a,b", [("data.json", "data"), ("Beach Water Quality (XML)", "beach water quality"), ("inspections_2024_csv", "inspections_2024"), ("a.json.csv", "a"), ("a.csv.json", "a.csv"), ("DineSafe - CSV", "dinesafe")])
def test_resource_name(spark, a, b):
    assert spark.createDataFrame([(a,)], "s string").selectExpr(N.resource_name_sql("s")).first()[0] == b


def test_urls():
    assert N.file_name("https://example.com/members/en/votes/csv", "csv") == "votes.csv"
    assert N.file_name("https://example.com/data/Parliament_2024.csv", "csv") == "parliament_2024.csv"
    assert N.file_name("https://example.com/", "xml") == "parliament_votes.xml"
    assert N.file_name("https://example.com/api/votes/12", "json") == "votes_12.json"
    assert N.base_path("http://x.org/a/b.csv?format=csv&q=1#f") == "http://x.org/a/b?q=1"


CATALOGUE = [
    (0, "r1", "DineSafe - CSV", "CSV", "http://x/dinesafe.csv", False), (1, "r2", "DineSafe", "JSON", "http://x/dinesafe.json", False), (2, "r3", "ob_report_2016", "JSON", "http://x/ob_report_2016.json", False),
    (3, "r4", "ob_report_2017", "JSON", "http://x/ob_report_2017.json", False), (4, "r5", "report", "CSV", "http://x/ob_report_2018.csv", False), (5, "r6", "ward boundary", "ZIP", "http://x/w.zip", False),
    (6, "r7", "live table", "CSV", "http://x/dump/abc", True), (7, "r8", "no url", "CSV", "", False),
]


def test_catalogue(spark):
    from cedarloom.operators import resources as R

    df = spark.createDataFrame(CATALOGUE, "pos int, id string, name string, format string, url string, datastore_active boolean")
    at = {r["pos"]: r for r in R.described(df).collect()}
    assert [at[i]["signature"] for i in range(8)] == ["dinesafe", "dinesafe", "ob_report_2016", "ob_report_2017", "report:ob_report_2018", "ward boundary:w", "live table:abc", "no url"]
    assert [(at[i]["method"], at[i]["method_format"]) for i in range(8)] == [("csv", "csv"), ("json_file", "json"), ("json_file", "json"), ("json_file", "json"), ("csv", "csv"), ("shp", "zip"), ("datastore", "json"), (None, None)]
    assert sorted(r["pos"] for r in R.deduplicated(df).collect()) == [1, 2, 3, 4, 5, 6, 7]


@pytest.mark.parametrize("ds,issue,sub,kind", [
    ("dinesafe", "health", "food_safety", "inspection"), ("toronto-beaches-observations", "environment", "water_environment", "measurement"), ("business-licences", "transportation", None, "record"),
    ("tree-list", "environment", None, "inventory"), ("fire-incidents", "safety", "fire-services", "incident"), ("zzz", None, None, "record"),
])
def test_classification(spark, ds, issue, sub, kind):
    df = spark.createDataFrame([(ds,)], "d string").selectExpr("d", f"{C.primary_issue('d')} as i")
    assert tuple(df.selectExpr("i", C.subcategory("d", "i"), C.data_type("d")).first()) == (issue, sub, kind)
    assert df.selectExpr(C.primary_issue("d", default="uncategorized")).first()[0] == (issue or "uncategorized")


def test_keys():
    assert C.data_type_of_keys(["Severity"]) == "inspection" and C.data_type_of_keys([]) == "unknown" and C.data_type_of_keys(["x"]) == "general"


def test_outbreak_record(spark):
    df = spark.createDataFrame([(1, 9, " ABC ", "Respiratory", "N/A", "unknown", "2024-01-05T00:00:00", "Y"), (2, 9, "", None, "-", "x", None, "maybe")],
        "_id int, _rank int, `Institution Name` string, `Type of Outbreak` string, `Causative Agent-1` string, `Causative Agent-2` string, `Date Outbreak Began` string, Active string")
    a, b = M.normalised(df).orderBy("original_id").collect()
    assert tuple(a) == (1, "ABC", "Respiratory", None, "unknown", "2024-01-05T00:00:00", True)
    assert (b["institution_name"], b["is_active"]) == (None, False)
    s = M.silver(df, "'outbreaks-in-toronto-healthcare-institutions'", "'res'").orderBy("original_id").first()
    assert s["_unique_id"] == "outbreaks-in-toronto-healthcare-institutions:res:1" and s["primary_issue"] == "health" and "outbreaks in toronto" in s["searchable_text"]
    raw = M.bronze(df, "'d'").orderBy("_raw_id").first()
    assert raw["_raw_id"] == "d:unknown_source:1"
    assert {r["_checksum"] for r in M.bronze(df.select(*reversed(df.columns)), "'d'").collect()} == {r["_checksum"] for r in M.bronze(df, "'d'").collect()}


def test_gold_and_dates(spark):
    df = spark.createDataFrame([("a", "d", 43.6, None, "43.6", "-79.4"), ("b", "d", None, None, "x", "-79.4"), ("c", "d", 0.0, None, "1", "2")], "_unique_id string, dataset_id string, centroid_lat double, centroid_lon double, latitude string, longitude string")
    at = {r["_unique_id"]: r["location"] for r in M.gold(df).collect()}
    assert tuple(at["a"]) == (43.6, -79.4) and at["b"] is None and tuple(at["c"]) == (1.0, 2.0)
    sh = spark.createDataFrame([("1", "2019-01-01T00:00:00"), ("2", "01/02/2020"), ("3", "13/45/2020"), ("4", None)], "_unique_id string, occupancy_date string")
    assert [r["insDate"] for r in M.transformed(sh, "shelter").orderBy("_unique_id").collect()] == ["2019-01-01", "2020-01-02", None, None]
    assert M.transformed(sh, "shelter").first()["issue_keywords"] == ["tenant"]


@pytest.mark.parametrize("a,b", [("caresses", "caress"), ("ponies", "poni"), ("relational", "relat"), ("hopping", "hop"), ("filing", "file"), ("happy", "happi"), ("adjustment", "adjust"), ("inspections", "inspect")])
def test_stem(a, b):
    assert stem(a) == b


def test_registered_queries_have_names_in_both():
    import __spark_entry__ as E

    assert set(E.oracle_sql()) <= set(E.queries()) and "flagship" in E.queries()


def test_rules_may_be_others(spark, tmp_path):
    from cedarloom.config import store
    from cedarloom.functions import classify as C

    own, known = {"sport": (["rink"], {"ice": ["rink"]})}, {"a": ("play", [], "toys")}
    df = spark.createDataFrame([("a",), ("city-rink",), ("x",)], "d string")
    got = df.selectExpr(C.primary_issue("d", default="none", taxonomy=own, known=known) + " as i", C.subcategory("d", "'sport'", "none", own, known) + " as s").collect()
    assert [tuple(r) for r in got] == [("play", "toys"), ("sport", "ice"), ("none", "none")]
    N.add_field_name("Strasse", "street_name")
    assert N.silver_name("Strasse") == "street_name" and "Strasse" in N.all_field_names()
    assert store("gold", str(tmp_path / "g")) is store("gold", str(tmp_path / "g"))


def test_search_names_keep_their_case():
    assert [N.search_name(n) for n in ("CRIME TYPE", "FooBar", "A.B (c)+", "TOTAL_UNITS", "Total_Units", "Street_No.")] == ["CRIME_TYPE", "FooBar", "AB_c_plus_", "total_units", "total_units", "street_no"]
