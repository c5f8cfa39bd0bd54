import pytest

from itertools import product

from cedarloom.llm.addresses import Parser, distance, edits, localities, same_address

P = Parser(["Tamsley", "Lower Wexmoor", "St. Aldric"])


@pytest.mark.parametrize(
    "text,want",
    [
        ("17B-51 Sesronhasfan Blvd., Tamsley ON  N0J 4S6", ("51", "sesronhasfan", "boulevard", "", "tamsley", "n0j4s6")),
        ("54, boul. Sesronhasfan", ("54", "sesronhasfan", "boulevard", "", "", "")),
        ("UNIT 22, PARNESPURZUN BVD, 246, ST. ALDRIC ONT.  M0C2B2, CANADA", ("246", "parnespurzun", "boulevard", "", "staldric", "m0c2b2")),
        ("972 E Vishedullpal Cres - side entrance", ("972", "vishedullpal", "crescent", "e", "", "")),
        ("51  N. Wenfolnellun St", ("51", "wenfolnellun", "street", "n", "", "")),
        ("Nine Kinpulginnel Sq (at Other Rd)", ("9", "kinpulginnel", "square", "", "", "")),
        ("Sifosnes House Apt 30 148A Tarselronses road", ("148a", "tarselronses", "road", "", "", "")),
        ("44 Tusesgirron Avenue North, Tamsly Ontario MOC 3VO", ("44", "tusesgirron", "avenue", "n", "tamsley", "m0c3v0")),
    ],
)
def test_parse(text, want):
    p = P.parse(text)
    assert tuple(p[k] for k in ("num", "name", "kind", "dir", "city", "postal")) == want


@pytest.mark.parametrize("text", [None, "", "N/A", "address withheld", "-", "TBD", "unknown", "12"])
def test_unusable(text):
    assert P.parse(text) is None


def test_distance():
    assert [distance(a, b, 2) for a, b in (("abcd", "abdc"), ("abcd", "abcd"), ("abcd", "axyd"), ("abcd", "wxyz"), ("a", "abcd"))] == [1, 0, 2, 3, 3]


SCHEMA = "premise_id bigint, addr_full string, address string, shelter_address string, city string, postal_code string"


def test_pairs(spark):
    base = [(100 + i, None, f"{i} Parnespurzun Blvd", None, "Tamsley", None) for i in range(20)] + [(200 + i, None, f"{i} Parnespurzun Road", None, "Tamsley", None) for i in range(20)]
    base += [(300 + i, None, f"{i} Longbrooken Ave E", None, "St. Aldric", "M0C 1A1") for i in range(9)] + [(320 + i, None, f"{i} Longbrooken Ave W", None, "St. Aldric", "M0C 2B2") for i in range(9)]
    rows = [
        (1, "Unit 3, 77 Parnespurzun Boulevard, Tamsley", None, None, None, None), (2, None, "77 PARNESPRUZUN BVD", None, "Tamsly", None), (3, None, None, "77 Parnespurzun Rd", "Tamsley", None),
        (4, None, "77A Parnespurzun Blvd", None, "Tamsley", None), (5, None, "7 Longbrooken Ave", None, None, "M0C 2B2"), (6, None, "N/A", None, None, None), (7, None, None, None, None, None),
        (8, "y" * 20_000, None, None, None, None),
    ]
    got = {tuple(r) for r in same_address(spark.createDataFrame(base + rows, SCHEMA)).collect()}
    assert got == {(1, 2), (5, 327)}


def test_empty(spark):
    assert same_address(spark.createDataFrame([], SCHEMA)).count() == 0


def test_edits_in_sql(spark):
    words = ["debilviswel", "debivlsiwel", "debilvisel", "edbilviswle", "debilviswell", "xdebilviswel", "debxlvyswel", "debilviswe", "other", "debiliswlev"]
    rows = spark.createDataFrame(list(product(words, words)), "a string, b string").selectExpr("a", "b", f"{edits('a', 'b')} as d").collect()
    assert all((r["d"] if r["d"] is not None else 3) == min(distance(r["a"], r["b"], 2), 3) for r in rows)


def test_rare_cities_stay_themselves(spark):
    rows = [(i, None, "10 Longbrooken Ave", None, f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}ton{i}", None) for i in range(3000)]
    rows += [(5000, "10 Longbrooken Ave, Aaton0", None, None, None, None), (5001, None, "11 Longbrooken Ave", None, "aaton0", None)]
    assert {tuple(r) for r in same_address(spark.createDataFrame(rows, SCHEMA)).collect()} == {(0, 5000)}


def test_localities(spark):
    rows = [("milton", "l9t")] * 9 + [("hilton", "k0c"), ("miltn", "l9t"), ("mitlon", ""), ("mxltn", "l9t"), ("oakville", ""), ("milltown", "k1a")]
    got = dict(localities(spark.createDataFrame(rows, "city string, postal string")).collect())
    # another postal area: another place; six letters: one typo at most
    assert got == {"milton": "milton", "hilton": "hilton", "miltn": "milton", "mitlon": "milton", "mxltn": "mxltn", "oakville": "oakville", "milltown": "milltown"}


def test_very_long_street_name(spark):
    long = "".join(chr(97 + (i * 7 + i // 11) % 26) for i in range(20_000))
    rows = [(i, None, f"12 {long} Street", None, "Tamsley", None) for i in range(4)] + [(9, None, f"12 {long[:500]}{long[501:]} Street", None, "Tamsley", None)]
    assert same_address(spark.createDataFrame(rows, SCHEMA)).count() == 10


def test_clashing_names_and_ties(spark):
    rows = [(1, None, "5 Abcdefgh St", None, "Aa", None, "x"), (2, None, "5 Abcdefgh St", None, "Bb", None, "y"), (3, None, "5 Abcdefgh St", None, None, None, "z")]
    got = {tuple(r) for r in same_address(spark.createDataFrame(rows, SCHEMA + ", num string")).collect()}
    # a record without a city goes to one of two cities that are as likely, the later in name
    assert got == {(2, 3)}
