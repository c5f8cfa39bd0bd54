import json

from cedarloom.operators.drift import Drift, one_table

SCHEMA = "raw_id bigint, dataset_id string, source_file string, file_seq int, original string"


def records():
    out, n = [], 0
    for seq in (1, 2, 3):
        for k in range(12):
            r = {"EST_ID": 9000000 + k, "est_name": f"Kitchen {k:03d}", "street": f"Long Street {k}", "open": k % 2 == 0}
            if seq > 1:  # renamed; retyped; another boolean in place of the first
                r["EstablishmentName"], r["open"] = r.pop("est_name"), "Y" if k % 2 == 0 else "N"
                r["fee"] = k
            if seq > 2:
                r["licensed"] = k % 3 == 0
                r.pop("open")
            out.append((n := n + 1, "d", f"f{seq}.csv", seq, json.dumps(r)))
    out += [(n + 1, "d", "f1.csv", 1, "not json"), (n + 2, "d", "f1.csv", 1, None), out[0]]
    return out


def test_changes(spark):
    df = spark.createDataFrame(records(), SCHEMA)
    got = {tuple(r)[1:] for r in Drift(df).changes().collect()}
    assert got == {
        ("f2.csv", "EstablishmentName", "renamed"),
        ("f2.csv", "open", "retyped"),
        ("f2.csv", "fee", "added"),
        ("f3.csv", "open", "removed"),
        ("f3.csv", "licensed", "added"),
    }


def test_one_table_keeps_every_record(spark):
    df = spark.createDataFrame(records(), SCHEMA)
    rows = one_table(df, Drift(df)).collect()
    assert len(rows) == len(records())
    by = {r["raw_id"]: r for r in rows}
    assert by[1]["establishment_name"] == by[13]["establishment_name"] == "Kitchen 000" and by[1]["establishment_id"] == 9000000
    assert json.loads(by[13]["rescued"])["fee"] == "0"
    assert by[37]["rescued"] == "not json" and by[38]["rescued"] is None


def test_rescued_values_are_replayed(spark):
    dates = ["2022-06-08", "6/8/2022", "1654646400", 1654646400]
    rows = [(i, "d", "f1", 1, json.dumps({"Inspection_Date": v, "isOpen": b, "wardNo": w, "note": "x"})) for i, (v, b, w) in enumerate(zip(dates, ["Y", "no", True, "maybe"], ["12", 12.0, "+12", "12a"], strict=True))]
    rows += [(9, "d", "f1", 1, json.dumps({"wardNo": 3, "ward": 4}))]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["raw_id"]: r for r in one_table(df, Drift(df)).collect()}
    assert {str(got[i]["inspection_date"]) for i in range(4)} == {"2022-06-08"}
    assert [got[i]["is_open"] for i in range(4)] == [True, False, True, None] and [got[i]["ward"] for i in range(4)] == [12, 12, 12, None]
    assert [json.loads(got[i]["rescued"]) for i in range(4)] == [{"note": "x"}] * 3 + [{"isOpen": "maybe", "wardNo": "12a", "note": "x"}]
    # two fields for one column: one is taken, the other rescued
    assert {got[9]["ward"], *map(int, json.loads(got[9]["rescued"]).values())} == {3, 4}


def test_establishments_with_many_records_a_file(spark):
    rows, n = [], 0
    for seq in (1, 2):
        for k in range(300):
            for visit in range(3):
                r = {"id_no": 9000000 + k, "street": f"Long Street {k}", ("est_name" if seq == 1 else "trading_as"): f"Kitchen {k:03d}", "visit": visit}
                rows.append((n := n + 1, "d", f"f{seq}.csv", seq, json.dumps(r)))
    got = {tuple(r)[2:] for r in Drift(spark.createDataFrame(rows, SCHEMA)).changes().collect()}
    assert got == {("trading_as", "renamed")}


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert Drift(df).changes().count() == 0
