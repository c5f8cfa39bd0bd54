from datetime import datetime

from cedarloom.llm.survivors import survivors

SCHEMA = "pos bigint, package_id string, name string, format string, url string, datastore_active boolean, last_modified timestamp, description string, licence string, size_bytes bigint"


def entry(pos, name="Beach Samples", fmt="csv", url=None, ds=False, when=None, d=None, lic=None, size=None, package="p"):
    return (pos, package, name, fmt, url, ds, when and datetime(*when), d, lic, size)


def run(spark, rows):
    got = survivors(spark.createDataFrame(rows, SCHEMA)).collect()
    return {r["keep_pos"]: r["from_pos"] for r in got}


def test_rank_and_fill(spark):
    rows = [
        entry(1, fmt="CSV", when=(2020, 1, 1), lic="open"),
        entry(2, "beach_samples (json)", " .JSON", when=(2019, 1, 1), d="n/a", url="http://x/Beach-Samples.json?download=1"),
        entry(3, "BEACH SAMPLES - XLS", "xls", when=(2021, 1, 1), d="about", size=5),
        entry(4, "beach samples 2019", "csv"),
    ]
    assert run(spark, rows) == {2: {"licence": 1, "description": 3, "size_bytes": 3}}


def test_trust_then_format_then_recency_then_position(spark):
    assert run(spark, [entry(1, fmt="json"), entry(2, fmt="shp", ds=True)]) == {2: {}}
    assert run(spark, [entry(1, when=(2019, 1, 1)), entry(2, when=(2020, 1, 1)), entry(3)]) == {2: {}}
    assert run(spark, [entry(5), entry(4), entry(4)]) == {4: {}}


def test_file_names_part_groups(spark):
    rows = [entry(1, url="http://x/a/beach_samples_north.csv"), entry(2, url="http://x/beach_samples_south.csv"), entry(3, None), entry(4, package=None)]
    assert run(spark, rows) == {}
    assert run(spark, []) == {}
