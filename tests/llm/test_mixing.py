import random

from cedarloom.llm.mixing import mix_report, mixed, plan


def docs(spark):
    random.seed(2)
    rows = [(i, "big", random.randint(1, 400)) for i in range(3000)] + [(10_000 + i, "small", random.randint(1, 400)) for i in range(200)]
    rows += [(20_000 + i, "mid", 50) for i in range(500)] + [(1, None, 9), (2, "other", 9), (3, "big", 0)]
    return spark.createDataFrame(rows, "doc_id bigint, source string, n_tokens bigint")


def targets(spark):
    return spark.createDataFrame([("big", 0.5, 1), ("small", 0.3, 4), ("mid", 0.1, 2), ("nowhere", 0.1, 2)], "source string, target_share double, max_repeats int")


def test_shares_caps_and_determinism(spark):
    d, t = docs(spark), targets(spark)
    got = mixed(d, t).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixed(d.repartition(7), t).collect()))
    assert all(1 <= r["copies"] <= {"big": 1, "small": 4, "mid": 2}[r["source"]] for r in got)
    assert len({(r["doc_id"], r["source"]) for r in got}) == len(got)
    shares = {r["source"]: r["actual_share"] for r in mix_report(spark.createDataFrame(got), t).collect()}
    for s, want in (("big", 0.5 / 0.9), ("small", 0.3 / 0.9), ("mid", 0.1 / 0.9), ("nowhere", 0.0)):
        assert abs(shares[s] - want) < 0.01, (s, shares)


def test_dual_meets_its_constraints(spark):
    d, t = docs(spark), targets(spark)
    rows = {r["source"]: r for r in plan(d, t, total_tokens=50_000.0).collect()}
    import math

    for s, r in rows.items():
        own = [x["n_tokens"] for x in d.where(f"source = '{s}' and n_tokens > 0").collect()]
        got = sum(n * min(r["cap"], math.exp(min(700, r["tilt"] * n / r["mean"]))) for n in own)
        assert abs(got - r["goal"]) < 1e-4 * r["goal"]


def test_empty(spark):
    d, t = docs(spark), targets(spark)
    assert mixed(d.limit(0), t).count() == 0
    assert mixed(d, t.limit(0)).count() == 0
