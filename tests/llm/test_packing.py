import random

from hypothesis import given, settings
from hypothesis import strategies as st

from cedarloom.llm.packing import best_fit, fill_report, packed


def plain(sizes, capacity, most):
    """Best fit over a list of open bins."""
    bins, out, n = [], [], 0
    for s in sizes:
        fit = [b for b in bins if b[1] >= s]
        if fit:
            b = min(fit, key=lambda b: b[1])
        else:
            if len(bins) == most:
                bins.remove(min(bins, key=lambda b: b[1]))
            b = [n, capacity]
            n += 1
            bins.append(b)
        b[1] -= s
        out.append(capacity - b[1])
    return out, n


@given(st.lists(st.integers(0, 50), max_size=200), st.integers(1, 8))
@settings(deadline=None, max_examples=60)
def test_bins_never_overflow_and_are_as_many_as_plain_best_fit(sizes, most):
    got = best_fit(sizes, 50, most)
    load = {}
    for b, s in zip(got, sizes, strict=True):
        load[b] = load.get(b, 0) + s
    assert all(v <= 50 for v in load.values())
    assert len(load) == plain(sizes, 50, most)[1]


def test_pieces(spark):
    random.seed(1)
    items = [(i, random.choice([3, 17, 60, 90, 100, 250, 0])) for i in range(300)] + [(7, 60), (999, 1050)]
    caps = spark.createDataFrame([(1, 100), (2, 1000), (3, None), (4, 0)], "capacity_id int, capacity_tokens int")
    df = spark.createDataFrame(items, "doc_id bigint, n_tokens bigint")
    rows = packed(df, caps, open_bins=16, stream_tokens=2000).collect()
    for cap_id, cap in ((1, 100), (2, 1000)):
        own = [r for r in rows if r["capacity_id"] == cap_id]
        load = {}
        for r in own:
            load[r["container_id"]] = load.get(r["container_id"], 0) + r["token_end"] - r["token_start"]
        assert max(load.values()) <= cap
        assert sum(load.values()) == sum(n for _, n in items)
        assert {r["doc_id"] for r in own} == {i for i, _ in items}
        assert all(r["piece"] == 0 for r in own if dict(items)[r["doc_id"]] <= cap)
    share = {r["capacity_id"]: r["fill_share"] for r in fill_report(spark.createDataFrame(rows), caps).collect()}
    assert share[1] > 0.8


def test_empty(spark):
    caps = spark.createDataFrame([(1, 100)], "capacity_id int, capacity_tokens int")
    assert packed(spark.createDataFrame([], "doc_id bigint, n_tokens bigint"), caps).count() == 0
    assert packed(spark.createDataFrame([(1, 5)], "doc_id bigint, n_tokens bigint"), caps.limit(0)).count() == 0


