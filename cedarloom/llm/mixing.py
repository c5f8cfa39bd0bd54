"""Mixing sources to target weights (problem 8).

Method: entropy balancing. The rates of the documents are the ones nearest to uniform, in relative
entropy, under which each source contributes its share of the tokens: exponentially tilted in the
size of the document and cut at the source's cap. The convex dual has one unknown a source; Newton
steps solve it, each a distributed aggregation of one row a source over the histogram of sizes, which
is all the sums need. Rates are then rounded into copies by systematic selection along the sizes;
what a source is short of or over by is then taken up by single documents of about that size.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cedarloom.io import cut

STEPS, TOLERANCE = 60, 1e-9


def _solve(sizes: DataFrame, goal: dict[str, float], cap: dict[str, float], mean: dict[str, float]) -> dict[str, float]:
    """The tilt of each source: sum of t * min(cap, exp(tilt * t / mean)) = goal."""
    tilt, low, high = dict.fromkeys(goal, 0.0), dict.fromkeys(goal, -math.inf), dict.fromkeys(goal, math.inf)
    todo = set(goal)
    spark = sizes.sparkSession
    for _ in range(STEPS):
        if not todo:
            break
        now = spark.createDataFrame([(s, tilt[s], cap[s], mean[s]) for s in sorted(todo)], "source string, tilt double, cap double, mean double")
        at = sizes.join(F.broadcast(now), "source").selectExpr("source", "n_tokens as t", "n", "mean", "cap", "least(exp(least(tilt * n_tokens / mean, 700D)), cap) as w")
        sums = at.groupBy("source").agg(F.sum(F.expr("n * t * w")).alias("got"), F.sum(F.expr("case when w < cap then n * t * t / mean * w else 0 end")).alias("slope")).collect()
        for r in sums:  # one row a source of the parameter table
            s, gap = r["source"], r["got"] - goal[r["source"]]
            if abs(gap) <= TOLERANCE * max(goal[s], 1):
                todo.discard(s)
                continue
            low[s], high[s] = (tilt[s], high[s]) if gap < 0 else (low[s], tilt[s])
            # Newton on the logarithm of the sum, which is near linear in the tilt; inside the bracket
            step = tilt[s] - (math.log(r["got"] / goal[s]) * r["got"] / r["slope"] if r["slope"] > 0 and r["got"] > 0 else math.inf)
            if not low[s] < step < high[s]:
                step = (low[s] + high[s]) / 2 if math.isfinite(low[s]) and math.isfinite(high[s]) else tilt[s] + (1 if gap < 0 else -1) * max(1.0, abs(tilt[s]))
            if step == tilt[s] or abs(step) > 1e6:
                todo.discard(s)
            tilt[s] = step
    # nine digits: what is left does not depend on the order of the additions
    return {s: float(f"{x:.9g}") for s, x in tilt.items()}


def plan(docs: DataFrame, targets: DataFrame, total_tokens: float | None = None) -> DataFrame:
    """(source, target_share, goal, tilt, cap, mean) for each source of `targets` that has documents
    (doc_id, source, n_tokens). The shares of sources without documents are dealt to the others in
    proportion. Without total_tokens the total is the largest that lets every source keep its share
    within its cap. A target table is a parameter: one row a source, collected here."""
    sizes = cut(docs.where("n_tokens > 0").groupBy("source", "n_tokens").agg(F.count("*").alias("n")), "histogram")
    have = sizes.groupBy("source").agg(F.sum(F.expr("n * n_tokens")).alias("tokens"), F.sum("n").alias("docs"))
    rows = targets.where("target_share > 0 and max_repeats >= 1").join(have, "source").collect()
    spark = docs.sparkSession
    schema = "source string, target_share double, goal double, tilt double, cap double, mean double"
    if not rows:
        return spark.createDataFrame([], schema)
    share = {r["source"]: r["target_share"] / sum(x["target_share"] for x in rows) for r in rows}
    most = {r["source"]: float(r["tokens"] * r["max_repeats"]) for r in rows}
    total = min([*(most[s] / share[s] for s in share), *([total_tokens] if total_tokens else [])])
    goal = {s: share[s] * total for s in share}
    cap, mean = {r["source"]: float(r["max_repeats"]) for r in rows}, {r["source"]: r["tokens"] / r["docs"] for r in rows}
    free = {s: g for s, g in goal.items() if g < most[s] * (1 - 1e-12)}
    tilt = _solve(sizes, free, cap, mean)
    return spark.createDataFrame([(s, share[s], goal[s], tilt.get(s, 1e6), cap[s], mean[s]) for s in sorted(share)], schema)


def mixed(docs: DataFrame, targets: DataFrame, total_tokens: float | None = None, part_docs: int = 100_000) -> DataFrame:
    """(doc_id, source, n_tokens, rate, copies), the documents that are taken, copies >= 1 and at
    most the cap of the source. Documents of sources without a target, without a source, or without
    tokens are not taken. Equal documents (same doc_id) are taken each on its own."""
    rates = F.broadcast(plan(docs, targets, total_tokens))
    # documents of one source and size are cut into parts, so that no window holds more than these
    parts = max(64, docs.count() // part_docs)
    at = docs.where("n_tokens > 0").join(rates, "source").selectExpr(
        "doc_id", "source", "n_tokens", "cap", "cast(least(exp(least(tilt * n_tokens / mean, 700D)), cap) as decimal(20,9)) as rate", "cast(floor(log2(n_tokens) * 8) as int) as band", f"pmod(xxhash64(doc_id), {parts}) as part"
    )
    at = cut(at, "rates")
    # running sum of the rates along size: over the bands and parts, then within each; in decimals,
    # so that it doesn't depend on the order of the additions
    at = at.withColumn("block", F.expr("part div 1000"))
    cells = at.groupBy("source", "band", "block", "part").agg(F.sum("rate").alias("s"))
    # sums before each band, each block of a band, each part of a block: no window holds more than
    # the bands, the blocks of one band, or a thousand parts
    blocks = cells.groupBy("source", "band", "block").agg(F.sum("s").alias("s"))
    bands = blocks.groupBy("source", "band").agg(F.sum("s").alias("s")).selectExpr("source", "band", "sum(s) over (partition by source order by band) - s as b1")
    blocks = blocks.selectExpr("source", "band", "block", "sum(s) over (partition by source, band order by block) - s as b2")
    before = cells.selectExpr("source", "band", "block", "part", "sum(s) over (partition by source, band, block order by part) - s as b3").join(blocks, ["source", "band", "block"]).join(bands, ["source", "band"])
    before = before.selectExpr("source", "band", "part", "cast(b1 + b2 + b3 as decimal(38,9)) as before")
    run = at.join(before, ["source", "band", "part"]).selectExpr("doc_id", "source", "n_tokens", "cap", "rate", "before + sum(rate) over (partition by source, band, part order by n_tokens, doc_id rows unbounded preceding) as upto")
    copies = "cast(least(floor(upto + 0.5) - floor(upto - rate + 0.5), cap) as int) as copies"
    run = cut(run.selectExpr("doc_id", "source", "n_tokens", "rate", "cap", "upto", copies), "rounded")
    return _evened(run, rates).where("copies > 0").select("doc_id", "source", "n_tokens", "rate", "copies")


def _evened(run: DataFrame, rates: DataFrame, rounds: int = 2) -> DataFrame:
    """The rounded copies, with the tokens a source is short of (or over by) made up by one copy more
    (or less) of the document nearest to them in size; repeated while that brings it nearer. upto is
    the place of a row in its source."""
    for _ in range(rounds):
        gap = run.groupBy("source").agg(F.sum(F.expr("n_tokens * copies")).alias("got")).join(rates.select("source", "goal"), "source").selectExpr("source", "goal - got as gap")
        own = run.join(F.broadcast(gap), "source").where("case when gap > 0 then copies < cap and rate > 0 else copies > 0 end")
        near = own.where("abs(n_tokens - abs(gap)) < abs(gap)").groupBy("source").agg(F.min(F.struct(F.expr("abs(n_tokens - abs(gap))"), "doc_id", "upto", F.expr("cast(sign(gap) as int) as step"))).alias("m"))
        near = near.selectExpr("source", "m.doc_id as doc_id", "m.upto as upto", "m.step as step")
        rows = near.collect()  # a row a source of the targets
        if not rows:
            break
        run = run.join(F.broadcast(run.sparkSession.createDataFrame(rows, near.schema)), ["source", "doc_id", "upto"], "left").withColumn("copies", F.expr("copies + coalesce(step, 0)")).drop("step")
    return run


def mix_report(taken: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, actual_share, docs, copies, tokens, most_used) for every source of the
    targets; a source that nothing was taken of has 0."""
    got = taken.groupBy("source").agg(
        F.count("*").alias("docs"), F.sum("copies").cast("bigint").alias("copies"), F.sum(F.expr("n_tokens * copies")).cast("bigint").alias("tokens"), F.max("copies").alias("most_used")
    )
    whole = got.agg(F.sum("tokens").alias("whole"))
    at = targets.select("source", "target_share").join(got, "source", "left").crossJoin(F.broadcast(whole))
    zero = [f"coalesce({c}, 0) as {c}" for c in ("docs", "copies", "tokens", "most_used")]
    return at.selectExpr("source", "target_share", "round(coalesce(tokens / whole, 0D), 6) as actual_share", *zero)
