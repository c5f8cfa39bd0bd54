"""Filling containers of fixed capacity with items (problem 7).

Method: bounded-space online best-fit. A fixed number of bins is open; a bitset keyed by free space
finds the bin with the least room that still takes an item. If none does, a new bin is opened, and
if too many are open the fullest closes first. Items are dealt by a hash of their key into streams
of bounded size that are packed side by side; only keys and sizes are shuffled, never texts.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN_BINS = 256
STREAM_TOKENS = 5_000_000


def best_fit(sizes: list[int], capacity: int, open_bins: int = OPEN_BINS) -> list[int]:
    """The bin number of each item, in the order of arrival. Every size is at most `capacity`."""
    bits, by_free, n_open, n_bins, out = 0, {}, 0, 0, []
    for size in sizes:
        fits = bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            own = by_free[free]
            bin_ = own.pop()
            if not own:
                bits ^= 1 << free
        else:
            if n_open == open_bins:
                fullest = (bits & -bits).bit_length() - 1
                own = by_free[fullest]
                own.pop()
                n_open -= 1
                if not own:
                    bits ^= 1 << fullest
            bin_, free, n_bins, n_open = n_bins, capacity, n_bins + 1, n_open + 1
        free -= size
        if not by_free.get(free):
            by_free[free] = []
            bits |= 1 << free
        by_free[free].append(bin_)
        out.append(bin_)
    return out


def packed(items: DataFrame, capacities: DataFrame, open_bins: int = OPEN_BINS, stream_tokens: int = STREAM_TOKENS) -> DataFrame:
    """(capacity_id, container_id, doc_id, piece, token_start, token_end) of items (doc_id,
    n_tokens) for each of the capacities (capacity_id, capacity_tokens).

    An item larger than the capacity is cut into full pieces, each a container of its own, and a
    rest that is packed like any item; no other item is cut. Items without tokens go where any room
    is. Repeated items are packed each. Capacities that are null or below 1 hold nothing. The table
    of capacities is a parameter table, read here; its rows become part of the plan."""
    total = items.agg(F.sum("n_tokens")).first()[0] or 0
    streams = max(1, math.ceil(total / stream_tokens))
    caps = [f"struct({r[0]} as capacity_id, {r[1]}L as cap)" for r in capacities.where("capacity_tokens >= 1").select("capacity_id", "capacity_tokens").collect()]
    each = f"inline(array({', '.join(caps)}))" if caps else "inline(cast(array() as array<struct<capacity_id:int,cap:bigint>>))"
    dealt = items.selectExpr("doc_id", "n_tokens", f"pmod(xxhash64(doc_id), {streams}) as stream", each)

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        capacity_id, stream, cap = (int(k) for k in key)
        rows = rows.sort_values(["doc_id", "n_tokens"])
        doc, size = rows["doc_id"].to_numpy(), rows["n_tokens"].to_numpy()
        full = (size // cap) * (size > cap)
        rest = size - full * cap
        bins = best_fit([int(r) for r, f in zip(rest, full, strict=True) if not (f and r == 0)], cap, open_bins)
        own, new, out = iter(bins), max(bins, default=-1) + 1, []
        for d, f, r, s in zip(doc, full, rest, size, strict=True):
            for k in range(f):
                out.append((capacity_id, (stream << 32) + new, d, k, k * cap, (k + 1) * cap))
                new += 1
            if not (f and r == 0):
                out.append((capacity_id, (stream << 32) + next(own), d, int(f), f * cap, s))
        return pd.DataFrame(out, columns=["capacity_id", "container_id", "doc_id", "piece", "token_start", "token_end"])

    return dealt.groupBy("capacity_id", "stream", "cap").applyInPandas(
        pack, "capacity_id int, container_id bigint, doc_id bigint, piece int, token_start bigint, token_end bigint"
    )


def fill_report(pieces: DataFrame, capacities: DataFrame) -> DataFrame:
    """(capacity_id, capacity_tokens, containers, tokens, fill_share) of packed pieces."""
    used = pieces.groupBy("capacity_id").agg(F.count_distinct("container_id").alias("containers"), F.sum(F.expr("token_end - token_start")).alias("tokens"))
    return capacities.join(used, "capacity_id").selectExpr(
        "capacity_id", "capacity_tokens", "containers", "tokens", "round(tokens / (containers * cast(capacity_tokens as bigint)), 6) as fill_share"
    )
