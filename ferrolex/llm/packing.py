"""Packing whole texts into containers of a fixed token capacity (problem 7).

Items are spread over packing groups of a bounded size by a hash. Each group is packed by best fit decreasing; lower
bounds from dual-feasible functions certify its number of bins. Groups with a gap between bins and bound give up the
documents of their emptiest bins, which are exchanged: regrouped with those of other groups and packed again, and the
exchange is kept only where it saves bins; rounds go on while they do. The certificates of all groups of a round are
kept (`certificates`), and `report` certifies the whole by dual-feasible bounds over all sizes.

A text longer than the capacity is cut into full containers and a rest that is packed like a text; no other text is
split. Defined results: a null text has no tokens and no container; an empty text takes none either (container null,
0 tokens); ties in size are ordered by row; repeated rows, and rows with one or no id, are packed each, as containers
and groups are told apart by a number of the row; further columns are not read.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrolex.llm.tokens import TOKENIZERS, VOCABULARY, token_count
from ferrolex.session import cut, spread

CAPACITY = 4096
#: Tokens in a packing group, in containers: a group holds about this many full containers, whatever the data's size.
GROUP_CONTAINERS = 512
#: Rounds of exchange at most, and below which fill the documents of a bin are exchanged: in groups whose number of bins
#: meets the bound, and in groups with a gap.
ROUNDS, EXCHANGED, EXCHANGED_OF_GAPS = 4, 0.6, 0.95
#: Staircases, and thresholds over half of the capacity, of the bound over all sizes.
STAIRS, THRESHOLDS = 20, 32


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """Bin number of each item; items are taken by falling size and put where the least room remains."""
    bins: list[int] = [0] * len(sizes)
    rooms: list[int] = []  # distinct rooms in use, sorted
    by_room: dict[int, list[int]] = {}
    count = 0
    for k in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[k]
        at = bisect_left(rooms, size)
        if at == len(rooms):
            b, room = count, capacity
            count += 1
        else:
            room = rooms[at]
            b = by_room[room].pop()
            if not by_room[room]:
                rooms.pop(at)
        bins[k] = b
        left = room - size
        if left > 0:
            if not by_room.setdefault(left, []):
                rooms.insert(bisect_left(rooms, left), left)
            by_room[left].append(b)
    return bins


def lower_bound(sizes: list[int], capacity: int) -> int:
    """A number of bins that no packing can undercut, from dual-feasible functions.

    f(x) = x / C; the step functions that round large items up to a bin and drop small ones (threshold e); and the
    staircases floor((k + 1) x / C) / k. Each maps sizes so that no feasible bin exceeds 1.
    """
    if not sizes:
        return 0
    best = -(-sum(sizes) // capacity)
    ordered = sorted(sizes)
    prefix = [0]
    for s in ordered:
        prefix.append(prefix[-1] + s)
    half = capacity // 2
    for e in {s for s in ordered if s <= half} | {0}:
        low, high = bisect_left(ordered, e), bisect_left(ordered, capacity - e + 1)
        best = max(best, len(ordered) - high + -(-(prefix[high] - prefix[low]) // capacity))
    for k in range(1, 21):
        total = 0  # of k (k + 1) u(x), where u(x) = x if (k + 1) x is whole, else floor((k + 1) x) / k
        for s in sizes:
            steps, left = divmod(s * (k + 1), capacity)
            total += steps * (k + 1 if left else k)
        best = max(best, -(-total // (k * (k + 1))))
    return best


def pack_group(capacity: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Packs one group: item columns with bin, fill of the bin, and the group's bins and bound."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["size", "item", "part"], ascending=[False, True, True], kind="stable")
        sizes = group["size"].tolist()
        bins = best_fit_decreasing(sizes, capacity)
        fill: dict[int, int] = {}
        for b, s in zip(bins, sizes):
            fill[b] = fill.get(b, 0) + s
        return pd.DataFrame({
            "grp": group["grp"].iloc[0], "doc_id": group["doc_id"], "item": group["item"], "part": group["part"], "size": group["size"], "bin": bins,
            "fill": [fill[b] for b in bins], "n_bins": len(fill), "bound": lower_bound(sizes, capacity),
        })

    return run


PACKED = "grp string, doc_id bigint, item bigint, part int, size bigint, bin int, fill bigint, n_bins int, bound int"


def pieces(docs: DataFrame, capacity: int, folder: str, vocabulary: str) -> DataFrame:
    """doc_id, item (number of the row), n_tokens, part, size: one row per text, or per full container and rest of a text over the capacity."""
    texts = spread(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
    sized = texts.select("doc_id", F.coalesce(token_count(F.col("text"), folder, vocabulary), F.lit(0)).alias("n_tokens"))
    sized = sized.withColumn("item", F.monotonically_increasing_id())  # fixed by the checkpoint that follows
    full = F.floor((F.col("n_tokens") - 1) / capacity).cast("int")
    parts = F.when(F.col("n_tokens") > capacity, F.sequence(F.lit(0), full)).otherwise(F.array(F.lit(0)))
    rows = sized.select("doc_id", "item", "n_tokens", F.explode(parts).alias("part"))
    rest = F.col("n_tokens") - F.col("part") * capacity
    return rows.withColumn("size", F.least(rest, F.lit(capacity)))


def pack(docs: DataFrame, capacity: int = CAPACITY, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY, rounds: int = ROUNDS, group_containers: int = GROUP_CONTAINERS) -> DataFrame:
    """doc_id, part, n_tokens (of the part), container, position of the part's first token in its text."""
    return certified(docs, capacity, folder, vocabulary, rounds, group_containers)[0]


def certified(
    docs: DataFrame, capacity: int = CAPACITY, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY, rounds: int = ROUNDS, group_containers: int = GROUP_CONTAINERS
) -> tuple[DataFrame, DataFrame]:
    """The packing, and the certificate of each group packed: round_no, grp, n_bins, bound; n_bins = bound is optimal.

    Shuffles sizes only, never texts: one exchange for the first packing and one, of the emptiest bins, per round.
    """
    if capacity < 1:
        raise ValueError("the capacity must be at least 1")
    items = cut(pieces(docs, capacity, folder, vocabulary))
    total = items.where((F.col("size") > 0) & (F.col("size") < capacity)).agg(F.sum("size")).first()[0] or 0
    groups = max(1, math.ceil(total / (capacity * group_containers)))
    whole = items.where(F.col("size") == capacity).select(
        F.concat(F.lit("w"), F.col("item"), F.lit("-"), F.col("part")).alias("grp"), "doc_id", "part", "size", F.lit(0).alias("bin")
    )
    loose = items.where((F.col("size") > 0) & (F.col("size") < capacity))
    scatter = lambda df, n, r: df.withColumn("grp", F.concat(F.lit(f"r{r}-"), F.pmod(F.xxhash64("item", "part", F.lit(r)), F.lit(n)).cast("string")))
    packed = cut(scatter(loose, groups, 0).select("grp", "doc_id", "item", "part", "size").groupBy("grp").applyInPandas(pack_group(capacity), PACKED))
    proof = lambda df, r: df.groupBy("grp").agg(F.first("n_bins").alias("n_bins"), F.first("bound").alias("bound")).select(F.lit(r).alias("round_no"), "grp", "n_bins", "bound")
    proofs = proof(packed, 0)
    settled = []
    for r in range(1, rounds + 1):
        # Well-filled bins are settled; a certified group gives up only what its last bin holds.
        bins = packed.groupBy("grp", "bin").agg(F.first("fill").alias("fill"), F.first("n_bins").alias("n_bins"), F.first("bound").alias("bound"))
        limit = F.when(F.col("n_bins") > F.col("bound"), capacity * EXCHANGED_OF_GAPS).otherwise(capacity * EXCHANGED)
        open_bins = bins.where(F.col("fill") < limit).select("grp", "bin")
        loose_rows = packed.join(open_bins, ["grp", "bin"], "left_semi")
        left = loose_rows.agg(F.sum("size"), F.countDistinct("grp", "bin")).first()
        if not left[0] or left[1] < 2:
            break
        n = max(1, math.ceil(left[0] / (capacity * group_containers)))
        again = scatter(loose_rows.select("doc_id", "item", "part", "size"), n, r).select("grp", "doc_id", "item", "part", "size").groupBy("grp").applyInPandas(pack_group(capacity), PACKED)
        again = cut(again)
        after = again.select("grp", "bin").distinct().count()
        if after >= left[1]:
            break
        settled.append(packed.join(open_bins, ["grp", "bin"], "left_anti").select("grp", "doc_id", "part", "size", "bin"))
        packed = again
        proofs = proofs.unionByName(proof(packed, r))
    settled.append(packed.select("grp", "doc_id", "part", "size", "bin"))
    out = whole
    for part in settled:
        out = out.unionByName(part)
    packed_rows = out.select("doc_id", "part", F.col("size").alias("n_tokens"), F.concat("grp", F.lit("-"), F.col("bin")).alias("container"))
    empty = items.where(F.coalesce("size", F.lit(0)) <= 0).select("doc_id", "part", F.coalesce("size", F.lit(0)).cast("bigint").alias("n_tokens"), F.lit(None).cast("string").alias("container"))
    return packed_rows.unionByName(empty).withColumn("first_token", F.col("part").cast("bigint") * capacity), proofs


def dual_feasible_bounds(capacity: int) -> list[Column]:
    """The bounds of `lower_bound` as aggregates over a column n_tokens of sizes, so that they hold for any number of items."""
    size = F.col("n_tokens")
    whole = lambda x: F.ceil(x).cast("bigint")
    out = [whole(F.sum(size) / capacity)]
    for j in range(1, THRESHOLDS + 1):
        e = capacity * j // (2 * THRESHOLDS)
        kept = F.coalesce(F.sum(F.when((size >= e) & (size <= capacity - e), size)), F.lit(0))
        out.append(F.count(F.when(size > capacity - e, 1)) + whole(kept / capacity))
    for k in range(1, STAIRS + 1):
        steps, left = F.floor(size * (k + 1) / capacity), (size * (k + 1)) % capacity
        out.append(whole(F.sum(steps * F.when(left > 0, k + 1).otherwise(k)) / (k * (k + 1))))
    return out


def report(packed: DataFrame, capacity: int = CAPACITY, certificates: DataFrame | None = None) -> DataFrame:
    """One row: containers, tokens, the bound over all sizes and the gap to it, the largest fill, the share of space left
    over, and of the first packing the groups, those certified, their bins and the sum of their bounds."""
    held = packed.where("container is not null")
    bins = held.groupBy("container").agg(F.sum("n_tokens").alias("fill"))
    sums = bins.agg(
        F.count("*").alias("n_containers"), F.coalesce(F.sum("fill"), F.lit(0)).alias("n_tokens"), F.max("fill").alias("largest_fill"),
        F.when(F.count("*") > 0, 1 - F.sum("fill") / (F.count("*") * capacity)).alias("space_left"),
    )
    bound = held.agg(F.coalesce(F.greatest(*dual_feasible_bounds(capacity)), F.lit(0)).cast("bigint").alias("bound"))
    out = sums.crossJoin(bound).withColumn("gap", F.col("n_containers") - F.col("bound"))  # one row each
    if certificates is not None:
        first = certificates.where("round_no = 0").agg(
            F.count("*").alias("n_groups"), F.count(F.when(F.col("n_bins") == F.col("bound"), 1)).alias("n_certified_groups"),
            F.coalesce(F.sum("n_bins"), F.lit(0)).alias("group_bins"), F.coalesce(F.sum("bound"), F.lit(0)).alias("group_bounds"),
        )
        out = out.crossJoin(first)
    return out
