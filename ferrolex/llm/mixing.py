"""Sources mixed to target weights, with capped repeats (problem 8).

The texts of each listed source are laid end to end in a fixed order and cut into blocks of a fixed number of tokens.
For each output shard source counts are drawn from a multinomial, conditioned on the planned totals; slot i of a source
is block p(i) of its current pass, where p is a pseudorandom permutation of the block numbers, and slots are joined
with blocks on that number. The draw splits: the slots of a run of shards are divided between its halves by a
multivariate hypergeometric draw seeded by the run, which is that conditioned multinomial, so each task draws the counts
and first slots of its own shards from the seed and nothing is drawn on the driver.

The size of the mix is the largest at which the sources together miss at most `tolerance` of it: a source that is too
small gives all its passes and holds a lower share, an absent one gives nothing; the shares of the others stay in
proportion. The sources that run out first do not bear on the size where the mix without them in the reckoning is more than
1 + GAIN * w times as large, w being their share together; they give what they have. A text that occurs
under several ids of listed sources is taken once, under the lowest of these ids and with that id's source.

Defined results: texts of unlisted or null sources, null and empty texts are left out; a target without share or
passes gives nothing; of a source listed twice the row with the larger share counts. Without any usable text both
results are empty apart from the report's rows. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ferrolex.llm.tokens import TOKENIZERS, VOCABULARY, token_count
from ferrolex.session import cut, spread
from ferrolex.sources.tables import small_rows

BLOCK = 512
#: Share of the mix by which small sources may fall short together; texts per bucket when offsets are summed up;
#: slots of a shard, and shards that a task draws.
TOLERANCE, BUCKET, SHARD_SLOTS, TASK_SHARDS = 0.01, 20_000, 256, 2_000
#: Above this many slots a split is drawn from the normal distribution with the same mean and variance.
EXACT_SLOTS = 500_000_000
#: How much larger, per share left out of the reckoning of the size, the mix must become by it.
GAIN = 50
#: More sources than this are refused.
MAX_SOURCES = 10_000
SEED = 20_240_501


def plan(available: dict[str, int], targets: dict[str, tuple[float, int]], tolerance: float = TOLERANCE, total: float | None = None) -> dict[str, float]:
    """Tokens that each source gives: its share of the size of the mix, at most its tokens times its passes."""
    usable = {s: (share, available[s] * passes) for s, (share, passes) in targets.items() if share > 0 and passes > 0 and available.get(s, 0) > 0}
    weight = sum(share for share, _ in usable.values())
    if not usable:
        return {}
    if total is None:
        total = size_of_mix([(share / weight, float(cap)) for share, cap in usable.values()], tolerance)
    return {s: min(share / weight * total, float(cap)) for s, (share, cap) in usable.items()}


def size_of_mix(sources: list[tuple[float, float]], tolerance: float) -> float:
    """The size for (share, most tokens) of each source.

    With the first k sources to run out left aside, the size is the largest at which the others miss at most `tolerance`
    of their part; among all k the one with the largest size / (1 + GAIN * share left aside) counts.
    """
    ordered = sorted(sources, key=lambda x: x[1] / x[0])
    ends = [cap / share for share, cap in ordered]
    share = np.concatenate([[0.0], np.cumsum([x[0] for x in ordered])])
    most = np.concatenate([[0.0], np.cumsum([x[1] for x in ordered])])
    best, size = -1.0, 0.0
    for k in range(len(ordered)):
        allowed = tolerance * (share[-1] - share[k])
        low, high = k, len(ordered)  # the first source at whose end the sources from k on miss too much
        while low < high:
            m = (low + high) // 2
            over = (share[m] - share[k] - allowed) * ends[m] > most[m] - most[k]
            low, high = (low, m) if over else (m + 1, high)
        t = (most[low] - most[k]) / max(1e-9, share[low] - share[k] - allowed)
        if (worth := t / (1 + GAIN * share[k])) > best:
            best, size = worth, float(t)
    return size


def split(counts: np.ndarray, take: int, rng: np.random.Generator) -> np.ndarray:
    """How many of `take` slots drawn from counts belong to each source: one draw without replacement."""
    out = np.zeros_like(counts)
    left, rest = int(counts.sum()), int(take)
    for k, own in enumerate(counts.tolist()):
        if rest == 0:
            break
        others = left - own
        if left <= EXACT_SLOTS:
            n = int(rng.hypergeometric(own, others, rest)) if own and others else min(own, rest)
        else:
            mean = rest * (own / left)
            spread = max(0.0, mean * (1 - own / left) * (1 - rest / left))
            n = round(mean + spread**0.5 * rng.standard_normal())
        n = min(max(n, rest - others, 0), own, rest)
        out[k] = n
        left, rest = others, rest - n
    return out


def draw(counts: np.ndarray, slots: int, first: int, last: int, seed: int = SEED) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """shard, counts per source and first slot per source of the shards first to last - 1.

    A run of shards is halved until it is one shard; only the runs that hold wanted shards are visited.
    """
    total = int(counts.sum())
    shards = -(-total // slots)
    todo = [(0, shards, counts.astype(np.int64), np.zeros(len(counts), dtype=np.int64))]
    while todo:
        low, high, own, start = todo.pop()
        if low >= high or high <= first or low >= last:
            continue
        if high - low == 1:
            yield low, own, start
            continue
        middle = (low + high) // 2
        left = split(own, min(middle * slots, total) - low * slots, np.random.default_rng([seed, low, high]))
        todo.append((middle, high, own - left, start + left))
        todo.append((low, middle, left, start))


def mixed_bits(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing function."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Element-wise permutation of 0..size-1 chosen by key: a Feistel network on the next power of four, walked along
    its cycles until the value is below size."""
    bits = np.ceil(np.log2(np.maximum(size, 2)) / 2).astype(np.uint64)
    mask = (np.uint64(1) << bits) - np.uint64(1)
    x, limit = index.astype(np.uint64), size.astype(np.uint64)
    key = key.astype(np.uint64)
    todo = np.ones(len(x), dtype=bool)
    with np.errstate(over="ignore"):
        while todo.any():
            left, right = x[todo] >> bits[todo], x[todo] & mask[todo]
            for turn in range(4):
                left, right = right, left ^ (mixed_bits(right + key[todo] + np.uint64(0x9E3779B97F4A7C15) * np.uint64(turn + 1)) & mask[todo])
            x[todo] = (left << bits[todo]) | right
            todo[todo] = x[todo] >= limit[todo]
    return x.astype(np.int64)


def slots_of(names: list[str], counts: np.ndarray, blocks: np.ndarray, keys: np.ndarray, seed: int):
    """The function for mapInPandas over runs of shards (first, last): shard, source, pass_no, block of every slot."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first, last in zip(batch["first"], batch["last"]):
                shard, source, index = [], [], []
                for number, n, start in draw(counts, SHARD_SLOTS, int(first), int(last), seed):
                    held = np.flatnonzero(n)
                    shard.append(np.full(int(n.sum()), number))
                    source.append(np.repeat(held, n[held]))
                    index.append(np.concatenate([np.arange(start[k], start[k] + n[k]) for k in held]))
                if not shard:
                    continue
                s, i = np.concatenate(source), np.concatenate(index)
                turn, of = i // blocks[s], blocks[s]
                with np.errstate(over="ignore"):
                    key = keys[s].astype(np.uint64) + turn.astype(np.uint64) * np.uint64(1_000_003)
                yield pd.DataFrame({"shard": np.concatenate(shard), "source": np.array(names, dtype=object)[s], "pass_no": (turn + 1).astype("int32"), "block": permuted(i % of, of, key)})

    return run


def source_texts(docs: DataFrame, sources: list[str], folder: str, vocabulary: str) -> DataFrame:
    """doc_id, source, n_tokens: each different text of the listed sources once."""
    listed = spread(docs.select("doc_id", "source", "text").where(F.col("source").isin(sources) & F.col("text").isNotNull() & (F.length("text") > 0)))
    sized = listed.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "source", F.length("text").alias("n"), F.md5("text").alias("h"),
        token_count(F.col("text"), folder, vocabulary).alias("n_tokens"),
    )
    one = sized.groupBy("h", "n").agg(F.min(F.struct("doc_id", "source", "n_tokens")).alias("d"))
    return one.select("d.*").where(F.col("n_tokens") > 0)


def block_pieces(texts: DataFrame, block: int, n_texts: int) -> DataFrame:
    """source, block, doc_id, first_token, n_tokens: which stretch of which text lies in which block of its source.

    Offsets are running sums within buckets of about BUCKET texts plus the sums of the buckets before, so that no task
    sees a whole source.
    """
    buckets = max(1, -(-n_texts // BUCKET))
    t = texts.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)))
    inner = t.withColumn("before", F.sum("n_tokens").over(W.partitionBy("source", "bucket").orderBy("doc_id").rowsBetween(W.unboundedPreceding, -1)))
    sums = t.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("s"))
    base = sums.withColumn("base", F.sum("s").over(W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1))).select("source", "bucket", "base")
    o = inner.join(base, ["source", "bucket"]).withColumn("offset", F.coalesce("before", F.lit(0)) + F.coalesce("base", F.lit(0)))
    last = F.col("offset") + F.col("n_tokens")
    parts = o.select("source", "doc_id", "offset", last.alias("end"), F.explode(F.sequence(F.floor(F.col("offset") / block), F.floor((last - 1) / block))).alias("block"))
    from_ = F.greatest(F.col("offset"), F.col("block") * block)
    to = F.least(F.col("end"), (F.col("block") + 1) * block)
    return parts.select("source", "block", "doc_id", (from_ - F.col("offset")).alias("first_token"), (to - from_).alias("n_tokens"))


def mix(docs: DataFrame, targets: DataFrame, block: int = BLOCK, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY, tolerance: float = TOLERANCE, total: float | None = None, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(selection, shares).

    selection: shard, source, pass_no, block, doc_id, first_token, n_tokens. shares: source, target_share,
    actual_share, tokens_available, tokens_taken, max_repeats, most_uses (of one text).
    """
    spark = docs.sparkSession
    rows = small_rows(targets.select("source", "target_share", "max_repeats"), MAX_SOURCES, "the table of targets")
    wanted: dict[str, tuple[float, int]] = {}
    for r in sorted((r for r in rows if r.source is not None), key=lambda r: -(r.target_share or 0)):
        wanted.setdefault(r.source, (float(r.target_share or 0), int(r.max_repeats or 0)))
    texts = cut(source_texts(docs, list(wanted), folder, vocabulary))
    sums = {r.source: (r.n, r.t) for r in texts.groupBy("source").agg(F.count("*").alias("n"), F.sum("n_tokens").alias("t")).collect()}
    tokens = {s: t for s, (_, t) in sums.items()}
    given = plan(tokens, wanted, tolerance, total)
    n_blocks = {s: -(-tokens[s] // block) for s in given}
    counts = {s: min(round(given[s] / (tokens[s] / n_blocks[s])), n_blocks[s] * wanted[s][1]) for s in given}
    named = sorted(s for s, n in counts.items() if n > 0)
    keys = {s: int(np.random.default_rng([seed, k]).integers(1 << 62)) for k, s in enumerate(sorted(wanted))}
    column = lambda of: np.array([of[s] for s in named], dtype=np.int64)
    shards = -(-sum(counts[s] for s in named) // SHARD_SLOTS)
    tasks = -(-shards // TASK_SHARDS)
    runs = spark.range(0, tasks, 1, max(1, tasks)).select((F.col("id") * TASK_SHARDS).alias("first"), F.least((F.col("id") + 1) * TASK_SHARDS, F.lit(shards)).alias("last"))
    slots = runs.mapInPandas(slots_of(named, column(counts), column(n_blocks), column(keys), seed), "shard bigint, source string, pass_no int, block bigint")
    pieces = block_pieces(texts, block, sum(n for n, _ in sums.values()) or 1)
    selection = slots.join(pieces, ["source", "block"]).select("shard", "source", "pass_no", "block", "doc_id", "first_token", "n_tokens")
    return selection, _shares(spark, selection, wanted, tokens)


def _shares(spark: SparkSession, selection: DataFrame, wanted: dict[str, tuple[float, int]], tokens: dict[str, int]) -> DataFrame:
    uses = selection.groupBy("source", "doc_id", "first_token").agg(F.count("*").alias("u"), F.sum("n_tokens").alias("t"))
    taken = uses.groupBy("source").agg(F.sum("t").alias("tokens_taken"), F.max("u").alias("most_uses"))
    rows = [(s, share, passes, int(tokens.get(s, 0))) for s, (share, passes) in wanted.items()]
    listed = spark.createDataFrame(rows, "source string, target_share double, max_repeats int, tokens_available bigint")
    t = listed.join(taken, "source", "left").withColumn("tokens_taken", F.coalesce("tokens_taken", F.lit(0)))
    whole = W.partitionBy(F.lit(1))  # over the listed sources, MAX_SOURCES rows at most
    return t.withColumn("whole", F.sum("tokens_taken").over(whole)).select(
        "source", "target_share", F.when(F.coalesce("whole", F.lit(0)) > 0, F.col("tokens_taken") / F.col("whole")).otherwise(0.0).alias("actual_share"),
        "tokens_available", "tokens_taken", "max_repeats", F.coalesce("most_uses", F.lit(0)).alias("most_uses"),
    )
