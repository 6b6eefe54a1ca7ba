"""Column-level quality profile of loads against declared constraints (problem 4).

Declared checks are compiled into one shared aggregate scan. Its state has a fixed size per load and column, whatever
the number of rows or different values: counts of rows, nulls, values out of range, low values and misshapen values,
the two ends, a sketch of the different values, and the counts of values by a few hash buckets. States of partitions,
files or days unite by sums, minima, maxima and the union of sketches, and are kept in a folder between runs.

A value that makes up more than a given share of a load makes its bucket at least as large, so only loads with such a
bucket are counted exactly, value by value, in a second scan; all others are certain to have none. A third operator
holds the metrics of each load against control limits from the loads before it.

Defined results: a load without rows gives nothing; a column of nulls only has n_values 0 and null shares; NaN counts
as a value outside every range; repeated rows count each; ties for the most frequent value do not matter, its count
does. Null load ids form a load of their own. Columns of the input that are not profiled are not read. Empty tables
give empty tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ferrolex.session import cut
from ferrolex.sources.tables import small_rows

#: Shares at which a check reports (fixed by the statement of the problem), and the least number of values it needs.
RANGE_SHARE, SHAPE_SHARE, REPEAT_SHARE, SHIFT_LOW, SHIFT_HIGH, LEAST_VALUES = 0.05, 0.05, 0.3, 0.2, 0.8, 20
#: More declared columns than this are refused.
MAX_COLUMNS = 2000
#: Hash buckets of the values of a numeric column, and the size (log2 of its registers) of the sketch of different values.
BUCKETS, SKETCH = 16, 12
#: Buckets in doubt are broadcast up to this many rows (of some 40 bytes), beyond they are joined by a shuffle.
MAX_DOUBT = 100_000
#: Ranges of load order in which the history of a metric is summed up.
SPANS = 4096

KEYS = ("load_id", "column_name", "is_number")
COUNTS = ("n", "n_null", "n_out", "n_low", "n_odd", *(f"b{k}" for k in range(BUCKETS)))
NUMBERS = ("double", "float", "int", "bigint", "smallint", "tinyint")


def declared(profile: DataFrame) -> list:
    rows = small_rows(profile.select("column_name", "null_limit", "low_value", "high_value", "mid_value", "shape"), MAX_COLUMNS, "the column profile")
    return [r for r in rows if r.column_name is not None]


def _cells(records: DataFrame, profile: DataFrame, load: str, at: str | None) -> DataFrame:
    """One row per record and profiled column: load_id, at, column_name, is_number, number, text and the flags of the checks."""
    types = dict(records.dtypes)
    cells = []
    for r in declared(profile):
        if r.column_name not in types:
            continue
        c = F.col(f"`{r.column_name}`")
        numeric = types[r.column_name] in NUMBERS or types[r.column_name].startswith("decimal")
        number = c.cast("double") + F.lit(0.0) if numeric else F.lit(None).cast("double")
        cells.append(
            F.struct(
                F.lit(r.column_name).alias("column_name"),
                F.lit(numeric).alias("is_number"),
                number.alias("number"),
                F.lit(None).cast("string").alias("text") if numeric else c.cast("string").alias("text"),
                _flag((number < r.low_value) if r.low_value is not None else None, (number > r.high_value) if r.high_value is not None else None).alias("out"),
                _flag(number <= r.mid_value if r.mid_value is not None else None).alias("low"),
                _flag(~c.cast("string").rlike(r.shape) if r.shape is not None and not numeric else None).alias("odd"),
            )
        )
    if not cells:
        raise ValueError("no profiled column is in the table")
    time = F.col(at) if at and at in types else F.lit(None).cast("timestamp")
    return records.select(F.col(load).alias("load_id"), time.alias("at"), F.explode(F.array(*cells)).alias("c")).select("load_id", "at", "c.*")


def _flag(*conditions: Column | None) -> Column:
    met = [c for c in conditions if c is not None]
    if not met:
        return F.lit(False)
    either = met[0]
    for c in met[1:]:
        either = either | c
    return F.coalesce(either, F.lit(False))


def _bucket() -> Column:
    return F.pmod(F.xxhash64("number"), F.lit(BUCKETS))


def load_states(records: DataFrame, profile: DataFrame, load: str = "load_id", at: str | None = "loaded_at") -> DataFrame:
    """The mergeable state, one row of fixed size per load and profiled column.

    KEYS, COUNTS (b0.. are the values per hash bucket), low, high, first_at and `seen`, a sketch of the different values.
    Counting before the shuffle keeps a load that holds a third of all rows cheap.
    """
    cells = _cells(records, profile, load, at)
    value = F.coalesce(F.col("number").cast("string"), F.col("text"))
    count = lambda condition: F.count(F.when(condition, 1))
    bucket = _bucket()
    return cells.groupBy(*KEYS).agg(
        F.count("*").alias("n"), count(F.col("number").isNull() & F.col("text").isNull()).alias("n_null"),
        count(F.col("out")).alias("n_out"), count(F.col("low")).alias("n_low"), count(F.col("odd")).alias("n_odd"),
        *[count(F.col("number").isNotNull() & (bucket == k)).alias(f"b{k}") for k in range(BUCKETS)],
        F.min("number").alias("low"), F.max("number").alias("high"), F.min("at").alias("first_at"), F.hll_sketch_agg(value, F.lit(SKETCH)).alias("seen"),
    )


def merge_states(states: DataFrame, more: DataFrame | None = None) -> DataFrame:
    """Unite the states of several parts of the data, such as old and new days, into one row per load and column."""
    every = states if more is None else states.unionByName(more)
    return every.groupBy(*KEYS).agg(
        *[F.sum(c).alias(c) for c in COUNTS], F.min("low").alias("low"), F.max("high").alias("high"), F.min("first_at").alias("first_at"),
        F.hll_union_agg("seen").alias("seen"),
    )


def keep_states(states: DataFrame, folder: str) -> None:
    """Add the states of newly arrived rows to a folder of states; late rows of an old load are a further row of it."""
    states.write.mode("append").parquet(folder)


def kept_states(spark: SparkSession, folder: str) -> DataFrame:
    """All states of a folder, united: the profile of everything that has arrived, without a look at the old rows."""
    return merge_states(spark.read.parquet(folder))


def load_metrics(states: DataFrame, tops: DataFrame | None = None) -> DataFrame:
    """Metrics per load and column: row and value counts, different values, ends and shares.

    top_share is the share of the most frequent number where it is above REPEAT_SHARE, else null; it needs `tops`.
    n_distinct is exact for up to some 380 different values and within about 2 % beyond.
    """
    values = F.col("n") - F.col("n_null")
    share = lambda c: F.when(values > 0, F.col(c) / values)
    m = states
    if tops is not None:
        m = m.alias("m").join(tops.alias("t"), F.col("m.load_id").eqNullSafe(F.col("t.load_id")) & (F.col("m.column_name") == F.col("t.column_name")), "left")
        m = m.select("m.*", "n_top")
    else:
        m = m.withColumn("n_top", F.lit(None).cast("bigint"))
    top = F.when(F.col("is_number"), share("n_top"))
    return m.select(
        *KEYS, "first_at", F.col("n").alias("n_rows"), values.alias("n_values"), F.hll_sketch_estimate("seen").alias("n_distinct"), "low", "high",
        (F.col("n_null") / F.col("n")).alias("null_share"), share("n_out").alias("out_share"), share("n_low").alias("low_share"),
        share("n_odd").alias("odd_share"), F.when(top > REPEAT_SHARE, top).alias("top_share"),
    )


def frequent_values(records: DataFrame, profile: DataFrame, states: DataFrame, load: str = "load_id") -> DataFrame:
    """load_id, column_name, n_top: the exact count of the most frequent number wherever one may exceed REPEAT_SHARE.

    Only values of buckets that large are counted; the others cannot hold such a value. `states` is a table already written.
    """
    values = F.col("n") - F.col("n_null")
    large = F.filter(F.array(*[F.struct(F.lit(k).alias("bucket"), F.col(f"b{k}").alias("size")) for k in range(BUCKETS)]), lambda b: b["size"] > REPEAT_SHARE * values)
    doubt = states.where("is_number").select("load_id", "column_name", F.explode(large).alias("b")).select("load_id", "column_name", "b.bucket")
    cells = _cells(records, profile, load, None).where("number is not null").select("load_id", "column_name", "number", _bucket().cast("int").alias("bucket"))
    c, d = cells.alias("c"), (F.broadcast(doubt) if doubt.count() <= MAX_DOUBT else doubt).alias("d")
    same = F.col("c.load_id").eqNullSafe(F.col("d.load_id")) & (F.col("c.column_name") == F.col("d.column_name")) & (F.col("c.bucket") == F.col("d.bucket"))
    counts = c.join(d, same, "left_semi").groupBy("load_id", "column_name", "number").agg(F.count("*").alias("k"))
    return counts.groupBy("load_id", "column_name").agg(F.max("k").alias("n_top"))


def metrics(records: DataFrame, profile: DataFrame, load: str = "load_id", at: str | None = "loaded_at") -> DataFrame:
    """The metrics of all loads: states, written once, and the exact counts of what they leave in doubt."""
    states = cut(load_states(records, profile, load, at))
    return load_metrics(states, frequent_values(records, profile, states, load))


def findings(records: DataFrame, profile: DataFrame, load: str = "load_id") -> DataFrame:
    """load_id, column_name, finding: where a load departs from its profile."""
    states = cut(load_states(records, profile, load, None).drop("seen"))  # no check needs the sketch
    m = load_metrics(states.withColumn("seen", F.lit(None).cast("binary")), frequent_values(records, profile, states, load))
    limits = F.broadcast(profile.select("column_name", "null_limit", "low_value", "high_value", "mid_value", "shape"))  # declared(): MAX_COLUMNS rows
    m = m.join(limits, "column_name", "inner").drop("low", "high")
    enough = F.col("n_values") >= LEAST_VALUES
    number = enough & F.col("is_number")
    ranged = F.col("low_value").isNotNull() | F.col("high_value").isNotNull()
    tests = {
        "nulls": F.col("null_share") > F.col("null_limit"),
        "range": number & ranged & (F.col("out_share") > RANGE_SHARE),
        "shift": number & F.col("mid_value").isNotNull() & ((F.col("low_share") < SHIFT_LOW) | (F.col("low_share") > SHIFT_HIGH)),
        "repeat": number & (F.col("top_share") > REPEAT_SHARE),
        "shape": enough & F.col("shape").isNotNull() & ~F.col("is_number") & (F.col("odd_share") > SHAPE_SHARE),
    }
    found = F.array(*[F.when(test, F.lit(name)) for name, test in tests.items()])
    return m.select("load_id", "column_name", F.explode(F.array_compact(found)).alias("finding"))


#: Metrics that are held against their history.
WATCHED = ("null_share", "out_share", "low_share", "odd_share")


def control_limits(metrics: DataFrame, sigmas: float = 3.0, least_loads: int = 8) -> DataFrame:
    """Loads whose metric lies outside mean ± sigmas * deviation of the loads before it, of which there must be least_loads.

    Loads are in the order of their first arrival and id. The moments of the earlier loads are running sums within
    SPANS ranges of that order plus the sums of the ranges before, so that no task orders the whole history of a column.
    A metric that never varied reports any load that departs from it.
    """
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("x")) for c in WATCHED]))
    long = metrics.select("load_id", "first_at", "column_name", cells.alias("m")).select("load_id", "first_at", "column_name", "m.*").where("x is not null")
    order = F.coalesce(F.unix_micros(F.col("first_at").cast("timestamp")).cast("double"), F.col("load_id").cast("double"), F.lit(0.0))
    ends = long.agg(F.min(order).alias("lo"), F.max(order).alias("hi")).first()
    lo, hi = (ends.lo or 0.0, ends.hi or 0.0)
    long = long.withColumn("span", F.floor((order - F.lit(lo)) / F.lit(max(hi - lo, 1.0)) * SPANS))
    keys = ["column_name", "metric"]
    moments = {"n": F.lit(1), "s": F.col("x"), "q": F.col("x") * F.col("x")}
    within = W.partitionBy(*keys, "span").orderBy("first_at", "load_id").rowsBetween(W.unboundedPreceding, -1)
    inner = long.withColumns({f"in_{m}": F.sum(c).over(within) for m, c in moments.items()})
    sums = long.groupBy(*keys, "span").agg(*[F.sum(c).alias(m) for m, c in moments.items()])
    before = W.partitionBy(*keys).orderBy("span").rowsBetween(W.unboundedPreceding, -1)
    earlier = sums.select(*keys, "span", *[F.sum(m).over(before).alias(f"to_{m}") for m in moments])
    j = inner.join(earlier, [*keys, "span"])
    zero = lambda c: F.coalesce(c, F.lit(0))
    n, s, q = (zero(f"in_{m}") + zero(f"to_{m}") for m in moments)
    j = j.select("load_id", *keys, "x", n.alias("n"), s.alias("s"), q.alias("q")).where(F.col("n") >= least_loads)
    mean = F.col("s") / F.col("n")
    variance = F.greatest(F.lit(0.0), F.col("q") / F.col("n") - mean * mean)
    j = j.withColumns({"expected": mean, "deviation": F.sqrt(variance * F.col("n") / (F.col("n") - 1))})
    return j.where(F.abs(F.col("x") - F.col("expected")) > sigmas * F.col("deviation") + 1e-9).select(
        "load_id", "column_name", "metric", F.col("x").alias("value"), "expected", "deviation"
    )
