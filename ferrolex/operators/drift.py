"""Schemas that drift between the files of a feed: a report of changes and one table with fixed columns (problem 2).

Each file is profiled per key in one aggregate of fixed size: JSON types, numbers of values and a sketch of the values
(min-hashes, moments of numbers and of lengths). Records that two consecutive files have in common tell how often two
keys hold the same content; all of them count, their counts are added up before the shuffle. Keys of a file and of the
file before it are matched by bipartite matching on this agreement, with name and type similarity as lesser weights;
keys without common records are compared by their sketches. Unmatched keys were added or removed. Lineages of keys
over renames, found by pointer doubling, then name one fixed column each.

Defined results: of a file listed several times one listing counts; records that are not JSON objects count for nothing; a file without readable records has no keys;
files without feed or order number are compared with nothing; of files with one order number the lower file_id comes
first; a type changes only where both files have non-null values. Of a record repeated within a file one version counts
for agreement, the smallest; keys and types use all rows. A file without the record key is keyed by its string member
with the most different values, if no other member has many more.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ferrolex.functions.matching import best_matching
from ferrolex.session import cut, written

#: Least share of agreement for content to count as going on, of the common records in which the rarer of two keys has a
#: value; least number of agreeing records where they are under this share of all; the bonus of an unchanged name.
LEAST_COUNT = 2
LEAST_OVERLAP, SAME_NAME, NAME_WEIGHT, TYPE_WEIGHT = 0.3, 0.5, 0.1, 0.05
#: Without common values: least likeness of names alone, and least likeness of the value sketches (of keys with at least
#: LEAST_VALUES values) with that of the names beside it.
NAME_ALONE, SKETCH_ALONE, SKETCH_NAME, LEAST_VALUES = 0.8, 0.5, 0.3, 5
#: Min-hashes of a value sketch.
MINHASHES = 8
#: A member stands in for the record key if it has at least this share of the different values of any member.
NEARLY_ALL = 0.8
BUCKET = 1024
#: What is known per file (one row of some 40 bytes) is broadcast up to this many files, beyond the planner chooses.
MAX_FILES = 200_000
# JSON types by their code.
KINDS = ("string", "number", "boolean", "object", "array")

# The columns of the unified table and their types, under their declared names.
UNIFIED = {
    "record_id": "string", "material_name": "string", "source_DOI": "string", "VEC": "double", "delta_H_mix_kJ_mol": "double",
    "delta_S_mix_J_mol_K": "double", "composition_string": "string", "hardness_HV": "double", "delta_atomic_size": "double",
    "specimen_form": "string",
}


def listed(files: DataFrame) -> DataFrame:
    """file_id, feed_name, seq_no: each file once; of several listings the one with the lowest order number counts."""
    place = F.min(F.struct("seq_no", "feed_name"))
    return files.where("file_id is not null").groupBy("file_id").agg(place.alias("p")).select("file_id", "p.feed_name", "p.seq_no")


def previous_files(files: DataFrame) -> DataFrame:
    """file_id, feed_name, seq_no, prev_id: each file with the one before it in its feed.

    Found in buckets of order numbers, then between buckets, so that no feed is sorted by one task as a whole.
    """
    placed = listed(files.where("feed_name is not null and seq_no is not null"))
    f = placed.select("file_id", "feed_name", "seq_no", F.floor(F.col("seq_no") / BUCKET).alias("b"))
    order = F.struct("seq_no", "file_id")
    inner = f.withColumn("p", F.lag("file_id").over(W.partitionBy("feed_name", "b").orderBy("seq_no", "file_id")))
    ends = f.groupBy("feed_name", "b").agg(F.max(order).getField("file_id").alias("end_id"))
    before = ends.select("feed_name", "b", F.lag("end_id").over(W.partitionBy("feed_name").orderBy("b")).alias("end_before"))
    return inner.join(before, ["feed_name", "b"]).select(
        "file_id", "feed_name", "seq_no", F.coalesce("p", "end_before").alias("prev_id")
    )


def cells(records: DataFrame) -> DataFrame:
    """file_id and m: array<struct<key, kind, mark, number, size>> of the members of each readable record, parsed once.

    kind is the place in KINDS, null for a JSON null; `mark` is the fingerprint of the content, `number` its value where it
    is one, `size` the length of its text. Fingerprints have 32 bits: two different contents of one record agree by chance
    once in four billion comparisons.
    """
    entries = F.map_entries(F.try_variant_get(F.try_parse_json("payload"), "$", "map<string,variant>"))
    rows = records.select("file_id", F.explode(F.array(F.struct(entries.alias("m")))).alias("p")).where("p.m is not null")

    # Each step binds what it computes, so that nothing is computed twice for a member.
    def typed(e: Column) -> Column:
        return F.struct(e["key"].alias("key"), e["value"].alias("v"), F.schema_of_variant(e["value"]).alias("s"))

    def coded(e: Column) -> Column:
        s = e["s"]
        code = F.when(s == "STRING", 0).when(s == "BOOLEAN", 2).when(s.startswith("OBJECT"), 3).when(s.startswith("ARRAY"), 4).when(s != "VOID", 1)
        return F.struct(e["key"].alias("key"), e["v"].alias("v"), code.cast("tinyint").alias("kind"))

    def valued(e: Column) -> Column:
        number = F.when(e["kind"] == 1, F.try_variant_get(e["v"], "$", "double"))
        text = F.when(e["kind"] <= 2, F.try_variant_get(e["v"], "$", "string")).when(e["kind"] >= 3, plain_text(F.to_json(e["v"])))
        return F.struct(e["key"].alias("key"), e["kind"].alias("kind"), number.alias("number"), text.alias("text"))

    def numbered(e: Column) -> Column:
        number = F.coalesce(e["number"], number_in(e["text"]))
        return F.struct(e["key"].alias("key"), e["kind"].alias("kind"), number.alias("number"), e["text"].alias("text"))

    def marked(e: Column) -> Column:
        content = F.coalesce(e["number"].cast("string"), F.when(e["number"].isNull(), words_of(e["text"])))
        mark = F.when(e["kind"].isNotNull(), F.hash(content))
        return F.struct(e["key"].alias("key"), e["kind"].alias("kind"), mark.alias("mark"), e["number"].alias("number"), F.length(e["text"]).alias("size"))

    m = F.col("p.m")
    for step in (typed, coded, valued, numbered, marked):
        m = F.transform(m, step)
    return rows.select("file_id", m.alias("m"))


def plain_text(j: Column) -> Column:
    """A JSON value without its wrapping: an object with one member, named in lower case, is unwrapped; marks are dropped."""
    inner = F.regexp_replace(j, r'^\{"[a-z][A-Za-z_]*":([^,:{}\[\]]*|"(?:[^"\\]|\\.)*")\}$', "$1")
    bare = F.regexp_replace(inner, r'^"(.*)"$', "$1")
    return F.when(bare.rlike(r"^[\[{]"), F.regexp_replace(bare, r'[\[\]{}",:\s]', "")).otherwise(bare)


def number_in(text: Column) -> Column:
    """The number that a text is as a whole, null for other texts."""
    return F.when(text.rlike(r"^\s*[-+.]?[0-9]"), text.try_cast("double"))


def words_of(text: Column) -> Column:
    """The words, numbers and marks of a text in sorted order: equal for one content in several forms."""
    return F.array_join(F.sort_array(F.regexp_extract_all(text, F.lit(r"([A-Za-z]+|[0-9]+(?:\.[0-9]+)?|[^\sA-Za-z0-9\"\[\]{},:]+)"), F.lit(1))), " ")


def key_profiles(rows: DataFrame) -> DataFrame:
    """file_id, key_name, key_hash, types (bits), n_values, n_distinct and the value sketch; over all rows, states merge."""
    c = rows.select("file_id", F.explode("m").alias("e")).select("file_id", F.col("e.key").alias("key_name"), "e.kind", "e.mark", "e.number", "e.size")
    moments = {"n_numbers": F.count("number"), "mean": F.avg("number"), "spread": F.stddev_pop("number"), "size": F.avg("size"), "size_spread": F.stddev_pop("size")}
    return c.groupBy("file_id", "key_name").agg(
        F.coalesce(F.bit_or(F.expr("shiftleft(1, kind)")), F.lit(0)).alias("types"), F.count("kind").alias("n_values"),
        F.approx_count_distinct("mark", 0.08).alias("n_distinct"), *[v.alias(k) for k, v in moments.items()],
        F.array(*[F.min(F.when(F.col("mark").isNotNull(), F.hash("mark", F.lit(j)))) for j in range(MINHASHES)]).alias("hashes"),
    ).withColumn("key_hash", F.hash("key_name"))


def record_keys(profiles: DataFrame, record_key: str) -> DataFrame:
    """file_id, id_hash: the member that tells a file's records apart."""
    named = F.regexp_replace(F.lower("key_name"), "_", "") == record_key.replace("_", "").lower()
    fit = F.when(named | (F.col("types") == 1), F.struct(named.alias("named"), F.col("n_distinct"), F.col("key_hash")))
    best = profiles.groupBy("file_id").agg(F.max(fit).alias("best"), F.max("n_distinct").alias("most"))
    return best.where(F.col("best.named") | (F.col("best.n_distinct") >= NEARLY_ALL * F.col("most"))).select("file_id", F.col("best.key_hash").alias("id_hash"))


def overlaps(rows: DataFrame, links: DataFrame, keys: DataFrame, few_files: bool = False) -> DataFrame:
    """file_id, prev_hash, key_hash, n_same: common records of a file and the one before in which two keys hold the same.

    A row with only one of the keys counts the values of this key in the common records, in the file or the one before.
    Each record goes once to its own file and once to the next; counts are added up within the tasks before they move.
    """
    after = links.where("prev_id is not null").select(F.col("prev_id").alias("file_id"), F.col("file_id").alias("next_id"))
    of_file = links.select("file_id", F.col("prev_id").isNotNull().alias("has_prev")).join(after, "file_id", "left").join(keys, "file_id")
    of_file = F.broadcast(of_file) if few_files else of_file
    full = F.filter("m", lambda e: e["mark"].isNotNull())
    r = rows.join(of_file, "file_id").select("file_id", "has_prev", "next_id", "id_hash", full.alias("m"))
    r = r.select("file_id", "has_prev", "next_id", "id_hash", F.transform("m", lambda e: F.hash(e["key"])).alias("k"), F.transform("m", lambda e: e["mark"]).alias("v"))
    rec = F.try_element_at("v", F.nullif(F.array_position("k", F.col("id_hash")).cast("int"), F.lit(0)))
    sides = F.array(F.struct(F.when(F.col("has_prev"), F.col("file_id")).alias("file_id"), F.lit(True).alias("now")), F.struct(F.col("next_id").alias("file_id"), F.lit(False).alias("now")))
    r = r.select(rec.alias("rec"), "k", "v", F.explode(sides).alias("s")).where("rec is not null and s.file_id is not null")
    r = r.select("s.file_id", "rec", "s.now", F.struct("k", "v").alias("x"))
    side = lambda now: F.min(F.when(F.col("now") == now, F.col("x")))
    both = r.groupBy("file_id", "rec").agg(side(True).alias("n"), side(False).alias("t")).where("n is not null and t is not null")
    pair = lambda a, b: F.struct(a.alias("prev_hash"), b.alias("key_hash"))
    none = F.lit(None).cast("int")
    then = F.arrays_zip(F.col("t.k").alias("k"), F.col("t.v").alias("v"))
    same = F.flatten(F.transform(F.col("n.v"), lambda v, i: F.transform(F.filter(then, lambda p: p["v"] == v), lambda p: pair(p["k"], F.get(F.col("n.k"), i)))))
    alone = F.concat(F.transform(F.col("t.k"), lambda k: pair(k, none)), F.transform(F.col("n.k"), lambda k: pair(none, k)))
    each = both.select("file_id", F.explode(F.concat(same, alone)).alias("p"))
    return each.groupBy("file_id", "p.prev_hash", "p.key_hash").agg(F.count("*").alias("n_same"))


@lru_cache(maxsize=100_000)
def likeness(a: str, b: str) -> float:
    x, y = (k.replace("_", "").lower() for k in (a, b))
    return 1.0 if x == y else SequenceMatcher(None, x, y).ratio()


def closeness(m: float | None, s: float | None, n: float | None, t: float | None) -> float:
    """Likeness of two distributions from mean and spread: 1 where they agree, towards 0 as the means part or spreads differ."""
    if m is None or n is None:
        return 1.0 if m is None and n is None else 0.0
    s, t = s or 0.0, t or 0.0
    wide = max(s, t, 1e-9 * max(abs(m), abs(n)), 1e-12)
    return max(0.0, 1 - abs(m - n) / (2 * wide)) * (min(s, t) + 1e-12) / (max(s, t) + 1e-12)


def sketch_likeness(a: dict, b: dict) -> float:
    """How alike the values of two keys are by their sketches: shared values, or else distributions of one kind."""
    if min(a["n_values"], b["n_values"]) < LEAST_VALUES:
        return 0.0
    shared = sum(x == y for x, y in zip(a["hashes"], b["hashes"]) if x is not None) / MINHASHES
    sizes = closeness(a["size"], a["size_spread"], b["size"], b["size_spread"])
    numbers = min(a["n_numbers"] / a["n_values"], b["n_numbers"] / b["n_values"])
    alike = closeness(a["mean"], a["spread"], b["mean"], b["spread"]) if numbers > 0.5 else 0.5 * sizes
    return max(shared, alike)


def match_keys(file_id: int, rows: list[dict]) -> list[tuple]:
    """Changes of one file, from rows of side p (previous key), n (new key) and s (agreement of two keys, or values of one)."""
    then = {r["key_name"]: r for r in rows if r["side"] == "p"}
    now = {r["key_name"]: r for r in rows if r["side"] == "n"}
    same = {(r["prev_hash"], r["key_hash"]): r["n_same"] for r in rows if r["side"] == "s"}
    common = max([0, *(n for (a, b), n in same.items() if a is not None and b is not None)])
    old, new = sorted(then), sorted(now)

    def weight(a: str, b: str) -> float:
        x, y = then[a], now[b]
        agree = same.get((x["key_hash"], y["key_hash"]), 0)
        filled = same.get((x["key_hash"], None), 0), same.get((None, y["key_hash"]), 0)
        rarer = min(filled)
        share = agree / max(filled) if agree else 0.0
        if a == b:
            return SAME_NAME + share
        enough = agree and agree >= LEAST_OVERLAP * rarer and (agree >= LEAST_COUNT or agree >= LEAST_OVERLAP * common)
        comparable = rarer and not 0 < agree < LEAST_COUNT
        gone = a not in now and b not in then
        if not enough and (comparable or not gone):
            return 0.0
        alike = likeness(a, b)
        rest = NAME_WEIGHT * alike + TYPE_WEIGHT * float(x["types"] == y["types"])
        if enough:
            return share + rest
        if alike >= NAME_ALONE:
            return rest
        looks = sketch_likeness(x, y) if alike >= SKETCH_NAME and not rarer else 0.0
        return 0.1 * looks + 0.1 * rest if looks >= SKETCH_ALONE else 0.0

    pairs = matched(old, new, weight)
    out = []
    for a, b in pairs:
        if a != b:
            out.append((file_id, a, b, "renamed"))
        x, y = then[a]["types"], now[b]["types"]
        if x and y and x != y:
            out.append((file_id, a, b, "retyped"))
    left, right = {a for a, _ in pairs}, {b for _, b in pairs}
    out += [(file_id, a, a, "removed") for a in old if a not in left]
    out += [(file_id, b, b, "added") for b in new if b not in right]
    return out


def matched(old: list[str], new: list[str], weight) -> list[tuple[str, str]]:
    """The matching of largest weight, solved apart for each connected part of the graph of pairs with a weight."""
    edges = {(a, b): w for a in old for b in new if (w := weight(a, b)) > 0}
    of_old: dict[str, list[str]] = {}
    of_new: dict[str, list[str]] = {}
    for a, b in edges:
        of_old.setdefault(a, []).append(b)
        of_new.setdefault(b, []).append(a)
    out, seen = [], set()
    for start in old:
        if start in seen or start not in of_old:
            continue
        left, right, todo = {start}, set(), [start]
        while todo:
            for b in of_old[todo.pop()]:
                if b not in right:
                    right.add(b)
                    fresh = [a for a in of_new[b] if a not in left]
                    left.update(fresh)
                    todo += fresh
        seen |= left
        rows, columns = sorted(left), sorted(right)
        if len(rows) == len(columns) == 1:
            out.append((rows[0], columns[0]))
        else:
            out += [(rows[i], columns[j]) for i, j in best_matching([[edges.get((a, b), 0.0) for b in columns] for a in rows])]
    return out


def _match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = [c for file_id, rows in zip(b["file_id"], b["rows"]) for c in match_keys(file_id, list(rows))]
        yield pd.DataFrame(out, columns=["file_id", "prev_key", "key_name", "change_kind"])


SKETCH = ("types", "n_values", "n_numbers", "mean", "spread", "size", "size_spread", "hashes")


def changes(files: DataFrame, records: DataFrame, record_key: str = "record_id", profiles: DataFrame | None = None) -> DataFrame:
    """file_id, prev_key, key_name, change_kind of each file against the one before it.

    What is gathered per file are its keys and those of the file before, never rows.
    """
    rows = written(cells(records))
    few = files.count() <= MAX_FILES
    links = written(previous_files(files))
    hinted = F.broadcast if few else (lambda df: df)
    profiles = written(key_profiles(rows)) if profiles is None else profiles
    nothing, no_hash = F.lit(None), F.lit(None).cast("int")
    part = ["file_id", "side", "key_name", "prev_hash", "key_hash", "n_same", *SKETCH]
    with_side = lambda df, side: df.select("file_id", F.lit(side).alias("side"), "key_name", no_hash.alias("prev_hash"), "key_hash", F.lit(0).cast("bigint").alias("n_same"), *SKETCH)
    new = with_side(profiles.join(hinted(links.where("prev_id is not null").select("file_id")), "file_id"), "n")
    old = with_side(profiles.withColumnRenamed("file_id", "prev_id").join(hinted(links.where("prev_id is not null").select("file_id", "prev_id")), "prev_id"), "p")
    types = dict(profiles.dtypes)
    same = overlaps(rows, links, record_keys(profiles, record_key), few).select(
        "file_id", F.lit("s").alias("side"), nothing.cast("string").alias("key_name"), "prev_hash", "key_hash", "n_same", *[nothing.cast(types[c]).alias(c) for c in SKETCH]
    )
    every = new.unionByName(old).unionByName(same)
    gathered = every.groupBy("file_id").agg(F.collect_list(F.struct(*part[1:])).alias("rows"))
    return gathered.mapInPandas(_match, "file_id bigint, prev_key string, key_name string, change_kind string")


def lineages(files: DataFrame, found: DataFrame) -> DataFrame:
    """feed_name, key_name, from_seq, to_seq, root: during which files a renamed key carries the content of `root`.

    Each rename points at the rename before it of the same content; pointers are doubled until all point at a first one,
    in as many rounds as the logarithm of the longest chain. Only rename events are handled, never files or records.
    """
    events = found.where("change_kind = 'renamed'").join(listed(files), "file_id")
    event = lambda key: F.xxhash64("file_id", key)
    made = events.select("feed_name", F.col("key_name").alias("k"), "seq_no", F.lit(1).alias("made"), event("key_name").alias("id"), F.lit(None).cast("string").alias("root"))
    used = events.select("feed_name", F.col("prev_key").alias("k"), "seq_no", F.lit(0).alias("made"), event("key_name").alias("id"), F.col("prev_key").alias("root"))
    order = W.partitionBy("feed_name", "k").orderBy("seq_no", "made")
    both = made.unionByName(used).withColumns({
        "parent": F.last(F.when(F.col("made") == 1, F.col("id")), True).over(order.rowsBetween(W.unboundedPreceding, -1)),
        "end": F.first(F.when(F.col("made") == 0, F.col("seq_no")), True).over(order.rowsBetween(1, W.unboundedFollowing)),
    })
    both = cut(both)
    spans = both.where("made = 1").select("id", "feed_name", F.col("k").alias("key_name"), F.col("seq_no").alias("from_seq"), F.coalesce(F.col("end") - 1, F.lit(2**31 - 1)).alias("to_seq"))
    points = both.where("made = 0").select("id", "parent", "root")
    while not points.where("parent is not null").isEmpty():
        up = points.select(F.col("id").alias("parent"), F.col("parent").alias("above"), F.col("root").alias("root_above"))
        points = cut(points.join(up, "parent", "left").select("id", F.col("above").alias("parent"), F.coalesce("root_above", "root").alias("root")))
    return spans.join(points, "id").select("feed_name", "key_name", "from_seq", "to_seq", "root")


def unified(files: DataFrame, records: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """One row per readable record with the fixed columns of UNIFIED (lower case) and a map of all others.

    A key's content goes to the column its lineage began under, compared without case and underscores; a value that
    does not fit the column's type is null there.
    """
    profiles = written(key_profiles(cells(records)))
    found = cut(changes(files, records, profiles=profiles)) if found is None else found
    spans = lineages(files, found)
    of_file = listed(files)
    # Fields per key and file: few rows beside the records, joined on the file.
    keys = (
        profiles.join(of_file, "file_id").alias("k")
        .join(spans.alias("s"), (F.col("k.feed_name") == F.col("s.feed_name")) & (F.col("k.key_name") == F.col("s.key_name")) & F.col("k.seq_no").between(F.col("s.from_seq"), F.col("s.to_seq")), "left")
        .select("k.file_id", "k.key_name", F.coalesce("s.root", "k.key_name").alias("field"))
    )
    maps = keys.groupBy("file_id").agg(F.map_from_entries(F.collect_list(F.struct("key_name", "field"))).alias("fields"))
    parsed = records.select("raw_id", "file_id", "line_no", F.try_variant_get(F.try_parse_json("payload"), "$", "map<string,variant>").alias("m")).where("m is not null")
    rows = parsed.join(maps, "file_id", "left").join(of_file, "file_id", "left")
    named = F.transform(
        F.map_entries("m"),
        lambda e: F.struct(
            F.coalesce(F.try_element_at(F.col("fields"), e["key"]), e["key"]).alias("field"),
            F.when(~F.is_variant_null(e["value"]), plain_text(F.to_json(e["value"]))).alias("text"),
        ),
    )
    rows = rows.select("raw_id", "file_id", "feed_name", "seq_no", "line_no", named.alias("n"))
    same = lambda x, name: F.regexp_replace(F.lower(x["field"]), "_", "") == name.replace("_", "").lower()

    def column(name: str, kind: str) -> Column:
        hit = F.try_element_at(F.filter("n", lambda x: same(x, name)), F.lit(1))["text"]
        return (hit.try_cast(kind) if kind != "string" else hit).alias(name.lower())

    rest = F.filter("n", lambda x: ~F.regexp_replace(F.lower(x["field"]), "_", "").isin([u.replace("_", "").lower() for u in UNIFIED]) & x["text"].isNotNull())
    others = F.map_from_entries(F.transform(F.array_distinct(F.transform(rest, lambda x: x["field"])), lambda k: F.struct(k, F.element_at(F.filter(rest, lambda x: x["field"] == k), 1)["text"])))
    return rows.select("raw_id", "file_id", "feed_name", "seq_no", "line_no", *[column(n, t) for n, t in UNIFIED.items()], others.alias("other_fields"))
