"""Nested JSON answers turned into related flat tables by shared inlining (problem 5).

An answer is a list of documents, an object that holds such a list somewhere in its first two levels, or one document.
Null, blank, cut-off and failed answers are kept in the table of answers and give no documents; a document keeps its
position in the answer, also when others around it are null. Repeated answers are kept under their own keys. Everything
runs on VARIANT values inside the JVM; the schema graph comes from one mergeable aggregate over the data, and one more
for each member that is of several kinds, or from a schema passed in.

Keys: a row of a table is the element at `node` of document doc_pos of an answer, `node` being its path with positions,
empty for the document itself; parent_table and parent_node name the row it belongs to, pos its place in its list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrolex.functions.schema_graph import Node, Table, columns_of, inline, parse_schema

#: An object with one of these members is a document. Wrappers are known by their form alone.
DOCUMENT_MARKS = ("material_id", "symmetry", "bulk_modulus", "shear_modulus", "origins", "formula_pretty", "energy_above_hull")
#: A wrapper with one of these members that holds no documents is a failed answer, not an empty one.
FAILURE_MARKS = ("error", "errors", "message", "detail", "status_code")
SCALARS = {"BIGINT": "bigint", "BOOLEAN": "boolean", "DOUBLE": "double", "STRING": "string", "FLOAT": "double"}


def step(path: tuple[str, ...]) -> str:
    """JSON path of nested members, quoted so that any name is safe."""
    return "$" + "".join("['" + p.replace("\\", "\\\\").replace("'", "\\'") + "']" for p in path)


def once(value: Column) -> Column:
    """The value behind a generator, so that it is computed once and not copied into each expression that uses it."""
    return F.explode(F.array(value))


def _list(v: Column) -> Column:
    return F.when(F.schema_of_variant(v).startswith("ARRAY"), F.try_variant_get(v, "$", "array<variant>"))


def _values(v: Column) -> Column:
    """The values of the members of an object, empty for anything else."""
    inner = F.map_values(F.try_variant_get(v, "$", "map<string,variant>"))
    return F.coalesce(F.when(F.schema_of_variant(v).startswith("OBJECT"), inner), F.array().cast("array<variant>"))


def _marked(v: Column) -> Column:
    has = [F.try_variant_get(v, step((m,)), "variant").isNotNull() for m in DOCUMENT_MARKS]
    found = has[0]
    for h in has[1:]:
        found = found | h
    return F.schema_of_variant(v).startswith("OBJECT") & found


def wrapped_documents(v: Column) -> Column:
    """array<variant>: the documents within a wrapper, null where there are none and it is no empty answer.

    Of the members and their members: a list with documents or a document itself; else a list of objects among the
    members; else an empty list, unless a member tells of a failure. Of several, the longest, then the first by name.
    """
    keys = F.map_keys(F.try_variant_get(v, "$", "map<string,variant>"))
    failed = F.arrays_overlap(F.transform(keys, F.lower), F.array(*map(F.lit, FAILURE_MARKS)))
    first = _values(v)
    both = F.concat(first, F.flatten(F.transform(first, _values)))
    as_list = lambda x: F.coalesce(_list(x), F.when(_marked(x), F.array(x)))
    lists = F.filter(F.transform(both, as_list), lambda d: d.isNotNull())
    own = F.filter(F.transform(first, _list), lambda d: d.isNotNull())
    tiers = F.array(
        F.filter(lists, lambda d: F.exists(d, _marked)),
        F.filter(own, lambda d: F.exists(d, lambda x: F.schema_of_variant(x).startswith("OBJECT"))),
        F.when(~failed, F.filter(lists, lambda d: F.size(d) == 0)).otherwise(F.array().cast("array<array<variant>>")),
    )
    best = F.try_element_at(F.filter(tiers, lambda t: F.size(t) > 0), F.lit(1))
    longest = F.array_max(F.transform(best, F.size))
    return F.try_element_at(F.filter(best, lambda d: F.size(d) == longest), F.lit(1))


def parsed(answers: DataFrame, payload: str = "payload") -> DataFrame:
    """Adds outer_form and docs (array<variant>): the documents of each answer."""
    text = F.col(payload)
    df = answers.select("*", once(F.try_parse_json(text)).alias("_v"))
    is_doc = F.coalesce(F.arrays_overlap(F.json_object_keys(text), F.array(*map(F.lit, DOCUMENT_MARKS))), F.lit(False))
    form = (
        F.when(F.trim(F.coalesce(text, F.lit(""))) == "", "empty")
        .when(F.col("_v").isNull(), "broken")
        .when(F.ltrim(text).startswith("["), "list")
        .when(~F.ltrim(text).startswith("{"), "scalar")
        .when(is_doc, "document")
        .otherwise("wrapped")
    )
    df = df.select("*", once(F.struct(form.alias("form"))).alias("_f"))
    form = F.col("_f.form")
    docs = F.when(form == "list", _list(F.col("_v"))).when(form == "document", F.array("_v")).when(form == "wrapped", wrapped_documents(F.col("_v")))
    df = df.select("*", once(F.struct(docs.alias("docs"))).alias("_d"))
    found = F.when((form == "wrapped") & F.col("_d.docs").isNull(), "failed").otherwise(form)
    rest = [F.col(f"`{c}`") for c in answers.columns if c not in ("outer_form", "docs")]
    return df.select(*rest, found.alias("outer_form"), F.col("_d.docs").alias("docs"))


def documents(answers: DataFrame, key: str = "cache_id", payload: str = "payload") -> DataFrame:
    """key, doc_pos (from 0) and the document as VARIANT."""
    return parsed(answers.select(key, payload), payload).select(key, F.posexplode("docs").alias("doc_pos", "doc"))


def schema_plan(docs: DataFrame, schema: str | None = None, roots: tuple[str, ...] | None = None) -> Table:
    """The tables by shared inlining. `schema` is a merged VARIANT schema; without it aggregates find it.

    With `roots` the tables hold these members of the documents only.
    """
    if schema is not None:
        root = parse_schema(schema if schema not in ("", "VOID", "VARIANT") else "OBJECT<>")
    else:
        objects = docs.where(F.schema_of_variant("doc").startswith("OBJECT")).select(F.col("doc").alias("_e"))
        root = merged(objects)
    if roots is not None:
        root.fields = {k: v for k, v in root.fields.items() if k in roots}
    if schema is None:
        root.fields = {k: told_apart(objects, child, (k,)) for k, child in root.fields.items()}
    return inline(root, "document")


def merged(elements: DataFrame) -> Node:
    """The node of the elements `_e`: the fields of their objects, the item of their arrays and their scalars side by side."""
    kind = F.schema_of_variant("_e")
    part = lambda of_kind, name: F.schema_of_variant_agg(F.when(of_kind, F.col("_e"))).alias(name)
    found = elements.select(
        part(kind.startswith("OBJECT"), "o"), part(kind.startswith("ARRAY"), "a"), part(~kind.rlike("^(OBJECT|ARRAY)"), "s")
    ).first()
    nodes = [parse_schema(t) for t in found if t and t != "VOID"]
    if len(nodes) == 1:
        return nodes[0]
    fields = {k: v for n in nodes for k, v in n.fields.items()}
    return Node("mixed" if nodes else "object", "VARIANT" if nodes else "", fields, next((n.item for n in nodes if n.item), None))


def several_kinds(node: Node) -> bool:
    return node.kind == "mixed" or any(map(several_kinds, node.fields.values())) or (node.item is not None and several_kinds(node.item))


def told_apart(elements: DataFrame, node: Node, path: tuple[str, ...] = ()) -> Node:
    """The node at `path` below the elements, with what its members of several kinds hold as objects, arrays and scalars."""
    if not several_kinds(node):
        return node
    if path:
        elements = elements.select(F.try_variant_get("_e", step(path), "variant").alias("_e")).where("_e is not null")
    if node.kind == "mixed":
        node = merged(elements)
    node.fields = {k: told_apart(elements, child, (k,)) for k, child in node.fields.items()}
    if node.item is not None and several_kinds(node.item):
        items = F.when(F.schema_of_variant("_e").startswith("ARRAY"), F.try_variant_get("_e", "$", "array<variant>"))
        node.item = told_apart(elements.select(F.explode(items).alias("_e")), node.item)
    return node


def value_of(v: Column, path: tuple[str, ...], node: Node) -> Column:
    """The leaf as a typed column; mixed, nested and void leaves as JSON text, a JSON null as null.

    Objects and arrays of a mixed leaf that has columns or a table for them are not repeated in it.
    """
    if node.kind == "scalar" and (t := SCALARS.get(node.type.split("(")[0])):
        return F.try_variant_get(v, step(path), t)
    if node.kind == "scalar" and node.type.startswith("DECIMAL"):
        return F.try_variant_get(v, step(path), "double")
    inner = F.try_variant_get(v, step(path), "variant")
    text = F.when(inner.isNotNull() & ~F.is_variant_null(inner), F.to_json(inner))
    apart = [k for k, own in (("OBJECT", node.fields), ("ARRAY", node.item)) if own]
    return F.when(~F.schema_of_variant(inner).rlike(f"^({'|'.join(apart)})"), text) if apart else text


def flat_tables(
    answers: DataFrame, key: str = "cache_id", payload: str = "payload", schema: str | None = None, roots: tuple[str, ...] | None = None
) -> dict[str, DataFrame]:
    """The related tables by name: `answer`, `document` and the other tables of the plan.

    Each row of the others carries the answer's key, doc_pos, node, parent_table, parent_node and pos, then its leaves.
    """
    docs = documents(answers, key, payload)
    plan = schema_plan(docs, schema, roots)
    rest = [c for c in answers.columns if c not in (payload, "outer_form", "docs")]
    out = {"answer": parsed(answers, payload).select(*[F.col(f"`{c}`") for c in rest], "outer_form", F.coalesce(F.size("docs"), F.lit(0)).alias("n_documents"))}
    for name, (df, columns) in _tables(docs, plan, key).items():
        out[name if name != "answer" else "answer_element"] = df.select(*_keys(key), *[value_of(F.col("_e"), p, n).alias(c) for p, n, c in columns])
    return out


def _keys(key: str) -> list[str]:
    return [key, "doc_pos", "node", "parent_table", "parent_node", "pos"]


def _tables(docs: DataFrame, plan: Table, key: str) -> dict[str, tuple[DataFrame, list[tuple[tuple[str, ...], Node, str]]]]:
    """By table the rows of all its occurrences (keys and the element `_e`), and path, node and column name of its leaves."""
    none = F.lit(None)
    rows: dict[str, list[DataFrame]] = {}

    def walk(df: DataFrame, table: Table) -> None:
        rows.setdefault(table.name, []).append(df)
        for child in table.children:
            below = F.concat(F.col("node"), F.when(F.col("node") != "", ".").otherwise("") if child.path else F.lit(""), F.lit(".".join(child.path)))
            at = F.try_variant_get("_e", step(child.path), "variant")
            if child.repeated:
                items = df.select(key, "doc_pos", F.col("node").alias("parent_node"), below.alias("_at"), F.posexplode(_list(at)).alias("pos", "_e"))
                inner = items.withColumn("node", F.concat("_at", F.lit("["), F.col("pos").cast("string"), F.lit("]")))
            else:
                inner = df.select(key, "doc_pos", F.col("node").alias("parent_node"), below.alias("node"), none.cast("int").alias("pos"), at.alias("_e"))
                inner = inner.where(F.schema_of_variant("_e").startswith("OBJECT"))
            walk(inner.withColumn("parent_table", F.lit(table.name)).select(*_keys(key), "_e"), child)

    start = docs.select(key, "doc_pos", F.lit("").alias("node"), F.lit("answer").alias("parent_table"), none.cast("string").alias("parent_node"), none.cast("int").alias("pos"), F.col("doc").alias("_e"))
    walk(start, plan)
    out = {}
    for name, leaves in columns_of(plan).items():
        seen: dict[str, int] = {k.lower(): 1 for k in _keys(key)}
        columns = []
        for path, node in leaves:
            column = "_".join(path) or "value"
            n = seen[column.lower()] = seen.get(column.lower(), 0) + 1
            columns.append((path, node, column if n == 1 else f"{column}_{n}"))
        every = rows[name][0]
        for more in rows[name][1:]:
            every = every.unionByName(more)
        out[name] = (every, columns)
    return out


def leaf_paths(answers: DataFrame, roots: tuple[str, ...], key: str = "cache_id", payload: str = "payload", schema: str | None = None) -> DataFrame:
    """key, doc_pos, leaf_path of each non-null scalar below `roots` in each document: the filled leaves of the flat tables.

    The path of a leaf is its row's node and the leaf's place within it.
    """
    docs = documents(answers, key, payload)
    out = docs.select(key, "doc_pos", F.lit(None).cast("string").alias("leaf_path")).limit(0)
    for name, (df, columns) in _tables(docs, schema_plan(docs, schema, roots), key).items():
        below = [(p, n, c) for p, n, c in columns if name != "document" or len(p) > 1]
        if not below:
            continue
        flat = df.select(key, "doc_pos", "node", *[value_of(F.col("_e"), p, n).alias(f"c{i}") for i, (p, n, _) in enumerate(below)])
        paths = []
        for i, (p, n, _) in enumerate(below):
            value = F.col(f"c{i}")
            filled = value.isNotNull() if n.kind == "scalar" and n.type != "VOID" else value.isNotNull() & ~value.rlike(r"^[\[{]")
            dot = F.when(F.col("node") != "", ".").otherwise("") if p else F.lit("")
            paths.append(F.when(filled, F.concat("node", dot, F.lit(".".join(p)))))
        out = out.unionByName(flat.select(key, "doc_pos", F.explode(F.array_compact(F.array(*paths))).alias("leaf_path")))
    return out
