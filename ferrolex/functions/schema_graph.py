"""Schema graph of nested records and its shared inlining into related flat tables."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field


@dataclass
class Node:
    """An element of the schema: kind is object, array, scalar or mixed; `type` is the scalar's type.

    A mixed element may have fields and an item beside its scalars, as far as its objects and arrays are known.
    """

    kind: str
    type: str = ""
    fields: dict[str, "Node"] = field(default_factory=dict)
    item: "Node | None" = None


def parse_schema(text: str) -> Node:
    """The node described by a merged VARIANT schema such as OBJECT<a: BIGINT, b: ARRAY<STRING>>."""
    node, rest = _parse(text.strip())
    if rest.strip():
        raise ValueError(f"schema text goes on after its end: {rest[:40]}")
    return node


def _parse(text: str) -> tuple[Node, str]:
    if text.startswith("OBJECT<"):
        node, rest = Node("object"), text[7:].lstrip()
        while not rest.startswith(">"):
            name, rest = _name(rest)
            node.fields[name], rest = _parse(rest.lstrip(": "))
            rest = rest.lstrip(", ")
        return node, rest[1:]
    if text.startswith("ARRAY<"):
        item, rest = _parse(text[6:])
        return Node("array", item=item), rest[1:]
    if text.startswith("OBJECT"):
        return Node("object"), text[6:]
    end, depth = 0, 0
    while end < len(text) and (depth or text[end] not in ",>"):
        depth += {"(": 1, ")": -1}.get(text[end], 0)
        end += 1
    kind = text[:end].strip()
    return Node("mixed" if kind == "VARIANT" else "scalar", kind), text[end:]


def _name(text: str) -> tuple[str, str]:
    if text.startswith("`"):
        end = 1
        while text[end] != "`" or text[end + 1 : end + 2] == "`":
            end += 2 if text[end] == "`" else 1
        return text[1:end].replace("``", "`"), text[end + 1 :]
    end = text.index(":")
    return text[:end].strip(), text[end:]


def united(nodes: list[Node]) -> Node:
    """One definition for several occurrences of an element: fields side by side, scalars of different types mixed."""
    if len(nodes) == 1:
        return nodes[0]
    fields: dict[str, list[Node]] = {}
    for n in nodes:
        for key, child in n.fields.items():
            fields.setdefault(key, []).append(child)
    items = [n.item for n in nodes if n.item]
    kinds = {(n.kind, n.type) for n in nodes if (n.kind, n.type) != ("scalar", "VOID")} or {(nodes[0].kind, nodes[0].type)}
    kind, type_ = kinds.pop() if len(kinds) == 1 else ("mixed", "VARIANT")
    return Node(kind, type_, {k: united(v) for k, v in fields.items()}, united(items) if items else None)


@dataclass
class Table:
    """One occurrence of a flat table: where its elements lie below the parent's element, and its child tables.

    Occurrences of a shared or recursive element have the same `name`: their rows form one table.
    """

    name: str
    path: tuple[str, ...]
    repeated: bool
    leaves: list[tuple[tuple[str, ...], Node]] = field(default_factory=list)
    children: list["Table"] = field(default_factory=list)

    def every(self) -> list["Table"]:
        return [self, *(t for c in self.children for t in c.every())]


def columns_of(root: Table) -> dict[str, list[tuple[tuple[str, ...], Node]]]:
    """The inlined leaves of each table, those of all its occurrences united."""
    found: dict[str, dict[tuple[str, ...], list[Node]]] = {}
    for t in root.every():
        own = found.setdefault(t.name, {})
        for path, node in t.leaves:
            own.setdefault(path, []).append(node)
    return {name: [(path, united(nodes)) for path, nodes in own.items()] for name, own in found.items()}


def inline(root: Node, name: str) -> Table:
    """Shared inlining: singleton descendants are inlined into the table of their ancestor; repeated elements get tables
    of their own; an element that is reached from several parents, or that lies below one of the same name, has one
    table for all its occurrences. An element is known by its member name."""
    parents: Counter[str] = Counter()

    def element(node: Node) -> Node | None:
        return node if node.fields else element(node.item) if node.item else None

    def visit(node: Node, above: tuple[str, ...]) -> None:
        for key, child in node.fields.items():
            if element(child):
                parents[key] += 2 if key in above else 1
            visit(child, (*above, key))
        if node.item:
            visit(node.item, above)

    visit(root, (name,))
    shared = {key for key, n in parents.items() if n > 1}
    taken = {name}
    titles: dict[str, str] = {}
    for key in sorted(shared):
        titles[key] = key if key not in taken else f"{key}_element"
        taken.add(titles[key])
    table = Table(name, (), False)
    _fill(table, root, (), titles, taken)
    return table


def _fill(table: Table, node: Node, path: tuple[str, ...], titles: dict[str, str], taken: set[str]) -> None:
    if node.kind in ("scalar", "mixed") or not (node.fields or node.item):
        table.leaves.append((path, node))
    if node.item:
        own = Table(titles.get(path[-1], "") if path and node.item.fields else "", path, True)
        own.name = own.name or _free(f"{table.name}_{'_'.join(path) or 'item'}", taken)
        table.children.append(own)
        _fill(own, node.item, (), titles, taken)
    for key, child in node.fields.items():
        at = (*path, key)
        if child.fields and key in titles:
            own = Table(titles[key], at, False)
            table.children.append(own)
            if child.kind == "mixed" or child.item:  # its scalars stay with the parent, its arrays are occurrences beside its objects
                _fill(table, Node(child.kind, child.type, item=child.item), at, titles, taken)
            _fill(own, Node("object", "", child.fields), (), titles, taken)
        else:
            _fill(table, child, at, titles, taken)


def _free(title: str, taken: set[str]) -> str:
    while title in taken:
        title += "_2"
    taken.add(title)
    return title
