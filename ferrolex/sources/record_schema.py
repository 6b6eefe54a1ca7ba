"""Record schemas declared in YAML: types, prompt sections and the struct type to read with."""

from __future__ import annotations

from pyspark.sql import types as T

# The type names that a schema may use.
TYPES = {
    "str": T.StringType(), "float": T.DoubleType(), "int": T.LongType(), "bool": T.BooleanType(),
    "list[str]": T.ArrayType(T.StringType()), "list[float]": T.ArrayType(T.DoubleType()),
}


# The name of a schema without one, and how a list is asked for in a prompt.
DEFAULT_NAME = "DynamicRecord"
AS_LIST = "  (return as JSON array, or null)"


class RecordSchema:
    """A schema: its name, its settings, its fields in order and the struct type. Of a name given twice the last counts."""

    def __init__(self, config: dict, origin: str = "schema"):
        self.config = config
        self.name = config.get("project") or DEFAULT_NAME
        self.fields: dict[str, dict] = {}
        for f in config.get("fields") or []:
            kind = f.get("type") or "str"
            if kind not in TYPES:
                raise ValueError(f"field {f.get('name')!r} in {origin} has the type {kind!r}; supported are {', '.join(TYPES)}")
            self.fields[f["name"]] = {"type": kind, "unit": f.get("unit"), "description": f.get("description")}

    @property
    def struct(self) -> T.StructType:
        """All fields nullable, with unit and description as metadata."""
        return T.StructType([
            T.StructField(n, TYPES[f["type"]], True, {k: str(f[k]) for k in ("unit", "description") if f[k] is not None}) for n, f in self.fields.items()
        ])

    def prompt_fields(self) -> str:
        """The section of a prompt that lists the fields."""
        lines = ["Fields of each record:"]
        for name, f in self.fields.items():
            unit = f" [{f['unit']}]" if f["unit"] else ""
            array = AS_LIST if f["type"].startswith("list") else ""
            text = f": {' '.join(str(f['description']).split())}" if f["description"] else ""
            lines.append(f"- {name}{unit}{array}{text}")
        return "\n".join(lines)

    def extraction_prompt(self, doi: str) -> str:
        """Instructions for one paper: what to extract, the rules of the domain and the fields."""
        system = self.config.get("material_system") or "the material"
        rules = self.config.get("domain_rules") or ""
        parts = [
            f"Paper {doi}: extract every data record on {system} as a JSON array of objects.",
            "Use null for what the paper does not state, never an empty string or 0.",
            "Values read from a graph are tagged [graph_read] with [high] or [low] confidence in the notes.",
            str(rules).strip(), self.prompt_fields(),
        ]
        return "\n\n".join(p for p in parts if p)


# The classes of figures and what they show.
FIGURE_CLASSES = {
    "microstructure": "grain structure, porosity, precipitates", "DBTT_curve": "transition temperature against a variable", "hardness": "hardness plots and profiles",
    "EBSD": "orientation maps, pole figures, boundary maps", "fracture_surface": "images of fracture surfaces", "map": "element, strain or dose maps", "other": "all else",
}


def classification_prompt(labels: list[str]) -> str:
    """Instructions to classify the figures named."""
    kinds = "\n".join(f"- {k}: {v}" for k, v in FIGURE_CLASSES.items())
    return f"Classify each figure ({', '.join(labels)}) as one of\n{kinds}\nand say whether it contains data. Answer as a JSON array."


def load_schema(path: str) -> RecordSchema:
    """Read a schema file on the driver."""
    import yaml

    with open(path, encoding="utf-8") as f:
        return RecordSchema(yaml.safe_load(f) or {}, path)
