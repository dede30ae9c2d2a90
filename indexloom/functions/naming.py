"""Types inferred from field names, and the columns a field tree spreads into."""

from __future__ import annotations

from indexloom.functions import fixed_values as fixed

SPARK_TYPES = {
    "keyword": "string",
    "text": "string",
    "long": "bigint",
    "double": "double",
    "boolean": "boolean",
    "date": "timestamp",
}


def detect_type(field: str) -> str:
    """Type of a field from its last path segment; the first rule that fits wins."""
    name = field.replace(".", "__").rsplit("__", 1)[-1].lower()
    if any(code in name for code in fixed.CODE_NAMES):
        return "keyword"
    if name == "id" or name.endswith("_id"):
        return "long"
    if name.endswith(fixed.DOUBLE_ENDINGS) or name in fixed.DOUBLE_NAMES:
        return "double"
    if name.startswith(fixed.BOOLEAN_STARTS):
        return "boolean"
    if name.endswith(fixed.DATE_ENDINGS):
        return "date"
    return "text"


def field_key(path: str) -> str:
    return path.replace(".", "__")


def strip_locale(name: str, locales) -> str:
    for locale in locales:
        if name.endswith("_" + locale):
            return name[: -len(locale) - 1]
    return name


def leaves(tree, path: str = ""):
    """Dotted paths of all leaf fields, in order."""
    for node in tree:
        if isinstance(node, str):
            yield f"{path}.{node}" if path else node
        else:
            for relation, below in node.items():
                yield from leaves(below, f"{path}.{relation}" if path else relation)


def flatten_weights(weights: dict, path: str = "") -> dict[str, float]:
    """Nested ``{field: weight, relation: {...}}`` as ``{dotted path: weight}``."""
    flat = {}
    for name, value in weights.items():
        full = f"{path}.{name}" if path else name
        if isinstance(value, dict):
            flat.update(flatten_weights(value, full))
        else:
            flat[full] = float(value)
    return flat
