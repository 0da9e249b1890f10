"""Shredding of nested JSON documents into rows.

A document is parsed **once**, into one VARIANT per resource. An extractor's nested
schema of the fields it needs is then **one** cast of that VARIANT, to text in structs and
arrays; levels are outer explodes of these arrays, and every scalar is pulled out at its
own level, so a fan-out copies flat columns only. Where a node has another kind than the
schema says (an object where an array is usual, or the reverse) an object still gives one
row and an array one row per element, read from the same VARIANT to the same type.

Expressions are written as SQL text: a wide resource is some hundred of them,
and one ``selectExpr`` per level keeps plan building short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinloom.functions.scalars import ANY_LENGTH
from clinloom.session import ensure_json_settings

_TEXT = T.StringType()
# Field the JSON parser fills with the text when a node did not fit the schema.
_MISFIT = "_misfit"


# --- schema building blocks -------------------------------------------------


def leaf(*names: str) -> list[T.StructField]:
    """Scalar fields, read exactly and by their kind, kept as text until they are cast."""
    return [T.StructField(n, _TEXT) for n in names]


def texts(name: str) -> T.StructField:
    """Array of scalars of which a path takes the first."""
    return T.StructField(name, T.ArrayType(_TEXT))


def rows(name: str, *fields) -> T.StructField:
    """Usually an array: a level that gives one row per element."""
    return T.StructField(name, T.ArrayType(shape(*fields)), metadata={"level": True})


def node(name: str, *fields) -> T.StructField:
    """Usually an object: a level that gives one row."""
    return T.StructField(name, shape(*fields), metadata={"level": True})


def obj(name: str, *fields) -> T.StructField:
    """Object that a path steps through; anything else reads as NULL."""
    return T.StructField(name, shape(*fields))


def items(name: str, *fields) -> T.StructField:
    """Array of objects of which a path takes the first; else NULL."""
    return T.StructField(name, T.ArrayType(shape(*fields)))


def shape(*fields) -> T.StructType:
    flat: list[T.StructField] = []
    for f in fields:
        flat.extend(f if isinstance(f, list) else [f])
    return T.StructType(flat)


def coding(*names: str) -> T.StructField:
    """The ``coding`` level of a coded concept."""
    return rows("coding", leaf(*(names or ("code", "display"))))


# --- bundles -> entries -------------------------------------------------------


def explode_entries(docs: DataFrame, *types: str, json: str = "json") -> DataFrame:
    """One row per bundle entry: all other columns, fullUrl, resourceType, resource.

    ``resource`` is VARIANT: numbers keep their digits, of repeated keys the last counts. With
    ``types`` only those resource types are kept; without, a document that has no
    entries gives one row of NULLs.
    """
    ensure_json_settings(docs.sparkSession)
    keep = [c for c in docs.columns if c != json]
    options = f"map('columnNameOfCorruptRecord', '{_MISFIT}', {ANY_LENGTH})"
    usual = f"from_json(`{json}`, 'entry ARRAY<STRUCT<fullUrl: VARIANT, resource: VARIANT>>, {_MISFIT} STRING', {options})"
    entries = docs.selectExpr(*map(_quoted, docs.columns), f"{usual} AS _usual").selectExpr(
        *map(_quoted, keep),
        f"inline_outer(CASE WHEN _usual.{_MISFIT} IS NULL THEN _usual.entry ELSE {_unusual_entries(json)} END)"
        " AS (_url, resource)",
    )
    found = entries.selectExpr(
        *map(_quoted, keep), f"{_scalar('_url')} AS fullUrl", f"{_scalar(_get('resource', '.resourceType'))} AS resourceType", "resource"
    )
    return of_type(found, *types) if types else found


def _unusual_entries(json: str) -> str:
    """Entries of a root array of bundles, or of an ``entry`` that is one object."""
    bundles = _elements(f"from_json(`{json}`, 'VARIANT', map({ANY_LENGTH}))", "d")
    fields = ", ".join(f"'{f}', {_get('e', '.' + f)}" for f in ("fullUrl", "resource"))
    listed = f"coalesce({_elements(_get('b', '.entry'), 'l')}, array())"
    return f"flatten(transform({bundles}, b -> transform({listed}, e -> named_struct({fields}))))"


def of_type(entries: DataFrame, *types: str) -> DataFrame:
    return entries.filter(F.col("resourceType").isin(*types))


# --- resource -> flat rows -------------------------------------------------------


def tabulate(df: DataFrame, schema: T.StructType, *levels: str, text: str = "resource") -> DataFrame:
    """Shred a VARIANT or JSON text column into flat columns, opening ``levels`` in order.

    Columns are named by their path, joined with ``_``; ``texts`` and ``items``
    give their first element. ``levels`` are dotted paths such as ``item`` or
    ``item.productOrService.coding``: opening one multiplies the row by its
    elements, a missing or empty one keeps the row with NULLs. Independent
    levels multiply each other.
    """
    ensure_json_settings(df.sparkSession)
    keep = [c for c in df.columns if c != text]
    if df.schema[text].dataType == _TEXT:
        df = df.selectExpr(*map(_quoted, keep), f"from_json(`{text}`, 'VARIANT', map({ANY_LENGTH})) AS `{text}`")
    out, open_now = _read(df, keep, text, _needed(schema, levels, ""))
    for level in levels:
        name = level.replace(".", "_")
        element = open_now.pop(name)
        keep = [c for c in out.columns if c != name]
        out, opened = _columns(out, keep, _quoted(name), element, name + "_")
        open_now.update(opened)
    return out


def _needed(schema: T.StructType, levels: tuple[str, ...], path: str) -> T.StructType:
    """The schema without arrays that are never opened."""
    fields = []
    for f in schema:
        here, kind = path + f.name, f.dataType
        listed = isinstance(kind, T.ArrayType)
        if listed and f.metadata.get("level") and here not in levels:
            continue
        element = kind.elementType if listed else kind
        if isinstance(element, T.StructType):
            element = _needed(element, levels, here + ".")
        fields.append(T.StructField(f.name, T.ArrayType(element) if listed else element, metadata=f.metadata))
    return T.StructType(fields)


def _read(df: DataFrame, keep: list[str], column: str, schema: T.StructType):
    """Read a VARIANT column once, with all its levels: flat columns, and arrays of structs to open.

    A usual resource is one cast. In another, each node is read by its own kind, to the same type.
    """
    kept, ref = list(map(_quoted, keep)), _quoted(column)
    each = f"flatten(transform({_elements(ref, 'd')}, e -> {_combined('e', schema, 0)}))"
    typed = df.selectExpr(*kept, ref, f"{_get(ref, '', _type(schema))} AS _s")
    usual = " AND ".join(["_s IS NOT NULL", *[f"NOT coalesce({t}, false)" for t in _unusual(schema, "_s", "", ref)]])
    found = typed.selectExpr(*kept, f"CASE WHEN {usual} THEN array(_s) ELSE {each} END AS _r")
    return _columns(found, keep, "_r", schema, "")


def _columns(df: DataFrame, keep: list[str], ref: str, element: T.StructType, prefix: str):
    """A row per element of an array of structs: its flat columns, and the levels found in them."""
    kept = list(map(_quoted, keep))
    one = df.selectExpr(*kept, f"explode_outer({ref}) AS _s")
    columns: list[str] = []
    levels: dict[str, T.StructType] = {}
    for field in element:
        _flatten(field, f"_s.`{field.name}`", prefix + field.name, columns, levels)
    return one.selectExpr(*kept, *columns), levels


def _flatten(field: T.StructField, ref: str, name: str, columns: list, levels: dict) -> None:
    kind = field.dataType
    if isinstance(kind, T.ArrayType):
        if field.metadata.get("level"):
            columns.append(f"{ref} AS `{name}`")
            levels[name] = kind.elementType
            return
        kind = kind.elementType
        ref = f"get({ref}, 0)"
    if isinstance(kind, T.StructType):
        for f in kind:
            _flatten(f, f"{ref}.`{f.name}`", f"{name}_{f.name}", columns, levels)
    else:
        columns.append(f"{ref} AS `{name}`")


def _scalar(ref: str) -> str:
    """Text of a VARIANT leaf; NULL, not its JSON, where it is an object or array.

    Only texts that open like one are asked for their kind.
    """
    text = f"CAST({ref} AS STRING)"
    return (
        f"CASE WHEN substring({text}, 1, 1) IN ('{{', '[') AND schema_of_variant({ref}) <> 'STRING'"
        f" THEN NULL ELSE {text} END"
    )


# All functions below give SQL text. Lambda variables hold what is used more than
# once: a variable is evaluated once, repeated text once per use.


def _get(ref: str, path: str, kind: str = "VARIANT") -> str:
    """What lies at a path below a VARIANT; NULL where nothing does or it is of another kind."""
    return f"try_variant_get({ref}, '${path}', '{kind}')"


def _elements(ref: str, variable: str) -> str:
    """The elements of a level: those of an array, an object as its only one, else NULL."""
    return (
        f"get(transform(array({ref}), {variable} -> coalesce({_get(variable, '', 'ARRAY<VARIANT>')},"
        f" CASE WHEN {_get(variable, '', 'STRUCT<`_`: VARIANT>')} IS NOT NULL THEN array({variable}) END)), 0)"
    )


def _unusual(schema: T.StructType, ref: str, path: str, raw: str | None = None, depth: int = 0) -> list[str]:
    """Tests for nodes of which the cast may not tell all: of another kind than usual, or a text that opens like JSON.

    Where the VARIANT itself is at hand (``raw``) it tells another kind from nodes that are absent.
    """
    tests = []
    for f in schema:
        below, node, kind = f"{path}.{f.name}", f"{ref}.`{f.name}`", f.dataType
        if f.metadata.get("level"):
            listed = isinstance(kind, T.ArrayType)
            other = "STRUCT<`_`: VARIANT>" if listed else "ARRAY<VARIANT>"
            tests.append(f"({node} IS NULL AND {_get(raw, below, other)} IS NOT NULL)" if raw else f"({node} IS NULL)")
            if listed:
                inner = _unusual(kind.elementType, f"x{depth}", "", None, depth + 1)
                if inner:
                    tests.append(f"exists({node}, x{depth} -> coalesce({' OR '.join(inner)}, false))")
                continue
        elif isinstance(kind, T.ArrayType):
            below, node, kind = below + "[0]", f"get({node}, 0)", kind.elementType
        if isinstance(kind, T.StructType):
            tests += _unusual(kind, node, below, raw, depth)
        else:
            like = f"left({node}, 1) IN ('{{', '[')"
            tests.append(f"({like} AND schema_of_variant({_get(raw, below)}) <> 'STRING')" if raw else f"({like})")
    return tests


def _combined(ref: str, schema: T.StructType, depth: int) -> str:
    """All combinations of the elements of an object's nodes, as an array of structs."""
    several = _nodes(schema)
    values = ", ".join(
        f"'{f.name}', " + (f"o{depth}_{f.name}" if f in several else _value(ref, "." + f.name, f, depth)) for f in schema
    )
    out = f"array(named_struct({values}))"
    for f in reversed(several):
        found, e = f"f{depth}", f"e{depth}"
        listed = _elements(_get(ref, f".{f.name}"), f"d{depth}")
        options = (
            f"flatten(transform(array(flatten(transform({listed}, {e} -> {_combined(e, f.dataType, depth + 1)}))),"
            f" {found} -> CASE WHEN size({found}) > 0 THEN {found} ELSE array(CAST(NULL AS {_type(f.dataType)})) END))"
        )
        out = f"flatten(transform({options}, o{depth}_{f.name} -> {out}))"
    return out


def _value(ref: str, path: str, field: T.StructField, depth: int) -> str:
    """What one field of an object says, each node read by its own kind."""
    kind = field.dataType
    if isinstance(kind, T.ArrayType):
        element = kind.elementType
        if field.metadata.get("level"):
            e = f"e{depth}"
            return f"flatten(transform({_elements(_get(ref, path), f'd{depth}')}, {e} -> {_combined(e, element, depth + 1)}))"
        return f"array({_value(ref, path + '[0]', T.StructField('first', element), depth)})"
    if isinstance(kind, T.StructType):
        return "named_struct(" + ", ".join(f"'{f.name}', {_value(ref, f'{path}.{f.name}', f, depth)}" for f in kind) + ")"
    return _scalar(_get(ref, path))


def _nodes(schema: T.StructType) -> list[T.StructField]:
    return [f for f in schema if f.metadata.get("level") and isinstance(f.dataType, T.StructType)]


def _quoted(name: str) -> str:
    return f"`{name}`"


def _type(kind: T.DataType) -> str:
    """What a node is cast to: text in structs and arrays."""
    if isinstance(kind, T.StructType):
        return "STRUCT<" + ", ".join(f"`{f.name}`: {_type(f.dataType)}" for f in kind) + ">"
    if isinstance(kind, T.ArrayType):
        return f"ARRAY<{_type(kind.elementType)}>"
    return "STRING"
