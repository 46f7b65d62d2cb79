"""Deeply nested records into related flat tables.

One walk over the schema finds every array and map level. Each becomes a child table whose rows carry the surrogate key
of their parent, their ordinal in it and, for maps, their key. Surrogates are paths (`parent/level:ordinal`), so they are
the same on every run and whichever executor makes them; `/` and `%` of a key are written `%2F` and `%25` in them, so
that no key can pass for a path. Columns of an ancestor that its descendants need travel down with the explode, so that
no table has to be joined to its parent. Columns of raw JSON get a schema merged over all rows first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def merged_json_schema(df: DataFrame, json: Column) -> str:
    """DDL of the schema that fits every document of a JSON column; documents that can't be parsed don't count."""
    parsed = df.select(F.try_parse_json(json).alias("v"))
    found = parsed.agg(F.schema_of_variant_agg("v").alias("s")).first()
    return (found.s or "STRING").replace("OBJECT<", "STRUCT<").replace("VARIANT", "STRING").replace("VOID", "STRING")


def _flat(schema: T.StructType, at: Column | None, prefix: str) -> tuple[list[tuple[str, Column]], list[tuple[str, Column, T.DataType]]]:
    """Scalar columns, and the levels to explode, of a struct; nested structs are flattened into prefixed names."""
    scalars, levels = [], []
    for field in schema.fields:
        here = F.col(f"`{field.name}`") if at is None else at.getField(field.name)
        name = f"{prefix}{field.name}"
        if isinstance(field.dataType, T.StructType):
            s, more = _flat(field.dataType, here, f"{name}_")
            scalars += s
            levels += more
        elif isinstance(field.dataType, (T.ArrayType, T.MapType)):
            levels.append((name, here, field.dataType))
        else:
            scalars.append((name, here))
    return scalars, levels


def _named(columns: list[tuple[str, Column]], taken: set[str]) -> list[Column]:
    out = []
    for name, c in columns:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(c.alias(name))
    return out


def _step(c: Column) -> Column:
    """A key as a step of a path."""
    return F.replace(F.replace(c.cast("string"), F.lit("%"), F.lit("%25")), F.lit("/"), F.lit("%2F"))


def shred(records: DataFrame, record_key: str, name: str = "record", carry: dict[str, list[str]] | None = None) -> dict[str, DataFrame]:
    """Flat tables by path: `name` for the records, `name_claims`, `name_claims_qualifiers`, ... for the levels below.

    Root rows have `row_id` (the record key as a step of a path) and the scalar columns. Child rows have `row_id`,
    `parent_id`, `ordinal` (position in the array; 0-based position of the key for maps), `map_key` (null below arrays)
    and the scalar columns of the element; an element that is a plain value is in `value`. A map of arrays is one level:
    its rows are the elements, with the key and the position in that key's array. Null and empty arrays and maps have no
    child rows; a null element has a row of nulls. A null record key gives null surrogates: such records are left out.
    carry: by table, its scalar columns that all tables below have as well, as `table__column`. Scalar columns whose
    names clash with these get `_` appended.
    """
    tables: dict[str, DataFrame] = {}
    carry = carry or {}

    def carried(path: str, scalars: list[tuple[str, Column]]) -> list[Column]:
        return [c.alias(f"{path}__{n}") for n, c in scalars if n in carry.get(path, ())]

    def walk(df: DataFrame, path: str, head: list[str], kept: list[str], levels: list[tuple[str, Column, T.DataType]]) -> None:
        for level, at, kind in levels:
            child = f"{path}_{level}"
            if isinstance(kind, T.MapType):
                entries = df.select(F.col("row_id").alias("parent_id"), *kept, F.posexplode(at).alias("ordinal", "map_key", "item"))
                element, step = kind.valueType, _step(F.col("map_key"))
                if isinstance(element, T.ArrayType):
                    entries = entries.select("parent_id", *kept, "map_key", F.posexplode("item").alias("ordinal", "item"))
                    element, step = element.elementType, F.concat(step, F.lit(":"), "ordinal")
            else:
                entries = df.select(F.col("row_id").alias("parent_id"), *kept, F.posexplode(at).alias("ordinal", "item")).withColumn("map_key", F.lit(None).cast("string"))
                element, step = kind.elementType, F.col("ordinal").cast("string")
            entries = entries.select(F.concat("parent_id", F.lit(f"/{level}:"), step).alias("row_id"), "parent_id", "ordinal", F.col("map_key").cast("string").alias("map_key"), *kept, "item")
            if isinstance(element, T.StructType):
                scalars, below = _flat(element, F.col("item"), "")
            elif isinstance(element, (T.ArrayType, T.MapType)):
                scalars, below = [], [("items", F.col("item"), element)]
            else:
                scalars, below = [("value", F.col("item"))], []
            tables[child] = entries.select(*head, *kept, *_named(scalars, {*head, *(k.lower() for k in kept)}))
            more = carried(child, scalars)
            walk(entries.select("*", *more), child, head, [*kept, *(f"{child}__{n}" for n, _ in scalars if n in carry.get(child, ()))], below)

    scalars, levels = _flat(T.StructType(records.schema.fields), F.col("doc"), "")
    rooted = records.select(_step(F.col(f"`{record_key}`")).alias("row_id"), F.struct("*").alias("doc")).where("row_id is not null")
    tables[name] = rooted.select("row_id", *_named(scalars, {"row_id"}))
    walk(rooted.select("*", *carried(name, scalars)), name, ["row_id", "parent_id", "ordinal", "map_key"], [f"{name}__{n}" for n, _ in scalars if n in carry.get(name, ())], levels)
    return tables


def json_fields(df: DataFrame, json: Column) -> list[tuple[str, Column]]:
    """(name, value) of every leaf that the objects of a JSON column have, for use in a select on df: the objects' schema
    is merged over all rows, path by path. A field that holds objects in some rows and plain values in others has a
    leaf for the latter, null for the former, beside those below it. Arrays are leaves, as JSON text. Names are paths
    joined with `_`; documents that can't be parsed have nulls. A field whose name holds both kinds of quotation marks
    can't be named in a path: it stays in the raw column only.
    """
    doc, found, paths = F.try_parse_json(json), [], [("$", ())]
    while paths:
        path, names = paths.pop(0)
        objects = df.select(F.try_variant_get(doc, path, "variant").alias("v")).where(F.schema_of_variant("v").startswith("OBJECT<"))
        ddl = objects.agg(F.schema_of_variant_agg("v").alias("s")).first().s
        if not ddl or ddl == "VOID":
            continue
        for field in T._parse_datatype_string(ddl.replace("OBJECT<", "STRUCT<")).fields:
            quote = next((q for q in "'\"" if q not in field.name), None)
            if quote is None:
                continue
            at, kind, name = f"{path}[{quote}{field.name}{quote}]", field.dataType, (*names, field.name)
            mixed = isinstance(kind, T.VariantType)
            if mixed or isinstance(kind, T.StructType):
                paths.append((at, name))
            if not isinstance(kind, T.StructType):
                value = F.try_variant_get(doc, at, "string" if mixed or isinstance(kind, (T.ArrayType, T.NullType)) else kind.simpleString())
                plain = F.when(~F.schema_of_variant(F.try_variant_get(doc, at, "variant")).startswith("OBJECT<"), value) if mixed else value
                found.append(("_".join(name), plain))
    return found
