"""Entity-attribute-value rows into one typed row per entity.

The claims are read once. Readings are made and de-duplicated in the JVM, cells are thinned there to what a row can
hold, and what is left is bucketed by a hash of the entity. Each bucket is dictionary-encoded, scattered into numpy
arrays per type by row and column index, and leaves Python as Arrow tables.

Every entity has one row. A cell of many values that would make it a huge one, more than `cell_limit` distinct values,
is told by the state `long`, and `long_values` has all of its values as rows. So no task ever gathers such a cell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomspan.functions import readings
from loomspan.functions.text import key, strip
from loomspan.operators.skew import lookup

TYPES = {"wikibase-item": "string", "quantity": "double", "time": "date", "string": "string"}
ARROW = {"string": pa.string(), "double": pa.float64(), "date": pa.date32()}
STATES = ("ok", "conflict", "unread", "long")
MAX_COLUMNS = 5000
#: Values of a cell. Spark cuts groups before it shuffles them for limits up to 1000: this one, a null and one too many.
CELL_LIMIT = 998


def _columns(defs: DataFrame, taken: set[str]) -> list[tuple[str, str, str, bool]]:
    """(property key, column name, datatype, single) per defined property; one per key, sorted by key."""
    rows = (
        defs.select(key("property_id").alias("p"), F.lower(strip("datatype")).alias("d"), (F.lower(strip("cardinality")) == "single").alias("s"))
        .where("p is not null").groupBy("p").agg(F.min("d").alias("d"), F.min("s").alias("s")).orderBy("p").limit(MAX_COLUMNS + 1).collect()
    )
    if len(rows) > MAX_COLUMNS:
        raise ValueError(f"more than {MAX_COLUMNS} properties can't be columns of one table")
    out = []
    for r in rows:
        name = r.p
        while name.lower() in taken or f"{name}__state".lower() in taken:
            name += "_"
        taken |= {name.lower(), f"{name}__state".lower()}
        out.append((r.p, name, r.d if r.d in TYPES else "string", bool(r.s)))
    return out


def cells(claims: DataFrame, columns: list, entity: str, attribute: str, value: str) -> DataFrame:
    """(entity, col, reading): the distinct readings of each cell, null for claims that can't be read."""
    spark = claims.sparkSession
    known = spark.createDataFrame([(p, i, d) for i, (p, _, d, _) in enumerate(columns)], "p string, col int, datatype string")
    raw = claims.select(key(entity).alias("entity"), key(attribute).alias("p"), strip(value).alias("raw"))
    raw = raw.where("entity is not null and raw != ''").join(F.broadcast(known), "p")  # at most MAX_COLUMNS rows
    return raw.select("entity", "col", readings.canonical(F.col("raw"), F.col("datatype")).alias("reading")).distinct()


def _scatter(columns: list, entity: str, cell_limit: int):
    """A function from Arrow batches of cells, sorted by entity, column and reading, to wide Arrow batches."""
    is_single = np.array([c[3] for c in columns])

    def table(t: pa.Table) -> pa.RecordBatch:
        names = t["entity"].combine_chunks().dictionary_encode()
        codes, col, reading = names.indices.to_numpy(), t["col"].to_numpy(), t["reading"].combine_chunks()
        first = np.ones(len(codes), bool)
        first[1:] = codes[1:] != codes[:-1]
        opens = first.copy()
        opens[1:] |= col[1:] != col[:-1]
        row, cell, n = np.cumsum(first) - 1, np.cumsum(opens) - 1, int(first.sum())
        there = reading.is_valid().to_numpy(zero_copy_only=False)
        held = np.bincount(cell, there)
        of_single = is_single[col[opens]]
        state = np.select([held == 0, of_single & (held > 1), ~of_single & (held > cell_limit)], [2, 1, 3], 0)
        states = np.full((n, len(columns)), -1, np.int8)
        states[row[opens], col[opens]] = state
        there &= (state == 0)[cell]
        # one array per type, rows by the columns of that type
        values = {}
        for kind in ARROW:
            of = np.array([TYPES[c[2]] == kind for c in columns])
            picked = np.flatnonzero(there & of[col])
            if kind == "string":
                code = reading.take(pa.array(picked)).dictionary_encode()
                cast = code.dictionary
                numbers = code.indices.to_numpy()
            else:
                cast = reading.take(pa.array(picked)).cast(ARROW[kind])
                numbers = np.arange(len(picked))
            place = np.cumsum(of) - 1
            grid = np.full((n, max(1, int(of.sum()))), -1, np.int64)
            alone = is_single[col[picked]]
            grid[row[picked[alone]], place[col[picked[alone]]]] = numbers[alone]
            values[kind] = (cast, grid, place, picked, numbers)
        arrays, fields = [names.take(pa.array(np.flatnonzero(first))).cast(pa.string())], [(entity, pa.string())]
        labels = pa.array(STATES)
        for i, (_, name, datatype, single) in enumerate(columns):
            kind = TYPES[datatype]
            cast, grid, place, picked, numbers = values[kind]
            if single:
                index = grid[:, place[i]]
                array = cast.take(pa.array(index, mask=index < 0))
            else:
                own = col[picked] == i
                rows = row[picked[own]]
                bounds = np.searchsorted(rows, np.arange(n + 1)).astype(np.int32)
                content = cast.take(pa.array(numbers[own]))
                array = pa.ListArray.from_arrays(pa.array(bounds), content, mask=pa.array(bounds[1:] == bounds[:-1]))
            arrays += [array, labels.take(pa.array(states[:, i], mask=states[:, i] < 0))]
            fields += [(name, array.type), (f"{name}__state", pa.string())]
        return pa.RecordBatch.from_arrays(arrays, schema=pa.schema(fields))

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([held, t]) if held is not None and held.num_rows else t
            if not t.num_rows:
                continue
            # rows of the last entity may go on in the next batch
            codes = t["entity"].combine_chunks().dictionary_encode().indices.to_numpy()
            cut = int(np.argmax(codes == codes[-1]))
            if cut:
                yield table(t.slice(0, cut).combine_chunks())
            held = t.slice(cut)
        if held is not None and held.num_rows:
            yield table(held.combine_chunks())

    return scatter


def widen(claims: DataFrame, defs: DataFrame, *, entity: str = "qid", attribute: str = "property_id", value: str = "value", cell_limit: int = CELL_LIMIT) -> DataFrame:
    """One row per entity, a typed column and a `__state` column per property of defs.

    A column of a `single` property holds its value if all readable claims agree; `__state` tells `ok`, `conflict` (two
    or more different values; the value is null) or `unread` (claims, none readable), null: no non-blank claim. A column
    of a `many` property is an array of its distinct values, sorted by their canonical text; null if there is none, or
    if there are more than cell_limit: its state is then `long` and `long_values` has them. Claims with a null or blank
    entity, attribute or value make no cell, and properties not in defs no column. An entity all of whose claims are
    blank has no row. Extra columns of claims aren't read; a property whose name clashes with another column gets `_`
    appended. Empty input gives an empty table of the same schema. Over MAX_COLUMNS properties are an error: give defs in
    parts then.
    """
    columns = _columns(defs, {entity.lower()})
    schema = f"`{entity}` string" + "".join(f", `{name}` {TYPES[d] if single else f'array<{TYPES[d]}>'}, `{name}__state` string" for _, name, d, single in columns)
    if not columns:
        return claims.select(key(entity).alias(entity)).where(F.col(entity).isNotNull()).distinct()
    rows = cells(claims, columns, entity, attribute, value)
    # a null, all the values that a row may hold, and one more that tells that there are too many
    place = F.row_number().over(Window.partitionBy("entity", "col").orderBy("reading"))
    thin = rows.withColumn("place", place).where(F.col("place") <= cell_limit + 2).drop("place")
    bucketed = thin.repartition("entity").sortWithinPartitions("entity", "col", "reading")
    wide = bucketed.mapInArrow(_scatter(columns, entity, cell_limit), schema)
    wide._properties = columns
    return wide


def long_values(claims: DataFrame, defs: DataFrame, *, entity: str = "qid", attribute: str = "property_id", value: str = "value", cell_limit: int = CELL_LIMIT) -> DataFrame:
    """(entity, property_id, reading): every distinct value, as its canonical text, of the cells that widen calls long."""
    columns = _columns(defs, {entity.lower()})
    many = spark_columns(claims, columns)
    rows = cells(claims, columns, entity, attribute, value).join(F.broadcast(many), "col").where("reading is not null")
    rows = rows.select(F.struct("entity", "property_id").alias("cell"), "reading")
    large = rows.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > cell_limit)
    return lookup(rows, large, "cell").where("n is not null").select(F.col("cell.entity").alias(entity), "cell.property_id", "reading")


def spark_columns(df: DataFrame, columns: list) -> DataFrame:
    """(col, property_id) of the properties of many values."""
    return df.sparkSession.createDataFrame([(i, p) for i, (p, _, _, single) in enumerate(columns) if not single], "col int, property_id string")


def cell_states(wide: DataFrame, single_only: bool = True) -> DataFrame:
    """(entity, property, state) of every cell of a table that widen made."""
    entity = wide.columns[0]
    structs = [F.struct(F.lit(p).alias("property_id"), F.col(f"`{name}__state`").alias("state")) for p, name, _, single in wide._properties if single or not single_only]
    if not structs:
        return wide.select(F.col(entity), F.lit("").alias("property_id"), F.lit("").alias("state")).limit(0)
    return wide.select(F.col(f"`{entity}`"), F.explode(F.array(*structs)).alias("cell")).select(entity, "cell.*").where("state is not null")
