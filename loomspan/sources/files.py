"""Dumps, pages, redirects, page ids, triples; writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomspan.functions.normal import byte_size
from loomspan.schemas import DUMP_RECORD, PAGE


def json_lines(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(records, bad lines) of a file of JSON lines, or of one JSON array with an object a line.

    Lines of fewer than three characters are skipped, one comma at the end is dropped, lines that aren't JSON objects
    come back as text. JSON below fields declared as string stays raw."""
    lines = spark.read.text(path).select(F.btrim("value", F.lit(" \t\r\n")).alias("line")).where(F.length("line") >= 3)
    parsed = lines.select("line", F.from_json(F.regexp_replace("line", ",$", ""), f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"))
    good = parsed.where("r is not null and r._bad is null").select("r.*").drop("_bad")
    return good, parsed.where("r is null or r._bad is not null").select("line")


def dump(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Records of a knowledge-base dump, with datavalues as raw JSON, and the lines that can't be read."""
    return json_lines(spark, path, DUMP_RECORD)


def pages(spark: SparkSession, path: str) -> DataFrame:
    """Extracted pages below a folder, HTML entities of the text undone."""
    from loomspan.functions.normal import unescape

    return spark.read.schema(PAGE).option("recursiveFileLookup", "true").json(path).withColumn("text", unescape("text"))


def redirects(spark: SparkSession, path: str) -> DataFrame:
    """(source, target, ts) of the redirect pages of an XML dump."""
    schema = "title string, redirect struct<_title:string,_VALUE:string>, revision struct<timestamp:string>"
    rows = spark.read.format("xml").option("rowTag", "page").schema(schema).load(path)
    return rows.where("redirect._title is not null").select(F.col("title").alias("source"), F.col("redirect._title").alias("target"), F.try_to_timestamp("revision.timestamp").alias("ts"))


def page_ids(rows: DataFrame) -> DataFrame:
    """(title, id): of several ids of a title the greatest, whatever the file order."""
    return rows.where("title is not null").groupBy("title").agg(F.max("id").alias("id"))


def space_triples(spark: SparkSession, path: str, columns: tuple[str, ...] = ("head", "rel", "tail")) -> DataFrame:
    """Triples, or pairs, separated by single blanks; further blanks, quotes and backslashes belong to the last part. Lines
    with fewer parts have nulls for the rest."""
    parts = F.split("value", " ", len(columns))
    return spark.read.text(path).select(*[F.get(parts, F.lit(i)).alias(c) for i, c in enumerate(columns)])


def qid_filter(spark: SparkSession, path: str | None) -> DataFrame | None:
    """(qid) from a JSON file that holds a list, or an object by its keys; None without a path: no filter."""
    if path is None:
        return None
    text = spark.read.text(path, wholetext=True)
    listed = text.select(F.explode(F.from_json("value", "array<string>")).alias("qid"))
    keys = text.select(F.explode(F.json_object_keys("value")).alias("qid"))
    return listed.unionByName(keys).where("qid is not null").distinct()


def numbered_sentences(rows: DataFrame, *order: str) -> DataFrame:
    """rows with sent_idx_unq, from 0 in the order given."""
    from loomspan.operators.knowledge import dense_ids

    return dense_ids(rows, [F.col(c) for c in order], 0, "sent_idx_unq")


def latest(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """One row per key, the last by the order given."""
    w = Window.partitionBy(key).orderBy(*[F.desc(c) for c in order])
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def write_rolled(df: DataFrame, path: str, records: int, kind: str = "json") -> None:
    """Files of at most so many records each (n-line chunks, size-rolled shards)."""
    df.write.option("maxRecordsPerFile", records).mode("overwrite").format(kind).save(path)


def write_by_size(df: DataFrame, path: str, size: str = "10M", kind: str = "json") -> int:
    """Files of about so many bytes each ("10M", with K, M, G or none), by the mean length of a row as JSON text; returns the
    most records of a file."""
    mean = df.select(F.avg(F.octet_length(F.to_json(F.struct("*"))) + 1).alias("m")).first().m or 1.0
    records = max(1, int(byte_size(size) / mean))
    write_rolled(df, path, records, kind)
    return records


def write_one(df: DataFrame, path: str, kind: str = "json") -> None:
    """One file for tables that must be one at the end of a pipeline. A single task writes it."""
    df.coalesce(1).write.mode("overwrite").format(kind).save(path)


def write_json_map(df: DataFrame, path: str, key: str, value: str) -> None:
    """A JSON object per line, {key: value}: a dictionary in parts that load_json_map reads whole; null keys are left out."""
    df.where(F.col(key).isNotNull()).select(F.to_json(F.map_from_arrays(F.array(F.col(key).cast("string")), F.array(key if value == key else value))).alias("value")).write.mode("overwrite").text(path)


def load_json_map(spark: SparkSession, path: str, kind: str = "string") -> DataFrame:
    """(key, value) of JSON objects, one a line, whatever number of keys each has."""
    return spark.read.text(path).select(F.explode(F.from_json("value", f"map<string,{kind}>")).alias("key", "value"))


def title_map_file(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """(url, title, id) of side maps: addresses with the title they have now and its page number, -1 or blank for none."""
    parts = F.split("value", sep)
    at = lambda i: F.nullif(F.trim(F.get(parts, F.lit(i))), F.lit(""))
    return spark.read.text(path).where("value != ''").select(at(0).alias("url"), at(1).alias("title"), F.nullif(at(2).try_cast("long"), F.lit(-1)).alias("id"))


def write_delimited(df: DataFrame, path: str, field: str = "|", item: str = "~*~") -> None:
    """Text lines, fields by one mark and array items by another; nulls are empty."""
    parts = [F.concat_ws(item, F.transform(c, lambda x: x.cast("string"))) if t.startswith("array") else F.coalesce(F.col(c).cast("string"), F.lit("")) for c, t in df.dtypes]
    df.select(F.concat_ws(field, *parts).alias("value")).write.mode("overwrite").text(path)


def run_config(spark: SparkSession, settings: dict[str, object]) -> DataFrame:
    """One row per setting of a run, with the time it began."""
    rows = [(k, str(v)) for k, v in sorted(settings.items())]
    return spark.createDataFrame(rows, "name string, value string").withColumn("started_at", F.current_timestamp())
