"""Sources: JSON lines, delimited files, workbooks, clips, Parquet shards."""

from __future__ import annotations

import io
import xml.etree.ElementTree as ET
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CLIP = r"^(\d{6})_(\d{4})_(.*)$"


def json_lines(spark: SparkSession, path: str, schema: str, strict: bool = True) -> DataFrame:
    """Strict: a malformed line is an error. Else it is left out."""
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def json_lines_keyed(spark: SparkSession, path: str, schema: str, keys: list[str]) -> DataFrame:
    """The last line of each key (the first of keys that is set); torn lines are left out. Needs one file a path, as
    lines are ordered within a file."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_at"))
    rows = lines.select(F.from_json("value", schema).alias("r"), "_f", "_b", "_at").where("r is not null").select("r.*", "_f", "_b", "_at").withColumn("_key", F.coalesce(*keys)).where("_key is not null")
    last = Window.partitionBy("_key").orderBy(F.desc("_f"), F.desc("_b"), F.desc("_at"))
    return rows.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n", "_f", "_b", "_at", "_key")


def with_presence(df: DataFrame, raw: str, fields: list[str]) -> DataFrame:
    """has_<field> columns that tell an absent key from a null one, of a column of JSON text."""
    for f in fields:
        df = df.withColumn(f"has_{f}", F.array_contains(F.json_object_keys(raw), f))
    return df


def positional_index(df: DataFrame) -> DataFrame:
    """index from the position of a row where it is null. Positions come from partitions in the order of the files."""
    rdd = df.rdd.zipWithIndex().map(lambda x: (*x[0], x[1]))
    schema = T.StructType([*df.schema.fields, T.StructField("_at", T.LongType())])
    out = df.sparkSession.createDataFrame(rdd, schema)
    own = F.coalesce("index", "_at") if "index" in df.columns else F.col("_at")
    return out.withColumn("index", own).drop("_at")


def delimited(spark: SparkSession, path: str, header: list[str] | None = None, sep: str = ";", comment: str | None = None) -> DataFrame:
    """Text columns; with header given, any other header is an error."""
    reader = spark.read.option("sep", sep).option("header", True)
    df = (reader.option("comment", comment) if comment else reader).csv(path)
    if header is not None and df.columns != header:
        raise ValueError(f"the header is {df.columns}, not {header}")
    return df


def json_array(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def texts(spark: SparkSession, path: str, field: str = "text") -> DataFrame:
    """(text): a field of JSON lines, or the lines of a text file, by the path's ending."""
    if path.rstrip("/").endswith((".jsonl", ".json")):
        return spark.read.schema(f"{field} string").json(path).select(F.col(field).alias("text"))
    return spark.read.text(path).select(F.col("value").alias("text"))


def shards(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet shards whose columns may differ; a clip's name from its own column, its audio's path or its position."""
    df = spark.read.option("mergeSchema", True).parquet(path)
    names = [F.col(c) for c in ("filename",) if c in df.columns] + ([F.col("audio.path")] if "audio" in df.columns else [])
    df = df.withColumn("filename", F.coalesce(*names, F.concat(F.lit("clip_"), F.monotonically_increasing_id().cast("string"))))
    return df.select(*columns) if columns else df


def clips(spark: SparkSession, path: str, pattern: str = "*.flac") -> DataFrame:
    """(path, length, term_index, variant_index, slug): the first file of each pair of numbers; contents aren't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path).select("path", "length")
    rows = files.select("*", *clip_name(F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1))).where("term_index is not null")
    first = Window.partitionBy("term_index", "variant_index").orderBy("path")
    return rows.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def clip_name(stem: Column) -> list[Column]:
    part = lambda k: F.nullif(F.regexp_extract(stem, CLIP, k), F.lit(""))
    return [part(1).cast("int").alias("term_index"), part(2).cast("int").alias("variant_index"), part(3).alias("slug")]


def flac_seconds(content: Column) -> Column:
    """Duration from the header of a FLAC file: samples over the rate, null where there is no header."""
    at = lambda a, b: F.conv(F.hex(F.substring(content, a, b)), 16, 10).cast("bigint")
    packed = at(19, 8)
    rate, samples = F.shiftrightunsigned(packed, 44), packed.bitwiseAND(F.lit((1 << 36) - 1))
    return F.when((F.hex(F.substring(content, 1, 4)) == "664C6143") & (rate > 0), samples / rate)


def probed(files: DataFrame, cache: DataFrame, key: str, measure: Column, name: str) -> DataFrame:
    """(key, name): from the cache, or measured; what can't be measured is left out."""
    new = files.join(cache, key, "left_anti").select(key, measure.alias(name)).where(F.col(name).isNotNull())
    return cache.select(key, name).unionByName(new)


def workbook(spark: SparkSession, path: str, first_cell: str, sheet: int = 1) -> DataFrame:
    """Text columns of a sheet: the header is the first row that begins with first_cell, short rows are filled up.

    A workbook is one zip archive of at most a million rows a sheet, so it is read in one piece, through Spark's reader.
    """
    raw = spark.read.format("binaryFile").load(path).select("content").first()["content"]
    ns = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    with zipfile.ZipFile(io.BytesIO(bytes(raw))) as z:
        names = z.namelist()
        shared = ["".join(t.text or "" for t in si.iter(f"{ns}t")) for si in ET.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{ns}si")] if "xl/sharedStrings.xml" in names else []
        rows = []
        for row in ET.fromstring(z.read(f"xl/worksheets/sheet{sheet}.xml")).iter(f"{ns}row"):
            cells: dict[int, str] = {}
            for c in row.iter(f"{ns}c"):
                at = 0
                for ch in filter(str.isalpha, c.get("r", "A")):
                    at = 26 * at + ord(ch) - 64
                v = c.find(f"{ns}v")
                text = "".join(t.text or "" for t in c.iter(f"{ns}t")) if c.get("t") == "inlineStr" else "" if v is None else v.text or ""
                cells[at - 1] = shared[int(text)] if c.get("t") == "s" and text else text
            rows.append(cells)
    head = next(k for k, r in enumerate(rows) if r.get(0, "").strip() == first_cell)
    width = max(rows[head]) + 1
    schema = ", ".join(f"`{rows[head].get(k) or f'c{k}'}` string" for k in range(width))
    return spark.createDataFrame([tuple(r.get(k) for k in range(width)) for r in rows[head + 1 :]], schema)


def decimal_comma(c: Column) -> Column:
    return F.replace(F.regexp_replace(c, r"[\s  ]", ""), F.lit(","), F.lit(".")).try_cast("double")
