"""Files, folders, archives, notebooks, JSON lines, policies and graphs as tables."""

from __future__ import annotations

import hashlib
import io
import json
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.session import exists


def ordered_scan(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A Parquet scan with the place of each row, ``_file`` and ``_row``, as scans in order need it."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path).select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def shards(spark: SparkSession, folder: str, pattern: str = "*.parquet", first: int | None = None) -> list[str]:
    """Paths below a folder that match, sorted; only the first few if asked."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{folder}/{pattern}")
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p) or []
    paths = sorted(x.getPath().toString() for x in found)
    return paths[:first] if first else paths


def tolerant_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of JSON lines; blank lines and lines that are no JSON object are left out."""
    raw = spark.read.text(path).where(F.trim("value") != "")
    good = raw.where(F.expr("coalesce(schema_of_variant(try_parse_json(value)) like 'OBJECT%', false)"))
    return good.select(F.from_json("value", schema).alias("r")).select("r.*")


def ids_of_json_lines(spark: SparkSession, path: str, key: str = "instance_id") -> DataFrame:
    """Distinct ids of the lines that have one."""
    return tolerant_json_lines(spark, path, f"{key} string").where(F.col(key).isNotNull() & (F.col(key) != "")).distinct()


def staged_or_else(spark: SparkSession, folder: str, make) -> DataFrame:
    """The table in ``folder`` if it has rows, else ``make()`` written there and read back."""
    if exists(spark, folder):
        df = spark.read.parquet(folder)
        if not df.isEmpty():
            return df
    make().write.mode("overwrite").parquet(folder)
    return spark.read.parquet(folder)


def catalog(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON array of records of exactly this schema; anything else fails."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def task_list(spark: SparkSession, path: str) -> DataFrame:
    """(place, task): lines without # comments and blanks, each once, in the order of the file."""
    x = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("place", "line"))
    x = x.select("place", F.trim(F.regexp_replace("line", "#.*$", "")).alias("task")).where("task <> ''")
    return x.groupBy("task").agg(F.min("place").alias("place")).select("place", "task")


def tree_digests(spark: SparkSession, folder: str, ignore: list[str] | None = None, max_depth: int | None = None) -> DataFrame:
    """(path, bytes, sha256) of all files below a folder, relative to it; ``ignore`` has regular expressions of paths."""
    x = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    path = F.substring_index("path", folder.rstrip("/") + "/", -1)
    x = x.select(path.alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    for pattern in ignore or []:
        x = x.where(~F.col("path").rlike(pattern))
    return x.where(F.size(F.split("path", "/")) <= max_depth) if max_depth else x


def text_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, text) of the files without a NUL in their first 1,024 bytes."""
    x = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    has_nul = F.exists(F.sequence(F.lit(1), F.greatest(F.least(F.length("content"), F.lit(1024)), F.lit(1))), lambda i: F.hex(F.substring(F.col("content"), i, F.lit(1))) == "00")
    return x.where(~has_nul).select("path", F.decode("content", "UTF-8").alias("text"))


def zip_members(spark: SparkSession, path: str) -> DataFrame:
    """(archive, member, bytes, sha256) of the files of zip archives; a broken archive has one row with null member."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for p, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        rows += [(p, i.filename, i.file_size, hashlib.sha256(z.read(i)).hexdigest()) for i in z.infolist() if not i.is_dir()]
                except (zipfile.BadZipFile, RuntimeError, NotImplementedError):
                    rows.append((p, None, None, None))
            cols = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int64(), pa.string()))], names=["archive", "member", "bytes", "sha256"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "archive string, member string, bytes long, sha256 string")


def graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of node-link JSON files."""
    x = spark.read.schema("nodes array<struct<id:string,name:string,text:string>>, edges array<struct<source:string,target:string>>").option("multiLine", True).json(path)
    return x.select(F.explode("nodes").alias("n")).select("n.*"), x.select(F.explode("edges").alias("e")).select("e.*")


def policy(text: str) -> list[tuple[str, str, object]]:
    """(section, key, value) of a flat two-level policy text: ``section:`` and ``  key: value`` lines, scalars typed."""
    out, section = [], ""
    for line in text.splitlines():
        bare = line.split(" #")[0].rstrip()
        if not bare.strip() or bare.lstrip().startswith("#") or ":" not in bare:
            continue
        key, _, value = bare.partition(":")
        if not value.strip() and not line[:1].isspace():
            section = key.strip()
        else:
            out.append((section if line[:1].isspace() else "", key.strip(), scalar(value.strip())))
    return out


def scalar(v: str) -> object:
    """true, false, null, numbers and quoted texts as what they are, the rest as text."""
    low = v.lower()
    if low in ("true", "false"):
        return low == "true"
    if low in ("null", "~", ""):
        return None
    for kind in (int, float):
        try:
            return kind(v)
        except ValueError:
            pass
    return v[1:-1] if len(v) > 1 and v[0] == v[-1] and v[0] in "\"'" else v


def notebook_cells(spark: SparkSession, path: str, output_chars: int = 2000) -> DataFrame:
    """(path, place, cell_type, source, output) of notebooks; outputs beyond ``output_chars`` are cut with a mark."""
    cell = "struct<cell_type:string,source:string,outputs:array<struct<text:string>>>"
    x = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.from_json("value", f"cells array<{cell}>").alias("n"))
    x = x.select("path", F.posexplode("n.cells").alias("place", "c"))
    # the parts of a source are an array or one text; as text an array is JSON again
    whole = lambda t: F.coalesce(F.array_join(F.from_json(t, "array<string>"), ""), t)
    out = F.array_join(F.transform(F.coalesce("c.outputs", F.array().cast("array<struct<text:string>>")), lambda o: F.coalesce(whole(o["text"]), F.lit(""))), "\n")
    return x.select("path", "place", F.col("c.cell_type").alias("cell_type"), whole(F.col("c.source")).alias("source"), F.when(F.length(out) > output_chars, F.concat(F.left(out, F.lit(output_chars)), F.lit("\n... [cut]"))).otherwise(out).alias("output"))


def numstat(lines: DataFrame, col: str) -> DataFrame:
    """(path, added, removed, is_binary) of ``git diff --numstat`` lines; - counts as 0."""
    p = F.split(F.col(col), "\t")
    n = lambda i: F.coalesce(F.try_to_number(F.when(F.get(p, F.lit(i)) != "-", F.get(p, F.lit(i))), F.lit("9999999999")), F.lit(0)).cast("long")
    return lines.where(F.size(p) == 3).select(F.get(p, F.lit(2)).alias("path"), n(0).alias("added"), n(1).alias("removed"), (F.get(p, F.lit(0)) == "-").alias("is_binary"))


def to_json_text(record: dict) -> str:
    """JSON with non-ASCII characters as they are."""
    return json.dumps(record, ensure_ascii=False)


def nested(spark: SparkSession, path: str, schema: str, items: str, multi_line: bool = False) -> DataFrame:
    """Documents with nested items as one row an item, beside the document's other fields. ``multi_line`` reads files that
    are one document each, else each line is one."""
    x = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    return x.select(*[c for c in x.columns if c != items], F.explode(items).alias("_item")).select("*", "_item.*").drop("_item")


def numbered_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The records of JSON lines with their place over all files, from 1: files by name, lines by where they begin. Lines
    are numbered within their file and files added up, so no task holds more than a file."""
    x = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("at"))
    w = Window.partitionBy("file").orderBy("at")
    x = x.withColumn("n", F.row_number().over(w))
    sizes = x.groupBy("file").agg(F.count("*").alias("lines"))  # one row a file
    before = sizes.select("file", F.coalesce(F.sum("lines").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return x.join(F.broadcast(before), "file").select((F.col("n") + F.col("before")).alias("place"), F.from_json("value", schema).alias("r")).select("place", "r.*")
