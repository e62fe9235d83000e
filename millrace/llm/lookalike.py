"""Problem 2: visually identical text with different characters.

Every value gets a look-alike-mapped form: width, ligatures, compatibility ideographs, kinds of blank and hyphen and
look-alike letters go to one character each, invisible characters go away; case, accents, raised digits and all other
characters stay. Composition is left to the grouping: the mapped values are grouped in SQL under the accent- and
case-sensitive collation UNICODE, each class gets a canonical member (the least digest of its members' code points) from
a partial, map-side aggregation, and the class is joined back to the rows. Digests have 128 bits.

Null texts are in no class; points need a non-empty text. Rows delivered again count once; extra columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_BLOCK = 4096
# fixed values: letters and signs that look like an ASCII one, by script
LOOKALIKES = {
    "АВЕКМНОРСТХІЅЈУԌԚԜ": "ABEKMHOPCTXISJYGQW",
    "аеорсухѕіјһԁԛԝѵӏ": "aeopcyxsijhdqwvl",
    "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ": "ABEZHIKMNOPTYX",
    "ονϲϳ": "ovcj",
    "ՕՏԼօսոհցզ": "OSLounhgq",
    "ɑɡꞓ": "agc",
    "‐‑‒–⁃−﹘﹣˗": "---------",
    "⁄∕∶꞉․‚∣∼∙⋅・": "//::.,|~···",
    "カエニロタトハヘノー": "力工二口夕卜八へ丿一",
    "\t    ": "     ",
}
# ranges whose compatibility form looks the same; raised and lowered digits lie outside
_SAME_FORM = ((0x2000, 0x200A), (0x2160, 0x217F), (0x2E80, 0x2FDF), (0x3000, 0x3000), (0xF900, 0xFAFF), (0xFB00, 0xFB06), (0xFF01, 0xFFEE), (0x1D400, 0x1D7FF), (0x2F800, 0x2FA1F))
_INVISIBLE = ((0x34F, 0x34F), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFFA0, 0xFFA0), (0xE0100, 0xE01EF))


def fold_table() -> dict[int, str]:
    """What ``str.translate`` does to a decomposed text."""
    table: dict[int, str] = {}
    for a, b in _SAME_FORM:
        for c in range(a, b + 1):
            k = unicodedata.normalize("NFKC", chr(c))
            if k != chr(c):
                table[c] = unicodedata.normalize("NFD", k)
    for c in [*range(0xA0, 0x2100), *range(0xFE00, 0x10000), *range(0x1BCA0, 0x1BCA4), *range(0x1D173, 0x1D17B), *range(0xE0001, 0xE0080)]:
        if unicodedata.category(chr(c)) == "Cf" and not (0x600 <= c <= 0x605 or c in (0x6DD, 0x70F, 0x8E2)):
            table[c] = ""
    for a, b in _INVISIBLE:
        table.update(dict.fromkeys(range(a, b + 1), ""))
    for odd, plain in LOOKALIKES.items():
        table.update({ord(o): p for o, p in zip(odd, plain, strict=True)})
    return {c: v.translate(table) for c, v in table.items()}


def mapped(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, form) of the rows with a text."""
    table = fold_table()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nfd = unicodedata.normalize
        for batch in batches:
            form = [t if t.isascii() and "\t" not in t else nfd("NFD", nfd("NFD", t).translate(table)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(form, pa.string())], names=["id", "text", "form"])

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where(F.col("text").isNotNull())
    return rows.mapInArrow(run, "id long, text string, form string")


def _keyed(rows: DataFrame, side: int) -> DataFrame:
    # the digest stands for the text from here on: two independent 64-bit hashes
    digest = F.struct(F.xxhash64("text").alias("x"), F.xxhash64(F.lit(0x5EED), F.reverse(F.col("text"))).alias("y"))
    return rows.select(F.lit(side).alias("side"), "id", digest.alias("own"), F.expr("form COLLATE UNICODE").alias("form"))


def same_look(points: DataFrame, refs: DataFrame) -> DataFrame:
    """(point_id, ref_id): texts of a point and a reference that look the same and are not equal.

    Both inputs have the columns ``id`` and ``text``."""
    both = _keyed(mapped(points.where(F.col("text") != ""), "id", "text"), 0).unionByName(_keyed(mapped(refs, "id", "text"), 1))
    classes = both.groupBy("form").agg(F.min("own").alias("canon"), F.max("own").alias("last"), F.min("side").alias("lo"), F.max("side").alias("hi"), F.sum("side").alias("refs"))
    # a class with many references is joined in blocks of them, each with all its points
    classes = classes.where("lo = 0 and hi = 1 and canon <> last").select("form", "canon", F.ceil(F.col("refs") / HOT_BLOCK).cast("int").alias("blocks"))
    members = both.join(classes, "form").select("side", "id", "own", "canon", "blocks").distinct()
    p = members.where("side = 0").select(F.col("id").alias("point_id"), F.col("own").alias("p"), "canon", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    r = members.where("side = 1").select(F.col("id").alias("ref_id"), F.col("own").alias("r"), "canon", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"))
    return p.join(r, ["canon", "block"]).where("p <> r").select("point_id", "ref_id").distinct()


def canonical(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, canonical, members, changed): each row's text in the form of its class's canonical member, the least text
    by code points, with the number of different texts in the class."""
    rows = mapped(df, id_col, text_col).select("id", "text", F.expr("form COLLATE UNICODE").alias("form"))
    values = rows.groupBy("text").agg(F.first("form").alias("form"))
    classes = values.groupBy("form").agg(F.min("text").alias("canonical"), F.count("*").alias("members"))
    out = rows.join(classes, "form").select("id", "canonical", "members", (F.col("text") != F.col("canonical")).alias("changed"))
    return out.distinct()
