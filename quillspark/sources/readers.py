"""Sources and sinks."""

from __future__ import annotations

import codecs
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quillspark.operators.groups import first_per_group

DOCUMENT_TREE = (
    "doc_id string, files array<struct<id string, `order` int, extension string, pages array<struct<page_num int, meta array<double>, "
    "blocks array<struct<text string, coords array<double>, font_name string, font_size_pt double>>>>>>"
)
METADATA = "doc_id string, kind string, delivery_type string, reg_date timestamp, content string, sender string, sender_id string, signer string, signer_id string, outgoing_number string, out_reg_date timestamp"
#: Fixed values of the metadata.
LETTER, ELECTRONIC = "Письмо", "МЭДО"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Extracted layout as JSON lines, with a declared schema."""
    return spark.read.schema(DOCUMENT_TREE).json(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METADATA).json(path)


def _single_byte(encoding: str) -> str | None:
    """The characters of bytes 128 to 255 in an encoding of one byte a character in which ASCII stays; null for other encodings."""
    if bytes(range(128)).decode(encoding, errors="replace") != bytes(range(128)).decode("ascii"):
        return None
    high = [bytes([b]).decode(encoding, errors="replace") for b in range(128, 256)]
    return "".join(high) if all(len(c) == 1 for c in high) and len({*high} - {"\ufffd"}) > 64 else None


def decoded(text: Column, encoding: str) -> Column:
    """A text that was read as Latin 1, that is byte by byte, in its true encoding of one byte a character."""
    high = _single_byte(encoding)
    return F.translate(text, bytes(range(128, 256)).decode("latin-1"), high)


def read_lines(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame:
    """(value): the lines of text files. Files in encodings of one byte a character are read in splits, as those in UTF-8 are."""
    if _utf8(encoding):
        return spark.read.text(path)
    if _single_byte(encoding):  # lines are kept as the bytes that they are
        return spark.read.text(path).select(decoded(F.decode(F.col("value").cast("binary"), "ISO-8859-1"), encoding).alias("value"))
    whole = lambda batches: (pd.DataFrame({"value": c.decode(encoding).splitlines()}) for b in batches for c in b["content"])
    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(whole, "value string")


def _utf8(encoding: str) -> bool:
    return codecs.lookup(encoding).name == "utf-8"


def read_csv(spark: SparkSession, path: str, schema: str, encoding: str = "utf-8", sep: str = ",", multi_line: bool | None = None) -> DataFrame:
    """CSV with a header and a declared schema; values that do not fit it are null.

    In encodings of one byte a character, such as windows-1251, Spark reads the bytes as Latin 1 and their texts are
    translated, so a large file is many tasks. A record with line breaks inside needs multi_line, which reads a file in
    one task; it is the default for UTF-8 only. Files in other encodings are decoded one by one.
    """
    wanted = StructType.fromDDL(schema)
    texts = StructType([StructField(f.name, StringType()) for f in wanted])
    typed = lambda rows: rows.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in wanted])
    read = spark.read.option("header", True).option("sep", sep)
    if _utf8(encoding):
        return read.schema(schema).option("multiLine", multi_line is not False).csv(path)
    if _single_byte(encoding):
        # the header is in the file's encoding, so columns go by place, not by name
        rows = read.schema(texts).option("encoding", "ISO-8859-1").option("enforceSchema", True).option("multiLine", bool(multi_line)).csv(path)
        return typed(rows.select(*[decoded(F.col(f.name), encoding).alias(f.name) for f in wanted]))

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                yield pd.read_csv(io.BytesIO(content), encoding=encoding, sep=sep, dtype=str, keep_default_na=False, na_values=[""])[texts.names]

    return typed(spark.read.format("binaryFile").load(path).select("content").mapInPandas(whole, texts))


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object of texts as (source, target) rows; null values go."""
    raw = spark.read.text(path, wholetext=True)
    pairs = raw.select(F.explode(F.from_json("value", "map<string,string>")).alias("source", "target"))
    return pairs.where("target is not null")


def write_mapping(df: DataFrame, path: str) -> None:
    """(source, target) rows as one JSON object; for mappings that a driver could hold, as one object is one text."""
    entries = F.array_sort(F.collect_list(F.struct("source", "target")))
    df.where("source is not null").groupBy("source").agg(F.min("target").alias("target")).agg(F.to_json(F.map_from_entries(entries)).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def with_content(metadata: DataFrame, files: DataFrame) -> DataFrame:
    """Rows of the metadata with a content that is not blank and a PDF among their files. files: doc_id, extension."""
    pdf = files.where(F.lower("extension") == ".pdf")
    return metadata.where(F.col("content").rlike(r"(?U)\S")).join(pdf, "doc_id", "left_semi")


def read_dataset(spark: SparkSession, path: str, schema: str | None = None, form: str | None = None) -> DataFrame:
    """A table in CSV (with a header), JSON lines, one JSON array (form json_array) or Parquet, by the end of its path if no form is given. Only Parquet needs no schema."""
    form = form or path.rstrip("/").rsplit(".", 1)[-1].lower()
    if form != "parquet" and schema is None:
        raise ValueError("files without a schema of their own need one")
    if form == "csv":
        return read_csv(spark, path, schema)
    if form in ("json", "jsonl"):
        return spark.read.schema(schema).json(path)
    if form == "json_array":
        return spark.read.schema(schema).option("multiLine", True).json(path)
    return spark.read.parquet(path)


def nth_file(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, id, extension) of the file at place n, from 0, by its order; documents with fewer files have no row."""
    by_order = F.array_sort(F.transform("files", lambda f: F.struct(f["order"].alias("order"), f["id"].alias("id"), f["extension"].alias("extension"))))
    return docs.select("doc_id", F.get(by_order, F.lit(n)).alias("file")).where("file is not null").select("doc_id", "file.id", "file.extension")


def list_pdfs(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length) of PDF files under a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", True).load(folder)
    return files.select("path", "length")


def letters(metadata: DataFrame, with_electronic: bool = False) -> DataFrame:
    """Letters, without those delivered electronically unless wanted."""
    kept = metadata.where(F.col("kind") == LETTER)
    return kept if with_electronic else kept.where(F.coalesce(F.col("delivery_type"), F.lit("")) != ELECTRONIC)


def last_pdf(files: DataFrame, existing: DataFrame) -> DataFrame:
    """Of each document the existing PDF of highest order. files: doc_id, id, order, extension; existing: id."""
    real = files.where(F.lower("extension") == ".pdf").join(existing, "id", "left_semi")
    return first_per_group(real, ["doc_id"], [F.col("order").desc(), F.col("id")])


def dedup_metadata(metadata: DataFrame) -> DataFrame:
    """What the search for twins of partners and employees needs of the metadata, without repeated rows."""
    return metadata.select("doc_id", "sender", "sender_id", "signer", "signer_id").dropDuplicates()


def pdf_paths(root: str, metadata: DataFrame, files: DataFrame, existing: DataFrame, with_electronic: bool = False) -> DataFrame:
    """(doc_id, path) of the PDF to read of each letter: the existing one of highest order, under root/doc_id; letters without one go. files: doc_id, id, order, extension; existing: id."""
    wanted = letters(metadata, with_electronic).select("doc_id").distinct()
    best = last_pdf(files.join(wanted, "doc_id", "left_semi"), existing)
    return best.select("doc_id", F.concat(F.lit(root.rstrip("/") + "/"), F.col("doc_id"), F.lit("/"), F.col("id"), F.col("extension")).alias("path"))


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, form: str = "parquet") -> None:
    writer = df.write.mode("overwrite").format(form)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)
