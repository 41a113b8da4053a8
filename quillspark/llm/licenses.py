"""License scans: canonical texts, hash-joined to the digests of known licenses.

Everything on the main path is DataFrame functions. The catalogue is a constant of this module, so its broadcast
has a proven bound; a larger one can be given as a DataFrame and is joined by shuffle on the digest.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.license_texts import DIGESTS, TEXTS

#: Lines that name a copyright holder and a year. They differ from copy to copy of a license.
COPYRIGHT_LINE = r"(^|\n)[^\n\p{L}\p{N}]*(copyright|©|\(c\))[^\n]*[0-9]{4}[^\n]*"
#: For the look-up of a license also lines with a sign after the word, and the phrase that reserves all rights, are left out.
HOLDER_LINE = r"(^|\n)[^\n\p{L}\p{N}]*((copyright|©|\(c\))[^\n]*[0-9]{4}|copyright[^\n\p{L}\p{N}]*(\(c\)|©)|©)[^\n]*"
RESERVED = "all rights reserved"
NOT_WORD = r"[^\p{L}\p{N}]+"
#: Spellings that count as equal, replaced in this order after lower-casing.
EQUIVALENT = (
    ("licence", "license"), ("organisation", "organization"), ("authorisation", "authorization"), ("favour", "favor"), ("modelling", "modeling"),
    ("acknowledgement", "acknowledgment"), ("fulfilment", "fulfillment"), ("per cent", "percent"), ("https://", "http://"), ("&", " and "),
)


def canonical(text: Column) -> Column:
    """Lower case, without copyright lines, one spelling, runs of anything but letters and digits as one space."""
    out = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "$1")
    for a, b in EQUIVALENT:
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.trim(F.regexp_replace(out, NOT_WORD, " "))


def canonical_text(text: str) -> str:
    """The same for a text of the catalogue, on the driver."""
    out = re.sub(r"(^|\n)(?:(?!\n)[\W_])*(copyright|©|\(c\))[^\n]*[0-9]{4}[^\n]*", r"\1", text.lower())
    for a, b in EQUIVALENT:
        out = out.replace(a, b)
    return re.sub(r"[\W_]+", " ", out).strip()


def look_up_digest(text: Column, digest: Column) -> Column:
    """SHA-256 of the form by which licenses are looked up: digest, that of the canonical form, unless there is more to leave out."""
    bare = canonical(F.replace(F.regexp_replace(F.lower(text), HOLDER_LINE, "$1"), F.lit(RESERVED), F.lit("")))
    return F.when(F.lower(text).rlike(f"copyright|©|{RESERVED}"), F.sha2(bare, 256)).otherwise(digest)


def look_up_text(text: str) -> str:
    """The form by which licenses are looked up, on the driver."""
    bare = re.sub(r"(^|\n)(?:(?!\n)[\W_])*((copyright|©|\(c\))[^\n]*[0-9]{4}|copyright(?:(?!\n)[\W_])*(\(c\)|©)|©)[^\n]*", r"\1", text.lower())
    return canonical_text(bare.replace(RESERVED, ""))


def look_up_digests() -> dict[str, str]:
    """SHA-256 of the form by which licenses are looked up to license id: the catalogue's texts and those known by digest."""
    return DIGESTS | {hashlib.sha256(look_up_text(text).encode()).hexdigest(): name for name, texts in TEXTS.items() for text in texts}


def known_digests() -> dict[str, str]:
    """SHA-256 of canonical text to license id."""
    return {hashlib.sha256(canonical_text(text).encode()).hexdigest(): name for name, texts in TEXTS.items() for text in texts}


def scan_licenses(docs: DataFrame, catalogue: DataFrame | None = None) -> DataFrame:
    """doc_id, text_digest, license_id (of the whole text, null if it is no known license) of every row of docs.

    The whole text is digested in canonical form; its license is looked up by look_up_digest. Null texts have null digests and no license; a text without a
    letter or digit has the digest of the empty text, which is no license. Repeated rows and null doc_ids stay as
    they are; other columns are not read. catalogue has digest and license_id; of equal digests the license that
    sorts first holds. An empty table gives no rows.
    """
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").alias("doc_id"), F.sha2(canonical(text), 256).alias("text_digest"), text.alias("text"))
    if catalogue is None:
        rows = rows.select("doc_id", "text_digest", look_up_digest(F.col("text"), F.col("text_digest")).alias("look_up"))
        known = F.broadcast(docs.sparkSession.createDataFrame(sorted(look_up_digests().items()), "look_up string, license_id string"))
        return rows.join(known, "look_up", "left").select("doc_id", "text_digest", "license_id")
    known = catalogue.groupBy(F.col("digest").alias("text_digest")).agg(F.min("license_id").alias("license_id"))
    return rows.join(known, "text_digest", "left").select("doc_id", "text_digest", "license_id")


def scan_notices(docs: DataFrame) -> DataFrame:
    """doc_id, line_no (from 0), license_id: the lines that are, in canonical form, a known text by themselves."""
    lines = docs.select("doc_id", F.posexplode(F.split(F.col("text").cast("string"), "\n")).alias("line_no", "line"))
    known = F.broadcast(docs.sparkSession.createDataFrame(sorted(look_up_digests().items()), "look_up string, license_id string"))
    digests = lines.select("doc_id", "line_no", look_up_digest(F.col("line"), F.sha2(canonical(F.col("line")), 256)).alias("look_up"))
    return digests.join(known, "look_up").select("doc_id", "line_no", "license_id")


def scan(docs: DataFrame) -> DataFrame:
    """Of every row of docs: doc_id, unit_no (-1: the whole text; else the line), digest and license_id of its
    canonical whole text, and of those lines that are a known notice by themselves. One pass over the texts.

    A row stands for a whole text even if no license is known for it; lines only if one is. Else as scan_licenses.
    """
    text = F.col("text").cast("string")
    units = docs.select(
        "doc_id", F.posexplode(F.concat(F.array(text), F.coalesce(F.split(text, "\n"), F.array().cast("array<string>")))).alias("place", "unit")
    )
    known = F.broadcast(docs.sparkSession.createDataFrame(sorted(look_up_digests().items()), "look_up string, license_id string"))
    digests = units.select("doc_id", (F.col("place") - 1).cast("int").alias("unit_no"), "unit", F.sha2(canonical(F.col("unit")), 256).alias("text_digest"))
    digests = digests.select("doc_id", "unit_no", "text_digest", look_up_digest(F.col("unit"), F.col("text_digest")).alias("look_up"))
    return (
        digests.join(known, "look_up", "left").where((F.col("unit_no") < 0) | F.col("license_id").isNotNull())
        .select("doc_id", "unit_no", "text_digest", "license_id")
    )


def scan_sql() -> str:
    """The same in DuckDB SQL over the view documents, but for what only look_up_digest leaves out and DIGESTS."""
    out = f"regexp_replace(lower(unit), '{COPYRIGHT_LINE}', '\\1', 'g')"
    for a, b in EQUIVALENT:
        out = f"replace({out}, '{a}', '{b}')"
    known = ", ".join(f"('{digest}', '{name}')" for digest, name in sorted(known_digests().items()))
    return f"""
    WITH units AS (
        SELECT doc_id, -1 AS unit_no, text AS unit FROM documents
        UNION ALL
        SELECT doc_id, unnest(range(len(parts)))::INT, unnest(parts) FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)),
    digests AS (SELECT doc_id, unit_no::INT AS unit_no, sha256(trim(regexp_replace({out}, '{NOT_WORD}', ' ', 'g'), ' ')) AS text_digest FROM units),
    known(digest, license_id) AS (VALUES {known})
    SELECT doc_id, unit_no, text_digest, license_id FROM digests LEFT JOIN known ON text_digest = digest
    WHERE unit_no < 0 OR license_id IS NOT NULL"""
