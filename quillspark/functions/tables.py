"""The library's functions under SQL names: scalar functions, and table functions for LATERAL and PARTITION BY."""

from __future__ import annotations

from unicodedata import category

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, LongType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn

from quillspark.functions import similarity as S


class NamedValues:
    """named_values(array, 'a,b,c'): one row with the array's values as columns of these names; null where it is shorter, values behind the names go."""

    @staticmethod
    def analyze(values: AnalyzeArgument, names: AnalyzeArgument) -> AnalyzeResult:
        if not names.isConstantExpression or not names.value:
            raise ValueError("named_values needs the names as a constant text")
        kind: DataType = values.dataType.elementType
        out = StructType()
        for name in names.value.split(","):
            out = out.add(name.strip(), kind)
        return AnalyzeResult(out)

    def eval(self, values, names):
        width = len(names.split(","))
        yield tuple([*(values or []), *[None] * width][:width])


class CaseIslands:
    """case_islands(TABLE(...), 'key', 'place', 'text'): lines of one key, in the order of place, as islands of equal case class.

    The table function asks for its rows by key and in order; it holds one island at a time. Columns: the key, island (from 0), lines, text.
    """

    def __init__(self):
        self.key, self.island, self.upper, self.parts = None, 0, None, []

    @staticmethod
    def analyze(table: AnalyzeArgument, key: AnalyzeArgument, place: AnalyzeArgument, text: AnalyzeArgument) -> AnalyzeResult:
        kind = table.dataType[key.value].dataType
        schema = StructType().add(key.value, kind).add("island", LongType()).add("lines", LongType()).add("text", StringType())
        return AnalyzeResult(schema, partitionBy=[PartitioningColumn(key.value)], orderBy=[OrderingColumn(place.value)])

    def eval(self, row, key, place, text):
        line = row[text]
        upper = line is not None and 2 * sum(category(c) == "Lu" for c in line) > len(line)
        if self.parts and upper != self.upper:
            yield self._made()
        self.key, self.upper = row[key], upper
        self.parts.append(line or "")

    def terminate(self):
        if self.parts:
            yield self._made()

    def _made(self):
        out = (self.key, self.island, len(self.parts), " ".join(self.parts))
        self.island, self.parts = self.island + 1, []
        return out


class Ngrams:
    """word_ngrams(text, n): the place (from 0) and the text of each run of n words between white space."""

    def eval(self, text: str, n: int):
        words = (text or "").split()
        for i in range(len(words) - n + 1):
            yield i, " ".join(words[i : i + n])


SCALARS = {
    "indel_ratio": S.indel, "token_sort_ratio": S.token_sort, "partial_ratio": S.partial, "weighted_ratio": S.weighted, "jaro_winkler": S.jaro_winkler,
}


def register(spark: SparkSession) -> None:
    """Makes the functions known to the session's SQL: the string similarities as Arrow functions, and the three table functions."""
    for name, f in SCALARS.items():
        spark.udf.register(name, S.as_udf(f))
    spark.udtf.register("named_values", F.udtf(NamedValues))
    spark.udtf.register("case_islands", F.udtf(CaseIslands))
    spark.udtf.register("word_ngrams", F.udtf(Ngrams, returnType="place bigint, gram string"))

