"""Reference tables: cleaning of partners and employees, and duplicate partners."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions import text as T
from quillspark.operators.resolve import fuzzy_pairs

#: Fixed values.
PARTNER_STOP = ("физлица", "новые", "#новые", "test", "тест")
SURNAME_STOP = ("подписант", "руководитель", "специалист", "получатель", "фамилия", "фио")
ONE_LETTER = ("Ю", "Е", "О", "И")


def clean_partners(partners: DataFrame) -> DataFrame:
    """Partners of type 0 known to be available, once each, in lower case; no numbers, placeholders or names under three characters."""
    out = partners.where("partner_type = 0 and not partner_not_available").dropDuplicates(["partner_id", "partner_name"])
    out = out.withColumn("partner_name", F.lower("partner_name")).withColumn("partner_full_name", F.lower("partner_full_name"))
    out = out.na.drop(subset=["partner_name"]).where(F.col("partner_name").try_cast("double").isNull())
    return out.where(~F.col("partner_name").isin(*PARTNER_STOP) & (F.length("partner_name") >= 3))


def clean_employees(employees: DataFrame) -> DataFrame:
    """Surname and initials from names whose first and middle names are stored the wrong way round."""
    known = employees.na.drop(subset=["last_name"])
    swapped = known.withColumns({"first_name": F.col("middle_name"), "middle_name": F.col("first_name")})  # both from the row as it was
    out = swapped.withColumns({c: T.letters_only(F.col(c)) for c in ("last_name", "first_name", "middle_name")})
    out = out.withColumns({c: F.upper(F.substring(c, 1, 1)) for c in ("first_name", "middle_name")}).withColumn("last_name", F.initcap("last_name"))
    return out.where(~F.lower("last_name").isin(*SURNAME_STOP) & ((F.length("last_name") > 1) | F.col("last_name").isin(*ONE_LETTER)))


def twins(partners: DataFrame, least: float = 95.0) -> DataFrame:
    """(partner_id, twin_id, sim): other partners whose name is, with sorted tokens, more than `least` similar."""
    names = partners.select("partner_id", "partner_name")
    pairs = fuzzy_pairs(names, "partner_name", names.select(F.col("partner_name").alias("twin_name")), "twin_name", least).where(F.col("sim") > least)
    other = names.select(F.col("partner_id").alias("twin_id"), F.col("partner_name").alias("twin_name"))
    return names.join(pairs, "partner_name").join(other, "twin_name").where("partner_id <> twin_id").select("partner_id", "twin_id", "sim")


def unused_twins(found: DataFrame, truth: DataFrame) -> DataFrame:
    """Twins that are no sender in the truth table, once for each partner that sees them."""
    return found.join(truth.select(F.col("sender_id").alias("twin_id")).distinct(), "twin_id", "left_anti").select("twin_id")


def used_twins(found: DataFrame, truth: DataFrame) -> DataFrame:
    """Twins that are a sender in the truth table."""
    return found.join(truth.select(F.col("sender_id").alias("twin_id")).distinct(), "twin_id", "left_semi").select("twin_id")


def twin_counts(partners: DataFrame, found: DataFrame) -> DataFrame:
    """(partner_id, n_twins) of every partner, 0 where there is none."""
    n = found.groupBy("partner_id").agg(F.countDistinct("twin_id").alias("n_twins"))
    return partners.select("partner_id").distinct().join(n, "partner_id", "left").na.fill(0, ["n_twins"])
