"""Parameters from a YAML file: estimators and thresholds of each field, shares of the split, paths of reference tables."""

from __future__ import annotations

from dataclasses import dataclass, field, fields

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.operators import evaluate, labelling

#: Names of the two estimators.
JARO, SORTED = "jaro_winkler", "lev_distance"


@dataclass(frozen=True)
class Settings:
    """Names in the file are those of the fields, in any case; others are ignored. assets maps a table's name to its path."""

    rs: int = 42
    lev_distance: float = 60.0
    row_df_limit: int = 500_000
    estimator_sender: str = JARO
    estimator_signer: str = SORTED
    sim_val_signer: float = 70.0
    sim_val_sender: float = 60.0
    max_size_pdf: int = 10_000_000
    assets: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        for name in ("estimator_sender", "estimator_signer"):
            if getattr(self, name) not in (JARO, SORTED):
                raise ValueError(f"{name} is {JARO} or {SORTED}")


def parsed(text: str) -> Settings:
    """Settings of a YAML text; an empty one has the defaults."""
    raw = {str(k).lower(): v for k, v in (yaml.safe_load(text) or {}).items()}
    known = {f.name: raw[f.name] for f in fields(Settings) if f.name in raw and f.name != "assets"}
    assets = {name: entry["path"] for name, entry in (raw.get("assets") or {}).items() if isinstance(entry, dict) and "path" in entry}
    kinds = {f.name: type(f.default) for f in fields(Settings) if f.name != "assets"}
    return Settings(**{k: kinds[k](v) for k, v in known.items()}, assets=assets)


def read_settings(spark: SparkSession, path: str) -> Settings:
    """Settings of a file that Spark can read."""
    row = spark.read.text(path, wholetext=True).first()
    return parsed(row.value if row else "")


def mark_senders(blocks: DataFrame, truth: DataFrame, settings: Settings) -> DataFrame:
    return labelling.mark_senders(blocks, truth, jaro=settings.estimator_sender == JARO)


def mark_signers(blocks: DataFrame, truth: DataFrame, settings: Settings) -> DataFrame:
    return labelling.mark_signers(blocks, truth, settings.lev_distance, settings.estimator_signer == JARO)


def accepted(validated: DataFrame, settings: Settings, entity: str) -> DataFrame:
    """Share of the letters of validate_senders or validate_signers whose similarity is over the settings' threshold."""
    least = settings.sim_val_sender if entity == "sender" else settings.sim_val_signer
    return validated.agg(evaluate.share(F.col("similarity") >= least).alias("share"))

