"""Parameters of a run: from a file, under defaults, with what is fixed for a small trial."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Parameters:
    """The published defaults."""

    min_k: int = 5
    max_k: int = 30
    random_state: int = 42
    umbral: float = 0.90
    mode: str = "MVP"
    trial_ids: tuple[int, ...] = field(default=(570, 413150))

    @property
    def ks(self) -> range:
        return range(self.min_k, self.max_k + 1)


#: Sections of a parameter file and what is taken from them.
SECTIONS = {"clustering": ("min_k", "max_k", "random_state"), "similitud": ("umbral",), "run": ("mode", "trial_ids")}


def parse(text: str) -> dict:
    """A JSON document, or YAML where a library for it is installed."""
    try:
        return json.loads(text) or {}
    except ValueError:
        pass
    try:
        import yaml
    except ImportError as e:
        raise ValueError("the parameters aren't JSON, and no library for YAML is installed") from e
    return yaml.safe_load(text) or {}


def read_parameters(spark: SparkSession, path: str) -> Parameters:
    """The parameters in a file that Spark can read; what it lacks has its default, sections and names beyond these are ignored.
    Values are checked: 2 <= min_k <= max_k, a threshold between -1 and 1, a known mode."""
    rows = spark.read.text(path, wholetext=True).collect()
    found = parse(rows[0][0]) if rows else {}
    given = {n: found[s][n] for s, names in SECTIONS.items() for n in names if isinstance(found.get(s), dict) and n in found[s]}
    if "trial_ids" in given:
        given["trial_ids"] = tuple(given["trial_ids"] or ())
    out = replace(Parameters(), **given)
    if not 2 <= out.min_k <= out.max_k or not -1 <= out.umbral <= 1 or out.mode not in ("MVP", "FULL"):
        raise ValueError(f"{path}: {out} can't be run")
    return out


def selected(df: DataFrame, key: str, params: Parameters) -> DataFrame:
    """All rows, or in a trial those of the ids that it names."""
    return df.where(F.col(key).isin(*params.trial_ids)) if params.mode == "MVP" else df
