"""Settings of the explanation and drift stage, from a JSON file, checked before anything runs."""

from __future__ import annotations

import json
from dataclasses import dataclass, fields

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Settings:
    """fraction, cap: of the equal-class sample; least_importance: below it a feature is dropped; threshold, rows: of drift; top, borderline: cases that are explained."""

    fraction: float = 0.001
    cap: int = 50_000
    least_importance: float = 0.001
    threshold: float = 0.10
    rows: int = 10_000
    top: int = 100
    borderline: int = 50
    seed: int = 42

    def __post_init__(self) -> None:
        wrong = [f"{n} is not over 0" for n in ("fraction", "cap", "threshold", "rows", "top") if getattr(self, n) <= 0]
        wrong += [f"{n} is not within 0 and 1" for n in ("fraction", "least_importance") if not 0 <= getattr(self, n) <= 1]
        wrong += ["borderline is below 0"] if self.borderline < 0 else []
        if wrong:
            raise ValueError("; ".join(wrong))


def load(spark: SparkSession, path: str) -> Settings:
    """Names that are no setting are refused."""
    found = json.loads("\n".join(r[0] for r in spark.read.text(path).collect()))
    unknown = set(found) - {f.name for f in fields(Settings)}
    if unknown:
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
    return Settings(**found)
