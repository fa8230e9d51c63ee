"""What a step hands back."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation


@dataclass
class StepResult:
    """``rows`` flows to the next step; ``outputs`` are side frames (log rows, edges);
    ``counters`` fill when an action runs over ``rows``; ``warnings`` are known at once."""

    rows: DataFrame
    outputs: dict[str, DataFrame] = field(default_factory=dict)
    counters: dict[str, Observation] = field(default_factory=dict)
    warnings: list[str] = field(default_factory=list)
