"""A fitted transformer: named output expressions over named input columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame


@dataclass(frozen=True)
class FittedStep:
    """What a fit leaves behind. Applying it is one projection, on batch tables and streams alike."""

    name: str
    kind: str
    inputs: tuple[str, ...]
    outputs: Mapping[str, Column]
    params: Mapping[str, str] = field(default_factory=dict)
    levels: Mapping[str, Sequence[float]] | None = None  # all values an output can take, where they are few

    @property
    def features(self) -> tuple[str, ...]:
        return tuple(self.outputs)

    def apply(self, df: DataFrame) -> DataFrame:
        replaced = {*self.inputs, *self.outputs}
        kept = [c for c in df.columns if c not in replaced]
        return df.select(*kept, *[e.alias(name) for name, e in self.outputs.items()])


def as_params(values: Mapping[str, object]) -> dict[str, str]:
    return {k: str(v) for k, v in values.items()}
