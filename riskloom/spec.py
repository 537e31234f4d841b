"""The one configuration object: which columns play which role."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field


@dataclass(frozen=True)
class FeatureSpec:
    """Column roles of one record type.

    Raw names (as they arrive) appear in ``integer_fields``, ``double_fields``,
    ``renames``, ``keys`` and ``target``; every other entry uses the names that hold
    after renaming and normalising.
    """

    keys: tuple[str, ...]
    target: str
    label_order: tuple[str, ...]
    positive_label: str
    dropped_labels: tuple[str, ...] = ()
    integer_fields: tuple[str, ...] = ()
    double_fields: tuple[str, ...] = ()
    renames: dict[str, str] = field(default_factory=dict)
    drops: tuple[str, ...] = ()
    drop_patterns: tuple[str, ...] = ()
    pairs: dict[str, tuple[str, str]] = field(default_factory=dict)
    categorical: tuple[str, ...] = ()
    text_categorical: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()
    contradictions: tuple[str, ...] = ()
    bad_numeric: str = "quarantine"
    foreign_target: str = "unlabelled"
    standardise: str = "numbers"
    max_iter: int = 100
    tolerance: float = 1e-6
    aggregation_depth: int = 2

    def __post_init__(self):
        if self.positive_label not in self.label_order:
            raise ValueError(f"positive label {self.positive_label!r} is not in {self.label_order}")
        unknown = [d for d in self.dropped_labels if d not in self.label_order]
        if unknown:
            raise ValueError(f"dropped labels {unknown} are not in {self.label_order}")
        if len(self.class_labels) != 2:
            raise ValueError("exactly two labels must remain after dropping")
        if self.bad_numeric not in ("quarantine", "impute"):
            raise ValueError("bad_numeric is 'quarantine' or 'impute'")
        if self.foreign_target not in ("unlabelled", "error"):
            raise ValueError("foreign_target is 'unlabelled' or 'error'")
        if self.standardise not in ("numbers", "all"):
            raise ValueError("standardise is 'numbers' or 'all'")

    @property
    def class_labels(self) -> tuple[str, ...]:
        return tuple(v for v in self.label_order if v not in self.dropped_labels)

    @property
    def negative_label(self) -> str:
        return next(v for v in self.class_labels if v != self.positive_label)

    @property
    def record_fields(self) -> tuple[str, ...]:
        """Raw field names of a record without its keys and target."""
        return self.integer_fields + self.double_fields

    @property
    def features(self) -> tuple[str, ...]:
        return self.categorical + self.text_categorical + self.numeric

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> FeatureSpec:
        values = json.loads(text)
        for name, value in values.items():
            if isinstance(value, list):
                values[name] = tuple(value)
        values["pairs"] = {k: tuple(v) for k, v in values["pairs"].items()}
        return cls(**values)
