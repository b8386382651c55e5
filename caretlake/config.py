"""Settings: defaults, strict loading, a hash of what is in force."""

from __future__ import annotations

import dataclasses
import hashlib
import json
import re
from dataclasses import dataclass, field

from caretlake.functions.regexes import re2_to_java
from caretlake.operators import discovery as D
from caretlake.operators.golexer import WEIGHTS


@dataclass(frozen=True)
class Sampling:
    weights: dict = field(default_factory=lambda: dict(WEIGHTS))
    per_line: int = 2
    per_file: int = 300
    prefix_max: int = 4
    max_line: int = 240
    min_target: int = 1
    max_target: int = 200
    trivial_keep: float = 0.05
    examples: int = 25
    keep: float = 1.0
    test_keep: float = 1.0
    repo_cap: int = 0


@dataclass(frozen=True)
class Config:
    seed: int = 20261009
    allowed: list | None = None  # licences; without a list every licence passes
    build_excluded: str = "keep"
    markers: list = field(default_factory=lambda: list(D.MARKERS))
    secrets: list = field(default_factory=lambda: list(D.SECRETS))
    max_bytes: int = 1 << 20
    max_line_bytes: int = 2000
    left_units: int = 6000
    right_units: int = 1000
    evaluation: float = 0.02
    test: float = 0.02
    sampling: Sampling = field(default_factory=Sampling)

    def check(self) -> Config:
        """Raises ValueError for unknown caret kinds, bad patterns and fractions outside [0, 1]."""
        if unknown := set(self.sampling.weights) - set(WEIGHTS):
            raise ValueError(f"unknown caret kinds: {sorted(unknown)}")
        for p in [*self.markers, *self.secrets]:
            try:
                re.compile(re2_to_java(p).replace(r"\z", r"\Z"))
            except re.error as e:
                raise ValueError(f"bad pattern {p!r}: {e}") from e
        if self.build_excluded not in ("keep", "skip"):
            raise ValueError("build_excluded must be keep or skip")
        for name, v in (("keep", self.sampling.keep), ("test_keep", self.sampling.test_keep), ("trivial_keep", self.sampling.trivial_keep), ("evaluation", self.evaluation), ("test", self.test)):
            if not 0 <= v <= 1:
                raise ValueError(f"{name} must lie in [0, 1]")
        return self

    def sha256(self) -> str:
        return hashlib.sha256(json.dumps(dataclasses.asdict(self), sort_keys=True).encode()).hexdigest()


def load(text: str) -> Config:
    """Settings over the defaults; fields that do not exist are errors."""
    raw = json.loads(text)
    part = raw.pop("sampling", {})
    for cls, given in ((Config, raw), (Sampling, part)):
        if unknown := set(given) - {f.name for f in dataclasses.fields(cls)}:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
    return Config(sampling=Sampling(**part), **raw).check()
