"""Settings of a run; unknown keys of a settings file are ignored, values are checked."""

from __future__ import annotations

import json
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class EngineConfig:
    dataset_id: str = "dataset"
    run_id: str = "run"
    kg_base: str = "https://graph.example.org/kg#"
    fuzzy_threshold: float = 0.92
    least_confidence: float = 0.5
    inference_rounds: int = 3
    reasoning: bool = True
    most_unknown: float = 0.02
    strict_provenance: bool = False
    output_format: str = "parquet"
    triple_format: str = "nt"
    fail_on_shapes: bool = False
    strict_predicates: bool = False
    consolidate: bool = True

    def check(self) -> list[str]:
        bad = [n for n in ("fuzzy_threshold", "least_confidence", "most_unknown") if not 0 <= getattr(self, n) <= 1]
        if self.inference_rounds < 0:
            bad.append("inference_rounds")
        if self.output_format not in ("parquet", "json"):
            bad.append("output_format")
        if self.triple_format not in ("nt", "ttl", "jsonld", "xml"):
            bad.append("triple_format")
        return bad


def load(path: str | None) -> EngineConfig:
    if not path:
        return EngineConfig()
    with open(path, encoding="utf-8") as f:
        given = json.load(f)
    known = {f.name for f in fields(EngineConfig)}
    config = EngineConfig(**{k: v for k, v in given.items() if k in known})
    if bad := config.check():
        raise ValueError(f"settings out of range: {', '.join(bad)}")
    return config


def save(config: EngineConfig, path: str) -> None:
    with open(path, "w", encoding="utf-8") as f:
        json.dump({f.name: getattr(config, f.name) for f in fields(config)}, f, indent=2)
