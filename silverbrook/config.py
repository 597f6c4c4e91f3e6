"""Settings: from the environment, and from YAML files by domain, pipeline and environment."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from silverbrook.errors import ConfigError

ENVIRONMENTS = ("dev", "staging", "prod")
_VARIABLE = re.compile(r"\$\{(\w+)(?::-([^}]*))?\}")


@dataclass(frozen=True)
class Settings:
    environment: str = "dev"
    app_name: str = "silverbrook"
    master: str | None = None
    shuffle_partitions: int = 200
    spark: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.environment not in ENVIRONMENTS:
            raise ConfigError("unknown environment", {"environment": self.environment})

    @classmethod
    def from_environment(cls, variables: Mapping[str, str] | None = None, prefix: str = "SILVERBROOK_") -> Settings:
        """``SILVERBROOK_ENVIRONMENT`` and so on."""
        have = os.environ if variables is None else variables
        read = {n: have[prefix + n.upper()] for n in ("environment", "app_name", "master", "shuffle_partitions") if prefix + n.upper() in have}
        if "shuffle_partitions" in read:
            read["shuffle_partitions"] = int(read["shuffle_partitions"])
        return cls(**read)


def _expanded(value: Any, variables: Mapping[str, str]) -> Any:
    if isinstance(value, str):
        def one(m: re.Match) -> str:
            if m[1] in variables:
                return variables[m[1]]
            if m[2] is None:
                raise ConfigError("variable is not set", {"variable": m[1]})
            return m[2]

        return _VARIABLE.sub(one, value)
    if isinstance(value, dict):
        return {k: _expanded(v, variables) for k, v in value.items()}
    if isinstance(value, list):
        return [_expanded(v, variables) for v in value]
    return value


class PipelineConfig:
    """A YAML file ``folder/domain/environment.yaml``; ``${NAME}`` and ``${NAME:-default}`` are filled in."""

    def __init__(self, values: Mapping[str, Any]):
        self.values = dict(values)

    @classmethod
    def load(cls, folder: str | Path, domain: str, environment: str = "dev", variables: Mapping[str, str] | None = None) -> PipelineConfig:
        import yaml

        path = Path(folder) / domain / f"{environment}.yaml"
        if not path.exists():
            raise ConfigError("no such file", {"path": str(path)})
        return cls(_expanded(yaml.safe_load(path.read_text()) or {}, os.environ if variables is None else variables))

    def get(self, name: str, default: Any = None) -> Any:
        """A value by its dotted name."""
        at: Any = self.values
        for part in name.split("."):
            if not isinstance(at, Mapping) or part not in at:
                return default
            at = at[part]
        return at

    def require(self, name: str) -> Any:
        found = self.get(name, self)
        if found is self:
            raise ConfigError("setting is missing", {"name": name})
        return found
