"""Errors of the library."""

from __future__ import annotations

from typing import Any


class SilverbrookError(Exception):
    """Base of all; ``details`` is kept for logs."""

    def __init__(self, message: str, details: dict[str, Any] | None = None):
        super().__init__(message)
        self.message, self.details = message, dict(details or {})

    def __str__(self) -> str:
        return f"{self.message} {self.details}" if self.details else self.message


class ConfigError(SilverbrookError):
    """A setting is missing or wrong."""


class SourceError(SilverbrookError):
    """Data could not be read."""


class SinkError(SilverbrookError):
    """Data could not be written."""


class TransformError(SilverbrookError):
    """An operator was given columns or parameters that don't fit."""


class QualityError(SilverbrookError):
    """Checks failed."""


class SchemaError(SilverbrookError):
    """A schema isn't the one asked for."""
