"""Errors raised to the caller. Operators stay lazy; only the explicit checks raise."""


class SchemaValidationError(Exception):
    """Required columns are missing from an input frame."""


class SourceError(Exception):
    """An input path is absent or has a format the readers do not know."""


class SinkError(Exception):
    """An output format is not available in this Spark installation."""


class QualityGateError(Exception):
    """One or more quality checks failed on a table about to be published."""
