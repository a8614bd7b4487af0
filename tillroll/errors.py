"""Errors raised by the library."""


class SourceNotFoundError(FileNotFoundError):
    """The raw input path does not exist."""


class MissingColumnsError(ValueError):
    """The raw input lacks required columns."""


class DataQualityError(ValueError):
    """Transformed or staged data broke a validation rule."""


class FactNotPublishedError(LookupError):
    """A report was asked of a table that has no published version."""


class ConcurrentLoadError(RuntimeError):
    """Other loads published new versions as often as this one tried to."""


class EtlError(RuntimeError):
    """The load job stopped; ``steps`` tells how far it came."""

    def __init__(self, message, steps):
        super().__init__(message)
        self.steps = steps
