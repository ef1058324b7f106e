"""Errors that stop a run."""


class DataQualityError(Exception):
    """Data that must not go further: missing columns, or a failed check of severity error."""


class ExtractionError(Exception):
    """A raw source is missing, incomplete or malformed."""


class PublishError(Exception):
    """A batch that cannot be published, such as one that repeats a key."""
