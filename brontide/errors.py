"""Errors raised by gates."""


class DataQualityError(ValueError):
    """A gate found data that must not be published."""
