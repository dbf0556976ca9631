"""foliomill: DataFrame operators over parsed, paginated documents."""

__version__ = "0.1.0"
