"""Column -> Column scalar helpers."""
from . import dates, keys, text  # noqa: F401
