"""DataFrame → DataFrame operators (no actions except model fits)."""

from . import behaviour, charts, common, models, prep, sampling, sentiment, weather  # noqa: F401
