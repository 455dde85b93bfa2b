"""Column expressions: text, dates, exact rounding."""

from tradecast.functions import dates, numeric, text  # noqa: F401
