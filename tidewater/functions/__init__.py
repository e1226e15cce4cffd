"""Column expressions."""

from tidewater.functions.columns import *  # noqa: F401,F403
