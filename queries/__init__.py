"""Registered queries: each Spark query next to the SQL that checks it."""

from .base import ORACLE, QUERIES  # noqa: F401
from . import table_functions, statistics, corpus, mixed, prompts, training  # noqa: F401,E402
