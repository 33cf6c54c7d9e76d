"""Registered queries: each operator run over whole tables, with an equivalent SQL text where one exists."""

from tabwright.catalog.registry import ENTRIES, Entry  # noqa: F401
from tabwright.catalog import (  # noqa: F401,E402  (importing registers the entries)
    flagship, basics, cleaning, profiling, blocks, imputing, encoding, splitting, correlating, describing, evaluating, modelling,
)
