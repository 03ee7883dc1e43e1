"""Imports every module that registers queries."""

from . import dictionary, extraction, indicators, named, parsers, relational, shapes  # noqa: F401
