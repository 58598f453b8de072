"""Operators for large-scale training-data pipelines. Nothing else in the library imports this subpackage."""

from titlewright.session import ship_code

ship_code()
