"""Crop-yield data jobs on PySpark: lazy DataFrame operators, sources, plans and streams."""

from agrospark.session import configure, get_session

__all__ = ["configure", "get_session"]
