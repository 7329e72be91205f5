"""Spark jobs over saved web responses and keyed, ordered series."""

from tidegrid.operators.series import Series
from tidegrid.session import build_session

__all__ = ["Series", "build_session"]
