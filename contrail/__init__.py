"""contrail: flight movement analytics as composable Spark DataFrame functions."""

from contrail.config import Settings
from contrail.session import build_session

__all__ = ["Settings", "build_session"]
