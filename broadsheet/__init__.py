"""News-stream analytics as PySpark DataFrame and Structured Streaming operators."""

from broadsheet.config import ValidationConfig, WindowSpec

__all__ = ["ValidationConfig", "WindowSpec"]
