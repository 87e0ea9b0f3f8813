"""Column functions: plain ``Column -> Column`` builders over built-in Spark SQL."""

from pawprint.functions import temporal, text

__all__ = ["temporal", "text"]
