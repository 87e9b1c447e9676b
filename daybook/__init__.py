"""daybook: daily and monthly sales reporting on Apache Spark."""

from daybook.context import RunContext

__all__ = ["RunContext"]
