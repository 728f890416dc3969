"""Schema-driven event loading on Spark."""

from sluiceway.streaming.loader import MissingSchemaError, configure, load_batch, load_lines, run_stream

__all__ = ["MissingSchemaError", "configure", "load_batch", "load_lines", "run_stream"]
