"""Build, lay out, refresh and verify denormalised read tables on Spark."""

from tidemark.config import BatchConfig, GenerationConfig, OutputSpec, WatermarkPolicy

__all__ = ["BatchConfig", "GenerationConfig", "OutputSpec", "WatermarkPolicy"]
