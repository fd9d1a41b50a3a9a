"""tracklab: Spark jobs for audio-feature tables and their text companions."""

__version__ = "0.1.0"
