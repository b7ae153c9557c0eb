"""Structured Streaming scoring."""

from churnspark.streaming.scoring import score_stream, scoring_plan, stream_output

__all__ = ["score_stream", "scoring_plan"]
