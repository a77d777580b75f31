"""Preparation and scoring of multilingual OCR training data as Spark jobs."""

from glyphmill.config import PrepConfig
from glyphmill.operators.chunks import plan_chunks
from glyphmill.operators.evaluate import evaluate
from glyphmill.operators.manifest import render_manifest
from glyphmill.operators.splits import split_and_shard

__all__ = ["PrepConfig", "evaluate", "plan_chunks", "render_manifest", "split_and_shard"]
