"""Structured Streaming form of the resumable embedding run."""

from annofold.streaming.embed_stream import start_embedding_stream

__all__ = ["start_embedding_stream"]
