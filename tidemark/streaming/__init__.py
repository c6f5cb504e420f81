from tidemark.streaming.audit import audited_stream
from tidemark.streaming.transform import stream_transform

__all__ = ["audited_stream", "stream_transform"]
