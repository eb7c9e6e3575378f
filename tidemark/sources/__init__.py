from tidemark.sources.base import Source
from tidemark.sources.frames import FrameSource
from tidemark.sources.jdbc import JdbcSource

__all__ = ["FrameSource", "JdbcSource", "Source"]
