from quorum.sources.catalog import SOURCES, Source, conform, source
from quorum.sources.scan import RunWindow, in_window, in_window_whole_seconds

__all__ = ["SOURCES", "Source", "conform", "source", "RunWindow", "in_window",
           "in_window_whole_seconds"]
