from quorum.streaming.incremental import recompute_touched, stream_recompute, tumbling_counts

__all__ = ["recompute_touched", "stream_recompute", "tumbling_counts"]
