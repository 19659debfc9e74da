from bankflow.streaming.available_now import stream_scd1, stream_scd2

__all__ = ["stream_scd1", "stream_scd2"]
