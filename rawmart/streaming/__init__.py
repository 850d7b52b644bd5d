from rawmart.streaming.stream import stream_upsert  # noqa: F401
