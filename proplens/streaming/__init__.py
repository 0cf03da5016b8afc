from proplens.streaming.ingest import clean_feed, start_feed_ingest  # noqa: F401
