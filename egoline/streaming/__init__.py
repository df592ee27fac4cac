from egoline.streaming.landing import land_topics, topic_stream  # noqa: F401
