from areabook.streaming.republish import republish_on_arrival  # noqa: F401
