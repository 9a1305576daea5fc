from tickflow.streaming import stream  # noqa: F401
