from tickflow.functions import change, jsoncols, temporal  # noqa: F401
