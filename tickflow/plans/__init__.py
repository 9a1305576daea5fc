"""Named queries. Importing this package registers every plan module."""

from tickflow.plans import (evaluation, files, models, payloads, series, signals,  # noqa: F401
                            streams, tables)
from tickflow.plans.registry import QUERIES  # noqa: F401
