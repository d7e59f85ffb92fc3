"""Named queries over the test tables, each beside the SQL another engine answers it with."""

from tidemark.registry import changes, cleaning, kept, measures, profiles, sketched, stars, streams, tables  # noqa: F401
from tidemark.registry.base import REGISTRY  # noqa: F401
