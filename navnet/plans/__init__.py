"""Query plans: the driver's catalogue and what it registers."""

from . import catalogue, network  # noqa: F401  both fill the catalogue's tables of queries
