"""Ready-made catalogues."""

from rowguard.catalogs.yellow_taxi import YELLOW_TAXI

__all__ = ["YELLOW_TAXI"]
