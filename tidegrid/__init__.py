"""tidegrid: event feeds to complete hour grids, profiles, models and revenue, on Spark."""

from tidegrid.session import session

__all__ = ["session"]
