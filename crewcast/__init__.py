"""Job-duration forecasting and crew allocation as Spark jobs."""

from crewcast.params import Params

__all__ = ["Params"]
