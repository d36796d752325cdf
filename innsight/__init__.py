"""Hotel-review analytics on Spark."""

from innsight.api import HotelReviews

__all__ = ["HotelReviews"]
