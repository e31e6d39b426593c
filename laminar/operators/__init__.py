"""Relational operators of the refined layer."""

from laminar.operators.bands import DEFAULT_BANDS, Bands, band_counts, band_shares
from laminar.operators.correlation import socio_correlation
from laminar.operators.latest import latest_batch
from laminar.operators.profile import state_profile

__all__ = ["DEFAULT_BANDS", "Bands", "band_counts", "band_shares", "socio_correlation", "latest_batch",
           "state_profile"]
