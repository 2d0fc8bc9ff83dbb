"""deskmill: DataFrame operators for the exported records of an office suite."""

from deskmill.session import configure, durable_cut

__all__ = ["configure", "durable_cut"]
