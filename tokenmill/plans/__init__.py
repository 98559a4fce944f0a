"""Composed jobs (``jobs``), driver-table shapes (``tables``) and the
registered queries with their SQL oracles (``registry``, ``q_*``)."""
