"""Query plans over the driver tables: role bindings, registered queries, SQL twins."""


def load_all():
    """Import every query module so the registry is filled; returns it."""
    from . import q_panel, q_reports, q_misc, q_ml, q_signal  # noqa: F401
    from .registry import QUERIES

    return QUERIES
