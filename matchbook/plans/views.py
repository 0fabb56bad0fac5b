"""The built tables as SQL views, dimensions also under their role names."""

from __future__ import annotations

from matchbook.plans.metrics import ROLES
from matchbook.schemas import COLUMNS


def register_views(tables) -> list[str]:
    """Temporary views for ``spark.sql``: every table, and e.g. ``batters`` or ``home_teams``."""
    names = {table: table for table in COLUMNS} | {role: table for role, (table, _) in ROLES.items()}
    for view, table in names.items():
        getattr(tables, table).createOrReplaceTempView(view)
    return sorted(names)
