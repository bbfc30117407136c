"""visitflow: listing-operations analytics as lazy Spark DataFrame jobs.

    from visitflow import Params, read_roles, reports, outbox
    t = read_roles(spark, {"visit_log": "db.visits", "property_master": "db.master", ...})
    reports.visits_tomorrow(t, Params(as_of=datetime.date(2026, 4, 23), visit_types=("...",), visit_categories=("...",), report_sender="...")).show()
"""

from .params import Params  # noqa: F401
from .plans import outbox, reports  # noqa: F401
from .plans.daily import run_daily  # noqa: F401
from .plans.materialize import materialize_roles  # noqa: F401
from .sources.roles import read_roles  # noqa: F401

__version__ = "0.1.0"
