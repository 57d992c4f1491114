"""Named queries over the sample tables, each with the SQL it must agree with."""

from . import (aggregates, features, incremental, joins_windows, models, projections, quality, reports_clinical,
               reports_gold, reports_monitoring, scans, streams)
from .base import ORACLES, QUERIES, Tables

__all__ = ["ORACLES", "QUERIES", "Tables", "aggregates", "features", "incremental", "joins_windows", "models",
           "projections", "quality", "reports_clinical", "reports_gold", "reports_monitoring", "scans", "streams"]
