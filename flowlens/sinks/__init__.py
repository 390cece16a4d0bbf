"""Writers for report sets."""

from flowlens.sinks.reports import publish_reports, read_reports, write_reports

__all__ = ["publish_reports", "read_reports", "write_reports"]
