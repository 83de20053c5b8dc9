"""All queries, registered on import."""

from waybill.plans import comparison, documents, extraction, validation  # noqa: F401
from waybill.plans.catalog import CATALOG

__all__ = ["CATALOG"]
