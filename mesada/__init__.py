"""mesada: monthly loan-disbursement and transfer reports as Spark DataFrames."""

from mesada.plans.reports import (
    disbursement_detail,
    disbursement_totals,
    end_date_report,
    start_date_report,
    transfer_detail,
    transfer_totals,
)
from mesada.operators.calendar import business_calendar, report_calendar
from mesada.profiles import DRAFT, PROFILES, V1, V2, Profile

__all__ = [
    "DRAFT",
    "PROFILES",
    "V1",
    "V2",
    "Profile",
    "business_calendar",
    "disbursement_detail",
    "disbursement_totals",
    "end_date_report",
    "report_calendar",
    "start_date_report",
    "transfer_detail",
    "transfer_totals",
]
