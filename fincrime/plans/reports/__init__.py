"""The ten parameterised reports, each ``report(warehouse, params) -> DataFrame``."""

from fincrime.plans.reports.aml import aml_evidence
from fincrime.plans.reports.arrears import arrears
from fincrime.plans.reports.card_search import card_search
from fincrime.plans.reports.case_lookup import case_lookup
from fincrime.plans.reports.client_lookup import client_lookup
from fincrime.plans.reports.contra import staff_from_stopped
from fincrime.plans.reports.employer import employer_accounts
from fincrime.plans.reports.incidents import latest_incidents
from fincrime.plans.reports.missed_fraud import missed_fraud
from fincrime.plans.reports.tollgate import tollgate

__all__ = ["aml_evidence", "arrears", "card_search", "case_lookup", "client_lookup",
           "staff_from_stopped", "employer_accounts", "latest_incidents", "missed_fraud", "tollgate"]
