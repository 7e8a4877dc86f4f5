"""Value lists the generator draws from.

Fixed values: generated tables only come out the same everywhere if these lists, their
order and their lengths stay as they are.  Pass another ``Vocabulary`` to generate
different content.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values -----------------------------------------------------------------

DEPARTMENT_NAMES = (
    "Payments Engineering", "Regulatory Reporting Technology", "Global Markets Technology",
    "Securities Services Platform", "Treasury Services Technology", "Trade Finance Engineering",
    "Liquidity Risk Technology", "Wholesale Payments Core", "Real Time Payments",
    "ACH and Wires Platform", "SWIFT Connectivity", "Client Onboarding Technology",
    "Reference Data Services", "Market Risk Analytics", "Credit Risk Technology",
    "Counterparty Risk Platform", "Collateral Management Tech", "Clearing and Settlement",
    "Custody Platform Engineering", "Fund Services Technology", "Middle Office Platform",
    "Post Trade Processing", "Equities Electronic Trading", "Fixed Income Trading Tech",
    "FX Trading Platform", "Commodities Technology", "Rates Technology",
    "Derivatives Processing", "Prime Brokerage Tech", "Research Platform Engineering",
    "Regulatory Change Delivery", "CCAR and Stress Testing", "Basel Reporting Platform",
    "MiFID Reporting Engineering", "EMIR and SFTR Reporting", "Transaction Reporting Ops Tech",
    "Financial Crime Technology", "Sanctions Screening Platform", "AML Analytics",
    "KYC Platform Engineering", "Fraud Detection Engineering", "Cyber Data Platform",
    "Identity and Access Engineering", "Infrastructure Observability", "Site Reliability Engineering",
    "Network Services Engineering", "Cloud Platform Services", "Container Platform Engineering",
    "Data Platform Engineering", "Data Governance Technology", "Metadata and Lineage Services",
    "Enterprise Data Warehouse", "Streaming Platform Engineering", "Machine Learning Platform",
    "Quantitative Research Tech", "Client Reporting Technology", "Digital Channels Engineering",
    "API Gateway Services", "Corporate Functions Technology", "Finance Systems Engineering",
)

FIRST_NAMES = (
    "Aarav", "Priya", "Chen", "Maria", "James", "Fatima", "Daniel", "Yuki", "Omar", "Sofia",
    "Liam", "Ananya", "Wei", "Isabella", "Noah", "Zara", "Ethan", "Mei", "Rahul", "Elena",
    "Marcus", "Nadia", "Hiroshi", "Camila", "Tobias", "Lakshmi", "Dmitri", "Amara", "Felix", "Ingrid",
)

LAST_NAMES = (
    "Sharma", "Okafor", "Zhang", "Rodriguez", "Whitfield", "Al-Rashid", "Kowalski", "Tanaka",
    "Haddad", "Moreau", "Sullivan", "Iyer", "Liu", "Rossi", "Andersen", "Khan", "Brennan",
    "Nakamura", "Kedia", "Papadopoulos", "Volkov", "Mensah", "Lindqvist", "Ferreira",
    "Castellanos", "Nguyen", "Berhane", "Fitzgerald", "Yamamoto", "Dubois",
)

LOCATION_CODES = (
    "NYC1", "JRC1", "CMH1", "PLN1", "CHI1", "TPA1", "WLM1",
    "LDN1", "BMH1", "GLA1", "DUB1",
    "MUM1", "HYD1", "BLR1", "SGP1", "HKG1", "TOK1", "SYD1",
    "BUE1", "SAO1",
)

SALARY_BANDS = ("B1", "B2", "B3", "B4", "B5", "B6", "B7")

DIVISIONS = (
    "Commercial & Investment Bank", "Markets", "Securities Services", "Payments",
    "Corporate Functions",
)

COST_CENTER_PREFIX = "CC-"
COST_CENTER_BASE = 400_000
COST_CENTER_SPAN = 99_999
COST_CENTER_DIGITS = 6

# Salts: each makes one independent draw out of the same key.
SALT_HEAD_FIRST = "head_fn"
SALT_HEAD_LAST = "head_ln"
SALT_COST_CENTER = "cc"
SALT_DIVISION = "div"
SALT_IS_HOT = "skew"
SALT_HOT_KEY = "top"
SALT_ANY_KEY = "dept"
SALT_FIRST = "fn"
SALT_LAST = "ln"
SALT_LOCATION = "loc"
SALT_BAND = "band"
SALT_UPDATED = "ts"
SALT_NEW_KEY = "newdept"
SALT_NEW_UPDATED = "newts"
SALT_MOVE_ORDER = "move"
SALT_MOVE_KEY = "movedept"
SALT_MOVE_UPDATED = "movets"

MOVE_ORDER_SPAN = 1_000_000

# --- end of fixed values ----------------------------------------------------------


@dataclass(frozen=True)
class Vocabulary:
    departments: tuple[str, ...] = DEPARTMENT_NAMES
    first_names: tuple[str, ...] = FIRST_NAMES
    last_names: tuple[str, ...] = LAST_NAMES
    locations: tuple[str, ...] = LOCATION_CODES
    salary_bands: tuple[str, ...] = SALARY_BANDS
    divisions: tuple[str, ...] = DIVISIONS

    def __post_init__(self) -> None:
        for name in self.__dataclass_fields__:
            values = getattr(self, name)
            if not values or any(v is None or v == "" for v in values):
                raise ValueError(f"vocabulary list {name!r} must hold non-empty strings")
        if len(set(self.departments)) != len(self.departments):
            raise ValueError("department names must be unique")
