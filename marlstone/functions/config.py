"""Configuration as data. Companies are rows of a registry, never names in code."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Enumerations of the data model.
STATUSES = ("OK", "OK_APPROX", "DIM_XBRL_OK", "MDA_OK", "DEF14A_OK", "8K_ITEM_OK", "TEXT_QUAL", "NOT_AVAILABLE_SEC", "NOT_EXTRACTED", "PARSE_FAILED", "NEEDS_REVIEW", "NOT_MEANINGFUL", "N_A_STRUCTURAL")
SOURCE_CLASSES = ("STD_XBRL", "DIM_XBRL", "CUSTOM_XBRL", "MDA", "DEF14A", "8K_ITEM", "TEXT", "DERIVED", "NOT_AVAILABLE")
UNITS = ("USD", "ratio", "pure", "percent", "count", "flag", "")
CHECK_STATUSES = ("PASS", "FAIL", "SKIPPED_LIGHT_PACKAGE", "NOT_EVALUATED_MISSING_EVIDENCE", "WORKSPACE_INCOMPLETE")
MODES = ("FULL_VALIDATION", "LIGHT_REVIEW_MODE", "WORKSPACE_INCOMPLETE")
RESULTS = ("IN_PROGRESS", "PASSED", "PASSED_WITH_CAVEATS", "FAILED")

# Candidate concepts of each component, first hit wins. Chains that the public description does
# not give in full are provisional choices and marked so.
CHAINS = {
    "revenue": ("RevenueFromContractWithCustomerExcludingAssessedTax", "Revenues", "SalesRevenueNet", "RevenueFromContractWithCustomerIncludingAssessedTax"),
    "net_income": ("NetIncomeLoss", "ProfitLoss"),
    "operating_income": ("OperatingIncomeLoss",),
    "depreciation_amortization": ("DepreciationDepletionAndAmortization", "DepreciationAndAmortization", "DepreciationAmortizationAndAccretionNet"),  # provisional
    "depreciation": ("Depreciation",),
    "amortization": ("AmortizationOfIntangibleAssets",),
    "operating_cash_flow": ("NetCashProvidedByUsedInOperatingActivities", "NetCashProvidedByUsedInOperatingActivitiesContinuingOperations"),
    "capex": ("PaymentsToAcquirePropertyPlantAndEquipment", "PaymentsToAcquireProductiveAssets"),
    "interest_expense": ("InterestExpense", "InterestExpenseNonoperating", "InterestExpenseDebt"),  # provisional
    "pretax_income": ("IncomeLossFromContinuingOperationsBeforeIncomeTaxesExtraordinaryItemsNoncontrollingInterest",),
    "noninterest_income": ("NoninterestIncome",),
    "net_interest_income": ("InterestIncomeExpenseNet",),
    "allowance": ("FinancingReceivableAllowanceForCreditLosses",),
    "loans": ("FinancingReceivableExcludingAccruedInterestBeforeAllowanceForCreditLoss",),
    "current_assets": ("AssetsCurrent",),
    "current_liabilities": ("LiabilitiesCurrent",),
    "cash": ("CashAndCashEquivalentsAtCarryingValue", "CashCashEquivalentsRestrictedCashAndRestrictedCashEquivalents"),
    "equity": ("StockholdersEquity", "StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest"),
    "long_term_debt": ("LongTermDebt",),
    "long_term_debt_current": ("LongTermDebtCurrent",),
    "long_term_debt_noncurrent": ("LongTermDebtNoncurrent",),
    "short_term_borrowings": ("ShortTermBorrowings",),
    "commercial_paper": ("CommercialPaper",),
    "finance_lease": ("FinanceLeaseLiability",),
}
INSTANT = frozenset({"current_assets", "current_liabilities", "cash", "equity", "long_term_debt", "long_term_debt_current", "long_term_debt_noncurrent", "short_term_borrowings", "commercial_paper", "finance_lease", "allowance", "loans"})

# Which metrics a profile has. Ids come in families: A banks, B standard, C governance, D text, E events.
FAMILY_A = tuple(f"A{i:02d}" for i in range(1, 14))
STANDARD = tuple(f"B{i:02d}" for i in range(1, 10))
REST = tuple(f"{f}{i:02d}" for f, n in (("C", 4), ("D", 4), ("E", 5)) for i in range(1, n + 1))
EXTRA = {"lodging": ("B10", "B11"), "subscription_or_contract_revenue": ("B12",), "manufacturing": ("B13",)}
PROFILES = ("financial_institution", "lodging", "subscription_or_contract_revenue", "manufacturing", "retail", "pharma", "telecom", "media", "airline", "default_non_fi")

# Lexicons and bands.
THRESHOLD_WORDS = ("minimum", "requiredforcapitaladequacy", "requiredtobewellcapitalized", "wellcapitalizedminimum", "tobewellcapitalized", "capitaladequacyminimum", "wellcapitalized")
BASEL_AXIS = "RiskWeightedAssetsCalculationMethodologyAxis"
CAPTIVE_WORDS = ("captivefinance", "financialservices", "credit", "finance")
CAPTIVE_EXCEPTIONS = ("creditloss", "creditfacility", "financelease", "supplierfinance", "deferredcost")
RPO = "RevenueRemainingPerformanceObligation"
LODGING_SCOPES = ("comparable systemwide worldwide", "systemwide worldwide", "companywide", "worldwide")
REVPAR_USD, OCCUPANCY_PERCENT, RPO_LEAST_USD = (30, 600), (0, 100), 1_000_000_000
EVENT_ITEMS = {"C01": ("5.02",), "E01": ("1.01", "2.01"), "E02": ("1.03",), "E03": ("5.02",), "E04": ("4.02",), "E05": ("1.01",)}
RISK_WORDS = {"D01": "risk factors", "D02": "legal proceedings|litigation", "D03": "regulatory (?:action|matter|investigation)|governmental investigation", "D04": "substantial doubt|going concern"}


def metric_ids(profile: str) -> tuple[str, ...]:
    own = (*FAMILY_A, "B08") if profile == "financial_institution" else STANDARD
    return (*own, *EXTRA.get(profile, ()), *REST)


def applicability(spark: SparkSession) -> DataFrame:
    """(profile, metric_id), some 230 rows."""
    rows = ", ".join(f"('{p}', '{m}')" for p in PROFILES for m in metric_ids(p))
    return spark.sql(f"select * from values {rows} as t(profile, metric_id)")


def chains(spark: SparkSession) -> DataFrame:
    """(component, concept, chain_rank, instant)."""
    rows = ", ".join(f"('{c}', '{x}', {i}, {str(c in INSTANT).lower()})" for c, xs in CHAINS.items() for i, x in enumerate(xs))
    return spark.sql(f"select * from values {rows} as t(component, concept, chain_rank, instant)")
