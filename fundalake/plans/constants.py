"""Names, codes and maps that results depend on."""

#: The statement items of the wide table, in column order.
CONCEPTS = (
    "Assets AssetsCurrent AssetsNoncurrent CapitalExpenditures DiscontinuedOperationsNetIncome DividendIncome EBITDA "
    "EarningsPerShareDiluted EquityInEarningsOfSubsidiaries FeeExpense FeeIncome GeneralAndAdministrativeExpense GrossProfit "
    "IncomeLossFromContinuingOperationsBeforeIncomeTaxes InterestExpense InterestIncome Inventory Liabilities LiabilitiesCurrent "
    "LiabilitiesNoncurrent NetFeeIncome NetIncomeLoss NetInterestIncome OperatingCashFlow OperatingIncomeLoss "
    "OtherFinancialInstrumentsResult OtherOperatingExpense OtherOperatingIncome ProvisionForLoanLosses Receivables "
    "ResearchAndDevelopment RetainedEarnings Revenues StockholdersEquity TradingAndRevaluationResult"
).split()

#: Filed tag -> concept. A tag that is listed for two concepts belongs to the later one.
TAG_CONCEPT = {
    "Assets": "Assets", "AssetsNet": "Assets",
    "Liabilities": "Liabilities",
    "StockholdersEquity": "StockholdersEquity", "StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest": "StockholdersEquity", "Equity": "StockholdersEquity",
    "GrossProfit": "GrossProfit",
    "Revenues": "Revenues", "RevenueFromContractWithCustomerExcludingAssessedTax": "Revenues", "SalesRevenueNet": "Revenues", "SalesRevenueServicesGross": "Revenues", "RevenuesNetOfInterestExpense": "Revenues", "SalesRevenueGoodsNet": "Revenues", "OilAndGasRevenue": "Revenues",
    "NetIncomeLoss": "NetIncomeLoss", "ProfitLoss": "NetIncomeLoss", "NetIncomeLossAvailableToCommonStockholdersBasic": "NetIncomeLoss", "NetIncomeLossAvailableToCommonStockholdersDiluted": "NetIncomeLoss",
    "EarningsPerShareDiluted": "EarningsPerShareDiluted", "EarningsPerShareBasicAndDiluted": "EarningsPerShareDiluted",
    "OperatingIncomeLoss": "OperatingIncomeLoss",
    "NetCashProvidedByUsedInOperatingActivities": "OperatingCashFlow", "NetCashProvidedByUsedInOperatingActivitiesContinuingOperations": "OperatingCashFlow",
    "CapitalExpenditures": "CapitalExpenditures", "PaymentsToAcquirePropertyPlantAndEquipment": "CapitalExpenditures", "PaymentsToAcquireProductiveAssets": "CapitalExpenditures",
    "EarningsBeforeInterestTaxesDepreciationAmortization": "EBITDA", "EarningsBeforeInterestAndTaxesDepreciationAndAmortization": "EBITDA", "EBITDA": "EBITDA",
    "ResearchAndDevelopment": "ResearchAndDevelopment", "ResearchAndDevelopmentExpense": "ResearchAndDevelopment", "ResearchAndDevelopmentExpenditures": "ResearchAndDevelopment",
    "AssetsCurrent": "AssetsCurrent", "AssetsCurrentAbstract": "AssetsCurrent",
    "LiabilitiesCurrent": "LiabilitiesCurrent", "LiabilitiesCurrentAbstract": "LiabilitiesCurrent",
    "InterestExpense": "InterestExpense", "InterestExpenseDebt": "InterestExpense", "InterestExpenseRelatedParty": "InterestExpense", "InterestPaidNet": "InterestExpense",
    "RetainedEarningsAccumulatedDeficit": "RetainedEarnings", "RetainedEarnings": "RetainedEarnings",
    "InventoryNet": "Inventory", "Inventory": "Inventory", "InventoryGross": "Inventory",
    "ReceivablesNetCurrent": "Receivables", "AccountsReceivableNetCurrent": "Receivables", "ReceivablesNet": "Receivables", "AccountsReceivableNet": "Receivables",
}
PER_SHARE_CONCEPT = "EarningsPerShareDiluted"
PER_SHARE_UNITS = ("USD/shares", "USD/share")
MONEY_UNIT = "USD"

#: Share-count tags in order of preference; the source type that each gives.
SHARE_TAGS_DEI = ("EntityCommonStockSharesOutstanding", "CommonStockSharesOutstanding")
SHARE_TAGS_GAAP = ("WeightedAverageNumberOfSharesOutstandingBasic", "WeightedAverageNumberOfDilutedSharesOutstanding", "WeightedAverageNumberOfSharesOutstandingDiluted")
INCOME_TAGS = ("NetIncomeLoss", "ProfitLoss")
SHARE_PRICE_UNIT = "USD/shares"
EPS_TAGS = ("EarningsPerShareDiluted", "EarningsPerShareBasic")

DELISTING_FORMS = ("25", "25-NSE")
DEREGISTRATION_FORMS = ("15-12G", "15-12B", "15-15D")
FINANCIAL_FORMS = ("10-K", "10-Q", "20-F", "40-F", "10-K/A", "10-Q/A")
ZOMBIE_DAYS = 18 * 30

EXCLUDED_SIC = (6722, 6726, 6021, 6022, 6311)
FUND_WORDS = ("etf", "fund", "trust", "index", "portfolio")

MONTHS_PL = {"sty": 1, "lut": 2, "mar": 3, "kwi": 4, "maj": 5, "cze": 6, "lip": 7, "sie": 8, "wrz": 9, "paź": 10, "lis": 11, "gru": 12}

#: Labels of report pages -> concept.
INCOME_LABELS = {
    "Przychody ze sprzedaży": "Revenues", "Przychody netto ze sprzedaży": "Revenues", "Przychody odsetkowe": "InterestIncome", "Przychody z działalności operacyjnej": "OperatingRevenue",
    "Przychody prowizyjne": "FeeIncome", "Przychody z tytułu dywidend": "DividendIncome", "Pozostałe przychody operacyjne": "OtherOperatingIncome", "Koszty odsetkowe": "InterestExpense",
    "Koszty prowizyjne": "FeeExpense", "Ogólne koszty administracyjne": "GeneralAndAdministrativeExpense", "Pozostałe koszty operacyjne": "OtherOperatingExpense",
    "Odpisy netto z tytułu utraty wartości kredytów": "ProvisionForLoanLosses", "Wynik z tytułu odsetek": "NetInterestIncome", "Wynik z tytułu prowizji": "NetFeeIncome",
    "Wynik handlowy i rewaluacja": "TradingAndRevaluationResult", "Wynik na pozostałych instrumentach finansowych": "OtherFinancialInstrumentsResult",
    "Zysk (strata) brutto ze sprzedaży": "GrossProfit", "Zysk (strata) na działalności operacyjnej": "OperatingIncomeLoss",
    "Zysk przed opodatkowaniem": "IncomeLossFromContinuingOperationsBeforeIncomeTaxes", "Zysk (strata) przed opodatkowaniem": "IncomeLossFromContinuingOperationsBeforeIncomeTaxes",
    "Zysk (strata) netto": "NetIncomeLoss", "Zysk netto": "NetIncomeLoss", "Zysk netto akcjonariuszy jednostki dominującej": "NetIncomeLoss", "Wynik operacyjny": "OperatingIncomeLoss",
    "Wynik netto": "NetIncomeLoss", "Udział w zyskach jednostek podporządkowanych": "EquityInEarningsOfSubsidiaries",
    "Zysk (strata) netto z działalności zaniechanej": "DiscontinuedOperationsNetIncome", "EBITDA": "EBITDA",
}
BALANCE_LABELS = {
    "Aktywa": "Assets", "Aktywa razem": "Assets", "Aktywa trwałe": "AssetsNoncurrent", "Aktywa obrotowe": "AssetsCurrent", "Zobowiązania": "Liabilities",
    "Zobowiązania i rezerwy na zobowiązania": "Liabilities", "Zobowiązania długoterminowe": "LiabilitiesNoncurrent", "Zobowiązania krótkoterminowe": "LiabilitiesCurrent",
    "Kapitał (fundusz) własny": "StockholdersEquity", "Kapitał własny": "StockholdersEquity", "Kapitały własne": "StockholdersEquity",
}
CASH_LABELS = {
    "Przepływy pieniężne netto z działalności operacyjnej": "NetCashProvidedByUsedInOperatingActivities", "Przepływy środków pieniężnych z działalności operacyjnej": "NetCashProvidedByUsedInOperatingActivities",
    "Przepływy pieniężne netto z działalności inwestycyjnej": "NetCashProvidedByUsedInInvestingActivities", "Przepływy środków pieniężnych z działalności inwestycyjnej": "NetCashProvidedByUsedInInvestingActivities",
    "Przepływy pieniężne netto z działalności finansowej": "NetCashProvidedByUsedInFinancingActivities", "Przepływy środków pieniężnych z działalności finansowej": "NetCashProvidedByUsedInFinancingActivities",
    "Nakłady inwestycyjne": "CapitalExpenditures",
}

MACRO = ("retail_sales_yoy", "gdp_yoy", "cpi_yoy", "unemp_level", "unemp_diff", "rate_level", "rate_diff")
