"""Table layouts, written out: one column a line.

Order matters: the first table that lists a name owns it.
"""

from __future__ import annotations

# Fixed values.  A table: name, grain, keys, freshness, attribute of the date; then its columns:
# name, attribute in the raw payload, type, roll-up.
LAYOUTS = [
    ("daily_price", "DAILY", ("symbol", "date"), "daily_historical", "date", [
        ("open", "open", "double", "first"),
        ("high", "high", "double", "max"),
        ("low", "low", "double", "min"),
        ("close", "close", "double", "last"),
        ("adj_close", "adjClose", "double", "last"),
        ("volume", "volume", "bigint", "sum"),
        ("vwap", "vwap", "double", "mean"),
        ("change", "change", "double", "sum"),
        ("change_pct", "changePercent", "double", "sum"),
    ]),
    ("income_statement", "QUARTERLY", ("symbol", "date", "period"), "financial_statements", "date", [
        ("reported_currency", "reportedCurrency", "string", "last"),
        ("cik", "cik", "string", "last"),
        ("filling_date", "filingDate", "date", "last"),
        ("accepted_date", "acceptedDate", "string", "last"),
        ("calendar_year", "fiscalYear", "string", "last"),
        ("revenue", "revenue", "bigint", "sum"),
        ("cost_of_revenue", "costOfRevenue", "bigint", "sum"),
        ("gross_profit", "grossProfit", "bigint", "sum"),
        ("rd_expenses", "researchAndDevelopmentExpenses", "bigint", "sum"),
        ("sga_expenses", "sellingGeneralAndAdministrativeExpenses", "bigint", "sum"),
        ("operating_expenses", "operatingExpenses", "bigint", "sum"),
        ("operating_income", "operatingIncome", "bigint", "sum"),
        ("interest_income", "interestIncome", "bigint", "sum"),
        ("interest_expense", "interestExpense", "bigint", "sum"),
        ("ebitda", "ebitda", "bigint", "sum"),
        ("net_income", "netIncome", "bigint", "sum"),
        ("eps", "eps", "double", "sum"),
        ("eps_diluted", "epsDiluted", "double", "sum"),
        ("weighted_avg_shares", "weightedAverageShsOut", "bigint", "last"),
        ("weighted_avg_shares_diluted", "weightedAverageShsOutDil", "bigint", "last"),
        ("income_before_tax", "incomeBeforeTax", "bigint", "sum"),
        ("income_tax_expense", "incomeTaxExpense", "bigint", "sum"),
        ("depreciation_and_amortization", "depreciationAndAmortization", "bigint", "sum"),
        ("cost_and_expenses", "costAndExpenses", "bigint", "sum"),
        ("other_expenses", "otherExpenses", "bigint", "sum"),
        ("total_other_income", "totalOtherIncomeExpensesNet", "bigint", "sum"),
    ]),
    ("balance_sheet", "QUARTERLY", ("symbol", "date", "period"), "financial_statements", "date", [
        ("reported_currency", "reportedCurrency", "string", "last"),
        ("cik", "cik", "string", "last"),
        ("filling_date", "filingDate", "date", "last"),
        ("calendar_year", "fiscalYear", "string", "last"),
        ("cash_and_equivalents", "cashAndCashEquivalents", "bigint", "last"),
        ("short_term_investments", "shortTermInvestments", "bigint", "last"),
        ("net_receivables", "netReceivables", "bigint", "last"),
        ("inventory", "inventory", "bigint", "last"),
        ("total_current_assets", "totalCurrentAssets", "bigint", "last"),
        ("property_plant_equipment", "propertyPlantEquipmentNet", "bigint", "last"),
        ("goodwill", "goodwill", "bigint", "last"),
        ("intangible_assets", "intangibleAssets", "bigint", "last"),
        ("total_non_current_assets", "totalNonCurrentAssets", "bigint", "last"),
        ("total_assets", "totalAssets", "bigint", "last"),
        ("accounts_payable", "accountPayables", "bigint", "last"),
        ("short_term_debt", "shortTermDebt", "bigint", "last"),
        ("total_current_liabilities", "totalCurrentLiabilities", "bigint", "last"),
        ("long_term_debt", "longTermDebt", "bigint", "last"),
        ("total_non_current_liabilities", "totalNonCurrentLiabilities", "bigint", "last"),
        ("total_liabilities", "totalLiabilities", "bigint", "last"),
        ("total_stockholders_equity", "totalStockholdersEquity", "bigint", "last"),
        ("total_equity", "totalEquity", "bigint", "last"),
        ("total_liabilities_and_equity", "totalLiabilitiesAndTotalEquity", "bigint", "last"),
        ("total_debt", "totalDebt", "bigint", "last"),
        ("net_debt", "netDebt", "bigint", "last"),
        ("retained_earnings", "retainedEarnings", "bigint", "last"),
        ("common_stock", "commonStock", "bigint", "last"),
        ("other_current_assets", "otherCurrentAssets", "bigint", "last"),
        ("other_non_current_assets", "otherNonCurrentAssets", "bigint", "last"),
        ("deferred_revenue", "deferredRevenue", "bigint", "last"),
        ("tax_payables", "taxPayables", "bigint", "last"),
        ("minority_interest", "minorityInterest", "bigint", "last"),
        ("goodwill_and_intangibles", "goodwillAndIntangibleAssets", "bigint", "last"),
        ("other_assets", "otherAssets", "bigint", "last"),
        ("other_liabilities", "otherLiabilities", "bigint", "last"),
        ("total_investments", "totalInvestments", "bigint", "last"),
        ("capital_lease_obligations", "capitalLeaseObligations", "bigint", "last"),
    ]),
    ("cash_flow", "QUARTERLY", ("symbol", "date", "period"), "financial_statements", "date", [
        ("reported_currency", "reportedCurrency", "string", "last"),
        ("cik", "cik", "string", "last"),
        ("filling_date", "filingDate", "date", "last"),
        ("calendar_year", "fiscalYear", "string", "last"),
        ("net_income_cf", "netIncome", "bigint", "sum"),
        ("depreciation", "depreciationAndAmortization", "bigint", "sum"),
        ("stock_based_compensation", "stockBasedCompensation", "bigint", "sum"),
        ("operating_cash_flow", "operatingCashFlow", "bigint", "sum"),
        ("capex", "capitalExpenditure", "bigint", "sum"),
        ("acquisitions", "acquisitionsNet", "bigint", "sum"),
        ("investing_cash_flow", "netCashProvidedByInvestingActivities", "bigint", "sum"),
        ("debt_repayment", "netDebtIssuance", "bigint", "sum"),
        ("share_repurchase", "commonStockRepurchased", "bigint", "sum"),
        ("dividends_paid", "commonDividendsPaid", "bigint", "sum"),
        ("financing_cash_flow", "netCashProvidedByFinancingActivities", "bigint", "sum"),
        ("free_cash_flow", "freeCashFlow", "bigint", "sum"),
        ("net_change_in_cash", "netChangeInCash", "bigint", "sum"),
    ]),
    ("key_metrics", "QUARTERLY", ("symbol", "date", "period"), "key_metrics", "date", [
        ("calendar_year", "fiscalYear", "string", "last"),
        ("market_cap", "marketCap", "bigint", "last"),
        ("enterprise_value", "enterpriseValue", "bigint", "last"),
        ("ev_to_sales", "evToSales", "double", "last"),
        ("ev_to_ebitda", "evToEBITDA", "double", "last"),
        ("ev_to_fcf", "evToFreeCashFlow", "double", "last"),
        ("earnings_yield", "earningsYield", "double", "last"),
        ("fcf_yield", "freeCashFlowYield", "double", "last"),
        ("current_ratio", "currentRatio", "double", "last"),
        ("roic", "returnOnInvestedCapital", "double", "last"),
        ("roe", "returnOnEquity", "double", "last"),
        ("roa", "returnOnAssets", "double", "last"),
        ("tax_burden_km", "taxBurden", "double", "last"),
        ("interest_burden_km", "interestBurden", "double", "last"),
        ("operating_return_on_assets_km", "operatingReturnOnAssets", "double", "last"),
        ("return_on_capital_employed_km", "returnOnCapitalEmployed", "double", "last"),
        ("return_on_tangible_assets_km", "returnOnTangibleAssets", "double", "last"),
        ("net_debt_to_ebitda_km", "netDebtToEBITDA", "double", "last"),
        ("invested_capital", "investedCapital", "bigint", "last"),
        ("working_capital_km", "workingCapital", "bigint", "last"),
        ("graham_number_km", "grahamNumber", "double", "last"),
        ("income_quality", "incomeQuality", "double", "last"),
    ]),
    ("ratios", "QUARTERLY", ("symbol", "date", "period"), "key_metrics", "date", [
        ("gross_profit_margin", "grossProfitMargin", "double", "last"),
        ("operating_profit_margin", "operatingProfitMargin", "double", "last"),
        ("net_profit_margin", "netProfitMargin", "double", "last"),
        ("debt_ratio", "debtToAssetsRatio", "double", "last"),
        ("debt_equity_ratio", "debtToEquityRatio", "double", "last"),
        ("interest_coverage", "interestCoverageRatio", "double", "last"),
        ("cash_flow_to_debt", "cashFlowToDebtRatio", "double", "last"),
        ("current_ratio_r", "currentRatio", "double", "last"),
        ("quick_ratio", "quickRatio", "double", "last"),
        ("cash_ratio", "cashRatio", "double", "last"),
        ("asset_turnover", "assetTurnover", "double", "last"),
        ("inventory_turnover", "inventoryTurnover", "double", "last"),
        ("receivables_turnover", "receivablesTurnover", "double", "last"),
        ("dividend_yield_r", "dividendYield", "double", "last"),
        ("price_earnings_ratio", "priceToEarningsRatio", "double", "last"),
        ("price_to_book", "priceToBookRatio", "double", "last"),
        ("price_to_sales_r", "priceToSalesRatio", "double", "last"),
        ("price_to_fcf", "priceToFreeCashFlowRatio", "double", "last"),
        ("ev_to_sales_r", "enterpriseValueMultiple", "double", "last"),
        ("revenue_per_share_r", "revenuePerShare", "double", "last"),
        ("net_income_per_share_r", "netIncomePerShare", "double", "last"),
        ("book_value_per_share_r", "bookValuePerShare", "double", "last"),
        ("fcf_per_share_r", "freeCashFlowPerShare", "double", "last"),
        ("operating_cf_per_share_r", "operatingCashFlowPerShare", "double", "last"),
        ("cash_per_share_r", "cashPerShare", "double", "last"),
        ("tangible_bvps_r", "tangibleBookValuePerShare", "double", "last"),
        ("dividend_per_share_r", "dividendPerShare", "double", "last"),
        ("ebitda_margin_r", "ebitdaMargin", "double", "last"),
        ("effective_tax_rate_r", "effectiveTaxRate", "double", "last"),
    ]),
    ("quote", "SNAPSHOT", ("symbol",), "realtime_quotes", "date", [
        ("quote_name", "name", "string", "last"),
        ("price", "price", "double", "last"),
        ("quote_change", "change", "double", "last"),
        ("quote_change_pct", "changePercentage", "double", "last"),
        ("day_low", "dayLow", "double", "last"),
        ("day_high", "dayHigh", "double", "last"),
        ("year_low", "yearLow", "double", "last"),
        ("year_high", "yearHigh", "double", "last"),
        ("quote_market_cap", "marketCap", "bigint", "last"),
        ("price_avg_50", "priceAvg50", "double", "last"),
        ("price_avg_200", "priceAvg200", "double", "last"),
        ("quote_volume", "volume", "bigint", "last"),
        ("quote_open", "open", "double", "last"),
        ("previous_close", "previousClose", "double", "last"),
        ("exchange", "exchange", "string", "last"),
    ]),
    ("profile", "SNAPSHOT", ("symbol",), "company_profiles", "date", [
        ("company_name", "companyName", "string", "last"),
        ("currency", "currency", "string", "last"),
        ("cik", "cik", "string", "last"),
        ("isin", "isin", "string", "last"),
        ("exchange_short", "exchange", "string", "last"),
        ("exchange_full", "exchangeFullName", "string", "last"),
        ("industry", "industry", "string", "last"),
        ("sector", "sector", "string", "last"),
        ("country", "country", "string", "last"),
        ("employees", "fullTimeEmployees", "string", "last"),
        ("description", "description", "string", "last"),
        ("ceo", "ceo", "string", "last"),
        ("website", "website", "string", "last"),
        ("ipo_date", "ipoDate", "date", "last"),
        ("beta", "beta", "double", "last"),
        ("profile_market_cap", "marketCap", "bigint", "last"),
        ("profile_price", "price", "double", "last"),
        ("profile_volume", "volume", "bigint", "last"),
        ("is_etf", "isEtf", "boolean", "last"),
        ("is_fund", "isFund", "boolean", "last"),
        ("is_adr", "isAdr", "boolean", "last"),
        ("is_actively_trading", "isActivelyTrading", "boolean", "last"),
        ("default_image", "defaultImage", "boolean", "last"),
    ]),
    ("earnings_data", "QUARTERLY", ("symbol", "date"), "earnings_calendar", "date", [
        ("earnings_eps", "epsActual", "double", "last"),
        ("eps_estimated", "epsEstimated", "double", "last"),
        ("earnings_revenue", "revenueActual", "bigint", "sum"),
        ("revenue_estimated", "revenueEstimated", "bigint", "sum"),
        ("earnings_last_updated", "lastUpdated", "date", "last"),
    ]),
    ("dividends_data", "QUARTERLY", ("symbol", "date"), "earnings_calendar", "date", [
        ("dividend", "dividend", "double", "last"),
        ("adj_dividend", "adjDividend", "double", "last"),
        ("record_date", "recordDate", "date", "last"),
        ("payment_date", "paymentDate", "date", "last"),
        ("declaration_date", "declarationDate", "date", "last"),
    ]),
    ("enterprise_values", "QUARTERLY", ("symbol", "date"), "financial_statements", "date", [
        ("stock_price_ev", "stockPrice", "double", "last"),
        ("shares_outstanding_ev", "numberOfShares", "bigint", "last"),
        ("ev_market_cap", "marketCapitalization", "bigint", "last"),
        ("minus_cash", "minusCashAndCashEquivalents", "bigint", "last"),
        ("plus_debt", "addTotalDebt", "bigint", "last"),
        ("enterprise_value", "enterpriseValue", "bigint", "last"),
    ]),
    ("dcf_data", "SNAPSHOT", ("symbol",), "dcf", "date", [
        ("dcf_val", "dcf", "double", "last"),
        ("dcf_stock_price", "Stock Price", "double", "last"),
    ]),
    ("esg_data", "SNAPSHOT", ("symbol",), "esg", "date", [
        ("esg_total", "environmentalScore", "double", "last"),
        ("esg_environmental", "environmentalScore", "double", "last"),
        ("esg_social", "socialScore", "double", "last"),
        ("esg_governance", "governanceScore", "double", "last"),
        ("esg_score", "ESGScore", "double", "last"),
    ]),
    ("price_change", "SNAPSHOT", ("symbol",), "realtime_quotes", "date", [
        ("provider_return_1d", "1D", "double", "last"),
        ("provider_return_5d", "5D", "double", "last"),
        ("provider_return_1m", "1M", "double", "last"),
        ("provider_return_3m", "3M", "double", "last"),
        ("provider_return_6m", "6M", "double", "last"),
        ("provider_return_ytd", "ytd", "double", "last"),
        ("provider_return_1y", "1Y", "double", "last"),
        ("provider_return_3y", "3Y", "double", "last"),
        ("provider_return_5y", "5Y", "double", "last"),
    ]),
    ("splits_data", "QUARTERLY", ("symbol", "date"), "earnings_calendar", "date", [
        ("split_label", "label", "string", "last"),
        ("split_numerator", "numerator", "int", "last"),
        ("split_denominator", "denominator", "int", "last"),
    ]),
    ("institutional_summary", "SNAPSHOT", ("symbol",), "sec_filings", "date", [
        ("inst_holders_count", "investorsHolding", "int", "last"),
        ("inst_holders_prev", "lastInvestorsHolding", "int", "last"),
        ("inst_holders_change", "investorsHoldingChange", "int", "last"),
        ("inst_total_invested", "totalInvested", "bigint", "last"),
        ("inst_invested_prev", "lastTotalInvested", "bigint", "last"),
        ("inst_invested_change", "totalInvestedChange", "bigint", "last"),
        ("inst_put_call_ratio", "putCallRatio", "double", "last"),
    ]),
    ("financial_scores", "SNAPSHOT", ("symbol",), "key_metrics", "date", [
        ("altman_z_score_provider", "altmanZScore", "double", "last"),
        ("piotroski_score_provider", "piotroskiScore", "double", "last"),
        ("working_capital_score", "workingCapital", "double", "last"),
        ("retained_earnings_score", "retainedEarnings", "double", "last"),
        ("operating_cash_flow_score", "operatingCashFlow", "double", "last"),
        ("total_assets_score", "totalAssets", "double", "last"),
    ]),
    ("treasury_rates", "DAILY", ("date",), "economic_indicators", "date", [
        ("rate_1m", "month1", "double", "last"),
        ("rate_2m", "month2", "double", "last"),
        ("rate_3m", "month3", "double", "last"),
        ("rate_6m", "month6", "double", "last"),
        ("rate_1y", "year1", "double", "last"),
        ("rate_2y", "year2", "double", "last"),
        ("rate_3y", "year3", "double", "last"),
        ("rate_5y", "year5", "double", "last"),
        ("rate_7y", "year7", "double", "last"),
        ("rate_10y", "year10", "double", "last"),
        ("rate_20y", "year20", "double", "last"),
        ("rate_30y", "year30", "double", "last"),
    ]),
    ("analyst_estimates", "QUARTERLY", ("symbol", "date"), "analyst", "date", [
        ("est_revenue_low", "revenueLow", "bigint", "last"),
        ("est_revenue_high", "revenueHigh", "bigint", "last"),
        ("est_revenue_avg", "revenueAvg", "bigint", "last"),
        ("est_ebitda_low", "ebitdaLow", "bigint", "last"),
        ("est_ebitda_high", "ebitdaHigh", "bigint", "last"),
        ("est_ebitda_avg", "ebitdaAvg", "bigint", "last"),
        ("est_eps_low", "epsLow", "double", "last"),
        ("est_eps_high", "epsHigh", "double", "last"),
        ("est_eps_avg", "epsAvg", "double", "last"),
        ("est_net_income_low", "netIncomeLow", "bigint", "last"),
        ("est_net_income_high", "netIncomeHigh", "bigint", "last"),
        ("est_net_income_avg", "netIncomeAvg", "bigint", "last"),
        ("est_sga_avg", "sgaExpenseAvg", "bigint", "last"),
        ("num_analysts_revenue", "numAnalystsRevenue", "int", "last"),
        ("num_analysts_eps", "numAnalystsEps", "int", "last"),
    ]),
    ("price_target", "SNAPSHOT", ("symbol",), "analyst", "date", [
        ("target_high", "targetHigh", "double", "last"),
        ("target_low", "targetLow", "double", "last"),
        ("target_consensus", "targetConsensus", "double", "last"),
        ("target_median", "targetMedian", "double", "last"),
    ]),
    ("grades_consensus", "SNAPSHOT", ("symbol",), "analyst", "date", [
        ("strong_buy", "strongBuy", "int", "last"),
        ("buy", "buy", "int", "last"),
        ("hold", "hold", "int", "last"),
        ("sell", "sell", "int", "last"),
        ("strong_sell", "strongSell", "int", "last"),
        ("consensus", "consensus", "string", "last"),
    ]),
    ("ratings", "SNAPSHOT", ("symbol",), "analyst", "date", [
        ("provider_rating", "rating", "string", "last"),
        ("provider_rating_score", "overallScore", "int", "last"),
        ("provider_dcf_score", "discountedCashFlowScore", "int", "last"),
        ("provider_roe_score", "returnOnEquityScore", "int", "last"),
        ("provider_roa_score", "returnOnAssetsScore", "int", "last"),
        ("provider_de_score", "debtToEquityScore", "int", "last"),
        ("provider_pe_score", "priceToEarningsScore", "int", "last"),
        ("provider_pb_score", "priceToBookScore", "int", "last"),
    ]),
    ("employee_count", "ANNUAL", ("symbol", "date"), "company_profiles", "date", [
        ("employee_count_val", "employeeCount", "int", "last"),
        ("company_name_emp", "companyName", "string", "last"),
    ]),
    ("shares_float_data", "SNAPSHOT", ("symbol",), "company_profiles", "date", [
        ("free_float", "freeFloat", "double", "last"),
        ("float_shares", "floatShares", "bigint", "last"),
        ("outstanding_shares", "outstandingShares", "bigint", "last"),
    ]),
    ("historical_market_cap", "DAILY", ("symbol", "date"), "daily_historical", "date", [
        ("hist_market_cap", "marketCap", "bigint", "last"),
    ]),
    ("historical_grades", "MONTHLY", ("symbol", "date"), "analyst", "date", [
        ("hist_strong_buy", "analystRatingsStrongBuy", "int", "last"),
        ("hist_buy", "analystRatingsBuy", "int", "last"),
        ("hist_hold", "analystRatingsHold", "int", "last"),
        ("hist_sell", "analystRatingsSell", "int", "last"),
        ("hist_strong_sell", "analystRatingsStrongSell", "int", "last"),
    ]),
    ("historical_ratings", "MONTHLY", ("symbol", "date"), "analyst", "date", [
        ("hist_rating", "rating", "string", "last"),
        ("hist_overall_score", "overallScore", "int", "last"),
        ("hist_dcf_score", "discountedCashFlowScore", "int", "last"),
        ("hist_roe_score", "returnOnEquityScore", "int", "last"),
        ("hist_roa_score", "returnOnAssetsScore", "int", "last"),
        ("hist_de_score", "debtToEquityScore", "int", "last"),
        ("hist_pe_score", "priceToEarningsScore", "int", "last"),
        ("hist_pb_score", "priceToBookScore", "int", "last"),
    ]),
    ("historical_institutional", "QUARTERLY", ("symbol", "date"), "sec_filings", "date", [
        ("hist_inst_holders", "investorsHolding", "int", "last"),
        ("hist_inst_holders_change", "investorsHoldingChange", "int", "last"),
        ("hist_inst_invested", "totalInvested", "bigint", "last"),
        ("hist_inst_invested_change", "totalInvestedChange", "bigint", "last"),
        ("hist_inst_ownership_pct", "ownershipPercent", "double", "last"),
        ("hist_inst_new_positions", "newPositions", "int", "last"),
        ("hist_inst_closed_positions", "closedPositions", "int", "last"),
        ("hist_inst_put_call_ratio", "putCallRatio", "double", "last"),
    ]),
    ("delisted_companies", "SNAPSHOT", ("symbol",), "static_lists", "date", [
        ("company_name", "companyName", "string", "last"),
        ("delisted_exchange", "exchange", "string", "last"),
        ("ipo_date", "ipoDate", "date", "last"),
        ("delisted_date", "delistedDate", "date", "last"),
    ]),
    ("insider_trades", "DAILY", ("symbol", "date"), "insider_trades", "transactionDate", [
        ("insider_filing_date", "filingDate", "date", "last"),
        ("reporting_cik", "reportingCik", "string", "last"),
        ("company_cik", "companyCik", "string", "last"),
        ("transaction_type", "transactionType", "string", "last"),
        ("securities_owned", "securitiesOwned", "bigint", "last"),
        ("reporting_name", "reportingName", "string", "last"),
        ("type_of_owner", "typeOfOwner", "string", "last"),
        ("acquisition_or_disposition", "acquisitionOrDisposition", "string", "last"),
        ("direct_or_indirect", "directOrIndirect", "string", "last"),
        ("form_type", "formType", "string", "last"),
        ("securities_transacted", "securitiesTransacted", "bigint", "last"),
        ("insider_price", "price", "double", "last"),
        ("security_name", "securityName", "string", "last"),
        ("insider_url", "url", "string", "last"),
    ]),
    ("mergers_acquisitions", "DAILY", ("symbol", "date"), "sec_filings", "transactionDate", [
        ("ma_company_name", "companyName", "string", "last"),
        ("ma_cik", "cik", "string", "last"),
        ("targeted_company_name", "targetedCompanyName", "string", "last"),
        ("targeted_cik", "targetedCik", "string", "last"),
        ("targeted_symbol", "targetedSymbol", "string", "last"),
        ("ma_accepted_date", "acceptedDate", "string", "last"),
        ("ma_link", "link", "string", "last"),
    ]),
    ("earnings_calendar", "DAILY", ("symbol", "date"), "earnings_calendar", "date", [
        ("ec_eps_actual", "epsActual", "double", "last"),
        ("ec_eps_estimated", "epsEstimated", "double", "last"),
        ("ec_revenue_actual", "revenueActual", "bigint", "last"),
        ("ec_revenue_estimated", "revenueEstimated", "bigint", "last"),
        ("ec_last_updated", "lastUpdated", "date", "last"),
    ]),
    ("dividends_calendar", "DAILY", ("symbol", "date"), "earnings_calendar", "date", [
        ("dc_record_date", "recordDate", "date", "last"),
        ("dc_payment_date", "paymentDate", "date", "last"),
        ("dc_declaration_date", "declarationDate", "date", "last"),
        ("dc_adj_dividend", "adjDividend", "double", "last"),
        ("dc_dividend", "dividend", "double", "last"),
        ("dc_yield", "yield", "double", "last"),
        ("dc_frequency", "frequency", "string", "last"),
    ]),
    ("splits_calendar", "DAILY", ("symbol", "date"), "earnings_calendar", "date", [
        ("split_numerator", "numerator", "int", "last"),
        ("split_denominator", "denominator", "int", "last"),
        ("split_type", "splitType", "string", "last"),
    ]),
    ("ipos_calendar", "DAILY", ("symbol", "date"), "earnings_calendar", "date", [
        ("ipo_company", "company", "string", "last"),
        ("ipo_exchange", "exchange", "string", "last"),
        ("ipo_actions", "actions", "string", "last"),
        ("ipo_shares", "shares", "bigint", "last"),
        ("ipo_price_range", "priceRange", "string", "last"),
        ("ipo_market_cap", "marketCap", "bigint", "last"),
    ]),
    ("economic_calendar", "DAILY", ("date",), "daily_historical", "date", [
        ("econ_country", "country", "string", "last"),
        ("econ_event", "event", "string", "last"),
        ("econ_currency", "currency", "string", "last"),
        ("econ_previous", "previous", "double", "last"),
        ("econ_estimate", "estimate", "double", "last"),
        ("econ_actual", "actual", "double", "last"),
        ("econ_change", "change", "double", "last"),
        ("econ_impact", "impact", "string", "last"),
        ("econ_change_pct", "changePercentage", "double", "last"),
        ("econ_unit", "unit", "string", "last"),
    ]),
    ("income_statement_ttm", "SNAPSHOT", ("symbol",), "financial_statements", "date", [
        ("ttm_revenue", "revenue", "bigint", "last"),
        ("ttm_cost_of_revenue", "costOfRevenue", "bigint", "last"),
        ("ttm_gross_profit", "grossProfit", "bigint", "last"),
        ("ttm_rd_expenses", "researchAndDevelopmentExpenses", "bigint", "last"),
        ("ttm_sga_expenses", "sellingGeneralAndAdministrativeExpenses", "bigint", "last"),
        ("ttm_operating_expenses", "operatingExpenses", "bigint", "last"),
        ("ttm_operating_income", "operatingIncome", "bigint", "last"),
        ("ttm_interest_income", "interestIncome", "bigint", "last"),
        ("ttm_interest_expense", "interestExpense", "bigint", "last"),
        ("ttm_ebitda", "ebitda", "bigint", "last"),
        ("ttm_ebit", "ebit", "bigint", "last"),
        ("ttm_net_income", "netIncome", "bigint", "last"),
        ("ttm_eps", "eps", "double", "last"),
        ("ttm_eps_diluted", "epsDiluted", "double", "last"),
        ("ttm_income_before_tax", "incomeBeforeTax", "bigint", "last"),
        ("ttm_income_tax_expense", "incomeTaxExpense", "bigint", "last"),
        ("ttm_da", "depreciationAndAmortization", "bigint", "last"),
    ]),
    ("key_metrics_ttm", "SNAPSHOT", ("symbol",), "financial_statements", "date", [
        ("ttm_market_cap", "marketCap", "bigint", "last"),
        ("ttm_ev", "enterpriseValueTTM", "bigint", "last"),
        ("ttm_ev_to_sales", "evToSalesTTM", "double", "last"),
        ("ttm_ev_to_ocf", "evToOperatingCashFlowTTM", "double", "last"),
        ("ttm_ev_to_fcf", "evToFreeCashFlowTTM", "double", "last"),
        ("ttm_ev_to_ebitda", "evToEBITDATTM", "double", "last"),
        ("ttm_net_debt_to_ebitda", "netDebtToEBITDATTM", "double", "last"),
        ("ttm_current_ratio", "currentRatioTTM", "double", "last"),
        ("ttm_roa", "returnOnAssetsTTM", "double", "last"),
        ("ttm_roe", "returnOnEquityTTM", "double", "last"),
        ("ttm_roic", "returnOnInvestedCapitalTTM", "double", "last"),
        ("ttm_roce", "returnOnCapitalEmployedTTM", "double", "last"),
        ("ttm_earnings_yield", "earningsYieldTTM", "double", "last"),
        ("ttm_fcf_yield", "freeCashFlowYieldTTM", "double", "last"),
        ("ttm_capex_to_ocf", "capexToOperatingCashFlowTTM", "double", "last"),
        ("ttm_capex_to_revenue", "capexToRevenueTTM", "double", "last"),
        ("ttm_rd_to_revenue", "researchAndDevelopementToRevenueTTM", "double", "last"),
        ("ttm_sbc_to_revenue", "stockBasedCompensationToRevenueTTM", "double", "last"),
        ("ttm_dso", "daysOfSalesOutstandingTTM", "double", "last"),
        ("ttm_dpo", "daysOfPayablesOutstandingTTM", "double", "last"),
        ("ttm_dio", "daysOfInventoryOutstandingTTM", "double", "last"),
        ("ttm_ccc", "cashConversionCycleTTM", "double", "last"),
        ("ttm_graham_number", "grahamNumberTTM", "double", "last"),
        ("ttm_working_capital", "workingCapitalTTM", "bigint", "last"),
        ("ttm_invested_capital", "investedCapitalTTM", "bigint", "last"),
        ("ttm_tangible_asset_value", "tangibleAssetValueTTM", "bigint", "last"),
    ]),
    ("ratios_ttm", "SNAPSHOT", ("symbol",), "financial_statements", "date", [
        ("ttm_gross_margin", "grossProfitMarginTTM", "double", "last"),
        ("ttm_ebitda_margin", "ebitdaMarginTTM", "double", "last"),
        ("ttm_operating_margin", "operatingProfitMarginTTM", "double", "last"),
        ("ttm_net_margin", "netProfitMarginTTM", "double", "last"),
        ("ttm_pe_ratio", "priceToEarningsRatioTTM", "double", "last"),
        ("ttm_peg_ratio", "priceToEarningsGrowthRatioTTM", "double", "last"),
        ("ttm_pb_ratio", "priceToBookRatioTTM", "double", "last"),
        ("ttm_ps_ratio", "priceToSalesRatioTTM", "double", "last"),
        ("ttm_p_to_fcf", "priceToFreeCashFlowRatioTTM", "double", "last"),
        ("ttm_p_to_ocf", "priceToOperatingCashFlowRatioTTM", "double", "last"),
        ("ttm_debt_to_assets", "debtToAssetsRatioTTM", "double", "last"),
        ("ttm_debt_to_equity", "debtToEquityRatioTTM", "double", "last"),
        ("ttm_debt_to_capital", "debtToCapitalRatioTTM", "double", "last"),
        ("ttm_financial_leverage", "financialLeverageRatioTTM", "double", "last"),
        ("ttm_quick_ratio", "quickRatioTTM", "double", "last"),
        ("ttm_cash_ratio", "cashRatioTTM", "double", "last"),
        ("ttm_receivables_turnover", "receivablesTurnoverTTM", "double", "last"),
        ("ttm_inventory_turnover", "inventoryTurnoverTTM", "double", "last"),
        ("ttm_asset_turnover", "assetTurnoverTTM", "double", "last"),
        ("ttm_ocf_ratio", "operatingCashFlowRatioTTM", "double", "last"),
        ("ttm_ocf_to_sales", "operatingCashFlowSalesRatioTTM", "double", "last"),
        ("ttm_fcf_to_ocf", "freeCashFlowOperatingCashFlowRatioTTM", "double", "last"),
        ("ttm_interest_coverage", "interestCoverageTTM", "double", "last"),
        ("ttm_dividend_payout", "dividendPayoutRatioTTM", "double", "last"),
        ("ttm_dividend_yield_r", "dividendYieldTTM", "double", "last"),
        ("ttm_effective_tax_rate", "effectiveTaxRateTTM", "double", "last"),
        ("ttm_revenue_per_share", "revenuePerShareTTM", "double", "last"),
        ("ttm_ni_per_share", "netIncomePerShareTTM", "double", "last"),
        ("ttm_book_value_per_share", "bookValuePerShareTTM", "double", "last"),
        ("ttm_ocf_per_share", "operatingCashFlowPerShareTTM", "double", "last"),
        ("ttm_fcf_per_share", "freeCashFlowPerShareTTM", "double", "last"),
        ("ttm_cash_per_share", "cashPerShareTTM", "double", "last"),
        ("ttm_ev_multiple", "enterpriseValueMultipleTTM", "double", "last"),
        ("ttm_dividend_per_share", "dividendPerShareTTM", "double", "last"),
    ]),
    ("income_growth", "QUARTERLY", ("symbol", "date", "period"), "financial_statements", "date", [
        ("growth_revenue", "growthRevenue", "double", "last"),
        ("growth_gross_profit", "growthGrossProfit", "double", "last"),
        ("growth_gross_profit_ratio", "growthGrossProfitRatio", "double", "last"),
        ("growth_rd_expenses", "growthResearchAndDevelopmentExpenses", "double", "last"),
        ("growth_operating_expenses", "growthOperatingExpenses", "double", "last"),
        ("growth_operating_income", "growthOperatingIncome", "double", "last"),
        ("growth_ebitda", "growthEBITDA", "double", "last"),
        ("growth_net_income", "growthNetIncome", "double", "last"),
        ("growth_eps", "growthEPS", "double", "last"),
        ("growth_eps_diluted", "growthEPSDiluted", "double", "last"),
    ]),
    ("balance_sheet_growth", "QUARTERLY", ("symbol", "date", "period"), "financial_statements", "date", [
        ("growth_cash", "growthCashAndCashEquivalents", "double", "last"),
        ("growth_receivables", "growthNetReceivables", "double", "last"),
        ("growth_inventory", "growthInventory", "double", "last"),
        ("growth_total_current_assets", "growthTotalCurrentAssets", "double", "last"),
        ("growth_total_assets", "growthTotalAssets", "double", "last"),
        ("growth_short_term_debt", "growthShortTermDebt", "double", "last"),
        ("growth_long_term_debt", "growthLongTermDebt", "double", "last"),
        ("growth_total_liabilities", "growthTotalLiabilities", "double", "last"),
        ("growth_retained_earnings", "growthRetainedEarnings", "double", "last"),
        ("growth_total_equity", "growthTotalStockholdersEquity", "double", "last"),
        ("growth_total_debt", "growthTotalDebt", "double", "last"),
        ("growth_net_debt", "growthNetDebt", "double", "last"),
    ]),
    ("cash_flow_growth", "QUARTERLY", ("symbol", "date", "period"), "financial_statements", "date", [
        ("growth_operating_cf", "growthNetCashProvidedByOperatingActivites", "double", "last"),
        ("growth_investing_cf", "growthNetCashUsedForInvestingActivites", "double", "last"),
        ("growth_financing_cf", "growthNetCashUsedProvidedByFinancingActivities", "double", "last"),
        ("growth_capex", "growthCapitalExpenditure", "double", "last"),
        ("growth_fcf", "growthFreeCashFlow", "double", "last"),
        ("growth_dividends_paid", "growthDividendsPaid", "double", "last"),
        ("growth_stock_repurchased", "growthCommonStockRepurchased", "double", "last"),
        ("growth_sbc", "growthStockBasedCompensation", "double", "last"),
        ("growth_da", "growthDepreciationAndAmortization", "double", "last"),
        ("growth_net_change_cash", "growthNetChangeInCash", "double", "last"),
    ]),
    # Event tables of the recent-event signals.
    ("senate_trades", "DAILY", ("symbol", "date"), "senate", "transactionDate", [
        ("senate_trade_type", "type", "string", "last"),
    ]),
    ("grade_changes", "DAILY", ("symbol", "date"), "analyst", "date", [
        ("grade_action", "action", "string", "last"),
    ]),
]
