"""Parameters and fixed values used across the package."""

PERIODS = (5, 10, 20)          # trading rows in a return window
MIN_COVERAGE = 0.7             # share of a period that must be present
SLACK_DAYS = 5                 # calendar days read in addition to a period
TOP_HOLDINGS = 5               # holdings kept per fund
PORTFOLIO_SIZE = 20            # names in the monthly portfolio
NEW_NAME_FIRST_RANK = 20       # names absent from the 20-day portfolio start here
VALID_DAYS = 28                # calendar days a monthly portfolio stays valid

# ---- fixed values -------------------------------------------------------
MAIN_BENCHMARK = "SPY"
BENCHMARK_FUNDS = ("SPY", "QQQ", "IWM", "DIA", "EWY", "SCHD")
BENCHMARK_PRIORITY = ("QQQ", "SPY", "IWM", "DIA", "EWY", "SCHD")
SECTOR_OF_FUND = {
    "XLK": "Technology",
    "XLV": "Healthcare",
    "XLF": "Financial",
    "XLY": "Consumer Cyclical",
    "XLC": "Communication",
    "XLI": "Industrial",
    "XLP": "Consumer Defensive",
    "XLE": "Energy",
    "XLU": "Utilities",
    "XLRE": "Real Estate",
    "XLB": "Basic Materials",
}
TREND_UNIVERSE = (MAIN_BENCHMARK, *SECTOR_OF_FUND)
PLACEHOLDER_TICKER = r"(?i)^STOCK\d+$"
PLACEHOLDER_NAME_PREFIXES = ("STOCK ",)
TICKER_PATTERN = r"^[A-Z][A-Z0-9.\-]{0,9}$"
BENCHMARK_SECTOR = "Benchmark"
UNKNOWN_SECTOR = "Unknown"
ALLOCATION_REASON = "top1_perf_per_etf_%dd_score_perf_x_inv_mcap"
OVERLAP_SCORES = {
    "base_20d": 1.0,
    "also_10d": 1.0,
    "also_5d": 1.0,
    "10d_and_5d": 2.0,
    "10d_only": 0.5,
    "5d_only": 0.3,
}
# -------------------------------------------------------------------------
