"""tradewatch: trade-surveillance operators on Spark DataFrames.

sources/    driver tables, domain adapters, raw_trades / stream / dump readers
functions/  Column helpers (symbols, time, money, ids) and size-checked joins
operators/  DataFrame -> DataFrame operators per module, plus window helpers
plans/      run_modules, sinks, lakehouse operations
streaming/  Structured Streaming jobs and keyed-state scoring
suite/      registered queries and their DuckDB oracle SQL
"""

from tradewatch.config import DEFAULTS, make_config  # noqa: F401
