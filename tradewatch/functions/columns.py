"""Column -> Column helpers. All are built-in expressions (JVM side, inside
whole-stage codegen); none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text form of event times, and the quote assets that end a venue's symbol.
ISO_MS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
QUOTE_ASSETS = ("USDT", "BTC", "ETH")

MONEY = "decimal(28,8)"
MONEY_LIMIT = 1e20
FIRST_MS, LAST_MS = -62_135_596_800_000, 253_402_300_799_999


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- symbols --------------------------------------------------------------

def _split_quote(c, names: dict) -> Column:
    """BASEQUOTE -> BASE-QUOTE, quotes renamed by ``names``; other symbols pass in upper case."""
    s, out = F.upper(_c(c)), None
    for quote in QUOTE_ASSETS:
        split = F.concat(s.substr(F.lit(1), F.length(s) - len(quote)), F.lit("-" + names.get(quote, quote)))
        out = F.when(s.endswith(quote), split) if out is None else out.when(s.endswith(quote), split)
    return out.otherwise(s)


def norm_symbol(c) -> Column:
    """Venue A pair to BASE-QUOTE: BTCUSDT -> BTC-USDT; quote assets USDT, BTC,
    ETH are split off, any other symbol passes unchanged."""
    return _split_quote(c, {})


def norm_symbol_usd(c) -> Column:
    """Venue B product id to the unified symbol: BTC-USD -> BTC-USDT; -BTC and
    -ETH pairs unchanged."""
    return F.regexp_replace(F.upper(_c(c)), "-USD$", "-USDT")


def norm_product_id(c) -> Column:
    """Configured symbol to venue B product id: btcusdt -> BTC-USD."""
    return _split_quote(c, {"USDT": "USD"})


# ---- time -------------------------------------------------------------------

def norm_epoch_ms(c) -> Column:
    """Epoch milliseconds to a UTC timestamp (millisecond precision); null outside the years 1 to 9999."""
    return F.when(_c(c).between(F.lit(FIRST_MS), F.lit(LAST_MS)), F.timestamp_millis(_c(c)))


def iso_ms(c) -> Column:
    """Timestamp to ISO-8601 text with milliseconds and a Z suffix."""
    return F.date_format(_c(c), ISO_MS)


def norm_iso_ms(c) -> Column:
    """ISO text with microseconds to a timestamp truncated (not rounded) to ms;
    null for a text that is no time."""
    return F.date_trunc("millisecond", F.try_to_timestamp(F.regexp_replace(_c(c), "Z$", "")))


def norm_quote_volume(price, qty) -> Column:
    return _c(price) * _c(qty)


def norm_ingest_stamp(at=None) -> Column:
    """Ingestion time: the micro-batch clock in streams, a parameter in tests."""
    if at is None:
        return F.current_timestamp()
    return F.lit(at).cast("timestamp") if not isinstance(at, Column) else at


def epoch_seconds(c) -> Column:
    return F.unix_micros(_c(c)) / F.lit(1_000_000)


# ---- money ----------------------------------------------------------------------

def money(c) -> Column:
    """Exact money for sums: double -> DECIMAL(28,8); null for what it can't hold (not a number, infinite, too large)."""
    return _c(c).try_cast(MONEY)


def in_money_range(c) -> Column:
    """Whether a double is finite and within DECIMAL(28,8); a number that is none is not."""
    return F.abs(_c(c)) < F.lit(MONEY_LIMIT)


def money_sum(c) -> Column:
    """Order-independent sum of a double column, returned as double."""
    return F.sum(money(c)).cast("double")


def ratio(num: Column, den: Column) -> Column:
    """Null-safe division (null when the divisor is 0 or null)."""
    return F.try_divide(num, F.when(den != 0, den))


# ---- ids ---------------------------------------------------------------------------

def lin_correlation_id(exchange, symbol, ts_text) -> Column:
    """First 16 hex characters of sha256("exchange:symbol:timestamp")."""
    return F.substring(F.sha2(F.concat_ws(":", _c(exchange), _c(symbol), _c(ts_text)), 256), 1, 16)


def alert_id(*parts) -> Column:
    """Deterministic alert id: first 32 hex chars of sha256 over the parts."""
    return F.substring(F.sha2(F.concat_ws("|", *[F.coalesce(_c(p).cast("string"), F.lit("")) for p in parts]), 256), 1, 32)


def stable_round(c, places: int = 4) -> Column:
    """Round through DECIMAL(38,10) with HALF_UP: the same digits in any engine
    even for values that sit on a tie (money sums of short decimals often do)."""
    return F.round(_c(c).cast("decimal(38,10)"), places).cast("double")
