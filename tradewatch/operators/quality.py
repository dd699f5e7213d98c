"""Data quality: rule predicates, the valid/invalid split and metrics
(SURVEY 2.4). Every rule appends its name to ``failed_rules``; ``reason`` is
the first failure in the order malformed, incomplete, invalid (R13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewatch.functions.columns import QUOTE_ASSETS, in_money_range, ratio

TRADE_JSON_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()), T.StructField("exchange", T.StringType()),
    T.StructField("symbol", T.StringType()), T.StructField("price", T.DoubleType()),
    T.StructField("quantity", T.DoubleType()), T.StructField("quote_volume", T.DoubleType()),
    T.StructField("side", T.StringType()), T.StructField("timestamp", T.StringType()),
    T.StructField("ingestion_timestamp", T.StringType()),
])

REQUIRED = ("event_id", "symbol", "price", "quantity", "timestamp")
KEY = ("exchange", "symbol", "event_id")


def empty() -> Column:
    return F.array().cast("array<string>")


def unified_symbol(s: str) -> str:
    """Config symbol (btcusdt) -> unified form (BTC-USDT); config-side only."""
    u = s.upper()
    quote = next((q for q in QUOTE_ASSETS if "-" not in u and u.endswith(q)), None)
    return f"{u[: -len(quote)]}-{quote}" if quote else u


def _with_rule(df: DataFrame, name: str, failed: Column) -> DataFrame:
    base = F.col("failed_rules") if "failed_rules" in df.columns else empty()
    add = F.when(F.coalesce(failed, F.lit(False)), F.array(F.lit(name))).otherwise(empty())
    return df.withColumn("failed_rules", F.concat(base, add))


def dq_schema(df: DataFrame, schema: T.StructType = TRADE_JSON_SCHEMA, value_col: str = "value") -> DataFrame:
    """Parse payloads; rows that are not a JSON object of the schema (cut
    short, a field of the wrong type, a time that is none) get the
    ``malformed`` rule and null fields. Times arrive as ISO text. No record
    ends the job."""
    corrupt = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json(F.col(value_col), corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    times = [f for f in ("timestamp", "ingestion_timestamp") if f in schema.names]
    when = {f: F.try_to_timestamp(F.regexp_replace(F.col(f"_p.{f}"), "Z$", "")) for f in times}
    bad = (F.col(value_col).isNull() | F.col("_p").isNull() | F.col("_p._corrupt").isNotNull()
           | ~F.coalesce(F.ltrim(F.col(value_col)).startswith("{"), F.lit(False)))
    for f in times:
        bad = bad | (F.col(f"_p.{f}").isNotNull() & when[f].isNull())
    keep = [c for c in df.columns if c not in schema.names]
    out = df.withColumn("_p", parsed).withColumn("_malformed", bad)
    out = out.select(*keep, *[F.when(~F.col("_malformed"), when.get(n, F.col(f"_p.{n}"))).alias(n) for n in schema.names], "_malformed")
    return _with_rule(out, "malformed", F.col("_malformed")).drop("_malformed")


def dq_complete(df: DataFrame, cols=REQUIRED) -> DataFrame:
    missing = None
    for c in cols:
        m = F.col(c).isNull()
        missing = m if missing is None else (missing | m)
    return _with_rule(df, "incomplete", missing)


def dq_valid_range(df: DataFrame) -> DataFrame:
    """Price and quantity must be positive, and they, their product and the quote volume finite
    numbers that exact sums can hold; what is missing is another rule's."""
    price, quantity, volume = F.col("price"), F.col("quantity"), F.col("quote_volume")
    bad = (price <= 0) | (quantity <= 0) | F.coalesce(~in_money_range(price), F.lit(False)) | F.coalesce(~in_money_range(quantity), F.lit(False))
    product = F.coalesce(~in_money_range(price * quantity), F.lit(False))
    return _with_rule(df, "invalid_range", F.coalesce(bad, F.lit(False)) | product | F.coalesce(~in_money_range(volume), F.lit(False)))


def dq_valid_symbol(df: DataFrame, symbols) -> DataFrame:
    allowed = [unified_symbol(s) for s in symbols]
    return _with_rule(df, "invalid_symbol", F.col("symbol").isNotNull() & ~F.col("symbol").isin(allowed))


def dq_valid_exchange(df: DataFrame, exchanges) -> DataFrame:
    return _with_rule(df, "invalid_exchange", ~F.coalesce(F.col("exchange").isin(list(exchanges)), F.lit(False)))


def dq_valid_side(df: DataFrame) -> DataFrame:
    return _with_rule(df, "invalid_side", ~F.coalesce(F.col("side").isin("buy", "sell"), F.lit(False)))


def dq_custom_rules(df: DataFrame, rules) -> DataFrame:
    """Rules from config: dicts with ``name``, ``expr`` (a SQL predicate that
    must hold) and ``severity`` ('error' fails the row, 'warn' only tags it)."""
    for r in rules:
        broken = ~F.coalesce(F.expr(r["expr"]), F.lit(False))
        if r.get("severity", "error") == "warn":
            base = F.col("warnings") if "warnings" in df.columns else empty()
            df = df.withColumn("warnings", F.concat(base, F.when(broken, F.array(F.lit(r["name"]))).otherwise(empty())))
        else:
            df = _with_rule(df, r["name"], broken)
    return df


def with_reason(df: DataFrame) -> DataFrame:
    fr = F.col("failed_rules")
    reason = (F.when(F.array_contains(fr, "malformed"), "malformed")
              .when(F.array_contains(fr, "incomplete"), "incomplete")
              .when(F.size(fr) > 0, "invalid"))
    return df.withColumn("reason", reason)


def dq_flag_duplicates(df: DataFrame, seconds: int = 3600) -> DataFrame:
    """``is_duplicate``: the previous row with the same (exchange, symbol,
    event_id) came at most ``seconds`` earlier (R2). Rows that already failed a
    rule are never duplicates; they are spread over a hash of their payload
    instead of sharing one null key."""
    ok = F.col("reason").isNull() if "reason" in df.columns else F.lit(True)
    salt = F.xxhash64(*[F.col(c) for c in df.columns if c not in ("failed_rules", "warnings")])
    part = [F.when(ok, F.col(c)).otherwise(F.lit(None)) for c in KEY] + [F.when(~ok, salt)]
    w = Window.partitionBy(*part).orderBy("timestamp", "ingestion_timestamp")
    prev = F.lag("timestamp").over(w)
    gap = (F.unix_micros("timestamp") - F.unix_micros(prev)) <= F.lit(seconds * 1_000_000)
    return df.withColumn("is_duplicate", ok & F.coalesce(gap, F.lit(False)))


def dq_dedup(df: DataFrame, seconds: int = 3600) -> DataFrame:
    """Drop repeats of an event within ``seconds``, keeping the first."""
    return dq_flag_duplicates(df, seconds).where(~F.col("is_duplicate")).drop("is_duplicate")


def dq_late_flag(df: DataFrame, seconds: int = 300, as_of=None) -> DataFrame:
    """``is_late``: older than ``seconds`` at processing time (ingestion time,
    or ``as_of`` when given). ``is_early``: that much in the future, a skewed
    clock. Both are kept."""
    ref = F.col("ingestion_timestamp") if as_of is None else (
        as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp"))
    lag_us = F.unix_micros(ref) - F.unix_micros("timestamp")
    return df.withColumn("is_late", F.coalesce(lag_us > F.lit(seconds * 1_000_000), F.lit(False))).withColumn(
        "is_early", F.coalesce(lag_us < F.lit(-seconds * 1_000_000), F.lit(False)))


def dq_consistency(df: DataFrame, tol: float = 0.001) -> DataFrame:
    """``qv_warn``: quote_volume disagrees with price * quantity by >= tol."""
    rel = ratio(F.abs(F.col("quote_volume") - F.col("price") * F.col("quantity")), F.col("quote_volume"))
    return df.withColumn("qv_warn", F.coalesce(rel >= F.lit(tol), F.lit(False)))


def dq_flag(df: DataFrame, cfg: dict, as_of=None, parse: bool = True) -> DataFrame:
    """All row rules in order, plus reason, late, consistency and duplicate
    flags, in a single pass (one shuffle, for the duplicate window)."""
    q = cfg["quality"]
    out = dq_schema(df) if parse else df.withColumn("failed_rules", empty())
    out = dq_complete(out)
    out = dq_valid_range(out)
    out = dq_valid_symbol(out, cfg["symbols"])
    out = dq_valid_exchange(out, cfg["exchanges"])
    out = dq_valid_side(out)
    out = dq_custom_rules(out, q.get("custom_rules", []))
    out = with_reason(out)
    out = dq_late_flag(out, q["late_seconds"], as_of)
    out = dq_consistency(out, q["consistency_tolerance"])
    return dq_flag_duplicates(out, q["dedup_seconds"])


def dq_validate(df: DataFrame, cfg: dict, as_of=None, processing_date=None, parse: bool = True):
    """Return (valid, invalid, metrics). ``invalid`` carries reason,
    failed_rules and the DLQ day ``dt``; duplicates are dropped and counted."""
    flagged = dq_flag(df, cfg, as_of, parse)
    valid = flagged.where(F.col("reason").isNull() & ~F.col("is_duplicate")).drop("failed_rules", "reason",
                                                                                      "is_duplicate")
    day = F.current_date() if processing_date is None else F.lit(processing_date).cast("date")
    invalid = flagged.where(F.col("reason").isNotNull()).withColumn(
        "dt", F.date_format(F.coalesce(F.to_date("timestamp"), day), "yyyy-MM-dd")).drop("is_duplicate")
    return valid, invalid, dq_metrics(flagged)


def dq_metrics(flagged: DataFrame) -> DataFrame:
    """processed, passed, failed, late, duplicate, score and failure in %."""
    failed = F.col("reason").isNotNull()
    agg = flagged.agg(
        F.count(F.lit(1)).alias("processed"),
        F.count(F.when(~failed & ~F.col("is_duplicate"), 1)).alias("passed"),
        F.count(F.when(failed, 1)).alias("failed"),
        F.count(F.when(F.col("is_late"), 1)).alias("late"),
        F.count(F.when(F.col("is_duplicate"), 1)).alias("duplicate"),
    )
    return agg.select(
        "*",
        F.round(ratio(F.lit(100.0) * (F.col("processed") - F.col("failed")), F.col("processed")), 6).alias("quality_score_pct"),
        F.round(ratio(F.lit(100.0) * F.col("failed"), F.col("processed")), 6).alias("failure_pct"),
    )


def dq_score_series(flagged: DataFrame, width: str = "1 hour") -> DataFrame:
    """Pass and fail rates per event-time interval."""
    failed = F.col("reason").isNotNull()
    g = flagged.where(F.col("timestamp").isNotNull()).groupBy(F.window("timestamp", width).alias("w")).agg(
        F.count(F.lit(1)).alias("records"),
        F.count(F.when(~failed, 1)).alias("passed"),
        F.count(F.when(failed, 1)).alias("failed"))
    return g.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "records", "passed", "failed",
        F.round(F.lit(100.0) * F.col("passed") / F.col("records"), 6).alias("pass_rate_pct"),
        F.round(F.lit(100.0) * F.col("failed") / F.col("records"), 6).alias("fail_rate_pct"))


def dq_failure_breakdown(invalid: DataFrame) -> DataFrame:
    return invalid.groupBy("reason").agg(F.count(F.lit(1)).alias("failures"))


def dq_rule_breakdown(flagged: DataFrame) -> DataFrame:
    """Failures per rule before precedence (a row may count under several)."""
    return (flagged.select(F.explode("failed_rules").alias("rule"))
            .groupBy("rule").agg(F.count(F.lit(1)).alias("failures")))


def dq_recent_failures(invalid: DataFrame, n: int = 20) -> DataFrame:
    """Latest failed samples with reasons (a top-k: TakeOrderedAndProject)."""
    return (invalid.select("key", "event_id", "timestamp", "reason",
                           F.concat_ws(",", "failed_rules").alias("failed_rules"))
            .orderBy(F.col("timestamp").desc_nulls_last(), F.col("key").desc(), F.col("failed_rules").desc())
            .limit(n))


def dq_dlq_summary(invalid: DataFrame) -> DataFrame:
    return invalid.groupBy("dt", "reason").agg(F.count(F.lit(1)).alias("records"))


def dq_stream_gap(df: DataFrame, width_seconds: int, start=None, as_of=None) -> DataFrame:
    """Windows with no record per (exchange, symbol) from ``start`` to ``as_of``
    (default: the first and last window of the whole input), so that a feed that came
    late or has stopped is reported too. The calendar grows with time span / width,
    not with rows."""
    w_us = width_seconds * 1_000_000

    def window_of(c):
        return (F.floor(F.unix_micros(c) / F.lit(w_us)) * F.lit(w_us)).cast("long")

    def bound(given, default):
        if given is None:
            return df.agg(default("timestamp")).scalar()
        return given if isinstance(given, Column) else F.lit(given).cast("timestamp")

    seen = df.select("exchange", "symbol", window_of(F.col("timestamp")).alias("ws")).distinct()
    cal = seen.select("exchange", "symbol").distinct().select("exchange", "symbol", F.explode(F.sequence(
        window_of(bound(start, F.min)), window_of(bound(as_of, F.max)), F.lit(w_us).cast("long"))).alias("ws"))
    gaps = cal.join(seen, ["exchange", "symbol", "ws"], "left_anti")
    return gaps.select("exchange", "symbol", F.timestamp_micros("ws").alias("window_start"),
                       F.timestamp_micros(F.col("ws") + F.lit(w_us)).alias("window_end"))


def dq_feed_staleness(df: DataFrame, as_of=None, seconds: int = 30) -> DataFrame:
    """Per venue: last message time and healthy = a message within ``seconds``
    of ``as_of`` (default: the latest event of all venues)."""
    last = df.groupBy("exchange").agg(F.max("timestamp").alias("last_seen"))
    if as_of is None:
        last = last.withColumn("as_of", df.agg(F.max("timestamp")).scalar())  # scalar subquery
    else:
        last = last.withColumn("as_of", as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp"))
    age = F.unix_micros("as_of") - F.unix_micros("last_seen")
    return last.select("exchange", "last_seen", (age / F.lit(1_000_000)).alias("age_seconds"),
                       (age < F.lit(seconds * 1_000_000)).alias("healthy"))


def dq_batch_gate(df: DataFrame, expected_schema: T.StructType | None = None, min_rows: int = 1) -> DataFrame:
    """One row: passed and the reasons for failure. The schema test compares
    metadata on the driver; the row count is one distributed aggregate."""
    schema_ok = True
    if expected_schema is not None:
        have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        schema_ok = all(have.get(f.name) == f.dataType.simpleString() for f in expected_schema.fields)
    cnt = df.agg(F.count(F.lit(1)).alias("row_count"))
    reasons = F.concat_ws(",", F.array_compact(F.array(
        F.when(F.col("row_count") < F.lit(min_rows), F.lit("too_few_rows")),
        F.when(~F.lit(schema_ok), F.lit("schema_mismatch")))))
    return cnt.select("row_count", F.lit(schema_ok).alias("schema_ok"),
                      ((F.col("row_count") >= F.lit(min_rows)) & F.lit(schema_ok)).alias("passed"),
                      reasons.alias("reasons"))
