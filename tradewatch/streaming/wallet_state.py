"""MOD-004 on a stream: wallet scores kept up to date per micro-batch, in
DataFrame operations.

State is two tables. Trades are stored by (month, batch), sorted by day; a replayed batch
overwrites its own part. Summaries are stored by month. A (wallet, day) to which every batch brought a few
trades only is kept as its trades, each a summary of its own (a unit): a batch adds its units and reads none of the older
ones. Any other (wallet, day) is kept ``whole``: a batch that touches it, late rows included, builds its summary
again from the stored trades of those days. A whole summary replaces the units of its (wallet, day) and whole ones
of fewer trades. The scores of the horizon are combined from the summaries, as in the batch operator.

Summaries have two tiers: those batches append, and, once a month holds those of many batches, one
compacted set of whole ones that replaces them. Months before the horizon are removed. So the summaries a batch opens
and the rows it builds depend on the batch and the horizon, not on the number of batches before."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradewatch.operators import wallet as W
from tradewatch.plans.files import exists, file_names, partition_values, remove

DAY = 86400
COMPACT_AFTER = 8  # writes to a month before its summaries are compacted


MONTH_PARTS = 8  # tasks that write a month of a batch
UNITS = 8  # trades that a batch may bring to a (wallet, day) kept as units


def _segments(trades: DataFrame) -> DataFrame:
    return W.wallet_segments(trades.withColumn("_as_of", F.col("ts")), W.KEYS, DAY)


def _day_number():
    return F.floor(F.unix_micros("ts") / F.lit(DAY * 1_000_000)).cast("long")


def _pair():
    return F.xxhash64(*W.KEYS, "_tb").alias("_pair")


def _spread(rows: DataFrame, *of: str) -> DataFrame:
    """Rows laid out so that a month is written by several tasks, but not by all."""
    return rows.repartition("month", F.pmod(F.xxhash64(*of), F.lit(MONTH_PARTS)))


def _month_of_bucket() -> F.Column:
    return F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), F.col("_tb").cast("int")), "yyyy-MM")


#: A key's summaries: days in order, in a day the whole summary of the most trades first, units by time.
ORDER = [F.col("_tb"), F.col("whole").desc(), F.col("trade_count").desc(), F.col("_last")]


UNIT = [*W.KEYS, "_total", "wins", "_ret_sum", "_last"]  # what a score reads of a unit
SUMMARY = [*UNIT, "_tb", "_inner", "_low", "_high", "_values", "trade_count"]  # and of a whole summary


def _valid(segments: DataFrame) -> DataFrame:
    """The summaries that count: of a (wallet, day) with whole ones, copies included, one of the most trades, else its units."""
    w = Window.partitionBy(*W.KEYS).orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1)
    held = F.max(F.when(F.col("whole") == 1, F.col("_tb"))).over(w)
    return segments.withColumn("_held", held).where(F.col("_held").isNull() | (F.col("_held") < F.col("_tb"))).drop("_held")


def latest_segments(segments: DataFrame) -> DataFrame:
    """The whole summary of every (wallet, day)."""
    own, valid = [*W.KEYS, "_tb"], _valid(segments)
    whole = valid.where("whole = 1")
    folded = W.fold_units(valid.where("whole = 0"), own)
    return whole.select(*folded.columns).unionByName(folded)


def _compact(segments: DataFrame, month: str, segments_path: str, epoch: int) -> None:
    """Replace a month's summaries by whole ones. The
    new files are complete before the old ones go: a failure in between leaves copies, no gap."""
    spark, folder = segments.sparkSession, f"{segments_path}/month={month}"
    old = file_names(spark, folder)  # bounded by the compaction itself
    rows = _stored(latest_segments(segments.where(F.col("month") == month)), epoch, 1)
    _append(_spread(rows, "wallet"), segments.schema, segments_path)
    remove(spark, *[f"{folder}/{name}" for name in old])


def _stored(summaries: DataFrame, epoch: int, whole: int) -> DataFrame:
    return summaries.withColumn("month", _month_of_bucket()).withColumn("batch_id", F.lit(epoch).cast("long")).withColumn("whole", F.lit(whole))


def _append(rows: DataFrame, like: StructType, path: str) -> None:
    rows.select(*[F.col(c.name).cast(c.dataType) for c in like]).write.mode("append").partitionBy("month").parquet(path)


def _writes(spark, folder: str) -> int:
    """How many writes a folder's files come from: part-<number>-<write>.<ending>."""
    return len({name.split("-", 2)[-1].split(".")[0] for name in file_names(spark, folder) if name.startswith("part-")})


def wallet_alpha_batch(trades_path: str, segments_path: str, scores_path: str, days: int = 30, min_trades: int = 5,
                       compact_after: int = COMPACT_AFTER):
    """foreachBatch body. Input rows: wallet, blockchain, ts, event_id, ret.
    Writes the scores of all wallets within ``days`` of the latest trade as
    ``batch_id=<epoch>``."""
    dynamic = {"partitionOverwriteMode": "dynamic"}

    def of_batch(spark, epoch: int) -> list[str]:
        return [m for m in partition_values(spark, trades_path, "month") if exists(spark, f"{trades_path}/month={m}/batch_id={epoch}")]

    def rebuilt(stored: DataFrame, known: DataFrame, pairs: DataFrame) -> DataFrame:
        """Whole summaries of the (wallet, day) ``pairs`` from all their stored trades."""
        touched = known.groupBy("month").agg(F.min("day").alias("lo"), F.max("day").alias("hi")).collect()  # of one batch
        near = F.lit(False)
        for m in touched:  # a day tells its month
            near = near | F.col("day").between(F.lit(m["lo"]), F.lit(m["hi"]))
        again = stored.where(F.col("month").isin([m["month"] for m in touched]) & near).withColumn("_tb", _day_number())  # prunes folders and, by the days, files
        return _segments(again.join(pairs, [*W.KEYS, "_tb"], "left_semi"))

    def fn(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        rows = batch.select("wallet", "blockchain", "ts", "event_id", "ret", F.to_date("ts").alias("day"),
                            F.date_format("ts", "yyyy-MM").alias("month"), F.lit(epoch).cast("long").alias("batch_id"))
        replayed = bool(of_batch(spark, epoch))
        _spread(rows, "wallet", "event_id").sortWithinPartitions("month", "batch_id", "day").write.mode("overwrite").options(**dynamic).partitionBy(
            "month", "batch_id").parquet(trades_path)
        touched = of_batch(spark, epoch)
        if not touched:
            return
        # a month reads back as text whatever the session infers
        stored = spark.read.schema(rows.schema).parquet(trades_path)
        known = stored.where(F.col("batch_id") == epoch).dropna(subset=[*W.KEYS, "ts"]).withColumn("_tb", _day_number())
        like = _stored(_segments(stored), epoch, 1).schema
        pairs, held = known, replayed  # the (wallet, day) to be whole; whether there are whole ones
        if not replayed:  # else units may be there already, or some of them
            many = known.groupBy(_pair()).count().where(F.col("count") > UNITS).select("_pair")
            some = many.count()
            units = known.withColumn("_pair", _pair()).join(many, "_pair", "left_anti") if some else known
            _append(_stored(W.unit_segments(units), epoch, 0), like, segments_path)
            whole = spark.read.schema(like).parquet(segments_path).where("whole = 1")
            held = whole.agg(F.count(F.lit(1))).first()[0] > 0  # skips what holds units only
            marks = [many] * bool(some) + [whole.where(F.col("month").isin(touched)).select(_pair())] * held
            pairs = known.withColumn("_pair", _pair()).join(reduce(DataFrame.unionByName, marks), "_pair", "left_semi") if marks else None
        if pairs is not None:
            held = True
            _append(_spread(_stored(rebuilt(stored, known, pairs.select(*W.KEYS, "_tb").distinct()), epoch, 1), "wallet"), like, segments_path)
        months = partition_values(spark, segments_path, "month")
        if not months:
            return
        segments = spark.read.schema(like).parquet(segments_path)
        as_of = segments.where(F.col("month") == months[-1]).agg(F.max("scored_at")).first()[0]  # the latest day's month
        lo = as_of - dt.timedelta(days=days)
        first = (lo.date() - dt.date(1970, 1, 1)).days
        inside = segments.where((F.col("month") >= f"{lo:%Y-%m}") & (F.col("_tb") > first))
        found = _valid(inside).select(*SUMMARY, "whole") if held else inside.select(*UNIT)
        if f"{lo:%Y-%m}" in partition_values(spark, trades_path, "month"):
            # the day the horizon begins in is summed from its trades, later days from their summaries
            edge = stored.where((F.col("month") == f"{lo:%Y-%m}") & (F.col("day") == F.lit(lo.date())) & (F.col("ts") > F.lit(lo)))
            edge = _segments(edge).withColumn("whole", F.lit(1)) if held else W.unit_segments(edge.withColumn("_tb", _day_number()))
            found = found.unionByName(edge.select(*found.columns))
        scores = W.scores_of_segments(found, W.KEYS, min_trades, as_of, ORDER) if held else W.scores_of_units(found, W.KEYS, min_trades, as_of)
        scores.write.mode("overwrite").parquet(f"{scores_path}/batch_id={epoch}")
        for m in touched:
            if _writes(spark, f"{segments_path}/month={m}") > compact_after:
                _compact(segments, m, segments_path, epoch)
        remove(spark, *[f"{path}/month={m}" for path in (trades_path, segments_path) for m in partition_values(spark, path, "month") if m < f"{lo:%Y-%m}"])
    return fn
