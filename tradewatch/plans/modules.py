"""run_modules: chosen detector modules over their inputs, in dependency order
(SURVEY 2.11). Plain DataFrame composition: each module is a function of the inputs and
of what the modules before it have made, and attaches its own lineage.

Inputs by name: ``trades`` (validated), ``wallet_trades`` (trades with a wallet and a chain), ``labels``,
``onchain`` (normalised events) and ``swaps`` (decoded swap legs). A module asks for those it reads."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.config import DEPENDENCIES, MODULES
from tradewatch.functions.columns import alert_id
from tradewatch.operators import backtest as B
from tradewatch.operators import flow as FL
from tradewatch.operators import labels as LB
from tradewatch.operators import lineage as L
from tradewatch.operators import onchain as O
from tradewatch.operators import predict as P
from tradewatch.operators import spread as S
from tradewatch.operators import volume as V
from tradewatch.operators import wallet as WS
from tradewatch.operators import whale as W
from tradewatch.operators.alerts import alert_union
from tradewatch.operators.windows import stored


def dependency_order(modules) -> list[str]:
    """Requested modules plus their dependencies, dependencies first."""
    out: list[str] = []

    def visit(m: str, stack: tuple = ()) -> None:
        if m in out:
            return
        if m in stack:
            raise ValueError(f"dependency cycle at {m}")
        if m not in MODULES:
            raise ValueError(f"no module {m}")
        for d in DEPENDENCIES.get(m, []):
            visit(d, stack + (m,))
        out.append(m)

    for m in modules:
        visit(m)
    return out


def _secs(n: int) -> str:
    return f"{int(n)} seconds"


@dataclass
class Run:
    """What the modules of one run share: inputs, configuration, the clock of the lineage, and
    rows that later modules read (``made``) beside the alerts (``out``)."""

    inputs: dict
    cfg: dict
    at: str
    store: bool = False
    made: dict = field(default_factory=dict)
    out: dict = field(default_factory=dict)

    def read(self, name: str, module: str) -> DataFrame:
        if self.inputs.get(name) is None:
            raise ValueError(f"{module} needs the input {name}")
        return self.inputs[name]

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        """Rows for later modules; stored where many of them read it."""
        self.made[name] = stored(df, name) if self.store else df
        return self.made[name]

    def latest(self, df: DataFrame, module: str, section: str) -> DataFrame:
        """Lineage of aggregated trades: the window's latest event."""
        return L.lin_attach_latest(df, module, MODULES[module], self.cfg[section], self.at)

    def source(self, module: str, section: str, table: str, event, place, ts):
        """A function that adds the lineage of another source's rows."""
        return lambda df: L.lin_attach_source(df, module, MODULES[module], self.cfg[section], self.at, table, event, place, ts)


def _volume(run: Run, m: str) -> DataFrame:
    c = run.cfg["volume_anomaly"]
    scored = V.vol_detect(run.read("trades", m), run.cfg, _secs(c["window_seconds"]), c["rolling_window_seconds"])
    scored = run.keep("vol_scored", scored)
    return V.vol_spike_alerts(L.lin_attach(scored, m, MODULES[m], c, run.at, event_col="last_event_id"), run.cfg)


def _whale(run: Run, m: str) -> DataFrame:
    whales = W.whale_detect(run.read("trades", m), run.cfg)
    whales = run.keep("whales", whales)
    return W.whale_alerts(L.lin_attach(L.with_correlation_id(whales), m, MODULES[m], run.cfg["whale_detector"], run.at), run.cfg)


def _spread(run: Run, m: str) -> DataFrame:
    c = run.cfg["spread_calculator"]
    spreads = S.spread_detect(run.read("trades", m), run.cfg, _secs(c["window_seconds"]))
    return S.spread_alerts(run.latest(spreads, m, "spread_calculator"), c["spread_threshold_pct"], c["spread_high_pct"])


def _wallets(run: Run, m: str) -> DataFrame:
    c = run.cfg["wallet_scorer"]
    trades = run.read("wallet_trades", m)
    width = f"{int(c['period_days'])} days"
    scores = stored(WS.wallet_scores_periodic(trades, width, c["min_trades"], symbols=True), "wallet-scores")
    run.made["symbol_alpha"] = lambda: WS.alpha_by_symbol(WS.alpha_percentile(scores))
    rows = run.source(m, "wallet_scorer", "wallet_trades", F.col("last_event_id"), (F.col("blockchain"), F.col("wallet")), "last_timestamp")(scores)
    return alert_union(WS.wallet_high_alpha(rows, c["high_alpha_pct"]), WS.wallet_score_change(rows, c["score_delta"]))


def _labels(run: Run, m: str) -> DataFrame:
    c = run.cfg["labels"]
    rows = run.source(m, "labels", "wallet_trades", F.col("event_id"), (F.col("exchange"), F.col("symbol")), "ts")(run.read("wallet_trades", m))
    return LB.label_alerts(rows, run.read("labels", m), c["min_quote_volume_usd"], c["severity_high_usd"])


def _flow(run: Run, m: str) -> DataFrame:
    c = run.cfg["flow"]
    flows = run.keep("flows", FL.flow_aggregate(run.made["whales"], _secs(c["window_seconds"])))
    return FL.flow_alerts(run.latest(flows, m, "flow"), c["accumulation"], c["distribution"],
                          c["strong_accumulation"], c["strong_distribution"])


def _consensus(run: Run, m: str) -> DataFrame:
    c, fc = run.cfg["consensus"], run.cfg["flow"]
    vs = run.made["vol_scored"].withColumn(
        "alert_id", alert_id(F.lit("volume_spike"), "exchange", "symbol", F.unix_seconds("window_start")))
    wh = run.made["whales"].withColumn("alert_id", alert_id(F.lit("whale_trade"), "exchange", "symbol", "event_id"))
    r = F.col("flow_ratio")
    ftype = F.when(r > fc["accumulation"], "accumulation_signal").when(r < fc["distribution"], "distribution_signal")
    fl = run.made["flows"].withColumn("alert_id", F.when(ftype.isNotNull(), alert_id(
        ftype, F.lit(None).cast("string"), "symbol", F.unix_seconds("window_start"))))
    sig = FL.consensus_score(FL.consensus_signals(vs, wh, fl, _secs(c["window_seconds"])), tuple(c["weights"]))
    sig = run.keep("consensus", sig)
    return FL.consensus_alerts(run.latest(sig, m, "consensus"), c["threshold"], c["high"])


def _onchain(run: Run, m: str) -> DataFrame:
    c = run.cfg["onchain"]
    rows = run.source(m, "onchain", "onchain_events", F.col("tx"), (F.col("blockchain"), F.col("tx")), "block_timestamp")(run.read("onchain", m))
    routers = O.routers_frame(rows.sparkSession, c["routers"])
    return alert_union(O.onchain_swap_filter(rows, routers), O.onchain_large_transfer(rows, c["large_transfer_usd"], c["high_transfer_usd"]))


def _dex(run: Run, m: str) -> DataFrame:
    c, swaps = run.cfg["dex"], run.read("swaps", m)
    leg = run.source(m, "dex", "dex_trades", F.concat_ws("/", "tx", "leg_id"), (F.col("blockchain"), F.col("pair")), "swap_timestamp")
    pool = run.source(m, "dex", "dex_trades", F.col("last_event_id"), (F.col("last_blockchain"), F.col("pair")), "last_timestamp")
    return alert_union(O.dex_large_swaps(leg(O.dex_price_impact(swaps)), c["large_swap_usd"], c["high_swap_usd"]),
                       O.dex_liquidity_change(swaps, _secs(c["liquidity_window_seconds"]), c["liquidity_change_pct"], lineage=pool))


def _predict(run: Run, m: str) -> DataFrame:
    c, trades = run.cfg["predictive"], run.read("trades", m)
    grid = P.pred_grid(trades, c["window_seconds"])
    f = stored(P.pred_features(grid, run.made["consensus"], run.made["vol_scored"], run.made["flows"], run.made["symbol_alpha"]()), "features")
    out = P.pred_outcomes(f, trades, c["outcome_seconds"], c["move_pct"])
    scores = stored(P.pred_score(P.pred_accuracy(f, out, c["outcome_seconds"], c["window_seconds"])), "scores")
    event = F.concat_ws("@", "symbol", F.unix_seconds("window_start").cast("string"))
    rows = run.source(m, "predictive", "predictive_scores", event, (F.lit(""), F.col("symbol")), "window_end")(scores)
    return P.pred_alerts(rows, c["alert_p"], c["update_delta"])


def _backtest(run: Run, m: str) -> DataFrame:
    """Every alert that the run has made on trades: volume spikes and whale trades by
    the direction of their rows, flow and consensus signals by type, spreads without one."""
    c, trades = run.cfg["backtest"], run.read("trades", m)
    vs = run.made["vol_scored"].where(F.col("severity").isNotNull())
    up = F.when(F.col("close_price") > F.col("open_price"), 1).when(F.col("close_price") < F.col("open_price"), -1)
    tested = [vs.select(alert_id(F.lit("volume_spike"), "exchange", "symbol", F.unix_seconds("window_start")).alias("alert_id"), F.lit("MOD-001").alias("module_id"),
                        F.lit("volume_spike").alias("alert_type"), "symbol", F.col("window_end").alias("detected_at"), up.alias("direction")),
              run.made["whales"].select(alert_id(F.lit("whale_trade"), "exchange", "symbol", "event_id").alias("alert_id"), F.lit("MOD-002").alias("module_id"),
                                        F.lit("whale_trade").alias("alert_type"), "symbol", F.col("timestamp").alias("detected_at"),
                                        F.when(F.col("side") == "buy", 1).otherwise(-1).alias("direction"))]
    tested += [B.bt_direction_of(run.out[x]) for x in ("MOD-003", "MOD-006", "MOD-007") if x in run.out]
    alerts = tested[0]
    for t in tested[1:]:
        alerts = alerts.unionByName(t)
    returns = stored(B.bt_forward_return(alerts, trades, c["horizons_seconds"]), "returns")
    day = c["date"] or run.at[:10]
    report = run.source(m, "backtest", "backtest_results", F.concat_ws("@", "module_id", "backtest_date"), (F.lit(""), F.col("module_id")), "detected_at")
    daily = run.source(m, "backtest", "backtest_results", F.concat_ws("@", "module_id", "symbol", "horizon_s", "backtest_date"),
                       (F.lit(""), F.col("module_id")), F.col("backtest_date").cast("timestamp"))
    return alert_union(B.bt_complete_alerts(B.bt_report(returns, day), report),
                       B.bt_degradation(daily(B.bt_daily_hit_rate(returns)), c["degradation_drop"]))


STEPS = {"MOD-001": _volume, "MOD-002": _whale, "MOD-003": _spread, "MOD-004": _wallets, "MOD-005": _labels, "MOD-006": _flow,
         "MOD-007": _consensus, "MOD-008": _onchain, "MOD-009": _dex, "MOD-010": _predict, "MOD-011": _backtest}


def run_modules(valid: DataFrame | None, cfg: dict, modules=("MOD-001", "MOD-002", "MOD-003"),
                processed_at: str | None = None, inputs: dict | None = None) -> dict[str, DataFrame]:
    """Return {module_id: alerts} of the modules asked for and those they depend on. ``valid`` is the
    input ``trades``; the other ones come in ``inputs``. Every alert carries the eight lineage fields.
    With the prediction or the back-test, which read most of the others' rows, those are stored."""
    order = dependency_order(modules)
    run = Run({"trades": valid, **(inputs or {})}, cfg, processed_at or "1970-01-01T00:00:00.000Z",
              store="MOD-010" in order or "MOD-011" in order)
    for m in order:
        run.out[m] = STEPS[m](run, m)
    return {m: run.out[m] for m in order}
