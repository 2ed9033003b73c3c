"""Every operator as a query over the test tables, with the SQL that must agree."""

from __future__ import annotations

import datetime as dt
import itertools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions import clock, dates, durations, values
from barloom.functions.slots import TEN_MINUTE_SLOTS, shift_slot, trading_slots
from barloom.operators import asof, calendar as cal, datesets, matrices, resample, returns, scaling, splits
from barloom.plans import alpha, dataset, panel, return_items, return_tables, scoring, training, walk_forward
from barloom.plans.features import feature_bars, wide_columns
from barloom.sources import bucketed, incremental, readers, sinks
from barloom.sources.workdir import work_folder, written_table
from barloom.streaming import stats
from checks import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL over the fixture tables."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = fx.with_fixtures(sql)
        return fn

    return register


def fixed(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round floating columns, so that the order of a sum does not show."""
    return df.selectExpr(
        *[
            f"round(CAST(`{f.name}` AS DOUBLE), {digits}) + 0.0D AS `{f.name}`"
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else f"`{f.name}`"
            for f in df.schema.fields
        ]
    )


def r(expr: str, name: str, digits: int = 6) -> str:
    """SQL side of :func:`fixed`."""
    return f"round(CAST({expr} AS DOUBLE), {digits}) + 0.0 AS \"{name}\""


def stats_sql(bars, ops=("mean", "std")) -> str:
    form = {
        "mean": "avg({b})",
        "std": "stddev_samp({b})",
        "skew": "CASE WHEN var_pop({b}) > 1e-12 * avg({b}) * avg({b}) THEN "
        "(avg({b}*{b}*{b}) - 3*avg({b})*avg({b}*{b}) + 2*avg({b})*avg({b})*avg({b})) / pow(var_pop({b}), 1.5) END",
        "kurt": "CASE WHEN var_pop({b}) > 1e-12 * avg({b}) * avg({b}) THEN kurtosis_pop({b}) END",
    }
    return ", ".join(r(form[o].format(b=b), f"{b}_{o}") for b in bars for o in ops)


def ret_sql(end: str, start: str, name: str) -> str:
    return r(f"({end}) / nullif({start}, 0) - 1", name)


# --- Downsampling -----------------------------------------------------------------------------------------------

PRICES = ["open", "close", "volume"]
LONG_SQL = f"SELECT date, symbol, slot, {stats_sql(PRICES)}, count(time) AS count FROM slotted GROUP BY date, symbol, slot"


@query(LONG_SQL)
def downsample_long(spark, sf_dir):
    return fixed(resample.resample_long(fx.bar_1m(spark, sf_dir), PRICES))


@query(f"SELECT date, symbol, slot, {stats_sql(['centred', 'volume'], ('skew', 'kurt'))} "
       "FROM (SELECT *, close - 1500 AS centred FROM slotted) GROUP BY date, symbol, slot")
def downsample_moments(spark, sf_dir):
    bars = fx.bar_1m(spark, sf_dir).withColumn("centred", F.col("close") - 1500)
    return fixed(resample.resample_long(bars, ["centred", "volume"], ("skew", "kurt")).drop("count"), 5)


ORACLE["downsample_moments"] = ORACLE["downsample_moments"].replace(", 6) + 0.0", ", 5) + 0.0")

WIDE_BARS = ["close", "volume"]


def wide_sql(bars, slots, digits=6, real=False, source="slotted"):
    cell = "CAST(max(CASE WHEN slot = '{s}' THEN {b}_{o} END) AS REAL)" if real else "max(CASE WHEN slot = '{s}' THEN {b}_{o} END)"
    cols = ", ".join(
        r(cell.format(s=s, b=b, o=o), f"{b}_{o}_{s}", digits) for b in bars for o in ("mean", "std") for s in slots
    )
    raw = ", ".join(f"avg({b}) AS {b}_mean, stddev_samp({b}) AS {b}_std" for b in bars)
    return (
        f"SELECT date, symbol, {cols} FROM (SELECT date, symbol, slot, {raw} FROM {source} GROUP BY date, symbol, slot) "
        "GROUP BY date, symbol"
    )


@query(wide_sql(WIDE_BARS, TEN_MINUTE_SLOTS, 3, real=True))
def downsample_wide(spark, sf_dir):
    return fixed(panel.downsample_wide(fx.bar_1m(spark, sf_dir), WIDE_BARS), 3)


V2_BARS = feature_bars("v2")
V2_SOURCES = ["open", "high", "low", "close", "volume", "amount"]
V2_SELECT = ", ".join(f"{V2_SOURCES[i % 6]} * {1 + i % 16} / 1000.0::DOUBLE + {i}.0000123::DOUBLE AS \"{b}\"" for i, b in enumerate(V2_BARS))


@query(f"WITH full_bars AS (SELECT date, symbol, slot, time, {V2_SELECT} FROM slotted)\n"
       f"SELECT date, symbol, slot, {', '.join(r(f'avg(\"{b}\")', f'{b}_mean', 4) for b in V2_BARS)}, "
       f"{', '.join(r(f'stddev_samp(\"{b}\")', f'{b}_std', 4) for b in V2_BARS)}, count(time) AS count "
       "FROM full_bars GROUP BY date, symbol, slot")
def downsample_v2_bars(spark, sf_dir):
    """All 139 bars of the default feature set, each derived from one of the panel's (off round numbers)."""
    made = [f"{V2_SOURCES[i % 6]} * {1 + i % 16} / 1000.0D + {i}.0000123D AS `{b}`" for i, b in enumerate(V2_BARS)]
    plain = resample.place(fx.bar_1m(spark, sf_dir).select("date", "symbol", "time", *V2_SOURCES), *resample.KEYS)
    return fixed(resample.resample_long(plain.selectExpr("date", "symbol", "time", *made), V2_BARS, placed=True), 4)


@query("SELECT date, count(*) AS windows, bool_and(n = 10) AS complete FROM "
       "(SELECT date, symbol, slot, count(*) AS n FROM slotted GROUP BY date, symbol, slot) GROUP BY date")
def window_complete(spark, sf_dir):
    return resample.windows_complete(resample.resample_long(fx.bar_1m(spark, sf_dir), ["close"]))


MORNING = "hhmm > '0930' AND hhmm <= '1000'"


@query(f"SELECT date, symbol FROM slotted WHERE {MORNING} GROUP BY date, symbol HAVING count(time) = 30")
def complete_symbols(spark, sf_dir):
    return resample.complete_symbols(fx.bar_1m(spark, sf_dir), trading_slots("0930", "1000", closed="right"))


ONLINE_SLOTS = ["0940", "0950", "1000"]


@query(f"""WITH whole AS (
  SELECT date, symbol FROM slotted WHERE {MORNING} GROUP BY date, symbol HAVING count(time) = 30),
kept AS (SELECT s.* FROM slotted s JOIN whole USING (date, symbol) JOIN univ u USING (date, symbol)
  WHERE {MORNING} AND u.euniv_largemid)
{wide_sql(WIDE_BARS, ONLINE_SLOTS, source='kept')}""")
def online_features(spark, sf_dir):
    members = readers.read_universe(spark, fx.univ(spark, sf_dir), "euniv_largemid")
    return fixed(panel.online_features(fx.bar_1m(spark, sf_dir), WIDE_BARS, ("0930", "1000"), members))


@query(f"""WITH early AS (SELECT * FROM slotted WHERE {MORNING}),
wide AS ({wide_sql(WIDE_BARS, ONLINE_SLOTS, source='early')})
SELECT * FROM (SELECT date, symbol FROM univ WHERE euniv_largemid) LEFT JOIN wide USING (date, symbol)""")
def slot_range_features(spark, sf_dir):
    members = readers.read_universe(spark, fx.univ(spark, sf_dir), "euniv_largemid")
    return fixed(panel.slot_range_features(fx.bar_1m(spark, sf_dir), WIDE_BARS, ("0930", "1000"), members))


@query("SELECT date, symbol, time, close, volume FROM slotted WHERE date BETWEEN DATE '2024-01-09' AND DATE '2024-01-16' "
       "AND hhmm IN ('0935', '1305', '1500')")
def bars_at_slots(spark, sf_dir):
    return readers.read_bars(
        spark, fx.bar_1m(spark, sf_dir), ["close", "volume"], "20240109", "2024-01-16", at=["0935", "1305", "1500"]
    )


@query("SELECT date, symbol FROM univ WHERE euniv_largemid AND date BETWEEN DATE '2024-01-09' AND DATE '2024-01-16'")
def universe_members(spark, sf_dir):
    return readers.read_universe(spark, fx.univ(spark, sf_dir), "euniv_largemid", "2024-01-09", "2024-01-16")


@query("SELECT b.* REPLACE (round(b.amount, 2) AS amount), f.adj_factor FROM bar_1m b LEFT JOIN adj_factor f USING (date, symbol)")
def adj_bars(spark, sf_dir):
    rows = returns.adjusted_bars(fx.bar_1m(spark, sf_dir), readers.read_daily(spark, fx.adj_factor(spark, sf_dir)))
    return rows.withColumn("amount", F.round("amount", 2))


@query("SELECT b.* REPLACE (round(b.amount, 2) AS amount), f.adj_factor FROM bar_1m b LEFT JOIN adj_factor f USING (date, symbol)")
def adj_bars_bucketed(spark, sf_dir):
    bars = bucketed.bucketed(fx.bar_1m(spark, sf_dir), "bar_1m", 16)
    factors = bucketed.bucketed(readers.read_daily(spark, fx.adj_factor(spark, sf_dir)), "adj_factor", 16)
    return returns.adjusted_bars(bars, factors).withColumn("amount", F.round("amount", 2))


# --- Returns ----------------------------------------------------------------------------------------------------

SPANS = returns.intraday_spans()
SPAN_SLOTS = sorted({s for span in SPANS.values() for s in span})


def at_sql(slot: str, price: str = "close") -> str:
    return f"max(CASE WHEN hhmm = '{slot}' THEN {price} END)"


@query("SELECT date, symbol, " + ", ".join(f'{at_sql(s)} AS "{s}"' for s in SPAN_SLOTS) + " FROM slotted "
       f"WHERE hhmm IN ({', '.join(repr(s) for s in SPAN_SLOTS)}) GROUP BY date, symbol")
def slot_prices(spark, sf_dir):
    return resample.slot_values(fx.bar_1m(spark, sf_dir), SPAN_SLOTS)


@query("SELECT date, symbol, " + ", ".join(ret_sql(at_sql(e), at_sql(b), n) for n, (b, e) in SPANS.items())
       + f" FROM slotted WHERE hhmm IN ({', '.join(repr(s) for s in SPAN_SLOTS)}) GROUP BY date, symbol")
def intraday_returns(spark, sf_dir):
    return fixed(returns.intraday_returns(fx.bar_1m(spark, sf_dir)))


PAIR_SLOTS, PAIR_DURATIONS = ["0935", "1120", "1400"], ["20m", "45m"]
PAIRS = {f"ret_{s}_{d}": (s, shift_slot(s, d)[1]) for s, d in itertools.product(PAIR_SLOTS, PAIR_DURATIONS)}


@query("SELECT date, symbol, " + ", ".join(ret_sql(at_sql(e), at_sql(b), n) for n, (b, e) in PAIRS.items())
       + " FROM slotted WHERE hhmm IN ('0935','0955','1020','1120','1310','1335','1400','1420','1445') GROUP BY date, symbol")
def pairwise_returns(spark, sf_dir):
    return fixed(returns.pairwise_returns(fx.bar_1m(spark, sf_dir), PAIR_SLOTS, PAIR_DURATIONS))


def vwap_sql(b: str, e: str) -> str:
    inside = f"CASE WHEN hhmm > '{b}' AND hhmm <= '{e}' THEN"
    return f"sum({inside} amount END) / nullif(sum({inside} volume END), 0)"


@query("SELECT date, symbol, " + ", ".join(r(vwap_sql(b, e), f"vwap_{b}_{e}") for b, e in returns.HALF_HOURS)
       + " FROM slotted WHERE hhmm > '0935' AND hhmm <= '1500' GROUP BY date, symbol")
def interval_vwap(spark, sf_dir):
    return fixed(returns.interval_vwap(fx.bar_1m(spark, sf_dir)))


FORWARD_SQL = (
    "WITH prices AS (SELECT date, symbol, "
    + ", ".join(f"{vwap_sql(b, e)} AS v2v_{b}, {at_sql(b)} AS o2o_{b}" for b, e in returns.HALF_HOURS)
    + ", " + ", ".join(f"{at_sql(s)} AS c{s}" for s in SPAN_SLOTS)
    + " FROM slotted GROUP BY date, symbol),\n"
    "placed AS (SELECT p.*, c.idx, coalesce(f.adj_factor, NULL) AS adj FROM prices p JOIN calendar c USING (date) "
    "LEFT JOIN adj_factor f USING (date, symbol))\n"
)
FORWARD_COLS = ", ".join(
    ret_sql(f"f{n}.{k}_{b} * f{n}.adj", f"a.{k}_{b} * a.adj", f"rtn_{k}_{b}_{n}D")
    for k in ("v2v", "o2o") for b, _ in returns.HALF_HOURS for n in returns.HORIZONS
)
FORWARD_FROM = " FROM placed a " + " ".join(
    f"LEFT JOIN placed f{n} ON f{n}.symbol = a.symbol AND f{n}.idx = a.idx + {n}" for n in returns.HORIZONS
)
INTRA_COLS = ", ".join(ret_sql(f"a.c{e}", f"a.c{b}", n) for n, (b, e) in SPANS.items())
RETURN_SQL = FORWARD_SQL + f"SELECT a.date, a.symbol, {FORWARD_COLS}, {INTRA_COLS} {FORWARD_FROM}"


def _returns(spark, sf_dir):
    return return_tables.return_table(
        fx.bar_1m(spark, sf_dir), fx.calendar(spark, sf_dir), fx.adj_factor(spark, sf_dir)
    )


@query(FORWARD_SQL + f"SELECT a.date, a.symbol, {FORWARD_COLS} {FORWARD_FROM}")
def forward_returns(spark, sf_dir):
    bars, days = fx.bar_1m(spark, sf_dir), fx.calendar(spark, sf_dir)
    prices = returns.price_table(bars, [b for b, _ in returns.HALF_HOURS])
    prices = prices.join(fx.adj_factor(spark, sf_dir), ["date", "symbol"], "left")
    columns = {f"rtn_v2v_{b}": f"vwap_{b}_{e}" for b, e in returns.HALF_HOURS}
    columns |= {f"rtn_o2o_{b}": b for b, _ in returns.HALF_HOURS}
    return fixed(returns.forward_returns(prices, days, columns, adj="adj_factor"))


@query(RETURN_SQL)
def return_table(spark, sf_dir):
    return fixed(_returns(spark, sf_dir))


LAG_COLS = ", ".join(f'r."{c}" AS "lag_{c}"' for c in return_tables.return_columns())


@query(FORWARD_SQL.rstrip() + f", ret AS (SELECT a.date, a.symbol, {FORWARD_COLS}, {INTRA_COLS} {FORWARD_FROM})\n"
       f"SELECT c.prev AS date, r.symbol, {LAG_COLS} FROM ret r JOIN calendar c USING (date) WHERE c.prev IS NOT NULL")
def lag_returns(spark, sf_dir):
    return fixed(return_tables.lag_return_table(_returns(spark, sf_dir), fx.calendar(spark, sf_dir)))


# --- Calendar ---------------------------------------------------------------------------------------------------


@query("SELECT date, idx, prev, next, lead(date, 5) OVER (ORDER BY date) AS next5 FROM order_calendar")
def calendar_next(spark, sf_dir):
    days = fx.order_calendar(spark, sf_dir)
    ahead = cal.calendar_next(days, 5).withColumnRenamed("next", "next5")
    return days.join(ahead, "date").withColumn("idx", F.col("idx").cast("bigint"))


def _orders(spark, sf_dir):
    return fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("date"))


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, c.date IS NOT NULL AS is_trading_day "
       "FROM orders LEFT JOIN order_calendar c ON c.date = CAST(o_orderdate AS DATE)")
def trading_day_flag(spark, sf_dir):
    return cal.flag_trading_days(_orders(spark, sf_dir).drop("o_custkey"), fx.order_calendar(spark, sf_dir))


@query("""WITH moved AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, o_custkey % 11 - 5 AS n FROM orders),
days AS (SELECT DISTINCT date FROM moved),
located AS (SELECT d.date, count(c.date) AS before, (SELECT count(*) FROM order_calendar) AS total,
  EXISTS (SELECT 1 FROM order_calendar x WHERE x.date = d.date) AS trading
  FROM days d LEFT JOIN order_calendar c ON c.date < d.date GROUP BY d.date)
SELECT m.o_orderkey, m.date, m.n, c.date AS shifted FROM moved m JOIN located l USING (date)
LEFT JOIN order_calendar c ON m.n <> 0 AND l.before < l.total
  AND c.idx = l.before + m.n - CASE WHEN m.n > 0 AND NOT l.trading THEN 1 ELSE 0 END""")
def shift_dates(spark, sf_dir):
    moved = _orders(spark, sf_dir).select("o_orderkey", "date", (F.col("o_custkey") % 11 - 5).alias("n"))
    return cal.shift_dates(moved, fx.order_calendar(spark, sf_dir), F.col("n"))


@query("""WITH starts(pos) AS (VALUES (4), (59), (209)),
moves AS (SELECT CASE WHEN pos < 120 THEN 571 + pos ELSE 661 + pos END AS a, 1 + (pos + 123) // 240 AS gap,
  CASE WHEN (pos + 123) % 240 < 120 THEN 571 + (pos + 123) % 240 ELSE 661 + (pos + 123) % 240 END AS b FROM starts)
SELECT CAST(c.date AS TIMESTAMP) + to_minutes(CAST(a AS INTEGER)) AS time,
  CAST(n.date AS TIMESTAMP) + to_minutes(CAST(b AS INTEGER)) AS next_time
FROM order_calendar c CROSS JOIN moves LEFT JOIN order_calendar n ON n.idx = c.idx + gap""")
def slot_schedule(spark, sf_dir):
    return cal.slot_schedule(fx.order_calendar(spark, sf_dir), "1d2h3m", ["0935", "1030", "1430"])


@query("""SELECT hhmm AS right_label, strftime(time - INTERVAL 1 MINUTE, '%H%M') AS left_label,
  CAST(CASE WHEN hhmm < '1200' THEN date_diff('minute', CAST(date AS TIMESTAMP), time) - 571
       ELSE date_diff('minute', CAST(date AS TIMESTAMP), time) - 661 END AS BIGINT) AS position,
  hhmm IN (""" + ", ".join(repr(s) for s in TEN_MINUTE_SLOTS) + """) AS ends_ten, count(*) AS n_bars, sum(total_trades)::BIGINT AS n_trades
FROM slotted GROUP BY ALL""")
def trading_slots_of_bars(spark, sf_dir):
    bars = fx.bar_1m(spark, sf_dir).groupBy(clock.hhmm("time").alias("right_label")).agg(
        F.count("time").alias("n_bars"), F.sum("total_trades").alias("n_trades")
    )
    position = clock.slot_position("right_label")
    return bars.select(
        "right_label",
        clock.slot_at_position(position, right=False).alias("left_label"),
        position.cast("bigint").alias("position"),
        F.col("right_label").isin(trading_slots(freq=10)).alias("ends_ten"),
        "n_bars",
        "n_trades",
    )


@query("""WITH moves AS (SELECT o_orderkey, o_orderkey % 240 AS pos, o_custkey % 3 AS d, o_custkey % 1440 AS m FROM orders),
ends AS (SELECT *, (pos + m) // 240 + d AS gap, (pos + m) % 240 AS e FROM moves),
labels AS (SELECT o_orderkey, gap, CASE WHEN pos < 120 THEN 571 + pos ELSE 661 + pos END AS a,
  CASE WHEN e < 120 THEN 571 + e ELSE 661 + e END AS b FROM ends)
SELECT o_orderkey, lpad(CAST(a // 60 * 100 + a % 60 AS VARCHAR), 4, '0') AS slot, CAST(gap AS INTEGER) AS gap_days,
  lpad(CAST(b // 60 * 100 + b % 60 AS VARCHAR), 4, '0') AS end_slot FROM labels""")
def session_time_sums(spark, sf_dir):
    moves = fx.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        clock.slot_at_position((F.col("o_orderkey") % 240).cast("int")).alias("slot"),
        (F.col("o_custkey") % 3).alias("d"),
        (F.col("o_custkey") % 1440).alias("m"),
    )
    gap, end = clock.add_session_minutes("slot", F.col("d"), F.col("m"))
    return moves.select("o_orderkey", "slot", gap.alias("gap_days"), end.alias("end_slot"))


@query("""WITH texts AS (SELECT o_orderkey, CASE o_custkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y%m%d')
  WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 2 THEN 'bad' || o_custkey ELSE strftime(o_orderdate, '%Y-13-%d') END AS text FROM orders)
SELECT o_orderkey, text, strftime(CASE WHEN regexp_full_match(text, '[0-9]{8}') THEN CAST(try_strptime(text, '%Y%m%d') AS DATE)
  WHEN regexp_full_match(text, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN CAST(try_strptime(text, '%Y-%m-%d') AS DATE) END, '%Y-%m-%d') AS ymd,
  make_date(year(CASE WHEN o_orderkey IS NOT NULL THEN (SELECT max(o_orderdate) FROM orders) END), 12, 31) AS last_year_end FROM texts""")
def parse_dates(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date")
    text = (
        F.when(F.col("o_custkey") % 4 == 0, F.date_format(day, "yyyyMMdd"))
        .when(F.col("o_custkey") % 4 == 1, dates.ymd(day))
        .when(F.col("o_custkey") % 4 == 2, F.concat(F.lit("bad"), F.col("o_custkey")))
        .otherwise(F.date_format(day, "yyyy-'13'-dd"))
    )
    last = orders.agg(F.max(day).alias("last")).select(dates.year_end_of("last").alias("last_year_end")).scalar()
    return orders.select("o_orderkey", text.alias("text")).select(
        "o_orderkey", "text", dates.ymd(dates.parse_date("text")).alias("ymd"), last.alias("last_year_end")
    )


@query("""WITH texts AS (SELECT o_orderkey, CASE WHEN o_custkey % 2 = 0 THEN '' ELSE (o_custkey % 5) || 'd' END
  || CASE WHEN o_custkey % 3 = 0 THEN '' ELSE (o_custkey % 30) || 'h' END
  || CASE WHEN o_custkey % 7 = 0 THEN '' ELSE (o_custkey % 2000) || 'm' END
  || CASE WHEN o_custkey % 13 = 0 THEN '3h' ELSE '' END AS text FROM orders),
parts AS (SELECT o_orderkey, text, CASE WHEN regexp_full_match(text, '([0-9]+d)?([0-9]+h)?([0-9]+m)?') THEN
  coalesce(TRY_CAST(regexp_extract(text, '([0-9]+)d', 1) AS BIGINT), 0) * 1440
  + coalesce(TRY_CAST(regexp_extract(text, '([0-9]+)h', 1) AS BIGINT), 0) * 60
  + coalesce(TRY_CAST(regexp_extract(text, '([0-9]+)m', 1) AS BIGINT), 0) END AS total FROM texts)
SELECT o_orderkey, text, CASE WHEN total > 0 THEN total // 1440 END AS days,
  CASE WHEN total > 0 THEN total % 1440 END AS minutes FROM parts""")
def parse_durations(spark, sf_dir):
    c = F.col("o_custkey")

    def part(skip, size, unit):
        return F.when(c % skip == 0, F.lit("")).otherwise(F.concat((c % size).cast("string"), F.lit(unit)))

    text = F.concat(part(2, 5, "d"), part(3, 30, "h"), part(7, 2000, "m"), F.when(c % 13 == 0, F.lit("3h")).otherwise(F.lit("")))
    texts = fx.table(spark, sf_dir, "orders").select("o_orderkey", text.alias("text"))
    days, minutes = durations.split_duration("text")
    return texts.select("o_orderkey", "text", days.alias("days"), minutes.alias("minutes"))


@query("SELECT c_custkey, md5(c_name) AS c_key FROM customer")
def anonymised_keys(spark, sf_dir):
    return fx.table(spark, sf_dir, "customer").select("c_custkey", values.anonymised("c_name").alias("c_key"))


# --- Date sets and the dataset ----------------------------------------------------------------------------------


def _items(spark, sf_dir):
    days = fx.calendar(spark, sf_dir)
    bars, members, rets = fx.bar_1m(spark, sf_dir), fx.univ(spark, sf_dir), _returns(spark, sf_dir)
    return bars, members, rets, return_tables.lag_return_table(rets, days)


@query("""SELECT date FROM (SELECT date, row_number() OVER (ORDER BY date DESC) AS r FROM
  (SELECT date FROM bar_1m INTERSECT SELECT date FROM univ INTERSECT SELECT date FROM adj_factor
   INTERSECT SELECT prev FROM calendar)) WHERE r > 6""")
def ready_dates(spark, sf_dir):
    days = fx.calendar(spark, sf_dir)
    lagged = days.where(F.col("prev").isNotNull()).select(F.col("prev").alias("date"))
    return datesets.ready_dates(fx.bar_1m(spark, sf_dir), fx.univ(spark, sf_dir), fx.adj_factor(spark, sf_dir), lagged)


@query("""WITH loaded AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders WHERE o_custkey % 3 = 0),
settled AS (SELECT date FROM (SELECT date, row_number() OVER (ORDER BY date DESC) AS r FROM loaded) WHERE r > 6)
SELECT date FROM order_calendar WHERE date NOT IN (SELECT date FROM settled)""")
def pending_dates(spark, sf_dir):
    loaded = _orders(spark, sf_dir).where(F.col("o_custkey") % 3 == 0)
    return datesets.pending_dates(fx.order_calendar(spark, sf_dir), loaded, reload_last=6)


@query("SELECT date FROM order_calendar WHERE date >= DATE '1996-03-02' AND date < DATE '1999-06-30'")
def clamp_range(spark, sf_dir):
    days = fx.order_calendar(spark, sf_dir)
    first, last = cal.clamp_range(days, "19960302", "1999-06-30", dt.datetime(2024, 1, 2, 22, 30))
    return cal.calendar_between(days, first, last).select("date")


@query("""SELECT b.date, b.symbol, b.time, CASE WHEN b.total_trades = 1 THEN NULL ELSE b.close END AS close, b.volume
FROM bar_1m b JOIN univ u USING (date, symbol) WHERE u.euniv_largemid AND b.date BETWEEN DATE '2024-01-09' AND DATE '2024-01-17'""")
def offline_select(spark, sf_dir):
    rows = fx.nan_bars(spark, sf_dir).join(fx.univ(spark, sf_dir), ["date", "symbol"], "left")
    return readers.read_dataset(
        spark, rows, ["date", "symbol", "time", "close", "volume"], universe="euniv_largemid",
        date_range=("20240109", "2024-01-17"), date_col="date",
    )


DATASET_BARS, DATASET_SLOTS = ["close", "volume"], ["0940", "0950", "1000", "1310", "1500"]
LABELS = ["rtn_v2v_1005_1D", "rtn_v2v_1005_2D", "rtn_v2v_1005_5D", "1000_1h", "lag_rtn_v2v_0935_2D", "lag_0930_1h"]
DATASET_COLUMNS = ["date", "symbol", "euniv_largemid", *wide_columns(DATASET_BARS, DATASET_SLOTS), *LABELS]

WIDE_RAW = ", ".join(
    f"max(CASE WHEN slot = '{s}' THEN {b}_{o} END) AS {b}_{o}_{s}"
    for b in DATASET_BARS for o in ("mean", "std") for s in DATASET_SLOTS
)
STAT_RAW = ", ".join(f"avg({b}) AS {b}_mean, stddev_samp({b}) AS {b}_std" for b in DATASET_BARS)
DATASET_CTE = FORWARD_SQL.rstrip() + f""",
wide AS (SELECT date, symbol, {WIDE_RAW} FROM (SELECT date, symbol, slot, {STAT_RAW} FROM slotted GROUP BY date, symbol, slot)
  GROUP BY date, symbol),
ret AS (SELECT a.date, a.symbol, (f1.v2v_1005 * f1.adj) / nullif(a.v2v_1005 * a.adj, 0) - 1 AS rtn_v2v_1005_1D,
  (f2.v2v_1005 * f2.adj) / nullif(a.v2v_1005 * a.adj, 0) - 1 AS rtn_v2v_1005_2D,
  (f5.v2v_1005 * f5.adj) / nullif(a.v2v_1005 * a.adj, 0) - 1 AS rtn_v2v_1005_5D,
  (f2.v2v_0935 * f2.adj) / nullif(a.v2v_0935 * a.adj, 0) - 1 AS rtn_v2v_0935_2D,
  a.c1100 / nullif(a.c1005, 0) - 1 AS "1000_1h", a.c1030 / nullif(a.c0935, 0) - 1 AS "0930_1h" {FORWARD_FROM}),
lagged AS (SELECT c.prev AS date, symbol, rtn_v2v_0935_2D AS lag_rtn_v2v_0935_2D, "0930_1h" AS lag_0930_1h
  FROM ret JOIN calendar c USING (date) WHERE c.prev IS NOT NULL),
full_set AS (SELECT u.date, u.symbol, u.euniv_largemid, {', '.join(wide_columns(DATASET_BARS, DATASET_SLOTS))},
  rtn_v2v_1005_1D, rtn_v2v_1005_2D, rtn_v2v_1005_5D, "1000_1h", lag_rtn_v2v_0935_2D, lag_0930_1h
  FROM univ u LEFT JOIN wide USING (date, symbol) LEFT JOIN ret USING (date, symbol) LEFT JOIN lagged USING (date, symbol))
"""
DATASET_SELECT = "SELECT date, symbol, euniv_largemid, " + ", ".join(
    r(f'CAST("{c}" AS REAL)', c, 3 if c[:5] in ("close", "volum") else 5) for c in DATASET_COLUMNS[3:]
)


def _fix_dataset(df):
    stats_part = [c for c in DATASET_COLUMNS[3:] if c[:5] in ("close", "volum")]
    labels = [c for c in DATASET_COLUMNS[3:] if c not in stats_part]
    return df.select(
        "date", "symbol", "euniv_largemid",
        *[(F.round(F.col(c).cast("double"), 3) + 0.0).alias(c) for c in stats_part],
        *[(F.round(F.col(f"`{c}`").cast("double"), 5) + 0.0).alias(c) for c in labels],
    )


@query(DATASET_CTE + DATASET_SELECT + " FROM full_set")
def dataset_join(spark, sf_dir):
    bars, members, rets, lagged = _items(spark, sf_dir)
    features = panel.downsample_wide(bars, DATASET_BARS, DATASET_SLOTS)
    rows = values.numeric_to_float(dataset.join_dataset(members, features, rets, lagged))
    return _fix_dataset(rows)


@query(DATASET_CTE + DATASET_SELECT + " FROM full_set WHERE date IN (SELECT date FROM "
       "(SELECT date, row_number() OVER (ORDER BY date DESC) AS r FROM calendar WHERE next IS NOT NULL) WHERE r > 6)")
def dataset_build(spark, sf_dir):
    """The four items are written by date first, then the dataset is built from their folders."""
    folder = work_folder(spark, "dataset")
    bars, days = fx.bar_1m(spark, sf_dir).select("date", "symbol", "time", "close", "volume", "amount"), fx.calendar(spark, sf_dir)
    paths = {name: f"{folder}/{name}" for name in ("bar_1m", "univ", "return", "lag_return")}
    sinks.write_by_date(bars, paths["bar_1m"], sort=("symbol", "time"))
    sinks.write_by_date(fx.univ(spark, sf_dir), paths["univ"])
    rets = return_tables.return_table(spark.read.parquet(paths["bar_1m"]), days, fx.adj_factor(spark, sf_dir))
    sinks.write_by_date(rets, paths["return"])
    sinks.write_by_date(return_tables.lag_return_table(spark.read.parquet(paths["return"]), days), paths["lag_return"])
    dataset.build_dataset(spark, paths, f"{folder}/set", DATASET_BARS, slots=DATASET_SLOTS)
    return _fix_dataset(spark.read.parquet(f"{folder}/set"))


@query("SELECT date, symbol, euniv_largemid FROM univ WHERE date BETWEEN DATE '2024-01-09' AND DATE '2024-01-22'")
def incremental_load(spark, sf_dir):
    """Two overlapping loads: the second adds its missing dates and reloads the last two."""
    path, days, members = work_folder(spark, "univ"), fx.calendar(spark, sf_dir), fx.univ(spark, sf_dir)

    def source(first, last):
        return readers.read_universe(spark, members, None, first, last)

    late = dt.datetime(2024, 1, 30, 23, 30)
    incremental.load_item(spark, source, path, days, "2024-01-09", "2024-01-16", now=late)
    incremental.load_item(spark, source, path, days, "2024-01-11", "2024-01-22", now=late, reload_last=2)
    return spark.read.parquet(path).select("date", "symbol", "euniv_largemid")


LOADS = (dt.date(2024, 1, 12), dt.date(2024, 1, 17), dt.date(2024, 1, 23))


def _loaded_returns(spark, sf_dir, lag):
    """Three loads as more and more bars are known, in spans of four dates."""
    path, days = work_folder(spark, "return"), fx.calendar(spark, sf_dir)
    bars, factors = fx.bar_1m(spark, sf_dir).select("date", "symbol", "time", "close", "volume", "amount"), fx.adj_factor(spark, sf_dir)
    for known in LOADS:
        return_items.load_returns(spark, bars, factors, path, days, dt.date(2024, 1, 9), known, lag=lag, days_per_job=4)
    return fixed(spark.read.parquet(path))


@query(RETURN_SQL + " WHERE a.date >= DATE '2024-01-09'")
def incremental_returns(spark, sf_dir):
    """Returns loaded in several spans, immature dates again, are those of the table built at once."""
    return _loaded_returns(spark, sf_dir, False)


@query(FORWARD_SQL.rstrip() + f", ret AS (SELECT a.date, a.symbol, {FORWARD_COLS}, {INTRA_COLS} {FORWARD_FROM})\n"
       f"SELECT c.prev AS date, r.symbol, {LAG_COLS} FROM ret r JOIN calendar c USING (date) WHERE c.prev >= DATE '2024-01-09'")
def incremental_lag_returns(spark, sf_dir):
    return _loaded_returns(spark, sf_dir, True)


V2_MADE = [f"{V2_SOURCES[i % 6]} * {1 + i % 16} / 1000.0D + {i}.0000123D AS `{b}`" for i, b in enumerate(V2_BARS)]
V2_STATS = [f"{b}_{op}" for b in V2_BARS for op in ("mean", "std")]
# Symbol-days of minute bars in a bucket: some 500 MB at 139 bars, which a task sorts.
SYMBOL_DAYS = 2000


@query(f"WITH full_bars AS (SELECT date, symbol, slot, time, {V2_SELECT} FROM slotted),\n"
       "stats AS (SELECT date, symbol, slot, " + ", ".join(f'avg("{b}") AS "{b}_mean", stddev_samp("{b}") AS "{b}_std"' for b in V2_BARS)
       + " FROM full_bars GROUP BY date, symbol, slot),\n"
       "days AS (SELECT date FROM (SELECT date, row_number() OVER (ORDER BY date DESC) AS r FROM calendar WHERE next IS NOT NULL) WHERE r > 6)\n"
       "SELECT u.date, u.symbol, s.slot, " + ", ".join(r(f'CAST("{c}" AS REAL)', c, 1) for c in V2_STATS)
       + f" FROM univ u JOIN days USING (date) CROSS JOIN (SELECT unnest({list(TEN_MINUTE_SLOTS)!r}) AS slot) s "
       "LEFT JOIN stats t ON t.date = u.date AND t.symbol = u.symbol AND t.slot = s.slot")
def dataset_v2(spark, sf_dir):
    """The full-width dataset, 139 bars at 24 slots, built from written items and compared in long form."""
    folder, days = work_folder(spark, "dataset"), fx.calendar(spark, sf_dir)
    paths = {name: f"{folder}/{name}" for name in ("bar_1m", "univ", "return", "lag_return")}
    plain = written_table(fx.bar_1m(spark, sf_dir).select("date", "symbol", "time", *V2_SOURCES), "plain")
    sinks.write_by_date(fx.univ(spark, sf_dir), paths["univ"])
    # symbols are dealt while bars are six columns; 139 are made of them where they are written
    buckets = max(spark.sparkContext.defaultParallelism, -(-spark.read.parquet(paths["univ"]).count() // SYMBOL_DAYS))
    made, table = plain.repartition(buckets, "symbol").selectExpr("date", "symbol", "time", *V2_MADE), f"bar_1m_{uuid.uuid4().hex}"
    sinks.write_by_date(made, paths["bar_1m"], sort=("symbol", "time"), placed=True, table=table, buckets=buckets)
    rets = return_tables.return_table(plain, days, fx.adj_factor(spark, sf_dir))
    sinks.write_by_date(rets, paths["return"])
    sinks.write_by_date(return_tables.lag_return_table(spark.read.parquet(paths["return"]), days), paths["lag_return"])
    dataset.build_dataset(spark, {**paths, "bar_1m": spark.table(table)}, f"{folder}/set", V2_BARS)
    spark.sql(f"DROP TABLE {table}")  # the files stay, they are not the catalogue's
    return fixed(resample.unwiden(spark.read.parquet(f"{folder}/set"), V2_STATS), 1)


# --- Splits, scaling, models ------------------------------------------------------------------------------------


@query("""WITH pos AS (SELECT count(*) AS i FROM order_calendar WHERE date <= DATE '2000-06-01'),
tagged AS (SELECT c.date, CASE WHEN idx >= greatest(i - 1035, 0) AND idx < i - 35 THEN 'train'
  WHEN idx >= i - 35 AND idx < i - 5 THEN 'eval' WHEN idx >= i AND idx < i + 20 THEN 'test' END AS split FROM order_calendar c, pos),
ends AS (SELECT split, min(date) AS b, max(date) AS e FROM tagged WHERE split IS NOT NULL GROUP BY split)
SELECT e.split, count(*) AS n_rows FROM orders o JOIN ends e ON CAST(o.o_orderdate AS DATE) BETWEEN e.b AND e.e GROUP BY e.split""")
def split_sizes(spark, sf_dir):
    ranges = splits.split_ranges(fx.order_calendar(spark, sf_dir), "2000-06-01", n_test=20)
    return splits.split_sizes(splits.tag_split(_orders(spark, sf_dir), ranges))


@query("""WITH miles AS (SELECT DISTINCT date_trunc('month', CAST(o_orderdate AS DATE))::DATE AS milestone FROM orders),
pos AS (SELECT milestone, count(c.date) AS i FROM miles LEFT JOIN order_calendar c ON c.date <= milestone GROUP BY milestone)
SELECT milestone, date, split FROM (SELECT p.milestone, c.date, CASE WHEN idx >= greatest(i - 135, 0) AND idx < i - 35 THEN 'train'
  WHEN idx >= i - 35 AND idx < i - 5 THEN 'eval' WHEN idx >= i AND idx < i + 10 THEN 'test' END AS split
  FROM pos p JOIN order_calendar c ON i - 35 >= 0) WHERE split IS NOT NULL""")
def milestone_splits(spark, sf_dir):
    miles = _orders(spark, sf_dir).select(F.trunc("date", "month").alias("milestone")).distinct()
    return splits.split_dates(miles, fx.order_calendar(spark, sf_dir), n_train=100, n_test=10)


@query(f"""WITH train AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}' for c in ('close', 'volume'))}
  FROM bar_1m WHERE date <= DATE '2024-01-16')
SELECT date, symbol, time, {', '.join(r(f'({c} - m_{c}) / nullif(s_{c}, 0)', c) for c in ('close', 'volume'))}
FROM bar_1m, train WHERE date > DATE '2024-01-16'""")
def zscore_fit_apply(spark, sf_dir):
    bars = fx.bar_1m(spark, sf_dir).select("date", "symbol", "time", "close", "volume")
    split_day = F.lit("2024-01-16").cast("date")
    scaler = scaling.normaliser("zscore", bars.where(F.col("date") <= split_day), ["close", "volume"])
    return fixed(scaler.transform(bars.where(F.col("date") > split_day)))


@query(f"""WITH st AS (SELECT date, {', '.join(f'avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}' for c in ('close', 'volume'))}
  FROM bar_1m GROUP BY date)
SELECT date, symbol, time, {', '.join(r(f'({c} - m_{c}) / nullif(s_{c}, 0)', c) for c in ('close', 'volume'))}
FROM bar_1m JOIN st USING (date)""")
def cs_zscore(spark, sf_dir):
    bars = fx.bar_1m(spark, sf_dir).select("date", "symbol", "time", "close", "volume")
    return fixed(scaling.normaliser("cs_zscore", bars, ["close", "volume"]).transform(bars))


@query("""WITH miles AS (SELECT DISTINCT date_trunc('month', CAST(o_orderdate AS DATE))::DATE AS milestone FROM orders),
ranked AS (SELECT c.date, m.milestone, row_number() OVER (PARTITION BY c.date ORDER BY m.milestone DESC) AS k
  FROM order_calendar c JOIN miles m ON m.milestone <= c.date)
SELECT date, milestone, CAST(k AS INTEGER) AS rank FROM ranked WHERE k <= 3""")
def latest_models(spark, sf_dir):
    miles = _orders(spark, sf_dir).select(F.trunc("date", "month").alias("milestone"))
    return asof.latest_versions(fx.order_calendar(spark, sf_dir), miles, 3)


Y1000 = ["rtn_v2v_1005_1D", "rtn_v2v_1005_2D", "rtn_v2v_1005_5D"]
X1000 = wide_columns(["close", "volume"], ONLINE_SLOTS)

PRED_CTE = f"""WITH cells AS (SELECT date, symbol, slot, {STAT_RAW} FROM slotted GROUP BY date, symbol, slot),
feats AS (SELECT date, symbol, stat || '_' || slot AS feature, v FROM (
  SELECT date, symbol, slot, unnest(['close_mean', 'close_std', 'volume_mean', 'volume_std']) AS stat,
         unnest([close_mean, close_std, volume_mean, volume_std]) AS v FROM cells)),
days AS (SELECT DISTINCT date, symbol FROM feats WHERE v IS NOT NULL AND right(feature, 4) IN ('0940', '0950', '1000')),
picks AS (SELECT c.date, m.milestone, row_number() OVER (PARTITION BY c.date ORDER BY m.milestone DESC) AS k
  FROM calendar c JOIN (SELECT DISTINCT milestone FROM models WHERE prod = '1000') m ON m.milestone <= c.date),
preds AS (SELECT d.date, d.symbol, p.milestone, p.k, m.y,
    sum(CASE WHEN m.feature = '(intercept)' THEN m.weight ELSE m.weight * (f.v - m.mean) / m.std END) AS pred
  FROM days d JOIN picks p USING (date) JOIN models m ON m.prod = '1000' AND m.milestone = p.milestone
  LEFT JOIN feats f ON f.date = d.date AND f.symbol = d.symbol AND f.feature = m.feature
  WHERE p.k <= 3 GROUP BY ALL)
"""


def _morning_wide(spark, sf_dir):
    long = resample.resample_long(fx.bar_1m(spark, sf_dir), ["close", "volume"])
    early = long.where(F.col("slot").isin(ONLINE_SLOTS))
    return resample.widen(early, resample.stat_names(["close", "volume"], resample.MEAN_STD), ONLINE_SLOTS)


def _models1000(spark, sf_dir):
    return fx.models(spark, sf_dir).where(F.col("prod") == "1000")


@query(PRED_CTE + f"SELECT date, symbol, milestone, CAST(k AS INTEGER) AS rank, y, {r('pred', 'pred')} FROM preds")
def linear_predictions(spark, sf_dir):
    return fixed(scoring.linear_predictions(_morning_wide(spark, sf_dir), _models1000(spark, sf_dir), X1000, 3))


@query(PRED_CTE + "SELECT date, symbol, " + ", ".join(r(f"max(CASE WHEN y = '{y}' THEN pred END)", y) for y in Y1000)
       + " FROM preds WHERE k = 1 GROUP BY date, symbol")
def linear_score(spark, sf_dir):
    return fixed(scoring.score_linear(_morning_wide(spark, sf_dir), _models1000(spark, sf_dir), X1000, Y1000, 1))


@query(PRED_CTE + "SELECT date, symbol, n_latest, " + ", ".join(r(f"avg(CASE WHEN y = '{y}' THEN pred END)", y) for y in Y1000)
       + " FROM preds JOIN (VALUES (1), (2), (3)) v(n_latest) ON k <= n_latest GROUP BY date, symbol, n_latest")
def ensemble_mean(spark, sf_dir):
    preds = scoring.linear_predictions(_morning_wide(spark, sf_dir), _models1000(spark, sf_dir), X1000, 3)
    return fixed(scoring.ensemble(preds, Y1000, [1, 2, 3]))


@query(PRED_CTE + "SELECT date, symbol, n_latest, " + ", ".join(r(f"avg(CASE WHEN y = '{y}' THEN pred END)", y) for y in Y1000)
       + " FROM preds JOIN (VALUES (1), (3)) v(n_latest) ON k <= n_latest GROUP BY date, symbol, n_latest")
def linear_score_several(spark, sf_dir):
    return fixed(scoring.score_linear(_morning_wide(spark, sf_dir), _models1000(spark, sf_dir), X1000, Y1000, [1, 3]))


def _partial_models(spark, sf_dir):
    """Models of which the earliest milestone lacks one label."""
    models = _models1000(spark, sf_dir)
    first = models.agg(F.min("milestone").alias("m")).scalar()
    return models.where(~((F.col("y") == Y1000[1]) & (F.col("milestone") == first)))


PARTIAL_SQL = PRED_CTE + "SELECT date, symbol, " + ", ".join(
    r(f"avg(CASE WHEN y = '{y}' AND NOT (y = '{Y1000[1]}' AND milestone = (SELECT min(milestone) FROM models WHERE prod = '1000')) THEN pred END)", y)
    for y in Y1000
) + " FROM preds GROUP BY date, symbol"


@query(PARTIAL_SQL)
def score_partial_labels(spark, sf_dir):
    return fixed(scoring.score_linear(_morning_wide(spark, sf_dir), _partial_models(spark, sf_dir), X1000, Y1000, 3))


@query(PARTIAL_SQL)
def score_partial_labels_joined(spark, sf_dir):
    preds = scoring.linear_predictions(_morning_wide(spark, sf_dir), _partial_models(spark, sf_dir), X1000, 3)
    return fixed(scoring.ensemble(preds, Y1000, 3))


@query(f"""SELECT date, symbol, CAST(s AS INTEGER) AS slot_pos, CAST(f AS INTEGER) AS feature_pos,
  {r("CASE f WHEN 0 THEN close_mean WHEN 1 THEN close_std WHEN 2 THEN volume_mean ELSE volume_std END", 'value')}
FROM (SELECT DISTINCT date, symbol FROM slotted WHERE slot IN ('0940', '0950', '1000'))
CROSS JOIN (VALUES (0, '0940'), (1, '0950'), (2, '1000')) v(s, slot) CROSS JOIN (VALUES (0), (1), (2), (3)) w(f)
LEFT JOIN (SELECT date, symbol, slot, {STAT_RAW} FROM slotted GROUP BY date, symbol, slot) USING (date, symbol, slot)""")
def feature_matrix(spark, sf_dir):
    long = resample.resample_long(fx.bar_1m(spark, sf_dir), ["close", "volume"])
    x = matrices.matrix_from_long(long, ["close_mean", "close_std", "volume_mean", "volume_std"], ONLINE_SLOTS)
    rows = x.select("date", "symbol", F.posexplode("x").alias("slot_pos", "row"))
    return fixed(rows.select("date", "symbol", "slot_pos", F.posexplode("row").alias("feature_pos", "value")))


@query(f"""SELECT date, symbol, {r("(coalesce(max(CASE WHEN slot='0940' THEN cm END),0) + 2*coalesce(max(CASE WHEN slot='0950' THEN cm END),0) + 3*coalesce(max(CASE WHEN slot='1000' THEN cm END),0)) / 6", 'y_close')},
  {r("(coalesce(max(CASE WHEN slot='0940' THEN vm END),0) + 2*coalesce(max(CASE WHEN slot='0950' THEN vm END),0) + 3*coalesce(max(CASE WHEN slot='1000' THEN vm END),0)) / 6", 'y_volume')}
FROM (SELECT date, symbol, slot, avg(close) AS cm, avg(volume) AS vm FROM slotted WHERE slot IN ('0940', '0950', '1000')
  GROUP BY date, symbol, slot) GROUP BY date, symbol""")
def matrix_model_score(spark, sf_dir):
    def recency_weighted(x):
        """A stand-in for a trained sequence model: weights grow toward the last slot."""
        import numpy as np

        w = np.arange(1, x.shape[1] + 1) / x.shape[1]
        mean = np.nansum(x * w[None, :, None], axis=1) / w.sum()
        return np.stack([mean[:, 0], mean[:, 2]], axis=1)

    long = resample.resample_long(fx.bar_1m(spark, sf_dir), ["close", "volume"])
    x = matrices.matrix_from_long(long, ["close_mean", "close_std", "volume_mean", "volume_std"], ONLINE_SLOTS)
    return fixed(scoring.score_with(x, recency_weighted, ["y_close", "y_volume"], (3, 4)))


@query(f"""WITH raw AS (SELECT volume AS a, CAST(total_trades AS DOUBLE) AS b, high - low AS y FROM bar_1m WHERE date <= DATE '2024-01-16'),
z AS (SELECT (a - avg(a) OVER ()) / stddev_samp(a) OVER () AS a, (b - avg(b) OVER ()) / stddev_samp(b) OVER () AS b, y FROM raw),
m AS (SELECT covar_pop(a, y) AS ay, covar_pop(b, y) AS "by", covar_pop(a, b) AS ab, var_pop(a) AS aa, var_pop(b) AS bb, avg(y) AS my FROM z),
w AS (SELECT (ay * bb - "by" * ab) / (aa * bb - ab * ab) AS wa, ("by" * aa - ay * ab) / (aa * bb - ab * ab) AS wb, my FROM m),
s AS (SELECT avg(a) AS ma, stddev_samp(a) AS sa, avg(b) AS mb, stddev_samp(b) AS sb FROM raw)
SELECT '1000' AS prod, DATE '2024-01-17' AS milestone, 'range' AS y, feature, {r('weight', 'weight', 4)}, {r('mean', 'mean', 4)}, {r('std', 'std', 4)} FROM (
  SELECT '(intercept)' AS feature, my AS weight, NULL::DOUBLE AS mean, NULL::DOUBLE AS std FROM w
  UNION ALL SELECT 'volume', wa, ma, sa FROM w, s UNION ALL SELECT 'total_trades', wb, mb, sb FROM w, s)""")
def trained_model(spark, sf_dir):
    bars = fx.bar_1m(spark, sf_dir).withColumn("range", F.col("high") - F.col("low"))
    train = bars.where(F.col("date") <= F.lit("2024-01-16").cast("date"))
    return fixed(training.train_linear(train, ["volume", "total_trades"], ["range"], "1000", "2024-01-17"), 4)


@query(f"""WITH raw AS (SELECT volume AS a, CASE WHEN total_trades % 5 = 0 THEN NULL ELSE CAST(total_trades AS DOUBLE) END AS b, high - low AS y FROM bar_1m WHERE date <= DATE '2024-01-16'),
z AS (SELECT (a - avg(a) OVER ()) / stddev_samp(a) OVER () AS a, coalesce((b - avg(b) OVER ()) / stddev_samp(b) OVER (), 0) AS b, y FROM raw),
m AS (SELECT covar_pop(a, y) AS ay, covar_pop(b, y) AS "by", covar_pop(a, b) AS ab, var_pop(a) AS aa, var_pop(b) AS bb, avg(y) AS my FROM z),
w AS (SELECT (ay * bb - "by" * ab) / (aa * bb - ab * ab) AS wa, ("by" * aa - ay * ab) / (aa * bb - ab * ab) AS wb, my FROM m),
s AS (SELECT avg(a) AS ma, stddev_samp(a) AS sa, avg(b) AS mb, stddev_samp(b) AS sb FROM raw)
SELECT '1000' AS prod, DATE '2024-01-17' AS milestone, 'range' AS y, feature, {r('weight', 'weight', 4)}, {r('mean', 'mean', 4)}, {r('std', 'std', 4)} FROM (
  SELECT '(intercept)' AS feature, my AS weight, NULL::DOUBLE AS mean, NULL::DOUBLE AS std FROM w
  UNION ALL SELECT 'volume', wa, ma, sa FROM w, s UNION ALL SELECT 'total_trades', wb, mb, sb FROM w, s)""")
def trained_model_nan(spark, sf_dir):
    gap = F.when(F.col("total_trades") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("total_trades"))
    bars = fx.bar_1m(spark, sf_dir).withColumn("range", F.col("high") - F.col("low")).withColumn("total_trades", gap)
    train = bars.where(F.col("date") <= F.lit("2024-01-16").cast("date"))
    return fixed(training.train_linear(train, ["volume", "total_trades"], ["range"], "1000", "2024-01-17"), 4)


# Three milestones of windows of five training and two evaluation dates, a date apart from the milestone.
WALK = {"n_train": 5, "n_eval": 2, "n_lag": 1}
WALK_AT, WALK_REGS = (6, 8, 10), (0.0, 0.1, 1.0)
WALK_ROWS = """WITH raw AS (SELECT b.date, c.idx, volume AS a, CASE WHEN total_trades % 5 = 0 THEN NULL ELSE CAST(total_trades AS DOUBLE) END AS b,
  unnest([{'y': 'range', 'v': high - low}, {'y': 'move', 'v': CASE WHEN total_trades % 3 = 0 THEN NULL ELSE close - open END}], recursive := true)
  FROM bar_1m b JOIN calendar c USING (date)),
miles AS (SELECT date AS milestone, idx + 1 AS i FROM calendar WHERE idx IN (6, 8, 10)),
windows AS (SELECT milestone, raw.*, CASE WHEN idx >= i - 3 THEN 'eval' ELSE 'train' END AS split
  FROM miles JOIN raw ON idx >= greatest(i - 8, 0) AND idx < i - 1 WHERE i >= 3)"""
WALK_Z = """,
s AS (SELECT milestone, avg(a) AS ma, stddev_samp(a) AS sa, avg(b) AS mb, stddev_samp(b) AS sb FROM windows WHERE split = 'train' AND y = 'range'
  GROUP BY milestone),
z AS (SELECT milestone, split, y, v, coalesce((a - ma) / sa, 0) AS a, coalesce((b - mb) / sb, 0) AS b
  FROM windows JOIN s USING (milestone) WHERE v IS NOT NULL)"""
WALK_DATED = """,
s AS (SELECT milestone, NULL::DOUBLE AS ma, NULL::DOUBLE AS sa, NULL::DOUBLE AS mb, NULL::DOUBLE AS sb FROM miles),
d AS (SELECT date, avg(a) AS ma, stddev_samp(a) AS sa, avg(b) AS mb, stddev_samp(b) AS sb FROM raw WHERE y = 'range' GROUP BY date),
z AS (SELECT milestone, split, y, v, coalesce((a - ma) / sa, 0) AS a, coalesce((b - mb) / sb, 0) AS b
  FROM windows JOIN d USING (date) WHERE v IS NOT NULL)"""
WALK_FIT = """,
m AS (SELECT milestone, y, covar_pop(a, v) AS ay, covar_pop(b, v) AS "by", covar_pop(a, b) AS ab, var_pop(a) AS aa, var_pop(b) AS bb, avg(v) AS my,
  avg(a) AS ma, avg(b) AS mb FROM z WHERE split = 'train' GROUP BY milestone, y),
p AS (SELECT *, (ay * (bb + reg) - "by" * ab) / ((aa + reg) * (bb + reg) - ab * ab) AS wa,
  ("by" * (aa + reg) - ay * ab) / ((aa + reg) * (bb + reg) - ab * ab) AS wb FROM m, (VALUES (0.0::DOUBLE), (0.1::DOUBLE), (1.0::DOUBLE)) AS r(reg)),
w AS (SELECT milestone, y, reg, wa, wb, my - wa * ma - wb * mb AS w0 FROM p),
e AS (SELECT milestone, y, reg, count(*) AS n_eval, avg((v - w0 - wa * a - wb * b) ** 2) AS mse FROM w JOIN z USING (milestone, y)
  WHERE split = 'eval' GROUP BY milestone, y, reg),
best AS (SELECT *, row_number() OVER (PARTITION BY milestone, y ORDER BY mse, reg) = 1 AS chosen FROM e)"""
WALK_MODELS = f""" SELECT '1000' AS prod, milestone, y, feature, {r('weight', 'weight', 4)}, {r('mean', 'mean', 4)}, {r('std', 'std', 4)}, NORMALISER AS normaliser FROM (
  SELECT milestone, y, '(intercept)' AS feature, w0 AS weight, NULL::DOUBLE AS mean, NULL::DOUBLE AS std FROM w JOIN best USING (milestone, y, reg) WHERE chosen
  UNION ALL SELECT milestone, y, 'volume', wa, ma, sa FROM w JOIN best USING (milestone, y, reg) JOIN s USING (milestone) WHERE chosen
  UNION ALL SELECT milestone, y, 'total_trades', wb, mb, sb FROM w JOIN best USING (milestone, y, reg) JOIN s USING (milestone) WHERE chosen)"""


def _walk(spark, sf_dir, normaliser="zscore"):
    gap = F.when(F.col("total_trades") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("total_trades"))
    move = F.when(F.col("total_trades") % 3 != 0, F.col("close") - F.col("open"))
    bars = fx.bar_1m(spark, sf_dir).withColumns({"range": F.col("high") - F.col("low"), "move": move, "total_trades": gap})
    days = fx.calendar(spark, sf_dir)
    at = [x["date"] for x in days.where(F.col("idx").isin(list(WALK_AT))).collect()]
    return walk_forward.train_walk_forward(
        bars, days, at, ["volume", "total_trades"], ["range", "move"], "1000", regs=WALK_REGS, normaliser=normaliser, **WALK
    )


@query(WALK_ROWS + WALK_Z + WALK_FIT + WALK_MODELS.replace("NORMALISER", "'zscore'"))
def walk_forward_models(spark, sf_dir):
    """Models of three milestones and two labels from sums of the dates' products, the data read once."""
    return fixed(_walk(spark, sf_dir)[0], 4)


@query(WALK_ROWS + WALK_Z + WALK_FIT + f" SELECT '1000' AS prod, milestone, y, reg, n_eval, {r('mse', 'mse', 3)}, chosen FROM best")
def ridge_choice(spark, sf_dir):
    """Errors of each strength of the ridge path on the evaluation dates, and the one kept."""
    return fixed(_walk(spark, sf_dir)[1], 3)


@query(WALK_ROWS + WALK_DATED + WALK_FIT + WALK_MODELS.replace("NORMALISER", "'cs_zscore'"))
def trained_model_cs(spark, sf_dir):
    """The same with features standardised within each date."""
    return fixed(_walk(spark, sf_dir, "cs_zscore")[0], 4)


CS_MODELS = [("cs_zscore", "volume", 0.5), ("cs_zscore", "total_trades", -0.25), ("cs_zscore", "(intercept)", 0.125)]


@query(f"""WITH raw AS (SELECT date, symbol, time, volume AS a, CAST(total_trades AS DOUBLE) AS b FROM bar_1m),
d AS (SELECT date, avg(a) AS ma, stddev_samp(a) AS sa, avg(b) AS mb, stddev_samp(b) AS sb FROM raw GROUP BY date),
p AS (SELECT raw.*, 0.125 + 0.5 * coalesce((a - ma) / sa, 0) - 0.25 * coalesce((b - mb) / sb, 0) AS within,
  1.0 + 0.01 * (a - 10) AS plain FROM raw JOIN d USING (date))
SELECT date, symbol, time, {r("CASE WHEN date >= DATE '2024-01-16' THEN (within + plain) / 2 ELSE within END", 'signal')}
FROM p WHERE date >= DATE '2024-01-10'""")
def linear_score_cs(spark, sf_dir):
    """A model that normalises within the date, averaged later with one of fixed means and deviations."""
    early, late = dt.date(2024, 1, 10), dt.date(2024, 1, 16)
    rows = [("1000", early, "signal", f, w, None, None, n) for n, f, w in CS_MODELS]
    rows += [("1000", late, "signal", "volume", 0.1, 10.0, 10.0, "zscore"), ("1000", late, "signal", "(intercept)", 1.0, None, None, "zscore")]
    models = spark.createDataFrame(rows, f"{training.MODEL_SCHEMA}, normaliser string")
    bars = fx.bar_1m(spark, sf_dir)
    return fixed(scoring.score_linear(bars, models, ["volume", "total_trades"], ["signal"], 2, index=("date", "symbol", "time")))


# --- Alpha ------------------------------------------------------------------------------------------------------


@query(PRED_CTE + f"""SELECT p.date, CAST(p.date AS TIMESTAMP) + INTERVAL 10 HOUR AS time, p.symbol, {r('avg(pred)', 'alpha')}
FROM preds p JOIN univ u USING (date, symbol) WHERE u.euniv_largemid AND y = 'rtn_v2v_1005_2D' AND k <= 2
  AND p.date BETWEEN DATE '2024-01-10' AND DATE '2024-01-19' GROUP BY p.date, p.symbol""")
def alpha_hist(spark, sf_dir):
    rows = _morning_wide(spark, sf_dir).join(fx.univ(spark, sf_dir), ["date", "symbol"])
    stat_cols = resample.stat_names(["close", "volume"], resample.MEAN_STD)
    return fixed(
        alpha.alpha_history(
            rows, fx.models(spark, sf_dir), "1000", stat_cols, fx.calendar(spark, sf_dir),
            "2024-01-10", "20240119", n_latest=2, universe="euniv_largemid",
        )
    )


AFTERNOON = [s for s in TEN_MINUTE_SLOTS if s > "1300"]
NEXT_DAY_CTE = f"""WITH cells AS (SELECT date, symbol, slot, avg(close) AS v FROM slotted WHERE slot > '1300' GROUP BY date, symbol, slot),
picks AS (SELECT c.date, max(m.milestone) AS milestone FROM calendar c JOIN models m ON m.prod = '0930' AND m.milestone <= c.date GROUP BY c.date),
preds AS (SELECT d.date, d.symbol, coalesce(sum(m.weight * (f.v - m.mean) / m.std), 0) AS pred
  FROM (SELECT DISTINCT date, symbol FROM cells) d JOIN picks p USING (date)
  JOIN models m ON m.prod = '0930' AND m.milestone = p.milestone
  LEFT JOIN cells f ON f.date = d.date AND f.symbol = d.symbol AND m.feature = 'close_mean_' || f.slot
  GROUP BY d.date, d.symbol),
shifted AS (SELECT c.next AS date, CAST(c.next AS TIMESTAMP) + INTERVAL '570' MINUTE AS time, symbol, {r('pred', 'alpha')}
  FROM preds JOIN calendar c USING (date))
"""


def _next_day_alpha(spark, sf_dir):
    long = resample.resample_long(fx.bar_1m(spark, sf_dir), ["close"], ("mean",))
    wide = resample.widen(long.where(F.col("slot").isin(AFTERNOON)), ["close_mean"], AFTERNOON)
    return alpha.alpha_history(
        wide, fx.models(spark, sf_dir), "0930", ["close_mean"], fx.calendar(spark, sf_dir), "2024-01-01", "2024-12-31"
    )


@query(NEXT_DAY_CTE + "SELECT date, time, symbol, alpha FROM shifted")
def alpha_next_day(spark, sf_dir):
    return fixed(_next_day_alpha(spark, sf_dir))


@query(NEXT_DAY_CTE + "SELECT u.date, count(*) AS n_rows, count_if(s.alpha IS NOT NULL AND NOT isnan(s.alpha)) AS n_valid "
       "FROM univ u LEFT JOIN shifted s USING (date, symbol) GROUP BY u.date")
def alpha_validity(spark, sf_dir):
    rows = fx.univ(spark, sf_dir).join(_next_day_alpha(spark, sf_dir), ["date", "symbol"], "left")
    return alpha.alpha_validity(rows)


@query(PRED_CTE.rstrip() + f""",
whole AS (SELECT date, symbol FROM slotted WHERE {MORNING} GROUP BY date, symbol HAVING count(time) = 30)
SELECT p.date, CAST(p.date AS TIMESTAMP) + INTERVAL 10 HOUR AS time, p.symbol, {r('pred', 'alpha')}
FROM preds p JOIN univ u USING (date, symbol) JOIN whole USING (date, symbol)
WHERE u.euniv_largemid AND y = 'rtn_v2v_1005_2D' AND k = 1 AND p.date = DATE '2024-01-15'""")
def alpha_online(spark, sf_dir):
    members = readers.read_universe(spark, fx.univ(spark, sf_dir), "euniv_largemid")
    return fixed(
        alpha.alpha_online(
            fx.bar_1m(spark, sf_dir), fx.models(spark, sf_dir), "1000", ["close", "volume"],
            fx.calendar(spark, sf_dir), "20240115", universe=members,
        )
    )


@query(f"""SELECT p.prod, p.date, p.symbol, p.alpha FROM (SELECT '0930' AS prod, * FROM (
{NEXT_DAY_CTE} SELECT * FROM shifted)) p WHERE p.date IS NOT NULL""")
def alpha_written(spark, sf_dir):
    path = work_folder(spark, "alpha")
    alpha.write_alpha(_next_day_alpha(spark, sf_dir).where(F.col("date").isNotNull()), path, "0930")
    table = spark.read.schema("date date, time timestamp_ntz, symbol string, alpha double, prod string").parquet(path)
    return fixed(table.select("prod", "date", "symbol", "alpha"))


# --- Streams ----------------------------------------------------------------------------------------------------

TICK_SQL = f"""WITH ticks AS (SELECT ts AS time, 'U' || lpad(CAST(user_id // 50 AS VARCHAR), 6, '0') AS symbol, value,
  strftime(ts, '%H%M') AS hhmm FROM events),
inside AS (SELECT *, time_bucket(INTERVAL 10 MINUTE, time - INTERVAL 1 MINUTE) AS b FROM ticks
  WHERE hhmm BETWEEN '0931' AND '1130' OR hhmm BETWEEN '1301' AND '1500')
SELECT CAST(time AS DATE) AS date, symbol, strftime(b + INTERVAL 10 MINUTE, '%H%M') AS slot, {stats_sql(['value'])}, count(*) AS count
FROM inside WHERE time <= b + INTERVAL 10 MINUTE GROUP BY ALL"""


@query(TICK_SQL)
def stream_downsample(spark, sf_dir):
    """The events as a stream; every session window is past the final watermark."""
    out = stats.resample_stream(fx.ticks(spark, sf_dir), ["value"])
    path = work_folder(spark, "stream")
    run = (
        out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{path}/state")
        .trigger(availableNow=True).start(f"{path}/rows")
    )
    run.awaitTermination()
    return fixed(spark.read.schema(out.schema).parquet(f"{path}/rows"))


@query(TICK_SQL)
def stream_by_date(spark, sf_dir):
    path = work_folder(spark, "stream")
    out = stats.resample_stream(fx.ticks(spark, sf_dir), ["value"])
    stats.write_stream_by_date(out, f"{path}/rows", f"{path}/state").start().awaitTermination()
    return fixed(spark.read.parquet(f"{path}/rows").select(*out.columns))


# The first quarter of the time without a tenth of its ticks, then the rest up to 11:00 of the last day, then that tenth: too late.
REPLAY_SQL = f"""WITH span AS (SELECT min(ts) AS a, max(ts) AS z FROM events),
ticks AS (SELECT ts AS time, 'U' || lpad(CAST(user_id // 50 AS VARCHAR), 6, '0') AS symbol, value, strftime(ts, '%H%M') AS hhmm,
  ts < a + (z - a) / 4 AS early, event_id % 10 = 0 AND ts < a + (z - a) / 4 AS held FROM events, span WHERE ts < CAST(z AS DATE) + INTERVAL 11 HOUR),
-- a batch drops what the watermark of the batch before it had closed: the third, what the first had
first AS (SELECT max(time) - INTERVAL 2 HOUR AS w1 FROM ticks WHERE early AND NOT held),
inside AS (SELECT * EXCLUDE (held), held AND done <= w1 AS late FROM (
  SELECT *, time_bucket(INTERVAL 10 MINUTE, time - INTERVAL 1 MINUTE) + INTERVAL 11 MINUTE AS done FROM ticks), first
  WHERE (hhmm BETWEEN '0931' AND '1130' OR hhmm BETWEEN '1301' AND '1500')
  AND time <= time_bucket(INTERVAL 10 MINUTE, time - INTERVAL 1 MINUTE) + INTERVAL 10 MINUTE),
mark AS (SELECT max(time) - INTERVAL 2 HOUR AS w FROM ticks WHERE NOT held),
seen AS (SELECT symbol, done, count(*) AS n FROM inside WHERE NOT late GROUP BY symbol, done)
SELECT (SELECT count(*) FROM seen, mark WHERE done <= w) AS emitted_windows,
  (SELECT coalesce(sum(n), 0)::BIGINT FROM seen, mark WHERE done <= w) AS emitted_ticks,
  (SELECT count(*) FROM seen, mark WHERE done > w) AS open_windows,
  (SELECT coalesce(sum(n), 0)::BIGINT FROM seen, mark WHERE done > w) AS open_ticks,
  (SELECT count(*) FROM inside WHERE late) AS late_ticks"""


@query(REPLAY_SQL)
def stream_replay(spark, sf_dir):
    """The events in three batches, the last of them late, two hours of lateness: what was emitted, waits in the state, was dropped."""
    folder = work_folder(spark, "replay")
    events = fx.table(spark, sf_dir, "events")
    a, z = events.agg(F.min("ts"), F.max("ts")).first()
    quarter = F.lit(a + (z - a) / 4).cast("timestamp_ntz")
    events = events.where(F.col("ts") < F.lit(dt.datetime.combine(z.date(), dt.time(11))).cast("timestamp_ntz"))
    held = (F.col("event_id") % 10 == 0) & (F.col("ts") < quarter)
    for name, rows in (("1", ~held & (F.col("ts") < quarter)), ("2", ~held & (F.col("ts") >= quarter)), ("3", held)):
        events.where(rows).coalesce(1).write.parquet(f"{folder}/in/{name}")
    stream = fx.tick_columns(
        spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).option("pathGlobFilter", "*.parquet").parquet(f"{folder}/in/*")
    )
    out = stats.resample_stream(stream, ["value"], lateness="2 hours")
    stats.write_stream_by_date(out, f"{folder}/rows", f"{folder}/state").start().awaitTermination()
    emitted = spark.read.parquet(f"{folder}/rows").agg(F.count("*").alias("emitted_windows"), F.coalesce(F.sum("count"), F.lit(0)).alias("emitted_ticks"))
    waiting = stats.open_windows(spark, f"{folder}/state").agg(F.count("*").alias("open_windows"), F.coalesce(F.sum("count"), F.lit(0)).alias("open_ticks"))
    ticks = fx.tick_columns(events)
    every = ticks.where(clock.in_session("time") & resample.inside_window("time")).agg(F.count("*").alias("n"))
    late = F.col("n") - F.col("emitted_ticks") - F.col("open_ticks")
    return emitted.join(waiting).join(every).withColumn("late_ticks", late).drop("n")


@query("SELECT date, symbol, euniv_largemid FROM univ WHERE date = DATE '2024-01-15'")
def one_date(spark, sf_dir):
    """One date of a written item: only its folder is read."""
    path = work_folder(spark, "univ")
    sinks.write_by_date(fx.univ(spark, sf_dir), path)
    return readers.read_one_date(spark, path, "20240115").select("date", "symbol", "euniv_largemid")


@query(f"""SELECT date, symbol, {', '.join(r(f"CAST(max(CASE WHEN slot = '{s}' THEN {b}_{o} END) AS REAL)", f'{b}_{o}_{s}', 2) for b in DATASET_BARS for o in ('mean', 'std') for s in DATASET_SLOTS)}
FROM (SELECT date, symbol, slot, {STAT_RAW} FROM slotted GROUP BY date, symbol, slot) GROUP BY date, symbol""")
def pending_downsample(spark, sf_dir):
    """Minute bars written in two goes; each time only the dates that the ten-minute table lacks are downsampled."""
    folder, day = work_folder(spark, "pending"), F.lit("2024-01-15").cast("date")
    bars = fx.bar_1m(spark, sf_dir).select("date", "symbol", "time", *DATASET_BARS)
    for some in (bars.where(F.col("date") < day), bars.where(F.col("date") >= day)):
        sinks.write_by_date(some, f"{folder}/bar_1m", sort=("symbol", "time"))
        dataset.downsample_pending(spark, f"{folder}/bar_1m", f"{folder}/10m", DATASET_BARS, DATASET_SLOTS)
    wide = spark.read.parquet(f"{folder}/10m")
    return fixed(wide.select("date", "symbol", *wide_columns(DATASET_BARS, DATASET_SLOTS)), 2)


@query(f"""WITH cells AS (SELECT date, symbol, slot, avg(close) AS cm FROM slotted WHERE slot IN ('0940', '0950', '1000') GROUP BY date, symbol, slot),
x AS (SELECT date, symbol, avg(cm) AS m FROM cells GROUP BY date, symbol),
versions AS (SELECT date AS milestone, idx + 1 AS k FROM calendar WHERE idx IN (2, 5, 8)),
picks AS (SELECT c.date, v.k, row_number() OVER (PARTITION BY c.date ORDER BY v.milestone DESC) AS rank FROM calendar c JOIN versions v ON v.milestone <= c.date)
SELECT x.date, x.symbol, {r('avg(x.m * k)', 'signal', 3)} FROM x JOIN picks p ON p.date = x.date AND p.rank <= 2 GROUP BY x.date, x.symbol""")
def version_scores(spark, sf_dir):
    """Any model by version: the mean of the latest two versions of a model that weighs a mean price by its number."""
    days = fx.calendar(spark, sf_dir)
    numbers = {x["date"]: x["idx"] + 1 for x in days.where(F.col("idx").isin([2, 5, 8])).collect()}
    versions = spark.createDataFrame([(d,) for d in numbers], "milestone date")

    def weighed(x, milestone):
        import numpy as np

        return np.nanmean(x[:, :, 0], axis=1)[:, None] * numbers[milestone]

    long = resample.resample_long(fx.bar_1m(spark, sf_dir), ["close"])
    x = matrices.matrix_from_long(long, ["close_mean"], ONLINE_SLOTS)
    return fixed(scoring.score_versions(x, versions, weighed, ["signal"], (3, 1), n_latest=2), 3)
