"""SQL that states, for each registered query, the rows it must return."""

from __future__ import annotations

SERIES = "PARTITION BY symbol ORDER BY price_date"


def rows(n: int) -> str:
    return f"OVER ({SERIES} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def lag(column: str, n: int = 1) -> str:
    return f"lag({column}, {n}) OVER ({SERIES})"


def lead(column: str, n: int = 1) -> str:
    return f"lead({column}, {n}) OVER ({SERIES})"


def out(exact: str, rounded: str = "") -> str:
    """Select list: columns as they are, then columns rounded to six places."""
    return ", ".join(exact.split() + [f"round({c}, 6) + 0 AS {c}" for c in rounded.split()])


def query(parts: list[str], select: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + select


BARS = """bars AS MATERIALIZED (
  SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS symbol, lower(r_name) AS sector, price_date,
         min(line).price AS open_price, max(line.price) AS high_price,
         min(line.price) AS low_price, max(line).price AS close_price,
         CAST(sum(l_quantity) AS BIGINT) AS volume
  FROM (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS price_date, l_quantity,
               struct_pack(o := l_orderkey, n := l_linenumber,
                           price := l_extendedprice / l_quantity) AS line
        FROM lineitem)
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  GROUP BY l_suppkey, r_name, price_date)"""

RAW = """marked AS (
  SELECT *, CAST(price_date AS TIMESTAMP) AS date, day(price_date) AS d,
         CASE WHEN sector IN ('africa', 'asia') THEN lower(symbol) ELSE symbol END AS listed
  FROM bars),
raw AS MATERIALIZED (
  SELECT date, listed AS symbol, upper(sector) AS sector, open_price, high_price, low_price,
         close_price, volume, '2002-01-02T00:00:00' AS extraction_timestamp FROM marked
  UNION ALL
  SELECT date, listed, upper(sector), open_price, high_price + 1, low_price, close_price + 1,
         volume, CASE d WHEN 15 THEN '2002-01-01T00:00:00' ELSE '2002-01-03T00:00:00' END
  FROM marked WHERE d IN (15, 16)
  UNION ALL
  SELECT date, listed, upper(sector), open_price, high_price, low_price, NULL,
         volume, '2002-01-04T00:00:00' FROM marked WHERE d = 20 AND sector = 'europe'
  UNION ALL
  SELECT NULL, listed, upper(sector), open_price, high_price, low_price, close_price,
         volume, '2002-01-04T00:00:00' FROM marked WHERE d = 21 AND sector = 'america')"""

STAGED = """staged AS MATERIALIZED (
  SELECT price_date, symbol, sector, open_price, high_price, low_price, close_price, volume,
         high_price - low_price AS daily_range, extraction_timestamp
  FROM (SELECT * REPLACE (upper(symbol) AS symbol, lower(sector) AS sector),
               CAST(date AS DATE) AS price_date,
               row_number() OVER (PARTITION BY CAST(date AS DATE), upper(symbol)
                                  ORDER BY extraction_timestamp DESC) AS newest
        FROM raw WHERE date IS NOT NULL AND symbol IS NOT NULL AND close_price IS NOT NULL)
  WHERE newest = 1)"""

STAGING = [BARS, RAW, STAGED]
STAGED_EXACT = (
    "price_date symbol sector open_price high_price low_price close_price volume daily_range "
    "extraction_timestamp"
)


def indicator_parts(source: str, prefix: str = "") -> list[str]:
    """Relations ending in ``{prefix}indicators`` over a relation with staged columns."""
    return [
        f"""{prefix}prices AS (
  SELECT symbol, price_date, sector, open_price, high_price, low_price, close_price, volume,
         high_price - low_price AS daily_range, {lag('close_price')} AS pc,
         avg(close_price) {rows(7)} AS sma_7, avg(close_price) {rows(14)} AS sma_14,
         avg(close_price) {rows(30)} AS sma_30, avg(close_price) {rows(50)} AS sma_50,
         avg(close_price) {rows(200)} AS sma_200,
         avg(close_price) {rows(12)} - avg(close_price) {rows(26)} AS macd_line,
         avg(close_price) {rows(20)} AS bb_middle,
         2 * stddev_samp(close_price) {rows(20)} AS band,
         avg(volume) {rows(20)} AS volume_sma_20
  FROM {source})""",
        f"""{prefix}moves AS (
  SELECT *, CASE WHEN close_price > pc THEN close_price - pc ELSE 0 END AS gain,
         CASE WHEN close_price < pc THEN pc - close_price ELSE 0 END AS loss,
         greatest(high_price - low_price, abs(high_price - pc), abs(low_price - pc)) AS tr,
         CASE WHEN close_price > pc THEN volume WHEN close_price < pc THEN -volume
              ELSE 0 END AS flow,
         (close_price - pc) / nullif(pc, 0) AS daily_return
  FROM {prefix}prices)""",
        f"""{prefix}layered AS (
  SELECT *, avg(gain) {rows(14)} AS avg_gain, avg(loss) {rows(14)} AS avg_loss,
         avg(macd_line) {rows(9)} AS macd_signal, avg(tr) {rows(14)} AS atr_14,
         CAST(sum(flow) OVER ({SERIES}) AS BIGINT) AS obv,
         stddev_samp(daily_return) {rows(20)} AS volatility_20,
         bb_middle + band AS bb_upper, bb_middle - band AS bb_lower
  FROM {prefix}moves)""",
        f"""{prefix}indicators AS MATERIALIZED (
  SELECT *, CASE WHEN avg_loss = 0 THEN 100 ELSE 100 - 100 / (1 + avg_gain / avg_loss) END
              AS rsi_14,
         macd_line - macd_signal AS macd_histogram,
         CASE WHEN bb_upper - bb_lower = 0 THEN 0
              ELSE (close_price - bb_lower) / nullif(bb_upper - bb_lower, 0) END AS bb_position,
         CASE WHEN volume_sma_20 > 0 THEN volume / volume_sma_20 ELSE 1 END AS volume_ratio
  FROM {prefix}layered)""",
    ]


INDICATOR_EXACT = (
    "symbol price_date open_price high_price low_price close_price volume daily_range obv"
)
INDICATOR_ROUNDED = (
    "sma_7 sma_14 sma_30 sma_50 sma_200 rsi_14 macd_line macd_signal macd_histogram bb_middle "
    "bb_upper bb_lower bb_position atr_14 volume_sma_20 volume_ratio volatility_20"
)


def pct(now: str, base: str) -> str:
    return f"({now} - {base}) / nullif({base}, 0) * 100"


LAGS = ", ".join(
    f"{pct('close_price', lag('close_price', n))} AS lag_{n}_day_return" for n in (1, 3, 5, 7)
)
MOMENTUM = (
    ", ".join(
        f"{pct('close_price', lag('close_price', n))} AS momentum_{n}" for n in (7, 14, 30)
    )
    + f", close_price - {lag('close_price')} AS momentum_1"
)
CROSSES = f"""CASE WHEN sma_50 > sma_200 AND {lag('sma_50')} <= {lag('sma_200')}
              THEN 1 ELSE 0 END AS golden_cross_signal,
         CASE WHEN sma_50 < sma_200 AND {lag('sma_50')} >= {lag('sma_200')}
              THEN 1 ELSE 0 END AS death_cross_signal,
         sma_50 - sma_200 AS ma_crossover_distance, sma_7 - sma_14 AS short_term_trend"""
RANGES = ", ".join(
    f"min(low_price) {rows(n)} AS support_{n}, max(high_price) {rows(n)} AS resistance_{n}"
    for n in (20, 50)
)
POSITIONS = ", ".join(
    f"CASE WHEN resistance_{n} = support_{n} THEN 0.5 ELSE (close_price - support_{n}) / "
    f"(resistance_{n} - support_{n}) END AS price_position_{n}"
    for n in (20, 50)
)


def feature_parts(prefix: str = "") -> list[str]:
    return [
        f"""{prefix}ranged AS (
  SELECT * REPLACE (first_value(sector) OVER ({SERIES}) AS sector),
         {LAGS}, {MOMENTUM}, {CROSSES}, {RANGES}
  FROM {prefix}indicators)""",
        f"""{prefix}features AS MATERIALIZED (
  SELECT *, {POSITIONS} FROM {prefix}ranged)""",
    ]


FEATURE_EXACT = (
    INDICATOR_EXACT + " momentum_1 golden_cross_signal death_cross_signal support_20 "
    "resistance_20 support_50 resistance_50"
)
FEATURE_ROUNDED = (
    INDICATOR_ROUNDED + " lag_1_day_return lag_3_day_return lag_5_day_return lag_7_day_return "
    "momentum_7 momentum_14 momentum_30 ma_crossover_distance short_term_trend "
    "price_position_20 price_position_50"
)

TARGETS = ", ".join(
    f"{pct(lead('close_price', n), 'close_price')} AS next_{name}_return"
    for name, n in (("day", 1), ("week", 5), ("month", 21))
)
SPLIT = """CASE WHEN price_date < DATE '2000-01-01' THEN 'train'
              WHEN price_date < DATE '2001-01-01' THEN 'validation' ELSE 'test' END AS split,
         CAST(CASE WHEN price_date < DATE '1997-01-01' THEN 0
              WHEN price_date < DATE '1998-01-01' THEN 1
              WHEN price_date < DATE '1999-01-01' THEN 2
              WHEN price_date < DATE '2000-01-01' THEN 3
              WHEN price_date < DATE '2001-01-01' THEN 4 ELSE 5 END AS INTEGER) AS fold_number"""
SECTOR_CODE = """CAST(CASE sector WHEN 'africa' THEN 1 WHEN 'america' THEN 2 WHEN 'asia' THEN 3
              ELSE 0 END AS INTEGER) AS sector_code"""


def mart_parts(prefix: str = "") -> list[str]:
    return [
        f"""{prefix}labelled AS (
  SELECT *, {TARGETS}, {SPLIT}, {SECTOR_CODE} FROM {prefix}features)""",
        f"""{prefix}mart AS MATERIALIZED (
  SELECT * FROM {prefix}labelled
  WHERE COLUMNS(['next_day_return', 'next_week_return', 'sma_7', 'sma_14', 'sma_30', 'sma_50',
                 'sma_200', 'rsi_14', 'macd_line', 'bb_position', 'atr_14', 'volatility_20'])
        IS NOT NULL)""",
    ]


MART_EXACT = FEATURE_EXACT + " sector_code split fold_number"
MART_ROUNDED = FEATURE_ROUNDED + " next_day_return next_week_return next_month_return"

INDICATORS = STAGING + indicator_parts("staged")
FEATURES = INDICATORS + feature_parts()
MART = FEATURES + mart_parts()


def core() -> dict[str, str]:
    """Staging, indicators, features and mart."""
    bars, close = [BARS], "symbol price_date close_price"
    on_bars = [BARS, *indicator_parts("bars")]
    found = {
        "stage_prices": query(STAGING, f"SELECT {out(STAGED_EXACT)} FROM staged"),
        "stage_dedup_latest": query(
            STAGING, "SELECT symbol, price_date, close_price, extraction_timestamp FROM staged"
        ),
        "price_change": query(
            bars,
            f"SELECT {out(close)}, close_price - {lag('close_price')} AS price_change, "
            "close_price - open_price AS intraday_return FROM bars",
        ),
        "gain_loss": query(on_bars, f"SELECT {out(close)}, gain, loss FROM moves"),
        "lag_returns": query(
            [BARS, f"x AS (SELECT *, {LAGS} FROM bars)"],
            "SELECT "
            + out(close, "lag_1_day_return lag_3_day_return lag_5_day_return lag_7_day_return")
            + " FROM x",
        ),
        "prev_close": query(
            bars,
            f"SELECT {out(close)}, "
            + ", ".join(f"{lag('close_price', n)} AS prev_close_{n}" for n in (1, 3, 5, 7))
            + " FROM bars",
        ),
        "momentum": query(
            [BARS, f"x AS (SELECT *, {MOMENTUM} FROM bars)"],
            f"SELECT {out(close + ' momentum_1', 'momentum_7 momentum_14 momentum_30')} FROM x",
        ),
        "support_resistance": query(
            [BARS, f"x AS (SELECT *, {RANGES} FROM bars)"],
            f"SELECT {out(close + ' support_20 resistance_20 support_50 resistance_50')} FROM x",
        ),
        "price_position": query(
            [BARS, f"x AS (SELECT *, {RANGES} FROM bars)", f"y AS (SELECT *, {POSITIONS} FROM x)"],
            f"SELECT {out(close, 'price_position_20 price_position_50')} FROM y",
        ),
        "stable_sector": query(
            STAGING, "SELECT symbol, arg_min(sector, price_date) AS sector FROM staged GROUP BY 1"
        ),
        "sector_momentum": query(
            [
                BARS,
                f"x AS (SELECT *, first_value(sector) OVER ({SERIES}) AS s, {LAGS} FROM bars)",
                """y AS (SELECT symbol, price_date, s AS sector,
         avg(lag_1_day_return) OVER d AS sector_1_day_return,
         avg(lag_3_day_return) OVER d AS sector_3_day_return,
         avg(lag_7_day_return) OVER d AS sector_7_day_return
  FROM x WINDOW d AS (PARTITION BY s, price_date))""",
            ],
            "SELECT "
            + out(
                "symbol price_date sector",
                "sector_1_day_return sector_3_day_return sector_7_day_return",
            )
            + " FROM y",
        ),
        "targets": query(
            [BARS, f"x AS (SELECT *, {TARGETS} FROM bars)"],
            f"SELECT {out(close, 'next_day_return next_week_return next_month_return')} FROM x",
        ),
        "split_fold": query(bars, f"SELECT symbol, price_date, {SPLIT} FROM bars"),
        "sector_code": query(bars, f"SELECT symbol, price_date, sector, {SECTOR_CODE} FROM bars"),
        "technical_indicators": query(
            INDICATORS, f"SELECT {out(INDICATOR_EXACT, INDICATOR_ROUNDED)} FROM indicators"
        ),
        "ml_features": query(
            FEATURES, f"SELECT {out(FEATURE_EXACT + ' sector', FEATURE_ROUNDED)} FROM features"
        ),
        "training_mart": query(MART, f"SELECT {out(MART_EXACT, MART_ROUNDED)} FROM mart"),
    }
    singles = {
        "sma": "sma_7 sma_14 sma_30 sma_50 sma_200",
        "rsi": "rsi_14",
        "macd_sma": "macd_line macd_signal macd_histogram",
        "bollinger": "bb_middle bb_upper bb_lower bb_position",
        "atr": "atr_14",
        "volume_ratio": "volume_sma_20 volume_ratio",
        "volatility": "volatility_20",
        "daily_return": "daily_return",
    }
    for name, columns in singles.items():
        found[name] = query(on_bars, f"SELECT {out(close, columns)} FROM indicators")
    found["true_range"] = query(on_bars, f"SELECT {out(close)}, tr AS true_range FROM indicators")
    found["obv"] = query(on_bars, f"SELECT {out(close)}, obv FROM indicators")
    found["ma_cross"] = query(
        [*on_bars, *feature_parts()],
        "SELECT "
        + out(
            close + " golden_cross_signal death_cross_signal",
            "ma_crossover_distance short_term_trend",
        )
        + " FROM features",
    )
    return found


def full(function: str, n: int) -> str:
    """A trailing aggregate that is NULL until n rows are there."""
    return (
        f"CASE WHEN count(*) {rows(n)} = {n} THEN {function} {rows(n)} END"
    )


def smooth(value: str, previous: str, span: int) -> str:
    alpha = 2.0 / (span + 1.0)
    return f"({value}) * {alpha!r}::DOUBLE + {previous} * {1.0 - alpha!r}::DOUBLE"


MACD_EMA = [
    f"numbered AS MATERIALIZED (SELECT *, row_number() OVER ({SERIES}) AS i FROM bars)",
    f"""averages AS (
  SELECT symbol, price_date, i, close_price AS ema_12, close_price AS ema_26,
         0.0::DOUBLE AS macd_signal_line
  FROM numbered WHERE i = 1
  UNION ALL
  SELECT n.symbol, n.price_date, n.i,
         {smooth('n.close_price', 'e.ema_12', 12)} AS fast,
         {smooth('n.close_price', 'e.ema_26', 26)} AS slow,
         {smooth('fast - slow', 'e.macd_signal_line', 9)}
  FROM averages e JOIN numbered n ON n.symbol = e.symbol AND n.i = e.i + 1)""",
    "trend AS MATERIALIZED (SELECT *, ema_12 - ema_26 AS macd FROM averages)",
]

STATE = [
    *MACD_EMA,
    f"""steps AS (
  SELECT n.*, t.macd, t.macd_signal_line, close_price - {lag('close_price')} AS change,
         {lag('close_price')} AS prev_close,
         greatest(high_price - low_price, abs(high_price - {lag('close_price')}),
                  abs(low_price - {lag('close_price')})) AS tr,
         greatest(high_price - low_price, high_price - close_price, close_price - low_price)
           AS day_tr
  FROM numbered n JOIN trend t USING (symbol, price_date, i))""",
    f"""wide AS (
  SELECT *, count(*) OVER (PARTITION BY symbol) AS n_bars,
         avg(greatest(coalesce(change, 0), 0)) {rows(14)} AS up,
         avg(greatest(-coalesce(change, 0), 0)) {rows(14)} AS down,
         {full('avg(close_price)', 20)} AS sma_20, {full('avg(close_price)', 50)} AS sma_50,
         {full('stddev_samp(close_price)', 20)} AS dev_20,
         {full('avg(tr)', 14)} AS atr, {full('avg(day_tr)', 14)} AS atr_same_day,
         {lag('macd')} AS prev_macd, {lag('macd_signal_line')} AS prev_line,
         sum(CASE WHEN change > 0 THEN volume WHEN change < 0 THEN -volume ELSE 0 END)
           {rows(19)} / 20 AS obv_slope,
         max(high_price) {rows(30)} AS high_30, min(low_price) {rows(30)} AS low_30
  FROM steps)""",
    """state AS MATERIALIZED (
  SELECT *, sma_20 + 2 * dev_20 AS bb_upper, sma_20 - 2 * dev_20 AS bb_lower,
         CASE WHEN down > 0 THEN 100 - 100 / (1 + up / down) WHEN up > 0 THEN 100 END
           AS rsi_partial,
         CASE WHEN i >= 14 THEN rsi_partial END AS rsi
  FROM wide WHERE i = n_bars)""",
]

OVERVIEW = [
    BARS,
    *STATE,
    """voted AS (
  SELECT *, CASE WHEN rsi < 30 THEN 'BUY' WHEN rsi > 70 THEN 'SELL' ELSE 'NEUTRAL' END
           AS rsi_signal,
         CASE WHEN macd > macd_signal_line AND prev_macd <= prev_line THEN 'BUY'
              WHEN macd < macd_signal_line AND prev_macd >= prev_line THEN 'SELL'
              ELSE 'NEUTRAL' END AS macd_signal,
         CASE WHEN close_price < bb_lower THEN 'BUY' WHEN close_price > bb_upper THEN 'SELL'
              ELSE 'NEUTRAL' END AS bb_signal,
         CASE WHEN close_price > greatest(sma_20, sma_50) AND sma_50 IS NOT NULL THEN 'BULLISH'
              WHEN close_price < least(sma_20, sma_50) AND sma_50 IS NOT NULL THEN 'BEARISH'
              ELSE 'NEUTRAL' END AS trend_signal
  FROM state WHERE n_bars >= 14)""",
    """counted AS (
  SELECT *, len(list_filter([rsi_signal, macd_signal, bb_signal, trend_signal],
                            lambda x: x IN ('BUY', 'BULLISH')))
          - len(list_filter([rsi_signal, macd_signal, bb_signal, trend_signal],
                            lambda x: x IN ('SELL', 'BEARISH'))) AS margin
  FROM voted)""",
    f"""overview AS MATERIALIZED (
  SELECT symbol, s_name AS name, sector, close_price,
         {pct('close_price', 'prev_close')} AS change_pct, rsi, macd, macd_signal_line,
         sma_20, sma_50, atr, bb_lower AS support, bb_upper AS resistance,
         rsi_signal, macd_signal, bb_signal, trend_signal,
         CASE WHEN margin > 1 THEN 'STRONG BUY' WHEN margin > 0 THEN 'BUY'
              WHEN margin < -1 THEN 'STRONG SELL' WHEN margin < 0 THEN 'SELL'
              ELSE 'HOLD' END AS overall_signal,
         price_date AS last_updated
  FROM counted JOIN supplier ON symbol = 'S' || s_suppkey)""",
]
OVERVIEW_EXACT = (
    "symbol name sector close_price rsi_signal macd_signal bb_signal trend_signal "
    "overall_signal last_updated"
)
OVERVIEW_ROUNDED = (
    "change_pct rsi macd macd_signal_line sma_20 sma_50 atr support resistance"
)

FIBONACCI_LEVELS = """(VALUES ('0.0% (Low)', 0.0), ('23.6%', 0.236), ('38.2%', 0.382),
  ('50.0%', 0.5), ('61.8%', 0.618), ('78.6%', 0.786), ('100% (High)', 1.0)) AS v(level, f)"""


def windowed(parts: list[str]) -> list[str]:
    """The same parts over the bars that reports look back on."""
    since = "WHERE price_date >= DATE '2000-11-04'\n  GROUP BY"
    return [p.replace("GROUP BY", since, 1) if p == BARS else p for p in parts]


def target_prices(state: list[str]) -> str:
    return query(
        [
            *state,
            """goals AS (
  SELECT *, close_price AS current_price, high_30 - low_30 AS span,
         CASE WHEN n_bars >= 30 THEN low_30 + span * 0.382::DOUBLE END AS fib_38,
         CASE WHEN n_bars >= 30 THEN low_30 + span * 0.618::DOUBLE END AS fib_61,
         CASE WHEN n_bars >= 30 THEN low_30 + span * 0.786::DOUBLE END AS fib_78,
         CASE WHEN n_bars >= 30 THEN high_30 END AS fib_high,
         CASE WHEN n_bars >= 30 THEN low_30 END AS support,
         CASE WHEN n_bars >= 30 THEN high_30 END AS resistance,
         close_price + 2 * atr_same_day AS upside_target,
         close_price - 2 * atr_same_day AS downside_target
  FROM state)""",
        ],
        "SELECT "
        + out(
            "symbol current_price fib_high support resistance",
            "fib_38 fib_61 fib_78 sma_20 sma_50 upside_target downside_target",
        )
        + " FROM goals",
    )


def analytics() -> dict[str, str]:
    bars, state, close = [BARS], [BARS, *STATE], "symbol price_date close_price"
    flags = """flags AS (
  SELECT symbol, price_date,
         n_bars >= 30 AND coalesce(rsi_partial < 30, false) AS rsi_buy,
         n_bars >= 30 AND coalesce(rsi_partial > 70, false) AS rsi_sell,
         n_bars >= 30 AND coalesce(macd > macd_signal_line AND prev_macd <= prev_line, false)
           AS macd_buy,
         n_bars >= 30 AND coalesce(macd < macd_signal_line AND prev_macd >= prev_line, false)
           AS macd_sell,
         n_bars >= 30 AND coalesce(close_price < bb_lower, false) AS bb_buy,
         n_bars >= 30 AND coalesce(close_price > bb_upper, false) AS bb_sell,
         n_bars >= 30 AND coalesce(obv_slope > 0, false) AS obv_buy,
         n_bars >= 30 AND coalesce(obv_slope < 0, false) AS obv_sell
  FROM state)"""
    votes = """votes AS (
  SELECT symbol,
         CAST(rsi_buy::INT + macd_buy::INT + bb_buy::INT + obv_buy::INT AS INTEGER)
           AS buy_signals,
         CAST(rsi_sell::INT + macd_sell::INT + bb_sell::INT + obv_sell::INT AS INTEGER)
           AS sell_signals
  FROM flags)"""
    ranked = """ranked AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY price_date DESC) AS age,
         lead(close_price) OVER (PARTITION BY symbol ORDER BY price_date DESC) AS before
  FROM bars)"""
    cents = ", ".join(
        f"round_even({c}_price * 100, 0) / 100 AS {c}_price"
        for c in ("open", "high", "low", "close")
    )
    strength = (
        f"x AS (SELECT *, close_price - {lag('close_price')} AS change FROM bars),\n"
        f"y AS (SELECT *, row_number() OVER ({SERIES}) AS i,"
        f" avg(greatest(coalesce(change, 0), 0)) {rows(14)} AS up,"
        f" avg(greatest(-coalesce(change, 0), 0)) {rows(14)} AS down FROM x),\n"
        "z AS (SELECT *, CASE WHEN down > 0 THEN 100 - 100 / (1 + up / down)"
        " WHEN up > 0 THEN 100 END AS rsi FROM y)"
    )
    ranges = (
        "x AS (SELECT *, greatest(high_price - low_price, abs(high_price - close_price),"
        " abs(low_price - close_price)) AS day_tr, greatest(high_price - low_price,"
        f" abs(high_price - {lag('close_price')}), abs(low_price - {lag('close_price')})) AS tr"
        " FROM bars)"
    )
    return {
        "ema": query([BARS, *MACD_EMA], f"SELECT {out(close, 'ema_12 ema_26')} FROM trend "
                     "JOIN bars USING (symbol, price_date)"),
        "macd_ema": query(
            [BARS, *MACD_EMA],
            f"SELECT {out(close, 'macd macd_signal_line')},"
            " round(macd - macd_signal_line, 6) + 0 AS macd_histogram"
            " FROM trend JOIN bars USING (symbol, price_date)",
        ),
        "rsi_partial_window": query([BARS, strength], f"SELECT {out(close, 'rsi')} FROM z"),
        "rsi_full_window": query(
            [BARS, strength],
            f"SELECT {out(close)}, CASE WHEN i >= 14 THEN round(rsi, 6) END AS rsi FROM z",
        ),
        "sma_full_window": query(
            [
                BARS,
                f"x AS (SELECT *, {full('avg(close_price)', 20)} AS sma_20,"
                f" {full('avg(close_price)', 50)} AS sma_50 FROM bars)",
            ],
            f"SELECT {out(close, 'sma_20 sma_50')} FROM x",
        ),
        "bollinger_full_window": query(
            [
                BARS,
                f"x AS (SELECT *, {full('avg(close_price)', 20)} AS bb_middle,"
                f" 2 * {full('stddev_samp(close_price)', 20)} AS band FROM bars)",
                "y AS (SELECT *, bb_middle + band AS bb_upper, bb_middle - band AS bb_lower"
                " FROM x)",
            ],
            f"SELECT {out(close, 'bb_middle bb_upper bb_lower')} FROM y",
        ),
        "atr_variants": query(
            [
                BARS,
                ranges,
                f"y AS (SELECT *, {full('avg(tr)', 14)} AS atr_previous_close,"
                f" {full('avg(day_tr)', 14)} AS atr_same_day FROM x)",
            ],
            f"SELECT {out(close, 'atr_previous_close atr_same_day')} FROM y",
        ),
        "fibonacci": query(
            state,
            "SELECT symbol, level, round(CASE WHEN f = 1 THEN high_30 ELSE"
            " low_30 + (high_30 - low_30) * CAST(f AS DOUBLE) END, 6) AS price"
            f" FROM state CROSS JOIN {FIBONACCI_LEVELS} WHERE n_bars >= 30",
        ),
        "signal_flags": query([*state, flags], "SELECT * FROM flags"),
        "recommendation": query(
            [*state, flags, votes],
            "SELECT *, CASE WHEN buy_signals > sell_signals THEN 'BUY'"
            " WHEN sell_signals > buy_signals THEN 'SELL' ELSE 'HOLD' END AS overall FROM votes",
        ),
        "target_prices": target_prices(state),
        "target_prices_window": target_prices(windowed(state)),
        "latest_change": query(
            [
                *bars,
                ranked,
                f"x AS (SELECT *, close_price - before AS price_change,"
                f" {pct('close_price', 'before')} AS price_change_pct FROM ranked WHERE age = 1)",
            ],
            f"SELECT {out(close + ' price_change', 'price_change_pct')} FROM x",
        ),
        "recent_bars": query(
            [*bars, ranked],
            f"SELECT symbol, price_date, {cents}, volume FROM ranked WHERE age <= 10",
        ),
        "signal_overview": query(
            OVERVIEW, f"SELECT {out(OVERVIEW_EXACT, OVERVIEW_ROUNDED)} FROM overview"
        ),
        "signal_overview_window": query(
            windowed(OVERVIEW), f"SELECT {out(OVERVIEW_EXACT, OVERVIEW_ROUNDED)} FROM overview"
        ),
        "market_summary": query(
            OVERVIEW,
            "SELECT count(*) FILTER (overall_signal IN ('BUY', 'STRONG BUY')) AS buy_signals,"
            " count(*) FILTER (overall_signal IN ('SELL', 'STRONG SELL')) AS sell_signals,"
            " count(*) FILTER (overall_signal = 'HOLD') AS hold_signals,"
            " count(DISTINCT sector) AS sectors FROM overview",
        ),
        "sector_signal_pivot": query(
            OVERVIEW,
            "SELECT sector, "
            + ", ".join(
                f"count(*) FILTER (overall_signal = '{n}') AS {n.lower().replace(' ', '_')}"
                for n in ("STRONG BUY", "BUY", "HOLD", "SELL", "STRONG SELL")
            )
            + " FROM overview GROUP BY sector",
        ),
        "signal_distribution": query(
            OVERVIEW, "SELECT overall_signal, count(*) AS symbols FROM overview GROUP BY 1"
        ),
        "signal_codes": query(
            OVERVIEW,
            "SELECT symbol, "
            + ", ".join(
                f"CAST(CASE WHEN {c}_signal IN ('BUY', 'BULLISH') THEN 1"
                f" WHEN {c}_signal IN ('SELL', 'BEARISH') THEN -1 ELSE 0 END AS INTEGER)"
                f" AS {c}_code"
                for c in ("rsi", "macd", "bb", "trend")
            )
            + " FROM overview",
        ),
        "symbol_detail": query(
            OVERVIEW,
            f"SELECT {out(OVERVIEW_EXACT, OVERVIEW_ROUNDED)} FROM overview WHERE symbol = 'S7'",
        ),
        "strength_by_price": query(
            OVERVIEW,
            f"SELECT {out('symbol close_price overall_signal', 'rsi atr')} FROM overview",
        ),
    }


RAW_COLUMNS = (
    "date symbol sector open_price high_price low_price close_price volume extraction_timestamp"
)
SCAN_COLUMNS = "date symbol sector open_price high_price low_price close_price volume"
CUT = "DATE '2001-01-01'"
AS_OF = "DATE '2001-11-04'"
LISTED = """listed(symbol, sector) AS (VALUES ('S0', 'africa'), ('S1', 'africa'),
  ('S2', 'africa'), ('S3', 'asia'), ('S4', 'asia'), ('S5', 'europe'), ('S6', 'europe'),
  ('S7', 'europe'), ('S8', 'europe'))"""
DELIVERED = """delivered AS (
  SELECT *, CASE WHEN day(price_date) = 20 AND sector = 'asia' THEN 'n/a'
                 ELSE CAST(price_date AS VARCHAR) || 'T00:00:00+10:00' END AS d_date,
         CASE WHEN day(price_date) = 21 AND sector = 'africa' THEN NULL ELSE symbol END AS d_symbol,
         day(price_date) = 22 AND sector = 'europe' AS no_close
  FROM bars)"""


def ingest() -> dict[str, str]:
    raw = [BARS, RAW]
    return {
        "price_scan": query(
            raw, f"SELECT {out(SCAN_COLUMNS)} FROM raw WHERE date >= {AS_OF} - INTERVAL 365 DAY"
        ),
        "symbol_scan": query(
            raw,
            f"SELECT {out(SCAN_COLUMNS)} FROM raw"
            f" WHERE date >= {AS_OF} - INTERVAL 365 DAY AND symbol = 'S7'",
        ),
        "training_scan": query(
            MART,
            f"SELECT {out(MART_EXACT, MART_ROUNDED)} FROM mart"
            f" WHERE price_date >= {AS_OF} - INTERVAL 1095 DAY",
        ),
        "full_refresh": query(
            raw,
            f"SELECT {out(RAW_COLUMNS)} FROM raw"
            f" WHERE date >= {AS_OF} - INTERVAL 1825 DAY AND date < {AS_OF}",
        ),
        "incremental_window": query(
            raw,
            f"SELECT {out(RAW_COLUMNS)} FROM raw"
            f" WHERE date >= {CUT} - INTERVAL 1 DAY AND date < {AS_OF}",
        ),
        "merge_upsert": query(
            raw,
            f"SELECT {out(RAW_COLUMNS)} FROM raw WHERE date < {AS_OF}"
            " QUALIFY row_number() OVER (PARTITION BY date, symbol"
            " ORDER BY extraction_timestamp DESC) = 1",
        ),
        "merge_undated": query(
            raw, f"SELECT DISTINCT {out(RAW_COLUMNS)} FROM raw WHERE date IS NULL"
        ),
        "upsert_by_key": query(
            STAGING,
            "SELECT * REPLACE (CAST(CASE WHEN year(price_date) >= 2000 THEN volume * 2"
            " ELSE volume END AS BIGINT) AS volume) FROM staged",
        ),
        "sector_dim": query(
            [LISTED],
            "SELECT symbol, sector, s_name FROM listed JOIN supplier ON symbol = 'S' || s_suppkey",
        ),
        "sector_tag": query(
            [BARS, LISTED],
            "SELECT b.symbol, price_date, coalesce(l.sector, 'unknown') AS sector"
            " FROM bars b LEFT JOIN listed l ON b.symbol = l.symbol",
        ),
        "normalise_records": query(
            [BARS, LISTED, DELIVERED],
            "SELECT CAST(price_date AS TIMESTAMP) AS date, d.symbol,"
            " coalesce(l.sector, 'unknown') AS sector, open_price, high_price, low_price,"
            " close_price, volume, '2002-01-02T00:00:00' AS extraction_timestamp"
            " FROM delivered d LEFT JOIN listed l ON d.symbol = l.symbol"
            " WHERE d_date <> 'n/a' AND d_symbol IS NOT NULL AND NOT no_close",
        ),
        "record_rejects": query(
            [BARS, DELIVERED],
            "SELECT d_date AS delivered_date, d_symbol AS delivered_symbol,"
            " CASE WHEN d_symbol IS NULL THEN 'missing symbol' WHEN d_date = 'n/a'"
            " THEN 'invalid date' ELSE 'invalid close_price' END AS reason FROM delivered"
            " WHERE d_date = 'n/a' OR d_symbol IS NULL OR no_close",
        ),
        "raw_info": query(
            raw,
            "SELECT count(*) AS records, min(date) AS min_date, max(date) AS max_date,"
            " count(DISTINCT symbol) AS symbols FROM raw",
        ),
        "mart_info": query(
            MART,
            "SELECT count(*) AS records, min(price_date) AS min_date,"
            " max(price_date) AS max_date, count(DISTINCT symbol) AS symbols FROM mart",
        ),
        "watermark_dates": query(
            STAGING,
            "SELECT max(price_date) AS watermark,"
            " CAST(max(price_date) - INTERVAL 200 DAY AS DATE) AS indicators_from,"
            " CAST(max(price_date) - INTERVAL 7 DAY AS DATE) AS features_from,"
            " CAST(max(price_date) - INTERVAL 21 DAY AS DATE) AS mart_from FROM staged",
        ),
        "event_indicators": query(
            [
                """ticks AS (
  SELECT event_type AS symbol, CAST(ts AS DATE) AS price_date, 'unknown' AS sector,
         arg_min(value, struct_pack(t := ts, e := event_id)) AS open_price,
         max(value) AS high_price, min(value) AS low_price,
         arg_max(value, struct_pack(t := ts, e := event_id)) AS close_price, count(*) AS volume
  FROM events GROUP BY 1, 2)""",
                *indicator_parts("ticks"),
            ],
            f"SELECT {out(INDICATOR_EXACT, INDICATOR_ROUNDED)} FROM indicators",
        ),
        "stream_ingest": query(STAGING, f"SELECT {out(STAGED_EXACT)} FROM staged"),
        "stream_dedup": query(STAGING, "SELECT symbol, price_date FROM staged"),
        "stream_late": query(
            [
                BARS,
                RAW,
                """arrived AS (
  SELECT *, least(CASE WHEN year(date) <= 1997 THEN 0 WHEN year(date) <= 1999 THEN 1 ELSE 2 END
                  + CASE extraction_timestamp[1:10] WHEN '2002-01-03' THEN 1
                         WHEN '2002-01-01' THEN 2 ELSE 0 END, 3) AS arrival
  FROM raw),
newest AS (SELECT symbol, arrival, max(date) AS day FROM arrived GROUP BY ALL),
marks AS (SELECT a.arrival AS arrival, n.symbol AS symbol, max(day) AS mark
          FROM range(4) AS a(arrival) JOIN newest n ON n.arrival < a.arrival GROUP BY ALL)""",
            ],
            "SELECT date, symbol, close_price, extraction_timestamp,"
            " coalesce(date < mark - INTERVAL 30 DAY, false) AS late"
            " FROM arrived LEFT JOIN marks USING (symbol, arrival)",
        ),
        "file_rejects": query(
            [BARS, RAW],
            "SELECT coalesce(CAST(year(date) AS VARCHAR), 'none') AS file, count(*) AS rows,"
            " NULL AS reason FROM raw GROUP BY 1"
            " UNION ALL SELECT 'broken.parquet', 0, 'no readable rows'",
        ),
    }


def incremental_runs() -> dict[str, str]:
    before = f"before AS MATERIALIZED (SELECT * FROM staged WHERE price_date <= {CUT})"
    last = "(SELECT max(price_date) FROM before)"
    shown = out(INDICATOR_EXACT, INDICATOR_ROUNDED)
    full = query(INDICATORS, f"SELECT {shown} FROM indicators")
    features = out(FEATURE_EXACT + " sector", FEATURE_ROUNDED)
    labelled = out(MART_EXACT, MART_ROUNDED)
    return {
        "ti_incremental_calendar": query(
            [
                *STAGING,
                before,
                *indicator_parts("before", "old_"),
                f"redone AS MATERIALIZED (SELECT * FROM staged"
                f" WHERE price_date >= {last} - INTERVAL 200 DAY)",
                *indicator_parts("redone", "new_"),
            ],
            f"SELECT {shown} FROM new_indicators UNION ALL SELECT {shown} FROM old_indicators"
            " WHERE (symbol, price_date) NOT IN (SELECT (symbol, price_date) FROM redone)",
        ),
        "ti_incremental_rows": full,
        "ti_late_corrections": full,
        "features_incremental": query(
            [*FEATURES, before], f"SELECT {features} FROM features WHERE price_date > {last}"
        ),
        "features_incremental_calendar": query(
            [
                *INDICATORS,
                before,
                f"near_indicators AS MATERIALIZED (SELECT * FROM indicators"
                f" WHERE price_date >= {last} - INTERVAL 7 DAY)",
                *feature_parts("near_"),
            ],
            f"SELECT {features} FROM near_features WHERE price_date > {last}",
        ),
        "mart_incremental": query(MART, f"SELECT {labelled} FROM mart"),
        "warehouse_refresh": query(MART, f"SELECT {labelled} FROM mart"),
        "warehouse_recovery": query(MART, f"SELECT {labelled} FROM mart"),
        "warehouse_late_recovery": query(MART, f"SELECT {labelled} FROM mart"),
        "mart_incremental_calendar": query(
            [
                *FEATURES,
                f"old_features AS MATERIALIZED (SELECT * FROM features WHERE price_date <= {CUT})",
                *mart_parts("old_"),
                "near_features AS MATERIALIZED (SELECT * FROM features WHERE price_date >="
                " (SELECT max(price_date) FROM old_mart) - INTERVAL 21 DAY)",
                *mart_parts("near_"),
            ],
            f"SELECT {labelled} FROM old_mart UNION ALL SELECT {labelled} FROM near_mart"
            " WHERE price_date > (SELECT max(price_date) FROM old_mart)",
        ),
    }


FEATURE_VECTOR = (
    "daily_range sma_7 sma_14 sma_30 sma_50 sma_200 rsi_14 macd_line macd_signal macd_histogram "
    "bb_position atr_14 volume_ratio obv volatility_20 lag_1_day_return lag_3_day_return "
    "lag_5_day_return lag_7_day_return momentum_7 momentum_14 momentum_30 momentum_1 "
    "ma_crossover_distance short_term_trend price_position_20 price_position_50 sector_code"
)


def checks_and_models() -> dict[str, str]:
    def failing(table: str, relation: str, column: str, check: str, bad: str) -> str:
        return (
            f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{check}' AS check_name,"
            f" count(*) FILTER ({bad}) AS failing_rows FROM {relation}"
        )

    prices = "open_price high_price low_price close_price volume".split()
    sectors = "('africa', 'america', 'asia')"

    def null_checks(table: str, relation: str, columns: list[str]) -> list[str]:
        return [failing(table, relation, c, "not_null", f"{c} IS NULL") for c in columns]

    staged = [
        *null_checks("staged_prices", "staged", ["price_date", "symbol", "sector", *prices]),
        failing("staged_prices", "staged", "sector", "accepted_values", f"sector NOT IN {sectors}"),
        *[
            failing("staged_prices", "staged", c, "not_negative", f"{c} < 0")
            for c in [*prices, "daily_range"]
        ],
    ]

    def repeated(key: str, where: str) -> str:
        return (
            f"SELECT 'staged_prices', '{key}', 'unique', count(*) FROM"
            f" (SELECT 1 FROM staged {where} GROUP BY {key} HAVING count(*) > 1)"
        )

    report = [
        *null_checks("raw_prices", "raw", ["date", "symbol", "sector", *prices]),
        failing(
            "raw_prices", "raw", "sector", "accepted_values",
            "sector NOT IN ('AFRICA', 'AMERICA', 'ASIA')",
        ),
        *staged,
        repeated("symbol, price_date", ""),
        *null_checks(
            "technical_indicators", "indicators", ["symbol", "price_date", "close_price"]
        ),
        *null_checks("ml_features", "features", ["symbol", "price_date"]),
        *null_checks(
            "training_mart", "mart",
            "symbol price_date close_price next_day_return next_week_return split "
            "fold_number".split(),
        ),
        failing(
            "training_mart", "mart", "split", "accepted_values",
            "split NOT IN ('train', 'validation', 'test')",
        ),
    ]
    flagged = "SELECT *, failing_rows = 0 AS passed FROM ({})"
    union = "\nUNION ALL "
    complete = (
        "complete AS MATERIALIZED (SELECT *, CAST(CASE WHEN next_day_return > 1.0 THEN 1 ELSE 0 END"
        " AS INTEGER) AS label, row_number() OVER (ORDER BY symbol, price_date) - 1 AS position"
        " FROM mart WHERE COLUMNS(["
        + ", ".join(f"'{c}'" for c in FEATURE_VECTOR.split())
        + "]) IS NOT NULL)"
    )
    sized = "sized AS (SELECT count(*) AS n FROM complete)"
    folds = """folds AS (
  SELECT CAST(fold AS INTEGER) AS fold, fold * (n // 6) AS train_end,
         (fold + 1) * (n // 6) AS test_end
  FROM sized, range(1, 6) AS f(fold))"""
    by_fold = """by_fold AS (
  SELECT fold, count(*) AS n, count(*) FILTER (label = (rsi_14 < 30)::INT) AS correct,
         count(*) FILTER (label = 1 AND rsi_14 < 30) AS hits,
         count(*) FILTER (rsi_14 < 30) AS guessed, count(*) FILTER (label = 1) AS actual
  FROM complete JOIN folds ON position >= train_end AND position < test_end GROUP BY fold),
fold_metrics AS (
  SELECT fold, correct / n AS accuracy, coalesce(hits / nullif(guessed, 0), 0) AS precision,
         coalesce(hits / nullif(actual, 0), 0) AS recall,
         coalesce(2 * hits / nullif(guessed + actual, 0), 0) AS f1 FROM by_fold)"""
    names = ["accuracy", "precision", "recall", "f1"]
    return {
        "quality_inline": query(STAGING, flagged.format(union.join(staged))),
        "schema_drift": query(
            STAGING,
            "SELECT change, refused, (CASE WHEN refused THEN 0 ELSE n END)::BIGINT AS rows FROM (VALUES"
            " ('unchanged', false), ('other order', false), ('column missing', true),"
            " ('column added', true), ('type changed', true), ('column renamed', true))"
            " AS c(change, refused), (SELECT count(*) AS n FROM staged)",
        ),
        "cv_rule_metrics": query(
            [*MART, complete, sized, folds, by_fold],
            f"SELECT fold, {', '.join(f'round({c}, 6) AS {c}' for c in names)} FROM fold_metrics",
        ),
        "cv_rule_averages": query(
            [*MART, complete, sized, folds, by_fold],
            f"SELECT {', '.join(f'round(avg({c}), 6) AS {c}' for c in names)} FROM fold_metrics",
        ),
        "rule_prediction_counts": query(
            MART,
            "SELECT (rsi_14 < 30)::INT AS prediction, count(*) AS rows FROM mart"
            f" WHERE price_date BETWEEN {CUT} - INTERVAL 365 DAY AND {CUT} GROUP BY 1",
        ),
        "separable_models": query(
            [*MART, complete],
            "SELECT CAST(sector_code >= 2 AS INTEGER) AS label,"
            " CAST(sector_code >= 2 AS INTEGER) AS prediction, count(*) AS rows, model_type,"
            f" CAST(1 AS DOUBLE) AS accuracy, {AS_OF} AS trained_on, 'sector_code' AS top_feature"
            " FROM complete, (VALUES ('random_forest'), ('gradient_boosting')) AS m(model_type)"
            " GROUP BY sector_code >= 2, model_type",
        ),
        "forecast_days": query(
            [BARS],
            "SELECT symbol, price_date AS ds, close_price, true AS inside FROM bars"
            " WHERE symbol IN (SELECT symbol FROM bars GROUP BY 1 HAVING count(close_price) >= 60)"
            " UNION ALL SELECT symbol, CAST(last + CAST(ahead AS INTEGER) AS DATE), NULL, true"
            " FROM (SELECT symbol, max(price_date) AS last FROM bars GROUP BY 1"
            " HAVING count(close_price) >= 60),"
            " range(1, 31) AS h(ahead)",
        ),
        "forecast_checks": query(
            [BARS],
            "SELECT symbol, arg_max(close_price, price_date) AS current_price,"
            " true AS change_agrees, true AS inside FROM bars GROUP BY 1"
            " HAVING count(close_price) >= 60",
        ),
        "quality_report": query(MART, flagged.format(union.join(report))),
        "quality_unique_where": query(
            STAGING,
            flagged.format(
                union.join([*staged, repeated("price_date", "WHERE sector = 'europe'")])
            ),
        ),
        "binary_target": query([*MART, complete], "SELECT symbol, price_date, label FROM complete"),
        "holdout_split": query(
            [*MART, complete, sized],
            "SELECT symbol, price_date, position,"
            " CASE WHEN position < n - (n * 2 + 9) // 10 THEN 'train' ELSE 'test' END AS role"
            " FROM complete, sized",
        ),
        "holdout_by_date": query(
            [*MART, complete],
            "SELECT symbol, price_date, label, split AS role FROM complete"
            " WHERE split <> 'validation'",
        ),
        "cv_folds": query(
            [*MART, complete, sized, folds],
            "SELECT fold, CASE WHEN position < train_end THEN 'train' ELSE 'test' END AS role,"
            " count(*) AS rows, min(position) AS first_position, max(position) AS last_position,"
            " min(symbol) AS first_symbol, max(symbol) AS last_symbol"
            " FROM complete JOIN folds ON position < test_end GROUP BY 1, 2",
        ),
        "classification_metrics": query(
            [
                *MART,
                complete,
                """counted AS (
  SELECT count(*) AS n, count(*) FILTER (label = (rsi_14 < 30)::INT) AS correct,
         count(*) FILTER (label = 1 AND rsi_14 < 30) AS hits,
         count(*) FILTER (rsi_14 < 30) AS guessed, count(*) FILTER (label = 1) AS actual
  FROM complete)""",
            ],
            "SELECT round(correct / n, 6) AS accuracy,"
            " round(coalesce(hits / nullif(guessed, 0), 0), 6) AS precision,"
            " round(coalesce(hits / nullif(actual, 0), 0), 6) AS recall,"
            " round(coalesce(2 * hits / nullif(guessed + actual, 0), 0), 6) AS f1 FROM counted",
        ),
    }


def all_oracles() -> dict[str, str]:
    return {
        **core(),
        **analytics(),
        **ingest(),
        **incremental_runs(),
        **checks_and_models(),
    }
