"""The queries as plain SQL for DuckDB, written from their definitions.

Series operators use one window per cell here: this side only checks values.
"""

from __future__ import annotations

KPIS = ["throughput", "latency", "jitter", "packet_loss", "cell_load"]
UNITS = dict(zip(KPIS, ["Mbit/s", "ms", "ms", "%", "%"]))
BOUNDS = {
    "throughput": (107, 77, False),
    "latency": (20, 50, True),
    "jitter": (4.0, 5.1, True),
    "packet_loss": (0.5, 0.9, True),
    "cell_load": (70, 90, True),
}
HORIZONS = [5, 15, 30]
HOUR, TEN = "1 HOUR", "10 MINUTE"
ORACLES: dict[str, str] = {}
# Lifts exact ties off the rounding boundary, where the last bit of a sum would decide.
NUDGE = 1.7e-8


def each(template: str, sep: str = ", ") -> str:
    return sep.join(template.format(k=k) for k in KPIS)


def d(value) -> str:
    return f"CAST({value} AS DOUBLE)"


def add(name: str, sql: str, columns: str, digits: int = 6) -> None:
    """Register ``sql`` with typed output: ``name:kind`` with kind d, l, s, b or t."""
    kinds = {"l": "BIGINT", "s": "VARCHAR", "b": "BOOLEAN", "t": "TIMESTAMP"}
    out = []
    for item in columns.split():
        column, kind = item.split(":")
        if kind == "d":
            out.append(f"round(CAST({column} AS DOUBLE) + CAST({NUDGE} AS DOUBLE), {digits}) + CAST(0 AS DOUBLE) AS {column}")
        else:
            out.append(f"CAST({column} AS {kinds[kind]}) AS {column}")
    ORACLES[name] = f"SELECT {', '.join(out)} FROM ({sql}) AS result"


# -- shared steps -----------------------------------------------------------

RAW = """raw AS (
  SELECT ts, 'cell_' || lpad(CAST(user_id % 5 + 1 AS VARCHAR), 3, '0') AS cell_id,
    value - 5 AS throughput, CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS latency,
    CAST(user_id % 13 AS DOUBLE) / 2 AS jitter, value / 100 AS packet_loss, value AS cell_load,
    event_type = 'error' AND value > 100 AS is_anomaly,
    CASE WHEN event_type = 'view' THEN 'stream' ELSE 'batch' END AS source, ts AS ingested_at
  FROM events),
copies AS (
  SELECT * FROM raw UNION ALL
  SELECT ts, cell_id, throughput + 1, latency, jitter, packet_loss, cell_load, is_anomaly, source,
    ingested_at + INTERVAL 1 MINUTE FROM raw)"""

CLIP = ", ".join(
    f"CASE WHEN {k} IS NULL THEN NULL ELSE "
    + (f"least(greatest({k}, 0), 100)" if k in ("packet_loss", "cell_load") else f"greatest({k}, 0)")
    + f" END AS {k}"
    for k in KPIS
)
DEDUPE = (
    "SELECT * FROM {src} QUALIFY row_number() OVER (PARTITION BY cell_id, ts "
    "ORDER BY ingested_at, source, throughput, latency, jitter, packet_loss, cell_load) = 1"
)


def cleaning(step: str, src: str = "raw") -> str:
    """CTEs from RAW to CLEAN on a grid of ``step``."""
    near = ", ".join(
        f"last_value(CASE WHEN {k} IS NOT NULL THEN i END IGNORE NULLS) OVER past AS pi_{k}, "
        f"last_value({k} IGNORE NULLS) OVER past AS pv_{k}, "
        f"first_value(CASE WHEN {k} IS NOT NULL THEN i END IGNORE NULLS) OVER future AS ni_{k}, "
        f"first_value({k} IGNORE NULLS) OVER future AS nv_{k}"
        for k in KPIS
    )
    fill = each(
        "CASE WHEN {k} IS NOT NULL THEN {k} "
        "WHEN i - pi_{k} <= 3 OR ni_{k} - i <= 3 THEN CASE "
        "WHEN pi_{k} IS NULL THEN nv_{k} WHEN ni_{k} IS NULL THEN pv_{k} "
        "ELSE pv_{k} + (nv_{k} - pv_{k}) / (ni_{k} - pi_{k}) * (i - pi_{k}) END END AS {k}"
    )
    return f"""{RAW},
first_rows AS ({DEDUPE.format(src=src)}),
clipped AS (SELECT ts, cell_id, is_anomaly, {CLIP} FROM first_rows),
bins AS (SELECT cell_id, time_bucket(INTERVAL {step}, ts) AS ts, {each('avg({k}) AS {k}')} FROM clipped GROUP BY 1, 2),
truth AS (SELECT cell_id, time_bucket(INTERVAL {step}, ts) AS ts, bool_or(is_anomaly) AS is_anomaly FROM raw GROUP BY 1, 2),
span AS (SELECT cell_id, min(ts) AS a, max(ts) AS b FROM bins GROUP BY 1),
steps AS (SELECT cell_id, unnest(generate_series(a, b, INTERVAL {step})) AS ts FROM span),
numbered AS (SELECT *, row_number() OVER (PARTITION BY cell_id ORDER BY ts) AS i FROM steps),
grid AS (SELECT n.cell_id, n.ts, n.i, {each('b.{k}')} FROM numbered n LEFT JOIN bins b ON b.cell_id = n.cell_id AND b.ts = n.ts),
labels AS (SELECT n.cell_id, n.ts, coalesce(t.is_anomaly, false) AS is_anomaly
  FROM numbered n LEFT JOIN truth t ON t.cell_id = n.cell_id AND t.ts = n.ts),
near AS (SELECT *, {near} FROM grid WINDOW
  past AS (PARTITION BY cell_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  future AS (PARTITION BY cell_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
filled AS (SELECT cell_id, ts, {fill}, throughput IS NULL AS is_missing FROM near),
clean AS (SELECT * FROM filled WHERE throughput IS NOT NULL AND latency IS NOT NULL)"""


def featuring(step: str) -> str:
    """CTEs from CLEAN to PREPARED with truth, split and targets."""
    count, unit = step.split()

    def frame(n: int) -> str:
        return (
            f"(PARTITION BY cell_id ORDER BY ts RANGE BETWEEN INTERVAL {(n - 1) * int(count)} {unit} "
            "PRECEDING AND CURRENT ROW)"
        )

    wide = []
    for k in KPIS:
        wide += [f"avg({k}) OVER w{n} AS {k}_mean_{n}m" for n in (5, 15, 30)]
        wide.append(f"stddev_samp({k}) OVER w15 AS {k}_std_15m")
        wide += [f"lag({k}, {n}) OVER wc AS {k}_lag_{n}" for n in (1, 5, 10)]
        wide.append(f"avg({k}) OVER w60 AS {k}_hour_mean")
    names = [w.rsplit(" AS ", 1)[1] for w in wide] + ["cell_load_hour_max"]
    present = " AND ".join(f"{n} IS NOT NULL" for n in names)
    return f"""rolled AS (SELECT cell_id, ts, {each('{k}')}, {', '.join(wide)}, max(cell_load) OVER w60 AS cell_load_hour_max,
    hour(ts) AS hour_of_day, isodow(ts) - 1 AS day_of_week FROM clean
  WINDOW w5 AS {frame(5)}, w15 AS {frame(15)}, w30 AS {frame(30)}, w60 AS {frame(60)},
    wc AS (PARTITION BY cell_id ORDER BY ts)),
features AS (SELECT * FROM rolled WHERE {present}),
prepared AS (SELECT f.*, sin(2 * pi() * hour_of_day / 24) AS hour_sin, cos(2 * pi() * hour_of_day / 24) AS hour_cos,
    sin(2 * pi() * day_of_week / 7) AS dow_sin, cos(2 * pi() * day_of_week / 7) AS dow_cos,
    {each('{k}_mean_5m - {k}_mean_30m AS {k}_trend_5m_30m')},
    {each('coalesce({k}_mean_5m / nullif({k}_hour_mean, 0), 1) AS {k}_ratio_to_hour')} FROM features f),
labelled AS (SELECT p.*, coalesce(l.is_anomaly, false) AS is_anomaly FROM prepared p
  LEFT JOIN labels l ON l.cell_id = p.cell_id AND l.ts = p.ts)"""


def splitting(src: str, out: str) -> str:
    return f"""{out} AS (SELECT * EXCLUDE (pos, n) FROM (
  SELECT *, CASE WHEN pos < floor(n * {d(0.6)}) THEN 'train'
    WHEN pos >= floor(n * {d(0.6)}) + 60 AND pos < floor(n * ({d(0.6)} + {d(0.2)})) THEN 'val'
    WHEN pos >= floor(n * ({d(0.6)} + {d(0.2)})) + 60 THEN 'test' END AS segment
  FROM (SELECT *, row_number() OVER (PARTITION BY cell_id ORDER BY ts) - 1 AS pos,
    count(*) OVER (PARTITION BY cell_id) AS n FROM {src})) WHERE segment IS NOT NULL)"""


C = "WITH " + cleaning(HOUR)
C10 = "WITH " + cleaning(TEN)
P = C + ",\n" + featuring(HOUR)
S = P + ",\n" + splitting("labelled", "segments")
TARGETS = [f"{k}_target_{h}m" for k in KPIS for h in HORIZONS]
_lead = " ".join(
    f"LEFT JOIN clean c{h} ON c{h}.cell_id = p.cell_id AND c{h}.ts = p.ts + INTERVAL {h} HOUR" for h in HORIZONS
)
T = (
    P
    + f",\ntargeted AS (SELECT p.*, {', '.join(f'c{h}.{k} AS {k}_target_{h}m' for k in KPIS for h in HORIZONS)} FROM prepared p {_lead}),\n"
    + f"complete AS (SELECT * FROM targeted WHERE {' AND '.join(t + ' IS NOT NULL' for t in TARGETS)}),\n"
    + splitting("complete", "supervised")
)
SCORES = (
    S
    + ",\nscores AS (SELECT 'seuils_contrat' AS detector, segment, ts, cell_id, is_anomaly, CAST(greatest("
    + ", ".join(
        (f"CASE WHEN {k}_mean_5m > {b} THEN 2 WHEN {k}_mean_5m > {g} THEN 1 ELSE 0 END" if up
         else f"CASE WHEN {k}_mean_5m < {b} THEN 2 WHEN {k}_mean_5m < {g} THEN 1 ELSE 0 END")
        for k, (g, b, up) in BOUNDS.items()
    )
    + ") AS DOUBLE) AS score FROM segments UNION ALL "
    "SELECT 'ratio_latence', segment, ts, cell_id, is_anomaly, round(latency_ratio_to_hour, 6) FROM segments)"
)
ALERTS = (
    P
    + ",\nrated AS (SELECT *, round(latency_ratio_to_hour, 6) AS score FROM labelled),\n"
    + "alerts AS (SELECT *, score >= (SELECT quantile_cont(score, 0.9) FROM rated) AS is_anomaly_pred FROM rated)"
)


def runs(src: str, flag: str, out: str) -> str:
    """Number the runs of a flag per cell."""
    return (
        f"{out} AS (SELECT *, pos - row_number() OVER (PARTITION BY cell_id ORDER BY ts) AS run FROM "
        f"(SELECT *, row_number() OVER (PARTITION BY cell_id ORDER BY ts) AS pos FROM {src}) WHERE {flag})"
    )


def rank_of(k: str, column: str) -> str:
    g, b, up = BOUNDS[k]
    op = ">" if up else "<"
    return f"CASE WHEN {column} IS NULL THEN 0 WHEN {column} {op} {b} THEN 2 WHEN {column} {op} {g} THEN 1 ELSE 0 END"


def worst(suffix: str = "") -> str:
    return "greatest(" + ", ".join(rank_of(k, k + suffix) for k in KPIS) + ")"


def label_of(rank: str) -> str:
    return f"CASE {rank} WHEN 0 THEN 'bon' WHEN 1 THEN 'dégradé' ELSE 'critique' END"


def blame(src: str, keys: str, suffix: str = "") -> str:
    """Rows of ``src`` with ``cause_kpi`` and ``cause_excess``."""
    parts = []
    for place, k in enumerate(KPIS):
        g, _, up = BOUNDS[k]
        c = k + suffix
        away = f"({c} - {g}) / {d(g)}" if up else f"({g} - {c}) / {d(g)}"
        parts.append(
            f"SELECT {keys}, {rank_of(k, c)} AS r, {away} AS e, {place} AS place, '{k}' AS kpi FROM {src}"
        )
    top = (
        f"SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY r DESC, e DESC NULLS LAST, place) AS rn "
        f"FROM ({' UNION ALL '.join(parts)})"
    )
    return (
        f"SELECT {keys}, CASE WHEN r > 0 THEN kpi ELSE 'aucun' END AS cause_kpi, "
        f"CASE WHEN r > 0 THEN e END AS cause_excess FROM ({top}) WHERE rn = 1"
    )


KPI_D = each("{k}:d", " ")
RAW_COLUMNS = f"ts:t cell_id:s {KPI_D} is_anomaly:b source:s ingested_at:t"
CLEAN_COLUMNS = f"cell_id:s ts:t {KPI_D} is_missing:b"
R = "WITH " + RAW

# -- sources and sinks

add("csv_scan", f"{R} SELECT ts, cell_id, {each('{k}')}, is_anomaly, 'batch' AS source FROM raw",
    f"ts:t cell_id:s {KPI_D} is_anomaly:b source:s")
add("raw_append", f"{R} SELECT * FROM raw", RAW_COLUMNS)
add("scan_since", f"{C} SELECT * FROM clean WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'", f"ts:t cell_id:s {KPI_D}")
add("upsert", f"{R} SELECT * FROM copies WHERE ingested_at > ts", RAW_COLUMNS)
add("table_upsert", f"{R} SELECT * FROM copies WHERE (source = 'stream') = (ingested_at > ts)", RAW_COLUMNS)
ORACLES["snapshot_upsert"] = ORACLES["table_upsert"]
add("snapshot_version", f"{R} SELECT * FROM raw WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-06 00:00:00'", RAW_COLUMNS)
add("store_features", f"{P} SELECT * FROM features WHERE ts >= TIMESTAMP '2024-01-05 00:00:00'",
    "cell_id:s ts:t throughput_mean_5m:d latency_lag_10:d jitter_std_15m:d hour_of_day:l")
add("store_labels", f"{C} SELECT * FROM labels WHERE cell_id = 'cell_002'", "ts:t cell_id:s is_anomaly:b")
SAMPLE = "ts >= (SELECT max(ts) FROM clean) - INTERVAL 3 DAY AND {t}cell_id IN (SELECT DISTINCT cell_id FROM clean ORDER BY 1 LIMIT 2)"
add("sample_kpi", f"{C} SELECT * FROM clean WHERE {SAMPLE.format(t='')}", CLEAN_COLUMNS)
add("sample_labels", f"{C} SELECT c.*, coalesce(l.is_anomaly, false) AS is_anomaly FROM clean c LEFT JOIN labels l "
    f"ON l.cell_id = c.cell_id AND l.ts = c.ts WHERE c.{SAMPLE.format(t='c.')}", CLEAN_COLUMNS + " is_anomaly:b")
add("sample_features", f"{P} SELECT * FROM features WHERE {SAMPLE.format(t='')}",
    "cell_id:s ts:t throughput_mean_5m:d latency_lag_10:d cell_load_hour_max:d")

# -- cleaning

add("clip_bounds", f"{R} SELECT ts, cell_id, {CLIP} FROM raw", f"ts:t cell_id:s {KPI_D}")
add("dedupe_first", f"{R} {DEDUPE.format(src='copies')}", RAW_COLUMNS)
add("resample_mean", f"{C} SELECT * FROM bins", f"cell_id:s ts:t {KPI_D}")
add("regular_grid", f"{C10} SELECT * FROM grid", f"cell_id:s ts:t {KPI_D}")
add("gap_fill", f"{C10} SELECT * FROM filled", CLEAN_COLUMNS)
add("clean_series", f"{C} SELECT * FROM clean", CLEAN_COLUMNS)
add("clean_series_fine", f"{C10} SELECT * FROM clean", CLEAN_COLUMNS)
add("clean_from_duplicates", f"WITH {cleaning(HOUR, 'copies')} SELECT * FROM clean", CLEAN_COLUMNS)
add("labels_grid", f"{C10} SELECT * FROM labels", "cell_id:s ts:t is_anomaly:b")
add("labels_floor", f"{R} SELECT cell_id, date_trunc('minute', ts) AS ts, bool_or(is_anomaly) AS is_anomaly FROM raw GROUP BY 1, 2",
    "cell_id:s ts:t is_anomaly:b")

# -- features

MEANS = " ".join(f"{k}_mean_{n}m:d" for k in KPIS for n in (5, 15, 30))
STDS = " ".join(f"{k}_std_15m:d" for k in KPIS)
LAGS = " ".join(f"{k}_lag_{n}:d" for k in KPIS for n in (1, 5, 10))
HOURS = " ".join(f"{k}_hour_mean:d" for k in KPIS) + " cell_load_hour_max:d"
SEASON = "hour_sin:d hour_cos:d dow_sin:d dow_cos:d"
DERIVED = " ".join(f"{k}_trend_5m_30m:d {k}_ratio_to_hour:d" for k in KPIS)
P10 = C10 + ",\n" + featuring(TEN)
add("rolling_mean", f"{P} SELECT * FROM rolled", f"cell_id:s ts:t {MEANS}")
add("rolling_std", f"{P} SELECT * FROM rolled", f"cell_id:s ts:t {STDS}")
add("lags", f"{P10} SELECT * FROM rolled", f"cell_id:s ts:t {LAGS}")
add("hour_stats", f"{P} SELECT * FROM rolled", f"cell_id:s ts:t {HOURS}")
add("feature_build", f"{P} SELECT * FROM features", f"cell_id:s ts:t {MEANS} {STDS} {LAGS} {HOURS} hour_of_day:l day_of_week:l")
add("feature_build_fine", f"{P10} SELECT * FROM features",
    "cell_id:s ts:t throughput_mean_30m:d latency_std_15m:d jitter_lag_10:d packet_loss_hour_mean:d day_of_week:l")
add("cyclic", f"{C} SELECT cell_id, ts, sin(2 * pi() * hour(ts) / 24) AS hour_sin, cos(2 * pi() * hour(ts) / 24) AS hour_cos, "
    "sin(2 * pi() * (isodow(ts) - 1) / 7) AS dow_sin, cos(2 * pi() * (isodow(ts) - 1) / 7) AS dow_cos, "
    "0.3 + 0.7 * (0.5 + 0.5 * sin((hour(ts) - 7) / CAST(24 AS DOUBLE) * 2 * pi())) AS load_factor FROM clean",
    f"cell_id:s ts:t {SEASON} load_factor:d")
add("derived", f"{P} SELECT * FROM prepared", f"cell_id:s ts:t {DERIVED}")
add("prepared", f"{P} SELECT * FROM prepared", f"cell_id:s ts:t {MEANS} {STDS} {LAGS} {HOURS} {SEASON} {DERIVED}")
add("detector_inputs", f"{P} SELECT * FROM prepared", "ts:t cell_id:s "
    + " ".join(f"{k}_mean_5m:d {k}_std_15m:d {k}_ratio_to_hour:d {k}_trend_5m_30m:d" for k in KPIS)
    + " cell_load_hour_max:d hour_sin:d hour_cos:d")

# -- selection

add("range_filter", f"{C} SELECT * FROM clean WHERE cell_id = 'cell_003' AND ts BETWEEN TIMESTAMP '2024-01-03 05:00:00' "
    "AND TIMESTAMP '2024-01-09 05:00:00'", CLEAN_COLUMNS)
add("since_last", f"{C} SELECT * FROM clean WHERE ts >= (SELECT max(ts) FROM clean) - INTERVAL 48 HOUR", CLEAN_COLUMNS)
add("served_rows", f"{C} SELECT cell_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS ts, {each('{k}')}, is_missing FROM clean",
    f"cell_id:s ts:s {KPI_D} is_missing:b")
add("cells", f"{C} SELECT cell_id, (SELECT count(DISTINCT cell_id) FROM clean) AS count FROM clean GROUP BY 1",
    "cell_id:s count:l")
add("thresholds", C + " " + " UNION ALL ".join(
    f"SELECT '{k}' AS kpi, '{UNITS[k]}' AS unit, {d(g)} AS good, {d(b)} AS degraded, '1.1' AS contract_version, "
    f"count(*) FILTER ({k} {'>' if up else '<'} {b}) AS critical_rows FROM clean"
    for k, (g, b, up) in BOUNDS.items()), "kpi:s unit:s good:d degraded:d contract_version:s critical_rows:l")
add("page", f"{C} SELECT * FROM clean ORDER BY ts, cell_id LIMIT 100 OFFSET 50", CLEAN_COLUMNS)
add("page_summary", f"{C} SELECT count(*) AS total, greatest(least(count(*) - 50, 100), 0) AS count, "
    "50 + greatest(least(count(*) - 50, 100), 0) < count(*) AS has_more FROM clean WHERE cell_id = 'cell_001'",
    "total:l count:l has_more:b")
add("page_after", f"{C} SELECT * FROM clean WHERE (ts, cell_id) > (TIMESTAMP '2024-01-02 03:00:00', 'cell_003') "
    "ORDER BY ts, cell_id LIMIT 100", CLEAN_COLUMNS)
add("latest_n", f"{C} SELECT * FROM clean ORDER BY ts DESC, cell_id LIMIT 100", CLEAN_COLUMNS)
add("stream_rows", f"{R} SELECT * FROM raw WHERE source = 'stream'", RAW_COLUMNS)
add("stream_tail", f"{R} SELECT * FROM raw WHERE source = 'stream' ORDER BY ts DESC, cell_id LIMIT 50", RAW_COLUMNS)
MEAN5 = each("{k}_mean_5m")
add("latest_state", f"{P}, newest AS (SELECT * FROM rolled QUALIFY row_number() OVER (PARTITION BY cell_id ORDER BY ts DESC) = 1) "
    f"SELECT n.cell_id, n.ts, {MEAN5}, {label_of(worst('_mean_5m'))} AS qos_state, {worst('_mean_5m')} AS qos_state_rank, "
    f"c.cause_kpi, c.cause_excess FROM newest n JOIN ({blame('newest', 'cell_id, ts', '_mean_5m')}) c ON c.cell_id = n.cell_id",
    "cell_id:s ts:t " + each("{k}_mean_5m:d", " ") + " qos_state:s qos_state_rank:l cause_kpi:s cause_excess:d")
add("first_cells", f"{C} SELECT * FROM clean WHERE cell_id IN (SELECT DISTINCT cell_id FROM clean ORDER BY 1 LIMIT 2)", CLEAN_COLUMNS)
add("origins", f"{P} SELECT cell_id, ts FROM prepared WINDOW w AS (PARTITION BY cell_id ORDER BY ts) "
    "QUALIFY (row_number() OVER w - 1) % 30 = 0 AND row_number() OVER w <= 3600", "cell_id:s ts:t")
add("systematic_sample", f"{P} SELECT cell_id, ts FROM (SELECT cell_id, ts, row_number() OVER (ORDER BY cell_id, ts) - 1 AS rn, "
    "greatest(count(*) OVER () // 500, 1) AS step FROM prepared) WHERE rn % step = 0 AND rn < step * 500", "cell_id:s ts:t")

# -- joins

add("align_labels", f"{P} SELECT cell_id, ts, is_anomaly FROM labelled", "cell_id:s ts:t is_anomaly:b")
add("match_rate", f"{P} SELECT (SELECT count(*) FROM labels) AS labels, count(*) AS rows, count(l.ts) AS matched, "
    "count(l.ts) / CAST(count(*) AS DOUBLE) AS rate FROM prepared p LEFT JOIN labels l ON l.cell_id = p.cell_id AND l.ts = p.ts",
    "labels:l rows:l matched:l rate:d")
add("history_labels", f"{C} SELECT c.*, coalesce(l.is_anomaly, false) AS is_anomaly FROM clean c LEFT JOIN labels l "
    "ON l.cell_id = c.cell_id AND l.ts = c.ts", CLEAN_COLUMNS + " is_anomaly:b")
TARGET_COLUMNS = " ".join(f"{t}:d" for t in TARGETS)
add("targets", f"{T} SELECT * FROM targeted", f"cell_id:s ts:t {TARGET_COLUMNS}")
add("supervised", f"{T} SELECT * FROM supervised", f"cell_id:s ts:t segment:s {TARGET_COLUMNS}")


def day_before(k: str, p: str = "p") -> tuple[str, str]:
    """Select list and joins of the seasonal-naive forecast of one KPI."""
    cols = ", ".join(f"coalesce(b{h}.{k}, {p}.{k}_mean_5m) AS y_hat_{h}" for h in HORIZONS)
    joins = " ".join(
        f"LEFT JOIN clean b{h} ON b{h}.cell_id = {p}.cell_id AND b{h}.ts = {p}.ts + INTERVAL ({h - 24}) HOUR" for h in HORIZONS
    )
    return cols, joins


_cols, _joins = day_before("latency")
add("seasonal_naive", f"{P} SELECT p.cell_id, p.ts, {_cols} FROM prepared p {_joins}",
    "cell_id:s ts:t y_hat_5:d y_hat_15:d y_hat_30:d")
add("alert_semi_join", f"{ALERTS} SELECT c.* FROM clean c SEMI JOIN (SELECT * FROM alerts WHERE is_anomaly_pred) a "
    "ON a.cell_id = c.cell_id AND a.ts = c.ts", CLEAN_COLUMNS)
add("shifted_forecast", f"{P} SELECT cell_id, ts + INTERVAL 15 HOUR AS ts, latency_mean_5m AS y_hat FROM prepared",
    "cell_id:s ts:t y_hat:d")
add("arima_context", f"{T}, numbered_clean AS (SELECT *, row_number() OVER (PARTITION BY cell_id ORDER BY ts) AS pos FROM clean), "
    "starts AS (SELECT cell_id, ts AS origin FROM supervised WHERE segment = 'test' WINDOW w AS (PARTITION BY cell_id ORDER BY ts) "
    "QUALIFY (row_number() OVER w - 1) % 30 = 0 AND row_number() OVER w <= 3600) "
    "SELECT s.cell_id, s.origin, count(*) AS n, min(h.ts) AS first_ts, avg(h.latency) AS latency FROM starts s "
    "JOIN numbered_clean o ON o.cell_id = s.cell_id AND o.ts = s.origin "
    "JOIN numbered_clean h ON h.cell_id = s.cell_id AND h.pos <= o.pos AND h.pos > o.pos - 1440 GROUP BY 1, 2",
    "cell_id:s origin:t n:l first_ts:t latency:d")

# -- exploration

STATED = f"stated AS (SELECT *, {worst()} AS rank, {label_of(worst())} AS qos_state, " + ", ".join(
    f"{label_of(rank_of(k, k))} AS {k}_state" for k in KPIS) + " FROM clean)"
add("qos_state", f"{C}, {STATED} SELECT *, rank AS qos_state_rank FROM stated",
    "cell_id:s ts:t qos_state:s qos_state_rank:l " + each("{k}_state:s", " "))
add("dominant_cause", f"{C} {blame('clean', 'cell_id, ts')}", "cell_id:s ts:t cause_kpi:s cause_excess:d")
DIST = "SELECT s.etat, count(st.qos_state) AS n, round(count(st.qos_state) * 100.0 / (SELECT count(*) FROM stated), 2) AS pct " \
    "FROM (VALUES ('bon'), ('dégradé'), ('critique')) s(etat) LEFT JOIN stated st ON st.qos_state = s.etat GROUP BY 1"
add("state_distribution", f"{C}, {STATED} {DIST}", "etat:s n:l pct:d")
add("metric_sink", f"{C}, {STATED} {DIST}", "etat:s n:l pct:d")


def shares(by: str, state: str) -> str:
    return ", ".join(
        f"round(count(*) FILTER ({state} = '{s}') * 100.0 / count(*), 2) AS {a}"
        for s, a in (("bon", "bon"), ("dégradé", "degrade"), ("critique", "critique"))
    )


PER_KPI = " UNION ALL ".join(f"SELECT '{k}' AS kpi, {shares('kpi', k + '_state')} FROM stated" for k in KPIS)
add("state_by_cell", f"{C}, {STATED} SELECT cell_id, {shares('cell_id', 'qos_state')} FROM stated GROUP BY 1",
    "cell_id:s bon:d degrade:d critique:d")
add("state_by_kpi", f"{C}, {STATED} {PER_KPI}", "kpi:s bon:d degrade:d critique:d")
add("state_truth_crosstab", f"{C}, {STATED} SELECT qos_state AS etat, is_anomaly, round(count(*) * 100.0 / sum(count(*)) OVER "
    "(PARTITION BY is_anomaly), 2) AS pct FROM (SELECT s.*, coalesce(l.is_anomaly, false) AS is_anomaly FROM stated s "
    "LEFT JOIN labels l ON l.cell_id = s.cell_id AND l.ts = s.ts) GROUP BY 1, 2", "etat:s is_anomaly:b pct:d")
add("independence", f"{C}, {STATED}, kpi_shares AS ({PER_KPI}) SELECT product(bon / 100) * 100 AS attendu_pct, "
    f"(SELECT pct FROM ({DIST}) WHERE etat = 'bon') AS observe_pct FROM kpi_shares", "attendu_pct:d observe_pct:d")
LONG = " UNION ALL ".join(f"SELECT '{k}' AS kpi, '{UNITS[k]}' AS unite, {k} AS value, * FROM hist" for k in KPIS)
HIST = "hist AS (SELECT c.*, coalesce(l.is_anomaly, false) AS is_anomaly FROM clean c LEFT JOIN labels l ON l.cell_id = c.cell_id AND l.ts = c.ts)"
add("describe_kpi", f"{C}, {HIST} SELECT kpi, unite, count(value) AS count, avg(value) AS mean, stddev_samp(value) AS std, "
    "min(value) AS min, max(value) AS max, skewness(value) AS skew, " + ", ".join(
        f"quantile_cont(value, {p}) AS {n}" for p, n in ((0.05, "p5"), (0.25, "p25"), (0.5, "p50"), (0.75, "p75"), (0.95, "p95"), (0.99, "p99")))
    + f" FROM ({LONG}) GROUP BY 1, 2", "kpi:s unite:s count:l mean:d std:d min:d max:d skew:d p5:d p25:d p50:d p75:d p95:d p99:d")
add("normal_vs_anomaly", f"{C}, {HIST} SELECT kpi, unite, round(mu_n, 3) AS moy_normal, round(mu_a, 3) AS moy_anomalie, "
    "round((mu_a - mu_n) / nullif(mu_n, 0) * 100, 2) AS ecart_relatif_pct, round(abs(mu_a - mu_n) / nullif(sigma, 0), 3) AS separabilite_sigma "
    "FROM (SELECT kpi, unite, avg(value) FILTER (NOT is_anomaly) AS mu_n, avg(value) FILTER (is_anomaly) AS mu_a, "
    f"stddev_samp(value) FILTER (NOT is_anomaly) AS sigma FROM ({LONG}) GROUP BY 1, 2)",
    "kpi:s unite:s moy_normal:d moy_anomalie:d ecart_relatif_pct:d separabilite_sigma:d")
PROFILE = f"profile AS (SELECT hour(ts) AS heure, {each('avg({k}) AS {k}')} FROM clean GROUP BY 1)"
add("hourly_profile", f"{C}, {PROFILE} SELECT * FROM profile", f"heure:l {KPI_D}")
add("amplitude", f"{C}, {PROFILE} " + " UNION ALL ".join(
    f"SELECT '{k}' AS kpi, round((max({k}) - min({k})) / avg({k}) * 100, 1) AS amplitude_pct FROM profile" for k in KPIS),
    "kpi:s amplitude_pct:d")
add("correlation", C + " " + " UNION ALL ".join(
    f"SELECT '{a}' AS kpi_a, '{b}' AS kpi_b, " + ("CAST(1 AS DOUBLE)" if a == b else f"corr({a}, {b})") + " AS r FROM clean" + (" GROUP BY 1" if a == b else "")
    for a in KPIS for b in KPIS), "kpi_a:s kpi_b:s r:d")
add("strongest_pairs", f"{C}, mixed AS (SELECT * REPLACE (cell_load + jitter AS cell_load) FROM clean) SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS kpi_a, '{b}' AS kpi_b, corr({a}, {b}) AS r FROM mixed" for a in KPIS for b in KPIS if a < b)
    + ") ORDER BY abs(r) DESC, kpi_a, kpi_b LIMIT 3", "kpi_a:s kpi_b:s r:d")
ACF = [1, 2, 5, 10, 15, 30, 60, 120, 720, 1440]
add("autocorrelation", C + " " + " UNION ALL ".join(
    f"SELECT cell_id, '{k}' AS kpi, {n} AS lag, CASE WHEN isnan(corr(v, p)) THEN NULL ELSE corr(v, p) END AS autocorr FROM "
    f"(SELECT cell_id, {k} AS v, lag({k}, {n}) OVER (PARTITION BY cell_id ORDER BY ts) AS p FROM clean) GROUP BY 1"
    for k in KPIS for n in ACF), "cell_id:s kpi:s lag:l autocorr:d")
GAPS = "gaps AS (SELECT cell_id, count(*) FILTER (ts - before <> INTERVAL {step}) AS irregular FROM (SELECT cell_id, ts, lag(ts) OVER (PARTITION BY cell_id ORDER BY ts) AS before FROM clean) GROUP BY 1)"
add("contract_audit", f"{C}, {HIST}, {GAPS.format(step=HOUR)} SELECT count(*) AS n_lignes, min(ts) AS periode_debut, max(ts) AS periode_fin, "
    "round(epoch(max(ts) - min(ts)) / 86400, 2) AS duree_jours, round(avg(CAST(is_missing AS INT)) * 100, 4) AS taux_imputation_pct, "
    "round(avg(CAST(is_anomaly AS INT)) * 100, 4) AS taux_anomalie_pct, "
    + " + ".join(f"count(*) FILTER ({k} IS NULL)" for k in KPIS) + " AS valeurs_nulles, "
    + ", ".join(f"count(*) FILTER ({k} < 0 OR {k} > 100) AS hors_bornes_{k}" for k in ("packet_loss", "cell_load")) + ", "
    + each("count(*) FILTER ({k} < 0) AS negatifs_{k}") + ", '' AS kpi_absents, '' AS seuils_absents, "
    "(SELECT count(*) FROM gaps) AS n_cellules, (SELECT sum(irregular) FROM gaps) AS intervalles_irreguliers FROM hist",
    "n_lignes:l periode_debut:t periode_fin:t duree_jours:d taux_imputation_pct:d taux_anomalie_pct:d valeurs_nulles:l "
    "hors_bornes_packet_loss:l hors_bornes_cell_load:l " + each("negatifs_{k}:l", " ")
    + " kpi_absents:s seuils_absents:s n_cellules:l intervalles_irreguliers:l")
add("grid_gaps", f"{C10}, {GAPS.format(step=TEN)} SELECT * FROM gaps", "cell_id:s irregular:l")
add("histogram", f"{C}, {HIST}, ends AS (SELECT kpi, min(value) AS lo, max(value) AS hi FROM ({LONG}) GROUP BY 1) "
    "SELECT kpi, least(CASE WHEN hi > lo THEN floor((value - lo) / ((hi - lo) / CAST(80 AS DOUBLE))) ELSE 0 END, 79) AS bin, count(*) AS n "
    f"FROM (SELECT kpi, value FROM ({LONG})) JOIN ends USING (kpi) WHERE value IS NOT NULL GROUP BY 1, 2", "kpi:s bin:l n:l")

# -- protocol

add("chronological_split", f"{S} SELECT cell_id, ts, segment FROM segments", "cell_id:s ts:t segment:s")
add("split_by_time", f"{P} SELECT * FROM (SELECT cell_id, ts, CASE WHEN ts <= TIMESTAMP '2024-01-18 00:00:00' THEN 'train' "
    "WHEN ts > TIMESTAMP '2024-01-18 00:00:00' + INTERVAL 60 HOUR AND ts <= TIMESTAMP '2024-01-24 00:00:00' THEN 'val' "
    "WHEN ts > TIMESTAMP '2024-01-24 00:00:00' + INTERVAL 60 HOUR THEN 'test' END AS segment FROM prepared) WHERE segment IS NOT NULL",
    "cell_id:s ts:t segment:s")
add("split_summary", f"{S} SELECT segment, count(*) AS n, min(ts) AS debut, max(ts) AS fin, count(DISTINCT cell_id) AS cellules "
    "FROM segments GROUP BY 1", "segment:s n:l debut:t fin:t cellules:l")
add("chronology", f"{S} SELECT *, coalesce(train_end < val_start, true) AND coalesce(val_end < test_start, true) AS in_order FROM (SELECT cell_id, "
    + ", ".join(f"min(ts) FILTER (segment = '{s}') AS {s}_start, max(ts) FILTER (segment = '{s}') AS {s}_end" for s in ("train", "val", "test"))
    + " FROM segments GROUP BY 1)", "cell_id:s train_start:t train_end:t val_start:t val_end:t test_start:t test_end:t in_order:b")

# -- episodes

add("episodes", f"{C}, {runs('labels', 'is_anomaly', 'flagged')} SELECT cell_id, row_number() OVER (PARTITION BY cell_id ORDER BY start_ts) "
    "AS episode_id, start_ts, end_ts, points FROM (SELECT cell_id, run, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS points "
    "FROM flagged GROUP BY 1, 2)", "cell_id:s episode_id:l start_ts:t end_ts:t points:l")
RUNS = (
    ALERTS + ", " + runs("alerts", "is_anomaly_pred", "alerted") + ", " + runs("alerts", "is_anomaly", "real")
    + ", alert_runs AS (SELECT cell_id, run, min(ts) AS debut, max(ts) AS fin, count(*) AS points, count(*) FILTER (is_anomaly) AS vrais FROM alerted GROUP BY 1, 2)"
    + ", real_runs AS (SELECT cell_id, run, min(ts) AS debut, count(*) AS points, count(*) FILTER (is_anomaly_pred) AS hits, "
    "(min(pos) FILTER (is_anomaly_pred) - min(pos)) * 60 AS delai, max(latency_ratio_to_hour) AS pic_l, max(packet_loss_mean_5m) AS pic_p, max(score) AS top FROM real GROUP BY 1, 2)"
    + ", cell_runs AS (SELECT a.cell_id, count(*) AS n, "
    "(SELECT count(*) FROM real_runs r WHERE r.cell_id = a.cell_id) AS reels, "
    "(SELECT count(*) FROM real_runs r WHERE r.cell_id = a.cell_id AND hits > 0) AS vus, "
    "(SELECT quantile_cont(delai, 0.5) FROM real_runs r WHERE r.cell_id = a.cell_id) AS med, "
    "(SELECT max(delai) FROM real_runs r WHERE r.cell_id = a.cell_id) AS longest, "
    "(SELECT count(*) FROM alert_runs x WHERE x.cell_id = a.cell_id AND vrais = 0) AS faux FROM alerts a GROUP BY 1)"
)
add("episode_overlap", f"{RUNS} SELECT cell_id, debut, fin, points, vrais, vrais = 0 AS fausse_alerte FROM alert_runs",
    "cell_id:s debut:t fin:t points:l vrais:l fausse_alerte:b")
CELL_METRICS = (
    "SELECT cell_id, reels AS episodes_reels, vus AS episodes_detectes, vus / nullif(CAST(reels AS DOUBLE), 0) AS rappel_episode, "
    "med AS delai_median_min, longest AS delai_max_min, faux AS episodes_fausse_alerte, faux / CAST(n AS DOUBLE) AS fausses_alertes_par_heure, "
    "round(CAST(n AS DOUBLE), 1) AS duree_evaluee_heures FROM cell_runs"
)
add("episode_metrics", f"{RUNS} {CELL_METRICS}", "cell_id:s episodes_reels:l episodes_detectes:l rappel_episode:d delai_median_min:d "
    "delai_max_min:d episodes_fausse_alerte:l fausses_alertes_par_heure:d duree_evaluee_heures:d")
add("episode_total", f"{RUNS} SELECT sum(episodes_reels) AS episodes_reels, sum(episodes_detectes) AS episodes_detectes, "
    "sum(episodes_detectes) / nullif(CAST(sum(episodes_reels) AS DOUBLE), 0) AS rappel_episode, quantile_cont(delai_median_min, 0.5) AS delai_median_min, "
    "sum(episodes_fausse_alerte) AS episodes_fausse_alerte, sum(episodes_fausse_alerte) / sum(duree_evaluee_heures) AS fausses_alertes_par_heure "
    f"FROM ({CELL_METRICS})", "episodes_reels:l episodes_detectes:l rappel_episode:d delai_median_min:d episodes_fausse_alerte:l fausses_alertes_par_heure:d")
ERRORS = (
    "SELECT cell_id, debut, points * 60 AS duree_min, hits > 0 AS detecte, round(hits / CAST(points AS DOUBLE), 3) AS part_points_detectes, "
    "round(pic_l, 3) AS pic_latence_ratio, round(pic_p, 3) AS pic_packet_loss, round(top, 4) AS score_max FROM real_runs"
)
add("episode_errors", f"{RUNS} {ERRORS}", "cell_id:s debut:t duree_min:l detecte:b part_points_detectes:d pic_latence_ratio:d pic_packet_loss:d score_max:d")
add("episode_error_summary", f"{RUNS} SELECT count(*) AS episodes_test, count(*) FILTER (NOT detecte) AS episodes_manques, "
    "quantile_cont(duree_min, 0.5) FILTER (NOT detecte) AS duree_mediane_manques, quantile_cont(duree_min, 0.5) FILTER (detecte) AS duree_mediane_detectes, "
    f"quantile_cont(part_points_detectes, 0.5) FILTER (detecte) AS part_mediane_detectee FROM ({ERRORS})",
    "episodes_test:l episodes_manques:l duree_mediane_manques:d duree_mediane_detectes:d part_mediane_detectee:d")

# -- point-wise metrics


def counts(y: str = "is_anomaly", p: str = "is_anomaly_pred") -> str:
    return (
        f"count(*) FILTER ({y} AND {p}) AS vp, count(*) FILTER (NOT {y} AND {p}) AS fp, "
        f"count(*) FILTER (NOT {y} AND NOT {p}) AS vn, count(*) FILTER ({y} AND NOT {p}) AS fn"
    )


RATIOS = (
    "coalesce(vp / nullif(CAST(vp + fp AS DOUBLE), 0), 0) AS precision, coalesce(vp / nullif(CAST(vp + fn AS DOUBLE), 0), 0) AS rappel, "
    "coalesce(2 * vp / nullif(CAST(2 * vp + fp + fn AS DOUBLE), 0), 0) AS f1, vp + fp + vn + fn AS n, "
    "(vp + fp) / CAST(vp + fp + vn + fn AS DOUBLE) * 100 AS taux_alerte_pct, (vp + fn) / CAST(vp + fp + vn + fn AS DOUBLE) * 100 AS prevalence_pct, "
    "coalesce(vn / nullif(CAST(vn + fp AS DOUBLE), 0), 0) AS specificite"
)
POINT = "precision:d rappel:d f1:d vp:l fp:l vn:l fn:l n:l taux_alerte_pct:d prevalence_pct:d specificite:d"
add("confusion", f"{ALERTS} SELECT *, {RATIOS} FROM (SELECT cell_id, {counts()} FROM alerts GROUP BY 1)", f"cell_id:s {POINT}")
RANKED = (
    "SELECT detector, sum(pos * hits / CAST(n_ge AS DOUBLE)) / nullif(max(p), 0) AS pr_auc, "
    "(sum(pos * (below + (n + 1) / CAST(2 AS DOUBLE))) - max(p) * (max(p) + 1) / CAST(2 AS DOUBLE)) / nullif(CAST(max(p) * (max(total) - max(p)) AS DOUBLE), 0) AS roc_auc FROM ("
    "SELECT *, sum(n) OVER (PARTITION BY detector ORDER BY score DESC) AS n_ge, sum(pos) OVER (PARTITION BY detector ORDER BY score DESC) AS hits, "
    "sum(n) OVER (PARTITION BY detector ORDER BY score) - n AS below, sum(n) OVER (PARTITION BY detector) AS total, sum(pos) OVER (PARTITION BY detector) AS p "
    "FROM (SELECT detector, score, count(*) AS n, count(*) FILTER (is_anomaly) AS pos FROM scores WHERE segment = 'test' GROUP BY 1, 2)) GROUP BY 1"
)
add("ranking", f"{SCORES} {RANKED}", "detector:s pr_auc:d roc_auc:d")
_width = (0.9995 - 0.50) / 199
PROBS = ", ".join(repr(0.50 + k * _width) for k in range(199)) + ", 0.9995"


def swept(segment: str) -> str:
    return (
        f"cuts AS (SELECT DISTINCT detector, unnest(quantile_cont(score, [{PROBS}])) AS seuil FROM scores WHERE segment = '{segment}' GROUP BY detector), "
        f"curve AS (SELECT *, {RATIOS} FROM (SELECT c.detector, c.seuil, {counts('s.is_anomaly', '(s.score >= c.seuil)')} FROM cuts c "
        f"JOIN scores s ON s.detector = c.detector AND s.segment = '{segment}' GROUP BY 1, 2))"
    )


add("sweep", f"{SCORES}, {swept('val')} SELECT * FROM curve", "detector:s seuil:d taux_alerte_pct:d precision:d rappel:d f1:d")
add("precision_recall_curve", f"{SCORES}, {swept('test')} SELECT * FROM curve", "detector:s rappel:d precision:d")
BEST = "SELECT detector, seuil, f1 FROM curve QUALIFY row_number() OVER (PARTITION BY detector ORDER BY f1 DESC, seuil) = 1"
add("best_threshold", f"{SCORES}, {swept('val')} {BEST}", "detector:s seuil:d f1:d")
FREE = "SELECT detector, quantile_cont(score, 0.98) AS seuil FROM scores WHERE segment = 'train' GROUP BY 1"
add("score_threshold", f"{SCORES} {FREE}", "detector:s seuil:d")
add("score_histogram", f"{SCORES}, t AS (SELECT * FROM scores WHERE segment = 'test'), ends AS (SELECT detector, min(score) AS lo, max(score) AS hi FROM t GROUP BY 1) "
    "SELECT detector, is_anomaly, least(CASE WHEN hi > lo THEN floor((score - lo) / ((hi - lo) / CAST(60 AS DOUBLE))) ELSE 0 END, 59) AS bin, count(*) AS n "
    "FROM t JOIN ends USING (detector) GROUP BY 1, 2, 3", "detector:s is_anomaly:b bin:l n:l")
add("threshold_detector", f"{P} SELECT cell_id, ts, {worst('_mean_5m')} AS score, {worst('_mean_5m')} >= 2 AS is_anomaly_pred FROM prepared",
    "cell_id:s ts:t score:d is_anomaly_pred:b")
COMPARED = (
    f"{SCORES}, {swept('val')}, points AS (SELECT detector, 'f1_optimal' AS point, seuil FROM ({BEST}) UNION ALL SELECT detector, 'exploitation', seuil FROM ({FREE})), "
    "judged AS (SELECT s.*, p.point, p.seuil, s.score >= p.seuil AS pred, row_number() OVER w AS pos FROM scores s JOIN points p USING (detector) WHERE segment = 'test' "
    "WINDOW w AS (PARTITION BY s.detector, p.point, s.cell_id ORDER BY s.ts)), "
    "truth_runs AS (SELECT detector, point, cell_id, run, count(*) FILTER (pred) AS hits, (min(pos) FILTER (pred) - min(pos)) * 60 AS delai FROM "
    "(SELECT *, pos - row_number() OVER (PARTITION BY detector, point, cell_id ORDER BY ts) AS run FROM judged WHERE is_anomaly) GROUP BY 1, 2, 3, 4), "
    "pred_runs AS (SELECT detector, point, cell_id, run, count(*) FILTER (is_anomaly) AS vrais FROM "
    "(SELECT *, pos - row_number() OVER (PARTITION BY detector, point, cell_id ORDER BY ts) AS run FROM judged WHERE pred) GROUP BY 1, 2, 3, 4), "
    "per_cell AS (SELECT j.detector, j.point, j.cell_id, round(CAST(count(*) AS DOUBLE), 1) AS hours, "
    "(SELECT count(*) FROM truth_runs t WHERE t.detector = j.detector AND t.point = j.point AND t.cell_id = j.cell_id) AS reels, "
    "(SELECT count(*) FROM truth_runs t WHERE t.detector = j.detector AND t.point = j.point AND t.cell_id = j.cell_id AND hits > 0) AS vus, "
    "(SELECT quantile_cont(delai, 0.5) FROM truth_runs t WHERE t.detector = j.detector AND t.point = j.point AND t.cell_id = j.cell_id) AS med, "
    "(SELECT count(*) FROM pred_runs t WHERE t.detector = j.detector AND t.point = j.point AND t.cell_id = j.cell_id AND vrais = 0) AS faux "
    "FROM judged j GROUP BY 1, 2, 3), "
    "compared AS (SELECT f.detector, f.point AS point_de_fonctionnement, f.* EXCLUDE (detector, point), e.* EXCLUDE (detector, point), r.pr_auc, r.roc_auc FROM "
    f"(SELECT *, {RATIOS} FROM (SELECT detector, point, seuil, {counts('is_anomaly', 'pred')} FROM judged GROUP BY 1, 2, 3)) f "
    "JOIN (SELECT detector, point, sum(reels) AS episodes_reels, sum(vus) AS episodes_detectes, sum(vus) / nullif(CAST(sum(reels) AS DOUBLE), 0) AS rappel_episode, "
    "quantile_cont(med, 0.5) AS delai_median_min, sum(faux) AS episodes_fausse_alerte, sum(faux) / sum(hours) AS fausses_alertes_par_heure FROM per_cell GROUP BY 1, 2) e "
    f"ON e.detector = f.detector AND e.point = f.point JOIN ({RANKED}) r ON r.detector = f.detector)"
)
add("detector_comparison", f"{COMPARED} SELECT * FROM compared", f"detector:s point_de_fonctionnement:s seuil:d {POINT} episodes_reels:l episodes_detectes:l "
    "rappel_episode:d delai_median_min:d episodes_fausse_alerte:l fausses_alertes_par_heure:d pr_auc:d roc_auc:d")
add("threshold_sensitivity", f"{COMPARED} SELECT detector, max(f1) FILTER (point_de_fonctionnement = 'f1_optimal') - "
    "max(f1) FILTER (point_de_fonctionnement = 'exploitation') AS ecart_f1 FROM compared GROUP BY 1", "detector:s ecart_f1:d")

# -- scaling

INPUTS = [f"{k}_{x}" for k in KPIS for x in ("mean_5m", "std_15m", "ratio_to_hour", "trend_5m_30m")] + ["cell_load_hour_max", "hour_sin", "hour_cos"]


def spread(c: str, where: str = "segment = 'train'", by: str = "") -> str:
    q = [f"quantile_cont({c}, {p})" for p in (0.25, 0.5, 0.75)]
    return f"{q[1]} AS center, CASE WHEN {q[2]} - {q[0]} = 0 THEN 1 ELSE {q[2]} - {q[0]} END AS scale"


add("robust_parameters", S + " " + " UNION ALL ".join(
    f"SELECT cell_id, '{c}' AS name, {spread(c)} FROM segments WHERE segment = 'train' GROUP BY 1 UNION ALL "
    f"SELECT '*', '{c}', {spread(c)} FROM segments WHERE segment = 'train'" for c in INPUTS), "cell_id:s name:s center:d scale:d")
THREE = ["latency_mean_5m", "throughput_std_15m", "cell_load_hour_max"]


def params(name: str, by_cell: bool, where: str, standard: bool = False) -> str:
    cols = []
    for c in THREE:
        if standard:
            cols.append(f"avg({c}) AS c_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS s_{c}")
        else:
            cols.append(spread(c).replace("AS center", f"AS c_{c}").replace("AS scale", f"AS s_{c}"))
    return f"{name} AS (SELECT {'cell_id, ' if by_cell else ''}{', '.join(cols)} FROM segments WHERE {where}{' GROUP BY 1' if by_cell else ''})"


TRAIN = "segment = 'train'"
KNOWN = "segment = 'train' AND cell_id <> 'cell_005'"
THREE_D = "cell_id:s ts:t " + " ".join(f"{c}:d" for c in THREE)
add("robust_scale", f"{S}, {params('own', True, KNOWN)}, {params('overall', False, KNOWN)} SELECT t.cell_id, t.ts, "
    + ", ".join(f"(t.{c} - coalesce(o.c_{c}, g.c_{c})) / coalesce(o.s_{c}, g.s_{c}) AS {c}" for c in THREE)
    + " FROM segments t LEFT JOIN own o ON o.cell_id = t.cell_id, overall g WHERE t.segment = 'test'", THREE_D)
add("global_scale", f"{S}, {params('r', False, TRAIN)}, "
    f"{params('z', False, TRAIN, True)} "
    + " UNION ALL ".join(f"SELECT t.cell_id, t.ts, '{kind}' AS kind, " + ", ".join(f"(t.{c} - p.c_{c}) / p.s_{c} AS {c}" for c in THREE)
                         + f" FROM segments t, {cte} p WHERE t.segment = 'test'" for kind, cte in (("robust", "r"), ("standard", "z"))), THREE_D + " kind:s")
add("trim_extremes", f"{S}, {params('own', True, TRAIN)}, far AS (SELECT t.cell_id, t.ts, "
    + " + ".join(f"abs((t.{c} - o.c_{c}) / o.s_{c})" for c in THREE)
    + f" AS extremity FROM segments t JOIN own o ON o.cell_id = t.cell_id WHERE t.{TRAIN}) "
    "SELECT cell_id, ts FROM far WHERE extremity <= (SELECT quantile_cont(extremity, 0.95) FROM far)", "cell_id:s ts:t")

# -- density: every pair of rows is measured here

_scaled = ", ".join(f"(t.{c} - o.c_{c}) / o.s_{c}" for c in INPUTS)
_own = ", ".join(spread(c).replace("AS center", f"AS c_{c}").replace("AS scale", f"AS s_{c}") for c in INPUTS)
DENSITY = (
    f"{S}, own AS (SELECT cell_id, {_own} FROM segments WHERE {TRAIN} GROUP BY 1), "
    f"v AS MATERIALIZED (SELECT t.cell_id, t.ts, t.segment, t.is_anomaly, [{_scaled}] AS x FROM segments t JOIN own o ON o.cell_id = t.cell_id), "
    f"tr AS MATERIALIZED (SELECT row_number() OVER (ORDER BY cell_id, ts) AS i, x FROM v WHERE {TRAIN}), "
    "pairs AS MATERIALIZED (SELECT a.i, b.i AS j, list_distance(a.x, b.x) AS dist FROM tr a, tr b), "
    "kth AS MATERIALIZED (SELECT i, dist FROM (SELECT i, dist, row_number() OVER (PARTITION BY i ORDER BY dist) AS n FROM pairs) WHERE n = 20), "
    "eps AS MATERIALIZED (SELECT quantile_cont(dist, 0.98) AS e FROM kth), "
    "core AS MATERIALIZED (SELECT i FROM kth, eps WHERE dist <= e), "
    "kept AS MATERIALIZED (SELECT i, x FROM tr WHERE i IN (SELECT i FROM pairs, eps WHERE dist <= e AND j IN (SELECT i FROM core)))"
)
add("dbscan", f"{DENSITY}, test AS (SELECT * FROM v WHERE segment = 'test') SELECT t.cell_id, t.ts, any_value(t.is_anomaly) AS is_anomaly, "
    "min(list_distance(t.x, k.x)) AS score FROM test t, kept k GROUP BY 1, 2", "cell_id:s ts:t is_anomaly:b score:d")

# -- forecasts

_joins24 = " ".join(f"LEFT JOIN clean b{h} ON b{h}.cell_id = p.cell_id AND b{h}.ts = p.ts + INTERVAL ({h - 24}) HOUR" for h in HORIZONS)


def long_forecasts(src: str, scope: str) -> str:
    models = {
        "persistance": "p.{k}_mean_5m",
        "moyenne_mobile_15m": "p.{k}_mean_15m",
        "naif_saisonnier_24h": "coalesce(b{h}.{k}, p.{k}_mean_5m)",
    }
    return " UNION ALL ".join(
        f"SELECT '{scope}' AS scope, '{m}' AS model, '{k}' AS kpi, {h} AS horizon_min, p.{k}_target_{h}m AS y, {e.format(k=k, h=h)} AS y_hat FROM {src} p {_joins24}"
        for m, e in models.items() for k in KPIS for h in HORIZONS
    )


ERROR = (
    "SELECT scope, model, kpi, horizon_min, avg(abs(y_hat - y)) AS mae, sqrt(avg((y_hat - y) * (y_hat - y))) AS rmse, "
    "avg(abs(y_hat - y) / greatest(abs(y), 1e-6)) * 100 AS mape, avg(abs(y_hat - y) / greatest((abs(y) + abs(y_hat)) / 2, 1e-6)) * 100 AS smape, "
    "avg(y_hat - y) AS biais, count(y_hat - y) AS n FROM forecasts GROUP BY 1, 2, 3, 4"
)
TABLE = (
    f"errors AS ({ERROR}), table_ AS (SELECT e.*, round((round(b.mae, 4) - round(e.mae, 4)) / nullif(round(b.mae, 4), 0) * 100, 2) AS gain_mae_vs_persistance_pct, "
    "CASE e.kpi " + " ".join(f"WHEN '{k}' THEN '{u}'" for k, u in UNITS.items()) + " END AS unite FROM errors e LEFT JOIN errors b "
    "ON b.scope = e.scope AND b.kpi = e.kpi AND b.horizon_min = e.horizon_min AND b.model = 'persistance')"
)
TEST = ", test_rows AS (SELECT * FROM supervised WHERE segment = 'test')"
F = f"{T}{TEST}, forecasts AS ({long_forecasts('test_rows', 'test_complet')}), {TABLE}"
add("forecast_table", f"{F} SELECT * REPLACE (round(mape, 2) AS mape) FROM table_", "scope:s model:s kpi:s horizon_min:l mae:d rmse:d mape:d smape:d biais:d n:l gain_mae_vs_persistance_pct:d unite:s")
ORIGIN_ROWS = (
    "origin_rows AS (SELECT * FROM test_rows WINDOW w AS (PARTITION BY cell_id ORDER BY ts) QUALIFY (row_number() OVER w - 1) % 30 = 0 AND row_number() OVER w <= 3600)"
)
add("forecast_scopes", f"{T}{TEST}, {ORIGIN_ROWS}, forecasts AS ({long_forecasts('test_rows', 'test_complet')} UNION ALL {long_forecasts('origin_rows', 'origines_communes')}) {ERROR}",
    "scope:s model:s kpi:s horizon_min:l mae:d n:l")
add("gain_pivot", f"{F} SELECT scope, model, " + ", ".join(f"round(avg(gain_mae_vs_persistance_pct) FILTER (horizon_min = {h}), 2) AS gain_{h}" for h in HORIZONS)
    + " FROM table_ GROUP BY 1, 2", "scope:s model:s gain_5:d gain_15:d gain_30:d")
add("mae_pivot", f"{F} SELECT scope, kpi, horizon_min, " + ", ".join(
    f"max(round(mae, 4)) FILTER (model = '{m}') AS {m}" for m in ("persistance", "moyenne_mobile_15m", "naif_saisonnier_24h"))
    + " FROM table_ GROUP BY 1, 2, 3", "scope:s kpi:s horizon_min:l persistance:d moyenne_mobile_15m:d naif_saisonnier_24h:d")
add("best_model", f"{F} SELECT * FROM (SELECT scope, horizon_min, model, avg(gain_mae_vs_persistance_pct) AS gain FROM table_ WHERE model <> 'persistance' GROUP BY 1, 2, 3) "
    "QUALIFY row_number() OVER (PARTITION BY scope, horizon_min ORDER BY gain DESC NULLS LAST, model) = 1", "scope:s horizon_min:l model:s gain:d")


def pairs(h: int) -> str:
    told = "greatest(" + ", ".join(rank_of(k, f"{k}_mean_5m") for k in KPIS) + ")"
    seen = "greatest(" + ", ".join(rank_of(k, f"{k}_target_{h}m") for k in KPIS) + ")"
    return f"SELECT {h} AS horizon_min, {told} AS predicted, {seen} AS actual FROM supervised WHERE segment = 'test'"


PAIRS = "pairs AS (" + " UNION ALL ".join(pairs(h) for h in HORIZONS) + ")"
add("state_accuracy", f"{T}, {PAIRS} SELECT horizon_min, round(avg(CAST(predicted = actual AS INT)), 4) AS exactitude_etat, "
    "round(count(*) FILTER (actual = 2 AND predicted <> 2) / CAST(greatest(count(*) FILTER (actual = 2), 1) AS DOUBLE), 4) AS part_critiques_manques, count(*) AS n "
    "FROM pairs GROUP BY 1", "horizon_min:l exactitude_etat:d part_critiques_manques:d n:l")
add("state_confusion", f"{T}, {PAIRS} SELECT h AS horizon_min, {label_of('a')} AS actual, {label_of('b')} AS predicted, count(pairs.actual) AS n FROM "
    "(SELECT * FROM (VALUES (5), (15), (30)) x(h), (VALUES (0), (1), (2)) y(a), (VALUES (0), (1), (2)) z(b)) g "
    "LEFT JOIN pairs ON horizon_min = h AND pairs.actual = a AND pairs.predicted = b GROUP BY h, a, b", "horizon_min:l actual:s predicted:s n:l")


def pairs_of(model: str, template: str, h: int) -> str:
    told = "greatest(" + ", ".join(rank_of(k, "told").replace("told", "(" + template.format(k=k, h=h) + ")") for k in KPIS) + ")"
    seen = "greatest(" + ", ".join(rank_of(k, f"p.{k}_target_{h}m") for k in KPIS) + ")"
    return f"SELECT '{model}' AS model, {h} AS horizon_min, {told} AS predicted, {seen} AS actual FROM supervised p {_joins24} WHERE p.segment = 'test'"


MODEL_PAIRS = "pairs AS (" + " UNION ALL ".join(
    pairs_of(m, t, h)
    for m, t in (("persistance", "p.{k}_mean_5m"), ("moyenne_mobile_15m", "p.{k}_mean_15m"), ("naif_saisonnier_24h", "coalesce(b{h}.{k}, p.{k}_mean_5m)"))
    for h in HORIZONS
) + ")"
add("state_accuracy_by_model", f"{T}, {MODEL_PAIRS} SELECT model, horizon_min, round(avg(CAST(predicted = actual AS INT)), 4) AS exactitude_etat, "
    "round(count(*) FILTER (actual = 2 AND predicted <> 2) / CAST(greatest(count(*) FILTER (actual = 2), 1) AS DOUBLE), 4) AS part_critiques_manques, count(*) AS n "
    "FROM pairs GROUP BY 1, 2", "model:s horizon_min:l exactitude_etat:d part_critiques_manques:d n:l")
add("state_confusion_by_model", f"{T}, {MODEL_PAIRS} SELECT m AS model, h AS horizon_min, {label_of('a')} AS actual, {label_of('b')} AS predicted, count(pairs.actual) AS n FROM "
    "(SELECT * FROM (VALUES ('persistance'), ('moyenne_mobile_15m'), ('naif_saisonnier_24h')) w(m), (VALUES (5), (15), (30)) x(h), (VALUES (0), (1), (2)) y(a), (VALUES (0), (1), (2)) z(b)) g "
    "LEFT JOIN pairs ON model = m AND horizon_min = h AND pairs.actual = a AND pairs.predicted = b GROUP BY m, h, a, b", "model:s horizon_min:l actual:s predicted:s n:l")
_paths = " UNION ALL ".join(
    f"SELECT cell_id, ts, kpi, {h} AS horizon_min, CASE WHEN pos + 1 >= 60 THEN coalesce(icept * "
    + "(" + " + ".join(f"power(slope, {i})" for i in range(h)) + f") + power(slope, {h}) * y, y) + centre END AS y_hat FROM fits"
    for h in HORIZONS
)
add("ar1_forecast", f"{T}, long AS (" + " UNION ALL ".join(f"SELECT cell_id, ts, '{k}' AS kpi, {k} AS raw FROM clean WHERE {k} IS NOT NULL" for k in KPIS) + "), "
    "centred AS (SELECT cell_id, kpi, ts, avg(raw) OVER s AS centre, raw - avg(raw) OVER s AS y, row_number() OVER (s ORDER BY ts) - 1 AS pos, "
    "lag(raw) OVER (s ORDER BY ts) - avg(raw) OVER s AS y1 FROM long WINDOW s AS (PARTITION BY cell_id, kpi)), "
    "usable AS (SELECT *, CASE WHEN pos >= 12 THEN y1 END AS x FROM centred), "
    "fitted AS (SELECT *, regr_slope(y, x) OVER w AS slope, regr_intercept(y, x) OVER w AS icept FROM usable "
    "WINDOW w AS (PARTITION BY cell_id, kpi ORDER BY ts ROWS BETWEEN 1427 PRECEDING AND CURRENT ROW)), "
    "fits AS (SELECT o.cell_id, o.ts, f.kpi, f.pos, f.slope, f.icept, f.y, f.centre FROM (SELECT cell_id, ts FROM supervised WHERE segment = 'test') o "
    "JOIN fitted f ON f.cell_id = o.cell_id AND f.ts <= o.ts QUALIFY row_number() OVER (PARTITION BY o.cell_id, o.ts, f.kpi ORDER BY f.ts DESC) = 1) "
    f"{_paths}", "cell_id:s ts:t kpi:s horizon_min:l y_hat:d")
_again = " UNION ALL ".join(
    f"SELECT '{m}' AS model, '{k}' AS kpi, {h} AS horizon_min, p.cell_id, p.ts, {t.format(k=k, h=h)} AS y_hat FROM supervised p {_joins24} WHERE p.segment = 'test'"
    for m, t in (("persistance", "p.{k}_mean_5m"), ("moyenne_mobile_15m", "p.{k}_mean_15m"), ("naif_saisonnier_24h", "coalesce(b{h}.{k}, p.{k}_mean_5m)"))
    for k in KPIS for h in HORIZONS
)
add("reloaded_models", f"{T} {_again} UNION ALL SELECT 'seuils_contrat', 'tous', 0, cell_id, ts, greatest({', '.join(rank_of(k, k + '_mean_5m') for k in KPIS)}) "
    "FROM supervised WHERE segment = 'test'", "model:s kpi:s horizon_min:l cell_id:s ts:t y_hat:d")
add("canonical_order", f"{C} SELECT cell_id, ts, row_number() OVER (PARTITION BY cell_id ORDER BY ts) - 1 AS place, latency FROM clean ORDER BY cell_id, ts",
    "cell_id:s ts:t place:l latency:d")
add("known_cells", f"{C} SELECT a AS cell_id, a IN (SELECT cell_id FROM clean) AS known FROM (VALUES ('cell_001'), ('cell_005'), ('cell_999'), ('')) x(a)", "cell_id:s known:b")
add("gbt_retained", f"SELECT kpi, horizon_min, 2 AS candidats, 1 AS retenus, true AS meilleur FROM (VALUES {', '.join(f"('{k}')" for k in KPIS)}) q(kpi), "
    "(VALUES (5), (15), (30)) h(horizon_min)", "kpi:s horizon_min:l candidats:l retenus:l meilleur:b")
add("gbt_start", f"{T}, tr AS (SELECT * FROM supervised WHERE segment = 'train') " + " UNION ALL ".join(
    f"SELECT '{t}' AS cible, '{loss}' AS objectif, {f.format(t)} AS depart FROM tr" for t in TARGETS for loss, f in (("squared", "avg({})"), ("absolute", "quantile_cont({}, 0.5)"))),
    "cible:s objectif:s depart:d")
add("announced_state", f"{P}, newest AS (SELECT * FROM prepared QUALIFY row_number() OVER (PARTITION BY cell_id ORDER BY ts DESC) = 1) "
    f"SELECT n.cell_id, n.ts, h AS horizon_min, n.ts + h * INTERVAL 1 HOUR AS announced_for, {label_of(worst('_mean_5m'))} AS qos_state, c.cause_kpi, c.cause_excess "
    f"FROM newest n JOIN ({blame('newest', 'cell_id, ts', '_mean_5m')}) c ON c.cell_id = n.cell_id, (VALUES (5), (15), (30)) x(h)",
    "cell_id:s ts:t horizon_min:l announced_for:t qos_state:s cause_kpi:s cause_excess:d")

# -- monitoring

add("alerts_by_cell", f"{ALERTS} SELECT cell_id, count(*) AS alertes, max(round(score, 4)) AS score_max, max(ts) AS derniere FROM alerts "
    "WHERE is_anomaly_pred GROUP BY 1", "cell_id:s alertes:l score_max:d derniere:t")
AGE = "epoch_us(TIMESTAMP '2024-01-31 00:00:00' - max(ts)) / CAST(1000000 AS DOUBLE)"
add("freshness", f"{R} SELECT cell_id, max(ts) AS derniere, {AGE} AS age_s, {AGE} < 2400 AS actif FROM raw WHERE source = 'stream' GROUP BY 1",
    "cell_id:s derniere:t age_s:d actif:b")
add("stream_liveness", f"{R} SELECT cell_id, max(ts) AS derniere, {AGE} AS age_s, {AGE} < 2400 AS actif FROM raw GROUP BY 1",
    "cell_id:s derniere:t age_s:d actif:b")
add("point_delta", f"{R} SELECT cell_id, ts, " + each("CASE WHEN row_number() OVER w = 1 THEN 0 ELSE {k} - lag({k}) OVER w END AS {k}_delta")
    + " FROM raw WHERE source = 'stream' WINDOW w AS (PARTITION BY cell_id ORDER BY ts)", "cell_id:s ts:t " + each("{k}_delta:d", " "))

# -- streaming: the result after all input has been read

add("stream_ingest", f"{R} SELECT * REPLACE ('stream' AS source) FROM raw", RAW_COLUMNS)
ORACLES["stream_snapshots"] = ORACLES["stream_ingest"]
add("stream_latest", f"{R} SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY cell_id ORDER BY ts DESC) = 1", f"cell_id:s ts:t {KPI_D}")
add("stream_state", f"{R} SELECT r.cell_id, r.ts, {label_of(worst())} AS qos_state, c.cause_kpi, c.cause_excess FROM raw r "
    f"JOIN ({blame('raw', 'cell_id, ts')}) c ON c.cell_id = r.cell_id AND c.ts = r.ts", "cell_id:s ts:t qos_state:s cause_kpi:s cause_excess:d")
WIDE = f"cell_id:s ts:t {MEANS} {STDS} {LAGS} {HOURS} hour_of_day:l day_of_week:l"
add("stream_refresh", f"{P} SELECT * FROM features", WIDE)
HOLES = (
    "holes AS (SELECT * FROM raw WHERE NOT (cell_id IN ('cell_001', 'cell_004') "
    "AND ts BETWEEN TIMESTAMP '2024-01-06 00:00:00' AND TIMESTAMP '2024-01-22 16:00:00'))"
)
add("stream_refresh_holes", "WITH " + cleaning(HOUR, "holes").replace("first_rows AS", HOLES + ",\nfirst_rows AS", 1) + ",\n" + featuring(HOUR)
    + " SELECT * FROM features", WIDE)
_frames = ", ".join(
    f"w{n} AS (PARTITION BY cell_id ORDER BY ts RANGE BETWEEN INTERVAL {n - 1} HOUR PRECEDING AND CURRENT ROW)" for n in (5, 15, 30, 60)
)
add("stream_means", f"WITH {RAW}, first_rows AS ({DEDUPE.format(src='raw')}), "
    f"bins AS (SELECT cell_id, time_bucket(INTERVAL 1 HOUR, ts) AS ts, {each('avg({k}) AS {k}')} FROM first_rows GROUP BY 1, 2) "
    "SELECT cell_id, ts, " + ", ".join(f"avg({k}) OVER w{n} AS {k}_mean_{n}m" for k in KPIS for n in (5, 15, 30, 60)) + f" FROM bins WINDOW {_frames}",
    "cell_id:s ts:t " + " ".join(f"{k}_mean_{n}m:d" for k in KPIS for n in (5, 15, 30, 60)))
add("stream_episodes", f"{C}, {runs('labels', 'is_anomaly', 'flagged')} SELECT cell_id, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS points "
    "FROM flagged GROUP BY cell_id, run", "cell_id:s start_ts:t end_ts:t points:l")
add("stream_closed_episodes", f"{C}, {runs('labels', 'is_anomaly', 'flagged')} SELECT cell_id, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS points "
    "FROM flagged GROUP BY cell_id, run HAVING max(ts) + INTERVAL 1 HOUR < (SELECT max(ts) FROM labels) - INTERVAL 20 DAY",
    "cell_id:s start_ts:t end_ts:t points:l")
add("csv_mixed_headers", f"{R} SELECT ts, cell_id, {each('{k}')}, is_anomaly, 'batch' AS source FROM raw",
    f"ts:t cell_id:s {KPI_D} is_anomaly:b source:s")
add("served_elsewhere", f"{C} SELECT cell_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS ts, hour(ts) AS hour_of_day, isodow(ts) - 1 AS day_of_week FROM clean",
    "cell_id:s ts:s hour_of_day:l day_of_week:l")
add("learned_counts", f"{S} SELECT detector, segment, count(*) AS n, count(*) AS finite FROM segments, "
    "(VALUES ('isolation_forest'), ('dbscan'), ('acp'), ('autoencodeur')) m(detector) GROUP BY 1, 2", "detector:s segment:s n:l finite:l")
add("forecast_study_counts", f"{T}, tested AS (SELECT *, row_number() OVER (PARTITION BY cell_id ORDER BY ts) - 1 AS place FROM supervised WHERE segment = 'test'), "
    "scopes AS (SELECT 'test_complet' AS scope, count(*) AS n FROM tested UNION ALL SELECT 'origines_communes', count(*) FROM tested WHERE place % 30 = 0) "
    "SELECT scope, model, kpi, horizon_min, n, true AS measured FROM scopes, "
    "(VALUES ('persistance'), ('moyenne_mobile_15m'), ('naif_saisonnier_24h'), ('arima')) m(model), "
    f"(VALUES {', '.join(f"('{k}')" for k in KPIS)}) q(kpi), (VALUES (5), (15), (30)) h(horizon_min) "
    "WHERE model <> 'arima' OR scope = 'origines_communes'", "scope:s model:s kpi:s horizon_min:l n:l measured:b")
