"""The registered queries as DuckDB SQL, written independently of the Spark plans."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class LogSql:
    """One driver table as a log: its CTEs and the constants its queries use."""

    raw: str
    category: str
    split: str
    first_day: str
    days: int
    threshold: float
    low_max: int
    high_min: int
    retracted: str

    @property
    def base(self) -> str:
        return self._ctes("*")

    @property
    def base_without_repeats(self) -> str:
        return self._ctes("DISTINCT contract, category, duration, log_date")

    @property
    def base_without_retracted(self) -> str:
        return self._ctes("*", f"AND NOT {self.retracted}")

    def _ctes(self, columns: str, rest: str = "") -> str:
        return f"""WITH raw AS ({self.raw}),
every AS (SELECT *, {self.category} AS category FROM raw),
log AS (SELECT {columns} FROM every WHERE category <> 'Error' {rest}),
tot AS (SELECT contract, category, SUM(duration) AS t FROM log GROUP BY ALL),
day_tot AS (SELECT contract, log_date, SUM(duration) AS t FROM log GROUP BY ALL),
"""


EVENTS = LogSql(
    raw="""SELECT event_id AS session_id, CAST(user_id AS VARCHAR) AS contract, event_type AS app_name,
       CAST(value AS DECIMAL(18,2)) AS duration, CAST(ts AS DATE) AS log_date FROM events""",
    category="""CASE app_name WHEN 'view' THEN 'TV' WHEN 'click' THEN 'Movie' WHEN 'purchase' THEN 'Relax'
       WHEN 'signup' THEN 'Child' ELSE 'Error' END""",
    split="2024-01-16",
    first_day="2024-01-01",
    days=30,
    threshold=0.8,
    low_max=2400,
    high_min=2800,
    retracted="log_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-11'",
)

ORDERS = LogSql(
    raw="""SELECT o_orderkey AS session_id, CAST(o_custkey AS VARCHAR) AS contract, o_orderpriority AS app_name,
       CAST(o_totalprice AS DECIMAL(18,2)) AS duration, CAST(o_orderdate AS DATE) AS log_date FROM orders""",
    category="""CASE app_name WHEN '1-URGENT' THEN 'TV' WHEN '2-HIGH' THEN 'Movie' WHEN '3-MEDIUM' THEN 'Relax'
       WHEN '4-NOT SPECIFIED' THEN 'Child' WHEN '5-LOW' THEN 'Sport' ELSE 'Error' END""",
    split="1998-04-01",
    first_day="1995-01-01",
    days=2405,
    threshold=0.004,
    low_max=2_000_000,
    high_min=3_000_000,
    retracted="log_date BETWEEN DATE '1998-04-01' AND DATE '2001-08-01'",
)

ORDER = """CASE category WHEN 'Relax' THEN 1 WHEN 'Movie' THEN 2 WHEN 'Child' THEN 3
       WHEN 'Sport' THEN 4 ELSE 5 END"""

SUMS = """CAST(SUM(duration) FILTER (category = 'Relax') AS DECIMAL(18,2)) AS relax_duration,
       CAST(SUM(duration) FILTER (category = 'Movie') AS DECIMAL(18,2)) AS movie_duration,
       CAST(SUM(duration) FILTER (category = 'Child') AS DECIMAL(18,2)) AS child_duration,
       CAST(SUM(duration) FILTER (category = 'Sport') AS DECIMAL(18,2)) AS sport_duration,
       CAST(SUM(duration) FILTER (category = 'TV') AS DECIMAL(18,2)) AS tv_duration"""

PIVOT = f"piv AS (SELECT contract, {SUMS} FROM log GROUP BY contract)"
DAY_PIVOT = f"day_piv AS (SELECT contract, log_date, {SUMS} FROM log GROUP BY contract, log_date)"


def _most_watch(source: str, value: str) -> str:
    return f"""mw AS (SELECT contract, category AS most_watch FROM (
  SELECT contract, category, ROW_NUMBER() OVER (
    PARTITION BY contract ORDER BY {value} DESC NULLS LAST, {ORDER}) AS r FROM {source}) WHERE r = 1)"""


def _label(column: str, label: str, test: str) -> str:
    return f"CASE WHEN {column} {test} THEN '{label}' END"


def _taste(test: str = "IS NOT NULL") -> str:
    labels = [
        _label(c, name, test)
        for c, name in (
            ("relax_duration", "Relax"),
            ("movie_duration", "Movie"),
            ("child_duration", "Child"),
            ("sport_duration", "Sport"),
            ("tv_duration", "TV"),
        )
    ]
    return f"CONCAT_WS('-', {', '.join(labels)})"


ACTIVE = """act AS (SELECT contract, CAST(SUM(CASE WHEN t > 0 THEN 1 ELSE 0 END) AS BIGINT) AS active_days
  FROM day_tot GROUP BY contract)"""

FLAG_ANY = """CASE WHEN relax_duration > 0 OR movie_duration > 0 OR child_duration > 0
       OR sport_duration > 0 OR tv_duration > 0 THEN 1 ELSE 0 END"""


def _profile(log: LogSql) -> str:
    """CTEs up to ``prof``, the contract-grain profile."""
    return f"""{PIVOT}, {_most_watch("tot", "t")}, {ACTIVE},
prof AS (SELECT piv.*, most_watch, {_taste()} AS customer_taste, active_days,
       active_days / {log.days} AS active_rate
  FROM piv LEFT JOIN mw USING (contract) LEFT JOIN act USING (contract) WHERE contract IS NOT NULL)"""


def _groups(log: LogSql) -> str:
    return f"""{_profile(log)},
grp AS (SELECT contract, most_watch, customer_taste, active_level,
       CONCAT_WS(' , ', most_watch, customer_taste, active_level) AS customer_group
  FROM (SELECT *, CASE WHEN active_rate >= {log.threshold} THEN 'High' ELSE 'Low' END AS active_level FROM prof))"""


def _activeness(log: LogSql, days: str) -> str:
    return f"""SELECT contract, active_days, active_days / {log.days} AS active_rate,
       ROUND(100 * active_days / {log.days}, 2) AS active_percent FROM {days}"""


def _log_queries(log: LogSql) -> dict[str, str]:
    """Queries that run on both logs. A value is the part after the common CTEs."""
    flagged = f"SELECT contract, log_date, {FLAG_ANY} AS is_active FROM day_piv"
    contract_total = "ct AS (SELECT contract, SUM(duration) AS total FROM log GROUP BY contract)"
    level = """CASE WHEN {t} >= {high} THEN 'high' WHEN {t} >= {low} THEN 'normal' WHEN {t} < {low} THEN 'low' END
            AS engagement_type"""
    by_amount = level.format(t="total", high=log.high_min, low=log.low_max)
    by_quantile = level.format(t="CAST(total AS DOUBLE)", high="hi", low="lo")
    profile, groups = _profile(log), _groups(log)
    pivot_rows = f"{PIVOT} SELECT * FROM piv"
    daily = f"""{profile}, {DAY_PIVOT} SELECT day_piv.*, most_watch, customer_taste, active_days, active_rate
            FROM day_piv JOIN prof USING (contract)"""
    return {
        "sum_contract_category": """x AS (SELECT 1) SELECT contract, category,
            CAST(t AS DECIMAL(18,2)) AS total FROM tot""",
        "sum_contract_category_day": """x AS (SELECT 1) SELECT contract, category, log_date,
            CAST(SUM(duration) AS DECIMAL(18,2)) AS total FROM log GROUP BY contract, category, log_date""",
        "sum_contract_day": "x AS (SELECT 1) SELECT contract, log_date, CAST(t AS DECIMAL(18,2)) AS total FROM day_tot",
        "category_summary": """x AS (SELECT 1) SELECT category, COUNT(DISTINCT contract) AS contracts,
            CAST(SUM(duration) AS DECIMAL(18,2)) AS total FROM log GROUP BY category""",
        "pivot_category": pivot_rows,
        "pivot_category_day": f"{DAY_PIVOT} SELECT * FROM day_piv",
        "merge_partials": pivot_rows,
        "pivot_by_join": pivot_rows,
        "active_flag_any": f"{DAY_PIVOT} {flagged}",
        "active_flag_total": """x AS (SELECT 1) SELECT contract, log_date, CAST(t AS DECIMAL(18,2)) AS total,
            CASE WHEN t > 0 THEN 1 ELSE 0 END AS is_active FROM day_tot""",
        "active_days": f"{ACTIVE} SELECT * FROM act",
        "duplicate_contracts": """x AS (SELECT 1) SELECT contract, COUNT(*) AS n_rows FROM log
            GROUP BY contract HAVING COUNT(*) > 1""",
        "dedup_sessions": "x AS (SELECT 1) SELECT DISTINCT contract, category, duration, log_date FROM log",
        "top_contracts": f"""{contract_total} SELECT contract, CAST(total AS DECIMAL(18,2)) AS total
            FROM ct ORDER BY ct.total DESC, contract LIMIT 10""",
        "most_watch": f"{_most_watch('tot', 't')} SELECT * FROM mw",
        "most_watch_max_by": f"{_most_watch('tot', 't')} SELECT * FROM mw",
        "most_watch_day": f"""dt AS (SELECT contract, category, log_date, SUM(duration) AS t FROM log GROUP BY ALL),
            {_most_watch('dt', 't')} SELECT * FROM mw""",
        "most_watch_session": f"{_most_watch('log', 'duration')} SELECT * FROM mw",
        "presence_labels": f"""{PIVOT} SELECT contract, {_label('relax_duration', 'Relax', 'IS NOT NULL')} AS relax,
            {_label('movie_duration', 'Movie', 'IS NOT NULL')} AS movie,
            {_label('child_duration', 'Child', 'IS NOT NULL')} AS child,
            {_label('sport_duration', 'Sport', 'IS NOT NULL')} AS sport,
            {_label('tv_duration', 'TV', 'IS NOT NULL')} AS tv FROM piv""",
        "customer_taste": f"{PIVOT} SELECT contract, {_taste()} AS customer_taste FROM piv",
        "customer_taste_nonzero": f"{PIVOT} SELECT contract, {_taste('<> 0')} AS customer_taste FROM piv",
        "activeness": f"{ACTIVE} {_activeness(log, 'act')}",
        "activeness_pivot": f"""{DAY_PIVOT}, act AS (SELECT contract, CAST(SUM(is_active) AS BIGINT) AS active_days
            FROM ({flagged}) GROUP BY contract) {_activeness(log, 'act')}""",
        "customer_profile": f"{profile} SELECT * FROM prof",
        "customer_profile_join": f"{profile} SELECT * FROM prof",
        "daily_profile": daily,
        "daily_profile_join": daily,
        "session_profile": f"""{profile} SELECT session_id, contract, category, duration, log_date, most_watch,
            customer_taste, active_days, active_rate FROM log LEFT JOIN prof USING (contract)""",
        "engagement_level": f"""{contract_total} SELECT contract, CAST(total AS DECIMAL(18,2)) AS total, {by_amount}
            FROM ct""",
        "engagement_percentile": f"""{contract_total}, cut AS (
            SELECT QUANTILE_CONT(CAST(total AS DOUBLE), 1.0 / 3) AS lo,
              QUANTILE_CONT(CAST(total AS DOUBLE), 2.0 / 3) AS hi FROM ct)
            SELECT contract, {by_quantile} FROM ct, cut""",
        "active_level": f"""{ACTIVE} SELECT contract, active_days / {log.days} AS active_rate,
            CASE WHEN active_days / {log.days} >= {log.threshold} THEN 'High' ELSE 'Low' END AS active_level
            FROM act""",
        "customer_group": f"{groups} SELECT * FROM grp",
        "segment_counts": f"""{groups} SELECT most_watch, customer_taste, active_level, COUNT(*) AS customers
            FROM grp GROUP BY ALL""",
        "segment_dimensions": f"""{groups} SELECT COUNT(DISTINCT most_watch) AS most_watch_values,
            COUNT(DISTINCT customer_taste) AS taste_values, COUNT(DISTINCT active_level) AS level_values,
            COUNT(*) AS customers FROM grp""",
        "segment_cube": f"""{groups},
            tastes AS (SELECT CONCAT_WS('-', CASE WHEN i & 1 <> 0 THEN 'Relax' END, CASE WHEN i & 2 <> 0 THEN 'Movie' END,
              CASE WHEN i & 4 <> 0 THEN 'Child' END, CASE WHEN i & 8 <> 0 THEN 'Sport' END,
              CASE WHEN i & 16 <> 0 THEN 'TV' END) AS customer_taste FROM range(32) t(i) UNION ALL SELECT 'All'),
            grid AS (SELECT * FROM (SELECT UNNEST(['Relax', 'Movie', 'Child', 'Sport', 'TV', 'All']) AS most_watch),
              tastes, (SELECT UNNEST(['High', 'Low', 'All']) AS active_level)),
            counted AS (SELECT CASE WHEN GROUPING(most_watch) = 1 THEN 'All' ELSE most_watch END AS most_watch,
              CASE WHEN GROUPING(customer_taste) = 1 THEN 'All' ELSE customer_taste END AS customer_taste,
              CASE WHEN GROUPING(active_level) = 1 THEN 'All' ELSE active_level END AS active_level,
              COUNT(*) AS customers FROM grp GROUP BY CUBE (most_watch, customer_taste, active_level))
            SELECT most_watch, customer_taste, active_level, COALESCE(customers, 0) AS customers
            FROM grid LEFT JOIN counted USING (most_watch, customer_taste, active_level)""",
        "sketched_summary": """x AS (SELECT 1) SELECT category, COUNT(DISTINCT contract) AS contracts,
            CAST(SUM(duration) AS DECIMAL(18,2)) AS total FROM log GROUP BY category""",
        "export_profile": f"""{profile} SELECT contract AS "Contract", relax_duration AS "RelaxDuration",
            movie_duration AS "MovieDuration", child_duration AS "ChildDuration", sport_duration AS "SportDuration",
            tv_duration AS "TVDuration", CASE most_watch WHEN 'Relax' THEN 'Giải Trí' WHEN 'Movie' THEN 'Phim Truyện'
            WHEN 'Child' THEN 'Thiếu Nhi' WHEN 'Sport' THEN 'Thể Thao' WHEN 'TV' THEN 'Truyền Hình' END AS "MostWatch",
            customer_taste AS "CustomerTaste", active_days AS "ActiveDays", active_rate AS "ActiveRate" FROM prof""",
    }


def _row_queries() -> dict[str, str]:
    paired = """CASE WHEN app_name IN ('1-URGENT', '2-HIGH') THEN 'TV'
        WHEN app_name IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN 'Movie' ELSE 'Error' END"""
    events = {
        "parse_date": """SELECT CAST(STRPTIME(STRFTIME(log_date, '%Y%m%d'), '%Y%m%d') AS DATE) AS log_date,
            COUNT(*) AS n_rows FROM raw GROUP BY 1""",
        "date_stamp": "SELECT session_id, log_date FROM raw",
        "date_range": """SELECT session_id, contract, log_date FROM raw
            WHERE log_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-11'""",
        "categorize_case": "SELECT session_id, category FROM every",
        "categorize_isin": "SELECT session_id, category FROM every",
        "categorize_dim": "SELECT session_id, category FROM every",
        "project": "SELECT contract, category, duration, log_date FROM log",
        "filter_contract": "SELECT session_id FROM raw WHERE contract <> '0'",
        "filter_mapped": "SELECT session_id, category FROM log",
        "category_slice": "SELECT session_id, contract, duration FROM every WHERE category = 'TV'",
        "contract_lookup": "SELECT session_id, contract, category, duration, log_date FROM log WHERE contract = '7'",
        "union_days": "SELECT * FROM log",
        "sort_contract": "SELECT contract, log_date, category, duration FROM log",
        "mapping_audit": "SELECT DISTINCT app_name, category FROM every",
        "scan_json": "SELECT contract, app_name, duration, log_date FROM raw",
        "scan_json_range": """SELECT contract, app_name, duration, log_date FROM raw
            WHERE log_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-11'""",
        "consolidate": "SELECT * FROM raw",
        "compacted": "SELECT * FROM raw",
        "contract_lookup_stored": "SELECT session_id, contract, category, duration, log_date FROM log WHERE contract = '7'",
        "weekend_sessions": "SELECT contract, app_name, duration, log_date FROM raw WHERE ISODOW(log_date) >= 6",
        "quarantine": """SELECT CASE WHEN reason IS NULL THEN contract END AS contract,
            CASE WHEN reason IS NULL THEN app_name END AS app_name,
            CASE WHEN reason IS NULL THEN duration END AS duration, log_date, reason
            FROM (SELECT *, CASE WHEN session_id % 97 = 0 THEN 'no JSON' WHEN session_id % 89 = 0 THEN 'duration' END
              AS reason FROM raw)""",
        "rolling_activeness": """c.contract, e.end_date, COUNT(d.contract) AS active_days,
            COUNT(d.contract) / 7 AS active_rate
            FROM (SELECT DISTINCT contract FROM log) c CROSS JOIN ends e LEFT JOIN day_tot d
            ON d.contract = c.contract AND d.t > 0 AND d.log_date BETWEEN e.end_date - 6 AND e.end_date GROUP BY ALL""",
        "rolling_customers": """category, end_date, COUNT(DISTINCT contract) AS contracts
            FROM log JOIN ends ON log_date BETWEEN end_date - 6 AND end_date GROUP BY ALL""",
        "retention": """category, COUNT(a) AS before, COUNT(b) AS after,
            COUNT(*) FILTER (a IS NOT NULL AND b IS NOT NULL) AS stayed, COUNT(*) FILTER (b IS NULL) AS gone,
            COUNT(*) FILTER (a IS NULL) AS joined
            FROM (SELECT DISTINCT category, contract, contract AS a FROM log
              WHERE log_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-11')
            FULL JOIN (SELECT DISTINCT category, contract, contract AS b FROM log
              WHERE log_date BETWEEN DATE '2024-01-12' AND DATE '2024-01-18') USING (category, contract)
            GROUP BY category""",
        "total_quantiles": """UNNEST([0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]::DOUBLE[]) AS fraction,
            CAST(UNNEST(QUANTILE_DISC(t, [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0])) AS DECIMAL(18,2)) AS total,
            COUNT(*) AS n FROM day_tot""",
    }
    ends = f"""ends AS (SELECT CAST(UNNEST(GENERATE_SERIES(DATE '{EVENTS.first_day}' + 6,
        DATE '{EVENTS.first_day}' + {EVENTS.days - 1}, INTERVAL 1 DAY)) AS DATE) AS end_date)"""
    for key in ("rolling_activeness", "rolling_customers", "retention", "total_quantiles"):
        events[key] = f", {ends} SELECT {events[key]}"
    found = {key: f"{EVENTS.base} x AS (SELECT 1){' ' * (sql[0] != ',')}{sql}" for key, sql in events.items()}
    found["stamp_result"] = f"""{EVENTS.base} {PIVOT} SELECT *, DATE '{EVENTS.first_day}' AS log_date FROM piv"""
    found["category_summary_unmapped"] = f"""{EVENTS.base} x AS (SELECT 1)
        SELECT category, COUNT(DISTINCT contract) AS contracts, CAST(SUM(duration) AS DECIMAL(18,2)) AS total
        FROM every WHERE contract <> '0' GROUP BY category"""
    for key in ("categorize_isin_orders", "categorize_dim_orders"):
        found[key] = f"{ORDERS.base} x AS (SELECT 1) SELECT session_id, {paired} AS category FROM raw"
    found["pivot_unmapped"] = f"""{EVENTS.base} {PIVOT},
        err AS (SELECT contract, CAST(SUM(duration) AS DECIMAL(18,2)) AS error_duration
          FROM every WHERE category = 'Error' GROUP BY contract)
        SELECT * FROM piv FULL JOIN err USING (contract) WHERE contract <> '0'"""
    return found


def all_sql() -> dict[str, str]:
    """SQL by query key."""
    events = {key: f"{EVENTS.base}{sql}" for key, sql in _log_queries(EVENTS).items()}
    orders = {f"{key}_orders": f"{ORDERS.base}{sql}" for key, sql in _log_queries(ORDERS).items()}
    same = {
        f"customer_profile_dedup{suffix}": f"{log.base_without_repeats}{_profile(log)} SELECT * FROM prof"
        for suffix, log in (("", EVENTS), ("_orders", ORDERS))
    }
    same |= {
        "customer_profile_one_shuffle": events["customer_profile"],
        "activeness_one_shuffle": events["activeness"],
        "csv_roundtrip": events["customer_profile"],
        "incremental_profile": events["customer_profile"],
        "incremental_days": events["sum_contract_category_day"],
        "synced_days": events["sum_contract_category_day"],
    }
    same |= {
        f"retracted_profile{suffix}": f"{log.base_without_retracted}{_profile(log)} SELECT * FROM prof"
        for suffix, log in (("", EVENTS), ("_orders", ORDERS))
    }
    return _row_queries() | events | orders | same
