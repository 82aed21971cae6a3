"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The SQL is assembled from CTE fragments that mirror the Spark stages:
raw (adapter) -> tagged (drop reason) -> clean -> rfm -> logged -> scaled
-> assigned (fixed centres) -> enriched / profile. Every computed column
carries the same alias as the Spark query, counts are BIGINT, and derived
doubles are rounded identically on both sides (``+ 0.0`` turns a rounded
negative zero into zero, as Spark's decimal rounding does).
"""

from __future__ import annotations

# Fixed values, written out here so that the SQL does not depend on the code it checks.
WEEKDAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
AUDIT_STEPS = (
    "rows_in", "customer_null", "date_invalid", "cancelled", "quantity_null", "quantity_non_positive",
    "price_null", "price_non_positive", "description_null", "duplicate", "rows_out",
)
FIXED_CENTRES = ((1.0, -1.0, -1.0), (-1.0, 1.0, 1.0), (0.0, 0.0, 0.0))
SEGMENT_NAMES = ("Champions", "Potential Loyalists", "Hibernating")

# -- adapters ---------------------------------------------------------------

RAW_ORDERS = """raw AS (
  SELECT CASE WHEN l.l_returnflag = 'R' THEN 'C' ELSE '' END || CAST(o.o_orderkey AS VARCHAR) AS "Invoice",
         CAST(l.l_partkey AS VARCHAR) AS "StockCode",
         p.p_name AS "Description",
         CAST(l.l_quantity AS INTEGER) AS "Quantity",
         o.o_orderdate AS "InvoiceDate",
         p.p_retailprice AS "Price",
         CAST(o.o_custkey AS VARCHAR) AS "Customer ID",
         n.n_name AS "Country"
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

RAW_EVENTS = """raw AS (
  SELECT CAST(event_id AS VARCHAR) AS "Invoice",
         event_type AS "StockCode",
         event_type AS "Description",
         CAST(1 AS INTEGER) AS "Quantity",
         ts AS "InvoiceDate",
         value AS "Price",
         CAST(user_id AS VARCHAR) AS "Customer ID",
         CAST(NULL AS VARCHAR) AS "Country"
  FROM events
)"""

# Order lines damaged by rule number, and events without dates after the 20th (sources/adapters.py, plans/stages.py).
RAW_DIRTY = RAW_ORDERS.replace("raw AS", "sound AS", 1) + """,
numbered AS (
  SELECT *, (CAST("StockCode" AS BIGINT) + 5 * "Quantity") % 19 AS rule FROM sound
),
damaged AS (
  SELECT rule, "Invoice",
         CASE WHEN rule <> 14 THEN "StockCode" END AS "StockCode",
         CASE WHEN rule <> 9 THEN "Description" END AS "Description",
         CAST(CASE rule WHEN 2 THEN NULL WHEN 3 THEN 0 WHEN 4 THEN -"Quantity" ELSE "Quantity" END AS INTEGER) AS "Quantity",
         CASE WHEN rule <> 1 THEN CAST("InvoiceDate" AS TIMESTAMP) END AS "InvoiceDate",
         CASE rule WHEN 5 THEN NULL WHEN 6 THEN CAST('NaN' AS DOUBLE) WHEN 7 THEN CAST(0 AS DOUBLE)
                   WHEN 8 THEN -"Price" WHEN 15 THEN CAST(0.001 AS DOUBLE) ELSE "Price" END AS "Price",
         CASE rule WHEN 0 THEN NULL WHEN 10 THEN "Customer ID" || '.0' WHEN 11 THEN ' ' || "Customer ID" || ' '
                   ELSE "Customer ID" END AS "Customer ID",
         CASE WHEN rule <> 13 THEN "Country" END AS "Country"
  FROM numbered
),
raw AS (
  SELECT * EXCLUDE (rule) FROM damaged
  UNION ALL SELECT * EXCLUDE (rule) FROM damaged WHERE rule = 12
)"""
RAW_SPARSE = RAW_EVENTS.replace("raw AS", "every AS", 1) + """,
raw AS (
  SELECT * REPLACE (CASE WHEN day("InvoiceDate") <= 20 THEN "InvoiceDate" END AS "InvoiceDate") FROM every
)"""

# -- cleaning ---------------------------------------------------------------

TAGGED = r"""tagged AS (
  SELECT CASE
           WHEN "Customer ID" IS NULL THEN 'customer_null'
           WHEN "InvoiceDate" IS NULL THEN 'date_invalid'
           WHEN starts_with("Invoice", 'C') THEN 'cancelled'
           WHEN "Quantity" IS NULL THEN 'quantity_null'
           WHEN NOT ("Quantity" > 0) THEN 'quantity_non_positive'
           WHEN "Price" IS NULL OR isnan("Price") THEN 'price_null'
           WHEN NOT ("Price" > 0) THEN 'price_non_positive'
           WHEN "Description" IS NULL THEN 'description_null'
         END AS reason,
         "Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price",
         trim(regexp_replace("Customer ID", '\.0$', ''), ' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)) AS "Customer ID",
         "Country",
         "Quantity" * "Price" AS "Revenue"
  FROM raw
)"""

CLEAN = """clean AS (
  SELECT DISTINCT * EXCLUDE (reason) FROM tagged WHERE reason IS NULL
)"""

# -- RFM, features, fixed-centre clusters --------------------------------------

RFM = """snap AS (
  SELECT CAST(CAST(max("InvoiceDate") AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY AS s FROM clean
),
rfm AS (
  SELECT "Customer ID" AS CustomerID,
         CAST(date_sub('day', max("InvoiceDate"), any_value(s)) AS INTEGER) AS Recency,
         CAST(count(DISTINCT "Invoice") AS BIGINT) AS Frequency,
         CAST(sum(CAST("Revenue" AS DECIMAL(38,8))) AS DOUBLE) AS Monetary
  FROM clean CROSS JOIN snap
  GROUP BY "Customer ID"
)"""

LOGGED = """logged AS (
  SELECT *, ln(1 + CAST(Recency AS DOUBLE)) AS R_log,
            ln(1 + CAST(Frequency AS DOUBLE)) AS F_log,
            ln(1 + Monetary) AS M_log
  FROM rfm
)"""


def _z(col: str) -> str:
    return (
        f"({col}_log - (SELECT avg({col}_log) FROM logged)) / "
        f"(SELECT CASE WHEN stddev_pop({col}_log) = 0 THEN 1.0 ELSE stddev_pop({col}_log) END FROM logged)"
    )


SCALED = f"""scaled AS (
  SELECT *, {_z('R')} AS R_scaled, {_z('F')} AS F_scaled, {_z('M')} AS M_scaled
  FROM logged
)"""


def _dist(i: int, centre) -> str:
    terms = [
        f"(({c} - {float(v)!r}) * ({c} - {float(v)!r}))"
        for c, v in zip(("R_scaled", "F_scaled", "M_scaled"), centre)
    ]
    expr = terms[0]
    for t in terms[1:]:
        expr = f"({expr} + {t})"
    return f"{expr} AS d{i}"


def _argmin(k: int) -> str:
    cases = []
    for i in range(k - 1):
        conds = " AND ".join(f"d{i} <= d{j}" for j in range(i + 1, k))
        cases.append(f"WHEN {conds} THEN {i}")
    return f"CAST(CASE {' '.join(cases)} ELSE {k - 1} END AS INTEGER)"


ASSIGNED = f"""dists AS (
  SELECT *, {', '.join(_dist(i, c) for i, c in enumerate(FIXED_CENTRES))} FROM scaled
),
assigned AS (
  SELECT *, {_argmin(len(FIXED_CENTRES))} AS Cluster FROM dists
)"""

# -- temporal ----------------------------------------------------------------

ENRICHED = """enriched AS (
  SELECT c."Invoice" AS "Invoice", c."Customer ID" AS CustomerID, c."InvoiceDate" AS "InvoiceDate",
         CAST(hour(c."InvoiceDate") AS INTEGER) AS hour,
         dayname(c."InvoiceDate") AS day_of_week,
         CAST(isodow(c."InvoiceDate") - 1 AS INTEGER) AS dow_num,
         isodow(c."InvoiceDate") - 1 >= 5 AS is_weekend,
         CAST(day(c."InvoiceDate") AS INTEGER) AS day_of_month,
         CAST(month(c."InvoiceDate") AS INTEGER) AS month,
         CASE WHEN day(c."InvoiceDate") > 0 AND day(c."InvoiceDate") <= 10 THEN 'Early'
              WHEN day(c."InvoiceDate") > 10 AND day(c."InvoiceDate") <= 20 THEN 'Mid'
              WHEN day(c."InvoiceDate") > 20 AND day(c."InvoiceDate") <= 31 THEN 'Late' END AS month_period
  FROM clean c
)"""

ACTIVITY = """activity AS (
  SELECT e.*, a.Cluster FROM enriched e JOIN assigned a ON e.CustomerID = a.CustomerID
)"""

PROFILE = """prof AS (
  SELECT Cluster, day_of_week, hour, month_period,
         CAST(count(*) AS BIGINT) AS transactions,
         CAST(count(DISTINCT CustomerID) AS BIGINT) AS unique_customers
  FROM activity
  WHERE day_of_week IS NOT NULL AND hour IS NOT NULL AND month_period IS NOT NULL
  GROUP BY Cluster, day_of_week, hour, month_period
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ORDERS_CLEAN = with_ctes(RAW_ORDERS, TAGGED, CLEAN)
ORDERS_RFM = with_ctes(RAW_ORDERS, TAGGED, CLEAN, RFM)
ORDERS_SCALED = with_ctes(RAW_ORDERS, TAGGED, CLEAN, RFM, LOGGED, SCALED)
ORDERS_ASSIGNED = with_ctes(RAW_ORDERS, TAGGED, CLEAN, RFM, LOGGED, SCALED, ASSIGNED)
EVENTS_CLEAN = with_ctes(RAW_EVENTS, TAGGED, CLEAN)
EVENTS_RFM = with_ctes(RAW_EVENTS, TAGGED, CLEAN, RFM)
EVENTS_ENRICHED = with_ctes(RAW_EVENTS, TAGGED, CLEAN, ENRICHED)
EVENTS_ACTIVITY = with_ctes(RAW_EVENTS, TAGGED, CLEAN, RFM, LOGGED, SCALED, ASSIGNED, ENRICHED, ACTIVITY)
EVENTS_PROFILE = with_ctes(RAW_EVENTS, TAGGED, CLEAN, RFM, LOGGED, SCALED, ASSIGNED, ENRICHED, ACTIVITY, PROFILE)


def r(expr: str, digits: int) -> str:
    return f"(round({expr}, {digits}) + 0.0)"


def _describe(source: str, cols, probs) -> str:
    parts = []
    for c in cols:
        x = f'CAST("{c}" AS DOUBLE)'
        qs = ", ".join(
            f"{r(f'quantile_cont(x, {p})', 4)} AS p{round(p * 100):d}" for p in probs
        )
        parts.append(
            f"SELECT '{c}' AS field, CAST(count(x) AS BIGINT) AS count, {r('avg(x)', 4)} AS mean, "
            f"{r('stddev_samp(x)', 4)} AS std, {r('min(x)', 4)} AS min, {qs}, {r('max(x)', 4)} AS max "
            f"FROM (SELECT {x} AS x FROM {source}) WHERE x IS NOT NULL AND NOT isnan(x)"
        )
    return "\nUNION ALL\n".join(parts)


def _skew(source: str, cols) -> str:
    parts = [
        f"SELECT '{c}' AS field, {r('skewness(x)', 4)} AS skewness "
        f'FROM (SELECT CAST("{c}" AS DOUBLE) AS x FROM {source}) WHERE x IS NOT NULL AND NOT isnan(x)'
        for c in cols
    ]
    return "\nUNION ALL\n".join(parts)


def _missing(source: str, cols_types) -> str:
    parts = []
    for i, (c, is_float) in enumerate(cols_types):
        cond = f'"{c}" IS NULL' + (f' OR isnan("{c}")' if is_float else "")
        parts.append(
            f"SELECT '{c}' AS field, {i} AS position, "
            f"avg(CASE WHEN {cond} THEN 1.0 ELSE 0.0 END) AS missing_ratio FROM {source}"
        )
    return (
        "SELECT * FROM (\n" + "\nUNION ALL\n".join(parts) + "\n) ORDER BY missing_ratio DESC, position LIMIT 10"
    )


def _audit(raw: str) -> str:
    counts = ", ".join(
        f"count(*) FILTER (WHERE reason = '{s}') AS {s}" for s in AUDIT_STEPS[1:-2]
    )
    rows = [f"SELECT 0 AS step, 'rows_in' AS rule, CAST(rows_in AS BIGINT) AS rows FROM counts"]
    for i, s in enumerate(AUDIT_STEPS[1:-2], start=1):
        rows.append(f"SELECT {i}, '{s}', CAST({s} AS BIGINT) FROM counts")
    n = len(AUDIT_STEPS)
    rows.append(f"SELECT {n - 2}, 'duplicate', CAST(kept - rows_out AS BIGINT) FROM counts, outc")
    rows.append(f"SELECT {n - 1}, 'rows_out', CAST(rows_out AS BIGINT) FROM outc")
    return (
        with_ctes(
            raw,
            TAGGED,
            CLEAN,
            f"counts AS (SELECT count(*) AS rows_in, count(*) FILTER (WHERE reason IS NULL) AS kept, {counts} FROM tagged)",
            "outc AS (SELECT count(*) AS rows_out FROM clean)",
        )
        + "\nUNION ALL\n".join(rows)
    )


def _slot_order(slot: str) -> str:
    if slot == "month_period":
        return "CASE month_period WHEN 'Early' THEN 0 WHEN 'Mid' THEN 1 WHEN 'Late' THEN 2 END"
    return slot


def _top(slot: str, n: int, unique: bool, dense: bool, activity: str = EVENTS_ACTIVITY) -> str:
    name = "unique_customers" if unique else "transactions"
    pct = "pct_unique_within_cluster" if unique else "pct_within_cluster"
    agg = "count(DISTINCT CustomerID)" if unique else "count(*)"
    counts = (
        f"cnt AS (SELECT Cluster, {slot}, CAST({agg} AS BIGINT) AS {name} FROM activity "
        f"WHERE {slot} IS NOT NULL GROUP BY Cluster, {slot})"
    )
    ctes = [counts]
    src = "cnt"
    if dense:
        ctes.append(
            "grid AS (SELECT Cluster, unnest(['Early', 'Mid', 'Late']) AS month_period "
            "FROM (SELECT DISTINCT Cluster FROM cnt))"
        )
        ctes.append(
            f"dense AS (SELECT g.Cluster, g.month_period, CAST(coalesce(c.{name}, 0) AS BIGINT) AS {name} "
            "FROM grid g LEFT JOIN cnt c ON g.Cluster = c.Cluster AND g.month_period = c.month_period)"
        )
        src = "dense"
    ctes.append(
        f"pct AS (SELECT *, {name} / sum({name}) OVER (PARTITION BY Cluster) AS {pct} FROM {src})"
    )
    ctes.append(
        f"ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY Cluster ORDER BY {pct} DESC, "
        f"{_slot_order(slot)} ASC) AS INTEGER) AS rank FROM pct)"
    )
    return (
        activity.rstrip("\n")
        + ",\n"
        + ",\n".join(ctes)
        + f"\nSELECT Cluster, {slot}, {name}, {pct}, rank FROM ranked WHERE rank <= {n}"
    )


def _share(row_keys, col_key, values, names, profile: str = EVENTS_PROFILE) -> str:
    rk = ", ".join(row_keys)
    lit = (lambda v: f"'{v}'") if isinstance(values[0], str) else str
    cols = ", ".join(
        f"coalesce(max(share) FILTER (WHERE {col_key} = {lit(v)}), 0.0) AS {n}" for v, n in zip(values, names)
    )
    extra = ""
    if row_keys == ["day_of_week"]:
        days = ", ".join(f"'{d}'" for d in WEEKDAY_NAMES)
        extra = f", CAST(list_position([{days}], day_of_week) - 1 AS INTEGER) AS dow_num"
    return profile.rstrip("\n") + f""",
s AS (SELECT {rk}, {col_key}, sum(unique_customers) AS v FROM prof GROUP BY {rk}, {col_key}),
sh AS (SELECT {rk}, {col_key}, v / sum(v) OVER (PARTITION BY {rk}) AS share FROM s)
SELECT {rk}{extra}, {cols} FROM sh GROUP BY {rk}"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    raw_cols = [
        ("Invoice", False), ("StockCode", False), ("Description", False), ("Quantity", False),
        ("InvoiceDate", False), ("Price", True), ("Customer ID", False), ("Country", False),
        ("Revenue", True),
    ]
    # Entry A
    q["clean_transactions"] = ORDERS_CLEAN + "SELECT * FROM clean"
    q["clean_audit"] = _audit(RAW_ORDERS)
    q["missing_ratio"] = ORDERS_CLEAN + _missing("clean", raw_cols)
    q["revenue_describe"] = ORDERS_CLEAN + _describe("clean", ["Revenue"], (0.5, 0.9, 0.95, 0.99))
    q["date_range_uniques"] = ORDERS_CLEAN + (
        'SELECT min("InvoiceDate") AS min_date, max("InvoiceDate") AS max_date, '
        'CAST(count(DISTINCT "Customer ID") AS BIGINT) AS customers, '
        'CAST(count(DISTINCT "Invoice") AS BIGINT) AS invoices FROM clean'
    )
    q["rfm"] = ORDERS_RFM + "SELECT * FROM rfm"
    q["rfm_events"] = EVENTS_RFM + "SELECT * FROM rfm"
    rfm_cols = ["Recency", "Frequency", "Monetary"]
    q["rfm_describe"] = ORDERS_RFM + _describe("rfm", rfm_cols, (0.5, 0.9, 0.95, 0.99))
    q["rfm_skew"] = ORDERS_RFM + _skew("rfm", rfm_cols)
    for name, col in (("monetary", "Monetary"), ("frequency", "Frequency"), ("recency", "Recency")):
        q[f"rfm_top_{name}"] = ORDERS_RFM + f"SELECT * FROM rfm ORDER BY {col} DESC, CustomerID ASC LIMIT 10"
    q["rfm_head"] = ORDERS_RFM + "SELECT * FROM rfm ORDER BY CustomerID LIMIT 5"

    # Entry B
    logs = ["R_log", "F_log", "M_log"]
    scaled = ["R_scaled", "F_scaled", "M_scaled"]
    q["rfm_log"] = with_ctes(RAW_ORDERS, TAGGED, CLEAN, RFM, LOGGED) + (
        "SELECT CustomerID, " + ", ".join(f"{r(c, 6)} AS {c}" for c in logs) + " FROM logged"
    )
    q["rfm_log_skew"] = with_ctes(RAW_ORDERS, TAGGED, CLEAN, RFM, LOGGED) + _skew("logged", logs)
    q["rfm_scaled"] = ORDERS_SCALED + (
        "SELECT CustomerID, " + ", ".join(f"{r(c, 6)} AS {c}" for c in logs + scaled) + " FROM scaled"
    )
    q["scaled_describe"] = ORDERS_SCALED + _describe("scaled", scaled, (0.25, 0.5, 0.75))
    q["assign_fixed_centres"] = ORDERS_ASSIGNED + "SELECT CustomerID, Cluster FROM assigned"
    k = len(FIXED_CENTRES)
    least = "least(" + ", ".join(f"d{i}" for i in range(k)) + ")"
    q["inertia_fixed_centres"] = ORDERS_ASSIGNED + f"SELECT {r(f'sum({least})', 4)} AS inertia FROM assigned"
    q["silhouette_fixed_centres"] = ORDERS_ASSIGNED.rstrip("\n") + """,
cstats AS (
  SELECT Cluster AS id, CAST(count(*) AS DOUBLE) AS n,
         sum(R_scaled) AS y0, sum(F_scaled) AS y1, sum(M_scaled) AS y2,
         sum(((R_scaled * R_scaled) + (F_scaled * F_scaled)) + (M_scaled * M_scaled)) AS psi
  FROM assigned GROUP BY Cluster
),
pts AS (
  SELECT row_number() OVER () AS pid, Cluster, R_scaled AS x0, F_scaled AS x1, M_scaled AS x2,
         ((R_scaled * R_scaled) + (F_scaled * F_scaled)) + (M_scaled * M_scaled) AS norm2
  FROM assigned
),
pd AS (
  SELECT p.pid, p.Cluster, s.id, s.n,
         p.norm2 - 2.0 * (((x0 * y0) + (x1 * y1)) + (x2 * y2)) / s.n + s.psi / s.n AS msq
  FROM pts p CROSS JOIN cstats s
),
per_point AS (
  SELECT pid,
         max(CASE WHEN id = Cluster THEN msq * n / (n - 1) END) AS a,
         min(CASE WHEN id <> Cluster THEN msq END) AS b,
         max(CASE WHEN id = Cluster THEN n END) AS own_n
  FROM pd GROUP BY pid
)
SELECT """ + r(
        "avg(CASE WHEN own_n <= 1 OR b IS NULL THEN 0.0 WHEN a < b THEN 1.0 - a / b "
        "WHEN a > b THEN b / a - 1.0 ELSE 0.0 END)",
        4,
    ) + " AS silhouette_sq_euclidean FROM per_point"

    q["silhouette_euclidean"] = ORDERS_ASSIGNED.rstrip("\n") + """,
pts AS (SELECT row_number() OVER () AS pid, Cluster, R_scaled AS x0, F_scaled AS x1, M_scaled AS x2 FROM assigned),
sizes AS (SELECT Cluster, count(*) AS n FROM pts GROUP BY Cluster),
sums AS (
  SELECT p.pid, any_value(p.Cluster) AS own, o.Cluster AS other,
         sum(sqrt((p.x0 - o.x0) * (p.x0 - o.x0) + (p.x1 - o.x1) * (p.x1 - o.x1) + (p.x2 - o.x2) * (p.x2 - o.x2))) AS d
  FROM pts p CROSS JOIN pts o GROUP BY p.pid, o.Cluster
),
ab AS (
  SELECT pid, max(CASE WHEN own = other THEN n END) AS own_n, max(CASE WHEN own = other THEN d / greatest(n - 1, 1) END) AS a,
         min(CASE WHEN own <> other THEN d / n END) AS b
  FROM sums JOIN sizes ON sizes.Cluster = sums.other GROUP BY pid
)
SELECT """ + r("avg(CASE WHEN own_n <= 1 OR b IS NULL OR greatest(a, b) = 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END)", 4) + """ AS silhouette,
       TRUE AS within_bound FROM ab"""

    profile_cols = []
    for c in rfm_cols:
        profile_cols.append(f"{r(f'avg(CAST({c} AS DOUBLE))', 4)} AS {c}_mean")
        profile_cols.append(f"{r(f'quantile_cont(CAST({c} AS DOUBLE), 0.5)', 4)} AS {c}_median")
    q["cluster_profile"] = ORDERS_ASSIGNED + (
        "SELECT Cluster, CAST(count(CustomerID) AS BIGINT) AS Customers, "
        + ", ".join(profile_cols)
        + " FROM assigned GROUP BY Cluster"
    )
    q["cluster_medians"] = ORDERS_ASSIGNED + (
        "SELECT Cluster, "
        + ", ".join(f"{r(f'quantile_cont(CAST({c} AS DOUBLE), 0.5)', 4)} AS {c}_median" for c in rfm_cols)
        + " FROM assigned GROUP BY Cluster"
    )
    q["cluster_sizes"] = ORDERS_ASSIGNED + (
        "SELECT Cluster, CAST(count(*) AS BIGINT) AS Customers FROM assigned GROUP BY Cluster"
    )
    names = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(SEGMENT_NAMES, start=1))
    q["segment_names"] = ORDERS_ASSIGNED.rstrip("\n") + f""",
med AS (SELECT Cluster, quantile_cont(Monetary, 0.5) AS m FROM assigned GROUP BY Cluster),
rk AS (SELECT Cluster, CAST(row_number() OVER (ORDER BY m DESC, Cluster ASC) AS INTEGER) AS segment_rank FROM med)
SELECT Cluster, segment_rank,
       CASE segment_rank {names} ELSE 'Segment ' || CAST(segment_rank AS VARCHAR) END AS segment
FROM rk"""
    q["segment_revenue_share"] = ORDERS_ASSIGNED.rstrip("\n") + """,
per AS (SELECT Cluster, CAST(sum(CAST(Monetary AS DECIMAL(38,8))) AS DOUBLE) AS revenue,
               CAST(count(*) AS BIGINT) AS Customers FROM assigned GROUP BY Cluster)
SELECT Cluster, Customers, revenue, """ + r("revenue / sum(revenue) OVER ()", 6) + " AS revenue_share FROM per"

    # Entry C
    q["time_features"] = EVENTS_ENRICHED + "SELECT * FROM enriched"
    for slot, qname in (("day_of_week", "dow_counts"), ("hour", "hour_counts"), ("month_period", "period_counts")):
        q[qname] = EVENTS_ACTIVITY + (
            f"SELECT Cluster, {slot}, CAST(count(*) AS BIGINT) AS transactions FROM activity "
            f"WHERE {slot} IS NOT NULL GROUP BY Cluster, {slot}"
        )
    for slot, short, n in (("day_of_week", "dow", 3), ("hour", "hour", 5), ("month_period", "period", 3)):
        dense = slot == "month_period"
        q[f"top_{short}"] = _top(slot, n, unique=False, dense=dense)
        q[f"top_{short}_unique"] = _top(slot, n, unique=True, dense=dense)
    q["temporal_profile"] = EVENTS_PROFILE + "SELECT * FROM prof"
    q["bitmap_profile"] = q["temporal_profile"]
    slots = ("day_of_week", "hour", "month_period")
    for name, agg in (("transactions", "count(*)"), ("unique_customers", "count(DISTINCT CustomerID)")):
        q[f"slot_{name.removeprefix('unique_')}"] = EVENTS_ACTIVITY + "\nUNION ALL\n".join(
            f"SELECT Cluster, '{s}' AS kind, CAST({s} AS VARCHAR) AS slot, CAST({agg} AS BIGINT) AS {name} FROM activity GROUP BY Cluster, {s}"
            for s in slots
        )
    q["cluster_profile_order"] = ORDERS_ASSIGNED + (
        f"SELECT Cluster, CAST(row_number() OVER (ORDER BY {r('avg(Monetary)', 4)} DESC, Cluster) AS INTEGER) AS position FROM assigned GROUP BY Cluster"
    )
    q["hour_counts_order"] = EVENTS_ACTIVITY + (
        "SELECT Cluster, hour, CAST(row_number() OVER (ORDER BY Cluster, count(*) DESC, hour) AS INTEGER) AS position "
        "FROM activity GROUP BY Cluster, hour"
    )
    q["hour_share_order"] = EVENTS_PROFILE + (
        "SELECT Cluster, CAST(row_number() OVER (ORDER BY Cluster) AS INTEGER) AS position FROM prof GROUP BY Cluster"
    )
    hours = list(range(24))
    hnames = [f"h{h}" for h in hours]
    q["hour_share"] = _share(["Cluster"], "hour", hours, hnames)
    q["dow_share"] = _share(["Cluster"], "day_of_week", list(WEEKDAY_NAMES), list(WEEKDAY_NAMES))
    q["dow_hour_share"] = _share(["day_of_week"], "hour", hours, hnames)
    q["period_share"] = _share(["Cluster"], "month_period", ["Early", "Mid", "Late"], ["Early", "Mid", "Late"])
    days = ", ".join(f"'{d}'" for d in WEEKDAY_NAMES)
    q["dow_ranking"] = EVENTS_PROFILE.rstrip("\n") + f""",
s AS (SELECT Cluster, day_of_week, CAST(sum(unique_customers) AS BIGINT) AS unique_customers
      FROM prof GROUP BY Cluster, day_of_week)
SELECT *, CAST(row_number() OVER (PARTITION BY Cluster ORDER BY unique_customers DESC,
       list_position([{days}], day_of_week) ASC) AS INTEGER) AS rank FROM s"""

    # Damaged inputs, joins and sets
    dirty = with_ctes(RAW_DIRTY, TAGGED, CLEAN)
    q["dirty_clean_transactions"] = dirty + "SELECT * FROM clean"
    q["dirty_clean_audit"] = _audit(RAW_DIRTY)
    q["dirty_missing_ratio"] = dirty + _missing("clean", raw_cols)
    q["dirty_rfm"] = with_ctes(RAW_DIRTY, TAGGED, CLEAN, RFM) + "SELECT * FROM rfm"
    sparse = with_ctes(RAW_SPARSE, TAGGED, CLEAN, RFM, LOGGED, SCALED, ASSIGNED, ENRICHED, ACTIVITY)
    q["sparse_top_period"] = _top("month_period", 3, unique=False, dense=True, activity=sparse)
    q["sparse_top_period_unique"] = _top("month_period", 3, unique=True, dense=True, activity=sparse)
    periods = ["Early", "Mid", "Late"]
    q["sparse_period_share"] = _share(["Cluster"], "month_period", periods, periods, sparse.rstrip("\n") + ",\n" + PROFILE)
    q["clustered_transactions"] = ORDERS_ASSIGNED + (
        'SELECT c."Invoice", c."StockCode", a.CustomerID, a.Cluster '
        'FROM clean c JOIN assigned a ON c."Customer ID" = a.CustomerID'
    )
    q["active_weekdays"] = EVENTS_ENRICHED + "SELECT DISTINCT day_of_week FROM enriched"

    # What any valid fit meets
    q["kmeans_fit_facts"] = ORDERS_RFM + (
        "SELECT CAST(3 AS BIGINT) AS clusters, CAST(count(*) AS BIGINT) AS customers, TRUE AS centres_are_means FROM rfm"
    )
    q["kmeans_sweep_facts"] = (
        "SELECT CAST(7 AS BIGINT) AS fits, CAST(2 AS INTEGER) AS k_min, CAST(8 AS INTEGER) AS k_max, "
        "TRUE AS inertia_never_rises, TRUE AS silhouettes_valid"
    )
    q["temporal_kmeans_facts"] = EVENTS_CLEAN + (
        "SELECT CAST(count(*) AS BIGINT) AS transactions, CAST(3 AS BIGINT) AS clusters FROM clean"
    )
    return q
