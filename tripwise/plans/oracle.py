"""Independent DuckDB SQL for every SQL-expressible registered query.

Each statement is the plain, unfused definition (one group-by per block, joins,
windows over whole partitions): a check of the fused Spark plans, not a copy.
All statements start from the driver-generated tables; ``t`` is the telemetry
view of FIXTURES.md, derived from ``events``.
"""

from __future__ import annotations

from tripwise.config import ANCHOR_LAT, ANCHOR_LON, EARTH_RADIUS_KM

TELEMETRY_CTE = """t AS (
  SELECT user_id AS terminalno,
         CAST(floor(epoch(ts)) AS BIGINT) AS time,
         CAST(datediff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS BIGINT) AS trip_id,
         113.5::DOUBLE + ((event_id * 7919) % 10000) / 10000.0::DOUBLE AS longitude,
         22.3::DOUBLE + ((event_id * 104729) % 10000) / 20000.0::DOUBLE AS latitude,
         CAST(json_extract_string(props, '$.k') AS INTEGER) * 3.6::DOUBLE AS direction,
         ((event_id * 37) % 1000) / 10.0::DOUBLE AS height,
         CASE WHEN isnan(value) THEN NULL ELSE value END AS speed,
         CAST(CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'signup' THEN 2
                              WHEN 'purchase' THEN 3 WHEN 'error' THEN 4 END AS INTEGER) AS callstate,
         CASE WHEN user_id % 5 = 0 THEN NULL
              ELSE CAST(greatest(0, (user_id * 37) % 11 - 6) AS DOUBLE) * 0.5::DOUBLE END AS y,
         event_id AS seq,
         CASE WHEN user_id % 5 = 0 THEN 'test' ELSE 'train' END AS split,
         hour(ts) AS hr,
         isodow(ts) - 1 AS wd
  FROM events)"""


def hav(lon: str, lat: str) -> str:
    """Haversine metres to the fixed anchor, in DuckDB SQL."""
    return (
        f"(2 * {EARTH_RADIUS_KM * 1000.0}::DOUBLE * asin(sqrt("
        f"pow(sin((radians({ANCHOR_LAT}::DOUBLE) - radians({lat})) / 2), 2) + "
        f"cos(radians({lat})) * cos(radians({ANCHOR_LAT}::DOUBLE)) * "
        f"pow(sin((radians({ANCHOR_LON}::DOUBLE) - radians({lon})) / 2), 2))))"
    )


ORDER_TELEMETRY_CTE = """t AS (
  SELECT o.o_custkey AS terminalno,
         CAST(floor(epoch(CAST(l.l_shipdate AS TIMESTAMP))) AS BIGINT) + (l.l_partkey * 37) % 86400 AS time,
         l.l_orderkey AS trip_id,
         113.5::DOUBLE + (l.l_partkey % 10000) / 10000.0::DOUBLE AS longitude,
         22.3::DOUBLE + (l.l_suppkey % 100) / 200.0::DOUBLE AS latitude,
         l.l_discount * 3600.0::DOUBLE AS direction,
         l.l_tax * 1000.0::DOUBLE AS height,
         CASE WHEN isnan(l.l_quantity) THEN NULL ELSE l.l_quantity END AS speed,
         CAST(l.l_linenumber % 5 AS INTEGER) AS callstate,
         CASE WHEN o.o_custkey % 5 = 0 THEN NULL
              ELSE CAST(greatest(0, (o.o_custkey * 37) % 11 - 6) AS DOUBLE) * 0.5::DOUBLE END AS y,
         l.l_orderkey * 8 + l.l_linenumber AS seq,
         CASE WHEN o.o_custkey % 5 = 0 THEN 'test' ELSE 'train' END AS split,
         hour(to_timestamp(CAST(floor(epoch(CAST(l.l_shipdate AS TIMESTAMP))) AS BIGINT) + (l.l_partkey * 37) % 86400)
              AT TIME ZONE 'UTC') AS hr,
         isodow(to_timestamp(CAST(floor(epoch(CAST(l.l_shipdate AS TIMESTAMP))) AS BIGINT) + (l.l_partkey * 37) % 86400)
              AT TIME ZONE 'UTC') - 1 AS wd
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


def with_t(body: str, *ctes: str, telemetry: str = TELEMETRY_CTE) -> str:
    return "WITH " + ",\n".join((telemetry,) + ctes) + "\n" + body


def nudge(dp: int) -> float:
    """Offset added before rounding to ``dp`` decimals, on both engines.

    Exact decimals with at most dp+3 places (means of 2-decimal speeds over 64
    rows, variances over 5 rows, ...) would otherwise sit exactly on a rounding
    tie, where last-bit differences of the two engines' sums pick different
    sides.  With the offset, such values are at least this far from any
    boundary, far above the float error of either engine.
    """
    return 3.0 * 10.0 ** -(dp + 4)


def rounded(inner: str, keep: list[str], d6: list[str] = (), d3: list[str] = (), d4: list[str] = ()) -> str:
    """Outer projection rounding doubles exactly like ``present`` does in Spark."""
    cols = [f"q.{c}" for c in keep]
    for dp, names in ((6, d6), (4, d4), (3, d3)):
        cols += [f"round(q.{c} + {nudge(dp)!r}::DOUBLE, {dp}) + 0.0::DOUBLE AS {c}" for c in names]
    return f"SELECT {', '.join(cols)}\nFROM (\n{inner}\n) q"


def decimals(name: str) -> int:
    """Presentation precision of a double column."""
    if name in METRES:
        return 3
    if name in COARSE:
        return 4
    return 6


def rounded_auto(inner: str, cols: list[str]) -> str:
    """``rounded`` with the precision of every non-integral column taken from ``decimals``."""
    return rounded(
        inner,
        keep=[c for c in cols if c in INTEGRAL or c in KEEP],
        d6=[c for c in cols if c not in INTEGRAL and c not in KEEP and decimals(c) == 6],
        d4=[c for c in cols if c not in INTEGRAL and c not in KEEP and decimals(c) == 4],
        d3=[c for c in cols if c not in INTEGRAL and c not in KEEP and decimals(c) == 3],
    )


# ---------------------------------------------------------------------------
# per-block driver statistics, block by block (the original's shape)

K = "split, terminalno"
HOURS = [f"hour{h}" for h in range(24)]
WEEKDAYS = ["mon", "tue", "wed", "thu", "fri", "sat", "sun"]


def _share(cond: str) -> str:
    return f"avg(CASE WHEN {cond} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)"


TRIP_CTE = f"""trip AS (
  SELECT {K}, trip_id,
         coalesce(var_samp(direction), 0.0::DOUBLE) AS dv,
         coalesce(var_samp(height), 0.0::DOUBLE) AS hv,
         max(time) - min(time) AS dur,
         max(wd) AS wdm
  FROM t GROUP BY {K}, trip_id)"""

ACC_CTE = f"""acc AS (
  SELECT {K},
         coalesce(speed - lag(speed) OVER (PARTITION BY {K}, trip_id ORDER BY time NULLS FIRST, seq),
                  0.0::DOUBLE) AS a
  FROM t)"""

BLOCK_SQL = {
    "speed": f"SELECT {K}, max(speed) AS speed_max, avg(speed) AS speed_mean FROM t GROUP BY {K}",
    "direction": f"SELECT {K}, max(dv) AS direction_var_max, avg(dv) AS direction_var_mean FROM trip GROUP BY {K}",
    "call": f"SELECT {K}, " + ", ".join(f"{_share(f'callstate = {k}')} AS count{k}" for k in range(5))
            + f" FROM t GROUP BY {K}",
    "height": f"SELECT {K}, avg(height) AS height_mean FROM t GROUP BY {K}",
    "height_trip": f"SELECT {K}, max(hv) AS height_var_max, avg(hv) AS height_var_mean FROM trip GROUP BY {K}",
    "hour": f"SELECT {K}, " + ", ".join(f"{_share(f'hr = {h}')} AS hour{h}" for h in range(24))
            + f" FROM t GROUP BY {K}",
    "gps": f"""SELECT {K}, max(height) AS height_max, min(height) AS height_min,
                max(longitude) AS lon_max, min(longitude) AS lon_min,
                max(latitude) AS lat_max, min(latitude) AS lat_min,
                avg(latitude) AS lat_mean, avg(longitude) AS lon_mean,
                avg({hav('longitude', 'latitude')}) AS dis_mean,
                min({hav('longitude', 'latitude')}) AS dis_min,
                max({hav('longitude', 'latitude')}) AS dis_max
         FROM t GROUP BY {K}""",
    "trips": f"SELECT {K}, max(trip_id) AS trip_max FROM t GROUP BY {K}",
    "weekday": f"SELECT {K}, " + ", ".join(f"{_share(f'wdm = {k}')} AS {d}" for k, d in enumerate(WEEKDAYS))
               + f" FROM trip GROUP BY {K}",
    "acc": f"""SELECT {K}, max(a) AS max_acc, min(a) AS min_acc, avg(a) AS mean_acc,
                coalesce(var_samp(a), 0.0::DOUBLE) AS var_acc FROM acc GROUP BY {K}""",
    "duration": f"SELECT {K}, max(dur) AS time_duration_max, avg(dur) AS time_duration_mean FROM trip GROUP BY {K}",
    "label": f"SELECT {K}, max(y) AS y FROM t GROUP BY {K}",
    "smoothed": f"""SELECT {K}, """ + ", ".join(
        f"CAST(count_if(callstate = {k}) AS DOUBLE) / CAST(count(*) - count_if(callstate = 0) + 1 AS DOUBLE) AS count{k}_s"
        for k in (1, 2, 3)) + f" FROM t GROUP BY {K}",
}

BLOCK_COLUMNS = {
    "speed": ["speed_max", "speed_mean"],
    "direction": ["direction_var_max", "direction_var_mean"],
    "call": [f"count{k}" for k in range(5)],
    "height": ["height_mean"],
    "height_trip": ["height_var_max", "height_var_mean"],
    "hour": HOURS,
    "gps": ["height_max", "height_min", "lon_max", "lon_min", "lat_max", "lat_min", "lat_mean", "lon_mean",
            "dis_mean", "dis_min", "dis_max"],
    "trips": ["trip_max"],
    "weekday": WEEKDAYS,
    "acc": ["max_acc", "min_acc", "mean_acc", "var_acc"],
    "duration": ["time_duration_max", "time_duration_mean"],
    "label": ["y"],
    "smoothed": ["count1_s", "count2_s", "count3_s"],
}

INTEGRAL = {"trip_max", "time_duration_max", "num_of_trips", "num_of_records", "n_rows", "n_trips",
            "terminalno", "trip_id", "first_seq", "fold", "rank", "n_drivers", "n_zero", "n_positive",
            "time", "seq", "callstate", "driver_count", "n", "rows", "drivers", "trips", "k", "Id",
            "test_id", "train_id", "hr", "wd", "feature_index", "selected_rank", "nb", "left_rows", "held_fold",
            "n_rejected"}
KEEP = {"split", "feature", "name", "metric", "side", "holdout", "within_bound", "kind"}
# metres: 3 dp; variance-type values (float error up to ~1e-10): 4 dp; the rest 6 dp
METRES = {"dis_mean", "dis_min", "dis_max", "dis", "hdis", "start_dis"}
COARSE = {"direction_var_max", "direction_var_mean", "direction_var_min", "height_var_max", "height_var_mean",
          "var_acc", "var_speed", "time_duration_mean", "dv", "hv", "f_score", "pred_var_samp",
          "pred_var_pop", "r", "dist", "radius", "gain"}


def blocks_sql(blocks: list[str], columns: list[str] | None = None, telemetry: str = TELEMETRY_CTE) -> str:
    """Join of the named blocks on the driver key, rounded like the Spark side."""
    ctes = [TRIP_CTE, ACC_CTE]
    ctes += [f"b_{b} AS ({BLOCK_SQL[b]})" for b in blocks]
    first = f"b_{blocks[0]}"
    joins = " ".join(f"JOIN b_{b} USING ({K})" for b in blocks[1:])
    cols = columns or [c for b in blocks for c in BLOCK_COLUMNS[b]]
    inner = with_t(f"SELECT {K}, {', '.join(cols)} FROM {first} {joins}", *ctes, telemetry=telemetry)
    return rounded_auto(inner, ["split", "terminalno"] + cols)


FEATURE_BLOCKS = {
    "61": ["speed", "direction", "call", "height", "height_trip", "hour", "gps", "trips", "weekday", "acc",
           "duration", "label"],
    "42": ["speed", "direction", "call", "height", "height_trip", "hour", "gps", "trips", "label"],
    "7": ["speed", "direction", "smoothed", "label"],
}


def feature_ctes(name: str, feature_set: str, columns: list[str]) -> list[str]:
    """CTEs defining ``name`` = (split, terminalno, columns..., y) from the blocks of a set."""
    blocks = FEATURE_BLOCKS[feature_set]
    ctes = [TRIP_CTE, ACC_CTE] + [f"b_{b} AS ({BLOCK_SQL[b]})" for b in blocks]
    joins = " ".join(f"JOIN b_{b} USING ({K})" for b in blocks[1:])
    ctes.append(f"{name} AS (SELECT {K}, {', '.join(columns)}, y FROM b_{blocks[0]} {joins})")
    return ctes


def holdout_sql(key: str, seed: int, fraction: float) -> str:
    """Same bucket as ``split.hash_bucket``: md5('seed:key'), first 8 hex digits, in millionths."""
    return (f"((('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8))::BIGINT % 1000000) "
            f"< {int(round(fraction * 1000000))})")


def _shrunk_score(g: str, h: str, l1: float, l2: float) -> str:
    t = f"greatest(abs({g}) - {l1}::DOUBLE, 0.0::DOUBLE)"
    return f"({t} * {t} / ({h} + {l2}::DOUBLE))"


def split_ctes(name: str, rows: str, features: list[str], p, best_per: str = "node") -> list[str]:
    """``name`` = each node's best split by definition: (node, f, cut, gain, gl, hl, g, h).

    ``rows`` selects (terminalno, node, r) with r = prediction - label; the values are in
    ``lx`` (terminalno, f, x), all values of the fitted rows in ``cuts`` (f, x, cut).
    """
    over = "OVER (PARTITION BY node, f ORDER BY x)"
    gain = (f"{_shrunk_score('gl', 'hl', p.l1, p.l2)} + {_shrunk_score('(g - gl)', '(h - hl)', p.l1, p.l2)} - "
            f"{_shrunk_score('g', 'h', p.l1, p.l2)}")
    return [
        f"{name}_s AS (SELECT node, f, x, sum(r) AS sr, count(*) AS n FROM ({rows}) JOIN lx USING (terminalno) GROUP BY node, f, x)",
        f"{name}_p AS (SELECT node, f, x, sum(sr) {over} AS gl, sum(n) {over} AS hl, sum(sr) OVER (PARTITION BY node, f) AS g, "
        f"sum(n) OVER (PARTITION BY node, f) AS h FROM {name}_s)",
        f"{name}_g AS (SELECT node, f, cut, round({gain}, 9) AS gain, gl, hl, g, h FROM {name}_p JOIN cuts USING (f, x) "
        f"WHERE hl >= {p.min_child} AND h - hl >= {p.min_child})",
        f"{name} AS (SELECT * FROM {name}_g WHERE gain > 1e-6 "
        f"QUALIFY row_number() OVER (PARTITION BY {best_per} ORDER BY gain DESC, f, cut) = 1)",
    ]


def boosted_ctes(features: list[str], p, feat: str = "feat") -> list[str]:
    """``boosted`` (terminalno, split, y, margin): ``p.rounds`` level-wise trees of ``p.max_depth`` fitted on the train rows.

    Every round and level is spelt out: residuals, best splits, rows moved to their child,
    leaf values.  ``feat`` has (split, terminalno, features, y).
    """
    long = " UNION ALL ".join(f"SELECT terminalno, split, {i} AS f, coalesce({c}, 0)::DOUBLE AS x FROM {feat}" for i, c in enumerate(features))
    ctes = [f"lx AS ({long})",
            "cuts AS (SELECT f, x, x + (lead(x) OVER (PARTITION BY f ORDER BY x) - x) / 2 AS cut "
            "FROM (SELECT DISTINCT f, x FROM lx WHERE split = 'train') QUALIFY cut IS NOT NULL)",
            f"b0 AS (SELECT terminalno, split, y, {p.base}::DOUBLE AS margin FROM {feat})"]
    for r in range(p.rounds):
        ctes.append(f"n{r}_0 AS (SELECT *, 0 AS node FROM b{r})")
        for d in range(p.max_depth):
            here = f"n{r}_{d}"
            ctes += split_ctes(f"s{r}_{d}", f"SELECT terminalno, node, margin - y AS r FROM {here} WHERE split = 'train'", features, p)
            ctes.append(f"n{r}_{d + 1} AS (SELECT n.terminalno, n.split, n.y, n.margin, CASE WHEN s.f IS NULL THEN n.node "
                        f"WHEN l.x < s.cut THEN 2 * n.node + 1 ELSE 2 * n.node + 2 END AS node FROM {here} n "
                        f"LEFT JOIN s{r}_{d} s ON s.node = n.node LEFT JOIN lx l ON l.terminalno = n.terminalno AND l.f = s.f "
                        "AND l.split = n.split)")
        last = f"n{r}_{p.max_depth}"
        weight = (f"-{p.eta}::DOUBLE * sign(g) * greatest(abs(g) - {p.l1}::DOUBLE, 0.0::DOUBLE) / (h + {p.l2}::DOUBLE)")
        ctes.append(f"w{r} AS (SELECT node, {weight} AS w FROM (SELECT node, sum(margin - y) AS g, count(*) AS h FROM {last} "
                    "WHERE split = 'train' GROUP BY node))")
        ctes.append(f"b{r + 1} AS (SELECT terminalno, split, y, margin + w AS margin FROM {last} JOIN w{r} USING (node))")
    return ctes + [f"boosted AS (SELECT * FROM b{p.rounds})"]


def knn_ctes(feat: str, features: list[str], k: int, train_filter: str = "split = 'train'",
             test_filter: str = "split = 'test'") -> list[str]:
    """Brute-force k-NN over all (test, train) pairs of the feature CTE ``feat``."""
    dist = " + ".join(f"(coalesce(q.{c}, 0.0::DOUBLE) - coalesce(r.{c}, 0.0::DOUBLE)) * "
                      f"(coalesce(q.{c}, 0.0::DOUBLE) - coalesce(r.{c}, 0.0::DOUBLE))" for c in features)
    return [
        f"knn_all AS (SELECT q.terminalno AS test_id, r.terminalno AS train_id, r.y AS label, sqrt({dist}) AS dist "
        f"FROM (SELECT * FROM {feat} WHERE {test_filter}) q, (SELECT * FROM {feat} WHERE {train_filter}) r)",
        f"knn_top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY test_id ORDER BY dist, train_id) - 1 "
        f"AS nb FROM knn_all) WHERE nb < {k})",
        "knn_pred AS (SELECT test_id AS terminalno, CASE WHEN count_if(dist = 0) > 0 "
        "THEN avg(CASE WHEN dist = 0 THEN label END) "
        "ELSE sum(CASE WHEN dist <> 0 THEN label / dist END) / sum(CASE WHEN dist <> 0 THEN 1.0 / dist END) END "
        "AS pred FROM knn_top GROUP BY test_id)",
    ]
