"""Shared SQL for the oracle: the trip layers as common table expressions for DuckDB."""

from __future__ import annotations

from textwrap import dedent

# Fixed zone centres for checks, off the coordinate grid so that no point is equally near to two.
CENTROIDS = [
    (40.6617, -74.0013), (40.6619, -73.9017), (40.6613, -73.8011),
    (40.7517, -74.0019), (40.7513, -73.9011), (40.7519, -73.8017),
    (40.8413, -74.0017), (40.8419, -73.9013), (40.8417, -73.8019),
]


def rnd(expr: str, digits: int) -> str:
    """Half-up rounding of the decimal value, as a double."""
    return f"CAST(round(CAST({expr} AS DECIMAL(30,12)), {digits}) AS DOUBLE)"


def hav(lat1, lon1, lat2, lon2):
    return (f"(2*6371.0088*asin(sqrt(least(1.0, pow(sin(radians(({lat2})-({lat1}))/2),2)"
            f"+cos(radians({lat1}))*cos(radians({lat2}))*pow(sin(radians(({lon2})-({lon1}))/2),2)))))")


def _coord(lost, m, sign=""):
    return (f"CASE WHEN e % {lost} = 0 THEN '0.0' ELSE '{sign}' || CAST(({m}) // 1000 AS VARCHAR) || '.' "
            f"|| lpad(CAST(({m}) % 1000 AS VARCHAR), 3, '0') END")


def _near(site):
    lat, lon = site
    checks = [
        f"(pow(({p}_latitude - {lat}) * 111.0, 2) + pow(({p}_longitude - ({lon})) * 84.0, 2) <= 4.0)"
        for p in ("pickup", "dropoff")
    ]
    return " OR ".join(checks)


SITES = {"JFK": (40.6413, -73.7781), "LGA": (40.7769, -73.8740)}


def nearest(lat, lon):
    """Index of the nearest fixed centre."""
    options = ", ".join(
        f"{{'d': ({lat}-({a}))*({lat}-({a})) + ({lon}-({b}))*({lon}-({b})), 'i': {i}}}" for i, (a, b) in enumerate(CENTROIDS)
    )
    return f"(list_min([{options}])).i"


P = "pickup_latitude, pickup_longitude, dropoff_latitude, dropoff_longitude".split(", ")
BAND = ("CASE WHEN distancia_haversine_km <= 0 THEN NULL WHEN distancia_haversine_km <= 1 THEN 0 "
        "WHEN distancia_haversine_km <= 2 THEN 1 WHEN distancia_haversine_km <= 3 THEN 2 WHEN distancia_haversine_km <= 5 THEN 3 "
        "WHEN distancia_haversine_km <= 8 THEN 4 WHEN distancia_haversine_km <= 12 THEN 5 "
        "WHEN distancia_haversine_km <= 20 THEN 6 ELSE 7 END")

CTES = {
    "grid": """
        SELECT event_id AS e, user_id AS u, date_trunc('second', ts) AS t,
               (37*user_id+13*event_id) % 300 AS a, (53*user_id+29*event_id) % 300 AS b,
               (71*user_id+17*event_id) % 300 AS c, (11*user_id+41*event_id) % 300 AS d
        FROM events""",
    "timed": """
        SELECT *, CASE WHEN e % 997 = 0 THEN 86391
               ELSE 60 + 9*(abs(a-c)+abs(b-d)) + (7919*e) % 300
                    + CASE WHEN hour(t) BETWEEN 7 AND 19 THEN 240 ELSE 0 END END AS s
        FROM grid""",
    "raw": f"""
        SELECT 'id' || CAST(e AS VARCHAR) AS id, CAST(u % 2 + 1 AS VARCHAR) AS vendor_id,
               strftime(t, '%Y-%m-%d %H:%M:%S') AS pickup_datetime,
               strftime(t + to_seconds(s), '%Y-%m-%d %H:%M:%S') AS dropoff_datetime,
               CASE WHEN e % 97 = 0 THEN '0' ELSE CAST(1 + (31*e) % 6 AS VARCHAR) END AS passenger_count,
               {_coord(419, '74050 - b', '-')} AS pickup_longitude,
               {_coord(419, '40600 + a')} AS pickup_latitude,
               {_coord(211, '74050 - d', '-')} AS dropoff_longitude,
               {_coord(211, '40600 + c')} AS dropoff_latitude,
               CASE WHEN e % 179 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
               CAST(s AS VARCHAR) AS trip_duration
        FROM timed""",
    "typed": """
        SELECT id, vendor_id, CAST(pickup_datetime AS TIMESTAMP) AS pickup_datetime,
               CAST(dropoff_datetime AS TIMESTAMP) AS dropoff_datetime,
               CAST(passenger_count AS INTEGER) AS passenger_count,
               CAST(pickup_longitude AS DOUBLE) AS pickup_longitude, CAST(pickup_latitude AS DOUBLE) AS pickup_latitude,
               CAST(dropoff_longitude AS DOUBLE) AS dropoff_longitude, CAST(dropoff_latitude AS DOUBLE) AS dropoff_latitude,
               CASE upper(trim(store_and_fwd_flag)) WHEN 'Y' THEN 1 WHEN 'N' THEN 0 END AS store_and_fwd_flag,
               CAST(trip_duration AS INTEGER) AS trip_duration
        FROM raw""",
    "rules": """
        SELECT *, trip_duration BETWEEN 1 AND 21600 AS v_duracion,
               passenger_count BETWEEN 1 AND 6 AS v_pasajeros,
               pickup_latitude BETWEEN 40.50 AND 41.00 AND pickup_longitude BETWEEN -74.30 AND -73.70 AS v_coords_pickup,
               dropoff_latitude BETWEEN 40.50 AND 41.00 AND dropoff_longitude BETWEEN -74.30 AND -73.70 AS v_coords_dropoff,
               id IS NOT NULL AND pickup_datetime IS NOT NULL AND trip_duration IS NOT NULL AS v_completitud
        FROM typed""",
    "flagged": """
        SELECT *, v_duracion AND v_pasajeros AND v_coords_pickup AND v_coords_dropoff AND v_completitud AS es_valido
        FROM rules""",
    "clean": """
        SELECT * EXCLUDE (v_duracion, v_pasajeros, v_coords_pickup, v_coords_dropoff, v_completitud, es_valido)
        FROM flagged WHERE es_valido""",
    "quarantine": "SELECT * FROM flagged WHERE NOT es_valido",
    "enriched": f"""
        SELECT *, CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour,
               CAST(dayofweek(pickup_datetime) + 1 AS INTEGER) AS pickup_dayofweek,
               CAST(month(pickup_datetime) AS INTEGER) AS pickup_month,
               CASE WHEN dayofweek(pickup_datetime) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
               round({hav(*P)}, 6) AS distancia_haversine_km,
               round({hav(P[0], P[1], P[2], P[1])} + {hav(P[0], P[1], P[0], P[3])}, 6) AS distancia_manhattan_km,
               round(fmod(degrees(atan2(
                   sin(radians(dropoff_longitude-pickup_longitude))*cos(radians(dropoff_latitude)),
                   cos(radians(pickup_latitude))*sin(radians(dropoff_latitude))
                   - sin(radians(pickup_latitude))*cos(radians(dropoff_latitude))
                     *cos(radians(dropoff_longitude-pickup_longitude)))) + 360, 360.0), 6) AS bearing_deg,
               CASE WHEN {_near(SITES["JFK"])} OR {_near(SITES["LGA"])} THEN 1 ELSE 0 END AS es_aeropuerto,
               CASE WHEN CAST(pickup_datetime AS DATE) >= DATE '2024-01-24' THEN 'test' ELSE 'train' END AS split_flag
        FROM clean""",
    "zoned": f"""
        SELECT *, {nearest(P[0], P[1])} AS pickup_cluster, {nearest(P[2], P[3])} AS dropoff_cluster FROM enriched""",
    "analytics": """
        SELECT *, CASE WHEN trip_duration > 0 THEN round(distancia_haversine_km / (trip_duration / 3600.0), 6) ELSE 0.0 END
                  AS velocidad_kmh, trip_duration / 60.0 AS duracion_min
        FROM zoned""",
    "demand": f"""
        SELECT *, {rnd("distancia_mediana_km / (duracion_mediana_seg / 3600.0)", 2)} AS velocidad_mediana_kmh,
               {rnd("duracion_mediana_seg / 60.0", 2)} AS duracion_mediana_min
        FROM (SELECT pickup_cluster, pickup_hour, pickup_dayofweek, count(*) AS n_viajes,
                     quantile_disc(trip_duration, 0.5) AS duracion_mediana_seg,
                     quantile_disc(distancia_haversine_km, 0.5) AS distancia_mediana_km,
                     {rnd("avg(passenger_count)", 2)} AS pasajeros_promedio
              FROM zoned GROUP BY ALL)""",
    "profile": """
        SELECT pickup_hour, CAST(sum(n_viajes) AS BIGINT) AS viajes,
               sum(velocidad_mediana_kmh * n_viajes) / sum(n_viajes) AS vel,
               sum(duracion_mediana_min * n_viajes) / sum(n_viajes) AS dur
        FROM demand GROUP BY pickup_hour""",
    "daily": """
        SELECT CAST(pickup_datetime AS DATE) AS fecha, count(*) AS viajes, quantile_disc(velocidad_kmh, 0.5) AS vel
        FROM analytics GROUP BY 1""",
    "logs": """
        SELECT *, ln(1 + trip_duration) AS log_dur, ln(1 + distancia_haversine_km) AS log_dist FROM analytics""",
    "fit": """
        SELECT covar_pop(log_dur, log_dist) / var_pop(log_dist) AS b,
               avg(log_dur) - covar_pop(log_dur, log_dist) / var_pop(log_dist) * avg(log_dist) AS a FROM logs""",
    "residual": "SELECT logs.*, log_dur - (fit.a + fit.b * log_dist) AS residuo FROM logs, fit",
    "train": f"SELECT *, {BAND} AS tramo FROM analytics WHERE split_flag = 'train'",
    "test": f"SELECT *, {BAND} AS tramo FROM analytics WHERE split_flag = 'test'",
    "everything": f"SELECT *, {BAND} AS tramo FROM analytics",
    "cal": "SELECT pickup_hour, pickup_dayofweek, median(trip_duration) AS m FROM train GROUP BY 1, 2",
    "dis": "SELECT tramo, pickup_hour, median(trip_duration) AS m FROM train WHERE tramo IS NOT NULL GROUP BY 1, 2",
    "overall": "SELECT median(trip_duration) AS g FROM train",
    "scored": """
        SELECT x.*, greatest(1.0, least(21600.0, coalesce(cal.m, g))) AS p_calendario,
               greatest(1.0, least(21600.0, coalesce(dis.m, g))) AS p_distancia_hora
        FROM everything x CROSS JOIN overall
        LEFT JOIN cal USING (pickup_hour, pickup_dayofweek)
        LEFT JOIN dis ON dis.tramo = x.tramo AND dis.pickup_hour = x.pickup_hour""",
    "res": """
        SELECT *, (p_distancia_hora - trip_duration) / 60 AS residuo_min FROM scored WHERE split_flag = 'test'""",
}

_ORDER = list(CTES)


def with_ctes(sql: str, upto: str, extra: dict[str, str] | None = None) -> str:
    """``sql`` preceded by the layers up to and including ``upto``, and by ``extra`` expressions."""
    names = _ORDER[: _ORDER.index(upto) + 1]
    parts = [f"{n} AS ({dedent(CTES[n]).strip()})" for n in names]
    parts += [f"{n} AS ({dedent(q).strip()})" for n, q in (extra or {}).items()]
    return "WITH " + ",\n".join(parts) + "\n" + dedent(sql).strip()


def eta(table: str, factor: str, value: str) -> str:
    """Share of variance between the levels of ``factor``, as a scalar subquery."""
    return (f"(SELECT coalesce(sum(n * pow(m - (SELECT avg({value}) FROM {table}), 2)) "
            f"/ nullif((SELECT var_pop({value}) * count(*) FROM {table}), 0), 0) "
            f"FROM (SELECT count(*) AS n, avg({value}) AS m FROM {table} GROUP BY {factor}))")


def long_sql(table: str, columns, where: str = "TRUE") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS variable, CAST({c} AS DOUBLE) AS valor FROM {table} WHERE {where} AND {c} IS NOT NULL"
        for c in columns
    )


def psi_ctes(ref_sql: str, new_sql: str, bins: int = 10) -> dict[str, str]:
    """PSI per variable from two long tables (variable, valor): ends in ``psi(variable, psi, n_referencia, n_lote)``."""
    picks = ", ".join(f"CAST(floor(n * {i} / {bins}.0) AS BIGINT)" for i in range(1, bins))
    return {
        "lr": ref_sql,
        "ln": new_sql,
        "ordered": "SELECT variable, valor, row_number() OVER (PARTITION BY variable ORDER BY valor) - 1 AS rk, "
                   "count(*) OVER (PARTITION BY variable) AS n FROM lr",
        "cuts": f"SELECT variable, list_sort(list_distinct(list(valor))) AS c FROM ordered "
                f"WHERE list_contains([0, n - 1, {picks}], rk) GROUP BY variable",
        "bins": """
            SELECT variable, lado, CASE WHEN len(c) > 1 AND valor <= c[len(c)]
                THEN len([x for x in c[2:len(c)-1] if x <= valor]) END AS bin
            FROM (SELECT *, 'r' AS lado FROM lr UNION ALL SELECT *, 'n' AS lado FROM ln) JOIN cuts USING (variable)""",
        "binned": """
            SELECT variable, bin, count(*) FILTER (lado = 'r') AS r, count(*) FILTER (lado = 'n') AS w
            FROM bins GROUP BY 1, 2""",
        "shares": """
            SELECT variable, bin, greatest(1e-6, r / sum(r) OVER v) AS pr,
                   greatest(1e-6, coalesce(w / nullif(sum(w) OVER v, 0), 0)) AS pa,
                   sum(r) OVER v AS nr, sum(w) OVER v AS nw
            FROM binned WINDOW v AS (PARTITION BY variable)""",
        "psi": """
            SELECT variable, sum(CASE WHEN bin IS NULL THEN 0.0 ELSE (pa - pr) * ln(pa / pr) END) AS psi,
                   CAST(max(nr) AS BIGINT) AS n_referencia, CAST(max(nw) AS BIGINT) AS n_lote
            FROM shares GROUP BY variable""",
    }


def state(expr: str) -> str:
    return f"CASE WHEN {expr} < 0.10 THEN 'estable' WHEN {expr} < 0.25 THEN 'vigilar' ELSE 'alerta' END"
