"""The additive model as SQL: features, normal equations, elimination, prediction."""

DAY_MICROS = 86_400_000_000
WAVES, BENDS = 6, 5


def _features():
    bends = [
        f"CASE WHEN cps >= {k} THEN greatest(t - 0.8::DOUBLE * {k} / (cps + 1), 0) ELSE 0 END"
        for k in range(1, BENDS + 1)
    ]
    waves = [
        f"CASE WHEN daily THEN {wave}(phase * {k}) ELSE 0 END"
        for k in range(1, WAVES + 1)
        for wave in ("sin", "cos")
    ]
    scaled = "CASE WHEN use_x THEN (coalesce(x, x_mean) - x_mean) / x_std ELSE 0 END"
    return ", ".join(f"({part})::DOUBLE" for part in ["1", "t", *bends, *waves, scaled])


def additive_sql(source, step_micros, digits=3, periods=30):
    """Forecast rows of `source` (series_key, ds, y, x), history included."""
    ridge = [1e-9, 1e-6, *[1.0] * BENDS, *[1e-2] * (2 * WAVES), 1e-6]
    size = len(ridge)
    ratio = "CASE WHEN n < 20 THEN 0.9 WHEN n < 50 THEN 0.85 ELSE 0.8 END"
    return f"""
    WITH RECURSIVE s AS ({source}),
    num AS (SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY ds) - 1 AS idx,
                   count(*) OVER (PARTITION BY series_key) AS n FROM s),
    cut AS (SELECT *, greatest(floor(n * CAST({ratio} AS DOUBLE)), least(10, n))::BIGINT AS train FROM num),
    p AS (SELECT series_key, any_value(n) AS n, min(epoch_us(ds)) AS t0, max(ds) AS last_ds,
                 max(epoch_us(ds)) FILTER (idx = train - 1) AS train_end,
                 max(x) FILTER (idx = n - 1) AS x_last, avg(x) FILTER (idx < train) AS x_mean,
                 stddev_samp(x) AS x_std, any_value(train) AS train
          FROM cut GROUP BY 1),
    c AS (SELECT *, CASE WHEN n < 20 THEN 1 WHEN n < 50 THEN 2 ELSE 5 END AS cps, n >= 50 AS daily,
                 coalesce(x_std > 0.01, false) AS use_x,
                 greatest(train_end - t0, 1)::DOUBLE AS span FROM p),
    rows_ AS (SELECT series_key, ds, y, x, idx, false AS is_future FROM cut
              UNION ALL
              SELECT series_key, make_timestamp(epoch_us(last_ds) + k * {step_micros}), NULL, x_last, NULL, true
              FROM c, range(1, {periods + 1}) AS r(k)),
    u AS (SELECT rows_.*, c.* EXCLUDE (series_key), (epoch_us(ds) - t0) / span AS t,
                 (epoch_us(ds) % {DAY_MICROS}) * (2 * pi() / {DAY_MICROS}.0::DOUBLE) AS phase
          FROM rows_ JOIN c USING (series_key)),
    f AS (SELECT series_key, ds, is_future, idx < train AS fitted, [{_features()}] AS f, y FROM u),
    g AS (SELECT series_key, i, j, sum(f[i] * CASE WHEN j > {size} THEN y ELSE f[j] END) AS v
          FROM f, range(1, {size + 1}) AS a(i), range(1, {size + 2}) AS b(j)
          WHERE fitted AND y IS NOT NULL GROUP BY ALL),
    line AS (SELECT series_key, i, list(v + CASE WHEN i = j THEN {ridge}[i] ELSE 0 END ORDER BY j) AS r
             FROM g GROUP BY ALL),
    solve AS (
      SELECT series_key, 1 AS k, list(r ORDER BY i) AS m FROM line GROUP BY series_key
      UNION ALL
      SELECT series_key, k + 1, list_transform(range(1, {size + 1}), lambda i: list_transform(
               range(1, {size + 2}), lambda j: CASE WHEN i = k THEN m[k][j] / m[k][k]
                 ELSE m[i][j] - m[i][k] / m[k][k] * m[k][j] END))
      FROM solve WHERE k <= {size}),
    model AS (SELECT series_key, list_transform(m, lambda r: r[{size + 1}]) AS w
              FROM solve WHERE k = {size + 1})
    SELECT series_key, strftime(ds, '%Y-%m-%dT%H:%M:%S') AS ds,
           round(list_sum(list_transform(range(1, {size + 1}), lambda i: w[i] * f[i])) + 1e-5, {digits}) AS yhat,
           is_future
    FROM f JOIN model USING (series_key)
    """
