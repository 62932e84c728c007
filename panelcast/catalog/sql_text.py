"""SQL fragments shared by the expected-result queries."""

ORDER_SUM = "sum(cast(o_totalprice AS decimal(18,2)))"
NET = "cast(l_extendedprice AS decimal(12,2)) * (cast(1 AS decimal(3,2)) - cast(l_discount AS decimal(3,2)))"

# The label of each frequency for a timestamp column named {d}.
PERIOD_SQL = {
    "MS": "cast(date_trunc('month', {d}) AS date)",
    "QS": "cast(date_trunc('quarter', {d}) AS date)",
    "YS": "cast(date_trunc('year', {d}) AS date)",
    "M": "last_day(cast({d} AS date))",
    "Q": "last_day(cast(date_trunc('quarter', {d}) AS date) + INTERVAL 2 MONTH)",
    "Y": "make_date(year({d}), 12, 31)",
    "D": "cast({d} AS date)",
    "W": "cast(date_trunc('week', {d}) AS date) + 6",
    "15min": "time_bucket(INTERVAL '15 minutes', {d})",
    "h": "date_trunc('hour', {d})",
}

CITY_JOIN = (
    "orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"
)

CITY_PANEL = f"""
  SELECT n_name AS City, cast(date_trunc('month', o_orderdate) AS date) AS period,
         cast({ORDER_SUM} AS double) AS sales
  FROM {CITY_JOIN}
  GROUP BY 1, 2 HAVING {ORDER_SUM} > 0
"""

TOTAL_PANEL = f"""
  SELECT cast(date_trunc('month', o_orderdate) AS date) AS period, cast({ORDER_SUM} AS double) AS sales
  FROM orders GROUP BY 1 HAVING {ORDER_SUM} > 0
"""

# 80 % / 20 % cut in time order of a table named panel.
SPLIT = """
  SELECT *, row_number() OVER (PARTITION BY City ORDER BY period) AS rn,
         count(*) OVER (PARTITION BY City) AS cnt,
         CASE WHEN row_number() OVER (PARTITION BY City ORDER BY period)
                   <= floor(count(*) OVER (PARTITION BY City) * (1 - 0.2::double))
              THEN 'train' ELSE 'test' END AS split
  FROM panel
"""


def series_cte(panel: str) -> str:
    """One row per city: the values in time order."""
    return f"""SELECT City, list(sales ORDER BY period) AS ys, list(period ORDER BY period) AS periods,
       count(*) AS n, max(period) AS last_period FROM {panel} GROUP BY City"""


def _values(numbers) -> str:
    return ", ".join(f"({x}::double)" for x in numbers)


def seasonal_search(series: str, alphas, betas, gammas) -> str:
    """CTEs that end in ``best(City, sse, alpha, beta, gamma)`` and ``final(City, l, b, s, sse)``:
    a grid search of additive smoothing with season 12, one pass around the winner, and the last
    state under the winning parameters. ``series`` names a table with ``City, ys, n``."""
    step = """
      {a} * (y - s[1]) + (1 - {a}) * (l + b) AS l,
      {b} * (({a} * (y - s[1]) + (1 - {a}) * (l + b)) - l) + (1 - {b}) * b AS b,
      list_concat(s[2:12], [{g} * (y - (l + b)) + (1 - {g}) * s[1]]) AS s,
      sse + (y - ((l + b) + s[1])) * (y - ((l + b) + s[1])) AS sse
    """.format(a="alpha", b="beta", g="gamma")

    def run(name: str, candidates: str) -> str:
        return f"""
    {name} AS (
      SELECT City, alpha, beta, gamma, 12 AS i, l, b, s, 0.0::double AS sse
      FROM start JOIN {candidates} USING (City)
      UNION ALL
      SELECT City, alpha, beta, gamma, i + 1 AS i, {step}
      FROM (SELECT r.*, p.ys[r.i + 1] AS y FROM {name} r JOIN {series} p USING (City) WHERE r.i < p.n)
    )"""

    def winner(name: str, source: str) -> str:
        return f"""
    {name} AS (
      SELECT City, sse, alpha, beta, gamma FROM (
        SELECT r.*, row_number() OVER (PARTITION BY r.City ORDER BY r.sse, r.alpha, r.beta, r.gamma) AS place
        FROM {source} r JOIN {series} p USING (City) WHERE r.i = p.n)
      WHERE place = 1
    )"""

    clip = "greatest(0.01::double, least(0.99::double, {}))"
    return f"""
    start AS (
      SELECT City, l, b, list_transform(ys[1:12], lambda y: y - l) AS s FROM (
        SELECT City, ys, list_sum(ys[1:12]) / 12.0::double AS l,
               (list_sum(ys[13:24]) - list_sum(ys[1:12])) / 144.0::double AS b FROM {series})
    ),
    coarse AS (
      SELECT City, alpha, beta, gamma FROM {series},
        (VALUES {_values(alphas)}) x(alpha), (VALUES {_values(betas)}) y(beta), (VALUES {_values(gammas)}) z(gamma)
    ),
    {run("coarse_run", "coarse")},
    {winner("coarse_best", "coarse_run")},
    fine AS (
      SELECT City, {clip.format("alpha + da")} AS alpha, {clip.format("beta + db")} AS beta,
             {clip.format("gamma + dg")} AS gamma
      FROM coarse_best, (VALUES {_values((-0.1, 0.0, 0.1))}) x(da), (VALUES {_values((-0.075, 0.0, 0.075))}) y(db),
        (VALUES {_values((-0.075, 0.0, 0.075))}) z(dg)
    ),
    {run("fine_run", "fine")},
    {winner("best", "fine_run")},
    final AS (
      SELECT r.* FROM fine_run r JOIN best USING (City, alpha, beta, gamma) JOIN {series} p USING (City)
      WHERE r.i = p.n
    )"""


_RIDGE = " + 1e-8::double"


def products(names: list[str], target: str, ridge: str = "") -> str:
    """Normal equations of a regression: ``a<i><j>`` (lower triangle) and ``r<i>``."""
    cells = [
        f"sum({names[i]} * {names[j]}){ridge if i == j else ''} AS a{i}{j}"
        for i in range(len(names))
        for j in range(i + 1)
    ]
    cells += [f"sum({names[i]} * {target}) AS r{i}" for i in range(len(names))]
    return ", ".join(cells)


def cholesky(source: str, k: int) -> str:
    """``source`` with the solution ``x<i>`` of the equations of :func:`products`.

    One nested SELECT per step: an alias reused inside one SELECT would be expanded in place.
    """
    steps = []
    for j in range(k):
        inner = "".join(f" - l{j}{m} * l{j}{m}" for m in range(j))
        steps.append([f"sqrt(a{j}{j}{inner}) AS l{j}{j}"])
        below = []
        for i in range(j + 1, k):
            inner = "".join(f" - l{i}{m} * l{j}{m}" for m in range(j))
            below.append(f"(a{i}{j}{inner}) / l{j}{j} AS l{i}{j}")
        steps.append(below)
    for i in range(k):
        inner = "".join(f" - l{i}{m} * z{m}" for m in range(i))
        steps.append([f"(r{i}{inner}) / l{i}{i} AS z{i}"])
    for i in reversed(range(k)):
        inner = "".join(f" - l{m}{i} * x{m}" for m in range(i + 1, k))
        steps.append([f"(z{i}{inner}) / l{i}{i} AS x{i}"])
    for step in steps:
        if step:
            source = f"SELECT *, {', '.join(step)} FROM ({source})"
    return source


def arima_211(series: str) -> str:
    """CTEs that end in ``arima(City, phi1, phi2, theta, scale, last, w1, w2, e1)``: two-stage
    least squares of order (2,1,1), ridge 1e-8, roots kept inside 0.98."""

    def lag(column: str, k: int) -> str:
        return f"lag({column}, {k}) OVER (PARTITION BY City ORDER BY t)"

    return f"""
    points AS (
      SELECT City, list_max(ys) AS scale, unnest(ys) / list_max(ys) AS y,
             unnest(range(1, n + 1)) AS t FROM {series}
    ),
    diffs AS (
      SELECT * FROM (SELECT *, y - {lag("y", 1)} AS w FROM points) WHERE w IS NOT NULL
    ),
    lags AS (
      SELECT *, {lag("w", 1)} AS w1, {lag("w", 2)} AS w2, {lag("w", 3)} AS w3, {lag("w", 4)} AS w4 FROM diffs
    ),
    long AS (
      {cholesky(f"""SELECT City, {products(["w1", "w2", "w3", "w4"], "w", _RIDGE)}
                    FROM lags WHERE w4 IS NOT NULL GROUP BY City""", 4)}
    ),
    resid AS (
      SELECT lags.*, w - (x0 * w1 + x1 * w2 + x2 * w3 + x3 * w4) AS e FROM lags JOIN long USING (City)
      WHERE w4 IS NOT NULL
    ),
    resid1 AS (SELECT *, {lag("e", 1)} AS e1 FROM resid),
    short AS (
      SELECT City, x0 AS p1, x1 AS p2, x2 AS q1 FROM (
        {cholesky(f"""SELECT City, {products(["w1", "w2", "e1"], "w", _RIDGE)}
                      FROM resid1 WHERE e1 IS NOT NULL GROUP BY City""", 3)})
    ),
    rooted AS (
      SELECT *, CASE WHEN p1 * p1 + 4 * p2 >= 0 THEN (abs(p1) + sqrt(p1 * p1 + 4 * p2)) / 2
                     ELSE sqrt(-p2) END AS r,
             greatest(-0.98::double, least(0.98::double, CASE WHEN abs(q1) > 1 THEN 1 / q1 ELSE q1 END)) AS theta
      FROM short
    ),
    coefs AS (
      SELECT City, p1 * f AS phi1, p2 * f * f AS phi2, theta,
             abs(p1 * f - p1) > 1e-12 OR abs(p2 * f * f - p2) > 1e-12 OR abs(theta - q1) > 1e-12 AS adjusted
      FROM (SELECT *, CASE WHEN r >= 0.98::double THEN 0.98::double / r ELSE 1.0::double END AS f FROM rooted)
    ),
    filtered AS (
      SELECT City, 3 AS t, 0.0::double AS e, 0.0::double AS sse FROM coefs
      UNION ALL
      SELECT f.City, f.t + 1 AS t, l.w - c.phi1 * l.w1 - c.phi2 * l.w2 - c.theta * f.e AS e,
             f.sse + pow(l.w - c.phi1 * l.w1 - c.phi2 * l.w2 - c.theta * f.e, 2) AS sse
      FROM filtered f JOIN lags l ON l.City = f.City AND l.t = f.t + 1 JOIN coefs c ON c.City = f.City
    ),
    arima AS (
      SELECT c.*, l.scale, l.y AS last, l.w AS w1, l.w1 AS w2, f.e AS e1, f.sse
      FROM coefs c JOIN {series} p ON p.City = c.City
        JOIN lags l ON l.City = c.City AND l.t = p.n JOIN filtered f ON f.City = c.City AND f.t = p.n
    ),
    ahead AS (
      SELECT City, 0 AS step, w1, w2, e1, last AS level, scale, phi1, phi2, theta FROM arima
      UNION ALL
      SELECT City, step + 1 AS step, phi1 * w1 + phi2 * w2 + theta * e1 AS w1, w1 AS w2, 0.0::double AS e1,
             level + (phi1 * w1 + phi2 * w2 + theta * e1) AS level, scale, phi1, phi2, theta
      FROM ahead WHERE step < 40
    )"""
