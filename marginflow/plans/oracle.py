"""DuckDB SQL for each registered query (the correctness oracle).

Written against the raw driver tables (views named after the parquet
files).  Numeric literals carry ::DOUBLE so DuckDB does not switch to
DECIMAL arithmetic; outputs are rounded exactly where the Spark side rounds.
"""

from __future__ import annotations

from marginflow.sources import fixtures as fx

DBL = "::DOUBLE"


def _d2(a: str, b: str) -> str:
    return (f"list_sum(list_transform(list_zip({a}, {b}), "
            f"lambda p: (p[1] - p[2]) * (p[1] - p[2])))")


def _rbf(a: str, b: str) -> str:
    return f"exp(-{fx.PLANTED_GAMMA}{DBL} * {_d2(a, b)})"


def _r(expr: str, places: int) -> str:
    return f"(round({expr}, {places}) + 0.0{DBL})"


EMB = "emb AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS x, label FROM embeddings)"
PM = (f"pm AS (SELECT id, x, label, CASE WHEN label < 5 THEN 1.0{DBL} ELSE -1.0{DBL} END AS y, "
      f"{fx.PLANTED_C}{DBL} * (id % {fx.PLANTED_ALPHA_MOD}){DBL} / 10.0{DBL} AS alpha FROM emb)")
# the planted model: of each class the row with the least id, and a threshold
# that centres the scores
def _model(src: str, tag: str = "", scored: str = "emb") -> str:
    """sv (support), ks (kernel sums of ``scored``), bb (mean of the sums over
    the rows of ``src``) and dec (scores), each with ``tag`` appended."""
    return (f"sv{tag} AS (SELECT e.label, e.id, e.x, CASE WHEN e.label < 5 THEN 1.0{DBL} ELSE -1.0{DBL} END AS y, "
            f"{fx.PLANTED_C}{DBL} * (e.label + 1){DBL} / 10.0{DBL} AS alpha FROM emb e JOIN "
            f"(SELECT label, min(id) AS id FROM {src} GROUP BY label) f ON e.id = f.id), "
            f"ks{tag} AS (SELECT t.id, sum(s.alpha * s.y * {_rbf('s.x', 't.x')}) AS s "
            f"FROM {scored} t, sv{tag} s GROUP BY t.id), "
            f"bb{tag} AS (SELECT avg(k.s) AS b FROM ks{tag} k JOIN (SELECT id FROM {src}) r USING (id)), "
            f"dec{tag} AS (SELECT id, s - b AS score FROM ks{tag}, bb{tag})")


DEC = _model("emb")
STATE = (f"state AS (SELECT p.id, p.x, p.y, {fx.PLANTED_C}{DBL} AS cap, coalesce(v.alpha, 0.0{DBL}) AS alpha, "
         f"p.y * k.s - 1.0{DBL} AS g, k.s - bb.b - p.y AS e "
         f"FROM pm p JOIN ks k USING (id) LEFT JOIN sv v USING (id), bb)")
PLANTED = f"WITH {EMB}, {PM}, {DEC}, {STATE}"
# every row with the multipliers id % 11, for the arithmetic of whole-table pairs
PAIR_STATE = (f"state AS (SELECT p.id, p.x, p.y, {fx.PLANTED_C}{DBL} AS cap, p.alpha, d.score - p.y AS e "
              f"FROM pm p JOIN dec d USING (id))")

LI = (f"li AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, l_quantity, "
      f"l_extendedprice, l_discount + 0.0{DBL} AS l_discount, l_tax + 0.0{DBL} AS l_tax FROM lineitem)")
RING = (f"ring AS (SELECT *, CASE WHEN (q - 0.5{DBL}) * (q - 0.5{DBL}) + (d - 0.5{DBL}) * (d - 0.5{DBL}) "
        f"< {fx.RING_RADIUS_SQ}{DBL} THEN 1.0{DBL} ELSE 0.0{DBL} END AS in_ring FROM "
        f"(SELECT *, (l_quantity - 1.0{DBL}) / 49.0{DBL} AS q, l_discount / 0.1{DBL} + 0.0{DBL} AS d FROM li))")
KEYS = "l_orderkey, l_partkey, l_suppkey, l_linenumber"
F8 = "l_quantity, l_extendedprice, l_discount, l_tax, in_ring"

PAIRS = ("pairs AS (SELECT a.id AS i, b.id AS j, a.x AS x_i, b.x AS x_j FROM emb a JOIN emb b "
         "ON a.id // 2 = b.id // 2 AND a.id < b.id)")

HOLD = (_model("(SELECT * FROM emb WHERE id % 5 <> 4)", "_tr") + ", "
        "held AS (SELECT d.id, d.score, p.y, p.label, p.id % 5 = 4 AS holdout "
        "FROM dec_tr d JOIN pm p USING (id))")

LATE = f"o_orderdate >= TIMESTAMP '{fx.ORDERS_SPLIT_DATE}'"
UNIT = (f"unit AS (SELECT o.o_orderkey, o.o_totalprice AS price, {LATE} AS is_test, l.label, l.prediction FROM orders o "
        f"JOIN (SELECT l_orderkey, avg(l_tax) / 0.08{DBL} AS label, avg(l_discount) / 0.1{DBL} AS prediction "
        "FROM lineitem GROUP BY l_orderkey) l ON o.o_orderkey = l.l_orderkey), "
        "rng AS (SELECT min(price) AS mn, max(price) AS mx FROM unit WHERE NOT is_test), "
        "back AS (SELECT o_orderkey, is_test, label * (mx - mn) + mn AS label, "
        "prediction * (mx - mn) + mn AS prediction FROM unit, rng)")
PRICES = (f"st AS (SELECT avg(o_totalprice) AS mean, max(o_totalprice) AS top FROM orders), "
          f"pr AS (SELECT o_orderkey, CASE WHEN o_totalprice > mean THEN 1.0{DBL} ELSE 0.0{DBL} END AS label, "
          "o_totalprice / top AS v FROM orders, st)")

F6 = ("f6 AS (SELECT o.o_orderkey, o.o_orderdate, o.o_totalprice AS label, l.prediction FROM orders o "
      "JOIN (SELECT l_orderkey, sum(l_extendedprice) AS prediction FROM lineitem GROUP BY l_orderkey) l "
      "ON o.o_orderkey = l.l_orderkey)")


def _pair_step_sql(eps: float) -> str:
    y1, y2, a1, a2 = "y_i", "y_j", "alpha_i", "alpha_j"
    e1, e2, c1, c2 = "e_i", "e_j", "cap_i", "cap_j"
    s = f"({y1} * {y2})"
    lo = (f"(CASE WHEN {y1} <> {y2} THEN greatest(0.0{DBL}, {a2} - {a1}) "
          f"ELSE greatest(0.0{DBL}, {a1} + {a2} - {c1}) END)")
    hi = (f"(CASE WHEN {y1} <> {y2} THEN least({c2}, {c1} + {a2} - {a1}) "
          f"ELSE least({c2}, {a1} + {a2}) END)")
    eta = "(2.0::DOUBLE * k12 - k11 - k22)"
    newton = f"least(greatest({a2} - {y2} * ({e1} - {e2}) / {eta}, {lo}), {hi})"
    bb = "(SELECT b FROM bb)"
    f1 = f"({y1} * ({e1} + {bb}) - {a1} * k11 - {s} * {a2} * k12)"
    f2 = f"({y2} * ({e2} + {bb}) - {s} * {a1} * k12 - {a2} * k22)"
    l1 = f"({a1} + {s} * ({a2} - {lo}))"
    h1 = f"({a1} + {s} * ({a2} - {hi}))"
    lobj = (f"({l1} * {f1} + {lo} * {f2} + 0.5{DBL} * {l1} * {l1} * k11 "
            f"+ 0.5{DBL} * {lo} * {lo} * k22 + {s} * {lo} * {l1} * k12)")
    hobj = (f"({h1} * {f1} + {hi} * {f2} + 0.5{DBL} * {h1} * {h1} * k11 "
            f"+ 0.5{DBL} * {hi} * {hi} * k22 + {s} * {hi} * {h1} * k12)")
    flat = (f"(CASE WHEN {lobj} < {hobj} - {eps}{DBL} THEN {lo} "
            f"WHEN {lobj} > {hobj} + {eps}{DBL} THEN {hi} ELSE {a2} END)")
    a2n = f"(CASE WHEN {lo} >= {hi} THEN {a2} WHEN {eta} < -1e-12{DBL} THEN {newton} ELSE {flat} END)"
    return (f"SELECT *, {a1} + {s} * ({a2} - a2n) AS a1n FROM "
            f"(SELECT *, {a2n} AS a2n FROM kp)")


PAIR_SELECT = ("a.id AS i, b.id AS j, a.x AS x_i, b.x AS x_j, a.y AS y_i, b.y AS y_j, "
               "a.cap AS cap_i, b.cap AS cap_j, a.alpha AS alpha_i, b.alpha AS alpha_j, a.e AS e_i, b.e AS e_j, "
               f"{_rbf('a.x', 'a.x')} AS k11, {_rbf('a.x', 'b.x')} AS k12, {_rbf('b.x', 'b.x')} AS k22")
KP_ALL = f"kp AS (SELECT {PAIR_SELECT} FROM state a JOIN state b ON a.id // 2 = b.id // 2 AND a.id < b.id)"
CHOICE = (f"viol AS (SELECT * FROM state WHERE (y * e > 0.01{DBL} AND alpha > 0) "
          f"OR (y * e < -0.01{DBL} AND alpha < cap)), "
          "first AS (SELECT id, e FROM viol ORDER BY abs(e) DESC, id LIMIT 1), "
          "second AS (SELECT f.id AS i, s.id AS j FROM state s, first f "
          "WHERE s.alpha > 0 AND s.alpha < s.cap AND s.id <> f.id ORDER BY abs(f.e - s.e) DESC, s.id LIMIT 1)")
KP_CHOSEN = (f"{CHOICE}, kp AS (SELECT {PAIR_SELECT} FROM second c JOIN state a ON a.id = c.i "
             "JOIN state b ON b.id = c.j)")


def _steps(kp: str = KP_ALL, eps: float = 1e-3) -> str:
    bb = "(SELECT b FROM bb)"
    b1 = f"(e_i + y_i * (a1n - alpha_i) * k11 + y_j * (a2n - alpha_j) * k12 + {bb})"
    b2 = f"(e_j + y_i * (a1n - alpha_i) * k12 + y_j * (a2n - alpha_j) * k22 + {bb})"
    steps = (f"steps AS (SELECT *, CASE WHEN a1n > 0 AND a1n < cap_i THEN {b1} "
             f"WHEN a2n > 0 AND a2n < cap_j THEN {b2} ELSE ({b1} + {b2}) / 2.0{DBL} END AS bn "
             f"FROM ({_pair_step_sql(eps)}))")
    deltas = ("deltas AS (SELECT i AS id, x_i AS x, y_i AS y, alpha_i AS alpha_old, a1n AS alpha_new FROM steps "
              "UNION ALL SELECT j, x_j, y_j, alpha_j, a2n FROM steps)")
    return f"{kp}, {steps}, {deltas}"


WEIGHTS = ("w AS (SELECT pos, sum(alpha * y * v) AS w FROM "
           "(SELECT alpha, y, unnest(x) AS v, generate_subscripts(x, 1) - 1 AS pos FROM pm) GROUP BY pos)")

PRED = (f"pred AS (SELECT d.id, CASE WHEN p.label < 5 THEN 1.0{DBL} ELSE 0.0{DBL} END AS label01, "
        f"CASE WHEN d.score > 0 THEN 1.0{DBL} ELSE 0.0{DBL} END AS prediction FROM dec d JOIN pm p USING (id))")


def _priors(src: str, col: str, name: str) -> str:
    return (f"{name} AS (SELECT {col} AS cls, count(*)::DOUBLE / (sum(count(*)) OVER ())::DOUBLE AS p "
            f"FROM {src} GROUP BY {col})")


def _type_codes() -> str:
    rows = " UNION ALL ".join(
        f"SELECT {i}::INTEGER AS pos, '{c}' AS name, {t}::INTEGER AS code, "
        f"'{'Classification' if t == 1 else 'Regression'}' AS task, {c == 'in_ring'} AS is_target, "
        f"count({c}) AS n_values FROM ring"
        for i, (c, t) in enumerate(zip(fx.F8_NAMES, fx.F8_TYPES)))
    return f"WITH {LI}, {RING} {rows}"


def _report() -> str:
    """The run's report; a trainer that learns reaches the stated accuracy."""
    split = f"l_shipdate >= TIMESTAMP '{fx.SPLIT_DATE}'"
    return (f"WITH {LI}, {RING}, t AS (SELECT *, {split} AS is_test FROM ring), "
            f"{_priors('t WHERE NOT is_test', 'in_ring', 'p')}, {_priors('t WHERE is_test', 'in_ring', 'q')}, "
            "n AS (SELECT count(*) FILTER (NOT is_test) AS tr, count(*) FILTER (is_test) AS te FROM t), "
            f"d AS (SELECT count(*) AS d FROM (SELECT DISTINCT {F8} FROM t WHERE NOT is_test)) "
            f"SELECT 'train_rows' AS metric, tr::DOUBLE AS value FROM n UNION ALL SELECT 'test_rows', te::DOUBLE FROM n "
            "UNION ALL SELECT 'distinct_train_rows', d::DOUBLE FROM d "
            f"UNION ALL SELECT 'random_precision', {_r(f'coalesce(sum(p.p * q.p), 0.0{DBL})', 9)} FROM p JOIN q USING (cls) "
            + " ".join(f"UNION ALL SELECT '{m}', 1.0{DBL}" for m in ("train_accurate", "test_accurate", "converged")))


def _regression_report(c: float = 1.0) -> str:
    """RMSE of the least-squares fit, whose d equations are solved by
    elimination, one CTE a column (d = 4; column 4 is the label)."""
    cols = ["l_quantity", "l_discount", "l_tax", "in_ring", "l_extendedprice"]
    d = len(cols) - 1
    lohi = ", ".join(f"min({x}) AS lo{i}, max({x}) AS hi{i}" for i, x in enumerate(cols))
    unit = ", ".join(f"coalesce(({x} - lo{i}) / nullif(hi{i} - lo{i}, 0.0{DBL}), 0.0{DBL}) AS x{i}" for i, x in enumerate(cols))
    means = ", ".join(f"avg(x{i}) AS m{i}" for i in range(d + 1))
    cells = [(i, j) for i in range(d) for j in range(d + 1)]
    sums = ", ".join(f"sum((x{i} - m{i}) * (x{j} - m{j})){f' + {1.0 / c}{DBL}' if i == j else ''} AS s{i}_{j}" for i, j in cells)
    steps = []
    for k in range(d):
        now = ", ".join(f"s{i}_{j} - s{i}_{k} * s{k}_{j} / s{k}_{k} AS s{i}_{j}" if i > k and j >= k else f"s{i}_{j}"
                        for i, j in cells)
        steps.append(f"e{k + 1} AS (SELECT {now} FROM e{k})")
    back = []
    for k in reversed(range(d)):
        rest = "".join(f" - s{k}_{j} * w{j}" for j in range(k + 1, d))
        back.append(f"b{k} AS (SELECT *, (s{k}_{d}{rest}) / s{k}_{k} AS w{k} FROM {'e%d' % d if k == d - 1 else 'b%d' % (k + 1)})")
    guess = " + ".join(f"w{i} * (x{i} - m{i})" for i in range(d)) + f" + m{d}"
    rmse = _r(f"sqrt(avg(power((x{d} - ({guess})) * (hi{d} - lo{d}), 2)))", 4)
    return (f"WITH {LI}, {RING}, t AS (SELECT *, l_shipdate >= TIMESTAMP '{fx.SPLIT_DATE}' AS is_test FROM ring), "
            f"r AS (SELECT {lohi} FROM t WHERE NOT is_test), u AS (SELECT is_test, {unit}, lo{d}, hi{d} FROM t, r), "
            f"m AS (SELECT {means} FROM u WHERE NOT is_test), "
            f"e0 AS (SELECT {sums} FROM u, m WHERE NOT is_test), {', '.join(steps)}, {', '.join(back)} "
            f"SELECT CASE WHEN is_test THEN 'test_rmse' ELSE 'train_rmse' END AS metric, {rmse} AS value "
            "FROM u, m, b0 GROUP BY is_test UNION ALL "
            "SELECT CASE WHEN is_test THEN 'test_rows' ELSE 'train_rows' END, count(*)::DOUBLE FROM t GROUP BY is_test")


def _pair_round(pairs: int) -> str:
    """One round on the planted state: both sets' first rows matched by rank,
    each pair's own step, and the least objective along all steps together."""
    v = "-y * g"
    up = "(y > 0 AND alpha < cap) OR (y < 0 AND alpha > 0)"
    low = "(y > 0 AND alpha > 0) OR (y < 0 AND alpha < cap)"
    d2 = _rbf("a.x", "b.x")
    return (f"{PLANTED}, cand AS (SELECT * FROM (SELECT *, {v} AS v, 0 AS side, row_number() OVER (ORDER BY {v} DESC, id) AS rk "
            f"FROM state WHERE {up}) WHERE rk <= {pairs} UNION ALL SELECT * FROM (SELECT *, {v} AS v, 1 AS side, "
            f"row_number() OVER (ORDER BY {v}, id) AS rk FROM state WHERE {low}) WHERE rk <= {pairs}), "
            "once AS (SELECT * FROM cand QUALIFY row_number() OVER (PARTITION BY id ORDER BY rk, side) = 1), "
            "ranked AS (SELECT * EXCLUDE rk, row_number() OVER (PARTITION BY side ORDER BY rk) AS rk FROM once), "
            f"p AS (SELECT a.id AS i, b.id AS j, a.y AS y_i, b.y AS y_j, least((a.v - b.v) / (2.0{DBL} - 2.0{DBL} * {d2}), "
            "CASE WHEN a.y > 0 THEN a.cap - a.alpha ELSE a.alpha END, CASE WHEN b.y > 0 THEN b.alpha ELSE b.cap - b.alpha END) AS t "
            "FROM ranked a JOIN ranked b ON a.side = 0 AND b.side = 1 AND a.rk = b.rk AND a.v > b.v), "
            "d AS (SELECT s.id, s.x, s.y, q.d FROM (SELECT i AS id, y_i * t AS d FROM p UNION ALL SELECT j, -y_j * t FROM p) q "
            "JOIN state s USING (id)), "
            f"dg AS (SELECT t.id, t.y * coalesce(sum(d.d * d.y * {_rbf('d.x', 't.x')}), 0.0{DBL}) AS dg FROM state t LEFT JOIN d ON TRUE "
            "GROUP BY t.id, t.y), "
            "ls AS (SELECT sum(s.g * d.d) AS gd, sum(dg.dg * d.d) AS q FROM d JOIN state s USING (id) JOIN dg USING (id)), "
            f"st AS (SELECT CASE WHEN q > 0 THEN greatest(least(1.0{DBL}, -gd / q), 0.0{DBL}) ELSE 1.0{DBL} END AS s FROM ls) "
            f"SELECT s.id, {_r(f'least(greatest(s.alpha + st.s * coalesce(d.d, 0.0{DBL}), 0.0{DBL}), s.cap)', 6)} AS alpha, "
            f"{_r('s.g + st.s * dg.dg', 6)} AS g FROM state s JOIN dg USING (id) LEFT JOIN d USING (id), st")


def _zoned_choice(k: int) -> str:
    v = "-y * g"
    one = ("SELECT '{side}' AS side, row_number() OVER (ORDER BY {v} {way}, id)::INTEGER AS rank, id, {shown} AS v, true AS pruned "
           "FROM state WHERE {where} QUALIFY rank <= {k}")
    shown = _r(v, 6)
    return (f"{PLANTED} " + one.format(side="up", v=v, way="DESC", shown=shown, k=k,
                                       where="(y > 0 AND alpha < cap) OR (y < 0 AND alpha > 0)")
            + " UNION ALL " + one.format(side="low", v=v, way="ASC", shown=shown, k=k,
                                         where="(y > 0 AND alpha > 0) OR (y < 0 AND alpha < cap)"))


#: the closed form of ``price_samples``: the two points next to the gap are
#: the support, no row is inside the margin
GAP = (f"WITH {PRICES}, e AS (SELECT min(CASE WHEN label = 1 THEN v + 1.0{DBL} END) AS p, "
       "max(CASE WHEN label = 0 THEN v END) AS n, count(*) AS n_rows FROM pr) "
       f"SELECT {_r(f'2.0{DBL} / (p - n)', 6)} AS w, {_r('(p + n) / (p - n)', 6)} AS b, n_rows, "
       + ", ".join(f"{_r(f'2.0{DBL} / ((p - n) * (p - n))', 4)} AS {k}" for k in ("primal", "dual"))
       + f", 0.0{DBL} AS duality_gap")


ORACLE: dict[str, str] = {
    "csv_lines": f"WITH {LI}, {RING} SELECT {KEYS}, {F8} FROM ring",
    "task_type": _type_codes(),
    "target_split": (f"WITH {LI}, {RING} SELECT {KEYS}, l_discount AS label, l_quantity AS f0, "
                     "l_extendedprice AS f1, l_tax AS f2, in_ring AS f3 FROM ring"),
    "global_minmax": f"WITH {EMB} SELECT min(list_min(x)) AS mn, max(list_max(x)) AS mx FROM emb",
    "scale_global": (f"WITH {EMB}, st AS (SELECT min(list_min(x)) AS mn, max(list_max(x)) AS mx FROM emb) "
                     f"SELECT id, pos::INTEGER AS pos, coalesce((v - mn) / nullif(mx - mn, 0.0{DBL}), 0.0{DBL}) AS v "
                     "FROM (SELECT id, unnest(x) AS v, generate_subscripts(x, 1) - 1 AS pos FROM emb), st"),
    "scale_per_column": (f"WITH {EMB}, cells AS (SELECT id, unnest(x) AS v, generate_subscripts(x, 1) - 1 AS pos FROM emb), "
                         "st AS (SELECT pos, min(v) AS mn, max(v) AS mx FROM cells GROUP BY pos) "
                         f"SELECT id, pos::INTEGER AS pos, coalesce((v - mn) / nullif(mx - mn, 0.0{DBL}), 0.0{DBL}) AS v "
                         "FROM cells JOIN st USING (pos)"),
    "class_count": "SELECT count(DISTINCT o_orderstatus) AS n_classes FROM orders",
    "one_hot": ("WITH cls AS (SELECT o_orderstatus AS cls, (row_number() OVER (ORDER BY o_orderstatus) - 1) AS idx "
                "FROM (SELECT DISTINCT o_orderstatus FROM orders)), k AS (SELECT count(*) AS k FROM cls), "
                "slots AS (SELECT unnest(range(k)) AS slot FROM k) "
                f"SELECT o.o_orderkey, o.o_orderstatus AS cls, s.slot::INTEGER AS slot, "
                f"CASE WHEN s.slot = c.idx THEN 1.0{DBL} ELSE 0.0{DBL} END AS v "
                "FROM orders o JOIN cls c ON o.o_orderstatus = c.cls CROSS JOIN slots s"),
    "one_hot_decode": (f"WITH {EMB}, st AS (SELECT min(list_min(x)) AS mn, max(list_max(x)) AS mx FROM emb), "
                       f"sc AS (SELECT id, list_transform(x, lambda v: coalesce((v - mn) / nullif(mx - mn, 0.0{DBL}), 0.0{DBL})) AS xs FROM emb, st) "
                       "SELECT id, coalesce(list_max(list_filter(list_transform(xs, lambda v, i: "
                       "CASE WHEN v >= 0.5 THEN i - 1 END), lambda e: e IS NOT NULL)), 0)::INTEGER AS cls FROM sc"),
    "sq_distance": f"WITH {EMB}, {PAIRS} SELECT i, j, {_r(_d2('x_i', 'x_j'), 9)} AS d2 FROM pairs",
    "rbf_pairs": f"WITH {EMB}, {PAIRS} SELECT i, j, {_r(_rbf('x_i', 'x_j'), 9)} AS k FROM pairs",
    "pair_curvature": (f"WITH {EMB}, {PAIRS} SELECT i, j, "
                       f"{_r('2.0::DOUBLE * ' + _rbf('x_i', 'x_j') + ' - ' + _rbf('x_i', 'x_i') + ' - ' + _rbf('x_j', 'x_j'), 9)} AS eta FROM pairs"),
    "decision_rbf": f"WITH {EMB}, {PM}, {DEC} SELECT id, {_r('score', 6)} AS score FROM dec",
    "decision_sqdist": (f"WITH {EMB}, {PM}, {DEC}, d2 AS (SELECT t.id, sum(s.alpha * s.y * {_d2('s.x', 't.x')}) AS s "
                        "FROM emb t, sv s GROUP BY t.id) "
                        f"SELECT id, {_r('s - (SELECT avg(s) FROM d2)', 6)} AS score FROM d2"),
    "prediction_error": (f"WITH {EMB}, {PM}, {DEC} SELECT d.id, p.y, {_r('d.score - p.y', 6)} AS e "
                         "FROM dec d JOIN pm p USING (id)"),
    "predict_label": (f"WITH {EMB}, {PM}, {DEC} SELECT id, {_r('score', 6)} AS score, "
                      f"CASE WHEN score > 0 THEN 1.0{DBL} ELSE 0.0{DBL} END AS prediction FROM dec"),
    "accuracy": (f"WITH {EMB}, {PM}, {DEC}, {PRED} SELECT n, accuracy, 1.0{DBL} - accuracy AS error_rate FROM "
                 f"(SELECT count(*) AS n, avg(CASE WHEN label01 = prediction THEN 1.0{DBL} ELSE 0.0{DBL} END) AS accuracy FROM pred)"),
    "predict_rows": (f"WITH {EMB}, {PM}, {DEC} SELECT d.id, p.label, {_r('list_sum(p.x)', 6)} AS x_sum, "
                     f"{_r('d.score', 6)} AS score, CASE WHEN d.score > 0 THEN 1.0{DBL} ELSE 0.0{DBL} END AS prediction, "
                     f"{_r('d.score - p.y', 6)} AS error FROM dec d JOIN pm p USING (id)"),
    "linear_weights": f"WITH {EMB}, {PM}, {WEIGHTS} SELECT pos::INTEGER AS pos, {_r('w', 9)} AS w FROM w",
    "linear_score": (f"WITH {EMB}, {PM}, {WEIGHTS} SELECT e.id, {_r(f'sum(e.v * w.w) - {fx.PLANTED_B}{DBL}', 6)} AS score "
                     "FROM (SELECT id, unnest(x) AS v, generate_subscripts(x, 1) - 1 AS pos FROM emb) e "
                     "JOIN w USING (pos) GROUP BY e.id"),
    "classify_test": f"WITH {EMB}, {PM}, {HOLD} SELECT id, {_r('score', 6)} AS score FROM held WHERE holdout",
    "holdout_agreement": (f"WITH {EMB}, {PM}, {HOLD} SELECT count(*) AS n, "
                          f"avg(CASE WHEN (score > 0) = (y > 0) THEN 1.0{DBL} ELSE 0.0{DBL} END) AS agreement "
                          "FROM held WHERE holdout"),
    "warm_start": (f"{PLANTED}, {_steps(KP_CHOSEN)}, "
                   "warm AS (SELECT id, alpha_new AS alpha FROM deltas), "
                   "w0 AS (SELECT e.id, e.x, CASE WHEN e.label < 5 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS y, "
                   "coalesce(w.alpha, 0.0::DOUBLE) AS alpha FROM emb e LEFT JOIN warm w USING (id)), "
                   "basis AS (SELECT x, alpha * y AS coef FROM w0 WHERE alpha > 0) "
                   f"SELECT t.id, t.y, t.alpha, {_r('t.y * coalesce(sum(s.coef * ' + _rbf('s.x', 't.x') + f'), 0.0{DBL}) - 1.0{DBL}', 6)} AS g "
                   "FROM w0 t LEFT JOIN basis s ON TRUE GROUP BY t.id, t.y, t.alpha"),
    "kkt_violators": (f"{PLANTED} SELECT id, y, alpha, {_r('e', 6)} AS e FROM state "
                      f"WHERE (y * e > 0.01{DBL} AND alpha > 0) OR (y * e < -0.01{DBL} AND alpha < cap)"),
    "second_choice": (f"{PLANTED}, viol AS (SELECT * FROM state WHERE (y * e > 0.01{DBL} AND alpha > 0) "
                      f"OR (y * e < -0.01{DBL} AND alpha < cap)), "
                      "first AS (SELECT id, e FROM viol ORDER BY abs(e) DESC, id LIMIT 1) "
                      f"SELECT f.id AS i, s.id AS j, {_r('f.e', 6)} AS e_i, {_r('s.e', 6)} AS e_j, "
                      f"{_r('abs(f.e - s.e)', 6)} AS gap FROM state s, first f "
                      "WHERE s.alpha > 0 AND s.alpha < s.cap AND s.id <> f.id "
                      "ORDER BY abs(f.e - s.e) DESC, s.id LIMIT 1"),
    "fallback_nonbound": (f"{PLANTED}, viol AS (SELECT * FROM state WHERE (y * e > 0.01{DBL} AND alpha > 0) "
                          f"OR (y * e < -0.01{DBL} AND alpha < cap)), "
                          "first AS (SELECT id, e FROM viol ORDER BY abs(e) DESC, id LIMIT 1), "
                          "k AS (SELECT 18581050327 % (max(id) + 1) AS k0 FROM state) "
                          "SELECT f.id AS i, s.id AS j, k.k0 FROM state s, first f, k "
                          "WHERE s.alpha > 0 AND s.alpha < s.cap AND s.id <> f.id "
                          "ORDER BY (s.id < k.k0), s.id LIMIT 1"),
    "fallback_any": (f"{PLANTED}, viol AS (SELECT * FROM state WHERE (y * e > 0.01{DBL} AND alpha > 0) "
                     f"OR (y * e < -0.01{DBL} AND alpha < cap)), "
                     "first AS (SELECT id, e FROM viol ORDER BY abs(e) DESC, id LIMIT 1), "
                     "k AS (SELECT 18581050327 % (max(id) + 1) AS k0 FROM state) "
                     "SELECT f.id AS i, s.id AS j, k.k0 FROM state s, first f, k "
                     "WHERE s.id <> f.id ORDER BY (s.id < k.k0), s.id LIMIT 1"),
    "pair_bounds": (f"WITH {EMB}, {PM} SELECT a.id AS i, b.id AS j, "
                    f"CASE WHEN a.y <> b.y THEN greatest(0.0{DBL}, b.alpha - a.alpha) "
                    f"ELSE greatest(0.0{DBL}, a.alpha + b.alpha - {fx.PLANTED_C}{DBL}) END AS lo, "
                    f"CASE WHEN a.y <> b.y THEN least({fx.PLANTED_C}{DBL}, {fx.PLANTED_C}{DBL} + b.alpha - a.alpha) "
                    f"ELSE least({fx.PLANTED_C}{DBL}, a.alpha + b.alpha) END AS hi "
                    "FROM pm a JOIN pm b ON a.id // 2 = b.id // 2 AND a.id < b.id"),
    "pair_step": (f"WITH {EMB}, {PM}, {DEC}, {PAIR_STATE}, {_steps()} SELECT i, j, {_r('a1n', 9)} AS a1_new, {_r('a2n', 9)} AS a2_new, "
                  f"{_r('bn', 6)} AS b_new FROM steps"),
    "apply_step": (f"{PLANTED}, {_steps(KP_CHOSEN)} SELECT s.id, {_r('coalesce(d.alpha_new, s.alpha)', 9)} AS alpha, "
                   f"{_r('coalesce((SELECT max(bn) FROM steps), bb.b)', 6)} AS b "
                   "FROM state s LEFT JOIN deltas d USING (id), bb"),
    "gradient_update": (f"{PLANTED}, {_steps(KP_CHOSEN)}, "
                        "moved AS (SELECT x, (alpha_new - alpha_old) * y AS coef FROM deltas "
                        "WHERE (alpha_new - alpha_old) * y <> 0), "
                        f"upd AS (SELECT s.id, s.y, s.g + s.y * coalesce(sum(m.coef * {_rbf('m.x', 's.x')}), 0.0{DBL}) AS g "
                        "FROM state s LEFT JOIN moved m ON TRUE GROUP BY s.id, s.g, s.y) "
                        f"SELECT id, {_r('g', 6)} AS g, "
                        f"{_r('y * g - coalesce((SELECT max(bn) FROM steps), bb.b)', 6)} AS e FROM upd, bb"),
    "weights_delta": (f"{PLANTED}, {_steps(KP_CHOSEN)}, {WEIGHTS}, "
                      "dw AS (SELECT pos, sum(coef * v) AS dw FROM (SELECT (alpha_new - alpha_old) * y AS coef, "
                      "unnest(x) AS v, generate_subscripts(x, 1) - 1 AS pos FROM deltas) GROUP BY pos) "
                      f"SELECT pos::INTEGER AS pos, {_r(f'coalesce(w.w, 0.0{DBL}) + coalesce(dw.dw, 0.0{DBL})', 9)} AS w "
                      "FROM w FULL JOIN dw USING (pos)"),
    "confusion": (f"WITH {EMB}, {PM}, {DEC}, {PRED} SELECT label01 AS label, prediction, count(*) AS n "
                  "FROM pred GROUP BY label01, prediction"),
    "class_metrics": (f"WITH {EMB}, {PM}, {DEC}, {PRED}, "
                      "conf AS (SELECT label01 AS label, prediction, count(*) AS n FROM pred GROUP BY label01, prediction), "
                      "nt AS (SELECT label AS cls, sum(n) AS n_true FROM conf GROUP BY label), "
                      "np AS (SELECT prediction AS cls, sum(n) AS n_pred FROM conf GROUP BY prediction), "
                      "tp AS (SELECT label AS cls, n AS tp FROM conf WHERE label = prediction), "
                      "tot AS (SELECT sum(n)::DOUBLE AS total, sum(CASE WHEN label = prediction THEN n ELSE 0 END)::DOUBLE AS correct FROM conf), "
                      "per AS (SELECT cls, coalesce(tp.tp, 0)::BIGINT AS tp, coalesce(n_true, 0)::BIGINT AS n_true, "
                      "coalesce(n_pred, 0)::BIGINT AS n_pred FROM nt FULL JOIN np USING (cls) LEFT JOIN tp USING (cls)), "
                      "pr AS (SELECT *, tp / nullif(n_pred, 0) AS precision, tp / nullif(n_true, 0) AS recall FROM per) "
                      f"SELECT cls, tp, n_true, n_pred, {_r('precision', 9)} AS precision, {_r('recall', 9)} AS recall, "
                      f"{_r(f'2.0{DBL} * precision * recall / nullif(precision + recall, 0.0{DBL})', 9)} AS f1, "
                      f"{_r('correct / total', 9)} AS overall_precision FROM pr, tot"),
    "class_priors": ("SELECT o_orderstatus AS cls, count(*) AS n, "
                     "count(*)::DOUBLE / (sum(count(*)) OVER ())::DOUBLE AS prior FROM orders GROUP BY o_orderstatus"),
    "random_precision": (f"WITH {_priors(f'orders WHERE o_orderdate < TIMESTAMP {chr(39)}{fx.ORDERS_SPLIT_DATE}{chr(39)}', 'o_orderstatus', 'p')}, "
                         f"{_priors(f'orders WHERE o_orderdate >= TIMESTAMP {chr(39)}{fx.ORDERS_SPLIT_DATE}{chr(39)}', 'o_orderstatus', 'q')} "
                         f"SELECT {_r(f'coalesce(sum(p.p * q.p), 0.0{DBL})', 9)} AS random_precision FROM p JOIN q USING (cls)"),
    "eval_classification": (f"WITH {EMB}, {PM}, {HOLD}, "
                            f"hp AS (SELECT *, CASE WHEN label < 5 THEN 1.0{DBL} ELSE 0.0{DBL} END AS label01, "
                            f"CASE WHEN score > 0 THEN 1.0{DBL} ELSE 0.0{DBL} END AS prediction FROM held), "
                            f"{_priors('hp WHERE NOT holdout', 'label01', 'p')}, {_priors('hp WHERE holdout', 'label01', 'q')} "
                            f"SELECT 'train_precision' AS metric, {_r(f'avg(CASE WHEN label01 = prediction THEN 1.0{DBL} ELSE 0.0{DBL} END)', 9)} AS value "
                            "FROM hp WHERE NOT holdout UNION ALL "
                            f"SELECT 'test_precision', {_r(f'avg(CASE WHEN label01 = prediction THEN 1.0{DBL} ELSE 0.0{DBL} END)', 9)} "
                            "FROM hp WHERE holdout UNION ALL "
                            f"SELECT 'random_precision', {_r(f'coalesce(sum(p.p * q.p), 0.0{DBL})', 9)} FROM p JOIN q USING (cls)"),
    "denormalise": (f"WITH {UNIT} SELECT o_orderkey, is_test, {_r('label', 4)} AS label, "
                    f"{_r('prediction', 4)} AS prediction FROM back"),
    "eval_regression": (f"WITH {UNIT} SELECT CASE WHEN is_test THEN 'test_rmse' ELSE 'train_rmse' END AS metric, "
                        f"{_r('sqrt(avg((label - prediction) * (label - prediction)))', 4)} AS value "
                        "FROM back GROUP BY is_test"),
    "train_kernel": f"{GAP} FROM e",
    "train_shrinking": f"{GAP}, true AS fell, true AS whole_at_the_end FROM e",
    # three points on a line, the middle one positive: its multiplier is twice the others'
    "train_rbf": (f"WITH st AS (SELECT avg(o_totalprice) / max(o_totalprice) AS m FROM orders), "
                  f"k AS (SELECT exp(-{fx.PLANTED_GAMMA}{DBL} * m * m) AS k1, exp(-{fx.PLANTED_GAMMA}{DBL} * 4.0{DBL} * m * m) AS k2 FROM st), "
                  f"a AS (SELECT 2.0{DBL} / (3.0{DBL} - 4.0{DBL} * k1 + k2) AS a1, k1 FROM k) "
                  "SELECT o_orderstatus AS cls, count(*) AS n_rows, "
                  f"{_r(f'CASE WHEN o_orderstatus = {chr(39)}O{chr(39)} THEN 2.0{DBL} * a1 ELSE a1 END', 4)} AS alpha, "
                  f"CASE WHEN o_orderstatus = 'O' THEN 1.0{DBL} ELSE -1.0{DBL} END AS score, "
                  f"{_r(f'2.0{DBL} * a1 * (1.0{DBL} - k1) - 1.0{DBL}', 4)} AS b FROM orders, a GROUP BY o_orderstatus, a1, k1"),
    "decision_tiled": (f"WITH {EMB}, {PM} SELECT t.id, {_r(f'sum(s.alpha * s.y * ' + _rbf('s.x', 't.x') + f') - {fx.PLANTED_B}{DBL}', 6)} AS score "
                       "FROM emb t, (SELECT * FROM pm WHERE alpha > 0) s GROUP BY t.id"),
    # the sum is a broken line in t: its zero lies between two breakpoints
    "project_start": (f"WITH s AS (SELECT vec_id AS id, CASE WHEN label < 5 THEN 1.0{DBL} ELSE -1.0{DBL} END AS y, "
                      f"{fx.PLANTED_C}{DBL} * (vec_id % {fx.PLANTED_ALPHA_MOD} - 2)::DOUBLE / 6.0{DBL} AS a FROM embeddings), "
                      f"bp AS (SELECT DISTINCT unnest([y * a, y * (a - {fx.PLANTED_C}{DBL})]) AS t FROM s), "
                      f"h AS (SELECT t, sum(y * least(greatest(a - t * y, 0.0{DBL}), {fx.PLANTED_C}{DBL})) AS h FROM bp, s GROUP BY t), "
                      "lo AS (SELECT t, h FROM h WHERE h >= 0 ORDER BY t DESC LIMIT 1), "
                      "hi AS (SELECT t, h FROM h WHERE h <= 0 ORDER BY t LIMIT 1), "
                      "z AS (SELECT CASE WHEN lo.h = hi.h THEN lo.t ELSE lo.t + lo.h * (hi.t - lo.t) / (lo.h - hi.h) END AS t FROM lo, hi) "
                      f"SELECT id, y, {_r(f'least(greatest(a - z.t * y, 0.0{DBL}), {fx.PLANTED_C}{DBL})', 6)} AS alpha FROM s, z"),
    "train_linear": f"WITH {PRICES} SELECT o_orderkey, label, label AS prediction FROM pr",
    "train_rff": ("WITH li AS (SELECT (l_quantity - 1.0::DOUBLE) / 49.0::DOUBLE AS q, l_extendedprice AS v FROM lineitem), "
                  "st AS (SELECT min(v) AS lo, max(v) AS hi FROM li), "
                  "x AS (SELECT q, (v - lo) / (hi - lo) AS d FROM li, st) "
                  "SELECT count(*) AS n_rows, count(*) FILTER ((q - 0.5::DOUBLE) * (q - 0.5::DOUBLE) "
                  f"+ (d - 0.5::DOUBLE) * (d - 0.5::DOUBLE) < {fx.RING_RADIUS_SQ}::DOUBLE) AS n_positive, "
                  "true AS accurate, true AS two_sided FROM x"),
    "svm_report": _report(),
    "svm_regression_report": _regression_report(),
    "pair_round": _pair_round(8),
    "zoned_choice": _zoned_choice(8),
    "blocked_weights": f"WITH {EMB}, {PM}, {WEIGHTS} SELECT pos::INTEGER AS pos, {_r('w', 9)} AS w FROM w",
    "blocked_score": (f"WITH {EMB}, {PM}, {WEIGHTS} SELECT e.id, {_r(f'sum(e.v * w.w) - {fx.PLANTED_B}{DBL}', 6)} AS score "
                      "FROM (SELECT id, unnest(x) AS v, generate_subscripts(x, 1) - 1 AS pos FROM emb) e "
                      "JOIN w USING (pos) GROUP BY e.id"),
    "rmse": (f"WITH {F6} SELECT count(*) AS n, {_r('avg((label - prediction) * (label - prediction))', 0)} AS mse, "
             f"{_r('sqrt(avg((label - prediction) * (label - prediction)))', 6)} AS rmse FROM f6"),
    "half_mse": (f"WITH {F6} SELECT count(*) AS n, "
                 f"{_r(f'0.5{DBL} * avg((label - prediction) * (label - prediction))', 0)} AS half_mse FROM f6"),
}
