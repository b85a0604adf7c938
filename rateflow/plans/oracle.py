"""Equivalent ANSI SQL (DuckDB dialect) for the named queries.

Written independently of the DataFrame code, straight from each operator's
definition, over the pre-registered tables.  ALS models have no SQL
form; of their queries only the pair and candidate sets are here.
"""

from __future__ import annotations

from rateflow.plans import catalog as C

RATINGS = """ratings AS (
  SELECT user_id, item_id, rating FROM (
    SELECT o.o_custkey AS user_id, l.l_suppkey AS item_id,
           CAST(ceil(l.l_quantity / 5) / 2 AS DOUBLE) AS rating,
           row_number() OVER (PARTITION BY o.o_custkey, l.l_suppkey
                              ORDER BY l.l_shipdate DESC, l.l_orderkey DESC, l.l_linenumber DESC,
                                       l.l_partkey DESC, l.l_quantity DESC) AS rn
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey) t
  WHERE rn = 1)"""

ITEMS = "items AS (SELECT s_suppkey AS item_id, s_name AS title FROM supplier)"

ROWS = """rows_ AS (SELECT event_id AS line, user_id, CAST(floor(value) AS BIGINT) AS item_id
  FROM events)"""

PREV = """prev AS (
  SELECT line, user_id, item_id,
         coalesce(lag(user_id) OVER (ORDER BY line), 0) AS prev_user_id,
         coalesce(lag(item_id) OVER (ORDER BY line), 0) AS prev_item_id
  FROM rows_)"""


def _hash(*cols: str) -> str:
    return f"CAST(('0x' || substr(md5(concat_ws('|', {', '.join(cols)})), 1, 8)) AS BIGINT)"


def _split(seeds) -> str:
    seeds = [seeds] if isinstance(seeds, int) else list(seeds)
    seed_list = ", ".join(str(int(s)) for s in seeds)
    return f"""split AS (
  SELECT seed, user_id, item_id, rating,
         CASE WHEN b < 6 THEN 'train' WHEN b < 8 THEN 'validation' ELSE 'test' END AS part
  FROM (SELECT s.seed, r.user_id, r.item_id, r.rating,
               {_hash('s.seed', 'r.user_id', 'r.item_id')} % 10 AS b
        FROM ratings r CROSS JOIN (SELECT unnest([{seed_list}]) AS seed) s) x)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


SIM_EXPR = "CASE WHEN sqrt(s1) * sqrt(s2) <> 0 THEN dot / (sqrt(s1) * sqrt(s2)) ELSE 0.0 END"


def _sums(src: str, cond: str, group: str, key: str = "") -> str:
    k = f"a.{key} AS {key}, " if key else ""
    kj = f"a.{key} = b.{key} AND " if key else ""
    kg = f"a.{key}, " if key else ""
    return f"""SELECT {k}a.user_id AS u, b.user_id AS v,
         sum(a.rating * b.rating) AS dot, sum(a.rating * a.rating) AS s1,
         sum(b.rating * b.rating) AS s2, count(*) AS n
  FROM {src} a JOIN {src} b ON {kj}a.item_id = b.item_id AND {cond}
  {group.format(kg=kg)}"""


def _nbr_ctes(src: str, key: str = "", k: int = C.K, min_common: int = C.MIN_COMMON) -> list[str]:
    kc = f"{key}, " if key else ""
    sums = _sums(src, "a.user_id < b.user_id",
                 "GROUP BY {kg}a.user_id, b.user_id HAVING count(*) >= " + str(min_common), key)
    return [
        f"tsim AS ({sums})",
        f"""tdir AS (
  SELECT {kc}u AS user_id, v AS nb, {SIM_EXPR} AS sim, n FROM tsim
  UNION ALL
  SELECT {kc}v AS user_id, u AS nb, {SIM_EXPR} AS sim, n FROM tsim)""",
        f"""nbrs AS (
  SELECT * FROM (
    SELECT {kc}user_id, nb, sim, n,
           CAST(row_number() OVER (PARTITION BY {kc}user_id ORDER BY sim DESC, nb ASC) AS INTEGER) AS rk
    FROM tdir) z
  WHERE rk <= {k})""",
    ]


def _knn_ctes(seeds) -> list[str]:
    return [
        RATINGS, _split(seeds),
        "train AS (SELECT seed, user_id, item_id, rating FROM split WHERE part = 'train')",
        "means AS (SELECT seed, user_id, avg(rating) AS mean_rating FROM train GROUP BY seed, user_id)",
        *_nbr_ctes("train", "seed", C.K_GRID[-1]),
        """dev AS (
  SELECT t.seed, t.user_id AS nb, t.item_id, t.rating - m.mean_rating AS dev
  FROM train t JOIN means m ON t.seed = m.seed AND t.user_id = m.user_id)""",
    ]


def _pred_expr(a: str = "a", m: str = "m") -> str:
    mu = f"coalesce({m}.mean_rating, 0.0)"
    return (f"CASE WHEN {a}.ss IS NOT NULL AND {a}.ss <> 0 THEN {mu} + {a}.ws / {a}.ss "
            f"ELSE {mu} END")


def _knn_agg(k: int) -> str:
    return f"""agg AS (
  SELECT p.seed, p.user_id, p.item_id, sum(n.sim * d.dev) AS ws, sum(abs(n.sim)) AS ss
  FROM tgt p
  JOIN nbrs n ON p.seed = n.seed AND p.user_id = n.user_id
  JOIN dev d ON d.seed = n.seed AND d.nb = n.nb AND d.item_id = p.item_id
  WHERE n.rk <= {k}
  GROUP BY p.seed, p.user_id, p.item_id)"""


def _knn_errors_by_k_sql() -> str:
    ks = ", ".join(str(k) for k in C.K_GRID)
    return _with(
        *_knn_ctes(C.KNN_SEEDS),
        "tgt AS (SELECT seed, user_id, item_id, rating FROM split WHERE part = 'validation')",
        f"ks AS (SELECT unnest([{ks}]) AS k)",
        """aggk AS (
  SELECT p.seed, p.user_id, p.item_id, ks.k, sum(n.sim * d.dev) AS ws, sum(abs(n.sim)) AS ss
  FROM tgt p
  JOIN nbrs n ON p.seed = n.seed AND p.user_id = n.user_id
  JOIN dev d ON d.seed = n.seed AND d.nb = n.nb AND d.item_id = p.item_id
  JOIN ks ON n.rk <= ks.k
  GROUP BY p.seed, p.user_id, p.item_id, ks.k)""",
        f"""pred AS (
  SELECT p.seed, ks.k, p.rating, {_pred_expr()} AS prediction
  FROM tgt p CROSS JOIN ks
  LEFT JOIN aggk a ON a.seed = p.seed AND a.user_id = p.user_id AND a.item_id = p.item_id AND a.k = ks.k
  LEFT JOIN means m ON m.seed = p.seed AND m.user_id = p.user_id)""",
        """e AS (
  SELECT seed, k, sqrt(avg((prediction - rating) * (prediction - rating))) AS rmse,
         avg(abs(prediction - rating)) AS mae, count(prediction) AS n,
         count(prediction) / count(*) AS coverage
  FROM pred GROUP BY seed, k)""",
        """errs AS (
  SELECT CAST(k AS INTEGER) AS k, round(avg(rmse), 6) AS rmse, round(avg(mae), 6) AS mae,
         CAST(sum(n) AS BIGINT) AS n, round(avg(coverage), 6) AS coverage, count(*) AS n_seeds
  FROM e GROUP BY k)""",
    )


def _recs_sql(nbr_ctes: list[str], titled: bool) -> str:
    body = _with(
        RATINGS, ITEMS, *nbr_ctes,
        f"""agg AS (
  SELECT n.user_id, r.item_id, sum(n.sim * r.rating) AS ws, sum(n.sim) AS ss
  FROM nbrs n JOIN ratings r ON r.user_id = n.nb
  WHERE n.rk <= {C.K}
  GROUP BY n.user_id, r.item_id
  HAVING sum(n.sim) <> 0)""",
        f"""recs AS (
  SELECT * FROM (
    SELECT user_id, item_id, score,
           CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id ASC) AS INTEGER) AS rk
    FROM (SELECT user_id, item_id, round(ws / ss, {C.DIGITS}) AS score FROM agg) s) z
  WHERE rk <= {C.REC_N})""",
    )
    if titled:
        return body + "SELECT r.user_id, r.rk, r.item_id, r.score, i.title FROM recs r LEFT JOIN items i ON r.item_id = i.item_id"
    return body + "SELECT user_id, rk, item_id, score FROM recs"


def _for_user_nbrs() -> list[str]:
    sums = _sums("ratings", f"a.user_id <> b.user_id WHERE a.user_id = {C.USER}",
                 f"GROUP BY a.user_id, b.user_id HAVING count(*) >= {C.MIN_COMMON}")
    return [
        f"tsim AS ({sums})",
        f"""nbrs AS (
  SELECT * FROM (
    SELECT u AS user_id, v AS nb, {SIM_EXPR} AS sim, n,
           CAST(row_number() OVER (PARTITION BY u ORDER BY {SIM_EXPR} DESC, v ASC) AS INTEGER) AS rk
    FROM tsim) z
  WHERE rk <= {C.K})""",
    ]


def _histogram(key: str) -> str:
    inc = "(CAST(mx - mn AS DOUBLE) / nb)"
    return _with(
        RATINGS,
        f"counts AS (SELECT {key}, count(*) AS c FROM ratings GROUP BY {key})",
        "st AS (SELECT min(c) AS mn, max(c) AS mx, CASE WHEN min(c) = max(c) THEN 1 ELSE 20 END AS nb FROM counts)",
        """frame AS (
  SELECT CAST(g.bucket AS INTEGER) AS bucket, st.mn, st.mx, st.nb
  FROM st CROSS JOIN (SELECT unnest(range(0, 20)) AS bucket) g WHERE g.bucket < st.nb)""",
        f"""filled AS (
  SELECT CAST(CASE WHEN st.mx = st.mn THEN 0
                   ELSE least(floor((c.c - st.mn) / (CAST(st.mx - st.mn AS DOUBLE) / st.nb)), st.nb - 1)
              END AS INTEGER) AS bucket, count(*) AS n
  FROM counts c CROSS JOIN st GROUP BY 1)""",
    ) + f"""SELECT f.bucket, f.bucket * {inc} + f.mn AS lo,
       CASE WHEN f.bucket = f.nb - 1 THEN CAST(f.mx AS DOUBLE) ELSE (f.bucket + 1) * {inc} + f.mn END AS hi,
       CAST(coalesce(fl.n, 0) AS BIGINT) AS n
FROM frame f LEFT JOIN filled fl ON f.bucket = fl.bucket"""


_MEAN_ERRORS = """SELECT round(avg(rmse), 6) AS rmse, round(avg(mae), 6) AS mae, CAST(sum(n) AS BIGINT) AS n,
       round(avg(coverage), 6) AS coverage, count(*) AS n_seeds FROM e"""


def _sample(table: str, col: str, n: int) -> str:
    return (f"SELECT {col} FROM (SELECT DISTINCT {col} FROM {table}) d "
            f"ORDER BY {_hash(str(C.SAMPLE_SEED), col)}, {col} LIMIT {n}")


def _active(src: str) -> list[str]:
    return [f"""kept AS (
  SELECT * FROM {src}
  WHERE user_id IN (SELECT user_id FROM {src} GROUP BY user_id HAVING count(*) >= {C.SAMPLE_MIN}))""",
            """ids AS (
  SELECT user_id, CAST(dense_rank() OVER (ORDER BY user_id) AS BIGINT) AS new_id
  FROM (SELECT DISTINCT user_id FROM kept) d)"""]


_SAMPLE_CTES = [
    RATINGS, ITEMS,
    "users AS (SELECT c_custkey AS user_id FROM customer)",
    f"su AS ({_sample('users', 'user_id', C.SAMPLE_USERS)})",
    f"si AS ({_sample('items', 'item_id', C.SAMPLE_ITEMS)})",
    """restricted AS (
  SELECT user_id, item_id, rating FROM ratings
  WHERE user_id IN (SELECT user_id FROM su) AND item_id IN (SELECT item_id FROM si))""",
    *_active("restricted"),
]
_ACTIVE_CTES = [RATINGS, *_active("ratings")]


STEP_BAD = "NOT (user_id = prev_user_id OR user_id = prev_user_id + 1)"
ITEM_BAD = "(user_id = prev_user_id AND item_id < prev_item_id)"
ORDER_FLAGS = f"""SELECT coalesce(NOT bool_or(user_id < prev_user_id), true) AS user_order_ok,
       coalesce(NOT bool_or({STEP_BAD}), true) AS user_step_ok,
       coalesce(NOT bool_or({ITEM_BAD}), true) AS item_order_ok,
       count(*) FILTER (WHERE {STEP_BAD}) AS n_user_step_violations,
       count(*) FILTER (WHERE {ITEM_BAD}) AS n_item_order_violations
FROM prev"""

LINES = """lines AS (
  SELECT CASE (user_id * 31 + item_id) % 11
           WHEN 0 THEN printf('%d', user_id) WHEN 1 THEN printf('%d,x,nan', user_id)
           WHEN 2 THEN printf('%d,%d,nan', user_id, item_id) WHEN 3 THEN printf('u,%d,3.0', item_id)
           WHEN 4 THEN '' ELSE printf('%d,%d,%.1f', user_id, item_id, rating) END AS value
  FROM ratings)"""
FIELDS = """fields AS (
  SELECT value, try_cast(trim(f[1]) AS BIGINT) AS user_id, try_cast(trim(f[2]) AS BIGINT) AS item_id,
         try_cast(trim(f[3]) AS DOUBLE) AS rating
  FROM (SELECT value, string_split(value, ',') AS f FROM lines) t)"""
VALID = "(user_id IS NOT NULL AND item_id IS NOT NULL AND rating IS NOT NULL AND isfinite(rating))"


# The sorted file: a header, then one line per rating; spoilt lines only count.
FILE_ROWS = """rows_ AS (
  SELECT user_id, item_id, rating, line FROM (
    SELECT user_id, item_id, rating, row_number() OVER (ORDER BY user_id, item_id) + 1 AS line FROM ratings) t
  WHERE (user_id * 31 + item_id) % 11 >= 5)"""
# Several ratings of one (user, item), numbered in the order of time.
OCCURRENCES = """lines AS (
  SELECT o.o_custkey AS user_id, l.l_suppkey AS item_id, CAST(ceil(l.l_quantity / 5) / 2 AS DOUBLE) AS rating,
         row_number() OVER (PARTITION BY o.o_custkey, l.l_suppkey
                            ORDER BY l.l_shipdate, l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity) AS occurrence
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


def _files() -> dict[str, str]:
    least = C.SAMPLE_MIN
    head = _with(RATINGS, FILE_ROWS, PREV)
    shelves = _with(RATINGS, LINES.replace("AS value\n", "AS value, user_id % 4 AS shelf\n"),
                    FIELDS.replace("SELECT value,", "SELECT shelf, value,"),
                    f"good AS (SELECT *, coalesce({VALID}, false) AS ok FROM fields)")

    def active(src: str, n: int) -> str:
        return f"""SELECT count(*) AS n_rows, sum(rating) AS total FROM {src}
  WHERE user_id IN (SELECT user_id FROM {src} GROUP BY user_id HAVING count(*) >= {n})"""

    steps = [("first", True, "ratings", least), ("same", False, "ratings", least), ("reordered", False, "ratings", least),
             ("parameter", True, "ratings", least + 1), ("input", True, "fewer", least), ("input again", False, "fewer", least)]
    return {
        "file_order_facts": head + ORDER_FLAGS.replace("\nFROM prev", f""",
       (SELECT arg_max(user_id, line) FROM rows_) AS last_user_id, (SELECT max(line) FROM rows_) AS last_line,
       (SELECT count(*) FROM rows_) AS n_rows, (SELECT count(*) + 1 FROM ratings) AS n_lines,
       (SELECT string_agg(printf('%.1f:%d', rating, n), ',' ORDER BY rating)
        FROM (SELECT rating, count(*) AS n FROM rows_ GROUP BY rating) v) AS rating_counts
FROM prev"""),
        "file_order_offenders": _with(ROWS.replace("event_id AS line", "row_number() OVER (ORDER BY event_id) + 1 AS line"), PREV)
        + f"""SELECT 'step' AS kind, prev_user_id AS before, user_id AS own, line
FROM prev WHERE {STEP_BAD} UNION ALL SELECT 'item', prev_item_id, item_id, line FROM prev WHERE {ITEM_BAD}""",
        "imported_ratings": shelves + "SELECT shelf, user_id, item_id, rating FROM good WHERE ok",
        "import_counts": shelves + """SELECT shelf, count(*) AS lines, count(*) FILTER (WHERE ok) AS accepted,
       count(*) FILTER (WHERE NOT ok) AS rejected, (SELECT count(*) FROM good) AS all_lines,
       (SELECT count(*) FROM good WHERE ok) AS all_accepted, (SELECT count(*) FROM good WHERE NOT ok) AS all_rejected
FROM good GROUP BY shelf""",
        "built_once": _with(RATINGS, f"fewer AS (SELECT * FROM ratings WHERE user_id <> {C.USER})") + " UNION ALL ".join(
            f"SELECT '{step}' AS step, {str(built).lower()} AS built, n_rows, total FROM ({active(src, n)}) x"
            for step, built, src, n in steps),
        "co_ratings_with_duplicates": _with(OCCURRENCES) + f"""SELECT a.user_id AS u, b.user_id AS v,
       sum(a.rating * b.rating) AS dot, sum(a.rating * a.rating) AS s1, sum(b.rating * b.rating) AS s2, count(*) AS n
FROM lines a JOIN lines b ON a.item_id = b.item_id AND a.occurrence = b.occurrence AND a.user_id < b.user_id
GROUP BY a.user_id, b.user_id HAVING count(*) >= {C.MIN_COMMON}""",
    }


def _factor_ctes(src: str = "ratings", key: str = "") -> list[str]:
    """Alternating least squares of rank 2, by the inverse of the 2 x 2 matrix."""
    k, rk, on = (f"{key}, ", f"r.{key}, ", f"AND s.{key} = r.{key} ") if key else ("", "", "")
    hashed = [*([key] if key else []), "user_id"]
    start = ", ".join(f"{_hash(*hashed, str(n))} / 2147483648.0 - 1 AS f{n + 1}" for n in range(2))
    out = [f"u0 AS (SELECT {k}user_id AS id, {start} FROM (SELECT DISTINCT {k}user_id FROM {src}) d)"]
    for i in range(1, C.SMALL_ITERS + 1):
        for name, own, other, known in ((f"v{i}", "item_id", "user_id", f"u{i - 1}"), (f"u{i}", "user_id", "item_id", f"v{i}")):
            out.append(f"""{name} AS MATERIALIZED (
  SELECT {k}id, (a22 * b1 - a12 * b2) / (a11 * a22 - a12 * a12) AS f1, (a11 * b2 - a12 * b1) / (a11 * a22 - a12 * a12) AS f2
  FROM (SELECT {rk}r.{own} AS id, sum(f1 * f1) + {C.ALS_REG} * count(*) AS a11, sum(f1 * f2) AS a12,
               sum(f2 * f2) + {C.ALS_REG} * count(*) AS a22, sum(f1 * rating) AS b1, sum(f2 * rating) AS b2
        FROM {src} r JOIN {known} s ON s.id = r.{other} {on}GROUP BY {rk}r.{own}) t)""")
    return out


def _factors() -> dict[str, str]:
    last, d = C.SMALL_ITERS, C.DIGITS
    pred = " UNION ALL ".join(f"""SELECT t.seed, {i} AS iteration, t.rating, u.f1 * v.f1 + u.f2 * v.f2 AS prediction
  FROM split t JOIN u{i} u ON u.seed = t.seed AND u.id = t.user_id JOIN v{i} v ON v.seed = t.seed AND v.id = t.item_id
  WHERE t.part = 'test'""" for i in range(1, last + 1))
    return {
        "als_factor_errors": _with(
            RATINGS, _split(C.ALS_SEEDS), "train AS (SELECT seed, user_id, item_id, rating FROM split WHERE part = 'train')",
            *_factor_ctes("train", "seed"), f"pred AS ({pred})",
            """e AS (SELECT seed, iteration, sqrt(avg((prediction - rating) ** 2)) AS rmse,
         avg(abs(prediction - rating)) AS mae, count(*) AS n FROM pred GROUP BY seed, iteration)""")
        + """SELECT CAST(iteration AS INTEGER) AS iteration, round(avg(rmse), 6) AS rmse, round(avg(mae), 6) AS mae,
       CAST(sum(n) AS BIGINT) AS n, count(*) AS n_seeds FROM e GROUP BY iteration""",
        "als_factor_steps": _with(RATINGS, *_factor_ctes()) + " UNION ALL ".join(
            f"SELECT '{kind}' AS kind, id, round(f1, {d}) AS f1, round(f2, {d}) AS f2 FROM {t}{last}"
            for kind, t in (("user", "u"), ("item", "v"))),
        "als_recommendations_all": _with(RATINGS, *_factor_ctes(), ITEMS, f"""scored AS (
  SELECT u.id AS user_id, c.item_id, i.title, c.n, round(u.f1 * v.f1 + u.f2 * v.f2, {d}) AS prediction
  FROM u{last} u CROSS JOIN (SELECT item_id, count(*) AS n FROM ratings GROUP BY item_id HAVING count(*) > {C.ALS_MIN_COUNT}) c
  JOIN v{last} v ON v.id = c.item_id JOIN items i ON i.item_id = c.item_id
  WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.user_id = u.id AND r.item_id = c.item_id))""") + f"""SELECT * FROM (
  SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY prediction DESC, item_id) AS INTEGER) AS rk,
         item_id, title, prediction, n FROM scored) t WHERE rk <= {C.REC_N}""",
        "als_reloaded_predictions": _with(RATINGS, _split(C.SEED)) + """, train AS (SELECT user_id, item_id FROM split WHERE part = 'train')
SELECT user_id, item_id, true AS agrees FROM split WHERE part = 'test'
  AND user_id IN (SELECT user_id FROM train) AND item_id IN (SELECT item_id FROM train)""",
    }


def _order_checks() -> dict[str, str]:
    head = _with(ROWS, PREV)
    return {
        "user_order_check": head + ORDER_FLAGS,
        "user_step_violations": head + f"SELECT prev_user_id, user_id, line FROM prev WHERE {STEP_BAD}",
        "item_order_violations": head + f"SELECT prev_item_id, item_id, line FROM prev WHERE {ITEM_BAD}",
        "last_row_facts": _with(ROWS) + (
            "SELECT arg_max(user_id, line) AS last_user_id, max(line) AS last_line, count(*) AS n_rows FROM rows_"),
    }


def oracle_sql() -> dict[str, str]:
    r = _with(RATINGS)
    ri = _with(RATINGS, ITEMS)
    sim_all = _with(RATINGS, f"tsim AS ({_sums('ratings', 'a.user_id < b.user_id', 'GROUP BY a.user_id, b.user_id')})")
    s0 = _with(RATINGS, _split(C.SEED))
    sql = {
        "ratings": r + "SELECT user_id, item_id, rating FROM ratings",
        "row_counts": ri + "SELECT (SELECT count(*) FROM ratings) AS n_ratings, (SELECT count(*) FROM items) AS n_items",
        "preview": r + "SELECT user_id, item_id, rating FROM ratings ORDER BY user_id, item_id LIMIT 3",
        "rating_distribution": r + "SELECT rating, count(*) AS n FROM ratings GROUP BY rating",
        "overall_mean": _with(RATINGS, "dist AS (SELECT rating, count(*) AS n FROM ratings GROUP BY rating)")
        + "SELECT sum(rating * n) / sum(n) AS mean_rating FROM dist",
        "parsed_ratings": _with(RATINGS, LINES, FIELDS) + f"SELECT user_id, item_id, rating FROM fields WHERE {VALID}",
        "rejected_ratings": _with(RATINGS, LINES, FIELDS) + f"SELECT value FROM fields WHERE NOT coalesce({VALID}, false)",
        "parsed_items": """SELECT p_partkey AS item_id, p_name || ', The' AS title,
       CAST(len(string_split(p_name, ' ')) AS INTEGER) AS n_genres
FROM part WHERE p_partkey % 7 <> 0""",
        "rating_order_check": _with(RATINGS, "rows_ AS (SELECT user_id, item_id, row_number() OVER "
                                    "(ORDER BY user_id, item_id) AS line FROM ratings)", PREV) + ORDER_FLAGS,
        "als_scored_pairs": s0 + """, train AS (SELECT user_id, item_id FROM split WHERE part = 'train')
SELECT user_id, item_id FROM split WHERE part = 'test'
  AND user_id IN (SELECT user_id FROM train) AND item_id IN (SELECT item_id FROM train)""",
        "als_candidates": ri + f"""SELECT CAST({C.USER} AS BIGINT) AS user_id, i.item_id, i.title, s.n
FROM items i JOIN (SELECT item_id, count(*) AS n FROM ratings GROUP BY item_id) s ON s.item_id = i.item_id
WHERE s.n > {C.ALS_MIN_COUNT} AND i.item_id NOT IN (SELECT item_id FROM ratings WHERE user_id = {C.USER})""",
        "item_activity_histogram": _histogram("item_id"),
        "user_activity_histogram": _histogram("user_id"),
        "item_rating_distribution": r + f"SELECT rating, count(*) AS n FROM ratings WHERE item_id = {C.ITEM} GROUP BY rating",
        "user_rating_distribution": r + f"SELECT rating, count(*) AS n FROM ratings WHERE user_id = {C.USER} GROUP BY rating",
        **_order_checks(),
        **_files(),
        **_factors(),
        "item_catalog": _with(ITEMS) + "SELECT DISTINCT item_id FROM items",
        "items_with_genres": """SELECT item_id, title, CAST(i AS INTEGER) AS genre_pos, g[i] AS genre
FROM (SELECT p_partkey AS item_id, p_name AS title, string_split(p_name, ' ') AS g,
             unnest(range(1, len(string_split(p_name, ' ')) + 1)) AS i
      FROM part) t""",
        "sample_items": _with(*_SAMPLE_CTES) + "SELECT item_id FROM si",
        "sample_users": _with(*_SAMPLE_CTES) + "SELECT user_id FROM su",
        "restrict_ratings": _with(*_SAMPLE_CTES) + "SELECT user_id, item_id, rating FROM restricted",
        "min_activity": _with(*_ACTIVE_CTES) + "SELECT user_id, item_id, rating FROM kept",
        "dense_user_ids": _with(*_ACTIVE_CTES) + "SELECT user_id, new_id FROM ids",
        "kept_users": _with(*_ACTIVE_CTES) + "SELECT DISTINCT user_id FROM kept",
        "sampled_ratings": _with(*_SAMPLE_CTES)
        + "SELECT i.new_id AS user_id, k.item_id, k.rating FROM kept k JOIN ids i ON k.user_id = i.user_id",
        "split_sizes": _with(RATINGS, _split(C.BASELINE_SEEDS))
        + "SELECT seed, part, count(*) AS n FROM split GROUP BY seed, part",
        "union_splits": s0 + """SELECT user_id, item_id, rating FROM split WHERE part = 'train'
UNION ALL SELECT user_id, item_id, rating FROM split WHERE part = 'validation'""",
        "prediction_pairs": s0 + "SELECT user_id, item_id FROM split WHERE part = 'test'",
        "user_means": r + "SELECT user_id, avg(rating) AS mean_rating FROM ratings GROUP BY user_id",
        "item_stats": r + "SELECT item_id, count(*) AS n, avg(rating) AS mean_rating FROM ratings GROUP BY item_id",
        "item_counts": r + "SELECT item_id, count(*) AS n FROM ratings GROUP BY item_id",
        "user_histories": r + """SELECT user_id, item_id, rating,
       row_number() OVER (PARTITION BY user_id ORDER BY item_id) AS pos
FROM ratings""",
        "baseline_predictions": s0 + """, means AS (
  SELECT user_id, avg(rating) AS mean_rating FROM split WHERE part <> 'test' GROUP BY user_id)
SELECT t.user_id, t.item_id, coalesce(m.mean_rating, 0.0) AS prediction
FROM split t LEFT JOIN means m ON t.user_id = m.user_id WHERE t.part = 'test'""",
        "prediction_errors": s0 + f""", known AS (
  SELECT user_id, avg(rating) AS mean_rating FROM split WHERE part = 'train'
  GROUP BY user_id HAVING count(*) >= {C.PREDICT_MIN})
SELECT round(sqrt(avg((k.mean_rating - t.rating) ** 2)), 6) AS rmse,
       round(avg(abs(k.mean_rating - t.rating)), 6) AS mae,
       count(k.mean_rating) AS n, count(k.mean_rating) / count(*) AS coverage
FROM split t LEFT JOIN known k ON t.user_id = k.user_id WHERE t.part = 'test'""",
        "baseline_errors": _with(
            RATINGS, _split(C.BASELINE_SEEDS),
            "means AS (SELECT seed, user_id, avg(rating) AS mean_rating FROM split WHERE part <> 'test' GROUP BY seed, user_id)",
            """pred AS (
  SELECT t.seed, t.rating, coalesce(m.mean_rating, 0.0) AS prediction
  FROM split t LEFT JOIN means m ON t.seed = m.seed AND t.user_id = m.user_id
  WHERE t.part = 'test')""",
            """e AS (
  SELECT seed, sqrt(avg((prediction - rating) * (prediction - rating))) AS rmse,
         avg(abs(prediction - rating)) AS mae, count(prediction) AS n,
         count(prediction) / count(*) AS coverage
  FROM pred GROUP BY seed)""",
        ) + _MEAN_ERRORS,
        "co_rating_pairs": r + """SELECT a.item_id, a.user_id AS u, b.user_id AS v, a.rating AS ru, b.rating AS rv
FROM ratings a JOIN ratings b ON a.item_id = b.item_id AND a.user_id < b.user_id""",
        "user_similarity": sim_all + f"SELECT u, v, {SIM_EXPR} AS sim, n FROM tsim",
        "directed_similarity": sim_all + f"""SELECT u AS user_id, v AS nb, {SIM_EXPR} AS sim, n FROM tsim
UNION ALL SELECT v AS user_id, u AS nb, {SIM_EXPR} AS sim, n FROM tsim""",
        "top_neighbours": _with(RATINGS, *_nbr_ctes("ratings"))
        + "SELECT user_id, nb, sim, n, rk FROM nbrs",
        "knn_predictions": _with(
            *_knn_ctes(C.SEED),
            "tgt AS (SELECT seed, user_id, item_id FROM split WHERE part = 'test')",
            _knn_agg(C.K),
        ) + f"""SELECT p.user_id, p.item_id, round({_pred_expr()}, {C.DIGITS}) AS prediction
FROM tgt p
LEFT JOIN agg a ON a.seed = p.seed AND a.user_id = p.user_id AND a.item_id = p.item_id
LEFT JOIN means m ON m.seed = p.seed AND m.user_id = p.user_id""",
        "knn_errors_by_k": _knn_errors_by_k_sql() + "SELECT k, rmse, mae, n, coverage, n_seeds FROM errs",
        "knn_test_errors": _with(
            *_knn_ctes(C.KNN_SEEDS),
            "tgt AS (SELECT seed, user_id, item_id, rating FROM split WHERE part = 'test')",
            _knn_agg(C.K),
            f"""pred AS (
  SELECT p.seed, p.rating, {_pred_expr()} AS prediction
  FROM tgt p
  LEFT JOIN agg a ON a.seed = p.seed AND a.user_id = p.user_id AND a.item_id = p.item_id
  LEFT JOIN means m ON m.seed = p.seed AND m.user_id = p.user_id)""",
            """e AS (
  SELECT seed, sqrt(avg((prediction - rating) * (prediction - rating))) AS rmse,
         avg(abs(prediction - rating)) AS mae, count(prediction) AS n,
         count(prediction) / count(*) AS coverage
  FROM pred GROUP BY seed)""",
        ) + _MEAN_ERRORS,
        "best_k": _knn_errors_by_k_sql()
        + "SELECT (SELECT k FROM errs ORDER BY rmse, k LIMIT 1) AS best_k, (SELECT min(rmse) FROM errs) AS rmse",
        "knn_recommendations": _recs_sql(_nbr_ctes("ratings"), titled=False),
        "knn_recommendations_titled": _recs_sql(_nbr_ctes("ratings"), titled=True),
        "knn_recommendations_for_user": _recs_sql(_for_user_nbrs(), titled=True),
        "popular_items": ri + f"""SELECT s.item_id, i.title, s.mean_rating, s.n
FROM (SELECT item_id, count(*) AS n, avg(rating) AS mean_rating
      FROM ratings GROUP BY item_id HAVING count(*) > {C.POPULAR_MIN}) s
JOIN items i ON s.item_id = i.item_id
ORDER BY s.mean_rating DESC, s.item_id ASC LIMIT {C.POPULAR_N}""",
        "unrated_items": ri + f"""SELECT CAST({C.USER} AS BIGINT) AS user_id, item_id
FROM (SELECT DISTINCT item_id FROM items) d
WHERE item_id NOT IN (SELECT item_id FROM ratings WHERE user_id = {C.USER})""",
    }
    return sql
