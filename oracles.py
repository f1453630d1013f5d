"""DuckDB SQL with the expected result of each query."""

from __future__ import annotations

ACTIONS = [
    "business_requirement_1", "business_requirement_2", "recurring_action", "auto_transport",
    "next_positive", "small_action", "long_term", "transport_action",
]
RULES = ACTIONS[:2]
SHARES = {
    "recurring_action": "share_urgent",
    "auto_transport": "share_high",
    "next_positive": "share_medium",
    "small_action": "share_unspec",
    "long_term": "share_low",
    "transport_action": "return_share",
}
PRIORITY = {
    "urgent": "1-URGENT",
    "high": "2-HIGH",
    "medium": "3-MEDIUM",
    "unspec": "4-NOT SPECIFIED",
    "low": "5-LOW",
}
MODIFIER = {
    "business_requirement_1": "1.01",
    "business_requirement_2": "1.00",
    "recurring_action": "0.9151",
    "auto_transport": "0.6667",
    "next_positive": "0.81673",
    "small_action": "0.7852",
    "long_term": "0.6453",
    "transport_action": "0.6657",
}
FEATURES = [
    "segment", "acctbal", "n_orders", "amt_sum", "amt_avg", "recency_days", "tenure_days",
    *SHARES.values(),
]
CUTOFF = "TIMESTAMP '2001-01-01'"
AS_OF = "TIMESTAMP '2001-07-01'"
PAST = f"o_orderdate < {CUTOFF}"
WINDOW = f"o_orderdate >= {CUTOFF}"


def _hash(key: str, seed: int | None = None) -> str:
    text = f"CAST({key} AS VARCHAR)" + (f" || '|{seed}'" if seed is not None else "")
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


def _cols(names, prefix="") -> str:
    return ", ".join(f"{prefix}{n}" for n in names)


def _profile() -> str:
    counts = ",\n  ".join(
        f"count(*) FILTER ({PAST} AND o_orderpriority = '{p}') AS n_{s},"
        f" count(*) FILTER ({WINDOW} AND o_orderpriority = '{p}') AS w_{s}"
        for s, p in PRIORITY.items()
    )
    shares = ", ".join(
        f"CASE WHEN coalesce(n_orders, 0) > 0 THEN CAST(n_{s} AS DOUBLE) / n_orders END AS share_{s}" for s in PRIORITY
    )
    taken = ", ".join(
        f"CASE WHEN w_{share.removeprefix('share_')} > 0 THEN 1 ELSE 0 END AS {a}_binary"
        for a, share in SHARES.items()
        if a != "transport_action"
    )
    return f"""
items AS (
  SELECT l_orderkey, count(*) AS items, count(*) FILTER (l_returnflag = 'R') AS returned FROM lineitem GROUP BY 1
),
activity AS (
  SELECT o_custkey AS id,
  count(*) FILTER ({PAST}) AS n_orders,
  round(sum(o_totalprice) FILTER ({PAST}), 2) AS amt_sum,
  min(o_orderdate) FILTER ({PAST}) AS first_at,
  max(o_orderdate) FILTER ({PAST}) AS last_at,
  sum(items) FILTER ({PAST}) AS n_items,
  sum(returned) FILTER ({PAST}) AS n_returned,
  sum(returned) FILTER ({WINDOW}) AS w_returned,
  count(*) FILTER ({WINDOW} AND o_orderstatus = 'P') AS w_status_p,
  {counts}
  FROM orders LEFT JOIN items ON o_orderkey = l_orderkey
  WHERE o_orderdate < {AS_OF} GROUP BY 1
),
profile AS (
  SELECT c_custkey AS id,
  CASE WHEN c_mktsegment = 'FURNITURE' THEN 'null' ELSE c_mktsegment END AS segment,
  c_acctbal AS acctbal,
  coalesce(n_orders, 0) AS n_orders,
  coalesce(amt_sum, 0.0) AS amt_sum,
  CASE WHEN n_orders > 0 THEN amt_sum / n_orders END AS amt_avg,
  date_diff('day', CAST(last_at AS DATE), DATE '2001-01-01') AS recency_days,
  date_diff('day', CAST(first_at AS DATE), DATE '2001-01-01') AS tenure_days,
  {shares},
  CASE WHEN n_items > 0 THEN CAST(n_returned AS DOUBLE) / CAST(n_items AS DOUBLE) END AS return_share,
  CASE WHEN c_acctbal >= 0 THEN 1 ELSE 0 END AS business_requirement_1_binary,
  CASE WHEN w_status_p > 0 THEN 1 ELSE 0 END AS business_requirement_2_binary,
  {taken},
  CASE WHEN w_returned > 0 THEN 1 ELSE 0 END AS transport_action_binary
  FROM customer LEFT JOIN activity ON c_custkey = activity.id
)"""


PROFILE = _profile()
MODEL_FEATURES = ["segment", "acctbal", "n_orders", "amt_avg", "recency_days", "tenure_days", "share_urgent"]


def _complete(share: str) -> str:
    names = [*MODEL_FEATURES[:-1], share]
    return " AND ".join(f"{'nullif(segment, ' + repr('null') + ')' if n == 'segment' else n} IS NOT NULL" for n in names)


def _scores() -> str:
    parts = []
    for a, share in SHARES.items():
        real = f"{share} IS NOT NULL" if a == "transport_action" else _complete(share)
        limit = "CAST(1 AS DOUBLE) / 3" if a == "transport_action" else "CAST(0.2 AS DOUBLE)"
        real = f"({a}_binary = 0 AND {real})"
        parts += [
            f"CASE WHEN {real} THEN {share} ELSE 0.0 END AS {a}_probability",
            f"CASE WHEN {real} AND {share} >= {limit} THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS {a}_prediction",
            f"{real} AS {a}_scored",
        ]
    flags = _cols([f"{a}_binary" for a in ACTIONS])
    return f"scores AS (SELECT id, {flags}, " + ",\n  ".join(parts) + " FROM profile)"


SCORES = _scores()


def _action_scores() -> str:
    def mod(a: str) -> str:
        return f"CAST({MODIFIER[a]} AS DOUBLE)"

    cols = [f"CASE WHEN {a}_binary = 0 THEN {mod(a)} ELSE CAST(-1 AS DOUBLE) END AS {a}" for a in RULES]
    for a in list(SHARES)[:-1]:
        taken = f"{a}_binary = 1" + (" OR recurring_action_binary = 1" if a == "next_positive" else "")
        cols.append(
            f"CASE WHEN {taken} THEN CAST(-1 AS DOUBLE) WHEN {a}_prediction = 0 THEN {mod(a)} * CAST(0.1 AS DOUBLE) "
            f"ELSE {a}_prediction * {mod(a)} END AS {a}"
        )
    a = "transport_action"
    cols.append(
        f"CASE WHEN {a}_binary = 1 THEN CAST(-1 AS DOUBLE) "
        f"WHEN auto_transport_prediction = 1 THEN auto_transport_prediction * {mod('auto_transport')} - CAST(0.0001 AS DOUBLE) "
        f"WHEN {a}_prediction = 0 THEN {mod(a)} * CAST(0.1 AS DOUBLE) ELSE {mod(a)} END AS {a}"
    )
    return "action_scores AS (SELECT id, " + ",\n  ".join(cols) + " FROM scores)"


ACTION_SCORES = _action_scores()
LONG = "long AS (" + " UNION ALL ".join(f"SELECT id, '{a}' AS key, {a} AS score FROM action_scores" for a in ACTIONS) + ")"
RANKS = """ranks AS (SELECT id, key, score, raw_rank, CASE WHEN score = -1 THEN 100 ELSE raw_rank END AS rank FROM
  (SELECT *, rank() OVER (PARTITION BY id ORDER BY score DESC NULLS LAST) AS raw_rank FROM long))"""
WIDE_RANKS = "SELECT id, " + ", ".join(f"CAST(sum(rank) FILTER (key = '{a}') AS BIGINT) AS {a}" for a in ACTIONS) + " FROM ranks GROUP BY id"

USERS = """users AS (SELECT c_custkey AS id, verified_at, CASE WHEN c_acctbal < 0 THEN last_at END AS closed_at
  FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS verified_at, max(o_orderdate) AS last_at FROM orders GROUP BY 1)
  ON c_custkey = o_custkey)"""
USER_DATES = "SELECT id, CAST(verified_at AS DATE) AS verified_at, CAST(closed_at AS DATE) AS closed_at FROM users"

R = "recurring_action"
FLAG = f"{R}_binary"
POPULATION = f"population AS (SELECT id, {_cols(MODEL_FEATURES)}, {FLAG} FROM profile WHERE {_complete('share_urgent')})"
NEGATIVE_SAMPLE = f"""negative_sample AS (SELECT * FROM population WHERE {FLAG} = 0 AND
  CAST({_hash('id', 123)} AS DOUBLE) / 4294967296.0 < (SELECT least(CAST(count(*) FILTER ({FLAG} = 1) AS DOUBLE)
  / count(*) FILTER ({FLAG} = 0), 1.0) FROM population))"""
ORDER = f"ORDER BY p ASC NULLS FIRST, {_hash('id')}, id"


def _evaluation() -> str:
    return "evaluation AS (" + " UNION ALL ".join(
        f"SELECT id, '{a}' AS action, {a}_binary AS target, {s} AS score, "
        f"CASE WHEN {s} >= CAST(0.2 AS DOUBLE) THEN 1.0 ELSE 0.0 END AS prediction FROM profile WHERE n_orders > 0"
        for a, s in list(SHARES.items())[:-1]
    ) + ")"


EVALUATION = _evaluation()
CURVES = """points AS (SELECT action, score, count(*) FILTER (target = 1) AS pos, count(*) FILTER (target = 0) AS neg
  FROM evaluation GROUP BY ALL),
curves AS (SELECT action, score AS threshold, pos, neg,
  CAST(sum(pos) OVER w AS DOUBLE) AS tp, CAST(sum(neg) OVER w AS DOUBLE) AS fp,
  CAST(sum(pos) OVER g AS DOUBLE) AS p_all, CAST(sum(neg) OVER g AS DOUBLE) AS n_all FROM points
  WINDOW w AS (PARTITION BY action ORDER BY score DESC), g AS (PARTITION BY action))"""
CONFUSION = """confusion AS (SELECT action,
  count(*) FILTER (target = 1 AND prediction = 1) AS tp, count(*) FILTER (target = 0 AND prediction = 1) AS fp,
  count(*) FILTER (target = 0 AND prediction = 0) AS tn, count(*) FILTER (target = 1 AND prediction = 0) AS fn
  FROM evaluation GROUP BY action)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _tiles(action: str) -> str:
    return (
        f"SELECT id, CAST(ntile(10) OVER ({ORDER}) AS INTEGER) AS tile FROM "
        f"(SELECT id, {action}_probability AS p FROM scores WHERE {action}_scored)"
    )


def _summary(table: str, columns: list[str]) -> str:
    def quartile(c: str, k: int) -> str:
        return f"(SELECT v FROM (SELECT CAST({c} AS DOUBLE) AS v, row_number() OVER (ORDER BY {c}) AS r, count(*) OVER () AS n FROM {table} WHERE {c} IS NOT NULL) WHERE r = ({k} * n + 3) // 4)"

    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS n, round(avg(CAST({c} AS DOUBLE)), 9) AS mean, round(stddev(CAST({c} AS DOUBLE)), 9) AS stddev, "
        f"CAST(min({c}) AS DOUBLE) AS min, {quartile(c, 1)} AS p25, {quartile(c, 2)} AS p50, {quartile(c, 3)} AS p75, CAST(max({c}) AS DOUBLE) AS max FROM {table}"
        for c in columns
    )


def _drift() -> list[str]:
    """CTEs of four populations: bins along the full one's twentieths, stability index and largest gap of each against the full one."""
    parts = {
        "full_population": "population", "positive_class": f"population WHERE {FLAG} = 1",
        "negative_class": "negative_sample", "negative_class_all": f"population WHERE {FLAG} = 0",
    }
    numbers = MODEL_FEATURES[1:]
    return [
        "pops AS (" + " UNION ALL ".join(f"SELECT '{p}' AS population, * FROM {t}" for p, t in parts.items()) + ")",
        "vals AS (" + " UNION ALL ".join(f"SELECT population, '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM pops" for c in numbers) + ")",
        """edges AS (SELECT DISTINCT "column", value AS edge FROM (SELECT "column", value, row_number() OVER (PARTITION BY "column" ORDER BY value) AS r,
  count(*) OVER (PARTITION BY "column") AS n FROM vals WHERE population = 'full_population' AND value IS NOT NULL), range(1, 20) t(k)
  WHERE r = (k * n + 19) // 20)""",
        """binned AS (SELECT population, "column", bin, count(*) AS n FROM (SELECT population, v."column", CAST(CASE WHEN value IS NULL THEN -1 ELSE
  (SELECT count(*) FROM edges e WHERE e."column" = v."column" AND e.edge < v.value) END AS VARCHAR) AS bin FROM vals v
  UNION ALL SELECT population, 'segment', coalesce(segment, '-1') FROM pops) GROUP BY ALL)""",
        """cells AS (SELECT p.population, b."column", b.bin, coalesce(n, 0) + CAST(0.5 AS DOUBLE) AS n FROM (SELECT DISTINCT population FROM pops) p,
  (SELECT DISTINCT "column", bin FROM binned) b LEFT JOIN binned c ON c.population = p.population AND c."column" = b."column" AND c.bin = b.bin)""",
        'smooth AS (SELECT population, "column", bin, n / sum(n) OVER (PARTITION BY population, "column") AS share FROM cells)',
        """psi AS (SELECT a.population, a."column", sum((a.share - r.share) * ln(a.share / r.share)) AS psi FROM smooth a
  JOIN smooth r ON r.population = 'full_population' AND r."column" = a."column" AND r.bin = a.bin WHERE a.population <> 'full_population' GROUP BY ALL)""",
        """below AS (SELECT p.population, v."column", v.value, CAST(sum(coalesce(n, 0)) OVER (PARTITION BY p.population, v."column" ORDER BY v.value) AS DOUBLE)
  / sum(coalesce(n, 0)) OVER (PARTITION BY p.population, v."column") AS f FROM (SELECT DISTINCT population FROM pops) p,
  (SELECT DISTINCT "column", value FROM vals WHERE value IS NOT NULL) v LEFT JOIN (SELECT population, "column", value, count(*) AS n FROM vals
  WHERE value IS NOT NULL GROUP BY ALL) c ON c.population = p.population AND c."column" = v."column" AND c.value = v.value)""",
        """ks AS (SELECT a.population, a."column", max(abs(a.f - r.f)) AS ks FROM below a JOIN below r ON r.population = 'full_population'
  AND r."column" = a."column" AND r.value = a.value WHERE a.population <> 'full_population' GROUP BY ALL)""",
    ]


# Games of two fixed trees: a0 .. asn the first one's value when nothing, the share, the number of orders or both are known; b0 .. bgs the second's.
FROZEN = """frozen AS (SELECT id, share_urgent AS s, n_orders AS n, coalesce(segment IN ('AUTOMOBILE', 'HOUSEHOLD'), false) AS g FROM population),
shares AS (SELECT CAST(count(*) FILTER (s <= 0.2) AS DOUBLE) / count(*) AS cs,
  CAST(count(*) FILTER (s > 0.2 AND n <= 8) AS DOUBLE) / nullif(count(*) FILTER (s > 0.2), 0) AS cn,
  CAST(count(*) FILTER (g) AS DOUBLE) / count(*) AS cg,
  CAST(count(*) FILTER (NOT g AND s <= 0.4) AS DOUBLE) / nullif(count(*) FILTER (NOT g), 0) AS ch FROM frozen),
games AS (SELECT id,
  cs * -0.5 + (1 - cs) * (cn * 0.25 + (1 - cn) * 0.75) AS a0,
  CASE WHEN s <= 0.2 THEN -0.5 ELSE cn * 0.25 + (1 - cn) * 0.75 END AS as_,
  cs * -0.5 + (1 - cs) * CASE WHEN n <= 8 THEN 0.25 ELSE 0.75 END AS an,
  CASE WHEN s <= 0.2 THEN -0.5 WHEN n <= 8 THEN 0.25 ELSE 0.75 END AS asn,
  cg * 0.125 + (1 - cg) * (ch * -0.25 + (1 - ch) * 0.375) AS b0,
  CASE WHEN g THEN 0.125 ELSE ch * -0.25 + (1 - ch) * 0.375 END AS bg,
  cg * 0.125 + (1 - cg) * CASE WHEN s <= 0.4 THEN -0.25 ELSE 0.375 END AS bs,
  CASE WHEN g THEN 0.125 WHEN s <= 0.4 THEN -0.25 ELSE 0.375 END AS bgs
  FROM frozen, shares)"""


def oracles() -> dict[str, str]:
    profile, scores = _with(PROFILE), _with(PROFILE, SCORES)
    population = _with(PROFILE, POPULATION)
    sampled = _with(PROFILE, POPULATION, NEGATIVE_SAMPLE)
    evaluation = _with(PROFILE, EVALUATION)
    curves = _with(PROFILE, EVALUATION, CURVES)
    ranks = _with(PROFILE, SCORES, ACTION_SCORES, LONG, RANKS)
    feature_columns = _cols(FEATURES)
    flags = _cols([f"{a}_binary" for a in ACTIONS])
    out: dict[str, str] = {}

    out["scan_users"] = _with(USERS) + USER_DATES
    out["eligible_users"] = (
        _with(USERS) + USER_DATES + f" WHERE CAST(verified_at AS DATE) >= DATE '2001-07-01' - 2000 AND (closed_at IS NULL OR closed_at > {AS_OF})"
    )
    out["survivability_table"] = profile + " UNION ALL ".join(
        f"SELECT '{a}' AS action, CAST({MODIFIER[a]} AS DOUBLE) AS modifier, CAST(sum({a}_binary) AS BIGINT) AS n_taken FROM profile"
        for a in ACTIONS
    )
    out["latest_model"] = """SELECT model_name, version, s3_uri, snapshot_date FROM (
  SELECT o_orderpriority AS model_name, o_orderstatus AS version, 'models/' || CAST(o_orderkey AS VARCHAR) AS s3_uri,
  CAST(o_orderdate AS DATE) AS snapshot_date, row_number() OVER (PARTITION BY o_orderpriority
  ORDER BY CAST(o_orderdate AS DATE) DESC, 'models/' || CAST(o_orderkey AS VARCHAR) DESC) AS row FROM orders) WHERE row = 1"""

    out["model_history"] = """SELECT model_name, s3_uri, trained_at, value, best_before, value - best_before AS gain, best_before IS NULL OR value > best_before AS took_over,
  row_number() OVER (PARTITION BY model_name ORDER BY value DESC, trained_at, version, s3_uri) = 1 AS is_champion FROM
  (SELECT *, max(value) OVER (PARTITION BY model_name ORDER BY trained_at, version, s3_uri ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before FROM
  (SELECT o_orderpriority AS model_name, o_orderstatus AS version, 'models/' || CAST(o_orderkey AS VARCHAR) AS s3_uri,
  CAST(o_orderdate AS DATE) AS trained_at, o_totalprice / CAST(1000000 AS DOUBLE) AS value FROM orders))"""
    day = "SELECT o_custkey AS id, count(*) AS n_orders, DATE '{0}' AS snapshot_date FROM orders WHERE o_orderdate < TIMESTAMP '{0}' GROUP BY 1"
    out["snapshot_history"] = " UNION ALL ".join(day.format(d) for d in ("2001-01-01", "2001-04-01", "2001-07-01"))
    out["snapshot_as_of"] = day.format("2001-04-01")

    moved = lambda sql: sql.replace("2001-01-01", "2000-07-01").replace("2001-07-01", "2001-01-01")
    at = _with(PROFILE, USERS) + (
        f"SELECT DATE '2001-01-01' AS cutoff, profile.id, {feature_columns}, {flags} FROM profile JOIN users USING (id) "
        "WHERE CAST(verified_at AS DATE) >= DATE '2001-07-01' - 2000 AND (closed_at IS NULL OR closed_at > TIMESTAMP '2001-07-01')"
    )
    out["profiles_from_state"] = f"SELECT * FROM ({moved(at)}) UNION ALL SELECT * FROM ({at})"
    indexes = [
        f"(SELECT {c}, least(row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) - 1, 4) AS i FROM customer GROUP BY 1) {a}"
        for c, a in (("c_mktsegment", "a"), ("c_nationkey", "b"))
    ]
    out["indexed_features"] = (
        "SELECT c_custkey AS id, CAST(a.i AS DOUBLE) AS c_mktsegment_index, CAST(b.i AS DOUBLE) AS nation_index FROM customer "
        f"JOIN {indexes[0]} USING (c_mktsegment) JOIN {indexes[1]} USING (c_nationkey)"
    )

    out["user_features"] = profile + f"SELECT id, {feature_columns} FROM profile"
    out["user_flags"] = profile + f"SELECT id, {flags} FROM profile"
    out["feature_set_projection"] = profile + f"SELECT id, {_cols(MODEL_FEATURES)}, {FLAG} FROM profile"
    codes = {"acctbal": "vx0001", "n_orders": "vx0002", "amt_avg": "vx0003", "recency_days": "vx0004", "tenure_days": "vx0005"}
    out["vendor_rename"] = profile + "SELECT id, " + ", ".join(f"{c} AS {codes.get(c, c)}" for c in FEATURES) + " FROM profile"
    out["null_sentinel"] = profile + "SELECT id, nullif(segment, 'null') AS segment, acctbal FROM profile"
    out["complete_cases"] = population + f"SELECT id, {_cols(MODEL_FEATURES)}, {FLAG} FROM population"
    out["null_audit"] = profile + "SELECT " + ", ".join(
        "count(*) FILTER (" + ("nullif(segment, 'null')" if c == "segment" else c) + f" IS NULL) AS {c}" for c in ["id", *FEATURES]
    ) + " FROM profile"
    out["class_balance"] = population + f"SELECT {FLAG}, count(*) AS n FROM population GROUP BY 1"
    out["positive_class"] = population + f"SELECT * FROM population WHERE {FLAG} = 1"
    out["negative_class"] = population + f"SELECT * FROM population WHERE {FLAG} = 0"
    out["class_ratio"] = population + (
        f"SELECT count(*) FILTER ({FLAG} = 1) AS positives, count(*) FILTER ({FLAG} = 0) AS negatives, "
        f"CAST(count(*) FILTER ({FLAG} = 1) AS DOUBLE) / count(*) FILTER ({FLAG} = 0) AS ratio FROM population"
    )
    out["downsample_negative"] = sampled + f"SELECT id, {FLAG} FROM negative_sample"
    out["value_distribution"] = profile + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS n, "
        f"CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM profile) AS share FROM profile GROUP BY {c}"
        for c in ["segment", "n_orders", FLAG]
    )
    drift = []
    for c in MODEL_FEATURES:
        a, b = (
            f"(SELECT CAST({c} AS VARCHAR) AS value, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM {t}) AS share FROM {t} GROUP BY 1)"
            for t in ("negative_all", "negative_sample")
        )
        drift.append(
            f"SELECT '{c}' AS \"column\", round(sum(abs(coalesce(a.share, 0) - coalesce(b.share, 0))) / 2, 9) AS distance "
            f"FROM {a} a FULL JOIN {b} b ON a.value IS NOT DISTINCT FROM b.value"
        )
    negative_all = f"negative_all AS (SELECT * FROM population WHERE {FLAG} = 0)"
    out["distribution_drift"] = _with(PROFILE, POPULATION, NEGATIVE_SAMPLE, negative_all) + " UNION ALL ".join(drift)
    out["window_targets"] = (
        "SELECT c_custkey AS id, "
        + ", ".join(
            f"CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = "
            f"'{PRIORITY[s.removeprefix('share_')]}' AND o_orderdate >= {CUTOFF} AND o_orderdate < {AS_OF}) THEN 1 ELSE 0 END AS {a}_binary"
            for a, s in list(SHARES.items())[:-1]
        )
        + " FROM customer"
    )
    out["cast_numeric"] = profile + (
        "SELECT id, CASE WHEN segment = 'null' THEN NULL ELSE acctbal END AS vx0001, CAST(n_orders AS DOUBLE) AS vx0002 FROM profile"
    )
    doubles = ", ".join(c if c == "segment" else f"CAST({c} AS DOUBLE) AS {c}" for c in MODEL_FEATURES)
    out["training_union"] = sampled + (
        f"SELECT id, {doubles}, {FLAG} AS target FROM population WHERE {FLAG} = 1 "
        f"UNION ALL SELECT id, {doubles}, {FLAG} AS target FROM negative_sample"
    )
    out["train_split"] = population + (
        f"SELECT id, {FLAG} AS target, CASE WHEN CAST({_hash('id', 1234)} AS DOUBLE) / 4294967296.0 < CAST(0.8 AS DOUBLE) "
        "THEN 'train' ELSE 'test' END AS split FROM population"
    )

    confusion = _with(PROFILE, EVALUATION, CONFUSION)
    out["confusion_matrix"] = confusion + "SELECT * FROM confusion"
    out["model_performance"] = confusion + (
        "SELECT *, CAST(tp AS DOUBLE) / nullif(tp + fn, 0) AS recall, CAST(tp AS DOUBLE) / nullif(tp + fp, 0) AS precision, "
        "CAST(tp + tn AS DOUBLE) / nullif(tp + tn + fp + fn, 0) AS accuracy, "
        "CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0) AS f1 FROM confusion"
    )
    out["auc_roc"] = curves + (
        "SELECT action, sum(pos * (n_all - fp + neg / CAST(2 AS DOUBLE))) / nullif(max(p_all) * max(n_all), 0) AS auc FROM curves GROUP BY 1"
    )
    out["roc_curve"] = curves + (
        "SELECT action, threshold, fp / n_all AS fpr, tp / p_all AS tpr FROM curves UNION ALL "
        "SELECT action, CAST(NULL AS DOUBLE), CAST(e AS DOUBLE), CAST(e AS DOUBLE) FROM (SELECT DISTINCT action FROM evaluation), "
        "(VALUES (0), (1)) v(e)"
    )
    out["f1_by_threshold"] = curves + "SELECT action, threshold, 2 * tp / (tp + fp + p_all) AS f1 FROM curves"
    out["recall_by_threshold"] = curves + "SELECT action, threshold, tp / p_all AS recall FROM curves"
    out["precision_by_threshold"] = curves + "SELECT action, threshold, tp / (tp + fp) AS precision FROM curves"

    order = f"OVER (ORDER BY {_hash('id', 8)}, id)"
    moved = ", ".join(
        f"coalesce(lead({c}) {order}, first({c}) {order}) AS {c}" for c in ("acctbal", "n_orders", "recency_days", "tenure_days")
    )
    out["permuted_features"] = profile + f"SELECT id, {moved} FROM profile WHERE n_orders > 0"

    scorable = f"{FLAG} = 0 AND {_complete('share_urgent')}"
    out["scorable_users"] = profile + f"SELECT id, {_cols(MODEL_FEATURES)} FROM profile WHERE {scorable}"
    out["unscored_users"] = profile + f"SELECT id FROM profile WHERE NOT ({scorable})"
    out["scores_with_defaults"] = scores + (
        f"SELECT id, {R}_probability, {R}_prediction, coalesce(tile, 0) AS {R}_score_decile FROM scores LEFT JOIN ({_tiles(R)}) USING (id)"
    )
    out["score_deciles"] = scores + (
        f"SELECT id, {R}_probability, {R}_prediction, tile AS {R}_score_decile FROM scores JOIN ({_tiles(R)}) USING (id)"
    )
    out["score_deciles_by_cuts"] = out["score_deciles"]
    out["transport_scores"] = profile + (
        "SELECT id, transport_action_binary, CASE WHEN return_share IS NULL THEN NULL WHEN return_share >= CAST(1 AS DOUBLE) / 3 THEN "
        "CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS transport_action_prediction, return_share AS transport_action_probability FROM profile"
    )
    flipped = ", ".join(f"CASE WHEN {a}_binary = 0 THEN 1 ELSE 0 END AS {a}_binary" for a in RULES)
    out["binary_decisioning"] = profile + f"SELECT id, {flipped} FROM profile"
    tiles = [f"{a}_tiles AS ({_tiles(a)})" for a in SHARES]
    triples = ", ".join(f"{a}_probability, {a}_prediction, coalesce({a}_tiles.tile, 0) AS {a}_score_decile" for a in SHARES)
    joins = " ".join(f"LEFT JOIN {a}_tiles ON {a}_tiles.id = scores.id" for a in SHARES)
    out["user_level_scores"] = _with(PROFILE, SCORES, *tiles) + f"SELECT scores.id, {flipped}, {triples} FROM scores {joins}"
    out["user_level_scores_by_cuts"] = out["user_level_scores"]
    out["gathered_scores"] = _with(PROFILE, SCORES, *tiles) + "SELECT scores.id, " + ", ".join(
        f"{a}_probability, {a}_prediction, coalesce({a}_tiles.tile, 0) AS {a}_score_decile" for a in SHARES
    ) + f" FROM scores {joins}"
    out["score_summary"] = scores + _summary("scores", [f"{a}_{x}" for a in SHARES for x in ("probability", "prediction")])
    out["rank_summary"] = ranks + f"SELECT * FROM (WITH wide AS ({WIDE_RANKS}) {_summary('wide', ACTIONS)})"

    out["feature_quantiles"] = profile + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(n AS BIGINT) AS n, CAST(k AS INTEGER) AS k, CAST(v AS DOUBLE) AS value FROM "
        f"(SELECT {c} AS v, row_number() OVER (ORDER BY {c}) AS r, count(*) OVER () AS n FROM profile WHERE {c} IS NOT NULL), range(1, 10) t(k) "
        "WHERE r = (k * n + 9) // 10"
        for c in MODEL_FEATURES[1:]
    )
    drifted = _with(PROFILE, POPULATION, NEGATIVE_SAMPLE, *_drift())
    out["binned_distribution"] = drifted + "SELECT population, \"column\", bin, n, CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY population, \"column\") AS share FROM binned"
    out["feature_drift"] = drifted + (
        "SELECT population, \"column\", round(psi, 9) AS psi, round(ks, 9) AS ks FROM psi LEFT JOIN ks USING (population, \"column\")"
    )

    out["cv_grid_points"] = (
        "SELECT i AS max_iter, d AS max_depth, s AS step_size, true AS has_auc, true AS best_is_highest, CAST(1 AS BIGINT) AS n_best FROM "
        "(VALUES (5), (10)) a(i), (VALUES (2), (5)) b(d), (VALUES (CAST(0.01 AS DOUBLE)), (CAST(0.1 AS DOUBLE))) c(s)"
    )
    out["stored_model_scores"] = profile + f"SELECT id, 'V2p0' AS version, true AS same, true AS in_range FROM profile WHERE {scorable}"
    out["feature_attributions"] = profile + f"SELECT id, true AS adds_up FROM profile WHERE {scorable}"
    frozen = _with(PROFILE, POPULATION, FROZEN)
    places = {
        0: "true", 1: "s <= 0.2", 2: "s > 0.2", 3: "s > 0.2 AND n <= 8", 4: "s > 0.2 AND n > 8",
        5: "true", 6: "g", 7: "NOT g", 8: "NOT g AND s <= 0.4", 9: "NOT g AND s > 0.4",
    }
    out["frozen_tree_cover"] = frozen + " UNION ALL ".join(
        f"SELECT CAST({p} AS INTEGER) AS place, count(*) FILTER ({c}) AS cover FROM frozen" for p, c in places.items()
    )
    out["frozen_attributions"] = frozen + """SELECT id, round(a0 + b0, 9) + 0.0 AS base, round((bg - b0 + bgs - bs) / 2, 9) + 0.0 AS phi_segment,
  round((as_ - a0 + asn - an) / 2 + (bs - b0 + bgs - bg) / 2, 9) + 0.0 AS phi_share_urgent, round((an - a0 + asn - as_) / 2, 9) + 0.0 AS phi_n_orders,
  round(CAST(asn + bgs AS DOUBLE), 9) + 0.0 AS margin FROM games"""

    out["scores_with_flags"] = scores + f"SELECT id, {_cols([f'{a}_prediction' for a in SHARES])}, {flags} FROM scores"
    out["action_scores"] = _with(PROFILE, SCORES, ACTION_SCORES) + "SELECT * FROM action_scores"
    out["unpivot_scores"] = _with(PROFILE, SCORES, ACTION_SCORES, LONG) + "SELECT id, key, score FROM long"
    out["raw_ranks"] = ranks + "SELECT id, key, raw_rank FROM ranks"
    out["action_ranks"] = ranks + "SELECT id, key, raw_rank, rank FROM ranks"
    out["pivoted_ranks"] = ranks + WIDE_RANKS
    out["user_level_ranks"] = ranks + WIDE_RANKS
    return out
