"""The same queries in plain SQL, for a side-by-side check on DuckDB."""

from __future__ import annotations

_TX = """
e AS (
  SELECT event_id, ts, user_id, value, event_type,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events),
tx AS (
  SELECT 'T' || lpad(CAST(event_id AS VARCHAR), 9, '0') AS tx_id,
         'A' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS account_id,
         'D' || lpad(CAST((user_id*7 + (k%3)*13) % 97 AS VARCHAR), 6, '0') AS device_id,
         'M' || lpad(CAST(k AS VARCHAR), 5, '0') AS merchant_id,
         value AS amount,
         CASE event_type WHEN 'purchase' THEN 'PAYMENT' WHEN 'signup' THEN 'TRANSFER'
              WHEN 'click' THEN 'CASH_OUT' WHEN 'view' THEN 'DEBIT' ELSE 'CASH_IN' END AS tx_type,
         CASE k%4 WHEN 0 THEN 'web' WHEN 1 THEN 'mobile' WHEN 2 THEN 'pos' ELSE 'atm' END AS channel,
         ts AS event_time, epoch_us(ts) AS us, event_id,
         CASE WHEN (user_id*7 + (k%3)*13) % 97 < 6 AND value > 20 THEN 1 ELSE 0 END AS is_fraud
  FROM e)"""

_SCORED = """,
scored AS (
  SELECT *, least(1.0, amount / 190.0) AS raw,
         round(least(1.0, amount / 190.0), 4) AS fraud_score,
         CASE WHEN least(1.0, amount / 190.0) >= 0.85 THEN 'decline'
              WHEN least(1.0, amount / 190.0) >= 0.45 THEN 'challenge' ELSE 'approve' END AS decision,
         least(1.0, amount / 190.0) >= 0.85 AS is_high_risk
  FROM tx)"""


def _graph(seconds: int = 3600) -> str:
    """g: windowed events; ed: edges; nd: nodes with order; arcs: both directions."""
    return _graph_on(f"(us // 1000000) // {seconds} * {seconds}")


def _graph_on(graph_id: str, source: str = "tx") -> str:
    return f""",
g AS (SELECT *, CAST({graph_id} AS BIGINT) AS graph_id FROM {source}),
ed AS (
  SELECT graph_id, account_id, 'device' AS ntype, device_id AS other_id, count(*) AS weight,
         sum(amount) AS amount FROM g GROUP BY ALL
  UNION ALL
  SELECT graph_id, account_id, 'merchant', merchant_id, count(*), sum(amount) FROM g GROUP BY ALL),
ap AS (
  SELECT graph_id, 'account' AS ntype, account_id AS id, us, tx_id, 0 AS slot FROM g
  UNION ALL SELECT graph_id, 'device', device_id, us, tx_id, 1 FROM g
  UNION ALL SELECT graph_id, 'merchant', merchant_id, us, tx_id, 2 FROM g),
fs AS (SELECT graph_id, ntype, id, min((us, tx_id, slot)) AS seen FROM ap GROUP BY ALL),
nd AS MATERIALIZED (
  SELECT graph_id, ntype, id,
         row_number() OVER (PARTITION BY graph_id ORDER BY seen) - 1 AS ord FROM fs),
half AS (
  SELECT ed.graph_id, a.ord AS a, b.ord AS b, weight FROM ed
  JOIN nd a ON a.graph_id = ed.graph_id AND a.ntype = 'account' AND a.id = ed.account_id
  JOIN nd b ON b.graph_id = ed.graph_id AND b.ntype = ed.ntype AND b.id = ed.other_id),
arcs AS MATERIALIZED (
  SELECT graph_id, a AS s, b AS d, weight FROM half
  UNION ALL SELECT graph_id, b, a, weight FROM half),
dg AS MATERIALIZED (
  SELECT graph_id, s AS ord, count(*) AS degree, sum(weight) AS strength FROM arcs GROUP BY ALL),
sz AS MATERIALIZED (SELECT graph_id, count(*) AS n FROM nd GROUP BY ALL)"""


_DEGREES = """,
ac AS (SELECT graph_id, account_id, count(*) AS degree, count(*) FILTER (ntype = 'device') AS devices,
              count(*) FILTER (ntype = 'merchant') AS merchants FROM ed GROUP BY ALL),
ot AS (SELECT graph_id, ntype, other_id, count(*) AS degree FROM ed GROUP BY ALL),
ve AS (SELECT graph_id, account_id, count(*) AS velocity FROM g GROUP BY ALL),
df AS (
  SELECT g.graph_id, g.tx_id, ac.degree AS account_degree, dv.degree AS device_degree,
         me.degree AS merchant_degree, ve.velocity AS velocity_ring_score,
         ac.devices AS unique_devices_per_account, ac.merchants AS unique_merchants_per_account,
         g.is_fraud, g.channel
  FROM g JOIN ac USING (graph_id, account_id) JOIN ve USING (graph_id, account_id)
  JOIN ot dv ON dv.graph_id = g.graph_id AND dv.ntype = 'device' AND dv.other_id = g.device_id
  JOIN ot me ON me.graph_id = g.graph_id AND me.ntype = 'merchant' AND me.other_id = g.merchant_id)"""

_DF_COLUMNS = """graph_id, tx_id, account_degree, device_degree, merchant_degree,
  velocity_ring_score, unique_devices_per_account, unique_merchants_per_account"""

_COMPONENTS = """,
reach AS (
  SELECT graph_id, ord AS root, ord AS v FROM nd
  UNION
  SELECT r.graph_id, r.root, a.d FROM reach r JOIN arcs a ON a.graph_id = r.graph_id AND a.s = r.v),
cs AS MATERIALIZED (SELECT graph_id, root AS ord, count(*) AS component_size FROM reach GROUP BY ALL)"""

_PAGERANK = """,
pr AS (
  SELECT nd.graph_id, nd.ord, 0 AS t, 1.0::DOUBLE / n AS rank, false AS done, n
  FROM nd JOIN sz USING (graph_id)
  UNION ALL
  SELECT graph_id, ord, t + 1, rank, {done}, n FROM (
    SELECT p.graph_id, a.d AS ord, p.t, p.n,
           0.15::DOUBLE / p.n + 0.85::DOUBLE * sum(p.rank * a.weight / dg.strength) AS rank
    FROM pr p JOIN dg ON dg.graph_id = p.graph_id AND dg.ord = p.ord
    JOIN arcs a ON a.graph_id = p.graph_id AND a.s = p.ord
    WHERE NOT p.done AND p.t < {limit}
    GROUP BY p.graph_id, a.d, p.t, p.n) x
  {old}),
pk AS MATERIALIZED (
  SELECT graph_id, ord, arg_max(rank, t) AS pagerank FROM pr GROUP BY ALL)"""

_PAGERANK_FIXED = _PAGERANK.format(done="false", limit=20, old="")
_PAGERANK_FULL = (
    _PAGERANK.replace("SELECT graph_id, ord, t + 1, rank, {done}, n FROM (", "SELECT graph_id, ord, t + 1, rank, sum(abs(rank - old)) OVER (PARTITION BY graph_id) < n * 1e-6, n FROM (SELECT x.*, o.rank AS old FROM (")
    .replace("{limit}", "100")
    .replace(") x\n  {old})", ") x JOIN pr o ON o.graph_id = x.graph_id AND o.ord = x.ord))")
)

_BETWEENNESS = """,
sp(graph_id, s, v, dist, paths) USING KEY (graph_id, s, v) AS (
  SELECT graph_id, ord, ord, 0, 1.0::DOUBLE FROM nd
  UNION
  SELECT p.graph_id, p.s, a.d, p.dist + 1, sum(p.paths)
  FROM sp p JOIN arcs a ON a.graph_id = p.graph_id AND a.s = p.v
  LEFT JOIN recurring.sp r ON r.graph_id = p.graph_id AND r.s = p.s AND r.v = a.d
  WHERE r.v IS NULL GROUP BY ALL),
pairs AS MATERIALIZED (SELECT * FROM sp),
through AS (
  SELECT st.graph_id, sv.v AS ord, sum(sv.paths * vt.paths / st.paths) AS total
  FROM pairs st JOIN pairs sv ON sv.graph_id = st.graph_id AND sv.s = st.s
  JOIN pairs vt ON vt.graph_id = st.graph_id AND vt.s = sv.v AND vt.v = st.v
  WHERE sv.v <> st.s AND sv.v <> st.v AND sv.dist + vt.dist = st.dist
  GROUP BY ALL),
bw AS MATERIALIZED (
  SELECT nd.graph_id, nd.ord, coalesce(total, 0.0)
           / CASE WHEN n > 2 THEN (n - 1.0) * (n - 2.0) ELSE 1.0 END AS betweenness
  FROM nd JOIN sz USING (graph_id) LEFT JOIN through USING (graph_id, ord))"""

# Greedy colours by rounds, then label propagation colour by colour to the fixed point.
_LABELS = """,
pri AS MATERIALIZED (
  SELECT a.graph_id, a.s AS hi, a.d AS lo FROM arcs a
  JOIN dg x ON x.graph_id = a.graph_id AND x.ord = a.s
  JOIN dg y ON y.graph_id = a.graph_id AND y.ord = a.d
  WHERE x.degree > y.degree OR (x.degree = y.degree AND a.s < a.d)),
col(graph_id, ord, colour) USING KEY (graph_id, ord) AS (
  SELECT graph_id, ord, 0 FROM dg
  WHERE NOT EXISTS (SELECT 1 FROM pri WHERE pri.graph_id = dg.graph_id AND pri.lo = dg.ord)
  UNION
  SELECT q.graph_id, q.lo,
         list_min(list_filter(range(0, count(*) + 1), lambda c: NOT list_contains(list(r.colour), c)))
  FROM (SELECT DISTINCT p.graph_id, p.lo FROM col c JOIN pri p ON p.graph_id = c.graph_id AND p.hi = c.ord) n
  JOIN pri q ON q.graph_id = n.graph_id AND q.lo = n.lo
  LEFT JOIN recurring.col r ON r.graph_id = q.graph_id AND r.ord = q.hi
  GROUP BY q.graph_id, q.lo HAVING count(*) = count(r.colour)),
colours AS MATERIALIZED (SELECT * FROM col),
nc AS MATERIALIZED (SELECT max(colour) + 1 AS n FROM colours),
lab AS (
  SELECT graph_id, ord, ord AS label, colour, 0 AS step, 0 AS still FROM colours
  UNION ALL
  SELECT graph_id, ord, fresh, colour, step + 1,
         CASE WHEN max(CAST(fresh <> label AS INT)) OVER () = 1 THEN 0 ELSE still + 1 END
  FROM (
    SELECT l.graph_id, l.ord, l.label, l.colour, l.step, l.still,
           CASE WHEN v.ord IS NULL OR list_contains(v.best, l.label) THEN l.label
                ELSE list_max(v.best) END AS fresh
    FROM lab l LEFT JOIN (
      SELECT graph_id, ord, list(label) AS best FROM (
        SELECT x.graph_id, x.ord, nb.label, count(*) AS n,
               max(count(*)) OVER (PARTITION BY x.graph_id, x.ord) AS top
        FROM lab x JOIN arcs a ON a.graph_id = x.graph_id AND a.d = x.ord
        JOIN lab nb ON nb.graph_id = x.graph_id AND nb.ord = a.s
        WHERE x.colour = x.step % (SELECT n FROM nc)
        GROUP BY x.graph_id, x.ord, nb.label) WHERE n = top GROUP BY ALL) v
    ON v.graph_id = l.graph_id AND v.ord = l.ord
    WHERE l.still < (SELECT n FROM nc))),
labels AS MATERIALIZED (
  SELECT graph_id, ord, arg_max(label, step) AS label FROM lab GROUP BY ALL)"""


def _rings(min_accounts: int = 3) -> str:
    return f""",
mem AS MATERIALIZED (
  SELECT nd.graph_id, label, ord, ntype, id FROM labels JOIN nd USING (graph_id, ord)),
ie AS (
  SELECT h.graph_id, x.label, count(*) AS n_edges FROM half h
  JOIN labels x ON x.graph_id = h.graph_id AND x.ord = h.a
  JOIN labels y ON y.graph_id = h.graph_id AND y.ord = h.b AND y.label = x.label GROUP BY ALL),
cm AS (
  SELECT graph_id, label, count(*) FILTER (ntype = 'account') AS size,
         count(*) FILTER (ntype = 'device') AS n_devices,
         count(*) FILTER (ntype = 'merchant') AS n_merchants, count(*) AS n_nodes,
         min(ord) AS first_node FROM mem GROUP BY ALL),
rg AS MATERIALIZED (
  SELECT graph_id, label, size, n_devices, n_merchants, n_nodes, coalesce(n_edges, 0) AS n_edges,
         row_number() OVER (PARTITION BY graph_id ORDER BY first_node) - 1 AS ring_id,
         1.0 - least(1.0, n_devices / size::DOUBLE) AS shared_device_ratio,
         CASE WHEN n_nodes < 2 THEN 0.0
              ELSE 2.0 * coalesce(n_edges, 0) / (n_nodes * (n_nodes - 1.0)) END AS density
  FROM cm LEFT JOIN ie USING (graph_id, label) WHERE size >= {min_accounts}),
rings AS MATERIALIZED (
  SELECT *, least(1.0, 0.5 * density + 0.5 * shared_device_ratio) AS risk_score FROM rg),
rm AS MATERIALIZED (
  SELECT graph_id, ring_id, ntype, id FROM mem JOIN rings USING (graph_id, label))"""


_RING_COLUMNS = """graph_id, ring_id, size, n_devices, n_merchants, n_nodes, n_edges,
  round(shared_device_ratio, 9) AS shared_device_ratio, round(density, 9) AS density,
  round(risk_score, 9) AS risk_score"""

_BATCHES = """,
bt AS MATERIALIZED (
  SELECT *, (row_number() OVER (ORDER BY us, tx_id) - 1) // 250 AS batch_id FROM tx),
bw AS MATERIALIZED (
  SELECT batch_id, count(*) AS n_events, max(us) AS watermark, max(us) - 3600000000 AS window_start,
         max(us) AS window_end FROM bt GROUP BY ALL),
wm AS MATERIALIZED (
  SELECT bw.batch_id, tx.* FROM bw JOIN tx ON tx.us > bw.window_start AND tx.us <= bw.window_end)"""

_RATES = """count(*) AS transactions_scored,
  count(*) FILTER (is_fraud = 1) AS true_fraud,
  count(*) FILTER (decision <> 'approve') AS flagged,
  count(*) FILTER (decision <> 'approve' AND is_fraud = 1) AS fraud_caught,
  round(count(*) FILTER (decision <> 'approve' AND is_fraud = 1)
        / greatest(1, count(*) FILTER (is_fraud = 1))::DOUBLE, 9) AS detection_rate,
  round(count(*) FILTER (decision <> 'approve' AND is_fraud = 0)
        / greatest(1, count(*) FILTER (decision <> 'approve'))::DOUBLE, 9) AS false_positive_rate,
  round(count(*) FILTER (decision <> 'approve' AND is_fraud = 0)
        / greatest(1, count(*) FILTER (is_fraud = 0))::DOUBLE, 9) AS fpr_true"""

_FEATURE_NAMES = [
    "amount",
    "amount_log",
    "tx_type_code",
    "channel_code",
    "hour_of_day",
    "account_degree",
    "device_degree",
    "merchant_degree",
    "velocity_ring_score",
    "unique_devices_per_account",
    "unique_merchants_per_account",
]

_CODES = """CAST(CASE tx_type WHEN 'TRANSFER' THEN 1 WHEN 'CASH_OUT' THEN 2 WHEN 'DEBIT' THEN 3
       WHEN 'CASH_IN' THEN 4 ELSE 0 END AS BIGINT) AS tx_type_code,
  CAST(CASE channel WHEN 'mobile' THEN 1 WHEN 'pos' THEN 2 WHEN 'atm' THEN 3 ELSE 0 END AS BIGINT)
       AS channel_code,
  CAST(hour(event_time) AS BIGINT) AS hour_of_day"""

def _sql(body: str, *parts: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{_TX.strip()}{''.join(parts)}\n{body}"


def _degree_block(prefix: str, seconds: int, source: str) -> str:
    p = prefix
    return f""",
{p}g AS (SELECT *, (us // 1000000) // {seconds} * {seconds} AS graph_id FROM {source}),
{p}ed AS (SELECT DISTINCT graph_id, account_id, 'device' AS ntype, device_id AS other_id FROM {p}g
  UNION ALL SELECT DISTINCT graph_id, account_id, 'merchant', merchant_id FROM {p}g),
{p}ac AS (SELECT graph_id, account_id, count(*) AS degree,
  count(*) FILTER (ntype = 'device') AS devices, count(*) FILTER (ntype = 'merchant') AS merchants
  FROM {p}ed GROUP BY ALL),
{p}ot AS (SELECT graph_id, ntype, other_id, count(*) AS degree FROM {p}ed GROUP BY ALL),
{p}ve AS (SELECT graph_id, account_id, count(*) AS velocity FROM {p}g GROUP BY ALL),
{p}df AS (SELECT {p}g.tx_id, a.degree AS account_degree, d.degree AS device_degree,
  m.degree AS merchant_degree, v.velocity AS velocity_ring_score,
  a.devices AS unique_devices_per_account, a.merchants AS unique_merchants_per_account
  FROM {p}g JOIN {p}ac a USING (graph_id, account_id) JOIN {p}ve v USING (graph_id, account_id)
  JOIN {p}ot d ON d.graph_id = {p}g.graph_id AND d.ntype = 'device' AND d.other_id = {p}g.device_id
  JOIN {p}ot m ON m.graph_id = {p}g.graph_id AND m.ntype = 'merchant'
    AND m.other_id = {p}g.merchant_id)"""


_LATEST = (
    _degree_block("h_", 3600, "tx")
    + _degree_block("d_", 86400, "tx")
    + """,
versions AS (SELECT *, 0 AS batch_id FROM h_df UNION ALL SELECT *, 1 FROM d_df),
latest AS (SELECT * FROM versions
  QUALIFY row_number() OVER (PARTITION BY tx_id ORDER BY batch_id DESC) = 1)"""
)

_LATEST_COLUMNS = """tx_id, CAST(batch_id AS BIGINT) AS batch_id, account_degree, device_degree,
  merchant_degree, velocity_ring_score, unique_devices_per_account, unique_merchants_per_account"""


def _psi(groups: str) -> str:
    key = f"{groups}, " if groups else ""
    inner = ", ".join(str(i / 10) for i in range(1, 10))
    day = "strftime(event_time, '%Y-%m-%d') AS day, " if groups else ""
    return f""",
lg AS (SELECT event_time, {day}raw AS score FROM scored),
mid AS (SELECT (min(epoch_us(event_time)) + max(epoch_us(event_time))) // 2 AS m FROM lg),
ref AS (SELECT lg.* FROM lg, mid WHERE epoch_us(event_time) < m),
cur AS (SELECT lg.* FROM lg, mid WHERE epoch_us(event_time) >= m),
edg AS (SELECT quantile_cont(score, [{inner}]) AS q FROM ref),
bins AS (SELECT unnest(range(0, 10)) AS bin),
rc AS (SELECT len(list_filter(q, lambda x: x <= score)) AS bin, count(*) AS c FROM ref, edg GROUP BY ALL),
cc AS (SELECT {key}len(list_filter(q, lambda x: x <= score)) AS bin, count(*) AS c FROM cur, edg GROUP BY ALL),
grp AS (SELECT {key}sum(c) AS n FROM cc GROUP BY ALL),
cells AS (
  SELECT {"grp." + groups + ", " if groups else ""}bins.bin, greatest(coalesce(rc.c, 0) / (SELECT sum(c)::DOUBLE FROM rc), 1e-6) AS r,
         greatest(coalesce(cc.c, 0) / grp.n::DOUBLE, 1e-6) AS k
  FROM grp CROSS JOIN bins LEFT JOIN rc ON rc.bin = bins.bin
  LEFT JOIN cc ON cc.bin = bins.bin {"AND cc." + groups + " = grp." + groups if groups else ""}),
ps AS (SELECT {key}sum((k - r) * ln(k / r)) AS psi
  FROM cells GROUP BY ALL)"""


_PSI_SELECT = """round(psi, 9) AS psi, CASE WHEN psi < 0.1 THEN 'stable'
  WHEN psi < 0.2 THEN 'moderate-shift' ELSE 'significant-drift -> trigger retraining' END AS verdict"""

_LEVELS = """,
sc AS (SELECT floor(amount) AS score, is_fraud AS label, channel FROM tx),
lv AS (SELECT {key}score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg
  FROM sc GROUP BY ALL),
cu AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM lv
  WINDOW w AS ({part}ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""
_LEVELS_ALL = _LEVELS.format(key="", part="")
_LEVELS_CHANNEL = _LEVELS.format(key="channel, ", part="PARTITION BY channel ")

_AUC = """CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives,
  round(sum(neg * ((tp - pos) + pos * 0.5::DOUBLE)) / (sum(pos)::DOUBLE * sum(neg)), 9) AS roc_auc"""


def _histogram(value: str, bins: int, where: str = "true") -> str:
    return f""",
v AS (SELECT {value} AS v FROM tx WHERE {where}),
b AS (SELECT min(v) AS lo, max(v) AS hi FROM v),
hb AS (SELECT least({bins - 1}, CAST(floor((v - lo) / ((hi - lo) / {bins})) AS BIGINT)) AS bin,
  lo, (hi - lo) / {bins} AS w FROM v, b)"""


_HIST_SELECT = """SELECT bin, round(any_value(lo) + bin * any_value(w), 9) AS "left", count(*) AS n
FROM hb GROUP BY bin"""

_TEXT_COLUMNS = ["tx_id", "account_id", "device_id", "merchant_id", "tx_type", "channel"]
_TX_COLUMNS = [*_TEXT_COLUMNS[:4], "amount", *_TEXT_COLUMNS[4:], "event_time", "is_fraud"]


def _union(rows: list[str]) -> str:
    return "\nUNION ALL\n".join(rows)


def _numeric(column: str) -> str:
    return f"""SELECT '{column}' AS "column", count(*) AS count, round(avg(x), 9) AS mean,
  round(stddev_samp(x), 9) AS std, round(min(x), 9) AS min,
  round(quantile_cont(x, 0.25), 9) AS p25, round(quantile_cont(x, 0.5), 9) AS p50,
  round(quantile_cont(x, 0.75), 9) AS p75, round(max(x), 9) AS max,
  round(skewness(x), 9) AS skewness, round(kurtosis(x), 9) AS kurtosis
FROM (SELECT CAST({column} AS DOUBLE) AS x FROM tx)"""


def _categorical(column: str) -> str:
    return f"""SELECT '{column}' AS "column", CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique",
  arg_min(v, (-n, v)) AS top, max(n) AS freq
FROM (SELECT {column} AS v, count(*) AS n FROM tx GROUP BY ALL)"""


_RULES = {
    "null_tx_id": "tx_id IS NULL",
    "null_account_id": "account_id IS NULL",
    "null_device_id": "device_id IS NULL",
    "null_merchant_id": "merchant_id IS NULL",
    "negative_amount": "amount < 0",
    "null_amount": "amount IS NULL",
    "unknown_tx_type": "tx_type NOT IN ('PAYMENT','TRANSFER','CASH_OUT','DEBIT','CASH_IN')",
    "unknown_channel": "channel NOT IN ('web','mobile','pos','atm')",
}

_IMPORTANCE = (
    _graph()
    + _DEGREES
    + f""",
fx AS (SELECT tx.amount, ln(1 + tx.amount) AS amount_log, {_CODES.replace("tx_type", "tx.tx_type", 1).replace("CASE channel", "CASE tx.channel").replace("event_time", "tx.event_time")},
  df.account_degree, df.device_degree, df.merchant_degree, df.velocity_ring_score,
  df.unique_devices_per_account, df.unique_merchants_per_account, tx.is_fraud FROM tx JOIN df USING (tx_id)),
im AS ({_union([f"SELECT '{c}' AS feature, {i} AS position, {int(i > 4)} AS is_graph, abs(corr({c}::DOUBLE, is_fraud::DOUBLE)) AS importance FROM fx" for i, c in enumerate(_FEATURE_NAMES)])})"""
)

# --- fixed values -----------------------------------------------------------
# Wording of the narrative and of the actions.
_NARRATIVE = """
'Fraud Investigation Summary - Transaction ' || tx_id || chr(10) || repeat('=', 60) || chr(10) ||
'Account        : ' || account_id || chr(10) || 'Device         : ' || device_id || chr(10) ||
'Merchant       : ' || merchant_id || chr(10) || 'Amount         : $' || printf('%,.2f', amount) || chr(10) ||
'Fraud score    : ' || printf('%.2f%%', 100 * fraud_score) || chr(10) ||
'Recommendation : ' || action || chr(10) || chr(10) || 'Graph evidence:' || chr(10) ||
'  - Account velocity in window : ' || velocity || ' transactions' || chr(10) ||
'  - Devices linked to account  : ' || devices || chr(10) ||
'  - Shared-device degree       : ' || device_degree || ' accounts' || chr(10) ||
'  - Account graph component    : ' || component_size || ' nodes' || chr(10) || chr(10) ||
CASE WHEN ring_id IS NULL THEN 'No coordinated ring membership detected for this account in the current window; risk is driven by transaction-level and velocity signals.'
ELSE 'Coordinated fraud ring detected:' || chr(10) || '  - Ring id            : ' || ring_id || chr(10) ||
'  - Accounts in ring   : ' || size || chr(10) ||
'  - Shared-device ratio: ' || printf('%.0f%%', 100 * shared_device_ratio) || chr(10) ||
'  - Ring risk score    : ' || printf('%.2f%%', 100 * risk_score) || chr(10) ||
'  - Interpretation     : multiple accounts sharing a small device pool and targeting the same merchants is a classic mule-ring cash-out pattern.' END"""

_ACTION = """CASE decision WHEN 'decline' THEN 'DECLINE the transaction and freeze the account pending review'
  WHEN 'challenge' THEN 'CHALLENGE with step-up authentication (3-D Secure / OTP)'
  WHEN 'approve' THEN 'APPROVE — risk below action threshold' ELSE decision END"""
# --- end of fixed values ----------------------------------------------------

_DAILY = _graph(86400)
_DAILY_RINGS = (_DAILY, _LABELS, _rings())

ORACLE: dict[str, str] = {
    "tx_features": _sql(
        f"SELECT tx_id, round(amount, 6) AS amount, round(ln(1 + amount), 9) AS amount_log, {_CODES} FROM tx"
    ),
    "json_roundtrip": _sql(
        "SELECT tx_id, account_id, device_id, merchant_id, amount, tx_type, channel, us AS event_time FROM tx"
    ),
    "json_props": "SELECT count(*) AS n_rows, count(*) FILTER (json_extract_string(props, '$.tx_id') IS NULL) AS n_quarantined FROM events",
    "kafka_payload": _sql(
        """SELECT account_id AS key, '{"tx_id":"' || tx_id || '","account_id":"' || account_id ||
  '","fraud_score":' || CAST(fraud_score AS VARCHAR) || ',"decision":"' || decision || '"}' AS value
FROM scored WHERE is_high_risk""",
        _SCORED,
    ),
    "external_mapping": """SELECT CAST(o_orderkey AS VARCHAR) AS tx_id, CAST(o_custkey AS VARCHAR) AS account_id,
  CAST(NULL AS VARCHAR) AS device_id, CAST(NULL AS VARCHAR) AS merchant_id, o_totalprice AS amount,
  o_orderpriority AS tx_type, o_orderstatus AS channel, epoch_us(o_orderdate) AS event_time,
  CAST(NULL AS INTEGER) AS is_fraud FROM orders""",
    "time_functions": _sql(
        """SELECT tx_id, us // 1000000 // 3600 * 3600 AS hour_start,
  strftime(event_time, '%Y%m%dT%H%M%SZ') AS path_stamp, strftime(event_time, '%H:%M') AS clock,
  us // 1000000 * 1000000 AS whole_second FROM tx"""
    ),
    "one_hot": _sql(
        "SELECT tx_id, "
        + ", ".join(
            f"CAST({c} = '{v}' AS INTEGER) AS {p}_{v}"
            for c, p, vs in (
                ("tx_type", "type", ["PAYMENT", "TRANSFER", "CASH_OUT", "DEBIT", "CASH_IN"]),
                ("channel", "chan", ["web", "mobile", "pos", "atm"]),
            )
            for v in vs
        )
        + " FROM tx"
    ),
    "edges_hourly": _sql(
        """SELECT graph_id, 'acct:' || account_id AS src,
  CASE ntype WHEN 'device' THEN 'dev:' ELSE 'mer:' END || other_id AS dst, weight,
  round(amount, 2) AS amount FROM ed""",
        _graph(),
    ),
    "vertices_hourly": _sql(
        """SELECT graph_id, CASE ntype WHEN 'account' THEN 'acct:' WHEN 'device' THEN 'dev:' ELSE 'mer:' END
  || id AS node, ntype, ord FROM nd""",
        _graph(),
    ),
    "graph_stats_hourly": _sql(
        """SELECT graph_id, n_tx, n AS n_nodes, n_edges FROM sz
JOIN (SELECT graph_id, count(*) AS n_tx FROM g GROUP BY ALL) USING (graph_id)
JOIN (SELECT graph_id, count(*) AS n_edges FROM ed GROUP BY ALL) USING (graph_id)""",
        _graph(),
    ),
    "degree_hourly": _sql(
        "SELECT graph_id, ntype, id, degree FROM nd JOIN dg USING (graph_id, ord)", _graph()
    ),
    "fanout_hourly": _sql(
        """SELECT graph_id, account_id, count(DISTINCT device_id) AS unique_devices,
  count(DISTINCT merchant_id) AS unique_merchants FROM g GROUP BY ALL""",
        _graph(),
    ),
    "fanout_daily_sketched": _sql(
        """SELECT graph_id, ntype, id, side, count(DISTINCT other) AS neighbours, TRUE AS within_bound
FROM (
  SELECT graph_id, 'account' AS ntype, account_id AS id, 'device' AS side, device_id AS other FROM g
  UNION ALL SELECT graph_id, 'account', account_id, 'merchant', merchant_id FROM g
  UNION ALL SELECT graph_id, 'device', device_id, 'account', account_id FROM g
  UNION ALL SELECT graph_id, 'merchant', merchant_id, 'account', account_id FROM g)
GROUP BY ALL""",
        _DAILY,
    ),
    "velocity_hourly": _sql(
        "SELECT graph_id, account_id, count(*) AS velocity_ring_score FROM g GROUP BY ALL", _graph()
    ),
    "velocity_rolling": _sql(
        """SELECT tx_id, account_id, count(*) OVER (PARTITION BY account_id ORDER BY us
  RANGE BETWEEN 3600000000 PRECEDING AND CURRENT ROW) AS velocity_rolling FROM tx"""
    ),
    "degree_features_hourly": _sql(f"SELECT {_DF_COLUMNS} FROM df", _graph(), _DEGREES),
    "components_hourly": _sql(
        "SELECT graph_id, ntype, id, component_size FROM nd JOIN cs USING (graph_id, ord)",
        _graph(),
        _COMPONENTS,
        recursive=True,
    ),
    "pagerank_hourly": _sql(
        "SELECT graph_id, ntype, id, round(pagerank, 9) AS pagerank FROM nd JOIN pk USING (graph_id, ord)",
        _graph(),
        _PAGERANK_FULL,
        recursive=True,
    ),
    "pagerank_daily_fixed": _sql(
        "SELECT graph_id, ntype, id, round(pagerank, 9) AS pagerank FROM nd JOIN pk USING (graph_id, ord)",
        _DAILY,
        _PAGERANK_FIXED,
        recursive=True,
    ),
    "betweenness_hourly": _sql(
        "SELECT graph_id, ntype, id, round(betweenness, 9) AS betweenness FROM nd JOIN bw USING (graph_id, ord)",
        _graph(),
        _BETWEENNESS,
        recursive=True,
    ),
    "pagerank_daily": _sql(
        "SELECT graph_id, ntype, id, round(pagerank, 9) AS pagerank FROM nd JOIN pk USING (graph_id, ord)",
        _DAILY,
        _PAGERANK_FULL,
        recursive=True,
    ),
    "betweenness_daily": _sql(
        "SELECT graph_id, ntype, id, round(betweenness, 9) AS betweenness, false AS sampled FROM nd JOIN bw USING (graph_id, ord)",
        _DAILY,
        _BETWEENNESS,
        recursive=True,
    ),
    "triangles_entity": _sql(
        """, pe AS (SELECT DISTINCT graph_id, least(a, b) AS a, greatest(a, b) AS b FROM (
  SELECT graph_id, account_id AS a, device_id AS b FROM g
  UNION ALL SELECT graph_id, account_id, merchant_id FROM g
  UNION ALL SELECT graph_id, device_id, merchant_id FROM g)),
tri AS (SELECT x.graph_id, x.a, x.b, y.b AS c FROM pe x
  JOIN pe y ON y.graph_id = x.graph_id AND y.a = x.b
  JOIN pe z ON z.graph_id = x.graph_id AND z.a = x.a AND z.b = y.b),
tn AS (SELECT graph_id, node, count(*) AS triangles FROM (
  SELECT graph_id, a AS node FROM tri UNION ALL SELECT graph_id, b FROM tri
  UNION ALL SELECT graph_id, c FROM tri) GROUP BY ALL),
dn AS (SELECT graph_id, node, count(*) AS degree FROM (
  SELECT graph_id, a AS node FROM pe UNION ALL SELECT graph_id, b FROM pe) GROUP BY ALL)
SELECT graph_id, node, degree, coalesce(triangles, 0) AS triangles,
  round(CASE WHEN degree < 2 THEN 0.0 ELSE 2.0 * coalesce(triangles, 0) / (degree * (degree - 1.0)) END, 9)
  AS clustering FROM dn LEFT JOIN tn USING (graph_id, node)""",
        _graph(),
    ),
    "graph_features_hourly": _sql(
        """, nm AS (SELECT nd.graph_id, ntype, id, degree, pagerank, betweenness, component_size FROM nd
  JOIN dg USING (graph_id, ord) JOIN pk USING (graph_id, ord) JOIN bw USING (graph_id, ord)
  JOIN cs USING (graph_id, ord))
SELECT df.graph_id, df.tx_id, df.account_degree, round(a.pagerank, 9) AS account_pagerank,
  0.0::DOUBLE AS account_clustering_coef, round(a.betweenness, 9) AS account_betweenness,
  df.device_degree, round(d.betweenness, 9) AS device_betweenness_centrality,
  round(d.pagerank, 9) AS device_pagerank, df.device_degree AS device_shared_account_count,
  df.merchant_degree, 0.0::DOUBLE AS merchant_cluster_coefficient,
  round(m.betweenness, 9) AS merchant_betweenness, df.velocity_ring_score, a.component_size,
  df.unique_devices_per_account, df.unique_merchants_per_account
FROM df JOIN g ON g.tx_id = df.tx_id
JOIN nm a ON a.graph_id = g.graph_id AND a.ntype = 'account' AND a.id = g.account_id
JOIN nm d ON d.graph_id = g.graph_id AND d.ntype = 'device' AND d.id = g.device_id
JOIN nm m ON m.graph_id = g.graph_id AND m.ntype = 'merchant' AND m.id = g.merchant_id""",
        _graph(),
        _DEGREES,
        _COMPONENTS,
        _PAGERANK_FULL,
        _BETWEENNESS,
        recursive=True,
    ),
    "feature_matrix": _sql(
        f"""SELECT tx.tx_id, round(tx.amount, 6) AS amount, round(ln(1 + tx.amount), 9) AS amount_log,
  {_CODES.replace("CASE channel", "CASE tx.channel")},
  account_degree, device_degree, merchant_degree, velocity_ring_score, unique_devices_per_account,
  unique_merchants_per_account, CAST(tx.is_fraud AS BIGINT) AS is_fraud
FROM tx JOIN df ON df.tx_id = tx.tx_id""",
        _graph(),
        _DEGREES,
    ),
    "labels_daily": _sql(
        "SELECT graph_id, ntype, id, label FROM nd JOIN labels USING (graph_id, ord)",
        _DAILY,
        _LABELS,
        recursive=True,
    ),
    "labels_weekly": _sql(
        "SELECT graph_id, ntype, id, label FROM nd JOIN labels USING (graph_id, ord)",
        _graph_on("epoch(date_trunc('week', event_time))"),
        _LABELS,
        recursive=True,
    ),
    "rings_daily": _sql(f"SELECT {_RING_COLUMNS} FROM rings", *_DAILY_RINGS, recursive=True),
    "rings_weekly_top": _sql(
        """SELECT graph_id, ring_id, size, round(shared_device_ratio, 9) AS shared_device_ratio,
  round(density, 9) AS density, round(risk_score, 9) AS risk_score FROM rings
ORDER BY risk_score DESC, graph_id, ring_id LIMIT 25""",
        _graph_on("epoch(date_trunc('week', event_time))"),
        _LABELS,
        _rings(),
        recursive=True,
    ),
    "ring_members": _sql(
        "SELECT graph_id, ring_id, ntype, id FROM rm", *_DAILY_RINGS, recursive=True
    ),
    "rings_distinct": _sql(
        """, ks AS (SELECT graph_id, ring_id, list(id ORDER BY id) AS k, count(*) AS size FROM rm
  WHERE ntype = 'account' GROUP BY ALL)
SELECT graph_id, ring_id, size FROM ks
QUALIFY row_number() OVER (PARTITION BY k ORDER BY graph_id, ring_id) = 1""",
        *_DAILY_RINGS,
        recursive=True,
    ),
    "ring_documents": _sql(
        """, ks AS (SELECT graph_id, ring_id, list(id ORDER BY id) AS k, count(*) AS size FROM rm
  WHERE ntype = 'account' GROUP BY ALL),
ds AS (SELECT graph_id, ring_id, size FROM ks
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY graph_id, ring_id) = 1),
pm AS (SELECT graph_id, ring_id, ntype, id,
  (row_number() OVER (PARTITION BY graph_id, ring_id, ntype ORDER BY id) - 1) // 10 AS page
  FROM rm WHERE ntype <> 'device')
SELECT graph_id, ring_id, size, page,
  coalesce(string_agg(id, ',' ORDER BY id) FILTER (ntype = 'account'), '') AS accounts,
  coalesce(string_agg(id, ',' ORDER BY id) FILTER (ntype = 'merchant'), '') AS merchants
FROM ds JOIN pm USING (graph_id, ring_id) GROUP BY ALL""",
        *_DAILY_RINGS,
        recursive=True,
    ),
    "account_rings": _sql(
        """SELECT id AS account_id, graph_id, ring_id FROM rm WHERE ntype = 'account'
QUALIFY row_number() OVER (PARTITION BY id ORDER BY graph_id DESC, ring_id DESC) = 1""",
        *_DAILY_RINGS,
        recursive=True,
    ),
    "rings_busiest_hour": _sql(
        f"SELECT {_RING_COLUMNS} FROM rings ORDER BY rings.risk_score DESC, ring_id LIMIT 10",
        """,
hh AS (SELECT us // 1000000 // 3600 AS h, count(*) AS n FROM tx GROUP BY ALL),
bz AS (SELECT tx.* FROM tx WHERE us // 1000000 // 3600 = (SELECT h FROM hh ORDER BY n DESC, h LIMIT 1))""",
        _graph_on("(us // 1000000) // 3600 * 3600", "bz"),
        _LABELS,
        _rings(1),
        recursive=True,
    ),
    "ring_spike": _sql(
        """, rc AS (SELECT graph_id, count(*) AS n_rings FROM rings GROUP BY ALL)
SELECT a.graph_id, a.n_rings, a.n_rings - coalesce(b.n_rings, 0) AS increase,
  a.n_rings - coalesce(b.n_rings, 0) > 1 AS spike
FROM rc a LEFT JOIN rc b ON b.graph_id = a.graph_id - 86400""",
        *_DAILY_RINGS,
        recursive=True,
    ),
    "micro_batches": _sql("SELECT tx_id, batch_id FROM bt", _BATCHES),
    "batch_watermarks": _sql(
        """SELECT batch_id, watermark, max(watermark) OVER (ORDER BY batch_id
  ROWS UNBOUNDED PRECEDING) AS running_watermark FROM bw""",
        _BATCHES,
    ),
    "batch_progress": _sql(
        """SELECT batch_id, window_start, window_end,
  strftime(make_timestamp(window_start), '%H:%M') AS start_label,
  strftime(make_timestamp(window_end), '%H:%M') AS end_label, n_events, coalesce(n_rings, 0) AS n_rings
FROM bw LEFT JOIN (SELECT graph_id, count(*) AS n_rings FROM rings GROUP BY graph_id) r ON r.graph_id = bw.batch_id""",
        _BATCHES,
        _graph_on("batch_id", "wm"),
        _LABELS,
        _rings(),
        recursive=True,
    ),
    "window_members": _sql("SELECT batch_id, tx_id FROM wm", _BATCHES),
    "outside_window": _sql(
        """SELECT batch_id, count(*) FILTER (us <= window_start) AS n_outside
FROM bt JOIN bw USING (batch_id) GROUP BY ALL""",
        _BATCHES,
    ),
    "batch_degree_features": _sql(
        """, we AS (SELECT DISTINCT batch_id, account_id, 'device' AS ntype, device_id AS other_id FROM wm
  UNION ALL SELECT DISTINCT batch_id, account_id, 'merchant', merchant_id FROM wm),
wa AS (SELECT batch_id, account_id, count(*) AS degree, count(*) FILTER (ntype = 'device') AS devices,
  count(*) FILTER (ntype = 'merchant') AS merchants FROM we GROUP BY ALL),
wo AS (SELECT batch_id, ntype, other_id, count(*) AS degree FROM we GROUP BY ALL),
wv AS (SELECT batch_id, account_id, count(*) AS velocity FROM bt GROUP BY ALL)
SELECT bt.batch_id AS graph_id, tx_id, coalesce(wa.degree, 0) AS account_degree,
  coalesce(d.degree, 0) AS device_degree, coalesce(m.degree, 0) AS merchant_degree,
  velocity AS velocity_ring_score, coalesce(devices, 0) AS unique_devices_per_account,
  coalesce(merchants, 0) AS unique_merchants_per_account
FROM bt JOIN wv ON wv.batch_id = bt.batch_id AND wv.account_id = bt.account_id
LEFT JOIN wa ON wa.batch_id = bt.batch_id AND wa.account_id = bt.account_id
LEFT JOIN wo d ON d.batch_id = bt.batch_id AND d.ntype = 'device' AND d.other_id = bt.device_id
LEFT JOIN wo m ON m.batch_id = bt.batch_id AND m.ntype = 'merchant' AND m.other_id = bt.merchant_id""",
        _BATCHES,
    ),
    "batch_graph_features": _sql(
        """, nm AS (SELECT nd.graph_id, ntype, id, degree, pagerank, betweenness, component_size FROM nd
  JOIN dg USING (graph_id, ord) JOIN pk USING (graph_id, ord) JOIN bw USING (graph_id, ord)
  JOIN cs USING (graph_id, ord)),
fan AS (SELECT graph_id, account_id, count(*) FILTER (ntype = 'device') AS devices,
  count(*) FILTER (ntype = 'merchant') AS merchants FROM ed GROUP BY ALL),
wv AS (SELECT batch_id, account_id, count(*) AS velocity FROM bt GROUP BY ALL)
SELECT bt.batch_id AS graph_id, bt.tx_id, coalesce(a.degree, 0) AS account_degree,
  round(coalesce(a.pagerank, 0), 9) AS account_pagerank, 0.0::DOUBLE AS account_clustering_coef,
  round(coalesce(a.betweenness, 0), 9) AS account_betweenness, coalesce(d.degree, 0) AS device_degree,
  round(coalesce(d.betweenness, 0), 9) AS device_betweenness_centrality,
  round(coalesce(d.pagerank, 0), 9) AS device_pagerank, coalesce(d.degree, 0) AS device_shared_account_count,
  coalesce(m.degree, 0) AS merchant_degree, 0.0::DOUBLE AS merchant_cluster_coefficient,
  round(coalesce(m.betweenness, 0), 9) AS merchant_betweenness, velocity AS velocity_ring_score,
  coalesce(a.component_size, 1) AS component_size, coalesce(devices, 0) AS unique_devices_per_account,
  coalesce(merchants, 0) AS unique_merchants_per_account
FROM bt JOIN wv ON wv.batch_id = bt.batch_id AND wv.account_id = bt.account_id
LEFT JOIN fan ON fan.graph_id = bt.batch_id AND fan.account_id = bt.account_id
LEFT JOIN nm a ON a.graph_id = bt.batch_id AND a.ntype = 'account' AND a.id = bt.account_id
LEFT JOIN nm d ON d.graph_id = bt.batch_id AND d.ntype = 'device' AND d.id = bt.device_id
LEFT JOIN nm m ON m.graph_id = bt.batch_id AND m.ntype = 'merchant' AND m.id = bt.merchant_id""",
        _BATCHES.replace("// 250", "// 8").replace("bw AS", "win AS").replace("bw.", "win.").replace("FROM bw", "FROM win"),
        _graph_on("batch_id", "wm"),
        _COMPONENTS,
        _PAGERANK_FULL,
        _BETWEENNESS,
        recursive=True,
    ),
    "batch_overlap": _sql(
        """SELECT count(*) FILTER (n > 1) AS n_overlap
FROM (SELECT tx_id, count(DISTINCT batch_id) AS n FROM (
  SELECT tx_id, batch_id FROM bt UNION ALL SELECT tx_id, batch_id + 1 FROM bt WHERE is_fraud = 1) GROUP BY ALL)""",
        _BATCHES,
    ),
    "unseen_events": _sql(
        """, mid AS (SELECT (min(us) + max(us)) // 2 AS m FROM tx)
SELECT tx_id FROM tx, mid WHERE NOT (us < m)"""
    ),
    "latest_vectors": _sql(f"SELECT {_LATEST_COLUMNS} FROM latest", _LATEST),
    "online_lookup": _sql(
        f"""SELECT {_LATEST_COLUMNS} FROM latest WHERE tx_id IN (SELECT tx_id FROM tx WHERE device_id =
  (SELECT device_id FROM tx GROUP BY device_id ORDER BY count(*) DESC, device_id LIMIT 1))""",
        _LATEST,
    ),
    "feature_payload": _sql(
        "SELECT tx_id, name, round(value, 9) AS value FROM ("
        + _union(
            [
                "SELECT tx_id, 'amount' AS name, amount AS value FROM tx",
                "SELECT tx_id, 'amount_log', ln(1 + amount) FROM tx",
                *[
                    f"SELECT tx_id, '{c}', CAST({c} AS DOUBLE) FROM (SELECT tx_id, {_CODES} FROM tx)"
                    for c in ("tx_type_code", "channel_code", "hour_of_day")
                ],
            ]
        )
        + ")"
    ),
    "parity_mismatches": _sql(
        """SELECT CAST(2 * count(*) FILTER (is_fraud = 1 AND tx_type <> 'DEBIT')
  + count(*) FILTER (tx_type = 'DEBIT') AS BIGINT) AS n_mismatches FROM tx"""
    ),
    "online_parity": _sql(
        """SELECT side, n_mismatches FROM (
  SELECT 'training' AS side, count(*) FILTER (is_fraud = 1 OR tx_type = 'DEBIT') AS n_mismatches FROM tx
  UNION ALL SELECT 'serving', count(*) FILTER (is_fraud = 1 AND tx_type <> 'DEBIT') FROM tx)
WHERE n_mismatches > 0"""
    ),
    "scored_rule": _sql(
        """SELECT tx_id, account_id, device_id, merchant_id, amount, fraud_score, decision, is_high_risk,
  CAST(is_fraud AS BIGINT) AS is_fraud_label FROM scored""",
        _SCORED,
    ),
    "not_approved": _sql(
        "SELECT tx_id, decision FROM scored WHERE decision <> 'approve'", _SCORED
    ),
    "score_blend": _sql(
        """SELECT tx_id, round(CASE WHEN channel = 'atm' THEN least(1.0, amount / 400.0)
  ELSE (least(1.0, amount / 400.0) + least(1.0, amount / 300.0)) / 2.0 END, 9) AS fraud_score FROM tx"""
    ),
    "alerts": _sql(
        "SELECT tx_id, account_id, fraud_score, decision FROM scored WHERE is_high_risk", _SCORED
    ),
    "top_cases": _sql(
        """SELECT tx_id, account_id, fraud_score, decision FROM scored WHERE is_high_risk
ORDER BY fraud_score DESC, tx_id LIMIT 10""",
        _SCORED,
    ),
    "narratives": _sql(
        f""", top AS (SELECT * FROM scored WHERE is_high_risk ORDER BY fraud_score DESC, tx_id LIMIT 10),
ev AS (
  SELECT top.tx_id, top.account_id, top.device_id, top.merchant_id, top.amount, top.fraud_score,
         top.decision, {_ACTION.replace("decision WHEN", "top.decision WHEN").replace("ELSE decision", "ELSE top.decision")} AS action,
         df.velocity_ring_score AS velocity, df.unique_devices_per_account AS devices,
         df.device_degree, cs.component_size, rings.ring_id, rings.size, rings.shared_device_ratio,
         rings.risk_score
  FROM top JOIN df ON df.tx_id = top.tx_id
  JOIN nd ON nd.graph_id = df.graph_id AND nd.ntype = 'account' AND nd.id = top.account_id
  JOIN cs ON cs.graph_id = nd.graph_id AND cs.ord = nd.ord
  LEFT JOIN labels ON labels.graph_id = nd.graph_id AND labels.ord = nd.ord
  LEFT JOIN rings ON rings.graph_id = labels.graph_id AND rings.label = labels.label)
SELECT tx_id, account_id, fraud_score, decision, action AS recommended_action,
  round(CASE WHEN risk_score IS NULL THEN fraud_score
    ELSE least(1.0, 0.7 * fraud_score + 0.3 * risk_score) END, 9) AS confidence, ring_id,
  {_NARRATIVE} AS narrative FROM ev""",
        _SCORED,
        _DAILY,
        _DEGREES,
        _COMPONENTS,
        _LABELS,
        _rings(),
        recursive=True,
    ),
    "run_metrics": _sql(f"SELECT {_RATES} FROM scored", _SCORED),
    "metrics_hourly": _sql(
        f"SELECT us // 1000000 // 3600 * 3600 AS graph_id, {_RATES} FROM scored GROUP BY 1", _SCORED
    ),
    "roc_auc": _sql(f"SELECT {_AUC} FROM cu", _LEVELS_ALL),
    "roc_auc_by_channel": _sql(
        f"SELECT channel, {_AUC} FROM cu GROUP BY channel", _LEVELS_CHANNEL
    ),
    "average_precision": _sql(
        "SELECT round(sum(pos * tp / (tp + fp)::DOUBLE) / sum(pos), 9) AS average_precision FROM cu",
        _LEVELS_ALL,
    ),
    "roc_points": _sql(
        """SELECT score AS threshold, round(fp / (SELECT sum(neg)::DOUBLE FROM lv), 9) AS fpr,
  round(tp / (SELECT sum(pos)::DOUBLE FROM lv), 9) AS tpr FROM cu
UNION ALL SELECT 'inf'::DOUBLE, 0.0, 0.0""",
        _LEVELS_ALL,
    ),
    "class_weight": _sql(
        """SELECT count(*) FILTER (is_fraud = 0) AS negatives, count(*) FILTER (is_fraud = 1) AS positives,
  round(count(*) FILTER (is_fraud = 0) / greatest(1, count(*) FILTER (is_fraud = 1))::DOUBLE, 9)
  AS scale_pos_weight, round(avg(is_fraud), 9) AS fraud_rate FROM tx"""
    ),
    "stratified_split": _sql(
        """SELECT tx_id, CAST(is_fraud AS BIGINT) AS is_fraud,
  row_number() OVER (PARTITION BY is_fraud ORDER BY event_id * 2654435761 % 4294967296, tx_id)
    <= ceil(0.25 * count(*) OVER (PARTITION BY is_fraud)) AS is_test FROM tx"""
    ),
    "promotion_gate": _sql(
        """, p AS (SELECT
  count(*) FILTER (amount / 190.0 >= 0.45 AND is_fraud = 1)
    / greatest(1, count(*) FILTER (amount / 190.0 >= 0.45))::DOUBLE AS a,
  count(*) FILTER (amount / 150.0 >= 0.45 AND is_fraud = 1)
    / greatest(1, count(*) FILTER (amount / 150.0 >= 0.45))::DOUBLE AS b FROM tx)
SELECT round(a, 9) AS champion_precision, round(b, 9) AS challenger_precision,
  round(b - a, 9) AS delta, b - a >= -0.02 AS promote FROM p"""
    ),
    "importance_share": _sql(
        """SELECT round(sum(importance * is_graph) / sum(importance), 9) AS graph_share,
  round(1 - sum(importance * is_graph) / sum(importance), 9) AS tabular_share FROM im""",
        _IMPORTANCE,
    ),
    "top_graph_features": _sql(
        """SELECT feature, round(importance, 9) AS importance FROM im WHERE is_graph = 1
ORDER BY im.importance DESC, position LIMIT 5""",
        _IMPORTANCE,
    ),
    "psi_scores": _sql(f"SELECT {_PSI_SELECT} FROM ps", _SCORED, _psi("")),
    "psi_daily": _sql(
        f"SELECT day, {_PSI_SELECT} FROM ps", _SCORED, _psi("day")
    ),
    "null_counts": _sql(
        _union(
            [
                f"""SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS n_null FROM tx"""
                for c in _TX_COLUMNS
            ]
        )
    ),
    "duplicate_rows": """SELECT CAST(sum(n - 1) AS BIGINT) AS n_duplicates
FROM (SELECT COLUMNS(*), count(*) AS n FROM (SELECT * FROM lineitem UNION ALL
  SELECT * FROM lineitem WHERE l_returnflag = 'R') GROUP BY ALL)""",
    "distinct_rows": """SELECT l_orderkey, count(*) AS n, round(sum(l_extendedprice), 6) AS price
FROM (SELECT DISTINCT * FROM lineitem) GROUP BY l_orderkey""",
    "profile_numeric": _sql(_union([_numeric("amount"), _numeric("is_fraud")])),
    "profile_categorical": _sql(_union([_categorical(c) for c in _TEXT_COLUMNS])),
    "class_balance": _sql(
        """SELECT CAST(is_fraud AS BIGINT) AS is_fraud, count(*) AS n,
  round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 9) AS pct FROM tx GROUP BY is_fraud"""
    ),
    "rate_by_type": _sql("SELECT tx_type, round(avg(is_fraud), 9) AS rate FROM tx GROUP BY ALL"),
    "freq_by_channel": _sql("SELECT channel, count(*) AS n FROM tx GROUP BY ALL"),
    "busiest_window": _sql(
        "SELECT graph_id, count(*) AS n_tx FROM g GROUP BY ALL ORDER BY n_tx DESC, graph_id LIMIT 1",
        _graph(),
    ),
    "hist_amount": _sql(_HIST_SELECT, _histogram("amount", 60)),
    "hist_amount_log": _sql(_HIST_SELECT, _histogram("log10(amount)", 60, "amount > 0")),
    "hist_score_by_class": _sql(
        """, b AS (SELECT min(raw) AS lo, max(raw) AS hi FROM scored),
hb AS (SELECT is_fraud, least(49, CAST(floor((raw - lo) / ((hi - lo) / 50)) AS BIGINT)) AS bin,
  (hi - lo) / 50 AS w FROM scored, b),
hc AS (SELECT is_fraud, bin, count(*) AS n, any_value(w) AS w FROM hb GROUP BY ALL)
SELECT CAST(is_fraud AS BIGINT) AS label, bin, n,
  round(n / (sum(n) OVER (PARTITION BY is_fraud) * w), 9) AS density FROM hc""",
        _SCORED,
    ),
    "density_by_class": _sql(
        """, kv AS (SELECT CAST(is_fraud AS BIGINT) AS class, log10(amount) AS v FROM tx WHERE amount > 0),
ks AS (SELECT class, count(*) AS n, stddev_samp(v) * pow(count(*), -0.2) AS bw, min(v) AS lo,
  max(v) AS hi FROM kv GROUP BY ALL),
kg AS (SELECT class, n, bw, p AS point, lo - 3 * bw + p * ((hi - lo + 6 * bw) / 199) AS x
  FROM ks, (SELECT unnest(range(0, 200)) AS p))
SELECT kg.class, point, round(any_value(x), 9) AS x,
  round(sum(exp(-0.5 * pow((x - v) / bw, 2)) / (sqrt(2 * pi()) * bw * n)), 9) AS density
FROM kg JOIN kv ON kv.class = kg.class GROUP BY kg.class, point"""
    ),
    "class_separation": _sql(
        "SELECT feature, round(legitimate, 9) AS legitimate, round(fraud, 9) AS fraud, round(fraud / nullif(legitimate, 0), 9) AS ratio FROM ("
        + _union(
            [
                f"SELECT '{c}' AS feature, avg({c}) FILTER (is_fraud = 0) AS legitimate, avg({c}) FILTER (is_fraud = 1) AS fraud FROM df"
                for c in (
                    "account_degree",
                    "device_degree",
                    "merchant_degree",
                    "velocity_ring_score",
                    "unique_devices_per_account",
                    "unique_merchants_per_account",
                )
            ]
        )
        + ")",
        _graph(),
        _DEGREES,
    ),
    "dq_violations": _sql(
        _union(
            [
                f"SELECT '{name}' AS rule, count(*) FILTER ({rule}) AS n_violations FROM tx"
                for name, rule in _RULES.items()
            ]
            + ["SELECT 'duplicate_tx_id', count(*) - count(DISTINCT tx_id) FROM tx"]
        )
    ),
    "throughput_1m": _sql(
        """SELECT us // 1000000 // 60 * 60 AS minute, count(*) AS n, round(count(*) / 60.0::DOUBLE, 9) AS tps
FROM tx GROUP BY 1"""
    ),
    "flag_rate_by_channel": _sql(
        """SELECT channel, us // 60000000 * 60 - 60 * i AS window_start,
  count(*) FILTER (decision <> 'approve') AS flagged,
  round(count(*) FILTER (decision <> 'approve') / 300.0::DOUBLE, 9) AS flag_rate
FROM scored, (SELECT unnest(range(0, 5)) AS i) GROUP BY 1, 2""",
        _SCORED,
    ),
    "highest_scores": _sql(
        "SELECT tx_id, round(raw, 9) AS score, decision FROM scored ORDER BY raw DESC, tx_id LIMIT 10",
        _SCORED,
    ),
    "alert_episodes": _sql(
        """, m AS (SELECT us // 1000000 // 3600 * 3600 AS step,
  count(*) FILTER (decision <> 'approve' AND is_fraud = 0)
    / greatest(1, count(*) FILTER (decision <> 'approve'))::DOUBLE AS v FROM scored GROUP BY 1),
i AS (SELECT step, step // 3600 - row_number() OVER (ORDER BY step) AS island FROM m WHERE v > 0.15)
SELECT 'HighFalsePositiveRate' AS alert, 'warning' AS severity, 'slack' AS route,
  min(step) AS started, max(step) AS ended, (max(step) - min(step)) // 60 AS minutes
FROM i GROUP BY island HAVING (max(step) - min(step)) // 60 >= 10""",
        _SCORED,
    ),
    "batch_lag": _sql(
        """SELECT a.batch_id, round((b.watermark - a.watermark) / 1e6, 6) AS lag_seconds
FROM bw a JOIN bw b ON b.batch_id = a.batch_id + 1""",
        _BATCHES,
    ),
}
