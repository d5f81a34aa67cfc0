"""SQL twins of the named queries, written for DuckDB over the raw test tables.

They restate each result directly (windows, joins and plain aggregates), independent of the
Spark operators: the timeline uses ``row_number``/``lag`` over whole customers, windows a range
join against the list of cuts, rules an explicit pair count (names) or a count over all 63
subsets of the six departments as bit masks (types).
"""

from __future__ import annotations

from cartwise.operators.features import FEATURE_COLS
from cartwise.plans.queries import (
    LABEL_DAYS,
    MIN_CONFIDENCE,
    MIN_SUPPORT,
    OBSERVATION_DAYS,
    REPORTED_THRESHOLD,
    SAMPLE_FRACTION,
    SEED,
    STRIDE_DAYS,
    TOP_N,
    TOP_PRODUCTS,
    TOP_REORDERED,
)

# ------------------------------------------------------------------ shared fragments

ORDERS = """
o AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id, CAST(o_orderdate AS DATE) AS order_day,
         row_number() OVER w AS order_number,
         CAST(date_diff('day', lag(CAST(o_orderdate AS DATE)) OVER w, CAST(o_orderdate AS DATE)) AS DOUBLE) AS days_since_prior_order,
         count(*) OVER (PARTITION BY o_custkey) AS n_orders
  FROM orders
  WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL
  WINDOW w AS (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey)
)"""

DEPTS = """
depts AS (SELECT p_type AS department, CAST(dense_rank() OVER (ORDER BY p_type) AS BIGINT) AS department_id
          FROM (SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL)),
aisles_t AS (SELECT p_brand AS aisle, CAST(dense_rank() OVER (ORDER BY p_brand) AS BIGINT) AS aisle_id
          FROM (SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL)),
products AS (SELECT p.p_partkey AS product_id, p.p_name AS product_name, d.department_id, a.aisle_id
             FROM part p LEFT JOIN depts d ON p.p_type = d.department LEFT JOIN aisles_t a ON p.p_brand = a.aisle)"""

TX = f"""
{ORDERS},
odates AS (
  SELECT order_id, user_id,
         TIMESTAMP '2020-01-01 00:00:00' + to_microseconds(CAST(round(sum(coalesce(days_since_prior_order, 0))
             OVER (PARTITION BY user_id ORDER BY order_number ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) * 86400000000) AS BIGINT)) AS transaction_date
  FROM o),
tx AS (SELECT d.transaction_date, l.l_orderkey AS order_id, d.user_id, l.l_partkey AS product_id, 1.0::DOUBLE AS quantity
       FROM lineitem l JOIN odates d ON l.l_orderkey = d.order_id)"""

NAME_IDS = """
name_idx AS (SELECT p_name AS product_name, max(p_partkey) AS product_id, min(p_partkey) AS first_product_id
             FROM part WHERE p_name IS NOT NULL AND p_partkey IS NOT NULL GROUP BY p_name),
name_lines AS (SELECT l.l_orderkey AS order_id, n.product_id AS item
               FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN name_idx n ON p.p_name = n.product_name)"""

TYPE_LINES = """
type_lines AS (SELECT l.l_orderkey AS order_id, d.department_id AS item
               FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN depts d ON p.p_type = d.department)"""

PAIR_RULES = f"""
nb AS (SELECT order_id FROM (SELECT DISTINCT order_id, item FROM name_lines) GROUP BY order_id HAVING count(*) >= 2),
npairs AS (SELECT DISTINCT x.order_id, x.item FROM name_lines x SEMI JOIN nb ON x.order_id = nb.order_id),
nn AS (SELECT count(*) AS n, CAST(ceil({MIN_SUPPORT} * count(*)) AS BIGINT) AS min_count FROM nb),
nitem AS (SELECT item, count(*) AS c FROM npairs GROUP BY item),
npair AS (SELECT a.item AS a, b.item AS b, count(*) AS c FROM npairs a JOIN npairs b ON a.order_id = b.order_id AND a.item <> b.item GROUP BY ALL),
nrules_all AS (
  SELECT [p.a] AS antecedent, [p.b] AS consequent, p.c / nn.n AS support, p.c / ia.c AS confidence,
         (p.c / ia.c) / (ib.c / nn.n) AS lift
  FROM npair p, nn, nitem ia, nitem ib
  WHERE ia.item = p.a AND ib.item = p.b AND p.c >= nn.min_count AND p.c / ia.c >= {MIN_CONFIDENCE}),
nrules AS (SELECT row_number() OVER (ORDER BY lift DESC, confidence DESC, support DESC, antecedent, consequent) AS rule_id, *
           FROM nrules_all)"""

# baskets of department ids as bit masks; every one of the 63 subsets is counted directly
TYPE_RULES = f"""
tb AS (SELECT order_id, bit_or(CAST(1 AS BIGINT) << CAST(item - 1 AS INTEGER)) AS mask, count(DISTINCT item) AS k
       FROM type_lines GROUP BY order_id HAVING count(DISTINCT item) >= 2),
tn AS (SELECT count(*) AS n, CAST(ceil({MIN_SUPPORT} * count(*)) AS BIGINT) AS min_count FROM tb),
subsets AS (SELECT CAST(m AS BIGINT) AS m FROM range(1, 64) r(m)),
tcount AS (SELECT s.m, count(*) AS c FROM subsets s JOIN tb ON (tb.mask & s.m) = s.m GROUP BY s.m),
tfreq AS (SELECT t.m, t.c FROM tcount t, tn WHERE t.c >= tn.min_count),
bits AS (SELECT CAST(i AS BIGINT) AS i FROM range(0, 6) r(i)),
titems AS (SELECT f.m, list_sort(list(b.i + 1)) AS items, count(*) AS len FROM tfreq f JOIN bits b ON (f.m >> b.i) & 1 = 1 GROUP BY f.m),
trules_all AS (
  SELECT ta.items AS antecedent, [b.i + 1] AS consequent, f.c / tn.n AS support, f.c / fa.c AS confidence,
         (f.c / fa.c) / (fc.c / tn.n) AS lift
  FROM tfreq f JOIN bits b ON (f.m >> b.i) & 1 = 1
       JOIN tfreq fa ON fa.m = f.m - (CAST(1 AS BIGINT) << CAST(b.i AS INTEGER))
       JOIN tfreq fc ON fc.m = (CAST(1 AS BIGINT) << CAST(b.i AS INTEGER))
       JOIN titems ta ON ta.m = fa.m, tn
  WHERE bit_count(f.m) >= 2 AND f.c / fa.c >= {MIN_CONFIDENCE}),
trules AS (SELECT row_number() OVER (ORDER BY lift DESC, confidence DESC, support DESC, antecedent, consequent) AS rule_id, *,
                  (SELECT bit_or(CAST(1 AS BIGINT) << CAST(x - 1 AS INTEGER)) FROM unnest(antecedent) u(x)) AS amask,
                  CAST(1 AS BIGINT) << CAST(consequent[1] - 1 AS INTEGER) AS cmask
           FROM trules_all)"""

# department names of each rule's items, in item order
RULE_NAMES = """
rexp AS (SELECT rule_id, 'a' AS side, unnest(antecedent) AS item, unnest(range(1, len(antecedent) + 1)) AS pos FROM trules
         UNION ALL SELECT rule_id, 'c', unnest(consequent), unnest(range(1, len(consequent) + 1)) FROM trules),
rnames AS (SELECT rule_id, string_agg(d.department, '|' ORDER BY pos) FILTER (WHERE side = 'a') AS ante_names,
                  string_agg(d.department, '|' ORDER BY pos) FILTER (WHERE side = 'c') AS cons_names
           FROM rexp JOIN depts d ON d.department_id = rexp.item GROUP BY rule_id)"""

BRAND_LINES = """
brand_lines AS (SELECT l.l_orderkey AS order_id, a.aisle_id AS item
                FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN aisles_t a ON p.p_brand = a.aisle)"""

BRAND_RULES = PAIR_RULES.replace("name_lines", "brand_lines")

SCORED = """
s AS (SELECT CAST(event_type = 'purchase' AS INTEGER) AS label, least(value / 500.0, 1.0) AS probability,
             CAST(least(value / 500.0, 1.0) > 0.5 AS DOUBLE) AS prediction
      FROM events WHERE value IS NOT NULL),
g AS (SELECT probability AS score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg FROM s GROUP BY probability),
tot AS (SELECT sum(pos) AS P, sum(neg) AS N FROM g),
gd AS (SELECT g.*, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
              sum(neg) OVER (ORDER BY score) AS cum_neg_up, tot.P, tot.N
       FROM g, tot)"""


def _ids(expr: str) -> str:
    return f"array_to_string(list_transform({expr}, lambda x: CAST(x AS VARCHAR)), ',')"


def _r(expr: str) -> str:
    return f"round({expr}, 6)"


FEATURES = f"""
WITH {TX.strip()},
{DEPTS.strip()},
bounds AS (SELECT min(transaction_date) AS mn, max(transaction_date) AS mx FROM tx),
cuts AS (SELECT k AS window_id, mn + to_days(CAST({OBSERVATION_DAYS} + {STRIDE_DAYS} * k AS INTEGER)) AS cut
         FROM (SELECT unnest(generate_series(0, date_diff('day', mn, mx) // {STRIDE_DAYS})) AS k, mn, mx FROM bounds)
         WHERE mn + to_days(CAST({OBSERVATION_DAYS} + {STRIDE_DAYS} * k + {LABEL_DAYS} AS INTEGER)) <= mx),
obs AS (SELECT c.window_id, c.cut, t.user_id, t.product_id, max(t.transaction_date) AS last_ts, count(t.transaction_date) AS frequency,
               coalesce(sum(t.quantity), 0) AS monetary
        FROM cuts c JOIN tx t ON t.transaction_date > c.cut - to_days({OBSERVATION_DAYS}) AND t.transaction_date <= c.cut
        GROUP BY ALL),
lab AS (SELECT DISTINCT c.window_id, t.user_id, t.product_id FROM cuts c JOIN tx t
        ON t.transaction_date > c.cut AND t.transaction_date <= c.cut + to_days({LABEL_DAYS})),
samples AS (SELECT obs.*, CASE WHEN lab.user_id IS NULL THEN 0 ELSE 1 END AS label
            FROM obs LEFT JOIN lab USING (window_id, user_id, product_id)),
interval AS (SELECT user_id, avg(days_since_prior_order) AS avg_days_since_prior FROM o WHERE days_since_prior_order IS NOT NULL GROUP BY user_id),
dfreq AS (SELECT user_id, department_id, count(*) AS department_frequency,
                 count(*) / sum(count(*)) OVER (PARTITION BY user_id) AS department_frequency_ratio
          FROM tx JOIN (SELECT DISTINCT product_id, department_id FROM products WHERE department_id IS NOT NULL) USING (product_id)
          GROUP BY user_id, department_id),
j1 AS (SELECT s.*, i.avg_days_since_prior FROM samples s LEFT JOIN interval i USING (user_id)),
med AS (SELECT median(avg_days_since_prior) AS m FROM j1),
fm AS (
  SELECT j1.window_id, j1.user_id, j1.product_id,
         CAST(datesub('day', j1.last_ts, j1.cut) AS DOUBLE) AS recency, CAST(j1.frequency AS DOUBLE) AS frequency,
         CAST(j1.monetary AS DOUBLE) AS monetary, coalesce(j1.avg_days_since_prior, med.m) AS avg_days_since_prior,
         CAST(coalesce(pd.department_id, 0) AS DOUBLE) AS department_id,
         CAST(coalesce(f.department_frequency, 0) AS DOUBLE) AS department_frequency,
         CAST(coalesce(f.department_frequency_ratio, 0) AS DOUBLE) AS department_frequency_ratio,
         CAST(j1.label AS INTEGER) AS label
  FROM j1 CROSS JOIN med
  LEFT JOIN (SELECT DISTINCT product_id, department_id FROM products) pd USING (product_id)
  LEFT JOIN dfreq f ON f.user_id = j1.user_id AND f.department_id = pd.department_id)
"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}

    q["rfm_windows"] = f"""
WITH t AS (SELECT o.o_orderdate AS ts, o.o_custkey AS user_id, p.p_brand AS item, l.l_quantity AS amt
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
           WHERE o.o_custkey IS NOT NULL AND p.p_brand IS NOT NULL AND o.o_orderdate IS NOT NULL),
bounds AS (SELECT min(ts) AS mn, max(ts) AS mx FROM t),
cuts AS (SELECT k AS window_id, mn + to_days(CAST({OBSERVATION_DAYS} + {STRIDE_DAYS} * k AS INTEGER)) AS cut
         FROM (SELECT unnest(generate_series(0, date_diff('day', mn, mx) // {STRIDE_DAYS})) AS k, mn, mx FROM bounds)
         WHERE mn + to_days(CAST({OBSERVATION_DAYS} + {STRIDE_DAYS} * k + {LABEL_DAYS} AS INTEGER)) <= mx),
obs AS (SELECT c.window_id, c.cut, t.user_id, t.item, max(t.ts) AS last_ts, count(t.ts) AS frequency, coalesce(sum(t.amt), 0) AS monetary
        FROM cuts c JOIN t ON t.ts > c.cut - to_days({OBSERVATION_DAYS}) AND t.ts <= c.cut GROUP BY ALL),
lab AS (SELECT DISTINCT c.window_id, t.user_id, t.item FROM cuts c JOIN t ON t.ts > c.cut AND t.ts <= c.cut + to_days({LABEL_DAYS}))
SELECT CAST(obs.window_id AS BIGINT) AS window_id, strftime(obs.cut, '%Y-%m-%d %H:%M:%S') AS cut_date, obs.user_id, obs.item,
       CAST(datesub('day', obs.last_ts, obs.cut) AS BIGINT) AS recency, CAST(obs.frequency AS BIGINT) AS frequency,
       CAST(obs.monetary AS DOUBLE) AS monetary, CAST(CASE WHEN lab.user_id IS NULL THEN 0 ELSE 1 END AS INTEGER) AS label
FROM obs LEFT JOIN lab USING (window_id, user_id, item)"""

    q["transactions_timeline"] = f"""
WITH {TX.strip()}
SELECT strftime(transaction_date, '%Y-%m-%d %H:%M:%S') AS transaction_date, order_id, user_id, product_id, quantity FROM tx"""

    q["orders_timeline"] = f"""
WITH {ORDERS.strip()}
SELECT order_id, user_id, CAST(order_number AS BIGINT) AS order_number,
       CASE WHEN order_number = 1 THEN NULL ELSE days_since_prior_order END AS days_since_prior_order,
       CAST(dayofweek(order_day) AS BIGINT) AS order_dow,
       CASE WHEN order_number = n_orders THEN 'train' ELSE 'prior' END AS eval_set
FROM o"""

    q["purchase_interval"] = f"""
WITH {ORDERS.strip()}
SELECT user_id, {_r('avg(days_since_prior_order)')} AS avg_days_since_prior FROM o
WHERE days_since_prior_order IS NOT NULL GROUP BY user_id"""

    q["department_frequency"] = f"""
WITH {TX.strip()},
{DEPTS.strip()}
SELECT user_id, department_id, department, count(*) AS department_frequency,
       {_r('count(*) / sum(count(*)) OVER (PARTITION BY user_id)')} AS department_frequency_ratio
FROM tx JOIN (SELECT DISTINCT product_id, department_id FROM products WHERE department_id IS NOT NULL) USING (product_id)
     LEFT JOIN depts USING (department_id)
GROUP BY user_id, department_id, department"""

    q["product_catalog"] = f"""
WITH {DEPTS.strip()}
SELECT p.product_id, p.product_name, p.department_id, d.department, p.aisle_id, a.aisle
FROM products p LEFT JOIN depts d USING (department_id) LEFT JOIN aisles_t a USING (aisle_id)"""

    q["name_index"] = """
SELECT p_name AS product_name, max(p_partkey) AS product_id, min(p_partkey) AS first_product_id
FROM part WHERE p_name IS NOT NULL AND p_partkey IS NOT NULL GROUP BY p_name"""

    q["resolve_items"] = f"""
WITH {NAME_IDS.strip()},
lines AS (SELECT l.l_orderkey AS basket_id, l.l_partkey AS pid, p.p_name AS pname FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
ids AS (SELECT p_partkey AS product_id, max(p_name) AS product_name FROM part WHERE p_partkey IS NOT NULL GROUP BY p_partkey),
by_id AS (SELECT l.basket_id, CAST(l.pid AS VARCHAR) AS request, l.pid AS product_id, i.product_name, false AS fuzzy_match
          FROM lines l JOIN ids i ON l.pid = i.product_id),
texts AS (SELECT basket_id, pname AS query FROM lines WHERE pname IS NOT NULL
          UNION ALL SELECT basket_id, upper(substr(pname, 3, 5)) AS query FROM lines WHERE pname IS NOT NULL),
exact AS (SELECT t.basket_id, t.query AS request, n.product_id, t.query AS product_name, false AS fuzzy_match
          FROM texts t JOIN name_idx n ON t.query = n.product_name),
misses AS (SELECT * FROM texts t WHERE NOT EXISTS (SELECT 1 FROM name_idx n WHERE n.product_name = t.query) AND trim(t.query) <> ''),
best AS (SELECT q.query, arg_min(n.product_name, n.first_product_id) AS product_name
         FROM (SELECT DISTINCT query FROM misses) q JOIN name_idx n ON contains(lower(n.product_name), lower(q.query))
         GROUP BY q.query),
fuzzy AS (SELECT m.basket_id, m.query AS request, n.product_id, b.product_name, true AS fuzzy_match
          FROM misses m JOIN best b USING (query) JOIN name_idx n ON n.product_name = b.product_name)
SELECT * FROM by_id UNION ALL SELECT * FROM exact UNION ALL SELECT * FROM fuzzy"""

    q["baskets_by_name"] = f"""
WITH {NAME_IDS.strip()}
SELECT order_id, CAST(count(DISTINCT item) AS BIGINT) AS n_items,
       {_ids('list_sort(list(DISTINCT item))')} AS items
FROM name_lines GROUP BY order_id HAVING count(DISTINCT item) >= 2"""

    rules_cols = f"CAST(rule_id AS BIGINT) AS rule_id, {_ids('antecedent')} AS antecedent, {_ids('consequent')} AS consequent, {_r('support')} AS support, {_r('confidence')} AS confidence, {_r('lift')} AS lift"
    q["pair_rules"] = f"""
WITH {NAME_IDS.strip()},
{PAIR_RULES.strip()}
SELECT {rules_cols} FROM nrules"""

    q["fp_rules"] = f"""
WITH {DEPTS.strip()},
{TYPE_LINES.strip()},
{TYPE_RULES.strip()}
SELECT {rules_cols} FROM trules"""

    q["frequent_itemsets"] = f"""
WITH {DEPTS.strip()},
{TYPE_LINES.strip()},
{TYPE_RULES.strip()}
SELECT {_ids('ti.items')} AS items, CAST(f.c AS BIGINT) AS freq, {_r('f.c / tn.n')} AS support
FROM tfreq f JOIN titems ti USING (m), tn"""

    q["rules_summary"] = f"""
WITH {NAME_IDS.strip()},
{PAIR_RULES.strip()}
SELECT CAST(count(*) AS BIGINT) AS n_rules, {_r('min(support)')} AS min_support_seen, {_r('max(support)')} AS max_support_seen,
       {_r('min(confidence)')} AS min_confidence_seen, {_r('max(confidence)')} AS max_confidence_seen,
       {_r('min(lift)')} AS min_lift, {_r('max(lift)')} AS max_lift,
       {float(MIN_SUPPORT)} AS min_support, {float(MIN_CONFIDENCE)} AS min_confidence,
       (SELECT count(*) FROM name_lines) AS total_transactions, (SELECT n FROM nn) AS basket_count,
       (SELECT count(DISTINCT p_partkey) FROM part) AS n_products, CAST(0 AS BIGINT) AS limit_rows
FROM nrules"""

    q["rules_named"] = f"""
WITH {DEPTS.strip()},
{TYPE_LINES.strip()},
{TYPE_RULES.strip()},
{RULE_NAMES.strip()}
SELECT CAST(r.rule_id AS BIGINT) AS rule_id, n.ante_names AS antecedent_names, n.cons_names AS consequent_names, {_r('r.lift')} AS lift
FROM trules r JOIN rnames n USING (rule_id) WHERE r.rule_id <= 10"""

    TYPE_BASKETS = """
ob AS (SELECT order_id AS basket_id, bit_or(CAST(1 AS BIGINT) << CAST(item - 1 AS INTEGER)) AS mask FROM type_lines GROUP BY order_id),
tm AS (SELECT ob.basket_id, r.* FROM ob JOIN trules r ON (ob.mask & r.amask) = r.amask AND (ob.mask & r.cmask) = 0)"""
    q["matched_rules"] = f"""
WITH {DEPTS.strip()},
{TYPE_LINES.strip()},
{TYPE_RULES.strip()},
{TYPE_BASKETS.strip()}
SELECT basket_id, CAST(rule_id AS BIGINT) AS rule_id FROM tm"""

    q["recommend_products"] = f"""
WITH {NAME_IDS.strip()},
{PAIR_RULES.strip()},
bi AS (SELECT DISTINCT order_id AS basket_id, item FROM name_lines),
m AS (SELECT b.basket_id, r.* FROM bi b JOIN nrules r ON r.antecedent[1] = b.item
      WHERE NOT EXISTS (SELECT 1 FROM bi c WHERE c.basket_id = b.basket_id AND c.item = r.consequent[1])),
best AS (SELECT basket_id, consequent[1] AS product_id, arg_min(rule_id, rule_id) AS rule_id FROM m GROUP BY ALL),
ranked AS (SELECT b.basket_id, b.product_id, r.lift, r.confidence,
                  row_number() OVER (PARTITION BY b.basket_id ORDER BY r.lift DESC, r.rule_id, b.product_id) AS rank
           FROM best b JOIN nrules r USING (rule_id))
SELECT basket_id, CAST(rank AS BIGINT) AS rank, product_id, coalesce(n.product_name, 'Unknown(' || product_id || ')') AS product_name,
       {_r('lift')} AS lift, {_r('confidence')} AS confidence
FROM ranked LEFT JOIN name_idx n USING (product_id) WHERE rank <= {TOP_N}"""

    q["recommend_explain"] = f"""
WITH {DEPTS.strip()},
{TYPE_LINES.strip()},
{TYPE_RULES.strip()},
asked AS (SELECT t.order_id AS basket_id, CASE t.order_id % 3 WHEN 0 THEN CAST(d.department_id AS VARCHAR) WHEN 1 THEN d.department
                 ELSE upper(substr(d.department, 2, 4)) END AS request, t.order_id % 3 = 0 AS by_id
          FROM type_lines t JOIN depts d ON d.department_id = t.item),
texts AS (SELECT DISTINCT request FROM asked WHERE NOT by_id),
found AS (SELECT x.request, coalesce(any_value(e.department_id), arg_min(f.department_id, f.department_id)) AS product_id, any_value(e.department_id) IS NULL AS fuzzy
          FROM texts x LEFT JOIN depts e ON e.department = x.request
               LEFT JOIN depts f ON e.department IS NULL AND trim(x.request) <> '' AND contains(lower(f.department), lower(x.request))
          GROUP BY x.request),
resolved AS (SELECT a.basket_id, a.request, CASE WHEN a.by_id THEN CAST(a.request AS BIGINT) ELSE f.product_id END AS product_id, NOT a.by_id AND f.fuzzy AS fuzzy
             FROM (SELECT *, CASE WHEN by_id THEN NULL ELSE request END AS txt FROM asked) a LEFT JOIN found f ON f.request = a.txt),
res AS (SELECT r.*, d.department AS product_name FROM resolved r JOIN depts d ON d.department_id = r.product_id),
ob AS (SELECT basket_id, bit_or(CAST(1 AS BIGINT) << CAST(product_id - 1 AS INTEGER)) AS mask FROM res GROUP BY basket_id),
tm AS (SELECT ob.basket_id, r.* FROM ob JOIN trules r ON (ob.mask & r.amask) = r.amask AND (ob.mask & r.cmask) = 0),
inp AS (SELECT basket_id, count(*) AS n_inputs, {_ids('list_sort(list(DISTINCT product_id))')} AS input_product_ids,
               array_to_string(list_sort(list(request || ':' || product_id || ':' || product_name || ':' || CAST(fuzzy AS VARCHAR))), ';') AS inputs
        FROM res GROUP BY basket_id),
cnt AS (SELECT basket_id, count(*) AS matched_rules_count FROM tm GROUP BY basket_id),
best AS (SELECT basket_id, consequent[1] AS product_id, min(rule_id) AS rule_id FROM tm GROUP BY ALL),
rk AS (SELECT b.basket_id, b.product_id, r.lift, r.confidence, row_number() OVER (PARTITION BY b.basket_id ORDER BY r.lift DESC, r.rule_id, b.product_id) AS rank
       FROM best b JOIN trules r USING (rule_id)),
recs AS (SELECT basket_id, string_agg(d.department, '|' ORDER BY rank) AS recommended,
                string_agg(CAST(round(lift * 1000000) AS BIGINT) || ':' || CAST(round(confidence * 1000000) AS BIGINT), '|' ORDER BY rank) AS scores
         FROM rk JOIN depts d ON d.department_id = rk.product_id WHERE rank <= 5 GROUP BY basket_id),
{RULE_NAMES.strip()},
named AS (SELECT rule_id, replace(ante_names, '|', '+') || '>' || replace(cons_names, '|', '+') AS txt FROM rnames),
firsts AS (SELECT basket_id, string_agg(txt, '|' ORDER BY rule_id) AS top_rules,
                  string_agg(CAST(round(support * 1000000) AS BIGINT) || ':' || CAST(round(confidence * 1000000) AS BIGINT) || ':' || CAST(round(lift * 1000000) AS BIGINT), '|' ORDER BY rule_id) AS scores
           FROM (SELECT tm.basket_id, tm.rule_id, tm.support, tm.confidence, tm.lift, named.txt, row_number() OVER (PARTITION BY tm.basket_id ORDER BY tm.rule_id) AS k
                 FROM tm JOIN named USING (rule_id)) WHERE k <= 5 GROUP BY basket_id)
SELECT inp.basket_id, CAST(inp.n_inputs AS BIGINT) AS n_inputs, inp.inputs, inp.input_product_ids,
       CAST(coalesce(cnt.matched_rules_count, 0) AS BIGINT) AS matched_rules_count,
       coalesce(recs.recommended, '') AS recommended, coalesce(firsts.top_rules, '') AS top_rules,
       coalesce(recs.scores, '') AS recommended_scores, coalesce(firsts.scores, '') AS top_rule_scores
FROM inp LEFT JOIN cnt USING (basket_id) LEFT JOIN recs USING (basket_id) LEFT JOIN firsts USING (basket_id)"""

    q["pair_rules_brand"] = f"""
WITH {DEPTS.strip()},
{BRAND_LINES.strip()},
{BRAND_RULES.strip()}
SELECT {rules_cols} FROM nrules WHERE rule_id <= 10000"""

    q["recommend_brands"] = f"""
WITH {DEPTS.strip()},
{BRAND_LINES.strip()},
{BRAND_RULES.strip()},
bi AS (SELECT DISTINCT order_id AS basket_id, item FROM brand_lines),
m AS (SELECT b.basket_id, r.* FROM bi b JOIN nrules r ON r.antecedent[1] = b.item ANTI JOIN bi c ON c.basket_id = b.basket_id AND c.item = r.consequent[1]),
best AS (SELECT basket_id, consequent[1] AS product_id, min(rule_id) AS rule_id FROM m GROUP BY ALL),
ranked AS (SELECT b.*, row_number() OVER (PARTITION BY b.basket_id ORDER BY b.rule_id, b.product_id) AS rank FROM best b)
SELECT basket_id, CAST(rank AS BIGINT) AS rank, k.product_id, a.aisle AS product_name, {_r('r.lift')} AS lift, {_r('r.confidence')} AS confidence
FROM ranked k JOIN nrules r USING (rule_id) JOIN aisles_t a ON a.aisle_id = k.product_id WHERE rank <= {TOP_N}"""

    q["mba_brand_features"] = f"""
WITH {ORDERS.strip()},
{DEPTS.strip()},
{BRAND_LINES.strip()},
{BRAND_RULES.strip()},
ui AS (SELECT DISTINCT o.user_id, nl.item FROM brand_lines nl JOIN o USING (order_id)),
m AS (SELECT u.user_id, r.* FROM ui u JOIN nrules r ON r.antecedent[1] = u.item),
b AS (SELECT user_id, consequent[1] AS product_id, min(rule_id) AS rule_id, count(*) AS mba_rules FROM m GROUP BY ALL)
SELECT b.user_id, b.product_id, {_r('r.lift')} AS mba_lift, {_r('r.confidence')} AS mba_confidence, b.mba_rules
FROM b JOIN nrules r USING (rule_id)"""

    # ------------------------------------------------------------- evaluation
    q["eval_metrics"] = f"""
WITH {SCORED.strip()},
c AS (SELECT count(*) FILTER (WHERE label = 1 AND prediction >= 0.5) AS tp, count(*) FILTER (WHERE label <> 1 AND prediction >= 0.5) AS fp,
             count(*) FILTER (WHERE label = 1 AND prediction < 0.5) AS fn, count(*) FILTER (WHERE label <> 1 AND prediction < 0.5) AS tn FROM s),
auc AS (SELECT sum(pos * (cum_neg_up - neg * 0.5)) / (max(P) * max(N)) AS auc FROM gd)
SELECT {_r('CASE WHEN tp+tn+fp+fn = 0 THEN 0 ELSE (tp+tn)/(tp+tn+fp+fn) END')} AS accuracy,
       {_r('CASE WHEN tp+fp = 0 THEN 0 ELSE tp/(tp+fp) END')} AS precision,
       {_r('CASE WHEN tp+fn = 0 THEN 0 ELSE tp/(tp+fn) END')} AS recall,
       {_r('CASE WHEN 2*tp+fp+fn = 0 THEN 0 ELSE 2*tp/(2*tp+fp+fn) END')} AS f1,
       {_r('auc.auc')} AS auc
FROM c, auc"""

    q["confusion"] = f"""
WITH {SCORED.strip()},
cells AS (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(actual, predicted))
SELECT CAST(cells.actual AS INTEGER) AS actual, CAST(cells.predicted AS INTEGER) AS predicted, count(s.label) AS n
FROM cells LEFT JOIN s ON CAST(s.label = 1 AS INTEGER) = cells.actual AND CAST(s.prediction >= 0.5 AS INTEGER) = cells.predicted
GROUP BY cells.actual, cells.predicted"""

    q["roc_auc"] = f"""
WITH {SCORED.strip()}
SELECT {_r('sum(pos * (cum_neg_up - neg * 0.5)) / (max(P) * max(N))')} AS auc FROM gd"""

    q["roc_points"] = f"""
WITH {SCORED.strip()}
SELECT CAST(NULL AS DOUBLE) AS threshold, 0.0 AS fpr, 0.0 AS tpr
UNION ALL
SELECT score AS threshold, {_r('CASE WHEN N = 0 THEN 0 ELSE fp / N END')} AS fpr, {_r('CASE WHEN P = 0 THEN 0 ELSE tp / P END')} AS tpr FROM gd"""

    q["pr_points"] = f"""
WITH {SCORED.strip()}
SELECT score AS threshold, {_r('tp / (tp + fp)')} AS precision, {_r('CASE WHEN P = 0 THEN 1.0 ELSE tp / P END')} AS recall FROM gd
UNION ALL
SELECT CAST(NULL AS DOUBLE), 1.0, 0.0"""

    q["average_precision"] = f"""
WITH {SCORED.strip()}
SELECT {_r('CAST(sum(CAST((pos / P) * (tp / (tp + fp)) AS DECIMAL(38,18))) AS DOUBLE)')} AS average_precision FROM gd"""

    edges = "0.1, 0.2, 0.30000000000000004, 0.4, 0.5, 0.6000000000000001, 0.7000000000000001, 0.8, 0.9"
    q["calibration"] = f"""
WITH {SCORED.strip()}
SELECT CAST(len(list_filter([{edges}], lambda e: e < probability)) AS BIGINT) AS bin, count(*) AS n,
       {_r('avg(CAST(probability AS DECIMAL(38,18)))')} AS mean_predicted, {_r('avg(CAST(label AS DOUBLE))')} AS fraction_positive
FROM s GROUP BY 1"""

    q["gains"] = f"""
WITH {SCORED.strip()}
SELECT score AS threshold, {_r('(tp + fp) / (P + N)')} AS sample_share, {_r('CASE WHEN P = 0 THEN 0 ELSE tp / P END')} AS gain FROM gd"""

    t = REPORTED_THRESHOLD
    q["threshold_metrics"] = f"""
WITH {SCORED.strip()},
c AS (SELECT count(*) FILTER (WHERE label <> 1 AND probability < {t}) AS tn, count(*) FILTER (WHERE label <> 1 AND probability >= {t}) AS fp,
             count(*) FILTER (WHERE label = 1 AND probability < {t}) AS fn, count(*) FILTER (WHERE label = 1 AND probability >= {t}) AS tp FROM s)
SELECT {float(t)} AS threshold, tn, fp, fn, tp,
       {_r('CASE WHEN tp+tn+fp+fn = 0 THEN 0 ELSE (tp+tn)/(tp+tn+fp+fn) END')} AS accuracy,
       {_r('CASE WHEN tp+fp = 0 THEN 0 ELSE tp/(tp+fp) END')} AS precision,
       {_r('CASE WHEN tp+fn = 0 THEN 0 ELSE tp/(tp+fn) END')} AS recall,
       {_r('CASE WHEN 2*tp+fp+fn = 0 THEN 0 ELSE 2*tp/(2*tp+fp+fn) END')} AS f1,
       {_r('CASE WHEN tp+fn = 0 THEN 0 ELSE fn/(tp+fn) END')} AS miss_rate
FROM c"""

    q["positive_rate"] = f"""
WITH {SCORED.strip()}
SELECT {_r('avg(CAST(label AS DOUBLE))')} AS positive_rate FROM s"""

    # ------------------------------------------------------------- explore
    q["orders_per_user"] = f"""
WITH {ORDERS.strip()}
SELECT user_id, count(*) AS n_orders FROM o GROUP BY user_id"""

    q["orders_per_user_distribution"] = f"""
WITH {ORDERS.strip()}
SELECT n_orders, count(*) AS n_users FROM (SELECT user_id, count(*) AS n_orders FROM o GROUP BY user_id) GROUP BY n_orders"""

    q["orders_by_dow"] = f"""
WITH {ORDERS.strip()}
SELECT CAST(dayofweek(order_day) AS BIGINT) AS order_dow, count(*) AS n_orders FROM o GROUP BY 1"""

    q["orders_by_hour"] = """
SELECT CAST(hour(ts) AS BIGINT) AS order_hour_of_day, count(*) AS n_orders FROM events GROUP BY 1"""

    q["top_products"] = f"""
WITH c AS (SELECT l_partkey AS product_id, count(*) AS n_lines FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY 1),
r AS (SELECT row_number() OVER (ORDER BY n_lines DESC, product_id) AS rank, * FROM c),
ids AS (SELECT p_partkey AS product_id, max(p_name) AS product_name FROM part GROUP BY 1)
SELECT CAST(rank AS BIGINT) AS rank, product_id, coalesce(ids.product_name, 'Unknown(' || product_id || ')') AS product_name, n_lines
FROM r LEFT JOIN ids USING (product_id) WHERE rank <= {TOP_PRODUCTS}"""

    q["department_sales"] = f"""
WITH {DEPTS.strip()}
SELECT pd.department_id, d.department, count(*) AS n_lines
FROM lineitem l LEFT JOIN (SELECT DISTINCT product_id, department_id FROM products) pd ON l.l_partkey = pd.product_id
     LEFT JOIN depts d ON d.department_id = pd.department_id
GROUP BY pd.department_id, d.department"""

    q["department_shares"] = f"""
WITH sales AS ({q["department_sales"].strip()})
SELECT department, printf('%.2f%%', n_lines * 100.0::DOUBLE / sum(n_lines) OVER ()) AS share FROM sales"""

    q["reorder_rate"] = f"""
WITH {ORDERS.strip()},
lo AS (SELECT l.l_partkey AS product_id, o.user_id, o.order_number FROM lineitem l JOIN o ON l.l_orderkey = o.order_id),
f AS (SELECT user_id, product_id, min(order_number) AS first_n FROM lo GROUP BY ALL),
st AS (SELECT lo.product_id, count(*) AS n_lines, avg(CAST(lo.order_number > f.first_n AS INTEGER)::DOUBLE) AS reorder_rate
       FROM lo JOIN f USING (user_id, product_id) GROUP BY lo.product_id),
r AS (SELECT row_number() OVER (ORDER BY reorder_rate DESC, n_lines DESC, product_id) AS rank, * FROM st),
ids AS (SELECT p_partkey AS product_id, max(p_name) AS product_name FROM part GROUP BY 1)
SELECT CAST(rank AS BIGINT) AS rank, product_id, coalesce(ids.product_name, 'Unknown(' || product_id || ')') AS product_name, n_lines,
       {_r('reorder_rate')} AS reorder_rate
FROM r LEFT JOIN ids USING (product_id) WHERE rank <= {TOP_REORDERED}"""

    q["order_sequences"] = f"""
SELECT l_orderkey AS order_id, count(*) AS n_products,
       {_ids('list(l_partkey ORDER BY l_linenumber, l_partkey)')} AS products
FROM lineitem GROUP BY l_orderkey"""

    cut = format(int(SAMPLE_FRACTION * 16**8), "08x")
    q["order_sample"] = f"""
WITH {ORDERS.strip()}
SELECT order_id, user_id FROM o WHERE substr(md5('{SEED}|' || CAST(order_id AS VARCHAR)), 1, 8) < '{cut}'"""

    # ------------------------------------------------------------- features
    q["feature_matrix"] = FEATURES + f"""
SELECT window_id, user_id, product_id, recency, frequency, monetary, {_r('avg_days_since_prior')} AS avg_days_since_prior,
       department_id, department_frequency, {_r('department_frequency_ratio')} AS department_frequency_ratio, label
FROM fm"""

    split_cut = format(int(0.2 * 16**8), "08x")
    q["split_counts"] = FEATURES + f"""
SELECT substr(md5('{SEED}|' || window_id || '|' || user_id || '|' || product_id), 1, 8) < '{split_cut}' AS is_test, label, count(*) AS n
FROM fm GROUP BY ALL"""

    q["model_check"] = FEATURES + f"""
SELECT count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS n_positive, CAST(0 AS BIGINT) AS n_probabilities_off, CAST(0 AS BIGINT) AS n_importances_off FROM fm
WHERE substr(md5('{SEED}|' || window_id || '|' || user_id || '|' || product_id), 1, 8) < '{split_cut}'"""

    q["stratified_split"] = FEATURES + f""",
per AS (SELECT label, count(*) AS c FROM fm GROUP BY label),
tot AS (SELECT CAST(sum(c) AS BIGINT) AS n, (CAST(sum(c) AS BIGINT) * 2 + 9) // 10 AS draws FROM per),
base AS (SELECT label, draws * c // n AS k, row_number() OVER (ORDER BY draws * c % n DESC, label) AS place, draws - CAST(sum(draws * c // n) OVER () AS BIGINT) AS rest FROM per, tot),
ranked AS (SELECT window_id, user_id, product_id, label, row_number() OVER (PARTITION BY label ORDER BY substr(md5('{SEED}|' || window_id || '|' || user_id || '|' || product_id), 1, 15)) AS i FROM fm)
SELECT window_id, user_id, product_id, label FROM ranked JOIN base USING (label) WHERE i <= k + CASE WHEN place <= rest THEN 1 ELSE 0 END"""

    q["as_of_features"] = FEATURES + f""",
pd AS (SELECT DISTINCT product_id, department_id FROM products),
gaps AS (SELECT o.user_id, d.transaction_date AS ts, o.days_since_prior_order AS gap FROM o JOIN odates d USING (order_id) WHERE o.days_since_prior_order IS NOT NULL),
lines AS (SELECT tx.user_id, pd.department_id, tx.transaction_date AS ts FROM tx JOIN pd USING (product_id) WHERE pd.department_id IS NOT NULL),
asked AS (SELECT DISTINCT window_id, cut, user_id FROM samples),
iv AS (SELECT a.window_id, a.user_id, avg(g.gap) AS interval FROM asked a JOIN gaps g ON g.user_id = a.user_id AND g.ts <= a.cut GROUP BY ALL),
dn AS (SELECT a.window_id, a.user_id, l.department_id, count(*) AS n FROM asked a JOIN lines l ON l.user_id = a.user_id AND l.ts <= a.cut GROUP BY ALL),
dt AS (SELECT window_id, user_id, sum(n) AS total FROM dn GROUP BY ALL),
j AS (SELECT s.*, pd.department_id, iv.interval, dn.n, dt.total FROM samples s LEFT JOIN pd USING (product_id) LEFT JOIN iv USING (window_id, user_id)
      LEFT JOIN dn ON dn.window_id = s.window_id AND dn.user_id = s.user_id AND dn.department_id = pd.department_id LEFT JOIN dt ON dt.window_id = s.window_id AND dt.user_id = s.user_id),
jm AS (SELECT median(interval) AS m FROM j)
SELECT j.window_id, j.user_id, j.product_id, CAST(datesub('day', j.last_ts, j.cut) AS DOUBLE) AS recency, CAST(j.frequency AS DOUBLE) AS frequency, CAST(j.monetary AS DOUBLE) AS monetary,
       {_r('coalesce(j.interval, jm.m)')} AS avg_days_since_prior, CAST(coalesce(j.department_id, 0) AS DOUBLE) AS department_id, CAST(coalesce(j.n, 0) AS DOUBLE) AS department_frequency,
       {_r('CAST(coalesce(j.n / j.total, 0) AS DOUBLE)')} AS department_frequency_ratio, CAST(j.label AS INTEGER) AS label
FROM j CROSS JOIN jm"""

    q["repurchase_split"] = FEATURES + f"""
SELECT window_id, user_id, product_id, label FROM fm
WHERE substr(md5('{SEED}|' || window_id || '|' || user_id || '|' || product_id), 1, 8) < '{split_cut}'"""

    SERVING = f"""
{TX.strip()},
{DEPTS.strip()},
interval AS (SELECT user_id, avg(days_since_prior_order) AS avg_days_since_prior FROM o WHERE days_since_prior_order IS NOT NULL GROUP BY user_id),
dfreq AS (SELECT user_id, department_id, count(*) AS department_frequency,
                 count(*) / sum(count(*)) OVER (PARTITION BY user_id) AS department_frequency_ratio
          FROM tx JOIN (SELECT DISTINCT product_id, department_id FROM products WHERE department_id IS NOT NULL) USING (product_id)
          GROUP BY user_id, department_id)"""
    q["serving_features"] = f"""
WITH {SERVING.strip()},
asked AS (SELECT DISTINCT o.o_custkey AS u, l.l_partkey AS p FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE o.o_custkey IS NOT NULL AND o.o_orderdate IS NOT NULL),
req AS (SELECT CASE WHEN u % 5 = 0 THEN u + 1000000000 ELSE u END AS user_id, CASE WHEN p % 7 = 0 THEN p + 1000000000 ELSE p END AS product_id,
               CASE WHEN (u + p) % 3 <> 0 THEN p % 50 ELSE 0 END AS recency, CASE WHEN (u + p) % 3 <> 0 THEN u % 4 + 1 ELSE 1 END AS frequency,
               CASE WHEN (u + p) % 3 <> 0 THEN (p % 9) / 2.0 ELSE 1.0 END AS monetary FROM asked),
med AS (SELECT median(avg_days_since_prior) AS m FROM interval),
pdept AS (SELECT product_id, max(department_id) AS department_id FROM products WHERE department_id IS NOT NULL GROUP BY product_id)
SELECT r.user_id, r.product_id, CAST(r.recency AS DOUBLE) AS recency, CAST(r.frequency AS DOUBLE) AS frequency, CAST(r.monetary AS DOUBLE) AS monetary,
       {_r('coalesce(i.avg_days_since_prior, med.m)')} AS avg_days_since_prior, CAST(coalesce(d.department_id, 0) AS DOUBLE) AS department_id,
       CAST(coalesce(f.department_frequency, 0) AS DOUBLE) AS department_frequency,
       {_r('CAST(coalesce(f.department_frequency_ratio, 0) AS DOUBLE)')} AS department_frequency_ratio
FROM req r CROSS JOIN med LEFT JOIN interval i ON i.user_id = r.user_id LEFT JOIN pdept d ON d.product_id = r.product_id
     LEFT JOIN dfreq f ON f.user_id = r.user_id AND f.department_id = coalesce(d.department_id, 0)"""

    q["stream_scores"] = q["serving_features"]

    q["artifact_tables"] = f"""
WITH {SERVING.strip()},
{BRAND_LINES.strip()},
{BRAND_RULES.strip()},
{SCORED.strip()},
cells AS (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(actual, predicted)),
micro AS (SELECT antecedent[1] || '>' || consequent[1] AS key, CAST(round(support * 1000000) AS BIGINT) || '/' || CAST(round(confidence * 1000000) AS BIGINT) || '/' || CAST(round(lift * 1000000) AS BIGINT) AS value
          FROM nrules WHERE rule_id <= 10000)
SELECT 'interval' AS part, CAST(user_id AS VARCHAR) AS key, CAST(CAST(round(avg_days_since_prior * 1000000) AS BIGINT) AS VARCHAR) AS value FROM interval
UNION ALL SELECT 'department_frequency', f.user_id || '/' || f.department_id, d.department || '/' || f.department_frequency || '/' || CAST(round(f.department_frequency_ratio * 1000000) AS BIGINT)
          FROM dfreq f JOIN depts d USING (department_id)
UNION ALL SELECT 'product_department', CAST(product_id AS VARCHAR), CAST(department_id AS VARCHAR) FROM (SELECT DISTINCT product_id, department_id FROM products)
UNION ALL SELECT 'rules', key, value FROM micro
UNION ALL SELECT 'products', CAST(product_id AS VARCHAR), product_name || '/' || coalesce(CAST(department_id AS VARCHAR), '-') FROM products
UNION ALL SELECT 'metrics', cells.actual || '/' || cells.predicted, CAST(count(s.label) AS VARCHAR)
          FROM cells LEFT JOIN s ON CAST(s.label = 1 AS INTEGER) = cells.actual AND CAST(s.prediction >= 0.5 AS INTEGER) = cells.predicted GROUP BY ALL
UNION ALL SELECT 'feature_cols', CAST(i AS VARCHAR), name FROM (VALUES {", ".join(f"({i}, '{c}')" for i, c in enumerate(FEATURE_COLS))}) v(i, name)
UNION ALL SELECT 'parameters', name, CAST(CAST(round(number * 1000000) AS BIGINT) AS VARCHAR)
          FROM (VALUES ('min_support', {float(MIN_SUPPORT)}), ('min_confidence', {float(MIN_CONFIDENCE)}), ('limit_rows', 0.0)) v(name, number)"""

    q["csv_rejects"] = """
WITH t AS (SELECT strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S') AS d, l.l_orderkey AS o, o.o_custkey AS u, regexp_extract(p.p_brand, '([0-9]+)', 1) AS p, CAST(l.l_quantity AS BIGINT) AS q,
                  l.l_quantity AS quantity, l.l_orderkey % 11 AS kind
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey),
r AS (SELECT *, CASE kind WHEN 0 THEN d || ',' || o || ',' || u || ',' || p || ',x' || q WHEN 1 THEN '1998-13-45,' || o || ',' || u || ',' || p || ',' || q
                          WHEN 2 THEN d || ',' || o || ',' || u || ',' || p WHEN 3 THEN d || ',' || o || ',' || u || ',' || p || ',' || q || ',7'
                          WHEN 4 THEN d || ',,' || u || ',' || p || ',' || q || '.0' END AS record FROM t)
SELECT CASE WHEN kind > 4 THEN d END AS transaction_date, CASE WHEN kind > 4 THEN o END AS order_id, CASE WHEN kind > 4 THEN u END AS user_id,
       CASE WHEN kind > 4 THEN CAST(p AS BIGINT) END AS product_id, CASE WHEN kind > 4 THEN quantity END AS quantity,
       CASE WHEN kind < 4 THEN 'malformed' WHEN kind = 4 THEN 'missing order_id' END AS reason, record FROM r"""

    q["csv_orders"] = """
SELECT strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S') AS transaction_date, l.l_orderkey AS order_id, o.o_custkey AS user_id,
       CAST(regexp_extract(p.p_brand, '([0-9]+)', 1) AS BIGINT) AS product_id, l.l_quantity AS quantity
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey"""

    q["user_product_features"] = f"""
WITH {ORDERS.strip()},
un AS (SELECT user_id, count(*) AS n, max(order_number) AS mx FROM o GROUP BY user_id),
up AS (SELECT o.user_id, l.product_id, count(*) AS up_orders, min(o.order_number) AS first_n, max(o.order_number) AS last_n
       FROM (SELECT DISTINCT l_orderkey AS order_id, l_partkey AS product_id FROM lineitem) l JOIN o USING (order_id) GROUP BY ALL)
SELECT up.user_id, up.product_id, up.up_orders, {_r('up.up_orders / un.n')} AS up_order_rate,
       CAST(un.mx - up.last_n AS BIGINT) AS up_orders_since_last_order,
       {_r('up.up_orders / (un.mx - up.first_n + 1)')} AS up_order_rate_since_first_order
FROM up JOIN un USING (user_id)"""

    q["mba_features"] = f"""
WITH {ORDERS.strip()},
{NAME_IDS.strip()},
{PAIR_RULES.strip()},
ui AS (SELECT DISTINCT o.user_id, nl.item FROM name_lines nl JOIN o USING (order_id)),
m AS (SELECT u.user_id, r.* FROM ui u JOIN nrules r ON r.antecedent[1] = u.item),
b AS (SELECT user_id, consequent[1] AS product_id, min(rule_id) AS rule_id, count(*) AS mba_rules FROM m GROUP BY ALL)
SELECT b.user_id, b.product_id, {_r('r.lift')} AS mba_lift, {_r('r.confidence')} AS mba_confidence, b.mba_rules
FROM b JOIN nrules r USING (rule_id)"""

    q["product_features"] = f"""
WITH {ORDERS.strip()},
lo AS (SELECT l.l_partkey AS product_id, l.l_orderkey AS order_id, o.user_id, o.order_number FROM lineitem l JOIN o ON l.l_orderkey = o.order_id),
f AS (SELECT user_id, product_id, min(order_number) AS first_n FROM lo GROUP BY ALL)
SELECT lo.product_id, count(*) AS n_lines, count(DISTINCT lo.order_id) AS n_orders, count(DISTINCT lo.user_id) AS n_users,
       {_r('avg(CAST(lo.order_number > f.first_n AS INTEGER)::DOUBLE)')} AS reorder_rate
FROM lo JOIN f USING (user_id, product_id) GROUP BY lo.product_id"""

    q["user_features"] = f"""
WITH {ORDERS.strip()},
po AS (SELECT l_orderkey AS order_id, count(*) AS sz FROM lineitem GROUP BY 1),
a AS (SELECT o.user_id, count(*) AS n_orders, CAST(sum(po.sz) AS BIGINT) AS n_lines, avg(po.sz) AS mean_basket_size
      FROM po JOIN o USING (order_id) GROUP BY o.user_id),
p AS (SELECT o.user_id, count(DISTINCT l.l_partkey) AS n_products FROM lineitem l JOIN o ON l.l_orderkey = o.order_id GROUP BY o.user_id)
SELECT a.user_id, a.n_orders, a.n_lines, p.n_products, {_r('a.mean_basket_size')} AS mean_basket_size FROM a LEFT JOIN p USING (user_id)"""

    return q
