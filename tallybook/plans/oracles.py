"""The expected result of each registered query as SQL over the same tables."""

from __future__ import annotations

_SOLD = """
    FROM lineitem
    JOIN part ON l_partkey = p_partkey
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey
"""

_PRICE = "CAST(l_extendedprice AS DECIMAL(18,6))"
_SHARE = "CAST(l_discount AS DECIMAL(6,4))"
_DISCOUNTED = f"CAST({_PRICE} * (CAST(1 AS DECIMAL(6,4)) - {_SHARE}) AS DECIMAL(18,6))"
_START = "strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ')"
_STOP = "l_shipdate + to_hours(CAST(l_quantity AS BIGINT))"
_END = f"strftime({_STOP}, '%Y-%m-%dT%H:%M:%SZ')"
_LINE_ID = "CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)"
_ARN = "'arn:aws:ec2:reserved-instances/ri-' || CAST(l_partkey AS VARCHAR)"

CUR = f"""cur AS (
    SELECT {_LINE_ID} AS line_item_id,
        {_START} || '/' || {_END} AS time_interval,
        'payer-' || CAST(n_regionkey AS VARCHAR) AS payer_account_id,
        CAST(l_suppkey AS VARCHAR) AS usage_account_id,
        CASE l_returnflag WHEN 'R' THEN 'DiscountedUsage' WHEN 'A' THEN 'Usage'
            ELSE 'SavingsPlanCoveredUsage' END AS line_item_type,
        {_START} AS usage_start,
        {_END} AS usage_end,
        p_type AS product_code,
        'BoxUsage:' || p_name AS usage_type,
        'RunInstances' AS operation,
        'i-' || CAST(l_orderkey AS VARCHAR) AS resource_id,
        CAST(l_quantity AS DECIMAL(24,6)) AS usage_amount,
        CASE WHEN l_returnflag = 'R' THEN CAST(0 AS DECIMAL(18,6)) ELSE {_DISCOUNTED} END AS unblended_cost,
        p_name AS instance_type,
        'region-' || CAST(n_regionkey AS VARCHAR) AS region,
        CASE l_returnflag WHEN 'R' THEN 'Reserved' WHEN 'A' THEN 'OnDemand'
            ELSE 'SavingsPlan' END AS pricing_term,
        {_PRICE} AS on_demand_cost,
        CASE WHEN l_returnflag = 'R' THEN {_DISCOUNTED} END AS reservation_effective_cost,
        CASE WHEN l_returnflag = 'R' THEN {_ARN} END AS reservation_arn,
        n_name AS tag_team,
        p_brand AS tag_cost_center,
        l_shipdate AS started_at,
        {_STOP} AS stopped_at
    {_SOLD}
    WHERE l_linestatus = 'O'
)"""

FEES = f"""fees AS (
    SELECT 'fee-' || CAST(l_partkey AS VARCHAR) AS line_item_id,
        '1995-01-01T00:00:00Z/2002-01-01T00:00:00Z' AS time_interval,
        'payer' AS payer_account_id,
        'payer' AS usage_account_id,
        'RIFee' AS line_item_type,
        '1995-01-01T00:00:00Z' AS usage_start,
        '2002-01-01T00:00:00Z' AS usage_end,
        'reservation' AS product_code,
        'HeavyUsage:' || CAST(l_partkey AS VARCHAR) AS usage_type,
        CAST(sum(CAST(l_quantity AS DECIMAL(24,6))) AS DECIMAL(24,6)) AS usage_amount,
        CAST(sum({_DISCOUNTED}) AS DECIMAL(18,6)) AS unblended_cost,
        {_ARN} AS reservation_arn
    FROM lineitem
    WHERE l_returnflag = 'R'
    GROUP BY l_partkey
)"""

GCP = f"""gcp AS (
    SELECT CAST(l_suppkey AS VARCHAR) AS project,
        s_name AS project_name,
        p_type AS service,
        CAST(l_partkey AS VARCHAR) AS sku,
        CASE p_type WHEN 'PROMO' THEN 'Commitment v1: ' || p_name WHEN 'SMALL' THEN p_name
            ELSE p_brand || ' Instance Core running in Americas' END AS sku_text,
        {_START} AS usage_start_time,
        {_END} AS usage_end_time,
        l_shipdate AS started_at,
        {_STOP} AS stopped_at,
        n_name AS team,
        p_brand AS cost_center,
        {_PRICE} AS cost,
        CASE WHEN n_regionkey = 3 THEN 'EUR' ELSE 'USD' END AS currency,
        CAST(CASE WHEN n_regionkey = 3 THEN '1.08' ELSE '1' END AS DECIMAL(10,6)) AS rate,
        CAST(l_quantity AS DECIMAL(18,6)) AS units,
        CAST(-({_PRICE} * {_SHARE}) AS DECIMAL(18,6)) AS credit,
        CASE WHEN {_SHARE} > 0.05 THEN 'COMMITTED_USAGE_DISCOUNT'
            WHEN {_SHARE} > 0 THEN 'SUSTAINED_USAGE_DISCOUNT' END AS credit_type,
        CAST({_PRICE} - CAST({_PRICE} * {_SHARE} AS DECIMAL(18,6)) AS DECIMAL(18,6)) AS net,
        CASE l_linenumber WHEN 7 THEN 'adjustment' WHEN 6 THEN 'tax' WHEN 5 THEN 'rounding_error'
            ELSE 'regular' END AS cost_type
    {_SOLD}
    WHERE l_linestatus = 'F'
)"""

CANONICAL = f"""{CUR}, {GCP}, canonical AS (
    SELECT 'AWS' AS provider, line_item_id AS line_id, usage_account_id AS account,
        product_code AS service, usage_type AS sku, instance_type AS machine,
        tag_team AS team, tag_cost_center AS cost_center,
        CASE line_item_type WHEN 'Usage' THEN 'usage' ELSE 'covered_usage' END AS charge_class,
        started_at AS usage_start, stopped_at AS usage_end,
        usage_amount, CAST(NULL AS VARCHAR) AS usage_unit,
        'USD' AS currency, CAST(1 AS DECIMAL(10,6)) AS rate,
        on_demand_cost AS list_cost, unblended_cost AS net_cost,
        coalesce(reservation_effective_cost, unblended_cost) AS effective_cost
    FROM cur
    UNION ALL
    SELECT 'GCP',
        sha256(CAST(length(project) AS VARCHAR) || ':' || project
            || CAST(length(sku) AS VARCHAR) || ':' || sku
            || CAST(length(usage_start_time) AS VARCHAR) || ':' || usage_start_time),
        project, service, sku_text,
        CASE WHEN sku_text LIKE '% Instance Core%' THEN cost_center END,
        team, cost_center,
        CASE cost_type WHEN 'tax' THEN 'tax' WHEN 'adjustment' THEN 'adjustment'
            WHEN 'rounding_error' THEN 'adjustment'
            ELSE CASE WHEN sku_text LIKE 'Commitment %' THEN 'fee' ELSE 'usage' END END,
        started_at, stopped_at,
        CAST(units AS DECIMAL(24,6)), 'hour', currency, rate, cost, net, net
    FROM gcp
)"""


def _base(column: str) -> str:
    return f"CAST(round(round(sum({column} * rate), 6), 6) AS DOUBLE)"


def _money(expression: str) -> str:
    return f"CAST(round({expression}, 6) AS DOUBLE)"


def _spend(keys: str, group: str) -> str:
    return f"""SELECT {keys}, count(*) AS line_count, {_base('list_cost')} AS list_cost,
        {_base('net_cost')} AS net_cost, {_base('effective_cost')} AS effective_cost
    FROM canonical GROUP BY {group}"""


_LINE_COLUMNS = (
    "l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_quantity, "
    "l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
)
_LINE_ORDER = (
    "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, "
    "l_tax, l_returnflag, l_linestatus, l_shipdate"
)

_FEED = f"""feed AS (
    SELECT {_LINE_COLUMNS}, row_number() OVER (ORDER BY {_LINE_ORDER}) - 1 AS position,
        count(*) OVER () AS size
    FROM lineitem
)"""


def _page(token: int, size: int) -> str:
    start = f"CASE WHEN {token} > size THEN 0 ELSE {token} END"
    return f"""WITH {_FEED}, wanted AS (SELECT *, {start} AS start FROM feed)
    SELECT * EXCLUDE (position, size, start),
        CASE WHEN start + {size} < size THEN CAST(start + {size} AS VARCHAR) END AS next_token
    FROM wanted WHERE position >= start AND position < start + {size}"""


_EVENT_COLUMNS = (
    "CAST(event_id AS VARCHAR) AS id, event_type AS aggregate_type, CAST(user_id AS VARCHAR) AS aggregate_id, "
    "event_type AS type, props AS payload, ts AS created_at"
)
_K = r"CAST(json_extract(props, '$.k') AS BIGINT)"
_ROUTED = f"""SELECT 'billing.events.' || event_type AS topic, CAST(user_id AS VARCHAR) AS key,
    CAST(event_id AS VARCHAR) AS id, event_type AS type, {_K} AS k, ts AS created_at FROM events"""

_CURSORS = """SELECT event_type AS source, arg_max(CAST(event_id AS VARCHAR),
        {'ts': ts, 'token': CAST(event_id AS VARCHAR)}) AS last_token, max(ts) AS updated_at
    FROM events GROUP BY event_type"""

_CREATED = "ts - to_minutes(CAST(trunc(value * 60) AS BIGINT))"
_AUDIT = f"""WITH arrivals AS (
        SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS key,
            {_CREATED} AS created_at, event_id AS arrival FROM events
    ), numbered AS (
        SELECT *, row_number() OVER (PARTITION BY key ORDER BY arrival) AS arrival_no,
            max(created_at) OVER (PARTITION BY key ORDER BY arrival
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest
        FROM arrivals
    )
    SELECT id, key, arrival_no, coalesce(created_at < newest, false) AS out_of_order,
        CASE WHEN created_at >= newest
            THEN (epoch_us(created_at) - epoch_us(newest)) // 1000 END AS gap_ms
    FROM numbered"""

_SHA_PART = "sha256(CAST(p_partkey AS VARCHAR))"


def _digest(*parts: str) -> str:
    return "sha256(" + " || ".join(f"CAST(length({p}) AS VARCHAR) || ':' || {p}" for p in parts) + ")"


_CHECK = "SELECT '{name}' AS check_name, {count} = 0 AS passed, CAST({count} AS BIGINT) AS violations FROM {table}"


def _every(name: str, condition: str, table: str = "items") -> str:
    count = f"count(*) FILTER (WHERE NOT coalesce({condition}, false))"
    return _CHECK.format(name=name, count=count, table=table)


def _some(name: str, condition: str, table: str = "items") -> str:
    count = f"(CASE WHEN count(*) FILTER (WHERE {condition}) > 0 THEN 0 ELSE 1 END)"
    return _CHECK.format(name=name, count=count, table=table)


def _unique(name: str, key: str, table: str) -> str:
    return _CHECK.format(name=name, count=f"(count(*) - count(DISTINCT {key}))", table=table)


_TYPES = ("Usage", "DiscountedUsage", "SavingsPlanCoveredUsage", "RIFee", "Tax", "Credit")
_ITEMS = f"""{CUR}, {FEES}, items AS (
    SELECT line_item_id, line_item_type, unblended_cost, tag_team, reservation_effective_cost FROM cur
    UNION ALL
    SELECT line_item_id, line_item_type, unblended_cost, NULL, NULL FROM fees
), box AS (SELECT {_EVENT_COLUMNS} FROM events)"""
_TABLE_CHECKS = [
    _every("line_item_type_known", f"line_item_type IN {_TYPES}"),
    _every("id_not_blank", "trim(line_item_id) <> ''"),
    _every("reserved_costs_nothing", "line_item_type <> 'DiscountedUsage' OR unblended_cost = 0"),
    _every("fee_has_no_team", "line_item_type <> 'RIFee' OR tag_team IS NULL"),
    _every("effective_cost_positive", "reservation_effective_cost > 0"),
    *(_some(f"line_item_type_has_{t}", f"line_item_type = '{t}'") for t in _TYPES),
    _some("any_free_row", "unblended_cost = 0"),
    *(
        _every(f"outbox_{c}_present", f"{c} IS NOT NULL", "box")
        for c in ("id", "aggregate_type", "aggregate_id", "type", "payload", "created_at")
    ),
    *(
        _every(f"outbox_{c}_fits", f"coalesce(length({c}) <= 255, true)", "box")
        for c in ("aggregate_type", "aggregate_id", "type")
    ),
    _unique("line_item_id_unique", "line_item_id", "items"),
    _unique("event_id_unique", "id", "box"),
]

_JSON_ITEM = """line_item_id, time_interval, payer_account_id, usage_account_id, line_item_type,
    usage_start, usage_end, product_code, usage_type, operation, resource_id,
    CAST(round(usage_amount, 6) AS DOUBLE) AS usage_amount,
    CAST(round(unblended_cost, 6) AS DOUBLE) AS unblended_cost, instance_type, region, pricing_term,
    CAST(round(on_demand_cost, 6) AS DOUBLE) AS on_demand_cost,
    CAST(round(reservation_effective_cost, 6) AS DOUBLE) AS reservation_effective_cost,
    reservation_arn, tag_team, tag_cost_center"""

_BACK_AT = "ts + to_microseconds(CAST(CAST(value AS DECIMAL(18,6)) / 2 * 1000000 AS BIGINT))"

_PART = "CAST(floor(event_id * 4 / (SELECT max(event_id) + 1 FROM events)) AS BIGINT)"

ORACLES: dict[str, str] = {
    "net_cost_by_team": f"""WITH {GCP}
        SELECT team, count(*) AS line_count, {_money('sum(cost * rate)')} AS cost_base,
            {_money('sum(credit * rate)')} AS credit_base, {_money('sum(net * rate)')} AS net_base
        FROM gcp GROUP BY team""",
    "effective_cost_by_type": f"""WITH {CUR}, {FEES}, items AS (
            SELECT line_item_type, unblended_cost, reservation_effective_cost FROM cur
            UNION ALL SELECT line_item_type, unblended_cost, NULL FROM fees)
        SELECT CASE line_item_type WHEN 'Usage' THEN 'usage' WHEN 'RIFee' THEN 'fee'
                ELSE 'covered_usage' END AS charge_class,
            count(*) AS line_count, {_money('sum(unblended_cost)')} AS cash_cost,
            {_money('''sum(CASE line_item_type WHEN 'RIFee' THEN 0
                WHEN 'DiscountedUsage' THEN reservation_effective_cost ELSE unblended_cost END)''')}
                AS amortised_cost
        FROM items GROUP BY 1""",
    "gcp_charge_classes": f"WITH {CANONICAL} " + _spend("charge_class", "charge_class").replace(
        "FROM canonical", "FROM canonical WHERE provider = 'GCP'"
    ),
    "canonical_spend_daily": f"WITH {CANONICAL} "
    + _spend(
        """provider, CASE provider WHEN 'AWS' THEN 'Amazon Web Services' ELSE 'Google Cloud Platform' END
            AS provider_name, account, team, date_trunc('day', usage_start) AS day""",
        "provider, account, team, date_trunc('day', usage_start)",
    ).replace("date_trunc('day', usage_start) AS day", "CAST(date_trunc('day', usage_start) AS TIMESTAMP) AS day"),
    "spend_by_hour": f"WITH {CANONICAL} "
    + _spend(
        "provider, CAST(date_trunc('hour', usage_start) AS TIMESTAMP) AS hour",
        "provider, date_trunc('hour', usage_start)",
    ),
    "spend_by_account": f"WITH {CANONICAL} " + _spend("provider, account, team", "provider, account, team"),
    "canonical_rows": f"""WITH {CANONICAL}
        SELECT * REPLACE ({_money('usage_amount')} AS usage_amount, {_money('rate')} AS rate,
            {_money('list_cost')} AS list_cost, {_money('net_cost')} AS net_cost,
            {_money('effective_cost')} AS effective_cost)
        FROM canonical""",
    "credit_types": f"""WITH {GCP}
        SELECT credit_type, count(*) AS credits, {_money('sum(credit)')} AS amount
        FROM gcp WHERE credit_type IS NOT NULL GROUP BY credit_type""",
    "credit_coverage": f"""WITH {GCP}
        SELECT team, count(*) FILTER (WHERE credit_type = 'COMMITTED_USAGE_DISCOUNT') AS committed_rows,
            count(*) FILTER (WHERE credit_type IS NULL) AS bare_rows
        FROM gcp GROUP BY team""",
    "covered_vs_on_demand": f"""WITH {GCP}, split AS (
            SELECT sku, net * rate AS net, units, credit_type IS NULL AS bare,
                coalesce(credit_type = 'COMMITTED_USAGE_DISCOUNT', false) AS committed FROM gcp
        ), sums AS (
            SELECT sku, count(*) FILTER (WHERE committed) AS covered_rows,
                count(*) FILTER (WHERE bare) AS on_demand_rows,
                sum(net) FILTER (WHERE committed) AS covered_net,
                sum(net) FILTER (WHERE bare) AS on_demand_net,
                sum(units) FILTER (WHERE committed) AS covered_units,
                sum(units) FILTER (WHERE bare) AS on_demand_units
            FROM split GROUP BY sku
        )
        SELECT sku, covered_rows, on_demand_rows,
            CAST(round(round(covered_net, 6), 6) AS DOUBLE) AS covered_net,
            CAST(round(round(on_demand_net, 6), 6) AS DOUBLE) AS on_demand_net,
            CAST(round(covered_net, 6) AS DOUBLE) / CAST(covered_units AS DOUBLE) AS covered_unit_cost,
            CAST(round(on_demand_net, 6) AS DOUBLE) / CAST(on_demand_units AS DOUBLE) AS on_demand_unit_cost
        FROM sums WHERE covered_rows > 0 AND on_demand_rows > 0""",
    "team_coverage_gap": f"""WITH {CANONICAL}, sums AS (
            SELECT sku, round(sum(net_cost * rate) FILTER (WHERE team = 'NATION_1'), 6) AS covered_net,
                round(sum(net_cost * rate) FILTER (WHERE team = 'NATION_2'), 6) AS on_demand_net
            FROM canonical WHERE provider = 'GCP' GROUP BY sku
        )
        SELECT sku, {_money('covered_net')} AS covered_net, {_money('on_demand_net')} AS on_demand_net,
            {_money('on_demand_net - covered_net')} AS gap
        FROM sums WHERE covered_net IS NOT NULL AND on_demand_net IS NOT NULL""",
    "reservation_utilisation": f"""WITH {CUR}, {FEES}, used AS (
            SELECT reservation_arn, sum(usage_amount) AS used_hours, sum(reservation_effective_cost) AS used_cost
            FROM cur WHERE line_item_type = 'DiscountedUsage' GROUP BY reservation_arn
        ), bought AS (
            SELECT reservation_arn, sum(usage_amount) AS fee_hours, sum(unblended_cost) AS fee
            FROM fees GROUP BY reservation_arn
        )
        SELECT reservation_arn, regexp_extract(reservation_arn, '/(ri-[^/]+)$', 1) AS reservation_id,
            {_money('used_hours')} AS used_hours, {_money('used_cost')} AS used_cost,
            {_money('fee_hours')} AS fee_hours, {_money('fee')} AS fee,
            CAST(coalesce(used_hours, 0) AS DOUBLE) / CAST(fee_hours AS DOUBLE) AS utilisation,
            {_money('fee - coalesce(used_cost, 0)')} AS unused_cost
        FROM bought FULL JOIN used USING (reservation_arn)""",
    "reservation_by_period": f"""WITH {CUR}, {FEES}, numbered AS (
            SELECT *, CAST(regexp_extract(reservation_arn, '([0-9]+)$', 1) AS BIGINT) AS part FROM fees
        ), periods AS (
            SELECT line_item_id || '-a' AS fee_id, reservation_arn, TIMESTAMP '1995-01-01' AS starts,
                TIMESTAMP '1998-03-01' + to_hours(31 * part % 977) AS ends, usage_amount, unblended_cost FROM numbered
            UNION ALL SELECT line_item_id || '-b', reservation_arn, TIMESTAMP '1998-02-01' + to_hours(17 * part % 977),
                TIMESTAMP '2002-01-01', usage_amount, unblended_cost FROM numbered
        ), used AS (
            SELECT reservation_arn, CAST(epoch(started_at) AS BIGINT) AS s, CAST(epoch(stopped_at) AS BIGINT) AS e,
                CAST(usage_amount * 1000000 AS HUGEINT) AS h, CAST(reservation_effective_cost * 1000000 AS HUGEINT) AS c
            FROM cur WHERE line_item_type = 'DiscountedUsage'
        ), sums AS (
            SELECT fee_id, count(*) AS n, sum(h * b // w - h * a // w) AS h, sum(c * b // w - c * a // w) AS c FROM (
                SELECT fee_id, h, c, e - s AS w, least(e, CAST(epoch(ends) AS BIGINT)) - s AS b,
                    greatest(s, CAST(epoch(starts) AS BIGINT)) - s AS a
                FROM used JOIN periods USING (reservation_arn)
                WHERE greatest(s, CAST(epoch(starts) AS BIGINT)) < least(e, CAST(epoch(ends) AS BIGINT))
            ) GROUP BY fee_id
        )
        SELECT fee_id, reservation_arn, strftime(starts, '%Y-%m-%dT%H:%M:%SZ') AS period_start,
            strftime(ends, '%Y-%m-%dT%H:%M:%SZ') AS period_end, coalesce(n, 0) AS usage_rows,
            {_money("CAST(coalesce(h, 0) AS DECIMAL(32,6)) / 1000000")} AS used_hours,
            {_money("CAST(coalesce(c, 0) AS DECIMAL(32,6)) / 1000000")} AS used_cost,
            {_money('usage_amount')} AS fee_hours, {_money('unblended_cost')} AS fee,
            {_money("CAST(coalesce(h, 0) AS DECIMAL(32,6)) / 1000000")} / CAST(usage_amount AS DOUBLE) AS utilisation
        FROM periods LEFT JOIN sums USING (fee_id)""",
    "apportioned_spend": f"""WITH {CANONICAL}, whole AS (
            SELECT row_number() OVER () AS row, provider, rate, CAST(epoch(usage_start) AS BIGINT) AS s,
                CAST(epoch(usage_end) AS BIGINT) AS e, CAST(abs(net_cost) * 1000000 AS HUGEINT) AS units,
                CAST(sign(net_cost) AS INTEGER) AS sign FROM canonical
        ), parts AS (
            SELECT *, unnest(range(s - s % 86400, e, 86400)) AS t FROM whole
        ), shares AS (
            SELECT *, units * (least(e, t + 86400) - greatest(s, t)) // (e - s) AS f,
                units * (least(e, t + 86400) - greatest(s, t)) % (e - s) AS r FROM parts
        ), given AS (
            SELECT *, f + CASE WHEN row_number() OVER (PARTITION BY row ORDER BY r DESC, t)
                <= units - sum(f) OVER (PARTITION BY row) THEN 1 ELSE 0 END AS part FROM shares
        )
        SELECT provider, CAST(to_timestamp(t) AT TIME ZONE 'UTC' AS TIMESTAMP) AS day, count(*) AS parts,
            {_base('CAST(sign * part * CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(18,6))')} AS net_cost
        FROM given GROUP BY provider, t""",
    "restated_spend": f"WITH {CANONICAL}, restated AS (SELECT * REPLACE (CASE charge_class WHEN 'adjustment' "
    "THEN CAST(net_cost * 2 AS DECIMAL(18,6)) ELSE net_cost END AS net_cost) FROM canonical WHERE charge_class <> 'tax') "
    + _spend(
        "provider, account, CAST(date_trunc('day', usage_start) AS TIMESTAMP) AS day",
        "provider, account, date_trunc('day', usage_start)",
    ).replace("FROM canonical", "FROM restated"),
    "non_base_currency": f"""WITH {GCP}
        SELECT currency, team, count(*) AS line_count, {_money('sum(net)')} AS net_local,
            {_base('net')} AS net_base
        FROM gcp WHERE currency <> 'USD' GROUP BY currency, team""",
    "machine_families": f"""WITH {CANONICAL}
        SELECT provider, machine, usage_unit, count(*) AS line_count,
            {_money('sum(usage_amount)')} AS usage_amount
        FROM canonical GROUP BY provider, machine, usage_unit""",
    "usage_windows": f"""WITH {CUR}
        SELECT line_item_id, started_at AS window_start, stopped_at AS window_end,
            CAST(usage_amount * 3600 AS BIGINT) AS window_seconds
        FROM cur""",
    "line_item_types": f"""WITH {CUR}, {FEES}
        SELECT line_item_type FROM cur UNION SELECT line_item_type FROM fees""",
    "commitment_names": f"""
        SELECT p_partkey, 'ri-' || substr({_SHA_PART}, 1, 12) AS reservation,
            'projects/' || p_brand || '/regions/' || p_type || '/commitments/cud-'
                || substr({_SHA_PART}, 1, 8) AS commitment,
            'ri-' || substr({_SHA_PART}, 1, 12) AS parsed_reservation,
            'cud-' || substr({_SHA_PART}, 1, 8) AS parsed_commitment,
            p_brand AS parsed_project
        FROM part""",
    "feed_pages": f"""WITH {_FEED}
        SELECT * EXCLUDE (position, size), position // 5 AS page, position % 5 AS page_row FROM feed""",
    "feed_page_sizes": """WITH counted AS (
            SELECT page, least(5, size - page * 5) AS page_rows, size FROM (
                SELECT unnest(range(0, CAST(ceil(size / 5.0) AS BIGINT))) AS page, size
                FROM (SELECT count(*) AS size FROM lineitem)))
        SELECT page, page_rows, CASE WHEN (page + 1) * 5 < size
            THEN CAST((page + 1) * 5 AS VARCHAR) END AS next_token FROM counted""",
    "feed_page_n": _page(15, 5),
    "feed_page_deep": _page(5995, 4),
    "page_walk_check": """SELECT count(*) AS walked_rows, CAST(ceil(count(*) / 5.0) AS BIGINT) AS pages,
            CAST(0 AS BIGINT) AS differing_keys FROM lineitem""",
    "page_walk_faults": """WITH numbered AS (
            SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
                l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 AS place FROM lineitem
        ), walked AS (
            SELECT * FROM numbered WHERE place % 5 < 4
            UNION ALL SELECT * FROM numbered WHERE place % 5 < 4 AND (place // 5) % 3 = 0
        ), keys AS (
            SELECT * EXCLUDE (place, w, h), sum(w) AS walked, sum(h) AS held FROM (
                SELECT *, 1 AS w, 0 AS h FROM walked UNION ALL SELECT *, 0, 1 FROM numbered) GROUP BY ALL
        )
        SELECT (SELECT count(*) FROM walked) AS walked_rows, (SELECT max(place) // 5 + 1 FROM walked) AS pages,
            (SELECT count(*) FROM keys WHERE walked <> held) AS differing_keys""",
    "line_item_pages": f"""WITH {CUR}, numbered AS (
            SELECT *, row_number() OVER (ORDER BY line_item_id, time_interval, payer_account_id,
                usage_account_id, line_item_type, usage_start, usage_end, product_code, usage_type,
                operation, resource_id, usage_amount, unblended_cost, instance_type, region,
                pricing_term, on_demand_cost, reservation_effective_cost NULLS FIRST) - 1 AS place,
                count(*) OVER () AS size
            FROM cur)
        SELECT (SELECT substr(max(usage_start), 1, 7) FROM cur) AS "billingPeriod",
            CASE WHEN (place // 5 + 1) * 5 < size THEN CAST((place // 5 + 1) * 5 AS VARCHAR) END AS "nextToken",
            place % 5 AS position, line_item_id, line_item_type, {_money('unblended_cost')} AS unblended_cost,
            {_money('reservation_effective_cost')} AS reservation_effective_cost, tag_team
        FROM numbered""",
    "billing_row_pages": f"""WITH {GCP}, numbered AS (
            SELECT *, row_number() OVER (ORDER BY project, sku, usage_start_time, cost) - 1 AS place,
                count(*) OVER () AS size FROM gcp)
        SELECT project, (place // 4 + 1) * 4 >= size AS last_page, count(*) AS line_count,
            count(*) FILTER (WHERE credit_type IS NULL) AS bare_rows, {_money('sum(net)')} AS net_cost
        FROM numbered GROUP BY 1, 2""",
    "token_decode": r"""WITH tokens AS (
            SELECT event_id, (SELECT count(*) FROM events) - 100 AS size,
                CASE event_type WHEN 'view' THEN CAST(event_id AS VARCHAR)
                    WHEN 'click' THEN ' +' || CAST(event_id AS VARCHAR) || ' '
                    WHEN 'error' THEN '-' || CAST(event_id AS VARCHAR)
                    WHEN 'signup' THEN CAST(event_id AS VARCHAR) || '.5'
                    ELSE CASE WHEN value > 10 THEN CAST(event_id AS VARCHAR) || '99999999999'
                        WHEN value > 5 THEN '  ' END END AS token
            FROM events
        ), numbers AS (
            SELECT *, CASE WHEN regexp_matches(trim(token), '^[+-]?[0-9]+$')
                THEN try_cast(trim(token) AS BIGINT) END AS number FROM tokens
        )
        SELECT event_id, coalesce(token, 'none') AS token,
            CASE WHEN number BETWEEN 0 AND size THEN number ELSE 0 END AS position
        FROM numbers""",
    "json_roundtrip": f"""WITH {CUR}, {FEES}
        SELECT CASE WHEN line_item_type = 'DiscountedUsage' THEN 21 ELSE 19 END AS key_count, {_JSON_ITEM} FROM cur
        UNION ALL
        SELECT 12, line_item_id, time_interval, payer_account_id, usage_account_id, line_item_type,
            usage_start, usage_end, product_code, usage_type, NULL, NULL,
            {_money('usage_amount')}, {_money('unblended_cost')}, NULL, NULL, NULL, NULL, NULL,
            reservation_arn, NULL, NULL
        FROM fees""",
    "landed_line_items": f"WITH {CUR} SELECT {_JSON_ITEM} FROM cur",
    "landed_billing_rows": f"""WITH {GCP}
        SELECT project, project_name, service, sku, sku_text, usage_start_time, usage_end_time,
            {_money('cost')} AS cost, currency, cost_type, {_money('units * 3600')} AS raw_amount,
            2 AS label_count, CASE WHEN credit_type IS NULL THEN 0 ELSE 1 END AS credit_count
        FROM gcp""",
    "dedup_line_items": f"""SELECT * EXCLUDE (rank) FROM (
            SELECT {_LINE_COLUMNS}, {_LINE_ID} AS line_item_id,
                row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}) AS rank
            FROM lineitem) WHERE rank = 1""",
    "repeated_line_items": f"""SELECT {_LINE_ID} AS line_item_id, count(*) AS copies
        FROM lineitem GROUP BY 1 HAVING count(*) > 1""",
    "seen_anti_join": f"""WITH items AS (SELECT {_LINE_COLUMNS}, {_LINE_ID} AS line_item_id FROM lineitem)
        SELECT * FROM items
        WHERE line_item_id NOT IN (SELECT line_item_id FROM items WHERE l_returnflag = 'R')""",
    "cursor_latest": _CURSORS,
    "cursor_lookup": f"""SELECT {_EVENT_COLUMNS} FROM events
        WHERE CAST(event_id AS VARCHAR) IN (SELECT last_token FROM ({_CURSORS}))""",
    "resume_after_token": "SELECT * FROM events WHERE event_id > (SELECT max(event_id) // 2 FROM events)",
    "outbox_routed": _ROUTED,
    "payload_variant": f"""SELECT CAST(event_id AS VARCHAR) AS id, {_K} AS k, CAST(NULL AS VARCHAR) AS missing
        FROM events""",
    "topic_leakage": """SELECT CAST(event_id AS VARCHAR) AS id, 'billing.events.error' AS first_topic,
            'billing.events.signup' AS last_topic
        FROM events WHERE event_type = 'error' AND value > 20""",
    "outbox_ordered": """SELECT CAST(user_id AS VARCHAR) AS aggregate_id,
            row_number() OVER (PARTITION BY user_id ORDER BY ts, CAST(event_id AS VARCHAR)) AS sequence,
            CAST(event_id AS VARCHAR) AS id, ts AS created_at
        FROM events""",
    "creation_order": "SELECT CAST(event_id AS VARCHAR) AS id, ts AS created_at FROM events ORDER BY ts, id",
    "retention_kept": f"SELECT {_EVENT_COLUMNS} FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'",
    "retention_by_date": f"SELECT {_EVENT_COLUMNS} FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'",
    "cdc_capture": """SELECT CAST(event_id AS VARCHAR) AS id,
            CASE WHEN ts < TIMESTAMP '2024-01-20' THEN 'r' ELSE 'c' END AS op,
            event_type AS type, props AS payload, ts AS created_at
        FROM events
        WHERE event_type <> 'signup' AND (ts < TIMESTAMP '2024-01-20' OR event_type <> 'error')""",
    "state_events": f"""WITH rows AS (
            SELECT 'order' AS aggregate_type, CAST(o_orderkey AS VARCHAR) AS aggregate_id,
                'OrderStatus' || o_orderstatus AS type,
                '{{"o_custkey":' || CAST(o_custkey AS VARCHAR) || ',"o_orderpriority":"' || o_orderpriority
                    || '"}}' AS payload,
                o_orderdate AS created_at
            FROM orders)
        SELECT {_digest('aggregate_type', 'aggregate_id', 'type', 'CAST(epoch_us(created_at) AS VARCHAR)', 'payload')}
            AS id, * FROM rows""",
    "marker_events": f"""SELECT {_EVENT_COLUMNS} FROM events
        WHERE event_type = 'click' AND contains(props, '"k": 7')""",
    "first_marker_event": f"""SELECT {_EVENT_COLUMNS} FROM events WHERE contains(props, '"k": 7')
        ORDER BY ts, CAST(event_id AS VARCHAR) LIMIT 1""",
    "round_trip": """WITH trips AS (
            SELECT user_id, ts AS published_at, event_id, (
                SELECT min(c.ts) FROM events c WHERE c.event_type = 'click' AND c.user_id = p.user_id
                    AND c.ts >= p.ts AND c.ts <= p.ts + INTERVAL 1 HOUR) AS consumed_at
            FROM events p WHERE event_type = 'view')
        SELECT *, (epoch_us(consumed_at) - epoch_us(published_at)) // 1000 AS latency_ms,
            consumed_at IS NULL AS timed_out FROM trips""",
    "sequence_audit": _AUDIT,
    "quarantine_rows": f"""SELECT CAST(event_id AS VARCHAR) AS id,
            event_type IN ('error', 'signup') AS quarantined,
            CASE WHEN event_type NOT IN ('error', 'signup') THEN {_K} END AS k,
            CASE event_type WHEN 'error' THEN substr(props, 1, length(props) - 1)
                WHEN 'signup' THEN '{{"k": "many"}}' END AS payload
        FROM events""",
    "table_checks": f"WITH {_ITEMS} " + " UNION ALL ".join(_TABLE_CHECKS),
    "spend_windows": f"""SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS window_start,
            CAST(date_trunc('hour', ts) AS TIMESTAMP) + INTERVAL 1 HOUR AS window_end, event_type,
            count(*) AS row_count, {_money('sum(CAST(value AS DECIMAL(18,6)))')} AS total
        FROM events GROUP BY 1, 2, 3""",
    "stream_route_dedup": _ROUTED,
    "stream_outbox_commit": f"""WITH parts AS (SELECT *, {_PART} AS batch_id FROM events)
        SELECT 'state' AS output, CAST(user_id AS VARCHAR) AS key, CAST(max(event_id) AS VARCHAR) AS value, batch_id
        FROM parts GROUP BY user_id, batch_id
        UNION ALL SELECT 'events', CAST(event_id AS VARCHAR), props, batch_id FROM parts""",
    "stream_replay": "SELECT * FROM events",
    "stream_dedup_exact": f"SELECT {_EVENT_COLUMNS} FROM events",
    "late_rows": f"""WITH parts AS (SELECT event_id, ts, 3 - {_PART} AS batch_id FROM events),
        newest AS (SELECT b.n AS batch_id, max(p.ts) AS newest
            FROM (VALUES (1), (2), (3)) b(n) JOIN parts p ON p.batch_id < b.n GROUP BY b.n)
        SELECT event_id, batch_id,
            CASE WHEN ts < newest - INTERVAL 10 DAY THEN 'late' ELSE 'rows' END AS output
        FROM parts LEFT JOIN newest USING (batch_id)""",
    "resume_from_cursor": """WITH half AS (SELECT * FROM events WHERE event_type <> 'error' AND event_id % 3 <> 0),
        cursor AS (SELECT event_type, max(event_id) AS token FROM half
            WHERE event_id <= (SELECT max(event_id) FROM half) / 2.0 GROUP BY event_type)
        SELECT e.* FROM events e LEFT JOIN cursor c USING (event_type) WHERE token IS NULL OR event_id > token""",
    "log_order_per_key": """SELECT 'billing.events.' || event_type AS topic, count(*) AS entries,
            CAST(0 AS BIGINT) AS out_of_order
        FROM events GROUP BY event_type""",
    "stream_log_order": f"""WITH placed AS (
            SELECT *, max(ts) OVER (PARTITION BY event_type, user_id ORDER BY 3 - {_PART}, ts, CAST(event_id AS VARCHAR)
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > ts AS behind FROM events)
        SELECT 'billing.events.' || event_type AS topic, count(*) AS entries, CAST(0 AS BIGINT) AS out_of_order,
            CAST(0 AS BIGINT) AS misplaced, count(*) FILTER (WHERE behind) AS behind_later
        FROM placed GROUP BY event_type""",
    "stream_ingest": """SELECT event_type AS source, CAST(arg_max(event_id, {'ts': ts, 'token': event_id})
            AS VARCHAR) AS last_token, max(ts) AS updated_at
        FROM events GROUP BY event_type""",
    "stream_sequence": _AUDIT,
    "stream_capture": """SELECT CAST(event_id AS VARCHAR) AS id,
            CASE WHEN ts < TIMESTAMP '2024-01-20' THEN 'r' ELSE 'c' END AS op,
            event_type AS type, props AS payload, ts AS created_at
        FROM events
        WHERE event_type <> 'signup' AND (ts < TIMESTAMP '2024-01-20' OR event_type <> 'error')""",
    "stream_round_trip": f"""WITH trips AS (
            SELECT CASE WHEN event_type <> 'purchase' THEN CAST(event_id AS VARCHAR) END AS id, ts AS published_at,
                event_id AS number,
                CASE WHEN event_type NOT IN ('error', 'purchase') AND {_BACK_AT} <= ts + INTERVAL 5 SECOND
                    THEN {_BACK_AT} END AS consumed_at
            FROM events)
        SELECT *, (epoch_us(consumed_at) - epoch_us(published_at)) // 1000 AS latency_ms,
            consumed_at IS NULL AS timed_out FROM trips""",
}
ORACLES["stream_pages"] = ORACLES["line_item_pages"]
