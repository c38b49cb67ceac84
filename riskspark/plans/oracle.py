"""DuckDB SQL text of the fixture views (FIXTURES.md part B) for the correctness gate.

``with_ctes(body, "decision_log")`` prepends the needed views (dependencies
resolved in order) to an oracle query.  These texts are independent of the
Spark code in ``sources/fixtures.py`` and ``operators/``: the gate compares the
two engines on the same parquet tables.
"""

from __future__ import annotations

from .. import constants as C

_Q = lambda xs: ", ".join(f"'{x}'" for x in xs)

_COUNTRIES12 = "['US','GB','CA','DE','IN','BR','SG','AU','FR','JP','NG','ZZ']"
_COUNTRIES11 = "['US','GB','CA','DE','IN','BR','SG','AU','FR','JP','NG']"
_CURRENCY_CASE = "CASE country " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in C.COUNTRY_CURRENCY.items()) + " END"

CTES: dict[str, tuple[str, list[str]]] = {}

CTES["txn0"] = (f"""
SELECT CAST(event_id AS VARCHAR) AS event_id,
       event_id AS eid,
       CASE WHEN event_id % 71 = 0 THEN 'txn.updated' ELSE 'txn.created' END AS event_type,
       make_timestamp(1704067200000000 + (epoch_us(ts) - 1704067200000000) // 120) AS event_ts,
       user_id,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS merchant_id,
       event_id % 97 AS device_id,
       event_id % 61 AS ip_id,
       round(CASE WHEN event_id % 23 = 0 THEN value * 50 ELSE value END, 2) AS amount,
       list_extract({_COUNTRIES12}, CAST(event_id % 12 AS INTEGER) + 1) AS country,
       CASE WHEN event_id % 50 = 0 THEN 'kiosk' WHEN event_id % 2 = 0 THEN 'mobile' ELSE 'web' END AS channel,
       CAST(CASE WHEN ts >= TIMESTAMP '2024-01-20 00:00:00' THEN 1 ELSE 0 END AS INTEGER) AS drift_phase,
       list_extract({_COUNTRIES11}, CAST(user_id % 11 AS INTEGER) + 1) AS home_country,
       CAST(event_id % 19 = 0 AS INTEGER) AS is_new_device,
       CAST(event_id % 29 = 0 AS INTEGER) AS is_new_ip
FROM events""", [])

CTES["txn"] = (f"""
SELECT event_id, eid, event_type, event_ts, user_id, merchant_id, device_id, ip_id, amount, country,
       channel, drift_phase, home_country, is_new_device, is_new_ip,
       CASE WHEN eid % 3 = 0 THEN '{{"is_fraud":' || CAST(CAST(amount >= 500 AS INTEGER) AS VARCHAR) || '}}'
            WHEN eid % 3 = 1 THEN '{{"label":' || CAST(CAST(amount >= 500 AS INTEGER) AS VARCHAR) || '}}'
            ELSE '{{}}' END AS payload,
       {_CURRENCY_CASE} AS currency,
       CAST(country <> home_country AS INTEGER) AS geo_mismatch,
       event_ts + INTERVAL 2 SECOND AS validated_at
FROM txn0""", ["txn0"])

CTES["txn_raw"] = ("""
SELECT * FROM txn
UNION ALL
SELECT * REPLACE (validated_at + INTERVAL 1 SECOND AS validated_at) FROM txn WHERE eid % 41 = 0""", ["txn"])

def suite_conditions(regex_fail: str, int_fail: dict | None = None) -> list[tuple[str, str, str]]:
    """(expectation name, column, SQL 'fails' condition) in suite order; nulls never fail values."""
    out = [("expect_column_values_to_not_be_null", c, f"{c} IS NULL") for c in C.REQUIRED_COLUMNS]
    out.append(("expect_column_values_to_be_between", "amount",
                f"coalesce(amount < CAST({C.AMOUNT_MIN} AS DOUBLE) OR amount > CAST({C.AMOUNT_MAX} AS DOUBLE), false)"))
    out.append(("expect_column_values_to_be_in_set", "country", f"coalesce(country NOT IN ({_Q(C.COUNTRIES)}), false)"))
    out.append(("expect_column_values_to_be_in_set", "currency", f"coalesce(currency NOT IN ({_Q(C.CURRENCIES)}), false)"))
    out.append(("expect_column_values_to_be_in_set", "channel", f"coalesce(channel NOT IN ({_Q(C.CHANNELS)}), false)"))
    out.append(("expect_column_values_to_be_in_set", "event_type",
                f"coalesce(event_type NOT IN ({_Q(C.EVENT_TYPES)}), false)"))
    out.append(("expect_column_values_to_be_in_set", "drift_phase", "coalesce(drift_phase NOT IN (0, 1), false)"))
    for c in C.ID_COLUMNS:
        out.append(("expect_column_values_to_be_between", c, f"coalesce({c} < 0, false)"))
        if int_fail is not None:
            out.append(("expect_column_values_to_be_of_type", c, int_fail.get(c, "false")))
    out.append(("expect_column_values_to_match_regex", "event_ts", regex_fail))
    return out


TYPED_REGEX_FAIL = ("coalesce(NOT regexp_matches(strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%fZ'), "
                    "'^\\d{4}-\\d{2}-\\d{2}T.*Z$'), false)")


def failed_list_sql(conds) -> str:
    items = ",\n    ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, _, cond in conds)
    return f"list_filter([\n    {items}\n  ], lambda x: x IS NOT NULL)"


CTES["txn_flags"] = (f"""
SELECT *, {failed_list_sql(suite_conditions(TYPED_REGEX_FAIL))} AS failed_raw
FROM txn""", ["txn"])

# Raw messages (B5): breakage class by priority, then the typed values a parser would see.
_BRK = " ".join(f"WHEN eid % {m} = 0 THEN '{k}'" for m, k in
                [(53, "truncated"), (59, "float_id"), (67, "missing_user"), (73, "negative_ip"),
                 (79, "zero_amount"), (83, "no_z")])
CTES["msg_typed"] = (f"""
SELECT eid, event_id, event_type, event_ts, validated_at,
       CASE WHEN brk = 'missing_user' THEN NULL ELSE user_id END AS user_id,
       merchant_id, device_id,
       CASE WHEN brk = 'negative_ip' THEN -1 ELSE ip_id END AS ip_id,
       CASE WHEN brk = 'zero_amount' THEN CAST(0 AS DOUBLE) ELSE amount END AS amount,
       currency, country, channel, drift_phase, payload, brk,
       coalesce(brk = 'truncated', false) AS is_dead
FROM (SELECT *, CASE {_BRK} END AS brk FROM txn_raw) b""", ["txn_raw"])

MSG_CONDS = suite_conditions(
    "coalesce(brk = 'no_z', false)",
    {"user_id": "coalesce(brk = 'float_id', false)"})

CTES["msg_flags"] = (f"""
SELECT *, CASE WHEN NOT is_dead THEN {failed_list_sql(MSG_CONDS)} END AS failed_raw
FROM msg_typed""", ["msg_typed"])

CTES["txn_validated"] = ("""
SELECT * EXCLUDE (failed_raw) FROM txn_flags WHERE len(failed_raw) = 0""", ["txn_flags"])

CTES["feats"] = ("""
SELECT *,
  count(*) OVER w5m AS user_txn_count_5m,
  count(*) OVER w1h AS user_txn_count_1h,
  coalesce(CAST(sum(CAST(amount AS DECIMAL(18,2))) OVER w1h AS DOUBLE), CAST(0 AS DOUBLE)) AS user_amount_sum_1h,
  coalesce(CAST(sum(CAST(amount AS DECIMAL(18,2))) OVER w30d AS DOUBLE)
           / CAST(count(amount) OVER w30d AS DOUBLE), CAST(0 AS DOUBLE)) AS user_avg_amount_30d,
  CAST(0 AS DOUBLE) AS merchant_chargeback_rate_30d,
  CAST(0 AS DOUBLE) AS device_risk_score,
  CAST(0 AS DOUBLE) AS ip_risk_score
FROM txn_validated
WINDOW w5m AS (PARTITION BY user_id ORDER BY event_ts RANGE BETWEEN INTERVAL 5 MINUTE PRECEDING AND CURRENT ROW),
       w1h AS (PARTITION BY user_id ORDER BY event_ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW),
       w30d AS (PARTITION BY user_id ORDER BY event_ts RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW)""",
                  ["txn_validated"])

_T = C.RULE_THRESHOLDS
RULES_SQL = f"""
least(greatest(
  CASE WHEN merchant_chargeback_rate_30d >= CAST({_T['merchant_risk']} AS DOUBLE)
       THEN greatest(r3, CAST({_T['elevated_risk']} AS DOUBLE)) ELSE r3 END, CAST(0 AS DOUBLE)), CAST(1 AS DOUBLE))"""

CTES["scored"] = (f"""
SELECT * EXCLUDE (r0, r1, r2, r3),
       {RULES_SQL} AS rules_score
FROM (
  SELECT *,
    CASE WHEN user_amount_sum_1h >= CAST({_T['velocity_amount_1h']} AS DOUBLE)
         THEN greatest(r2, CAST({_T['elevated_risk']} AS DOUBLE)) ELSE r2 END AS r3
  FROM (
    SELECT *,
      CASE WHEN user_txn_count_5m >= CAST({_T['velocity_count_5m']} AS DOUBLE)
           THEN greatest(r1, CAST({_T['elevated_risk']} AS DOUBLE)) ELSE r1 END AS r2
    FROM (
      SELECT *,
        CASE WHEN amount >= CAST({_T['high_amount']} AS DOUBLE) AND susp
             THEN greatest(r0, CAST({_T['elevated_risk']} AS DOUBLE)) ELSE r0 END AS r1
      FROM (
        SELECT *,
          CASE WHEN amount >= CAST({_T['very_high_amount']} AS DOUBLE) AND susp
               THEN CAST({_T['high_risk']} AS DOUBLE) ELSE CAST({_T['base_risk']} AS DOUBLE) END AS r0
        FROM (SELECT *, (CAST(geo_mismatch AS DOUBLE) + CAST(is_new_device AS DOUBLE)
                         + CAST(is_new_ip AS DOUBLE)) >= 1 AS susp FROM feats) s0
      ) s1
    ) s2
  ) s3
) s4""", ["feats"])

_B = C.BLEND
_D = C.DECISION_THRESHOLDS
FINAL_SQL = f"""
CASE WHEN champion_score IS NOT NULL AND anomaly_score IS NOT NULL
       THEN greatest(rules_score, CAST({_B['both'][0]} AS DOUBLE) * champion_score
                                  + CAST({_B['both'][1]} AS DOUBLE) * anomaly_score)
     WHEN champion_score IS NOT NULL
       THEN greatest(rules_score, CAST({_B['champion_only'][0]} AS DOUBLE) * champion_score
                                  + CAST({_B['champion_only'][1]} AS DOUBLE) * rules_score)
     WHEN anomaly_score IS NOT NULL
       THEN greatest(rules_score, CAST({_B['anomaly_only'][0]} AS DOUBLE) * anomaly_score
                                  + CAST({_B['anomaly_only'][1]} AS DOUBLE) * rules_score)
     ELSE rules_score END"""


def decide_sql(x: str) -> str:
    return (f"CASE WHEN {x} >= CAST({_D['block']} AS DOUBLE) THEN 'block' "
            f"WHEN {x} >= CAST({_D['review']} AS DOUBLE) THEN 'review' "
            f"WHEN {x} >= CAST({_D['step_up']} AS DOUBLE) THEN 'step_up' ELSE 'approve' END")


CTES["decisions0"] = (f"""
SELECT *, {FINAL_SQL} AS final_score
FROM (
  SELECT *,
    CASE WHEN eid % 10 <> 9 THEN CAST((eid * 37) % 101 AS DOUBLE) / CAST(100 AS DOUBLE) END AS champion_score,
    CASE WHEN eid % 7 <> 6 THEN CAST((eid * 53) % 101 AS DOUBLE) / CAST(100 AS DOUBLE) END AS anomaly_score
  FROM scored) x""", ["scored"])

CTES["decisions1"] = (f"""
SELECT event_id, eid, event_ts, user_id, merchant_id, device_id, ip_id, amount, country, channel,
       drift_phase, final_score, {decide_sql('final_score')} AS decision,
       rules_score, champion_score, anomaly_score,
       champion_score IS NULL AND anomaly_score IS NULL AS fb_rules_only,
       champion_score IS NULL AS fb_champion_missing,
       anomaly_score IS NULL AS fb_anomaly_missing,
       eid % 13 <> 0 AS has_features,
       CASE WHEN eid % 13 <> 0 THEN user_txn_count_5m END AS f_user_txn_count_5m,
       CASE WHEN eid % 13 <> 0 THEN CAST(user_txn_count_1h AS DOUBLE) END AS f_user_txn_count_1h,
       CASE WHEN eid % 13 <> 0 THEN user_amount_sum_1h END AS f_user_amount_sum_1h,
       CASE WHEN eid % 13 <> 0 THEN user_avg_amount_30d END AS f_user_avg_amount_30d,
       CASE WHEN eid % 13 <> 0 THEN merchant_chargeback_rate_30d END AS f_merchant_chargeback_rate_30d,
       CASE WHEN eid % 13 <> 0 THEN device_risk_score END AS f_device_risk_score,
       CASE WHEN eid % 13 <> 0 THEN ip_risk_score END AS f_ip_risk_score,
       CAST(5 + eid % 40 AS DOUBLE) AS latency_total,
       CASE WHEN user_id % 100 < 20 THEN 'v2' ELSE 'v1' END AS served_by,
       'gbt' AS champion_type,
       event_ts + INTERVAL 1 MINUTE AS created_at
FROM decisions0""", ["decisions0"])

CTES["decision_log"] = ("""
SELECT * FROM decisions1
UNION ALL
SELECT * REPLACE (created_at + INTERVAL 1 MINUTE AS created_at) FROM decisions1 WHERE eid % 37 = 0""",
                        ["decisions1"])

CTES["txn_labels"] = (f"""
SELECT event_id, eid,
       coalesce(TRY_CAST(json_extract_string(payload, '$.is_fraud') AS INTEGER),
                TRY_CAST(json_extract_string(payload, '$.label') AS INTEGER),
                TRY_CAST(json_extract_string(payload, '$.isFraud') AS INTEGER), 0) AS label,
       '{C.GROUND_TRUTH_SOURCE}' AS label_source,
       event_ts + INTERVAL 31 MINUTE AS labeled_at
FROM txn_validated WHERE eid % 2 = 0""", ["txn_validated"])


def _order(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        if n in out:
            return
        for d in CTES[n][1]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_ctes(body: str, *names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH <fixture views...>, <extra...> <body>``."""
    parts = [f"{n} AS ({CTES[n][0]}\n)" for n in _order(names)]
    parts += [f"{n} AS ({sql}\n)" for n, sql in (extra or [])]
    return "WITH " + ",\n".join(parts) + "\n" + body
