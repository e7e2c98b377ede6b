"""The same results in SQL, for checking ``queries`` on another engine."""

from __future__ import annotations

from coppice.plans.documents import INPUTS


def _hash(seed: int, key: str) -> str:
    return f"md5(concat_ws('|', '{seed}', {key}))"


def _below(seed: int, key: str, fraction: float) -> str:
    return (
        f"('0x' || substr({_hash(seed, key)}, 1, 8))::BIGINT"
        f" < trunc({fraction}::DOUBLE * 4294967296)::BIGINT"
    )


def _quota_split(source: str, label: str, key: str, fraction: float = 0.7, seed: int = 42) -> str:
    """CTEs ending in ``flagged``: the rows of ``source`` with ``is_train``."""
    return f"""
    counts AS (SELECT {label}, count(*) AS n FROM {source} GROUP BY {label}),
    exact AS (
        SELECT {label}, n, floor(round({fraction}::DOUBLE * n, 9)) AS base,
               round(round({fraction}::DOUBLE * n, 9)
                     - floor(round({fraction}::DOUBLE * n, 9)), 9) AS rest
        FROM counts),
    seats AS (
        SELECT floor(round({fraction}::DOUBLE * sum(n), 9)) - sum(base) AS seats FROM exact),
    quotas AS (
        SELECT {label},
               base + CASE WHEN row_number() OVER (ORDER BY rest DESC, {label}) <= seats
                           THEN 1 ELSE 0 END AS quota
        FROM exact, seats),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY {label}
                                     ORDER BY {_hash(seed, key)}, {key}) AS place
        FROM {source}),
    flagged AS (
        SELECT ranked.*, place <= quota AS is_train
        FROM ranked JOIN quotas USING ({label}))"""


def _folds(source: str, label: str, key: str, folds: int, seed: int = 42) -> str:
    """CTE ``folded``: the rows of ``source`` with their fold."""
    return f"""
    places AS (
        SELECT *, count(*) OVER (PARTITION BY {label}) AS n,
               row_number() OVER (PARTITION BY {label}
                                  ORDER BY {_hash(seed, key)}, {key}) AS place
        FROM {source}),
    folded AS (
        SELECT *, len([i FOR i IN range(1, {folds}) IF i * n // {folds} < place])::INT AS fold
        FROM places)"""


def _dictionary(order: str) -> str:
    return f"""
        WITH items AS (
            SELECT l_orderkey, l_linenumber,
                   CASE WHEN l_linenumber % 2 = 0 THEN trunc(l_quantity)::BIGINT
                        ELSE l_partkey + 1000 END::VARCHAR AS label
            FROM lineitem),
        codes AS (
            SELECT label, (row_number() OVER (ORDER BY {order}) - 1)::DOUBLE AS index
            FROM items GROUP BY label)
        SELECT l_orderkey, l_linenumber, label, index FROM items JOIN codes USING (label)"""


LABELLED = "labelled AS (SELECT doc_id, quality FROM labels JOIN documents USING (doc_id))"
HELDOUT = f"WITH {LABELLED}, {_quota_split('labelled', 'quality', 'doc_id')}"

# Java's split drops trailing empty strings; the tokenizer keeps one token for an empty text.
SPACE = r"[ \t\n\x0B\f\r]"
TOKENS = rf"""
    CASE WHEN text = '' THEN 1
         WHEN regexp_full_match(text, '{SPACE}*') THEN 0
         ELSE len(regexp_split_to_array(regexp_replace(text, '{SPACE}+$', ''), '{SPACE}'))
    END::BIGINT"""

JUDGED = "judged AS (SELECT doc_id, quality, 1 - toxic AS guess FROM labels)"
CELLS = f"""
WITH {JUDGED},
classes AS (SELECT quality AS c FROM judged UNION SELECT guess FROM judged),
grid AS (SELECT a.c AS actual, p.c AS predicted FROM classes a, classes p),
cells AS (
    SELECT actual, predicted, count(doc_id) AS n
    FROM grid LEFT JOIN judged ON quality = actual AND guess = predicted
    GROUP BY actual, predicted)"""

LENGTH_SCORES = """
scored AS (
    SELECT lang, quality, (n_chars // 50 * 50)::DOUBLE AS score
    FROM labels JOIN documents USING (doc_id)),
totals AS (
    SELECT lang, count(*) FILTER (quality = 1) AS p, count(*) FILTER (quality = 0) AS q
    FROM scored GROUP BY lang),
points AS (
    SELECT lang, score, count(*) FILTER (quality = 1) AS pos, count(*) FILTER (quality = 0) AS neg
    FROM scored GROUP BY lang, score),
upto AS (
    SELECT *, sum(pos) OVER w AS pos_upto, sum(neg) OVER w AS neg_upto
    FROM points JOIN totals USING (lang)
    WINDOW w AS (PARTITION BY lang ORDER BY score DESC))"""

USER_MODELS = """
models AS (
    SELECT 'user-' || user_id AS name, min(event_id) AS first_id,
           max(CASE WHEN event_type = 'purchase' THEN event_id END) AS bought_id
    FROM events GROUP BY user_id)"""

SHAPES = rf"""
shapes AS (
    SELECT doc_id, quality, n_chars,
           regexp_split_to_array(text, '{SPACE}+') AS words,
           length(regexp_replace(text, '[A-Za-z ]', '', 'g')) AS n_other
    FROM labels JOIN documents USING (doc_id))"""
SHAPE_COLUMNS = """
    n_chars::DOUBLE AS n_chars, len(words)::DOUBLE AS n_words,
    round(len(list_distinct(words)) / len(words), 6) AS distinct_ratio,
    round(CASE WHEN n_chars = 0 THEN 0 ELSE n_other / n_chars END, 6) AS nonalpha_ratio"""

SCORED = """
SELECT doc_id, quality, true AS in_classes, true AS prob_ok, true AS beats_constant
FROM flagged WHERE NOT is_train"""

STAGE_SPANS = """
        WITH clicks AS (
            SELECT user_id, event_id, ts,
                ts + to_days(CAST(event_id % 5 AS INT)) AS moved,
                ts + to_days(CAST(event_id % 5 + event_id % 7 AS INT)) AS gone
            FROM events WHERE event_type = 'click'
        ),
        held AS (
            SELECT user_id AS name, event_id AS version, 'Staging' AS stage, ts AS since, moved AS until
            FROM clicks WHERE ts < moved
            UNION ALL
            SELECT user_id, event_id, 'Production', moved, gone FROM clicks WHERE moved < gone
            UNION ALL
            SELECT user_id, event_id, 'Archived', gone, NULL FROM clicks
        )"""

ORACLES: dict[str, str] = {
    "table_scan": "SELECT * FROM orders",
    "format_roundtrip": "SELECT * FROM orders",
    "orc_table_roundtrip": "SELECT * FROM customer",
    "feature_projection": """
        SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag FROM lineitem""",
    "class_name": """
        SELECT o_orderkey, o_orderstatus,
               CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS status_name
        FROM orders""",
    "equality_filter": """
        SELECT o_orderkey, o_totalprice FROM orders
        WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'""",
    "cast_types": """
        SELECT c_custkey::VARCHAR AS c_custkey, c_nationkey::DOUBLE AS c_nationkey,
               trunc(c_acctbal)::INT AS c_acctbal
        FROM customer""",
    "shuffle_rows": f"""
        SELECT o_orderkey, o_custkey,
               row_number() OVER (ORDER BY {_hash(42, "o_orderkey")}, o_orderkey) AS position
        FROM orders""",
    "shuffle_topn": f"""
        SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
        ORDER BY {_hash(42, "o_orderkey")}, o_orderkey LIMIT 100""",
    "preview": """
        SELECT o_orderkey, o_totalprice FROM orders
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 5""",
    "sort_descending": """
        SELECT l_returnflag || '-' || l_linestatus AS price_group,
               max(l_extendedprice) AS top_price,
               row_number() OVER (ORDER BY max(l_extendedprice) DESC,
                                  l_returnflag || '-' || l_linestatus) AS position
        FROM lineitem GROUP BY l_returnflag, l_linestatus""",
    "random_split": f"""
        SELECT o_orderkey, o_orderstatus, {_below(42, "o_orderkey", 0.7)} AS is_train
        FROM orders""",
    "default_split": f"""
        SELECT o_orderkey, o_orderstatus, {_below(0, "o_orderkey", 0.75)} AS is_train
        FROM orders""",
    "stratified_split": f"""
        WITH {_quota_split("customer", "c_mktsegment", "c_custkey")}
        SELECT c_custkey, c_mktsegment, is_train FROM flagged""",
    "stratified_folds": f"""
        WITH {_folds("customer", "c_mktsegment", "c_custkey", 7)}
        SELECT c_custkey, c_mktsegment, fold FROM folded""",
    "stratified_counts": f"""
        WITH {_quota_split("lineitem", "l_returnflag", "l_orderkey")}
        SELECT l_returnflag, quota::BIGINT AS n_train, (n - quota)::BIGINT AS n_heldout
        FROM quotas JOIN counts USING (l_returnflag)""",
    "heldout_roundtrip": f"""
        SELECT * FROM orders WHERE NOT ({_below(42, "o_orderkey", 0.7)})""",
    "label_index_frequency": """
        WITH codes AS (
            SELECT c_mktsegment,
                   (row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) - 1)::DOUBLE
                       AS segment_index
            FROM customer GROUP BY c_mktsegment)
        SELECT c_custkey, c_mktsegment, segment_index
        FROM customer JOIN codes USING (c_mktsegment)""",
    "label_index_alpha": """
        WITH codes AS (
            SELECT c_mktsegment,
                   (row_number() OVER (ORDER BY c_mktsegment) - 1)::DOUBLE AS segment_index
            FROM customer GROUP BY c_mktsegment)
        SELECT c_custkey, c_mktsegment, segment_index
        FROM customer JOIN codes USING (c_mktsegment)""",
    "label_dictionary_frequency": _dictionary("count(*) DESC, label"),
    "label_dictionary_alpha": _dictionary("label"),
    "assembled_features": """
        SELECT l_orderkey, l_partkey, l_quantity AS slot_l_quantity,
               l_extendedprice AS slot_l_extendedprice, l_discount AS slot_l_discount,
               l_tax AS slot_l_tax
        FROM lineitem""",
    "categorical_slots": """
        WITH counts AS (
            SELECT 'line_mod_3' AS slot, count(DISTINCT l_linenumber % 3) AS n FROM lineitem
            UNION ALL SELECT 'l_linenumber', count(DISTINCT l_linenumber) FROM lineitem
            UNION ALL SELECT 'l_tax', count(DISTINCT l_tax) FROM lineitem
            UNION ALL SELECT 'l_discount', count(DISTINCT l_discount) FROM lineitem)
        SELECT slot, n <= 4 AS is_categorical, CASE WHEN n <= 4 THEN n END AS n_categories
        FROM counts""",
    "token_counts": f"SELECT doc_id, {TOKENS} AS n_tokens FROM documents",
    "hashed_tf_total": f"SELECT doc_id, {TOKENS} AS total FROM documents",
    "balanced_weights": """
        WITH counts AS (SELECT quality, count(*) AS n FROM labels GROUP BY quality),
        totals AS (SELECT sum(n) AS rows, count(*) AS classes FROM counts)
        SELECT doc_id, quality, round(rows / (classes * n), 6)::DOUBLE AS weight
        FROM labels JOIN counts USING (quality), totals""",
    "accuracy": f"""
        WITH {JUDGED}
        SELECT round(avg((quality = guess)::INT), 6) AS accuracy FROM judged""",
    "accuracy_count": f"""
        WITH {JUDGED}
        SELECT sum((quality = guess)::INT)::DOUBLE AS n_right FROM judged""",
    "accuracy_weighted": f"""
        WITH {JUDGED}, counts AS (SELECT quality, count(*) AS n FROM judged GROUP BY quality)
        SELECT round(sum((quality = guess)::INT / n::DOUBLE) / sum(1 / n::DOUBLE), 6) AS accuracy
        FROM judged JOIN counts USING (quality)""",
    "confusion_matrix": f"{CELLS} SELECT actual, predicted, n FROM cells",
    "confusion_share": f"""{CELLS}
        SELECT actual, predicted, round(n / sum(n) OVER (), 6)::DOUBLE AS share FROM cells""",
    "confusion_wide": f"""{CELLS}
        SELECT actual, sum(CASE WHEN predicted = 0 THEN n END)::BIGINT AS pred_0,
               sum(CASE WHEN predicted = 1 THEN n END)::BIGINT AS pred_1
        FROM cells GROUP BY actual""",
    "confusion_named": f"""{CELLS}
        SELECT CASE actual WHEN 0 THEN 'poor' WHEN 1 THEN 'good' END AS actual_name,
               CASE predicted WHEN 0 THEN 'poor' WHEN 1 THEN 'good' END AS predicted_name,
               n, round(n / sum(n) OVER (), 6)::DOUBLE AS share
        FROM cells""",
    "confusion_by_group": f"""
        WITH {JUDGED}, tagged AS (SELECT * FROM judged JOIN documents USING (doc_id)),
        classes AS (SELECT unnest([0, 1]) AS c),
        grid AS (
            SELECT lang, a.c AS actual, p.c AS predicted
            FROM (SELECT DISTINCT lang FROM tagged), classes a, classes p),
        cells AS (
            SELECT grid.lang, actual, predicted, count(doc_id) AS n
            FROM grid LEFT JOIN tagged
              ON tagged.lang = grid.lang AND quality = actual AND guess = predicted
            GROUP BY grid.lang, actual, predicted)
        SELECT lang, actual, predicted, n,
               round(n / sum(n) OVER (PARTITION BY lang), 6)::DOUBLE AS share
        FROM cells""",
    "roc_auc": """
        WITH scored AS (
            SELECT quality, n_chars FROM labels JOIN documents USING (doc_id)),
        ranked AS (
            SELECT quality, rank() OVER (ORDER BY n_chars)
                   + (count(*) OVER (PARTITION BY n_chars) - 1) / 2.0::DOUBLE AS place
            FROM scored),
        parts AS (
            SELECT sum(place) FILTER (quality = 1) AS places,
                   (count(*) FILTER (quality = 1))::DOUBLE AS p,
                   (count(*) FILTER (quality = 0))::DOUBLE AS q
            FROM ranked)
        SELECT round((places - p * (p + 1) / 2) / (p * q), 6)::DOUBLE AS auc FROM parts""",
    "roc_curve": f"""
        WITH {LENGTH_SCORES}
        SELECT lang, score AS threshold, round(neg_upto / nullif(q, 0)::DOUBLE, 6)::DOUBLE AS fpr,
               round(pos_upto / nullif(p, 0)::DOUBLE, 6)::DOUBLE AS tpr
        FROM upto
        UNION ALL
        SELECT lang, 'inf'::DOUBLE, CASE WHEN q > 0 THEN 0.0::DOUBLE END,
               CASE WHEN p > 0 THEN 0.0::DOUBLE END
        FROM totals""",
    "auc_by_group": f"""
        WITH {LENGTH_SCORES}
        SELECT lang, round(sum(neg * (pos_upto - pos / 2.0::DOUBLE))
                           / nullif(max(p) * max(q), 0), 6)::DOUBLE AS auc
        FROM upto GROUP BY lang""",
    "latest_per_key": """
        SELECT event_id, ts, user_id, event_type, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type
                                   ORDER BY ts DESC, event_id DESC) = 1""",
    "register_version": f"""
        WITH {USER_MODELS}
        SELECT name, 1::BIGINT AS version, first_id::VARCHAR AS run_id,
               'models/' || first_id AS source
        FROM models
        UNION ALL
        SELECT name, 2::BIGINT, bought_id::VARCHAR, 'models/' || bought_id
        FROM models WHERE bought_id IS NOT NULL""",
    "stage_change": f"""
        WITH {USER_MODELS}
        SELECT name, 1::BIGINT AS version,
               CASE WHEN bought_id IS NULL THEN 'Staging' ELSE 'Production' END AS stage
        FROM models""",
    "version_at_stage": f"""
        WITH {USER_MODELS}
        SELECT name, 'Staging' AS stage,
               (CASE WHEN bought_id IS NULL THEN 1 ELSE 2 END)::BIGINT AS version,
               coalesce(bought_id, first_id)::VARCHAR AS run_id,
               'models/' || coalesce(bought_id, first_id) AS source
        FROM models""",
    "stage_spans": f"""
        {STAGE_SPANS}
        SELECT name, version, stage, since, until FROM held""",
    "version_as_of": f"""
        {STAGE_SPANS}
        SELECT p.event_id, s.stage, max(h.version) AS version
        FROM (SELECT * FROM events WHERE event_type = 'purchase') p
        CROSS JOIN (VALUES ('Staging'), ('Production'), ('Archived')) s(stage)
        LEFT JOIN held h ON h.name = p.user_id AND h.stage = s.stage
            AND h.since <= p.ts AND (h.until IS NULL OR p.ts < h.until)
        GROUP BY p.event_id, s.stage""",
    "stage_history": f"""
        WITH {USER_MODELS}
        SELECT commit::INT AS commit, name,
               (CASE WHEN commit = 2 AND bought_id IS NOT NULL THEN 2 ELSE 1 END)::BIGINT AS version
        FROM models, (SELECT unnest([1, 2, 3]) AS commit)""",
    "concurrent_versions": """
        SELECT 'user-' || user_id AS name,
               string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS writers,
               count(DISTINCT event_type) AS n_versions, count(DISTINCT event_type) AS n_numbers,
               count(DISTINCT event_type) AS last_version
        FROM events GROUP BY user_id""",
    "run_params": """
        SELECT o_orderkey::VARCHAR AS run_id, 'o_orderstatus' AS key, o_orderstatus AS value
        FROM orders
        UNION ALL
        SELECT o_orderkey::VARCHAR, 'o_orderpriority', o_orderpriority FROM orders""",
    "run_metrics": f"""
        WITH {JUDGED}
        SELECT lang AS name, 1::BIGINT AS version, min(doc_id)::VARCHAR AS run_id,
               round(avg((quality = guess)::INT), 6) AS value
        FROM judged JOIN documents USING (doc_id) GROUP BY lang""",
    "quality_features": f"WITH {SHAPES} SELECT doc_id, quality, {SHAPE_COLUMNS} FROM shapes",
    "forest_train_score": f"{HELDOUT} {SCORED}",
    "scored_display": f"""{HELDOUT}, {SHAPES}
        SELECT doc_id, flagged.quality::DOUBLE AS "indexedLabel", true AS in_classes, {SHAPE_COLUMNS}
        FROM flagged JOIN shapes USING (doc_id) WHERE NOT is_train""",
    "forest_full_options": f"""{HELDOUT}
        SELECT doc_id, quality, true AS in_classes, true AS prob_ok, 100 AS n_trees,
               20 AS max_depth, 'auto' AS subset, 'gini' AS impurity, true AS bootstrap,
               21 AS seed, true AS weighted
        FROM flagged WHERE NOT is_train""",
    "predictions_decoded": f"""{HELDOUT}
        SELECT doc_id, quality, quality AS decoded_truth, true AS in_classes,
               quality::VARCHAR AS actual_label
        FROM flagged WHERE NOT is_train""",
    "model_reload": f"""{HELDOUT}
        SELECT doc_id, true AS same_prediction FROM flagged WHERE NOT is_train""",
    "feature_ranking": " UNION ALL ".join(
        f"SELECT '{name}' AS feature, true AS sum_is_one, true AS is_sorted" for name in INPUTS
    ),
    "evaluate_job": f"""{HELDOUT}
        SELECT 1::BIGINT AS model_version, quality AS actual, count(*) AS n,
               true AS beats_majority, true AS is_logged
        FROM flagged WHERE NOT is_train GROUP BY quality""",
    "evaluate_history": f"""{HELDOUT}
        SELECT unnest([1, 2])::BIGINT AS model_version, quality::VARCHAR AS actual,
               CASE quality WHEN 0 THEN 'poor' WHEN 1 THEN 'good' END AS actual_name,
               count(*) AS n, true AS beats_chance
        FROM flagged WHERE NOT is_train GROUP BY quality""",
    "rejected_rows": """
        WITH judged AS (
            SELECT doc_id, concat_ws('; ',
                CASE WHEN doc_id % 5 = 0 THEN 'null: n_chars' END,
                CASE WHEN doc_id % 7 = 0 THEN 'not a number: n_words' END,
                CASE WHEN doc_id % 11 = 0 THEN 'null: quality'
                     WHEN doc_id % 3 = 0 THEN 'unknown: quality' END) AS reasons
            FROM labels JOIN documents USING (doc_id))
        SELECT doc_id, reasons, reasons = '' AS in_classes FROM judged""",
    "roc_versions": f"""{HELDOUT}
        SELECT unnest([1, 2])::BIGINT AS model_version, 0.0::DOUBLE AS first_fpr,
               1.0::DOUBLE AS last_tpr, true AS ties_combined,
               count(*) FILTER (quality = 1) AS n_positive,
               count(*) FILTER (quality = 0) AS n_negative, true AS beats_chance
        FROM flagged WHERE NOT is_train""",
    "append_again": f"""{HELDOUT}
        SELECT doc_id, 1::BIGINT AS model_version, 'half-' || doc_id % 2 AS batch,
               quality AS actual, true AS in_classes
        FROM flagged WHERE NOT is_train""",
    "evaluate_increment": f"""{HELDOUT}
        SELECT 1::BIGINT AS model_version, quality AS actual, count(*) AS n,
               '2/0/1' AS batches_read, true AS equals_full
        FROM flagged WHERE NOT is_train GROUP BY quality""",
    "model_signature": " UNION ALL ".join(
        [f"SELECT 'inputs' AS side, '{name}' AS name, 'double' AS type" for name in INPUTS]
        + [
            f"SELECT 'outputs', '{name}', '{kind}'"
            for name, kind in (
                ("features", "array<double>"),
                ("indexedFeatures", "array<double>"),
                ("rawPrediction", "array<double>"),
                ("probability", "array<double>"),
                ("prediction", "double"),
                ("predicted_label", "string"),
            )
        ]
    ),
    "text_logistic": f"{HELDOUT} {SCORED}",
    "linear_svc": f"""{HELDOUT}
        SELECT doc_id, quality, true AS in_classes, true AS beats_constant
        FROM flagged WHERE NOT is_train""",
    "kernel_svc": f"{HELDOUT} {SCORED}",
    "cross_validation": f"""
        WITH {LABELLED}, {_folds("labelled", "quality", "doc_id", 3)}
        SELECT doc_id, quality, fold, true AS in_classes, true AS beats_chance FROM folded""",
    "permutation_ranking": " UNION ALL ".join(
        f"SELECT '{name}' AS feature, true AS noise_is_low, true AS some_matter"
        for name in (*INPUTS, "noise")
    ),
    "harness": f"""{HELDOUT}
        SELECT quality::DOUBLE AS y_test, count(*) AS n, true AS beats_constant
        FROM flagged WHERE NOT is_train GROUP BY quality""",
}
