"""Independent SQL for the registered queries, over the raw test tables.

Every statement starts from the tables themselves; the shared views below are
plain SQL definitions of the encounter table and of scored stays.
"""

from __future__ import annotations

_LINE_MEDS = {
    1: "metformin", 2: "repaglinide", 3: "nateglinide", 4: "glimepiride",
    5: "glipizide", 6: "pioglitazone", 7: "insulin",
}


def _diag(i: int) -> str:
    p = f"max(CASE WHEN l_linenumber = {i} THEN l_partkey * 10 + l_suppkey % 10 END)"
    return f"{p} AS p{i}"


def _code(i: int) -> str:
    part, digit = f"(p{i} // 10)", f"(p{i} % 10)"
    return (
        f"CASE WHEN p{i} IS NULL OR {part} % 20 = 3 THEN NULL "
        f"WHEN {part} % 20 = 0 THEN concat('250.', {digit}) "
        f"WHEN {part} % 20 = 1 THEN concat('V', 10 + {part} % 80) "
        f"WHEN {part} % 20 = 2 THEN concat('E', 800 + {part} % 200) "
        f"ELSE concat(100 + ({part} * 7) % 900, '.', {digit}) END AS diag_{i}"
    )


def _med(i: int, name: str) -> str:
    worst = f"max(CASE WHEN l_linenumber = {i} THEN l_returnflag END)"
    return (
        f"CASE {worst} WHEN 'R' THEN 'Up' WHEN 'N' THEN 'Steady' "
        f"WHEN 'A' THEN 'Down' ELSE 'No' END AS {name}"
    )


def icd9_sql(column: str) -> str:
    """Category of a code column."""
    n = f"TRY_CAST({column} AS DOUBLE)"
    digits = f"regexp_full_match(trim({column}), '[0-9]+(\\.[0-9]*)?')"

    def between(low: int, high: int, extra: int | None = None) -> str:
        test = f"({n} >= {low} AND {n} < {high})"
        return test if extra is None else f"({test} OR ({n} >= {extra} AND {n} < {extra + 1}))"

    return (
        f"CASE WHEN {column} IS NULL OR trim({column}) IN ('', 'nan') THEN 'Missing' "
        f"WHEN starts_with(trim({column}), '250') THEN 'Diabetes' "
        f"WHEN NOT {digits} THEN 'Other' "
        f"WHEN {between(140, 240)} THEN 'Neoplasms' "
        f"WHEN {between(390, 460, 785)} THEN 'Circulatory' "
        f"WHEN {between(460, 520, 786)} THEN 'Respiratory' "
        f"WHEN {between(520, 580, 787)} THEN 'Digestive' "
        f"WHEN {between(580, 630, 788)} THEN 'Genitourinary' "
        f"WHEN {between(710, 740)} THEN 'Musculoskeletal' "
        f"WHEN {between(800, 1000)} THEN 'Injury' ELSE 'Other' END"
    )


_VIEWS = f"""
WITH stays AS (
  SELECT o_orderkey AS encounter_id, o_custkey AS patient_nbr, o_orderdate AS admitted,
    o_orderstatus AS gender, o_totalprice AS charge, o_orderpriority AS priority,
    CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS admission_type_id,
    CAST(1 + o_orderkey % 28 AS BIGINT) AS discharge_disposition_id,
    CAST(1 + o_custkey % 25 AS BIGINT) AS admission_source_id,
    CAST(floor(o_totalprice / 5000) AS BIGINT) AS num_lab_procedures,
    CAST(o_orderkey % 7 AS BIGINT) AS num_procedures,
    CAST(1 + o_orderkey % 9 AS BIGINT) AS number_diagnoses,
    CASE o_orderkey % 5 WHEN 0 THEN '>200' WHEN 1 THEN '>300' WHEN 2 THEN 'Norm' END AS max_glu_serum,
    CASE o_orderkey % 6 WHEN 0 THEN '>7' WHEN 1 THEN '>8' WHEN 2 THEN 'Norm' END AS "A1Cresult",
    CASE WHEN o_orderkey % 5 >= 2 THEN 'MC' END AS payer_code,
    lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS next_admitted
  FROM orders),
labelled AS (
  SELECT *, CASE WHEN next_admitted IS NULL THEN 'NO'
      WHEN date_diff('day', CAST(admitted AS DATE), CAST(next_admitted AS DATE)) < 30 THEN '<30'
      ELSE '>30' END AS readmitted,
    CASE WHEN date_diff('day', CAST(admitted AS DATE), CAST(next_admitted AS DATE)) < 30
      THEN 1 ELSE 0 END AS label
  FROM stays),
people AS (
  SELECT c_custkey, c_mktsegment,
    concat('[', 10 * CAST(floor((c_acctbal + 1000) / 1100) AS BIGINT), '-',
           10 * (CAST(floor((c_acctbal + 1000) / 1100) AS BIGINT) + 1), ')') AS age,
    CASE WHEN c_nationkey % 2 = 1 THEN concat('Specialty', c_nationkey) END AS medical_specialty
  FROM customer),
packed AS (
  SELECT l_orderkey,
    count(*) FILTER (WHERE l_returnflag = 'N') AS number_outpatient,
    count(*) FILTER (WHERE l_returnflag = 'A') AS number_emergency,
    count(*) FILTER (WHERE l_returnflag = 'R') AS number_inpatient,
    count(*) AS num_medications, CAST(max(l_linenumber) AS BIGINT) AS time_in_hospital,
    {_diag(1)}, {_diag(2)}, {_diag(3)},
    {", ".join(_med(i, m) for i, m in _LINE_MEDS.items())}
  FROM lineitem GROUP BY l_orderkey),
enc AS (
  SELECT l.* EXCLUDE (priority, next_admitted),
    CASE WHEN l.priority <> '4-NOT SPECIFIED' THEN c.c_mktsegment END AS race,
    c.age, c.medical_specialty, p.number_outpatient, p.number_emergency,
    p.number_inpatient, p.num_medications, p.time_in_hospital,
    {", ".join(_code(i) for i in (1, 2, 3))},
    {", ".join(f"coalesce(p.{m}, 'No') AS {m}" for m in _LINE_MEDS.values())},
    CASE WHEN p.number_inpatient > 0 THEN 'Ch' ELSE 'No' END AS change,
    CASE WHEN p.num_medications IS NOT NULL THEN 'Yes' ELSE 'No' END AS "diabetesMed"
  FROM labelled l LEFT JOIN people c ON l.patient_nbr = c.c_custkey
    LEFT JOIN packed p ON l.encounter_id = p.l_orderkey),
scored AS (
  SELECT *, CASE WHEN score >= CAST(0.4 AS DOUBLE) THEN 1 ELSE 0 END AS y_pred
  FROM (SELECT *, least(CAST(1 AS DOUBLE),
      charge / CAST(1000000 AS DOUBLE) + CAST(0.3 AS DOUBLE) * label) AS score FROM labelled)),
scored_people AS (
  SELECT s.encounter_id, s.patient_nbr, s.gender, s.label, s.score, s.y_pred,
    CASE WHEN s.priority <> '4-NOT SPECIFIED' THEN c.c_mktsegment END AS race, c.age
  FROM scored s LEFT JOIN people c ON s.patient_nbr = c.c_custkey),
long_people AS (
  SELECT 'race' AS attribute, coalesce(race, 'Unknown') AS value, label, y_pred, score FROM scored_people
  UNION ALL SELECT 'age', coalesce(age, 'Unknown'), label, y_pred, score FROM scored_people
  UNION ALL SELECT 'gender', coalesce(gender, 'Unknown'), label, y_pred, score FROM scored_people),
scored_docs AS (
  SELECT d.doc_id, d.lang, d.source, CAST(l.quality AS BIGINT) AS label,
    least(CAST(1 AS DOUBLE), d.n_chars / CAST(4000 AS DOUBLE)) AS score,
    CASE WHEN least(CAST(1 AS DOUBLE), d.n_chars / CAST(4000 AS DOUBLE)) >= 0.5 THEN 1 ELSE 0 END AS y_pred
  FROM documents d JOIN labels l USING (doc_id)),
rounded AS (
  SELECT *, floor(score * CAST(100 AS DOUBLE)) / CAST(100 AS DOUBLE) AS score2 FROM scored)
"""

# Confusion counts and rates as SQL fragments.
_COUNTS = """count(*) FILTER (WHERE label = 1 AND y_pred = 1) AS tp,
  count(*) FILTER (WHERE label = 0 AND y_pred = 1) AS fp,
  count(*) FILTER (WHERE label = 0 AND y_pred = 0) AS tn,
  count(*) FILTER (WHERE label = 1 AND y_pred = 0) AS fn"""


def _div(top: str, bottom: str, empty: str = "NULL") -> str:
    return f"CASE WHEN ({bottom}) <> 0 THEN CAST({top} AS DOUBLE) / ({bottom}) ELSE {empty} END"


def _r(expression: str, name: str) -> str:
    return f"round({expression}, 6) AS {name}"


_RATES = ", ".join([
    "tp + fp + tn + fn AS count",
    _r(_div("tp + fn", "tp + fp + tn + fn"), "base_rate"),
    _r(_div("tp + fp", "tp + fp + tn + fn"), "selection_rate"),
    _r(_div("tp", "tp + fn", "0"), "recall"),
    _r(_div("tn", "tn + fp", "0"), "specificity"),
    _r(_div("fp", "tn + fp", "0"), "false_positive_rate"),
    _r(_div("fn", "tp + fn", "0"), "false_negative_rate"),
    _r(_div("tp", "tp + fp"), "precision"),
])
_POINT = ", ".join([
    _r(_div("tp", "tp + fn", "0"), "recall"), _r(_div("tp", "tp + fp", "0"), "precision"),
    _r(_div("2 * tp", "2 * tp + fn + fp", "0"), "f1"),
    _r(_div("5 * tp", "5 * tp + 4 * fn + fp", "0"), "f2"),
])


def _ranked(source: str, score: str = "score", groups: str = "") -> str:
    """CTEs ending in ``ranked``: running tp/fp over distinct scores."""
    part = f"PARTITION BY {groups}" if groups else ""
    lead = f"{groups}, " if groups else ""
    return f""", per_score AS (
  SELECT {lead}{score} AS score, count(*) FILTER (WHERE label = 1) AS pos,
    count(*) FILTER (WHERE label = 0) AS neg FROM {source} GROUP BY ALL),
ranked AS (
  SELECT *, sum(pos) OVER (w ROWS UNBOUNDED PRECEDING) AS tp,
    sum(neg) OVER (w ROWS UNBOUNDED PRECEDING) AS fp,
    sum(pos) OVER ({part}) AS n_pos, sum(neg) OVER ({part}) AS n_neg
  FROM per_score WINDOW w AS ({part} ORDER BY score DESC))"""


_AREAS = (
    "round(sum(CAST(neg AS DOUBLE) * (tp - pos + pos / 2.0)) "
    "/ nullif(CAST(sum(pos) AS DOUBLE) * sum(neg), 0), 6) AS auc_roc, "
    "round(sum(CAST(pos AS DOUBLE) * tp / (tp + fp)) / nullif(sum(pos), 0), 6) AS auc_pr"
)


def _digest(key: str, seed: int = 42) -> str:
    return f"md5(concat('{seed}:', CAST({key} AS VARCHAR)))"


def _side(key: str) -> str:
    return f"CASE WHEN substr({_digest(key)}, 1, 8) < '33333333' THEN 'test' ELSE 'train' END"


# The 200 cuts are numpy's linspace values, written out by the caller.
def _curve(source: str, cuts: list[float], groups: str = "") -> str:
    values = ", ".join(f"(CAST({c!r} AS DOUBLE))" for c in cuts)
    lead = f"{groups}, " if groups else ""
    return f""", cuts(threshold) AS (VALUES {values}),
curve AS (
  SELECT {lead}threshold,
    CAST(count(*) FILTER (WHERE label = 0 AND score >= threshold)
      + 5 * count(*) FILTER (WHERE label = 1 AND score < threshold) AS DOUBLE) AS cost,
    count(*) FILTER (WHERE label = 1 AND score >= threshold) AS tp,
    count(*) FILTER (WHERE label = 0 AND score >= threshold) AS fp,
    count(*) FILTER (WHERE label = 0 AND score < threshold) AS tn,
    count(*) FILTER (WHERE label = 1 AND score < threshold) AS fn
  FROM {source}, cuts GROUP BY ALL)"""


_NUMERIC = (
    "num_lab_procedures", "number_diagnoses", "number_outpatient", "number_emergency",
    "number_inpatient", "num_medications", "time_in_hospital", "charge",
)
_CATEGORICAL = ("race", "age", "gender", "medical_specialty", "diag_1", "discharge_disposition_id")
_MEDS = tuple(_LINE_MEDS.values())
_PROFILED = (
    "race", "age", "gender", "medical_specialty", "payer_code", "diag_1", "diag_2", "diag_3",
    "max_glu_serum", "A1Cresult", "number_outpatient", "num_medications", "time_in_hospital",
    "charge", "change", "metformin",
)


def _q(name: str) -> str:
    return f'"{name}"'


def _unions(rows: list[str]) -> str:
    return " UNION ALL ".join(rows)


def _encoder_sql() -> dict[str, str]:
    stats = _unions([
        f"""SELECT '{c}' AS column_name, round(m, 6) AS median,
          round(avg(coalesce(CAST(x AS DOUBLE), m)), 6) AS mean,
          round(stddev_pop(coalesce(CAST(x AS DOUBLE), m)), 6) AS std
        FROM (SELECT {c} AS x, (SELECT median(CAST({c} AS DOUBLE)) FROM enc) AS m FROM enc)
        GROUP BY m"""
        for c in _NUMERIC
    ])
    scaled = ", ".join(
        f"round((coalesce(CAST({c} AS DOUBLE), m_{c}) - a_{c}) / s_{c}, 6) AS scaled__{c}"
        for c in _NUMERIC
    )
    medians = ", ".join(f"median(CAST({c} AS DOUBLE)) AS m_{c}" for c in _NUMERIC)
    moments = ", ".join(
        f"avg(coalesce(CAST({c} AS DOUBLE), m_{c})) AS a_{c}, "
        f"stddev_pop(coalesce(CAST({c} AS DOUBLE), m_{c})) AS s_{c}" for c in _NUMERIC
    )
    long = _unions([
        f"SELECT '{c}' AS column_name, coalesce(CAST({c} AS VARCHAR), 'Unknown') AS category, "
        f"encounter_id, {_side('patient_nbr')} AS split FROM enc" for c in _CATEGORICAL
    ])
    floors = f""", long AS ({long}), floors AS (
      SELECT column_name, category, count(*) AS n FROM long WHERE split = 'train' GROUP BY ALL)"""
    onehot = f"""{_VIEWS} {floors}
          SELECT concat(l.column_name, '_',
              CASE WHEN f.n < 10 THEN 'infrequent_sklearn' ELSE l.category END) AS feature,
            l.split, count(*) AS n, CAST(sum(l.encounter_id) AS BIGINT) AS id_sum
          FROM long l JOIN floors f USING (column_name, category) GROUP BY ALL"""
    numbers = _unions([
        f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS x, encounter_id, "
        f"{_side('patient_nbr')} AS split FROM enc" for c in _NUMERIC
    ])
    return {
        "encode_onehot_stored": onehot,
        "encode_features": f"""{_VIEWS} {floors}, numbers AS ({numbers}), middles AS (
            SELECT column_name, median(x) AS m FROM numbers WHERE split = 'train' GROUP BY ALL
          ), moments AS (
            SELECT column_name, m, avg(coalesce(x, m)) AS a, stddev_pop(coalesce(x, m)) AS s
            FROM numbers JOIN middles USING (column_name) WHERE split = 'train' GROUP BY ALL
          ), entries AS (
            SELECT encounter_id, split, column_name AS feature,
              (coalesce(x, m) - a) / CASE WHEN s = 0 THEN 1 ELSE s END AS value
            FROM numbers JOIN moments USING (column_name)
            UNION ALL SELECT encounter_id, split, concat(column_name, '_',
              CASE WHEN n < 10 THEN 'infrequent_sklearn' ELSE category END), 1.0
            FROM long JOIN floors USING (column_name, category)
          ) SELECT encounter_id, split, feature, round(value, 6) AS value FROM entries
          WHERE abs(value) > 5e-7""",
        "encode_numeric_stats": f"{_VIEWS} {stats}",
        "encode_scaled": f"""{_VIEWS}, med AS (SELECT {medians} FROM enc),
          mom AS (SELECT {moments} FROM enc, med)
          SELECT encounter_id, {scaled} FROM enc, med, mom""",
        "encode_category_floor": f"""{_VIEWS} {floors}
          SELECT column_name, category, n,
            CASE WHEN n < 10 THEN 1 ELSE 0 END AS infrequent FROM floors""",
        "encode_onehot": onehot,
        "encode_column_groups": _VIEWS + _unions(
            [f"SELECT '{c}' AS column_name, 'numeric' AS kind, count({c}) AS n_known FROM enc"
             for c in _NUMERIC]
            + [f"SELECT '{c}', 'categorical', count({c}) FROM enc" for c in _CATEGORICAL]
        ),
    }


def _feature_sql() -> dict[str, str]:
    prescribed = " + ".join(f"CAST({m} <> 'No' AS BIGINT)" for m in _MEDS)
    changed = " + ".join(f"CAST({m} IN ('Up', 'Down') AS BIGINT)" for m in _MEDS)
    cats = {i: icd9_sql(f"diag_{i}") for i in (1, 2, 3)}

    def has(name: str) -> str:
        return (f"CAST({cats[2]} = '{name}' OR {cats[3]} = '{name}' AS BIGINT)")

    def prior(a: int, b: int, c: int) -> str:
        return (f"CAST({a} * coalesce(number_outpatient, 0) + {b} * coalesce(number_emergency, 0)"
                f" + {c} * coalesce(number_inpatient, 0) AS DOUBLE)")

    lab = {
        "A1C_measured": 'CAST("A1Cresult" IS NOT NULL AS BIGINT) AS "A1C_measured"',
        "glu_measured": "CAST(max_glu_serum IS NOT NULL AS BIGINT) AS glu_measured",
    }
    flags = ("CAST(change = 'Ch' AS BIGINT) AS change_flag, "
             "CAST(\"diabetesMed\" = 'Yes' AS BIGINT) AS \"diabetesMed_flag\"")
    comorbid = (f"{has('Circulatory')} AS has_circulatory_comorb, "
                f"{has('Respiratory')} AS has_respiratory_comorb, "
                f"{has('Diabetes')} AS has_diabetes_diag")
    cat_columns = ", ".join(f"{cats[i]} AS diag_{i}_cat" for i in (1, 2, 3))
    meds = f"{prescribed} AS n_med_prescribed, {changed} AS n_med_changed"
    ordinal = ", ".join(
        f"CASE {m} WHEN 'No' THEN 0 WHEN 'Steady' THEN 1 WHEN 'Up' THEN 2 WHEN 'Down' THEN 2 END "
        f"AS {m}" for m in _MEDS
    )
    return {
        "icd9_categories": f"""{_VIEWS} SELECT encounter_id, diag_1, diag_2, diag_3,
          {cat_columns} FROM enc""",
        "icd9_distribution": f"""{_VIEWS}, c AS (SELECT {cats[1]} AS value FROM enc)
          SELECT value, count(*) AS n,
            round(100.0 * count(*) / (SELECT count(*) FROM c), 2) AS pct FROM c GROUP BY value""",
        "feat_medication_counts": f"{_VIEWS} SELECT encounter_id, {meds} FROM enc",
        "feat_prior_use": f"""{_VIEWS} SELECT encounter_id, {prior(1, 2, 3)} AS prior_healthcare_use,
          {prior(1, 2, 4)} AS prior_utilization_score FROM enc""",
        "feat_comorbidity": f"{_VIEWS} SELECT encounter_id, {comorbid} FROM enc",
        "feat_lab_flags": f"""{_VIEWS} SELECT encounter_id, {lab['A1C_measured']},
          {lab['glu_measured']} FROM enc""",
        "feat_change_flags": f"{_VIEWS} SELECT encounter_id, {flags} FROM enc",
        "feat_all": f"""{_VIEWS} SELECT encounter_id, {meds}, {prior(1, 2, 3)} AS prior_healthcare_use,
          {cat_columns}, {comorbid}, {lab['A1C_measured']}, {lab['glu_measured']}, {flags} FROM enc""",
        "feat_medication_ordinal": f"{_VIEWS} SELECT encounter_id, {ordinal} FROM enc",
        "label_rate_by_diagnosis": f"""{_VIEWS} SELECT {cats[1]} AS diag_1_cat, count(*) AS n,
          round(100.0 * avg(label), 2) AS rate_pct FROM enc
          WHERE discharge_disposition_id NOT IN (11, 13, 14, 19, 20, 21) GROUP BY 1""",
    }


def _source_sql() -> dict[str, str]:
    alive = "discharge_disposition_id NOT IN (11, 13, 14, 19, 20, 21)"
    # The public file's columns; those that the tables have nothing for are NULL.
    from wardlight.sources.encounters import CSV_COLUMNS

    given = {"examide": "'No'", "citoglipton": "'No'", "weight": "NULL"}
    of_enc = {"encounter_id", "patient_nbr", "race", "gender", "age", "admission_type_id",
              "discharge_disposition_id", "admission_source_id", "time_in_hospital", "payer_code",
              "medical_specialty", "num_lab_procedures", "num_procedures", "num_medications",
              "number_outpatient", "number_emergency", "number_inpatient", "diag_1", "diag_2",
              "diag_3", "number_diagnoses", "max_glu_serum", "A1Cresult", "change",
              "diabetesMed", "readmitted", *_MEDS}
    record = ", ".join(
        _q(c) if c in of_enc else f"{given.get(c, 'NULL')} AS {_q(c)}" for c in CSV_COLUMNS)
    cleaned = ("encounter_id, patient_nbr, gender, admission_type_id, discharge_disposition_id, "
               "num_procedures, readmitted, label AS readmitted_30d")
    return {
        "source_encounters_csv": f"{_VIEWS} SELECT {record} FROM enc",
        "source_json_records": f"{_VIEWS} SELECT {record} FROM enc",
        "source_code_table": f"""{_VIEWS} SELECT encounter_id,
          admission_source_id + 3 AS admission_source_id, n_name AS admission_source_id_description
          FROM stays LEFT JOIN nation ON admission_source_id + 3 = n_nationkey + 1""",
        "sink_csv_report": f"""{_VIEWS}, c AS (SELECT attribute, value, {_COUNTS} FROM long_people
          GROUP BY ALL) SELECT attribute, value, {_RATES}, tp, fp, tn, fn FROM c""",
        "sink_json_metrics": f"""{_VIEWS} {_ranked('scored')}, c AS (SELECT {_COUNTS} FROM scored)
          SELECT (SELECT auc_pr FROM (SELECT {_AREAS} FROM ranked)) AS auc_pr,
            (SELECT auc_roc FROM (SELECT {_AREAS} FROM ranked)) AS auc_roc, {_POINT},
            CAST(0.4 AS DOUBLE) AS threshold, tp, fp, tn, fn FROM c""",
        "sink_prediction_log": f"""{_VIEWS} SELECT strftime(admitted, '%Y-%m-%d') AS score_date,
          count(*) AS n, CAST(sum(y_pred) AS BIGINT) AS n_flagged, CAST(sum(CAST(round(score * 100000000) AS BIGINT)) AS BIGINT) AS score_sum
          FROM scored GROUP BY 1""",
        "clean_binarize": f"""{_VIEWS} SELECT encounter_id, readmitted, label AS readmitted_30d
          FROM labelled""",
        "clean_drop_unused": f"""{_VIEWS} SELECT encounter_id, patient_nbr, gender, num_procedures
          FROM stays""",
        "clean_drop_expired": f"""{_VIEWS} SELECT encounter_id, patient_nbr,
          discharge_disposition_id FROM stays WHERE {alive}""",
        "clean_basic": f"{_VIEWS} SELECT {cleaned} FROM labelled WHERE {alive}",
        "clean_roles": f"""{_VIEWS} SELECT label, patient_nbr AS "group", gender,
          admission_type_id, discharge_disposition_id, num_procedures
          FROM labelled WHERE {alive}""",
        "clean_exclusions": f"""{_VIEWS} SELECT count(*) AS n_rows,
          count(*) FILTER (WHERE NOT {alive}) AS n_terminal,
          count(*) FILTER (WHERE gender = 'P') AS n_invalid_gender,
          count(*) FILTER (WHERE NOT {alive} OR gender = 'P') AS n_removed,
          round(100.0 * count(*) FILTER (WHERE NOT {alive} OR gender = 'P') / count(*), 2) AS pct_removed
          FROM stays""",
        "clean_drop_gender": f"""{_VIEWS} SELECT encounter_id, gender FROM stays
          WHERE gender <> 'P'""",
        "clean_group_categories": f"""{_VIEWS}, m AS (
            SELECT concat('Specialty', n_nationkey + 3) AS medical_specialty, r_name
            FROM nation JOIN region ON n_regionkey = r_regionkey)
          SELECT e.encounter_id, e.medical_specialty,
            CASE WHEN e.medical_specialty IS NULL THEN 'Unknown' ELSE coalesce(m.r_name, 'Other') END
              AS specialty_group
          FROM enc e LEFT JOIN m USING (medical_specialty)""",
        "score_align": f"""{_VIEWS} SELECT encounter_id, gender,
          CAST(admission_type_id AS BIGINT) AS admission_type_id, CAST(NULL AS VARCHAR) AS insulin,
          CAST(NULL AS BIGINT) AS number_inpatient FROM stays""",
        "score_threshold": f"""{_VIEWS} SELECT encounter_id,
          CASE WHEN score >= 0.27 THEN 1 ELSE 0 END AS y_pred FROM scored""",
        "join_scores_attributes": f"""{_VIEWS} SELECT race, count(*) AS n,
          CAST(sum(y_pred) AS BIGINT) AS n_flagged FROM scored_people GROUP BY race""",
    }


def _profile_sql() -> dict[str, str]:
    missing = _unions([
        f"SELECT '{c}' AS column_name, count(*) - count({_q(c)}) AS n_missing, "
        f"round(100.0 * (count(*) - count({_q(c)})) / count(*), 2) AS pct_missing FROM enc"
        for c in _PROFILED
    ])
    distinct = _unions([
        f"SELECT '{c}' AS column_name, count(DISTINCT {_q(c)}) AS n_distinct, "
        f"CASE WHEN count(DISTINCT {_q(c)}) = 1 THEN 1 ELSE 0 END AS is_constant FROM enc"
        for c in _PROFILED
    ])
    corr = _unions([
        f"SELECT '{c}' AS column_name, round(corr(CAST({c} AS DOUBLE), label), 6) AS corr FROM enc"
        for c in ("number_inpatient", "number_emergency", "num_medications", "charge")
    ])
    describe = _unions([
        f"""SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean,
          round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS low,
          CAST(max({c}) AS DOUBLE) AS high FROM enc WHERE charge / 1e6 + 0.3 * label < 0.4
            AND label = 1""" for c in ("number_inpatient", "num_medications", "time_in_hospital")
    ])
    rates = _unions([
        f"SELECT '{c}' AS attribute, {c} AS value, count(*) AS n, "
        f"round(100.0 * avg(label), 2) AS rate_pct FROM enc GROUP BY {c}"
        for c in ("race", "age", "gender")
    ])
    top = _unions([
        f"""SELECT * FROM (SELECT '{c}' AS column_name, {c} AS value, count(*) AS n FROM enc
          WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY n DESC, value LIMIT 20)"""
        for c in ("diag_1", "diag_2")
    ])
    return {
        "profile_missing": f"{_VIEWS} SELECT * FROM ({missing}) WHERE n_missing > 0",
        "profile_marker": f"""{_VIEWS}, p AS (SELECT * FROM packed),
          r AS (SELECT count(*) FILTER (WHERE priority = '4-NOT SPECIFIED') AS race,
              count(*) AS n_rows FROM stays),
          s AS (SELECT count(*) FILTER (WHERE c_nationkey % 2 = 0) AS medical_specialty
            FROM stays JOIN customer ON patient_nbr = c_custkey),
          d AS (SELECT count(*) FILTER (WHERE (p1 // 10) % 20 = 3) AS diag_1,
              count(*) FILTER (WHERE (p2 // 10) % 20 = 3) AS diag_2,
              count(*) FILTER (WHERE (p3 // 10) % 20 = 3) AS diag_3
            FROM stays JOIN packed ON encounter_id = l_orderkey),
          w AS (SELECT count(*) AS weight, count(*) - count(payer_code) AS payer_code FROM stays),
          u AS (UNPIVOT (SELECT race, medical_specialty, diag_1, diag_2, diag_3, weight, payer_code
            FROM r, s, d, w) ON * INTO NAME column_name VALUE n_marker)
          SELECT column_name, CAST(n_marker AS BIGINT) AS n_marker,
            round(100.0 * n_marker / (SELECT n_rows FROM r), 2) AS pct_marker FROM u""",
        "profile_value_counts": f"""{_VIEWS} SELECT readmitted AS value, count(*) AS n,
          round(100.0 * count(*) / (SELECT count(*) FROM labelled), 2) AS pct
          FROM labelled GROUP BY readmitted""",
        "profile_rate_by_group": f"{_VIEWS} {rates}",
        "profile_patients": f"""{_VIEWS}, c AS (SELECT patient_nbr, count(*) AS n FROM stays GROUP BY 1)
          SELECT count(*) AS n_patients, CAST(sum(n) AS BIGINT) AS n_encounters,
            count(*) FILTER (WHERE n > 1) AS n_repeat_patients, max(n) AS max_encounters,
            min(n) AS min_encounters, round(avg(n), 6) AS mean_encounters,
            quantile_cont(CAST(n AS DOUBLE), 0.25) AS q1_encounters,
            quantile_cont(CAST(n AS DOUBLE), 0.5) AS median_encounters,
            quantile_cont(CAST(n AS DOUBLE), 0.75) AS q3_encounters,
            round(100.0 * sum(n) FILTER (WHERE n > 1) / sum(n), 2) AS pct_rows_repeat FROM c""",
        "profile_cardinality": f"{_VIEWS} {distinct}",
        "profile_rate_cube": f"""{_VIEWS} SELECT race, age, CAST(grouping_id(race, age) AS BIGINT) AS level,
          count(*) AS n, round(100.0 * avg(label), 2) AS rate_pct FROM enc GROUP BY CUBE (race, age)""",
        "profile_rate_pivot": f"""{_VIEWS} SELECT race,
          round(100.0 * avg(label) FILTER (WHERE gender = 'F'), 2) AS "F",
          round(100.0 * avg(label) FILTER (WHERE gender = 'O'), 2) AS "O",
          round(100.0 * avg(label) FILTER (WHERE gender = 'P'), 2) AS "P" FROM enc GROUP BY race""",
        "profile_top_codes": f"{_VIEWS} {top}",
        "profile_correlation": f"{_VIEWS} {corr}",
        "profile_missed_describe": f"{_VIEWS} {describe}",
        "profile_first_last": f"""{_VIEWS}, r AS (SELECT *, row_number() OVER (PARTITION BY patient_nbr
              ORDER BY admitted, encounter_id) AS up, row_number() OVER (PARTITION BY patient_nbr
              ORDER BY admitted DESC, encounter_id DESC) AS down FROM labelled)
          SELECT 'first' AS which, patient_nbr, encounter_id, readmitted FROM r WHERE up = 1
          UNION ALL SELECT 'last', patient_nbr, encounter_id, readmitted FROM r WHERE down = 1""",
        "profile_first_later": f"""{_VIEWS}, r AS (SELECT label, row_number() OVER (
              PARTITION BY patient_nbr ORDER BY admitted, encounter_id) AS up FROM labelled)
          SELECT CASE WHEN up = 1 THEN 'first' ELSE 'later' END AS visit, count(*) AS n_rows,
            CAST(sum(label) AS BIGINT) AS n_pos, round(100.0 * avg(label), 2) AS rate_pct
          FROM r GROUP BY 1""",
        "profile_repeat_rows": f"""{_VIEWS} SELECT encounter_id, patient_nbr FROM stays
          WHERE patient_nbr IN (SELECT patient_nbr FROM stays GROUP BY 1 HAVING count(*) > 1)""",
        "derive_readmission": f"{_VIEWS} SELECT encounter_id, readmitted FROM labelled",
    }


def _split_sql() -> dict[str, str]:
    side = _side("patient_nbr")
    folds = f""", g AS (SELECT patient_nbr, count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS n_pos
        FROM labelled GROUP BY 1),
      f AS (SELECT *, (row_number() OVER (PARTITION BY n_rows, n_pos
          ORDER BY {_digest('patient_nbr')}, patient_nbr) + n_rows + n_pos) % 5 AS fold FROM g)"""
    return {
        "split_group_holdout": f"""{_VIEWS} SELECT encounter_id, patient_nbr, {side} AS split
          FROM stays""",
        "split_exact_holdout": f"""{_VIEWS}, g AS (SELECT DISTINCT patient_nbr FROM stays),
          r AS (SELECT patient_nbr, row_number() OVER (ORDER BY {_digest('patient_nbr')}, patient_nbr)
            AS place, count(*) OVER () AS n FROM g)
          SELECT s.encounter_id, CASE WHEN place <= ceil(0.2 * n) THEN 'test' ELSE 'train' END AS split
          FROM stays s JOIN r USING (patient_nbr)""",
        "split_summary": f"""{_VIEWS} SELECT {side} AS split, count(*) AS n_rows,
          count(DISTINCT patient_nbr) AS n_groups, CAST(sum(label) AS BIGINT) AS n_pos,
          round(avg(label), 6) AS positive_rate FROM labelled GROUP BY 1""",
        "split_leakage": f"""{_VIEWS}, s AS (SELECT patient_nbr,
            CASE WHEN substr({_digest('encounter_id')}, 1, 8) < '33333333' THEN 'test' ELSE 'train' END
            AS split FROM stays)
          SELECT patient_nbr, count(DISTINCT split) AS n_sides FROM s GROUP BY 1
          HAVING count(DISTINCT split) > 1""",
        "split_shared_groups": f"""{_VIEWS}
          SELECT patient_nbr FROM stays WHERE admitted < TIMESTAMP '1997-01-01'
          INTERSECT SELECT patient_nbr FROM stays WHERE admitted >= TIMESTAMP '2000-01-01'""",
        "split_exact_unknown": f"""{_VIEWS}, visits AS (SELECT encounter_id,
            CASE WHEN encounter_id % 11 <> 0 THEN patient_nbr END AS patient_nbr FROM stays),
          g AS (SELECT DISTINCT patient_nbr FROM visits WHERE patient_nbr IS NOT NULL),
          r AS (SELECT patient_nbr, row_number() OVER (ORDER BY {_digest('patient_nbr')}, patient_nbr)
            AS place, count(*) OVER () AS n FROM g)
          SELECT encounter_id, patient_nbr,
            CASE WHEN place <= ceil(0.2 * n) THEN 'test' ELSE 'train' END AS split
          FROM visits LEFT JOIN r USING (patient_nbr)""",
        "split_shared_unknown": f"""{_VIEWS}, visits AS (SELECT encounter_id, patient_nbr, admitted
            FROM stays WHERE encounter_id % 11 <> 0)
          SELECT patient_nbr, 'shared' AS kind FROM visits GROUP BY patient_nbr
          HAVING count(*) FILTER (admitted < TIMESTAMP '1997-01-01') > 0
            AND count(*) FILTER (admitted >= TIMESTAMP '1997-01-01') > 0
          UNION ALL SELECT patient_nbr, 'leaking' FROM visits GROUP BY patient_nbr
          HAVING count(DISTINCT encounter_id % 3 = 0) > 1""",
        "sample_first_unknown": f"""{_VIEWS}, visits AS (SELECT encounter_id, admitted,
            CASE WHEN encounter_id % 11 <> 0 THEN patient_nbr END AS patient_nbr FROM stays)
          SELECT encounter_id, patient_nbr FROM visits WHERE patient_nbr IS NULL
          UNION ALL (SELECT encounter_id, patient_nbr FROM visits WHERE patient_nbr IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY patient_nbr ORDER BY admitted, encounter_id) = 1)""",
        "cv_group_folds": f"""{_VIEWS} {folds} SELECT patient_nbr, n_rows, n_pos,
          CAST(fold AS BIGINT) AS fold FROM f""",
        "cv_assigned_folds": f"""{_VIEWS} {folds} SELECT fold, count(*) AS n_rows,
          count(DISTINCT patient_nbr) AS n_groups, CAST(sum(label) AS BIGINT) AS n_pos
          FROM (SELECT l.*, CAST(f.fold AS BIGINT) AS fold FROM labelled l JOIN f USING (patient_nbr))
          GROUP BY fold""",
        "cv_hash_folds": f"""{_VIEWS} SELECT encounter_id,
          CAST(concat('0x', substr({_digest('patient_nbr')}, 1, 8)) AS BIGINT) % 5 AS fold
          FROM stays""",
        "sample_undersample": f"""{_VIEWS} SELECT encounter_id, label FROM labelled
          WHERE label = 1 OR substr({_digest('encounter_id')}, 1, 8) < '40000000'""",
        "sample_first_encounter": f"""{_VIEWS} SELECT patient_nbr, encounter_id FROM stays
          QUALIFY row_number() OVER (PARTITION BY patient_nbr ORDER BY admitted, encounter_id) = 1""",
        "sample_hash": f"""{_VIEWS} SELECT encounter_id, patient_nbr FROM stays
          ORDER BY {_digest('encounter_id', 0)}, encounter_id LIMIT 200""",
        "prepare_data": f"""{_VIEWS} SELECT encounter_id, label, patient_nbr AS "group",
          {side} AS split, race, age, diag_1, num_medications FROM enc
          WHERE discharge_disposition_id NOT IN (11, 13, 14, 19, 20, 21)""",
    }


def _metric_sql(cuts: list[float]) -> dict[str, str]:
    report = f"""{_VIEWS} {_ranked('scored')}, a AS (SELECT {_AREAS} FROM ranked),
      c AS (SELECT {_COUNTS} FROM scored)
      SELECT auc_roc, auc_pr, {_POINT}, CAST(0.4 AS DOUBLE) AS threshold, tp, fp, tn, fn FROM a, c"""
    curve = _curve("scored", cuts)
    return {
        "metric_confusion": f"{_VIEWS} SELECT {_COUNTS} FROM scored",
        "metric_auc_roc": f"""{_VIEWS} {_ranked('scored')}
          SELECT auc_roc FROM (SELECT {_AREAS} FROM ranked)""",
        "metric_auc_pr": f"""{_VIEWS} {_ranked('scored')}
          SELECT auc_pr FROM (SELECT {_AREAS} FROM ranked)""",
        "metric_ap_evaluator": f"""{_VIEWS} {_ranked('scored')}
          SELECT auc_pr FROM (SELECT {_AREAS} FROM ranked)""",
        "metric_report": report,
        "metric_at_thresholds": f"""{_VIEWS}, t(threshold) AS (VALUES (CAST(0.1 AS DOUBLE)),
            (CAST(0.27 AS DOUBLE)), (CAST(0.5 AS DOUBLE)), (CAST(0.75 AS DOUBLE))),
          c AS (SELECT threshold,
            count(*) FILTER (WHERE label = 1 AND score >= threshold) AS tp,
            count(*) FILTER (WHERE label = 0 AND score >= threshold) AS fp,
            count(*) FILTER (WHERE label = 0 AND score < threshold) AS tn,
            count(*) FILTER (WHERE label = 1 AND score < threshold) AS fn
            FROM scored, t GROUP BY threshold)
          SELECT threshold, tp, fp, tn, fn, {_POINT},
            {_r(_div("10 * tp", "10 * tp + 9 * fn + fp", "0"), "f3")} FROM c""",
        "metric_histogram": f"""{_VIEWS}, b AS (SELECT least(19, CAST(floor(score2 * 20) AS BIGINT)) AS bin
            FROM (SELECT score AS score2 FROM scored))
          SELECT bin, round(bin / 20.0, 6) AS low, round((bin + 1) / 20.0, 6) AS high,
            count(*) AS n, round(count(*) / CAST((SELECT count(*) FROM b) AS DOUBLE), 6) AS share
          FROM b GROUP BY bin""",
        "metric_calibration": f"""{_VIEWS}, b AS (SELECT least(9, CAST(floor(score2 * 10) AS BIGINT)) AS bin,
            score2 AS score, label FROM (SELECT score AS score2, label FROM scored))
          SELECT bin, count(*) AS n, round(avg(score), 6) AS mean_score,
            round(avg(label), 6) AS observed_rate, round(avg(label) - avg(score), 6) AS gap
          FROM b GROUP BY bin""",
        "curve_roc": f"""{_VIEWS} {_ranked('scored')}
          SELECT CAST(round(score * 100000000) AS BIGINT) AS threshold, CAST(fp AS DOUBLE) / n_neg AS fpr,
            CAST(tp AS DOUBLE) / n_pos AS tpr FROM ranked
          UNION ALL SELECT -1, 0, 0""",
        "curve_pr": f"""{_VIEWS} {_ranked('scored')}
          SELECT CAST(round(score * 100000000) AS BIGINT) AS threshold, CAST(tp AS DOUBLE) / (tp + fp) AS precision,
            CAST(tp AS DOUBLE) / n_pos AS recall FROM ranked
          UNION ALL SELECT -1, 1, 0""",
        "prefix_running_total": f"""{_VIEWS} {_ranked('scored_people', 'score', 'gender')}
          SELECT gender, CAST(round(score * 100000000) AS BIGINT) AS score, pos, neg, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
            CAST(n_pos AS BIGINT) AS n_pos, CAST(n_neg AS BIGINT) AS n_neg FROM ranked""",
        "compare_models": f"""{_VIEWS}, both_models AS (
            SELECT 'exact' AS model, score, label, y_pred FROM scored
            UNION ALL SELECT 'rounded', score2, label, CASE WHEN score2 >= 0.4 THEN 1 ELSE 0 END FROM rounded)
          {_ranked('both_models', 'score', 'model')},
          a AS (SELECT model, {_AREAS} FROM ranked GROUP BY model),
          c AS (SELECT model, {_COUNTS} FROM both_models GROUP BY model)
          SELECT model, auc_roc, auc_pr, {_POINT}, CAST(0.4 AS DOUBLE) AS threshold, tp, fp, tn, fn
          FROM a JOIN c USING (model)""",
        "threshold_cost_at": f"""{_VIEWS} {_curve('scored', [0.27])}
          SELECT threshold, cost, tp, fp, tn, fn FROM curve""",
        "threshold_cost_curve": f"""{_VIEWS} {curve}
          SELECT round(threshold, 6) AS threshold, cost, tp, fp, tn, fn FROM curve""",
        "threshold_optimum": f"""{_VIEWS} {curve}, best AS (SELECT * FROM curve ORDER BY cost, threshold LIMIT 1)
          SELECT round(threshold, 6) AS optimal_threshold, cost AS optimal_cost,
            {_r(_div("tp", "tp + fn", "0"), "optimal_recall")},
            {_r(_div("tp", "tp + fp", "0"), "optimal_precision")},
            {_r(_div("2 * tp", "2 * tp + fn + fp", "0"), "optimal_f1")}, tp, fp, tn, fn FROM best""",
        "rank_capacity": f"""{_VIEWS}, r AS (SELECT encounter_id, row_number() OVER (
            ORDER BY score DESC, encounter_id) AS place, count(*) OVER () AS n FROM scored)
          SELECT encounter_id, CASE WHEN place <= floor(CAST(0.15 AS DOUBLE) * n) THEN 1 ELSE 0 END AS flagged
          FROM r""",
        "rank_capacity_by_unit": f"""{_VIEWS}, r AS (SELECT encounter_id, admission_type_id, row_number() OVER (
            PARTITION BY admission_type_id ORDER BY score DESC, encounter_id) AS place,
            count(*) OVER (PARTITION BY admission_type_id) AS n FROM scored)
          SELECT encounter_id, admission_type_id,
            CASE WHEN place <= floor(CAST(0.15 AS DOUBLE) * n) THEN 1 ELSE 0 END AS flagged FROM r""",
        "monitor_ks": f"""WITH half AS (SELECT value, event_type,
              CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 0 ELSE 1 END AS side FROM events),
            pairs AS (SELECT 'value' AS column_name, CAST(value AS DOUBLE) AS value, side FROM half
              UNION ALL SELECT 'type_length', CAST(length(event_type) AS DOUBLE), side FROM half),
            d AS (SELECT column_name, value, count(*) FILTER (WHERE side = 0) AS a,
              count(*) FILTER (WHERE side = 1) AS b FROM pairs WHERE value IS NOT NULL GROUP BY ALL),
            f AS (SELECT column_name, abs(sum(a) OVER w / CAST(sum(a) OVER p AS DOUBLE)
                - sum(b) OVER w / CAST(sum(b) OVER p AS DOUBLE)) AS gap,
              sum(a) OVER p AS n_reference, sum(b) OVER p AS n_current FROM d
              WINDOW w AS (PARTITION BY column_name ORDER BY value ROWS UNBOUNDED PRECEDING),
                p AS (PARTITION BY column_name))
          SELECT column_name, round(max(gap), 6) AS ks, CAST(max(n_reference) AS BIGINT) AS n_reference,
            CAST(max(n_current) AS BIGINT) AS n_current,
            CASE WHEN max(gap) > 0.15 THEN 1 ELSE 0 END AS alert FROM f GROUP BY column_name""",
        "monitor_ks_split": f"""{_VIEWS}, pairs AS (
            SELECT 'num_medications' AS column_name, CAST(num_medications AS DOUBLE) AS value,
              {_side('patient_nbr')} AS side FROM enc
            UNION ALL SELECT 'charge', charge, {_side('patient_nbr')} FROM enc),
            d AS (SELECT column_name, value, count(*) FILTER (WHERE side = 'train') AS a,
              count(*) FILTER (WHERE side = 'test') AS b FROM pairs WHERE value IS NOT NULL GROUP BY ALL),
            f AS (SELECT column_name, abs(sum(a) OVER w / CAST(sum(a) OVER p AS DOUBLE)
                - sum(b) OVER w / CAST(sum(b) OVER p AS DOUBLE)) AS gap,
              sum(a) OVER p AS n_reference, sum(b) OVER p AS n_current FROM d
              WINDOW w AS (PARTITION BY column_name ORDER BY value ROWS UNBOUNDED PRECEDING),
                p AS (PARTITION BY column_name))
          SELECT column_name, round(max(gap), 6) AS ks, CAST(max(n_reference) AS BIGINT) AS n_reference,
            CAST(max(n_current) AS BIGINT) AS n_current,
            CASE WHEN max(gap) > 0.15 THEN 1 ELSE 0 END AS alert FROM f GROUP BY column_name""",
    }


def _fairness_sql(cuts: list[float]) -> dict[str, str]:
    counts = f""", c AS (SELECT attribute, value, {_COUNTS} FROM long_people GROUP BY ALL)"""
    rates = f""", r AS (SELECT attribute, value, {_RATES} FROM c)"""
    exact = f""", x AS (SELECT attribute,
        {_div("tp + fp", "tp + fp + tn + fn")} AS sel, {_div("tp", "tp + fn", "0")} AS tpr,
        {_div("fp", "tn + fp", "0")} AS fpr, {_div("tp", "tp + fp")} AS ppv FROM c)"""
    gaps = """SELECT attribute, round(max(sel) - min(sel), 6) AS demographic_parity_gap,
        round(greatest(max(tpr) - min(tpr), max(fpr) - min(fpr)), 6) AS equalized_odds_gap,
        round(max(ppv) - min(ppv), 6) AS predictive_parity_gap, count(*) AS n_groups
      FROM x GROUP BY attribute"""
    per_group = f"""{_curve('scored_people', cuts, 'gender')},
      overall AS (SELECT CAST(count(*) FILTER (WHERE label = 1 AND y_pred = 1) AS DOUBLE)
        / count(*) FILTER (WHERE label = 1) AS target FROM scored_people),
      best AS (SELECT curve.* FROM curve, overall QUALIFY row_number() OVER (PARTITION BY gender ORDER BY
        round(CASE WHEN tp + fn > 0 THEN abs(CAST(tp AS DOUBLE) / (tp + fn) - target) ELSE 0 END, 12),
        cost, threshold) = 1)"""
    weights = """, j AS (SELECT coalesce(race, 'Unknown') AS value, label, count(*) AS n_joint
        FROM scored_people GROUP BY ALL),
      k AS (SELECT *, sum(n_joint) OVER (PARTITION BY value) AS n_value,
        sum(n_joint) OVER (PARTITION BY label) AS n_label, sum(n_joint) OVER () AS n_total FROM j)"""
    return {
        "fair_report": f"{_VIEWS} {counts} SELECT attribute, value, {_RATES}, tp, fp, tn, fn FROM c",
        "fair_report_custom": f"""{_VIEWS} SELECT attribute, value, count(*) AS count,
          round(avg(CAST(label = y_pred AS INTEGER)), 6) AS accuracy
          FROM long_people GROUP BY ALL""",
        "fair_report_documents": f"""{_VIEWS}, l AS (
            SELECT 'lang' AS attribute, lang AS value, label, y_pred FROM scored_docs
            UNION ALL SELECT 'source', source, label, y_pred FROM scored_docs),
          c AS (SELECT attribute, coalesce(value, 'Unknown') AS value, {_COUNTS} FROM l GROUP BY ALL)
          SELECT attribute, value, {_RATES}, tp, fp, tn, fn FROM c""",
        "fair_report_drop_null": f"""{_VIEWS}, c AS (SELECT 'race' AS attribute, race AS value, {_COUNTS}
          FROM scored_people WHERE race IS NOT NULL GROUP BY ALL)
          SELECT attribute, value, {_RATES}, tp, fp, tn, fn FROM c""",
        "fair_intersection": f"""{_VIEWS}, c AS (SELECT coalesce(race, 'Unknown') AS race, age, {_COUNTS}
          FROM scored_people GROUP BY ALL) SELECT race, age, {_RATES} FROM c""",
        "fair_intersection_filled": f"""{_VIEWS}, c AS (SELECT lang, source, {_COUNTS}
            FROM scored_docs GROUP BY ALL), r AS (SELECT lang, source, {_RATES} FROM c)
          SELECT * FROM (SELECT DISTINCT lang FROM c) CROSS JOIN (SELECT DISTINCT source FROM c)
            LEFT JOIN r USING (lang, source)""",
        "fair_gaps": f"{_VIEWS} {counts} {exact} {gaps}",
        "fair_over_alerting": f"""{_VIEWS} {counts}, a AS (SELECT *, tp + fp + tn + fn AS n FROM c)
          SELECT attribute, value, n AS count, round(CAST(tp + fn AS DOUBLE) / n, 6) AS base_rate,
            round(CAST(tp + fp AS DOUBLE) / n, 6) AS selection_rate,
            round((CAST(tp + fp AS DOUBLE) / n) / nullif(CAST(tp + fn AS DOUBLE) / n, 0), 6) AS alert_ratio
          FROM a""",
        "fair_subgroup_areas": f"""{_VIEWS} {_ranked('long_people', 'score', 'attribute, value')}
          SELECT attribute, value, {_AREAS} FROM ranked GROUP BY ALL""",
        "fair_missed_positives": f"""{_VIEWS} {counts} SELECT attribute, value, tp + fn AS n_positive,
          fn AS n_missed, {_r(_div("fn", "tp + fn"), "missed_share")} FROM c""",
        "fair_group_thresholds": f"""{_VIEWS} {per_group}
          SELECT gender, round(threshold, 6) AS threshold, cost, tp, fp, tn, fn FROM best""",
        "fair_group_thresholds_applied": f"""{_VIEWS} {per_group},
          l AS (SELECT s.gender AS value, s.label, CASE WHEN s.score >= b.threshold THEN 1 ELSE 0 END AS y_pred
            FROM scored_people s JOIN best b USING (gender)),
          c AS (SELECT 'gender' AS attribute, value, {_COUNTS} FROM l GROUP BY ALL) {exact} {gaps}""",
        "fair_reweighting": f"""{_VIEWS} {weights} SELECT value, label, n_joint,
          CAST(n_value AS BIGINT) AS n_value, CAST(n_label AS BIGINT) AS n_label,
          CAST(n_total AS BIGINT) AS n_total,
          round(CAST(n_value AS DOUBLE) * n_label / (CAST(n_total AS DOUBLE) * n_joint), 6) AS weight FROM k""",
        "fair_weighted_rates": f"""{_VIEWS} {weights},
          w AS (SELECT value, label, n_joint,
            CAST(n_value AS DOUBLE) * n_label / (CAST(n_total AS DOUBLE) * n_joint) AS weight FROM k)
          SELECT value, round(sum(weight * n_joint * label) / sum(weight * n_joint), 6) AS weighted_rate,
            CAST(sum(n_joint) AS BIGINT) AS n FROM w GROUP BY value""",
        "ml_class_weights": f"""{_VIEWS} SELECT label, count(*) AS n,
          round((SELECT count(*) FROM labelled) / (2.0 * count(*)), 6) AS weight
          FROM labelled GROUP BY label""",
        "ml_score_spellings": f"""{_VIEWS} SELECT spelling, count(*) AS n_rows,
            CAST(0 AS BIGINT) AS n_different
          FROM enc, (VALUES ('NULL'), ('?'), ('None'), ('NA'), (' ')) s(spelling)
          WHERE discharge_disposition_id NOT IN (11, 13, 14, 19, 20, 21)
            AND {_side('patient_nbr')} = 'test' GROUP BY spelling""",
        "ml_models_scored": f"""{_VIEWS} SELECT model, count(*) AS n_rows,
            CAST(0 AS BIGINT) AS n_outside
          FROM enc, (VALUES ('LogReg'), ('RandomForest'), ('BoostedTrees')) m(model)
          WHERE discharge_disposition_id NOT IN (11, 13, 14, 19, 20, 21)
            AND {_side('patient_nbr')} = 'test' GROUP BY model""",
        "ml_save_load": f"""{_VIEWS} SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_different FROM enc
          WHERE discharge_disposition_id NOT IN (11, 13, 14, 19, 20, 21)
            AND {_side('patient_nbr')} = 'test'""",
    }


def _model_sql() -> dict[str, str]:
    """What is certain about fitted models: rows, sizes, order, and sums of labels."""
    from wardlight.plans import catalog

    rows = f"""{_VIEWS}, usable AS (
        SELECT *, {_side('patient_nbr')} AS split FROM enc
        WHERE discharge_disposition_id NOT IN (11, 13, 14, 19, 20, 21)),
      sizes AS (SELECT count(*) FILTER (split = 'train') AS n_train,
        count(*) FILTER (split = 'test') AS n_holdout, CAST(0 AS BIGINT) AS n_outside,
        CAST(sum(label) FILTER (split = 'test') AS BIGINT) AS n_pos FROM usable),
      g AS (SELECT patient_nbr, count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS n_pos
        FROM usable WHERE split = 'train' GROUP BY 1),
      folds AS (SELECT patient_nbr, (row_number() OVER (PARTITION BY n_rows, n_pos
        ORDER BY {_digest('patient_nbr')}, patient_nbr) + n_rows + n_pos)
        % {catalog.TUNING.folds} AS fold FROM g)"""
    grid = catalog.TUNING.grids
    points = [(m, str(p)) for m in catalog.TUNING.models for p in catalog.tuning.grid_points(grid[m])]
    listed = ", ".join("('{}', '{}')".format(m, p.replace("'", "''")) for m, p in points)
    per_model = ", ".join(f"('{m}', {sum(n == m for n, _ in points)})" for m in catalog.TUNING.models)

    def trees(n: int) -> str:
        return f"""{rows} SELECT n_train, n_holdout, n_outside, CAST({n} AS BIGINT) AS n_trees,
          CAST(1 AS DOUBLE) AS importances FROM sizes"""

    top = "SELECT CAST(unnest(range(20)) AS BIGINT) AS place, TRUE AS in_order, TRUE AS known"

    def groups(attributes: dict[str, str]) -> str:
        return rows + _unions([
            f"""SELECT '{a}' AS attribute, coalesce({a}, 'Unknown') AS value, count(*) AS count,
              round(avg(label), 6) AS base_rate, {is_input} AS is_input
            FROM usable WHERE split = 'test' GROUP BY ALL""" for a, is_input in attributes.items()])

    unused = ("encounter_id, patient_nbr, readmitted, label, weight, payer_code, examide, "
              "citoglipton, admitted, charge, score, priority, next_admitted")
    return {
        "ml_logistic_regression":
            f"{rows} SELECT n_train, n_holdout, n_outside, TRUE AS optimal FROM sizes",
        "ml_random_forest": trees(catalog.FOREST["n_estimators"]),
        "ml_boosted_trees": trees(catalog.BOOST["n_estimators"]),
        "ml_predict_risk": f"""{_VIEWS} SELECT encounter_id, race, TRUE AS in_range,
          TRUE AS agrees FROM enc""",
        "ml_example_record": "SELECT CAST(1 AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_outside",
        "ml_top_coefficients": top, "ml_top_importances": top,
        "ml_permutation_importance": f"""{rows}, names AS (
            SELECT column_name AS feature FROM (DESCRIBE SELECT * FROM usable))
          SELECT feature, TRUE AS same_base, TRUE AS is_drop, TRUE AS has_deviation FROM names
          WHERE feature NOT IN ({", ".join(f"'{c.strip()}'" for c in unused.split(","))}, 'split')""",
        "ml_tune_models": f"""{rows} SELECT model, n_points,
            CAST({catalog.TUNING.folds} AS BIGINT) AS n_folds, n_points * n_train AS n_scores,
            n_train AS n_out_of_fold, TRUE AS best_is_best
          FROM sizes, (VALUES {per_model}) m(model, n_points)""",
        "ml_cv_results": f"""{rows} SELECT model, params, fold, count(*) AS n_rows,
            CAST(sum(label) AS BIGINT) AS n_pos, TRUE AS same_area
          FROM usable JOIN folds USING (patient_nbr), (VALUES {listed}) p(model, params)
          GROUP BY model, params, fold""",
        "ml_select_best": f"""SELECT CAST(unnest(range({len(catalog.TUNING.models)})) AS BIGINT)
          AS place, TRUE AS in_order, TRUE AS chosen_first""",
        "ml_ablation": """SELECT configuration, TRUE AS in_range FROM (VALUES ('LogReg'),
          ('LogReg balanced'), ('RandomForest balanced')) c(configuration)""",
        "ml_exclude_protected": groups({"race": "FALSE", "age": "FALSE"}),
        "ml_reweighted": groups({"race": "TRUE"}),
        "ml_calibrated": f"""{rows} SELECT n_holdout, CAST(0 AS BIGINT) AS n_falls,
          TRUE AS mean_kept FROM sizes""",
        "ml_training_run": f"""{rows} SELECT kind, n_holdout AS n, n_pos, TRUE AS from_counts
          FROM sizes, (VALUES ('LogReg'), ('RandomForest'), ('optimal')) k(kind)""",
    }


def _stream_sql() -> dict[str, str]:
    start = "CAST(epoch(admitted) AS BIGINT) // 2592000"
    closed = f"""w AS (SELECT *, {start} AS slot FROM scored),
      m AS (SELECT CAST(epoch(max(admitted)) AS BIGINT) - 86400 AS mark FROM scored)"""
    return {
        "stream_monitor": f"""{_VIEWS}, {closed}
          SELECT slot * 2592000 AS window_start, count(*) AS n, round(avg(score), 6) AS mean_score,
            round(avg(y_pred), 6) AS alert_rate,
            round(avg(CASE WHEN payer_code IS NULL THEN 1 ELSE 0 END), 6) AS missing_payer_code
          FROM w, m GROUP BY slot, mark HAVING (slot + 1) * 2592000 <= mark""",
        "stream_fairness": f"""{_VIEWS}, {closed},
          c AS (SELECT slot, 'gender' AS attribute, gender AS value, {_COUNTS} FROM w, m
            WHERE (slot + 1) * 2592000 <= mark GROUP BY ALL),
          x AS (SELECT slot, attribute, {_div("tp + fp", "tp + fp + tn + fn")} AS sel,
            {_div("tp", "tp + fn", "0")} AS tpr, {_div("fp", "tn + fp", "0")} AS fpr,
            {_div("tp", "tp + fp")} AS ppv FROM c)
          SELECT slot * 2592000 AS window_start, attribute,
            round(max(sel) - min(sel), 6) AS demographic_parity_gap,
            round(greatest(max(tpr) - min(tpr), max(fpr) - min(fpr)), 6) AS equalized_odds_gap,
            round(max(ppv) - min(ppv), 6) AS predictive_parity_gap, count(*) AS n_groups
          FROM x GROUP BY slot, attribute""",
        "stream_prediction_log": f"""{_VIEWS} SELECT strftime(admitted, '%Y-%m-%d') AS score_date,
          count(*) AS n, count(*) AS n_records, CAST(0 AS BIGINT) AS n_different
          FROM stays GROUP BY 1""",
        "stream_drift": f"""{_VIEWS}, {closed}, vals AS (
            SELECT slot, admitted, 'charge' AS column_name, CAST(charge AS DOUBLE) AS value FROM w
            UNION ALL SELECT slot, admitted, 'num_procedures', CAST(num_procedures AS DOUBLE) FROM w
          ), windows AS (
            SELECT slot, column_name, count(*) AS n FROM vals, m
            WHERE (slot + 1) * 2592000 <= mark GROUP BY ALL
          ), sides AS (
            SELECT slot, column_name, value, 1 AS new FROM vals JOIN windows USING (slot, column_name)
            UNION ALL SELECT windows.slot, column_name, value, 0 FROM vals
              JOIN windows USING (column_name) WHERE admitted < TIMESTAMP '1997-01-01'
          ), upto AS (
            SELECT slot, column_name, value, sum(new) AS a, count(*) - sum(new) AS b
            FROM sides GROUP BY ALL
          ), ks AS (
            SELECT slot, column_name, abs(sum(a) OVER (p ORDER BY value) / sum(a) OVER p
              - sum(b) OVER (p ORDER BY value) / sum(b) OVER p) AS apart
            FROM upto WINDOW p AS (PARTITION BY slot, column_name)
          )
          SELECT slot * 2592000 AS window_start, column_name, any_value(n) AS n,
            CASE WHEN max(apart) > 0.15 THEN 1 ELSE 0 END AS alert
          FROM ks JOIN windows USING (slot, column_name) GROUP BY slot, column_name""",
    }


def statements() -> dict[str, str]:
    """SQL per query name."""
    from wardlight.operators.threshold import threshold_grid

    cuts = threshold_grid(200)
    return (
        _source_sql() | _feature_sql() | _encoder_sql() | _profile_sql() | _split_sql()
        | _metric_sql(cuts) | _fairness_sql(cuts) | _model_sql() | _stream_sql()
    )
