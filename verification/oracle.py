"""SQL with the same results as the registered queries, written independently of the library's expressions."""

from __future__ import annotations

from verification.inputs import THRESHOLDS, query, rounded_sql

#: Resamples: of the row weights themselves and of classes drawn by row, and of everything else, as in a real run.
REPLICATES = 20
FULL_REPLICATES = 1000
SEED = 7
ORACLE: dict[str, str] = {}

THRESHOLD_VALUES = "(VALUES " + ", ".join(f"({t}::DOUBLE)" for t in THRESHOLDS) + ") t(threshold)"
NUMERIC = ("rsq", "mape", "rmse")
CLASS = ("sens", "spec", "ppv", "npv", "accuracy", "f_meas")


def add(name: str, *parts: str, body: str, extra: dict[str, str] | None = None, doubles: str = "", digits: int = 6) -> None:
    text = query(*parts, body=body, extra=extra)
    ORACLE[name] = rounded_sql(doubles, text, digits) if doubles else text


# ---- building blocks -------------------------------------------------------------------------------------------

NUMERIC_POINT = {
    "numeric_wide": """SELECT CASE WHEN grouping(v."GIA") = 1 THEN 'Overall' ELSE v."GIA" END AS "GIA",
        power(corr(lpa_nmol_max, lpa_pred_nm), 2) AS rsq,
        avg(abs((lpa_nmol_max - lpa_pred_nm) / lpa_nmol_max)) * 100 AS mape,
        sqrt(avg(power(lpa_nmol_max - lpa_pred_nm, 2))) AS rmse
        FROM valid v GROUP BY GROUPING SETS ((v."GIA"), ())""",
}


def confusion(source: str, weight: str, keys: str) -> str:
    """tp, fp, tn, fn of a table with boolean true_class and pred_class."""
    cells = {
        "tp": "true_class AND pred_class",
        "fp": "NOT true_class AND pred_class",
        "tn": "NOT true_class AND NOT pred_class",
        "fn": "true_class AND NOT pred_class",
    }
    sums = ", ".join(f"sum(CASE WHEN {c} THEN {weight} ELSE 0 END)::BIGINT AS {n}" for n, c in cells.items())
    return f"SELECT {keys}, {sums} FROM {source}"


CLASS_FORMULAS = """
    CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END AS sens,
    CASE WHEN tn + fp > 0 THEN tn / (tn + fp) END AS spec,
    CASE WHEN tp + fp > 0 AND tp + fn > 0 AND tn + fp > 0 THEN tp / (tp + fp) END AS ppv,
    CASE WHEN tn + fn > 0 AND tp + fn > 0 AND tn + fp > 0 THEN tn / (tn + fn) END AS npv,
    (tp + tn) / (tp + fp + tn + fn) AS accuracy,
    CASE WHEN tp > 0 THEN 2 * tp / (2 * tp + fp + fn) END AS f_meas"""

CLASS_ROWS = f"""SELECT v."ID", v."GIA", threshold, lpa_nmol_max > threshold AS true_class,
    lpa_pred_nm > threshold AS pred_class,
    coalesce(v."GIA", 'NA') || '_' || upper((lpa_nmol_max > threshold)::VARCHAR) || '_' || (threshold::INT)::VARCHAR AS strata
    FROM valid v CROSS JOIN {THRESHOLD_VALUES}"""

CLASS_POINT = {
    "class_rows": CLASS_ROWS,
    "class_counts": confusion(
        "class_rows c GROUP BY GROUPING SETS ((c.\"GIA\", threshold), (threshold))", "1",
        """CASE WHEN grouping(c."GIA") = 1 THEN 'Overall' ELSE c."GIA" END AS "GIA", threshold""",
    ),
    "class_wide": f"""SELECT "GIA", threshold, {CLASS_FORMULAS} FROM class_counts""",
}


def long(source: str, keys: str, names: tuple[str, ...], value: str) -> str:
    """One row per key and column."""
    return " UNION ALL ".join(f"SELECT {keys}, '{n}' AS metric, {n}::DOUBLE AS {value} FROM {source}" for n in names)


NO_CI = "NULL::DOUBLE AS sd, NULL::DOUBLE AS lower_ci, NULL::DOUBLE AS upper_ci"
METRIC_DOUBLES = "estimate sd lower_ci upper_ci"
NUMERIC_LONG = {**NUMERIC_POINT, "numeric_long": f"""SELECT *, {NO_CI} FROM ({long('numeric_wide', '"GIA"', NUMERIC, 'estimate')})"""}
CLASS_LONG = {**CLASS_POINT, "class_long": f"""SELECT *, {NO_CI} FROM ({long('class_wide', '"GIA", threshold', CLASS, 'estimate')})"""}
METRICS = {
    **NUMERIC_LONG,
    **CLASS_LONG,
    "metrics": """SELECT "GIA", NULL::DOUBLE AS threshold, metric, estimate, sd, lower_ci, upper_ci, 'Numeric' AS metric_type
        FROM numeric_long UNION ALL
        SELECT "GIA", threshold, metric, estimate, sd, lower_ci, upper_ci, 'Classification' FROM class_long""",
}
GROUP_SIZES = {
    "sizes": """SELECT CASE WHEN grouping(v."GIA") = 1 THEN 'Overall' ELSE v."GIA" END AS "GIA", count(*)::BIGINT AS pop_size
        FROM valid v GROUP BY GROUPING SETS ((v."GIA"), ())""",
}


def order_of(source: str) -> dict[str, str]:
    return {
        "ordering": f"""SELECT "GIA", n, row_number() OVER (ORDER BY coalesce("GIA" = 'Other', false), n DESC, "GIA" NULLS LAST)
            AS ord FROM (SELECT s."GIA", count(*)::BIGINT AS n FROM {source} s GROUP BY s."GIA")"""
    }


ORDER_OF_VALID = order_of("valid")
ORD = """CASE WHEN x."GIA" = 'Overall' THEN 0 ELSE o.ord END::BIGINT AS ord"""


# ---- resampling ------------------------------------------------------------------------------------------------


def draw60(*parts: str) -> str:
    return f"('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 15))::BIGINT"


def mix(source: str, z: str, keep: str, out: str) -> str:
    """The 64-bit finaliser of column expression ``z``."""
    modulus = "'18446744073709551616'::UHUGEINT"
    return f"""SELECT {keep}, xor(m4, m4 >> 31) AS {out} FROM (
        SELECT {keep}, ((xor(m2, m2 >> 27)::UHUGEINT * 10723151780598845931::UHUGEINT) % {modulus})::UBIGINT AS m4 FROM (
        SELECT {keep}, ((xor(m0, m0 >> 30)::UHUGEINT * 13787848793156543929::UHUGEINT) % {modulus})::UBIGINT AS m2 FROM (
        SELECT {keep}, (({z}) % {modulus})::UBIGINT AS m0 FROM {source})))"""


def strata(rows: str, level: str) -> dict[str, str]:
    """Levels with at least a tenth of the rows are strata, other rows are spread over them by their id."""
    pick = draw60(f"'{SEED}'", "'pool'", """coalesce("ID"::VARCHAR, 'NA')""")
    return {
        "b_rows": rows,
        "b_names": f"""SELECT list({level} ORDER BY {level}) AS names FROM (SELECT {level}, count(*) AS c FROM b_rows GROUP BY {level})
            WHERE {level} IS NOT NULL AND c / (SELECT count(*) FROM b_rows) >= 0.1::DOUBLE""",
        "b_strata": f"""SELECT r.*, CASE WHEN names IS NULL THEN 'all' WHEN list_contains(names, {level}) THEN {level}
            ELSE names[1 + ({pick}) % len(names)] END AS stratum FROM b_rows r, b_names""",
    }


def index(keys: list[tuple[str, bool]], y: str, x: str) -> dict[str, str]:
    """Positions of the rows in their stratum; ``keys`` are (name, is numeric)."""

    def text(name: str, numeric: bool) -> str:
        return f"coalesce({f'{name}::DECIMAL(38,6)' if numeric else name}::VARCHAR, 'NA')"

    names = ", ".join(n for n, _ in keys)
    content = f"stratum, {names}, {y}, {x}"
    tag = ", ".join(["stratum", *[text(n, num) for n, num in keys], text(y, True), text(x, True)])
    return {
        "b_cells": f"SELECT {content}, count(*)::BIGINT AS copies FROM b_strata GROUP BY {content}",
        "b_index": f"""SELECT {content}, copies, (sum(copies) OVER (PARTITION BY stratum ORDER BY tag, {y}, {x}, {names}
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - copies)::BIGINT AS start
            FROM (SELECT *, md5(concat_ws('|', {tag})) AS tag FROM b_cells)""",
    }


#: The sum of the terms of a Poisson distribution with a rate of 1 at most stops growing before this one.
_CUTOFFS = 22


def weights(keys: list[tuple[str, bool]], y: str, x: str, replicates: int = REPLICATES) -> dict[str, str]:
    """Weights of every row in every replicate."""
    names = ", ".join(n for n, _ in keys)
    content = f"stratum, {names}, {y}, {x}"
    cuts = ["greatest(0.0::DOUBLE, 1 - 3 / sqrt(size)) AS rate", "exp(-rate) AS t0", "t0 AS f0"]
    for k in range(1, _CUTOFFS):
        cuts += [f"t{k - 1} * rate / {k} AS t{k}", f"f{k - 1} + t{k} AS f{k}"]
    cuts += [f"floor(f{k} * 9007199254740992)::UBIGINT AS cut{k}" for k in range(_CUTOFFS)]
    # A cutoff counts while its term still raises the sum.
    above = " + ".join(["(u >> 11 >= cut0)::INT", *[f"(f{k} > f{k - 1} AND u >> 11 >= cut{k})::INT" for k in range(1, _CUTOFFS)]])
    pick = draw60(f"'{SEED}'", "'pick'", "stratum", "replicate::VARCHAR", "slot::VARCHAR")
    return {
        **index(keys, y, x),
        "b_sizes": "SELECT stratum, sum(copies)::BIGINT AS size FROM b_cells GROUP BY stratum",
        "b_cuts": f"SELECT stratum, size, {', '.join(cuts)} FROM b_sizes",
        "b_units": f"""SELECT {content}, start + unnest(generate_series(0, copies - 1)) AS pos FROM b_index""",
        "b_keyed": f"""SELECT *, ({draw60(f"'{SEED}'", 'stratum')})::UBIGINT AS skey FROM b_units""",
        "b_row": mix("b_keyed", "skey::UHUGEINT + pos::UHUGEINT * 11400714819323198485::UHUGEINT", f"{content}, pos", "rowkey"),
        "b_pairs": f"SELECT *, unnest(generate_series(1, {replicates}))::INT AS replicate FROM b_row",
        "b_u": mix("b_pairs", "rowkey::UHUGEINT + replicate::UHUGEINT * 15074714826142052245::UHUGEINT",
                   f"{content}, pos, replicate", "u"),
        "b_poisson": f"""SELECT {", ".join("b_u." + c.strip() for c in content.split(","))}, replicate, {above} AS w
            FROM b_u JOIN b_cuts ON b_u.stratum = b_cuts.stratum""",
        "b_drawn": f"""SELECT s.stratum, size, r.replicate, coalesce(drawn, 0)::BIGINT AS drawn
            FROM b_sizes s CROSS JOIN (SELECT unnest(generate_series(1, {replicates}))::INT AS replicate) r
            LEFT JOIN (SELECT stratum, replicate, sum(w) AS drawn FROM b_poisson GROUP BY stratum, replicate) d
            ON d.stratum = s.stratum AND d.replicate = r.replicate""",
        "b_slots": """SELECT stratum, size, replicate,
            unnest(generate_series(0, CASE WHEN drawn > size THEN size ELSE size - drawn END - 1)) AS slot FROM b_drawn""",
        "b_picks": f"SELECT stratum, replicate, ({pick}) % size AS pos FROM b_slots",
        "b_weights": f"""SELECT {content}, replicate, sum(w)::BIGINT AS weight FROM (
            SELECT {", ".join("p." + c.strip() for c in content.split(","))}, p.replicate, w FROM b_poisson p
              JOIN b_drawn d ON p.stratum = d.stratum AND p.replicate = d.replicate WHERE drawn <= size AND w > 0
            UNION ALL
            SELECT {", ".join("u." + c.strip() for c in content.split(","))}, k.replicate, 1 FROM b_picks k
              JOIN b_units u ON k.stratum = u.stratum AND k.pos = u.pos)
            GROUP BY {content}, replicate""",
    }


def ci(source: str, keys: str) -> str:
    return f"""SELECT {keys}, CASE WHEN count(value) = count(*) THEN avg(value) END AS estimate,
        CASE WHEN count(value) = count(*) THEN stddev_samp(value) END AS sd,
        quantile_cont(value, 0.025) AS lower_ci, quantile_cont(value, 0.975) AS upper_ci FROM {source} GROUP BY {keys}"""


NUMERIC_KEYS = [('"GIA"', False)]
NUMERIC_WEIGHTS = {**strata("SELECT * FROM valid", '"GIA"'), **weights(NUMERIC_KEYS, "lpa_nmol_max", "lpa_pred_nm")}
NUMERIC_BOOT = {
    **NUMERIC_WEIGHTS,
    **weights(NUMERIC_KEYS, "lpa_nmol_max", "lpa_pred_nm", FULL_REPLICATES),
    "n_sums": """SELECT CASE WHEN grouping(w."GIA") = 1 THEN 'Overall' ELSE w."GIA" END AS "GIA", replicate,
        sum(weight) AS n, sum(weight * lpa_nmol_max) AS sy, sum(weight * lpa_pred_nm) AS sx,
        sum(weight * lpa_nmol_max * lpa_nmol_max) AS syy, sum(weight * lpa_pred_nm * lpa_pred_nm) AS sxx,
        sum(weight * lpa_nmol_max * lpa_pred_nm) AS sxy,
        sqrt(sum(weight * power(lpa_nmol_max - lpa_pred_nm, 2)) / sum(weight)) AS rmse,
        sum(weight * abs((lpa_nmol_max - lpa_pred_nm) / lpa_nmol_max)) / sum(weight) * 100 AS mape
        FROM b_weights w GROUP BY GROUPING SETS ((w."GIA", replicate), (replicate))""",
    "n_wide": """SELECT "GIA", replicate, mape, rmse,
        power(sxy - sx * sy / n, 2) / ((sxx - sx * sx / n) * (syy - sy * sy / n)) AS rsq FROM n_sums""",
    "n_long": long("n_wide", '"GIA", replicate', NUMERIC, "value"),
    "n_ci": ci("n_long", '"GIA", metric'),
}
CLASS_KEYS = [('"GIA"', False), ("threshold", True)]
CLASS_BOOT = {
    "class_rows": CLASS_ROWS,
    **strata(
        """SELECT "ID", "GIA", threshold, strata, true_class::INT::DOUBLE AS truth, pred_class::INT::DOUBLE AS called
        FROM class_rows""",
        "strata",
    ),
    **weights(CLASS_KEYS, "truth", "called"),
    "c_flags": "SELECT *, truth = 1 AS true_class, called = 1 AS pred_class FROM b_weights",
    "c_sums": confusion(
        'c_flags c GROUP BY GROUPING SETS ((c."GIA", threshold, replicate), (threshold, replicate))', "weight",
        """CASE WHEN grouping(c."GIA") = 1 THEN 'Overall' ELSE c."GIA" END AS "GIA", threshold, replicate""",
    ),
    "c_wide": f"""SELECT "GIA", threshold, replicate, {CLASS_FORMULAS} FROM c_sums""",
    "c_long": long("c_wide", '"GIA", threshold, replicate', CLASS, "value"),
    "c_ci": ci("c_long", '"GIA", threshold, metric'),
}
_CELL = 'stratum, "GIA", threshold, truth, called'
_CELL_TAG = ", ".join(["stratum", """coalesce("GIA"::VARCHAR, 'NA')""",
                       *[f"coalesce({c}::DECIMAL(38,6)::VARCHAR, 'NA')" for c in ("threshold", "truth", "called")]])
CLASS_CELLS = {
    "class_rows": CLASS_ROWS,
    **strata(
        """SELECT "ID", "GIA", threshold, strata, true_class::INT::DOUBLE AS truth, pred_class::INT::DOUBLE AS called
        FROM class_rows""",
        "strata",
    ),
    "e_cells": f"""SELECT *, md5(concat_ws('|', {_CELL_TAG})) AS tag FROM (
        SELECT {_CELL}, count(*)::BIGINT AS copies FROM b_strata GROUP BY {_CELL})""",
    "e_placed": """SELECT *, (sum(copies) OVER (PARTITION BY stratum))::BIGINT AS size, coalesce(sum(copies) OVER (PARTITION BY stratum
        ORDER BY tag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM e_cells""",
    "e_means": "SELECT tag, greatest(0.0::DOUBLE, 1 - 6 / sqrt(size::DOUBLE)) * copies AS mean FROM e_placed",
    "e_reach": "SELECT *, greatest(0, floor(mean - (9 * sqrt(mean) + 30)))::BIGINT AS low, ceil(mean + (9 * sqrt(mean) + 30))::BIGINT AS high FROM e_means WHERE mean > 0",
    "e_logs": """SELECT tag, k, sum(CASE WHEN k > low THEN ln(mean / k) ELSE 0.0::DOUBLE END) OVER (PARTITION BY tag ORDER BY k) AS l
        FROM (SELECT *, unnest(generate_series(low, high)) AS k FROM e_reach)""",
    "e_terms": "SELECT tag, k, exp(l - max(l) OVER (PARTITION BY tag)) AS p FROM e_logs",
    "e_table": "SELECT tag, k, (sum(p) OVER (PARTITION BY tag ORDER BY k)) / (sum(p) OVER (PARTITION BY tag)) AS upto FROM e_terms",
    "e_draws": f"""SELECT tag, stratum, size, replicate, (({draw60(f"'{SEED}'", "'cell'", "tag", "replicate::VARCHAR")}) >> 7) / 9007199254740992.0::DOUBLE AS u
        FROM e_placed, (SELECT unnest(generate_series(1, {FULL_REPLICATES}))::INT AS replicate)""",
    "e_counts": """SELECT d.tag, d.stratum, d.size, d.replicate, coalesce(t.k, 0)::BIGINT AS weight
        FROM e_draws d ASOF LEFT JOIN e_table t ON d.tag = t.tag AND d.u < t.upto""",
    "e_drawn": "SELECT stratum, size, replicate, sum(weight)::BIGINT AS drawn FROM e_counts GROUP BY stratum, size, replicate",
    "e_slots": """SELECT stratum, size, replicate,
        unnest(generate_series(0, CASE WHEN drawn > size THEN size ELSE size - drawn END - 1)) AS slot FROM e_drawn""",
    "e_picks": f"""SELECT stratum, replicate, ({draw60(f"'{SEED}'", "'cell-pick'", "stratum", "replicate::VARCHAR", "slot::VARCHAR")}) % size AS pos
        FROM e_slots""",
    "e_picked": """SELECT c.tag, p.replicate FROM e_picks p ASOF JOIN e_placed c ON p.stratum = c.stratum AND p.pos >= c.start""",
    "e_weights": """SELECT tag, replicate, sum(weight) AS weight FROM (
        SELECT c.tag, c.replicate, c.weight FROM e_counts c JOIN e_drawn d ON c.stratum = d.stratum AND c.replicate = d.replicate
        WHERE drawn <= d.size AND weight > 0 UNION ALL SELECT tag, replicate, 1 FROM e_picked) GROUP BY tag, replicate""",
    "c_flags": """SELECT "GIA", threshold, replicate, weight, truth = 1 AS true_class, called = 1 AS pred_class
        FROM e_weights w JOIN e_placed c ON w.tag = c.tag""",
    **{k: CLASS_BOOT[k] for k in ("c_sums", "c_wide", "c_long", "c_ci")},
}

# ---- sources, sinks, contracts ---------------------------------------------------------------------------------

add("read_measured", "measured", body='SELECT "ID"::VARCHAR AS "ID", * EXCLUDE ("ID") FROM measured', doubles="lpa_nmol_max age")
add("read_predictions", "predictions", body="SELECT * FROM predictions", doubles="Lpa_pred_nM min_uncertainty_nM", digits=10)
add("write_results", "valid", extra=GROUP_SIZES, body="SELECT * FROM sizes")
add("require_columns", "measured", body='SELECT "ID", "GIA" FROM measured')
add("available_columns", "measured", body='SELECT sex, age, "DM" FROM measured')
add("domain_violations", "joined",
    body="""SELECT DISTINCT "GIA" FROM joined WHERE "GIA" IS NULL OR "GIA" NOT IN ('AFR', 'AMR', 'EAS', 'EUR')""")
add("read_calls_vcf", "raw_calls",
    body="""SELECT v.chrom, v.pos, v.ref, v.alt, s.sample, coalesce(c.gt, '.|.') AS gt
    FROM (SELECT DISTINCT chrom, pos, ref, alt FROM raw_calls) v CROSS JOIN (SELECT DISTINCT sample FROM raw_calls) s
    LEFT JOIN raw_calls c ON c.pos = v.pos AND c.alt = v.alt AND c.sample = s.sample""")
ORACLE["read_calls_vcf_blocks"] = ORACLE["read_calls_vcf"]
add("read_sites", "sites", body="SELECT * FROM sites")

# ---- projections, filters, scalar functions --------------------------------------------------------------------

add("normal_ci", "predictions", doubles="Lpa_pred_nM lower upper", digits=10,
    body="""SELECT "ID", "Lpa_pred_nM", "Lpa_pred_nM" - 1.96 * "min_uncertainty_nM" AS lower,
    "Lpa_pred_nM" + 1.96 * "min_uncertainty_nM" AS upper FROM predictions""")
add("complete_pairs", "pairs", body='SELECT "ID", lpa_nmol_max, lpa_pred_nm FROM pairs', doubles="lpa_nmol_max lpa_pred_nm")
add("exceeds", "joined", body='SELECT "ID", lpa_nmol_max > 150 AS true_class, lpa_pred_nm > 150 AS pred_class FROM joined')
add("strata_key", "valid", extra={"class_rows": CLASS_ROWS}, body='SELECT "ID", threshold, strata FROM class_rows')
add("select_rename", "valid", body='SELECT "GIA", n AS "Count", "HTN", "DM", "IHD" FROM valid')
add("prefer_adjusted", "joined", doubles="value",
    body="""SELECT "ID", CASE WHEN "GIA" <> 'CSA' AND lpa_nmol_max IS NOT NULL THEN lpa_nmol_max ELSE lpa_pred_nm END AS value
    FROM joined""")
add("relabel", "valid", extra=CLASS_LONG,
    body="""SELECT CASE metric WHEN 'sens' THEN 'Sensitivity' WHEN 'spec' THEN 'Specificity' WHEN 'ppv' THEN 'PPV'
    WHEN 'npv' THEN 'NPV' WHEN 'accuracy' THEN 'Accuracy' WHEN 'f_meas' THEN 'F1 Score' END AS performance, count(*)::BIGINT AS n
    FROM class_long GROUP BY metric
    UNION ALL SELECT k, count(*)::BIGINT FROM valid, (VALUES ('Predicted'), ('Measured')) t(k) GROUP BY k""")
add("p_value_band", "joined",
    body="""SELECT CASE WHEN p IS NULL THEN 'NA' WHEN p < 0.001 THEN 'p < 0.001' WHEN p < 0.01 THEN 'p < 0.01'
    WHEN p < 0.05 THEN 'p < 0.05' ELSE 'p \u2265 0.05' END AS band, count(*)::BIGINT AS n
    FROM (SELECT CASE WHEN lpa_nmol_max > 0 THEN lpa_pred_se / (100 * lpa_nmol_max) END AS p FROM joined) GROUP BY band""")
add("ratio_label", "joined",
    body="""SELECT "ID", CASE WHEN r IS NULL THEN 'NA' ELSE printf('%.2fx', r) END AS label
    FROM (SELECT "ID", CASE WHEN lpa_nmol_max > 0 THEN lpa_pred_nm / lpa_nmol_max END AS r FROM joined)""")
add("pct_label", "joined",
    body="""SELECT "ID", CASE WHEN r IS NULL THEN 'NA%' ELSE printf('%.1f%%', r) END AS label
    FROM (SELECT "ID", CASE WHEN lpa_nmol_max > 0 THEN lpa_pred_nm / lpa_nmol_max END * 100 AS r FROM joined)""")
add("ci_label", "pred",
    body="""SELECT "ID", printf('%.1f (%.1f-%.1f)', lpa_pred_nm, lpa_pred_lci95, lpa_pred_uci95) AS label FROM pred""")
add("group_label", "valid", body="""SELECT "ID", "GIA" || ' (n = ' || n::VARCHAR || ')' AS label FROM valid""")
add("round_cols", "pred",
    body="""SELECT "ID", round_even(lpa_pred_lci95, 2) AS lpa_pred_lci95, round_even(lpa_pred_uci95, 2) AS lpa_pred_uci95 FROM pred""")

# ---- joins -----------------------------------------------------------------------------------------------------

PRED_DOUBLES = "lpa_pred_nm lpa_pred_se lpa_pred_lci95 lpa_pred_uci95"
add("join_pred_measured", "joined", body="SELECT * FROM joined", doubles=PRED_DOUBLES + " lpa_nmol_max age")


def prevalence(thresholds: str, by_group: bool) -> str:
    key = 'j."GIA"' if by_group else "'Overall'"
    return f"""SELECT *, measured_elevated_count / total_count * 100 AS measured_elevated_pct,
        predicted_elevated_count / total_count * 100 AS predicted_elevated_pct FROM (
        SELECT {key} AS "GIA", threshold, count(*)::BIGINT AS total_count, count(lpa_nmol_max)::BIGINT AS measured_available_count,
        count(lpa_pred_nm)::BIGINT AS predicted_available_count,
        count(*) FILTER (lpa_nmol_max > threshold)::BIGINT AS measured_elevated_count,
        count(*) FILTER (lpa_pred_nm > threshold)::BIGINT AS predicted_elevated_count
        FROM joined j CROSS JOIN {thresholds} {'WHERE j."GIA" IS NOT NULL' if by_group else ''}
        GROUP BY {'j."GIA", ' if by_group else ''}threshold)"""


PREVALENCE = {
    "prev_overall": prevalence(THRESHOLD_VALUES, False),
    "prev_group": prevalence(THRESHOLD_VALUES, True),
    "prev_union": "SELECT * FROM prev_overall UNION ALL SELECT * FROM prev_group",
    **CLASS_POINT,
    "prev": """SELECT p.*, c.ppv, predicted_elevated_count AS predicted_elevated_unadjusted,
        predicted_elevated_count / total_count * 100 AS predicted_elevated_unadjusted_pct,
        predicted_elevated_count * c.ppv AS predicted_elevated_adjusted,
        predicted_elevated_count * c.ppv / total_count * 100 AS predicted_elevated_adjusted_pct,
        c.ppv IS NOT NULL AS has_ppv_adjustment
        FROM prev_union p LEFT JOIN class_wide c ON p."GIA" = c."GIA" AND p.threshold = c.threshold""",
}
PREVALENCE_DOUBLES = "measured_elevated_pct predicted_elevated_pct"
PREV_AT_150 = {k: v for k, v in PREVALENCE.items() if k in ("prev_overall", "prev_group", *CLASS_POINT)}
add("join_ppv_overall", "joined", "valid", extra=PREV_AT_150, doubles=PREVALENCE_DOUBLES + " ppv",
    body="""SELECT *, (SELECT ppv FROM class_wide WHERE "GIA" = 'Overall' AND threshold = 150) AS ppv
    FROM prev_overall WHERE threshold = 150""")
add("join_ppv_group", "joined", "valid", extra=PREV_AT_150, doubles=PREVALENCE_DOUBLES + " ppv",
    body="""SELECT p.*, c.ppv FROM prev_group p LEFT JOIN class_wide c ON p."GIA" = c."GIA" AND p.threshold = c.threshold
    WHERE p.threshold = 150""")
add("join_group_sizes", "valid", extra={**NUMERIC_LONG, **GROUP_SIZES}, doubles=METRIC_DOUBLES,
    body='SELECT m.*, pop_size FROM numeric_long m LEFT JOIN sizes s ON m."GIA" IS NOT DISTINCT FROM s."GIA"')
add("join_fallback_counts", "valid", doubles="mean_truth",
    body='SELECT "GIA" AS stratum, count(*)::BIGINT AS cohort_size, avg(lpa_nmol_max) AS mean_truth FROM valid GROUP BY "GIA"')
add("cross_thresholds", "valid", doubles="lpa_nmol_max",
    body=f'SELECT "ID", "GIA", lpa_nmol_max, threshold FROM valid CROSS JOIN {THRESHOLD_VALUES}')
add("site_intersect", "extracted", body="SELECT * FROM extracted")
add("missing_sites", "extracted",
    body="""SELECT * FROM sites s WHERE NOT EXISTS (SELECT 1 FROM extracted e WHERE e.pos = s.pos AND e.alt = s.alt)""")
add("order_join", "valid", extra={**GROUP_SIZES, **ORDER_OF_VALID},
    body=f'SELECT x.*, {ORD} FROM sizes x LEFT JOIN ordering o ON x."GIA" IS NOT DISTINCT FROM o."GIA"')

# ---- aggregations ----------------------------------------------------------------------------------------------

add("pred_summary", "pred", body="SELECT * FROM pred", doubles=PRED_DOUBLES)
add("group_counts", "joined", body='SELECT "GIA", count(*)::BIGINT AS n FROM joined GROUP BY "GIA"')
add("group_sizes", "valid", extra=GROUP_SIZES, body="SELECT * FROM sizes")
add("metrics_numeric", "valid", extra=NUMERIC_POINT, body="SELECT * FROM numeric_wide", doubles=" ".join(NUMERIC))
add("metrics_numeric_exact", "valid", extra=NUMERIC_POINT, body="SELECT * FROM numeric_wide", doubles=" ".join(NUMERIC))
add("exact_sums", doubles="price price_quantity", digits=2,
    body="""SELECT l_suppkey, fsum(l_extendedprice) AS price, fsum(l_extendedprice * l_quantity) AS price_quantity
    FROM lineitem GROUP BY l_suppkey""")
add("metrics_class", "valid", extra=CLASS_POINT, body="""SELECT * FROM class_wide WHERE "GIA" <> 'Overall'""", doubles=" ".join(CLASS))
add("metrics_class_by_threshold_grouping", "valid", extra=CLASS_POINT, body="SELECT * FROM class_wide", doubles=" ".join(CLASS))
add("prevalence_overall", "joined", body=prevalence(THRESHOLD_VALUES, False), doubles=PREVALENCE_DOUBLES)
add("prevalence_by_group", "joined", body=prevalence(THRESHOLD_VALUES, True), doubles=PREVALENCE_DOUBLES)
add("prevalence_table", "joined", "valid", extra=PREVALENCE, body="SELECT * FROM prev",
    doubles=PREVALENCE_DOUBLES + " ppv predicted_elevated_unadjusted_pct predicted_elevated_adjusted predicted_elevated_adjusted_pct")


def continuous(stratum: str) -> str:
    one = """SELECT {s} AS stratum, '{c}' AS variable, count({c})::BIGINT AS n, quantile_cont({c}, 0.25) AS p25,
        quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.75) AS p75 FROM valid GROUP BY {s}"""
    return " UNION ALL ".join(one.format(s=stratum, c=c) for c in ("age", "lpa_nmol_max", "lpa_pred_nm"))


def categorical(stratum: str, texts: tuple[str, ...]) -> str:
    parts = []
    for c in texts:
        counted = f"""SELECT {stratum} AS stratum, '{c}' AS variable, "{c}" AS level, count(*)::BIGINT AS n
            FROM valid WHERE "{c}" IS NOT NULL GROUP BY 1, 3"""
        parts.append(f"SELECT *, n / sum(n) OVER (PARTITION BY stratum) * 100 AS pct FROM ({counted})")
    for c in ("HTN", "DM", "IHD"):
        parts.append(
            f"""SELECT {stratum} AS stratum, '{c}' AS variable, 'TRUE' AS level, count(*) FILTER ("{c}")::BIGINT AS n,
            count(*) FILTER ("{c}") / count("{c}") * 100 AS pct FROM valid GROUP BY 1 HAVING count("{c}") > 0"""
        )
    return " UNION ALL ".join(f"({p})" for p in parts)


add("summary_continuous", "valid", body=continuous('"GIA"'), doubles="p25 median p75")
add("summary_continuous_overall", "valid", body=continuous("'Overall'"), doubles="p25 median p75")
add("summary_categorical", "valid", body=categorical('"GIA"', ("sex",)), doubles="pct")
add("summary_categorical_overall", "valid", body=categorical("'Overall'", ("sex", "GIA")), doubles="pct")
add("summary_fallback", "valid", doubles="mean_truth",
    body="SELECT 'Overall' AS stratum, count(*)::BIGINT AS cohort_size, avg(lpa_nmol_max) AS mean_truth FROM valid")
add("bootstrap_ci", "valid", doubles=METRIC_DOUBLES, extra=NUMERIC_BOOT, body="SELECT * FROM n_ci")
add("an_ac", "extracted",
    body="""SELECT chrom, pos, ref, alt, an::BIGINT AS an, CASE WHEN alt LIKE '%,%' THEN ac1::VARCHAR || ',' || ac2::VARCHAR
    ELSE ac1::VARCHAR END AS ac FROM (SELECT chrom, pos, ref, alt,
    sum((substr(gt, 1, 1) <> '.')::INT + (substr(gt, 3, 1) <> '.')::INT) AS an,
    sum((substr(gt, 1, 1) = '1')::INT + (substr(gt, 3, 1) = '1')::INT)::BIGINT AS ac1,
    sum((substr(gt, 1, 1) = '2')::INT + (substr(gt, 3, 1) = '2')::INT)::BIGINT AS ac2
    FROM extracted GROUP BY chrom, pos, ref, alt)""")
COVERAGE = {
    "coverage": """SELECT (SELECT count(*) FROM sites)::BIGINT AS n_required,
        (SELECT count(*) FROM (SELECT DISTINCT pos, alt FROM extracted))::BIGINT AS n_extracted""",
    "missing": "SELECT sample, count(*)::BIGINT AS n_missing FROM extracted WHERE gt LIKE '%.%' GROUP BY sample",
}
add("site_coverage", "extracted", extra=COVERAGE,
    body="SELECT *, round(n_extracted / n_required * 100, 1) AS coverage_pct FROM coverage")
add("sample_missingness", "extracted", extra=COVERAGE, body="SELECT * FROM missing")
add("needs_imputation", "extracted", extra=COVERAGE,
    body="""SELECT s AS n_sites_missing, m AS n_samples_missing, s > 0 OR m > 0 AS needed,
    CASE WHEN s > 0 THEN 'sites missing' WHEN m > 0 THEN 'samples missing' ELSE 'none' END AS reason
    FROM (SELECT n_required - n_extracted AS s, (SELECT count(*) FROM missing)::BIGINT AS m FROM coverage)""")
add("multiallelic_count", "extracted",
    body="SELECT count(DISTINCT pos)::BIGINT AS n_multiallelic FROM extracted WHERE alt LIKE '%,%'")
for _name in ("an_ac", "sample_missingness", "multiallelic_count"):
    ORACLE[f"{_name}_packed"] = ORACLE[_name]
add("unpack_calls", "extracted", body="SELECT * FROM extracted")
_STAGE = """SELECT '{name}' AS stage, (SELECT min(chrom) FROM raw_calls WHERE chrom IN ('6', 'chr6')) AS chrom_naming, (SELECT count(*) FROM sites)::BIGINT AS n_required,
    count(DISTINCT pos)::BIGINT AS n_extracted, round(count(DISTINCT pos) / (SELECT count(*) FROM sites) * 100, 1) AS coverage_pct,
    count(DISTINCT sample)::BIGINT AS n_samples, count(DISTINCT CASE WHEN gt LIKE '%.%' THEN sample END)::BIGINT AS n_samples_missing,
    count(DISTINCT CASE WHEN alt LIKE '%,%' THEN pos END)::BIGINT AS n_multiallelic,
    CASE WHEN (SELECT count(*) FROM sites) > count(DISTINCT pos) THEN 'sites missing'
         WHEN count(*) FILTER (gt LIKE '%.%') > 0 THEN 'samples missing' ELSE 'none' END AS reason
    FROM extracted {where}"""
add("qc_summary", "raw_calls", "extracted",
    body=_STAGE.format(name="raw", where="") + " UNION ALL " + _STAGE.format(name="complete", where="WHERE gt NOT LIKE '%.%'"))
add("headline", "predictions", "valid", extra=NUMERIC_POINT,
    body="""SELECT (SELECT count(DISTINCT "ID") FROM predictions)::BIGINT AS n_genotyped, (SELECT count(*) FROM measured)::BIGINT AS n_measured_rows,
    (SELECT count(lpa_nmol_max) FROM measured)::BIGINT AS n_measured, (SELECT count(*) FROM valid)::BIGINT AS n_validated,
    round_even(rsq, 3) AS rsq, round_even(rmse, 1) AS rmse FROM numeric_wide WHERE "GIA" = 'Overall'""")

# ---- group attachments, order, limits --------------------------------------------------------------------------

add("add_group_size", "joined", body='SELECT "ID", "GIA", count(*) OVER (PARTITION BY "GIA")::BIGINT AS n FROM joined')
add("min_group_filter", "valid", body='SELECT "ID", "GIA", n FROM valid')
add("total_count", "joined", body='SELECT "ID", "GIA", count(*) OVER ()::BIGINT AS total_count FROM joined')
add("best_group", "valid", extra=NUMERIC_POINT, doubles="estimate",
    body="""SELECT "GIA", rsq AS estimate FROM numeric_wide WHERE "GIA" <> 'Overall' ORDER BY rsq DESC, "GIA" LIMIT 1""")
add("resample_index", "valid", doubles="lpa_nmol_max lpa_pred_nm",
    extra={**strata("SELECT * FROM valid", '"GIA"'), **index(NUMERIC_KEYS, "lpa_nmol_max", "lpa_pred_nm")},
    body="SELECT * FROM b_index")
add("group_order", "pairs", extra=order_of("pairs"), body="SELECT * FROM ordering")
add("overall_first", "valid", extra={**GROUP_SIZES, **ORDER_OF_VALID},
    body=f'SELECT x.*, {ORD} FROM sizes x LEFT JOIN ordering o ON x."GIA" IS NOT DISTINCT FROM o."GIA"')
add("take_n", "valid", body='SELECT "ID", lpa_pred_nm FROM valid ORDER BY lpa_pred_nm DESC, "ID" LIMIT 10', doubles="lpa_pred_nm")

# ---- set operations and reshaping ------------------------------------------------------------------------------

add("union_metrics", "valid", extra=METRICS, body="SELECT * FROM metrics", doubles=METRIC_DOUBLES)
add("point_metrics", "valid", extra=CLASS_LONG, body="SELECT * FROM class_long", doubles=METRIC_DOUBLES)
add("union_prevalence", "joined", "valid", extra=PREVALENCE, body="SELECT * FROM prev_union", doubles=PREVALENCE_DOUBLES)
add("name_setops", "measured", body='SELECT "HTN", "DM", count(*)::BIGINT AS n FROM measured GROUP BY "HTN", "DM"')
add("pivot_longer", "joined", doubles="value",
    body="""SELECT "ID", "GIA", 'lpa_pred_nm' AS measurement, lpa_pred_nm AS value FROM joined UNION ALL
    SELECT "ID", "GIA", 'lpa_nmol_max', lpa_nmol_max FROM joined""")


def wide(source: str, keys: str, names: tuple[str, ...], value: str = "{}") -> str:
    cols = [
        value.format(f"max({s}) FILTER (metric = '{m}')") + f" AS {s}_{m}" for m in names for s in ("estimate", "lower_ci", "upper_ci")
    ]
    return f"SELECT {keys}, {', '.join(cols)} FROM {source} GROUP BY {keys}"


add("pivot_wider_numeric", "valid", extra=NUMERIC_BOOT, body=wide("n_ci", '"GIA"', NUMERIC, "round_even({}, 2)"))
CLASS_WIDE_DOUBLES = " ".join(f"{s}_{m}" for m in CLASS for s in ("estimate", "lower_ci", "upper_ci"))
add("pivot_wider_class", "valid", extra=CLASS_LONG, doubles=CLASS_WIDE_DOUBLES,
    body=wide("(SELECT * FROM class_long WHERE threshold = 150)", '"GIA"', CLASS, "{} * 100"))
add("threshold_table", "valid", extra=CLASS_LONG,
    doubles=" ".join(f"{s}_{m}" for m in ("sens", "spec", "ppv", "npv") for s in ("estimate", "lower_ci", "upper_ci")),
    body=wide("""(SELECT * FROM class_long WHERE "GIA" = 'Overall')""", "threshold", ("sens", "spec", "ppv", "npv"), "{} * 100"))
_LABELS = {"age": "Age (years)", "sex": "Sex", "lpa_nmol_max": "Lp(a) (nmol/L)", "HTN": "Hypertension", "DM": "Diabetes",
           "IHD": "Ischemic heart disease"}
_LABEL = "CASE variable " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _LABELS.items()) + " END AS label"


def shown(x: str, digits: int = 1) -> str:
    """Text of a number with that many digits, halves rounded up."""
    return f"(round({x}::DECIMAL(30,9), {digits}))::DECIMAL(30,{digits})::VARCHAR"


add("tidy_summary", "valid", doubles="stat_1 stat_2 stat_3",
    extra={"cont": continuous('"GIA"'), "cat": categorical('"GIA"', ("sex",))},
    body=f"""SELECT variable, {_LABEL}, NULL::VARCHAR AS level, stratum, {shown('median')} || ' (' || {shown('p25')} || ', ' || {shown('p75')} || ')' AS value,
    median AS stat_1, p25 AS stat_2, p75 AS stat_3 FROM cont WHERE variable <> 'lpa_pred_nm' UNION ALL
    SELECT variable, {_LABEL}, level, stratum, n::VARCHAR || ' (' || {shown('pct')} || '%)', n::DOUBLE, pct, NULL::DOUBLE FROM cat""")
add("drop_na", "joined", body='SELECT "ID", "GIA" FROM joined WHERE lpa_nmol_max IS NOT NULL AND "GIA" IS NOT NULL AND "ID" IS NOT NULL')

# ---- resampling ------------------------------------------------------------------------------------------------

add("bootstrap_strata", "valid", extra=strata("SELECT * FROM valid", '"GIA"'), body='SELECT "ID", "GIA", stratum FROM b_strata')
add("bootstrap_weights", "valid", extra={**NUMERIC_WEIGHTS, **weights(NUMERIC_KEYS, "lpa_nmol_max", "lpa_pred_nm", FULL_REPLICATES)}, doubles="lpa_nmol_max lpa_pred_nm", body="SELECT * FROM b_weights")
add("bootstrap_weight_vectors", "valid", doubles="lpa_nmol_max lpa_pred_nm",
    extra={**NUMERIC_BOOT, "b_maps": """SELECT stratum, "GIA", lpa_nmol_max, lpa_pred_nm,
        map_from_entries(list((replicate, weight))) AS weights FROM b_weights GROUP BY stratum, "GIA", lpa_nmol_max, lpa_pred_nm"""},
    body=f"""SELECT c.stratum, c."GIA", c.lpa_nmol_max, c.lpa_pred_nm, block::INT AS block,
    md5(array_to_string([coalesce(weights[r::INT], 0) FOR r IN range(block * 250 + 1, least(block * 250 + 250, {FULL_REPLICATES}) + 1)], ','))
        AS digest FROM b_cells c CROSS JOIN range(({FULL_REPLICATES} + 249) // 250) AS blocks(block)
    LEFT JOIN b_maps m ON c.stratum = m.stratum AND c."GIA" IS NOT DISTINCT FROM m."GIA"
      AND c.lpa_nmol_max = m.lpa_nmol_max AND c.lpa_pred_nm = m.lpa_pred_nm""")
add("numeric_boot_from_vectors", "valid", extra=NUMERIC_BOOT, doubles=METRIC_DOUBLES, body="SELECT * FROM n_ci")
add("numeric_boot_grouped", "valid", extra=NUMERIC_BOOT, doubles=METRIC_DOUBLES, body="""SELECT * FROM n_ci WHERE "GIA" <> 'Overall'""")
add("numeric_boot_overall", "valid", extra=NUMERIC_BOOT, doubles=METRIC_DOUBLES, body="""SELECT * FROM n_ci WHERE "GIA" = 'Overall'""")
add("class_boot_by_row", "valid", extra=CLASS_BOOT, doubles=METRIC_DOUBLES, body="SELECT * FROM c_ci")
add("class_boot_by_cell", "valid", extra=CLASS_CELLS, doubles=METRIC_DOUBLES, body="SELECT * FROM c_ci")
add("class_boot_grouped", "valid", extra=CLASS_CELLS, doubles=METRIC_DOUBLES, body="""SELECT * FROM c_ci WHERE "GIA" <> 'Overall'""")
add("class_boot_overall", "valid", extra=CLASS_CELLS, doubles=METRIC_DOUBLES, body="""SELECT * FROM c_ci WHERE "GIA" = 'Overall'""")

# ---- impact ----------------------------------------------------------------------------------------------------


def reciprocal(c: str) -> str:
    return f"CASE WHEN {c} = 0 THEN 'Infinity'::DOUBLE ELSE 1 / {c} END"


add("nnt", "valid", extra=CLASS_CELLS, doubles="estimate lower_ci upper_ci",
    body=f"""SELECT "GIA", 'nnt' AS metric, {reciprocal('estimate')} AS estimate, {reciprocal('upper_ci')} AS lower_ci,
    {reciprocal('lower_ci')} AS upper_ci, 'Classification' AS metric_type FROM c_ci WHERE threshold = 150 AND metric = 'ppv'""")
RATES = {
    **PREVALENCE,
    "rates": """SELECT *, measured_elevated_count / total_count * 1000 AS clinical_rate_per_1000,
        predicted_elevated_unadjusted / total_count * 1000 AS genetic_rate_unadjusted_per_1000,
        predicted_elevated_adjusted / total_count * 1000 AS genetic_rate_per_1000 FROM prev""",
}


def improvement(c: str) -> str:
    return f"""CASE WHEN clinical_rate_per_1000 > 0 THEN {c} / clinical_rate_per_1000
        WHEN {c} > 0 THEN 'Infinity'::DOUBLE END"""


add("detection_rates", "joined", "valid", extra=RATES,
    doubles="clinical_rate_per_1000 genetic_rate_unadjusted_per_1000 genetic_rate_per_1000 improvement_factor_unadjusted improvement_factor",
    body=f"""SELECT "GIA", threshold, clinical_rate_per_1000, genetic_rate_unadjusted_per_1000, genetic_rate_per_1000,
    {improvement('genetic_rate_unadjusted_per_1000')} AS improvement_factor_unadjusted,
    {improvement('genetic_rate_per_1000')} AS improvement_factor FROM rates""")
# Hypergeometric probabilities by log gamma over the whole support.
FISHER = {
    **RATES,
    "f_used": """SELECT *, CASE WHEN has_ppv_adjustment THEN predicted_elevated_adjusted ELSE predicted_elevated_unadjusted::DOUBLE END
        AS used FROM rates""",
    "f_tables": """SELECT "GIA", threshold, round_even(used, 0)::BIGINT AS a, measured_elevated_count AS c, total_count AS n
        FROM f_used WHERE used > 0 AND measured_elevated_count > 0""",
    "f_support": """SELECT *, unnest(generate_series(greatest(0, a + c - n), least(a + c, n))) AS v FROM f_tables""",
    "f_logs": """SELECT *, 2 * lgamma(n + 1) - lgamma(v + 1) - lgamma(n - v + 1) - lgamma(a + c - v + 1) - lgamma(n - a - c + v + 1)
        - lgamma(2 * n + 1) + lgamma(a + c + 1) + lgamma(2 * n - a - c + 1) AS lp FROM f_support""",
    "f_seen": 'SELECT "GIA", threshold, lp AS seen FROM f_logs WHERE v = a',
    "fisher": """SELECT l."GIA", l.threshold, least(1.0::DOUBLE, sum(exp(lp)) FILTER (exp(lp) <= exp(seen) * (1 + 1e-7::DOUBLE)) / sum(exp(lp)))
        AS p_value FROM f_logs l JOIN f_seen s ON l."GIA" = s."GIA" AND l.threshold = s.threshold GROUP BY l."GIA", l.threshold""",
    "tested": """SELECT u.*, p_value,
        CASE WHEN has_ppv_adjustment THEN 'PPV adjusted' ELSE 'Unadjusted (no PPV available)' END AS rate_note
        FROM f_used u LEFT JOIN fisher f ON u."GIA" = f."GIA" AND u.threshold = f.threshold""",
}
add("fisher_exact", "joined", "valid", extra=FISHER, doubles="p_value", digits=8,
    body='SELECT "GIA", threshold, p_value, rate_note FROM tested')
add("detection_comparison", "joined", "valid", extra={**FISHER, **ORDER_OF_VALID},
    doubles="clinical_pct genetic_count genetic_pct improvement",
    body=f"""SELECT *, coalesce({shown('clinical_pct')}, 'NA') || '%' AS clinical_pct_text,
    coalesce({shown('genetic_pct')}, 'NA') || '%' AS genetic_pct_text,
    CASE WHEN improvement IS NULL THEN 'NA' WHEN isinf(improvement) THEN '\u221e' ELSE {shown('improvement', 2)} || 'x' END AS improvement_text
    FROM (SELECT x."GIA", {ORD}, total_count, measured_elevated_count AS clinical_count, measured_elevated_pct AS clinical_pct,
    coalesce(predicted_elevated_adjusted, predicted_elevated_unadjusted::DOUBLE) AS genetic_count,
    coalesce(predicted_elevated_adjusted_pct, predicted_elevated_unadjusted_pct) AS genetic_pct,
    coalesce({improvement('genetic_rate_per_1000')}, {improvement('genetic_rate_unadjusted_per_1000')}) AS improvement,
    CASE WHEN p_value IS NULL THEN 'NA' WHEN p_value < 0.001 THEN 'p < 0.001' WHEN p_value < 0.01 THEN 'p < 0.01'
    WHEN p_value < 0.05 THEN 'p < 0.05' ELSE 'p \u2265 0.05' END AS p_value_text, rate_note
    FROM tested x LEFT JOIN ordering o ON x."GIA" = o."GIA" WHERE threshold = 150)""")
add("conclusions", "valid", extra={**NUMERIC_POINT, **CLASS_POINT},
    body="""SELECT CASE WHEN rsq > 0.5 THEN 'strong' ELSE 'moderate' END AS performance, round_even(rsq, 2) AS rsq,
    b.best_group, round_even(b.best_rsq, 2) AS best_rsq, round_even(c.sens * 100, 1) AS sens_pct,
    round_even(c.spec * 100, 1) AS spec_pct, round_even(1 / c.ppv, 1) AS nnt
    FROM numeric_wide w, (SELECT * FROM class_wide WHERE "GIA" = 'Overall' AND threshold = 150) c,
    (SELECT "GIA" AS best_group, rsq AS best_rsq FROM numeric_wide WHERE "GIA" <> 'Overall' ORDER BY rsq DESC, "GIA" LIMIT 1) b
    WHERE w."GIA" = 'Overall'""")

# ---- plot data -------------------------------------------------------------------------------------------------

FIT = {
    "fit": """SELECT "GIA", n, slope, intercept, CASE WHEN n > 2 AND sxx > 0 THEN sqrt(greatest(syy - sxy * sxy / sxx, 0) / (n - 2)) END
        AS residual_se, sxx, mean_x, min_x, max_x FROM (
        SELECT CASE WHEN grouping(v."GIA") = 1 THEN 'Overall' ELSE v."GIA" END AS "GIA", count(*)::BIGINT AS n,
        regr_slope(lpa_nmol_max, lpa_pred_nm) AS slope, regr_intercept(lpa_nmol_max, lpa_pred_nm) AS intercept,
        regr_sxx(lpa_nmol_max, lpa_pred_nm) AS sxx, regr_syy(lpa_nmol_max, lpa_pred_nm) AS syy,
        regr_sxy(lpa_nmol_max, lpa_pred_nm) AS sxy, avg(lpa_pred_nm) AS mean_x, min(lpa_pred_nm) AS min_x, max(lpa_pred_nm) AS max_x
        FROM valid v GROUP BY GROUPING SETS ((v."GIA"), ()))""",
}
add("fit_line", "valid", extra=FIT, body="SELECT * FROM fit", digits=4, doubles="slope intercept residual_se sxx mean_x min_x max_x")
add("fit_band", "valid", extra=FIT, digits=4, doubles="x fitted se",
    body="""SELECT "GIA", i, x, intercept + slope * x AS fitted, residual_se * sqrt(1 / n + power(x - mean_x, 2) / sxx) AS se FROM (
    SELECT *, min_x + i * (max_x - min_x) / 79 AS x FROM (SELECT *, unnest(generate_series(0, 79)) AS i FROM fit))""")


def kernel(source: str, keys: list[str], adjust: float, lo: str, hi: str, points: int = 512) -> dict[str, str]:
    """Linear binning on the grid, then the Gaussian sum over all nodes."""
    k = ", ".join(keys)

    def same(a: str, b: str) -> str:
        return " AND ".join(f"{a}.{c} = {b}.{c}" for c in keys)

    return {
        "k_rows": source,
        "k_basis": f"""SELECT {k}, count(*) AS n, {lo} AS lo, {hi} AS hi,
            0.9::DOUBLE * {adjust} * least(stddev_samp(value), (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) / 1.34::DOUBLE)
              * power(count(*), -0.2::DOUBLE) AS bw FROM k_rows GROUP BY {k}""",
        "k_at": f"""SELECT {", ".join("r." + c for c in keys)}, (value - lo) / ((hi - lo) / {points - 1}) AS spot
            FROM k_rows r JOIN k_basis b ON {same('r', 'b')}""",
        "k_node": f"SELECT {k}, least(floor(spot)::BIGINT, {points - 2}) AS node, spot FROM k_at",
        "k_weights": f"""SELECT {k}, node, sum(w) AS w FROM (SELECT {k}, node, 1 - (spot - node) AS w FROM k_node
            UNION ALL SELECT {k}, node + 1, spot - node FROM k_node) GROUP BY {k}, node""",
        "k_density": f"""SELECT {", ".join("w." + c for c in keys)}, i, min(lo + i * ((hi - lo) / {points - 1})) AS x,
            sum(w.w * exp(-0.5::DOUBLE * power((i - node) * ((hi - lo) / {points - 1}) / bw, 2))) / (min(n) * min(bw) * sqrt(2 * pi()))
              AS density, min(bw) AS bandwidth
            FROM k_weights w JOIN k_basis b ON {same('w', 'b')}, (SELECT unnest(generate_series(0, {points - 1})) AS i)
            GROUP BY {", ".join("w." + c for c in keys)}, i""",
    }


_VALUES = """SELECT "GIA" AS panel, 'Predicted' AS measurement, lpa_pred_nm AS value FROM valid UNION ALL
    SELECT "GIA", 'Measured', lpa_nmol_max FROM valid"""
_PANELS = f"SELECT * FROM ({_VALUES}) UNION ALL SELECT 'Overall', measurement, value FROM ({_VALUES})"
add("density", "valid", digits=8, doubles="x density bandwidth", body="SELECT * FROM k_density",
    extra=kernel(_PANELS, ["panel", "measurement"], 2.0, "(SELECT min(value) FROM k_rows)", "(SELECT max(value) FROM k_rows)"))
_LOGS = 'SELECT "GIA", log10(lpa_nmol_max) AS value FROM valid WHERE lpa_nmol_max > 0'
add("violin_density", "valid", digits=6, doubles="x density bandwidth", body="SELECT * FROM k_density",
    extra=kernel(_LOGS, ['"GIA"'], 1.0, "min(value)", "max(value)"))
add("box_stats", "valid", doubles="q1 median q3 whisker_low whisker_high",
    extra={
        "logs": _LOGS,
        "quartiles": """SELECT "GIA", count(*)::BIGINT AS n, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
            quantile_cont(value, 0.75) AS q3 FROM logs GROUP BY "GIA" """,
        "placed": """SELECT l.value, q.*, value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
            FROM logs l JOIN quartiles q ON l."GIA" = q."GIA" """,
    },
    body="""SELECT "GIA", n, q1, median, q3, min(value) FILTER (inside) AS whisker_low, max(value) FILTER (inside) AS whisker_high,
    count(*) FILTER (NOT inside)::BIGINT AS n_outliers FROM placed GROUP BY "GIA", n, q1, median, q3""")
add("scatter_points", "valid", doubles="predicted measured",
    body="""SELECT "GIA", "GIA" || ' (n = ' || n::VARCHAR || ')' AS label, lpa_pred_nm AS predicted, lpa_nmol_max AS measured FROM valid""")
add("performance_points", "valid", extra={**METRICS, **GROUP_SIZES, **ORDER_OF_VALID}, doubles=METRIC_DOUBLES,
    body=f"""SELECT x.*, pop_size, {ORD} FROM metrics x LEFT JOIN sizes s ON x."GIA" = s."GIA"
    LEFT JOIN ordering o ON x."GIA" = o."GIA" WHERE metric_type = 'Numeric' OR threshold = 150""")
add("nnt_points", "valid", extra={**CLASS_LONG, **GROUP_SIZES, **ORDER_OF_VALID}, doubles="estimate lower_ci upper_ci",
    body=f"""SELECT x."GIA", 'nnt' AS metric, {reciprocal('estimate')} AS estimate, NULL::DOUBLE AS lower_ci, NULL::DOUBLE AS upper_ci,
    'Classification' AS metric_type, pop_size, {ORD} FROM class_long x LEFT JOIN sizes s ON x."GIA" = s."GIA"
    LEFT JOIN ordering o ON x."GIA" = o."GIA" WHERE threshold = 150 AND metric = 'ppv'""")

# ---- genotype calls and documented preparation -----------------------------------------------------------------

add("detect_chrom_naming", "raw_calls", body="SELECT min(chrom) AS chrom_naming FROM raw_calls WHERE chrom IN ('6', 'chr6')")
add("normalize_chrom", "raw_calls", body="SELECT * REPLACE ('chr6' AS chrom) FROM raw_calls")
add("region_filter", "raw_calls",
    body="SELECT * REPLACE ('chr6' AS chrom) FROM raw_calls WHERE pos BETWEEN 160400000 AND 160800000")
add("strip_fields", "raw_calls", body="SELECT * EXCLUDE (filter) FROM raw_calls")
add("is_phased", "raw_calls",
    body="SELECT n AS n_unphased, n = 0 AS phased FROM (SELECT count(*) FILTER (gt LIKE '%/%')::BIGINT AS n FROM raw_calls)")
add("to_nmol", doubles="value",
    body="SELECT event_id, CASE WHEN event_type = 'click' THEN value * 2.15::DOUBLE ELSE value END AS value FROM events")
add("max_per_person", doubles="lpa_nmol_max",
    body="""SELECT user_id, max(CASE WHEN event_type = 'click' THEN value * 2.15::DOUBLE ELSE value END) AS lpa_nmol_max
    FROM events GROUP BY user_id""")
add("code_flag",
    body="""SELECT user_id, count(*) FILTER (event_type = 'click') >= 2 AS clicked, count(*) FILTER (event_type = 'view') >= 2 AS viewed,
    count(*) FILTER (event_type = 'purchase') >= 2 AS purchased FROM events GROUP BY user_id""")
add("id_overlap", "predictions", "measured",
    extra={
        "a": 'SELECT DISTINCT "ID" FROM predictions',
        "b": 'SELECT DISTINCT "ID" FROM measured',
    },
    body="""SELECT (SELECT count(*) FROM a WHERE "ID" IN (SELECT "ID" FROM b))::BIGINT AS n_both,
    (SELECT count(*) FROM a WHERE "ID" NOT IN (SELECT "ID" FROM b))::BIGINT AS n_first_only,
    (SELECT count(*) FROM b WHERE "ID" NOT IN (SELECT "ID" FROM a))::BIGINT AS n_second_only""")

# ---- whole flows -----------------------------------------------------------------------------------------------

ORACLE["validate_all_metrics"] = ORACLE["union_metrics"]
ORACLE["validate_prevalence"] = ORACLE["prevalence_table"]
ORACLE["validate_conclusions"] = ORACLE["conclusions"]
ORACLE["prepare_calls_summary"] = ORACLE["qc_summary"]

# ---- samples, sketches, regions and runs -----------------------------------------------------------------------

_DRAW = draw60(f"'{SEED}'", "'sample'", *[f"coalesce({c}::DECIMAL(38,6)::VARCHAR, 'NA')" for c in ('"ID"', "lpa_nmol_max", "lpa_pred_nm")])
add("scatter_sample", "valid", doubles="predicted measured weight",
    body=f"""SELECT "GIA", "GIA" || ' (n = ' || n::VARCHAR || ')' AS label, lpa_pred_nm AS predicted, lpa_nmol_max AS measured,
    n / least(n, 300)::DOUBLE AS weight FROM (SELECT *, row_number() OVER (PARTITION BY "GIA"
    ORDER BY {_DRAW}, "ID") AS place FROM valid) WHERE place <= 300""")
add("summary_continuous_approx", "valid",
    extra={"v_long": " UNION ALL ".join(f"""SELECT "GIA" AS stratum, '{c}' AS variable, {c}::DOUBLE AS value FROM valid""" for c in ("age", "lpa_nmol_max", "lpa_pred_nm"))},
    body="""SELECT stratum, variable, count(value)::BIGINT AS n, p, true AS "within" FROM v_long
    CROSS JOIN (VALUES (0.25::DOUBLE), (0.5::DOUBLE), (0.75::DOUBLE)) t(p) GROUP BY stratum, variable, p""")
add("overlaps", "raw_calls",
    body="""SELECT c.chrom, pos, pos + 1 + pos % 7 * 90 - 1 AS last, alt, sample, 'r' || s_suppkey::VARCHAR AS region
    FROM raw_calls c JOIN supplier ON c.chrom = CASE WHEN s_suppkey % 10 = 0 THEN 'chr6' ELSE '6' END
    AND pos <= 160395000 + s_suppkey * 701 + s_suppkey % 1000 AND pos + pos % 7 * 90 >= 160395000 + s_suppkey * 701""")
add("commit_run", "sites", "pred", "valid",
    body="""SELECT 'sites' AS table_name, count(*)::BIGINT AS row_count FROM sites UNION ALL
    SELECT 'sizes', 1 + count(DISTINCT coalesce("GIA", '?'))::BIGINT FROM valid UNION ALL SELECT 'summary', count(*)::BIGINT FROM pred""")
