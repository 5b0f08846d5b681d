"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cohortlens import ValidationConfig  # noqa: E402
from cohortlens.config import GROUP  # noqa: E402
from cohortlens.operators import agreement, calls, cohort, impact, plotdata, resample, summary  # noqa: E402
from cohortlens.plans.genotypes import prepare_calls  # noqa: E402
from cohortlens.plans.validation import validate  # noqa: E402
from cohortlens.sources.scratch import written  # noqa: E402
from verification.compare import session  # noqa: E402
from verification.inputs import THRESHOLDS, Inputs  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
SEED = 7


def full_run(i: Inputs) -> int:
    """Every result table of the default configuration."""
    tables = validate(i.predictions, i.measured, ValidationConfig())
    return sum(len(df.collect()) if name != "scatter_points" else df.count() for name, df in tables.items())


def main() -> None:
    only = sys.argv[1:]
    spark = session(CPUS)
    i = Inputs(spark, SF_DIR)
    for name in ("lineitem", "orders"):
        i.table(name).count()
    valid = written(i.valid, "bench-valid")
    joined = written(i.joined, "bench-joined")
    extracted = written(calls.site_intersect(calls.strip_fields(calls.normalize_chrom(i.raw_calls)), i.sites), "bench-calls")
    point = written(agreement.point_metrics_class(valid, THRESHOLDS), "bench-point")
    headline = {
        "agreement_from_tables": lambda: agreement.metrics_numeric(Inputs(spark, SF_DIR).valid).collect(),
        "numeric_boot_100": lambda: resample.numeric_boot(valid, 100, SEED).collect(),
        "numeric_boot_1000": lambda: resample.numeric_boot(valid, 1000, SEED).collect(),
        "class_boot_1000": lambda: resample.class_boot(valid, THRESHOLDS, 1000, SEED).collect(),
        "class_boot_by_row_100": lambda: resample.class_boot(valid, THRESHOLDS, 100, SEED, by_cell=False).collect(),
        "prevalence_table": lambda: impact.prevalence_table(joined, point, THRESHOLDS).collect(),
        "fisher_exact": lambda: impact.detection_improvement(impact.prevalence_table(joined, point, THRESHOLDS)).collect(),
        "demographics_by_group": lambda: summary.demographics(valid, GROUP).collect(),
        "density": lambda: plotdata.density(valid).collect(),
        "box_stats": lambda: plotdata.box_stats(valid).collect(),
        "group_order": lambda: cohort.group_order(valid).collect(),
        "an_ac": lambda: calls.an_ac(extracted).collect(),
        "calls_qc": lambda: [t.count() for t in prepare_calls(i.raw_calls, i.sites).values()],
        "full_run_1000": lambda: full_run(Inputs(spark, SF_DIR)),
    }
    times = {}
    for name, run in headline.items():
        if only and name not in only:
            continue
        start = time.time()
        run()
        times[name] = round(time.time() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_wall_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
