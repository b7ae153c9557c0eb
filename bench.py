"""Headline benchmark: one JSON line with wall seconds per stage.

Stages (SURVEY section 6): preparation pipeline (frame, sequential IQR filter,
hash split, encoder fit, SMOTE), depth-5 tree fit, evaluation (confusion,
ROC / PR curves, AUC / AP), batch scoring of every customer into risk tiers.
Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from churnspark.operators import metrics as M  # noqa: E402
from churnspark.operators import score as J  # noqa: E402
from churnspark.operators.tree import TreeParams, fit_tree  # noqa: E402
from churnspark.plans.prepare import prepare  # noqa: E402
from churnspark.session import get_session  # noqa: E402
from churnspark.sources.tables import churn_frame  # noqa: E402
from churnspark.streaming.scoring import scoring_plan  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = get_session()
    times: dict[str, float] = {}

    t = time.time()
    frame = churn_frame(spark, sf_dir)
    prepared = prepare(frame)
    n_resampled = prepared.resampled.count()
    times["prepare"] = time.time() - t

    t = time.time()
    model = fit_tree(prepared.resampled, prepared.features, "label", TreeParams())
    times["tree_fit"] = time.time() - t

    t = time.time()
    pred = model.predict(prepared.test).persist()
    ev = M.evaluate(pred)
    ev["confusion"].collect()
    ev["roc"].collect()
    ev["pr"].collect()
    auc = ev["auc"].first()
    times["evaluate"] = time.time() - t

    t = time.time()
    scored = scoring_plan(frame, prepared.model, model)
    tiers = J.tier_summary(scored).collect()
    times["score"] = time.time() - t

    total = sum(times.values())
    print(json.dumps({
        "metric": "pipeline_wall", "value": round(total, 3), "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "rows_resampled": n_resampled, "tree_nodes": len(model.nodes),
        "roc_auc": auc["roc_auc"], "tiers": {r["risk_tier"]: r["customers"] for r in tiers},
    }))


if __name__ == "__main__":
    main()
