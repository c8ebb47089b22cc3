"""Print the physical plans of the job's main stages (for plan review).

    python tools/explain_plans.py [sf_dir] [mode]

``mode`` is any ``DataFrame.explain`` mode (default ``formatted``).  Stages
are materialised as the pipeline does, so later plans start from ORC scans.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from churnlens.operators.typing import type_rows  # noqa: E402
from churnlens.plans import reports  # noqa: E402
from churnlens.plans.clean import add_groups, deduplicate  # noqa: E402
from churnlens.plans.pipeline import AttritionPipeline  # noqa: E402
from churnlens.schema import ROW_ID  # noqa: E402
from churnlens.session import build_session  # noqa: E402
from churnlens.sources.fixture import raw_records  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    mode = sys.argv[2] if len(sys.argv) > 2 else "formatted"
    spark = build_session("local[8]", shuffle_partitions=8)
    p = AttritionPipeline(spark, raw_records(spark, sf))
    stages = {
        "raw fixture (orders + line summary + customer)": lambda: p.raw,
        "profile: raw_missing (one scan, stack)": p.raw_missing,
        "profile: raw_duplicate_keys (top 100)": p.raw_duplicate_keys,
        "typed rows": lambda: type_rows(p.raw_stored, passthrough=[ROW_ID]),
        "latest per customer": lambda: deduplicate(p.typed),
        "bands (cut points inlined)": lambda: add_groups(p.deduplicated, [1.0, 2.0], [1.0, 2.0]),
        "share of total": lambda: reports.churn_summary(p.cleaned, 4),
        "rate: charge band x contract": lambda: reports.rate_charge_contract(p.cleaned),
    }
    for title, build in stages.items():
        print(f"\n===== {title} =====")
        build().explain(mode)
    spark.stop()


if __name__ == "__main__":
    main()
