"""Write PLANS.md: formatted physical plans of the headline queries.

The trips are first written as the raw monthly parquet table (as in bench.py),
so the plans show what a run over real trip files looks like: partition and
pushed filters in the scans, broadcast joins, exchanges.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from farelane.plans import catalog  # noqa: E402
from farelane.session import get_spark  # noqa: E402
from farelane.sources import fixtures, sinks  # noqa: E402

KEYS = ("build_features", "preprocess_features", "build_splits", "drop_impact", "ks_distance", "quantile_scan", "outlier_summary")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = sys.argv[2] if len(sys.argv) > 2 else "PLANS.md"
    spark = get_spark("local[8]")
    raw = sinks.write_months(fixtures.load_trips(spark, sf), sinks.shared_dir(spark, "plans_raw"), files_per_month=1)
    fixtures.use_trip_table(sf, raw)
    qs = catalog.all_raw_queries()
    parts = ["# Physical plans of the headline queries\n",
             "Generated by `tools/dump_plans.py` over the trips written as monthly parquet "
             "(`file_month=YYYY-MM`).  Tree and scan details only; paths shortened.\n"]
    for k in KEYS:
        df = qs[k](spark, sf)
        df.write.format("noop").mode("overwrite").save()  # final adaptive plan
        text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        tree = text.split("\n\n")[0]
        scans = re.findall(r"\(\d+\) Scan parquet.*?(?=\n\n)", text, flags=re.S)
        scans = [re.sub(r"file:[^\],]*", "<dir>", s) for s in scans]
        parts.append(f"\n## {k}\n\n```\n{tree}\n```\n")
        if scans:
            parts.append("\nScans:\n\n```\n" + "\n\n".join(scans) + "\n```\n")
    with open(out, "w") as fh:
        fh.write("".join(parts))
    print(f"wrote {out}")


if __name__ == "__main__":
    main()
