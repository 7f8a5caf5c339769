"""Write the formatted physical plan of every query of the benefits domain to docs/plans/.

usage: python tools/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from perkflow.plans.catalog import REGISTRY
    from perkflow.session import local_session

    spark = local_session("8", 8)
    out = ROOT / "docs" / "plans"
    out.mkdir(parents=True, exist_ok=True)
    for key, q in sorted(REGISTRY.items()):
        df = q(spark, sf_dir).select("*")
        text = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
        (out / f"{key}.txt").write_text(f"-- {key} at {sf_dir}\n{text}\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
