"""Command line for the load jobs, for ``spark-submit``.

    spark-submit --py-files icdforge.zip -m icdforge.plans.cli \\
        diagnosis --source-dir /data/ICD_Diag_Desc --table DIM_ICD_Diagnosis \\
        --action DROP_CREATE --which ALL --reject-table icd_load_rejects

One run is one distributed job over all selected release files.  The session
comes from ``spark-submit`` (master, executors, ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from ..session import apply_recommended_conf
from . import jobs

LOADERS = {
    "diagnosis": jobs.load_diagnosis,
    "procedure": jobs.load_procedure,
    "poa_exempt": jobs.load_poa_exempt,
    "mce_edits": jobs.load_mce_edits,
}


def parse_args(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="icdforge", description="Load code-set releases into dimension tables.")
    p.add_argument("kind", choices=sorted(LOADERS))
    p.add_argument("--source-dir", required=True)
    p.add_argument("--table")
    p.add_argument("--schema")
    p.add_argument("--action", default="DROP_CREATE")
    p.add_argument("--which", default="ALL")
    p.add_argument("--reject-table")
    p.add_argument("--check-table")
    p.add_argument("--load-id", help="slice of the reject and check tables that this load replaces")
    p.add_argument("--max-rejects", type=int, default=0)
    p.add_argument("--store-dir", help="versioned store to publish into instead of a catalog table (action REFRESH: changed files only)")
    p.add_argument(
        "--field-name", action="append", default=[], metavar="OLD=NEW",
        help="output column name (diagnosis and procedure only), repeatable",
    )
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    a = parse_args(sys.argv[1:] if argv is None else argv)
    spark = SparkSession.builder.appName(f"icdforge-load-{a.kind}").getOrCreate()
    apply_recommended_conf(spark)
    kw = dict(
        table=a.table, schema=a.schema, action=a.action, which=a.which,
        reject_table=a.reject_table, max_rejects=a.max_rejects, check_table=a.check_table, load_id=a.load_id, store_dir=a.store_dir,
    )
    if a.field_name:
        if a.kind not in ("diagnosis", "procedure"):
            raise SystemExit("--field-name applies to diagnosis and procedure loads only")
        kw["field_names"] = dict(f.split("=", 1) for f in a.field_name)
    res = LOADERS[a.kind](spark, a.source_dir, **kw)
    print(json.dumps({"table": res.table, "rows": res.rows, "rejects": res.rejects, "releases": res.releases}))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
