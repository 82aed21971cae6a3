"""Report what every registered core query ran, from Spark's event log, into PLANS.md.

usage: python tools/plan_report.py [sf_dir] [out.md]

Each query is built and executed into the no-op sink with the event log on, in a
scratch folder. Everything that ran in that time counts: stage tables that a query
writes while it is built, subqueries, and the final plans after adaptive
re-planning, not those that ``explain`` shows beforehand.
"""

from __future__ import annotations

import glob
import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NODES = {
    "hash": r"Exchange hashpartitioning",
    "range": r"Exchange rangepartitioning",
    "single": r"Exchange SinglePartition",
    "BHJ": r"BroadcastHashJoin",
    "SMJ": r"SortMergeJoin",
    "nested": r"BroadcastNestedLoopJoin|CartesianProduct",
    "expand": r"^Expand",
    "window": r"^Window ",
    "python": r"MapInArrow|FlatMapGroupsInArrow|FlatMapCoGroupsInArrow|Python|Pandas",
    "codegen": r"^WholeStageCodegen",
}


def _walk(node: dict, found: dict[str, int]) -> None:
    text = node["simpleString"] if "Codegen" not in node["nodeName"] else node["nodeName"]
    if node["nodeName"] == "ReusedExchange":
        return
    for name, pattern in NODES.items():
        found[name] += bool(re.search(pattern, text))
    for child in node["children"]:
        _walk(child, found)


def _measured(log: str, spans: list[tuple[str, float, float]]) -> dict[str, dict]:
    """Per query: jobs, stages, rows scanned and shuffled, MB shuffled and spilled, and final plan nodes."""
    out = {name: {k: 0 for k in ("jobs", "stages", "read", "shuffled", "mb", "spill", *NODES)} for name, _, _ in spans}

    def of(ms: float) -> dict | None:
        return next((out[n] for n, a, b in spans if a <= ms / 1000 <= b), None)

    plans: dict[int, tuple[dict, dict]] = {}
    with open(log) as lines:
        for line in lines:
            e = json.loads(line)
            kind = e["Event"].rpartition(".")[2]
            if kind == "SparkListenerJobStart" and (q := of(e["Submission Time"])):
                q["jobs"] += 1
            elif kind == "SparkListenerStageCompleted" and (q := of(e["Stage Info"].get("Submission Time", 0))):
                q["stages"] += 1
            elif kind == "SparkListenerTaskEnd" and (m := e.get("Task Metrics")) and (q := of(e["Task Info"]["Launch Time"])):
                q["read"] += m["Input Metrics"]["Records Read"]
                q["shuffled"] += m["Shuffle Write Metrics"]["Shuffle Records Written"]
                q["mb"] += m["Shuffle Write Metrics"]["Shuffle Bytes Written"] / 1e6
                q["spill"] += m["Disk Bytes Spilled"] / 1e6
            elif "sparkPlanInfo" in e:
                owner = of(e["time"]) if "time" in e else plans.get(e["executionId"], (None, None))[0]
                if owner is not None:
                    plans[e["executionId"]] = (owner, e["sparkPlanInfo"])  # the last is the one that ran
    for owner, plan in plans.values():
        _walk(plan, owner)
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out = sys.argv[2] if len(sys.argv) > 2 else os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    from cohortlens.plans.catalog import queries
    from cohortlens.session import build_session
    from cohortlens.sources.files import load_testdata

    log_dir = tempfile.mkdtemp(prefix="cohortlens-events-")
    conf = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log_dir}", "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false"}
    spark = build_session("local[8]", shuffle_partitions=8, extra_conf=conf)
    spark.sparkContext.setLogLevel("ERROR")
    lines, events = (load_testdata(spark, sf_dir, t).count() for t in ("lineitem", "events"))
    spans = []
    for name, query in queries().items():
        began = time.time()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        spans.append((name, began, time.time()))
        time.sleep(0.05)
    spark.stop()
    (log,) = [p for p in glob.glob(os.path.join(log_dir, "*")) if not p.endswith(".inprogress")]
    measured = _measured(log, spans)

    head = ["jobs", "stages", "rows read", "rows shuffled", "MB shuffled", "MB spilled", *NODES]
    text = [
        "# What the registered core queries ran",
        "",
        f"Generated by `tools/plan_report.py` on `{sf_dir}` ({lines} order lines, {events} events) from Spark's",
        "event log: all jobs from the call of a query to its end, stage tables and subqueries included,",
        "with the plans as they ended after adaptive re-planning. `nested` must stay 0: no query pairs rows",
        "with rows. `expand` counts Expand nodes (GROUPING SETS over at most 504 rows per cluster); `python`",
        "nodes are the passes of KMeans and of the cell tree. Rows read are those of all scans, the other",
        "tables and the written stage tables too; a customer table has some",
        "hundredths of the rows of its facts.",
        "",
        "| query | " + " | ".join(head) + " |",
        "|---|" + "---|" * len(head),
    ]
    for name, m in measured.items():
        cells = [m["jobs"], m["stages"], m["read"], m["shuffled"], f"{m['mb']:.1f}", f"{m['spill']:.0f}", *[m[n] for n in NODES]]
        text.append(f"| `{name}` | " + " | ".join(map(str, cells)) + " |")
    with open(out, "w") as fh:
        fh.write("\n".join([*text, ""]))


if __name__ == "__main__":
    main()
