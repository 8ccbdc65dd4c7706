"""Time headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Every query is run to its last row (a no-op sink), once to warm up and once for the figure.
"""

import json
import os
import sys
import time

from docgraph.catalog import QUERIES
from docgraph.plans.session import session

HEADLINE = [
    "report_global_index", "ingest_pages", "ingest_documents", "text_url_host", "link_channel",
    "agg_distribution", "score_importance", "score_action", "score_signals", "lint_immutable",
    "lint_terms", "gate_review_queue", "ident_make_id", "ident_collision_suffix", "dedup_exact",
    "dedup_near", "version_scd2", "asof_version", "link_entities", "rel_references", "rel_extends",
    "rel_aligns_shared", "rel_derives_band", "link_fuzzy", "link_cascade", "opinion_consensus",
    "cover_matrix", "cover_gaps", "theme_stats", "theme_bundle", "rank_topk", "graph_reverse",
    "graph_degree", "graph_chain", "set_diff", "lint_report", "append_new_docs", "stream_daily_counts",
]


def main() -> None:
    path = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        for _ in range(2):
            begin = time.time()
            QUERIES[name](spark, path).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - begin, 3)
    print(json.dumps({"metric": "total_headline_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": os.path.basename(path.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
