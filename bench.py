"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the data folder and BENCH_CPUS the number of local threads.
"""

import json
import os
import sys
import tempfile
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

from quireworks.registry import QUERIES  # noqa: E402
from quireworks.session import build_session  # noqa: E402

HEADLINE = (
    "clean_text",
    "char_windows",
    "chunk_recursive",
    "dedupe_batch",
    "known_hash_filter",
    "ingest_summary",
    "embed_hashed",
    "ingest_append",
    "ingest_dedupe",
    "ingest_stream",
    "document_concat",
    "file_listing",
    "ingest_file_stream",
    "batch_plan",
    "topk_cosine",
    "topk_batch",
    "topk_in_collection",
    "rag_prompt",
    "answer_prompts",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        tempfile.mkdtemp(prefix="bench-"),
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("chunks_per_title")  # start the JVM's compilers and the Python workers
    seconds = {name: run(name) for name in names}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
