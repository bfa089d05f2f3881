"""Times the headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from tallyfold.operators import reads
from tallyfold.plans import fixtures
from tallyfold.plans.cycle import Load, init_marks, init_star, load_dimensions, load_facts, open_star, run_cycle
from tallyfold.plans.ingest import ingest_invoices, open_source
from tallyfold.queries import QUERIES
from tallyfold.queries.cycles import FIRST, SECOND, second_source
from tallyfold.queries.documents import documents
from tallyfold.schemas import SOURCE_TABLES
from tallyfold.session import build_session, fresh_path
from tallyfold.sources.tables import read_source

PLAIN = (
    "invoice_point",
    "derive_status",
    "calendar",
    "resolve_invoice",
    "unresolved_invoices",
    "first_per_key",
    "get_or_create_product",
    "surrogate_keys",
    "unique_violations_line",
    "fk_violations",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name, job):
        began = time.perf_counter()
        result = job()
        seconds[name] = round(time.perf_counter() - began, 3)
        return result

    def consume(df):
        df.write.format("noop").mode("overwrite").save()

    # The source tables as files, as an export of the source system would be.
    root = fresh_path(spark, "bench-source")
    for name in SOURCE_TABLES:
        fixtures.READERS[name](spark, folder).write.parquet(f"{root}/{name}")

    def table(name):
        return read_source(spark, root, name)

    timed("invoice_detail", lambda: consume(reads.invoice_detail(table)))
    for name in PLAIN:
        timed(name, lambda: consume(QUERIES[name](spark, folder)))

    star = open_star(spark, fresh_path(spark, "bench-star"), block_rows=1 << 15)
    init_star(star)
    init_marks(star)
    load = Load(star, table)
    timed("cycle_dimensions", lambda: load_dimensions(load, FIRST))
    timed("cycle_facts", lambda: load_facts(load, FIRST))
    changed = fresh_path(spark, "bench-changed")
    for name in SOURCE_TABLES:
        second_source(spark, folder)(name).write.parquet(f"{changed}/{name}")
    later = Load(star, lambda name: read_source(spark, changed, name))
    timed("cycle_increment", lambda: run_cycle(later, SECOND, retries=0))

    lines = fresh_path(spark, "bench-lines")
    documents(spark, folder).select("value").write.text(lines)
    store = open_source(spark, fresh_path(spark, "bench-ingest"), 1 << 15, 16)
    timed("ingest_documents", lambda: ingest_invoices(spark, lines, store, "line", FIRST))

    print(
        json.dumps(
            {
                "metric": "total time of the headline jobs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
