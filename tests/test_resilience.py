"""A task that dies on its first attempt is retried and the results do not
change (local[4,2]: two attempts per task). Runs in its own process so the
shared test session keeps its settings."""

import os
import subprocess
import sys
import textwrap

SCRIPT = textwrap.dedent('''
    import sys
    sys.path.insert(0, sys.argv[1])
    import pandas as pd
    from pyspark import TaskContext
    from pyspark.sql import SparkSession
    from shoplens.operators import behaviour as B, prep as P
    from shoplens.sources import fixtures as X

    spark = (SparkSession.builder.master("local[4,2]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    sf = "/root/testdata/sf0.01"

    def fail_first_attempt(batches):
        ctx = TaskContext.get()
        if ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
            raise RuntimeError("injected task failure")
        yield from batches

    events = X.shop_events(spark, sf).repartition(4)
    flaky = events.mapInPandas(fail_first_attempt, events.schema)
    want = sorted(map(tuple, B.category_behaviour(P.clean_events(events, max_events=5)).collect()))
    got = sorted(map(tuple, B.category_behaviour(P.clean_events(flaky, max_events=5)).collect()))
    assert got == want and len(got) > 0, (got, want)
    print("RESILIENCE_OK")
''')


def test_results_survive_a_failed_task(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "flaky.py"
    script.write_text(SCRIPT)
    out = subprocess.run([sys.executable, str(script), repo], capture_output=True, text=True, timeout=600)
    assert "RESILIENCE_OK" in out.stdout, out.stdout[-2000:] + out.stderr[-4000:]
