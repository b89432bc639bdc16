"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tabfeat.operators import metrics, profile, quality, split  # noqa: E402
from tabfeat.plans.chain import FeatureChain  # noqa: E402
from tabfeat.plans.models import Regressor  # noqa: E402
from tabfeat.plans.runs import run_single  # noqa: E402
from tabfeat.sources import frames  # noqa: E402
from tabfeat.sources.frames import LINE, LINE_INTER, LINE_KEY  # noqa: E402


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g")
             # Small files still give every core a task.
             .config("spark.sql.files.maxPartitionBytes", "2m").config("spark.sql.files.openCostInBytes", "64k")
             .config("spark.sql.execution.arrow.pyspark.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    frames.line(spark, folder).agg(F.sum("charge")).collect()  # start-up, not timed

    seconds: dict[str, float] = {}

    def timed(name, action):
        begun = time.perf_counter()
        result = action()
        seconds[name] = round(time.perf_counter() - begun, 3)
        return result

    lines = timed("split_exact", lambda: _kept(split.split_exact(frames.line_null(spark, folder), LINE)))
    inter = _kept(split.split_exact(frames.line_inter(spark, folder), LINE_INTER))
    basic = timed("basic_fit", lambda: FeatureChain("basic").fit(lines, LINE))
    timed("basic_apply", lambda: drain(basic.transform(lines)))
    advanced = timed("advanced_fit", lambda: FeatureChain("advanced").fit(inter, LINE_INTER))
    timed("advanced_apply", lambda: drain(advanced.transform(inter)))
    timed("all_metrics", lambda: metrics.all_metrics(frames.predictions(spark, folder), LINE_KEY).collect())
    timed("data_quality", lambda: quality.data_quality(lines.select(*LINE.features, "charge")).collect())
    timed("privacy_check", lambda: quality.privacy_check(frames.table(spark, folder, "documents")).collect())
    timed("corr_matrix", lambda: profile.corr_matrix(lines, [*LINE.features, "charge"]).collect())
    timed("histograms", lambda: profile.histograms(lines, list(LINE.features[:4]), 20).collect())
    timed("run_single", lambda: run_single(lines, LINE, "basic", Regressor("linear_regression")).metrics.collect())
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


def _kept(df):
    df = df.persist()
    df.count()
    return df


if __name__ == "__main__":
    main()
