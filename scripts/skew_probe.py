"""Measure what a hot key does to task sizes (from Spark's event log).

    python scripts/skew_probe.py [sf_dir]

A third of the documents (chosen by id hash) are moved onto one artist and
one title, then dedup, top-k per artist, the cap and term statistics run
with the event log written to a fresh scratch folder. For every stage that
reads a shuffle, the largest and the mean number of shuffle records one
task read are printed. A naive dedup (a whole-group window minimum, which
Spark cannot pre-limit) runs too, for contrast. Partition coalescing is off
so every reducer partition shows.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="verso-skew-log-")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", f"file://{log_dir}")
        .config("spark.eventLog.compress", "false")
        # keep every reducer partition visible (no coalescing of small ones)
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from verso.operators import corpus as corp
    from verso.operators import features as feat
    from verso.operators.prepare import hash_bucket
    from verso.sources.tables import read_table
    from verso.session import spread

    docs = spread(read_table(spark, sf_dir, "documents"))
    hot = hash_bucket("doc_id", 3) == 0
    songs = docs.select(
        "doc_id",
        F.when(hot, F.lit("hot artist")).otherwise(F.col("source")).alias("artist_name"),
        F.when(hot, F.lit("same title")).otherwise(F.substring("text", 1, 40)).alias("track_name"),
        F.col("n_chars").alias("popularity"),
        "text",
    )
    runs = {
        "dedup (min_by)": lambda: corp.dedup_first(songs.select("doc_id", "artist_name", "track_name")),
        "dedup naive (whole-group window)": lambda: songs.select("doc_id", "artist_name", "track_name")
        .withColumn("_m", F.min("doc_id").over(Window.partitionBy("artist_name", "track_name")))
        .where(F.col("doc_id") == F.col("_m")),
        "top-10 per artist": lambda: corp.top_per_group(songs, ["artist_name"], [F.desc("popularity"), F.asc("doc_id")], 10),
        "cap at target": lambda: corp.cap_at_target(songs.select("doc_id", "artist_name"), "artist_name"),
        "term statistics": lambda: feat.term_stats(feat.tokenize(songs, "text", "words")),
    }
    sc = spark.sparkContext
    for name, make in runs.items():
        sc.setJobGroup(name, name)
        make().write.format("noop").mode("overwrite").save()
    spark.stop()

    stage_group, tasks = {}, {}
    for path in sorted(glob.glob(f"{log_dir}/**/*", recursive=True)):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    props = ev.get("Properties") or {}
                    group = props.get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    recs = m.get("Total Records Read", 0)
                    size = m.get("Remote Bytes Read", 0) + m.get("Local Bytes Read", 0)
                    if recs:
                        tasks.setdefault(ev["Stage ID"], []).append((recs, size))
    print("| run | stage | tasks | max records / task | mean records / task | max KB / task |")
    print("| --- | --- | --- | --- | --- | --- |")
    for sid in sorted(tasks):
        recs = [r for r, _ in tasks[sid]]
        kb = max(b for _, b in tasks[sid]) / 1024
        print(f"| {stage_group.get(sid)} | {sid} | {len(recs)} | {max(recs)} | {sum(recs) / len(recs):.0f} | {kb:.0f} |")


if __name__ == "__main__":
    main()
