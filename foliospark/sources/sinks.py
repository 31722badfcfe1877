"""Writers of results."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_markdown(pages: DataFrame, folder: str, layouts: DataFrame | None = None) -> DataFrame:
    """Writes ``<folder>/<stem>.md`` for each doc of ``pages`` (doc, page, markdown); returns doc, path, pages.

    Documents are partitioned by name and their pages sorted, so a task writes
    page after page and never holds a document.  ``folder`` must be shared by the
    executors.  A repeated task writes the same file again (to a temporary name,
    then renamed).
    """
    counts = pages.groupBy("doc").agg(F.count("*").alias("n"))
    rows = pages.join(counts, "doc")
    rows = rows.join(
        layouts.select("doc", "layout"), "doc", "left"
    ) if layouts is not None else rows.withColumn("layout", F.lit(None).cast("string"))
    rows = rows.select(
        "doc", "page", "markdown", "n", F.coalesce("layout", F.lit("1-column")).alias("layout")
    ).repartition("doc").sortWithinPartitions("doc", "page")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.makedirs(folder, exist_ok=True)
        done: list[tuple[str, str, int]] = []
        now, file, final = None, None, ""
        for batch in batches:
            for row in batch.to_pylist():
                if row["doc"] != now:
                    if file:
                        file.close()
                        os.replace(file.name, final)
                    now = row["doc"]
                    stem = os.path.splitext(now)[0]
                    final = os.path.join(folder, f"{stem}.md")
                    file = open(f"{final}.{os.getpid()}.tmp", "w", encoding="utf-8")
                    file.write(
                        f'---\ntitle: "{stem}"\nsource: "{now}"\npages: {row["n"]}\nlayout: "{row["layout"]}"\n---\n'
                    )
                    done.append((now, final, row["n"]))
                if (row["markdown"] or "").strip():
                    file.write(f"\n\n---\n\n<!-- page {row['page']} -->\n\n{row['markdown']}")
        if file:
            file.close()
            os.replace(file.name, final)
        cols = list(zip(*done)) if done else [[], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64())],
            ["doc", "path", "pages"]
        )

    return rows.mapInArrow(run, "doc string, path string, pages bigint")


def write_json(df: DataFrame, folder: str) -> None:
    """One JSON object per row, nulls kept."""
    df.select(
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")
    ).write.mode("overwrite").text(folder)
