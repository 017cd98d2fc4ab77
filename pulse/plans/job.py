"""A full run: every dataset built once, stored, and copied to the other format."""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Collection, Mapping
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import asdict

from pyspark.sql import DataFrame

from pulse.operators.profile import observed, require_rows
from pulse.plans.commits import Commits
from pulse.plans.datasets import DATASETS, build_dataset
from pulse.plans.params import Params
from pulse.session import configure, hashed_joins
from pulse.sinks.files import write_dataset
from pulse.sinks.paths import remove_path

log = logging.getLogger(__name__)

FOLDERS = {"parquet": "etl_parquet", "csv": "etl_csv"}


def run(
    tables: Mapping[str, DataFrame],
    params: Params,
    out: str,
    formats: Collection[str] = ("parquet", "csv"),
    only: Collection[str] | None = None,
    *,
    single_file: bool = False,
    in_place: bool = False,
    run_id: str | None = None,
) -> dict[str, dict[str, str]]:
    """Write the datasets below `out` and return their paths by dataset and format.

    A dataset is computed once, into Parquet. The CSV copy and the datasets built on it read
    that table, so a lost executor costs no recomputation of the joins and nothing is cached. The
    copies are written one after the other beside the datasets that follow, on cores these leave
    idle; no dataset is begun after a copy has failed.

    With a `run_id` every output is marked once it is in place. A run that is started again under
    the same id, with the same parameters and layout, skips what is marked and reads it where other
    datasets need it; the id stands for the state of the source tables, such as their date.
    """
    unknown = set(formats) - set(FOLDERS) | set(only or ()) - set(DATASETS)
    if unknown:
        raise ValueError(f"unknown formats or datasets: {sorted(unknown)}")
    spark = configure(next(iter(tables.values())).sparkSession)
    out = out.rstrip("/")
    layout = {"single_file": single_file, "in_place": in_place}
    key = run_id and json.dumps(
        {"run": run_id, "params": asdict(params), **layout}, default=str, sort_keys=True
    )
    commits = Commits(spark, out, key)
    staging = f"{out}/_staging_{uuid.uuid4().hex}"
    stored: dict[str, DataFrame] = {}
    paths: dict[str, dict[str, str]] = {}
    copier = ThreadPoolExecutor(1)
    copies: list[Future] = []

    def copy(name: str) -> None:
        order_by = DATASETS[name].order_by
        # Part files are read back in no set order.
        df = stored[name].sort(*order_by) if order_by else stored[name]
        commits.open(name, "csv")
        path = write_dataset(
            df, f"{out}/{FOLDERS['csv']}", DATASETS[name].file, "csv", order_by=order_by, **layout
        )
        commits.close(name, "csv", path)
        paths[name]["csv"] = path

    try:
        with hashed_joins(spark):
            for name, dataset in DATASETS.items():
                if only is not None and name not in only:
                    continue
                for begun in copies:
                    if begun.done():
                        begun.result()
                done = {fmt: commits.path_of(name, fmt) for fmt in formats}
                paths[name] = {fmt: path for fmt, path in done.items() if path}
                if done.get("parquet"):
                    stored[name] = spark.read.parquet(done["parquet"])
                if all(done.values()):
                    log.info("%s: committed by an earlier start", name)
                    continue
                keep = "parquet" in formats
                if name not in stored:
                    df, rows = observed(build_dataset(name, tables, params, stored), name)
                    if keep:
                        commits.open(name, "parquet")
                    path = write_dataset(
                        df,
                        f"{out}/{FOLDERS['parquet']}" if keep else staging,
                        dataset.file,
                        "parquet",
                        single_file=single_file and keep,
                        order_by=dataset.order_by,
                        in_place=in_place,
                    )
                    require_rows(rows.get["n_rows"], name)
                    stored[name] = spark.read.schema(df.schema).parquet(path)
                    if keep:
                        commits.close(name, "parquet", path)
                        paths[name]["parquet"] = path
                if "csv" in formats and "csv" not in paths[name]:
                    copies.append(copier.submit(copy, name))
            for begun in copies:
                begun.result()
    finally:
        copier.shutdown(cancel_futures=True)
        remove_path(spark, staging)
    return paths
