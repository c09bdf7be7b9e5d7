"""Dependency-ordered report builds (M3) and user-supplied SQL (M5)."""

from __future__ import annotations

import datetime as dt
import json
import os
import re
import time
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mooclens.plans.reports import BASE_TABLES, CATALOG, build_order, resolve
from mooclens.session import delete_path, escape_partition, path_exists, scratch_scope, settle_folder, swap_folder


def build_reports(spark: SparkSession, tables, out_dir: str, names: list[str] | None = None,
                  params: Mapping | None = None, append: bool = False, fail_fast: bool = False,
                  courses: list[str] | None = None, rebalance: bool = True) -> list[dict]:
    """M3: build reports (and the reports they read) in dependency order.

    All courses are built in one job per report.  Each report is written to
    ``out_dir/<name>`` partitioned by ``course_id``: the whole report is
    replaced (a course that has become empty goes), or, with ``courses``, just
    the rows of those courses, or rows are appended.  A replacement is written aside and swapped in once it is whole, so a
    report that fails leaves its old rows.  Later reports read the
    stored result instead of recomputing it.  The write is rebalanced by
    course, so small courses make one file and large ones several (``rebalance=False`` spares that shuffle).  Errors are collected per report; with ``fail_fast`` the
    first one is raised.  Intermediate tables go when the build ends.  Returns one status dict per report.
    """
    with scratch_scope(spark):
        return _build(spark, tables, out_dir, build_order(names or list(CATALOG)), params, append, fail_fast, courses, rebalance)


def _build(spark, tables, out_dir, order, params, append, fail_fast, courses, rebalance) -> list[dict]:
    memo: dict[str, DataFrame] = {}
    status = []
    sc = spark.sparkContext
    for name in order:
        t0 = time.perf_counter()
        sc.setJobDescription(f"report:{name}")   # tags the report's jobs (event log, UI)
        try:
            df = resolve(name, tables, params, memo, share=False)
            path = f"{out_dir}/{name}"
            settle_folder(spark, path)
            if courses is not None:
                df = df.where(F.col("course_id").isin(list(courses)))
            df = df.hint("rebalance", "course_id") if rebalance else df
            if append:
                df.write.mode("append").partitionBy("course_id").parquet(path)
            else:
                aside = f"{out_dir}/_new-{name}-{uuid.uuid4().hex}"
                try:
                    df.write.partitionBy("course_id").parquet(aside)
                    if courses is None or not path_exists(spark, path):
                        swap_folder(spark, aside, path)
                    else:
                        for course in courses:
                            part = f"course_id={escape_partition(spark, course)}"
                            swap_folder(spark, f"{aside}/{part}" if path_exists(spark, f"{aside}/{part}") else None, f"{path}/{part}")
                finally:
                    delete_path(spark, aside)
            memo[name] = spark.read.parquet(path)
            status.append({"report": name, "status": "ok", "seconds": round(time.perf_counter() - t0, 3)})
        except Exception as e:  # noqa: BLE001 - collected per report, like the source
            if fail_fast:
                raise
            status.append({"report": name, "status": "error", "error": str(e),
                           "seconds": round(time.perf_counter() - t0, 3)})
            memo.pop(name, None)
    sc.setJobDescription(None)
    return status


_TYPES = {"int": int, "float": float, "str": str, "bool": lambda v: v.lower() in ("1", "true", "yes"),
          "date": dt.date.fromisoformat, "json": json.loads}


def parse_params(items: list[str]) -> dict:
    """M5: ``key:type=value`` strings -> typed values; a repeated key gives a list."""
    out: dict = {}
    for item in items:
        head, _, raw = item.partition("=")
        key, _, typ = head.partition(":")
        val = _TYPES[typ or "str"](raw)
        if key in out:
            out[key] = (out[key] if isinstance(out[key], list) else [out[key]]) + [val]
        else:
            out[key] = val
    return out


def run_query(spark: SparkSession, sql: str, tables: Mapping[str, DataFrame], params: Mapping | None = None) -> DataFrame:
    """M5: run a user's SQL text over the given tables with named parameters.

    Tables are exposed as temporary views under their names; ``:name``
    markers in the text bind to ``params`` (lists become arrays).
    """
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    args = {}
    for k, v in (params or {}).items():
        args[k] = F.array(*[F.lit(x) for x in v]) if isinstance(v, list) else v
    return spark.sql(sql, args=args or None)


def read_query_file(path: str) -> tuple[str, str]:
    """M5: a user's ``.sql`` file -> ``(sql, description)``; the description is
    the block of ``--`` comment lines at the top of the file."""
    with open(path, encoding="utf8") as fh:
        text = fh.read()
    desc = []
    for line in text.splitlines():
        s = line.strip()
        if s.startswith("--"):
            desc.append(s[2:].strip())
        elif s:
            break
    return text, "\n".join(desc)


def run_query_file(spark: SparkSession, path: str, tables: Mapping[str, DataFrame], params: list[str] | None = None,
                   param_file: str | None = None) -> tuple[DataFrame, str]:
    """M5: run a ``.sql`` file with ``key:type=value`` parameters and/or a JSON
    parameter file (its values used as they are; command-line ones win)."""
    sql, desc = read_query_file(path)
    values: dict = {}
    if param_file:
        with open(param_file, encoding="utf8") as fh:
            values.update(json.load(fh))
    values.update(parse_params(params or []))
    return run_query(spark, sql, tables, values), desc


def tables_read(spark: SparkSession, sql: str) -> set[str]:
    """Names of the tables that a query reads, from its parsed plan (subqueries and common tables included)."""
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    return {n.strip("`") for n in re.findall(r"UnresolvedRelation \[([^\],]+)\]", plan.treeString())}


def run_query_dir(spark: SparkSession, folder: str, tables, params: Mapping | None = None) -> dict[str, DataFrame]:
    """M5: run all ``.sql`` files of a folder, each after the files it reads; a file's query is a view under the file's name.

    Files may also read reports of the catalogue, which are built from ``tables`` as needed, and the tables
    themselves. Files that read each other in a circle are an error. ``params`` bind the markers of any file.
    """
    texts = {os.path.splitext(n)[0]: read_query_file(os.path.join(folder, n))[0] for n in sorted(os.listdir(folder)) if n.endswith(".sql")}
    reads = {name: tables_read(spark, sql) for name, sql in texts.items()}
    memo: dict = {}
    out: dict[str, DataFrame] = {}
    path: list[str] = []

    def visit(name: str) -> None:
        if name in out:
            return
        if name in path:
            raise ValueError(f"queries read each other: {' -> '.join([*path[path.index(name):], name])}")
        path.append(name)
        given = {}
        for dep in sorted(reads[name]):
            if dep in texts:
                visit(dep)
            elif dep in CATALOG or dep in BASE_TABLES:
                given[dep] = resolve(dep, tables, params, memo)
        own = {k: v for k, v in (params or {}).items() if re.search(rf":{k}\b", texts[name])}
        out[name] = run_query(spark, texts[name], given, own)
        out[name].createOrReplaceTempView(name)
        path.pop()

    for name in texts:
        visit(name)
    return out
