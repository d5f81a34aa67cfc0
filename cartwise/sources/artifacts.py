"""Saving and loading trained artifacts (A11, A13, S4-S10), in versions.

Layout under one folder (any Hadoop path; shared storage on a cluster):

- ``parts/<id>/<name>/``       the parts of one save, each under a folder of its own that is never written again:
  ``model`` (PipelineModel, S9), ``metrics``, ``feature_cols``, ``parameters`` (JSON, S6, S7), ``avg_purchase_interval``,
  ``department_frequency``, ``product_department``, ``rules``, ``products`` (Parquet, S4, S5, S8)
- ``versions/<n>.json``        one manifest per committed version: where each part lies

A save writes its parts first and commits them with one manifest, put in place by a rename that fails when the
number is taken. Until then nothing names the new parts: a save that dies leaves the version before it whole. A reader picks
one manifest and reads only what it names, so it never sees a mixture, whatever is saved meanwhile.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from cartwise.functions.selection import exact_quantile
from cartwise.sources.files import read_table, write_table

PARTS = ("model", "feature_cols", "metrics", "avg_purchase_interval", "department_frequency", "product_department", "rules", "products", "parameters")


@dataclass
class Artifacts:
    model: PipelineModel | None
    feature_cols: list[str]
    metrics: DataFrame | None
    interval: DataFrame | None
    dept_freq: DataFrame | None
    product_dept: DataFrame | None
    rules: DataFrame | None = None
    products: DataFrame | None = None
    parameters: dict | None = None
    version: int | None = None

    @property
    def median(self) -> float | None:
        """The purchase interval that unknown users get: the one kept in training, else the median over the saved intervals."""
        kept = (self.parameters or {}).get("interval_median")
        return exact_quantile(self.interval, "avg_days_since_prior") if kept is None and self.interval is not None else kept


def _path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on any Hadoop file system."""
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def versions(spark: SparkSession, root: str) -> list[int]:
    """The committed versions, oldest first."""
    fs, folder = _hadoop(spark, _path(root, "versions"))
    if not fs.exists(folder):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def read_manifest(spark: SparkSession, root: str, version: int | None = None) -> tuple[int, dict[str, str]]:
    """``(version, {part: path under the root})`` of a committed version, the newest by default."""
    known = versions(spark, root)
    if not known or (version is not None and version not in known):
        raise FileNotFoundError(f"no {'artifacts' if version is None else f'version {version}'} at {root}; train and save first")
    version = known[-1] if version is None else version
    fs, p = _hadoop(spark, _path(root, f"versions/{version:08d}.json"))
    stream = fs.open(p)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return version, json.loads(text)["parts"]


def _commit(spark: SparkSession, root: str, parts: dict[str, str], after: int) -> int:
    """Put the manifest in place under the first free number after ``after``."""
    jvm = spark.sparkContext._jvm
    fs, draft = _hadoop(spark, _path(root, f"versions/.{uuid.uuid4().hex}.draft"))
    out = fs.create(draft, True)
    try:
        out.write(bytearray(json.dumps({"parts": parts}, sort_keys=True).encode()))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    plain = spark.sparkContext._gateway.new_array(kind, 0)  # no overwriting
    version = after + 1
    while True:
        _, target = _hadoop(spark, _path(root, f"versions/{version:08d}.json"))
        if not fs.exists(target):
            try:
                context.rename(fs.makeQualified(draft), fs.makeQualified(target), plain)
                return version
            except Exception as exc:  # another save took the number
                if "FileAlreadyExists" not in str(exc):
                    raise
        version += 1


def save_artifacts(
    root: str,
    model: PipelineModel | None = None,
    feature_cols: list[str] | None = None,
    metrics: DataFrame | None = None,
    interval: DataFrame | None = None,
    dept_freq: DataFrame | None = None,
    product_dept: DataFrame | None = None,
    rules: DataFrame | None = None,
    products: DataFrame | None = None,
    parameters: dict | None = None,
    inherit: bool = True,
) -> int:
    """Write the given parts as a new version under ``root`` and return its number.

    Parts that are not given are those of the version before (``inherit=False``: they are absent). ``parameters`` is a flat dict
    of numbers and text (training settings, rule thresholds, row limit, ``interval_median``).
    """
    spark = SparkSession.getActiveSession()
    before = versions(spark, root)
    parts = read_manifest(spark, root, before[-1])[1] if before and inherit else {}
    place = f"parts/{uuid.uuid4().hex}"

    def path(name: str) -> str:
        parts[name] = f"{place}/{name}"
        return _path(root, parts[name])

    if model is not None:
        model.write().overwrite().save(path("model"))
    if feature_cols is not None:
        rows = [(i, c) for i, c in enumerate(feature_cols)]
        write_table(spark.createDataFrame(rows, "position int, feature string").coalesce(1), path("feature_cols"), "json")
    if parameters is not None:
        rows = [(json.dumps(parameters, sort_keys=True),)]
        write_table(spark.createDataFrame(rows, "parameters string").coalesce(1), path("parameters"), "json")
    if metrics is not None:
        write_table(metrics.coalesce(1), path("metrics"), "json")
    for name, df in (
        ("avg_purchase_interval", interval),
        ("department_frequency", dept_freq),
        ("product_department", product_dept),
        ("rules", rules),
        ("products", products),
    ):
        if df is not None:
            write_table(df, path(name))
    return _commit(spark, root, parts, before[-1] if before else 0)


def load_artifacts(spark: SparkSession, root: str, with_model: bool = True, version: int | None = None) -> Artifacts:
    """Load one committed version, the newest by default; what is saved later does not touch it.

    No version, or one without a model where a model is asked for, raises FileNotFoundError (S10).
    """
    version, parts = read_manifest(spark, root, version)
    model = None
    if with_model:
        if "model" not in parts:
            raise FileNotFoundError(f"no model in version {version} at {root}; train and save it first")
        model = PipelineModel.load(_path(root, parts["model"]))

    def opt(name: str, fmt: str = "parquet") -> DataFrame | None:
        return read_table(spark, _path(root, parts[name]), fmt) if name in parts else None

    fc, given = opt("feature_cols", "json"), opt("parameters", "json")
    return Artifacts(
        model=model,
        feature_cols=[r["feature"] for r in fc.orderBy("position").select("feature").collect()] if fc is not None else [],
        metrics=opt("metrics", "json"),
        interval=opt("avg_purchase_interval"),
        dept_freq=opt("department_frequency"),
        product_dept=opt("product_department"),
        rules=opt("rules"),
        products=opt("products"),
        parameters=json.loads(given.first()["parameters"]) if given is not None else None,
        version=version,
    )


def prune_versions(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Forget all but the newest ``keep`` versions and delete the parts that no kept version names; the versions forgotten.

    Manifests go first, so a reader that starts later never picks a version whose parts are going. Readers of old
    versions must be done.
    """
    known = versions(spark, root)
    gone = known[: max(0, len(known) - max(1, keep))]
    kept = {p.split("/")[1] for v in known[len(gone) :] for p in read_manifest(spark, root, v)[1].values()}
    old = {p.split("/")[1] for v in gone for p in read_manifest(spark, root, v)[1].values()}
    for v in gone:
        fs, p = _hadoop(spark, _path(root, f"versions/{v:08d}.json"))
        fs.delete(p, False)
    for place in old - kept:
        fs, p = _hadoop(spark, _path(root, f"parts/{place}"))
        fs.delete(p, True)
    return gone
