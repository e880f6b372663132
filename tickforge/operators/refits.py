"""Compiled refits: the fits per key (``learning.fit_online``) as columns of a Spark plan.

A refit is some million additions in small tables, which NumPy does in thousands of short
calls.  ``Refit.java`` takes the same steps in loops.  Spark's own compiler (Janino, which
its generated code goes through) compiles it on the driver, once per application; the
classes go to the executors as an added jar.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

import numpy as np
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.signals import MODEL_SIGNALS
from . import trees

SOURCE = Path(__file__).with_name("Refit.java")
BITS = ["XGBoost", "RandomForest", "AdaBoost", "LogisticReg"]  # of a label set, lowest first
LABELLED = "array<struct<_m: bigint, said: int>>"
MESSAGES = "array<struct<ts: timestamp_ntz, event_id: bigint, message_number: bigint, model_epoch: bigint, said: int>>"
_compiled: dict = {}  # application -> class loader


def _classes(spark: SparkSession):
    """The driver's loader of the compiled classes; executors have them from now on."""
    sc, jvm = spark.sparkContext, spark._jvm
    if sc.applicationId not in _compiled:
        compiler = jvm.org.codehaus.janino.SimpleCompiler()
        compiler.setParentClassLoader(jvm.java.lang.Thread.currentThread().getContextClassLoader())
        compiler.setDebuggingInformation(True, True, False)  # names and lines in stack traces
        compiler.cook(SOURCE.read_text())
        jar = os.path.join(tempfile.mkdtemp(prefix="tickforge-refit-"), f"refit-{sc.applicationId}.jar")
        with zipfile.ZipFile(jar, "w") as out:
            for name, code in dict(compiler.getBytecodes()).items():
                out.writestr(f"{name.replace('.', '/')}.class", bytes(code))
        sc._jsc.addJar(jar)
        _compiled[sc.applicationId] = compiler.getClassLoader()
    return _compiled[sc.applicationId]


def _java_array(spark: SparkSession, kind, values):
    out = spark.sparkContext._gateway.new_array(kind, len(values))
    for i, v in enumerate(values):
        out[i] = v
    return out


def seed_words(seed: int = trees.SEED) -> list[int]:
    """State and increment of NumPy's generator of a seed as signed 64-bit words, high ones first."""
    state = np.random.default_rng(seed).bit_generator.state["state"]
    words = [w for k in ("state", "inc") for w in (state[k] >> 64, state[k] & (1 << 64) - 1)]
    return [w - (1 << 64) if w >> 63 else w for w in words]


def _applied(spark: SparkSession, kind: str, returns: str, column: Column, every: int, buffer_rows: int, rounds: dict, n_bins: int) -> Column:
    settings = [n_bins, rounds["XGBoost"], rounds["RandomForest"], rounds["AdaBoost"], trees.BOOST_DEPTH, trees.FOREST_DEPTH,
                trees.SHRINKAGE, trees.L2, trees.MIN_HESSIAN, trees.GAIN]
    jvm = spark._jvm
    made = _classes(spark).loadClass(f"tickforge.Refit${kind}").getConstructors()[0]
    args = _java_array(spark, jvm.java.lang.Object, [_java_array(spark, jvm.double, [float(s) for s in settings]), _java_array(spark, jvm.long, seed_words()),
                                                     jvm.java.lang.Long.valueOf(every), jvm.java.lang.Long.valueOf(buffer_rows)])
    name = "tickforge_refit_" + "_".join(str(x).replace(".", "d") for x in [kind.lower(), every, buffer_rows, *settings[:4]])
    spark._jsparkSession.udf().register(name, made.newInstance(args), spark._jsparkSession.parseDataType(T._parse_datatype_string(returns).json()))
    return F.call_function(name, column)


def labelled(spark: SparkSession, rows: Column, every: int, buffer_rows: int, rounds: dict, n_bins: int) -> Column:
    """``rows``: message rows of a key, ascending: struct of number (bigint), label (int), refit that
    labels it or null (bigint) and the features (double).  (``_m``, ``said``) of those with a refit."""
    return _applied(spark, "Rows", LABELLED, rows, every, buffer_rows, rounds, n_bins)


def messages(spark: SparkSession, job: Column, every: int, buffer_rows: int, rounds: dict, n_bins: int) -> Column:
    """The labelled messages of a block of refits (``keyed.packed``)."""
    return _applied(spark, "Job", MESSAGES, job, every, buffer_rows, rounds, n_bins)


def label_columns(said: Column) -> dict[str, Column]:
    """UP or DOWN per model of a label set, null without one."""
    up = {name: said.bitwiseAND(F.lit(1 << k)) for k, name in enumerate(BITS)}
    return {name: F.when(up[name] > 0, F.lit("UP")).when(up[name] == 0, F.lit("DOWN")) for name in MODEL_SIGNALS}
