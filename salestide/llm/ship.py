"""Send this package to Python workers that cannot import it by themselves."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import salestide

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package's sources to the session's Python files, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.abspath(salestide.__file__))
    name = os.path.join(tempfile.mkdtemp(prefix="salestide-code-"), "salestide-code.zip")
    with zipfile.ZipFile(name, "w") as archive:
        for folder, _, files in os.walk(top):
            for file in files:
                if file.endswith(".py"):
                    path = os.path.join(folder, file)
                    archive.write(path, os.path.relpath(path, os.path.dirname(top)))
    context.addPyFile(name)
    _shipped.add(context.applicationId)
