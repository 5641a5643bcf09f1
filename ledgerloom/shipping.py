"""Makes this package known to Python workers, wherever the driver has it from."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import ledgerloom

#: Bytes of rows that a Python worker gets at once, so that long texts do not pile up in it.
BATCH_BYTES = "8m"
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the library's sources to the workers of ``spark``, once per application.

    Also sets how much the session hands to a worker at once.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(ledgerloom.__path__[0])
    # The driver hands the file out as long as the application runs.
    folder = tempfile.mkdtemp(prefix="ledgerloom-ship-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = f"{folder}/ledgerloom.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, str(source.relative_to(root.parent)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
