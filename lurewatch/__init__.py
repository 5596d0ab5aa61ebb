"""Mail-threat analytics as table-in / table-out Spark jobs."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

_SHIPPED: set[str] = set()


def ship(spark) -> None:
    """Make the package importable on the executors, once per application.

    Same as submitting it with ``--py-files``: the driver zips its own copy and
    Spark distributes the archive. Not needed where the package is installed.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    archive = shutil.make_archive(
        str(Path(tempfile.mkdtemp(prefix="lurewatch-")) / "lurewatch"), "zip", root.parent, root.name
    )
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
