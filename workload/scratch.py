"""Folder for tables a query writes and reads back."""

import tempfile

SETTING = "spark.checkpoint.dir"
OWN = {}


def scratch_folder(spark):
    """The shared folder the cluster names; where a local master names none, a new temporary one per application."""
    folder = spark.conf.get(SETTING, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"set {SETTING} to a folder that the driver and all executors share")
        application = spark.sparkContext.applicationId
        if application not in OWN:
            OWN[application] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        folder = OWN[application]
    return folder.rstrip("/")
